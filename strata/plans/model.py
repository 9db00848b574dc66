"""Telecom / retail entities derived from the driver tables.

The reference's analytics run over a 15-table telecom schema and a retail
schema.  Here every entity is a lazy projection of the driver tables, so each
query's work grows with the data.  ``ENTITY_SQL`` holds the same derivations as
SQL text; the DuckDB oracle uses it as a CTE prefix.

Mapping (all ids are the driver keys):

    department  <- nation             worklocation <- region
    employee    <- supplier           employeeworklocation <- supplier (+2nd site for key % 10 = 0)
    salesperson <- supplier key % 4 <> 0 (SalesPersonId = key - 1), so chains of depth <= 3
    customer    <- customer, salesperson = c_custkey div 15 (about 15 customers each at any scale)
    orders      <- orders             tracking <- lineitem
    billinginformation <- lineitem aggregated per order
    plans, planinclusions <- part
    simdata, phonenumber  <- orders (one SIM / account / bill per order)
    callrecords <- events (user_id = account, value x 10 = seconds)
    salary      <- supplier (history with a fixed change per key % 4; key % 4 = 3 has none)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import AS_OF_YEAR
from ..sources.tables import Tables


class Model:
    """Entity frames for one scale-factor directory (lazy, nothing is read until an action)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = Tables(spark, sf_dir)

    # -- people and places ------------------------------------------------
    @property
    def department(self) -> DataFrame:
        n = self.t.nation
        return n.select(n.n_nationkey.cast("bigint").alias("DepartmentId"), n.n_name.alias("DepartmentName"))

    @property
    def worklocation(self) -> DataFrame:
        r = self.t.region
        return r.select(r.r_regionkey.cast("bigint").alias("LocationId"), r.r_name.alias("LocationName"))

    @staticmethod
    def _employee_name(key) -> F.Column:
        return F.concat(F.char((F.lit(65) + key % 26).cast("bigint")), F.lit(" "), F.col("s_name"))

    @property
    def employee(self) -> DataFrame:
        s = self.t.supplier
        k = F.col("s_suppkey")
        digits = F.lpad(((k * 7919 + 123456789) % 1000000000).cast("string"), 9, "0")
        ssn = F.concat_ws("-", F.substring(digits, 1, 3), F.substring(digits, 4, 2), F.substring(digits, 6, 4))
        return s.select(
            k.alias("EmployeeId"),
            self._employee_name(k).alias("Employee_Name"),
            ssn.alias("SSN"),
            (F.lit(20) + k % 45).alias("Age"),
            F.col("s_nationkey").cast("bigint").alias("DepartmentId"),
            F.col("s_acctbal").alias("Salary"),
        )

    @property
    def employeeworklocation(self) -> DataFrame:
        s = self.t.supplier.select("s_suppkey", "s_nationkey")
        home = s.select(F.col("s_suppkey").alias("WorkEmployeeId"), (F.col("s_nationkey") % 5).cast("bigint").alias("LocationId"))
        second = s.filter(F.col("s_suppkey") % 10 == 0).select(
            F.col("s_suppkey").alias("WorkEmployeeId"), ((F.col("s_nationkey") + 1) % 5).cast("bigint").alias("LocationId")
        )
        return home.unionByName(second)

    @property
    def salesperson(self) -> DataFrame:
        s = self.t.supplier
        return s.filter(F.col("s_suppkey") % 4 != 0).select(
            (F.col("s_suppkey") - 1).alias("SalesPersonId"), F.col("s_suppkey").alias("IdEmployeeSalesPerson")
        )

    @property
    def salary(self) -> DataFrame:
        s = self.t.supplier
        k = F.col("s_suppkey")
        delta = F.when(k % 4 == 0, F.lit(-100.0)).when(k % 4 == 1, F.lit(250.0)).otherwise(F.lit(0.0))
        return s.filter(k % 4 != 3).select(
            k.alias("EmployeeId"),
            self._employee_name(k).alias("EmployeeName"),
            F.col("s_nationkey").cast("bigint").alias("DepartmentId"),
            (F.col("s_acctbal") + delta).alias("Salary"),
        )

    @property
    def customer(self) -> DataFrame:
        c = self.t.customer
        k = F.col("c_custkey")
        dob = F.date_add(F.lit("1960-01-01").cast("date"), (k % 14000).cast("int"))
        return c.select(
            k.alias("CustomerId"),
            F.col("c_name").alias("CustomerName"),
            F.when(k % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("Sex"),
            (F.lit(AS_OF_YEAR) - F.year(dob)).cast("bigint").alias("Age"),
            dob.alias("DateOfBirth"),
            ((k * 7919 + 100000000) % 1000000000).alias("SocialSecurityNumber"),
            F.expr("c_custkey div 15").alias("CustomerSalesPersonId"),
        )

    # -- orders and billing ----------------------------------------------
    @property
    def orders(self) -> DataFrame:
        o = self.t.orders
        status = (
            F.when(F.col("o_orderstatus") == "F", F.lit("Shipped"))
            .when(F.col("o_orderstatus") == "O", F.lit("On the way"))
            .otherwise(F.lit("Pending"))
        )
        return o.select(
            F.col("o_orderkey").alias("OrderId"),
            F.col("o_orderpriority").alias("OrderType"),
            status.alias("OrderStatus"),
            F.col("o_custkey").alias("OrderCustomerId"),
        )

    @property
    def tracking(self) -> DataFrame:
        li = self.t.lineitem
        status = F.when(F.col("l_linestatus") == "O", F.lit("On the way")).otherwise(F.lit("Delivered"))
        return li.select(
            F.col("l_orderkey").alias("TrackingOrderId"),
            status.alias("TrackingStatus"),
            F.col("l_linenumber").cast("bigint").alias("TrackingLine"),
        )

    @property
    def billinginformation(self) -> DataFrame:
        li = self.t.lineitem
        return li.groupBy(F.col("l_orderkey").alias("BillNumber")).agg(
            (F.count(F.lit(1)) * 30).cast("bigint").alias("IncludedData"),
            F.sum("l_quantity").cast("bigint").alias("DataUsed"),
            (F.count(F.lit(1)) * 30 - F.sum("l_quantity")).cast("bigint").alias("BalancedData"),
            F.sum(F.round(F.col("l_tax") * 100)).cast("bigint").alias("Tax"),
        )

    # -- plans, SIMs, calls ----------------------------------------------
    @property
    def planinclusions(self) -> DataFrame:
        p = self.t.part
        size = F.col("p_size")
        s = lambda x: x.cast("string")
        data = (
            F.when(size % 4 == 0, F.concat(s(size * 50), F.lit("MB")))
            .when(size % 4 == 1, F.concat(s(size % 7), F.lit("GB")))
            .when(size % 4 == 2, F.concat(s(size % 5), F.lit(".5 GB")))
            .otherwise(F.concat(s(size % 9), F.lit(" GB")))
        )
        talk = F.when(size % 5 == 0, F.concat(s(size % 4 + 1), F.lit(" Hours"))).otherwise(
            F.concat(s(size * 10), F.lit(" Minutes"))
        )
        texts = F.when(size % 6 == 0, F.lit("Unlimited")).otherwise(s(size * 20))
        return p.select(F.col("p_partkey").alias("PlanId"), data.alias("Data"), talk.alias("Talktime"), texts.alias("TextMessages"))

    @property
    def plans(self) -> DataFrame:
        p = self.t.part
        return p.select(
            F.col("p_partkey").alias("PlansId"),
            F.col("p_type").alias("PlansType"),
            F.concat(F.col("p_name"), F.lit(" "), F.col("p_size").cast("string")).alias("PlanName"),
            F.col("p_partkey").alias("PlanInclusionId"),
        )

    @property
    def simdata(self) -> DataFrame:
        o = self.t.orders
        k = F.col("o_orderkey")
        plans = self.t.part.agg(F.max("p_partkey") + 1).scalar()  # SIMs reach every plan
        return o.select(
            (F.lit(5550000000) + k).alias("SimNumber"),
            F.when(k % 3 == 0, F.lit("eSIM")).otherwise(F.lit("physical")).alias("SimType"),
            F.col("o_custkey").alias("SimCustomerId"),
            k.alias("SimAccountNumber"),
            F.when(k % 13 == 0, F.lit(None).cast("bigint")).otherwise(k % plans).alias("SimPlanNumber"),
        )

    @property
    def phonenumber(self) -> DataFrame:
        o = self.t.orders
        k = F.col("o_orderkey")
        return o.select(k.alias("AccountNumber"), (F.lit(5550000000) + k).alias("PhoneNumber"), k.alias("PhoneBillNumber"))

    @property
    def callrecords(self) -> DataFrame:
        e = self.t.events
        dur = F.round(F.col("value") * 10).cast("bigint")
        return e.select(
            F.col("event_id").alias("CallId"),
            F.col("ts").alias("CallStartTime"),
            F.timestamp_add("SECOND", dur, F.col("ts")).alias("CallEndTime"),
            dur.alias("CallDuration"),
            F.col("user_id").alias("CallAccountNumber"),
        )

    # -- retail / lake ----------------------------------------------------
    @property
    def trx(self) -> DataFrame:
        li = self.t.lineitem
        fee = F.when(F.col("l_linenumber") % 5 == 0, F.lit(None).cast("double")).otherwise(F.round(F.col("l_tax") * 100, 2))
        return li.select(
            F.col("l_orderkey").alias("nid"),
            F.col("l_shipdate").alias("dinsertion"),
            F.col("l_partkey").alias("nproductid"),
            F.col("l_extendedprice").alias("namount"),
            fee.alias("noperationfee"),
            F.col("l_suppkey").alias("nshopid"),
        )

    @property
    def facturation(self) -> DataFrame:
        o = self.t.orders
        return o.select(
            F.col("o_orderkey").alias("nid"),
            F.col("o_custkey").alias("nshopid"),
            F.col("o_orderdate").alias("dinsertion"),
            F.expr("o_custkey div 15").alias("sbillerid"),
            F.col("o_totalprice").alias("namount"),
        )

    @property
    def shop(self) -> DataFrame:
        s = self.t.supplier
        name = F.when(F.col("s_suppkey") % 11 == 5, F.lit(None).cast("string")).otherwise(F.col("s_name"))
        return s.select(F.col("s_suppkey").alias("nid"), name.alias("sname"), F.col("s_nationkey").cast("bigint").alias("ncityid"))

    @property
    def city(self) -> DataFrame:
        n = self.t.nation
        return n.select(n.n_nationkey.cast("bigint").alias("nid"), F.lower(n.n_name).alias("sname"))

    @property
    def product(self) -> DataFrame:
        p = self.t.part
        return p.select(F.col("p_partkey").alias("nid"), F.col("p_name").alias("sname"))

    @property
    def recharge(self) -> DataFrame:
        e = self.t.events
        return e.filter(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("nid"),
            F.col("user_id").alias("nShopId"),
            F.col("ts").alias("dRecharge"),
            F.col("value").alias("nAmount"),
        )


# SQL form of the same derivations for the DuckDB oracle (one CTE per entity).
ENTITY_SQL: dict[str, str] = {
    "t_department": "SELECT CAST(n_nationkey AS BIGINT) AS DepartmentId, n_name AS DepartmentName FROM nation",
    "t_worklocation": "SELECT CAST(r_regionkey AS BIGINT) AS LocationId, r_name AS LocationName FROM region",
    "t_employee": (
        "SELECT s_suppkey AS EmployeeId, concat(chr(CAST(65 + s_suppkey % 26 AS INTEGER)), ' ', s_name) AS Employee_Name, "
        "concat_ws('-', substr(lpad(CAST((s_suppkey * 7919 + 123456789) % 1000000000 AS VARCHAR), 9, '0'), 1, 3), "
        "substr(lpad(CAST((s_suppkey * 7919 + 123456789) % 1000000000 AS VARCHAR), 9, '0'), 4, 2), "
        "substr(lpad(CAST((s_suppkey * 7919 + 123456789) % 1000000000 AS VARCHAR), 9, '0'), 6, 4)) AS SSN, "
        "20 + s_suppkey % 45 AS Age, CAST(s_nationkey AS BIGINT) AS DepartmentId, s_acctbal AS Salary FROM supplier"
    ),
    "t_employeeworklocation": (
        "SELECT s_suppkey AS WorkEmployeeId, CAST(s_nationkey % 5 AS BIGINT) AS LocationId FROM supplier "
        "UNION ALL SELECT s_suppkey, CAST((s_nationkey + 1) % 5 AS BIGINT) FROM supplier WHERE s_suppkey % 10 = 0"
    ),
    "t_salesperson": "SELECT s_suppkey - 1 AS SalesPersonId, s_suppkey AS IdEmployeeSalesPerson FROM supplier WHERE s_suppkey % 4 <> 0",
    "t_salary": (
        "SELECT s_suppkey AS EmployeeId, concat(chr(CAST(65 + s_suppkey % 26 AS INTEGER)), ' ', s_name) AS EmployeeName, "
        "CAST(s_nationkey AS BIGINT) AS DepartmentId, s_acctbal + CASE WHEN s_suppkey % 4 = 0 THEN -100.0 "
        "WHEN s_suppkey % 4 = 1 THEN 250.0 ELSE 0.0 END AS Salary FROM supplier WHERE s_suppkey % 4 <> 3"
    ),
    "t_customer": (
        "SELECT c_custkey AS CustomerId, c_name AS CustomerName, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS Sex, "
        f"CAST({AS_OF_YEAR} - year(DATE '1960-01-01' + CAST(c_custkey % 14000 AS INTEGER)) AS BIGINT) AS Age, "
        "DATE '1960-01-01' + CAST(c_custkey % 14000 AS INTEGER) AS DateOfBirth, "
        "(c_custkey * 7919 + 100000000) % 1000000000 AS SocialSecurityNumber, c_custkey // 15 AS CustomerSalesPersonId FROM customer"
    ),
    "t_orders": (
        "SELECT o_orderkey AS OrderId, o_orderpriority AS OrderType, CASE WHEN o_orderstatus = 'F' THEN 'Shipped' "
        "WHEN o_orderstatus = 'O' THEN 'On the way' ELSE 'Pending' END AS OrderStatus, o_custkey AS OrderCustomerId FROM orders"
    ),
    "t_tracking": (
        "SELECT l_orderkey AS TrackingOrderId, CASE WHEN l_linestatus = 'O' THEN 'On the way' ELSE 'Delivered' END AS TrackingStatus, "
        "CAST(l_linenumber AS BIGINT) AS TrackingLine FROM lineitem"
    ),
    "t_billinginformation": (
        "SELECT l_orderkey AS BillNumber, CAST(count(*) * 30 AS BIGINT) AS IncludedData, CAST(sum(l_quantity) AS BIGINT) AS DataUsed, "
        "CAST(count(*) * 30 - sum(l_quantity) AS BIGINT) AS BalancedData, CAST(sum(round(l_tax * 100)) AS BIGINT) AS Tax "
        "FROM lineitem GROUP BY l_orderkey"
    ),
    "t_planinclusions": (
        "SELECT p_partkey AS PlanId, CASE WHEN p_size % 4 = 0 THEN concat(CAST(p_size * 50 AS VARCHAR), 'MB') "
        "WHEN p_size % 4 = 1 THEN concat(CAST(p_size % 7 AS VARCHAR), 'GB') WHEN p_size % 4 = 2 THEN concat(CAST(p_size % 5 AS VARCHAR), '.5 GB') "
        "ELSE concat(CAST(p_size % 9 AS VARCHAR), ' GB') END AS Data, "
        "CASE WHEN p_size % 5 = 0 THEN concat(CAST(p_size % 4 + 1 AS VARCHAR), ' Hours') ELSE concat(CAST(p_size * 10 AS VARCHAR), ' Minutes') END AS Talktime, "
        "CASE WHEN p_size % 6 = 0 THEN 'Unlimited' ELSE CAST(p_size * 20 AS VARCHAR) END AS TextMessages FROM part"
    ),
    "t_plans": (
        "SELECT p_partkey AS PlansId, p_type AS PlansType, concat(p_name, ' ', CAST(p_size AS VARCHAR)) AS PlanName, "
        "p_partkey AS PlanInclusionId FROM part"
    ),
    "t_simdata": (
        "SELECT 5550000000 + o_orderkey AS SimNumber, CASE WHEN o_orderkey % 3 = 0 THEN 'eSIM' ELSE 'physical' END AS SimType, "
        "o_custkey AS SimCustomerId, o_orderkey AS SimAccountNumber, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % (SELECT max(p_partkey) + 1 FROM part) END AS SimPlanNumber FROM orders"
    ),
    "t_phonenumber": "SELECT o_orderkey AS AccountNumber, 5550000000 + o_orderkey AS PhoneNumber, o_orderkey AS PhoneBillNumber FROM orders",
    "t_callrecords": (
        "SELECT event_id AS CallId, ts AS CallStartTime, ts + to_seconds(CAST(round(value * 10) AS BIGINT)) AS CallEndTime, "
        "CAST(round(value * 10) AS BIGINT) AS CallDuration, user_id AS CallAccountNumber FROM events"
    ),
    "t_trx": (
        "SELECT l_orderkey AS nid, l_shipdate AS dinsertion, l_partkey AS nproductid, l_extendedprice AS namount, "
        "CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE round(l_tax * 100, 2) END AS noperationfee, l_suppkey AS nshopid FROM lineitem"
    ),
    "t_facturation": (
        "SELECT o_orderkey AS nid, o_custkey AS nshopid, o_orderdate AS dinsertion, o_custkey // 15 AS sbillerid, "
        "o_totalprice AS namount FROM orders"
    ),
    "t_shop": "SELECT s_suppkey AS nid, CASE WHEN s_suppkey % 11 = 5 THEN NULL ELSE s_name END AS sname, CAST(s_nationkey AS BIGINT) AS ncityid FROM supplier",
    "t_city": "SELECT CAST(n_nationkey AS BIGINT) AS nid, lower(n_name) AS sname FROM nation",
    "t_product": "SELECT p_partkey AS nid, p_name AS sname FROM part",
    "t_recharge": "SELECT event_id AS nid, user_id AS nShopId, ts AS dRecharge, value AS nAmount FROM events WHERE event_type = 'purchase'",
}


def with_entities(sql: str) -> str:
    """Prefix an oracle query with the entity CTEs it mentions."""
    used = [name for name in ENTITY_SQL if name in sql]
    if not used:
        return sql
    ctes = ",\n".join(f"{name} AS ({ENTITY_SQL[name]})" for name in used)
    body = sql.strip()
    head = body[:20].upper()
    if head.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if head.startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
