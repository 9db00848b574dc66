"""DuckDB oracle SQL for the loading / data-management queries.

Written from the definitions (which rows a version table must hold after the
run, which keys an upsert touches, ...) rather than from the Spark plans.
"""

from __future__ import annotations

from .loading_queries import EXPECTED_TABLES, T0, T1, TRACK_DAY
from .model import with_entities

HIGH = "9999-12-31 00:00:00"

V1 = """
v0 AS (SELECT * FROM customer),
v1 AS (
    SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer
    UNION ALL
    SELECT c_custkey + (SELECT max(c_custkey) + 1 FROM customer), c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 50 = 0
),
v1_del AS (SELECT * FROM v1 WHERE NOT (c_custkey % 97 = 0 AND c_custkey <= (SELECT max(c_custkey) FROM customer))),
chg AS (
    SELECT v0.c_custkey FROM v0 JOIN v1 ON v0.c_custkey = v1.c_custkey
    WHERE v0.c_name IS DISTINCT FROM v1.c_name OR v0.c_nationkey IS DISTINCT FROM v1.c_nationkey
       OR v0.c_acctbal IS DISTINCT FROM v1.c_acctbal OR v0.c_mktsegment IS DISTINCT FROM v1.c_mktsegment
)"""


def _hash(alias: str) -> str:
    texts = [f"CAST({alias}.{c} AS VARCHAR)" for c in ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]
    parts = [f"coalesce(length({t}) || ':' || {t}, '~')" for t in texts]
    return f"md5(concat_ws(chr(31), {', '.join(parts)}))"


def _versions(with_hash: bool) -> str:
    h0 = f", {_hash('v0')} AS row_hash" if with_hash else ""
    h1 = f", {_hash('v1')} AS row_hash" if with_hash else ""
    return f"""
WITH {V1}
SELECT v0.*{h0}, TIMESTAMP '{T0}' AS valid_from, TIMESTAMP '{HIGH}' AS valid_to, 1 AS flag
FROM v0 WHERE c_custkey NOT IN (SELECT c_custkey FROM chg)
UNION ALL
SELECT v0.*{h0}, TIMESTAMP '{T0}', TIMESTAMP '{T1}', 0 FROM v0 WHERE c_custkey IN (SELECT c_custkey FROM chg)
UNION ALL
SELECT v1.*{h1}, TIMESTAMP '{T1}', TIMESTAMP '{HIGH}', 1 FROM v1
WHERE c_custkey IN (SELECT c_custkey FROM chg) OR c_custkey NOT IN (SELECT c_custkey FROM v0)
"""


SQL: dict[str, str] = {}

SQL["ver1_initial_load"] = f"SELECT *, TIMESTAMP '{T0}' AS valid_from, TIMESTAMP '{HIGH}' AS valid_to, 1 AS flag FROM customer"
SQL["ver2_new_keys"] = f"""
WITH {V1}
SELECT v1.*, TIMESTAMP '{T1}' AS valid_from, TIMESTAMP '{HIGH}' AS valid_to, 1 AS flag
FROM v1 WHERE c_custkey NOT IN (SELECT c_custkey FROM v0)
"""
SQL["ver2_new_keys_by_max"] = f"""
WITH {V1}
SELECT v1.*, TIMESTAMP '{T1}' AS valid_from, TIMESTAMP '{HIGH}' AS valid_to, 1 AS flag
FROM v1 WHERE c_custkey > (SELECT coalesce(max(c_custkey), 0) FROM v0)
"""
SQL["ver3_compare"] = _versions(False)
SQL["ver4_since"] = _versions(False)
SQL["ver5_hash"] = _versions(True)
SQL["ver6_change_report"] = f"""
WITH {V1}
SELECT v1.c_custkey, {_hash('v0')} AS ChecksumColonne, {_hash('v1')} AS NouveauChecksum,
       CASE WHEN {_hash('v0')} = {_hash('v1')} THEN 'Non modifié' ELSE 'Modifié' END AS StatutModification
FROM v1 JOIN v0 ON v1.c_custkey = v0.c_custkey
"""
SQL["stm1_stamp"] = f"""
WITH {V1}
SELECT v1.*, CASE WHEN v0.c_custkey IS NULL OR v1.c_custkey IN (SELECT c_custkey FROM chg)
                  THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T0}' END AS last_updated
FROM v1 LEFT JOIN v0 ON v1.c_custkey = v0.c_custkey
"""
SQL["wmk1_advance"] = f"""
SELECT event_type AS "table", max(ts) AS watermark FROM events WHERE event_type <> 'click' GROUP BY event_type
UNION ALL SELECT 'click', TIMESTAMP '{T1}'
"""
SQL["load2_incremental"] = """
SELECT * FROM t_facturation
WHERE nid > (SELECT coalesce(max(nid), 0) FROM t_facturation WHERE nid <= (SELECT max(nid) // 2 FROM t_facturation))
"""
SQL["load4_consolidate"] = """
SELECT 'stge_trx' AS table_name, nid, NULL::VARCHAR AS sname, nshopid AS parent, namount::DOUBLE AS amount,
       coalesce(noperationfee, 0.0)::DOUBLE AS fee, dinsertion::DATE AS day FROM t_trx
UNION ALL SELECT 'stge_facturation', nid, NULL, nshopid, namount, NULL, dinsertion::DATE FROM t_facturation
UNION ALL SELECT 'stge_shop', nid, upper(sname), ncityid, NULL, NULL, NULL FROM t_shop
UNION ALL SELECT 'stge_city', nid, upper(substr(sname, 1, 1)) || lower(substr(sname, 2)), NULL, NULL, NULL, NULL FROM t_city
UNION ALL SELECT 'stge_product', nid, sname, NULL, NULL, NULL, NULL FROM t_product
UNION ALL SELECT 'stge_recharge', nid, NULL, nShopId, nAmount, NULL, dRecharge::DATE FROM t_recharge
"""

_PRODUCT = f"""
tgt AS (SELECT nid, sname, TIMESTAMP '{T0}' AS last_modified, TIMESTAMP '{T0}' AS dw_insert_date,
               TIMESTAMP '{T0}' AS dw_update_date FROM t_product WHERE nid % 3 <> 0),
chg_rows AS (SELECT nid, sname FROM t_product WHERE nid % 4 = 0
             UNION ALL SELECT nid + (SELECT max(nid) + 1 FROM t_product), sname FROM t_product WHERE nid % 25 = 0),
inc AS (SELECT nid, upper(substr(sname, 1, 1)) || lower(substr(sname, 2)) AS sname,
               TIMESTAMP '{T1}' AS last_modified FROM chg_rows)"""

SQL["ups1_upsert"] = f"""
WITH {_PRODUCT}
SELECT coalesce(t.nid, s.nid) AS nid,
       CASE WHEN s.nid IS NOT NULL THEN s.sname ELSE t.sname END AS sname,
       CASE WHEN s.nid IS NOT NULL THEN s.last_modified ELSE t.last_modified END AS last_modified,
       coalesce(t.dw_insert_date, TIMESTAMP '{T1}') AS dw_insert_date,
       CASE WHEN s.nid IS NOT NULL THEN TIMESTAMP '{T1}' ELSE t.dw_update_date END AS dw_update_date
FROM tgt t FULL OUTER JOIN inc s ON t.nid = s.nid
"""
SQL["jn12_lookup_route"] = f"""
WITH {_PRODUCT}
SELECT inc.*, CASE WHEN inc.nid IN (SELECT nid FROM tgt) THEN 'matched' ELSE 'unmatched' END AS route FROM inc
"""

_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
SQL["snap2_differential"] = f"""
WITH {V1}
SELECT CASE WHEN f.c_custkey IS NULL THEN 'I' WHEN c.c_custkey IS NULL THEN 'D' ELSE 'U' END AS op,
       {", ".join(f"CASE WHEN c.c_custkey IS NULL THEN f.{x} ELSE c.{x} END AS {x}" for x in _COLS)}
FROM v0 f FULL OUTER JOIN v1_del c ON f.c_custkey = c.c_custkey
WHERE f.c_custkey IS NULL OR c.c_custkey IS NULL
   OR f.c_name IS DISTINCT FROM c.c_name OR f.c_nationkey IS DISTINCT FROM c.c_nationkey
   OR f.c_acctbal IS DISTINCT FROM c.c_acctbal OR f.c_mktsegment IS DISTINCT FROM c.c_mktsegment
"""
SQL["snap3_restore"] = f"WITH {V1}\nSELECT * FROM v1_del"

SQL["trk1_first_insert"] = f"""
SELECT event_type AS table_name, min(ts) AS first_insert FROM events
WHERE CAST(ts AS DATE) = DATE '{TRACK_DAY}' GROUP BY event_type
"""
_EXPECTED = ", ".join(f"('{t}')" for t in EXPECTED_TABLES)
SQL["trk2_missing"] = f"""
SELECT table_name FROM (VALUES {_EXPECTED}) AS e(table_name)
WHERE table_name NOT IN (SELECT event_type FROM events WHERE CAST(ts AS DATE) = DATE '{TRACK_DAY}')
"""
SQL["trk3_rebuild"] = "SELECT event_type AS table_name, CAST(ts AS DATE) AS day, min(ts) AS first_insert FROM events GROUP BY 1, 2"

SQL["q1_duplicate_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
"""
SQL["q2_orphans"] = """
SELECT CustomerId, CustomerName, CustomerSalesPersonId FROM t_customer
WHERE CustomerSalesPersonId IS NOT NULL AND CustomerSalesPersonId NOT IN (SELECT SalesPersonId FROM t_salesperson)
"""
SQL["q3_null_counts"] = "SELECT " + ", ".join(
    f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}"
    for c in ["nid", "dinsertion", "nproductid", "namount", "noperationfee", "nshopid"]
) + " FROM t_trx"
SQL["q4_surrogate_key"] = "SELECT *, row_number() OVER (ORDER BY OrderId) AS sk FROM t_orders"
SQL["hsh1_row_hash"] = f"SELECT c_custkey, {_hash('c')} AS row_hash FROM customer c"

_RIB = "concat('FR76', lpad(CAST(c_custkey AS VARCHAR), 10, '0'), ' ', c_name)"
SQL["cry1_encrypt_roundtrip"] = f"SELECT c_custkey AS ID, {_RIB} AS RIB, {_RIB} AS DecryptedRIB FROM customer"
SQL["cry2_decrypt_errors"] = f"""
SELECT c_custkey AS ID, {_RIB} AS RIB,
       CASE WHEN c_custkey % 7 IN (0, 1) THEN 'ERREUR DE DÉCHIFFREMENT' ELSE {_RIB} END AS DecryptedRIB
FROM customer
"""

_TS_TEXT = "strftime(dinsertion, '%Y-%m-%d %H:%M:%S')"
SQL["jsn1_to_json"] = f"""
SELECT nid, CAST(to_json({{'nid': nid, 'nshopid': nshopid, 'dinsertion': {_TS_TEXT}, 'sbillerid': sbillerid, 'namount': namount}}) AS VARCHAR) AS record
FROM t_facturation
"""
SQL["jsn2_default_field"] = f"SELECT nid, nshopid, {_TS_TEXT} AS dinsertion, sbillerid, namount, 'FACTURATION1' AS dataSource FROM t_facturation"
SQL["jsn3_json_roundtrip"] = "SELECT nid, nshopid, dinsertion, sbillerid, namount FROM t_facturation"
SQL["agg16_rollup"] = """
SELECT CAST(ts AS DATE) AS day, user_id, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value, count(*) AS rows
FROM events GROUP BY 1, 2, 3
"""

SQL["lak1_lake_report"] = """
WITH t AS (SELECT CAST(nid AS VARCHAR) AS nid, CAST(dinsertion AS VARCHAR) AS dinsertion, CAST(nproductid AS VARCHAR) AS nproductid,
                  CAST(namount AS VARCHAR) AS namount, CAST(noperationfee AS VARCHAR) AS noperationfee, CAST(nshopid AS VARCHAR) AS nshopid FROM t_trx),
     p AS (SELECT CAST(nid AS VARCHAR) AS nid, sname FROM t_product),
     s AS (SELECT CAST(nid AS VARCHAR) AS nid, sname, CAST(ncityid AS VARCHAR) AS ncityid FROM t_shop),
     c AS (SELECT CAST(nid AS VARCHAR) AS nid, sname FROM t_city),
     f AS (SELECT CAST(nid AS VARCHAR) AS nid, CAST(nshopid AS VARCHAR) AS nshopid, CAST(dinsertion AS VARCHAR) AS dinsertion,
                  CAST(sbillerid AS VARCHAR) AS sbillerid, CAST(namount AS VARCHAR) AS namount FROM t_facturation)
SELECT t.nid AS transaction_id, t.dinsertion AS transaction_date, t.namount AS transaction_amount, t.noperationfee AS operation_fee,
       p.sname AS product_name, s.sname AS shop_name, c.sname AS city_name, f.namount AS facturation_amount, f.dinsertion AS facturation_date
FROM t
LEFT JOIN p ON t.nproductid = p.nid
LEFT JOIN s ON t.nshopid = s.nid
LEFT JOIN c ON s.ncityid = c.nid
LEFT JOIN f ON f.nshopid = t.nshopid
WHERE t.namount IS NOT NULL AND s.sname IS NOT NULL
"""

SQL["jn7_not_in"] = "SELECT EmployeeId, Employee_Name FROM t_employee WHERE EmployeeId NOT IN (SELECT IdEmployeeSalesPerson FROM t_salesperson)"
SQL["srt6_top_keys"] = "SELECT SimCustomerId FROM t_simdata GROUP BY SimCustomerId ORDER BY count(*) DESC, SimCustomerId LIMIT 5"
SQL["fn_call_times"] = """
SELECT CallId, strftime(CallStartTime, '%H:%M:%S') AS StartClock,
       CAST(hour(CallStartTime) * 3600 + minute(CallStartTime) * 60 + second(CallStartTime) AS BIGINT) AS StartSecondOfDay,
       date_diff('second', CallStartTime, CallEndTime) AS Seconds,
       CAST(year(CallStartTime) - 1990 AS INTEGER) AS YearsSince1990,
       CallStartTime + INTERVAL 3 MONTH AS PlusThreeMonths,
       strftime(CallEndTime, '%Y-%m-%d %H:%M:%S') AS EndText,
       strftime(CallStartTime, '%Y%m%d') AS DayStamp,
       abs(CallDuration - 2500) AS GapTo2500
FROM t_callrecords
"""

# ---- cleaning rules (LOAD3)
_CAP = "upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"
SQL["load3_clean_department"] = f"SELECT DepartmentId, {_CAP.format(c='DepartmentName')} AS DepartmentName FROM t_department"
SQL["load3_clean_worklocation"] = (
    "SELECT LocationId, CASE WHEN LocationName = 'Washington DC' THEN 'DC' ELSE LocationName END AS LocationName FROM t_worklocation"
)
SQL["load3_clean_employee"] = """
SELECT EmployeeId, Employee_Name, SSN, CAST(Age AS DOUBLE) AS Age, DepartmentId, CAST(Salary AS DOUBLE) AS Salary,
       regexp_split_to_array(trim(Employee_Name), '\\s+')[1] AS First_Name,
       regexp_split_to_array(trim(Employee_Name), '\\s+')[-1] AS Last_Name,
       CASE WHEN Age > 0 AND Age <= 20 THEN '<20' WHEN Age > 20 AND Age <= 30 THEN '20-30' WHEN Age > 30 AND Age <= 40 THEN '30-40'
            WHEN Age > 40 AND Age <= 50 THEN '40-50' WHEN Age > 50 THEN '50+' END AS Age_Group
FROM (SELECT *, row_number() OVER (PARTITION BY EmployeeId ORDER BY SSN) AS rn FROM t_employee) x WHERE rn = 1
"""
SQL["load3_clean_customer"] = """
SELECT *, CAST(2024 - year(DateOfBirth) AS INTEGER) AS Ages, CAST(year(DateOfBirth) AS INTEGER) AS BirthYear,
       '***-**-' || right(CAST(SocialSecurityNumber AS VARCHAR), 4) AS Masked_SSN
FROM t_customer
"""
SQL["load3_clean_orders"] = """
SELECT OrderId, coalesce(OrderType, 'Standard') AS OrderType, OrderStatus, OrderCustomerId,
       CASE WHEN contains(coalesce(OrderType, 'Standard'), 'Priority') THEN 1 ELSE 0 END AS IsPriorityOrder
FROM t_orders
"""
_MB = (
    "CASE WHEN regexp_matches(upper(trim(Data)), '^[0-9.]+\\s*GB$') "
    "THEN TRY_CAST(regexp_extract(upper(trim(Data)), '^([0-9]+(\\.[0-9]+)?)', 1) AS DOUBLE) * 1024 "
    "WHEN regexp_matches(upper(trim(Data)), '^[0-9.]+\\s*MB$') "
    "THEN TRY_CAST(regexp_extract(upper(trim(Data)), '^([0-9]+(\\.[0-9]+)?)', 1) AS DOUBLE) END"
)
_MIN = (
    "CASE WHEN contains(Talktime, 'Hours') THEN TRY_CAST(nullif(regexp_extract(Talktime, '(\\d+)', 1), '') AS DOUBLE) * 60 "
    "ELSE TRY_CAST(nullif(regexp_extract(Talktime, '(\\d+)', 1), '') AS DOUBLE) END"
)
SQL["load3_clean_planinclusions"] = f"""
SELECT *, {_MB} AS Data_MB, {_MIN} AS Talktime_Minutes, TRY_CAST(TextMessages AS BIGINT) AS TextMessages_Count,
       CAST({_MB} AS VARCHAR) || ' MB' AS Data_with_Unit, CAST({_MIN} AS VARCHAR) || ' Minutes' AS Talktime_with_Unit
FROM t_planinclusions
"""
SQL["load3_clean_plans"] = """
SELECT *, TRY_CAST(nullif(regexp_extract(PlanName, '(\\d+)', 1), '') AS DOUBLE) AS PlanName_Numeric,
       regexp_extract(trim(PlanName), '^(\\S+)', 1) AS PlanName_Action,
       nullif(regexp_extract(trim(PlanName), '^\\S+\\s+(.*)$', 1), '') AS PlanName_Description
FROM t_plans
"""
SQL["load3_clean_phonenumber"] = """
SELECT *, left(CAST(PhoneNumber AS VARCHAR), greatest(length(CAST(PhoneNumber AS VARCHAR)) - 4, 0)) || '****' AS Masked_PhoneNumber,
       left(CAST(PhoneNumber AS VARCHAR), 3) AS AreaCode, CAST(length(CAST(PhoneNumber AS VARCHAR)) AS INTEGER) AS NumberLength,
       row_number() OVER (PARTITION BY PhoneNumber ORDER BY AccountNumber) > 1 AS IsDuplicate
FROM t_phonenumber
"""
SQL["load3_clean_salary"] = """
SELECT *, Salary * 0.1 AS Bonus, Salary * 12 AS AnnualSalary,
       CASE WHEN Salary > 0 AND Salary <= 3000 THEN 'Low' WHEN Salary > 3000 AND Salary <= 6000 THEN 'Medium'
            WHEN Salary > 6000 AND Salary <= 9000 THEN 'High' WHEN Salary > 9000 THEN 'Very High' END AS SalaryRange,
       (Salary - (SELECT min(Salary) FROM t_salary)) / nullif((SELECT max(Salary) FROM t_salary) - (SELECT min(Salary) FROM t_salary), 0)
           AS NormalizedSalary
FROM t_salary
"""
SQL["load3_clean_simdata"] = "SELECT *, left(CAST(SimNumber AS VARCHAR), 6) AS CountryCode FROM t_simdata"
SQL["load3_clean_trx"] = "SELECT nid, dinsertion, nproductid, namount, coalesce(noperationfee, 0.0) AS noperationfee, nshopid FROM t_trx"
SQL["load3_clean_shop"] = "SELECT nid, upper(sname) AS sname, ncityid FROM t_shop"
SQL["load3_clean_city"] = f"SELECT nid, {_CAP.format(c='sname')} AS sname FROM t_city"


def oracle(name: str) -> str:
    return with_entities(SQL[name])
