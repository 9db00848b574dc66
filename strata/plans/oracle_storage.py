"""DuckDB oracle SQL of the storage queries: what must be read back, from the source tables."""

from __future__ import annotations

from . import oracle_analytics, oracle_loading
from .analytics import PRESENTATION_ORDER
from .model import with_entities
from .storage_queries import EVENT_DOMAIN, RUN_DATE


def _position(name: str) -> str:
    order = ", ".join(f"{c} {'ASC' if asc else 'DESC'} NULLS LAST" for c, asc in PRESENTATION_ORDER[name])
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({oracle_analytics.SQL[name]})"


SQL: dict[str, str] = {
    "src6_discovery": """
SELECT 'clients' AS table_name, 'unknown' AS status, 'c_custkey bigint, c_name string' AS detail, CAST(NULL AS BIGINT) AS n_rows
UNION ALL SELECT 'nation', 'known', '', (SELECT count(*) FROM nation)
UNION ALL SELECT 'region', 'changed', '-r_regionkey int, +r_regionkey bigint, +r_comment string', NULL
UNION ALL SELECT 'supplier', 'missing', '', NULL
""",
    "src8_landing": f"SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '{RUN_DATE}' - 1",
    "src9_csv_header": "SELECT nid, sname, '20240630' AS stamp FROM t_product",
    "src10_json": "SELECT event_id, date_trunc('second', ts) AS ts, event_type, value FROM events",
    "snk1_append": "SELECT * FROM customer",
    "snk2_replace": "SELECT * FROM customer WHERE c_custkey % 3 = 0",
    "snk3_create_then_append": "SELECT * FROM supplier",
    "snk5_twice": "SELECT *, 'first' AS copy FROM supplier UNION ALL SELECT *, 'second' FROM supplier",
    "snk7_time_partitions": """
SELECT day AS event_date, count(*) AS n_rows, count(*) > 500 AS split
FROM (SELECT CASE WHEN event_id % 10 <> 0 THEN DATE '2024-01-05' ELSE CAST(ts AS DATE) END AS day FROM events) GROUP BY day
""",
    "snap1_full": "SELECT *, 'customer_FULL_20240601' AS snapshot FROM customer",
    "load1_branch": oracle_loading.SQL["ver3_compare"],
    "agg8_pieces": """
WITH entries AS (
  SELECT e.Employee_Name, c.CustomerName,
         coalesce(sum(length(c.CustomerName) + 2) OVER (PARTITION BY e.Employee_Name ORDER BY c.CustomerName ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM t_employee e JOIN t_salesperson sp ON sp.SalesPersonId = e.EmployeeId JOIN t_customer c ON c.CustomerSalesPersonId = sp.SalesPersonId
  LEFT JOIN t_simdata d ON c.CustomerId = d.SimCustomerId LEFT JOIN t_phonenumber p ON d.SimAccountNumber = p.AccountNumber
  LEFT JOIN t_callrecords ca ON p.AccountNumber = ca.CallAccountNumber
  WHERE c.CustomerName IS NOT NULL)
SELECT Employee_Name, CAST(begins // 64 AS BIGINT) AS piece, string_agg(CustomerName, ', ' ORDER BY begins) AS text FROM entries GROUP BY 1, 2
""",
    "typ2_domain": f"SELECT event_id, event_type FROM events WHERE event_type NOT IN ({', '.join(repr(c) for c in EVENT_DOMAIN)})",
    "snap2_by_range": oracle_loading.SQL["snap2_differential"],
    "snap2_one_range": """
SELECT 'U' AS op, o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey BETWEEN 101 AND 140
""",
    "ver3_by_range": oracle_loading.SQL["ver3_compare"],
    "win4_hot_tie": """
WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS line, l_returnflag, CASE WHEN l_linenumber < 5 THEN 0.0 ELSE l_quantity END AS quantity FROM lineitem)
SELECT line, l_returnflag, CAST(quantity AS DOUBLE) AS quantity,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY quantity DESC, line) AS row_number,
       rank() OVER (PARTITION BY l_returnflag ORDER BY quantity DESC) AS rank,
       dense_rank() OVER (PARTITION BY l_returnflag ORDER BY quantity DESC) AS dense_rank
FROM r
""",
    "srt1_position": _position("req1_20"),
    "srt2_position": _position("req1_01"),
}


def oracle(name: str) -> str:
    return with_entities(SQL[name])
