"""DuckDB oracle SQL for the business queries.

Each oracle states the request directly in SQL over the entity CTEs of
``model.ENTITY_SQL`` (``t_customer`` ...), independently of the DataFrame plans:
correlated subqueries, LATERAL, recursive CTE and PIVOT are left for DuckDB
to plan.  Semantics follow SURVEY 2.15 (double averages, decimal money sums,
explicit NULL order, a key as last sort column, ordered string aggregation).
"""

from __future__ import annotations

from ..session import AS_OF, AS_OF_YEAR
from .analytics import (
    CMP_ABOVE, CMP_BELOW, CMP_EQUAL, DEPT_PREFIX, EXCEEDING, SHIPPED, TREND_DOWN, TREND_SAME, TREND_UP,
    UNKNOWN_NAME, WITHIN_LIMIT,
)
from .model import with_entities


def _minutes(c: str) -> str:
    """Leading number of a talk-time text."""
    return f"TRY_CAST(trim(substr({c}, 1, strpos({c}, ' '))) AS BIGINT)"


def _years(dob: str) -> str:
    return f"({AS_OF_YEAR} - year({dob}))"


SQL: dict[str, str] = {}

# --- talk minutes: customer -> sim -> plan -> inclusions
_PLAN_ROWS = """
    FROM t_simdata s
    JOIN t_customer c ON c.CustomerId = s.SimCustomerId
    JOIN t_plans pl ON pl.PlansId = s.SimPlanNumber
    JOIN t_planinclusions pin ON pin.PlanId = pl.PlanInclusionId"""

SQL["req1_01"] = f"""
SELECT c.CustomerName, CAST(sum({_minutes('pin.Talktime')}) AS BIGINT) AS total_talktime_minutes
{_PLAN_ROWS}
GROUP BY c.CustomerName
"""

_SP_PLAN_ROWS = """
    FROM t_customer c
    JOIN t_salesperson sp ON c.CustomerSalesPersonId = sp.SalesPersonId
    JOIN t_simdata s ON s.SimCustomerId = c.CustomerId
    LEFT JOIN t_plans pl ON pl.PlansId = s.SimPlanNumber
    JOIN t_planinclusions pin ON pin.PlanId = pl.PlanInclusionId"""

SQL["req1_02"] = f"""
SELECT sp.SalesPersonId, max(c.CustomerName) AS max_customername,
       CAST(sum({_minutes('pin.Talktime')}) AS BIGINT) AS total_talktime_minutes
{_SP_PLAN_ROWS}
GROUP BY 1
"""

SQL["req1_03"] = f"""
SELECT sp.SalesPersonId, c.CustomerName, CAST(sum({_minutes('pin.Talktime')}) AS BIGINT) AS total_talktime
{_SP_PLAN_ROWS}
GROUP BY 1, 2
"""

# --- location -> staff -> salesperson -> customers -> orders -> tracking lines
_SITE_CHAIN = """
    FROM t_worklocation loc
    LEFT JOIN t_employeeworklocation lnk ON lnk.LocationId = loc.LocationId
    LEFT JOIN t_employee emp ON emp.EmployeeId = lnk.WorkEmployeeId
    {extra}LEFT JOIN t_salesperson sp ON sp.IdEmployeeSalesPerson = emp.EmployeeId
    LEFT JOIN t_customer cu ON cu.CustomerSalesPersonId = sp.SalesPersonId
    LEFT JOIN t_orders od ON od.OrderCustomerId = cu.CustomerId
    LEFT JOIN t_tracking tr ON tr.TrackingOrderId = od.OrderId
    WHERE lower(tr.TrackingStatus) = 'on the way'"""

SQL["req1_05"] = f"""
SELECT loc.LocationName, count(od.OrderId) AS order_count, 'on the way' AS tracking_status,
       CAST(sum(CAST(emp.Salary AS DECIMAL(18,2))) AS DOUBLE) AS total_salary
{_SITE_CHAIN.format(extra="")}
GROUP BY loc.LocationName
"""

SQL["req1_10"] = f"""
SELECT loc.LocationName, count(od.OrderId) AS total_orders, tr.TrackingStatus,
       CAST(sum(CAST(hist.Salary AS DECIMAL(18,2))) AS DOUBLE) AS total_salary
{_SITE_CHAIN.format(extra="LEFT JOIN t_salary hist ON hist.DepartmentId = emp.DepartmentId\n    ")}
GROUP BY loc.LocationName, tr.TrackingStatus
"""

SQL["req1_06"] = """
SELECT emp.Employee_Name,
       string_agg(cu.CustomerName, ', ' ORDER BY cu.CustomerName) AS customer_names,
       CAST(sum(cl.CallDuration) AS BIGINT) AS total_call_duration_seconds
FROM t_employee emp
LEFT JOIN t_salesperson sp ON emp.EmployeeId = sp.SalesPersonId
LEFT JOIN t_customer cu ON sp.SalesPersonId = cu.CustomerSalesPersonId
LEFT JOIN t_simdata sim ON sim.SimCustomerId = cu.CustomerId
LEFT JOIN t_phonenumber ph ON ph.AccountNumber = sim.SimAccountNumber
LEFT JOIN t_callrecords cl ON cl.CallAccountNumber = ph.AccountNumber
GROUP BY emp.Employee_Name
"""

_CALL_ROWS = """
FROM t_customer cu
LEFT JOIN t_simdata sim ON sim.SimCustomerId = cu.CustomerId
LEFT JOIN t_phonenumber ph ON ph.AccountNumber = sim.SimAccountNumber
LEFT JOIN t_callrecords cl ON cl.CallAccountNumber = ph.AccountNumber
"""

SQL["req1_07"] = f"""
SELECT cu.CustomerName, cu.CustomerId AS id
{_CALL_ROWS}
WHERE cl.CallDuration >= (SELECT max(CallDuration) FROM t_callrecords WHERE CallDuration >= 1000)
"""

SQL["req1_08"] = f"""
SELECT DISTINCT cu.CustomerName, cu.CustomerId AS id
{_CALL_ROWS}
WHERE EXISTS (SELECT 1 FROM t_callrecords x WHERE x.CallDuration >= 1000 AND x.CallDuration = cl.CallDuration)
"""

SQL["req1_09"] = f"""
SELECT cu.CustomerName, max(cu.CustomerId) AS id
{_CALL_ROWS}
WHERE cl.CallDuration <= (SELECT avg(CallDuration) FROM t_callrecords)
GROUP BY cu.CustomerName
"""

_SALES = """
SELECT sp.SalesPersonId, emp.Employee_Name AS SalesPersonName, CAST(sum(b.{m}) AS BIGINT) AS TotalSales
FROM t_salesperson sp
LEFT JOIN t_employee emp ON emp.EmployeeId = sp.IdEmployeeSalesPerson
LEFT JOIN t_customer cu ON cu.CustomerSalesPersonId = sp.SalesPersonId
LEFT JOIN t_orders od ON od.OrderCustomerId = cu.CustomerId
LEFT JOIN t_billinginformation b ON b.BillNumber = od.OrderId
GROUP BY sp.SalesPersonId, emp.Employee_Name
"""
SQL["req1_11"] = _SALES.format(m="BalancedData")
SQL["req1_12"] = _SALES.format(m="DataUsed")

SQL["req1_13"] = """
WITH usage_groups AS (
    SELECT cu.CustomerId, cu.CustomerName, b.DataUsed, sum(b.DataUsed) AS group_sum
    FROM t_orders od
    JOIN t_customer cu ON cu.CustomerId = od.OrderCustomerId
    JOIN t_billinginformation b ON b.BillNumber = od.OrderId
    GROUP BY 1, 2, 3
),
numbered AS (
    SELECT *, CAST(sum(DataUsed) OVER (PARTITION BY CustomerId) AS BIGINT) AS TotalDataUsage,
           CAST(row_number() OVER (ORDER BY group_sum DESC, CustomerId, DataUsed) AS INTEGER) AS Rank
    FROM usage_groups
)
SELECT CustomerId, CustomerName, TotalDataUsage, Rank FROM numbered WHERE Rank <= 3
"""

SQL["req1_14"] = """
SELECT EmployeeId, Employee_Name, Salary, prev_id AS PreviousEmployeeId, next_id AS NextEmployeeId,
       abs(EmployeeId - prev_id) AS GapToPreviousEmployee, abs(EmployeeId - next_id) AS GapToNextEmployee
FROM (
    SELECT *, lag(EmployeeId) OVER w AS prev_id, lead(EmployeeId) OVER w AS next_id
    FROM t_employee WINDOW w AS (ORDER BY EmployeeId)
) z
"""

SQL["req1_15"] = """
SELECT DepartmentId, EmployeeId, Employee_Name, Salary, Rank
FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY DepartmentId ORDER BY Salary DESC, EmployeeId) AS INTEGER) AS Rank
    FROM t_employee
) z
WHERE Rank <= 5
"""

SQL["req1_16"] = """
SELECT EmployeeId, Employee_Name, Salary, DepartmentId,
    CAST(dense_rank() OVER by_pay AS BIGINT) AS SalaryRankInDepartment,
    CAST(row_number() OVER by_pay_id AS BIGINT) AS SalaryRowInDepartment,
    CAST(ntile(4) OVER by_pay_id AS BIGINT) AS SalaryQuartileInDepartment,
    round(Salary - avg(Salary) OVER (PARTITION BY DepartmentId), 4) AS SalaryDifferenceFromAvg,
    first_value(EmployeeId) OVER by_pay_id AS HighestPaidEmployeeIdInDepartment,
    max(EmployeeId) OVER (PARTITION BY DepartmentId, Salary) AS LowestPaidEmployeeIdInDepartment
FROM t_employee
WINDOW by_pay AS (PARTITION BY DepartmentId ORDER BY Salary DESC),
       by_pay_id AS (PARTITION BY DepartmentId ORDER BY Salary DESC, EmployeeId)
"""

SQL["req1_17"] = """
WITH cost AS (
    SELECT cu.CustomerId, cu.CustomerName, CAST(sum(b.BalancedData) AS BIGINT) AS TotalOrderCost
    FROM t_customer cu
    LEFT JOIN t_orders od ON od.OrderCustomerId = cu.CustomerId
    LEFT JOIN t_billinginformation b ON b.BillNumber = od.OrderId
    GROUP BY cu.CustomerId, cu.CustomerName
)
SELECT CustomerId, CustomerName, TotalOrderCost,
       CAST(rank() OVER (ORDER BY TotalOrderCost DESC NULLS LAST) AS BIGINT) AS CustomerRank,
       round(100.0 * TotalOrderCost / sum(TotalOrderCost) OVER (), 4) AS OrderCostPercentage
FROM cost
QUALIFY dense_rank() OVER (PARTITION BY CustomerId ORDER BY TotalOrderCost DESC NULLS LAST) = 1
"""

SQL["req1_18"] = """
WITH named AS (
    SELECT e.EmployeeId, e.Employee_Name, e.DepartmentId, e.Salary, e.Age, e.SSN,
           CAST(row_number() OVER (ORDER BY e.Salary DESC, e.EmployeeId) AS BIGINT) AS RowNumber
    FROM t_employee e
    WHERE regexp_matches(e.Employee_Name, '^[A-Ma-m]')
      AND EXISTS (SELECT 1 FROM t_department d WHERE d.DepartmentId = e.DepartmentId)
)
SELECT * FROM named ORDER BY Age DESC, EmployeeId LIMIT 5 OFFSET 10
"""

SQL["req1_19"] = f"""
SELECT coalesce(Employee_Name, '{UNKNOWN_NAME}') AS EmployeeName, DepartmentId,
       (CASE WHEN Salary < 0 THEN '-$' ELSE '$' END) || format('{{:,.2f}}', abs(Salary)) AS FormattedSalary,
       '{DEPT_PREFIX}' || CAST(DepartmentId AS VARCHAR) AS DepartmentCode,
       TIMESTAMP '{AS_OF}' + INTERVAL 3 MONTH AS HiredDatePlus3Months
FROM t_employee
"""

SQL["req1_20"] = f"""
WITH trends AS (
    SELECT CAST(year(cu.DateOfBirth) AS INTEGER) AS BirthYear, cu.Sex, od.OrderType, od.OrderStatus,
           count(*) AS OrderCount, avg({_years('cu.DateOfBirth')}) AS AvgCustomerAge
    FROM t_orders od JOIN t_customer cu ON cu.CustomerId = od.OrderCustomerId
    GROUP BY 1, 2, 3, 4
),
sellers AS (
    SELECT sp.SalesPersonId, emp.Employee_Name AS SalespersonName, dep.DepartmentName,
           count(DISTINCT cu.CustomerId) AS TotalCustomers, count(DISTINCT od.OrderId) AS TotalOrders,
           count(*) FILTER (WHERE od.OrderStatus = '{SHIPPED}') AS ShippedOrders,
           avg({_years('cu.DateOfBirth')}) AS AvgCustomerAge
    FROM t_salesperson sp
    JOIN t_employee emp ON emp.EmployeeId = sp.IdEmployeeSalesPerson
    JOIN t_department dep ON dep.DepartmentId = emp.DepartmentId
    LEFT JOIN t_customer cu ON cu.CustomerSalesPersonId = sp.SalesPersonId
    LEFT JOIN t_orders od ON od.OrderCustomerId = cu.CustomerId
    GROUP BY 1, 2, 3
),
matched AS (
    SELECT t.*, best.SalespersonName, best.DepartmentName, best.TotalCustomers, best.TotalOrders, best.ShippedOrders,
           CAST(best.ShippedOrders AS DOUBLE) / NULLIF(best.TotalOrders, 0) AS rate
    FROM trends t, LATERAL (
        SELECT * FROM sellers s
        WHERE s.AvgCustomerAge >= t.AvgCustomerAge - 5 AND s.AvgCustomerAge <= t.AvgCustomerAge + 5
        ORDER BY s.TotalOrders DESC, s.SalesPersonId
        LIMIT 1
    ) best
)
SELECT BirthYear, Sex, OrderType, OrderStatus, OrderCount, round(AvgCustomerAge, 4) AS AvgCustomerAge,
       SalespersonName, DepartmentName, TotalCustomers, TotalOrders, ShippedOrders, round(rate, 4) AS ShippedOrderRate,
       CAST(dense_rank() OVER (ORDER BY TotalCustomers DESC NULLS LAST) AS INTEGER) AS CustomerRank,
       CAST(dense_rank() OVER (ORDER BY TotalOrders DESC NULLS LAST) AS INTEGER) AS OrderRank,
       CAST(dense_rank() OVER (ORDER BY rate DESC NULLS LAST) AS INTEGER) AS ShippedOrderRateRank
FROM matched
"""

SQL["req1_22"] = """
WITH per_customer AS (
    SELECT od.OrderCustomerId AS cust, CAST(sum(b.IncludedData + b.DataUsed + b.BalancedData) AS BIGINT) AS TotalCost
    FROM t_billinginformation b JOIN t_orders od ON od.OrderId = b.BillNumber
    GROUP BY 1
),
bill_mean AS (
    SELECT avg(total) AS mean_cost FROM (
        SELECT BillNumber, sum(IncludedData + DataUsed + BalancedData) AS total FROM t_billinginformation GROUP BY 1
    ) q
)
SELECT cu.CustomerId, cu.CustomerName, od.OrderId, od.OrderType, od.OrderStatus, pc.TotalCost
FROM per_customer pc
JOIN t_customer cu ON cu.CustomerId = pc.cust
JOIN t_orders od ON od.OrderCustomerId = cu.CustomerId
CROSS JOIN bill_mean
WHERE pc.TotalCost > bill_mean.mean_cost
"""

SQL["req2_01"] = f"""
WITH staff AS (
    SELECT emp.EmployeeId, emp.Employee_Name, dep.DepartmentName, loc.LocationName, emp.Salary AS CurrentSalary,
           CASE WHEN hist.Salary IS NULL OR emp.Salary = hist.Salary THEN '{TREND_SAME}'
                WHEN emp.Salary > hist.Salary THEN '{TREND_UP}' ELSE '{TREND_DOWN}' END AS SalaryTrend
    FROM t_employeeworklocation lnk
    JOIN t_employee emp ON emp.EmployeeId = lnk.WorkEmployeeId
    JOIN t_department dep ON dep.DepartmentId = emp.DepartmentId
    JOIN t_worklocation loc ON loc.LocationId = lnk.LocationId
    LEFT JOIN t_salary hist ON hist.EmployeeId = emp.EmployeeId
),
means AS (
    SELECT *, avg(CurrentSalary) OVER (PARTITION BY DepartmentName) AS dep_mean,
              avg(CurrentSalary) OVER (PARTITION BY LocationName) AS loc_mean
    FROM staff
)
SELECT EmployeeId, Employee_Name, DepartmentName, LocationName, CurrentSalary, SalaryTrend,
       round(dep_mean, 4) AS AvgDepartmentSalary, round(loc_mean, 4) AS AvgLocationSalary,
       CASE WHEN CurrentSalary > dep_mean THEN '{CMP_ABOVE}' WHEN CurrentSalary < dep_mean THEN '{CMP_BELOW}' ELSE '{CMP_EQUAL}' END
           AS DepartmentSalaryComparison,
       CASE WHEN CurrentSalary > loc_mean THEN '{CMP_ABOVE}' WHEN CurrentSalary < loc_mean THEN '{CMP_BELOW}' ELSE '{CMP_EQUAL}' END
           AS LocationSalaryComparison
FROM means
"""

SQL["req2_02"] = """
WITH gb_plans AS (
    SELECT cu.CustomerId, cu.CustomerName, pl.PlansType, pl.PlanName
    FROM t_simdata s
    JOIN t_customer cu ON cu.CustomerId = s.SimCustomerId
    JOIN t_plans pl ON pl.PlansId = s.SimPlanNumber
    JOIN t_planinclusions pin ON pin.PlanId = pl.PlanInclusionId
    WHERE contains(pin.Data, 'GB')
      AND TRY_CAST(CASE WHEN strpos(pin.Data, ' ') > 1 THEN substr(pin.Data, 1, strpos(pin.Data, ' ') - 1) ELSE pin.Data END
                   AS DECIMAL(18,0)) >= 1.5
)
SELECT g.CustomerName, g.PlansType, g.PlanName,
       CAST(sum(date_diff('second', cl.CallStartTime, cl.CallEndTime)) AS BIGINT) AS TotalCallDurationSeconds
FROM gb_plans g
JOIN t_simdata s2 ON s2.SimCustomerId = g.CustomerId
JOIN t_phonenumber ph ON ph.AccountNumber = s2.SimAccountNumber
JOIN t_callrecords cl ON cl.CallAccountNumber = ph.AccountNumber
GROUP BY 1, 2, 3
"""

SQL["req2_03"] = """
SELECT sp.SalesPersonId, emp.Employee_Name AS SalespersonName, count(DISTINCT cu.CustomerId) AS TotalCustomers,
       round(avg(emp.Salary), 4) AS AverageSalary,
       (SELECT count(DISTINCT od.OrderId) FROM t_orders od JOIN t_customer c2 ON c2.CustomerId = od.OrderCustomerId
         WHERE c2.CustomerSalesPersonId = sp.SalesPersonId) AS TotalOrders,
       (SELECT min(loc.LocationName) FROM t_employeeworklocation lnk JOIN t_worklocation loc ON loc.LocationId = lnk.LocationId
         WHERE lnk.WorkEmployeeId = sp.IdEmployeeSalesPerson) AS PrimaryWorkLocation
FROM t_customer cu
JOIN t_salesperson sp ON sp.SalesPersonId = cu.CustomerSalesPersonId
JOIN t_employee emp ON emp.EmployeeId = sp.IdEmployeeSalesPerson
GROUP BY sp.SalesPersonId, sp.IdEmployeeSalesPerson, emp.Employee_Name, emp.Salary
HAVING count(DISTINCT cu.CustomerId) > 3
"""

SQL["req2_04"] = f"""
WITH per_sim AS (
    SELECT cu.CustomerId, cu.CustomerName, s.SimNumber, pl.PlanName, pin.Data AS PlanData, pin.Talktime AS PlanTalktime,
           count(cl.CallId) AS TotalCalls,
           CAST(sum(date_diff('second', cl.CallStartTime, cl.CallEndTime)) AS BIGINT) AS TotalCallDurationSeconds,
           round(avg(date_diff('second', cl.CallStartTime, cl.CallEndTime)), 4) AS AvgCallDurationSeconds
    FROM t_simdata s
    JOIN t_customer cu ON cu.CustomerId = s.SimCustomerId
    JOIN t_plans pl ON pl.PlansId = s.SimPlanNumber
    JOIN t_planinclusions pin ON pin.PlanId = pl.PlanInclusionId
    JOIN t_phonenumber ph ON ph.AccountNumber = s.SimAccountNumber
    LEFT JOIN t_callrecords cl ON cl.CallAccountNumber = ph.AccountNumber
    GROUP BY 1, 2, 3, 4, 5, 6
),
top_sim AS (
    SELECT * FROM per_sim QUALIFY row_number() OVER (PARTITION BY CustomerId ORDER BY TotalCalls DESC, SimNumber) = 1
),
billed AS (
    SELECT t.*, b.IncludedData, b.DataUsed, b.BalancedData, b.Tax
    FROM top_sim t
    JOIN t_phonenumber ph ON ph.PhoneNumber = t.SimNumber
    JOIN t_billinginformation b ON b.BillNumber = ph.PhoneBillNumber
)
SELECT *,
       CASE WHEN 60 * TRY_CAST(split_part(PlanTalktime, ' ', 1) AS BIGINT) < TotalCallDurationSeconds
            THEN '{EXCEEDING}' ELSE '{WITHIN_LIMIT}' END AS TalktimeStatus,
       CASE WHEN DataUsed > IncludedData THEN '{EXCEEDING}' ELSE '{WITHIN_LIMIT}' END AS DataUsageStatus,
       CAST(dense_rank() OVER (ORDER BY TotalCalls DESC NULLS LAST) AS BIGINT) AS CallFrequencyRank,
       CAST(dense_rank() OVER (ORDER BY DataUsed DESC NULLS LAST) AS BIGINT) AS DataUsageRank
FROM billed
"""

SQL["req2_05"] = """
WITH RECURSIVE chain AS (
    SELECT e.EmployeeId, e.Employee_Name, e.DepartmentId, d.DepartmentName, e.Salary,
           left(e.Employee_Name, 255) AS HierarchyPath, 0 AS Level
    FROM t_employee e JOIN t_department d ON d.DepartmentId = e.DepartmentId
    WHERE e.EmployeeId NOT IN (SELECT IdEmployeeSalesPerson FROM t_salesperson)
    UNION ALL
    SELECT e.EmployeeId, e.Employee_Name, e.DepartmentId, d.DepartmentName, e.Salary,
           left(up.HierarchyPath || ' > ' || e.Employee_Name, 255), up.Level + 1
    FROM chain up
    JOIN t_salesperson sp ON sp.SalesPersonId = up.EmployeeId
    JOIN t_employee e ON e.EmployeeId = sp.IdEmployeeSalesPerson
    JOIN t_department d ON d.DepartmentId = e.DepartmentId
    WHERE e.EmployeeId <> up.EmployeeId
)
SELECT ch.EmployeeId, ch.Employee_Name, ch.DepartmentId, ch.DepartmentName, ch.Salary, ch.HierarchyPath, ch.Level,
       loc.LocationName, count(cu.CustomerId) AS ManagedCustomers, round(avg(CAST(cu.Age AS DOUBLE)), 4) AS AvgCustomerAge
FROM chain ch
LEFT JOIN t_employeeworklocation lnk ON lnk.WorkEmployeeId = ch.EmployeeId
LEFT JOIN t_worklocation loc ON loc.LocationId = lnk.LocationId
LEFT JOIN t_salesperson sp ON sp.IdEmployeeSalesPerson = ch.EmployeeId
LEFT JOIN t_customer cu ON cu.CustomerSalesPersonId = sp.SalesPersonId
GROUP BY ALL
"""

SQL["req2_07"] = f"""
WITH long_form AS (
    UNPIVOT (
        SELECT pl.PlansId, pl.PlansType, pl.PlanName, pin.Data, pin.Talktime, pin.TextMessages
        FROM t_plans pl JOIN t_planinclusions pin ON pin.PlanId = pl.PlanInclusionId
    ) ON Data, Talktime, TextMessages INTO NAME InclusionType VALUE InclusionValue
),
wide AS (
    PIVOT long_form ON InclusionType IN ('Data', 'Talktime', 'TextMessages') USING max(InclusionValue)
    GROUP BY PlansId, PlansType, PlanName
)
SELECT w.PlansId, w.PlansType, w.PlanName, w.Data, w.Talktime, w.TextMessages,
       count(DISTINCT s.SimCustomerId) AS TotalCustomers,
       round(avg({_years('cu.DateOfBirth')}), 4) AS AvgCustomerAge,
       CAST(count(*) FILTER (WHERE od.OrderStatus = '{SHIPPED}') AS BIGINT) AS TotalShippedOrders,
       round(avg(b.DataUsed), 4) AS AvgDataUsed,
       round(avg(b.Tax), 4) AS AvgTax
FROM wide w
LEFT JOIN t_simdata s ON s.SimPlanNumber = w.PlansId
LEFT JOIN t_customer cu ON cu.CustomerId = s.SimCustomerId
LEFT JOIN t_orders od ON od.OrderCustomerId = cu.CustomerId
LEFT JOIN t_phonenumber ph ON ph.AccountNumber = s.SimAccountNumber
LEFT JOIN t_billinginformation b ON b.BillNumber = ph.PhoneBillNumber
GROUP BY 1, 2, 3, 4, 5, 6
"""

SQL["req2_08"] = """
WITH busiest AS (
    SELECT SimCustomerId FROM t_simdata GROUP BY 1 ORDER BY count(*) DESC, SimCustomerId LIMIT 5
),
mean_call AS (SELECT avg(date_diff('second', CallStartTime, CallEndTime)) AS secs FROM t_callrecords)
SELECT cu.CustomerId, cu.CustomerName, s.SimNumber, pl.PlanName, b.IncludedData, b.DataUsed,
       round((SELECT avg(b2.DataUsed) FROM t_billinginformation b2
              WHERE b2.BillNumber IN (SELECT ph2.PhoneBillNumber FROM t_phonenumber ph2
                                      JOIN t_simdata s2 ON s2.SimAccountNumber = ph2.AccountNumber
                                      WHERE s2.SimCustomerId = cu.CustomerId)), 4) AS AvgDataUsed,
       (SELECT count(*) FROM t_callrecords cl JOIN t_phonenumber ph3 ON ph3.AccountNumber = cl.CallAccountNumber
         WHERE ph3.AccountNumber = s.SimAccountNumber
           AND date_diff('second', cl.CallStartTime, cl.CallEndTime) > (SELECT secs FROM mean_call)) AS LongCalls,
       (SELECT arg_max(od.OrderStatus, od.OrderId) FROM t_orders od WHERE od.OrderCustomerId = cu.CustomerId) AS LatestOrderStatus
FROM t_simdata s
JOIN t_customer cu ON cu.CustomerId = s.SimCustomerId
JOIN t_plans pl ON pl.PlansId = s.SimPlanNumber
JOIN t_phonenumber ph ON ph.AccountNumber = s.SimAccountNumber
JOIN t_billinginformation b ON b.BillNumber = ph.PhoneBillNumber
WHERE cu.CustomerId IN (SELECT SimCustomerId FROM busiest)
  AND b.DataUsed > (SELECT avg(DataUsed) FROM t_billinginformation)
"""


def oracle(name: str) -> str:
    return with_entities(SQL[name])
