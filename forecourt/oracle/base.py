"""Common table expressions over the parquet views, and small text helpers."""

from __future__ import annotations

import re


def tag(prefix: str, number: str, width: int = 6) -> str:
    text = f"({number})::VARCHAR"
    return f"('{prefix}' || lpad({text}, greatest({width}, length({text}))::INTEGER, '0'))"


def pick(values: tuple[str, ...], number: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[({number}) % {len(values)} + 1]"


def cents(expression: str) -> str:
    return f"(({expression})::DECIMAL(18,2) * 100)::BIGINT"


def half_up(n: str, d: str) -> str:
    """round(n / d) to an integer, ties away from zero, NULL on a zero denominator."""
    n, d = f"(({n})::HUGEINT)", f"(({d})::HUGEINT)"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE "
            f"sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))) END)")


def ratio(n_cents: str, d: str) -> str:
    """cents / units, as an amount with 2 decimals."""
    return f"({half_up(n_cents, d)}::DOUBLE / 100)"


def percent(n: str, d: str) -> str:
    return f"({half_up(f'10000 * ({n})', d)}::DOUBLE / 100)"


def money(expression: str) -> str:
    return f"(({expression})::DOUBLE / 100)"


def big(expression: str) -> str:
    return f"({expression})::BIGINT"


def day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def instant(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def flag(expression: str) -> str:
    return f"({expression})::BOOLEAN::VARCHAR"


def ymd(expression: str) -> str:
    return f"strftime({expression}, '%Y%m%d')::BIGINT"


N_PART = "(SELECT count(*) FROM part)"
N_SUPP = "(SELECT count(*) FROM supplier)"

CTES: dict[str, str] = {}

CTES["dealers"] = f"""
  SELECT s_suppkey AS dealership_key, {tag('DLR', 's_suppkey', 3)} AS dealership_id, s_name AS dealership_name,
         n_name AS city, n_name AS state, {tag('', 's_suppkey % 100000', 5)} AS postal_code, r_name AS region,
         (DATE '1990-01-01' + (s_suppkey % 1500)::INTEGER)::DATE AS opened_date
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey"""

CTES["people"] = f"""
  SELECT s_suppkey * 3 + n AS employee_key, {tag('EMP', 's_suppkey * 3 + n')} AS employee_id,
         s_suppkey AS dealership_key, {tag('DLR', 's_suppkey', 3)} AS dealership_id,
         ['Consultant', 'Advisor', 'Technician'][n + 1] AS first_name, s_name AS last_name,
         ['Sales Consultant', 'Service Advisor', 'Service Technician'][n + 1] AS role,
         (DATE '1990-01-01' + ((s_suppkey * 3 + n) % 1500)::INTEGER)::DATE AS hire_date,
         CASE WHEN (s_suppkey * 3 + n) % 17 = 0 THEN 'Inactive' ELSE 'Active' END AS employment_status
  FROM supplier, (SELECT unnest([0, 1, 2]) AS n)"""

CTES["buyers"] = f"""
  SELECT c_custkey AS customer_key, {tag('CUS', 'c_custkey')} AS customer_id, 'Customer' AS first_name,
         c_name AS last_name, 'customer' || {tag('', 'c_custkey')} || '@example.com' AS email,
         '555-' || {tag('', 'c_custkey % 10000', 4)} AS phone, n_name AS city, n_name AS state,
         {tag('', 'c_custkey % 100000', 5)} AS postal_code,
         (DATE '1990-01-01' + (c_custkey % 1500)::INTEGER)::DATE AS customer_since_date,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Business' WHEN 'MACHINERY' THEN 'Fleet' ELSE 'Individual' END
           AS customer_type
  FROM customer JOIN nation ON n_nationkey = c_nationkey"""

CTES["cars"] = f"""
  SELECT p_partkey AS vehicle_key, {tag('VEH', 'p_partkey')} AS vehicle_id,
         'SYN' || {tag('', 'p_partkey', 14)} AS vin, p_brand AS brand, p_name AS model,
         1990 + p_size % 6 AS model_year, p_type AS vehicle_type,
         {pick(('Gasoline', 'Hybrid', 'Electric', 'Diesel'), 'p_partkey')} AS fuel_type,
         {pick(('Black', 'White', 'Silver', 'Gray', 'Blue', 'Red', 'Green'), 'p_partkey')} AS color,
         CASE WHEN p_partkey % 3 = 0 THEN 'Used' ELSE 'New' END AS vehicle_condition,
         CASE WHEN p_partkey % 3 = 0 THEN 2000 + p_partkey * 37 % 108000 ELSE 0 END AS mileage,
         {cents('p_retailprice')} AS msrp
  FROM part"""

CTES["deals"] = f"""
  SELECT o_orderkey AS sale_no, {tag('SAL', 'o_orderkey')} AS sale_id, o_orderdate::DATE AS sale_date,
         o_custkey AS customer_key, o_orderkey % {N_PART} AS vehicle_key, o_orderkey % {N_SUPP} AS dealership_key,
         (o_orderkey % {N_SUPP}) * 3 AS salesperson_key,
         CASE left(o_orderpriority, 1) WHEN '1' THEN 'Fleet' WHEN '2' THEN 'Partner' WHEN '3' THEN 'Online'
           ELSE 'Showroom' END AS sales_channel,
         {cents('o_totalprice')} + o_orderkey % 5000 * 100 AS list_c, o_orderkey % 5000 * 100 AS discount_c,
         {cents('o_totalprice')} AS price_c, {cents('o_totalprice')} - o_orderkey % 900 * 100 AS cost_c,
         o_orderkey % 900 * 100 AS profit_c, {pick(('Finance', 'Cash', 'Lease'), 'o_orderkey')} AS payment_type,
         CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'Returned' WHEN 'O' THEN 'Cancelled' END
           AS sale_status,
         CASE o_orderstatus WHEN 'P' THEN -1 ELSE 1 END AS units
  FROM orders"""

CTES["stock"] = f"""
  SELECT {tag('INV', f'l_partkey * {N_SUPP} + l_suppkey')} AS inventory_id,
         l_partkey AS vehicle_key, l_suppkey AS dealership_key,
         make_date(year(l_shipdate), 12, 31) AS snapshot_date, min(l_shipdate::DATE) AS acquired_date,
         sum({cents('l_extendedprice')}) AS value_c, 1 AS units,
         date_diff('day', min(l_shipdate::DATE), make_date(year(l_shipdate), 12, 31)) AS days
  FROM lineitem GROUP BY l_partkey, l_suppkey, year(l_shipdate)"""

CTES["visits"] = f"""
  SELECT event_id AS visit_no, {tag('APT', 'event_id')} AS appointment_id, user_id AS customer_key,
         event_id % {N_PART} AS vehicle_key, event_id % {N_SUPP} AS dealership_key,
         (event_id % {N_SUPP}) * 3 + 1 AS service_advisor_key, ts::DATE AS appointment_date,
         strftime(ts, '%H:%M:%S') AS appointment_time,
         {pick(('Maintenance', 'Repair', 'Inspection', 'Recall', 'Tires'), 'event_id')} AS service_type,
         CASE event_type WHEN 'purchase' THEN 'Completed' WHEN 'click' THEN 'Completed' WHEN 'error' THEN 'Cancelled'
           WHEN 'signup' THEN 'No Show' WHEN 'view' THEN 'Scheduled' END AS appointment_status
  FROM events"""

CTES["jobs"] = f"""
  SELECT event_id AS visit_no, {tag('SRO', 'event_id')} AS service_order_id, user_id AS customer_key,
         event_id % {N_PART} AS vehicle_key, event_id % {N_SUPP} AS dealership_key,
         (event_id % {N_SUPP}) * 3 + 1 AS service_advisor_key, (event_id % {N_SUPP}) * 3 + 2 AS technician_key,
         ts AS opened_at, ts + to_hours((event_id % 47 + 2)::INTEGER) AS promised_at,
         ts + to_hours((event_id % 60 + 1)::INTEGER) AS completed_at,
         (event_id % 60 + 1) * 100 AS hours_c, event_id % 60 + 1 <= event_id % 47 + 2 AS on_time,
         CASE WHEN event_id % 40 = 0 THEN 'Reopened' ELSE 'Completed' END AS order_status,
         {pick(('Customer Pay', 'Warranty', 'Internal'), 'event_id')} AS payer_type,
         {cents('value')} AS labor_c, event_id % 700 * 100 AS parts_c, event_id % 5 * 100 AS discount_c,
         {cents('value')} + event_id % 700 * 100 - event_id % 5 * 100 AS revenue_c
  FROM events WHERE event_type IN ('purchase', 'click')"""

CTES["kinds"] = """
  SELECT DISTINCT service_type, -(('0x' || substr(md5(service_type), 1, 15))::BIGINT) - 1 AS service_key,
         CASE WHEN service_type IN ('Maintenance', 'Inspection') THEN 'Preventive'
              WHEN service_type = 'Tires' THEN 'Tire Services' ELSE 'Corrective' END AS service_category
  FROM visits"""

CTES["span"] = """
  SELECT min(d) AS lo, max(d) AS hi FROM (
    SELECT sale_date AS d FROM deals UNION ALL SELECT snapshot_date FROM stock
    UNION ALL SELECT acquired_date FROM stock UNION ALL SELECT appointment_date FROM visits
    UNION ALL SELECT opened_at::DATE FROM jobs UNION ALL SELECT completed_at::DATE FROM jobs
    UNION ALL SELECT customer_since_date FROM buyers UNION ALL SELECT hire_date FROM people
    UNION ALL SELECT opened_date FROM dealers)"""

CTES["days"] = """
  SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS full_date FROM span"""

# Facts whose lookups all resolve (customer, vehicle, dealership, employee in role at the same dealership).
CTES["fsales"] = """
  SELECT deals.* FROM deals JOIN buyers USING (customer_key) JOIN cars USING (vehicle_key)
  JOIN dealers USING (dealership_key)
  JOIN people ON employee_key = salesperson_key AND people.dealership_key = deals.dealership_key
   AND role = 'Sales Consultant'"""

CTES["fstock"] = """
  SELECT stock.* FROM stock JOIN cars USING (vehicle_key) JOIN dealers USING (dealership_key)"""

CTES["fservice"] = """
  SELECT jobs.*, v.appointment_id, kinds.service_type, kinds.service_key FROM jobs
  JOIN visits v ON v.visit_no = jobs.visit_no AND v.customer_key = jobs.customer_key
   AND v.vehicle_key = jobs.vehicle_key AND v.dealership_key = jobs.dealership_key
   AND v.service_advisor_key = jobs.service_advisor_key
  JOIN kinds ON kinds.service_type = v.service_type
  JOIN buyers ON buyers.customer_key = jobs.customer_key JOIN cars ON cars.vehicle_key = jobs.vehicle_key
  JOIN people a ON a.employee_key = jobs.service_advisor_key AND a.dealership_key = jobs.dealership_key
   AND a.role = 'Service Advisor'
  JOIN people t ON t.employee_key = jobs.technician_key AND t.dealership_key = jobs.dealership_key
   AND t.role = 'Service Technician'"""

# Canonical details.
CTES["sd"] = """
  SELECT f.sale_no, f.sale_id, sale_date, year(sale_date) AS y, quarter(sale_date) AS q, month(sale_date) AS m,
         monthname(sale_date) AS month_name, f.customer_key, f.vehicle_key, vehicle_id, vin, brand, model,
         model_year, vehicle_type, fuel_type, vehicle_condition, f.dealership_key, dealers.dealership_id,
         dealership_name, region, state, salesperson_key, employee_id AS salesperson_id,
         first_name || ' ' || last_name AS salesperson_name, sales_channel, payment_type, sale_status, units,
         list_c, discount_c, price_c * units AS rev_c, cost_c * units AS cost_c, profit_c * units AS gp_c
  FROM fsales f JOIN days ON full_date = sale_date JOIN cars USING (vehicle_key) JOIN dealers USING (dealership_key)
  JOIN people ON employee_key = salesperson_key
  WHERE sale_status <> 'Cancelled'"""

CTES["idt"] = """
  SELECT f.*, strftime(snapshot_date, '%Y%m%d')::BIGINT AS snap, vehicle_id, vin, brand, model, model_year,
         vehicle_type, fuel_type, vehicle_condition, dealership_id, dealership_name, region, state,
         'Available' AS inventory_status,
         CASE WHEN days BETWEEN 0 AND 30 THEN 1 WHEN days BETWEEN 31 AND 60 THEN 2 WHEN days BETWEEN 61 AND 90 THEN 3
              WHEN days BETWEEN 91 AND 120 THEN 4 ELSE 5 END AS bucket_no,
         ['0-30', '31-60', '61-90', '91-120', '120+'][bucket_no] AS bucket, days > 90 AS slow
  FROM fstock f JOIN days c ON c.full_date = snapshot_date JOIN cars USING (vehicle_key)
  JOIN dealers USING (dealership_key)"""

CTES["vd"] = """
  SELECT v.visit_no, v.appointment_id, v.appointment_date, year(v.appointment_date) AS y,
         quarter(v.appointment_date) AS q, month(v.appointment_date) AS m,
         monthname(v.appointment_date) AS month_name, appointment_time, v.customer_key, customer_id,
         v.vehicle_key, vehicle_id, vin, brand, model, model_year, vehicle_type, v.dealership_key,
         dealers.dealership_id, dealership_name, region, dealers.state, v.service_advisor_key,
         a.employee_id AS service_advisor_id, a.first_name || ' ' || a.last_name AS service_advisor_name,
         kinds.service_key, kinds.service_type, service_category, appointment_status,
         (appointment_status = 'Completed')::INTEGER AS done, (appointment_status = 'Cancelled')::INTEGER AS cancelled,
         (appointment_status = 'No Show')::INTEGER AS missed, (appointment_status <> 'Scheduled')::INTEGER AS eligible,
         o.service_order_id, o.technician_key, t.employee_id AS technician_id,
         t.first_name || ' ' || t.last_name AS technician_name, o.payer_type, o.opened_at, o.promised_at,
         o.completed_at, o.on_time, o.hours_c, coalesce(o.labor_c, 0) AS labor_c, coalesce(o.parts_c, 0) AS parts_c,
         coalesce(o.discount_c, 0) AS discount_c, coalesce(o.revenue_c, 0) AS revenue_c, o.order_status
  FROM visits v JOIN days ON full_date = v.appointment_date
  JOIN buyers ON buyers.customer_key = v.customer_key JOIN cars ON cars.vehicle_key = v.vehicle_key
  JOIN dealers ON dealers.dealership_key = v.dealership_key
  JOIN people a ON a.employee_key = v.service_advisor_key AND a.dealership_key = v.dealership_key
   AND a.role = 'Service Advisor'
  JOIN kinds ON kinds.service_type = v.service_type
  LEFT JOIN fservice o ON o.visit_no = v.visit_no LEFT JOIN people t ON t.employee_key = o.technician_key"""

CTES["buyer_sales"] = """
  SELECT customer_key, count(*) FILTER (sale_status = 'Completed') AS n, sum(units) AS units,
         sum(price_c * units) AS rev_c, min(CASE sale_status WHEN 'Completed' THEN sale_date END) AS first_d,
         max(CASE sale_status WHEN 'Completed' THEN sale_date END) AS last_d
  FROM fsales WHERE sale_status <> 'Cancelled' GROUP BY customer_key"""

CTES["buyer_service"] = """
  SELECT customer_key, count(*) AS n, sum(revenue_c) AS rev_c, min(completed_at::DATE) AS first_d,
         max(completed_at::DATE) AS last_d
  FROM fservice WHERE order_status = 'Completed' GROUP BY customer_key"""

CTES["today"] = """
  SELECT max(d) AS d FROM (SELECT max(sale_date) AS d FROM fsales WHERE sale_status <> 'Cancelled'
    UNION ALL SELECT max(completed_at::DATE) FROM fservice WHERE order_status = 'Completed')"""

CTES["cd"] = f"""
  SELECT b.*, today.d AS as_of, coalesce(s.n, 0) AS sales_n, coalesce(s.units, 0) AS net_units,
         coalesce(s.rev_c, 0) AS sales_c, s.first_d AS first_sale, s.last_d AS last_sale,
         coalesce(o.n, 0) AS orders_n, coalesce(o.rev_c, 0) AS service_c, o.first_d AS first_service,
         o.last_d AS last_service, coalesce(s.n, 0) + coalesce(o.n, 0) AS touches,
         least(s.first_d, o.first_d) AS first_act, greatest(s.last_d, o.last_d) AS last_act,
         coalesce(s.rev_c, 0) + coalesce(o.rev_c, 0) AS value_c,
         CASE WHEN s.n > 0 AND o.n > 0 THEN 'Sales + Service' WHEN s.n > 0 THEN 'Sales Only'
              WHEN o.n > 0 THEN 'Service Only' ELSE 'No Activity' END AS relationship_segment,
         ['Prospect', 'New Customer', 'Repeat Customer'][least(touches, 2) + 1] AS lifecycle_segment,
         CASE WHEN last_act IS NULL THEN 'Never Active' WHEN date_diff('day', last_act, as_of) > 365 THEN 'Inactive'
              ELSE 'Active' END AS activity_segment,
         CASE WHEN orders_n = 0 THEN 1 WHEN orders_n = 1 THEN 2 WHEN orders_n <= 3 THEN 3 WHEN orders_n <= 6 THEN 4
              ELSE 5 END AS freq_no,
         ['No Service', 'One-time Service', 'Occasional Service', 'Frequent Service', 'Loyal Service'][freq_no]
           AS service_frequency_segment,
         {half_up('orders_n * 36525 * 100',
                  "greatest(36525, 100 * (date_diff('day', coalesce(o.first_d, as_of), as_of) + 1))")} AS per_year_c,
         CASE WHEN orders_n > 1 THEN {half_up("100 * date_diff('day', o.first_d, o.last_d)", 'orders_n - 1')} END
           AS gap_c
  FROM today, buyers b LEFT JOIN buyer_sales s USING (customer_key)
  LEFT JOIN buyer_service o USING (customer_key)"""


def build(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix the SELECT with exactly the CTEs it reaches, in dependency order."""
    known = {**CTES, **(extra or {})}
    ordered: list[str] = []

    def visit(text: str) -> None:
        words = set(re.findall(r"\b(?:FROM|JOIN|,)\s+([a-z_0-9]+)", text))
        for name in known:
            if name in words and name not in ordered:
                visit(known[name])
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    clauses = ",\n".join(f"{name} AS ({known[name]}\n)" for name in ordered)
    return f"WITH {clauses}\n{sql}"
