"""Twins of the model tables, measures, report queries, scenario sweep and pages."""

from __future__ import annotations

import re

from forecourt.operators.measures import CATALOGUE, KPI_VECTOR, MEASURES, REPORTS
from forecourt.oracle.base import big, build, day, flag, half_up, instant, money, percent, ratio, ymd
from forecourt.oracle.checks import EXTRA
from forecourt.plans import pages


def fraction(n: str, d: str) -> str:
    """n / d rounded to 8 decimals; both in the same units."""
    return f"({half_up(f'100000000 * ({n})', d)}::DOUBLE / 100000000)"


def per_unit(n_cents: str, d: str) -> str:
    return f"({half_up(f'1000000 * ({n_cents})', d)}::DOUBLE / 100000000)"


YM = "strftime({}, '%Y-%m')"
CTX = {
    **EXTRA,
    "cal": "\n  SELECT unnest(generate_series(a, b - INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d FROM years",
    "done": "\n  SELECT *, completed_at::DATE AS done_d FROM vd WHERE order_status = 'Completed'",
    "now_stock": "\n  SELECT * FROM idt WHERE snap = (SELECT max(snap) FROM idt)",
    "touch": "\n  SELECT customer_key, sum(b)::BIGINT AS b, sum(s)::BIGINT AS s FROM ("
             "SELECT customer_key, count(DISTINCT sale_id) AS b, 0 AS s FROM sd WHERE sale_status = 'Completed' GROUP BY 1 "
             "UNION ALL SELECT customer_key, 0, count(DISTINCT service_order_id) FROM done GROUP BY 1) GROUP BY 1",
}


def _q(sql: str) -> str:
    return build(sql.strip(), CTX)


VERSION = "'1900-01-01' AS effective_from, '9999-12-31' AS effective_to, 'true' AS is_current"
CALENDAR = f"""
SELECT {ymd('d')} AS date_key, {day('d')} AS full_date, {big('year(d)')} AS calendar_year,
  {big('month(d)')} AS month_number, monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month,
  {big('year(d) * 100 + month(d)')} AS year_month_sort, {big('quarter(d)')} AS quarter_number,
  {big('isoyear(d)')} AS iso_year, {big('week(d)')} AS iso_week FROM cal"""


def _staff(role: str) -> str:
    return _q(f"""SELECT employee_key, employee_id, first_name || ' ' || last_name AS employee_name, role,
  employment_status, {day('hire_date')} AS hire_date, {VERSION} FROM people WHERE role = '{role}'""")


TABLES = {
    "mdl_01_dim_date": _q(CALENDAR),
    "mdl_02_dim_snapshot_date": _q(CALENDAR),
    "mdl_03_dim_customer": _q(f"""SELECT customer_key, customer_id, customer_type, city, state, postal_code,
  {day('customer_since_date')} AS customer_since_date, {VERSION} FROM buyers"""),
    "mdl_04_dim_vehicle": _q(f"""SELECT vehicle_key, vehicle_id, brand, model, {big('model_year')} AS model_year,
  vehicle_type, fuel_type, vehicle_condition, color FROM cars"""),
    "mdl_05_dim_dealership": _q(f"""SELECT dealership_key, dealership_id, dealership_name, city, state, region,
  postal_code, {day('opened_date')} AS opened_date FROM dealers"""),
    "mdl_06_dim_service": _q("SELECT service_key, service_type, service_category, 'true' AS is_active FROM kinds"),
    "mdl_07_dim_salesperson": _staff("Sales Consultant"),
    "mdl_08_dim_service_advisor": _staff("Service Advisor"),
    "mdl_09_dim_technician": _staff("Service Technician"),
    "mdl_10_fact_sales": _q(f"""SELECT sale_no AS sales_key, sale_id, {ymd('sale_date')} AS sale_date_key, customer_key,
  vehicle_key, dealership_key, salesperson_key, sales_channel, payment_type, sale_status, {big('units')} AS units_sold,
  {money('list_c')} AS list_price, {money('discount_c')} AS discount_amount, {money('rev_c')} AS revenue,
  {money('cost_c')} AS vehicle_cost, {money('gp_c')} AS gross_profit FROM sd"""),
    "mdl_11_fact_inventory": _q(f"""SELECT
  (substr(inventory_id, 4)::HUGEINT * 100000000 + snap)::DOUBLE AS inventory_key, inventory_id,
  snap AS snapshot_date_key, vehicle_key, dealership_key, {day('acquired_date')} AS acquired_date,
  {ymd('acquired_date')} AS acquired_date_key, inventory_status, {big('units')} AS inventory_units,
  {money('value_c')} AS inventory_value, {big('days')} AS days_in_inventory, bucket AS aging_bucket,
  {big('bucket_no')} AS aging_bucket_sort, {flag('slow')} AS is_slow_moving FROM idt"""),
    "mdl_12_fact_service": _q(f"""SELECT appointment_id, {ymd('appointment_date')} AS appointment_date_key, customer_key,
  vehicle_key, dealership_key, service_advisor_key, technician_key, service_key, service_order_id, appointment_status,
  1::BIGINT AS appointment_count, {big('done')} AS completed_appointment_count, {big('cancelled')} AS cancellation_count,
  {big('missed')} AS no_show_count, {big('eligible')} AS completion_eligible_count,
  CASE WHEN service_order_id IS NOT NULL THEN 1::BIGINT END AS repair_order_quantity, payer_type,
  {instant('opened_at')} AS opened_at, {instant('promised_at')} AS promised_at, {instant('completed_at')} AS completed_at,
  {ymd('opened_at')} AS opened_date_key, {ymd('promised_at')} AS promised_date_key,
  {ymd('completed_at')} AS completed_date_key, {flag('on_time')} AS completed_on_time,
  {money('hours_c')} AS turnaround_hours, {money('labor_c')} AS labor_revenue, {money('parts_c')} AS parts_revenue,
  {money('discount_c')} AS discount_amount, {money('revenue_c')} AS service_revenue, NULL::DOUBLE AS service_cost,
  NULL::DOUBLE AS service_profit, 'false' AS service_cost_available, order_status FROM vd"""),
}

# -- measures: each as one scalar expression over the unfiltered model ------------------
SALE_EXPR = {
    "revenue": money("coalesce(sum(rev_c), 0)"), "units_sold": big("coalesce(sum(units), 0)"),
    "asp": per_unit("sum(rev_c)", "sum(units)"), "gross_profit": money("coalesce(sum(gp_c), 0)"),
    "gross_margin": fraction("sum(gp_c)", "sum(rev_c)"),
}
STOCK_EXPR = {
    "inventory_units": big("coalesce(sum(units), 0)"), "inventory_value": money("coalesce(sum(value_c), 0)"),
    "average_days_in_inventory": fraction("sum(days * units)", "sum(units)"),
    "slow_moving_vehicles": "count(DISTINCT vehicle_key) FILTER (days > 90)",
}
ORDER_EXPR = {
    "service_revenue": money("coalesce(sum(revenue_c), 0)"), "service_orders": "count(DISTINCT service_order_id)",
    "average_repair_order": per_unit("sum(revenue_c)", "count(DISTINCT service_order_id)"),
}
VISIT_EXPR = {"completion_rate": fraction("sum(done)", "sum(eligible)")}
TOUCH_EXPR = {
    "qualifying_interactions": big("coalesce(sum(b + s), 0)"),
    "qualifying_customers": "count(*) FILTER (b + s >= 1)",
    "repeat_customers": "count(*) FILTER (b + s >= 2)",
    "repeat_rate": fraction("count(*) FILTER (b + s >= 2)", "count(*) FILTER (b + s >= 1)"),
    "customers_with_sales": "count(*) FILTER (b > 0)", "customers_with_service": "count(*) FILTER (s > 0)",
    "sales_and_service_customers": "count(*) FILTER (b > 0 AND s > 0)",
    "service_frequency": fraction("sum(s)", "count(*) FILTER (s > 0)"),
}
ALIASES = {
    "executive_inventory_value": "inventory_value", "executive_inventory_units": "inventory_units",
    "as_of_inventory_value": "inventory_value", "as_of_inventory_units": "inventory_units",
    "as_of_average_days_in_inventory": "average_days_in_inventory",
    "as_of_slow_moving_vehicles": "slow_moving_vehicles",
}


def scalar(name: str) -> str:
    name = ALIASES.get(name, name)
    for expressions, source in ((SALE_EXPR, "sd"), (STOCK_EXPR, "now_stock"), (ORDER_EXPR, "done"),
                                (VISIT_EXPR, "vd"), (TOUCH_EXPR, "touch")):
        if name in expressions:
            return f"(SELECT {expressions[name]} FROM {source})"
    if name == "customers":
        return "(SELECT count(DISTINCT customer_id) FROM buyers)"
    return f"({money('(SELECT coalesce(sum(rev_c), 0) FROM sd) + (SELECT coalesce(sum(revenue_c), 0) FROM done)')})"


def _cards(names) -> str:
    return _q("SELECT " + ",\n  ".join(f"{scalar(n)} AS {n}" for n in names))


def _month_report(out: str) -> str:
    return _q(f"""SELECT m AS year_month, {out} FROM (SELECT DISTINCT strftime(d, '%Y-%m') AS m FROM cal)
LEFT JOIN (SELECT strftime(sale_date, '%Y-%m') AS m, sum(rev_c) AS r, sum(units) AS u, sum(gp_c) AS g FROM sd GROUP BY 1)
  USING (m)
LEFT JOIN (SELECT strftime(done_d, '%Y-%m') AS m, sum(revenue_c) AS sr, count(DISTINCT service_order_id) AS so
  FROM done GROUP BY 1) USING (m)""")


def _customer_report(keys: str, columns: str) -> str:
    """Per-customer numbers grouped by customer labels (alias p)."""
    return _q(f"""SELECT {keys}, {columns} FROM (
  SELECT customer_type, state AS customer_state, customer_id, coalesce(b, 0) AS b, coalesce(s, 0) AS s,
    coalesce(rv, 0) AS rv, coalesce(sv, 0) AS sv FROM buyers LEFT JOIN touch USING (customer_key)
  LEFT JOIN (SELECT customer_key, sum(rev_c) AS rv FROM sd GROUP BY 1) USING (customer_key)
  LEFT JOIN (SELECT customer_key, sum(revenue_c) AS sv FROM done GROUP BY 1) USING (customer_key)) GROUP BY {keys}""")


CLV = f"{money('sum(rv) + sum(sv)')} AS customer_lifetime_value"
Z = "coalesce({}, 0)".format
REVENUE, UNITS, PROFIT = (f"{money(Z('r'))} AS revenue", f"{big(Z('u'))} AS units_sold", f"{money(Z('g'))} AS gross_profit")

GROUPED = {
    "gq_01_monthly_sales": _month_report(f"{REVENUE}, {PROFIT}"),
    "gq_02_monthly_service": _month_report(f"{money(Z('sr'))} AS service_revenue"),
    "gq_06_monthly_sales_units": _month_report(f"{UNITS}, {REVENUE}, {PROFIT}"),
    "gq_12_monthly_service_orders": _month_report(
        f"{money(Z('sr'))} AS service_revenue, {big(Z('so'))} AS service_orders"),
    "gq_03_brand_sales": _q(f"""SELECT brand, {REVENUE} FROM (SELECT DISTINCT brand FROM cars)
LEFT JOIN (SELECT brand, sum(rev_c) AS r FROM sd GROUP BY 1) USING (brand)"""),
    "gq_04_dealership_sales": _q(f"""SELECT dealership_name, {REVENUE} FROM (SELECT DISTINCT dealership_name FROM dealers)
LEFT JOIN (SELECT dealership_name, sum(rev_c) AS r FROM sd GROUP BY 1) USING (dealership_name)"""),
    "gq_05_inventory_age": _q(f"""SELECT aging_bucket, aging_bucket_sort, {big(Z('u'))} AS executive_inventory_units
FROM (SELECT DISTINCT bucket AS aging_bucket, bucket_no::BIGINT AS aging_bucket_sort FROM idt)
LEFT JOIN (SELECT bucket AS aging_bucket, sum(units) AS u FROM now_stock GROUP BY 1) USING (aging_bucket)"""),
    "gq_07_salesperson_performance": _q(f"""SELECT salesperson, {REVENUE}, {fraction('g', 'r')} AS gross_margin
FROM (SELECT DISTINCT first_name || ' ' || last_name AS salesperson FROM people WHERE role = 'Sales Consultant')
LEFT JOIN (SELECT salesperson_name AS salesperson, sum(rev_c) AS r, sum(gp_c) AS g FROM sd GROUP BY 1)
  USING (salesperson)"""),
    "gq_08_model_performance": _q(f"""SELECT model, {REVENUE}, {UNITS}, {per_unit('r', 'u')} AS asp
FROM (SELECT DISTINCT model FROM cars)
LEFT JOIN (SELECT model, sum(rev_c) AS r, sum(units) AS u FROM sd GROUP BY 1) USING (model)"""),
    "gq_09_inventory_aging": _q(f"""SELECT aging_bucket, aging_bucket_sort, {big(Z('u'))} AS as_of_inventory_units,
  {money(Z('v'))} AS as_of_inventory_value
FROM (SELECT DISTINCT bucket AS aging_bucket, bucket_no::BIGINT AS aging_bucket_sort FROM idt)
LEFT JOIN (SELECT bucket AS aging_bucket, sum(units) AS u, sum(value_c) AS v FROM now_stock GROUP BY 1)
  USING (aging_bucket)"""),
    "gq_10_inventory_by_model": _q(f"""SELECT model, {money(Z('v'))} AS as_of_inventory_value,
  {fraction('a', 'u')} AS as_of_average_days_in_inventory FROM (SELECT DISTINCT model FROM cars)
LEFT JOIN (SELECT model, sum(units) AS u, sum(value_c) AS v, sum(days * units) AS a FROM now_stock GROUP BY 1)
  USING (model)"""),
    "gq_11_vehicle_model_matrix": _q(f"""SELECT brand, model, vehicle_type, {UNITS}, {REVENUE}, {PROFIT},
  {big(Z('iu'))} AS as_of_inventory_units, {big(Z('slow_n'))} AS as_of_slow_moving_vehicles
FROM (SELECT DISTINCT brand, model, vehicle_type FROM cars)
LEFT JOIN (SELECT brand, model, vehicle_type, sum(rev_c) AS r, sum(units) AS u, sum(gp_c) AS g FROM sd GROUP BY ALL)
  USING (brand, model, vehicle_type)
LEFT JOIN (SELECT brand, model, vehicle_type, sum(units) AS iu, count(DISTINCT vehicle_key) FILTER (slow) AS slow_n
  FROM now_stock GROUP BY ALL) USING (brand, model, vehicle_type)"""),
    "gq_13_technician_performance": _q(f"""SELECT technician, {money('sum(coalesce(r, 0))')} AS service_revenue,
  {big('sum(coalesce(n, 0))')} AS service_orders, {fraction('sum(c)', 'sum(e)')} AS completion_rate FROM (
  SELECT first_name || ' ' || last_name AS technician, NULL::BIGINT AS r, NULL::BIGINT AS n, NULL::BIGINT AS c,
    NULL::BIGINT AS e FROM people WHERE role = 'Service Technician'
  UNION ALL SELECT technician_name, sum(revenue_c), count(DISTINCT service_order_id), NULL, NULL FROM done GROUP BY 1
  UNION ALL SELECT technician_name, NULL, NULL, sum(done), sum(eligible) FROM vd GROUP BY 1) GROUP BY 1"""),
    "gq_14_service_type_performance": _q(f"""SELECT service_type, {money(Z('r'))} AS service_revenue,
  {big(Z('n'))} AS service_orders, {per_unit('r', 'n')} AS average_repair_order FROM kinds
LEFT JOIN (SELECT service_type, sum(revenue_c) AS r, count(DISTINCT service_order_id) AS n FROM done GROUP BY 1)
  USING (service_type)"""),
    "gq_15_customer_value_by_type": _customer_report(
        "customer_type", f"{CLV}, {TOUCH_EXPR['repeat_customers']} AS repeat_customers"),
    "gq_16_state_repeat_rate": _customer_report(
        "customer_state", f"{TOUCH_EXPR['repeat_rate']} AS repeat_rate, {TOUCH_EXPR['service_frequency']} AS service_frequency"),
    "gq_17_customer_matrix": _customer_report(
        "customer_type, customer_state",
        f"count(DISTINCT customer_id) AS customers, {TOUCH_EXPR['repeat_customers']} AS repeat_customers, "
        f"{TOUCH_EXPR['sales_and_service_customers']} AS sales_and_service_customers, "
        f"{TOUCH_EXPR['service_frequency']} AS service_frequency, {CLV}"),
    "gq_18_drill_through": _q(f"""SELECT brand, model, {big('model_year')} AS model_year, vehicle_type, aging_bucket,
  {UNITS}, {REVENUE}, {PROFIT}, {big(Z('iu'))} AS as_of_inventory_units, {money(Z('iv'))} AS as_of_inventory_value,
  {fraction('ia', 'iu')} AS as_of_average_days_in_inventory
FROM (SELECT DISTINCT brand, model, model_year, vehicle_type FROM cars)
CROSS JOIN (SELECT DISTINCT bucket AS aging_bucket FROM idt)
LEFT JOIN (SELECT brand, model, model_year, vehicle_type, sum(rev_c) AS r, sum(units) AS u, sum(gp_c) AS g
  FROM sd GROUP BY ALL) USING (brand, model, model_year, vehicle_type)
LEFT JOIN (SELECT brand, model, model_year, vehicle_type, bucket AS aging_bucket, sum(units) AS iu, sum(value_c) AS iv,
  sum(days * units) AS ia FROM now_stock GROUP BY ALL) USING (brand, model, model_year, vehicle_type, aging_bucket)"""),
}

SNAPSHOT = "(SELECT max(snapshot_date) FROM idt)"
SPECIAL = {
    "inventory_snapshot_key": f"{ymd(SNAPSHOT)}",
    "executive_snapshot_date": day(SNAPSHOT),
    "as_of_snapshot_date": day(SNAPSHOT),
    **{f"selected_{c}": f"(SELECT CASE count(DISTINCT {c}) WHEN 1 THEN min({c}) ELSE '{label}' END FROM cars)"
       for c, label in (("brand", "All Brands"), ("model", "All Models"), ("vehicle_type", "All Vehicle Types"))},
}

# -- scenario sweep: each family of scenarios as one grouped query ------------------------
SLICES = (("dealership_key", "dealer_", "dealers"), ("brand", "brand_", "cars"), ("vehicle_type", "type_", "cars"))


def _family(key: str, prefix: str, members: str) -> str:
    return f"""
  SELECT '{prefix}' || {key}::VARCHAR AS scenario, r, u, g, sr, so, vc, ve, q, rp, iu, iv, ia, sl, true AS held, r AS hr, sr AS hs
  FROM (SELECT DISTINCT {key} FROM {members})
  LEFT JOIN (SELECT {key}, sum(rev_c) AS r, sum(units) AS u, sum(gp_c) AS g FROM sd GROUP BY 1) USING ({key})
  LEFT JOIN (SELECT {key}, sum(revenue_c) AS sr, count(DISTINCT service_order_id) AS so FROM done GROUP BY 1) USING ({key})
  LEFT JOIN (SELECT {key}, sum(done) AS vc, sum(eligible) AS ve FROM vd GROUP BY 1) USING ({key})
  LEFT JOIN (SELECT {key}, count(*) AS q, count(*) FILTER (n > 1) AS rp FROM (SELECT {key}, customer_key, count(*) AS n FROM (
    SELECT {key}, customer_key FROM sd WHERE sale_status = 'Completed' UNION ALL SELECT {key}, customer_key FROM done)
    GROUP BY 1, 2) GROUP BY 1) USING ({key})
  LEFT JOIN (SELECT {key}, sum(units) AS iu, sum(value_c) AS iv, sum(days * units) AS ia,
    count(DISTINCT vehicle_key) FILTER (slow) AS sl FROM now_stock GROUP BY 1) USING ({key})"""


CTX["service_months"] = "\n  SELECT DISTINCT date_trunc('month', completed_at)::DATE AS mo FROM fservice"
CTX["month_rows"] = """
  SELECT 'month_' || strftime(mo, '%Y%m') AS scenario, r, u, g, sr, so, vc, ve, q, rp, iu, iv, ia, sl, iu IS NOT NULL AS held,
    (SELECT sum(rev_c) FROM sd WHERE sale_date < mo + INTERVAL 1 MONTH) AS hr,
    (SELECT sum(revenue_c) FROM done WHERE done_d < mo + INTERVAL 1 MONTH) AS hs
  FROM service_months
  LEFT JOIN (SELECT date_trunc('month', sale_date)::DATE AS mo, sum(rev_c) AS r, sum(units) AS u, sum(gp_c) AS g
    FROM sd GROUP BY 1) USING (mo)
  LEFT JOIN (SELECT date_trunc('month', done_d)::DATE AS mo, sum(revenue_c) AS sr, count(DISTINCT service_order_id) AS so
    FROM done GROUP BY 1) USING (mo)
  LEFT JOIN (SELECT date_trunc('month', appointment_date)::DATE AS mo, sum(done) AS vc, sum(eligible) AS ve
    FROM vd GROUP BY 1) USING (mo)
  LEFT JOIN (SELECT mo, count(*) AS q, count(*) FILTER (n > 1) AS rp FROM (SELECT mo, customer_key, count(*) AS n FROM (
    SELECT date_trunc('month', sale_date)::DATE AS mo, customer_key FROM sd WHERE sale_status = 'Completed'
    UNION ALL SELECT date_trunc('month', done_d)::DATE, customer_key FROM done) GROUP BY 1, 2) GROUP BY 1) USING (mo)
  LEFT JOIN (SELECT mo, sum(units) AS iu, sum(value_c) AS iv, sum(days * units) AS ia,
    count(DISTINCT vehicle_key) FILTER (slow) AS sl
    FROM (SELECT mo, (SELECT max(snapshot_date) FROM idt WHERE snapshot_date < mo + INTERVAL 1 MONTH) AS last_d FROM service_months)
    JOIN idt ON snapshot_date = last_d GROUP BY 1) USING (mo)"""
_ALL = _family("one", "", "(SELECT 1 AS one)").replace("'' || one::VARCHAR", "'all'")
_ALL = re.sub(r"FROM (sd|done|vd|now_stock)\b", r"FROM (SELECT *, 1 AS one FROM \1)", _ALL)
_NOTHING = "SELECT '{}', " + ", ".join(["NULL"] * 13) + ", {}, NULL, NULL"
_SWEEP = "\n  UNION ALL ".join(
    [_ALL, *[_family(*f) for f in SLICES], "SELECT * FROM month_rows",
     _NOTHING.format("empty", "true"), _NOTHING.format("before_inventory", "false")])


def _held(expression: str) -> str:
    return f"CASE WHEN held THEN {expression} END"


SWEEP_SQL = _q(f"""SELECT scenario, {REVENUE}, {UNITS}, {per_unit('r', 'u')} AS asp, {PROFIT},
  {fraction('g', 'r')} AS gross_margin, {_held(big(Z('iu')))} AS inventory_units,
  {_held(money(Z('iv')))} AS inventory_value, {_held(fraction('ia', 'iu'))} AS average_days_in_inventory,
  {_held(big(Z('sl')))} AS slow_moving_vehicles, {money(Z('sr'))} AS service_revenue, {big(Z('so'))} AS service_orders,
  {per_unit('sr', 'so')} AS average_repair_order, {fraction('vc', 've')} AS completion_rate,
  (SELECT count(*) FROM buyers) AS customers, {big(Z('rp'))} AS repeat_customers, {fraction('rp', 'q')} AS repeat_rate,
  {money('coalesce(hr, 0) + coalesce(hs, 0)')} AS customer_lifetime_value FROM ({_SWEEP})""")

# One selection at a time: the scenario of the same name.
CONTEXTS = {
    "ctx_1_dealership": "dealer_3", "ctx_2_brand": "brand_Brand#2", "ctx_3_month": "month_202401",
    "ctx_4_unknown_brand": "empty", "ctx_5_before_first_snapshot": "before_inventory",
}

# -- pages ----------------------------------------------------------------------------------
SALE_PAGE = f"""sale_id, {day('sale_date')} AS sale_date, brand, model, dealership_id, dealership_name, salesperson_name,
  payment_type, sale_status, {big('units')} AS units_sold, {money('rev_c')} AS revenue, {money('gp_c')} AS gross_profit,
  {percent('gp_c', 'rev_c')} AS gross_margin_percent, {ratio('rev_c', 'units')} AS average_selling_price"""
STOCK_PAGE = f"""inventory_id, {day('snapshot_date')} AS snapshot_date, vehicle_id, brand, model, dealership_id,
  dealership_name, inventory_status, {big('units')} AS inventory_units, {money('value_c')} AS inventory_value,
  {big('days')} AS days_in_inventory, bucket AS aging_bucket, {flag('slow')} AS is_slow_moving"""
VISIT_PAGE = f"""appointment_id, {day('appointment_date')} AS appointment_date, appointment_time, dealership_id,
  dealership_name, service_type, appointment_status, service_order_id, technician_name,
  {flag('on_time')} AS completed_on_time, {money('hours_c')} AS turnaround_hours, {money('revenue_c')} AS service_revenue"""
BUYER_PAGE = f"""customer_id, first_name || ' ' || last_name AS customer_name, city, state, customer_type,
  {day('customer_since_date')} AS customer_since_date, {big('sales_n')} AS sales_transaction_count,
  {big('orders_n')} AS service_order_count, {money('value_c')} AS customer_revenue,
  {money('value_c')} AS customer_lifetime_value, relationship_segment, lifecycle_segment, activity_segment,
  service_frequency_segment"""


def _top(columns: str, table: str, order: str, limit: int, offset: int = 0, where: str = "true") -> str:
    inner = f"SELECT * FROM {table} WHERE {where} ORDER BY {order} LIMIT {limit} OFFSET {offset}"
    return _q(f"SELECT {columns} FROM ({inner})")


def _dealer_page(limit: int, offset: int = 0, where: str = "true") -> str:
    from forecourt.oracle.views import SQL as views

    card = views["v_rep_5_dealership_performance"]
    return (f"SELECT {', '.join(pages.DEALERSHIP_FIELDS)} FROM (\n{card}\n) WHERE {where} "
            f"ORDER BY total_revenue DESC, dealership_id LIMIT {limit} OFFSET {offset}")


SALES_WHERE = "sale_date BETWEEN DATE '1996-01-01' AND DATE '1999-06-30' AND payment_type = 'Cash' AND sale_status = 'Completed'"
VISIT_WHERE = "appointment_date >= DATE '2024-01-05' AND service_type = 'Repair' AND appointment_status = 'Completed'"
PAGES = {
    "pg_01_sales": _top(SALE_PAGE, "sd", "sale_date DESC, sale_id", 100),
    "pg_02_inventory": _top(STOCK_PAGE, "idt", "snapshot_date DESC, inventory_id", 100),
    "pg_03_service": _top(VISIT_PAGE, "vd", "appointment_date DESC, appointment_id", 100),
    "pg_04_customers": _top(BUYER_PAGE, "cd", "value_c DESC, customer_id", 100),
    "pg_05_dealerships": _dealer_page(100),
    "pg_06_sales_summary": _q(f"""SELECT count(*) AS sales_transactions, {big('coalesce(sum(units), 0)')} AS units_sold,
  {money('coalesce(sum(rev_c), 0)')} AS revenue, {money('coalesce(sum(gp_c), 0)')} AS gross_profit,
  {percent('sum(gp_c)', 'sum(rev_c)')} AS gross_margin_percent, {ratio('sum(rev_c)', 'sum(units)')} AS average_selling_price
FROM sd WHERE {SALES_WHERE}"""),
    "pg_07_sales_performance": _top(SALE_PAGE, "sd", "sale_date DESC, sale_id", 200, 50, SALES_WHERE),
    "pg_08_inventory_aging": _top(STOCK_PAGE, "idt", "snapshot_date DESC, days DESC, inventory_id", 500, 20,
                                  "snapshot_date >= DATE '1997-01-01' AND bucket = '91-120'"),
    "pg_09_inventory_slow_moving": _top(STOCK_PAGE, "idt", "days DESC, inventory_id, snapshot_date DESC", 300, 0,
                                        "slow AND brand = 'Brand#2'"),
    "pg_10_service_revenue": _q(f"""SELECT count(*) AS appointments, {big('coalesce(sum(done), 0)')} AS completed_appointments,
  count(service_order_id) AS repair_orders, {money('coalesce(sum(revenue_c), 0)')} AS service_revenue,
  {percent('sum(done)', 'sum(eligible)')} AS completion_rate_percent,
  {ratio('sum(revenue_c)', 'count(service_order_id)')} AS average_repair_order
FROM vd WHERE appointment_date >= DATE '2024-01-05' AND service_type = 'Repair'"""),
    "pg_11_service_performance": _top(VISIT_PAGE, "vd", "appointment_date DESC, appointment_id", 100, 10, VISIT_WHERE),
    "pg_12_customer_value": _top(BUYER_PAGE, "cd", "value_c DESC, customer_id", 100, 0,
                                 "relationship_segment = 'Sales + Service' AND value_c >= 10000000"),
    "pg_13_dealership_performance": _dealer_page(100, 0, "region = 'ASIA' AND total_revenue >= 0"),
    "pg_14_deep_page": _top(SALE_PAGE, "sd", "sale_date DESC, sale_id", 500, 12_000),
    "pg_15_after_page": _top(VISIT_PAGE, "vd", "appointment_date DESC, appointment_id", 200, 900),
}

SQL: dict[str, str] = {
    **TABLES,
    **{f"k_{n:02d}_{name}": _cards([name]) if name in MEASURES else _q(f"SELECT {SPECIAL[name]} AS {name}")
       for n, name in enumerate(CATALOGUE, start=1)},
    "k_all_kpis": _cards(KPI_VECTOR),
    "rc_alt_kpis": _cards(KPI_VECTOR),
    **GROUPED,
    **{name: _cards(names) for name, (by, names) in REPORTS.items() if not by},
    "rc_scn_scenarios": SWEEP_SQL,
    **{name: f"SELECT * EXCLUDE (scenario) FROM (\n{SWEEP_SQL}\n) WHERE scenario = '{scenario}'" for name, scenario in CONTEXTS.items()},
    **PAGES,
}
