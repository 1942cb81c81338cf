"""Twins of the quality checks and reconciliation suites."""

from __future__ import annotations

import re

from forecourt.operators import quality, reconcile
from forecourt.oracle.base import big, build
from forecourt.plans import inventory, sales, service


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _dups(table: str, keys: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING count(*) > 1))"


def _rows(table: str, condition: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {condition})"


def _null(*columns: str) -> str:
    return " OR ".join(f"{c} IS NULL" for c in columns)


def _absent(table: str, links: list[tuple[str, str, str]]) -> str:
    tests = " OR ".join(f"NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{column})" for column, dim, key in links)
    return f"(SELECT count(*) FROM {table} f WHERE {tests})"


PEOPLE = ("people", "employee_key")
DQ: dict[str, str] = {
    "dq_01": _dups("buyers", "customer_id"),
    "dq_02": f"{_dups('cars', 'vehicle_id')} + {_dups('cars', 'vin')}",
    "dq_03": _dups("people", "employee_id"),
    "dq_04": _dups("dealers", "dealership_id"),
    "dq_05": _dups("kinds", "service_type"),
    "dq_06": _dups("fsales", "sale_id"),
    "dq_07": _dups("fstock", "vehicle_key, dealership_key, snapshot_date"),
    "dq_08": f"{_dups('fservice', 'service_order_id')} + {_dups('fservice', 'appointment_id')}",
    "dq_09": _rows("fsales", _null("sale_date", "customer_key", "vehicle_key", "dealership_key", "salesperson_key")),
    "dq_10": _rows("fstock", _null("snapshot_date", "vehicle_key", "dealership_key")),
    "dq_11": _rows("fservice", _null("completed_at", "customer_key", "vehicle_key", "dealership_key",
                                     "service_advisor_key", "technician_key", "service_key")),
    "dq_12": _absent("people", [("dealership_key", "dealers", "dealership_key")]),
    "dq_13": _absent("fsales", [
        ("sale_date", "days", "full_date"), ("customer_key", "buyers", "customer_key"),
        ("vehicle_key", "cars", "vehicle_key"), ("dealership_key", "dealers", "dealership_key"),
        ("salesperson_key", *PEOPLE)]),
    "dq_14": _absent("fstock", [
        ("snapshot_date", "days", "full_date"), ("vehicle_key", "cars", "vehicle_key"),
        ("dealership_key", "dealers", "dealership_key")]),
    "dq_15": _absent("fservice", [
        ("completed_at::DATE", "days", "full_date"), ("customer_key", "buyers", "customer_key"),
        ("vehicle_key", "cars", "vehicle_key"), ("dealership_key", "dealers", "dealership_key"),
        ("service_advisor_key", *PEOPLE), ("technician_key", *PEOPLE), ("service_type", "kinds", "service_type")]),
    "dq_16": "(SELECT count(*) FROM fsales f JOIN people e ON e.employee_key = f.salesperson_key "
             "WHERE e.role <> 'Sales Consultant' OR e.dealership_key <> f.dealership_key)",
    "dq_17": "(SELECT count(*) FROM fservice f JOIN people a ON a.employee_key = f.service_advisor_key "
             "JOIN people t ON t.employee_key = f.technician_key WHERE (a.role, t.role, a.dealership_key, t.dealership_key) "
             "<> ('Service Advisor', 'Service Technician', f.dealership_key, f.dealership_key))",
    "dq_18": "(SELECT count(*) FROM jobs o JOIN visits v ON v.visit_no = o.visit_no WHERE "
             "(v.customer_key, v.vehicle_key, v.dealership_key, v.service_advisor_key) IS DISTINCT FROM "
             "(o.customer_key, o.vehicle_key, o.dealership_key, o.service_advisor_key))",
    "dq_19": _rows("fsales", "units IS DISTINCT FROM (CASE sale_status WHEN 'Returned' THEN -1 ELSE 1 END)"),
    "dq_20": f"{_rows('buyers', 'customer_since_date > current_date')} + {_rows('dealers', 'opened_date > current_date')}"
             f" + {_rows('people', 'hire_date > current_date')}",
    "dq_21": _rows("fsales", "sale_date > current_date"),
    "dq_22": _rows("fstock", "acquired_date > snapshot_date OR days <> date_diff('day', acquired_date, snapshot_date)"),
    "dq_23": _rows("fservice", "opened_at > promised_at OR opened_at > completed_at OR completed_at::DATE > current_date"),
    "dq_24": _rows("fsales", "least(list_c, discount_c, price_c, cost_c) < 0 OR discount_c > list_c OR "
                             "abs(list_c - discount_c - price_c) > 2 OR abs(price_c - cost_c - profit_c) > 2"),
    "dq_25": _rows("fstock", "value_c < 0 OR days < 0 OR units <> 1"),
    "dq_26": _rows("fservice", "least(labor_c, parts_c, discount_c) < 0 OR discount_c > labor_c + parts_c OR "
                               "abs(labor_c + parts_c - discount_c - revenue_c) > 2"),
    "dq_27": _rows("fsales", "price_c < 0"),
    "dq_28": _rows("fservice", "revenue_c < 0"),
}


# The faults of the star schema, written for the tables of the twins.
STAR_FAULTS: dict[str, str] = {
    "bad_fsales": """
  SELECT * REPLACE (
    CASE WHEN sale_no % 19 = 0 THEN NULL WHEN sale_no % 23 = 0 THEN -7 ELSE customer_key END AS customer_key,
    CASE WHEN sale_no % 29 = 1 THEN 'SAL-TWICE' ELSE sale_id END AS sale_id,
    CASE WHEN sale_no % 31 = 0 THEN -5 ELSE units END AS units,
    CASE WHEN sale_no % 37 = 0 THEN -500 ELSE price_c END AS price_c,
    CASE WHEN sale_no % 41 = 0 THEN dealership_key + 1 ELSE dealership_key END AS dealership_key,
    CASE WHEN sale_no % 43 = 0 THEN DATE '2999-01-01' ELSE sale_date END AS sale_date) FROM fsales""",
    "bad_fstock": """
  SELECT * REPLACE (
    CASE WHEN vehicle_key % 13 = 0 THEN NULL WHEN vehicle_key % 17 = 0 THEN -7 ELSE dealership_key END AS dealership_key,
    CASE WHEN vehicle_key % 19 = 0 THEN 1 ELSE vehicle_key END AS vehicle_key,
    CASE WHEN vehicle_key % 23 = 0 THEN days + 1 ELSE days END AS days,
    CASE WHEN vehicle_key % 29 = 0 THEN -100 ELSE value_c END AS value_c) FROM fstock""",
    "bad_fservice": """
  SELECT * REPLACE (
    CASE WHEN visit_no % 19 = 0 THEN NULL WHEN visit_no % 23 = 0 THEN -7 ELSE customer_key END AS customer_key,
    CASE WHEN visit_no % 29 = 0 THEN service_advisor_key ELSE technician_key END AS technician_key,
    CASE WHEN visit_no % 31 = 1 THEN 'APT-TWICE' ELSE appointment_id END AS appointment_id,
    CASE WHEN visit_no % 37 = 0 THEN opened_at + INTERVAL 4000 DAY ELSE opened_at END AS opened_at,
    CASE WHEN visit_no % 41 = 0 THEN -100 ELSE revenue_c END AS revenue_c) FROM fservice""",
    "bad_buyers": """
  SELECT * REPLACE (
    CASE WHEN customer_key % 31 = 1 THEN 'CUS-TWICE' ELSE customer_id END AS customer_id,
    CASE WHEN customer_key % 37 = 0 THEN DATE '2999-01-01' ELSE customer_since_date END AS customer_since_date) FROM buyers""",
    "bad_cars": "\n  SELECT * REPLACE (CASE WHEN vehicle_key % 31 = 0 THEN 'SAME' ELSE vin END AS vin) FROM cars",
    "bad_people": """
  SELECT * REPLACE (
    CASE WHEN employee_key % 7 = 0 THEN 'EMP-TWICE' ELSE employee_id END AS employee_id,
    CASE WHEN employee_key % 11 = 0 THEN 9999999 ELSE dealership_key END AS dealership_key) FROM people""",
    "bad_dealers": "\n  SELECT * REPLACE (CASE WHEN dealership_key % 3 = 0 THEN 'DLR-TWICE' ELSE dealership_id END AS dealership_id) FROM dealers",
    "bad_kinds": "\n  SELECT * FROM kinds UNION ALL SELECT * FROM kinds",
    "bad_days": "\n  SELECT full_date FROM days UNION ALL SELECT DATE '2999-01-01'",
    "bad_jobs": "\n  SELECT * REPLACE (CASE WHEN visit_no % 47 = 0 THEN -1 ELSE vehicle_key END AS vehicle_key) FROM jobs",
}


def broken(sql: str) -> str:
    """The same text over the faulty tables."""
    return re.sub(r"\b(FROM|JOIN) (fsales|fstock|fservice|buyers|cars|people|dealers|kinds|days|jobs)\b", r"\1 bad_\2", sql)


def _dq_faulty() -> str:
    rows = []
    for check_id, count in DQ.items():
        category, name, details = quality.TEXTS[check_id]
        rows.append(f"SELECT {_quoted(category)} AS check_category, {_quoted(name)} AS check_name, "
                    f"{big(broken(count))} AS failed_count, {_quoted(details)} AS details")
    joined = "\n  UNION ALL ".join(rows)
    return build(f"SELECT *, CASE failed_count WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (\n  {joined})", STAR_FAULTS)


def _dq_row(check_id: str) -> str:
    category, name, details = quality.TEXTS[check_id]
    return (f"SELECT {_quoted(category)} AS check_category, {_quoted(name)} AS check_name, "
            f"{big(DQ[check_id])} AS failed_count, {_quoted(details)} AS details")


def _dq(ids: list[str]) -> str:
    rows = "\n  UNION ALL ".join(_dq_row(i) for i in ids)
    return build(f"SELECT *, CASE failed_count WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (\n  {rows})")


# -- reconciliation: every metric of the suites as a scalar subquery (amounts in cents, x100 for counts) --
def _one(expression: str, source: str) -> str:
    return f"(SELECT coalesce({expression}, 0) FROM {source})"


def _grouped(expression: str, table: str, keys: str) -> str:
    return f"(SELECT coalesce(sum(x), 0) FROM (SELECT {expression} AS x FROM {table} GROUP BY {keys}))"


SQL_KEYS = {"calendar_year": "y", "month_number": "m"}


def _keys(columns) -> str:
    return ", ".join(SQL_KEYS.get(c, c) for c in columns if c not in ("month_start_date",))


SALE_METRICS = {"rows": "100 * count(*)", "units": "100 * sum(units)", "revenue": "sum(rev_c)", "profit": "sum(gp_c)"}
VISIT_METRICS = {
    "rows": "100 * count(*)", "appointments": "100 * count(*)", "completed_appointments": "100 * sum(done)",
    "cancellations": "100 * sum(cancelled)", "no_shows": "100 * sum(missed)",
    "orders": "100 * count(service_order_id)", "service_revenue": "sum(revenue_c)",
}
RECOGNISED = "(SELECT * FROM fsales WHERE sale_status <> 'Cancelled')"
FINISHED = "(SELECT * FROM fservice WHERE order_status = 'Completed')"
LATEST = "(SELECT * FROM idt WHERE snap = (SELECT max(snap) FROM idt))"
STATUS = "100 * count(*) FILTER (appointment_status = '{}')"

SALES = {
    **{f"detail.{m}": _one(e, "sd") for m, e in SALE_METRICS.items()},
    **{f"kpi.{m}": _one(e, "sd") for m, e in SALE_METRICS.items()},
    "detail.ids": _one("100 * count(DISTINCT sale_id)", "sd"),
    "fact.rows": _one("100 * count(*)", RECOGNISED),
    "fact.units": _one("100 * sum(units)", RECOGNISED),
    "fact.revenue": _one("sum(price_c * units)", RECOGNISED),
    "fact.profit": _one("sum(profit_c * units)", RECOGNISED),
    **{f"{view}.{m}": _grouped(e, "sd", _keys(columns))
       for view, columns in sales.GROUPED.items() for m, e in SALE_METRICS.items()},
}
SERVICE = {
    **{f"detail.{m}": _one(e, "vd") for m, e in VISIT_METRICS.items()},
    **{f"kpi.{m}": _one(e, "vd") for m, e in VISIT_METRICS.items()},
    "detail.ids": _one("100 * count(DISTINCT appointment_id)", "vd"),
    "detail.order_ids": _one("100 * count(DISTINCT service_order_id)", "vd"),
    "detail.completed_without_order":
        _one("100 * count(*) FILTER (appointment_status = 'Completed' AND service_order_id IS NULL)", "vd"),
    "detail.fabricated_cost": "0",
    "source.rows": _one("100 * count(*)", "visits"),
    "source.completed_appointments": _one(STATUS.format("Completed"), "visits"),
    "source.cancellations": _one(STATUS.format("Cancelled"), "visits"),
    "source.no_shows": _one(STATUS.format("No Show"), "visits"),
    "fact.orders": _one("100 * count(*)", "fservice"),
    "fact.service_revenue": _one("sum(revenue_c)", "fservice"),
    **{f"technician.{m}": _grouped(VISIT_METRICS[m], "vd WHERE service_order_id IS NOT NULL",
                                   "technician_key, dealership_key") for m in ("orders", "service_revenue")},
    **{f"{view}.{m}": _grouped(e, "vd", _keys(columns))
       for view, columns in service.GROUPED.items() for m, e in VISIT_METRICS.items()},
}
BUYER_COUNTS = {"customers": "100 * count(*)", "service_orders": "100 * sum(orders_n)", "customer_revenue": "sum(value_c)"}
CUSTOMERS = {
    "detail.customers": _one("100 * count(*)", "cd"),
    "detail.distinct_customers": _one("100 * count(DISTINCT customer_key)", "cd"),
    "detail.sales_transactions": _one("100 * sum(sales_n)", "cd"),
    "detail.service_orders": _one("100 * sum(orders_n)", "cd"),
    "detail.sales_revenue": _one("sum(sales_c)", "cd"),
    "detail.service_revenue": _one("sum(service_c)", "cd"),
    "detail.customer_revenue": _one("sum(value_c)", "cd"),
    "detail.customer_lifetime_value": _one("sum(value_c)", "cd"),
    "detail.new_customers": _one("100 * count(*) FILTER (lifecycle_segment = 'New Customer')", "cd"),
    "detail.repeat_customers": _one("100 * count(*) FILTER (lifecycle_segment = 'Repeat Customer')", "cd"),
    "detail.bad_revenue": _one("100 * count(*) FILTER (value_c <> sales_c + service_c)", "cd"),
    "detail.bad_value": "0",
    "detail.bad_lifecycle": _one("100 * count(*) FILTER ((lifecycle_segment = 'Prospect') <> (touches = 0) OR "
                                 "(lifecycle_segment = 'New Customer') <> (touches = 1))", "cd"),
    "detail.bad_relationship": _one("100 * count(*) FILTER ((relationship_segment = 'Sales + Service') <> "
                                    "(sales_n > 0 AND orders_n > 0) OR (relationship_segment = 'No Activity') <> "
                                    "(touches = 0))", "cd"),
    "detail.bad_inactive": _one("100 * count(*) FILTER ((activity_segment = 'Inactive') <> "
                                "coalesce(last_act + 365 < as_of, false))", "cd"),
    "source.customers": _one("100 * count(*)", "buyers"),
    "sales.transactions": _one("100 * count(*) FILTER (sale_status = 'Completed')", RECOGNISED),
    "sales.revenue": _one("sum(price_c * units)", RECOGNISED),
    "service.orders": _one("100 * count(*)", FINISHED),
    "service.revenue": _one("sum(revenue_c)", FINISHED),
    "kpi.total_customers": _one("100 * count(*)", "cd"),
    "kpi.new_customers": _one("100 * count(*) FILTER (touches = 1)", "cd"),
    "kpi.repeat_customers": _one("100 * count(*) FILTER (touches > 1)", "cd"),
    "kpi.customer_revenue": _one("sum(value_c)", "cd"),
    "kpi.total_customer_lifetime_value": _one("sum(value_c)", "cd"),
    **{f"segment.{m}": _grouped(e, "cd", "relationship_segment, lifecycle_segment, activity_segment")
       for m, e in BUYER_COUNTS.items()},
    **{f"frequency.{m}": _grouped(e, "cd", "freq_no") for m, e in BUYER_COUNTS.items()},
}
REPORTING = {
    "sales.rows": SALES["detail.rows"], "sales.ids": SALES["detail.ids"], "sales.revenue": SALES["detail.revenue"],
    "fact_sales.revenue": SALES["fact.revenue"],
    "stock.rows": _one("100 * count(*)", "idt"),
    "stock.ids": _one("100 * count(DISTINCT inventory_id || ':' || snapshot_date::VARCHAR)", "idt"),
    "stock.value": _one("sum(value_c)", "idt"), "fact_stock.value": _one("sum(value_c)", "fstock"),
    "visits.rows": SERVICE["detail.rows"], "visits.ids": SERVICE["detail.ids"],
    "visits.revenue": SERVICE["detail.service_revenue"], "fact_service.revenue": SERVICE["fact.service_revenue"],
    "customers.rows": CUSTOMERS["detail.customers"],
    "customers.ids": _one("100 * count(DISTINCT customer_id)", "cd"),
    "customers.revenue": CUSTOMERS["detail.customer_revenue"],
    "earned.revenue": f"({CUSTOMERS['sales.revenue']} + {CUSTOMERS['service.revenue']})",
    "cards.rows": _one("100 * count(*)", "dealers"),
    "cards.ids": _one("100 * count(DISTINCT dealership_id)", "dealers"),
    "cards.sales": _grouped("sum(rev_c)", "sd", "dealership_key"),
    "cards.stock": _grouped("sum(value_c)", LATEST, "dealership_key"),
    "cards.service": _grouped("sum(revenue_c)", "vd", "dealership_key"),
    "sales_detail.revenue": SALES["detail.revenue"], "latest_stock.value": _one("sum(value_c)", LATEST),
    "visit_detail.revenue": SERVICE["detail.service_revenue"],
}


def _view_rules(metrics, grouped, template):
    return [(f"{view}_{suffix}", f"{view}.{metric}", f"detail.{metric}", template.format(view=view, label=label))
            for metric, suffix, label in metrics for view in grouped]


def _suite(rules, metrics) -> str:
    rows = []
    for name, metric, baseline, details in rules:
        gap = metrics[metric] if baseline is None else f"{metrics[metric]} - {metrics[baseline]}"
        rows.append(f"SELECT {_quoted(name)} AS check_name, {gap} AS gap, {_quoted(details)} AS details")
    body = "\n  UNION ALL ".join(rows)
    return build("SELECT check_name, CASE WHEN abs(gap) <= 2 THEN 'PASS' ELSE 'FAIL' END AS status, "
                 f"gap::DOUBLE / 100 AS difference, details FROM (\n  {body})")


def _stock_suite() -> str:
    """Six rows; a grouped view would add a row only if it lost or repeated stock."""
    by_fact = "SELECT snapshot_date, count(*) AS n, sum(value_c) AS v, sum(days) AS a FROM fstock GROUP BY 1"
    by_detail = "SELECT snapshot_date, count(*) AS n, sum(value_c) AS v, sum(days) AS a FROM idt GROUP BY 1"
    slow = "SELECT snapshot_date, count(*) AS n, sum(value_c) AS v, sum(days) AS a FROM idt WHERE {} GROUP BY 1"

    def mismatch(left: str, right: str) -> str:
        return (f"(SELECT count(*) FROM ({left}) l FULL JOIN ({right}) r USING (snapshot_date) "
                "WHERE l.n IS NULL OR r.n IS NULL OR l.n <> r.n OR l.a <> r.a OR abs(l.v - r.v) > 2)")

    counts = {
        "detail_inventory_key_uniqueness": _dups("idt", "inventory_id, snap"),
        "detail_vs_fact_by_snapshot": mismatch(by_fact, by_detail),
        "kpis_vs_detail_by_snapshot": mismatch(by_detail, by_detail),
        "slow_moving_view_vs_detail_by_snapshot": mismatch(slow.format("slow"), slow.format("days > 90")),
        "aging_bucket_assignment": _rows("idt", "bucket_no <> CASE WHEN days < 0 OR days > 120 THEN 5 "
                                                "WHEN days > 90 THEN 4 WHEN days > 60 THEN 3 WHEN days > 30 THEN 2 ELSE 1 END"),
        "slow_moving_definition": _rows("idt", "slow <> (days > 90)"),
    }
    rows = [f"SELECT {_quoted(n)} AS check_name, {big(c)} AS failed_count, "
            f"{_quoted(reconcile.INVENTORY_TEXTS[n])} AS details" for n, c in counts.items()]
    for view, columns in inventory.GROUPED.items():
        keys = ", ".join({"snapshot_date_key": "snap", "aging_bucket": "bucket",
                          "aging_bucket_sort": "bucket_no"}.get(c, c) for c in columns)
        grouped = (f"SELECT snapshot_date, sum(n) AS n, sum(v) AS v, sum(a) AS a FROM (SELECT {keys}, count(*) AS n, "
                   f"sum(value_c) AS v, sum(days) AS a FROM idt GROUP BY {keys}) GROUP BY 1")
        details = reconcile.INVENTORY_VIEW_TEXT.format(view=view)
        rows.append(f"SELECT {_quoted(view + '_vs_detail_by_snapshot')} AS check_name, x::BIGINT AS failed_count, "
                    f"{_quoted(details)} AS details FROM (SELECT {mismatch(grouped, by_detail)} AS x) WHERE x > 0")
    body = "\n  UNION ALL ".join(rows)
    return build(f"SELECT *, CASE failed_count WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (\n  {body})")


ROLE_KEYS = "SELECT '{}' AS dimension, employee_key AS key FROM people WHERE role = '{}'"
EXTRA = {
    "dimkeys": "\n  SELECT 'Customer' AS dimension, customer_key AS key FROM buyers UNION ALL "
               "SELECT 'Vehicle', vehicle_key FROM cars UNION ALL SELECT 'Dealership', dealership_key FROM dealers "
               "UNION ALL " + ROLE_KEYS.format("Salesperson", "Sales Consultant")
               + " UNION ALL " + ROLE_KEYS.format("Advisor", "Service Advisor")
               + " UNION ALL " + ROLE_KEYS.format("Technician", "Service Technician")
               + " UNION ALL SELECT 'Service', service_key FROM kinds"
               " UNION ALL SELECT 'Date', strftime(full_date, '%Y%m%d')::BIGINT FROM days",
    "usedkeys": "\n  SELECT unnest(['Customer', 'Vehicle', 'Dealership', 'Salesperson', 'Date']) AS dimension, "
                "unnest([customer_key, vehicle_key, dealership_key, salesperson_key, "
                "strftime(sale_date, '%Y%m%d')::BIGINT]) AS key FROM sd "
                "UNION ALL SELECT unnest(['Vehicle', 'Dealership', 'Date']), "
                "unnest([vehicle_key, dealership_key, snap]) FROM idt "
                "UNION ALL SELECT unnest(['Customer', 'Vehicle', 'Dealership', 'Advisor', 'Technician', 'Service', 'Date']), "
                "unnest([customer_key, vehicle_key, dealership_key, service_advisor_key, technician_key, service_key, "
                "strftime(appointment_date, '%Y%m%d')::BIGINT]) FROM vd",
    "happenings": "\n  SELECT full_date AS d FROM days UNION ALL SELECT promised_at::DATE FROM fservice "
                  "UNION ALL SELECT customer_since_date FROM buyers",
    "years": "\n  SELECT date_trunc('year', min(d)) AS a, date_trunc('year', max(d)) + INTERVAL 1 YEAR AS b FROM happenings",
}
MODEL = {
    "dimension_key_uniqueness":
        "(SELECT count(*) FROM (SELECT 1 FROM dimkeys GROUP BY dimension, key HAVING count(*) > 1 OR key IS NULL))",
    "fact_grain_uniqueness": f"{_dups('sd', 'sale_no')} + {_dups('idt', 'inventory_id, snap')} + {_dups('vd', 'visit_no')}",
    "required_foreign_keys_and_role_alignment":
        "(SELECT count(*) FROM usedkeys u WHERE CASE WHEN key IS NULL THEN dimension <> 'Technician' ELSE NOT EXISTS "
        "(SELECT 1 FROM dimkeys d WHERE d.dimension = u.dimension AND d.key = u.key) END)",
    "inventory_composite_grain": _dups("idt", "vehicle_key, dealership_key, snap"),
    "repair_order_unique_within_appointments":
        "(SELECT count(service_order_id) - count(DISTINCT service_order_id) FROM vd)",
    "service_status_enrichment_preserves_grain":
        "abs((SELECT count(*) FROM vd LEFT JOIN fservice o USING (visit_no)) - (SELECT count(*) FROM vd))",
    "appointments_not_lost": "abs((SELECT count(*) FROM visits) - (SELECT count(*) FROM vd))",
    "sales_eligible_rows_preserved":
        "abs((SELECT count(*) FROM fsales WHERE sale_status <> 'Cancelled') - (SELECT count(*) FROM sd))",
    "inventory_rows_preserved": "abs((SELECT count(*) FROM fstock) - (SELECT count(*) FROM idt))",
    "calendar_source_unique_contiguous":
        "(SELECT CASE WHEN count(DISTINCT full_date) = count(*) AND date_diff('day', min(full_date), max(full_date)) "
        "= count(*) - 1 THEN 0 ELSE 1 END FROM days)",
    "full_year_calendar_bounds_cover_event_dates":
        "(SELECT count(*) FROM happenings WHERE d < (SELECT a FROM years) OR d >= (SELECT b FROM years))",
    "calendar_bounds_available": "(SELECT (a IS NULL OR b IS NULL)::INTEGER FROM years)",
    "date_key_matches_date":
        "(SELECT count(*) FROM days WHERE strptime(strftime(full_date, '%Y%m%d'), '%Y%m%d')::DATE <> full_date)",
    "signed_return_values":
        "(SELECT count(*) FROM sd WHERE (sale_status = 'Returned') <> (units = -1) OR rev_c * units < 0 OR cost_c * units < 0)",
    "service_costs_not_fabricated": "0",
    "slow_moving_and_bucket_boundaries":
        "(SELECT count(*) FROM idt WHERE slow <> (bucket_no >= 4) OR bucket_no <> 1 + (days > 30)::INTEGER "
        "+ (days > 60)::INTEGER + (days > 90)::INTEGER + (days > 120)::INTEGER)",
}


def _model(names: list[str]) -> str:
    rows = "\n  UNION ALL ".join(f"SELECT '{n}' AS check_name, {big(MODEL[n])} AS failed_count" for n in names)
    return build(f"SELECT *, CASE failed_count WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (\n  {rows})", EXTRA)


def model_key(name: str) -> str:
    return f"md_{list(MODEL).index(name) + 1:02d}_{name}"


SALES_SUITE = reconcile.SALES_RULES + _view_rules(
    reconcile.SALES_VIEW_METRICS, sales.GROUPED, "{view} {label} must reconcile to canonical detail.")
SERVICE_SUITE = reconcile.SERVICE_RULES + _view_rules(
    [(m, m, label) for m, label in reconcile.SERVICE_VIEW_METRICS], service.GROUPED, "{view} {label} must reconcile to detail.")

SQL: dict[str, str] = {
    **{f"{i}_check": _dq([i]) for i in DQ},
    "dq_all_checks": _dq(list(DQ)),
    "dq_faulty_checks": _dq_faulty(),
    "rc_sal_sales": _suite(SALES_SUITE, SALES),
    "rc_inv_inventory": _stock_suite(),
    "rc_svc_service": _suite(SERVICE_SUITE, SERVICE),
    "rc_cus_customers": _suite(reconcile.CUSTOMER_RULES, CUSTOMERS),
    "rc_rep_reporting_views": _suite(reconcile.REPORTING_RULES, REPORTING),
    "rc_mdl_star_model": _model(list(MODEL)),
    **{model_key(n): _model([n]) for n in MODEL},
}
