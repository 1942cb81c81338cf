"""Twins of the warehouse load, its constraints, the source reports and the cleaning run."""

from __future__ import annotations

from forecourt.contracts import DATASETS, INSTANT, MONEY, ROLE_LINKS, SHARED_ORDER_COLUMNS, TEXT, Dataset, foreign_keys
from forecourt.oracle.base import big, build, day, flag, instant, money, ymd
from forecourt.oracle.checks import EXTRA, _dups
from forecourt.sources.faulty import COPIES, FAULTS, SOLD_VEHICLE

VERSION = "'1900-01-01' AS effective_from, '9999-12-31' AS effective_to, 'true' AS is_current"


def _q(sql: str) -> str:
    return build(sql.strip(), EXTRA)


TABLES = {
    "ld_01_dim_date": _q(f"""SELECT {ymd('full_date')} AS date_key, {day('full_date')} AS full_date,
  {big('isodow(full_date)')} AS day_of_week, dayname(full_date) AS day_name, {big('day(full_date)')} AS day_of_month,
  {big('dayofyear(full_date)')} AS day_of_year, {big('week(full_date)')} AS week_of_year,
  {big('month(full_date)')} AS month_number, monthname(full_date) AS month_name,
  {big('quarter(full_date)')} AS quarter_number, {big('year(full_date)')} AS calendar_year,
  {flag('isodow(full_date) > 5')} AS is_weekend FROM days"""),
    "ld_02_dim_dealership": _q(f"""SELECT dealership_key, dealership_id, dealership_name, city, state, postal_code, region,
  {day('opened_date')} AS opened_date, {VERSION} FROM dealers"""),
    "ld_03_dim_customer": _q(f"""SELECT customer_key, customer_id, first_name, last_name, email, phone, city, state,
  postal_code, {day('customer_since_date')} AS customer_since_date, customer_type, {VERSION} FROM buyers"""),
    "ld_04_dim_vehicle": _q(f"""SELECT vehicle_key, vehicle_id, vin, brand AS make, model, {big('model_year')} AS model_year,
  vehicle_type AS body_type, fuel_type, color, vehicle_condition, {big('mileage')} AS mileage_at_acquisition,
  {money('msrp')} AS manufacturer_msrp FROM cars"""),
    "ld_05_dim_employee": _q(f"""SELECT employee_key, employee_id, people.dealership_key, first_name, last_name, role,
  {day('hire_date')} AS hire_date, employment_status, {VERSION} FROM people JOIN dealers USING (dealership_id)"""),
    "ld_06_dim_service": _q("SELECT service_key, service_type, service_category, 'true' AS is_active FROM kinds"),
    "ld_07_fact_sales": _q(f"""SELECT sale_no AS sales_key, sale_id, {ymd('sale_date')} AS sale_date_key, customer_key,
  vehicle_key, dealership_key, salesperson_key, sales_channel, {money('list_c')} AS list_price,
  {money('discount_c')} AS discount_amount, {money('price_c')} AS sale_price, {money('cost_c')} AS vehicle_cost,
  {money('profit_c')} AS gross_profit, {big('units')} AS unit_quantity, payment_type, sale_status FROM fsales"""),
    "ld_08_fact_inventory": _q(f"""SELECT
  (substr(inventory_id, 4)::HUGEINT * 100000000 + {ymd('snapshot_date')})::DOUBLE AS inventory_key, inventory_id,
  {ymd('snapshot_date')} AS snapshot_date_key, vehicle_key, dealership_key, {day('acquired_date')} AS acquired_date,
  'Available' AS inventory_status, {money('value_c')} AS carrying_cost, {big('days')} AS days_in_inventory,
  {flag('days > 90')} AS slow_moving_flag, 1::BIGINT AS on_hand_quantity FROM fstock"""),
    "ld_09_fact_service": _q(f"""SELECT visit_no AS service_fact_key, service_order_id, appointment_id,
  {ymd('completed_at')} AS completed_date_key, customer_key, vehicle_key, dealership_key, service_advisor_key,
  technician_key, service_key, {instant('opened_at')} AS opened_at, {instant('promised_at')} AS promised_at,
  {instant('completed_at')} AS completed_at, order_status, payer_type, {money('labor_c')} AS labor_revenue,
  {money('parts_c')} AS parts_revenue, {money('discount_c')} AS discount_amount, {money('revenue_c')} AS service_revenue,
  1::BIGINT AS repair_order_quantity, {flag('on_time')} AS completed_on_time, {money('hours_c')} AS turnaround_hours
FROM fservice"""),
    "ld_12_repaired_unit_signs": _q(f"""SELECT sale_id, sale_status,
  {big("CASE sale_status WHEN 'Returned' THEN -1 ELSE 1 END")} AS unit_quantity FROM fsales"""),
}

# -- constraints ----------------------------------------------------------------------


def _bad(table: str, rule: str) -> str:
    return f"(SELECT count(*) FILTER (NOT ({rule})) FROM {table})"


def _null(table: str, columns: str) -> str:
    tests = " OR ".join(f"{c.strip()} IS NULL" for c in columns.split(","))
    return f"(SELECT count(*) FILTER ({tests}) FROM {table})"


def _long(table: str, **limits: int) -> str:
    tests = " OR ".join(f"length({c}) > {n}" for c, n in limits.items())
    return f"(SELECT count(*) FILTER ({tests}) FROM {table})"


VERSIONED = "DATE '1900-01-01' <= DATE '9999-12-31'"
CONSTRAINTS: list[tuple[str, str, str]] = [
    ("dim_date", "day_of_week", _bad("days", "isodow(full_date) BETWEEN 1 AND 7")),
    ("dim_date", "day_of_month", _bad("days", "day(full_date) BETWEEN 1 AND 31")),
    ("dim_date", "day_of_year", _bad("days", "dayofyear(full_date) BETWEEN 1 AND 366")),
    ("dim_date", "week_of_year", _bad("days", "week(full_date) BETWEEN 1 AND 53")),
    ("dim_date", "month_number", _bad("days", "month(full_date) BETWEEN 1 AND 12")),
    ("dim_date", "quarter_number", _bad("days", "quarter(full_date) BETWEEN 1 AND 4")),
    ("dim_date", "calendar_year", _bad("days", "year(full_date) BETWEEN 2000 AND 2200")),
    ("dim_date", "not_null", _null("days", "full_date")),
    ("dim_date", "unique(date_key)", _dups("days", "strftime(full_date, '%Y%m%d')")),
    ("dim_date", "unique(full_date)", _dups("days", "full_date")),
    ("dim_dealership", "effective_dates", _bad("dealers", VERSIONED)),
    ("dim_dealership", "not_null", _null("dealers", "dealership_id, dealership_name, city, state, postal_code, region, opened_date")),
    ("dim_dealership", "lengths", _long("dealers", dealership_id=20, dealership_name=150, city=100, state=50, postal_code=20, region=50)),
    ("dim_dealership", "unique(dealership_key)", _dups("dealers", "dealership_key")),
    ("dim_dealership", "unique(dealership_id)", _dups("dealers", "dealership_id")),
    ("dim_customer", "customer_type", _bad("buyers", "customer_type IN ('Individual', 'Business', 'Fleet')")),
    ("dim_customer", "effective_dates", _bad("buyers", VERSIONED)),
    ("dim_customer", "not_null", _null("buyers", "customer_id, first_name, last_name, customer_since_date, customer_type")),
    ("dim_customer", "lengths", _long("buyers", customer_id=20, first_name=100, last_name=100, email=320, phone=30, city=100, state=50, postal_code=20)),
    ("dim_customer", "unique(customer_key)", _dups("buyers", "customer_key")),
    ("dim_customer", "unique(customer_id, effective_from)", _dups("buyers", "customer_id")),
    ("dim_customer", "one current customer_id", _dups("buyers", "customer_id")),
    ("dim_vehicle", "model_year", _bad("cars", "model_year BETWEEN 1980 AND 2200")),
    ("dim_vehicle", "vehicle_condition", _bad("cars", "vehicle_condition IN ('New', 'Used')")),
    ("dim_vehicle", "mileage", _bad("cars", "mileage >= 0")),
    ("dim_vehicle", "msrp", _bad("cars", "msrp >= 0")),
    ("dim_vehicle", "not_null", _null("cars", "vehicle_id, vin, brand, model, model_year, vehicle_type, fuel_type, mileage, msrp")),
    ("dim_vehicle", "lengths", _long("cars", vehicle_id=20, vin=17, brand=60, model=60, vehicle_type=30, fuel_type=30, color=30)),
    ("dim_vehicle", "unique(vehicle_key)", _dups("cars", "vehicle_key")),
    ("dim_vehicle", "unique(vehicle_id)", _dups("cars", "vehicle_id")),
    ("dim_vehicle", "unique(vin)", _dups("cars", "vin")),
    ("dim_employee", "role", _bad("people", "role IN ('Sales Consultant', 'Service Advisor', 'Service Technician')")),
    ("dim_employee", "employment_status", _bad("people", "employment_status IN ('Active', 'Inactive')")),
    ("dim_employee", "effective_dates", _bad("people", VERSIONED)),
    ("dim_employee", "not_null", _null("people", "employee_id, dealership_key, first_name, last_name, role, hire_date, employment_status")),
    ("dim_employee", "lengths", _long("people", employee_id=20, first_name=100, last_name=100, role=40, employment_status=10)),
    ("dim_employee", "unique(employee_key)", _dups("people", "employee_key")),
    ("dim_employee", "unique(employee_id, effective_from)", _dups("people", "employee_id")),
    ("dim_employee", "one current employee_id", _dups("people", "employee_id")),
    ("dim_service", "not_null", _null("kinds", "service_key, service_type, service_category")),
    ("dim_service", "lengths", _long("kinds", service_type=50, service_category=50)),
    ("dim_service", "unique(service_key)", _dups("kinds", "service_key")),
    ("dim_service", "unique(service_type)", _dups("kinds", "service_type")),
    ("fact_sales", "sales_channel", _bad("fsales", "sales_channel IN ('Showroom', 'Online', 'Fleet', 'Partner')")),
    ("fact_sales", "payment_type", _bad("fsales", "payment_type IN ('Finance', 'Cash', 'Lease')")),
    ("fact_sales", "sale_status", _bad("fsales", "sale_status IN ('Completed', 'Returned', 'Cancelled')")),
    ("fact_sales", "amounts", _bad("fsales", "least(list_c, discount_c, price_c, cost_c) >= 0 AND abs(list_c - discount_c - price_c) <= 2 AND abs(price_c - cost_c - profit_c) <= 2")),
    ("fact_sales", "units", _bad("fsales", "units = CASE sale_status WHEN 'Returned' THEN -1 ELSE 1 END")),
    ("fact_sales", "not_null", _null("fsales", "sale_id, sale_date, customer_key, vehicle_key, dealership_key, salesperson_key, price_c, payment_type, sale_status")),
    ("fact_sales", "lengths", _long("fsales", sale_id=20, sales_channel=20, payment_type=20, sale_status=20)),
    ("fact_sales", "unique(sales_key)", _dups("fsales", "sale_no")),
    ("fact_sales", "unique(sale_id)", _dups("fsales", "sale_id")),
    ("fact_inventory", "inventory_status", "0"),
    ("fact_inventory", "values", _bad("fstock", "value_c >= 0 AND days >= 0 AND units = 1")),
    ("fact_inventory", "not_null", _null("fstock", "inventory_id, snapshot_date, vehicle_key, dealership_key, acquired_date, value_c, days")),
    ("fact_inventory", "lengths", _long("fstock", inventory_id=20)),
    ("fact_inventory", "unique(inventory_key)", _dups("fstock", "inventory_id, snapshot_date")),
    ("fact_inventory", "unique(inventory_id, snapshot_date_key)", _dups("fstock", "inventory_id, snapshot_date")),
    ("fact_inventory", "unique(vehicle_key, dealership_key, snapshot_date_key)", _dups("fstock", "vehicle_key, dealership_key, snapshot_date")),
    ("fact_service", "timestamp_order", _bad("fservice", "opened_at <= promised_at AND opened_at <= completed_at")),
    ("fact_service", "order_status", _bad("fservice", "order_status IN ('Completed', 'Cancelled', 'Reopened')")),
    ("fact_service", "payer_type", _bad("fservice", "payer_type IN ('Customer Pay', 'Warranty', 'Internal')")),
    ("fact_service", "amounts", _bad("fservice", "least(labor_c, parts_c, discount_c, revenue_c) >= 0 AND abs(labor_c + parts_c - discount_c - revenue_c) <= 2")),
    ("fact_service", "quantity", "0"),
    ("fact_service", "not_null", _null("fservice", "service_order_id, appointment_id, opened_at, promised_at, completed_at, customer_key, vehicle_key, technician_key, revenue_c, on_time")),
    ("fact_service", "lengths", _long("fservice", service_order_id=20, appointment_id=20, order_status=20, payer_type=20)),
    ("fact_service", "unique(service_fact_key)", _dups("fservice", "visit_no")),
    ("fact_service", "unique(service_order_id)", _dups("fservice", "service_order_id")),
    ("fact_service", "unique(appointment_id)", _dups("fservice", "appointment_id")),
]
CONSTRAINT_SQL = _q("\n  UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"constraint\", {big(sql)} AS violations" for t, c, sql in CONSTRAINTS))

def faulty_constraints() -> str:
    """The same constraints over the faulty star schema."""
    from forecourt.oracle.checks import STAR_FAULTS, broken

    return build("\n  UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"constraint\", {big(broken(sql))} AS violations" for t, c, sql in CONSTRAINTS), STAR_FAULTS)


COUNTED = (("dim_customer", "customer", "buyers"), ("dim_vehicle", "part", "cars"), ("dim_dealership", "supplier", "dealers"),
           ("fact_sales", "orders", "fsales"), ("fact_inventory", "stock", "fstock"), ("fact_service", "jobs", "fservice"))
ROWS_SQL = _q("\n  UNION ALL ".join([
    *[f"SELECT '{t}' AS \"table\", (SELECT count(*) FROM {a}) AS expected, (SELECT count(*) FROM {b}) AS actual, "
      f"CASE WHEN (SELECT count(*) FROM {a}) = (SELECT count(*) FROM {b}) THEN 'PASS' ELSE 'FAIL' END AS status"
      for t, a, b in COUNTED],
    "SELECT 'dim_employee', 3 * (SELECT count(*) FROM supplier), (SELECT count(*) FROM people), 'PASS'",
    "SELECT 'dim_date', NULL, (SELECT count(*) FROM days), 'PASS'",
    "SELECT 'dim_service', NULL, (SELECT count(*) FROM kinds), 'PASS'"]))

# -- the faulty text datasets ------------------------------------------------------------
def _decimal(column: str) -> str:
    return f"printf('%d.%02d', {column} // 100, {column} % 100)"


SECONDS = "strftime({}, '%Y-%m-%d %H:%M:%S')".format
TEXT_SOURCES = {
    "customers": f"SELECT customer_id, first_name, last_name, email, phone, city, state, postal_code, "
                 f"{day('customer_since_date')} AS customer_since_date, customer_type, customer_key AS k FROM buyers",
    "vehicles": f"SELECT vehicle_id, vin, brand AS make, model, model_year::VARCHAR AS model_year, vehicle_type AS body_type, "
                f"fuel_type, color, vehicle_condition, mileage::VARCHAR AS mileage_at_acquisition, "
                f"{_decimal('msrp')} AS manufacturer_msrp, vehicle_key AS k FROM cars",
    "dealerships": f"SELECT dealership_id, dealership_name, city, state, postal_code, region, "
                   f"{day('opened_date')} AS opened_date, dealership_key AS k FROM dealers",
    "employees": f"SELECT employee_id, dealership_id, first_name, last_name, role, {day('hire_date')} AS hire_date, "
                 f"employment_status, employee_key AS k FROM people",
    "sales": f"SELECT sale_id, {day('sale_date')} AS sale_date, customer_id, vehicle_id, dealers.dealership_id, "
             f"employee_id AS salesperson_id, sales_channel, {_decimal('list_c')} AS list_price, "
             f"{_decimal('discount_c')} AS discount_amount, {_decimal('price_c')} AS sale_price, "
             f"{_decimal('cost_c')} AS vehicle_cost, {_decimal('profit_c')} AS gross_profit, payment_type, sale_status, "
             f"sale_no AS k FROM deals JOIN buyers USING (customer_key) JOIN cars USING (vehicle_key) "
             f"JOIN dealers USING (dealership_key) JOIN people ON employee_key = salesperson_key",
    "inventory": f"SELECT inventory_id, {day('snapshot_date')} AS snapshot_date, vehicle_id, dealership_id, "
                 f"{day('acquired_date')} AS acquired_date, 'Available' AS inventory_status, "
                 f"{_decimal('value_c')} AS carrying_cost, days::VARCHAR AS days_in_inventory, "
                 f"(days > 90)::VARCHAR AS slow_moving_flag, substr(inventory_id, 4)::BIGINT AS k "
                 f"FROM stock JOIN cars USING (vehicle_key) JOIN dealers USING (dealership_key)",
    "service_appointments":
        f"SELECT appointment_id, customer_id, vehicle_id, dealers.dealership_id, employee_id AS service_advisor_id, "
        f"{day('appointment_date')} AS appointment_date, appointment_time, service_type, appointment_status, visit_no AS k "
        f"FROM visits JOIN buyers USING (customer_key) JOIN cars USING (vehicle_key) JOIN dealers USING (dealership_key) "
        f"JOIN people ON employee_key = service_advisor_key",
    "service_orders":
        f"SELECT service_order_id, appointment_id, customer_id, vehicle_id, dealers.dealership_id, "
        f"a.employee_id AS service_advisor_id, t.employee_id AS technician_id, {SECONDS('opened_at')} AS opened_at, "
        f"{SECONDS('promised_at')} AS promised_at, {SECONDS('completed_at')} AS completed_at, order_status, payer_type, "
        f"{_decimal('labor_c')} AS labor_revenue, {_decimal('parts_c')} AS parts_revenue, "
        f"{_decimal('discount_c')} AS discount_amount, {_decimal('revenue_c')} AS service_revenue, jobs.visit_no AS k "
        f"FROM jobs JOIN visits v ON v.visit_no = jobs.visit_no JOIN buyers ON buyers.customer_key = jobs.customer_key "
        f"JOIN cars ON cars.vehicle_key = jobs.vehicle_key JOIN dealers ON dealers.dealership_key = jobs.dealership_key "
        f"JOIN people a ON a.employee_key = jobs.service_advisor_key JOIN people t ON t.employee_key = jobs.technician_key",
}
CLEAN: dict[str, str] = dict(EXTRA)
for _name, _contract in DATASETS.items():
    _source = TEXT_SOURCES[_name]
    if _name == "sales":
        _source = f"SELECT * REPLACE ({SOLD_VEHICLE} AS vehicle_id) FROM ({_source})"
    CLEAN[f"plain_{_name}"] = f"\n  {_source}"
    _changed = ", ".join(f"{FAULTS[_name].get(c, c)} AS {c}" for c in _contract.columns)
    CLEAN[f"broken_{_name}"] = f"\n  SELECT k, {_changed} FROM plain_{_name}"
    _all = ", ".join(_contract.columns)
    _copies = []
    for _condition, _over in COPIES.get(_name, []):
        _values = ", ".join(_over.get(c, c) for c in _contract.columns)
        _copies.append(f" UNION ALL SELECT {_values} FROM broken_{_name} WHERE {_condition}")
    CLEAN[f"bad_{_name}"] = f"\n  SELECT {_all} FROM broken_{_name}" + "".join(_copies)


def _b(sql: str) -> str:
    return build(sql.strip(), CLEAN)


def _parse(contract: Dataset, name: str, text: str) -> str:
    field = contract.field(name)
    if field in contract.dates:
        return f"TRY_CAST({text} AS {'TIMESTAMP' if field.type == INSTANT else 'DATE'})"
    if field in contract.numbers:
        return f"TRY_CAST({text} AS DECIMAL(18,2))"
    if field in contract.flags:
        word = f"lower(trim({text}))"
        return f"CASE WHEN {word} IN ('true', '1', 'yes') THEN true WHEN {word} IN ('false', '0', 'no') THEN false END"
    return text


# -- profile ---------------------------------------------------------------------------------
def _dataset_profile() -> str:
    rows = []
    for name, contract in sorted(DATASETS.items()):
        nulls = " + ".join(f"({c} IS NULL)::BIGINT" for c in contract.columns)
        rows.append(
            f"SELECT '{name}' AS dataset, count(*) AS row_count, {len(contract.columns)}::BIGINT AS column_count, "
            f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM bad_{name})) AS duplicate_row_count, "
            f"{big(f'sum({nulls})')} AS total_null_count, '{contract.key}' AS primary_key, "
            f"count(*) - count(DISTINCT {contract.key}) AS duplicate_primary_key_count FROM bad_{name}")
    return _b("\n  UNION ALL ".join(rows))


def _column_profile() -> str:
    rows = []
    for name, contract in sorted(DATASETS.items()):
        for position, c in enumerate(contract.columns, start=1):
            parsed = f"TRY_CAST({c} AS TIMESTAMP)" if contract.field(c) in contract.dates else "NULL::TIMESTAMP"
            bad = f"count(*) FILTER ({c} IS NOT NULL AND {parsed} IS NULL)" if contract.field(c) in contract.dates else "NULL::BIGINT"
            rows.append(
                f"SELECT '{name}' AS dataset, '{c}' AS \"column\", {position}::BIGINT AS position, count(*) AS row_count, "
                f"count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS unique_count, "
                f"(SELECT coalesce(string_agg(v, ' | ' ORDER BY v), '') FROM (SELECT DISTINCT {c} AS v FROM bad_{name} "
                f"WHERE {c} IS NOT NULL ORDER BY v LIMIT 5)) AS sample_unique_values, "
                f"count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) = 0 AND count({c}) > 0 AS is_number, "
                f"count(*) FILTER (lower({c}) NOT IN ('true', 'false')) = 0 AS is_flag, "
                f"min(TRY_CAST({c} AS DECIMAL(20,2))) AS lo, max(TRY_CAST({c} AS DECIMAL(20,2))) AS hi, "
                f"sum(TRY_CAST({c} AS DECIMAL(20,2)) * 100)::HUGEINT AS total_c, "
                f"count(*) FILTER (TRY_CAST({c} AS DECIMAL(20,2)) % 1 <> 0) AS fractions, "
                f"min({parsed}) AS first_d, max({parsed}) AS last_d, {bad} AS invalid_date_count FROM bad_{name}")
    body = "\n  UNION ALL ".join(rows)
    stamp = "strftime({}, '%Y-%m-%dT%H:%M:%S')".format
    from forecourt.oracle.base import half_up
    mean = half_up("total_c * 10000", "row_count - null_count")
    share = half_up("null_count * 1000000", "row_count")
    return _b(f"""SELECT dataset, "column", position, row_count, null_count, {share}::DOUBLE / 10000 AS null_percent,
  unique_count, sample_unique_values, CASE WHEN is_number THEN CASE fractions WHEN 0 THEN 'whole number' ELSE 'decimal number' END
    WHEN is_flag THEN 'boolean' ELSE 'text' END AS data_type,
  CASE WHEN is_number THEN lo::DOUBLE END AS numeric_min, CASE WHEN is_number THEN hi::DOUBLE END AS numeric_max,
  CASE WHEN is_number THEN {mean}::DOUBLE / 1000000 END AS numeric_mean,
  {stamp('first_d')} AS date_min, {stamp('last_d')} AS date_max, invalid_date_count FROM (\n  {body})""")


def _foreign_keys() -> str:
    rows = []
    for child, column, parent, key in foreign_keys():
        orphan = f"{column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM bad_{parent} WHERE {key} IS NOT NULL)"
        rows.append(
            f"SELECT '{child}' AS child_dataset, '{column}' AS child_column, '{parent}' AS parent_dataset, "
            f"'{key}' AS parent_column, count({column}) AS checked_rows, count(*) FILTER ({orphan}) AS orphan_count, "
            f"CASE WHEN count(*) FILTER ({orphan}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
            f"(SELECT coalesce(string_agg(v, ' | ' ORDER BY v), '') FROM (SELECT DISTINCT {column} AS v FROM bad_{child} "
            f"WHERE {orphan} ORDER BY v LIMIT 5)) AS details FROM bad_{child}")
    return _b("\n  UNION ALL ".join(rows))


def _check_rules() -> list[tuple[str, str, str, str, str]]:
    """(dataset, check, source, broken condition, example column)."""
    rules = []
    for name, contract in DATASETS.items():
        source, key = f"bad_{name}", contract.key
        every = ", ".join(contract.columns)
        rules += [
            (name, f"{key} is populated", source, f"{key} IS NULL", key),
            (name, f"{key} is unique", f"(SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM {source})", "n > 1", key),
            (name, "rows are unique", f"(SELECT *, count(*) OVER (PARTITION BY {every}) AS n FROM {source})", "n > 1", "NULL"),
        ]
        for f in contract.fields:
            if f in contract.dates:
                rules.append((name, f"{f.name} contains valid dates", source,
                              f"{f.name} IS NOT NULL AND TRY_CAST({f.name} AS TIMESTAMP) IS NULL", f.name))
            if f.nonnegative:
                rules.append((name, f"{f.name} is nonnegative numeric", source,
                              f"coalesce(TRY_CAST({f.name} AS DOUBLE), -1) < 0", f.name))
            if f.domain:
                rules.append((name, f"{f.name} uses allowed values", source,
                              f"coalesce({f.name} NOT IN ({', '.join(repr(v) for v in f.domain)}), true)", f.name))
    d, n = "TRY_CAST({} AS TIMESTAMP)".format, "TRY_CAST({} AS DECIMAL(18,2))".format
    age = f"date_diff('day', {d('acquired_date')}, {d('snapshot_date')})"
    flagged = "CASE lower(slow_moving_flag) WHEN 'true' THEN true WHEN 'false' THEN false END"
    late = "coalesce(abs({} - {}) > 0.02, false)".format
    rules += [
        ("customers", "email has a valid basic format", "bad_customers",
         r"NOT coalesce(regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$'), false)", "email"),
        ("inventory", "acquired_date is on or before snapshot_date", "bad_inventory",
         f"coalesce({d('acquired_date')} > {d('snapshot_date')}, false)", "NULL"),
        ("inventory", "days_in_inventory matches dates", "bad_inventory",
         f"coalesce(TRY_CAST(days_in_inventory AS DOUBLE) <> {age}, true)", "inventory_id"),
        ("inventory", "slow_moving_flag matches 90-day rule", "bad_inventory",
         f"coalesce({flagged} <> coalesce({age} > 90, false), true)", "inventory_id"),
        ("sales", "sale_price equals list_price minus discount", "bad_sales",
         late(f"{n('list_price')} - {n('discount_amount')}", n("sale_price")), "sale_id"),
        ("sales", "gross_profit equals sale_price minus vehicle_cost", "bad_sales",
         late(f"{n('sale_price')} - {n('vehicle_cost')}", n("gross_profit")), "sale_id"),
        *[("service_orders", f"opened_at is on or before {c}", "bad_service_orders",
           f"coalesce({d('opened_at')} > {d(c)}, false)", "service_order_id") for c in ("promised_at", "completed_at")],
        ("service_orders", "service_revenue matches components", "bad_service_orders",
         late(f"{n('labor_revenue')} + {n('parts_revenue')} - {n('discount_amount')}", n("service_revenue")), "service_order_id"),
        *[("service_orders", f"{c} matches appointment",
           f"(SELECT o.service_order_id, o.{c} AS mine, v.{c} AS due FROM bad_service_orders o "
           "LEFT JOIN bad_service_appointments v USING (appointment_id))",
           "coalesce(mine <> due, true)", "service_order_id") for c in SHARED_ORDER_COLUMNS],
    ]
    return rules


def _validation(only_summary: bool = False) -> str:
    rows = []
    for name, check, source, broken, example in _check_rules():
        shown = (f"(SELECT coalesce(string_agg(v, ' | ' ORDER BY v), '') FROM (SELECT DISTINCT {example} AS v FROM {source} "
                 f"WHERE ({broken}) AND {example} IS NOT NULL ORDER BY v LIMIT 5))") if example != "NULL" else "''"
        rows.append(f"SELECT '{name}' AS dataset, '{check}' AS \"check\", count(*) FILTER ({broken}) AS invalid_count, "
                    f"{shown} AS examples FROM {source}")
    body = "\n  UNION ALL ".join(rows)
    return (f"SELECT *, 'ERROR' AS severity, CASE invalid_count WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status "
            f"FROM (\n  {body})")


def _summary() -> str:
    rows = " + ".join(f"(SELECT count(*) FROM bad_{n})" for n in DATASETS)
    failed = " + ".join(
        f"(SELECT (count(*) > 0)::BIGINT FROM bad_{c} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {pk} FROM bad_{p} WHERE {pk} IS NOT NULL))"
        for c, k, p, pk in foreign_keys())
    return (f"SELECT {big(rows)} AS rows_profiled, (SELECT sum(invalid_count)::BIGINT FROM ({_validation()})) AS validation_errors, "
            f"{big(failed)} AS failed_foreign_keys")


# -- cleaning: the same order of steps, written over whole tables -----------------------------
STEPS: list[tuple[str, str, str, str]] = []  # dataset, action, details, count


def _step(dataset: str, action: str, details: str, count: str) -> None:
    STEPS.append((dataset, action, details, count))


def _rows_where(table: str, condition: str) -> str:
    return f"(SELECT count(*) FILTER ({condition}) FROM {table})"


for _name, _contract in DATASETS.items():
    _texts, _typed, _final = [], [], []
    for _f in _contract.fields:
        c = _f.name
        if _f in _contract.numbers + _contract.flags:
            _texts.append(c)
        else:
            std = f"nullif(trim({c}), '')"
            std = f"upper({std})" if _f.identifier else f"lower({std})" if c == "email" else std
            _texts.append(f"{std} AS {c}")
            _step(_name, "standardized string values", c,
                  _rows_where(f"bad_{_name}", f"coalesce({c}, '') <> coalesce({std}, '')"))
        parsed = _parse(_contract, c, c)
        kind = ("invalid date coerced to null" if _f in _contract.dates else "invalid number coerced to null"
                if _f in _contract.numbers else "invalid boolean coerced to null" if _f in _contract.flags else None)
        if kind:
            _step(_name, kind, c, _rows_where(f"s_{_name}", f"{c} IS NOT NULL AND ({parsed}) IS NULL"))
        if _f.domain:
            cases = " ".join(f"WHEN '{v.lower()}' THEN '{v}'" for v in _f.domain)
            parsed = f"CASE lower(trim({c})) {cases} END"
            _step(_name, "standardized category", c,
                  _rows_where(f"s_{_name}", f"coalesce({c}, '') <> coalesce({parsed}, '')"))
        _typed.append(f"{parsed} AS {c}")
    _columns = ", ".join(_contract.columns)
    _order = ", ".join(f"{c} NULLS FIRST" for c in _contract.columns)
    CLEAN[f"s_{_name}"] = f"\n  SELECT {', '.join(_texts)} FROM bad_{_name}"
    CLEAN[f"t_{_name}"] = f"\n  SELECT {', '.join(_typed)} FROM s_{_name}"
    CLEAN[f"u_{_name}"] = f"\n  SELECT DISTINCT {_columns} FROM t_{_name}"
    _key = _contract.key
    CLEAN[f"f_{_name}"] = (f"\n  SELECT {_columns} FROM (SELECT *, row_number() OVER (PARTITION BY {_key} ORDER BY {_order}) AS rn "
                           f"FROM u_{_name}) WHERE rn = 1 OR {_key} IS NULL")
    _step(_name, "removed duplicate rows", "", f"((SELECT count(*) FROM t_{_name}) - (SELECT count(*) FROM u_{_name}))")
    _step(_name, "removed duplicate primary keys", _key, f"((SELECT count(*) FROM u_{_name}) - (SELECT count(*) FROM f_{_name}))")
    _negative = [f.name for f in _contract.fields if f.nonnegative]
    for c in _negative:
        _step(_name, "invalid negative value set to null", c, _rows_where(f"f_{_name}", f"{c} < 0"))
    _cleared = ", ".join(f"CASE WHEN {c} >= 0 THEN {c} END AS {c}" if c in _negative else c for c in _contract.columns)
    CLEAN[f"n_{_name}"] = f"\n  SELECT {_cleared} FROM f_{_name}"
    _gone = " OR ".join(f"{c} IS NULL" for c in _contract.critical)
    _step(_name, "removed rows missing critical values", ", ".join(_contract.critical), _rows_where(f"n_{_name}", _gone))
    _described = [f.name for f in _contract.fields if f.type == TEXT and not f.critical]
    for c in _described:
        _step(_name, "filled missing descriptive values", c, _rows_where(f"n_{_name}", f"NOT ({_gone}) AND {c} IS NULL"))
    _filled = ", ".join(f"coalesce({c}, 'Unknown') AS {c}" if c in _described else c for c in _contract.columns)
    CLEAN[f"g_{_name}"] = f"\n  SELECT {_filled} FROM n_{_name} WHERE NOT ({_gone})"

CLEAN["r_sales"] = """
  SELECT * REPLACE (CASE WHEN abs(gross_profit - (p - vehicle_cost)) > 0.02 THEN p - vehicle_cost ELSE gross_profit END AS gross_profit)
  FROM (SELECT * REPLACE (CASE WHEN abs(sale_price - p) > 0.02 THEN p ELSE sale_price END AS sale_price) FROM (
    SELECT *, CASE WHEN abs(sale_price - (list_price - discount_amount)) > 0.02 THEN list_price - discount_amount
      ELSE sale_price END AS p FROM g_sales))"""
_step("sales", "recalculated sale_price", "", _rows_where("g_sales", "abs(sale_price - (list_price - discount_amount)) > 0.02"))
_step("sales", "recalculated gross_profit", "", _rows_where(
    "g_sales", "abs(gross_profit - (CASE WHEN abs(sale_price - (list_price - discount_amount)) > 0.02 THEN list_price - "
    "discount_amount ELSE sale_price END - vehicle_cost)) > 0.02"))
_AGE = "date_diff('day', acquired_date, snapshot_date)"
CLEAN["r_inventory"] = f"""
  SELECT * REPLACE ({_AGE} AS days_in_inventory, {_AGE} > 90 AS slow_moving_flag) FROM g_inventory WHERE acquired_date <= snapshot_date"""
_step("inventory", "removed rows with acquisition after snapshot", "", _rows_where("g_inventory", "acquired_date > snapshot_date"))
_step("inventory", "recalculated days_in_inventory", "",
      _rows_where("g_inventory", f"acquired_date <= snapshot_date AND days_in_inventory <> {_AGE}"))
_step("inventory", "recalculated slow_moving_flag", "",
      _rows_where("g_inventory", f"acquired_date <= snapshot_date AND slow_moving_flag <> ({_AGE} > 90)"))
_SUM = "labor_revenue + parts_revenue - discount_amount"
_IN_TIME = "opened_at <= promised_at AND opened_at <= completed_at"
CLEAN["r_service_orders"] = f"""
  SELECT * REPLACE (CASE WHEN abs(service_revenue - ({_SUM})) > 0.02 THEN {_SUM} ELSE service_revenue END AS service_revenue)
  FROM g_service_orders WHERE {_IN_TIME}"""
_step("service_orders", "removed rows with invalid timestamp order", "", _rows_where("g_service_orders", f"NOT ({_IN_TIME})"))
_step("service_orders", "recalculated service_revenue", "",
      _rows_where("g_service_orders", f"{_IN_TIME} AND abs(service_revenue - ({_SUM})) > 0.02"))
for _name in ("customers", "vehicles", "dealerships", "employees", "service_appointments"):
    CLEAN[f"r_{_name}"] = f"\n  SELECT * FROM g_{_name}"


def _settle(name: str, source: str, target: str, parents: dict[str, str]) -> None:
    """Drop orphans link by link, counting each link on what the previous one left."""
    current = source
    for child, column, parent, key in foreign_keys():
        if child != name or parent not in parents:
            continue
        known = f"{column} IN (SELECT {key} FROM {parents[parent]})"
        _step(name, "removed broken foreign-key rows", f"{column} -> {parent}.{key}",
              _rows_where(current, f"NOT coalesce({known}, false)"))
        step = f"{target}_{column}"
        CLEAN[step] = f"\n  SELECT * FROM {current} WHERE {known}"
        current = step
    CLEAN[target] = f"\n  SELECT * FROM {current}"


_PARENTS = {n: f"o_{n}" for n in ("customers", "vehicles", "dealerships", "employees", "service_appointments")}
for _name in DATASETS:
    _settle(_name, f"r_{_name}", f"o_{_name}", _PARENTS)
for _name in dict.fromkeys(link[0] for link in ROLE_LINKS):
    _current = f"o_{_name}"
    for _, _column, _role in [link for link in ROLE_LINKS if link[0] == _name]:
        _fits = f"{_column} IN (SELECT employee_id FROM o_employees WHERE role = '{_role}')"
        _step(_name, "removed rows with invalid employee role", f"{_column} requires {_role}",
              _rows_where(_current, f"NOT ({_fits})"))
        CLEAN[f"e_{_name}_{_column}"] = f"\n  SELECT * FROM {_current} WHERE {_fits}"
        _current = f"e_{_name}_{_column}"
    CLEAN[f"e_{_name}"] = f"\n  SELECT * FROM {_current}"
for c in SHARED_ORDER_COLUMNS:
    _step("service_orders", "reconciled value to appointment", c,
          f"(SELECT count(*) FILTER (coalesce(o.{c} <> v.{c}, true)) FROM e_service_orders o "
          "LEFT JOIN e_service_appointments v USING (appointment_id))")
CLEAN["w_service_orders"] = ("\n  SELECT o.* REPLACE (" + ", ".join(f"v.{c} AS {c}" for c in SHARED_ORDER_COLUMNS)
                             + ") FROM e_service_orders o LEFT JOIN e_service_appointments v USING (appointment_id)")
_step("inventory", "removed vehicles also present in sales", "",
      _rows_where("o_inventory", "vehicle_id IN (SELECT vehicle_id FROM e_sales)"))
CLEAN["z_inventory"] = "\n  SELECT * FROM o_inventory WHERE vehicle_id NOT IN (SELECT vehicle_id FROM e_sales)"
_EARLY = "sale_date < customer_since_date OR year(sale_date) < model_year - 1"
_DATED = "e_sales JOIN (SELECT customer_id, customer_since_date FROM o_customers) USING (customer_id) " \
         "JOIN (SELECT vehicle_id, model_year FROM o_vehicles) USING (vehicle_id)"
_step("sales", "removed rows with invalid relational dates", "", f"(SELECT count(*) FILTER ({_EARLY}) FROM {_DATED})")
CLEAN["z_sales"] = f"\n  SELECT {', '.join(DATASETS['sales'].columns)} FROM {_DATED} WHERE NOT ({_EARLY})"
_settle("service_orders", "w_service_orders", "z_service_orders", {"service_appointments": "e_service_appointments"})
for _name in ("customers", "vehicles", "dealerships", "employees"):
    CLEAN[f"z_{_name}"] = f"\n  SELECT * FROM o_{_name}"
CLEAN["z_service_appointments"] = "\n  SELECT * FROM e_service_appointments"


def audit(action: str | None = None) -> str:
    rows = "\n  UNION ALL ".join(
        f"SELECT '{d}' AS dataset, '{a}' AS action, {big(n)} AS affected_rows, '{t}' AS details"
        for d, a, t, n in STEPS if action is None or a == action)
    return _b(f"SELECT * FROM (\n  {rows}) WHERE affected_rows > 0")


def cleaned(name: str) -> str:
    contract, columns = DATASETS[name], []
    for f in contract.fields:
        c = f.name
        if f in contract.dates:
            columns.append(f"{instant(c) if f.type == INSTANT else day(c)} AS {c}")
        elif f in contract.numbers:
            columns.append(f"{c}::DOUBLE AS {c}")
        elif f in contract.flags:
            columns.append(f"{flag(c)} AS {c}")
        else:
            columns.append(c)
    return _b(f"SELECT {', '.join(columns)} FROM z_{name}")


# id -> audited action of each cleaning step
CLEANING_STEPS = {
    "cln_02_standardized_strings": "standardized string values",
    "cln_03_invalid_dates": "invalid date coerced to null",
    "cln_04_invalid_numbers": "invalid number coerced to null",
    "cln_05_invalid_booleans": "invalid boolean coerced to null",
    "cln_06_standardized_categories": "standardized category",
    "cln_07_duplicate_rows": "removed duplicate rows",
    "cln_08_duplicate_keys": "removed duplicate primary keys",
    "cln_09_negative_values": "invalid negative value set to null",
    "cln_10_missing_critical": "removed rows missing critical values",
    "cln_11_filled_descriptions": "filled missing descriptive values",
    "cln_12_sale_price": "recalculated sale_price",
    "cln_13_gross_profit": "recalculated gross_profit",
    "cln_14_acquired_after_snapshot": "removed rows with acquisition after snapshot",
    "cln_15_days_in_inventory": "recalculated days_in_inventory",
    "cln_16_slow_moving_flag": "recalculated slow_moving_flag",
    "cln_17_timestamp_order": "removed rows with invalid timestamp order",
    "cln_18_service_revenue": "recalculated service_revenue",
    "cln_19_orphans": "removed broken foreign-key rows",
    "cln_20_employee_roles": "removed rows with invalid employee role",
    "cln_21_follow_appointment": "reconciled value to appointment",
    "cln_22_sold_inventory": "removed vehicles also present in sales",
    "cln_23_relational_dates": "removed rows with invalid relational dates",
}
SQL: dict[str, str] = {
    **TABLES,
    "ld_10_constraints": CONSTRAINT_SQL,
    "ld_10_faulty_constraints": faulty_constraints(),
    "ld_11_row_reconciliation": ROWS_SQL,
    "prf_1_dataset_profile": _dataset_profile(),
    "prf_2_column_profile": _column_profile(),
    "prf_3_foreign_keys": _foreign_keys(),
    "prf_4_validation": _b(_validation()),
    "prf_5_outcome": _b(f"SELECT validation_errors + failed_foreign_keys AS error_count, "
                        f"(validation_errors + failed_foreign_keys = 0)::VARCHAR AS passed FROM ({_summary()})"),
    "prf_6_summary": _b(f"SELECT 8::BIGINT AS datasets_profiled, rows_profiled, "
                        f"{sum(len(d.columns) for d in DATASETS.values())}::BIGINT AS columns_profiled, validation_errors, "
                        f"failed_foreign_keys, CASE WHEN validation_errors + failed_foreign_keys = 0 THEN 'PASS' ELSE 'FAIL' END "
                        f"AS status FROM ({_summary()})"),
    **{name: audit(action) for name, action in CLEANING_STEPS.items()},
    "cln_24_audit": audit(),
    **{f"cln_24_cleaned_{name}": cleaned(name) for name in DATASETS},
}
