"""Twins of the file queries and of the model-level reconciliation."""

from __future__ import annotations

from forecourt.contracts import DATASETS
from forecourt.operators.measures import KPI_VECTOR
from forecourt.oracle import checks, load, model
from forecourt.oracle.base import big, build
from forecourt.plans.model import GRAINS, RELATIONSHIPS

WAREHOUSE = {
    "dim_date": ("days", 12), "dim_dealership": ("dealers", 11), "dim_customer": ("buyers", 14), "dim_vehicle": ("cars", 12),
    "dim_employee": ("people", 11), "dim_service": ("kinds", 4), "fact_sales": ("fsales", 17), "fact_inventory": ("fstock", 12),
    "fact_service": ("fservice", 23),
}
EXPORTED = {
    "dim_date": ("cal", 10), "dim_snapshot_date": ("cal", 10), "dim_customer": ("buyers", 10), "dim_vehicle": ("cars", 9),
    "dim_dealership": ("dealers", 8), "dim_service": ("kinds", 4),
    "dim_salesperson": ("(SELECT * FROM people WHERE role = 'Sales Consultant')", 9),
    "dim_service_advisor": ("(SELECT * FROM people WHERE role = 'Service Advisor')", 9),
    "dim_technician": ("(SELECT * FROM people WHERE role = 'Service Technician')", 9),
    "fact_sales": ("sd", 16), "fact_inventory": ("idt", 14), "fact_service": ("vd", 33),
}


def _sizes(sources: dict[str, tuple[str, int]], label: str, known: dict[str, str]) -> str:
    return build("\n  UNION ALL ".join(
        f"SELECT '{n}' AS \"{label}\", count(*) AS rows, {c}::BIGINT AS columns FROM {t}" for n, (t, c) in sources.items()), known)


PLAIN = {n: (f"plain_{n}", len(d.columns)) for n, d in DATASETS.items()}
CLEANED = {n: (f"z_{n}", len(d.columns)) for n, d in DATASETS.items()}


def _nulls() -> str:
    rows = []
    for n, d in DATASETS.items():
        cells = " + ".join(f"(nullif({c}, '') IS NULL)::BIGINT" for c in d.columns)
        rows.append(f"SELECT '{n}' AS dataset, count(*) AS rows, {big(f'sum({cells})')} AS null_cells, count(*) AS loaded "
                    f"FROM plain_{n}")
    return build("\n  UNION ALL ".join(rows), load.CLEAN)


WHOLE = (("vehicles", "model_year", 32767), ("vehicles", "mileage_at_acquisition", 2147483647),
         ("inventory", "days_in_inventory", 2147483647))
WHOLE_SQL = build("\n  UNION ALL ".join(
    f"SELECT '{n}.{c}' AS \"column\", count(*) FILTER (TRY_CAST({c} AS DOUBLE) IS NULL OR TRY_CAST({c} AS DOUBLE) < 0 OR "
    f"TRY_CAST({c} AS DOUBLE) > {top} OR TRY_CAST({c} AS DOUBLE) <> floor(TRY_CAST({c} AS DOUBLE))) AS invalid_count FROM bad_{n}"
    for n, c, top in WHOLE), load.CLEAN)

# The profile reports of the plain files: the same rules with the plain datasets in place of the faulty ones.
_PLAIN_RULES = {**load.CLEAN, **{f"bad_{n}": f"\n  SELECT {', '.join(d.columns)} FROM plain_{n}" for n, d in DATASETS.items()}}
# Files hold the unchanged sales, so the vehicle replacement of the faulty copy does not apply.
_PLAIN_RULES["plain_sales"] = f"\n  {load.TEXT_SOURCES['sales']}"
PLAIN_REPORT = build('SELECT dataset, "check", invalid_count, status FROM (' + load._validation() + ")", _PLAIN_RULES)

_DATE = "strftime({}, '%Y%m%d')::BIGINT".format
ONE_SIDE = {
    "dim_date.date_key": _DATE("d") + " AS k FROM cal", "dim_snapshot_date.date_key": _DATE("d") + " AS k FROM cal",
    "dim_date.full_date": "d AS k FROM cal", "dim_customer.customer_key": "customer_key AS k FROM buyers",
    "dim_vehicle.vehicle_key": "vehicle_key AS k FROM cars", "dim_dealership.dealership_key": "dealership_key AS k FROM dealers",
    "dim_salesperson.employee_key": "employee_key AS k FROM people WHERE role = 'Sales Consultant'",
    "dim_service_advisor.employee_key": "employee_key AS k FROM people WHERE role = 'Service Advisor'",
    "dim_technician.employee_key": "employee_key AS k FROM people WHERE role = 'Service Technician'",
    "dim_service.service_key": "service_key AS k FROM kinds",
}
MANY_SIDE = {
    "sale_date_key": _DATE("sale_date"), "snapshot_date_key": "snap", "acquired_date_key": _DATE("acquired_date"),
    "appointment_date_key": _DATE("appointment_date"), "completed_date_key": _DATE("completed_at"),
    "opened_date_key": _DATE("opened_at"), "promised_date_key": _DATE("promised_at"),
}
FACTS = {"fact_sales": "sd", "fact_inventory": "idt", "fact_service": "vd", "dim_customer": "buyers"}


def _relationships() -> str:
    rows = []
    for dim, key, fact, column in RELATIONSHIPS:
        one = f"(SELECT {ONE_SIDE[f'{dim}.{key}']})"
        many = f"(SELECT {MANY_SIDE.get(column, column)} AS k FROM {FACTS[fact]})"
        rows.append(
            f"SELECT '{dim}.{key} -> {fact}.{column}' AS relationship, (SELECT count(*) FROM (SELECT k FROM {one} GROUP BY k "
            f"HAVING count(*) > 1 OR k IS NULL)) AS dimension_errors, (SELECT count(*) FROM {many} WHERE k IS NOT NULL "
            f"AND k NOT IN (SELECT k FROM {one})) AS orphan_rows")
    return build("\n  UNION ALL ".join(rows), model.CTX)


def _grains() -> str:
    keys = {**{f: k for f, k in GRAINS.items()}}
    sql_keys = {"fact_inventory": "vehicle_key, dealership_key, snap"}
    rows = [
        f"SELECT '{f}({', '.join(k)})' AS grain, (SELECT count(*) FROM (SELECT 1 FROM {FACTS[f]} GROUP BY "
        f"{sql_keys.get(f, ', '.join(k))} HAVING count(*) > 1)) AS repeated_keys, 0::BIGINT AS null_rows" for f, k in keys.items()]
    rows.append("SELECT 'fact_service(service_order_id)', count(service_order_id) - count(DISTINCT service_order_id), 0 FROM vd")
    return build("\n  UNION ALL ".join(rows))


def _suites() -> str:
    suites = {"data_quality": "dq_all_checks", "sales": "rc_sal_sales", "inventory": "rc_inv_inventory",
              "service": "rc_svc_service", "customers": "rc_cus_customers", "reporting_views": "rc_rep_reporting_views",
              "star_model": "rc_mdl_star_model"}
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS suite, count(*) AS checks, count(*) FILTER (status <> 'PASS') AS not_passed FROM (\n{checks.SQL[q]}\n)"
        for n, q in suites.items())


_FAILED = "(SELECT count(*) FROM (\n{}\n) WHERE status <> 'PASS')".format
GATES = {
    "src_2_preflight_gate": "SELECT string_agg(\"column\", ', ' ORDER BY \"column\") || ' must contain valid whole numbers' "
                            f"AS outcome FROM (\n{WHOLE_SQL}\n) WHERE invalid_count > 0",
    "cln_25_clean_gate": f"SELECT 'cleaned datasets failed ' || {_FAILED(load.SQL['prf_4_validation'])} || ' checks and ' || "
                         f"{_FAILED(load.SQL['prf_3_foreign_keys'])} || ' foreign keys' AS outcome",
    "dq_g_quality_gate": f"SELECT 'passed: ' || count(*) AS outcome FROM (\n{checks.SQL['dq_all_checks']}\n)",
}

SQL: dict[str, str] = {
    **GATES,
    "src_1_load_datasets": _sizes(PLAIN, "dataset", load.CLEAN),
    "src_2_preflight_rows": build("\n  UNION ALL ".join(
        f"SELECT '{n}' AS dataset, count(*) AS rows FROM plain_{n}" for n in DATASETS), load.CLEAN),
    "src_3_whole_numbers": WHOLE_SQL,
    "src_4_staging": _nulls(),
    "src_5_manifest": build("\n  UNION ALL ".join(
        f"SELECT '{n}' AS dataset, (count(*) > 0)::VARCHAR AS hashed FROM plain_{n}" for n in DATASETS), load.CLEAN),
    "snk_1_cleaned_files": _sizes(CLEANED, "dataset", load.CLEAN),
    "snk_2_cleaning_audit": load.audit(),
    "snk_3_profile_reports": PLAIN_REPORT,
    "snk_4_published_warehouse": _sizes(WAREHOUSE, "table", {}),
    "snk_5_model_export": _sizes(EXPORTED, "table", model.CTX),
    "rc_rel_relationships": _relationships(),
    "rc_grn_grains": _grains(),
    "rc_cmp_scenarios": "SELECT scenario, kpi, v AS expected, v AS actual, v - v AS difference, 'PASS' AS status FROM (\n"
                        f"SELECT scenario, unnest([{', '.join(repr(k) for k in KPI_VECTOR)}]) AS kpi, "
                        f"unnest([{', '.join(f'{k}::DOUBLE' for k in KPI_VECTOR)}]) AS v FROM (\n{model.SWEEP_SQL}\n))",
    "rc_all_suites": _suites(),
}
