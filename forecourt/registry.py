"""The registered queries: operator id -> DataFrame over the warehouse of a data folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Mapping
from datetime import date
from decimal import Decimal
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.contracts import DATASETS
from forecourt.operators import constraints, measures, profile, quality, reconcile, scenarios
from forecourt.operators.clean import Once, Stage, cleaning, require_clean, run_all
from forecourt.operators.scoring import CheckFailure, require_all_pass, union_all
from forecourt.operators.warehouse import repair_unit_signs
from forecourt.plans import customer, inventory, model, pages, reporting, sales, service
from forecourt.plans.model import SemanticModel
from forecourt.plans.warehouse import DIMENSIONS, FACTS, Warehouse
from forecourt.sources import files
from forecourt.sources.faulty import faulty_dataset, faulty_star
from forecourt.sources.order_tables import read_order_tables
from forecourt.sources.store import TableStore, shared_folder, written_stages

_open: dict[tuple[str, str], Warehouse] = {}
_lock = threading.RLock()


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The written warehouse of a data folder; built table by table on first use, once per application."""
    key = (spark.sparkContext.applicationId, folder)
    with _lock:
        if key not in _open:
            staged = read_order_tables(spark, folder)
            # Row counts come from parquet footers and only size the buckets.
            sources = {"sales": "orders", "inventory": "lineitem", "service_appointments": "events",
                       "customers": "customer", "vehicles": "part"}
            rows = {name: spark.read.parquet(f"{folder}/{t}.parquet").count() for name, t in sources.items()}
            _open[key] = Warehouse(staged, TableStore.create(spark, shared_folder(spark) + "/forecourt", rows))
        return _open[key]


def portable(frame: DataFrame) -> DataFrame:
    """Amounts as DOUBLE, whole numbers as BIGINT, dates, times and flags as text."""

    def column(field: T.StructField):
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.BooleanType):
            c = c.cast("string")
        return c.alias(field.name)

    return frame.select([column(f) for f in frame.schema.fields])


Plan = Callable[[Warehouse], DataFrame]

VIEWS: dict[str, Plan] = {
    "v_sal_1_sales_detail": sales.detail,
    "v_sal_2_sales_kpis": sales.kpis,
    "v_sal_3_monthly_sales": sales.monthly,
    "v_sal_4_brand_model_performance": sales.brand_models,
    "v_sal_5_salesperson_performance": sales.salespeople,
    "v_sal_6_dealership_performance": sales.dealerships,
    "v_sal_7_vehicle_type_performance": sales.vehicle_types,
    "v_sal_8_payment_method_performance": sales.payment_methods,
    "v_inv_1_inventory_detail": inventory.detail,
    "v_inv_2_inventory_kpis": inventory.kpis,
    "v_inv_3_aging_buckets": inventory.aging_buckets,
    "v_inv_4_brand_model_inventory": inventory.brand_models,
    "v_inv_5_dealership_inventory": inventory.dealerships,
    "v_inv_6_slow_moving_vehicles": inventory.slow_moving,
    "v_svc_1_appointment_detail": service.detail,
    "v_svc_2_service_kpis": service.kpis,
    "v_svc_3_monthly_service": service.monthly,
    "v_svc_4_service_type_performance": service.service_types,
    "v_svc_5_dealership_service": service.dealerships,
    "v_svc_6_technician_performance": service.technicians,
    "v_cus_1a_sales_by_customer": customer.sales_by_customer,
    "v_cus_1b_service_by_customer": customer.service_by_customer,
    "v_cus_1c_warehouse_as_of": customer.as_of,
    "v_cus_1_lifetime_detail": customer.detail,
    "v_cus_2_customer_kpis": customer.kpis,
    "v_cus_3_segment_summary": customer.segment_summary,
    "v_cus_4_service_frequency": customer.service_frequency,
    "v_rep_1_sales_performance": reporting.sales_performance,
    "v_rep_2_inventory_aging": reporting.inventory_aging,
    "v_rep_3_service_performance": reporting.service_performance,
    "v_rep_4_customer_value": reporting.customer_value,
    "v_rep_5_dealership_performance": reporting.dealership_performance,
}


MODEL_CHECKS = (
    "dimension_key_uniqueness", "fact_grain_uniqueness", "required_foreign_keys_and_role_alignment",
    "inventory_composite_grain", "repair_order_unique_within_appointments",
    "service_status_enrichment_preserves_grain", "appointments_not_lost", "sales_eligible_rows_preserved",
    "inventory_rows_preserved", "calendar_source_unique_contiguous",
    "full_year_calendar_bounds_cover_event_dates", "calendar_bounds_available", "date_key_matches_date",
    "signed_return_values", "service_costs_not_fabricated", "slow_moving_and_bucket_boundaries",
)

CHECKS: dict[str, Plan] = {
    **{f"{i}_check": partial(quality.check, check_id=i) for i in quality.TEXTS},
    "dq_all_checks": quality.checks,
    "dq_faulty_checks": lambda w: quality.checks(faulty_star(w)),
    "rc_sal_sales": reconcile.sales_checks,
    "rc_inv_inventory": reconcile.inventory_checks,
    "rc_svc_service": reconcile.service_checks,
    "rc_cus_customers": reconcile.customer_checks,
    "rc_rep_reporting_views": reconcile.reporting_checks,
    "rc_mdl_star_model": reconcile.model_checks,
    **{f"md_{n:02d}_{name}": partial(reconcile.model_checks, only=name)
       for n, name in enumerate(MODEL_CHECKS, start=1)},
}


def _rounded(frame: DataFrame) -> DataFrame:
    """Unrounded quotients to 8 decimals, so that both engines can be compared exactly."""
    return frame.select([
        F.round(F.col(f.name), 8).alias(f.name)
        if isinstance(f.dataType, T.DecimalType) and f.dataType.scale > 8 else F.col(f.name)
        for f in frame.schema.fields
    ])


def _over_model(build: Callable[[SemanticModel], DataFrame]) -> Plan:
    return lambda w: _rounded(build(SemanticModel.narrow(w)))


MODEL: dict[str, Plan] = {
    **{f"mdl_{n:02d}_{name}": partial(model.model_table, name=name)
       for n, name in enumerate(model.TABLES, start=1)},
    **{f"k_{n:02d}_{name}": _over_model(partial(measures.measure, name=name))
       for n, name in enumerate(measures.CATALOGUE, start=1)},
    "k_all_kpis": _over_model(measures.kpis),
    **{name: _over_model(partial(measures.report, name=name)) for name in measures.REPORTS},
    "gq_18_drill_through": _over_model(measures.drill_through),
    "rc_alt_kpis": lambda w: _rounded(scenarios.alternate_kpis(w)),
    "rc_scn_scenarios": _over_model(scenarios.scenario_kpis),
}

# The KPI vector under one selection at a time.
CONTEXTS = {
    "ctx_1_dealership": measures.FilterContext(dealership=3),
    "ctx_2_brand": measures.FilterContext(brand="Brand#2"),
    "ctx_3_month": measures.FilterContext(start=date(2024, 1, 1), end=date(2024, 1, 31)),
    "ctx_4_unknown_brand": measures.FilterContext(brand="no such brand"),
    "ctx_5_before_first_snapshot": measures.FilterContext(end=date(1900, 1, 1)),
}
MODEL |= {name: _over_model(partial(measures.kpis, ctx=ctx)) for name, ctx in CONTEXTS.items()}

SALES_FILTER = {"date_from": date(1996, 1, 1), "date_to": date(1999, 6, 30),
                "payment_type": "Cash", "sale_status": "Completed"}
VISIT_FILTER = {"date_from": date(2024, 1, 5), "service_type": "Repair"}

PAGES: dict[str, Plan] = {
    **{f"pg_{n:02d}_{name}": partial(pages.page, name=name)
       for n, name in enumerate(("sales", "inventory", "service", "customers", "dealerships"), start=1)},
    "pg_06_sales_summary": partial(pages.sales_summary, **SALES_FILTER),
    "pg_07_sales_performance": partial(pages.page, name="sales_performance", limit=200, offset=50, **SALES_FILTER),
    "pg_08_inventory_aging": partial(pages.page, name="inventory_aging", limit=500, offset=20,
                                     date_from=date(1997, 1, 1), aging_bucket="91-120"),
    "pg_09_inventory_slow_moving": partial(pages.page, name="inventory_slow_moving", limit=300, brand="Brand#2"),
    "pg_10_service_revenue": partial(pages.service_revenue, **VISIT_FILTER),
    "pg_11_service_performance": partial(pages.page, name="service_performance", offset=10,
                                         appointment_status="Completed", **VISIT_FILTER),
    "pg_12_customer_value": partial(pages.page, name="customer_value", relationship_segment="Sales + Service",
                                    minimum_value=Decimal("100000")),
    "pg_13_dealership_performance": partial(pages.page, name="dealership_performance", region="ASIA",
                                            minimum_revenue=Decimal("0")),
    "pg_14_deep_page": partial(pages.page, name="sales_performance", limit=500, offset=12_000),
    "pg_15_after_page": lambda w: _after(w, "service", 900, 200),
}


def _after(w: Warehouse, name: str, seen: int, limit: int) -> DataFrame:
    """The page behind the first ``seen`` rows, found by the sort values of the last of them."""
    last = pages.page(w, name, limit=1, offset=seen - 1).first()
    return pages.page(w, name, limit=limit, after=tuple(last[c] for c, _ in pages.RESOURCES[name].order))


LOADED = (*DIMENSIONS, *FACTS)

LOAD: dict[str, Plan] = {
    **{f"ld_{n:02d}_{name}": (lambda w, name=name: w.table(name).drop("loaded_at"))
       for n, name in enumerate(LOADED, start=1)},
    "ld_10_constraints": constraints.violations,
    "ld_10_faulty_constraints": lambda w: constraints.violations(faulty_star(w)),
    "ld_11_row_reconciliation": constraints.row_reconciliation,
    "ld_12_repaired_unit_signs": lambda w: repair_unit_signs(
        w.table("fact_sales").withColumn("unit_quantity", F.lit(1).cast("smallint"))
    ).select("sale_id", "sale_status", "unit_quantity"),
}


class FaultyDatasets(Mapping):
    """The faulty datasets by name, each written when it is first asked for."""

    def __init__(self, w: Warehouse, stage: Stage):
        self._made = {name: Once(partial(self._written, w, stage, name)) for name in DATASETS}

    @staticmethod
    def _written(w: Warehouse, stage: Stage, name: str) -> DataFrame:
        return stage(f"faulty_{name}", faulty_dataset(name, w.table(name)))

    def __getitem__(self, name: str) -> DataFrame:
        return self._made[name]()

    def __iter__(self):
        return iter(self._made)

    def __len__(self) -> int:
        return len(self._made)


class Faulty:
    """The faulty datasets of a folder, written once, and the cleaning run over them."""

    def __init__(self, w: Warehouse):
        self._stage = written_stages(w.table("customers").sparkSession)
        self.datasets = FaultyDatasets(w, self._stage)
        self.cleaning = cleaning(self.datasets, stage=self._stage)
        self._cleaned: tuple[dict[str, DataFrame], DataFrame] | None = None

    @property
    def cleaned(self) -> tuple[dict[str, DataFrame], DataFrame]:
        if self._cleaned is None:
            tables, audit = run_all(self.cleaning)
            self._cleaned = tables, self._stage("audit", audit)
        return self._cleaned

    def audited(self, action: str) -> DataFrame:
        """The audit of one action."""
        if self._cleaned is None:
            return self.cleaning.audit(action)
        return self._cleaned[1].where(F.col("action") == action)

    @property
    def validation(self) -> DataFrame:
        return profile.validation_report(self.datasets)

    @property
    def relations(self) -> DataFrame:
        return profile.foreign_key_report(self.datasets)


_faulty: dict[int, Faulty] = {}


def _broken(w: Warehouse) -> Faulty:
    with _lock:
        if id(w) not in _faulty:
            _faulty[id(w)] = Faulty(w)
        return _faulty[id(w)]


# The audited action of each cleaning step.
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

SOURCES: dict[str, Plan] = {
    "prf_1_dataset_profile": lambda w: profile.dataset_profile(_broken(w).datasets),
    "prf_2_column_profile": lambda w: profile.column_profile(_broken(w).datasets),
    "prf_3_foreign_keys": lambda w: _broken(w).relations,
    "prf_4_validation": lambda w: _broken(w).validation,
    "prf_5_outcome": lambda w: profile.outcome(_broken(w).validation, _broken(w).relations),
    "prf_6_summary": lambda w: profile.summary(_broken(w).datasets, _broken(w).validation, _broken(w).relations),
    **{name: (lambda w, action=action: _broken(w).audited(action))
       for name, action in CLEANING_STEPS.items()},
    "cln_24_audit": lambda w: _broken(w).cleaned[1],
    **{f"cln_24_cleaned_{name}": (lambda w, name=name: _whole_as_double(name, _broken(w).cleaning.table(name)))
       for name in DATASETS},
}


class Files:
    """Text files written from the datasets of a folder, once, and what is read back from them."""

    def __init__(self, w: Warehouse):
        self.w, self.spark = w, w.table("customers").sparkSession
        self.root = f"{shared_folder(self.spark)}/forecourt/files-{uuid.uuid4().hex[:12]}"

    @cached_property
    def plain(self) -> str:
        files.write_datasets(self.w.sources(), f"{self.root}/plain")
        return f"{self.root}/plain"

    @cached_property
    def cleaned(self) -> str:
        tables, audit = _broken(self.w).cleaned
        files.write_datasets(tables, f"{self.root}/cleaned")
        files.write_audit(audit, f"{self.root}/cleaned")
        return f"{self.root}/cleaned"

    @cached_property
    def reports(self) -> dict[str, object]:
        return files.profile_folder(self.spark, self.plain, f"{self.root}/reports")

    @cached_property
    def published(self) -> Warehouse:
        for name in (*DIMENSIONS, *FACTS):
            self.w.table(name)
        self.w.store.publish([*DIMENSIONS, *FACTS])
        return Warehouse.current(self.spark, self.w.store.root)

    @cached_property
    def model(self) -> dict[str, str]:
        return files.export_model(model.exported(self.w), f"{self.root}/model")

    @cached_property
    def staged(self) -> dict[str, DataFrame]:
        return files.stage_datasets(self.spark, self.plain, f"{self.root}/staging")

    def read_csv(self, path: str) -> DataFrame:
        return self.spark.read.option("header", True).csv(path)


_files: dict[int, Files] = {}


def _written(w: Warehouse) -> Files:
    with _lock:
        return _files.setdefault(id(w), Files(w))


def _sizes(tables: dict[str, DataFrame], label: str = "dataset") -> DataFrame:
    return union_all([
        frame.agg(F.lit(name).alias(label), F.count("*").alias("rows"), F.lit(len(frame.columns)).alias("columns"))
        for name, frame in tables.items()])


def _staged_blanks(w: Warehouse) -> DataFrame:
    """Rows, NULL cells and load times per staged dataset."""
    parts = []
    for name, frame in _written(w).staged.items():
        nulls = [F.col(c).isNull().cast("bigint") for c in DATASETS[name].columns]
        parts.append(frame.agg(F.lit(name).alias("dataset"), F.count("*").alias("rows"),
                               F.sum(sum(nulls, F.lit(0))).alias("null_cells"), F.count("loaded_at").alias("loaded")))
    return union_all(parts)


def _hashed(w: Warehouse) -> DataFrame:
    work = _written(w)
    manifest = files.input_manifest(work.spark, work.plain)
    complete = F.count_if((F.length("sha256") == 64) & (F.col("size_bytes") > 0)) == F.count("*")
    return manifest.groupBy("dataset").agg(complete.alias("hashed"))


def _model_sizes(w: Warehouse) -> DataFrame:
    work = _written(w)
    return _sizes({n: work.spark.read.parquet(path) for n, path in work.model.items()}, "table")


FILES: dict[str, Plan] = {
    "src_1_load_datasets": lambda w: _sizes(files.load_datasets(_written(w).spark, _written(w).plain)),
    "src_2_preflight_rows": lambda w: files.row_counts(files.load_datasets(_written(w).spark, _written(w).plain)),
    "src_3_whole_numbers": lambda w: files.whole_number_errors(_broken(w).datasets),
    "src_4_staging": _staged_blanks,
    "src_5_manifest": _hashed,
    "snk_1_cleaned_files": lambda w: _sizes({
        name: frame for name, frame in files.load_datasets(_written(w).spark, _written(w).cleaned).items()
        if name in DATASETS}),
    "snk_2_cleaning_audit": lambda w: _written(w).read_csv(f"{_written(w).cleaned}/cleaning_summary.csv").select(
        "dataset", "action", F.col("affected_rows").cast("bigint"), F.coalesce("details", F.lit("")).alias("details")),
    "snk_3_profile_reports": lambda w: _written(w).read_csv(_written(w).reports["reports"]["validation_report"]).select(
        "dataset", "check", F.col("invalid_count").cast("bigint"), "status"),
    "snk_4_published_warehouse": lambda w: _sizes(
        {name: _written(w).published.table(name) for name in (*DIMENSIONS, *FACTS)}, "table"),
    "snk_5_model_export": _model_sizes,
}

def _outcome(w: Warehouse, gate: Callable[[], object]) -> DataFrame:
    """What a gate says: its result, or the reason for which it stops."""
    try:
        said = f"passed: {gate()}"
    except (files.SourceError, CheckFailure) as stop:
        said = str(stop)
    return w.table("customers").sparkSession.createDataFrame([(said,)], "outcome string")


GATES: dict[str, Plan] = {
    "src_2_preflight_gate": lambda w: _outcome(w, lambda: files.check_datasets(_broken(w).datasets)),
    "cln_25_clean_gate": lambda w: _outcome(w, lambda: require_clean(_broken(w).datasets)),
    "dq_g_quality_gate": lambda w: _outcome(w, lambda: require_all_pass(quality.checks(w), "data_quality")),
}

RECONCILED: dict[str, Plan] = {
    "rc_rel_relationships": lambda w: model.relationship_errors(SemanticModel.of(w)),
    "rc_grn_grains": lambda w: model.grain_errors(SemanticModel.narrow(w)),
    "rc_cmp_scenarios": lambda w: _rounded(scenarios.scenario_comparison(w)),
    "rc_all_suites": reconcile.suite_summary,
}


def _whole_as_double(name: str, frame: DataFrame) -> DataFrame:
    """Every numeric column as DOUBLE, whatever its width."""
    return frame.withColumns({f.name: F.col(f.name).cast("double") for f in DATASETS[name].numbers})


def plans() -> dict[str, Plan]:
    return {**LOAD, **VIEWS, **CHECKS, **MODEL, **PAGES, **SOURCES, **FILES, **GATES, **RECONCILED}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(plan: Plan):
        return lambda spark, folder: portable(plan(warehouse(spark, folder)))

    return {name: bind(plan) for name, plan in plans().items()}


def oracle_sql() -> dict[str, str]:
    from forecourt.oracle import checks, files, load, views
    from forecourt.oracle import model as model_sql

    return {**load.SQL, **views.SQL, **checks.SQL, **model_sql.SQL, **files.SQL}
