"""The gated batch: manifest, preflight, staging, load, quality gate, publication."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from forecourt.contracts import DATASETS, Dataset
from forecourt.operators.clean import clean_datasets, require_clean
from forecourt.operators.constraints import require_constraints, require_row_counts
from forecourt.operators.quality import checks
from forecourt.operators.scoring import require_all_pass
from forecourt.plans.warehouse import DETAILS, DIMENSIONS, FACTS, Warehouse
from forecourt.sources.files import (
    input_manifest,
    load_datasets,
    preflight,
    require_staged_rows,
    require_unchanged,
    stage_datasets,
    write_audit,
    write_datasets,
)
from forecourt.sources.store import LAYOUTS, TableStore


@dataclass(frozen=True)
class LoadResult:
    source_rows: dict[str, int]
    warehouse_rows: dict[str, int]
    quality_checks: int
    version: str


def clean_folder(spark: SparkSession, raw: str, target: str,
                 contracts: dict[str, Dataset] | None = None) -> tuple[dict[str, str], str]:
    """Read raw files, clean, gate, and write cleaned files plus the audit."""
    cleaned, audit = clean_datasets(load_datasets(spark, raw, with_order=True), contracts)
    require_clean(cleaned, contracts)
    return write_datasets(cleaned, target), write_audit(audit, target)


def load_folder(spark: SparkSession, processed: str, root: str, contracts: dict[str, Dataset] | None = None,
                as_of=None) -> LoadResult:
    """Load cleaned files into a new version and publish it only when every gate passes.

    A failed gate leaves the previously published version in place.
    """
    manifest = input_manifest(spark, processed)
    manifest_path = f"{root.rstrip('/')}/_manifests"
    rows = preflight(spark, processed, contracts)
    store = TableStore.create(spark, root, rows)
    manifest.write.parquet(f"{manifest_path}/{store.version}")
    recorded = spark.read.parquet(f"{manifest_path}/{store.version}")

    require_unchanged(spark, processed, recorded)
    staged = stage_datasets(spark, processed, f"{store.path}/_staging")
    require_staged_rows(rows, staged)
    w = Warehouse({name: frame.drop("loaded_at") for name, frame in staged.items()}, store)
    require_unchanged(spark, processed, recorded)

    loaded = require_row_counts(w.load([*DIMENSIONS, *FACTS]))
    require_constraints(w)
    passed = require_all_pass(checks(w, as_of), "data_quality")
    tables = [*[n for n in DATASETS if n in LAYOUTS], *DIMENSIONS, *FACTS, *DETAILS]
    w.load(tables)
    store.publish(tables)
    return LoadResult(rows, loaded, passed, store.version)
