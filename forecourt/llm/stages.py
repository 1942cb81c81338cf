"""Written stages: cut lineage in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from forecourt.sources.store import shared_folder

Stage = Callable[[str, DataFrame], DataFrame]
Batch = TypeVar("Batch")


def released(batches: Iterator[Batch]) -> Iterator[Batch]:
    """The batches of a task; what Arrow holds unused goes back to the system after each."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task builds for one of them stays small."""
    return (batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows))


def raw_bytes(text: pa.Scalar) -> bytes:
    """The bytes of a text, valid UTF-8 or not; null is empty."""
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def added_up(sent: DataFrame, *key: str) -> DataFrame:
    """(key, z): the arrays ``z`` of a key and many tasks (key, task, z) added in the order of the tasks, while they stream by."""
    kinds = dict(sent.dtypes)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, names = None, None, [*key, "z"]
        for batch in batches:
            schema = pa.schema([batch.schema.field(c) for c in names])
            for of, z in zip(zip(*(batch.column(c).to_pylist() for c in key)), batch.column("z")):
                if of != now:
                    if now is not None:
                        yield pa.record_batch([[v] for v in (*now, total)], schema=schema)
                    now, total = of, np.zeros(len(z.values))
                total = total + z.values.to_numpy()
        if now is not None:
            yield pa.record_batch([[v] for v in (*now, total)], schema=schema)

    return sent.repartition(*key).sortWithinPartitions(*key, "task").mapInArrow(added, ", ".join(f"{c} {kinds[c]}" for c in (*key, "z")))


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``."""
    return f"{shared_folder(spark)}/forecourt-llm/{name}-{uuid.uuid4().hex[:12]}"


def dealt_table(spark: SparkSession, name: str, frame: DataFrame, column: str) -> DataFrame:
    """The frame written once, one file per bucket of a column; joins on that column read it without a shuffle.

    It has as many buckets as a shuffle has partitions, so the other side of a join meets it bucket by bucket.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_folder(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    frame.repartition(parts, column).write.format("parquet").option("compression", "zstd").option("path", path) \
        .bucketBy(parts, column).saveAsTable(table)
    return spark.table(table)


def written(spark: SparkSession, name: str) -> Stage:
    """A function that writes a frame once as parquet and returns the frame that reads it back."""
    root = new_folder(spark, name)
    made: list[str] = []

    def stage(step: str, frame: DataFrame) -> DataFrame:
        path = f"{root}/{len(made):03d}-{step}"
        made.append(path)
        schema = frame.schema
        frame.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(schema).parquet(path)

    return stage
