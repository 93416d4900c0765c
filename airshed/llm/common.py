"""Helpers shared by the operators: inputs, folds, bounded labelled samples,
Arrow column functions."""

from __future__ import annotations

from collections.abc import Callable
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from airshed.session import ship_package

#: Words are runs of anything but these characters (ASCII white space).
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch where the session has Spark's default of 10,000.
BATCH_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Ships the package to the workers, and holds Arrow batches to
    BATCH_ROWS rows: rows are whole texts here, and a batch is in memory
    several times (the executor's buffers, the worker's array, its result).
    A session that sets its own number of rows keeps it."""
    ship_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(mod).cast("bigint"))


def whole_text(col: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def column_function(make: Callable[[], Callable[[pa.Array], pa.Array]], returns: str):
    """A Spark column function that applies ``make()(array)`` to each Arrow
    batch; ``make`` runs once per task, so lookup tables are built once."""
    def batches(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        apply = make()
        for batch in it:
            yield apply(batch)
    return arrow_udf(batches, returns)


def text_bytes(batch: pa.Array):
    """The UTF-8 bytes of each text of a batch, null as empty."""
    for value in batch.cast(pa.binary()):
        yield value.as_py() or b""


def sample_labels(labels: DataFrame, label: str, mod: int, held_out: int, bound: int) -> DataFrame:
    """At most ``bound`` rows (doc_id, label) of the learning folds.

    Rows with a null id or label don't count; an id with several labels has
    its largest. Above the bound, rows are taken by a hash of the id, so the
    choice is the same in every run. The result has a proven size bound."""
    rows = (labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold(F.col("doc_id"), mod) != held_out)))
    n = max(1, rows.count())
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30))
    few = rows.where(place < int(min(1.0, 1.1 * bound / n) * (1 << 30)))
    return (few.groupBy("doc_id").agg(F.max("label").alias("label"))
            .orderBy(F.xxhash64(F.col("doc_id"), F.lit("sample")), "doc_id").limit(bound))


def labelled_rows(docs: DataFrame, sample: DataFrame, features: Column) -> DataFrame:
    """One row (label, features) per sampled document; of repeated ids, the
    smallest features. The sample is broadcast: its size is bounded."""
    hit = (docs.select("doc_id", whole_text().alias("text"))
           .join(F.broadcast(sample), "doc_id").select("doc_id", "label", features.alias("features")))
    return hit.groupBy("doc_id").agg(F.min(F.struct("label", "features")).alias("r")).select("r.label", "r.features")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))
