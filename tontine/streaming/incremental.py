"""Incremental upkeep of rollups with Structured Streaming.

Each micro-batch is rolled up on its own and the partial rollup is stored under its batch
number; reading merges the partial rollups. No state is kept between batches, however many
groups there are, and late rows are simply added. Rewriting a batch after a failure
overwrites the same folder, so every row counts exactly once.

Now and then finished batches are merged into one snapshot. A snapshot counts only once its
mark exists, which is made last; readers take the newest marked snapshot and the batches after
it, so a failure between these steps counts nothing twice. What a snapshot replaces is removed
afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tontine.operators.rollups import Rollup

# Batches between two snapshots.
COMPACT_EVERY = 100


def start(
    rollup: Rollup, rows: DataFrame, path: str, *, compact_every: int = COMPACT_EVERY, **trigger
) -> StreamingQuery:
    """Keep the rollup of a stream under ``path`` up to date.

    Rollup and progress both live below ``path``, which must be on shared storage. With no
    trigger given, everything available is processed and the query then stops.
    """

    def store(batch: DataFrame, number: int) -> None:
        partial = rollup.partial(batch)
        partial.write.mode("overwrite").parquet(f"{path}/partials/batch={number}")
        if (number + 1) % compact_every == 0:
            compact(rollup, batch.sparkSession, path, partial.schema)

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{path}/progress")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _numbers(spark: SparkSession, folder: str, needs: str = "") -> list[int]:
    """The numbers that end the names in a folder, of those that hold the file ``needs``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    paths = [status.getPath() for status in fs.listStatus(root)]
    found = [p for p in paths if not needs or fs.exists(jvm.org.apache.hadoop.fs.Path(p, needs))]
    return sorted(int(p.getName().split("=")[-1]) for p in found)


def _remove(spark: SparkSession, path: str) -> None:
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def _parts(spark: SparkSession, path: str) -> tuple[list[str], int, list[int]]:
    """The folders that make up the rollup, the newest snapshot, and the batches after it."""
    marked = _numbers(spark, f"{path}/marks")
    newest = marked[-1] if marked else -1
    later = [n for n in _numbers(spark, f"{path}/partials", "_SUCCESS") if n > newest]
    folders = [f"{path}/snapshots/upto={newest}"] if marked else []
    return folders + [f"{path}/partials/batch={n}" for n in later], newest, later


def partials(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    folders, _, _ = _parts(spark, path)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def snapshot(rollup: Rollup, spark: SparkSession, path: str, schema: T.StructType) -> int | None:
    """Merge everything finished into a new, marked snapshot; its number, or None if nothing is new."""
    folders, _, later = _parts(spark, path)
    if not later:
        return None
    merged = rollup.merge(spark.read.schema(schema).parquet(*folders))
    # Sums of sums are wider decimals; all parts are stored with the same types.
    merged = merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]).hint("rebalance")
    merged.write.mode("overwrite").parquet(f"{path}/snapshots/upto={later[-1]}")
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/marks/upto={later[-1]}")
    mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(mark)
    return later[-1]


def compact(rollup: Rollup, spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Merge the finished batches and remove what the newest snapshot replaces. Only one compaction of
    a path may run at a time; the stream itself is the natural caller."""
    snapshot(rollup, spark, path, schema)
    newest = _parts(spark, path)[1]
    for n in _numbers(spark, f"{path}/partials"):
        if n <= newest:
            _remove(spark, f"{path}/partials/batch={n}")
    for n in _numbers(spark, f"{path}/marks"):
        if n < newest:
            _remove(spark, f"{path}/marks/upto={n}")
    for n in _numbers(spark, f"{path}/snapshots"):
        if n < newest:
            _remove(spark, f"{path}/snapshots/upto={n}")


def current(rollup: Rollup, spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rollup of everything processed so far; ``schema`` is that of the partial rollups."""
    return rollup.finish(rollup.merge(partials(spark, path, schema)))


def partial_schema(rollup: Rollup, rows: DataFrame) -> T.StructType:
    return rollup.partial(rows.sparkSession.createDataFrame([], rows.schema)).schema


def run(rollup: Rollup, rows: DataFrame, path: str, *, compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Process what is available and return the resulting rollup."""
    start(rollup, rows, path, compact_every=compact_every).awaitTermination()
    return current(rollup, rows.sparkSession, path, partial_schema(rollup, rows))
