"""Read and write the three tables: Parquet or CSV, local paths or object stores.

Paths may be globs and may use any scheme Hadoop knows (``s3a://bucket/claims/*.parquet``);
credentials come from the Hadoop configuration. Scans are distributed by Spark.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tontine.functions import calendar_month
from tontine.schemas import TABLES
from tontine.session import ADVISORY

# CSV as spreadsheet tools write it: JSON text is quoted, inner quotes are doubled. With a mark for
# missing values, quoted empty text stays text; a blank field is read as missing as well.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "nullValue": "\\N"}

# Shuffled bytes of the rows of a file, where a table has partitions; the session's tasks are smaller.
FILE_BYTES = "64m"

# How each table is laid out: partition columns, and the sort order inside a file, which
# gives the row-group statistics something to skip on.
LAYOUT = {
    "policies": (["effective_month"], ["line_of_business", "geography", "policy_id"]),
    "claims": (["accident_year"], ["line_of_business", "geography", "development_month", "claim_id"]),
    "reserves": ([], ["line_of_business", "geography", "cohort_year", "valuation_date"]),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to the declared schema. Equal types stay untouched, so filters on
    them still reach the scan; a value that cannot be cast is an error."""
    return df.selectExpr(*[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in schema])


def read_table(spark: SparkSession, table: str, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    if fmt == "parquet":
        raw = spark.read.parquet(*paths)
    elif fmt == "csv":
        raw = spark.read.options(**CSV_OPTIONS).csv(paths)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return conform(raw, TABLES[table])


def read_footers(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A stored Parquet table through Spark's second reader, which answers ``count``, ``min`` and ``max`` (of numbers and
    dates, by partition columns or of the whole table) from the files' footers. What it reads for them grows with the
    number of files, not of rows. Needs the settings of ``session.configure``."""
    name = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(name)
    spark.conf.set(name, ",".join(x for x in before.split(",") if x.strip() != "parquet"))
    try:
        found = spark.read.parquet(path)
    finally:
        spark.conf.set(name, before)
    return conform(found, TABLES[table])


class StoredSize(NamedTuple):
    files: int
    bytes: int


def stored_size(spark: SparkSession, path: str) -> StoredSize:
    """The number of data files below a path, and their bytes."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    found, files, size = root.getFileSystem(conf).listFiles(root, True), 0, 0
    while found.hasNext():
        status = found.next()
        if not status.getPath().getName().startswith(("_", ".")):
            files, size = files + 1, size + status.getLen()
    return StoredSize(files, size)


def read_table_stream(
    spark: SparkSession,
    table: str,
    path: str,
    *,
    max_bytes_per_trigger: int = 256 * 1024**3,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New Parquet files of a table as a stream. A micro-batch is bounded by the bytes (or
    by the number of files) it takes, also when a large backlog is waiting. The files' own
    types are cast to the declared ones, as in a batch."""
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException:  # no file yet: what comes must have the declared types
        found = TABLES[table]
    reader = spark.readStream.schema(found)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return conform(reader.parquet(path), TABLES[table])


def write_bucketed(df: DataFrame, name: str, path: str, *, key: str = "policy_id", buckets: int = 64) -> DataFrame:
    """Store the rows as the catalogue's table ``name`` under ``path``, in buckets of ``key``, and read them back.

    Tables with the same key and number of buckets are joined on it, and grouped by it, without a shuffle: the
    shuffle was paid once, here. Each bucket is one sorted file; take a number that lets a bucket fit in a task.
    """
    rows = df.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def write_table(
    df: DataFrame,
    table: str,
    path: str,
    fmt: str = "parquet",
    mode: str = "append",
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Append (or overwrite) rows of a table in its layout. ``mode='replace_partitions'`` replaces the
    partitions that the rows belong to and leaves the others, so a load of whole partitions can be repeated.

    The rebalance hint lets the adaptive planner merge small partitions and split a
    partition value that holds much of the data, so files come out evenly sized.

    With ``finish``, ``df`` has what the rows are derived from, and the columns of the layout. These are moved and
    sorted, and ``finish`` gives the rows from them where they are written; it must take the partition columns over.
    """
    partitions, order = LAYOUT[table]
    rows = df if finish else conform(df, TABLES[table])
    if fmt == "csv":
        rows = conform(finish(rows), TABLES[table]) if finish else rows
        rows.write.mode(mode).options(**CSV_OPTIONS).csv(path)
        return
    if "effective_month" in partitions:
        rows = rows.withColumn("effective_month", calendar_month("effective_date"))
    laid_out = rows.hint("rebalance", *[F.col(c) for c in partitions])
    if mode == "replace_partitions" and not partitions:
        raise ValueError(f"{table} has no partitions")
    laid_out = laid_out.sortWithinPartitions(*partitions, *order)
    if finish:
        laid_out = conform(finish(laid_out), TABLES[table])
    writer = laid_out.write
    if mode == "replace_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer = writer.option("compression", "snappy")
    if not partitions:
        writer.parquet(path)
        return
    spark = df.sparkSession
    before = spark.conf.get(ADVISORY)
    spark.conf.set(ADVISORY, FILE_BYTES)
    try:
        writer.partitionBy(*partitions).parquet(path)
    finally:
        spark.conf.set(ADVISORY, before)
