"""What the text operators share: column checks, stored intermediates, held-out splits."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.session import scratch_path

#: White space and words as the contracts define them (ASCII only).
SPACE = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Spark this package's source once a session, so that Python workers on any machine can
    import it. The driver serves the file; nothing has to be installed on the executors."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    file = os.path.join(tempfile.mkdtemp(prefix="tontine-code-"), "tontine_code.zip")
    with zipfile.ZipFile(file, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(file)
    _SHIPPED.add(context.applicationId)


#: Has Spark remove an execution's shuffle files at its end, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back. Later readers survive
    the loss of executors, and nothing above is computed twice. What was shuffled for it is removed."""
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove what ``stored`` wrote, once nothing reads these rows any more."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).getParent()
        folder.getFileSystem(conf).delete(folder, True)


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL for a missing id."""
    return F.crc32(F.col(id_col).cast("string")) % divisor


def held_out(id_col: str, divisor: int, rest: int) -> Column:
    """Rows kept out of training. A row without an id is never trained on."""
    return F.coalesce(remainder(id_col, divisor) == rest, F.lit(True))


def narrow(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only the id and the text (NULL: empty) of the rows, as ``id`` and ``text``. Other columns,
    whatever their names, go no further."""
    ship(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more
    )


#: Bytes of rows that a function gets as Python objects at once, unless a single row is longer.
AT_ONCE = 8 << 20


def rows_of(batches: Iterator[pa.RecordBatch], most: int = AT_ONCE) -> Iterator[dict[str, list]]:
    """Arrow batches as dictionaries of Python lists, cut so that each holds about ``most`` bytes."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(batch.nbytes, 1))
        for first in range(0, batch.num_rows, step):
            yield batch.slice(first, step).to_pydict()


#: Session settings under which a task holds a few megabytes of rows at once, in the JVM and in its Python worker. Spark's
#: own (10,000 rows or 64 MB to Python, 4,096 rows from Parquet) let whole texts fill tens of megabytes several times over:
#: the reader's columns, the Arrow buffers that double as they grow, and the worker's copy. A longer row goes alone.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}


def small_batches(spark: SparkSession) -> None:
    """Have the session read rows and pass them to Python in small batches. No result depends on the size."""
    for key, value in SMALL_BATCHES.items():
        spark.conf.set(key, value)


def arrow_fold(
    df: DataFrame, schema: str, function: Callable[[Iterator[dict[str, list]]], dict[str, list]], most: int = AT_ONCE
) -> DataFrame:
    """Apply ``function`` to all the rows of a task, given piece by piece; it returns columns once."""
    ship(df.sparkSession)
    wanted = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield as_batch(function(rows_of(batches, most)), wanted)

    return df.mapInArrow(run, wanted)


def as_batch(columns: dict[str, list], wanted) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(wanted)
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)


def arrow_map(
    df: DataFrame, schema: str, function: Callable[[dict[str, list]], dict[str, list]], most: int = AT_ONCE
) -> DataFrame:
    """Apply ``function`` to the columns of the rows, piece by piece; it returns the columns of ``schema``."""
    ship(df.sparkSession)
    wanted = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in rows_of(batches, most):
            yield as_batch(function(columns), wanted)

    return df.mapInArrow(run, wanted)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
