"""Loads that can be repeated: each has a name, and its rows count once however often it runs or fails.

An attempt writes the rows into a folder of its own, in the table's layout. When all files are there, the load's
mark is created, which names the attempt; creating it is a single step that only one attempt can win. Readers see
marked attempts only, so a load that failed half-way shows nothing, and one that is run again after it succeeded
writes nothing. This needs no rename, so it holds on object stores that create a file only if it is missing.
"""

from __future__ import annotations

import re
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from tontine.schemas import TABLES
from tontine.sources.tables import conform, write_table


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its class of paths."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf), jvm.org.apache.hadoop.fs.Path


def _folder_name(load: str) -> str:
    if not load:
        raise ValueError("a load needs a name")
    return quote(load, safe="").replace(".", "%2E")


def attempts(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of the attempt that counts, for each finished load."""
    fs, to_path = _fs(spark, path)
    marks = to_path(f"{path}/marks")
    if not fs.exists(marks):
        return {}
    found = {}
    for status in fs.listStatus(marks):
        stream = fs.open(status.getPath())
        try:
            attempt = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        name = status.getPath().getName()
        found[name] = f"{path}/data/load={name}/attempt={attempt}"
    return found


def _mark(spark: SparkSession, path: str, name: str, attempt: str) -> bool:
    """Create the load's mark; False if there is one already."""
    fs, to_path = _fs(spark, path)
    fs.mkdirs(to_path(f"{path}/marks"))
    try:
        stream = fs.create(to_path(f"{path}/marks/{name}"), False)
    except Exception as error:  # Hadoop says in its own words that the file exists
        if fs.exists(to_path(f"{path}/marks/{name}")):
            return False
        raise error
    stream.write(bytearray(attempt.encode()))
    stream.close()
    return True


def load(df: DataFrame, table: str, path: str, name: str) -> bool:
    """Add the rows to the table under ``path`` as the load ``name``. True if this call did it, False if the
    load was there already, whatever its rows."""
    spark, folder = df.sparkSession, _folder_name(name)
    if folder in attempts(spark, path):
        return False
    attempt = uuid.uuid4().hex
    write_table(df, table, f"{path}/data/load={folder}/attempt={attempt}")
    return _mark(spark, path, folder, attempt)


def read_loads(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The rows of all finished loads. Partition filters and pushed filters work as on a plain table."""
    folders = sorted(attempts(spark, path).values())
    if not folders:
        return spark.createDataFrame([], TABLES[table])
    return conform(spark.read.option("basePath", f"{path}/data").parquet(*folders), TABLES[table])


def remove_unfinished(spark: SparkSession, path: str) -> int:
    """Remove the files of attempts that don't count and return how many attempts that were. No load of this
    path may be running."""
    fs, to_path = _fs(spark, path)
    data = to_path(f"{path}/data")
    if not fs.exists(data):
        return 0
    counting = {re.sub(r".*/data/", "", folder) for folder in attempts(spark, path).values()}
    removed = 0
    for of_load in fs.listStatus(data):
        for attempt in fs.listStatus(of_load.getPath()):
            folder = attempt.getPath()
            if f"{of_load.getPath().getName()}/{folder.getName()}" not in counting:
                fs.delete(folder, True)
                removed += 1
    return removed
