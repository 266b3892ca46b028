"""Rollups kept as state of the streaming engine, in RocksDB, beside the stateless upkeep of ``incremental``.

The state holds one row for each group, however many rows or batches have come. Every batch gives the groups that it
changed, with their new measures (update mode); they are stored under the batch's number, and of each group's rows
the one of the newest batch counts. So a repeated batch replaces itself, and what is stored is merged into snapshots
just as the partial rollups of ``incremental`` are: as a rollup whose one measure is the newest record.

Every batch opens, commits and writes each partition of the state, however few groups it changes. ``partitions`` limits
their number where there are few groups; it stays what it was at the first start of a checkpoint.

Choose this where each batch changes few groups and readers want the groups as they are now; choose ``incremental``
where there are very many groups, since it needs no state at all.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tontine.operators.rollups import Rollup
from tontine.streaming import incremental

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newest(rollup: Rollup) -> Rollup:
    """The rollup of stored changes: per group, the measures of the newest batch."""
    return Rollup(
        keys=rollup.keys,
        measures={"newest": F.max("newest")},
        merge_with={"newest": F.max},
        output={name: F.col(f"newest.{name}") for name in rollup.measures},
    )


def _changes(rollup: Rollup, groups: DataFrame, number: int) -> DataFrame:
    record = F.struct(F.lit(number).cast("long").alias("batch__"), *rollup.measures)
    return groups.select(*rollup.keys, record.alias("newest"))


def _as_read(schema: T.StructType) -> T.StructType:
    """The schema as files give it back, where every field may be missing."""
    return T.StructType.fromJson(json.loads(schema.json().replace('"nullable":false', '"nullable":true')))


def start(
    rollup: Rollup,
    rows: DataFrame,
    path: str,
    *,
    compact_every: int = incremental.COMPACT_EVERY,
    partitions: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Keep the rollup of a stream under ``path`` up to date, with its state in the checkpoint there. With no
    trigger given, everything available is processed and the query then stops; a later start goes on from there."""
    spark = rows.sparkSession
    before = {key: spark.conf.get(key) for key in (PROVIDER, PARTITIONS)}
    changes = newest(rollup)

    def store(groups: DataFrame, number: int) -> None:
        found = _changes(rollup, groups, number)
        found.write.mode("overwrite").parquet(f"{path}/partials/batch={number}")
        if (number + 1) % compact_every == 0:
            incremental.compact(changes, groups.sparkSession, path, _as_read(found.schema))

    spark.conf.set(PROVIDER, ROCKSDB)
    if partitions:
        spark.conf.set(PARTITIONS, min(partitions, int(before[PARTITIONS])))
    try:
        # The query takes the settings of the session as they are when it starts.
        return (
            rollup.partial(rows)
            .writeStream.outputMode("update")
            .foreachBatch(store)
            .option("checkpointLocation", f"{path}/progress")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def current(rollup: Rollup, spark: SparkSession, path: str, rows: T.StructType) -> DataFrame:
    """The rollup of everything processed so far; ``rows`` is the schema of the stream's rows."""
    schema = _as_read(_changes(rollup, rollup.partial(spark.createDataFrame([], rows)), 0).schema)
    changes = newest(rollup)
    merged = changes.finish(changes.merge(incremental.partials(spark, path, schema)))
    return rollup.finish(merged)


def run(
    rollup: Rollup,
    rows: DataFrame,
    path: str,
    *,
    compact_every: int = incremental.COMPACT_EVERY,
    partitions: int | None = None,
) -> DataFrame:
    """Process what is available and return the resulting rollup."""
    start(rollup, rows, path, compact_every=compact_every, partitions=partitions).awaitTermination()
    return current(rollup, rows.sparkSession, path, rows.schema)
