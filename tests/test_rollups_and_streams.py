import datetime as dt

import pytest

from samples import claims, multiset, one, policies, reserves
from tontine.operators import rollups
from tontine.session import scratch_path
from tontine.sources.tables import read_table_stream, write_table
from tontine.streaming import incremental, stateful

CLAIMS = [
    {"geography": g, "accident_date": f"2021-0{m}-01", "report_date": f"2021-0{m + 1}-01", "claim_status": s,
     "paid_amount": m, "incurred_amount": 2 * m, "outstanding_reserve": m, "development_month": m}
    for g in ("CA", "TX") for m in (1, 2, 3) for s in ("Open", "Closed")
]
POLICIES = [{"geography": g, "customer_age": a, "sum_insured": a} for g in ("CA", "TX") for a in (20, 31, 60)]
RESERVES = [
    {"valuation_date": d, "total_outstanding": o, "initial_csm": o, "csm_amortization": 1, "cohort_year": y}
    for y in (2020, 2021)
    for d, o in (("2021-06-30", 7), ("2021-12-31", 3), ("2021-03-31", 9))
]
CASES = [
    ("claims", claims, CLAIMS, rollups.triangle),
    ("claims", claims, CLAIMS, rollups.triangle_projection),
    ("claims", claims, CLAIMS, rollups.monthly_claims),
    ("policies", policies, POLICIES, rollups.policy_geography),
    ("policies", policies, POLICIES, rollups.policy_daily),
    ("reserves", reserves, RESERVES, rollups.ifrs17_reporting),
    ("reserves", reserves, RESERVES, rollups.csm_movements),
    ("reserves", reserves, RESERVES, rollups.reserve_latest),
    ("claims", claims, CLAIMS, rollups.active_policies),
]
IDS = [case[3].__name__ for case in CASES]


@pytest.mark.parametrize("table,build,rows,make", CASES, ids=IDS)
def test_merged_parts_equal_the_whole(spark, table, build, rows, make):
    rollup = make()
    parts = rollup.partial(build(spark, *rows[:2])).unionByName(rollup.partial(build(spark, *rows[2:])))
    assert multiset(rollup.finish(rollup.merge(parts))) == multiset(rollup.batch(build(spark, *rows)))


@pytest.mark.parametrize("table,build,rows,make", CASES, ids=IDS)
def test_stream_equals_batch(spark, table, build, rows, make):
    rollup, source, target = make(), scratch_path(spark, "in"), scratch_path(spark, "out")
    write_table(build(spark, *rows[:3]), table, source)
    write_table(build(spark, *rows[3:]), table, source)
    stream = read_table_stream(spark, table, source, max_files_per_trigger=1)
    got = incremental.run(rollup, stream, target)
    assert len(incremental._numbers(spark, f"{target}/partials")) > 1
    assert multiset(got) == multiset(rollup.batch(build(spark, *rows)))

    # New rows are picked up where the last run stopped; nothing is counted twice.
    write_table(build(spark, *rows[:1]), table, source)
    again = incremental.run(rollup, read_table_stream(spark, table, source), target)
    assert multiset(again) == multiset(rollup.batch(build(spark, *rows, rows[0])))


def test_a_batch_written_again_replaces_itself(spark):
    rollup, source, target = rollups.triangle(), scratch_path(spark, "in"), scratch_path(spark, "out")
    write_table(claims(spark, *CLAIMS), "claims", source)
    for run in (1, 2):
        # A second start with lost progress repeats batch 0 into the same folder.
        stream = read_table_stream(spark, "claims", source)
        stream.writeStream.foreachBatch(
            lambda df, n: rollup.partial(df).write.mode("overwrite").parquet(f"{target}/partials/batch={n}")
        ).option("checkpointLocation", scratch_path(spark, f"progress{run}")).trigger(
            availableNow=True
        ).start().awaitTermination()
    got = incremental.current(rollup, spark, target, incremental.partial_schema(rollup, claims(spark, *CLAIMS)))
    assert multiset(got) == multiset(rollup.batch(claims(spark, *CLAIMS)))


def test_rollup_also_works_as_a_stateful_stream(spark):
    rollup, source = rollups.monthly_claims(), scratch_path(spark, "in")
    write_table(claims(spark, *CLAIMS), "claims", source)
    running = rollup.partial(read_table_stream(spark, "claims", source))
    query = (
        running.writeStream.outputMode("complete").format("memory").queryName("running_monthly")
        .option("checkpointLocation", scratch_path(spark, "progress")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = rollup.finish(spark.table("running_monthly"))
    assert multiset(got) == multiset(rollup.batch(claims(spark, *CLAIMS)))


def test_latest_does_not_depend_on_arrival(spark):
    rollup = rollups.reserve_latest()
    for order in (RESERVES, RESERVES[::-1]):
        rows = [r for r in order if r["cohort_year"] == 2020]
        row = one(rollup.batch(reserves(spark, *rows)))
        assert row["latest_valuation"] == dt.date(2021, 12, 31)
        assert row["latest_outstanding"] == 3 and row["valuation_count"] == 3


def test_a_tie_of_dates_is_decided_by_the_record(spark):
    same = [{"valuation_date": "2021-12-31", "reserve_adequacy_ratio": a, "total_outstanding": o} for a, o in ((0.5, 9), (0.7, 1), (0.7, 4))]
    for rows in (same, same[::-1]):
        row = one(rollups.reserve_latest().batch(reserves(spark, *rows)))
        assert (float(row["latest_adequacy_ratio"]), row["latest_outstanding"], row["valuation_count"]) == (0.7, 4, 3)


def test_sketches_merge_over_batches(spark):
    """20,000 policies, half of them in both parts, in batches and after compaction."""
    rollup, source, target = rollups.active_policies(), scratch_path(spark, "in"), scratch_path(spark, "out")
    row = claims(spark, {"claim_number": "c"}).drop("policy_id")
    first, second = (row.join(spark.range(a, b).withColumnRenamed("id", "policy_id")).select(claims(spark).columns) for a, b in ((0, 15_000), (5_000, 20_000)))
    for part in (first, second, second.limit(100)):
        write_table(part, "claims", source)
    stream = read_table_stream(spark, "claims", source, max_files_per_trigger=1)
    got = one(incremental.run(rollup, stream, target, compact_every=2))
    assert got["claim_count"] == 30_100 and abs(got["policy_estimate"] - 20_000) <= 400


def test_averages_are_not_added_up(spark):
    rollup = rollups.monthly_claims()
    part = rollup.partial(claims(spark, *CLAIMS))
    merged = rollup.finish(rollup.merge(part.unionByName(part)))
    assert {r.avg_report_delay for r in merged.collect()} == {31.0, 28.0}


def test_averages_leave_missing_values_out(spark):
    known, missing = dict(CLAIMS[0]), dict(CLAIMS[0]) | {"report_date": None}
    row = one(rollups.monthly_claims().batch(claims(spark, known, missing)))
    assert row["claim_count"] == 2
    assert row["avg_report_delay"] == one(rollups.monthly_claims().batch(claims(spark, known)))["avg_report_delay"]


def test_empty_stream_gives_an_empty_rollup(spark):
    source = scratch_path(spark, "in")
    write_table(claims(spark, *CLAIMS).limit(0), "claims", source)
    stream = read_table_stream(spark, "claims", source)
    assert incremental.run(rollups.triangle(), stream, scratch_path(spark, "out")).count() == 0


def test_compaction_counts_nothing_twice(spark):
    rollup, source, target = rollups.triangle(), scratch_path(spark, "in"), scratch_path(spark, "out")
    schema = incremental.partial_schema(rollup, claims(spark, *CLAIMS))

    def now():
        return multiset(incremental.current(rollup, spark, target, schema))

    for row in CLAIMS[:3]:
        write_table(claims(spark, row), "claims", source)
    stream = read_table_stream(spark, "claims", source, max_files_per_trigger=1)
    incremental.start(rollup, stream, target).awaitTermination()
    expected = multiset(rollup.batch(claims(spark, *CLAIMS[:3])))
    # A failure after the mark, before the clean-up, and one before the mark.
    incremental.snapshot(rollup, spark, target, schema)
    assert len(incremental._numbers(spark, f"{target}/partials")) == 3 and now() == expected
    incremental._remove(spark, f"{target}/marks")
    assert now() == expected
    incremental.compact(rollup, spark, target, schema)
    assert not incremental._numbers(spark, f"{target}/partials") and now() == expected
    # Batches after the snapshot are added; every second one compacts.
    for row in CLAIMS[:3]:
        write_table(claims(spark, row), "claims", source)
    stream = read_table_stream(spark, "claims", source, max_files_per_trigger=1)
    got = incremental.run(rollup, stream, target, compact_every=2)
    assert multiset(got) == multiset(rollup.batch(claims(spark, *CLAIMS[:3], *CLAIMS[:3])))
    assert len(incremental._numbers(spark, f"{target}/snapshots")) == 1


@pytest.mark.parametrize("table,build,rows,make", CASES, ids=IDS)
def test_state_equals_batch_after_a_restart(spark, table, build, rows, make):
    """One file a batch, with compaction; then more files from the checkpoint."""
    rollup, source, target = make(), scratch_path(spark, "in"), scratch_path(spark, "out")
    for part in (rows[:2], rows[2:]):
        write_table(build(spark, *part), table, source)
    query = stateful.start(rollup, read_table_stream(spark, table, source, max_files_per_trigger=1), target, compact_every=2)
    query.awaitTermination()
    groups = rollup.batch(build(spark, *rows))
    state = query.lastProgress["stateOperators"][0]
    assert "rocksdbCommitFileSyncLatencyMs" in state["customMetrics"]
    assert state["numRowsTotal"] == groups.count()
    schema = build(spark).schema
    assert multiset(stateful.current(rollup, spark, target, schema)) == multiset(groups)
    write_table(build(spark, rows[0], rows[-1]), table, source)
    again = stateful.run(rollup, read_table_stream(spark, table, source), target)
    assert multiset(again) == multiset(rollup.batch(build(spark, *rows, rows[0], rows[-1])))


def test_a_stale_record_never_wins(spark):
    """A batch written again, and batches read in any order, leave the newest state of each group."""
    rollup, target = rollups.triangle(), scratch_path(spark, "out")
    small, whole = (rollup.partial(claims(spark, *rows)) for rows in (CLAIMS[:3], CLAIMS))
    for number, groups in ((1, whole), (0, small), (0, small)):
        stateful._changes(rollup, groups, number).write.mode("overwrite").parquet(f"{target}/partials/batch={number}")
    got = stateful.current(rollup, spark, target, claims(spark).schema)
    assert multiset(got) == multiset(rollup.batch(claims(spark, *CLAIMS)))


def test_state_has_no_more_partitions_than_asked_for(spark):
    rollup, source, target = rollups.triangle(), scratch_path(spark, "in"), scratch_path(spark, "out")
    write_table(claims(spark, *CLAIMS), "claims", source)
    before = {key: spark.conf.get(key) for key in (stateful.PROVIDER, stateful.PARTITIONS)}
    for asked, expected in ((2, 2), (1000, int(before[stateful.PARTITIONS])), (None, int(before[stateful.PARTITIONS]))):
        path = f"{target}/{asked}"
        query = stateful.start(rollup, read_table_stream(spark, "claims", source), path, partitions=asked)
        assert {key: spark.conf.get(key) for key in before} == before
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == expected
    # A later start goes on with the partitions that there are.
    write_table(claims(spark, CLAIMS[0]), "claims", source)
    again = stateful.run(rollup, read_table_stream(spark, "claims", source), f"{target}/2", partitions=3)
    assert multiset(again) == multiset(rollup.batch(claims(spark, *CLAIMS, CLAIMS[0])))
