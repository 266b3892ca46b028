"""Loads that run twice, fail half-way, or run at the same time leave each row once."""

import pytest

from samples import claims, multiset, reserves
from tontine.session import scratch_path
from tontine.sources import loads, tables

ROWS = [{"claim_id": i, "accident_year": 2019 + i % 3, "paid_amount": i} for i in range(9)]


def test_a_load_counts_once(spark):
    path = scratch_path(spark, "loads")
    first, second = claims(spark, *ROWS[:5]), claims(spark, *ROWS[5:])
    assert loads.read_loads(spark, "claims", path).count() == 0
    assert loads.load(first, "claims", path, "2021-01 / a.b") and loads.load(second, "claims", path, "2021-02")
    assert not loads.load(first, "claims", path, "2021-01 / a.b")
    assert multiset(loads.read_loads(spark, "claims", path)) == multiset(claims(spark, *ROWS))
    with pytest.raises(ValueError):
        loads.load(first, "claims", path, "")


def test_a_load_that_fails_half_way_shows_nothing(spark, monkeypatch):
    path, rows = scratch_path(spark, "loads"), claims(spark, *ROWS)

    def fails(df, table, folder):
        tables.write_table(df.where("claim_id < 4"), table, folder)
        raise OSError("executor lost")

    monkeypatch.setattr(loads, "write_table", fails)
    with pytest.raises(OSError):
        loads.load(rows, "claims", path, "a")
    assert loads.read_loads(spark, "claims", path).count() == 0
    monkeypatch.undo()
    assert loads.load(rows, "claims", path, "a")
    assert multiset(loads.read_loads(spark, "claims", path)) == multiset(rows)
    assert loads.remove_unfinished(spark, path) == 1 and loads.remove_unfinished(spark, path) == 0
    assert multiset(loads.read_loads(spark, "claims", path)) == multiset(rows)


def test_of_two_attempts_at_once_one_counts(spark, monkeypatch):
    path, rows = scratch_path(spark, "loads"), reserves(spark, {"cohort_year": 2020}, {"cohort_year": 2021})

    def overtaken(df, table, folder):
        monkeypatch.undo()
        assert loads.load(df, table, path, "a")
        tables.write_table(df, table, folder)

    monkeypatch.setattr(loads, "write_table", overtaken)
    assert not loads.load(rows, "reserves", path, "a")
    assert multiset(loads.read_loads(spark, "reserves", path)) == multiset(rows)


def test_partitions_are_pruned(spark):
    path = scratch_path(spark, "loads")
    for i, row in enumerate(ROWS[:3]):
        loads.load(claims(spark, row), "claims", path, f"load {i}")
    plan = loads.read_loads(spark, "claims", path).where("accident_year = 2020")._jdf.queryExecution().executedPlan().toString()
    assert "accident_year" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_replacing_partitions(spark):
    path = scratch_path(spark, "replaced")
    tables.write_table(claims(spark, *ROWS), "claims", path)
    corrected = claims(spark, *[row | {"paid_amount": 100} for row in ROWS if row["accident_year"] == 2020])
    for _ in range(2):
        tables.write_table(corrected, "claims", path, mode="replace_partitions")
    got = tables.read_table(spark, "claims", path)
    expected = claims(spark, *[row | ({"paid_amount": 100} if row["accident_year"] == 2020 else {}) for row in ROWS])
    assert multiset(got) == multiset(expected)
    with pytest.raises(ValueError):
        tables.write_table(reserves(spark, {}), "reserves", path, mode="replace_partitions")
