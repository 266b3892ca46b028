import random
import re
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tontine.functions import distribution

WANTED = {"p01": 0.01, "p50": 0.5, "p95": 0.95, "p99": 0.99, "lowest": 0.0, "highest": 1.0}


def brute_force(rows):
    groups = {}
    for key, value in rows:
        if value is not None:
            groups.setdefault(key, []).append(value)
    result = {}
    for key, values in groups.items():
        x = np.array([float(v) for v in values])
        result[key] = {
            "n": len(values),
            "total": sum(values),
            "mean": x.mean(),
            "deviation": x.std(),
            **{name: np.quantile(x, q) for name, q in WANTED.items()},
        }
    return result


def samples():
    rng = random.Random(7)

    def cents(low, high):
        return Decimal(rng.randint(low, high)).scaleb(-2)

    rows = [("wide", cents(0, 10**11)) for _ in range(400)]
    rows += [("narrow", cents(100, 400)) for _ in range(300)]
    # One group with a third of all rows, most of them equal.
    rows += [("hot", Decimal("123.45") if i % 4 else cents(0, 10**7)) for i in range(500)]
    rows += [("negative", cents(-(10**6), 10**6)) for _ in range(101)]
    rows += [("single", Decimal("7.77")), ("two", Decimal("1.00")), ("two", Decimal("2.00"))]
    rows += [(None, cents(0, 10**5)) for _ in range(50)]
    rows += [("two", None), ("empty", None)]
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    rows = samples()
    df = spark.createDataFrame(rows, "k string, x decimal(18,2)").repartition(5)
    got = distribution(df, ["k"], "x", WANTED)
    expected = brute_force(rows)
    found = {r.k: r for r in got.collect()}
    assert set(found) == set(expected)
    for key, values in expected.items():
        assert found[key].n == values["n"]
        assert found[key].total == values["total"]
        for name in ("mean", "deviation", *WANTED):
            assert found[key][name] == pytest.approx(values[name], rel=1e-9, abs=1e-9), (key, name)


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, x decimal(18,2)")
    assert distribution(df, ["k"], "x", {"p50": 0.5}).count() == 0


def test_several_keys(spark):
    df = spark.range(1000).selectExpr(
        "id % 3 a", "id % 2 b", "cast(id * 1.37 as decimal(18,2)) x"
    )
    got = {(r.a, r.b): r.p50 for r in distribution(df, ["a", "b"], "x", {"p50": 0.5}).collect()}
    exact = df.groupBy("a", "b").agg({"x": "median"}).collect()
    assert got == pytest.approx({(r.a, r.b): float(r[2]) for r in exact})


def test_large_close_values_keep_their_deviation(spark):
    """A difference of squares would lose it."""
    rows = [("a", Decimal("50000000.00") + (i % 2) * Decimal("0.02")) for i in range(1000)]
    got = distribution(spark.createDataFrame(rows, "k string, x decimal(18,2)"), ["k"], "x", {"p50": 0.5}).first()
    assert got.deviation == pytest.approx(0.01, rel=1e-9)


def test_values_are_moved_once_and_never_by_the_group_alone(spark):
    df = spark.range(2000).selectExpr("id % 3 k", "cast(id * 1.37 as decimal(18,2)) x")
    plan = distribution(df, ["k"], "x", {"p50": 0.5, "p95": 0.95})._jdf.queryExecution().executedPlan().toString()
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)[^\n]*\n[^\n]*HashAggregate\(keys=\[([^\]]*)\]", plan)
    values = [by for by, keys in moved if "cents__" in keys]
    assert len(values) == 1 and "cents__" in values[0] and "start__" in values[0]
    # The source's rows reach an exchange only as counts by bin or by value.
    for line in plan.split("Exchange ")[1:]:
        below = line.split("\n")[1]
        assert "Generate" not in below and "Range" not in below


def test_many_groups(spark):
    """More bins than the bitmaps have places would only let more rows through."""
    df = spark.range(60_000).selectExpr("id % 20000 k", "cast(id * 7919 % 1000003 * 0.01 as decimal(18,2)) x")
    got = distribution(df, ["k"], "x", {"p50": 0.5})
    exact = df.groupBy("k").agg(F.median("x").cast("double").alias("m"))
    assert got.join(exact, "k").filter("abs(p50 - m) > 1e-9").count() == 0 and got.count() == 20_000


def test_defining_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(100).selectExpr("id % 3 k", "cast(id as decimal(18,2)) x")
    spark.sparkContext.setJobGroup("define", "define")
    try:
        distribution(df, ["k"], "x", {"p50": 0.5})
        assert not tracker.getJobIdsForGroup("define")
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
