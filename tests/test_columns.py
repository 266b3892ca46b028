from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tontine.functions import (
    above,
    adjacent_difference,
    banded,
    calendar_month,
    distinct,
    json_field,
    json_number,
    list_product,
    mean,
    ordered_values,
    ratio,
    side_by_side,
    sum_where,
)


def test_sketched_distinct_counts(spark):
    df = spark.range(60_000).selectExpr("id % 3 k", "id % 20000 v", "cast(null as long) n")
    got = df.groupBy("k").agg(distinct("v").alias("exact"), distinct("v", "sketch").alias("sketch"), distinct("n", "sketch").alias("none"))
    for r in got.collect():
        assert r.exact == 20_000 and abs(r.sketch - r.exact) <= 400 and r.none == 0
    with pytest.raises(ValueError):
        distinct("v", "other")


def test_ratio_is_null_without_a_denominator(spark):
    df = spark.createDataFrame(
        [(Decimal("1.00"), Decimal("3.00")), (Decimal("1.00"), Decimal("0.00")), (Decimal("1.00"), None)],
        "a decimal(18,2), b decimal(18,2)",
    )
    assert [r[0] for r in df.select(ratio("a", "b", 4)).collect()] == [0.3333, None, None]


def test_conditional_sum_without_a_match_is_zero(spark):
    df = spark.createDataFrame([(Decimal("5.00"),)], "x decimal(18,2)")
    none, some = df.agg(sum_where("x", F.col("x") > 9), sum_where("x", F.col("x") > 1)).first()
    assert (none, some) == (0, Decimal("5.00"))
    assert df.limit(0).agg(sum_where("x", F.col("x") > 1)).first()[0] == 0
    assert df.limit(0).agg(mean("x")).first()[0] is None


def test_json_fields(spark):
    texts = ['{"a": true}', '{"a": "true"}', '{"b": 1}', "{broken", '{"a": {"b": 0.045}}', None]
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    assert [r[0] for r in df.select(json_field("j", "a")).collect()][:4] == ["true", "true", None, None]
    assert [r[0] for r in df.select(json_number("j", "a.b")).collect()] == [None] * 4 + [0.045, None]
    assert df.select(json_number("j", "a")).first()[0] is None


def test_bands(spark):
    df = spark.createDataFrame([(24,), (25,), (75,)], "age int")
    assert [r[0] for r in df.select(banded("age", [(25, "a"), (75, "b")], "c")).collect()] == ["a", "b", "c"]
    assert [r[0] for r in df.select(above("age", [(74, "x"), (24, "y")], "z")).collect()] == ["z", "y", "x"]


def test_arrays(spark):
    df = spark.createDataFrame([(1, 3, 30), (1, 1, 10), (1, 2, 25), (2, 1, 7)], "k int, o int, v int")
    lists = df.groupBy("k").agg(ordered_values("o", "v").alias("v")).orderBy("k")
    assert [r.v for r in lists.collect()] == [[10, 25, 30], [7]]
    assert [r[0] for r in lists.select(adjacent_difference(F.col("v"))).collect()] == [[0, 15, 5], [0]]
    assert [r[0] for r in lists.select(list_product(F.col("v").cast("array<double>"))).collect()] == [7500.0, 7.0]


def test_calendar_month(spark):
    assert spark.sql("select date'2021-03-31' d").select(calendar_month("d")).first()[0] == 202103


def test_side_by_side(spark):
    a = spark.range(3).agg(F.count("id").alias("n"))
    b = spark.range(5).agg(F.sum("id").alias("s"))
    assert side_by_side(a, b).first().asDict() == {"n": 3, "s": 10}
