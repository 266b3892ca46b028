from pyspark.sql import functions as F

from tontine.functions import probably_in


def test_keeps_all_wanted_and_few_others(spark):
    rows = spark.range(200_000).selectExpr("id", "nullif(id % 1000, 7) k", "cast(id % 3 as string) t")
    wanted = spark.range(50).selectExpr("nullif(id, 7) k", "'1' t", "id other")
    got = probably_in(rows, wanted, ["k", "t"])
    assert got.columns == rows.columns
    exact = F.coalesce(F.col("k") < 50, F.lit(True)) & (F.col("t") == "1")
    assert got.where(exact).count() == rows.where(exact).count()
    assert got.where(~exact).count() < 2_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 1 and "NestedLoop" not in plan


def test_nothing_wanted(spark):
    rows = spark.range(100).withColumnRenamed("id", "k")
    assert probably_in(rows, rows.limit(0), ["k"]).count() == 0


def test_a_full_set_keeps_everything(spark):
    rows = spark.range(300_000).withColumnRenamed("id", "k")
    assert probably_in(rows, rows, ["k"]).count() == 300_000
