import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from samples import cells, claims, dicts, multiset, one
from tontine.operators import rollups, triangles

SHAPE = cells((2020, 1, 2000), (2020, 2, 3000), (2020, 3, 3300), (2021, 1, 4000), (2021, 2, 5000), (2022, 1, 6000))


def test_triangle_sums_filters_and_limits(spark):
    df = claims(spark, *SHAPE, *cells((2020, 1, 500), (2019, 1, 9)))
    rows = dicts(triangles.triangle(df))
    assert [(r["accident_year"], r["development_month"]) for r in rows][:2] == [(2020, 1), (2020, 2)]
    assert rows[0]["cumulative_paid"] == 2500 and rows[0]["claim_count"] == 2
    assert len(rows) == 6
    assert triangles.triangle(df, limit=2).count() == 2
    assert triangles.triangle(df.limit(0)).count() == 0


def test_arrays(spark):
    rows = dicts(triangles.triangle_arrays(claims(spark, *SHAPE)))
    assert rows[0]["paid_triangle_12m"] == [2000, 3000, 3300]
    assert rows[0]["incremental_paid_12m"] == [0, 1000, 300]
    assert [r["ultimate_loss_estimate"] for r in rows] == [1300, 1000, 0]
    assert [r["development_periods"] for r in rows] == [3, 2, 1]


def test_arrays_show_twelve_months_but_use_all(spark):
    row = one(triangles.triangle_arrays(claims(spark, *cells(*[(2020, m, m * 10) for m in range(1, 14)]))))
    assert len(row["paid_triangle_12m"]) == 12
    assert row["ultimate_loss_estimate"] == 120 and row["development_periods"] == 13


def test_factors_need_prior_month_credibility_and_points(spark):
    df = claims(spark, *SHAPE, *cells((2023, 1, 900), (2023, 2, 9000), (2024, 1, 2000), (2024, 2, 1000)))
    row = one(triangles.development_factors(df))
    # 2020, 2021 and 2024 count for month 2; 2023 has too little before it; month 3 has one point.
    assert row["development_month"] == 2 and row["data_points"] == 3
    assert row["avg_factor"] == pytest.approx((1.5 + 1.25 + 0.5) / 3, abs=1e-4)
    assert row["median_factor"] == 1.25
    assert row["selected_factor"] == pytest.approx(9000 / 8000, abs=1e-4)


def test_literal_chain_ladder_equals_the_window_form(spark):
    df = claims(spark, *SHAPE, *cells((2021, 7, 10), (2023, 13, 60), (2020, 14, 70)))
    for horizon in (50, 2):
        got = {r["accident_year"]: r for r in dicts(triangles.chain_ladder_literal(df, horizon=horizon))}
        base = triangles.cells(df, ["accident_year", "development_month"], 2020).withColumn(
            "f", triangles.selected_factor("development_month")
        )
        listed = base.withColumn("fs", F.collect_list("f").over(Window.orderBy("development_month")))
        direct = (
            listed.withColumn("part", F.slice("fs", F.col("development_month"), F.lit(horizon)))
            .withColumn("p", F.col("cumulative_paid") * F.aggregate("part", F.lit(1.0), lambda a, x: a * x))
            .groupBy("accident_year")
            .agg(F.max("p").alias("u"), F.max("cumulative_paid").alias("l"))
        )
        for r in direct.collect():
            assert got[r.accident_year]["ultimate_projection"] == pytest.approx(float(r.u), abs=0.01)
            assert got[r.accident_year]["latest_paid"] == r.l


def test_chain_ladder_uses_later_factors_of_reported_claims(spark):
    rows = [dict(r, report_date="2022-06-01") for r in SHAPE]
    rows += [dict(r, report_date="2023-06-01") for r in cells((2022, 2, 9999))]
    got = {r["accident_year"]: r for r in dicts(triangles.chain_ladder(claims(spark, *rows), as_of="2022-12-31"))}
    # Months 1..3 occur; what lies ahead of month 1 is 1.45 * 1.25.
    assert got[2022]["ultimate_projection"] == pytest.approx(6000 * 1.45 * 1.25)
    assert got[2021]["ultimate_projection"] == pytest.approx(5000 * 1.25)
    assert got[2020]["ibnr_estimate"] == 0
    assert got[2022]["latest_paid"] == Decimal(6000)


def test_selected_factor_table(spark):
    months = spark.createDataFrame([(m,) for m in (1, 5, 6, 12, 13, 24, 25)], "m int")
    assert [r[0] for r in months.select(triangles.selected_factor("m")).collect()] == [
        2.5, 1.1, 1.05, 1.05, 1.02, 1.02, 1.0,
    ]


def test_by_line_and_profile(spark):
    rows = [dict(r, line_of_business=lob, accident_year=2022) for lob in ("Life", "Motor") for r in cells((0, 2, 10.4), (0, 1, 5.5))]
    df = claims(spark, *rows)
    got = dicts(triangles.triangle_by_line(df))
    assert [r["line_of_business"] for r in got] == ["Life", "Motor"]
    assert got[0]["paid_triangle_12m"] == [6, 10] and got[0]["total_paid_to_date"] == Decimal("15.90")
    assert one(triangles.claims_profile(df)) == {
        "total_claims_processed": 4, "accident_years": 1, "max_development_period": 2, "lines_of_business": 2,
    }


def test_recent_triangle(spark):
    df = claims(spark, *cells((2017, 1, 1), (2018, 1, 2), (2021, 1, 3)))
    assert [r["accident_year"] for r in dicts(triangles.triangle_recent(df, as_of="2021-05-01"))] == [2018, 2021]


def test_all_cells_unless_a_limit_is_given(spark):
    rows = cells(*[(2021, m, 1) for m in range(1, 91)])
    df = claims(spark, *rows)
    assert triangles.triangle(df).count() == 90 and triangles.triangle_recent(df, as_of="2022-01-01").count() == 90


@pytest.mark.parametrize("operator", [triangles.triangle, triangles.triangle_arrays, triangles.triangle_by_line, triangles.development_factors])
def test_rollup_cells_stand_for_claims(spark, operator):
    rng = random.Random(8)
    rows = [
        {"accident_year": rng.choice([2019, 2021, 2022, 2023]), "development_month": rng.randint(1, 6), "paid_amount": rng.randint(0, 9000),
         "line_of_business": rng.choice(["Motor", "Life"]), "geography": rng.choice(["CA", "TX"])}
        for _ in range(200)
    ]
    df, rollup = claims(spark, *rows), rollups.triangle()
    parts = [rollup.partial(df.where(F.col("geography") == g)) for g in ("CA", "TX")]
    whole = rollup.finish(rollup.merge(parts[0].unionByName(parts[1])))
    assert multiset(operator(whole)) == multiset(operator(df))
