from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from samples import claims, dicts, one
from tontine import assumptions as A
from tontine.functions import banded, ratio
from tontine.operators import reserving


def test_summary(spark):
    df = claims(
        spark,
        {"outstanding_reserve": 100_000.01, "paid_amount": 50, "incurred_amount": 100_050.01},
        {"outstanding_reserve": 100_000, "claim_status": "Reserved"},
        {"outstanding_reserve": 5, "claim_status": "Closed"},
    )
    row = one(reserving.summary(df))
    assert row["active_claims"] == 2
    assert row["large_reserves_100k_plus"] == 1 and row["large_reserves_amount"] == Decimal("100000.01")
    none = one(reserving.summary(df.where("outstanding_reserve = 100000")))
    assert none["large_reserves_amount"] == 0 and none["payment_ratio"] is None


def test_development_assessment(spark):
    def row(lob, initial, left):
        return {"line_of_business": lob, "initial_reserve": initial, "outstanding_reserve": left}

    df = claims(spark, row("Motor", 100, 80), row("Life", 100, 120), row("Health", 100, 95), row("Pension", 0, 5))
    got = {r["line_of_business"]: r["adequacy_assessment"] for r in dicts(reserving.development(df))}
    assert got == {"Motor": "Over-Reserved", "Life": "Under-Reserved", "Health": "Adequate"}


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_quantiles(spark, method):
    df = claims(spark, *[{"outstanding_reserve": i} for i in range(0, 102)])
    row = one(reserving.quantiles(df, method=method))
    assert row["claim_count"] == 101
    assert row["median_reserve"] == 51 and row["p90_reserve"] == 91
    assert row["reserve_10pct_buffer"] == 5666
    assert reserving.quantiles(df, min_claims=101, method=method).count() == 0
    with pytest.raises(ValueError):
        reserving.quantiles(df, method="other")


def test_catastrophe_reserves(spark):
    rows = [{"accident_year": 2022, "outstanding_reserve": 100, "paid_amount": 1, "incurred_amount": 101}] * 6
    rows += [dict(rows[0], claim_attributes='{"catastrophe_related": true}')] * 7
    rows += [dict(rows[0], outstanding_reserve=60_000)] * 2
    got = {r["loss_type"]: r for r in dicts(reserving.catastrophe_reserves(claims(spark, *rows)))}
    assert set(got) == {"Attritional", "CAT"}
    everything = 13 * 100 + 2 * 60_000
    assert got["CAT"]["reserve_concentration"] == pytest.approx(700 / everything, abs=1e-4)


def test_cashflow_equals_the_join(spark):
    rows = [
        {"line_of_business": lob, "development_month": m, "accident_year": y, "claim_status": s,
         "paid_amount": 10 * m + len(lob), "outstanding_reserve": 7 * m}
        for lob, months in (("Motor", (1, 12, 13, 30, 47, 60)), ("Life", (1, 2)))
        for m in months
        for y in (2019, 2021)
        for s in ("Open", "Closed", "Reserved")
    ]
    rows += [{"line_of_business": x, "accident_year": 2015, "outstanding_reserve": 9} for x in ("Health", "Pension")]
    rows += [{"line_of_business": "Other", "claim_status": "Closed", "outstanding_reserve": 3}]
    df = claims(spark, *rows)
    got = {r["line_of_business"]: r for r in dicts(reserving.cashflow_projection(df))}

    weight = banded("development_month", [(m + 1, w) for m, w in A.PAYMENT_BANDS], 0.0)
    pattern = (
        df.where("accident_year >= 2020")
        .groupBy(F.col("line_of_business").alias("lob"), "development_month")
        .agg(F.sum("paid_amount").alias("p"), F.sum("outstanding_reserve").alias("o"))
        .withColumn("share", ratio("p", F.col("p") + F.col("o"), 4) * weight)
        .select("lob", F.col("development_month").alias("m"), "share")
    )
    joined = (
        df.where("claim_status in ('Open', 'Reserved')")
        .join(pattern, F.col("line_of_business") == F.col("lob"), "left")
        .groupBy("lob")
        .agg(
            F.sum("outstanding_reserve").alias("r"),
            *[F.max(F.when(F.col("m") <= h, F.col("share")).otherwise(0.0)).alias(f"s{h}") for h in (12, 24, 36, 48)],
        )
    )
    expected = {r.lob: r for r in joined.collect()}
    assert set(got) == set(expected) == {"Motor", "Life", None}
    for lob, r in expected.items():
        assert got[lob]["current_reserves"] == r.r
        for i, h in enumerate((12, 24, 36, 48), 1):
            assert got[lob][f"projected_payments_year{i}"] == round(float(r.r) * r[f"s{h}"])


def test_risk_metrics(spark):
    rows = [{"outstanding_reserve": v} for v in range(1, 22)]
    rows += [dict(r, geography="TX") for r in rows[:20]]
    row = one(reserving.risk_metrics(claims(spark, *rows)))
    assert row["total_claims"] == 21 and row["avg_reserve_per_claim"] == 11
    cv = (sum((v - 11) ** 2 for v in range(1, 22)) / 21) ** 0.5 / 11
    assert row["capital_ratio"] == pytest.approx(cv**0.5, abs=1e-4)


def test_p95_and_profile(spark):
    df = claims(spark, *[{"outstanding_reserve": v} for v in range(0, 101)], {"claim_status": "Closed"})
    assert one(reserving.p95_by_line(df))["p95_reserve"] == 95.0
    assert one(reserving.reserve_profile(df))["claims_analyzed"] == 100


def test_cashflow_of_claims_without_a_line(spark):
    """NULL joins no pattern: each claim counts once, and nothing is projected."""
    rows = [
        {"line_of_business": None, "development_month": m, "paid_amount": 10, "outstanding_reserve": r}
        for m, r in ((1, 90), (2, 80))
    ]
    (row,) = dicts(reserving.cashflow_projection(claims(spark, *rows)))
    assert row["current_reserves"] == 170 and row["projected_payments_year1"] == 0
