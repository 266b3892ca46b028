from decimal import Decimal

import pytest

from samples import dicts, one, policies
from tontine.operators import mortality


def life(*rows):
    return [{"line_of_business": "Life", **r} for r in rows]


def test_exposure_and_experience(spark):
    rows = life(
        *[{"customer_age": a, "risk_factors": '{"health_rating": "Standard"}'} for a in (24, 25, 66)],
        {"customer_age": 90, "customer_gender": "M", "risk_factors": "{bad"},
    )
    df = policies(spark, *rows, {"customer_age": 30})
    exposure = {r["customer_age"]: r for r in dicts(mortality.exposure(df))}
    assert exposure[66]["senior_policies"] == 1 and exposure[25]["senior_policies"] == 0
    assert exposure[24]["standard_risk"] == 1 and exposure[90]["standard_risk"] == 0
    got = dicts(mortality.experience(df))
    assert [r["age_band"] for r in got] == ["18-24", "25-34", "65-74", "75+"]
    assert got[3]["expected_deaths"] == Decimal("0.04") and got[3]["expected_rate_per_1000"] == 40


def test_trend_rolls_over_rows_and_compares_a_year(spark):
    months = [f"{2022 + m // 12}-{m % 12 + 1:02d}-15" for m in range(14)]
    rows = [r for i, d in enumerate(months) for r in life({"effective_date": d, "customer_age": 30}) * (500 * (i + 1))]
    got = sorted(dicts(mortality.trend(policies(spark, *rows))), key=lambda r: r["month_start"])
    assert len(got) == 14
    assert [float(r["actual_deaths"]) for r in got[:3]] == [1.0, 2.0, 3.0]
    assert got[11]["yoy_mortality_ratio"] is None
    assert got[12]["yoy_mortality_ratio"] == 13.0
    ae = [float(r["actual_deaths"]) / float(r["expected_deaths"]) for r in got]
    assert got[13]["rolling_12m_ae_ratio"] == pytest.approx(sum(ae[2:14]) / 12, abs=1e-4)
    total = one(mortality.actual_to_expected(policies(spark, *rows), since="2022-01-01"))
    assert total["exposure"] == len(rows)


def test_trend_drops_months_without_deaths(spark):
    df = policies(spark, *life({"effective_date": "2022-01-01"}, {"effective_date": "2021-12-31"}))
    assert mortality.trend(df).count() == 0
    assert mortality.trend(df, digits=4).count() == 1


def test_geography_threshold_is_exclusive(spark):
    rows = life({"geography": "FL"}) * 3 + life({"geography": "MI"}) * 2
    got = dicts(mortality.by_geography(policies(spark, *rows), min_policies=2))
    assert [r["geography"] for r in got] == ["FL"]
    assert float(got[0]["geographic_pricing_factor"]) == 1.15


def test_cohorts_count_year_boundaries(spark):
    df = policies(spark, *life({"effective_date": "2023-12-31", "customer_age": 29}) * 10)
    row = one(mortality.cohorts(df, as_of="2024-01-01"))
    assert row["avg_duration"] == 1.0
    assert row["mortality_rate_per_1000"] == pytest.approx(0.79)


def test_shocks(spark):
    df = policies(spark, *life({"sum_insured": 100_000}) * 2)
    row = one(mortality.shocks(df, min_policies=1))
    assert row["base_expected_claims"] == 600 and row["pandemic_shock_15pct"] == 690
    assert row["improvement_5pct"] == 570 and row["impact_ratio"] == 0.15
    assert mortality.shocks(df, min_policies=2).count() == 0


def test_profile_of_nothing(spark):
    assert one(mortality.life_profile(policies(spark, {})))["age_cohorts"] == 0
