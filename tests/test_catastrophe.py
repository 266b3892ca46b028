from decimal import Decimal

import pytest

from samples import claims, dicts, one, policies
from tontine.operators import catastrophe, checks

FLAGGED = '{"catastrophe_related": true}'


def portfolio(spark):
    return policies(
        spark,
        {"geography": "FL", "sum_insured": 1_000_000.01, "premium": 100},
        {"geography": "FL", "line_of_business": "Property", "sum_insured": 500, "premium": 10},
        {"geography": "CA", "sum_insured": 2000, "premium": 40},
        {"geography": "MI", "sum_insured": 70, "premium": 2},
        {"geography": "FL", "line_of_business": "Life", "sum_insured": 999, "premium": 9},
    )


def test_exposure(spark):
    got = dicts(catastrophe.geographic_exposure(portfolio(spark)))
    assert [r["geography"] for r in got] == ["FL", "CA", "FL", "MI"]
    assert got[0]["high_value_policies"] == 1 and got[1]["high_value_exposure"] == 0
    assert sum(r["exposure_concentration_pct"] for r in got) == pytest.approx(1, abs=1e-3)
    assert len(dicts(catastrophe.geographic_exposure(portfolio(spark), limit=1))) == 1


def test_ties_at_the_limit_are_settled_by_the_keys(spark):
    df = policies(spark, *[{"geography": g, "sum_insured": 5} for g in ("TX", "CA", "NY")])
    assert [r["geography"] for r in dicts(catastrophe.geographic_exposure(df, limit=2))] == ["CA", "NY"]


def test_hurricane(spark):
    got = dicts(catastrophe.hurricane_exposure(portfolio(spark)))
    assert [(r["hurricane_zone"], r["line_of_business"]) for r in got] == [
        ("Hurricane_Zone_1", "Motor"), ("Hurricane_Zone_1", "Property"),
    ]
    assert got[1]["expected_gross_loss"] == 40 and got[1]["expected_net_loss"] == 28
    assert got[1]["loss_to_premium_ratio"] == 4.0
    assert one(catastrophe.hurricane_states(portfolio(spark)))["total_exposure"] == Decimal("1000500.01")


def test_event_monitor(spark):
    df = claims(
        spark,
        {"accident_date": "2024-01-02", "claim_attributes": FLAGGED, "incurred_amount": 10, "paid_amount": 6},
        {"accident_date": "2024-01-04", "geography": "TX", "incurred_amount": 200_000, "paid_amount": 1},
        {"accident_date": "2024-01-04", "geography": "NY", "incurred_amount": 200_000},
        {"accident_date": "2023-12-31", "claim_attributes": FLAGGED},
    )
    got = {r["geography"]: r for r in dicts(catastrophe.event_monitor(df, as_of="2024-01-05 12:00:00"))}
    assert set(got) == {"CA", "TX"}
    assert got["CA"]["development_status"] == "Fast Development"
    assert got["TX"]["development_status"] == "Slow Development"
    assert float(got["TX"]["max_days_since_event"]) == 1.5


def test_stress_keeps_scenarios_without_exposure(spark):
    got = {r["scenario_name"]: r for r in dicts(catastrophe.stress_test(portfolio(spark)))}
    assert len(got) == 4
    quake = got["California Earthquake"]
    assert (quake["exposed_policies"], quake["estimated_gross_loss"], quake["estimated_net_loss"]) == (1, 300, 225)
    storm = got["Northeast Winter Storm"]
    assert (storm["exposed_policies"], storm["exposed_sum_insured"]) == (0, 0)
    assert storm["loss_to_premium_ratio"] is None and storm["exposure_concentration"] == 0
    everything = Decimal("1000000.01") + 500 + 2000 + 70 + 999
    assert got["Major Hurricane"]["exposure_concentration"] == pytest.approx(1000500.01 / float(everything), abs=1e-4)


def test_reinsurance_ladder(spark):
    got = dicts(catastrophe.reinsurance(catastrophe.scenario_losses(spark)))
    assert len(got) == 21 and got[0]["scenario"] == "Scenario_1"
    for n, row in enumerate(got, 1):
        gross = 15_000_000 + 25_000_000 * n
        recovery = sum(
            max(0, min(gross - attach, limit)) * share
            for attach, limit, share in ((10e6, 40e6, 0.85), (50e6, 50e6, 0.9), (100e6, 100e6, 0.95))
        )
        assert float(row["gross_loss"]) == gross
        assert float(row["reinsurance_recovery"]) == pytest.approx(recovery)
        assert recovery <= 40e6 * 0.85 + 50e6 * 0.9 + 100e6 * 0.95
        assert row["recovery_ratio"] == pytest.approx(recovery / gross, abs=1e-3)
    assert got[0]["impact_assessment"] == "Manageable Impact" and got[-1]["impact_assessment"] == "Severe Impact"


def test_dashboard(spark):
    df = claims(
        spark,
        {"accident_date": "2023-12-10", "claim_attributes": FLAGGED, "incurred_amount": 7, "outstanding_reserve": 100_000},
        {"accident_date": "2023-12-01", "claim_attributes": FLAGGED, "incurred_amount": 9},
        {"accident_date": "2023-12-30", "claim_status": "Closed", "outstanding_reserve": 8},
    )
    row = one(catastrophe.dashboard(portfolio(spark), df, as_of="2024-01-01"))
    assert row["total_policies_at_risk"] == 4 and row["high_risk_policies"] == 3
    assert row["recent_cat_claims"] == 1 and row["recent_cat_losses_30d"] == 7
    assert row["available_reserves"] == 100_000
    assert row["reserve_adequacy_ratio"] == 2.0 and row["financial_strength_status"] == "Adequate"
    profile = one(catastrophe.catastrophe_profile(portfolio(spark), df, as_of="2024-01-01"))
    assert profile["recent_claims_analyzed"] == 3 and profile["geographic_regions_analyzed"] == 3


def test_dashboard_of_nothing(spark):
    row = one(catastrophe.dashboard(portfolio(spark).limit(0), claims(spark), as_of="2024-01-01"))
    assert row["total_policies_at_risk"] == 0 and row["available_reserves"] == 0
    assert row["high_risk_concentration"] is None
    assert row["financial_strength_status"] == "Monitor Closely"


def test_counts(spark):
    row = one(checks.table_counts(portfolio(spark), claims(spark), portfolio(spark).limit(2)))
    assert row == {"policies_loaded": 5, "claims_loaded": 0, "reserves_loaded": 2}
