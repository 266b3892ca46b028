from decimal import Decimal

import pytest

from samples import dicts, one, reserves
from tontine.operators import checks, ifrs17

META = '{"actuarial_assumptions": {"discount_rate": 0.04}, "confidence_level": 0.85}'


def test_summary_without_premiums(spark):
    row = one(ifrs17.summary(reserves(spark, {"initial_csm": 10})))
    assert row["csm_margin_ratio"] is None and row["total_csm"] == 10


def test_csm_movements(spark):
    df = reserves(
        spark,
        {"initial_csm": 100, "csm_amortization": 10, "coverage_units_current": 3, "coverage_units_total": 4,
         "valuation_date": "2021-03-31"},
        {"initial_csm": 300, "csm_amortization": 60, "coverage_units_current": 1, "coverage_units_total": 2,
         "valuation_date": "2021-12-31"},
        {"initial_csm": 0},
        {"initial_csm": 5, "profitability_class": "Onerous"},
    )
    row = one(ifrs17.csm_movements(df))
    assert row["profitable_contract_groups"] == 2
    assert (row["opening_csm"], row["period_amortization"], row["closing_csm"]) == (400, 70, 330)
    assert row["avg_amortization_rate"] == 0.15 and row["projected_next_period_amort"] == 50
    assert one(checks.csm_by_line(df))["remaining_csm"] == Decimal(330)


def test_onerous(spark):
    df = reserves(spark, {"profitability_class": "Onerous", "loss_component": 30, "coverage_units_total": 0}, {})
    row = one(ifrs17.onerous_contracts(df))
    assert row["loss_per_coverage_unit"] is None and row["total_loss_component"] == 30


def test_discount_sensitivity(spark):
    df = reserves(
        spark,
        {"pv_claims": 1000, "pv_premiums": 1500, "pv_factor": 0.8, "reserve_metadata": META},
        {"pv_claims": 9999, "reserve_metadata": "{}"},
        {"pv_claims": 9999, "reserve_metadata": "{broken"},
    )
    row = one(ifrs17.discount_sensitivity(df))
    assert row["base_pv_claims"] == 1000
    assert row["up100bp_claims_impact"] == round(1000 / 0.8 / 1.05**5 - 1000)
    assert row["down100bp_net_impact"] == round(500 / 0.8 / 1.03**5 - 500)


def test_cohorts_units_and_risk(spark):
    df = reserves(
        spark,
        {"pv_claims": 100, "pv_premiums": 200, "initial_csm": 20, "risk_adjustment": 11, "best_estimate_liability": 111,
         "coverage_units_total": 10, "coverage_units_current": 5, "reserve_metadata": META},
        {"pv_claims": 100, "pv_premiums": 100, "loss_component": 5, "risk_adjustment": 4, "best_estimate_liability": 104,
         "profitability_class": "Onerous", "geography": "TX", "reserve_metadata": META},
        {"geography": "FL", "pv_claims": 100, "risk_adjustment": 8, "reserve_metadata": '{"confidence_level": "0.9"}'},
    )
    cohort = one(ifrs17.cohort_profitability(df))
    assert (cohort["profitable_groups"], cohort["onerous_groups"], cohort["profitable_ratio"]) == (2, 1, 0.67)
    assert cohort["net_profitability"] == 15
    units = {r["profitability_class"]: r for r in dicts(ifrs17.coverage_units(df))}
    assert units["Profitable"]["expected_remaining_csm"] == pytest.approx(20 * 6 / 11, abs=0.5)
    levels = {r["geography"]: r["risk_adjustment_level"] for r in dicts(ifrs17.risk_adjustment(df))}
    assert levels == {"CA": "High", "TX": "Low", "FL": "Moderate"}


def test_rates_and_profile(spark):
    df = reserves(spark, {"initial_csm": 3, "reserve_metadata": META}, {"initial_csm": 4})
    assert [(r["discount_rate"], r["total_csm"]) for r in dicts(ifrs17.csm_by_rate(df))] == [(None, 4), (0.04, 3)]
    assert one(ifrs17.reserves_profile(df))["contract_groups_processed"] == 2
    assert one(checks.verify_reserves(df))["total_csm"] == 7


def test_discount_sensitivity_without_a_factor(spark):
    """A factor of zero gives NULL, as a direct quotient would, and the sum leaves it out."""
    rows = [{"pv_claims": 100, "pv_premiums": 120, "pv_factor": f, "reserve_metadata": META} for f in (0, 1)]
    both, known = (one(ifrs17.discount_sensitivity(reserves(spark, *r))) for r in (rows, rows[1:]))
    assert both["base_pv_claims"] == 200
    assert both["up100bp_claims_impact"] + 200 == known["up100bp_claims_impact"] + 100
    assert one(ifrs17.discount_sensitivity(reserves(spark, rows[0])))["up100bp_claims_impact"] is None
