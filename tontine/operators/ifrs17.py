"""IFRS 17 measures on the reserve table (one row per contract group and valuation)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.functions import above, dbl, distinct, json_number, mean, ratio


def _rounded_sum(c: str, name: str):
    return F.round(F.sum(c), 0).alias(name)


def summary(reserves: DataFrame) -> DataFrame:
    """Liability components per line of business and profitability class."""
    return (
        reserves.groupBy("line_of_business", "profitability_class")
        .agg(
            F.count(F.lit(1)).alias("contract_groups"),
            _rounded_sum("pv_premiums", "total_pv_premiums"),
            _rounded_sum("pv_claims", "total_pv_claims"),
            _rounded_sum("acquisition_costs", "total_acquisition_costs"),
            _rounded_sum("risk_adjustment", "total_risk_adjustment"),
            _rounded_sum("initial_csm", "total_csm"),
            _rounded_sum("loss_component", "total_loss_component"),
            _rounded_sum("liability_remaining_coverage", "total_lrc"),
            ratio(F.sum("initial_csm"), F.sum("pv_premiums"), 4).alias("csm_margin_ratio"),
            ratio(F.sum("loss_component"), F.sum("pv_premiums"), 4).alias("loss_ratio"),
        )
        .orderBy("line_of_business", "profitability_class")
    )


def csm_movement_rows(reserves: DataFrame) -> DataFrame:
    """Closing margin, amortization rate and remaining coverage of each profitable group."""
    return reserves.where((F.col("profitability_class") == "Profitable") & (F.col("initial_csm") > 0)).select(
        "contract_group_id",
        "line_of_business",
        "geography",
        "cohort_year",
        "valuation_date",
        "initial_csm",
        "csm_amortization",
        (F.col("initial_csm") - F.col("csm_amortization")).alias("closing_csm"),
        ratio("csm_amortization", "initial_csm", 4).alias("amortization_rate_period"),
        ratio("coverage_units_current", "coverage_units_total", 4).alias("remaining_coverage_ratio"),
    )


def csm_movements(reserves: DataFrame) -> DataFrame:
    """Opening to closing margin per line of business and reporting year."""
    # The rates have four decimals: averaged as decimals, the result has no order of addition.
    rate, remaining = (
        mean(F.col(c).cast("decimal(18,4)")) for c in ("amortization_rate_period", "remaining_coverage_ratio")
    )
    return (
        csm_movement_rows(reserves)
        .groupBy("line_of_business", F.year("valuation_date").alias("reporting_year"))
        .agg(
            F.count(F.lit(1)).alias("profitable_contract_groups"),
            _rounded_sum("initial_csm", "opening_csm"),
            _rounded_sum("csm_amortization", "period_amortization"),
            F.round(F.sum(F.col("closing_csm")), 0).alias("closing_csm"),
            F.round(rate, 4).alias("avg_amortization_rate"),
            F.round(remaining, 4).alias("avg_remaining_coverage"),
            F.round(dbl(F.sum("closing_csm")) * rate, 0).alias("projected_next_period_amort"),
        )
        .orderBy("line_of_business", F.desc("reporting_year"))
    )


def onerous_contracts(reserves: DataFrame) -> DataFrame:
    """Loss components of onerous groups per line, geography and cohort."""
    keys = ["line_of_business", "geography", "cohort_year"]
    return (
        reserves.where(F.col("profitability_class") == "Onerous")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("onerous_contract_groups"),
            _rounded_sum("loss_component", "total_loss_component"),
            _rounded_sum("pv_claims", "total_pv_claims"),
            _rounded_sum("pv_premiums", "total_pv_premiums"),
            _rounded_sum("risk_adjustment", "total_risk_adjustment"),
            ratio(F.sum("pv_claims"), F.sum("pv_premiums"), 4).alias("claims_to_premium_ratio"),
            ratio(F.sum("loss_component"), F.sum("pv_premiums"), 4).alias("loss_component_ratio"),
            F.sum("coverage_units_total").alias("total_coverage_units"),
            ratio(F.sum("loss_component"), F.sum("coverage_units_total"), 2).alias("loss_per_coverage_unit"),
        )
        .orderBy(F.desc("total_loss_component"), *keys)
    )


def discount_sensitivity(reserves: DataFrame, *, shift: float = 0.01, years: int = 5) -> DataFrame:
    """Effect of higher and lower discount rates on present values per line.

    Amounts are undiscounted by their own factor and discounted again over ``years`` at the
    shifted rate read from the group's metadata; groups without a rate are left out.
    """
    rate = F.col("rate")

    def shifted(c: str, by: float):
        # A factor of zero undiscounts to nothing (NULL), which the sum leaves out.
        return F.sum(ratio(c, "pv_factor") / F.pow(1 + rate + by, F.lit(float(years))))

    directions = [("up100bp", shift), ("down100bp", -shift)]
    per_line = (
        reserves.withColumn("rate", json_number("reserve_metadata", "actuarial_assumptions.discount_rate"))
        .where(rate.isNotNull())
        .groupBy("line_of_business")
        .agg(
            F.sum("pv_claims").alias("claims"),
            F.sum("pv_premiums").alias("premiums"),
            *[shifted("pv_claims", by).alias(f"{name}_claims") for name, by in directions],
            *[shifted("pv_premiums", by).alias(f"{name}_premiums") for name, by in directions],
        )
    )
    net = dbl(F.col("premiums") - F.col("claims"))
    impacts = []
    for name, _ in directions:
        claims, premiums = F.col(f"{name}_claims"), F.col(f"{name}_premiums")
        impacts += [
            F.round(claims - dbl("claims"), 0).alias(f"{name}_claims_impact"),
            F.round(premiums - dbl("premiums"), 0).alias(f"{name}_premiums_impact"),
            F.round(premiums - claims - net, 0).alias(f"{name}_net_impact"),
        ]
    return per_line.select(
        "line_of_business",
        F.round("claims", 0).alias("base_pv_claims"),
        F.round("premiums", 0).alias("base_pv_premiums"),
        F.round(F.col("premiums") - F.col("claims"), 0).alias("base_net_margin"),
        *impacts,
    ).orderBy(F.desc(F.abs("up100bp_net_impact")), "line_of_business")


def cohort_profitability(reserves: DataFrame) -> DataFrame:
    """Group counts by class, margin and loss ratio per cohort year and line."""
    net = F.sum("initial_csm") - F.sum("loss_component")
    profitable = F.count_if(F.col("profitability_class") == "Profitable")
    return (
        reserves.groupBy("cohort_year", "line_of_business")
        .agg(
            F.count(F.lit(1)).alias("total_contract_groups"),
            profitable.alias("profitable_groups"),
            F.count_if(F.col("profitability_class") == "Onerous").alias("onerous_groups"),
            ratio(profitable, F.count(F.lit(1)), 2).alias("profitable_ratio"),
            _rounded_sum("pv_premiums", "total_pv_premiums"),
            _rounded_sum("pv_claims", "total_pv_claims"),
            _rounded_sum("initial_csm", "total_csm"),
            _rounded_sum("loss_component", "total_loss_component"),
            F.round(net, 0).alias("net_profitability"),
            ratio(net, F.sum("pv_premiums"), 4).alias("profit_margin_ratio"),
            ratio(F.sum("pv_claims"), F.sum("pv_premiums"), 4).alias("loss_ratio"),
        )
        .orderBy(F.desc("cohort_year"), "line_of_business")
    )


def coverage_units(reserves: DataFrame) -> DataFrame:
    """Coverage units and what they imply for the margin still to be released."""
    total, current = F.sum("coverage_units_total"), F.sum("coverage_units_current")
    return (
        reserves.where(F.col("coverage_units_total") > 0)
        .groupBy("line_of_business", "profitability_class")
        .agg(
            F.count(F.lit(1)).alias("contract_groups"),
            total.alias("total_coverage_units"),
            current.alias("current_coverage_units"),
            ratio(current, total, 4).alias("remaining_coverage_ratio"),
            F.round(mean("coverage_units_total"), 0).alias("avg_total_units_per_group"),
            F.round(F.stddev_pop("coverage_units_total"), 0).alias("std_dev_coverage_units"),
            F.round(dbl(F.sum("initial_csm")) * ratio(current, total), 0).alias("expected_remaining_csm"),
            ratio(F.sum("csm_amortization"), F.sum("initial_csm"), 4).alias("period_amortization_rate"),
        )
        .orderBy("line_of_business", "profitability_class")
    )


def risk_adjustment(reserves: DataFrame, *, high: float = 0.10, moderate: float = 0.05) -> DataFrame:
    """Risk adjustment relative to claims and liability per line and geography."""
    keys = ["line_of_business", "geography"]
    level = ratio(F.sum("risk_adjustment"), F.sum("pv_claims"))
    return (
        reserves.withColumn("confidence", json_number("reserve_metadata", "confidence_level"))
        .where(F.col("confidence").isNotNull())
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("contract_groups"),
            _rounded_sum("risk_adjustment", "total_risk_adjustment"),
            _rounded_sum("pv_claims", "total_pv_claims"),
            _rounded_sum("best_estimate_liability", "total_bel"),
            F.round(mean(F.col("confidence").cast("decimal(18,6)")), 2).alias("avg_confidence_level"),
            F.round(level, 4).alias("ra_to_claims_ratio"),
            ratio(F.sum("risk_adjustment"), F.sum("best_estimate_liability"), 4).alias("ra_to_bel_ratio"),
            above(level, [(high, "High"), (moderate, "Moderate")], "Low").alias("risk_adjustment_level"),
        )
        .orderBy(F.desc("total_risk_adjustment"), *keys)
    )


def reserves_profile(reserves: DataFrame, *, method: str = "exact") -> DataFrame:
    """Size of the reserve table. ``method='sketch'`` estimates the distinct counts."""
    return (
        reserves.groupBy("line_of_business", "cohort_year", "profitability_class")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("initial_csm").alias("csm"),
            F.sum("loss_component").alias("loss"),
        )
        .agg(
            F.sum("n").alias("contract_groups_processed"),
            F.sum("csm").alias("total_csm_calculated"),
            F.sum("loss").alias("total_loss_component_calculated"),
            distinct("line_of_business", method).alias("lines_analyzed"),
            distinct("cohort_year", method).alias("cohort_years_analyzed"),
            distinct("profitability_class", method).alias("profitability_classes"),
        )
    )


def csm_by_rate(reserves: DataFrame) -> DataFrame:
    """Margin of profitable groups per line of business and discount rate."""
    rate = json_number("reserve_metadata", "actuarial_assumptions.discount_rate")
    return (
        reserves.where(F.col("profitability_class") == "Profitable")
        .groupBy("line_of_business", rate.alias("discount_rate"))
        .agg(F.sum("initial_csm").alias("total_csm"))
        .orderBy("line_of_business", "discount_rate")
    )
