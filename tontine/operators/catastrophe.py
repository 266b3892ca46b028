"""Catastrophe exposure, event monitoring, stress tests and reinsurance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tontine import assumptions as A
from tontine.functions import above, as_date, mean, ratio, side_by_side, sum_where, total
from tontine.operators.reserving import is_catastrophe, unsettled


def exposed(policies: DataFrame) -> DataFrame:
    return policies.where(F.col("line_of_business").isin(A.CATASTROPHE_LINES))


def geographic_exposure(
    policies: DataFrame, *, high_value: int = 1_000_000, limit: int | None = None
) -> DataFrame:
    """Concentration of exposure per geography and line."""
    keys = ["geography", "line_of_business"]
    large = F.col("sum_insured") > high_value
    groups = (
        exposed(policies)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("policy_count"),
            F.sum("sum_insured").alias("exposure"),
            F.round(F.sum("premium"), 0).alias("total_premium"),
            F.round(mean("sum_insured"), 0).alias("avg_policy_size"),
            F.round(F.max("sum_insured"), 0).alias("largest_policy"),
            F.count_if(large).alias("high_value_policies"),
            sum_where("sum_insured", large).alias("high_value_exposure"),
        )
        # One row per geography and line: few enough for one task.
        .withColumn("everything", F.sum("exposure").over(Window.partitionBy()))
    )
    ordered = groups.select(
        *keys,
        "policy_count",
        F.round("exposure", 0).alias("total_exposure"),
        "total_premium",
        "avg_policy_size",
        "largest_policy",
        ratio("exposure", "everything", 4).alias("exposure_concentration_pct"),
        "high_value_policies",
        "high_value_exposure",
    ).orderBy(F.desc("total_exposure"), *keys)
    return ordered if limit is None else ordered.limit(limit)


def zone_table(spark: SparkSession, zones=A.HURRICANE_ZONES) -> DataFrame:
    """One row per exposed state (a constant of a few rows)."""
    rows = ", ".join(
        f"('{state}', '{zone}', {loss_ratio})" for zone, states, loss_ratio in zones for state in states
    )
    return spark.sql(f"select * from values {rows} as zones(state, hurricane_zone, loss_ratio)")


def hurricane_exposure(policies: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Expected hurricane losses per zone and line.

    Policies are summed per geography and line first; the join then sees that small result
    and the zone table. Only the built-in table is broadcast by hint; a table given by the
    caller (state, hurricane_zone, loss_ratio) is joined as its size suggests.
    """
    if zones is None:
        zones = F.broadcast(zone_table(policies.sparkSession))
    per_state = (
        exposed(policies)
        .groupBy("geography", "line_of_business")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("sum_insured").alias("exposure"),
            F.sum("premium").alias("premium"),
        )
    )
    gross = F.col("exposure") * F.col("loss_ratio")
    net = gross * F.lit(A.HURRICANE_RETENTION)
    return (
        per_state.join(zones, F.col("geography") == F.col("state"))
        .groupBy("hurricane_zone", "line_of_business", "loss_ratio")
        .agg(
            F.sum("n").alias("exposed_policies"),
            F.sum("exposure").cast("decimal(28,2)").alias("exposure"),
            F.sum("premium").cast("decimal(28,2)").alias("premium"),
        )
        .select(
            "hurricane_zone",
            "line_of_business",
            "exposed_policies",
            F.round("exposure", 0).alias("total_exposure"),
            F.round("premium", 0).alias("total_premium"),
            F.round(F.col("loss_ratio") * 100, 1).alias("expected_loss_ratio_pct"),
            F.round(gross, 0).alias("expected_gross_loss"),
            F.round(net, 0).alias("expected_net_loss"),
            ratio(gross, "premium", 2).alias("loss_to_premium_ratio"),
            ratio(net, "exposure", 4).alias("net_loss_ratio"),
        )
        .orderBy(F.desc("expected_gross_loss"), "hurricane_zone", "line_of_business")
    )


def hurricane_states(policies: DataFrame) -> DataFrame:
    """Exposure of the hurricane-prone states."""
    return (
        exposed(policies)
        .where(F.col("geography").isin(A.HURRICANE_GEOGRAPHIES))
        .groupBy("geography")
        .agg(F.sum("sum_insured").alias("total_exposure"))
        .orderBy("geography")
    )


def _hours_until(as_of, date: Column) -> Column:
    """Whole hours from midnight of a date to the valuation time."""
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return F.datediff(moment.cast("date"), date) * 24 + F.hour(moment)


def event_monitor(
    claims: DataFrame,
    *,
    as_of=None,
    since: str = "2024-01-01",
    large_loss: int = 100_000,
    event: str = "CAT_2024_001",
) -> DataFrame:
    """Claims of a catastrophe event per geography and line, with their development.

    A claim belongs to the event when flagged as catastrophe-related, or when it is large
    and lies in a hurricane state.
    """
    keys = ["event_code", "geography", "line_of_business"]
    in_event = is_catastrophe() | (
        (F.col("incurred_amount") > large_loss) & F.col("geography").isin(A.HURRICANE_GEOGRAPHIES)
    )
    hours = _hours_until(as_of, F.col("accident_date"))
    paid_share = ratio(F.sum("paid_amount"), F.sum("incurred_amount"), 4)
    return (
        claims.where(F.col("accident_date") >= F.lit(since).cast("date"))
        .where(in_event)
        .groupBy(F.lit(event).alias("event_code"), "geography", "line_of_business")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.round(F.sum("incurred_amount"), 0).alias("total_incurred"),
            F.round(F.sum("paid_amount"), 0).alias("total_paid"),
            F.round(F.sum("outstanding_reserve"), 0).alias("total_outstanding"),
            F.round(mean("incurred_amount"), 0).alias("avg_claim_severity"),
            F.round(F.max("incurred_amount"), 0).alias("max_claim_severity"),
            paid_share.alias("payment_ratio"),
            F.round(F.min(hours) / F.lit(24.0), 1).alias("min_days_since_event"),
            F.round(F.max(hours) / F.lit(24.0), 1).alias("max_days_since_event"),
            above(
                paid_share, [(0.5, "Fast Development"), (0.2, "Normal Development")], "Slow Development"
            ).alias("development_status"),
        )
        .orderBy(F.desc("total_incurred"), *keys)
    )


def scenario_table(spark: SparkSession, scenarios=A.STRESS_SCENARIOS) -> DataFrame:
    """Stress scenarios, one row each (a constant of a few rows)."""
    rows = ", ".join(
        "('{}', {}, array({}))".format(name, loss_ratio, ", ".join(f"'{state}'" for state in states))
        for name, loss_ratio, states in scenarios
    )
    return spark.sql(f"select * from values {rows} as scenarios(scenario_name, loss_ratio, affected_states)")


def stress_test(policies: DataFrame, scenarios: DataFrame | None = None) -> DataFrame:
    """Exposure and losses of the portfolio under each scenario.

    The scenarios' state lists are exploded and joined by equality to exposure summed per
    geography, instead of pairing every scenario with every group. A zero row per scenario
    keeps those that hit no state.
    """
    built_in = scenarios is None
    scenarios = scenario_table(policies.sparkSession) if built_in else scenarios
    at_risk = F.col("line_of_business").isin(A.CATASTROPHE_LINES)
    per_state = (
        policies.groupBy("geography")
        .agg(
            sum_where("sum_insured", at_risk).alias("exposure"),
            sum_where("premium", at_risk).alias("premium"),
            F.count_if(at_risk).alias("n"),
            F.sum("sum_insured").alias("all_lines"),
        )
        # One row per geography: few enough for one task.
        .withColumn("everything", F.sum("all_lines").over(Window.partitionBy()).cast("decimal(38,2)"))
    )
    name = ["scenario_name", "loss_ratio"]
    states = scenarios.select(*name, F.explode("affected_states").alias("state"))
    states = F.broadcast(states) if built_in else states
    hit = per_state.join(states, F.col("geography") == F.col("state")).select(
        *name, "exposure", "premium", "n", "everything"
    )
    zero = F.lit(0).cast("decimal(28,2)")
    nothing_hit = scenarios.select(
        *name,
        zero.alias("exposure"),
        zero.alias("premium"),
        F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("decimal(38,2)").alias("everything"),
    )
    gross = F.col("exposure") * F.col("loss_ratio")
    return (
        hit.unionByName(nothing_hit)
        .groupBy(*name)
        .agg(
            F.sum("exposure").cast("decimal(28,2)").alias("exposure"),
            F.sum("premium").cast("decimal(28,2)").alias("premium"),
            F.sum("n").alias("exposed_policies"),
            F.max("everything").alias("everything"),
        )
        .select(
            "scenario_name",
            F.round(F.col("loss_ratio") * 100, 1).alias("loss_ratio_pct"),
            "exposed_policies",
            F.round("exposure", 0).alias("exposed_sum_insured"),
            F.round("premium", 0).alias("exposed_premium"),
            F.round(gross, 0).alias("estimated_gross_loss"),
            F.round(gross * F.lit(A.STRESS_RETENTION), 0).alias("estimated_net_loss"),
            ratio(gross, "premium", 2).alias("loss_to_premium_ratio"),
            F.when(F.col("exposure") == 0, 0.0)
            .otherwise(ratio("exposure", "everything", 4))
            .alias("exposure_concentration"),
        )
        .orderBy(F.desc("estimated_gross_loss"), "scenario_name")
    )


def scenario_losses(spark: SparkSession, count: int = A.SCENARIO_COUNT) -> DataFrame:
    """The ladder of assumed gross losses, one row per step."""
    step = F.col("id")
    return spark.range(1, count + 1).select(
        F.concat(F.lit("Scenario_"), step.cast("string")).alias("scenario"),
        (F.lit(A.SCENARIO_LOSS_BASE) + step * A.SCENARIO_LOSS_STEP).cast("decimal(28,2)").alias("gross_loss"),
    )


def quarterly_losses(claims: DataFrame) -> DataFrame:
    """Gross losses as experienced: all incurred amounts per accident quarter, whatever their cause."""
    quarter = F.concat(F.year("accident_date"), F.lit("Q"), F.quarter("accident_date"))
    return claims.groupBy(quarter.alias("scenario")).agg(
        F.sum("incurred_amount").cast("decimal(28,2)").alias("gross_loss")
    )


def reinsurance(losses: DataFrame, layers=A.REINSURANCE_LAYERS) -> DataFrame:
    """Recoveries of a layered programme for each gross loss (``scenario``, ``gross_loss``).

    The layers are a handful of constants, so they become part of the expression.
    """
    gross = F.col("gross_loss")
    recovered = reduce(
        lambda a, b: a + b,
        [
            F.greatest(F.lit(0), F.least(gross - F.lit(attachment), F.lit(limit))) * F.lit(rate)
            for _, attachment, limit, rate in layers
        ],
    )
    net = gross - F.col("recovery")
    return (
        losses.withColumn("recovery", recovered.cast("decimal(28,4)"))
        .withColumn("net", net)
        .select(
            "scenario",
            F.round(gross, 0).alias("gross_loss"),
            F.round("recovery", 0).alias("reinsurance_recovery"),
            F.round("net", 0).alias("net_loss"),
            ratio("recovery", "gross_loss", 3).alias("recovery_ratio"),
            ratio("net", "gross_loss", 3).alias("net_retention_ratio"),
            above("net", A.REINSURANCE_IMPACT, A.REINSURANCE_SMALLEST_IMPACT).alias("impact_assessment"),
        )
        .orderBy("gross_loss", "scenario")
    )


def dashboard(policies: DataFrame, claims: DataFrame, *, as_of=None, days: int = 30) -> DataFrame:
    """Decision figures in one row: each table is read once, with conditional sums."""
    high_risk = F.col("geography").isin(A.HIGH_RISK_GEOGRAPHIES)
    recent = F.col("accident_date") >= F.date_sub(as_date(as_of), days)
    portfolio = exposed(policies).agg(
        F.count(F.lit(1)).alias("total_policies_at_risk"),
        total("sum_insured").alias("exposure"),
        total("premium").alias("premium"),
        F.count_if(high_risk).alias("high_risk_policies"),
        sum_where("sum_insured", high_risk).alias("high_risk"),
    )
    activity = claims.agg(
        sum_where("outstanding_reserve", unsettled()).alias("reserves"),
        F.count_if(recent & is_catastrophe()).alias("recent_cat_claims"),
        sum_where("incurred_amount", recent & is_catastrophe()).alias("recent_losses"),
    )
    strength = ratio("reserves", F.col("exposure") * F.lit("0.05").cast("decimal(3,2)"))
    return side_by_side(portfolio, activity).select(
        "total_policies_at_risk",
        F.round("exposure", 0).alias("total_exposure_at_risk"),
        F.round("premium", 0).alias("total_premium_cat_lines"),
        "high_risk_policies",
        F.round("high_risk", 0).alias("high_risk_exposure"),
        ratio("high_risk", "exposure", 3).alias("high_risk_concentration"),
        F.round("reserves", 0).alias("available_reserves"),
        "recent_cat_claims",
        F.round("recent_losses", 0).alias("recent_cat_losses_30d"),
        F.round(strength, 1).alias("reserve_adequacy_ratio"),
        above(strength, [(2.0, "Strong"), (1.0, "Adequate")], "Monitor Closely").alias(
            "financial_strength_status"
        ),
    )


def catastrophe_profile(policies: DataFrame, claims: DataFrame, *, as_of=None, days: int = 365) -> DataFrame:
    portfolio = (
        exposed(policies)
        .groupBy("geography")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("sum_insured").alias("exposure"))
        .agg(
            F.sum("n").alias("policies_analyzed"),
            F.sum("exposure").cast("decimal(38,2)").alias("exposure_analyzed"),
            F.count("geography").alias("geographic_regions_analyzed"),
        )
    )
    recent = claims.where(F.col("accident_date") >= F.date_sub(as_date(as_of), days)).agg(
        F.count(F.lit(1)).alias("recent_claims_analyzed")
    )
    return side_by_side(portfolio, recent)
