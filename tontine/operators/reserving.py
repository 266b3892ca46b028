"""Claim-reserve summaries, development, distribution, cash flow and risk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tontine import assumptions as A
from tontine.functions import (
    banded,
    calendar_month,
    dbl,
    distinct,
    distribution,
    json_field,
    mean,
    ratio,
    sum_where,
)


def unsettled():
    return F.col("claim_status").isin(A.UNSETTLED_STATUSES)


def is_catastrophe():
    return json_field("claim_attributes", "catastrophe_related") == "true"


def summary(claims: DataFrame, *, large_reserve: int = 100_000) -> DataFrame:
    """Reserve position of unsettled claims per line of business."""
    large = F.col("outstanding_reserve") > large_reserve
    return (
        claims.where(unsettled())
        .groupBy("line_of_business")
        .agg(
            F.count(F.lit(1)).alias("active_claims"),
            F.sum("outstanding_reserve").alias("total_reserves"),
            F.sum("paid_amount").alias("total_paid"),
            F.sum("incurred_amount").alias("total_incurred"),
            F.round(mean("outstanding_reserve"), 2).alias("avg_reserve_per_claim"),
            ratio(F.sum("outstanding_reserve"), F.sum("incurred_amount"), 4).alias("reserve_to_incurred_ratio"),
            ratio(F.sum("paid_amount"), F.sum("incurred_amount"), 4).alias("payment_ratio"),
            F.count_if(large).alias("large_reserves_100k_plus"),
            sum_where("outstanding_reserve", large).alias("large_reserves_amount"),
        )
        .orderBy(F.desc("total_reserves"), "line_of_business")
    )


def development_cells(claims: DataFrame, *, min_accident_year: int = 2020) -> DataFrame:
    """Reserve release and payment pattern per accident year, month and line."""
    release = F.col("initial_reserves") - F.col("current_reserves")
    return (
        claims.where(F.col("accident_year") >= min_accident_year)
        .groupBy("accident_year", "development_month", "line_of_business")
        .agg(
            F.sum("initial_reserve").alias("initial_reserves"),
            F.sum("outstanding_reserve").alias("current_reserves"),
            F.sum("paid_amount").alias("paid_to_date"),
            F.count(F.lit(1)).alias("claim_count"),
        )
        .where(F.col("initial_reserves") > 0)
        .withColumn("reserve_change", release)
        .withColumn("reserve_release_ratio", ratio(release, "initial_reserves", 4))
        .withColumn(
            "payment_pattern", ratio("paid_to_date", F.col("paid_to_date") + F.col("current_reserves"), 4)
        )
    )


def development(claims: DataFrame, *, min_accident_year: int = 2020, tolerance: float = 0.1) -> DataFrame:
    """Release of initial reserves per accident year and line, with an assessment."""
    released = ratio("total_reserve_release", "total_initial_reserves")
    return (
        development_cells(claims, min_accident_year=min_accident_year)
        .groupBy("accident_year", "line_of_business")
        .agg(
            F.max("development_month").alias("latest_development"),
            F.sum("initial_reserves").alias("total_initial_reserves"),
            F.sum("current_reserves").alias("total_current_reserves"),
            F.sum("reserve_change").alias("total_reserve_release"),
        )
        .withColumn("overall_release_ratio", F.round(released, 4))
        .withColumn(
            "adequacy_assessment",
            F.when(released > tolerance, "Over-Reserved")
            .when(released < -tolerance, "Under-Reserved")
            .otherwise("Adequate"),
        )
        .orderBy(F.desc("accident_year"), "line_of_business")
    )


def quantiles(claims: DataFrame, *, min_claims: int = 10, method: str = "exact") -> DataFrame:
    """Distribution of outstanding reserves per line, accident year and status.

    ``method='approx'`` uses Spark's single-pass sketch instead of exact ranks.
    """
    keys = ["line_of_business", "accident_year", "claim_status"]
    wanted = {"p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95}
    stats = reserve_distribution(
        claims.where(F.col("outstanding_reserve") > 0), keys, wanted, method=method
    )
    return (
        stats.where(F.col("n") > min_claims)
        .select(
            *keys,
            F.col("n").alias("claim_count"),
            F.round("total", 0).alias("total_reserves"),
            F.round("p50", 0).alias("median_reserve"),
            F.round("p75", 0).alias("p75_reserve"),
            F.round("p90", 0).alias("p90_reserve"),
            F.round("p95", 0).alias("p95_reserve"),
            F.round("deviation", 0).alias("reserve_volatility"),
            ratio("deviation", "p50", 2).alias("coefficient_of_variation"),
            F.round(F.col("total") * F.lit("1.1").cast("decimal(2,1)"), 0).alias("reserve_10pct_buffer"),
            F.round(F.col("total") * F.lit("1.2").cast("decimal(2,1)"), 0).alias("reserve_20pct_buffer"),
        )
        .orderBy("line_of_business", F.desc("accident_year"), "claim_status")
    )


def reserve_distribution(claims: DataFrame, keys: list[str], wanted: dict[str, float], *, method: str) -> DataFrame:
    """Count, total, mean, deviation and quantiles of the outstanding reserve."""
    if method == "exact":
        return distribution(claims, keys, "outstanding_reserve", wanted)
    if method != "approx":
        raise ValueError(f"unknown method {method!r}")
    value = dbl("outstanding_reserve")
    return claims.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("outstanding_reserve").alias("total"),
        mean("outstanding_reserve").alias("mean"),
        F.stddev_pop(value).alias("deviation"),
        *[F.percentile_approx(value, q).alias(name) for name, q in wanted.items()],
    )


def catastrophe_reserves(
    claims: DataFrame,
    *,
    min_accident_year: int = 2022,
    large_loss: int = 50_000,
    min_claims: int = 5,
    limit: int | None = None,
) -> DataFrame:
    """Reserves by loss type, accident year and geography, as a share of all reserves.

    The overall total is taken over the groups, before the small ones are dropped, so the
    claims are read once.
    """
    kind = (
        F.when(is_catastrophe(), "CAT")
        .when(F.col("outstanding_reserve") > large_loss, "Large Loss")
        .otherwise("Attritional")
    )
    keys = ["loss_type", "accident_year", "geography"]
    groups = (
        claims.where(F.col("accident_year") >= min_accident_year)
        .withColumn("loss_type", kind)
        .groupBy(*keys, calendar_month("accident_date").alias("accident_month"), "line_of_business")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("outstanding_reserve").alias("outstanding"),
            F.sum("paid_amount").alias("paid"),
            F.sum("incurred_amount").alias("incurred"),
            mean("outstanding_reserve").alias("mean_reserve"),
        )
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("total_claims"),
            F.sum("outstanding").alias("outstanding"),
            F.sum("paid").alias("paid"),
            F.sum("incurred").alias("incurred"),
            F.round(F.avg("mean_reserve"), 0).alias("avg_reserve_per_claim"),
        )
        # One row per loss type, year and geography: few enough for one task.
        .withColumn("everything", F.sum("outstanding").over(Window.partitionBy()))
    )
    ordered = (
        groups.where(F.col("total_claims") > min_claims)
        .select(
            *keys,
            "total_claims",
            F.round("outstanding", 0).alias("total_reserves"),
            F.round("paid", 0).alias("total_paid"),
            "avg_reserve_per_claim",
            ratio("outstanding", "everything", 4).alias("reserve_concentration"),
            ratio("paid", "incurred", 4).alias("payment_ratio"),
        )
        .orderBy(F.desc("total_reserves"), *keys)
    )
    return ordered if limit is None else ordered.limit(limit)


def cashflow_projection(claims: DataFrame, *, min_accident_year: int = 2020) -> DataFrame:
    """Payments expected within 12, 24, 36 and 48 months per line of business.

    Defined as unsettled claims joined to the payment pattern of their line: the reserve of
    a line counts once per month of its pattern, and lines without a pattern share one
    NULL row. Both sides come from the same claims, so one aggregation per (line, month)
    carries the two sums and the join becomes a second, tiny aggregation.
    """
    recent = F.col("accident_year") >= min_accident_year
    per_month = (
        claims.groupBy("line_of_business", "development_month")
        .agg(
            sum_where("paid_amount", recent).alias("paid"),
            sum_where("outstanding_reserve", recent).alias("outstanding"),
            F.max(recent).alias("in_pattern"),
            sum_where("outstanding_reserve", unsettled()).alias("reserve"),
            F.count_if(unsettled()).alias("unsettled_claims"),
        )
    )
    month = F.col("development_month")
    weight = banded(month, [(last + 1, w) for last, w in A.PAYMENT_BANDS], 0.0)
    share = ratio("paid", F.col("paid") + F.col("outstanding"), 4) * weight
    horizons = [last for last, _ in A.PAYMENT_BANDS]
    shares = [
        F.max(F.when(F.col("in_pattern"), F.when(month <= last, share).otherwise(0.0))).alias(f"share_{i}")
        for i, last in enumerate(horizons, 1)
    ]
    per_line = (
        per_month.groupBy("line_of_business")
        .agg(
            F.sum("reserve").alias("reserve"),
            F.sum("unsettled_claims").alias("unsettled_claims"),
            F.count_if(F.col("in_pattern")).alias("months"),
            *shares,
        )
        .where(F.col("unsettled_claims") > 0)
    )
    # A missing line joins nothing, so its claims count once and have no pattern.
    has_pattern = (F.col("months") > 0) & F.col("line_of_business").isNotNull()
    return (
        per_line.groupBy(F.when(has_pattern, F.col("line_of_business")).alias("line_of_business"))
        .agg(
            F.sum(F.col("reserve") * F.when(has_pattern, F.col("months")).otherwise(1)).alias("current_reserves"),
            *[
                F.coalesce(F.max(F.when(has_pattern, F.col(f"share_{i}"))), F.lit(0.0)).alias(f"share_{i}")
                for i in range(1, len(horizons) + 1)
            ],
        )
        .select(
            "line_of_business",
            "current_reserves",
            *[
                F.round(dbl("current_reserves") * F.col(f"share_{i}"), 0).alias(f"projected_payments_year{i}")
                for i in range(1, len(horizons) + 1)
            ],
        )
        .orderBy(F.desc("current_reserves"), "line_of_business")
    )


def risk_metrics(
    claims: DataFrame, *, min_accident_year: int = 2020, min_claims: int = 20, method: str = "exact"
) -> DataFrame:
    """Volatility, capital estimate and tail of reserves per line of business."""
    open_amounts = claims.where(
        (F.col("outstanding_reserve") > 0) & (F.col("accident_year") >= min_accident_year)
    )
    keys = ["line_of_business", "geography", "accident_year"]
    cells = reserve_distribution(open_amounts, keys, {"p99": 0.99}, method=method).where(
        F.col("n") > min_claims
    )
    capital = dbl("reserves") * F.sqrt("variation")
    return (
        cells.withColumn("variation", ratio("deviation", "mean"))
        .groupBy("line_of_business")
        .agg(
            F.sum("n").alias("total_claims"),
            F.sum("total").alias("reserves"),
            F.avg("mean").alias("average"),
            F.avg("variation").alias("variation"),
            F.avg("p99").alias("tail"),
        )
        .select(
            "line_of_business",
            "total_claims",
            F.round("reserves", 0).alias("total_reserves"),
            F.round("average", 0).alias("avg_reserve_per_claim"),
            F.round("variation", 4).alias("avg_coefficient_variation"),
            F.round(capital, 0).alias("reserve_risk_capital_estimate"),
            ratio(capital, "reserves", 4).alias("capital_ratio"),
            F.round("tail", 0).alias("avg_p99_reserve"),
            ratio("tail", "average", 2).alias("tail_risk_multiplier"),
        )
        .orderBy(F.desc("reserve_risk_capital_estimate"), "line_of_business")
    )


def reserve_profile(claims: DataFrame, *, method: str = "exact") -> DataFrame:
    """Size of the reserves. ``method='sketch'`` estimates the distinct counts."""
    return (
        claims.where(F.col("outstanding_reserve") > 0)
        .groupBy("line_of_business", "accident_year", "geography")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("outstanding_reserve").alias("reserve"))
        .agg(
            F.sum("n").alias("claims_analyzed"),
            F.sum("reserve").alias("total_reserves_calculated"),
            distinct("line_of_business", method).alias("lines_analyzed"),
            distinct("accident_year", method).alias("accident_years_analyzed"),
            distinct("geography", method).alias("geographies_analyzed"),
        )
    )


def p95_by_line(claims: DataFrame, *, method: str = "exact") -> DataFrame:
    """Total and 95th percentile of unsettled reserves per line of business."""
    stats = reserve_distribution(claims.where(unsettled()), ["line_of_business"], {"p95": 0.95}, method=method)
    # Cents at a rank in hundredths: four decimals are exact.
    return stats.select(
        "line_of_business", F.col("total").alias("total_reserves"), F.round("p95", 4).alias("p95_reserve")
    ).orderBy("line_of_business")
