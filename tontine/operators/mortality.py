"""Mortality studies of the life portfolio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tontine import assumptions as A
from tontine.functions import as_date, banded, dbl, json_field, mean, ratio


def life(policies: DataFrame, since: str | None = None) -> DataFrame:
    chosen = policies.where(F.col("line_of_business") == "Life")
    return chosen if since is None else chosen.where(F.col("effective_date") >= F.lit(since).cast("date"))


def _band_number(age) -> Column:
    """Position of an age in the band table, from 1."""
    bounds = [(upper, i) for i, (_, upper, _, _) in enumerate(A.MORTALITY_BANDS, 1) if upper]
    return banded(age, bounds, len(A.MORTALITY_BANDS))


def _of_band(number, field: int) -> Column:
    return F.element_at(F.array(*[F.lit(band[field]) for band in A.MORTALITY_BANDS]), number)


def exposure(policies: DataFrame) -> DataFrame:
    """Exposure per age and gender, with standard-health and senior counts."""
    return (
        life(policies)
        .groupBy("customer_age", "customer_gender")
        .agg(
            F.count(F.lit(1)).alias("exposure_count"),
            F.count_if(json_field("risk_factors", "health_rating") == "Standard").alias("standard_risk"),
            F.count_if(F.col("customer_age") > 65).alias("senior_policies"),
        )
        .withColumn("age_band", _of_band(_band_number("customer_age"), 0))
    )


def experience(policies: DataFrame) -> DataFrame:
    """Exposure and expected deaths per age band and gender."""
    number = F.col("band")
    return (
        exposure(policies)
        .groupBy(_band_number("customer_age").alias("band"), "customer_gender")
        .agg(F.sum("exposure_count").alias("total_exposure"))
        .orderBy("band", "customer_gender")
        .select(
            _of_band(number, 0).alias("age_band"),
            "customer_gender",
            "total_exposure",
            F.round(F.col("total_exposure") * _of_band(number, 2), 2).alias("expected_deaths"),
            F.round(_of_band(number, 3), 1).alias("expected_rate_per_1000"),
        )
    )


def monthly_experience(policies: DataFrame, *, since: str | None, digits: int = 1) -> DataFrame:
    """Policies, simulated and expected deaths per month, age group and gender."""
    inforce = F.count(F.lit(1))
    return (
        life(policies, since)
        .groupBy(
            F.trunc("effective_date", "MM").alias("month_start"),
            banded("customer_age", A.TREND_AGE_GROUPS, A.TREND_OLDEST_GROUP).alias("age_group"),
            "customer_gender",
        )
        .agg(inforce.alias("policies_inforce"))
        .withColumn("actual_deaths", F.round(F.col("policies_inforce") * F.lit(A.TREND_ACTUAL_RATE), digits))
        .withColumn("expected_deaths", F.round(F.col("policies_inforce") * F.lit(A.TREND_EXPECTED_RATE), digits))
    )


def trend(
    policies: DataFrame, *, since: str = "2022-01-01", digits: int = 1, limit: int | None = None
) -> DataFrame:
    """Actual to expected deaths by month, with a 12-row mean and the ratio to 12 rows ago.

    ``digits`` is the precision of the simulated deaths: with one digit, cells of fewer
    than 25 policies have none and drop out.
    """
    series = Window.partitionBy("age_group", "customer_gender").orderBy("month_start")
    a_to_e = ratio("actual_deaths", "expected_deaths")
    ordered = (
        monthly_experience(policies, since=since, digits=digits)
        .where(F.col("actual_deaths") > 0)
        .select(
            "month_start",
            "age_group",
            "customer_gender",
            "policies_inforce",
            "actual_deaths",
            "expected_deaths",
            F.round(a_to_e, 4).alias("actual_to_expected_ratio"),
            F.round(F.avg(a_to_e).over(series.rowsBetween(-11, 0)), 4).alias("rolling_12m_ae_ratio"),
            ratio("actual_deaths", F.lag("actual_deaths", 12).over(series), 4).alias("yoy_mortality_ratio"),
        )
        .orderBy(F.desc("month_start"), "age_group", "customer_gender")
    )
    return ordered if limit is None else ordered.limit(limit)


def actual_to_expected(policies: DataFrame, *, since: str | None = None, digits: int = 1) -> DataFrame:
    """Exposure and actual-to-expected ratio per age group and gender over all months."""
    return (
        monthly_experience(policies, since=since, digits=digits)
        .groupBy("age_group", "customer_gender")
        .agg(
            F.sum("policies_inforce").alias("exposure"),
            ratio(F.sum("actual_deaths"), F.sum("expected_deaths"), 4).alias("actual_to_expected_ratio"),
        )
        .orderBy("age_group", "customer_gender")
    )


def _by_state(field: int) -> Column:
    (states, *first), *rest = A.GEOGRAPHIC_MORTALITY
    chain = F.when(F.col("geography").isin(states), F.lit(first[field]))
    for states, *values in rest:
        chain = chain.when(F.col("geography").isin(states), F.lit(values[field]))
    return chain.otherwise(F.lit(A.GEOGRAPHIC_MORTALITY_ELSEWHERE[field]))


def by_geography(policies: DataFrame, *, min_policies: int = 1000) -> DataFrame:
    """Cover, expected deaths, credibility and pricing factor per geography."""
    n = F.col("life_policies")
    return (
        life(policies)
        .groupBy("geography")
        .agg(
            F.count(F.lit(1)).alias("life_policies"),
            F.sum("sum_insured").alias("total_coverage"),
            F.round(mean("customer_age"), 1).alias("avg_age"),
        )
        .where(n > min_policies)
        .withColumn("expected_annual_deaths", F.round(n * _by_state(0), 1))
        .withColumn("credibility_factor", F.round(F.sqrt(dbl(n)) / 100, 2))
        .withColumn("geographic_pricing_factor", F.round(_by_state(1), 3))
        .orderBy(F.desc("expected_annual_deaths"), "geography")
    )


def cohorts(policies: DataFrame, *, as_of=None, since: str = "2020-01-01") -> DataFrame:
    """Duration-adjusted mortality per issue year and gender.

    The duration counts calendar-year boundaries, so it is one number per issue year; ages
    are averaged over the (age) cells of a cohort, not over its policies.
    """
    duration = F.year(as_date(as_of)) - F.col("issue_year")
    improvement = F.lit(1) - F.col("duration") * F.lit(A.DURATION_IMPROVEMENT)
    deaths = F.sum(F.col("cohort_size") * F.col("rate"))
    return (
        life(policies, since)
        .groupBy(F.year("effective_date").alias("issue_year"), "customer_age", "customer_gender")
        .agg(F.count(F.lit(1)).alias("cohort_size"))
        .withColumn("duration", duration)
        .withColumn("base", banded("customer_age", A.COHORT_MORTALITY, A.COHORT_MORTALITY_OLDEST))
        .withColumn("rate", (F.col("base") * improvement).cast("decimal(12,8)"))
        .groupBy("issue_year", "customer_gender")
        .agg(
            F.sum("cohort_size").alias("total_policies"),
            F.round(mean("customer_age"), 1).alias("avg_issue_age"),
            F.round(mean("duration"), 1).alias("avg_duration"),
            F.round(deaths, 1).alias("expected_annual_deaths"),
            F.round(ratio(deaths, F.sum("cohort_size")) * 1000, 2).alias("mortality_rate_per_1000"),
        )
        .orderBy(F.desc("issue_year"), "customer_gender")
    )


def shocks(policies: DataFrame, *, min_policies: int = 500, limit: int | None = None) -> DataFrame:
    """Expected claims per geography and gender under mortality shocks."""
    base = F.col("base")
    (_, pandemic), *_ = A.MORTALITY_SHOCKS
    impact = base * F.lit(pandemic) - base
    ordered = (
        life(policies)
        .groupBy("geography", "customer_gender")
        .agg(
            F.count(F.lit(1)).alias("policy_count"),
            F.sum("sum_insured").alias("cover"),
            F.round(mean("customer_age"), 1).alias("avg_age"),
        )
        .where(F.col("policy_count") > min_policies)
        .withColumn("base", F.col("cover") * F.lit(A.EXPECTED_CLAIM_RATE))
        .select(
            "geography",
            "customer_gender",
            "policy_count",
            F.round("cover", 0).alias("total_coverage"),
            "avg_age",
            F.round(base, 0).alias("base_expected_claims"),
            *[F.round(base * F.lit(shock), 0).alias(name) for name, shock in A.MORTALITY_SHOCKS],
            F.round(impact, 0).alias("pandemic_impact"),
            ratio(impact, base, 4).alias("impact_ratio"),
        )
        .orderBy(F.desc("pandemic_impact"), "geography", "customer_gender")
    )
    return ordered if limit is None else ordered.limit(limit)


def life_profile(policies: DataFrame) -> DataFrame:
    return (
        life(policies)
        .groupBy("customer_age", "geography", "customer_gender")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("sum_insured").alias("cover"))
        .agg(
            F.sum("n").alias("life_policies_analyzed"),
            F.count_distinct("customer_age").alias("age_cohorts"),
            F.count_distinct("geography").alias("geographic_regions"),
            F.count_distinct("customer_gender").alias("gender_categories"),
            F.round(F.sum("cover"), 0).alias("total_coverage_analyzed"),
        )
    )
