"""Rules that derive claim attributes and the reserve table from claims.

Random inputs of a simulation are columns here (duration, premium ratio, ...): whoever
calls these functions supplies them per contract group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine import assumptions as A
from tontine.functions import dbl
from tontine.schemas import RESERVES

MONEY = "decimal(18,2)"
GROUP_KEYS = ["line_of_business", "geography", "cohort_year"]


# Claim-level rules ---------------------------------------------------------------------


def development_month(accident, report) -> Column:
    """Calendar months from accident to report, counted from 1; NULL if either date is missing."""
    months = (F.year(report) - F.year(accident)) * 12 + F.month(report) - F.month(accident) + 1
    return F.when(months.isNotNull(), F.greatest(F.lit(1), months))


def outstanding(developed, paid) -> Column:
    """What is still to be paid, never negative; NULL if either amount is missing."""
    left = F.col(developed) - F.col(paid)
    return F.when(left.isNotNull(), F.greatest(F.lit(0), left))


def claim_status(outstanding_reserve: Column) -> Column:
    (lowest, first), *rest = A.STATUS_LIMITS
    status = F.when(outstanding_reserve <= lowest, first)
    for limit, name in rest:
        status = status.when(outstanding_reserve <= limit, name)
    return status.when(outstanding_reserve.isNotNull(), "Reserved")


def quarter_end(date) -> Column:
    return F.last_day(F.add_months(F.trunc(date, "QUARTER"), 2))


# Contract groups -----------------------------------------------------------------------


def contract_groups(claims: DataFrame) -> DataFrame:
    """Claims per line, geography and accident year, with distinct policies.

    The one distinct count runs over rows already combined per policy, so a group with a
    large share of all claims is spread over its policies, and claims that were joined on
    the policy keep that partitioning. Where the count is not used, it is pruned and the
    groups are summed directly.
    """
    amounts = {
        "incurred_amount": "total_incurred",
        "paid_amount": "total_paid",
        "outstanding_reserve": "total_outstanding",
    }
    return (
        claims.groupBy("line_of_business", "geography", F.col("accident_year").alias("cohort_year"))
        .agg(
            F.count_distinct("policy_id").alias("policy_count"),
            F.count(F.lit(1)).alias("claim_count"),
            *[F.sum(c).cast(MONEY).alias(name) for c, name in amounts.items()],
        )
        .withColumn("contract_group_id", F.concat_ws("_", *GROUP_KEYS))
    )


def described_claims(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Claims with the line of business and geography of their policy. The merge hint keeps tables that are stored
    in buckets of the policy where they are: neither side is shuffled or broadcast."""
    described = policies.select("policy_id", "line_of_business", "geography").hint("merge")
    return claims.join(described, "policy_id", "left")


def contract_group_history(claims: DataFrame, valuations: list[tuple[int, int]]) -> DataFrame:
    """Contract groups as they were known at several valuations, with their ``valuation_date``.

    A valuation is a number of months from the start of the cohort's year, at whose end the group is valued, and
    the number of months whose reports it knows (fewer: a preliminary one, of the same date as its final). Claims
    reported later are left out of it, and a group without a known claim has none. The claims are summed once per
    policy for all valuations together, so that the distinct policies of a hot group are spread over its policies.
    """
    start = F.make_date("accident_year", F.lit(1), F.lit(1))
    reported = (F.year("report_date") - F.col("accident_year")) * 12 + F.month("report_date")
    amounts = {
        "incurred_amount": "total_incurred",
        "paid_amount": "total_paid",
        "outstanding_reserve": "total_outstanding",
    }
    per_policy, per_group, known_at = [], [], []
    for i, (valued, known) in enumerate(valuations):
        seen = reported <= known
        per_policy += [F.count_if(seen).alias(f"n_{i}"), *[F.sum(F.when(seen, F.col(c))).alias(f"{c}_{i}") for c in amounts]]
        per_group += [
            F.count_if(F.col(f"n_{i}") > 0).alias(f"policies_{i}"),
            F.sum(f"n_{i}").alias(f"n_{i}"),
            *[F.sum(f"{c}_{i}").cast(MONEY).alias(f"{c}_{i}") for c in amounts],
        ]
        known_at.append(
            F.struct(
                F.last_day(F.add_months(F.col("start"), valued - 1)).alias("valuation_date"),
                F.col(f"policies_{i}").alias("policy_count"),
                F.col(f"n_{i}").alias("claim_count"),
                *[F.col(f"{c}_{i}").alias(name) for c, name in amounts.items()],
            )
        )
    keys = ["line_of_business", "geography", F.col("accident_year").alias("cohort_year"), start.alias("start")]
    groups = claims.groupBy(*keys, "policy_id").agg(*per_policy).groupBy(*GROUP_KEYS, "start").agg(*per_group)
    return (
        groups.select(*GROUP_KEYS, F.inline(F.array(*known_at)))
        .where("claim_count > 0")
        .withColumn("contract_group_id", F.concat_ws("_", *GROUP_KEYS))
    )


# Reserve measures ----------------------------------------------------------------------


# Columns of one step may build on each other: Spark resolves them from left to right.


def with_discount_rates(groups: DataFrame, rates: dict[str, float] | None = None) -> DataFrame:
    """Add ``discount_rate`` per line of business."""
    rates = A.DISCOUNT_RATES if rates is None else rates
    (first, rate), *rest = rates.items()
    found = F.when(F.col("line_of_business") == first, rate)
    for line, rate in rest:
        found = found.when(F.col("line_of_business") == line, rate)
    return groups.withColumn("discount_rate", found.otherwise(A.DEFAULT_DISCOUNT_RATE))


def pv_measures(groups: DataFrame) -> DataFrame:
    """Present values. Needs discount_rate, duration_years and premium_ratio."""
    years = F.greatest(F.lit(0.5), dbl("duration_years"))
    factor = F.round(F.lit(1.0) / F.pow(F.lit(1.0) + F.col("discount_rate"), years), 6)
    return groups.withColumns(
        {
            "pv_factor": factor.cast("decimal(9,6)"),
            "pv_claims": (F.col("total_incurred") * F.col("pv_factor")).cast(MONEY),
            "pv_premiums": (F.col("pv_claims") * F.col("premium_ratio")).cast(MONEY),
        }
    )


def risk_and_acquisition(groups: DataFrame) -> DataFrame:
    """Risk adjustment and acquisition costs. Needs risk_rate and acquisition_rate."""
    return groups.withColumns(
        {
            "risk_adjustment": (F.col("pv_claims") * F.col("risk_rate")).cast(MONEY),
            "acquisition_costs": (F.col("pv_premiums") * F.col("acquisition_rate")).cast(MONEY),
        }
    )


def csm_split(groups: DataFrame) -> DataFrame:
    """Margin into contractual service margin (profitable) or loss component (onerous)."""
    margin = F.expr("pv_premiums - pv_claims - acquisition_costs - risk_adjustment")
    return groups.withColumns(
        {
            "margin": margin,
            "initial_csm": F.greatest(F.col("margin"), F.lit(0)).cast(MONEY),
            "loss_component": F.greatest(-F.col("margin"), F.lit(0)).cast(MONEY),
            "profitability_class": F.when(F.col("margin") > 0, "Profitable").otherwise("Onerous"),
        }
    ).drop("margin")


def csm_amortize(groups: DataFrame) -> DataFrame:
    """Coverage units and the quarter's release. Needs coverage_months and remaining_share."""
    units, left = F.col("coverage_units_total"), F.col("coverage_units_current")
    release = dbl("initial_csm") * left / F.nullif(units, F.lit(0)) * 0.25
    return groups.withColumns(
        {
            "coverage_units_total": (F.col("policy_count") * F.col("coverage_months")).cast("long"),
            "coverage_units_current": F.floor(units * F.col("remaining_share")).cast("long"),
            "csm_amortization": F.coalesce(release, F.lit(0.0)).cast(MONEY),
        }
    )


def liabilities(groups: DataFrame) -> DataFrame:
    """Best estimate, liability for remaining coverage and reserve adequacy."""
    adequacy = dbl("total_outstanding") / F.greatest(F.lit(1.0), dbl("pv_claims"))
    return groups.withColumns(
        {
            "best_estimate_liability": F.expr("pv_claims + risk_adjustment").cast(MONEY),
            "liability_remaining_coverage": F.expr(
                "best_estimate_liability + initial_csm - loss_component"
            ).cast(MONEY),
            "reserve_adequacy_ratio": adequacy.cast("decimal(18,4)"),
        }
    )


def reserve_metadata(groups: DataFrame) -> DataFrame:
    """Assumptions as nested JSON text. Needs confidence_level."""
    margin = F.round(dbl("risk_adjustment") / F.greatest(F.lit(1.0), dbl("pv_claims")), 4)
    record = F.struct(
        F.struct(F.col("discount_rate"), margin.alias("risk_margin")).alias("actuarial_assumptions"),
        F.lit("IFRS_17").alias("valuation_method"),
        F.col("confidence_level"),
        F.date_format("valuation_date", "yyyy-MM-dd").alias("last_updated"),
    )
    return groups.withColumn("reserve_metadata", F.to_json(record))


def reserve_table(groups: DataFrame) -> DataFrame:
    """All measures of contract groups that carry their assumption columns."""
    done = groups
    for step in (
        with_discount_rates,
        pv_measures,
        risk_and_acquisition,
        csm_split,
        csm_amortize,
        liabilities,
        reserve_metadata,
    ):
        done = step(done)
    return done.selectExpr(
        *[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in RESERVES]
    )
