"""Pre-aggregated tables, defined once for batch and for incremental upkeep.

A rollup is a set of group keys and measures that can be *merged*: sums, counts and
"latest by version" records. Averages are kept as sum and count and divided on read.
So the rollup of all rows equals the merged rollups of any split of the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.functions import calendar_month, distinct_sketch, ratio


@dataclass(frozen=True)
class Rollup:
    keys: dict[str, Column]
    # Name -> aggregate over rows; and the function that merges two of its values.
    measures: dict[str, Column]
    merge_with: dict[str, Callable] = field(default_factory=dict)
    # Output columns computed from the merged measures (None: the measures themselves).
    output: dict[str, Column] | None = None

    def partial(self, rows: DataFrame) -> DataFrame:
        """Mergeable rollup of some rows (batch, or a streaming aggregation)."""
        return rows.groupBy(*[c.alias(name) for name, c in self.keys.items()]).agg(
            *[c.alias(name) for name, c in self.measures.items()]
        )

    def merge(self, partials: DataFrame) -> DataFrame:
        """One rollup out of several partial ones."""
        return partials.groupBy(*self.keys).agg(
            *[self.merge_with.get(name, F.sum)(name).alias(name) for name in self.measures]
        )

    def finish(self, merged: DataFrame) -> DataFrame:
        columns = {name: F.col(name) for name in self.measures} if self.output is None else self.output
        return merged.select(*self.keys, *[c.alias(name) for name, c in columns.items()])

    def batch(self, rows: DataFrame) -> DataFrame:
        return self.finish(self.partial(rows))


def _cols(*names: str) -> dict[str, Column]:
    return {name: F.col(name) for name in names}


def _count() -> Column:
    return F.count(F.lit(1))


def triangle() -> Rollup:
    """Paid, incurred and outstanding per triangle cell, line and geography."""
    return Rollup(
        keys=_cols("accident_year", "development_month", "line_of_business", "geography"),
        measures={
            "total_paid": F.sum("paid_amount"),
            "total_incurred": F.sum("incurred_amount"),
            "total_outstanding": F.sum("outstanding_reserve"),
            "claim_count": _count(),
        },
    )


def triangle_projection() -> Rollup:
    """The triangle cells under the names of the per-table projection."""
    return Rollup(
        keys=triangle().keys,
        measures=triangle().measures,
        output={
            "cumulative_paid": F.col("total_paid"),
            "cumulative_incurred": F.col("total_incurred"),
            "total_outstanding": F.col("total_outstanding"),
            "claim_count": F.col("claim_count"),
        },
    )


def monthly_claims() -> Rollup:
    """Claims and their mean report delay per accident month and status."""
    return Rollup(
        keys={
            "accident_month": calendar_month("accident_date"),
            **_cols("line_of_business", "geography", "claim_status"),
        },
        measures={
            "claim_count": _count(),
            "total_incurred": F.sum("incurred_amount"),
            "total_paid": F.sum("paid_amount"),
            "delay_days": F.sum(F.datediff("report_date", "accident_date")),
            "delays_known": F.count(F.datediff("report_date", "accident_date")),
        },
        output={
            **_cols("claim_count", "total_incurred", "total_paid"),
            "avg_report_delay": ratio("delay_days", "delays_known"),
        },
    )


def active_policies() -> Rollup:
    """Claims, and about how many different policies they belong to, per accident year, line and geography.

    Distinct counts of parts can't be added up, so the parts keep sketches of the policies."""
    return Rollup(
        keys=_cols("accident_year", "line_of_business", "geography"),
        measures={"claim_count": _count(), "policies": distinct_sketch("policy_id")},
        merge_with={"policies": F.hll_union_agg},
        output={"claim_count": F.col("claim_count"), "policy_estimate": F.hll_sketch_estimate("policies")},
    )


def policy_geography() -> Rollup:
    """Policies, exposure and premium per geography, line and policy year."""
    return Rollup(
        keys={**_cols("geography", "line_of_business"), "policy_year": F.year("effective_date")},
        measures={
            "policy_count": _count(),
            "total_exposure": F.sum("sum_insured"),
            "total_premium": F.sum("premium"),
        },
    )


def policy_daily() -> Rollup:
    """Policies, exposure, premium and mean age per effective date."""
    return Rollup(
        keys=_cols("line_of_business", "geography", "effective_date"),
        measures={
            "policy_count": _count(),
            "total_sum_insured": F.sum("sum_insured"),
            "total_premium": F.sum("premium"),
            "age_years": F.sum("customer_age"),
            "ages_known": F.count("customer_age"),
        },
        output={
            **_cols("policy_count", "total_sum_insured", "total_premium"),
            "avg_customer_age": ratio("age_years", "ages_known"),
        },
    )


def ifrs17_reporting() -> Rollup:
    """Liability components per line, class and reporting year."""
    return Rollup(
        keys={**_cols("line_of_business", "profitability_class"), "reporting_year": F.year("valuation_date")},
        measures={
            "total_csm": F.sum("initial_csm"),
            "total_loss_component": F.sum("loss_component"),
            "total_lrc": F.sum("liability_remaining_coverage"),
            "total_bel": F.sum("best_estimate_liability"),
            "total_risk_adjustment": F.sum("risk_adjustment"),
        },
    )


def csm_movements() -> Rollup:
    """Opening and closing margin per valuation date, line, geography and class."""
    return Rollup(
        keys=_cols("valuation_date", "line_of_business", "geography", "profitability_class"),
        measures={
            "opening_csm": F.sum("initial_csm"),
            "period_amortization": F.sum("csm_amortization"),
            "contract_group_count": _count(),
        },
        output={
            **_cols("opening_csm", "period_amortization"),
            "closing_csm": F.col("opening_csm") - F.col("period_amortization"),
            "contract_group_count": F.col("contract_group_count"),
        },
    )


def reserve_latest() -> Rollup:
    """Reserve position of the latest valuation per contract group.

    The other fields of the record settle ties, so that the result does not depend on the
    order of arrival.
    """
    return Rollup(
        keys=_cols("line_of_business", "geography", "cohort_year"),
        measures={"latest": F.max(F.struct("valuation_date", "reserve_adequacy_ratio", "total_outstanding", "pv_claims")), "valuation_count": _count()},
        merge_with={"latest": F.max},
        output={
            "latest_valuation": F.col("latest.valuation_date"),
            "latest_adequacy_ratio": F.col("latest.reserve_adequacy_ratio"),
            "latest_outstanding": F.col("latest.total_outstanding"),
            "latest_pv_claims": F.col("latest.pv_claims"),
            "valuation_count": F.col("valuation_count"),
        },
    )
