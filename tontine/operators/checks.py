"""Summaries to look at after loading the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.functions import mean, side_by_side


def verify_policies(policies: DataFrame) -> DataFrame:
    return (
        policies.groupBy("line_of_business", "geography")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("effective_date").alias("first"),
            F.max("effective_date").alias("last"),
        )
        .agg(
            F.sum("n").alias("record_count"),
            F.min("first").alias("earliest_policy"),
            F.max("last").alias("latest_policy"),
            F.count_distinct("line_of_business").alias("lob_count"),
            F.count_distinct("geography").alias("geography_count"),
        )
    )


def verify_claims(claims: DataFrame) -> DataFrame:
    return (
        claims.groupBy("accident_year")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("accident_date").alias("first"),
            F.max("accident_date").alias("last"),
            F.max("development_month").alias("month"),
        )
        .agg(
            F.sum("n").alias("total_claims"),
            F.min("first").alias("earliest_accident"),
            F.max("last").alias("latest_accident"),
            F.count("accident_year").alias("accident_years"),
            F.max("month").alias("max_development_month"),
        )
    )


def verify_reserves(reserves: DataFrame) -> DataFrame:
    return (
        reserves.groupBy("line_of_business")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("initial_csm").alias("csm"),
            F.sum("loss_component").alias("loss"),
            F.sum("best_estimate_liability").alias("bel"),
        )
        .agg(
            F.sum("n").alias("contract_groups"),
            F.count("line_of_business").alias("lines_of_business"),
            F.sum("csm").alias("total_csm"),
            F.sum("loss").alias("total_loss_component"),
            F.sum("bel").alias("total_bel"),
        )
    )


def profitability_summary(reserves: DataFrame) -> DataFrame:
    return (
        reserves.groupBy("profitability_class")
        .agg(
            F.count(F.lit(1)).alias("contract_count"),
            F.sum("initial_csm").alias("total_csm"),
            F.sum("loss_component").alias("total_loss_component"),
            F.sum("liability_remaining_coverage").alias("total_lrc"),
            F.round(mean("reserve_adequacy_ratio"), 4).alias("avg_adequacy_ratio"),
        )
        .orderBy("profitability_class")
    )


def csm_by_line(reserves: DataFrame) -> DataFrame:
    csm, released = F.sum("initial_csm"), F.sum("csm_amortization")
    return (
        reserves.where(F.col("profitability_class") == "Profitable")
        .groupBy("line_of_business")
        .agg(
            csm.alias("total_csm"),
            released.alias("period_amortization"),
            (csm - released).alias("remaining_csm"),
            F.count(F.lit(1)).alias("contract_groups"),
        )
        .orderBy(F.desc("total_csm"), "line_of_business")
    )


def column_digests(df: DataFrame) -> DataFrame:
    """For each column: its known values, and a digest of them that doesn't depend on their order: the sum of the
    first 48 bits of each value's MD5, as text. Two tables with equal digests hold the same values in each column.
    One pass and one row to combine, whatever the number of columns."""

    def digest(name: str) -> Column:
        number = F.conv(F.substring(F.md5(F.col(name).cast("string").cast("binary")), 1, 12), 16, 10).cast("decimal(15,0)")
        return F.coalesce(F.sum(number).cast("decimal(38,0)"), F.lit(0)).cast("string")

    names = df.columns
    row = df.agg(
        *[F.count(name).alias(f"known_{i}") for i, name in enumerate(names)],
        *[digest(name).alias(f"digest_{i}") for i, name in enumerate(names)],
    )
    columns = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"known_{i}").alias("known"), F.col(f"digest_{i}").alias("digest"))
        for i, name in enumerate(names)
    ]
    return row.select(F.inline(F.array(*columns)))


def table_counts(policies: DataFrame, claims: DataFrame, reserves: DataFrame) -> DataFrame:
    tables = {"policies": policies, "claims": claims, "reserves": reserves}
    return side_by_side(
        *[df.agg(F.count(F.lit(1)).alias(f"{name}_loaded")) for name, df in tables.items()]
    )
