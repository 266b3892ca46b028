"""Loss-development triangles, age-to-age factors and chain-ladder projections.

Every operator first sums the claims per accident year and development month. That one
aggregation is combined before its shuffle; all later windows, arrays and joins work on
its result, which has at most (years x months) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tontine import assumptions as A
from tontine.functions import (
    adjacent_difference,
    as_date,
    banded,
    dbl,
    distinct,
    list_product,
    ordered_values,
    ratio,
)


def cells(claims: DataFrame, keys: list[str], min_accident_year: int) -> DataFrame:
    """Triangle cells: paid, incurred and count per key combination.

    ``claims`` are claims, or the cells of ``rollups.triangle`` (batch, or kept up to date by a stream), which are
    summed up to the wanted keys instead; the claims themselves are then not read.
    """
    rolled_up = "total_paid" in claims.columns
    paid, incurred = ("total_paid", "total_incurred") if rolled_up else ("paid_amount", "incurred_amount")
    return (
        claims.where(F.col("accident_year") >= min_accident_year)
        .groupBy(*keys)
        .agg(
            F.sum(paid).alias("cumulative_paid"),
            F.sum(incurred).alias("cumulative_incurred"),
            (F.sum("claim_count") if rolled_up else F.count(F.lit(1))).alias("claim_count"),
        )
    )


def triangle(
    claims: DataFrame, *, min_accident_year: int = 2020, limit: int | None = None
) -> DataFrame:
    """Cells in order; ``limit`` is the length of the report (None for all)."""
    keys = ["accident_year", "development_month"]
    ordered = cells(claims, keys, min_accident_year).orderBy(*keys)
    return ordered if limit is None else ordered.limit(limit)


def triangle_recent(claims: DataFrame, *, as_of=None, years: int = 3, limit: int | None = None) -> DataFrame:
    """Cells of the accident years since ``years`` before the valuation year."""
    since = F.year(as_date(as_of)) - years
    keys = ["accident_year", "development_month"]
    ordered = (
        claims.where(F.col("accident_year") >= since)
        .groupBy(*keys)
        .agg(
            F.sum("paid_amount").alias("total_paid"),
            F.sum("incurred_amount").alias("total_incurred"),
            F.count(F.lit(1)).alias("claim_count"),
        )
        .orderBy(*keys)
    )
    return ordered if limit is None else ordered.limit(limit)


def triangle_arrays(claims: DataFrame, *, min_accident_year: int = 2020, months: int = 12) -> DataFrame:
    """One row per accident year: paid amounts and their steps as arrays by month."""
    paid = F.col("paid")
    steps = adjacent_difference(paid)
    return (
        cells(claims, ["accident_year", "development_month"], min_accident_year)
        .groupBy("accident_year")
        .agg(ordered_values("development_month", "cumulative_paid").alias("paid"))
        .select(
            "accident_year",
            F.slice(paid, 1, months).alias("paid_triangle_12m"),
            F.slice(steps, 1, months).alias("incremental_paid_12m"),
            # The steps of an array add up to its last minus its first element.
            (F.element_at(paid, -1) - F.element_at(paid, 1)).alias("ultimate_loss_estimate"),
            F.size(paid).alias("development_periods"),
        )
        .orderBy("accident_year")
    )


def development_factors(
    claims: DataFrame,
    *,
    min_accident_year: int = 2020,
    min_prior_paid: int = 1000,
    min_points: int = 3,
    limit: int | None = None,
) -> DataFrame:
    """Age-to-age factors per development month over the accident years."""
    by_month = Window.partitionBy("accident_year").orderBy("development_month")
    points = (
        cells(claims, ["accident_year", "development_month"], min_accident_year)
        .withColumn("prior_paid", F.lag("cumulative_paid").over(by_month))
        .where(F.col("prior_paid") > min_prior_paid)
        .withColumn("factor", ratio("cumulative_paid", "prior_paid"))
    )
    factor, weight = F.col("factor"), dbl("prior_paid")
    ordered = (
        points.groupBy("development_month")
        .agg(
            F.count(F.lit(1)).alias("data_points"),
            F.round(F.avg(factor), 4).alias("avg_factor"),
            F.round(F.median(factor), 4).alias("median_factor"),
            F.round(F.stddev_pop(factor), 4).alias("factor_volatility"),
            ratio(F.sum(weight * factor), F.sum(weight), 4).alias("selected_factor"),
        )
        .where(F.col("data_points") >= min_points)
        .orderBy("development_month")
    )
    return ordered if limit is None else ordered.limit(limit)


def selected_factor(month, steps=A.DEVELOPMENT_FACTORS, tail=A.DEVELOPMENT_TAIL) -> Column:
    """Selected factor of a development month, from a table of last months."""
    return dbl(banded(month, [(last + 1, factor) for last, factor in steps], tail))


def _projectable(claims: DataFrame, min_accident_year: int) -> DataFrame:
    """Cells that have a month and an amount. Both uses of them in a projection need both
    columns, so the aggregation runs once and its exchange is reused."""
    triangle_cells = cells(claims, ["accident_year", "development_month"], min_accident_year)
    return triangle_cells.where(
        F.col("development_month").isNotNull() & F.col("cumulative_paid").isNotNull()
    )


def _months(triangle_cells: DataFrame) -> DataFrame:
    """One row holding the (short) list of months with factor and number of years."""
    return (
        triangle_cells.groupBy("development_month")
        .agg(F.count(F.lit(1)).alias("years"))
        .withColumn("factor", selected_factor("development_month"))
        .agg(F.array_sort(F.collect_list(F.struct("development_month", "factor", "years"))).alias("months"))
    )


def chain_ladder_literal(
    claims: DataFrame, *, min_accident_year: int = 2020, horizon: int = 50
) -> DataFrame:
    """Projection with the factors *up to* a month, each once per accident year.

    For month d, list the factors of all cells with month <= d in month order, keep
    ``horizon`` elements from position d, and multiply. The list depends on the month
    alone, so it is worked out once per month (at most a few hundred rows, whatever the
    number of claims) and joined to the cells.
    """
    triangle_cells = _projectable(claims, min_accident_year)
    month = F.col("m.development_month")
    repeated = F.flatten(
        F.transform(
            F.filter("months", lambda x: x["development_month"] <= month),
            lambda x: F.array_repeat(x["factor"], x["years"].cast("int")),
        )
    )
    products = (
        _months(triangle_cells)
        .select("months", F.explode("months").alias("m"))
        .select(
            month.alias("development_month"),
            list_product(F.slice(repeated, month, F.lit(horizon))).alias("product"),
        )
    )
    projected = triangle_cells.join(products, "development_month").withColumn(
        "projection", dbl("cumulative_paid") * F.col("product")
    )
    latest, ultimate = F.max("cumulative_paid"), F.max("projection")
    return (
        projected.groupBy("accident_year")
        .agg(latest.alias("latest_paid"), ultimate.alias("ultimate"))
        .select(
            "accident_year",
            "latest_paid",
            F.round("ultimate", 2).alias("ultimate_projection"),
            F.round(F.col("ultimate") - dbl("latest_paid"), 2).alias("ibnr_estimate"),
            ratio(F.col("ultimate") - dbl("latest_paid"), "latest_paid", 4).alias("ibnr_ratio"),
        )
        .orderBy(F.desc("accident_year"))
    )


def chain_ladder(claims: DataFrame, *, as_of=None, min_accident_year: int = 2020) -> DataFrame:
    """Textbook projection of what is reported so far: the latest cell of an accident year
    times the factors of all later months that occur in the triangle (Mack 1993)."""
    known = claims.where(F.col("report_date") <= as_date(as_of))
    triangle_cells = _projectable(known, min_accident_year)
    month = F.col("m.development_month")
    later = F.filter("months", lambda x: x["development_month"] > month)
    to_ultimate = (
        _months(triangle_cells)
        .select("months", F.explode("months").alias("m"))
        .select(
            month.alias("development_month"),
            list_product(F.transform(later, lambda x: x["factor"])).alias("to_ultimate"),
        )
    )
    latest = triangle_cells.groupBy("accident_year").agg(
        F.max("development_month").alias("development_month"),
        F.max_by("cumulative_paid", "development_month").alias("latest_paid"),
    )
    ultimate = dbl("latest_paid") * F.col("to_ultimate")
    return (
        latest.join(to_ultimate, "development_month")
        .select(
            "accident_year",
            "development_month",
            "latest_paid",
            F.round("to_ultimate", 6).alias("factor_to_ultimate"),
            F.round(ultimate, 2).alias("ultimate_projection"),
            F.round(ultimate - dbl("latest_paid"), 2).alias("ibnr_estimate"),
        )
        .orderBy(F.desc("accident_year"))
    )


def triangle_by_line(
    claims: DataFrame, *, min_accident_year: int = 2022, months: int = 12, limit: int | None = None
) -> DataFrame:
    """Paid array (whole units) and total per line of business and accident year."""
    keys = ["line_of_business", "accident_year"]
    paid = F.slice(ordered_values("development_month", "cumulative_paid"), 1, months)
    ordered = (
        cells(claims, [*keys, "development_month"], min_accident_year)
        .groupBy(*keys)
        .agg(
            F.transform(paid, lambda x: F.round(x, 0)).alias("paid_triangle_12m"),
            F.sum("cumulative_paid").alias("total_paid_to_date"),
        )
        .orderBy(*keys)
    )
    return ordered if limit is None else ordered.limit(limit)


def claims_profile(claims: DataFrame, *, method: str = "exact") -> DataFrame:
    """Size of the claims table. The distinct counts run over one row per combination, so
    no claim is expanded once per counted column. ``method='sketch'`` estimates them."""
    return (
        claims.groupBy("accident_year", "line_of_business")
        .agg(F.count(F.lit(1)).alias("n"), F.max("development_month").alias("month"))
        .agg(
            F.sum("n").alias("total_claims_processed"),
            distinct("accident_year", method).alias("accident_years"),
            F.max("month").alias("max_development_period"),
            distinct("line_of_business", method).alias("lines_of_business"),
        )
    )
