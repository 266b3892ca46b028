"""Exact grouped quantiles of a money column, for groups of any size, in one lazy plan.

``percentile`` keeps every distinct value of a group in one task. Here a histogram comes first: each task counts its
rows by group and bin, and the counts are added up by group and bin. The values of a bin share their first four
digits, so a group has some ten thousand bins for each power of ten, whatever its size, and the bins of a group say in
which of them each wanted rank lies. Only the values of these bins are moved: the wanted bins are marked in bitmaps of a fixed size, which are
broadcast to filter the rows at their source; what passes is counted by value, combined before its one shuffle, and
each bin's values are ordered by themselves. Nothing is hashed by the group's keys alone but its bins.

The bitmaps have two million places, so with very many groups they let more rows through; the join with the wanted
bins that follows is exact. A bin has at most a million distinct values for amounts below 10^10 cents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tontine.functions.columns import dbl, ratio
from tontine.functions.membership import probably_in

# Leading digits that values of one bin share; shorter values are bins of their own.
DIGITS = 4
# A long has at most 19 digits.
WIDTHS = [10 ** max(0, digits - DIGITS) for digits in range(1, 20)]

EXACT = "decimal(38,0)"
MOMENTS = ["size__", "sum__", "mean__", "variance__"]


def _same(keys: list[str], left: DataFrame, right: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"{k}__w"]) for k in keys])


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"{k}__w" for k in keys})


def bin_start(cents: str) -> Column:
    """The least value of the bin. Bins follow each other in the order of their values."""
    widths = ", ".join(f"{w}L" for w in WIDTHS)
    width = f"element_at(array({widths}), length(cast(abs({cents}) as string)))"
    return F.expr(f"{cents} - pmod({cents}, {width})")


def _histogram(values: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, and exact sums of the offsets and of their squares, for each bin; ``from__`` and ``upto__`` are the
    ranks of its rows within the group."""
    offset = (F.col("cents__") - F.col("start__")).cast("decimal(18,0)")
    bins = values.groupBy(*keys, "start__").agg(
        F.count(F.lit(1)).alias("n__"),
        F.sum(offset).cast(EXACT).alias("off__"),
        F.sum((offset * offset).cast(EXACT)).alias("off2__"),
    )
    # Always true. Every use of the histogram now needs all its sums, so that all can read one exchange of them.
    bins = bins.where("off__ IS NOT NULL AND off2__ IS NOT NULL")
    upto = F.sum("n__").over(Window.partitionBy(*keys).orderBy("start__").rowsBetween(Window.unboundedPreceding, 0))
    return bins.withColumns({"upto__": upto, "from__": upto - F.col("n__")})


def _with_moments(bins: DataFrame, keys: list[str]) -> DataFrame:
    """On each bin, of its group: the size ``size__``, exact ``sum__`` of the cents, ``mean__`` and ``variance__``.
    Squares are summed as exact offsets within bins, and between bins as distances from the group's mean."""
    in_group = Window.partitionBy(*keys)
    whole = (F.col("start__").cast("decimal(19,0)") * F.col("n__").cast("decimal(19,0)") + F.col("off__")).cast(EXACT)
    known = (
        bins.withColumn("sum__", F.sum(whole).over(in_group))
        .withColumn("size__", F.sum("n__").over(in_group))
        .withColumn("mean__", ratio("sum__", "size__"))
    )
    bin_n = dbl("n__")
    spread = dbl((F.col("off2__") * F.col("n__") - F.col("off__") * F.col("off__")).cast(EXACT)) / bin_n
    away = dbl("start__") - F.col("mean__") + dbl("off__") / bin_n
    squares = F.sum(spread + bin_n * away * away).over(in_group)
    return known.withColumn("variance__", squares / F.col("size__"))


def _asked(bins: DataFrame, keys: list[str], quantiles: dict[str, float]) -> DataFrame:
    """The bins that hold wanted ranks, with these ranks counted within the bin, and the group's moments."""
    ranks = []
    for name, q in quantiles.items():
        position = (F.col("size__") - 1) * F.lit(float(q))
        ranks.append(F.struct(F.lit(f"{name}__lo").alias("slot"), F.floor(position).alias("rank")))
        ranks.append(F.struct(F.lit(f"{name}__hi").alias("slot"), F.ceil(position).alias("rank")))
    here = F.filter(F.array(*ranks), lambda r: (r["rank"] >= F.col("from__")) & (r["rank"] < F.col("upto__")))
    within = F.transform(here, lambda r: F.struct(r["slot"].alias("slot"), (r["rank"] - F.col("from__")).alias("rank")))
    asked = bins.select(*keys, "start__", *MOMENTS, within.alias("asked__"))
    return asked.where(F.size("asked__") > 0)


def _picked(values: DataFrame, asked: DataFrame, keys: list[str], slots: list[str]) -> DataFrame:
    """Per group, its moments and the values at the asked ranks, one column for each slot."""
    inside = [*keys, "start__"]
    counted = probably_in(values, asked, inside).groupBy(*inside, "cents__").agg(F.count(F.lit(1)).alias("n__"))
    of_bin = _renamed(asked, inside)
    held = counted.join(of_bin, _same(inside, counted, of_bin))
    ordered = Window.partitionBy(*inside).orderBy("cents__").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("n__").over(ordered)
    placed = held.select(
        *keys, "cents__", "asked__", *MOMENTS, upto.alias("upto__"), (upto - F.col("n__")).alias("from__")
    )
    found = F.filter("asked__", lambda a: (a["rank"] >= F.col("from__")) & (a["rank"] < F.col("upto__")))
    rows = placed.select(*keys, "cents__", *MOMENTS, F.explode(found).alias("found__"))
    return rows.groupBy(*keys).agg(
        *[F.max(name).alias(name) for name in MOMENTS],
        *[F.max(F.when(F.col("found__.slot") == slot, F.col("cents__"))).alias(slot) for slot in slots],
    )


def distribution(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Per group: ``n``, ``total``, ``mean``, ``deviation`` (population) and the quantiles.

    ``value`` must be decimal with two places; NULLs are left out. Quantiles are interpolated
    linearly between the neighbouring ranks.
    """
    # The cents are used several times below: a generator keeps the optimiser from repeating how they are derived,
    # in generated methods too long for the JVM to compile.
    once = F.explode_outer(F.array((F.col(value) * 100).cast("long")))
    cents = df.select(*keys, once.alias("cents__")).where("cents__ IS NOT NULL")
    values = cents.select("*", bin_start("cents__").alias("start__"))
    bins = _with_moments(_histogram(values, keys), keys)
    # Every group has a first value, so none is lost if no quantile is wanted.
    wanted = quantiles or {"first__": 0.0}
    slots = [f"{name}__{end}" for name in wanted for end in ("lo", "hi")]
    picked = _picked(values, _asked(bins, keys, wanted), keys, slots)

    def interpolated(name: str, q: float) -> Column:
        low, high = dbl(f"{name}__lo") / 100, dbl(f"{name}__hi") / 100
        position = (F.col("size__") - 1) * F.lit(float(q))
        return low + (high - low) * (position - F.floor(position))

    return picked.select(
        *keys,
        F.col("size__").alias("n"),
        (F.col("sum__") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(38,2)").alias("total"),
        (F.col("mean__") / 100).alias("mean"),
        (F.sqrt("variance__") / 100).alias("deviation"),
        *[interpolated(name, q).alias(name) for name, q in quantiles.items()],
    )
