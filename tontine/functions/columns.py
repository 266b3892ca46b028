"""Column helpers shared by the operators. All are built-in Spark expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c) -> Column:
    return _col(c).cast("double")


def ratio(numerator, denominator, digits: int | None = None) -> Column:
    """Quotient in double precision; NULL where the denominator is zero or NULL."""
    quotient = dbl(numerator) / F.nullif(dbl(denominator), F.lit(0.0))
    return quotient if digits is None else F.round(quotient, digits)


def mean(c) -> Column:
    """Average of an exact (integer or decimal) column: exact sum over count."""
    return ratio(F.sum(c), F.count(c))


def total(c) -> Column:
    """Sum that is 0, not NULL, when there is nothing to add."""
    return F.coalesce(F.sum(c), F.lit(0))


#: Of a sketch: 2^14 registers of 6 bits, a standard error of 0.8 %.
SKETCH_BITS = 14


def distinct(c, method: str = "exact") -> Column:
    """Aggregate: number of distinct values. ``method='sketch'`` estimates it in bounded space."""
    if method == "exact":
        return F.count_distinct(c)
    if method != "sketch":
        raise ValueError(f"unknown method {method!r}")
    return F.hll_sketch_estimate(distinct_sketch(c))


def distinct_sketch(c) -> Column:
    """Aggregate: a sketch of the distinct values. Unlike their number, sketches of parts can be merged
    (``hll_union_agg``) and then estimated (``hll_sketch_estimate``)."""
    return F.hll_sketch_agg(c, SKETCH_BITS)


def sum_where(c, condition: Column) -> Column:
    """Conditional sum, 0 when no row matches."""
    return total(F.when(condition, _col(c)))


def banded(c, steps, beyond) -> Column:
    """Value of the first step whose (exclusive) upper bound lies above the column."""
    return _chain([(_col(c) < F.lit(bound), value) for bound, value in steps], beyond)


def above(c, steps, otherwise) -> Column:
    """Value of the first step whose bound the column exceeds."""
    return _chain([(_col(c) > F.lit(bound), value) for bound, value in steps], otherwise)


def _chain(cases, otherwise) -> Column:
    (first, value), *rest = cases
    chain = reduce(lambda acc, case: acc.when(case[0], F.lit(case[1])), rest, F.when(first, F.lit(value)))
    return chain.otherwise(F.lit(otherwise))


def json_field(c, path: str) -> Column:
    """Text of a JSON field (dotted path); NULL for a missing key or malformed text."""
    return F.get_json_object(_col(c), f"$.{path}")


def json_number(c, path: str) -> Column:
    return json_field(c, path).try_cast("double")


def calendar_month(c) -> Column:
    """Month as the number yyyymm."""
    return F.year(c) * 100 + F.month(c)


def as_date(value) -> Column:
    """A valuation date given as text, date or datetime; today when None."""
    return F.current_date() if value is None else F.lit(value).cast("date")


def ordered_values(order, value) -> Column:
    """Aggregate: values of a (small, already aggregated) group, sorted by ``order``."""
    pairs = F.array_sort(F.collect_list(F.struct(_col(order).alias("o"), _col(value).alias("v"))))
    return F.transform(pairs, lambda p: p["v"])


def adjacent_difference(values: Column) -> Column:
    """Array of steps between neighbours; the first element has no neighbour and gives 0."""
    return F.transform(values, lambda x, i: F.when(i == 0, x - x).otherwise(x - F.element_at(values, i)))


def list_product(values: Column) -> Column:
    return F.aggregate(values, F.lit(1.0), lambda acc, x: acc * x)


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row aggregates into one row, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])
