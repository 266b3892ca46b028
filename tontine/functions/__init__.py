from tontine.functions.columns import (
    above,
    adjacent_difference,
    as_date,
    banded,
    calendar_month,
    dbl,
    distinct,
    distinct_sketch,
    json_field,
    json_number,
    list_product,
    mean,
    ordered_values,
    ratio,
    side_by_side,
    sum_where,
    total,
)
from tontine.functions.membership import probably_in
from tontine.functions.quantiles import distribution

__all__ = [
    "above",
    "adjacent_difference",
    "as_date",
    "banded",
    "calendar_month",
    "dbl",
    "distinct",
    "distinct_sketch",
    "distribution",
    "json_field",
    "json_number",
    "list_product",
    "mean",
    "ordered_values",
    "probably_in",
    "ratio",
    "side_by_side",
    "sum_where",
    "total",
]
