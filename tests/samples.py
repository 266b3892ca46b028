"""Hand-made rows: every column has a default, tests name what they care about."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from tontine.schemas import CLAIMS, POLICIES, RESERVES

_DEFAULTS = {
    T.LongType: 1,
    T.IntegerType: 1,
    T.StringType: "",
    T.DateType: dt.date(2021, 1, 1),
    T.DecimalType: Decimal(0),
}
_NAMED = {
    "line_of_business": "Motor",
    "geography": "CA",
    "claim_status": "Open",
    "accident_year": 2021,
    "cohort_year": 2021,
    "profitability_class": "Profitable",
    "customer_gender": "F",
    "customer_age": 40,
    "risk_factors": "{}",
    "claim_attributes": "{}",
    "reserve_metadata": "{}",
    "pv_factor": Decimal(1),
}


def _value(field: T.StructField, given):
    if given is None:
        return None
    if isinstance(field.dataType, T.DecimalType):
        return Decimal(str(given))
    if isinstance(field.dataType, T.DateType) and isinstance(given, str):
        return dt.date.fromisoformat(given)
    return given


def _frame(spark, schema, rows):
    filled = []
    for row in rows:
        unknown = set(row) - set(schema.names)
        assert not unknown, unknown
        filled.append(
            tuple(
                _value(f, row[f.name] if f.name in row else _NAMED.get(f.name, _DEFAULTS[type(f.dataType)]))
                for f in schema
            )
        )
    return spark.createDataFrame(filled, schema)


def policies(spark, *rows):
    return _frame(spark, POLICIES, rows)


def claims(spark, *rows):
    return _frame(spark, CLAIMS, rows)


def reserves(spark, *rows):
    return _frame(spark, RESERVES, rows)


def cells(*amounts):
    """Claims of a triangle, from (accident_year, month, paid)."""
    return [
        {"accident_year": y, "development_month": m, "paid_amount": p, "incurred_amount": p}
        for y, m, p in amounts
    ]


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def dicts(df):
    return [r.asDict() for r in df.collect()]


def multiset(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
