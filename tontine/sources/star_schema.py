"""Policies, claims and reserves as views of orders, line items and customers.

A policy is an order and a claim is a line item. Order and customer only *describe* a
claim (line of business, geography), so they are joined from the left; work that needs no
description reads :func:`claim_facts`, a plain scan of the line items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine import assumptions as A
from tontine.operators import derive
from tontine.session import shuffle_into

MONEY = "decimal(18,2)"

# Columns and Parquet types of the source tables, so that no file is opened to infer them.
SOURCE_SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz"
    ),
    "customer": "c_custkey long, c_nationkey int, c_mktsegment string",
}

# Market segment of a customer, and the line of business it stands for.
SEGMENT_LINES = [
    ("AUTOMOBILE", "Motor"),
    ("BUILDING", "Property"),
    ("HOUSEHOLD", "Life"),
    ("MACHINERY", "Health"),
]


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# The source amounts are doubles with two decimals. Whole cents in a long are exact, and far
# cheaper than casting each double to a decimal; the cents become decimals only at the end.


def _hundredths(c: str) -> str:
    return f"floor({c} * 100 + 0.5)"


def _per_hundred(hundredths: str) -> str:
    """Divide a non-negative whole number by 100, rounding half up."""
    return f"floor(({hundredths} + 50) / 100)"


def _money(cents: str, name: str) -> Column:
    return F.expr(f"cast(cast({cents} as decimal(18,0)) * 0.01 as {MONEY}) as {name}")


def _exprs(*texts: str) -> list[Column]:
    return [F.expr(text) for text in texts]


def _customer_description(customer: DataFrame) -> DataFrame:
    lines = " ".join(f"when '{segment}' then '{line}'" for segment, line in SEGMENT_LINES)
    return customer.selectExpr(
        "c_custkey",
        f"case c_mktsegment {lines} else 'Pension' end as line_of_business",
        f"element_at({_texts(A.GEOGRAPHIES)}, c_nationkey % {len(A.GEOGRAPHIES)} + 1) as geography",
    )


def _texts(values: list[str]) -> str:
    return "array({})".format(", ".join(f"'{value}'" for value in values))


def policy_facts_from(orders: DataFrame) -> DataFrame:
    """What an order alone says about a policy."""
    cents = orders.selectExpr("*", f"{_hundredths('o_totalprice')} as insured_cents")
    return cents.select(
        *_exprs(
            "o_orderkey as policy_id",
            "concat('POL', format_string('%08d', o_orderkey)) as policy_number",
            "cast(o_orderdate as date) as effective_date",
            "date_add(cast(o_orderdate as date), 365) as expiry_date",
        ),
        _money("insured_cents", "sum_insured"),
        _money(_per_hundred("insured_cents * (o_orderkey % 7 + 2)"), "premium"),
        *_exprs(
            "o_custkey as customer_id",
            "cast(o_custkey % 68 + 18 as int) as customer_age",
            "if(o_custkey % 2 = 0, 'F', 'M') as customer_gender",
        ),
    )


# Risk attributes per line of business, as JSON text.
RISK_FACTORS = """
case line_of_business
  when 'Motor' then concat('{"vehicle_age": ', policy_id % 20, '}')
  when 'Property' then concat('{"flood_zone": "',
    case when policy_id % 10 < 7 then 'Low' when policy_id % 10 < 9 then 'Medium' else 'High' end, '"}')
  when 'Life' then concat('{"smoker": ', policy_id % 20 < 3, ', "health_rating": "',
    case when policy_id % 10 < 6 then 'Standard' when policy_id % 10 < 9 then 'Preferred'
      else 'Super Preferred' end, '"}')
  else '{}'
end as risk_factors
"""

CLAIM_ATTRIBUTES = """
concat('{"complexity": "',
  case when l_partkey % 10 < 6 then 'Simple' when l_partkey % 10 < 9 then 'Medium' else 'Complex' end,
  '", "legal_involvement": ', l_suppkey % 10 = 0,
  ', "catastrophe_related": ', l_partkey % 20 = 7, '}') as claim_attributes
"""


def policies_from(orders: DataFrame, customer: DataFrame) -> DataFrame:
    described = policy_facts_from(orders).join(
        _customer_description(customer), F.col("customer_id") == F.col("c_custkey"), "left"
    )
    return described.selectExpr("* except (customer_id, c_custkey)", RISK_FACTORS)


def claim_facts_from(lineitem: DataFrame, *described: str) -> DataFrame:
    """What a line item says about a claim, next to columns that describe it already."""
    amounts = lineitem.select(
        "*",
        *_exprs(
            "l_orderkey * 8 + l_linenumber as claim_id",
            "cast(l_shipdate as date) as accident_date",
            "date_add(accident_date, cast((l_partkey * 31 + l_suppkey * 17 + l_linenumber * 7) % 366 as int))"
            " as report_date",
            f"{_hundredths('l_extendedprice')} as price_cents",
            _per_hundred(f"price_cents * (100 - {_hundredths('l_discount')})") + " as incurred_cents",
            _per_hundred("incurred_cents * floor(l_quantity + 0.5) * 2") + " as paid_cents",
        ),
        derive.outstanding("incurred_cents", "paid_cents").alias("outstanding_cents"),
    )
    return amounts.select(
        "claim_id",
        *_exprs(
            "concat('CLM', format_string('%08d', claim_id)) as claim_number",
            "l_orderkey as policy_id",
        ),
        "accident_date",
        "report_date",
        F.expr("year(accident_date) as accident_year"),
        derive.development_month("accident_date", "report_date").alias("development_month"),
        F.expr("cast(l_suppkey % 5 as int) as cause_number"),
        derive.claim_status(F.col("outstanding_cents") / 100).alias("claim_status"),
        _money("price_cents", "initial_reserve"),
        _money("paid_cents", "paid_amount"),
        _money("outstanding_cents", "outstanding_reserve"),
        _money("incurred_cents", "incurred_amount"),
        F.expr(CLAIM_ATTRIBUTES),
        *described,
    )


def _described_items(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    description = orders.join(
        _customer_description(customer), F.col("o_custkey") == F.col("c_custkey"), "left"
    ).select("o_orderkey", "line_of_business", "geography")
    return lineitem.join(description, F.col("l_orderkey") == F.col("o_orderkey"), "left")


def _claims_of_described(described: DataFrame, *kept: str) -> DataFrame:
    causes = " ".join(
        f"when '{line}' then element_at({_texts(names)}, cause_number + 1)"
        for line, names in A.CLAIM_CAUSES.items()
    )
    return claim_facts_from(described, "line_of_business", "geography", *kept).selectExpr(
        "* except (cause_number)", f"case line_of_business {causes} end as claim_cause"
    )


def claims_from(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Claims with the line of business and geography of their order's customer.

    The joins come first and move the narrow source columns; texts and amounts are derived
    from them afterwards.
    """
    return _claims_of_described(_described_items(lineitem, orders, customer))


def claim_items_from(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """The claims' source columns and what the stored table is laid out by, so that these are moved and sorted in place
    of the claims, which are three times as wide; :func:`claims_of_items` gives the claims."""
    items = _described_items(lineitem, orders, customer).drop("o_orderkey")
    keys = claim_facts_from(items, *items.columns)
    return keys.select(*items.columns, "claim_id", "accident_year", "development_month")


def claims_of_items(items: DataFrame) -> DataFrame:
    """Claims of :func:`claim_items_from`. The accident year is taken over, which keeps rows sorted by it known as such."""
    sources = items.drop("claim_id", "development_month").withColumnRenamed("accident_year", "item_year")
    return _claims_of_described(sources, "item_year").selectExpr(
        "* except (accident_year, item_year)", "item_year as accident_year"
    )


def policy_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies without line of business, geography and risk factors: no join."""
    return policy_facts_from(source(spark, sf_dir, "orders"))


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policies_from(source(spark, sf_dir, "orders"), source(spark, sf_dir, "customer"))


def claim_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims without line of business, geography and cause: no join."""
    return claim_facts_from(source(spark, sf_dir, "lineitem")).drop("cause_number")


# Line items that a task joins and combines: about 10 MB of shuffled rows, below the advisory size.
ROWS_IN_TASK = 250_000


def _claim_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """What claims are joined from. Shuffles get partitions for the line items, whose number the footers tell."""
    lineitem, orders, customer = [source(spark, sf_dir, name) for name in ("lineitem", "orders", "customer")]
    shuffle_into(spark, -(-lineitem.count() // ROWS_IN_TASK))
    return [lineitem, orders, customer]


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims_from(*_claim_sources(spark, sf_dir))


def claim_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claim_items_from(*_claim_sources(spark, sf_dir))


def with_assumptions(groups: DataFrame) -> DataFrame:
    """Assumption columns of a contract group, as plain arithmetic on its keys."""
    numbered = groups.selectExpr(
        "*",
        f"array_position({_texts(A.LINES_OF_BUSINESS)}, line_of_business) - 1 as line_number",
        f"array_position({_texts(A.GEOGRAPHIES)}, geography) - 1 as place",
        "(place + line_number + cohort_year) % 8 as quarter",
    )
    return numbered.select(
        "*",
        *_exprs(
            "case line_of_business when 'Life' then 15 when 'Pension' then 20 else 3 end as duration_years",
            "cast(110 + 3 * ((cohort_year + place) % 11) as decimal(5,0)) * 0.01 as premium_ratio",
            "cast(5 + (place * 3 + line_number * 7 + cohort_year * 5) % 11 as decimal(5,0)) * 0.01 as risk_rate",
            "cast(20 + 3 * ((cohort_year * 2 + place * 5 + line_number) % 11) as decimal(5,0)) * 0.005"
            " as acquisition_rate",
            "case line_of_business when 'Life' then 240 when 'Pension' then 360 else 12 + 4 * place end"
            " as coverage_months",
            "cast(50 + (place * 5 + line_number) % 51 as decimal(5,0)) * 0.01 as remaining_share",
            "case when quarter < 2 then 0.75D when quarter < 6 then 0.85D else 0.95D end as confidence_level",
        ),
        derive.quarter_end(F.expr("add_months(date'2001-01-01', cast(quarter * 3 as int))")).alias(
            "valuation_date"
        ),
    ).drop("line_number", "place", "quarter")


def contract_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.contract_groups(claims(spark, sf_dir))


# Each cohort is valued at the end of its year, half a year later, and at the end of the next year, there first
# without the last month's reports and then finally, for the same date.
VALUATIONS = [(12, 12), (18, 18), (24, 23), (24, 24)]


def reserve_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reserve table with several valuations of each contract group, from the claims known at each."""
    groups = derive.contract_group_history(claims(spark, sf_dir), VALUATIONS)
    assumed = with_assumptions(groups.withColumnRenamed("valuation_date", "valued_on"))
    return derive.reserve_table(assumed.withColumn("valuation_date", F.col("valued_on")))


def reserves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.reserve_table(with_assumptions(contract_groups(spark, sf_dir)))
