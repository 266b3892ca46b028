"""Every registered query against its SQL, and the shape of its plan."""

import os
import re

import duckdb
import pandas as pd
import pytest

from tontine.plans import oracle, registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry.queries()
STATEMENTS = oracle.statements()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("orders", "lineitem", "customer"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def canonical(pdf: pd.DataFrame):
    columns = sorted(pdf.columns)
    rows = [tuple(None if pd.isna(v) else v for v in row) for row in pdf[columns].itertuples(index=False)]
    return columns, sorted(rows, key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, duck, name):
    got = canonical(QUERIES[name](spark, SF_DIR).toPandas())
    expected = canonical(duck.execute(STATEMENTS[name]).df())
    assert got == expected


@pytest.mark.parametrize("name", ["verify_claims_footers", "table_counts_footers"])
def test_checks_of_stored_tables_read_footers(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)") == plan.count("BatchScan") == (1 if "claims" in name else 3)


def test_bucketed_claims_and_policies_are_joined_where_they_are(spark):
    plan = QUERIES["contract_groups_bucketed"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    below = plan.split("SortMergeJoin")[1]
    assert "SortMergeJoin" in plan and "Exchange" not in below and below.count("Bucketed: true") == 2


# The largest number of scans: one per source table.
QUANTILES = ["reserve_quantiles", "reserve_risk", "reserve_p95"]
ONE_SCAN = ["tri_basic", "tri_arrays", "dev_factors", "chain_ladder_literal", "chain_ladder", "reinsurance"]
PLANNED = [n for n in QUERIES if not n.startswith(("stream_", "load_")) and not n.endswith("_footers")]


@pytest.mark.parametrize("name", PLANNED)
def test_plan(spark, name):
    """With every join beyond the broadcast limit, as on a large cluster."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[name](spark, SF_DIR)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert not re.search("Cartesian|NestedLoop|Python|ArrowEval", plan)
    scans = re.findall(r"FileScan parquet [\w.]*\[([^\]]*)\].*?ReadSchema: struct<([^>]*)", plan, re.S)
    # table_counts reads each of its three tables for itself. The quantiles' plan names its source often, and
    # reads it once, when the exchange is reused.
    if name not in QUANTILES:
        assert 1 <= len(scans) <= (5 if name == "table_counts" else 3)
    for columns, _ in scans:
        assert columns.count(",") < (12 if name.endswith("_stored") else 8)
    if name in QUANTILES:
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert len(set(re.findall(r"FileScan parquet \[l_orderkey#(\d+)", final))) == 1
        assert final.count("FileScan") == 3
    if name in ONE_SCAN:
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("FileScan") == 1
