import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from samples import claims, multiset, policies, reserves
from tontine import session
from tontine.operators import checks, derive
from tontine.plans import registry
from tontine.session import scratch_path
from tontine.sources import star_schema, tables
from tontine.sources.tables import read_footers, read_table, write_bucketed, write_table

JSON = '{"note": "a, \\"quoted\\" word", "catastrophe_related": true}'


def sample(spark, table):
    if table == "policies":
        return policies(spark, *[{"policy_id": i, "effective_date": f"2021-0{i}-15", "risk_factors": JSON} for i in (1, 2, 3)])
    if table == "claims":
        return claims(spark, *[{"claim_id": i, "accident_year": 2019 + i, "paid_amount": 1.5 * i, "claim_attributes": JSON} for i in (1, 2, 3)])
    return reserves(spark, *[{"cohort_year": y, "pv_factor": 0.123456} for y in (2020, 2021)])


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
@pytest.mark.parametrize("table", ["policies", "claims", "reserves"])
def test_round_trip(spark, table, fmt):
    path, df = scratch_path(spark, table), sample(spark, table)
    write_table(df, table, path, fmt)
    back = read_table(spark, table, path, fmt)
    assert back.columns == df.columns
    assert [f.dataType for f in back.schema] == [f.dataType for f in df.schema]
    assert multiset(back) == multiset(df)
    write_table(df, table, path, fmt)
    assert read_table(spark, table, path, fmt).count() == 2 * df.count()
    write_table(df, table, path, fmt, mode="overwrite")
    assert read_table(spark, table, path, fmt).count() == df.count()


def test_several_paths_and_globs(spark):
    base = scratch_path(spark, "many")
    for part in ("a", "b"):
        write_table(sample(spark, "reserves"), "reserves", f"{base}/{part}")
    assert read_table(spark, "reserves", f"{base}/*/*.parquet").count() == 4
    assert read_table(spark, "reserves", [f"{base}/a", f"{base}/b"]).count() == 4


def test_datetimes_and_doubles_are_cast_on_read(spark):
    path = scratch_path(spark, "loose")
    loose = (
        sample(spark, "claims")
        .withColumn("accident_date", F.col("accident_date").cast("timestamp"))
        .withColumn("paid_amount", F.col("paid_amount").cast("double"))
        .withColumn("development_month", F.col("development_month").cast("long"))
    )
    loose.write.parquet(path)
    assert multiset(read_table(spark, "claims", path)) == multiset(sample(spark, "claims"))


def test_bad_values_are_errors(spark):
    path = scratch_path(spark, "bad")
    df = sample(spark, "claims").withColumn("accident_date", F.lit("not a date"))
    df.write.options(header=True).csv(path)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_table(spark, "claims", path, "csv").collect()
    with pytest.raises(ValueError):
        read_table(spark, "claims", path, "xml")


def test_stored_claims_prune_partitions_columns_and_rows(spark):
    path = scratch_path(spark, "pruned")
    write_table(sample(spark, "claims"), "claims", path)
    df = (
        read_table(spark, "claims", path)
        .where("accident_year >= 2021 and claim_status = 'Open'")
        .groupBy("development_month")
        .agg(F.sum("paid_amount"))
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*accident_year[^\]]*>= 2021", plan)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(claim_status,Open\)", plan)
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"development_month", "claim_status", "paid_amount"}


def test_shared_folder_is_required_off_local_mode(spark, monkeypatch):
    class Remote:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Remote)
    own = session.shared_dir(spark)
    assert own.startswith(spark.conf.get("spark.checkpoint.dir")) and spark.sparkContext.applicationId in own


def test_missing_and_empty_text_stay_apart_in_csv(spark):
    path = scratch_path(spark, "csv")
    rows = sample(spark, "claims").limit(1)
    both = rows.withColumn("geography", F.lit(None).cast("string")).unionByName(rows.withColumn("geography", F.lit("")))
    write_table(both, "claims", path, "csv")
    got = read_table(spark, "claims", path, "csv")
    assert sorted(str(r.geography) for r in got.collect()) == ["", "None"]


def test_numbers_of_more_than_eight_digits_stay_whole(spark):
    orders = spark.createDataFrame([(987654313,), (987654305,), (5,)], "o_orderkey long").selectExpr(
        "o_orderkey", "1 o_custkey", "100.0D o_totalprice", "timestamp'1998-01-01' o_orderdate"
    )
    got = sorted(r.policy_number for r in star_schema.policy_facts_from(orders).collect())
    assert got == ["POL00000005", "POL987654305", "POL987654313"]


def test_bucketed_tables_join_without_a_shuffle(spark):
    rows = [{"claim_id": i, "policy_id": i % 5, "paid_amount": i} for i in range(30)]
    held = [{"policy_id": i, "geography": g} for i, g in enumerate(["CA", "TX", "CA", "FL"])]
    facts = write_bucketed(claims(spark, *rows).drop("line_of_business", "geography"), "t_claims", scratch_path(spark, "b"), buckets=4)
    known = write_bucketed(policies(spark, *held), "t_policies", scratch_path(spark, "b"), buckets=4)
    joined = derive.described_claims(facts, known)
    grouped = joined.groupBy("policy_id", "geography").agg(F.sum("paid_amount").alias("paid"))
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    got = {(r.policy_id, r.geography): int(r.paid) for r in grouped.collect()}
    assert got == {(i, g): sum(range(i, 30, 5)) for i, g in enumerate(["CA", "TX", "CA", "FL", None])}
    assert joined.count() == 30


def test_footers_answer_counts_minima_and_maxima(spark):
    path, rows = scratch_path(spark, "footers"), sample(spark, "claims")
    write_table(rows, "claims", path)
    df = read_footers(spark, "claims", path).groupBy("accident_year").agg(
        F.count(F.lit(1)).alias("n"), F.min("accident_date").alias("first"), F.max("claim_id").alias("most")
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedAggregation: \[COUNT\(\*\), MIN\(accident_date\)", plan) and "PushedGroupBy: [accident_year]" in plan
    assert {(r.accident_year, r.n, r.most) for r in df.collect()} == {(2019 + i, 1, i) for i in (1, 2, 3)}
    assert multiset(read_footers(spark, "claims", path)) == multiset(rows)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_column_digests_find_any_changed_value(spark):
    rows = [{"claim_id": i, "paid_amount": i, "geography": None if i == 2 else "CA"} for i in range(4)]
    digests = {r.column_name: (r.known, r.digest) for r in checks.column_digests(claims(spark, *rows)).collect()}
    assert list(digests) == claims(spark).columns and digests["geography"][0] == 3
    again = {r.column_name: (r.known, r.digest) for r in checks.column_digests(claims(spark, *rows[::-1])).collect()}
    assert again == digests
    other = {r.column_name: (r.known, r.digest) for r in checks.column_digests(claims(spark, *rows[:3], rows[3] | {"paid_amount": 3.01})).collect()}
    assert {c for c in digests if other[c] != digests[c]} == {"paid_amount"}
    assert {(r.known, r.digest) for r in checks.column_digests(claims(spark)).collect()} == {(0, "0")}


def test_tasks_are_small_and_files_are_not(spark, monkeypatch):
    session.configure(spark)
    size, write = lambda: spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"), DataFrameWriter.parquet
    assert size() == "16m"
    seen = []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append(size()), write(self, path)))
    for table in ("claims", "reserves"):
        write_table(sample(spark, table), table, scratch_path(spark, table))
    assert seen == ["64m", "16m"] and size() == "16m"
    path = scratch_path(spark, "claims")
    write_table(sample(spark, "claims"), "claims", path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_table(sample(spark, "claims"), "claims", path, mode="error")
    assert size() == "16m"


def test_stored_size_counts_data_files(spark):
    path = scratch_path(spark, "sized")
    write_table(sample(spark, "claims"), "claims", path)
    size = tables.stored_size(spark, path)
    assert size.files == 3 and size.bytes > 0


@pytest.mark.parametrize("files,mb,expected", [(7, 97, 3), (55, 1109, 19), (330, 6600, 51), (1, 1, 3), (0, 0, 3)])
def test_batches_grow_with_the_table_up_to_their_bytes(spark, monkeypatch, files, mb, expected):
    monkeypatch.setattr(tables, "stored_size", lambda spark, path: tables.StoredSize(files, mb * 1024**2))
    assert registry._files_in_batch(spark, "claims", "anywhere") == expected


def test_buckets_grow_with_the_claims(spark):
    path = scratch_path(spark, "bucket-source")
    spark.range(30).selectExpr("id as l_orderkey").write.parquet(f"{path}/lineitem.parquet")
    assert registry._buckets(spark, path) == 8
    big = scratch_path(spark, "bucket-source")
    spark.range(4_500_001).selectExpr("id as l_orderkey").write.parquet(f"{big}/lineitem.parquet")
    assert registry._buckets(spark, big) == 10


def test_claims_stored_from_their_items_are_the_claims(spark):
    session.configure(spark)
    schema = star_schema.SOURCE_SCHEMAS
    day = "timestamp_ntz'199{} 00:00:00'"
    lines = [
        f"({k}L, {p}, 3L, {n}, {q}, {price}, 0.05D, {d})"
        for k, p, n, q, price, d in [
            (1, "7L", "1", "3D", "100.25D", day.format("5-03-01")),
            (1, "7L", "1", "3D", "100.25D", day.format("5-03-01")),
            (2, "NULL", "NULL", "NULL", "NULL", day.format("6-12-31")),
            (3, "9L", "2", "50D", "99.99D", "NULL"),
            (4, "27L", "2", "1D", "5D", day.format("6-01-01")),
        ]
    ]
    names = ", ".join(c.split()[0] for c in schema["lineitem"].split(", "))
    lineitem = spark.sql(f"SELECT * FROM VALUES {', '.join(lines)} AS t({names})")
    orders = spark.createDataFrame([(1, 1, 9.0, None), (2, 2, 9.0, None), (3, 9, 9.0, None)], schema["orders"])
    customer = spark.createDataFrame([(1, 1, "BUILDING"), (2, None, None)], schema["customer"])
    items = star_schema.claim_items_from(lineitem, orders, customer)
    assert not {"claim_attributes", "claim_number", "claim_cause"} & set(items.columns)
    expected = multiset(tables.conform(star_schema.claims_from(lineitem, orders, customer), tables.TABLES["claims"]))
    path = scratch_path(spark, "claim-items")
    write_table(items, "claims", path, finish=star_schema.claims_of_items)
    assert multiset(read_table(spark, "claims", path)) == expected


def test_shuffles_of_claims_get_partitions_for_the_line_items(spark, monkeypatch):
    path = scratch_path(spark, "star")
    spark.range(100).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "1D AS l_quantity", "9D AS l_extendedprice",
        "0D AS l_discount", "timestamp_ntz'2021-01-01' AS l_shipdate",
    ).write.parquet(f"{path}/lineitem.parquet")
    spark.range(100).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "1D AS o_totalprice", "timestamp_ntz'2021-01-01' AS o_orderdate"
    ).write.parquet(f"{path}/orders.parquet")
    spark.range(100).selectExpr("id AS c_custkey", "1 AS c_nationkey", "'BUILDING' AS c_mktsegment").write.parquet(f"{path}/customer.parquet")
    own = spark.newSession()
    session.configure(own)
    own.conf.set("spark.sql.shuffle.partitions", 4)
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)

    def begun() -> set[str]:
        df = registry.queries()["contract_groups"](own, path)
        return set(re.findall(r"hashpartitioning\(l_orderkey.*?, (\d+)\)", df._jdf.queryExecution().executedPlan().toString()))

    assert begun() == {"4"}
    monkeypatch.setattr(star_schema, "ROWS_IN_TASK", 9)
    assert begun() == {"12"}
    assert [tuple(r) for r in registry.queries()["contract_groups"](own, path).select("policy_count", "claim_count").collect()] == [(100, 100)]
    own.conf.set("spark.sql.shuffle.partitions", 40)
    session.shuffle_into(own, 30)
    assert int(own.conf.get(session.INITIAL)) == 12
