"""Every operator as a named query over the given tables.

The fixture's dates and sizes differ from the operators' defaults (1995-2001, few
policies), so thresholds and dates are passed here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tontine.operators import (
    catastrophe,
    checks,
    derive,
    ifrs17,
    mortality,
    reserving,
    rollups,
    triangles,
)
from tontine.schemas import TABLES
from tontine.session import configure, scratch_path
from tontine.sources import loads, tables
from tontine.sources import star_schema as star
from tontine.streaming import incremental, stateful

AS_OF = "2001-11-05"
FIRST_YEAR = 1995
LATER_YEAR = 1998
RECENT_YEARS = 3

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Plain column types, so that results compare equal across engines: whole numbers as
    long, money as double, dates as text and arrays as comma-separated text."""

    def plain(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.IntegerType):
            c = c.cast("long")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("decimal(38,2)").cast("string")), ",")
        return c.alias(field.name)

    return df.select(*[plain(field) for field in df.schema])


def _over(*inputs: Callable[[SparkSession, str], DataFrame]):
    """Queries whose operator takes these input tables."""

    def query(operator: Callable[..., DataFrame], **parameters) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return comparable(operator(*[table(spark, sf_dir) for table in inputs], **parameters))

        return run

    return query


def _since(claims: Query, year: int) -> Query:
    """Claims from an accident year on. The year is that of the accident date, so the limit
    can be put on the date, which the Parquet scan uses to skip row groups."""
    start = f"{year}-01-01"
    return lambda spark, sf_dir: claims(spark, sf_dir).where(
        F.col("accident_date") >= F.lit(start).cast("date")
    )


_policies = _over(star.policies)
_claims = _over(star.claims)
# Claims without line of business and geography: a scan of line items, no join.
_facts = _over(star.claim_facts)
_first_claims = _over(_since(star.claims, FIRST_YEAR))
_later_claims = _over(_since(star.claims, LATER_YEAR))
_first_facts = _over(_since(star.claim_facts, FIRST_YEAR))
_reserves = _over(star.reserves)
_groups = _over(lambda spark, sf_dir: star.with_assumptions(star.contract_groups(spark, sf_dir)))


def _reinsurance(claims: DataFrame) -> DataFrame:
    return catastrophe.reinsurance(catastrophe.quarterly_losses(claims))


def _claim_rule(name: str, rule) -> Callable[[DataFrame], DataFrame]:
    return lambda claims: claims.groupBy("accident_year", rule().alias(name)).agg(
        F.count(F.lit(1)).alias("claims"), F.sum("incurred_amount").alias("incurred")
    )


def _outstanding(claims: DataFrame) -> DataFrame:
    rest = derive.outstanding("incurred_amount", "paid_amount")
    return claims.groupBy("accident_year").agg(
        F.sum(rest).alias("outstanding"), F.max(rest).alias("largest_outstanding")
    )


def _measures(*steps: Callable[[DataFrame], DataFrame], show: list[str]) -> Callable[[DataFrame], DataFrame]:
    def operator(groups: DataFrame) -> DataFrame:
        for step in (derive.with_discount_rates, derive.pv_measures, *steps):
            groups = step(groups)
        return groups.select("contract_group_id", *show)

    return operator


def _metadata(reserves: DataFrame) -> DataFrame:
    fields = {
        "discount_rate": "actuarial_assumptions.discount_rate",
        "risk_margin": "actuarial_assumptions.risk_margin",
        "confidence_level": "confidence_level",
    }
    text = F.col("reserve_metadata")
    return reserves.select(
        "contract_group_id",
        *[F.get_json_object(text, f"$.{path}").cast("double").alias(name) for name, path in fields.items()],
        F.get_json_object(text, "$.valuation_method").alias("valuation_method"),
        F.get_json_object(text, "$.last_updated").alias("last_updated"),
    )


def _loaded(table: str, fmt: str = "parquet", glob: str = "", show: Callable[[DataFrame], DataFrame] | None = None) -> Query:
    """Write a table in its layout, read it back and summarise what arrived."""
    source = {"policies": star.policies, "claims": star.claims, "reserves": star.reserves}[table]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        path = scratch_path(spark, f"load-{table}-{fmt}")
        tables.write_table(source(spark, sf_dir), table, path, fmt)
        arrived = tables.read_table(spark, table, path + glob, fmt)
        return comparable(show(arrived)) if show else _summary(arrived, table)

    return run


def _summary(arrived: DataFrame, table: str) -> DataFrame:
    amount, day = {
        "policies": ("sum_insured", "effective_date"),
        "claims": ("incurred_amount", "accident_date"),
        "reserves": ("pv_claims", "valuation_date"),
    }[table]
    return comparable(
        arrived.groupBy("line_of_business", "geography").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(amount).alias("amount"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
        )
    )


def _retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims in two loads, of which one runs twice and one fails before its mark and is run again."""
    configure(spark)
    path = scratch_path(spark, "loads")
    claims = star.claims(spark, sf_dir)
    even, odd = claims.where("accident_year % 2 = 0"), claims.where("accident_year % 2 <> 0 OR accident_year IS NULL")
    tables.write_table(even, "claims", f"{path}/data/load=even/attempt=failed")
    for name, rows in (("even", even), ("odd", odd), ("even", even)):
        loads.load(rows, "claims", path, name)
    loads.remove_unfinished(spark, path)
    return _summary(loads.read_loads(spark, "claims", path), "claims")


# Several micro-batches of the stored tables: claims have a file a year, policies one a month. Larger tables have more
# files, and take more of them at once: a batch costs the same whether it is small or not.
FILES_IN_BATCH = {"claims": 3, "policies": 30, "reserves": 1}
LEAST_BATCHES, BATCH_BYTES = 3, 1024**3


def _files_in_batch(spark: SparkSession, table: str, path: str) -> int:
    """As many files as ``BATCH_BYTES`` hold on the average, but no more than leave ``LEAST_BATCHES`` batches."""
    stored = tables.stored_size(spark, path)
    by_bytes = BATCH_BYTES * stored.files // max(stored.bytes, 1)
    return max(FILES_IN_BATCH[table], min(by_bytes, -(-stored.files // LEAST_BATCHES)))


_STORED: dict[tuple[str, str, str], str] = {}


# Claims are stored from their narrow source columns: texts and amounts are derived behind the shuffle and the sort.
FINISH = {star.claim_items: star.claims_of_items}


def _stored(name: str, source: Query, table: str | None = None, reader=tables.read_table) -> Query:
    """The table in its layout on shared storage, written by the first query of the session that needs
    it (the ``load_*`` queries show what that costs) and read by all."""

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, name)
        if key not in _STORED:
            path = scratch_path(spark, f"stored-{name}")
            tables.write_table(source(spark, sf_dir), table or name, path, finish=FINISH.get(source))
            _STORED[key] = path
        return reader(spark, table or name, _STORED[key])

    return read


_FOOTERS = [
    _stored(name, source, reader=tables.read_footers)
    for name, source in (("policies", star.policies), ("claims", star.claim_items), ("reserves", star.reserves))
]

BUCKETS, ROWS_IN_BUCKET = 8, 500_000


def _buckets(spark: SparkSession, sf_dir: str) -> int:
    """The buckets of claims and policies alike: so many that a bucket's claims fit in a task at any size of the table."""
    return max(BUCKETS, -(-star.source(spark, sf_dir, "lineitem").count() // ROWS_IN_BUCKET))


def _bucketed(name: str, source: Query) -> Query:
    """Rows stored in buckets of the policy by the first query of the session that needs them."""

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, f"bucketed-{name}")
        if key not in _STORED:
            path = scratch_path(spark, f"bucketed-{name}")
            table = path.rsplit("/", 1)[-1].replace("-", "_")
            tables.write_bucketed(source(spark, sf_dir), table, path, buckets=_buckets(spark, sf_dir))
            _STORED[key] = table
        return spark.table(_STORED[key])

    return read


def _groups_of_bucketed(claims: DataFrame, policies: DataFrame) -> DataFrame:
    return derive.contract_groups(derive.described_claims(claims, policies))


def _loads_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reserve history as a stream of two loads, the later valuations of each group first."""
    path = scratch_path(spark, "stream-history")
    history = _stored("history", star.reserve_history, "reserves")(spark, sf_dir)
    late = F.year("valuation_date") == F.col("cohort_year")
    for load in (history.where(~late), history.where(late)):
        tables.write_table(load, "reserves", path)
    return tables.read_table_stream(spark, "reserves", path, max_files_per_trigger=FILES_IN_BATCH["reserves"])


def _insertions(table: str, source: Query) -> Query:
    """A table's files as a stream. The rows are stored first, as an insert would do, so
    the joins behind them run as a batch; the stream itself joins nothing."""

    def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, f"stream-{table}")
        tables.write_table(source(spark, sf_dir), table, path, finish=FINISH.get(source))
        return tables.read_table_stream(spark, table, path, max_files_per_trigger=_files_in_batch(spark, table, path))

    return stream


# The rollups kept as state have some thousand groups at any size of the claims.
STATE_PARTITIONS = 12


def _streamed(source: Query, rollup: Callable[[], rollups.Rollup], upkeep=incremental) -> Query:
    options = {"partitions": STATE_PARTITIONS} if upkeep is stateful else {}

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        rows = source(spark, sf_dir)
        return comparable(upkeep.run(rollup(), rows, scratch_path(spark, "rollup"), compact_every=2, **options))

    return run


_policy_insertions = _insertions("policies", star.policies)
_claim_insertions = _insertions("claims", star.claim_items)


_stored_claims = _over(_stored("claims", star.claim_items))
_stored_reserves = _over(_stored("reserves", star.reserves))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triangle rollup that a stream of the claims has left, kept up to date once a session."""
    key, rollup = (spark.sparkContext.applicationId, sf_dir, "triangle-rollup"), rollups.triangle()
    if key not in _STORED:
        path, rows = scratch_path(spark, "triangle-rollup"), _claim_insertions(spark, sf_dir)
        incremental.start(rollup, rows, path, compact_every=2).awaitTermination()
        _STORED[key] = path
    empty = spark.createDataFrame([], TABLES["claims"])
    return incremental.current(rollup, spark, _STORED[key], rollup.partial(empty).schema)


_rolled = _over(_cells)
_history = _over(star.reserve_history)


ACTIVE_KEYS = ["accident_year", "line_of_business", "geography"]


def _agreement(counted: DataFrame) -> DataFrame:
    """Exact numbers of policies, and whether the estimates are within five standard errors of them."""
    near = F.abs(F.col("policy_estimate") - F.col("policy_count")) <= 0.04 * F.col("policy_count")
    return counted.select(*ACTIVE_KEYS, "claim_count", "policy_count", near.alias("estimate_agrees"))


def _active_policies(claims: DataFrame) -> DataFrame:
    """The rollup with one measure more, which can't be merged but is exact."""
    rollup, exact = rollups.active_policies(), {"policy_count": F.count_distinct("policy_id")}
    both = replace(rollup, measures=rollup.measures | exact, output=rollup.output | {"policy_count": F.col("policy_count")})
    return _agreement(both.batch(claims))


def _streamed_active_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged sketches of the batches, beside exact counts of the claims."""
    estimates = _streamed(_claim_insertions, rollups.active_policies)(spark, sf_dir)
    exact = star.claims(spark, sf_dir).groupBy(*ACTIVE_KEYS).agg(F.count_distinct("policy_id").alias("policy_count"))
    return comparable(_agreement(estimates.join(exact, ACTIVE_KEYS)))


def _rollup(inputs, rollup: Callable[[], rollups.Rollup]) -> Query:
    return inputs(lambda rows: rollup().batch(rows))


def queries() -> dict[str, Query]:
    first, later = {"min_accident_year": FIRST_YEAR}, {"min_accident_year": LATER_YEAR}
    return {
        # Loss triangles
        "tri_basic": _first_facts(triangles.triangle, limit=50, **first),
        "tri_arrays": _first_facts(triangles.triangle_arrays, **first),
        "dev_factors": _first_facts(triangles.development_factors, limit=24, **first),
        "chain_ladder_literal": _first_facts(triangles.chain_ladder_literal, **first),
        "chain_ladder": _first_facts(triangles.chain_ladder, as_of=AS_OF, **first),
        "tri_by_lob": _later_claims(triangles.triangle_by_line, limit=20, **later),
        "claims_profile": _claims(triangles.claims_profile),
        # Mortality
        "mort_exposure": _policies(mortality.exposure),
        "mort_experience": _policies(mortality.experience),
        "mort_trend": _policies(mortality.trend, since="1998-01-01", digits=4, limit=50),
        "mort_geo": _policies(mortality.by_geography, min_policies=100),
        "mort_cohort": _policies(mortality.cohorts, as_of=AS_OF, since="1995-01-01"),
        "mort_shock": _policies(mortality.shocks, min_policies=50, limit=20),
        "mort_profile": _policies(mortality.life_profile),
        "mort_ae": _policies(mortality.actual_to_expected, digits=4),
        # Reserving
        "reserve_summary": _claims(reserving.summary, large_reserve=60_000),
        "reserve_development": _first_claims(reserving.development, **first),
        "reserve_development_cells": _first_claims(reserving.development_cells, **first),
        "reserve_quantiles": _claims(reserving.quantiles),
        "cat_reserves": _later_claims(reserving.catastrophe_reserves, limit=30, **later),
        "cashflow_projection": _claims(reserving.cashflow_projection, **first),
        "reserve_risk": _first_claims(reserving.risk_metrics, **first),
        "reserve_profile": _claims(reserving.reserve_profile),
        "reserve_p95": _claims(reserving.p95_by_line),
        # IFRS 17
        "ifrs_summary": _reserves(ifrs17.summary),
        "csm_movements": _reserves(ifrs17.csm_movements),
        "csm_movement_rows": _reserves(ifrs17.csm_movement_rows),
        "onerous_contracts": _history(ifrs17.onerous_contracts),
        "discount_sensitivity": _reserves(ifrs17.discount_sensitivity),
        "cohort_profitability": _reserves(ifrs17.cohort_profitability),
        "coverage_units": _reserves(ifrs17.coverage_units),
        "risk_adjustment": _reserves(ifrs17.risk_adjustment),
        "ifrs_profile": _reserves(ifrs17.reserves_profile),
        "csm_by_rate": _reserves(ifrs17.csm_by_rate),
        # Catastrophe
        "geo_exposure": _policies(catastrophe.geographic_exposure, high_value=400_000, limit=20),
        "hurricane_exposure": _policies(catastrophe.hurricane_exposure),
        "hurricane_states": _policies(catastrophe.hurricane_states),
        "cat_monitor": _claims(
            catastrophe.event_monitor, as_of=AS_OF, since="2001-01-01", large_loss=90_000
        ),
        "stress_test": _policies(catastrophe.stress_test),
        "reinsurance": _facts(_reinsurance),
        "cat_dashboard": _over(star.policies, star.claim_facts)(catastrophe.dashboard, as_of=AS_OF),
        "cat_profile": _over(star.policies, star.claim_facts)(catastrophe.catastrophe_profile, as_of=AS_OF),
        # After loading
        "verify_policies": _policies(checks.verify_policies),
        "verify_claims": _facts(checks.verify_claims),
        "verify_reserves": _reserves(checks.verify_reserves),
        "triangle_recent": _over(_since(star.claim_facts, int(AS_OF[:4]) - RECENT_YEARS))(
            triangles.triangle_recent, as_of=AS_OF, years=RECENT_YEARS, limit=20
        ),
        "profitability_summary": _reserves(checks.profitability_summary),
        "csm_by_lob": _reserves(checks.csm_by_line),
        "table_counts": _over(star.policy_facts, star.claim_facts, star.contract_groups)(checks.table_counts),
        # Rollups
        "rollup_triangle_proj": _rollup(_claims, rollups.triangle_projection),
        "rollup_triangle": _rollup(_claims, rollups.triangle),
        "rollup_monthly_claims": _rollup(_claims, rollups.monthly_claims),
        "rollup_policy_geo": _rollup(_policies, rollups.policy_geography),
        "rollup_policy_daily": _rollup(_policies, rollups.policy_daily),
        "rollup_ifrs17": _rollup(_reserves, rollups.ifrs17_reporting),
        "rollup_csm_movements": _rollup(_history, rollups.csm_movements),
        "reserve_latest": _rollup(_history, rollups.reserve_latest),
        "rollup_active_policies": _claims(_active_policies),
        # Derivation of claims attributes and reserves
        "derive_dev_month": _facts(
            _claim_rule("month", lambda: derive.development_month("accident_date", "report_date"))
        ),
        "derive_outstanding": _facts(_outstanding),
        "derive_claim_status": _facts(
            _claim_rule("status", lambda: derive.claim_status(F.col("outstanding_reserve")))
        ),
        "quarter_end": _facts(_claim_rule("quarter_end", lambda: derive.quarter_end("report_date"))),
        "contract_groups": _claims(derive.contract_groups),
        "pv_measures": _groups(_measures(show=["pv_factor", "pv_claims", "pv_premiums"])),
        "risk_and_acquisition": _groups(
            _measures(derive.risk_and_acquisition, show=["risk_adjustment", "acquisition_costs"])
        ),
        "csm_split": _groups(
            _measures(
                derive.risk_and_acquisition,
                derive.csm_split,
                show=["initial_csm", "loss_component", "profitability_class"],
            )
        ),
        "csm_amortize": _groups(
            _measures(
                derive.risk_and_acquisition,
                derive.csm_split,
                derive.csm_amortize,
                show=["coverage_units_total", "coverage_units_current", "csm_amortization"],
            )
        ),
        "liabilities": _groups(
            _measures(
                derive.risk_and_acquisition,
                derive.csm_split,
                derive.liabilities,
                show=["best_estimate_liability", "liability_remaining_coverage", "reserve_adequacy_ratio"],
            )
        ),
        "reserve_metadata": _reserves(_metadata),
        # Sources and sinks
        "load_policies": _loaded("policies"),
        "load_claims": _loaded("claims"),
        "load_claims_csv": _loaded("claims", "csv"),
        "load_policies_csv": _loaded("policies", "csv"),
        "load_reserves_csv": _loaded("reserves", "csv"),
        "load_claims_retried": _retried,
        # Every column of what arrived
        "load_policies_columns": _loaded("policies", "csv", show=checks.column_digests),
        "load_claims_columns": _loaded("claims", show=checks.column_digests),
        "load_reserves_columns": _loaded("reserves", show=lambda df: checks.column_digests(df.drop("reserve_metadata"))),
        "load_reserves": _loaded("reserves", glob="/*.parquet"),
        # The same on stored tables: partitions are pruned, no joins are repeated
        "tri_stored": _stored_claims(triangles.triangle, limit=50, **first),
        "tri_by_lob_stored": _stored_claims(triangles.triangle_by_line, limit=20, **later),
        "dev_factors_stored": _stored_claims(triangles.development_factors, limit=24, **first),
        # The same on the rollup's cells: no claims are read
        "tri_rolled": _rolled(triangles.triangle, limit=50, **first),
        "tri_arrays_rolled": _rolled(triangles.triangle_arrays, **first),
        "tri_by_lob_rolled": _rolled(triangles.triangle_by_line, limit=20, **later),
        "dev_factors_rolled": _rolled(triangles.development_factors, limit=24, **first),
        "ifrs_summary_stored": _stored_reserves(ifrs17.summary),
        "csm_movements_stored": _stored_reserves(ifrs17.csm_movements),
        # Answered from Parquet footers
        "verify_claims_footers": _over(_FOOTERS[1])(checks.verify_claims),
        "table_counts_footers": _over(*_FOOTERS)(checks.table_counts),
        "contract_groups_bucketed": _over(_bucketed("claims", star.claim_facts), _bucketed("policies", star.policies))(
            _groups_of_bucketed
        ),
        # Incremental rollups
        "stream_triangle": _streamed(_claim_insertions, rollups.triangle),
        "stream_monthly_claims": _streamed(_claim_insertions, rollups.monthly_claims),
        "stream_policy_daily": _streamed(_policy_insertions, rollups.policy_daily),
        "stream_csm": _streamed(_loads_out_of_order, rollups.csm_movements),
        "stream_reserve_latest": _streamed(_loads_out_of_order, rollups.reserve_latest),
        "stream_triangle_state": _streamed(_claim_insertions, rollups.triangle, stateful),
        "stream_monthly_claims_state": _streamed(_claim_insertions, rollups.monthly_claims, stateful),
        "stream_reserve_latest_state": _streamed(_loads_out_of_order, rollups.reserve_latest, stateful),
        "stream_active_policies": _streamed_active_policies,
    }
