import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from samples import claims, dicts, one
from tontine.operators import derive


def test_development_month(spark):
    df = spark.sql(
        "select * from values (date'2021-01-31', date'2021-01-31'), (date'2021-01-31', date'2021-02-01'),"
        " (date'2021-01-15', date'2022-01-15'), (date'2021-03-01', date'2021-01-01') t(a, r)"
    )
    assert [r[0] for r in df.select(derive.development_month("a", "r")).collect()] == [1, 2, 13, 1]


def test_quarter_end(spark):
    df = spark.sql("select explode(array(date'2021-01-01', date'2021-03-31', date'2024-02-29', date'2021-10-05')) d")
    assert [str(r[0]) for r in df.select(derive.quarter_end("d")).collect()] == [
        "2021-03-31", "2021-03-31", "2024-03-31", "2021-12-31",
    ]


def test_outstanding_and_status(spark):
    df = claims(
        spark,
        *[{"incurred_amount": i, "paid_amount": 5} for i in (3, 15, 15.01, 1005, 1005.01)],
    ).withColumn("outstanding_reserve", derive.outstanding("incurred_amount", "paid_amount"))
    got = df.select("outstanding_reserve", derive.claim_status(F.col("outstanding_reserve")).alias("s")).collect()
    assert [(float(r[0]), r.s) for r in got] == [
        (0, "Closed"), (10, "Closed"), (10.01, "Open"), (1000, "Open"), (1000.01, "Reserved"),
    ]


def test_contract_groups_count_policies_once(spark):
    df = claims(spark, {"policy_id": 1}, {"policy_id": 1, "incurred_amount": 4}, {"policy_id": 2}, {"geography": "TX"})
    got = {r["contract_group_id"]: r for r in dicts(derive.contract_groups(df))}
    assert set(got) == {"Motor_CA_2021", "Motor_TX_2021"}
    group = got["Motor_CA_2021"]
    assert (group["policy_count"], group["claim_count"], group["total_incurred"]) == (2, 3, 4)


def groups(spark, **changes):
    df = derive.contract_groups(
        claims(spark, {"incurred_amount": 1000, "paid_amount": 400, "outstanding_reserve": 600})
    )
    assumptions = {
        "duration_years": F.lit(0.1),
        "premium_ratio": F.lit(Decimal("1.50")),
        "risk_rate": F.lit(Decimal("0.10")),
        "acquisition_rate": F.lit(Decimal("0.20")),
        "coverage_months": F.lit(12),
        "remaining_share": F.lit(Decimal("0.80")),
        "confidence_level": F.lit(0.85),
        "valuation_date": F.lit("2021-12-31").cast("date"),
        **changes,
    }
    return df.withColumns(assumptions)


def test_reserve_table(spark):
    row = one(derive.reserve_table(groups(spark)))
    # The duration is at least half a year.
    factor = round(1 / 1.045**0.5, 6)
    assert float(row["pv_factor"]) == pytest.approx(factor)
    claims_pv = round(1000 * factor, 2)
    assert float(row["pv_claims"]) == pytest.approx(claims_pv)
    margin = row["pv_premiums"] - row["pv_claims"] - row["acquisition_costs"] - row["risk_adjustment"]
    assert row["initial_csm"] == margin > 0 and row["loss_component"] == 0
    assert row["profitability_class"] == "Profitable"
    assert (row["coverage_units_total"], row["coverage_units_current"]) == (12, 9)
    assert float(row["csm_amortization"]) == pytest.approx(float(margin) * 9 / 12 * 0.25, abs=0.01)
    assert row["liability_remaining_coverage"] == row["best_estimate_liability"] + row["initial_csm"]
    assert float(row["reserve_adequacy_ratio"]) == pytest.approx(600 / claims_pv, abs=1e-4)
    assert '"discount_rate":0.045' in row["reserve_metadata"] and '"last_updated":"2021-12-31"' in row["reserve_metadata"]


def test_onerous_and_zero_units(spark):
    row = one(derive.reserve_table(groups(spark, premium_ratio=F.lit(Decimal("1.00")), coverage_months=F.lit(0))))
    assert row["initial_csm"] == 0 and row["loss_component"] > 0 and row["profitability_class"] == "Onerous"
    assert row["coverage_units_total"] == 0 and row["csm_amortization"] == 0


def test_unknown_line_has_the_default_rate(spark):
    df = groups(spark, line_of_business=F.lit("Marine"))
    assert one(derive.with_discount_rates(df))["discount_rate"] == 0.04
    assert one(derive.with_discount_rates(df, {"Marine": 0.01}))["discount_rate"] == 0.01


def test_history_of_contract_groups(spark):
    """Against counting the claims known at each valuation."""
    rng = random.Random(4)
    rows = [
        {
            "claim_id": i, "policy_id": rng.randint(1, 25), "accident_year": y, "line_of_business": rng.choice(["Motor", "Life"]),
            "accident_date": f"{y}-05-01", "report_date": rng.choice([f"{y}-06-30", f"{y}-12-31", f"{y + 1}-01-01", f"{y + 1}-11-30", f"{y + 1}-12-01", f"{y + 2}-01-01", None]),
            "incurred_amount": i, "paid_amount": 1, "outstanding_reserve": i - 1,
        }
        for i, y in enumerate(rng.choices([2020, 2021], k=120), 1)
    ]
    valuations = [(12, 12), (24, 23), (24, 24)]
    expected = {}
    for row in rows:
        for valued, known in valuations:
            if row["report_date"] is None:
                continue
            year, month, _ = map(int, row["report_date"].split("-"))
            if (year - row["accident_year"]) * 12 + month <= known:
                key = (row["line_of_business"], row["accident_year"], valued, known)
                expected.setdefault(key, []).append(row)
    got = dicts(derive.contract_group_history(claims(spark, *rows), valuations))
    found = sorted(
        (r["line_of_business"], r["cohort_year"], str(r["valuation_date"]), r["policy_count"], r["claim_count"], int(r["total_incurred"]), int(r["total_outstanding"]))
        for r in got
    )
    assert found == sorted(
        (line, year, f"{year + valued // 12 - 1}-12-31", len({r["policy_id"] for r in held}), len(held), sum(r["incurred_amount"] for r in held), sum(r["outstanding_reserve"] for r in held))
        for (line, year, valued, _), held in expected.items()
    )
    assert {r["contract_group_id"] for r in got} >= {"Motor_CA_2020"}
    assert derive.contract_group_history(claims(spark, {"report_date": "2031-01-01"}), valuations).count() == 0


def test_missing_values_stay_missing(spark):
    df = spark.sql("select date'2021-01-31' a, cast(null as date) r, 5.0BD x, cast(null as decimal(18,2)) y")
    row = df.select(
        derive.development_month("a", "r"), derive.outstanding("x", "y"), derive.claim_status(F.col("y"))
    ).first()
    assert list(row) == [None, None, None]
