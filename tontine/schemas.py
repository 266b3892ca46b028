"""Declared schemas of the three tables. Money is decimal(18,2) throughout."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "money": T.DecimalType(18, 2),
    "factor": T.DecimalType(18, 6),
    "adequacy": T.DecimalType(18, 4),
}


def _struct(spec: str) -> T.StructType:
    fields = (item.split() for item in spec.strip().split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


POLICIES = _struct("""
    policy_id long, policy_number string, effective_date date, expiry_date date,
    line_of_business string, sum_insured money, premium money, geography string,
    customer_age int, customer_gender string, risk_factors string
""")

CLAIMS = _struct("""
    claim_id long, claim_number string, policy_id long, accident_date date, report_date date,
    accident_year int, development_month int, line_of_business string, geography string,
    claim_cause string, claim_status string, initial_reserve money, paid_amount money,
    outstanding_reserve money, incurred_amount money, claim_attributes string
""")

RESERVES = _struct("""
    contract_group_id string, line_of_business string, geography string, cohort_year int,
    valuation_date date, policy_count long, claim_count long, total_incurred money,
    total_paid money, total_outstanding money, pv_factor factor, pv_claims money,
    pv_premiums money, risk_adjustment money, acquisition_costs money, initial_csm money,
    loss_component money, profitability_class string, coverage_units_total long,
    coverage_units_current long, csm_amortization money, best_estimate_liability money,
    liability_remaining_coverage money, reserve_adequacy_ratio adequacy, reserve_metadata string
""")

TABLES = {"policies": POLICIES, "claims": CLAIMS, "reserves": RESERVES}
