"""The actuarial constants that results depend on.

Rates are decimals, so that products with counts and money stay exact.
"""

from __future__ import annotations

from decimal import Decimal as D

# Lines of business, geographies and statuses.
LINES_OF_BUSINESS = ["Motor", "Property", "Life", "Health", "Pension"]
GEOGRAPHIES = ["CA", "TX", "FL", "NY", "IL", "PA", "OH", "GA", "NC", "MI", "Other"]
UNSETTLED_STATUSES = ["Open", "Reserved"]
CATASTROPHE_LINES = ["Motor", "Property"]
HIGH_RISK_GEOGRAPHIES = ["FL", "TX", "LA", "CA"]
HURRICANE_GEOGRAPHIES = ["FL", "TX", "LA"]

# The five claim causes of each line of business.
CLAIM_CAUSES = {
    "Motor": ["Collision", "Theft", "Vandalism", "Weather", "Other"],
    "Property": ["Fire", "Theft", "Weather", "Water", "Other"],
    "Life": ["Natural", "Accident", "Illness", "Other", "Unknown"],
    "Health": ["Surgery", "Emergency", "Routine", "Specialist", "Other"],
    "Pension": ["Retirement", "Disability", "Death", "Withdrawal", "Other"],
}

# Claim status by outstanding reserve (at most; else Reserved).
STATUS_LIMITS = [(10, "Closed"), (1000, "Open")]

# Fixed values: (last development month, age-to-age factor); later months have factor 1.
DEVELOPMENT_FACTORS = [
    (1, D("2.50")),
    (2, D("1.45")),
    (3, D("1.25")),
    (4, D("1.15")),
    (5, D("1.10")),
    (12, D("1.05")),
    (24, D("1.02")),
]
DEVELOPMENT_TAIL = D("1.00")

# Fixed values: (label, first age above the band, annual death rate, rate per 1000).
MORTALITY_BANDS = [
    ("18-24", 25, D("0.0005"), D("0.5")),
    ("25-34", 35, D("0.0008"), D("0.8")),
    ("35-44", 45, D("0.0015"), D("1.5")),
    ("45-54", 55, D("0.0035"), D("3.5")),
    ("55-64", 65, D("0.0080"), D("8.0")),
    ("65-74", 75, D("0.0180"), D("18.0")),
    ("75+", None, D("0.0400"), D("40.0")),
]

# Fixed values: (first age above the band, base death rate) of the cohort study.
COHORT_MORTALITY = [
    (30, D("0.0008")),
    (40, D("0.0015")),
    (50, D("0.0035")),
    (60, D("0.0080")),
    (70, D("0.0180")),
]
COHORT_MORTALITY_OLDEST = D("0.0400")
DURATION_IMPROVEMENT = D("0.01")

# Fixed values: (first age above the group, group) of the trend study; simulated rates.
TREND_AGE_GROUPS = [(35, "Young"), (55, "Middle")]
TREND_OLDEST_GROUP = "Senior"
TREND_ACTUAL_RATE = D("0.002")
TREND_EXPECTED_RATE = D("0.0025")

# Fixed values: (states, annual death rate, pricing factor); then the values elsewhere.
GEOGRAPHIC_MORTALITY = [
    (["FL", "AZ"], D("0.0035"), D("1.15")),
    (["CA", "NY"], D("0.0025"), D("0.95")),
    (["TX", "IL"], D("0.0028"), D("1.02")),
]
GEOGRAPHIC_MORTALITY_ELSEWHERE = (D("0.0030"), D("1.08"))

# Expected claim rate and the mortality shocks applied to it.
EXPECTED_CLAIM_RATE = D("0.003")
MORTALITY_SHOCKS = [
    ("pandemic_shock_15pct", D("1.15")),
    ("severe_pandemic_25pct", D("1.25")),
    ("improvement_5pct", D("0.95")),
]

# Fixed values: (last development month, weight of the payment ratio); later months weigh 0.
PAYMENT_BANDS = [(12, 0.6), (24, 0.3), (36, 0.08), (48, 0.02)]

# Annual discount rate by line of business, and for any other line.
DISCOUNT_RATES = {
    "Motor": 0.045,
    "Property": 0.042,
    "Life": 0.038,
    "Health": 0.040,
    "Pension": 0.035,
}
DEFAULT_DISCOUNT_RATE = 0.04

# Fixed values: (zone, states, expected loss ratio). Other states are not exposed.
HURRICANE_ZONES = [
    ("Hurricane_Zone_1", ["FL", "LA", "TX"], D("0.08")),
    ("Hurricane_Zone_2", ["NC", "SC", "GA"], D("0.04")),
    ("Hurricane_Zone_3", ["VA", "MD"], D("0.02")),
]
HURRICANE_RETENTION = D("0.7")

# Fixed values: (scenario, loss ratio, affected states).
STRESS_SCENARIOS = [
    ("Major Hurricane", D("0.12"), ["FL", "TX", "LA", "NC", "SC"]),
    ("Widespread Tornado", D("0.06"), ["TX", "OK", "KS", "MO", "IL"]),
    ("California Earthquake", D("0.15"), ["CA"]),
    ("Northeast Winter Storm", D("0.04"), ["NY", "MA", "CT", "NJ", "PA"]),
]
STRESS_RETENTION = D("0.75")

# Fixed values: (layer, attachment, limit, recovery rate).
REINSURANCE_LAYERS = [
    (1, 10_000_000, 40_000_000, D("0.85")),
    (2, 50_000_000, 50_000_000, D("0.90")),
    (3, 100_000_000, 100_000_000, D("0.95")),
]

# Net loss above which a reinsured loss has this impact.
REINSURANCE_IMPACT = [
    (200_000_000, "Severe Impact"),
    (100_000_000, "Major Impact"),
    (50_000_000, "Moderate Impact"),
]
REINSURANCE_SMALLEST_IMPACT = "Manageable Impact"

# The scenario ladder of gross losses, n = 1 .. 21.
SCENARIO_LOSS_BASE = 15_000_000
SCENARIO_LOSS_STEP = 25_000_000
SCENARIO_COUNT = 21
