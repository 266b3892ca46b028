"""The same queries in plain SQL (DuckDB), as an independent check of the results.

Every statement starts with the three tables as views over the source tables. ``_typed``
casts the output columns, written as ``name:kind`` with kinds i (bigint), d (double) and
s (text).
"""

from __future__ import annotations

from tontine import assumptions as A

_KINDS = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR"}

FIXTURE = """
WITH described AS (
  SELECT o.*,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Motor' WHEN 'BUILDING' THEN 'Property'
      WHEN 'HOUSEHOLD' THEN 'Life' WHEN 'MACHINERY' THEN 'Health' ELSE 'Pension' END AS lob,
    ['CA','TX','FL','NY','IL','PA','OH','GA','NC','MI','Other'][c_nationkey % 11 + 1] AS geo
  FROM orders o LEFT JOIN customer ON o_custkey = c_custkey
), policies AS (
  SELECT o_orderkey AS policy_id, CAST(o_orderdate AS DATE) AS effective_date,
    lob AS line_of_business, geo AS geography,
    CAST(o_totalprice AS DECIMAL(18,2)) AS sum_insured,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(2 + o_orderkey % 7 AS DECIMAL(4,0))
         * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS premium,
    18 + o_custkey % 68 AS customer_age,
    CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS customer_gender,
    lob = 'Life' AND o_orderkey % 10 < 6 AS standard_health
  FROM described
), line AS (
  SELECT *, CAST(l_shipdate AS DATE) AS accident_date,
    CAST(l_shipdate AS DATE)
      + CAST((l_partkey * 31 + l_suppkey * 17 + l_linenumber * 7) % 366 AS INTEGER) AS report_date,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS initial_reserve,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
         AS DECIMAL(18,2)) AS incurred_amount
  FROM lineitem
), settled AS (
  SELECT *, CAST(incurred_amount * CAST(l_quantity AS DECIMAL(4,0)) * CAST(0.02 AS DECIMAL(3,2))
                 AS DECIMAL(18,2)) AS paid_amount
  FROM line
), claims AS (
  SELECT l_orderkey AS policy_id, accident_date, report_date,
    year(accident_date) AS accident_year,
    (year(report_date) - year(accident_date)) * 12 + month(report_date) - month(accident_date) + 1
      AS development_month,
    lob AS line_of_business, geo AS geography, initial_reserve, incurred_amount, paid_amount,
    incurred_amount - paid_amount AS outstanding_reserve,
    CASE WHEN incurred_amount - paid_amount <= 10 THEN 'Closed'
         WHEN incurred_amount - paid_amount <= 1000 THEN 'Open' ELSE 'Reserved' END AS claim_status,
    incurred_amount - paid_amount > 10 AS unsettled,
    l_partkey % 20 = 7 AS catastrophe
  FROM settled LEFT JOIN described ON l_orderkey = o_orderkey
), grouped AS (
  SELECT line_of_business, geography, accident_year AS cohort_year,
    line_of_business || '_' || geography || '_' || accident_year AS contract_group_id,
    count(DISTINCT policy_id) AS policy_count, count(*) AS claim_count,
    CAST(sum(incurred_amount) AS DECIMAL(18,2)) AS total_incurred,
    CAST(sum(paid_amount) AS DECIMAL(18,2)) AS total_paid,
    CAST(sum(outstanding_reserve) AS DECIMAL(18,2)) AS total_outstanding
  FROM claims GROUP BY ALL
), indexed AS (
  SELECT *,
    list_position(['Motor','Property','Life','Health','Pension'], line_of_business) - 1 AS li,
    list_position(['CA','TX','FL','NY','IL','PA','OH','GA','NC','MI','Other'], geography) - 1 AS gi
  FROM grouped
), rated AS (
  SELECT *, (gi + li + cohort_year) % 8 AS q,
    [0.045, 0.042, 0.038, 0.040, 0.035][li + 1]::DOUBLE AS rate,
    [3, 3, 15, 3, 20][li + 1] AS dur,
    110 + 3 * ((cohort_year + gi) % 11) AS pr,
    5 + (gi * 3 + li * 7 + cohort_year * 5) % 11 AS ra,
    20 + 3 * ((cohort_year * 2 + gi * 5 + li) % 11) AS ac
  FROM indexed
), valued AS (
  SELECT *, CAST(1.0::DOUBLE / pow(1 + rate, dur) AS DECIMAL(9,6)) AS pv_factor,
    CAST(total_incurred * CAST(1.0::DOUBLE / pow(1 + rate, dur) AS DECIMAL(9,6)) AS DECIMAL(18,2))
      AS pv_claims
  FROM rated
), priced AS (
  SELECT *, CAST(pv_claims * CAST(pr AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))
      AS pv_premiums,
    CAST(pv_claims * CAST(ra AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))
      AS risk_adjustment
  FROM valued
), costed AS (
  SELECT *, CAST(pv_premiums * CAST(ac AS DECIMAL(5,0)) * CAST(0.005 AS DECIMAL(4,3)) AS DECIMAL(18,2))
      AS acquisition_costs
  FROM priced
), split AS (
  SELECT *, pv_premiums - pv_claims - acquisition_costs - risk_adjustment AS margin,
    policy_count * CASE line_of_business WHEN 'Life' THEN 240 WHEN 'Pension' THEN 360
                   ELSE 12 + 4 * gi END AS coverage_units_total
  FROM costed
), released AS (
  SELECT *, CAST(greatest(margin, 0) AS DECIMAL(18,2)) AS initial_csm,
    CAST(greatest(-margin, 0) AS DECIMAL(18,2)) AS loss_component,
    CASE WHEN margin > 0 THEN 'Profitable' ELSE 'Onerous' END AS profitability_class,
    coverage_units_total * (50 + (gi * 5 + li) % 51) // 100 AS coverage_units_current
  FROM split
), reserves AS (
  SELECT *,
    CAST(CAST(initial_csm AS DOUBLE) * coverage_units_current / coverage_units_total * 0.25::DOUBLE
         AS DECIMAL(18,2)) AS csm_amortization,
    pv_claims + risk_adjustment AS best_estimate_liability,
    pv_claims + risk_adjustment + initial_csm - loss_component AS liability_remaining_coverage,
    CAST(CAST(total_outstanding AS DOUBLE) / greatest(1, CAST(pv_claims AS DOUBLE)) AS DECIMAL(18,4))
      AS reserve_adequacy_ratio,
    CAST(last_day(DATE '2001-03-01' + to_months(CAST(3 * q AS INTEGER))) AS DATE) AS valuation_date,
    CASE WHEN q < 2 THEN 0.75 WHEN q < 6 THEN 0.85 ELSE 0.95 END::DOUBLE AS confidence
  FROM released
)
"""


def _with_history(fixture: str) -> str:
    """The reserve table with several valuations of each group, from the claims reported by then."""
    known = "(year(report_date) - accident_year) * 12 + month(report_date) <= known"
    changes = {
        "FROM claims GROUP BY ALL": f"FROM claims JOIN (VALUES (12, 12), (18, 18), (24, 23), (24, 24)) AS v(valued, known) ON {known} GROUP BY ALL",
        "count(DISTINCT policy_id) AS policy_count": "valued, known, count(DISTINCT policy_id) AS policy_count",
        "CAST(last_day(DATE '2001-03-01' + to_months(CAST(3 * q AS INTEGER))) AS DATE)": "CAST(last_day(make_date(cohort_year, 1, 1) + to_months(CAST(valued - 1 AS INTEGER))) AS DATE)",
    }
    for old, new in changes.items():
        assert fixture.count(old) == 1
        fixture = fixture.replace(old, new)
    return fixture


HISTORY = _with_history(FIXTURE)


def _over(a: str, b: str, digits: int | None = None) -> str:
    quotient = f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"
    return f"({quotient})" if digits is None else f"round({quotient}, {digits})"


def _typed(columns: str, body: str, fixture: str = FIXTURE) -> str:
    chosen = []
    for item in columns.split():
        name, kind = item.split(":")
        chosen.append(f"CAST({name} AS {_KINDS[kind]}) AS {name}")
    return f"{fixture}SELECT {', '.join(chosen)} FROM (\n{body.strip()}\n)"


def _text(values: str) -> str:
    return f"array_to_string(list_transform({values}, lambda v: CAST(CAST(v AS DECIMAL(38,2)) AS VARCHAR)), ',')"


_CELLS = """
SELECT accident_year, development_month, sum(paid_amount) AS paid, sum(incurred_amount) AS incurred,
  count(*) AS n
FROM claims WHERE accident_year >= 1995 GROUP BY ALL
"""

_FACTOR = """
CAST(CASE WHEN development_month = 1 THEN 2.50 WHEN development_month = 2 THEN 1.45
  WHEN development_month = 3 THEN 1.25 WHEN development_month = 4 THEN 1.15
  WHEN development_month = 5 THEN 1.10 WHEN development_month <= 12 THEN 1.05
  WHEN development_month <= 24 THEN 1.02 ELSE 1.00 END AS DOUBLE)
"""

_MONTHLY_LIFE = """
SELECT date_trunc('month', effective_date)::DATE AS month_start, customer_gender,
  CASE WHEN customer_age < 35 THEN 'Young' WHEN customer_age < 55 THEN 'Middle' ELSE 'Senior' END
    AS age_group,
  count(*) AS inforce,
  round(count(*) * CAST(0.002 AS DECIMAL(4,3)), 4) AS actual,
  round(count(*) * CAST(0.0025 AS DECIMAL(5,4)), 4) AS expected
FROM policies WHERE line_of_business = 'Life' AND effective_date >= DATE '{since}' GROUP BY ALL
"""

_BAND = """
CASE WHEN customer_age < 25 THEN 1 WHEN customer_age < 35 THEN 2 WHEN customer_age < 45 THEN 3
  WHEN customer_age < 55 THEN 4 WHEN customer_age < 65 THEN 5 WHEN customer_age < 75 THEN 6 ELSE 7 END
"""

_BAND_NAME = "['18-24','25-34','35-44','45-54','55-64','65-74','75+'][band]"


def _triangles() -> dict[str, str]:
    return {
        "tri_basic": _typed(
            "accident_year:i development_month:i cumulative_paid:d cumulative_incurred:d claim_count:i",
            f"""
SELECT accident_year, development_month, paid AS cumulative_paid, incurred AS cumulative_incurred,
  n AS claim_count
FROM ({_CELLS}) ORDER BY 1, 2 LIMIT 50
""",
        ),
        "tri_arrays": _typed(
            "accident_year:i paid_triangle_12m:s incremental_paid_12m:s ultimate_loss_estimate:d "
            "development_periods:i",
            f"""
SELECT accident_year, {_text("list(paid ORDER BY development_month)[1:12]")} AS paid_triangle_12m,
  {_text("list(step ORDER BY development_month)[1:12]")} AS incremental_paid_12m,
  sum(step) AS ultimate_loss_estimate, count(*) AS development_periods
FROM (
  SELECT *, paid - coalesce(lag(paid) OVER (PARTITION BY accident_year ORDER BY development_month), paid)
    AS step
  FROM ({_CELLS})
) GROUP BY accident_year
""",
        ),
        "dev_factors": _typed(
            "development_month:i data_points:i avg_factor:d median_factor:d factor_volatility:d "
            "selected_factor:d",
            f"""
SELECT development_month, count(*) AS data_points, round(avg(f), 4) AS avg_factor,
  round(median(f), 4) AS median_factor, round(stddev_pop(f), 4) AS factor_volatility,
  round(sum(prior * f) / sum(prior), 4) AS selected_factor
FROM (
  SELECT development_month, CAST(before AS DOUBLE) AS prior, {_over("paid", "before")} AS f
  FROM (SELECT *, lag(paid) OVER (PARTITION BY accident_year ORDER BY development_month) AS before
        FROM ({_CELLS}))
  WHERE before > 1000
) GROUP BY development_month HAVING count(*) >= 3 ORDER BY 1 LIMIT 24
""",
        ),
        "chain_ladder_literal": _typed(
            "accident_year:i latest_paid:d ultimate_projection:d ibnr_estimate:d ibnr_ratio:d",
            f"""
SELECT accident_year, max(paid) AS latest_paid, round(max(projection), 2) AS ultimate_projection,
  round(max(projection) - CAST(max(paid) AS DOUBLE), 2) AS ibnr_estimate,
  {_over("max(projection) - CAST(max(paid) AS DOUBLE)", "max(paid)", 4)} AS ibnr_ratio
FROM (
  SELECT *, CAST(paid AS DOUBLE) * list_product(list_slice(
    list({_FACTOR}) OVER (ORDER BY development_month), development_month, development_month + 49))
    AS projection
  FROM ({_CELLS})
) GROUP BY accident_year
""",
        ),
        "chain_ladder": _typed(
            "accident_year:i development_month:i latest_paid:d factor_to_ultimate:d "
            "ultimate_projection:d ibnr_estimate:d",
            f"""
WITH known AS (
  SELECT accident_year, development_month, sum(paid_amount) AS paid
  FROM claims WHERE report_date <= DATE '2001-11-05' AND accident_year >= 1995 GROUP BY ALL
), months AS (
  SELECT development_month, {_FACTOR} AS f FROM (SELECT DISTINCT development_month FROM known)
), latest AS (
  SELECT * FROM known
  QUALIFY row_number() OVER (PARTITION BY accident_year ORDER BY development_month DESC) = 1
), joined AS (
  SELECT accident_year, k.development_month, paid,
    coalesce(product(f) FILTER (m.development_month > k.development_month), 1) AS rest
  FROM latest k, months m GROUP BY ALL
)
SELECT accident_year, development_month, paid AS latest_paid, round(rest, 6) AS factor_to_ultimate,
  round(CAST(paid AS DOUBLE) * rest, 2) AS ultimate_projection,
  round(CAST(paid AS DOUBLE) * rest - CAST(paid AS DOUBLE), 2) AS ibnr_estimate
FROM joined
""",
        ),
        "tri_by_lob": _typed(
            "line_of_business:s accident_year:i paid_triangle_12m:s total_paid_to_date:d",
            f"""
SELECT line_of_business, accident_year,
  {_text("list(round(paid, 0) ORDER BY development_month)[1:12]")} AS paid_triangle_12m,
  sum(paid) AS total_paid_to_date
FROM (SELECT line_of_business, accident_year, development_month, sum(paid_amount) AS paid
      FROM claims WHERE accident_year >= 1998 GROUP BY ALL)
GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 20
""",
        ),
        "claims_profile": _typed(
            "total_claims_processed:i accident_years:i max_development_period:i lines_of_business:i",
            """
SELECT count(*) AS total_claims_processed, count(DISTINCT accident_year) AS accident_years,
  max(development_month) AS max_development_period,
  count(DISTINCT line_of_business) AS lines_of_business
FROM claims
""",
        ),
        "triangle_recent": _typed(
            "accident_year:i development_month:i total_paid:d total_incurred:d claim_count:i",
            """
SELECT accident_year, development_month, sum(paid_amount) AS total_paid,
  sum(incurred_amount) AS total_incurred, count(*) AS claim_count
FROM claims WHERE accident_year >= year(DATE '2001-11-05') - 3
GROUP BY ALL ORDER BY 1, 2 LIMIT 20
""",
        ),
    }


def _mortality() -> dict[str, str]:
    return {
        "mort_exposure": _typed(
            "customer_age:i customer_gender:s exposure_count:i standard_risk:i senior_policies:i age_band:s",
            f"""
SELECT customer_age, customer_gender, {_BAND_NAME} AS age_band, count(*) AS exposure_count,
  count(*) FILTER (standard_health) AS standard_risk,
  count(*) FILTER (customer_age > 65) AS senior_policies
FROM (SELECT *, {_BAND} AS band FROM policies WHERE line_of_business = 'Life') GROUP BY ALL
""",
        ),
        "mort_experience": _typed(
            "age_band:s customer_gender:s total_exposure:i expected_deaths:d expected_rate_per_1000:d",
            f"""
SELECT {_BAND_NAME} AS age_band, customer_gender, n AS total_exposure,
  round(n * CAST([0.0005, 0.0008, 0.0015, 0.0035, 0.0080, 0.0180, 0.0400][band] AS DECIMAL(5,4)), 2)
    AS expected_deaths,
  [0.5, 0.8, 1.5, 3.5, 8.0, 18.0, 40.0][band] AS expected_rate_per_1000
FROM (SELECT {_BAND} AS band, customer_gender, count(*) AS n
      FROM policies WHERE line_of_business = 'Life' GROUP BY ALL)
""",
        ),
        "mort_trend": _typed(
            "month_start:s age_group:s customer_gender:s policies_inforce:i actual_deaths:d "
            "expected_deaths:d actual_to_expected_ratio:d rolling_12m_ae_ratio:d yoy_mortality_ratio:d",
            f"""
SELECT month_start, age_group, customer_gender, inforce AS policies_inforce, actual AS actual_deaths,
  expected AS expected_deaths, {_over("actual", "expected", 4)} AS actual_to_expected_ratio,
  round(avg({_over("actual", "expected")}) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 4)
    AS rolling_12m_ae_ratio,
  {_over("actual", "lag(actual, 12) OVER w", 4)} AS yoy_mortality_ratio
FROM ({_MONTHLY_LIFE.format(since="1998-01-01")}) WHERE actual > 0
WINDOW w AS (PARTITION BY age_group, customer_gender ORDER BY month_start)
ORDER BY month_start DESC, age_group, customer_gender LIMIT 50
""",
        ),
        "mort_ae": _typed(
            "age_group:s customer_gender:s exposure:i actual_to_expected_ratio:d",
            f"""
SELECT age_group, customer_gender, sum(inforce) AS exposure,
  {_over("sum(actual)", "sum(expected)", 4)} AS actual_to_expected_ratio
FROM ({_MONTHLY_LIFE.format(since="1900-01-01")}) GROUP BY ALL
""",
        ),
        "mort_geo": _typed(
            "geography:s life_policies:i total_coverage:d avg_age:d expected_annual_deaths:d "
            "credibility_factor:d geographic_pricing_factor:d",
            f"""
SELECT geography, n AS life_policies, cover AS total_coverage, {_over("ages", "n", 1)} AS avg_age,
  round(n * CAST([0.0035, 0.0025, 0.0028, 0.0030][kind] AS DECIMAL(5,4)), 1) AS expected_annual_deaths,
  round(sqrt(n) / 100, 2) AS credibility_factor,
  [1.15, 0.95, 1.02, 1.08][kind] AS geographic_pricing_factor
FROM (
  SELECT geography, count(*) AS n, sum(sum_insured) AS cover, sum(customer_age) AS ages,
    CASE WHEN geography IN ('FL', 'AZ') THEN 1 WHEN geography IN ('CA', 'NY') THEN 2
         WHEN geography IN ('TX', 'IL') THEN 3 ELSE 4 END AS kind
  FROM policies WHERE line_of_business = 'Life' GROUP BY geography HAVING count(*) > 100
)
""",
        ),
        "mort_cohort": _typed(
            "issue_year:i customer_gender:s total_policies:i avg_issue_age:d avg_duration:d "
            "expected_annual_deaths:d mortality_rate_per_1000:d",
            f"""
SELECT issue_year, customer_gender, sum(n) AS total_policies,
  {_over("sum(customer_age)", "count(*)", 1)} AS avg_issue_age,
  {_over("sum(2001 - issue_year)", "count(*)", 1)} AS avg_duration,
  round(sum(n * rate), 1) AS expected_annual_deaths,
  round({_over("sum(n * rate)", "sum(n)")} * 1000, 2) AS mortality_rate_per_1000
FROM (
  SELECT *, CAST(CAST(CASE WHEN customer_age < 30 THEN 0.0008 WHEN customer_age < 40 THEN 0.0015
      WHEN customer_age < 50 THEN 0.0035 WHEN customer_age < 60 THEN 0.0080
      WHEN customer_age < 70 THEN 0.0180 ELSE 0.0400 END AS DECIMAL(5,4))
    * (1 - CAST(2001 - issue_year AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(12,8)) AS rate
  FROM (SELECT year(effective_date) AS issue_year, customer_age, customer_gender, count(*) AS n
        FROM policies WHERE line_of_business = 'Life' AND effective_date >= DATE '1995-01-01'
        GROUP BY ALL)
) GROUP BY issue_year, customer_gender
""",
        ),
        "mort_shock": _typed(
            "geography:s customer_gender:s policy_count:i total_coverage:d avg_age:d "
            "base_expected_claims:d pandemic_shock_15pct:d severe_pandemic_25pct:d improvement_5pct:d "
            "pandemic_impact:d impact_ratio:d",
            f"""
SELECT geography, customer_gender, n AS policy_count, round(cover, 0) AS total_coverage,
  {_over("ages", "n", 1)} AS avg_age, round(base, 0) AS base_expected_claims,
  round(base * CAST(1.15 AS DECIMAL(3,2)), 0) AS pandemic_shock_15pct,
  round(base * CAST(1.25 AS DECIMAL(3,2)), 0) AS severe_pandemic_25pct,
  round(base * CAST(0.95 AS DECIMAL(3,2)), 0) AS improvement_5pct,
  round(base * CAST(1.15 AS DECIMAL(3,2)) - base, 0) AS pandemic_impact,
  {_over("base * CAST(1.15 AS DECIMAL(3,2)) - base", "base", 4)} AS impact_ratio
FROM (
  SELECT geography, customer_gender, count(*) AS n, sum(sum_insured) AS cover,
    sum(customer_age) AS ages,
    CAST(sum(sum_insured) AS DECIMAL(28,2)) * CAST(0.003 AS DECIMAL(4,3)) AS base
  FROM policies WHERE line_of_business = 'Life' GROUP BY ALL HAVING count(*) > 50
)
ORDER BY pandemic_impact DESC, geography, customer_gender LIMIT 20
""",
        ),
        "mort_profile": _typed(
            "life_policies_analyzed:i age_cohorts:i geographic_regions:i gender_categories:i "
            "total_coverage_analyzed:d",
            """
SELECT count(*) AS life_policies_analyzed, count(DISTINCT customer_age) AS age_cohorts,
  count(DISTINCT geography) AS geographic_regions,
  count(DISTINCT customer_gender) AS gender_categories,
  round(sum(sum_insured), 0) AS total_coverage_analyzed
FROM policies WHERE line_of_business = 'Life'
""",
        ),
    }


def _reserving() -> dict[str, str]:
    reserve = "CAST(outstanding_reserve AS DOUBLE)"
    development = f"""
SELECT accident_year, development_month, line_of_business, sum(initial_reserve) AS initial_reserves,
  sum(outstanding_reserve) AS current_reserves, sum(paid_amount) AS paid_to_date,
  count(*) AS claim_count, sum(initial_reserve) - sum(outstanding_reserve) AS reserve_change,
  {_over("sum(initial_reserve) - sum(outstanding_reserve)", "sum(initial_reserve)", 4)}
    AS reserve_release_ratio,
  {_over("sum(paid_amount)", "sum(paid_amount) + sum(outstanding_reserve)", 4)} AS payment_pattern
FROM claims WHERE accident_year >= 1995 GROUP BY ALL HAVING sum(initial_reserve) > 0
"""
    return {
        "reserve_summary": _typed(
            "line_of_business:s active_claims:i total_reserves:d total_paid:d total_incurred:d "
            "avg_reserve_per_claim:d reserve_to_incurred_ratio:d payment_ratio:d "
            "large_reserves_100k_plus:i large_reserves_amount:d",
            f"""
SELECT line_of_business, count(*) AS active_claims, sum(outstanding_reserve) AS total_reserves,
  sum(paid_amount) AS total_paid, sum(incurred_amount) AS total_incurred,
  {_over("sum(outstanding_reserve)", "count(*)", 2)} AS avg_reserve_per_claim,
  {_over("sum(outstanding_reserve)", "sum(incurred_amount)", 4)} AS reserve_to_incurred_ratio,
  {_over("sum(paid_amount)", "sum(incurred_amount)", 4)} AS payment_ratio,
  count(*) FILTER (outstanding_reserve > 60000) AS large_reserves_100k_plus,
  coalesce(sum(outstanding_reserve) FILTER (outstanding_reserve > 60000), 0) AS large_reserves_amount
FROM claims WHERE unsettled GROUP BY line_of_business
""",
        ),
        "reserve_development_cells": _typed(
            "accident_year:i development_month:i line_of_business:s initial_reserves:d "
            "current_reserves:d paid_to_date:d claim_count:i reserve_change:d reserve_release_ratio:d "
            "payment_pattern:d",
            development,
        ),
        "reserve_development": _typed(
            "accident_year:i line_of_business:s latest_development:i total_initial_reserves:d "
            "total_current_reserves:d total_reserve_release:d overall_release_ratio:d "
            "adequacy_assessment:s",
            f"""
SELECT *, round(released, 4) AS overall_release_ratio,
  CASE WHEN released > 0.1 THEN 'Over-Reserved' WHEN released < -0.1 THEN 'Under-Reserved'
       ELSE 'Adequate' END AS adequacy_assessment
FROM (
  SELECT accident_year, line_of_business, max(development_month) AS latest_development,
    sum(initial_reserves) AS total_initial_reserves, sum(current_reserves) AS total_current_reserves,
    sum(reserve_change) AS total_reserve_release,
    {_over("sum(reserve_change)", "sum(initial_reserves)")} AS released
  FROM ({development}) GROUP BY 1, 2
)
""",
        ),
        "reserve_quantiles": _typed(
            "line_of_business:s accident_year:i claim_status:s claim_count:i total_reserves:d "
            "median_reserve:d p75_reserve:d p90_reserve:d p95_reserve:d reserve_volatility:d "
            "coefficient_of_variation:d reserve_10pct_buffer:d reserve_20pct_buffer:d",
            f"""
SELECT line_of_business, accident_year, claim_status, count(*) AS claim_count,
  round(sum(outstanding_reserve), 0) AS total_reserves,
  round(quantile_cont({reserve}, 0.50), 0) AS median_reserve,
  round(quantile_cont({reserve}, 0.75), 0) AS p75_reserve,
  round(quantile_cont({reserve}, 0.90), 0) AS p90_reserve,
  round(quantile_cont({reserve}, 0.95), 0) AS p95_reserve,
  round(stddev_pop({reserve}), 0) AS reserve_volatility,
  round(stddev_pop({reserve}) / quantile_cont({reserve}, 0.50), 2) AS coefficient_of_variation,
  round(CAST(sum(outstanding_reserve) AS DECIMAL(28,2)) * CAST(1.1 AS DECIMAL(2,1)), 0)
    AS reserve_10pct_buffer,
  round(CAST(sum(outstanding_reserve) AS DECIMAL(28,2)) * CAST(1.2 AS DECIMAL(2,1)), 0)
    AS reserve_20pct_buffer
FROM claims WHERE outstanding_reserve > 0 GROUP BY 1, 2, 3 HAVING count(*) > 10
""",
        ),
        "cat_reserves": _typed(
            "loss_type:s accident_year:i geography:s total_claims:i total_reserves:d total_paid:d "
            "avg_reserve_per_claim:d reserve_concentration:d payment_ratio:d",
            f"""
WITH typed AS (
  SELECT *, CASE WHEN catastrophe THEN 'CAT' WHEN outstanding_reserve > 50000 THEN 'Large Loss'
                 ELSE 'Attritional' END AS loss_type
  FROM claims WHERE accident_year >= 1998
), monthly AS (
  SELECT loss_type, accident_year, geography, line_of_business, month(accident_date) AS m,
    count(*) AS n, sum(outstanding_reserve) AS o, sum(paid_amount) AS p, sum(incurred_amount) AS i
  FROM typed GROUP BY ALL
)
SELECT loss_type, accident_year, geography, sum(n) AS total_claims, round(sum(o), 0) AS total_reserves,
  round(sum(p), 0) AS total_paid, round(avg({_over("o", "n")}), 0) AS avg_reserve_per_claim,
  {_over("sum(o)", "(SELECT sum(outstanding_reserve) FROM typed)", 4)} AS reserve_concentration,
  {_over("sum(p)", "sum(i)", 4)} AS payment_ratio
FROM monthly GROUP BY 1, 2, 3 HAVING sum(n) > 5
ORDER BY total_reserves DESC, 1, 2, 3 LIMIT 30
""",
        ),
        "cashflow_projection": _typed(
            "line_of_business:s current_reserves:d projected_payments_year1:d "
            "projected_payments_year2:d projected_payments_year3:d projected_payments_year4:d",
            f"""
WITH pattern AS (
  SELECT line_of_business AS lob, development_month AS m,
    {_over("sum(paid_amount)", "sum(paid_amount) + sum(outstanding_reserve)", 4)} *
    CASE WHEN development_month <= 12 THEN 0.6 WHEN development_month <= 24 THEN 0.3
         WHEN development_month <= 36 THEN 0.08 WHEN development_month <= 48 THEN 0.02
         ELSE 0 END::DOUBLE AS share
  FROM claims WHERE accident_year >= 1995 GROUP BY line_of_business, development_month
)
SELECT lob AS line_of_business, sum(outstanding_reserve) AS current_reserves,
  round(CAST(sum(outstanding_reserve) AS DOUBLE) * max(CASE WHEN m <= 12 THEN share ELSE 0 END), 0)
    AS projected_payments_year1,
  round(CAST(sum(outstanding_reserve) AS DOUBLE) * max(CASE WHEN m <= 24 THEN share ELSE 0 END), 0)
    AS projected_payments_year2,
  round(CAST(sum(outstanding_reserve) AS DOUBLE) * max(CASE WHEN m <= 36 THEN share ELSE 0 END), 0)
    AS projected_payments_year3,
  round(CAST(sum(outstanding_reserve) AS DOUBLE) * max(CASE WHEN m <= 48 THEN share ELSE 0 END), 0)
    AS projected_payments_year4
FROM claims LEFT JOIN pattern ON line_of_business = lob
WHERE unsettled GROUP BY lob
""",
        ),
        "reserve_risk": _typed(
            "line_of_business:s total_claims:i total_reserves:d avg_reserve_per_claim:d "
            "avg_coefficient_variation:d reserve_risk_capital_estimate:d capital_ratio:d "
            "avg_p99_reserve:d tail_risk_multiplier:d",
            f"""
SELECT line_of_business, sum(n) AS total_claims, round(sum(total), 0) AS total_reserves,
  round(avg(average), 0) AS avg_reserve_per_claim, round(avg(cv), 4) AS avg_coefficient_variation,
  round(CAST(sum(total) AS DOUBLE) * sqrt(avg(cv)), 0) AS reserve_risk_capital_estimate,
  {_over("CAST(sum(total) AS DOUBLE) * sqrt(avg(cv))", "sum(total)", 4)} AS capital_ratio,
  round(avg(p99), 0) AS avg_p99_reserve, round(avg(p99) / avg(average), 2) AS tail_risk_multiplier
FROM (
  SELECT line_of_business, geography, accident_year, count(*) AS n, sum(outstanding_reserve) AS total,
    {_over("sum(outstanding_reserve)", "count(*)")} AS average,
    stddev_pop({reserve}) / {_over("sum(outstanding_reserve)", "count(*)")} AS cv,
    quantile_cont({reserve}, 0.99) AS p99
  FROM claims WHERE outstanding_reserve > 0 AND accident_year >= 1995
  GROUP BY 1, 2, 3 HAVING count(*) > 20
) GROUP BY line_of_business
""",
        ),
        "reserve_profile": _typed(
            "claims_analyzed:i total_reserves_calculated:d lines_analyzed:i accident_years_analyzed:i "
            "geographies_analyzed:i",
            """
SELECT count(*) AS claims_analyzed, sum(outstanding_reserve) AS total_reserves_calculated,
  count(DISTINCT line_of_business) AS lines_analyzed,
  count(DISTINCT accident_year) AS accident_years_analyzed,
  count(DISTINCT geography) AS geographies_analyzed
FROM claims WHERE outstanding_reserve > 0
""",
        ),
        "reserve_p95": _typed(
            "line_of_business:s total_reserves:d p95_reserve:d",
            f"""
SELECT line_of_business, sum(outstanding_reserve) AS total_reserves,
  round(quantile_cont({reserve}, 0.95), 4) AS p95_reserve
FROM claims WHERE unsettled GROUP BY line_of_business
""",
        ),
    }


def _ifrs17() -> dict[str, str]:
    csm, loss, prem, claims = (f"sum({c})" for c in ("initial_csm", "loss_component", "pv_premiums", "pv_claims"))
    ra, bel = "sum(risk_adjustment)", "sum(best_estimate_liability)"
    units, left = "sum(coverage_units_total)", "sum(coverage_units_current)"

    def shifted(c: str, by: str) -> str:
        return f"sum(CAST({c} AS DOUBLE) / CAST(pv_factor AS DOUBLE) / pow(1 + rate {by}::DOUBLE, 5))"

    return {
        "ifrs_summary": _typed(
            "line_of_business:s profitability_class:s contract_groups:i total_pv_premiums:d "
            "total_pv_claims:d total_acquisition_costs:d total_risk_adjustment:d total_csm:d "
            "total_loss_component:d total_lrc:d csm_margin_ratio:d loss_ratio:d",
            f"""
SELECT line_of_business, profitability_class, count(*) AS contract_groups,
  round({prem}, 0) AS total_pv_premiums, round({claims}, 0) AS total_pv_claims,
  round(sum(acquisition_costs), 0) AS total_acquisition_costs, round({ra}, 0) AS total_risk_adjustment,
  round({csm}, 0) AS total_csm, round({loss}, 0) AS total_loss_component,
  round(sum(liability_remaining_coverage), 0) AS total_lrc,
  {_over(csm, prem, 4)} AS csm_margin_ratio, {_over(loss, prem, 4)} AS loss_ratio
FROM reserves GROUP BY 1, 2
""",
        ),
        "csm_movement_rows": _typed(
            "contract_group_id:s line_of_business:s geography:s cohort_year:i valuation_date:s "
            "initial_csm:d csm_amortization:d closing_csm:d amortization_rate_period:d "
            "remaining_coverage_ratio:d",
            f"""
SELECT *, initial_csm - csm_amortization AS closing_csm,
  {_over("csm_amortization", "initial_csm", 4)} AS amortization_rate_period,
  {_over("coverage_units_current", "coverage_units_total", 4)} AS remaining_coverage_ratio
FROM reserves WHERE profitability_class = 'Profitable' AND initial_csm > 0
""",
        ),
        "csm_movements": _typed(
            "line_of_business:s reporting_year:i profitable_contract_groups:i opening_csm:d "
            "period_amortization:d closing_csm:d avg_amortization_rate:d avg_remaining_coverage:d "
            "projected_next_period_amort:d",
            f"""
SELECT line_of_business, year(valuation_date) AS reporting_year, count(*) AS profitable_contract_groups,
  round(sum(initial_csm), 0) AS opening_csm, round(sum(csm_amortization), 0) AS period_amortization,
  round(sum(initial_csm) - sum(csm_amortization), 0) AS closing_csm,
  round(CAST({_over("sum(rate)", "count(*)")} AS DECIMAL(18,8)), 4) AS avg_amortization_rate,
  round(CAST({_over("sum(remaining)", "count(*)")} AS DECIMAL(18,8)), 4) AS avg_remaining_coverage,
  round(CAST(sum(initial_csm) - sum(csm_amortization) AS DOUBLE) * {_over("sum(rate)", "count(*)")}, 0)
    AS projected_next_period_amort
FROM (SELECT * EXCLUDE (rate),
        CAST({_over("csm_amortization", "initial_csm", 4)} AS DECIMAL(18,4)) AS rate,
        CAST({_over("coverage_units_current", "coverage_units_total", 4)} AS DECIMAL(18,4)) AS remaining
      FROM reserves WHERE profitability_class = 'Profitable' AND initial_csm > 0)
GROUP BY 1, 2
""",
        ),
        "onerous_contracts": _typed(
            "line_of_business:s geography:s cohort_year:i onerous_contract_groups:i "
            "total_loss_component:d total_pv_claims:d total_pv_premiums:d total_risk_adjustment:d "
            "claims_to_premium_ratio:d loss_component_ratio:d total_coverage_units:i "
            "loss_per_coverage_unit:d",
            f"""
SELECT line_of_business, geography, cohort_year, count(*) AS onerous_contract_groups,
  round({loss}, 0) AS total_loss_component, round({claims}, 0) AS total_pv_claims,
  round({prem}, 0) AS total_pv_premiums, round({ra}, 0) AS total_risk_adjustment,
  {_over(claims, prem, 4)} AS claims_to_premium_ratio, {_over(loss, prem, 4)} AS loss_component_ratio,
  {units} AS total_coverage_units, {_over(loss, units, 2)} AS loss_per_coverage_unit
FROM reserves WHERE profitability_class = 'Onerous' GROUP BY 1, 2, 3
""",
            HISTORY,
        ),
        "discount_sensitivity": _typed(
            "line_of_business:s base_pv_claims:d base_pv_premiums:d base_net_margin:d "
            "up100bp_claims_impact:d up100bp_premiums_impact:d up100bp_net_impact:d "
            "down100bp_claims_impact:d down100bp_premiums_impact:d down100bp_net_impact:d",
            f"""
SELECT line_of_business, round(c, 0) AS base_pv_claims, round(p, 0) AS base_pv_premiums,
  round(p - c, 0) AS base_net_margin,
  round(uc - c::DOUBLE, 0) AS up100bp_claims_impact, round(up - p::DOUBLE, 0) AS up100bp_premiums_impact,
  round(up - uc - (p - c)::DOUBLE, 0) AS up100bp_net_impact,
  round(dc - c::DOUBLE, 0) AS down100bp_claims_impact,
  round(dp - p::DOUBLE, 0) AS down100bp_premiums_impact,
  round(dp - dc - (p - c)::DOUBLE, 0) AS down100bp_net_impact
FROM (
  SELECT line_of_business, {claims} AS c, {prem} AS p,
    {shifted("pv_claims", "+ 0.01")} AS uc, {shifted("pv_premiums", "+ 0.01")} AS up,
    {shifted("pv_claims", "- 0.01")} AS dc, {shifted("pv_premiums", "- 0.01")} AS dp
  FROM reserves GROUP BY line_of_business
)
""",
        ),
        "cohort_profitability": _typed(
            "cohort_year:i line_of_business:s total_contract_groups:i profitable_groups:i "
            "onerous_groups:i profitable_ratio:d total_pv_premiums:d total_pv_claims:d total_csm:d "
            "total_loss_component:d net_profitability:d profit_margin_ratio:d loss_ratio:d",
            f"""
SELECT cohort_year, line_of_business, count(*) AS total_contract_groups,
  count(*) FILTER (profitability_class = 'Profitable') AS profitable_groups,
  count(*) FILTER (profitability_class = 'Onerous') AS onerous_groups,
  {_over("count(*) FILTER (profitability_class = 'Profitable')", "count(*)", 2)} AS profitable_ratio,
  round({prem}, 0) AS total_pv_premiums, round({claims}, 0) AS total_pv_claims,
  round({csm}, 0) AS total_csm, round({loss}, 0) AS total_loss_component,
  round({csm} - {loss}, 0) AS net_profitability, {_over(f"{csm} - {loss}", prem, 4)} AS profit_margin_ratio,
  {_over(claims, prem, 4)} AS loss_ratio
FROM reserves GROUP BY 1, 2
""",
        ),
        "coverage_units": _typed(
            "line_of_business:s profitability_class:s contract_groups:i total_coverage_units:i "
            "current_coverage_units:i remaining_coverage_ratio:d avg_total_units_per_group:d "
            "std_dev_coverage_units:d expected_remaining_csm:d period_amortization_rate:d",
            f"""
SELECT line_of_business, profitability_class, count(*) AS contract_groups,
  {units} AS total_coverage_units, {left} AS current_coverage_units,
  {_over(left, units, 4)} AS remaining_coverage_ratio,
  {_over(units, "count(*)", 0)} AS avg_total_units_per_group,
  round(stddev_pop(coverage_units_total), 0) AS std_dev_coverage_units,
  round(CAST({csm} AS DOUBLE) * {_over(left, units)}, 0) AS expected_remaining_csm,
  {_over("sum(csm_amortization)", csm, 4)} AS period_amortization_rate
FROM reserves WHERE coverage_units_total > 0 GROUP BY 1, 2
""",
        ),
        "risk_adjustment": _typed(
            "line_of_business:s geography:s contract_groups:i total_risk_adjustment:d total_pv_claims:d "
            "total_bel:d avg_confidence_level:d ra_to_claims_ratio:d ra_to_bel_ratio:d "
            "risk_adjustment_level:s",
            f"""
SELECT line_of_business, geography, count(*) AS contract_groups, round({ra}, 0) AS total_risk_adjustment,
  round({claims}, 0) AS total_pv_claims, round({bel}, 0) AS total_bel,
  {_over("sum(CAST(confidence AS DECIMAL(18,6)))", "count(*)", 2)} AS avg_confidence_level, {_over(ra, claims, 4)} AS ra_to_claims_ratio,
  {_over(ra, bel, 4)} AS ra_to_bel_ratio,
  CASE WHEN {_over(ra, claims)} > 0.10 THEN 'High' WHEN {_over(ra, claims)} > 0.05 THEN 'Moderate'
       ELSE 'Low' END AS risk_adjustment_level
FROM reserves GROUP BY 1, 2
""",
        ),
        "ifrs_profile": _typed(
            "contract_groups_processed:i total_csm_calculated:d total_loss_component_calculated:d "
            "lines_analyzed:i cohort_years_analyzed:i profitability_classes:i",
            f"""
SELECT count(*) AS contract_groups_processed, {csm} AS total_csm_calculated,
  {loss} AS total_loss_component_calculated, count(DISTINCT line_of_business) AS lines_analyzed,
  count(DISTINCT cohort_year) AS cohort_years_analyzed,
  count(DISTINCT profitability_class) AS profitability_classes
FROM reserves
""",
        ),
        "csm_by_rate": _typed(
            "line_of_business:s discount_rate:d total_csm:d",
            f"""
SELECT line_of_business, rate AS discount_rate, {csm} AS total_csm
FROM reserves WHERE profitability_class = 'Profitable' GROUP BY 1, 2
""",
        ),
        "verify_reserves": _typed(
            "contract_groups:i lines_of_business:i total_csm:d total_loss_component:d total_bel:d",
            f"""
SELECT count(*) AS contract_groups, count(DISTINCT line_of_business) AS lines_of_business,
  {csm} AS total_csm, {loss} AS total_loss_component, {bel} AS total_bel
FROM reserves
""",
        ),
        "profitability_summary": _typed(
            "profitability_class:s contract_count:i total_csm:d total_loss_component:d total_lrc:d "
            "avg_adequacy_ratio:d",
            f"""
SELECT profitability_class, count(*) AS contract_count, {csm} AS total_csm,
  {loss} AS total_loss_component, sum(liability_remaining_coverage) AS total_lrc,
  {_over("sum(reserve_adequacy_ratio)", "count(*)", 4)} AS avg_adequacy_ratio
FROM reserves GROUP BY profitability_class
""",
        ),
        "csm_by_lob": _typed(
            "line_of_business:s total_csm:d period_amortization:d remaining_csm:d contract_groups:i",
            f"""
SELECT line_of_business, {csm} AS total_csm, sum(csm_amortization) AS period_amortization,
  {csm} - sum(csm_amortization) AS remaining_csm, count(*) AS contract_groups
FROM reserves WHERE profitability_class = 'Profitable' GROUP BY line_of_business
""",
        ),
    }


def _catastrophe() -> dict[str, str]:
    exposed = "policies WHERE line_of_business IN ('Motor', 'Property')"
    zone = """
SELECT *, CASE WHEN geography IN ('FL', 'LA', 'TX') THEN 1 WHEN geography IN ('NC', 'SC', 'GA') THEN 2
  WHEN geography IN ('VA', 'MD') THEN 3 END AS z
FROM policies WHERE line_of_business IN ('Motor', 'Property')
"""
    return {
        "geo_exposure": _typed(
            "geography:s line_of_business:s policy_count:i total_exposure:d total_premium:d "
            "avg_policy_size:d largest_policy:d exposure_concentration_pct:d high_value_policies:i "
            "high_value_exposure:d",
            f"""
SELECT geography, line_of_business, count(*) AS policy_count, round(sum(sum_insured), 0) AS total_exposure,
  round(sum(premium), 0) AS total_premium, {_over("sum(sum_insured)", "count(*)", 0)} AS avg_policy_size,
  round(max(sum_insured), 0) AS largest_policy,
  {_over("sum(sum_insured)", f"(SELECT sum(sum_insured) FROM {exposed})", 4)} AS exposure_concentration_pct,
  count(*) FILTER (sum_insured > 400000) AS high_value_policies,
  coalesce(sum(sum_insured) FILTER (sum_insured > 400000), 0) AS high_value_exposure
FROM {exposed} GROUP BY 1, 2 ORDER BY total_exposure DESC, 1, 2 LIMIT 20
""",
        ),
        "hurricane_exposure": _typed(
            "hurricane_zone:s line_of_business:s exposed_policies:i total_exposure:d total_premium:d "
            "expected_loss_ratio_pct:d expected_gross_loss:d expected_net_loss:d "
            "loss_to_premium_ratio:d net_loss_ratio:d",
            f"""
SELECT 'Hurricane_Zone_' || z AS hurricane_zone, line_of_business, n AS exposed_policies,
  round(e, 0) AS total_exposure, round(p, 0) AS total_premium,
  [8.0, 4.0, 2.0][z] AS expected_loss_ratio_pct, round(gross, 0) AS expected_gross_loss,
  round(gross * CAST(0.7 AS DECIMAL(2,1)), 0) AS expected_net_loss,
  {_over("gross", "p", 2)} AS loss_to_premium_ratio,
  {_over("gross * CAST(0.7 AS DECIMAL(2,1))", "e", 4)} AS net_loss_ratio
FROM (
  SELECT z, line_of_business, count(*) AS n, sum(sum_insured) AS e, sum(premium) AS p,
    CAST(sum(sum_insured) AS DECIMAL(28,2)) * CAST([0.08, 0.04, 0.02][z] AS DECIMAL(3,2)) AS gross
  FROM ({zone}) WHERE z IS NOT NULL GROUP BY z, line_of_business
)
""",
        ),
        "hurricane_states": _typed(
            "geography:s total_exposure:d",
            f"""
SELECT geography, sum(sum_insured) AS total_exposure
FROM {exposed} AND geography IN ('FL', 'TX', 'LA') GROUP BY geography
""",
        ),
        "cat_monitor": _typed(
            "event_code:s geography:s line_of_business:s claim_count:i total_incurred:d total_paid:d "
            "total_outstanding:d avg_claim_severity:d max_claim_severity:d payment_ratio:d "
            "min_days_since_event:d max_days_since_event:d development_status:s",
            f"""
SELECT *, CASE WHEN payment_ratio > 0.5 THEN 'Fast Development'
  WHEN payment_ratio > 0.2 THEN 'Normal Development' ELSE 'Slow Development' END AS development_status
FROM (
  SELECT 'CAT_2024_001' AS event_code, geography, line_of_business, count(*) AS claim_count,
    round(sum(incurred_amount), 0) AS total_incurred, round(sum(paid_amount), 0) AS total_paid,
    round(sum(outstanding_reserve), 0) AS total_outstanding,
    {_over("sum(incurred_amount)", "count(*)", 0)} AS avg_claim_severity,
    round(max(incurred_amount), 0) AS max_claim_severity,
    {_over("sum(paid_amount)", "sum(incurred_amount)", 4)} AS payment_ratio,
    min(DATE '2001-11-05' - accident_date) AS min_days_since_event,
    max(DATE '2001-11-05' - accident_date) AS max_days_since_event
  FROM claims
  WHERE accident_date >= DATE '2001-01-01'
    AND (catastrophe OR (incurred_amount > 90000 AND geography IN ('FL', 'TX', 'LA')))
  GROUP BY 2, 3
)
""",
        ),
        "stress_test": _typed(
            "scenario_name:s loss_ratio_pct:d exposed_policies:i exposed_sum_insured:d exposed_premium:d "
            "estimated_gross_loss:d estimated_net_loss:d loss_to_premium_ratio:d exposure_concentration:d",
            f"""
WITH scenarios(scenario_name, lr, states) AS (
  VALUES ('Major Hurricane', CAST(0.12 AS DECIMAL(4,2)), 'FL,TX,LA,NC,SC'),
    ('Widespread Tornado', CAST(0.06 AS DECIMAL(4,2)), 'TX,OK,KS,MO,IL'),
    ('California Earthquake', CAST(0.15 AS DECIMAL(4,2)), 'CA'),
    ('Northeast Winter Storm', CAST(0.04 AS DECIMAL(4,2)), 'NY,MA,CT,NJ,PA')
), hits AS (
  SELECT scenario_name, lr, count(*) FILTER (instr(states, geography) > 0) AS n,
    CAST(coalesce(sum(sum_insured) FILTER (instr(states, geography) > 0), 0) AS DECIMAL(28,2)) AS e,
    coalesce(sum(premium) FILTER (instr(states, geography) > 0), 0) AS p
  FROM scenarios CROSS JOIN (SELECT * FROM {exposed}) GROUP BY ALL
)
SELECT scenario_name, round(lr * 100, 1) AS loss_ratio_pct, n AS exposed_policies,
  round(e, 0) AS exposed_sum_insured, round(p, 0) AS exposed_premium,
  round(e * lr, 0) AS estimated_gross_loss,
  round(e * lr * CAST(0.75 AS DECIMAL(3,2)), 0) AS estimated_net_loss,
  {_over("e * lr", "p", 2)} AS loss_to_premium_ratio,
  {_over("e", "(SELECT sum(sum_insured) FROM policies)", 4)} AS exposure_concentration
FROM hits
""",
        ),
        "reinsurance": _typed(
            "scenario:s gross_loss:d reinsurance_recovery:d net_loss:d recovery_ratio:d "
            "net_retention_ratio:d impact_assessment:s",
            f"""
WITH layers(attachment, cap, rate) AS (
  VALUES (10000000, 40000000, CAST(0.85 AS DECIMAL(3,2))), (50000000, 50000000, 0.90),
    (100000000, 100000000, 0.95)
), losses AS (
  SELECT year(accident_date) || 'Q' || quarter(accident_date) AS scenario,
    CAST(sum(incurred_amount) AS DECIMAL(28,2)) AS gross
  FROM claims GROUP BY 1
), recovered AS (
  SELECT scenario, gross, sum(greatest(0, least(gross - attachment, cap)) * rate) AS r
  FROM losses CROSS JOIN layers GROUP BY ALL
)
SELECT scenario, round(gross, 0) AS gross_loss, round(r, 0) AS reinsurance_recovery,
  round(gross - r, 0) AS net_loss, {_over("r", "gross", 3)} AS recovery_ratio,
  {_over("gross - r", "gross", 3)} AS net_retention_ratio,
  CASE WHEN gross - r > 200000000 THEN 'Severe Impact' WHEN gross - r > 100000000 THEN 'Major Impact'
       WHEN gross - r > 50000000 THEN 'Moderate Impact' ELSE 'Manageable Impact' END AS impact_assessment
FROM recovered
""",
        ),
        "cat_dashboard": _typed(
            "total_policies_at_risk:i total_exposure_at_risk:d total_premium_cat_lines:d "
            "high_risk_policies:i high_risk_exposure:d high_risk_concentration:d available_reserves:d "
            "recent_cat_claims:i recent_cat_losses_30d:d reserve_adequacy_ratio:d "
            "financial_strength_status:s",
            f"""
WITH p AS (
  SELECT count(*) AS n, sum(sum_insured) AS e, sum(premium) AS pr,
    count(*) FILTER (geography IN ('FL', 'TX', 'LA', 'CA')) AS hn,
    coalesce(sum(sum_insured) FILTER (geography IN ('FL', 'TX', 'LA', 'CA')), 0) AS he
  FROM {exposed}
), c AS (
  SELECT sum(outstanding_reserve) FILTER (unsettled) AS res,
    count(*) FILTER (catastrophe AND accident_date >= DATE '2001-11-05' - 30) AS cn,
    coalesce(sum(incurred_amount) FILTER (catastrophe AND accident_date >= DATE '2001-11-05' - 30), 0)
      AS ci
  FROM claims
), s AS (
  SELECT *, CAST(res AS DOUBLE) / CAST(CAST(e AS DECIMAL(28,2)) * CAST(0.05 AS DECIMAL(3,2)) AS DOUBLE)
    AS strength
  FROM p, c
)
SELECT n AS total_policies_at_risk, round(e, 0) AS total_exposure_at_risk,
  round(pr, 0) AS total_premium_cat_lines, hn AS high_risk_policies, round(he, 0) AS high_risk_exposure,
  {_over("he", "e", 3)} AS high_risk_concentration, round(res, 0) AS available_reserves,
  cn AS recent_cat_claims, round(ci, 0) AS recent_cat_losses_30d,
  round(strength, 1) AS reserve_adequacy_ratio,
  CASE WHEN strength > 2.0 THEN 'Strong' WHEN strength > 1.0 THEN 'Adequate' ELSE 'Monitor Closely' END
    AS financial_strength_status
FROM s
""",
        ),
        "cat_profile": _typed(
            "policies_analyzed:i exposure_analyzed:d geographic_regions_analyzed:i recent_claims_analyzed:i",
            f"""
SELECT count(*) AS policies_analyzed, sum(sum_insured) AS exposure_analyzed,
  count(DISTINCT geography) AS geographic_regions_analyzed,
  (SELECT count(*) FROM claims WHERE accident_date >= DATE '2001-11-05' - 365) AS recent_claims_analyzed
FROM {exposed}
""",
        ),
    }


def _digests(rows: str, columns: str) -> str:
    """Known values and digest of each column of the rows."""
    parts = [
        f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS known, "
        f"CAST(coalesce(sum(CAST('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 12) AS BIGINT)), 0) AS VARCHAR) AS digest FROM arrived"
        for c in columns.split()
    ]
    return f"{FIXTURE}, arrived AS ({rows})\n" + "\nUNION ALL\n".join(parts)


def _columns() -> dict[str, str]:
    causes = " ".join(
        f"WHEN '{line}' THEN [{', '.join(repr(x) for x in names)}][l_suppkey % 5 + 1]" for line, names in A.CLAIM_CAUSES.items()
    )
    return {
        "load_policies_columns": _digests(
            """
SELECT *, 'POL' || printf('%08d', policy_id) AS policy_number, CAST(effective_date + 365 AS DATE) AS expiry_date,
  CASE line_of_business
    WHEN 'Motor' THEN '{"vehicle_age": ' || policy_id % 20 || '}'
    WHEN 'Property' THEN '{"flood_zone": "' || CASE WHEN policy_id % 10 < 7 THEN 'Low' WHEN policy_id % 10 < 9 THEN 'Medium' ELSE 'High' END || '"}'
    WHEN 'Life' THEN '{"smoker": ' || (policy_id % 20 < 3) || ', "health_rating": "'
      || CASE WHEN policy_id % 10 < 6 THEN 'Standard' WHEN policy_id % 10 < 9 THEN 'Preferred' ELSE 'Super Preferred' END || '"}'
    ELSE '{}' END AS risk_factors
FROM policies
""",
            "policy_id policy_number effective_date expiry_date line_of_business sum_insured premium geography customer_age "
            "customer_gender risk_factors",
        ),
        "load_claims_columns": _digests(
            f"""
SELECT l_orderkey * 8 + l_linenumber AS claim_id, 'CLM' || printf('%08d', l_orderkey * 8 + l_linenumber) AS claim_number,
  l_orderkey AS policy_id, accident_date, report_date, year(accident_date) AS accident_year,
  greatest(1, (year(report_date) - year(accident_date)) * 12 + month(report_date) - month(accident_date) + 1) AS development_month,
  lob AS line_of_business, geo AS geography, CASE lob {causes} END AS claim_cause,
  CASE WHEN incurred_amount - paid_amount <= 10 THEN 'Closed' WHEN incurred_amount - paid_amount <= 1000 THEN 'Open' ELSE 'Reserved' END
    AS claim_status,
  initial_reserve, paid_amount, CAST(incurred_amount - paid_amount AS DECIMAL(18,2)) AS outstanding_reserve, incurred_amount,
  '{{"complexity": "' || CASE WHEN l_partkey % 10 < 6 THEN 'Simple' WHEN l_partkey % 10 < 9 THEN 'Medium' ELSE 'Complex' END
    || '", "legal_involvement": ' || (l_suppkey % 10 = 0) || ', "catastrophe_related": ' || (l_partkey % 20 = 7) || '}}' AS claim_attributes
FROM settled LEFT JOIN described ON l_orderkey = o_orderkey
""",
            "claim_id claim_number policy_id accident_date report_date accident_year development_month line_of_business geography "
            "claim_cause claim_status initial_reserve paid_amount outstanding_reserve incurred_amount claim_attributes",
        ),
        "load_reserves_columns": _digests(
            """
SELECT * REPLACE (CAST(pv_factor AS DECIMAL(18,6)) AS pv_factor, CAST(coverage_units_current AS BIGINT) AS coverage_units_current,
  CAST(best_estimate_liability AS DECIMAL(18,2)) AS best_estimate_liability,
  CAST(liability_remaining_coverage AS DECIMAL(18,2)) AS liability_remaining_coverage)
FROM reserves
""",
            "contract_group_id line_of_business geography cohort_year valuation_date policy_count claim_count total_incurred total_paid "
            "total_outstanding pv_factor pv_claims pv_premiums risk_adjustment acquisition_costs initial_csm loss_component "
            "profitability_class coverage_units_total coverage_units_current csm_amortization best_estimate_liability "
            "liability_remaining_coverage reserve_adequacy_ratio",
        ),
    }


def _tables() -> dict[str, str]:
    def arrived(table: str, amount: str, day: str) -> str:
        return _typed(
            "line_of_business:s geography:s n:i amount:d first_day:s last_day:s",
            f"""
SELECT line_of_business, geography, count(*) AS n, sum({amount}) AS amount, min({day}) AS first_day,
  max({day}) AS last_day
FROM {table} GROUP BY 1, 2
""",
        )

    def rule(name: str, kind: str, expression: str) -> str:
        return _typed(
            f"accident_year:i {name}:{kind} claims:i incurred:d",
            f"""
SELECT accident_year, {expression} AS {name}, count(*) AS claims, sum(incurred_amount) AS incurred
FROM claims GROUP BY 1, 2
""",
        )

    def measures(columns: str) -> str:
        names = ", ".join(item.split(":")[0] for item in columns.split())
        return _typed(f"contract_group_id:s {columns}", f"SELECT contract_group_id, {names} FROM reserves")

    return {
        "verify_policies": _typed(
            "record_count:i earliest_policy:s latest_policy:s lob_count:i geography_count:i",
            """
SELECT count(*) AS record_count, min(effective_date) AS earliest_policy,
  max(effective_date) AS latest_policy, count(DISTINCT line_of_business) AS lob_count,
  count(DISTINCT geography) AS geography_count
FROM policies
""",
        ),
        "verify_claims": _typed(
            "total_claims:i earliest_accident:s latest_accident:s accident_years:i max_development_month:i",
            """
SELECT count(*) AS total_claims, min(accident_date) AS earliest_accident,
  max(accident_date) AS latest_accident, count(DISTINCT accident_year) AS accident_years,
  max(development_month) AS max_development_month
FROM claims
""",
        ),
        "table_counts": _typed(
            "policies_loaded:i claims_loaded:i reserves_loaded:i",
            """
SELECT (SELECT count(*) FROM policies) AS policies_loaded, (SELECT count(*) FROM claims) AS claims_loaded,
  (SELECT count(*) FROM reserves) AS reserves_loaded
""",
        ),
        "load_policies": arrived("policies", "sum_insured", "effective_date"),
        "load_claims": arrived("claims", "incurred_amount", "accident_date"),
        "load_claims_csv": arrived("claims", "incurred_amount", "accident_date"),
        "load_claims_retried": arrived("claims", "incurred_amount", "accident_date"),
        "load_policies_csv": arrived("policies", "sum_insured", "effective_date"),
        "load_reserves_csv": arrived("reserves", "pv_claims", "valuation_date"),
        "load_reserves": arrived("reserves", "pv_claims", "valuation_date"),
        "derive_dev_month": rule("month", "i", "greatest(1, development_month)"),
        "derive_claim_status": rule("status", "s", "claim_status"),
        "quarter_end": rule(
            "quarter_end",
            "s",
            "CAST(date_trunc('quarter', report_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)",
        ),
        "derive_outstanding": _typed(
            "accident_year:i outstanding:d largest_outstanding:d",
            """
SELECT accident_year, sum(greatest(incurred_amount - paid_amount, 0)) AS outstanding,
  max(greatest(incurred_amount - paid_amount, 0)) AS largest_outstanding
FROM claims GROUP BY 1
""",
        ),
        "contract_groups": _typed(
            "line_of_business:s geography:s cohort_year:i policy_count:i claim_count:i total_incurred:d "
            "total_paid:d total_outstanding:d contract_group_id:s",
            "SELECT * FROM grouped",
        ),
        "pv_measures": measures("pv_factor:d pv_claims:d pv_premiums:d"),
        "risk_and_acquisition": measures("risk_adjustment:d acquisition_costs:d"),
        "csm_split": measures("initial_csm:d loss_component:d profitability_class:s"),
        "csm_amortize": measures("coverage_units_total:i coverage_units_current:i csm_amortization:d"),
        "liabilities": measures(
            "best_estimate_liability:d liability_remaining_coverage:d reserve_adequacy_ratio:d"
        ),
        "reserve_metadata": _typed(
            "contract_group_id:s discount_rate:d risk_margin:d confidence_level:d valuation_method:s "
            "last_updated:s",
            """
SELECT contract_group_id, rate AS discount_rate,
  round(CAST(risk_adjustment AS DOUBLE) / greatest(1, CAST(pv_claims AS DOUBLE)), 4) AS risk_margin,
  confidence AS confidence_level, 'IFRS_17' AS valuation_method, valuation_date AS last_updated
FROM reserves
""",
        ),
    }


def _rollups() -> dict[str, str]:
    def triangle(paid: str, incurred: str) -> str:
        return _typed(
            "accident_year:i development_month:i line_of_business:s geography:s "
            f"{paid}:d {incurred}:d total_outstanding:d claim_count:i",
            f"""
SELECT accident_year, development_month, line_of_business, geography, sum(paid_amount) AS {paid},
  sum(incurred_amount) AS {incurred}, sum(outstanding_reserve) AS total_outstanding,
  count(*) AS claim_count
FROM claims GROUP BY 1, 2, 3, 4
""",
        )

    monthly = _typed(
        "accident_month:i line_of_business:s geography:s claim_status:s claim_count:i total_incurred:d "
        "total_paid:d avg_report_delay:d",
        f"""
SELECT year(accident_date) * 100 + month(accident_date) AS accident_month, line_of_business, geography,
  claim_status, count(*) AS claim_count, sum(incurred_amount) AS total_incurred,
  sum(paid_amount) AS total_paid, {_over("sum(report_date - accident_date)", "count(*)")} AS avg_report_delay
FROM claims GROUP BY 1, 2, 3, 4
""",
    )
    daily = _typed(
        "line_of_business:s geography:s effective_date:s policy_count:i total_sum_insured:d "
        "total_premium:d avg_customer_age:d",
        f"""
SELECT line_of_business, geography, effective_date, count(*) AS policy_count,
  sum(sum_insured) AS total_sum_insured, sum(premium) AS total_premium,
  {_over("sum(customer_age)", "count(*)")} AS avg_customer_age
FROM policies GROUP BY 1, 2, 3
""",
    )
    csm = _typed(
        "valuation_date:s line_of_business:s geography:s profitability_class:s opening_csm:d "
        "period_amortization:d closing_csm:d contract_group_count:i",
        """
SELECT valuation_date, line_of_business, geography, profitability_class, sum(initial_csm) AS opening_csm,
  sum(csm_amortization) AS period_amortization, sum(initial_csm) - sum(csm_amortization) AS closing_csm,
  count(*) AS contract_group_count
FROM reserves GROUP BY 1, 2, 3, 4
""",
        HISTORY,
    )
    latest = _typed(
        "line_of_business:s geography:s cohort_year:i latest_valuation:s latest_adequacy_ratio:d "
        "latest_outstanding:d latest_pv_claims:d valuation_count:i",
        """
SELECT line_of_business, geography, cohort_year, valuation_date AS latest_valuation,
  reserve_adequacy_ratio AS latest_adequacy_ratio, total_outstanding AS latest_outstanding, pv_claims AS latest_pv_claims,
  count(*) OVER (PARTITION BY line_of_business, geography, cohort_year) AS valuation_count
FROM reserves
QUALIFY row_number() OVER (PARTITION BY line_of_business, geography, cohort_year
  ORDER BY valuation_date DESC, reserve_adequacy_ratio DESC, total_outstanding DESC, pv_claims DESC) = 1
""",
        HISTORY,
    )
    active = f"""{FIXTURE}
SELECT CAST(accident_year AS BIGINT) AS accident_year, line_of_business, geography, count(*) AS claim_count,
  count(DISTINCT policy_id) AS policy_count, true AS estimate_agrees
FROM claims GROUP BY 1, 2, 3
"""
    return {
        "rollup_triangle_proj": triangle("cumulative_paid", "cumulative_incurred"),
        "rollup_triangle": triangle("total_paid", "total_incurred"),
        "stream_triangle": triangle("total_paid", "total_incurred"),
        "rollup_monthly_claims": monthly,
        "stream_monthly_claims": monthly,
        "rollup_policy_geo": _typed(
            "geography:s line_of_business:s policy_year:i policy_count:i total_exposure:d total_premium:d",
            """
SELECT geography, line_of_business, year(effective_date) AS policy_year, count(*) AS policy_count,
  sum(sum_insured) AS total_exposure, sum(premium) AS total_premium
FROM policies GROUP BY 1, 2, 3
""",
        ),
        "rollup_policy_daily": daily,
        "stream_policy_daily": daily,
        "rollup_ifrs17": _typed(
            "line_of_business:s profitability_class:s reporting_year:i total_csm:d total_loss_component:d "
            "total_lrc:d total_bel:d total_risk_adjustment:d",
            """
SELECT line_of_business, profitability_class, year(valuation_date) AS reporting_year,
  sum(initial_csm) AS total_csm, sum(loss_component) AS total_loss_component,
  sum(liability_remaining_coverage) AS total_lrc, sum(best_estimate_liability) AS total_bel,
  sum(risk_adjustment) AS total_risk_adjustment
FROM reserves GROUP BY 1, 2, 3
""",
        ),
        "rollup_csm_movements": csm,
        "stream_csm": csm,
        "reserve_latest": latest,
        "stream_reserve_latest": latest,
        "rollup_active_policies": active,
        "stream_active_policies": active,
    }


def statements() -> dict[str, str]:
    made = {
        **_triangles(),
        **_mortality(),
        **_reserving(),
        **_ifrs17(),
        **_catastrophe(),
        **_tables(),
        **_columns(),
        **_rollups(),
    }
    # The queries on stored tables say the same as those on the raw ones.
    stored = {
        "tri_stored": "tri_basic",
        "tri_by_lob_stored": "tri_by_lob",
        "dev_factors_stored": "dev_factors",
        "tri_rolled": "tri_basic",
        "tri_arrays_rolled": "tri_arrays",
        "tri_by_lob_rolled": "tri_by_lob",
        "dev_factors_rolled": "dev_factors",
        "verify_claims_footers": "verify_claims",
        "table_counts_footers": "table_counts",
        "stream_triangle_state": "stream_triangle",
        "stream_monthly_claims_state": "stream_monthly_claims",
        "stream_reserve_latest_state": "stream_reserve_latest",
        "ifrs_summary_stored": "ifrs_summary",
        "csm_movements_stored": "csm_movements",
        "contract_groups_bucketed": "contract_groups",
    }
    return made | {name: made[same] for name, same in stored.items()}
