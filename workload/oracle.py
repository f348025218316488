"""DuckDB SQL that recomputes every query from the given parquet tables.

Written apart from the Spark plans: one chain of common table expressions from
orders to the KPI table, and a final SELECT per query. Decimals leave as DOUBLE;
quotients are rounded half up in integer arithmetic first.
"""

from __future__ import annotations

from tidemark.functions.rules import CATEGORIES
from tidemark.plans.dashboard import GRADIENT, MALE_FEMALE, URBAN_RURAL
from workload.derived import (
    MANY_DECIMALS,
    MANY_DIGITS,
    NAMES,
    PARAMS,
    TINY,
    TOO_LONG,
)

P = PARAMS
UNIT = 10**12  # values have twelve decimals

# Texts read as NULL.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def listed(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def exact_double(x: str, digits: int) -> str:
    """An integer number of 10**-digits as the DOUBLE next to it."""
    scale = 10**digits
    text = f"(abs({x}) // {scale}) || '.' || lpad((abs({x}) % {scale})::VARCHAR, {digits}, '0')"
    return f"(CASE WHEN ({x}) < 0 THEN '-' ELSE '' END || {text})::DOUBLE"


def half_up_units(num: str, den: str, digits: int) -> str:
    """num / den in 10**-digits, rounded half away from zero; den is positive."""
    scale = 10**digits
    size = f"(2 * abs({num}) * {scale} + {den}) // (2 * {den})"
    return f"(CASE WHEN {num} < 0 THEN -1 ELSE 1 END * ({size}))"


def half_up(num: str, den: str, digits: int) -> str:
    return exact_double(half_up_units(num, den, digits), digits)


def units(x: str) -> str:
    """A value as an integer number of 10**-12."""
    return f"replace(({x})::DECIMAL(38,12)::VARCHAR, '.', '')::HUGEINT"


def double(x: str) -> str:
    return f"({x})::VARCHAR::DOUBLE"


def avg_of(x: str, digits: int) -> str:
    """Rounded average of a value; NULL over no values."""
    quotient = half_up(f"sum({units(x)})", f"(count({x}) * {UNIT}::HUGEINT)", digits)
    return f"CASE WHEN count({x}) > 0 THEN {quotient} END"


def avg_pct(digits: int) -> str:
    quotient = half_up("sum(pct)", "(count(pct) * 100)::HUGEINT", digits)
    return f"CASE WHEN count(pct) > 0 THEN {quotient} END"


def avg_int(x: str, digits: int) -> str:
    return half_up(f"sum({x})::HUGEINT", f"count({x})::HUGEINT", digits)


def hundredths(x: str) -> str:
    return f"printf('%d.%02d', ({x}) // 100, ({x}) % 100)"


def number(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({x}), '[0-9.]+')"
        f" THEN TRY_CAST(trim({x}) AS DECIMAL(32,12)) END"
    )


def broken(x: str) -> str:
    """Digits and dots that are no number, too long, or not zero beyond twelve decimals."""
    return (
        f"coalesce(regexp_full_match(trim({x}), '[0-9.]+') AND ({number(x)} IS NULL"
        f" OR regexp_matches({x}, '\\.[0-9]{{12}}[0-9]*[1-9]')), false)"
    )


def piece(part: int) -> str:
    return f"split_part(translate(value_ci, '[]', ''), '-', {part})"


def bound(part: int) -> str:
    return f"CASE WHEN value_ci LIKE '%[%]%' THEN {number(piece(part))} END"


def labels(column: str, known: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in known.items())
    return f"CASE {column} {arms} ELSE {title(column)} END"


def title(x: str) -> str:
    words = f"regexp_extract_all({x}, '[A-Za-z0-9]+|[^A-Za-z0-9]+')"
    return (
        f"array_to_string(list_transform({words},"
        " lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


def any_word(name: str, *words: str) -> str:
    return "(" + " OR ".join(f"contains(lower({name}), '{w}')" for w in words) + ")"


YEAR = (
    "CASE WHEN regexp_full_match(period, '[0-9]{4}(-[0-9]{4})?')"
    " THEN left(period, 4)::INTEGER END"
)
VALUE = f"coalesce({number('value_numeric')}, {number('value')})"
MISSING = f"(({VALUE}) IS NULL OR coalesce(trim(value), '') = '')"
ISSUE = f"(value_numeric IS NULL AND ({VALUE}) IS NOT NULL)"
SEX = "trim(lower(coalesce(sex, 'both')))"
RESIDENCE = "trim(lower(coalesce(residence, 'total')))"
WEALTH = "trim(lower(coalesce(wealth_quintile, 'total')))"


def category(name: str) -> str:
    return f"""CASE
        WHEN {any_word(name, "stunting")} THEN 'Stunting'
        WHEN {any_word(name, "wasting")} THEN 'Wasting'
        WHEN {any_word(name, "underweight")} THEN 'Underweight'
        WHEN {any_word(name, "anaemia")} AND {any_word(name, "child")} THEN 'Anaemia'
        WHEN {any_word(name, "mortality")} AND {any_word(name, "under")} THEN 'Mortality'
        WHEN {any_word(name, "immunization", "vaccine")} THEN 'Immunization'
        ELSE 'Other' END"""


def severity(name: str) -> str:
    return f"""CASE WHEN {any_word(name, "severe")} THEN 'Severe'
        WHEN {any_word(name, "moderate")} THEN 'Moderate' ELSE 'Overall' END"""


def scope(name: str) -> str:
    single = any_word(
        name, "child", "stunting", "wasting", "underweight", "under-5", "under 5",
        "anaemia",
    )
    return f"({single} OR ({any_word(name, 'mortality')} AND {any_word(name, 'under')}))"


def band(gap: str) -> str:
    return f"""CASE WHEN abs({gap}) >= 10 THEN 'Large disparity'
        WHEN abs({gap}) >= 5 THEN 'Moderate disparity'
        WHEN abs({gap}) >= 1 THEN 'Small disparity'
        WHEN {gap} IS NOT NULL THEN 'Minimal disparity'
        ELSE 'No data' END"""


# name -> body, each using only names above it.
CTES: dict[str, str] = {}

CTES["base"] = """
SELECT o_orderkey AS k, year(o_orderdate)::INTEGER AS y,
       round(o_totalprice * 100)::BIGINT // 5000 AS h,
       o_orderpriority AS priority, o_orderstatus AS status,
       c_mktsegment AS segment, n_nationkey % 7 AS quintile, r_name
FROM orders
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey"""

CTES["raw"] = f"""
SELECT CASE priority WHEN '1-URGENT' THEN 'Severe ' WHEN '2-HIGH' THEN 'Moderate ' ELSE '' END
           || [{listed(NAMES)}][k % 8 + 1] AS indicator,
       if(k % 89 = 0, '#indicator+code', 'IND' || k % 8) AS indicator_code,
       r_name AS location,
       CASE WHEN r_name IN ('AFRICA', 'ASIA') THEN 'KEN'
            WHEN r_name = 'EUROPE' THEN ' KEN ' ELSE 'XXX' END AS location_code,
       CASE WHEN k % 97 = 0 THEN 'n/a' WHEN k % 10 = 0 THEN y || '-' || (y + 1)
            ELSE y::VARCHAR END AS period,
       CASE status WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Male' END AS sex,
       CASE segment WHEN 'AUTOMOBILE' THEN 'Urban' WHEN 'BUILDING' THEN 'Rural' END
           AS residence,
       if(quintile BETWEEN 1 AND 5, 'Q' || quintile, NULL) AS wealth_quintile,
       CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 'No data'
            WHEN k % 37 = 0 THEN '{MANY_DIGITS}' || {hundredths("h")}
            WHEN k % 41 = 0 THEN {hundredths("h")} || '{MANY_DECIMALS}'
            WHEN k % 43 = 0 THEN '{TINY}' || k % 10
            WHEN k % 211 = 0 THEN '{TOO_LONG}'
            ELSE {hundredths("h")} END AS value_numeric,
       CASE WHEN k % 17 = 0 THEN '' WHEN k % 143 = 0 THEN '1.2.3'
            ELSE {hundredths("h")} END AS value,
       CASE WHEN k % 7 = 0 THEN NULL WHEN k % 223 = 0 THEN '[1.2.3-4]'
            WHEN k % 227 = 0 THEN '[5-{TOO_LONG}]'
            WHEN k % 229 = 0 THEN '[0.5-7.5{MANY_DECIMALS}0001]' ELSE
           if(k % 19 = 0, {hundredths("h")} || ' ', '')
           || '[' || {hundredths("h * 8 // 10")} || '-'
           || {hundredths("h * 12 // 10")} || ']' END AS value_ci,
       k AS src_key
FROM base"""

CTES["numbered"] = """
SELECT *, row_number() OVER (ORDER BY indicator NULLS LAST, location NULLS LAST,
                             period NULLS LAST, src_key) AS indicator_id
FROM raw WHERE indicator_code <> '#indicator+code'"""

CTES["staged"] = f"""
SELECT indicator_id, trim(indicator) AS indicator_name,
       trim(indicator_code) AS indicator_code, trim(location) AS location,
       trim(location_code) AS location_code, trim(period) AS period,
       {YEAR} AS year, {SEX} AS sex, {RESIDENCE} AS residence,
       {WEALTH} AS wealth_quintile, {VALUE} AS value,
       {bound(1)} AS value_lower_ci, {bound(2)} AS value_upper_ci,
       {MISSING} AS is_missing_value, {ISSUE} AS has_data_quality_issue
FROM numbered
WHERE trim(location_code) = '{P.focus_location}' AND {YEAR} IS NOT NULL
  AND indicator IS NOT NULL"""

CTES["classified"] = f"""
SELECT indicator_id, indicator_name, indicator_code, year,
       {category("indicator_name")} AS indicator_category,
       {severity("indicator_name")} AS severity_level,
       sex, residence, wealth_quintile, value AS indicator_value,
       value_lower_ci, value_upper_ci, value_upper_ci - value_lower_ci AS ci_width,
       is_missing_value, has_data_quality_issue,
       CASE WHEN is_missing_value THEN 0 WHEN has_data_quality_issue THEN 50
            WHEN value_upper_ci IS NULL OR value_lower_ci IS NULL THEN 70
            WHEN value_upper_ci - value_lower_ci > 20 THEN 80
            ELSE 100 END AS data_quality_score
FROM staged
WHERE {scope("indicator_name")} AND indicator_category <> 'Other'"""

CTES["lagged"] = f"""
SELECT *, lag(indicator_value) OVER series AS prev, lag(year) OVER series AS prev_year,
       {units("indicator_value - prev")} AS n, {units("prev")} AS d
FROM classified WHERE indicator_value IS NOT NULL
WINDOW series AS (PARTITION BY indicator_name, sex, residence, wealth_quintile
                  ORDER BY year, indicator_id)"""

CTES["changed"] = f"""
SELECT *, indicator_value - prev AS absolute_change,
       CASE WHEN d <> 0 THEN {half_up_units("n * 100", "d", 2)} END AS pct,
       CASE WHEN d <> 0 THEN {half_up("n * 100", "d", 2)} END AS percentage_change,
       CASE WHEN prev IS NULL THEN 'No baseline' WHEN n > 0 THEN 'Increasing'
            WHEN n < 0 THEN 'Decreasing' ELSE 'Stable' END AS trend_direction,
       coalesce(d <> 0 AND abs(n) * 10 >= d, false) AS is_significant_change
FROM lagged"""

CTES["times"] = f"""
SELECT year, year // 10 * 10::BIGINT AS decade_start,
       year // 10 * 10::BIGINT + 9 AS decade_end,
       year // 10 * 10 || 's' AS decade_label,
       year // 5 * 5::BIGINT AS five_year_period_start,
       year // 5 * 5::BIGINT + 4 AS five_year_period_end,
       ({P.current_year} - year)::INTEGER AS years_ago,
       CASE WHEN years_ago = 0 THEN 'Current year' WHEN years_ago = 1 THEN 'Last year'
            WHEN years_ago <= 5 THEN 'Recent (5 years)'
            WHEN years_ago <= 10 THEN 'Medium term (10 years)'
            ELSE 'Historical (>10 years)' END AS time_category,
       years_ago = 0 AS is_current_year, years_ago <= 5 AS is_recent_5y,
       years_ago <= 10 AS is_recent_10y
FROM (SELECT DISTINCT year FROM staged)"""

CTES["people"] = f"""
SELECT row_number() OVER (ORDER BY sex, residence, wealth_quintile) AS demographic_key,
       sex, residence, wealth_quintile,
       {labels("sex", {"male": "Male", "female": "Female", "both": "Both Sexes"})}
           AS sex_label,
       {labels("residence", {"urban": "Urban", "rural": "Rural", "total": "All Areas"})}
           AS residence_label,
       {labels("wealth_quintile", {
           "q1": "Poorest (Q1)", "q2": "Second Quintile (Q2)",
           "q3": "Middle Quintile (Q3)", "q4": "Fourth Quintile (Q4)",
           "q5": "Richest (Q5)", "total": "All Wealth Groups"})}
           AS wealth_quintile_label,
       sex = 'both' AS is_total_sex, residence = 'total' AS is_total_residence,
       wealth_quintile = 'total' AS is_total_wealth,
       is_total_sex AND is_total_residence AND is_total_wealth AS is_total_population,
       wealth_quintile IN ('q1', 'q2') AS is_low_wealth, residence = 'rural' AS is_rural
FROM (SELECT DISTINCT sex, residence, wealth_quintile FROM staged)"""

CTES["facts"] = """
SELECT row_number() OVER (ORDER BY c.year, c.indicator_name, c.sex, c.residence,
                          c.wealth_quintile, c.indicator_id) AS fact_key,
       t.year AS time_key, p.demographic_key, c.indicator_id, c.indicator_name,
       c.indicator_code, c.indicator_category, c.severity_level, c.indicator_value,
       c.value_lower_ci, c.value_upper_ci, c.ci_width, c.prev AS previous_year_value,
       c.absolute_change, c.percentage_change, c.trend_direction,
       c.is_significant_change, c.is_missing_value, c.has_data_quality_issue,
       c.data_quality_score, c.pct
FROM changed c
LEFT JOIN people p USING (sex, residence, wealth_quintile)
LEFT JOIN times t ON t.year = c.year"""

CTES["star"] = """
SELECT * FROM facts JOIN times ON times.year = facts.time_key
JOIN people USING (demographic_key)"""

CTES["subgroups"] = f"""
SELECT indicator_category, sex_label, residence_label, wealth_quintile_label,
       {avg_of("indicator_value", 2)} AS avg_indicator_value,
       {half_up(units("min(indicator_value)"), f"{UNIT}::HUGEINT", 2)} AS min_indicator_value,
       {half_up(units("max(indicator_value)"), f"{UNIT}::HUGEINT", 2)} AS max_indicator_value,
       {half_up(units("max(indicator_value) - min(indicator_value)"), f"{UNIT}::HUGEINT", 2)}
           AS value_range,
       {avg_pct(4)} AS avg_percentage_change,
       count(*) AS measurement_count, max(year) AS most_recent_year,
       bool_or(is_low_wealth) AS includes_low_wealth, bool_or(is_rural) AS includes_rural
FROM star WHERE is_recent_5y GROUP BY ALL"""

CTES["gaps"] = """
SELECT indicator_category, year, sex_label,
       max(indicator_value) FILTER (residence_label = 'Urban') AS urban_value,
       max(indicator_value) FILTER (residence_label = 'Rural') AS rural_value,
       urban_value - rural_value AS urban_rural_gap
FROM star WHERE is_recent_5y AND wealth_quintile_label = 'All Wealth Groups'
GROUP BY ALL HAVING urban_rural_gap IS NOT NULL"""

CTES["kpi"] = f"""
SELECT s.*, g.urban_value, g.rural_value, g.urban_rural_gap,
       {band("g.urban_rural_gap")} AS disparity_level
FROM subgroups s LEFT JOIN gaps g ON g.indicator_category = s.indicator_category
 AND g.sex_label = s.sex_label AND g.year = s.most_recent_year"""


def with_ctes(select: str) -> str:
    chain = ",\n".join(f"{name} AS ({body})" for name, body in CTES.items())
    return f"WITH {chain}\n{select}"


DECIMALS = (
    "value", "value_lower_ci", "value_upper_ci", "ci_width", "indicator_value",
    "current_value", "previous_year_value", "absolute_change", "percentage_change",
    "urban_value", "rural_value", "urban_rural_gap",
)


def all_of(table: str, *decimals: str, rename: str = "") -> str:
    """SELECT * with the named decimals as DOUBLE."""
    casts = ", ".join(f"{double(d)} AS {d}" for d in decimals)
    return f"SELECT * REPLACE ({casts}) FROM {table}"


STG = all_of("staged", "value", "value_lower_ci", "value_upper_ci")
CLASSIFIED = all_of(
    "classified", "indicator_value", "value_lower_ci", "value_upper_ci", "ci_width"
)
FACT = all_of(
    "(SELECT * EXCLUDE (pct) FROM facts)", "indicator_value", "value_lower_ci", "value_upper_ci", "ci_width",
    "previous_year_value", "absolute_change",
)
YOY = """
SELECT indicator_id, indicator_name, indicator_category, severity_level, year,
       prev_year AS previous_year, (year - prev_year)::INTEGER AS years_gap, sex,
       residence, wealth_quintile, indicator_value::VARCHAR::DOUBLE AS current_value,
       prev::VARCHAR::DOUBLE AS previous_year_value, absolute_change::VARCHAR::DOUBLE AS absolute_change,
       percentage_change, trend_direction, is_significant_change, data_quality_score
FROM changed"""


def check(name: str, table: str, column: str, source: str, failing: str) -> str:
    return f"""SELECT '{name}' AS "check", '{table}' AS "table", '{column}' AS "column",
    if(bad = 0, 'pass', 'fail') AS status, bad::BIGINT AS failing_rows,
    total::BIGINT AS total_rows
    FROM (SELECT ({failing}) AS bad, (SELECT count(*) FROM {source}) AS total)"""


def nulls(source: str, column: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {column} IS NULL"


def repeats(source: str, column: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL"
        f" GROUP BY 1 HAVING count(*) > 1)"
    )


def orphans(source: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT count(*) FROM {source} WHERE {column} IS NOT NULL"
        f" AND {column} NOT IN (SELECT {key} FROM {parent})"
    )


def suite() -> str:
    names = {
        "stg_observations": "staged", "int_classified": "classified",
        "fact_observations": "facts", "dim_time": "times",
        "dim_demographics": "people", "mart_kpi_summary": "kpi",
    }
    filled = [
        ("stg_observations", "indicator_id"), ("stg_observations", "year"),
        ("int_classified", "indicator_category"), ("int_classified", "data_quality_score"),
        ("fact_observations", "fact_key"), ("fact_observations", "time_key"),
        ("dim_time", "year"), ("dim_demographics", "demographic_key"),
        ("mart_kpi_summary", "indicator_category"),
    ]
    keys = [
        ("stg_observations", "indicator_id"), ("fact_observations", "fact_key"),
        ("dim_time", "year"), ("dim_demographics", "demographic_key"),
    ]
    parts = [check("not_null", t, c, names[t], nulls(names[t], c)) for t, c in filled]
    parts += [check("unique", t, c, names[t], repeats(names[t], c)) for t, c in keys]
    parts.append(
        check(
            "accepted_values", "int_classified", "indicator_category", "classified",
            f"SELECT count(*) FROM classified"
            f" WHERE indicator_category NOT IN ({listed(CATEGORIES)})",
        )
    )
    for column, parent, key in (
        ("time_key", "times", "year"),
        ("demographic_key", "people", "demographic_key"),
    ):
        parts.append(
            check("relationships", "fact_observations", column, "facts",
                  orphans("facts", column, parent, key))
        )
    return " UNION ALL ".join(parts)


TOKENS = [*NULL_TOKENS, "12.5", "none", "Kenya"]
MEAN = avg_of("indicator_value", 4)
TOTAL = "is_total_population"

SELECTS: dict[str, str] = {
    # sources and sinks
    "src_csv": f"""SELECT * REPLACE (if(period IN ({listed(NULL_TOKENS)}), NULL, period)
        AS period, if(value IN ({listed(NULL_TOKENS)}), NULL, value) AS value) FROM raw""",
    "src_csv_breaks": f"""SELECT src_key, if(period IN ({listed(NULL_TOKENS)}), NULL, period)
        AS period, CASE src_key % 5 WHEN 0 THEN indicator || chr(10)
          WHEN 1 THEN '"' || chr(10) || ',' || indicator
          WHEN 2 THEN indicator || chr(13) || chr(10) || '"",' || chr(10) || chr(10) || '"'
            || indicator ELSE indicator END AS note FROM raw""",
    "inferred_types": """SELECT src_key, src_key::VARCHAR AS spelt, src_key::VARCHAR AS padded,
        (src_key // 2) || CASE src_key % 2 WHEN 1 THEN '.5' ELSE '' END AS halves,
        CASE WHEN src_key < 999 THEN (src_key + 1) || repeat('0', 12)
          ELSE rtrim(rtrim(left((src_key + 1)::VARCHAR, 1) || '.' || substr((src_key + 1)::VARCHAR, 2), '0'), '.')
            || 'e+' || (11 + length((src_key + 1)::VARCHAR)) END AS large,
        CASE src_key % 2 WHEN 1 THEN 'true' ELSE 'false' END AS truth,
        CASE WHEN src_key % 1000 = 999 THEN 'n/k' WHEN src_key % 4 = 0 THEN src_key || 'e0'
          WHEN src_key % 4 = 1 THEN src_key || '.0' WHEN src_key % 4 = 2 THEN ' +' || src_key
          ELSE src_key::VARCHAR END AS mixed,
        CASE src_key % 2 WHEN 1 THEN src_key::VARCHAR END AS holes,
        CASE src_key % 2 WHEN 1 THEN 'true' END AS truth_holes FROM raw""",
    "null_tokens": f"""SELECT src_key, if(period = 'n/a', NULL, period) AS period,
        if([{listed(TOKENS)}][src_key % {len(TOKENS)} + 1] IN ({listed(NULL_TOKENS)}),
           NULL, [{listed(TOKENS)}][src_key % {len(TOKENS)} + 1]) AS token FROM raw""",
    "bad_rows": """SELECT src_key, 
        if(src_key % 101 = 0 OR src_key % 107 = 0, 'rejected', 'kept') AS fate,
        indicator_code,
        if(src_key % 103 = 0 AND src_key % 101 <> 0 AND src_key % 107 <> 0, NULL, location)
        AS location FROM raw""",
    "normalize_headers": """SELECT src_key, indicator_code, value_ci,
        value_numeric AS valuenumeric, value, location AS value1 FROM raw""",
    "audit_columns": "SELECT src_key, 'derived.csv' AS source_file FROM raw",
    "sink_roundtrip": STG,
    "ingest_metrics": """SELECT count(*) AS rows_read,
        count(*) FILTER (src_key % 101 <> 0 AND src_key % 107 <> 0) AS rows_loaded,
        count(*) FILTER (src_key % 101 = 0 OR src_key % 107 = 0) AS rows_rejected,
        5::INTEGER AS columns_loaded FROM raw""",
    "typed_seed_long": """SELECT src_key,
        if(period = 'n/a' AND fate = 'kept', NULL, period) AS period,
        CASE WHEN fate = 'kept'
             THEN TRY_CAST(value_numeric AS DECIMAL(32,12))::VARCHAR::DOUBLE END AS number,
        CASE WHEN fate = 'kept' THEN printf('[%d.000000000000-%d.000000000000]',
             src_key % 7, src_key % 9) END AS value_ci, fate
        FROM (SELECT *, if(src_key % 101 = 0, 'rejected', 'kept') AS fate FROM raw)""",
    "header_order": """SELECT 'same' AS folder, count(*) AS rows_read FROM raw
        UNION ALL SELECT 'other', NULL""",
    "typed_seed": """SELECT src_key, if(period = 'n/a', NULL, period) AS "YEAR (DISPLAY)",
        TRY_CAST(value_numeric AS DECIMAL(32,12))::VARCHAR::DOUBLE AS "Numeric",
        TRY_CAST(value AS DECIMAL(32,12))::VARCHAR::DOUBLE AS "Low",
        TRY_CAST(split_part(value_ci, ' ', 1) AS DECIMAL(32,12))::VARCHAR::DOUBLE AS "High"
        FROM raw""",
    # row expressions
    "drop_tag_rows": """SELECT src_key, indicator_code FROM raw
        WHERE indicator_code <> '#indicator+code'""",
    "surrogate_key": "SELECT src_key, indicator_id FROM numbered",
    "clean_text": """SELECT src_key, trim(indicator) AS indicator_name,
        trim(indicator_code) AS indicator_code, trim(location) AS location,
        trim(location_code) AS location_code, trim(period) AS period FROM raw""",
    "default_dims": f"""SELECT src_key, {SEX} AS sex, {RESIDENCE} AS residence,
        {WEALTH} AS wealth_quintile FROM raw""",
    "parse_period": f"SELECT src_key, {YEAR} AS year FROM raw",
    "parse_value": f"SELECT src_key, ({VALUE})::VARCHAR::DOUBLE AS value FROM raw",
    "parse_ci": f"""SELECT src_key, ({bound(1)})::VARCHAR::DOUBLE AS value_lower_ci,
        ({bound(2)})::VARCHAR::DOUBLE AS value_upper_ci FROM raw""",
    "quality_flags": f"""SELECT src_key, {MISSING} AS is_missing_value,
        {ISSUE} AS has_data_quality_issue FROM raw""",
    "quarantine": f"""SELECT src_key, value_numeric, value, value_ci FROM raw
        WHERE indicator_code <> '#indicator+code' AND ({broken("value_numeric")}
          OR {broken("value")} OR (value_ci LIKE '%[%]%'
          AND ({broken(piece(1))} OR {broken(piece(2))})))""",
    "title_case": f"""SELECT o_orderkey, {title("lower(o_orderpriority)")} AS label
        FROM orders""",
    "scope_filter": f"""SELECT src_key, indicator FROM raw WHERE {scope("indicator")}""",
    "classify_category": f"""SELECT src_key, {category("indicator")}
        AS indicator_category FROM raw""",
    "classify_severity": f"""SELECT src_key, {severity("indicator")}
        AS severity_level FROM raw""",
    "ci_width": "SELECT indicator_id, ci_width::VARCHAR::DOUBLE AS ci_width FROM classified",
    "quality_score": "SELECT indicator_id, data_quality_score FROM classified",
    # models
    "stg_observations": STG,
    "int_classified": CLASSIFIED,
    "int_classified_by_name": CLASSIFIED,
    "yoy_changes": YOY,
    "yoy_changes_hot": YOY,
    "yoy_ordered": YOY,
    "dim_time": "SELECT * FROM times",
    "dim_demographics": "SELECT * FROM people",
    "fact_observations": FACT,
    "fact_yoy_join": """SELECT c.indicator_id, c.year, c.sex, c.residence,
        c.wealth_quintile, c.indicator_value::VARCHAR::DOUBLE AS indicator_value,
        y.prev::VARCHAR::DOUBLE AS previous_year_value,
        y.absolute_change::VARCHAR::DOUBLE AS absolute_change, y.percentage_change,
        y.trend_direction, y.is_significant_change
        FROM classified c LEFT JOIN changed y
        USING (indicator_id, year, sex, residence, wealth_quintile)
        WHERE c.indicator_value IS NOT NULL""",
    "mart_kpi_summary": all_of("kpi", "urban_value", "rural_value", "urban_rural_gap"),
    "distinct_years": "SELECT DISTINCT year FROM staged",
    "distinct_triples": "SELECT DISTINCT sex, residence, wealth_quintile FROM staged",
    "star_join": """SELECT fact_key, year, decade_label, time_category, sex_label,
        residence_label, wealth_quintile_label, indicator_category,
        indicator_value::VARCHAR::DOUBLE AS indicator_value FROM star""",
    "subgroup_aggregates": "SELECT * FROM subgroups",
    "equity_gap": all_of("gaps", "urban_value", "rural_value", "urban_rural_gap"),
    "disparity_band": f"""SELECT indicator_category, year, sex_label,
        {band("urban_rural_gap")} AS disparity_level FROM gaps""",
    "sql_views": f"""SELECT year, sex_label, count(*) AS measurements, {MEAN} AS avg_value
        FROM star WHERE is_total_wealth GROUP BY ALL""",
    "sql_relations": " UNION ALL ".join(
        f"SELECT '{view}' AS relation, count(*) AS rows, sum({c})::BIGINT AS total FROM {source}"
        for view, source, c in (
            ("stg_health_indicators", "staged", "year"),
            ("int_child_health_indicators", "classified", "data_quality_score"),
            ("int_yoy_changes", "changed", "year - prev_year"),
            ("fact_child_health", "facts", "demographic_key"),
            ("dim_time", "times", "years_ago"),
            ("dim_demographics", "people", "demographic_key"),
            ("mart_kpi_summary", "kpi", "measurement_count"),
        )
    ),
    # checks
    "validate_staging": """SELECT count(*) AS total_rows, count(indicator)
        AS non_null_indicators, count(value) AS non_null_values FROM raw""",
    "check_not_null": " UNION ALL ".join(
        check("not_null", "raw_observations", c, "raw", nulls("raw", c))
        for c in ("indicator", "sex", "wealth_quintile", "value_numeric", "value_ci")
    ),
    "check_unique": " UNION ALL ".join(
        check("unique", "raw_observations", c, "raw", repeats("raw", c))
        for c in ("src_key", "value_ci")
    ),
    "check_unique_stored": " UNION ALL ".join(
        check("unique", name, "fact_key", source, repeats(source, "fact_key"))
        for name, source in (
            ("fact_observations", "facts"),
            (
                "repeated",
                "(SELECT CASE WHEN fact_key % 97 = 0 THEN NULL WHEN fact_key % 89 = 0"
                " THEN fact_key - fact_key % 2 - 1 ELSE fact_key END AS fact_key FROM facts)",
            ),
        )
    ),
    "check_accepted_values": check(
        "accepted_values", "raw_observations", "sex", "raw",
        "SELECT count(*) FROM raw WHERE sex NOT IN ('Male')",
    ),
    "check_relationships_large": " UNION ALL ".join(
        check("relationships", name, "l_orderkey", source,
              orphans(source, "l_orderkey", "orders", "o_orderkey"))
        for name, source in (
            ("lineitem", "lineitem"),
            (
                "other",
                "(SELECT CASE WHEN l_orderkey % 97 = 0 THEN -l_orderkey"
                " WHEN l_orderkey % 89 <> 0 THEN l_orderkey END AS l_orderkey FROM lineitem)",
            ),
        )
    ),
    "check_relationships": check(
        "relationships", "orders", "o_custkey", "orders",
        orphans(
            "(SELECT if(o_orderkey % 97 = 0, -o_custkey, o_custkey) AS o_custkey FROM orders)",
            "o_custkey", "customer", "c_custkey",
        ),
    ),
    "check_range": check(
        "range", "int_classified", "ci_width", "classified",
        "SELECT count(*) FROM classified WHERE ci_width < 0 OR ci_width > 20",
    ),
    "check_suite": suite(),
    # dashboard
    "bi_stunting_trend": f"""SELECT year, indicator_value::VARCHAR::DOUBLE AS stunting_percentage,
        value_lower_ci::VARCHAR::DOUBLE AS lower_bound, value_upper_ci::VARCHAR::DOUBLE AS upper_bound
        FROM star WHERE indicator_category = 'Stunting' AND {TOTAL}
        AND severity_level = 'Overall'""",
    "bi_mortality_by_sex": """SELECT year, sex_label,
        indicator_value::VARCHAR::DOUBLE AS mortality_rate FROM star
        WHERE indicator_category = 'Mortality' AND is_total_residence
        AND is_total_wealth""",
    "bi_category_trend": f"""SELECT year, indicator_category, {MEAN} AS avg_value
        FROM star WHERE {TOTAL} AND severity_level = 'Overall'
        AND year >= {P.recent_min_year} GROUP BY ALL""",
    "bi_urban_rural": f"""SELECT indicator_category, residence_label, {MEAN} AS avg_value
        FROM star WHERE residence_label IN ({listed(URBAN_RURAL)})
        AND sex_label = 'Both Sexes' AND is_total_wealth AND is_recent_5y
        AND severity_level = 'Overall' GROUP BY ALL""",
    "bi_wealth_gradient": f"""SELECT indicator_category, wealth_quintile_label,
        {MEAN} AS avg_value FROM star WHERE wealth_quintile_label <> 'All Wealth Groups'
        AND sex_label = 'Both Sexes' AND is_total_residence AND is_recent_5y
        AND indicator_category IN ({listed(GRADIENT)}) GROUP BY ALL""",
    "bi_sex_gap": f"""SELECT indicator_category, sex_label, {MEAN} AS avg_value
        FROM star WHERE sex_label IN ({listed(MALE_FEMALE)}) AND is_total_residence
        AND is_total_wealth AND is_recent_5y GROUP BY ALL""",
    "bi_stunting_kpi": f"""SELECT indicator_value::VARCHAR::DOUBLE AS current_stunting_rate,
        percentage_change AS yoy_change, trend_direction, year AS measurement_year
        FROM star WHERE indicator_category = 'Stunting' AND {TOTAL}
        AND severity_level = 'Overall' ORDER BY year DESC, fact_key LIMIT 1""",
    "bi_mortality_kpi": f"""SELECT {avg_of("indicator_value", 1)} AS avg_mortality_rate,
        count(*) AS data_points, min(year) AS from_year, max(year) AS to_year
        FROM star WHERE indicator_category = 'Mortality' AND {TOTAL} AND is_recent_5y""",
    "bi_largest_gap": """SELECT indicator_category,
        urban_rural_gap::VARCHAR::DOUBLE AS gap_percentage, urban_value::VARCHAR::DOUBLE AS urban_value,
        rural_value::VARCHAR::DOUBLE AS rural_value, disparity_level
        FROM kpi WHERE urban_rural_gap IS NOT NULL AND sex_label = 'Both Sexes'
        ORDER BY abs(urban_rural_gap) DESC, indicator_category, residence_label,
        wealth_quintile_label LIMIT 1""",
    "bi_trend_scorecard": f"""SELECT indicator_category,
        count(*) FILTER (trend_direction = 'Decreasing') AS improving_indicators,
        count(*) FILTER (trend_direction = 'Increasing') AS worsening_indicators,
        count(*) FILTER (trend_direction = 'Stable') AS stable_indicators,
        {avg_pct(2)} AS avg_change_pct
        FROM facts JOIN people USING (demographic_key)
        WHERE {TOTAL} AND percentage_change IS NOT NULL GROUP BY ALL""",
    "bi_quality_summary": f"""SELECT indicator_category, count(*) AS total_records,
        count(*) FILTER (is_missing_value) AS missing_values,
        {avg_int("data_quality_score", 1)} AS avg_quality_score,
        count(*) FILTER (is_significant_change) AS significant_changes
        FROM facts GROUP BY ALL""",
    "bi_yoy_detail": f"""SELECT year, indicator_category, residence_label,
        indicator_value::VARCHAR::DOUBLE AS current_value,
        previous_year_value::VARCHAR::DOUBLE AS previous_year_value,
        absolute_change::VARCHAR::DOUBLE AS absolute_change, percentage_change,
        is_significant_change FROM star WHERE residence_label IN ({listed(URBAN_RURAL)})
        AND sex_label = 'Both Sexes' AND is_total_wealth
        AND percentage_change IS NOT NULL""",
    "bi_top_improvements": """SELECT indicator_name, year, residence_label,
        indicator_value::VARCHAR::DOUBLE AS indicator_value, percentage_change,
        absolute_change::VARCHAR::DOUBLE AS absolute_change FROM star
        WHERE percentage_change < 0 AND sex_label = 'Both Sexes' AND is_recent_5y
        ORDER BY percentage_change, fact_key LIMIT 5""",
    "bi_severe": """SELECT year, indicator_name,
        indicator_value::VARCHAR::DOUBLE AS severe_percentage, residence_label FROM star
        WHERE severity_level = 'Severe' AND sex_label = 'Both Sexes'
        AND is_total_wealth""",
    "bi_indicator_pivot": """SELECT year, demographic_key,
        max(indicator_value) FILTER (indicator_category = 'Stunting')::VARCHAR::DOUBLE AS stunting,
        max(indicator_value) FILTER (indicator_category = 'Wasting')::VARCHAR::DOUBLE AS wasting,
        max(indicator_value) FILTER (indicator_category = 'Underweight')::DOUBLE
            AS underweight,
        max(indicator_value) FILTER (indicator_category = 'Anaemia')::VARCHAR::DOUBLE AS anaemia
        FROM star WHERE severity_level = 'Overall' GROUP BY year, demographic_key
        HAVING stunting IS NOT NULL AND wasting IS NOT NULL""",
    "bi_coverage": f"""SELECT year,
        count(DISTINCT indicator_category) AS indicators_count,
        count(DISTINCT sex || residence || wealth_quintile) AS demographic_combinations,
        count(*) AS total_measurements, {avg_int("data_quality_score", 1)} AS avg_quality
        FROM star GROUP BY ALL""",
}


def oracle_sql() -> dict[str, str]:
    return {key: with_ctes(select) for key, select in SELECTS.items()}
