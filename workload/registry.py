"""The registered queries: every operator and model over the given tables.

Models read the tables one step upstream, stored once per session and input
folder, as the batch job stores them, when a query first needs them; operators read
the raw table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import parse, rules, text
from tidemark.operators import quality
from tidemark.operators.colocated import join_colocated, write_colocated
from tidemark.plans import dashboard, dimensions, job, kpi, staging, yoy
from tidemark.plans.classified import classify, classify_by_dictionary
from tidemark.plans.fact import build_fact
from tidemark.sources import extract, headers
from tidemark.workspace import Workspace, write_table
from workload.derived import PARAMS, derived_raw, read
from workload.oracle import TOKENS

Query = Callable[[SparkSession, str], DataFrame]

#: Files of a table stored for joins by id.
BUCKETS = 16


@dataclass(frozen=True)
class Session:
    """Stored tables of one input folder."""

    workspace: Workspace
    raw: DataFrame
    tables: Mapping[str, DataFrame]

    @property
    def warehouse(self) -> dashboard.Warehouse:
        return job.as_warehouse(self.tables, PARAMS)

    def cells(self) -> DataFrame:
        t = self.tables
        return kpi.recent_cells(t["fact_observations"], t["dim_time"], t["dim_demographics"])


_sessions: dict[tuple[str, str], Session] = {}


def session(spark: SparkSession, sf_dir: str) -> Session:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _sessions:
        workspace = Workspace(spark)
        raw = workspace.store(derived_raw(spark, sf_dir), "raw")
        tables = job.tables_on_demand(raw, PARAMS, workspace, workspace.path("warehouse"))
        _sessions[key] = Session(workspace, raw, tables)
    return _sessions[key]


def present(df: DataFrame) -> DataFrame:
    """Drop batch times; decimals leave as doubles, long ones rounded first."""

    def shown(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = (F.round(c, 4) if f.dataType.scale > 12 else c).cast("double")
        return c.alias(f.name)

    hidden = ("updated_at", "ingestion_timestamp")
    return df.select(*[shown(f) for f in df.schema if f.name not in hidden])


# --- sources and sinks

MESSY = {
    "indicator": " Indicator",
    "indicator_code": "Indicator Code ",
    "location": "LOCATION",
    "location_code": "Location Code",
    "period": "Period?",
    "sex": "Sex",
    "residence": "Residence!",
    "wealth_quintile": "Wealth Quintile",
    "value_numeric": "Value_Numeric",
    "value": "Value",
    "value_ci": "VALUE (CI)",
    "src_key": "src key",
}


def write_csv(df: DataFrame, s: Session, name: str) -> str:
    path = s.workspace.path(name)
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def src_csv(s: Session) -> DataFrame:
    spark = s.workspace.spark
    path = write_csv(s.raw.withColumnsRenamed(MESSY), s, "extract")
    rows = extract.read_extract(spark, path, PARAMS.run_ts).rows
    return rows.select(*MESSY).withColumn("src_key", F.col("src_key").cast("long"))


def src_csv_breaks(s: Session) -> DataFrame:
    """One file whose texts hold line breaks, quotes and commas."""
    key, note = F.col("src_key"), F.col("indicator")
    broken = (
        F.when(key % 5 == 0, F.concat(note, F.lit("\n")))
        .when(key % 5 == 1, F.concat(F.lit('"\n,'), note))
        .when(key % 5 == 2, F.concat(note, F.lit('\r\n"",\n\n"'), note))
        .otherwise(note)
    )
    rows = s.raw.select("src_key", broken.alias("note"), "period").repartition(1)
    read = extract.read_extract(
        s.workspace.spark, write_csv(rows, s, "breaks"), PARAMS.run_ts,
        multi_line=True, workspace=s.workspace,
    )
    return read.rows.select(F.col("src_key").cast("long").alias("src_key"), "note", "period")


def inferred_types(s: Session) -> DataFrame:
    """Columns of numbers in many spellings, truths, and texts, as inference reads them."""
    key = F.col("src_key")
    text, odd = key.cast("string"), key % 2 == 1
    spelt = (
        F.when(key % 4 == 0, F.concat(text, F.lit("e0")))
        .when(key % 4 == 1, F.concat(text, F.lit(".0")))
        .when(key % 4 == 2, F.concat(F.lit(" +"), text))
        .otherwise(text)
    )
    rows = s.raw.select(
        key,
        spelt.alias("spelt"),
        F.lpad(text, 9, "0").alias("padded"),
        F.concat((key * 5).cast("string"), F.lit("E-1")).alias("halves"),
        F.concat((key + 1).cast("string"), F.lit("e12")).alias("large"),
        F.when(odd, "TRUE").otherwise("False").alias("truth"),
        F.when(key % 1000 == 999, "n/k").otherwise(spelt).alias("mixed"),
        F.when(odd, text).otherwise("NA").alias("holes"),
        F.when(odd, "true").alias("truth_holes"),
    )
    read = extract.read_extract(s.workspace.spark, write_csv(rows, s, "typed"), PARAMS.run_ts)
    found = read.stored(s.workspace).inferred().rows.drop(*extract.ORDER, "ingestion_timestamp")
    return found.withColumn("src_key", F.col("src_key").cast("long"))


def null_tokens(s: Session) -> DataFrame:
    pick = (F.col("src_key") % len(TOKENS) + 1).cast("int")
    token = F.element_at(F.array(*map(F.lit, TOKENS)), pick)
    rows = s.raw.select("src_key", "period", token.alias("token"))
    return extract.null_tokens(rows, ["period", "token"])


def some_bad_lines(s: Session) -> extract.Extract:
    key = F.col("src_key")
    line = (
        F.when(key % 101 == 0, F.concat_ws(",", key, "indicator_code", "location", F.lit("x")))
        .when(key % 107 == 0, F.concat_ws(",", key, "indicator_code", "location", F.lit(",x")))
        .when(key % 103 == 0, F.concat_ws(",", key, "indicator_code"))
        .otherwise(F.concat_ws(",", key, "indicator_code", "location"))
    )
    path = s.workspace.path("lines")
    lines = s.raw.select(line.alias("src_key,Indicator Code,Location"))
    lines.write.option("header", True).option("sep", "\t").csv(path)
    return extract.read_extract(s.workspace.spark, path, PARAMS.run_ts, strict=False)


def bad_rows(s: Session) -> DataFrame:
    read = some_bad_lines(s)

    def fate(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.col("src_key").cast("long").alias("src_key"),
            F.lit(name).alias("fate"),
            "indicator_code",
            "location",
        )

    return fate(read.rows, "kept").unionByName(fate(read.rejected, "rejected"))


def normalize_headers(s: Session) -> DataFrame:
    columns = ["src_key", "indicator_code", "value_ci", "value_numeric", "value", "location"]
    messy = ["SRC KEY", " Indicator Code ", "VALUE (CI)", "Value-Numeric!", "Value", "Value"]
    return headers.normalize_headers(s.raw.select(*columns).toDF(*messy))


def audit_columns(s: Session) -> DataFrame:
    audited = extract.audit_columns(s.raw, PARAMS.run_ts, "derived.csv")
    return audited.select("src_key", "source_file", "ingestion_timestamp")


def sink_roundtrip(s: Session) -> DataFrame:
    """Full replace: the second load leaves only its own rows."""
    path = s.workspace.path("sink")
    staged = s.tables["stg_observations"]
    write_table(staged.withColumn("value", F.lit(None).cast(schemas.VALUE)), path)
    return write_table(staged, path)


def ingest_metrics(s: Session) -> DataFrame:
    """Of a lenient read that rejects lines."""
    read = some_bad_lines(s).stored(s.workspace)
    return job.load_raw(read, s.workspace.path("loaded"), lambda rows: rows)[1]


def typed_seed(s: Session) -> DataFrame:
    seed = s.raw.select(
        "src_key",
        F.col("period").alias("YEAR (DISPLAY)"),
        F.col("value_numeric").alias("Numeric"),
        F.col("value").alias("Low"),
        F.split_part("value_ci", F.lit(" "), F.lit(1)).alias("High"),
    )
    path = write_csv(seed, s, "seed")
    typed = extract.read_typed(s.workspace.spark, path).rows.drop(*extract.ORDER)
    return typed.withColumn("src_key", F.col("src_key").cast("long"))


def typed_seed_long(s: Session) -> DataFrame:
    """A seed with over-long lines, under the names of the raw contract."""
    key = F.col("src_key")
    line = F.concat_ws(
        ",", key, "period", F.coalesce("value_numeric", F.lit("NA")), key % 7, key % 9,
        F.when(key % 101 == 0, F.lit("SURPLUS")),
    )
    path = s.workspace.path("long-seed")
    lines = s.raw.select(line.alias("Src Key,YEAR (DISPLAY),Numeric,Low,High"))
    lines.write.option("header", True).option("sep", "\t").csv(path)
    read = extract.read_typed(s.workspace.spark, path, strict=False)
    kept = extract.raw_from_seed(read.rows, PARAMS.run_ts).select(
        F.col("src_key").cast("long").alias("src_key"),
        "period",
        F.col("value_numeric").try_cast("double").alias("number"),
        "value_ci",
        F.lit("kept").alias("fate"),
    )
    rejected = read.rejected.select(
        F.col("Src Key").cast("long").alias("src_key"),
        F.col("YEAR (DISPLAY)").alias("period"),
        F.lit(None).cast("double").alias("number"),
        F.lit(None).cast("string").alias("value_ci"),
        F.lit("rejected").alias("fate"),
    )
    return kept.unionByName(rejected)


def header_order(s: Session) -> DataFrame:
    """Whether a folder is read: two files with one header, or with two orders of it."""
    spark, raw = s.workspace.spark, s.raw.select("src_key", "location", "period")
    rows = []
    for name, columns in (("same", raw.columns), ("other", raw.columns[::-1])):
        path = s.workspace.path(f"headers-{name}")
        raw.filter("src_key % 2 = 0").write.option("header", True).csv(path)
        rest = raw.filter("src_key % 2 = 1").select(*columns)
        rest.write.mode("append").option("header", True).csv(path)
        read = extract.read_extract(spark, path, PARAMS.run_ts)
        try:
            found = write_table(read.rows, s.workspace.path("read")).count()
        except Exception as e:
            if "FAILED_READ_FILE" not in str(e) and "header" not in str(e):
                raise
            found = None
        rows.append((name, found))
    return spark.createDataFrame(rows, "folder string, rows_read long")


# --- row expressions over the raw table


def over_raw(**columns) -> Callable[[Session], DataFrame]:
    def run(s: Session) -> DataFrame:
        return s.raw.select("src_key", *[c.alias(n) for n, c in columns.items()])

    return run


def _parsed_value():
    return parse.parse_value(F.col("value_numeric"), F.col("value"))


def row_queries() -> dict[str, Callable[[Session], DataFrame]]:
    col = F.col
    return {
        "clean_text": over_raw(
            indicator_name=text.clean(col("indicator")),
            indicator_code=text.clean(col("indicator_code")),
            location=text.clean(col("location")),
            location_code=text.clean(col("location_code")),
            period=text.clean(col("period")),
        ),
        "default_dims": over_raw(
            sex=text.default_dimension(col("sex"), "both"),
            residence=text.default_dimension(col("residence"), "total"),
            wealth_quintile=text.default_dimension(col("wealth_quintile"), "total"),
        ),
        "parse_period": over_raw(year=parse.parse_year(col("period"))),
        "parse_value": over_raw(value=_parsed_value()),
        "parse_ci": over_raw(
            value_lower_ci=parse.lower_bound(col("value_ci")),
            value_upper_ci=parse.upper_bound(col("value_ci")),
        ),
        "quality_flags": over_raw(
            is_missing_value=parse.is_missing(_parsed_value(), col("value")),
            has_data_quality_issue=parse.used_fallback(
                _parsed_value(), col("value_numeric")
            ),
        ),
        "classify_category": over_raw(indicator_category=rules.category(col("indicator"))),
        "classify_severity": over_raw(severity_level=rules.severity(col("indicator"))),
    }


def surrogate_key(s: Session) -> DataFrame:
    return staging.number_raw(s.raw, PARAMS, s.workspace).select(
        "src_key", "indicator_id"
    )


# --- models


def yoy_changes(s: Session) -> DataFrame:
    return yoy.yoy_changes(s.tables["int_classified"], PARAMS, s.workspace)


def yoy_changes_hot(s: Session) -> DataFrame:
    """The same with nearly every series cut into chunks."""
    params = replace(PARAMS, hot_rows=8, chunk_rows=1000)
    return yoy.yoy_changes(s.tables["int_classified"], params, s.workspace)


def fact_observations(s: Session) -> DataFrame:
    t = s.tables
    return build_fact(
        t["int_classified"], t["dim_time"], t["dim_demographics"], PARAMS, s.workspace
    )


def colocated_changes(s: Session) -> tuple[DataFrame, DataFrame, list[str]]:
    """Valued rows and their changes, both in buckets by id, and the other keys."""
    keys = ["year", "sex", "residence", "wealth_quintile"]
    changes = [
        "previous_year_value",
        "absolute_change",
        "percentage_change",
        "trend_direction",
        "is_significant_change",
    ]
    valued = s.tables["int_classified"].filter("indicator_value IS NOT NULL")
    left = valued.select("indicator_id", *keys, "indicator_value")
    right = yoy_changes(s).select("indicator_id", *keys, *changes)
    stored = [
        write_colocated(df, name, "indicator_id", BUCKETS, s.workspace)
        for df, name in ((left, "valued"), (right, "changes"))
    ]
    return stored[0], stored[1], keys


def fact_yoy_join(s: Session) -> DataFrame:
    """The change columns by join instead of in the same pass, bucket by bucket."""
    valued, changes, keys = colocated_changes(s)
    return join_colocated(valued, changes, "indicator_id", keys)


def int_classified_by_name(s: Session) -> DataFrame:
    return classify_by_dictionary(s.tables["stg_observations"], s.workspace)


def star_join(s: Session) -> DataFrame:
    return s.warehouse.star().select(
        "fact_key",
        "year",
        "decade_label",
        "time_category",
        "sex_label",
        "residence_label",
        "wealth_quintile_label",
        "indicator_category",
        "indicator_value",
    )


def stored_cells(s: Session) -> DataFrame:
    return s.workspace.store(s.cells(), "cells")


def disparity_band(s: Session) -> DataFrame:
    return kpi.equity_gap(s.cells()).select(
        *kpi.GAP, rules.disparity_band(F.col("urban_rural_gap")).alias("disparity_level")
    )


def sql_views(s: Session) -> DataFrame:
    """The same tables through spark.sql under the dashboards' names."""
    job.register_views(s.tables, PARAMS, s.workspace)
    return s.workspace.spark.sql(
        """
        SELECT t.year, d.sex_label, count(*) AS measurements,
               round(avg(f.indicator_value), 4) AS avg_value
        FROM fact_child_health f
        JOIN dim_time t ON t.year = f.time_key
        JOIN dim_demographics d ON d.demographic_key = f.demographic_key
        WHERE d.is_total_wealth
        GROUP BY t.year, d.sex_label
        """
    )


def sql_relations(s: Session) -> DataFrame:
    """All seven relations through spark.sql: their rows, and the sum of a column."""
    job.register_views(s.tables, PARAMS, s.workspace)
    columns = {
        "stg_health_indicators": "year",
        "int_child_health_indicators": "data_quality_score",
        "int_yoy_changes": "years_gap",
        "fact_child_health": "demographic_key",
        "dim_time": "years_ago",
        "dim_demographics": "demographic_key",
        "mart_kpi_summary": "measurement_count",
    }
    return s.workspace.spark.sql(
        " UNION ALL ".join(
            f"SELECT '{view}' AS relation, count(*) AS rows, CAST(sum({c}) AS BIGINT) AS total"
            f" FROM {view}"
            for view, c in columns.items()
        )
    )


# --- checks


def check_not_null(s: Session) -> DataFrame:
    columns = ["indicator", "sex", "wealth_quintile", "value_numeric", "value_ci"]
    return quality.check_not_null(s.raw, "raw_observations", columns)


def check_unique(s: Session) -> DataFrame:
    return quality.check_unique(s.raw, "raw_observations", "src_key").unionByName(
        quality.check_unique(s.raw, "raw_observations", "value_ci")
    )


def check_unique_stored(s: Session) -> DataFrame:
    """Keys of the fact as stored, and with some repeated and some missing."""
    fact, workspace = s.tables["fact_observations"], s.workspace
    key = F.col("fact_key")
    again = F.when(key % 89 == 0, key - key % 2 - 1).otherwise(key)
    again = fact.withColumn("fact_key", F.when(key % 97 != 0, again))
    return quality.check_unique_number(
        fact, "fact_observations", "fact_key", workspace
    ).unionByName(quality.check_unique_number(again, "repeated", "fact_key", workspace))


def check_relationships_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines against orders, as they are and with some orders made up or unknown."""
    workspace = Workspace(spark)
    lines, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    key = F.col("l_orderkey")
    other = F.when(key % 97 == 0, -key).when(key % 89 != 0, key)
    checks = [(lines, "lineitem"), (lines.withColumn("l_orderkey", other), "other")]
    reports = [
        quality.check_relationships_number(
            child, name, "l_orderkey", orders, "o_orderkey", workspace
        )
        for child, name in checks
    ]
    return reports[0].unionByName(reports[1])


def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against customers, with unknown customers made up for some orders."""
    unknown = F.when(F.col("o_orderkey") % 97 == 0, -F.col("o_custkey"))
    orders = read(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.coalesce(unknown, "o_custkey")
    )
    parents = read(spark, sf_dir, "customer")
    return quality.check_relationships(orders, "orders", "o_custkey", parents, "c_custkey")


def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = text.title_case(F.lower("o_orderpriority"))
    return read(spark, sf_dir, "orders").select("o_orderkey", label.alias("label"))


SESSION_QUERIES: dict[str, Callable[[Session], DataFrame]] = {
    "src_csv": src_csv,
    "src_csv_breaks": src_csv_breaks,
    "inferred_types": inferred_types,
    "null_tokens": null_tokens,
    "bad_rows": bad_rows,
    "normalize_headers": normalize_headers,
    "audit_columns": audit_columns,
    "sink_roundtrip": sink_roundtrip,
    "ingest_metrics": ingest_metrics,
    "typed_seed": typed_seed,
    "typed_seed_long": typed_seed_long,
    "header_order": header_order,
    "drop_tag_rows": lambda s: staging.drop_tag_rows(s.raw).select(
        "src_key", "indicator_code"
    ),
    "surrogate_key": surrogate_key,
    "quarantine": lambda s: staging.malformed_numbers(s.raw).select(
        "src_key", "value_numeric", "value", "value_ci"
    ),
    "scope_filter": lambda s: s.raw.filter(rules.in_scope(F.col("indicator"))).select(
        "src_key", "indicator"
    ),
    "ci_width": lambda s: classify(s.tables["stg_observations"]).select(
        "indicator_id", "ci_width"
    ),
    "quality_score": lambda s: classify(s.tables["stg_observations"]).select(
        "indicator_id", "data_quality_score"
    ),
    "stg_observations": lambda s: staging.stage(s.raw, PARAMS, s.workspace),
    "int_classified": lambda s: classify(s.tables["stg_observations"]),
    "yoy_changes": yoy_changes,
    "yoy_changes_hot": yoy_changes_hot,
    "yoy_ordered": lambda s: yoy.by_size_of_change(yoy_changes(s)),
    "dim_time": lambda s: dimensions.dim_time(s.tables["stg_observations"], PARAMS),
    "dim_demographics": lambda s: dimensions.dim_demographics(
        s.tables["stg_observations"], PARAMS, s.workspace
    ),
    "distinct_years": lambda s: dimensions.distinct_years(s.tables["stg_observations"]),
    "distinct_triples": lambda s: dimensions.distinct_triples(
        s.tables["stg_observations"]
    ),
    "fact_observations": fact_observations,
    "fact_yoy_join": fact_yoy_join,
    "int_classified_by_name": int_classified_by_name,
    "star_join": star_join,
    "subgroup_aggregates": lambda s: kpi.subgroup_aggregates(s.cells()),
    "equity_gap": lambda s: kpi.equity_gap(s.cells()),
    "disparity_band": disparity_band,
    "mart_kpi_summary": lambda s: kpi.kpi_summary(stored_cells(s), PARAMS),
    "sql_views": sql_views,
    "sql_relations": sql_relations,
    "validate_staging": lambda s: quality.validate_raw(s.raw),
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_unique_stored": check_unique_stored,
    "check_accepted_values": lambda s: quality.check_accepted_values(
        s.raw, "raw_observations", "sex", ["Male"]
    ),
    "check_range": lambda s: quality.check_range(
        s.tables["int_classified"], "int_classified", "ci_width", 0, 20
    ),
    "check_suite": lambda s: quality.run_suite(s.tables, s.workspace),
}

TABLE_QUERIES: dict[str, Query] = {
    "title_case": title_case,
    "check_relationships": check_relationships,
    "check_relationships_large": check_relationships_large,
}


def _over_session(run: Callable[[Session], DataFrame]) -> Query:
    return lambda spark, sf_dir: present(run(session(spark, sf_dir)))


def _dashboard(run: Callable[[dashboard.Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: present(run(session(spark, sf_dir).warehouse))


def _table(run: Query) -> Query:
    return lambda spark, sf_dir: present(run(spark, sf_dir))


def _row(name: str) -> Query:
    # Expressions need an active session, so they are built when called.
    return lambda spark, sf_dir: present(row_queries()[name](session(spark, sf_dir)))


ROW_KEYS = (
    "clean_text",
    "default_dims",
    "parse_period",
    "parse_value",
    "parse_ci",
    "quality_flags",
    "classify_category",
    "classify_severity",
)


def queries() -> dict[str, Query]:
    return {
        **{k: _over_session(q) for k, q in SESSION_QUERIES.items()},
        **{k: _row(k) for k in ROW_KEYS},
        **{k: _table(q) for k, q in TABLE_QUERIES.items()},
        **{k: _dashboard(q) for k, q in dashboard.QUERIES.items()},
    }
