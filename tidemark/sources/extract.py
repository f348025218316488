"""CSV extracts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import SEED_TYPES
from tidemark.sources.headers import (
    check_headers,
    distinct_headers,
    normalize_header,
    normalized_names,
    read_header,
)
from tidemark.sources.infer import as_read, column_kinds
from tidemark.sources.records import parsed, read_records
from tidemark.workspace import Workspace

# Texts read as NULL, as the usual data-frame readers do.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
# The text of a line whose number of fields is not the header's, and whether it
# has more of them.
LINE, LONG = "line", "line_is_long"
ORDER = ("source_file", "source_block", "source_row")


@dataclass(frozen=True)
class Extract:
    """All data lines of an extract: its columns, LINE, LONG and the file order.

    ``rows`` are those that count, as the reader was asked to shape them;
    ``rejected`` are the over-long ones, with the line as it stands.
    """

    lines: DataFrame
    names: tuple[str, ...]
    shape: Callable[[DataFrame], DataFrame]
    strict: bool = True

    @property
    def rows(self) -> DataFrame:
        if self.strict:
            stop = F.raise_error(F.lit("a line has more fields than the header"))
            kept = F.when(F.col(LONG), stop.cast("boolean")).otherwise(True)
        else:
            kept = ~F.col(LONG)
        return self.shape(self.lines.filter(kept).drop(LINE, LONG))

    @property
    def rejected(self) -> DataFrame:
        return self.lines.filter(LONG).drop(LONG)

    def stored(self, workspace: Workspace) -> Extract:
        """The same with its lines parsed once and written down."""
        return replace(self, lines=workspace.store(self.lines, "lines"))

    def inferred(self) -> Extract:
        """The same with columns of numbers, or of truths, alone read as such.

        Looks at all rows once; store the lines before if they are parsed again.
        """
        kinds, shape = column_kinds(self.rows, self.names), self.shape
        return replace(self, shape=lambda lines: as_read(shape(lines), kinds))


def null_tokens(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL in place of a null token, in all or the given columns."""

    def cleaned(name: str) -> Column:
        c = F.col(f"`{name}`")
        return F.when(~c.isin(*NULL_TOKENS), c)

    return df.withColumns({n: cleaned(n) for n in columns or df.columns})


def audit_columns(df: DataFrame, run_ts: dt.datetime, source_file: str) -> DataFrame:
    """The batch time, one value per run, and the name of the file."""
    return df.withColumns(
        {
            "ingestion_timestamp": F.lit(run_ts),
            "source_file": F.lit(source_file),
        }
    )


def _file_order() -> dict[str, Column]:
    # Sorted by these, rows stand as in the file, however Spark split it.
    values = (
        F.col("_metadata.file_name"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    return dict(zip(ORDER, values, strict=True))


def _too_long(line: Column, width: int, field: Column) -> Column:
    """More fields than ``width``, by the commas outside quotes, if there are
    enough at all. Lines with as many fields as the header have no text here.

    Any ``field`` is looked at as well: Spark reads no line texts alone.
    """

    def commas(c: Column) -> Column:
        return F.length(c) - F.length(F.replace(c, F.lit(",")))

    unquoted = F.regexp_replace(
        F.replace(line, F.lit('""')), r'(?<![^,])"[^"]*"', ""
    )
    long = (commas(line) >= width) & (commas(unquoted) >= width)
    parsed = F.length(F.coalesce(field, F.lit(""))) >= 0
    return parsed & F.when(line.isNull(), False).otherwise(long)


def _scan(
    spark: SparkSession,
    path: str,
    header: Sequence[str],
    names: Sequence[str],
    multi_line: bool,
    workspace: Workspace | None,
) -> DataFrame:
    """All data lines as text. Files whose header differs fail the read.

    Without line breaks in fields, Spark compares every file's header with the schema as it opens the file, if
    the names can be a schema; else the first lines are looked at beforehand.
    """
    if multi_line:
        records = read_records(spark, path, workspace or Workspace(spark))
        lines = parsed(records, names, LINE)
        return lines.withColumn(LONG, _too_long(F.col(LINE), len(names), F.lit("")))
    plain = len({h.lower() for h in header if h}) == len(header) and LINE not in header
    if not plain:
        check_headers(spark, path)
    fields = [*(header if plain else names), LINE]
    scanned = (
        spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in fields]))
        .option("header", True)
        .option("enforceSchema", not plain)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", LINE)
        .option("columnPruning", False)  # else fields are not counted
        .csv(path)
    )
    columns = [
        F.col(f"`{f.replace('`', '``')}`").alias(n)
        for f, n in zip(fields, [*names, LINE], strict=True)
    ]
    order = [c.alias(n) for n, c in _file_order().items()]
    lines = scanned.select(*columns, *order)
    return lines.withColumn(LONG, _too_long(F.col(LINE), len(names), F.col(f"`{names[0]}`")))


def read_extract(
    spark: SparkSession,
    path: str,
    run_ts: dt.datetime,
    *,
    strict: bool = True,
    multi_line: bool = False,
    workspace: Workspace | None = None,
) -> Extract:
    """Read a CSV extract: one file, or a folder of files with equal headers.

    A file whose header differs from the others' fails the job. Every field is text.
    Short lines are filled with NULLs. A line with more fields than the header fails
    the job when ``strict``, else it is set aside. ``multi_line`` admits line breaks
    inside quotes; files are split all the same, but read twice, and a row per split is
    kept in ``workspace``.
    """
    header = read_header(spark, path, multi_line)
    names = normalized_names(header)

    def shape(lines: DataFrame) -> DataFrame:
        return null_tokens(lines, names).withColumn("ingestion_timestamp", F.lit(run_ts))

    lines = _scan(spark, path, header, names, multi_line, workspace)
    return Extract(lines, tuple(names), shape, strict)


def read_typed(
    spark: SparkSession,
    path: str,
    types: Mapping[str, T.DataType] | None = None,
    *,
    strict: bool = True,
    multi_line: bool = False,
    workspace: Workspace | None = None,
) -> Extract:
    """Read a CSV whose headers are kept and whose listed columns are typed.

    Repeated headers get the suffixes .1, .2 ...; over-long lines and differing
    headers are treated as in ``read_extract``. Text that does not fit its type
    becomes NULL.
    """
    types = SEED_TYPES if types is None else types
    header = read_header(spark, path, multi_line)
    names = distinct_headers(header)

    def shape(lines: DataFrame) -> DataFrame:
        def typed(name: str) -> Column:
            c = F.col(f"`{name}`")
            return c.try_cast(types[name]).alias(name) if name in types else c

        return null_tokens(lines, names).select(*map(typed, names), *ORDER)

    lines = _scan(spark, path, header, names, multi_line, workspace)
    return Extract(lines, tuple(names), shape, strict)


def raw_from_seed(rows: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Rows of a typed seed under the names of the raw contract, as text.

    The interval is put together from its two bounds; the other headers are
    normalized as those of an extract. The display value is the number, unless
    the seed has a column for it.
    """
    year, number, low, high = SEED_TYPES
    seed = (year, number, low, high)
    others = {c: normalize_header(c) for c in rows.columns if c not in (*seed, *ORDER)}
    text = F.col(f"`{number}`").cast("string")
    bounds = F.concat(
        F.lit("["), F.col(f"`{low}`").cast("string"), F.lit("-"),
        F.col(f"`{high}`").cast("string"), F.lit("]"),
    )
    made = {"period": F.col(f"`{year}`"), "value_numeric": text, "value": text, "value_ci": bounds}
    return rows.select(
        *[F.col(f"`{c}`").alias(n) for c, n in others.items()],
        *[c.alias(n) for n, c in made.items() if n not in others.values()],
        *ORDER,
        F.lit(run_ts).alias("ingestion_timestamp"),
    )
