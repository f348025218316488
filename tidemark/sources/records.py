"""Records of CSV files with line breaks inside quotes, read in splits.

A file is read as lines, split anywhere. Whether a line begins inside quotes depends on
all lines before it, but what it does to that is known from the line alone: it keeps the
state, turns it round, or ends in one state whatever came before. Those effects are
folded per split (one row each), then over the splits of a file; so every split knows
the state it begins with, and its lines theirs. Only splits that hold an open quote are
put in order line by line; elsewhere each line is a record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.workspace import Workspace

_BEFORE = (Window.unboundedPreceding, -1)
_UPTO = (Window.unboundedPreceding, 0)


def ends_inside(line: Column, inside: Column) -> Column:
    """Whether a line ends inside quotes, having begun there or not.

    A quote opens a field only as its first character; a doubled one inside is no end.
    """
    text = F.concat(F.when(inside, '"').otherwise(""), line)
    bare = F.regexp_replace(F.replace(text, F.lit('""')), r'(?<![^,])"[^"]*"', "")
    return bare.rlike(r'(?<![^,])"')


def _differ(a: Column, b: Column) -> Column:
    return a != b


def _with_state(
    df: DataFrame, part: Sequence[str], order: str, fixed: Column, turns: Column, entry: Column
) -> DataFrame:
    """``df`` with ``state``, that before each row.

    ``fixed`` is the state after a row that doesn't depend on the one before (else
    NULL), ``turns`` whether the row turns it round, ``entry`` the state at the start.
    """
    rows = Window.partitionBy(*part).orderBy(order)
    odd = F.col("__turned") % 2 == 1
    counted = df.withColumns({"__fixed": fixed, "__turns": turns.cast("int")}).withColumn(
        "__turned", F.sum("__turns").over(rows.rowsBetween(*_UPTO))
    )
    last = F.when(
        F.col("__fixed").isNotNull(),
        F.struct(_differ(F.col("__fixed"), odd).alias("start")),
    )
    known = counted.withColumn("__last", F.last(last, True).over(rows.rowsBetween(*_BEFORE)))
    before = (F.col("__turned") - F.col("__turns")) % 2 == 1
    state = _differ(F.coalesce(F.col("__last.start"), entry), before)
    return known.withColumn("state", state).drop("__fixed", "__turns", "__turned", "__last")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the files with their place, and the state after each from either."""
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_name").alias("source_file"),
            F.col("_metadata.file_block_start").alias("source_block"),
            F.monotonically_increasing_id().alias("source_row"),
            F.col("value").alias("line"),
        )
    )
    quoted = F.col("line").contains('"')
    return lines.withColumns(
        {
            "from_out": quoted & ends_inside(F.col("line"), F.lit(False)),
            "from_in": ~quoted | ends_inside(F.col("line"), F.lit(True)),
        }
    )


def _chunks(lines: DataFrame) -> DataFrame:
    """Per 64 rows of a split the state they end in, if it is the same from either, else
    whether they turn it; whether a quote stays open, and the first line that isn't blank.

    Lines that turn the state are bits of one number, so no list grows with the lines.
    """
    out, into, row = F.col("from_out"), F.col("from_in"), F.col("source_row")
    bit = F.expr("shiftleft(1L, cast(source_row % 64 as int))")
    folded = lines.groupBy("path", "source_block", F.shiftright(row, 6).alias("chunk")).agg(
        F.max(F.when(out == into, row * 2 + out.cast("long"))).alias("last"),
        F.coalesce(F.bit_or(F.when(out & ~into, bit)), F.lit(0).cast("long")).alias("turns"),
        F.bool_or(out).alias("opens"),
        F.min(F.when(F.trim("line") != "", row)).alias("first_row"),
    )
    last = F.col("last")
    behind = F.expr("shiftrightunsigned(shiftrightunsigned(turns, cast(last div 2 % 64 as int)), 1)")
    odd = F.bit_count(F.when(last.isNull(), F.col("turns")).otherwise(behind)) % 2 == 1
    return folded.select(
        "path", "source_block", "chunk", "opens", "first_row",
        F.when(last.isNotNull(), _differ(last % 2 == 1, odd)).alias("fixed"),
        (last.isNull() & odd).alias("turned"),
    )


def _splits(lines: DataFrame) -> DataFrame:
    """Per split its state at the start and end, whether a quote stays open at the end
    of a line, and its first line that isn't blank."""
    chunk, state = F.col("chunk"), F.col("fixed")
    folded = _chunks(lines).groupBy("path", "source_block").agg(
        F.max(F.when(state.isNotNull(), F.struct(chunk, state.alias("state")))).alias("last"),
        F.collect_list(F.when(F.col("turned"), chunk)).alias("turns"),
        F.bool_or("opens").alias("opens"),
        F.min("first_row").alias("first_row"),
    )
    since = F.filter("turns", lambda c: c > F.coalesce(F.col("last.chunk"), F.lit(-1)))
    odd = F.size(since) % 2 == 1
    folded = folded.select(
        "path", "source_block", "opens", "first_row",
        F.when(F.col("last").isNotNull(), _differ(F.col("last.state"), odd)).alias("fixed"),
        odd.alias("odd"),
    )
    fixed = F.col("fixed")
    turns = fixed.isNull() & F.col("odd")
    known = _with_state(folded, ["path"], "source_block", fixed, turns, F.lit(False))
    end = F.coalesce(fixed, _differ(F.col("state"), turns))
    return known.select(
        "path", "source_block", "first_row",
        F.col("state").alias("entry"),
        end.alias("end"),
        (F.col("state") | F.col("opens")).alias("broken"),
    )


def read_records(spark: SparkSession, path: str, workspace: Workspace) -> DataFrame:
    """All records of the files behind their headers: the place of their first line
    (source_file, source_block, source_row) and their text (record).

    Lines end with ``\\n`` or ``\\r\\n``; breaks inside quotes stay as they are. Blank
    lines are no records. Files must have the same header, and a quote that is open at
    the end of a file is an error. The headers and one row per split are looked at
    beforehand.
    """
    lines = read_lines(spark, path)
    splits = workspace.store(_splits(lines), "splits")
    ends = splits.groupBy("path").agg(F.max_by("end", "source_block").alias("open"))
    unclosed = ends.filter("open").head()
    if unclosed is not None:
        raise ValueError(f"a quoted field does not end in {unclosed['path']}")

    at = ["path", "source_block"]
    placed = lines.join(F.broadcast(splits), at)
    plain = placed.filter(~F.col("broken")).select(*_PLACE, F.col("line").alias("record"))
    ordered = _with_state(
        placed.filter("broken"), at, "source_row",
        F.when(F.col("from_out") == F.col("from_in"), F.col("from_out")),
        F.col("from_out") & ~F.col("from_in"), F.col("entry"),
    )
    after = F.when(F.col("state"), F.col("from_in")).otherwise(F.col("from_out"))
    rows = Window.partitionBy(*at).orderBy("source_row")
    begins = F.when(~F.col("state"), F.col("source_row"))
    ordered = ordered.withColumns(
        {
            "whole": ~F.col("state") & ~after,
            "began": F.last(begins, True).over(rows.rowsBetween(*_UPTO)),
        }
    )
    single = ordered.filter("whole").select(*_PLACE, F.col("line").alias("record"))

    # Lines at the start of a split may belong to a record begun splits before.
    starts = ordered.groupBy(*at).agg(F.max("began").alias("began"))
    earlier = Window.partitionBy("path").orderBy("source_block").rowsBetween(*_BEFORE)
    start = F.when(F.col("began").isNotNull(), F.struct("source_block", "began"))
    carried = workspace.store(
        starts.select(*at, F.last(start, True).over(earlier).alias("carried")), "carried"
    )
    own = F.when(F.col("began").isNotNull(), F.struct("source_block", "began"))
    parts = ordered.filter(~F.col("whole")).join(F.broadcast(carried), at)
    joined = (
        parts.withColumn("start", F.coalesce(own, "carried"))
        .groupBy("path", "source_file", "start")
        .agg(F.array_sort(F.collect_list(F.struct("source_block", "source_row", "line"))).alias("l"))
        .select(
            "path", "source_file",
            F.col("start.source_block").alias("source_block"),
            F.col("start.began").alias("source_row"),
            F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("record"),
        )
    )
    records = plain.unionByName(single).unionByName(joined)
    record = F.regexp_replace("record", r"\r\z", "")
    records = records.withColumn("record", record)

    headers = splits.filter("source_block = 0").select("path", F.col("first_row").alias("header"))
    headed = records.join(F.broadcast(headers), "path")
    first = (F.col("source_block") == 0) & (F.col("source_row") == F.col("header"))
    if len(headed.filter(first).select("record").distinct().limit(2).collect()) > 1:
        raise ValueError(f"files in {path} have different headers")
    data = (F.col("source_block") > 0) | (F.col("source_row") > F.col("header"))
    # Not deterministic, so that Spark applies no later check to lines that are only
    # parts of records.
    record = F.when(F.monotonically_increasing_id() >= 0, F.col("record"))
    return headed.filter(data & (F.trim("record") != "")).select(
        *_PLACE[1:], record.alias("record")
    )


_PLACE = ("path", "source_file", "source_block", "source_row")


def parsed(records: DataFrame, names: Sequence[str], line: str) -> DataFrame:
    """The fields of records as text, and under ``line`` the text of those whose number
    of fields isn't that of ``names``."""
    fields = [f"_{k}" for k in range(len(names))]
    schema = ", ".join(f"{f} string" for f in [*fields, "_line"])
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": "_line"}
    row = F.from_csv("record", schema, options)
    found = records.withColumn("__row", row)
    return found.select(
        *[F.col(f"__row.{f}").alias(n) for f, n in zip(fields, names, strict=True)],
        F.col("__row._line").alias(line),
        "source_file", "source_block", "source_row",
    )
