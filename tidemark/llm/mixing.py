"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.columns import free_name, own, quoted
from tidemark.workspace import Workspace

#: Weights of the sources in turn.
WEIGHTS = (5, 2, 1)
#: A source's target stops at so many times its size.
MOST = 3
#: Ranges of random odds; within one range documents are ordered one by one.
BINS = 4096
_SIZE, _ODDS, _DRAW = "__size", "__odds", "__draw"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII blanks; null has none."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) fixed by seed and key: 48 bits of their MD5, and a half."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source its size, target and expected copies, from (source, size).

    Sources in code point order, null last, take the weights in turn and share
    the sum of all sizes. A target stops at ``most`` times its source's size
    and the excess goes to the others by weight, until none is above: sources
    reach their stop in order of size by weight, so those stopped are a prefix
    of that order. There is one row per source, as in a table of weights.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    at = F.element_at(F.array(*map(F.lit, weights)), F.pmod(rank, F.lit(len(weights))) + 1)
    ranked = sources.withColumn("weight", at.cast("long")).withColumn("order", rank)
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "order")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - most * F.coalesce(
        F.sum("source_size").over(before), F.lit(0)
    )
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    stops = (
        F.lit(most).cast("double") * F.col("source_size") * F.col("rest")
        <= F.col("left").cast("double") * F.col("weight")
    )
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shared = ranked.withColumns({"left": left, "rest": rest}).withColumn("stops", stops)
    shared = shared.withColumn("stopped", F.min("stops").over(until))
    # What the first source that isn't stopped finds left holds for all behind it.
    per = F.first(
        F.when(~F.col("stopped"), F.struct("left", "rest")), ignorenulls=True
    ).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("stopped"), (most * F.col("source_size")).cast("double")).otherwise(
        (F.col("per.left") * F.col("weight")).cast("double") / F.col("per.rest")
    )
    return (
        shared.withColumn("per", per)
        .withColumn("target", target)
        .withColumn(
            "copies",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
            .otherwise(0)
            .cast("long"),
        )
        .select(
            "source",
            "source_size",
            "target",
            "copies",
            (F.col("target") - F.col("copies") * F.col("source_size")).alias("quota"),
        )
    )


def inclusion_rates(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source with a quota the sizes in words that are certain, and a rate.

    Documents join the sample with a probability in proportion to their size, so that
    the sum of probability times size is the quota. Where that would exceed one, a
    document is certain: those larger than ``limit``. What they leave of the quota is
    shared by the others: theirs is ``rate`` times size. Rows per size are counted
    first, so the window is over different sizes, not documents.
    """
    counted = sized.groupBy("source", _SIZE).agg(F.count(F.lit(1)).alias("n"))
    words = (F.col(_SIZE) * F.col("n")).cast("decimal(38,0)")
    squares = (F.col(_SIZE) * F.col(_SIZE)).cast("decimal(28,0)") * F.col("n")
    falling = Window.partitionBy("source").orderBy(F.desc(_SIZE))
    larger = falling.rowsBetween(Window.unboundedPreceding, -1)
    rest = falling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    shares = counted.filter(F.col(_SIZE) > 0).withColumns(
        {
            "certain": F.coalesce(F.sum(words).over(larger), F.lit(0)).cast("double"),
            "squares": F.sum(squares.cast("decimal(38,0)")).over(rest).cast("double"),
        }
    )
    rated = (
        shares.alias("s")
        .join(goals.filter("quota > 0").alias("g"), same_as("s", "g"))
        .select(
            "s.source", _SIZE,
            ((F.col("quota") - F.col("certain")) / F.col("squares")).alias("rate"),
        )
    )
    # The largest size at which the rest of the quota makes no one certain.
    return (
        rated.filter(F.col("rate") * F.col(_SIZE) < 1)
        .groupBy("source")
        .agg(F.max(_SIZE).alias("limit"), F.max_by("rate", _SIZE).alias("rate"))
    )


def same_as(a: str, b: str) -> Column:
    """Sources of two aliased tables are equal, null being one of them."""
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def _bin(odds: Column | None = None) -> Column:
    odds = F.col(_ODDS) if odds is None else odds
    return F.least(F.floor(odds / (1 + odds) * BINS), F.lit(BINS - 1))


def _draw(
    odds: Column | None = None, name: Column | None = None, size: Column | None = None
) -> Column:
    """What documents of a source are ordered by."""
    return F.struct(
        (F.col(_ODDS) if odds is None else odds).alias("odds"),
        (F.col("doc_id") if name is None else name).alias("name"),
        (F.col(_SIZE) if size is None else size).alias("size"),
    )


def cuts(draws: DataFrame, goals: DataFrame, workspace: Workspace) -> DataFrame:
    """Per source with a quota where its sample ends: bin, last draw, and a filler.

    Documents of a source are ordered by random odds over inclusion odds; they
    join as long as the quota holds them. Words per range of odds are summed
    first, so only the range in which the quota ends is put in order. Of the
    others, the one whose size comes nearest to what is left of the quota joins
    too, if that is nearer than none. Equal draws join or stay together.
    """
    binned = draws.groupBy("source", _bin().alias("bin")).agg(F.sum(_SIZE).alias("words"))
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    binned = binned.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    ends = (
        binned.alias("b")
        .join(goals.alias("g"), same_as("b", "g"))
        .filter("before <= quota AND quota < before + words AND quota > 0")
        .select("b.source", "bin", "before", "quota")
    )
    units = draws.withColumn("bin", _bin()).groupBy("source", "bin", _DRAW).agg(
        F.sum(_SIZE).alias("words")
    )
    beyond = workspace.store(
        units.alias("d")
        .join(ends.alias("g"), same_as("d", "g") & (F.col("d.bin") >= F.col("g.bin")))
        .select(
            "d.source", "before", "quota", _DRAW, "words",
            (F.col("d.bin") == F.col("g.bin")).alias("inside"),
        ),
        "beyond",
    )
    upto = Window.partitionBy("source").orderBy(_DRAW).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    last = (
        beyond.filter("inside")
        .withColumn("upto", F.col("before") + F.sum("words").over(upto))
        .filter("upto <= quota")
        .groupBy("source")
        .agg(F.max(_DRAW).alias("last"), F.max("upto").alias("upto"))
    )
    left = beyond.alias("b").join(last.alias("l"), same_as("b", "l"), "left")
    gap = F.col("quota") - F.coalesce("upto", "before")
    off = F.abs(gap - F.col("words"))
    filler = (
        left.filter(F.col("last").isNull() | (F.col(_DRAW) > F.col("last")))
        .filter(off < gap)
        .groupBy("b.source")
        .agg(F.min(F.struct(off.alias("off"), F.col(_DRAW).alias("draw"))).alias("best"))
    )
    return (
        ends.alias("b")
        .join(last.alias("l"), same_as("b", "l"), "left")
        .join(filler.alias("f"), same_as("b", "f"), "left")
        .select("b.source", "b.bin", "l.last", F.col("best.draw").alias("filler"))
    )


def _rank(
    chance: Column, size: Column, odds: Column | None, limit: Column, rate: Column
) -> Column:
    """Random odds over inclusion odds; certain documents come first, at zero."""
    drawn = chance / (1 - chance)
    if odds is not None:
        return drawn / odds.cast("double")
    share = rate * size
    return (
        F.when(size > limit, F.lit(0.0))
        .when(share > 0, drawn / (share / (1 - share)))
        .otherwise(drawn)
    )


def with_mix(
    docs: DataFrame,
    workspace: Workspace,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: str = "mix",
    odds: Column | None = None,
    name: str = "mix",
) -> DataFrame:
    """``docs`` with a struct column: size, source_size, target, copies, taken.

    ``docs`` needs doc_id, text and source. Size is the number of words. Every
    document of a source is expected target / source_size times: the whole
    part is certain, and a sample of fixed size in words gets one copy more.
    For the sample documents are ranked by the odds of a random number over
    their inclusion odds: those of a probability in proportion to their size
    (``inclusion_rates``), or ``odds`` per document, which must be positive.
    The random number depends on seed and doc_id only, so reruns
    agree. A sample stays within its quota but for one document, chosen by size
    to come nearest to it.

    Null and blank texts have size 0 and take nothing; a null source is a
    source of its own, the last. Rows of one doc_id draw one number; equal
    ones join or stay together. Other columns pass, but one called ``name``; an
    empty table stays empty.
    """
    held, limit, rate = (free_name(docs, n) for n in ("__held", "__limit", "__rate"))
    content = word_count(F.col("text"))
    given = (F.lit(None) if odds is None else odds).cast("double")
    sized = workspace.store(
        docs.select("source", "doc_id", content.alias(_SIZE), given.alias("given")), "sizes"
    )
    goals = targets(sized.select("source", F.col(_SIZE).alias("size")), weights, most)
    goals = workspace.store(goals, "goals")
    rates = inclusion_rates(sized, goals) if odds is None else goals.selectExpr(
        "source", "0L AS limit", "0D AS rate"
    )
    of = free_name(docs, "__source")
    rates = workspace.store(rates, "rates").toDF(of, limit, rate)

    def ranked(df: DataFrame, size: Column, given: Column | None) -> DataFrame:
        """``df`` with a struct of size and rank."""
        known = df.join(rates, F.col("source").eqNullSafe(quoted(of)), "left")
        rank = _rank(uniform(F.col("doc_id"), seed), size, given, quoted(limit), quoted(rate))
        return known.select(*own(df), F.struct(size.alias(_SIZE), rank.alias(_ODDS)).alias(held))

    drawn = ranked(docs, content, odds)
    draws = ranked(sized, F.col(_SIZE), None if odds is None else F.col("given"))
    draws = draws.select("source", "doc_id", f"{held}.*").withColumn(_DRAW, _draw())
    draws = workspace.store(draws.drop("doc_id"), "draws")
    ends = cuts(draws, goals, workspace)
    plan = workspace.store(
        goals.alias("g")
        .join(ends.alias("e"), same_as("g", "e"), "left")
        .select("g.*", "e.bin", "e.last", "e.filler"),
        "plan",
    )
    size, odd = F.col(f"d.{held}.{_SIZE}"), F.col(f"d.{held}.{_ODDS}")
    draw = _draw(odd, F.col("d.doc_id"), size)
    first = (F.col("p.quota") > 0) & (
        F.when(F.col("p.bin").isNull(), True)
        .when(_bin(odd) < F.col("p.bin"), True)
        .when(_bin(odd) > F.col("p.bin"), False)
        .otherwise(F.coalesce(draw <= F.col("p.last"), F.lit(False)))
        | F.coalesce(draw == F.col("p.filler"), F.lit(False))
    )
    copies = F.col("p.copies") + first.cast("long")
    return (
        drawn.alias("d")
        .join(plan.alias("p"), same_as("d", "p"))
        .select(
            *[quoted(c, "d") for c in docs.columns if c != name],
            F.struct(
                size.alias("size"),
                F.col("p.source_size").alias("source_size"),
                F.col("p.target").alias("target"),
                copies.alias("copies"),
                (copies * size).alias("taken"),
            ).alias(name),
        )
    )


def mixed(docs: DataFrame, workspace: Workspace, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, its own columns only.

    A document without words is not taken.
    """
    name = free_name(docs, "__mix")
    found = with_mix(docs, workspace, name=name, **options)
    taken = found.filter(F.col(f"{name}.taken") > 0)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{name}.copies")))
    return taken.withColumn(free_name(found, "__time"), times).select(*own(docs))
