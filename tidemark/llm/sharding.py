"""Sharding: balanced label propagation under row quotas, in DataFrame operations."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.workspace import Workspace

SHARDS = 40
#: Ranges of a 64-bit hash in which rows are ranked; what is broadcast has this
#: many rows per shard.
RANGES = 256
#: Groups of more than this part of a shard are placed first.
LARGE = 8
_KEY, _ORDER, _LINKED = "__key", "__order", "__linked"


def _range(order: Column) -> Column:
    """Which of RANGES parts of all hashes this one is in."""
    return F.shiftright(order, 56) + 128


def ranked(df: DataFrame, within: list[str], ties: list[str], rank: str) -> DataFrame:
    """Add a gapless rank from 0, by hash and then ``ties``, among equal ``within``.

    Rows are counted by range of the hash first, so that a rank is the place in
    a range plus the counts of the ranges before; no window holds more than
    one range of one group.
    """
    by = df.withColumn("__range", _range(F.col(_ORDER)))
    counts = by.groupBy(*within, "__range").agg(F.count(F.lit(1)).alias("__n"))
    earlier = (
        Window.partitionBy(*within).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    inside = Window.partitionBy(*within, "__range").orderBy(_ORDER, *ties)
    return (
        by.withColumn("__place", F.row_number().over(inside) - 1)
        .join(F.broadcast(counts), [*within, "__range"])
        .withColumn(rank, F.col("__before") + F.col("__place"))
        .drop("__range", "__n", "__before", "__place")
    )


def _pick(values: dict[int, int], key: Column, default: int = 0) -> Column:
    """The value a small table of the driver has for a key."""
    if not values:
        return F.lit(default).cast("long")
    table = F.create_map(*[F.lit(x) for k, v in values.items() for x in (int(k), int(v))])
    return F.coalesce(F.element_at(table, key), F.lit(default)).cast("long")


def _seats(state: DataFrame) -> DataFrame:
    """Per group in several shards: its rows, its main shard, and its rows by shard.

    The main shard holds most of the group; a hash settles ties, so that groups
    do not all turn to the same shards.
    """
    votes = state.filter(_LINKED).groupBy(_KEY, "shard").agg(F.count(F.lit(1)).alias("n"))
    seat = F.struct("n", F.xxhash64(_KEY, "shard").alias("tie"), "shard")
    groups = votes.groupBy(_KEY).agg(
        F.sum("n").alias("total"),
        F.max(seat).alias("main"),
        # At most one entry per shard.
        F.collect_list(seat).alias("seats"),
    )
    return groups.filter(F.size("seats") > 1)


def _whole_moves(seats: DataFrame, room: dict[int, int], turn: int) -> DataFrame:
    """Per group the shard of its own where all of it finds room: that with most of it.

    Groups are taken in an order that differs by ``turn``. The driver sees sums
    by shard and range of a hash only.
    """

    def needs(seat: Column) -> Column:
        # Elsewhere than in its main shard, a group's rows there are room it takes too.
        at_home = seat["shard"] == F.col("main.shard")
        return F.col("total") - F.when(at_home, seat["n"]).otherwise(0)

    best = F.array_max(F.filter("seats", lambda s: _pick(room, s["shard"]) >= needs(s)))
    wished = (
        seats.withColumn("best", best)
        .withColumn("n", needs(F.col("best")))
        .withColumn("lot", F.xxhash64(_KEY, F.lit(turn)))
        .select(
            _KEY, F.col("main.shard").alias("main"), F.col("best.shard").alias("to"),
            "n", "lot", _range(F.col("lot")).alias("part"),
        )
    )
    sums = wished.filter("to IS NOT NULL").groupBy("to", "part").agg(F.sum("n").alias("n"))
    before: dict[int, int] = {}
    taken: dict[int, int] = {}
    for to, part, n in sorted(map(tuple, sums.collect())):
        before[to * RANGES + part] = taken.get(to, 0)
        taken[to] = taken.get(to, 0) + n
    upto = F.sum("n").over(
        Window.partitionBy("to", "part").orderBy("lot", _KEY).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
    )
    start = wished.sparkSession.createDataFrame(
        [(k // RANGES, k % RANGES, n) for k, n in before.items()], "to int, part long, before long"
    )
    fits = F.col("before") + F.col("upto") <= _pick(room, F.col("to"))
    return (
        wished.withColumn("upto", upto)
        .join(F.broadcast(start), ["to", "part"], "left")
        .select(_KEY, "main", F.when(fits, F.col("to")).alias("to"))
    )


def _one_round(
    state: DataFrame, workspace: Workspace, ties: list[str], whole: bool, turn: int
) -> DataFrame | None:
    """Move linked rows under the quotas, and as many others back; None if none moves.

    A shard can give back its rows without links, and rows of groups whose main
    shard is another: these lose nothing anywhere. It takes no more than that.
    Groups move as a whole to where all of them fits, or else row by row to their
    main shard. So the rows in main shards get more with every round. The driver
    sees counts by pairs of shards and ranges of a hash only.
    """
    seats = workspace.store(_seats(state), "seats")
    away = (
        seats.select("main", F.explode("seats").alias("seat"))
        .filter("seat.shard <> main.shard")
        .groupBy("seat.shard")
        .agg(F.sum("seat.n").alias("n"))
    )
    room: dict[int, int] = {}
    for free in (away, state.filter(~F.col(_LINKED)).groupBy("shard").agg(F.count(_KEY))):
        for shard, n in free.collect():
            room[shard] = room.get(shard, 0) + n
    if whole:
        moves = _whole_moves(seats, room, turn)
    else:
        moves = seats.select(_KEY, F.col("main.shard").alias("main"))
        moves = moves.withColumn("to", F.col("main"))
    rows = state.join(moves, _KEY, "left")
    rows = rows.withColumn("to", F.when(F.col("to") != F.col("shard"), F.col("to")))
    if not whole:
        movers = ranked(rows.filter("to IS NOT NULL"), ["to"], ties, "place")
        goes = F.when(F.col("place") < _pick(room, F.col("to")), F.col("to"))
        movers = movers.withColumn("to", goes).drop("place")
        rows = movers.unionByName(rows.filter("to IS NULL"))
    rows = workspace.store(rows, "proposals")
    accepted = rows.filter("to IS NOT NULL").groupBy("shard", "to").count().collect()
    if not accepted:
        return None
    surplus: dict[int, int] = {}
    for m in accepted:
        surplus[m["to"]] = surplus.get(m["to"], 0) + m["count"]
        surplus[m["shard"]] = surplus.get(m["shard"], 0) - m["count"]
    give, at = {}, 0
    for shard, n in sorted(surplus.items()):
        if n > 0:
            give[shard], at = (at, n), at + n
    # Rows whose whole group has moved are at home, or on their way.
    free = F.col("to").isNull() & (
        ~F.col(_LINKED) | F.coalesce(F.col("main") != F.col("shard"), F.lit(False))
    )
    if whole:
        moved = moves.filter("to IS NOT NULL").select(_KEY, F.lit(True).alias("moved"))
        rows = rows.join(moved, _KEY, "left")
        free &= F.col("moved").isNull()
    others = ranked(rows.filter(free), ["shard"], ties, "place")
    turn_ = F.when(
        F.col("place") < _pick({s: n for s, (_, n) in give.items()}, F.col("shard")),
        F.col("place") + _pick({s: a for s, (a, _) in give.items()}, F.col("shard")),
    )
    target, at = F.col("shard"), 0
    for shard, n in sorted(surplus.items()):
        if n < 0:
            target = F.when((turn_ >= at) & (turn_ < at - n), F.lit(shard)).otherwise(target)
            at -= n
    others = others.withColumn("shard", target.cast("int"))
    linked = rows.filter(~free).withColumn("shard", F.coalesce("to", "shard").cast("int"))
    return workspace.store(
        linked.select(*state.columns).unionByName(others.select(*state.columns)), "state"
    )


def _seeds(large: DataFrame, left: list[int]) -> dict[int, int]:
    """Shards for large groups, each where it fills most of the places left.

    The driver sees LARGE groups per shard at most. ``left`` loses the places
    taken; a group that fits nowhere starts like other rows.
    """
    groups = large.groupBy(_KEY).count().collect()
    seeds = {}
    for n, key in sorted(((g["count"], g[_KEY]) for g in groups), reverse=True):
        fitting = [(free, s) for s, free in enumerate(left) if free >= n]
        if fitting:
            _, seeds[key] = min(fitting)
            left[seeds[key]] -= n
    return seeds


def shard_rows(
    docs: DataFrame, workspace: Workspace, shards: int = SHARDS, rounds: int | None = None
) -> DataFrame:
    """Documents with shard and slot: doc_id, size, text_crc32, shard, slot.

    ``docs`` needs doc_id and text; other columns are ignored. Documents with
    equal texts are linked. Shards differ by one row at most, and slots count
    from 0 without gaps in each. Size is the UTF-8 bytes of the text plus 16.

    Groups of more than an eighth of a shard are placed first, the largest
    foremost; one of more than a shard is cut into parts of a shard. Other rows
    start in shards by rank of a hash of doc_id and text. In each round
    groups move to the shard that holds most of them, as far as that shard has
    rows to give in return: rows without links, and rows of groups that are
    mostly elsewhere. These fill the places left. First groups move as a whole,
    then row by row, until no row moves any more or ``rounds`` of each kind are
    over.

    A null text counts as empty, and equals other empty ones; null doc_ids are
    one hash key. Repeated rows are documents of their own. An empty table
    gives no rows, and fewer rows than shards leave shards empty.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("__text"),
    ).withColumn(_ORDER, F.xxhash64("doc_id", "__text"))
    base = workspace.store(base, "documents")
    ties = ["doc_id", "__text", "size", "text_crc32"]
    count = base.count()
    most = max(1, count // shards)
    group = ["__text", "text_crc32", "size"]
    sizes = base.groupBy(*group).agg(F.count(F.lit(1)).alias("__copies")).filter("__copies > 1")
    known = base.join(sizes, group, "left")
    above = F.coalesce(F.col("__copies") > most, F.lit(False))
    cut = ranked(known.filter(above), group, ties, "__rank")
    known = known.filter(~above).withColumn("__rank", F.lit(0).cast("long")).unionByName(cut)
    known = known.withColumns(
        {
            _LINKED: F.col("__copies").isNotNull(),
            _KEY: F.xxhash64(*group, F.floor(F.col("__rank") / most)),
        }
    )
    known = workspace.store(known.select(*ties, _ORDER, _LINKED, _KEY, "__copies"), "known")
    left = [count // shards + (s < count % shards) for s in range(shards)]
    seeds = _seeds(known.filter(F.col("__copies") > most // LARGE), left)
    known = known.withColumn("shard", _pick(seeds, F.col(_KEY), -1).cast("int"))
    known = known.drop("__copies")
    others = ranked(
        known.filter("shard < 0").withColumn("__all", F.lit(0)), ["__all"], ties, "__rank"
    )
    shard, at = F.lit(0), 0
    for n in left[:-1]:
        at += n
        shard += (F.col("__rank") >= at).cast("int")
    others = others.withColumn("shard", shard).drop("__all", "__rank")
    state = workspace.store(known.filter("shard >= 0").unionByName(others), "state")
    for whole in (True, False):
        for turn in itertools.count() if rounds is None else range(rounds):
            moved = _one_round(state, workspace, ties, whole, turn)
            if moved is None:
                break
            state = moved
    return ranked(state, ["shard"], ties, "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )


def cut_copies(placed: DataFrame) -> DataFrame:
    """Per group of equal texts: rows, shards they are in, and rows of its main shard."""
    by = placed.groupBy("text_crc32", "size", "shard").agg(F.count(F.lit(1)).alias("n"))
    return by.groupBy("text_crc32", "size").agg(
        F.sum("n").alias("copies"), F.count("shard").alias("shards"), F.max("n").alias("main")
    )
