"""Line dedup by an exact set-similarity join of the lines' words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as w
from tidemark.llm.batches import bound_batches, tidy
from tidemark.llm.columns import free_name, quoted
from tidemark.workspace import Workspace

PERCENT = 80
#: Counters of token frequency: 2 MB are broadcast at any input size.
COUNTERS, PARTS = 1 << 21, 1024
_COUNTER_BITS = np.uint64(64 - 21)
#: Tokens that a bucket is planned for, in which lines meet that share a rare one.
BUCKET_TOKENS = 1 << 20
#: Earlier lines with the same rare token that every line is compared with.
REACH = 255
#: The largest bitmap of lines to look at again: 2**24 bits are 2 MB.
MOST_BITS = 24
#: Stands for a null doc_id, which comes first.
NULL_ID = np.iinfo(np.int64).min


class Lines:
    """Lines with a word of a slice, each with its distinct tokens in order of rarity."""

    def __init__(self, part: pa.RecordBatch, levels: np.ndarray | None = None):
        offsets, data = w.text_bytes(part["text"])
        found = w.find_words(offsets, data)
        start, end, bound = w.lines(offsets, data)
        first = np.searchsorted(found.start, start)
        count = np.searchsorted(found.start, end) - first
        owner = np.repeat(np.arange(len(bound) - 1), np.diff(bound))
        full = count > 0
        self.doc_id = part["doc_id"].fill_null(NULL_ID).to_numpy(zero_copy_only=False)[owner][full]
        self.number = (np.arange(len(start)) - bound[owner])[full].astype(np.int32)
        tokens = found.block_hashes()
        of = np.repeat(np.arange(len(self.number)), count[full])
        # One key sorts: line, rarity, and as many bits of the hash as are left.
        rarity = np.uint64(0)
        if levels is not None:
            rarity = levels[(tokens >> _COUNTER_BITS).astype(np.int64)].astype(np.uint64)
        bits = np.uint64(max(1, len(self.number)).bit_length())
        key = (rarity << np.uint64(56)) | (tokens >> np.uint64(8))
        order = np.argsort((of.astype(np.uint64) << (np.uint64(64) - bits)) | (key >> bits))
        tokens, of = tokens[order], of[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (of[1:] != of[:-1])
        self.tokens, self.of = tokens[new], of[new]
        self.size = np.bincount(self.of, minlength=len(self.number))
        self.first = np.cumsum(self.size) - self.size

    def __len__(self) -> int:
        return len(self.number)

    def classes(self) -> np.ndarray:
        """A name of each line's set: the sum of its mixed tokens."""
        if not len(self):
            return np.zeros(0, np.int64)
        return np.add.reduceat(w.mix(self.tokens, 5), self.first).view(np.int64)

    def bits(self) -> tuple[np.ndarray, np.ndarray]:
        """A bitmap of 128 bits of each line's tokens, as two halves."""
        one = np.uint64(1) << ((self.tokens >> np.uint64(20)) & np.uint64(63))
        upper = ((self.tokens >> np.uint64(26)) & np.uint64(1)) == 1
        halves = np.where(upper, np.uint64(0), one), np.where(upper, one, np.uint64(0))
        if not len(self):
            return halves
        return tuple(np.bitwise_or.reduceat(h, self.first) for h in halves)


def _blobs(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    """Rows of a bucket number and packed arrays."""
    columns = [[r[0] for r in rows], *([r[k].tobytes() for r in rows] for k in range(1, len(names)))]
    kinds = [pa.int32(), *[pa.binary()] * (len(names) - 1)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line with its class, and at the end how often tokens occur, in PARTS pieces."""
    counts = np.zeros(COUNTERS, np.int64)

    def rows(doc_id, line, name, part, raw):
        return pa.record_batch(
            {
                "doc_id": pa.array(doc_id, pa.int64(), mask=doc_id == NULL_ID),
                "line": pa.array(line, pa.int32()),
                "class": pa.array(name, pa.int64()),
                "part": pa.array(part, pa.int32()),
                "counts": pa.array(raw, pa.binary()),
            }
        )

    for batch in batches:
        for piece in w.slices(batch, "text"):
            lines = Lines(piece)
            at = (lines.tokens >> _COUNTER_BITS).astype(np.int64)
            np.add.at(counts, at, 1)
            none = [None] * len(lines)
            yield rows(lines.doc_id, lines.number, lines.classes(), none, none)
    if counts.any():
        pieces = [p.tobytes() for p in counts.reshape(PARTS, -1).astype(np.uint32)]
        zero = np.zeros(PARTS, np.int64)
        yield rows(zero, zero, zero, np.arange(PARTS), pieces)


def _levels(survey: DataFrame) -> tuple[np.ndarray, int]:
    """Per counter the logarithm of how many tokens it counts, in quarters, and the
    number of all tokens. A counter of one is at level 0."""

    def add(key, table):
        total = sum(np.frombuffer(x.as_py(), np.uint32).astype(np.int64) for x in table["counts"])
        return pa.table({"part": table["part"][:1], "counts": pa.array([total.tobytes()])})

    pieces = survey.filter("part IS NOT NULL").select("part", "counts")
    sums = pieces.groupBy("part").applyInArrow(add, "part int, counts binary").toArrow()
    counts = np.zeros((PARTS, COUNTERS // PARTS), np.int64)
    for part, raw in zip(sums["part"].to_pylist(), sums["counts"], strict=True):
        counts[part] = np.frombuffer(raw.as_py(), np.int64)
    return (4 * np.log2(np.maximum(counts.ravel(), 1))).astype(np.uint8), int(counts.sum())


_POSTING = ["bucket", "token", "doc_id", "line", "n", "pos", "bits", "more", "name"]
_KINDS = [np.uint32, np.int64, np.int32, np.uint32, np.uint32, np.uint64, np.uint64, np.int64]


def _postings(levels, percent: int, bucket_bits: int):
    """Per slice and bucket the rarest tokens of lines, of which linked ones share one.

    Of the lines of a slice with one set only the first is sent. Sets of a few
    tokens link with equal ones alone and are left out, and so are tokens that
    occur once.
    """
    smallest = -(-percent // (100 - percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in w.slices(batch, "text"):
                lines = Lines(piece, levels.value)
                classes = lines.classes()
                place = np.lexsort((lines.number, lines.doc_id))
                _, once = np.unique(classes[place], return_index=True)
                chosen = np.zeros(len(lines), bool)
                chosen[place[once]] = True
                chosen &= lines.size >= smallest
                pos = np.arange(len(lines.of)) - lines.first[lines.of]
                prefix = lines.size - -(-percent * lines.size // 100) + 1
                rare = chosen[lines.of] & (pos < prefix[lines.of])
                rare &= levels.value[(lines.tokens >> _COUNTER_BITS).astype(np.int64)] > 0
                sent = np.flatnonzero(rare)
                if not len(sent):
                    continue
                of, tokens = lines.of[sent], lines.tokens[sent]
                bucket = tokens >> np.uint64(64 - bucket_bits)
                bits, more = lines.bits()
                order = np.argsort(bucket, kind="stable")
                of, tokens, bucket = of[order], tokens[order], bucket[order]
                columns = [
                    tokens & np.uint64(0xFFFFFFFF), lines.doc_id[of], lines.number[of],
                    lines.size[of], pos[sent][order], bits[of], more[of], classes[of],
                ]
                columns = [c.astype(k) for c, k in zip(columns, _KINDS, strict=True)]
                cuts = np.flatnonzero(np.diff(bucket, prepend=np.uint64(1 << bucket_bits)))
                ends = np.append(cuts[1:], len(bucket))
                rows = [
                    (int(bucket[a]), *[c[a:b] for c in columns])
                    for a, b in zip(cuts, ends, strict=True)
                ]
                yield _blobs(_POSTING, rows)

    return run


_FOUND = (
    "name long, other long, common long, other_id long, token long, rank long, doc_id long, line int, "
    "n long, pos long, bits long, more long, open boolean"
)


def _passing(seat: dict, a: np.ndarray, b: np.ndarray, percent: int):
    """Which pairs of places pass, and the most tokens that each of those can share.

    Length, positional and bitmap filters; bitmaps of the pairs only that pass the others.
    """
    na, nb = seat["n"][a], seat["n"][b]
    left = np.minimum(na - seat["pos"][a], nb - seat["pos"][b])
    need = percent * (na + nb)
    sizes = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
    at = np.flatnonzero(sizes & (left * (100 + percent) >= need))
    a, b = a[at], b[at]
    misses_a, misses_b = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for k in ("bits", "more"):
        x, y = seat[k][a], seat[k][b]
        misses_a += np.bitwise_count(x & ~y)
        misses_b += np.bitwise_count(y & ~x)
    common = np.minimum(left[at], np.minimum(na[at] - misses_a, nb[at] - misses_b))
    passed = common * (100 + percent) >= need[at]
    return at[passed], common[passed]


def _first_of_each(seat: dict) -> dict:
    """Of lines with one set the first stands for all; in order of token and place."""
    order = np.lexsort((seat["line"], seat["doc_id"], seat["token"]))
    token, name = seat["token"][order], seat["name"][order]
    by_set = np.lexsort((name, token))
    token, name = token[by_set], name[by_set]
    once = np.ones(len(order), bool)
    once[1:] = (token[1:] != token[:-1]) | (name[1:] != name[:-1])
    order = order[np.sort(by_set[once])]
    return {k: v[order] for k, v in seat.items()}


def _meet(table: pa.Table, percent: int, reach: int) -> pa.Table:
    """Pairs of a bucket to verify, and the places of tokens for which that may not do.

    Every line is compared with the ``reach`` lines before it that have the
    same token. Of those that pass the filters, the one that may have most in
    common is told with both documents, and the first line of all where there are more than
    ``reach``. A line with further ones is open; of the tokens of open lines
    every place is told as well (other is null). Lines go by the names of their
    sets, for each of which its first line stands.
    """
    seat = _first_of_each(
        {
            name: np.concatenate([np.frombuffer(x.as_py(), kind) for x in table[name]])
            for name, kind in zip(_POSTING[1:], _KINDS, strict=True)
        }
    )
    seat |= {k: seat[k].astype(np.int64) for k in ("n", "pos")}
    new = np.ones(len(seat["token"]), bool)
    new[1:] = seat["token"][1:] != seat["token"][:-1]
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    rank = np.arange(len(new)) - starts[group]

    def taken(at):
        return {k: v[at] for k, v in seat.items()}

    found = np.zeros(len(new), np.int64)
    most, best = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
    later = np.arange(len(new))
    for back in range(1, reach + 1):
        later = later[rank[later] >= back]
        if not len(later):
            break
        at, common = _passing(seat, later, later - back, percent)
        a = later[at]
        found[a] += 1
        more = common > most[a]
        most[a[more]], best[a[more]] = common[more], a[more] - back
    far = np.flatnonzero(rank > reach)
    at, first = _passing(seat, far, starts[group[far]], percent)
    some, far = np.flatnonzero(found), far[at]
    a = np.concatenate([some, far])
    b = np.concatenate([best[some], starts[group[far]]])
    common = np.concatenate([most[some], first])
    # Lines at one place of repeated documents are no match for each other.
    apart = (seat["doc_id"][a] != seat["doc_id"][b]) | (seat["line"][a] != seat["line"][b])
    a, b, common = a[apart], b[apart], common[apart]
    order = np.lexsort((common, seat["name"][b], seat["name"][a]))
    a, b, common = a[order], b[order], common[order]
    name, other = seat["name"][a], seat["name"][b]
    once = np.ones(len(order), bool)
    once[1:] = (name[1:] != name[:-1]) | (other[1:] != other[:-1])
    a, b, name, other, common = (x[once] for x in (a, b, name, other, common))
    open_ = (found > 1) | (rank > reach)
    crowd = np.flatnonzero(np.bitwise_or.reduceat(open_, starts)[group] if len(new) else new)
    own = taken(crowd)
    bucket = table["bucket"][0].as_py()

    def column(first, second, kind):
        return pa.concat_arrays([pa.array(first, kind), pa.array(second, kind)])

    no_pair, no_place = [None] * len(crowd), [None] * len(name)
    place = {
        "token": own["token"].astype(np.int64) + (bucket << 32),
        "rank": rank[crowd],
        "line": own["line"].astype(np.int64),
        "n": own["n"].astype(np.int64),
        "pos": own["pos"].astype(np.int64),
        "bits": own["bits"].view(np.int64),
        "more": own["more"].view(np.int64),
        "open": open_[crowd],
    }
    kinds = {"line": pa.int32(), "open": pa.bool_()}
    return pa.table(
        {
            "name": column(name, own["name"], pa.int64()),
            "other": column(other, no_pair, pa.int64()),
            "common": column(common, no_pair, pa.int64()),
            "other_id": column(seat["doc_id"][b], no_pair, pa.int64()),
            "doc_id": column(seat["doc_id"][a], own["doc_id"], pa.int64()),
            **{k: column(no_place, v, kinds.get(k, pa.int64())) for k, v in place.items()},
        }
    )


_PLACE = ["token", "name", "rank", "doc_id", "line", "n", "pos", "bits", "more"]


def _before(percent: int):
    """Whether a line b of the same token is before line a, and the two pass the filters."""

    def a(name):
        return F.col(f"a.{name}")

    def b(name):
        return F.col(f"b.{name}")

    def misses(x, y):
        return sum(F.bit_count(x(k).bitwiseAND(F.bitwise_not(y(k)))) for k in ("bits", "more"))

    left = F.least(a("n") - a("pos"), b("n") - b("pos"))
    common = F.least(left, a("n") - misses(a, b), b("n") - misses(b, a))
    return (
        (a("token") == b("token"))
        & (a("name") != b("name"))
        & (b("rank") < a("rank"))
        & ((a("doc_id") != b("doc_id")) | (a("line") != b("line")))
        & (100 * F.least(a("n"), b("n")) >= percent * F.greatest(a("n"), b("n")))
        & (common * (100 + percent) >= percent * (a("n") + b("n")))
    )


def _candidates(
    places: DataFrame, near: DataFrame, workspace: Workspace, percent: int
) -> DataFrame:
    """Open lines that are still there and have a line before them that passes the filters
    (``late``), and all such lines. Each comes once per token, however many others it
    meets there."""
    open_ = places.filter("open").join(near, "name", "left_anti").select(*_PLACE).alias("a")
    all_ = places.select(*_PLACE).alias("b")
    later = open_.join(all_, _before(percent), "left_semi").withColumn("late", F.lit(True))
    earlier = all_.join(open_, _before(percent), "left_semi").withColumn("late", F.lit(False))
    # In one job, so that both joins read the same shuffled places.
    return workspace.store(later.unionByName(earlier), "candidates")


def _matching(candidates: DataFrame, near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Names of late lines that are still there and match one before them on whole sets."""
    later = candidates.filter("late").join(near, "name", "left_anti").join(sets, "name")
    earlier = candidates.filter("NOT late").join(sets, "name")
    common = F.size(F.array_intersect("a.tokens", "b.tokens"))
    enough = common * (100 + percent) >= percent * (F.col("a.n") + F.col("b.n"))
    same = _before(percent) & enough
    return later.alias("a").join(earlier.alias("b"), same, "left_semi").select("name")


def _slots(names: np.ndarray, bits: int) -> np.ndarray:
    return (w.mix(names.view(np.uint64), 3) >> np.uint64(64 - bits)).astype(np.int64)


def _bitmap(ends: DataFrame, count: int) -> tuple[int, np.ndarray]:
    """A bitmap of hashed names of sets, sixteen bits for each up to MOST_BITS in all."""
    bits = min(MOST_BITS, max(10, (16 * count).bit_length()))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _slots(batch["name"].to_numpy(), bits)
            yield pa.record_batch({"word": pa.array(at >> 6), "bit": pa.array(at & 63)})

    found = (
        ends.mapInArrow(tidy(slots), "word long, bit long")
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bits, bitmap.view(np.uint64)


def _hit(wanted: tuple[int, np.ndarray], names: np.ndarray) -> np.ndarray:
    bits, bitmap = wanted
    at = _slots(names, bits)
    return ((bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)) == 1


def _sets(wanted):
    """Sets of the lines that the bitmaps of names and documents let pass, once per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_, docs = wanted.value
        for batch in batches:
            doc_id = batch["doc_id"].fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(_hit(docs, doc_id)))
            for piece in w.slices(batch, "text"):
                lines = Lines(piece)
                names, once = np.unique(lines.classes(), return_index=True)
                hit = _hit(names_, names)
                names, once = names[hit], once[hit]
                spans = zip(lines.first[once], lines.first[once] + lines.size[once], strict=True)
                yield pa.record_batch(
                    {
                        "name": pa.array(names),
                        "tokens": pa.array(
                            [lines.tokens[a:b].view(np.int64) for a, b in spans],
                            pa.list_(pa.int64()),
                        ),
                    }
                )

    return run


def _sets_of(docs: DataFrame, lines: DataFrame, workspace: Workspace) -> DataFrame:
    """The sets of ``lines`` (name, doc_id), read from their documents again: name, tokens."""
    lines = workspace.store(lines.select("name", "doc_id").distinct(), "wanted")
    names, ids = lines.select("name"), lines.select(F.col("doc_id").alias("name")).distinct()
    wanted = _bitmap(names, lines.count()), _bitmap(ids, ids.count())
    chosen = docs.sparkSession.sparkContext.broadcast(wanted)
    sets = docs.mapInArrow(tidy(_sets(chosen)), "name long, tokens array<long>")
    sets = workspace.store(
        sets.join(names, "name", "left_semi").dropDuplicates(["name"]), "sets"
    )
    chosen.unpersist()
    return sets


def _ends(pairs: DataFrame) -> DataFrame:
    other = pairs.select(F.col("other").alias("name"), F.col("other_id").alias("doc_id"))
    return pairs.select("name", "doc_id").unionByName(other)


def _verified(pairs: DataFrame, sets: DataFrame, workspace: Workspace, percent: int) -> DataFrame:
    """The later lines of pairs whose Jaccard similarity reaches ``percent``.

    Pairs get both sets by name, so nothing but a pair is ever in one place.
    """
    one = sets.select(F.col("name"), F.col("tokens").alias("a"))
    two = sets.select(F.col("name").alias("other"), F.col("tokens").alias("b"))
    both = pairs.select("name", "other").join(one, "name").join(two, "other")
    common = F.size(F.array_intersect("a", "b"))
    enough = common * (100 + percent) >= percent * (F.size("a") + F.size("b"))
    return workspace.store(both.filter(enough).select("name").distinct(), "near")


def repeated_lines(
    docs: DataFrame, workspace: Workspace, percent: int = PERCENT, reach: int = REACH
) -> DataFrame:
    """Lines to remove, of all lines with a word: doc_id, line, exact, near.

    ``docs`` needs doc_id and text. A line's set are its distinct words; two
    lines match when 100 * common >= percent * all of them. Every line goes
    that matches any line before it, in the order of doc_id (null first) and
    line number from 0: ``exact`` if one of them has the same set, else
    ``near``. Lines without a word stay; other columns are ignored.

    Null texts have no lines. Rows of one doc_id are one document; lines at
    one place of it are no match for each other. An empty table gives no rows.

    Words are counted over all documents; a line's prefix are its rarest
    words, of which it must share one with any match. Lines meet by those, pass
    length, positional and bitmap filters, and are verified on their whole sets.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    survey = workspace.store(
        docs.mapInArrow(
            tidy(_survey), "doc_id long, line int, class long, part int, counts binary"
        ),
        "survey",
    )
    counted, tokens = _levels(survey)
    levels = docs.sparkSession.sparkContext.broadcast(counted)
    bucket_bits = min(24, max(6, (tokens // BUCKET_TOKENS).bit_length()))
    found = (
        docs.mapInArrow(
            tidy(_postings(levels, percent, bucket_bits)),
            "bucket int, " + ", ".join(f"{c} binary" for c in _POSTING[1:]),
        )
        .groupBy("bucket")
        .applyInArrow(lambda key, table: _meet(table, percent, reach), _FOUND)
    )
    found = workspace.store(found, "found")
    levels.unpersist()
    pairs = found.filter("other IS NOT NULL")
    # Lines that share many tokens meet by each: once per pair goes on.
    pairs = pairs.groupBy("name", "other").agg(
        *[F.max(c).alias(c) for c in ("common", "doc_id", "other_id")]
    )
    pairs = workspace.store(pairs, "pairs")
    # Of each line's candidates the one that may share most comes first.
    best = pairs.groupBy("name").agg(
        F.max(F.struct("common", "other", "doc_id", "other_id")).alias("p")
    )
    best = workspace.store(best.select("name", "p.*").drop("common"), "best")
    near = _verified(best, _sets_of(docs, _ends(best), workspace), workspace, percent)
    # Then all of those that are still there, also beyond what was looked at.
    others = pairs.drop("common").join(near, "name", "left_anti")
    others = workspace.store(others.join(best, ["name", "other"], "left_anti"), "others")
    candidates = _candidates(found.filter("other IS NULL"), near, workspace, percent)
    lines = _ends(others).unionByName(candidates.select("name", "doc_id"))
    if not lines.isEmpty():
        sets = _sets_of(docs, lines, workspace)
        near = near.unionByName(_verified(others, sets, workspace, percent))
        rest = _matching(candidates, near, sets, percent)
        near = near.unionByName(workspace.store(rest.distinct(), "rest"))
    near = near.distinct().select(F.col("name").alias("class"), F.lit(True).alias("hit"))
    named = survey.filter("part IS NULL").select("doc_id", "line", "class")
    firsts = named.groupBy("class").agg(F.min(F.struct("doc_id", "line")).alias("first"))
    same = F.col("first") < F.struct("doc_id", "line")
    sets = firsts.join(near, "class", "left")
    return named.join(sets, "class").select(
        "doc_id", "line", same.alias("exact"),
        (~same & F.coalesce("hit", F.lit(False))).alias("near"),
    )


def summary(lines: DataFrame) -> DataFrame:
    """Per document with a word: its lines, those removed, and their numbers."""
    goes = F.col("exact") | F.col("near")
    removed = F.sort_array(F.collect_list(F.when(goes, F.col("line"))))
    return lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("exact")).alias("n_exact"),
        F.count_if(F.col("near")).alias("n_near"),
        F.array_join(removed.cast("array<string>"), ",").alias("removed"),
    )


def without_repeated_lines(docs: DataFrame, workspace: Workspace, **options) -> DataFrame:
    """``docs`` with the lines to remove cut from their texts, in all columns they had."""
    lines = repeated_lines(docs, workspace, **options).filter("exact OR near")
    doc, cut = free_name(docs, "__doc"), free_name(docs, "__cuts")
    cuts = lines.groupBy(F.col("doc_id").alias(doc)).agg(F.collect_set("line").alias(cut))
    cuts = workspace.store(cuts, "cuts")
    joined = docs.join(cuts, docs["doc_id"].eqNullSafe(cuts[doc]), "left")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col(cut), i))
    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[text.alias(c) if c == "text" else quoted(c) for c in docs.columns])
