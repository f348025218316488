"""Conversation structure repair: the cheapest edits that make turns alternate.

After the repair, the initials of the roles read ``(s?(ua)+)?``: an optional system
turn, then user and assistant turns in pairs. A turn is kept, given the role user or
assistant, or deleted; empty turns may be inserted anywhere. Blank turns and turns that
an earlier one repeats must go; a truncated turn that stays costs one.

The cheapest edits are found by a Viterbi search over four states: nothing yet, after a
system, a user, an assistant turn. Each state has one survivor, the cheapest edits so
far that end in it; of equally cheap ones the least audit text, for which the complete
unresolved suffixes are compared. Survivors are leaves of a tree of back pointers whose
nodes count their references. Once the root has one child, all survivors agree on the
edit there: it is given out, and the child is the root. So memory holds the turns the
survivors disagree on, usually one or two, and runs of deletions take one node. Only
where the end decides between ties, as in user turns alone (by their number), all turns
from there on are held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import bound_batches, tidy
from tidemark.llm.columns import quoted
from tidemark.workspace import Workspace

BLANK = " \t\n\x0b\x0c\r"
NOT_BLANK = "[^\\x20\\x09-\\x0D]"
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
# Costs of the edits, and of a truncated turn that stays.
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
ROLES = {"u": "user", "a": "assistant"}

START, SYSTEM, USER, ASSISTANT = range(4)
#: Which initials may follow a state, and the state after them.
FOLLOWS = (
    {"s": SYSTEM, "u": USER},
    {"u": USER},
    {"a": ASSISTANT},
    {"u": USER},
)
#: The one initial that a new role or an inserted turn can have in a state.
NEXT = ("u", "u", "a", "u")


class Node:
    """An edit behind those of its parent; ``count`` deletions in a row are one node."""

    __slots__ = ("parent", "edit", "count", "role", "text", "refs")

    def __init__(self, parent, edit, role=None, text=None):
        self.parent, self.edit, self.count = parent, edit, 1
        self.role, self.text, self.refs = role, text, 0


class _Offer:
    """A candidate for a survivor; its parent is a node, or an offer of this turn."""

    __slots__ = ("cost", "parent", "edit", "role", "text", "node")

    def __init__(self, cost, parent, edit, role=None, text=None):
        self.cost, self.parent, self.edit = cost, parent, edit
        self.role, self.text, self.node = role, text, None


def _audit(of) -> str:
    """The edits from behind the root up to a node or an offer."""
    out = []
    while isinstance(of, _Offer):
        out.append(of.edit)
        of = of.parent
    while of is not None:
        out.append(of.edit * of.count)
        of = of.parent
    return "".join(reversed(out))


def _better(new: _Offer, old: _Offer | None) -> bool:
    if old is None or new.cost != old.cost:
        return old is None or new.cost < old.cost
    return _audit(new) < _audit(old)


class Search:
    """Reads one conversation turn by turn and gives out settled edits.

    ``emit(edit, count, role, text)`` gets them in order; role and text are those of
    the turn that stays, and None for deletions.
    """

    def __init__(self, emit: Callable[[str, int, str | None, str | None], None]):
        self.emit = emit
        self.root = Node(None, "")
        self.root.refs = 1
        self.survivors = {START: (0, self.root)}
        first = _Offer(0, self.root, "")
        self._advance({START: first}, first)

    def read(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        offers: dict[int, _Offer] = {}

        def offer(state: int, *edit) -> None:
            new = _Offer(*edit)
            if _better(new, offers.get(state)):
                offers[state] = new

        more = TRUNCATED if truncated else 0
        for state, (cost, node) in self.survivors.items():
            offer(state, cost + COSTS[DELETE], node, DELETE)
            if must_go:
                continue
            after = FOLLOWS[state].get(role[:1])
            if after is not None:
                offer(after, cost + more, node, KEEP, role, text)
            fit = NEXT[state]
            offer(FOLLOWS[state][fit], cost + COSTS[REROLE] + more, node, REROLE, ROLES[fit], text)
        self._advance(offers)

    def close(self) -> int:
        """Give out the rest; the cost of all edits."""
        ends = [self.survivors[s] for s in (START, ASSISTANT) if s in self.survivors]
        cost, node = min(ends, key=lambda end: (end[0], _audit(end[1])))
        way = []
        while node is not self.root:
            way.append(node)
            node = node.parent
        for node in reversed(way):
            self.emit(node.edit, node.count, node.role, node.text)
        return cost

    def unresolved(self) -> int:
        """Nodes of the tree below its root."""
        seen = set()
        for _, node in self.survivors.values():
            while node is not self.root and id(node) not in seen:
                seen.add(id(node))
                node = node.parent
        return len(seen)

    def _advance(self, offers: dict[int, _Offer], first: _Offer | None = None) -> None:
        # Insertions cost something, so cheap states are final before dear ones.
        for _ in range(2):
            for state in sorted(offers, key=lambda s: offers[s].cost):
                fit = NEXT[state]
                after = FOLLOWS[state][fit]
                new = _Offer(
                    offers[state].cost + COSTS[INSERT], offers[state], INSERT, ROLES[fit], ""
                )
                if _better(new, offers.get(after)):
                    offers[after] = new
        self._drop_beaten(offers)
        needed, direct = [], []
        for o in offers.values():
            while o not in needed:
                needed.append(o)
                if isinstance(o.parent, Node):
                    direct.append(o)
                    break
                o = o.parent
        for o in direct:
            o.parent.refs += 1
        for _, node in self.survivors.values():
            self._release(node)
        for o in direct:
            o.node = o.parent if o is first else self._grown(o)
        self.survivors = {}
        for state, o in offers.items():
            node = self._placed(o)
            node.refs += 1
            self.survivors[state] = (o.cost, node)
        if first is not None:
            self.root.refs -= 1
        self._settle()

    @staticmethod
    def _drop_beaten(offers: dict[int, _Offer]) -> None:
        """Forget states whose every continuation costs more than one after an assistant.

        That can follow any way on; only a system turn kept by a way that has nothing
        yet must be deleted instead.
        """
        done = offers.get(ASSISTANT)
        if done is None:
            return
        if START in offers and done.cost + COSTS[DELETE] < offers[START].cost:
            del offers[START]
        if SYSTEM in offers and done.cost < offers[SYSTEM].cost:
            del offers[SYSTEM]

    def _grown(self, o: _Offer) -> Node:
        """The node of an offer whose parent it holds one reference to."""
        p = o.parent
        if o.edit == DELETE == p.edit and p is not self.root and p.refs == 1:
            p.count += 1
            p.refs = 0
            return p
        return Node(p, o.edit, o.role, o.text)

    def _placed(self, o: _Offer) -> Node:
        if o.node is None:
            parent = self._placed(o.parent)
            parent.refs += 1
            o.node = Node(parent, o.edit, o.role, o.text)
        return o.node

    def _release(self, node: Node) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs or node is self.root:
                return
            node = node.parent

    def _settle(self) -> None:
        """Give out what all survivors share."""
        if self.root.refs > 1:
            return
        way = [next(iter(self.survivors.values()))[1]]
        while way[-1] is not self.root:
            way.append(way[-1].parent)
        while len(way) > 1 and self.root.refs == 1:
            way.pop()
            node = way[-1]
            self.emit(node.edit, node.count, node.role, node.text)
            node.parent = node.role = node.text = None
            node.edit = ""
            self.root = node


class _Conversation:
    """Counts over one conversation's turns, which come in order."""

    def __init__(self, emit):
        self.search = Search(emit)
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.last = None
        self.turns = 0

    def read(self, turn, role: str, text: str, earlier: bool) -> None:
        same = self.last == (turn, role, text)
        if self.last is not None:
            self.illegal += self.last[1][:1] + role[:1] not in LEGAL
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        bare = text.rstrip(BLANK)
        blank = not bare
        duplicate = not blank and (earlier or same)
        truncated = not blank and bare[-1] not in ENDS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated and not duplicate
        self.last = (turn, role, text)
        self.search.read(role, text, blank or duplicate, truncated)

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _conversations(batches: Iterator[pa.RecordBatch], begin, end) -> Iterator:
    """Run through sorted turns; ``begin(key)`` gives the emitter of a conversation,
    ``end(key, conversation)`` what to yield for it."""
    at = None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for key, there, turn, role, text, earlier in zip(*columns, strict=True):
            if at is None or at[0] != key:
                if at is not None:
                    yield end(*at)
                at = (key, _Conversation(begin(key)))
            if there:
                at[1].read(turn, role, text, earlier)
            yield None
    if at is not None:
        yield end(*at)


def _in_order(turns: DataFrame, workspace: Workspace, names: dict[str, str], there: Column):
    """Turns by conversation, each conversation whole and in order in one task.

    Repeats are found before, by a shuffle on role and text: a task that reads a long
    conversation needs no set of what it has seen. Digests stand for texts there.
    """
    none = F.lit(" ")
    rows = turns.select(
        quoted(names["conv"]).alias("conv"),
        there.alias("there"),
        quoted(names["turn"]).alias("turn"),
        F.coalesce(quoted(names["role"]).cast("string"), none).alias("role"),
        F.coalesce(quoted(names["text"]).cast("string"), none).alias("text"),
    )
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    texts = F.sha2("text", 256)
    repeated = (
        rows.filter("there")
        .groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), texts.alias("t"))
        .agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("first"))
        .filter("times > 1")
        .drop("times")
    )
    # Stored, its size tells Spark how to join it.
    repeated = workspace.store(repeated, "repeated")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
    marked = rows.join(repeated, same & (texts == F.col("t")), "left").select(
        *rows.columns, F.coalesce(place > F.col("first"), F.lit(False)).alias("earlier")
    )
    bound_batches(turns.sparkSession)
    return marked.repartition("conv").sortWithinPartitions(
        F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"
    )


NAMES = {"conv": "conv_id", "turn": "turn", "role": "role", "text": "text"}
BATCH = 4096
BATCH_CHARS = 1 << 23


def _yielded(schema: T.StructType, rows: Iterator) -> Iterator[pa.RecordBatch]:
    """Rows (None for nothing yet) as batches of bounded size."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, held, chars = to_arrow_schema(schema), [], 0

    def batch():
        columns = zip(*held, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=arrow)

    for row in rows:
        if row is None:
            continue
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) == BATCH or chars > BATCH_CHARS:
            yield batch()
            held, chars = [], 0
    if held:
        yield batch()


def repaired_turns(
    turns: DataFrame,
    workspace: Workspace,
    names: dict[str, str] | None = None,
    there: Column | None = None,
) -> DataFrame:
    """The edits of each conversation in order: conv, place (from 0), edit, role, text.

    Role and text are those after the edit, null for deletions; the repaired
    conversation is the rows that have a role. A null role or text counts as one space,
    null turns come first, turns of one number go by role and text. Rows of a null
    conversation are one conversation. ``there`` marks rows to be read at all; a
    conversation without any has no edits. An empty table gives an empty one.
    """
    names = NAMES | (names or {})
    ordered = _in_order(turns, workspace, names, F.lit(True) if there is None else there)
    schema = T.StructType(
        [
            T.StructField("conv", ordered.schema["conv"].dataType),
            T.StructField("place", T.LongType()),
            *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list = []

        def begin(key):
            place = 0

            def emit(edit, count, role, text):
                nonlocal place
                for _ in range(count):
                    ready.append((key, place, edit, role, text))
                    place += 1

            return emit

        def rows():
            for _ in _conversations(batches, begin, lambda key, c: c.search.close()):
                yield from ready
                ready.clear()

        yield from _yielded(schema, rows())

    return ordered.mapInArrow(tidy(run), schema)


def repair_summary(
    turns: DataFrame,
    workspace: Workspace,
    names: dict[str, str] | None = None,
    there: Column | None = None,
) -> DataFrame:
    """Per conversation what was found and done, from the edits as they are given out.

    conv, gaps, blank, duplicate, truncated, illegal, cost, audit (the edits' initials)
    and repaired_sha256 (of the lines ``role:text`` that stay, joined by newlines).
    Rows and ties count as in ``repaired_turns``; a conversation without rows that are
    ``there`` has zeros, an empty audit and the digest of nothing.
    """
    names = NAMES | (names or {})
    ordered = _in_order(turns, workspace, names, F.lit(True) if there is None else there)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType(
        [
            T.StructField("conv", ordered.schema["conv"].dataType),
            *[T.StructField(c, T.LongType()) for c in counts],
            T.StructField("audit", T.StringType()),
            T.StructField("repaired_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, found = [], hashlib.sha256()
        lines = 0

        def begin(key):
            nonlocal found, lines
            edits.clear()
            found, lines = hashlib.sha256(), 0

            def emit(edit, count, role, text):
                nonlocal lines
                edits.append(edit * count)
                if role is not None:
                    found.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1

            return emit

        def end(key, c):
            cost = c.search.close()
            numbers = (c.gaps(), c.blank, c.duplicate, c.truncated, c.illegal, cost)
            return (key, *numbers, "".join(edits), found.hexdigest())

        yield from _yielded(schema, _conversations(batches, begin, end))

    return ordered.mapInArrow(tidy(run), schema)
