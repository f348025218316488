"""Chat formatting: conversations as a prefix tree of turns, emitted depth-first."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import bound_batches, tidy
from tidemark.llm.tokens import BATCH_BYTES, decoder, encoder
from tidemark.llm.words import slices
from tidemark.operators.numbering import number_rows
from tidemark.workspace import Workspace

# Control strings of the template. A text's own ones get a backslash behind the
# first character, and so do those that have backslashes there already.
_CONTROL = r"(<|\[)(\\*)(/?s>|</?SYS>>|/?INST\]|/?ROLE\])"
_ESCAPE = re.compile(_CONTROL)
_UNESCAPE = re.compile(_CONTROL.replace(r"(\\*)", r"\\(\\*)"))
_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]"
    r"|<<SYS>>(?P<system>.*?)<</SYS>>"
    r"|<s>(?P<assistant>.*?)</s>"
    r"|\[ROLE\](?P<role>.*?)\[/ROLE\](?P<text>.*?)</s>",
    re.DOTALL,
)
#: Conversations whose node offsets are summed together.
GROUP = 4096


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def template(role: str, text: str) -> tuple[str, str, str]:
    """What stands before a turn's text, the escaped text, and what stands behind."""
    text = escape(text)
    if role == "user":
        return "[INST] ", text, " [/INST]"
    if role == "system":
        return "<<SYS>>", text, "<</SYS>>"
    if role == "assistant":
        return "<s>", text, "</s>"
    return f"[ROLE]{escape(role)}[/ROLE]", text, "</s>"


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        if m["role"] is not None:
            turns.append((unescape(m["role"]), unescape(m["text"])))
        else:
            turns.append((m.lastgroup, unescape(m[m.lastgroup])))
        at = m.end()
    return turns


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per turn the name of its prefix: a digest of that before, the role and the text."""
    for batch in batches:
        for i, turns in enumerate(batch["turns"]):
            out: dict[str, list] = {k: [] for k in ("depth", "node", "parent", "role", "text")}
            above = b""
            for depth, turn in enumerate(turns.as_py()):
                role, text = turn["role"], turn["text"]
                name = hashlib.blake2b(above, digest_size=16)
                name.update(len(role.encode()).to_bytes(8, "little"))
                name.update(role.encode() + text.encode())
                out["depth"].append(depth)
                out["parent"].append(above or None)
                above = name.digest()
                out["node"].append(above)
                out["role"].append(role)
                out["text"].append(text)
            n = len(out["node"])
            path = b"".join(x[:8] for x in out["node"])
            conv = batch["conv_id"][i].as_py()
            yield pa.record_batch(
                {
                    "conv_id": pa.array([conv] * n, pa.int64()),
                    "depth": pa.array(out["depth"], pa.int32()),
                    "node": pa.array(out["node"], pa.binary()),
                    "parent": pa.array(out["parent"], pa.binary()),
                    "path": pa.array([path] + [None] * (n - 1), pa.binary()),
                    "role": pa.array(out["role"], pa.string()),
                    "text": pa.array(out["text"], pa.string()),
                }
            )


def _segments(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                pieces: list[str] = []
                for role, text in zip(
                    part["role"].to_pylist(), part["text"].to_pylist(), strict=True
                ):
                    pieces += template(role, text)
                counts, ids = encoder(path).encode(pa.array(pieces, pa.large_string()))
                counts = counts.reshape(-1, 3)
                total = counts.sum(axis=1)
                edges = pa.array([0, *total.cumsum().tolist()], pa.int32())
                loss = [r == "assistant" for r in part["role"].to_pylist()]
                chars = [
                    sum(map(len, pieces[k : k + 3])) for k in range(0, len(pieces), 3)
                ]
                yield pa.record_batch(
                    {
                        "node": part["node"],
                        "parent": part["parent"],
                        "depth": part["depth"],
                        "rank": part["rank"],
                        "ids": pa.ListArray.from_arrays(edges, pa.array(ids.view("int32"))),
                        "n_tokens": pa.array(total, pa.int64()),
                        "n_chars": pa.array(chars, pa.int64()),
                        # Half-open range of ids that the loss counts.
                        "loss_from": pa.array(
                            [int(c[0]) if x else 0 for c, x in zip(counts, loss, strict=True)],
                            pa.int32(),
                        ),
                        "loss_to": pa.array(
                            [
                                int(c[0] + c[1]) if x else 0
                                for c, x in zip(counts, loss, strict=True)
                            ],
                            pa.int32(),
                        ),
                    }
                )

    return run


def _with_starts(nodes: DataFrame) -> DataFrame:
    """Add each node's place in the stream: the ids of all nodes before it.

    Nodes follow each other by the first conversation through them, then by
    depth; with conversations in order of their paths that is depth-first.
    Sums per GROUP conversations come first, one small row for each.
    """
    grouped = nodes.withColumn("group", F.floor(F.col("rank") / GROUP))
    sums = grouped.groupBy("group").agg(F.sum("n_tokens").alias("all"))
    earlier = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("group", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("base"))
    inside = (
        Window.partitionBy("group").orderBy("rank", "depth")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    own = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return (
        grouped.withColumn("own", own)
        .join(sums, "group")
        .withColumn("start", F.col("base") + F.col("own"))
        .drop("group", "own", "base")
    )


def format_conversations(
    turns: DataFrame, path: str, workspace: Workspace
) -> tuple[DataFrame, DataFrame]:
    """The prefix tree of all conversations, and each conversation's way through it.

    ``turns`` has conv_id (long), turn, role and text; other columns are
    ignored. ``path`` is a file of the tokenizers library.

    The tree has one row per distinct run of initial turns: start (its place in
    the depth-first stream of ids), ids, n_chars, the range of ids under the
    loss mask (an assistant's text), the position id of its first id, and
    ``attends``, the stream intervals of its ancestors: an id sees those and
    the ids before it in its own node. The second table has conv_id, a number
    of its own per conversation, and ``nodes``, the starts of its nodes in turn.

    A null text or role counts as empty; turns are ordered by number (null
    first), then role and text, so repeated rows are turns of their own. Rows
    with a null conv_id form one conversation. An empty table gives two empty
    tables.
    """
    bound_batches(turns.sparkSession)
    empty = F.lit("")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", empty).alias("role"),
            F.coalesce("text", empty).alias("text"),
        ).alias("row"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    steps = workspace.store(
        grouped.mapInArrow(
            tidy(_nodes),
            "conv_id long, depth int, node binary, parent binary, path binary, "
            "role string, text string",
        ),
        "steps",
    )
    ranks = number_rows(
        steps.filter("depth = 0").select("conv_id", "path"), ["path", "conv_id"], "rank", workspace
    ).drop("path")
    # Only names travel until it is known which conversation is a node's first.
    placed = workspace.store(
        steps.select("conv_id", "depth", "node")
        .alias("s")
        .join(ranks.alias("r"), F.col("s.conv_id").eqNullSafe(F.col("r.conv_id")))
        .select("s.*", "rank"),
        "placed",
    )
    first = placed.groupBy("node").agg(F.min(F.struct("rank", "conv_id", "depth")).alias("f"))
    first = workspace.store(
        first.select("f.rank", F.col("f.conv_id").alias("c"), F.col("f.depth").alias("d")), "first"
    )
    # It brings the text, once.
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("depth") == F.col("d"))
    own = steps.join(first, same).select("depth", "node", "parent", "role", "text", "rank")
    made = workspace.store(
        own.mapInArrow(
            tidy(_segments(path)),
            "node binary, parent binary, depth int, rank long, ids array<int>, n_tokens long, "
            "n_chars long, loss_from int, loss_to int",
        ),
        "made",
    )
    nodes = workspace.store(
        _with_starts(made.select("node", "depth", "rank", "n_tokens")), "nodes"
    )
    where = nodes.select("node", "start", "n_tokens", F.col("rank").alias("first"))
    # Repeated conversations and shared turns meet their node's one row here.
    way = placed.select("conv_id", "depth", "node", "rank").join(where, "node")
    seat = F.struct("depth", "start", "n_tokens", "first")
    ways = way.groupBy("rank").agg(
        F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(seat)).alias("seats")
    )
    ways = workspace.store(ways, "ways")
    # Of every way the nodes it is first to pass, with what lies above them.
    fresh = ways.select("rank", "seats", F.posexplode("seats").alias("at", "seat")).filter(
        "seat.first = rank"
    )
    above = F.slice("seats", 1, F.col("at"))
    context = fresh.select(
        F.col("seat.start").alias("start"),
        F.aggregate(above, F.lit(0).cast("long"), lambda n, x: n + x["n_tokens"]).alias("position"),
        F.transform(
            above,
            lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["n_tokens"]).alias("end")),
        ).alias("attends"),
    )
    light = nodes.select("node", "start").join(context, "start")
    tree = made.join(light, "node").select(
        "start", "ids", "n_tokens", "n_chars", "loss_from", "loss_to", "position", "attends"
    )
    conversations = ways.select(
        "conv_id", F.col("rank").alias("number"), F.col("seats.start").alias("nodes")
    )
    return workspace.store(tree, "tree"), workspace.store(conversations, "conversations")


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def _read(path: str):
    """Digests of conversations, from ids alone. A node's ids are decoded as the three
    pieces they were made of: before, under and behind the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = decoder(path).decode
        for batch in batches:
            lists = batch["parts"]
            edges = lists.offsets.to_numpy()
            parts = lists.values
            ids = parts.field("ids")
            lo, hi = (parts.field(f"loss_{k}").to_numpy() for k in ("from", "to"))
            first = ids.offsets.to_numpy()
            n = np.diff(first)
            pieces = np.stack([lo, hi - lo, n - hi], axis=1)
            flat = ids.values.to_numpy()[first[0] : first[-1]] if len(n) else np.zeros(0, np.int64)
            texts = decode(flat, pieces.ravel())
            out = []
            for conv, a, b in zip(
                batch["conv_id"].to_pylist(), edges[:-1], edges[1:], strict=True
            ):
                formatted = "".join(texts[3 * a : 3 * b])
                loss, turns = "".join(map(unescape, texts[3 * a + 1 : 3 * b : 3])), parse(formatted)
                told = "".join(f"{r}\n{t}\n" for r, t in turns)
                out.append(
                    (
                        conv,
                        len(turns),
                        hashlib.sha256(told.encode()).hexdigest(),
                        len(loss),
                        hashlib.sha256(loss.encode()).hexdigest(),
                        len(formatted),
                    )
                )
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[f.split()[0] for f in DIGESTS.split(", ")],
            )

    return run


def read_conversations(tree: DataFrame, conversations: DataFrame, path: str) -> DataFrame:
    """Digests of every conversation, decoded from the tree's ids alone."""
    steps = conversations.select("number", "conv_id", F.posexplode("nodes").alias("depth", "start"))
    parts = steps.join(tree.select("start", "ids", "loss_from", "loss_to"), "start")
    part = F.struct("depth", "ids", "loss_from", "loss_to")
    whole = parts.groupBy("number").agg(
        F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(part)).alias("parts")
    )
    return whole.select("conv_id", "parts").mapInArrow(tidy(_read(path)), DIGESTS)
