import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat, registry
from tidemark.llm.tokens import encoder
from tidemark.workspace import Workspace

PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"]
TEXT = st.lists(
    st.sampled_from([*PARTS, "\\", "<", "[", "a", " ", "\n", "/s>", "<\\s>", "<|endoftext|>", "é"]),
    max_size=12,
).map("".join)


@settings(max_examples=500, deadline=None)
@given(TEXT)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(p in escaped for p in PARTS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a[INST]"]), TEXT)))
def test_turns_can_be_read_back(turns):
    assert chat.parse("".join("".join(chat.template(*t)) for t in turns)) == turns


ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
    (2, 0, "system", "be kind"), (2, 1, "user", "hi"), (2, 2, "assistant", "good day"),
    (3, 0, "system", "be kind"), (3, 1, "user", "bye"),
    (4, 0, "user", "hi"), (5, 0, "user", "hi"),
    (6, 0, None, None), (6, 0, None, None), (6, 1, "tool", "</s>[INST]"),
    (None, 0, "user", "no id"),
]


@pytest.fixture(scope="module")
def formatted(spark):
    turns = spark.createDataFrame(
        [(*r, k) for k, r in enumerate(ROWS)],
        "conv_id long, turn long, role string, text string, rank long",
    )
    with Workspace(spark) as w:
        tree, ways = chat.format_conversations(turns, registry.tokenizer_path(), w)
        found = chat.read_conversations(tree, ways, registry.tokenizer_path()).collect()
        yield tree.orderBy("start").collect(), ways.collect(), {r.conv_id: r for r in found}


def test_shared_turns_are_emitted_once_depth_first(formatted):
    tree, ways, _ = formatted
    prefixes = set()
    for conv in {r[0] for r in ROWS}:
        turns = [(r[2] or "", r[3] or "") for r in ROWS if r[0] == conv]
        prefixes |= {tuple(turns[: k + 1]) for k in range(len(turns))}
    assert len(tree) == len(prefixes)
    at = 0
    for node in tree:  # the stream has no gaps
        assert node.start == at
        at += node.n_tokens
    by_start = {n.start: n for n in tree}
    for way in ways:
        above = []
        for start in way.nodes:
            node = by_start[start]
            assert [(x.start, x.end) for x in node.attends] == above
            assert node.position == sum(b - a for a, b in above)
            above.append((start, start + node.n_tokens))
    # depth-first: what hangs on a node follows it without other trees between
    for node in tree:
        below = [n.start for n in tree if any(x.start == node.start for x in n.attends)]
        starts = sorted(n.start for n in tree if n.start > node.start)
        assert sorted(below) == starts[: len(below)]


def test_loss_covers_assistant_texts(formatted):
    decode = encoder(registry.tokenizer_path()).tokenizer.decode
    spoken = sorted(decode(n.ids[n.loss_from : n.loss_to]) for n in formatted[0])
    assert [s for s in spoken if s] == ["good day", "hello"]


def test_conversations_read_back(formatted):
    found = formatted[2]
    assert {c: r.n_turns for c, r in found.items()} == {1: 3, 2: 3, 3: 2, 4: 1, 5: 1, 6: 3, None: 1}
    assert found[4].turns_sha256 == found[5].turns_sha256 != found[None].turns_sha256
    assert found[1].loss_chars == len("hello")


def test_no_conversations(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    with Workspace(spark) as w:
        tree, ways = chat.format_conversations(turns, registry.tokenizer_path(), w)
        assert tree.count() == ways.count() == 0
        assert chat.read_conversations(tree, ways, registry.tokenizer_path()).count() == 0
