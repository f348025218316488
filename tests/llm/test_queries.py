"""Queries that SQL cannot express, over whole tables against plain Python."""

import hashlib
import html
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tidemark.llm import registry

SF_DIR = "/root/testdata/sf0.01"


def rows(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


def run(spark, name):
    return registry.queries()[name](spark, SF_DIR).collect()


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] or "" for r in rows("documents")}


@pytest.fixture(scope="module")
def ids(texts):
    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    found = tokenizer.encode_batch(list(texts.values()), add_special_tokens=False)
    return dict(zip(texts, [e.ids for e in found], strict=True))


def test_extraction(spark):
    """The given pages mark their article; its blocks are the text."""
    expected = {}
    for page in rows("pages"):
        article = re.search(r"<article>(.*?)</article>", page["html"], re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", article)
        plain = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks]
        expected[page["page_id"]] = (page["url"], "\n".join(b for b in plain if b))
    found = run(spark, "op1_html_extract")
    assert {r.page_id: (r.url, r.text) for r in found} == expected
    assert all(r.n_chars == len(r.text) for r in found)


def test_token_files(spark, ids):
    expected, start = {}, 0
    for doc in sorted(ids):
        own = [*ids[doc], 2]
        expected[doc] = (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
    found = run(spark, "op5_token_files")
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in found} == expected


def test_token_counts(spark, texts, ids):
    expected = {d: (len(t.encode()), len(ids[d]), len(ids[d]) > 512) for d, t in texts.items()}
    found = run(spark, "op9_token_counts")
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in found} == expected


def test_shards(spark, texts):
    found = run(spark, "op6_sharding")
    assert {r.doc_id: (r.size, r.text_crc32) for r in found} == {
        d: (len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in texts.items()
    }
    by_shard = {}
    for r in found:
        by_shard.setdefault(r.shard, []).append(r.slot)
        assert (r.law, r.grown_shard) == ("rows", None)
    assert set(by_shard) == set(range(40))
    sizes = {len(s) for s in by_shard.values()}
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    # copies end up together
    shards = {}
    for r in found:
        shards.setdefault(texts[r.doc_id], set()).add(r.shard)
    copied = [t for t in shards if list(texts.values()).count(t) > 1]
    assert len(copied) > 50 and sum(len(shards[t]) > 1 for t in copied) <= len(copied) // 20


def test_chat(spark):
    given = {}
    for r in sorted(rows("conversations"), key=lambda r: (r["conv_id"], r["turn"])):
        given.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    given[-7] = [("user", registry.CONTROLLED), ("assistant", registry.CONTROLLED)]
    expected = {}
    for conv, turns in given.items():
        told = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        expected[conv] = (
            len(turns), hashlib.sha256(told.encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(),
        )
    found = run(spark, "op7_chat_format")
    assert {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found
    } == expected
    assert all(r.formatted_chars > sum(len(t) for _, t in given[r.conv_id]) for r in found)
