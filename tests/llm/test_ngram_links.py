"""Numbers of links against brute force, in one cell and in many."""

import random

import numpy as np
import pytest

from tidemark.llm import ngram_join, signature_tree
from tidemark.workspace import Workspace


def shingles(text):
    words = (text or "").lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def documents(seed):
    """Copies and near copies of some texts, of many lengths; null ids and texts; repeated rows."""
    rng = random.Random(seed)
    rows = [(None, None), (900, ""), (901, "two words"), (902, "Two WORDS")]
    for base in range(4):
        words = [f"b{base}w{k}" for k in range(rng.choice([30, 60, 90]))]
        for _ in range(12):
            own = words[: len(words) - rng.choice([0, 0, 1, 5, 9])]
            if rng.random() < 0.7:
                own[rng.choice([0, 1, len(own) - 1])] = f"x{rng.randrange(9)}"
            rows.append((rng.choice([len(rows), len(rows), None]), " ".join(own)))
    return rows + rows[-3:]


@pytest.mark.parametrize(
    "seed, cell_rows, cell_items", [(1, 4096, 1 << 22), (2, 4, 1 << 22), (3, 1, 9), (4, 4096, 120)]
)
def test_links_equal_brute_force(spark, monkeypatch, seed, cell_rows, cell_items):
    monkeypatch.setattr(ngram_join, "CELL_ITEMS", cell_items)
    rows = documents(seed)
    sets = [shingles(t) for _, t in rows]
    links = [sum(linked(a, b) for b in sets) - bool(a) for a in sets]
    expected = [(d, len(a), k) for (d, _), a, k in zip(rows, sets, links, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    with Workspace(spark) as w:
        found = ngram_join.ngram_links(df, w, cell_rows=cell_rows)
        plain = ngram_join.ngram_components(df, w, cell_rows=cell_rows)
        got = sorted(map(tuple, found.select("doc_id", "n_shingles", "n_links").collect()), key=repr)
        assert got == sorted(expected, key=repr)
        key = found.columns[:3]
        assert sorted(found.select(*key).collect(), key=repr) == sorted(plain.collect(), key=repr)
        assert ngram_join.ngram_links(df.filter("false"), w).count() == 0


@pytest.mark.parametrize("many", [1, 10**6])
def test_every_link_of_a_group(monkeypatch, many):
    """Near copies that hang together by few links still have all of them counted."""
    monkeypatch.setattr(signature_tree, "MANY", many)
    base = np.arange(1, 101, dtype=np.uint64)
    sets = [np.unique(np.append(base, np.uint64(1000 + k))) for k in range(90)]
    weight, all_ = np.arange(90), np.ones(90, bool)
    label, links = signature_tree.count_links(sets, 80, weight, all_, np.full(90, -1))
    assert len(set(label)) == 1
    assert links.tolist() == [int(weight.sum()) - k for k in range(90)]
