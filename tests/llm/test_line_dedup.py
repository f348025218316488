"""Removed lines against brute force, with few and with many candidates looked at."""

import random

import numpy as np
import pytest

from tidemark.llm import line_dedup
from tidemark.workspace import Workspace


def documents(seed):
    """Lines that vary a few texts, some by just too much, and lines of few words."""
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 12, 40]))] for _ in range(6)]
    docs = []
    for doc in range(60):
        lines = []
        for _ in range(rng.randrange(8)):
            words = list(rng.choice(bases))
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
            rng.shuffle(words)
            lines.append(" ".join(words))
            lines.append(rng.choice(["", " ", "of the", "the of", "a b c d", "a b c d e"]))
        docs.append((doc if rng.random() < 0.97 else None, "\n".join(lines)))
    return docs


def brute(docs):
    lines = [
        ((-1 if d is None else d, k), (d, k), frozenset(x.split()))
        for d, text in docs
        for k, x in enumerate(text.split("\n"))
        if x.split()
    ]
    out = []
    for at, place, words in lines:
        before = [w for a, _, w in lines if a < at]
        exact = words in before
        near = any(100 * len(words & w) >= 80 * len(words | w) for w in before)
        out.append((*place, exact, near and not exact))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, reach", [(1, 255), (2, 1), (3, 0), (4, 3)])
def test_equals_brute_force(spark, seed, reach):
    docs = documents(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    with Workspace(spark) as w:
        found = line_dedup.repeated_lines(df, w, reach=reach).collect()
    expected = brute(docs)
    assert sum(r[3] for r in expected) > 20
    assert sorted(map(tuple, found), key=repr) == expected


def test_filters_are_those_of_every_pair():
    rng = np.random.default_rng(3)
    n = rng.integers(5, 12, 400)
    seat = {"n": n, "pos": rng.integers(0, 4, 400)}
    seat |= {k: rng.integers(0, 1 << 6, 400).astype(np.uint64) for k in ("bits", "more")}
    a, b = np.arange(1, 400), np.arange(399)
    expected = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        left = min(n[x] - seat["pos"][x], n[y] - seat["pos"][y])
        lost = [
            sum(int(seat[m][p] & ~seat[m][q]).bit_count() for m in ("bits", "more"))
            for p, q in ((x, y), (y, x))
        ]
        common = min(left, n[x] - lost[0], n[y] - lost[1])
        if 5 * min(n[x], n[y]) >= 4 * max(n[x], n[y]) and 9 * common >= 4 * (n[x] + n[y]):
            expected.append((k, int(common)))
    at, common = line_dedup._passing(seat, a, b, 80)
    assert expected
    assert list(zip(at.tolist(), common.tolist(), strict=True)) == expected


def test_lines_of_large_groups_come_out_of_joins_once(spark, monkeypatch):
    """Lines that pass the filters with very many others, and match few of them or none."""
    rng = random.Random(5)
    pool = [f"w{k}" for k in range(310)]
    docs = [(k, " ".join(rng.sample(pool, 270))) for k in range(250)]
    rows, store = {}, Workspace.store

    def counted(self, df, name, *args):
        out = store(self, df, name, *args)
        rows.setdefault(name, []).append(out.count())
        if name == "found":
            rows["places"] = [out.filter("other IS NULL").count()]
        return out

    monkeypatch.setattr(Workspace, "store", counted)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    with Workspace(spark) as w:
        found = line_dedup.repeated_lines(df, w, reach=0).collect()
    assert sorted(map(tuple, found), key=repr) == brute(docs)
    places = rows.pop("places")[0]
    assert max(max(n) for name, n in rows.items() if name != "found") <= 2 * places
    assert rows["rest"][0] <= len(docs)


def test_sets_come_from_documents_without_id_too(spark):
    line = [f"w{k}" for k in range(20)]
    docs = [(None, " ".join(line)), (1, " ".join(line[:-1])), (2, " ".join([*line[1:], "x"]))]
    docs += [(k, f"other text {k}") for k in range(3, 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    with Workspace(spark) as w:
        found = line_dedup.repeated_lines(df, w).collect()
    assert sorted(map(tuple, found), key=repr) == brute(docs)
    assert {r.doc_id for r in found if r.near} == {1, 2}
