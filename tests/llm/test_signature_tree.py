import random

import numpy as np
import pytest

from tidemark.llm import signature_tree as tree


def brute(sets, percent):
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            union = len(sets[i]) + len(sets[j]) - common
            if 100 * common >= percent * union:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    return label


def same_groups(a, b):
    return len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("percent", [50, 80, 100])
def test_links_equal_brute_force(seed, percent):
    rng = random.Random(seed)
    sets = []
    for _ in range(rng.choice([1, 2, 20])):
        base = [rng.getrandbits(64) for _ in range(rng.choice([1, 3, 10, 60, 300]))]
        for _ in range(rng.choice([1, 5, 12])):
            kept = [x for x in base if rng.random() > rng.choice([0, 0.05, 0.15])] or base[:1]
            kept += [rng.getrandbits(64) for _ in range(rng.choice([0, 0, 1, 5]))]
            sets.append(np.unique(np.array(kept, np.uint64)))
    assert same_groups(tree.link(sets, percent).tolist(), brute(sets, percent))


def test_one_large_set_does_not_widen_all_bitmaps():
    import tracemalloc

    rng = np.random.Generator(np.random.PCG64(8))
    sets = [np.unique(rng.integers(0, 2**63, 60, dtype=np.uint64)) for _ in range(4000)]
    sets.append(np.unique(rng.integers(0, 2**63, 300_000, dtype=np.uint64)))
    sets.append(sets[-1][3:])
    tracemalloc.start()
    labels = tree.link(sets, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert labels[-1] == labels[-2] and len(set(labels.tolist())) == 4001
    assert peak < 150e6
