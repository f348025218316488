"""Set-similarity links inside one cell by dual traversal of a signature tree."""

from __future__ import annotations

import numpy as np

LEAF, FANOUT = 32, 8
#: Pairs from which on a pair of leaves is verified at once, and the flags that may take.
MANY, MOST_FLAGS = 64, 1 << 24
#: Bits of all sets' bitmaps together: 32 MB, whatever the largest set is.
MOST_BITS = 1 << 28


class Forest:
    """Union-find whose labels stay flat, so that whole ranges can be compared."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members = {i: [i] for i in range(n)}

    def join(self, i: int, j: int) -> None:
        a, b = int(self.label[i]), int(self.label[j])
        if a == b:
            return
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        moved = self.members.pop(b)
        self.label[moved] = a
        self.members[a] += moved


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def exact_maps(sets: list[np.ndarray]) -> np.ndarray | None:
    """Bitmaps of some sets in which no two elements share a bit, if not too large."""
    sizes = [len(s) for s in sets]
    if len(sets) * sum(sizes) > MOST_FLAGS:
        return None
    values, slot = np.unique(np.concatenate(sets), return_inverse=True)
    flags = np.zeros((len(sets), -(-len(values) // 64) * 64), bool)
    flags[np.repeat(np.arange(len(sets)), sizes), slot] = True
    return np.packbits(flags, axis=1).view(np.uint64)


def link(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """A label per set; linked sets (100 * common >= percent * union) share theirs.

    Pairs that hang together already are not looked at: the labels are right,
    but not every link is found. ``count_links`` finds them all.
    """
    return _traverse(sets, percent, None)[0]


def count_links(
    sets: list[np.ndarray], percent: int, weight: np.ndarray, late: np.ndarray, side: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Labels by the links counted, and per set the weight of all sets it links to.

    Pairs count of which one is ``late`` at least and whose ``side`` differs;
    a side of -1 differs from all.
    """
    return _traverse(sets, percent, (weight, late, side))


def _traverse(
    sets: list[np.ndarray], percent: int, tally: tuple[np.ndarray, ...] | None
) -> tuple[np.ndarray, np.ndarray]:
    """Labels and, with a tally, weights of links.

    Leaves hold sets, ordered by their least element, which near copies mostly
    share. Every node has the OR of its sets' bitmaps, the range of their sizes
    and the most elements any of them loses to bit collisions. A pair of nodes
    is left out if the sizes are too far apart, if the common bits plus those
    losses cannot reach the overlap the smallest sets need, or, without a tally,
    if all sets of both already share one label.
    """
    order = sorted(range(len(sets)), key=lambda i: int(sets[i][0]))
    sets = [sets[i] for i in order]
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    bits = 1 << max(6, int(2 * size.max() - 1).bit_length())
    # Narrower ones prune less; what they lose is counted in ``lost``.
    bits = min(bits, 1 << max(6, (MOST_BITS // m).bit_length() - 1))
    words = bits // 64
    maps = np.zeros((m, words), np.uint64)
    for row, s in zip(maps, sets, strict=True):
        at = (s & np.uint64(bits - 1)).astype(np.int64)
        np.bitwise_or.at(row, at >> 6, np.uint64(1) << (s & np.uint64(63)))
    lost = size - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)

    # levels[0] are the leaves; node k of a level spans the next level's nodes.
    levels = []
    edges = np.arange(0, m, LEAF)
    ors, low, high, loss = maps, size, size, lost
    spans = np.append(edges, m)
    while True:
        ors = np.bitwise_or.reduceat(ors, edges, axis=0)
        low = np.minimum.reduceat(low, edges)
        high = np.maximum.reduceat(high, edges)
        loss = np.maximum.reduceat(loss, edges)
        levels.append((ors, low, high, loss, spans))
        if len(ors) == 1:
            break
        edges = np.arange(0, len(ors), FANOUT)
        spans = np.append(spans[edges], m)

    forest = Forest(m)
    label = forest.label
    need = 100 + percent
    links = np.zeros(m, np.int64)
    if tally:
        weight, late, side = (np.asarray(t)[order] for t in tally)

    def pruned(level: int, i: int, j: int) -> bool:
        ors, low, high, loss, spans = levels[level]
        a, b = label[spans[i]], label[spans[j]]
        if not tally and a == b and (label[spans[i] : spans[i + 1]] == a).all() and (
            label[spans[j] : spans[j + 1]] == b
        ).all():
            return True
        if 100 * min(high[i], high[j]) < percent * max(low[i], low[j]):
            return True
        most = int(np.bitwise_count(ors[i] & ors[j]).sum()) + min(loss[i], loss[j])
        return most * need < percent * (low[i] + low[j])

    def verified(x: np.ndarray, y: np.ndarray, can: np.ndarray) -> np.ndarray:
        """Which of the pairs are links, by all of their elements."""
        out = np.zeros(can.shape, bool)
        own = None
        if np.count_nonzero(can) >= MANY:
            own = exact_maps([sets[k] for k in (*x, *y)])
        if own is None:
            for r, c in np.argwhere(can):
                p, q = int(x[r]), int(y[c])
                out[r, c] = overlap(sets[p], sets[q]) * need >= percent * int(size[p] + size[q])
            return out
        for r in np.flatnonzero(can.any(axis=1)):
            common = np.bitwise_count(own[r] & own[len(x) :]).sum(axis=1, dtype=np.int64)
            out[r] = common * need >= percent * (size[x[r]] + size[y])
        return out & can

    def leaves(i: int, j: int) -> None:
        spans = levels[0][4]
        x, y = np.arange(spans[i], spans[i + 1]), np.arange(spans[j], spans[j + 1])
        common = np.empty((len(x), len(y)), np.int64)
        for r, k in enumerate(x):
            common[r] = np.bitwise_count(maps[k] & maps[y]).sum(axis=1, dtype=np.int64)
        most = common + np.minimum(lost[x][:, None], lost[y][None, :])
        can = most * need >= percent * (size[x][:, None] + size[y][None, :])
        if i == j:
            can &= x[:, None] < y[None, :]
        if tally:
            can &= late[x][:, None] | late[y][None, :]
            can &= (side[x][:, None] != side[y][None, :]) | (side[x][:, None] < 0)
            can = verified(x, y, can)
            links[x] += can @ weight[y]
            links[y] += weight[x] @ can
            for r, c in np.argwhere(can & (label[x][:, None] != label[y][None, :])):
                forest.join(int(x[r]), int(y[c]))
            return
        can &= label[x][:, None] != label[y][None, :]
        for r, c in np.argwhere(can):
            p, q = int(x[r]), int(y[c])
            if label[p] != label[q]:
                k = overlap(sets[p], sets[q])
                if k * need >= percent * int(size[p] + size[q]):
                    forest.join(p, q)

    stack = [(len(levels) - 1, 0, 0)]
    while stack:
        level, i, j = stack.pop()
        if pruned(level, i, j):
            continue
        if level == 0:
            leaves(i, j)
            continue
        below = len(levels[level - 1][0])
        left = range(i * FANOUT, min((i + 1) * FANOUT, below))
        right = range(j * FANOUT, min((j + 1) * FANOUT, below))
        pairs = [(a, b) for a in left for b in right if i != j or a <= b]
        # Pairs near the diagonal come first: near copies merge early.
        pairs.sort(key=lambda p: -abs(p[0] - p[1]))
        stack += [(level - 1, a, b) for a, b in pairs]

    out = np.empty(m, np.int64)
    out[order] = [order[k] for k in label]
    counts = np.empty(m, np.int64)
    counts[order] = links
    return out, counts
