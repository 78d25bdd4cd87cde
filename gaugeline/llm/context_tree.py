"""Context trees over bytes: the numpy part of ``language_model``, run inside tasks on one part of the tree.

A byte is coded as eight binary decisions, each a node (1 to 255) of the binary tree of bytes. Each of these nodes
has a context tree of its own, over the bytes before, the nearest first. A place of a text is a *gram*: the ``depth``
bytes before, nearest first and so in the highest bits, and the byte itself in the lowest. Sorted grams are
the leaves of all 255 trees in order, and a context's grams stand together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

# Ends a text and stands before its beginning; no UTF-8 text has this byte.
END = 0xFF
_EXACT = 256
_LGAMMA = np.array([0.0] + [math.lgamma(i / 2) for i in range(1, 2 * _EXACT)])


def lgamma_half(n: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function at ``n / 2`` for positive whole ``n``."""
    small = _LGAMMA[np.minimum(n, 2 * _EXACT - 1)]
    x = np.maximum(n, 2 * _EXACT - 1) / 2.0
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n < 2 * _EXACT, small, series)


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov estimate of any sequence of so many zeros and ones, as a natural logarithm."""
    return lgamma_half(2 * zeros + 1) + lgamma_half(2 * ones + 1) - lgamma_half(2 * (zeros + ones) + 2) - math.log(math.pi)


@dataclass
class Level:
    """Grams of one depth, and for each of their eight decisions: its node, whether it is a one, and the nodes' counts."""

    gram: np.ndarray
    count: np.ndarray
    node: list[np.ndarray]
    first: list[np.ndarray]
    zeros: list[np.ndarray]
    ones: list[np.ndarray]


def level(gram: np.ndarray, count: np.ndarray) -> Level:
    """``gram`` is sorted, without repeats; a ``count`` may be 0."""
    node, first, zeros, ones = [], [], [], []
    for bit in range(8):
        key = gram >> (8 - bit)
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        one = (gram >> (7 - bit)) & 1
        number = np.zeros(len(key), np.int32)
        number[begin] = 1
        node.append(np.cumsum(number, dtype=np.int32) - 1)
        first.append(begin)
        ones.append(np.add.reduceat(count * one, begin) if len(begin) else begin)
        zeros.append(np.add.reduceat(count * (1 - one), begin) if len(begin) else begin)
    return Level(gram, count, node, first, zeros, ones)


def shorter(gram: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of one byte of context less, and the place of each old one among them."""
    context = gram >> 8
    short = ((context >> 8) << 8 if depth > 1 else context * 0) | (gram & 0xFF)
    return np.unique(short, return_inverse=True)


def upward(gram: np.ndarray, count: np.ndarray, depth: int, least: int) -> list[tuple[Level, np.ndarray | None, list, list]]:
    """Levels from ``depth`` down to ``least``, each with the places of its grams in the next one.

    With each come, per decision, the logarithms of the nodes' weighted probability and of the product over their
    children (None at the deepest level).
    """
    out = []
    here = level(gram, count)
    own = [estimate(z, o) for z, o in zip(here.zeros, here.ones, strict=True)]
    weighted, below = own, [None] * 8
    for d in range(depth, least - 1, -1):
        if d == least:
            out.append((here, None, weighted, below))
            break
        short, place = shorter(here.gram, d)
        up = level(short, np.bincount(place, here.count, len(short)).astype(np.int64))
        products = []
        for bit in range(8):
            # Each child node is counted once, at its first gram.
            parent = up.node[bit][place[here.first[bit]]]
            products.append(np.bincount(parent, weighted[bit], len(up.first[bit])))
        out.append((here, place, weighted, below))
        own = [estimate(z, o) for z, o in zip(up.zeros, up.ones, strict=True)]
        weighted = [np.logaddexp(a, b) - math.log(2) for a, b in zip(own, products, strict=True)]
        here, below = up, products
    return out


def chance(here: Level, bit: int) -> np.ndarray:
    """Estimate of each gram's own decision, from its node's counts."""
    node = here.node[bit]
    zeros, ones = here.zeros[bit], here.ones[bit]
    one = ((here.gram >> (7 - bit)) & 1).astype(bool)
    hits = np.where(one, ones[node], zeros[node])
    return (hits + 0.5) / ((zeros + ones)[node] + 1.0)


def stop(here: Level, bit: int, below: np.ndarray) -> np.ndarray:
    """Weight of a node's own estimate against its children, after all that was counted."""
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(below - estimate(here.zeros[bit], here.ones[bit])))


def mixed_chances(levels: list[tuple[Level, np.ndarray | None, list, list]]) -> np.ndarray:
    """For each deepest gram and decision: the probability mixed over all depths of ``levels``."""
    deepest = levels[0][0]
    out = np.stack([chance(deepest, bit) for bit in range(8)])
    place = np.arange(len(deepest.gram))
    for (_, step, _, _), (here, _, _, below) in zip(levels[:-1], levels[1:], strict=True):
        place = step[place]
        for bit in range(8):
            weight = stop(here, bit, below[bit])[here.node[bit]]
            out[bit] = (weight * chance(here, bit))[place] + (1.0 - weight)[place] * out[bit]
    return out


def to_parent(levels: list[tuple[Level, np.ndarray | None, list, list]], depth: int) -> tuple[np.ndarray, ...]:
    """What the least of ``levels``, at ``depth``, gives the nodes above it: context, node, zeros, ones, log of the product."""
    here, _, weighted, _ = levels[-1]
    parts = []
    for bit in range(8):
        gram = here.gram[here.first[bit]]
        context = (gram >> 8) >> 8 if depth > 1 else gram * 0
        node = (1 << bit) | ((gram & 0xFF) >> (8 - bit))
        key, place = np.unique(context << 8 | node, return_inverse=True)
        sums = [np.bincount(place, x, len(key)) for x in (here.zeros[bit], here.ones[bit], weighted[bit])]
        parts.append((key >> 8, key & 0xFF, sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def settle(zeros: np.ndarray, ones: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of inner nodes: weight of the own estimate, estimate of a one, log of the weighted probability."""
    own = estimate(zeros, ones)
    with np.errstate(over="ignore"):
        weight = 1.0 / (1.0 + np.exp(product - own))
    return weight, (ones + 0.5) / (zeros + ones + 1.0), np.logaddexp(own, product) - math.log(2)


@dataclass
class Top:
    """Depths 0 and 1: weight and estimate of a one per (context byte, node); a fixed number of numbers."""

    weight: list[np.ndarray]
    one: list[np.ndarray]

    @classmethod
    def of(cls, context: np.ndarray, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, product: np.ndarray) -> Top:
        """From the sums that depth 2 gives the nodes of depth 1."""
        count = np.zeros((2, 256, 256), np.int64)
        below = np.zeros((256, 256))
        count[0, context, node], count[1, context, node], below[context, node] = zeros, ones, product
        weight1, one1, weighted = settle(count[0], count[1], below)
        total = count.sum(1)
        weight0, one0, _ = settle(total[0], total[1], weighted.sum(0))
        return cls([weight0[None, :], weight1], [one0[None, :], one1])

    def mix(self, chances: np.ndarray, gram: np.ndarray, depth: int) -> np.ndarray:
        """Mixes the chances from depth 2 on with depths 1 and 0."""
        out = chances.copy()
        nearest = gram >> (8 * depth)
        for bit in range(8):
            node = (1 << bit) | ((gram & 0xFF) >> (8 - bit))
            set_bit = ((gram >> (7 - bit)) & 1).astype(bool)
            for context, d in ((nearest, 1), (nearest * 0, 0)):
                weight, one = self.weight[d][context, node], self.one[d][context, node]
                out[bit] = weight * np.where(set_bit, one, 1.0 - one) + (1.0 - weight) * out[bit]
        return out


def mix_second(chances: np.ndarray, gram: np.ndarray, depth: int, key: np.ndarray, weight: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Mixes the chances from depth 3 on with the nodes of depth 2, given by sorted ``key`` (context, then node)."""
    out = chances.copy()
    context = gram >> (8 * (depth - 1))
    for bit in range(8):
        node = (1 << bit) | ((gram & 0xFF) >> (8 - bit))
        wanted = context << 8 | node
        at = np.minimum(np.searchsorted(key, wanted), max(len(key) - 1, 0))
        known = key[at] == wanted if len(key) else np.zeros(len(gram), bool)
        # A node that nothing was counted at has both at one half.
        w, o = (np.where(known, x[at], 0.5) if len(key) else np.full(len(gram), 0.5) for x in (weight, one))
        set_bit = ((gram >> (7 - bit)) & 1).astype(bool)
        out[bit] = w * np.where(set_bit, o, 1.0 - o) + (1.0 - w) * out[bit]
    return out


def text_grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all bytes and ends of several texts, and where each text's grams begin."""
    sizes = np.array([len(t) for t in texts], np.int64)
    gap = bytes([END]) * depth
    joined = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    n = len(joined) - depth
    out = joined[depth:].astype(np.int64)
    for back in range(1, depth + 1):
        out |= joined[depth - back : depth - back + n].astype(np.int64) << (8 * (depth - back + 1))
    # After a text's end come ends that belong to none.
    ends = np.cumsum(sizes + depth) - depth
    keep = np.ones(n, bool)
    for extra in range(1, depth):
        keep[ends + extra] = False
    return out[keep], np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
