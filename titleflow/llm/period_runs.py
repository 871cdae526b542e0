"""Periodic runs of words, by longest common extensions on suffix trees.

A run is a stretch of words with smallest period q that no neighbouring word
extends.  Every run holds a Lyndon root: for the words' order or its reverse,
some position's longest Lyndon word is as long as the period.  So for both
orders each position offers one candidate root, and the root is extended to
the right and to the left as far as the period lasts.  Both extensions are
longest common extensions: of two suffixes of the text, and of two suffixes of
its reversal.  They come from an Ukkonen suffix tree of each, whose Euler tour
answers the depth of a lowest common ancestor in constant time (block minima
in a sparse table, and minima from both ends of each block).

Before the trees are built a document is cut down to where runs can lie.  A
run of ``min_periods`` periods or more has each of its words that many times,
and each pair of neighbours once less, so stretches with a rarer word or pair
hold no part of a run.  What is left is joined by marks that occur once each,
which no extension crosses; a text that is periodic all over stays whole.

Cases: a null or empty text has no runs and no words; equal rows give equal
rows; texts of any length are worked on whole, one at a time, in memory
proportional to the words left after the cut; extra columns are left to the
caller's ``keep``.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from titleflow.llm.common import map_texts

MIN_LENGTH = 6
MIN_PERIODS = 4
BLOCK = 16

Run = tuple[int, int, int]  # start, length, period
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class SuffixTree:
    """Ukkonen's suffix tree of symbols 1..k; the mark 0 is put at the end."""

    def __init__(self, symbols: list[int]):
        s = [*symbols, 0]
        self.n = n = len(s)
        self.width = width = max(s) + 1
        start, end, link = [0], [0], [0]
        edges: dict[int, int] = {}
        node = edge = length = pending = 0
        for i, c in enumerate(s):
            unlinked = -1
            pending += 1
            while pending:
                if not length:
                    edge = i
                key = node * width + s[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if unlinked >= 0:
                        link[unlinked] = node
                        unlinked = -1
                else:
                    size = min(end[child], i + 1) - start[child]
                    if length >= size:  # walk down
                        edge += size
                        length -= size
                        node = child
                        continue
                    if s[start[child] + length] == c:
                        length += 1
                        if unlinked >= 0:
                            link[unlinked] = node
                        break
                    split = len(start)
                    edges[key] = split
                    edges[split * width + c] = split + 1
                    start += [start[child], i]
                    end += [start[child] + length, n]
                    link += [0, 0]
                    start[child] += length
                    edges[split * width + s[start[child]]] = child
                    if unlinked >= 0:
                        link[unlinked] = split
                    unlinked = split
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.child = np.fromiter(edges.values(), np.int64, len(edges))
        self.parent, self.symbol = keys // width, keys % width
        self.size = np.array(end, np.int64) - np.array(start, np.int64)

    def tour(self, falling: bool = False) -> tuple[list[int], list[int], list[int]]:
        """(depths along the Euler tour, suffixes in order, place of each in the tour).

        Children go by symbol, or by falling symbol; the end mark is least in both orders.
        """
        rank = np.where(self.symbol > 0, self.width - self.symbol, 0) if falling else self.symbol
        order = np.lexsort((rank, self.parent))
        child = self.child[order].tolist()
        first = np.searchsorted(self.parent[order], np.arange(len(self.size) + 1)).tolist()
        size, n = self.size.tolist(), self.n
        depths, leaves, places = [0], [], []
        nodes, nexts, below = [0], [first[0]], [0]
        while nodes:
            node, at = nodes[-1], nexts[-1]
            if at == first[node + 1]:
                nodes.pop()
                nexts.pop()
                below.pop()
                if below:
                    depths.append(below[-1])
                continue
            nexts[-1] = at + 1
            down = child[at]
            depth = below[-1] + size[down]
            if first[down] == first[down + 1]:
                leaves.append(n - depth)
                places.append(len(depths))
                depths += (depth, below[-1])
            else:
                nodes.append(down)
                nexts.append(first[down])
                below.append(depth)
                depths.append(depth)
        return depths, leaves, places


class Extensions:
    """Longest common extensions of suffixes, many pairs at once."""

    def __init__(self, tree: SuffixTree):
        depths, leaves, places = tree.tour()
        self.leaves = leaves
        self.n = tree.n
        self.place = np.empty(tree.n, np.int64)
        self.place[leaves] = places
        size = -(-len(depths) // BLOCK) * BLOCK
        padded = np.full(size, tree.n, np.int32)
        padded[: len(depths)] = depths
        blocks = padded.reshape(-1, BLOCK)
        self.depths = padded
        self.upto = np.minimum.accumulate(blocks, axis=1).ravel()
        self.onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [blocks.min(axis=1)]
        step = 1
        while 2 * step <= len(blocks):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far the suffixes at i and j (i != j) agree."""
        a, b = self.place[i], self.place[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        left, right = low // BLOCK, high // BLOCK
        out = np.empty(len(low), np.int64)
        near = np.flatnonzero(left == right)
        if len(near):
            least = self.depths[low[near]].copy()
            for k in range(1, BLOCK):
                least = np.minimum(least, self.depths[np.minimum(low[near] + k, high[near])])
            out[near] = least
        far = np.flatnonzero(left < right)
        if len(far):
            least = np.minimum(self.onward[low[far]], self.upto[high[far]])
            begin, count = left[far] + 1, right[far] - left[far] - 1
            for level, minima in enumerate(self.levels):
                some = np.flatnonzero((count >> level) == 1)
                if len(some):
                    ends = begin[some] + count[some] - (1 << level)
                    least[some] = np.minimum(least[some], np.minimum(minima[begin[some]], minima[ends]))
            more = np.flatnonzero(count >> len(self.levels) > 0)
            assert not len(more)
            out[far] = least
        return out


def lyndon_sizes(leaves: list[int]) -> np.ndarray:
    """The longest Lyndon word at each position: up to the next smaller suffix."""
    n = len(leaves)
    rank = [0] * n
    for r, i in enumerate(leaves):
        rank[i] = r
    out = np.ones(n, np.int64)
    waiting: list[int] = []
    for i in range(n):
        r = rank[i]
        while waiting and rank[waiting[-1]] > r:
            j = waiting.pop()
            out[j] = i - j
        waiting.append(i)
    return out[:-1]  # without the end mark


def all_runs(symbols: list[int], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[Run]:
    """The runs of at least ``min_length`` symbols and ``min_periods`` (2 or more) periods, by start, then period."""
    n = len(symbols)
    if n < 2:
        return []
    tree = SuffixTree(symbols)
    forward = Extensions(tree)
    sizes = [lyndon_sizes(forward.leaves), lyndon_sizes(tree.tour(falling=True)[1])]
    del tree
    backward = Extensions(SuffixTree(symbols[::-1]))
    at = np.tile(np.arange(n), 2)
    period = np.concatenate(sizes)
    to_right = forward.common(at, at + period)
    # To the left of i is, in the reversal, the suffix at n - i.
    to_left = backward.common(n - at, n - at - period)
    start, length = at - to_left, to_left + period + to_right
    good = np.flatnonzero((length >= min_periods * period) & (length >= min_length))
    return sorted({(int(start[k]), int(length[k]), int(period[k])) for k in good}, key=lambda r: (r[0], r[2]))


def stretches(words: list, min_periods: int) -> list[tuple[int, int]]:
    """(start, end) of where runs can lie: no word there occurs less than ``min_periods`` times, and no pair of neighbours less than once fewer."""
    counts = Counter(words)
    usual = {w for w, c in counts.items() if c >= min_periods}
    if not usual:
        return []
    parts: list[tuple[int, int]] = []
    start = -1
    for i, w in enumerate(words):
        if w in usual:
            if start < 0:
                start = i
        elif start >= 0:
            parts.append((start, i))
            start = -1
    if start >= 0:
        parts.append((start, len(words)))
    parts = [(a, b) for a, b in parts if b - a >= min_periods]
    pairs: Counter = Counter()
    for a, b in parts:
        pairs.update(zip(words[a : b - 1], words[a + 1 : b]))
    out = []
    for a, b in parts:
        first = a
        for i in range(a, b):
            if i + 1 == b or pairs[words[i], words[i + 1]] < min_periods - 1:
                if i + 1 - first >= min_periods:
                    out.append((first, i + 1))
                first = i + 1
    return out


def word_runs(words: list, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[Run]:
    """The runs among the words, by start, then period."""
    parts = stretches(words, min_periods)
    if not parts:
        return []
    ids: dict = {}
    symbols: list[int] = []
    origin: list[int] = []
    marks = 0
    for a, b in parts:
        if symbols:
            marks += 1
            symbols.append(-marks)
            origin.append(-1)
        symbols += [ids.setdefault(w, len(ids) + 1) for w in words[a:b]]
        origin += range(a, b)
    symbols = [x if x > 0 else len(ids) - x for x in symbols]
    return [(origin[start], length, period) for start, length, period in all_runs(symbols, min_length, min_periods)]


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without those that some run holds after its first period."""
    if not runs:
        return words
    turns = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        turns[start + period] += 1
        turns[start + length] -= 1
    gone = np.cumsum(turns[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g]


def find_runs(
    docs: DataFrame, keep: list[str], text: str = "text", min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS
) -> DataFrame:
    """Columns ``keep``, ``runs`` (array of start, length, period) and ``collapsed`` (the kept words, joined by a blank)."""

    def make():
        def fn(texts: list[bytes]):
            found, kept = [], []
            for t in texts:
                words = t.split()
                runs = word_runs(words, min_length, min_periods)
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                kept.append(b" ".join(collapsed(words, runs)).decode())
            return [pa.array(found, pa.list_(RUN_TYPE)), kept]

        return fn

    fields = [
        ("runs", "array<struct<start:bigint,length:bigint,period:bigint>>", pa.list_(RUN_TYPE)),
        ("collapsed", "string", pa.string()),
    ]
    return map_texts(docs, text, keep, fields, make)
