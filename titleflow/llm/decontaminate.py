"""Benchmark decontamination by greedy string tiling.

Texts become word sequences (lower case, punctuation and symbols aside).
Every window of ``min_tile`` words of a benchmark item is a seed; a document's
windows, hashed by a running Karp-Rabin polynomial, are joined with the seeds.
Neighbouring seed hits make maximal matches; the longest one whose words are
still free in both texts is marked as a tile, again and again, until none of
``min_tile`` words is left.  The share of an item's words under tiles is its
coverage, whatever the order of the passages, and ``min_coverage`` decides.
Ties go to the match that starts first in the item, then in the document.

Benchmark items are dealt out by row, copies too, in blocks of about
``block_words`` words; a block is what a task holds (vocabulary, seeds), so
memory doesn't grow with the benchmark: more items mean more blocks, each held
against every document.  With more blocks than one the documents are written
once with a row key, every block writes its hits alone, and they meet at the end.

Cases: null or empty texts match nothing, nor do items of fewer than
``min_tile`` words; repeated items and rows are reported each; extra columns pass through.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titleflow.llm.common import bound_batches, free_name, materialise, slices
from titleflow.session import shared_path

WORDS = re.compile(r"[^\W_]+")
#: Seed hits turned into runs at once: bounds a task's memory, changes no result.
PAIRS = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
HIT = T.ArrayType(
    T.StructType(
        [T.StructField("item_id", T.LongType())]
        + [T.StructField(n, T.IntegerType()) for n in ("n_item_words", "n_covered", "n_tiles", "longest")]
    )
)
ARROW_HIT = pa.list_(
    pa.struct([("item_id", pa.int64()), ("n_item_words", pa.int32()), ("n_covered", pa.int32()), ("n_tiles", pa.int32()), ("longest", pa.int32())])
)


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def window_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows, as the difference of running polynomials would give them (mod 2^64)."""
    n = len(ids) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        out = out * BASE + (ids[k : n + k].astype(np.uint64) + np.uint64(2))
    return out


class Seeds:
    """Vocabulary and seed windows of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], min_tile: int):
        self.min_tile = min_tile
        self.vocab: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        for item_id, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text or "")]
            if len(ids) >= min_tile:
                self.items.append((item_id, np.array(ids, np.int64)))
        hashes = [window_hashes(ids, min_tile) for _, ids in self.items]
        sizes = [len(h) for h in hashes]
        key = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.item = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.at = (np.concatenate([np.arange(s) for s in sizes]) if sizes else np.zeros(0, np.int64))[order]
        self.lengths = np.array([len(ids) for _, ids in self.items], np.int64)
        self.words = np.concatenate([ids for _, ids in self.items]) if self.items else np.zeros(0, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def joined(self, text: str, min_coverage: float = 0.0) -> dict[int, np.ndarray]:
        """item number -> its maximal matches in a text, rows of (item position, document position, length).

        Items whose matches all together are shorter than ``min_coverage`` are left out.
        """
        get = self.vocab.get
        words = words_of(text)
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        if len(ids) < self.min_tile or not len(self.key):
            return {}
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        whole = np.flatnonzero(known[self.min_tile :] - known[: -self.min_tile] == self.min_tile)
        if not len(whole):
            return {}
        hashes = np.zeros(len(whole), np.uint64)
        for k in range(self.min_tile):
            hashes = hashes * BASE + (ids[whole + k].astype(np.uint64) + np.uint64(2))
        lo, hi = np.searchsorted(self.key, hashes, "left"), np.searchsorted(self.key, hashes, "right")
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            return {}
        upto = np.cumsum(hi[hit] - lo[hit])
        # Hits become runs some at a time: a text of one word repeated has a hit for every pair of positions.
        cuts = np.unique(np.searchsorted(upto, np.arange(0, upto[-1] + PAIRS, PAIRS), "left").clip(0, len(hit)))
        runs = [self._runs(ids, whole[some], lo[some], hi[some]) for some in np.split(hit, cuts) if len(some)]
        item, shift, first, last = _merged(np.concatenate(runs, axis=1)) if len(runs) > 1 else runs[0]
        size = last - first + self.min_tile
        enough = np.bincount(item, size, len(self.items)) >= np.maximum(min_coverage * self.lengths, 1)
        chosen = enough[item]
        item, found = item[chosen], np.stack([first, first + shift, size], axis=1)[chosen]
        borders = np.flatnonzero(np.diff(item)) + 1
        return {int(i): rows for i, rows in zip(item[np.r_[0, borders]], np.split(found, borders))} if len(item) else {}

    def _runs(self, ids: np.ndarray, windows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """(item, diagonal, first and last item position) of neighbouring equal windows."""
        counts = hi - lo
        seed = np.arange(counts.sum()) + np.repeat(lo - (np.cumsum(counts) - counts), counts)
        d, item, at = np.repeat(windows, counts), self.item[seed], self.at[seed]
        place = self.starts[item] + at
        same = np.ones(len(seed), bool)
        for k in range(self.min_tile):
            same &= self.words[place + k] == ids[d + k]
        d, item, at = d[same], item[same], at[same]
        return _merged(np.stack([item, d - at, at, at]))


def _merged(runs: np.ndarray) -> np.ndarray:
    """Runs that follow each other on a diagonal as one; sorted by item, diagonal and position."""
    item, shift, first, last = runs = runs[:, np.lexsort(runs[2::-1])]
    joins = (item[1:] == item[:-1]) & (shift[1:] == shift[:-1]) & (first[1:] == last[:-1] + 1)
    begin = np.flatnonzero(np.r_[True, ~joins][: len(item)])
    end = np.r_[begin[1:], len(item)][: len(begin)] - 1
    return np.stack([item[begin], shift[begin], first[begin], last[end]])


def tile(matches, width: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item position, document position, length) from matches of the same form."""
    heap = [(-size, i, d) for i, d, size in np.asarray(matches, np.int64).reshape(-1, 3).tolist()]
    heapq.heapify(heap)
    n_free = reach(matches)
    item_marks: set[int] = set()
    doc_marks: set[int] = set()
    tiles: list[tuple[int, int, int]] = []
    while heap and n_free - len(item_marks) >= width:
        size, i, d = heapq.heappop(heap)
        free = [k for k in range(-size) if i + k not in item_marks and d + k not in doc_marks]
        if len(free) == -size:
            tiles.append((i, d, -size))
            item_marks.update(range(i, i - size))
            doc_marks.update(range(d, d - size))
            continue
        # What earlier tiles leave of the match may still be long enough.
        run: list[int] = []
        for k in [*free, None]:
            if run and (k is None or k != run[-1] + 1):
                if len(run) >= width:
                    heapq.heappush(heap, (-len(run), i + run[0], d + run[0]))
                run = []
            if k is not None:
                run.append(k)
    return tiles


def reach(matches) -> int:
    """How many words of the item lie in any match: no tiles cover more."""
    rows = np.asarray(matches, np.int64).reshape(-1, 3)
    if not len(rows):
        return 0
    ends = rows[:, 0] + rows[:, 2]
    depth = np.zeros(ends.max() + 1, np.int64)
    np.add.at(depth, rows[:, 0], 1)
    np.add.at(depth, ends, -1)
    return int((np.cumsum(depth) > 0).sum())


def leaks(text: str, seeds: Seeds, min_coverage: float) -> list[dict]:
    """The items that a text covers to ``min_coverage`` or more."""
    out = []
    for number, matches in seeds.joined(text, min_coverage).items():
        item_id, ids = seeds.items[number]
        if reach(matches) < min_coverage * len(ids):
            continue
        tiles = tile(matches, seeds.min_tile)
        covered = sum(size for _, _, size in tiles)
        if covered >= min_coverage * len(ids):
            out.append({"item_id": item_id, "n_item_words": len(ids), "n_covered": covered, "n_tiles": len(tiles), "longest": max(s for _, _, s in tiles)})
    return out


def blocks(items: DataFrame, item_id: str, text: str, min_tile: int, block_words: int) -> Iterator[tuple[Seeds, bool]]:
    """The benchmark's blocks, one at a time, and whether more follow.

    Each is bounded by ``block_words`` on average: rows are dealt out by a row
    number that is written first, so copies of one item don't share a block.
    """
    numbered = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("t"), F.monotonically_increasing_id().alias("row"))
    numbered = materialise(numbered, "benchmark-items")
    n_words = F.size(F.split(F.coalesce("t", F.lit("")), r"\s+")).cast("bigint")
    n = -(-(numbered.agg(F.sum(n_words)).first()[0] or 0) // block_words)
    at = F.pmod(F.xxhash64("row"), F.lit(max(n, 1)))
    for b in range(n):
        yield Seeds([tuple(r) for r in numbered.where(at == b).orderBy("row").select("id", "t").collect()], min_tile), b + 1 < n


def with_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_tile: int = 5,
    min_coverage: float = 0.8,
    block_words: int = 2_000_000,
    keep: list[str] | None = None,
    found: str = "_leaks",
) -> DataFrame:
    """Columns ``keep`` (default: all) and ``found``, which ``keep`` must not hold: array of (item_id, n_item_words, n_covered, n_tiles, longest)."""
    bound_batches(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    if free_name([*keep, text], found) != found:
        raise ValueError(f"documents have a column {found}; name another in found")
    source = docs.select(*dict.fromkeys([*keep, text]))
    row = free_name([*source.columns, found], "_row")
    rowed = hits = None
    for b, (seeds, more) in enumerate(blocks(items, item_id, item_text, min_tile, block_words)):
        if b == 0 and not more:
            return _scan_block(source, text, seeds, min_coverage, found).select(*keep, found)
        if rowed is None:
            # The documents are written once, with a row key; each block then adds only its hits.
            rowed = materialise(source.withColumn(row, F.monotonically_increasing_id()), "tiled-documents")
            hits = shared_path(docs.sparkSession, "llm", "tiled-hits")
        one = _scan_block(rowed.select(row, text), text, seeds, min_coverage, found)
        one.where(F.size(found) > 0).select(row, found).write.parquet(f"{hits}/block={b}")
    empty = F.array().cast(HIT.simpleString())
    if rowed is None:
        return source.select(*keep, empty.alias(found))
    stored = docs.sparkSession.read.schema(f"`{row}` bigint, `{found}` {HIT.simpleString()}, block int").parquet(hits)
    by_row = stored.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("block", F.col(found).alias("hits")))).alias(found))
    by_row = by_row.select(row, F.flatten(F.col(f"{found}.hits")).alias(found))
    return rowed.select(*keep, row).join(by_row, row, "left").select(*keep, F.coalesce(found, empty).alias(found))


def _scan_block(docs: DataFrame, text: str, seeds: Seeds, min_coverage: float, column: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(seeds)
    others = docs.columns

    def run(batches):
        own = shared.value
        for batch in batches:
            for part, texts in slices(batch, text):
                found = [leaks(t.decode(), own, min_coverage) for t in texts]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), pa.array(found, ARROW_HIT)], names=[*others, column])

    return docs.mapInArrow(run, T.StructType([*(docs.schema[c] for c in others), T.StructField(column, HIT)]))
