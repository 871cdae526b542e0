"""Ranked lexical search: MaxScore with bounds on pairs of terms.

``build`` writes an inverted index in shards of bounded size: per shard and
term the documents and their counts, per shard the document ids and lengths.
For the ``PAIR_TERMS`` terms found in most documents it also writes, per shard
and pair of them, the list of documents that hold both and the largest joint
impact that any of them gives.

``search`` takes the queries in blocks of bounded size, reads the lists of
their terms only, and ranks each query inside each shard:

* terms go by falling bound (their largest impact in the shard); the k-th best
  partial score so far is the threshold;
* what the terms still to come can add is bounded by pairing them: a document
  that holds both of a pair adds their joint maximum at most, one that holds
  one of them that one's own maximum.  This is less than the sum of both
  maxima, since they rarely meet in one document;
* once that bound falls below the threshold no new document can enter, and
  the remaining lists are only looked up for documents that still may.  A step
  before, if a document with the next term but not its partner can't reach the
  threshold, new documents come from the pair's list alone.

The best k of each shard are then merged.  Scores are whole numbers, so the
result is exact and does not depend on how documents lie in shards.

Cases: documents without a term are not indexed and never found; a null text
has no term; a null id ranks after all others at equal score; repeated rows of
either side count each; a query without a known term gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titleflow.llm.common import bound_batches, materialise, slices

SHARD_BYTES = 32 << 20
SHARD_DOCS = (1 << 16) - 1  # places in a shard fit in two bytes
PAIR_TERMS = 32
BLOCK_TERMS = 500_000

#: ASCII letters and digits and every byte of other characters make terms; A-Z in lower case.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

INDEX = "kind int, shard bigint, term string, other string, n_docs bigint, n_terms bigint, top bigint, ids array<bigint>, docs binary, counts binary"
ARROW_INDEX = pa.schema(
    [
        ("kind", pa.int32()),
        ("shard", pa.int64()),
        ("term", pa.string()),
        ("other", pa.string()),
        ("n_docs", pa.int64()),
        ("n_terms", pa.int64()),
        ("top", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("docs", pa.binary()),
        ("counts", pa.binary()),
    ]
)
SHARD, POSTINGS, PAIR = 0, 1, 2


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


@dataclass(frozen=True)
class Scoring:
    """N and L: the documents with a term and all their terms."""

    n_docs: int
    n_terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1)))

    def impacts(self, weight: np.ndarray | int, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        m = 75 + (25 * length * self.n_docs) // self.n_terms
        return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


@dataclass
class Index:
    rows: DataFrame  # INDEX without pairs
    pairs: DataFrame  # INDEX, pairs only
    scoring: Scoring


# ------------------------------------------------------------------ building
def _cut_binary(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A binary array whose values are the slices of ``data`` that begin at ``starts``."""
    offsets = np.append(starts, len(data)).astype(np.int32) * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _shard_rows(shard: int, ids: list[int | None], lengths: list[int], vocab: dict[bytes, int], codes: list[np.ndarray]) -> pa.RecordBatch:
    """The index rows of one shard: its documents, then a row for each term."""
    length = np.array(lengths, np.int64)
    doc = np.repeat(np.arange(len(length)), length)
    key, tf = np.unique(np.concatenate(codes).astype(np.int64) << 16 | doc, return_counts=True)
    term = key >> 16
    starts = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    n = len(starts)
    names = [w.decode() for w in vocab]  # a term's code is its place
    one = [
        pa.array([SHARD] + [POSTINGS] * n, pa.int32()),
        pa.array(np.full(n + 1, shard), pa.int64()),
        pa.array([None, *names], pa.string()),
        pa.nulls(n + 1, pa.string()),
        pa.array(np.concatenate([[len(length)], np.diff(np.append(starts, len(term)))]), pa.int64()),
        pa.array(np.concatenate([[length.sum()], np.add.reduceat(tf, starts)]), pa.int64()),
        pa.nulls(n + 1, pa.int64()),
        pa.concat_arrays([pa.array([ids], pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))]),
        pa.concat_arrays([pa.nulls(1, pa.binary()), _cut_binary((key & 0xFFFF).astype(np.uint16), starts)]),
        pa.concat_arrays([pa.array([length.astype(np.int32).tobytes()], pa.binary()), _cut_binary(tf.astype(np.int32), starts)]),
    ]
    return pa.RecordBatch.from_arrays(one, schema=ARROW_INDEX)


def _index_rows(docs: DataFrame, doc_id: str, text: str, shard_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, base = 0, TaskContext.get().partitionId() << 24

        def fresh():
            vocab: dict[bytes, int] = defaultdict()
            vocab.default_factory = vocab.__len__
            return [], [], vocab, []

        ids, lengths, vocab, codes = fresh()
        size = 0
        for batch in batches:
            for part, texts in slices(batch, "body"):
                for i, t in zip(part.column("id").to_pylist(), texts):
                    words = terms_of(t)
                    if not words:
                        continue
                    if ids and (len(ids) == SHARD_DOCS or size + len(t) > shard_bytes):
                        yield _shard_rows(base + made, ids, lengths, vocab, codes)
                        ids, lengths, vocab, codes = fresh()
                        made, size = made + 1, 0
                    ids.append(i)
                    lengths.append(len(words))
                    codes.append(np.fromiter(map(vocab.__getitem__, words), np.int32, len(words)))
                    size += len(t)
        if ids:
            yield _shard_rows(base + made, ids, lengths, vocab, codes)

    bound_batches(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("body"))
    return source.mapInArrow(run, INDEX)


class Shard:
    """One shard's lists of the terms that are asked for."""

    def __init__(self, table: pa.Table, weights: dict[str, int], scoring: Scoring):
        rows = table.to_pylist()
        head = next(r for r in rows if r["kind"] == SHARD)
        self.ids = head["ids"]
        # Equal scores go by id, null ids last.
        order = sorted(range(len(self.ids)), key=lambda d: (self.ids[d] is None, self.ids[d] or 0))
        self.id_rank = np.empty(len(order), np.int64)
        self.id_rank[order] = np.arange(len(order))
        lengths = np.frombuffer(head["counts"], np.int32).astype(np.int64)
        self.lists: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.top: dict[str, int] = {}
        self.pairs: dict[tuple[str, str], tuple[int, np.ndarray]] = {}
        for r in rows:
            if r["kind"] == POSTINGS and r["term"] in weights:
                docs = np.frombuffer(r["docs"], np.uint16).astype(np.int64)
                tf = np.frombuffer(r["counts"], np.int32).astype(np.int64)
                own = scoring.impacts(weights[r["term"]], tf, lengths[docs])
                self.lists[r["term"]] = docs, own
                self.top[r["term"]] = int(own.max())
            elif r["kind"] == PAIR:
                self.pairs[r["term"], r["other"]] = r["top"], np.frombuffer(r["docs"], np.uint16)


def _pair_rows(shard: Shard, number: int) -> pa.RecordBatch:
    """A row for each pair of the shard's listed terms that meet in a document."""
    rows = []
    terms = sorted(shard.lists)
    size = len(shard.ids)
    for a, first in enumerate(terms):
        docs, own = shard.lists[first]
        mine = np.zeros(size, np.int64)
        mine[docs] = own
        here = np.zeros(size, bool)
        here[docs] = True
        for second in terms[a + 1 :]:
            others, theirs = shard.lists[second]
            both = here[others]
            if both.any():
                top = int((mine[others[both]] + theirs[both]).max())
                rows.append({"kind": PAIR, "shard": number, "term": first, "other": second, "top": top, "docs": others[both].astype(np.uint16).tobytes()})
    return pa.RecordBatch.from_pylist([{n: r.get(n) for n in ARROW_INDEX.names} for r in rows], schema=ARROW_INDEX)


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> Index:
    rows = materialise(_index_rows(docs, doc_id, text, shard_bytes), "search-index", "kind").select(*ARROW_INDEX.names)
    n_docs, n_terms = rows.where(F.col("kind") == SHARD).agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    scoring = Scoring(n_docs, max(n_terms, 1))
    postings = rows.where(F.col("kind") == POSTINGS)
    heavy = postings.groupBy("term").agg(F.sum("n_docs").alias("df")).orderBy(F.desc("df"), "term").limit(PAIR_TERMS).collect()
    weights = {r["term"]: scoring.weight(r["df"]) for r in heavy}

    def run(table):
        number = table.column("shard")[0].as_py()
        return pa.Table.from_batches([_pair_rows(Shard(table, weights, scoring), number)], schema=ARROW_INDEX)

    wanted = rows.where((F.col("kind") == SHARD) | F.col("term").isin(list(weights)))
    pairs = materialise(wanted.groupBy("shard").applyInArrow(run, INDEX), "search-pairs")
    return Index(rows, pairs, scoring)


# ------------------------------------------------------------------ one query in one shard
class Bounds:
    """What the terms from a place on can add, for every place, with pairs.

    ``upto[j]`` bounds the terms j, j+1, ...; ``partner[j]`` is the paired
    later term of j, if pairing them bounds less than their sum.
    """

    def __init__(self, shard: Shard, terms: list[tuple[str, int]], independent: bool = False):
        n = len(terms)
        self.own = [shard.top[t] * q for t, q in terms]
        self.pair: dict[tuple[int, int], int] = {}
        self.partner = [-1] * n
        self.upto = [0] * (n + 1)
        free: list[int] = []  # later terms with pairs but without a partner
        for j in range(n - 1, -1, -1):
            gain, best = 0, -1
            if not independent:
                for i in free:
                    bound = self._joint(shard, terms, j, i)
                    if bound is not None and self.own[j] + self.own[i] - bound > gain:
                        gain, best = self.own[j] + self.own[i] - bound, i
                        self.pair[j, i] = bound
            self.upto[j] = self.upto[j + 1] + self.own[j] - gain
            if best >= 0:
                self.partner[j] = best
                free.remove(best)
            else:
                free.append(j)
        self.paired_with = {i: j for j, i in enumerate(self.partner) if i >= 0}

    def _joint(self, shard: Shard, terms: list[tuple[str, int]], j: int, i: int) -> int | None:
        (a, p), (b, q) = terms[j], terms[i]
        found = shard.pairs.get((a, b) if a < b else (b, a))
        if found is None:
            return None
        # The list's joint maximum counts both terms once; further repeats count alone.
        both = min(p, q) * found[0] + (p - min(p, q)) * shard.top[a] + (q - min(p, q)) * shard.top[b]
        return max(self.own[j], self.own[i], both)

    def without(self, j: int, i: int) -> int:
        """What the terms after j can add, without the later term i."""
        total = self.upto[j + 1]
        mate = self.partner[i] if self.partner[i] >= 0 else self.paired_with.get(i, -1)
        if mate > j:
            first, second = min(i, mate), max(i, mate)
            return total - self.pair[first, second] + self.own[mate]
        return total - self.own[i]


def best_of(shard: Shard, query: dict[str, int], k: int, independent: bool = False) -> tuple[list[tuple[int, int]], int]:
    """([(place, score)] of the k best documents of the shard, lists' entries visited)."""
    terms = sorted(((t, q) for t, q in query.items() if t in shard.lists), key=lambda x: (-shard.top[x[0]] * x[1], x[0]))
    bounds = Bounds(shard, terms, independent)
    score = np.zeros(len(shard.ids), np.int64)
    seen = np.zeros(len(shard.ids), bool)
    threshold, highest, visited = 0, 0, 0
    alive: np.ndarray | None = None  # places that may still be among the best; None: any

    def kth(places: np.ndarray) -> int:
        own = score[places]
        return int(np.partition(own, len(own) - k)[len(own) - k]) if len(own) >= k else 0

    for j, (term, q) in enumerate(terms):
        docs, own = shard.lists[term]
        if alive is None and bounds.upto[j] < highest:
            places = np.flatnonzero(seen)
            threshold = max(threshold, kth(places))
            if bounds.upto[j] < threshold:
                alive = places
            elif bounds.upto[j + 1] < threshold and not independent:
                # New documents must hold this term; maybe also another one that shares a list with it.
                for i in range(j + 1, len(terms)):
                    shared = shard.pairs.get((term, terms[i][0]) if term < terms[i][0] else (terms[i][0], term))
                    if shared is not None and bounds.own[j] + bounds.without(j, i) < threshold:
                        alive = np.union1d(places, shared[1].astype(np.int64))
                        break
        if alive is not None:
            alive = alive[score[alive] + bounds.upto[j] >= threshold]
        if alive is None or len(docs) <= 4 * len(alive):
            visited += len(docs)
            score[docs] += q * own
            seen[docs] = True
            highest = max(highest, int(score[docs].max()))
        else:
            visited += len(alive)
            at = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
            hit = docs[at] == alive
            score[alive[hit]] += q * own[at[hit]]
        if alive is not None:
            threshold = max(threshold, kth(alive))
    left = np.flatnonzero(seen) if alive is None else alive
    left = left[score[left] > 0]
    order = np.lexsort((shard.id_rank[left], -score[left]))[:k]
    return [(int(d), int(score[d])) for d in left[order]], visited


# ------------------------------------------------------------------ searching
def _blocks(items: DataFrame, item_id: str, text: str, block_terms: int) -> Iterator[list[tuple]]:
    """The queries (row, id, text) in blocks of about ``block_terms`` words, dealt out by row."""
    numbered = items.select(F.monotonically_increasing_id().alias("row"), F.col(item_id).alias("id"), F.col(text).cast("string").alias("t"))
    numbered = materialise(numbered, "search-queries")
    n_words = F.size(F.split(F.coalesce("t", F.lit("")), r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+")).cast("bigint")
    n = max(-(-(numbered.agg(F.sum(n_words)).first()[0] or 0) // block_terms), 1)
    for b in range(n):
        yield [tuple(r) for r in numbered.where(F.pmod(F.xxhash64("row"), F.lit(n)) == b).collect()]


def _block_search(shared: Broadcast, k: int) -> Callable:
    def run(table):
        queries, weights, scoring = shared.value
        shard = Shard(table, weights, scoring)
        rows = [(row, shard.ids[d], s) for row, q in queries.items() for d, s in best_of(shard, q, k)[0]]
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("row", "doc_id", "score"), columns)})

    return run


def search(
    index: Index,
    items: DataFrame,
    item_id: str = "item_id",
    text: str = "text",
    k: int = 20,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each query with a score above 0."""
    spark = items.sparkSession
    id_type = items.schema[item_id].dataType.simpleString()
    found = []
    for block in _blocks(items, item_id, text, block_terms):
        queries = {row: Counter(w.decode() for w in terms_of((t or "").encode())) for row, _, t in block}
        asked = spark.createDataFrame([(t,) for t in sorted({t for q in queries.values() for t in q})], "term string")
        # The block bounds the number of terms, so this side is safe to broadcast.
        postings = index.rows.where(F.col("kind") == POSTINGS).join(F.broadcast(asked), "term", "left_semi").select(*ARROW_INDEX.names)
        df = dict(map(tuple, postings.groupBy("term").agg(F.sum("n_docs")).collect()))
        weights = {t: index.scoring.weight(n) for t, n in df.items()}
        shared = spark.sparkContext.broadcast((queries, weights, index.scoring))

        lists = index.rows.where(F.col("kind") == SHARD).unionByName(postings).unionByName(index.pairs)
        hits = lists.groupBy("shard").applyInArrow(_block_search(shared, k), "row bigint, doc_id bigint, score bigint")
        ids = spark.createDataFrame([(row, i) for row, i, _ in block], f"row bigint, item_id {id_type}")
        best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        ranked = ranked.join(F.broadcast(ids), "row").select(F.col("item_id").alias(item_id), "rank", "doc_id", "score")
        found.append(materialise(ranked, "search-results"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
