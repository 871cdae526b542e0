"""Language-model scoring by deleted interpolation of bigrams.

``P(w | h) = l2[b] c(h,w)/c(h) + l1[b] c(w)/N + l0[b] / (V + 1)``

The weights depend on the bucket ``b`` of the context's frequency (its power
of two).  They are learned by expectation-maximisation: one part of the
training documents is deleted from the counts, and its n-grams are predicted
from the counts of the rest.

Counts grow with the corpus, so they are never broadcast.  Documents are
tokenized once into *chunks* (a bounded run of texts of one part, with a
vocabulary of its own).  Every chunk sends its distinct n-grams, with how often its training
texts hold them, to the bucket of their hash; a bucket adds up what all chunks
sent and answers each chunk in the order it asked, so answers carry no keys.
Chunks then meet their answers: the held-out ones first, to gather their
statistics, and then all, to score.  N-grams are identified by 64-bit hashes.

Held-out statistics are counts per (bucket, p2, p1) with both probabilities on
a quarter-octave grid: a table of bounded size over all held-out events.

Cases: a null or empty text is the end token alone; with no training text all
probabilities come from the uniform part; repeated rows count and are scored
each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import bound_batches, materialise, slices

CHUNK_BYTES = 8 << 20
#: Tokens and n-grams (on average) that one bucket adds up, and tokens scored at once: both bound a task's memory.
BUCKET_KEYS = 1 << 21
SCORE_TOKENS = 1 << 18
#: The end token, also the context of a text's first word; it is no possible word.
END = b"\n"
KEPT, HELD, TEST = 0, 1, 2
GRID = 4  # steps of the held-out grid per octave
NO_P = 1 << 14
PRIOR = (0.6, 0.3, 0.1)


def pack(values: np.ndarray) -> bytes:
    """Compressed byte planes: the upper bytes of sorted or small numbers nearly vanish."""
    width = values.dtype.itemsize
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(dtype)


def bigram_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One 64-bit key per pair of word hashes."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(33))


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Bucket 0..n-1, rising with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


class Chunk:
    """The token sequences of a run of texts, over a local vocabulary."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, part: int, hashes: np.ndarray):
        self.lengths, self.part = lengths, part
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        self.uni_keys = hashes[order]
        self.word = place[tokens]
        starts = np.cumsum(lengths) - lengths
        before = np.empty_like(self.word)
        before[1:] = self.word[:-1]
        before[starts] = np.searchsorted(self.uni_keys, np.uint64(xxhash.xxh64_intdigest(END)))
        self.context = before
        codes, pair = np.unique(before.astype(np.int64) * len(hashes) + self.word, return_inverse=True)
        keys = bigram_keys(self.uni_keys[codes // len(hashes)], self.uni_keys[codes % len(hashes)])
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        self.pair_keys, self.pair = keys[order], place[pair]

    def requests(self):
        """(kind, keys, kept count, held count) of the unigrams (0) and bigrams (1)."""
        for kind, keys, at in ((0, self.uni_keys, self.word), (1, self.pair_keys, self.pair)):
            counts = np.bincount(at, minlength=len(keys)).astype(np.uint32)
            yield kind, keys, *(counts if self.part == p else np.zeros_like(counts) for p in (KEPT, HELD))


def _chunk_row(texts: list[bytes]) -> list[pa.Array]:
    vocab: dict[bytes, int] = {END: 0}
    tokens: list[int] = []
    lengths = []
    for t in texts:
        words = t.lower().split()
        tokens += [vocab.setdefault(w, len(vocab)) for w in words]
        tokens.append(0)
        lengths.append(len(words) + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, vocab), np.uint64, len(vocab))
    packed = (np.array(tokens, np.uint32), np.array(lengths, np.uint32), hashes)
    return [pa.array([len(tokens)], pa.int64()), *(pa.array([pack(x)], pa.binary()) for x in packed)]


CHUNK_SCHEMA = "chunk bigint, part int, doc_ids array<bigint>, n_words bigint, tokens binary, lengths binary, hashes binary"


def chunks(docs: DataFrame, part, doc_id: str, text: str) -> DataFrame:
    """Tokenized chunks; ``part`` is a column of KEPT, HELD or TEST."""
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), part.cast("int").alias("part"), F.col(text).cast("string").alias("t"))

    def run(batches):
        numbers = count(TaskContext.get().partitionId() << 24)
        held: dict[int, tuple[list, list[bytes]]] = {p: ([], []) for p in (KEPT, HELD, TEST)}
        sizes = dict.fromkeys(held, 0)

        def row(p: int):
            ids, texts = held[p]
            made = pa.RecordBatch.from_arrays(
                [pa.array([next(numbers)]), pa.array([p], pa.int32()), pa.array([ids], pa.list_(pa.int64())), *_chunk_row(texts)],
                names=["chunk", "part", "doc_ids", "n_words", "tokens", "lengths", "hashes"],
            )
            held[p], sizes[p] = ([], []), 0
            return made

        for batch in batches:
            for own, some in slices(batch, "t"):
                for doc, p, t in zip(own.column("doc_id").to_pylist(), own.column("part").to_pylist(), some):
                    held[p][0].append(doc)
                    held[p][1].append(t)
                    sizes[p] += len(t)
                    if sizes[p] >= CHUNK_BYTES:
                        yield row(p)
        yield from (row(p) for p, (_, texts) in held.items() if texts)

    return source.mapInArrow(run, CHUNK_SCHEMA)


def _load(row: dict) -> Chunk:
    return Chunk(
        unpack(row["tokens"], np.uint32),
        unpack(row["lengths"], np.uint32).astype(np.int64),
        row["part"],
        unpack(row["hashes"], np.uint64),
    )


def _ask(stored: DataFrame, n: int) -> DataFrame:
    """(kind, bucket, chunk, part, keys, kept, held): what each chunk sends to each bucket."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                out = defaultdict(list)
                for kind, keys, kept, held in _load(row).requests():
                    cuts = np.searchsorted(bucket_of(keys, n), np.arange(n + 1, dtype=np.uint64))
                    for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
                        part = slice(cuts[b], cuts[b + 1])
                        for name, value in zip(ASKED, (kind, int(b), row["chunk"], row["part"], pack(keys[part]), pack(kept[part]), pack(held[part]))):
                            out[name].append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[c], t) for c, t in zip(ASKED, [pa.int32(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 3])], names=ASKED
                )

    return stored.select("chunk", "part", "tokens", "lengths", "hashes").mapInArrow(run, "kind int, bucket int, chunk bigint, part int, keys binary, kept binary, held binary")


ASKED = ["kind", "bucket", "chunk", "part", "keys", "kept", "held"]
ANSWER_SCHEMA = "chunk bigint, part int, kind int, bucket int, kept binary, total binary, n_types bigint, n_kept bigint, n_total bigint"


def _answer(task: pa.Table) -> pa.Table:
    """Add up a bucket's n-grams; one row back to each chunk (the kept counts for held-out ones alone) and one (chunk -1) of sums."""
    rows = task.to_pylist()
    keys = [unpack(r["keys"], np.uint64) for r in rows]
    sizes = [len(k) for k in keys]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    add = lambda name: np.bincount(at, np.concatenate([unpack(r[name], np.uint32) for r in rows]), len(distinct)).astype(np.uint64)
    kept = add("kept")
    total = kept + add("held")
    kind, bucket = rows[0]["kind"], rows[0]["bucket"]
    cuts = np.cumsum([0, *sizes])
    out = [
        {"chunk": r["chunk"], "part": r["part"], "kind": kind, "bucket": bucket, "kept": pack(kept[at[a:b]]) if r["part"] == HELD else b"", "total": pack(total[at[a:b]]), "n_types": 0, "n_kept": 0, "n_total": 0}
        for r, a, b in zip(rows, cuts, cuts[1:])
    ]
    sums = {"n_types": int((total > 0).sum()), "n_kept": int(kept.sum()), "n_total": int(total.sum())}
    out.append({"chunk": -1, "part": -1, "kind": kind, "bucket": bucket, "kept": b"", "total": b""} | sums)
    return pa.Table.from_pylist(out, schema=pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("kept", pa.binary()), ("total", pa.binary()), ("n_types", pa.int64()), ("n_kept", pa.int64()), ("n_total", pa.int64())]))


def _counts(answers: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts of a chunk's unigrams and bigrams, in key order."""
    rows = sorted(answers.select(["kind", "bucket", column]).to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
    return tuple(np.concatenate([unpack(r[column], np.uint64) for r in rows if r["kind"] == k]).astype(np.float64) for k in (0, 1))


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else 1 + the power of two of the count."""
    return np.where(count > 0, np.frexp(np.maximum(count, 1))[1], 0).astype(np.int64)


def _parts(chunk: Chunk, uni: np.ndarray, pair: np.ndarray, total: float, some: slice):
    """(context bucket, p2, p1) of the tokens ``some``."""
    seen = uni[chunk.context[some]]
    p2 = pair[chunk.pair[some]] / np.maximum(seen, 1)
    return context_bucket(seen), p2, uni[chunk.word[some]] / max(total, 1)


def _on_grid(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.rint(GRID * np.log2(np.maximum(p, 1e-300))), NO_P).astype(np.int64)


def learn_weights(cells: list[tuple[int, int, int, int]], uniform: float, rounds: int = 50) -> dict[int, tuple[float, float, float]]:
    """Expectation-maximisation of the three weights of each context bucket.

    ``cells`` are (bucket, grid p2, grid p1, count); ``PRIOR`` counts as one
    event, so every weight stays positive.
    """
    value = lambda q: np.where(q == NO_P, 0.0, 2.0 ** (np.where(q == NO_P, 0, q) / GRID))
    by: dict[int, list] = defaultdict(list)
    for b, *rest in cells:
        by[b].append(rest)
    out = {}
    for b, rows in by.items():
        q2, q1, n = np.array(rows, np.int64).T
        p = np.stack([value(q2), value(q1), np.full(len(n), uniform)])
        weight = np.array(PRIOR)
        for _ in range(rounds):
            share = weight[:, None] * p
            share /= share.sum(axis=0)
            weight = (share * n).sum(axis=1) + np.array(PRIOR)
            weight /= weight.sum()
        out[b] = tuple(weight.tolist())
    return out


def by_bucket(learned: dict[int, tuple[float, float, float]], size: int = 64) -> list[tuple[float, float, float]]:
    """Weights of every context bucket.  One that no held-out event reached takes
    those of the nearest learned bucket of rarer contexts, or else of the nearest
    of more frequent ones; unseen contexts (bucket 0) share with no other."""
    seen = sorted(b for b in learned if b > 0)
    out = [learned.get(0, PRIOR)]
    for b in range(1, size):
        below = [x for x in seen if x <= b]
        out.append(learned[below[-1] if below else seen[0]] if seen else PRIOR)
    return out


def score(docs: DataFrame, part, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, part, n_tokens, n_known, train_tokens, base_score, score.

    ``part`` says whether a document is counted (KEPT), counted and used to
    learn the weights (HELD), or only scored (TEST).
    """
    spark = docs.sparkSession
    bound_batches(spark)
    stored = materialise(chunks(docs, part, doc_id, text), "lm-chunks")
    n_words = stored.agg(F.sum("n_words")).first()[0] or 0
    # A chunk asks for at most two n-grams a token, so buckets stay bounded however large the corpus.
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * n_words // BUCKET_KEYS))
    answers = materialise(_ask(stored, n).groupBy("kind", "bucket").applyInArrow(_answer, ANSWER_SCHEMA), "lm-answers")
    sums = answers.where("chunk = -1 and kind = 0").agg(F.sum("n_types"), F.sum("n_kept"), F.sum("n_total")).first()
    n_types, n_kept, n_total = (x or 0 for x in sums)
    uniform = 1.0 / (n_types + 1)
    asked = answers.where("chunk >= 0").select("chunk", "part", "kind", "bucket", "kept", "total")

    def held_cells(rows: pa.Table, counts: pa.Table) -> pa.Table:
        cells: dict = {}
        for row in rows.to_pylist():
            chunk = _load(row)
            uni, pair = _counts(counts, "kept")
            for first in range(0, len(chunk.word), SCORE_TOKENS):
                b, p2, p1 = _parts(chunk, uni, pair, n_kept, slice(first, first + SCORE_TOKENS))
                at, n_at = np.unique(np.stack([b, _on_grid(p2), _on_grid(p1)]), axis=1, return_counts=True)
                for cell, k in zip(at.T.tolist(), n_at.tolist()):
                    cells[tuple(cell)] = cells.get(tuple(cell), 0) + k
        table = [list(x) for x in zip(*cells)] if cells else [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in (*table, list(cells.values()))], names=["b", "q2", "q1", "n"])

    meet = lambda rows, counts: rows.groupBy("chunk").cogroup(counts.groupBy("chunk"))
    held_out = meet(stored.drop("doc_ids").where(F.col("part") == HELD), asked.where(F.col("part") == HELD).select("chunk", "kind", "bucket", "kept"))
    cells = held_out.applyInArrow(held_cells, "b bigint, q2 bigint, q1 bigint, n bigint").groupBy("b", "q2", "q1").agg(F.sum("n").alias("n"))
    learned = learn_weights([tuple(r) for r in cells.collect()], uniform)
    weights = np.array(by_bucket(learned))

    def scored(rows: pa.Table, counts: pa.Table) -> pa.Table:
        out = []
        for row in rows.to_pylist():
            chunk = _load(row)
            uni, pair = _counts(counts, "total")
            size = len(chunk.word)
            log_p, base, known = np.empty(size), np.empty(size), np.empty(size, np.int64)
            for at in range(0, size, SCORE_TOKENS):
                some = slice(at, at + SCORE_TOKENS)
                b, p2, p1 = _parts(chunk, uni, pair, n_total, some)
                w = weights[b]
                log_p[some] = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] * uniform)
                c = uni[chunk.word[some]]
                base[some] = np.log10((c + 0.5) / (n_total + 0.5 * (n_types + 1)))
                known[some] = c > 0
            starts = np.cumsum(chunk.lengths) - chunk.lengths
            out.append(
                pa.table(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "part": pa.array(np.full(len(chunk.lengths), chunk.part, np.int32)),
                        "n_tokens": chunk.lengths,
                        "n_known": np.add.reduceat(known, starts),
                        "base_score": np.add.reduceat(base, starts),
                        "score": np.add.reduceat(log_p, starts),
                    }
                )
            )
        return pa.concat_tables(out)

    done = meet(stored, asked.select("chunk", "kind", "bucket", "total"))
    schema = "doc_id bigint, part int, n_tokens bigint, n_known bigint, base_score double, score double"
    return done.applyInArrow(scored, schema).withColumn("train_tokens", F.lit(n_total).cast("bigint"))
