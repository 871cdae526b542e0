"""SimHash near-duplicates by a binary-trie self-join.

A fingerprint has a bit set where more than half of the text's shingle hashes
have it (shingles count as often as they occur).  Distinct fingerprints are
the leaves of a binary trie; pairs of nodes are walked down together, adding
up the bits in which their prefixes differ, and a pair is pruned as soon as
the error budget is exceeded.

Two tries share the work: of ``max_bits`` differing bits either at most half
lie in the upper 32 bits, or fewer than half in the lower 32.  So one trie
starts with the upper half and allows ``max_bits // 2`` errors there, the
other starts with the lower half and allows ``max_bits - max_bits // 2 - 1``;
below their first 32 levels both allow ``max_bits``.

The top levels of the walk are done by Spark: a trie is cut in blocks by its
first levels, and each fingerprint goes to its own block and to the lower
numbered blocks within the budget.  A block that holds more than ``BLOCK``
fingerprints is cut in chunks, whose pairs are tasks of their own, and guests
beyond ``PARTY * BLOCK`` in parties, each held against every chunk; so no task grows
with a crowded neighbourhood.  A task returns a spanning forest of the
links it finds (at most one edge per fingerprint), not all pairs: components
keep every link.

Cases: null and empty texts have fingerprint zero and link like any other;
texts shorter than a shingle hash as one; repeated rows share a component;
null ids join the component of their text and never name it; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import free_name, map_texts, materialise
from titleflow.llm.graph import components

SEED = 42
HALF = 32
#: Fingerprints of one block, or chunk of a block, and the least levels cut (so that few fingerprints still spread over cores).
BLOCK = 1 << 15
MIN_LEVELS = 3
#: Guests that meet a chunk at once, in blocks: every further party reads the chunk anew.
PARTY = 8
#: Node pairs walked at once, and the size at which two nodes are compared leaf by leaf.
WALK, LEAF = 1 << 19, 32


def fingerprint(text: bytes, width: int = 4) -> int:
    """The 64-bit SimHash of the text's ``width``-word shingles, as a signed number."""
    words = text.lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()][: max(1, len(words) - width + 1)]
    stops = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    hashed = b"".join([digest(body[a:b], SEED) for a, b in zip(starts, stops)])
    bits = np.unpackbits(np.frombuffer(hashed, np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", width: int = 4) -> DataFrame:
    """Columns ``keep`` and ``fp`` (bigint holding the 64 bits)."""

    def make():
        return lambda texts: [[fingerprint(t, width) for t in texts]]

    return map_texts(docs, text, keep, [("fp", "bigint", pa.int64())], make)


def masks(levels: int, errors: int) -> list[int]:
    """All differences of at most ``errors`` among ``levels`` bits, but none."""
    return [sum(1 << i for i in c) for e in range(1, min(errors, levels) + 1) for c in combinations(range(levels), e)]


def budgets(max_bits: int) -> list[tuple[int, int]]:
    """(bits to rotate by, errors allowed in the first half) of each trie."""
    second = max_bits - max_bits // 2 - 1
    return [(0, max_bits // 2), *([(HALF, second)] if second >= 0 else [])]


# --- the walk inside a task -------------------------------------------------


def _zeros(values: np.ndarray, depth: int) -> np.ndarray:
    """How many of the first i values have bit ``depth`` (from the top) clear."""
    clear = (values >> np.uint64(63 - depth)) & np.uint64(1) == 0
    return np.concatenate([[0], np.cumsum(clear)])


def _leaves(a: np.ndarray, b: np.ndarray, pairs: np.ndarray, max_bits: int) -> np.ndarray:
    """(i, j) of values within ``max_bits`` from node pairs (a lo, a hi, b lo, b hi, ...)."""
    alo, ahi, blo, bhi = pairs[:4]
    out = []
    sizes = (ahi - alo) * (bhi - blo)
    ends = np.cumsum(sizes)
    cuts = np.searchsorted(ends, np.arange(WALK * 4, (ends[-1] if len(ends) else 0) + WALK * 4, WALK * 4), "left") + 1
    first = 0
    for stop in cuts:
        stop = min(int(stop), len(sizes))
        if stop <= first:
            continue
        part = slice(first, stop)
        n = sizes[part]
        which = np.repeat(np.arange(first, stop), n)
        rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = (bhi - blo)[which]
        i, j = alo[which] + rank // wide, blo[which] + rank % wide
        near = np.bitwise_count(a[i] ^ b[j]) <= max_bits
        out.append(np.stack([i[near], j[near]]))
        first = stop
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)


def walk(a: np.ndarray, b: np.ndarray, half: int, max_bits: int, same: bool) -> Iterator[np.ndarray]:
    """Index pairs (i, j) of sorted ``a`` and ``b`` that the trie walk finds.

    With ``same``, ``a`` is ``b`` and each pair comes once, i < j.
    """
    if not len(a) or not len(b):
        return
    root = np.array([[0], [len(a)], [0], [len(b)], [0], [int(same)]], np.int64)
    stack = [(0, root)]
    while stack:
        depth, at = stack.pop()
        if at.shape[1] > WALK:
            stack += [(depth, at[:, k : k + WALK]) for k in range(0, at.shape[1], WALK)]
            continue
        alo, ahi, blo, bhi, diff, own = at
        small = ((ahi - alo) * (bhi - blo) <= LEAF) | (depth == 64)
        if small.any():
            done = at[:, small]
            found = _leaves(a, b, done, max_bits)
            if same:
                found = found[:, found[0] < found[1]]
            yield found
            alo, ahi, blo, bhi, diff, own = at = at[:, ~small]
        if not at.shape[1]:
            continue
        budget = half if depth < HALF else max_bits
        za, zb = _zeros(a, depth), _zeros(b, depth)
        amid, bmid = alo + za[ahi] - za[alo], blo + zb[bhi] - zb[blo]
        zero = np.zeros_like(own)
        children = [
            np.stack([alo, amid, blo, bmid, diff, own]),
            np.stack([amid, ahi, bmid, bhi, diff, own]),
            np.stack([alo, amid, bmid, bhi, diff + 1, zero]),
            np.stack([amid, ahi, blo, bmid, diff + 1, zero])[:, own == 0],  # of a node with itself: once
        ]
        nodes = np.concatenate(children, axis=1)
        nodes = nodes[:, (nodes[0] < nodes[1]) & (nodes[2] < nodes[3]) & (nodes[4] <= budget)]
        if nodes.shape[1]:
            stack.append((depth + 1, nodes))


def _forest(n: int, links: np.ndarray) -> np.ndarray:
    """The least index of each of n nodes' component."""
    label = np.arange(n)
    i, j = links
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        if np.array_equal(before, label):
            return label


def block_links(home: np.ndarray, probe: np.ndarray, self_join: bool, half: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (least value, value) of a spanning forest over a block's links."""
    home, probe = np.sort(home), np.sort(probe)
    n, label = len(home) + len(probe), None
    pending: list[np.ndarray] = []
    held = 0

    def settle():
        nonlocal label, pending, held
        if label is not None:
            pending.append(np.stack([np.arange(n), label]))
        label, pending, held = _forest(n, np.concatenate(pending, axis=1)), [], 0

    searches = [(home, home, 0, True)] if self_join else []
    for a, b, shift, same in [*searches, (home, probe, len(home), False)]:
        for found in walk(a, b, half, max_bits, same):
            if found.shape[1]:
                pending.append(np.stack([found[0], found[1] + shift]))
                held += found.shape[1]
            if held > 4 * WALK:
                settle()
    if pending:
        settle()
    if label is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    values = np.concatenate([home, probe])
    child = np.flatnonzero(label != np.arange(n))
    return values[label[child]], values[child]


# --- the join ---------------------------------------------------------------


def dealt(distinct: DataFrame, max_bits: int, block: int) -> DataFrame:
    """(trie, block, first, second, party, key, probe): the fingerprints of every task of the join."""
    count = distinct.count()
    levels = min(HALF, max(MIN_LEVELS, math.ceil(math.log2(max(count, 1) / block))))
    tries = budgets(max_bits)
    rotated = F.when(F.col("trie") == 0, F.col("fp")).otherwise(F.call_function("shiftleft", F.col("fp"), F.lit(HALF)).bitwiseOR(F.shiftrightunsigned("fp", HALF)))
    own = F.shiftrightunsigned(F.shiftrightunsigned("key", 32), 32 - levels)
    rows = (
        distinct.select("fp", F.explode(F.array(*[F.lit(i) for i in range(len(tries))])).alias("trie"))
        .withColumn("key", rotated)
        .withColumn("home", own)
    )
    reach = F.array(F.lit(0).cast("bigint"), *[F.lit(m).cast("bigint") for m in masks(levels, max(e for _, e in tries))])
    allowed = F.element_at(F.array(*[F.lit(e) for _, e in tries]), F.col("trie") + 1)
    spread = (
        rows.withColumn("mask", F.explode(reach))
        .where((F.bit_count("mask") <= allowed) & (F.col("home").bitwiseXOR(F.col("mask")) <= F.col("home")))
        .select("trie", F.col("home").bitwiseXOR(F.col("mask")).alias("block"), "key", (F.col("mask") != 0).alias("guest"))
    )
    # One row a block, about one per BLOCK fingerprints.  Guests are dealt out as well: a crowded block is a guest to its neighbours.
    sizes = spread.groupBy("trie", "block").agg(F.count_if(~F.col("guest")).alias("own"), F.count_if("guest").alias("guests"))
    pieces = lambda n, size: F.greatest(F.ceil(F.col(n) / size).cast("int"), F.lit(1))
    sizes = materialise(sizes.select("trie", "block", pieces("own", block).alias("chunks"), pieces("guests", PARTY * block).alias("parties")), "block-sizes")
    spread = spread.join(sizes, ["trie", "block"])
    # Tasks of a block in chunks are the pairs of chunks: i with itself (and one party of guests), i with j.
    # Parties after the first meet chunk i without its own pairs.
    mine = F.when(F.col("guest"), F.lit(-1)).otherwise(F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
    party = F.pmod(F.xxhash64("key", F.lit(1)), F.col("parties")).cast("int")
    return (
        spread.withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumns(
            {
                "first": F.when(F.col("guest"), F.col("other")).otherwise(F.least("mine", "other")),
                "second": F.when(F.col("guest"), F.col("other")).otherwise(F.greatest("mine", "other")),
            }
        )
        .withColumn("probe", F.col("guest") | ((F.col("first") != F.col("second")) & (F.col("mine") == F.col("second"))))
        .withColumn(
            "party",
            F.explode(
                F.when(F.col("guest"), F.array(party))
                .when(F.col("first") == F.col("second"), F.sequence(F.lit(0), F.col("parties") - 1))
                .otherwise(F.array(F.lit(0)))
            ),
        )
        .select("trie", "block", "first", "second", "party", "key", "probe")
    )


def links(distinct: DataFrame, max_bits: int = 4, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect all of ``distinct`` (fp) within ``max_bits``."""
    tries = budgets(max_bits)
    halves = [e for _, e in tries]
    shifts = [r for r, _ in tries]

    def run(task: pa.Table) -> pa.Table:
        trie, first, second, party = (task.column(c)[0].as_py() for c in ("trie", "first", "second", "party"))
        key = task.column("key").to_numpy().view(np.uint64)
        probe = task.column("probe").to_numpy()
        a, b = block_links(key[~probe], key[probe], first == second and party == 0, halves[trie], max_bits)
        if shifts[trie]:
            a, b = ((x << np.uint64(HALF)) | (x >> np.uint64(HALF)) for x in (a, b))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt(distinct, max_bits, block).groupBy("trie", "block", "first", "second", "party").applyInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per document: ``doc_id``, ``fp``, ``text_id`` (md5 of the text), ``label`` (of the component) and ``component_id``, the smallest id reachable."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_id"), F.col(text).alias("t"))
    marked = materialise(fingerprints(source, ["doc_id", "text_id"], "t", width), "fingerprints")
    distinct = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    joined = components(links(distinct.select("fp"), max_bits))
    named = materialise(
        distinct.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("label", "fp").alias("label")), "labelled-fingerprints"
    )
    first = materialise(named.groupBy("label").agg(F.min("least").alias("component_id")), "component-ids")
    classes = materialise(named.join(first, "label").select("fp", "label", "component_id"), "fingerprint-components")
    return marked.join(classes, "fp").select("doc_id", "fp", "text_id", "label", "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` but one per component: that of the smallest id (nulls last), then the smallest text hash.

    Of rows with the same id and text exactly one stays.
    """
    found = near_duplicates(docs, doc_id, text, width, max_bits)
    own, kept_id, kept_text = (free_name(docs.columns, n) for n in ("_own", "_id", "_text_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_id").alias("text_id"))).alias("first")
    winners = found.groupBy("label").agg(first).select(F.col("first.id").alias(kept_id), F.col("first.text_id").alias(kept_text))
    winners = materialise(winners, "kept-documents")
    tagged = docs.withColumn(own, F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    stay = tagged.join(winners, F.col(doc_id).eqNullSafe(F.col(kept_id)) & (F.col(own) == F.col(kept_text)), "left_semi")
    return stay.dropDuplicates([doc_id, own]).drop(own)
