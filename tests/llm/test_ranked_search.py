"""Ranked search against a full scoring of every document, and edge rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from titleflow.llm import ranked_search as search

from .conftest import EDGE

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    """Rows (item_id, rank, doc_id, score)."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item_id, text in items:
        rows = []
        for i, c, n in counted:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            s = sum(w(t) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                rows.append((-s, i is None, i or 0, i))
        rows.sort()
        out += [(item_id, r + 1, i, -s) for r, (s, _, _, i) in enumerate(rows[:k])]
    return out


def same(out, want):
    return sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))


def prose(draw, n):
    """Words of which a few are in nearly every text."""
    usual, rare = ["the", "Of", "and", "in"], [f"w{i}" for i in range(80)]
    return " ".join(draw.choice(usual) if draw.random() < 0.6 else draw.choice(rare) for _ in range(n))


@pytest.mark.parametrize("shard_bytes, block_terms", [(1 << 20, 500_000), (300, 40)])
def test_search_equals_brute_force(spark, make_docs, shard_bytes, block_terms):
    draw = random.Random(1)
    docs = [(i, prose(draw, draw.randint(0, 60))) for i in range(150)] + [(7, "the w1 the"), (None, "w1 w1 w2"), (200, "w1 w1 w2"), (201, "w1 w1 w2")]
    items = [(i, prose(draw, draw.randint(0, 25))) for i in range(12)] + [(3, "w1 W1 w1 the"), (None, "w2"), (50, "unknownword"), (51, None), (52, "")]
    index = search.build(make_docs(docs), shard_bytes=shard_bytes)
    found = search.search(index, spark.createDataFrame(items, "item_id bigint, text string"), k=20, block_terms=block_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert same(found, brute(docs, items))


def shard_of(docs, queries):
    """A shard in this process, with its pair lists."""
    vocab = defaultdict()
    vocab.default_factory = vocab.__len__
    words = [search.terms_of(t.encode()) for _, t in docs]
    codes = [np.array([vocab[w] for w in ws], np.int32) for ws in words]
    rows = pa.Table.from_batches([search._shard_rows(0, [i for i, _ in docs], [len(w) for w in words], vocab, codes)])
    scoring = search.Scoring(len(docs), sum(map(len, words)))
    df = Counter(w.decode() for ws in words for w in set(ws))
    heavy = {t: scoring.weight(n) for t, n in df.most_common(search.PAIR_TERMS)}
    pairs = pa.Table.from_batches([search._pair_rows(search.Shard(rows, heavy, scoring), 0)])
    weights = {t: scoring.weight(n) for t, n in df.items()}
    return search.Shard(pa.concat_tables([rows, pairs]), weights, scoring)


def test_pair_bounds_hold_and_tighten():
    draw = random.Random(2)
    docs = [(i, prose(draw, draw.randint(1, 80))) for i in range(400)]
    shard = shard_of(docs, None)
    joint, alone, tighter = 0, 0, 0
    for _ in range(80):
        query = Counter(terms(prose(draw, draw.randint(1, 12))))
        got, visited = search.best_of(shard, query, 5)
        plain, plain_visited = search.best_of(shard, query, 5, independent=True)
        want = [(i, s) for _, _, i, s in brute(docs, [(0, " ".join(query.elements()))], 5)]
        assert [(shard.ids[d], s) for d, s in got] == want == [(shard.ids[d], s) for d, s in plain]
        joint, alone = joint + visited, alone + plain_visited
        order = sorted(((t, q) for t, q in query.items() if t in shard.lists), key=lambda x: (-shard.top[x[0]] * x[1], x[0]))
        pair, single = search.Bounds(shard, order), search.Bounds(shard, order, independent=True)
        assert all(a <= b for a, b in zip(pair.upto, single.upto))
        tighter += pair.upto != single.upto
        for j in range(len(order)):  # no document's score exceeds a bound
            real = np.zeros(len(docs), np.int64)
            for t, q in order[j:]:
                at, own = shard.lists[t]
                real[at] += q * own
            assert real.max() <= pair.upto[j]
            for i in range(j + 1, len(order)):
                rest = real * 0
                for n, (t, q) in enumerate(order):
                    if n > j and n != i:
                        at, own = shard.lists[t]
                        rest[at] += q * own
                assert rest.max() <= pair.without(j, i)
    assert tighter > 20 and joint < alone


def test_pair_lists_hold_the_documents_with_both():
    draw = random.Random(3)
    docs = [(i, prose(draw, draw.randint(1, 30))) for i in range(60)]
    shard = shard_of(docs, None)
    for (a, b), (top, places) in shard.pairs.items():
        both = [d for d, (_, t) in enumerate(docs) if {a, b} <= set(terms(t))]
        assert places.tolist() == both
        scores = np.zeros(len(docs), np.int64)
        for t in (a, b):
            scores[shard.lists[t][0]] += shard.lists[t][1]
        assert top == scores[both].max()


def test_edge_rows(spark, edge, none):
    items = spark.createDataFrame([(1, "text words 日本", "z")], "item_id bigint, text string, score string")
    index = search.build(edge)
    docs = [(i, t) for i, t, *_ in EDGE]
    assert same(search.search(index, items), brute(docs, [(1, "text words 日本")]))
    assert search.search(index, items.limit(0)).count() == 0
    assert search.search(search.build(none), items).count() == 0
