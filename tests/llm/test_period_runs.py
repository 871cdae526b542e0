"""Periodic runs against a search of every period, and edge rows."""

import hashlib
import random
from zlib import crc32

from titleflow.llm import period_runs as runs
from titleflow.llm.queries import op13_periodic_runs, planted_periods

from .conftest import EDGE


def brute(words, min_length, min_periods):
    n, seen = len(words), {}
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_periods * q):
                seen.setdefault((i, j - i + q), q)  # the smallest period first
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in seen.items()), key=lambda r: (r[0], r[2]))


def samples():
    draw = random.Random(3)
    for _ in range(600):
        n, kinds = draw.randint(0, 60), draw.choice([1, 2, 2, 3, 4])
        words = [draw.choice("abcd"[:kinds]) for _ in range(n)]
        if n and draw.random() < 0.5:
            a, p = draw.randrange(n), draw.randint(1, max(1, n // 4))
            words = [x if i < a or a + p > n else words[a + (i - a) % p] for i, x in enumerate(words)]
        yield words


def test_runs_equal_brute_force():
    for words in samples():
        for min_periods in (2, 3, 4):
            for min_length in (2, 6):
                assert runs.word_runs(words, min_length, min_periods) == brute(words, min_length, min_periods)


def test_cutting_down_changes_nothing():
    """With and without the cut, and on texts that the cut leaves whole."""
    draw = random.Random(4)
    for words in samples():
        spread = [w for x in words for w in ([x] if draw.random() < 0.9 else [x, f"rare{draw.random()}"])]
        ids = {w: i + 1 for i, w in enumerate(dict.fromkeys(spread))}
        assert runs.word_runs(spread) == runs.all_runs([ids[w] for w in spread])
    assert runs.stretches(["a"] * 50, 4) == [(0, 50)]


def test_common_extensions():
    draw = random.Random(5)
    for n in (1, 2, 3, 17, 200):
        s = [draw.randint(1, 2) for _ in range(n)]
        tree = runs.SuffixTree(s)
        ext = runs.Extensions(tree)
        assert ext.leaves == sorted(range(n + 1), key=lambda i: s[i:])
        assert tree.tour(falling=True)[1] == sorted(range(n + 1), key=lambda i: [-x for x in s[i:]])
        pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]
        i, j = (runs.np.array(x) for x in zip(*pairs))
        full = [*s, 0]

        def lce(i, j):
            k = 0
            while max(i, j) + k <= n and full[i + k] == full[j + k]:
                k += 1
            return k

        assert ext.common(i, j).tolist() == [lce(*p) for p in pairs]


def test_long_texts():
    a, b = "a", "ab"
    while len(b) < 5000:
        a, b = b, b + a
    assert runs.word_runs(list(b)) == []  # Fibonacci words have no fourth power
    assert runs.word_runs(["x"] * 30000) == [(0, 30000, 1)]
    words = [f"w{i}" for i in range(2000)] * 5
    assert runs.word_runs(words) == [(0, 10000, 2000)]


def test_collapsed():
    words = "a b a b a b a b c".split()
    assert runs.collapsed(words, runs.word_runs(words)) == ["a", "b", "c"]


def digest(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_query_equals_brute_force(spark, make_docs, edge, tmp_path):
    draw = random.Random(6)
    rows = [(i, " ".join(draw.choice("abcd") for _ in range(draw.randint(0, 80)))) for i in range(300)] + list(EDGE)
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = op13_periodic_runs(spark, str(tmp_path)).collect()
    want = []
    for doc_id, text, *_ in rows:
        words = (text or "").encode().split()
        h = crc32(("" if doc_id is None else str(doc_id)).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        # The long row is checked elsewhere; brute force over its periods would take minutes.
        found = brute(words, 6, 4) if n < 1000 else runs.word_runs(words)
        gone = {i for s, k, q in found for i in range(s + q, s + k)}
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        row = [*best, 1000 * best[1] // best[2]] if best else [None] * 4
        listed = "".join(f"{s},{k},{q}\n" for s, k, q in found)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        want.append((doc_id, len(found), *row, digest(listed), digest(kept)))
    assert sorted(map(str, (tuple(r) for r in out))) == sorted(map(str, want))


def test_planted_periods_null_and_empty(spark):
    df = spark.createDataFrame([(0, None), (1, ""), (None, "x y")], "doc_id bigint, text string")
    # A null id counts as the empty text, whose crc32 is 0: its words repeat from the first on.
    assert sorted(r[0] for r in df.select(planted_periods("doc_id", "text")).collect()) == ["", "", "x x"]


def test_edge_rows(edge, none):
    found = runs.find_runs(edge, ["doc_id", "score"])
    rows = found.collect()
    assert len(rows) == len(EDGE) and found.columns == ["doc_id", "score", "runs", "collapsed"]
    long = next(r for r in rows if r["doc_id"] == 6)
    assert [tuple(r) for r in long["runs"]] == [(0, 40000, 5)] and long["collapsed"] == "long text of many words"
    assert all(r["runs"] == [] for r in rows if r["doc_id"] != 6)
    assert runs.find_runs(none, ["doc_id"]).count() == 0
