"""BPE, quality rules, line dedup and the classifier against brute force and edge rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from titleflow.llm import bpe, line_dedup, quality_model, quality_rules
from titleflow.llm.queries import BPE_FILE

from .conftest import EDGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def tok():
    return bpe.load(BPE_FILE)


def test_bpe_equals_the_library(tok):
    theirs, ours = Tokenizer.from_file(BPE_FILE), bpe.encoder(tok)
    draw = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "'re", "1", "é", "日", "😀", "<|endoftext|>", "|", "\x1c", "\x85", "\xa0", "the", " the", "_", "!"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(2000)]
    texts += ["".join(draw.choice("abcdeht") for _ in range(n)) for n in (bpe.LONG_WORD, bpe.LONG_WORD + 1, 3000)]
    for t in texts:
        ids = theirs.encode(t, add_special_tokens=False).ids
        assert ours(t) == ids
        assert bpe.decode(ids, tok) == theirs.decode(ids, skip_special_tokens=False) == t


def test_bpe_decodes_broken_utf8(tok):
    assert bpe.decode([tok.byte_ids[0xE2], tok.byte_ids[0x41]], tok) == "\ufffdA"


def test_bpe_edge_rows(edge, none):
    rows = bpe.encode_decode(edge, BPE_FILE, ["doc_id"]).collect()
    assert sorted(r["decoded"] for r in rows) == sorted(t or "" for _, t, *_ in EDGE)
    assert bpe.encode_decode(none, BPE_FILE, ["doc_id"]).count() == 0


def brute_stats(text):
    t = text or ""
    words, lines = WORD.findall(t), t.split("\n")
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    dup = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(hit)


def test_quality_counts(make_docs):
    draw = random.Random(2)
    texts = ["".join(draw.choice(["a ", "b ", "cé ", "# ", "\n", "A|", "x\n"]) for _ in range(draw.randint(0, 60))) for _ in range(200)]
    texts += [t for _, t, *_ in EDGE if t is None or len(t) < 1000]
    rows = quality_rules.text_stats(make_docs(list(enumerate(texts))), ["doc_id"]).collect()
    for r in rows:
        assert tuple(r[1:6]) == brute_stats(texts[r["doc_id"]])


def test_quality_sketch_buckets(spark):
    from pyspark.sql import functions as F

    rows = spark.range(0, 20000, 7).select("id", quality_rules.bucket(F.col("id")).alias("b")).withColumn("top", quality_rules.bucket_top(F.col("b"))).collect()
    for r in rows:
        assert r["id"] <= r["top"] <= r["id"] * (1 + 1 / quality_rules.SUB)
    assert [r["b"] for r in rows] == sorted(r["b"] for r in rows)


def test_quality_rules_adapt_and_keep(make_docs, edge, none):
    plain = "the quick brown fox jumps over a lazy dog near some quiet river bank while "
    clean = lambda i: " ".join(f"{w}{i * 7 + k}" if k % 3 else w for k, w in enumerate(plain.split() * 5))
    noisy = lambda i: " ".join(w + "$$$" for w in clean(i).split())
    docs = [(i, clean(i), "en", f"s{i % 2}") for i in range(100)] + [(1000 + i, noisy(i), "en", "s0") for i in range(5)]
    docs += [(2000 + i, noisy(i), "xx", "symbols") for i in range(60)]  # a source where symbols are usual
    kept = {r["doc_id"] for r in quality_rules.filter_docs(make_docs(docs)).collect()}
    assert kept == {*range(100), *range(2000, 2060)}
    out = quality_rules.apply_rules(edge, ["doc_id", "score"]).collect()
    assert len(out) == len(EDGE) and not any(r["kept"] for r in out if r["n_words"] < 50)
    assert quality_rules.filter_docs(none).columns == none.columns and quality_rules.filter_docs(none).count() == 0


def brute_lines(texts, min_docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(BLANKS).translate(lower)
    seen = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})
    return ["\n".join(x for x in (t or "").split("\n") if not key(x) or seen[key(x)] < min_docs) for t in texts]


@pytest.mark.parametrize("batches, fanout", [(4, 2), (3, 2), (1, 4)])
def test_line_dedup_equals_brute_force(make_docs, batches, fanout):
    draw = random.Random(3)
    pool = ["Hot line", " hot LINE\t", "é", "É", "", "  ", *(f"line {i}" for i in range(12))]
    texts = ["\n".join(draw.choice(pool) for _ in range(draw.randint(0, 5))) for _ in range(60)] + [None, "", "Hot line", "Hot line"]
    out = line_dedup.dedup_lines(make_docs(list(enumerate(texts))), min_docs=6, n_batches=batches, fanout=fanout).collect()
    want = brute_lines(texts, 6)
    assert len(out) == len(texts) and all(r["text"] == want[r["doc_id"]] for r in out)
    assert all(r["_n_lines"] - r["_n_dropped"] == len(want[r["doc_id"]].split("\n")) or r["_n_lines"] == r["_n_dropped"] for r in out)


def test_line_runs_are_levelled(spark):
    runs = line_dedup.LineRuns(spark, min_docs=3, fanout=2)
    batch = lambda *keys: spark.createDataFrame([(bytes([k]),) for k in keys], "key binary")
    for keys in ((1, 2, 2), (1, 3), (1, 2), (1, 1, 4), (4,)):
        runs.add(batch(*keys))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert sorted(bytes(r["key"])[0] for r in runs.frequent().collect()) == [1, 2]


def test_line_dedup_edge_rows(edge, none):
    out = line_dedup.dedup_lines(edge, min_docs=2)
    assert out.columns == [*edge.columns, "_n_lines", "_n_dropped"]
    texts = Counter(r["text"] for r in out.collect())
    assert texts == Counter(brute_lines([t for _, t, *_ in EDGE], 2))
    assert line_dedup.dedup_lines(none).count() == 0


def test_classifier_identity_and_learning(make_docs, edge, none, spark):
    draw = np.random.default_rng(0)
    weights = draw.normal(0, 0.1, (quality_model.DIM, 1 + quality_model.FACTORS)).astype(np.float32)
    model = quality_model.Model(0.3, weights)
    for text in (b"", b"some words some text!", b"A | b | c\nA | b | c"):
        index, value = quality_model.inputs(text)
        y = 0.3 + sum(float(weights[i, 0]) * v for i, v in zip(index, value))
        y += sum(
            float(weights[index[a], 1:] @ weights[index[b], 1:]) * value[a] * value[b] for a in range(len(index)) for b in range(a)
        )
        assert model.score(text) == pytest.approx(1 / (1 + math.exp(-y)), rel=1e-3)
    rows = [(f"plain words number {i} of a clean text", 1) for i in range(40)] + [(f"BUY!! NOW!! $$$ {i}", 0) for i in range(40)] + [("x", None), (None, 1)]
    trained = quality_model.train(spark.createDataFrame(rows, "text string, label int"))
    assert trained.score(b"plain words of another clean text") > 0.7 and trained.score(b"BUY!! $$$ IT!!") < 0.3
    scored = quality_model.score(edge, trained, ["doc_id"]).collect()
    assert len(scored) == len(EDGE) and all(0 <= r["score"] <= 1 for r in scored)
    empty = spark.createDataFrame([], "text string, label int")
    assert quality_model.train(empty).score(b"any") == pytest.approx(0.5)
    assert quality_model.score(none, trained, ["doc_id"]).count() == 0


def test_training_by_id_learns_the_same_and_shuffles_no_text(spark):
    rows = [(i, f"plain words number {i % 40} of a clean text" if i % 2 else f"BUY!! NOW!! $$$ {i % 30}") for i in range(200)] + [(500, None), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 200, 3)] + [(500, 1), (7, None), (999, 1)], "doc_id bigint, label int")
    for max_rows in (5000, 12):
        by_id = quality_model.train_by_id(docs, labels, max_rows=max_rows)
        joined = quality_model.train(docs.join(labels, "doc_id").select("text", "label"), max_rows=max_rows)
        assert by_id.bias == joined.bias and np.array_equal(by_id.weights, joined.weights)
    assert quality_model.train_by_id(docs, labels.limit(0)).score(b"x") == pytest.approx(0.5)
    assert quality_model.train_by_id(docs, labels.where("label = 1")).score(b"x") == pytest.approx(1, abs=1e-5)


def test_a_training_sample_is_bounded_whatever_the_copies(spark):
    from titleflow.llm.common import picked

    rows = [("copied", 1)] * 400 + [("copied", 0)] * 50 + [(f"text {i}", i % 2) for i in range(300)] + [(None, 1)] * 3
    df = spark.createDataFrame(rows, "text string, label int")
    few = [tuple(r) for r in picked(df, "text", 60).collect()]
    assert 20 < len(few) < 120 and len(few) == len(set(few)) and {t for t, _ in few} <= {t for t, _ in rows}
    assert sorted(map(tuple, picked(df, "text", 1000).na.fill("").collect())) == sorted({(t or "", n) for t, n in rows})
    assert picked(df.limit(0), "text", 10).count() == 0
