"""The pipeline's stages and the registered queries on the smallest tables."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from titleflow.llm import bpe, decontaminate
from titleflow.llm.common import materialise
from titleflow.llm.oracle import SQL
from titleflow.llm.queries import BPE_FILE

from .test_search_operators import brute_fingerprint, naive_tiles, union
from .test_text_operators import brute_lines

SF = "/root/testdata/sf0.001"


def test_stages_on_edge_rows(spark, edge, none):
    for docs in (edge, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialise(stage(spark, docs, SF), f"test-{name}")
            assert docs.columns == edge.columns
        corpus_pipeline.encode(spark, docs, SF).collect()


def test_pipeline_takes_effect(spark, make_docs):
    words = lambda tag: " ".join(f"{tag}{i}" for i in range(80))
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    docs = [(1, words("a")), (2, words("a")), (3, "short"), (4, words("b") + "\n" + leak), (5, None)]
    docs += [(10 + i, words(f"c{i}x") + "\nThe same closing line\n" + words(f"d{i}x")) for i in range(10)]
    out = make_docs(docs)
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, out, SF), f"test-{name}")
    rows = {r["doc_id"]: r for r in out.collect()}
    assert set(rows) == {1, *range(10, 20)} and all(r["decodes"] for r in rows.values())
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in rows.values())


CLASHING = ["_own", "_ID", "_text_id", "_tid", "_body", "_drop", "_n_lines", "_n_dropped", "_leaks", "_text", "k_text", "t", "_own2"]


def test_stages_keep_columns_with_clashing_names(spark, make_docs):
    """Columns named like those the stages use inside come through, and change no result."""
    words = lambda tag: " ".join(f"{tag}{i}" for i in range(80))
    rows = [(1, words("a")), (2, words("a")), (3, "short"), (None, words("b") + "\nno id")]
    plain = clash = make_docs(rows)
    for c in CLASHING:
        clash = clash.withColumn(c, F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, clash = (materialise(stage(spark, d, SF), f"test-{name}") for d in (plain, clash))
    assert clash.columns == [*plain.columns, *CLASHING]
    got = sorted(map(tuple, clash.collect()), key=str)
    assert [r[: len(plain.columns)] for r in got] == sorted(map(tuple, plain.collect()), key=str) and len(got) == 2
    assert all(r[len(plain.columns) + i] == f"{c}{'-' if r[0] is None else r[0]}" for r in got for i, c in enumerate(CLASHING))
    encoded = bpe.encode_decode(clash, BPE_FILE, ["_text", "doc_id"])
    assert encoded.columns == ["_text", "doc_id", "ids", "decoded"] and encoded.count() == 2


def test_pipeline_equals_brute_force(spark):
    """Every stage over again in plain Python (the quality rules in their SQL), on all documents of the smallest tables."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({SQL['op5_quality_rules']}) WHERE kept").fetchall()}
    docs = [r for r in con.execute("SELECT doc_id, text, lang, source FROM documents").fetchall() if r[0] in kept]
    assert len({d[0] for d in docs}) == len(docs)
    texts = dict(zip([d[0] for d in docs], brute_lines([d[1] for d in docs], 10)))
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    ids = sorted(prints)
    near = union([(a, b) for n, a in enumerate(ids) for b in ids[:n] if (prints[a] ^ prints[b]).bit_count() <= 4], ids)
    first = {}
    for i in ids:
        first.setdefault(near[i], i)
    items = [decontaminate.words_of(t or "") for (t,) in con.execute(f"SELECT text FROM read_parquet('{SF}/benchmark.parquet')").fetchall()]

    def leaks(text):
        words = decontaminate.words_of(text)
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        for item in items:
            reach = {i + k for i in range(len(item) - 4) if tuple(item[i : i + 5]) in grams for k in range(5)}
            if len(item) >= 5 and len(reach) >= 0.8 * len(item) and sum(n for *_, n in naive_tiles(words, item, 5)) >= 0.8 * len(item):
                return True
        return False

    tok = Tokenizer.from_file(BPE_FILE)
    about = {d[0]: (d[2], d[3]) for d in docs}
    want = {}
    for i in first.values():
        if not leaks(texts[i]):
            want[i] = (*about[i], tok.encode(texts[i], add_special_tokens=False).ids, hashlib.sha256(texts[i].encode()).hexdigest(), True)
    got = {r["doc_id"]: (r["lang"], r["source"], list(r["ids"]), r["text_sha256"], r["decodes"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 20 < len(want) < len(docs)


@pytest.mark.parametrize("name", [k for k in entry.queries() if k.startswith("op") or k == "pipeline"])
def test_query_runs_and_equals_its_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    assert rows
    sql = entry.oracle_sql().get(name)
    if sql:
        con = duckdb.connect()
        for t in ("documents", "pages", "benchmark", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        res = con.execute(sql)
        names = [d[0] for d in res.description]
        assert sorted(names) == sorted(df.columns)
        want = sorted(tuple(r[names.index(c)] for c in df.columns) for r in res.fetchall())
        assert sorted(map(tuple, rows)) == want
