"""The registered queries ``opN_<name>``: each applies one operator of this
subpackage, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleflow.llm import (
    bpe,
    decontaminate,
    html_extract,
    line_dedup,
    lm,
    period_runs,
    quality_model,
    quality_rules,
    ranked_search,
    secrets,
    simhash,
    spm,
    url_filter,
)
from titleflow.llm.common import remainder, table

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")


def sha256(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


#: Fixed values: (verdict, host, path) of the URL list.
URL_LIST = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page takes the label of the document of its id; ``toxic`` ones teach ``block``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (F.col("toxic") == 1).alias("block"))
    labelled = pages.join(labels, "page_id").select("url", "block")
    return url_filter.judge(pages, labelled, URL_LIST).select("page_id", "host", "path", "rule", "verdict", "mined_items", "mined_confidence")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The owner is the source; a repository is a source's documents of one language."""
    found = secrets.find(table(spark, sf_dir, "documents"), ["doc_id"], owner=["source"], repo=["source", "lang"])
    counts = [secrets.count_kind("base", kind).alias(f"n_{kind}") for kind, *_ in secrets.KINDS]
    base = F.sha2(secrets.rendered("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, secrets.rendered("all").alias("spans"), "n_live", "n_example")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item, one row per (document, item)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.with_leaks(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", F.explode("_leaks").alias("l")).select(
        "doc_id", "l.*", (F.col("l.n_covered") / F.col("l.n_item_words")).alias("coverage")
    )


def _token_digests(done: DataFrame) -> DataFrame:
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        sha256("decoded").alias("decoded_sha256"),
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_digests(bpe.encode_decode(table(spark, sf_dir, "documents"), BPE_FILE, ["doc_id"]))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from labels whose remainder is not 0; a score of 0.3 or more predicts 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label"))
    model = quality_model.train_by_id(docs, labels)
    scored = quality_model.score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, width=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remainder 1 is never trained on; of the rest, remainder 2 teaches the weights."""
    rest = remainder("doc_id", 5)
    part = F.when(rest == 1, lm.TEST).when(rest == 2, lm.HELD).otherwise(lm.KEPT)
    scored = lm.score(table(spark, sf_dir, "documents"), part)
    held_out = (F.col("part") == lm.TEST).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_extract.extract(pages, html_extract.train(pages), ["page_id", "url"])
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("bigint").alias("n_chars"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, min_docs=10).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), sha256("text").alias("kept_sha256")
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item is a query; its 20 best documents."""
    index = ranked_search.build(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"), k=20)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_digests(spm.encode_decode(table(spark, sf_dir, "documents"), PIECE_FILE, ["doc_id"]))


def planted_periods(doc_id: str, text: str) -> Column:
    """The text, of every tenth document (by crc32 of its id) with words repeated from some word on."""
    h = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(ws: Column) -> Column:
        n = F.size(ws).cast("bigint")
        a = F.pmod(g, F.greatest(n, F.lit(1)))
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.array_join(F.transform(ws, lambda w, i: F.get(ws, place(i))), " ")

    # The words are bound as a lambda's variable, so they are split once.
    return F.when(h % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(body)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of at least six words and four periods."""
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_periods("doc_id", "text").alias("text"))
    found = period_runs.find_runs(docs, ["doc_id"], min_length=6, min_periods=4)
    order = lambda r: F.struct((r["length"] / r["period"]).alias("e"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r.alias("run"))
    best = F.array_max(F.transform("runs", order))["run"]
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n"))))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        sha256("collapsed").alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_secrets": op2_secrets,
    "op3_decontaminate": op3_decontaminate,
    "op4_bpe": op4_bpe,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_model": op6_quality_model,
    "op7_simhash": op7_simhash,
    "op8_lm": op8_lm,
    "op9_html_extract": op9_html_extract,
    "op10_line_dedup": op10_line_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_periodic_runs": op13_periodic_runs,
}
