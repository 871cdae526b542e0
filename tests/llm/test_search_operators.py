"""SimHash, decontamination, secrets, URL rules, language model and HTML against brute force and edge rows."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from titleflow.llm import decontaminate, graph, html_extract, lm, secrets, simhash, url_filter
from titleflow.llm.queries import URL_LIST

from .conftest import EDGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
lower = lambda t: t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


# --- SimHash ------------------------------------------------------------------


def brute_fingerprint(text):
    w = WORD.findall(lower(text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint_equals_brute_force():
    draw = random.Random(1)
    for _ in range(100):
        t = " ".join(draw.choice(["A", "b", "Cé", "日", "d\n"]) for _ in range(draw.randint(0, 30)))
        assert simhash.fingerprint(t.encode()) % (1 << 64) == brute_fingerprint(t)


@pytest.mark.parametrize("bits, block", [(4, 1 << 15), (4, 16), (3, 16), (0, 16), (1, 8)])
def test_links_connect_all_pairs_within_the_budget(spark, bits, block):
    """Small blocks force many levels and chunks."""
    draw = np.random.default_rng(bits)
    base = draw.integers(0, 2**63, 6, dtype=np.uint64)
    values = np.concatenate([base[draw.integers(0, 6, 200)], draw.integers(0, 2**63, 40, dtype=np.uint64)])
    for _ in range(3):
        values[:200] ^= np.uint64(1) << draw.integers(0, 64, 200).astype(np.uint64)
    values = np.unique(values)
    near = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= bits)
    signed = values.view(np.int64).tolist()
    want = union([(signed[i], signed[j]) for i, j in near], signed)
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), bits, block).collect()
    assert union([(r["a"], r["b"]) for r in found], signed) == want


def test_no_task_grows_with_a_crowded_neighbour(spark):
    """Three quarters of all fingerprints share their first bits in both halves, so one block is crowded and a guest of its neighbours."""
    draw = np.random.default_rng(5)
    crowd = draw.integers(0, 2**63, 3000, dtype=np.uint64) & np.uint64(0x00FFFFFF00FFFFFF) | np.uint64(0x6B0000006B000000)
    values = np.unique(np.concatenate([crowd, draw.integers(0, 2**63, 1000, dtype=np.uint64)])).view(np.int64).tolist()
    tasks = simhash.dealt(spark.createDataFrame([(v,) for v in values], "fp bigint"), 4, 64)
    sizes = tasks.groupBy("trie", "block", "first", "second", "party", "probe").count()
    guests = F.col("probe") & (F.col("first") == F.col("second"))
    assert sizes.where(~guests).agg(F.max("count")).first()[0] < 2 * 64
    assert sizes.where(guests).agg(F.max("count")).first()[0] < 2 * simhash.PARTY * 64
    assert tasks.where("party > 0").count()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in graph.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_near_duplicates_edge_rows(edge, none):
    rows = simhash.near_duplicates(edge).collect()
    assert len(rows) == len(EDGE)
    by = {(r["doc_id"], r["text_id"]): r for r in rows}
    empty = hashlib.md5(b"").hexdigest()
    assert by[2, empty]["component_id"] == by[3, empty]["component_id"] == 2 and by[2, empty]["fp"] == 0
    kept = simhash.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.select("doc_id").collect() if r["doc_id"]) == [(False, i) for i in (1, 2, 5, 6)]
    assert simhash.near_duplicates(none).count() == simhash.drop_near_duplicates(none).count() == 0


# --- decontamination ------------------------------------------------------------


def naive_tiles(doc, item, width):
    free_doc, free_item, out = [True] * len(doc), [True] * len(item), []
    while True:
        size, at_i, at_d = 0, 0, 0
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and free_item[i + n] and free_doc[d + n] and item[i + n] == doc[d + n]:
                    n += 1
                if n > size:
                    size, at_i, at_d = n, i, d
        if size < width:
            return sorted(out)
        out.append((at_i, at_d, size))
        for k in range(size):
            free_item[at_i + k] = free_doc[at_d + k] = False


def test_tiles_equal_naive_tiling():
    draw = random.Random(4)
    for _ in range(200):
        letters = "abc"[: draw.randint(1, 3)]
        item, doc = ([draw.choice(letters) for _ in range(draw.randint(3, n))] for n in (14, 20))
        pairs = decontaminate.Seeds([(1, " ".join(item))], 3).joined(" ".join(doc)).get(0, [])
        assert sorted(decontaminate.tile(pairs, 3)) == naive_tiles(doc, item, 3)


def test_tiles_do_not_depend_on_the_slices_of_hits(monkeypatch):
    draw = random.Random(14)
    for _ in range(100):
        item, doc = (" ".join(draw.choice("ab") for _ in range(draw.randint(3, n))) for n in (14, 25))
        seeds = decontaminate.Seeds([(1, item), (2, item + " a b a")], 3)
        whole = {k: v.tolist() for k, v in seeds.joined(doc).items()}
        for pairs in (1, 2, 7):
            with monkeypatch.context() as m:
                m.setattr(decontaminate, "PAIRS", pairs)
                assert {k: v.tolist() for k, v in seeds.joined(doc).items()} == whole


def test_one_word_repeated_is_tiled_in_linear_time():
    seeds = decontaminate.Seeds([(1, "ha " * 200), (2, "ha ho " * 100)], 5)
    start = time.perf_counter()
    found = decontaminate.leaks("ha " * 60_000, seeds, 0.8)
    assert [(r["item_id"], r["n_covered"], r["n_tiles"]) for r in found] == [(1, 200, 1)]
    assert [r["item_id"] for r in decontaminate.leaks("ha ho " * 30_000, seeds, 0.8)] == [2]
    assert time.perf_counter() - start < 30


@pytest.mark.parametrize("block_words", [2_000_000, 30])
def test_reordered_and_edited_passages_are_caught(make_docs, spark, none, edge, block_words):
    w = [f"word{i}" for i in range(30)]
    item = " ".join(w)
    docs = [
        (1, "x y " + item.upper() + " z"),
        (2, " ".join(w[15:] + ["between"] + w[:15])),
        (3, " ".join(w[:14] + ["edited"] + w[15:])),
        (4, " ".join(w[:20])),
        (5, " ".join(w[i + k] for i in range(0, 28, 4) for k in (0, 2, 1))),
        (6, None),
    ]
    items = spark.createDataFrame([(7, item), (8, "too short"), (9, None), (10, "other words that no document of these holds at all")], "item_id int, text string")
    found = {r["doc_id"]: r["_leaks"] for r in decontaminate.with_leaks(make_docs(docs), items, block_words=block_words).collect()}
    assert {k: [x["item_id"] for x in v] for k, v in found.items()} == {1: [7], 2: [7], 3: [7], 4: [], 5: [], 6: []}
    assert found[2][0]["n_tiles"] == 2 and found[2][0]["n_covered"] == 30 and found[3][0]["n_covered"] == 29
    assert decontaminate.with_leaks(none, items).count() == 0
    assert decontaminate.with_leaks(edge, items.limit(0)).where(F.size("_leaks") == 0).count() == len(EDGE)


def test_copies_of_an_item_are_dealt_over_blocks(make_docs, spark):
    item = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(7, item)] * 40 + [(8, None), (None, item)], "item_id bigint, text string")
    sizes = [len(seeds.items) for seeds, _ in decontaminate.blocks(items, "item_id", "text", 5, 100)]
    assert sum(sizes) == 41 and len(sizes) > 2 and max(sizes) < 30
    found = decontaminate.with_leaks(make_docs([(1, f"x {item} y"), (2, "clean")]), items, block_words=100).collect()
    assert {r["doc_id"]: len(r["_leaks"]) for r in found} == {1: 41, 2: 0}


# --- secrets ----------------------------------------------------------------------

ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def brute_spans(text):
    t = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans_equal_brute_force(make_docs):
    draw = random.Random(5)
    parts = ["Password", "token", "API_key", ": ", "=", "'", '"', " ", "secret: token: abcdefgh", "AKIA", "ABCDEFGH01234567", "😀é", "0123456789abcdef", "\n", "x"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(300)] + [None, ""]
    found = secrets.find(make_docs(list(enumerate(texts))), ["doc_id"], ["source"], ["source", "lang"])
    for r in found.select("doc_id", secrets.rendered("base").alias("b")).collect():
        assert r["b"] == brute_spans(texts[r["doc_id"]])


def test_ownership_separates_examples_from_live(make_docs, none, edge):
    live, copied = "Zk9_qLw83Xv7Tb2Rm5Yd1Pc", "Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op"
    docs = [(1, f"use {live} here", "en", "s1"), (2, f"again {live}", "en", "s1")]
    docs += [(10 + i, f"see {copied} or token={copied}", "en", f"s{i}") for i in range(4)]
    out = {r["doc_id"]: r for r in secrets.find(make_docs(docs), ["doc_id"], ["source"], ["source", "lang"]).select("doc_id", secrets.rendered("all").alias("s"), "n_live", "n_example").collect()}
    assert out[1]["s"] == f"owned:4:{4 + len(live)}"
    assert "owned" not in out[10]["s"] and out[10]["s"].startswith("assign:") and out[10]["n_example"] == 1 and out[10]["n_live"] == 0
    assert secrets.find(edge, ["doc_id"], ["source"], ["lang"]).count() == len(EDGE)
    assert secrets.find(none, ["doc_id"], ["source"], ["lang"]).count() == 0


def test_repositories_count_as_well_as_owners(make_docs):
    few, many = "Zk9_qLw83Xv7Tb2Rm5Yd1Pc", "Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op"
    docs = [(i, f"use {few}", f"l{i}", "s") for i in range(3)] + [(10 + i, f"use {many}", f"l{i}", "s") for i in range(4)]
    docs += [(20, f"use {few}", "l0", "s"), (21, f"use {few}", "l0", "s")]  # copies in a repository do not count
    found = secrets.find(make_docs(docs), ["doc_id"], ["source"], ["source", "lang"]).select("doc_id", secrets.rendered("all").alias("s"))
    owned = f"owned:4:{4 + len(few)}"
    assert {r["doc_id"]: r["s"] for r in found.collect()} == {**dict.fromkeys([0, 1, 2, 20, 21], owned), **dict.fromkeys(range(10, 14), "")}


def test_a_token_is_owned_wherever_its_first_digit_or_letter_stands(make_docs):
    late = ["abcdefghij" * 7 + "1", "1234567_" * 9 + "Z", "abcdefghij" * 7, "1234567_" * 9]
    docs = make_docs([(i, f"see {t} here") for i, t in enumerate(late)])
    found = secrets.find(docs, ["doc_id"], ["source"], ["source", "lang"]).select("doc_id", secrets.rendered("all").alias("s"))
    assert {r["doc_id"]: r["s"] for r in found.collect()} == {0: "owned:4:75", 1: "owned:4:77", 2: "", 3: ""}


# --- URL rules ----------------------------------------------------------------------


def test_url_parts_and_list(spark):
    urls = ["http://WWW.Example.com/en/x?q#f", "https://a.example.com/en/", "http://x.net/es/1", "http://x.net/ES/1", "nothing", None, "a://b://c/d", "http://com/", "http://mycom/", "x://h?y", "http://a.com:80/z"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string")
    none = rows.select("url", F.lit(None).cast("boolean").alias("block"))
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(rows, none, URL_LIST).select("page_id", "host", "path", "rule", "verdict").collect()}
    assert got[0] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[1] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert got[2] == ("x.net", "/es/1", "net/es/", "block")
    assert got[3] == ("x.net", "/ES/1", None, "allow")
    assert got[4] == got[5] == ("", "", None, "allow")
    assert got[6][:2] == ("b:", "//c/d")
    assert got[7] == ("com", "/", "com/", "allow") and got[8][2] is None and got[9][:2] == ("h", "") and got[10][2] is None


def test_rules_are_mined_pruned_and_matched(spark):
    spam = [(f"http://casino.a{i}.org/win/{i}", True) for i in range(30)]
    fine = [(f"http://site{i}.org/win/{i}", False) for i in range(60)] + [(f"http://site.b{i}.org/page/{i}", False) for i in range(60)]
    labelled = spark.createDataFrame(spam + fine + [(None, True), ("http://x.org/", None)], "url string, block boolean")
    rules = url_filter.mine(labelled)
    assert [r["items"] for r in rules.collect()] == [["label:casino"]]  # every longer rule is no more confident
    urls = spark.createDataFrame([("http://casino.new.org/x",), ("http://casino.new.org/x",), ("http://other.org/win/1",), (None,)], "url string")
    got = sorted((r["url"] or "", r["verdict"]) for r in url_filter.judge(urls, labelled, []).collect())
    assert got == [("", "allow"), ("http://casino.new.org/x", "block"), ("http://casino.new.org/x", "block"), ("http://other.org/win/1", "allow")]
    assert url_filter.judge(urls.limit(0), labelled.limit(0), URL_LIST).count() == 0


# --- language model -------------------------------------------------------------------


@pytest.mark.parametrize("bucket_keys, score_tokens", [(lm.BUCKET_KEYS, lm.SCORE_TOKENS), (40, 7)])
def test_lm_equals_brute_force(make_docs, none, monkeypatch, bucket_keys, score_tokens):
    monkeypatch.setattr(lm, "BUCKET_KEYS", bucket_keys)
    monkeypatch.setattr(lm, "SCORE_TOKENS", score_tokens)
    draw = random.Random(6)
    texts = [" ".join(draw.choice("the of Cat dog é runs far".split()) for _ in range(draw.randint(0, 12))) for _ in range(80)] + [None, "", "unseen words"]
    parts = {i: (lm.TEST if i % 5 == 1 or i > 80 else lm.HELD if i % 5 == 2 else lm.KEPT) for i in range(len(texts))}
    docs = make_docs(list(enumerate(texts))).repartition(3)
    part = F.element_at(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]), F.col("doc_id").cast("int"))
    learned = {}
    real = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a, **k: learned.setdefault("w", real(*a, **k)))
    out = lm.score(docs, part).collect()
    tokens = {i: [w.encode() for w in WORD.findall(lower(t or ""))] + [lm.END] for i, t in enumerate(texts)}
    train = [i for i in tokens if parts[i] != lm.TEST]
    uni, pair = Counter(), Counter()
    for i in train:
        uni.update(tokens[i])
        pair.update(zip([lm.END, *tokens[i]], tokens[i]))
    n, v = sum(uni.values()), len(uni)
    assert len(out) == len(texts)
    for r in out:
        t = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(uni[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
        total = 0.0
        for h, w in zip([lm.END, *t], t):
            c = uni[h]
            l2, l1, l0 = lm.by_bucket(learned["w"])[int(lm.context_bucket(np.array([c]))[0])]
            total += math.log10(l2 * (pair[h, w] / c if c else 0) + l1 * uni[w] / n + l0 / (v + 1))
        assert r["score"] == pytest.approx(total)
    assert lm.score(none, F.lit(lm.KEPT)).count() == 0


def test_lm_weights_follow_the_better_estimate():
    sharp, flat = lm._on_grid(np.array([0.5, 0.001]))
    weights = lm.learn_weights([(3, sharp, flat, 1000), (9, lm.NO_P, flat, 1000)], 1e-6)
    assert weights[3][0] > 0.95 and weights[9][1] > 0.95 and all(abs(sum(w) - 1) < 1e-9 for w in weights.values())


def test_lm_buckets_without_weights_take_the_nearest():
    a, b = (0.7, 0.2, 0.1), (0.8, 0.1, 0.1)
    got = lm.by_bucket({3: a, 6: b}, 9)
    assert got == [lm.PRIOR, a, a, a, a, a, b, b, b]
    assert lm.by_bucket({0: a}, 3) == [a, lm.PRIOR, lm.PRIOR]


def test_lm_without_training(edge):
    rows = lm.score(edge, F.lit(lm.TEST)).collect()
    assert len(rows) == len(EDGE) and all(math.isfinite(r["score"]) for r in rows)


# --- HTML -----------------------------------------------------------------------------

PAGE = (
    '<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>'
    '<div class="ad">Buy this now at once {i}</div><article><h1>Head &amp; title {i}</h1><p><b>First para &lt;x&gt;\n of   the text {i}, which is rather long as text goes.<br>'
    "<p>Second <a href=3>linked</a> para of the text, again a long one {i}.</p></article><footer>&copy; all of it {i}</footer>"
)


def test_html_main_text(spark):
    pages = spark.createDataFrame([(i, f"u{i}", PAGE.replace("{i}", str(i))) for i in range(30)], "page_id int, url string, html string")
    model = html_extract.train(pages)
    got = {r["page_id"]: r["main_text"] for r in html_extract.extract(pages, model, ["page_id"]).collect()}
    assert got[7] == "Head & title 7 First para <x> of the text 7, which is rather long as text goes. Second linked para of the text, again a long one 7."
    other = '<body><header class=top><h1>Site</h1></header><main><p>The text of a page with other parts, long enough to count.</p><form><p>Your mail here</p></form><section class="comments"><p>A comment by a reader, of some length too, I must say.</p></section></main><aside><p>Beside</p></aside>'
    assert html_extract.page_text(other, model) == "The text of a page with other parts, long enough to count."
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "<p>Unclosed <b>and </i>crossed"), (4, "<!-- only --><nav><a href=x>menu</a></nav>")], "page_id int, html string")
    edge = {r["page_id"]: r["main_text"] for r in html_extract.extract(rows, model, ["page_id"]).collect()}
    assert edge == {1: "", 2: "", 3: "Unclosed and crossed", 4: ""}
    untrained = html_extract.train(pages.limit(0))
    assert html_extract.extract(pages, untrained, ["page_id"]).count() == 30


@pytest.mark.parametrize(
    "html, want",
    [
        ("<html><head><title>T</title><body><p>Hello", "Hello"),
        ("<head><meta charset=utf-8><title>T</title><style>p{}</style>\n<p>Hello", "Hello"),
        ("<head><title>T</title>Hello", "Hello"),
        ("<head><noscript><link href=x><body><p>Hello", "Hello"),
        ("<head><title>T</title><script>var a = '<p>'</script></head><body>Hello", "Hello"),
        ("<div>one <svg><path d=x><p>two</p></div>three", "one two three"),
        ("<div>one <svg><text>no</text><foreignObject><p>no</p></foreignObject></svg> two</div>", "one two"),
        ("<ul><li>one <object><li>two</ul>three", "one two three"),
        ("<div>one <object>no</div><p>two", "one two"),
    ],
)
def test_unseen_elements_without_an_end_tag_end(html, want):
    tree = html_extract.Tree(html)
    assert " ".join("".join(" " if t is None else t for _, t in tree.runs).split()) == want


def test_a_page_without_a_closed_head_keeps_its_text():
    model = html_extract.potentials({})
    body = "<body><main><p>The text of a page, long enough to count as content of it.</p></main>"
    assert html_extract.page_text("<html><head><title>T</title>" + body, model) == html_extract.page_text("<html><head><title>T</title></head>" + body, model) != ""


def test_marginals_equal_enumeration():
    from itertools import product

    tree = html_extract.Tree("<div><p>one</p><ul><li>two</li></ul></div>")
    draw = random.Random(7)
    triple = lambda: tuple(draw.random() + 0.05 for _ in range(3))
    model = html_extract.Potentials(
        {html_extract.slot(f): triple() for node in tree.nodes for f in html_extract.features(node, tree.nodes[0].text)},
        {html_extract.slot(node.tag): (triple(), triple(), triple()) for node in tree.nodes},
    )
    weight = [0.0] * len(tree.nodes)
    total = 0.0
    for labels in product(range(3), repeat=len(tree.nodes)):
        p = (1.0, 0.5, 0.1)[labels[0]]
        for i, node in enumerate(tree.nodes):
            for f in html_extract.features(node, tree.nodes[0].text):
                p *= model.unary[html_extract.slot(f)][labels[i]]
            if i:
                p *= model.edge[html_extract.slot(node.tag)][labels[node.parent]][labels[i]]
        total += p
        for i, k in enumerate(labels):
            weight[i] += p * (k == html_extract.CONTENT)
    assert html_extract.marginals(tree, model) == pytest.approx([w / total for w in weight])
