"""URL filters by association rules.

``tokens`` turns a URL into a set of items (host parts, path words, query
keys, shape).  ``mine`` lets Spark's FP-growth find the item combinations that
go with the label ``block`` in labelled URLs and prunes the rules: by support
(joint count), by confidence, and by dropping a rule when a more general one
(a subset of its items) is at least as confident.  ``match`` finds the rules
that hold for each URL with an inverted index: every rule is posted under its
rarest item, URLs meet the postings of their own items, and the rest of the
rule is then checked against the URL's items.  ``listed`` applies a fixed
allow/block list (host suffix + path prefix, longest wins), which goes before
the mined rules.

Cases: a null URL, or one without ``://``, has an empty host and path and no
items, and no rule matches it (verdict ``allow``); without labelled or blocked URLs no rule is mined;
repeated rows are judged each; labels that are null count as no label.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import materialise

BLOCK = "=block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """The items of a URL, distinct."""
    h, p = host(url), path(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    tagged = lambda parts, tag: F.transform(parts, lambda x: F.concat(F.lit(tag), x))
    words = lambda parts: F.filter(parts, lambda x: (x != "") & ~x.rlike("^[0-9]+$"))
    return F.array_distinct(
        F.concat(
            tagged(F.filter(F.array(F.substring_index(h, ".", -1), F.substring_index(h, ".", -2), h), lambda x: x != ""), "host:"),
            tagged(words(F.split(h, "[.-]")), "label:"),
            tagged(words(F.split(F.translate(p, UPPER, LOWER), "[/._-]")), "path:"),
            tagged(F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != ""), "query:"),
        )
    )


def mine(
    labelled: DataFrame,
    url: str = "url",
    block: str = "block",
    min_count: int = 10,
    min_support: float = 0.0005,
    min_confidence: float = 0.8,
) -> DataFrame:
    """Rules (rule_id, items, confidence, n) found in ``labelled`` (url, block boolean).

    A rule's joint count of items and ``block`` must reach ``min_count`` and
    ``min_support`` of the labelled URLs, its confidence ``min_confidence``.
    """
    spark = labelled.sparkSession
    known = labelled.where(F.col(block).isNotNull())
    baskets = known.select(
        F.concat(tokens(F.col(url)), F.when(F.col(block), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))).alias("items")
    )
    baskets = materialise(baskets, "url-baskets")
    size, blocked = baskets.agg(F.count(F.lit(1)), F.count_if(F.array_contains("items", BLOCK))).first()
    if blocked < min_count:
        return spark.createDataFrame([], "rule_id bigint, items array<string>, confidence double, n bigint")
    support = min(1.0, max(min_support, (min_count - 0.5) / size))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.array_contains("consequent", BLOCK)).select(
        F.array_sort("antecedent").alias("items"), "confidence", F.round(F.col("support") * size).cast("bigint").alias("n")
    )
    rules = materialise(rules, "url-rules-all")
    return materialise(prune(rules).withColumn("rule_id", F.xxhash64("items")), "url-rules")


def prune(rules: DataFrame) -> DataFrame:
    """Drop a rule when a strict subset of its items makes a rule at least as confident.

    Rules meet by a shared item; a subset of n items shares all n.
    """
    posted = rules.select("items", "confidence", F.explode("items").alias("item"))
    general = rules.select(F.col("items").alias("g_items"), F.col("confidence").alias("g_conf"), F.col("items")[0].alias("item"))
    beaten = (
        posted.join(general, "item")
        .where((F.size("g_items") < F.size("items")) & (F.col("g_conf") >= F.col("confidence")) & (F.size(F.array_except("g_items", "items")) == 0))
        .select("items")
        .distinct()
    )
    return rules.join(beaten, "items", "left_anti")


def index(rules: DataFrame) -> DataFrame:
    """(item, postings): each rule posted under the item that fewest rules hold."""
    spread = rules.select("rule_id", "items", "confidence", "n", F.explode("items").alias("item"))
    usage = spread.groupBy("item").agg(F.count(F.lit(1)).alias("uses"))
    rarest = spread.join(usage, "item").groupBy("rule_id").agg(F.min(F.struct("uses", "item")).alias("at"), F.first("items").alias("items"), F.max("confidence").alias("confidence"), F.max("n").alias("n"))
    return rarest.groupBy(F.col("at.item").alias("item")).agg(F.collect_list(F.struct("confidence", "n", "rule_id", "items")).alias("postings"))


def match(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """(url, rule_id, confidence, items) of the most confident rule of each distinct URL that one matches."""
    held = urls.select(F.col(url).alias("u")).distinct().select("u", tokens(F.col("u")).alias("own"))
    met = held.select("u", "own", F.explode("own").alias("item")).join(materialise(index(rules), "url-index"), "item")
    fits = F.filter("postings", lambda r: F.size(F.array_except(r["items"], F.col("own"))) == 0)
    best = met.select("u", F.array_max(fits).alias("best")).where(F.col("best").isNotNull())
    return best.groupBy("u").agg(F.max("best").alias("best")).select(F.col("u").alias(url), "best.rule_id", "best.confidence", "best.items")


def listed(url_host: Column, url_path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest list rule (verdict, host, path) that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((url_host == h) | url_host.endswith("." + h)) & url_path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judge(urls: DataFrame, labelled: DataFrame, fixed: list[tuple[str, str, str]], url: str = "url", **mining) -> DataFrame:
    """``urls`` with host, path, rule, verdict and the mined rule's items and confidence; columns of these names are replaced.

    ``labelled`` has columns (url, block).
    """
    found = materialise(match(urls, mine(labelled, **mining), url).withColumnsRenamed({url: "_u", "items": "mined_items", "confidence": "mined_confidence"}).drop("rule_id"), "url-matched")
    joined = urls.join(found, F.col(url) == F.col("_u"), "left")
    listing = listed(F.col("host"), F.col("path"), fixed)
    return (
        joined.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
        .withColumn("_l", listing)
        .withColumns(
            {
                "rule": F.col("_l.rule"),
                "verdict": F.coalesce(F.col("_l.verdict"), F.when(F.col("_u").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))),
            }
        )
        .drop("_l", "_u")
    )
