"""URL filtering: stated host and path rules, and association rules mined for
the URLs that no stated rule fits.

A URL becomes the set of all its parts: top-level domain, domain, host, first
label, every other host label, every path segment (the first two by position as
well), extension, every query key and the set of keys. Only tokens frequent over
all labelled URLs can be in a rule. Tokens found in exactly the same labelled
URLs are one item for FP-growth, so a long URL does not multiply its parts; in a
rule they are alternatives: any of them stands for the item. Those item sets that
imply a verdict with enough support and confidence become rules, unless a more
general rule ranks at least as high, since that one decides then. A rule is filed
in an inverted index under each token of its rarest item. Distinct token sets look
up their tokens there, candidates are verified in whole, and the best rule
(confidence, support, size, then its items) gives the verdict. Texts of URLs never
meet more than their own candidates.

Defined results: a null URL, or one without ``://``, has an empty host and path
and no tokens, and gets the default verdict. Null, repeated ids and repeated
URLs are judged row by row. Labels that are null take no part. Without labelled
URLs or mined rules the default verdict holds. Of a URL of any length all parts
are tokens. Columns named as the results are replaced, all others pass through,
whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kasir.llm.common import name_clash_free, slots, staged

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8
VERDICT_ITEM = "verdict="


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """The URL's token set; empty without a host."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    keys = F.array_sort(F.array_distinct(F.transform(
        F.split(query, "&"), lambda p: F.element_at(F.split(p, "="), 1))))

    def token(kind: str, value: Column) -> Column:
        return F.when(F.length(value) > 0, F.concat(F.lit(kind + ":"), value))

    found = F.concat(F.array(
        token("tld", F.element_at(labels, -1)),
        token("domain", F.when(F.size(labels) > 1, F.concat_ws(".", F.slice(labels, -2, 2)))),
        token("host", host),
        token("label", F.element_at(labels, 1)),
        token("path1", F.get(parts, F.lit(1))),
        token("path2", F.get(parts, F.lit(2))),
        token("ext", F.regexp_extract(last, r"\.([A-Za-z0-9]+)$", 1)),
        token("query", F.concat_ws("&", keys))),
        F.transform(F.slice(labels, 1, F.size(labels) - 1), lambda x: token("part", x)),
        F.transform(parts, lambda x: token("seg", x)),
        F.transform(keys, lambda x: token("key", x)))
    return F.when(host != "", F.array_sort(F.array_distinct(F.array_compact(found)))).otherwise(
        F.array().cast("array<string>"))


def stated_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, host, path) that
    fits; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def mine_rules(labelled: DataFrame, url_col: str = "url", label_col: str = "label",
               min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(key, items, of, verdict, confidence, support) from labelled URLs.
    ``items`` names the rule's items by their first tokens, ``of`` lists each
    one's alternatives; there is a row per token of the rarest item, ``key``,
    under which the index holds the rule."""
    from pyspark.ml.fpm import FPGrowth
    spark = labelled.sparkSession
    out = ("key string, items array<string>, of array<array<string>>, verdict string, "
           "confidence double, support double")
    label = F.col(label_col).cast("string")
    baskets = labelled.where(label.isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), url_tokens(F.col(url_col)).alias("tokens"),
        F.concat(F.lit(VERDICT_ITEM), label).alias("verdict"))
    baskets = staged(baskets, "url-baskets")
    total = baskets.count()
    if total == 0:
        return spark.createDataFrame([], out)
    least = math.ceil(min_support * total)
    pairs = baskets.select("row", F.explode("tokens").alias("token"))
    # The rows that hold a token, as a 128-bit digest that adds up in any order.
    held = (pairs.groupBy("token").agg(
        F.count("*").alias("freq"), F.bit_xor(F.xxhash64("row")).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("h2")).where(F.col("freq") >= least))
    classes = staged(held.groupBy("freq", "h1", "h2").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
                     .select(F.element_at("tokens", 1).alias("item"), "freq", "tokens"), "url-items")
    named = classes.select("item", F.explode("tokens").alias("token"))
    kept = pairs.join(F.broadcast(named), "token").groupBy("row").agg(F.collect_set("item").alias("items"))
    # A row without a frequent token still counts.
    none = F.array().cast("array<string>")
    items = staged(baskets.select("row", "verdict").join(kept, "row", "left").select(
        F.concat(F.coalesce("items", none), F.array("verdict")).alias("items")), "url-items-of-rows")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence,
                     numPartitions=slots(spark)).fit(items)
    rules = (model.associationRules
             .where(F.element_at("consequent", 1).startswith(VERDICT_ITEM))
             .where(~F.exists("antecedent", lambda t: t.startswith(VERDICT_ITEM)))
             .select(F.array_sort("antecedent").alias("items"),
                     F.substring(F.element_at("consequent", 1), len(VERDICT_ITEM) + 1, 1 << 20).alias("verdict"),
                     "confidence", "support"))
    rules = leading(staged(rules, "url-all-rules"))
    # Back to tokens: an item's tokens are alternatives, the rarest item first.
    member = rules.select("*", F.explode("items").alias("item")).join(classes, "item")
    spelled = (member.groupBy("items", "verdict", "confidence", "support")
               .agg(F.transform(F.sort_array(F.collect_list(F.struct("freq", "item", "tokens"))),
                                lambda c: c["tokens"]).alias("of")))
    return staged(spelled.select(F.explode(F.element_at("of", 1)).alias("key"), "items", "of", "verdict",
                                 "confidence", "support"), "url-rules")


def leading(rules: DataFrame) -> DataFrame:
    """``rules`` without those that a rule with one item less outranks or
    equals: whatever they fit, that one fits and decides."""
    wide = rules.where(F.size("items") > 1)
    fewer = (wide.select("*", F.explode("items").alias("out"))
             .withColumn("items0", F.array_except("items", F.array("out"))))
    general = rules.groupBy("items").agg(F.max(F.struct("confidence", "support")).alias("rank")).select(
        F.col("items").alias("items0"), "rank")
    beaten = (fewer.join(general, "items0").where(F.col("rank") >= F.struct("confidence", "support"))
              .select("items", "verdict").distinct())
    return rules.join(beaten, ["items", "verdict"], "left_anti")


def judge_mined(pages: DataFrame, rules: DataFrame, url_col: str, out_col: str,
                default: str = "allow") -> DataFrame:
    """``pages`` plus ``out_col``: the best mined rule's verdict."""
    tokens, found = name_clash_free(pages, "tokens"), name_clash_free(pages, "found")
    tokened = pages.withColumn(tokens, url_tokens(F.col(f"`{url_col}`")))
    sets = tokened.select(F.col(tokens).alias("set")).distinct()
    looked = (sets.select("set", F.explode("set").alias("key")).join(rules, "key")
              .where(F.forall("of", lambda tokens: F.arrays_overlap(tokens, F.col("set")))))
    best = (looked.groupBy("set")
            .agg(F.max(F.struct("confidence", "support", F.size("items").alias("n"), "items", "verdict"))
                 ["verdict"].alias(found))).withColumnRenamed("set", tokens)
    own = [c for c in pages.columns if c.lower() != out_col.lower()]
    return tokened.join(best, tokens, "left").select(
        *[F.col(f"`{c}`") for c in own], F.coalesce(found, F.lit(default)).alias(out_col))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url",
          default: str = "allow", min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``pages`` plus host, path, rule, verdict. The URLs that a stated rule
    decides are the labels from which the method learns the others."""
    url = F.col(f"`{url_col}`")
    own = pages.drop(*[c for c in pages.columns if c.lower() in ("host", "path", "rule", "verdict")])
    stated, learned = name_clash_free(own, "stated"), name_clash_free(own, "learned")
    rule, verdict = stated_rule(F.col("host"), F.col("path"), rules)
    cut = (own.withColumn("host", host_of(url)).withColumn("path", path_of(url))
           .withColumn("rule", rule).withColumn(stated, verdict))
    mined = mine_rules(cut.where(F.col(stated).isNotNull()).select(url_col, stated),
                       url_col, stated, min_support, min_confidence)
    out = judge_mined(cut, mined, url_col, learned, default)
    return out.withColumn("verdict", F.coalesce(stated, learned)).drop(stated, learned)


# The stated rules of op8_url_rules.
OP8_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op8_url_rules(spark, sf_dir: str) -> DataFrame:
    from kasir.llm.common import prepare, table
    prepare(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, OP8_RULES).select("page_id", "host", "path", "rule", "verdict")
