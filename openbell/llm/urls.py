"""URL filter: fixed host and path rules first, then association rules mined by FP-growth.

A url becomes a set of tokens: labels of the host, path segments (those with digits as ``#``), the extension and
query parameters. Transactions are the token sets of labelled urls, blocked ones with one more item. FP-growth
finds frequent sets; rules ``tokens -> blocked`` are kept by confidence and by support (a share of the urls, and no
fewer than ``MIN_COUNT`` of them, so that small tables give no chance rules), and dropped where a rule with
fewer of the same tokens already is kept. Tokens that stand in exactly the same labelled urls are one class, mined as
its first token, so that urls with many common parts do not multiply the sets; any token of the class stands for it
in a match, which is what the rules of its single tokens would do. Matching is an inverted index: every rule is filed under its rarest token,
the distinct token sets of all urls look their tokens up, and candidates are checked whole.

Defined cases: a null url, or one without ``://``, has empty host and path, no token, and is allowed; fixed rules
match the text as it stands (ports and user names are part of the host); repeated rows are judged alike; without a
blocked label nothing is mined; a url's tokens are a set, repeated parameters count once; very long urls are used whole;
further columns pass through, but those named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.llm.common import ascii_lower, table
from openbell.session import materialize

BLOCKED = "=blocked"
MIN_SUPPORT, MIN_CONFIDENCE, MIN_COUNT = 0.002, 0.8, 20

# Verdict, host, path prefix
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), "^([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest fixed rule that fits, nulls without one."""
    fits = [
        F.when((host.eqNullSafe(h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    ]
    return F.coalesce(*fits)


def tokens(url: Column) -> Column:
    """Sorted distinct tokens of a url."""
    rest = _rest(url)
    labels = F.transform(F.filter(F.split(host(url), r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("host:"), x))
    parts = F.filter(F.split(ascii_lower(path(url)), "/"), lambda x: x != "")
    plain = F.transform(parts, lambda x: F.concat(F.lit("path:"), F.regexp_replace(F.regexp_replace(x, r"\.[a-z]+$", ""), "^.*[0-9].*$", "#")))
    kind = F.filter(F.array(F.concat(F.lit("kind:"), F.regexp_extract(ascii_lower(path(url)), r"\.([a-z]+)$", 1))), lambda x: x != "kind:")
    query = F.filter(F.split(F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1), "&"), lambda x: x != "")
    given = F.transform(query, lambda x: F.concat(F.lit("query:"), F.regexp_replace(x, "[0-9]+", "#")))
    return F.sort_array(F.array_distinct(F.concat(labels, plain, kind, given)))


def token_classes(labelled: DataFrame) -> DataFrame:
    """(token, head): tokens in exactly the same token sets share the first of them as head. Two sets of sets count as
    the same if their sizes and two sums (xor) of 64-bit hashes are."""
    sets = labelled.where(F.size("tokens") > 0).select("tokens").distinct()
    seen = sets.select(F.explode("tokens").alias("token"), F.xxhash64("tokens").alias("a"), F.xxhash64(F.lit(1), "tokens").alias("b"))
    mark = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    heads = mark.groupBy("n", "a", "b").agg(F.min("token").alias("head"))
    return materialize(mark.join(heads, ["n", "a", "b"]).select("token", "head"), "url-classes")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_count: int = MIN_COUNT,
         classes: DataFrame | None = None) -> DataFrame:
    """(antecedent, confidence, support) of rules for blocking, from (tokens, blocked) rows; tokens stand for their classes."""
    schema = "antecedent array<string>, confidence double, support double"
    spark, labelled = labelled.sparkSession, labelled.where(F.size("tokens") > 0)
    classes = token_classes(labelled) if classes is None else classes
    sets = labelled.select("tokens").distinct()
    kept = sets.select("tokens", F.explode("tokens").alias("token")).join(classes.where("token = head"), "token")
    kept = kept.groupBy("tokens").agg(F.collect_list("token").alias("heads"))
    items = materialize(
        labelled.join(kept, "tokens").select(
            F.when(F.col("blocked"), F.concat("heads", F.array(F.lit(BLOCKED)))).otherwise(F.col("heads")).alias("items")
        ),
        "url-items",
    )
    if items.where(F.array_contains("items", BLOCKED)).isEmpty():
        return spark.createDataFrame([], schema)
    least = min(1.0, max(min_support, min_count / items.count()))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.col("consequent")[0] == BLOCKED).select(
        F.sort_array("antecedent").alias("antecedent"), "confidence", "support"
    )
    rules = materialize(rules, "url-rules")
    # a rule is dropped if one with a part of its tokens is there: parts are looked up, rules are not paired
    parts = rules.select("antecedent", F.explode("antecedent").alias("left"))
    parts = parts.select("antecedent", F.array_remove("antecedent", F.col("left")).alias("part"))
    shorter = parts.join(rules.select(F.col("antecedent").alias("part")), "part").select("antecedent").distinct()
    return materialize(rules.join(shorter, "antecedent", "left_anti"), "url-kept-rules")


def match(sets: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """The token sets (column ``tokens``, distinct) that hold a token of every class of a rule."""
    asked = rules.select(F.explode("antecedent").alias("head")).distinct()
    asked = materialize(classes.join(asked, "head"), "url-asked")
    posted = sets.select("tokens", F.explode("tokens").alias("token")).join(asked, "token")
    held = materialize(posted.groupBy("tokens").agg(F.collect_set("head").alias("heads")), "url-held")
    posted = held.select("tokens", "heads", F.explode("heads").alias("head"))
    seen = posted.groupBy("head").agg(F.count(F.lit(1)).alias("n"))
    each = rules.select("antecedent", F.explode("antecedent").alias("head")).join(seen, "head", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    filed = each.groupBy("antecedent").agg(F.min(F.struct("n", "head")).alias("rarest")).select("antecedent", F.col("rarest.head").alias("head"))
    found = posted.join(filed, "head").where(F.size(F.array_except("antecedent", "heads")) == 0)
    return found.select("tokens").distinct()


def judge(urls: DataFrame, labelled: DataFrame, rules=RULES, **mining) -> DataFrame:
    """``urls`` (column url) with host, path, rule, verdict and mined (blocked by a mined rule).

    ``labelled``: (url, blocked) rows to learn from; ``mining``: thresholds of ``mine``.
    """
    url = F.col("url").cast("string")
    learn = labelled.select(tokens(url).alias("tokens"), F.col("blocked").cast("boolean").alias("blocked"))
    classes = token_classes(learn)
    mined = mine(learn, classes=classes, **mining)
    rows = urls.drop("_tokens", "_fixed", "mined").withColumns({"host": F.coalesce(host(url), F.lit("")), "path": F.coalesce(path(url), F.lit("")), "_tokens": F.coalesce(tokens(url), F.array().cast("array<string>"))})
    rows = rows.withColumn("_fixed", fixed_rule(F.col("host"), F.col("path"), rules))
    hit = match(rows.select(F.col("_tokens").alias("tokens")).distinct(), mined, classes).select(F.col("tokens").alias("_tokens"), F.lit(True).alias("mined"))
    out = rows.join(materialize(hit, "url-hits"), "_tokens", "left").withColumn("mined", F.coalesce("mined", F.lit(False)))
    method = F.when(F.col("mined"), F.lit("block")).otherwise(F.lit("allow"))
    return out.withColumns({"rule": F.col("_fixed.rule"), "verdict": F.coalesce(F.col("_fixed.verdict"), method)}).drop("_fixed", "_tokens")


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, blocked): a page is labelled by the document whose number its path ends with; toxic or low-quality
    documents are blocked."""
    number = F.regexp_extract(path(F.col("url")), "/([0-9]{1,18})(?:[./]|$)", 1)
    pages = pages.select("url", F.when(number != "", number.cast("long")).alias("doc_id"))
    marks = labels.groupBy("doc_id").agg(F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("blocked"))
    return pages.join(marks, "doc_id").select("url", "blocked")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    labelled = labelled_pages(pages, table(spark, sf_dir, "labels"))
    return judge(pages.select("page_id", "url"), labelled).select("page_id", "host", "path", "rule", "verdict", "mined")
