"""Filter interaction audit: what each of several filters removes, in every order, and its fair share.

Every document fails a set of filters. For a coalition S of filters, v(S) counts the documents that fail any of S.
The Hart-Mas-Colell potential P(S) = (v(S) + sum of P(S without i) over i in S) / |S| is computed over all
coalitions; the Shapley value of a filter is the grand potential minus the potential without that filter. Times n!
all of them are whole numbers. Differences of v between neighbouring coalitions are the steps of every order.

Plan: one pass over the texts gives a narrow row per document (part, failure mask, digest); copies are found by
digest with partial minima per task and a merge join that Spark may split; then two aggregations leave one row per
part with at most 2^n masks, and everything else is an expression on that row.

Defined cases: a null text is the empty text, which is a text like any other; texts of any length are taken whole;
texts are identical if their SHA-256 is; a null part is the empty string; a null doc_id neither is smaller than
another nor has a smaller one, and no label; rows equal in doc_id count one by one and are no copies of each other; a
document with several label rows has a mark if any of them has it; labels without document count nothing; an empty
table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.llm.common import table
from openbell.session import materialize

BLANK = r"[\x20\x09-\x0D]+"


def text_flags(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text that is not null."""
    words = F.filter(F.split(text, BLANK, -1), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def later_copies(rows: DataFrame, digest: str, key: str) -> DataFrame:
    """``rows`` with ``later``: a row of smaller ``key`` has the same ``digest``."""
    firsts = rows.groupBy(F.col(digest).alias("_d")).agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    firsts = firsts.where("_first < _last").drop("_last")  # few: only texts that occur under several keys
    joined = rows.join(firsts.hint("merge"), rows[digest] == firsts["_d"], "left")
    return joined.withColumn("later", F.coalesce(F.col(key) > F.col("_first"), F.lit(False))).drop("_d", "_first")


def masks(rows: DataFrame, part: str, names: list[str], marks: list[str]) -> DataFrame:
    """(part, m): one row per part, m an array of (mask, n, one count per mark) of its documents' failures."""
    mask = sum((F.col(c).cast("long") * 2**k for k, c in enumerate(names)), F.lit(0).cast("long"))
    counted = rows.groupBy(F.col(part).alias("part"), mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("long")).alias(c) for c in marks]
    )
    return counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", *marks)).alias("m"))


def coalitions(per_part: DataFrame, n: int, marks: list[str]) -> DataFrame:
    """Adds ``total``, ``v_n`` and ``v_<mark>`` (arrays over all 2^n coalitions) and ``potential`` (times n!)."""

    def value(c: str) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(2**n - 1)),
            lambda s: F.aggregate("m", F.lit(0).cast("long"), lambda a, e: a + F.when(e["mask"].bitwiseAND(s) != 0, e[c]).otherwise(0)),
        )

    valued = per_part.select(
        "part", F.aggregate("m", F.lit(0).cast("long"), lambda a, e: a + e["n"]).alias("total"), *[value(c).alias(f"v_{c}") for c in ["n", *marks]]
    )
    # coalitions in numerical order come after all their subsets; every division leaves no rest
    without = " + ".join(f"if(s & {2**i} != 0, p[s - {2**i}], 0L)" for i in range(n))
    potential = f"aggregate(sequence(1, {2**n - 1}), array(0L), (p, s) -> concat(p, array(({math.factorial(n)} * v_n[s] + {without}) div bit_count(s))))"
    return valued.withColumn("potential", F.expr(potential))


def steps(valued: DataFrame, names: list[str], marks: dict[str, str]) -> DataFrame:
    """One row per part, order of the filters and step; ``marks`` maps a mark to the name of its column."""
    n, full = len(names), 2 ** len(names) - 1
    orders = F.explode(F.array(*[F.lit("".join(o)) for o in permutations(names)]))
    each = valued.withColumn("filter_order", orders).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    before = sum((F.when(F.instr("filter_order", c) < F.col("step"), 2**k).otherwise(0) for k, c in enumerate(names)), F.lit(0))
    bit = sum((F.when(F.instr("filter_order", c) == F.col("step"), 2**k).otherwise(0) for k, c in enumerate(names)), F.lit(0))
    each = each.withColumns({"b": before, "i": bit})
    at = lambda c, s: F.get(c, s)
    gain = lambda c: at(c, F.col("b") + F.col("i")) - at(c, F.col("b"))
    return each.select(
        "part", "filter_order", "step",
        (F.col("total") - at("v_n", F.col("b") + F.col("i"))).alias("kept"),
        gain("v_n").alias("removed"),
        (at("v_n", F.col("i")) - gain("v_n")).alias("redundant"),
        (at("v_n", F.lit(full)) - at("v_n", F.lit(full) - F.col("i"))).alias("unique_fails"),
        *[gain(f"v_{c}").alias(name) for c, name in marks.items()],
        (at("potential", F.lit(full)) - at("potential", F.lit(full) - F.col("i"))).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The audit of the filters A to E on ``docs`` (doc_id, text, ``part``) with marks of ``labels``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.coalesce(F.col(f"`{part}`").cast("string"), F.lit(""))
    narrow = docs.select(F.col("doc_id"), own.alias("part"), text.alias("text"))
    narrow = narrow.select("doc_id", "part", *[c.alias(k) for k, c in text_flags(F.col("text")).items()], F.unhex(F.sha2("text", 256)).alias("digest"))
    flagged = later_copies(materialize(narrow, "audit-flags"), "digest", "doc_id").withColumnRenamed("later", "E").drop("digest")
    marked = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad")
    )
    rows = flagged.join(marked, F.col("doc_id") == F.col("_id"), "left").fillna(False, ["good", "bad"])
    per_part = materialize(masks(rows, "part", list("ABCDE"), ["good", "bad"]), "audit-masks")
    return steps(coalitions(per_part, 5, ["good", "bad"]), list("ABCDE"), {"good": "good_lost", "bad": "toxic_lost"})


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), f AS (
  SELECT part, doc_id,
         len(words) < 200 AS "A",
         100 * len(list_distinct(words)) < 50 * len(words) AS "B",
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS "C",
         regexp_matches(text, '[#$%&*|]') AS "D",
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS "E"
  FROM d
), l AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS bad FROM labels GROUP BY doc_id
), m AS MATERIALIZED (
  SELECT part, CASE WHEN "A" THEN 'A' ELSE '' END || CASE WHEN "B" THEN 'B' ELSE '' END || CASE WHEN "C" THEN 'C' ELSE '' END
               || CASE WHEN "D" THEN 'D' ELSE '' END || CASE WHEN "E" THEN 'E' ELSE '' END AS fails,
         coalesce(good, false) AS good, coalesce(bad, false) AS bad, count(*) AS n
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
), x AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x AND b.x <> e.x
    AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x
), ran AS (
  SELECT part, filter_order, fails, good, bad, n,
         list_min(list_transform(string_split(fails, ''), lambda c: CASE WHEN c = '' THEN 9 ELSE instr(filter_order, c) END)) AS gone_at
  FROM m, o
), s AS MATERIALIZED (
  SELECT part, filter_order, step, substr(filter_order, step::INT, 1) AS letter,
         sum(n) FILTER (gone_at > step) AS kept,
         sum(n) FILTER (gone_at = step) AS removed,
         sum(n) FILTER (contains(fails, substr(filter_order, step::INT, 1)) AND gone_at < step) AS redundant,
         sum(n) FILTER (fails = substr(filter_order, step::INT, 1)) AS unique_fails,
         sum(n) FILTER (gone_at = step AND good) AS good_lost,
         sum(n) FILTER (gone_at = step AND bad) AS toxic_lost
  FROM ran, (SELECT unnest([1, 2, 3, 4, 5]) AS step) GROUP BY part, filter_order, step
)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM s
"""
