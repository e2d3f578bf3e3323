"""Score each distinct text once; failures stay data and are retried later."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openbell.functions.text import class_probability, content_key, tier2_scores
from openbell.operators.dedup import keep_last
from openbell.session import materialize
from openbell.sources.store import TableStore

# Fixed value: a text whose neutral probability exceeds this skips tier 2.
NEUTRAL_ABOVE = 0.80
CLASSES = {"prob_pos": "positive", "prob_neg": "negative", "prob_neu": "neutral"}
TIER2 = ["relevance", "novelty", "subjectivity"]
#: The checkpoint: a folder per batch and status, so that a batch, or all failures, can be read alone.
CHECKPOINT = (
    "text_hash STRING, Date DATE, published_at TIMESTAMP_NTZ, n_copies BIGINT, embedding ARRAY<FLOAT>, "
    "prob_pos DOUBLE, prob_neg DOUBLE, prob_neu DOUBLE, relevance DOUBLE, novelty DOUBLE, subjectivity DOUBLE, "
    "is_neutral BOOLEAN, tier2_scored BOOLEAN, updated_at BIGINT, status STRING"
)
PARTITIONS = ("updated_at", "status")


@dataclass(frozen=True)
class Scorer:
    """The caller's models, called on pandas batches inside tasks.

    ``tier1``: texts -> one list of ``{"label", "score"}`` per text.
    ``tier2``: texts -> raw reply per text, None where the call failed.
    ``embed``: texts -> one float vector per text.
    """

    tier1: Callable[[pd.Series], pd.Series]
    tier2: Callable[[pd.Series], pd.Series]
    embed: Callable[[pd.Series], pd.Series]


def with_key(articles: DataFrame) -> DataFrame:
    return articles.withColumn("text_hash", content_key(F.col("news_text")))


def gate(scored: DataFrame) -> DataFrame:
    """Add ``is_neutral`` (strictly above the threshold), drop tier-2 values of
    neutral rows, and say whether tier 2 is settled."""
    neutral = F.col("prob_neu") > NEUTRAL_ABOVE
    out = scored.withColumns({
        "is_neutral": neutral, **{c: F.when(~neutral, F.col(c)) for c in TIER2},
    })
    return out.withColumn("tier2_scored", F.col("is_neutral") | F.col("relevance").isNotNull())


def upgraded(checkpoint: DataFrame) -> DataFrame:
    """Checkpoints written before ``tier2_scored`` existed get it derived."""
    if "tier2_scored" in checkpoint.columns:
        return checkpoint
    return checkpoint.withColumn(
        "tier2_scored", F.col("is_neutral") | F.col("relevance").isNotNull()
    )


def distinct_keys(keyed: DataFrame) -> DataFrame:
    """One row per text key with its number of copies and the day and publish time
    of the newest copy. Fixed-width buffers: a hash aggregation that folds a heavily
    copied text inside every map task; no text is sorted or shuffled."""
    return keyed.groupBy("text_hash").agg(
        F.max_by("Date", "published_at").alias("Date"),
        F.max("published_at").alias("published_at"),
        F.count("*").alias("n_copies"),
    )


def with_text(keys: DataFrame, keyed: DataFrame) -> DataFrame:
    """Fetch the text of each key from its newest copy; ties hold the same text."""
    texts = keyed.select("text_hash", "published_at", "news_text").join(keys, ["text_hash", "published_at"])
    return texts.dropDuplicates(["text_hash"]).select("text_hash", "Date", "published_at", "news_text", "n_copies")


def unique_texts(keyed: DataFrame) -> DataFrame:
    return with_text(distinct_keys(keyed), keyed)


def pending_keys(keyed: DataFrame, checkpoint: DataFrame | None) -> DataFrame:
    """Keys of the texts the checkpoint has not seen. Folding copies first keeps the
    anti join free of hot keys."""
    keys = distinct_keys(keyed)
    return keys if checkpoint is None else keys.join(checkpoint.select("text_hash"), "text_hash", "left_anti")


def pending_texts(keyed: DataFrame, checkpoint: DataFrame | None) -> DataFrame:
    """Distinct unseen texts; only theirs are fetched."""
    return with_text(pending_keys(keyed, checkpoint), keyed)


def parsed_responses(raw: DataFrame) -> DataFrame:
    """(labels, raw) -> probabilities, gate and tier-2 scores, on the JVM."""
    tier2 = tier2_scores(F.col("raw"))
    probs = raw.withColumns({c: class_probability("labels", name) for c, name in CLASSES.items()})
    scores = probs.withColumn("_t2", tier2).withColumns({c: F.col(f"_t2.{c}") for c in TIER2})
    return gate(scores.drop("_t2", "labels", "raw"))


def raw_responses(texts: DataFrame, scorer: Scorer) -> DataFrame:
    """Call the models once per text: tier 1 and the embedding for all, tier 2 for
    texts the gate lets through. One pass over evenly spread partitions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            labels = scorer.tier1(pdf["news_text"])
            neutral = labels.map(
                lambda ls: {e["label"].lower(): e["score"] for e in ls}.get(CLASSES["prob_neu"], 0.0)
            )
            ask = neutral <= NEUTRAL_ABOVE
            raw = pd.Series([None] * len(pdf), index=pdf.index, dtype="object")
            if ask.any():
                raw[ask] = scorer.tier2(pdf.loc[ask, "news_text"])
            yield pdf.drop(columns="news_text").assign(
                labels=labels, raw=raw, embedding=scorer.embed(pdf["news_text"])
            )

    schema = (
        "text_hash STRING, Date DATE, published_at TIMESTAMP_NTZ, n_copies BIGINT, "
        "labels ARRAY<STRUCT<label: STRING, score: DOUBLE>>, raw STRING, embedding ARRAY<FLOAT>"
    )
    return texts.repartition("text_hash").mapInPandas(run, schema)


def retry_scores(checkpoint: DataFrame, texts: DataFrame, scorer: Scorer) -> DataFrame:
    """(text_hash, relevance, novelty, subjectivity) for texts whose tier 2 failed
    before. ``texts`` are distinct, so the join has no hot keys."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["text_hash"]].assign(raw=scorer.tier2(pdf["news_text"]))

    failed = checkpoint.filter(~F.col("tier2_scored")).select("text_hash")
    replies = failed.join(texts.select("text_hash", "news_text"), "text_hash").mapInPandas(
        run, "text_hash STRING, raw STRING"
    )
    parsed = replies.select("text_hash", tier2_scores(F.col("raw")).alias("_t2"))
    return parsed.filter("_t2 IS NOT NULL").select("text_hash", "_t2.*")


def retry_merge(checkpoint: DataFrame, retried: DataFrame) -> DataFrame:
    """Failed rows take the new scores; tier 1 and embedding stay as they are."""
    new = retried.select("text_hash", *[F.col(c).alias(f"_new_{c}") for c in TIER2])
    joined = checkpoint.join(new, "text_hash", "left")
    fixed = ~F.col("tier2_scored") & F.col("_new_relevance").isNotNull()
    out = joined.withColumns({
        c: F.when(fixed, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in TIER2
    })
    return out.withColumn("tier2_scored", F.col("tier2_scored") | fixed).select(*checkpoint.columns)


def spread_to_copies(
    keyed: DataFrame, scores: DataFrame, hot_copies: int = 100_000, max_hot: int = 10_000
) -> DataFrame:
    """Give every article row the scores of its text.

    ``scores`` carries ``n_copies``. Texts with more copies than the threshold are
    *hot* and their scores are broadcast to the rows where those stand. The
    threshold is at least rows / max_hot, and fewer than max_hot texts can exceed
    that, which bounds the broadcast. All other texts take a shuffled join.
    """
    total = scores.agg(F.sum("n_copies").alias("n")).first()["n"] or 0
    threshold = max(hot_copies, total // max_hot)
    hot = scores.filter(F.col("n_copies") > threshold)
    cold = scores.filter(F.col("n_copies") <= threshold)
    hot_rows = keyed.join(F.broadcast(hot), "text_hash")
    cold_rows = keyed.join(F.broadcast(hot.select("text_hash")), "text_hash", "left_anti").join(
        cold, "text_hash"
    )
    return hot_rows.unionByName(cold_rows)


def newest_scores(rows: DataFrame, seq: str = "updated_at") -> DataFrame:
    """General checkpoint read: several rows of one text, newest wins."""
    return keep_last(rows, ["text_hash"], seq)


def open_failures(rows: DataFrame) -> DataFrame:
    """Texts whose tier 2 failed and has not recovered since. A checkpoint with
    ``status`` is read in its folders of failed and recovered rows only."""
    if "status" in rows.columns:
        failed, done = rows.filter("status = 'failed'"), rows.filter("status = 'recovered'")
    else:
        failed, done = rows.filter(~F.col("tier2_scored")), rows.filter("tier2_scored")
    return failed.join(done.select("text_hash"), "text_hash", "left_anti").select(*rows.columns)


def current_scores(rows: DataFrame) -> DataFrame:
    """One row per text of a checkpoint written by ``score_articles``.

    Such a text has at most one failed and one scored row, so dropping the
    recovered failures is enough: vectors are neither sorted nor shuffled.
    """
    return rows.filter("tier2_scored").unionByName(open_failures(rows)).drop("status")


def _with_status(rows: DataFrame) -> DataFrame:
    return rows.withColumn("status", F.when(F.col("tier2_scored"), "scored").otherwise("failed"))


def checkpoint(store: TableStore, name: str = "article_scores") -> DataFrame | None:
    """The stored scores, None before the first. A table of an older layout is
    rewritten once as batch 0 or the batches it names."""
    if not store.exists(name):
        store.declare(name, CHECKPOINT, PARTITIONS)
        return None
    if name not in store._layout:
        plain = store.read(name)
        store.declare(name, CHECKPOINT, PARTITIONS)
        if "status" not in plain.columns:
            seen = upgraded(plain)
            if "updated_at" not in seen.columns:
                seen = seen.withColumn("updated_at", F.lit(0).cast("bigint"))
            store.replace(name, _with_status(current_scores(seen)))
    return store.read(name)


def score_articles(
    articles: DataFrame,
    scorer: Scorer,
    store: TableStore,
    batch: int,
    name: str = "article_scores",
    retry_from: DataFrame | None = None,
    parts: int = 8,
) -> DataFrame:
    """Score what the checkpoint lacks, retry what failed, return one row per text.

    Only new and recovered rows are appended, so every model is called once per text
    and history is not rewritten. New texts are fetched once and scored in ``parts`` by
    key, each appended when done: after a failure only the unfinished parts are scored
    again. ``batch`` is the load number that orders several rows of one text.
    ``retry_from`` holds the texts of failed articles when ``articles`` is only the
    newest part. ``compact_batches`` folds old batches.
    """
    keyed = with_key(articles)
    known = checkpoint(store, name)
    stamp = F.lit(batch).cast("bigint")
    part = F.pmod(F.xxhash64("text_hash"), F.lit(parts)).cast("int")
    pending = materialize(pending_texts(keyed, known).withColumn("part", part), "pending", ("part",))
    for k in range(parts):
        some = pending.filter(F.col("part") == k).drop("part")
        store.append(name, _with_status(parsed_responses(raw_responses(some, scorer))).withColumn("updated_at", stamp))
    if known is not None:
        failed = open_failures(known)
        source = keyed if retry_from is None else with_key(retry_from)
        texts = unique_texts(source.join(failed.select("text_hash"), "text_hash", "left_semi"))
        recovered = retry_merge(failed, retry_scores(failed, texts, scorer)).filter("tier2_scored")
        store.append(name, recovered.withColumns({"updated_at": stamp, "status": F.lit("recovered")}))
    return current_scores(store.read(name))


def compact(store: TableStore, name: str = "article_scores") -> DataFrame:
    """One row per text in a new version; readers switch when it is complete."""
    checkpoint(store, name)
    return store.replace(name, _with_status(current_scores(store.read(name)))).drop("status")


def compact_batches(store: TableStore, batch: int, keep: int = 30, name: str = "article_scores") -> bool:
    """Fold all batches up to ``batch - keep`` into one, in a new version, once there are
    twice ``keep`` of them; so the number of folders stays bounded and each row is
    rewritten once in ``keep`` batches. A crash before the switch leaves the old version.
    """
    rows = checkpoint(store, name)
    if rows is None or rows.select("updated_at").distinct().count() <= 2 * keep:
        return False
    last = F.lit(batch - keep).cast("bigint")
    old, new = rows.filter(F.col("updated_at") <= last), rows.filter(F.col("updated_at") > last)
    folded = _with_status(current_scores(old)).withColumn("updated_at", last)
    # a few files per folder instead of one per task
    store.replace(name, folded.unionByName(new).hint("rebalance", *PARTITIONS))
    return True
