"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits, lower-cased. A document and a benchmark item become a candidate pair when
they share a seed, a run of ``seed`` equal tokens. For a pair, the longest matches of unmarked tokens are found
again and again by running Karp-Rabin hashes and marked as tiles, down to ``seed`` tokens, so passages in another
order are found too. Hashes run over sums of prefixes, so every length costs one subtraction a place, and the longest
shared length is searched by doubling and halving. An item of which at least ``threshold`` of the tokens are tiled (an
item shorter than a seed: all of it, in a row) contaminates the document. Items whose tokens in shared seeds are
fewer than that cannot, and are not tiled.

A benchmark of at most ``max_broadcast`` characters is broadcast. The seeds of a larger one are joined with those of
the documents: pairs with enough shared seeds are counted, and only their texts meet. No part of it passes the driver.

Defined cases: null or empty texts and items without tokens match nothing; every benchmark row is an item of its
own, whatever its item_id: different texts of one item_id are searched and reported each (the id repeats), an item
whose item_id is null is reported with a null id, rows equal in both are one item; repeated documents are judged one
by one; further columns pass through, but those named ``_items`` or ``_row`` are replaced. ``_items`` is in the order of
item_id (nulls last) and text. Very long texts are searched whole.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.llm.common import rows_to_frames, table
from openbell.session import materialize

SEED, THRESHOLD = 5, 0.5
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Its inverse modulo 2**64.
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
TOKENS = re.compile(r"[^\W_]+").findall


def tokens(text: str) -> list[str]:
    return TOKENS(text.lower())


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2**64) of all runs of ``n`` ids."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(ids) - n + 1, np.uint64)
    for k in range(n):
        out = out * MULTIPLIER + ids[k : k + len(out)]
    return out


class Runs:
    """Hashes of all runs of any length: differences of prefix sums, moved to one power."""

    def __init__(self, ids: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * _powers(MULTIPLIER, len(ids)), dtype=np.uint64)])
        self.down = _powers(INVERSE, len(ids))

    def hashes(self, n: int) -> np.ndarray:
        found = self.sums[n:] - self.sums[: max(0, len(self.sums) - n)]
        return found * self.down[: len(found)]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _clear(free: np.ndarray, n: int) -> np.ndarray:
    """Starts of runs of ``n`` free tokens."""
    sums = np.concatenate([[0], np.cumsum(free)])
    return np.flatnonzero(sums[n:] - sums[: max(0, len(sums) - n)] == n)


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in doc, start in item, length), longest first.

    Runs are compared exactly before they are marked; a token is in one tile at most. Ties go to the earliest
    place in the item, then in the document.
    """
    free_d, free_i = np.ones(len(doc), bool), np.ones(len(item), bool)
    found: list[tuple[int, int, int]] = []
    runs_d, runs_i = Runs(doc), Runs(item)

    def shared(n: int):
        """Free runs of ``n`` tokens: (starts in item, hashes, starts in doc, hashes), those of the doc only where the item has them."""
        ok_i, ok_d = _clear(free_i, n), _clear(free_d, n)
        hash_i, hash_d = runs_i.hashes(n)[ok_i], runs_d.hashes(n)[ok_d]
        hit = np.isin(hash_d, hash_i)
        return ok_i, hash_i, ok_d[hit], hash_d[hit]

    most = min(len(item), len(doc))
    while most >= least:
        # what is shared at a length is shared at all below: double the step while it holds, then halve the rest
        low, high, step = least - 1, most + 1, 1
        while high - low > 1:
            n = min(low + step, (low + high) // 2) if step else (low + high) // 2
            if len(shared(n)[2]):
                low, step = n, 2 * step
            else:
                high, step = n, 0
        if low < least:
            break
        ok_i, hash_i, ok_d, hash_d = shared(low)
        places = defaultdict(list)
        for at, h in zip(ok_d.tolist(), hash_d.tolist(), strict=True):
            places[h].append(at)
        for at_i, h in zip(ok_i.tolist(), hash_i.tolist(), strict=True):
            if h not in places or not free_i[at_i : at_i + low].all():
                continue
            for at_d in places[h]:
                if free_d[at_d : at_d + low].all() and np.array_equal(doc[at_d : at_d + low], item[at_i : at_i + low]):
                    free_d[at_d : at_d + low] = free_i[at_i : at_i + low] = False
                    found.append((at_d, at_i, low))
                    break
        most = low - 1
    return found


def tiled_tokens(ids: np.ndarray, item: np.ndarray, seed: int, threshold: float) -> int:
    """Tokens of ``item`` in tiles with ``ids``; zero where they are too few to contaminate."""
    least = min(seed, len(item))
    # tokens outside the item cannot be in a tile; runs of them are cut to one
    inside = np.isin(ids, item)
    keep = inside | np.concatenate([[True], inside[:-1]])[: len(ids)]
    short = np.where(inside, ids, np.uint64(0))[keep]
    # every tiled token stands in a shared seed
    edge = np.zeros(len(item) + 1, np.int64)
    starts = np.flatnonzero(np.isin(rolling(item, least), rolling(short, least)))
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + least, -1)
    enough = lambda n: n >= threshold * len(item) and (len(item) >= seed or n == len(item))
    if not enough(int((edge[:-1].cumsum() > 0).sum())):
        return 0
    tiled = sum(n for _, _, n in tiles(short, item, least))
    return tiled if enough(tiled) else 0


class Matcher:
    """Seeds of a benchmark, and the tiling of documents against the items they hit."""

    def __init__(self, items: list[tuple[int | None, str]], seed: int, threshold: float):
        self.seed, self.threshold = seed, threshold
        self.vocab: dict[str, int] = {}
        #: Tokens of the items, by their number, and their ids.
        self.items: dict[int, np.ndarray] = {}
        self.ids: dict[int, int | None] = {}
        order = sorted(set(items), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        for number, (item_id, text) in enumerate(order):
            ids = np.array([self.vocab.setdefault(t, len(self.vocab) + 1) for t in tokens(text)], np.uint64)
            if len(ids):
                self.items[number], self.ids[number] = ids, item_id
        pairs: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for number, ids in self.items.items():
            n = min(seed, len(ids))
            for h in rolling(ids, n).tolist():
                pairs[n][h].add(number)
        self.owners = {n: dict(x) for n, x in pairs.items()}

    def judge(self, text: str) -> list[tuple[int | None, int, int, float]]:
        """(item_id, item tokens, tiled tokens, coverage) of every contaminating item."""
        get = self.vocab.get
        ids = np.fromiter(map(get, TOKENS(text.lower()), repeat(0)), np.int64).astype(np.uint64)
        hit: set[int] = set()
        # a seed has known tokens only: the token where the last unknown one is seeds before cannot end a seed
        place = np.arange(1, len(ids) + 1)
        run = place - np.maximum.accumulate(np.where(ids == 0, place, 0)) if len(ids) else place
        for n, owners in self.owners.items():
            ends = np.flatnonzero(run >= n)
            h = np.zeros(len(ends), np.uint64)
            for k in range(n):
                h = h * MULTIPLIER + ids[ends - (n - 1 - k)]
            for x in owners.keys() & set(h.tolist()):
                hit |= owners[x]
        out = []
        for number in sorted(hit):
            item = self.items[number]
            if tiled := tiled_tokens(ids, item, self.seed, self.threshold):
                out.append((self.ids[number], len(item), tiled, tiled / len(item)))
        return out


def _seeds(text: str, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` tokens, the same for every text."""
    import xxhash

    ids = np.array([xxhash.xxh64_intdigest(t) for t in tokens(text)], np.uint64)
    return (rolling(ids, n) ^ np.uint64(n)).view(np.int64)


def _by_join(docs: DataFrame, items: DataFrame, seed: int, threshold: float) -> DataFrame:
    """``docs`` (text and others) with ``_items``, for a benchmark of any size: seeds of both sides meet in a join."""
    numbered = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "tiling-documents")
    items = materialize(items.distinct().withColumn("_item", F.monotonically_increasing_id()), "tiling-items")

    def of_items(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for pdf in frames:
                for number, text in pdf.itertuples(index=False):
                    size = len(tokens(text))
                    if size:
                        n = min(seed, size)
                        found, times = np.unique(_seeds(text, n), return_counts=True)
                        need = threshold * size / n - 1e-9  # a shared seed covers n tokens
                        yield from ((int(h), number, int(t), need, n) for h, t in zip(found, times, strict=True))

        yield from rows_to_frames(rows(), ["h", "_item", "times", "need", "n"], 50_000)

    item_seeds = materialize(items.select("_item", "text").mapInPandas(of_items, "h long, _item long, times long, need double, n int"), "tiling-seeds")
    lengths = [r.n for r in item_seeds.select("n").distinct().collect()]  # at most ``seed`` numbers

    def of_docs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for number, text in pdf.itertuples(index=False):
                for n in lengths:
                    yield pd.DataFrame({"h": np.unique(_seeds(text, n)), "_row": number})

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    doc_seeds = numbered.select("_row", text).mapInPandas(of_docs, "h long, _row long")
    shared = doc_seeds.join(item_seeds, "h").groupBy("_row", "_item").agg(F.sum("times").alias("times"), F.max("need").alias("need"))
    pairs = materialize(shared.where("times >= need").select("_row", "_item"), "tiling-pairs")

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for pdf in frames:
                for number, text, item, item_text in pdf.itertuples(index=False):
                    vocab: dict[str, int] = {}
                    ids = np.array([vocab.setdefault(t, len(vocab) + 1) for t in tokens(item_text)], np.uint64)
                    doc = np.array([vocab.get(t, 0) for t in tokens(text)], np.uint64)
                    if tiled := tiled_tokens(doc, ids, seed, threshold):
                        yield number, item, len(ids), tiled, tiled / len(ids)

        yield from rows_to_frames(rows(), ["_row", "_item", "n_tokens", "tiled", "coverage"])

    both = pairs.join(items, "_item").join(numbered.select("_row", text.alias("_text")), "_row")
    found = both.select("_row", "_text", "_item", "text").mapInPandas(check, "_row long, _item long, n_tokens long, tiled long, coverage double")
    found = materialize(found, "tiling-found").join(items, "_item")
    order = [F.col("item_id").isNull().alias("last"), "item_id", "text", "n_tokens", "tiled", "coverage"]
    hits = found.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("_items"))
    plain = F.transform("_items", lambda x: F.struct(*[x[c].alias(c) for c in ("item_id", "n_tokens", "tiled", "coverage")]))
    hits = materialize(hits.select("_row", plain.alias("_items")), "tiling-hits")
    return numbered.join(hits, "_row", "left").drop("_row").withColumn("_items", F.coalesce("_items", F.array().cast(ITEMS)))


ITEMS = "array<struct<item_id: long, n_tokens: long, tiled: long, coverage: double>>"


def contaminations(
    docs: DataFrame, benchmark: DataFrame, seed: int = SEED, threshold: float = THRESHOLD, max_broadcast: int = 2_000_000
) -> DataFrame:
    """The documents with ``_items``: array of (item_id, n_tokens, tiled, coverage), empty for clean ones."""
    docs = docs.drop("_items", "_row")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if total > max_broadcast:  # characters bound the seeds
        return _by_join(docs, items, seed, threshold)
    matcher = docs.sparkSession.sparkContext.broadcast(Matcher([tuple(r) for r in items.collect()], seed, threshold))

    @F.pandas_udf(ITEMS)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = matcher.value
        for texts in batches:
            yield pd.Series([[dict(zip(("item_id", "n_tokens", "tiled", "coverage"), x, strict=True)) for x in m.judge(t)] for t in texts])

    return docs.withColumn("_items", judge(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it holds benchmark items, how many, and the best covered one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    best = F.array_min(F.transform("_items", lambda x: F.struct((-x["coverage"]).alias("c"), x["item_id"].alias("id"))))
    return contaminations(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        (F.size("_items") > 0).alias("contaminated"),
        F.size("_items").cast("long").alias("n_items"),
        F.transform("_items", lambda x: x["item_id"]).alias("item_ids"),
        best["id"].alias("best_item"),
        F.coalesce(-best["c"], F.lit(0.0)).alias("best_coverage"),
    )
