"""Language identification by rank-order profiles of character n-grams.

A text's letters are lower-cased; runs of anything else are one boundary. Its profile is the ``top`` most frequent
n-grams of one to ``longest`` characters (within words, boundaries included; ties: smaller code points first).
A language's profile is made the same way from the summed counts of its learning texts. The distance is the sum of
rank differences, ``top`` for an n-gram the language lacks; the closest language wins (ties: the first by name).
The score is one minus the distance over the largest possible one.

Counting a text is one vectorised pass per document; learning sums (language, n-gram) counts that every task has
added up before the shuffle, and only the ``top`` rows of each language reach the driver.

Defined cases: a null text, one without a letter, or no learned language gives ``und`` with score 0; rows without
lang are not learned from; repeated rows are predicted one by one and learned as often; further columns are ignored.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from openbell.llm.common import rows_to_frames, table

TOP, LONGEST = 300, 3
BITS, EDGE = 21, 1  # bits of a code point; the boundary, no letter


@functools.cache
def _letters() -> np.ndarray:
    """True at the code points that are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """Codes (21 bits per character, boundary 1) and counts of the n-grams, in order of code."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letters = _letters()[chars]
    if not letters.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # one boundary for a run of other characters, and one at either end
    chars = np.where(letters, chars, EDGE)
    chars = np.concatenate([[EDGE], chars[letters | np.concatenate([[False], letters[:-1]])], [EDGE]])
    if chars[-2] == EDGE:
        chars = chars[:-1]
    found, codes = [chars[chars > EDGE]], chars
    inner = np.ones(len(chars), bool)  # no boundary inside
    for n in range(2, longest + 1):
        codes = (codes[:-1] << BITS) | chars[n - 1 :]
        inner = inner[:-1] & ((chars[n - 2 : -1] > EDGE) | (n == 2))
        found.append(codes[inner])
    return np.unique(np.concatenate(found), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent codes, best first; ``codes`` is in order."""
    return codes[np.argsort(-counts, kind="stable")[:top]]


class Profiles:
    """Rank lists of all learned languages, looked up together."""

    def __init__(self, lists: dict[str, list[int]], top: int = TOP):
        self.names, self.top = sorted(lists), top
        self.codes = np.unique(np.concatenate([np.array(lists[n], np.int64) for n in self.names] or [np.zeros(0, np.int64)]))
        self.rank = np.full((len(self.names), len(self.codes) + 1), -1, np.int64)
        for k, name in enumerate(self.names):
            self.rank[k, np.searchsorted(self.codes, lists[name])] = np.arange(len(lists[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(*ngrams(text), self.top) if text else []
        if not len(own) or not self.names:
            return "und", 0.0
        at = np.searchsorted(self.codes, own)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != own)] = len(self.codes)
        theirs = self.rank[:, at]
        away = np.where(theirs < 0, self.top, np.abs(theirs - np.arange(len(own)))).sum(1)
        best = int(np.argmin(away))
        return self.names[best], 1.0 - float(away[best]) / (self.top * len(own))


def learn(docs: DataFrame, top: int = TOP, keep: int = 200_000) -> Profiles:
    """Profiles from all rows of ``docs`` (text, lang). ``keep`` only bounds a task's memory before it emits."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            sums: dict[str, dict[int, int]] = defaultdict(lambda: defaultdict(int))
            for pdf in frames:
                for lang, group in pdf.groupby("lang", sort=False):
                    parts = [ngrams(t) for t in group["text"]]
                    if not parts:
                        continue
                    codes, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                    total = np.bincount(where, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)
                    own = sums[lang]
                    for code, n in zip(codes.tolist(), total.tolist(), strict=True):
                        own[code] += n
                if sum(map(len, sums.values())) > keep:
                    yield from ((lang, code, n) for lang, own in sums.items() for code, n in own.items())
                    sums.clear()
            yield from ((lang, code, n) for lang, own in sums.items() for code, n in own.items())

        yield from rows_to_frames(rows(), ["lang", "code", "n"], 20_000)

    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    sums = rows.mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    lists: dict[str, list[int]] = defaultdict(list)
    for lang, code, _ in sums.withColumn("k", F.row_number().over(best)).where(F.col("k") <= top).select("lang", "code", "k").orderBy("lang", "k").collect():
        lists[lang].append(code)
    return Profiles(dict(lists), top)


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``."""
    known = docs.sparkSession.sparkContext.broadcast(profiles)

    @F.pandas_udf("name string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([known.value.predict(t) for t in texts], columns=["name", "score"])

    columns = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "lang_score")]
    rows = docs.select(F.struct(*columns).alias("row"), run(F.col("text").cast("string")).alias("found"))
    return rows.select("row.*", F.col("found.name").alias("lang_pred"), F.col("found.score").alias("lang_score"))


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, predict all."""
    return predict(docs, learn(docs.where(~F.coalesce(held_out(), F.lit(True)))))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", F.coalesce(held_out(), F.lit(True)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
