"""Best-fit packing of tokenized documents, certified by lower bounds.

Pieces are dealt to groups of bounded size; every group is packed by best-fit decreasing in its own task and
compares its bin count with a lower bound from dual-feasible functions. A group that meets its bound is certified:
only its loosest bin, the one that rounding up costs, may go. A group with a gap gives ``release`` of its loosest bins
back. The documents of all such bins are exchanged (dealt to fewer groups) and packed again, until nothing is given
back, one group remains or the rounds are over.

Defined cases: a null or empty text is the end token alone; only documents longer than the capacity are cut, into
full pieces and a shorter last one; repeated rows are packed one by one; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.llm.common import rows_to_frames, table
from openbell.session import materialize

CAPACITY = 4096
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# The tokenizer's own way to find words (its published file)
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Recent(dict):
    """Computed values of the keys met lately: two generations of at most ``limit`` keys each."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_letters() -> dict[int, str]:
    """Byte-level letters: visible Latin-1 characters stand for themselves, other bytes for those from 256 on."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordEncoder:
    """Token ids (little-endian, 4 bytes each) of whole texts through a bounded memory of words.

    The vocabulary never merges across white space, so a text's ids are those of its space-separated parts.
    Parts of plain Latin characters are split as the tokenizer does, and its model encodes their words; any other
    part goes to the whole tokenizer.
    """

    def __init__(self, path: str, limit: int = 250_000):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = regex.compile(PRETOKEN).findall
        self.plain = re.compile(r"[\x21-\x7eÀ-ÿ]{1,64}").fullmatch
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)").search
        self.letters = _byte_letters()
        self.known = Recent(self._word, limit // 2)
        self.parts = Recent(self._part, limit)

    def _word(self, word: str) -> bytes:
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _part(self, part: str) -> bytes:
        if self.plain(part) and not self.special(part):
            return b"".join(map(self.known.__getitem__, self.words(part.lower())))
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, text.replace("\n", " ").split(" ")))


@functools.cache
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = _encoder(tokenizer), end_id.to_bytes(4, "little")

        def rows():
            for pdf in frames:
                for key, text in pdf.itertuples(index=False):
                    ids = encoder.encode(text) + end
                    for k, start in enumerate(range(0, len(ids) // 4, capacity)):
                        part = ids[start * 4 : (start + capacity) * 4]
                        yield key, k, start, len(part) // 4, zlib.crc32(part)

        yield from rows_to_frames(rows(), ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = rows.mapInPandas(cut, PIECES.replace("doc_id long", "doc_id string"))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions over the length counts."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    number, weight = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(capacity // 2 + 1)  # more than capacity - t counts as whole, less than t as nothing
    below = np.where(t > 0, weight[np.maximum(t - 1, 0)], 0)
    best = int((-(-((number[-1] - number[capacity - t]) * capacity + weight[capacity - t] - below) // capacity)).max())
    for k in range(1, 21):
        scaled = (k + 1) * size
        whole = scaled % capacity == 0
        # in units of capacity / (k * (k + 1)): exact integers
        units = np.where(whole, k * (k + 1) * size // capacity, (k + 1) * (scaled // capacity))
        best = max(best, int(-(-(count * units).sum() // (k * (k + 1)))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every piece, and the fill of every bin; ties keep the given order."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: dict[int, list[int]] = defaultdict(list)
    sizes: list[int] = []  # free sizes that some bin has, in order
    fill: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        at = bisect_left(sizes, n)
        if at == len(sizes):
            b = len(fill)
            fill.append(0)
        else:
            space = sizes[at]
            b = free[space].pop()
            if not free[space]:
                sizes.pop(at)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        if rest := capacity - fill[b]:
            if not free[rest]:
                insort(sizes, rest)
            free[rest].append(b)
    return bins, offsets, np.asarray(fill, np.int64)


PACKED = PIECES.replace("doc_id long", "doc_id string") + ", sequence_id long, offset long, bins long, bound long, done boolean"


def _pack(pdf: pd.DataFrame, capacity: int, last: bool, release: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"], ascending=[False, True, True, True, True], kind="stable")
    lengths = pdf["length"].to_numpy(np.int64)
    bins, offsets, fill = best_fit_decreasing(lengths, capacity)
    bound = lower_bound(lengths, capacity)
    done = np.ones(len(fill), bool)
    if not last:  # the loosest bins go back; full ones cannot gain
        loose = np.argsort(fill, kind="stable")[: release if len(fill) > bound else 1]
        done[loose[fill[loose] < capacity]] = False
    return pdf[["doc_id", "piece", "start", "length", "ids_crc32"]].assign(
        sequence_id=int(pdf["_group"].iloc[0]) * (1 << 24) + bins, offset=offsets, bins=len(fill), bound=bound, done=done[bins]
    )


def pack(parts: DataFrame, capacity: int = CAPACITY, group_rows: int = 20_000, release: int = 64, rounds: int = 6) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    ``group_rows`` sets the rows of a task, ``release`` the bins a group with a gap gives back.
    """
    total = parts.count()
    # ids travel as text: pandas would turn a nullable long into a float
    parts = parts.withColumn("doc_id", F.col("doc_id").cast("string"))
    groups = max(1, -(-total // group_rows))
    todo, done, base = parts, [], 0
    for step in range(rounds):
        last = groups == 1 or step == rounds - 1
        # dealt by content, so that a recomputed task sees the same rows
        deal = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length", F.lit(step)), F.lit(groups)) + base
        run = functools.partial(_pack, capacity=capacity, last=last, release=release)
        packed = materialize(todo.withColumn("_group", deal).groupBy("_group").applyInPandas(run, PACKED), "packed")
        done.append(packed.where("done"))
        if last:
            break
        base += groups
        todo = packed.where("NOT done").select(*[c.split()[0] for c in PIECES.split(", ")])
        left = todo.count()
        if not left:
            break
        groups = max(1, min(groups // 4, -(-left // group_rows)))
    out = functools.reduce(DataFrame.unionByName, done)
    out = out.withColumn("doc_id", F.col("doc_id").cast("long"))
    return out.select(*[c.split()[0] for c in PIECES.split(", ")], "sequence_id", "offset")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(materialize(pieces(docs, tokenizer or default_tokenizer(), capacity), "pieces"), capacity)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
