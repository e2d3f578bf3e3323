"""SimHash near-dedup with vantage-point trees.

A tree of vantage points, balanced on a bounded sample of the distinct fingerprints, deals all of them to shards:
at a node a fingerprint goes to the inner side up to the split distance and to the outer side beyond it, and to
both when a ball of half the radius around it crosses the split (triangle bound). Two fingerprints within the
radius have a point between them at half the radius from each, so they meet in the shard of that point: no pair is
lost. Every shard builds its own tree the same way, compares the fingerprints of a leaf exactly and returns a
minimum spanning forest of the links, never all pairs of a cluster. Equal fingerprints are one node, so copies
cost nothing. The sample only balances the tree; the result does not depend on it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.llm.common import ascii_lower, table
from openbell.llm.components import components
from openbell.session import materialize

#: Rows of the sample that balances the tree, fingerprints a shard aims at, and of a leaf inside a shard.
SAMPLE, SHARD, LEAF = 32_768, 8_000, 512
#: Rows of a shard beyond which it becomes pairs of blocks, and an odd factor that spreads fingerprints over blocks.
SHARD_BLOCK, FACTOR = 1 << 17, np.uint64(0x9E3779B97F4A7C15)
WORDS = re.compile(rb"[^\x20\x09-\x0d]+").findall


def words(text: str) -> list[bytes]:
    """Words of the text with A-Z lower-cased, as UTF-8."""
    return WORDS(text.encode().lower())


def shingles(tokens: list[bytes], n: int) -> list[bytes]:
    """Space-joined runs of ``n`` words, repeats included; a shorter text is one shingle, no word none."""
    if not tokens:
        return []
    line, ends = b" ".join(tokens), np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(tokens) <= n:
        return [line]
    return [line[a:b] for a, b in zip(starts[: len(tokens) - n + 1].tolist(), ends[n - 1 :].tolist(), strict=True)]


def simhash(terms: list[bytes], seed: int = 42) -> int:
    """64-bit fingerprint (unsigned): a bit is 1 if set in over half the XXH64 of the terms; none: zero."""
    import xxhash

    if not terms:
        return 0
    h = np.array([xxhash.xxh64_intdigest(t, seed) for t in terms], np.uint64)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(h), bitorder="little").view(np.uint64)[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, n_words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. A null text is empty."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            fps = [_signed(simhash(shingles(words(t), n_words), seed)) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": np.array(fps, np.int64)})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id string, fp long").withColumn("doc_id", F.col("doc_id").cast("long"))


def _split(points: np.ndarray, half: int, seed: int, most: float) -> tuple[np.uint64, int] | None:
    """The vantage point and distance that leave the least work, of a few seeded candidates.

    Comparing all pairs costs the square of a side; None if the two sides together cost more than ``most`` of what
    the undivided points do, as in a dense cluster, whose points lie on both sides of any split.
    """
    rng = np.random.default_rng(seed)
    sample = points if len(points) <= 2048 else points[rng.integers(0, len(points), 2048)]
    best = None
    for vp in sample[rng.integers(0, len(sample), 6)]:
        d = np.bitwise_count(sample ^ vp)
        at = int(np.median(d))
        for mid in (at - 1, at):
            inner, outer = int((d <= mid + half).sum()), int((d > mid - half).sum())
            work = (inner**2 + outer**2) / len(sample) ** 2
            if work < most and (best is None or work < best[0]):
                best = (work, vp, mid)
    return best and (best[1], best[2])


def _sides(points: np.ndarray, vp: np.uint64, mid: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    d = np.bitwise_count(points ^ vp).astype(np.int64)
    return np.flatnonzero(d - half <= mid), np.flatnonzero(d + half > mid)


class Tree:
    """Routing tree over a sample; leaves are shard numbers."""

    def __init__(self, sample: np.ndarray, total: int, radius: int, shard: int = SHARD):
        self.half, self.leaves = (radius + 1) // 2, 0
        scale = total / max(1, len(sample))
        self.root = self._grow(sample, scale, shard, 0)

    def _grow(self, points: np.ndarray, scale: float, shard: int, depth: int):
        cut = _split(points, self.half, depth, 0.95) if len(points) * scale > shard and len(points) >= 16 else None
        if cut is None:
            self.leaves += 1
            return self.leaves - 1
        inner, outer = _sides(points, *cut, self.half)
        return (*cut, self._grow(points[inner], scale, shard, depth + 1), self._grow(points[outer], scale, shard, depth + 1))

    def route(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, positions) of all points; a point may be in several shards."""
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if isinstance(node, int):
                yield node, at
            else:
                vp, mid, inside, outside = node
                inner, outer = _sides(points[at], vp, mid, self.half)
                todo += [(inside, at[inner]), (outside, at[outer])]


def _leaf_links(points: np.ndarray, near: np.ndarray, at: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Minimum spanning forest (by distance of ``near``) of all links of a leaf."""
    x = points[at]
    linked = np.concatenate(
        [(np.bitwise_count(x[k : k + 256, None] ^ x[None, :]) <= radius).sum(1) > 1 for k in range(0, len(x), 256)]
    )
    at = at[linked]
    x, y = points[at], near[at]
    out, best, who = [], np.full(len(at), 1 << 20), np.zeros(len(at), np.int64)
    left = np.ones(len(at), bool)
    for _ in range(len(at)):
        k = int(np.argmin(np.where(left, best, 1 << 30)))
        left[k] = False
        if best[k] < 1 << 20:
            out.append((int(at[who[k]]), int(at[k])))
        d = np.where(np.bitwise_count(x ^ x[k]) <= radius, np.bitwise_count(y ^ y[k]).sum(1, dtype=np.int64), 1 << 20)
        closer = left & (d < best)
        best[closer], who[closer] = d[closer], k
    return out


def shard_links(points: np.ndarray, near: np.ndarray, radius: int, leaf: int = LEAF) -> set[tuple[int, int]]:
    """Forest of the links of one shard, by a tree of its own over positions. Equal points link to the first one."""
    _, first, same = np.unique(points, return_index=True, return_inverse=True)
    lead = first[same]
    out = {(int(lead[k]), int(k)) for k in np.flatnonzero(lead != np.arange(len(points)))}
    half, todo = (radius + 1) // 2, [(first, 0)]
    while todo:
        at, depth = todo.pop()
        cut = _split(points[at], half, depth, 0.9) if len(at) > leaf else None
        if cut is None:
            out.update(_leaf_links(points, near, at, radius))
        else:
            todo += [(at[side], depth + 1) for side in _sides(points[at], *cut, half)]
    return out


def links(nodes: DataFrame, radius: int, near: list[str] | None = None, shard: int = SHARD, block: int = SHARD_BLOCK) -> DataFrame:
    """(a, b): links between rows of ``nodes`` (node, fp, further long columns ``near``) within the radius.

    ``fp`` should be distinct. Rows connected by links stay connected; of a cluster a minimum spanning forest by
    the Hamming distance of the ``near`` columns (``fp`` where none are named) is returned.

    A shard of more than ``block`` rows (a dense cluster, which no split parts) is dealt out as pairs of blocks of
    about half that, by a hash of the fingerprint: every task holds two blocks, every pair of rows meets in one.
    """
    near = near or ["fp"]
    kind = dict(nodes.dtypes)["node"]
    total = nodes.count()
    some = nodes.select("fp").orderBy(F.xxhash64("fp", F.lit(7)), "fp").limit(SAMPLE).collect()
    tree = nodes.sparkSession.sparkContext.broadcast(Tree(np.array([r[0] for r in some], np.int64).view(np.uint64), total, radius, shard))
    columns = list(dict.fromkeys(["node", "fp", *near]))

    blocks: dict[int, int] = {}

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            fps = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            for number, at in tree.value.route(fps):
                n = blocks.get(number, 1)
                if n == 1:
                    yield pdf.iloc[at].assign(_shard=number, _pair=0)
                    continue
                own = ((fps[at] * FACTOR) >> np.uint64(33)).astype(np.int64) % n
                for other in range(n):
                    some = own != other
                    low, high = np.minimum(own[some], other), np.maximum(own[some], other)
                    yield pdf.iloc[at[some]].assign(_shard=number, _pair=low * n + high)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(tree.value.leaves, np.int64)
        for pdf in frames:
            for number, at in tree.value.route(pdf["fp"].to_numpy(np.int64).view(np.uint64)):
                held[number] += len(at)
        some = np.flatnonzero(held)
        yield pd.DataFrame({"_shard": some, "n": held[some]})

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        sig = np.stack([pdf[c].to_numpy(np.int64).view(np.uint64) for c in near], axis=1)
        node = pdf["node"].tolist()
        pairs = shard_links(points, sig, radius)
        return pd.DataFrame([(node[i], node[j]) for i, j in sorted(pairs)], columns=["a", "b"])

    fields = ", ".join(f"{c} {kind if c == 'node' else 'long'}" for c in columns)
    if total > block:  # one number per shard, and shards are at most a few thousand
        sizes = nodes.select("fp").mapInPandas(count, "_shard int, n long").groupBy("_shard").agg(F.sum("n").alias("n"))
        blocks = {r["_shard"]: -(-2 * r["n"] // block) for r in sizes.where(F.col("n") > block).collect()}
    dealt = nodes.select(*columns).mapInPandas(deal, f"{fields}, _shard int, _pair long")
    return dealt.groupBy("_shard", "_pair").applyInPandas(link, f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, n_words: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id): fingerprints within the radius link, components are transitive.

    Defined cases: a null text is empty, its fingerprint zero; equal rows are equal nodes; ``component_id`` is the
    smallest doc_id that can be reached (null only if all are null); an empty table gives no rows.
    """
    fps = materialize(fingerprints(docs, n_words), "fingerprints")
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    roots = components(links(nodes.select(F.col("fp").alias("node"), "fp"), radius))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    label = materialize(named.join(smallest, "root").select("fp", "component_id"), "fingerprint-labels")
    return fps.join(label, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


# --- one document of each group, for the pipeline -----------------------------------------------------------

#: Words of a fingerprint's shingles and differing bits of linked fingerprints, as in ``op6_simhash_near_dedup``.
PRINT_WORDS, PRINT_RADIUS = 3, 2
#: Keys per text and MinHash values in each. Two texts of similarity J share no key with probability
#: (1 - J**4) ** 32, which is 5e-8 at 0.8 and less above, whatever kind of edit parts them.
BANDS, ROWS = 32, 4
FACTORS = np.random.default_rng(42).integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
#: Shingles hashed in one block.
BLOCK = 2048


def band_keys(terms: set[bytes]) -> list[int]:
    """One signed 64-bit key per band: the MinHash values of the distinct terms, ``ROWS`` to a key. No term: no key."""
    import xxhash

    if not terms:
        return []
    h = np.array([xxhash.xxh64_intdigest(t, 42) for t in terms], np.uint64)
    least = np.full(BANDS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(h), BLOCK):
        g = h[None, at : at + BLOCK] * FACTORS[:, None]
        g ^= g >> np.uint64(32)
        g *= np.uint64(0xBF58476D1CE4E5B9)
        g ^= g >> np.uint64(29)
        least = np.minimum(least, g.min(1))
    key = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column) * np.uint64(0x94D049BB133111EB)
        key ^= key >> np.uint64(31)
    return key.view(np.int64).tolist()


def _node() -> F.Column:
    """Identity of a text up to case and white space."""
    plain = F.regexp_replace(ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), r"[\x20\x09-\x0D]+", " ")
    return F.md5(F.trim(plain))


def jaccard(left: str, right: str, n: int) -> float:
    a, b = set(shingles(words(left), n)), set(shingles(words(right), n))
    return len(a & b) / len(a | b) if a or b else 1.0


def shingle_hashes(text: str, n: int) -> np.ndarray:
    """The XXH64 of the distinct shingles, in order, as signed longs."""
    import xxhash

    terms = set(shingles(words(text), n))
    return np.sort(np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in terms), np.uint64, len(terms)).view(np.int64))


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, j): the similarity of every pair by its sets of 64-bit shingle hashes; ``sets`` are (nid, sh)."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("nid")).distinct()
    some = sets.join(wanted, "nid", "left_semi")
    left, right = some.toDF("a", "sa"), some.toDF("b", "sb")
    both = F.size(F.array_intersect("sa", "sb"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb")).alias("all"))
    return rows.select("a", "b", F.when(F.col("all") == 0, 1.0).otherwise(F.try_divide("both", F.col("all") - F.col("both"))).alias("j"))


#: Shingles that one block of a key's texts aims at: two blocks are compared in one task.
BLOCK_SHINGLES = 200_000


def block_links(sets: list[np.ndarray], roots: np.ndarray, blocks: np.ndarray, similarity: float) -> list[tuple[int, int, float]]:
    """Links (i, j, similarity) that connect different roots: a forest, never all pairs. Of two blocks only pairs across
    them are compared, of one block all pairs; pairs of one root are skipped."""
    sizes = np.array([len(s) for s in sets], np.int64)
    _, codes = np.unique(np.concatenate(sets) if len(sets) else np.zeros(0, np.int64), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(codes, kind="stable")
    postings, starts = owner[order], np.searchsorted(codes[order], np.arange(codes.max(initial=-1) + 2))
    ends, two, parent = np.cumsum(sizes), len(set(blocks.tolist())) > 1, {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    names, size_of_root = np.unique(roots, return_counts=True)
    out, largest = [], names[np.argmax(size_of_root)] if len(names) else None
    for i in np.flatnonzero(roots != largest):  # every pair of two roots has a text outside the largest
        own = codes[ends[i] - sizes[i] : ends[i]]
        shared = np.bincount(np.concatenate([postings[starts[c] : starts[c + 1]] for c in own] or [np.zeros(0, np.int64)]), minlength=len(sets))
        alike = shared / np.maximum(sizes[i] + sizes - shared, 1)
        for j in np.flatnonzero((alike >= similarity) & (roots != roots[i]) & ((blocks != blocks[i]) | (not two))):
            x, y = find(roots[i]), find(roots[j])
            if x != y:
                parent[x] = y
                out.append((int(i), int(j), float(alike[j])))
    return out


def _near_prints(nodes: DataFrame) -> DataFrame:
    """(a, b): texts whose SimHash fingerprints differ in few bits, by the vantage-point tree; ``nodes`` are (nid, fp).

    A forest that connects whatever such links connect: texts of one fingerprint meet its first one, and the tree's
    shards return a minimum spanning forest of the fingerprints.
    """
    prints = materialize(nodes.groupBy("fp").agg(F.min("nid").alias("node")), "near-prints")
    equal = nodes.join(prints, "fp").where(F.col("nid") != F.col("node")).select(F.col("node").alias("a"), F.col("nid").alias("b"))
    return materialize(links(prints.select("node", "fp"), PRINT_RADIUS).select("a", "b").unionByName(equal), "near-links")


def _shared_keys(nodes: DataFrame) -> DataFrame:
    """(key, nid, n) of the MinHash keys that several texts have."""
    rows = nodes.select(F.explode("keys").alias("key"), "nid", "n")
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    return materialize(rows.join(shared.hint("merge"), "key", "left_semi"), "band-shared")


def _groups(live: DataFrame, sets: DataFrame, similarity: float, near: DataFrame | None = None) -> DataFrame | None:
    """(nid, root) of all texts with a true link; None without any. ``live`` has the rows (key, nid, n) of shared keys,
    ``near`` the pairs (a, b) of near fingerprints.

    First come the pairs of near fingerprints, and every text is compared with one centre, the smallest text of all
    its keys: this connects most copies, one pair per text. Keys whose texts are not all connected by then are compared whole, in pairs of blocks of bounded
    size as tasks of their own; a task returns a forest of links, so no pairs are written whatever the group's size.
    """

    def linked(links: DataFrame) -> DataFrame | None:
        true = links.where(F.col("j") >= similarity).select("a", "b")
        if true.isEmpty():
            return None
        return materialize(components(true).select(F.col("node").alias("nid"), "root"), "band-roots")

    smallest = live.groupBy("key").agg(F.min(F.struct("nid", "n")).alias("c"))
    lead = live.join(smallest.hint("merge"), "key").groupBy("nid", "n").agg(F.min("c").alias("c"))
    sizes = F.least("n", "c.n") >= F.greatest("n", "c.n") * similarity - 1e-9
    pairs = lead.where((F.col("nid") != F.col("c.nid")) & sizes).select(F.col("c.nid").alias("a"), F.col("nid").alias("b"))
    if near is not None:
        both = pairs.unionByName(near)
        pairs = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    tried = materialize(_similar(materialize(pairs, "band-pairs"), sets), "band-tried")
    roots = linked(tried)
    named = live.withColumn("root", F.col("nid"))
    if roots is not None:
        named = live.join(roots, "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    named = materialize(named.select("key", "nid", "n", "root"), "band-rows")
    total = F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks")
    open_keys = named.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), total).where("x <> y").select("key", F.greatest("blocks", F.lit(1)).alias("blocks"))
    rows = named.join(open_keys.hint("merge"), "key").withColumn("block", F.pmod(F.xxhash64("nid"), "blocks").cast("int"))
    rows = rows.select("key", "nid", "root", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = materialize(rows.select("key", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "nid", "root"), "band-blocks")
    if rows.isEmpty():
        return roots

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        nids = pdf["nid"].to_numpy()
        found = block_links([np.asarray(s, np.int64) for s in pdf["sh"]], pdf["root"].to_numpy(), pdf["block"].to_numpy(), similarity)
        return pd.DataFrame([(min(nids[i], nids[j]), max(nids[i], nids[j]), s) for i, j, s in found], columns=["a", "b", "j"])

    met = rows.join(sets.hint("merge"), "nid").groupBy("key", "p", "q").applyInPandas(compare, "a long, b long, j double")
    return linked(tried.select("a", "b", "j").unionByName(materialize(met, "band-links")))


def keep_one(docs: DataFrame, n_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents without near copies: of every group the row with the smallest doc_id stays.

    Texts whose ``n_words`` shingle sets (64-bit hashes of whole texts, of any length) have a similarity of at least
    ``similarity`` are linked, groups are transitive. Candidates are the links of the vantage-point tree over all SimHash
    fingerprints, as in ``near_duplicates``; each is checked, since texts of much repetition agree in their bits without
    being alike. Near copies whose bits differ more share one of the keys of MinHash values of their shingles; every two
    texts of a key that are still apart are compared or connected (see ``_groups``). Equal texts are one node; texts without words are one group. Rows equal
    in doc_id and text count as one; other columns pass through.
    """
    columns = docs.columns
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), _node().alias("node"))

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            sizes, keys, fps = [], [], []
            for text in pdf["text"]:  # the shingles of one text at a time are in memory
                tokens = words(text)
                fps.append(_signed(simhash(shingles(tokens, PRINT_WORDS))))
                terms = set(shingles(tokens, n_words))
                sizes.append(len(terms))
                keys.append(band_keys(terms))
            yield pdf[["doc_id", "node"]].assign(n=sizes, keys=keys, fp=np.array(fps, np.int64))

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf[["nid"]].assign(sh=[shingle_hashes(t, n_words) for t in pdf["text"]])

    signed = texts.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(sign, "doc_id string, node string, n long, keys array<long>, fp long")
    signed = materialize(signed.withColumn("doc_id", F.col("doc_id").cast("long")), "bands")
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("n").alias("n"), F.min("keys").alias("keys"), F.min("fp").alias("fp"))
    nodes = materialize(nodes.withColumn("nid", F.monotonically_increasing_id()), "band-nodes")
    near, live = _near_prints(nodes.select("nid", "fp")), _shared_keys(nodes)

    met = live.select("nid").unionByName(near.select(F.explode(F.array("a", "b")).alias("nid"))).distinct()
    wanted = nodes.join(met, "nid", "left_semi").select("nid", F.col("node").alias("_n"), "first")
    some = texts.join(wanted.hint("merge"), (texts["node"] == wanted["_n"]) & texts["doc_id"].eqNullSafe(wanted["first"]))
    sets = some.groupBy("nid").agg(F.first("text").alias("text")).mapInPandas(hashed, "nid long, sh array<long>")
    sets = materialize(sets, "band-sets")

    group = F.col("nid")
    roots = _groups(live, sets, similarity, near)
    if roots is not None:
        nodes, group = nodes.join(roots, "nid", "left"), F.coalesce("root", "nid")
    order = F.struct(F.col("first").isNull().alias("unknown"), "first", "node")
    kept = nodes.groupBy(group.alias("group")).agg(F.min(order).alias("k"))
    kept = materialize(kept.select(F.col("k.first").alias("_id"), F.col("k.node").alias("_keep")), "kept")
    rows = docs.select("doc_id", _node().alias("node"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    rows = rows.join(kept.hint("merge"), (rows["node"] == kept["_keep"]) & rows["doc_id"].eqNullSafe(kept["_id"]), "left_semi")
    return rows.dropDuplicates(["doc_id", "node"]).select("row.*")
