"""Quality rules, filter audit and centroid clustering against brute force, with the defined edge cases."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from openbell.llm import audit, centroids, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SIMPLE = [f"w{k}" for k in range(40)]


def prose(rng, n, words=SIMPLE):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """(doc_id, text, source) and label rows: prose, junk, copies, repeats, nulls, a very long text."""
    rng = random.Random(3)
    rows = [(k, "\n".join(prose(rng, 15) for _ in range(rng.randint(3, 20))), f"s{k % 3}") for k in range(60)]
    rows += [(100 + k, " ".join(f"{rng.choice(SIMPLE)}{rng.choice('#$%&|')}" for _ in range(90)), "s1") for k in range(12)]
    rows += [(200 + k, prose(rng, 80).upper(), None) for k in range(6)]
    rows += [(300, None, "s0"), (301, "", None), (302, " \t\n\x0b ", ""), (303, "one", "s2"), (304, "ab " * 400, "s2")]
    rows += [(305, prose(rng, 60_000), "s0"), (306, "naïve é ü ß 漢字 " * 60, "s1"), (None, rows[1][1], "s1"), (None, "x y", None)]
    rows += [(400 + k, rows[k][1], f"s{k % 2}") for k in range(9)] + [rows[5], rows[5], (5, rows[6][1], "s2")]
    labels = [(k, 1, 0) for k in range(0, 50)] + [(k, 1, 1) for k in range(50, 55)] + [(k, 0, 0) for k in range(100, 112)]
    labels += [(3, 1, 0), (4, 0, 0), (300, 1, None), (None, 1, 0), (999, 1, 1), (400, 1, 1), (400, 1, 0), (201, None, 1)]
    return rows, labels


def frames(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame([(i, t, None, s, None) for i, t, s in rows], DOCS).repartition(3)
    return docs, spark.createDataFrame(labels, LABELS)


# --- quality rules --------------------------------------------------------------------------------------------


def brute_surface(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k in range(len(words) - 2) for j in range(3) if windows[tuple(words[k : k + 3])] > 1}
    lines = Counter(x for x in text.split("\n") if WORD.search(x))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(n - 1 for n in lines.values()), len(covered)


def brute_grams(text):
    number = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16)
    h = [number("".join(c.lower() if "A" <= c <= "Z" else c for c in w)) for w in WORD.findall(text or "")]
    return Counter([x % quality.BUCKETS for x in h] + [(a * quality.PAIR + b) % quality.BUCKETS for a, b in zip(h, h[1:], strict=False)])


def brute_quality(rows, labels, lose):
    marks = defaultdict(list)
    for i, q, t in labels:
        marks[i].append((q, t))
    trusted = {i for i, m in marks.items() if i is not None and all(q == 1 for q, _ in m) and not any(t == 1 for _, t in m)}
    grams, raw, target = [brute_grams(t) for _, t, _ in rows], Counter(), Counter()
    for (i, _, _), g in zip(rows, grams, strict=True):
        raw.update(g)
        if i in trusted:
            target.update(g)
    out, good, (nr, nt) = [], [], (sum(raw.values()), sum(target.values()))
    for (i, t, _), g in zip(rows, grams, strict=True):
        size, own = sum(g.values()), i in trusted
        units = sum(
            n * math.floor(math.log(((target[b] - n * own) / ((raw[b] - n + 1) / (nr - size + quality.BUCKETS)) + quality.BUCKETS) / (nt - size * own + quality.BUCKETS)) * quality.UNIT + 0.5)
            for b, n in g.items()
        )
        s = brute_surface(t)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        milli = math.floor(units * 1000 / (size * quality.UNIT)) if size else None
        out.append((i, *s, failed, milli))
        if own and not failed:
            good.append(milli)
    least = sorted(good)[int(len(good) * lose)] if good else None
    return [(*r[:7], None if r[7] is None else r[7] / 1000, not r[6] and (least is None or r[7] >= least)) for r in out]


def key(row):
    return tuple(str(x) for x in row)


@pytest.mark.parametrize("lose", [0.002, 0.1])
def test_quality_equals_brute_force(spark, corpus, lose):
    got = [tuple(r) for r in quality.judge(*frames(spark, corpus), lose=lose).collect()]
    want = brute_quality(*corpus, lose)
    assert sorted(got, key=key) == sorted(want, key=key)
    verdict = {r[0]: r[-1] for r in got}
    assert not any(verdict[k] for k in range(100, 112)) and sum(verdict[k] for k in range(60)) >= (55 if lose < 0.1 else 45)


def test_repeated_words_of_equal_windows():
    for words in (["a"] * 3, ["a"] * 4, list("abcabc"), list("abcxabcyabc"), list("ab"), [], list("abcd" * 50)):
        assert quality.repeated_words([w.encode() for w in words]) == brute_surface(" ".join(words))[4]


def test_quality_edges(spark, corpus):
    docs, labels = frames(spark, corpus)
    assert quality.judge(docs.limit(0), labels).count() == 0
    alone = quality.judge(docs, labels.limit(0)).collect()  # the base rules decide alone
    assert all(r.kept != r.base_failed for r in alone) and len(alone) == len(corpus[0])
    named = docs.selectExpr("*", "1 AS bucket", "2 AS raw", "3 AS milli", "'x' AS kept", "5 AS n_words", "true AS trusted")
    same = sorted((tuple(r) for r in quality.judge(named, labels).collect()), key=key)
    assert same == sorted((tuple(r) for r in quality.judge(docs, labels).collect()), key=key)
    assert len(quality.trusted_ids(labels, 7)) == 7 and 50 not in quality.trusted_ids(labels) and 4 not in quality.trusted_ids(labels)


def test_every_trusted_label_counts(spark, corpus):
    """More trusted ids than any bounded sample takes: the target and the threshold still come from all of them."""
    docs, labels = frames(spark, corpus)
    more = spark.range(10_000, 10_000 + quality.MAX_TRUSTED * 3).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    many = quality.judge(docs, labels.unionByName(more), lose=0.1).collect()
    assert sorted(map(tuple, many), key=key) == sorted(brute_quality(*corpus, 0.1), key=key)


def test_packed_grams_come_back():
    rng = np.random.default_rng(5)
    for size in (0, 1, 2, 700, quality.BUCKETS):
        at = np.sort(rng.choice(quality.BUCKETS, size, replace=False))
        n = rng.integers(1, 2 if size < 3 else 3_000_000, size)
        back = quality.unpack(quality.pack(at, n))
        assert back[0].tolist() == at.tolist() and back[1].tolist() == n.tolist()


def test_no_text_is_shuffled(spark, corpus, monkeypatch, capsys):
    """Trusted ids too many to broadcast: what the join deals out is narrower than the texts, the rows are the same."""
    rows, labels = corpus
    rows, labels = [*rows, (2**60 + 1, rows[2][1], "s1")], [*labels, (2**60 + 1, 1, 0)]
    docs = spark.createDataFrame([(i, t, None, s, None) for i, t, s in rows], DOCS)
    frames = []

    def seen(name):
        own = getattr(quality, name)
        monkeypatch.setattr(quality, name, lambda df, *a, **b: (frames.append(df), own(df, *a, **b))[1])

    for name in ("materialize", "bucket_counts", "score"):
        seen(name)
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted(map(tuple, quality.judge(docs, spark.createDataFrame(labels, LABELS), lose=0.1).collect()), key=key)
        capsys.readouterr()
        for df in frames:
            df.explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    dealt = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", capsys.readouterr().out)
    assert any("_deal#" in x for x in dealt) and not any(re.search(r"\btext#", x) for x in dealt)
    assert got == sorted(brute_quality(rows, labels, 0.1), key=key)


def test_packed_grams_are_smaller_than_texts(spark):
    rng = random.Random(8)
    docs = spark.createDataFrame([(k, prose(rng, 600, [f"word{x}" for x in range(5000)])) for k in range(20)], "doc_id long, text string")
    stored = quality.counted(docs).agg(F.sum(F.length("grams"))).first()[0]
    assert 2 * stored < docs.agg(F.sum(F.length("text"))).first()[0]


# --- filter audit ---------------------------------------------------------------------------------------------


def brute_audit(rows, labels):
    by_text, marks = defaultdict(list), defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            by_text[t or ""].append(i)
    for i, q, t in labels:
        marks[i].append((q == 1, t == 1))
    parts = defaultdict(list)
    for i, t, s in rows:
        t = t or ""
        words = WORD.findall(t)
        fails = set("A" if len(words) < 200 else "")
        fails |= set("B" if 100 * len(set(words)) < 50 * len(words) else "")
        fails |= set("C" if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else "")
        fails |= set("D" if re.search(r"[#$%&*|]", t) else "")
        fails |= set("E" if i is not None and min(by_text[t]) < i else "")
        own = marks[i] if i is not None else []
        parts[s or ""].append((fails, any(q for q, _ in own), any(x for _, x in own)))
    out, share = {}, Counter()
    for part, own in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, c in enumerate(order, 1):
                gone = [d for d in left if c in d[0]]
                left = [d for d in left if c not in d[0]]
                share[part, c] += len(gone)
                failing = sum(c in d[0] for d in own)
                out[part, "".join(order), step] = (
                    len(left), len(gone), failing - len(gone), sum(d[0] == {c} for d in own), sum(d[1] for d in gone), sum(d[2] for d in gone)
                )
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_brute_force(spark, corpus):
    got = audit.audit(*frames(spark, corpus)).collect()
    want = brute_audit(*corpus)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == want and len(got) == len(want) == 4 * 600
    for name in ("removed", "redundant", "unique_fails", "good_lost", "toxic_lost"):
        assert any(r[name] for r in got), name
    # efficiency: the shares of the five filters add up to what all of them remove, in every part
    for part in {r.part for r in got}:
        first = [r for r in got if r.part == part and r.filter_order == "ABCDE"]
        assert sum(r.shapley for r in first) == 120 * sum(r.removed for r in first)


def test_potential_of_another_game(spark):
    """Three filters on hand-made masks: the potential's differences are the Shapley values by definition."""
    rows = spark.createDataFrame([("p", m) for m in (0, 1, 1, 3, 5, 6, 7, 7, 4)], "part string, m int")
    rows = rows.selectExpr("part", "m & 1 = 1 AS x", "m & 2 = 2 AS y", "m & 4 = 4 AS z")
    got = audit.steps(audit.coalitions(audit.masks(rows, "part", ["x", "y", "z"], []), 3, []), list("xyz"), {}).collect()
    v = lambda s: sum(bool(m & s) for m in (0, 1, 1, 3, 5, 6, 7, 7, 4))
    for r in got:
        want = 0
        for o in itertools.permutations(range(3)):
            k = "xyz".index(r.filter_order[r.step - 1])
            before = sum(2**j for j in o[: o.index(k)])
            want += v(before | 2**k) - v(before)
        assert r.shapley == want


def test_audit_edges(spark, corpus):
    docs, labels = frames(spark, corpus)
    assert audit.audit(docs.limit(0), labels).count() == 0
    assert all(r.good_lost == r.toxic_lost == 0 for r in audit.audit(docs, labels.limit(0)).collect())
    named = docs.selectExpr("*", "'x' AS part", "1 AS A", "2 AS E", "'d' AS digest", "3 AS good", "4 AS mask", "5 AS _id", "6 AS quality")
    assert sorted(map(tuple, audit.audit(named, labels).collect())) == sorted(map(tuple, audit.audit(docs, labels).collect()))


# --- centroid clustering --------------------------------------------------------------------------------------


def brute_clusters(rows, k=8, rounds=10, size=64):
    kept = []
    for i, x in rows:
        if x is not None and len(x) == size and all(c is not None and math.isfinite(c) for c in x):
            kept.append((i, [math.floor(1024 * max(min(c, 131072.0), -131072.0)) for c in x]))
    start = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cs = [v for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[near(v)[1]].append(v)
        cs = [[sum(col) // len(own[n]) for col in zip(*own[n], strict=True)] if own[n] else c for n, c in enumerate(cs)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], cs


def vectors(rng, n):
    heads = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    return [(k, [np.float32(c + rng.gauss(0, 0.3)).item() for c in rng.choice(heads)]) for k in range(n)]


def test_clusters_equal_brute_force(spark):
    rng = random.Random(4)
    rows = vectors(rng, 300)
    rows += [(1000 + k, rows[0][1]) for k in range(100)]  # a common vector
    rows += [(7, rows[9][1]), (None, rows[3][1]), (501, None), (502, [0.5] * 63), (503, []), (504, [None] + [0.1] * 63)]
    rows += [(505, [float("nan")] + [0.1] * 63), (506, [float("inf")] + [0.1] * 63), (507, [-0.0] * 64), (508, [3.0e38] + [0.1] * 63)]
    df = spark.createDataFrame([(i, x, "x", 1) for i, x in rows], "vec_id long, embedding array<float>, v string, cluster int").repartition(4)
    whole = centroids.whole_vectors(df, "vec_id", "embedding")
    found, cs = centroids.cluster(whole, "vec_id")
    want, want_cs = brute_clusters(rows)
    assert cs == want_cs and len({c for _, c, _ in want}) > 3
    assert sorted(map(key, found.select("vec_id", "cluster", "distance").collect())) == sorted(map(key, want))


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    rows = vectors(random.Random(5), n)
    whole = centroids.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    found, cs = centroids.cluster(whole, "vec_id")
    assert len(cs) == n and [r.distance for r in found.collect()] == [0] * n


def test_ties_and_empty_clusters(spark):
    same = [(k, [0.25] * 64) for k in range(20)] + [(50, [0.75] * 64)]  # equal first centroids: the smaller number takes all
    whole = centroids.whole_vectors(spark.createDataFrame(same, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    found, cs = centroids.cluster(whole, "vec_id")
    want, want_cs = brute_clusters(same)
    assert cs == want_cs and {(r.vec_id, r.cluster, r.distance) for r in found.collect()} == set(want)
