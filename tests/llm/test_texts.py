"""Operators on whole texts against brute force, with the defined edge cases."""

import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
import xxhash

from openbell.llm import fingerprints, language, licenses, lines, packing, suffixes, tiling, vptree
from openbell.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside: they must pass through or be ignored.
CLASHING = "doc_id long, text string, _lines string, at long, node string, fp long, place long, _items long, gone string, data string, id long"


def word(rng, n=9):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, n)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "x", 2, 3, 4, "x", "x", 5) for i, t in rows], CLASHING)


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, near copies, shared passages, blanks and nulls."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(60, 300)) for _ in range(25)]
    shared = "\n".join(prose(rng, 12) for _ in range(6))
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(100 + k, t) for k, t in enumerate(base[:6])]  # copies
    for k in range(6, 12):  # near copies
        words = base[k].split()
        words[len(words) // 2] = "changed"
        rows.append((100 + k, " ".join(words)))
    rows += [(200 + k, prose(rng, 30) + "\n" + shared + "\n" + prose(rng, 20)) for k in range(8)]
    rows += [(300, None), (301, ""), (302, " \n\n "), (303, "short"), (304, "ÀÉ é ü " * 40), (None, base[3]), (305, "ab " * 3000), (306, prose(rng, 9000))]
    return rows


# --- suffix dedup ---------------------------------------------------------------------------------------------


def brute_repeats(rows, length=100):
    seen, out = {}, {}
    data = {i: (t or "").encode() for i, t in rows}
    for i in sorted(data, key=lambda x: (x is None, x)):
        for p in range(len(data[i]) - length + 1):
            seen.setdefault(data[i][p : p + length], (i, p))
    for i, b in data.items():
        lost = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] != (i, p):
                lost[p : p + length] = True
        spans = sum(bool(lost[k]) and (k == 0 or not lost[k - 1]) for k in range(len(b)))
        out[i] = (len(b), int(lost.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~lost[:-1]]))
    return out


def test_suffix_dedup_equals_brute_force(spark, corpus):
    rng = random.Random(1)
    rows = corpus + [(400, "a" * 500), (401, "b" + "a" * 350 + "c"), (402, "ab" * 300), (403, corpus[20][1][50:400] + "|" + corpus[20][1][120:330])]
    rows += [(410 + k, prose(rng, 8) + corpus[21][1][100 : 205 + k] + prose(rng, 8)) for k in range(10)]
    got = {r[0]: tuple(r)[1:] for r in suffixes.remove_repeats(docs(spark, rows).repartition(3)).collect()}
    assert {k: (*v[:3], bytes(v[3])) for k, v in got.items()} == brute_repeats(rows)


def test_suffix_dedup_edges(spark, corpus):
    assert suffixes.remove_repeats(docs(spark, [])).count() == 0
    rows = suffixes.remove_repeats(clashing(spark, [(1, corpus[0][1]), (2, corpus[0][1])])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (2, len(corpus[0][1]))]
    twice = suffixes.remove_repeats(docs(spark, [(1, corpus[0][1])] * 2)).collect()
    assert [r.n_removed for r in twice] == [0, 0]


# --- license scan ---------------------------------------------------------------------------------------------


def test_licenses(spark):
    mit = [k for k, v in licenses.SENTENCES.items() if v in ("mit-grant", "mit-condition", "mit-warranty")]
    rows = [
        (1, "Text.\nReleased under the MIT License.\nMore."),
        (2, ". ".join(mit)), (3, ". ".join(mit[::-1])), (4, None), (5, ""),
        (6, "All rights reserved. unknown words here\nLicensed under CC BY-NC 4.0."),
        (7, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
        (1, "Text.\nReleased under the MIT License.\nMore."),
    ]
    got = {r.doc_id: (r.n_known, r.licenses, r.license) for r in licenses.scan(clashing(spark, rows)).collect()}
    assert got[1] == (1, "MIT", "MIT") and got[2] == (3, "MIT", "MIT") and got[3] == (3, "", None)
    assert got[4] == got[5] == (0, "", None)
    assert got[6] == (2, "CC-BY-NC-4.0,proprietary", "CC-BY-NC-4.0")
    assert got[7] == (2, "GPL-3.0-or-later", "GPL-3.0-or-later")
    assert licenses.scan(docs(spark, [])).count() == 0


MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE."""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_wrapped_licenses(spark):
    comment = lambda t: "\n".join(f" * {x}" for x in t.split("\n"))
    texts = [MIT, GPL, BSD, BSD3, comment(MIT), MIT.replace("\n", "\r\n"), MIT.replace("a copy\nof", "a copy\n\nof"), "All rights\nreserved", "a\nAll rights reserved\nb"]
    got = {r.doc_id: (r.n_known, r.license) for r in licenses.scan(docs(spark, list(enumerate(texts)))).collect()}
    names = ["MIT", "GPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "MIT", "MIT", None, "proprietary", "proprietary"]
    assert got == {k: (n, name) for k, (n, name) in enumerate(zip([3, 2, 3, 4, 3, 3, 2, 1, 1], names, strict=True))}


OTHERS = {
    "MPL-2.0": "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL was not distributed with this\n"
    "// file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as "
    "published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as "
    "published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
    "copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES\nWITH "
    "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF\nMERCHANTABILITY AND FITNESS. IN NO EVENT",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\n"
    "distribute this software, either in source code form or as a compiled\nbinary, for any purpose, commercial or non-commercial, and by any\nmeans.",
    "Zlib": "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\n"
    "arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and "
    "to alter it and redistribute it\nfreely, subject to the following restrictions:\n",
}


def test_more_public_licenses_and_their_sql(spark):
    import duckdb

    texts = [*OTHERS.values(), MIT, GPL, BSD, BSD3, MIT.replace("\n", "\r\n"), "a\nAll rights\nreserved..\nb", "word " * 60_000 + "\n" + MIT, None, ""]
    got = licenses.scan(docs(spark, list(enumerate(texts)))).collect()
    assert [r.license for r in sorted(got)][: len(OTHERS)] == list(OTHERS)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = con.execute(f"SELECT doc_id, n_known, sentence_ids, licenses, license FROM ({licenses.ORACLE_SQL})").fetchall()
    assert sorted(tuple(r) for r in got) == sorted(want)


# --- language -------------------------------------------------------------------------------------------------


def brute_ngrams(text):
    counts = Counter()
    for w in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        counts.update(w)
        padded = "\1" + w + "\1"
        for n in (2, 3):
            counts.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return counts


def spelled(code):
    out = ""
    while code:
        out, code = chr(code & (1 << 21) - 1) + out, code >> 21
    return out


@pytest.mark.parametrize("text", ["a", "Ab c", "  É, x2y!", "..", "日本 é", "x" * 50, "É" + chr(0x10400)])
def test_ngrams(text):
    codes, counts = language.ngrams(text)
    assert {spelled(c): n for c, n in zip(codes.tolist(), counts.tolist(), strict=True)} == brute_ngrams(text)


def brute_language(learn, text, top=300):
    total = defaultdict(Counter)
    for t, lang in learn:
        total[lang].update(brute_ngrams(t))
    order = lambda c: sorted(c, key=lambda g: (-c[g], sum(ord(x) << 21 * (len(g) - 1 - i) for i, x in enumerate(g))))[:top]
    own = order(brute_ngrams(text or ""))
    if not own or not total:
        return "und", 0.0
    best = None
    for lang in sorted(total):
        ranks = {g: k for k, g in enumerate(order(total[lang]))}
        away = sum(abs(ranks[g] - k) if g in ranks else top for k, g in enumerate(own))
        if best is None or away < best[0]:
            best = (away, lang)
    return best[1], 1 - best[0] / (top * len(own))


def test_language_equals_brute_force(spark):
    rng = random.Random(3)
    sylls = {"xx": ["ka", "to", "mi", "ré"], "yy": ["schu", "ber", "ung", "ei"], "zz": ["los", "ción", "que", "ra"]}
    make = lambda lang: " ".join("".join(rng.choice(sylls[lang]) for _ in range(rng.randint(1, 3))) for _ in range(30))
    rows = [(k, make(lang), lang) for k, lang in enumerate(["xx", "yy", "zz"] * 12)]
    rows += [(100, None, "xx"), (101, "", "yy"), (102, "123 !!", "zz"), (103, make("xx"), None), (None, make("yy"), "yy")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, round(r.lang_score, 9)) for r in language.identify(table).collect()}
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 == 0
    learn = [(t, lang) for i, t, lang in rows if t is not None and lang is not None and not held(i)]
    want = {i: brute_language(learn, t) for i, t, _ in rows}
    assert got == {i: (a, round(b, 9)) for i, (a, b) in want.items()}
    nothing = language.identify(table.where("lang IS NULL"))
    assert [(r.lang_pred, r.lang_score) for r in nothing.collect()] == [("und", 0.0)]
    assert language.identify(table.limit(0)).count() == 0


def test_language_held_out_accuracy(spark):
    from openbell.llm.common import table

    docs_ = table(spark, "/root/testdata/sf0.001", "documents")
    rows = language.identify(docs_).where(language.held_out()).select("lang", "lang_pred").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95


# --- fingerprints ---------------------------------------------------------------------------------------------


def brute_votes(text):
    sums = np.zeros(64, int)
    for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()):
        if w:
            h = xxhash.xxh64_intdigest(w.encode(), 42)
            sums += np.array([len(w) if h >> k & 1 else -len(w) for k in range(64)])
    return sum(1 << k for k in range(64) if sums[k] > 0)


def test_fingerprints_equal_brute_force(spark, corpus):
    rows = [r for r in corpus]
    got = {r.doc_id: r for r in fingerprints.compare_edits(docs(spark, rows).repartition(3)).collect()}
    order = sorted(((i if i is not None else -(1 << 63), t or "") for i, t in rows), reverse=True)
    prints = [brute_votes(t) for _, t in order]
    for k, (i, t) in enumerate(order):
        row, after = got[None if i == -(1 << 63) else i], order[(k + 1) % len(order)][1]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]
        assert row.n_chars == len(t) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == f"{prints[k]:016x}" and row.edited_fingerprint == f"{brute_votes(edited):016x}"
        assert row.near_next == 1 - (prints[k] ^ prints[(k + 1) % len(order)]).bit_count() / 64
        near = {p for p in prints if 0 < (p ^ prints[k]).bit_count() <= 3}
        assert row.n_near == (len(near) if i % 20 == 0 else None)


def test_fingerprint_edges(spark):
    assert fingerprints.compare_edits(docs(spark, [])).count() == 0
    one = fingerprints.compare_edits(clashing(spark, [(7, "abc def")])).collect()
    assert [(r.doc_id, r.near_edited, r.near_next) for r in one] == [(7, 1.0 - (brute_votes("abc def") ^ brute_votes("abc dab")).bit_count() / 64, 1.0)]
    assert fingerprints.compare_edits(docs(spark, [(7, "abc")] * 3 + [(8, "x")])).count() == 2


def test_search_finds_all_within_radius(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = {x for b in base for x in [b, *(b ^ sum(1 << k for k in rng.sample(range(64), n)) for n in (1, 2, 3, 3, 4))]}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    table = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    asked = spark.createDataFrame([(signed(x),) for x in base], "fp long")
    for radius in (2, 3):
        got = {(r[0], r[1], r[2]) for r in fingerprints.search(asked, table, radius).collect()}
        assert got == {(signed(q), signed(x), (q ^ x).bit_count()) for q in base for x in fps if (q ^ x).bit_count() <= radius}


# --- near dedup -----------------------------------------------------------------------------------------------


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(500, k) for k in range(501, 560)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = groups({x for e in edges for x in e}, edges)
    assert got == {n: r for n, r in want.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("radius,shard", [(2, 40), (3, 40), (2, 10_000)])
def test_tree_keeps_every_connection(spark, radius, shard):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(150)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.choice((0, 1, 2, 2, 3, 5)))) for b in base for _ in range(4)})
    table = spark.createDataFrame([(k, vptree._signed(x)) for k, x in enumerate(fps)], "node long, fp long")
    got = [tuple(r) for r in vptree.links(table, radius, shard=shard).collect()]
    near = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= radius]
    assert all((fps[a] ^ fps[b]).bit_count() <= radius for a, b in got)
    assert groups(range(len(fps)), got) == groups(range(len(fps)), near)


def test_shard_of_a_dense_cluster_returns_a_forest():
    rng = np.random.default_rng(1)
    points = np.unique(np.uint64(1) << rng.integers(0, 20, (3000, 2), dtype=np.uint64)).astype(np.uint64)
    points = np.unique(np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 24, (3000, 3), dtype=np.uint64), axis=1))
    pairs = vptree.shard_links(points, points[:, None], 2, leaf=64)
    near = [(a, b) for a in range(len(points)) for b in range(a) if (int(points[a]) ^ int(points[b])).bit_count() <= 2]
    assert groups(range(len(points)), pairs) == groups(range(len(points)), near)
    assert len(pairs) < len(near) / 3


def test_dense_shards_are_dealt_out_as_pairs_of_blocks(spark):
    """All fingerprints near one another: the tree cannot part them, blocks of at most 100 do."""
    rng = np.random.default_rng(2)
    points = np.unique(np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 24, (1500, 3), dtype=np.uint64), axis=1))
    table = spark.createDataFrame([(k, int(x)) for k, x in enumerate(points)], "node long, fp long")
    got = [tuple(r) for r in vptree.links(table, 2, shard=64, block=200).collect()]
    near = [(a, b) for a in range(len(points)) for b in range(a) if (int(points[a]) ^ int(points[b])).bit_count() <= 2]
    assert set(got) <= {x for a, b in near for x in ((a, b), (b, a))}
    assert len(points) > 800 and groups(range(len(points)), got) == groups(range(len(points)), near)


def test_near_duplicates_equal_brute_force(spark, corpus):
    rows = corpus + [(501, "Same  words here twice"), (502, "same words\there twice"), (503, "?!")]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in vptree.near_duplicates(docs(spark, rows).repartition(3)).collect()}
    fps = {i: vptree.simhash(vptree.shingles(vptree.words(t or ""), 3)) for i, t in rows}

    def plain(text):
        w = regex.findall(r"[^\x20\x09-\x0d]+", regex.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    assert fps == {i: plain(t or "") for i, t in rows}
    ids = [i for i in fps if i is not None]
    want = groups(ids, [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    assert {i: got[i] for i in ids} == {i: (f"{fps[i]:016x}", want[i]) for i in ids}
    assert got[None] == (f"{fps[3]:016x}", want[3])
    assert vptree.near_duplicates(docs(spark, [])).count() == 0


def test_keep_one(spark, corpus):
    kept = sorted(r.doc_id for r in vptree.keep_one(clashing(spark, [r for r in corpus if r[0] is not None])).collect())
    texts = {i: t or "" for i, t in corpus if i is not None}
    ids = sorted(texts)
    sets = {i: set(vptree.shingles(vptree.words(texts[i]), 5)) for i in ids}
    alike = lambda a, b: not (sets[a] or sets[b]) or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    want = groups(ids, [(a, b) for a in ids for b in ids if a < b and alike(a, b)])
    assert kept == sorted(set(want.values()))
    same = [(1, "one two three"), (1, "one two three"), (None, "one  two three"), (None, None)]
    assert sorted(vptree.keep_one(docs(spark, same)).collect(), key=str)[0].doc_id == 1
    assert vptree.keep_one(docs(spark, same)).count() == 2
    assert vptree.keep_one(docs(spark, [])).count() == 0


def test_keep_one_finds_appended_cut_and_inserted_blocks(spark):
    rng = random.Random(12)
    rows, want = [], set()
    for k in range(90):
        base = prose(rng, 220).split()
        block, at = prose(rng, 50).split(), rng.randrange(20, 200)
        near = [base + block, base[:180], base[:at] + block[:42] + base[at:]][k % 3]
        assert 0.8 <= vptree.jaccard(" ".join(base), " ".join(near), 5) <= 0.86
        rows += [(k, " ".join(base)), (1000 + k, " ".join(near))]
        want.add(k)
    assert {r.doc_id for r in vptree.keep_one(docs(spark, rows)).collect()} == want


def test_keep_one_compares_texts_of_equal_word_sets(spark):
    """Many texts over few words: a failed comparison with one text leaves the others to be tried."""
    rng = random.Random(13)
    vocabulary = [word(rng) for _ in range(30)]
    base = [[rng.choice(vocabulary) for _ in range(500)] for _ in range(40)]
    rows = [(k, " ".join(t)) for k, t in enumerate(base)]
    rows += [(1000 + k, " ".join([*t[:250], vocabulary[0] + vocabulary[1], *t[251:]])) for k, t in enumerate(base)]
    assert {r.doc_id for r in vptree.keep_one(docs(spark, rows)).collect()} == set(range(40))


def test_keep_one_goes_through_fingerprints_and_tree(spark, monkeypatch):
    """Without any MinHash key the SimHash links of the tree still find copies; each link is checked."""
    rng = random.Random(19)
    base = [prose(rng, 400) for _ in range(30)]
    rows = [(k, t) for k, t in enumerate(base)] + [(1000 + k, f"{t} {word(rng)}") for k, t in enumerate(base)]
    bits = lambda t: vptree.simhash(vptree.shingles(vptree.words(t), 3))
    texts = dict(rows)
    linked = {k for k in range(30) if (bits(texts[k]) ^ bits(texts[1000 + k])).bit_count() <= 2}
    assert len(linked) > 20
    often = "buy it now or never " * 400  # equal bits, texts unlike
    rows += [(2000 + k, f"{often} {prose(rng, 600)} {often}") for k in range(2)]
    texts = dict(rows)
    apart = vptree.jaccard(texts[2000], texts[2001], 5)
    assert apart < 0.8 and (bits(texts[2000]) ^ bits(texts[2001])).bit_count() <= 2
    shared, asked, through = vptree._shared_keys, [], vptree.links
    monkeypatch.setattr(vptree, "_shared_keys", lambda nodes: shared(nodes).limit(0))
    monkeypatch.setattr(vptree, "links", lambda nodes, radius, *a, **k: asked.append(radius) or through(nodes, radius, *a, **k))
    kept = {r.doc_id for r in vptree.keep_one(docs(spark, rows)).collect()}
    assert asked == [2] and kept == {i for i, _ in rows} - {1000 + k for k in linked}


def test_groups_try_every_centre(spark):
    """One key holds texts with and without links: none is linked to the first one."""
    rng = random.Random(14)
    base = [prose(rng, 60) for _ in range(7)]
    texts = [base[0], *[f"{t} {x}" for x in ("a", "b", "c") for t in base[1:]]]
    live = spark.createDataFrame([(5, k, len(t.split()) - 4) for k, t in enumerate(texts)], "key long, nid long, n long")
    sets = [(k, vptree.shingle_hashes(t, 5).tolist()) for k, t in enumerate(texts)]
    roots = vptree._groups(live, spark.createDataFrame(sets, "nid long, sh array<long>"), 0.8)
    assert {r.nid: r.root for r in roots.collect()} == {k: (k - 1) % 6 + 1 for k in range(1, 19)}


def test_groups_of_a_dense_key_in_blocks(spark, monkeypatch):
    """Edited copies of one text, compared in many small blocks: the groups of brute force, from forests of links."""
    rng = random.Random(18)
    base = prose(rng, 150).split()
    texts = []
    for _ in range(120):
        t = list(base)
        for at in rng.sample(range(150), rng.randint(1, 9)):
            t[at] = word(rng)
        texts.append(" ".join(t))
    sets = [vptree.shingle_hashes(t, 5) for t in texts]
    alike = lambda a, b: len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))
    want = groups(list(range(120)), [(a, b) for a in range(120) for b in range(a) if alike(a, b)])
    assert 2 < len(set(want.values())) < 100
    table = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(sets)], "nid long, sh array<long>")
    live = spark.createDataFrame([(key, k, len(x)) for key in (5, 6) for k, x in enumerate(sets) if key == 5 or k % 2], "key long, nid long, n long")
    for size in (200_000, 3000, 700):
        monkeypatch.setattr(vptree, "BLOCK_SHINGLES", size)
        roots = {r.nid: r.root for r in vptree._groups(live, table, 0.8).collect()}
        assert {k: roots.get(k, k) for k in range(120)} == want
    links = vptree.block_links(sets, np.arange(120), np.zeros(120, np.int64), 0.8)
    assert len(links) == 120 - len(set(want.values()))  # a forest
    assert vptree.block_links([], np.zeros(0, np.int64), np.zeros(0, np.int64), 0.8) == []


# --- packing --------------------------------------------------------------------------------------------------


def exact_bins(lengths, capacity):
    """Fewest bins by trying all placements (small cases)."""
    best = [len(lengths)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + lengths[k] <= capacity:
                bins[j] += lengths[k]
                place(k + 1, bins)
                bins[j] -= lengths[k]
        place(k + 1, [*bins, lengths[k]])

    place(0, [])
    return best[0]


def test_bounds_never_exceed_the_optimum():
    rng = np.random.default_rng(6)
    for _ in range(60):
        lengths = rng.integers(1, 21, rng.integers(1, 9))
        best = exact_bins(sorted(lengths.tolist(), reverse=True), 20)
        bins, offsets, fill = packing.best_fit_decreasing(lengths, 20)
        assert packing.lower_bound(lengths, 20) <= best <= len(fill)
        for b in range(len(fill)):
            spans = sorted((o, o + n) for n, o, k in zip(lengths.tolist(), offsets.tolist(), bins.tolist(), strict=True) if k == b)
            assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False)) and spans[-1][1] == fill[b] <= 20
    assert packing.lower_bound(np.array([11] * 5), 20) == 5


def test_words_encode_as_whole_texts(corpus):
    texts = [t or "" for _, t in corpus]
    texts += ["a's it's !'' don't 12.5 ½ x²", "<|endoftext|> hi<|startoftext|>you", "ÀÉ ß÷×", "\x1c a\x85b\tc\r\nd", "日本語 é", "'S 'LL İstanbul ŉ", "a" * 300]
    encoder = packing.WordEncoder(packing.default_tokenizer(), limit=50)  # small: generations turn over
    for t, e in zip(texts, encoder.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == e.ids


def test_packing_is_whole_and_tight(spark, corpus):
    capacity = 128
    got = packing.pack(packing.pieces(docs(spark, corpus), packing.default_tokenizer(), capacity), capacity, group_rows=40, release=3).collect()
    encoder = packing.WordEncoder(packing.default_tokenizer())
    want = []
    for i, t in corpus:
        ids = [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(bins) <= packing.lower_bound(np.array([w[3] for w in want]), capacity) + 2
    assert packing.pack_documents(docs(spark, [])).count() == 0
    assert packing.pack_documents(clashing(spark, [(1, None), (1, None)])).count() == 2


# --- tiling ---------------------------------------------------------------------------------------------------


def brute_tiles(doc, item, least):
    """Greedy string tiling by comparing all places."""
    used_d, used_i, total = set(), set(), 0
    for n in range(min(len(doc), len(item)), least - 1, -1):
        for a in range(len(item) - n + 1):
            for b in range(len(doc) - n + 1):
                if doc[b : b + n] == item[a : a + n] and not used_i & set(range(a, a + n)) and not used_d & set(range(b, b + n)):
                    used_i |= set(range(a, a + n))
                    used_d |= set(range(b, b + n))
                    total += n
    return total


def test_tiling_equals_brute_force(spark):
    rng = random.Random(8)
    items = [(k, " ".join(rng.choice("abcdefghij") + rng.choice("xyz") for _ in range(rng.randint(3, 25)))) for k in range(12)]
    items += [(90, None), (91, "..."), (92, "Solo, word")]
    rows = []
    for k in range(40):
        t = prose(rng, 15).split()
        for i in rng.sample(range(12), 2):
            w = items[i][1].split()
            cut = rng.randint(1, len(w))
            t += [*w[cut:], "between", *w[:cut]] if rng.random() < 0.5 else w[: cut + 3]
        rows.append((k, " ".join(t)))
    rows += [(100, None), (101, ""), (102, items[0][1].upper()), (103, "a solo WORD here"), (102, items[0][1].upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (2_000_000, 100):
        got = tiling.contaminations(clashing(spark, rows), bench, max_broadcast=limit)
        found = {(r.doc_id, x.item_id): x.tiled for r in got.collect() for x in r._items}
        want = {}
        for i, t in rows:
            for k, text in items:
                doc, item = tiling.tokens(t or ""), tiling.tokens(text or "")
                n = brute_tiles(doc, item, min(5, len(item))) if item else 0
                if item and n >= 0.5 * len(item) and (len(item) >= 5 or n == len(item)):
                    want[i, k] = n
        assert found == want and len(want) > 20
    assert tiling.contaminations(docs(spark, []), bench).count() == 0
    assert all(not r._items for r in tiling.contaminations(docs(spark, rows), bench.limit(0)).collect())


@pytest.mark.parametrize("limit", [2_000_000, 60])
def test_tiling_searches_every_row_of_the_benchmark(spark, limit):
    rng = random.Random(17)
    a, b, c, d = (prose(rng, 12) for _ in range(4))
    bench = spark.createDataFrame([(0, a), (0, b), (None, c), (None, d), (0, a)], "item_id long, text string")
    rows = [(k, f"{prose(rng, 5)} {t} {prose(rng, 5)}") for k, t in enumerate([a, b, c, d, prose(rng, 9), f"{a} {b} {d}"])]
    got = {r.doc_id: sorted((x.item_id for x in r._items), key=str) for r in tiling.contaminations(docs(spark, rows), bench, max_broadcast=limit).collect()}
    assert got == {0: [0], 1: [0], 2: [None], 3: [None], 4: [], 5: [0, 0, None]}


def test_tiles_equal_the_plain_search():
    rng = random.Random(5)
    for _ in range(200):
        letters = rng.choice((2, 3, 6))
        doc, item = ([rng.randint(1, letters) for _ in range(rng.randint(0, 40))] for _ in range(2))
        least = rng.randint(1, 5)
        found = tiling.tiles(np.array(doc, np.uint64), np.array(item, np.uint64), least)
        assert sum(n for *_, n in found) == brute_tiles(doc, item, least)
        assert all(doc[a : a + n] == item[b : b + n] for a, b, n in found)


@pytest.mark.parametrize("limit", [2_000_000, 100])
def test_very_long_texts_are_tiled_whole(spark, limit):
    rng = random.Random(6)
    item = [f"w{rng.randint(0, 3000)}" for _ in range(800)]
    long = [f"v{rng.randint(0, 3000)}" for _ in range(20_000)]
    few = long[:500] + item[10:18] + long[500:]
    moved = long[:9000] + item[400:] + long[9000:12_000] + item[:400] + long[12_000:]
    matcher, start = tiling.Matcher([(1, " ".join(item))], 5, 0.5), time.time()
    assert matcher.judge(" ".join(few)) == [] and time.time() - start < 1
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: [(x.item_id, x.tiled) for x in r._items] for r in tiling.contaminations(docs(spark, [(1, " ".join(few)), (2, " ".join(moved))]), bench, max_broadcast=limit).collect()}
    assert got == {1: [], 2: [(1, 800)]}


# --- line dedup -----------------------------------------------------------------------------------------------


def brute_lines(rows):
    """Chunks cut as documented; a chunk of two lines or more stays only where it stands first."""
    chunks = {}
    for key in {(i, t or "") for i, t in rows}:
        ends, part, at, parts = [], [], 0, []
        h = [int(hashlib.md5(x.encode()).hexdigest()[:15], 16) % lines.PRIME for x in key[1].split("\n")]
        rolled = [(x + lines.BASE * (h[k - 1] if k else 0)) % lines.PRIME for k, x in enumerate(h)]
        for k, line in enumerate(key[1].split("\n")):
            part.append(line)
            if 1 <= k <= len(h) - 3 and rolled[k] < rolled[k - 1] and rolled[k] <= rolled[k + 1]:
                parts.append((at, part))
                at, part = k + 1, []
        if part:
            parts.append((at, part))
        chunks[key] = parts
    first = {}
    order = lambda x: (x[0] is not None, x[0] or 0, x[1])
    for key, parts in chunks.items():
        for at, part in parts:
            if len(part) > 1 and "".join(part).strip(" \t\r"):
                body = "\n".join(part)
                if body not in first or order((key[0], at)) < order(first[body]):
                    first[body] = (key[0], at)
    out = {}
    for key, parts in chunks.items():
        keep = [p for at, p in parts if first.get("\n".join(p), (key[0], at)) == (key[0], at)]
        out[key] = "\n".join(x for p in keep for x in p) if len(keep) < len(parts) else key[1]
    return out


def test_line_dedup_equals_brute_force(spark, corpus):
    rng = random.Random(9)
    pool = [prose(rng, 3) for _ in range(12)]
    rows = [(1000 + k, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 25)))) for k in range(60)]
    rows += corpus + [(700, "\n" * 40), (701, "\n" * 40), (702, "x\n" * 900)]
    got = lines.dedup_lines(docs(spark, rows).repartition(3)).collect()
    want = brute_lines(rows)
    texts = dict(rows)
    assert {r.doc_id: r.text or "" for r in got} == {i: t for (i, _), t in want.items()}
    assert len(got) == len(rows) and sum(r._gone_lines > 0 for r in got) > 10
    assert all(r._n_lines == (texts[r.doc_id] or "").count("\n") + 1 for r in got)


def test_line_dedup_edges(spark):
    assert lines.dedup_lines(docs(spark, [])).count() == 0
    text = "\n".join("line %d of a text" % k for k in range(30))
    got = lines.dedup_lines(clashing(spark, [(1, text), (1, text), (2, text), (3, None)]))
    assert got.columns[:11] == [c.split()[0] for c in CLASHING.split(", ")]
    rows = sorted((r.doc_id, r.text) for r in got.collect())
    assert rows[0] == rows[1] == (1, text) and len(rows[2][1]) < 40 and rows[3] == (3, None)


def test_line_chunks_of_copies_and_planted_passages(spark):
    rng = random.Random(21)
    own = lambda n: "\n".join(prose(rng, 5) for _ in range(n))
    texts = [own(n) for n in range(2, 40)]  # copies of texts of several lines vanish whole
    got = lines.dedup_lines(docs(spark, [(1000 * c + k, t) for c in range(3) for k, t in enumerate(texts)])).collect()
    assert all((r.text == "") == (r.doc_id >= 1000) and r._gone_lines == (r._n_lines if r.doc_id >= 1000 else 0) for r in got)
    shared = [own(20) for _ in range(40)]
    rows = [(100 * c + k, "\n".join([own(7), t, own(6)])) for c in range(2) for k, t in enumerate(shared)]
    got = {r.doc_id: r for r in lines.dedup_lines(docs(spark, rows)).collect()}
    assert all(got[k]._gone_lines == 0 and 0 < got[100 + k]._gone_lines <= 20 for k in range(40))
    assert sum(got[100 + k]._gone_lines for k in range(40)) > 40 * 20 * 0.7  # all but the edges
    for k in range(40):  # nothing but lines of the passage goes
        assert set(rows[40 + k][1].split("\n")) - set(got[100 + k].text.split("\n")) <= set(shared[k].split("\n"))


def brute_passages(rows):
    """Lines left of every (doc_id, text): pairs of neighbouring lines that are not blank stay where they stand first."""
    place, lost = {}, {}
    h = lambda x: hashlib.md5("\n".join(x).encode()).digest()
    for i, t in sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0] is not None, x[0] or 0)):
        shown = [x for x in t.split("\n") if x.strip(" \t\r")]
        out = lost[i, t] = set()
        for k in range(1, len(shown)):
            first = place.setdefault(h(shown[k - 1 : k + 1]), (i, t, k))
            if first != (i, t, k):
                out |= {k} if first == (i, t, k - 1) else {k - 1, k}
        lost[i, t] = [x for k, x in enumerate(shown) if k not in out]
    return lost


def test_passages_equal_brute_force(spark, corpus):
    rng = random.Random(15)
    planted = [[prose(rng, rng.randint(8, 30)) for _ in range(n)] for n in range(2, 8)]
    rows = []
    for k in range(40):
        own = [prose(rng, 6) for _ in range(5)]
        at = rng.randint(0, 5)
        rows.append((1000 + k, "\n".join([*own[:at], *planted[k % 6], *own[at:]])))
    pool = [prose(rng, 3) for _ in range(6)]
    rows += [(2000 + k, "\n".join(rng.choice([*pool, "", " \t"]) for _ in range(rng.randint(1, 25)))) for k in range(30)]
    rows += [(700, "\n" * 40), (702, "x\n" * 900), (703, None), (1000, rows[0][1])] + corpus
    got = lines.dedup_passages(docs(spark, rows).repartition(3)).collect()
    want = brute_passages(rows)
    left = defaultdict(list)
    for (i, _), x in want.items():
        left[i].append(x)
    assert len(got) == len(rows)
    assert all([x for x in (r.text or "").split("\n") if x.strip(" \t\r")] in left[r.doc_id] for r in got)
    texts = {r.doc_id: r.text for r in got}
    for k in range(6, 40):  # planted passages go whole, wherever they stand, and nothing else
        assert not set(texts[1000 + k].split("\n")) & set(planted[k % 6]) and texts[1000 + k].count("\n") == 4
    assert lines.dedup_passages(docs(spark, [])).count() == 0


def test_passages_keep_blank_lines_and_columns(spark):
    text = "\n a\n\nb\nc\n\n\nd \n"
    got = {r.doc_id: (r.text, r._gone_lines) for r in lines.dedup_passages(clashing(spark, [(1, text), (2, "b\n\n\nc\nnew\n"), (3, None)])).collect()}
    assert got == {1: (text, 0), 2: ("new\n", 4), 3: (None, 0)}
    assert lines.dedup_passages(clashing(spark, [(1, text)])).columns[:11] == [c.split()[0] for c in CLASHING.split(", ")]


def brute_chunks_and_passages(rows):
    """Text left of every (doc_id, text): lines of repeated chunks and of repeated pairs go, both judged on the input."""
    chunks, pairs, left = {}, {}, {}
    for i, t in sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0] is not None, x[0] or 0)):
        body, lost = t.split("\n"), set()
        h = [int(hashlib.md5(x.encode()).hexdigest()[:15], 16) % lines.PRIME for x in body]
        rolled = [(x + lines.BASE * (h[k - 1] if k else 0)) % lines.PRIME for k, x in enumerate(h)]
        ends = [k + 1 for k in range(1, len(h) - 2) if rolled[k] < rolled[k - 1] and rolled[k] <= rolled[k + 1]]
        for a, b in zip([0, *ends], [*ends, len(h)]):
            if b - a > 1 and "".join(body[a:b]).strip(" \t\r") and chunks.setdefault("\n".join(body[a:b]), (i, a)) != (i, a):
                lost |= {*range(a, b)}
        at = [k for k, x in enumerate(body) if x.strip(" \t\r")]
        for k in range(1, len(at)):
            first = pairs.setdefault((body[at[k - 1]], body[at[k]]), (i, k))
            if first != (i, k):
                start = at[k] if first == (i, k - 1) else at[k - 1] if k > 1 else 0
                lost |= {*range(start, at[k + 1] if k + 1 < len(at) else len(body))}
        left[i] = "\n".join(x for k, x in enumerate(body) if k not in lost), len(lost)
    return left


def test_chunks_and_passages_go_together(spark, corpus):
    rng = random.Random(23)
    pool = [prose(rng, 3) for _ in range(10)]
    rows = [(1000 + k, "\n".join(rng.choice([*pool, "", "", " \t"]) for _ in range(rng.randint(1, 25)))) for k in range(80)]
    rows += [(2000 + k, f"{pool[k % 5]}\n\n") for k in range(10)] + [(3000, "\n\n"), (3001, "\n\n"), (1000, rows[0][1])] + corpus
    got = lines.dedup_lines(docs(spark, rows).repartition(3), passages=True).collect()
    want, texts = brute_chunks_and_passages(rows), dict(rows)
    assert len(got) == len(rows) and all((r.text or "", r._gone_lines) == want[r.doc_id] for r in got)
    assert all(r.text == texts[r.doc_id] for r in got if not r._gone_lines)
    assert all(r._n_lines == (texts[r.doc_id] or "").count("\n") + 1 for r in got)
    alone = {r.doc_id: r._gone_lines for r in lines.dedup_passages(docs(spark, rows)).collect()}
    more = {r.doc_id for r in got if r._gone_lines > alone[r.doc_id]}  # what passages alone leave
    assert len(more) > 10 and more <= {r.doc_id for r in got if r._gone_chunks}
    assert lines.dedup_lines(docs(spark, []), passages=True).count() == 0
    columns = lines.dedup_lines(clashing(spark, [(1, "a\nb")]), passages=True).columns
    assert columns == [*(c.split()[0] for c in CLASHING.split(", ")), "_n_lines", "_gone_lines", "_gone_chunks"]


def test_no_line_is_lost_everywhere(spark):
    """Texts of one or no doc_id: chunks and passages agree on which of them stands first."""
    rng = random.Random(24)
    pool = [prose(rng, 2) for _ in range(30)]
    rows = [(rng.choice([1, 2, None]), "\n".join(rng.choice([*pool, "", ""]) for _ in range(rng.randint(2, 30)))) for _ in range(120)]
    got = lines.dedup_lines(docs(spark, rows), passages=True).collect()
    given, left = ({x for t in texts for x in t.split("\n")} - {""} for texts in ([t for _, t in rows], [r.text for r in got]))
    assert given == left and sum(r._gone_lines for r in got) > 100
