"""URL rules, archives, the pipeline, and registered queries against their SQL."""

import hashlib
import itertools
import random
from pathlib import Path

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from openbell.llm import packing, registry, tiling, urls, vptree, warc
from openbell.session import shared_dir

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# --- urls -----------------------------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "HTTP://Ex.ORG", "https://example.org/es/1?x=1#y", "https://EXAMPLE.org/en/12", "https://a.example.org/en/2",
    "https://example.org/en/2", "http://org/", "http://org", "https://x.com/fr/9.html", "https://com/de/", "https://xcom/de/", "ftp://u@h.com:80/de/?q",
    "https://h.com/de/\n?q=1", "://example.org/es/?z", "a://b://c.org/", "https://h.net?x#://y", "https://É.com/de/é",
]


def brute_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    return host, tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]


def brute_rule(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, "allow")


def test_fixed_rules(spark):
    pages = spark.createDataFrame([(k, u, "h", "p") for k, u in enumerate(URLS)], "page_id long, url string, host string, _tokens string")
    labelled = spark.createDataFrame([], "url string, blocked boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, labelled).collect()}
    want = {}
    for k, u in enumerate(URLS):
        host, path = brute_split(u)
        want[k] = (host, path, *brute_rule(host, path))
    assert got == want
    assert urls.judge(pages.limit(0), labelled).count() == 0


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        host = rng.choice(["win", "pay", "news", "blog"])
        lang = rng.choice(["en", "xx", "it"])
        query = rng.choice(["", "?ref=ad", "?page=3"])
        bad = (host == "win" and lang == "xx") or (query == "?ref=ad" and host == "pay")
        rows.append((f"https://{host}.site.net/{lang}/{rng.randrange(99)}{query}", bad if rng.random() < 0.95 else not bad))
    table = spark.createDataFrame(rows, "url string, blocked boolean")
    sets = table.select(urls.tokens(F.col("url")).alias("tokens"), "blocked").collect()
    rules = {}
    for n in range(1, 7):
        for combo in {c for r in sets for c in itertools.combinations(r.tokens, n)}:
            held = [r.blocked for r in sets if set(combo) <= set(r.tokens)]
            # a combination is frequent with the label
            if sum(held) >= 20 and sum(held) / len(held) >= 0.8:
                rules[combo] = sum(held) / len(held)
    least = {c: v for c, v in rules.items() if not any(set(x) == set(c) - {t} for t in c for x in rules)}
    mined = urls.mine(table.select(urls.tokens(F.col("url")).alias("tokens"), "blocked"))
    assert {tuple(r.antecedent): round(r.confidence, 9) for r in mined.collect()} == {c: round(v, 9) for c, v in least.items()}
    assert least
    judged = urls.judge(table.select("url"), table).collect()
    tokens = {r.url: set(r.tokens) for r in table.select("url", urls.tokens(F.col("url")).alias("tokens")).collect()}
    assert len(judged) == len(rows)
    assert all(r.mined == any(set(c) <= tokens[r.url] for c in least) for r in judged)
    assert {r.verdict for r in judged} == {"allow", "block"}


def test_urls_with_many_common_parts_are_mined_as_one(spark):
    """25 parameters that only blocked urls have: 2 ** 25 frequent sets, one class."""
    query = "&".join(f"p{chr(97 + k)}=x" for k in range(25))
    rows = [(f"https://a.site.net/en/{k}?{query}&pa=x", True) for k in range(25)] + [(f"https://a.site.net/en/{k}", False) for k in range(200)]
    table = spark.createDataFrame(rows, "url string, blocked boolean")
    new = spark.createDataFrame([("https://b.net/1?ph=x",), ("https://b.net/1?pzz=x",), (f"https://b.net/?{query}" + "&z=1" * 3000,)], "url string")
    assert [r.mined for r in urls.judge(new, table).sort(F.length("url"), "url").collect()] == [True, False, True]
    classes = urls.token_classes(table.select(urls.tokens(F.col("url")).alias("tokens")))
    assert classes.where("head = 'query:pa=x'").count() == 25


# --- warc -----------------------------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    rng = random.Random(4)
    big = "é" * 700
    rows = [(k, f"http://x/{k}\r\n%0A", "".join(rng.choice("ab\r\nWARC/1.1 é") for _ in range(rng.randint(0, 4000)))) for k in range(60)]
    rows += [(100, "u", big), (101, None, big), (102, "u", big), (102, "u", big), (None, "u", big), (103, "u", "x" * 999), (104, "u", "x" * 999)]
    rows += [(105, "u", None), (106, "u", ""), (107, "u", "y" * 300_000), (None, None, "z" * 1000)]
    pages = spark.createDataFrame([(a, b, c, 1) for a, b, c in rows], "page_id long, url string, html string, digest int").repartition(3)
    path = shared_dir(spark, "warc-test")
    index = warc.write_bundles(warc.records(pages), path, frame_bytes=10_000, bundle_bytes=20_000)
    got = warc.read_bundles(index, path, payloads=True).collect()
    want = []
    for page_id, url, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        copy = len(data) >= 1000 and same and max(same) != page_id
        want.append((page_id, url, "revisit" if copy else "response", len(data), hashlib.sha1(data).hexdigest(), max(same) if copy else None, None if copy else data))
    assert sorted(map(str, want)) == sorted(str((*tuple(r)[:6], None if r.payload is None else bytes(r.payload))) for r in got)
    files = index.select("file").distinct().count()
    assert files > 3 and index.groupBy("file", "frame").count().count() > files
    ids = spark.createDataFrame([(107,), (5,), (999,)], "page_id long")
    assert {r.page_id: len(r.payload) for r in warc.lookup(index, path, ids).collect()} == {107: 300_000, 5: len(rows[5][2].encode())}


def test_bundles_are_plain_zstandard(spark):
    """The frames and the skippable footer decompress as one stream, and any record starts where the index says."""
    import zstandard

    pages = spark.createDataFrame([(k, "u", "page %d " % k * 200) for k in range(50)], "page_id long, url string, html string")
    path = shared_dir(spark, "warc-test")
    index = warc.write_bundles(warc.records(pages.coalesce(1)), path, frame_bytes=5000)
    rows = index.collect()
    (name,) = {r.file for r in rows}
    folder = Path(path.removeprefix("file:"))
    with (folder / name).open("rb") as f:
        plain = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert plain.count(b"WARC-Record-ID") == 50
    store, inner = warc._open_store(path)
    with store.open_input_file(f"{inner}/{name}") as f:
        seeks = warc.seek_table(f)
    starts = list(itertools.accumulate((s[2] for s in seeks), initial=0))
    for r in rows:
        at = starts[r.frame] + r.record_offset
        assert warc.parse_record(plain[at : at + r.record_length])[0][0] == r.page_id
    assert warc.write_bundles(warc.records(pages.limit(0)), shared_dir(spark, "warc-test")).count() == 0


def every_record(plain):
    """Records of an archive by the format alone: (headers, block)."""
    at, out = 0, []
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        version, *lines = plain[at:end].decode().split("\r\n")
        assert version == "WARC/1.1"
        head = dict(x.split(": ", 1) for x in lines)
        start = end + 4
        stop = start + int(head["Content-Length"])
        assert plain[stop : stop + 4] == b"\r\n\r\n"
        out.append((head, plain[start:stop]))
        at = stop + 4
    return out


def test_archives_are_valid_for_any_reader(spark):
    """Mandatory headers, unique ids, revisits that name a stored response."""
    import zstandard

    big = "x" * 1200
    rows = [(1, "u", big), (2, "u", big), (3, "u", "a"), (3, "u", "a"), (3, "v", "b"), (None, "u", big), (None, "u", big), (4, "u", None), (2, "w", "c")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, again string")
    path = shared_dir(spark, "warc-test")
    index = warc.write_bundles(warc.records(pages), path, frame_bytes=3000, date="2020-02-03T04:05:06Z", info="software: s\noperator: o")
    files = [r.file for r in index.select("file").distinct().collect()]
    found = []
    for name in files:
        with (Path(path.removeprefix("file:")) / name).open("rb") as f:
            records = every_record(zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read())
        assert records[0][0]["WARC-Type"] == "warcinfo" and records[0][0]["WARC-Filename"] == name
        assert records[0][1] == b"software: s\r\noperator: o\r\n"
        found += records
    assert {h["WARC-Date"] for h, _ in found} == {"2020-02-03T04:05:06Z"}
    ids = [h["WARC-Record-ID"] for h, _ in found]
    assert len(ids) == len(set(ids)) == len(rows) + len(files) and all(i.startswith("<urn:") for i in ids)
    revisits = [h for h, _ in found if h["WARC-Type"] == "revisit"]
    stored = {h["WARC-Record-ID"].removesuffix(">") for h, _ in found if h["WARC-Type"] == "response"}
    assert len(revisits) == 3
    assert all(any(s.startswith(h["WARC-Refers-To"].removesuffix(">")) for s in stored) for h in revisits)
    assert warc.read_bundles(index, path).count() == len(rows)


# --- pipeline -------------------------------------------------------------------------------------------------


def word(rng):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    clean = [(k, " ".join(word(rng) for _ in range(80)), "xx") for k in range(30)]
    item = " ".join(word(rng) for _ in range(20))
    chunk = "\n".join(" ".join(word(rng) for _ in range(6)) for _ in range(12))
    rows = list(clean)
    rows += [(100, clean[0][1], "xx"), (101, clean[1][1].replace(clean[1][1].split()[40], "other"), None)]
    rows += [(110, f"{clean[2][1][:90]} {item} end", "xx"), (111, None, "xx"), (112, "12 34", "xx"), (113, "", None), (None, clean[4][1], "xx")]
    rows += [(120 + k, f"{' '.join(word(rng) for _ in range(40))}\n{chunk}", "xx") for k in range(3)]
    path = tmp_path_factory.mktemp("corpus")
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or ""), 7, "r") for i, t, lang in rows], DOCS + ", _items int, row string")
    docs.repartition(3).write.parquet(f"file://{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"file://{path}/benchmark.parquet")
    return f"file://{path}", rows, item, chunk


def test_stages(spark, folder, tmp_path):
    sf, rows, item, chunk = folder
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = sorted(docs.columns), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"file://{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"file://{tmp_path}/{name}")
        seen[name] = (before.collect(), docs.collect())
        assert name == "packing" or sorted(docs.columns) == columns
    ids = lambda name: {r.doc_id for r in seen[name][1]}
    given = {i for i, *_ in rows}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_dedup", "decontaminate", "packing"]
    assert ids("language") == given - {111, 112, 113}
    texts = {r.doc_id: r.text for r in seen["line_dedup"][1]}
    assert ids("line_dedup") == ids("language") and len(texts[121]) < len(dict((r[0], r[1]) for r in rows)[121])
    assert all(r.n_chars == len(r.text) for r in seen["line_dedup"][1])
    # brute force over the stage's own input
    inside = sorted(((r.doc_id is None, r.doc_id or 0, r.doc_id), r.text) for r in seen["near_dedup"][0])
    kept: list = []
    for (_, _, i), text in inside:
        if all(vptree.jaccard(text, t, 5) < 0.8 for _, t in kept):
            kept.append((i, text))
    assert ids("near_dedup") == {i for i, _ in kept} and not ids("near_dedup") & {100, 101, None}
    m = tiling.Matcher([(1, item)], tiling.SEED, tiling.THRESHOLD)
    assert ids("decontaminate") == {r.doc_id for r in seen["decontaminate"][0] if not m.judge(r.text)} == ids("near_dedup") - {110}
    encoder = packing.WordEncoder(packing.default_tokenizer())
    want = sum(len(encoder.encode(r.text)) // 4 + 1 for r in seen["packing"][0])
    assert sum(r.length for r in seen["packing"][1]) == want and ids("packing") == ids("decontaminate")
    assert len({r.sequence_id for r in seen["packing"][1]}) == -(-want // packing.CAPACITY)
    whole = corpus_pipeline.run(spark, sf)
    pick = lambda rs: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rs)
    assert pick(whole.collect()) == pick(seen["packing"][1])


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder[0]).count() == 0


def test_exact_copies_leave_no_fragment(spark, folder):
    rng = random.Random(16)
    texts = ["\n".join(" ".join(word(rng) for _ in range(6)) for _ in range(n)) for n in range(2, 30)]
    rows = [(100 * c + k, t, "xx", "s", len(t)) for c in range(3) for k, t in enumerate(texts)]
    left = corpus_pipeline.unique_lines(spark, spark.createDataFrame(rows, DOCS), folder[0]).collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in left} == {(k, t, len(t)) for k, t in enumerate(texts)}


def test_lines_go_by_chunks_too(spark, folder):
    """A line between blank ones is no passage, but op10's chunks hold it: copies go as there."""
    rng = random.Random(17)
    texts = [f"{' '.join(word(rng) for _ in range(6))}{blank}" for blank in ("\n", "\n\n", "\n \n") for _ in range(4)]
    rows = [(100 * c + k, t, "xx", "s", len(t)) for c in range(3) for k, t in enumerate(texts)]
    left = corpus_pipeline.unique_lines(spark, spark.createDataFrame(rows, DOCS), folder[0]).collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in left} == {(k, t, len(t)) for k, t in enumerate(texts)}


def test_nothing_to_learn_from_keeps_all_texts_with_letters(spark, folder):
    docs = spark.createDataFrame([(1, "abc", None, None, 3), (2, "12", None, None, 2), (3, None, None, None, 0)], DOCS)
    assert [r.doc_id for r in corpus_pipeline.known_language(spark, docs, folder[0]).collect()] == [1]


# --- registered queries ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    if name in registry.ORACLE:
        assert compare(df, duck, registry.ORACLE[name]) is None
    else:
        table = "pages" if name.startswith("op3") else "documents"
        key = "page_id" if name.startswith("op3") else "doc_id"
        assert df.select(key).distinct().count() == spark.read.parquet(f"{SF}/{table}.parquet").select(key).distinct().count()


def test_entry_registers_all():
    import __spark_entry__ as entry

    assert {*registry.QUERIES, "pipeline"} <= set(entry.queries()) and set(registry.ORACLE) <= set(entry.oracle_sql())
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in entry.queries())] == []
