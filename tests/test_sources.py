import datetime as dt
import tempfile

import pytest
from conftest import rows, utc
from pyspark.sql import functions as F

from openbell.functions.numeric import nan_to_null
from openbell.operators import contracts, dedup
from openbell.sources import articles as art
from openbell.sources import bars as src
from openbell.sources.store import TableStore


def test_volume_dedupe_then_first(make_bars):
    bars = make_bars(
        ("2024-03-05 10:00", 1, 1, 1, 1, 5, "VX", 1), ("2024-03-05 10:00", 2, 2, 2, 2, 9, "VX", 2),
        ("2024-03-05 10:01", 3, 3, 3, 3, 5, "VX", 1), ("2024-03-05 10:01", 4, 4, 4, 4, 5, "VX", 2),
    )
    assert rows(dedup.keep_highest_volume(bars), "open") == [(2.0,), (3.0,)]
    clean, dirty = src.healed(bars)
    assert dirty and clean.count() == 2
    assert not src.healed(clean)[1]


def test_keep_first_and_last(make_bars):
    bars = make_bars(("2024-03-05 10:00", 1, 1, 1, 1, 5, "ES", 1), ("2024-03-05 10:00", 2, 2, 2, 2, 9, "ES", 2))
    assert rows(dedup.keep_first(bars, ["symbol", "ts"]), "load_seq") == [(1,)]
    assert rows(dedup.keep_last(bars, ["symbol", "ts"]), "load_seq") == [(2,)]


def test_dedupe_limits_before_the_shuffle(make_bars):
    bars = make_bars(("2024-03-05 10:00", 1, 1, 1, 1, 5, "ES", 1)).repartition(4)
    plan = dedup.keep_first(bars, ["symbol", "ts"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # partial and final


def test_trim_is_half_open(make_bars):
    bars = make_bars(("2024-03-05 10:00", 1, 1, 1, 1), ("2024-03-05 10:05", 2, 2, 2, 2))
    out = src.trim(bars, utc("2024-03-05 10:00"), utc("2024-03-05 10:05"))
    assert rows(out, "open") == [(1.0,)]


def test_increment_per_symbol_and_rerun(make_bars):
    old = make_bars(("2024-03-05 10:00", 1, 1, 1, 1), ("2024-03-05 10:05", 1, 1, 1, 1, 1, "VX"))
    new = make_bars(
        ("2024-03-05 10:00", 9, 9, 9, 9), ("2024-03-05 10:02", 2, 2, 2, 2), ("2024-03-05 10:02", 3, 3, 3, 3, 1, "VX"),
        ("2024-03-05 10:07", 4, 4, 4, 4, 1, "VX"), ("2024-03-05 10:03", 5, 5, 5, 5, 1, "ZN"),
    )
    end = utc("2024-03-05 10:07")
    once = src.extended(old, new, end)
    assert rows(once, "symbol", "open") == [("ES", 1.0), ("ES", 2.0), ("VX", 1.0), ("ZN", 5.0)]
    assert rows(src.extended(once, new, end), "symbol", "ts") == rows(once, "symbol", "ts")


def test_append_writes_months_and_prunes(spark, make_bars):
    path = tempfile.mkdtemp(prefix="openbell-test-") + "/bars"
    src.append_bars(make_bars(("2024-03-29 10:00", 1, 1, 1, 1), ("2024-04-01 10:00", 2, 2, 2, 2)), path)
    src.append_bars(make_bars(("2024-04-02 10:00", 3, 3, 3, 3)), path)
    april = src.read_stamped(spark, path, first_month="2024-04")
    assert rows(april, "open", "et_second") == [(2.0, 36000), (3.0, 36000)]
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = april._jdf.queryExecution().explainString(mode)
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "et_month" in filters and "2024-04" in filters


def test_vendor_forms(spark):
    at = dt.datetime(2024, 3, 5, 9, 0)
    fixed = spark.createDataFrame(
        [("ZN", at, 110_250_000_000, 1, 1, 1, 7, 1)],
        "symbol STRING, ts TIMESTAMP_NTZ, open BIGINT, high BIGINT, low BIGINT, close BIGINT, volume BIGINT, load_seq BIGINT",
    )
    assert rows(src.normalise_fixed_point(fixed), "open", "volume") == [(110.25, 7.0)]
    chicago = spark.createDataFrame(
        [("ES", at, "5", "5", "5", "5", "1", 1)],
        "symbol STRING, ts TIMESTAMP_NTZ, open STRING, high STRING, low STRING, close STRING, volume STRING, load_seq BIGINT",
    )
    assert rows(src.normalise_exchange_time(chicago, "America/Chicago"), "ts", "open") == [
        (dt.datetime(2024, 3, 5, 15, 0), 5.0)
    ]
    assert rows(src.normalise_exchange_time(chicago, None), "ts") == [(at,)]
    assert src.normalise_exchange_time(chicago.limit(0), None).count() == 0


def test_nan_becomes_null(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"),), (1.0,)], "x DOUBLE"))
    assert df.filter("x IS NULL").count() == 1


def test_landing_first_wins_and_bad_stamps_are_null(spark):
    path = tempfile.mkdtemp(prefix="openbell-test-")
    with open(f"{path}/a.json", "w") as f:
        f.write('{"title": "t", "description": "d", "published_at": "2024-03-05T10:00:00+00:00", "extra": 1}\n')
        f.write('{"title": "u", "description": "d", "published_at": "never"}\n')
    first, second = art.read_landing(spark, path, 1), art.read_landing(spark, path, 2)
    out = art.landed(first.unionByName(second))
    assert rows(out, "title", "published_at", "load_seq") == [
        ("t", dt.datetime(2024, 3, 5, 10), 1), ("u", None, 1)
    ]


def _articles(spark, *data):
    return spark.createDataFrame(
        [(t, d, dt.datetime.fromisoformat(at), seq) for t, d, at, seq in data],
        "title STRING, description STRING, published_at TIMESTAMP_NTZ, load_seq BIGINT",
    )


def test_article_merge_retakes_the_last_day(spark):
    old = _articles(spark, ("a", "1", "2024-03-04 10:00", 1), ("b", "1", "2024-03-05 10:00", 1))
    new = _articles(spark, ("b", "2", "2024-03-05 10:00", 2), ("c", "2", "2024-03-05 09:00", 2),
                    ("z", "2", "2024-03-04 09:00", 2))
    out = art.merged(old, new, art.last_seen(old))
    assert rows(out, "title", "description") == [("a", "1"), ("b", "2"), ("c", "2")]
    assert rows(art.merged(out, new, art.last_seen(old)), "title", "description") == rows(out, "title", "description")


def test_corrupt_article_table_is_refused(spark):
    with pytest.raises(ValueError, match="published_at"):
        art.last_seen(_articles(spark).limit(0))


def test_manifest_names_missing_days(spark):
    manifest = spark.createDataFrame(
        [(dt.date(2024, 3, 4), True, None), (dt.date(2024, 3, 5), False, "HTTP 500")],
        "load_date DATE, ok BOOLEAN, error STRING",
    )
    art.check_manifest(manifest, dt.date(2024, 3, 4), dt.date(2024, 3, 4))
    with pytest.raises(RuntimeError, match="2024-03-05, 2024-03-06"):
        art.check_manifest(manifest, dt.date(2024, 3, 4), dt.date(2024, 3, 6))


def test_daily_cap_drops_the_earliest(spark):
    start = dt.datetime(2024, 3, 5)
    df = _articles(spark, *[(f"t{i}", "", (start + dt.timedelta(minutes=i)).isoformat(), 1) for i in range(501)])
    kept = dedup.latest_per_day(df)
    assert kept.count() == 500 and kept.filter("title = 't0'").count() == 0


def test_store_versions_and_prerequisites(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="openbell-test-"))
    with pytest.raises(FileNotFoundError, match="bars.*news"):
        store.require(bars="load bars", news="load news")
    store.replace("bars", spark.range(3))
    # a table can be rewritten from itself, and an unfinished version is invisible
    store.replace("bars", store.read("bars").filter("id > 0"))
    assert store.read("bars").count() == 2 and store.location("bars").endswith("v2")
    fs = store._fs()
    fs.mkdirs(store._path("bars", "v3"))
    assert store.location("bars").endswith("v2")
    store.append("bars", spark.range(1))
    assert store.read("bars").count() == 3
    assert store.next_location("bars").endswith("v4")


def test_contracts(spark, make_daily):
    df = make_daily([1, 2])
    contracts.check_schema(df, ["symbol", "date"], "market")
    contracts.check_unique(df, ["symbol", "date"], "market")
    with pytest.raises(ValueError, match="macro: duplicate key"):
        contracts.check_unique(df.union(df), ["date"], "macro")
    with pytest.raises(ValueError, match="market: date"):
        contracts.check_schema(df.withColumn("date", F.col("date").cast("timestamp")), ["date"], "market")
    with pytest.raises(ValueError, match="close.*market.*macro"):
        contracts.check_collisions({"market": df, "macro": df.select("date", "close")}, ["symbol", "date"])
    with pytest.raises(KeyError, match=r"\['a', 'b'\]"):
        contracts.require_columns(df, ["a", "close", "b"], "x")
    assert rows(contracts.null_audit(df.withColumn("open", F.lit(None))), "column_name", "n_null") == [("open", 2)]


def test_prune_keeps_the_last_versions(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="openbell-test-"))
    for n in range(5):
        store.replace("bars", spark.range(n))
    store.prune(keep=2)
    assert store._versions("bars", committed=False) == [4, 5] and store.read("bars").count() == 4


def test_first_delivery_wins_whatever_the_partitioning(spark):
    records = [(f"t{k % 5}", dt.datetime(2024, 1, 1), f"text {k}", 1, k) for k in range(40)]
    schema = "title STRING, published_at TIMESTAMP_NTZ, description STRING, load_seq BIGINT, delivery INT"
    for n in (1, 8):
        table = spark.createDataFrame(records[::-1], schema).repartition(n)
        assert rows(art.landed(table), "description") == [(f"text {k}",) for k in range(5)]
    ties = [spark.createDataFrame(records, schema).drop("delivery").repartition(n) for n in (1, 8)]
    first, second = (rows(art.landed(t), "title", "description") for t in ties)
    assert first == second and len(first) == 5


def test_landing_keeps_the_order_of_files(spark, tmp_path):
    for name, text in (("b.json", "late"), ("a.json", "early")):
        (tmp_path / name).write_text("".join(f'{{"title": "x", "published_at": "2024-01-01T00:00:00Z", "description": "{text} {k}"}}\n' for k in range(3)))
    landed = art.landed(art.read_landing(spark, str(tmp_path)))
    assert [r.description for r in landed.collect()] == ["early 0"]


def test_keep_rule_by_symbol(spark, make_bars):
    bars = make_bars(
        ("2024-03-05 10:00", 1, 1, 1, 1, 5, "VX", 1), ("2024-03-05 10:00", 2, 2, 2, 2, 9, "VX", 2),
        ("2024-03-05 10:00", 3, 3, 3, 3, 5, "ES", 1), ("2024-03-05 10:00", 4, 4, 4, 4, 9, "ES", 2),
    )
    out = src.new_bars(bars.limit(0), bars, dt.datetime(2024, 3, 6), keep=F.col("symbol").isin("VX"))
    assert rows(out, "symbol", "open") == [("ES", 3.0), ("VX", 2.0)]


def test_table_state_names_corrupt_groups(spark):
    table = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("a", None), ("b", None)], "k STRING, published_at TIMESTAMP_NTZ")
    assert rows(art.table_state(table, "k"), "k", "n", "last_seen", "corrupt") == [("a", 2, dt.datetime(2024, 1, 1), False), ("b", 1, None, True)]
    assert art.table_state(table.limit(0)).first()["corrupt"]


def test_prerequisites_as_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace("bars", spark.range(3))
    got = rows(store.prerequisites(bars="load bars", news="load news"), "table", "remedy", "present", "n")
    assert got == [("bars", "load bars", True, 3), ("news", "load news", False, None)]
