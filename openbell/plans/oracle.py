"""DuckDB SQL with the same results as the registered queries.

Fragments are CTE bodies shared by several statements.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def r(expr: str) -> str:
    """Rounded like the queries; + 0 turns a negative zero into zero."""
    return f"round({expr}, 6) + 0e0"


def prices(*cols: str) -> str:
    """Raw quotients of the inputs: eight digits, where no exact tie can occur."""
    return ", ".join(f"round({c}, 8) + 0e0 AS {c}" for c in cols)


def ratio(a: str, c: str) -> str:
    return f"(({a}) / nullif({c}, 0))"


def change(a: str, c: str) -> str:
    return f"({ratio(a, c)} - 1)"


def with_(*ctes: tuple[str, str], recursive: bool = False) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n"


# --- bars ---------------------------------------------------------------------

EVENT_BARS = (
    "bars",
    """SELECT event_type AS symbol, time_bucket(INTERVAL '30 minutes', ts) AS ts,
       arg_min(100 + value, ts) AS open, max(100 + value) AS high, min(100 + value) AS low,
       arg_max(100 + value, ts) AS close, CAST(count(*) AS DOUBLE) AS volume
       FROM events GROUP BY 1, 2""",
)
LINES = (
    "lines",
    """SELECT l_returnflag AS symbol, CAST(l_shipdate AS DATE) AS day,
       row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord,
       l_extendedprice / l_quantity AS price, l_quantity AS quantity,
       (l_orderkey + l_linenumber + l_partkey) % 6 AS slot FROM lineitem""",
)
OHLCV = """arg_min(price, ord) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, ord) AS close, sum(quantity) AS volume"""
DAILY = ("daily", f"SELECT symbol, day AS date, {OHLCV} FROM lines WHERE isodow(day) < 6 GROUP BY 1, 2")
LINE_BARS = (
    "bars",
    f"""SELECT symbol, timezone('UTC', timezone('America/New_York',
          day + (['08:30', '09:00', '09:30', '12:30', '15:30', '18:00'])[slot + 1]::TIME)) AS ts,
        open, high, low, close, volume
        FROM (SELECT symbol, day, slot, {OHLCV} FROM lines GROUP BY 1, 2, 3)""",
)
STAMPED = (
    "stamped",
    """SELECT *, CAST(local AS DATE) AS et_date, hour(local) * 3600 + minute(local) * 60 AS sec
       FROM (SELECT *, timezone('America/New_York', timezone('UTC', ts)) AS local FROM bars)""",
)
# seconds of the day: 08:30 09:00 09:30 15:30 18:00
PRE, SNAP, OPEN, LAST, EVENING = 30600, 32400, 34200, 55800, 64800


def session(first: int, last: int, source: str = "stamped") -> str:
    return f"""SELECT symbol, et_date AS date, arg_min(open, ts) AS open, max(high) AS high,
       min(low) AS low, arg_max(close, ts) AS close, sum(volume) AS volume
       FROM {source} WHERE sec BETWEEN {first} AND {last} AND isodow(et_date) < 6
       GROUP BY 1, 2 HAVING arg_max(close, ts) > 0"""


BARS_OUT = f"symbol, date, {r('open')} AS open, {r('high')} AS high, {r('low')} AS low, {r('close')} AS close, {r('volume')} AS volume"
ORACLE["session_ohlcv"] = with_(EVENT_BARS, STAMPED, ("s", session(OPEN, LAST))) + f"SELECT {BARS_OUT} FROM s"
ORACLE["window_0830"] = with_(EVENT_BARS, STAMPED, ("s", session(PRE, PRE))) + f"SELECT {BARS_OUT} FROM s"


def mean(c: str, n: int, start: int, part: str = "symbol", order: str = "date") -> str:
    end = start + n - 1
    first = f"{-start} PRECEDING"
    last = "CURRENT ROW" if end == 0 else f"{-end} PRECEDING"
    w = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {first} AND {last})"
    return f"(CASE WHEN count({c}) {w} = {n} THEN avg({c}) {w} END)"


RANGES = (
    "ranges",
    f"""SELECT *, {mean('realized_range', 5, -5)} AS rv_lag_5, {mean('realized_range', 22, -22)} AS rv_lag_22,
        realized_range AS target
        FROM (SELECT symbol, date, {ratio('high - low', 'open')} AS realized_range FROM s)""",
)
RANGE_OUT = "SELECT symbol, date, " + ", ".join(
    f"{r(c)} AS {c}" for c in ("realized_range", "rv_lag_5", "rv_lag_22", "target")
)
ORACLE["realized_range"] = with_(EVENT_BARS, STAMPED, ("s", session(OPEN, LAST)), RANGES) + f"{RANGE_OUT} FROM ranges"
ORACLE["realized_range_har"] = with_(LINES, DAILY, ("s", "SELECT * FROM daily"), RANGES) + f"{RANGE_OUT} FROM ranges"

PREMARKET = (
    "premarket",
    f"""SELECT symbol, date, {change('p9', 'lag(p16) OVER (PARTITION BY symbol ORDER BY date)')} AS overnight_gap,
        {change('p9', 'p18')} AS premarket_trend, {ratio('h830 - l830', 'o830')} AS macro_vol_830,
        {ratio('c830 - o830', 'o830')} AS macro_dir_830
        FROM (SELECT symbol, et_date AS date, open AS p9 FROM stamped WHERE sec = {SNAP}) a
        LEFT JOIN (SELECT symbol, et_date AS date, close AS p16 FROM stamped WHERE sec = {LAST}) USING (symbol, date)
        LEFT JOIN (SELECT symbol, et_date + 1 AS date, open AS p18 FROM stamped WHERE sec = {EVENING}) USING (symbol, date)
        LEFT JOIN (SELECT symbol, et_date AS date, arg_min(open, ts) AS o830, max(high) AS h830, min(low) AS l830,
                   arg_max(close, ts) AS c830 FROM stamped WHERE sec = {PRE} GROUP BY 1, 2) USING (symbol, date)""",
)
PREMARKET_COLS = ("overnight_gap", "premarket_trend", "macro_vol_830", "macro_dir_830")


def rounded(*cols: str) -> str:
    return ", ".join(f"{r(c)} AS {c}" for c in cols)


ORACLE["premarket_features"] = with_(EVENT_BARS, STAMPED, PREMARKET) + (
    f"SELECT symbol, date, {rounded(*PREMARKET_COLS)} FROM premarket"
)
LABEL = (
    "labels_",
    f"""SELECT symbol, date, CAST(CASE WHEN p16 > p930 THEN 1 ELSE 0 END AS TINYINT) AS y
        FROM (SELECT symbol, et_date AS date, close AS p16 FROM stamped WHERE sec = {LAST}) a
        JOIN (SELECT symbol, et_date AS date, open AS p930 FROM stamped WHERE sec = {OPEN}) USING (symbol, date)""",
)
ORACLE["updown_label"] = with_(EVENT_BARS, STAMPED, LABEL) + "SELECT symbol, date, y FROM labels_"
LEVEL = f"""SELECT symbol, et_date AS date,
       CASE WHEN max(sec) = {SNAP} THEN arg_max(open, ts) ELSE arg_max(close, ts) END AS level
       FROM stamped WHERE sec <= {SNAP} GROUP BY 1, 2"""
ORACLE["asof_level_0900"] = with_(EVENT_BARS, STAMPED, ("lv", LEVEL)) + f"SELECT symbol, date, {r('level')} AS level FROM lv"
ANCHORS = (
    "anchors",
    f"""SELECT symbol, date, level AS snapshot_9am, close_4pm FROM ({LEVEL})
        FULL JOIN (SELECT symbol, et_date AS date, arg_max(close, ts) AS close_4pm FROM stamped
                   WHERE sec <= {LAST} GROUP BY 1, 2) USING (symbol, date) WHERE isodow(date) < 6""",
)
ORACLE["daily_anchors"] = with_(EVENT_BARS, STAMPED, ANCHORS) + (
    f"SELECT symbol, date, {rounded('snapshot_9am', 'close_4pm')} FROM anchors"
)


def macro(vix: str, ten: str, n: int) -> list[tuple[str, str]]:
    w = "lag(close_4pm) OVER (PARTITION BY symbol ORDER BY date)"
    feats = f"""SELECT symbol, date, sign * {change('snapshot_9am', w)} AS overnight,
        sign * {change('snapshot_9am', mean('close_4pm', n, -n))} AS dist
        FROM (SELECT *, CASE WHEN symbol = '{ten}' THEN -1e0 ELSE 1e0 END AS sign FROM anchors)"""
    return [
        ("feats", feats),
        ("macro", f"""SELECT date, v.overnight AS vix_overnight, v.dist AS vix_dist_sma_{n},
            t.overnight AS tenY_overnight, t.dist AS tenY_dist_sma_{n}
            FROM (SELECT * FROM feats WHERE symbol = '{vix}') v
            FULL JOIN (SELECT * FROM feats WHERE symbol = '{ten}') t USING (date)"""),
    ]


def macro_cols(n: int) -> tuple[str, ...]:
    return ("vix_overnight", f"vix_dist_sma_{n}", "tenY_overnight", f"tenY_dist_sma_{n}")


ORACLE["macro_features"] = with_(LINES, LINE_BARS, STAMPED, ANCHORS, *macro("N", "R", 20)) + (
    f"SELECT date, {rounded(*macro_cols(20))} FROM macro"
)
ORACLE["macro_features_events"] = with_(EVENT_BARS, STAMPED, ANCHORS, *macro("error", "view", 5)) + (
    f"SELECT date, {rounded(*macro_cols(5))} FROM macro"
)

# --- indicators on a frame called `s`(symbol, date, open, high, low, close, volume)

W = "PARTITION BY symbol ORDER BY date"


def over(fn: str, n: int) -> str:
    return f"{fn} OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


PCT_B = f"""CASE WHEN {over('count(close)', 20)} = 20 THEN
      CASE WHEN {over('max(close)', 20)} = {over('min(close)', 20)} THEN 0.5e0
      ELSE (close - ({over('avg(close)', 20)} - 2 * {over('stddev_samp(close)', 20)}))
           / nullif(4 * {over('stddev_samp(close)', 20)}, 0) END END"""
ROLLING = (
    "rolling",
    f"""SELECT *, {mean('k_raw', 3, -2)} AS stoch_k FROM (SELECT symbol, date,
        {change('close', mean('close', 50, -49))} AS dist_sma_50,
        {change('close', mean('close', 200, -199))} AS dist_sma_200,
        {PCT_B} AS bb_pct_b, {ratio('volume', mean('volume', 20, -19))} AS relative_volume,
        CASE WHEN {over('count(low)', 14)} = 14 THEN 100 * (close - {over('min(low)', 14)})
             / nullif({over('max(high)', 14)} - {over('min(low)', 14)}, 0) END AS k_raw,
        {ratio('close - open', 'open')} AS prev_rth_momentum, {ratio('high - low', 'open')} AS prev_day_range
        FROM s)""",
)
ROLLING2 = ("rolling2", f"SELECT *, {mean('stoch_k', 3, -2)} AS stoch_d FROM rolling")


def rolling(*cols: str) -> str:
    ctes = (LINES, DAILY, ("s", "SELECT * FROM daily"), ROLLING, ROLLING2)
    return with_(*ctes) + f"SELECT symbol, date, {rounded(*cols)} FROM rolling2"


ORACLE["sma_distance"] = rolling("dist_sma_50", "dist_sma_200")
ORACLE["bollinger_pct_b"] = rolling("bb_pct_b")
ORACLE["relative_volume"] = rolling("relative_volume")
ORACLE["stochastic"] = rolling("stoch_k", "stoch_d")

MOVES = (
    "moves",
    f"""SELECT symbol, date, close, row_number() OVER ({W}) AS rn,
        greatest(close - pc, 0) AS gain, greatest(pc - close, 0) AS loss,
        CASE WHEN pc IS NOT NULL THEN greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr,
        CASE WHEN high - ph > pl - low AND high - ph > 0 THEN high - ph WHEN pc IS NOT NULL THEN 0 END AS pdm,
        CASE WHEN pl - low > high - ph AND pl - low > 0 THEN pl - low WHEN pc IS NOT NULL THEN 0 END AS mdm, pc
        FROM (SELECT *, lag(close) OVER ({W}) AS pc, lag(high) OVER ({W}) AS ph, lag(low) OVER ({W}) AS pl FROM s)""",
)


def step(y: str, x: str, a: str) -> str:
    """One step of a recursive mean seeded with the first non-null value."""
    return f"(CASE WHEN {x} IS NULL THEN {y} WHEN {y} IS NULL THEN {x} ELSE {y} + ({x} - {y}) * {a} END)"


A14 = "(1e0 / 14)"
STATE = (
    "state",
    f"""SELECT symbol, rn, date, close, CASE WHEN pc IS NOT NULL THEN gain END AS g,
          CASE WHEN pc IS NOT NULL THEN loss END AS l, tr, pdm, mdm,
          close AS e12, close AS e26 FROM moves WHERE rn = 1
        UNION ALL
        SELECT m.symbol, m.rn, m.date, m.close, {step('p.g', 'm.gain', A14)}, {step('p.l', 'm.loss', A14)},
          {step('p.tr', 'm.tr', A14)}, {step('p.pdm', 'm.pdm', A14)}, {step('p.mdm', 'm.mdm', A14)},
          {step('p.e12', 'm.close', '(2e0 / 13)')}, {step('p.e26', 'm.close', '(2e0 / 27)')}
        FROM state p JOIN moves m ON m.symbol = p.symbol AND m.rn = p.rn + 1""",
)
STATE2 = (
    "state2",
    """SELECT symbol, rn, date, close, CASE WHEN rn >= 15 THEN 100 * g / nullif(g + l, 0) END AS rsi_14,
       CASE WHEN rn >= 15 THEN tr END AS atr_14,
       CASE WHEN rn >= 15 THEN 100 * pdm / nullif(tr, 0) END AS dmp_14,
       CASE WHEN rn >= 15 THEN 100 * mdm / nullif(tr, 0) END AS dmn_14,
       CASE WHEN rn >= 26 THEN e12 - e26 END AS macd FROM state""",
)
STATE3 = (
    "state3",
    "SELECT *, 100 * abs(dmp_14 - dmn_14) / nullif(dmp_14 + dmn_14, 0) AS dx FROM state2",
)
STATE4 = (
    "state4",
    f"""SELECT symbol, rn, dx AS adx, macd AS sig FROM state3 WHERE rn = 1
        UNION ALL
        SELECT m.symbol, m.rn, {step('p.adx', 'm.dx', A14)}, {step('p.sig', 'm.macd', '(2e0 / 10)')}
        FROM state4 p JOIN state3 m ON m.symbol = p.symbol AND m.rn = p.rn + 1""",
)
RECURSIVE = (
    "recursive_",
    """SELECT a.*, CASE WHEN a.rn >= 28 THEN adx END AS adx_14, CASE WHEN a.rn >= 34 THEN sig END AS macd_signal,
       CASE WHEN a.rn >= 34 THEN macd - sig END AS macd_hist, atr_14 / nullif(close, 0) AS pct_atr,
       macd / nullif(close, 0) AS pct_macd, CASE WHEN a.rn >= 34 THEN (macd - sig) / nullif(close, 0) END AS pct_macd_hist,
       CASE WHEN a.rn >= 34 THEN sig / nullif(close, 0) END AS pct_macd_signal
       FROM state3 a JOIN state4 b USING (symbol, rn)""",
)
RECURSION = (MOVES, STATE, STATE2, STATE3, STATE4, RECURSIVE)


def recursive(*cols: str) -> str:
    ctes = (LINES, DAILY, ("s", "SELECT * FROM daily"), *RECURSION)
    return with_(*ctes, recursive=True) + f"SELECT symbol, date, {rounded(*cols)} FROM recursive_"


ORACLE["rsi"] = recursive("rsi_14")
ORACLE["atr"] = recursive("pct_atr")
ORACLE["adx"] = recursive("adx_14", "dmp_14", "dmn_14")
ORACLE["macd"] = recursive("pct_macd", "pct_macd_hist", "pct_macd_signal")
ORACLE["recursive_in_blocks"] = recursive(
    "rsi_14", "pct_atr", "adx_14", "dmp_14", "dmn_14", "pct_macd", "pct_macd_hist", "pct_macd_signal"
)

TECHNICALS = (
    "dist_sma_50", "dist_sma_200", "rsi_14", "pct_atr", "bb_pct_b", "relative_volume", "adx_14",
    "dmp_14", "dmn_14", "stoch_k", "stoch_d", "pct_macd", "pct_macd_hist", "pct_macd_signal",
    "prev_rth_momentum", "prev_day_range",
)
LAGGED = ", ".join(f"lag({c}) OVER ({W}) AS {c}" for c in TECHNICALS)


def technicals(as_of: str | None) -> list[tuple[str, str]]:
    """CTE `tech`(symbol, date, 16 lagged technicals) over `s`."""
    wide = f"SELECT symbol, date, {', '.join(TECHNICALS)} FROM rolling2 JOIN recursive_ USING (symbol, date)"
    if as_of:
        nulls = ", ".join("NULL" for _ in TECHNICALS)
        wide += f""" UNION ALL SELECT symbol, DATE '{as_of}', {nulls} FROM s GROUP BY 1
            HAVING NOT bool_or(date = DATE '{as_of}')"""
    return [ROLLING, ROLLING2, *RECURSION, ("wide", wide), ("tech", f"SELECT symbol, date, {LAGGED} FROM wide")]


ORACLE["daily_technicals"] = with_(
    LINES, DAILY, ("s", "SELECT * FROM daily"), *technicals("2002-01-01"), recursive=True
) + f"SELECT symbol, date, {rounded(*TECHNICALS)} FROM tech"

# --- feature tables -----------------------------------------------------------

AS_OF = "2001-11-06"
LINE_SESSION = (LINES, LINE_BARS, STAMPED, ("s", session(OPEN, LAST)))
FEATURES = (*PREMARKET_COLS, *TECHNICALS)
MATRIX = [
    *LINE_SESSION,
    *technicals(None),
    PREMARKET,
    LABEL,
    ("matrix", f"""SELECT symbol, date, {', '.join(FEATURES)}, y FROM premarket
        LEFT JOIN tech USING (symbol, date) LEFT JOIN labels_ USING (symbol, date)"""),
    ("complete", "SELECT * FROM matrix WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)),
]
ORACLE["feature_matrix"] = with_(*MATRIX, recursive=True) + f"""
    SELECT symbol, date, {rounded(*FEATURES)}, y FROM complete
    WHERE y IS NOT NULL AND date >= DATE '{AS_OF}' - INTERVAL 60 MONTH"""
ORACLE["feature_matrix_unsettled"] = with_(*MATRIX, recursive=True) + (
    f"SELECT symbol, date, {rounded(*FEATURES)}, y FROM matrix"
)
AUDITED = ("symbol", "date", *FEATURES, "y")
ORACLE["null_audit"] = with_(*MATRIX, recursive=True) + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM matrix" for c in AUDITED
) + ") WHERE n_null > 0"

LINE_LEVEL = ("lv", LEVEL.replace("WHERE sec", "WHERE symbol = 'N' AND sec"))
ORACLE["training_matrix"] = with_(*MATRIX, RANGES, LINE_LEVEL, recursive=True) + f"""
    SELECT symbol, date, {rounded(*FEATURES, 'rv_lag_5', 'rv_lag_22', 'target')}, {r('level')} AS vix_level
    FROM complete JOIN ranges USING (symbol, date) LEFT JOIN (SELECT date, level FROM lv) USING (date)
    WHERE y IS NOT NULL AND target IS NOT NULL"""
PRIOR = (
    "prior_",
    """SELECT c.symbol, c.date, count(r.date) AS prior_sessions
       FROM complete c LEFT JOIN ranges r ON r.symbol = c.symbol AND r.date < c.date GROUP BY 1, 2""",
)


def prior_mean(n: int) -> str:
    return f"""CASE WHEN prior_sessions >= 22 THEN (SELECT avg(realized_range) FROM numbered n
        WHERE n.symbol = p.symbol AND n.rn BETWEEN p.prior_sessions - {n - 1} AND p.prior_sessions) END"""


ORACLE["scoring_rows"] = with_(
    *MATRIX, RANGES, LINE_LEVEL, PRIOR,
    ("numbered", "SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM ranges"),
    ("lags", f"SELECT *, {prior_mean(5)} AS rv_lag_5, {prior_mean(22)} AS rv_lag_22 FROM prior_ p"),
    recursive=True,
) + f"""SELECT symbol, date, prior_sessions, {rounded('rv_lag_5', 'rv_lag_22', *FEATURES)},
    true AS has_features, {r('level')} AS vix_level
    FROM lags JOIN complete USING (symbol, date) LEFT JOIN (SELECT date, level FROM lv) USING (date)"""

# --- articles -------------------------------------------------------------------

SPACE = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{SPACE}+', ''), '{SPACE}+\\z', '')"


def articles(start: str = "2024-01-01") -> list[tuple[str, str]]:
    """CTEs `articles` and `boxed` (pre-market articles with their text and key)."""
    return [
        ("articles", f"""SELECT doc_id, TIMESTAMP '{start}' + to_minutes(CAST(doc_id * 127 AS INT)) AS published_at,
            substr(text, 1, 60) AS title, substr(text, 61) AS description, doc_id AS load_seq FROM documents"""),
        ("placed", """SELECT *, CASE WHEN hour(local) < 9 THEN CAST(local AS DATE)
            WHEN hour(local) >= 16 THEN CAST(local AS DATE) + 1 END AS day
            FROM (SELECT *, timezone('America/New_York', timezone('UTC', published_at)) AS local FROM articles)"""),
        ("boxed", f"""SELECT *, sha256(news_text) AS text_hash FROM (
            SELECT doc_id, published_at, title,
            CAST(day + CASE isodow(day) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS DATE) AS Date,
            replace({strip('title')} || '. ' || {strip('description')}, '.. ', '. ') AS news_text
            FROM placed WHERE day IS NOT NULL)"""),
    ]


SCORES = (
    "scores",
    """WITH w AS (SELECT doc_id, doc_id * 7919 % 17 + 1 AS a, doc_id * 104729 % 23 + 1 AS b,
            doc_id * 1299709 % 29 + 1 + CASE WHEN doc_id % 4 = 0 THEN 400 ELSE 0 END AS c FROM documents)
       SELECT doc_id, a * 1e0 / (a + b + c) AS prob_pos, b * 1e0 / (a + b + c) AS prob_neg,
       c * 1e0 / (a + b + c) AS prob_neu,
       CASE WHEN doc_id % 13 = 0 THEN NULL ELSE 0.10e0 + (doc_id * 31 % 91) / 1e2 END AS relevance,
       CASE WHEN doc_id % 13 = 0 THEN NULL ELSE 0.10e0 + (doc_id * 37 % 91) / 1e2 END AS novelty,
       CASE WHEN doc_id % 13 = 0 THEN NULL ELSE 0.10e0 + (doc_id * 41 % 91) / 1e2 END AS subjectivity FROM w""",
)
T2 = ("relevance", "novelty", "subjectivity")
PROBS = ("prob_pos", "prob_neg", "prob_neu")


def gated(source: str) -> str:
    t2 = ", ".join(f"CASE WHEN prob_neu <= 0.8e0 THEN {c} END AS {c}" for c in T2)
    return f"""SELECT *, is_neutral OR relevance IS NOT NULL AS tier2_scored FROM (
        SELECT * EXCLUDE ({', '.join(T2)}), {t2}, prob_neu > 0.8e0 AS is_neutral FROM ({source}))"""


ORACLE["duplicate_keys"] = with_(*articles()) + (
    "SELECT title, description, count(*) AS n_rows FROM articles GROUP BY 1, 2 HAVING count(*) > 1"
)
ORACLE["aligned_articles"] = with_(*articles()) + (
    "SELECT doc_id, Date, published_at, CAST(length(news_text) AS INT) AS n_chars, text_hash FROM boxed"
)
UNIQUE = """SELECT text_hash, arg_max(Date, published_at) AS Date, max(published_at) AS published_at,
    count(*) AS n_copies FROM boxed"""
ORACLE["text_keys"] = with_(*articles()) + UNIQUE + " GROUP BY 1"
ORACLE["pending_texts"] = with_(*articles()) + UNIQUE + """
    WHERE text_hash NOT IN (SELECT text_hash FROM boxed WHERE Date < DATE '2024-02-15') GROUP BY 1"""
ORACLE["retry_merge"] = with_(
    *articles(), SCORES,
    ("one", "SELECT text_hash, min(doc_id) AS doc_id FROM boxed WHERE Date < DATE '2024-02-15' GROUP BY 1"),
    ("ckpt", gated("SELECT * FROM one JOIN scores USING (doc_id)")),
) + f"""SELECT text_hash, doc_id, {rounded(*PROBS)}, is_neutral, tier2_scored OR fixed AS tier2_scored,
    {r('CASE WHEN fixed THEN 0.5 ELSE relevance END')} AS relevance,
    {r('CASE WHEN fixed THEN 0.25 ELSE novelty END')} AS novelty,
    {r('CASE WHEN fixed THEN 0.75 ELSE subjectivity END')} AS subjectivity
    FROM (SELECT *, NOT tier2_scored AND doc_id % 2 = 0 AS fixed FROM ckpt)"""
COPIES = ("one", "SELECT text_hash, min(doc_id) AS doc_id, count(*) AS n_copies FROM boxed GROUP BY 1")
ORACLE["scores_on_copies"] = with_(*articles(), SCORES, COPIES) + f"""
    SELECT b.doc_id, b.Date, text_hash, n_copies, {rounded(*PROBS, 'relevance')}
    FROM boxed b JOIN one USING (text_hash) JOIN scores s ON s.doc_id = one.doc_id"""
PARSED = ", ".join(
    f"CASE WHEN doc_id % 5 < 3 THEN coalesce(round({c}, 4), 0.1e0) END AS {c}" for c in T2
)
ORACLE["parsed_scores"] = with_(
    SCORES, ("parsed", gated(f"SELECT doc_id, {', '.join(PROBS)}, {PARSED} FROM scores"))
) + f"SELECT doc_id, {rounded(*PROBS, *T2)}, is_neutral, tier2_scored FROM parsed"


def digits(i: int) -> str:
    return f"CAST('0x' || substr(text_hash, {i}, 3) AS INT)"


ORACLE["scored_once"] = with_(
    *articles(),
    ("texts", UNIQUE + " GROUP BY 1"),
    ("parts", f"""SELECT *, {digits(1)} AS a, {digits(4)} AS b, {digits(7)} AS c, {digits(10)} AS d,
        {digits(13)} AS e FROM texts"""),
    ("scored", gated("""SELECT text_hash, Date, published_at, n_copies,
        (a + 1) * 1e0 / (a + b + 5 * c + 3) AS prob_pos, (b + 1) * 1e0 / (a + b + 5 * c + 3) AS prob_neg,
        (5 * c + 1) * 1e0 / (a + b + 5 * c + 3) AS prob_neu,
        CASE WHEN e % 10 <> 0 THEN 0.1e0 + a / 5e3 END AS relevance,
        CASE WHEN e % 10 <> 0 THEN 0.1e0 + b / 5e3 END AS novelty,
        CASE WHEN e % 10 <> 0 THEN 0.1e0 + d / 5e3 END AS subjectivity FROM parts""")),
) + f"""SELECT text_hash, Date, published_at, n_copies, {rounded(*PROBS, *T2)}, is_neutral, tier2_scored FROM scored"""
ORACLE["article_days"] = with_(*articles()) + "SELECT count(DISTINCT Date) AS n_days FROM boxed"
ORACLE["articles_merged"] = with_(
    *articles(),
    ("both_loads", """SELECT title, published_at, description, 1 AS load_seq FROM articles
        UNION ALL SELECT title, published_at, description || ' (updated)', 2 FROM articles
        WHERE published_at >= TIMESTAMP '2024-01-31' AND published_at >= TIMESTAMP '2024-02-01'"""),
) + """SELECT title, published_at, CAST(load_seq AS BIGINT) AS load_seq,
    sha256(description) AS text_key FROM both_loads
    QUALIFY row_number() OVER (PARTITION BY title, published_at ORDER BY load_seq DESC) = 1"""
ORACLE["daily_cap"] = with_(*articles()) + """SELECT doc_id, published_at FROM articles
    QUALIFY row_number() OVER (PARTITION BY CAST(published_at AS DATE) ORDER BY published_at DESC, title, doc_id) <= 5"""

DAILY_NEWS = (
    "daily_news",
    """SELECT Date, avg(prob_pos) AS prob_pos_mean, avg(prob_neg) AS prob_neg_mean, avg(prob_neu) AS prob_neu_mean,
       avg(relevance) AS relevance_mean, avg(novelty) AS novelty_mean, avg(subjectivity) AS subjectivity_mean,
       avg((prob_pos - prob_neg) * relevance * subjectivity) AS weighted_impact,
       stddev_samp(prob_pos - prob_neg) FILTER (NOT is_neutral) AS sentiment_entropy,
       CAST(nullif(count(*) FILTER (NOT is_neutral), 0) AS DOUBLE) AS article_count
       FROM scored GROUP BY 1""",
)
DAILY_NEWS_COLS = (
    "prob_pos_mean", "prob_neg_mean", "prob_neu_mean", "relevance_mean", "novelty_mean", "subjectivity_mean",
    "weighted_impact", "sentiment_entropy", "article_count",
)
SERIES_COLS = (
    "buzz_factor", "sentiment_momentum", "sentiment_ewma_5d", *(f"impact_lag_{k}" for k in range(1, 6)),
)


def ewma(source: str, value: str, key: str = "symbol", day: str = "date") -> list[tuple[str, str]]:
    """CTE `ew`(key, rn, y): alpha 1/3; a gap keeps y and decays its weight w."""
    a = "(1e0 / 3)"
    return [
        ("ewn", f"""SELECT {key} AS k, row_number() OVER (PARTITION BY {key} ORDER BY {day}) AS rn,
            {day} AS day, {value} AS x FROM {source}"""),
        ("ew", f"""SELECT k, rn, day, x AS y, 1e0 AS w FROM ewn WHERE rn = 1
            UNION ALL
            SELECT n.k, n.rn, n.day,
              CASE WHEN n.x IS NULL THEN p.y WHEN p.y IS NULL THEN n.x
                   ELSE (p.w * (1 - {a}) * p.y + {a} * n.x) / (p.w * (1 - {a}) + {a}) END,
              CASE WHEN n.x IS NULL AND p.y IS NOT NULL THEN p.w * (1 - {a}) ELSE 1e0 END
            FROM ew p JOIN ewn n ON n.k = p.k AND n.rn = p.rn + 1"""),
    ]


def series(source: str, key: str) -> str:
    w = f"OVER (PARTITION BY {key} ORDER BY Date)"
    lags = ", ".join(f"lag(weighted_impact, {k}) {w} AS impact_lag_{k}" for k in range(1, 6))
    frame = f"OVER (PARTITION BY {key} ORDER BY Date ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)"
    return f"""SELECT *, weighted_impact - lag(weighted_impact) {w} AS sentiment_momentum, {lags},
        coalesce(article_count, 0) / nullif(avg(coalesce(article_count, 0)) {frame}, 0) AS buzz_factor
        FROM {source}"""


def sentiment(start: str) -> list[tuple[str, str]]:
    """CTE `sentiment`(Date, 17 features)."""
    return [
        *articles(start), SCORES,
        ("scored", gated("SELECT * FROM boxed JOIN scores USING (doc_id)")),
        DAILY_NEWS,
        *ewma("daily_news", "weighted_impact", "0", "Date"),
        ("sentiment", f"""SELECT t.*, y AS sentiment_ewma_5d FROM ({series('daily_news', '0')}) t
            JOIN ew ON ew.day = t.Date"""),
    ]


SENTIMENT_COLS = (*DAILY_NEWS_COLS, *SERIES_COLS)
ORACLE["daily_sentiment"] = with_(*sentiment("2024-01-01"), recursive=True) + (
    f"SELECT Date, {rounded(*SENTIMENT_COLS)} FROM sentiment"
)
ORACLE["daily_sentiment_with_copies"] = with_(
    *articles(), SCORES, COPIES,
    ("scored", gated("""SELECT b.Date, text_hash, s.* FROM boxed b JOIN one USING (text_hash)
        JOIN scores s ON s.doc_id = one.doc_id""")),
    DAILY_NEWS,
) + f"SELECT Date, {rounded(*DAILY_NEWS_COLS)} FROM daily_news"
MOMENTUM = ("mom", "SELECT symbol, date AS Date, (close - open) / nullif(open, 0) AS weighted_impact, volume AS article_count FROM daily")
ORACLE["buzz_momentum_lags"] = with_(
    LINES, DAILY, MOMENTUM, *ewma("mom", "weighted_impact", day="Date"), recursive=True
) + f"""SELECT symbol, Date, {rounded('weighted_impact', 'article_count', *SERIES_COLS)}
    FROM (SELECT t.*, y AS sentiment_ewma_5d FROM ({series('mom', 'symbol')}) t
          JOIN ew ON ew.k = t.symbol AND ew.day = t.Date)"""
ORACLE["ewma"] = with_(
    LINES, DAILY,
    ("gappy", "SELECT symbol, date, CASE WHEN day(date) % 7 <> 0 THEN (close - open) / open END AS value FROM daily"),
    *ewma("gappy", "value"), recursive=True,
) + f"SELECT symbol, date, {r('value')} AS value, {r('y')} AS ewma_5 FROM gappy JOIN ew ON k = symbol AND day = date"
ORACLE["ewma_blocks"] = ORACLE["ewma"]
TAIL = "OVER (PARTITION BY symbol ORDER BY Date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)"
ORACLE["tail_flags"] = with_(LINES, DAILY, MOMENTUM) + f"""
    SELECT symbol, Date AS date, {r('weighted_impact')} AS weighted_impact,
    CASE WHEN n = 252 THEN CAST(weighted_impact > hi AS TINYINT) END AS is_top_2pct_weighted_impact,
    CASE WHEN n = 252 THEN CAST(weighted_impact < lo AS TINYINT) END AS is_bot_2pct_weighted_impact
    FROM (SELECT *, count(weighted_impact) {TAIL} AS n, quantile_cont(weighted_impact, 0.98) {TAIL} AS hi,
          quantile_cont(weighted_impact, 0.02) {TAIL} AS lo FROM mom)"""
ORACLE["mean_embedding"] = with_(
    *articles(),
    ("vectors", """SELECT Date, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos
        FROM boxed JOIN embeddings ON vec_id = doc_id % (SELECT count(*) FROM embeddings)"""),
) + f"SELECT Date, CAST(pos AS INT) AS pos, {r('avg(CAST(x AS DOUBLE))')} AS value FROM vectors GROUP BY 1, 2"
ORACLE["daily_news_incremental"] = with_(
    *articles(), SCORES, ("scored", gated("SELECT * FROM boxed JOIN scores USING (doc_id)")), DAILY_NEWS,
) + f"SELECT Date, {rounded(*DAILY_NEWS_COLS)} FROM daily_news"
ORACLE["mean_embedding_incremental"] = ORACLE["mean_embedding"]

# --- calendar ---------------------------------------------------------------------


def calendar(first: str, last: str) -> list[tuple[str, str]]:
    """CTE `cal`(date, 9 features) between two scalar dates."""
    from openbell.operators.calendar import FOMC_DAYS

    fomc = ", ".join(f"(DATE '{d}')" for d in FOMC_DAYS)
    friday = "m + CAST((12 - isodow(m)) % 7 + 14 AS INT)"
    return [
        ("fomc", f"SELECT * FROM (VALUES {fomc}) t(d)"),
        ("spine", f"""SELECT CAST(unnest(generate_series(({first}), ({last}), INTERVAL 1 DAY)) AS DATE) AS date"""),
        ("months", f"""SELECT CAST(unnest(generate_series(date_trunc('month', ({first})),
            date_trunc('month', ({last})) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS m"""),
        ("opex", f"SELECT CAST({friday} AS DATE) AS d FROM months"),
        ("cal", """SELECT date, CAST(isodow(date) = 1 AS TINYINT) AS dow_mon, CAST(isodow(date) = 2 AS TINYINT) AS dow_tue,
            CAST(isodow(date) = 3 AS TINYINT) AS dow_wed, CAST(isodow(date) = 4 AS TINYINT) AS dow_thu,
            CAST(isodow(date) = 5 AS TINYINT) AS dow_fri,
            CAST((SELECT min(d) FROM fomc WHERE d >= date) - date AS DOUBLE) AS days_to_fomc,
            CAST(date IN (SELECT d FROM fomc) AS TINYINT) AS is_fomc_day,
            CAST((SELECT min(d) FROM opex WHERE d >= date) - date AS INT) AS days_to_opex,
            CAST(date IN (SELECT d FROM opex WHERE month(d) IN (3, 6, 9, 12)) AS TINYINT) AS is_quarterly_opex
            FROM spine WHERE isodow(date) < 6"""),
    ]


CALENDAR_COLS = (
    "dow_mon", "dow_tue", "dow_wed", "dow_thu", "dow_fri", "days_to_fomc", "is_fomc_day", "days_to_opex",
    "is_quarterly_opex",
)
ORACLE["calendar_features"] = with_(
    *articles(), *calendar("SELECT min(Date) FROM boxed", "SELECT max(Date) FROM boxed")
) + f"SELECT date, {', '.join(CALENDAR_COLS)} FROM cal"
ORACLE["days_to_event"] = """
    WITH o AS (SELECT o_orderstatus AS symbol, CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders),
    big AS (SELECT DISTINCT symbol, date FROM o WHERE o_totalprice > 499000),
    days AS (SELECT symbol, date, count(*) AS n_orders FROM o GROUP BY 1, 2)
    SELECT symbol, date, n_orders, CAST((SELECT min(b.date) FROM big b
        WHERE b.symbol = d.symbol AND b.date >= d.date) - date AS INT) AS days_to_event FROM days d"""
ORACLE["model_matrix"] = with_(
    *MATRIX, ANCHORS, *macro("N", "R", 20), *sentiment("1996-01-01"),
    *calendar("SELECT min(day) FROM lines", "SELECT max(day) FROM lines"), recursive=True,
) + f"""SELECT symbol, date, {rounded(*FEATURES)}, y, {rounded(*macro_cols(20))}, {rounded(*SENTIMENT_COLS)},
    {', '.join(CALENDAR_COLS)} FROM complete JOIN macro USING (date)
    JOIN (SELECT Date AS date, {', '.join(SENTIMENT_COLS)} FROM sentiment) USING (date) JOIN cal USING (date)
    WHERE y IS NOT NULL AND date <= DATE '{AS_OF}'"""

# --- loads and deduplication ---------------------------------------------------------

LOADS = (
    EVENT_BARS,
    ("first_load", "SELECT *, CAST(1 AS BIGINT) AS load_seq FROM bars WHERE ts < TIMESTAMP '2024-01-20'"),
    ("second_load", """SELECT * REPLACE (CASE WHEN minute(ts) = 0 THEN volume + 1 ELSE volume - 1 END AS volume),
        CAST(2 AS BIGINT) AS load_seq FROM bars WHERE ts >= TIMESTAMP '2024-01-18'"""),
    ("both_loads", "SELECT * FROM first_load UNION ALL SELECT * FROM second_load"),
)
BAR_COLS = f"symbol, ts, {rounded('open', 'high', 'low', 'close', 'volume')}"
BY_TS = "QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY"
ORACLE["bars_incremental"] = with_(*LOADS) + f"""SELECT {BAR_COLS}, load_seq FROM first_load
    UNION ALL SELECT {BAR_COLS}, load_seq FROM second_load s
    LEFT JOIN (SELECT symbol, max(ts) + INTERVAL 1 MINUTE AS start FROM first_load GROUP BY 1) USING (symbol)
    WHERE ts < TIMESTAMP '2024-01-28 14:01:00' AND (start IS NULL OR ts >= start)"""
ORACLE["dedupe_highest_volume"] = with_(*LOADS) + f"SELECT {BAR_COLS}, load_seq FROM both_loads b {BY_TS} b.volume DESC, load_seq) = 1"
ORACLE["dedupe_first"] = with_(*LOADS) + f"SELECT {BAR_COLS}, load_seq FROM both_loads {BY_TS} load_seq) = 1"
ORACLE["dedupe_last"] = with_(*LOADS) + f"SELECT {BAR_COLS}, load_seq FROM both_loads {BY_TS} load_seq DESC) = 1"
ORACLE["trim_half_open"] = with_(EVENT_BARS) + (
    f"SELECT {BAR_COLS} FROM bars WHERE ts >= TIMESTAMP '2024-01-18' AND ts < TIMESTAMP '2024-01-20'"
)
ORACLE["lookback"] = with_(LINES, DAILY) + f"SELECT symbol, date, {prices('open', 'high', 'low', 'close', 'volume')} FROM daily WHERE date >= DATE '1998-06-30'"
ORACLE["bars_fixed_point"] = with_(EVENT_BARS) + f"SELECT {BAR_COLS} FROM bars"
ORACLE["bars_exchange_time"] = with_(EVENT_BARS) + f"SELECT {BAR_COLS}, CAST(1 AS BIGINT) AS load_seq FROM bars"

# --- profiles, splits, metrics ----------------------------------------------------------

STATS = ", ".join(
    f"{r(f'avg({c})')} AS {c}_mean, {r(f'stddev_samp({c})')} AS {c}_std, {r(f'min({c})')} AS {c}_min, "
    f"{r(f'max({c})')} AS {c}_max, count(*) FILTER ({c} IS NULL) AS {c}_nulls"
    for c in ("close", "volume")
)
ORACLE["table_profile"] = with_(LINES, DAILY) + f"""SELECT symbol, count(*) AS n_rows, min(date) AS first_date,
    max(date) AS last_date, {STATS} FROM daily GROUP BY 1"""
ORACLE["latest_rows"] = with_(LINES, DAILY) + (
    f"SELECT symbol, date, {prices('open', 'high', 'low', 'close', 'volume')} FROM daily QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 5"
)
ORACLE["previous_day"] = with_(LINES, DAILY) + f"""SELECT symbol,
    CASE WHEN max(date) < DATE '{AS_OF}' THEN max(date) END AS previous_day FROM daily GROUP BY 1"""
ORACLE["numeric_coercion"] = f"""SELECT event_id,
    {r("TRY_CAST(regexp_extract(props, '\"k\": (\\d*)', 1) || CASE WHEN event_id % 3 = 0 THEN 'x' ELSE '' END AS DOUBLE)")} AS k
    FROM events"""
HAR = (LINES, DAILY, ("s", "SELECT * FROM daily"), RANGES)
ORACLE["chrono_split"] = with_(
    *HAR,
    ("days", "SELECT date, row_number() OVER (ORDER BY date) AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM ranges)"),
    ("cuts", "SELECT date, pos, floor(n * 0.8e0) AS fit FROM days"),
    ("split_", """SELECT date, CASE WHEN pos <= floor(fit * 0.8e0) THEN 'train' WHEN pos <= fit THEN 'validation'
        ELSE 'test' END AS split FROM cuts"""),
) + """SELECT split, symbol, count(*) AS n, min(date) AS first_date, max(date) AS last_date
    FROM ranges JOIN split_ USING (date) GROUP BY 1, 2"""
ORACLE["baseline_metrics"] = with_(
    *HAR,
    ("named", f"SELECT *, lag(realized_range) OVER ({W}) AS prev FROM ranges"),
    ("long", " UNION ALL ".join(
        f"SELECT '{n}' AS predictor, target AS t, {c} AS p FROM named WHERE {c} IS NOT NULL"
        for n, c in (("persist", "prev"), ("rv_lag_5", "rv_lag_5"), ("rv_lag_22", "rv_lag_22"))
    )),
    ("maes", "SELECT predictor, avg(abs(t - p)) AS m FROM long GROUP BY 1"),
) + f"""SELECT predictor, count(*) AS n, {r('sqrt(avg((t - p) * (t - p)))')} AS rmse, {r('avg(abs(t - p))')} AS mae,
    {r('1 - sum((t - p) * (t - p)) / (var_pop(t) * count(*))')} AS r2, {r('stddev_pop(p)')} AS pred_std,
    {r('avg(CASE WHEN abs(t - p) <= m THEN 1e0 ELSE 0e0 END)')} AS coverage_at_mae
    FROM long JOIN maes USING (predictor) GROUP BY 1"""

# --- ledger and report ----------------------------------------------------------------------


def predictions(name: str = "preds") -> list[tuple[str, str]]:
    w5 = "OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"
    return [
        (f"{name}_rr", f"SELECT symbol, date, (high - low) / nullif(open, 0) AS rr FROM daily"),
        (name, f"""SELECT symbol, date, predicted_range, CASE WHEN rn > 20 THEN rr END AS actual_range,
            CASE WHEN rn > 20 THEN abs(predicted_range - rr) END AS abs_error, rr
            FROM (SELECT *, avg(rr) {w5} AS predicted_range, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM {name}_rr)
            WHERE predicted_range IS NOT NULL"""),
    ]


PREDS = (LINES, DAILY, *predictions())
LEDGER_COLS = f"symbol, date, {rounded('predicted_range', 'actual_range', 'abs_error')}"
ORACLE["settlement"] = with_(
    *PREDS,
    ("known", "SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) > 5 AS done FROM preds"),
) + f"""SELECT symbol, date, {r('predicted_range')} AS predicted_range,
    {r('CASE WHEN done THEN rr END')} AS actual_range,
    {r('CASE WHEN done THEN abs(predicted_range - rr) END')} AS abs_error FROM known"""
ORACLE["ledger_upsert"] = with_(
    *PREDS,
    ("again", """SELECT symbol, date, CASE WHEN rn <= 30 THEN predicted_range * 2 ELSE predicted_range END AS predicted_range,
        actual_range, abs_error FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM preds)"""),
) + f"SELECT {LEDGER_COLS} FROM again"
ORACLE["ledger_by_month"] = with_(
    *PREDS,
    ("again", """SELECT symbol, date, predicted_range * CASE WHEN rn <= 30 THEN 2 ELSE 1 END AS predicted_range, rr, rn, abs_error
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM preds)"""),
    ("done", """SELECT symbol, date, predicted_range, CASE WHEN rn > 5 THEN rr END AS actual_range,
        CASE WHEN rn > 20 THEN abs_error WHEN rn > 5 THEN abs(predicted_range - rr) END AS abs_error FROM again"""),
) + f"SELECT {LEDGER_COLS} FROM done"
ROLLING7 = (
    "rolling7",
    """SELECT *, avg(abs_error) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS mae_7d
       FROM preds WHERE actual_range IS NOT NULL""",
)
ORACLE["rolling_error"] = with_(*PREDS, ROLLING7) + f"SELECT symbol, date, {r('mae_7d')} AS mae_7d FROM rolling7"
ORACLE["last_settled"] = with_(*PREDS, ROLLING7) + f"""SELECT symbol, date AS settled_date,
    {r('predicted_range')} AS settled_predicted, {r('actual_range')} AS settled_actual,
    {r('abs_error')} AS settled_error, {r('mae_7d')} AS rolling_mae FROM rolling7
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1"""
TRAIL = "OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)"
BANDS = (
    "bands",
    f"""SELECT *, CASE WHEN n_ranges < 30 THEN 'Normal' WHEN predicted_range < p25 THEN 'Calm'
        WHEN predicted_range < p75 THEN 'Normal' ELSE 'Active' END AS band
        FROM preds JOIN (SELECT symbol, date, quantile_cont(rr, 0.25) {TRAIL} AS p25, quantile_cont(rr, 0.75) {TRAIL} AS p75,
        count(*) {TRAIL} AS n_ranges FROM preds_rr) USING (symbol, date)""",
)
ORACLE["range_band"] = with_(*PREDS, BANDS) + (
    f"SELECT symbol, date, {rounded('predicted_range', 'p25', 'p75')}, n_ranges, band FROM bands"
)
ORACLE["tone_label"] = with_(
    LINES, DAILY, MOMENTUM,
    ("hist", f"SELECT symbol, Date AS date, weighted_impact AS v, list(weighted_impact) {TAIL} AS h FROM mom"),
    ("share", """SELECT symbol, date, len(list_filter(h, lambda x: x < v)) * 1e2 / nullif(len(h), 0) AS pct,
        coalesce(len(h), 0) AS n FROM hist"""),
) + f"""SELECT symbol, date, {r('pct')} AS share_below, CAST(n AS INT) AS n_impacts,
    CASE WHEN pct IS NULL OR n < 30 THEN '—' WHEN pct > 95 THEN 'Extreme Bullish' WHEN pct > 80 THEN 'Strong Bullish'
    WHEN pct > 65 THEN 'Mild Bullish' WHEN pct >= 35 THEN 'Neutral' WHEN pct >= 20 THEN 'Mild Bearish'
    WHEN pct >= 5 THEN 'Strong Bearish' ELSE 'Extreme Bearish' END AS tone FROM share"""


def bps(x: str) -> str:
    return f"printf('%.0f', ({x}) * 10000) || ' bps'"


ORACLE["forecast_report"] = with_(
    *PREDS, ROLLING7, BANDS,
    ("s", "SELECT * FROM daily"), RANGES,
    ("newest", "SELECT * FROM rolling7 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1"),
    ("msg", """SELECT b.*, rv_lag_5, n.date AS sd, n.predicted_range AS sp, n.actual_range AS sa, n.mae_7d AS sm,
        greatest((b.predicted_range - 0.003e0) * 10000, 0) AS low, (b.predicted_range + 0.003e0) * 10000 AS high
        FROM bands b JOIN newest n ON n.symbol = b.symbol
        LEFT JOIN ranges g ON g.symbol = b.symbol AND g.date = b.date"""),
) + f"""SELECT symbol, date, symbol || ': range forecast for ' || strftime(date, '%A %Y-%m-%d') AS title,
    symbol || ': range forecast for ' || strftime(date, '%A %Y-%m-%d') AS payload_title, '—' AS tone,
    'Expected high-low range ' || {bps('predicted_range')} || ' = ' || printf('%.2f', predicted_range * 100) || '%' || chr(10)
    || 'Session class: ' || band || chr(10) || 'Interval: ' || printf('%.0f', low) || ' to '
    || printf('%.0f', high) || ' bps' AS description, band,
    CAST(CASE band WHEN 'Calm' THEN 3447003 WHEN 'Active' THEN 15548997 ELSE 5763719 END AS INT) AS color,
    strftime(sd, '%Y-%m-%d') || chr(10) || 'Forecast ' || {bps('sp')} || chr(10) || 'Realized ' || {bps('sa')}
    || chr(10) || 'Missed by ' || {bps('abs(sp - sa)')} || chr(10) || 'Mean miss, last 7: ' || {bps('sm')} AS last_settled,
    strftime(date, '%A') AS dates_and_levels,
    CASE WHEN rv_lag_5 IS NOT NULL THEN 'Mean of 5 sessions ' || {bps('rv_lag_5')} || ', forecast is off it by '
    || printf('%+.0f', (predicted_range - rv_lag_5) * 10000) || ' bps' END AS simple,
    '[Latest settled day, Dates and levels, Overnight articles, ' || CASE WHEN rv_lag_5 IS NULL THEN '' ELSE 'Simple forecasts, ' END
    || 'Fit]' AS field_names,
    CAST(CASE WHEN rv_lag_5 IS NULL THEN 4 ELSE 5 END AS INT) AS n_fields, {r('low')} AS low_bps,
    {r('high')} AS high_bps, {r('(predicted_range - rv_lag_5) * 10000')} AS edge_bps FROM msg"""

# --- streaming (the batch result on the same rows) ---------------------------------------------

TICKS = (
    "bars",
    """SELECT event_type AS symbol, ts, 100 + value AS open, 100 + value AS high, 100 + value AS low,
       100 + value AS close, 1e0 AS volume FROM events""",
)
ORACLE["stream_dedupe"] = with_(TICKS) + f"SELECT {BAR_COLS} FROM bars"
TICK_STAMPED = ("stamped", STAMPED[1].replace("minute(local) * 60", "minute(local) * 60 + second(local)"))
ORACLE["stream_sessions"] = with_(TICKS, TICK_STAMPED, ("s", session(34200, 57540))) + f"SELECT {BARS_OUT} FROM s"
ORACLE["stream_articles"] = with_(*articles()) + "SELECT Date, published_at, text_hash FROM boxed"
ORACLE["stream_append"] = with_(TICKS, TICK_STAMPED) + f"""SELECT symbol, ts, {rounded('close', 'volume')}, et_date,
    CAST(sec AS INT) AS et_second, strftime(et_date, '%Y-%m') AS et_month FROM stamped"""
ORACLE["stream_snapshot"] = with_(EVENT_BARS, STAMPED, PREMARKET) + f"""
    SELECT symbol, date, {rounded(*PREMARKET_COLS)} FROM premarket
    WHERE date + INTERVAL 541 MINUTE <= (SELECT max(local) FROM stamped)"""
ORACLE["stream_snapshot_closed"] = with_(EVENT_BARS, STAMPED, PREMARKET) + f"SELECT symbol, date, {rounded(*PREMARKET_COLS)} FROM premarket"
ORACLE["stream_append_merged"] = ORACLE["stream_append"]
ORACLE["stream_late_repair"] = ORACLE["stream_sessions"]

# --- contracts and rules ------------------------------------------------------------------------

ORACLE["null_audit_observed"] = ORACLE["null_audit"]
ORACLE["contract_violations"] = with_(LINES, DAILY) + """
    SELECT 'market' AS source, 'duplicate key' AS rule, '{"symbol":"' || symbol || '","date":"' || strftime(date, '%Y-%m-%d') || '"}' AS detail,
           CAST(2 AS BIGINT) AS n FROM daily WHERE day(date) = 1
    UNION ALL SELECT 'macro', 'null key', '{"date":null}', 1 FROM (SELECT 1 FROM daily WHERE dayofyear(date) = 5 LIMIT 1)
    UNION ALL SELECT * FROM (VALUES ('market', 'missing column', 'y', CAST(NULL AS BIGINT)), ('calendar', 'missing column', 'date', NULL),
      ('sentiment', 'not a date', 'date: timestamp', NULL), ('market', 'column collision', 'open', NULL), ('macro', 'column collision', 'open', NULL),
      ('macro', 'column collision', 'close', NULL), ('calendar', 'column collision', 'close', NULL)) v"""

ORACLE["bars_keep_rule"] = with_(EVENT_BARS) + f"""SELECT symbol, ts,
    {r("close + CASE WHEN symbol = 'click' THEN 1 ELSE 0 END")} AS close,
    {r("volume + CASE WHEN symbol = 'click' THEN 1 ELSE 0 END")} AS volume
    FROM bars WHERE ts < TIMESTAMP '2024-01-28 14:01:00'"""
ORACLE["bars_healed"] = ORACLE["dedupe_highest_volume"]
ORACLE["bars_read"] = with_(EVENT_BARS) + f"SELECT {BAR_COLS} FROM bars"
ORACLE["articles_first_delivered"] = with_(*articles()) + """SELECT title, published_at, sha256(description || '0') AS text_key
    FROM articles QUALIFY row_number() OVER (PARTITION BY title, published_at ORDER BY doc_id) = 1"""
ORACLE["load_gaps"] = """WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS load_date FROM events)
    SELECT CAST(unnest(generate_series((SELECT min(load_date) FROM days), (SELECT max(load_date) FROM days), INTERVAL 1 DAY)) AS DATE)
    AS load_date EXCEPT SELECT load_date FROM days WHERE isodow(load_date) <> 7"""
ORACLE["scored_in_two_runs"] = f"SELECT * EXCLUDE (Date, published_at, n_copies) FROM ({ORACLE['scored_once']})"
ORACLE["legacy_checkpoint"] = with_(
    *articles(), SCORES,
    ("one", "SELECT text_hash, min(doc_id) AS doc_id FROM boxed WHERE Date < DATE '2024-02-15' GROUP BY 1"),
    ("ckpt", gated("SELECT * FROM one JOIN scores USING (doc_id)")),
) + "SELECT text_hash, is_neutral, tier2_scored FROM ckpt"
ORACLE["failed_texts"] = ORACLE["legacy_checkpoint"].replace(
    "SELECT text_hash, is_neutral, tier2_scored FROM ckpt", "SELECT text_hash, doc_id FROM ckpt WHERE NOT tier2_scored AND doc_id % 2 <> 0"
)
ORACLE["sentiment_load"] = with_(LINES, DAILY) + f"""SELECT date,
    {r('max(close) * CASE WHEN day(date) % 2 = 0 THEN -1 ELSE 1 END')} AS impact FROM daily GROUP BY date"""
ORACLE["fit_predict_rows"] = with_(
    *HAR,
    ("rows_", "SELECT symbol, date, target FROM ranges WHERE target IS NOT NULL"),
    ("days", "SELECT date, row_number() OVER (ORDER BY date) AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM rows_)"),
) + f"""SELECT symbol, date, {r('target')} AS target, true AS predicted FROM rows_ JOIN days USING (date)
    WHERE pos > floor(n * 0.8e0)"""
ORACLE["importance_names"] = """SELECT unnest(['rv_lag_5', 'rv_lag_22', 'prev_day_range', 'prev_rth_momentum', 'relative_volume',
    'rv_lag_22_missing']) AS feature, true AS non_negative, true AS sums_to_one"""

FLAGGED = (
    *HAR,
    ("rows_", "SELECT *, symbol = 'N' AS f, isodow(date) = 1 AS g FROM ranges WHERE target IS NOT NULL"),
    ("days", "SELECT date, row_number() OVER (ORDER BY date) AS pos, floor(count(*) OVER () * 0.8e0) AS fit FROM (SELECT DISTINCT date FROM rows_)"),
    ("placed_", "SELECT *, CASE WHEN pos <= floor(fit * 0.8e0) THEN 'train' WHEN pos <= fit THEN 'validation' ELSE 'test' END AS split FROM rows_ JOIN days USING (date)"),
    ("on_train", "SELECT f, g, avg(target) AS p FROM placed_ WHERE split = 'train' GROUP BY f, g"),
    ("on_fit", "SELECT f, g, avg(target) AS p FROM placed_ WHERE split <> 'test' GROUP BY f, g"),
    ("on_all", "SELECT f, g, avg(target) AS p FROM placed_ GROUP BY f, g"),
)
ORACLE["fit_by_cells"] = with_(*FLAGGED) + f"""SELECT symbol, date, {r('target')} AS target, {r('a.p')} AS tested, {r('b.p')} AS deployed
    FROM placed_ JOIN on_fit a USING (f, g) JOIN on_all b USING (f, g) WHERE split = 'test'"""
ORACLE["importance_by_cells"] = with_(
    *FLAGGED,
    ("means", """SELECT target AS t, avg(target) OVER () AS m, avg(target) OVER (PARTITION BY f) AS mf,
        avg(target) OVER (PARTITION BY g) AS mg, avg(target) OVER (PARTITION BY f, g) AS mfg FROM placed_"""),
    ("sse", """SELECT sum((t - m) * (t - m)) AS a, sum((t - mf) * (t - mf)) AS af, sum((t - mg) * (t - mg)) AS ag,
        sum((t - mfg) * (t - mfg)) AS afg FROM means"""),
    ("share", "SELECT CASE WHEN af <= ag THEN (a - af) / (a - afg) ELSE (ag - afg) / (a - afg) END AS x FROM sse"),
) + f"SELECT 'is_n' AS feature, {r('x')} AS importance FROM share UNION ALL SELECT 'is_monday', {r('1 - x')} FROM share"
ORACLE["model_metadata"] = with_(
    *FLAGGED,
    ("extent", "SELECT count(*) AS n, min(date) AS a, max(date) AS z FROM rows_"),
    ("val", "SELECT sqrt(avg((target - p) * (target - p))) AS rmse FROM placed_ JOIN on_train USING (f, g) WHERE split = 'validation'"),
    ("test", """SELECT sqrt(avg((target - p) * (target - p))) AS rmse, avg(abs(target - p)) AS mae, avg(abs(target - rv_lag_5)) AS lag
        FROM placed_ JOIN on_fit USING (f, g) WHERE split = 'test'"""),
) + f"""SELECT 'aggressive' AS mode, 'is_n,is_monday' AS features, CAST(1 AS INT) AS best_iter, CAST(10 AS INT) AS refit_rounds,
    trained, DATE '2024-01-08' AS searched, n AS train_rows, a AS train_start, z AS train_end, {r('val.rmse')} AS val_rmse,
    {r('test.rmse')} AS test_rmse, {r('test.mae')} AS test_mae, {r('test.lag')} AS lag_mae
    FROM extent, val, test, (VALUES (DATE '2024-01-08'), (DATE '2024-01-10')) v(trained)"""
ORACLE["trial_scores"] = with_(
    *HAR,
    ("rows_", "SELECT * FROM ranges WHERE target IS NOT NULL AND rv_lag_22 IS NOT NULL"),
    ("days", "SELECT date, row_number() OVER (ORDER BY date) AS pos, floor(count(*) OVER () * 0.8e0) AS fit FROM (SELECT DISTINCT date FROM rows_)"),
    ("held", "SELECT * FROM rows_ JOIN days USING (date) WHERE pos > floor(fit * 0.8e0) AND pos <= fit"),
    ("long", " UNION ALL ".join(f"SELECT '{n}' AS candidate, target AS t, {c} AS p FROM held" for n, c in (
        ("rv_lag_5", "rv_lag_5"), ("rv_lag_22", "rv_lag_22"), ("constant", "1e-2"), ("nearly_constant", "1e-2 + rv_lag_5 * 1e-6")))),
    ("scored", """SELECT candidate, avg(abs(t - p)) AS score, stddev_pop(p) < 1e-3 * stddev_samp(t) AS collapsed FROM long GROUP BY 1"""),
) + f"""SELECT candidate, CASE WHEN NOT collapsed THEN {r('score')} END AS score, collapsed,
    NOT collapsed AND score = (SELECT min(score) FROM scored WHERE NOT collapsed) AS wins FROM scored"""
ORACLE["search_due"] = with_(LINES, DAILY) + """SELECT date, last AS last_search, last IS NULL OR date + INTERVAL 12 HOUR - last >= INTERVAL 7 DAY AS due
    FROM (SELECT date, CASE WHEN day(date) > 1 THEN date + INTERVAL 13 HOUR - to_days(CAST(day(date) % 10 AS INT)) - to_hours(day(date) % 3) END AS last
          FROM (SELECT DISTINCT date FROM daily))"""
ORACLE["pinned_bounds"] = with_(LINES, LINE_BARS) + """
    SELECT symbol, date, bound, bound > date + INTERVAL 14 HOUR + INTERVAL 30 SECOND AS too_early,
           count(*) FILTER (ts < bound) AS seen, count(*) AS n
    FROM (SELECT symbol, ts, date, timezone('UTC', timezone('America/New_York', date + INTERVAL 541 MINUTE)) AS bound
          FROM (SELECT *, CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS date FROM bars)) GROUP BY ALL"""
ORACLE["article_tables"] = with_(*articles()) + """
    SELECT source, count(*) AS n, max(stored_at) AS last_seen, max(stored_at) IS NULL AS corrupt FROM (
      SELECT source, CASE WHEN min(doc_id) OVER (PARTITION BY source) % 2 = 0 AND doc_id % 3 > 0 THEN published_at END AS stored_at
      FROM articles JOIN (SELECT doc_id, source FROM documents) USING (doc_id)) GROUP BY 1"""
ORACLE["prerequisites"] = with_(LINES, DAILY) + """
    SELECT 'daily_bars' AS "table", 'load the bars' AS remedy, true AS present, count(*) AS n FROM daily
    UNION ALL VALUES ('sessions', 'build the sessions', true, CAST(0 AS BIGINT)), ('sentiment', 'score the articles', false, NULL)"""
