import datetime as dt
import sys
from pathlib import Path
from zoneinfo import ZoneInfo

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

NY = ZoneInfo("America/New_York")


@pytest.fixture(scope="session")
def spark():
    from oracle_check import session

    s = session()
    s.sparkContext.setLogLevel("ERROR")
    return s


def utc(local: str) -> dt.datetime:
    t = dt.datetime.fromisoformat(local).replace(tzinfo=NY)
    return t.astimezone(dt.timezone.utc).replace(tzinfo=None)


@pytest.fixture(scope="session")
def make_bars(spark):
    """Rows of (local time, open, high, low, close[, volume[, symbol[, load_seq]]])."""
    from openbell.schemas import BARS

    def build(*rows):
        out = []
        for row in rows:
            at, o, h, lo, c, *rest = row
            volume, symbol, seq = (*rest, *(1.0, "ES", 1)[len(rest):])
            num = [None if x is None else float(x) for x in (o, h, lo, c, volume)]
            out.append((symbol, utc(at), *num, seq))
        return spark.createDataFrame(out, BARS)

    return build


@pytest.fixture(scope="session")
def make_daily(spark):
    """Daily OHLCV rows from closes (or full tuples), on consecutive weekdays."""

    def build(values, symbol="ES", start=dt.date(2020, 1, 1)):
        rows, day = [], start
        for v in values:
            while day.weekday() > 4:
                day += dt.timedelta(days=1)
            o, h, lo, c, vol = v if isinstance(v, tuple) else (v, v, v, v, 1.0)
            rows.append((symbol, day, *[None if x is None else float(x) for x in (o, h, lo, c, vol)]))
            day += dt.timedelta(days=1)
        return spark.createDataFrame(
            rows, "symbol STRING, date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"
        )

    return build


def rows(df, *columns):
    """Sorted tuples of the chosen columns."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: tuple(map(str, t)))
