"""Recursive means of long series as composed maps, in built-in functions only.

Every value x of ``y += alpha * (x - y)`` is a map ``y -> a * y + b``. A series is cut into cells; inside a cell the
composed map of every row comes from running sums (``a`` is a power, ``b`` a weighted sum), so cells run side by side. One
row per cell then meets the others of its series: their maps are applied one after the other, and every cell gets the
mean before its first row. No task holds a whole series, only one row per cell of it.

``indicators.with_recursive`` gives the same values in one pandas call per series and is the shorter way for
daily rows. This one is for series too long for a task.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openbell.operators.indicators import MOVES, with_moves
from openbell.session import materialize

#: Days of a block of dates. Rows of one block are in one task.
BLOCK_DAYS = 512
#: Most rows of a cell, and the largest exponent of its weights, so that they stay far from the limits of a double.
CELL, EXPONENT = 2048, 600.0


def block_of_dates(order: str, days: int = BLOCK_DAYS) -> Column:
    return F.floor(F.datediff(F.col(order), F.lit(dt.date(1970, 1, 1))) / days)


def cell_rows(decays: Sequence[float], most: int = CELL) -> int:
    """Rows of a cell, so that no weight ``decay ** -rows`` exceeds e**600."""
    return max(1, min(most, int(EXPONENT / -math.log(min(decays)))))


def _attach(rows: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``side`` has one row per key; keys may be NULL."""
    side = side.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    met = same[0]
    for one in same[1:]:
        met = met & one
    return rows.join(side, met, "left").drop(*[f"_of_{k}" for k in keys])


def previous(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("symbol",), order: str = "date", block: Column | None = None) -> DataFrame:
    """Add ``_prev_<column>``, the values of the row before in the series. Blocks run side by side; the first row of a
    block gets the last row of the block before it."""
    rows = df.withColumn("_block", block_of_dates(order) if block is None else block)
    keys = [*by, "_block"]
    inside = Window.partitionBy(*keys).orderBy(order)
    ends = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.col(order)).alias("_end"))
    ends = ends.select(*keys, F.lag("_end").over(Window.partitionBy(*by).orderBy("_block")).alias("_end"))
    rows = _attach(rows.withColumn("_first", F.row_number().over(inside) == 1), ends, keys)
    return rows.withColumns({
        f"_prev_{c}": F.when(F.col("_first"), F.col("_end")[c]).otherwise(F.lag(c).over(inside)) for c in columns
    }).drop("_block", "_first", "_end")


def recursive_means(
    df: DataFrame,
    means: Mapping[str, tuple[str, float, int]],
    by: Sequence[str] = ("symbol",),
    order: str = "date",
    block: Column | None = None,
    most: int = CELL,
) -> DataFrame:
    """Add one recursive mean per entry ``name: (value column, alpha, least count)``.

    A mean starts with the first value, skips NULL and NaN (the row shows the mean so far) and is NULL until ``least
    count`` values were seen; 0 < alpha < 1. ``block`` never falls along ``order`` and says which rows share a task (by
    default 512 days); a block may hold any number of rows. ``order`` is unique in a series. Rows of a NULL key are
    one series; an empty table gives no rows. The input is read twice: store it if it is costly.
    """
    for name, (_, alpha, _) in means.items():
        if not 0 < alpha < 1:
            raise ValueError(f"alpha of {name} is not between 0 and 1: {alpha}")
    decay = {name: 1 - alpha for name, (_, alpha, _) in means.items()}
    length = cell_rows(list(decay.values()), most)
    rows = df.withColumn("_block", block_of_dates(order) if block is None else block)
    inside = Window.partitionBy(*by, "_block").orderBy(order)
    rows = rows.withColumn("_cell", F.floor((F.row_number().over(inside) - 1) / length))
    keys = [*by, "_block", "_cell"]
    running = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    values = {}
    for name, (column, _, _) in means.items():
        x = F.col(column).cast("double")
        values[f"_x_{name}"] = F.when(~F.isnan(x), x)
    rows = rows.withColumns(values)
    rows = rows.withColumns({f"_n_{name}": F.count(f"_x_{name}").over(running) for name in means})
    # with n values so far: y = decay**n * (mean before the cell) + b
    rows = rows.withColumns({
        f"_b_{name}": F.lit(alpha) * F.pow(F.lit(decay[name]), F.col(f"_n_{name}")) * F.coalesce(
            F.sum(F.col(f"_x_{name}") * F.pow(F.lit(1 / decay[name]), F.col(f"_n_{name}"))).over(running), F.lit(0.0)
        )
        for name, (_, alpha, _) in means.items()
    })
    ends = []
    for name in means:
        ends += [
            F.max(f"_n_{name}").alias(f"n_{name}"),
            F.max_by(f"_b_{name}", order).alias(f"b_{name}"),
            F.min_by(f"_x_{name}", F.when(F.col(f"_x_{name}").isNotNull(), F.col(order))).alias(f"x_{name}"),
        ]
    cells = rows.groupBy(*keys).agg(*ends)
    fields = [c for c in cells.columns if c not in by]
    series = cells.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_cells"))
    carries = series.select(
        *by,
        F.explode(F.arrays_zip("_cells", *[_carry(name, decay[name]).alias(f"_c_{name}") for name in means])).alias("_at"),
    ).select(
        *by, F.col("_at._cells._block").alias("_block"), F.col("_at._cells._cell").alias("_cell"),
        *[F.col(f"_at._c_{name}").alias(f"_c_{name}") for name in means],
    )
    out = _attach(rows, carries, keys)
    out = out.withColumns({
        name: F.when(
            F.col(f"_c_{name}.n") + F.col(f"_n_{name}") >= least,
            F.pow(F.lit(decay[name]), F.col(f"_n_{name}")) * F.col(f"_c_{name}.y") + F.col(f"_b_{name}"),
        )
        for name, (_, _, least) in means.items()
    })
    return out.select(*df.columns, *means)


def _carry(name: str, decay: float) -> Column:
    """Per cell of a series the mean (y) and the count (n) before its first row.

    A series starts as if its first value had been the mean before it: the first map keeps it there. Cells before
    that value have no count, so nothing is published for them.
    """
    cells = F.col("_cells")
    first = F.get(F.filter(cells, lambda c: c[f"x_{name}"].isNotNull()), F.lit(0))[f"x_{name}"]
    state = "struct<y:double,n:bigint,done:array<struct<y:double,n:bigint>>>"

    def step(acc: Column, cell: Column) -> Column:
        return F.struct(
            (F.pow(F.lit(decay), cell[f"n_{name}"]) * acc["y"] + cell[f"b_{name}"]).alias("y"),
            (acc["n"] + cell[f"n_{name}"]).alias("n"),
            F.concat(acc["done"], F.array(F.struct(acc["y"].alias("y"), acc["n"].alias("n")))).alias("done"),
        ).cast(state)

    start = F.struct(first.alias("y"), F.lit(0).alias("n"), F.array().alias("done")).cast(state)
    return F.aggregate(cells, start, step, lambda acc: acc["done"])


def with_recursive_in_blocks(daily: DataFrame, by: Sequence[str] = ("symbol",), order: str = "date", block: Column | None = None) -> DataFrame:
    """RSI, ATR, ADX, +DI, -DI and MACD like ``indicators.with_recursive``, without a task per series.

    The first means are stored, because ADX and the MACD signal are means of values made of them.
    """
    moves = with_moves(
        previous(daily, ["high", "low", "close"], by, order, block),
        prev={c: F.col(f"_prev_{c}") for c in ("high", "low", "close")},
    )
    wilder = {f"_{c}": (c, 1 / 14, 14) for c in MOVES}
    emas = {f"_ema_{n}": ("close", 2 / (n + 1), n) for n in (12, 26)}
    first = materialize(recursive_means(moves, wilder | emas, by, order, block), "recursive-means")

    def share(a: Column, b: Column) -> Column:
        return 100 * F.try_divide(a, b)

    first = first.withColumns({
        "dmp_14": share(F.col("_plus_move"), F.col("_true_range")),
        "dmn_14": share(F.col("_minus_move"), F.col("_true_range")),
        "macd": F.col("_ema_12") - F.col("_ema_26"),
    }).withColumn("_dx", share(F.abs(F.col("dmp_14") - F.col("dmn_14")), F.col("dmp_14") + F.col("dmn_14")))
    second = recursive_means(first, {"adx_14": ("_dx", 1 / 14, 14), "macd_signal": ("macd", 2 / 10, 9)}, by, order, block)
    return second.select(
        *daily.columns,
        share(F.col("_gain"), F.col("_gain") + F.col("_loss")).alias("rsi_14"),
        F.col("_true_range").alias("atr_14"),
        "adx_14", "dmp_14", "dmn_14", "macd",
        (F.col("macd") - F.col("macd_signal")).alias("macd_hist"),
        "macd_signal",
    )


#: Decay (as exponent of e) that one cell of an EWMA spans, and that of a single row that starts a cell of its own.
SPANNED, LEAP = 500.0, 50.0


def ewma_in_blocks(
    df: DataFrame, value: str, out: str, span: float = 5, by: Sequence[str] = ("symbol",), order: str = "date", block: Column | None = None
) -> DataFrame:
    """``indicators.ewma`` without a task per series: a gap of g rows before a value decays the mean g + 1 times.

    The map of a value depends on the rows since the one before, which may lie in an earlier block; so blocks first
    exchange how many rows they hold and where their last value stands. Rows before the first value are NULL, NaN
    counts as NULL. ``block`` and ``order`` as in ``recursive_means``; the rows are stored once on the way.
    """
    if span <= 1:
        raise ValueError(f"span must exceed 1: {span}")
    alpha = 2 / (span + 1)
    rows = df.withColumn("_block", block_of_dates(order) if block is None else block)
    keys = [*by, "_block"]
    inside, blocks = Window.partitionBy(*keys).orderBy(order), Window.partitionBy(*by).orderBy("_block")
    so_far, before = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)
    x = F.col(value).cast("double")
    rows = rows.withColumns({"_x": F.when(~F.isnan(x), x), "_p": F.row_number().over(inside)})
    seen = F.when(F.col("_x").isNotNull(), F.col("_p"))
    ends = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.max(seen).alias("_last"))
    ends = ends.withColumn("_start", F.coalesce(F.sum("_rows").over(blocks.rowsBetween(*before)), F.lit(0)))
    ends = ends.select(*keys, "_start", F.max(F.col("_start") + F.col("_last")).over(blocks.rowsBetween(*before)).alias("_prior"))
    rows = _attach(rows, ends, keys)
    here = F.max(seen).over(inside.rowsBetween(*before))
    rows = rows.withColumn("_d", F.coalesce(F.col("_p") - here, F.col("_start") + F.col("_p") - F.col("_prior")))
    weight = F.pow(F.lit(1 - alpha), F.col("_d"))
    known, first = F.col("_x").isNotNull(), F.col("_d").isNull()
    rows = rows.withColumns({
        "_a": F.when(~known, 1.0).when(first, 0.0).otherwise(weight / (weight + alpha)),
        "_b": F.when(~known, 0.0).when(first, F.col("_x")).otherwise(alpha * F.col("_x") / (weight + alpha)),
    })
    rows = rows.withColumn("_e", F.when(F.col("_a") > 0, F.least(-F.log("_a"), F.lit(LEAP))).otherwise(F.lit(LEAP)))
    rows = rows.withColumn("_turn", F.floor(F.sum("_e").over(inside.rowsBetween(*so_far)) / SPANNED))
    cut = (F.col("_p") == 1) | (F.col("_e") >= LEAP) | (F.col("_turn") != F.lag("_turn").over(inside))
    rows = rows.withColumn("_cut", cut)
    rows = rows.withColumn("_cell", F.sum(F.col("_cut").cast("int")).over(inside.rowsBetween(*so_far)))
    rows = materialize(rows.select(*df.columns, "_block", "_cell", "_cut", "_x", "_a", "_b"), "ewma-rows")

    keys = [*by, "_block", "_cell"]
    running = Window.partitionBy(*keys).orderBy(order).rowsBetween(*so_far)
    # y = _w * (decay of the cell's first row) * (mean before the cell) + _y
    rows = rows.withColumn("_w", F.product(F.when(F.col("_cut"), 1.0).otherwise(F.col("_a"))).over(running))
    rows = rows.withColumns({
        "_y": F.col("_w") * F.sum(F.col("_b") / F.col("_w")).over(running),
        "_w": F.col("_w") * F.first("_a").over(running),
        "_n": F.count("_x").over(running),
    })
    cells = rows.groupBy(*keys).agg(F.max_by("_w", order).alias("w"), F.max_by("_y", order).alias("y"), F.max("_n").alias("n"))
    series = cells.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_block", "_cell", "w", "y", "n"))).alias("_cells"))
    state = "struct<y:double,done:array<double>>"

    def step(acc: Column, cell: Column) -> Column:
        mean = F.when(cell["n"] == 0, acc["y"]).otherwise(F.coalesce(cell["w"] * acc["y"], F.lit(0.0)) + cell["y"])
        return F.struct(mean.alias("y"), F.concat(acc["done"], F.array(acc["y"])).alias("done")).cast(state)

    start = F.struct(F.lit(None).cast("double").alias("y"), F.array().alias("done")).cast(state)
    carried = F.aggregate(F.col("_cells"), start, step, lambda acc: acc["done"])
    at = series.select(*by, F.explode(F.arrays_zip("_cells", carried.alias("c"))).alias("_at"))
    carries = at.select(*by, F.col("_at._cells._block").alias("_block"), F.col("_at._cells._cell").alias("_cell"), F.col("_at.c").alias("_c"))
    known = (F.col("_n") > 0) | F.col("_c").isNotNull()
    mean = F.when(known, F.coalesce(F.col("_w") * F.col("_c"), F.lit(0.0)) + F.col("_y"))
    return _attach(rows, carries, keys).select(*df.columns, mean.alias(out))
