"""Windows over price series of many symbols.

A series holds at most one row per symbol and calendar day
(:func:`daily_prices` makes it so with a map-side combine). That bounds what
one window task sorts: even a symbol that owns a third of the raw rows
has no more than about 36,500 days per century. All columns share one
``partitionBy(symbol).orderBy(date)``, hence one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tabloom.functions.fixed_values import CLOSE_NAMES



def by_day(*keys: str) -> WindowSpec:
    """Days of each series in order."""
    return Window.partitionBy(*(keys or ("symbol",))).orderBy("date")


def daily_prices(
    raw: DataFrame, symbol: str | None = None, date: str = "Date", seq: str | None = None
) -> DataFrame:
    """``symbol, date, close``: typed, without NULLs, first row of each day.

    The close column is the first known alias. ``seq`` gives the input order;
    without it the file order within each input split is used.
    """
    close = next((name for name in CLOSE_NAMES if name in raw.columns), None)
    if date not in raw.columns:
        raise ValueError(f"no {date} column")
    if close is None:
        raise ValueError(f"no close column, expected one of {CLOSE_NAMES}")
    rows = raw.select(
        (F.col(symbol) if symbol else F.lit("series")).alias("symbol"),
        F.to_date(F.col(date)).alias("date"),
        F.col(f"`{close}`").cast("double").alias("close"),
        (F.col(seq) if seq else F.monotonically_increasing_id()).alias("seq"),
    ).dropna()
    return rows.groupBy("symbol", "date").agg(F.min_by("close", "seq").alias("close"))


def between_dates(prices: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Days from ``start`` up to but without ``end``."""
    if start:
        prices = prices.where(F.col("date") >= F.lit(start).cast("date"))
    if end:
        prices = prices.where(F.col("date") < F.lit(end).cast("date"))
    return prices


def rolling_mean(value: Column, size: int, over: WindowSpec | None = None) -> Column:
    """Mean of the last ``size`` rows, NULL until that many values exist."""
    frame = (over or by_day()).rowsBetween(1 - size, 0)
    return F.when(F.count(value).over(frame) == size, F.avg(value).over(frame))


def difference(value: Column, over: WindowSpec | None = None) -> Column:
    """Change from the previous row, NULL on the first."""
    return value - F.lag(value).over(over or by_day())


def pct_change(value: Column, over: WindowSpec | None = None) -> Column:
    """Relative change from the previous row, 0 on the first."""
    return F.coalesce(F.try_divide(value, F.lag(value).over(over or by_day())) - 1, F.lit(0.0))


def drawdown(value: Column, over: WindowSpec | None = None) -> Column:
    """Distance below the highest value so far (0 or negative)."""
    so_far = (over or by_day()).rowsBetween(Window.unboundedPreceding, 0)
    return value / F.max(value).over(so_far) - 1


def with_rsi(prices: DataFrame, period: int = 14, over: WindowSpec | None = None) -> DataFrame:
    """Adds ``rsi``: simple rolling means, 50 where undefined.

    The first day counts as no gain and no loss, and a window
    without losses is undefined, so it reads 50 as well.
    """
    step = difference(F.col("close"), over)
    moves = prices.withColumns(
        {
            "_gain": F.when(step > 0, step).otherwise(0.0),
            "_loss": F.when(step < 0, -step).otherwise(0.0),
        }
    )
    strength = F.try_divide(
        rolling_mean(F.col("_gain"), period, over), rolling_mean(F.col("_loss"), period, over)
    )
    return moves.withColumn("rsi", F.coalesce(100 - 100 / (1 + strength), F.lit(50.0))).drop("_gain", "_loss")


def carried_state(enter: Column, leave: Column, over: WindowSpec | None = None) -> Column:
    """1 after the last ``enter``, 0 after the last ``leave``, 0 before both."""
    event = F.when(enter, 1).when(leave, 0)
    frame = (over or by_day()).rowsBetween(Window.unboundedPreceding, 0)
    return F.coalesce(F.last(event, ignorenulls=True).over(frame), F.lit(0))


def signals(
    prices: DataFrame,
    short_window: int = 20,
    long_window: int = 50,
    use_rsi_filter: bool = True,
    rsi_period: int = 14,
    rsi_buy_max: float = 70.0,
    rsi_sell_min: float = 30.0,
) -> DataFrame:
    """Adds ``sma_short, sma_long, rsi, signal, position_change``."""
    if short_window >= long_window:
        raise ValueError("short_window must be smaller than long_window")
    averaged = with_rsi(prices, rsi_period).withColumns(
        {
            "sma_short": rolling_mean(F.col("close"), short_window),
            "sma_long": rolling_mean(F.col("close"), long_window),
        }
    )
    above, below = F.col("sma_short") > F.col("sma_long"), F.col("sma_short") < F.col("sma_long")
    if use_rsi_filter:
        state = carried_state(
            above & (F.col("rsi") <= rsi_buy_max), below & (F.col("rsi") >= rsi_sell_min)
        )
    else:
        state = F.coalesce(above.cast("int"), F.lit(0))
    return averaged.withColumn("signal", state).withColumn(
        "position_change", F.coalesce(difference(F.col("signal")), F.lit(0)).cast("int")
    )


def grid_signals(prices: DataFrame, grid: list[tuple[int, int]]) -> DataFrame:
    """Crossover signals of many (short, long) pairs, one row per pair and day.

    Every distinct window length becomes one column over the same sort; the
    pairs are then unfolded from an array, so prices are shuffled once.
    """
    for short, long in grid:
        if short >= long:
            raise ValueError("short_window must be smaller than long_window")
    sizes = sorted({size for pair in grid for size in pair})
    averaged = prices.withColumns({f"_sma{n}": rolling_mean(F.col("close"), n) for n in sizes})
    choices = [
        F.struct(
            F.lit(short).alias("short_window"),
            F.lit(long).alias("long_window"),
            F.coalesce((F.col(f"_sma{short}") > F.col(f"_sma{long}")).cast("int"), F.lit(0)).alias("signal"),
        )
        for short, long in grid
    ]
    return averaged.select("symbol", "date", "close", F.inline(F.array(*choices)))


def value_metrics(
    values: DataFrame, initial_cash: float, days_per_year: int = 252, keys: tuple[str, ...] = ("symbol",)
) -> DataFrame:
    """Return, risk and drawdown of ``portfolio_value`` per key.

    Needs ``date, portfolio_value, daily_return, action``.
    """
    over = by_day(*keys)
    totals = (
        values.withColumn("_drawdown", drawdown(F.col("portfolio_value"), over))
        .groupBy(*keys)
        .agg(
            F.max_by("portfolio_value", "date").alias("final_portfolio_value"),
            F.avg("daily_return").alias("_mean"),
            F.stddev_samp("daily_return").alias("_std"),
            F.min("_drawdown").alias("max_drawdown"),
            F.count("*").cast("int").alias("num_trading_days"),
            F.count_if(F.col("action") != "HOLD").cast("int").alias("num_trades"),
        )
    )
    growth = F.col("final_portfolio_value") / F.lit(float(initial_cash))
    ratio = F.try_divide(F.col("_mean"), F.col("_std")) * F.sqrt(F.lit(float(days_per_year)))
    return totals.select(
        *keys,
        F.lit(float(initial_cash)).alias("initial_cash"),
        "final_portfolio_value",
        (growth - 1).alias("total_return"),
        (F.pow(growth, days_per_year / F.col("num_trading_days")) - 1).alias("annualized_return"),
        F.coalesce(ratio, F.lit(0.0)).alias("sharpe_ratio"),
        "max_drawdown",
        "num_trading_days",
        "num_trades",
    )
