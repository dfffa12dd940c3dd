"""Price analysis: order priorities are the symbols, order totals the prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators import ledger, series
from tabloom.plans import Query
from tabloom.session import load

CASH = 10_000_000.0
GRID = [(3, 8), (5, 12), (10, 30)]


def _prices(spark: SparkSession, folder: str) -> DataFrame:
    raw = load(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_orderdate").alias("Date"), F.col("o_totalprice").alias("Close")
    )
    return series.daily_prices(raw, symbol="o_orderpriority", seq="o_orderkey")


def price_series(spark, folder):
    return _prices(spark, folder).orderBy("symbol", "date")


def price_window(spark, folder):
    return series.between_dates(_prices(spark, folder), "1994-01-01", "1996-01-01")


def sma_signals(spark, folder):
    rows = series.signals(_prices(spark, folder), 5, 12, use_rsi_filter=False)
    return rows.select("symbol", "date", _r("sma_short"), _r("sma_long"), "signal", "position_change")


def rsi(spark, folder):
    return series.with_rsi(_prices(spark, folder), 14).select("symbol", "date", _r("rsi", 6))


def rsi_filtered_signals(spark, folder):
    rows = series.signals(_prices(spark, folder), 5, 12, True, 7, 55.0, 45.0)
    return rows.select("symbol", "date", "signal", "position_change")


def default_signals(spark, folder):
    rows = series.signals(_prices(spark, folder))
    return rows.select("symbol", "date", _r("sma_short"), _r("sma_long"), _r("rsi", 6), "signal", "position_change")


def daily_returns(spark, folder):
    return _prices(spark, folder).select("symbol", "date", F.round(series.pct_change(F.col("close")), 8).alias("daily_return"))


def drawdowns(spark, folder):
    return _prices(spark, folder).select("symbol", "date", F.round(series.drawdown(F.col("close")), 8).alias("drawdown"))


def series_metrics(spark, folder):
    values = _prices(spark, folder).select(
        "symbol", "date", F.col("close").alias("portfolio_value"),
        series.pct_change(F.col("close")).alias("daily_return"), F.lit("HOLD").alias("action"),
    )
    return _rounded(series.value_metrics(values, 200_000.0))


def _ledger(spark, folder, cash: float = CASH) -> DataFrame:
    signals = series.signals(_prices(spark, folder), 5, 12, use_rsi_filter=False)
    return ledger.position_ledger(signals, cash)


def _ledger_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "symbol", "date", _r("close", 2), "signal", "action", _r("cash", 6), "shares",
        _r("holdings_value", 6), _r("portfolio_value", 6), _r("daily_return", 8),
    )


def position_ledger(spark, folder):
    return _ledger_columns(_ledger(spark, folder))


def small_cash_ledger(spark, folder):
    """Cash that mostly buys nothing: orders are tried again until affordable."""
    return _ledger_columns(_ledger(spark, folder, 10_000.0))


def trades(spark, folder):
    return ledger.trades(_ledger(spark, folder)).select(
        "symbol", "date", "action", _r("price", 2), "shares", _r("notional", 6), _r("fee", 6)
    )


def trade_marks(spark, folder):
    return _ledger(spark, folder).groupBy("symbol").agg(
        F.count_if(F.col("action") == "BUY").alias("buys"), F.count_if(F.col("action") == "SELL").alias("sells")
    )


def portfolio_metrics(spark, folder):
    return _rounded(series.value_metrics(_ledger(spark, folder), CASH))


def param_grid(spark, folder):
    keys = ("symbol", "short_window", "long_window")
    signals = series.grid_signals(_prices(spark, folder), GRID)
    return _rounded(series.value_metrics(ledger.position_ledger(signals, CASH, keys=keys), CASH, keys=keys), keys)


def _r(column: str, places: int = 4):
    return F.round(column, places).alias(column)


def _rounded(metrics: DataFrame, keys=("symbol",)) -> DataFrame:
    return metrics.select(
        *keys, "initial_cash", _r("final_portfolio_value", 6), _r("total_return", 6), _r("annualized_return", 6),
        _r("sharpe_ratio", 6), _r("max_drawdown", 6), "num_trading_days", "num_trades",
    )


_PRICES = """
prices AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date, arg_min(o_totalprice, o_orderkey) AS close
  FROM orders GROUP BY 1, 2)"""
_ROLL = "OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
_W = "OVER (PARTITION BY symbol ORDER BY date)"


def _sma(size: int, value: str = "close") -> str:
    frame = _ROLL.format(n=size - 1)
    return f"CASE WHEN count({value}) {frame} = {size} THEN avg({value}) {frame} END"


def _signal_sql(short: int, long: int, rsi: int, extra: str = "") -> str:
    """CTEs up to ``s``: prices with averages, RSI and the plain crossover."""
    return f"""{_PRICES},
moves AS (
  SELECT *, CASE WHEN close > lag(close) {_W} THEN close - lag(close) {_W} ELSE 0.0::DOUBLE END AS gain,
         CASE WHEN close < lag(close) {_W} THEN lag(close) {_W} - close ELSE 0.0::DOUBLE END AS loss
  FROM prices),
s AS (
  SELECT symbol, date, close, {_sma(short)} AS sma_short, {_sma(long)} AS sma_long,
         coalesce(100 - 100 / (1 + ({_sma(rsi, 'gain')}) / nullif({_sma(rsi, 'loss')}, 0)), 50.0::DOUBLE) AS rsi
  FROM moves)"""


def _state_sql(buy_max: float, sell_min: float) -> str:
    return f"""
events AS (
  SELECT *, CASE WHEN sma_short > sma_long AND rsi <= {buy_max} THEN 1
                 WHEN sma_short < sma_long AND rsi >= {sell_min} THEN 0 END AS event
  FROM s),
state AS (
  SELECT *, coalesce(last_value(event IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS signal
  FROM events)"""


def _fold_sql(cash: float) -> str:
    """Recursive fold over ``numbered(series, i, close, signal, ...)``."""
    return f"""
steps AS (
  SELECT series, 0::BIGINT AS i, {cash}::DOUBLE AS cash, 0::BIGINT AS shares, 'HOLD' AS action,
         0::BIGINT AS traded, 0.0::DOUBLE AS notional
  FROM (SELECT DISTINCT series FROM numbered)
  UNION ALL
  SELECT n.series, n.i,
    CASE WHEN n.signal = 1 AND p.shares = 0 AND floor(p.cash / n.close) > 0
         THEN p.cash - (floor(p.cash / n.close) * n.close + floor(p.cash / n.close) * n.close * 0.0005::DOUBLE)
         WHEN n.signal = 0 AND p.shares > 0
         THEN p.cash + (p.shares * n.close - p.shares * n.close * 0.0005::DOUBLE) ELSE p.cash END,
    CASE WHEN n.signal = 1 AND p.shares = 0 THEN floor(p.cash / n.close)::BIGINT
         WHEN n.signal = 0 THEN 0 ELSE p.shares END,
    CASE WHEN n.signal = 1 AND p.shares = 0 AND floor(p.cash / n.close) > 0 THEN 'BUY'
         WHEN n.signal = 0 AND p.shares > 0 THEN 'SELL' ELSE 'HOLD' END,
    CASE WHEN n.signal = 1 AND p.shares = 0 THEN floor(p.cash / n.close)::BIGINT
         WHEN n.signal = 0 THEN p.shares ELSE 0 END,
    CASE WHEN n.signal = 1 AND p.shares = 0 THEN floor(p.cash / n.close) * n.close
         WHEN n.signal = 0 THEN p.shares * n.close ELSE 0.0::DOUBLE END
  FROM steps p JOIN numbered n ON n.series = p.series AND n.i = p.i + 1),
hist AS (
  SELECT n.*, t.action, t.cash, t.shares, t.traded, t.notional,
         t.shares * n.close AS holdings_value, t.cash + t.shares * n.close AS portfolio_value
  FROM steps t JOIN numbered n ON n.series = t.series AND n.i = t.i),
history AS (
  SELECT *, coalesce(portfolio_value / lag(portfolio_value) OVER (PARTITION BY series ORDER BY i) - 1, 0.0::DOUBLE)
              AS daily_return,
         portfolio_value / max(portfolio_value) OVER (PARTITION BY series ORDER BY i) - 1 AS dd
  FROM hist)"""


def _metrics_sql(keys: str, cash: float) -> str:
    return f"""
SELECT {keys}, {cash}::DOUBLE AS initial_cash, round(final, 6) AS final_portfolio_value,
       round(final / {cash} - 1, 6) AS total_return,
       round(pow(final / {cash}, 252.0 / days) - 1, 6) AS annualized_return,
       round(CASE WHEN coalesce(sd, 0) = 0 THEN 0.0::DOUBLE ELSE mean / sd * sqrt(252.0) END, 6) AS sharpe_ratio,
       round(dd, 6) AS max_drawdown, days::INTEGER AS num_trading_days, n::INTEGER AS num_trades
FROM (SELECT {keys}, arg_max(portfolio_value, date) AS final, avg(daily_return) AS mean,
             stddev_samp(daily_return) AS sd, min(dd) AS dd, count(*) AS days,
             count(*) FILTER (action <> 'HOLD') AS n
      FROM history GROUP BY {keys})"""


_CROSS = "CASE WHEN sma_short > sma_long THEN 1 ELSE 0 END"
_CHANGE = f"coalesce(signal - lag(signal) {_W}, 0)"
_NUMBERED = f"""
numbered AS (SELECT symbol AS series, symbol, date, close, {_CROSS} AS signal, row_number() {_W} AS i FROM s)"""


def _ledger_sql(cash: float) -> str:
    return f"""WITH RECURSIVE {_signal_sql(5, 12, 14)}, {_NUMBERED}, {_fold_sql(cash)}"""


_LEDGER_SELECT = """
SELECT symbol, date, round(close, 2) AS close, signal, action, round(cash, 6) AS cash, shares,
       round(holdings_value, 6) AS holdings_value, round(portfolio_value, 6) AS portfolio_value,
       round(daily_return, 8) AS daily_return FROM history"""

_GRID_NUMBERED = "numbered AS (" + " UNION ALL ".join(
    f"""SELECT symbol || '/{a}/{b}' AS series, symbol, {a} AS short_window, {b} AS long_window, date, close,
        CASE WHEN ({_sma(a)}) > ({_sma(b)}) THEN 1 ELSE 0 END AS signal, row_number() {_W} AS i FROM prices"""
    for a, b in GRID
) + ")"

QUERIES = {
    "price_series": Query(price_series, f"WITH {_PRICES} SELECT * FROM prices"),
    "price_window": Query(
        price_window,
        f"WITH {_PRICES} SELECT * FROM prices WHERE date >= DATE '1994-01-01' AND date < DATE '1996-01-01'",
    ),
    "sma_signals": Query(
        sma_signals,
        f"""WITH {_signal_sql(5, 12, 14)}, state AS (SELECT *, {_CROSS} AS signal FROM s)
SELECT symbol, date, round(sma_short, 4) AS sma_short, round(sma_long, 4) AS sma_long, signal,
       {_CHANGE} AS position_change FROM state""",
    ),
    "rsi": Query(rsi, f"WITH {_signal_sql(5, 12, 14)} SELECT symbol, date, round(rsi, 6) AS rsi FROM s"),
    "rsi_filtered_signals": Query(
        rsi_filtered_signals,
        f"""WITH {_signal_sql(5, 12, 7)}, {_state_sql(55, 45)}
SELECT symbol, date, signal, {_CHANGE} AS position_change FROM state""",
    ),
    "default_signals": Query(
        default_signals,
        f"""WITH {_signal_sql(20, 50, 14)}, {_state_sql(70, 30)}
SELECT symbol, date, round(sma_short, 4) AS sma_short, round(sma_long, 4) AS sma_long, round(rsi, 6) AS rsi,
       signal, {_CHANGE} AS position_change FROM state""",
    ),
    "daily_returns": Query(
        daily_returns,
        f"""WITH {_PRICES}
SELECT symbol, date, round(coalesce(close / lag(close) {_W} - 1, 0), 8) AS daily_return FROM prices""",
    ),
    "drawdowns": Query(
        drawdowns,
        f"WITH {_PRICES} SELECT symbol, date, round(close / max(close) {_W} - 1, 8) AS drawdown FROM prices",
    ),
    "series_metrics": Query(
        series_metrics,
        f"""WITH {_PRICES}, history AS (
  SELECT symbol, date, close AS portfolio_value, 'HOLD' AS action,
         coalesce(close / lag(close) {_W} - 1, 0) AS daily_return, close / max(close) {_W} - 1 AS dd FROM prices)
{_metrics_sql('symbol', 200000.0)}""",
    ),
    "position_ledger": Query(position_ledger, _ledger_sql(CASH) + _LEDGER_SELECT),
    "small_cash_ledger": Query(small_cash_ledger, _ledger_sql(10000.0) + _LEDGER_SELECT),
    "trades": Query(
        trades,
        _ledger_sql(CASH)
        + """
SELECT symbol, date, action, round(close, 2) AS price, traded AS shares, round(notional, 6) AS notional,
       round(notional * 0.0005::DOUBLE, 6) AS fee FROM history WHERE action <> 'HOLD'""",
    ),
    "trade_marks": Query(
        trade_marks,
        _ledger_sql(CASH)
        + """
SELECT symbol, count(*) FILTER (action = 'BUY') AS buys, count(*) FILTER (action = 'SELL') AS sells
FROM history GROUP BY symbol""",
    ),
    "portfolio_metrics": Query(portfolio_metrics, _ledger_sql(CASH) + _metrics_sql("symbol", CASH)),
    "param_grid": Query(
        param_grid,
        f"WITH RECURSIVE {_PRICES}, {_GRID_NUMBERED}, {_fold_sql(CASH)}"
        + _metrics_sql("symbol, short_window, long_window", CASH),
    ),
}
