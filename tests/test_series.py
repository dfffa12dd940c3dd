import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tabloom.operators import ledger, series

# Closes of a sample series on consecutive trading days, 2024-01-02 to 2024-03-15.
SAMPLE = [
    100, 101, 102, 101, 103, 104, 105, 104, 106, 107, 109, 108, 110, 111, 113, 112, 114, 115, 117, 116, 118, 119,
    117, 120, 121, 123, 122, 124, 125, 126, 127, 125, 128, 129, 130, 131, 130, 132, 133, 134, 136, 135, 137, 138,
    139, 140, 141, 142, 141, 143, 144, 145,
]


def prices(spark, closes, symbol="s"):
    start = datetime.date(2024, 1, 1)
    rows = [(symbol, start + datetime.timedelta(days=i), float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, date date, close double")


def run(spark, closes, cash=10_000.0, **kwargs):
    return ledger.position_ledger(series.signals(prices(spark, closes), **kwargs), cash)


def test_daily_prices_takes_first_non_null_row_of_a_day(spark):
    raw = spark.createDataFrame(
        [(1, "2024-01-02", None), (2, "2024-01-02", 5.0), (3, "2024-01-02", 6.0), (4, "2024-01-01", 1.0), (5, None, 2.0)],
        "seq int, Date string, `Adj Close` double",
    )
    rows = series.daily_prices(raw, seq="seq").orderBy("date").collect()
    assert [(str(r["date"]), r["close"]) for r in rows] == [("2024-01-01", 1.0), ("2024-01-02", 5.0)]


def test_daily_prices_prefers_close_and_reports_missing_columns(spark):
    both = spark.createDataFrame([("2024-01-02", 1.0, 2.0)], "Date string, adj_close double, Close double")
    assert series.daily_prices(both).head()["close"] == 2.0
    with pytest.raises(ValueError):
        series.daily_prices(both.drop("Date"))
    with pytest.raises(ValueError):
        series.daily_prices(both.select("Date"))


def test_short_window_must_be_smaller(spark):
    with pytest.raises(ValueError):
        series.signals(prices(spark, [1, 2]), 5, 5)
    with pytest.raises(ValueError):
        series.grid_signals(prices(spark, [1, 2]), [(3, 2)])


def test_rsi_reads_50_without_losses_and_before_the_window_fills(spark):
    rising = series.with_rsi(prices(spark, range(1, 40)), 14).collect()
    assert {r["rsi"] for r in rising} == {50.0}
    mixed = series.with_rsi(prices(spark, [10, 12, 11, 13]), 3).orderBy("date").collect()
    # Day 3 sees gains 0, 2, 0 and losses 0, 0, 1.
    assert [round(r["rsi"], 6) for r in mixed] == [50.0, 50.0, round(100 - 100 / 3, 6), 80.0]


def test_carried_state_equals_a_loop(spark):
    rng = random.Random(5)
    closes = [100 + rng.randint(-20, 20) for _ in range(300)]
    rows = series.signals(prices(spark, closes), 3, 8, True, 5, 60.0, 40.0).orderBy("date").collect()
    state = 0
    for row in rows:
        if row["sma_long"] is not None:
            if row["sma_short"] > row["sma_long"] and row["rsi"] <= 60:
                state = 1
            elif row["sma_short"] < row["sma_long"] and row["rsi"] >= 40:
                state = 0
        assert row["signal"] == state


@pytest.mark.parametrize(
    "windows, day, price, shares, fee, final, total, yearly, sharpe, drawdown",
    [
        ((20, 50), 49, 143, 69, 4.9335, 10133.0665, 0.01330665, 0.06615721, 3.02318100, -0.00049335),
        ((3, 8), 7, 104, 96, 4.992, 13931.008, 0.39310080, 3.98610647, 10.31669201, -0.01679054),
    ],
)
def test_sample_portfolio(spark, windows, day, price, shares, fee, final, total, yearly, sharpe, drawdown):
    held = run(spark, SAMPLE, short_window=windows[0], long_window=windows[1], use_rsi_filter=False)
    (trade,) = ledger.trades(held).collect()
    assert trade["action"] == "BUY" and trade["price"] == price and trade["shares"] == shares
    assert (trade["date"] - datetime.date(2024, 1, 1)).days == day
    assert trade["notional"] == price * shares and math.isclose(trade["fee"], fee)
    m = series.value_metrics(held, 10_000.0).head()
    assert m["num_trades"] == 1 and m["num_trading_days"] == 52
    for name, value in (
        ("final_portfolio_value", final), ("total_return", total), ("annualized_return", yearly),
        ("sharpe_ratio", sharpe), ("max_drawdown", drawdown),
    ):
        assert math.isclose(m[name], value, abs_tol=6e-9 * max(1, abs(value))), name


def test_unaffordable_order_is_tried_again(spark):
    signals = prices(spark, [50, 40, 9, 12]).withColumn("signal", F.lit(1))
    rows = ledger.position_ledger(signals, 30.0, 0.0).orderBy("date").collect()
    assert [r["action"] for r in rows] == ["HOLD", "HOLD", "BUY", "HOLD"]
    assert [r["shares"] for r in rows] == [0, 0, 3, 3] and rows[-1]["portfolio_value"] == 39.0


def test_flat_and_single_day_series_have_sharpe_zero(spark):
    for closes in ([7] * 60, [7]):
        m = series.value_metrics(run(spark, closes), 10_000.0).head()
        assert m["sharpe_ratio"] == 0.0 and m["num_trades"] == 0 and m["total_return"] == 0.0


def test_grid_equals_single_runs(spark):
    grid = series.grid_signals(prices(spark, SAMPLE), [(2, 5), (3, 8)])
    for short, long in ((2, 5), (3, 8)):
        one = series.signals(prices(spark, SAMPLE), short, long, use_rsi_filter=False).select("date", "signal")
        part = grid.where((F.col("short_window") == short) & (F.col("long_window") == long)).select("date", "signal")
        assert sorted(one.collect()) == sorted(part.collect())


def test_one_exchange_serves_all_window_columns(spark):
    raw = prices(spark, SAMPLE).withColumnRenamed("date", "Date")
    plan = series.signals(series.daily_prices(raw, "symbol"), 3, 8)._jdf.queryExecution().executedPlan().toString()
    # One for the daily prices, one by symbol for every window.
    assert plan.count("Exchange hashpartitioning") == 2


def test_ledger_does_not_depend_on_the_length_of_runs(spark, monkeypatch):
    rng = random.Random(11)
    closes = [rng.choice([None, 20.0, 35.0, 50.0, 400.0]) if i % 9 == 0 else rng.uniform(20, 120) for i in range(600)]
    start = datetime.date(2000, 1, 1)
    days = [("ab"[i % 2], start + datetime.timedelta(days=i), c, rng.choice([0, 1, 1, None])) for i, c in enumerate(closes)]
    signals = spark.createDataFrame(days, "symbol string, date date, close double, signal int")
    got = {}
    for length in (1, 7, 256, 10_000):
        monkeypatch.setattr(ledger, "RUN", length)
        got[length] = ledger.position_ledger(signals, 200.0).orderBy("date").collect()
    assert len(got[1]) == 600 and {r.action for r in got[1]} == {"BUY", "SELL", "HOLD"}
    assert all(repr(rows) == repr(got[1]) for rows in got.values())
