import math
import statistics

import pytest
from pyspark.sql import functions as F

from quotidian.functions import rolling
from tests.conftest import column


def test_returns_take_the_last_known_price_over_gaps(bars):
    got = column(rolling.simple_return(bars({"A": [10.0, 11.0, None, 12.0]})), "ret")
    assert got == [None, pytest.approx(0.1), 0.0, pytest.approx(1 / 11)]


def test_leading_gap_has_no_return(bars):
    got = column(rolling.simple_return(bars({"A": [None, None, 10.0, 12.0]})), "ret")
    assert got == [None, None, None, pytest.approx(0.2)]


def test_zero_price_gives_null_not_infinity(bars):
    got = column(rolling.simple_return(bars({"A": [1.0, 0.0, 5.0, 10.0]})), "ret")
    assert got == [None, -1.0, None, 1.0]


def test_zero_price_in_the_frame_makes_volatility_null(bars):
    closes = [0.0] + [float(10 + i % 3) for i in range(21)]
    got = column(rolling.realized_volatility(bars({"A": closes})), "realized_vol_20d")
    # The return onto the row after the zero is NULL; the last frame no longer holds it.
    assert got[:21] == [None] * 21 and got[21] is not None


@pytest.mark.parametrize("rows, known", [(20, False), (21, True)])
def test_volatility_needs_twenty_returns(bars, rows, known):
    closes = [100.0 + (i * 7) % 11 for i in range(rows)]
    got = column(rolling.realized_volatility(bars({"A": closes})), "realized_vol_20d")
    assert (got[-1] is not None) == known
    if known:
        returns = [b / a - 1 for a, b in zip(closes, closes[1:])]
        assert got[-1] == pytest.approx(statistics.stdev(returns) * math.sqrt(252))


@pytest.mark.parametrize("rows, known", [(60, False), (61, True)])
def test_momentum_needs_sixty_one_prices(bars, rows, known):
    got = column(rolling.momentum(bars({"A": [float(i + 1) for i in range(rows)]})), "momentum_60d")
    assert got[-1] == (pytest.approx(60.0) if known else None)


def test_windows_and_columns_are_parameters(bars):
    df = bars({"A": [1.0, 2.0, 4.0, 8.0]}).withColumnRenamed("close", "px")
    assert column(rolling.momentum(df, 2, "px", "m"), "m") == [None, None, 3.0, 3.0]
    assert column(rolling.realized_volatility(df, 2, "px", "v"), "v")[2] == pytest.approx(0.0)
    z = column(rolling.mean_reversion_zscore(df, 2, "px", "z"), "z")
    assert z[1] == pytest.approx(0.5 / statistics.stdev([1, 2]))


def test_mean_reversion_null_with_a_gap_in_the_frame(bars):
    closes = [1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0, 8.0, 9.0]
    got = column(rolling.mean_reversion_zscore(bars({"A": closes})), "mean_reversion_zscore_5d")
    assert [v is not None for v in got] == [False] * 8 + [True]


def test_mean_reversion_null_without_spread(bars):
    got = column(rolling.mean_reversion_zscore(bars({"A": [5.0] * 6})), "mean_reversion_zscore_5d")
    assert got == [None] * 6


def test_tickers_do_not_mix(bars):
    df = bars({"A": [1.0, 2.0], "B": [10.0, 30.0]})
    got = rolling.simple_return(df).where(F.col("ret").isNotNull()).orderBy("ticker").collect()
    assert [(r["ticker"], r["ret"]) for r in got] == [("A", 1.0), ("B", 2.0)]
