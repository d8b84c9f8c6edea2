"""Rolling columns over the bars of a ticker.

Offsets count rows, not calendar days. Every column here is over the same partition and order, so
Spark plans one shuffle and one sort however many of them a query uses. A partition is one
ticker's bars, at most one per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window

from quotidian import schemas
from quotidian.functions import scalar


def by_ticker(keys: Sequence[str] = ("ticker",), order: Sequence[str] = ("date",)) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def last_rows(window: WindowSpec, n: int) -> WindowSpec:
    return window.rowsBetween(1 - n, Window.currentRow)


def forward_filled(price: str, window: WindowSpec) -> Column:
    """The last known price at or before the row; one that is not finite is not known."""
    return last_known(scalar.finite(price), window)


def last_known(value: Column | str, window: WindowSpec) -> Column:
    """The last value that is not NULL at or before the row."""
    up_to_here = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(value, ignorenulls=True).over(up_to_here)


def with_finite(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns, NULL where they come out too large for a number. Judging them in a step of their own
    keeps window functions from being computed twice."""
    return df.withColumns(columns).withColumns({c: scalar.finite(c) for c in columns})


def complete(value: Column, count: Column, n: int) -> Column:
    """``value`` only where its frame holds ``n`` non-null inputs."""
    return F.when(count == n, value)


def simple_return(
    df: DataFrame,
    price_col: str = "close",
    out: str = "ret",
    periods: int = 1,
    window: WindowSpec | None = None,
) -> DataFrame:
    """Return over ``periods`` rows; gaps take the last known price, a zero base gives NULL."""
    window = window or by_ticker()
    filled = f"__{out}_filled"
    known = df.withColumn(filled, forward_filled(price_col, window))
    change = F.try_divide(F.col(filled), F.lag(filled, periods).over(window)) - 1
    return with_finite(known, **{out: change}).drop(filled)


def realized_volatility(
    df: DataFrame,
    window_rows: int = schemas.VOLATILITY_WINDOW,
    price_col: str = "close",
    out: str = "realized_vol_20d",
    window: WindowSpec | None = None,
) -> DataFrame:
    """Annualised sample deviation of the last returns; NULL until the frame is full."""
    window = window or by_ticker()
    ret = f"__{out}_ret"
    returns = simple_return(df, price_col, ret, window=window)
    return with_finite(returns, **{out: volatility_of(ret, window_rows, window)}).drop(ret)


def volatility_of(ret: str, window_rows: int, window: WindowSpec) -> Column:
    frame = last_rows(window, window_rows)
    annualised = F.stddev_samp(ret).over(frame) * F.sqrt(F.lit(schemas.TRADING_DAYS_PER_YEAR))
    return complete(annualised, F.count(ret).over(frame), window_rows)


def momentum(
    df: DataFrame,
    window_rows: int = schemas.MOMENTUM_WINDOW,
    price_col: str = "close",
    out: str = "momentum_60d",
    window: WindowSpec | None = None,
) -> DataFrame:
    """Return over ``window_rows`` rows."""
    return simple_return(df, price_col, out, window_rows, window)


def mean_reversion_zscore(
    df: DataFrame,
    window_rows: int = schemas.MEAN_REVERSION_WINDOW,
    price_col: str = "close",
    out: str = "mean_reversion_zscore_5d",
    window: WindowSpec | None = None,
) -> DataFrame:
    """Distance from the rolling mean in rolling sample deviations, on unfilled prices."""
    return with_finite(df, **{out: mean_reversion_of(price_col, window_rows, window or by_ticker())})


def mean_reversion_of(price_col: str, window_rows: int, window: WindowSpec) -> Column:
    frame = last_rows(window, window_rows)
    price = scalar.finite(price_col)
    distance = price - F.avg(price).over(frame)
    zscore = F.try_divide(distance, F.stddev_samp(price).over(frame))
    return complete(zscore, F.count(price).over(frame), window_rows)
