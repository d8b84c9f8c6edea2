"""What a day needs of the days before it: each ticker's bars inside the lookback, as one row.

The state of a date and the bars after it make the state of a later date, so a day's run reads one state and
what came since instead of every date of the lookback. Features come from a state's bars by the same
operators as from the prices themselves.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def state_of(bars: DataFrame, as_of: date, keep_days: int) -> DataFrame:
    """(ticker, date, bars): the bars of the ``keep_days`` up to ``as_of``, both ends included, oldest first.

    Takes one row per ticker and date; a ticker has a bar a day at most, so no row outgrows the lookback.
    """
    since = as_of - timedelta(days=keep_days)
    inside = bars.where(F.col("date").between(F.lit(since), F.lit(as_of)))
    return inside.groupBy("ticker").agg(
        F.sort_array(F.collect_list(F.struct("date", "close"))).alias("bars")
    ).select("ticker", F.lit(as_of).alias("date"), "bars")


def bars_of(state: DataFrame) -> DataFrame:
    """(ticker, date, close) that a state holds."""
    return state.select("ticker", F.inline("bars"))


def last_closes(state: DataFrame) -> DataFrame:
    """(ticker, date, close) of each ticker's last bar."""
    last = F.element_at("bars", -1)
    return state.select("ticker", last["date"].alias("date"), last["close"].alias("close"))
