"""Price features as of one date, or for a whole calendar of dates in one job."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotidian import schemas
from quotidian.functions import rolling, scalar

VOL, MOM, REV = schemas.PRICE_FEATURE_COLUMNS


def rolling_price_features(prices: DataFrame) -> DataFrame:
    """Every bar with its three features; other columns are kept.

    Takes one row per ticker and date.
    """
    window = rolling.by_ticker()
    known = prices.withColumn("filled", rolling.forward_filled("close", window))
    before = {n: F.lag("filled", n).over(window) for n in (1, schemas.MOMENTUM_WINDOW)}
    changes = {n: F.try_divide(F.col("filled"), value) - 1 for n, value in before.items()}
    returns = rolling.with_finite(known, **{"ret": changes[1], MOM: changes[schemas.MOMENTUM_WINDOW]})
    return rolling.with_finite(
        returns,
        **{
            VOL: rolling.volatility_of("ret", schemas.VOLATILITY_WINDOW, window),
            REV: rolling.mean_reversion_of("close", schemas.MEAN_REVERSION_WINDOW, window),
        },
    ).drop("filled", "ret")


def price_features_as_of(
    prices: DataFrame,
    as_of: date,
    lookback_days: int = schemas.FEATURE_LOOKBACK_DAYS,
    min_rows: int = schemas.MIN_HISTORY_ROWS,
    shared: bool = False,
) -> DataFrame:
    """The features of every ticker's last bar in the lookback, dated ``as_of``.

    The lookback holds both of its end dates. Tickers with fewer than ``min_rows`` bars in it are
    left out; a ticker without a bar on ``as_of`` itself is carried forward from its last one.

    ``shared`` is for results that feed several branches of one plan, as scores and books do: see
    ``shared_by_branches``.
    """
    window = rolling.by_ticker()
    since = as_of - timedelta(days=lookback_days)
    history = prices.where(F.col("date").between(F.lit(since), F.lit(as_of)))
    bars = (
        rolling_price_features(history.select("ticker", "date", "close"))
        .withColumn("bar_no", F.row_number().over(window))
        .withColumn("next_date", F.lead("date", 1).over(window))
    )
    # No bar is later than as_of, so the greatest of both is as_of. A plain literal would be folded
    # into the join with the date's statistics, which would then have no key left to join on.
    dated = F.greatest(F.col("date"), F.lit(as_of)).alias("date")
    latest = bars.where(F.col("next_date").isNull() & (F.col("bar_no") >= min_rows)).select(
        "ticker", dated, VOL, MOM, REV
    )
    return shared_by_branches(latest) if shared else latest


def shared_by_branches(rows: DataFrame) -> DataFrame:
    """The same rows behind a shuffle that all branches of a plan read.

    Spark runs equal shuffles once. Without this one, each branch would sort and window the bars
    again; with it they are windowed once and the far fewer resulting rows are shuffled.
    """
    return rows.hint("rebalance", F.col("ticker"))


def price_features_panel(
    prices: DataFrame,
    dates: DataFrame,
    lookback_days: int = schemas.FEATURE_LOOKBACK_DAYS,
    min_rows: int = schemas.MIN_HISTORY_ROWS,
    first: date | None = None,
    last: date | None = None,
    shared: bool = False,
) -> DataFrame:
    """``price_features_as_of`` for every date of ``dates`` at once.

    A bar stands for its ticker from its own date until the day before the next bar, as long as
    the ``min_rows``-th bar back is still inside the lookback. That span is known on the bar's own
    row, so each bar is expanded to its span (at most ``lookback_days + 1`` days) and matched with
    the wanted dates; no grid of all tickers by all dates is built.

    A feature that reaches further back than its ticker's gate is NULL on the dates whose lookback
    no longer holds the oldest price it uses. With filled gaps that price may be older than the row
    it fills, hence the dates of known prices are carried along.

    ``first`` and ``last`` bound the wanted dates, where known, and so the scan and the spans.
    """
    window = rolling.by_ticker()
    if first is not None:
        prices = prices.where(F.col("date") >= F.lit(first - timedelta(days=lookback_days)))
    if last is not None:
        prices = prices.where(F.col("date") <= F.lit(last))

    dated = prices.select(
        "ticker", "date", "close", F.when(scalar.finite("close").isNotNull(), F.col("date")).alias("known")
    )
    bars = (
        rolling_price_features(dated)
        .withColumn("price_date", rolling.last_known("known", window))
        .withColumn("gate_date", F.lag("date", min_rows - 1).over(window))
        .withColumn("next_date", F.lead("date", 1).over(window))
        .withColumn("vol_from", F.lag("price_date", schemas.VOLATILITY_WINDOW).over(window))
        .withColumn("mom_from", F.lag("price_date", schemas.MOMENTUM_WINDOW).over(window))
        .withColumn("rev_from", F.lag("date", schemas.MEAN_REVERSION_WINDOW - 1).over(window))
    )
    until = F.least(F.date_sub("next_date", 1), F.date_add("gate_date", lookback_days))
    since = F.col("date")
    if first is not None:
        since = F.greatest(since, F.lit(first))
    if last is not None:
        until = F.least(until, F.lit(last))
    spans = bars.withColumns({"since": since, "until": until}).where(
        F.col("gate_date").isNotNull() & (F.col("until") >= F.col("since"))
    )
    if shared:
        spans = shared_by_branches(spans)
    spans = spans.withColumn("as_of", F.explode(F.sequence("since", "until")))
    # One row per calendar day at most: DateType itself bounds what is broadcast.
    wanted = F.broadcast(dates.select(F.col("date").cast("date").alias("as_of")).distinct())
    oldest = F.date_sub("as_of", lookback_days)

    def inside(value: str, since: str) -> Column:
        return F.when(F.col(since) >= oldest, F.col(value)).alias(value)

    return spans.join(wanted, "as_of", "left_semi").select(
        "ticker",
        F.col("as_of").alias("date"),
        inside(VOL, "vol_from"),
        inside(MOM, "mom_from"),
        inside(REV, "rev_from"),
    )


def ticker_features(features: DataFrame, ticker: str) -> DataFrame:
    """One ticker's features. The predicate moves below the windows, whose partition key it is."""
    return features.where(F.col("ticker") == ticker)
