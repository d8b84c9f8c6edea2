"""Queries on the marts. All take DataFrames, stored or computed, and return DataFrames."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotidian import schemas
from quotidian.functions import scalar
from quotidian.operators.features import price_features_as_of, price_features_panel
from quotidian.operators.positions import bottom_per_date, top_per_date
from quotidian.sources.prices import last_bars
from quotidian.sources.universe import enrich

SIDES = ("long", "short")


def on_date(df: DataFrame, as_of: date | None = None) -> DataFrame:
    """Rows of a date, of the latest one by default. Empty for an empty table."""
    if as_of is not None:
        return df.where(F.col("date") == F.lit(as_of))
    return df.where(F.col("date") == df.agg(F.max("date")).scalar())


def latest_signal_scores(
    scores: DataFrame, universe: DataFrame, as_of: date | None = None, sector: str | None = None
) -> DataFrame:
    """(ticker, date, signal_score, company, sector), best first, unscored last."""
    day = enrich(on_date(scores, as_of).select("ticker", "date", "signal_score"), universe)
    if sector is not None:
        day = day.where(F.col("sector") == sector)
    return day.orderBy(F.desc_nulls_last("signal_score"), "ticker")


def latest_positions(
    positions: DataFrame,
    universe: DataFrame,
    as_of: date | None = None,
    position_type: str | None = None,
) -> DataFrame:
    """(ticker, date, position_type, signal_score, rank, company, sector) by type and rank.

    The latest date is that of the whole table, also when only one side is asked for.
    """
    day = on_date(positions, as_of).select(*schemas.POSITIONS.names)
    if position_type is not None:
        day = day.where(F.col("position_type") == position_type)
    return enrich(day, universe).orderBy("position_type", "rank")


def positions_of(positions: DataFrame, as_of: date) -> DataFrame:
    """The stored book of a date."""
    return positions.where(F.col("date") == F.lit(as_of)).orderBy("position_type", "rank")


def sector_exposure(
    positions: DataFrame, universe: DataFrame, as_of: date | None = None
) -> DataFrame:
    """(sector, long_count, short_count, net_exposure), largest net first; unknown sectors do not
    count. Both counts are always there."""
    held = enrich(on_date(positions, as_of), universe).where(F.col("sector").isNotNull())
    counts = held.groupBy("sector").agg(
        *[F.count_if(F.col("position_type") == side).alias(f"{side}_count") for side in SIDES]
    )
    return counts.withColumn(
        "net_exposure", F.col("long_count") - F.col("short_count")
    ).orderBy(F.desc("net_exposure"), "sector")


def exposure_series(exposure: DataFrame) -> DataFrame:
    """Chart form of the exposure: longs up, shorts down."""
    return exposure.select(
        "sector", F.col("long_count").alias("longs"), (-F.col("short_count")).alias("shorts")
    )


def available_dates(scores: DataFrame) -> DataFrame:
    """Distinct score dates, latest first."""
    return scores.select("date").distinct().orderBy(F.desc("date"))


def available_tickers(scores: DataFrame, as_of: date | None = None) -> DataFrame:
    """Distinct tickers scored on a date, ascending."""
    return on_date(scores, as_of).select("ticker").distinct().orderBy("ticker")


def latest_score_date(scores: DataFrame, ticker: str) -> DataFrame:
    """One row (date): the ticker's latest score date, else the latest of all."""
    own = F.max(F.when(F.col("ticker") == ticker, F.col("date")))
    return scores.agg(F.coalesce(own, F.max("date")).alias("date"))


def candidates_from_positions(
    positions: DataFrame,
    universe: DataFrame,
    side: str,
    as_of: date | None = None,
    sector: str | None = None,
) -> DataFrame:
    """One side of the book with the sector filter after the cut, so ranks may have gaps."""
    book = latest_positions(positions, universe, as_of, side)
    return book.where(F.col("sector") == sector) if sector is not None else book


def candidates_from_scores(
    scores: DataFrame,
    universe: DataFrame,
    side: str,
    as_of: date | None = None,
    sector: str | None = None,
    n: int = schemas.BOOK_SIZE,
) -> DataFrame:
    """First or last ``n`` of the day's scores with the sector filter before the cut. Unscored
    tickers are at the end of the order, hence possible among the shorts."""
    day = enrich(on_date(scores, as_of).select("ticker", "date", "signal_score"), universe)
    if sector is not None:
        day = day.where(F.col("sector") == sector)
    cut = top_per_date if side == "long" else bottom_per_date
    return cut(day, n).withColumn("rank", F.col("rank").cast("int")).orderBy("rank")


def market_overview(
    scores: DataFrame,
    positions: DataFrame,
    universe: DataFrame,
    as_of: date | None = None,
    sector: str | None = None,
) -> dict[str, DataFrame]:
    """Long and short candidates and the exposure. A side without positions on the date is taken
    from the scores; testing for that reads one row of the stored book."""
    tables = {}
    for side in SIDES:
        if latest_positions(positions, universe, as_of, side).isEmpty():
            tables[side] = candidates_from_scores(scores, universe, side, as_of, sector)
        else:
            tables[side] = candidates_from_positions(positions, universe, side, as_of, sector)
    tables["exposure"] = sector_exposure(positions, universe, as_of)
    return tables


def ticker_score(scores: DataFrame, ticker: str, as_of: date | None = None) -> DataFrame:
    """(ticker, date, signal_score, signal_class) of one ticker; empty if it is not scored."""
    return (
        on_date(scores, as_of)
        .where(F.col("ticker") == ticker)
        .select("ticker", "date", "signal_score", scalar.signal_class("signal_score").alias("signal_class"))
    )


def volatility_bands(
    prices: DataFrame, features: DataFrame, ticker: str, bars: int = schemas.HISTORY_BARS
) -> DataFrame:
    """Price history with bands one volatility above and below; NULL bands without a volatility."""
    history = last_bars(prices.select("ticker", "date", "close"), ticker, bars)
    width = features.where(F.col("ticker") == ticker).select(
        "ticker", scalar.band_width("realized_vol_20d").alias("width")
    )
    return history.join(width, "ticker", "left").select(
        "date",
        "close",
        (F.col("close") * (1 + F.col("width"))).alias("upper_band"),
        (F.col("close") * (1 - F.col("width"))).alias("lower_band"),
    ).orderBy("date")


def feature_breakdown(features: DataFrame) -> DataFrame:
    """(ticker, date, feature_name, value, description), known values only.

    The labels are a fixed list of three, so they are a map in the expression and need no join.
    """
    def lookup(place: int):
        pairs = [F.lit(v) for label in schemas.FEATURE_LABELS for v in (label[0], label[place])]
        return F.create_map(*pairs)[F.col("feature")]

    return (
        features.unpivot(
            ["ticker", "date"], list(schemas.PRICE_FEATURE_COLUMNS), "feature", "value"
        )
        .where(F.col("value").isNotNull())
        .select(
            "ticker", "date", lookup(1).alias("feature_name"), "value", lookup(2).alias("description")
        )
    )


def features_of_ticker(
    prices: DataFrame,
    scores: DataFrame,
    ticker: str,
    as_of: date | None = None,
    lookback_days: int = schemas.FEATURE_LOOKBACK_DAYS,
) -> DataFrame:
    """A ticker's features as of a date, by default its latest score date, else the latest of all.

    The default date is found inside the plan: features are asked for on a calendar of one date.
    """
    own = prices.where(F.col("ticker") == ticker)
    if as_of is not None:
        return price_features_as_of(own, as_of, lookback_days)
    return price_features_panel(own, latest_score_date(scores, ticker), lookback_days)


def single_name(
    prices: DataFrame,
    scores: DataFrame,
    ticker: str,
    as_of: date | None = None,
    lookback_days: int = schemas.FEATURE_LOOKBACK_DAYS,
) -> dict[str, DataFrame]:
    """Price history with bands, score, and feature breakdown of one ticker. The history is always
    the latest one, whatever the date."""
    own = features_of_ticker(prices, scores, ticker, as_of, lookback_days)
    return {
        "prices": volatility_bands(prices, own, ticker),
        "score": ticker_score(scores, ticker, as_of),
        "features": feature_breakdown(own),
    }
