"""The long/short book."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quotidian import schemas
from quotidian.functions import scalar


def top_per_date(signals: DataFrame, n: int, signal_col: str = "signal_score") -> DataFrame:
    """The ``n`` best of each date with their rank; ties go to the smaller ticker.

    ``row_number() <= n`` lets Spark cut every partition to ``n`` rows per date before the shuffle.
    """
    best_first = Window.partitionBy("date").orderBy(F.desc_nulls_last(signal_col), "ticker")
    return signals.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= n)


def bottom_per_date(signals: DataFrame, n: int, signal_col: str = "signal_score") -> DataFrame:
    """The tail of ``top_per_date``'s order, ranked in that same order: rank n is the worst."""
    worst_first = Window.partitionBy("date").orderBy(
        F.asc_nulls_first(signal_col), F.desc("ticker")
    )
    best_first = Window.partitionBy("date").orderBy(F.desc_nulls_last(signal_col), "ticker")
    return (
        signals.withColumn("from_end", F.row_number().over(worst_first))
        .where(F.col("from_end") <= n)
        .withColumn("rank", F.row_number().over(best_first))
        .drop("from_end")
    )


def generate_positions(
    signals: DataFrame,
    as_of: date | None = None,
    n_longs: int = schemas.BOOK_SIZE,
    n_shorts: int = schemas.BOOK_SIZE,
    signal_col: str = "signal_score",
) -> DataFrame:
    """Top ``n_longs`` and bottom ``n_shorts`` of each date (or of ``as_of``) among scored tickers.

    With fewer scored tickers than both sides need, some are long and short at once. Signals without
    a date or a score column give an empty book.
    """
    if not {"ticker", "date", signal_col} <= set(signals.columns):
        book = signals.sparkSession.createDataFrame([], schemas.POSITIONS)
        return book.withColumnRenamed("signal_score", signal_col)
    scored = signals.where(scalar.finite(signal_col).isNotNull()).select("ticker", "date", signal_col)
    if as_of is not None:
        scored = scored.where(F.col("date") == F.lit(as_of))

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(
            "ticker", "date", F.lit(name).alias("position_type"), signal_col, F.col("rank").cast("int")
        )

    longs = side(top_per_date(scored, n_longs, signal_col), "long")
    shorts = side(bottom_per_date(scored, n_shorts, signal_col), "short")
    return longs.unionByName(shorts)
