"""Cross-sectional z-scores and the composite signal score."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotidian import schemas
from quotidian.functions import scalar


def zscores(
    df: DataFrame, value_cols: Sequence[str], group_col: str = "date", suffix: str = "_zscore"
) -> DataFrame:
    """Adds ``<value>_zscore``: distance from the group's mean in its sample deviations.

    Values that are NULL or not finite give NULL and do not count; so does a group of one, or without
    spread, and a row without a group.

    The statistics are an aggregate joined back rather than a window, because one date may hold the
    whole table and a window would put it into one task. Grouped by a date the statistics have at
    most one row per calendar day, which bounds the broadcast; for other groupings adaptive execution
    chooses by the statistics' measured size, and splits a large group's rows where it shuffles them.
    """
    stats = df.groupBy(F.col(group_col).alias("__group")).agg(
        *[F.avg(scalar.finite(c)).alias(f"__{c}_mean") for c in value_cols],
        *[F.stddev_samp(scalar.finite(c)).alias(f"__{c}_std") for c in value_cols],
    )
    if isinstance(df.schema[group_col].dataType, T.DateType):
        stats = F.broadcast(stats)
    # A null-safe match adds no "is not null" to the statistics' branch, so that both branches stay
    # equal and Spark runs what is below them once.
    joined = df.join(stats, F.col(group_col).eqNullSafe(F.col("__group")), "left")

    def scaled(c: str) -> Column:
        z = scalar.finite(F.try_divide(F.col(c) - F.col(f"__{c}_mean"), F.col(f"__{c}_std")))
        return F.when(F.col(group_col).isNotNull(), z).alias(f"{c}{suffix}")

    return joined.select(*df.columns, *[scaled(c) for c in value_cols])


def normalize_to_zscore(
    df: DataFrame, value_col: str, group_col: str = "date", out: str | None = None
) -> DataFrame:
    """``zscores`` for one column, under a name of choice."""
    scaled = zscores(df, [value_col], group_col)
    return scaled.withColumnRenamed(f"{value_col}_zscore", out) if out else scaled


def mean_of_available(columns: Sequence[str]) -> Column:
    """Mean over the non-null columns of a row; NULL if there is none."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns), F.lit(0.0))
    present = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return F.try_divide(total, present)


def score_signals(
    price_features: DataFrame,
    fundamental_features: DataFrame | None = None,
    as_of: date | None = None,
    feature_cols: Sequence[str] | None = None,
) -> DataFrame:
    """(ticker, date, one z-score per feature, signal_score), the equal-weight mean of the z-scores.

    Without any feature column the result is empty. With fundamentals given, their columns are
    joined on (ticker, date), kept, and scored among the tickers that have price features. Only
    z-scores made here enter the mean, whatever other columns are called.
    """
    keys = ["ticker", "date"]
    features = list(feature_cols or [c for c in price_features.columns if c not in keys])
    if not features:
        no_score = F.lit(None).cast("double").alias("signal_score")
        return price_features.select(*keys, no_score).limit(0)
    table = price_features.select(*keys, *features)
    extra: list[str] = []
    if as_of is not None:
        table = table.where(F.col("date") == F.lit(as_of))
    if fundamental_features is not None:
        extra = [c for c in fundamental_features.columns if c not in keys]
        table = table.join(fundamental_features.select(*keys, *extra), keys, "left")

    names = [f"{c}_zscore" for c in features + extra]
    return zscores(table, features + extra).select(
        *keys,
        *names[: len(features)],
        *extra,
        *names[len(features):],
        mean_of_available(names).alias("signal_score"),
    )


def to_mart(scores: DataFrame) -> DataFrame:
    """The stored form: the mart's columns in order, absent ones NULL, further ones last."""
    known = schemas.SIGNAL_SCORES
    further = [c for c in scores.columns if c not in known.names]
    return scores.select(
        *[
            (F.col(f.name) if f.name in scores.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in known
        ],
        *further,
    )
