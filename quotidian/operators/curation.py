"""Raw price rows and filing manifests to curated tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotidian import schemas
from quotidian.functions import scalar

PRICES = ("open", "high", "low", "close")


class MissingColumns(ValueError):
    """A table lacks columns its operator needs."""


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` itself; looks at its schema only."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(f"Missing required columns: {missing}")
    return df


def coerce_prices(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw rows in the curated types. What is no number or no date becomes NULL."""
    require_columns(raw, schemas.DAILY_PRICES.names)
    columns = dict.fromkeys([*schemas.DAILY_PRICES.names, *keep])
    numbers = scalar.parse_numbers(raw.select(*columns), [*PRICES, "volume"])
    return numbers.select(
        scalar.to_day("date").alias("date"),
        F.col("ticker").cast("string").alias("ticker"),
        *PRICES,
        scalar.whole_number(F.col("volume")).alias("volume"),
        F.col("source").cast("string").alias("source"),
        *keep,
    )


def keep_run_date(rows: DataFrame, run_date: date) -> DataFrame:
    """Rows of ``run_date``; without any, the rows of the latest date there is."""
    target = rows.agg(
        F.coalesce(F.max(F.when(F.col("date") == F.lit(run_date), F.col("date"))), F.max("date"))
        .alias("date")
    )
    return rows.join(F.broadcast(target), "date", "left_semi")


def keep_partition_dates(rows: DataFrame, partition_col: str) -> DataFrame:
    """``keep_run_date`` for every landing partition at once, each by its own date.

    Partitions named by dates are at most one per calendar day, which bounds the broadcast of the
    choice; for other names Spark decides.
    """
    own = F.max(F.when(F.col("date") == F.col(partition_col), F.col("date")))
    target = rows.groupBy(partition_col).agg(F.coalesce(own, F.max("date")).alias("date"))
    if isinstance(rows.schema[partition_col].dataType, T.DateType):
        target = F.broadcast(target)
    return rows.join(target, [partition_col, "date"], "left_semi")


def ingest_order(order_by: Sequence[str], columns: Sequence[str]) -> Column:
    """Sort key: the ingest columns, then every column so that equal ingests cannot tie."""
    return F.struct(*order_by, *[c for c in columns if c not in order_by])


def keep_last(
    rows: DataFrame,
    keys: Sequence[str] = ("date", "ticker"),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One row per key, the last in ingest order.

    An aggregate, so that copies of a hot key collapse before the shuffle; a window would send all
    of them to one task. Spark sorts by the keys in their order for it, and tells dates apart by
    their sort prefix, but not texts that begin alike; hence the date first.
    """
    values = [c for c in rows.columns if c not in keys]
    last = F.max(ingest_order(order_by, [c for c in values if c not in order_by]))
    picked = rows.groupBy(*keys).agg(last.alias("last"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"last.{c}") for c in rows.columns])


def curate_daily_prices(
    raw: DataFrame, run_date: date, order_by: Sequence[str] = ()
) -> DataFrame:
    """The curated prices of one run date."""
    typed = coerce_prices(raw, order_by)
    picked = keep_last(keep_run_date(typed, run_date), order_by=order_by)
    return picked.select(*schemas.DAILY_PRICES.names)


def curate_price_partitions(
    raw: DataFrame, partition_col: str, order_by: Sequence[str] = ()
) -> DataFrame:
    """The curated prices of every landing partition in one job.

    Where several partitions fall back to the same date, the later partition's rows win.
    """
    order = [partition_col, *[c for c in order_by if c != partition_col]]
    typed = coerce_prices(raw, order)
    picked = keep_last(keep_partition_dates(typed, partition_col), order_by=order)
    return picked.select(*schemas.DAILY_PRICES.names)


def curate_all_dates(raw: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """The curated prices of every date present, each under its own date."""
    typed = coerce_prices(raw, order_by).where(F.col("date").isNotNull())
    return keep_last(typed, order_by=order_by).select(*schemas.DAILY_PRICES.names)


def curate_filings(manifest: DataFrame) -> DataFrame:
    """Manifest rows that name a file, typed, with the quarter partition columns kept if present."""
    require_columns(manifest, schemas.MANIFEST.names)
    partitions = [c for c in ("year", "quarter") if c in manifest.columns]
    return manifest.select(
        F.col("ticker").cast("string").alias("ticker"),
        F.col("filing_type").cast("string").alias("filing_type"),
        F.col("download_time").cast("timestamp").alias("download_time"),
        F.col("file_path").cast("string").alias("file_path"),
        F.col("source").cast("string").alias("source"),
        *partitions,
    ).where(F.col("file_path").isNotNull() & (F.col("file_path") != ""))


def prefer_filing_type(
    manifest: DataFrame, priority: Sequence[str] = schemas.FILING_PRIORITY
) -> DataFrame:
    """Per ticker only the filings of the first type in ``priority`` it has.

    Rows of the first type pass without a shuffle. Those of each further type are kept unless the
    ticker is among the holders of an earlier one; the holders are distinct tickers, and adaptive
    execution splits the row side where one ticker has most of the filings.
    """
    kept = manifest.where(F.col("filing_type") == priority[0])
    for place, filing_type in enumerate(priority[1:], 1):
        holders = (
            manifest.where(F.col("filing_type").isin(*priority[:place])).select("ticker").distinct()
        )
        rows = manifest.where(F.col("filing_type") == filing_type)
        kept = kept.unionByName(rows.join(holders, "ticker", "left_anti").select(*kept.columns))
    return kept
