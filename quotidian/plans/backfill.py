"""A range of dates in one pass instead of one run per date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotidian import schemas
from quotidian.operators import curation, quality
from quotidian.operators.features import price_features_panel
from quotidian.operators.positions import generate_positions
from quotidian.operators.scoring import score_signals, to_mart
from quotidian.plans.daily import (
    INGEST_ORDER, append_raw_prices, curate_filings_of, reject_rows, rejected_count, report_unreadable, staged,
    stored_growth,
)
from quotidian.sources import lake as lake_io, prices, publish
from quotidian.sources.lake import Lake


def in_ingest_windows(
    day: Column | str,
    start: date,
    end: date,
    step_days: int = schemas.INGEST_WINDOW_DAYS,
    window_days: int = schemas.INGEST_WINDOW_DAYS,
) -> Column:
    """True for days that one of the ingests fetches: they run at ``end`` and every ``step_days``
    before it down to ``start``, each over ``window_days`` back."""
    last_anchor = (end - start).days // step_days
    back = F.date_diff(F.lit(end), day)
    anchor = F.least(F.floor(back / step_days), F.lit(last_anchor))
    return (back >= 0) & (back - anchor * step_days <= window_days)


def with_enough_history(dates: DataFrame, min_dates: int = schemas.MIN_HISTORY_ROWS) -> DataFrame:
    """The dates that have at least ``min_dates`` other dates before them: those after the
    ``min_dates``-th, which a top-n finds without ordering all of them in one task."""
    distinct = dates.select("date").distinct()
    if min_dates < 1:
        return distinct
    earliest = distinct.orderBy("date").limit(min_dates)
    return distinct.where(F.col("date") > earliest.agg(F.max("date")).scalar())


def dates_to_process(
    available: DataFrame, done: DataFrame | None, start: date, end: date
) -> DataFrame:
    """(date) available in the range and not done yet."""
    wanted = available.select("date").distinct().where(
        F.col("date").between(F.lit(start), F.lit(end))
    )
    return wanted if done is None else wanted.join(done, "date", "left_anti")


def build_dates(
    spark: SparkSession,
    lake: Lake,
    dates: DataFrame,
    start: date,
    end: date,
    lookback_days: int = schemas.FEATURE_LOOKBACK_DAYS,
    growth: DataFrame | None = None,
) -> None:
    """Scores and positions for all given dates in one pass over the prices, published as one.

    The dates are listed on the driver (a calendar bounds them), as those that come out empty get an empty
    partition, which also clears rows of an earlier run. With growth given, it is scored with the prices.
    """
    daily = lake_io.read_table(spark, lake.daily_prices, schemas.DAILY_PRICES)
    days = sorted(r["date"] for r in dates.select("date").distinct().collect())
    with publish.publication(spark, lake) as unit:
        features = price_features_panel(
            daily, dates, lookback_days, first=start, last=end, shared=True
        )
        scores = unit.stage(to_mart(score_signals(features, growth)), lake.signal_scores, days)
        book = lake_io.conform(generate_positions(scores), schemas.POSITIONS)
        unit.stage(book, lake.positions, days, ["position_type", "rank"])


def backfill(
    spark: SparkSession,
    lake: Lake,
    target_date: date,
    end_date: date | None = None,
    landing: str | None = None,
    days_to_fetch: int = schemas.INGEST_WINDOW_DAYS,
    run_curation: bool = True,
    run_features: bool = False,
    skip_existing: bool = True,
    lookback_days: int = schemas.FEATURE_LOOKBACK_DAYS,
) -> dict | None:
    """Ingests (if a landing folder is given), curates and builds every date of the range.

    The bounds may come in either order. With ``skip_existing`` dates that already have scores or
    positions are left alone. Features need enough raw dates before their date. Returns the
    quality report on what was curated; findings do not stop the run.
    """
    end_date = end_date or target_date
    start, end = min(target_date, end_date), max(target_date, end_date)

    if landing is not None:
        with staged(prices.read_landed_csv(spark, landing), lake, "landed") as read:
            reject_rows(read, lake, end)
            landed = prices.normalise_landed(read)
            append_raw_prices(landed.where(in_ingest_windows("date", start, end, days_to_fetch)), lake)

    publish.recover(spark, lake)
    available = lake_io.dates_with_files(spark, lake.raw_prices)
    done = lake_io.dates_done(spark, lake) if skip_existing else None
    # Listed before anything is written, as the writes below change what is done.
    chosen = sorted(r["date"] for r in dates_to_process(available, done, start, end).collect())
    if not chosen:
        return None
    dates = spark.createDataFrame([(d,) for d in chosen], "date date")

    report = None
    if run_curation:
        report = curate_dates(spark, lake, chosen, end, lookback_days)

    if run_features:
        ready = dates.join(with_enough_history(available), "date", "left_semi")
        build_dates(spark, lake, ready, start, end, lookback_days, stored_growth(spark, lake, ready))
    return report


def curate_dates(
    spark: SparkSession, lake: Lake, days: Sequence[date], run_date: date,
    lookback_days: int = schemas.FEATURE_LOOKBACK_DAYS,
) -> dict:
    """Curates the days, all in one job, with the filings of their quarters; reports on them.

    The raw files are read once. A close is judged against its ticker's stored one before, whether or not
    that date is among the days.
    """
    wanted = F.broadcast(spark.createDataFrame([(d,) for d in days], "date date"))
    raw = prices.read_raw(spark, lake.raw_prices).where(
        F.col("date").between(F.lit(days[0]), F.lit(days[-1]))).join(wanted, "date", "left_semi")
    with staged(raw, lake, "raw-days") as rows:
        lake_io.overwrite_partitions(
            curation.curate_all_dates(rows, INGEST_ORDER), lake.daily_prices, days=days)
        damaged = report_unreadable(
            rows, lake, lake.raw_prices, [f"{lake.raw_prices}/date={d.isoformat()}" for d in days], run_date)
    manifests = curate_filings_of(spark, lake, days)
    near = F.col("date").between(F.lit(days[0] - timedelta(days=lookback_days)), F.lit(days[-1]))
    stored = lake_io.read_table(spark, lake.daily_prices, schemas.DAILY_PRICES).where(near)
    return {
        **damaged,
        "unreadable_manifests": manifests["unreadable_files"],
        "rejected_rows": rejected_count(spark, lake, run_date),
        **quality.validate_daily_prices(stored, fail_on_error=False, wanted=F.col("date").isin(list(days))),
    }


def anchors(start: date, end: date, step_days: int = schemas.INGEST_WINDOW_DAYS) -> list[date]:
    """The ingest dates of a range in ascending order."""
    start, end = min(start, end), max(start, end)
    count = (end - start).days // step_days
    return [end - timedelta(days=step_days * k) for k in range(count, -1, -1)]
