"""One day's run: ingest, curate, build. These run jobs and write the lake's tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotidian import schemas
from quotidian.functions import scalar
from quotidian.operators import curation, quality, state
from quotidian.operators.fundamentals import growth_as_filed
from quotidian.operators.features import price_features_as_of
from quotidian.operators.positions import generate_positions
from quotidian.operators.scoring import score_signals, to_mart
from quotidian.sources import files, filings, lake as lake_io, listing, prices, publish
from quotidian.sources.lake import Lake

INGEST_ORDER = ("ingest_no", "file_time", "file_path")
#: Damaged files that a report names; all of them are in the lake's table.
NAMED_FILES = 100


@contextmanager
def staged(rows: DataFrame, lake: Lake, purpose: str) -> Iterator[DataFrame]:
    """The rows, written once beside the lake's tables for the steps of a run that read them; then they go,
    also where a step fails."""
    folder = lake.staging(purpose)
    try:
        rows.write.parquet(folder)
        yield rows.sparkSession.read.schema(rows.schema).parquet(folder)
    finally:
        files.delete(rows.sparkSession, folder)


def append_raw_prices(rows: DataFrame, lake: Lake) -> list[date]:
    """Adds rows to the raw layer that differ from what it holds last for their ticker and date; returns the
    dates that the rows have.

    Nothing is replaced, so a run with some of the tickers cannot lose the others; of several rows
    curation keeps those of the last ingest, whose number every row carries. What is known already is not
    written again, so the layer grows with new data, not with the number of runs. Only the stored dates
    that the rows have are read.
    """
    spark = rows.sparkSession
    dated = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.RAW_PRICES])
    with staged(dated.where(F.col("date").isNotNull()), lake, "raw") as new:
        days = sorted(r["date"] for r in new.select("date").distinct().collect())  # one a calendar day
        if not days:
            return []
        number = (lake_io.date_log(spark, lake.raw_prices).agg(F.max("ingest_no")).first()[0] or 0) + 1
        values = [c for c in schemas.RAW_PRICES.names if c not in ("ticker", "date")]
        wanted = F.broadcast(spark.createDataFrame([(d,) for d in days], "date date"))
        stored = prices.read_raw(spark, lake.raw_prices).join(wanted, "date", "left_semi")  # lists the folders once
        last = stored.groupBy("ticker", "date").agg(
            F.max(F.struct(*INGEST_ORDER, *values)).alias("last")).select(
            "ticker", "date", F.struct(*[F.col(f"last.{c}") for c in values]).alias("known"))
        same = new["ticker"].eqNullSafe(last["ticker"]) & (new["date"] == last["date"]) & F.struct(
            *[new[c] for c in values]).eqNullSafe(last["known"])
        new = new.join(last, same, "left_anti")
        with lake_io.many_small_files(spark):
            (
                new.withColumn("ingest_no", F.lit(number).cast("bigint"))
                .hint("rebalance", F.col("date"))
                .write.mode("append")
                .partitionBy("date")
                .parquet(lake.raw_prices)
            )
    lake_io.note_days(spark, lake.raw_prices, days, number)
    return days


def ingest_prices(
    spark: SparkSession, lake: Lake, landing: str, run_date: date, universe: DataFrame | None = None
) -> DataFrame:
    """Landed files of the ingest window into the raw layer; returns each ticker's row of the run
    date or its latest earlier one. With a universe given, only files of its tickers are taken. The files
    are parsed once."""
    landed = prices.read_landed_csv(spark, landing)
    if universe is not None:
        landed = landed.join(universe.select("ticker").distinct(), "ticker", "left_semi")
    with staged(landed, lake, "landed") as rows:
        reject_rows(rows, lake, run_date)
        append_raw_prices(prices.ingest_window(prices.normalise_landed(rows), run_date), lake)
    return prices.last_at_or_before(prices.ingest_window(prices.normalise_landed(landed), run_date), run_date)


def reject_rows(landed: DataFrame, lake: Lake, run_date: date) -> None:
    """Landed rows without a readable date, kept as they came; they replace those of an earlier run of the
    date."""
    lake_io.overwrite_date(
        prices.rejected(landed).withColumnRenamed("date", "date_text").withColumn("date", F.lit(run_date)),
        lake.rejected_prices, run_date,
    )


def rejected_count(spark: SparkSession, lake: Lake, run_date: date) -> int:
    """Rows that the run of a date has rejected."""
    folder = f"{lake.rejected_prices}/date={run_date.isoformat()}"
    return spark.read.parquet(folder).count() if lake_io.is_written(spark, folder) else 0


def ingest_filings(
    spark: SparkSession,
    lake: Lake,
    downloads: str,
    run_date: date,
    priority: Sequence[str] = schemas.FILING_PRIORITY,
) -> None:
    """The manifest of the quarter's downloads into the raw layer."""
    manifest = filings.build_manifest(spark, downloads, run_date, priority)
    lake_io.overwrite_partitions(
        manifest, lake.raw_filings, ["year", "quarter"], ["ticker", "filing_type"]
    )


def report_unreadable(
    read: DataFrame, lake: Lake, table: str, folders: Sequence[str], run_date: date
) -> dict:
    """Files of a table's folders that gave no rows to ``read``: all of them into the lake's table of such
    files, under the run date, and in the report their number and the first names."""
    spark = read.sparkSession
    name = table.removeprefix(f"{lake.root}/")
    folder = f"{lake.unreadable_files}/table={name.replace('/', '.')}/date={run_date.isoformat()}"
    listing.without_rows(read, table, folders).coalesce(1).write.mode("overwrite").parquet(folder)
    found = spark.read.schema("file_path string, size long").parquet(folder)
    named = [r["file_path"] for r in found.orderBy("file_path").limit(NAMED_FILES).collect()]
    return {"unreadable_files": named, "unreadable_count": found.count() if len(named) == NAMED_FILES else len(named)}


def closes_before(
    spark: SparkSession, lake: Lake, day: date, lookback_days: int = schemas.FEATURE_LOOKBACK_DAYS
) -> DataFrame:
    """(ticker, date, close): each ticker's last stored close before a day, from the last state and the dates
    after it."""
    bars = history_before(spark, lake, day - timedelta(days=1), lookback_days)
    return bars.groupBy("ticker").agg(F.max(F.struct("date", "close")).alias("last")).select(
        "ticker", "last.date", "last.close")


def judged_day(spark: SparkSession, lake: Lake, day: date) -> dict:
    """The quality report of a stored day, whose closes are judged against each ticker's last one before."""
    stored = lake_io.read_table(spark, lake.daily_prices, schemas.DAILY_PRICES)
    before = lake_io.conform(
        closes_before(spark, lake, day).select("date", "ticker", "close", *[
            F.lit(None).alias(f.name) for f in schemas.DAILY_PRICES if f.name not in ("date", "ticker", "close")]),
        schemas.DAILY_PRICES)
    rows = stored.where(F.col("date") == F.lit(day)).unionByName(before)
    return quality.validate_daily_prices(rows, fail_on_error=False, wanted=F.col("date") == F.lit(day))


def curate_prices_day(spark: SparkSession, lake: Lake, run_date: date) -> dict | None:
    """Curates the run date, or the latest earlier date there is, validates it, and replaces that date.
    Findings, files that could not be read and rows rejected at landing are reported and do not stop the
    load. The raw files are read once. None without raw rows."""
    known = [d for d in lake_io.stored_days(spark, lake.raw_prices) if d <= run_date]
    if not known:
        return None
    day = known[-1]
    with staged(prices.read_raw(spark, lake.raw_prices).where(F.col("date") == F.lit(day)), lake, "raw-day") as raw:
        curated = curation.curate_daily_prices(raw, day, INGEST_ORDER)
        lake_io.overwrite_date(curated, lake.daily_prices, day)
        damaged = report_unreadable(
            raw, lake, lake.raw_prices, [f"{lake.raw_prices}/date={day.isoformat()}"], run_date)
    return {
        "date": day,
        **damaged,
        "rejected_rows": rejected_count(spark, lake, run_date),
        **judged_day(spark, lake, day),
    }


def curate_filings_of(spark: SparkSession, lake: Lake, days: Sequence[date]) -> dict:
    """Replaces the curated fundamentals of the days' quarters, all in one job; reports manifests that could
    not be read, under the last of the days."""
    manifest = filings.read_manifests(spark, lake.raw_filings, days, with_path=True)
    with staged(manifest, lake, "manifests") as rows:
        lake_io.overwrite_partitions(
            curation.curate_filings(rows),
            lake.quarterly_fundamentals,
            ["year", "quarter"],
            ["ticker", "filing_type"],
        )
        folders = [f"{lake.raw_filings}/year={y}/quarter={q}" for y, q in filings.quarters_of(days)]
        read = rows.select(F.col("manifest_path").alias("file_path"))
        there = [f for f in folders if files.exists(spark, f)]
        return report_unreadable(read, lake, lake.raw_filings, there, max(days))


def curate_day(spark: SparkSession, lake: Lake, run_date: date, with_filings: bool = True) -> dict | None:
    """Prices, then the quarter's filings."""
    report = curate_prices_day(spark, lake, run_date)
    if with_filings:
        manifests = curate_filings_of(spark, lake, [run_date])
        if report is not None:
            report["unreadable_manifests"] = manifests["unreadable_files"]
    return report


def usable_state(spark: SparkSession, lake: Lake, run_date: date, lookback_days: int) -> date | None:
    """The date of the last stored state up to ``run_date`` that the run can start from: none of the dates
    it was made from has been written since, and it reaches back far enough."""
    keep = schemas.FEATURE_LOOKBACK_DAYS
    if lookback_days > keep:
        return None
    since = run_date - timedelta(days=lookback_days)
    states = {r["date"]: r["at"] for r in lake_io.date_log(spark, lake.rolling_state).where(
        F.col("date").between(F.lit(since), F.lit(run_date))).collect()}
    if not states:
        return None
    day = max(states)
    if not files.exists(spark, f"{lake.rolling_state}/date={day.isoformat()}"):
        return None
    written = {r["date"]: r["at"] for r in lake_io.date_log(spark, lake.daily_prices).collect()}
    used = [d for d in lake_io.stored_days(spark, lake.daily_prices) if day - timedelta(days=keep) <= d <= day]
    fresh = all(d in written and written[d] <= states[day] for d in used)
    return day if fresh else None


def history_before(
    spark: SparkSession, lake: Lake, run_date: date, lookback_days: int = schemas.FEATURE_LOOKBACK_DAYS
) -> DataFrame:
    """(ticker, date, close) of the lookback up to ``run_date``: from the last usable state and the dates after
    it, or, where there is none, from every date."""
    daily = lake_io.read_table(spark, lake.daily_prices, schemas.DAILY_PRICES).select("ticker", "date", "close")
    since = F.lit(run_date - timedelta(days=lookback_days))
    day = usable_state(spark, lake, run_date, lookback_days)
    if day is None:
        return daily.where(F.col("date").between(since, F.lit(run_date)))
    kept = spark.read.schema(T.StructType([f for f in schemas.ROLLING_STATE if f.name != "date"])).parquet(
        f"{lake.rolling_state}/date={day.isoformat()}")
    newer = daily.where((F.col("date") > F.lit(day)) & (F.col("date") <= F.lit(run_date)))
    return state.bars_of(kept).where(F.col("date") >= since).unionByName(newer)


def build_day(
    spark: SparkSession,
    lake: Lake,
    run_date: date,
    lookback_days: int = schemas.FEATURE_LOOKBACK_DAYS,
    fundamentals: DataFrame | None = None,
) -> None:
    """Scores, positions and rolling state of a date, published as one; all are written, also when empty.

    The state comes from the last one and the dates after it, the features from the state, the book from the
    scores: each is staged once and read from there.
    """
    with publish.publication(spark, lake) as unit:
        keep = max(lookback_days, schemas.FEATURE_LOOKBACK_DAYS)
        kept = state.state_of(history_before(spark, lake, run_date, keep), run_date, keep)
        kept = unit.stage(lake_io.conform(kept, schemas.ROLLING_STATE), lake.rolling_state, [run_date])
        features = price_features_as_of(state.bars_of(kept), run_date, lookback_days, shared=True)
        scores = unit.stage(to_mart(score_signals(features, fundamentals)), lake.signal_scores, [run_date])
        book = lake_io.conform(generate_positions(scores, run_date), schemas.POSITIONS)
        unit.stage(book, lake.positions, [run_date], ["position_type", "rank"])


def ingest_revenue(spark: SparkSession, lake: Lake, landing: str) -> None:
    """Landed revenue files into the curated table: CSV with the columns ticker, quarter (any day of it), filed
    and revenue, in any order. The table holds every filing, restatements too; one that is landed again is
    stored once. Rows without ticker, quarter or a revenue that is a number are left out."""
    read = spark.read.option("header", True).option("multiLine", True).option("recursiveFileLookup", True).csv(landing)
    named = read.toDF(*[c.strip().lower() for c in read.columns])
    curation.require_columns(named, ("ticker", "quarter", "filed", "revenue"))
    rows = scalar.parse_numbers(named, ["revenue"]).select(
        F.trim("ticker").alias("ticker"),
        scalar.quarter_index(scalar.parse_day("quarter")).cast("int").alias("quarter_no"),
        "revenue",
        scalar.parse_day("filed").alias("filed"),
    ).where("ticker <> '' AND quarter_no IS NOT NULL AND revenue IS NOT NULL")
    known = lake_io.read_table(spark, lake.quarterly_revenue, schemas.REVENUE_FILINGS)
    year = F.floor(F.col("quarter_no") / 4).cast("int").alias("year")
    with staged(rows.distinct(), lake, "revenue") as new:
        touched = new.select(year).distinct()
        merged = known.withColumn("year", year).join(F.broadcast(touched), "year", "left_semi").unionByName(
            new.withColumn("year", year)).distinct()
        with staged(merged, lake, "revenue-merged") as whole:  # the source is the target
            lake_io.overwrite_partitions(whole, lake.quarterly_revenue, ["year"], ["ticker", "quarter_no"])


def stored_growth(spark: SparkSession, lake: Lake, dates: DataFrame) -> DataFrame | None:
    """Revenue growth as filed on the dates; None where no revenue was ever stored."""
    if not lake_io.is_written(spark, lake.quarterly_revenue):
        return None
    revenue = lake_io.read_table(spark, lake.quarterly_revenue, schemas.REVENUE_FILINGS)
    return growth_as_filed(revenue, dates)


def run_day(
    spark: SparkSession,
    lake: Lake,
    landing: str,
    run_date: str | date | None = None,
    downloads: str | None = None,
    universe: DataFrame | None = None,
) -> dict | None:
    """Ingest, curate and build; with a folder of downloads, filings too. The run date may be given as text
    and defaults to today. Growth from the stored revenues, where there are any, is scored with prices."""
    day = run_date if isinstance(run_date, date) else scalar.parse_run_date(run_date)
    ingest_prices(spark, lake, landing, day, universe)
    if downloads is not None:
        ingest_filings(spark, lake, downloads, day)
    report = curate_day(spark, lake, day, with_filings=downloads is not None)
    growth = stored_growth(spark, lake, spark.createDataFrame([(day,)], "date date"))
    build_day(spark, lake, day, fundamentals=growth)
    return report
