"""The three layers on storage: partitioned writes, reads, and the dates they hold."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotidian import schemas
from quotidian.sources import files


@dataclass(frozen=True)
class Lake:
    """Table locations under one root; the root can be any URI Spark reads."""

    root: str

    @property
    def raw_prices(self) -> str:
        return f"{self.root}/raw/prices"

    @property
    def rejected_prices(self) -> str:
        return f"{self.root}/raw/rejected_prices"

    @property
    def rejected_stream(self) -> str:
        return f"{self.root}/raw/rejected_stream"

    @property
    def unreadable_files(self) -> str:
        return f"{self.root}/raw/unreadable_files"

    @property
    def rolling_state(self) -> str:
        return f"{self.root}/marts/rolling_state"

    @property
    def publishing(self) -> str:
        return f"{self.root}/_publishing"

    def staging(self, purpose: str) -> str:
        """A fresh folder beside the tables, so that every executor reaches it; readers skip its name."""
        return f"{self.root}/_staging/{purpose}-{uuid.uuid4().hex}"

    @property
    def raw_filings(self) -> str:
        return f"{self.root}/raw/filings"

    @property
    def daily_prices(self) -> str:
        return f"{self.root}/curated/daily_prices"

    @property
    def quarterly_fundamentals(self) -> str:
        return f"{self.root}/curated/quarterly_fundamentals"

    @property
    def quarterly_revenue(self) -> str:
        return f"{self.root}/curated/quarterly_revenue"

    @property
    def signal_scores(self) -> str:
        return f"{self.root}/marts/signal_scores"

    @property
    def positions(self) -> str:
        return f"{self.root}/marts/positions"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in order and type; further columns of ``df`` follow."""
    further = [c for c in df.columns if c not in schema.names]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], *further)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("date",),
    sort_by: Sequence[str] = ("ticker",),
    days: Iterable[date] = (),
) -> None:
    """Replaces exactly the partitions that ``df`` has rows for; all others stay. ``days`` are the dates among
    them, where the caller knows them; the table's log of dates takes them down.

    The rebalance gathers each partition's rows into few files, and lets adaptive execution split a
    partition that is large instead of giving it to one task. Sorting inside the files gives their
    row groups narrow ticker ranges, which single-ticker reads skip by.
    """
    with many_small_files(df.sparkSession):
        (
            df.hint("rebalance", *[F.col(c) for c in partition_by])
            .sortWithinPartitions(*partition_by, *sort_by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(path)
        )
    note_days(df.sparkSession, path, days)


@contextmanager
def many_small_files(spark: SparkSession) -> Iterator[None]:
    """Lets a write of many small partitions keep its tasks. Adaptive execution would join them by size into
    one, which then opens all files by itself; opening files, not writing them, takes the time here."""
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def overwrite_date(df: DataFrame, path: str, day: date, sort_by: Sequence[str] = ("ticker",)) -> None:
    """Replaces the partition of one date, also by nothing: the partition then holds one typed file
    without rows, so that the date counts as done and readers find the schema."""
    (
        df.where(F.col("date") == F.lit(day))
        .drop("date")
        .hint("rebalance")
        .sortWithinPartitions(*sort_by)
        .write.mode("overwrite")
        .parquet(f"{path}/date={day.isoformat()}")
    )
    note_days(df.sparkSession, path, [day])


def read_scores_of(spark: SparkSession, path: str, day: date) -> DataFrame:
    """The scores of one date, from its folder alone."""
    rows = or_empty(
        spark, lambda: spark.read.parquet(f"{path}/date={day.isoformat()}"),
        T.StructType([f for f in schemas.SIGNAL_SCORES if f.name != "date"]),
    )
    return conform(rows.withColumn("date", F.lit(day)), schemas.SIGNAL_SCORES)


NOTHING_WRITTEN = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def or_empty(
    spark: SparkSession, read: Callable[[], DataFrame], schema: T.StructType
) -> DataFrame:
    """What ``read`` gives, or a typed empty table where nothing was written yet."""
    try:
        return read()
    except AnalysisException as exc:
        if exc.getCondition() not in NOTHING_WRITTEN:
            raise
        return spark.createDataFrame([], schema)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether there is any Parquet file below the path."""
    try:
        spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() not in NOTHING_WRITTEN:
            raise
        return False
    return True


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table in its schema, without opening files to find it; typed and empty if nothing was
    written."""
    return or_empty(spark, lambda: spark.read.schema(schema).parquet(path), schema).select(
        *schema.names
    )


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """The scores, whose width may differ by date: the mart's columns, then any further z-scores
    and fundamentals that some date has."""
    schema = schemas.SIGNAL_SCORES
    stored = or_empty(spark, lambda: spark.read.option("mergeSchema", True).parquet(path), schema)
    known = [
        (F.col(f.name) if f.name in stored.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return stored.select(*known, *[c for c in stored.columns if c not in schema.names])


# --- dates of a table -------------------------------------------------------------------------

#: A table's log of the dates written to it: beside its partitions, where readers of the table don't look.
DATE_LOG = "_dates/log"
LOGGED = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("ingest_no", T.LongType()),
])


def note_days(spark: SparkSession, path: str, days: Iterable[date], ingest_no: int | None = None) -> None:
    """Adds to the table's log that the days' partitions were written now."""
    now = datetime.now(timezone.utc)
    rows = [(d, now, ingest_no) for d in sorted(set(days))]
    if rows:
        spark.createDataFrame(rows, LOGGED).coalesce(1).write.mode("append").parquet(f"{path}/{DATE_LOG}")


def date_log(spark: SparkSession, path: str) -> DataFrame:
    """(date, at, ingest_no): when each date was written last, and by which ingest."""
    log = or_empty(spark, lambda: spark.read.schema(LOGGED).parquet(f"{path}/{DATE_LOG}"), LOGGED)
    return log.groupBy("date").agg(F.max("at").alias("at"), F.max("ingest_no").alias("ingest_no"))


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """The dates of every partition or daily file that has a data file, also one without rows, in order. Names
    that are no dates are ignored. Folders are listed, one a date; only where the log doesn't know a date,
    as in tables that others have filled, one look is taken into its folder. No file name is gathered."""
    known = {r["date"] for r in date_log(spark, path).collect()}  # a row per calendar day at most
    return files.days_with_files(spark, path, known)


def dates_with_files(spark: SparkSession, path: str) -> DataFrame:
    """(date) of ``stored_days``, listed when this is called."""
    return spark.createDataFrame([(d,) for d in stored_days(spark, path)], "date date")


def dates_done(spark: SparkSession, lake: Lake) -> DataFrame:
    """(date) present in the scores or in the positions, but for those of a publication that has not ended."""
    from quotidian.sources import publish

    days = {*stored_days(spark, lake.signal_scores), *stored_days(spark, lake.positions)}
    open_days = publish.unfinished_days(spark, lake)
    return spark.createDataFrame([(d,) for d in sorted(days - open_days)], "date date")
