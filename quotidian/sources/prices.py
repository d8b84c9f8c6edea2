"""Landed price files and the raw price layer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotidian import schemas
from quotidian.functions import scalar
from quotidian.sources.lake import or_empty

DATE_NAMES = ("date", "datetime")


class NoDateColumn(ValueError):
    """A landed price table has no date column."""


VALUES = ("open", "high", "low", "close", "volume")
#: A field: quoted, with line ends, commas and doubled quotes inside, or plain up to the next comma or line end.
#: Nothing is tried twice, so time goes by the length of the text.
_FIELD = r'(?:[ \t]*+"[^"]*+(?:""[^"]*+)*+"[^,\r\n]*+|[^,\r\n]*+)'
_RECORD = rf"{_FIELD}(?:,{_FIELD})*+"
_QUOTED = r'^[ \t]*+"([^"]*+(?:""[^"]*+)*+)"'


def records(text: Column) -> Column:
    """The records of a CSV text, which end where a line ends outside quotes; blank ones are skipped."""
    found = F.regexp_extract_all(F.regexp_replace(text, "^\ufeff", ""), F.lit(_RECORD), F.lit(0))
    return F.filter(found, lambda r: F.trim(r) != "")


def fields(record: Column) -> Column:
    """The texts of a record's fields, without their quotes; empty ones are NULL."""
    cut = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({_FIELD})"), F.lit(1))

    def plain(field: Column) -> Column:
        inside = F.replace(F.regexp_extract(field, _QUOTED, 1), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(field.rlike(_QUOTED), inside).otherwise(field), F.lit(""))

    return F.transform(cut, plain)


def by_own_header(files: DataFrame) -> DataFrame:
    """Whole files, one per row in ``value``, as rows of text columns date, open, high, low, close and
    volume, each found by the header of its own file: in any order and case, the first one called date or
    datetime being the date. A file may have any number of columns, and line ends inside quotes. Absent
    columns are NULL; blank lines are skipped."""
    others = [c for c in files.columns if c != "value"]
    rows = (
        files.select(*others, records(F.col("value")).alias("records"))
        .withColumn("header", F.transform(fields(F.get("records", F.lit(0))), lambda h: F.lower(F.trim(h))))
        .select(*others, "header", F.explode(
            F.slice("records", 2, F.greatest(F.size("records") - 1, F.lit(0)))).alias("record"))
    )
    is_date = F.transform("header", lambda h: F.coalesce(h.isin(*DATE_NAMES), F.lit(False)))
    places = {"date": F.array_position(is_date, True), **{c: F.array_position("header", F.lit(c)) for c in VALUES}}
    placed = rows.select(*others, fields(F.col("record")).alias("fields"), *[p.alias(f"at_{c}") for c, p in places.items()])
    return placed.select(*others, *[
        F.when(F.col(f"at_{c}") > 0, F.get("fields", (F.col(f"at_{c}") - 1).cast("int"))).alias(c) for c in places])


def landed_files(reader, path: str) -> DataFrame:
    """(ticker, value) of landed files, read whole: a ticker's file has a line per day at most. The ticker is
    the name of the file ``<ticker>.csv``, of the folder that Spark wrote under such a name, or of
    the folder ``ticker=<ticker>``, in whose names Spark escapes signs. Files of other names are not landed
    prices. reader: ``spark.read`` or ``spark.readStream``."""
    files = reader.format("text").option("wholetext", True).option("recursiveFileLookup", True).load(path)
    path = F.col("_metadata.file_path")

    def decoded(name: Column) -> Column:
        return F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))

    def part(pattern: str) -> Column:
        return decoded(F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")))

    ticker = F.coalesce(
        decoded(part(r"/ticker=([^/]+)/")),
        part(r"/([^/]+)\.csv/[^/]+$"),
        part(r"/([^/]+?)\.csv(\.[^/]*)?$"),
    )
    return files.select(ticker.alias("ticker"), "value").where(F.col("ticker").isNotNull())


def read_landed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Landed files as text, each read by its own header, with the ticker from the file's name."""
    return by_own_header(landed_files(spark.read, path))


def rejected(landed: DataFrame) -> DataFrame:
    """Landed rows that have no date that can be read, as they came: (ticker, date, values, reason)."""
    day = scalar.parse_day("date")
    reason = F.when(F.col("date").isNull(), "no date").otherwise("unreadable date")
    return landed.where(day.isNull()).select("ticker", "date", *VALUES, reason.alias("reason"))


def normalise_landed(
    landed: DataFrame, ticker: Column | str = "ticker", source: str = schemas.PRICE_SOURCE
) -> DataFrame:
    """Landed rows in the raw schema.

    The first column called date or datetime, in any case, is the date; all names become lower
    case; prices that are no numbers become NULL.
    """
    date_col = next((c for c in landed.columns if c.lower() in DATE_NAMES), None)
    if date_col is None:
        raise NoDateColumn(f"No date column among {landed.columns}")
    lowered = landed.toDF(*["date" if c == date_col else c.lower() for c in landed.columns])
    text = isinstance(lowered.schema["date"].dataType, T.StringType)
    return scalar.parse_numbers(lowered, VALUES).select(
        (scalar.parse_day("date") if text else scalar.to_day("date")).alias("date"),
        *VALUES,
        scalar.as_column(ticker).cast("string").alias("ticker"),
        F.lit(source).alias("source"),
    )


def ingest_window(
    prices: DataFrame, run_date: date, days: int = schemas.INGEST_WINDOW_DAYS
) -> DataFrame:
    """Rows from ``days`` before the run date up to it, both included."""
    return prices.where(
        F.col("date").between(F.lit(run_date - timedelta(days=days)), F.lit(run_date))
    )


def last_at_or_before(
    prices: DataFrame, run_date: date, order_by: Sequence[str] = ()
) -> DataFrame:
    """Per ticker the row of ``run_date``, else its latest earlier one.

    An aggregate with map-side reduction: a ticker's history does not have to meet in one task.
    """
    values = [c for c in prices.columns if c not in ("ticker", "date")]
    order = [*order_by, *[c for c in values if c not in order_by]]
    rows = prices.where(F.col("date") <= F.lit(run_date))
    last = rows.groupBy("ticker").agg(F.max(F.struct("date", *order)).alias("last"))
    return last.select(
        *[F.col("ticker") if c == "ticker" else F.col(f"last.{c}") for c in prices.columns]
    )


#: Rows of a later ingest have a greater number; files written before there were numbers have none.
STORED_RAW = T.StructType([*schemas.RAW_PRICES.fields, T.StructField("ingest_no", T.LongType())])
RAW_WITH_ORDER = T.StructType([
    *STORED_RAW.fields,
    T.StructField("file_time", T.TimestampType()),
    T.StructField("file_path", T.StringType()),
])


def read_raw(spark: SparkSession, root: str, skip_unreadable: bool = True) -> DataFrame:
    """The raw layer, a ``date=`` partitioned table, with its ingest order; empty if never written.

    Unreadable files are skipped, as a bad download must not stop a day. ``ingest_no`` orders rows by the
    ingest that added them, ``file_time`` and ``file_path`` those that have none.
    """
    reader = (
        spark.read.schema(STORED_RAW)
        .option("ignoreCorruptFiles", skip_unreadable)
        .option("ignoreMissingFiles", skip_unreadable)
    )
    order = (
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file_path"),
    )
    return or_empty(
        spark,
        lambda: reader.parquet(root).select(*STORED_RAW.names, *order),
        RAW_WITH_ORDER,
    )


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name; absent columns are NULL."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def last_bars(prices: DataFrame, ticker: str, bars: int = schemas.HISTORY_BARS) -> DataFrame:
    """The last ``bars`` rows of a ticker, in no order."""
    return prices.where(F.col("ticker") == ticker).orderBy(F.desc("date")).limit(bars)


def price_history(prices: DataFrame, ticker: str, bars: int = schemas.HISTORY_BARS) -> DataFrame:
    """The last ``bars`` bars of a ticker in chronological order."""
    recent = last_bars(prices, ticker, bars)
    return recent.select("date", "open", "high", "low", "close", "volume").orderBy("date")
