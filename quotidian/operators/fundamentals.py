"""Fundamental features from quarterly revenue."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quotidian import schemas
from quotidian.functions import scalar


def yoy_growth(revenue: DataFrame) -> DataFrame:
    """Adds ``yoy_revenue_growth`` to (ticker, quarter_no, revenue).

    The base is the quarter exactly four earlier; a RANGE frame finds it, or NULL, also where other
    quarters are missing. ``quarter_no`` counts quarters without gaps over the years.
    """
    year_before = Window.partitionBy("ticker").orderBy("quarter_no").rangeBetween(-4, -4)
    base = F.max("revenue").over(year_before)
    return revenue.withColumn("yoy_revenue_growth", F.try_divide(F.col("revenue"), base) - 1)


def yoy_revenue_growth_proxy(revenue: DataFrame, as_of: date) -> DataFrame:
    """(ticker, date, yoy_revenue_growth_proxy): growth in each ticker's last quarter before the one that
    ``as_of`` lies in, dated ``as_of``. A quarter counts from the day after its end."""
    next_quarter = as_of.year * 4 + (as_of.month - 1) // 3
    by_quarter = Window.partitionBy("ticker").orderBy("quarter_no")
    known = revenue.where(F.col("quarter_no") < next_quarter)
    return (
        yoy_growth(known)
        .withColumn("following", F.lead("quarter_no", 1).over(by_quarter))
        .where(F.col("following").isNull())
        .select(
            "ticker",
            F.lit(as_of).cast("date").alias("date"),
            F.col("yoy_revenue_growth").alias("yoy_revenue_growth_proxy"),
        )
    )


def yoy_revenue_growth_panel(revenue: DataFrame, dates: DataFrame) -> DataFrame:
    """``yoy_revenue_growth_proxy`` for every date of ``dates`` at once.

    A quarter's growth stands from the quarter after it until the ticker's next one; it is laid out over
    the quarters that the dates lie in, of which there are four a year.
    """
    by_quarter = Window.partitionBy("ticker").orderBy("quarter_no")
    days = dates.select(F.col("date").cast("date").alias("date")).distinct().withColumn(
        "in_quarter", scalar.quarter_index("date"))
    span = days.agg(F.min("in_quarter").alias("low"), F.max("in_quarter").alias("high")).first()
    if span["low"] is None:
        return revenue.sparkSession.createDataFrame([], "ticker string, date date, yoy_revenue_growth_proxy double")
    since = F.greatest(F.col("quarter_no") + 1, F.lit(span["low"]))
    until = F.least(F.lead("quarter_no", 1).over(by_quarter), F.lit(span["high"]))
    standing = (
        yoy_growth(revenue)
        .withColumns({"since": since, "until": until})
        .where(F.col("until") >= F.col("since"))
        .withColumn("in_quarter", F.explode(F.sequence("since", "until")))
    )
    # At most one row per calendar day.
    return standing.join(F.broadcast(days), "in_quarter").select(
        "ticker", "date", F.col("yoy_revenue_growth").alias("yoy_revenue_growth_proxy"))


def quarter_end(quarter_no: str) -> Column:
    """The last day of a quarter given by its number."""
    number = F.col(quarter_no)
    month = (F.pmod(number, F.lit(4)) * 3 + 3).cast("int")
    return F.last_day(F.make_date(F.floor(number / 4).cast("int"), month, F.lit(1)))


def growth_by_filing(filings: DataFrame) -> DataFrame:
    """(ticker, since, quarter_no, yoy_revenue_growth): what is known of a ticker from each of its filings on.

    filings: (ticker, quarter_no, revenue, filed), a row per filing; a quarter filed again is restated. Known at
    a time is the latest quarter filed by then, in its last version by then, and as its base the quarter four
    earlier in its last version by then, which a later restatement doesn't change in retrospect. Of two
    versions of one day the larger counts. What has no filing date is known from the day after its quarter.
    """
    known = filings.where(F.col("ticker").isNotNull() & F.col("quarter_no").isNotNull()).withColumn(
        "filed", F.coalesce(F.col("filed"), F.date_add(quarter_end("quarter_no"), 1)))
    versions = known.groupBy("ticker", "quarter_no", "filed").agg(F.max("revenue").alias("revenue"))
    so_far = Window.partitionBy("ticker").orderBy("since").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    events = versions.groupBy("ticker", F.col("filed").alias("since")).agg(
        F.max("quarter_no").alias("newest")).withColumn("latest", F.max("newest").over(so_far))
    # Both quarters by their own key, so only versions of one quarter meet.
    asked = events.select("ticker", "since", "latest", F.explode(F.array("latest", F.col("latest") - 4)).alias("quarter_no"))
    met = asked.join(versions, ["ticker", "quarter_no"]).where(F.col("filed") <= F.col("since"))

    def last(of: Column) -> Column:
        return F.max(F.when(F.col("quarter_no") == of, F.struct("filed", "revenue")))["revenue"]

    return met.groupBy("ticker", "since", "latest").agg(
        last(F.col("latest")).alias("now"), last(F.col("latest") - 4).alias("base")
    ).select("ticker", "since", F.col("latest").alias("quarter_no"),
             (F.try_divide(F.col("now"), F.col("base")) - 1).alias("yoy_revenue_growth"))


def growth_as_filed(filings: DataFrame, dates: DataFrame) -> DataFrame:
    """(ticker, date, yoy_revenue_growth_proxy) for every date of ``dates``: an as-of join on two times, the
    quarter a revenue belongs to and the day it was filed.

    A filing stands until the ticker's next one; each is laid out over its span inside the dates' range and
    matched with the dates, so no grid of tickers by dates is built.
    """
    wanted = dates.select(F.col("date").cast("date").alias("date")).distinct()
    span = wanted.agg(F.min("date").alias("low"), F.max("date").alias("high")).first()
    if span["low"] is None:
        return filings.sparkSession.createDataFrame([], schemas.FUNDAMENTAL_FEATURES)
    following = F.lead("since", 1).over(Window.partitionBy("ticker").orderBy("since"))
    begin = F.greatest(F.col("since"), F.lit(span["low"]))
    end = F.least(F.date_sub("next", 1), F.lit(span["high"]))
    standing = growth_by_filing(filings).withColumn("next", following).withColumns(
        {"begin": begin, "end": end}).where(F.col("end") >= F.col("begin"))
    laid_out = standing.withColumn("date", F.explode(F.sequence("begin", "end")))
    # At most one row per calendar day.
    return laid_out.join(F.broadcast(wanted), "date", "left_semi").select(
        "ticker", "date", F.col("yoy_revenue_growth").alias("yoy_revenue_growth_proxy"))
