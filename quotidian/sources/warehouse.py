"""Prices, universe, filings and revenue derived from an order warehouse.

Gives the engine its inputs from the tables region, nation, supplier, customer, part, orders and
lineitem: every order line is a trade, a supplier or a brand is a ticker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotidian import schemas
from quotidian.functions import scalar

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def trade_price() -> Column:
    return F.col("l_extendedprice") / F.col("l_quantity")


def trade_order(*more: str) -> Column:
    """Order of the trades of a day. The line key repeats, so the traded values follow it."""
    return F.struct(
        "l_orderkey", "l_linenumber", "l_partkey", *more, "l_quantity", "l_extendedprice"
    )


def bars_by(trades: DataFrame, key: str, order: Column) -> DataFrame:
    """(key, date, open, high, low, close, volume): one bar per key and day with trades.

    Map-side aggregation reduces a busy key before the shuffle, and the shuffle is by key *and* day,
    so one key is spread over as many tasks as it has days.
    """
    price = trade_price()
    return trades.groupBy(key, F.to_date("l_shipdate").alias("date")).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
    )


def supplier_bars(spark: SparkSession, folder: str, ticker: str | None = None) -> DataFrame:
    """Curated daily prices with suppliers as tickers, of one ticker if given.

    For all tickers the names are joined to the bars, which are fewer than the trades. For one the
    join comes first and keeps its trades alone.
    """
    lines = table(spark, folder, "lineitem")
    names = table(spark, folder, "supplier").select("s_suppkey", F.col("s_name").alias("ticker"))
    if ticker is not None:
        wanted = names.where(F.col("ticker") == ticker)
        trades = lines.join(wanted, lines["l_suppkey"] == wanted["s_suppkey"])
        bars = bars_by(trades, "ticker", trade_order())
    else:
        bars = bars_by(lines, "l_suppkey", trade_order())
        bars = bars.join(names, bars["l_suppkey"] == names["s_suppkey"])
    return bars.select(
        "date", "ticker", "open", "high", "low", "close", "volume",
        F.lit(schemas.PRICE_SOURCE).alias("source"),
    )


def brand_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Curated daily prices with brands as tickers: few tickers, with a bar on most days."""
    brands = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("ticker"))
    lines = table(spark, folder, "lineitem")
    trades = lines.join(brands, lines["l_partkey"] == brands["p_partkey"])
    return bars_by(trades, "ticker", trade_order("l_suppkey")).select(
        "date", "ticker", "open", "high", "low", "close", "volume",
        F.lit(schemas.PRICE_SOURCE).alias("source"),
    )


def universe(spark: SparkSession, folder: str) -> DataFrame:
    """(ticker, company, sector, cik): supplier, its nation, its region, its key."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    supplier = table(spark, folder, "supplier")
    return supplier.join(places, supplier["s_nationkey"] == places["n_nationkey"], "left").select(
        F.col("s_name").alias("ticker"),
        F.col("n_name").alias("company"),
        F.col("r_name").alias("sector"),
        F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("cik"),
    )


QUOTE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


def raw_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Uncurated price rows, one per order line, with the faults curation is there for: several rows
    per ticker and day, opens and volumes as text that is not always a number, volumes ending in
    .5, negative volumes, closes outside the day's range, highs below lows."""
    names = table(spark, folder, "supplier").select("s_suppkey", F.col("s_name").alias("ticker"))
    lines = table(spark, folder, "lineitem")
    price = trade_price()
    return lines.join(names, lines["l_suppkey"] == names["s_suppkey"]).select(
        F.col("l_shipdate").alias("date"),
        "ticker",
        F.when(F.col("l_returnflag") == "R", "n/a").otherwise(price.cast("string")).alias("open"),
        (price * (F.lit(0.98) + F.col("l_tax"))).alias("high"),
        (price * (F.lit(1.0) - F.col("l_discount"))).alias("low"),
        price.alias("close"),
        F.when(F.col("l_returnflag") == "N", "")
        .otherwise((F.col("l_quantity") - 10.5).cast("string"))
        .alias("volume"),
        F.lit(schemas.PRICE_SOURCE).alias("source"),
        *QUOTE_ORDER,
    )


def quarterly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """(ticker, quarter_no, revenue) of the suppliers."""
    names = table(spark, folder, "supplier").select("s_suppkey", F.col("s_name").alias("ticker"))
    revenue = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", scalar.quarter_index("l_shipdate").alias("quarter_no"))
        .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    )
    return revenue.join(names, revenue["l_suppkey"] == names["s_suppkey"]).select(
        "ticker", "quarter_no", "revenue"
    )


def quarterly_brand_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """(ticker, quarter_no, revenue) of the brands."""
    brands = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("ticker"))
    lines = table(spark, folder, "lineitem")
    return (
        lines.join(brands, lines["l_partkey"] == brands["p_partkey"])
        .groupBy("ticker", scalar.quarter_index("l_shipdate").alias("quarter_no"))
        .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    )


def revenue_filings(spark: SparkSession, folder: str) -> DataFrame:
    """(ticker, quarter_no, revenue, filed): each supplier files a quarter 20 to 59 days after its end, without
    what is returned, and files it again 90 days later with everything."""
    names = table(spark, folder, "supplier").select("s_suppkey", F.col("s_name").alias("ticker"))
    value = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    sums = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", scalar.quarter_index("l_shipdate").alias("quarter_no"),
                 F.last_day(F.add_months(F.trunc("l_shipdate", "quarter"), 2)).alias("end"))
        .agg(F.sum(F.when(F.col("l_returnflag") != "R", value)).alias("first"), F.sum(value).alias("last"))
    )
    own = (F.lit(20) + F.col("l_suppkey") % 40).cast("int")
    filed = F.explode(F.array(
        F.struct(F.date_add("end", own).alias("filed"), F.col("first").alias("revenue")),
        F.struct(F.date_add("end", own + 90).alias("filed"), F.col("last").alias("revenue")),
    )).alias("f")
    return sums.join(names, sums["l_suppkey"] == names["s_suppkey"]).select("ticker", "quarter_no", filed).select(
        "ticker", "quarter_no", "f.revenue", "f.filed").where("revenue IS NOT NULL")


def filing_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Uncurated filing manifests: an order is a filing of its customer; some name no file."""
    customer = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("ticker"))
    orders = table(spark, folder, "orders")
    form = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "10-Q")
        .when(F.col("o_orderpriority") == "2-HIGH", "10-K")
        .otherwise("8-K")
    )
    path = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("/filings/"), F.col("o_orderkey")))
        .when(F.col("o_orderstatus") == "O", "")
    )
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        "ticker",
        form.alias("filing_type"),
        F.col("o_orderdate").cast("timestamp").alias("download_time"),
        path.alias("file_path"),
        F.lit(schemas.FILING_SOURCE).alias("source"),
        F.year("o_orderdate").alias("year"),
        scalar.quarter_label("o_orderdate").alias("quarter"),
    )


def brand_universe(spark: SparkSession, folder: str) -> DataFrame:
    """(ticker, company, sector): each brand with the name and type of its newest part."""
    newest = F.max(F.struct("p_partkey", "p_name", "p_type")).alias("newest")
    return table(spark, folder, "part").groupBy(F.col("p_brand").alias("ticker")).agg(newest).select(
        "ticker", F.col("newest.p_name").alias("company"), F.col("newest.p_type").alias("sector")
    )
