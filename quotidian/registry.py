"""The engine's operators as named queries over a folder of warehouse tables.

Each entry takes (spark, folder) and returns a DataFrame. Doubles that come out of arithmetic are
rounded to six decimals, so that results can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotidian import schemas
from quotidian.functions import rolling, scalar
from quotidian.operators import curation, fundamentals, quality
from quotidian.operators.features import (
    price_features_as_of,
    price_features_panel,
    ticker_features,
)
from quotidian.operators.positions import generate_positions
from quotidian.operators.scoring import normalize_to_zscore, score_signals
from quotidian.plans import backfill, daily, marts
from quotidian.session import scratch_dir
from quotidian.sources import catalog, files, filings, lake as lake_io, listing, prices, publish, universe, warehouse
from quotidian.sources.lake import Lake

Query = Callable[[SparkSession, str], DataFrame]

# Suppliers trade on one day in five or so, so their lookback is longer than the default.
SUPPLIER_AS_OF = date(2000, 6, 30)
SUPPLIER_LOOKBACK = 400
BRAND_AS_OF = date(1998, 4, 11)
TICKER = "Supplier#000000001"
BRAND = "Brand#1"
SECTOR = "ASIA"
RANGE_START, RANGE_END = date(1998, 1, 1), date(1999, 12, 31)

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Registers a function under its name; a trailing underscore keeps it off an operator's."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Rounded columns; adding zero turns a negative zero into a plain one."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# --- inputs -----------------------------------------------------------------------------------

@query
def ohlcv_bars(spark, folder):
    return warehouse.supplier_bars(spark, folder)


@query
def brand_bars(spark, folder):
    return warehouse.brand_bars(spark, folder)


@query
def universe_dim(spark, folder):
    return universe.with_sectors(warehouse.universe(spark, folder))


@query
def universe_tickers(spark, folder):
    return universe.tickers(warehouse.universe(spark, folder))


def typed_quotes(spark, folder) -> DataFrame:
    return curation.coerce_prices(warehouse.raw_quotes(spark, folder), warehouse.QUOTE_ORDER)


@query
def raw_window_asof(spark, folder):
    """Each ticker's row of the run date, or its latest earlier one inside the ingest window."""
    window = prices.ingest_window(typed_quotes(spark, folder), BRAND_AS_OF)
    return prices.last_at_or_before(window, BRAND_AS_OF, warehouse.QUOTE_ORDER).select(
        *schemas.DAILY_PRICES.names
    )


@query
def ingest_windows(spark, folder):
    """Raw rows per day that ingests 200 days apart, each over 120 days, would fetch."""
    rows = warehouse.table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    fetched = backfill.in_ingest_windows("date", RANGE_START, RANGE_END, step_days=200)
    return rows.where(fetched).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))


@query
def ingest_anchor_dates(spark, folder):
    """The run dates that cover the whole history, from its last day backwards."""
    day = F.to_date("l_shipdate")
    span = warehouse.table(spark, folder, "lineitem").agg(
        F.min(day).alias("first"), F.max(day).alias("last")
    )
    steps = scalar.anchor_dates(F.col("first"), F.col("last"), schemas.INGEST_WINDOW_DAYS)
    return span.select(F.explode(steps).alias("date"))


@query
def landed_prices(spark, folder):
    """Quotes under a landed file's column names, in the raw schema."""
    quotes = warehouse.raw_quotes(spark, folder)
    landed = quotes.select(
        F.col("close").alias("Close"),
        F.col("date").alias("DateTime"),
        F.col("volume").alias("VOLUME"),
        F.col("open").alias("Open"),
        F.col("high").alias("high"),
        F.col("low").alias("LOW"),
        "ticker",
    )
    return prices.normalise_landed(landed)


@query
def dates_from_paths(spark, folder):
    """The dates that file names stand for, in all layouts; some names are no dates."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    path = (
        F.when(F.col("o_orderpriority") == "5-LOW", "/marts/scores/latest.parquet")
        .when(status == "F", F.format_string("/marts/scores/date=%s/part-0.parquet", day))
        .when(status == "O", F.format_string("/raw/%s/A.parquet", scalar.day_path("o_orderdate")))
        .otherwise(F.format_string("/marts/positions/%s.parquet", day))
    )
    paths = warehouse.table(spark, folder, "orders").select(path.alias("path"))
    days = paths.groupBy(scalar.day_from_path("path").alias("date"))
    return days.agg(F.count(F.lit(1)).alias("files"))


def raw_dates(spark, folder) -> DataFrame:
    lines = warehouse.table(spark, folder, "lineitem")
    return lines.select(F.to_date("l_shipdate").alias("date")).distinct()


@query
def available_raw_dates(spark, folder):
    """The dates of a stored raw layer, from its folders and its log."""
    return lake_io.dates_with_files(spark, raw_layer(spark, folder).raw_prices).select(
        "date",
        scalar.day_path("date").alias("day_path"),
        F.year("date").alias("year"),
        scalar.quarter_label("date").alias("quarter"),
    )


@query
def dates_to_process(spark, folder):
    """Days of the range with prices, enough earlier days, and no order still pending."""
    orders = warehouse.table(spark, folder, "orders")
    done = (
        orders.where(F.col("o_orderstatus") == "P")
        .select(F.to_date("o_orderdate").alias("date"))
        .distinct()
    )
    available = raw_dates(spark, folder)
    wanted = backfill.dates_to_process(available, done, RANGE_START, RANGE_END)
    return wanted.join(backfill.with_enough_history(available), "date", "left_semi")


@query
def dates_with_history(spark, folder):
    return backfill.with_enough_history(raw_dates(spark, folder))


# --- curation and quality ---------------------------------------------------------------------

@query
def curate_prices(spark, folder):
    raw = warehouse.raw_quotes(spark, folder)
    return curation.curate_daily_prices(raw, BRAND_AS_OF, warehouse.QUOTE_ORDER)


@query
def curate_prices_fallback(spark, folder):
    """No row has the run date, so the latest date is curated."""
    raw = warehouse.raw_quotes(spark, folder)
    return curation.curate_daily_prices(raw, date(2030, 1, 1), warehouse.QUOTE_ORDER)


@query
def curate_prices_all(spark, folder):
    return curation.curate_all_dates(warehouse.raw_quotes(spark, folder), warehouse.QUOTE_ORDER)


@query
def curate_landing_partitions(spark, folder):
    """Landing partitions dated month ends: a partition keeps its own date, else its latest."""
    raw = warehouse.raw_quotes(spark, folder).withColumn("landed_on", F.last_day("date"))
    return curation.curate_price_partitions(raw, "landed_on", warehouse.QUOTE_ORDER)


@query
def dq_report(spark, folder):
    report = quality.quality_report(curation.coerce_prices(warehouse.raw_quotes(spark, folder)))
    return report.withColumn("failed", F.col("failed").cast("int"))


@query
def manifest_curated(spark, folder):
    return with_text_time(curation.curate_filings(warehouse.filing_manifest(spark, folder)))


@query
def filing_priority(spark, folder):
    manifest = curation.curate_filings(warehouse.filing_manifest(spark, folder))
    return with_text_time(curation.prefer_filing_type(manifest))


def with_text_time(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn(
        "download_time", F.date_format("download_time", "yyyy-MM-dd HH:mm:ss")
    )


# --- rolling features -------------------------------------------------------------------------

@query
def returns(spark, folder):
    bars = warehouse.supplier_bars(spark, folder).select("ticker", "date", "close")
    return rounded(rolling.simple_return(bars), "ret")


@query
def returns_with_gaps(spark, folder):
    """Returns of curated opens, many of which are missing."""
    curated = curate_prices_all(spark, folder).select("ticker", "date", "open")
    return rounded(rolling.simple_return(curated, price_col="open"), "ret")


@query
def realized_vol(spark, folder):
    bars = warehouse.supplier_bars(spark, folder).select("ticker", "date", "close")
    return rounded(rolling.realized_volatility(bars), "realized_vol_20d")


@query
def momentum(spark, folder):
    bars = warehouse.supplier_bars(spark, folder).select("ticker", "date", "close")
    return rounded(rolling.momentum(bars), "momentum_60d")


@query
def mean_reversion_z(spark, folder):
    bars = warehouse.supplier_bars(spark, folder).select("ticker", "date", "close")
    return rounded(rolling.mean_reversion_zscore(bars), "mean_reversion_zscore_5d")


def supplier_features(spark, folder, shared: bool = False) -> DataFrame:
    bars = warehouse.supplier_bars(spark, folder)
    return price_features_as_of(bars, SUPPLIER_AS_OF, SUPPLIER_LOOKBACK, shared=shared)


def brand_features(spark, folder) -> DataFrame:
    return price_features_as_of(warehouse.brand_bars(spark, folder), BRAND_AS_OF)


def brand_panel(spark, folder, shared: bool = False) -> DataFrame:
    bars = warehouse.brand_bars(spark, folder)
    return price_features_panel(bars, raw_dates(spark, folder), shared=shared)


def gapped_panel(spark, folder) -> DataFrame:
    """Every date's features from curated opens, many of which are missing."""
    opens = curate_prices_all(spark, folder).withColumn("close", F.col("open"))
    return price_features_panel(opens, raw_dates(spark, folder), SUPPLIER_LOOKBACK)


@query
def price_features_asof(spark, folder):
    return rounded(supplier_features(spark, folder), *schemas.PRICE_FEATURE_COLUMNS)


@query
def price_features_brand(spark, folder):
    return rounded(brand_features(spark, folder), *schemas.PRICE_FEATURE_COLUMNS)


@query
def price_features_panel_(spark, folder):
    return rounded(brand_panel(spark, folder), *schemas.PRICE_FEATURE_COLUMNS)


@query
def price_features_gaps(spark, folder):
    return rounded(gapped_panel(spark, folder), *schemas.PRICE_FEATURE_COLUMNS)


@query
def yoy_growth(spark, folder):
    growth = fundamentals.yoy_growth(warehouse.quarterly_revenue(spark, folder))
    return rounded(rounded(growth, "yoy_revenue_growth"), "revenue", digits=4)


@query
def fundamental_features(spark, folder):
    return rounded(supplier_fundamentals(spark, folder), "yoy_revenue_growth_proxy")


def supplier_fundamentals(spark, folder) -> DataFrame:
    revenue = warehouse.quarterly_revenue(spark, folder)
    return fundamentals.yoy_revenue_growth_proxy(revenue, SUPPLIER_AS_OF)


# --- scores and books -------------------------------------------------------------------------

Z_COLUMNS = tuple(f"{c}_zscore" for c in schemas.PRICE_FEATURE_COLUMNS)


@query
def zscore_by_date(spark, folder):
    bars = warehouse.supplier_bars(spark, folder).select("ticker", "date", "close")
    return rounded(normalize_to_zscore(bars, "close", out="close_z"), "close_z")


@query
def zscore_by_sector(spark, folder):
    """Another grouping than the date, with groups as large as the data makes them."""
    bars = warehouse.supplier_bars(spark, folder).select("ticker", "date", "close")
    sized = universe.enrich(bars, warehouse.universe(spark, folder)).drop("company")
    return rounded(normalize_to_zscore(sized, "close", "sector", "close_z"), "close_z")


def supplier_scores(spark, folder) -> DataFrame:
    return score_signals(supplier_features(spark, folder, shared=True))


def brand_scores(spark, folder) -> DataFrame:
    return score_signals(brand_panel(spark, folder, shared=True))


@query
def signal_scores(spark, folder):
    return rounded(supplier_scores(spark, folder), *Z_COLUMNS, "signal_score")


@query
def signal_scores_with_fundamentals(spark, folder):
    features = supplier_features(spark, folder, shared=True)
    scores = score_signals(features, supplier_fundamentals(spark, folder))
    return rounded(
        scores, *Z_COLUMNS, "yoy_revenue_growth_proxy", "yoy_revenue_growth_proxy_zscore", "signal_score"
    )


@query
def signal_scores_panel(spark, folder):
    return rounded(brand_scores(spark, folder), *Z_COLUMNS, "signal_score")


def supplier_book(spark, folder) -> DataFrame:
    return generate_positions(supplier_scores(spark, folder))


@query
def positions(spark, folder):
    return rounded(supplier_book(spark, folder), "signal_score")


@query
def positions_panel(spark, folder):
    """The book of every date, three a side."""
    book = generate_positions(brand_scores(spark, folder), n_longs=3, n_shorts=3)
    return rounded(book, "signal_score")


# --- mart queries -----------------------------------------------------------------------------

@query
def scores_enriched(spark, folder):
    day = marts.latest_signal_scores(
        supplier_scores(spark, folder), warehouse.universe(spark, folder), SUPPLIER_AS_OF
    )
    return rounded(day, "signal_score")


@query
def scores_enriched_sector(spark, folder):
    day = marts.latest_signal_scores(
        supplier_scores(spark, folder), warehouse.universe(spark, folder), sector=SECTOR
    )
    return rounded(day, "signal_score")


@query
def scores_enriched_latest(spark, folder):
    """Scores of the latest date of the whole history."""
    day = marts.latest_signal_scores(
        brand_scores(spark, folder), warehouse.brand_universe(spark, folder)
    )
    return rounded(day, "signal_score")


@query
def positions_enriched(spark, folder):
    book = marts.latest_positions(supplier_book(spark, folder), warehouse.universe(spark, folder))
    return rounded(book, "signal_score")


@query
def positions_by_date(spark, folder):
    return rounded(marts.positions_of(supplier_book(spark, folder), SUPPLIER_AS_OF), "signal_score")


@query
def price_history(spark, folder):
    return prices.price_history(warehouse.supplier_bars(spark, folder, TICKER), TICKER)


@query
def ticker_features_(spark, folder):
    bars = warehouse.supplier_bars(spark, folder, TICKER)
    own = ticker_features(price_features_as_of(bars, SUPPLIER_AS_OF, SUPPLIER_LOOKBACK), TICKER)
    return rounded(own, *schemas.PRICE_FEATURE_COLUMNS)


@query
def ticker_score_date(spark, folder):
    return marts.latest_score_date(brand_scores(spark, folder), BRAND)


@query
def ticker_features_latest(spark, folder):
    """A brand's features on its own latest score date."""
    own = marts.features_of_ticker(
        warehouse.brand_bars(spark, folder), brand_scores(spark, folder), BRAND
    )
    return rounded(own, *schemas.PRICE_FEATURE_COLUMNS)


@query
def ticker_score(spark, folder):
    return rounded(marts.ticker_score(supplier_scores(spark, folder), TICKER), "signal_score")


@query
def sector_exposure(spark, folder):
    book, names = supplier_book(spark, folder), warehouse.universe(spark, folder)
    return marts.sector_exposure(book, names, SUPPLIER_AS_OF)


@query
def exposure_series(spark, folder):
    return marts.exposure_series(sector_exposure(spark, folder))


@query
def available_dates(spark, folder):
    return marts.available_dates(brand_scores(spark, folder))


@query
def available_tickers(spark, folder):
    return marts.available_tickers(supplier_scores(spark, folder))


@query
def available_sectors(spark, folder):
    return universe.sectors(warehouse.universe(spark, folder))


def overview_side(spark, folder, side: str) -> DataFrame:
    book, names = supplier_book(spark, folder), warehouse.universe(spark, folder)
    return rounded(
        marts.candidates_from_positions(book, names, side, SUPPLIER_AS_OF, SECTOR), "signal_score"
    )


def fallback_side(spark, folder, side: str) -> DataFrame:
    scores, names = supplier_scores(spark, folder), warehouse.universe(spark, folder)
    day = marts.candidates_from_scores(scores, names, side, SUPPLIER_AS_OF, SECTOR)
    return rounded(day, "signal_score")


@query
def overview_long(spark, folder):
    return overview_side(spark, folder, "long")


@query
def overview_short(spark, folder):
    return overview_side(spark, folder, "short")


@query
def overview_long_fallback(spark, folder):
    return fallback_side(spark, folder, "long")


@query
def overview_short_fallback(spark, folder):
    return fallback_side(spark, folder, "short")


@query
def vol_bands(spark, folder):
    bars = warehouse.supplier_bars(spark, folder, TICKER)
    features = price_features_as_of(bars, SUPPLIER_AS_OF, SUPPLIER_LOOKBACK)
    return rounded(marts.volatility_bands(bars, features, TICKER), "upper_band", "lower_band")


@query
def feature_breakdown(spark, folder):
    return rounded(marts.feature_breakdown(supplier_features(spark, folder)), "value")


# --- tables and SQL ---------------------------------------------------------------------------

@query
def table_row_counts(spark, folder):
    return catalog.count_rows({n: warehouse.table(spark, folder, n) for n in warehouse.TABLES})


@query
def adhoc_sql(spark, folder):
    """A user's own statement over registered views, with a bound value."""
    catalog.register_views({
        "daily_prices": warehouse.supplier_bars(spark, folder),
        "universe": warehouse.universe(spark, folder),
    })
    return catalog.run_query(
        spark,
        """
        SELECT u.sector, year(p.date) AS year, count(*) AS bars, max(p.high) AS top,
               min(p.low) AS bottom, sum(p.volume) AS volume
        FROM daily_prices p JOIN universe u ON p.ticker = u.ticker
        WHERE p.date >= :since
        GROUP BY u.sector, year(p.date)
        """,
        since=RANGE_START,
    )


@query
def union_by_name(spark, folder):
    """Bars of both kinds of ticker, where each side lacks a column of the other."""
    return prices.union_by_name([
        warehouse.supplier_bars(spark, folder).select("ticker", "date", "close", "open"),
        warehouse.brand_bars(spark, folder).select("volume", "date", "ticker", "close"),
    ])


@query
def signal_scores_infinite(spark, folder):
    """Some closes are infinite or no number: they count as unknown, and no other ticker's scores change."""
    wild = F.when(F.dayofmonth("date") == 5, F.lit(float("inf"))).when(F.dayofmonth("date") == 17, F.lit(float("nan")))
    bars = warehouse.supplier_bars(spark, folder).withColumn("close", F.coalesce(wild, F.col("close")))
    features = price_features_as_of(bars, SUPPLIER_AS_OF, SUPPLIER_LOOKBACK)
    return rounded(score_signals(features), *Z_COLUMNS, "signal_score")


@query
def signal_scores_panel_with_fundamentals(spark, folder):
    """Prices and revenue growth of the brands, scored on every date at once."""
    dates = raw_dates(spark, folder)
    features = price_features_panel(warehouse.brand_bars(spark, folder), dates)
    growth = fundamentals.yoy_revenue_growth_panel(warehouse.quarterly_brand_revenue(spark, folder), dates)
    scores = score_signals(features, growth)
    return rounded(scores, *[c for c in scores.columns if c not in ("ticker", "date")])


# --- landed files and listings ----------------------------------------------------------------

def landed_csv_files(spark, folder) -> DataFrame:
    """The brands' bars as landed files in three layouts: other headers, column orders and date texts. On the
    13th of a month there is no date that can be read. One layout has 200 columns, the close the last of them,
    and one a note with a line end, a comma and quotes in it."""
    root = scratch_dir(spark, "landing")
    bars = warehouse.brand_bars(spark, folder).withColumn(
        "layout", F.pmod(F.ascii(F.substring("ticker", -1, 1)), F.lit(3)))
    layouts = (
        (("Date", "Open", "High", "Low", "Close", "Volume"), "yyyy-MM-dd"),
        (("close", "DateTime", "VOLUME", "open", "high", "low"), "MM/dd/yyyy"),
        (("Volume", "Close", "Low", "High", "Open", "date"), "yyyyMMdd"),
    )
    for k, (names, form) in enumerate(layouts):
        text = F.when(F.dayofmonth("date") == 13, "n/a").otherwise(F.date_format("date", form))
        rows = bars.where(F.col("layout") == k).withColumn("date", text)
        named = [F.col("date" if n.lower() == "datetime" else n.lower()).alias(n) for n in names]
        if k == 1:
            named.insert(1, F.lit('one,\n"two"\r\nthree').alias("Note"))
        if k == 2:
            close = named.pop(1)
            named = [*named, *[F.col("volume").alias(f"x{i}") for i in range(194)], close]
        rows.repartition("ticker").select("ticker", *named).write.mode("append").option("header", True).option(
            "escape", '"').partitionBy("ticker").csv(root)
    return prices.read_landed_csv(spark, root)


@query
def landed_csv(spark, folder):
    return prices.normalise_landed(landed_csv_files(spark, folder)).where(F.col("date").isNotNull())


@query
def rejected_rows(spark, folder):
    rows = prices.rejected(landed_csv_files(spark, folder))
    return rows.select("ticker", F.col("date").alias("date_text"), F.col("close").cast("double"), "reason")


@query
def filing_listing(spark, folder):
    """Stored filings listed by folder, with an empty and a hidden file among them."""
    root = scratch_dir(spark, "downloads")
    manifest = warehouse.filing_manifest(spark, folder).where(
        F.col("filing_type").isin("10-Q", "10-K") & (F.col("file_path") != ""))
    ticker = F.coalesce(F.url_encode(F.nullif("ticker", F.lit(""))), F.lit("__HIVE_DEFAULT_PARTITION__"))
    below = F.concat(F.lit("ticker="), ticker, F.lit("/filing_type="), "filing_type", F.lit("/part-0.txt"))
    listing.write_texts(manifest.groupBy(below.alias("below")).agg(F.max("file_path").alias("value")), root)
    for name in ("empty.txt", "_hidden.txt", ".dotted.txt"):
        files.touch(spark, f"{root}/ticker=NONE/filing_type=8-K/{name}")
    listed = filings.list_filings(spark, root)
    plain = [F.url_decode(F.regexp_replace(c, "^[a-z_]+=", "")).alias(c) for c in ("ticker", "filing_type")]
    return listed.select(*plain).groupBy("ticker", "filing_type").agg(F.count(F.lit(1)).alias("files"))


# --- stored tables ----------------------------------------------------------------------------

@query
def curated_price_upsert(spark, folder):
    """All months of curated prices are stored; then one month is stored again without volumes. The other
    partitions must stay."""
    table = f"{scratch_dir(spark, 'upsert')}/daily_prices"
    months = warehouse.supplier_bars(spark, folder).withColumn("month", F.trunc("date", "month"))
    lake_io.overwrite_partitions(months, table, ["month"], ["ticker", "date"])
    april = F.col("month") == F.lit(date(1998, 4, 1))
    again = months.where(april).withColumn("volume", F.lit(None).cast("bigint"))
    lake_io.overwrite_partitions(again, table, ["month"], ["ticker", "date"])
    return spark.read.parquet(table).select(*schemas.DAILY_PRICES.names)


@query
def fundamentals_by_quarter(spark, folder):
    """Manifests stored raw by quarter, read back, curated, stored and counted."""
    lake = Lake(scratch_dir(spark, "filings"))
    by = (["year", "quarter"], ["ticker", "filing_type"])
    lake_io.overwrite_partitions(warehouse.filing_manifest(spark, folder), lake.raw_filings, *by)
    curated = curation.curate_filings(filings.read_manifests(spark, lake.raw_filings))
    lake_io.overwrite_partitions(curated, lake.quarterly_fundamentals, *by)
    stored = lake_io.read_table(spark, lake.quarterly_fundamentals, schemas.QUARTERLY_FUNDAMENTALS)
    return stored.groupBy("year", "quarter", "filing_type").agg(
        F.count(F.lit(1)).alias("filings"), F.count_distinct("ticker").alias("tickers")
    )


def raw_layer(spark, folder) -> Lake:
    """A new lake whose raw layer holds all brand prices, a partition per day."""
    lake = Lake(scratch_dir(spark, "lake"))
    daily.append_raw_prices(warehouse.brand_bars(spark, folder), lake)
    return lake


def curated_layer(spark, folder) -> Lake:
    """A new lake whose curated layer holds them too."""
    lake = raw_layer(spark, folder)
    days = lake_io.stored_days(spark, lake.raw_prices)
    curated = curation.curate_all_dates(prices.read_raw(spark, lake.raw_prices), daily.INGEST_ORDER)
    lake_io.overwrite_partitions(curated, lake.daily_prices, days=days)
    return lake


def stored_prices(spark, lake: Lake) -> DataFrame:
    return lake_io.read_table(spark, lake.daily_prices, schemas.DAILY_PRICES)


@query
def raw_reingest(spark, folder):
    """The same bars are ingested three times, the last time with other closes on first days of a month:
    only those are added."""
    lake = Lake(scratch_dir(spark, "reingest"))
    with daily.staged(warehouse.brand_bars(spark, folder), lake, "bars") as bars:
        daily.append_raw_prices(bars, lake)
        daily.append_raw_prices(bars, lake)
        first = F.dayofmonth("date") == 1
        daily.append_raw_prices(
            bars.withColumn("close", F.when(first, F.col("close") * 2).otherwise(F.col("close"))), lake)
    return prices.read_raw(spark, lake.raw_prices).select("ticker", "date", "close")


@query
def curate_day(spark, folder):
    """Prices and filings of a day, from the raw layer to the stored tables."""
    lake = raw_layer(spark, folder)
    report = daily.curate_day(spark, lake, BRAND_AS_OF)
    return stored_prices(spark, lake).where(F.col("date") == F.lit(report["date"]))


@query
def curate_day_fallback(spark, folder):
    """No prices on the run date, nor in the ingest window before it: the latest day there is."""
    lake = raw_layer(spark, folder)
    report = daily.curate_day(spark, lake, date(2030, 1, 1))
    return stored_prices(spark, lake).where(F.col("date") == F.lit(report["date"]))


@query
def daily_build(spark, folder):
    """One day from the raw layer to the stored book."""
    lake = curated_layer(spark, folder)
    daily.build_day(spark, lake, BRAND_AS_OF)
    stored = lake_io.read_table(spark, lake.positions, schemas.POSITIONS)
    return rounded(marts.positions_of(stored, BRAND_AS_OF), "signal_score")


@query
def backfill_build(spark, folder):
    """All dates from the raw layer to the stored scores: curation, checks, gate and features."""
    lake = raw_layer(spark, folder)
    backfill.backfill(spark, lake, date(1900, 1, 1), date(2100, 1, 1), run_features=True)
    stored = lake_io.read_scores(spark, lake.signal_scores)
    return rounded(stored, *Z_COLUMNS, "signal_score")


@query
def incremental_build(spark, folder):
    """The last ten dates one after the other, each from the state of the one before and its own partition."""
    lake = curated_layer(spark, folder)
    days = lake_io.stored_days(spark, lake.daily_prices)[-10:]
    for day in days:
        daily.build_day(spark, lake, day)
    return rounded(publish.published_scores(spark, lake), *Z_COLUMNS, "signal_score")


@query
def overnight_change_day(spark, folder):
    """Some closes of a day are 1.7 times what they were: the day's run finds them against the stored closes."""
    lake = Lake(scratch_dir(spark, "jumps"))
    since = BRAND_AS_OF - timedelta(days=schemas.FEATURE_LOOKBACK_DAYS + 1)
    jumps = (F.col("date") == F.lit(BRAND_AS_OF)) & (F.ascii(F.substring("ticker", -1, 1)) % 2 == 1)
    bars = warehouse.brand_bars(spark, folder).where(F.col("date").between(F.lit(since), F.lit(BRAND_AS_OF)))
    daily.append_raw_prices(bars.withColumn("close", F.when(jumps, F.col("close") * 1.7).otherwise(F.col("close"))), lake)
    backfill.backfill(spark, lake, since, BRAND_AS_OF - timedelta(days=1))
    report = daily.curate_prices_day(spark, lake, BRAND_AS_OF)
    found = [(report["date"], w) for w in report["warnings"] if "overnight" in w]
    return spark.createDataFrame(found, "date date, warning string")


@query
def unreadable_files(spark, folder):
    """The first day of every month has an empty and a damaged file, which a run over all dates reports; the
    others' rows are all there."""
    lake = Lake(scratch_dir(spark, "damaged"))
    daily.append_raw_prices(warehouse.brand_bars(spark, folder), lake)
    days = [d for d in lake_io.stored_days(spark, lake.raw_prices) if d.day == 1]
    for day in days:
        files.touch(spark, f"{lake.raw_prices}/date={day}/empty.parquet")
        files.write_text(spark, f"{lake.raw_prices}/date={day}/broken.parquet", "PAR1 and no more")
    backfill.backfill(spark, lake, date(1900, 1, 1), date(2100, 1, 1))
    found = spark.read.parquet(f"{lake.unreadable_files}/table=raw.prices")
    rows = stored_prices(spark, lake).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
    named = found.select(
        scalar.day_from_path("file_path").alias("date"),
        F.element_at(F.split("file_path", "/"), -1).alias("name"), "size")
    return named.join(rows, "date", "left")


def filed_revenue(spark, folder) -> Lake:
    """A new lake whose revenue was landed as files, once over again."""
    lake = Lake(scratch_dir(spark, "revenue"))
    landing = scratch_dir(spark, "revenue-files")
    first = F.make_date(F.floor(F.col("quarter_no") / 4).cast("int"), (F.col("quarter_no") % 4 * 3 + 2).cast("int"), F.lit(5))
    rows = warehouse.revenue_filings(spark, folder).select(
        F.date_format("filed", "MM/dd/yyyy").alias("Filed"), F.round("revenue", 4).alias("Revenue"), "ticker",
        first.alias("Quarter"))
    rows.write.option("header", True).csv(landing)
    for _ in range(2):
        daily.ingest_revenue(spark, lake, landing)
    return lake


@query
def revenue_ingest(spark, folder):
    lake = filed_revenue(spark, folder)
    return lake_io.read_table(spark, lake.quarterly_revenue, schemas.REVENUE_FILINGS)


@query
def fundamentals_as_filed(spark, folder):
    """Growth on the first days of months, by what was filed until then, restatements included."""
    first = raw_dates(spark, folder).where(F.dayofmonth("date") == 1)
    growth = fundamentals.growth_as_filed(warehouse.revenue_filings(spark, folder), first)
    return rounded(growth, "yoy_revenue_growth_proxy")


@query
def dq_missing_column(spark, folder):
    """Prices without their volumes: the report ends with the columns that lack."""
    return report_rows(spark, curation.coerce_prices(warehouse.raw_quotes(spark, folder)).drop("volume", "low"))


@query
def dq_empty(spark, folder):
    """No price is as old: an empty table is valid, with a warning."""
    typed = curation.coerce_prices(warehouse.raw_quotes(spark, folder))
    return report_rows(spark, typed.where(F.col("date") < F.lit(date(1900, 1, 1))))


def report_rows(spark, typed: DataFrame) -> DataFrame:
    report = quality.validate_daily_prices(typed, fail_on_error=False)
    return spark.createDataFrame(
        [(report["valid"], ";".join(report["errors"]), ";".join(report["warnings"]),
          report["stats"]["total_rows"], report["stats"]["unique_tickers"])],
        "valid boolean, errors string, warnings string, total_rows long, unique_tickers long")


@query
def dq_first_error(spark, folder):
    """Asked to, the check raises at its first error, in the order of the checks."""
    try:
        quality.validate_daily_prices(curation.coerce_prices(warehouse.raw_quotes(spark, folder)), fail_on_error=True)
    except quality.ValidationError as error:
        return spark.createDataFrame([(str(error),)], "error string")
    return spark.createDataFrame([], "error string")


@query
def required_columns(spark, folder):
    """What each kind of input lacks to be curated prices; what lacks nothing is counted."""
    inputs = {
        "bars": warehouse.supplier_bars(spark, folder),
        "quotes": warehouse.raw_quotes(spark, folder).drop("open", "source"),
        "filings": warehouse.filing_manifest(spark, folder),
    }
    found = []
    for name, rows in inputs.items():
        try:
            found.append((name, "", curation.require_columns(rows, schemas.DAILY_PRICES.names).count()))
        except curation.MissingColumns as error:
            found.append((name, str(error), None))
    return spark.createDataFrame(found, "input string, error string, row_count long")


@query
def curated_order(spark, folder):
    """The place of each row in its date's stored file: by ticker."""
    table = f"{scratch_dir(spark, 'ordered')}/daily_prices"
    lake_io.overwrite_partitions(warehouse.brand_bars(spark, folder).repartition(7, "open"), table)
    stored = spark.read.schema(schemas.DAILY_PRICES).parquet(table)
    return stored.select("date", "ticker", F.col("_metadata.row_index").alias("place"))


@query
def run_date_prices(spark, folder):
    """The bars of a run date given as text."""
    day = scalar.parse_run_date(BRAND_AS_OF.isoformat())
    return warehouse.brand_bars(spark, folder).where(F.col("date") == F.lit(day))


# --- catalog ----------------------------------------------------------------------------------

@query
def table_sample(spark, folder):
    """How many rows a table's sample has, and how many of those are the table's."""
    schema = loaded_schema(spark, folder, "orders")
    sample = catalog.show_table_info(spark, "orders", schema, limit=7)["sample"]
    own = sample.join(spark.table(f"{schema}.orders"), "o_orderkey", "left_semi").count()
    return spark.createDataFrame([(sample.count(), own)], "sampled long, found long")


def loaded_schema(spark, folder, *tables: str) -> str:
    """A schema of its own in scratch, with tables loaded into it."""
    place = scratch_dir(spark, "schema")
    name = f"q{place.rpartition('-')[2]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{place}'")
    for table in tables:
        catalog.load_parquet_to_table(spark, f"{folder}/{table}.parquet", table, name)
    return name


@query
def list_tables(spark, folder):
    return catalog.list_tables(spark, loaded_schema(spark, folder, "supplier", "customer", "orders"))


@query
def describe_table(spark, folder):
    info = catalog.show_table_info(spark, "orders", loaded_schema(spark, folder, "orders"))
    names = [(name, info["row_count"]) for name, _ in info["columns"]]
    return spark.createDataFrame(names, "column_name string, row_count long")


@query
def load_modes(spark, folder):
    """The row count after each way of loading over an existing table."""
    schema, path = loaded_schema(spark, folder, "orders"), f"{folder}/orders.parquet"
    counts = [(mode, catalog.load_parquet_to_table(spark, path, "orders", schema, mode)) for mode in ("append", "replace")]
    try:
        catalog.load_parquet_to_table(spark, path, "orders", schema, "fail")
    except AnalysisException:
        counts.append(("fail", spark.table(f"{schema}.orders").count()))
    return spark.createDataFrame(counts, "mode string, row_count long")


@query
def typed_empty(spark, folder):
    """A table that is there, and one that is not, by the same call."""
    schema = loaded_schema(spark, folder, "orders")
    there = spark.table(f"{schema}.orders").schema
    rows = {name: catalog.table_or_empty(spark, name, there, schema) for name in ("orders", "absent")}
    counts = [(name, len(df.columns), df.count()) for name, df in rows.items()]
    return spark.createDataFrame(counts, "table_name string, columns int, row_count long")
