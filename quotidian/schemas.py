"""Table schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

UNIVERSE = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("cik", T.StringType()),
])

RAW_PRICES = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("source", T.StringType()),
])

DAILY_PRICES = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("source", T.StringType()),
])

MANIFEST = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("filing_type", T.StringType()),
    T.StructField("download_time", T.TimestampType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("source", T.StringType()),
])

QUARTERLY_REVENUE = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("quarter_no", T.IntegerType()),
    T.StructField("revenue", T.DoubleType()),
])

REVENUE_FILINGS = T.StructType([
    *QUARTERLY_REVENUE.fields,
    T.StructField("filed", T.DateType()),
])

REVENUE_BY_YEAR = T.StructType([*REVENUE_FILINGS.fields, T.StructField("year", T.IntegerType())])

# Landed rows without a readable date, as they came.
REJECTED_PRICES = T.StructType([
    *[T.StructField(c, T.StringType()) for c in (
        "ticker", "date_text", "open", "high", "low", "close", "volume", "reason")],
    T.StructField("date", T.DateType()),
])

ROLLING_STATE = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("bars", T.ArrayType(T.StructType([
        T.StructField("date", T.DateType()),
        T.StructField("close", T.DoubleType()),
    ]))),
])

QUARTERLY_FUNDAMENTALS = T.StructType([
    *MANIFEST.fields,
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.StringType()),
])

PRICE_FEATURES = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("realized_vol_20d", T.DoubleType()),
    T.StructField("momentum_60d", T.DoubleType()),
    T.StructField("mean_reversion_zscore_5d", T.DoubleType()),
])

FUNDAMENTAL_FEATURES = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("yoy_revenue_growth_proxy", T.DoubleType()),
])

SIGNAL_SCORES = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("realized_vol_20d_zscore", T.DoubleType()),
    T.StructField("momentum_60d_zscore", T.DoubleType()),
    T.StructField("mean_reversion_zscore_5d_zscore", T.DoubleType()),
    T.StructField("signal_score", T.DoubleType()),
])

POSITIONS = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("position_type", T.StringType()),
    T.StructField("signal_score", T.DoubleType()),
    T.StructField("rank", T.IntegerType()),
])

# Results depend on each of these.
PRICE_SOURCE = "stooq"
FILING_SOURCE = "sec_edgar"
INGEST_WINDOW_DAYS = 120
FEATURE_LOOKBACK_DAYS = 100
MIN_HISTORY_ROWS = 60
TRADING_DAYS_PER_YEAR = 252
VOLATILITY_WINDOW = 20
MOMENTUM_WINDOW = 60
MEAN_REVERSION_WINDOW = 5
BOOK_SIZE = 10
HISTORY_BARS = 60
MIN_PRICE = 0.01
MAX_PRICE = 10000.0
MIN_POSITIVE_SHARE = 0.99
MAX_OVERNIGHT_CHANGE = 0.5
FILING_PRIORITY = ("10-Q", "10-K")

PRICE_FEATURE_COLUMNS = ("realized_vol_20d", "momentum_60d", "mean_reversion_zscore_5d")

# Feature, display name, description.
FEATURE_LABELS = (
    (
        "realized_vol_20d",
        "20-Day Realized Volatility",
        "Annualized volatility calculated from 20-day rolling returns",
    ),
    (
        "momentum_60d",
        "60-Day Momentum",
        "Price return over the past 60 trading days",
    ),
    (
        "mean_reversion_zscore_5d",
        "5-Day Mean Reversion Z-Score",
        "Z-score of current price vs 5-day moving average "
        "(negative = oversold, positive = overbought)",
    ),
)
