"""SQL counterparts of the registered queries, written for another engine and independently of the
DataFrame plans: per-date self joins instead of spans, ranks from full sorts, sums instead of
partial aggregates."""

from __future__ import annotations

SUPPLIER_AS_OF, SUPPLIER_LOOKBACK = "2000-06-30", 400
BRAND_AS_OF, BRAND_LOOKBACK = "1998-04-11", 100
TICKER, BRAND, SECTOR = "Supplier#000000001", "Brand#1", "ASIA"
FEATURES = ("realized_vol_20d", "momentum_60d", "mean_reversion_zscore_5d")


def r6(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0 AS {name}"


def bars(key: str, source: str, order: str) -> str:
    return f"""
        SELECT CAST(l_shipdate AS DATE) AS date, {key} AS ticker,
               first(l_extendedprice / l_quantity ORDER BY {order}) AS open,
               max(l_extendedprice / l_quantity) AS high,
               min(l_extendedprice / l_quantity) AS low,
               last(l_extendedprice / l_quantity ORDER BY {order}) AS close,
               CAST(sum(l_quantity) AS BIGINT) AS volume,
               'stooq' AS source
        FROM {source} GROUP BY 1, 2"""


SUPPLIER_BARS = bars(
    "s_name",
    "lineitem JOIN supplier ON l_suppkey = s_suppkey",
    "l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice",
)
BRAND_BARS = bars(
    "p_brand",
    "lineitem JOIN part ON l_partkey = p_partkey",
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice",
)
UNIVERSE = """
    SELECT s_name AS ticker, n_name AS company, r_name AS sector
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
                  LEFT JOIN region ON n_regionkey = r_regionkey"""
BRAND_UNIVERSE = """
    SELECT p_brand AS ticker, p_name AS company, p_type AS sector FROM part
    WHERE p_partkey IN (SELECT max(p_partkey) FROM part GROUP BY p_brand)"""
RAW_DATES = "SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem"

# Typed quotes: text that is no number is already NULL here.
QUOTES = """
    SELECT CAST(l_shipdate AS DATE) AS date, s_name AS ticker,
           CASE WHEN l_returnflag <> 'R' THEN l_extendedprice / l_quantity END AS open,
           (l_extendedprice / l_quantity) * (0.98 + l_tax) AS high,
           (l_extendedprice / l_quantity) * (1.0 - l_discount) AS low,
           l_extendedprice / l_quantity AS close,
           CASE WHEN l_returnflag <> 'N'
                THEN CAST(round_even(l_quantity - 10.5, 0) AS BIGINT) END AS volume,
           'stooq' AS source,
           l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
QUOTE_COLUMNS = "date, ticker, open, high, low, close, volume, source"
# Rows equal in the ingest columns differ at most in what follows; the greatest is the last.
LAST_FIRST = """l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC,
    l_extendedprice DESC, open DESC NULLS LAST, high DESC, low DESC, close DESC,
    volume DESC NULLS LAST"""
CURATED = f"""
    SELECT {QUOTE_COLUMNS} FROM ({QUOTES})
    QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY {LAST_FIRST}) = 1"""


def per_bar_features(source: str) -> str:
    """One row per bar with all three features, from bars (ticker, date, close)."""
    return f"""
        filled AS (
            SELECT ticker, date, close,
                   last_value(close IGNORE NULLS) OVER w AS known
            FROM {source} WINDOW w AS (PARTITION BY ticker ORDER BY date)),
        moved AS (
            SELECT *, known / nullif(lag(known, 1) OVER w, 0) - 1 AS ret,
                   known / nullif(lag(known, 60) OVER w, 0) - 1 AS momentum_60d
            FROM filled WINDOW w AS (PARTITION BY ticker ORDER BY date)),
        featured AS (
            SELECT ticker, date, close, ret, momentum_60d,
                   CASE WHEN count(ret) OVER v = 20
                        THEN stddev_samp(ret) OVER v * sqrt(252) END AS realized_vol_20d,
                   CASE WHEN count(close) OVER z = 5
                        THEN (close - avg(close) OVER z) / nullif(stddev_samp(close) OVER z, 0)
                   END AS mean_reversion_zscore_5d
            FROM moved
            WINDOW v AS (PARTITION BY ticker ORDER BY date ROWS 19 PRECEDING),
                   z AS (PARTITION BY ticker ORDER BY date ROWS 4 PRECEDING))"""


def features_as_of(bars_sql: str, as_of: str, lookback: int) -> str:
    """CTEs ending in ``features``."""
    return f"""
        bars AS ({bars_sql}),
        history AS (
            SELECT ticker, date, close FROM bars
            WHERE date >= DATE '{as_of}' - INTERVAL {lookback} DAY AND date <= DATE '{as_of}'),
        {per_bar_features("history")},
        features AS (
            SELECT ticker, DATE '{as_of}' AS date, {", ".join(FEATURES)} FROM featured
            QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1
                AND count(*) OVER (PARTITION BY ticker) >= 60)"""


def features_panel(bars_sql: str, lookback: int) -> str:
    """CTEs ending in ``features``: the lookback of every date is laid out in full and the single
    date's rules are applied to it."""
    return f"""
        bars AS ({bars_sql}),
        days AS ({RAW_DATES}),
        history AS (
            SELECT b.ticker, d.date AS as_of, b.date, b.close
            FROM bars b JOIN days d
              ON b.date >= d.date - INTERVAL {lookback} DAY AND b.date <= d.date),
        placed AS (
            SELECT *, row_number() OVER w AS bar_no,
                   last_value(close IGNORE NULLS) OVER w AS known,
                   count(*) OVER (PARTITION BY ticker, as_of) AS n
            FROM history WINDOW w AS (PARTITION BY ticker, as_of ORDER BY date)),
        moved AS (
            SELECT *, known / nullif(lag(known, 1) OVER w, 0) - 1 AS ret FROM placed
            WHERE n >= 60 WINDOW w AS (PARTITION BY ticker, as_of ORDER BY date)),
        features AS (
            SELECT ticker, as_of AS date,
                   CASE WHEN count(ret) FILTER (bar_no > n - 20) = 20
                        THEN stddev_samp(ret) FILTER (bar_no > n - 20) * sqrt(252)
                   END AS realized_vol_20d,
                   max(known) FILTER (bar_no = n)
                       / nullif(max(known) FILTER (bar_no = n - 60), 0) - 1 AS momentum_60d,
                   CASE WHEN count(close) FILTER (bar_no > n - 5) = 5
                        THEN (max(close) FILTER (bar_no = n) - avg(close) FILTER (bar_no > n - 5))
                             / nullif(stddev_samp(close) FILTER (bar_no > n - 5), 0)
                   END AS mean_reversion_zscore_5d
            FROM moved GROUP BY ticker, as_of)"""


def scored(features: tuple[str, ...] = FEATURES, source: str = "features") -> str:
    """CTEs ending in ``scores``, with unrounded z-scores."""
    z = ",\n".join(
        f"({f} - avg({f}) OVER d) / nullif(stddev_samp({f}) OVER d, 0) AS {f}_zscore"
        for f in features
    )
    total = " + ".join(f"coalesce({f}_zscore, 0)" for f in features)
    present = " + ".join(f"({f}_zscore IS NOT NULL)::INT" for f in features)
    return f"""
        z AS (SELECT *, {z} FROM {source} WINDOW d AS (PARTITION BY date)),
        scores AS (SELECT *, ({total}) / nullif({present}, 0) AS signal_score FROM z)"""


def book(n: int) -> str:
    """CTEs ending in ``book``: both sides are cut from one full descending order."""
    return f"""
        placed_scores AS (
            SELECT ticker, date, signal_score,
                   row_number() OVER (PARTITION BY date ORDER BY signal_score DESC, ticker) AS place,
                   count(*) OVER (PARTITION BY date) AS scored_tickers
            FROM scores WHERE signal_score IS NOT NULL),
        book AS (
            SELECT ticker, date, 'long' AS position_type, signal_score, CAST(place AS INTEGER) AS rank
            FROM placed_scores WHERE place <= {n}
            UNION ALL
            SELECT ticker, date, 'short', signal_score,
                   CAST(place - greatest(scored_tickers - {n}, 0) AS INTEGER)
            FROM placed_scores WHERE place > scored_tickers - {n})"""


SUPPLIER_FEATURES = features_as_of(SUPPLIER_BARS, SUPPLIER_AS_OF, SUPPLIER_LOOKBACK)
BRAND_FEATURES = features_as_of(BRAND_BARS, BRAND_AS_OF, BRAND_LOOKBACK)
BRAND_PANEL = features_panel(BRAND_BARS, BRAND_LOOKBACK)
OPENS = f"SELECT date, ticker, open AS close FROM ({CURATED})"
SUPPLIER_SCORES = f"{SUPPLIER_FEATURES}, {scored()}"
SUPPLIER_BOOK = f"{SUPPLIER_SCORES}, {book(10)}"
BRAND_SCORES = f"{BRAND_PANEL}, {scored()}"
SCORE_COLUMNS = (
    "ticker, date, "
    + ", ".join(r6(f"{f}_zscore", f"{f}_zscore") for f in FEATURES)
    + ", " + r6("signal_score", "signal_score")
)
FEATURE_COLUMNS = "ticker, date, " + ", ".join(r6(f, f) for f in FEATURES)
BOOK_COLUMNS = f"ticker, date, position_type, {r6('signal_score', 'signal_score')}, rank"


def rolling_query(column: str) -> str:
    return f"""WITH bars AS ({SUPPLIER_BARS}), {per_bar_features("bars")}
        SELECT ticker, date, close, {r6(column, column)} FROM featured"""


MANIFEST = """
    SELECT c_name AS ticker,
           CASE o_orderpriority WHEN '1-URGENT' THEN '10-Q' WHEN '2-HIGH' THEN '10-K' ELSE '8-K'
           END AS filing_type,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS download_time,
           '/filings/' || o_orderkey AS file_path, 'sec_edgar' AS source,
           CAST(year(o_orderdate) AS INTEGER) AS year, 'Q' || quarter(o_orderdate) AS quarter
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'"""

REVENUE = """
    SELECT s_name AS ticker,
           CAST(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS quarter_no,
           sum(l_extendedprice * (1 - l_discount)) AS revenue
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2"""
GROWTH = f"""
    revenue AS ({REVENUE}),
    growth AS (
        SELECT a.ticker, a.quarter_no, a.revenue,
               a.revenue / nullif(b.revenue, 0) - 1 AS yoy_revenue_growth
        FROM revenue a LEFT JOIN revenue b
          ON a.ticker = b.ticker AND b.quarter_no = a.quarter_no - 4)"""
FUNDAMENTALS = f"""
    {GROWTH},
    fundamentals AS (
        SELECT ticker, DATE '{SUPPLIER_AS_OF}' AS date,
               yoy_revenue_growth AS yoy_revenue_growth_proxy
        FROM growth WHERE quarter_no < 2000 * 4 + 1
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY quarter_no DESC) = 1)"""

WILD_BARS = f"""
    SELECT * REPLACE (CASE WHEN day(date) IN (5, 17) THEN NULL ELSE close END AS close) FROM ({SUPPLIER_BARS})"""

# Every date's growth by a search of its own, where the engine lays spans out.
BRAND_GROWTH = f"""
    revenue AS (
        SELECT p_brand AS ticker, CAST(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS quarter_no,
               sum(l_extendedprice * (1 - l_discount)) AS revenue
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
    fundamentals AS (
        SELECT a.ticker, d.date, a.revenue / nullif(b.revenue, 0) - 1 AS yoy_revenue_growth_proxy
        FROM ({RAW_DATES}) d
        JOIN revenue a ON a.quarter_no < year(d.date) * 4 + quarter(d.date) - 1
        LEFT JOIN revenue b ON a.ticker = b.ticker AND b.quarter_no = a.quarter_no - 4
        QUALIFY row_number() OVER (PARTITION BY a.ticker, d.date ORDER BY a.quarter_no DESC) = 1)"""

FILED = """
    sums AS (
        SELECT s_name AS ticker, l_suppkey,
               CAST(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS quarter_no,
               CAST(max(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY) AS DATE) AS ends,
               sum(l_extendedprice * (1 - l_discount)) FILTER (l_returnflag <> 'R') AS first,
               sum(l_extendedprice * (1 - l_discount)) AS last
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3),
    filed AS (
        SELECT ticker, quarter_no, first AS revenue, CAST(ends + CAST(20 + l_suppkey % 40 AS INTEGER) AS DATE) AS filed
        FROM sums WHERE first IS NOT NULL
        UNION ALL
        SELECT ticker, quarter_no, last, CAST(ends + CAST(110 + l_suppkey % 40 AS INTEGER) AS DATE) FROM sums)"""

DQ = f"""
    WITH q AS ({QUOTES}),
    stats AS (SELECT count(*) AS total_rows, count(DISTINCT ticker) AS unique_tickers FROM q),
    per_date AS (
        SELECT ticker, date, count(*) AS n, min(close) AS lowest, max(close) AS highest
        FROM q GROUP BY 1, 2),
    moves AS (
        SELECT *, highest / nullif(lag(lowest) OVER w, 0) - 1 AS rise,
               1 - lowest / nullif(lag(highest) OVER w, 0) AS fall
        FROM per_date WINDOW w AS (PARTITION BY ticker ORDER BY date)),
    checks AS (
        SELECT 'open_not_positive' AS "check", 'warning' AS severity,
               count(*) FILTER (open < 0.01) AS bad_rows,
               count(*) FILTER (open >= 0.01) * 1.0 / count(open) < 0.99 AS failed FROM q
        UNION ALL SELECT 'high_not_positive', 'warning', count(*) FILTER (high < 0.01),
               count(*) FILTER (high >= 0.01) * 1.0 / count(high) < 0.99 FROM q
        UNION ALL SELECT 'low_not_positive', 'warning', count(*) FILTER (low < 0.01),
               count(*) FILTER (low >= 0.01) * 1.0 / count(low) < 0.99 FROM q
        UNION ALL SELECT 'close_not_positive', 'warning', count(*) FILTER (close < 0.01),
               count(*) FILTER (close >= 0.01) * 1.0 / count(close) < 0.99 FROM q
        UNION ALL SELECT 'high_below_low', 'error', count(*) FILTER (high < low),
               count(*) FILTER (high < low) > 0 FROM q
        UNION ALL SELECT 'close_outside_range', 'error',
               count(*) FILTER (close > high OR close < low),
               count(*) FILTER (close > high OR close < low) > 0 FROM q
        UNION ALL SELECT 'duplicate_ticker_date', 'error',
               coalesce(sum(n) FILTER (n > 1), 0), count(*) FILTER (n > 1) > 0 FROM per_date
        UNION ALL SELECT 'negative_volume', 'error', count(*) FILTER (volume < 0),
               count(*) FILTER (volume < 0) > 0 FROM q
        UNION ALL SELECT 'extreme_close', 'warning', count(*) FILTER (close > 10000 OR close < 0.01),
               count(*) FILTER (close > 10000 OR close < 0.01) > 0 FROM q
        UNION ALL SELECT 'overnight_change', 'warning', count(*) FILTER (rise > 0.5 OR fall > 0.5),
               count(*) FILTER (rise > 0.5 OR fall > 0.5) > 0 FROM moves)
    SELECT "check", severity, CAST(bad_rows AS BIGINT) AS bad_rows, CAST(failed AS INTEGER) AS failed,
           total_rows, unique_tickers
    FROM checks, stats"""


def enriched(source: str, columns: str, universe: str = UNIVERSE, where: str = "true") -> str:
    return f"""SELECT {columns}, company, sector
        FROM {source} LEFT JOIN ({universe}) u USING (ticker) WHERE {where}"""


SCORED_DAY = f"ticker, date, {r6('signal_score', 'signal_score')}"


def overview(side: str) -> str:
    return f"WITH {SUPPLIER_BOOK} " + enriched(
        "book", BOOK_COLUMNS, where=f"position_type = '{side}' AND sector = '{SECTOR}'"
    )


def overview_fallback(side: str) -> str:
    place = "place" if side == "long" else "place - greatest(n - 10, 0)"
    keep = "place <= 10" if side == "long" else "place > n - 10"
    return f"""WITH {SUPPLIER_SCORES},
        day AS (
            SELECT ticker, date, signal_score, company, sector,
                   row_number() OVER (ORDER BY signal_score DESC NULLS LAST, ticker) AS place,
                   count(*) OVER () AS n
            FROM scores JOIN ({UNIVERSE}) u USING (ticker) WHERE sector = '{SECTOR}')
        SELECT ticker, date, {r6("signal_score", "signal_score")}, company, sector,
               CAST({place} AS INTEGER) AS rank
        FROM day WHERE {keep}"""


EXPOSURE = f"""WITH {SUPPLIER_BOOK}
    SELECT sector, count(*) FILTER (position_type = 'long') AS long_count,
           count(*) FILTER (position_type = 'short') AS short_count,
           count(*) FILTER (position_type = 'long')
               - count(*) FILTER (position_type = 'short') AS net_exposure
    FROM book JOIN ({UNIVERSE}) u USING (ticker) WHERE sector IS NOT NULL GROUP BY sector"""

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

LABELS = (
    ("realized_vol_20d", "20-Day Realized Volatility",
     "Annualized volatility calculated from 20-day rolling returns"),
    ("momentum_60d", "60-Day Momentum", "Price return over the past 60 trading days"),
    ("mean_reversion_zscore_5d", "5-Day Mean Reversion Z-Score",
     "Z-score of current price vs 5-day moving average (negative = oversold, positive = overbought)"),
)

ORACLES: dict[str, str] = {
    "ohlcv_bars": SUPPLIER_BARS,
    "brand_bars": BRAND_BARS,
    "universe_dim": UNIVERSE,
    "universe_tickers": "SELECT DISTINCT s_name AS ticker FROM supplier WHERE s_name IS NOT NULL",
    "raw_window_asof": f"""
        SELECT {QUOTE_COLUMNS} FROM ({QUOTES})
        WHERE date BETWEEN DATE '{BRAND_AS_OF}' - INTERVAL 120 DAY AND DATE '{BRAND_AS_OF}'
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC, {LAST_FIRST}) = 1""",
    "ingest_windows": """
        WITH anchors AS (
            SELECT CAST(a AS DATE) AS a
            FROM generate_series(DATE '1999-12-31', DATE '1998-01-01', INTERVAL (-200) DAY) t(a)),
        days AS (SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS rows FROM lineitem GROUP BY 1)
        SELECT date, rows FROM days
        WHERE EXISTS (SELECT 1 FROM anchors WHERE date BETWEEN a - INTERVAL 120 DAY AND a)""",
    "ingest_anchor_dates": """
        WITH span AS (
            SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi
            FROM lineitem)
        SELECT CAST(hi - INTERVAL (k * 120) DAY AS DATE) AS date
        FROM span, range(0, 1000) t(k) WHERE hi - INTERVAL (k * 120) DAY >= lo""",
    "landed_prices": """
        SELECT CAST(l_shipdate AS DATE) AS date,
               CASE WHEN l_returnflag <> 'R' THEN l_extendedprice / l_quantity END AS open,
               (l_extendedprice / l_quantity) * (0.98 + l_tax) AS high,
               (l_extendedprice / l_quantity) * (1.0 - l_discount) AS low,
               l_extendedprice / l_quantity AS close,
               CASE WHEN l_returnflag <> 'N' THEN l_quantity - 10.5 END AS volume,
               s_name AS ticker, 'stooq' AS source
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "dates_from_paths": """
        SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS date,
               count(*) AS files
        FROM orders GROUP BY 1""",
    "available_raw_dates": f"""
        SELECT date, strftime(date, '%Y/%m/%d') AS day_path, CAST(year(date) AS INTEGER) AS year,
               'Q' || quarter(date) AS quarter
        FROM ({RAW_DATES})""",
    "dates_to_process": f"""
        WITH days AS ({RAW_DATES})
        SELECT date FROM days d
        WHERE date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'
          AND date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'P')
          AND (SELECT count(*) FROM days e WHERE e.date < d.date) >= 60""",
    "dates_with_history": f"""
        WITH days AS ({RAW_DATES})
        SELECT date FROM days d WHERE (SELECT count(*) FROM days e WHERE e.date < d.date) >= 60""",
    "curate_prices": f"""
        SELECT * FROM ({CURATED})
        WHERE date = (SELECT coalesce(max(date) FILTER (date = DATE '{BRAND_AS_OF}'), max(date))
                      FROM ({RAW_DATES}))""",
    "curate_prices_fallback": f"""
        SELECT * FROM ({CURATED})
        WHERE date = (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)""",
    "curate_prices_all": CURATED,
    "curate_landing_partitions": f"""
        WITH days AS ({RAW_DATES}), chosen AS (SELECT max(date) AS date FROM days GROUP BY last_day(date))
        SELECT c.* FROM ({CURATED}) c JOIN chosen USING (date)""",
    "dq_report": DQ,
    "manifest_curated": MANIFEST,
    "filing_priority": f"""
        WITH m AS ({MANIFEST})
        SELECT * FROM m WHERE filing_type = '10-Q'
           OR (filing_type = '10-K'
               AND NOT EXISTS (SELECT 1 FROM m q WHERE q.ticker = m.ticker AND q.filing_type = '10-Q'))""",
    "returns": rolling_query("ret"),
    "returns_with_gaps": f"""
        WITH bars AS ({OPENS}), {per_bar_features("bars")}
        SELECT ticker, date, close AS open, {r6("ret", "ret")} FROM featured""",
    "realized_vol": rolling_query("realized_vol_20d"),
    "momentum": rolling_query("momentum_60d"),
    "mean_reversion_z": rolling_query("mean_reversion_zscore_5d"),
    "price_features_asof": f"WITH {SUPPLIER_FEATURES} SELECT {FEATURE_COLUMNS} FROM features",
    "price_features_brand": f"WITH {BRAND_FEATURES} SELECT {FEATURE_COLUMNS} FROM features",
    "price_features_panel": f"WITH {BRAND_PANEL} SELECT {FEATURE_COLUMNS} FROM features",
    "price_features_gaps": f"""
        WITH {features_panel(OPENS, SUPPLIER_LOOKBACK)} SELECT {FEATURE_COLUMNS} FROM features""",
    "yoy_growth": f"""
        WITH {GROWTH}
        SELECT ticker, quarter_no, round(revenue, 4) + 0.0 AS revenue,
               {r6("yoy_revenue_growth", "yoy_revenue_growth")} FROM growth""",
    "fundamental_features": f"""
        WITH {FUNDAMENTALS}
        SELECT ticker, date, {r6("yoy_revenue_growth_proxy", "yoy_revenue_growth_proxy")}
        FROM fundamentals""",
    "zscore_by_date": f"""
        SELECT ticker, date, close, {r6(
            "(close - avg(close) OVER d) / nullif(stddev_samp(close) OVER d, 0)", "close_z")}
        FROM ({SUPPLIER_BARS}) WINDOW d AS (PARTITION BY date)""",
    "zscore_by_sector": f"""
        SELECT ticker, date, close, sector, {r6(
            "(close - avg(close) OVER d) / nullif(stddev_samp(close) OVER d, 0)", "close_z")}
        FROM ({SUPPLIER_BARS}) b LEFT JOIN ({UNIVERSE}) u USING (ticker)
        WINDOW d AS (PARTITION BY sector)""",
    "signal_scores": f"WITH {SUPPLIER_SCORES} SELECT {SCORE_COLUMNS} FROM scores",
    "signal_scores_with_fundamentals": f"""
        WITH {SUPPLIER_FEATURES}, {FUNDAMENTALS},
        joined AS (SELECT * FROM features LEFT JOIN fundamentals USING (ticker, date)),
        {scored((*FEATURES, "yoy_revenue_growth_proxy"), "joined")}
        SELECT {SCORE_COLUMNS}, {r6("yoy_revenue_growth_proxy", "yoy_revenue_growth_proxy")},
               {r6("yoy_revenue_growth_proxy_zscore", "yoy_revenue_growth_proxy_zscore")}
        FROM scores""",
    "signal_scores_panel": f"WITH {BRAND_SCORES} SELECT {SCORE_COLUMNS} FROM scores",
    "positions": f"WITH {SUPPLIER_BOOK} SELECT {BOOK_COLUMNS} FROM book",
    "positions_panel": f"WITH {BRAND_SCORES}, {book(3)} SELECT {BOOK_COLUMNS} FROM book",
    "scores_enriched": f"WITH {SUPPLIER_SCORES} " + enriched("scores", SCORED_DAY),
    "scores_enriched_sector": f"WITH {SUPPLIER_SCORES} "
    + enriched("scores", SCORED_DAY, where=f"sector = '{SECTOR}'"),
    "scores_enriched_latest": f"WITH {BRAND_SCORES} "
    + enriched("scores", SCORED_DAY, BRAND_UNIVERSE, "date = (SELECT max(date) FROM scores)"),
    "positions_enriched": f"WITH {SUPPLIER_BOOK} " + enriched("book", BOOK_COLUMNS),
    "positions_by_date": f"WITH {SUPPLIER_BOOK} SELECT {BOOK_COLUMNS} FROM book",
    "price_history": f"""
        SELECT date, open, high, low, close, volume FROM ({SUPPLIER_BARS})
        WHERE ticker = '{TICKER}' ORDER BY date DESC LIMIT 60""",
    "ticker_features": f"""
        WITH {SUPPLIER_FEATURES} SELECT {FEATURE_COLUMNS} FROM features WHERE ticker = '{TICKER}'""",
    "ticker_score_date": f"""
        WITH {BRAND_SCORES}
        SELECT coalesce(max(date) FILTER (ticker = '{BRAND}'), max(date)) AS date FROM scores""",
    "ticker_features_latest": f"""
        WITH {BRAND_PANEL}
        SELECT {FEATURE_COLUMNS} FROM features
        WHERE ticker = '{BRAND}'
          AND date = (SELECT max(date) FROM features WHERE ticker = '{BRAND}')""",
    "ticker_score": f"""
        WITH {SUPPLIER_SCORES}
        SELECT ticker, date, {r6("signal_score", "signal_score")},
               CASE WHEN signal_score > 0 THEN 'positive' WHEN signal_score <= 0 THEN 'negative'
               END AS signal_class
        FROM scores WHERE ticker = '{TICKER}'""",
    "sector_exposure": EXPOSURE,
    "exposure_series": f"""
        SELECT sector, long_count AS longs, -short_count AS shorts FROM ({EXPOSURE})""",
    "available_dates": f"WITH {BRAND_SCORES} SELECT DISTINCT date FROM scores",
    "available_tickers": f"WITH {SUPPLIER_SCORES} SELECT DISTINCT ticker FROM scores",
    "available_sectors": f"SELECT DISTINCT sector FROM ({UNIVERSE}) WHERE sector IS NOT NULL",
    "overview_long": overview("long"),
    "overview_short": overview("short"),
    "overview_long_fallback": overview_fallback("long"),
    "overview_short_fallback": overview_fallback("short"),
    "vol_bands": f"""
        WITH {SUPPLIER_FEATURES},
        recent AS (
            SELECT date, close FROM bars WHERE ticker = '{TICKER}' ORDER BY date DESC LIMIT 60),
        width AS (
            SELECT CASE WHEN realized_vol_20d < 1 THEN realized_vol_20d
                        ELSE realized_vol_20d / 100 END AS w
            FROM features WHERE ticker = '{TICKER}')
        SELECT date, close, {r6("close * (1 + w)", "upper_band")},
               {r6("close * (1 - w)", "lower_band")}
        FROM recent LEFT JOIN width ON true""",
    "feature_breakdown": f"WITH {SUPPLIER_FEATURES} "
    + " UNION ALL ".join(
        f"SELECT ticker, date, '{name}' AS feature_name, {r6(column, 'value')}, "
        f"'{text}' AS description FROM features WHERE {column} IS NOT NULL"
        for column, name, text in LABELS
    ),
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES
    ),
    "adhoc_sql": f"""
        SELECT sector, CAST(year(date) AS INTEGER) AS year, count(*) AS bars, max(high) AS top,
               min(low) AS bottom, CAST(sum(volume) AS BIGINT) AS volume
        FROM ({SUPPLIER_BARS}) p JOIN ({UNIVERSE}) u USING (ticker)
        WHERE date >= DATE '1998-01-01' GROUP BY 1, 2""",
    "union_by_name": f"""
        SELECT ticker, date, close, open, NULL::BIGINT AS volume FROM ({SUPPLIER_BARS})
        UNION ALL SELECT ticker, date, close, NULL, volume FROM ({BRAND_BARS})""",
    "curated_price_upsert": f"""
        SELECT date, ticker, open, high, low, close,
               CASE WHEN date BETWEEN DATE '1998-04-01' AND DATE '1998-04-30' THEN NULL
                    ELSE volume END AS volume, source
        FROM ({SUPPLIER_BARS})""",
    "fundamentals_by_quarter": f"""
        SELECT year, quarter, filing_type, count(*) AS filings, count(DISTINCT ticker) AS tickers
        FROM ({MANIFEST}) GROUP BY 1, 2, 3""",
    "daily_build": f"""
        WITH {BRAND_FEATURES}, {scored()}, {book(10)} SELECT {BOOK_COLUMNS} FROM book""",
    "backfill_build": f"""
        WITH {BRAND_SCORES} SELECT {SCORE_COLUMNS} FROM scores
        WHERE (SELECT count(*) FROM ({RAW_DATES}) e WHERE e.date < scores.date) >= 60""",
    "raw_reingest": f"""
        SELECT ticker, date, close FROM ({BRAND_BARS})
        UNION ALL SELECT ticker, date, close * 2 FROM ({BRAND_BARS}) WHERE day(date) = 1""",
    "curate_day": f"SELECT * FROM ({BRAND_BARS}) WHERE date = DATE '{BRAND_AS_OF}'",
    "curate_day_fallback": f"""
        SELECT * FROM ({BRAND_BARS}) WHERE date = (SELECT max(date) FROM ({BRAND_BARS}))""",
    "signal_scores_infinite": f"""
        WITH {features_as_of(WILD_BARS, SUPPLIER_AS_OF, SUPPLIER_LOOKBACK)}, {scored()}
        SELECT {SCORE_COLUMNS} FROM scores""",
    "signal_scores_panel_with_fundamentals": f"""
        WITH {BRAND_PANEL}, {BRAND_GROWTH},
        joined AS (SELECT * FROM features LEFT JOIN fundamentals USING (ticker, date)),
        {scored((*FEATURES, "yoy_revenue_growth_proxy"), "joined")}
        SELECT {SCORE_COLUMNS}, {r6("yoy_revenue_growth_proxy", "yoy_revenue_growth_proxy")},
               {r6("yoy_revenue_growth_proxy_zscore", "yoy_revenue_growth_proxy_zscore")}
        FROM scores""",
    "landed_csv": f"""
        SELECT date, open, high, low, close, CAST(volume AS DOUBLE) AS volume, ticker, source
        FROM ({BRAND_BARS}) WHERE day(date) <> 13""",
    "rejected_rows": f"""
        SELECT ticker, 'n/a' AS date_text, close, 'unreadable date' AS reason
        FROM ({BRAND_BARS}) WHERE day(date) = 13""",
    "filing_listing": f"""
        SELECT DISTINCT ticker, filing_type, 1::BIGINT AS files FROM ({MANIFEST})
        WHERE filing_type IN ('10-Q', '10-K')
        UNION ALL SELECT 'NONE', '8-K', 3""",
    "incremental_build": f"""
        WITH {BRAND_SCORES} SELECT {SCORE_COLUMNS} FROM scores
        WHERE date IN (SELECT date FROM ({RAW_DATES}) ORDER BY date DESC LIMIT 10)""",
    "overnight_change_day": f"""
        WITH near AS (
            SELECT ticker, date, CASE WHEN date = DATE '{BRAND_AS_OF}' AND ascii(right(ticker, 1)) % 2 = 1
                                      THEN close * 1.7 ELSE close END AS close
            FROM ({BRAND_BARS})
            WHERE date BETWEEN DATE '{BRAND_AS_OF}' - 101 AND DATE '{BRAND_AS_OF}'),
        moves AS (
            SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS before FROM near),
        counted AS (
            SELECT count(*) AS n FROM moves
            WHERE date = DATE '{BRAND_AS_OF}' AND abs(close / nullif(before, 0) - 1) > 0.5)
        SELECT DATE '{BRAND_AS_OF}' AS date,
               'Found ' || n || ' ticker dates with an overnight change above 50%' AS warning
        FROM counted WHERE n > 0""",
    "unreadable_files": f"""
        WITH days AS (SELECT date, count(*) AS rows FROM ({BRAND_BARS}) WHERE day(date) = 1 GROUP BY 1)
        SELECT date, 'empty.parquet' AS name, 0::BIGINT AS size, rows FROM days
        UNION ALL SELECT date, 'broken.parquet', 16, rows FROM days""",
    "revenue_ingest": f"WITH {FILED} SELECT ticker, quarter_no, round(revenue, 4) AS revenue, filed FROM filed",
    "fundamentals_as_filed": f"""
        WITH {FILED},
        wanted AS (SELECT date FROM ({RAW_DATES}) WHERE day(date) = 1),
        versions AS (
            SELECT w.date, f.* FROM wanted w JOIN filed f ON f.filed <= w.date
            QUALIFY row_number() OVER (
                PARTITION BY w.date, f.ticker, f.quarter_no ORDER BY f.filed DESC, f.revenue DESC) = 1),
        growth AS (
            SELECT a.ticker, a.date, a.revenue / nullif(b.revenue, 0) - 1 AS growth
            FROM versions a LEFT JOIN versions b
              ON a.ticker = b.ticker AND a.date = b.date AND b.quarter_no = a.quarter_no - 4
            QUALIFY row_number() OVER (PARTITION BY a.ticker, a.date ORDER BY a.quarter_no DESC) = 1)
        SELECT ticker, date, {r6("growth", "yoy_revenue_growth_proxy")} FROM growth""",
    "dq_missing_column": f"""
        SELECT false AS valid, 'Missing required columns: [''low'', ''volume'']' AS errors, '' AS warnings,
               count(*) AS total_rows, count(DISTINCT ticker) AS unique_tickers FROM ({QUOTES})""",
    "dq_empty": f"""
        SELECT true AS valid, '' AS errors, 'Empty DataFrame' AS warnings,
               count(*) AS total_rows, count(DISTINCT ticker) AS unique_tickers
        FROM ({QUOTES}) WHERE date < DATE '1900-01-01'""",
    "dq_first_error": f"""
        SELECT CASE WHEN a > 0 THEN 'Found ' || a || ' rows where high < low'
                    ELSE 'Found ' || b || ' rows where close is outside [low, high] range' END AS error
        FROM (SELECT count(*) FILTER (high < low) AS a,
                     count(*) FILTER (close > high OR close < low) AS b FROM ({QUOTES})) WHERE a + b > 0""",
    "required_columns": f"""
        SELECT 'bars' AS input, '' AS error, count(*) AS row_count FROM ({SUPPLIER_BARS})
        UNION ALL SELECT 'quotes', 'Missing required columns: [''open'', ''source'']', NULL
        UNION ALL SELECT 'filings', 'Missing required columns: [''date'', ''open'', ''high'', ''low'', ''close'', ''volume'']', NULL""",
    "curated_order": f"""
        SELECT date, ticker, row_number() OVER (PARTITION BY date ORDER BY ticker) - 1 AS place FROM ({BRAND_BARS})""",
    "run_date_prices": f"SELECT * FROM ({BRAND_BARS}) WHERE date = DATE '{BRAND_AS_OF}'",
    "table_sample": "SELECT least(7, count(*)) AS sampled, least(7, count(*)) AS found FROM orders",
    "list_tables": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ("customer", "orders", "supplier")
    ),
    "describe_table": """
        SELECT column_name, (SELECT count(*) FROM orders) AS row_count
        FROM (DESCRIBE SELECT * FROM orders)""",
    "load_modes": """
        SELECT 'append' AS mode, 2 * count(*) AS row_count FROM orders
        UNION ALL SELECT 'replace', count(*) FROM orders
        UNION ALL SELECT 'fail', count(*) FROM orders""",
    "typed_empty": """
        SELECT 'orders' AS table_name, CAST((SELECT count(*) FROM (DESCRIBE SELECT * FROM orders)) AS INTEGER) AS columns,
               count(*) AS row_count FROM orders
        UNION ALL SELECT 'absent', CAST((SELECT count(*) FROM (DESCRIBE SELECT * FROM orders)) AS INTEGER), 0""",
}
