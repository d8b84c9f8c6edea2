"""Results on tables where single keys hold a third of all rows, against the SQL twins."""

import duckdb
import pytest

from checks.compare import differences, open_tables
from quotidian.sources.warehouse import TABLES

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """One supplier, one part, one day and one customer hold a third each; a tenth of the lines are
    exact copies; some lines repeat another's key with other values."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()

    def write(name, sql):
        con.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")

    for name in TABLES:
        if name not in ("lineitem", "orders"):
            write(name, f"SELECT * FROM '{SOURCE}/{name}.parquet'")
    write("lineitem", f"""
        WITH l AS (
            SELECT *, hash(l_orderkey, l_linenumber, l_partkey) % 9 AS a,
                   hash(l_partkey, l_extendedprice) % 9 AS b,
                   hash(l_extendedprice, l_orderkey) % 9 AS c
            FROM '{SOURCE}/lineitem.parquet'),
        hot AS (
            SELECT * REPLACE (
                CASE WHEN a < 3 THEN 7 ELSE l_suppkey END AS l_suppkey,
                CASE WHEN b < 3 THEN 5 ELSE l_partkey END AS l_partkey,
                CASE WHEN c < 3 THEN TIMESTAMP '1998-04-10' ELSE l_shipdate END AS l_shipdate)
            FROM l),
        lines AS (
            SELECT * FROM hot
            UNION ALL SELECT * FROM hot WHERE a = 4
            UNION ALL SELECT * REPLACE (l_extendedprice + 1 AS l_extendedprice) FROM hot WHERE b = 4)
        SELECT * EXCLUDE (a, b, c) FROM lines""")
    write("orders", f"""
        SELECT * REPLACE (CASE WHEN hash(o_orderkey) % 3 = 0 THEN 3 ELSE o_custkey END AS o_custkey)
        FROM '{SOURCE}/orders.parquet'""")
    return str(folder)


@pytest.fixture(scope="module")
def tables(skewed):
    return open_tables(skewed)


@pytest.mark.parametrize("name", [
    "ohlcv_bars", "brand_bars", "raw_window_asof", "curate_prices", "curate_prices_all",
    "curate_landing_partitions", "dq_report", "filing_priority", "manifest_curated",
    "returns_with_gaps", "price_features_asof", "price_features_gaps", "yoy_growth",
    "zscore_by_date", "zscore_by_sector", "signal_scores_with_fundamentals", "dates_to_process",
    "curated_price_upsert", "fundamentals_by_quarter",
])
def test_skewed_tables_equal_sql(spark, skewed, tables, name):
    difference, rows, _, _ = differences(spark, tables, name, skewed)
    assert difference is None
    assert rows > 0
