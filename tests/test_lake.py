import os
from datetime import date

import pytest

from quotidian import schemas
from quotidian.plans import daily
from quotidian.sources import catalog, lake as lake_io

D1, D2, D3 = date(2024, 6, 26), date(2024, 6, 27), date(2024, 6, 28)


def stored(spark, path):
    rows = lake_io.read_table(spark, path, schemas.DAILY_PRICES).collect()
    return sorted((r["date"], r["ticker"], r["close"]) for r in rows)


def test_overwrite_touches_only_its_partitions(spark, prices, tmp_path):
    path = f"{tmp_path}/t"
    lake_io.overwrite_partitions(prices({"date": D1}, {"date": D2}), path)
    lake_io.overwrite_partitions(prices({"date": D2, "close": 7.0}, {"date": D3}), path)
    assert stored(spark, path) == [(D1, "A", 10.0), (D2, "A", 7.0), (D3, "A", 10.0)]


def test_writing_twice_equals_writing_once(spark, prices, tmp_path):
    df = prices({"date": D1}, {"date": D1, "ticker": "B"}, {"date": D2})
    path = f"{tmp_path}/t"
    for _ in range(2):
        lake_io.overwrite_partitions(df, path)
    once = stored(spark, path)
    for day in (D1, D1, D2):
        lake_io.overwrite_date(df, path, day)
    assert stored(spark, path) == once and len(once) == 3


def test_few_files_per_date(prices, tmp_path):
    df = prices(*[{"date": d, "ticker": f"T{i}"} for i in range(50) for d in (D1, D2)])
    lake_io.overwrite_partitions(df.repartition(16), f"{tmp_path}/t")
    for day in (D1, D2):
        files = [f for f in os.listdir(f"{tmp_path}/t/date={day}") if f.endswith(".parquet")]
        assert len(files) == 1


def test_an_empty_date_is_stored_and_counts_as_there(spark, prices, tmp_path):
    path = f"{tmp_path}/t"
    lake_io.overwrite_date(prices({"date": D1}), path, D1)
    lake_io.overwrite_date(prices({"date": D1}), path, D2)
    assert stored(spark, path) == [(D1, "A", 10.0)]
    assert sorted(r["date"] for r in lake_io.dates_with_files(spark, path).collect()) == [D1, D2]
    lake_io.overwrite_date(prices({"date": D3}), path, D1)
    assert stored(spark, path) == []


def test_missing_table_reads_as_typed_empty(spark, tmp_path):
    df = lake_io.read_table(spark, f"{tmp_path}/none", schemas.POSITIONS)
    assert df.schema == schemas.POSITIONS and df.count() == 0
    assert lake_io.dates_with_files(spark, f"{tmp_path}/none").count() == 0


def test_only_empty_dates_read_as_typed_empty(spark, tmp_path):
    path = f"{tmp_path}/t"
    lake_io.overwrite_date(spark.createDataFrame([], schemas.POSITIONS), path, D1)
    df = lake_io.read_table(spark, path, schemas.POSITIONS)
    assert df.count() == 0 and df.schema.names == schemas.POSITIONS.names


def test_scores_may_gain_columns(spark, tmp_path):
    path = f"{tmp_path}/t"
    base = spark.createDataFrame([("A", D1, 1.0)], "ticker string, date date, signal_score double")
    wide = spark.createDataFrame([("A", D2, 1.0, 2.0)], "ticker string, date date, signal_score double, x_zscore double")
    lake_io.overwrite_date(base, path, D1)
    lake_io.overwrite_date(wide, path, D2)
    df = lake_io.read_scores(spark, path)
    assert df.columns == [*schemas.SIGNAL_SCORES.names, "x_zscore"]
    assert {r["date"]: r["x_zscore"] for r in df.collect()} == {D1: None, D2: 2.0}


def test_dates_done_is_the_union_of_both_marts(spark, lake, prices):
    lake_io.overwrite_date(prices({"date": D1}), lake.signal_scores, D1)
    lake_io.overwrite_date(prices({"date": D1}), lake.positions, D1)
    lake_io.overwrite_date(prices({"date": D2}), lake.positions, D2)
    os.makedirs(f"{lake.positions}/date=junk")
    open(f"{lake.positions}/date=junk/x.parquet", "w").close()
    assert sorted(r["date"] for r in lake_io.dates_done(spark, lake).collect()) == [D1, D2]


def test_raw_layer_adds_and_never_replaces(spark, lake, prices):
    daily.append_raw_prices(prices({"ticker": "A"}), lake)
    daily.append_raw_prices(prices({"ticker": "B"}), lake)
    assert spark.read.parquet(lake.raw_prices).count() == 2


# --- catalog ----------------------------------------------------------------------------------

@pytest.fixture
def parquet(prices, tmp_path):
    path = f"{tmp_path}/p.parquet"
    prices({}, {"ticker": "B"}).write.parquet(path)
    return path


@pytest.fixture
def database(spark):
    name = "curated_test"
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
    yield name
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def test_load_modes(spark, parquet, database):
    assert catalog.load_parquet_to_table(spark, parquet, "daily_prices", database) == 2
    assert catalog.load_parquet_to_table(spark, parquet, "daily_prices", database, "append") == 4
    assert catalog.load_parquet_to_table(spark, parquet, "daily_prices", database, "replace") == 2
    with pytest.raises(Exception, match="already exists"):
        catalog.load_parquet_to_table(spark, parquet, "daily_prices", database, "fail")
    with pytest.raises(ValueError):
        catalog.load_parquet_to_table(spark, parquet, "daily_prices", database, "upsert")


def test_append_creates_a_missing_table(spark, parquet, database):
    assert catalog.load_parquet_to_table(spark, parquet, "t", database, "append") == 2


def test_listing_and_describing(spark, parquet, database):
    assert catalog.list_tables(spark, database).count() == 0
    catalog.load_parquet_to_table(spark, parquet, "b", database)
    catalog.load_parquet_to_table(spark, parquet, "a", database)
    assert [tuple(r) for r in catalog.list_tables(spark, database).collect()] == [("a", 2), ("b", 2)]
    info = catalog.show_table_info(spark, "a", database, limit=1)
    assert info["row_count"] == 2 and info["sample"].count() == 1
    assert ("close", "double") in info["columns"]
    assert catalog.show_table_info(spark, "none", database) is None


def test_existence(spark, parquet, database):
    catalog.load_parquet_to_table(spark, parquet, "t", database)
    assert catalog.table_exists(spark, "t", database)
    assert not catalog.table_exists(spark, "u", database)
    assert catalog.has_column(spark.table(f"{database}.t"), "close")
    assert not catalog.has_column(spark.table(f"{database}.t"), "nope")
    assert catalog.table_or_empty(spark, "t", schemas.DAILY_PRICES, database).count() == 2
    empty = catalog.table_or_empty(spark, "u", schemas.DAILY_PRICES, database)
    assert empty.count() == 0 and empty.schema == schemas.DAILY_PRICES


def test_sql_binds_its_values(spark, prices):
    catalog.register_views({"quotes": prices({}, {"ticker": "B'; DROP"})})
    got = catalog.run_query(spark, "SELECT ticker FROM quotes WHERE ticker = :t", t="B'; DROP").collect()
    assert [r["ticker"] for r in got] == ["B'; DROP"]
    assert catalog.run_query(spark, "SELECT * FROM quotes").count() == 2
