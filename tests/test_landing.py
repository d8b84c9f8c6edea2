"""From landed files to the raw layer: nothing is lost unseen, nothing is stored twice."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quotidian import schemas
from quotidian.functions import scalar
from quotidian.operators import curation
from quotidian.plans import daily
from quotidian.sources import catalog, files, filings, prices, universe
from quotidian.sources import lake as lake_io

DAY = date(2024, 6, 28)


def land(folder: Path, **texts: str) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def landed(spark, path):
    rows = prices.normalise_landed(prices.read_landed_csv(spark, path))
    return {(r["ticker"], r["date"]): (r["open"], r["close"], r["volume"]) for r in rows.collect()}


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    path = land(
        tmp_path / "in",
        AAA="Date,Open,High,Low,Close,Volume\n2024-06-27,1,2,0.5,1.5,10\n",
        BBB='Close,"DateTime",VOLUME,Open\r\n2.5,06/28/2024,20,2\r\n\r\n2.6,20240627,21,2.1',
        CCC="volume,close,date,extra,open\n30,3.5,28-Jun-2024,x,3\n",
        DDD="Date,Open\n",
        EEE="",
    )
    assert landed(spark, path) == {
        ("AAA", date(2024, 6, 27)): (1.0, 1.5, 10.0),
        ("BBB", DAY): (2.0, 2.5, 20.0), ("BBB", date(2024, 6, 27)): (2.1, 2.6, 21.0),
        ("CCC", DAY): (3.0, 3.5, 30.0),
    }


@pytest.mark.parametrize("text, day", [
    ("2024-06-28", DAY), ("20240628", DAY), ("06/28/2024", DAY), ("6/28/2024", DAY), ("2024/06/28", DAY),
    ("28-Jun-2024", DAY), ("28 Jun 2024", DAY), ("Jun 28, 2024", DAY), ("June 28, 2024", DAY),
    ("2024-06-28 16:00:00", DAY), ("2024-06-28T16:00:00Z", DAY), ("06/28/2024 4:00 PM", DAY), (" 2024-06-28 ", DAY),
    ("", None), ("n/a", None), ("13/45/2024", None), ("20241399", None), ("12", None), (None, None),
])
def test_date_texts(spark, text, day):
    assert spark.createDataFrame([(text,)], "t string").select(scalar.parse_day("t")).first()[0] == day


def test_rows_without_a_date_are_kept_apart(spark, lake, tmp_path):
    path = land(tmp_path / "in", AAA="Date,Close\n2024-06-28,1\nsoon,2\n,3\n", BBB="Open,Close\n1,2\n")
    daily.ingest_prices(spark, lake, path, DAY)
    report = daily.curate_prices_day(spark, lake, DAY)
    assert report["rejected_rows"] == 3 and report["unreadable_files"] == []
    stored = spark.read.parquet(lake.rejected_prices)
    assert {(r["ticker"], r["date_text"], r["close"], r["reason"]) for r in stored.collect()} == {
        ("AAA", "soon", "2", "unreadable date"), ("AAA", None, "3", "no date"), ("BBB", None, "2", "no date")}
    daily.ingest_prices(spark, lake, path, DAY)  # again: the same rows, once
    assert daily.rejected_count(spark, lake, DAY) == 3


def test_raw_layer_grows_with_new_data_only(spark, lake, tmp_path):
    path = land(tmp_path / "in", AAA="Date,Close\n2024-06-27,1\n2024-06-28,2\n")
    for _ in range(3):
        daily.ingest_prices(spark, lake, path, DAY)
    assert prices.read_raw(spark, lake.raw_prices).count() == 2
    before = len(files.matching(spark, lake.raw_prices, "date=*/*.parquet"))
    for close in ("5", "2", "5"):  # a value may come back
        land(tmp_path / "in", AAA=f"Date,Close\n2024-06-27,1\n2024-06-28,{close}\n")
        daily.ingest_prices(spark, lake, path, DAY)
    assert len(files.matching(spark, lake.raw_prices, "date=*/*.parquet")) == before + 3
    daily.curate_prices_day(spark, lake, DAY)
    assert [r["close"] for r in spark.read.parquet(lake.daily_prices).collect()] == [5.0]


def test_fallback_reaches_any_earlier_date(spark, lake, tmp_path):
    path = land(tmp_path / "in", AAA="Date,Close\n2023-01-02,1\n")
    daily.ingest_prices(spark, lake, path, date(2023, 1, 2))
    assert daily.curate_prices_day(spark, lake, DAY)["date"] == date(2023, 1, 2)


def test_files_that_cannot_be_read_are_reported(spark, lake, tmp_path):
    path = land(tmp_path / "in", AAA="Date,Close\n2024-06-28,1\n")
    daily.ingest_prices(spark, lake, path, DAY)
    broken = Path(lake.raw_prices) / "date=2024-06-28" / "broken.parquet"
    broken.write_bytes(b"PAR1 and no more")
    report = daily.curate_prices_day(spark, lake, DAY)
    assert [Path(p).name for p in report["unreadable_files"]] == ["broken.parquet"]
    assert report["stats"]["total_rows"] == 1


def test_universe_by_header(spark, tmp_path):
    path = tmp_path / "universe.csv"
    path.write_text("CIK,Ticker,company,Sector,more\n0000012,AAA,Alpha,Tech,x\n")
    assert universe.read_universe(spark, str(path)).first().asDict() == {
        "ticker": "AAA", "company": "Alpha", "sector": "Tech", "cik": "0000012"}


def test_every_filing_is_listed(spark, tmp_path):
    folder = tmp_path / "AAA" / "10-Q" / "2024"
    folder.mkdir(parents=True)
    for name in ("a.txt", "_b.txt", ".c.txt", "empty.txt"):
        (folder / name).write_text("" if name == "empty.txt" else "x")
    (tmp_path / "AAA" / "loose.txt").write_text("x")
    got = filings.list_filings(spark, str(tmp_path)).collect()
    assert sorted(Path(r["file_path"]).name for r in got) == [".c.txt", "_b.txt", "a.txt", "empty.txt"]
    assert {(r["ticker"], r["filing_type"]) for r in got} == {("AAA", "10-Q")}


def test_listing_runs_no_job(spark, lake, bars):
    raw = bars({"A": [1.0] * 5}).withColumns({c: F.lit(1.0) for c in ("open", "high", "low", "volume")}).withColumn(
        "source", F.lit("s"))
    daily.append_raw_prices(raw, lake)
    plan = lake_io.dates_with_files(spark, lake.raw_prices)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "LocalTableScan" in plan or "Scan ExistingRDD" in plan
    assert lake_io.dates_with_files(spark, lake.raw_prices).count() == 5


def test_registering_leaves_loaded_tables_alone(spark, lake, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/five")
    assert catalog.load_parquet_to_table(spark, f"{tmp_path}/five", "daily_prices", "curated") == 5
    try:
        assert catalog.register_lake(spark, lake) == ["curated.daily_prices"]
        assert spark.table("curated.daily_prices").count() == 5
        assert catalog.register_lake(spark, lake) == ["curated.daily_prices"]
        assert set(spark.table("marts.positions").columns) == set(schemas.POSITIONS.names)
    finally:
        spark.sql("DROP TABLE curated.daily_prices")


def test_infinities_are_unknown_everywhere(spark):
    rows = spark.createDataFrame([(float("inf"),), (float("nan"),), (1e308,)], "close double")
    assert [r[0] for r in rows.select(scalar.finite("close")).collect()] == [None, None, 1e308]
    raw = spark.createDataFrame(
        [("2024-06-28", "A", float("inf"), 1.0, 1.0, float("nan"), 1.0, "s")],
        "date string, ticker string, open double, high double, low double, close double, volume double, source string")
    row = curation.coerce_prices(raw).first()
    assert row["open"] is None and row["close"] is None and row["high"] == 1.0
