import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from quotidian import schemas
from quotidian.functions import scalar
from quotidian.sources import filings, prices, universe

D = date(2024, 6, 28)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write(text)


def test_universe_file(spark, tmp_path):
    write(f"{tmp_path}/u.csv", "ticker,company,sector,cik\nB,Beta,Tech,0000000002\nA,\"Alpha, Inc.\",,0000000001\n,None,Tech,3\nA,Again,Tech,4\n")
    table = universe.read_universe(spark, f"{tmp_path}/u.csv")
    assert table.schema.names == schemas.UNIVERSE.names
    assert sorted(r["ticker"] for r in universe.tickers(table).collect()) == ["A", "B"]
    assert table.where("ticker = 'B'").first()["cik"] == "0000000002"
    assert universe.with_sectors(table).columns == ["ticker", "company", "sector"]
    assert [r["sector"] for r in universe.sectors(table).collect()] == ["Tech"]


def test_landed_files_take_the_ticker_from_their_name(spark, tmp_path):
    header = "Date,Open,High,Low,Close,Volume\n"
    write(f"{tmp_path}/in/AAA.csv", header + "2024-06-28,1,2,0.5,1.5,100\n2024-06-27,1,2,x,1.4,\n")
    write(f"{tmp_path}/in/BRK.B.csv", header + "2024-06-28,9,9,9,9,7.5\n")
    got = prices.normalise_landed(prices.read_landed_csv(spark, f"{tmp_path}/in"))
    assert got.schema.names == schemas.RAW_PRICES.names
    rows = {(r["ticker"], r["date"]): r for r in got.collect()}
    assert set(rows) == {("AAA", D), ("AAA", date(2024, 6, 27)), ("BRK.B", D)}
    assert rows[("AAA", date(2024, 6, 27))]["low"] is None
    assert rows[("BRK.B", D)]["source"] == "stooq" and rows[("BRK.B", D)]["volume"] == 7.5


@pytest.mark.parametrize("name", ["DATE", "Datetime", "datetime", "date"])
def test_date_column_is_found_in_any_case(spark, name):
    df = spark.createDataFrame([("2024-06-28", 1.0, 1.0, 1.0, 1.0, 1.0)], [name, "Open", "HIGH", "low", "Close", "Volume"])
    assert prices.normalise_landed(df, F.lit("A"), "x").first()["date"] == D


def test_no_date_column_is_an_error(spark):
    with pytest.raises(prices.NoDateColumn):
        prices.normalise_landed(spark.createDataFrame([(1.0,)], ["Open"]))


def test_ingest_window_holds_both_ends(spark):
    days = [date(2024, 2, 28), date(2024, 2, 29), D, date(2024, 6, 29)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    assert [r["date"] for r in prices.ingest_window(df, D).orderBy("date").collect()] == days[1:3]


def test_last_row_at_or_before_the_run_date(bars):
    df = bars({"A": [1.0, 2.0, 3.0]}, D).union(bars({"B": [4.0]}, date(2024, 6, 20)))
    got = {r["ticker"]: (r["date"], r["close"]) for r in prices.last_at_or_before(df, date(2024, 6, 27)).collect()}
    assert got == {"A": (date(2024, 6, 27), 2.0), "B": (date(2024, 6, 20), 4.0)}


def test_price_history_is_the_latest_in_order(request):
    make = request.getfixturevalue("prices")
    price_history = prices.price_history
    df = make(*[{"date": date(2024, 6, d), "close": float(d)} for d in (3, 1, 5, 2, 4)], {"ticker": "B", "date": date(2024, 6, 9)})
    got = price_history(df, "A", 3)
    assert got.columns == ["date", "open", "high", "low", "close", "volume"]
    assert [r["close"] for r in got.collect()] == [3.0, 4.0, 5.0]
    assert price_history(df, "nobody").count() == 0


def test_union_by_name_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2.0)], "s string, d double")
    got = prices.union_by_name([a, b])
    assert sorted((r["s"], r["n"], r["d"]) for r in got.collect()) == [("x", 1, None), ("y", None, 2.0)]


def test_manifest_of_downloaded_files(spark, tmp_path):
    root = f"{tmp_path}/downloads"
    write(f"{root}/AAA/10-Q/0001/full-submission.txt", "q")
    write(f"{root}/AAA/10-Q/0001/primary.html", "q")
    write(f"{root}/AAA/10-K/0002/full-submission.txt", "k")
    write(f"{root}/BRK.B/10-K/0003/full-submission.txt", "k")
    write(f"{root}/stray.txt", "?")
    write(f"{root}/AAA/8-K/0009/x.txt", "e")
    assert filings.list_filings(spark, f"file:{root}/").count() == 5
    assert [r["filing_type"] for r in filings.build_manifest(spark, root, D, ["8-K"]).collect()] == ["8-K"]
    assert filings.build_manifest(spark, f"{root}/none", D).count() == 0
    manifest = filings.build_manifest(spark, root, D)
    rows = manifest.collect()
    assert sorted((r["ticker"], r["filing_type"]) for r in rows) == [("AAA", "10-Q"), ("AAA", "10-Q"), ("BRK.B", "10-K")]
    assert {(r["year"], r["quarter"], r["source"]) for r in rows} == {(2024, "Q2", "sec_edgar")}
    assert all(r["file_path"].endswith((".txt", ".html")) and r["download_time"] for r in rows)


def test_listing_files_reads_no_content(spark, tmp_path):
    write(f"{tmp_path}/d/A/10-Q/1/f.txt", "q")
    plan = filings.list_filings(spark, f"{tmp_path}/d")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_manifest_summary_file_is_left_out(spark, tmp_path):
    part = f"{tmp_path}/m/year=2024/quarter=Q2"
    os.makedirs(part)
    rows = spark.createDataFrame([("A", "10-Q", None, "/a", "s")], schemas.MANIFEST).toPandas()
    rows.to_parquet(f"{part}/A.parquet")
    rows.to_parquet(f"{part}/manifest.parquet")
    assert filings.read_manifests(spark, f"{tmp_path}/m", [D, date(2023, 1, 1)]).count() == 1
    assert filings.read_manifests(spark, f"{tmp_path}/m", [date(2024, 7, 1)]).count() == 0
    assert filings.read_manifests(spark, f"{tmp_path}/m").count() == 1
    assert filings.read_manifests(spark, f"{tmp_path}/none").count() == 0


def test_unreadable_raw_files_are_skipped(spark, tmp_path):
    root = f"{tmp_path}/raw"
    spark.createDataFrame([(D, 1.0, 1.0, 1.0, 1.0, 1.0, "A", "s")], schemas.RAW_PRICES).write.partitionBy("date").parquet(root)
    write(f"{root}/date=2024-06-28/broken.parquet", "this is no parquet file")
    got = prices.read_raw(spark, root).collect()
    assert [(r["ticker"], r["date"]) for r in got] == [("A", D)]


def one(spark, value):
    return spark.range(1).select(value.alias("v")).first()["v"]


def test_scalar_functions(spark):
    day = F.lit(D)
    assert one(spark, scalar.quarter_label(day)) == "Q2" == scalar.quarter_label_of(D)
    assert [scalar.quarter_label_of(date(2024, m, 1)) for m in (1, 3, 4, 6, 7, 9, 10, 12)] == ["Q1", "Q1", "Q2", "Q2", "Q3", "Q3", "Q4", "Q4"]
    assert one(spark, scalar.quarter_index(day)) == 2024 * 4 + 1
    assert one(spark, scalar.day_path(day)) == "2024/06/28"
    assert scalar.parse_run_date("2024-06-28") == D
    assert scalar.parse_run_date() == date.today()
    with pytest.raises(ValueError):
        scalar.parse_run_date("28.06.2024")
    assert one(spark, scalar.signal_class(F.lit(0.1))) == "positive"
    assert one(spark, scalar.signal_class(F.lit(0.0))) == "negative"
    assert one(spark, scalar.signal_class(F.lit(None).cast("double"))) is None
    assert one(spark, scalar.band_width(F.lit(0.5))) == 0.5
    assert one(spark, scalar.band_width(F.lit(25.0))) == 0.25


@pytest.mark.parametrize("path, day", [
    ("s3://x/scores/date=2024-06-28/part-0.parquet", D),
    ("file:/x/scores/2024-06-28.parquet", D),
    ("file:/x/raw/2024/06/28/AAA.parquet", D),
    ("file:/x/scores/date=junk/part-0.parquet", None),
    ("file:/x/scores/latest.parquet", None),
    ("file:/x/raw/2024/13/41/AAA.parquet", None),
])
def test_date_from_path(spark, path, day):
    assert one(spark, scalar.day_from_path(F.lit(path))) == day


@pytest.mark.parametrize("swap", [False, True])
def test_anchor_dates(spark, swap):
    a, b = F.lit(date(2024, 1, 1)), F.lit(date(2024, 12, 31))
    got = one(spark, scalar.anchor_dates(b, a, 120) if swap else scalar.anchor_dates(a, b, 120))
    assert got == [date(2024, 12, 31), date(2024, 9, 2), date(2024, 5, 5), date(2024, 1, 6)]
