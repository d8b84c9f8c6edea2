"""Whole runs against a lake on disk."""

import os
from datetime import date, timedelta

import pytest

from quotidian import schemas
from quotidian.plans import backfill, daily
from quotidian.sources import lake as lake_io
from quotidian.sources.lake import Lake
from quotidian.streaming import landing as stream

END = date(2024, 6, 28)
TICKERS = [f"T{i:02d}" for i in range(6)]


def close_of(ticker, i):
    return 50 + (i * (3 + int(ticker[1:])) % 17) + int(ticker[1:])


def land(folder, days=95, end=END, tickers=TICKERS, change=0.0):
    """One CSV per ticker with a bar per day."""
    os.makedirs(folder, exist_ok=True)
    for ticker in tickers:
        lines = ["Date,Open,High,Low,Close,Volume"]
        for i in range(days):
            c = close_of(ticker, i) + change
            lines.append(f"{end - timedelta(days=days - 1 - i)},{c},{c + 1},{c - 1},{c},{100 + i}.5")
        with open(f"{folder}/{ticker}.csv", "w") as file:
            file.write("\n".join(lines) + "\n")
    return folder


def table(spark, path, schema):
    return sorted((tuple(r) for r in lake_io.read_table(spark, path, schema).collect()), key=str)


def marts_of(spark, lake):
    return (
        sorted((tuple(r) for r in lake_io.read_scores(spark, lake.signal_scores).collect()), key=str),
        table(spark, lake.positions, schemas.POSITIONS),
    )


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """A lake with all dates curated and no marts."""
    root = tmp_path_factory.mktemp("filled")
    lake = Lake(f"{root}/lake")
    report = backfill.backfill(
        spark, lake, END - timedelta(days=94), END, landing=land(f"{root}/landing"))
    assert report["valid"] and report["stats"] == {"total_rows": 570, "unique_tickers": 6}
    return lake


def with_prices_of(lake, other):
    """A new lake that shares the other's raw and curated layers."""
    os.makedirs(other.root)
    for layer in ("raw", "curated"):
        os.symlink(f"{lake.root}/{layer}", f"{other.root}/{layer}")
    return other


def test_ingest_returns_the_run_date_or_the_row_before(spark, lake, tmp_path):
    folder = land(f"{tmp_path}/landing", days=3)
    got = daily.ingest_prices(spark, lake, folder, END + timedelta(days=4))
    assert {r["date"] for r in got.collect()} == {END}
    got = daily.ingest_prices(spark, lake, folder, END - timedelta(days=1))
    assert {r["date"] for r in got.collect()} == {END - timedelta(days=1)}


def test_a_day_from_landing_to_book(spark, lake, tmp_path):
    report = daily.run_day(spark, lake, land(f"{tmp_path}/landing"), "2024-06-28")
    assert report["valid"] and report["stats"] == {"total_rows": 6, "unique_tickers": 6}
    curated = lake_io.read_table(spark, lake.daily_prices, schemas.DAILY_PRICES)
    assert {r["date"] for r in curated.select("date").collect()} == {END}
    # One curated day is no history: both marts exist for the date and are empty.
    assert marts_of(spark, lake) == ([], [])
    assert [r["date"] for r in lake_io.dates_done(spark, lake).collect()] == [END]


def test_curation_takes_the_latest_date_and_loads_it(spark, lake, tmp_path):
    daily.ingest_prices(spark, lake, land(f"{tmp_path}/landing", days=3), END)
    report = daily.curate_prices_day(spark, lake, END + timedelta(days=3))
    assert report["date"] == END
    rows = table(spark, lake.daily_prices, schemas.DAILY_PRICES)
    assert {r[0] for r in rows} == {END} and len(rows) == 6


def test_curation_without_raw_rows(spark, lake, tmp_path):
    daily.ingest_prices(spark, lake, land(f"{tmp_path}/landing", days=1), END)
    assert daily.curate_prices_day(spark, lake, date(2020, 1, 1)) is None


def test_repeated_ingest_keeps_the_last_prices_and_all_tickers(spark, lake, tmp_path):
    daily.ingest_prices(spark, lake, land(f"{tmp_path}/a", days=2), END)
    daily.ingest_prices(spark, lake, land(f"{tmp_path}/b", days=2, tickers=["T01"], change=5.0), END)
    report = daily.curate_prices_day(spark, lake, END)
    assert report["stats"] == {"total_rows": 6, "unique_tickers": 6}
    closes = {r[1]: r[5] for r in table(spark, lake.daily_prices, schemas.DAILY_PRICES)}
    assert closes["T01"] == close_of("T01", 1) + 5 and closes["T02"] == close_of("T02", 1)


def test_bad_prices_are_reported_and_loaded(spark, lake, prices):
    daily.append_raw_prices(prices({"high": 8.0, "low": 9.0}), lake)
    report = daily.curate_prices_day(spark, lake, END)
    assert not report["valid"] and "high < low" in report["errors"][0]
    assert len(table(spark, lake.daily_prices, schemas.DAILY_PRICES)) == 1


def test_building_a_day(spark, filled, tmp_path):
    lake = with_prices_of(filled, Lake(f"{tmp_path}/lake"))
    daily.build_day(spark, lake, END)
    scores, book = marts_of(spark, lake)
    assert [r[0] for r in scores] == TICKERS
    assert len(book) == 12 and {r[1] for r in book} == {END}
    daily.build_day(spark, lake, END)
    assert marts_of(spark, lake) == (scores, book)


def test_other_dates_stay_in_the_marts(spark, filled, tmp_path):
    lake = with_prices_of(filled, Lake(f"{tmp_path}/lake"))
    daily.build_day(spark, lake, END)
    daily.build_day(spark, lake, END - timedelta(days=1))
    scores, _ = marts_of(spark, lake)
    assert {r[1] for r in scores} == {END, END - timedelta(days=1)}


def test_backfill_equals_day_by_day(spark, filled, tmp_path):
    days = [END - timedelta(days=i) for i in range(3)]
    one_pass = with_prices_of(filled, Lake(f"{tmp_path}/one"))
    backfill.backfill(spark, one_pass, days[-1], days[0], run_curation=False, run_features=True)
    each = with_prices_of(filled, Lake(f"{tmp_path}/each"))
    for day in days:
        daily.build_day(spark, each, day)

    def rounded(rows):
        return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows]

    for a, b in zip(marts_of(spark, one_pass), marts_of(spark, each)):
        assert rounded(a) == rounded(b) and len(a) > 0


def test_backfill_gate_and_reversed_range(spark, filled, tmp_path):
    lake = with_prices_of(filled, Lake(f"{tmp_path}/lake"))
    first = END - timedelta(days=94)
    backfill.backfill(spark, lake, first + timedelta(days=61), first + timedelta(days=58), run_curation=False, run_features=True)
    done = sorted(r["date"] for r in lake_io.dates_done(spark, lake).collect())
    # Sixty raw dates lie before the 61st; the two earlier days of the range are not built.
    assert done == [first + timedelta(days=60), first + timedelta(days=61)]


def test_backfill_skips_what_is_done(spark, filled, tmp_path):
    lake = with_prices_of(filled, Lake(f"{tmp_path}/lake"))
    lake_io.overwrite_date(spark.createDataFrame([], schemas.SIGNAL_SCORES), lake.signal_scores, END)
    backfill.backfill(spark, lake, END, run_curation=False, run_features=True)
    assert marts_of(spark, lake) == ([], [])
    backfill.backfill(spark, lake, END, run_curation=False, run_features=True, skip_existing=False)
    scores, book = marts_of(spark, lake)
    assert len(scores) == 6 and len(book) == 12


def test_backfill_clears_a_date_that_is_now_empty(spark, filled, tmp_path):
    lake = with_prices_of(filled, Lake(f"{tmp_path}/lake"))
    daily.build_day(spark, lake, END)
    assert marts_of(spark, lake)[0]
    backfill.backfill(
        spark, lake, END, run_curation=False, run_features=True, skip_existing=False, lookback_days=30)
    assert marts_of(spark, lake) == ([], [])
    assert [r["date"] for r in lake_io.dates_done(spark, lake).collect()] == [END]


def test_backfill_without_data(spark, lake):
    assert backfill.backfill(spark, lake, END, run_features=True) is None
    assert marts_of(spark, lake) == ([], [])


def test_backfill_curates_the_filings_of_its_quarters(spark, lake, tmp_path):
    for run_date in (date(2024, 3, 29), END):
        folder = f"{tmp_path}/{run_date}/A/10-Q/1"
        os.makedirs(folder)
        with open(f"{folder}/x.txt", "w") as file:
            file.write("filing")
        daily.ingest_filings(spark, lake, f"{tmp_path}/{run_date}", run_date)
    landing = land(f"{tmp_path}/landing", days=95)
    backfill.backfill(spark, lake, date(2024, 3, 29), date(2024, 4, 2), landing=landing)
    rows = lake_io.read_table(spark, lake.quarterly_fundamentals, schemas.QUARTERLY_FUNDAMENTALS)
    assert sorted(r["quarter"] for r in rows.collect()) == ["Q1", "Q2"]


@pytest.mark.parametrize("n, kept", [(60, 0), (61, 1), (70, 10), (3, 0)])
def test_enough_history(spark, n, kept):
    days = [(END - timedelta(days=2 * i),) for i in range(n)]
    df = spark.createDataFrame(days + days, "date date")
    got = sorted(r["date"] for r in backfill.with_enough_history(df).collect())
    assert got == sorted(d for d, in days)[n - kept:] if kept else got == []
    assert backfill.with_enough_history(df, 0).count() == n


def test_anchors():
    a, b = date(2024, 1, 1), date(2024, 12, 31)
    expected = [date(2024, 1, 6), date(2024, 5, 5), date(2024, 9, 2), date(2024, 12, 31)]
    assert backfill.anchors(a, b) == backfill.anchors(b, a) == expected


@pytest.mark.parametrize("step", [50, 120, 121, 300])
def test_ingest_windows_by_hand(spark, step):
    start, end = date(2023, 1, 1), date(2024, 6, 28)
    days = [start - timedelta(days=200) + timedelta(days=i) for i in range(800)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    got = {r["date"] for r in df.where(backfill.in_ingest_windows("date", start, end, step)).collect()}
    runs = backfill.anchors(start, end, step)
    assert got == {d for d in days if any(timedelta(0) <= a - d <= timedelta(days=120) for a in runs)}


def test_filings_run(spark, lake, tmp_path):
    for path in ("A/10-Q/1/x.txt", "A/10-K/2/x.txt", "B/10-K/3/x.txt"):
        os.makedirs(os.path.dirname(f"{tmp_path}/dl/{path}"))
        with open(f"{tmp_path}/dl/{path}", "w") as file:
            file.write("filing")
    for _ in range(2):
        daily.ingest_filings(spark, lake, f"{tmp_path}/dl", END)
        daily.curate_day(spark, lake, END)
    rows = lake_io.read_table(spark, lake.quarterly_fundamentals, schemas.QUARTERLY_FUNDAMENTALS).collect()
    assert sorted((r["ticker"], r["filing_type"], r["year"], r["quarter"]) for r in rows) == [
        ("A", "10-Q", 2024, "Q2"), ("B", "10-K", 2024, "Q2")]


def test_stream_takes_new_files_and_late_rows(spark, lake, tmp_path):
    def run():
        stream.start(spark, lake, f"{tmp_path}/landing", f"{tmp_path}/state").awaitTermination()
        return table(spark, lake.daily_prices, schemas.DAILY_PRICES)

    land(f"{tmp_path}/landing", days=2, tickers=["T01"])
    assert len(run()) == 2
    assert len(run()) == 2
    land(f"{tmp_path}/landing", days=1, tickers=["T02"])
    rows = run()
    assert {(r[0], r[1]) for r in rows} == {
        (END - timedelta(days=1), "T01"), (END, "T01"), (END, "T02")}


def test_a_repeated_stream_batch_changes_nothing(spark, lake, prices):
    batch = prices({}, {"ticker": "B"})
    stream.curate_batch(spark, lake, batch)
    once = table(spark, lake.daily_prices, schemas.DAILY_PRICES)
    stream.curate_batch(spark, lake, batch)
    assert table(spark, lake.daily_prices, schemas.DAILY_PRICES) == once and len(once) == 2
