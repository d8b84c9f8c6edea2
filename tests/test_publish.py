"""Several tables published as one, listings by tasks, dates by their folders."""

import os
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quotidian import schemas
from quotidian.operators import state
from quotidian.operators.features import price_features_as_of
from quotidian.plans import backfill, daily
from quotidian.sources import files, filings, lake as lake_io, listing, prices, publish
from quotidian.streaming import landing as stream

DAY = date(2024, 6, 28)


def scores_of(spark, *rows):
    wide = [(t, d, 1.0, 1.0, 1.0, s) for t, d, s in rows]
    return spark.createDataFrame(wide, schemas.SIGNAL_SCORES)


def book_of(spark, *rows):
    return spark.createDataFrame([(t, d, "long", s, 1) for t, d, s in rows], schemas.POSITIONS)


def publish_both(spark, lake, score):
    days = [DAY, DAY - timedelta(days=1)]
    with publish.publication(spark, lake) as unit:
        unit.stage(scores_of(spark, ("A", DAY, score)), lake.signal_scores, days)
        unit.stage(book_of(spark, ("A", DAY, score)), lake.positions, days)


def seen(spark, lake):
    return (
        [(r["date"], r["signal_score"]) for r in publish.published_scores(spark, lake).collect()],
        [(r["date"], r["signal_score"]) for r in publish.published_positions(spark, lake).collect()],
    )


def left_behind(lake):
    return [p for d in ("_staging", "_publishing") if (Path(lake.root) / d).exists() for p in (Path(lake.root) / d).iterdir()
            if not p.name.endswith(".crc")]


def test_both_tables_and_empty_dates_are_published(spark, lake):
    publish_both(spark, lake, 1.0)
    assert seen(spark, lake) == ([(DAY, 1.0)], [(DAY, 1.0)])
    assert sorted(r["date"] for r in lake_io.dates_done(spark, lake).collect()) == [DAY - timedelta(days=1), DAY]
    assert left_behind(lake) == []


def test_a_run_that_fails_while_staging_leaves_nothing(spark, lake):
    publish_both(spark, lake, 1.0)
    with pytest.raises(ZeroDivisionError):
        with publish.publication(spark, lake) as unit:
            unit.stage(scores_of(spark, ("A", DAY, 2.0)), lake.signal_scores, [DAY])
            raise ZeroDivisionError
    assert seen(spark, lake) == ([(DAY, 1.0)], [(DAY, 1.0)])
    assert left_behind(lake) == []


@pytest.mark.parametrize("moved", [0, 1, 2, 3])
def test_a_run_that_fails_between_the_moves_is_carried_on(spark, lake, monkeypatch, moved):
    publish_both(spark, lake, 1.0)
    move, done = files.move, []

    def failing(spark, source, target):
        if len(done) == moved:
            raise OSError("the store is gone")
        done.append(target)
        move(spark, source, target)

    monkeypatch.setattr(files, "move", failing)
    monkeypatch.setattr(publish, "MOVERS", 1)
    with pytest.raises(OSError):
        publish_both(spark, lake, 2.0)
    # Neither the old nor the new rows are shown, and the dates count as not done.
    assert seen(spark, lake) == ([], [])
    assert lake_io.dates_done(spark, lake).count() == 0
    monkeypatch.setattr(files, "move", move)
    assert len(publish.recover(spark, lake)) == 1
    assert seen(spark, lake) == ([(DAY, 2.0)], [(DAY, 2.0)])
    assert lake_io.dates_done(spark, lake).count() == 2
    assert left_behind(lake) == [] and publish.recover(spark, lake) == []


def test_the_next_run_carries_on_first(spark, lake, monkeypatch):
    monkeypatch.setattr(files, "move", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        publish_both(spark, lake, 2.0)
    monkeypatch.undo()
    other = DAY + timedelta(days=1)
    with publish.publication(spark, lake) as unit:
        unit.stage(scores_of(spark, ("A", other, 3.0)), lake.signal_scores, [other])
    assert sorted(seen(spark, lake)[0]) == [(DAY, 2.0), (other, 3.0)]


def test_dates_go_by_folders_and_not_by_files(spark, lake, tmp_path, monkeypatch):
    """10,000 files in 100 dates: at most one file of a date is looked at, and none of a date that is logged."""
    table = tmp_path / "t"
    days = [DAY - timedelta(days=i) for i in range(100)]
    for day in days:
        folder = table / f"date={day}"
        folder.mkdir(parents=True)
        for i in range(100):
            (folder / f"part-{i}.parquet").touch()
    (table / "date=junk").mkdir()
    (table / f"date={DAY + timedelta(days=1)}").mkdir()
    looked = []
    entries = files.entries

    def counted(spark, path):
        for entry in entries(spark, path):
            looked.append(entry.path)
            yield entry

    monkeypatch.setattr(files, "entries", counted)
    assert lake_io.stored_days(spark, str(table)) == sorted(days)
    assert len(looked) == 100
    looked.clear()
    lake_io.note_days(spark, str(table), days)
    assert lake_io.stored_days(spark, str(table)) == sorted(days) and looked == []


def test_other_layouts_of_dates(spark, tmp_path):
    for name in ("2024/06/28/A.parquet", "2024/06/27/readme.txt", "2024-06-26.parquet", "latest.parquet", "2024/6x/01/A.parquet"):
        path = tmp_path / "t" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.touch()
    assert lake_io.stored_days(spark, f"{tmp_path}/t") == [date(2024, 6, 26), DAY]


def test_filings_with_signs_in_their_names(spark, tmp_path):
    names = ["A%23B", "C D, E", "F+G", "H=1#2"]
    for name in names:
        folder = tmp_path / "dl" / name / "10-Q"
        folder.mkdir(parents=True)
        (folder / "x y%20.txt").write_text("abc")
        (folder / "_empty.txt").touch()
    rows = filings.list_filings(spark, f"{tmp_path}/dl").collect()
    assert sorted({r["ticker"] for r in rows}) == sorted(names) and len(rows) == 8
    assert {Path(r["file_path"]).name for r in rows} == {"x y%20.txt", "_empty.txt"}


def test_listing_is_dealt_to_tasks(spark, tmp_path, monkeypatch):
    folders = []
    for i in range(100):
        folder = tmp_path / f"f{i}"
        folder.mkdir()
        (folder / "a.txt").touch()
        folders.append(f"file:{folder}")
    monkeypatch.setattr(files, "entries", None)  # the driver lists nothing
    listed = listing.list_files(spark, folders)
    assert listed.rdd.getNumPartitions() == 4 and listed.count() == 100
    assert listing.list_files(spark, []).count() == 0


def test_a_store_that_only_spark_reaches(spark, tmp_path, monkeypatch):
    (tmp_path / "A" / "10-Q").mkdir(parents=True)
    (tmp_path / "A" / "10-Q" / "x.txt").write_text("x")
    monkeypatch.setattr(listing, "is_reachable", lambda folder: False)
    assert [(r["ticker"], r["filing_type"]) for r in filings.list_filings(spark, str(tmp_path)).collect()] == [("A", "10-Q")]


# --- landed files -----------------------------------------------------------------------------

def landed(spark, tmp_path, text):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / "AAA.csv").write_text(text, newline="")
    return prices.read_landed_csv(spark, f"{tmp_path}/in").drop("ticker").collect()


def test_any_number_of_columns(spark, tmp_path):
    names = ["date", *[f"x{i}" for i in range(500)], "Close"]
    rows = landed(spark, tmp_path, ",".join(names) + "\n" + ",".join(["2024-06-28", *["1"] * 500, "9.5"]) + "\n")
    assert [(r["date"], r["close"], r["open"]) for r in rows] == [("2024-06-28", "9.5", None)]


def test_line_ends_commas_and_quotes_inside_quotes(spark, tmp_path):
    rows = landed(spark, tmp_path, (
        '"Note","Date",Close\r\n'
        '"a\r\nb, ""c"" ",2024-06-27,1\r\n'
        '\r\n'
        '5" wide,2024-06-28,2\r\n'  # a quote inside a plain field is a sign like others
        ',"2024-06-30","4"\r\n'
        '"open,2024-06-29,3'))  # never closed: plain
    assert [(r["date"], r["close"]) for r in rows] == [
        ("2024-06-27", "1"), ("2024-06-28", "2"), ("2024-06-30", "4"), ("2024-06-29", "3")]


def test_a_long_quoted_field(spark, tmp_path):
    text = "x" * 200_000 + "\n" + '""' * 20_000
    rows = landed(spark, tmp_path, f'Date,Note,Close\n2024-06-28,"{text}",7\n')
    assert [(r["date"], r["close"]) for r in rows] == [("2024-06-28", "7")]


def test_names_that_are_no_tickers_are_not_landed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "A%41.csv").write_text("Date,Close\n2024-06-28,1\n")
    (folder / "README.txt").write_text("Date,Close\n2024-06-28,1\n")
    assert [r["ticker"] for r in prices.read_landed_csv(spark, str(folder)).collect()] == ["A%41"]


def test_a_universe_bounds_the_ingest(spark, lake, tmp_path, universe):
    folder = tmp_path / "in"
    folder.mkdir()
    for ticker in ("A", "Z"):
        (folder / f"{ticker}.csv").write_text("Date,Close\n2024-06-28,1\n")
    daily.ingest_prices(spark, lake, str(folder), DAY, universe)
    assert {r["ticker"] for r in prices.read_raw(spark, lake.raw_prices).collect()} == {"A"}


def test_a_repeated_stream_batch_replaces_its_rejected_rows(spark, lake):
    batch = spark.createDataFrame(
        [("A", "soon", "1", "1", "1", "1", "1"), ("A", "2024-06-28", "1", "1", "1", "1", "1")],
        "ticker string, date string, open string, high string, low string, close string, volume string")
    for number in (3, 3, 4):
        stream.curate_batch(spark, lake, batch, number)
    assert spark.read.parquet(lake.rejected_stream).groupBy("batch").count().orderBy("batch").collect() == [(3, 1), (4, 1)]


def test_the_last_ingest_wins_whatever_its_file_is_called(spark, lake, prices):
    for close in (1.0, 2.0, 3.0, 2.0):
        daily.append_raw_prices(prices({"close": close}), lake)
        for part in Path(lake.raw_prices).glob("date=*/*.parquet"):
            os.utime(part, (0, 0))  # a store whose times tie
    daily.curate_prices_day(spark, lake, DAY)
    assert [r["close"] for r in spark.read.parquet(lake.daily_prices).collect()] == [2.0]


def test_damaged_manifests_are_reported(spark, lake, tmp_path, prices):
    folder = tmp_path / "dl" / "A" / "10-Q"
    folder.mkdir(parents=True)
    (folder / "x.txt").write_text("x")
    daily.ingest_filings(spark, lake, f"{tmp_path}/dl", DAY)
    daily.append_raw_prices(prices({}), lake)
    (Path(lake.raw_filings) / "year=2024" / "quarter=Q2" / "broken.parquet").write_bytes(b"PAR1")
    report = daily.curate_day(spark, lake, DAY)
    assert [Path(p).name for p in report["unreadable_manifests"]] == ["broken.parquet"]
    assert spark.read.parquet(lake.quarterly_fundamentals).count() == 1


# --- a day against the days before ------------------------------------------------------------

def test_a_jump_over_a_gap_is_reported(spark, lake, prices):
    before = DAY - timedelta(days=40)
    daily.append_raw_prices(prices(
        {"date": before, "close": 10.0}, {"date": before, "close": 10.0, "ticker": "B"},
        {"close": 16.0, "high": 20.0}, {"close": 10.5, "ticker": "B"}), lake)
    daily.curate_prices_day(spark, lake, before)
    report = daily.curate_prices_day(spark, lake, DAY)
    assert report["warnings"] == ["Found 1 ticker dates with an overnight change above 50%"]
    assert report["stats"] == {"total_rows": 2, "unique_tickers": 2}


def test_a_backfill_judges_by_stored_neighbours(spark, lake, prices):
    days = [DAY - timedelta(days=i) for i in (2, 1, 0)]
    closes = dict(zip(days, (10.0, 14.0, 19.0)))  # 90 % in two days, no more than 40 % in one
    daily.append_raw_prices(prices(*[{"date": d, "close": c, "high": 30.0} for d, c in closes.items()]), lake)
    backfill.backfill(spark, lake, days[1])
    lake_io.overwrite_date(spark.createDataFrame([], schemas.SIGNAL_SCORES), lake.signal_scores, days[1])
    report = backfill.backfill(spark, lake, days[0], days[2])
    assert report["warnings"] == [] and report["stats"]["total_rows"] == 2


def test_state_follows_day_by_day(spark, bars):
    """Thirty days from state to state give the features that each day's own lookback gives."""
    series = {"A": [10.0 + (7 * i) % 13 for i in range(130)], "B": [None if i % 9 == 4 else 5.0 + (3 * i) % 11 for i in range(75)]}
    every = bars(series)
    rows = every.collect()
    kept = state.state_of(every.where(F.col("date") <= F.lit(DAY - timedelta(days=30))), DAY - timedelta(days=30), 100)
    for back in range(29, -1, -1):
        day = DAY - timedelta(days=back)
        today = spark.createDataFrame([r for r in rows if r["date"] == day], "ticker string, date date, close double")
        kept = state.state_of(state.bars_of(kept).unionByName(today), day, 100)
        kept = spark.createDataFrame(kept.collect(), schemas.ROLLING_STATE)
        if back % 10 == 0:
            got = price_features_as_of(state.bars_of(kept), day).orderBy("ticker").collect()
            assert got == price_features_as_of(every, day).orderBy("ticker").collect() and got


def test_a_state_is_used_until_a_date_behind_it_changes(spark, lake, prices):
    days = [DAY - timedelta(days=i) for i in range(70, -1, -1)]
    table = prices(*[{"date": d, "close": 10.0 + (i * 7) % 5} for i, d in enumerate(days)])
    lake_io.overwrite_partitions(table, lake.daily_prices, days=days)
    assert daily.usable_state(spark, lake, DAY, 100) is None
    daily.build_day(spark, lake, days[-2])
    assert daily.usable_state(spark, lake, DAY, 100) == days[-2]
    assert daily.usable_state(spark, lake, DAY, 101) is None
    plan = daily.history_before(spark, lake, DAY)._jdf.queryExecution().executedPlan().toString()
    assert f"> {days[-2]})" in plan and plan.count("PartitionFilters: [isnotnull(date") == 1
    daily.build_day(spark, lake, DAY)
    from_state = [tuple(r) for r in publish.published_scores(spark, lake).collect() if r["date"] == DAY]
    lake_io.overwrite_date(table.where(F.col("date") == F.lit(days[30])), lake.daily_prices, days[30])
    assert daily.usable_state(spark, lake, DAY, 100) is None
    daily.build_day(spark, lake, DAY)
    assert [tuple(r) for r in publish.published_scores(spark, lake).collect() if r["date"] == DAY] == from_state


# --- revenue ----------------------------------------------------------------------------------

def test_growth_by_hand(spark):
    """Quarter 8096 is the first of 2024; a base is restated later, a quarter is filed late, one has no date."""
    from quotidian.operators.fundamentals import growth_as_filed, quarter_end

    rows = [
        ("A", 8092, 100.0, date(2023, 4, 20)), ("A", 8096, 150.0, date(2024, 4, 20)),
        ("A", 8092, 120.0, date(2024, 5, 10)), ("A", 8095, 80.0, date(2024, 6, 1)),
        ("A", 8096, 180.0, date(2024, 6, 10)), ("B", 8092, 10.0, None), ("B", 8096, 20.0, None), ("C", 8096, 5.0, date(2024, 5, 1)),
    ]
    filings_ = spark.createDataFrame(rows, schemas.REVENUE_FILINGS)
    days = [date(2024, 4, 1), date(2024, 4, 20), date(2024, 5, 9), date(2024, 5, 10), date(2024, 6, 5), date(2024, 6, 28)]
    wanted = spark.createDataFrame([(d,) for d in days], "date date")
    got = {(r["ticker"], r["date"]): r["yoy_revenue_growth_proxy"] for r in growth_as_filed(filings_, wanted).collect()}
    own = [got.get(("A", d), "none") for d in days]
    assert own == [None, pytest.approx(0.5), pytest.approx(0.5), pytest.approx(0.25), pytest.approx(0.25), pytest.approx(0.5)]
    assert [got.get(("B", d)) for d in days] == [pytest.approx(1.0)] * 6
    assert [("C", d) in got for d in days] == [False, False, True, True, True, True] and got["C", days[2]] is None
    assert growth_as_filed(filings_, wanted.limit(0)).count() == 0
    assert spark.createDataFrame([(8096,), (8099,)], "q int").select(quarter_end("q")).collect() == [
        (date(2024, 3, 31),), (date(2024, 12, 31),)]


def test_landed_revenue_is_stored_once(spark, lake, tmp_path):
    folder = tmp_path / "rev"
    folder.mkdir()
    (folder / "a.csv").write_text("Ticker,Quarter,Filed,Revenue\nA,2024-03-31,04/20/2024,100\nA,2024-02-01,2024-05-20,110\nA,x,2024-05-20,1\n,2024-03-31,,2\nB,2024-03-31,,n/a\n")
    for _ in range(2):
        daily.ingest_revenue(spark, lake, str(folder))
    stored = lake_io.read_table(spark, lake.quarterly_revenue, schemas.REVENUE_FILINGS)
    assert sorted(map(tuple, stored.collect())) == [
        ("A", 8096, 100.0, date(2024, 4, 20)), ("A", 8096, 110.0, date(2024, 5, 20))]
    growth = daily.stored_growth(spark, lake, spark.createDataFrame([(DAY,)], "date date"))
    assert [tuple(r) for r in growth.collect()] == [("A", DAY, None)]


def test_revenue_and_rejected_rows_are_known_to_sql(spark, lake, tmp_path):
    from quotidian.sources import catalog

    (tmp_path / "rev").mkdir()
    (tmp_path / "rev" / "a.csv").write_text("ticker,quarter,filed,revenue\nA,2024-03-31,2024-04-20,100\n")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "A.csv").write_text("Date,Close\nsoon,1\n2024-06-28,2\n")
    daily.ingest_revenue(spark, lake, f"{tmp_path}/rev")
    daily.ingest_prices(spark, lake, f"{tmp_path}/in", DAY)
    assert catalog.register_lake(spark, lake) == []
    assert spark.sql("SELECT ticker, revenue, year FROM curated.quarterly_revenue").collect() == [("A", 100.0, 2024)]
    assert spark.sql("SELECT ticker, date_text, date FROM raw.rejected_prices").collect() == [("A", "soon", DAY)]
