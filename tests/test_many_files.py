"""Queries whose input is many small files: tasks write and list them, and it is made once."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from quotidian import registry, schemas
from quotidian.sources import files, filings, listing, warehouse


def _forbidden(*_):
    raise AssertionError("the driver lists ticker folders")


def test_ticker_folders_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """The driver used to gather the ticker folders and to send them all to each task."""
    for name in ("A#1/10-K/x.txt", "B/10-Q/deep/y.txt", "B/10-Q/_hidden.txt", "C/8-K/.dotted", "C/loose.txt", "stray.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("z")
    (tmp_path / "EMPTY").mkdir()
    monkeypatch.setattr(files, "matching", _forbidden)
    rows = filings.list_filings(spark, str(tmp_path)).select("ticker", "filing_type", "file_path").collect()
    assert sorted((r["ticker"], r["filing_type"], r["file_path"].removeprefix(f"file:{tmp_path}")) for r in rows) == [
        ("A#1", "10-K", "/A#1/10-K/x.txt"), ("B", "10-Q", "/B/10-Q/_hidden.txt"), ("B", "10-Q", "/B/10-Q/deep/y.txt"),
        ("C", "8-K", "/C/8-K/.dotted")]
    assert filings.list_filings(spark, f"{tmp_path}/nowhere").count() == 0


def test_small_files_are_written_by_many_tasks(spark, tmp_path):
    """Few bytes in many files used to be one task's, and its driver moved each file."""
    rows = spark.range(200).select(
        F.concat(F.lit("t="), "id", F.lit("/f.txt")).alias("below"), F.concat(F.lit("é"), "id").alias("value"))
    listing.write_texts(rows, str(tmp_path))
    found = [p for p in tmp_path.rglob("*") if p.is_file()]
    assert {(p.relative_to(tmp_path).as_posix(), p.read_text()) for p in found} == {
        (f"t={i}/f.txt", f"é{i}\n") for i in range(200)}


def test_filings_of_any_ticker_are_listed(spark, monkeypatch):
    rows = [(t, kind, datetime(2024, 1, 1), path, "s", 2024, "Q1") for t, kind, path in [
        ("A+B C", "10-K", "/a"), ("A+B C", "10-K", "/b"), ("#%/é", "10-Q", "/c"), (None, "10-Q", "/d"), ("", "10-Q", "/e"),
        ("D", "8-K", "/f"), ("E", "10-K", ""), ("F", "10-K", None)]]
    names = "ticker string, filing_type string, download_time timestamp, file_path string, source string, year int, quarter string"
    monkeypatch.setattr(warehouse, "filing_manifest", lambda spark, folder: spark.createDataFrame(rows, names))
    listed = {tuple(r) for r in registry.QUERIES["filing_listing"](spark, "").collect()}
    assert listed == {("A+B C", "10-K", 1), ("#%/é", "10-Q", 1), ("__HIVE_DEFAULT_PARTITION__", "10-Q", 1), ("NONE", "8-K", 3)}


def test_bars_are_made_once_for_three_ingests(spark, monkeypatch):
    """Bars whose closes differ whenever they are made: each ingest used to make them again."""
    draw = F.udf(lambda _: random.SystemRandom().random() + 1, "double").asNondeterministic()
    days = [(date(2024, 1, 1) + timedelta(days=i), t) for i in range(3) for t in ("A", "B")]

    def bars(spark, folder):
        rows = spark.createDataFrame(days, "date date, ticker string").withColumn("close", draw("ticker"))
        return rows.select("date", "ticker", *[F.col("close").alias(c) for c in ("open", "high", "low", "close")],
                           F.lit(1).cast("bigint").alias("volume"), F.lit(schemas.PRICE_SOURCE).alias("source"))

    monkeypatch.setattr(warehouse, "brand_bars", bars)
    stored = registry.QUERIES["raw_reingest"](spark, "").collect()
    assert len(stored) == 8  # six, and both closes of the first again
    first = sorted((r["ticker"], r["close"]) for r in stored if r["date"].day == 1)
    assert [t for t, _ in first] == ["A", "A", "B", "B"]
    assert first[1][1] == 2 * first[0][1] and first[3][1] == 2 * first[2][1]
