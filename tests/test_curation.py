import random
from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quotidian import schemas
from quotidian.functions import scalar
from quotidian.operators import curation

D1, D2, D3 = date(2024, 6, 26), date(2024, 6, 27), date(2024, 6, 28)
TEXT = "date string, ticker string, open string, high string, low string, close string, volume string, source string, seq int"


def raw(spark, *rows):
    """Rows (date, ticker, close, volume, seq) as text."""
    return spark.createDataFrame(
        [(str(d), t, c, c, c, c, v, "s", q) for d, t, c, v, q in rows], TEXT)


def test_missing_columns_raise(spark):
    with pytest.raises(curation.MissingColumns, match="volume"):
        curation.coerce_prices(raw(spark, (D1, "A", "1", "1", 1)).drop("volume"))


@pytest.mark.parametrize("text, number", [
    ("2", 2.0), (" 2.5 ", 2.5), ("1e3", 1000.0), ("", None), ("x", None), (None, None),
    ("nan", None), ("1d", None), ("2.5f", None), ("3D ", None), ("inf", None),
    ("-Infinity", None), ("1e400", None), ("0x1p3", None), ("4d\t", None), ("\t4 ", 4.0),
])
def test_text_to_number(spark, text, number):
    got = curation.coerce_prices(raw(spark, (D1, "A", text, "1", 1))).first()
    assert got["close"] == number


def test_random_text_parses_as_in_pandas(spark):
    rng = random.Random(1)
    letters = "0123456789" * 2 + ".eE+-dDfF naixINFtyp_,\t"
    texts = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(20000)})
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["n"] for r in scalar.parse_numbers(df.withColumn("n", F.col("t")), ["n"]).collect()}
    expected = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    for text, number in zip(texts, expected):
        if pd.isna(number) or abs(number) == float("inf"):
            # pandas also gives up on a zero with an exponent too large for a double.
            assert got[text] is None or got[text] == 0, text
        else:
            assert got[text] == pytest.approx(number, rel=1e-12), text


def test_nan_in_a_number_column_becomes_null(spark):
    df = raw(spark, (D1, "A", "1", "1", 1)).withColumn("close", F.lit(float("nan")))
    assert curation.coerce_prices(df).first()["close"] is None


@pytest.mark.parametrize("text, whole", [
    ("0.5", 0), ("1.5", 2), ("2.5", 2), ("3", 3), ("-0.5", 0), ("-1.5", -2), ("x", None), ("", None),
    ("1e30", None),
])
def test_volume_rounds_half_to_even(spark, text, whole):
    df = curation.coerce_prices(raw(spark, (D1, "A", "1", text, 1)))
    assert df.schema["volume"].dataType.simpleString() == "bigint"
    assert df.first()["volume"] == whole


def test_timestamps_are_cut_to_dates(spark):
    df = raw(spark, (D1, "A", "1", "1", 1)).withColumn("date", F.lit(datetime(2024, 6, 26, 15, 30)))
    assert curation.coerce_prices(df).first()["date"] == D1


def test_absent_text_stays_null(spark):
    df = raw(spark, (D1, None, "1", "1", 1))
    assert curation.coerce_prices(df).first()["ticker"] is None


def test_run_date_is_kept_and_others_dropped(spark):
    df = raw(spark, (D1, "A", "1", "1", 1), (D2, "A", "2", "1", 1), (D3, "A", "3", "1", 1))
    assert [r["date"] for r in curation.curate_daily_prices(df, D2).collect()] == [D2]


def test_without_the_run_date_the_latest_is_kept(spark):
    df = raw(spark, (D1, "A", "1", "1", 1), (D2, "A", "2", "1", 1), (D2, "B", "2", "1", 1))
    got = curation.curate_daily_prices(df, date(2024, 7, 1)).collect()
    assert {(r["date"], r["ticker"]) for r in got} == {(D2, "A"), (D2, "B")}


def test_no_rows_give_a_typed_empty_result(spark):
    got = curation.curate_daily_prices(raw(spark, (D1, "A", "1", "1", 1)).limit(0), D1)
    assert got.schema == schemas.DAILY_PRICES or got.columns == schemas.DAILY_PRICES.names
    assert got.count() == 0


def test_last_ingested_copy_wins(spark):
    df = raw(spark, (D1, "A", "9", "1", 1), (D1, "A", "2", "1", 3), (D1, "A", "5", "1", 2))
    got = curation.curate_daily_prices(df, D1, ["seq"]).collect()
    assert [r["close"] for r in got] == [2.0]


def test_equal_ingests_are_settled_by_their_values(spark):
    rows = [(D1, "A", "3", "1", 1), (D1, "A", "7", "1", 1), (D1, "A", None, "1", 1)]
    for order in (rows, rows[::-1]):
        got = curation.curate_daily_prices(raw(spark, *order), D1, ["seq"]).collect()
        assert [r["close"] for r in got] == [7.0]


def test_every_partition_keeps_its_own_date_or_its_latest(spark):
    df = raw(spark, (D1, "A", "1", "1", 1), (D2, "A", "2", "1", 1), (D3, "B", "3", "1", 1))
    landed = df.withColumn("landed", F.when(F.col("ticker") == "B", F.lit(date(2024, 7, 1))).otherwise(F.lit(D2)))
    got = curation.curate_price_partitions(landed, "landed").collect()
    assert {(r["date"], r["ticker"]) for r in got} == {(D2, "A"), (D3, "B")}


def test_partitions_may_be_named_by_text(spark):
    df = raw(spark, (D1, "A", "1", "1", 1), (D2, "A", "2", "1", 1), (D3, "B", "3", "1", 1))
    landed = df.withColumn("batch", F.when(F.col("ticker") == "B", "2024-07-01").otherwise("2024-06-26"))
    got = curation.curate_price_partitions(landed, "batch").collect()
    assert {(r["date"], r["ticker"]) for r in got} == {(D1, "A"), (D3, "B")}


def test_later_partition_wins_on_a_shared_date(spark):
    df = raw(spark, (D1, "A", "1", "1", 9), (D1, "A", "2", "1", 1))
    landed = df.withColumn(
        "landed", F.when(F.col("seq") == 9, F.lit(D2)).otherwise(F.lit(D3)))
    got = curation.curate_price_partitions(landed, "landed", ["seq"]).collect()
    assert [r["close"] for r in got] == [2.0]


def test_all_dates_at_once(spark):
    df = raw(spark, (D1, "A", "1", "1", 1), (D2, "A", "2", "1", 1), (D2, "A", "3", "1", 2), ("bad", "A", "1", "1", 1))
    got = {r["date"]: r["close"] for r in curation.curate_all_dates(df, ["seq"]).collect()}
    assert got == {D1: 1.0, D2: 3.0}


def manifest(spark, *rows):
    return spark.createDataFrame(
        [(t, f, datetime(2024, 1, 1), p, "s") for t, f, p in rows], schemas.MANIFEST)


def test_filings_without_a_file_are_dropped(spark):
    df = manifest(spark, ("A", "10-Q", "/x"), ("A", "10-Q", None), ("B", "10-Q", ""))
    assert [r["file_path"] for r in curation.curate_filings(df).collect()] == ["/x"]


def test_filings_need_their_columns(spark):
    with pytest.raises(curation.MissingColumns):
        curation.curate_filings(manifest(spark, ("A", "10-Q", "/x")).drop("source"))


def test_annual_reports_only_without_quarterly_ones(spark):
    df = manifest(spark, ("A", "10-Q", "/1"), ("A", "10-K", "/2"), ("B", "10-K", "/3"), ("C", "8-K", "/4"))
    got = {r["file_path"] for r in curation.prefer_filing_type(df).collect()}
    assert got == {"/1", "/3"}


def test_three_filing_types(spark):
    df = manifest(spark, ("A", "x", "/1"), ("A", "z", "/2"), ("B", "y", "/3"), ("B", "z", "/4"), ("C", "z", "/5"))
    got = {r["file_path"] for r in curation.prefer_filing_type(df, ("x", "y", "z")).collect()}
    assert got == {"/1", "/3", "/5"}
