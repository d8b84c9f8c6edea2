import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F

from quotidian import schemas
from quotidian.operators.scoring import normalize_to_zscore, score_signals, to_mart

D1, D2 = date(2024, 6, 27), date(2024, 6, 28)
SCHEMA = "ticker string, date date, a double, b double"


def test_zscore_per_date_with_sample_deviation(spark):
    df = spark.createDataFrame(
        [("A", D1, 1.0, 0.0), ("B", D1, 2.0, 0.0), ("C", D1, 6.0, 0.0), ("A", D2, 5.0, 0.0),
         ("B", D2, 9.0, 0.0)], SCHEMA)
    got = {(r["ticker"], r["date"]): r["z"] for r in normalize_to_zscore(df, "a", out="z").collect()}
    mean, std = 3.0, statistics.stdev([1, 2, 6])
    assert got[("C", D1)] == pytest.approx((6 - mean) / std)
    assert got[("A", D2)] == pytest.approx((5 - 7) / statistics.stdev([5, 9]))


def test_nulls_stay_out_of_the_statistics(spark):
    df = spark.createDataFrame([("A", D1, 1.0, 0.0), ("B", D1, None, 0.0), ("C", D1, 3.0, 0.0)], SCHEMA)
    got = {r["ticker"]: r["a_zscore"] for r in normalize_to_zscore(df, "a").collect()}
    assert got["B"] is None
    assert got["A"] == pytest.approx(-got["C"])


def test_one_ticker_or_no_spread_gives_null(spark):
    df = spark.createDataFrame([("A", D1, 1.0, 0.0), ("A", D2, 4.0, 0.0), ("B", D2, 4.0, 0.0)], SCHEMA)
    assert {r["signal_score"] for r in score_signals(df).collect()} == {None}


def test_rows_without_a_group_are_kept(spark):
    df = spark.createDataFrame([("A", None, 1.0, 0.0), ("B", D1, 2.0, 0.0)], SCHEMA)
    assert normalize_to_zscore(df, "a").count() == 2


def test_composite_is_the_mean_of_what_is_there(spark):
    df = spark.createDataFrame(
        [("A", D1, 1.0, None), ("B", D1, 2.0, 4.0), ("C", D1, 3.0, 8.0), ("D", D1, None, None)], SCHEMA)
    got = {r["ticker"]: r for r in score_signals(df).collect()}
    assert got["A"]["signal_score"] == pytest.approx(got["A"]["a_zscore"])
    assert got["C"]["signal_score"] == pytest.approx(
        (got["C"]["a_zscore"] + got["C"]["b_zscore"]) / 2)
    assert got["D"]["signal_score"] is None


def test_a_feature_unknown_for_all_is_left_out(spark):
    df = spark.createDataFrame([("A", D1, 1.0, None), ("B", D1, 2.0, None)], SCHEMA)
    got = {r["ticker"]: r for r in score_signals(df).collect()}
    assert got["A"]["b_zscore"] is None
    assert got["A"]["signal_score"] == pytest.approx(got["A"]["a_zscore"])


def test_as_of_filters(spark):
    df = spark.createDataFrame([("A", D1, 1.0, 1.0), ("A", D2, 1.0, 1.0)], SCHEMA)
    assert [r["date"] for r in score_signals(df, as_of=D2).collect()] == [D2]


def test_fundamentals_join_and_only_own_zscores_count(spark):
    df = spark.createDataFrame([("A", D1, 1.0, 1.0), ("B", D1, 2.0, 3.0), ("C", D1, 4.0, 2.0)], SCHEMA)
    # A raw column that merely looks like a z-score.
    facts = spark.createDataFrame(
        [("A", D1, 10.0), ("B", D1, 20.0), ("Z", D1, 99.0)], "ticker string, date date, odd_zscore double")
    scores = score_signals(df, facts)
    assert scores.columns == [
        "ticker", "date", "a_zscore", "b_zscore", "odd_zscore", "odd_zscore_zscore", "signal_score"]
    got = {r["ticker"]: r for r in scores.collect()}
    assert set(got) == {"A", "B", "C"}
    assert got["C"]["odd_zscore"] is None
    a = got["A"]
    assert a["signal_score"] == pytest.approx((a["a_zscore"] + a["b_zscore"] + a["odd_zscore_zscore"]) / 3)


def test_zscores_have_mean_zero_and_deviation_one(spark):
    df = spark.range(500).select(
        F.col("id").cast("string").alias("ticker"),
        F.when(F.col("id") < 200, F.lit(D1)).otherwise(F.lit(D2)).alias("date"),
        F.rand(3).alias("a"), F.randn(4).alias("b"))
    stats = score_signals(df).groupBy("date").agg(
        F.avg("a_zscore").alias("m"), F.stddev_samp("b_zscore").alias("s")).collect()
    assert len(stats) == 2
    for row in stats:
        assert row["m"] == pytest.approx(0, abs=1e-9) and row["s"] == pytest.approx(1)


def test_no_feature_columns_give_an_empty_result(spark):
    df = spark.createDataFrame([("A", D1)], "ticker string, date date")
    assert score_signals(df).columns == ["ticker", "date", "signal_score"]
    assert score_signals(df).count() == 0


def test_mart_form_has_all_columns(spark):
    empty = spark.createDataFrame([], "ticker string, date date, signal_score double, extra double")
    assert to_mart(empty).columns == [*schemas.SIGNAL_SCORES.names, "extra"]
