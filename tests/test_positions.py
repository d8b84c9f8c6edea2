from datetime import date

import pytest

from quotidian.operators.positions import generate_positions

DAY = date(2024, 6, 28)


def signals(spark, scores: dict, day=DAY):
    return spark.createDataFrame(
        [(t, day, s) for t, s in scores.items()], "ticker string, date date, signal_score double")


def book(df, side):
    rows = [r for r in df.collect() if r["position_type"] == side]
    return [(r["rank"], r["ticker"]) for r in sorted(rows, key=lambda r: r["rank"])]


@pytest.mark.parametrize("tickers, rows, both_sides", [(25, 20, 0), (12, 20, 8), (3, 6, 3)])
def test_sides_overlap_only_when_there_are_too_few(spark, tickers, rows, both_sides):
    df = generate_positions(signals(spark, {f"T{i:02d}": float(i) for i in range(tickers)}))
    assert df.count() == rows
    assert len({t for _, t in book(df, "long")} & {t for _, t in book(df, "short")}) == both_sides


def test_ranks(spark):
    df = generate_positions(signals(spark, {"A": 3.0, "B": 2.0, "C": 1.0, "D": 0.0}), n_longs=2, n_shorts=2)
    assert book(df, "long") == [(1, "A"), (2, "B")]
    # The best of the shorts comes first.
    assert book(df, "short") == [(1, "C"), (2, "D")]


def test_ties_go_by_ticker(spark):
    df = generate_positions(signals(spark, dict.fromkeys("DCBA", 1.0)), n_longs=2, n_shorts=2)
    assert book(df, "long") == [(1, "A"), (2, "B")]
    assert book(df, "short") == [(1, "C"), (2, "D")]


def test_unscored_tickers_stay_out(spark):
    df = generate_positions(signals(spark, {"A": None, "B": 1.0}))
    assert {r["ticker"] for r in df.collect()} == {"B"}


def test_each_date_has_its_book_and_as_of_selects_one(spark):
    other = date(2024, 6, 27)
    both = signals(spark, {"A": 1.0, "B": 2.0}).union(signals(spark, {"A": 5.0, "B": 1.0}, other))
    df = generate_positions(both, n_longs=1, n_shorts=1)
    longs = {r["date"]: r["ticker"] for r in df.collect() if r["position_type"] == "long"}
    assert longs == {DAY: "B", other: "A"}
    assert {r["date"] for r in generate_positions(both, other).collect()} == {other}


def test_empty_signals(spark):
    df = generate_positions(signals(spark, {"A": None}))
    assert df.columns == ["ticker", "date", "position_type", "signal_score", "rank"]
    assert df.count() == 0


@pytest.mark.parametrize("absent", ["date", "signal_score"])
def test_missing_columns_give_an_empty_book(spark, absent):
    df = generate_positions(signals(spark, {"A": 1.0}).drop(absent))
    assert df.columns == ["ticker", "date", "position_type", "signal_score", "rank"]
    assert df.count() == 0


def test_other_signal_column(spark):
    df = signals(spark, {"A": 1.0}).withColumnRenamed("signal_score", "alpha")
    assert generate_positions(df, signal_col="alpha").columns[3] == "alpha"
