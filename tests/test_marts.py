from datetime import date, timedelta

import pytest

from quotidian import schemas
from quotidian.plans import marts

D1, D2 = date(2024, 6, 27), date(2024, 6, 28)


@pytest.fixture
def scores(spark):
    rows = [("A", D1, 0.5), ("A", D2, 1.0), ("B", D2, -1.0), ("C", D2, None), ("X", D2, 2.0), ("D", D2, 0.0)]
    return spark.createDataFrame(rows, "ticker string, date date, signal_score double")


@pytest.fixture
def positions(spark):
    rows = [("A", D1, "long", 0.5, 1), ("X", D2, "long", 2.0, 1), ("A", D2, "long", 1.0, 2),
            ("D", D2, "short", 0.0, 1), ("B", D2, "short", -1.0, 2)]
    return spark.createDataFrame(rows, schemas.POSITIONS)


def names(df, column="ticker"):
    return [r[column] for r in df.collect()]


def test_latest_scores_best_first_unscored_last(scores, universe):
    df = marts.latest_signal_scores(scores, universe)
    assert df.columns == ["ticker", "date", "signal_score", "company", "sector"]
    assert names(df) == ["X", "A", "D", "B", "C"]
    assert df.first()["sector"] is None


def test_scores_of_a_date_and_a_sector(scores, universe):
    assert names(marts.latest_signal_scores(scores, universe, D1)) == ["A"]
    assert names(marts.latest_signal_scores(scores, universe, sector="Tech")) == ["A", "B"]
    assert names(marts.latest_signal_scores(scores, universe, date(2020, 1, 1))) == []


def test_empty_marts_give_typed_empty_results(scores, positions, universe):
    assert names(marts.latest_signal_scores(scores.limit(0), universe)) == []
    assert names(marts.latest_positions(positions.limit(0), universe)) == []
    empty = marts.sector_exposure(positions.limit(0), universe)
    assert empty.columns == ["sector", "long_count", "short_count", "net_exposure"]
    assert empty.count() == 0
    assert marts.available_dates(scores.limit(0)).count() == 0


def test_positions_by_type_and_rank(positions, universe):
    df = marts.latest_positions(positions, universe)
    assert names(df) == ["X", "A", "D", "B"]
    assert names(marts.latest_positions(positions, universe, position_type="short")) == ["D", "B"]
    assert names(marts.latest_positions(positions, universe, D1, "short")) == []
    assert names(marts.positions_of(positions, D2)) == ["X", "A", "D", "B"]


def test_exposure_counts_known_sectors_with_both_sides(positions, universe):
    # X is unknown and D has no sector: both are left out.
    got = [tuple(r) for r in marts.sector_exposure(positions, universe).collect()]
    assert got == [("Tech", 1, 1, 0)]
    got = [tuple(r) for r in marts.sector_exposure(positions, universe, D1).collect()]
    assert got == [("Tech", 1, 0, 1)]
    chart = marts.exposure_series(marts.sector_exposure(positions, universe)).collect()
    assert [tuple(r) for r in chart] == [("Tech", 1, -1)]


def test_available_values(scores):
    assert names(marts.available_dates(scores), "date") == [D2, D1]
    assert names(marts.available_tickers(scores)) == ["A", "B", "C", "D", "X"]
    assert names(marts.available_tickers(scores, D1)) == ["A"]


def test_latest_score_date_of_a_ticker_else_of_all(scores):
    early = scores.where("not (ticker = 'A' and date = '2024-06-28')")
    assert marts.latest_score_date(early, "A").first()["date"] == D1
    assert marts.latest_score_date(early, "nobody").first()["date"] == D2
    assert marts.latest_score_date(early.limit(0), "A").first()["date"] is None


def test_overview_filters_the_book_after_the_cut(scores, positions, universe):
    got = marts.market_overview(scores, positions, universe, sector="Tech")
    assert [(r["ticker"], r["rank"]) for r in got["long"].collect()] == [("A", 2)]
    assert [(r["ticker"], r["rank"]) for r in got["short"].collect()] == [("B", 2)]
    assert got["exposure"].count() == 1


def test_overview_falls_back_to_scores_per_side(scores, positions, universe):
    longs_only = positions.where("position_type = 'long'")
    got = marts.market_overview(scores, longs_only, universe)
    assert [(r["ticker"], r["rank"]) for r in got["long"].collect()] == [("X", 1), ("A", 2)]
    # The tail of the order, so an unscored ticker can be last.
    assert [(r["ticker"], r["rank"]) for r in got["short"].collect()] == [
        ("X", 1), ("A", 2), ("D", 3), ("B", 4), ("C", 5)]


def test_fallback_filters_the_sector_before_the_cut(scores, universe):
    got = marts.candidates_from_scores(scores, universe, "short", sector="Tech", n=1)
    assert [(r["ticker"], r["rank"]) for r in got.collect()] == [("B", 1)]
    got = marts.candidates_from_scores(scores, universe, "long", sector="Tech", n=1)
    assert [(r["ticker"], r["rank"]) for r in got.collect()] == [("A", 1)]


def test_ticker_score(scores):
    assert tuple(marts.ticker_score(scores, "B").first())[2:] == (-1.0, "negative")
    assert marts.ticker_score(scores, "nobody").count() == 0


def features(spark, *rows):
    return spark.createDataFrame(rows, schemas.PRICE_FEATURES)


@pytest.mark.parametrize("vol, width", [(0.2, 0.2), (20.0, 0.2), (None, None)])
def test_bands(spark, prices, vol, width):
    df = prices({"close": 10.0}, {"date": D1, "close": 20.0}, {"ticker": "B"})
    got = marts.volatility_bands(df, features(spark, ("A", D2, vol, 1.0, 1.0)), "A").collect()
    assert [r["close"] for r in got] == [20.0, 10.0]
    if width is None:
        assert got[1]["upper_band"] is None
    else:
        assert got[1]["upper_band"] == pytest.approx(10 * (1 + width))
        assert got[1]["lower_band"] == pytest.approx(10 * (1 - width))


def test_bands_without_features_keep_the_history(spark, prices):
    got = marts.volatility_bands(prices({}), features(spark), "A").collect()
    assert [(r["close"], r["upper_band"]) for r in got] == [(10.0, None)]


def test_breakdown_lists_known_features_with_labels(spark):
    got = marts.feature_breakdown(features(spark, ("A", D2, 0.3, None, -1.5))).collect()
    assert {(r["feature_name"], r["value"]) for r in got} == {
        ("20-Day Realized Volatility", 0.3), ("5-Day Mean Reversion Z-Score", -1.5)}
    assert all(r["description"] for r in got)


@pytest.fixture
def long_history(prices):
    days = [D2 - timedelta(days=i) for i in range(80)]
    return prices(*[
        {"ticker": t, "date": d, "close": 10.0 + (d.toordinal() * 7) % 5} for t in "AB" for d in days
    ])


def test_features_of_a_ticker_on_its_latest_score_date(scores, long_history):
    early = scores.where("not (ticker = 'A' and date = '2024-06-28')")
    got = marts.features_of_ticker(long_history, early, "A").collect()
    assert [(r["ticker"], r["date"]) for r in got] == [("A", D1)]
    asked = marts.features_of_ticker(long_history, early, "A", D1).collect()
    assert got[0]["realized_vol_20d"] == pytest.approx(asked[0]["realized_vol_20d"])
    assert got[0]["momentum_60d"] == pytest.approx(asked[0]["momentum_60d"])
    assert marts.features_of_ticker(long_history, early, "nobody").count() == 0
    assert marts.features_of_ticker(long_history, early.limit(0), "A").count() == 0


@pytest.mark.parametrize("as_of", [None, D1])
def test_single_name(scores, long_history, as_of):
    got = marts.single_name(long_history, scores, "A", as_of)
    assert got["prices"].count() == 60
    assert got["prices"].where("upper_band > close and lower_band < close").count() == 60
    assert got["score"].first()["signal_score"] == (1.0 if as_of is None else 0.5)
    assert got["features"].count() == 3
