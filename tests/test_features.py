import math
import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quotidian.operators.features import price_features_as_of, price_features_panel, ticker_features
from quotidian.schemas import PRICE_FEATURE_COLUMNS as FEATURES

END = date(2024, 6, 28)


def wave(n, base=100.0):
    return [base + (i * 7) % 11 + i * 0.1 for i in range(n)]


@pytest.mark.parametrize("rows, present, with_momentum", [
    (59, False, False), (60, True, False), (61, True, True),
])
def test_history_gate(bars, rows, present, with_momentum):
    got = price_features_as_of(bars({"A": wave(rows)}), END).collect()
    assert len(got) == present
    if present:
        assert got[0]["realized_vol_20d"] is not None
        assert got[0]["mean_reversion_zscore_5d"] is not None
        assert (got[0]["momentum_60d"] is not None) == with_momentum


def test_stale_ticker_is_carried_forward(bars):
    got = price_features_as_of(bars({"A": wave(70)}, END - timedelta(days=5)), END).collect()
    assert [(r["ticker"], r["date"]) for r in got] == [("A", END)]


def test_lookback_holds_both_ends(bars, spark):
    recent = bars({"A": wave(59), "B": wave(59)})
    edge = spark.createDataFrame(
        [("A", END - timedelta(days=100), 90.0), ("B", END - timedelta(days=101), 90.0)],
        recent.schema,
    )
    got = price_features_as_of(recent.union(edge), END).collect()
    assert [r["ticker"] for r in got] == ["A"]


def test_later_bars_are_not_used(bars):
    closes = wave(80)
    early = price_features_as_of(bars({"A": closes[:70]}, END), END).collect()
    late = price_features_as_of(bars({"A": closes}, END + timedelta(days=10)), END).collect()
    assert early == late


def test_no_rows_give_a_typed_empty_result(bars):
    got = price_features_as_of(bars({"A": wave(70)}, date(2020, 1, 1)), END)
    assert got.count() == 0
    assert got.columns == ["ticker", "date", *FEATURES]


def test_shared_changes_nothing_but_the_plan(bars):
    df = bars({"A": wave(70), "B": wave(65, 50.0)})
    plain = sorted(price_features_as_of(df, END).collect())
    assert sorted(price_features_as_of(df, END, shared=True).collect()) == plain


def test_ticker_features_selects_one(bars):
    df = price_features_as_of(bars({"A": wave(70), "B": wave(70)}), END)
    assert [r["ticker"] for r in ticker_features(df, "B").collect()] == ["B"]


# --- brute force on gappy data ----------------------------------------------------------------

def by_hand(rows, as_of, lookback, min_rows):
    """One ticker's features by the plain definition, from its (date, close) list."""
    history = [(d, c) for d, c in rows if as_of - timedelta(days=lookback) <= d <= as_of]
    if len(history) < min_rows:
        return None
    closes = [c for _, c in history]
    filled, last = [], None
    for c in closes:
        last = c if c is not None else last
        filled.append(last)

    def change(i, n):
        if i - n < 0 or filled[i] is None or not filled[i - n]:
            return None
        return filled[i] / filled[i - n] - 1

    end = len(closes) - 1
    returns = [change(i, 1) for i in range(max(end - 19, 0), end + 1)]
    full = len(returns) == 20 and None not in returns
    vol = statistics.stdev(returns) * math.sqrt(252) if full else None
    frame = closes[-5:]
    rev = None
    if len(frame) == 5 and None not in frame and len(set(frame)) > 1:
        rev = (frame[-1] - statistics.fmean(frame)) / statistics.stdev(frame)
    return vol, change(end, 60), rev


@pytest.fixture(scope="module")
def gappy():
    """Tickers with missing days, missing closes, zero closes, long breaks."""
    rng = random.Random(11)
    series = {}
    for k in range(12):
        day, rows = date(2023, 1, 1), []
        skip, gap = rng.choice([0.0, 0.1, 0.3]), rng.choice([0.0, 0.05, 0.4])
        for i in range(320):
            day += timedelta(days=1)
            if k % 4 == 3 and 150 < i < 230:
                continue
            if rng.random() < skip:
                continue
            close = round(rng.uniform(5, 50), 2)
            if rng.random() < gap:
                close = None
            elif rng.random() < 0.01:
                close = 0.0
            rows.append((day, close))
        series[f"T{k:02d}"] = rows
    # Closes unknown for long: the last known price is older than the lookback.
    series["T00"] = [(d, c if i < 40 or i > 200 else None) for i, (d, c) in enumerate(series["T00"])]
    return series


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("lookback, min_rows", [(100, 60), (40, 10), (100, 1), (15, 3)])
def test_panel_equals_every_single_date_by_hand(spark, gappy, lookback, min_rows):
    rows = [(t, d, c) for t, series in gappy.items() for d, c in series]
    df = spark.createDataFrame(rows, "ticker string, date date, close double")
    panel = price_features_panel(df, df.select("date").distinct(), lookback, min_rows)
    got = {(r["ticker"], r["date"]): tuple(r[f] for f in FEATURES) for r in panel.collect()}

    days = sorted({d for series in gappy.values() for d, _ in series})
    expected = {}
    for ticker, series in gappy.items():
        for day in days:
            features = by_hand(series, day, lookback, min_rows)
            if features is not None:
                expected[(ticker, day)] = features
    assert got.keys() == expected.keys()
    wrong = {
        k: (got[k], expected[k])
        for k in got
        if not all(same(a, b) for a, b in zip(got[k], expected[k]))
    }
    assert not wrong


def test_single_date_equals_panel(spark, gappy):
    rows = [(t, d, c) for t, series in gappy.items() for d, c in series]
    df = spark.createDataFrame(rows, "ticker string, date date, close double")
    days = [date(2023, 5, 5), date(2023, 9, 30), date(2023, 11, 10)]
    wanted = spark.createDataFrame([(d,) for d in days], "date date")
    panel = price_features_panel(df, wanted, first=min(days), last=max(days), shared=True)
    single = price_features_as_of(df, days[0])
    for day in days[1:]:
        single = single.union(price_features_as_of(df, day))

    def table(frame):
        rounded = [F.round(f, 9).alias(f) for f in FEATURES]
        return sorted(frame.select("ticker", "date", *rounded).collect(), key=str)

    assert table(panel) == table(single)
