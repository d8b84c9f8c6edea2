from datetime import date

import pytest

from quotidian.operators.quality import ValidationError, quality_report, validate_daily_prices

D1, D2 = date(2024, 6, 27), date(2024, 6, 28)


def counts(df):
    return {r["check"]: (r["bad_rows"], r["failed"]) for r in quality_report(df).collect()}


def test_clean_prices_pass(prices):
    df = prices({}, {"ticker": "B"}, {"date": D1})
    result = validate_daily_prices(df)
    assert result == {
        "valid": True, "errors": [], "warnings": [], "stats": {"total_rows": 3, "unique_tickers": 2}}


@pytest.mark.parametrize("row, check, severity", [
    ({"high": 8.0, "low": 9.0, "close": 8.5}, "high_below_low", "error"),
    ({"close": 12.0}, "close_outside_range", "error"),
    ({"close": 8.0}, "close_outside_range", "error"),
    ({"volume": -1}, "negative_volume", "error"),
    ({"close": 20000.0, "high": 20000.0}, "extreme_close", "warning"),
    ({"close": 0.001, "low": 0.001}, "extreme_close", "warning"),
])
def test_one_bad_row(prices, row, check, severity):
    df = prices({"ticker": "B"}, row)
    assert counts(df)[check] == (1, True)
    result = validate_daily_prices(df, fail_on_error=False)
    assert result["valid"] == (severity == "warning")


def test_all_members_of_a_duplicate_count(prices):
    assert counts(prices({}, {}, {"ticker": "B"}))["duplicate_ticker_date"] == (2, True)


def test_overnight_jump(prices):
    calm = prices({"date": D1, "close": 10.0}, {"date": D2, "close": 15.0, "high": 15.0})
    jump = prices({"date": D1, "close": 10.0}, {"date": D2, "close": 16.0, "high": 16.0})
    fall = prices({"date": D1, "close": 10.0}, {"date": D2, "close": 4.0, "low": 4.0})
    assert counts(calm)["overnight_change"] == (0, False)
    assert counts(jump)["overnight_change"] == (1, True)
    assert counts(fall)["overnight_change"] == (1, True)
    assert validate_daily_prices(jump)["valid"]


def test_positivity_allows_one_percent(prices):
    def with_bad(n):
        return prices(*[{"ticker": f"T{i}", "open": 0.0 if i < n else 10.0} for i in range(200)])

    assert counts(with_bad(2))["open_not_positive"] == (2, False)
    assert counts(with_bad(3))["open_not_positive"] == (3, True)


def test_nulls_are_no_findings(prices):
    df = prices({"open": None, "high": None, "low": None, "close": None, "volume": None})
    assert all(not failed for _, failed in counts(df).values())


def test_null_high_does_not_hide_a_close_below_low(prices):
    assert counts(prices({"high": None, "close": 1.0}))["close_outside_range"] == (1, True)


def test_first_error_in_order_is_raised(prices):
    df = prices({"volume": -1}, {"ticker": "B", "high": 8.0, "low": 9.0, "close": 8.5})
    with pytest.raises(ValidationError, match="high < low"):
        validate_daily_prices(df)


def test_missing_columns(prices):
    df = prices({}).drop("close")
    with pytest.raises(ValidationError, match="close"):
        validate_daily_prices(df)
    result = validate_daily_prices(df, fail_on_error=False)
    assert not result["valid"] and len(result["errors"]) == 1
    assert result["stats"] == {"total_rows": 1, "unique_tickers": 1}
    assert validate_daily_prices(df.limit(0))["valid"]
    assert validate_daily_prices(df.drop("ticker"), fail_on_error=False)["stats"]["unique_tickers"] == 0


def test_empty_input_is_valid_with_a_warning(prices):
    result = validate_daily_prices(prices({}).limit(0))
    assert result["valid"] and result["warnings"] == ["Empty DataFrame"]
