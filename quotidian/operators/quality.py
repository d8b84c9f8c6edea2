"""Checks on curated prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotidian import schemas
from quotidian.functions import rolling

REQUIRED = ("date", "ticker", "open", "high", "low", "close", "volume")
PRICE_COLUMNS = ("open", "high", "low", "close")

# Checks in the order in which the first failing error is raised.
SEVERITY = {
    "open_not_positive": "warning",
    "high_not_positive": "warning",
    "low_not_positive": "warning",
    "close_not_positive": "warning",
    "high_below_low": "error",
    "close_outside_range": "error",
    "duplicate_ticker_date": "error",
    "negative_volume": "error",
    "extreme_close": "warning",
    "overnight_change": "warning",
}

# The report's texts.
MESSAGES = {
    "high_below_low": "Found {n} rows where high < low",
    "close_outside_range": "Found {n} rows where close is outside [low, high] range",
    "duplicate_ticker_date": "Found {n} duplicate ticker+date combinations",
    "negative_volume": "Found {n} rows with negative volume",
    "extreme_close": "Found {n} rows with extreme close prices (outside [0.01, 10000])",
    "overnight_change": "Found {n} ticker dates with an overnight change above 50%",
}


class ValidationError(ValueError):
    """Raised for the first failed error check when asked for."""


def row_conditions() -> dict[str, Column]:
    c = F.col
    return {
        "high_below_low": c("high") < c("low"),
        "close_outside_range": (c("close") > c("high")) | (c("close") < c("low")),
        "negative_volume": c("volume") < 0,
        "extreme_close": (c("close") > schemas.MAX_PRICE) | (c("close") < schemas.MIN_PRICE),
    }


def check_counts(prices: DataFrame, wanted: Column | None = None) -> DataFrame:
    """One row with all counts, from one scan. With ``wanted``, a condition on the date, only rows that meet
    it count; the others are there as their neighbours, for what changes overnight.

    Rows are first reduced to one per (ticker, date), where copies of a key meet and the counts that
    look at single rows are added up. A change overnight is judged between the extremes of
    neighbouring dates, which for one row per date is the plain change and for copies does not
    depend on their order.
    """
    single = {
        **{name: F.count_if(condition) for name, condition in row_conditions().items()},
        **{f"{c}_small": F.count_if(F.col(c) < schemas.MIN_PRICE) for c in PRICE_COLUMNS},
        **{f"{c}_known": F.count(c) for c in PRICE_COLUMNS},
    }
    per_bar = prices.groupBy("ticker", "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("close").alias("lowest"),
        F.max("close").alias("highest"),
        *[count.alias(name) for name, count in single.items()],
    )
    window = rolling.by_ticker()
    rise = F.try_divide(F.col("highest"), F.lag("lowest", 1).over(window)) - 1
    fall = 1 - F.try_divide(F.col("lowest"), F.lag("highest", 1).over(window))
    limit = schemas.MAX_OVERNIGHT_CHANGE
    counted = F.lit(True) if wanted is None else wanted
    per_ticker = (
        per_bar.withColumn("rise", rise)
        .withColumn("fall", fall)
        .withColumn("counted", F.coalesce(counted, F.lit(False)))
        .groupBy("ticker")
        .agg(
            F.sum(F.when(F.col("counted"), F.col("n"))).alias("total_rows"),
            F.sum(F.when(F.col("counted") & (F.col("n") > 1), F.col("n"))).alias("duplicate_ticker_date"),
            F.count_if(F.col("counted") & ((F.col("rise") > limit) | (F.col("fall") > limit))).alias("overnight_change"),
            *[F.sum(F.when(F.col("counted"), F.col(name))).alias(name) for name in single],
        )
    )
    return per_ticker.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("total_rows", "duplicate_ticker_date", "overnight_change", *single)
        ],
        F.count(F.when(F.col("total_rows") > 0, F.col("ticker"))).alias("unique_tickers"),
    )


def quality_report(prices: DataFrame, wanted: Column | None = None) -> DataFrame:
    """(check, severity, bad_rows, failed, total_rows, unique_tickers), one row per check, of the rows whose
    date is wanted, or of all.

    A positivity check fails when under 99% of the known prices reach one cent; any other check
    fails with its first bad row.
    """
    counts = check_counts(_with_required(prices), wanted)
    rows = []
    for name, severity in SEVERITY.items():
        if name.endswith("_not_positive"):
            price = name.removesuffix("_not_positive")
            bad = F.col(f"{price}_small")
            good = F.col(f"{price}_known") - bad
            share = F.try_divide(good, F.col(f"{price}_known"))
            failed = F.coalesce(share < schemas.MIN_POSITIVE_SHARE, F.lit(False))
        else:
            bad = F.col(name)
            failed = bad > 0
        rows.append(
            F.struct(
                F.lit(name).alias("check"),
                F.lit(severity).alias("severity"),
                bad.alias("bad_rows"),
                failed.alias("failed"),
            )
        )
    return counts.select(F.explode(F.array(*rows)).alias("c"), "total_rows", "unique_tickers").select(
        "c.check", "c.severity", "c.bad_rows", "c.failed", "total_rows", "unique_tickers"
    )


def _with_required(prices: DataFrame) -> DataFrame:
    missing = [c for c in REQUIRED if c not in prices.columns]
    if missing:
        raise ValidationError(f"Missing required columns: {missing}")
    return prices


def validate_daily_prices(
    prices: DataFrame, fail_on_error: bool = True, wanted: Column | None = None
) -> dict:
    """The report as a dictionary: valid, errors, warnings, stats; of the rows whose date is wanted, or of all.

    Runs one job and brings back one row per check. With ``fail_on_error`` the first failed error
    check raises.
    """
    try:
        _with_required(prices)
    except ValidationError as exc:
        tickers = F.count_distinct("ticker") if "ticker" in prices.columns else F.lit(0)
        total, unique = prices.agg(F.count(F.lit(1)), tickers).first()
        stats = {"total_rows": total, "unique_tickers": unique}
        if total == 0:
            return {"valid": True, "errors": [], "warnings": ["Empty DataFrame"], "stats": stats}
        if fail_on_error:
            raise
        return {"valid": False, "errors": [str(exc)], "warnings": [], "stats": stats}

    report = quality_report(prices, wanted).collect()
    stats = {
        "total_rows": report[0]["total_rows"],
        "unique_tickers": report[0]["unique_tickers"],
    }
    if stats["total_rows"] == 0:
        return {"valid": True, "errors": [], "warnings": ["Empty DataFrame"], "stats": stats}

    found = {"error": [], "warning": []}
    for row in report:
        if not row["failed"]:
            continue
        template = MESSAGES.get(row["check"], "Check {check} failed for {n} rows")
        message = template.format(n=row["bad_rows"], check=row["check"])
        if row["severity"] == "error" and fail_on_error:
            raise ValidationError(message)
        found[row["severity"]].append(message)
    return {
        "valid": not found["error"],
        "errors": found["error"],
        "warnings": found["warning"],
        "stats": stats,
    }
