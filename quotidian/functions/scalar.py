"""Scalar column expressions: coercion, dates, paths."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_run_date(text: str | None = None) -> date:
    """A ``YYYY-MM-DD`` run date; today when none is given."""
    return datetime.strptime(text, "%Y-%m-%d").date() if text else date.today()


def finite(number: Column | str) -> Column:
    """The number, NULL where it is infinite or no number."""
    column = as_column(number)
    return F.when(F.abs(column) < float("inf"), column)


def parse_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles, NULL where a text is no decimal number; all others as they are.

    Spark's cast takes more than decimal numbers: Java's type suffixes (``1d``, ``2.5f``),
    hexadecimal floats, and exponents too large for a double, which become infinite. Those are NULL
    here, as is whatever is infinite or ``nan`` in the first place: a price that is no finite number
    would spoil every mean it enters.

    Casting a text that is no number costs far more than casting one that is. Texts that cannot be
    numbers by their last character are not cast; the casts are columns of their own before they
    are judged, so that each is done once.
    """
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    endings = df.select(
        *df.columns,
        *[F.substring(F.rtrim(c, F.lit(" \t\r\n\f")), -1, 1).alias(f"__{c}_last") for c in texts],
    )
    cast = endings.select(
        "*",
        *[
            F.when(F.col(f"__{c}_last").isin(*"0123456789."), F.col(c))
            .try_cast("double")
            .alias(f"__{c}_number")
            for c in texts
        ],
    )

    def number(c: str) -> Column:
        if c not in texts:
            return finite(F.col(c).cast("double"))
        value, last = F.col(f"__{c}_number"), F.col(f"__{c}_last")
        hexadecimal = F.contains(c, F.lit("x")) | F.contains(c, F.lit("X"))
        return F.when(~last.isin("f", "F") & ~hexadecimal, finite(value))

    return cast.select(*[number(c).alias(c) if c in columns else c for c in df.columns])


def whole_number(number: Column) -> Column:
    """Nullable bigint of a double, ties rounded to the even neighbour."""
    return F.rint(number).try_cast("bigint")


#: Further ways of writing a date, month before day where both are numbers; tried in this order.
DATE_FORMATS = (
    "yyyyMMdd", "M/d/yyyy", "yyyy/M/d", "M-d-yyyy", "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy", "MMMM d, yyyy",
    "d MMMM yyyy", "yyyy.M.d",
)


def to_day(value: Column | str) -> Column:
    """Calendar date of a date, timestamp or text; NULL where it is none."""
    return as_column(value).try_cast("date")


def parse_day(text: Column | str) -> Column:
    """``to_day`` for text that may also be written in one of DATE_FORMATS, with a time behind it."""
    column = F.trim(as_column(text).cast("string"))
    day = F.regexp_replace(column, r"[T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?[AaPp][Mm])?Z?$", "")
    eight_digits = F.try_to_date(F.when(day.rlike(r"^\d{8}$"), day), "yyyyMMdd")
    return F.coalesce(eight_digits, F.when(~day.rlike(r"^\d+$"), F.coalesce(
        to_day(column), *[F.try_to_date(day, form) for form in DATE_FORMATS[1:]])))


def quarter_label(value: Column | str) -> Column:
    """``Q1`` to ``Q4``."""
    return F.concat(F.lit("Q"), F.quarter(as_column(value)).cast("string"))


def quarter_label_of(day: date) -> str:
    """``quarter_label`` for a date on the driver."""
    return f"Q{(day.month + 2) // 3}"


def quarter_index(value: Column | str) -> Column:
    """Quarters since year 0, so that neighbouring quarters differ by one."""
    column = as_column(value)
    return F.year(column) * 4 + F.quarter(column) - 1


def day_path(value: Column | str) -> Column:
    """``YYYY/MM/DD``."""
    return F.date_format(as_column(value), "yyyy/MM/dd")


def day_from_path(path: Column | str) -> Column:
    """The date a data file's path stands for; NULL where it has none.

    Understands ``…/date=2024-01-31/part.parquet``, ``…/2024/01/31/part.parquet`` and
    ``…/2024-01-31.parquet``.
    """
    column = as_column(path)
    hive = F.regexp_extract(column, r"date=([^/]+)/[^/]+$", 1)
    folders = F.regexp_extract(column, r"/([^/]+/[^/]+/[^/]+)/[^/]+$", 1)
    stem = F.regexp_extract(column, r"([^/]+)\.[^./]+$", 1)
    return F.coalesce(
        F.try_to_date(hive, "yyyy-MM-dd"),
        F.try_to_date(stem, "yyyy-MM-dd"),
        F.try_to_date(folders, "yyyy/MM/dd"),
    )


def anchor_dates(start: Column, end: Column, step_days: int) -> Column:
    """Dates from the later bound backwards in steps of ``step_days``; bounds in either order."""
    first, last = F.least(start, end), F.greatest(start, end)
    steps = F.sequence(F.lit(0), F.floor(F.date_diff(last, first) / step_days).cast("int"))
    return F.transform(steps, lambda i: F.date_sub(last, i * step_days))


def signal_class(score: Column | str) -> Column:
    """``positive`` above zero, else ``negative``; NULL without a score."""
    column = as_column(score)
    return F.when(column > 0, "positive").when(column.isNotNull(), "negative")


def band_width(volatility: Column | str) -> Column:
    """Volatility as a fraction: values of 1 and more are taken as percentages."""
    column = as_column(volatility)
    return F.when(column < 1, column).otherwise(column / 100)
