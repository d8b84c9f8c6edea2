"""The universe file: ticker, company, sector, cik."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotidian import schemas


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """The file's columns by their names in its header, in any order and case, as text, so that leading
    zeros stay; absent ones are NULL."""
    rows = spark.read.option("header", True).csv(path)
    names = {c.strip().lower(): c for c in reversed(rows.columns)}
    return rows.select(*[
        (F.col(f"`{names[f.name]}`") if f.name in names else F.lit(None)).cast("string").alias(f.name)
        for f in schemas.UNIVERSE
    ])


def tickers(universe: DataFrame) -> DataFrame:
    return universe.select("ticker").dropna().distinct()


def with_sectors(universe: DataFrame) -> DataFrame:
    """The dimension used for enrichment."""
    return universe.select("ticker", "company", "sector")


def enrich(df: DataFrame, universe: DataFrame) -> DataFrame:
    """Adds company and sector; unknown tickers keep NULL.

    No broadcast is forced, as a universe can be large: Spark broadcasts it when its size on disk,
    or its measured size at run time, is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return df.join(with_sectors(universe), "ticker", "left")


def sectors(universe: DataFrame) -> DataFrame:
    """Distinct known sectors in ascending order."""
    return universe.select("sector").dropna().distinct().orderBy("sector")
