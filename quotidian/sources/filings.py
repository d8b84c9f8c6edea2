"""Downloaded filings and their manifests."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotidian import schemas
from quotidian.functions import scalar
from quotidian.operators.curation import prefer_filing_type
from quotidian.sources import listing
from quotidian.sources.lake import or_empty


def list_filings(spark: SparkSession, root: str) -> DataFrame:
    """One manifest row per file under ``root/<ticker>/<filing type>/…``, hidden and empty ones too.

    Tasks list the ticker folders and what is below them, and no file is opened.
    """
    listed = listing.list_below(spark, root)
    parts = F.split("below", "/")
    return listed.where(F.size(parts) > 1).select(
        F.element_at(F.split("folder", "/"), -1).alias("ticker"),
        parts[0].alias("filing_type"),
        F.col("modified").alias("download_time"),
        F.concat_ws("/", "folder", "below").alias("file_path"),
        F.lit(schemas.FILING_SOURCE).alias("source"),
    )


def build_manifest(
    spark: SparkSession,
    root: str,
    run_date: date,
    priority: Sequence[str] = schemas.FILING_PRIORITY,
) -> DataFrame:
    """The quarter's manifest with its partition columns; by default annual reports only where a
    ticker has no quarterly one. Typed and empty without files."""
    listed = list_filings(spark, root)
    return (
        prefer_filing_type(listed, priority)
        .withColumn("year", F.lit(run_date.year))
        .withColumn("quarter", F.lit(scalar.quarter_label_of(run_date)))
    )


#: Manifest rows with the file that they were read from.
MANIFEST_ROWS = T.StructType([*schemas.QUARTERLY_FUNDAMENTALS.fields, T.StructField("manifest_path", T.StringType())])


def read_manifests(
    spark: SparkSession, root: str, days: Sequence[date] = (), with_path: bool = False
) -> DataFrame:
    """Raw manifests (``year=/quarter=`` partitions), only of the days' quarters if any are given.

    A file called ``manifest.parquet`` is a summary of the others and is left out, as are files that cannot
    be read. Empty if nothing was written.
    """
    reader = spark.read.schema(schemas.QUARTERLY_FUNDAMENTALS).option("ignoreCorruptFiles", True)
    summary = F.col("_metadata.file_name") == "manifest.parquet"
    rows = or_empty(
        spark, lambda: reader.parquet(root).where(~summary).select(
            *schemas.QUARTERLY_FUNDAMENTALS.names, F.col("_metadata.file_path").alias("manifest_path")),
        MANIFEST_ROWS,
    )
    if not with_path:
        rows = rows.drop("manifest_path")
    quarters = quarters_of(days)
    if not quarters:
        return rows
    wanted = [(F.col("year") == y) & (F.col("quarter") == q) for y, q in quarters]
    return rows.where(reduce(operator.or_, wanted))


def quarters_of(days: Sequence[date]) -> list[tuple[int, str]]:
    return sorted({(d.year, scalar.quarter_label_of(d)) for d in days})
