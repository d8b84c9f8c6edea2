"""The daily ingest and curation as a file stream over the landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotidian.operators.curation import curate_all_dates
from quotidian.plans.daily import INGEST_ORDER, append_raw_prices, staged
from quotidian.sources import lake as lake_io
from quotidian.sources import prices
from quotidian.sources.lake import Lake


def curate_batch(spark: SparkSession, lake: Lake, batch: DataFrame, number: int = 0) -> None:
    """Adds a batch of landed rows to the raw layer and curates the dates it touches again, from all their
    raw rows. Rows without a readable date are kept apart, in a folder of the batch's number.

    A repeated batch adds nothing to the raw layer and replaces its own rejected rows: the result is the same.
    """
    with staged(batch, lake, "batch") as rows:
        bad = prices.rejected(rows).withColumnRenamed("date", "date_text")
        if not bad.isEmpty():
            bad.write.mode("overwrite").parquet(f"{lake.rejected_stream}/batch={number}")
        touched = append_raw_prices(prices.normalise_landed(rows), lake)
    if touched:
        raw = prices.read_raw(spark, lake.raw_prices).where(F.col("date").isin(touched))
        lake_io.overwrite_partitions(curate_all_dates(raw, INGEST_ORDER), lake.daily_prices, days=touched)


def start(spark: SparkSession, lake: Lake, landing: str, checkpoint: str) -> StreamingQuery:
    """Processes all files that are new since the last run, then stops. Late rows of an old date
    simply touch that date again."""
    rows = prices.by_own_header(prices.landed_files(spark.readStream, landing))
    return (
        rows.writeStream.foreachBatch(lambda batch, number: curate_batch(spark, lake, batch, number))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
