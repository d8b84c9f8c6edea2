"""Several tables' dates published as one unit.

A run stages the partitions of all its tables beside the lake's, empty ones too. Once all are there a
marker is put up, one small file, which is the moment of publication: from then on the run can only be
carried on, never undone. The staged folders take the places of the old ones, and the marker goes.

A run that fails before its marker leaves nothing behind. One that fails after it leaves the marker and
what is not moved yet; the next run, or ``recover``, moves the rest. Until then the marker's dates count as
not done, and ``published`` readers leave them out, so nobody sees scores of one run with another one's book.
One run works on a lake at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotidian import schemas
from quotidian.sources import files, lake as lake_io
from quotidian.sources.lake import Lake

#: Folders that are moved at once.
MOVERS = 16


class Publication:
    """The staged tables of a run, by their paths below the lake's root."""

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark, self.lake = spark, lake
        self.run = uuid.uuid4().hex
        self.root = f"{lake.root}/_staging/{self.run}"
        self.tables: dict[str, list[str]] = {}

    def stage(self, rows: DataFrame, path: str, days: Sequence[date], sort_by: Sequence[str] = ("ticker",)) -> DataFrame:
        """Stages the days' partitions of a table, and an empty one for each day that has no rows; returns
        what is staged, for tables made from it."""
        table = path.removeprefix(f"{self.lake.root}/")
        staged = f"{self.root}/{table}"
        with lake_io.many_small_files(self.spark):
            (
                rows.hint("rebalance", F.col("date")).sortWithinPartitions("date", *sort_by)
                .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date").parquet(staged)
            )
        names = [d.isoformat() for d in days]
        self.tables[table] = names
        there = {files.name_of(p) for p in files.matching(self.spark, staged, "date=*")}
        empty = [n for n in names if f"date={n}" not in there]
        if empty:
            typed = f"{staged}/date={empty[0]}"
            self.spark.createDataFrame([], rows.drop("date").schema).write.parquet(typed)
            _each(lambda n: files.copy(self.spark, typed, f"{staged}/date={n}"), empty[1:])
        return self.spark.read.schema(rows.schema).parquet(staged).select(*rows.columns)

    def commit(self) -> None:
        """The marker, then the moves."""
        text = json.dumps({"run": self.run, "tables": self.tables})
        files.write_text(self.spark, f"{self.lake.publishing}/{self.run}.json", text)
        carry_on(self.spark, self.lake, self.run, self.tables)


def _each(work, things: Iterable) -> None:
    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(work, things))


def markers(spark: SparkSession, lake: Lake) -> dict[str, dict[str, list[str]]]:
    """Runs whose publication has not ended: their tables and dates."""
    found = files.matching(spark, lake.publishing, "*.json")
    texts = [r["value"] for p in found for r in spark.read.text(p, wholetext=True).collect()]
    return {m["run"]: m["tables"] for m in map(json.loads, texts)}


def carry_on(spark: SparkSession, lake: Lake, run: str, tables: dict[str, list[str]]) -> None:
    """Moves what is staged and not moved yet, and takes the marker down. Any number of attempts do as one."""
    root = f"{lake.root}/_staging/{run}"

    def move(what: tuple[str, str]) -> None:
        table, day = what
        staged, target = f"{root}/{table}/date={day}", f"{lake.root}/{table}/date={day}"
        if files.exists(spark, staged):
            files.delete(spark, target)
            files.move(spark, staged, target)

    _each(move, [(table, day) for table, days in tables.items() for day in days])
    for table, days in tables.items():
        lake_io.note_days(spark, f"{lake.root}/{table}", [date.fromisoformat(d) for d in days])
    files.delete(spark, f"{lake.publishing}/{run}.json")
    files.delete(spark, root)


def recover(spark: SparkSession, lake: Lake) -> list[str]:
    """Carries on every publication that has not ended; returns their runs."""
    found = markers(spark, lake)
    for run, tables in found.items():
        carry_on(spark, lake, run, tables)
    return sorted(found)


def unfinished_days(spark: SparkSession, lake: Lake) -> set[date]:
    return {date.fromisoformat(d) for tables in markers(spark, lake).values() for days in tables.values() for d in days}


@contextmanager
def publication(spark: SparkSession, lake: Lake) -> Iterator[Publication]:
    """Stage inside the block; at its end all of it is published, or none where the block has failed."""
    recover(spark, lake)
    unit = Publication(spark, lake)
    try:
        yield unit
    except BaseException:
        files.delete(spark, unit.root)
        raise
    unit.commit()


def _of_ended(rows: DataFrame, lake: Lake) -> DataFrame:
    days = unfinished_days(rows.sparkSession, lake)
    return rows.where(~F.col("date").isin(sorted(days))) if days else rows


def published_scores(spark: SparkSession, lake: Lake) -> DataFrame:
    """The scores, without dates of a publication that has not ended."""
    return _of_ended(lake_io.read_scores(spark, lake.signal_scores), lake)


def published_positions(spark: SparkSession, lake: Lake) -> DataFrame:
    return _of_ended(lake_io.read_table(spark, lake.positions, schemas.POSITIONS), lake)
