"""Catalog tables: loading, listing, describing, ad-hoc SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotidian import schemas
from quotidian.sources import lake as lake_io
from quotidian.sources.lake import Lake

MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def load_parquet_to_table(
    spark: SparkSession,
    path: str,
    table: str,
    schema: str = "curated",
    if_exists: str = "replace",
) -> int:
    """Loads Parquet into ``schema.table`` and returns the table's row count.

    ``replace`` swaps the table, ``append`` adds to it, ``fail`` refuses an existing one.
    """
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {sorted(MODES)}, not {if_exists!r}")
    rows = spark.read.parquet(path)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(schema)}")
    name = f"{quoted(schema)}.{quoted(table)}"
    if if_exists == "append" and spark.catalog.tableExists(f"{schema}.{table}"):
        rows = rows.select(*spark.table(name).columns)
    rows.write.mode(MODES[if_exists]).saveAsTable(name)
    return spark.table(name).count()


def quoted(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


def count_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of the given tables, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def list_tables(spark: SparkSession, schema: str = "curated") -> DataFrame:
    """(table_name, row_count) of a schema, by name; typed and empty for an unknown schema."""
    names = (
        sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)
        if spark.catalog.databaseExists(schema)
        else []
    )
    if not names:
        return spark.createDataFrame(
            [],
            T.StructType([
                T.StructField("table_name", T.StringType()),
                T.StructField("row_count", T.LongType()),
            ]),
        )
    tables = {n: spark.table(f"{quoted(schema)}.{quoted(n)}") for n in names}
    return count_rows(tables).orderBy("table_name")


def describe(df: DataFrame, limit: int = 10) -> dict:
    """Row count, (column, type) pairs, and a sample of at most ``limit`` rows as a DataFrame."""
    return {
        "row_count": df.count(),
        "columns": [(f.name, f.dataType.simpleString()) for f in df.schema],
        "sample": df.limit(limit),
    }


def show_table_info(
    spark: SparkSession, table: str, schema: str = "curated", limit: int = 10
) -> dict | None:
    """``describe`` for a catalog table; None for an unknown one."""
    if not table_exists(spark, table, schema):
        return None
    return describe(spark.table(f"{quoted(schema)}.{quoted(table)}"), limit)


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_query(spark: SparkSession, text: str, **parameters) -> DataFrame:
    """Ad-hoc SQL; ``:name`` markers are bound to the given values, never spliced into the text."""
    return spark.sql(text, args=parameters or None)


def table_exists(spark: SparkSession, table: str, schema: str | None = None) -> bool:
    return spark.catalog.tableExists(f"{schema}.{table}" if schema else table)


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def table_or_empty(
    spark: SparkSession, table: str, schema: T.StructType, database: str | None = None
) -> DataFrame:
    """The table, or its typed empty form where it does not exist."""
    if table_exists(spark, table, database):
        return spark.table(f"{database}.{table}" if database else table)
    return spark.createDataFrame([], schema)


def lake_tables(lake: Lake) -> dict[tuple[str, str], tuple[str, T.StructType, tuple[str, ...]]]:
    """(schema, table) to (location, columns, partition columns) of everything a lake stores."""
    return {
        ("raw", "prices"): (lake.raw_prices, schemas.RAW_PRICES, ("date",)),
        ("raw", "filings"): (lake.raw_filings, schemas.QUARTERLY_FUNDAMENTALS, ("year", "quarter")),
        ("curated", "daily_prices"): (lake.daily_prices, schemas.DAILY_PRICES, ("date",)),
        ("curated", "quarterly_fundamentals"): (
            lake.quarterly_fundamentals, schemas.QUARTERLY_FUNDAMENTALS, ("year", "quarter"),
        ),
        ("curated", "quarterly_revenue"): (lake.quarterly_revenue, schemas.REVENUE_BY_YEAR, ("year",)),
        ("raw", "rejected_prices"): (lake.rejected_prices, schemas.REJECTED_PRICES, ("date",)),
        ("marts", "signal_scores"): (lake.signal_scores, schemas.SIGNAL_SCORES, ("date",)),
        ("marts", "positions"): (lake.positions, schemas.POSITIONS, ("date",)),
    }


def _location(spark: SparkSession, table: str) -> tuple[bool, str]:
    """Whether a table is external, and where it lies."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return facts.get("Type") == "EXTERNAL", facts.get("Location", "")


def _same_place(spark: SparkSession, a: str, b: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def plain(text: str) -> str:
        place = path(text)
        return place.getFileSystem(conf).makeQualified(place).toString()

    return plain(a) == plain(b)


def register_lake(spark: SparkSession, lake: Lake) -> list[str]:
    """Makes a lake's tables known as ``raw.*``, ``curated.*`` and ``marts.*`` for SQL.

    The tables are external: registering or dropping them leaves their files alone. Layers that
    were never written are empty tables. Partitions are picked up from the folders; register again
    after a run has added some. A table of such a name that is something else, one that was loaded
    for instance, is left as it is; the names of those are returned.
    """
    foreign = []
    for (schema, name), (path, columns, partition_by) in lake_tables(lake).items():
        if columns is schemas.SIGNAL_SCORES:
            columns = lake_io.read_scores(spark, path).schema
        fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in columns)
        by = ", ".join(quoted(c) for c in partition_by)
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(schema)}")
        table = f"{quoted(schema)}.{quoted(name)}"
        if spark.catalog.tableExists(f"{schema}.{name}"):
            external, place = _location(spark, table)
            if not external or not _same_place(spark, place, path):
                foreign.append(f"{schema}.{name}")
                continue
            # Its columns may have grown since; dropping an external table leaves its files.
            spark.sql(f"DROP TABLE {table}")
        location = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {table} ({fields}) USING parquet PARTITIONED BY ({by}) LOCATION '{location}'"
        )
        if lake_io.is_written(spark, path):
            spark.catalog.recoverPartitions(f"{schema}.{name}")
    return foreign
