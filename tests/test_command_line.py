from datetime import date

import pytest

from quotidian.__main__ import parser, run
from quotidian.sources import catalog
from quotidian.sources.lake import Lake
from tests.test_runs import land


@pytest.fixture
def call(spark, tmp_path):
    def with_args(*args):
        return run(spark, parser().parse_args(["--lake", f"{tmp_path}/lake", *args]))

    yield with_args
    for schema in ("raw", "curated", "marts"):
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def test_a_day_by_commands(call, spark, tmp_path, capsys):
    landing = land(f"{tmp_path}/landing")
    assert call("backfill", "--target-date", "2024-06-26", "--end-date", "2024-06-28", "--landing", landing) == 0
    assert call("ingest-prices", "--landing", landing, "--run-date", "2024-06-28") == 0
    assert call("curate", "--run-date", "2024-06-28") == 0
    assert "'valid': True" in capsys.readouterr().out
    assert call("build", "--run-date", "2024-06-28") == 0
    assert call("tables") == 0
    out = capsys.readouterr().out
    assert "curated.daily_prices: 18 rows" in out and "marts.positions: 0 rows" in out
    assert call("describe", "curated.daily_prices", "--limit", "2") == 0
    assert "close: double" in capsys.readouterr().out
    assert call("describe", "curated.nothing") == 1
    assert call("query", "SELECT count(DISTINCT date) AS days FROM curated.daily_prices") == 0
    assert capsys.readouterr().out == "days\n3\n"
    rows = "SELECT id FROM range(50)"
    assert call("query", rows) == 0
    assert capsys.readouterr().out.split() == ["id", *map(str, range(50))]
    assert call("query", rows, "--limit", "2") == 0
    assert len(capsys.readouterr().out.split()) == 3
    assert call("query", rows, "--output", f"{tmp_path}/rows") == 0
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 50


def test_registered_tables_prune_partitions_and_stay_on_drop(call, spark, tmp_path):
    call("backfill", "--target-date", "2024-06-27", "--end-date", "2024-06-28", "--landing", land(f"{tmp_path}/landing"))
    lake = Lake(f"{tmp_path}/lake")
    catalog.register_lake(spark, lake)
    catalog.register_lake(spark, lake)
    one = spark.table("curated.daily_prices").where(f"date = date'{date(2024, 6, 28)}'")
    assert one.count() == 6
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE curated.daily_prices")
    assert spark.read.parquet(lake.daily_prices).count() == 12


def test_commands_need_a_lake():
    with pytest.raises(SystemExit):
        parser().parse_args(["build"])
