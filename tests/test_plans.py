"""What the plans must look like to hold at scale."""

import re
from datetime import date

import pytest

from quotidian import schemas
from quotidian.operators import curation
from quotidian.operators.features import price_features_as_of
from quotidian.registry import QUERIES
from quotidian.sources import lake as lake_io

FOLDER = "/root/testdata/sf0.001"


def physical(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture(scope="module")
def plans(spark):
    stored = {
        "curated_price_upsert", "fundamentals_by_quarter", "daily_build", "backfill_build", "raw_reingest",
        "curate_day", "curate_day_fallback", "landed_csv", "rejected_rows", "filing_listing", "list_tables",
        "describe_table", "load_modes", "typed_empty",
    }
    return {n: physical(q(spark, FOLDER)) for n, q in QUERIES.items() if n not in stored}


def test_no_python_in_any_plan(plans):
    for name, plan in plans.items():
        assert not re.search(r"Python|InPandas|MapPartitions|Arrow", plan), name


def test_no_joins_without_a_key(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_no_window_without_a_partition(plans):
    for name, plan in plans.items():
        for spec in re.findall(r"Window \[(.*)$", plan, re.MULTILINE):
            # "[functions], [partition], [order]": an absent partition leaves two brackets.
            assert re.search(r"\], \[[^\[\]]+\], \[[^\[\]]+\]$", spec), (name, spec)


def test_quality_report_reads_the_lines_once(plans):
    assert plans["dq_report"].count("l_extendedprice:double") == 1


def test_sector_statistics_meet_the_rows_without_a_shuffle(plans):
    before_stats = plans["zscore_by_sector"].split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning(sector" not in before_stats and "SortMergeJoin [sector" not in before_stats


def test_lookback_reaches_the_scan(plans):
    scan = next(l for l in plans["price_features_asof"].splitlines() if "l_extendedprice" in l and "FileScan" in l)
    assert "GreaterThanOrEqual(l_shipdate,1999-05-27" in scan
    assert "LessThan(l_shipdate,2000-07-01" in scan
    assert "l_tax" not in scan and "l_comment" not in scan


def test_rolling_columns_share_one_shuffle_and_one_sort(bars):
    plan = physical(price_features_as_of(bars({"A": [1.0]}), date(2024, 6, 28)))
    assert plan.count("Exchange hashpartitioning(ticker") == 1
    assert len(re.findall(r"Sort \[ticker", plan)) == 1


def test_branches_share_the_windows(spark):
    df = QUERIES["positions"](spark, FOLDER)
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 2
    assert final.count("stddev_samp(ret)") == 1


@pytest.mark.parametrize("name, n", [("positions", 10), ("positions_panel", 3)])
def test_books_cut_before_the_shuffle(plans, name, n):
    assert len(re.findall(rf"WindowGroupLimit \[date.*?, {n}, Partial", plans[name])) == 2


def test_last_row_is_an_aggregate_not_a_window(spark, prices):
    plan = physical(curation.keep_last(prices({})))
    assert "Window" not in plan and "partial_max" in plan


def test_stored_dates_prune_partitions(spark, prices, tmp_path):
    path = f"{tmp_path}/t"
    lake_io.overwrite_partitions(prices({"date": date(2024, 1, 1)}, {}), path)
    daily = lake_io.read_table(spark, path, schemas.DAILY_PRICES)
    plan = physical(price_features_as_of(daily, date(2024, 6, 28)))
    assert re.search(r"PartitionFilters: \[isnotnull\(date[^\]]*date >= ", plan)
    assert "ReadSchema: struct<ticker:string,close:double>" in plan


def test_single_ticker_reaches_the_scan(spark, prices, tmp_path):
    path = f"{tmp_path}/t"
    lake_io.overwrite_partitions(prices({}), path)
    daily = lake_io.read_table(spark, path, schemas.DAILY_PRICES)
    features = price_features_as_of(daily, date(2024, 6, 28)).where("ticker = 'A'")
    assert "EqualTo(ticker,A)" in physical(features)
