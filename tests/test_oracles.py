"""Every registered query against its SQL counterpart."""

import pytest

from checks.compare import differences, open_tables
from checks.oracles import ORACLES
from quotidian.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
# The brands have too few bars at the smallest scale for their 60-row gate.
LARGER = "/root/testdata/sf0.01"
NEED_LARGER = {
    "price_features_brand", "price_features_panel", "signal_scores_panel", "positions_panel",
    "scores_enriched_latest", "available_dates", "ticker_features_latest", "ticker_score_date", "daily_build",
    "backfill_build", "signal_scores_panel_with_fundamentals", "incremental_build", "overnight_change_day",
}


@pytest.fixture(scope="module")
def engines():
    return {folder: open_tables(folder) for folder in (SMALL, LARGER)}


def test_every_query_has_a_counterpart():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, engines, name):
    folder = LARGER if name in NEED_LARGER else SMALL
    difference, rows, _, _ = differences(spark, engines[folder], name, folder)
    assert difference is None
    assert rows > 0
