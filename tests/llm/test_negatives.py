import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotidian.llm import negatives
from tests.llm.conftest import rows_of


def by_hand(rows, step=50):
    dims = max((len(v) for _, l, v in rows if v is not None), default=0)
    seen = set()
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        seen.add((i, (label + 1) % 10 if i % 7 == 0 else label, whole + (0,) * (dims - len(whole))))
    every, out = sorted(seen), []
    for a in every:
        if a[0] % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in every if b != a)
        same = [(-s, i) for s, i, label in scored if label == a[1]][:5]
        for ps, pid in same:
            hard = [(-s, i) for s, i, label in scored if label != a[1] and 50 * ps <= 100 * -s <= 95 * ps][:3]
            out += [(a[0], pid, k + 1, i, ps, s) for k, (s, i) in enumerate(hard)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3).withColumns(
        {c: F.lit(c) for c in ("vector", "ids", "asked", "block", "home", "score", "class", "rank", "anchor")})


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 12))
    out = [(i, int(rng.integers(0, 10)), (centres[i % 6] + 0.4 * rng.normal(size=12)).tolist()) for i in range(600)]
    out += [(1000 + i, i % 3, out[0][2]) for i in range(300)]  # copies under three labels
    return out + [
        (2000, None, out[1][2]), (2050, 3, None), (2100, 3, [None, *[1.0] * 11]), (2150, 3, [float("nan"), *[1.0] * 11]),
        (2200, 3, [float("-inf"), *[1.0] * 11]), (2250, 3, [0.5] * 4), (2300, 3, []), (None, 3, [1.0] * 12),
        (2350, 3, [0.0] * 12), out[50], out[50], (50, 4, out[51][2]), (60, out[60][1], out[61][2]), (-50, 9, out[2][2]),
    ]


@pytest.mark.parametrize("block", [7, 64, 1024])
def test_against_search_by_hand(spark, rows, block):
    """Whatever the blocks: ties, copies, repeated ids, short and empty vectors, rows that take no part."""
    given = frame(spark, [(i, v, label) for i, label, v in rows])
    assert rows_of(negatives.mine(given, step=50, block=block)) == by_hand(rows)


def test_zones_are_tested_in_slices(spark, rows, monkeypatch):
    monkeypatch.setattr(negatives, "SLICE_BYTES", 4000)
    given = frame(spark, [(i, v, label) for i, label, v in rows])
    assert rows_of(negatives.mine(given, step=50, block=16)) == by_hand(rows)


def test_distant_blocks_are_not_read(spark):
    """Clusters far apart: an anchor's windows pass few zones."""
    rng = np.random.default_rng(1)
    centre = np.eye(8)[np.arange(8).repeat(64)] * 4
    x = centre + 0.02 * rng.normal(size=centre.shape)
    given = [(i, int(i % 2), v.tolist()) for i, v in enumerate(x)]
    vectors = frame(spark, [(i, v, label) for i, label, v in given])
    rows = negatives.whole_numbers(vectors, 8)
    classes = rows.select("label", "vector", F.array("vec_id").alias("ids"), (F.col("vec_id") % 50 == 0).alias("asked"))
    blocks = negatives.blocks_of(classes, 8, 32)
    asked = negatives.anchors_of(blocks, 8).withColumns({
        "lows": F.array(F.lit(500_000).cast("long")), "highs": F.array(F.lit(negatives.HIGH))})
    packets = negatives.elsewhere(asked, blocks, True).select(F.size("anchors")).collect()
    assert 0 < sum(p[0] for p in packets) <= 0.25 * asked.count() * blocks.count()


def test_large_components_do_not_overflow(spark):
    rows = [(i, [3e38, -3e38, float(i)], i % 2) for i in range(0, 200, 10)]
    found = negatives.mine(frame(spark, rows)).collect()
    assert all(0 <= r["negative_score"] <= r["positive_score"] < 2**56 for r in found)


def test_empty(spark):
    assert negatives.mine(frame(spark, [(0, [1.0], 1)]).limit(0)).collect() == []
    assert negatives.mine(frame(spark, [(0, [1.0], 1)])).collect() == []


def test_curve_visits_neighbours():
    """Every cell once, and consecutive cells touch."""
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        key = negatives.hilbert(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_products_of_large_numbers_are_exact():
    a = np.array([[2**40 + 1, 3]])
    assert negatives.products(a, np.array([[2**20 + 1, 7]])).tolist() == [[(2**40 + 1) * (2**20 + 1) + 21]]
