"""Approximate nearest neighbours by stable projections, kd-trees and a chi-square stopping test.

Vectors of length one are projected onto DIMS Gaussian directions; the projected distance of two vectors
is their distance times the root of a chi-square variable with DIMS degrees of freedom. Projected
neighbours are taken in the order of their projected distance and verified on the original vectors. A
search stops at projected distance p once p^2 exceeds d^2 times the SURE quantile of chi-square, d being the
distance of the worst of the neighbours found: any closer vector would have been met by then with
probability SURE.

The projected space is cut into cells by a kd-tree whose medians come from a bounded sample; every row is
indexed in its cell, and within a cell by a kd-tree of its own. A query first searches its home cell, then
all cells whose boxes pass the same test. Cells and queries meet in blocks of bounded size.

Equal vectors are one class with its smallest ids, and equal queries are searched once, so copies cost
nothing; the answer is the same, since of equally near vectors those with the smallest ids win.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from quotidian.llm.scratch import saved
from quotidian.llm.text import column

DIMS = 8
SURE = 0.985
SEED = 11
#: Vectors that the cells' medians are taken from, classes per cell, queries per block, vectors per leaf.
SAMPLE, CELL, BLOCK, LEAF = 20_000, 8192, 4096, 64


def chi_square_quantile(p: float, dims: int) -> float:
    """For an even number of degrees of freedom, where the distribution has a closed form."""

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))

    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list column of one length, in double precision."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 1)


def project(x: np.ndarray, dims: int = DIMS) -> np.ndarray:
    directions = np.random.default_rng(SEED).standard_normal((x.shape[1], dims))
    return (x / np.sqrt((x * x).sum(1))[:, None]) @ directions


def kd_splits(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Axis and median of each inner node, by levels; the axis with the widest spread is cut."""
    nodes, level = [], [points]
    for _ in range(depth):
        below = []
        for part in level:
            axis = int(np.ptp(part, axis=0).argmax()) if len(part) else 0
            cut = float(np.median(part[:, axis])) if len(part) else 0.0
            nodes.append((axis, cut))
            right = part[:, axis] > cut if len(part) else np.zeros(0, bool)
            below += [part[~right], part[right]]
        level = below
    return nodes


def cell_of(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    axes, cuts = np.array([a for a, _ in splits], np.int64), np.array([c for _, c in splits])
    for _ in range(int(math.log2(len(splits) + 1))):
        right = points[np.arange(len(points)), axes[node]] > cuts[node]
        node = 2 * node + 1 + right
    return node - len(splits)


def box_distance(low: np.ndarray, high: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distance from a point to each box."""
    away = np.maximum(np.maximum(low - point, point - high), 0)
    return (away * away).sum(1)


class Index:
    """A kd-tree over the projected vectors of one cell."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]]):
        self.vectors, self.ids = vectors, ids
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.points = project(vectors)
        leaves = [np.arange(len(vectors))]
        while len(leaves[0]) > LEAF:
            halves = []
            for part in leaves:
                axis = int(np.ptp(self.points[part], axis=0).argmax())
                middle = len(part) // 2
                order = np.argpartition(self.points[part, axis], middle)
                halves += [part[order[:middle]], part[order[middle:]]]
            leaves = halves
        self.leaves = leaves
        self.low = np.array([self.points[x].min(0) for x in leaves])
        self.high = np.array([self.points[x].max(0) for x in leaves])

    def search(self, query: np.ndarray, known: list[tuple[float, int]], k: int, limit: float) -> list[tuple[float, int]]:
        """The k best (minus cosine, id) of the known ones and this cell's. Leaves are taken nearest first, twice
        as many each time, until the next one fails the stopping test."""
        point, norm = project(query[None])[0], np.sqrt((query * query).sum())
        distance = box_distance(self.low, self.high, point)
        order = np.argsort(distance, kind="stable")
        distance = distance[order]
        best, at, step = sorted(known)[:k], 0, 1
        while at < len(order):
            reach = math.inf if len(best) < k else limit * max(2 + 2 * best[-1][0], 0) + 1e-9
            end = min(at + step, int(np.searchsorted(distance, reach, "right")))
            if end <= at:
                break
            rows = np.concatenate([self.leaves[i] for i in order[at:end]])
            if reach < math.inf:
                gap = self.points[rows] - point
                rows = rows[(gap * gap).sum(1) <= reach]
            score = -((self.vectors[rows] * query).sum(1) / (self.norms[rows] * norm))
            worst = best[-1][0] if len(best) == k else math.inf
            for i in np.flatnonzero(score <= worst):
                best += [(float(score[i]), j) for j in self.ids[rows[i]]]
            best = sorted(set(best))[:k]
            at, step = end, step * 2
        return best


_FOUND = "h long, vector array<{kind}>, found array<struct<away: double, vec_id: long>>"
_PLACED = "h long, vector array<{kind}>, ids array<long>, cell long, point array<double>"


def component(df: DataFrame, name: str) -> str:
    """The type of a vector column's components: float stays float, all others are doubles."""
    kind = df.schema[name].dataType
    return "float" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "double"


def _table(rows: list[tuple], vectors: pa.Array) -> pa.Table:
    found = pa.array([[{"away": a, "vec_id": i} for a, i in best] for _, best in rows],
                     pa.list_(pa.struct([("away", pa.float64()), ("vec_id", pa.int64())])))
    return pa.table({"h": pa.array([h for h, _ in rows], pa.int64()), "vector": vectors, "found": found})


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, h, vector): rows with an id and a vector of finite components that is not zero; of the vectors'
    lengths the commonest, the larger of two that tie. Repeated rows become one."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kind = f"array<{component(vectors, 'embedding')}>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("vector"), "embedding").where(
        F.col("vec_id").isNotNull() & ok & F.exists("embedding", lambda x: x != 0))
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dims = size["n"] if size else 0
    return rows.where(F.size("vector") == dims).select(
        "vec_id", F.xxhash64("vector").alias("h"), "vector").distinct()


def _blocks(cells: DataFrame, asked: DataFrame, k: int, limit: float) -> DataFrame:
    """Every asked (cell, h, vector, found) searched in its cell; one block of about BLOCK queries at a time, of
    which a cell has as many as its own queries fill."""
    blocks = [F.lit(x) for r in asked.groupBy("cell").count().collect() for x in (r["cell"], -(-r["count"] // BLOCK))]
    many = F.create_map(*blocks)[F.col("cell")] if blocks else F.lit(1)
    asked = asked.withColumn("block", F.pmod("h", many).cast("int"))
    wanted = asked.select("cell", "block").distinct()
    rows = cells.join(wanted, "cell")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        vectors = right["vector"].combine_chunks() if right.num_rows else right["vector"]
        if left.num_rows and right.num_rows:
            index = Index(matrix(left["vector"]), left["ids"].to_pylist())
            queries = matrix(vectors)
            for i, (h, found) in enumerate(zip(right["h"].to_pylist(), right["found"].to_pylist())):
                known = [(x["away"], x["vec_id"]) for x in found]
                out.append((h, index.search(queries[i], known, k, limit)))
            return _table(out, vectors)
        return _table([(h, [(x["away"], x["vec_id"]) for x in f]) for h, f in zip(
            right["h"].to_pylist(), right["found"].to_pylist())], vectors)

    # A salted cell is searched in each of its parts.
    salted = asked.join(cells.select("cell", "salt").distinct(), "cell").select(
        F.col("cell").alias("in_cell"), F.col("salt").alias("in_salt"), F.col("block").alias("in_block"),
        "h", "vector", "found")
    return rows.groupBy("cell", "salt", "block").cogroup(
        salted.groupBy("in_cell", "in_salt", "in_block")).applyInArrow(run, _FOUND.format(kind=component(asked, "vector")))


def _merge(found: DataFrame, k: int) -> DataFrame:
    return found.groupBy("h", "vector").agg(
        F.slice(F.array_distinct(F.array_sort(F.flatten(F.collect_list("found")))), 1, k).alias("found"))


def search(vectors: DataFrame, step: int = 50, k: int = 5, dims: int = DIMS, sure: float = SURE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by `step` the k rows of other
    ids with the largest cosine found, nearest first, ties to the smaller vec_id; all others, if fewer.

    score is the cosine of the original vectors in double precision. Rows without a vec_id, and vectors that
    are null, zero, hold null or non-finite components or are of an unusual length, take no part. A
    vec_id that repeats with other vectors is a candidate with each. An empty table gives no rows.
    Squares are taken in double precision, in which those of components beyond 1e150 overflow.
    """
    limit, take = chi_square_quantile(sure, dims), k + 1  # a query may meet itself
    rows = saved(valid_vectors(vectors), "vectors")
    kind = component(rows, "vector")
    least = Window.partitionBy("h", "vector").orderBy("vec_id")
    classes = saved(
        rows.withColumn("n", F.row_number().over(least)).where(F.col("n") <= take)
        .groupBy("h", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "vector-classes")
    total = classes.count()
    asked = rows.where(F.col("vec_id") % step == 0)
    queries = asked.select("h", "vector").distinct()
    sample = classes.orderBy(F.xxhash64("h")).limit(SAMPLE).select("vector").toArrow()
    depth = min(max(0, math.ceil(math.log2(max(total, 1) / CELL))), 11)
    splits = kd_splits(project(matrix(sample["vector"])), depth) if sample.num_rows else []

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = project(matrix(column(batch, "vector")))
                cell = cell_of(points, splits) if splits else np.zeros(len(points), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell), pa.array(list(points), pa.list_(pa.float64()))],
                    [*batch.schema.names, "cell", "point"])

    placed = saved(classes.mapInArrow(place, _PLACED.format(kind=kind)), "cells")
    bounds = placed.groupBy("cell").agg(
        F.count("*").alias("n"),
        F.array(*[F.min(F.col("point")[i]) for i in range(dims)]).alias("low"),
        F.array(*[F.max(F.col("point")[i]) for i in range(dims)]).alias("high")).collect()
    parts = F.create_map(*[F.lit(x) for b in bounds for x in (b["cell"], max(1, round(b["n"] / (2 * CELL))))]) if bounds else None
    cells = placed.select("h", "vector", "ids", "cell")
    cells = cells.withColumn("salt", F.pmod("h", parts[F.col("cell")]) if bounds else F.lit(0).cast("long"))
    low = np.array([b["low"] for b in bounds]).reshape(-1, dims)
    high = np.array([b["high"] for b in bounds]).reshape(-1, dims)
    numbers = np.array([b["cell"] for b in bounds], np.int64)

    home = queries.withColumn("ids", F.array().cast("array<long>")).mapInArrow(
        place, _PLACED.format(kind=kind)).select(
        "cell", "h", "vector", F.array().cast("array<struct<away: double, vec_id: long>>").alias("found"))
    first = saved(_merge(_blocks(cells, home, take, limit), take), "home-cells")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each further cell that passes the test with what the home cell has found."""
        for batch in batches:
            if not batch.num_rows:
                continue
            points = project(matrix(column(batch, "vector")))
            own = cell_of(points, splits) if splits else np.zeros(len(points), np.int64)
            which, cell = [], []
            for i, found in enumerate(column(batch, "found").to_pylist()):
                reach = math.inf if len(found) < take else limit * max(2 + 2 * found[-1]["away"], 0) + 1e-9
                there = numbers[(box_distance(low, high, points[i]) <= reach) & (numbers != own[i])]
                which += [i] * len(there)
                cell += there.tolist()
            asked_rows = batch.take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int64()), *asked_rows.columns], ["cell", *asked_rows.schema.names])

    far = saved(first.mapInArrow(visit, "cell long, " + _FOUND.format(kind=kind)), "further-cells")
    every = _merge(first.unionByName(_blocks(cells, far, take, limit)), take)
    answers = asked.join(every, ["h", "vector"]).select(
        F.col("vec_id").alias("query_id"),
        F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("vec_id")), 1, k).alias("found"))
    return answers.select("query_id", F.posexplode("found").alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", (-F.col("x.away")).alias("score"))
