"""Hard negatives from candidate blocks along a Hilbert curve, chosen by zone maps.

Vectors are whole numbers, floor(256 * x). Rows of one label and vector are a class; only a class's first
ids can be among an answer, since of equal scores the smaller id wins, so copies cost nothing. Classes are
ordered along a Hilbert curve through their widest-spread dimensions and written to Parquet in blocks of
BLOCK classes, each block with the least and greatest value of every dimension: its zone.

For an anchor a, the inner product with any vector of a zone [l, h] lies within
[sum min(a*l, a*h), sum max(a*l, a*h)]. A window of scores reads the blocks whose interval meets it. Twice,
for the positives (no bounds) and for the negatives of each positive (its window), there are two rounds: an
anchor first reads the block it lies in, and with what it has found there only blocks that can hold better.

Anchors travel to blocks by a join on the block's number, packed by the task that tested them; the
products are matrix multiplications of a block by a packet. Zones are tested in slices of SLICE_BYTES,
each broadcast by itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotidian.llm.scratch import saved, stream_texts
from quotidian.llm.text import column

POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 50, 95
#: Classes in a block, anchors in a packet, bytes of zones that are broadcast at once.
BLOCK, PACKET, SLICE_BYTES = 1024, 256, 8 << 20
#: Dimensions and bits of the curve.
CURVE_DIMS, CURVE_BITS = 8, 7
LOW, HIGH = -(2**62), 2**62
#: A class's number is its block's times this, and its place there.
PLACES = 1 << 20


def limit_of(dims: int) -> int:
    """Components are held within this bound, so that a hundred times an inner product fits in 64 bits."""
    return math.isqrt(2**55 // max(dims, 1))


def whole_numbers(vectors: DataFrame, dims: int) -> DataFrame:
    """(vec_id, label, vector): the rows that take part, each distinct one once; shorter vectors are filled up
    with zeros."""
    bound = limit_of(dims)
    whole = F.transform("embedding", lambda x: F.floor(F.greatest(F.least(
        x.cast("double") * 256, F.lit(float(bound))), F.lit(float(-bound)))).cast("long"))
    label = F.col("label").cast("long")
    return _taking_part(vectors).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.concat(whole, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("embedding"))).alias("vector"),
    ).distinct()


def _taking_part(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select("vec_id", "label", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)


def matrix(col: pa.Array) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0), np.int64)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of whole numbers below 2 ** bits, dims * bits below 63."""
    x = points.T.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):  # undo the turns of each level's cells
        q = 1 << level
        for i in range(dims):
            turned = (x[i] & q) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(turned, q - 1, swap)
            x[i] ^= swap
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[dims - 1] >> level) & 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def widest(classes: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The dimensions of greatest variance, and the range of each; sums are made by the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(column(batch, "vector")).astype(np.float64)
            if x.size:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(dims)), pa.array(np.full(dims, len(x))), pa.array(x.sum(0)), pa.array((x * x).sum(0)),
                    pa.array(x.min(0)), pa.array(x.max(0))], ["dim", "n", "s", "ss", "low", "high"])

    rows = classes.select("vector").mapInArrow(
        run, "dim long, n long, s double, ss double, low double, high double").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"),
        F.min("low").alias("low"), F.max("high").alias("high")).collect()  # one row a dimension
    rows.sort(key=lambda r: (-(r["ss"] / r["n"] - (r["s"] / r["n"]) ** 2), r["dim"]))
    best = rows[:CURVE_DIMS]
    return tuple(np.array([r[c] for r in best]) for c in ("dim", "low", "high"))


_BLOCKS = ("block long, labels array<long>, vectors binary, ids array<array<long>>, asked array<boolean>, "
           "low array<long>, high array<long>, one_label boolean")


def blocks_of(classes: DataFrame, dims: int, size: int = BLOCK) -> DataFrame:
    """The classes packed along the curve; a row is a block, and its columns low and high are its zone."""
    axes, low, high = widest(classes, dims)
    step = np.where(high > low, high - low, 1) / (1 << CURVE_BITS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(column(batch, "vector"))
                key = np.zeros(len(x), np.int64)
                if len(axes):
                    cells = ((x[:, axes.astype(int)] - low) / step).astype(np.int64)
                    key = hilbert(np.clip(cells, 0, (1 << CURVE_BITS) - 1), CURVE_BITS)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], [*batch.schema.names, "place"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, number = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows >= size:
                yield _block((part << 20) + number, held.slice(0, size))
                held, number = held.slice(size), number + 1
        if held is not None and held.num_rows:
            yield _block((part << 20) + number, held)

    parts = max(1, -(-classes.count() // (16 * size)))
    placed = classes.mapInArrow(place, "label long, vector array<long>, ids array<long>, asked boolean, place long")
    curve = ["place", "label", F.xxhash64("vector")]
    ordered = stream_texts(placed.repartitionByRange(parts, *curve).sortWithinPartitions(*curve, "vector"))
    return saved(ordered.mapInArrow(pack, _BLOCKS), "hilbert-blocks")


def _block(number: int, rows: pa.Table) -> pa.RecordBatch:
    x = matrix(rows["vector"])
    labels = rows["label"].to_pylist()
    return pa.RecordBatch.from_arrays([
        pa.array([number]), pa.array([labels], pa.list_(pa.int64())), pa.array([x.astype("<i8").tobytes()], pa.binary()),
        pa.array([rows["ids"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
        pa.array([rows["asked"].to_pylist()], pa.list_(pa.bool_())),
        pa.array([x.min(0).tolist()], pa.list_(pa.int64())), pa.array([x.max(0).tolist()], pa.list_(pa.int64())),
        pa.array([len(set(labels)) == 1]),
    ], ["block", "labels", "vectors", "ids", "asked", "low", "high", "one_label"])


_PACKETS = "block long, anchors array<long>, own array<long>, vectors binary, lows array<array<long>>, highs array<array<long>>"


def _packet(block: int, anchors, own, x, lows, highs) -> list:
    return [block, anchors, own, x.astype("<i8").tobytes(), lows, highs]


def _packets(rows: list[list]) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), longs, longs, pa.binary(), pa.list_(longs), pa.list_(longs)]
    names = ["block", "anchors", "own", "vectors", "lows", "highs"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names) if rows else (
        pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles as long as every sum stays below 2 ** 53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Zones:
    """A slice of the blocks' zones, and the test which of them an anchor's windows must read."""

    def __init__(self, table: pa.Table):
        self.block = table["block"].to_numpy()
        self.low, self.high = matrix(table["low"]).astype(np.float64), matrix(table["high"]).astype(np.float64)
        self.only = np.array([labels[0] if one else -1 for labels, one in zip(
            table["labels"].to_pylist(), table["one_label"].to_pylist())])
        self.one = table["one_label"].to_numpy()

    def wanted(self, x: np.ndarray, label: np.ndarray, lows: list, highs: list, same: bool) -> np.ndarray:
        """Anchors by blocks. Bounds are widened by what doubles may lose."""
        plus, minus = np.maximum(x, 0).astype(np.float64), np.minimum(x, 0).astype(np.float64)
        most, least = plus @ self.high.T + minus @ self.low.T, plus @ self.low.T + minus @ self.high.T
        slack = (np.abs(x).astype(np.float64) @ np.maximum(np.abs(self.low), np.abs(self.high)).T) * 2.0**-40
        out = np.zeros(most.shape, bool)
        for i, (low, high) in enumerate(zip(lows, highs)):
            for a, b in zip(low, high):
                out[i] |= (most[i] + slack[i] >= a) & (least[i] - slack[i] <= b)
        own = self.one[None, :] & (self.only[None, :] == label[:, None])
        return out & ~own if not same else out & (own | ~self.one[None, :])


def anchors_of(blocks: DataFrame, dims: int) -> DataFrame:
    """(anchor, label, vector, home) of the classes that an anchor row belongs to, by the blocks they lie in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {n: c[row] for n, c in zip(batch.schema.names, batch.columns)}
                at = np.flatnonzero(np.asarray(get["asked"].values))
                labels, block = np.asarray(get["labels"].values), get["block"].as_py()
                x = np.frombuffer(get["vectors"].as_buffer(), "<i8").reshape(len(labels), -1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(block * PLACES + at), pa.array(labels[at]),
                    pa.array(x[at].tolist(), pa.list_(pa.int64())), pa.array(np.full(len(at), block))],
                    ["anchor", "label", "vector", "home"])

    return stream_texts(blocks.where(F.exists("asked", lambda x: x)).select("block", "labels", "vectors", "asked")).mapInArrow(
        run, "anchor long, label long, vector array<long>, home long")


def _read(batch: pa.RecordBatch):
    return (np.asarray(column(batch, "anchor")), np.asarray(column(batch, "label")), matrix(column(batch, "vector")),
            column(batch, "lows").to_pylist(), column(batch, "highs").to_pylist(), np.asarray(column(batch, "home")))


def at_home(asked: DataFrame) -> DataFrame:
    """Packets for the blocks that the anchors lie in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                anchor, label, x, lows, highs, home = _read(batch)
                rows = []
                for block in np.unique(home):
                    at = np.flatnonzero(home == block)
                    for k in range(0, len(at), PACKET):
                        i = at[k : k + PACKET]
                        rows.append(_packet(int(block), anchor[i], label[i], x[i], [lows[j] for j in i], [highs[j] for j in i]))
                yield _packets(rows)

    return asked.mapInArrow(run, _PACKETS)


def elsewhere(asked: DataFrame, blocks: DataFrame, same: bool) -> DataFrame:
    """Packets for all other blocks whose zones pass the test."""
    zones = blocks.select("block", "labels", "low", "high", "one_label").withColumn(
        "labels", F.slice("labels", 1, 1))  # the only one, where there is one
    bounds = blocks.groupBy().agg(F.count("*").alias("n"), F.max(F.size("low")).alias("dims")).first()
    parts = max(1, -(-bounds["n"] * 16 * (bounds["dims"] or 0) // SLICE_BYTES))
    out = None
    for part in range(parts):
        table = zones.where(F.pmod(F.xxhash64("block"), F.lit(parts)) == part).toArrow()
        if not table.num_rows:
            continue
        shared = asked.sparkSession.sparkContext.broadcast(Zones(table))
        found = asked.mapInArrow(_choosing(shared, same), _PACKETS)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else asked.sparkSession.createDataFrame([], _PACKETS)


def _choosing(shared, same: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zones = shared.value
        for whole in batches:
            for begin in range(0, whole.num_rows, PACKET):
                anchor, label, x, lows, highs, home = _read(whole.slice(begin, PACKET))
                wanted = zones.wanted(x, label, lows, highs, same) & (zones.block[None, :] != home[:, None])
                for z in np.flatnonzero(wanted.any(0)):
                    i = np.flatnonzero(wanted[:, z])
                    yield _packets([_packet(int(zones.block[z]), anchor[i], label[i], x[i], [lows[j] for j in i], [highs[j] for j in i])])

    return run


_FOUND = "anchor long, nth int, score long, vec_id long, class long"


def evaluate(packets: DataFrame, blocks: DataFrame, same: bool, keep: int) -> DataFrame:
    """(anchor, nth, score, vec_id, class): of each packet's windows, by number, the `keep` best rows of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield _best({n: c[row] for n, c in zip(batch.schema.names, batch.columns)}, same, keep)

    held = blocks.select("block", "labels", F.col("vectors").alias("members"), "ids")
    # Packets come from a small table, but may be many: neither side is to be broadcast by that table's size.
    return stream_texts(packets.join(held.hint("merge"), "block")).mapInArrow(run, _FOUND)


def _best(get: dict[str, pa.Scalar], same: bool, keep: int) -> pa.RecordBatch:
    labels, own, anchors = (np.asarray(get[n].values) for n in ("labels", "own", "anchors"))
    members = np.frombuffer(get["members"].as_buffer(), "<i8").reshape(len(labels), -1)
    x = np.frombuffer(get["vectors"].as_buffer(), "<i8").reshape(len(own), -1)
    lows, highs, listed = get["lows"].values, get["highs"].values, get["ids"].values
    windows = np.asarray(lows.value_lengths())
    which = np.repeat(np.arange(len(own)), windows)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
    low, high = np.asarray(lows.flatten()), np.asarray(highs.flatten())
    fits = (labels[None, :] == own[:, None]) if same else (labels[None, :] != own[:, None])
    masked = products(x, members)[which]
    masked = np.where(fits[which] & (masked >= low[:, None]) & (masked <= high[:, None]), masked, LOW - 1)
    if len(labels) > keep:
        floor = np.partition(masked, len(labels) - keep, axis=1)[:, len(labels) - keep]
    else:
        floor = np.full(len(masked), LOW)
    w, c = np.nonzero(masked >= np.maximum(floor, LOW)[:, None])
    many, ids = np.asarray(listed.value_lengths()).astype(np.int64), np.asarray(listed.flatten())
    first = np.cumsum(many) - many
    reach = many[c]
    at = np.arange(int(reach.sum())) + np.repeat(first[c] - (np.cumsum(reach) - reach), reach)
    w, c = np.repeat(w, reach), np.repeat(c, reach)
    score, ids = masked[w, c], ids[at]
    order = np.lexsort((ids, -score, w))
    w, c, score, ids = w[order], c[order], score[order], ids[order]
    best = np.arange(len(w)) - np.searchsorted(w, w) < keep
    w, c, score, ids = w[best], c[best], score[best], ids[best]
    return pa.RecordBatch.from_arrays([
        pa.array(anchors[which[w]]), pa.array(nth[w].astype(np.int32)), pa.array(score), pa.array(ids),
        pa.array(get["block"].as_py() * PLACES + c)], ["anchor", "nth", "score", "vec_id", "class"])


def first_of(found: DataFrame, keep: int) -> DataFrame:
    """The rows with their rank, cut to each window's `keep` best."""
    order = Window.partitionBy("anchor", "nth").orderBy(F.col("score").desc(), "vec_id", "class")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def searched(asked: DataFrame, blocks: DataFrame, same: bool, keep: int) -> DataFrame:
    """first_of() all blocks that the windows of asked must read."""
    near = saved(first_of(evaluate(at_home(asked), blocks, same, keep), keep).drop("rank"), "home-blocks")
    # What comes after `keep` found rows, and has no smaller an id, can't count: floors rise to the last of them.
    floors = near.groupBy("anchor", "nth").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(
        F.col("n") == keep).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("nth", "floor"))).alias("floors"))
    raised = asked.join(floors, "anchor", "left").withColumn("lows", F.transform(
        "lows", lambda low, i: F.greatest(low, F.coalesce(F.try_element_at("floors", i), low)))).select(asked.columns)
    far = evaluate(elsewhere(raised, blocks, same), blocks, same, keep)
    return saved(first_of(near.unionByName(far), keep), "read-blocks")


def mine(vectors: DataFrame, step: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
         block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row whose vec_id is
    divisible by `step` and each of its positives, the best rows of other labels whose score lies between
    LEAST and MOST hundredths of the positive's.

    Rows without a vec_id or label, and those whose vector is null or holds a null or non-finite component,
    take no part. Rows equal in id, label and whole numbers are one. A vec_id that repeats with another
    label or vector stands for several rows, each an anchor and a candidate of its own. A shorter vector
    counts as filled up with zeros. Components are held within limit_of(dims), 2 ** 24 and more up to 128 dimensions.
    Equal scores: the smaller vec_id first. An empty table gives no rows.
    """
    dims = _taking_part(vectors).agg(F.max(F.size("embedding"))).first()[0] or 0
    rows = saved(whole_numbers(vectors, dims), "whole-vectors")
    least = Window.partitionBy("label", "vector").orderBy("vec_id")
    wanted = rows.where(F.col("vec_id") % step == 0)
    key = ["label", "vector"]
    classes = saved(rows.withColumn("n", F.row_number().over(least)).where(
        F.col("n") <= max(positives + 1, negatives)).groupBy(*key).agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids")).join(
        wanted.select(*key, F.lit(True).alias("asked")).distinct(), key, "left").select(
        *key, "ids", F.col("asked").isNotNull().alias("asked")), "vector-classes")
    blocks = blocks_of(classes, dims, block)
    anchors = saved(anchors_of(blocks, dims), "anchors")
    same = searched(anchors.withColumns({
        "lows": F.array(F.lit(LOW)), "highs": F.array(F.lit(HIGH))}), blocks, True, positives + 1)

    # One window for each score that a positive has; none below zero, where the bounds leave nothing.
    windows = same.where(F.col("score") >= 0).groupBy("anchor").agg(F.sort_array(F.collect_set("score")).alias("scores"))
    asked = anchors.join(windows, "anchor").withColumns({
        "lows": F.expr(f"transform(scores, s -> (s * {LEAST} + 99) div 100)"),
        "highs": F.expr(f"transform(scores, s -> (s * {MOST}) div 100)")})
    other = searched(asked.drop("scores"), blocks, False, negatives)
    numbered = windows.select("anchor", F.posexplode("scores").alias("nth", "positive_score"))
    hard = other.join(numbered, ["anchor", "nth"]).select(
        "anchor", "positive_score", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))

    # Every anchor row: its class's positives but itself.
    listed = same.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        F.col("rank"), F.col("score"), F.col("vec_id"), F.col("class")))).alias("found"))
    own = wanted.join(anchors.join(listed, "anchor").select("anchor", *key, "found"), key)
    others = F.filter("found", lambda x: (x["vec_id"] != F.col("vec_id")) | (x["class"] != F.col("anchor")))
    chosen = own.select("anchor", F.col("vec_id").alias("anchor_id"), F.explode(F.slice(others, 1, positives)).alias("x")).select(
        "anchor", "anchor_id", F.col("x.vec_id").alias("positive_id"), F.col("x.score").alias("positive_score"))
    return chosen.join(hard, ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: The same by comparing every anchor with every row.
SQL = f"""
WITH whole AS MATERIALIZED (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbered AS MATERIALIZED (
  SELECT row_number() OVER () AS r, * FROM whole
), scored AS MATERIALIZED (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS other, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM numbered a JOIN numbered b ON a.r <> b.r WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT a, anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, other) <= {POSITIVES}
), ranked AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.a, positive_id ORDER BY score DESC, other) AS r,
         other AS negative_id, positive_score, score AS negative_score
  FROM positives p JOIN scored s ON s.a = p.a
  WHERE NOT s.same AND {LEAST} * positive_score <= 100 * score AND 100 * score <= {MOST} * positive_score
)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE r <= {NEGATIVES}
"""
