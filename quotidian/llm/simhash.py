"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint's 64 bits are cut into parts of correlated bits. If two fingerprints differ in at most r
bits and the parts' thresholds add up to r - parts + 1, then they differ in at most its threshold in one
part at least (a threshold of -1 leaves a part out). The thresholds are those with the fewest estimated
candidates, found by dynamic programming. Each fingerprint is probed under every value within the
threshold of its part; what meets under a value is verified on all 64 bits.

Work is on distinct fingerprints, so copies collapse before the first exchange. Within a small bucket the
verified links are kept as a spanning forest, never as pairs. A bucket of more than BUCKET fingerprints is
not gathered: its members are spread over the fingerprints at distance one, and since any two members
at distance two have such a neighbour in common (at most 65 fingerprints share one), the same links are
found by an ordinary exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotidian.llm.scratch import id_and_text, released, saved, stream_texts, whole_row
from quotidian.llm.text import LOWER, NOT_BLANK, Texts, ints, pieces, words_of

#: Fingerprints that one task gathers under one probed value.
BUCKET = 1024
#: Hot values that are broadcast; more are joined by a shuffle.
HOT_VALUES = 100_000

_P = [np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
)]


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of each byte range; ranges of one length are hashed together."""
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    quads = np.ndarray(len(padded) - 7, "<u8", padded, 0, (1,))
    halves = np.ndarray(len(padded) - 7, "<u4", padded, 0, (1,))
    p1, p2, p3, p4, p5 = _P
    lens = ends - starts
    order = np.argsort(lens, kind="stable")
    cuts = np.flatnonzero(np.diff(lens[order], prepend=-1, append=-1))
    for low, high in zip(cuts[:-1], cuts[1:]):
        rows = order[low:high]
        at, size = starts[rows], int(lens[rows[0]])
        end = at + size
        if size >= 32:
            with np.errstate(over="ignore"):
                s = np.uint64(seed)
                acc = [np.full(len(at), v) for v in (s + p1 + p2, s + p2, s, s - p1)]
            for _ in range(size // 32):
                for k in range(4):
                    acc[k] = _rotl(acc[k] + quads[at + 8 * k] * p2, 31) * p1
                at = at + 32
            h = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for a in acc:
                h = (h ^ (_rotl(a * p2, 31) * p1)) * p1 + p4
        else:
            with np.errstate(over="ignore"):
                h = np.full(len(at), np.uint64(seed) + p5)
        h = h + np.uint64(size)
        left = size % 32
        for _ in range(left // 8):
            h = _rotl(h ^ (_rotl(quads[at] * p2, 31) * p1), 27) * p1 + p4
            at = at + 8
        if left % 8 >= 4:
            h = _rotl(h ^ (halves[at].astype(np.uint64) * p1), 23) * p2 + p3
            at = at + 4
        while (at < end).any():
            h = _rotl(h ^ (padded[at].astype(np.uint64) * p5), 11) * p1
            at = at + 1
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        out[rows] = h ^ (h >> np.uint64(32))
    return out


def _joined(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one blank after each: bytes, begins, ends, words per text."""
    words = words_of(texts, NOT_BLANK)
    size = words.ends - words.starts + 1
    ends = np.cumsum(size)
    starts = ends - size
    take = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(words.starts - starts, size)
    data = LOWER[texts.data[np.minimum(take, max(len(texts.data) - 1, 0))]] if len(take) else np.zeros(0, np.uint8)
    if len(ends):
        data[ends - 1] = 32
    return data, starts, ends - 1, words


def fingerprints(texts: Texts, shingle: int, seed: int = 42) -> np.ndarray:
    """SimHash of each text's word shingles, zero for a text without words."""
    data, starts, ends, words = _joined(texts)
    counts = words.counts
    short = (counts > 0) & (counts < shingle)
    grams = words.grams(shingle)
    first = words.bounds[:-1][short]
    begins = np.concatenate([grams, first])
    order = np.argsort(begins, kind="stable")
    last = np.concatenate([grams + shingle - 1, words.bounds[1:][short] - 1])[order]
    begins = begins[order]
    hashes = xxh64(data, starts[begins], ends[last], seed)

    out = np.zeros(len(texts), np.uint64)
    total = np.where(short, 1, np.maximum(counts - shingle + 1, 0))
    some = np.flatnonzero(total)
    if not len(some):
        return out
    # Bits are counted in byte lanes, so a block has at most 255 hashes.
    blocks = -(-total[some] // 255)
    block_of = np.repeat(np.arange(len(some)), blocks)
    number = np.arange(len(block_of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = (np.cumsum(total[some]) - total[some])[block_of] + 255 * number
    heads = np.flatnonzero(np.diff(block_of, prepend=-1))
    limit = total[some] // 2
    ones = np.uint64(0x0101010101010101)
    for j in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(j)) & ones, begin)
        counted = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), heads, axis=0)
        for k in range(8):
            out[some] |= (counted[:, k] > limit).astype(np.uint64) << np.uint64(8 * k + j)
    return out


def with_fingerprint(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(fingerprints(texts, shingle).view(np.int64))], ["doc_id", "fp"]
                )

    return stream_texts(id_and_text(docs)).mapInArrow(
        released(run), "doc_id long, fp long"
    )


# Parts and thresholds -------------------------------------------------------------------------------


def bit_counts(distinct: DataFrame) -> np.ndarray:
    """65 x 64 sums over all fingerprints: of the products of two bits, and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((64, 64)), 0
        for batch in batches:
            fps = ints(batch, "fp").view(np.uint64)
            for i in range(0, len(fps), 1 << 16):
                bits = np.unpackbits(fps[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                total += bits.T.astype(np.float32) @ bits.astype(np.float32)
            rows += len(fps)
        if rows:
            yield pa.RecordBatch.from_pydict({"i": list(range(4097)), "n": [*total.ravel().tolist(), float(rows)]})

    out = np.zeros(4097)
    for row in distinct.select("fp").mapInArrow(released(run), "i long, n double").groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[row["i"]] = row["n"]
    return out


def parts_of_bits(counts: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in parts of nearly equal width; each part grows by the bit that correlates most with it."""
    rows = max(counts[4096], 1)
    both = counts[:4096].reshape(64, 64) / rows
    p = np.diag(both)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both - np.outer(p, p)) / np.outer(spread, spread))
    free, out = set(range(64)), []
    for k in range(parts):
        width = 64 // parts + (k < 64 % parts)
        rest = sorted(free)
        pairs = corr[np.ix_(rest, rest)] * (1 - np.eye(len(rest)))
        part = [rest[int(pairs.sum(1).argmax())]]
        free.discard(part[0])
        while len(part) < width:
            best = max(sorted(free), key=lambda b: corr[b, part].sum())
            part.append(best)
            free.discard(best)
        out.append(sorted(part))
    return out


def allocate(costs: list[dict[int, float]], total: int) -> list[int]:
    """Thresholds that add up to `total` at the least sum of costs: costs[part][threshold]."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        ahead: dict[int, tuple[float, list[int]]] = {}
        for done, (spent, chosen) in best.items():
            for t, c in cost.items():
                option = (spent + c, [*chosen, t])
                if done + t not in ahead or option < ahead[done + t]:
                    ahead[done + t] = option
        best = ahead
    return best[total][1]


def _value(part: list[int]):
    """The part's bits of fp, in place."""
    mask = sum(1 << b for b in part)
    return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def thresholds(distinct: DataFrame, counts: np.ndarray, parts: list[list[int]], distance: int) -> list[int]:
    """By the number of candidates: pairs that share a value are counted, those a few bits away are
    estimated from the bits' frequencies, and each probe costs as much as a candidate."""
    rows = max(counts[4096], 1)
    p = np.diag(counts[:4096].reshape(64, 64)) / rows
    odds = 2 * p * (1 - p) / np.maximum(1 - 2 * p * (1 - p), 1e-9)
    pairs = dict(
        distinct.select(F.explode(F.array(*[F.struct(F.lit(k).alias("part"), _value(b).alias("value"))
                                            for k, b in enumerate(parts)])).alias("x"))
        .groupBy("x.part", "x.value").agg(F.count("*").cast("double").alias("n"))
        .groupBy("part").agg(F.sum(F.col("n") * F.col("n")).alias("n"))
        .collect()
    )
    costs = []
    for k, bits in enumerate(parts):
        cost, near, probes = {-1: 0.0}, 1.0, 1.0
        for t in range(distance + 1):
            cost[t] = pairs.get(k, 0.0) * near + rows * probes
            near *= 1 + odds[bits].sum() / (t + 1)
            probes *= 1 + len(bits) / (t + 1)
        costs.append(cost)
    return allocate(costs, distance - len(parts) + 1)


# Probing, verifying, components -----------------------------------------------------------------------


def _flips(part: list[int], threshold: int) -> list[int]:
    """Masks of up to `threshold` bits of a part, the empty one first."""
    masks = [0]
    layer = [(0, -1)]
    for _ in range(threshold):
        layer = [(m | 1 << b, b) for m, top in layer for b in part if b > top]
        masks += [m for m, _ in layer]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each fingerprint to the smallest one that it reaches over links of at most that distance."""
    fps = np.unique(fps)
    label = np.arange(len(fps))
    bits = fps.view(np.uint64)
    near = [np.flatnonzero(np.bitwise_count(bits ^ b) <= distance) for b in bits]
    while True:
        new = np.array([label[x].min() for x in near])
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def links(distinct: DataFrame, parts: list[list[int]], limits: list[int], distance: int, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that span every group of fingerprints within the distance of each other."""
    probes = [
        F.struct(F.lit(k).alias("part"), _value(bits).bitwiseXOR(F.lit(m).cast("long")).alias("value"))
        for k, (bits, t) in enumerate(zip(parts, limits)) if t >= 0 for m in _flips(bits, t)
    ]
    members = distinct.select("fp", F.explode(F.array(*probes)).alias("x")).select("fp", "x.part", "x.value")
    hot = saved(members.groupBy("part", "value").count().where(F.col("count") > bucket).drop("count"), "hot-values")
    if hot.count() <= HOT_VALUES:
        hot = F.broadcast(hot)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [forest(np.asarray(x, np.int64), distance) for x in batch.column(0).to_numpy(zero_copy_only=False)]
            a = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
            b = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    small = (
        members.join(hot, ["part", "value"], "left_anti")
        .groupBy("part", "value").agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1).select("fps").mapInArrow(gather, "a long, b long")
    )
    large = members.join(hot, ["part", "value"], "left_semi").select("fp").distinct()
    near = large.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in _flips(list(range(64)), (distance + 1) // 2)]).alias("m")).alias("m"))
    star = near.select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("middle"))
    if distance % 2:
        raise ValueError("large buckets are split for even distances")
    low = star.groupBy("middle").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b < top")
    crowded = star.join(low, "middle").where("fp != b").select(F.col("fp").alias("a"), "b")
    return small.unionByName(crowded).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): every end of a link with the smallest end that it reaches.

    Each round takes the smallest label among the neighbours and then the label's own label, which
    about doubles the reach; every round is written to the shared folder.
    """
    both = saved(edges.select("a", "b").union(edges.select("b", "a")), "links")
    label = saved(both.groupBy(F.col("a").alias("fp")).agg(F.min("b").alias("l"))
                  .select("fp", F.least("fp", "l").alias("root")), "labels")
    while True:
        around = both.join(label, F.col("b") == F.col("fp")).groupBy("a").agg(F.min("root").alias("seen"))
        step = label.join(around, F.col("fp") == F.col("a")).select(
            "fp", F.col("root").alias("old"), F.least("root", "seen").alias("root"))
        jump = label.select(F.col("fp").alias("via"), F.col("root").alias("far"))
        new = saved(step.join(jump, F.col("root") == F.col("via"), "left").select(
            "fp", "old", F.least("root", F.coalesce("far", "root")).alias("root")), "labels")
        label = new.select("fp", "root")
        if new.where("root != old").isEmpty():
            return label


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, parts: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    fingerprint: 16 lower-case hex digits. component_id: the smallest doc_id reachable over links.
    A null or blank text has the fingerprint zero, which links like any other. Rows without a doc_id get
    a fingerprint; their component is the smallest doc_id that is there, null if none is. Repeated rows stay
    repeated. An empty table gives no rows.
    """
    fps = saved(with_fingerprint(docs, shingle), "fingerprints")
    distinct = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    counts = bit_counts(distinct)
    groups = parts_of_bits(counts, parts)
    limits = thresholds(distinct, counts, groups, distance)
    label = components(links(distinct, groups, limits, distance))
    rooted = distinct.join(label, "fp").select("fp", "least", "root")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = saved(rooted.join(least, "root").select("fp", "component_id"), "components")
    classes = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return fps.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """The columns of docs, for one document of each component: that of the smallest doc_id.

    Repeated rows become one; rows that share a doc_id but not the text all stand for that document.
    Rows without a doc_id stay as they are.
    """
    groups = near_duplicates(docs.where("doc_id IS NOT NULL"), shingle, distance)
    heads = groups.select(F.col("component_id").alias("doc_id")).distinct()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), whole_row(docs).alias("row"))
    one = Window.partitionBy("doc_id", "digest").orderBy(F.xxhash64("row"))
    first = rows.join(heads, "doc_id", "left_semi").withColumn("copy", F.row_number().over(one)).where("copy = 1")
    return first.select("row.*").union(docs.where("doc_id IS NULL"))
