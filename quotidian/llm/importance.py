"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are counted: one of the raw text, over all documents, and one of
the target, over at most FIT_ROWS of the rows labelled good and not toxic. A document's log weight is the sum of log p(target) / p(raw)
over its n-grams, divided by the root of their number so that length alone decides nothing. The documents
kept are a Gumbel top-k sample: the k largest of log weight plus Gumbel noise, with k the number of
documents whose weight passes the cut that errs least on the labelled rows.

n-grams are words (lower-case letters and digits), their first 4, 5 and 6 bytes, runs of other signs and
pairs of neighbouring words. The target model is drawn towards the raw one where a bucket is rarely
seen, so that rare words cannot outvote common ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotidian.llm.scratch import id_and_text, released, saved, stream_texts
from quotidian.llm.text import (
    ALNUM, Texts, byte_class, column, hash_grams, ints, mix, pieces, nameable, range_names, sums, words_of,
)

#: Buckets of hashed n-grams: bounds the models (two counts each) and what is broadcast (4 bytes each).
BUCKETS = 1 << 20
#: Buckets counted per row of the reduction.
BLOCK = 1 << 14
SIGNS = byte_class(bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum()))
PREFIXES = (4, 5, 6)
#: Labelled good documents that the target model is counted on, taken by a hash of their ids: bounds what
#: is broadcast (8 bytes each), so that no text is shuffled.
FIT_ROWS = 200_000
#: Pseudo-count, and the expected count at which a bucket's ratio gets half its weight.
SMOOTH, TRUST = 0.5, 40.0
#: Scale of the Gumbel noise, in spreads of the labelled rows' weights.
TEMPERATURE = 0.02
SEED = 42


def ngrams(texts: Texts, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every n-gram, ordered by text."""
    lower = texts.lower()
    words = words_of(lower, ALNUM)
    padded = nameable(lower.data)
    names = range_names(padded, words.starts, words.ends)
    owner = words.owner()
    signs = words_of(texts, SIGNS)
    found = [names, range_names(padded, signs.starts, signs.ends)]
    owners = [owner, signs.owner()]
    for n in PREFIXES:
        long = words.ends - words.starts >= n
        found.append(mix(range_names(padded, words.starts[long], words.starts[long] + n) + np.uint64(n)))
        owners.append(owner[long])
    pairs = words.grams(2)
    found.append(hash_grams(names, pairs, 2))
    owners.append(owner[pairs])
    where = np.concatenate(owners)
    order = np.argsort(where, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(buckets)).astype(np.int64), where[order]


def count_models(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """2 x buckets: n-grams of all documents, and of those labelled good and not toxic."""
    good = (labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL")
            .select(F.col("doc_id").alias("_good_id")).distinct()
            .orderBy(F.xxhash64("_good_id"), "_good_id").limit(FIT_ROWS))
    rows = id_and_text(docs).join(F.broadcast(good), F.col("doc_id") == F.col("_good_id"), "left").select(
        "text", F.col("_good_id").isNotNull().cast("long").alias("good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for piece, texts in pieces(batch, "text"):
                found, owner = ngrams(texts, buckets)
                good = ints(piece, "good").astype(bool)
                total[0] += np.bincount(found, minlength=buckets)
                total[1] += np.bincount(found[good[owner]], minlength=buckets)
        if total[0].any():
            parts = [total[:, i : i + BLOCK].astype("<i8").tobytes() for i in range(0, buckets, BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(counts.as_buffer(), "<i8")
                total[block] = total[block] + values if block in total else values
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
            ["block", "counts"])

    kind = "block int, counts binary"
    out = np.zeros((2, buckets), np.int64)
    for row in stream_texts(rows).mapInArrow(released(count), kind).repartition("block").mapInArrow(add, kind).collect():
        part = np.frombuffer(row["counts"], "<i8").reshape(2, -1)
        out[:, row["block"] * BLOCK : row["block"] * BLOCK + part.shape[1]] = part
    return out


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Per bucket; zero where there is no target text."""
    raw, target = counts.astype(float)
    if not target.sum():
        return np.zeros(len(raw), np.float32)
    expected = raw / raw.sum() * target.sum()
    return (np.log((target + SMOOTH) / (expected + SMOOTH)) * expected / (expected + TRUST)).astype(np.float32)


def weights(texts: Texts, ratios: np.ndarray) -> np.ndarray:
    found, owner = ngrams(texts, len(ratios))
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    return sums(ratios[found].astype(np.float64), bounds) / np.sqrt(np.maximum(np.diff(bounds), 1))


def gumbel(ids: np.ndarray, seed: int) -> np.ndarray:
    u = (mix(ids.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(float)
    return -np.log(-np.log((u + 0.5) / 2.0**53))


def with_weight(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """(doc_id, log_weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [column(piece, "doc_id"), pa.array(weights(texts, shared.value))], ["doc_id", "log_weight"])

    return stream_texts(id_and_text(docs)).mapInArrow(released(run), "doc_id long, log_weight double")


def best_cut(scored: DataFrame, labels: DataFrame, bins: int = 2048) -> tuple[float, float]:
    """(cut, spread): the weight at which the labelled rows are told apart with the fewest errors, and the
    distance between the means of the two kinds. No cut (minus infinity) if one kind is missing."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(((F.col("quality") != 1) | (F.coalesce("toxic", F.lit(0)) != 0)).cast("int")).alias("bad"))
    rows = scored.join(known, "doc_id").select("log_weight", "bad")
    kinds = {r["bad"]: r for r in rows.groupBy("bad").agg(
        F.avg("log_weight").alias("m"), F.min("log_weight").alias("low"), F.max("log_weight").alias("high")).collect()}
    if len(kinds) < 2:
        return float("-inf"), 0.0
    low = min(r["low"] for r in kinds.values())
    width = max((max(r["high"] for r in kinds.values()) - low) / bins, 1e-9)
    table = np.zeros((2, bins + 1))
    place = F.floor((F.col("log_weight") - low) / width).cast("int")
    for r in rows.groupBy("bad", F.least(place, F.lit(bins)).alias("bin")).count().collect():
        table[r["bad"], r["bin"]] = r["count"]
    errors = np.concatenate([[0], np.cumsum(table[0])]) + table[1].sum() - np.concatenate([[0], np.cumsum(table[1])])
    return low + width * int(errors.argmin()), abs(kinds[0]["m"] - kinds[1]["m"])


def kth_largest(keys: DataFrame, k: int, bins: int = 4096) -> int:
    """The k-th largest of a long column `key`, by a few rounds of histograms over all rows."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    while low < high:
        width = -(-(high - low + 1) // bins)
        found = keys.where(F.col("key").between(low, high)).groupBy(
            F.floor((F.col("key") - low) / width).alias("bin")).count().collect()
        above = keys.where(F.col("key") > high).count()
        for row in sorted(found, key=lambda r: -r["bin"]):
            above += row["count"]
            if above >= k:
                low, high = low + row["bin"] * width, min(high, low + (row["bin"] + 1) * width - 1)
                break
    return low


def resampled(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> tuple[DataFrame, np.ndarray, float, int]:
    """(doc_id, log_weight, key), the ratios, the scale of the noise, and the least key that is kept."""
    ratios = log_ratios(count_models(docs, labels))
    scored = saved(with_weight(docs, ratios), "weights")
    cut, spread = best_cut(scored, labels)
    scale = TEMPERATURE * spread
    keyed = saved(with_key(scored, scale, seed), "keys")
    k = scored.where(F.col("log_weight") >= cut).count()
    least = kth_largest(keyed, k) if k else 1 << 62
    return keyed, ratios, scale, least


def key_of(weight: np.ndarray, ids: np.ndarray, scale: float, seed: int) -> np.ndarray:
    """Weight plus noise, in units of 2 ** -32."""
    return np.floor(np.clip(weight + scale * gumbel(ids, seed), -1e8, 1e8) * 2.0**32).astype(np.int64)


def with_key(scored: DataFrame, scale: float, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = column(batch, "log_weight").to_numpy(zero_copy_only=False)
            key = pa.array(key_of(weight, ints(batch, "doc_id"), scale, seed))
            yield pa.RecordBatch.from_arrays([*batch.columns, key], ["doc_id", "log_weight", "key"])

    return scored.mapInArrow(released(run), "doc_id long, log_weight double, key long")


def classify(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, log_weight, kept) of every row.

    A null or empty text has weight 0. Without labelled rows of both kinds every document is kept. Rows
    that tie with the last one kept are kept, so repeated rows share their fate. Rows without a doc_id
    share one draw of the noise.
    """
    keyed, _, _, least = resampled(docs, labels, seed)
    return keyed.select("doc_id", "log_weight", (F.col("key") >= least).alias("kept"))


def keep_sampled(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of docs, with all their columns, that the sample keeps. They are weighed again as they
    stream by, which is cheaper than a join of whole texts."""
    _, ratios, scale, least = resampled(docs, labels, seed)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in pieces(batch, "text"):
                key = key_of(weights(texts, shared.value), ints(piece, "doc_id"), scale, seed)
                yield piece.filter(pa.array(key >= least))

    return stream_texts(docs).mapInArrow(released(run), docs.schema)
