"""Mixing sources to target weights by systematic sampling; DataFrame operations only.

A source's documents are laid out in one order and each takes up the expected number of copies, the
source's target divided by its size. One random offset is added, and a document is emitted once for
every integer boundary within its stretch. The order goes by size class first, so the words taken stay
close to the target.

The prefix sum has two levels: documents are numbered within small buckets (source, size class, a range
of a hash), and the buckets' counts are summed ahead of them. No window holds a source's documents. The
order of documents, and so the sample, doesn't depend on the number of buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotidian.llm.scratch import saved, whole_row

WORD = r"[^\x20\x09-\x0D]+"
SEED = "42"
#: Documents per hash range and size class, at most about this many.
BUCKET_ROWS = 50_000
#: A target is at most so many times the size of its source.
MOST = 3


def _unit(text):
    """32 bits of a hash as a long."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def _source_key(source):
    """A source's name that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def targets(sizes: DataFrame) -> DataFrame:
    """(_key, source_size, target, _rate, _offset) per source, from rows (source, _key, size).

    Weights are 1, 2, 3, repeating, in the order of the sources' code points, null last. Sources are taken
    in the order in which they reach their limit: as long as the share of what is left would exceed a
    source's limit it gets the limit, all later ones share the rest by weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_source = sizes.groupBy("_key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size")
    ).withColumn("w", (F.row_number().over(order) - 1) % 3 + 1)
    limit = by_source.withColumn("limit", F.col("source_size") * MOST)
    filling = Window.orderBy(F.col("limit") / F.col("w"), "_key")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    share = left / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    stepped = limit.withColumn("share", share).withColumn("full", F.col("limit") <= F.col("w") * F.col("share"))
    rest = F.max(F.when(~F.col("full"), F.col("share"))).over(every)
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(F.col("w") * rest)
    return stepped.select(
        "_key", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("_rate"),
        (_unit(F.concat(F.lit(SEED + "|"), "_key")) / F.lit(4294967296.0)).alias("_offset"),
    )


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and text of docs with what their place in the mix depends on: size, source key, size class, place by hash, and a
    digest of the text that orders rows of one doc_id."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    bits = F.bin("_size")
    return docs.withColumn("_size", size).withColumns({
        "_key": _source_key(F.col("source")),
        "_class": F.length(bits) * 8 + F.conv(F.substring(bits, 1, 3), 2, 10).cast("int"),
        "_at": _unit(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
        "_digest": F.xxhash64("text"),
    })


def with_copies(rows: DataFrame, slim: DataFrame) -> DataFrame:
    """rows, as from sized(), with source_size, target and _copies. slim: the same rows; only their place
    columns are read from it, for the sums over whole sources.

    Size: words of the whole text, null and empty ones have none. Rows without a doc_id are ordered as if
    it were empty. Repeated rows are separate documents. Sources without words have the target zero and
    are not emitted. An empty table gives no rows.
    """
    buckets = max(1, -(-slim.count() // BUCKET_ROWS))
    within = F.floor(F.col("_at") * buckets / F.lit(4294967296.0))
    bucket = ["_key", "_class", "_range"]
    counts = saved(slim.withColumn("_range", within).groupBy(*bucket).agg(
        F.count("*").alias("n"), F.sum("_size").alias("size"), F.first("source").alias("source")), "mix-buckets")
    ahead = Window.partitionBy("_key").orderBy("_class", "_range").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(*bucket, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_ahead")).join(
        targets(counts.select("source", "_key", "size")), "_key")
    inside = Window.partitionBy(*bucket).orderBy("_at", "doc_id", "_size", "_digest")
    i = F.col("_ahead") + F.row_number().over(inside) - 1
    crossed = F.floor(F.col("_offset") + F.col("_rate") * (F.col("_i") + 1)) - F.floor(
        F.col("_offset") + F.col("_rate") * F.col("_i"))
    return rows.withColumn("_range", within).join(placed, bucket).withColumn("_i", i).withColumn(
        "_copies", F.least(crossed, F.lit(MOST)).cast("int"))


def _slim(docs: DataFrame) -> DataFrame:
    return saved(sized(docs.select("doc_id", "source", "text")).select("doc_id", "source", "_size", "_key", "_class", "_at", "_digest"), "mix-sizes")


def mixed(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row; taken counts the words of all its copies."""
    slim = _slim(docs)
    return with_copies(slim, slim).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        (F.col("_copies") * F.col("_size")).alias("taken"))


def emit(docs: DataFrame) -> DataFrame:
    """The rows of docs, each as often as the mix takes it."""
    rows = sized(docs.select("doc_id", "source", "text", whole_row(docs).alias("_row"))).drop("text")
    return with_copies(rows, _slim(docs)).where("_copies > 0").withColumn(
        "_nth", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")


#: The same order, targets and boundaries in the other engine.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS place,
         text
  FROM documents
), sources AS (
  SELECT k, min(source) AS source, sum(size)::BIGINT AS source_size FROM sized GROUP BY k
), weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w, 3 * source_size AS cap FROM sources
), stepped AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce((sum(cap) OVER before), 0)::BIGINT)::DOUBLE
            / ((sum(w) OVER ())::BIGINT - coalesce((sum(w) OVER before), 0)::BIGINT)::DOUBLE AS share
  FROM weighed
  WINDOW before AS (ORDER BY cap::DOUBLE / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (
  SELECT *, CASE WHEN cap <= w * share THEN cap::DOUBLE
                 ELSE w * max(CASE WHEN NOT cap <= w * share THEN share END) OVER () END AS target
  FROM stepped
), placed AS (
  SELECT s.*, f.source_size, f.target,
         CASE WHEN f.source_size > 0 THEN f.target / f.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('42|' || s.k), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS off,
         row_number() OVER (PARTITION BY s.k
           ORDER BY length(bin(size)) * 8 + (size >> greatest(length(bin(size)) - 3, 0)::INT), place, doc_id, size) - 1 AS i
  FROM sized s JOIN filled f ON s.k = f.k
)
SELECT doc_id, size, source_size, target,
       (least(floor(off + rate * (i + 1)) - floor(off + rate * i), 3)::BIGINT * size)::BIGINT AS taken
FROM placed
"""
