"""Ranked lexical search without an index of the documents: an Aho-Corasick scan for all items' terms.

The items' distinct terms, each between two guards, make up one automaton. A text is handed to it with A-Z
lower-cased and every sign that belongs to no term turned into a guard, so a term is met exactly where it
stands as a whole one, and its occurrences are counted straight from the text. The automaton's outputs
are term numbers; a list per term leads on to the items that hold it.

There are two scans. The first counts documents, terms and the documents that hold each term; the second
weighs, scores and keeps each item's best documents per task, which a window over parts of an item, and one
over the parts' winners, cut to the best of all. No document is shuffled and no list of documents is kept.

Items are worked through in blocks whose (item, term) rows take at most about BLOCK_BYTES, measured; a
block's terms are what is broadcast. Only an item that outgrows a block by itself makes a larger one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from quotidian.llm import columns
from quotidian.llm.scratch import id_and_text, saved, stream_texts
from quotidian.llm.text import ALNUM, LOWER, Texts, column, ints, pieces

KEEP = 50
#: Bytes of an item block's terms, and of the row that each of an item's terms takes besides.
BLOCK_BYTES, ROW_BYTES = 4 << 20, 24
#: Scores (documents by items) that a task works out at once.
CELLS = 1 << 21
#: Parts that an item's candidates are cut in before the last cut.
PARTS = 64
GUARD = 10
#: Rows of the first scan that are no term: documents with a term, and terms.
DOCS, TERMS = -2, -1


@dataclass
class Items:
    """A block of items: its distinct terms, and for each of them the items that hold it."""

    terms: list[bytes]
    bounds: np.ndarray
    items: np.ndarray
    count: int


class Scanner:
    """The automaton of a block's terms."""

    def __init__(self, terms: list[bytes]):
        self.size = len(terms)
        self.automaton = ahocorasick.Automaton()
        guard = chr(GUARD)
        for number, term in enumerate(terms):
            self.automaton.add_word(guard + term.decode("latin-1") + guard, number)
        self.automaton.make_automaton()

    def __call__(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text; and text, term and occurrences of each term met in a text, by text."""
        lower = LOWER[texts.data]
        flat = np.insert(np.where(ALNUM[lower], lower, np.uint8(GUARD)), texts.bounds, GUARD)
        between = texts.bounds + np.arange(len(texts) + 1)
        inside = flat != GUARD
        begun = np.zeros(len(flat), np.int64)
        np.cumsum(inside[1:] & ~inside[:-1], out=begun[1:])
        ends = np.zeros(0, np.int64)
        if self.size:
            found = self.automaton.iter(flat.tobytes().decode("latin-1"))
            ends = np.fromiter(((end << 32) | term for end, term in found), np.int64)
        text = np.searchsorted(between, ends >> 32) - 1
        pairs, tf = np.unique(text * max(self.size, 1) + (ends & 0xFFFFFFFF), return_counts=True)
        text, term = np.divmod(pairs, max(self.size, 1))
        return np.diff(begun[between]), text, term, tf


def item_terms(benchmark: DataFrame) -> DataFrame:
    """(item_id, term), each pair once."""
    return saved(benchmark.select(
        "item_id", F.explode(F.array_distinct(columns.terms(F.col("text")))).alias("term")).distinct(), "item-terms")


def blocks_of(pairs: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """The pairs, all of an item together, in blocks that are halved until each is small or one item."""
    weight = F.sum(F.octet_length("term") + ROW_BYTES)
    total = pairs.agg(weight).first()[0] or 0
    parts = max(1, -(-total // limit))
    while True:
        block = F.pmod(F.xxhash64("item_id"), F.lit(parts))
        crowded = pairs.groupBy(block.alias("block")).agg(
            weight.alias("held"), F.min(F.xxhash64("item_id")).alias("a"), F.max(F.xxhash64("item_id")).alias("b"))
        if crowded.where((F.col("held") > 2 * limit) & (F.col("a") != F.col("b"))).isEmpty():
            break
        parts *= 2
    for part in range(parts if total else 0):
        table = pairs.where(block == part).toArrow()
        if table.num_rows:
            yield table


def block_items(table: pa.Table) -> tuple[Items, pa.Array]:
    """The block, and the ids of its items by number."""
    by_item = table["item_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    by_term = table["term"].combine_chunks().dictionary_encode()
    item, term = by_item.indices.to_numpy(), by_term.indices.to_numpy()
    terms = [t.encode() for t in by_term.dictionary.to_pylist()]
    order = np.argsort(term, kind="stable")
    bounds = np.searchsorted(term[order], np.arange(len(terms) + 1))
    return Items(terms, bounds, item[order].astype(np.int64), len(by_item.dictionary)), by_item.dictionary


def _counting(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, docs, words = Scanner(shared.value.terms), 0, 0
        held = np.zeros(scan.size, np.int64)
        for batch in batches:
            for _, texts in pieces(batch, "text"):
                n, _, term, _ = scan(texts)
                docs, words = docs + int((n > 0).sum()), words + int(n.sum())
                held += np.bincount(term, minlength=scan.size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([DOCS, TERMS, *some.tolist()], pa.int64()), pa.array([docs, words, *held[some].tolist()], pa.int64())],
            ["term", "n"])

    return run


class Best:
    """Each item's best documents so far."""

    def __init__(self, items: int, keep: int):
        self.keep, self.floor = keep, np.ones(items, np.int64)  # a score above 0 counts
        self.rows = np.zeros((4, 0), np.int64)  # item, score, missing id, id

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        """scores: a row for each document. What stays below an item's floor can't be among its best."""
        if len(scores) > self.keep:
            at = len(scores) - self.keep
            np.maximum(self.floor, np.partition(scores, at, axis=0)[at], out=self.floor)
        doc, item = np.nonzero(scores >= self.floor)
        rows = np.concatenate([self.rows, [item, scores[doc, item], missing[doc], ids[doc]]], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])
        nth = np.arange(rows.shape[1]) - first
        last = nth == self.keep - 1
        self.floor[rows[0, last]] = np.maximum(self.floor[rows[0, last]], rows[1, last])
        self.rows = rows[:, nth < self.keep]


def _ranking(shared, weights, total_docs: int, total_terms: int, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = shared.value, weights.value
        scan, best = Scanner(block.terms), Best(block.count, keep)
        step = max(1, CELLS // max(block.count, 1))
        for batch in batches:
            for piece, texts in pieces(batch, "text"):
                n, text, term, tf = scan(texts)
                if not len(text):
                    continue
                ids = ints(piece, "doc_id", 0)
                missing = np.asarray(column(piece, "doc_id").is_null(), np.int64)
                # whole numbers of any length, since 50 * n * N may outgrow 64 bits
                m = np.array([100 - 50 + 50 * int(k) * total_docs // max(total_terms, 1) for k in n], np.int64)
                gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[text]))
                many = np.diff(block.bounds)[term]
                for low in range(0, len(texts), step):
                    high = min(low + step, len(texts))
                    mine = slice(*np.searchsorted(text, [low, high]))
                    reach = many[mine]
                    places = np.arange(int(reach.sum())) + np.repeat(
                        block.bounds[term[mine]] - (np.cumsum(reach) - reach), reach)
                    cell = np.repeat((text[mine] - low) * block.count, reach) + block.items[places]
                    scores = np.zeros((high - low) * block.count, np.int64)
                    np.add.at(scores, cell, np.repeat(gain[mine], reach))
                    best.add(scores.reshape(high - low, block.count), ids[low:high], missing[low:high])
        item, score, gone, doc = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(doc, mask=gone.astype(bool)), pa.array(score)], ["item", "doc_id", "score"])

    return run


def _cut(found: DataFrame, keep: int) -> DataFrame:
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    within = Window.partitionBy("item", "part").orderBy(*best)
    found = found.withColumn("part", part).withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= keep)
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(
        F.col("rank") <= keep)


def rank(docs: DataFrame, benchmark: DataFrame, keep: int = KEEP, limit: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `keep` documents with the highest scores above 0.

    Null and empty texts hold no term. Items of one id are one item with all their terms; those without
    an id are one whose id is null. Items without terms, and those of an empty benchmark, give no rows.
    Every row of docs is a document, whether or not its doc_id repeats; one without a doc_id comes after
    the others of its score. Texts may be of any length.
    """
    spark, texts = docs.sparkSession, id_and_text(docs)
    kind = StructType([
        StructField("item_id", benchmark.schema["item_id"].dataType), StructField("rank", IntegerType()),
        StructField("doc_id", LongType()), StructField("score", LongType())])
    out = spark.createDataFrame([], kind)
    for table in blocks_of(item_terms(benchmark), limit):
        block, item_ids = block_items(table)
        shared = spark.sparkContext.broadcast(block)
        counts = dict(map(tuple, stream_texts(texts).mapInArrow(_counting(shared), "term long, n long").groupBy(
            "term").agg(F.sum("n")).collect()))
        n_docs, n_terms = counts.get(DOCS, 0), counts.get(TERMS, 0)
        weights = spark.sparkContext.broadcast(np.array([
            math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(i, 0) + 1))) for i in range(len(block.terms))],
            np.int64))
        found = stream_texts(texts).mapInArrow(
            _ranking(shared, weights, n_docs, n_terms, keep), "item long, doc_id long, score long")
        names = spark.createDataFrame(pa.table({"item": pa.array(np.arange(len(item_ids))), "item_id": item_ids}))
        out = out.unionByName(_cut(found, keep).join(F.broadcast(names), "item").select(
            F.col("item_id").cast(kind["item_id"].dataType), "rank", "doc_id", "score"))
    return out


#: The same from an inverted list of all terms.
SQL = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, {columns.SQL_TERMS % "text"} AS words FROM documents
), sizes AS (
  SELECT rid, doc_id, len(words)::BIGINT AS n FROM docs WHERE len(words) > 0
), whole AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes
), held AS (
  SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(words) AS term FROM docs) GROUP BY rid, term
), wanted AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({columns.SQL_TERMS % "text"}) AS term FROM benchmark)
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), whole
), scored AS (
  SELECT item_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM wanted JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (rid), whole
  GROUP BY item_id, rid
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS r
  FROM scored JOIN sizes USING (rid) WHERE score > 0
)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked WHERE r <= {KEEP}
"""
