"""Benchmark decontamination with one FM-index per training shard.

A shard is a piece of a partition's texts. Its words, as numbers of the benchmark's vocabulary, with a
separator after every text, are suffix-sorted by prefix doubling; the Burrows-Wheeler transform is held
in a wavelet matrix. All windows of the benchmark are searched backwards at once, each step two ranks per
window; the rows of the surviving intervals are walked back to the nearest sampled suffix position, and
the spans found are merged into the words to remove.

Tasks make the benchmark's windows, in blocks whose arrays take at most BLOCK_BYTES, measured, or which hold
one item; the driver takes one block after the other and broadcasts it. The documents stream through one
search per block and are written between two, so that no task, worker or broadcast ever holds more than
one block. No document is shuffled.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from quotidian.llm.scratch import id_and_text, released, saved, stream_texts
from quotidian.llm.text import ALNUM, Texts, Words, column, hash_words, pieces, texts_of, words_of

WINDOW = 10
#: Bytes of the windows that are broadcast at once, and those that a word and an item take at most.
BLOCK_BYTES, WORD_BYTES, ITEM_BYTES = 16 << 20, 32, 128
#: Bytes of text that one index is built over.
SHARD = 4 << 20
#: Every so many positions of a shard, the suffix array is kept.
SAMPLE = 8


def names_of(texts: Texts) -> tuple[Words, np.ndarray]:
    lower = texts.lower()
    words = words_of(lower, ALNUM)
    return words, hash_words(lower.data, words.starts, words.ends)


@dataclass
class Patterns:
    """Distinct windows of a block of items, each a run of the items' words, which are numbered from 3 on."""

    vocabulary: np.ndarray  # sorted names of words
    words: np.ndarray  # all items' words, one after the other
    starts: np.ndarray  # first word and number of words of each window
    sizes: np.ndarray
    item_bounds: np.ndarray  # items of each window, in `items`
    items: np.ndarray
    item_ids: list[str]


def run_numbers(words: np.ndarray, size: int) -> np.ndarray:
    """For each place a number that two runs of `size` words share if, and only if, they are equal. A run is told
    by two shorter ones that cover it."""
    number, width = words.astype(np.int64), 1
    while width < size:
        step = min(width, size - width)
        key = number[:-step] * (number.max(initial=0) + 1) + number[step:]
        number, width = np.unique(key, return_inverse=True)[1].astype(np.int64), width + step
    return number


def patterns_of(item_ids: list[str], texts: Texts, width: int) -> Patterns:
    words, names = names_of(texts)
    vocabulary, numbers = np.unique(names, return_inverse=True)
    counts, at, size, alike, known = words.counts, [], [], [], 0
    for n in np.unique(np.minimum(counts[counts > 0], width)).tolist():
        begin = words.grams(n) if n == width else words.bounds[:-1][counts == n]
        number = run_numbers(numbers, n)[begin]
        at.append(begin)
        size.append(np.full(len(begin), n))
        alike.append(number + known)
        known += int(number.max(initial=-1)) + 1
    none = np.zeros(0, np.int64)
    at, size, alike = (np.concatenate([none, *x]) for x in (at, size, alike))
    _, first, which = np.unique(alike, return_index=True, return_inverse=True)
    owner = np.searchsorted(words.bounds, at, "right") - 1
    which, owner = np.divmod(np.unique(which * max(len(texts), 1) + owner), max(len(texts), 1))
    return Patterns(
        vocabulary, (numbers + 3).astype(np.int32), at[first].astype(np.int32), size[first].astype(np.int32),
        np.searchsorted(which, np.arange(len(first) + 1)).astype(np.int32), owner.astype(np.int32), item_ids)


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """Order of all suffixes. The first keys hold as many letters as fit; then ranks of prefixes are doubled,
    and only suffixes that still tie are sorted again."""
    n = len(text)
    bits = max(int(letters).bit_length(), 1)
    step = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for j in range(step):
        key = key << bits
        if j < n:
            key[: n - j] |= text[j:]
    order = np.argsort(key)
    changed = np.ones(n, bool)
    sorted_key = key[order]
    changed[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(n, np.int64)
    head = np.flatnonzero(changed)
    group = np.repeat(head, np.diff(np.append(head, n)))
    rank[order] = group
    tied = ~(changed & np.append(changed[1:], True))
    places = np.flatnonzero(tied)
    while len(places):
        suffix = order[places]
        ahead = np.where(suffix + step < n, rank[np.minimum(suffix + step, n - 1)] + 1, 0)
        key = (rank[suffix] << 31) | ahead
        by = np.argsort(key)
        suffix, key = suffix[by], key[by]
        order[places] = suffix
        new = np.ones(len(places), bool)
        new[1:] = key[1:] != key[:-1]
        head = np.flatnonzero(new)
        rank[suffix] = np.repeat(places[head], np.diff(np.append(head, len(places))))
        places = places[~(new & np.append(new[1:], True))]
        step *= 2
    return order


class WaveletMatrix:
    """Ranks of letters in a sequence, one bit level at a time from the highest."""

    def __init__(self, text: np.ndarray, letters: int):
        self.bits = max(int(letters).bit_length(), 1)
        self.ones, self.zeros = [], []
        for level in reversed(range(self.bits)):
            bit = (text >> level) & 1
            ones = np.zeros(len(text) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(text) - int(ones[-1]))
            high = bit.astype(bool)
            text = np.concatenate([text[~high], text[high]])

    def rank(self, letter: np.ndarray, *at: np.ndarray) -> list[np.ndarray]:
        """Occurrences of each letter before each place, counted from its first place in the last level."""
        begin, places = np.zeros(len(letter), np.int64), list(at)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            high = ((letter >> (self.bits - 1 - level)) & 1).astype(bool)
            for k, p in enumerate([begin, *places]):
                one = ones[p].astype(np.int64)
                p = np.where(high, zeros + one, p - one)
                if k:
                    places[k - 1] = p
                else:
                    begin = p
        return [p - begin for p in places]


class FMIndex:
    """Backward search and location in a sequence of small numbers whose last one, and no other, is zero."""

    def __init__(self, text: np.ndarray, letters: int, sample: int = SAMPLE):
        self.n = len(text)
        order = suffix_array(text, letters)
        self.bwt = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=letters + 1))])
        self.tree = WaveletMatrix(self.bwt, letters)
        kept = order % sample == 0
        self.sampled = np.concatenate([[0], np.cumsum(kept)])
        self.positions = order[kept]

    def search(self, windows: np.ndarray, sizes: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The interval of rows of each window; empty where it doesn't occur. `windows` has one a row or, with
        `starts`, is one sequence in which they begin."""
        if starts is None:
            starts, windows = np.arange(len(windows)) * windows.shape[1], windows.ravel()
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.n)
        for step in range(int(sizes.max(initial=0))):
            live = np.flatnonzero((sizes > step) & (high > low))
            if not len(live):
                break
            letter = windows[starts[live] + sizes[live] - 1 - step]
            a, b = self.tree.rank(letter, low[live], high[live])
            low[live], high[live] = self.before[letter] + a, self.before[letter] + b
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array."""
        out, back = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            r = rows[open_]
            hit = self.sampled[r + 1] > self.sampled[r]
            done = open_[hit]
            out[done] = self.positions[self.sampled[r[hit]]] + back[done]
            open_ = open_[~hit]
            letter = self.bwt[rows[open_]]
            rows[open_] = self.before[letter] + self.tree.rank(letter, rows[open_])[0]
            back[open_] += 1
        return out


def find(texts: Texts, patterns: Patterns) -> tuple[Words, np.ndarray, list[np.ndarray]]:
    """The shard's words, which of them are hit, and the numbers of the items that occur in each text."""
    words, names = names_of(texts)
    hit = np.zeros(len(words), bool)
    items = [np.zeros(0, np.int64)] * len(texts)
    if not len(words) or not len(patterns.starts):
        return words, hit, items
    at = np.minimum(np.searchsorted(patterns.vocabulary, names), len(patterns.vocabulary) - 1)
    known = patterns.vocabulary[at] == names
    # 0: the end, once; 1: behind a text; 2: a word that the benchmark hasn't; from 3 on: its words
    place = np.arange(len(words)) + words.owner()
    text = np.ones(len(words) + len(texts) + 1, np.int64)
    text[-1] = 0
    text[place] = np.where(known, at + 3, 2)
    letters = len(patterns.vocabulary) + 2
    index = FMIndex(text, letters)
    low, high = index.search(patterns.words, patterns.sizes, patterns.starts)
    count = high - low
    which = np.repeat(np.arange(len(count)), count)
    rows = np.arange(int(count.sum())) + np.repeat(low - (np.cumsum(count) - count), count)
    position = index.locate(rows)
    if not len(position):
        return words, hit, items
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, position, 1)
    np.add.at(edge, position + patterns.sizes[which], -1)
    hit = (np.cumsum(edge) > 0)[place]
    bounds = words.bounds + np.arange(len(texts) + 1)
    doc = np.searchsorted(bounds, position, "right") - 1
    pairs = np.unique(doc * len(patterns.starts) + which)
    doc, which = np.divmod(pairs, len(patterns.starts))
    many = np.diff(patterns.item_bounds)[which]
    found = patterns.items[np.arange(int(many.sum())) + np.repeat(patterns.item_bounds[which] - (np.cumsum(many) - many), many)]
    doc = np.repeat(doc, many)
    for low in np.flatnonzero(np.diff(doc, prepend=-1)):
        items[doc[low]] = np.unique(found[low : np.searchsorted(doc, doc[low], "right")])
    return words, hit, items


def pattern_blocks(benchmark: DataFrame, width: int, limit: int = BLOCK_BYTES) -> DataFrame:
    """(bucket, part, patterns): the benchmark's windows in blocks of at most `limit` bytes, or of one item.

    Items are dealt to tasks by a hash, in groups of about `limit` bytes of text; a task cuts its group once it
    knows the words. Repeated rows are taken once, a null item_id is the empty string, null texts have no
    window.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").where(
        "text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item_id"))).first()[0] or 0
    buckets = max(1, -(-size // limit))

    def make(table: pa.Table) -> pa.Table:
        table = table.sort_by([("item_id", "ascending"), ("text", "ascending")]).combine_chunks()
        texts, ids = table["text"].combine_chunks(), table["item_id"].to_pylist()
        weight = words_of(texts_of(texts).lower(), ALNUM).counts * WORD_BYTES + ITEM_BYTES
        weight += np.array([len(i) for i in ids], np.int64)
        parts, begin = [], 0
        while begin < len(ids):
            end = begin + max(1, int(np.searchsorted(np.cumsum(weight[begin:]), limit, "right")))
            parts.append(pickle.dumps(patterns_of(ids[begin:end], texts_of(texts.slice(begin, end - begin)), width)))
            begin = end
        return pa.table({
            "bucket": pa.array(table["bucket"].to_pylist()[:1] * len(parts), pa.int64()),
            "part": pa.array(range(len(parts)), pa.int32()), "patterns": pa.array(parts, pa.binary())})

    bucket = F.pmod(F.xxhash64("item_id", "text"), F.lit(buckets)).cast("long")
    made = items.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(make, "bucket long, part int, patterns binary")
    return saved(made, "patterns")


def marked(docs: DataFrame, blocks: DataFrame, finish: Callable | None = None, kind: StructType | str | None = None) -> DataFrame:
    """docs with _hits, the merged spans of hit words as first word and end alternately, and _items. `finish`
    makes of each piece so marked, and its words, what the last search gives, in the form `kind`."""
    out = docs.withColumns({
        "_hits": F.array().cast("array<int>"), "_items": F.array().cast("array<string>")})
    keys = blocks.select("bucket", "part").orderBy("bucket", "part").collect()  # two numbers a block
    if not keys:
        nothing = docs.sparkSession.sparkContext.broadcast(patterns_of([], texts_of(pa.array([], pa.string())), 1))
        return stream_texts(out).mapInArrow(released(_searcher(nothing, finish)), kind or out.schema)
    for key in keys[:-1]:
        shared = _shared(blocks, key)
        out = saved(stream_texts(out).mapInArrow(released(_searcher(shared)), out.schema), "hits")
        shared.unpersist()
    last = released(_searcher(_shared(blocks, keys[-1]), finish))
    return stream_texts(out).mapInArrow(last, kind or out.schema)


def _shared(blocks: DataFrame, key):
    row = blocks.where((F.col("bucket") == key["bucket"]) & (F.col("part") == key["part"])).first()
    return blocks.sparkSession.sparkContext.broadcast(pickle.loads(row["patterns"]))


def with_hits(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, limit: int = BLOCK_BYTES, *,
              finish: Callable | None = None, kind: StructType | str | None = None) -> DataFrame:
    return marked(docs, pattern_blocks(benchmark, width, limit), finish, kind)


def _searcher(shared, finish: Callable | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in pieces(batch, "text", SHARD):
                words, hit, items = find(texts, shared.value)
                hits, found = column(piece, "_hits").to_pylist(), column(piece, "_items").to_pylist()
                for i in np.unique(words.owner()[hit]).tolist():
                    mine = hit[words.bounds[i] : words.bounds[i + 1]].copy()
                    for low, high in zip(hits[i][::2], hits[i][1::2]):
                        mine[low:high] = True
                    hits[i] = np.flatnonzero(np.diff(mine, prepend=False, append=False)).tolist()
                    found[i] = found[i] + [shared.value.item_ids[k] for k in items[i]]
                columns = [c for c, n in zip(piece.columns, piece.schema.names) if n not in ("_hits", "_items")]
                names = [n for n in piece.schema.names if n not in ("_hits", "_items")]
                piece = pa.RecordBatch.from_arrays(
                    [*columns, pa.array(hits, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string()))],
                    [*names, "_hits", "_items"])
                yield finish(piece, texts, words) if finish else piece

    return run


def report(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row.

    Null and empty texts have no words; a text of any length is searched whole. An item without words has no
    window; an item_id that repeats is counted once, a null one is the empty string. Items with the same
    window all occur where it does. An empty benchmark hits nothing; items_sha256 is then that of the empty
    string.
    """

    def finish(piece: pa.RecordBatch, texts: Texts, words: Words) -> pa.RecordBatch:
        spans = column(piece, "_hits").to_pylist()
        items = [sorted(set(x)) for x in column(piece, "_items").to_pylist()]
        n_hit = [sum(s[1::2]) - sum(s[::2]) for s in spans]
        return pa.RecordBatch.from_arrays([
            column(piece, "doc_id"), pa.array(words.counts.astype(np.int64)), pa.array(n_hit, pa.int64()),
            pa.array([len(x) for x in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
            pa.array([n > 0 for n in n_hit], pa.bool_()),
        ], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return with_hits(
        id_and_text(docs), benchmark, width, finish=finish,
        kind="doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def cut_spans(text: bytes, starts: np.ndarray, ends: np.ndarray, spans: list[int]) -> bytes:
    """The text without the words of its spans. What stands between two removed words goes with them; a line end
    takes the place of each span."""
    out, at = [], 0
    for low, high in zip(spans[::2], spans[1::2]):
        out.append(text[at : starts[low]])
        at = ends[high - 1]
    return b"\n".join([*out, text[at:]])


def cut(piece: pa.RecordBatch, texts: Texts, words: Words) -> pa.RecordBatch:
    """(_row, text, _cut): the texts without their hit words."""
    spans = column(piece, "_hits").to_pylist()
    dirty = [i for i, s in enumerate(spans) if s]
    text = column(piece, "text")
    if dirty:
        values = text.to_pylist()
        for i in dirty:
            mine, begin = slice(words.bounds[i], words.bounds[i + 1]), texts.bounds[i]
            values[i] = cut_spans(texts.text(i), words.starts[mine] - begin, words.ends[mine] - begin, spans[i]).decode()
        text = pa.array(values, text.type)
    return pa.RecordBatch.from_arrays(
        [column(piece, "_row"), text, pa.array([bool(s) for s in spans], pa.bool_())], ["_row", "text", "_cut"])


def remove(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, limit: int = BLOCK_BYTES) -> DataFrame:
    """docs, with all their columns, without the words of any occurrence of a benchmark window; n_chars,
    where there is such a column, is counted again. Rows without hits stay as they are.

    Words that become neighbours may make up a window anew, so texts that were cut are searched again, in
    rounds over those texts alone, until nothing is found.
    """
    blocks = pattern_blocks(benchmark, width, limit)
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"] or [F.lit(0).alias("none")]
    left, done = docs.select(F.struct(*others).alias("_row"), "text"), []
    kind = StructType([*left.schema.fields, StructField("_cut", BooleanType())])
    while not done or not left.isEmpty():
        searched = saved(marked(left, blocks, cut, kind), "cut")
        done.append(searched.where("NOT _cut").select("_row", "text"))
        left = searched.where("_cut").select("_row", "text")
    out = reduce(DataFrame.union, done)
    out = out.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(kind)))
    return out
