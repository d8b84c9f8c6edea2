"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions; each decision, with up to DEPTH bytes before it as context, is a node of
a context tree. A node's zeros and ones give its Krichevsky-Trofimov estimate; its weighted probability is half
that estimate and half the product of its children's, so every subtree of contexts up to DEPTH is mixed with
its own prior weight. The conditional probability of a bit after training mixes the nodes on the path from
the root to the longest context, each by the posterior weight of stopping there.

Texts are coded with A-Z lower-cased and an end after each, so that the probabilities of all texts sum to one.
All counts follow from those of strings of DEPTH + 1 bytes, which Spark sums over the training texts. The
tree is built in groups of whole subtrees: all contexts that end in the same TOP bytes lie under one node, and
a group holds the strings of some such nodes, GROUP strings on average. What these nodes pass on is summed per
node above, of which there are at most 256 x 255 for TOP = 2; the levels from there to the root are put
together from those sums. Each string that occurs in any text gets its log probability, so scoring is a lookup.

Texts are dealt to pieces of PIECE_BYTES. A piece asks once for each of its distinct strings and words; questions meet the
model by key, and the answers go back to the piece, which then scores its texts. So no table is held whole anywhere, and
the work is the same number of passes at any size.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotidian.llm.scratch import give_back, id_and_text, released, saved, stream_texts
from quotidian.llm.seen import from_bytes, heads_of, joined, to_bytes
from quotidian.llm.text import NOT_BLANK, Texts, column, hash_words, pieces, sums, words_of

DEPTH = 5
#: Last context bytes whose subtree is built in one group, and the strings of a group on average.
TOP, GROUP = 2, 250_000
#: Text of a piece, which asks for its strings and words together, and text whose questions make up one bucket.
PIECE_BYTES, ASK_BYTES = 16 << 20, 64 << 20
#: Text that is worked on at once: a dozen arrays of eight bytes a byte live at a time.
SLICE_BYTES = 1 << 20
#: Strings and words that a task holds before it adds them up, and those it passes on in a batch, which the JVM holds whole.
HELD, BATCH_ROWS = 2_000_000, 1 << 16
BYTE, WORD, END = 0, 1, 2
#: Stands after every text and before it; no UTF-8 text holds it.
END_BYTE = 0xFF

_ZERO = np.zeros(0, np.int64)


def coded(texts: Texts) -> Texts:
    """What is coded: A-Z lower-cased, and after each text its end."""
    lower = texts.lower()
    bounds = lower.bounds + np.arange(len(lower.bounds))
    return Texts(np.insert(lower.data, lower.bounds[1:], END_BYTE), bounds, lower.null)


def byte_keys(texts: Texts, depth: int = DEPTH) -> np.ndarray:
    """For each byte the bytes before it, the nearest one highest, and itself lowest; before a text stand ends."""
    data = texts.data.astype(np.int64)
    key = data.copy()
    begins, sizes = texts.bounds[:-1], np.diff(texts.bounds)
    for back in range(1, depth + 1):
        shift = 8 * (depth + 1 - back)
        key[back:] |= data[:-back] << shift
        at = begins[sizes >= back] + back - 1  # this byte and those before it have no byte so far back
        for place in (at - k for k in range(back)):
            key[place] |= END_BYTE << shift
        short = begins[sizes < back], sizes[sizes < back]
        rest = np.repeat(short[0], short[1]) + np.arange(int(short[1].sum())) - np.repeat(np.cumsum(short[1]) - short[1], short[1])
        key[rest] |= END_BYTE << shift
    return key


def word_names(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, name) of every lower-cased word."""
    lower = texts.lower()
    words = words_of(lower, NOT_BLANK)
    return words.bounds, hash_words(lower.data, words.starts, words.ends).view(np.int64)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the sums of their counts. parts is emptied, so that it is not held beside its sum."""
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([n for _, n in parts])
    parts.clear()
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys = keys[order]
    counts = counts[order]
    del order
    head = heads_of(keys)
    return keys[head], np.add.reduceat(counts, head)


def distinct(keys: np.ndarray) -> np.ndarray:
    """Distinct keys in order, by sorting: without counts np.unique hashes them first, which takes four times as
    long where most keys differ."""
    ordered = np.sort(keys)
    return ordered[heads_of(ordered)] if len(ordered) else ordered


class Distinct:
    """Distinct keys, put together whenever those that came since are as many."""

    def __init__(self):
        self.parts, self.size, self.most = [_ZERO], 0, HELD // 4

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(distinct(keys))
        self.size += len(self.parts[-1])
        if self.size > self.most:
            self.parts = [self.keys()]
            self.size = len(self.parts[0])
            self.most = max(2 * self.size, HELD // 4)

    def keys(self) -> np.ndarray:
        return distinct(np.concatenate(self.parts))


def _tally(keys: np.ndarray, train: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Counts of keys in training texts, and zeros for the others'."""
    seen, n = np.unique(keys[train], return_counts=True)
    other = distinct(keys[~train])
    return [(seen, n.astype(np.int64)), (other, np.zeros(len(other), np.int64))]


def dealt(docs: DataFrame, size: int = PIECE_BYTES) -> DataFrame:
    """(piece, size, rows): docs (doc_id, held_out, text) in pieces of about so many bytes of text, or one row, each
    packed into one row with its texts compressed. A piece's number is drawn, so the result is to be written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        total = 0

        def row() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for part in held:
                    out.write_batch(part)
            held.clear()
            number = int.from_bytes(os.urandom(8), "little") >> 1
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([total], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
            ], ["piece", "size", "rows"])

        for batch in batches:
            for part, texts in pieces(batch, "text", size):
                if held and total + len(texts.data) > size:
                    yield row()
                    total = 0
                held.append(part)
                total += len(texts.data)
        if held:
            yield row()

    return stream_texts(docs.select("doc_id", "held_out", "text")).mapInArrow(run, "piece long, size long, rows binary")


def unpacked(rows: pa.Scalar) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """A piece's rows, in slices that are worked on at once."""
    for part in pa.ipc.open_stream(rows.as_buffer()):
        yield from pieces(part, "text", SLICE_BYTES)


def counts(dealt_docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(kind, key, n): strings and words of all texts with their number in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {BYTE: [], WORD: []}

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, parts in held.items():
                if parts:
                    keys, n = _added(parts)
                    for a in range(0, len(keys), BATCH_ROWS):
                        some = slice(a, a + BATCH_ROWS)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(keys[some]), kind, np.int32)), pa.array(keys[some]), pa.array(n[some])], ["kind", "key", "n"])

        ends = size = 0
        for batch in batches:
            for piece, texts in (x for rows in column(batch, "rows") for x in unpacked(rows)):
                train = ~np.asarray(column(piece, "held_out").to_numpy(zero_copy_only=False), bool)
                ends += int(train.sum())
                bounds, names = word_names(texts)
                whole = coded(texts)
                held[BYTE] += _tally(byte_keys(whole, depth), np.repeat(train, np.diff(whole.bounds)))
                held[WORD] += _tally(names, np.repeat(train, np.diff(bounds)))
                size += sum(len(k) for parts in held.values() for k, _ in parts[-2:])
                if size > HELD:
                    for kind in held:
                        held[kind] = [_added(held[kind])]
                    size = sum(len(parts[0][0]) for parts in held.values())
                    if size > HELD // 4 * 3:  # else adding up would soon be all it does
                        yield from flush()
                        size = 0
        yield from flush()
        yield pa.RecordBatch.from_arrays(
            [pa.array([END], pa.int32()), pa.array([0], pa.int64()), pa.array([ends], pa.int64())], ["kind", "key", "n"])

    return (
        stream_texts(dealt_docs).mapInArrow(released(run), "kind int, key long, n long")
        .groupBy("kind", "key").agg(F.sum("n").alias("n"))
    )


# The tree ---------------------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series after shifting the argument up."""
    x = x.astype(np.float64)
    low = np.zeros(len(x))
    for _ in range(8):
        small = x < 8
        low[small] += np.log(x[small])
        x = np.where(small, x + 1, x)
    i = 1 / (x * x)
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + (1 / 12 - i * (1 / 360 - i * (1 / 1260 - i / 1680))) / x - low


def kt_block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a string with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def nodes_of(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, zeros, ones) of the binary decisions under each context; keys: context << 8 | byte, sorted.
    A decision's id is context << 8 | (1 and the bits of the byte decided so far)."""
    ids, zeros, ones = [], [], []
    context, symbol = keys >> 8, keys & 255
    for bit in range(8):
        node = (context << 8) | (1 << bit) | (symbol >> (8 - bit))
        head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        one = (symbol >> (7 - bit)) & 1
        ids.append(node[head])
        ones.append(np.add.reduceat(n * one, head))
        zeros.append(np.add.reduceat(n * (1 - one), head))
    every = np.concatenate(ids)
    order = np.argsort(every)
    return every[order], np.concatenate(zeros)[order], np.concatenate(ones)[order]


def parents(ids: np.ndarray) -> np.ndarray:
    """The same decisions under contexts that are shorter by their farthest byte."""
    return ((ids >> 16) << 8) | (ids & 255)


def build(keys: np.ndarray, n: np.ndarray, depth: int, top: int) -> list[tuple]:
    """From the longest contexts up to `top`: (id, stop, one, weighted) of the nodes of each depth, where stop is
    the posterior weight of the node's own estimate and one that estimate of a one. keys sorted, n > 0."""
    levels, below = [], None
    for d in range(depth, top - 1, -1):
        if d < depth:
            shorter = ((keys >> (8 * (depth + 1 - d))) << 8) | (keys & 255)
            at, sums_ = _added([(shorter, n)])
        else:
            at, sums_ = keys, n
        ids, zeros, ones = nodes_of(at, sums_)
        own = kt_block(zeros, ones)
        if below is None:
            weighted, stop = own, np.ones(len(ids))
        else:
            child, child_weighted = below
            through = np.bincount(np.searchsorted(ids, parents(child)), child_weighted, len(ids))
            weighted = np.logaddexp(own, through) - math.log(2)
            stop = np.exp(own - math.log(2) - weighted)
        levels.append((ids, stop, (ones + 0.5) / (zeros + ones + 1.0), weighted, zeros, ones))
        below = ids, weighted
    return levels


def log_probabilities(keys: np.ndarray, levels: list[tuple], depth: int) -> np.ndarray:
    """log10 of each key's last byte after its context. levels: from the longest contexts to the root."""
    total = np.zeros(len(keys))
    symbol = keys & 255
    for bit in range(8):
        p = np.full(len(keys), 0.5)
        for k, (ids, stop, one, *_) in enumerate(levels):
            node = ((keys >> (8 * (k + 1))) << 8) | (1 << bit) | (symbol >> (8 - bit))
            if not len(ids):
                continue
            at = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
            seen = ids[at] == node
            # Below a context that was never seen nothing was, and the estimate is one half.
            p = np.where(seen, stop[at] * one[at] + (1 - stop[at]) * p, 0.5)
        total += np.log10(np.where((symbol >> (7 - bit)) & 1, p, 1 - p))
    return total


def upper_levels(nodes: pa.Table, top: int) -> list[tuple]:
    """(id, stop, one) of each depth from top - 1 to the root. nodes: (node, zeros, ones, through) of depth
    top - 1, through being what its children pass on."""
    nodes = nodes.sort_by("node")
    ids, zeros, ones = (nodes[c].to_numpy() for c in ("node", "zeros", "ones"))
    through = nodes["through"].to_numpy()
    levels = []
    for d in range(top - 1, -1, -1):
        own = kt_block(zeros, ones)
        weighted = np.logaddexp(own, through) - math.log(2)
        levels.append((ids, np.exp(own - math.log(2) - weighted), (ones + 0.5) / (zeros + ones + 1.0)))
        if d:
            ids, which = np.unique(parents(ids), return_inverse=True)
            zeros, ones, through = (np.bincount(which, x, len(ids)) for x in (zeros, ones, weighted))
    return levels


def byte_table(counted: DataFrame, strings: int, depth: int = DEPTH, group: int = GROUP) -> DataFrame:
    """(kind, key, value, known) of every string, of which there are so many."""
    spark = counted.sparkSession
    top = min(TOP, depth)
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-strings // group))
    grouped = (
        counted.where(F.col("kind") == BYTE)
        .withColumn("group", F.pmod(F.xxhash64(F.shiftright("key", 8 * (depth + 1 - top))), F.lit(groups)))
        .repartition(groups, "group").groupBy("group")
    )

    def subtrees(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
        keys, n = table["key"].to_numpy(), table["n"].to_numpy()
        order = np.argsort(keys)
        keys, known = keys[order], n[order] > 0
        levels = build(keys[known], n[order][known], depth, top) if known.any() else []
        return keys, known, levels

    def passed_on(table: pa.Table) -> pa.Table:
        _, _, levels = subtrees(table)
        ids, _, _, weighted, zeros, ones = levels[-1] if levels else (_ZERO,) * 6
        node, which = np.unique(parents(ids), return_inverse=True)
        zeros, ones, through = (np.bincount(which, x, len(node)) for x in (zeros, ones, weighted))
        return pa.table({"node": node, "zeros": zeros.astype(np.int64), "ones": ones.astype(np.int64), "through": through.astype(float)})

    found = grouped.applyInArrow(passed_on, "node long, zeros long, ones long, through double")
    above = spark.sparkContext.broadcast(upper_levels(found.groupBy("node").agg(
        *[F.sum(c).alias(c) for c in ("zeros", "ones", "through")]).toArrow(), top))

    def values(table: pa.Table) -> pa.Table:
        keys, known, levels = subtrees(table)
        levels = levels or [(_ZERO, _ZERO, _ZERO)] * (depth - top + 1)
        told = pa.table({"kind": np.full(len(keys), BYTE, np.int32), "key": keys,
                         "value": log_probabilities(keys, [*levels, *above.value], depth), "known": known})
        del levels
        give_back()
        return told

    return grouped.applyInArrow(values, "kind int, key long, value double, known boolean")


# Scoring ----------------------------------------------------------------------------------------------


class Table:
    """Values by key."""

    def __init__(self, rows: pa.Table):
        keys, values, known = (rows[c].to_numpy() for c in ("key", "value", "known"))
        order = np.argsort(keys)
        self.keys, self.values, self.known = keys[order], values[order], known[order]

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, known) of each key; zero and false for those of other shards. Distinct keys are looked up
        in order, which reads the table from front to back."""
        if not len(self.keys) or not len(keys):
            return np.zeros(len(keys)), np.zeros(len(keys), bool)
        order = np.argsort(keys)
        ordered = keys[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        distinct = ordered[new]
        at = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
        hit = self.keys[at] == distinct
        which = np.empty(len(keys), np.int64)
        which[order] = np.cumsum(new) - 1
        return np.where(hit, self.values[at], 0.0)[which], (hit & self.known[at])[which]


def _width(kind: int, depth: int) -> int:
    return depth + 1 if kind == BYTE else 8


def asked(dealt_docs: DataFrame, depth: int, buckets: int) -> DataFrame:
    """(bucket, piece, kind, keys): the distinct strings and words of each piece, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, rows in zip(column(batch, "piece").to_pylist(), column(batch, "rows")):
                found = {BYTE: Distinct(), WORD: Distinct()}
                for _, texts in unpacked(rows):
                    found[BYTE].add(byte_keys(coded(texts), depth))
                    found[WORD].add(word_names(texts)[1])
                for kind, parts in found.items():
                    keys = parts.keys()
                    bucket = np.mod(keys, buckets)
                    order = np.argsort(bucket, kind="stable")
                    keys, bucket = keys[order], bucket[order]
                    heads = heads_of(bucket) if len(keys) else _ZERO
                    lists = [to_bytes(keys[a:b].view(np.uint64), _width(kind, depth)).tobytes()
                             for a, b in zip(heads, np.append(heads[1:], len(keys)))]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(bucket[heads], pa.int32()), pa.array(np.full(len(heads), number, np.int64)),
                        pa.array(np.full(len(heads), kind, np.int32)), pa.array(lists, pa.binary()),
                    ], ["bucket", "piece", "kind", "keys"])

    return stream_texts(dealt_docs).mapInArrow(released(run), "bucket int, piece long, kind int, keys binary")


def answered(model: DataFrame, asks: DataFrame, depth: int, buckets: int) -> DataFrame:
    """(piece, kind, keys, values, known): what was asked, with what the model says; packed."""
    by_key = model.withColumn("bucket", F.pmod("key", F.lit(buckets).cast("long")).cast("int"))

    def run(mine: pa.Table, asks: pa.Table) -> pa.Table:
        out = []
        for kind in (BYTE, WORD):
            of_kind = asks.filter(pc.equal(asks["kind"], kind))
            if not len(of_kind):
                continue
            keys = from_bytes(joined(of_kind["keys"], np.uint8), _width(kind, depth)).view(np.int64)
            value, known = Table(mine.filter(pc.equal(mine["kind"], kind))).look_up(keys)
            ends = np.cumsum([len(x.as_buffer()) // _width(kind, depth) for x in of_kind["keys"]])
            spans = list(zip(np.append(0, ends[:-1]), ends))
            told = pa.table({
                "piece": of_kind["piece"], "kind": of_kind["kind"], "keys": of_kind["keys"].cast(pa.binary()),
                "values": pa.array([value[a:b].tobytes() for a, b in spans], pa.binary()),
                "known": pa.array([known[a:b].tobytes() if kind == WORD else b"" for a, b in spans], pa.binary())})
            rows = max(1, len(told) * BATCH_ROWS // max(1, len(keys)))
            out += [told.slice(a, rows) for a in range(0, len(told), rows)]
            del of_kind, keys, value, known, told
        give_back()
        return pa.concat_tables(out) if out else _ANSWERS.empty_table()

    def grouped(df: DataFrame):
        return df.repartition(buckets, "bucket").groupBy("bucket")

    return grouped(by_key).cogroup(grouped(asks)).applyInArrow(
        run, "piece long, kind int, keys binary, values binary, known binary")


_ANSWERS = pa.schema([("piece", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("values", pa.binary()), ("known", pa.binary())])
_SUMS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_bytes", pa.int64()), ("n_words", pa.int64()),
                   ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])


def summed(dealt_docs: DataFrame, answers: DataFrame, depth: int, partitions: int) -> DataFrame:
    """(doc_id, held_out, n_bytes, n_words, n_known, base, score) of every row; of words, without the end."""

    def run(piece: pa.Table, answers: pa.Table) -> pa.Table:
        def table(kind: int) -> Table:
            mine = answers.filter(pc.equal(answers["kind"], kind))
            keys = from_bytes(joined(mine["keys"], np.uint8), _width(kind, depth)).view(np.int64)
            known = joined(mine["known"], np.bool_) if kind == WORD else np.ones(len(keys), bool)
            return Table(pa.table({"key": keys, "value": joined(mine["values"], np.float64), "known": known}))

        strings, words, out = table(BYTE), table(WORD), []
        for rows, texts in (x for packed_rows in piece["rows"] for x in unpacked(packed_rows)):
            whole = coded(texts)
            bounds, names = word_names(texts)
            value, known = words.look_up(names)
            out.append(pa.RecordBatch.from_arrays([
                column(rows, "doc_id"), column(rows, "held_out"), pa.array(np.diff(whole.bounds)), pa.array(np.diff(bounds)),
                pa.array(sums(known.astype(np.int64), bounds)), pa.array(sums(value, bounds)),
                pa.array(sums(strings.look_up(byte_keys(whole, depth))[0], whole.bounds)),
            ], schema=_SUMS))
        del strings, words
        give_back()
        return pa.Table.from_batches(out, _SUMS)

    def grouped(df: DataFrame):
        return df.repartition(partitions, "piece").groupBy("piece")

    return grouped(dealt_docs.select("piece", "rows")).cogroup(grouped(answers)).applyInArrow(
        run, "doc_id long, held_out boolean, n_bytes long, n_words long, n_known long, base double, score double")


def score(docs: DataFrame, depth: int = DEPTH, folds: int = 10, piece: int = PIECE_BYTES, group: int = GROUP) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row.

    score: log10 of the text's probability with A-Z lower-cased, its end included, as the baseline has it;
    bits_per_byte: the code length that follows, per byte and the end.

    Rows whose crc32 of the doc_id as text is divisible by `folds` are held out; rows without a doc_id are
    not. A null text is empty: all that is coded is its end. Without training rows
    every decision is one half and every token is as likely as the end. Repeated rows are counted and
    scored each. An empty table gives no rows. depth is 1 to 6.
    """
    rows = id_and_text(docs).withColumns({
        "held_out": F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))})
    texts = saved(dealt(rows, piece), "ctw-texts")
    n_bytes = texts.select(F.sum("size")).first()[0] or 0
    counted = saved(counts(texts, depth), "ctw-counts")
    sizes = {r["kind"]: r for r in counted.groupBy("kind").agg(
        F.sum("n").alias("n"), F.sum((F.col("n") > 0).cast("long")).alias("distinct"), F.count("*").alias("rows")).collect()}

    def size(kind: int, what: str) -> int:
        return int(sizes[kind][what]) if kind in sizes else 0

    ends = size(END, "n")
    tokens, vocabulary = size(WORD, "n") + ends, size(WORD, "distinct") + (ends > 0)
    scale = tokens + 0.1 * (vocabulary + 1)
    words = counted.where(F.col("kind") == WORD).select(
        "kind", "key", F.log10((F.col("n") + 0.1) / scale).alias("value"), (F.col("n") > 0).alias("known"))
    model = saved(byte_table(counted, size(BYTE, "rows"), depth, group).unionByName(words), "ctw-model")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Odd, so that all bytes of a string have a part in the remainder.
    buckets = max(partitions, -(-n_bytes // ASK_BYTES)) | 1
    answers = answered(model, asked(texts, depth, buckets), depth, buckets)
    added = summed(texts, answers, depth, max(partitions, -(-n_bytes // (2 * PIECE_BYTES))))
    end = math.log10((ends + 0.1) / scale)
    return added.select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"), (F.col("n_known") + int(ends > 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") + end).alias("base_score"), "score",
        (-F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"))
