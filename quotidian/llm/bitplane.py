"""Token files: ids in blocks, each block turned into planes, each plane compressed.

Documents are range-partitioned by doc_id; a partition is one shard of the file set and its rows are
chunks in order. A chunk holds whole documents, CHUNK ids or one document more; its ids are cut into
blocks of BLOCK ids. A block's ids are transposed into byte planes (all lowest bytes, then all second
bytes, ...) or bit planes, and each plane is one zstandard frame. The frames' lengths, the blocks' sizes
and the documents' ids and sizes are the chunk index, in columns beside the payload, so a reader finds
any document without decoding the others. The container is Parquet: written by Spark's committer, it
survives lost executors and lies in any store that Spark writes to.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotidian.llm.scratch import fresh, id_and_text, released, stream_texts
from quotidian.llm.text import Texts, byte_class, column, hash_words, pieces, texts_of

#: Ids of a block, and of a chunk before it is closed.
BLOCK = 1 << 14
CHUNK = 1 << 16
END = 2
#: Bytes of text whose distinct pieces are encoded together, and bytes per call of the tokenizer.
TEXT, CALL = 4 << 20, 1 << 16
#: Stretches that a worker remembers: about 40 bytes each.
KNOWN = 1_500_000

FILES = """shard int, chunk int, start long, n_ids long, doc_ids array<long>, doc_sizes array<int>,
           block_sizes array<int>, frame_sizes array<int>, payload binary"""


_VISIBLE = byte_class(bytes(range(0x21, 0x7F)))
_ALNUM = byte_class(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_POINT = byte_class(b".,;:!?)")


def cuts(texts: Texts) -> np.ndarray:
    """Places where a byte-level BPE's splitting pattern always cuts, whatever stands around them: before a
    blank that a visible sign follows, between a letter or digit and a punctuation mark, and between a
    line end and a letter or digit. Of several blanks in a row before a letter the last one is split off, so
    such a line end is cut off before it too, unless a visible sign stands there. And the beginnings of texts."""
    data, cut = texts.data, np.zeros(len(texts.data), bool)
    line = (data[:-1] == 0x0A) & _ALNUM[data[1:]]
    cut[:-1] = (data[:-1] == 0x20) & _VISIBLE[data[1:]]
    cut[1:] |= (_ALNUM[data[:-1]] & _POINT[data[1:]]) | line
    cut[1:-1] |= line[1:] & ~_VISIBLE[data[:-2]]
    some = np.diff(texts.bounds) > 0
    last = texts.bounds[1:][some] - 1
    cut[last] &= (data[last] != 0x20) & (data[last] != 0x0A)  # what follows this blank belongs to the next text
    cut[texts.bounds[:-1][some]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of texts by the tokenizers library; each distinct stretch is encoded once.

    Up to KNOWN stretches are remembered by their 64-bit names for as long as the worker lives; others
    are encoded again in the next call.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():  # each sign of a byte-level token is one byte
            self.token_bytes[i] = len(token)
        self.names, self.first, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the bounds of each text's: those of its stretches between cuts."""
        if not len(texts.data):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        begins = cuts(texts)
        offsets = np.append(begins, len(texts.data)).astype(np.int32)
        units = pa.Array.from_buffers(
            pa.utf8(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(texts.data))])
        coded = units.dictionary_encode()
        places = coded.indices.to_numpy(zero_copy_only=False)
        distinct = texts_of(coded.dictionary)
        names = hash_words(distinct.data, distinct.bounds[:-1], distinct.bounds[1:])
        first, sizes, pool = self._look_up(coded.dictionary, distinct, names)

        count = sizes[places]
        total = np.cumsum(count)
        ids = pool[np.arange(int(total[-1])) + np.repeat(first[places] - (total - count), count)]
        return ids, np.concatenate([[0], total])[np.searchsorted(begins, texts.bounds)]

    def _look_up(self, words: pa.Array, distinct: Texts, names: np.ndarray):
        """(first, size) of each word's ids in a pool, and the pool."""
        first, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        new = np.ones(len(words), bool)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
            new = self.names[at] != names
            first[~new], sizes[~new] = self.first[at[~new]], self.size[at[~new]]
        places = np.flatnonzero(new)
        order, counts, ids = self._encode_words(words, distinct, places)
        sizes[order] = counts
        first[order] = len(self.pool) + np.cumsum(counts) - counts
        pool = np.concatenate([self.pool, ids])
        if len(self.names) + len(order) <= KNOWN:
            every = np.concatenate([self.names, names[order]])
            by_name = np.argsort(every)
            self.names = every[by_name]
            self.first = np.concatenate([self.first, first[order]])[by_name]
            self.size = np.concatenate([self.size, counts])[by_name]
            self.pool = pool
        return first, sizes, pool

    def _encode_words(self, words: pa.Array, distinct: Texts, places: np.ndarray):
        """The words at these places in the order of their ids, how many each has, and the ids.

        Words that begin with a blank are encoded as one long text, since each is cut from the one
        before, and told apart by the bytes of their tokens; the others are encoded one by one.
        """
        size, at = np.diff(distinct.bounds)[places], distinct.bounds[:-1][places]
        leading = (distinct.data[at] == 0x20) & (size > 1)
        leading[leading] = _VISIBLE[distinct.data[at[leading] + 1]]
        pool, counts = self._joined(words.take(pa.array(places[leading])), size[leading])
        single = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(
            words.take(pa.array(places[~leading])).to_pylist(), add_special_tokens=False)]
        order = np.concatenate([places[leading], places[~leading]])
        counts = np.concatenate([counts, np.array([len(x) for x in single], np.int64)])
        return order, counts, np.concatenate([np.zeros(0, np.int32), *pool, *single])

    def _joined(self, words: pa.Array, size: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        group = np.cumsum(size) // CALL
        heads = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(size))
        strings = words.to_pylist()
        calls = ["".join(strings[low:high]) for low, high in zip(heads[:-1], heads[1:])]
        found = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(calls, add_special_tokens=False)]
        if not found:
            return [], np.zeros(0, np.int64)
        ends = np.cumsum(self.token_bytes[np.concatenate(found)])
        return found, np.diff(np.searchsorted(ends, np.cumsum(size), "right"), prepend=0)


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each Python worker, which serves many tasks."""
    return Encoder(path)


def to_planes(ids: np.ndarray, kind: str, level: int) -> list[bytes]:
    """Compressed planes of a block of ids, lowest first."""
    pack = zstandard.ZstdCompressor(level=level).compress
    bytes_ = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if kind == "byte":
        return [pack(p.tobytes()) for p in bytes_]
    return [pack(np.packbits(p >> k & 1, bitorder="little").tobytes()) for p in bytes_ for k in range(8)]


def from_planes(frames: list[bytes], n: int) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor().decompress
    planes = [np.frombuffer(unpack(f), np.uint8) for f in frames]
    if len(planes) == 32:
        bits = [np.unpackbits(p, bitorder="little")[:n] for p in planes]
        planes = [sum((bits[8 * b + k] << np.uint8(k) for k in range(8)), np.zeros(n, np.uint8)) for b in range(4)]
    return np.ascontiguousarray(np.stack(planes, axis=1)).view("<u4").ravel()


def write_files(docs: DataFrame, path: str, tokenizer_path: str, end: int = END, kind: str = "byte", level: int = 3) -> None:
    """Writes the token files of docs (doc_id, text) in ascending doc_id order, null ones first."""
    rows = (
        id_and_text(docs).repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text")).withColumn("shard", F.spark_partition_id())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        chunk = start = 0
        open_ids: list[np.ndarray] = []
        open_docs: list = []
        held = 0

        def close(shard: int) -> pa.RecordBatch:
            ids = np.concatenate(open_ids)
            blocks = [to_planes(ids[i : i + BLOCK], kind, level) for i in range(0, len(ids), BLOCK)]
            frames = [f for b in blocks for f in b]
            record = {
                "shard": shard, "chunk": chunk, "start": start, "n_ids": len(ids), "doc_ids": list(open_docs),
                "doc_sizes": [len(x) for x in open_ids],
                "block_sizes": [len(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)],
                "frame_sizes": [len(f) for f in frames], "payload": b"".join(frames),
            }
            return pa.RecordBatch.from_pylist([record], schema=ARROW)

        shard = 0
        for batch in batches:
            for piece, texts in pieces(batch, "text", TEXT):
                shard = column(piece, "shard")[0].as_py()
                ids, bounds = encode(texts)
                for i, doc in enumerate(column(piece, "doc_id").to_pylist()):
                    open_ids.append(np.append(ids[bounds[i] : bounds[i + 1]], end))
                    open_docs.append(doc)
                    held += len(open_ids[-1])
                    if held >= CHUNK:
                        yield close(shard)
                        chunk, start, held = chunk + 1, start + held, 0
                        open_ids.clear()
                        open_docs.clear()
        if open_docs:
            yield close(shard)

    stream_texts(rows).mapInArrow(released(run), FILES).write.option("parquet.block.size", str(16 << 20)).parquet(path)


ARROW = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int32())),
    ("block_sizes", pa.list_(pa.int32())), ("frame_sizes", pa.list_(pa.int32())), ("payload", pa.binary()),
])


def shard_starts(files: DataFrame) -> dict[int, int]:
    """Ids before each shard. There are as many rows as partitions were written."""
    out, total = {}, 0
    for row in files.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect():
        out[row["shard"]] = total
        total += row["n"]
    return out


def decode_chunk(row: dict) -> np.ndarray:
    """All ids of a chunk."""
    per = len(row["frame_sizes"]) // len(row["block_sizes"])
    ends = np.cumsum(row["frame_sizes"])
    frames = [row["payload"][e - s : e] for s, e in zip(row["frame_sizes"], ends)]
    return np.concatenate([from_planes(frames[b * per : (b + 1) * per], n) for b, n in enumerate(row["block_sizes"])])


def read_digests(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    begins = files.sparkSession.sparkContext.broadcast(shard_starts(files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = decode_chunk(row)
                sizes = np.array(row["doc_sizes"], np.int64)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(begins.value[row["shard"]] + row["start"] + ends - sizes),
                    pa.array(sizes),
                    pa.array([zlib.crc32(ids[e - s : e].tobytes()) for s, e in zip(sizes, ends)], pa.int64()),
                ], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return stream_texts(files).mapInArrow(released(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer_path: str, kind: str = "byte", path: str | None = None) -> DataFrame:
    """Writes the token files and returns what they hold: (doc_id, start, n_tokens, ids_crc32).

    A null or empty text is its end id alone. Rows without a doc_id come first. Repeated rows are written
    each. An empty table writes files without chunks and returns no rows.
    """
    spark = docs.sparkSession
    path = path or fresh(spark, "token-files")
    write_files(docs, path, tokenizer_path, kind=kind)
    return read_digests(spark.read.schema(FILES).parquet(path))
