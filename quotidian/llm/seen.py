"""Which of a document's names also occur in other documents.

Names are 64-bit values that the caller computes from whole texts (of words, runs, byte strings). A piece
of a partition keeps, of all its documents with a name, only the smallest and the largest doc_id, settles the
rest by itself, and packs what is left into one row per bucket of names. A name that every document has
therefore travels twice per piece, not once per document. The answer is a list of names per document, so
it doesn't matter how rows are dealt to partitions when it is used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotidian.llm.scratch import stream_texts, unzipped
from quotidian.llm.text import Texts, column, ints, mix, pieces

#: (piece, texts) -> (number of the text, name) of every entry, for each kind of names
Entries = Callable[[pa.RecordBatch, Texts], list[tuple[np.ndarray, np.ndarray]]]

#: Bytes of text whose entries make up a bucket on average.
BUCKET_BYTES = 16 << 20
#: Bytes of a name where a few false answers do no harm.
SHORT = 6
_ROW = "bucket int, kind int, answer boolean, docs binary, names binary"
_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("answer", pa.bool_()), ("docs", pa.binary()),
                    ("names", pa.binary())])


def bucket_count(docs: DataFrame) -> int:
    """Buckets for the entries of these texts, so that a bucket, which a task holds, stays one size at any input."""
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def by_bucket(rows: DataFrame, buckets: int):
    """Rows grouped by bucket, in as many partitions as there are buckets."""
    return rows.repartition(buckets, "bucket").groupBy("bucket")


def heads_of(ordered: np.ndarray) -> np.ndarray:
    """First places of equal values."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    """The packed values of all rows."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def short(names: np.ndarray) -> np.ndarray:
    """Names of SHORT bytes, for answers that only spare further work: a false one costs a comparison."""
    return names & np.uint64((1 << 8 * SHORT) - 1)


def to_bytes(names: np.ndarray, width: int) -> np.ndarray:
    return names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def from_bytes(data: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = data.reshape(-1, width)
    return out.view("<u8").ravel()


def packed(bucket: np.ndarray, docs: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """Buckets, and the docs and values of each column that belong to each of them, packed; ordered by doc,
    whose repeated numbers then cost next to nothing."""
    columns = (docs, *columns)
    order = np.lexsort((docs, bucket))
    bucket = bucket[order]
    cuts = np.append(heads_of(bucket), len(bucket)) if len(bucket) else np.zeros(1, np.int64)
    out = []
    for values in columns:
        values = values[order]
        out.append([values[x:y].tobytes() for x, y in zip(cuts, cuts[1:])])
    return bucket[cuts[:-1]].astype(np.int32), out


def doc_bucket(docs: np.ndarray, buckets: int) -> np.ndarray:
    """Where a document's answers are gathered."""
    return (mix(docs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _by_name(names: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """names and docs in the order of names; for each the smallest and the largest doc of its name; and the
    heads of equal names."""
    order = np.argsort(names)
    names, docs = names[order], docs[order]
    heads = heads_of(names)
    size = np.diff(np.append(heads, len(names)))
    return (names, docs, np.repeat(np.minimum.reduceat(docs, heads), size),
            np.repeat(np.maximum.reduceat(docs, heads), size), heads)


def _rows(bucket: np.ndarray, kind: int, answer: bool, docs: np.ndarray, names: np.ndarray, width: int) -> pa.RecordBatch:
    at, (docs_of, names_of) = packed(bucket, docs, to_bytes(names, width))
    return pa.RecordBatch.from_arrays(
        [pa.array(at), pa.array(np.full(len(at), kind, np.int32)), pa.array([answer] * len(at), pa.bool_()),
         pa.array(docs_of, pa.binary()), pa.array(names_of, pa.binary())], schema=_ARROW)


def seen(docs: DataFrame, entries: Entries, buckets: int, **kinds: bool) -> DataFrame:
    """docs: with zipped texts. (doc_id, and a column for each kind of names): for every doc_id the names that a
    smaller doc_id has too, or, of the kinds that are True, those that another doc_id has, by SHORT names.
    names are packed. Rows without a doc_id take no part.

    Two exchanges carry rows of packed values: entries by name, then answers by document.
    """
    others = list(enumerate(kinds.values()))

    def width(any_other: bool) -> int:
        return SHORT if any_other else 8

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in (x for part in unzipped(batch) for x in pieces(part, "text")):
                given = np.asarray(column(piece, "doc_id").is_valid().to_numpy(zero_copy_only=False), bool)
                ids = ints(piece, "doc_id")
                for (kind, any_other), (owner, names) in zip(others, entries(piece, texts)):
                    names = short(names) if any_other else names
                    there = given[owner]
                    if not there.any():
                        continue
                    names, of, low, high, heads = _by_name(names[there], ids[owner[there]])
                    settled = (low < high) if any_other else (of > low)
                    yield _rows(doc_bucket(of[settled], buckets), kind, True, of[settled], names[settled], width(any_other))
                    name, low, high = names[heads], low[heads], high[heads]
                    wide = low < high
                    sent = np.concatenate([name, name[wide]])
                    yield _rows((sent % np.uint64(buckets)).astype(np.int64), kind, False, np.concatenate([low, high[wide]]),
                                sent, width(any_other))

    def compare(table: pa.Table) -> pa.Table:
        out = [table.filter(table["answer"]).cast(_ARROW)]
        rest = table.filter(pc.invert(table["answer"]))
        for kind, any_other in others:
            mine = rest.filter(pc.equal(rest["kind"], kind))
            names, of = from_bytes(joined(mine["names"], np.uint8), width(any_other)), joined(mine["docs"], np.int64)
            if len(names):
                names, of, low, high, _ = _by_name(names, of)
                found = (low < high) if any_other else (of > low)
                rows = _rows(doc_bucket(of[found], buckets), kind, True, of[found], names[found], width(any_other))
                out.append(pa.Table.from_batches([rows], _ARROW))
        return pa.concat_tables(out)

    def gather(table: pa.Table) -> pa.Table:
        lists: list[dict[int, bytes]] = []
        for kind, any_other in others:
            mine, size = table.filter(pc.equal(table["kind"], kind)), width(any_other)
            names, of = from_bytes(joined(mine["names"], np.uint8), size), joined(mine["docs"], np.int64)
            order = np.lexsort((names, of))
            names, of = names[order], of[order]
            new = np.ones(len(names), bool)
            new[1:] = (names[1:] != names[:-1]) | (of[1:] != of[:-1])
            names, of = names[new], of[new]
            heads = heads_of(of)
            raw = to_bytes(names, size).tobytes()
            lists.append({int(d): raw[size * a : size * b] for d, a, b in zip(of[heads], heads, np.append(heads[1:], len(of)))})
        ids = sorted(set().union(*lists))
        return pa.table({"doc_id": pa.array(ids, pa.int64()),
                         **{name: pa.array([x.get(d) for d in ids], pa.binary()) for name, x in zip(kinds, lists)}})

    answers = by_bucket(stream_texts(docs).mapInArrow(pack, _ROW), buckets).applyInArrow(compare, _ROW)
    return by_bucket(answers, buckets).applyInArrow(gather, ", ".join(["doc_id long", *[f"{name} binary" for name in kinds]]))


def told(
    piece: pa.RecordBatch, answers: str, owner: np.ndarray, names: np.ndarray, any_other: bool = False
) -> np.ndarray:
    """Which entries (text, name) are among the answers in a column of the piece."""
    width = SHORT if any_other else 8
    names = short(names) if any_other else names
    lists = column(piece, answers)
    if len(lists) == lists.null_count or not len(names):
        return np.zeros(len(names), bool)
    counts, parts = [], []
    for got in lists.to_pylist():
        counts.append(len(got or b"") // width)
        parts.append(got or b"")
    known = from_bytes(np.frombuffer(b"".join(parts), np.uint8), width)
    of = np.repeat(np.arange(len(counts)), counts)
    # A name is looked up within its own text.
    spread = np.uint64(0x9E3779B97F4A7C15)
    return np.isin(names + owner.astype(np.uint64) * spread, known + of.astype(np.uint64) * spread)
