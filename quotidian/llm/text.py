"""Texts of an Arrow batch as flat numpy arrays: bytes, words and hashes, without a loop over rows.

Every function takes whole texts. A batch is worked through in pieces of a few megabytes, so memory is
bounded by the larger of a piece and the longest text. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text per piece.
PIECE = 2 << 20

_rng = np.random.default_rng(20240628)
_ODD = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_class(listed: bytes, inside: bool = True) -> np.ndarray:
    """256 booleans: the listed bytes, or all but them."""
    table = np.zeros(256, bool)
    table[list(listed)] = True
    return table if inside else ~table


#: `[^\\x20\\x09-\\x0D]+`
NOT_BLANK = byte_class(b" \t\n\x0b\x0c\r", inside=False)
#: `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of text whose A-Z are lower-case already
ALNUM = byte_class(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Texts:
    """Consecutive texts: their bytes, and where each one begins (one more bound than texts)."""

    data: np.ndarray
    bounds: np.ndarray
    null: np.ndarray

    def __len__(self) -> int:
        return len(self.null)

    def lower(self) -> Texts:
        return Texts(LOWER[self.data], self.bounds, self.null)

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def texts_of(column: pa.Array) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type not in (pa.string(), pa.binary()):
        column = column.cast(pa.binary() if pa.types.is_large_binary(column.type) else pa.string())
    n = len(column)
    _, offsets, data = column.buffers()
    bounds = np.zeros(1, np.int64)
    if n:
        bounds = np.frombuffer(offsets, np.int32, n + 1, column.offset * 4).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    null = np.asarray(column.is_null().to_numpy(zero_copy_only=False), bool)
    if null.any() and (np.diff(bounds)[null] > 0).any():  # bytes may lie under a null
        filled = texts_of(column.fill_null("" if column.type == pa.string() else b""))
        return Texts(filled.data, filled.bounds, null)
    return Texts(raw[bounds[0] : bounds[-1]], bounds - bounds[0], null)


def pieces(batch: pa.RecordBatch, name: str, limit: int = PIECE) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batch in slices of at most `limit` bytes of text, or of one row."""
    every = texts_of(column(batch, name))
    start = 0
    while start < len(every):
        end = int(np.searchsorted(every.bounds, every.bounds[start] + limit, "right")) - 1
        end = min(max(end, start + 1), len(every))
        low, high = every.bounds[start], every.bounds[end]
        yield (
            batch.slice(start, end - start),
            Texts(every.data[low:high], every.bounds[start : end + 1] - low, every.null[start:end]),
        )
        start = end


@dataclass
class Words:
    """Words of consecutive texts: byte ranges, and the first word of each text (one more bound)."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def grams(self, n: int) -> np.ndarray:
        """First words of all runs of n words that lie in one text."""
        i = np.arange(max(len(self) - n + 1, 0))
        if not len(i):
            return i
        rest = np.repeat(self.bounds[1:], self.counts)[: len(i)]
        return i[i + n <= rest]


def words_of(texts: Texts, kind: np.ndarray) -> Words:
    """Maximal runs of bytes of a class; a run ends with its text."""
    inside = kind[texts.data]
    if not len(inside):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(texts) + 1, np.int64))
    edge = np.empty(len(inside) + 1, bool)
    edge[0] = True
    edge[-1] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[texts.bounds] = True
    at = np.flatnonzero(edge)
    keep = inside[at[:-1]]
    starts, ends = at[:-1][keep], at[1:][keep]
    return Words(starts, ends, np.searchsorted(starts, texts.bounds))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Bytes of a range up to which its name is made eight bytes at a time, all ranges at once; longer ones are
#: named one by one.
_SHORT = 64
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def nameable(data: np.ndarray) -> np.ndarray:
    """What range_names needs of a text: its bytes, with eight more behind them."""
    return np.concatenate([data, np.zeros(8, np.uint8)])


def range_names(padded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit name of each byte range, equal for equal bytes wherever they stand.

    Eight bytes are taken in at a time and the whole is mixed after each of them, so that no bytes can make up
    for others as they can in a sum. Ranges of more than _SHORT bytes have their XXH64.
    """
    sizes = ends - starts
    at_each_byte = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    names = sizes.astype(np.uint64) * _ODD[1]
    live = np.flatnonzero(sizes <= _SHORT)
    places, left = starts[live], sizes[live]
    while True:
        some = left > 0
        if not some.all():
            live, places, left = live[some], places[some], left[some]
        if not len(live):
            break
        names[live] = mix((names[live] ^ (at_each_byte[places] & _KEEP[np.minimum(left, 8)])) + _ODD[0])
        places, left = places + 8, left - 8
    for i in np.flatnonzero(sizes > _SHORT):
        names[i] = xxhash.xxh64_intdigest(padded[starts[i] : ends[i]].data, seed=42)
    return names


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_names(nameable(data), starts, ends)


def hash_grams(names: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit name of each run of n names."""
    total = np.full(len(at), n, np.uint64)
    for i in range(n):
        total += mix(names[at + i] + _ODD[i + 2]) * _ODD[i + 3]
    return mix(total)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values between neighbouring bounds, zero where there is none; each sum stands alone, so that
    a text scores the same whatever stands beside it."""
    out = np.zeros(len(bounds) - 1, values.dtype)
    some = bounds[1:] > bounds[:-1]
    if some.any():
        out[some] = np.add.reduceat(values, bounds[:-1][some])
    return out


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.names.index(name))


def ints(batch: pa.RecordBatch, name: str, missing: int = -1) -> np.ndarray:
    """A long column; a null reads as `missing`."""
    values = column(batch, name)
    if values.null_count:
        values = values.fill_null(missing)
    return np.asarray(values.to_numpy(zero_copy_only=False), np.int64)
