"""Substring dedup by recompression.

Runs of one word are named first. Then every round names pairs: a symbol's name and the round decide
whether it is a left or a right one, and each left one that a right one follows becomes one symbol with
it. (Runs are not named again in later rounds: equal neighbours are never a pair, so nothing is lost but
some shortening, and each run step would widen all contexts.) A name is a
64-bit hash of what it names, so all tasks give equal parts equal names without a table of them. A
symbol's context is the stretch of words on which its making depends; wherever that stretch occurs, the
same symbol does.

Two exchanges settle what repeats:

1. After ROUNDS rounds a window with a symbol, context included, that no other document has cannot
   repeat. After PHRASE_ROUNDS rounds symbols span about as many words as a window; PHRASE of them in a row are a
   phrase. A phrase that a smaller doc_id has too stands for the same words there, so all windows inside it
   are repeats, and nothing else is asked about them.
2. What is left are windows at the ends of repeats, where symbols still depend on what stands around, short
   repeats, and the first document of each repeat. The names of these windows are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotidian.llm.scratch import id_and_text, stream_texts, unzipped, zipped
from quotidian.llm.seen import bucket_count, seen, told
from quotidian.llm.text import NOT_BLANK, Texts, Words, column, hash_grams, hash_words, mix, pieces, words_of

WINDOW = 13
ROUNDS = 3
#: Rounds after which symbols verify repeats, and how many in a row do.
PHRASE_ROUNDS, PHRASE = 8, 3

_RUN, _PAIR, _SIDE = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_PHRASE = np.uint64(0x8EBC6AF09C88C6E3)


@dataclass
class Symbols:
    """Symbols of consecutive texts: name, text, the words [low, high) that its making depends on, and those
    that it stands for, [begin, end)."""

    name: np.ndarray
    owner: np.ndarray
    low: np.ndarray
    high: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def at(self, which: np.ndarray) -> Symbols:
        return Symbols(*(x[which] for x in (self.name, self.owner, self.low, self.high, self.begin, self.end)))


def _neighbours(s: Symbols, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Whether each symbol has one before and one behind it in its text, and the contexts' ends when
    these are taken in; beyond a text, a context reaches one word further and so lies in no window."""
    before = np.zeros(len(s.name), bool)
    before[1:] = s.owner[1:] == s.owner[:-1]
    behind = np.zeros(len(s.name), bool)
    behind[:-1] = before[1:]
    low, high = bounds[s.owner] - 1, bounds[s.owner + 1] + 1
    low[1:] = np.where(before[1:], s.low[:-1], low[1:])
    high[:-1] = np.where(behind[:-1], s.high[1:], high[:-1])
    return before, behind, low, high


def _runs(s: Symbols, bounds: np.ndarray) -> Symbols:
    """Maximal runs of a symbol become one. That a run ends, or a symbol is none, depends on the neighbours."""
    if not len(s.name):
        return s
    before, _, low, high = _neighbours(s, bounds)
    head = np.ones(len(s.name), bool)
    head[1:] = ~(before[1:] & (s.name[1:] == s.name[:-1]))
    heads = np.flatnonzero(head)
    count = np.diff(np.append(heads, len(head)))
    last = heads + count - 1
    many = count > 1
    name = s.name[heads]
    name[many] = mix(name[many] * _RUN + count[many].astype(np.uint64))
    return Symbols(name, s.owner[heads], low[heads], high[last], s.begin[heads], s.end[last])


def _pairs(s: Symbols, bounds: np.ndarray, round_: int) -> Symbols:
    """A left symbol and a right one behind it become one. That a symbol stays alone depends on the
    neighbour with which it would have paired."""
    if not len(s.name):
        return s
    before, behind, low, high = _neighbours(s, bounds)
    right = (mix(s.name ^ (_SIDE + np.uint64(round_))) & np.uint64(1)).astype(bool)
    opens = np.zeros(len(s.name), bool)
    opens[:-1] = ~right[:-1] & right[1:] & behind[:-1]
    closes = np.zeros(len(s.name), bool)
    closes[1:] = opens[:-1]
    out = s.at(~closes)
    opened, rightish = opens[~closes], right[~closes]
    first = np.flatnonzero(opens)
    name = out.name.copy()
    name[opened] = mix(mix(s.name[first] + _PAIR) * _PAIR + s.name[first + 1])
    wide_low, wide_high = low[~closes], high[~closes]
    new_high = np.where(opened, out.high, np.where(rightish, out.high, wide_high))
    new_high[opened] = s.high[first + 1]
    new_low = np.where(opened | ~rightish, out.low, wide_low)
    end = out.end.copy()
    end[opened] = s.end[first + 1]
    return Symbols(name, out.owner, new_low, new_high, out.begin, end)


def parse(names: np.ndarray, words: Words, *rounds: int) -> list[Symbols]:
    """The symbols after so many rounds each, ascending."""
    at = np.arange(len(names))
    s = _runs(Symbols(names, words.owner(), at, at + 1, at, at + 1), words.bounds)
    out = []
    for r in range(rounds[-1]):
        out += [s] * rounds.count(r)
        s = _pairs(s, words.bounds, r)
    return out + [s] * rounds.count(rounds[-1])


def phrases(s: Symbols, size: int, window: int) -> Symbols:
    """`size` symbols in a row as one, those that hold a window."""
    first = np.arange(max(len(s.name) - size + 1, 0))
    first = first[s.owner[first] == s.owner[first + size - 1]]
    last = first + size - 1
    first, last = (x[s.end[last] - s.begin[first] >= window] for x in (first, last))
    name = s.name[first]
    for k in range(1, size):
        name = mix(mix(name + _PHRASE) * _PAIR + s.name[first + k])
    return Symbols(name, s.owner[first], s.low[first], s.high[last], s.begin[first], s.end[last])


def _words(texts: Texts) -> tuple[Words, np.ndarray]:
    words = words_of(texts, NOT_BLANK)
    return words, hash_words(texts.data, words.starts, words.ends)


def _inside(s: Symbols, window: int) -> np.ndarray:
    """Symbols that some window has together with their context."""
    return s.high - s.low <= window


def _symbols(names: np.ndarray, words: Words, window: int, rounds: int) -> tuple[Symbols, Symbols]:
    """Symbols that some window has together with their context, and phrases."""
    low, high = parse(names, words, rounds, max(rounds, PHRASE_ROUNDS))
    return low.at(_inside(low, window)), phrases(high, PHRASE, window)


def _symbol_entries(window: int, rounds: int):
    def entries(piece: pa.RecordBatch, texts: Texts):
        words, names = _words(texts)
        return [(s.owner, s.name) for s in _symbols(names, words, window, rounds)]

    return entries


def _covered(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in some [begin, end)."""
    change = np.zeros(n + 2, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, np.maximum(end, begin), -1)
    return np.cumsum(change)[:n] > 0


def _candidates(
    piece: pa.RecordBatch, texts: Texts, window: int, rounds: int
) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, the first words of windows inside phrases that a smaller doc_id has, and those of the other windows that
    may repeat, with their names."""
    words, names = _words(texts)
    s, p = _symbols(names, words, window, rounds)
    lonely = s.at(~told(piece, "shared", s.owner, s.name, any_other=True))
    # Windows that begin from high - window to low hold the symbol and its context.
    begin = np.maximum(lonely.high - window, words.bounds[lonely.owner])
    dead = _covered(begin, lonely.low + 1, len(words))
    p = p.at(told(piece, "phrases", p.owner, p.name))
    verified = _covered(p.begin, p.end - window + 1, len(words))
    at = words.grams(window)
    at = at[~(dead | verified)[at]]
    return words, np.flatnonzero(verified), at, hash_grams(names, at, window)


def _window_entries(window: int, rounds: int):
    def entries(piece: pa.RecordBatch, texts: Texts):
        words, _, at, names = _candidates(piece, texts, window, rounds)
        return [(words.owner()[at], names)]

    return entries


def kept_words(texts: Texts, words: Words, removed: np.ndarray) -> list[bytes]:
    """Each text's words that stay, joined by one blank."""
    size = np.where(removed, 0, words.ends - words.starts + 1)
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    take = np.arange(total) + np.repeat(words.starts - (ends - size), size)
    data = texts.data[np.minimum(take, max(len(texts.data) - 1, 0))] if total else np.zeros(0, np.uint8)
    data[ends[size > 0] - 1] = 0x20
    bounds = np.concatenate([[0], ends])[words.bounds]
    raw = data.tobytes()
    return [raw[a : max(b - 1, a)] for a, b in zip(bounds, bounds[1:])]


def repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, text, shared, smaller): docs, their texts zipped, with the names of their symbols that other documents have, and
    of their phrases and windows that documents with a smaller doc_id have."""
    plain = zipped(docs)
    buckets = bucket_count(id_and_text(docs))
    shared = seen(plain, _symbol_entries(window, rounds), buckets, shared=True, phrases=False)
    # Only documents with a shared symbol can have a window that repeats, save for windows that hold no
    # whole symbol, so all rows stay.
    first = plain.join(shared, "doc_id", "left")
    smaller = seen(first, _window_entries(window, rounds), buckets, smaller=False)
    return first.join(smaller, "doc_id", "left")


def dedup(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of every row; kept is the text that stays.

    A word goes if a window that covers it also starts in a document with a smaller doc_id. Null, empty and
    blank texts have no words. Rows that share a doc_id are one document: none of them is smaller. Nothing is
    removed for or from rows without a doc_id. An empty table gives no rows. Equal windows are told by
    64-bit names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in (x for part in unzipped(batch) for x in pieces(part, "text")):
                words, verified, at, names = _candidates(piece, texts, window, rounds)
                hit = np.concatenate([verified, at[told(piece, "smaller", words.owner()[at], names)]])
                removed = _covered(hit, hit + window, len(words))
                kept = kept_words(texts, words, removed)
                gone = np.concatenate([[0], np.cumsum(removed)])[words.bounds]
                yield pa.RecordBatch.from_arrays([
                    column(piece, "doc_id"), pa.array(words.counts.astype(np.int64)), pa.array(np.diff(gone)),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                    pa.array([k.decode() for k in kept], pa.string()),
                ], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return stream_texts(repeats(docs, window, rounds)).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    return dedup(docs, window).select("doc_id", "n_words", "n_removed", "kept_sha256")
