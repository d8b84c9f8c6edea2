"""Anchors: places of a text that any window of bytes finds by its own content.

Every window of `window` bytes holds window - k + 1 strings of k bytes; the one with the smallest name is the
window's anchor (all of them, if several tie). Equal windows, wherever they stand, have equal anchors at
equal places, so windows need to be compared only where they share an anchor. A window's anchor
lies at most window - k bytes behind its begin, so the bytes from window - k before an anchor to window behind
it, its context, hold every window that it stands for.
"""

from __future__ import annotations

import numpy as np

from quotidian.llm.text import Texts, mix

K = 24
#: Names made at once.
BLOCK = 1 << 16
_MUL = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def fixed_names(data: np.ndarray, at: np.ndarray | None, size: int) -> np.ndarray:
    """A 64-bit name of the `size` bytes (8 or more) from each place on; from every place if none is given.

    Each word is mixed by itself: a product modulo 2^64 takes a difference only to higher bits, so top bytes of
    two words would differ in 8 bits of the sum."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    quads = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), 0, (1,))
    begins = [*range(0, size - 8, 8), size - 8]
    out = np.empty(len(data) - size + 1 if at is None else len(at), np.uint64)
    for low in range(0, len(out), BLOCK):
        total = out[low : low + BLOCK]
        total[:] = size
        if at is None:
            mixed = mix(quads[low : low + len(total) + size - 8])
        for k, begin in enumerate(begins):
            total += (mixed[begin : begin + len(total)] if at is None else mix(quads[at[low : low + BLOCK] + begin])) * _MUL[k]
        total[:] = mix(total)
    return out


def _slide(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over every `width` neighbouring values, one result per first place."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return pick(values[:-rest], values[rest:]) if rest else values


def anchors(texts: Texts, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, name) of all anchors, in order."""
    size = len(texts.data)
    if size < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    names = fixed_names(texts.data, None, K)
    width = window - K + 1
    least = _slide(names, width, np.minimum)  # of the window that begins at each place
    ends = texts.bounds[1:]
    # Windows that would cross the end of their text are no windows.
    change = np.zeros(size + 2, np.int32)
    np.add.at(change, np.maximum(ends - window + 1, texts.bounds[:-1]), 1)
    np.add.at(change, ends, -1)
    fits = np.cumsum(change)[: len(least)] == 0
    least[~fits] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(len(names) - len(least), np.uint64)])
    most = _slide(padded, width, np.maximum)  # of the windows that hold each place
    place = np.flatnonzero(most == names)
    return place, names[place]


def contexts(texts: Texts, place: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end) of each anchor's context."""
    owner = np.searchsorted(texts.bounds, place, "right") - 1
    return (owner, np.maximum(place - (window - K), texts.bounds[owner]),
            np.minimum(place + window, texts.bounds[owner + 1]))
