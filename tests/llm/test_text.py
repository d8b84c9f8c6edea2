import pyarrow as pa
import xxhash

from quotidian.llm.simhash import allocate, forest, xxh64
from quotidian.llm.text import ALNUM, NOT_BLANK, hash_words, pieces, texts_of, words_of
from tests.llm import brute

import numpy as np


def test_words_as_by_pattern(pairs):
    texts = texts_of(pa.array([t for _, t in pairs], pa.string()))
    for kind, pattern, form in ((NOT_BLANK, brute.BLANK, texts), (ALNUM, brute.ALNUM, texts.lower())):
        words = words_of(form, kind)
        got = [[form.data[a:b].tobytes() for a, b in zip(words.starts[lo:hi], words.ends[lo:hi])]
               for lo, hi in zip(words.bounds, words.bounds[1:])]
        assert got == [pattern.findall(form.text(i)) for i in range(len(form))]


def test_names_tell_words_apart(pairs):
    texts = texts_of(pa.array([t for _, t in pairs], pa.string()))
    words = words_of(texts, NOT_BLANK)
    names = hash_words(texts.data, words.starts, words.ends)
    found = {}
    for name, a, b in zip(names.tolist(), words.starts, words.ends):
        found.setdefault(name, set()).add(texts.data[a:b].tobytes())
    assert all(len(v) == 1 for v in found.values())
    assert len(found) == len(set().union(*found.values()))


def test_pieces_hold_whole_texts(pairs):
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in pairs], pa.string())], ["text"]).slice(2)
    got = [texts.text(i) for _, texts in pieces(batch, "text", 100) for i in range(len(texts))]
    assert got == [brute.raw(t) for _, t in pairs[2:]]


def test_null_slots_with_bytes():
    values = pa.array(["abc", "de", "f"]).buffers()
    masked = pa.Array.from_buffers(pa.string(), 3, [pa.array([True, False, True]).buffers()[1], *values[1:]])
    texts = texts_of(masked)
    assert [texts.text(i) for i in range(3)] == [b"abc", b"", b"f"] and texts.null.tolist() == [False, True, False]


def test_xxh64_of_all_lengths():
    data = np.random.default_rng(0).integers(0, 256, 4000, dtype=np.uint8)
    starts = np.arange(0, 300)
    ends = starts + np.arange(300) % 131
    expected = [xxhash.xxh64_intdigest(data[a:b].tobytes(), seed=42) for a, b in zip(starts, ends)]
    assert xxh64(data, starts, ends, 42).tolist() == expected


def test_thresholds_take_the_cheapest_split():
    costs = [{-1: 0, 0: 10, 1: 50, 2: 99}, {-1: 0, 0: 1000, 1: 5000, 2: 9999}, {-1: 0, 0: 10, 1: 20, 2: 99}]
    assert allocate(costs, 0) == [0, -1, 1]


def test_forest_links_chains():
    fps = np.array([0, 3, 15, 7 << 40, (7 << 40) | 1], np.int64)
    a, b = forest(fps, 2)
    assert dict(zip(a.tolist(), b.tolist())) == {3: 0, 15: 0, (7 << 40) | 1: 7 << 40}


def swapped(size):
    """A word of a and b, and the one with both exchanged, whose bytes weighed by powers of any odd number sum
    to the same modulo 2 ** 64 once it is long enough."""
    word = b"a"
    while len(word) < size:
        word += word.translate(bytes.maketrans(b"ab", b"ba"))
    return word[:size], word[:size].translate(bytes.maketrans(b"ab", b"ba"))


def test_swapped_words_have_names_of_their_own():
    rng = np.random.default_rng(3)
    words = set()
    for size in (8, 16, 63, 64, 65, 72, 128, 256, 1000, 1024, 2048, 4096):
        for word in swapped(size):
            words.add(word)
            for _ in range(200):  # blocks of eight bytes exchanged, which any sum over blocks would not see
                blocks = [word[i : i + 8] for i in range(0, size, 8)]
                i, j = rng.integers(0, len(blocks), 2)
                blocks[i], blocks[j] = blocks[j], blocks[i]
                words.add(b"".join(blocks))
                k = int(rng.integers(0, size))
                words.add(word[:k] + bytes([word[k] ^ 3]) + word[k + 1 :])
    words = sorted(words)
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = np.append(0, ends[:-1])
    names = hash_words(data, starts, ends)
    assert len(set(names.tolist())) == len(words)
    moved = hash_words(np.concatenate([np.frombuffer(b"xyz", np.uint8), data]), starts + 3, ends + 3)
    assert (moved == names).all()


def test_trailing_zeros_tell_words_apart():
    data = np.zeros(100, np.uint8)
    names = hash_words(data, np.zeros(80, np.int64), np.arange(80))
    assert len(set(names.tolist())) == 80
