import re

import numpy as np
import pytest

from quotidian.llm import fmindex
from tests.llm import brute
from tests.llm.conftest import LINE, ordered, rows_of

ITEMS = [
    (1, LINE), (2, "Jumps over the LAZY dog"), (3, "ha"), (4, ""), (5, None), (6, "日本語"), (7, "... !"),
    (8, "zebra"), (8, "ha ha ha ha ha ha ha ha ha ha ha"), (None, "seven wizards"), (9, LINE.upper()),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def expected(pairs, width):
    return ordered(brute.decontamination(pairs, [("" if i is None else i, t) for i, t in ITEMS], width))


@pytest.mark.parametrize("limit", [1 << 20, 40])
def test_report(odd_docs, pairs, items, limit, monkeypatch):
    """Also with a benchmark in many blocks."""
    monkeypatch.setattr(fmindex.with_hits, "__defaults__", (fmindex.WINDOW, limit))
    assert rows_of(fmindex.report(odd_docs, items, 10)) == expected(pairs, 10)


def test_short_windows(odd_docs, pairs, items):
    assert rows_of(fmindex.report(odd_docs, items, 3)) == expected(pairs, 3)


def test_empty_benchmark_and_documents(odd_docs, no_docs, items):
    assert all(r["n_hit"] == 0 for r in fmindex.report(odd_docs, items.limit(0)).collect())
    assert fmindex.report(no_docs, items).collect() == []


def test_removal(odd_docs, items, pairs):
    cleaned = fmindex.remove(odd_docs, items, 10)
    assert cleaned.schema.names == odd_docs.schema.names
    rows = [(r["doc_id"], r["text"], r["n_chars"]) for r in cleaned.collect()]
    assert len(rows) == len(pairs)
    assert all(not r[5] for r in expected([(d, t) for d, t, _ in rows], 10))
    clean = {(r[0]) for r in expected(pairs, 10) if not r[5]}
    before = {d: t for d, t in pairs}
    for doc, text, n in rows:
        assert n == (None if text is None else len(text))
        if doc in clean and doc is not None:
            assert text == before[doc]


@pytest.mark.parametrize("letters", [1, 3, 300])
def test_index_against_search_by_hand(letters):
    rng = np.random.default_rng(letters)
    for size in (1, 2, 50, 700):
        text = np.append(rng.integers(1, letters + 1, size), 0)
        index = fmindex.FMIndex(text, letters, sample=4)
        order = fmindex.suffix_array(text, letters)
        assert [tuple(text[i:]) for i in order] == sorted(tuple(text[i:]) for i in range(len(text)))
        windows = np.array([[*rng.integers(1, letters + 1, 3)] for _ in range(60)])
        sizes = rng.integers(1, 4, 60)
        windows[np.arange(3) >= sizes[:, None]] = 0
        low, high = index.search(windows, sizes)
        for w, s, a, b in zip(windows, sizes, low, high):
            found = sorted(index.locate(np.arange(a, b)).tolist())
            assert found == [i for i in range(len(text) - s + 1) if (text[i : i + s] == w[:s]).all()]


def test_words_that_sum_to_the_same_are_not_hit(spark):
    from tests.llm.test_text import swapped

    a, b = (w.decode() for w in swapped(1024))
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    items = spark.createDataFrame([(1, a)], "item_id long, text string")
    assert {r["doc_id"]: r["n_hit"] for r in fmindex.report(docs, items, 10).collect()} == {1: 1, 2: 0}


def by_rounds(text, width):
    """Marks the hit words by comparison with every window, cuts them, and starts again."""
    windows = set()
    for _, item in ITEMS:
        words = [item[a:b] for a, b in spans_of(item or "")]
        words = tuple(w.lower() for w in words)
        windows |= {words[i : i + width] for i in range(len(words) - width + 1)} if len(words) >= width else {words} - {()}
    while True:
        spans = spans_of(text)
        words = [text[a:b].lower() for a, b in spans]
        hit = [False] * len(words)
        for i in range(len(words)):
            for n in {len(w) for w in windows}:
                if tuple(words[i : i + n]) in windows:
                    hit[i : i + n] = [True] * n
        if not any(hit):
            return text
        out, at, i = [], 0, 0
        while i < len(words):
            if hit[i]:
                out.append(text[at : spans[i][0]])
                while i < len(words) and hit[i]:
                    at, i = spans[i][1], i + 1
            else:
                i += 1
        text = "\n".join([*out, text[at:]])


def spans_of(text):
    return [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]


@pytest.mark.parametrize("limit", [1 << 20, 40])
def test_removal_against_rounds_by_hand(spark, items, limit):
    """Windows of several items that overlap, words that become neighbours and are a window then, in one block and in
    many; columns of any name come through."""
    w = LINE.split()
    texts = ["jumps over the ha lazy dog, and more", " ".join(w[:6] + ["zebra"] + w[6:]) + " end", "zebra", "", None,
             "seven ha ha wizards", "before. " + LINE + ", jumps over the lazy dog. After!", "clean words stay",
             "Jumps over the Jumps over the lazy dog lazy dog tail"]
    docs = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _cut string").withColumnRenamed("_cut", "a.b")
    found = {r["doc_id"]: (r["text"], r["a.b"]) for r in fmindex.remove(docs, items, 10, limit).collect()}
    assert found == {i: (None if t is None else by_rounds(t, 10), "x") for i, t in enumerate(texts)}


def test_blocks_hold_what_their_limit_allows(spark):
    rng = np.random.default_rng(4)
    rows = [(i % 90, " ".join(f"w{x}" for x in rng.integers(0, 500, 40))) for i in range(300)] * 2
    blocks = fmindex.pattern_blocks(spark.createDataFrame(rows, "item_id long, text string"), 10, 20_000)
    sizes = [len(r["patterns"]) for r in blocks.collect()]
    assert len(sizes) > 15 and max(sizes) <= 20_000


def test_runs_are_numbered_alike_if_they_are_equal():
    words = np.random.default_rng(1).integers(0, 3, 400)
    for size in (1, 2, 3, 5, 8, 10):
        numbers = fmindex.run_numbers(words, size)
        runs = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        assert len(numbers) == len(runs)
        assert len(set(zip(numbers.tolist(), runs))) == len(set(runs)) == len(set(numbers.tolist()))


def test_long_text(spark):
    """Ten megabytes in one row, the window at its very end."""
    long = "lorem ipsum " * 870_000
    docs = spark.createDataFrame([(1, long + LINE), (2, long)], "doc_id long, text string")
    items = spark.createDataFrame([(1, LINE)], "item_id long, text string")
    n = len(LINE.split())
    assert {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in fmindex.report(docs, items, 10).collect()} == {
        1: (1_740_000 + n, n), 2: (1_740_000, 0)}
