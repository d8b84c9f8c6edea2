import math
import re
from collections import Counter

import pytest

from quotidian.llm import lexical
from tests.llm.conftest import LINE, rows_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = [
    (1, LINE), (2, "Jumps over the LAZY dog dog"), (3, "ha"), (4, ""), (5, None), (6, "日本語 Ünï ünï"), (7, "... !"),
    (8, "aw1 bw2 cw3"), (8, "bw2 dw4"), (None, "seven wizards"), (9, "no such term here"), (10, "x"), (11, "it s 123"),
]


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def by_hand(docs, items, keep):
    held = [(doc, Counter(TERM.findall(low(text)))) for doc, text in docs]
    held = [(doc, terms) for doc, terms in held if terms]
    n_docs, n_terms = len(held), sum(sum(t.values()) for _, t in held)
    df = Counter(term for _, terms in held for term in terms)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(TERM.findall(low(text)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc, tf in held:
            m = 100 - 50 + 50 * sum(tf.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * tf[t] // (1000 * tf[t] + 20 * m))
                for t in terms if t in tf)
            if score > 0:
                scored.append((-score, doc is None, doc, score))
        best = sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:keep]
        out += [(item, i + 1, doc, score) for i, (_, _, doc, score) in enumerate(best)]
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.fixture(scope="module")
def items(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({
        c: F.lit(c) for c in ("doc_id", "term", "score", "rank", "item")}).repartition(2)


@pytest.mark.parametrize("keep, limit", [(50, 1 << 20), (3, 1 << 20), (5, 60)])
def test_against_search_by_hand(odd_docs, pairs, items, keep, limit):
    """Also with items in many blocks; further columns, nulls, ties, repeated rows and ids, a very long text."""
    assert rows_of(lexical.rank(odd_docs, items, keep, limit)) == by_hand(pairs, ITEMS, keep)


def test_small_chunks_keep_the_best(odd_docs, pairs, items, monkeypatch):
    best = lexical.Best(3, 2)
    import numpy as np

    for begin in range(0, 40, 4):
        ids = np.arange(begin, begin + 4)
        best.add(np.stack([ids % 7, ids, np.zeros(4, np.int64)], axis=1), ids, np.zeros(4, np.int64))
    assert best.rows[[0, 1, 3]].T.tolist() == [[0, 6, 6], [0, 6, 13], [1, 39, 39], [1, 38, 38]]


def test_terms_are_met_whole_only():
    import pyarrow as pa

    from quotidian.llm.text import texts_of

    scan = lexical.Scanner([b"ab", b"b", b"a"])
    n, text, term, tf = scan(texts_of(pa.array(["ab b,b  bab", "", None, "A-a", "abb"], pa.string())))
    assert n.tolist() == [4, 0, 0, 2, 1]
    assert list(zip(text.tolist(), term.tolist(), tf.tolist())) == [(0, 0, 1), (0, 1, 2), (3, 2, 2)]


def test_empty_tables(odd_docs, no_docs, items):
    assert lexical.rank(no_docs, items).collect() == []
    empty = lexical.rank(odd_docs, items.limit(0))
    assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_text_of_ten_megabytes(spark, items):
    docs = spark.createDataFrame([(1, "ha " * 3_500_000 + "x"), (2, "x")], "doc_id long, text string")
    assert rows_of(lexical.rank(docs, items)) == by_hand([(1, "ha " * 3_500_000 + "x"), (2, "x")], ITEMS, 50)
