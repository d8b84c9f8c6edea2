import random

import numpy as np
import pyarrow as pa
import pytest

from quotidian.llm import recompression, simhash, suffixes
from quotidian.llm.anchors import anchors, fixed_names
from quotidian.llm.text import texts_of
from tests.llm import brute
from tests.llm.conftest import ordered, prose, rows_of


def test_byte_dedup(odd_docs, pairs):
    assert rows_of(suffixes.digests(odd_docs, 50)) == ordered(brute.byte_dedup(pairs, 50))


def test_word_dedup(odd_docs, pairs):
    assert rows_of(recompression.digests(odd_docs, 13)) == ordered(brute.word_dedup(pairs, 13))


@pytest.mark.parametrize("run", [suffixes.digests, recompression.digests, simhash.near_duplicates])
def test_empty_tables(run, no_docs):
    assert run(no_docs).collect() == []


@pytest.fixture(scope="module")
def repetitive():
    """Small vocabularies, so that windows repeat in many ways, also within a text and around crowded lines."""
    rng = random.Random(9)
    line = prose(rng, 14, 3)
    rows = []
    for i in range(160):
        words = prose(rng, rng.randint(0, 60), 2).split()
        cut = rng.randint(0, len(words))
        middle = [line] * rng.randint(0, 2) if i % 2 else []
        rows.append((i * 7 % 160, " ".join([*words[:cut], *middle, *words[cut:]])))
    return rows


def test_repetitive_texts(spark, repetitive, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD", 5)
    monkeypatch.setattr(suffixes, "BLOCK", 500)
    docs = spark.createDataFrame(repetitive, "doc_id long, text string").repartition(4)
    assert rows_of(suffixes.digests(docs, 50)) == ordered(brute.byte_dedup(repetitive, 50))
    assert rows_of(recompression.digests(docs, 13)) == ordered(brute.word_dedup(repetitive, 13))


def test_phrases_verify_long_repeats():
    """Of a passage inside different texts, all but its ends lies in phrases that both have; equal names, equal words."""
    rng = random.Random(12)
    passage = prose(rng, 400, 4)
    texts = [f"{prose(rng, 70, 4)} {passage} {prose(rng, 90, 4)}" for _ in range(2)] + ["the " * 300, ""]
    words, names = recompression._words(texts_of(pa.array(texts)))
    found = [{}, {}, {}, {}]
    _, high = recompression.parse(names, words, 3, recompression.PHRASE_ROUNDS)
    p = recompression.phrases(high, 3, 13)
    for name, owner, a, b in zip(p.name, p.owner, p.begin, p.end):
        assert b - a >= 13 and words.bounds[owner] <= a and b <= words.bounds[owner + 1]
        found[owner].setdefault(int(name), set()).add((a, b))
    both = found[0].keys() & found[1].keys()
    spelt = [{n: {" ".join(t.split()[a - words.bounds[i] : b - words.bounds[i]]) for a, b in spans} for n, spans in f.items()}
             for i, (t, f) in enumerate(zip(texts, found))]
    assert all(spelt[0][n] == spelt[1][n] and len(spelt[0][n]) == 1 for n in both)
    windows = {i for n in both for a, b in found[0][n] for i in range(a, b - 12)}
    assert len(windows) > 0.7 * 388 and not found[2] and not found[3]


def test_copies_with_changed_ends(spark):
    """Long copies, whole and in part, in documents of every order; phrases and windows settle them together."""
    rng = random.Random(21)
    stems = [prose(rng, 200, 4).split() for _ in range(4)]
    rows = []
    for i in range(60):
        stem = stems[i % 4]
        a, b = sorted(rng.sample(range(201), 2))
        rows.append((i * 37 % 60, " ".join([*prose(rng, rng.randint(0, 20), 4).split(), *stem[a:b], *prose(rng, rng.randint(0, 20), 4).split()])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(recompression.digests(docs, 13)) == ordered(brute.word_dedup(rows, 13))


@pytest.mark.parametrize("size, places", [(24, (7, 15)), (24, (15, 23)), (76, (15, 63)), (76, (7, 75)), (50, (7, 39))])
def test_names_of_strings_that_differ_in_top_bytes(size, places):
    data = np.tile(np.frombuffer(b"the quick brown fox " * 4, np.uint8)[:size], (1 << 16, 1))
    data[:, places[0]], data[:, places[1]] = np.divmod(np.arange(1 << 16), 256)
    at = np.arange(1 << 16) * size
    assert len(np.unique(fixed_names(data.ravel(), at, size))) == 1 << 16
    assert (fixed_names(data.ravel(), None, size)[at] == fixed_names(data.ravel(), at, size)).all()


def test_contexts_that_differ_in_top_bytes(spark):
    """Texts that are one context each, all around one anchor."""
    rng = random.Random(4)
    place = []
    while list(place) != [26]:
        stem = bytearray("".join(rng.choices("abcdefgh ", k=76)).encode())
        place, _ = anchors(texts_of(pa.array([stem.decode()])), 50)
    texts = []
    for i in range(6):  # no window avoids both places, and no two texts share either byte
        stem[15], stem[63] = 97 + 3 * i, 60 + 7 * i
        texts.append(stem.decode())
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert rows_of(suffixes.digests(docs, 50)) == ordered(brute.byte_dedup(rows, 50))


def test_difference_cover():
    cover = suffixes.difference_cover(16)
    assert {(a - b) % 16 for a in cover for b in cover} == set(range(16))


def test_near_duplicates(odd_docs, pairs):
    assert rows_of(simhash.near_duplicates(odd_docs)) == ordered(brute.near_duplicates(pairs))


@pytest.mark.parametrize("bucket", [1, 2048])
@pytest.mark.parametrize("limits", [[0, 0, 0], [2, -1, -1], [-1, 1, 0]])
def test_links_of_close_fingerprints(spark, bucket, limits):
    """Every way of probing finds the same components, in small and in split buckets."""
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    near = [c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)))
            for c in np.repeat(centres, 30)]
    fps = sorted({int(x) for x in near})
    distinct = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    parts = [list(range(0, 22)), list(range(22, 43)), list(range(43, 64))]
    label = simhash.components(simhash.links(distinct, parts, limits, 2, bucket))
    got = {r["fp"]: r["root"] for r in label.collect()}
    for i, a in enumerate(fps):
        signed = int(np.uint64(a).astype(np.int64))
        linked = [b for b in fps if b != a and (a ^ b).bit_count() <= 2]
        assert (signed in got) == bool(linked)
        for b in linked:
            assert got[signed] == got[int(np.uint64(b).astype(np.int64))]
    groups = len(set(got.values()))
    seen, expected = set(), 0
    for a in fps:
        if a in seen or not any(b != a and (a ^ b).bit_count() <= 2 for b in fps):
            continue
        expected, stack = expected + 1, [a]
        while stack:
            x = stack.pop()
            if x not in seen:
                seen.add(x)
                stack += [b for b in fps if (x ^ b).bit_count() <= 2]
    assert groups == expected


def test_one_document_of_each_group_stays(odd_docs, pairs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    heads = {c for _, _, c in brute.near_duplicates([p for p in pairs if p[0] is not None])}
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(heads)
    assert ids.count(None) == sum(d is None for d, _ in pairs)


def test_words_that_sum_to_the_same_are_not_taken_for_copies(spark):
    from tests.llm.test_text import swapped

    a, b = (w.decode() for w in swapped(1024))
    start = " ".join(f"w{i}" for i in range(12))
    docs = [(1, f"{start} {a}"), (2, f"{start} {b}"), (3, f"{start} {a}")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in recompression.digests(frame, window=13).collect()}
    assert got == {1: 0, 2: 0, 3: 13}
