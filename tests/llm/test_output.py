import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quotidian.llm import bitplane, mixing
from quotidian.llm.queries import tokenizer_path
from quotidian.llm.text import texts_of
from tests.llm import brute
from tests.llm.conftest import ordered, rows_of

ODD = ["", None, " ", "a", " a", "a ", "  a  b ", "<|endoftext|> x <|endoftext|>y", "it's 'tis  'll don 't\n\n x \n y",
       "日本 語 テキスト", "\t x", "x　 y", "a  \n  b", " !", "é è à.", "a\x7f b \x1c c", " " * 20 + "z" + " " * 7,
       "1 2 3.4 5,6 $7", "x.\ny", "Foo,bar; baz", "\nx", "— , a", "a<|endoftext|>.b", "end", "of", "end "]


def test_ids_as_of_whole_texts(pairs):
    encoder = bitplane.Encoder(tokenizer_path())
    texts = [*ODD, *[t for _, t in pairs if t is None or len(t) < 5000]]
    for _ in range(2):  # the second time from memory
        ids, bounds = encoder.encode(texts_of(pa.array(texts, pa.string())))
        got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        assert got == [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_ids_around_blank_lines():
    encoder = bitplane.Encoder(tokenizer_path())
    texts = ["a\n\nb", "a.\n\n1", "a \n\nb", "foo \nbar", "foo\r\nbar", "\n\nx", "\u00a0\nx", "\u3000\nx", "a \n", "b\n\n", "\n", "c"]
    rng = random.Random(3)
    signs = ["\n", "\n", "\n\n", " ", "\t", "\r", "\u00a0", "\u2028", "\u3000", "a", "Foo", "7", ".", ",", "'s", "é", "<|endoftext|>"]
    texts += ["".join(rng.choices(signs, k=rng.randint(1, 12))) for _ in range(5000)]
    ids, bounds = encoder.encode(texts_of(pa.array(texts, pa.string())))
    got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    for n in (1, 7, 1000):
        ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
        frames = bitplane.to_planes(ids, kind, 3)
        assert len(frames) == (4 if kind == "byte" else 32)
        assert (bitplane.from_planes(frames, n) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_files(spark, odd_docs, pairs, kind, monkeypatch):
    got = rows_of(bitplane.write_and_read(odd_docs, tokenizer_path(), kind))
    tokenizer = bitplane.Encoder(tokenizer_path()).tokenizer
    encoded = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in pairs}
    expected = sorted(((d is not None, d, len(encoded[t]), zlib.crc32(np.array(encoded[t], "<u4").tobytes()))
                       for d, t in pairs), key=lambda r: (r[0], r[1] or 0))
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in by_start] == [r[1] for r in expected]
    assert [r[1] for r in by_start] == np.concatenate([[0], np.cumsum([r[2] for r in by_start])[:-1]]).tolist()
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in got) == sorted((a, b or 0, c, d) for a, b, c, d in expected)


def test_no_documents(no_docs):
    assert bitplane.write_and_read(no_docs, tokenizer_path()).collect() == []
    assert mixing.mixed(no_docs).collect() == []
    assert mixing.emit(no_docs).collect() == []


def test_mix(odd_docs, odd_rows):
    got = mixing.mixed(odd_docs).collect()
    sizes: dict = {}
    for _, text, _, source in odd_rows:
        sizes[source] = sizes.get(source, 0) + len(brute.BLANK.findall(brute.raw(text)))
    targets = brute.mix_targets(sizes)
    assert len(got) == len(odd_rows)
    by_size = {v: k for k, v in sizes.items()}
    taken: dict = {}
    for r in got:
        source = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(targets[source])
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[source] = taken.get(source, 0) + r["taken"]
    longest = max(r["size"] for r in got)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 3 * longest
    assert rows_of(mixing.mixed(odd_docs)) == ordered([tuple(r) for r in got])


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 10, "b": 1, "c": 100, None: 5}, {"a": 0, "b": 7}, {"a": 0}])
def test_targets_stop_at_three_times_the_size(spark, sizes):
    rows = [(s, "n" if s is None else "s" + s, n) for s, n in sizes.items()]
    got = mixing.targets(spark.createDataFrame(rows, "source string, _key string, size long")).collect()
    expected = brute.mix_targets(sizes)
    assert {r["_key"]: pytest.approx(r["target"]) for r in got} == {
        "n" if s is None else "s" + s: t for s, t in expected.items()}


def test_order_does_not_depend_on_buckets(odd_docs, monkeypatch):
    one = rows_of(mixing.mixed(odd_docs))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    assert rows_of(mixing.mixed(odd_docs)) == one


def test_emitted_rows(odd_docs):
    emitted = mixing.emit(odd_docs)
    assert emitted.schema == odd_docs.schema
    copies = {}
    for r in emitted.collect():
        copies[(r["doc_id"], r["text"])] = copies.get((r["doc_id"], r["text"]), 0) + 1
    words = {}
    for r in mixing.mixed(odd_docs).collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + r["taken"]
    got = {}
    for (doc, text), n in copies.items():
        got[doc] = got.get(doc, 0) + n * len(brute.BLANK.findall(brute.raw(text)))
    assert {d: n for d, n in words.items() if n} == {d: n for d, n in got.items() if n}


def test_words_that_sum_to_the_same_have_their_own_ids():
    from tests.llm.test_text import swapped

    encoder = bitplane.Encoder(tokenizer_path())
    for word in swapped(1024):  # the second one after the first is remembered
        ids, _ = encoder.encode(texts_of(pa.array([word.decode()], pa.string())))
        assert ids.tolist() == encoder.tokenizer.encode(word.decode(), add_special_tokens=False).ids
