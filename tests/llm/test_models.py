import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from quotidian.llm import ctw, importance, language
from quotidian.llm.text import texts_of
from tests.llm import brute
from tests.llm.conftest import ordered, prose, rows_of

SYLLABLES = {"en": ["the", "ing", "tion", "wh", "sh"], "fr": ["eau", "oux", "ment", "é", "qu"], "de": ["sch", "ung", "keit", "ü"]}


def text_in(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(1)
    rows = [(i, text_in(rng, lang := rng.choice("en fr de".split()), rng.randint(3, 60)), lang) for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


def test_languages_of_held_out_texts(spoken):
    rows = language.identify(spoken).join(spoken, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == brute.held_out(r["doc_id"], 3, 1) for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_code_switching(spoken):
    rng = random.Random(4)
    model = language.fit([(r["lang"], r["text"]) for r in spoken.collect()])
    text = text_in(rng, "en", 40) + " " + text_in(rng, "fr", 30)
    words, marginal = language.label_words(texts_of(pa.array([text])), model)
    runs = language.spans(marginal, model.languages)
    assert [r["lang"] for r in runs] == ["en", "fr"] and abs(runs[0]["end_word"] - 40) <= 1
    assert len(words) == 70 and np.allclose(marginal.sum(1), 1)


def test_fitting_rows_take_turns(spoken):
    """The first of each language by the hash of the doc_id, as ranking all rows would give; some rows twice."""
    rows = spoken.unionByName(spoken.where("doc_id % 5 = 0")).selectExpr(
        "doc_id", "lang", "text", "xxhash64(doc_id) hash", "crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 held_out",
        "text is not null has_letter")
    taken = [r for r in rows.collect() if r["lang"] and not r["held_out"] and r["has_letter"]]
    by_lang = {}
    for r in sorted(taken, key=lambda r: r["hash"]):
        by_lang.setdefault(r["lang"], []).append(r)
    turns = sorted((i, lang, r["hash"], r["text"]) for lang, own in by_lang.items() for i, r in enumerate(own))
    for texts in (7, 40, 10_000):
        first = {(lang, text) for _, lang, _, text in turns[:texts]}
        got = language.fitting_rows(rows, texts)
        assert set(got) <= first and len(got) <= texts
        assert {lang for lang, _ in got} == {lang for lang, _ in first}
        if texts > len(turns):
            assert set(got) == first


def test_odd_texts_have_a_language(odd_docs, odd_rows, no_docs):
    got = language.identify(odd_docs).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        if r["doc_id"] in (200, 201, 202, 213):
            assert r["lang_pred"] == "und" and r["score"] == 0
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in ("en", "fr")
    assert language.identify(no_docs).collect() == []
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}


def test_chunked_chains_are_whole_ones():
    rng = np.random.default_rng(0)
    emit, move = rng.normal(size=(300, 3)) * 3, rng.normal(size=(3, 3))
    bounds = np.array([0, 1, 200, 200, 264, 300])
    got = language.chain(emit, move, bounds)
    for a, b in zip(bounds, bounds[1:]):
        ahead, v = [], np.full(3, 1 / 3)
        for t in range(a, b):
            v = (v @ np.exp(move)) * np.exp(emit[t])
            ahead.append(v := v / v.sum())
        v = np.ones(3)
        for t in range(b - 1, a - 1, -1):
            both = ahead[t - a] * v
            assert np.allclose(got[t], both / both.sum())
            v = np.exp(move) @ (np.exp(emit[t]) * v)
            v /= v.sum()


@pytest.mark.parametrize("piece", [1 << 20, 400])
def test_unigram_scores(odd_docs, pairs, piece):
    """Also with the texts in many pieces."""
    short = odd_docs.where("doc_id IS NULL OR doc_id NOT IN (209, 210)")
    kept = [p for p in pairs if p[0] not in (209, 210)]
    got = rows_of(ctw.score(short, depth=2, piece=piece), "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    expected = ordered(brute.unigram(kept))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in expected])


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_context_tree_by_hand(spark, depth):
    """Levels below, at and above those that groups are made of."""
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(0, 12), 5)) for i in range(40)] + [(90, ""), (91, None), (92, "zzz é\x00\x00"), (93, "AW1 ÉB \x00aw1")]
    scored = ctw.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), depth=depth, piece=200, group=40)
    train = [brute.raw(t) for d, t in rows if not brute.held_out(d, 10, 0)]
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    for doc, text in rows[::4] + rows[-4:]:
        assert got[doc] == pytest.approx(brute.context_tree(train, brute.raw(text), depth), abs=1e-6)


def test_every_text_has_a_code_length(spark):
    """The end is coded, so no text is certain; the odds of all texts of up to one byte stay below one."""
    rows = [(i, "ab ba" * (i % 3)) for i in range(30)] + [(100, ""), (101, None)]
    signs = [(200 + i, chr(i)) for i in range(128)]
    got = {r["doc_id"]: r for r in ctw.score(spark.createDataFrame(rows + signs, "doc_id long, text string")).collect()}
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in got.values())
    assert got[100]["score"] == got[101]["score"]
    assert 10 ** got[100]["score"] + sum(10 ** got[d]["score"] for d, s in signs if not s.isupper()) < 1
    assert got[200 + ord("A")]["score"] == got[200 + ord("a")]["score"]


def test_models_without_rows(odd_docs, no_docs):
    assert ctw.score(no_docs).collect() == []
    all_held = odd_docs.where("doc_id = 10").limit(1)
    row = ctw.score(all_held, folds=1).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0
    assert row["score"] == pytest.approx(-8 * math.log10(2) * (len(brute.raw(all_held.first()["text"])) + 1))
    assert row["bits_per_byte"] == pytest.approx(8)
    assert row["base_score"] == pytest.approx(0)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 7.9, 8, 100.5, 1e9])
    assert ctw.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-10, abs=1e-10)


@pytest.fixture(scope="module")
def graded(spark):
    """Clean prose, junk with odd signs, and toxic prose that has an insult here and there."""
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(900):
        words = prose(rng, rng.randint(20, 80), 60).split()
        kind = "clean" if i % 10 < 7 else "junk" if i % 10 == 7 else "toxic"
        if kind == "junk":
            words = [w + "###" for w in words]
        elif kind == "toxic":
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["scoundrel", "blockhead"]))
        docs.append((i, " ".join(words), kind))
        if i % 2:
            labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    return (spark.createDataFrame(docs, "doc_id long, text string, kind string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_sample_keeps_clean_documents(graded):
    docs, labels = graded
    got = importance.classify(docs, labels).join(docs, "doc_id").groupBy("kind").agg(
        F.avg(F.col("kept").cast("int")).alias("share"))
    share = {r["kind"]: r["share"] for r in got.collect()}
    assert share["clean"] > 0.98 and share["junk"] < 0.05 and share["toxic"] < 0.05
    kept = importance.keep_sampled(docs, labels)
    assert kept.schema == docs.schema
    wanted = importance.classify(docs, labels).where("kept").select("doc_id")
    assert rows_of(kept, "doc_id") == rows_of(wanted)


def test_sample_without_labels(odd_docs, no_docs, graded):
    none = graded[1].limit(0)
    assert all(r["kept"] for r in importance.classify(odd_docs, none).collect())
    assert importance.classify(no_docs, graded[1]).collect() == []
    odd = importance.classify(odd_docs, graded[1]).collect()
    assert len(odd) == odd_docs.count()
    assert all(r["log_weight"] == 0 for r in odd if r["doc_id"] in (200, 201, 202))


def test_kth_largest(spark):
    rng = random.Random(3)
    values = [rng.choice([5, -(1 << 50), 1 << 55, rng.randrange(1 << 40)]) for _ in range(500)]
    keys = spark.createDataFrame([(v,) for v in values], "key long")
    for k in (1, 77, 250, 500):
        assert importance.kth_largest(keys, k, bins=16) == sorted(values, reverse=True)[k - 1]


def test_keys_are_made_distinct_by_sorting(monkeypatch):
    """np.unique without counts hashes the keys, which took a tenth of the query's time."""
    unique = np.unique

    def counting(keys, **wanted):
        assert wanted, "hashes the keys"
        return unique(keys, **wanted)

    keys = np.array([5, -1, 5, 3, 1 << 40, 3, -1], np.int64)
    train = np.array([True, False, True, False, False, False, True])
    monkeypatch.setattr(np, "unique", counting)
    (seen, n), (other, zeros) = ctw._tally(keys, train)
    assert (seen.tolist(), n.tolist()) == ([-1, 5], [1, 2])
    assert (other.tolist(), zeros.tolist()) == ([-1, 3, 1 << 40], [0, 0, 0])
    assert ctw.distinct(keys).tolist() == [-1, 3, 5, 1 << 40]
    assert ctw.distinct(keys[:0]).tolist() == []


class Plan:
    """Takes the place of a DataFrame, and keeps the functions that would run in tasks."""

    def __init__(self):
        self.tasks = []

    def __getattr__(self, name):
        def step(*args, **kwargs):
            self.tasks += [x for x in args if callable(x)]
            return self

        return self if name in ("sparkSession", "conf") else step


def test_counts_are_passed_on_in_small_batches(spark):
    """Strings that all differ: a task held eight times its text, and passed millions of rows to the JVM at once."""
    text = np.random.default_rng(0).integers(97, 123, 6 << 20, np.uint8).tobytes().decode()
    texts = [text[i : i + (1 << 18)] for i in range(0, len(text), 1 << 18)]
    rows = pa.record_batch({"doc_id": list(range(len(texts))), "held_out": [False] * len(texts), "text": texts})
    deal = Plan()
    ctw.dealt(deal)
    piece = list(deal.tasks[0](iter([rows])))
    plan = Plan()
    ctw.counts(plan)
    found = {ctw.BYTE: [], ctw.WORD: [], ctw.END: []}
    sizes = []
    tracemalloc.start()
    for batch in plan.tasks[0](iter(piece)):
        sizes.append(batch.num_rows)
        found[batch.column(0)[0].as_py()].append(int(pc.sum(batch.column(2)).as_py()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160e6 and max(sizes) <= 1 << 16
    assert [sum(found[kind]) for kind in (ctw.BYTE, ctw.WORD, ctw.END)] == [len(text) + len(texts), len(texts), len(texts)]


def test_answers_are_passed_on_in_small_batches():
    width, n, pieces = ctw.DEPTH + 1, 50_000, 4
    keys = np.arange(n, dtype=np.int64)
    packed = np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()
    model = pa.table({"kind": np.zeros(n, np.int32), "key": keys, "value": keys * 0.5, "known": np.ones(n, bool)})
    asks = pa.table({"piece": list(range(pieces)), "kind": pa.array([ctw.BYTE] * pieces, pa.int32()), "keys": [packed] * pieces})
    plan = Plan()
    ctw.answered(plan, plan, ctw.DEPTH, 1)
    got = plan.tasks[-1](model, asks)
    assert [len(b) for b in got.to_batches()] == [1] * pieces
    assert got["piece"].to_pylist() == list(range(pieces)) and got["keys"].to_pylist() == [packed] * pieces
    assert all((np.frombuffer(v, np.float64) == keys * 0.5).all() for v in got["values"].to_pylist())


def test_distinct_keys_of_many_parts(monkeypatch):
    monkeypatch.setattr(ctw, "HELD", 40)
    rng = np.random.default_rng(1)
    parts = [rng.integers(-50, 50, 7) for _ in range(40)]
    held = ctw.Distinct()
    for part in parts:
        held.add(part)
    assert held.keys().tolist() == sorted(set(np.concatenate(parts).tolist()))
    assert ctw.Distinct().keys().tolist() == []
