import random
import re

import pytest
from pyspark.sql import functions as F

from quotidian.llm import licenses
from tests.llm.conftest import rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def by_hand(docs, templates=licenses.TEMPLATES, threshold=licenses.THRESHOLD):
    out = []
    for doc, text in docs:
        words = WORD.findall(low(text))
        spots, named = [], set()
        for phrase, label in licenses.PHRASES:
            parts = phrase.split()
            found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            spots += found
            named |= {label} if found else set()
        labels, share = set(named), 0.0
        for t in licenses.read_templates(templates):
            for start in range(0, len(words), t.span):
                common = len(set(words[start : start + 2 * t.span]) & set(t.words))
                if common * 1000 >= round(threshold * 1000) * len(t.words):
                    labels.add(t.label)
                    share = max(share, common / len(t.words))
        out.append((doc, len(words), len(spots), min(spots, default=None), max(spots, default=None),
                    ",".join(sorted(named)), ",".join(sorted(labels)), 1.0 if spots else share))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.fixture(scope="module")
def texts(pairs):
    rng = random.Random(3)
    rows = list(pairs)
    for i, (_, text) in enumerate(licenses.TEMPLATES):
        words = text.split()
        rows.append((300 + i, text))
        rows.append((320 + i, " filler" * rng.randrange(80) + "\n" + ",  ".join(words).upper() + " filler" * rng.randrange(200)))
        lost = rng.randrange(len(words))
        rows.append((340 + i, " ".join(words[:lost] + words[lost + 1 :])))
        rows.append((360 + i, " ".join(w for w in words if rng.random() > 0.12)))
        rows.append((380 + i, " ".join(words[: len(words) // 2])))
        rng.shuffle(words)
        rows.append((400 + i, " ".join(f"{w} und" if rng.random() < 0.2 else w for w in words)))
    return rows + [
        (500, "MIT License mit-license MIT LICENSES"), (501, "Apache\nlicense, general public; license"),
        (502, "mit"), (503, "general general public license license"), (504, "Kind License mİt license"),
        (505, "the " * 300_000 + "mit license"), (None, "MIT license"), (None, "MIT license"),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    return frame.withColumns({c: F.lit(f"{c}!") for c in (
        "digest", "terms", "word", "span", "labels", "met_id", "block", "held", "found", "share", "p0", "score")})


def test_against_scan_by_hand(docs, texts):
    assert rows_of(licenses.scan(docs)) == by_hand(texts)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_other_thresholds(docs, texts, threshold):
    assert rows_of(licenses.scan(docs, threshold=threshold)) == by_hand(texts, threshold=threshold)


def test_other_templates(docs, texts):
    own = (("line", "the quick brown fox jumps over the lazy dog"), ("long", " ".join(f"w{i}" for i in range(100))))
    assert rows_of(licenses.scan(docs, own)) == by_hand(texts, own)


def test_no_documents(docs):
    assert licenses.scan(docs.limit(0)).collect() == []


def test_no_python_and_no_text_in_an_exchange(docs):
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    for line in plan.splitlines():
        if "Exchange" in line:
            assert "text#" not in line and "terms#" not in line
