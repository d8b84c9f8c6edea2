from __future__ import annotations

import random

import pytest

LINE = "The quick brown fox jumps over the lazy dog while seven wizards box with jugs of liquor"


def prose(rng: random.Random, n: int, alphabet: int = 400) -> str:
    return " ".join(f"{rng.choice('abcdefgh')}w{rng.randrange(alphabet)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source): nulls, empty and blank texts, ties, repeated rows, copies, near copies,
    shared passages, a very long text, signs beyond ASCII, runs of one word."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(1, 60)) for _ in range(40)]
    rows = [(i + 10, text, rng.choice(["en", "fr", None]), rng.choice(["a", "b", None])) for i, text in enumerate(base)]
    rows += [(100 + i, base[i], "en", "a") for i in range(8)]  # copies
    rows += [(120 + i, base[i] + " tail", "en", "b") for i in range(8)]
    rows += [(140 + i, f"{prose(rng, 9)} {LINE} {prose(rng, 9)}", "fr", "c") for i in range(6)]
    long = prose(rng, 30000, 50000)
    return rows + [
        (None, base[0], "en", "a"), (None, None, None, None), (200, None, "en", None), (201, "", "en", "a"),
        (202, " \n\t ", None, "b"), (203, "ha " * 60, "en", "b"), (204, "ha " * 50 + "x", "en", "b"),
        (205, "Ünï çödé — текст 日本語 " * 5, "fr", "c"), (206, "Ünï çödé — текст 日本語 " * 5, "fr", "c"),
        (207, "x" * 400, "en", "c"), (208, "x" * 300 + "y" * 200, "en", "c"), (209, long, "en", "a"),
        (210, long[5000:90000], "en", "a"), (211, "a\x00b\x00" * 40, "en", "a"), (212, LINE, "en", "c"),
        (212, LINE, "en", "c"), (213, "123 456 !?", "en", None), (7, LINE + " " + LINE, "en", "c"),
        (-3, base[1], "en", "a"), (214, "<|endoftext|> it's\n\n done.\nNext", "en", "b"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The same with further columns, whose names operators use inside."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string").repartition(3)
    extra = ["shared", "smaller", "names", "key", "kept", "size", "_size", "_key", "digest", "row", "copy", "shard",
             "held_out", "target", "_copies", "held", "bucket", "_hits", "score"]
    return docs.withColumns({c: F.lit(f"{c}!") for c in extra}).withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def pairs(odd_rows):
    return [(doc, text) for doc, text, _, _ in odd_rows]


def rows_of(df, *columns):
    """Rows as tuples, nulls first."""
    found = [tuple(r) for r in df.select(*columns).collect()] if columns else [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, v) for v in r))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
