import duckdb
import pytest

import corpus_pipeline
from quotidian.llm.queries import ORACLES, QUERIES, table

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twins(spark, name):
    con = duckdb.connect()
    for source in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {source} AS SELECT * FROM read_parquet('{FOLDER}/{source}.parquet')")
    twin = con.execute(ORACLES[name])
    columns = [d[0] for d in twin.description]
    ours = QUERIES[name](spark, FOLDER)
    assert sorted(ours.columns) == sorted(columns)
    assert sorted(tuple(r) for r in ours.select(columns).collect()) == sorted(twin.fetchall())


def test_stages_pass_on_documents(spark):
    docs = table(spark, FOLDER, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = corpus_pipeline.saved(stage(spark, docs, FOLDER), "stage")
        assert docs.columns == COLUMNS and 0 < docs.count() <= 3 * before
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == docs.count()


def test_empty_input(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).collect() == []


def test_odd_documents(spark, odd_docs):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.saved(stage(spark, docs, FOLDER), "odd")
    assert docs.count() > 0
