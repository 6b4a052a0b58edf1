"""The registered queries on the given tables: against their SQL, and the pipeline against its stages' promises."""

import os

import corpus_pipeline
import duckdb
import pytest
from framelearn.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir)
    want = duck.execute(queries.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*[f"`{c}`" for c in columns]).collect()))) == sorted(map(repr, want.fetchall()))


def test_pipeline(spark, duck, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        n = docs.count()
        assert n == before if name == "line dedup" else 0 < n <= before
        before = n
    texts = [r.text for r in docs.collect()]
    items = [t for (t,) in duck.execute("SELECT text FROM benchmark").fetchall()]
    assert not any(i in t for i in items for t in texts)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in docs.collect()}
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"


def test_run_equals_the_packed_documents(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert rows and max(fill.values()) <= 1024
