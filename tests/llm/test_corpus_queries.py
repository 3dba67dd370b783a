"""Registered corpus queries: against their SQL where they have it, for shape and repeatability where not."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ordermill.llm.oracle import ORACLE
from ordermill.llm.queries import REGISTRY

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def other():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_one_query_for_each_operator_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
    assert set(REGISTRY) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, other, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = Counter(tuple(r[c] for c in columns) for r in df.collect())
    result = other.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert {d[0]: str(d[1]) for d in result.description} == {c: TYPES[t] for c, t in df.dtypes}
    assert found == Counter(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())


@pytest.mark.parametrize("name", ["op2_histogram_sharding", "op7_minhash_near_duplicates", "op8_phrase_automata", "op9_kneser_ney_quality"])
def test_one_row_per_document(spark, name):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = REGISTRY[name](spark, FOLDER)
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_pipeline_stages(spark):
    """Each stage on its own input: what goes is what its operator rejects, what stays is whole."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    counts, held = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, held, FOLDER)
        if name != "sharding":
            assert out.columns == columns
            assert out.select(columns).distinct().join(held, columns, "left_anti").count() == 0
        held = corpus_pipeline.materialise(out, "stage")
        counts.append(held.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] <= counts[4] == counts[5]
    ids = {r.doc_id for r in held.select("doc_id").distinct().collect()}
    assert len(ids) == counts[3] and held.select("shard").distinct().count() == corpus_pipeline.SHARDS
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()) == sorted(r.doc_id for r in held.select("doc_id").collect())


def test_pipeline_survives_awkward_documents(spark):
    from tests.llm import cases

    docs = cases.clashing(cases.frame(spark), "kept", "Shard", "block")
    rows = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        docs = corpus_pipeline.materialise(out, "stage")
        assert 0 < docs.count() <= 2 * rows
        assert {r.kept for r in docs.select("kept").collect()} == {r.block for r in docs.select("block").collect()} == {"theirs"}
    nothing = cases.frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, FOLDER)
    assert nothing.count() == 0
