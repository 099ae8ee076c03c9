"""The registered queries against DuckDB, and the pipeline, on the smallest tables."""

import pytest

from checks.compare import _rows, database
from dossierflow.llm.queries import ORACLES, QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want) and len(got)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from dossierflow.llm import decontaminate, simhash

    first = spark.read.parquet(f"{SF}/documents.parquet")
    docs, counts = first, [first.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        counts.append(docs.count())
        if k < 4:
            assert docs.schema == first.schema
            assert docs.exceptAll(first).count() == 0  # rows as they were
        if k == 1:
            assert docs.select("text").distinct().count() == counts[-1]
        if k == 2:
            found = simhash.near_duplicates(spark, docs)
            assert found.select("component_id").distinct().count() == counts[-1]
        if k == 3:
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            assert decontaminate.find_contamination(spark, docs, bench).where("n_hit > 0").count() == 0
            kept = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == kept
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > counts[4] > 0
