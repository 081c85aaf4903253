import pytest

import corpus_pipeline
from flowmetrics.llm import queries
from tests.oracle import connect, duck_rows, spark_rows, types_match

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(session, name):
    con = connect(SF)
    df = queries.queries()[name](session, SF)
    assert types_match(df, con, queries.oracle_sql()[name]) == []
    assert spark_rows(df) == duck_rows(con, queries.oracle_sql()[name])


def test_one_query_per_operator():
    assert sorted(n.split("_")[0] for n in queries.queries()) == sorted(f"op{i}" for i in range(1, 14))


def test_shards_of_the_contract(session):
    out = queries.op9_stratified_shards(session, SF).toPandas()
    assert set(out["law"]) == {"rows"} and out["grown_shard"].isna().all()
    sizes = out.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1 and len(sizes) == 40


def test_pipeline_stages_keep_columns_and_decide(session):
    docs = session.read.parquet(f"{SF}/documents.parquet")
    ids = {r[0] for r in docs.select("doc_id").collect()}
    *stages, (name, last) = corpus_pipeline.STAGES
    folder = queries.scratch_path(session, "stages")
    for i, (_, stage) in enumerate(stages):
        out = stage(session, docs, SF)
        assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{i}")
        docs = session.read.parquet(f"{folder}/{i}")
        left = {r[0] for r in docs.select("doc_id").collect()}
        assert left <= ids
        ids = left
    packed = last(session, docs, SF)
    assert {r[0] for r in packed.select("doc_id").collect()} == ids
    leaks = queries.op2_string_tiling(session, SF).select("doc_id").collect()
    assert not ids & {r[0] for r in leaks}
