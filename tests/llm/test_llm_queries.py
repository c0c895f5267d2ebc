"""The registered queries against their SQL, and the pipeline against its stages."""

import pytest
from compare import connect, difference

import corpus_pipeline
from clipledger.llm.queries import ORACLES, QUERIES
from clipledger.session import stored


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name in ORACLES:
        assert difference(df, connect(sf_dir), ORACLES[name]) is None
    else:
        assert df.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


@pytest.mark.parametrize("name", ["op1_quality_rules", "op4_line_dedup", "op8_exact_dedup"])
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_pipeline_stages(spark, sf_dir):
    docs = corpus_pipeline.documents(spark, sf_dir)
    columns = docs.columns
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        assert docs.columns == columns
        assert docs.where("n_chars <> char_length(text)").count() == 0
        counts.append(docs.count())
    assert counts[0] > counts[1] == counts[2] > counts[3] == counts[4] > 0
    packed = corpus_pipeline.run(spark, sf_dir)
    assert sorted(r[0] for r in packed.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_pipeline_on_odd_rows(spark, docs, tmp_path):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(None, 1, 0), (1, None, None), (2, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
