"""The registered queries against their SQL, and the pipeline stage by stage."""

import pytest
from conftest import SF

import corpus_pipeline
import oracle_tools
from countyrisk import session
from countyrisk.llm import jaccard_join, packing, quality_rules
from countyrisk.llm.lengths import written
from countyrisk.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert oracle_tools.compare(QUERIES[name](spark, SF), oracle_tools.connect(SF), ORACLES[name]) is None


def test_thirteen_queries():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in quality_rules.quality_report(docs).where("kept").collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    after = {}
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        frame = written(stage(spark, frame, SF), f"test-{name}")
        after[name] = frame
        if name != names[-1]:
            assert frame.columns == docs.columns
    ids = lambda name: [r.doc_id for r in after[name].select("doc_id").collect()]
    assert set(ids(names[0])) == kept and len(ids(names[0])) == len(kept)
    heads = jaccard_join.similar_components(after[names[0]], 5, 80).where("doc_id = component_id").select("doc_id").collect()
    assert sorted(ids(names[1])) == sorted(r.doc_id for r in heads)
    assert sorted(ids(names[2])) == sorted(ids(names[1]))
    assert after[names[2]].where("text rlike 'token = .[0-9a-f]{40}'").count() == 0
    packed = after[names[4]].groupBy("bin_id").sum("n_words").collect()
    assert max(r[1] for r in packed) <= packing.CAPACITY
    assert set(ids(names[4])) == set(ids(names[3]))


def test_pipeline_keeps_the_last_rows_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path / "shared"))
    spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").write.parquet(str(tmp_path / "documents.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "shared" / "countyrisk").iterdir()}
    assert left == {"stage-best_fit_packing"} and packed.count() > 0
    spark.read.parquet(f"{SF}/documents.parquet").where("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
