"""The pipeline's stages: what each does, and that they are chained."""

import corpus_pipeline
from tracewell.llm import packing, pii, quality, simhash, suffix_dedup
from tracewell.llm.common import stored


def test_stages_do_what_their_operators_say(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "repeated_passages", "personal_data", "packing"]
    columns, tables = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], sf_dir), name))
    assert all(t.columns == columns for t in tables[:-1])
    ids = [sorted(r.doc_id for r in t.select("doc_id").collect()) for t in tables[:-1]]
    kept = {r.doc_id for r in quality.digest(docs, labels).filter("kept").collect()}
    assert ids[1] == sorted(kept) and 0 < len(ids[1]) < len(ids[0])
    assert ids[2] == sorted({r.component_id for r in simhash.clusters(tables[1]).collect()}) and len(ids[2]) < len(ids[1])
    assert ids[3] == ids[4] == ids[2]
    gone = {r.doc_id: r for r in suffix_dedup.digest(tables[2]).collect()}
    before = {r.doc_id: r.text for r in tables[2].collect()}
    for r in tables[3].collect():
        assert (r.text == before[r.doc_id]) == (gone[r.doc_id].n_removed == 0) and r.n_chars == len(r.text)
    for r in tables[4].collect():
        assert not pii.identifiers(r.text)
    assert tables[5].count() == packing.pieces(tables[4]).count()
    run = corpus_pipeline.run(spark, sf_dir)
    assert sorted(run.select("doc_id", "start", "ids").collect()) == sorted(tables[5].select("doc_id", "start", "ids").collect())


def test_stages_stand_edge_cases(spark, sf_dir, edge_docs, empty_docs):
    for docs in (edge_docs, empty_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, sf_dir), name)
