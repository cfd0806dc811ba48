"""The pipeline against its operators' own decisions on a small corpus written as Parquet."""

import corpus_pipeline
from plazaflow.llm import decontaminate, pieces, secrets, simhash

from . import corpus


def test_pipeline(spark, tmp_path):
    docs = corpus.documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    corpus.benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    at = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, at, str(tmp_path))
        out.write.parquet(f"{tmp_path}/stage-{name}")
        before, at = at, spark.read.parquet(f"{tmp_path}/stage-{name}")
        if k < 4:
            assert at.columns == docs.columns
        if name == "language_id":
            gone = {r.text for r in before.collect()} - {r.text for r in at.collect()}
            assert {None, "", " \t\n", "...", "123 456"} <= gone
        if name == "near_dedup":
            assert simhash.near_duplicates(at.where("doc_id IS NOT NULL")).where("doc_id <> component_id").count() == 0
            assert at.where("doc_id = 3").count() == 1
        if name == "decontamination":
            assert decontaminate.overlaps(at, corpus.benchmark(spark).where("item_id = 1")).where("size(hits) > 0").count() == 0
        if name == "secret_scans":
            automaton = secrets._automaton()
            assert not any(secrets.find((r.text or "").replace(secrets.MASK, ""), automaton) for r in at.collect())
        if name == "sentencepiece":
            sp = pieces.segmenter(pieces.default_model()).sp
            want = sorted(sp.encode(r.text) for r in before.collect())
            assert sorted(list(r.ids) for r in at.collect()) == want
    whole = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    assert sorted(whole.collect(), key=key) == sorted(at.collect(), key=key)
