"""The stages of the pipeline, each on what the one before kept, against brute force."""

from collections import Counter

import corpus_pipeline
from test_lines import brute as clean_lines
from test_minhash import brute as group
from test_packing import check as check_packing

from tallyroll.llm import mixing, quality


def test_every_stage_on_what_the_one_before_kept(spark, small_documents, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    columns = small_documents.columns

    judged = {r["doc_id"] for r in quality.judge(small_documents).where("kept").collect()}
    docs = stages["quality_rules"](spark, small_documents, sf_dir).cache()
    assert docs.columns == columns
    assert sorted(r["doc_id"] for r in docs.collect()) == sorted(judged)

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    wanted = {doc_id: text for doc_id, text, _, _ in clean_lines(rows)}
    docs = stages["line_dedup"](spark, docs, sf_dir).cache()
    assert docs.columns == columns
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == wanted

    kept = {doc_id for doc_id, _, _, keep in group(list(wanted.items())) if keep}
    docs = stages["minhash_near_dedup"](spark, docs, sf_dir).cache()
    assert docs.columns == columns
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == {d: wanted[d] for d in kept}

    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(docs).collect()}
    docs = stages["source_mixing"](spark, docs, sf_dir).cache()
    assert docs.columns == columns
    assert Counter(r["doc_id"] for r in docs.collect()) == Counter({d: n for d, n in copies.items() if n})
    check_packing(docs)

    places = ["doc_id", "piece", "length", "ids_crc32"]
    run = corpus_pipeline.run(spark, sf_dir.replace("sf0.01", "sf0.001")).select(*places)
    packed = stages["best_fit_packing"](spark, docs, sf_dir).select(*places)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, packed.collect()))


def test_pipeline_on_awkward_rows(spark, awkward, no_docs, sf_dir):
    for docs in (awkward, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, stage(spark, docs, sf_dir).cache()
            assert name == "best_fit_packing" or docs.columns == before.columns
