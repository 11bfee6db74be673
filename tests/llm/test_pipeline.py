"""The stages against plain versions of themselves, each on what its predecessor kept."""

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.durable import settle
from tidemark.llm import langid, quality
from tidemark.llm.common import learns
from tidemark.llm.vocabulary import default_path
from tidemark.sources.tables import read_table

from .test_simhash import brute
from .test_tokens import check_packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_the_smallest_tables(spark, folder):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_classifier", "simhash_near_dedup", "best_fit_packing"]
    docs = read_table(spark, folder, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, settle(stage(spark, docs, folder), name)
        kept[name] = (before, docs)
        if name != names[-1]:
            assert docs.columns == COLUMNS
            assert docs.exceptAll(before).count() == 0

    before, after = kept["language_id"]
    model = langid.fit(before.where(learns("doc_id", 4, 2)))
    judged = langid.predict(before, model).collect()
    gone = {r["doc_id"] for r in judged if r["lang_pred"] == "und" or (r["score"] < 0.5 and r["n_words"] >= 8)}
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - gone

    before, after = kept["quality_classifier"]
    teach = learns("doc_id", 3, 1)
    labels = read_table(spark, folder, "labels")
    model = quality.fit(before.where(teach), labels.where(teach))
    good = {r["doc_id"] for r in quality.score(before, model).collect() if r["score"] >= 0.5}
    assert {r["doc_id"] for r in after.collect()} == good

    # The smallest key of each group that plain comparison of fingerprints finds.
    before, after = kept["simhash_near_dedup"]
    groups = brute([(r["doc_id"], r["text"]) for r in before.collect()])
    assert {r["doc_id"] for r in after.collect()} == {i for i, _, component in groups if i == component}

    _, after = kept["best_fit_packing"]
    texts = {r["doc_id"]: r["text"] for r in kept["best_fit_packing"][0].collect()}
    check_packing(after.collect(), texts, Tokenizer.from_file(default_path()), 2048)


def test_run_gives_the_last_stage(spark, folder):
    result = corpus_pipeline.run(spark, folder)
    assert result.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert result.count() > 0


@pytest.mark.parametrize("number", range(4))
def test_stages_take_empty_tables_and_nulls(spark, folder, odd_docs, number):
    stage = corpus_pipeline.STAGES[number][1]
    assert stage(spark, odd_docs.limit(0), folder).count() == 0
    rows = stage(spark, odd_docs, folder)
    assert rows.count() > 0
    if number < 3:
        assert rows.columns == odd_docs.columns


@pytest.mark.parametrize("labels", [[], [(1, None, 0), (None, 1, None), (2, 7, 0)]])
def test_quality_stage_without_usable_labels_keeps_all(spark, odd_docs, tmp_path, labels):
    made = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    made.write.parquet(f"{tmp_path}/labels.parquet")
    rows = dict(corpus_pipeline.STAGES)["quality_classifier"](spark, odd_docs, str(tmp_path))
    assert rows.count() == odd_docs.count()


def test_planted_copies_go_and_clean_documents_stay(spark, folder, frame):
    docs = read_table(spark, folder, "documents").select(*COLUMNS)
    base = [r for r in docs.collect() if 1500 < r["n_chars"] < 6000][:10]
    planted = [(10_000 + n, r["text"].encode().upper().decode() if n % 2 else r["text"], *r[2:]) for n, r in enumerate(base)]
    both = docs.union(frame(planted, docs.schema))
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    stay = {r["doc_id"] for r in stage(spark, both, folder).collect()}
    assert not stay & {p[0] for p in planted}
    assert stay == {r["doc_id"] for r in stage(spark, docs, folder).collect()}
