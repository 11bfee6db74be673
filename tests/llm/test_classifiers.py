"""Quality and language on held-out rows, and on odd ones."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import langid, quality
from tidemark.llm.queries import QUERIES
from tidemark.llm.vocabulary import byte_vocabulary, default_path
from tidemark.sources.tables import read_table

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.01"


def test_held_out_quality(spark):
    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, SF, "labels").collect()}
    rows = QUERIES["op1_quality"](spark, SF).collect()
    assert len(rows) == read_table(spark, SF, "documents").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 80
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held)
    assert right > 0.93
    bad = [r["score"] for r in held if labels[r["doc_id"]] == 0]
    good = [r["score"] for r in held if labels[r["doc_id"]] == 1]
    order = sum((b < g) + 0.5 * (b == g) for b, g in itertools.product(bad, good)) / len(bad) / len(good)
    assert order > 0.92


def test_quality_of_odd_rows(odd_docs, frame, spark):
    labels = frame([(i, i % 2, None) for i in range(14)] + [(None, 1, None), (3, None, None), (4, 7, None)], "doc_id long, quality int, text string")
    rows = quality.classify(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (0, 1)}) == 1
    assert quality.classify(odd_docs.limit(0), labels).count() == 0
    unlabelled = quality.classify(odd_docs, labels.limit(0)).collect()
    assert {round(r["score"], 6) for r in unlabelled} == {0.5}
    kept = quality.keep_good(odd_docs, quality.Model(b"a" * 100, b"b" * 100, weights=np.array([5.0, 0, 0, 0, 0, 0])))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_quality_sees_whole_texts():
    """Junk behind a long clean beginning counts."""
    draw = np.random.default_rng(1)
    words = ["".join(draw.choice(list("etaoin"), 5)) for _ in range(300)]
    good = [" ".join(draw.choice(words, 300)).encode() for _ in range(60)]
    bad = ["#!% ".join(draw.choice(words, 300)).encode() for _ in range(60)]
    model = quality.Model(quality._dictionary(good, 20_000), quality._dictionary(bad, 20_000))
    clean = " ".join(draw.choice(words, 8000))
    mixed = clean + " " + "#!% ".join(draw.choice(words, 400))
    x = quality.features(model, [quality.windows(t.encode()) for t in (clean, mixed)])
    assert x[1][1] < x[0][1] - 0.05


def test_features_and_curve_are_what_plain_compression_gives():
    import zstandard

    draw = np.random.default_rng(4)
    words = ["".join(draw.choice(list("abcdefgh"), 4)) for _ in range(200)]
    texts = [" ".join(draw.choice(words, n)).encode() for n in (1, 50, 409, 410, 3000, 40_000)] + [b""]
    model = quality.Model(b" ".join(w.encode() for w in words[:100]) * 3, b"#%! " * 100)
    found = quality.features(model, [quality.windows(t) for t in texts])
    for text, row in zip(texts, found, strict=True):
        count = max(1, round(len(text) / 2048))
        cuts = [text[len(text) * k // count : len(text) * (k + 1) // count] for k in range(count)] if text else []
        assert b"".join(cuts) == text

        def size(window, data):
            held = zstandard.ZstdCompressionDict(data) if data else None
            kind = {"level": 3, "write_content_size": False, "write_dict_id": False, "write_checksum": False}
            return len(zstandard.ZstdCompressor(dict_data=held, **kind).compress(window))

        pairs = [(size(w, model.good), size(w, model.bad)) for w in cuts]
        # Digested dictionaries may code a window a few bytes differently.
        apart = [(d - g) / (d + g) for g, d in pairs] or [0.0]
        shrunk = [math.log(max(1, size(w, None) - 9) / len(w)) for w in cuts] or [0.0]
        expected = [np.mean(apart), min(apart), max(apart), np.mean(shrunk), min(shrunk)]
        assert row == pytest.approx(expected, abs=0.03)
    x = draw.normal(size=(400, 2))
    y = (draw.random(400) < 1 / (1 + np.exp(-(0.5 + x @ [2.0, -1.0])))).astype(float)
    w = quality._logistic(x, y, np.ones(400))
    p = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
    assert np.abs(np.column_stack([np.ones(400), x]).T @ (p - y)).max() < 0.01  # the maximum of the likelihood


def test_windows_are_drawn_over_the_whole_length():
    data = bytes(np.random.default_rng(3).integers(0, 256, 2048 * 400, dtype=np.uint8))
    held = quality.windows(data)
    drawn = quality.drawn_windows(data, 32)
    places = sorted(held.index(w) for w in drawn)
    assert len(drawn) == 32 and places[0] < 60 and places[-1] > 340
    assert quality.drawn_windows(data[:5000], 32) != [] and sorted(quality.drawn_windows(data[:5000], 32)) == sorted(quality.windows(data[:5000]))
    assert quality.drawn_windows(b"", 32) == []


def test_a_long_text_teaches_by_all_of_its_length(frame):
    """Bad texts whose first 100,000 characters look good: only what lies behind them tells."""
    draw = np.random.default_rng(7)
    words = ["".join(draw.choice(list("etaoinshr"), 5)) for _ in range(400)]

    def clean(n):
        return " ".join(draw.choice(words, n))

    rows = [(i, clean(30_000), None) for i in range(30)]
    rows += [(100 + i, clean(14_000) + "#!% ".join(draw.choice(words, 12_000)), None) for i in range(30)]
    docs = frame(rows, "doc_id long, text string, label int")
    labels = frame([(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    scored = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert all((score >= 0.5) == (i < 100) for i, score in scored.items())


def test_labels_without_documents_do_not_shrink_the_sample(frame):
    draw = np.random.default_rng(8)
    docs = frame([(i, ("#!% " if i % 2 else "etaoin ") * int(draw.integers(20, 60))) for i in range(40)], "doc_id long, text string")
    labels = frame([(i, 1 - i % 2) for i in range(3000)], "doc_id long, quality int")
    model = quality.fit(docs, labels, sample_rows=20)
    scored = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert all((score >= 0.5) == (i % 2 == 0) for i, score in scored.items())


def segmentations(word: bytes, p) -> float:
    total = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for begin in range(end):
            token = byte_vocabulary(default_path()).tokens.get(word[begin:end])
            if token is not None:
                total[end] += total[begin] * p[token]
    return total[-1]


def test_forward_sums_all_segmentations():
    draw = np.random.default_rng(2)
    size = byte_vocabulary(default_path()).size
    p = draw.dirichlet(np.ones(size), size=2)
    words = ["the", "straße", "a", "inthe", "漢字", "ingestion", "q" * 30]
    column = pa.array(words, pa.large_string())
    found = langid.log_likelihoods(langid.find_matches(column, default_path()), p, len(words))
    for language in (0, 1):
        for i, word in enumerate(words):
            assert found[language][i] == pytest.approx(math.log(segmentations(f" {word}".encode(), p[language])))


def test_no_word_underflows():
    """Whole words of any length, with probabilities far below what a double can multiply."""
    size = byte_vocabulary(default_path()).size
    p = np.full((2, size), 1e-30)
    p[1] = 1 / size
    words = ["the", "漢" * 20, "ж" * 40, "ab" * 300, "x" * 5000]
    found = langid.log_likelihoods(langid.find_matches(pa.array(words, pa.large_string()), default_path()), p, len(words))
    assert np.isfinite(found).all()
    for language in (0, 1):
        for i, word in enumerate(words):
            data, tokens = f" {word}".encode(), byte_vocabulary(default_path()).tokens
            total = [0.0] + [-math.inf] * len(data)
            for end in range(1, len(data) + 1):
                for begin in range(max(0, end - 130), end):
                    if data[begin:end] in tokens:
                        total[end] = np.logaddexp(total[end], total[begin] + math.log(p[language][tokens[data[begin:end]]]))
            assert found[language][i] == pytest.approx(total[-1])


@pytest.mark.parametrize("times", [10**3, 10**6, 10**9, 10**12])
def test_one_word_in_an_unseen_script_does_not_decide(times):
    """However large the corpus, a long English text stays English with a long Russian word in it."""
    english = "the people of this town have always said that water from the old river was good for their bread"
    russian = "люди этого города всегда говорили что вода из старой реки хороша для хлеба достопримечательность"
    counts = np.zeros((2, byte_vocabulary(default_path()).size))
    for row, text, n in zip(counts, (english, russian), (times, 1000), strict=True):
        found = langid.find_matches(langid.read_words(pa.array([text], pa.large_string())).words, default_path())
        np.add.at(row, found.piece, n)
    model = langid.Model(["en", "ru"], langid._smoothed(counts))
    quoting = " ".join([english] * 10 + ["достопримечательность"] + [english] * 10)
    column = pa.array([quoting, russian, "漢字" * 40], pa.large_string())
    names, score, words = langid.judgements(model, default_path(), column)
    assert names.to_pylist()[:2] == ["en", "ru"]
    assert np.isfinite(score.to_numpy()).all() and min(score.to_pylist()[:2]) > 0.9


def test_words_are_counted_by_text():
    column = pa.array(["The the, THE!", "", "123 --", "l'eau d'or", "x1y"], pa.large_string())
    found = langid.read_words(column)
    assert found.per_text(np.ones(len(found.words)), 5).tolist() == [3, 0, 0, 4, 2]


def test_held_out_languages(spark):
    lang = {r["doc_id"]: r["lang"] for r in read_table(spark, SF, "documents").collect()}
    rows = QUERIES["op4_langid"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(lang)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 200
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.98


def test_odd_rows_have_languages(odd_docs):
    rows = langid.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        text = ODD_TEXTS[r["doc_id"]] if r["doc_id"] is not None else "a text"
        if not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] == "en" and 0 < r["score"] <= 1
    assert langid.identify(odd_docs.limit(0)).count() == 0
    from pyspark.sql import functions as F

    unknown = langid.identify(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in unknown} == {"und"}


def test_rows_without_a_language_go(odd_docs):
    model = langid.fit(odd_docs)
    kept = langid.keep_identified(odd_docs, model)
    assert kept.columns == odd_docs.columns
    expected = [t for t in ODD_TEXTS if any(c.isalpha() for c in t or "")]
    assert {r["text"] for r in kept.collect()} == {*expected, "a text"}
