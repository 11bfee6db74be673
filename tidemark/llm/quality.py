"""A compression classifier of text quality.

Two zstandard dictionaries are built, one from texts labelled good and one from texts labelled bad.
A text is cut into windows; each is compressed with either dictionary, and the difference of the
two sizes over their sum tells which labelled text it resembles. A text's features are the mean
of that over its windows and its extremes, and how far its windows shrink without a dictionary, as
text that only repeats itself resembles neither; a logistic curve fitted to labelled rows turns
them into a score between 0 and 1.

Learning takes a bounded sample: at most ``sample_rows`` labelled texts of each label that have a
document, of which ``dictionary_rows`` go into a dictionary. A text gives ``sample_windows`` windows
at most, drawn by hash over its whole length, to the curve, and ``dictionary_windows`` of them to a
dictionary. The curve is fitted to features of texts that the dictionaries have not seen: the
sample is cut into folds, and each fold is compressed with dictionaries built from the others. Rows
are drawn by hash too, so the sample does not depend on how they are dealt out. Scoring covers every
window of every text.

Null texts are read as empty; empty texts have the features of a window of no difference. Very long
texts are scored window by window. Labels that are null or neither 0 nor 1, or whose key is null or
has no document, teach nothing, and a key with labels of both kinds teaches both. Rows with a null
key are scored like others; repeated rows are scored each. Without rows of both labels the score is
their share, 0.5 if none. An empty table gives an empty one. Only the named columns are read, so
other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from math import log

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import free, settle
from tidemark.llm.common import annotate, learns, only, restored, texts
from tidemark.llm.shipping import ship

WINDOW = 2048
#: Bytes of text held as Python strings at once.
SLICE = 2 << 20
LEVEL = 3
SAMPLE_ROWS = 2000
DICTIONARY_ROWS = 1000
FOLDS = 4
SAMPLE_WINDOWS = 32
DICTIONARY_WINDOWS = 2
DICTIONARY_BYTES = 110_000
FEATURES = 5
FURTHEST = 4.0


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    scale: np.ndarray = field(default_factory=lambda: np.ones(FEATURES))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))

    @property
    def name(self) -> str:
        return hashlib.sha256(self.good + self.bad).hexdigest()

    def standard(self, features: np.ndarray) -> np.ndarray:
        """In standard deviations of the sample. What lies further out than it shows, such as the
        extremes of a text with many more windows, or of one that is in a dictionary, counts no more."""
        return np.clip((features - self.mean) / self.scale, -FURTHEST, FURTHEST)

    def score(self, features: np.ndarray) -> np.ndarray:
        x = self.standard(features)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -40, 40)))


_COMPRESSORS: dict[str, list[zstandard.ZstdCompressor]] = {}
_PLAIN: dict = {"level": LEVEL, "write_content_size": False, "write_dict_id": False, "write_checksum": False}
#: Bytes of a frame around what is compressed.
_FRAME = 9


def _compressors(model: Model) -> list[zstandard.ZstdCompressor]:
    """With the good dictionary, the bad one and none; digested once in the life of a worker process."""
    if model.name not in _COMPRESSORS:
        made = []
        for data in (model.good, model.bad):
            held = zstandard.ZstdCompressionDict(data)
            held.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(dict_data=held, **_PLAIN))
        _COMPRESSORS.clear()
        _COMPRESSORS[model.name] = [*made, zstandard.ZstdCompressor(**_PLAIN)]
    return _COMPRESSORS[model.name]


def windows(data: bytes) -> list[bytes]:
    """A text's bytes in equal windows of about ``WINDOW``; none if it is empty."""
    count = max(1, round(len(data) / WINDOW)) if data else 0
    ends = [len(data) * k // count for k in range(count + 1)] if count else []
    return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def drawn_windows(data: bytes, most: int) -> list[bytes]:
    """At most ``most`` windows, those of the smallest hashes of place and content, in that order."""
    held = windows(data)
    return [held[i] for i in sorted(range(len(held)), key=lambda i: xxhash.xxh64_intdigest(held[i], i))[:most]]


def features(model: Model, column: list[list[bytes]]) -> np.ndarray:
    """Of each text's windows: mean, smallest and largest normalised difference of the two sizes;
    mean and smallest logarithm of the size without dictionary over that of the text."""
    good, bad, plain = (c.compress for c in _compressors(model))
    out = np.zeros((len(column), FEATURES))
    for i, held in enumerate(column):
        sizes, shrunk = [], []
        for window in held:
            g, d = len(good(window)), len(bad(window))
            sizes.append((d - g) / (d + g))
            shrunk.append(log(max(1, len(plain(window)) - _FRAME) / len(window)))
        if held:
            count = len(held)
            out[i] = sum(sizes) / count, min(sizes), max(sizes), sum(shrunk) / count, min(shrunk)
    return out


def _dictionary(pieces: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the windows themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, pieces)) // 4)), pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[:size] or b"\n" * 64


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton's method with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    dictionary_rows: int = DICTIONARY_ROWS,
    sample_windows: int = SAMPLE_WINDOWS,
    dictionary_windows: int = DICTIONARY_WINDOWS,
) -> Model:
    """A model from labelled rows; pass only rows that may be learned from."""
    ship(docs.sparkSession)
    marked = only(labels, key=key, label=label).withColumn("label", F.col("label").cast("int"))
    marked = marked.where("label IN (0, 1)").distinct()
    # Only keys and labels: which labelled keys have a document, before any is drawn.
    present = settle(marked.join(only(docs, key=key), "key", "left_semi"), "labelled")
    counts = {r["label"]: r["n"] for r in present.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [present.where(F.col("label") == value).orderBy(F.xxhash64("key"), "key").limit(sample_rows) for value in (0, 1)]
    # Bounded by the parameters; as a local table its size is known, so the documents stay where they lie.
    wanted = docs.sparkSession.createDataFrame(parts[0].union(parts[1]).toArrow())
    rows = only(docs, key=key, text=text).join(wanted, "key").select("label", F.xxhash64(F.lit(1), "key").alias("draw"), "text")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [drawn_windows(t.encode("utf-8", "replace"), sample_windows) for t in texts(batch.column(2)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(held, pa.list_(pa.binary()))], ["label", "draw", "windows"]
            )

    cut = settle(rows.mapInArrow(draw, "label int, draw bigint, windows array<binary>"), "drawn")
    drawn: dict[int, list[list[bytes]]] = {}
    for value in (0, 1):
        mine = cut.where(F.col("label") == value).orderBy("draw", F.xxhash64("windows")).limit(sample_rows)
        drawn[value] = [[bytes(w) for w in r["windows"]] for r in mine.collect()]
    free(present, cut)

    def dictionaries(samples: dict[int, list[list[bytes]]]) -> Model:
        pieces = {v: [w for text in samples[v][:dictionary_rows] for w in text[:dictionary_windows]] for v in samples}
        return Model(*(_dictionary(pieces[v], DICTIONARY_BYTES) for v in (1, 0)))

    model = dictionaries(drawn)
    if min(map(len, drawn.values())) < 2:
        seen = sum(counts.values())
        share = counts.get(1, 0) / seen if seen else 0.5
        constant = np.append(np.log((share + 1e-9) / (1 - share + 1e-9)), np.zeros(FEATURES))
        return Model(model.good, model.bad, weights=constant)
    folds = min(FOLDS, *map(len, drawn.values()))
    parts_x, parts_y = [], []
    for fold in range(folds):
        others = dictionaries({v: [t for i, t in enumerate(drawn[v]) if i % folds != fold] for v in drawn})
        for value in (1, 0):
            mine = drawn[value][fold::folds]
            parts_x.append(features(others, mine))
            parts_y.append(np.full(len(mine), float(value)))
    x, y = np.concatenate(parts_x), np.concatenate(parts_y)
    # Rows stand for all labelled rows of their kind, so that the score is a probability.
    total = counts[0] + counts[1]
    each = {v: counts[v] / total * len(y) / len(drawn[v]) for v in drawn}
    weight = np.where(y == 1, each[1], each[0])
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    model = replace(model, mean=mean, scale=scale)
    return replace(model, weights=_logistic(model.standard(x), y, weight))


def _cut(column: pa.Array) -> list[list[bytes]]:
    return [windows(t.encode("utf-8", "replace")) for t in column.to_pylist()]


def annotated(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows as c0, c1, ... with their score a0."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size
    return annotate(
        docs, text, ["double"], lambda column: [pa.array(sent.value.score(features(sent.value, _cut(column))))], SLICE
    )


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every whole text."""
    found = annotated(only(docs, **{key: key, "text": text}), model, "text")
    return found.select(F.col("c0").alias(key), F.col("a0").alias("score"))


def keep_good(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """Whole rows whose score is ``least`` or more."""
    return restored(annotated(docs, model, text).where(F.col("a0") >= least), docs)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all documents, learned from the labelled ones that are not held out."""
    teach = learns(key, 3, 1)
    model = fit(docs.where(teach), labels.where(teach), key, text)
    return score(docs, model, key, text).select(
        key, (~teach).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
