"""Language identification by unigrams of vocabulary pieces, summed over all segmentations.

A language is a probability for each piece of a fixed public vocabulary. A word's probability is
the sum over every way to cut it into pieces, by the forward algorithm; a text's is the product
over its words. The language under which a text is likeliest is its prediction. Words are runs of
letters, lower-cased, with one space before them as the vocabulary writes words. Words are read
whole, however long; where the plain sum comes near the smallest double it is taken in logarithms.

Piece probabilities are the smoothed shares of a piece among all matches of pieces in the words of
that language, over all documents that may be learned from, and ``FLOOR`` of equal shares whatever
the size of the corpus, so that one word in a script unknown to a language does not decide a long
text. They are counted where the documents lie and added up by Spark; what the driver and the tasks
hold is bounded by vocabulary times languages.

The score is the posterior of the predicted language, with the text's mean word standing for at
most ``EVIDENCE`` words, so that mixed text does not look certain. Texts that are null or have no
letter are ``und`` with score 0, as is all text where no language could be learned. Of equally
likely languages the first by name is taken. Null languages teach nothing. Rows with a null key are
judged like others; repeated rows are judged, and learned from, each. An empty table gives an empty
one. Only the named columns are read or all are handed on, so none can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import annotate, learns, offsets_of, only, ragged, restored, slices, texts
from tidemark.llm.shipping import ship
from tidemark.llm.vocabulary import byte_trie, byte_vocabulary, default_path

#: Texts worked on at once: each byte of a distinct word has several matches, and each match its numbers.
SLICE = 2 << 20
EVIDENCE = 8
SMOOTHING = 1000.0
#: Share of equal piece probabilities in each language.
FLOOR = 1e-3
#: Sums below this are taken in logarithms: what a double loses is less than 1e-100 of larger ones.
TINY = 1e-200
#: Bytes of a word from which it is summed place by place for all languages together, not in groups
#: with other words.
LONG = 1024


@dataclass
class Words:
    """A slice of texts as counts of distinct words."""

    words: pa.Array
    units_of_text: np.ndarray  # text of each unit
    unit: np.ndarray  # code of each unit
    unit_of_word: np.ndarray  # for each word of a distinct unit, that unit
    word: np.ndarray  # and the word's code
    units: int

    def per_text(self, by_word: np.ndarray, count: int) -> np.ndarray:
        """Sums of a number of each word over the words of each text."""
        by_unit = np.bincount(self.unit_of_word, weights=by_word[self.word], minlength=self.units)
        return np.bincount(self.units_of_text, weights=by_unit[self.unit], minlength=count)


def read_words(column: pa.Array) -> Words:
    """Distinct units between white space first, then the words in each of these few."""
    split = pc.utf8_split_whitespace(pc.utf8_lower(column))
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    units = split.flatten().dictionary_encode()
    clean = pc.replace_substring_regex(units.dictionary, r"[^\p{L}\p{M}]+", " ")
    inner = pc.split_pattern(clean, " ")
    counts = pc.list_value_length(inner).to_numpy(zero_copy_only=False)
    words = inner.flatten()
    real = pc.match_substring_regex(words, r"\p{L}").to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(counts)), counts)[real]
    coded = words.filter(pa.array(real)).dictionary_encode()
    return Words(
        coded.dictionary,
        np.repeat(np.arange(len(column)), sizes),
        units.indices.to_numpy(zero_copy_only=False),
        of,
        coded.indices.to_numpy(zero_copy_only=False),
        len(units.dictionary),
    )


@dataclass
class Matches:
    """Every match of a piece in some stretches, which are words: where it starts and ends, and the piece.

    A stretch of m bytes has m + 1 places; ``first`` is the place of each one's beginning. Matches
    are sorted by distance from that and then length; those of one distance and length lie between
    two of ``cuts``, so none of them meet in a place.
    """

    first: np.ndarray
    last: np.ndarray
    word: np.ndarray
    places: int
    start: np.ndarray
    length: np.ndarray
    piece: np.ndarray
    stretch: np.ndarray
    cuts: np.ndarray

    def groups(self) -> Iterator[tuple[slice, int]]:
        """Matches of one distance and length, by distance, and that length."""
        if len(self.piece):
            cuts = self.cuts.tolist()
            for a, b, length in zip(cuts[:-1], cuts[1:], self.length[self.cuts[:-1]].tolist(), strict=True):
                yield slice(a, b), length

    def of(self, chosen: np.ndarray) -> Matches:
        """The matches of some stretches alone; places stay as they are."""
        on = np.flatnonzero(chosen[self.stretch])
        cuts = np.unique(np.searchsorted(on, self.cuts))
        return Matches(
            self.first[chosen], self.last[chosen], self.word[chosen], self.places,
            self.start[on], self.length[on], self.piece[on], self.stretch[on], cuts,
        )


def find_matches(words: pa.Array, path: str) -> Matches:
    """Matches in whole words, each behind one space."""
    trie = byte_trie(path)
    led = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), words, pa.scalar("", pa.large_string()))
    if not len(led):
        empty = np.zeros(0, np.int64)
        return Matches(empty, empty, empty, 0, empty, empty, empty, empty, np.zeros(1, np.int64))
    ends = np.frombuffer(led.buffers()[1], np.int64)[: len(led) + 1]
    data = np.frombuffer(led.buffers()[2], np.uint8)
    begin, length = ends[:-1], np.diff(ends)
    word = np.arange(len(length))
    offsets = offsets_of(length + 1)
    first = offsets[:-1]

    # All bytes at which a piece may start, walked down the trie together.
    stretch = np.repeat(np.arange(len(length), dtype=np.int32), length)
    distance = ragged(np.zeros(len(length), np.int64), length).astype(np.int32)
    at = begin[stretch] + distance
    left = (length[stretch] - distance).astype(np.int32)
    node = np.zeros(len(at), np.int32)
    found = []
    taken = 0
    while len(at):
        node = trie.step(node, data[at + taken])
        on = node >= 0
        taken += 1
        at, node, left, stretch, distance = at[on], node[on], left[on], stretch[on], distance[on]
        value = trie.value[node]
        hit = value >= 0
        found.append((stretch[hit], distance[hit], np.full(hit.sum(), taken, np.int32), value[hit].astype(np.int32)))
        on = left > taken
        at, node, left, stretch, distance = at[on], node[on], left[on], stretch[on], distance[on]
    stretch, distance, taken_, piece = (np.concatenate(x) for x in zip(*found, strict=True))
    width = taken + 1
    code = distance.astype(np.int32 if int(length.max()) * width < 1 << 31 else np.int64) * width + taken_
    by = np.argsort(code, kind="stable")
    cuts = np.r_[0, np.flatnonzero(np.diff(code[by])) + 1, len(by)]
    del code
    stretch = stretch[by]
    start = first[stretch] + distance[by]
    return Matches(first, first + length, word, int(offsets[-1]), start, taken_[by], piece[by], stretch, cuts)


def log_likelihoods(matches: Matches, probability: np.ndarray, words: int) -> np.ndarray:
    """log p(word | language) by the forward algorithm: languages x words."""
    out = np.zeros((len(probability), words))
    long = matches.last - matches.first > LONG
    if long.any():
        apart = matches.of(long)
        for row, sums in zip(out, _place_by_place(apart, probability), strict=True):
            row += np.bincount(apart.word, weights=sums, minlength=words)
        matches = matches.of(~long)
    for language, p in enumerate(probability):
        forward = np.zeros(matches.places)
        forward[matches.first] = 1.0
        for at, length in matches.groups():  # by start, so that each is complete when read
            start = matches.start[at]
            forward[start + length] += forward[start] * p[matches.piece[at]]
        ends = forward[matches.last]
        low = ends < TINY
        ends = np.log(np.where(low, 1.0, ends))
        if low.any():
            ends[low] = _in_logarithms(matches.of(low), p)
        out[language] += np.bincount(matches.word, weights=ends, minlength=words)
    return out


def _place_by_place(matches: Matches, probability: np.ndarray) -> np.ndarray:
    """log p(stretch | language) in logarithms: languages x stretches."""
    by = np.argsort(matches.start, kind="stable")
    start, length, piece = matches.start[by], matches.length[by], matches.piece[by]
    begins = np.r_[np.searchsorted(start, matches.first), len(start)]
    width = int(length.max()) + 1
    with np.errstate(divide="ignore"):
        share = np.log(probability)
    out = np.empty((len(probability), len(matches.first)))
    for i, first in enumerate(matches.first):
        own = slice(begins[i], begins[i + 1])
        place, reach, pieces = start[own] - first, length[own], piece[own]
        held = np.full((len(probability), width), -np.inf)  # the next places, in a ring
        held[:, 0] = 0.0
        size = int(matches.last[i] - first)
        ends = np.searchsorted(place, np.arange(size), side="right").tolist()
        a = 0
        for at in range(size):
            now = held[:, at % width].copy()
            held[:, at % width] = -np.inf
            b = ends[at]
            to = (at + reach[a:b]) % width
            held[:, to] = np.logaddexp(held[:, to], now[:, None] + share[:, pieces[a:b]])
            a = b
        out[:, i] = held[:, size % width]
    return out


def _in_logarithms(matches: Matches, p: np.ndarray) -> np.ndarray:
    """log p(stretch) where the plain sum is too small for a double."""
    # Places of the other stretches are left out.
    size = matches.last - matches.first + 1
    own = offsets_of(size)
    shift = matches.first - own[:-1]
    start = matches.start - shift[np.searchsorted(matches.first, matches.start, side="right") - 1]
    forward = np.full(int(own[-1]), -np.inf)
    forward[own[:-1]] = 0.0
    with np.errstate(divide="ignore"):
        share = np.log(p)
    for at, length in matches.groups():
        to = start[at] + length
        forward[to] = np.logaddexp(forward[to], forward[start[at]] + share[matches.piece[at]])
    return forward[own[1:] - 1]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    probability: np.ndarray  # languages x pieces


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", path: str | None = None) -> Model:
    """Piece probabilities of each language, from all rows of ``docs`` with a language."""
    path = path or default_path()
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = byte_vocabulary(path).size
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for cut in slices(batch, 0, SLICE):
                found = read_words(texts(cut.column(0)))
                matches = find_matches(found.words, path)
                names = cut.column(1).dictionary_encode()
                of_text = names.indices.to_numpy(zero_copy_only=False)
                for code, name in enumerate(names.dictionary.to_pylist()):
                    mine = of_text[found.units_of_text] == code
                    units = np.bincount(found.unit[mine], minlength=found.units)
                    times = np.bincount(found.word, weights=units[found.unit_of_word], minlength=len(found.words))
                    sums = held.setdefault(name, np.zeros(pieces))
                    if len(matches.piece):
                        sums += np.bincount(matches.piece, weights=times[matches.word[matches.stretch]], minlength=pieces)
        for name, sums in held.items():
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(sums[some])], ["lang", "piece", "n"]
            )

    counted = (
        only(docs, text=text, lang=lang)
        .where("lang is not null")
        .mapInArrow(run, "lang string, piece bigint, n double")
        .groupBy("lang", "piece")
        .agg(F.sum("n").alias("n"))
    )
    table = counted.toArrow().to_pandas()  # at most vocabulary x languages rows
    languages = sorted(table["lang"].unique())
    counts = np.zeros((len(languages), byte_vocabulary(path).size))
    counts[np.searchsorted(languages, table["lang"]), table["piece"]] = table["n"]
    return Model(languages, _smoothed(counts))


def _smoothed(counts: np.ndarray) -> np.ndarray:
    """Shares of pieces, drawn towards their shares over all languages, and these towards equal ones.

    Of each language ``FLOOR`` are equal shares, so an unseen piece does not fade as the corpus grows.
    """
    if not len(counts):
        return counts
    overall = counts.sum(axis=0) + 0.1
    overall /= overall.sum()
    shares = (counts + SMOOTHING * overall) / (counts.sum(axis=1, keepdims=True) + SMOOTHING)
    return (1 - FLOOR) * shares + FLOOR / counts.shape[1]


def judgements(model: Model, path: str, column: pa.Array) -> list[pa.Array]:
    """Language, score and number of words of each text."""
    n = len(column)
    names = pa.array([*model.languages, "und"], pa.string())
    found = read_words(column)
    words = found.per_text(np.ones(len(found.words)), n)
    likely = log_likelihoods(find_matches(found.words, path), model.probability, len(found.words))
    total = np.array([found.per_text(row, n) for row in likely]).reshape(len(model.languages), n)
    best, score = np.full(n, len(model.languages)), np.zeros(n)
    some = words > 0
    if len(model.languages):
        best[some] = total[:, some].argmax(axis=0)
        mean = total[:, some] / words[some] * np.minimum(words[some], EVIDENCE)
        score[some] = 1 / np.exp(mean - mean.max(axis=0)).sum(axis=0)
    return [names.take(pa.array(best)), pa.array(score), pa.array(words.astype(np.int64))]


def annotated(docs: DataFrame, model: Model, text: str = "text", path: str | None = None) -> DataFrame:
    """Rows as c0, c1, ... with language a0, score a1 and number of words a2."""
    path = path or default_path()
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary x languages
    return annotate(docs, text, ["string", "double", "bigint"], lambda column: judgements(sent.value, path, column), SLICE)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, lang_pred, score, n_words) of every whole text."""
    found = annotated(only(docs, **{key: key, "text": text}), model, "text", path)
    return found.select(F.col("c0").alias(key), F.col("a0").alias("lang_pred"), F.col("a1").alias("score"), F.col("a2").alias("n_words"))


def keep_identified(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """Whole rows whose text has a language.

    Texts without letters go, and texts of which no language has a share of ``least``, unless they
    have too few words to tell.
    """
    found = annotated(docs, model, text)
    unclear = (F.col("a1") < least) & (F.col("a2") >= EVIDENCE)
    return restored(found.where((F.col("a0") != "und") & ~unclear), docs)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Predictions for all documents, learned from those that are not held out."""
    teach = learns(key, 4, 2)
    model = fit(docs.where(teach), text, lang)
    return predict(docs, model, key, text).select(key, (~teach).alias("held_out"), "lang_pred", "score", "n_words")
