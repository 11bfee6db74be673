"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Tokenizer A is byte-level BPE and reads the text behind one space; B is a sentencepiece model, which adds
that space itself. Special tokens' strings are plain text to both. All tokens of a batch lie on one line
of bytes, document after document, so ``merge_asof``, keyed by document, finds for each token's first
byte the token of the other side that covers it. A pair overlaps exactly if the later of its two first
bytes lies in the other token: the union of both directions, with pairs that begin together counted once,
is all overlaps. Where tokens of both sides end at one byte, a group ends.

Whole texts are split into units at single spaces, which neither tokenizer's tokens cross: each distinct
unit of a batch is encoded once. Texts with runs of spaces or with the model's own space character go
through the library whole.

In how many documents a pair of ids is linked is counted by Spark over all documents: a batch passes on
each document's distinct pairs with their times. The counted pairs are bounded by the vocabularies, not
by the input; up to ``BROADCAST_PAIRS`` of them are sent to the documents, more are joined by shuffle.

Null and empty texts, and those whose tokens do not give back their bytes (the model's normaliser or its
space character changed them), have no tokens: zeros. Very long texts are read whole. Null keys and
repeated rows are documents of their own. An empty table gives an empty one. Only the named columns are
read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import free, settle
from tidemark.llm.common import joined_bytes, offsets_of, only, ragged, slices, texts
from tidemark.llm.pretokens import Coded, spread
from tidemark.llm.shipping import ship
from tidemark.llm.tokens import BatchTokenizer
from tidemark.llm.vocabulary import byte_vocabulary, default_path

#: Bytes of text aligned at once; each has about a token of either side, with its numbers and links.
SLICE = 1 << 20
#: Linked pairs of ids, 16 bytes each, up to which they are broadcast.
BROADCAST_PAIRS = 2_000_000
PIECES = "piece_bpe_32k.model"
_MARK = "▁"


class TokenBytes:
    """The bytes of every id, one after the other."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.first = offsets_of(self.length)[:-1]
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.first[ids], self.length[ids])]


class PieceTokenizer:
    """Ids by a sentencepiece model, each distinct unit of a batch encoded once."""

    def __init__(self, path: str):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(self.size)]
        if any(_MARK in p.lstrip(_MARK) for p in pieces):
            raise ValueError("a piece with a space inside breaks the cut into units")
        self.bytes = TokenBytes(
            [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        )

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the texts' offsets in them. No text may be null."""
        odd = pc.match_substring_regex(column, f"^ |  | $|{_MARK}").to_numpy(zero_copy_only=False)
        split = pc.split_pattern(column.filter(pa.array(~odd)), " ")
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        units = coded.dictionary.to_pylist() + column.filter(pa.array(odd)).to_pylist()
        lists = self.model.encode(units, num_threads=1) if units else []
        lengths = np.array([len(x) for x in lists], np.int64)
        ids = np.fromiter((i for x in lists for i in x), np.int64, int(lengths.sum()))
        each = np.ones(len(column), np.int64)
        each[~odd] = counts
        offsets = offsets_of(each)
        unit = np.empty(offsets[-1], np.int64)
        unit[ragged(offsets[:-1][~odd], counts)] = codes
        unit[offsets[:-1][odd]] = len(coded.dictionary) + np.arange(odd.sum())
        return spread(Coded(coded.dictionary, unit, offsets, set()), ids, offsets_of(lengths)[:-1], lengths)


class Pair:
    def __init__(self, a_path: str, b_path: str):
        vocabulary = byte_vocabulary(a_path)
        self.a = BatchTokenizer(a_path, added=False)
        self.a_bytes = TokenBytes(vocabulary.bytes)
        self.b = PieceTokenizer(b_path)
        width = max(len(self.a_bytes.length), self.b.size)
        self.width = width
        #: A decimal id behind nothing, a comma, a bar and a semicolon.
        self.written = [f"{before}{i}" for before in ("", ",", "|", ";") for i in range(width)]


@lru_cache(maxsize=1)
def pair_of(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


@dataclass
class Aligned:
    """The tokens of some documents; places of links and groups are counted over all of them."""

    documents: int
    a: np.ndarray  # ids
    b: np.ndarray
    a_document: np.ndarray  # of each token, its document
    b_document: np.ndarray
    a_first: np.ndarray  # and its first byte and the one behind its last, on the line of all documents
    b_first: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    link_a: np.ndarray  # of each link, the places of its tokens
    link_b: np.ndarray
    ends: np.ndarray  # where groups end

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """The group of each token of a, and of b."""
        return np.searchsorted(self.ends, self.a_end), np.searchsorted(self.ends, self.b_end)


def _kept(ids: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    document = np.repeat(np.arange(len(keep)), np.diff(offsets))
    on = keep[document]
    return ids[on], document[on]


def align(column: pa.Array, pair: Pair) -> Aligned:
    """``column`` is a large_string array without nulls."""
    some = pc.greater(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    led = pc.if_else(pa.array(some), pc.binary_join_element_wise(space, column, nothing), nothing)
    a_ids, a_offsets = pair.a.encode(led)
    b_ids, b_offsets = pair.b.encode(column)
    a_ids = a_ids.astype(np.int64)
    given = np.frombuffer(joined_bytes(led), np.uint8)
    bounds = offsets_of(pc.binary_length(led).to_numpy(zero_copy_only=False).astype(np.int64))
    keep = some.copy()
    for held, ids, offsets in ((pair.a_bytes, a_ids, a_offsets), (pair.b.bytes, b_ids, b_offsets)):
        made, at = held.joined(ids), np.append(0, np.cumsum(held.length[ids]))[offsets]
        keep &= np.diff(at) == np.diff(bounds)
        # Of texts of the right length, the bytes that differ.
        own = np.flatnonzero(keep)
        sizes = np.diff(bounds)[own]
        unlike = made[ragged(at[:-1][own], sizes)] != given[ragged(bounds[:-1][own], sizes)]
        keep[np.repeat(own, sizes)[unlike]] = False
    a, a_document = _kept(a_ids, a_offsets, keep)
    b, b_document = _kept(b_ids, b_offsets, keep)
    a_end, b_end = np.cumsum(pair.a_bytes.length[a]), np.cumsum(pair.b.bytes.length[b])
    a_first, b_first = a_end - pair.a_bytes.length[a], b_end - pair.b.bytes.length[b]

    left = pd.DataFrame({"at": a_first, "document": a_document, "a": np.arange(len(a))})
    right = pd.DataFrame({"at": b_first, "document": b_document, "b": np.arange(len(b))})
    of_a = pd.merge_asof(left, right, on="at", by="document")
    of_b = pd.merge_asof(right, left, on="at", by="document")
    # Pairs that begin together come from both directions.
    later = of_b["at"].to_numpy() > a_first[of_b["a"].to_numpy()] if len(b) else np.zeros(0, bool)
    link_a = np.concatenate([of_a["a"].to_numpy(), of_b["a"].to_numpy()[later]]).astype(np.int64)
    link_b = np.concatenate([of_a["b"].to_numpy(), of_b["b"].to_numpy()[later]]).astype(np.int64)
    ends = np.intersect1d(a_end, b_end, assume_unique=True)
    return Aligned(len(column), a, b, a_document, b_document, a_first, b_first, a_end, b_end, link_a, link_b, ends)


def group_texts(found: Aligned, pair: Pair) -> list[str]:
    """Each document's groups as ``a1,a2|b1;a3|b2,b3``: decimal ids in order; nothing without tokens."""
    a_group, b_group = found.groups()
    group = np.concatenate([a_group, b_group])
    side = np.repeat([0, 1], [len(a_group), len(b_group)])
    by = np.lexsort((side, group))  # stable: tokens of a side stay in order
    ids = np.concatenate([found.a, found.b])[by]
    document = np.concatenate([found.a_document, found.b_document])[by]
    group, side = group[by], side[by]
    before = np.ones(len(by), np.int64)  # a comma
    if len(by):
        before[1:][side[1:] != side[:-1]] = 2
        before[1:][group[1:] != group[:-1]] = 3
        before[0] = 0
        before[1:][document[1:] != document[:-1]] = 0
    written = list(map(pair.written.__getitem__, (before * pair.width + ids).tolist()))
    cuts = np.searchsorted(document, np.arange(found.documents + 1)).tolist()
    return ["".join(written[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


def document_pairs(found: Aligned, pair: Pair) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each document's distinct linked pairs of ids, as a * size of B + b, ascending; their times; offsets."""
    document = found.a_document[found.link_a]
    code = found.a[found.link_a] * pair.b.size + found.b[found.link_b]
    by = np.lexsort((code, document))
    document, code = document[by], code[by]
    first = np.ones(len(by), bool)
    first[1:] = (document[1:] != document[:-1]) | (code[1:] != code[:-1])
    at = np.flatnonzero(first)
    times = np.diff(np.append(at, len(by)))
    return code[at], times, np.searchsorted(document[at], np.arange(found.documents + 1))


def _paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    return a_path or default_path(), b_path or default_path(PIECES)


def links(
    docs: DataFrame, key: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None
) -> DataFrame:
    """One row per overlapping pair of tokens: (key, a_place, b_place, a_id, b_id, a_start, b_start, group),
    places and groups counted from 0 within the document, starts in bytes of the text behind its space."""
    paths = _paths(a_path, b_path)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, 1, SLICE):
                found = align(texts(cut.column(1)), pair_of(*paths))
                places = np.arange(found.documents + 1)
                a0, b0 = (np.searchsorted(d, places) for d in (found.a_document, found.b_document))
                a, b = found.link_a, found.link_b
                of = found.a_document[a]
                by = np.lexsort((b, a))
                a, b, of = a[by], b[by], of[by]
                begins = np.append(found.a_first, 0)[np.minimum(a0, len(found.a_first))]
                # A link's group is that of the byte where both tokens are: the later first byte.
                at = np.maximum(found.a_first[a], found.b_first[b])
                group = np.searchsorted(found.ends, at, side="right")
                first_group = np.searchsorted(found.ends, begins[of], side="right")
                columns = [
                    cut.column(0).take(pa.array(of)), pa.array(a - a0[of]), pa.array(b - b0[of]), pa.array(found.a[a]), pa.array(found.b[b]),
                    pa.array(found.a_first[a] - begins[of]), pa.array(found.b_first[b] - begins[of]), pa.array(group - first_group),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [key, "a_place", "b_place", "a_id", "b_id", "a_start", "b_start", "group"]
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"{n} bigint" for n in names[1:])
    return only(docs, **{key: key, "text": text}).mapInArrow(run, schema)


def _counted(docs: DataFrame, key: str, text: str, paths: tuple[str, str]) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*paths)
        for batch in batches:
            for cut in slices(batch, 1, SLICE):
                found = align(texts(cut.column(1)), pair)
                n = found.documents
                codes, times, offsets = document_pairs(found, pair)
                offsets = pa.array(offsets, pa.int32())
                hexes = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in group_texts(found, pair)]
                closing = found.a_document[np.searchsorted(found.a_end, found.ends)]
                counts = [found.a_document, found.b_document, closing, found.a_document[found.link_a]]
                columns = [
                    cut.column(0),
                    *(pa.array(np.bincount(c, minlength=n)) for c in counts),
                    pa.array(hexes, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(codes.astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [key, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"{n} bigint" for n in names[1:5])
    schema += ", groups_sha256 string, pairs array<int>, times array<int>"
    return only(docs, **{key: key, "text": text}).mapInArrow(run, schema)


def audit(
    docs: DataFrame, key: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    paths = _paths(a_path, b_path)
    size = sentencepiece.SentencePieceProcessor(model_file=paths[1]).get_piece_size()
    counted = _counted(docs, key, text, paths).withColumnRenamed(key, "key")
    # The number of a row is written with it, so it is the same for whoever reads it.
    held = settle(counted.withColumn("row", F.monotonically_increasing_id()), "aligned")
    documents = held.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    documents = settle(documents.withColumn("a", F.expr(f"pair div {size}")), "pairs")
    highest = documents.groupBy("a").agg(F.max("documents").alias("highest"))
    rated = settle(
        documents.join(highest, "a").select("pair", "documents", (F.col("documents") == F.col("highest")).alias("best")), "rated"
    )
    free(documents)
    if rated.count() <= BROADCAST_PAIRS:
        rated = F.broadcast(rated)
    each = held.select("row", F.inline(F.arrays_zip("pairs", "times"))).join(rated, F.col("pairs") == F.col("pair"))
    sums = each.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0).cast("long")).alias("n_best"),
        F.sum(F.col("times") * F.col("documents")).alias("count_sum"),
    )
    joined = held.select("key", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
