"""Byte-level BPE: speculate with the longest match, verify every adjacent pair, merge what fails.

A sequence of vocabulary tokens is what BPE makes of its bytes exactly if each token is what BPE
makes of its own bytes and no merge ever crosses the seam between two neighbours. The second is
a question about two tokens only: their merge trees tell which tokens meet at the seam, and until
which merge they do. So the greedy proposal for a word is checked pair by pair, for all distinct
pairs of a batch at once, and only words with a failing pair are merged step by step.

Null texts are read as empty: no ids, and an empty text back. Strings of added tokens become
those tokens, as the library does. Very long texts and words are encoded whole. Repeated rows and
null keys are encoded each. An empty table gives an empty one. Any column but the two named ones is
ignored, so none can clash.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm.common import offsets_of, only, ragged, slices, texts
from tidemark.llm.pretokens import Coded, code_texts, pattern, spread
from tidemark.llm.shipping import ship
from tidemark.llm.vocabulary import Trie, byte_vocabulary, default_path

#: A unit of these letters alone is one piece of the pattern.
_ONE_PIECE = r"\A ?[A-Za-zÀ-ÖØ-öø-ɏ]+\z"
#: Longer pieces are walked one by one; vectors over few long pieces have nothing to share.
_LONG = 256
_NEVER = np.iinfo(np.int64).max


class Encoder:
    def __init__(self, path: str):
        self.vocabulary = v = byte_vocabulary(path)
        keys = np.array([a * v.size + b for a, b in v.merges], np.int64)
        by = np.argsort(keys)
        self.pair_keys = keys[by]
        both = np.array(list(v.merges.values()), np.int64)[by]
        self.pair_rank, self.pair_made = both[:, 0], both[:, 1]
        ids = np.array([i for i in v.tokens.values()], np.int64)
        self.canonical = self._canonical(ids)
        tokens = [(t, i) for t, i in v.tokens.items() if self.canonical[i]]
        self.trie = Trie([t for t, _ in tokens], [i for _, i in tokens])
        self.by_bytes = dict(tokens)
        self.longest = max(len(t) for t, _ in tokens)

    def merge_rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of the merge of each pair (a number beyond all ranks if there is none), and its place."""
        key = left * self.vocabulary.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], _NEVER), at

    def compatible(self, left: np.ndarray, right: np.ndarray, joined: bool = False) -> np.ndarray:
        """Whether no merge crosses the seam of each pair; with ``joined``, but the one that joins it."""
        v = self.vocabulary
        fine = np.ones(len(left), bool)
        if not joined:
            fine &= self.merge_rank(left, right)[0] == _NEVER
        alive = np.flatnonzero(fine)
        left, right = left[alive], right[alive]
        while len(alive):
            # Undo the later of the two merges that made the tokens at the seam: before it, the
            # seam lay between its inner part and the other token.
            of_left, of_right = v.rank[left], v.rank[right]
            undo_left = of_left > of_right
            until = np.where(undo_left, of_left, of_right)
            some = until >= 0
            alive, left, right, undo_left, until = (x[some] for x in (alive, left, right, undo_left, until))
            left = np.where(undo_left, v.right[left], left)
            right = np.where(undo_left, right, v.left[right])
            rank, _ = self.merge_rank(left, right)
            # Among equal ranks the leftmost goes first: the seam is left of a merge on its right.
            crosses = np.where(undo_left, rank < until, rank <= until)
            fine[alive[crosses]] = False
            alive, left, right = alive[~crosses], left[~crosses], right[~crosses]
        return fine

    def _canonical(self, ids: np.ndarray) -> np.ndarray:
        v = self.vocabulary
        out = np.zeros(v.size, bool)
        out[v.single[v.single >= 0]] = True
        made = ids[v.rank[ids] >= 0]
        seam = np.zeros(v.size, bool)
        seam[made] = self.compatible(v.left[made], v.right[made], joined=True)
        for i in made[np.argsort(v.rank[made])].tolist():
            out[i] = seam[i] and out[v.left[i]] and out[v.right[i]]
        return out

    def propose(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all pieces at once: (piece, token), by piece and place."""
        pieces, tokens = [], []
        pos, who = starts.copy(), np.arange(len(starts))
        who = who[pos < ends]
        while len(who):
            best = np.zeros(len(who), np.int64)
            best_end = pos[who].copy()
            live, node, at = np.arange(len(who)), np.zeros(len(who), np.int32), pos[who].copy()
            while len(live):
                node = self.trie.step(node, data[at])
                on = node >= 0
                live, node, at = live[on], node[on], at[on] + 1
                value = self.trie.value[node]
                hit = value >= 0
                best[live[hit]], best_end[live[hit]] = value[hit], at[hit]
                on = at < ends[who[live]]
                live, node, at = live[on], node[on], at[on]
            pieces.append(who)
            tokens.append(best)
            pos[who] = best_end
            who = who[best_end < ends[who]]
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        piece = np.concatenate(pieces)
        by = np.argsort(piece, kind="stable")
        return piece[by], np.concatenate(tokens)[by]

    def _propose_long(self, piece: bytes) -> list[int]:
        out, at = [], 0
        while at < len(piece):
            for size in range(min(self.longest, len(piece) - at), 0, -1):
                token = self.by_bytes.get(piece[at : at + size])
                if token is not None:
                    out.append(token)
                    at += size
                    break
        return out

    def merge_one(self, piece: bytes) -> list[int]:
        """Exact merging of one piece: the lowest rank first, the leftmost of equal ones."""
        v = self.vocabulary
        ids = [int(v.single[b]) for b in piece]
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        heap = [
            (m[0], i, a, b)
            for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False))
            if (m := v.merges.get((a, b)))
        ]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = v.merges[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (m := v.merges.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def merge_all(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many short pieces, one merge of each in every round: (piece, token)."""
        v = self.vocabulary
        size = ends - starts
        width = int(size.max())
        there = np.arange(width) < size[:, None]
        ids = np.where(there, v.single[data[np.minimum(starts[:, None] + np.arange(width), len(data) - 1)]], -1)
        rank = np.full((len(size), width), _NEVER)
        x, y = np.nonzero(there[:, 1:])
        rank[x, y] = self.merge_rank(ids[x, y], ids[x, y + 1])[0]
        rows = np.arange(len(size))
        results = np.full(ids.shape, -1, np.int64)
        while len(rows):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            over = best == _NEVER
            if over.any():
                results[rows[over], : ids.shape[1]] = ids[over]
                ids, rank, rows, at = ids[~over], rank[~over], rows[~over], at[~over]
                if not len(rows):
                    break
            n = np.arange(len(rows))
            _, place = self.merge_rank(ids[n, at], ids[n, at + 1])
            shift = np.arange(ids.shape[1]) + (np.arange(ids.shape[1]) > at[:, None])
            full = shift >= ids.shape[1]
            shift[full] = ids.shape[1] - 1
            ids = np.take_along_axis(ids, shift, 1)
            rank = np.take_along_axis(rank, shift, 1)
            ids[full], rank[full] = -1, _NEVER
            ids[n, at] = self.pair_made[place]
            for x in (at - 1, at):
                inside = (x >= 0) & (x + 1 < ids.shape[1])
                k, c = n[inside], x[inside]
                good = ids[k, c + 1] >= 0
                rank[k[~good], c[~good]] = _NEVER
                k, c = k[good], c[good]
                rank[k, c] = self.merge_rank(ids[k, c], ids[k, c + 1])[0]
        row, col = np.nonzero(results >= 0)
        return row, results[row, col]

    def encode_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of distinct pieces one after the other, and offsets."""
        ends = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        if not len(pieces) or ends[-1] == ends[0]:
            return np.zeros(0, np.int64), np.zeros(len(pieces) + 1, np.int64)
        data = np.frombuffer(pieces.buffers()[2], np.uint8)
        starts, ends = ends[:-1].astype(np.int64), ends[1:].astype(np.int64)
        long = np.flatnonzero(ends - starts > _LONG)
        short = np.flatnonzero(ends - starts <= _LONG)
        piece, token = self.propose(data, starts[short], ends[short])
        piece = short[piece]
        lengthy = [self._propose_long(data[starts[i] : ends[i]].tobytes()) for i in long]
        piece = np.concatenate([piece, np.repeat(long, [len(x) for x in lengthy])]).astype(np.int64)
        token = np.concatenate([token, *(np.array(x, np.int64) for x in lengthy)])

        beside = np.flatnonzero(piece[1:] == piece[:-1])
        pairs, where = np.unique(token[beside] * self.vocabulary.size + token[beside + 1], return_inverse=True)
        fine = self.compatible(pairs // self.vocabulary.size, pairs % self.vocabulary.size)[where]
        failing = np.unique(piece[beside[~fine]])
        self.checked, self.failed = len(pieces), len(failing)

        keep = ~np.isin(piece, failing)
        few = failing[(ends - starts)[failing] <= _LONG]
        more = [(piece[keep], token[keep])]
        # Pieces of similar length together, so that rows of a block are filled.
        few = few[np.argsort((ends - starts)[few])]
        for block in (few[i : i + 20_000] for i in range(0, len(few), 20_000)):
            row, made = self.merge_all(data, starts[block], ends[block])
            more.append((block[row], made))
        for i in failing[(ends - starts)[failing] > _LONG]:
            made = self.merge_one(data[starts[i] : ends[i]].tobytes())
            more.append((np.full(len(made), i), np.array(made, np.int64)))
        piece = np.concatenate([x for x, _ in more])
        by = np.argsort(piece, kind="stable")
        counts = np.bincount(piece, minlength=len(pieces))
        return np.concatenate([y for _, y in more])[by], offsets_of(counts)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts one after the other, and the texts' offsets in them."""
        coded = code_texts(column, tuple(self.vocabulary.added))
        one = pc.match_substring_regex(coded.units, _ONE_PIECE).to_numpy(zero_copy_only=False)
        one[list(coded.whole)] = True
        # Units as pieces: one each, or those that the pattern finds.
        rest = [pattern().findall(u) for u in coded.units.filter(pa.array(~one)).to_pylist()]
        counts = np.ones(len(coded.units), np.int64)
        counts[~one] = [len(x) for x in rest]
        offsets = offsets_of(counts)
        found = pa.array([p for x in rest for p in x], pa.large_string())
        at = np.empty(offsets[-1], np.int64)
        at[offsets[:-1][one]] = np.arange(one.sum())
        at[ragged(offsets[:-1][~one], counts[~one])] = one.sum() + np.arange(len(found))
        pieces = pa.concat_arrays([coded.units.filter(pa.array(one)), found]).dictionary_encode()
        of_piece = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ids, ends = self.encode_pieces(pieces.dictionary)
        starts, lengths = ends[:-1].copy(), np.diff(ends)
        if coded.whole:
            own = {s: i for i, s in enumerate(pieces.dictionary.to_pylist()) if s in self.vocabulary.added}
            for s, i in own.items():
                starts[i], lengths[i] = len(ids), 1
                ids = np.append(ids, self.vocabulary.added[s])
        of_unit, unit_offsets = spread(Coded(pieces.dictionary, of_piece[at], offsets, set()), ids, starts, lengths)
        return spread(coded, of_unit, unit_offsets[:-1], np.diff(unit_offsets))

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become the replacement character."""
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """Token ids of whole texts: (key, ids)."""
    path = path or default_path()
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, 1):
                ids, offsets = encoder(path).encode(texts(cut.column(1)))
                held = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([cut.column(0), held], [key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return only(df, **{key: key, "text": text}).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(df: DataFrame, key: str, ids: str, path: str | None = None) -> DataFrame:
    """Texts of token ids: (key, text). Null ids give an empty text."""
    path = path or default_path()
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [encoder(path).decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [key, "text"])

    kind = df.schema[key].dataType.simpleString()
    return only(df, **{key: key, "ids": ids}).mapInArrow(run, f"`{key}` {kind}, text string")


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Encode and decode whole texts; digests of both: (key, n_tokens, ids_sha256, decoded_sha256)."""
    path = path or default_path()
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        decimal = [str(i) for i in range(coder.vocabulary.size)]
        for batch in batches:
            for cut in slices(batch, 1):
                ids, offsets = coder.encode(texts(cut.column(1)))
                ids_hex, text_hex = [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    own = ids[a:b].tolist()
                    ids_hex.append(hashlib.sha256(",".join(map(decimal.__getitem__, own)).encode()).hexdigest())
                    text_hex.append(hashlib.sha256(coder.decode(own).encode()).hexdigest())
                columns = [cut.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(ids_hex), pa.array(text_hex)]
                yield pa.RecordBatch.from_arrays(columns, [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    return only(docs, **{key: key, "text": text}).mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
