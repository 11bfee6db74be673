"""Token ids of whole texts by a public byte-level tokenizer, for operators that only need the ids.

The ids are those of the ``tokenizers`` library for the same file. Each distinct unit of a batch
is encoded once: units without inner spaces go through the library's merge code in one joined
call, where a token that begins with a space begins a unit.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

from tidemark.llm.common import joined_text
from tidemark.llm.pretokens import LED, PATTERN, code_texts, spread
from tidemark.llm.vocabulary import byte_of_char, default_path


class BatchTokenizer:
    """With ``added`` false, the strings of added tokens are plain text."""

    def __init__(self, path: str, added: bool = True):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte = byte_of_char()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(to_byte[c] for c in token): rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in special
        }
        self.added = special if added else {}
        self.encoding = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max([*ranks.values(), *special.values()]) + 1
        self.leads = np.zeros(self.size, bool)
        for token, rank in ranks.items():
            self.leads[rank] = token[:1] == b" "

    def _units(self, units: pa.Array, whole: set[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, and where each unit's begin and how many they are."""
        led = pc.match_substring_regex(units, LED).to_numpy(zero_copy_only=False)
        led[list(whole)] = False
        joined = np.flatnonzero(led)
        text = joined_text(units.filter(pa.array(led)))
        ids = np.asarray(self.encoding.encode_ordinary(text), dtype=np.uint32)
        at = np.flatnonzero(self.leads[ids])
        if len(at) != len(joined):
            raise ValueError("a token with a space inside breaks the cut into units")
        starts = np.zeros(len(units), np.int64)
        lengths = np.zeros(len(units), np.int64)
        starts[joined] = at
        lengths[joined] = np.diff(np.append(at, len(ids)))
        rest: list[int] = []
        alone = np.flatnonzero(~led)
        for i, unit in zip(alone.tolist(), units.take(pa.array(alone)).to_pylist(), strict=True):
            own = [self.added[unit]] if i in whole else self.encoding.encode_ordinary(unit)
            starts[i], lengths[i] = len(ids) + len(rest), len(own)
            rest.extend(own)
        return np.concatenate([ids, np.array(rest, np.uint32)]), starts, lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the texts' offsets in them. No text may be null."""
        coded = code_texts(texts, tuple(self.added))
        ids, starts, lengths = self._units(coded.units, coded.whole)
        return spread(coded, ids, starts, lengths)


@lru_cache(maxsize=2)
def batch_tokenizer(path: str) -> BatchTokenizer:
    """One per worker process: reading the vocabulary takes longer than many a batch."""
    return BatchTokenizer(path)


DEFAULT_PATH = default_path()
