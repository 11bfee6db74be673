"""Texts as few distinct pieces that byte-level BPE encodes one by one.

The tokenizer's pattern never joins what stands before a single space with what follows it, so a
text falls into the units that ``split(" ")`` gives, each but the first led by its space. A batch
has far fewer distinct units than units: Arrow finds them and codes each text by them. Runs of
white space are the exception, as are the strings of added tokens; such texts are cut by the
pattern itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from tidemark.llm.common import offsets_of, ragged

# Fixed value: the pattern of the public byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WHITE = (
    r"[\t-\r \x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
_RUN = f"{_WHITE} (?:{_WHITE}|\\z)|^ (?:{_WHITE}|\\z)"
#: Units led by a space that hold no other at their ends: joined, each is cut off by its space again.
LED = f"\\A [^{_WHITE[1:]}(?:[^ ]*[^{_WHITE[1:]})?\\z"


@lru_cache(maxsize=1)
def pattern() -> regex.Pattern:
    return regex.compile(PATTERN)


@dataclass
class Coded:
    """Texts as codes of units: text i has codes[offsets[i]:offsets[i + 1]]."""

    units: pa.Array  # large_string
    codes: np.ndarray
    offsets: np.ndarray
    whole: set[int]  # codes of units that are strings of added tokens


def _pieces(text: str, added: Sequence[str]) -> list[tuple[str, bool]]:
    """A text by the pattern, the strings of added tokens kept whole."""
    if not added:
        return [(p, False) for p in pattern().findall(text)]
    out: list[tuple[str, bool]] = []
    for part in regex.split("(" + "|".join(map(regex.escape, added)) + ")", text):
        if part in added:
            out.append((part, True))
        else:
            out.extend((p, False) for p in pattern().findall(part))
    return out


def code_texts(column: pa.Array, added: Sequence[str] = ()) -> Coded:
    odd = pc.match_substring_regex(column, _RUN)
    for string in added:
        odd = pc.or_(odd, pc.match_substring(column, string))
    odd = odd.to_numpy(zero_copy_only=False)

    plain = column.filter(pa.array(~odd))
    split = pc.split_pattern(plain, " ")
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    space, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    units = pc.binary_join_element_wise(space, coded.dictionary, nothing)
    offsets = offsets_of(counts)
    if len(plain):  # the first unit of a text has no space before it
        firsts = coded.dictionary.take(pa.array(codes[offsets[:-1]])).dictionary_encode()
        codes[offsets[:-1]] = firsts.indices.to_numpy(zero_copy_only=False).astype(np.int64) + len(units)
        units = pa.concat_arrays([units, firsts.dictionary])
    whole: set[int] = set()
    if not odd.any():
        return Coded(units, codes, offsets, whole)

    known: dict[tuple[str, bool], int] = {}
    lists = []
    for text in column.filter(pa.array(odd)).to_pylist():
        own = [known.setdefault(p, len(units) + len(known)) for p in _pieces(text, added)]
        lists.append(np.array(own, np.int64))
    whole.update(code for (_, special), code in known.items() if special)
    units = pa.concat_arrays([units, pa.array([unit for unit, _ in known], pa.large_string())])
    lengths = np.zeros(len(column), np.int64)
    lengths[~odd] = counts
    lengths[odd] = [len(x) for x in lists]
    both = offsets_of(lengths)
    out = np.empty(both[-1], np.int64)
    out[ragged(both[:-1][~odd], counts)] = codes
    if lists:
        out[ragged(both[:-1][odd], lengths[odd])] = np.concatenate(lists)
    return Coded(units, out, both, whole)


def spread(coded: Coded, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of each text, from the ids of each unit; and the texts' offsets in them."""
    each = lengths[coded.codes]
    out = ids[ragged(starts[coded.codes], each)]
    ends = np.concatenate([[0], np.cumsum(each)])
    return out, ends[coded.offsets]
