"""Token counts by greedy longest match, in time linear in the text, without building tokens.

The vocabulary is a trie with failure links. Where a word leaves the trie at a node, the longest
matches of what has been read so far are popped: how many they are is stored with the node, as is
the node to go on from, so the count of a word is a walk over its bytes. All distinct words of a
batch walk at once. A word is what white space bounds, read with one space before it, as the
vocabulary writes words within a text.

Null and empty texts have no words and no tokens; very long texts and words are read whole. Repeated
rows and null keys are counted each. An empty table gives an empty one. Only the named columns are
read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm.common import only, slices, texts
from tidemark.llm.shipping import ship
from tidemark.llm.vocabulary import byte_trie, default_path


class Automaton:
    def __init__(self, path: str):
        self.trie = trie = byte_trie(path)
        nodes = len(trie.value)
        children: dict[tuple[int, int], int] = {
            (p, b): n for n, (p, b) in enumerate(zip(trie.parent.tolist(), trie.byte.tolist(), strict=True)) if n
        }
        if any((0, b) not in children or trie.value[children[0, b]] < 0 for b in range(256)):
            raise ValueError("every byte has to be a token")
        link = [0] * nodes
        popped = [0] * nodes
        value, parent, byte = trie.value.tolist(), trie.parent.tolist(), trie.byte.tolist()
        for node in range(1, nodes):  # nodes are numbered by depth
            if value[node] >= 0:
                popped[node] = 1  # the node's string is a token itself: pop it, start anew
                continue
            at, count = link[parent[node]], popped[parent[node]]
            while (at, byte[node]) not in children:
                count += popped[at]
                at = link[at]
            link[node], popped[node] = children[at, byte[node]], count
        self.link = np.array(link, np.int32)
        self.popped = np.array(popped, np.int64)

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many tokens each word has."""
        out = np.zeros(len(starts), np.int64)
        who = np.flatnonzero(starts < ends)
        at, node = starts[who].copy(), np.zeros(len(who), np.int32)
        while len(who):
            byte = data[at]
            child = self.trie.step(node, byte)
            stuck = np.flatnonzero(child < 0)
            while len(stuck):  # from the root every byte leads on
                out[who[stuck]] += self.popped[node[stuck]]
                node[stuck] = self.link[node[stuck]]
                child[stuck] = self.trie.step(node[stuck], byte[stuck])
                stuck = stuck[child[stuck] < 0]
            node = child
            at += 1
            done = at == ends[who]
            if done.any():
                self._pop_rest(out, who[done], node[done])
                who, at, node = who[~done], at[~done], node[~done]
        return out

    def _pop_rest(self, out: np.ndarray, who: np.ndarray, node: np.ndarray) -> None:
        while len(who):
            out[who] += self.popped[node]
            node = self.link[node]
            who, node = who[node > 0], node[node > 0]


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(path)


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, n_words, n_tokens) of whole texts."""
    path = path or default_path()
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = automaton(path)
        space, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        for batch in batches:
            for cut in slices(batch, 1):
                split = pc.utf8_split_whitespace(texts(cut.column(1)))
                sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
                words = split.flatten().dictionary_encode()
                codes = words.indices.to_numpy(zero_copy_only=False)
                real = pc.greater(pc.binary_length(words.dictionary), 0).to_numpy(zero_copy_only=False)
                led = pc.binary_join_element_wise(space, words.dictionary, nothing)
                ends = np.frombuffer(led.buffers()[1], np.int64)[: len(led) + 1] if len(led) else np.zeros(1, np.int64)
                data = np.frombuffer(led.buffers()[2], np.uint8) if len(led) else np.zeros(0, np.uint8)
                each = np.where(real, counter.counts(data, ends[:-1].copy(), ends[1:]), 0)
                doc = np.repeat(np.arange(len(cut)), sizes)
                n_words = np.bincount(doc, weights=real[codes], minlength=len(cut)).astype(np.int64)
                n_tokens = np.bincount(doc, weights=each[codes], minlength=len(cut)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [cut.column(0), pa.array(n_words), pa.array(n_tokens)], [key, "n_words", "n_tokens"]
                )

    kind = docs.schema[key].dataType.simpleString()
    return only(docs, **{key: key, "text": text}).mapInArrow(run, f"`{key}` {kind}, n_words bigint, n_tokens bigint")
