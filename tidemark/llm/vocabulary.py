"""A public byte-level vocabulary as arrays: tokens, merges and a trie.

Files are read where they lie, by a path that is a parameter; nothing is copied or trained.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

NAME = "byte_bpe_50k.json"


def default_path(name: str = NAME) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: its own where it has one,
    else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in printable}
    for n, b in enumerate(b for b in range(256) if chr(b) not in out):
        out[chr(256 + n)] = b
    return out


class Trie:
    """Byte strings as a trie. Edges are one sorted array of node * 256 + byte, found by bisection."""

    def __init__(self, strings: list[bytes], values: list[int]):
        nodes: dict[bytes, int] = {b"": 0}
        keys: list[int] = []
        children: list[int] = []
        order = sorted(range(len(strings)), key=lambda i: (len(strings[i]), strings[i]))
        value = {}
        for i in order:
            string = strings[i]
            at = len(string)
            while at and string[:at] not in nodes:
                at -= 1
            node = nodes[string[:at]]
            for end in range(at + 1, len(string) + 1):
                child = len(nodes)
                nodes[string[:end]] = child
                keys.append(node * 256 + string[end - 1])
                children.append(child)
                node = child
            value[node] = values[i]
        by = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[by]
        self.children = np.array(children, np.int32)[by]
        self.value = np.full(len(nodes), -1, np.int64)
        for node, v in value.items():
            self.value[node] = v
        self.depth = np.zeros(len(nodes), np.int32)
        self.parent = np.zeros(len(nodes), np.int32)
        self.byte = np.zeros(len(nodes), np.int32)
        for key, child in zip(keys, children, strict=True):
            self.parent[child] = key >> 8
            self.byte[child] = key & 255
        for string, node in nodes.items():
            self.depth[node] = len(string)
        # Most steps leave the root or a node one byte deep: those have a table of their own.
        self.near = int((self.depth <= 1).sum())
        self.renumbered = np.argsort(self.depth, kind="stable")
        place = np.empty(len(nodes), np.int32)
        place[self.renumbered] = np.arange(len(nodes))
        self.value, self.depth, self.byte = (a[self.renumbered] for a in (self.value, self.depth, self.byte))
        self.parent = place[self.parent[self.renumbered]]
        moved = place[self.keys >> 8].astype(np.int64) * 256 + (self.keys & 255)
        by = np.argsort(moved)
        self.keys, self.children = moved[by], place[self.children[by]]
        self.table = np.full(self.near * 256, -1, np.int32)
        low = self.keys < self.near * 256
        self.table[self.keys[low]] = self.children[low]
        self.keys, self.children = self.keys[~low], self.children[~low]

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child of each node by each byte, or -1."""
        key = node.astype(np.int64) * 256 + byte
        out = np.full(len(key), -1, np.int32)
        near = node < self.near
        out[near] = self.table[key[near]]
        far = np.flatnonzero(~near)
        if len(far) and len(self.keys):
            wanted = key[far]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            out[far] = np.where(self.keys[at] == wanted, self.children[at], -1)
        return out


class ByteVocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte = byte_of_char()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {
            bytes(to_byte[c] for c in token): rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in self.added
        }
        self.size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes: list[bytes] = [b""] * self.size
        for token, i in vocab.items():
            self.bytes[i] = token
        for content, i in self.added.items():
            self.bytes[i] = content.encode()
        self.single = np.full(256, -1, np.int64)
        for token, i in vocab.items():
            if len(token) == 1:
                self.single[token[0]] = i
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        self.rank = np.full(self.size, -1, np.int64)  # of the merge that makes a token; -1: a byte
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            x, y = (bytes(to_byte[c] for c in part) for part in (a, b))
            made = vocab[x + y]
            self.merges[vocab[x], vocab[y]] = (rank, made)
            if self.rank[made] < 0:
                self.left[made], self.right[made], self.rank[made] = vocab[x], vocab[y], rank
        self.tokens = vocab


@lru_cache(maxsize=2)
def byte_vocabulary(path: str) -> ByteVocabulary:
    return ByteVocabulary(path)


@lru_cache(maxsize=2)
def byte_trie(path: str) -> Trie:
    tokens = byte_vocabulary(path).tokens
    return Trie(list(tokens), list(tokens.values()))
