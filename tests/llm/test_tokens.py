"""Token operators against the public library and against plain versions of themselves."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing, token_counts, training_order
from tidemark.llm.queries import QUERIES
from tidemark.llm.tokens import batch_tokenizer
from tidemark.llm.vocabulary import byte_vocabulary, default_path
from tidemark.sources.tables import read_table

from .conftest import ODD_TEXTS

PATH = default_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def random_texts():
    draw = random.Random(7)
    parts = [
        "a", "b", " ", "  ", "\n", "\t", "é", "漢", "字", "1", "23", "'s", "'", "!", "<|endoftext|>", " \n", "\x1c", "\x85",
        "\xa0", "🙂", "　", "​", "ا", "x" * 30, "<|endoftext", "\r\n", "\x00", "ⅷ", "́", "aaaaaaa", "....",
        "====", "the", "ing", "un", "est",
    ]
    mixed = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 18))) for _ in range(4000)]
    return mixed + ["a" * n for n in range(300)] + ["=" * n for n in range(300)] + ["ab" * 700, "漢字" * 300]


def parts_of(ids, offsets):
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def test_both_encoders_agree_with_the_library(library, random_texts):
    expected = [e.ids for e in library.encode_batch(random_texts, add_special_tokens=False)]
    column = pa.array(random_texts, pa.large_string())
    assert parts_of(*batch_tokenizer(PATH).encode(column)) == expected
    assert parts_of(*bpe.encoder(PATH).encode(column)) == expected


def test_decoding_agrees_with_the_library(library):
    draw = random.Random(3)
    for _ in range(300):
        ids = [draw.randrange(50257) for _ in range(draw.randint(0, 12))]
        assert bpe.encoder(PATH).decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_only_wrong_proposals_fail_the_check():
    """The seam check is exact: a proposal passes if and only if it is what merging gives."""
    coder = bpe.encoder(PATH)
    draw = random.Random(5)
    words = list({"".join(draw.choice("abeehinorst") for _ in range(draw.randint(1, 12))) for _ in range(3000)})
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    piece, token = coder.propose(data, ends - [len(w) for w in words], ends)
    for i, word in enumerate(words):
        proposal = token[piece == i]
        fine = bool(coder.compatible(proposal[:-1], proposal[1:]).all())
        assert fine == (proposal.tolist() == coder.merge_one(word.encode()))


def test_vectorised_merging_is_exact():
    coder = bpe.encoder(PATH)
    draw = random.Random(6)
    words = ["".join(draw.choice("aabcdeé ") for _ in range(draw.randint(1, 40))).encode() for _ in range(400)]
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    row, made = coder.merge_all(data, ends - [len(w) for w in words], ends)
    assert [made[row == i].tolist() for i in range(len(words))] == [coder.merge_one(w) for w in words]


def test_round_trip_of_all_documents(spark, folder, library):
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, folder, "documents").collect()}
    rows = QUERIES["op7_bpe"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_odd_texts_round_trip(odd_docs, library):
    rows = bpe.round_trip(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    nothing = hashlib.sha256(b"").hexdigest()
    for row in rows:
        if row["doc_id"] is not None:
            text = ODD_TEXTS[row["doc_id"]] or ""
            assert row["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
            assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert next(r for r in rows if r["doc_id"] == 0)["ids_sha256"] == nothing
    assert bpe.round_trip(odd_docs.limit(0)).count() == 0


def test_ids_and_texts_as_tables(odd_docs):
    ids = bpe.encode(odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"]), "doc_id", "text")
    back = {r["doc_id"]: r["text"] for r in bpe.decode(ids, "doc_id", "ids").collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD_TEXTS)}


def greedy(word: bytes, tokens) -> int:
    count = at = 0
    while at < len(word):
        at += next(n for n in range(min(128, len(word) - at), 0, -1) if word[at : at + n] in tokens)
        count += 1
    return count


def test_token_counts_are_greedy_longest_matches(spark, folder, odd_docs):
    tokens = byte_vocabulary(PATH).tokens
    for docs in (read_table(spark, folder, "documents"), odd_docs):
        texts = docs.select("doc_id", "text").collect()
        expected = sorted(
            (str(r["doc_id"]), len((r["text"] or "").split()), sum(greedy(f" {w}".encode(), tokens) for w in (r["text"] or "").split()))
            for r in texts
        )
        found = token_counts.count_tokens(docs).collect()
        assert sorted((str(r["doc_id"]), r["n_words"], r["n_tokens"]) for r in found) == expected
    assert token_counts.count_tokens(odd_docs.limit(0)).count() == 0


def test_counts_of_random_words_are_greedy():
    tokens, counter = byte_vocabulary(PATH).tokens, token_counts.automaton(PATH)
    draw = random.Random(2)
    words = [bytes(draw.choice(b" aeinorst\xc3\xa9\xff=.") for _ in range(draw.randint(0, 30))) for _ in range(2000)]
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    found = counter.counts(data, ends - np.array([len(w) for w in words]), ends)
    assert found.tolist() == [greedy(w, tokens) for w in words]


# Packing


def check_packing(rows, texts, library, capacity):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(-(-len(ids) // capacity)))
        at = 0
        for p in pieces:
            assert p["start"] == at
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
        assert all(p["length"] == capacity for p in pieces[1:])
    check_layout(rows, capacity)


def check_layout(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def best_fit_decreasing(lengths, capacity):
    from bisect import bisect_left, insort

    gaps = []
    for length in sorted(lengths, reverse=True):
        at = bisect_left(gaps, length)
        gap = gaps.pop(at) - length if at < len(gaps) else capacity - length
        insort(gaps, gap)
    return len(gaps)


def test_all_documents_are_packed(spark, folder, library):
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, folder, "documents").collect()}
    rows = QUERIES["op10_packing"](spark, folder).collect()
    check_packing(rows, texts, library, 2048)
    sequences = len({r["sequence_id"] for r in rows})
    assert sequences <= best_fit_decreasing([r["length"] for r in rows], 2048) + 1


def test_odd_documents_are_packed(odd_docs, library):
    rows = packing.pack(odd_docs, capacity=64).collect()
    check_layout(rows, 64)
    single = [r for r in rows if r["doc_id"] not in (None, 5)]
    texts = {i: t for i, t in enumerate(ODD_TEXTS) if i != 5}
    by_doc = {i: [r for r in single if r["doc_id"] == i] for i in texts}
    for i, text in texts.items():
        assert sum(r["length"] for r in by_doc[i]) == len(library.encode(text or "", add_special_tokens=False).ids) + 1
    assert sum(r["doc_id"] == 5 for r in rows) == 3
    assert packing.pack(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_plans_keep_every_piece(seed):
    draw = np.random.default_rng(seed)
    capacity = int(draw.choice([8, 64, 512, 2048]))
    lengths = np.clip(draw.lognormal(np.log(capacity / 3), 1, int(draw.integers(0, 4000))).astype(int), 1, capacity)
    counts = np.bincount(lengths, minlength=capacity + 1)
    plan = packing.make_plan(counts, capacity)
    used = np.zeros(capacity + 1, np.int64)
    for group, n in plan.groups:
        assert sum(group) <= capacity
        for length in group:
            used[length] += n
    assert (used == counts).all()
    assert plan.sequences <= best_fit_decreasing(lengths.tolist(), capacity) + 2
    for length, places in plan.places().items():
        assert (np.diff(places[:, 0]) > 0).all() and counts[length]


def test_exact_complements_are_found():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 55, 30, 15, 50, 20, 17, 13]] = [5, 5, 3, 3, 3, 2, 2, 2, 2]
    plan = packing.make_plan(counts, 100)
    assert plan.sequences == 5 + 3 + 2 and all(sum(g) == 100 for g, _ in plan.groups)


# Training order


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 70_001])
def test_the_permutation_is_one(size):
    order = training_order.Permutation("key", size)
    slots = order.slots(np.arange(size))
    assert sorted(slots) == list(range(size))
    assert (order.ranks(slots) == np.arange(size)).all()


def test_keys_give_other_orders():
    a, b = (training_order.Permutation(k, 1000).slots(np.arange(1000)) for k in ("a", "b"))
    assert (a == b).sum() < 20 and abs(np.corrcoef(a, np.arange(1000))[0, 1]) < 0.15


def test_shards_hold_every_sequence_at_its_place(odd_docs, library, tmp_path):
    folder = f"file://{tmp_path}/shards"
    rows = training_order.materialise(odd_docs, folder, shard_slots=5, record_ids=64).collect()
    total = odd_docs.count()
    assert sorted(r["slot"] for r in rows) == sorted(r["rank"] for r in rows) == list(range(total))
    for r in rows:
        assert r["shard"] == r["slot"] // 5
        first, skip = divmod(r["start"], 64)
        ids = training_order.read_records(folder, r["shard"], first, -(-(skip + r["length"]) // 64), 64).ravel()
        ids = ids[skip : skip + r["length"]]
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        if r["doc_id"] is not None:
            expected = library.encode(ODD_TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids
            assert ids.tolist() == [*expected, 50256]
    for shard in {r["shard"] for r in rows}:
        mine = sorted((r["slot"], r["start"], r["length"]) for r in rows if r["shard"] == shard)
        at = 0
        for _, start, length in mine:
            assert start == at
            at += length
        size = (tmp_path / "shards" / f"shard-{shard:08d}.bin").stat().st_size
        assert size == -(-at // 64) * 64 * 2
    assert not list((tmp_path / "shards").glob("_attempt*"))


def test_an_empty_table_has_no_shards(odd_docs):
    assert training_order.materialise(odd_docs.limit(0)).count() == 0


def test_the_whole_table_is_ordered(spark, folder, library, tmp_path):
    """Slots follow from ranks by the key, and every shard read back whole holds its documents' ids in slot order."""
    docs = read_table(spark, folder, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = training_order.materialise(docs, f"file://{tmp_path}/shards", shard_slots=64).collect()
    own = QUERIES["op6_training_order"](spark, folder).collect()
    assert sorted((r["doc_id"], r["rank"], r["slot"], r["ids_crc32"]) for r in own) == sorted((r["doc_id"], r["rank"], r["slot"], r["ids_crc32"]) for r in rows)
    assert sorted(r["slot"] for r in rows) == sorted(r["rank"] for r in rows) == list(range(len(texts)))
    order = training_order.Permutation("epoch-0", len(texts))
    assert all(order.slots(np.array([r["rank"]]))[0] == r["slot"] == order.slots(order.ranks(np.array([r["slot"]])))[0] for r in rows)
    assert sum(abs(r["rank"] - r["slot"]) < len(texts) // 20 for r in rows) < len(texts) // 4  # shuffled
    by_slot = sorted(rows, key=lambda r: r["slot"])
    for shard in range(-(-len(texts) // 64)):
        mine = by_slot[64 * shard : 64 * (shard + 1)]
        expected = [i for r in mine for i in [*library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 50256]]
        records = -(-len(expected) // training_order.RECORD_IDS)
        found = training_order.read_records(f"file://{tmp_path}/shards", shard, 0, records, training_order.RECORD_IDS).ravel()
        assert found[: len(expected)].tolist() == expected and (found[len(expected) :] == 50256).all()


def test_keys_of_other_types_are_packed(frame):
    for kind, keys in (("int", [1, 2]), ("string", ["a", None])):
        rows = packing.pack(frame([(k, "some words") for k in keys], f"doc_id {kind}, text string"))
        assert dict(rows.dtypes)["doc_id"] == kind and {r["doc_id"] for r in rows.collect()} == set(keys)
