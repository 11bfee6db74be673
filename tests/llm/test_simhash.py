"""Fingerprints, near-duplicate groups and components against plain versions."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import fingerprints, simhash
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES
from tidemark.sources.tables import read_table

from .conftest import ODD_TEXTS


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def fingerprint(text, size=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    runs = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(texts, radius=2):
    prints = {i: fingerprint(t) for i, t in texts}
    groups = Groups()
    distinct = {}
    for i in sorted(prints):
        groups.join(i, distinct.setdefault(prints[i], i))
    values = np.array(list(distinct), np.uint64)
    for n, value in enumerate(values):
        for m in np.flatnonzero(np.bitwise_count(values ^ value) <= radius):
            groups.join(distinct[int(value)], distinct[int(values[m])])
    return sorted((i, format(p, "016x"), groups.find(i)) for i, p in prints.items())


def test_all_documents_are_grouped(spark, folder):
    texts = [(r["doc_id"], r["text"]) for r in read_table(spark, folder, "documents").collect()]
    assert sorted(map(tuple, QUERIES["op9_simhash_dedup"](spark, folder).collect())) == brute(texts)


def test_odd_documents(odd_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    expected = {i: (p, c) for i, p, c in brute(list(enumerate(ODD_TEXTS)))}
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["fingerprint"], r["component_id"]) == expected[r["doc_id"]]
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (0, 1, 2, 3)} == {"0" * 16}
    assert simhash.near_duplicates(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [3, 16, 4096])
def test_tiles_lose_no_link(frame, monkeypatch, tile):
    """Clusters of fingerprints a few bits apart, a third of all under one population count."""
    monkeypatch.setattr(simhash, "TILE", tile)
    draw = random.Random(4)
    values = {draw.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1, 1, 3, 2**63}
    for value in list(values)[:25]:
        for _ in range(4):
            value ^= 1 << draw.randrange(64)
            values.add(value)
    values |= {sum(1 << b for b in draw.sample(range(64), 20)) for _ in range(90)}
    values = sorted(values)
    rows = [(i, v if v < 2**63 else v - 2**64) for i, v in enumerate(values)]
    groups = Groups()
    for (a, x), (b, y) in itertools.combinations(enumerate(values), 2):
        if (x ^ y).bit_count() <= 2:
            groups.join(a, b)
    found = simhash.near_groups(frame(rows, "id long, print long"), "id", 2).collect()
    assert {r["id"]: r["component_id"] for r in found} == {i: groups.find(i) for i in range(len(values))}


@pytest.mark.parametrize("parts", [1, 2, 4, 8])
def test_steps_reach_all_near_counts(parts):
    steps = simhash._steps(parts, 2)
    draw = random.Random(parts)

    def key(value):
        size = 64 // parts
        out = 0
        for i in range(parts):
            out = out * 100 + (value >> i * size & (1 << size) - 1).bit_count()
        return out

    for _ in range(300):
        a = draw.getrandbits(64)
        b = a ^ sum(1 << bit for bit in draw.sample(range(64), draw.randrange(3)))
        assert abs(key(a) - key(b)) in steps


def test_count_key_is_as_described(frame):
    value = 0xFF0000000000000F
    row = frame([(1, value - 2**64)], "id long, w long").select(
        *(simhash.count_key("w", p).alias(str(p)) for p in (1, 2, 4, 8))
    ).first()
    assert (row["1"], row["2"], row["4"]) == (12, 408, 4_000_008)


def test_majority_over_many_shingles():
    draw = np.random.default_rng(1)
    hashes = draw.integers(0, 2**63, 200_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    cuts = np.array([0, 0, 1, 3, 150_000, 200_000])
    found = simhash.majority_bits(hashes, cuts)
    for a, b, word in zip(cuts, cuts[1:], found, strict=False):
        votes = [int((hashes[a:b] >> np.uint64(bit) & np.uint64(1)).sum()) for bit in range(64)]
        assert int(word) == sum(1 << bit for bit, v in enumerate(votes) if 2 * v > b - a)


def test_tiles_and_their_bytes_do_not_depend_on_partitions(spark, frame, monkeypatch):
    """Rows of one count make rows / TILE tiles, rounded up, however many partitions there are."""
    monkeypatch.setattr(simhash, "TILE", 64)
    draw = random.Random(3)
    prints = {sum(1 << b for b in draw.sample(range(64), 32)) for _ in range(900)} | {draw.getrandbits(64) for _ in range(300)}
    rows = [(p if p < 2**63 else p - 2**64,) for p in prints]
    nodes = frame(rows, "print long").select("print", simhash.count_key("print", 1).alias("key"))
    of_count = {}
    for p in prints:
        of_count[p.bit_count()] = of_count.get(p.bit_count(), 0) + 1
    shapes = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (6, 211):
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            made = simhash.tiles(nodes).select("key", F.size("prints").alias("n")).collect()
            count = {}
            for r in made:
                count[r["key"]] = count.get(r["key"], 0) + 1
            for key, n in of_count.items():
                assert math.ceil(n / 64) - 1 <= count[key] <= math.ceil(n / 64)
            assert sum(r["n"] for r in made) == len(prints)
            shapes.append(sorted((r["key"], r["n"]) for r in made))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert shapes[0] == shapes[1]


def test_one_of_each_group_stays(frame):
    """What stays is the smallest key of each group that plain comparison finds; whole rows, clashing names."""
    draw = random.Random(9)
    words = ["".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    texts = []
    for _ in range(6):
        base = [draw.choice(words) for _ in range(600)]
        for copy in range(8):
            own = base.copy()
            for at in draw.sample(range(600), copy // 2):
                own[at] = draw.choice(words)
            texts.append(" ".join(own))
    texts += [" ".join(draw.choice(words) for _ in range(draw.randint(1, 500))) for i in range(60)]
    rows = [(i, t, "x", i) for i, t in enumerate(texts)]
    rows += [rows[10], rows[10], rows[60], (3, "another text under a used key, which stays", None, None)]
    kept = simhash.keep_one_of_each(frame(rows, "doc_id long, text string, print string, component_id long"))
    assert kept.columns == ["doc_id", "text", "print", "component_id"]
    first = {i for i, _, c in brute(list(enumerate(texts))) if i == c}
    assert len(first) < len(texts) - 20
    expected = sorted([rows[i] for i in first] + [rows[-1]], key=str)
    assert sorted(map(tuple, kept.collect()), key=str) == expected


def test_odd_documents_keep_one_of_each(odd_docs):
    kept = simhash.keep_one_of_each(odd_docs).collect()
    texts = [r["text"] for r in kept]
    assert len(texts) == len({(t or "").strip() for t in texts}) == len({(t or "").strip() for t in [*ODD_TEXTS, "a text"]})
    assert simhash.keep_one_of_each(odd_docs.limit(0)).count() == 0


def test_components_of_random_graphs(frame):
    draw = random.Random(8)
    for nodes, edges in ((40, 30), (200, 150), (60, 400)):
        pairs = [(draw.randrange(nodes), draw.randrange(nodes)) for _ in range(edges)]
        groups = Groups()
        for a, b in pairs:
            groups.join(a, b)
        linked = {x for a, b in pairs if a != b for x in (a, b)}
        found = components(frame([*pairs, (None, 1), (2, None)], "a long, b long")).collect()
        assert {r["node"]: r["component"] for r in found} == {x: groups.find(x) for x in linked}
        assert len(found) == len(linked)


def test_components_of_long_chains_and_hubs(frame, spark):
    chain = [(i, i + 1) for i in range(100, 400)]
    hub = [(1000, i) for i in range(2000, 2600)]
    found = {r["node"]: r["component"] for r in components(frame(chain + hub, "a long, b long")).collect()}
    assert set(found[i] for i in range(100, 401)) == {100}
    assert set(found[i] for i in [1000, *range(2000, 2600)]) == {1000}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


# Document fingerprints


def edited(text, following):
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def test_edits_and_likeness(spark, folder):
    rows = sorted((r["doc_id"], r["text"]) for r in read_table(spark, folder, "documents").collect())
    result = QUERIES["op3_fingerprints"](spark, folder)
    found = {r["doc_id"]: r for r in result.collect()}
    assert len(found) == len(rows)
    own = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint_texts(read_table(spark, folder, "documents")).collect()}
    by_text = {}
    for n, (i, text) in enumerate(rows):
        after, following = rows[(n + 1) % len(rows)]
        r = found[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited(text, following).encode()).hexdigest()
        assert r["fingerprint"] == own[i]
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        distance = bin(int(own[i], 16) ^ int(own[after], 16)).count("1")
        assert r["near_next"] == pytest.approx(max(0, math.cos(math.pi * distance / 64)), abs=1e-9)
        distance = bin(int(r["fingerprint"], 16) ^ int(r["edited_fingerprint"], 16)).count("1")
        assert r["near_edited"] == pytest.approx(max(0, math.cos(math.pi * distance / 64)), abs=1e-9)
    nearer = sum(r["near_edited"] > r["near_next"] for r in found.values())
    assert nearer > 0.95 * len(found)
    values = {int(r["fingerprint"], 16) for r in found.values()}
    near = {v: sum(0 < (v ^ w).bit_count() <= 3 for w in values) for v in values}
    assert all(r["n_near"] == near[int(r["fingerprint"], 16)] for r in found.values())
    plan = spark._jvm.PythonSQLUtils.explainString(result._jdf.queryExecution(), "simple")
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


def test_texts_are_split_once_and_never_in_a_join(spark, folder, monkeypatch):
    """Spark must not carry the test for terms into the join of texts, where each pair would be split."""
    plans = []

    def keep(df, label="step", settle=fingerprints.settle):
        plans.append(spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted"))
        return settle(df, label)

    monkeypatch.setattr(fingerprints, "settle", keep)
    QUERIES["op3_fingerprints"](spark, folder)
    conditions = [x for p in plans for x in re.findall(r"(?:Join condition|Condition) *: (.*)", p)]
    assert conditions and not any("split(" in c for c in conditions)


def test_votes_are_majorities(frame):
    words = "one two three four five one two three six seven".split()
    df = frame([(1, " ".join(words)), (2, "one"), (3, None), (4, "one two"), (5, "ONE, two?")], "doc_id long, text string")
    hashed = df.where("text is not null").select(
        "doc_id", F.posexplode(fingerprints.term_hashes(fingerprints.word_hashes(F.col("text")))).alias("at", "h")
    )
    terms = {}
    for r in hashed.collect():
        terms.setdefault(r["doc_id"], []).append(r["h"] % 2**64)
    assert len(terms[1]) == 8 and terms[1][0] == terms[1][5] and len(terms[2]) == 1
    prints = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint_texts(df).collect()}
    for i, hashes in terms.items():
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert prints[i] == format(bits, "016x")
    assert prints[3] == "0" * 16 and prints[4] == prints[5]


def test_odd_documents_have_fingerprints(odd_docs):
    rows = fingerprints.fingerprints_and_edits(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r["doc_id"] is not None:
            text = ODD_TEXTS[r["doc_id"]] or ""
            following = ODD_TEXTS[r["doc_id"] + 1] if r["doc_id"] + 1 < len(ODD_TEXTS) else ""
            if r["doc_id"] + 1 < len(ODD_TEXTS):
                assert r["edited_sha256"] == hashlib.sha256(edited(text, following or "").encode()).hexdigest()
            assert r["n_chars"] == len(text)
            if len(text) < 4:
                assert r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1
    assert fingerprints.fingerprints_and_edits(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize(("radius", "blocks"), [(0, 1), (1, 2), (3, 6), (4, 5)])
def test_block_tables_find_all_near_fingerprints(frame, radius, blocks):
    draw = random.Random(radius)
    values = [draw.getrandbits(64) for _ in range(60)]
    for value in values[:40]:
        values.append(value ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(6))))
    values += values[:10]
    df = frame([(format(v, "016x"), 1) for v in values] + [(None, 2)], "fingerprint string, table int")
    found = [tuple(r) for r in fingerprints.within_radius(df, df, radius, blocks).collect()]
    assert len(found) == len(set(found))
    expected = {
        (format(a, "016x"), format(b, "016x"), (a ^ b).bit_count())
        for a, b in itertools.product(set(values), repeat=2)
        if (a ^ b).bit_count() <= radius
    }
    assert set(found) == expected


def test_near_fingerprints_are_counted(frame):
    """A dense group, copies and lone fingerprints against all pairs."""
    draw = random.Random(11)
    base = draw.getrandbits(64)
    values = [base ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(3))) for _ in range(300)]
    values += [draw.getrandbits(64) for _ in range(200)] + values[:40]
    df = frame([(v - 2**64 if v >= 2**63 else v,) for v in values], "bits long")
    found = {r["bits"] % 2**64: r["n_near"] for r in fingerprints.count_near(df).collect()}
    distinct = set(values)
    expected = {v: sum(0 < (v ^ w).bit_count() <= 3 for w in distinct) for v in distinct}
    assert found == {v: n for v, n in expected.items() if n}
    assert fingerprints.count_near(df.limit(0)).count() == 0
