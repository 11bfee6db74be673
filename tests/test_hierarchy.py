"""Hierarchies: the expected quarantine and paths, and random graphs against plain Python."""

import math
import random

import pytest
from pyspark.errors import PySparkException

from tidemark.operators import hierarchy as h

FIXTURE = [(0, 0), (1, 0), (2, 1), (3, 2), (10, 11), (11, 10), (12, 10), (13, 12), (20, 20), (30, 99)]


def edges_of(spark, pairs):
    return h.Edges(spark.createDataFrame(pairs, "OrganizationID INT, ParentOrganizationID INT"))


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def walk(pairs, start, limit=50):
    """All (ancestor, path, distance) of one node, by following rows."""
    parents = {}
    for child, parent in pairs:
        parents.setdefault(child, []).append(parent)
    found, frontier = [], [(p, str(start), 0) for p in parents[start]]
    while frontier:
        ancestor, path, distance = frontier.pop()
        found.append((ancestor, path, distance))
        if distance < limit and ancestor is not None and ancestor != start:
            frontier += [
                (p, f"{path} > {ancestor}", distance + 1)
                for p in parents.get(ancestor, ())
                if p is not None and p != ancestor
            ]
    return found


def expected_circular(pairs, limit=50):
    return sorted(
        {c for c, _ in pairs if c != 0 and any(a == c and d > 0 for a, _, d in walk(pairs, c, limit))}
    )


def expected_removed(pairs, limit=50):
    removed = set(expected_circular(pairs, limit))
    while True:
        below = {c for c, p in pairs if p in removed} - removed
        if not below:
            return sorted(removed)
        removed |= below


def test_fixture(spark):
    edges = edges_of(spark, FIXTURE)
    members = h.circular(edges)
    assert ids(members) == [10, 11]
    hanging = h.nested(edges, members)
    assert ids(hanging) == [12]
    below = h.descendants(edges, hanging)
    assert sorted((r["level"], r["id"]) for r in below.collect()) == [(1, 12), (2, 13)]
    split = h.quarantine(edges, 5)
    removed = split.exceptions.collect()
    assert sorted(r["OrganizationID"] for r in removed) == [10, 11, 12, 13]
    assert {(r["ServerExecutionID"], r["ErrorCode"], r["ErrorDescription"]) for r in removed} == {(5, 0, h.CIRCULAR)}
    found = {r["id"]: r["path"] for r in h.paths(edges.with_rows(split.clean)).collect()}
    assert found == {0: "/", 1: "/1/", 2: "/1/2/", 3: "/1/2/3/"}


def test_trail_sorts_depth_first(spark):
    found = h.paths(edges_of(spark, [(0, 0), (2, 0), (10, 0), (3, 2), (11, 2)])).orderBy("trail").collect()
    assert [r["id"] for r in found] == [0, 2, 3, 11, 10]


def random_forest(rng, n, cycles=True):
    pairs = [(0, 0)]
    for child in range(1, n):
        parent = rng.randrange(n + 3) if cycles and rng.random() < 0.3 else rng.randrange(child)
        pairs.append((child, rng.choice([parent] * 15 + [None, child])))
    return pairs


@pytest.mark.parametrize("seed", range(3))
def test_single_parents_against_plain_python(spark, seed):
    pairs = random_forest(random.Random(seed), 60)
    edges = edges_of(spark, pairs)
    found = sorted((r["id"], r["ancestor"], r["path"], r["distance"]) for r in h.ancestors(edges).fillna(-1).collect())
    expected = sorted((c, -1 if a is None else a, p, d) for c, _ in pairs for a, p, d in walk(pairs, c))
    assert found == expected
    assert ids(h.circular(edges)) == expected_circular(pairs)
    split = h.quarantine(edges, 1)
    assert sorted(r["OrganizationID"] for r in split.exceptions.collect()) == expected_removed(pairs)
    # Every edge is either removed, on a path, or does not lead to the root.
    parent = dict(pairs)
    paths = {r["id"]: r["trail"] for r in h.paths(edges.with_rows(split.clean)).collect()}
    for node in set(parent) - set(expected_removed(pairs)):
        way, at = [], node
        while at != 0 and at in parent and parent[at] != at and len(way) < 100:
            way.insert(0, at)
            at = parent[at]
        assert paths.get(node) == (way if at == 0 else None)


def test_cycle_length_limit(spark):
    ring = [(100 + n, 100 + (n + 1) % 51) for n in range(51)]
    long_ring = [(200 + n, 200 + (n + 1) % 52) for n in range(52)]
    tails = [(300, 100), (301, 200)]
    edges = edges_of(spark, [(0, 0), *ring, *long_ring, *tails])
    assert ids(h.circular(edges, 50)) == list(range(100, 151))
    removed = h.quarantine(edges, 1, 50).exceptions
    assert sorted(r["OrganizationID"] for r in removed.collect()) == [*range(100, 151), 300]
    # Without a limit no cycle is too long.
    everything = [*range(100, 151), *range(200, 252)]
    assert ids(h.circular(edges)) == everything
    assert sorted(r["OrganizationID"] for r in h.quarantine(edges, 1).exceptions.collect()) == [*everything, 300, 301]
    # The long ring survives quarantine and must not trap the path building.
    assert [r["path"] for r in h.paths(edges).collect()] == ["/"]


def test_deep_hierarchy(spark):
    found = h.paths(edges_of(spark, [(0, 0)] + [(n, n - 1) for n in range(1, 200)]))
    assert {r["id"]: len(r["trail"]) for r in found.collect()} == {n: n for n in range(200)}


def test_several_parents(spark):
    pairs = [(0, 0), (1, 0), (2, 0), (3, 1), (3, 2), (4, 3), (5, 6), (6, 5), (6, 0), (7, 6)]
    edges = edges_of(spark, pairs)
    limit = 6
    found = sorted((r["id"], r["ancestor"], r["path"], r["distance"]) for r in h.ancestors(edges, limit).collect())
    assert found == sorted((c, a, p, d) for c in dict(pairs) for a, p, d in walk(pairs, c, limit))
    assert ids(h.circular(edges, limit)) == [5, 6]
    removed = h.quarantine(edges, 1, limit).exceptions.collect()
    assert sorted({r["OrganizationID"] for r in removed}) == [5, 6, 7]
    with pytest.raises(PySparkException, match="two parents"):
        h.paths(edges).collect()
    smallest = {r["id"]: r["path"] for r in h.paths(edges, smallest=True).collect()}
    assert smallest == {0: "/", 1: "/1/", 2: "/2/", 3: "/1/3/", 4: "/1/3/4/", 6: "/6/", 5: "/6/5/", 7: "/6/7/"}


def reachable(pairs):
    up = {}
    for child, parent in pairs:
        if parent is not None and parent != child:
            up.setdefault(child, set()).add(parent)
    above = {}
    for start in {c for c, _ in pairs}:
        seen, todo = set(), list(up.get(start, ()))
        while todo:
            at = todo.pop()
            if at not in seen:
                seen.add(at)
                todo += up.get(at, ())
        above[start] = seen
    return above


@pytest.mark.parametrize("seed", range(1))
def test_several_parents_without_a_limit(spark, seed):
    rng = random.Random(seed)
    pairs = [(0, 0)] + [(rng.randrange(1, 30), rng.choice([rng.randrange(33), None])) for _ in range(45)]
    pairs += [(100 + n, 100 + (n + 1) % 60) for n in range(60)] + [(100, 0), (200, 130), (201, 200), (201, 0)]
    edges = edges_of(spark, pairs)
    above = reachable(pairs)
    members = {c for c in above if c in above[c]}
    assert ids(h.circular(edges)) == sorted(members - {0})
    removed = {r["OrganizationID"] for r in h.quarantine(edges, 1).exceptions.collect()}
    assert removed == {c for c in above if c in members or above[c] & members}


def test_a_ladder_writes_no_paths(spark):
    """Two ways up at every level: paths double, nodes do not."""
    pairs = [(0, 0)] + [(2 * n + side, max(0, 2 * (n - 1) + other)) for n in range(1, 24) for side in (0, 1) for other in (0, 1)]
    edges = edges_of(spark, pairs)
    assert h.circular(edges).count() == 0
    assert h.quarantine(edges, 1).exceptions.count() == 0
    below = h.descendants(edges, spark.createDataFrame([(2,), (3,)], "id INT"))
    assert below.count() == len({p for p in pairs if p[0] >= 2})


@pytest.mark.parametrize(
    "pairs",
    [
        [(n, (n + 1) % 120) for n in range(120)] + [(5, 60)],
        [(n, n - 1) for n in range(1, 101)] + [(50, 20)],
    ],
    ids=["ring", "chain"],
)
def test_rounds_grow_with_the_logarithm(spark, monkeypatch, pairs):
    nodes = {x for p in pairs for x in p}
    steps = []
    settled = h.settle
    monkeypatch.setattr(h, "settle", lambda df, label="step": steps.append(label) or settled(df, label))
    edges = edges_of(spark, pairs)
    above = reachable(pairs)
    members = {c for c in above if c in above[c]}
    found = h.circular(edges, root=-1)
    assert ids(found) == sorted(members)
    assert len(steps) <= 3 * math.log2(len(nodes)) ** 2
    steps.clear()
    known = found if members else None
    removed = {r["OrganizationID"] for r in h.quarantine(edges, 1, members=known).exceptions.collect()}
    assert removed == {c for c in above if c in members or above[c] & members}
    assert len(steps) <= 4 * math.log2(len(nodes)) ** 2


def test_a_ring_of_two_parents_takes_few_steps(spark, monkeypatch):
    """A ring, a ladder into it and one that leads nowhere: each is followed by one parent, and that settles it."""
    total = 300
    ring, ladder = total * 2 // 3, total * 5 // 6
    ways = [(k, after) for k in range(total) for after in (k + 1, k + 2)]
    pairs = [(k, after % ring if k < ring else 0 if k < ladder <= after else after) for k, after in ways]
    steps = []
    settled = h.settle
    monkeypatch.setattr(h, "settle", lambda df, label="step": steps.append(label) or settled(df, label))
    edges = edges_of(spark, pairs)
    members = h.circular(edges, root=-1)
    removed = h.quarantine(edges, 1, members=members).exceptions
    assert ids(members) == list(range(ring))
    assert {r["OrganizationID"] for r in removed.collect()} == set(range(ladder))
    assert len(steps) <= 8 * math.log2(total)


RING_OF_TWO = [(n, (n + step) % 12) for n in range(12) for step in (1, 2)] + [(20, 3), (21, 20), (21, 30)]
LADDER = [(0, 0)] + [(n, max(0, n - step)) for n in range(1, 12) for step in (1, 2)] + [(5, 9), (20, 5)]
RINGS = [(n, n // 6 * 6 + (n + 1) % 6) for n in range(12)] + [(20, 3), (21, 20), (30, 40)]


@pytest.mark.parametrize(
    ("pairs", "run"),
    [
        (RING_OF_TWO, lambda e: [m := h.circular(e, root=-1), h.quarantine(e, 1, members=m).exceptions]),
        (LADDER, lambda e: [h.quarantine(e, 1).exceptions, h.quarantine(e, 1).clean]),
        (LADDER, lambda e: [h.circular(e)]),
        (RINGS, lambda e: [h.circular(e, root=-1), h.circular(e, 50), h.quarantine(e, 1).exceptions]),
    ],
    ids=["ring_of_two_parents", "several_parents_quarantine", "several_parents_circular", "long_cycle"],
)
def test_no_round_is_broadcast(spark, monkeypatch, pairs, run):
    """A settled round that repeats few values looks small enough to broadcast at any number of rows."""
    joins = []

    def look(df):
        joins.extend(line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if " Join " in f" {line}")

    settled = h.settle
    monkeypatch.setattr(h, "settle", lambda df, label="step": look(df) or settled(df, label))
    for found in run(edges_of(spark, pairs)):
        look(found)
    assert joins
    assert [line for line in joins if "strategy=merge" not in line] == []


def test_no_root_no_paths(spark):
    assert h.paths(edges_of(spark, [(1, 0), (2, 1)])).count() == 0


def test_update_and_resolve(spark):
    edges = edges_of(spark, [(0, 0), (1, 0), (2, 2)])
    table = spark.createDataFrame([(0, "/"), (1, None), (2, "/old/")], "OrganizationID INT, Path STRING")
    updated = h.update_if_changed(table, h.paths(edges), "OrganizationID", "Path")
    assert sorted((r[0], r[1], r[2]) for r in updated.collect()) == [(0, "/", False), (1, "/1/", True), (2, None, True)]
    old = [(1, h.CIRCULAR), (1, "Orphan x"), (2, h.CIRCULAR), (1, None)]
    exceptions = spark.createDataFrame(old, "OrganizationID INT, ErrorDescription STRING")
    left = h.clear_resolved(exceptions, updated, "OrganizationID", "Path").collect()
    assert sorted(map(str, left)) == sorted(map(str, exceptions.collect()[1:]))
