"""Parent-child hierarchies: ancestor walks, cycles and what hangs off them, paths from the root.

Where every child has one parent, chains are followed by doubling: after ``k`` rounds each row
knows where ``2**k`` steps lead, so a hierarchy of depth ``d`` takes ``log2(d)`` joins instead
of ``d``, and rows that have arrived take no further part. Every round is settled. Where children
have several parents, one parent of each is followed in this way: cycles that are met shrink to one
node, and lengths of chains tell most steps that lie on none. What is left is parted by the lowest
node above and below each node, which spreads by doubling too.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import free, new_run_folder, settle
from tidemark.functions.guards import require, true
from tidemark.functions.ordered import HOT_ROWS, numbered
from tidemark.spec import ERROR_CODE, ERROR_COLUMN, ERROR_DESCRIPTION

# How far an ancestor walk goes, the root's id, and the text of a quarantined row.
MAX_DISTANCE = 50
ROOT = 0
CIRCULAR = "Circular ParentOrganizationID Reference"


@dataclass(frozen=True)
class Edges:
    """An adjacency list and the names of its two columns."""

    df: DataFrame
    id: str = "OrganizationID"
    parent: str = "ParentOrganizationID"

    def pairs(self) -> DataFrame:
        return self.df.select(F.col(self.id).cast("bigint").alias("id"), F.col(self.parent).cast("bigint").alias("parent"))

    def with_rows(self, df: DataFrame) -> Edges:
        return Edges(df, self.id, self.parent)


def _shuffled(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is never broadcast, however few bytes it seems to have.

    Many rows that share a few values take little room in files and all of it in a broadcast, and a
    loop would send one through the driver in every round.
    """
    return df.hint("merge")


def has_repeated_children(edges: Edges) -> bool:
    counts = edges.pairs().groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return not counts.where(F.col("n") > 1).isEmpty()


def ancestors(edges: Edges, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Every node with each of its ancestors: ``id``, ``ancestor``, ``path``, ``distance``.

    A walk ends at a row that is its own parent, when it comes back to its start, and after
    ``max_distance`` steps. A child with several parents is followed through each of them.
    """
    if has_repeated_children(edges):
        return _walk(edges, max_distance)
    trails = _trails(edges, max_distance + 1)
    returned = F.array_position("trail", F.col("id")).cast("int")
    cut = trails.withColumn("trail", F.when(returned > 0, F.slice("trail", F.lit(1), returned)).otherwise(F.col("trail")))
    steps = cut.select("id", "trail", F.posexplode("trail").alias("distance", "ancestor"))
    met = F.slice(F.concat(F.array("id"), F.col("trail")), F.lit(1), F.col("distance") + 1)
    return steps.select("id", "ancestor", F.array_join(met.cast("array<string>"), " > ").alias("path"), "distance")


def _onward(pairs: DataFrame) -> DataFrame:
    """Mark the rows whose parent leads further on.

    The others are left out of the joins that follow: without this, all nodes below one root
    would meet in one task only to find no partner.
    """
    known = pairs.where(F.col("parent") != F.col("id")).select(F.col("id").alias("_known")).distinct()
    return pairs.join(known, F.col("parent") == F.col("_known"), "left").select(
        "id", "parent", F.col("_known").isNotNull().alias("onward")
    )


def _trails(edges: Edges, limit: int) -> DataFrame:
    """Each node's first ``limit`` ancestors, nearest first. One parent per child."""
    marked = settle(_onward(edges.pairs()).withColumn("trail", F.array("parent")), "trails")
    waiting = marked.where("onward").select("id", F.col("parent").alias("to"), "trail")
    closed = [marked.where(~F.col("onward")).select("id", "trail")]
    length = 1
    while length < limit and not waiting.isEmpty():
        ahead = waiting.select(F.col("id").alias("_id"), F.col("to").alias("_to"), F.col("trail").alias("_trail"))
        for done in closed:
            ahead = ahead.unionByName(
                done.select(F.col("id").alias("_id"), F.lit(None).cast("bigint").alias("_to"), F.col("trail").alias("_trail"))
            )
        stepped = settle(
            waiting.join(ahead, F.col("to") == F.col("_id")).select(
                "id", F.col("_to").alias("to"), F.slice(F.concat("trail", "_trail"), 1, limit).alias("trail")
            ),
            "trails",
        )
        closed.append(stepped.where(F.col("to").isNull()).select("id", "trail"))
        waiting = stepped.where(F.col("to").isNotNull())
        length *= 2
    found = waiting.select("id", "trail")
    for done in closed:
        found = found.unionByName(done)
    return found


def _walk(edges: Edges, max_distance: int) -> DataFrame:
    """The ancestor walk one level at a time, for children with several parents."""
    spark = edges.df.sparkSession
    marked = settle(_onward(edges.pairs()), "edges")
    steps = marked.where(F.col("parent") != F.col("id")).select(
        F.col("id").alias("_at"), F.col("parent").alias("_to"), F.col("onward").alias("_onward")
    )
    folder = new_run_folder(spark, "ancestors")
    level = marked.select(
        "id", F.col("parent").alias("ancestor"), F.col("id").cast("string").alias("path"), F.lit(0).alias("distance"), "onward"
    )
    schema = level.schema
    for distance in range(max_distance + 1):
        level.write.parquet(f"{folder}/level={distance}")
        written = spark.read.schema(schema).parquet(f"{folder}/level={distance}")
        frontier = written.where(F.col("onward") & (F.col("ancestor") != F.col("id")))
        if distance == max_distance or frontier.isEmpty():
            break
        level = frontier.join(steps, F.col("ancestor") == F.col("_at")).select(
            "id",
            F.col("_to").alias("ancestor"),
            F.concat("path", F.lit(" > "), F.col("_at").cast("string")).alias("path"),
            (F.col("distance") + 1).alias("distance"),
            F.col("_onward").alias("onward"),
        )
    return spark.read.schema(schema).parquet(f"{folder}/level=*").drop("onward")


def _cycles(edges: Edges, max_length: int | None) -> tuple[DataFrame, DataFrame]:
    """Cycle members, and all nodes that lead into a cycle or lie on one. One parent per child.

    ``to`` is where a row's chain leads, twice as far in every round, and ``low`` the smallest
    node on the way. Chains that end drop out of the join. Following the others far enough
    always lands on a cycle, so the nodes landed on, once their number stops shrinking, are
    exactly the cycle members. Each cycle is named by its smallest node; with a ``max_length``,
    longer cycles are left out.
    """
    # A parent that is no row here ends the chain: it is unknown, has no parent or is its own.
    first = edges.pairs().where(F.col("parent") != F.col("id"))
    rows = settle(first.select("id", F.col("parent").alias("to"), F.col("id").alias("low")), "chains")
    count, landed = rows.count(), None
    while count > 0:
        ahead = rows.select(F.col("id").alias("_id"), F.col("to").alias("_to"), F.col("low").alias("_low"))
        stepped = settle(
            rows.join(_shuffled(ahead), F.col("to") == F.col("_id")).select(
                "id",
                F.col("_to").alias("to"),
                F.least("low", "_low").alias("low"),
                (F.col("_low") < F.col("low")).alias("moved"),
            ),
            "chains",
        )
        left, moved = stepped.agg(F.count(F.lit(1)), F.count_if("moved")).first()
        rows = stepped.drop("moved")
        # Shorter chains would have ended before longer ones, so without an end in one round
        # none comes later; the same holds for smaller nodes still to be met.
        if left == count and moved == 0:
            ends = rows.agg(F.count_distinct("to")).first()[0]
            if ends in (landed, left):
                break
            landed = ends
        count = left
    on_cycle = rows.join(_shuffled(rows.select(F.col("to").alias("id")).distinct()), "id", "left_semi").select("id", "low")
    if max_length is not None:
        lengths = on_cycle.groupBy("low").agg(F.count(F.lit(1)).alias("n"))
        on_cycle = on_cycle.join(_shuffled(lengths.where(F.col("n") <= max_length)), "low", "left_semi")
    members = settle(on_cycle.select("id"), "cycles")
    leading = rows.join(_shuffled(members.select(F.col("id").alias("to"))), "to", "left_semi").select("id")
    return members, leading


def _steps(edges: Edges) -> DataFrame:
    """The distinct steps from a node to another that is a row too."""
    first = edges.pairs().where(F.col("parent") != F.col("id")).distinct()
    return settle(first.join(_shuffled(first.select(F.col("id").alias("parent")).distinct()), "parent", "left_semi"), "steps")


def _ends(steps: DataFrame) -> DataFrame:
    return steps.select("id").union(steps.select("parent")).distinct()


def _lowest_above(nodes: DataFrame, steps: DataFrame, deal: int = 0) -> DataFrame:
    """For each of ``nodes`` the lowest value of every column but ``id``, of itself and all it reaches by
    ``steps`` (id to parent).

    Each round a node takes the lowest of what it knows, what its parents know, and what the nodes it has
    shortcuts to know. A round adds a shortcut along one parent of each node, twice as long as the one
    before: rounds grow with the logarithm of the way's length, and so do shortcuts.
    """
    lows = [c for c in nodes.columns if c != "id"]
    far, ways, length, count = None, [steps], 1, nodes.count()
    state = settle(nodes, "lowest")
    while True:
        known = state.select(F.col("id").alias("_id"), *(F.col(low).alias(f"_{low}") for low in lows))
        every = reduce(DataFrame.unionByName, (way.select("id", "parent") for way in ways))
        up = every.join(_shuffled(known), F.col("parent") == F.col("_id")).groupBy("id").agg(*(F.min(f"_{low}").alias(f"_{low}") for low in lows))
        met = state.select("id", *lows).join(_shuffled(up), "id", "left")
        best = [F.least(low, f"_{low}") for low in lows]
        moved = reduce(Column.__or__, (b != F.col(low) for b, low in zip(best, lows, strict=True)))
        before, state = state, settle(met.select("id", *(b.alias(low) for b, low in zip(best, lows, strict=True)), moved.alias("moved")), "lowest")
        free(before)
        # Where no step brings a node anything lower, shortcuts, which are made of steps, bring nothing either.
        if state.where("moved").isEmpty():
            free(*ways[1:])
            return state.drop("moved")
        if length < count:
            if far is None:
                far = settle(_one_parent(steps, F.xxhash64("parent", F.lit(deal))), "shortcuts")
            onward = far.select(F.col("id").alias("_at"), F.col("parent").alias("_to"))
            before, far = far, settle(far.join(_shuffled(onward), F.col("parent") == F.col("_at")).select("id", F.col("_to").alias("parent")), "shortcuts")
            if length == 1:
                free(before)
            ways.append(far)
            length = count if far.isEmpty() else 2 * length


def _one_parent(steps: DataFrame, *order: Column) -> DataFrame:
    """The first step of each node, in some order of its parents."""
    keys = [c.alias(f"_by{i}") for i, c in enumerate(order)]
    first = steps.groupBy("id").agg(F.min(F.struct(*keys, "parent")).alias("_first"))
    return first.select("id", F.col("_first.parent").alias("parent"))


def _followed(chains: DataFrame) -> DataFrame:
    """Where chains of one parent per node lead: (id, to, low, length, ended).

    A chain that has ended does so in ``to``, ``length`` steps away. The others go round in a cycle that
    ``to`` lies on, and the ``low`` of a node on a cycle is the smallest node of it. As in ``_cycles``, what
    a row knows reaches twice as far in every round, and rows whose chain has ended take no further part.
    """
    columns = ["id", "to", "low", "length", "ended"]
    begun = chains.select("id", F.col("parent").alias("to"), F.col("id").alias("low"), F.lit(1).cast("bigint").alias("length"), F.lit(False).alias("ended"))
    rows = settle(begun, "chains")
    count, landed = rows.count(), None
    while count > 0:
        ahead = rows.select(*(F.col(c).alias(f"_{c}") for c in columns))
        stepped = rows.where(~F.col("ended")).join(_shuffled(ahead), F.col("to") == F.col("_id"), "left")
        # A parent that has no step ends the chain.
        stepped = stepped.select(
            "id",
            F.coalesce("_to", "to").alias("to"),
            F.least("low", "_low").alias("low"),
            (F.col("length") + F.coalesce("_length", F.lit(0))).alias("length"),
            F.coalesce("_ended", F.lit(True)).alias("ended"),
            (~F.col("_ended") & (F.col("_low") < F.col("low"))).alias("moved"),
        )
        arrived = rows.where("ended").select(*columns, F.lit(False).alias("moved"))
        before, rows = rows, settle(stepped.unionByName(arrived), "chains")
        free(before)
        left, moved = rows.agg(F.count_if(~F.col("ended")), F.count_if("moved")).first()
        # The same tests as in ``_cycles``.
        if left == count and moved == 0:
            ends = rows.where(~F.col("ended")).agg(F.count_distinct("to")).first()[0]
            if ends in (landed, left):
                break
            landed = ends
        count = left
    return rows


def _unresolved(edges: Edges, members: DataFrame | None) -> DataFrame:
    """Nodes on a cycle, and those from which some way up leads into one. Several parents per child."""
    members = settle(_on_cycles(edges) if members is None else members.select("id"), "cycles")
    if members.isEmpty():
        return members
    steps = _steps(edges)
    known = members.select(F.col("id").alias("_member")).distinct()
    # Nobody needs to know where the members lead. Of the others one way is followed first, which leaves few to ask.
    others = steps.join(_shuffled(known), F.col("id") == F.col("_member"), "left_anti")
    others = others.join(_shuffled(known), F.col("parent") == F.col("_member"), "left")
    others = settle(others.select("id", "parent", F.col("_member").isNull().alias("outside")), "steps")
    led = _followed(_one_parent(others, F.col("outside"), F.xxhash64("parent"))).where("ended")
    led = led.join(_shuffled(known), F.col("to") == F.col("_member"), "left_semi").select(F.col("id").alias("_member"))
    known = settle(known.unionByName(led), "cycles")
    undecided = settle(others.select("id", "parent").join(_shuffled(known), F.col("id") == F.col("_member"), "left_anti"), "steps")
    near = undecided.join(_shuffled(known), F.col("parent") == F.col("_member"), "left_semi")
    near = settle(near.select(F.col("id").alias("_near")).distinct(), "cycles")
    resolved = known.select(F.col("_member").alias("id"))
    if near.isEmpty():
        return resolved
    nodes = undecided.select("id").distinct().join(_shuffled(near), F.col("id") == F.col("_near"), "left")
    asking = settle(undecided.join(_shuffled(near), F.col("id") == F.col("_near"), "left_anti"), "steps")
    lowest = _lowest_above(nodes.select("id", F.col("_near").isNull().alias("free")), asking)
    return resolved.unionByName(lowest.where(~F.col("free")).select("id"))


def _peeled(steps: DataFrame) -> DataFrame:
    """Steps without those at the rims, which no cycle can hold: from nodes nothing leads to, or to nodes that
    lead nowhere. Layer by layer, while a layer is a fourth of what is left: enough for a shallow hierarchy."""
    count = steps.count()
    while count > 0:
        inner = steps.join(_shuffled(steps.select(F.col("id").alias("parent")).distinct()), "parent", "left_semi")
        inner = settle(inner.join(_shuffled(steps.select(F.col("parent").alias("id")).distinct()), "id", "left_semi"), "steps")
        free(steps)
        steps, before, count = inner, count, inner.count()
        if 4 * (before - count) < before:
            break
    return steps


def _renamed(steps: DataFrame, names: DataFrame) -> DataFrame:
    """Steps between nodes by their ``name``, where they have one, without those that lead nowhere else."""
    of_parent = names.select(F.col("id").alias("parent"), F.col("name").alias("_name"))
    joined = steps.join(_shuffled(names.select("id", "name")), "id", "left").join(_shuffled(of_parent), "parent", "left")
    joined = joined.select(F.coalesce("name", "id").alias("id"), F.coalesce("_name", "parent").alias("parent"))
    return settle(joined.where("id <> parent").distinct(), "steps")


def _contracted(left: DataFrame, deal: int) -> tuple[DataFrame, list[DataFrame]]:
    """Steps that may still lie on a cycle, and members of cycles found on the way.

    From every node one parent is followed, drawn by lot. Chains that go round are cycles, and each becomes one
    node, named by one of its members. Chains that end have a length, and the nodes of a cycle have the same
    greatest length above them: a step between nodes that differ in it lies on no cycle. Along a ladder, however
    long, lengths fall nearly everywhere, so only short stretches of it are left. Nodes that are each other's
    parents become one last.
    """
    chains = _followed(_one_parent(left, F.xxhash64("parent", F.lit(deal))))
    going = chains.where(~F.col("ended"))
    rings = settle(going.join(_shuffled(going.select(F.col("to").alias("id")).distinct()), "id", "left_semi").select("id", F.col("low").alias("name")), "cycles")
    # Low is long here. A chain that goes round is longer than any.
    height = F.when(F.col("ended"), -F.col("length")).otherwise(F.lit(-(2**62)))
    ended = chains.where("ended").select(F.col("id").alias("_ended"))
    nodes = chains.select("id", height.alias("height"))
    asking = settle(left.join(_shuffled(ended), F.col("id") == F.col("_ended"), "left_semi"), "steps")
    heights = _lowest_above(nodes, asking, deal)
    of_parent = heights.select(F.col("id").alias("parent"), F.col("height").alias("_height"))
    level = left.join(_shuffled(heights), "id").join(_shuffled(of_parent), "parent").where("height = _height")
    found, level = [rings.select("id")], settle(level.select("id", "parent"), "steps")
    free(left, chains, asking)
    if not rings.isEmpty():
        level = _renamed(level, rings)

    count = level.count()
    while count > 0:
        turned = level.select(F.col("parent").alias("id"), F.col("id").alias("parent"))
        pairs = settle(level.join(_shuffled(turned), ["id", "parent"], "left_semi"), "cycles")
        if pairs.isEmpty():
            break
        by_lot = F.struct(F.xxhash64("parent", F.lit(deal)), F.col("parent"))
        lowest = pairs.groupBy("id").agg(F.min(by_lot).alias("_lowest"))
        itself = F.struct(F.xxhash64("id", F.lit(deal)), F.col("id"))
        names = settle(lowest.select("id", F.when(F.col("_lowest") < itself, F.col("_lowest.parent")).otherwise(F.col("id")).alias("name")), "cycles")
        found.append(names.select("id"))
        before, level = level, _renamed(level, names)
        free(before, pairs)
        before, count = count, level.count()
        if 2 * count > before:
            break
    return level, found


#: Ranks by which steps are cut at once: more of them cut ways that lie on no cycle into shorter pieces.
RANKS = 8


def _coloured(left: DataFrame, deal: int) -> tuple[DataFrame, DataFrame]:
    """Steps that may still lie on a cycle, and members of cycles found on the way.

    The nodes of a strongly connected part have the same lowest node above and, within the steps between
    such nodes, the same lowest node below. Where these two are one, its part is found; all other steps
    between nodes that differ in either, by any of several ranks, lie on no cycle and go.
    """
    # A rank is a hash that no two ids share, so it stands for its node and tells nothing about the way to it.
    lows = [f"low_{i}" for i in range(RANKS)]
    ranks = [F.xxhash64("id", F.lit(deal), F.lit(i)).alias(low) for i, low in enumerate(lows)]
    # Equal hashes of the lowest nodes by all ranks stand for the nodes themselves.
    above = _lowest_above(_ends(left).select("id", *ranks), left, deal)
    above = settle(above.select("id", F.xxhash64(*lows).alias("colour"), F.col("low_0").alias("top")), "above")
    of_parent = above.select(F.col("id").alias("parent"), F.col("colour").alias("_colour"))
    inside = left.join(_shuffled(above.select("id", "colour")), "id").join(_shuffled(of_parent), "parent").where("colour = _colour")
    inside = settle(inside.select("id", "parent"), "steps")
    turned = inside.select(F.col("parent").alias("id"), F.col("id").alias("parent"))
    below = _lowest_above(_ends(inside).select("id", *ranks), turned, deal)
    marks = below.select("id", F.xxhash64(*lows).alias("mark"), F.col("low_0").alias("bottom"))
    marked = settle(marks.join(_shuffled(above.select("id", "top")), "id"), "parts")
    part = marked.where("top = bottom")
    several = part.groupBy("top").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = settle(part.join(_shuffled(several), "top", "left_semi").select("id"), "cycles")
    other = marked.where("top <> bottom").select("id", "mark")
    of_parent = other.select(F.col("id").alias("parent"), F.col("mark").alias("_mark"))
    rest = inside.join(_shuffled(other), "id").join(_shuffled(of_parent), "parent")
    before, left = left, settle(rest.where("mark = _mark").select("id", "parent"), "steps")
    free(before, above, inside, marked)
    return left, found


def _on_cycles(edges: Edges) -> DataFrame:
    """Members of cycles where children may have several parents, however long the cycles are.

    Each pass peels, follows chains and makes one node of every cycle it meets; what does not shrink so is
    parted by lowest nodes. Lots are drawn anew in every pass, so what is on no cycle falls apart in a number
    of passes that grows with the logarithm.
    """
    left = _steps(edges)
    parts = [left.select("id").where(F.lit(False))]
    count, deal = left.count(), 0
    while count > 0:
        left = _peeled(left)
        if left.isEmpty():
            break
        left, found = _contracted(left, deal)
        parts += found
        before, count = count, left.count()
        if 2 * count > before:
            left, members = _coloured(left, deal)
            parts.append(members)
            count = left.count()
        deal += 1
    return settle(reduce(DataFrame.unionByName, parts).distinct(), "cycles")


def circular(edges: Edges, max_distance: int | None = None, root: int = ROOT) -> DataFrame:
    """Members of cycles; a row that is its own parent is none.

    With ``max_distance``, only of cycles of up to ``max_distance + 1`` nodes, which takes the whole
    walk where children have several parents.
    """
    if not has_repeated_children(edges):
        found = _cycles(edges, None if max_distance is None else max_distance + 1)[0]
    elif max_distance is None:
        found = _on_cycles(edges)
    else:
        walks = ancestors(edges, max_distance)
        found = walks.where((F.col("id") == F.col("ancestor")) & (F.col("distance") > 0)).select("id").distinct()
    return found.where(F.col("id") != root)


def nested(edges: Edges, members: DataFrame) -> DataFrame:
    """Nodes below a cycle member that are no members themselves."""
    return (
        edges.pairs()
        .join(members.select(F.col("id").alias("parent")), "parent", "left_semi")
        .join(members, "id", "left_anti")
        .select("id", "parent")
    )


def _reached_once(reached: DataFrame, several: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the nodes a level reaches, those that no earlier level has, and what was seen by now.

    Only nodes with several parents can be reached again, so only those are remembered; the rest of
    what was found is not read again.
    """
    again = reached.join(several, "id", "left_semi").join(seen, "id", "left_anti")
    new = settle(reached.join(several, "id", "left_anti").withColumn("again", F.lit(False)).unionByName(again.withColumn("again", F.lit(True))), "level")
    before, seen = seen, settle(seen.unionByName(new.where("again").select("id")), "seen")
    free(before)
    return new.select("id"), seen


def descendants(edges: Edges, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Nodes below ``roots`` with their level, the roots being level 1.

    Each row of the hierarchy is given once, at the first level that reaches it, so a cycle ends
    the descent. With ``max_depth``, a deeper descent fails.
    """
    spark = edges.df.sparkSession
    pairs = settle(edges.pairs(), "edges")
    named = settle(roots.select("id").distinct(), "roots")
    level = pairs.join(named, "id", "left_semi").select(F.lit(1).alias("level"), "id", "parent")
    schema = level.schema
    # Rows of the roots are level 1 and no other; all others come when their parent first does.
    pairs = settle(pairs.join(named, "id", "left_anti"), "edges")
    several = settle(pairs.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "several")
    seen = settle(several.where(F.lit(False)), "seen")
    folder = new_run_folder(spark, "descendants")
    number = 1
    while True:
        level.write.parquet(f"{folder}/step={number}")
        written = spark.read.schema(schema).parquet(f"{folder}/step={number}")
        if written.isEmpty():
            return spark.read.schema(schema).parquet(f"{folder}/step=*")
        if max_depth is not None and number > max_depth:
            raise RecursionError(f"more than {max_depth} levels below the given nodes")
        found, seen = _reached_once(written.select("id").distinct(), several, seen)
        number += 1
        level = pairs.join(found.withColumnRenamed("id", "parent"), "parent").select(F.lit(number).alias("level"), "id", "parent")


@dataclass(frozen=True)
class Quarantined:
    clean: DataFrame
    exceptions: DataFrame


def quarantine(
    edges: Edges, execution_id: int, max_distance: int | None = None, members: DataFrame | None = None
) -> Quarantined:
    """Split off cycles and everything below them; with ``max_distance``, as ``circular`` finds them.

    ``members`` are those of all cycles, where they are known already and children have several parents.
    """
    if not has_repeated_children(edges):
        removed = _cycles(edges, None if max_distance is None else max_distance + 1)[1]
    elif max_distance is None:
        removed = _unresolved(edges, members)
    else:
        members = settle(circular(edges, max_distance), "cycles")
        hanging = settle(nested(edges, members), "cycles")
        removed = members.unionByName(descendants(edges, hanging).select("id")).distinct()
    removed = _shuffled(settle(removed.select(F.col("id").alias("_removed")), "quarantine"))
    match = F.col(edges.id) == F.col("_removed")
    out = edges.df.join(removed, match, "left_semi").withColumns(
        {
            "ServerExecutionID": F.lit(execution_id).cast("bigint"),
            ERROR_CODE: F.lit(0),
            ERROR_COLUMN: F.lit(0),
            ERROR_DESCRIPTION: F.lit(CIRCULAR),
        }
    )
    return Quarantined(edges.df.join(removed, match, "left_anti"), out)


def sibling_number(edges: Edges, out: str = "Num", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number the children of each parent by id. A parent with very many children is split."""
    return numbered(edges.df, [edges.parent], [edges.id], out, hot_rows)


def paths(edges: Edges, root: int = ROOT, smallest: bool = False) -> DataFrame:
    """The way from the root to every node it reaches: ``id``, ``path`` text, ``trail`` of ids.

    The root's path is ``/``. Unreachable nodes get none, whether they hang off a cycle, off
    an unknown parent or off a row that is its own parent. A child with two parents fails the
    plan, unless ``smallest`` asks for the smallest of its shortest paths.
    """
    if smallest:
        return _smallest_paths(edges, root)
    pairs = edges.pairs()
    counted = pairs.groupBy("id").agg(F.min("parent").alias("parent"), F.max("parent").alias("other"))
    one_parent = F.col("parent").eqNullSafe(F.col("other"))
    single = settle(require(counted, one_parent, "a child has two parents").drop("other"), "paths")
    top = single.where(F.col("id") == root).select("id", F.array().cast("array<bigint>").alias("trail"))
    if top.isEmpty():
        return _path_text(top)

    below = single.where((F.col("id") != root) & (F.col("parent") != F.col("id")))
    # trail: from the node itself upwards, the node first and `to` not yet in it.
    chains = below.select("id", F.col("parent").alias("to"), F.array("id").alias("trail"))
    arrived = [top, chains.where(F.col("to") == root).select("id", "trail")]
    waiting = chains.where(F.col("to") != root)
    left = None
    while left != 0:
        ahead = waiting.select(F.col("id").alias("_id"), F.col("to").alias("_to"), F.col("trail").alias("_trail"))
        for done in arrived[1:]:
            ahead = ahead.unionByName(
                done.select(F.col("id").alias("_id"), F.lit(root).cast("bigint").alias("_to"), F.col("trail").alias("_trail"))
            )
        stepped = settle(
            waiting.join(ahead, F.col("to") == F.col("_id")).select(
                "id", F.col("_to").alias("to"), F.concat("trail", "_trail").alias("trail")
            ),
            "paths",
        )
        new, left = stepped.agg(F.count_if(F.col("to") == root), F.count_if(F.col("to") != root)).first()
        # Whoever is deeper than this round reached has an ancestor that arrived in it: with no
        # arrival the rest only leads into cycles.
        if new == 0:
            break
        arrived.append(stepped.where(F.col("to") == root).select("id", "trail"))
        waiting = stepped.where(F.col("to") != root)
    reached = arrived[0]
    for part in arrived[1:]:
        reached = reached.unionByName(part.select("id", F.reverse("trail").alias("trail")))
    return _path_text(reached)


def _path_text(reached: DataFrame) -> DataFrame:
    steps = F.transform("trail", lambda step: F.concat(step.cast("string"), F.lit("/")))
    return reached.select("id", F.concat(F.lit("/"), F.array_join(steps, "")).alias("path"), "trail")


def _smallest_paths(edges: Edges, root: int) -> DataFrame:
    """Level by level from the root; a node keeps the smallest of its shortest trails."""
    spark = edges.df.sparkSession
    pairs = edges.pairs()
    level = pairs.where(F.col("id") == root).select("id", F.array().cast("array<bigint>").alias("trail")).distinct()
    schema = level.schema
    pairs = settle(pairs.where(F.col("id") != root).distinct(), "edges")
    several = settle(pairs.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "several")
    seen = settle(several.where(F.lit(False)), "seen")
    folder = new_run_folder(spark, "paths")
    number = 0
    while True:
        level.write.parquet(f"{folder}/step={number}")
        written = spark.read.schema(schema).parquet(f"{folder}/step={number}")
        if written.isEmpty():
            return _path_text(spark.read.schema(schema).parquet(f"{folder}/step=*"))
        reached = pairs.join(written.select(F.col("id").alias("parent")), "parent").select("id").distinct()
        found, seen = _reached_once(reached, several, seen)
        new = pairs.join(found, "id", "left_semi").join(
            written.select(F.col("id").alias("parent"), F.col("trail").alias("_trail")), "parent"
        )
        level = new.groupBy("id").agg(F.min(F.concat("_trail", F.array("id"))).alias("trail"))
        number += 1


def update_if_changed(table: DataFrame, found: DataFrame, id_column: str, path_column: str) -> DataFrame:
    """Set each row's path to what was found, NULL if nothing was; ``changed`` tells which differ."""
    new = found.select(F.col("id").alias("_id"), F.col("path").alias("_new"))
    joined = table.join(new, F.col(id_column) == F.col("_id"), "left")
    changed: Column = ~F.col(path_column).eqNullSafe(F.col("_new"))
    return joined.withColumn("changed", changed).select(
        *(F.when(F.col("changed"), F.col("_new")).otherwise(F.col(c)).alias(c) if c == path_column else F.col(c) for c in table.columns),
        "changed",
    )


def clear_resolved(exceptions: DataFrame, table: DataFrame, id_column: str, path_column: str) -> DataFrame:
    """Drop cycle exceptions of nodes that have a path by now."""
    resolved = table.where(F.col(path_column).isNotNull()).select(F.col(id_column).alias("_id"))
    gone = (F.col(id_column) == F.col("_id")) & true(F.col(ERROR_DESCRIPTION) == CIRCULAR)
    return exceptions.join(resolved, gone, "left_anti")
