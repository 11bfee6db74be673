"""Document fingerprints: SimHash of weighted terms, and a search of them by permuted blocks.

Terms are runs of three words (letters and digits, lower-cased; a shorter text is one term), each
weighted by how often the text has it. A term's hash votes with that weight for each of 64 bits;
bits that more than half of the weight wants are set. A text without words has the fingerprint
zero. The angle between two texts' term vectors is read from the bits that differ, and likeness is
its cosine, 0 where it would be negative.

The votes of bits j and j + 32 are added in one long, so a text's votes are 32 sums; they are exact
up to 2^31 terms a text. Everything runs as DataFrame expressions.

Null texts are empty, very long ones are read whole. Rows that repeat a key with one text collapse
before the votes and come back as often; where a key has several texts, the next document's text is
its smallest text and its fingerprint its smallest one. Null keys go before all others. An empty
table gives an empty one. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import settle
from tidemark.llm.common import only

BITS = 64
TERM_WORDS = 3
#: Differing bits within which fingerprints count as near, and the blocks whose permutations find them.
NEAR = 3
NEAR_BLOCKS = 6


def term_hashes(words: Column, size: int = TERM_WORDS) -> Column:
    """Hashes of all runs of ``size`` words, from the hashes of the words."""
    count = F.size(words)
    runs = F.slice(words, F.lit(1), F.greatest(count - (size - 1), F.lit(0)))
    for shift in range(1, size):
        runs = F.zip_with(
            runs, F.slice(words, F.lit(1 + shift), F.greatest(count - (size - 1), F.lit(0))), lambda x, y: F.xxhash64(x, y)
        )
    short = F.array(F.aggregate(words, F.lit(0).cast("long"), lambda held, x: F.xxhash64(held, x)))
    return F.when(count >= size, runs).when(count > 0, short).otherwise(F.array().cast("array<bigint>"))


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _votes() -> list[Column]:
    mask = F.lit((1 << 32) | 1)
    return [F.sum(F.shiftrightunsigned("term", j).bitwiseAND(mask)).alias(f"v{j}") for j in range(32)]


def _majority() -> Column:
    """The fingerprint as a long, from the sums and the whole weight ``weight``."""
    out = F.lit(0).cast("long")
    for j in range(32):
        low = F.col(f"v{j}").bitwiseAND(F.lit((1 << 32) - 1))
        high = F.shiftrightunsigned(f"v{j}", 32)
        for bit, vote in ((j, low), (j + 32, high)):
            one = 1 << bit if bit < 63 else -(1 << 63)
            out = out.bitwiseOR(F.when(vote * 2 > F.col("weight"), F.lit(one)).otherwise(F.lit(0).cast("long")))
    return out


def votes_of(terms: DataFrame, *keys: str) -> DataFrame:
    """(keys, bits) from one row (keys, term) per term; a null term marks a text and has no vote."""
    summed = terms.groupBy(*keys).agg(F.count("term").alias("weight"), *_votes())
    filled = summed.fillna(0, [f"v{j}" for j in range(32)])
    return filled.select(*keys, _majority().alias("bits"))


def likeness(a: Column, b: Column) -> Column:
    """The cosine of the angle that the differing bits of two fingerprints speak for, at least 0."""
    differing = F.bit_count(a.bitwiseXOR(b))
    return F.greatest(F.lit(0.0), F.round(F.cos(differing * F.lit(3.141592653589793 / BITS)), 12))


def as_text(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def next_keys(keys: DataFrame) -> DataFrame:
    """(key, next) for distinct keys in ascending order; the first follows the last.

    Keys are dealt out in ranges, each range is a window of its own, and the ranges are chained
    by their first keys, of which there are no more than partitions.
    """
    ranged = keys.repartitionByRange("key").withColumn("range", F.spark_partition_id())
    ranged = settle(ranged, "ranges")
    firsts = ranged.groupBy("range").agg(F.min_by("key", F.struct(F.col("key").isNotNull(), "key")).alias("first"))
    chain = Window.orderBy("range")
    every = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chained = firsts.select(
        F.col("range").alias("of_range"),
        F.coalesce(F.lead("first").over(chain), F.first("first").over(every)).alias("after"),
    )
    inside = Window.partitionBy("range").orderBy(F.col("key").asc_nulls_first())
    last = F.lead(F.lit(1)).over(inside).isNull()
    found = ranged.select("key", "range", F.lead("key").over(inside).alias("lead"), last.alias("last"))
    return found.join(chained, F.col("range") == F.col("of_range")).select(
        "key", F.when(F.col("last"), F.col("after")).otherwise(F.col("lead")).alias("next")
    )


def fingerprint_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of whole texts, one row for each distinct text of a key."""
    rows = only(docs, key=key, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    hashed = rows.select("key", F.xxhash64("text").alias("text_hash"), word_hashes(F.col("text")).alias("words"))
    hashed = hashed.select("key", "text_hash", term_hashes(F.col("words")).alias("terms"))
    exploded = hashed.select("key", "text_hash", F.explode_outer("terms").alias("term"))
    return votes_of(exploded, "key", "text_hash").select(F.col("key").alias(key), as_text(F.col("bits")).alias("fingerprint"))


def fingerprints_and_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of texts, of their edited texts, and how alike both and the next document's are.

    The edited text has its last quarter (rounded down) replaced by as much of the next document.
    ``n_near`` is the number of other fingerprints in the table within ``NEAR`` bits of a row's own.
    """
    rows = only(docs, key=key, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    quarter = F.expr("cast(length(text) div 4 as int)")
    # What each key wants of the next document; keys and lengths alone.
    wants = rows.groupBy("key").agg(F.max(quarter).alias("most"))
    following = settle(next_keys(wants.select("key")).join(
        wants.withColumnRenamed("key", "own"), F.col("key").eqNullSafe(F.col("own"))
    ).select(F.col("key").alias("asker"), "next", "most"), "following")

    heads = (
        rows.join(following, F.col("key").eqNullSafe(F.col("next")))
        .groupBy("asker")
        .agg(F.min(F.left(F.col("text"), F.col("most"))).alias("head"))
    )
    edited = F.concat(F.left(F.col("text"), F.length("text") - quarter), F.left(F.col("head"), quarter))
    # Both joins take the same rows by the same key, so the texts are shuffled once.
    both = rows.join(heads, F.col("key").eqNullSafe(F.col("asker"))).select("key", "text", edited.alias("edited"))
    # Texts are split into words once each. Only numbers go on: the digest as four longs.
    digest = F.sha2(F.col("edited").cast("binary"), 256)
    hashed = both.select(
        "key",
        F.xxhash64("text").alias("text_hash"),
        F.length("text").cast("long").alias("n"),
        *(F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("long").alias(f"d{i}") for i in range(4)),
        word_hashes(F.col("text")).alias("words"),
        word_hashes(F.col("edited")).alias("edited_words"),
    )
    # The number of terms follows from the number of words.
    count = F.size("words")
    terms = hashed.select(
        "key", "text_hash", "n", "d0", "d1", "d2", "d3",
        F.when(count > 0, F.greatest(count - (TERM_WORDS - 1), F.lit(1))).otherwise(0).alias("own_terms"),
        F.concat(term_hashes(F.col("words")), term_hashes(F.col("edited_words"))).alias("terms"),
    )
    # Outer: a plain one would have Spark test for terms first, below the join and pair by pair.
    facts = ["n", "d0", "d1", "d2", "d3"]
    exploded = terms.select("key", "text_hash", *facts, "own_terms", F.posexplode_outer("terms").alias("at", "term"))
    is_edited = F.coalesce(F.col("at") >= F.col("own_terms"), F.lit(True))
    marked = exploded.select("key", "text_hash", *facts, is_edited.alias("is_edited"), F.coalesce("at", F.lit(0)).alias("at"), "term")
    summed = marked.groupBy("key", "text_hash", "is_edited").agg(
        F.count_if(F.col("at") == 0).alias("times"),
        F.count("term").alias("weight"),
        *(F.max(c).alias(c) for c in facts),
        *_votes(),
    )
    summed = summed.fillna(0, [f"v{j}" for j in range(32)])
    prints = summed.select("key", "text_hash", *facts, "is_edited", "times", _majority().alias("bits"))

    def of(edited_text: bool) -> Column:
        return F.coalesce(F.max(F.when(F.col("is_edited") == edited_text, F.col("bits"))), F.lit(0).cast("long"))

    found = settle(
        prints.groupBy("key", "text_hash").agg(
            F.sum("times").alias("rows"),
            of(False).alias("bits"),
            of(True).alias("edited_bits"),
            *(F.max(c).alias(c) for c in facts),
        ),
        "prints",
    )
    first = found.groupBy("key").agg(F.min_by("bits", as_text(F.col("bits"))).alias("bits"))
    after = following.join(first, F.col("next").eqNullSafe(F.col("key"))).select("asker", F.col("bits").alias("next_bits"))
    joined = found.join(after, F.col("key").eqNullSafe(F.col("asker")))
    near = settle(count_near(found.select("bits")), "near").withColumnRenamed("bits", "of_bits")
    joined = joined.join(near, F.col("bits") == F.col("of_bits"), "left")
    repeated = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return repeated.select(
        F.col("key").alias(key),
        F.col("n").alias("n_chars"),
        F.concat(*(as_text(F.col(f"d{i}")) for i in range(4))).alias("edited_sha256"),
        as_text(F.col("bits")).alias("fingerprint"),
        as_text(F.col("edited_bits")).alias("edited_fingerprint"),
        likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"),
        likeness(F.col("bits"), F.col("next_bits")).alias("near_next"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
    )


# Search by permuted blocks


def block_keys(bits: Column, radius: int, blocks: int) -> Column:
    """An array of (table, prefix): for each choice of ``blocks - radius`` blocks, these blocks.

    Fingerprints that differ in ``radius`` bits or fewer agree in at least that many whole blocks,
    so they meet in one table at least.
    """
    if not radius < blocks <= BITS:
        raise ValueError("more blocks than differing bits are needed")
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    tables = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        mask = mask if mask < 1 << 63 else mask - (1 << 64)
        tables.append(F.struct(F.lit(number).alias("table"), bits.bitwiseAND(F.lit(mask)).alias("prefix")))
    return F.array(*tables)


def _met(a: DataFrame, b: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(a, b, distance): pairs within the radius, each given by the first table in which it meets."""
    a, b = (df.select(n, F.explode(block_keys(F.col(n), radius, blocks)).alias("key")).select(n, "key.*") for df, n in ((a, "a"), (b, "b")))
    met = a.join(b, ["table", "prefix"]).withColumn("distance", F.bit_count(F.col("a").bitwiseXOR(F.col("b"))))
    agree = F.transform(
        F.arrays_zip(block_keys(F.col("a"), radius, blocks).alias("x"), block_keys(F.col("b"), radius, blocks).alias("y")),
        lambda z: z["x"] == z["y"],
    )
    first = (F.col("distance") <= radius) & (F.array_position(agree, True) == F.col("table") + 1)
    return met.where(first).select("a", "b", "distance")


def count_near(prints: DataFrame, radius: int = NEAR, blocks: int = NEAR_BLOCKS) -> DataFrame:
    """(bits, n_near): for each distinct fingerprint, how many others lie within the radius, if any do.

    The table is searched against itself by permuted blocks. Pairs are counted where they meet and
    never written, so a dense group costs comparisons only; a prefix that very many fingerprints
    share is an ordinary hot key of the join, which adaptive execution splits.
    """
    bits = settle(prints.select("bits").distinct(), "bits")
    met = _met(bits.withColumnRenamed("bits", "a"), bits.withColumnRenamed("bits", "b"), radius, blocks)
    return met.where("distance > 0").groupBy(F.col("a").alias("bits")).agg(F.count("*").alias("n_near"))


def within_radius(
    asked: DataFrame, held: DataFrame, radius: int = NEAR, blocks: int = NEAR_BLOCKS, fingerprint: str = "fingerprint"
) -> DataFrame:
    """(asked, held, distance): all distinct fingerprints of ``held`` near each distinct one asked for.

    Copies are one fingerprint on either side; null ones are passed over. A pair that meets in
    several tables is given by the first of them alone, so nothing has to be made distinct afterwards.
    """
    def bits(df: DataFrame, name: str) -> DataFrame:
        known = only(df, text=fingerprint).where("text is not null").distinct()
        return known.select(F.conv(F.col("text"), 16, -10).cast("long").alias(name))

    met = _met(bits(asked, "a"), bits(held, "b"), radius, blocks)
    return met.select(as_text(F.col("a")).alias("asked"), as_text(F.col("b")).alias("held"), "distance")
