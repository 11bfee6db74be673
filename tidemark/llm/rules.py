"""Quality rules whose thresholds follow from the corpus, per language and source.

A text's words are the runs between ASCII white space. Counted per text: words and their characters,
symbols, lines that repeat an earlier line, and words that lie in runs of eight words which the text
has twice or more. Two rules are fixed: too few words, and too large a share of repeated words. The
others compare rates per thousand words with fences that each group of one language and source sets
for itself: the quartiles of the texts that pass the fixed rules, and ``REACH`` times their distance
(at least a slack, so that a group of like texts does not turn on itself) below and above them.

Quartiles come from sketches: counts of rates whose leading ``DIGITS`` binary digits are alike, so a
quantile is off by less than one part in 2^(DIGITS - 1). Sketches of equal rates add up, so tasks count
before the shuffle, a language's sketch is the sum of its sources' and that of the corpus the sum of
all. A group of fewer than ``LEAST`` texts takes the fences of its language, and that those of the
corpus if it is as small; a corpus without any takes the slack around zero rates alone, which refuses
nothing. Everything runs as DataFrame expressions, in whole numbers.

Null texts have no words and fail. Very long texts are read whole. Null languages and sources are read
as empty ones. Null keys and repeated rows are judged like others, each for itself; equal texts of one
group get equal verdicts. An empty table gives an empty one. Only the named columns are read, so other
columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import free, settle
from tidemark.llm.common import only

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
RUN = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # of a hundred words
DIGITS = 7
REACH = 5
LEAST = 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rate:
    """A count per thousand words, and the least distance of quartiles to reckon with: a fixed slack, or a
    share of the lower quartile where ``slack`` is 0."""

    name: str
    count: str
    slack: int
    low: bool


RATES = (
    Rate("length", "word_chars", 0, True),
    Rate("symbols", "n_symbols", 20, False),
    Rate("dup_lines", "n_dup_lines", 5, False),
    Rate("repeats", "n_repeat_words", 60, False),
)


# What a text counts


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+"))


def _paired(hashes: Column, apart: int) -> Column:
    """A hash of each two elements that lie so far apart."""
    count = F.greatest(F.size(hashes) - apart, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), count), F.slice(hashes, F.lit(1 + apart), count), lambda x, y: F.xxhash64(x, y))


def with_repeated_words(df: DataFrame) -> DataFrame:
    """``df`` with ``n_repeat_words``: how many of its ``words`` lie in runs of eight that it has twice or more.

    Step by step, so that what a step uses several times is a column and not computed again.
    """
    df = df.withColumn("runs", F.transform("words", lambda w: F.xxhash64(w)))
    for apart in (1, 2, 4):
        df = df.withColumn("runs", _paired(F.col("runs"), apart))
    # Runs with their places, equal ones side by side. Most texts repeat no run: to see that takes no sorting.
    again = F.size(F.array_distinct("runs")) < F.size("runs")
    by_run = F.array_sort(F.transform("runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("placed", F.when(again, by_run)).drop("runs")
    pairs = F.zip_with(
        F.slice("placed", F.lit(1), F.size("placed") - 1),
        F.slice("placed", F.lit(2), F.size("placed") - 1),
        lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])),
    )
    places = F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))
    df = df.withColumn("places", F.when(F.col("placed").isNotNull(), places)).drop("placed")
    # Each run covers its eight words, but for those that the next run begins with.
    following = F.concat(F.slice("places", F.lit(2), F.size("places")), F.array(F.lit(1 << 30)))
    covered = F.zip_with("places", following, lambda at, after: F.least(after - at, F.lit(RUN)))
    total = F.aggregate(covered, F.lit(0), lambda held, n: held + n)
    return df.withColumn("n_repeat_words", F.when(F.col("places").isNotNull(), total).otherwise(0)).drop("places")


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(key, lang, source, the counts, base_failed) of every whole text."""
    nothing = F.lit("")
    rows = only(docs, **{"id": key, "text": text, "lang": lang, "source": source})
    rows = rows.withColumns({c: F.coalesce(c, nothing) for c in ("text", "lang", "source")})
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    split = rows.select(
        "id",
        "lang",
        "source",
        words_of(F.col("text")).alias("words"),
        lines.alias("lines"),
        F.length(F.translate("text", SPACE, "")).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
    )
    counted = with_repeated_words(split).select(
        "id",
        "lang",
        "source",
        F.size("words").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        "n_repeat_words",
    )
    counted = counted.withColumns({c: F.col(c).cast("long") for c in COUNTS})
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


# Sketches


def rate(of: Rate) -> Column:
    return F.when(F.col("n_words") > 0, F.expr(f"{of.count} * 1000 div n_words")).otherwise(F.lit(0).cast("long"))


def leading(value: Column) -> Column:
    """A whole number with all but its leading binary digits set to 0."""
    spare = F.greatest(F.length(F.bin(value)) - DIGITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, spare), spare)


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, rate, at, n): of the texts that pass the fixed rules, how many have which rates."""
    each = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rate"), rate(r).alias("value")) for r in RATES))).alias("x")
    rates = measured.where(~F.col("base_failed")).select("lang", "source", each).select("lang", "source", "x.*")
    return rates.groupBy("lang", "source", "rate", leading(F.col("value")).alias("at")).agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    return sketch.groupBy(*keys, "rate", "at").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """(keys, total, and per rate the lower and upper quartile): a sketch has few rows per group and rate."""
    window = Window.partitionBy(*keys, "rate")
    ranked = sketch.withColumns(
        {"upto": F.sum("n").over(window.orderBy("at")), "total": F.sum("n").over(window)}
    )
    found = []
    for r in RATES:
        for part, name in ((1, "q1"), (3, "q3")):
            reached = (F.col("rate") == r.name) & (4 * F.col("upto") >= part * F.col("total"))
            found.append(F.min(F.when(reached, F.col("at"))).alias(f"{r.name}_{name}"))
    return ranked.groupBy(*keys).agg(F.max("total").alias("total"), *found)


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, per rate the least and the largest allowed) for every group of the sketch."""
    limits = [f"{r.name}_{q}" for r in RATES for q in ("q1", "q3")]

    def named(df: DataFrame, level: str) -> DataFrame:
        return df.withColumnsRenamed({"total": f"{level}_total", **{c: f"{level}_{c}" for c in limits}})

    groups = named(quartiles(sketch, "lang", "source"), "own")
    languages = named(quartiles(merged(sketch, "lang"), "lang"), "lang")
    corpus = named(quartiles(merged(sketch.withColumn("of", F.lit(0)), "of"), "of"), "all").withColumnRenamed("of", "of_all")
    joined = groups.join(languages, "lang").withColumn("of", F.lit(0)).join(corpus, F.col("of") == F.col("of_all"))

    def chosen(limit: str) -> Column:
        return (
            F.when(F.col("own_total") >= LEAST, F.col(f"own_{limit}"))
            .when(F.col("lang_total") >= LEAST, F.col(f"lang_{limit}"))
            .otherwise(F.col(f"all_{limit}"))
        )

    out = []
    for r in RATES:
        low, high = chosen(f"{r.name}_q1"), chosen(f"{r.name}_q3")
        slack = F.lit(r.slack) if r.slack else F.call_function("shiftright", low, F.lit(4))
        reach = REACH * F.greatest(high - low, slack)
        out += [(low - reach).alias(f"{r.name}_least"), (high + reach).alias(f"{r.name}_most")]
    return joined.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), *out)


def within(limits: DataFrame, measured: DataFrame) -> DataFrame:
    """``measured`` with ``kept``: what passes the fixed rules and lies within its group's fences."""
    same = (F.col("lang") == F.col("of_lang")) & (F.col("source") == F.col("of_source"))
    fits = ~F.col("base_failed")
    for r in RATES:
        fits = fits & (rate(r) <= F.col(f"{r.name}_most"))
        if r.low:
            fits = fits & (rate(r) >= F.col(f"{r.name}_least"))
    # A group without fences has no text that passes the fixed rules.
    joined = measured.join(limits, same, "left")
    return joined.withColumn("kept", F.coalesce(fits, F.lit(False))).select(*measured.columns, "kept")


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(key, the counts, base_failed, kept) of every row."""
    # Texts are read once; counts and fences are small, and the fences' true size is known to the join.
    measured = settle(measure(docs, key, text, lang, source), "measured")
    sketch = settle(sketches(measured), "sketches")
    limits = settle(fences(sketch), "fences")
    free(sketch)
    return within(limits, measured).select(F.col("id").alias(key), *COUNTS, "base_failed", "kept")


def keep_within(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Whole rows of ``docs`` that the rules keep."""
    renamed = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    place = {name: f"c{docs.columns.index(name)}" for name in (text, lang, source)}
    whole = renamed.withColumn("row", F.struct(*renamed.columns))
    sketch = settle(sketches(measure(whole, place[text], place[text], place[lang], place[source])), "sketches")
    limits = settle(fences(sketch), "fences")
    free(sketch)
    measured = measure(whole, "row", place[text], place[lang], place[source])
    return within(limits, measured).where("kept").select("id.*").toDF(*docs.columns)
