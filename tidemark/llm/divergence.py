"""Source divergence audit: how far the term shares of one source lie from another's, and by which terms.

Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased. Within a language, terms
that stand in ``least_documents`` documents or more are kept. A group's share of a term is
p = 1 + floor(10^9 (count + 2) / (N + 2 V)), where N counts all its kept terms and V is their number in
the language, and two shares diverge by floor((p - q)^2 / (p + q)). All arithmetic is exact.

Each task folds whole documents into stripes: per language a hash of term to document frequency and
counts by source. A task that holds ``STRIPE_ENTRIES`` of these passes them on and begins anew, so its
memory does not grow with the input. Stripes merge by term; a merged stripe holds all that is known of a
term, and emits the divergences between any two sources and from each source to the language. Pairs are
added up by task and then over all; of a source's terms a task passes on those that may be among its
first ``top``.

Null texts, languages and sources are read as empty; very long texts are folded whole. Repeated rows
and null keys count as documents of their own: no key is read. Ties are ordered by the item's bytes. A
source without kept terms has count 0 for all of its language's terms; a language without kept terms
has divergence 0 between its sources and no terms. An empty table gives an empty result. Only the named
columns are read, so others cannot clash. A language's list of sources, by contract paired each with
each, is taken to fit a row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import free, settle
from tidemark.llm.common import offsets_of, only, texts
from tidemark.llm.shipping import ship

#: (term, source) entries that a task holds at most, beside the document it is at; some 150 bytes each.
STRIPE_ENTRIES = 400_000
#: Terms that are compared at once, times the sources of a block.
BLOCK_ENTRIES = 1 << 20
SOURCES = 1024
#: (term, source) entries of merged stripes for a task to compare, 16 bytes each: a task emits each pair
#: of a language's sources, so tasks follow the entries and not the partitions.
TASK_ENTRIES = 1 << 21
ONE = 1_000_000_000


def _plain() -> bytes:
    """Bytes as terms have them: letters in lower case, all others of ASCII as spaces."""
    return bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


_TABLE = _plain()


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TABLE).split()


STRIPES = "lang string, term binary, sources array<string>, counts array<bigint>"


def fold(rows: Iterator[tuple[str, str, str]], most: int = STRIPE_ENTRIES) -> Iterator[list[tuple]]:
    """Stripes (lang, term, sources, counts) of (lang, source, text), passed on whenever ``most`` entries
    are held, and at the end. The source None has the document frequency."""
    held: dict[str, dict[bytes, dict[str | None, int]]] = {}
    size = 0
    for lang, source, text in rows:
        of_lang = held.setdefault(lang, {})
        for term, count in Counter(terms_of(text)).items():
            stripe = of_lang.get(term)
            if stripe is None:
                stripe = of_lang[term] = {None: 0}
            stripe[None] += 1
            if source not in stripe:
                size += 1
                stripe[source] = count
            else:
                stripe[source] += count
        if size >= most:
            yield from _flat(held)
            held, size = {}, 0
    yield from _flat(held)


def _flat(held: dict[str, dict[bytes, dict[str | None, int]]], rows: int = 20_000) -> Iterator[list[tuple]]:
    out = []
    for lang, of_lang in held.items():
        for term, stripe in of_lang.items():
            out.append((lang, term, list(stripe), list(stripe.values())))
            if len(out) == rows:
                yield out
                out = []
    if out:
        yield out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, str]]:
    for batch in batches:
        for begin in range(0, len(batch), 256):
            cut = batch.slice(begin, 256)
            yield from zip(*(texts(cut.column(i)).to_pylist() for i in range(3)), strict=True)


def stripes(docs: DataFrame, text: str, lang: str, source: str, least_documents: int, entries: int = STRIPE_ENTRIES) -> DataFrame:
    """(lang, term, stripe) of the kept terms; a stripe has (source, count) of each source that has the term."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
        for out in fold(_rows(batches), entries):
            columns = [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "sources", "counts"])

    folded = only(docs, lang=lang, source=source, text=text).mapInArrow(run, STRIPES)
    # Stripes are shuffled once, by term; both sums below take them where they lie.
    met = folded.repartition("lang", "term")
    parts = met.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    parts = parts.select("lang", "term", F.col("x.sources").alias("source"), F.col("x.counts").alias("count"))
    summed = parts.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"))
    whole = summed.groupBy("lang", "term").agg(
        F.max(F.when(F.col("source").isNull(), F.col("count"))).alias("documents"),
        F.collect_list(F.when(F.col("source").isNotNull(), F.struct("source", "count"))).alias("stripe"),
    )
    return whole.where(F.col("documents") >= least_documents).select("lang", "term", "stripe")


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / total) by long division, exact up to counts of 9 * 10^13."""
    first, rest = np.divmod((counts + 2) * 10_000, total)
    return 1 + first * 100_000 + rest * 100_000 // total


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


EMITTED = "lang string, a int, b int, term binary, value bigint"


def _emitted(lang: str, a: np.ndarray, b: np.ndarray | None, term: pa.Array | None, value: np.ndarray) -> pa.RecordBatch:
    n = len(value)
    columns = [
        pa.array([lang] * n, pa.string()),
        pa.array(a.astype(np.int32)),
        pa.nulls(n, pa.int32()) if b is None else pa.array(b.astype(np.int32)),
        pa.nulls(n, pa.binary()) if term is None else term.cast(pa.binary()),
        pa.array(value.astype(np.int64)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "term", "value"])


class _Stripes:
    """Stripes of one language: rows of (term, places of sources, counts), and the language's totals."""

    def __init__(self, cuts: list[pa.RecordBatch]):
        self.terms = pa.concat_arrays([c.column(1) for c in cuts])
        self.total = cuts[0].column(4)[0].values.to_numpy()  # N + 2 V of each source
        self.whole = np.int64(cuts[0].column(5)[0].as_py())  # and of the language
        sizes = np.concatenate([pc.list_value_length(c.column(2)).to_numpy(zero_copy_only=False) for c in cuts])
        self.begins = offsets_of(sizes.astype(np.int64))
        self.places = np.concatenate([c.column(2).flatten().to_numpy() for c in cuts])
        self.counts = np.concatenate([c.column(3).flatten().to_numpy() for c in cuts])

    def dense(self, begin: int, end: int, first: int, last: int) -> np.ndarray:
        """Counts of some rows in the sources from ``first`` to ``last``."""
        at = slice(self.begins[begin], self.begins[end])
        row = np.repeat(np.arange(end - begin), np.diff(self.begins[begin : end + 1]))
        place = self.places[at]
        on = (place >= first) & (place < last)
        out = np.zeros((end - begin, last - first), np.int64)
        out[row[on], place[on] - first] = self.counts[at][on]
        return out


def _compared(lang: str, held: _Stripes, top: int, block: int, sources: int) -> Iterator[pa.RecordBatch]:
    """What stripes of one language emit: each two sources once, and of each source's terms the first."""
    n, width = len(held.terms), len(held.total)
    step = max(1, block // max(1, min(width, sources)))
    whole = np.add.reduceat(held.counts, held.begins[:-1])  # no stripe is empty
    for one in range(0, width, sources):
        end_one = min(width, one + sources)
        of_one = held.total[one:end_one]
        found: list[np.ndarray] = []
        for other in range(one, width, sources):
            end_other = min(width, other + sources)
            sums = np.zeros((end_one - one, end_other - other), np.int64)
            for begin in range(0, n, step):
                end = min(n, begin + step)
                counts = held.dense(begin, end, one, end_one)
                a = shares(counts, of_one)
                b = a if other == one else shares(held.dense(begin, end, other, end_other), held.total[other:end_other])
                for i in range(a.shape[1]):
                    sums[i] += _divergence(a[:, [i]], b).sum(axis=0)
                if other == one:
                    q = shares(whole[begin:end], held.whole)[:, None]
                    above = np.where((counts > 0) & (a > q), _divergence(a, q), -1)
                    row, of = np.nonzero(_among_first(above, top))
                    found.append(np.stack([of, above[row, of], begin + row]))
            i, j = np.nonzero(sums)
            first = one + i < other + j
            if first.any():
                yield _emitted(lang, one + i[first], other + j[first], None, sums[i[first], j[first]])
        of, value, row = np.concatenate(found, axis=1)
        by = np.lexsort((-value, of))
        of, value, row = of[by], value[by], row[by]
        # Of the rows that were among the first somewhere, those that are over all: ties go on.
        begins = np.searchsorted(of, np.arange(end_one - one + 1))
        last = np.minimum(begins[:-1] + top, begins[1:]) - 1
        on = value >= value[np.maximum(last, 0)][of] if len(of) else np.zeros(0, bool)
        if on.any():
            yield _emitted(lang, one + of[on], None, held.terms.take(pa.array(row[on])), value[on])


def _among_first(above: np.ndarray, top: int) -> np.ndarray:
    """Which values of each column are 0 or more and among its ``top`` largest, ties included."""
    if len(above) <= top:
        return above >= 0
    least = np.partition(above, len(above) - top, axis=0)[len(above) - top]
    return (above >= 0) & (above >= least)


def emit(held: DataFrame, top: int, block: int = BLOCK_ENTRIES, sources: int = SOURCES, entries: int = TASK_ENTRIES) -> DataFrame:
    """From stripes with their language's totals, what they add to pairs (a, b, value), a < b, and which
    terms (a, term, value) may be among the first of a source.

    A task emits each pair once for all stripes it has, and goes on to the next ``entries`` if it has more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts: dict[str, list[pa.RecordBatch]] = {}
        size = 0
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                cuts.setdefault(lang, []).append(batch.filter(pc.equal(langs.indices, i)))
            size += len(batch.column(2).flatten())
            if size >= entries:
                yield from emitted(cuts)
                cuts, size = {}, 0
        yield from emitted(cuts)

    def emitted(cuts: dict[str, list[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        for lang, of_lang in cuts.items():
            yield from _compared(lang, _Stripes(of_lang), top, block, sources)

    return held.select("lang", "term", "places", "counts", "totals", "whole").mapInArrow(run, EMITTED)


def _first_by_value(*of: str) -> Column:
    return F.row_number().over(Window.partitionBy("lang", *of).orderBy(F.col("value").desc(), F.col("item")))


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_documents: int = 10,
    top: int = 10,
    stripe_entries: int = STRIPE_ENTRIES,
    block_entries: int = BLOCK_ENTRIES,
    block_sources: int = SOURCES,
    task_entries: int = TASK_ENTRIES,
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has a source's divergence from each other
    source of its language, part ``term`` its ``top`` terms by divergence from the language."""
    nothing = F.lit("")
    groups = only(docs, lang=lang, source=source).select(F.coalesce("lang", nothing).alias("lang"), F.coalesce("source", nothing).alias("source"))
    sources = groups.distinct().groupBy("lang").agg(F.array_sort(F.collect_list("source")).alias("all_sources"))
    sources = settle(sources, "sources")
    kept = settle(stripes(docs, text, lang, source, least_documents, stripe_entries), "stripes")

    # N of each source and V of each language, in the order of the language's sources.
    parts = kept.select("lang", F.explode("stripe").alias("x")).select("lang", "x.*")
    of_source = parts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    of_lang = of_source.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("n_of"), F.sum("n").alias("n"))
    v = kept.groupBy("lang").agg(F.count("*").alias("v"))
    totals = settle(
        sources.join(of_lang, "lang").join(v, "lang").select(
            "lang",
            "all_sources",
            F.transform("all_sources", lambda s: F.coalesce(F.try_element_at("n_of", s), F.lit(0)) + 2 * F.col("v")).alias("totals"),
            (F.col("n") + 2 * F.col("v")).alias("whole"),
        ),
        "totals",
    )
    place = F.transform("stripe", lambda x: (F.array_position("all_sources", x["source"]) - 1).cast("int"))
    placed = kept.join(totals, "lang").select(
        "lang", "term", place.alias("places"), F.transform("stripe", lambda x: x["count"]).alias("counts"), "totals", "whole"
    )
    size = kept.agg(F.sum(F.size("stripe"))).first()[0] or 0
    emitted = emit(placed.coalesce(-(-size // task_entries) or 1), top, block_entries, block_sources, task_entries)
    added = emitted.groupBy("lang", "a", "b", "term").agg(F.sum("value").alias("value"))
    added = settle(added, "divergences")
    free(kept)

    pairs = added.where("term IS NULL").select("lang", "a", "b", "value")
    both = pairs.unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = sources.select("lang", F.posexplode("all_sources").alias("a", "source"), "all_sources")
    wanted = names.select("lang", "a", "source", F.posexplode("all_sources").alias("b", "item")).where("a <> b")
    valued = wanted.join(both, ["lang", "a", "b"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    pair = valued.withColumns({"part": F.lit("pair"), "rank": _first_by_value("source")})

    terms = added.where("term IS NOT NULL").select("lang", "a", F.col("term").cast("string").alias("item"), "value")
    first = terms.withColumn("rank", _first_by_value("a")).where(F.col("rank") <= top)
    term = first.join(names.select("lang", "a", "source"), ["lang", "a"]).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank"]
    return pair.select(*columns).unionByName(term.select(*columns))
