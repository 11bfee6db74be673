"""Source divergence, quality rules and cross-tokenizer alignment against plain versions and SQL."""

import hashlib
import random
import re
import sys
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment, divergence, rules
from tidemark.llm.queries import ORACLE_SQL, QUERIES
from tidemark.llm.vocabulary import byte_vocabulary, default_path
from tidemark.sources.tables import read_table

sys.path.append(str(__import__("pathlib").Path(__file__).parent.parent))
from oracle import connect  # noqa: E402


def sql_rows(connection, name, columns):
    cursor = connection.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(columns)
    return Counter(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("name", ["op11_divergence", "op12_rules"])
def test_agrees_with_sql(spark, folder, name):
    result = QUERIES[name](spark, folder)
    assert rows_of(result) == sql_rows(connect(folder), name, result.columns)


@pytest.mark.parametrize("name", ["op11_divergence", "op12_rules"])
def test_sql_reads_odd_documents_alike(spark, odd_docs, tmp_path, name):
    import duckdb

    odd_docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = QUERIES[name](spark, str(tmp_path))
    assert rows_of(result) == sql_rows(connection, name, result.columns)


# Source divergence


def brute_divergence(docs, least=10, top=10):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for lang, source, t in docs]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        frequency = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in frequency.items() if n >= least)
        counts = {}
        for _, source, terms in own:
            counts.setdefault(source, Counter()).update(t for t in terms if frequency[t] >= least)
        whole = sum(counts.values(), Counter())

        def shares(of):
            total = sum(of.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (of[t] + 2) // total for t in kept}

        p = {source: shares(of) for source, of in counts.items()}
        q = shares(whole)

        def apart(x, y):
            return (x - y) ** 2 // (x + y)

        for source, of in counts.items():
            pair = [(-sum(apart(p[source][t], p[other][t]) for t in kept), other) for other in counts if other != source]
            term = [(-apart(p[source][t], q[t]), t) for t in kept if of[t] > 0 and p[source][t] > q[t]]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, source, part, item, -value, n + 1) for n, (value, item) in enumerate(found)]
    return Counter(out)


def divergent(frame):
    """Three languages; a source that holds a third of all rows, one without terms, ties, odd characters."""
    draw = random.Random(6)
    words = ["Alpha", "beta", "GAMMA", "δέλτα", "straße", "Éa", "zwei", "x", "漢字", "tie1tie", "Ａ", "😀up", "kept"]
    rows = []
    for i in range(240):
        lang = draw.choice(["en", "en", "de", None])
        source = "hot" if i % 3 == 0 else draw.choice(["a", "b", None, "Z", "é"])
        rows.append((i, " ".join(draw.choices(words, range(1, 14), k=draw.randrange(0, 30))), lang, source))
    rows += [(900, "", "en", "silent"), (901, None, "en", "silent"), (902, "rare words only", "fr", "one"), (903, "", "fr", "two")]
    rows += [(904, None, None, None)] + rows[:5]
    return [r[2:] + (r[1],) for r in rows], frame(rows, "doc_id long, text string, lang string, source string").withColumns(
        {"term": F.lit(1), "counts": F.lit("x"), "value": F.lit(None)}
    )


@pytest.mark.parametrize(("entries", "block", "sources", "task"), [(400_000, 1 << 20, 256, 1 << 20), (7, 3, 2, 9), (50, 6, 3, 1 << 20)])
def test_divergence_against_plain_counts(frame, entries, block, sources, task):
    """Also where stripes spill after each few entries and blocks hold few terms and sources."""
    plain, docs = divergent(frame)
    bounds = {"stripe_entries": entries, "block_entries": block, "block_sources": sources, "task_entries": task}
    assert rows_of(divergence.audit(docs, **bounds)) == brute_divergence(plain)
    assert rows_of(divergence.audit(docs, least_documents=40, top=2, **bounds)) == brute_divergence(plain, 40, 2)


def test_spilled_stripes_add_up():
    draw = random.Random(2)
    docs = [(draw.choice("ab"), draw.choice("xyz"), " ".join(draw.choices(["p", "q", "r", "s"], k=draw.randrange(6)))) for _ in range(80)]
    once, often = Counter(), Counter()
    for total, most in ((once, 10**6), (often, 3)):
        for out in divergence.fold(iter(docs), most):
            for lang, term, sources, counts in out:
                for source, count in zip(sources, counts, strict=True):
                    total[lang, term, source] += count
    assert once == often
    assert once["a", b"p", None] == sum(1 for lang, _, t in docs if lang == "a" and "p" in t)


def test_shares_are_exact():
    import numpy as np

    counts = np.array([0, 1, 10**6, 8 * 10**13, 3 * 10**10 + 1])
    total = int(counts.sum()) + 2 * 10**9 + 1
    assert divergence.shares(counts, np.int64(total)).tolist() == [1 + 10**9 * (int(c) + 2) // total for c in counts]


def test_divergence_of_nothing(odd_docs):
    assert divergence.audit(odd_docs.limit(0)).count() == 0


# Quality rules


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(runs)
    repeated = {j for i, run in enumerate(runs) if times[run] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), n < 20 or 100 * len(repeated) > 30 * n


def brute_rules(docs):
    """Fences by sorting exact rates with their trailing digits cut."""
    measured = [(lang or "", source or "", *measures(t)) for lang, source, t in docs]

    def rates(m):
        return [1000 * m[i] // m[2] for i in (3, 4, 5, 6)]

    def cut(v):
        spare = max(0, v.bit_length() - rules.DIGITS) if v else 0
        return v >> spare << spare

    good = [m for m in measured if not m[-1]]
    kept = []
    for m in measured:
        if m[-1]:
            kept.append(False)
            continue
        for group in ([g for g in good if g[:2] == m[:2]], [g for g in good if g[0] == m[0]], good):
            if len(group) >= rules.LEAST:
                break
        fits = True
        for k, rate in enumerate(rules.RATES):
            values = sorted(cut(rates(g)[k]) for g in group)
            q1, q3 = (values[-(-part * len(values) // 4) - 1] for part in (1, 3))
            reach = rules.REACH * max(q3 - q1, rate.slack or q1 // 16)
            fits &= rates(m)[k] <= q3 + reach and (not rate.low or rates(m)[k] >= q1 - reach)
        kept.append(fits)
    return [(*m[2:], k) for m, k in zip(measured, kept, strict=True)]


def test_rules_against_plain_counts(frame):
    draw = random.Random(12)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(3, 8))) for _ in range(300)]

    def text(n, junk=0.0):
        return "".join((w + "###" if draw.random() < junk else w) + draw.choice([" "] * 9 + ["\n"]) for w in draw.choices(words, k=n))

    docs = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else draw.choice(["a", "b", "small", None])
        kind = draw.random()
        body = text(draw.randint(5, 120), 0.9 if kind < 0.1 else 0.3 if source == "b" else 0)
        if kind > 0.9:
            line = text(12).replace("\n", " ")
            body = "\n".join([line] * draw.randint(2, 9) + [body])
        docs.append(("en" if source != "small" else "de", source, body))
    docs += [("en", "a", None), ("en", "a", ""), (None, None, " \t\x0b\f\r\n \n"), ("xx", "only", text(30)), ("en", "hot", "w " * 40_000)]
    docs += docs[:3]
    rows = [(i, t, lang, source, 1, "x") for i, (lang, source, t) in enumerate(docs)]
    df = frame(rows, "doc_id long, text string, lang string, source string, n_words int, id string")
    found = sorted(map(tuple, rules.judge(df).collect()))
    expected = [(i, *row) for i, row in enumerate(brute_rules(docs))]
    assert found == expected
    assert 0 < sum(not r[-1] and not r[-2] for r in found) < 60
    kept = rules.keep_within(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [r[0] for r in expected if r[-1]]


def test_rules_are_native_and_take_odd_rows(spark, folder, odd_docs):
    result = QUERIES["op12_rules"](spark, folder)
    plan = spark._jvm.PythonSQLUtils.explainString(result._jdf.queryExecution(), "simple")
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    rows = rules.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r["n_words"] == 0:
            assert r["base_failed"] and not r["kept"]
    assert rules.judge(odd_docs.limit(0)).count() == 0
    assert rules.keep_within(odd_docs.limit(0)).count() == 0


def test_labelled_good_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    good = {r["doc_id"] for r in read_table(spark, sf, "labels").where("quality = 1").collect()}
    bad = {r["doc_id"] for r in read_table(spark, sf, "labels").where("quality = 0").collect()}
    rows = [r for r in QUERIES["op12_rules"](spark, sf).collect() if not r["base_failed"]]
    stay = [r["kept"] for r in rows if r["doc_id"] in good]
    assert sum(stay) >= 0.99 * len(stay)
    gone = [not r["kept"] for r in rows if r["doc_id"] in bad]
    assert sum(gone) >= 0.6 * len(gone)


# Alignment


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(default_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=default_path(alignment.PIECES))


def plain_tokens(text, libraries):
    """(id, start, end) of both sides, or nothing."""
    if not text:
        return [], []
    a_model, b_model = libraries
    whole = b" " + text.encode()
    out = []
    for ids, bytes_of in (
        (a_model.encode(" " + text, add_special_tokens=False).ids, lambda i: byte_vocabulary(default_path()).bytes[i]),
        (
            b_model.encode(text),
            lambda i: bytes([int(b_model.id_to_piece(i)[1:-1], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode(),
        ),
    ):
        held = [bytes_of(i) for i in ids]
        if b"".join(held) != whole:
            return [], []
        ends = [sum(map(len, held[: n + 1])) for n in range(len(held))] if len(held) < 300 else None
        if ends is None:
            ends, at = [], 0
            for t in held:
                at += len(t)
                ends.append(at)
        out.append([(i, e - len(t), e) for i, t, e in zip(ids, held, ends, strict=True)])
    return out


def plain_links(a, b):
    out, first = [], 0
    for m, (_, start, end) in enumerate(a):
        while first < len(b) and b[first][2] <= start:
            first += 1
        n = first
        while n < len(b) and b[n][1] < end:
            out.append((m, n))
            n += 1
    return out


def plain_groups(a, b):
    ends = sorted({x[2] for x in a} & {x[2] for x in b})
    text, last = [], 0
    for end in ends:
        text.append("|".join(",".join(str(i) for i, s, e in side if last <= s and e <= end) for side in (a, b)))
        last = end
    return ends, ";".join(text)


def brute_alignment(docs, libraries):
    tokens = [plain_tokens(t, libraries) for _, t in docs]
    links = [plain_links(a, b) for a, b in tokens]
    held = Counter(p for (a, b), found in zip(tokens, links, strict=True) for p in {(a[m][0], b[n][0]) for m, n in found})
    highest = {}
    for (x, _), n in held.items():
        highest[x] = max(highest.get(x, 0), n)
    out = []
    for (key, _), (a, b), found in zip(docs, tokens, links, strict=True):
        ends, text = plain_groups(a, b)
        counts = [(a[m][0], held[a[m][0], b[n][0]]) for m, n in found]
        best = sum(n == highest[x] for x, n in counts)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out.append((key, len(a), len(b), len(ends), len(found), best, sum(n for _, n in counts), digest))
    return Counter(out)


def test_alignment_of_the_whole_table(spark, folder, libraries):
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, folder, "documents").collect()]
    short = [(k, t) for k, t in docs if t is None or len(t) < 6000]
    found = QUERIES["op13_alignment"](spark, folder)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    # Counts are over all documents, long ones too; digests of those need no quadratic check.
    expected = {r[0]: r for r in brute_alignment(short, libraries)}
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == len(docs)
    for k, t in short:
        r = rows[k]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) == (*expected[k][1:5], expected[k][7])


ODD = [
    "double  spaces and   more", " leading", "trailing ", "  ", " ", "a▁b", "<s>special</s> <|endoftext|> <unk>", "line\nbreak\r\n\ttab",
    "漢字 かな", "é café ﬁ ½ Å ﷺ", "no-break space　wide", "🙂🙂 emoji🙂", "\x00\x01 control", "x" * 3000, "word " * 300, "don't can't 1234567 ... === !!",
    "zero​width ﻿mark", "a\nb\n\nc", "▁", "Straße über Äpfel", "한국어 텍스트",
]


def test_alignment_of_odd_texts(frame, odd_docs, libraries):
    texts = [*ODD, *(r["text"] for r in odd_docs.collect())]
    docs = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[7]), (5, None)]
    df = frame([(k, t, 1, "x", None) for k, t in docs], "doc_id long, text string, pairs int, row string, n_a long")
    assert rows_of(alignment.audit(df)) == brute_alignment(docs, libraries)
    assert alignment.audit(df.limit(0)).count() == 0


def test_alignment_joined_by_shuffle(frame, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", 0)
    docs = list(enumerate(ODD))
    assert rows_of(alignment.audit(frame(docs, "doc_id long, text string"))) == brute_alignment(docs, libraries)


def test_links_are_all_overlaps(frame, libraries):
    docs = list(enumerate(ODD))
    found = alignment.links(frame(docs, "doc_id long, text string")).collect()
    expected = []
    for key, text in docs:
        a, b = plain_tokens(text, libraries)
        ends, _ = plain_groups(a, b)
        for m, n in plain_links(a, b):
            at = max(a[m][1], b[n][1])
            expected.append((key, m, n, a[m][0], b[n][0], a[m][1], b[n][1], sum(e <= at for e in ends)))
    assert Counter(map(tuple, found)) == Counter(expected)


def test_units_give_the_library_s_ids(libraries):
    draw = random.Random(1)
    letters = ["a", "B", "é", "ß", "漢", "🙂", " ", "  ", "\n", "\t", "▁", "<s>", "</s>", ".", "1", "́", " ", "the", " of", "\x00"]
    texts = ["".join(draw.choices(letters, k=draw.randrange(40))) for _ in range(3000)]
    ids, offsets = alignment.pair_of(default_path(), default_path(alignment.PIECES)).b.encode(pa.array(texts, pa.large_string()))
    for text, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == libraries[1].encode(text)
