"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    bpe,
    divergence,
    fingerprints,
    langid,
    packing,
    quality,
    redirects,
    rules,
    simhash,
    token_counts,
    topk,
    training_order,
)
from tidemark.sources.tables import read_table


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    return topk.top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5, scale=256)


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints_and_edits(read_table(spark, folder, "documents"))


def op4_langid(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(read_table(spark, folder, "documents"))


#: The rules that the query is asked to judge by.
RULES = (
    redirects.Rule("block", "net", "/"),
    redirects.Rule("allow", "example.net", "/en/"),
    redirects.Rule("block", "example.com", "/de/"),
    redirects.Rule("allow", "org", "/fr/"),
)


def op5_redirects(spark: SparkSession, folder: str) -> DataFrame:
    return redirects.judge(read_table(spark, folder, "pages"), RULES)


def op6_training_order(spark: SparkSession, folder: str) -> DataFrame:
    return training_order.materialise(read_table(spark, folder, "documents"))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, folder, "documents"))


def op9_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, folder, "documents"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"))


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read_table(spark, folder, "documents"))


def op12_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(read_table(spark, folder, "documents"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.audit(read_table(spark, folder, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_topk": op2_topk,
    "op3_fingerprints": op3_fingerprints,
    "op4_langid": op4_langid,
    "op5_redirects": op5_redirects,
    "op6_training_order": op6_training_order,
    "op7_bpe": op7_bpe,
    "op8_token_counts": op8_token_counts,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_packing": op10_packing,
    "op11_divergence": op11_divergence,
    "op12_rules": op12_rules,
    "op13_alignment": op13_alignment,
}

_OP2_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# The same reading of urls, tags and rules; aliases are followed by a recursive query.
_OP5_SQL = r"""
WITH RECURSIVE tags AS (
    SELECT url, unnest(list_concat(
        list_transform(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
            lambda tag: regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
        list_transform(regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'),
            lambda tag: regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)))) AS raw
    FROM pages
),
targets AS (
    SELECT url, CASE
        WHEN contains(target, '://') THEN target
        WHEN starts_with(target, '//') THEN regexp_extract(url, '^([^:/?#]*)://', 1) || ':' || target
        WHEN starts_with(target, '/') THEN regexp_extract(url, '^[^:/?#]*://[^/?#]*') || target
        ELSE regexp_extract(url, '^[^:/?#]*://[^/?#]*')
             || coalesce(nullif(regexp_extract(url, '^[^:/?#]*://[^/?#]*(/(?:[^?#]*/)?)', 1), ''), '/') || target
        END AS target
    FROM (SELECT url, replace(trim(raw), '&amp;', '&') AS target FROM tags) WHERE target <> ''
),
urls AS (SELECT url FROM pages UNION SELECT url FROM targets UNION SELECT target FROM targets),
parsed AS (
    SELECT url,
        translate(coalesce(regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*'), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*(/[^?#]*)?', 1) AS path,
        regexp_extract(url, '^[^?#]*(\?[^#]*)?', 1) AS query
    FROM urls WHERE contains(url, '://')
),
rules(verdict, rule, host, path) AS (
    VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
        ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
),
ruled AS (
    SELECT p.url, p.host, p.path,
        CASE WHEN p.host <> '' THEN p.host || CASE p.path WHEN '' THEN '/' ELSE p.path END || p.query END AS address,
        (SELECT arg_max(r.rule, length(r.rule)) FROM rules r
         WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS rule,
        (SELECT arg_max(r.verdict, length(r.rule)) FROM rules r
         WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS own
    FROM parsed p
),
edges AS (
    SELECT a.address AS a, b.address AS b
    FROM targets t JOIN ruled a ON a.url = t.url JOIN ruled b ON b.url = t.target
    WHERE a.address <> b.address
),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(node, other) AS (
    SELECT a, a FROM both_ways
    UNION
    SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.other
),
decided AS (
    SELECT node, min(other) AS component, bool_or(d.own = 'allow') AS allowed, bool_or(d.own = 'block') AS blocked
    FROM reach JOIN ruled d ON d.address = reach.other GROUP BY node
)
SELECT p.page_id, coalesce(u.host, '') AS host, coalesce(u.path, '') AS path, u.rule,
    coalesce(u.own, CASE WHEN d.allowed THEN 'allow' WHEN d.blocked THEN 'block' ELSE 'allow' END) AS verdict,
    d.component
FROM pages p LEFT JOIN ruled u ON u.url = p.url LEFT JOIN decided d ON d.node = u.address
"""

# Terms, totals and divergences spelled out: every term of a language in every one of its sources.
_OP11_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
sources AS (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT doc, lang, source, term, count(*) AS n FROM (SELECT doc, lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL),
kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(*) >= 10),
counted AS (SELECT lang, source, term, sum(n)::BIGINT AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
full_counts AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n
    FROM sources s JOIN kept k ON k.lang = s.lang
    LEFT JOIN counted c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
),
shares AS (
    SELECT lang, source, term, n,
        1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v)::HUGEINT AS p
    FROM full_counts JOIN v USING (lang)
),
of_lang AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v)::HUGEINT AS q
    FROM (SELECT lang, term, sum(n) AS n FROM full_counts GROUP BY lang, term) JOIN v USING (lang)
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL
),
terms AS (
    SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
    FROM shares JOIN of_lang USING (lang, term) WHERE n > 0 AND p > q
),
ranked AS (
    SELECT lang, source, 'pair' AS part, item, value,
        row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, value,
        row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM terms
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def _op12_sql() -> str:
    """The rules with plain windows of words, and quartiles by counting along ordered rates."""
    rates = " UNION ALL ".join(
        f"SELECT doc, lang, source, '{r.name}' AS rate, {r.count} * 1000 // n_words AS value FROM counted WHERE NOT base_failed"
        for r in rules.RATES
    )
    fits = []
    for r in rules.RATES:
        value = f"{r.count} * 1000 // n_words"
        fits.append(f"{value} <= max(most) FILTER (rate = '{r.name}')")
        if r.low:
            fits.append(f"{value} >= max(least) FILTER (rate = '{r.name}')")
    slack = "CASE rate " + " ".join(f"WHEN '{r.name}' THEN {r.slack or 'q1 // 16'}" for r in rules.RATES) + " END"
    levels = []
    for name, keys in (("own", "lang, source, rate"), ("of_lang", "lang, rate"), ("of_all", "rate")):
        levels.append(f"""
{name}_upto AS (
    SELECT {keys}, cut, sum(count(*)) OVER (PARTITION BY {keys} ORDER BY cut) AS upto, sum(count(*)) OVER (PARTITION BY {keys}) AS total
    FROM rates GROUP BY {keys}, cut
),
{name} AS (
    SELECT {keys}, max(total) AS total, min(cut) FILTER (4 * upto >= total) AS q1, min(cut) FILTER (4 * upto >= 3 * total) AS q3
    FROM {name}_upto GROUP BY {keys}
)""")
    return rf"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
    FROM documents
),
split AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
    FROM docs
),
runs AS (
    SELECT doc, pos, array_to_string(words[pos:pos + {rules.RUN - 1}], ' ') AS run
    FROM (SELECT doc, words, unnest(range(1, len(words) - {rules.RUN - 2})) AS pos FROM split WHERE len(words) >= {rules.RUN})
),
again AS (SELECT doc, pos FROM (SELECT doc, pos, count(*) OVER (PARTITION BY doc, run) AS times FROM runs) WHERE times > 1),
covered AS (
    SELECT doc, sum(least({rules.RUN}, following - pos)) AS n
    FROM (SELECT doc, pos, coalesce(lead(pos) OVER (PARTITION BY doc ORDER BY pos), pos + {rules.RUN}) AS following FROM again)
    GROUP BY doc
),
counts AS (
    SELECT s.doc, doc_id, lang, source, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM split s LEFT JOIN covered c ON c.doc = s.doc
),
counted AS (
    SELECT *, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed FROM counts
),
rates AS (
    SELECT *, (value >> greatest(length(bin(value)) - {rules.DIGITS}, 0)) << greatest(length(bin(value)) - {rules.DIGITS}, 0) AS cut FROM ({rates})
),{",".join(levels)},
chosen AS (
    SELECT o.lang, o.source, rate,
        CASE WHEN o.total >= {rules.LEAST} THEN o.q1 WHEN l.total >= {rules.LEAST} THEN l.q1 ELSE a.q1 END AS q1,
        CASE WHEN o.total >= {rules.LEAST} THEN o.q3 WHEN l.total >= {rules.LEAST} THEN l.q3 ELSE a.q3 END AS q3
    FROM own o JOIN of_lang l USING (lang, rate) JOIN of_all a USING (rate)
),
limits AS (
    SELECT lang, source, rate, q1 - {rules.REACH} * greatest(q3 - q1, {slack}) AS least, q3 + {rules.REACH} * greatest(q3 - q1, {slack}) AS most
    FROM chosen
),
judged AS (
    SELECT c.doc, {" AND ".join(fits)} AS fits
    FROM counted c JOIN limits USING (lang, source) WHERE NOT base_failed GROUP BY c.doc, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(fits, false) AS kept
FROM counted c LEFT JOIN judged j ON j.doc = c.doc
"""


ORACLE_SQL: dict[str, str] = {
    "op2_topk": _OP2_SQL,
    "op5_redirects": _OP5_SQL,
    "op11_divergence": _OP11_SQL,
    "op12_rules": _op12_sql(),
}
