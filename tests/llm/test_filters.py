"""Url rules and the aliases that carry them."""

import re
import sys

from tidemark.llm import redirects
from tidemark.llm.queries import ORACLE_SQL, QUERIES, RULES

sys.path.append(str(__import__("pathlib").Path(__file__).parent.parent))
from oracle import connect  # noqa: E402

SCHEMA = "page_id long, url string, html string, host string, component string"


def canonical(url):
    return f'<head><LINK href="{url}" rel="canonical"></head>'


def refresh(url):
    return f"<meta http-equiv='refresh' content='0; url={url}'>"


PAGES = [
    (1, "http://a.example.com/x", canonical("http://b.net/spam")),
    (2, "http://b.net/spam", ""),
    (3, "https://c.example.org/y?id=1#top", refresh("//A.example.com/x")),
    (4, "http://a.example.org/fr/1", canonical("/other")),
    (5, "http://a.example.org/other", None),
    (6, "http://d.net/bad", canonical("http://e.org/fr/ok")),
    (7, "http://f.com/1", canonical("http://d.net/bad")),
    (8, "http://f.com/2", "<p>canonical refresh http-equiv</p>"),
    (9, "http://Example.COM/de/page", canonical("http://g.com/")),
    (10, "http://g.com", ""),
    (11, None, canonical("http://b.net/spam")),
    (12, "no scheme", None),
    (13, "", ""),
    (14, "http://shop.example.net/en/1", canonical("http://b.net/spam")),
    (15, "http://xexample.net/en/", ""),
    (16, "http://site.net", ""),
    (17, "http://site.net?x=/", ""),
    (18, "ftp://h.com/dir/page.html", '<link rel=canonical href=next.html?a=1&amp;b=2>'),
    (19, "http://h.com/dir/next.html?a=1&b=2", canonical("http://b.net/spam") + refresh("http://f.com/2")),
    (20, "http://b.net/spam", ""),
    (1, "http://a.example.com/x", canonical("http://b.net/spam")),
    (None, None, None),
]

VERDICTS = {
    # b.net/spam is blocked; shop.example.net/en/ is an alias of it that a rule allows, and so are all.
    1: "allow", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block", 7: "allow", 8: "allow", 9: "block",
    10: "block", 11: "allow", 12: "allow", 13: "allow", 14: "allow", 15: "block", 16: "allow", 17: "allow",
    18: "allow", 19: "allow", 20: "block",
}


def rows_of(frame, pages):
    return frame([(*p, "clash", "clash") for p in pages], SCHEMA)


def test_aliases_share_block_decisions(frame):
    found = redirects.judge(rows_of(frame, PAGES), RULES).collect()
    assert len(found) == len(PAGES)
    assert {r["page_id"]: r["verdict"] for r in found if r["page_id"]} == VERDICTS
    without = [p for p in PAGES if p[0] != 14]
    found = {r["page_id"]: r["verdict"] for r in redirects.judge(rows_of(frame, without), RULES).collect()}
    assert [found[i] for i in (1, 2, 3, 8, 18, 19)] == ["block"] * 6
    assert redirects.judge(rows_of(frame, PAGES).limit(0), RULES).count() == 0


def test_sql_reads_pages_alike(spark, frame, tmp_path):
    folder = str(tmp_path)
    rows_of(frame, PAGES).select("page_id", "url", "html").coalesce(1).write.parquet(f"{folder}/pages.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    cursor = con.execute(ORACLE_SQL["op5_redirects"])
    result = QUERIES["op5_redirects"](spark, folder)
    order = [[d[0] for d in cursor.description].index(c) for c in result.columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=str)
    assert sorted(map(tuple, result.collect()), key=str) == expected


def test_whole_table(spark, folder):
    result = QUERIES["op5_redirects"](spark, folder)
    cursor = connect(folder).execute(ORACLE_SQL["op5_redirects"])
    order = [[d[0] for d in cursor.description].index(c) for c in result.columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=str)
    assert sorted(map(tuple, result.collect()), key=str) == expected
    plan = spark._jvm.PythonSQLUtils.explainString(result._jdf.queryExecution(), "simple")
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


def test_long_redirect_chains(frame):
    pages = [(i, f"http://site.com/{i}", canonical(f"http://site.com/{i + 1}")) for i in range(150)]
    pages.append((150, "http://site.com/150", refresh("https://bad.net/")))
    found = redirects.judge(rows_of(frame, pages), RULES).collect()
    assert {r["verdict"] for r in found} == {"block"} and {r["rule"] for r in found} == {None}


def test_very_long_urls_and_pages(frame):
    long = "http://bad.net/" + "x" * 300_000
    pages = [
        (1, "http://a.com/1", "<p>" * 200_000 + canonical("http://b.net/spam") + " canonical " * 100_000),
        (2, "http://a.com/2", canonical(long)),
        (3, long + "?q#f", None),
        (4, "http://" + "a" * 100_000 + ".com/", ""),
    ]
    found = {r["page_id"]: r for r in redirects.judge(rows_of(frame, pages), RULES).collect()}
    assert [found[i]["verdict"] for i in (1, 2, 3, 4)] == ["block", "block", "block", "allow"]
    assert found[3]["path"] == long[len("http://bad.net") :] and len(found[4]["host"]) == 100_004
