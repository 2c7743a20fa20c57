from pyspark.sql import functions as F

from tallyhouse.llm.url_filter import address, alias_edges, decoded, host_and_path, judge, op3_url_filter

PAGES = "page_id long, url string, html string"


def test_parts(spark):
    urls = ["http://A.Org/x/Y?q#f", "no scheme", None, "https://h", "h://x?a/b", "://", "a://b://c/d", "http://ü.ORG:80/p/?x", "x://H#a/b"]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(*host_and_path(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [("a.org", "/x/Y"), ("", ""), ("", ""), ("h", ""), ("x", ""), ("", ""), ("b:", "//c/d"), ("ü.org:80", "/p/"), ("h", "")]


def test_aliases(spark, stored, tmp_path):
    link = lambda u: f"<html><LINK  href='{u}' rel=\"canonical\"></html>"
    moved = lambda u: f'<meta http-equiv="Refresh" content="0; url={u}">'
    pages = [
        (1, "http://x.net/a", link("http://example.org/es/1")),  # alias of a blocked one
        (2, "http://y.net/b", moved("/c")),
        (3, "http://y.net/c#top", link("http://x.net/a")),  # two steps
        (4, "http://z.net/d", link("http://example.org/en/1")),  # blocked and allowed in one class
        (5, "http://w.net/e", link("http://z.net/d")),
        (6, "http://shop.com/fr/1", link("http://z.net/d")),
        (7, "http://example.org/other", link("http://sub.example.org/es/2")),  # an explicit allow stays
        (8, "http://q.net/", "<html></html>"),
        (9, None, link("http://example.org/es/1")),
        (10, "odd", None),
        (1, "http://x.net/a", link("http://example.org/es/1")),
        (11, "http://notexample.org/es/", ""),
        (12, "http://example.org/es/1", ""),
        (13, "http://a.com/de/", ""),
    ]
    stored(pages, PAGES, "pages")
    got = sorted({(r.page_id, r.rule, r.verdict) for r in op3_url_filter(spark, str(tmp_path)).collect()})
    assert got == [
        (1, None, "block"), (2, None, "block"), (3, None, "block"), (4, None, "allow"), (5, None, "allow"), (6, "com/fr/", "allow"),
        (7, "org/", "allow"), (8, None, "allow"), (9, None, "allow"), (10, None, "allow"), (11, "org/", "allow"),
        (12, "example.org/es/", "block"), (13, "com/de/", "block"),
    ]
    docs = spark.read.parquet(f"{tmp_path}/pages.parquet").withColumn("component", F.lit(1))
    assert judge(docs, alias_edges(docs)).count() == len(pages)
    stored([], PAGES, "pages")
    assert op3_url_filter(spark, str(tmp_path)).collect() == []


def test_plan_has_no_python(spark, sf):
    plan = op3_url_filter(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_sql_follows_aliases_too(spark, stored, tmp_path):
    import duckdb

    from tallyhouse.llm.url_filter import SQL

    stored([(1, "http://x.net/a#q", "<link rel=canonical href='http://example.org/es/1'>"), (2, "http://y.net/b/c", "<meta http-equiv=refresh content='1;url=d'>"),
            (3, "http://y.net/b/d", "<link href='http://x.net/a' rel=canonical>"), (4, "http://z.net", "<link rel=canonical href='e'>"), (5, "http://z.net/e", None), (6, None, "")], PAGES, "pages")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    columns = ["page_id", "host", "path", "rule", "verdict"]
    mine = sorted(tuple(r) for r in op3_url_filter(spark, str(tmp_path)).select(*columns).collect())
    assert mine == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({SQL['op3_url_filter']})").fetchall())
    assert [r[-1] for r in mine] == ["block", "block", "block", "allow", "allow", "allow"]


def test_addresses(spark):
    cases = {
        "http://H": "http://h/", "http://h?q=/../": "http://h/?q=/../", "HTTP://h/a/./b/../c?x#f": "http://h/a/c?x", "http://h/..": "http://h/", "http://h/a/..": "http://h/",
        "http://h/a/b/.": "http://h/a/b/", "http://h/../../x": "http://h/x", "http://h/a//../b": "http://h/a/b", "http://h/a...b/.c/..d": "http://h/a...b/.c/..d", "no": None, None: None,
    }
    got = spark.createDataFrame([(u,) for u in cases], "u string").select("u", address(F.col("u")).alias("a")).collect()
    assert {r.u: r.a for r in got} == cases


def test_entities_are_decoded_once(spark):
    import html

    texts = ["a&amp;b", "&amp;lt;", "&#38;&#x26;&#X41;", "&quot;x&apos;&lt;&gt;", "&#128512;", "&#xD800;|&#x110000;|&#0;", "&amp", "plain", "", "&#252;"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decoded(F.col("t")).alias("d")).collect()
    for r in got:
        assert r.d == (r.t if r.t.startswith("&#xD") or r.t == "&amp" else html.unescape(r.t))
    assert spark.createDataFrame([(None,)], "t string").select(decoded(F.col("t"))).first()[0] is None


ALIASES = [
    ("http://x.net/p/q?a=1", '<link rel="nofollow canonical" href="?page=2&amp;ref=x">', "http://x.net/p/q?page=2&ref=x"),
    ("http://x.net/p/q", "<link href='../r/./s' rel='canonical shortlink'>", "http://x.net/r/s"),
    ("http://x.net", "<link rel=canonical href=y>", "http://x.net/y"),
    ("http://x.net?a", "<link rel=canonical href=y>", "http://x.net/y"),
    ("http://x.net/a/b?c=d/e", "<link rel=canonical href=y>", "http://x.net/a/y"),
    ("http://x.net/a", "<link rel=canonical/><link rel=canonical href='//Z.net?to=http://w.net/../'>", None),
    ("http://x.net/b", "<link rel=canonical href='//Z.net?to=http://w.net/../'>", "http://z.net/?to=http://w.net/../"),
    ("http://x.net/c", "<meta http-equiv=refresh content='0;url=/d&#x2f;e'>", "http://x.net/d/e"),
    ("http://x.net/d", "<link rel='x-canonical' href='/n'><link data-rel=canonical href='/n'>", None),
    ("http://x.net/e", "<link rel=canonical href='#top'>", None),
    ("http://x.net/f", "<link rel=canonical href='mailto:a@b'>", None),
    ("http://x.net", "<link rel=canonical href='http://x.net/'>", None),
]


def test_references_are_resolved_and_sql_agrees(spark, stored, tmp_path):
    import duckdb

    from tallyhouse.llm.url_filter import SQL

    pages = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(ALIASES)], PAGES)
    assert sorted((r.a, r.b) for r in alias_edges(pages).collect()) == sorted((address_of(u), to) for u, _, to in ALIASES if to)
    # each target is blocked through a page of its own, and the page that names it inherits that
    rows = [(i, u, h) for i, (u, h, _) in enumerate(ALIASES)] + [(100 + i, to, f"<link rel=canonical href='http://example.org/es/{i}'>") for i, (_, _, to) in enumerate(ALIASES) if to]
    stored(rows, PAGES, "pages")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    columns = ["page_id", "host", "path", "rule", "verdict"]
    mine = sorted(tuple(r) for r in op3_url_filter(spark, str(tmp_path)).select(*columns).collect())
    assert mine == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({SQL['op3_url_filter']})").fetchall())
    blocked = {r[0] for r in mine if r[-1] == "block"}
    assert blocked >= {i for i, (_, _, to) in enumerate(ALIASES) if to} and not blocked & {5, 8, 9, 10}


def address_of(url):
    scheme, rest = url.split("://")
    host, mark, query = rest.partition("?")
    return f"{scheme}://{host if '/' in host else host + '/'}{mark}{query}"
