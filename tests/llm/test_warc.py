import duckdb
import pytest

from tallyhouse.llm.warc import SQL, captures, op6_revisits, resolve

RECORDS = "record_id long, url string, time long, kind string, status int, headers map<string,string>, digest string, extra string"


def test_rules(spark):
    rows = [
        (1, "http://A.org:80/x#f", 10, "response", 200, {"etag": '"a"', "content-length": "9", "x": "old"}, "d1", "e"),
        (2, "http://www.a.org/x", 20, "response", 404, {"etag": '"b"'}, "d2", "e"),
        (3, "http://a.org/x", 5000, "revisit", 304, {"etag": 'W/"a"', "content-length": "0", "x": "new"}, None, None),
        (4, "http://a.org/x", 10, "revisit", 304, {"etag": '"a"'}, None, None),
        (5, "http://a.org/x", 11, "revisit", 304, {"etag": '"z"'}, None, None),
        (6, "http://a.org/x", 11, "revisit", 304, None, None, None),
        (7, None, 11, "revisit", 304, {}, None, None),
        (8, "http://a.org/x", None, "revisit", 304, {}, None, None),
        (9, None, 1, "response", 200, {}, "d9", None),
        (10, "http://a.org/x", 11, "revisit", 304, {"last-modified": "m"}, None, None),
        (10, "http://a.org/x", 11, "revisit", 304, {"last-modified": "m"}, None, None),
    ]
    for cell in (4096, 3):
        got = resolve(spark.createDataFrame(rows, RECORDS), cell=cell).collect()
        assert sorted((r.record_id, r.refers_to, r.verdict, r.digest) for r in got if r.record_id != 3) == [
            (4, None, "orphan", None), (5, 1, "changed", None), (6, 1, "unchecked", None), (7, None, "orphan", None),
            (8, None, "orphan", None), (10, 1, "changed", None), (10, 1, "changed", None),
        ]
        third = next(r for r in got if r.record_id == 3)
        assert third.refers_to == 1 and third.digest == "d1" and third.headers == {"etag": 'W/"a"', "content-length": "9", "x": "new"}


def test_odd_pages(spark, stored, tmp_path):
    pages = [(1, None, None), (None, "http://a.org", "x"), (2, "", ""), (2, "", ""), (3, "http://a.org/#q", None), (4, "http://a.org", "y")]
    stored(pages, "page_id long, url string, html string", "pages")
    rows = op6_revisits(spark, str(tmp_path)).collect()
    assert len(rows) == 5 * len(pages) and {r.url for r in rows} == {None, "", "http://a.org/", "http://common.example/"}
    stored([], "page_id long, url string, html string", "pages")
    assert op6_revisits(spark, str(tmp_path)).collect() == []
    assert captures(spark.read.parquet(f"{tmp_path}/pages.parquet")).columns[0] == "record_id"


def plain(records):
    """The latest earlier full response of each revisit, by looking at all of its URL."""
    out = {}
    for r in records:
        if r.kind == "revisit":
            url = r.url.removesuffix("#again")
            earlier = [(o.time, o.record_id) for o in records if o.kind == "response" and o.status == 200 and o.url == url and o.time < r.time]
            out[r.record_id] = max(earlier)[1] if earlier else None
    return out


@pytest.mark.parametrize("cell", [4096, 64, 1])
def test_latest_of_several_responses_across_cells_and_ties(spark, cell):
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.org/{i}", str(i)) for i in range(120)], "page_id long, url string, html string")
    records = captures(pages).cache()
    rows = records.collect()
    assert sum(r.url == "http://common.example/" for r in rows) * 3 == len(rows)
    got = resolve(records, cell=cell).collect()
    assert {r.record_id: r.refers_to for r in got} == plain(rows) and len(got) == 600
    assert {r.verdict for r in got} == {"resolved", "changed", "unchecked", "orphan"}
    records.unpersist()


def test_repeated_urls_compete_across_pages(spark, stored, tmp_path):
    """Pages of one URL: their responses compete, in the SQL counterpart too."""
    stored([(i, ["http://a.org/x", "http://A.org:80/x#f", "http://b.org", "http://www.a.org/x"][i % 4], f"v{i}") for i in range(3000, 3160)], "page_id long, url string, html string", "pages")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    columns = ["record_id", "url", "time", "refers_to", "verdict", "headers", "digest"]
    mine = sorted((tuple(r) for r in op6_revisits(spark, str(tmp_path)).select(*columns).collect()), key=str)
    theirs = sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({SQL['op6_revisits']})").fetchall(), key=str)
    assert mine == theirs and len(mine) == 800
