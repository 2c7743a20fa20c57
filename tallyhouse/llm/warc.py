"""WARC not-modified revisits: each meets the latest earlier full response of its canonical URL.

Records have an id, a URL, a time, a kind (`response` or `revisit`), a status and lower-case header
names. The as-of join is a window over the records of a URL, cut into cells of time: inside a cell the
window carries the last full response, and one summary row per cell carries it on to later cells, so a
URL with a third of all records is worked on by as many tasks as it has cells. Bodies are not moved.

A revisit with an entity tag agrees with the response if the tags are equal without their weakness
marks; one without, if the modification dates are equal; `unchecked` if it carries neither, `changed`
if they differ (or the response has none), `orphan` without an earlier full response. Headers of a
revisit replace those of the response where validators agree, but for those that describe the missing
body or the connection. A response of the same time is not earlier; of several latest ones the largest
id counts. Null or odd URLs: null has no response; without "://" the text is the key. Records without a
time are no earlier response, and revisits without one are orphans. Null headers are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import read

#: Header fields of a not-modified answer that do not update the stored ones (fixed values).
NOT_MERGED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-connection", "set-cookie", "te", "trailer", "transfer-encoding", "upgrade",
)
CELL = 4096


def canonical(url: Column) -> Column:
    """Scheme and host lower-cased, no fragment, no default port, no leading www., "/" for an empty path."""
    site = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(site), r"^(http://[^/]*):80$|^(https://[^/]*):443$", "$1$2"), r"://www\.", "://")
    rest = F.regexp_extract(F.substring(url, F.length(site) + 1, F.length(url)), r"^([^#]*)", 1)
    return F.when(site == "", F.regexp_extract(url, r"^([^#]*)", 1)).otherwise(F.concat(host, F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))))


def resolve(records: DataFrame, *, cell: int = CELL) -> DataFrame:
    """A row per revisit: record_id, url (canonical), time, refers_to, verdict, headers (merged), digest.

    `records`: record_id, url, time (long), kind, status (int), headers (map), digest. `cell` is the
    length of a time cell.
    """
    none = F.create_map().cast("map<string,string>")
    own = records.select("record_id", canonical(F.col("url")).alias("url"), F.col("time").cast("long").alias("time"), "kind", "status", F.coalesce("headers", none).alias("headers"), "digest")
    full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200) & F.col("time").isNotNull() & F.col("url").isNotNull(), F.lit(False))
    revisit = F.coalesce(F.col("kind") == "revisit", F.lit(False))
    stored = F.struct(F.col("record_id").alias("id"), "headers", "digest")
    # records without a URL or time meet nobody; a salt keeps them apart
    lone = F.col("url").isNull() | F.col("time").isNull()
    rows = own.filter(full | revisit).select(
        "*", full.alias("_full"), F.when(full, stored).alias("_stored"),
        F.struct("url", F.floor(F.col("time") / cell).alias("cell"), F.when(lone, F.xxhash64("record_id")).alias("salt")).alias("_at"),
    )
    order = [F.col("time"), F.col("_full"), F.col("record_id")]
    inside = F.last("_stored", ignorenulls=True).over(Window.partitionBy("_at").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    cells = rows.filter("_full").groupBy("_at").agg(F.max_by("_stored", F.struct("time", "record_id")).alias("_edge"))
    # cells with revisits only take what the last cell with a response left
    seen = rows.groupBy("_at").agg(F.lit(1).alias("_one")).join(cells, "_at", "left")
    before = Window.partitionBy("_at.url", "_at.salt").orderBy("_at.cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = seen.select("_at", F.last("_edge", ignorenulls=True).over(before).alias("_carried"))
    met = rows.withColumn("_inside", inside).filter(~F.col("_full")).join(carried, "_at").withColumn("_met", F.when(~lone, F.coalesce("_inside", "_carried")))

    tag = lambda headers: F.regexp_replace(headers["etag"], r"^W/", "")
    mine, theirs = F.col("headers"), F.col("_met.headers")
    agrees = F.when(mine["etag"].isNotNull(), F.coalesce(tag(mine) == tag(theirs), F.lit(False))).when(
        mine["last-modified"].isNotNull(), F.coalesce(mine["last-modified"] == theirs["last-modified"], F.lit(False))
    )
    verdict = F.when(F.col("_met").isNull(), "orphan").when(agrees, "resolved").when(~agrees, "changed").otherwise("unchecked")
    update = F.map_filter(mine, lambda k, v: ~k.isin(*NOT_MERGED))
    merged = F.map_concat(F.map_filter(theirs, lambda k, v: ~F.map_contains_key(update, k)), update)
    return met.select(
        "record_id", "url", "time", F.col("_met.id").alias("refers_to"), verdict.alias("verdict"),
        F.when(verdict == "resolved", merged).otherwise(mine).alias("headers"),
        F.when(verdict == "resolved", F.col("_met.digest")).alias("digest"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Records of a crawl that the pages stand for, nine a page. Page n is fetched three times, 3,000 steps
    apart (of every fourth, the second answer is an error), and asked for again three times, a little
    after a fetch, at its very time or just before it. Each page also adds a response and two revisits of one
    common URL, which so has a third of all records, and two responses at a time. Entity tags name the
    version; asked again, a fifth of the pages names another tag, a fifth only the date, a fifth a weak
    tag, and a fifth neither at the last time."""
    n, k, again = F.col("n"), F.col("k"), F.col("n") % 5
    page = pages.select(
        F.col("page_id").cast("long").alias("n"), "url", F.md5(F.coalesce("html", F.lit(""))).alias("sum"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string").alias("size")
    )  # the page's text stays behind
    rows = page.select("*", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("k"))
    shared, revisit, visit = k >= 6, k.isin(3, 4, 5, 7, 8), k % 3
    late = F.when(n % 11 == 0, -1).when(n % 11 == 1, 0).otherwise(1 + n % 7)
    time = F.when(k < 3, n + k * 3000).when(k < 6, n + visit * 3000 + late).when(k == 6, n - n % 2).otherwise(n + k - 7)
    version = F.when(shared, F.concat(F.lit("common"), F.floor(n / 50).cast("string"))).otherwise(F.concat("sum", visit.cast("string")))
    tag = F.concat(F.lit('"'), F.substring(F.md5(version), 1, 16), F.lit('"'))
    date = F.concat(F.lit("day "), F.when(shared, F.floor(n / 50)).otherwise((n + visit) % 365).cast("string"))
    neither = (again == 3) & k.isin(5, 8)
    asked = F.when(again == 0, F.lit('"other"')).when(again == 2, F.concat(F.lit("W/"), tag)).when((again != 1) & ~neither, tag)
    own = {
        "etag": F.when(revisit, asked).otherwise(tag),
        "last-modified": F.when(~revisit | (again == 1), date),
        "content-type": F.when(~revisit, F.lit("text/html")),
        "content-length": F.when(revisit, F.lit("0")).otherwise(F.col("size")),
        "cache-control": F.concat(F.lit("max-age="), F.when(revisit, (n % 100).cast("string")).otherwise("60")),
        "set-cookie": F.when(revisit, F.lit("s=1")),
    }
    headers = F.map_filter(F.create_map(*[x for name, value in own.items() for x in (F.lit(name), value)]), lambda _, v: v.isNotNull())
    return rows.select(
        (n * 9 + k).alias("record_id"),
        F.when(shared, F.lit("http://common.example/")).when(revisit, F.concat("url", F.lit("#again"))).otherwise(F.col("url")).alias("url"),
        time.cast("long").alias("time"),
        F.when(revisit, F.lit("revisit")).otherwise("response").alias("kind"),
        F.when(revisit, 304).when((k == 1) & (n % 4 == 0), 503).otherwise(200).alias("status"),
        headers.alias("headers"),
        F.when(~revisit, F.md5(version)).alias("digest"),
    )


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
    return resolve(captures(read(spark, sf_dir, "pages"))).select("record_id", "url", "time", "refers_to", "verdict", lines.alias("headers"), "digest")


_CANONICAL = r"""CASE WHEN NOT regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN regexp_extract(u, '^([^#]*)', 1)
  ELSE regexp_replace(regexp_replace(lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)), '^(http://[^/]*):80$|^(https://[^/]*):443$', '\1\2'), '://www\.', '://')
       || CASE WHEN starts_with(rest, '/') THEN rest ELSE '/' || rest END END"""

SQL = {
    "op6_revisits": rf"""
WITH p AS (
  SELECT page_id AS n, url, md5(coalesce(html, '')) AS hash, CAST(octet_length(encode(coalesce(html, ''))) AS VARCHAR) AS size FROM pages
), versions AS (
  SELECT n, 0 AS common, v, url, size, md5(hash || CAST(v AS VARCHAR)) AS digest, 'day ' || CAST((n + v) % 365 AS VARCHAR) AS date FROM p, range(3) AS t(v)
  UNION ALL SELECT n, 1, 0, 'http://common.example/', size, md5('common' || CAST(n // 50 AS VARCHAR)), 'day ' || CAST(n // 50 AS VARCHAR) FROM p
), tagged AS (
  SELECT *, '"' || substr(digest, 1, 16) || '"' AS tag FROM versions
), r AS (
  SELECT CASE common WHEN 1 THEN n * 9 + 6 ELSE n * 9 + v END AS id, url AS u, CASE common WHEN 1 THEN n - n % 2 ELSE n + v * 3000 END AS t, tag, date, size, digest
  FROM tagged WHERE common = 1 OR v <> 1 OR n % 4 <> 0
), asks AS (
  SELECT *, n * 9 + 3 + v AS id, url || '#again' AS u, n + v * 3000 + CASE n % 11 WHEN 0 THEN -1 WHEN 1 THEN 0 ELSE 1 + n % 7 END AS t, v = 2 AS final FROM tagged WHERE common = 0
  UNION ALL SELECT t.*, n * 9 + 7 + i, url, n + i, i = 1 FROM tagged t, range(2) AS s(i) WHERE common = 1
), v AS (
  SELECT id, n, u, t, CASE n % 5 WHEN 0 THEN '"other"' WHEN 1 THEN NULL WHEN 2 THEN 'W/' || tag WHEN 3 THEN CASE WHEN NOT final THEN tag END ELSE tag END AS tag,
         CASE WHEN n % 5 = 1 THEN date END AS date FROM asks
), rc AS (
  SELECT *, {_CANONICAL} AS c FROM (SELECT *, regexp_extract(substr(u, length(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) + 1), '^([^#]*)', 1) AS rest FROM r)
), vc AS (
  SELECT *, {_CANONICAL} AS c FROM (SELECT *, regexp_extract(substr(u, length(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) + 1), '^([^#]*)', 1) AS rest FROM v)
), newest AS (
  SELECT * FROM rc QUALIFY row_number() OVER (PARTITION BY c, t ORDER BY id DESC) = 1
), m AS (
  SELECT vc.id, vc.n, vc.c, vc.t, vc.tag, vc.date, o.id AS rid, o.tag AS rtag, o.date AS rdate, o.size, o.digest
  FROM vc ASOF LEFT JOIN newest o ON vc.c = o.c AND vc.t > o.t
), d AS (
  SELECT *, CASE WHEN rid IS NULL THEN 'orphan' WHEN tag IS NOT NULL THEN CASE WHEN replace(tag, 'W/', '') = rtag THEN 'resolved' ELSE 'changed' END
                 WHEN date IS NOT NULL THEN CASE WHEN date = rdate THEN 'resolved' ELSE 'changed' END ELSE 'unchecked' END AS verdict FROM m
)
SELECT id AS record_id, c AS url, t AS time, rid AS refers_to, verdict,
       CASE WHEN verdict = 'resolved'
            THEN concat_ws(chr(10), 'cache-control: max-age=' || CAST(n % 100 AS VARCHAR), 'content-length: ' || size, 'content-type: text/html', 'etag: ' || coalesce(tag, rtag), 'last-modified: ' || coalesce(date, rdate))
            ELSE concat_ws(chr(10), 'cache-control: max-age=' || CAST(n % 100 AS VARCHAR), 'content-length: 0', 'etag: ' || tag, 'last-modified: ' || date, 'set-cookie: s=1') END AS headers,
       CASE WHEN verdict = 'resolved' THEN digest END AS digest
FROM d
""",
}
