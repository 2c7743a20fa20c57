"""URL filters over redirect equivalence, by DataFrame operations alone.

Rules are (host, path) pairs with a verdict. A rule fits its host and all subdomains if the URL's path
starts with the rule's path; the longest host wins, and of equal hosts the longest path. URLs that no
rule fits follow their aliases: redirects (meta refresh) and canonical links of pages are edges between
addresses, an address and its form without a fragment are the same, and the connected components of
these are classes of one page. References are decoded from HTML, resolved against their page, and freed of
dot segments; an empty path is "/". Entities other than numbers and the few named here stay as written. A class with a blocked member and no explicitly allowed one is blocked;
else its members without a rule are allowed. A rule always decides for its own URLs: an explicit allow
is never overruled by an alias.

Rules are a small literal list of the caller. Hot hosts or link targets are hubs of the component
search, which splits them. Null URLs, and those without "://", have an empty host and path, no rule
and no alias, and are allowed. Repeated pages are judged each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import read
from tallyhouse.llm.components import connected_components

RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: HTML entities that are read by name (fixed values); numbers are read too.
ENTITIES = (("amp", "&"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"))
ENTITY = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|amp|lt|gt|quot|apos);"
#: Tags that name an alias, and where they name it; for Spark and SQL alike.
LINK = r"""(?is)(<link\b[^>]*\srel\s*=\s*(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"[^>]*|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'[^>]*|canonical(?:[\s/][^>]*)?)>)"""
META = r"""(?is)(<meta\b[^>]*\shttp-equiv\s*=\s*["']?refresh\b[^>]*>)"""
HREF = r"""(?is)\shref\s*=\s*["']?\s*([^"'\s>]+)"""
TARGET = r"""(?is)\burl\s*=\s*['"]?([^"'\s>]+)"""
_SCHEME, _DOTS, _FOLDER, _BARE = "^[A-Za-z][A-Za-z0-9+.-]*:", r"/\.{1,2}(/|$)", "^([^:/?#]+://[^/?#]*/[^?#]*/|[^:/?#]+://[^/?#]*/|[^:/?#]+://[^/?#]*)", "^[^:/?#]+://[^/?#]*$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A to Z lower-cased, and the path up to a query or fragment; empty without "://"."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def address(url: Column) -> Column:
    """What a server is asked for: no fragment, a lower-case host, no dot segments, "/" for an empty path."""
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.length(url))
    own = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    scheme = F.translate(F.substring(url, F.lit(1), at - 1), _UPPER, _LOWER)
    tail = F.regexp_extract(F.substring(rest, F.length(own) + 1, F.length(rest)), r"^([^#]*)", 1)
    path = F.regexp_extract(tail, r"^([^?]*)", 1)
    query = F.substring(tail, F.length(path) + 1, F.length(tail))
    return F.when(at > 0, F.concat(scheme, F.lit("://"), F.translate(own, _UPPER, _LOWER), without_dots(path), query))


def without_dots(path: Column) -> Column:
    """`path` (empty, or with a leading slash) with "." and ".." segments carried out."""
    step = lambda done, one: F.when(one == ".", done).when(one == "..", F.regexp_replace(done, "/[^/]*$", "")).otherwise(F.concat(done, F.lit("/"), one))
    short = F.aggregate(F.split(F.substring(path, F.lit(2), F.length(path)), "/"), F.lit(""), step)
    short = F.concat(short, F.when(path.rlike(r"/\.{1,2}$"), "/").otherwise(""))
    return F.when(path == "", "/").when(path.rlike(_DOTS), short).otherwise(path)


def decoded(text: Column) -> Column:
    """`text` of an HTML attribute with its entities as characters, each decoded once."""
    digits = lambda e, skip, base: F.conv(F.substring(e, skip, 10), base, 10).cast("int")
    code = lambda e: F.when(e.rlike("^&#[xX]"), digits(F.rtrim(e, F.lit(";")), 4, 16)).when(e.startswith("&#"), digits(F.rtrim(e, F.lit(";")), 3, 10))
    named = lambda e: F.coalesce(*[F.when(e == f"&{name};", value) for name, value in ENTITIES], e)
    sound = lambda n: n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
    letter = lambda e: F.when(sound(code(e)), F.decode(F.unhex(F.lpad(F.hex(code(e)), 8, "0")), "UTF-32")).otherwise(named(e))
    between, found = F.split(text, ENTITY, -1), F.transform(F.regexp_extract_all(text, F.lit(f"({ENTITY})"), 1), letter)
    pairs = F.zip_with(between, found, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(text.rlike(ENTITY), F.array_join(pairs, "")).otherwise(text)


def ruled(host: Column, path: Column, rules=RULES) -> Column:
    """The best rule as a struct (rule, verdict), or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), -len(r[1])))
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    return F.coalesce(*[F.when(fits(h, p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for h, p, v in ordered])


def alias_edges(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b) addresses of pages and of what their redirects and canonical links name."""
    tag = lambda pattern: F.regexp_extract(F.col(html), pattern, 1)
    named = F.array(F.regexp_extract(tag(LINK), HREF, 1), F.regexp_extract(tag(META), TARGET, 1))
    found = pages.select(F.col(url).alias("u"), F.explode(named).alias("raw")).filter("u IS NOT NULL AND raw <> ''")
    found = found.select("u", decoded(F.col("raw")).alias("to"))
    base = lambda pattern: F.regexp_extract("u", pattern, 1)
    folder = base(_FOLDER)
    absolute = (
        F.when(F.col("to").rlike(_SCHEME), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat(base(r"^([^:/?#]+:)"), F.col("to")))
        .when(F.col("to").startswith("/"), F.concat(base(r"^([^:/?#]+://[^/?#]*)"), F.col("to")))
        .when(F.col("to").startswith("?"), F.concat(base(r"^([^?#]*)"), F.col("to")))
        .when(F.col("to").startswith("#"), F.concat(base(r"^([^#]*)"), F.col("to")))
        .otherwise(F.concat(folder, F.when(folder.rlike(_BARE), "/").otherwise(""), F.col("to")))
    )
    return found.select(address(F.col("u")).alias("a"), address(absolute).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")


def judge(pages: DataFrame, edges: DataFrame, *, url: str = "url", rules=RULES) -> DataFrame:
    """`pages` with `_host`, `_path`, `_rule` and `_verdict`. `edges` are pairs (a, b) of addresses."""
    host, path = host_and_path(F.col(url))
    own = pages.withColumns({"_host": host, "_path": path, "_address": address(F.col(url))})
    own = own.withColumn("_best", ruled(F.col("_host"), F.col("_path"), rules))
    classes = connected_components(edges)
    node_host, node_path = host_and_path(F.col("node"))
    verdict = ruled(node_host, node_path, rules)["verdict"]
    decided = classes.groupBy("component").agg(F.max(F.coalesce(verdict == "block", F.lit(False))).alias("b"), F.max(F.coalesce(verdict == "allow", F.lit(False))).alias("w"))
    blocked = decided.filter("b AND NOT w").select("component")
    aliases = classes.join(blocked, "component", "left_semi").select(F.col("node").alias("_address"), F.lit("block").alias("_inherited"))
    return (
        own.join(aliases, "_address", "left")
        .withColumns({"_rule": F.col("_best.rule"), "_verdict": F.coalesce("_best.verdict", "_inherited", F.lit("allow"))})
        .drop("_best", "_inherited", "_address")
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    judged = judge(pages.select("page_id", "url"), alias_edges(pages))
    return judged.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))


def _sql_parts(u: str) -> tuple[str, str, str]:
    """Host, path and address of a URL expression in SQL."""
    at = f"strpos({u}, '://')"
    rest = f"substr({u}, {at} + 3)"
    raw = f"regexp_extract({rest}, '^([^/?#]*)', 1)"
    fold = lambda x: f"translate({x}, '{_UPPER}', '{_LOWER}')"
    tail = f"substr({rest}, length({raw}) + 1)"
    host = f"CASE WHEN {at} > 0 THEN {fold(raw)} ELSE '' END"
    path = f"CASE WHEN {at} > 0 THEN regexp_extract({tail}, '^([^?#]*)', 1) ELSE '' END"
    target = f"regexp_extract({tail}, '^([^#]*)', 1)"
    asked = f"regexp_extract({target}, '^([^?]*)', 1)"
    folded = f"list_reduce(string_split(substr({asked}, 2), '/'), lambda done, one: CASE one WHEN '.' THEN done WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || one END, '')"
    clean = rf"CASE WHEN {asked} = '' THEN '/' WHEN regexp_matches({asked}, '{_DOTS}') THEN {folded} || CASE WHEN regexp_matches({asked}, '/\.{{1,2}}$') THEN '/' ELSE '' END ELSE {asked} END"
    whole = f"CASE WHEN {at} > 0 THEN {fold(f'substr({u}, 1, {at} - 1)')} || '://' || {fold(raw)} || {clean} || substr({target}, length({asked}) + 1) END"
    return host, path, whole


def _sql_rule(host: str, path: str, what: str) -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r[0]), -len(r[1])))
    cases = " ".join(f"WHEN ({host} = '{h}' OR ends_with({host}, '.{h}')) AND starts_with({path}, '{p}') THEN '{h + p if what == 'rule' else v}'" for h, p, v in ordered)
    return f"CASE {cases} END"


_HOST, _PATH, _ADDRESS = _sql_parts("u")
_quoted = lambda text: "'" + text.replace("'", "''") + "'"
_NAMED = [f"regexp_extract(regexp_extract(html, {_quoted(tag)}, 1), {_quoted(place)}, 1)" for tag, place in ((LINK, HREF), (META, TARGET))]
_NAMES = " ".join(f"WHEN '&{name};' THEN {_quoted(value)}" for name, value in ENTITIES)
_CODE = "CASE WHEN regexp_matches(e, '^&#[xX]') THEN CAST('0x' || rtrim(substr(e, 4), ';') AS INTEGER) WHEN starts_with(e, '&#') THEN CAST(rtrim(substr(e, 3), ';') AS INTEGER) END"
_LETTER = f"CASE WHEN {_CODE} BETWEEN 1 AND 55295 OR {_CODE} BETWEEN 57344 AND 1114111 THEN chr({_CODE}) ELSE CASE e {_NAMES} ELSE e END END"
_DECODED = f"""list_reduce(list_transform(list_zip(string_split_regex(raw, '{ENTITY}'), regexp_extract_all(raw, '{ENTITY}')),
    lambda x: x[1] || coalesce(list_transform([x[2]], lambda e: {_LETTER})[1], '')), lambda x, y: x || y)"""

SQL = {
    "op3_url_filter": rf"""
WITH RECURSIVE p AS (
  SELECT page_id, u, {_HOST} AS host, {_PATH} AS path, {_ADDRESS} AS address FROM (SELECT page_id, coalesce(url, '') AS u FROM pages)
), named AS (
  SELECT url AS v, {_NAMED[0]} AS raw FROM pages UNION ALL SELECT url, {_NAMED[1]} FROM pages
), decoded AS (
  SELECT v, {_DECODED} AS target FROM named WHERE v IS NOT NULL AND raw <> ''
), absolute AS (
  SELECT v, CASE WHEN regexp_matches(target, '{_SCHEME}') THEN target
    WHEN starts_with(target, '//') THEN regexp_extract(v, '^([^:/?#]+:)', 1) || target
    WHEN starts_with(target, '/') THEN regexp_extract(v, '^([^:/?#]+://[^/?#]*)', 1) || target
    WHEN starts_with(target, '?') THEN regexp_extract(v, '^([^?#]*)', 1) || target
    WHEN starts_with(target, '#') THEN regexp_extract(v, '^([^#]*)', 1) || target
    ELSE regexp_extract(v, '{_FOLDER}', 1) || CASE WHEN regexp_matches(regexp_extract(v, '{_FOLDER}', 1), '{_BARE}') THEN '/' ELSE '' END || target END AS w
  FROM decoded
), edges AS (
  SELECT {_sql_parts('v')[2]} AS a, {_sql_parts('w')[2]} AS b FROM absolute
), both_ways AS (
  SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b
), reach AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
), decided AS (
  SELECT a, bool_or(verdict = 'block') AS b, bool_or(verdict = 'allow') AS w
  FROM (SELECT a, {_sql_rule('host', 'path', 'verdict')} AS verdict FROM (SELECT a, {_HOST} AS host, {_PATH} AS path FROM (SELECT a, b AS u FROM reach))) GROUP BY a
)
SELECT page_id, host, path, {_sql_rule('host', 'path', 'rule')} AS rule,
       coalesce({_sql_rule('host', 'path', 'verdict')}, CASE WHEN d.b AND NOT coalesce(d.w, FALSE) THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN decided d ON d.a = p.address
""",
}
