"""Queries of the link family (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_audit.functions.text import FIVE_OR_MORE
from corpus_audit.operators import links as ops
from corpus_audit.plans import inputs
from corpus_audit.plans.registry import query, table

HOST = "regexp_extract({c}, '^https?://([^/?#:]*)', 1)"


def host(c: str) -> str:
    return HOST.replace("{c}", c)


@query("d1_extract_links", f"SELECT page_id, line_no, url, '官方来源' AS section FROM ({inputs.PAGE_REFS})")
def extract_links(spark, sf):
    # one Markdown link and the same bare url on a line are one reference each occurrence kind; the pages
    # never repeat a Markdown link on a line, so distinct rows describe the result fully
    return inputs.page_refs(spark, sf).select("page_id", "line_no", "url", "section")


AUTH_HOSTS = ["www.cheap-pills.example.com", "spam-farm.example.org", "thther.example.org", "blog.ththan.example.net"]
AUTH_SQL = ", ".join(f"'{h}'" for h in AUTH_HOSTS)


@query(
    "d2_collect_urls",
    f"""
SELECT url, {host('url')} AS host, {host('url')} IN ({AUTH_SQL}) AS authoritative, count(*) AS n_refs,
 count(DISTINCT page_id) AS n_codes, 1::BIGINT AS n_sections, count(DISTINCT page_id) AS n_files
FROM ({inputs.PAGE_REFS}) GROUP BY url
""",
)
def collect_urls(spark, sf):
    return ops.collect(inputs.page_refs(spark, sf), AUTH_HOSTS, FIVE_OR_MORE)


@query(
    "d2_url_members",
    f"""
SELECT DISTINCT url, 'code' AS member, printf('%05d', page_id) AS value FROM ({inputs.PAGE_REFS}) UNION ALL
SELECT DISTINCT url, 'section', '官方来源' FROM ({inputs.PAGE_REFS}) UNION ALL
SELECT DISTINCT url, 'file', {inputs.SQL_PAGE_PATH} FROM ({inputs.PAGE_REFS})
""",
)
def url_members(spark, sf):
    return ops.url_members(inputs.page_refs(spark, sf), FIVE_OR_MORE)


# probe attempts: five events of one user make one run over that user's page
ATTEMPTS_SQL = """
SELECT 'u' || user_id || '/' || (event_id // 500) AS url, event_id AS attempt, CASE WHEN user_id % 2 = 0 THEN 'GET' WHEN event_id % 3 = 0 THEN 'GET' ELSE 'HEAD' END AS method,
 CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 301 WHEN 'error' THEN 404 WHEN 'signup' THEN 405 END AS http_code,
 CASE WHEN event_type = 'purchase' THEN 'timeout ' || event_id END AS error, user_id % 2 = 0 AS authoritative, sha256(props) AS content_hash
FROM events
"""


@query(
    "d3_classify_probes",
    f"""
WITH a AS ({ATTEMPTS_SQL}), t AS (SELECT *, http_code IS NOT NULL AND NOT (method = 'HEAD' AND http_code IN (403, 405, 501)) AS decides FROM a),
v AS (SELECT url, arg_min(http_code, attempt) FILTER (WHERE decides) AS code, arg_min(content_hash, attempt) FILTER (WHERE decides) AS h,
  arg_max(coalesce(error, 'unreachable'), attempt) FILTER (WHERE NOT decides) AS fault, bool_or(authoritative) AS auth FROM t GROUP BY url)
SELECT url, CASE WHEN code IS NULL THEN 'inconclusive' WHEN code < 400 THEN 'ok' ELSE 'dead' END AS status, code AS http_code,
 CASE WHEN code < 400 AND auth THEN h END AS content_hash, CASE WHEN code IS NULL THEN fault ELSE '' END AS detail, auth AS authoritative FROM v
""",
)
def classify_probes(spark, sf):
    e, uid, eid = F.col("event_type"), F.col("user_id"), F.col("event_id")
    attempts = inputs.events(spark, sf).select(
        F.concat(F.lit("u"), uid.cast("string"), F.lit("/"), F.expr("event_id div 500").cast("string")).alias("url"),
        eid.alias("attempt"),
        F.when((uid % 2 == 0) | (eid % 3 == 0), F.lit("GET")).otherwise(F.lit("HEAD")).alias("method"),
        F.when(e == "view", 200).when(e == "click", 301).when(e == "error", 404).when(e == "signup", 405).alias("http_code"),
        F.when(e == "purchase", F.concat(F.lit("timeout "), eid.cast("string"))).alias("error"),
        (uid % 2 == 0).alias("authoritative"),
        F.sha2("props", 256).alias("content_hash"),
    )
    return ops.classify_probes(attempts)


DIFF_SQL = f"""
SELECT c.url, c.page_id, {host('c.url')} AS host, c.status, c.http_code, c.content_hash, c.authoritative,
 b.status AS baseline_status, b.content_hash AS baseline_hash,
 CASE WHEN b.url IS NULL THEN 'new' WHEN c.status = 'dead' AND b.status = 'ok' THEN 'went_dead' WHEN c.status = 'ok' AND b.status = 'dead' THEN 'recovered'
      WHEN c.authoritative AND c.status = 'ok' AND c.content_hash <> b.content_hash THEN 'content_changed' END AS change
FROM ({inputs.CURRENT}) c LEFT JOIN ({inputs.BASELINE}) b ON b.url = c.url
"""


def findings(spark, sf):
    return ops.diff(inputs.current_probes(spark, sf), inputs.baseline_probes(spark, sf))


@query("d4_diff_baseline", DIFF_SQL)
def diff_baseline(spark, sf):
    return findings(spark, sf)


# whole-week liveness per page, rolled up by registered host family
ROT_SQL = f"""
SELECT split_part({host('url')}, '.', -2) || '.' || split_part({host('url')}, '.', -1) AS host, count(*) AS total, count(*) FILTER (WHERE status = 'dead') AS dead
FROM ({DIFF_SQL}) GROUP BY 1 HAVING count(*) >= 3 AND count(*) FILTER (WHERE status = 'dead') >= 3 AND count(*) FILTER (WHERE status = 'dead') * 100 >= count(*) * 18
"""


def _family(spark, sf):
    parts = F.split("host", r"\.")
    name = F.concat_ws(".", F.element_at(parts, -2), F.element_at(parts, -1))
    return findings(spark, sf).withColumn("host", name)


@query("d5_bulk_rot", ROT_SQL)
def bulk_rot(spark, sf):
    return ops.bulk_rot(_family(spark, sf), percent=18)


ADVICE = "CASE change WHEN 'went_dead' THEN '{}' ELSE '{}' END".format(*ops.RECOMMENDATION.values())


@query(
    "d6_actionable",
    f"""
WITH f AS (SELECT url, change, split_part(host, '.', -2) || '.' || split_part(host, '.', -1) AS host FROM ({DIFF_SQL}))
SELECT url, host, change, {ADVICE} AS recommendation, host IN (SELECT host FROM ({ROT_SQL})) AS in_bulk_host FROM f WHERE change IN ('went_dead', 'content_changed')
""",
)
def actionable(spark, sf):
    found = _family(spark, sf)
    return ops.actionable(found, ops.bulk_rot(found, percent=18))


NEXT_SQL = f"""
SELECT c.url, CASE WHEN k THEN b.status ELSE c.status END AS status, CASE WHEN k THEN b.http_code ELSE c.http_code END AS http_code, c.authoritative,
 CASE WHEN k THEN b.content_hash ELSE c.content_hash END AS content_hash
FROM (SELECT c0.*, b0.url IS NOT NULL AND c0.status = 'inconclusive' AS k FROM ({inputs.CURRENT}) c0 LEFT JOIN ({inputs.BASELINE}) b0 ON b0.url = c0.url) c
LEFT JOIN ({inputs.BASELINE}) b ON b.url = c.url
"""


def persisted(spark, sf):
    return ops.next_baseline(inputs.current_probes(spark, sf), inputs.baseline_probes(spark, sf))


@query("d7_next_baseline", NEXT_SQL)
def next_baseline(spark, sf):
    return persisted(spark, sf)


@query(
    "d7_next_members",
    f"""
SELECT DISTINCT url, 'code' AS member, printf('%05d', page_id) AS value FROM ({inputs.PAGE_REFS}) UNION ALL
SELECT DISTINCT url, 'section', '官方来源' FROM ({inputs.PAGE_REFS})
""",
)
def next_members(spark, sf):
    return ops.next_members(inputs.page_refs(spark, sf), FIVE_OR_MORE)


@query(
    "d8_summary",
    f"""
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status = 'dead') AS dead, count(*) FILTER (WHERE status = 'inconclusive') AS inconclusive,
 count(*) FILTER (WHERE change = 'new') AS n_new, count(*) FILTER (WHERE change = 'went_dead') AS n_went_dead, count(*) FILTER (WHERE change = 'recovered') AS n_recovered,
 count(*) FILTER (WHERE change = 'content_changed') AS n_content_changed FROM ({DIFF_SQL})
""",
)
def summary(spark, sf):
    return ops.summary(findings(spark, sf))


@query("d9_official_snapshot", f"SELECT * FROM ({NEXT_SQL}) WHERE authoritative AND ({host('url')} = 'example.org' OR {host('url')} LIKE '%.example.org')")
def official_snapshot(spark, sf):
    return ops.official_snapshot(persisted(spark, sf), "example.org")


@query(
    "d10_canonical_url_per_code",
    f"""
SELECT printf('%05d', l_partkey) AS code, min(url) AS url FROM lineitem JOIN pages ON page_id = l_suppkey GROUP BY 1
""",
)
def canonical_url_per_code(spark, sf):
    pages = table(spark, sf, "pages")
    codes = table(spark, sf, "lineitem").join(pages, F.col("page_id") == F.col("l_suppkey")).select(
        "url", inputs.padded(F.col("l_partkey")).alias("code")
    )
    return ops.canonical_url_per_code(pages.select("url").distinct(), codes)


# a baseline made from orders, with defects by key arithmetic
ENTRIES_SQL = """
SELECT 'u' || o_orderkey AS url, CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'dead' ELSE CASE WHEN o_custkey % 9 = 0 THEN 'odd' ELSE 'inconclusive' END END AS status,
 CASE WHEN o_orderkey % 11 = 0 THEN 599 WHEN o_orderstatus = 'F' THEN 200 WHEN o_orderstatus = 'O' THEN 404 END AS http_code,
 o_custkey % 2 = 0 AS authoritative, CASE WHEN o_custkey % 2 = 0 AND o_orderkey % 13 <> 0 THEN sha256(o_orderpriority) WHEN o_orderkey % 17 = 0 THEN 'zz' END AS content_hash,
 CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE o_orderpriority END AS section, CASE WHEN o_orderkey % 23 = 0 THEN 'x1' ELSE printf('%05d', o_custkey) END AS code FROM orders
"""


@query(
    "d11_coherence",
    f"""
WITH e AS ({ENTRIES_SQL})
SELECT 'status_value' AS rule, url AS entity FROM e WHERE status = 'odd' UNION ALL
SELECT 'ok_code', url FROM e WHERE status = 'ok' AND (http_code IS NULL OR http_code NOT BETWEEN 200 AND 399) UNION ALL
SELECT 'dead_code', url FROM e WHERE status = 'dead' AND (http_code IS NULL OR http_code NOT BETWEEN 400 AND 599) UNION ALL
SELECT 'inconclusive_code', url FROM e WHERE status = 'inconclusive' AND http_code IS NOT NULL UNION ALL
SELECT 'hash_unexpected', url FROM e WHERE NOT authoritative AND content_hash IS NOT NULL UNION ALL
SELECT 'hash_missing', url FROM e WHERE authoritative AND status = 'ok' AND NOT coalesce(regexp_full_match(content_hash, '[0-9a-f]{{64}}'), false) UNION ALL
SELECT 'hash_shape', url FROM e WHERE authoritative AND status <> 'ok' AND content_hash IS NOT NULL AND NOT regexp_full_match(content_hash, '[0-9a-f]{{64}}') UNION ALL
SELECT 'sections_empty', url FROM e WHERE section = '' UNION ALL
SELECT 'code_shape', url FROM e WHERE NOT regexp_full_match(code, '{FIVE_OR_MORE}') UNION ALL
SELECT 'code_unknown', url FROM e WHERE regexp_full_match(code, '{FIVE_OR_MORE}') AND code NOT IN (SELECT printf('%05d', c_custkey) FROM customer WHERE c_acctbal > 0)
""",
)
def coherence(spark, sf):
    key, cust, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    entries = table(spark, sf, "orders").select(
        F.concat(F.lit("u"), key.cast("string")).alias("url"),
        F.when(st == "F", "ok").when(st == "O", "dead").when(cust % 9 == 0, "odd").otherwise("inconclusive").alias("status"),
        F.when(key % 11 == 0, 599).when(st == "F", 200).when(st == "O", 404).alias("http_code"),
        (cust % 2 == 0).alias("authoritative"),
        F.when((cust % 2 == 0) & (key % 13 != 0), F.sha2("o_orderpriority", 256)).when(key % 17 == 0, "zz").alias("content_hash"),
        F.when(key % 19 == 0, "").otherwise(F.col("o_orderpriority")).alias("section"),
        F.when(key % 23 == 0, "x1").otherwise(inputs.padded(cust)).alias("code"),
    )
    catalog = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0).select(
        inputs.padded(F.col("c_custkey")).alias("code")
    )
    found = ops.coherence(entries, entries.select("url", "code"), entries.select("url", "section"), catalog, FIVE_OR_MORE)
    return found.select("rule", "entity")


@query(
    "d12_set_equal",
    """
(SELECT DISTINCT o_custkey AS value, 'left_only' AS side FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))
UNION ALL (SELECT DISTINCT c_custkey, 'right_only' FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders))
""",
)
def set_equal(spark, sf):
    left = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    right = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("k"))
    return ops.set_equal(left, right, "k")


@query(
    "d13_broken_relative",
    f"""
WITH p AS (SELECT page_id, 'en/' || page_id || '/index.md' AS path FROM pages),
l AS (SELECT 'en/' || page_id || '/index.md' AS page, '../' || (page_id + 1) || '/./index.md#top' AS href, 'en/' || (page_id + 1) || '/index.md' AS target FROM pages UNION ALL
 SELECT 'en/' || page_id || '/index.md', href, ltrim(regexp_replace(href, '[?#].*$', ''), '/') FROM ({inputs.PAGE_LINKS}))
SELECT page, href, target FROM l WHERE target NOT IN (SELECT path FROM p)
""",
)
def broken_relative(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.concat(F.lit("en/"), F.col("page_id").cast("string"), F.lit("/index.md")).alias("path"))
    chain = pages.select(
        F.col("path").alias("page"),
        F.concat(F.lit("../"), (F.col("page_id") + 1).cast("string"), F.lit("/./index.md#top")).alias("href"),
    )
    found = inputs.page_links(spark, sf).select(
        F.concat(F.lit("en/"), F.col("page_id").cast("string"), F.lit("/index.md")).alias("page"), "href"
    )
    outside = table(spark, sf, "pages").select(
        F.concat(F.lit("en/"), F.col("page_id").cast("string"), F.lit("/index.md")).alias("page"), F.col("url").alias("href")
    )
    return ops.broken_relative(chain.unionByName(found).unionByName(outside), pages)


@query(
    "d14_missing_edges",
    """
WITH e AS (SELECT DISTINCT page_id AS entity, CASE WHEN event_type = 'view' THEN 'index' WHEN event_type = 'click' THEN 'plan' ELSE 'sources' END AS src,
  CASE event_id % 3 WHEN 0 THEN 'index' WHEN 1 THEN 'plan' ELSE 'sources' END AS dst FROM events JOIN pages ON page_id = user_id),
k AS (SELECT unnest(['index', 'plan', 'sources']) AS kind)
SELECT page_id AS entity, a.kind AS src, b.kind AS dst, 'missing' AS problem FROM pages, k a, k b WHERE a.kind <> b.kind
 AND NOT EXISTS (SELECT 1 FROM e WHERE e.entity = page_id AND e.src = a.kind AND e.dst = b.kind)
UNION ALL SELECT entity, src, dst, 'self_link' FROM e WHERE src = dst
""",
)
def missing_edges(spark, sf):
    kinds = ["index", "plan", "sources"]
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("entity"))
    e, i = F.col("event_type"), F.col("event_id") % 3
    edges = (
        inputs.events(spark, sf)
        .join(pages, F.col("user_id") == F.col("entity"))
        .select(
            "entity",
            F.when(e == "view", "index").when(e == "click", "plan").otherwise("sources").alias("src"),
            F.when(i == 0, "index").when(i == 1, "plan").otherwise("sources").alias("dst"),
        )
    )
    return ops.missing_edges(pages, "entity", kinds, edges)
