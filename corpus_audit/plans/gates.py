"""Queries of the schedule (I), gate, maturity and report (J) and streaming (K) families."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_audit.findings import no_findings, whole_findings
from corpus_audit.functions import text as tx
from corpus_audit.operators import maturity, report
from corpus_audit.operators import gates as ops
from corpus_audit.operators import schedule as sched
from corpus_audit.plans import content as content_plans
from corpus_audit.plans import evidence as evidence_plans
from corpus_audit.plans import inputs
from corpus_audit.plans import text as text_plans
from corpus_audit.plans.registry import ORACLES, QUERIES, query, table, wide
from corpus_audit.session import scratch_dir
from corpus_audit.sources import files
from corpus_audit.streaming import monitor

# -- schedules ----------------------------------------------------------------------------------

EXAMS = """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN strftime(o_orderdate, '%Y-%m') || '-31' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS exam_date,
 CASE WHEN o_custkey % 6 > 0 THEN (o_custkey % 6)::DOUBLE - 1 END AS weekly_hours FROM orders
"""


def exams(spark, sf):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(k % 5 == 1, F.concat(F.date_format(d, "yyyy-MM"), F.lit("-31"))).when(k % 5 != 0, F.date_format(d, "yyyy-MM-dd")).alias("exam_date"),
        F.when(F.col("o_custkey") % 6 > 0, (F.col("o_custkey") % 6).cast("double") - 1).alias("weekly_hours"),
    )


@query(
    "i1_schedule_inputs",
    f"""
WITH e AS (SELECT *, try_cast(exam_date AS DATE) AS d FROM ({EXAMS}))
SELECT o_orderkey, d AS exam_date, CASE WHEN weekly_hours > 0 THEN weekly_hours END AS weekly_hours,
 CASE WHEN exam_date IS NOT NULL AND d IS NULL THEN 'invalid' WHEN exam_date IS NULL OR NOT coalesce(weekly_hours > 0, false) THEN 'named_gap' ELSE 'planned' END AS status,
 concat_ws('、', CASE WHEN exam_date IS NULL THEN 'exam_date' END, CASE WHEN NOT coalesce(weekly_hours > 0, false) THEN 'weekly_hours' END) AS missing FROM e
""",
)
def schedule_inputs(spark, sf):
    return sched.inputs(exams(spark, sf), "o_orderkey")


SPREAD_SQL = """
WITH p AS (SELECT DISTINCT l_partkey, l_orderkey, l_linenumber FROM lineitem),
r AS (SELECT l_partkey, l_orderkey || '-' || l_linenumber AS point_id, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) - 1 AS i, count(*) OVER (PARTITION BY l_partkey) AS n FROM p),
x AS (SELECT r.*, h, DATE '2026-03-01' + (l_partkey % 30)::INT AS exam, (l_partkey % 9 + 1)::DOUBLE AS hours FROM r, (SELECT unnest([30, 14, 7]) AS h)),
y AS (SELECT x.*, (SELECT min(d) FROM range(1, h + 1) u(d) WHERE ((d - 1) * n) // h <= i AND i < (d * n) // h) AS od FROM x),
z AS (SELECT *, dense_rank() OVER (PARTITION BY l_partkey, h ORDER BY od) AS day FROM y)
SELECT l_partkey, point_id, h AS horizon_days, day, exam - (h - 1) + (day - 1)::INT AS date, exam - (h - 1) AS start_date, exam AS end_date, round_even(hours * 60 / 7, 0)::INT AS daily_minutes,
 CASE WHEN od <= ceil(h / 2) THEN 'read' WHEN od <= ceil(h / 2) + ceil(h / 4) THEN 'drill' ELSE 'review' END AS kind FROM z
"""


def _plans(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.date_add(F.to_date(F.lit("2026-03-01")), (F.col("p_partkey") % 30).cast("int")).alias("exam_date"),
        (F.col("p_partkey") % 9 + 1).cast("double").alias("weekly_hours"),
    )


def _study_points(spark, sf):
    return table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber").distinct().withColumn(
        "point_id", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    )


def spread_rows(spark, sf):
    return sched.spread(
        _study_points(spark, sf), _plans(spark, sf), "l_partkey", ["l_orderkey", "l_linenumber"], F.floor(F.col("l_orderkey") / 100000)
    )


@query("i2_spread", SPREAD_SQL)
def spread(spark, sf):
    return spread_rows(spark, sf)


@query(
    "i2_day_items",
    f"""
WITH s AS ({SPREAD_SQL}) SELECT l_partkey, horizon_days, day, date, kind, count(*) AS n_points,
 arg_min(point_id, (split_part(point_id, '-', 1)::BIGINT, split_part(point_id, '-', 2)::BIGINT)) AS focus_point FROM s GROUP BY ALL
""",
)
def day_items(spark, sf):
    rows = spread_rows(spark, sf).withColumn("_k", F.transform(F.split("point_id", "-"), lambda x: x.cast("bigint")))
    return sched.day_items(rows, "l_partkey", "_k")


@query(
    "i3_spaced_repetition",
    "SELECT p_partkey, o AS offset_days, DATE '2026-03-01' + o AS review_date FROM part, (SELECT unnest([1, 3, 7]) AS o)",
)
def spaced_repetition(spark, sf):
    points = table(spark, sf, "part").select("p_partkey", F.to_date(F.lit("2026-03-01")).alias("start"))
    return sched.spaced_repetition(points, start="start").drop("start")


@query(
    "i4_validate_schedule",
    """
WITH p AS (SELECT o_orderkey, t AS tier_pos, CASE WHEN o_custkey % 20 = 0 THEN 10 ELSE [30, 14, 7][t] END AS h, o_custkey % 5 AS hours, o_totalprice, o_orderpriority, o_custkey FROM orders, (SELECT unnest([1, 2, 3]) AS t) WHERE NOT (o_orderpriority = '5-LOW' AND t = 3)),
i AS (SELECT DISTINCT l_orderkey AS o_orderkey, l_linenumber AS day, l_suppkey, CASE l_returnflag WHEN 'A' THEN 'read' WHEN 'N' THEN 'drill' ELSE 'rest' END AS kind, l_shipdate::DATE AS date FROM lineitem),
d AS (SELECT o_orderkey, day, min(date) AS a, max(date) AS z FROM i GROUP BY ALL)
SELECT 'horizon_order' AS rule, o_orderkey::VARCHAR AS entity FROM p WHERE h = 10 UNION ALL
SELECT 'end_date', o_orderkey::VARCHAR FROM p WHERE o_custkey % 31 = 0 UNION ALL
SELECT 'start_date', o_orderkey::VARCHAR FROM p WHERE o_custkey % 37 = 0 UNION ALL
SELECT 'weekly_hours', o_orderkey::VARCHAR FROM p WHERE hours = 0 UNION ALL
SELECT 'daily_minutes', o_orderkey::VARCHAR FROM p WHERE round_even(hours * 60 / 7, 0) <> CASE WHEN hours = 3 THEN 25 ELSE round_even(hours * 60 / 7, 0) END UNION ALL
SELECT 'plan_count', o_orderkey::VARCHAR FROM p GROUP BY o_orderkey HAVING count(*) <> 3 UNION ALL
SELECT 'kind', o_orderkey::VARCHAR FROM i WHERE kind = 'rest' UNION ALL
SELECT 'day_sequence', o_orderkey::VARCHAR FROM d GROUP BY o_orderkey HAVING min(day) <> 1 OR max(day) <> count(*) UNION ALL
SELECT 'date_order', d.o_orderkey::VARCHAR FROM d JOIN d n ON n.o_orderkey = d.o_orderkey AND n.day = d.day + 1 WHERE n.a <= d.z UNION ALL
SELECT 'point_unknown', o_orderkey::VARCHAR FROM i WHERE l_suppkey % 10 = 0
""",
)
def validate_schedule(spark, sf):
    cust = F.col("o_custkey")
    tiers = F.posexplode(F.array(*[F.lit(h) for h in sched.HORIZONS])).alias("t", "h")
    hours = (cust % 5).cast("double")
    exam = F.to_date("o_orderdate")
    plans = (
        table(spark, sf, "orders").select("*", tiers)
        .filter(~((F.col("o_orderpriority") == "5-LOW") & (F.col("t") == 2)))
        .select(
            "o_orderkey", (F.col("t") + 1).alias("tier_pos"), F.when(cust % 20 == 0, 10).otherwise(F.col("h")).alias("horizon_days"),
            exam.alias("exam_date"), F.when(cust % 31 == 0, F.date_add(exam, 1)).otherwise(exam).alias("end_date"), hours.alias("weekly_hours"), cust.alias("c"),
            F.when(cust % 5 == 3, F.lit(25.0)).otherwise(F.bround(hours * 60 / 7)).alias("daily_minutes"),
        )
        .withColumn("start_date", F.expr("date_sub(exam_date, horizon_days - CASE WHEN c % 37 = 0 THEN 2 ELSE 1 END)"))
    )
    flag = F.col("l_returnflag")
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.lit(30).alias("horizon_days"), F.col("l_linenumber").alias("day"), F.to_date("l_shipdate").alias("date"),
        F.when(flag == "A", "read").when(flag == "N", "drill").otherwise("rest").alias("kind"), F.col("l_suppkey").alias("point_id"),
    ).distinct()
    points = items.filter(F.col("point_id") % 10 != 0).select("o_orderkey", "point_id")
    return sched.validate(items, plans, points, "o_orderkey").select("rule", "entity")


@query(
    "i5_first_divergence",
    """
WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem), a AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS pos, l_partkey AS item FROM l),
c AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber) AS pos, l_partkey AS item FROM l WHERE l_linenumber < 7),
d AS (SELECT coalesce(a.l_orderkey, c.l_orderkey) AS l_orderkey, coalesce(a.pos, c.pos) AS pos, a.item AS actual, c.item AS expected FROM a FULL JOIN c ON a.l_orderkey = c.l_orderkey AND a.pos = c.pos WHERE a.item IS DISTINCT FROM c.item)
SELECT l_orderkey, min(pos) AS pos, arg_min(struct_pack(v := actual), pos).v AS actual, arg_min(struct_pack(v := expected), pos).v AS expected FROM d GROUP BY l_orderkey
""",
)
def first_divergence(spark, sf):
    from corpus_audit.scale import ranked

    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    a = ranked(rows, ["l_orderkey"], [F.col("l_linenumber"), F.col("l_partkey")], F.col("l_linenumber"), "pos")
    c = ranked(
        rows.filter(F.col("l_linenumber") < 7), ["l_orderkey"], [F.col("l_partkey"), F.col("l_linenumber")], F.floor(F.col("l_partkey") / 100000), "pos"
    )
    item = F.col("l_partkey").alias("item")
    return sched.first_divergence(a.select("l_orderkey", "pos", item), c.select("l_orderkey", "pos", item), "l_orderkey")


# -- gates --------------------------------------------------------------------------------------

# Markdown pages made from orders: course and major pages with defects by key arithmetic
def gate_pages(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    code = F.when(k % 17 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(inputs.padded(k))
    major = F.concat(inputs.padded(k, 6), F.when(k % 19 == 0, "ZZ").when(k % 3 == 0, "K").otherwise(""))
    is_major = F.col("o_orderstatus") == "P"
    return wide(spark, sf, "orders").select(
        "o_orderkey",
        F.when(is_major, F.concat(F.lit("a/majors/"), major, F.lit("-name/index.md"))).otherwise(F.concat(F.lit("a/courses/"), code, F.lit("/index.md"))).alias("path"),
        F.concat(
            F.lit("---\nlifecycle: "), F.when(c % 7 == 0, "odd").otherwise("draft"), F.lit("\n---\n| 字段 | 内容 |\n| --- | --- |\n| 省份 | x |\n| 专业名称 | y |\n"),
            F.when(c % 5 == 0, "").otherwise("| 层次 | z |\n"), F.when(is_major, F.concat(F.lit("| 专业代码 | "), major, F.lit(" |\n"))).otherwise(""),
            F.lit("| 资料状态 | "), F.when(c % 11 == 0, "bad").otherwise("complete"), F.lit(" |\n| 最后核验日期 | "),
            F.when(c % 13 == 0, "2024/01/01").otherwise("2024-01-01"), F.lit(" |\n"),
            F.when(c % 23 == 0, "see https://github.com/o/private-store/raw/x\n").otherwise(""), F.when(c % 29 == 0, "`e-books/a.pdf`\n").otherwise(""),
        ).alias("text"),
    )


CONTENT_GATE_SQL = """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus = 'P' AS major, printf('%05d', o_orderkey) AS code, printf('%06d', o_orderkey) || CASE WHEN o_orderkey % 19 = 0 THEN 'ZZ' WHEN o_orderkey % 3 = 0 THEN 'K' ELSE '' END AS mcode FROM orders),
p AS (SELECT *, CASE WHEN major THEN 'a/majors/' || mcode || '-name/index.md' ELSE 'a/courses/' || CASE WHEN k % 17 = 0 THEN 'x' || k ELSE code END || '/index.md' END AS path FROM o)
SELECT 'private_url' AS rule, path AS entity FROM p WHERE c % 23 = 0 UNION ALL SELECT 'completeness_value', path FROM p WHERE c % 11 = 0 UNION ALL
SELECT 'lifecycle_value', path FROM p WHERE c % 7 = 0 UNION ALL SELECT 'verified_date', path FROM p WHERE c % 13 = 0 UNION ALL SELECT 'course_code', path FROM p WHERE NOT major AND k % 17 = 0 UNION ALL
SELECT 'major_code', path FROM p WHERE major AND k % 19 = 0 UNION ALL SELECT 'pdf_claim', path FROM p WHERE c % 29 = 0 UNION ALL SELECT 'field_3', path FROM p WHERE major AND c % 5 = 0
"""


def content_gate(spark, sf):
    return ops.content_rules(gate_pages(spark, sf), "path", "text", "private-store", tx.FIVE_OR_MORE)


@query("j2_content_rules", CONTENT_GATE_SQL)
def content_rules(spark, sf):
    return content_gate(spark, sf).select("rule", "entity")


MANIFEST_GATE_SQL = f"""
WITH m AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '' ELSE path END AS src, path || '.xml' AS xml, path || '.txt' AS txt, CASE WHEN doc_id % 6 = 0 THEN 'zz' WHEN doc_id % 13 = 0 THEN repeat('0', 64) ELSE digest END AS sha, doc_id % 17 = 0 AS nopol FROM ({text_plans.FILES_SQL})),
f AS (SELECT DISTINCT txt FROM m WHERE doc_id % 3 <> 0)
SELECT 'path_empty' AS rule, doc_id::VARCHAR AS entity FROM m WHERE src = '' UNION ALL
SELECT 'target_missing', doc_id::VARCHAR FROM m, (SELECT unnest(['txt', 'view']) AS c) WHERE c = 'view' OR txt NOT IN (SELECT txt FROM f) UNION ALL
SELECT 'digest_mismatch', doc_id::VARCHAR FROM m WHERE src <> '' AND (doc_id % 6 = 0 OR doc_id % 13 = 0) UNION ALL
SELECT 'digest_shape', doc_id::VARCHAR FROM m WHERE doc_id % 6 = 0 UNION ALL SELECT 'policy_empty', doc_id::VARCHAR FROM m WHERE nopol
"""


def manifest_gate(spark, sf):
    d = F.col("doc_id")
    listing = text_plans.source_files(spark, sf)
    manifest = listing.select(
        d.alias("row_no"), F.when(d % 11 == 0, "").otherwise(F.replace("path", F.lit("/"), F.lit("\\"))).alias("source_pdf"),
        F.concat("path", F.lit(".xml")).alias("raw_xml"), F.concat("path", F.lit(".txt")).alias("raw_txt"), F.concat("path", F.lit(".view")).alias("raw_view_html"),
        F.concat("path", F.lit(".xml")).alias("extracted_md"),
        F.when(d % 6 == 0, "zz").when(d % 13 == 0, "0" * 64).otherwise(F.col("digest")).alias("source_sha256"),
        F.when(d % 17 != 0, "full-text-draft").alias("extraction_policy"),
    )
    outputs = F.array_compact(F.array(F.concat("path", F.lit(".xml")), F.when(d % 3 != 0, F.concat("path", F.lit(".txt")))))
    made = listing.select(F.explode(outputs).alias("path"), F.lit(None).cast("string").alias("digest"))
    return ops.manifest_rules(manifest, listing.select("path", "digest").unionByName(made))


@query("j3_manifest_rules", MANIFEST_GATE_SQL)
def manifest_rules(spark, sf):
    return manifest_gate(spark, sf).select("rule", "entity")


@query(
    "j4_resolve_refs",
    """
WITH f AS (SELECT 'en/' || (page_id % 40) || '/' || page_id || CASE page_id % 4 WHEN 0 THEN ' title.pdf' WHEN 1 THEN '-b-c.pdf' WHEN 2 THEN '（卷）.pdf' ELSE '.pdf' END AS path, page_id FROM pages),
r AS (SELECT page_id AS ref_id, CASE page_id % 7 WHEN 0 THEN 'en/' || (page_id % 40) || '/' || page_id || '.pdf' WHEN 1 THEN 'en/../x' WHEN 2 THEN 'en/' || (page_id % 40) WHEN 3 THEN 'en/secret' || page_id WHEN 4 THEN 'en/' || (page_id % 40) || '/' || page_id || '-b' ELSE 'en/' || (page_id % 40) || '/' || page_id END AS path FROM pages),
c AS (SELECT r.*, (SELECT count(*) FROM f WHERE f.path = r.path OR starts_with(f.path, r.path || '/')) > 0 AS hit, (SELECT count(*) FROM f WHERE starts_with(f.path, r.path || ' ') OR starts_with(f.path, r.path || '-') OR starts_with(f.path, r.path || '（')) AS near FROM r)
SELECT ref_id, path, CASE WHEN ref_id % 7 = 1 THEN 'invalid:path-escape' WHEN ref_id % 7 = 3 THEN 'invalid:sensitive' WHEN hit THEN 'ok' WHEN near > 0 THEN 'ok-prefix' ELSE 'missing' END AS resolution,
 CASE WHEN ref_id % 7 IN (1, 3) THEN 0 WHEN hit THEN 1 ELSE near END AS n_candidates FROM c
""",
)
def resolve_refs(spark, sf):
    return ops.resolve_refs(*_refs_and_listing(spark, sf))


@query(
    "j4_prefix_candidates",
    """
WITH f AS (SELECT 'en/' || (page_id % 40) || '/' || page_id || CASE page_id % 4 WHEN 0 THEN ' title.pdf' WHEN 1 THEN '-b-c.pdf' WHEN 2 THEN '（卷）.pdf' ELSE '.pdf' END AS path FROM pages),
r AS (SELECT DISTINCT CASE page_id % 7 WHEN 0 THEN 'en/' || (page_id % 40) || '/' || page_id || '.pdf' WHEN 2 THEN 'en/' || (page_id % 40) WHEN 4 THEN 'en/' || (page_id % 40) || '/' || page_id || '-b' ELSE 'en/' || (page_id % 40) || '/' || page_id END AS path FROM pages WHERE page_id % 7 NOT IN (1, 3))
SELECT r.path, f.path AS file FROM r JOIN f ON starts_with(f.path, r.path || ' ') OR starts_with(f.path, r.path || '-') OR starts_with(f.path, r.path || '（') WHERE r.path NOT IN (SELECT path FROM f)
""",
)
def prefix_candidates(spark, sf):
    return ops.prefix_candidates(*_refs_and_listing(spark, sf)).select("path", "file")


def _refs_and_listing(spark, sf):
    from corpus_audit.functions.policy import parse_ref

    i = F.col("page_id")
    s, folder = i.cast("string"), (i % 40).cast("string")
    tail = F.when(i % 4 == 0, " title.pdf").when(i % 4 == 1, "-b-c.pdf").when(i % 4 == 2, "（卷）.pdf").otherwise(".pdf")
    listing = table(spark, sf, "pages").select(F.concat(F.lit("en/"), folder, F.lit("/"), s, tail).alias("path"))
    refs = table(spark, sf, "pages").select(i.alias("ref_id"), parse_ref(_reference(i)).alias("r")).select("ref_id", "r.path", "r.state")
    return refs, listing


def _reference(i):
    s, folder, m = i.cast("string"), (i % 40).cast("string"), i % 7
    own = F.concat(F.lit("en/"), folder, F.lit("/"), s)
    return (
        F.when(m == 0, F.concat(own, F.lit(".pdf"))).when(m == 1, "en/../x").when(m == 2, F.concat(F.lit("en/"), folder))
        .when(m == 3, F.concat(F.lit("en/secret"), s)).when(m == 4, F.concat(own, F.lit("-b"))).otherwise(own)
    )


# two lines a page: one that names its reference, one that leaks a file in every eleventh page
MATERIAL_SQL = f"""
WITH j AS ({ORACLES['j4_resolve_refs']})
SELECT 'ref_policy' AS rule, ref_id::VARCHAR AS entity, 'L1' AS locator, 'bad materials path' AS message FROM j WHERE ref_id % 7 = 1 UNION ALL
SELECT 'ref_policy', ref_id::VARCHAR, 'L1', 'sensitive word in path' FROM j WHERE ref_id % 7 = 3 UNION ALL
SELECT 'ref_unresolved', ref_id::VARCHAR, 'L1', resolution || ' ' || path FROM j WHERE resolution NOT IN ('ok', 'ok-prefix') UNION ALL
SELECT 'line_leak', page_id::VARCHAR, 'L2', 'private or raw file' FROM pages WHERE page_id % 11 = 0 AND page_id % 22 <> 0
"""


def material_lines(spark, sf):
    i = F.col("page_id")
    named = F.concat(F.lit("see materials://"), _reference(i), F.lit("`, or materials://<path>"))
    leak = F.when(i % 22 == 0, "official.example papers/2020.pdf").when(i % 11 == 0, "in papers/2020.pdf").otherwise("papers")
    both = F.array(F.struct(F.lit(1).cast("bigint").alias("line_no"), named.alias("text")), F.struct(F.lit(2).cast("bigint").alias("line_no"), leak.alias("text")))
    return table(spark, sf, "pages").select("page_id", F.inline(both))


@query("j4_material_findings", MATERIAL_SQL)
def material_findings(spark, sf):
    _, listing = _refs_and_listing(spark, sf)
    found = ops.material_findings(material_lines(spark, sf), listing, "page_id", "official.example", "private-store")
    return found.select("rule", "entity", "locator", "message")


REQUIRED = {"plan.md": ["tion", "the "], "sources.md": ["href"], "index.md": ["<nav>"]}


def page_set(spark, sf):
    """Every page id has up to three page kinds; ids divisible by five lack ``plan.md``."""
    i = F.col("page_id")
    names = F.array_compact(F.array(F.lit("index.md"), F.lit("sources.md"), F.when(i % 5 != 0, "plan.md")))
    return wide(spark, sf, "pages").select("page_id", F.explode(names).alias("name"), F.col("html").alias("text"))


PAGES_GATE_SQL = """
SELECT 'page_missing' AS rule, page_id::VARCHAR AS entity, 'plan.md' AS message FROM pages WHERE page_id % 5 = 0 UNION ALL
SELECT 'mark_missing', page_id::VARCHAR, m FROM pages, (VALUES ('plan.md', 'tion'), ('plan.md', 'the '), ('sources.md', 'href'), ('index.md', '<nav>')) v(n, m) WHERE NOT contains(html, m) AND NOT (n = 'plan.md' AND page_id % 5 = 0)
"""


def pages_gate(spark, sf):
    pages = page_set(spark, sf)
    return ops.required_pages(table(spark, sf, "pages"), pages, "page_id", REQUIRED)


@query("j5_required_pages", PAGES_GATE_SQL)
def required_pages(spark, sf):
    return pages_gate(spark, sf).select("rule", "entity", "message")


FRONT_GATE_SQL = """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders)
SELECT 'lifecycle_missing' AS rule, k::VARCHAR AS entity FROM o WHERE k % 4 = 1 UNION ALL
SELECT 'completeness_missing', k::VARCHAR FROM o WHERE c % 5 = 0 UNION ALL
SELECT 'lifecycle_value', k::VARCHAR FROM o WHERE k % 4 = 2 UNION ALL SELECT 'completeness_value', k::VARCHAR FROM o WHERE c % 5 = 1 UNION ALL SELECT 'route_disallowed', k::VARCHAR FROM o WHERE c % 9 = 0
"""


def front_gate(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = F.concat(
        F.lit("---\n"), F.when(k % 4 == 0, "status: in_review\n").when(k % 4 == 1, "lifecycle: \n").when(k % 4 == 2, "lifecycle: nope\n").otherwise("lifecycle: draft\n"),
        F.when(c % 5 == 0, "").when(c % 5 == 1, "completeness: nope\n").otherwise("completeness: complete\n"), F.when(c % 9 == 0, "route: /x\n").otherwise(""), F.lit("---\nbody"),
    )
    pages = wide(spark, sf, "orders").select("o_orderkey", text.alias("text"))
    return ops.frontmatter_rules(pages, F.col("o_orderkey"), tx.parse_frontmatter("text"), ["lifecycle", "completeness"], ["route", "canonical"])


@query("j6_frontmatter_rules", FRONT_GATE_SQL)
def frontmatter_rules(spark, sf):
    return front_gate(spark, sf).select("rule", "entity")


PUBLISH_GATE_SQL = """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders WHERE o_orderstatus <> 'O')
SELECT 'replacement_free_text' AS rule, k::VARCHAR AS entity FROM o WHERE k % 2 = 0 AND k < 10000 AND c % 3 = 0 UNION ALL
SELECT 'pending_数据状态', k::VARCHAR FROM o WHERE c % 4 = 0 UNION ALL SELECT 'pending_replacement', k::VARCHAR FROM o WHERE c % 5 = 0 UNION ALL
SELECT 'pending_exam_source_status', k::VARCHAR FROM o WHERE c % 7 = 0 UNION ALL SELECT 'review_missing', k::VARCHAR FROM o WHERE k % 3 = 0 UNION ALL
SELECT 'reviewer_missing', k::VARCHAR FROM o WHERE k % 3 <> 0 AND c % 2 = 0 UNION ALL SELECT 'exam_index_mixed', k::VARCHAR FROM o WHERE c % 11 = 0 UNION ALL
SELECT 'exam_scope_shared', k::VARCHAR FROM o WHERE c % 13 = 0 UNION ALL SELECT 'revision_mismatch', k::VARCHAR FROM o WHERE c % 17 = 0
"""


def publish_gate(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    front = F.create_map(
        F.lit("lifecycle"), F.when(F.col("o_orderstatus") == "O", "draft").otherwise("publishable"), F.lit("replacement_confirmed"), F.when(c % 5 == 0, "pending").otherwise("True"),
        F.lit("exam_source_status"), F.when(c % 7 == 0, "待统计").otherwise("done"), F.lit("reviewed"), F.when(k % 3 == 0, "no").otherwise("yes"),
        F.lit("reviewer"), F.when(c % 2 == 0, "None").otherwise("someone"), F.lit("current_exam_periods"), F.lit("[2024-04, 2024-10]"),
        F.lit("legacy_comparison_periods"), F.when(c % 13 == 0, "['2024-10']").otherwise("[2019-10]"), F.lit("content_revision"), F.when(c % 17 == 0, "abc").otherwise("rev1"),
    )
    meta = F.create_map(F.lit("数据状态"), F.when(c % 4 == 0, "待补充").otherwise("ok"), F.lit("发布日期"), F.lit("2024-01-01"))
    body = F.concat(
        F.lit("# t\n## 新旧课程顶替\n"), F.when(c % 3 == 0, "> 可替代旧课\n").otherwise("> 说明\n"), F.lit("| 字段 | 内容 |\n## 考期索引\n| 考期 15043 03708 |\n"),
        F.when(c % 11 == 0, "| 2024 | 15043 | 03708 |\n").otherwise("| 2024 | 15043 |\n"), F.lit("## 其他\n| 15043 03708 |\n"),
    )
    pages = wide(spark, sf, "orders").select("o_orderkey", front.alias("front"), meta.alias("meta"), body.alias("body"))
    structured = (k % 2 == 0) & (k < 10000)
    return ops.publish_rules(pages, F.col("o_orderkey"), "rev1", structured, ["03708", "03709"], ["15043", "15044"])


@query("j7_publish_rules", PUBLISH_GATE_SQL)
def publish_rules(spark, sf):
    return publish_gate(spark, sf).select("rule", "entity")


@query(
    "j8_page_warnings",
    """
WITH c AS (SELECT c_custkey AS k, c_mktsegment AS seg, c_acctbal AS b FROM customer)
SELECT 'meta_3_missing' AS rule, k::VARCHAR AS entity FROM c WHERE seg = 'BUILDING' AND b < 5000 UNION ALL SELECT 'migration_status', k::VARCHAR FROM c WHERE seg = 'BUILDING' AND k % 3 = 0 UNION ALL
SELECT 'status_unparseable', k::VARCHAR FROM c WHERE seg = 'BUILDING' AND k % 5 = 0 UNION ALL SELECT 'marks_unpaired', k::VARCHAR FROM c WHERE seg = 'MACHINERY' AND k % 2 = 0
""",
)
def page_warnings(spark, sf):
    k = F.col("c_custkey")
    filled = [x for name in ops.ADVISORY_META if name not in ("学分", "状态", "MIGRATION_STATUS") for x in (F.lit(name), F.lit("v"))]
    meta = F.create_map(
        *filled, F.lit("学分"), F.when(F.col("c_acctbal") < 5000, "").otherwise("4"), F.lit("状态"), F.when(k % 5 == 0, "done").otherwise("🔴 x"),
        F.lit("MIGRATION_STATUS"), F.when(k % 3 == 0, "v1").otherwise("v2"),
    )
    pages = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), meta.alias("meta"), F.when(k % 2 == 0, "<start>").otherwise("<start> <end>").alias("body")
    )
    own, paired = F.col("segment") == "BUILDING", F.col("segment") == "MACHINERY"
    return ops.page_warnings(pages, F.col("c_custkey"), own, paired, ["<start>"], ["<end>"]).select("rule", "entity")


# -- maturity -----------------------------------------------------------------------------------

# labelled documents as entities, their pages from the document's own lines
MATURE_SQL = f"""
WITH e AS (SELECT l.doc_id, CASE WHEN quality = 1 THEN CASE WHEN toxic = 0 THEN 'publishable' ELSE 'in_review' END ELSE 'draft' END AS life, CASE WHEN doc_id % 3 = 0 THEN 'missing-source' ELSE 'complete' END AS comp FROM labels l),
p AS (SELECT doc_id, contains(text, 'tion') AND regexp_matches({inputs.sql_strip("regexp_extract(text, '(?s)tion[^' || chr(10) || ']*' || chr(10) || '((?:[^' || chr(10) || ']*' || chr(10) || '?){1,7})', 1)")}, '\\S') AS ok FROM documents),
g AS (SELECT e.*, coalesce(ok, false) AS ok, doc_id % 4 = 0 AS lacks FROM e LEFT JOIN p USING (doc_id))
SELECT doc_id, life AS lifecycle, comp AS completeness, CASE WHEN lacks THEN 'red' WHEN comp = 'missing-source' AND life = 'draft' THEN 'red' WHEN life = 'publishable' AND comp = 'complete' AND ok THEN 'green' ELSE 'yellow' END AS maturity,
 concat_ws('|', CASE WHEN lacks THEN 'missing:plan.md' END, CASE WHEN NOT lacks AND NOT ok THEN 'thin-required-pages' END, 'lifecycle:' || life, 'completeness:' || comp) AS reasons FROM g
"""


def mature_rows(spark, sf):
    d = F.col("doc_id")
    entities = table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, F.when(F.col("toxic") == 0, "publishable").otherwise("in_review")).otherwise("draft").alias("lifecycle"),
        F.when(d % 3 == 0, "missing-source").otherwise("complete").alias("completeness"),
    )
    names = F.array_compact(F.array(F.lit("index.md"), F.lit("sources.md"), F.lit("practice.md"), F.when(d % 4 != 0, "plan.md")))
    docs = wide(spark, sf, "documents").select("doc_id", F.explode(names).alias("name"), "text")
    text = F.when(F.col("name") == "sources.md", F.replace("text", F.lit("tion"), F.lit("核验"))).otherwise(F.lit("真题 阶段目标\n x"))
    return maturity.grade(entities, docs.withColumn("text", text), "doc_id")


@query("j9_grade", MATURE_SQL)
def grade(spark, sf):
    return mature_rows(spark, sf).withColumn("reasons", F.array_join("reasons", "|"))


PROJECT_SQL = f"""
SELECT doc_id, lifecycle, completeness, maturity, CASE WHEN kept = '' THEN '-' ELSE kept END AS reasons, CASE WHEN contains(reasons, 'missing:') THEN 'gap: plan.md' WHEN contains(reasons, 'thin-') THEN 'gap: 核验' ELSE '/courses/' || doc_id || '/' END AS next_step
FROM (SELECT *, array_to_string([x FOR x IN string_split(reasons, '|') IF NOT contains(x, 'completeness:') AND NOT contains(x, 'draft')], '; ') AS kept FROM ({MATURE_SQL}))
"""


@query("j10_project", PROJECT_SQL)
def project(spark, sf):
    return maturity.project(mature_rows(spark, sf), "doc_id", ["completeness:", "draft"])


@query(
    "j11_tally",
    f"SELECT l.maturity, count(m.doc_id) AS n FROM (SELECT unnest(['red', 'yellow', 'green']) AS maturity) l LEFT JOIN ({MATURE_SQL}) m USING (maturity) GROUP BY 1",
)
def tally(spark, sf):
    return maturity.tally(mature_rows(spark, sf))


@query(
    "j12_projection_drift",
    """
SELECT doc_id, CASE WHEN doc_id % 10 = 1 THEN 'only_right' ELSE 'differs' END AS problem FROM labels WHERE doc_id % 10 = 1 OR (doc_id % 7 = 2)
""",
)
def projection_drift(spark, sf):
    rows = maturity.project(mature_rows(spark, sf), "doc_id")
    stored = rows.filter(F.col("doc_id") % 10 != 1).withColumn(
        "maturity", F.when(F.col("doc_id") % 7 == 2, "stale").otherwise(F.col("maturity"))
    )
    return maturity.projection_drift(stored, rows, "doc_id")


REMAP_SQL = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'publishable' WHEN o_orderkey % 4 = 1 THEN 'weird' END AS life, CASE o_custkey % 4 WHEN 0 THEN 'green' WHEN 1 THEN 'yellow' WHEN 2 THEN 'publishable' END AS status,
  CASE WHEN o_custkey % 3 = 0 THEN 'complete' END AS comp, CASE WHEN o_custkey % 3 = 1 THEN 'odd' END AS mcomp FROM orders WHERE o_orderstatus <> 'P'),
r AS (SELECT *, CASE life WHEN 'publishable' THEN 'publishable' WHEN 'weird' THEN 'draft' ELSE CASE WHEN status IS NULL THEN 'draft' ELSE 'machine_ready' END END AS nl, CASE WHEN comp IS NOT NULL THEN comp WHEN mcomp = 'odd' THEN 'needs-review' ELSE 'metadata-only' END AS nc FROM o)
SELECT o_orderkey, coalesce(life, status, '(none)') AS old_status, nl AS lifecycle, nc AS completeness, CASE nl WHEN 'draft' THEN '🔴 建设中' WHEN 'publishable' THEN '🟢 可发布' ELSE '🟡 机器初稿' END AS display,
 life IS DISTINCT FROM nl OR comp IS DISTINCT FROM nc AS changed FROM r
"""


@query("j13_change_report", f"SELECT old_status, lifecycle, count(*) AS pages, count(*) FILTER (WHERE changed) AS changed FROM ({REMAP_SQL}) GROUP BY ALL")
def change_report(spark, sf):
    return maturity.change_report(remap(spark, sf))


@query("j13_remap", REMAP_SQL)
def remap(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    orders = table(spark, sf, "orders")
    pages = orders.select(
        "o_orderkey", F.when(k % 4 == 0, "publishable").when(k % 4 == 1, "weird").alias("lifecycle"),
        F.when(c % 4 == 0, "green").when(c % 4 == 1, "yellow").when(c % 4 == 2, "publishable").alias("status"),
        F.when(c % 3 == 0, "complete").alias("completeness"), F.when(c % 3 == 1, "odd").alias("meta_completeness"),
    )
    return maturity.remap(pages, orders.filter(F.col("o_orderstatus") == "P").select("o_orderkey"), "o_orderkey")


# -- reports ------------------------------------------------------------------------------------

@query(
    "j14_gap_backlog",
    """
SELECT n_nationkey AS pos, '[course-gap] ' || printf('%05d', n_nationkey) || ' ' || n_name || '：教材、' || n_regionkey AS issue_title, 'course-gap,p' || n_regionkey || ',materials-needed' AS labels,
 '课程：`' || printf('%05d', n_nationkey) || '` ' || n_name || chr(10) || chr(10) || '缺口：教材、' || n_regionkey || chr(10) || '优先级：P' || n_regionkey || chr(10) || 'materials线索：h' AS body FROM nation
""",
)
def gap_backlog(spark, sf):
    r = F.col("n_regionkey").cast("string")
    gaps = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("pos"), inputs.padded(F.col("n_nationkey")).alias("code"), F.col("n_name").alias("title"),
        F.concat(F.lit("P"), r).alias("priority"), F.array(F.lit("教材"), r).alias("gaps"), F.lit("h").alias("materials_hint"),
    )
    return report.gap_backlog(gaps)


@query(
    "j15_sitemap",
    """
SELECT 'https://s.example/' || p AS loc, w AS priority FROM (VALUES ('', '1.0'), ('courses/', '0.9'), ('majors/', '0.9')) v(p, w) UNION ALL
SELECT 'https://s.example/courses/' || printf('%05d', page_id) || '/', '0.8' FROM pages UNION ALL SELECT 'https://s.example/majors/' || lower(n_name) || '/', '0.7' FROM nation WHERE n_regionkey > 1
""",
)
def sitemap(spark, sf):
    courses = table(spark, sf, "pages").select(tx.entity_route(inputs.page_path(F.col("page_id")), tx.FIVE_OR_MORE).alias("route"))
    majors = table(spark, sf, "nation").select(F.lower("n_name").alias("slug"), (F.col("n_regionkey") > 1).alias("present"))
    return report.sitemap("https://s.example", courses, majors)


@query(
    "j16_unit_layers",
    """
SELECT p_brand, count(*) AS n_points, concat_ws('、', CASE WHEN a > 0 THEN '识记 ' || a END, CASE WHEN b > 0 THEN '领会 ' || b END, CASE WHEN c > 0 THEN '应用 ' || c END, CASE WHEN count(*) > a + b + c THEN '未分级 ' || (count(*) - a - b - c) END) AS layers
FROM (SELECT p_brand, count(*) FILTER (WHERE p_type = 'ECONOMY') OVER w AS a, count(*) FILTER (WHERE p_type = 'SMALL') OVER w AS b, count(*) FILTER (WHERE p_type = 'LARGE' AND p_brand = 'Brand#1') OVER w AS c FROM part WINDOW w AS (PARTITION BY p_brand)) GROUP BY p_brand, a, b, c
""",
)
def unit_layers(spark, sf):
    t = F.col("p_type")
    level = F.when(t == "ECONOMY", "识记").when(t == "SMALL", "领会").when((t == "LARGE") & (F.col("p_brand") == "Brand#1"), "应用")
    return report.unit_layers(table(spark, sf, "part").withColumn("requirement", level), ["p_brand"])


SCHEMA = {
    "type": "object",
    "required": ["k", "kind"],
    "additionalProperties": False,
    "properties": {
        "k": {"type": "integer"},
        "kind": {"type": "string", "enum": ["view", "click", "error"], "minLength": 5},
        "flag": {"type": ["number", "null"]},
        "tags": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"type": "string"}},
        "v": {"const": 1},
    },
}
SCHEMA_SQL = """
WITH e AS (SELECT event_id AS id, event_type AS t, event_id % 6 AS m FROM events)
SELECT 'enum' AS rule, id::VARCHAR AS entity, '$.kind' AS locator FROM e WHERE t NOT IN ('view', 'click', 'error') AND m <> 5 UNION ALL SELECT 'minLength', id::VARCHAR, '$.kind' FROM e WHERE length(t) < 5 AND m <> 5 UNION ALL
SELECT 'type', id::VARCHAR, '$.flag' FROM e WHERE m = 0 UNION ALL SELECT 'minItems', id::VARCHAR, '$.tags' FROM e WHERE m = 1 UNION ALL SELECT 'type', id::VARCHAR, '$.tags[]' FROM e WHERE m = 2 UNION ALL
SELECT 'maxItems', id::VARCHAR, '$.tags' FROM e WHERE m = 3 UNION ALL SELECT 'const', id::VARCHAR, '$.v' FROM e WHERE m = 3 UNION ALL SELECT 'closed', id::VARCHAR, '$' FROM e WHERE m = 4 UNION ALL
SELECT 'type', id::VARCHAR, '$.k' FROM e WHERE m = 4 UNION ALL SELECT 'required', id::VARCHAR, '$.kind' FROM e WHERE m = 5
"""


def schema_gate(spark, sf):
    m = F.col("event_id") % 6
    k = F.get_json_object("props", "$.k")
    kind = F.concat(F.lit(', "kind": "'), "event_type", F.lit('"'))
    tail = (
        F.when(m == 0, F.concat(kind, F.lit(', "flag": true'))).when(m == 1, F.concat(kind, F.lit(', "tags": [], "flag": 1.5')))
        .when(m == 2, F.concat(kind, F.lit(', "tags": ["a", 1], "flag": null'))).when(m == 3, F.concat(kind, F.lit(', "tags": ["a", "b", "c"], "v": 2')))
        .when(m == 4, F.concat(kind, F.lit(', "extra": {}'))).otherwise(F.lit(', "v": 1, "tags": ["a"]'))
    )
    value = F.when(m == 4, F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k)
    rows = wide(spark, sf, "events").select("event_id", F.concat(F.lit('{"k": '), value, tail, F.lit("}")).alias("json"))
    return ops.schema_rules(rows, F.col("event_id"), "json", SCHEMA)


@query("j17_schema_rules", SCHEMA_SQL)
def schema_rules(spark, sf):
    return schema_gate(spark, sf).select("rule", "entity", "locator")


# the rule groups of the layers that are made of other queries: their rows as findings, by column
GROUPS = {
    "materials": [
        ("j4_material_findings", {"rule": "rule", "entity": "entity", "locator": "locator", "message": "message"}, "true"),
        ("b29_leak_patterns", {"rule": "rule", "entity": "doc_id", "locator": "line_no"}, "true"),
    ],
    "maturity-check": [("j12_projection_drift", {"rule": "problem", "entity": "doc_id"}, "true")],
    "evidence": [
        ("f8_validate_facts", {"rule": "rule", "entity": "entity"}, "true"),
        ("f9_rederive", {"rule": "rule", "entity": "entity"}, "true"),
        ("f10_digest_drift", {"rule": "problem", "entity": "doc_id", "locator": "path"}, "true"),
        ("f11_url_provenance", {"rule": "rule", "entity": "entity"}, "true"),
        ("f12_forbidden_artifacts", {"rule": "'forbidden_artifact'", "entity": "l_orderkey", "locator": "artifact"}, "true"),
        ("g10_denominator_status", {"rule": "problem", "entity": "o_orderkey"}, "problem IS NOT NULL"),
        ("g14_validate_points", {"rule": "rule", "entity": "entity"}, "true"),
        ("g15_ordered_list_equal", {"rule": "rule", "entity": "entity", "locator": "locator", "message": "message"}, "true"),
    ],
    "ai-content": [
        ("h7_validate_blocks", {"rule": "rule", "entity": "entity"}, "true"),
        ("h9_validate_stages", {"rule": "rule", "entity": "entity", "locator": "locator"}, "true"),
        ("h10_official_sample_rules", {"rule": "rule", "entity": "entity"}, "true"),
        ("h13_overlap_violations", {"rule": "'overlap'", "entity": "doc_id", "message": "n_shared"}, "true"),
        ("h16_enforce_scope", {"rule": "rule", "entity": "entity", "locator": "locator", "message": "message"}, "true"),
        ("h17_point_reach", {"rule": "problem", "entity": "course", "locator": "point_id", "message": "kind"}, "true"),
        ("h18_count_reconcile", {"rule": "'count'", "entity": "course", "locator": "kind", "message": "rendered"}, "true"),
        ("h18_drill_reach", {"rule": "rule", "entity": "entity", "message": "message"}, "true"),
        ("h19_plan_reach", {"rule": "rule", "entity": "entity", "message": "message"}, "true"),
        ("h20_page_marks", {"rule": "rule", "entity": "entity"}, "true"),
        ("h21_blockquote_rules", {"rule": "rule", "entity": "entity", "locator": "locator"}, "true"),
        ("h22_orphan_products", {"rule": "problem", "entity": "order_key", "message": "banner_pages"}, "true"),
    ],
}
GATE_SQLS = {
    "content": CONTENT_GATE_SQL, "manifest": MANIFEST_GATE_SQL, "pages": PAGES_GATE_SQL, "frontmatter": FRONT_GATE_SQL, "publish": PUBLISH_GATE_SQL, "schema": SCHEMA_SQL,
    **{n: " UNION ALL ".join(f"SELECT {c['rule']} AS rule FROM ({ORACLES[q]}) WHERE {only}" for q, c, only in groups) for n, groups in GROUPS.items()},
}


def group_findings(spark, sf, layer):
    """The findings of a layer that is made of other queries, a frame for each of its rule groups."""
    parts = []
    for name, columns, only in GROUPS[layer]:
        rows = QUERIES[name](spark, sf).where(only).select(*[F.expr(e).cast("string").alias(c) for c, e in columns.items()])
        parts.append(whole_findings(rows.withColumn("severity", F.lit("error")), layer))
    return parts


def layers(spark, sf):
    return {
        "content": content_gate(spark, sf), "manifest": manifest_gate(spark, sf), "pages": pages_gate(spark, sf), "frontmatter": front_gate(spark, sf),
        "publish": publish_gate(spark, sf), "schema": schema_gate(spark, sf),
        **{n: group_findings(spark, sf, n) for n in GROUPS},
        "clean": no_findings(spark),
    }


ALL_LAYERS = [*GATE_SQLS, "clean"]
_RULES_SQL = " UNION ALL ".join(f"SELECT '{n}' AS layer, rule FROM ({q})" for n, q in GATE_SQLS.items())


@query(
    "j1_run_gates",
    "SELECT layer, count(rule) AS n_findings, CASE WHEN count(rule) > 0 THEN 'failed' ELSE 'ok' END AS state "
    f"FROM (SELECT unnest({ALL_LAYERS}) AS layer) LEFT JOIN ({_RULES_SQL}) USING (layer) GROUP BY layer",
)
def run_gates(spark, sf):
    return ops.run(layers(spark, sf))[1]


@query("j1_rule_counts", f"SELECT layer, rule, count(*) AS n FROM ({_RULES_SQL}) GROUP BY ALL")
def rule_counts(spark, sf):
    """What the gates found, by layer and rule: every rule group of every layer is in the one staged table."""
    return ops.run(layers(spark, sf))[0].groupBy("layer", "rule").agg(F.count(F.lit(1)).alias("n"))


# -- streaming ----------------------------------------------------------------------------------

PROBE_ROWS = f"SELECT url, ts, event_id AS seq, status, content_hash, authoritative FROM ({inputs.PROBES})"
TRANSITIONS_SQL = f"""
WITH p AS ({PROBE_ROWS}), f AS (SELECT url, min((ts, seq)) AS m FROM p GROUP BY url),
d AS (SELECT *, lag(status) OVER w AS ps, lag(content_hash) OVER w AS ph FROM p WHERE status <> 'inconclusive' WINDOW w AS (PARTITION BY url ORDER BY ts, seq)),
c AS (SELECT url, seq, CASE WHEN status = 'dead' AND ps = 'ok' THEN 'went_dead' WHEN status = 'ok' AND ps = 'dead' THEN 'recovered' WHEN authoritative AND status = 'ok' AND content_hash <> ph THEN 'content_changed' END AS change FROM d)
SELECT c.url, c.seq, change FROM c JOIN f USING (url) WHERE change IS NOT NULL AND seq <> m[2] UNION ALL SELECT url, m[2], 'new' FROM f
"""


def probe_rows(spark, sf, source=None):
    cols = ["url", "ts", F.col("event_id").alias("seq"), "status", "content_hash", "authoritative"]
    return inputs.probes(spark, sf, source).select(*cols)


@query("k1_transitions", TRANSITIONS_SQL)
def transitions(spark, sf):
    changes, _ = monitor.transitions(probe_rows(spark, sf), monitor.empty_state(spark))
    return changes.select("url", "seq", "change")


@query("k1_stream_transitions", TRANSITIONS_SQL)
def stream_transitions(spark, sf):
    """The same result as keyed state: the events as a file stream, then a heartbeat that lets the last ones ripen."""
    schema = inputs.events(spark, sf).schema
    base = scratch_dir(spark, "transitions")
    for last in (False, True):
        if last:
            monitor.heartbeat(spark, f"{base}/beats", F.lit("9999-01-01"))
        stream = spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet")
        monitor.start_transitions(
            probe_rows(spark, sf, stream), f"{base}/changes", f"{base}/checkpoint", beats=f"{base}/beats"
        ).awaitTermination()
    return spark.read.schema("url string, ts timestamp, seq bigint, change string").parquet(f"{base}/changes").select("url", "seq", "change")


@query(
    "k2_rot_alerts",
    f"""
WITH p AS (SELECT *, time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS run_start FROM ({PROBE_ROWS})),
l AS (SELECT run_start, url, arg_max(status, (ts, seq)) AS status FROM p GROUP BY ALL),
h AS (SELECT run_start, regexp_extract(url, '([^./]+[.][^./]+)(?:/|$)', 1) AS host, status FROM l)
SELECT strftime(run_start, '%Y-%m-%d') AS run_day, host, count(*) AS total, count(*) FILTER (WHERE status = 'dead') AS dead FROM h GROUP BY ALL HAVING count(*) >= 3 AND count(*) FILTER (WHERE status = 'dead') >= 3 AND count(*) FILTER (WHERE status = 'dead') * 100 >= count(*) * 20
""",
)
def rot_alerts(spark, sf):
    family = F.regexp_extract("url", r"([^./]+[.][^./]+)(?:/|$)", 1)
    out = monitor.rot_alerts(probe_rows(spark, sf), percent=20, host=family)
    return out.select(F.date_format("run_start", "yyyy-MM-dd").alias("run_day"), "host", "total", "dead")



@query("k3_new_documents", f"SELECT url, count(*) AS n_refs FROM ({inputs.PAGE_REFS}) GROUP BY url")
def new_documents(spark, sf):
    """Derived Markdown pages land as files, one for each page; a stream picks them up and extracts their links."""
    base = scratch_dir(spark, "intake")
    line = F.struct("line_no", "text")
    pages = inputs.page_markdown(spark, sf).groupBy("page_id").agg(F.array_sort(F.collect_list(line)).alias("l"))  # the lines of one page
    text = F.array_join(F.transform("l", lambda x: x.text), "\n")
    name = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(".txt"))
    files.write_tree(pages.select(name.alias("name"), text.alias("text")), f"{base}/pages")
    docs = monitor.new_documents(spark, f"{base}/pages", "*.txt")
    run = monitor.start_link_intake(docs, ["来源"], f"{base}/refs", f"{base}/checkpoint")
    run.awaitTermination()
    return spark.read.parquet(f"{base}/refs").groupBy("url").agg(F.count(F.lit(1)).alias("n_refs"))
