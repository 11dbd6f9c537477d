"""Queries of the model family (G), over the syllabus documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpus_audit.functions import text as tx
from corpus_audit.operators import model as ops
from corpus_audit.operators import structure
from corpus_audit.plans import inputs
from corpus_audit.plans import structure as sp
from corpus_audit.plans.registry import query, table
from corpus_audit.scale import dealt

KEYS = ["doc_id", "idx", "title"]
KEYS_SQL = "doc_id, idx, title"
LOGICAL = sp.logical_sql(sp.SLICES_SQL, KEYS_SQL)


def logical(spark, sf):
    return structure.logical_lines(sp.unit_lines(spark, sf), KEYS)


def _numbers(n: int) -> str:
    return "list_position([" + ", ".join(f"'{_cn(i)}'" for i in range(1, n)) + "], {})"


def _cn(n: int) -> str:
    digits = " 一二三四五六七八九"
    tens, ones = divmod(n, 10)
    if n < 10:
        return digits[n]
    return ("" if tens == 1 else digits[tens]) + "十" + (digits[ones] if ones else "")


CN_TO_INT = _numbers(100)


@query(
    "g1_unit_identity",
    f"""
SELECT doc_id, idx, CASE WHEN title = '导论' THEN 0 WHEN title LIKE '第一章%' THEN 1 WHEN title LIKE '第二章%' THEN 2 ELSE 3 END AS ordinal,
 CASE WHEN title = '导论' THEN 'intro' WHEN title LIKE '第一章%' THEN 'ch01' WHEN title LIKE '第二章%' THEN 'ch02' ELSE 'ch03' END AS slug,
 CASE WHEN title = '导论' THEN '导论' WHEN title LIKE '第一章%' THEN '第一章' WHEN title LIKE '第二章%' THEN '第二章' ELSE '第3章' END AS label FROM ({sp.TITLES_SQL})
""",
)
def unit_identity(spark, sf):
    out = sp.titles(spark, sf).select("doc_id", F.col("idx").cast("bigint").alias("idx"), ops.unit_identity("title").alias("u"))
    return out.select("doc_id", "idx", "u.*")


@query(
    "g2_missing_ordinals",
    """
WITH u AS (SELECT DISTINCT l_orderkey AS k, l_linenumber::BIGINT AS o FROM lineitem), h AS (SELECT k, max(o) AS hi FROM u GROUP BY k)
SELECT h.k AS l_orderkey, m AS missing FROM h, unnest(range(1, hi)) v(m) WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.k = h.k AND u.o = m)
""",
)
def missing_ordinals(spark, sf):
    units = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("ordinal"))
    return ops.missing_ordinals(units, "l_orderkey")


@query(
    "g2_ordinal_findings",
    """
WITH u AS (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem), p AS (SELECT *, lag(l_orderkey) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) AS prev FROM u)
SELECT l_suppkey::VARCHAR AS entity, l_orderkey::VARCHAR AS message FROM p WHERE (prev IS NULL AND l_orderkey NOT IN (0, 1)) OR l_orderkey <> prev + 1
""",
)
def ordinal_findings(spark, sf):
    units = table(spark, sf, "lineitem").select("l_suppkey", F.col("l_orderkey").alias("pos"), F.col("l_orderkey").alias("ordinal")).distinct()
    return ops.ordinal_findings(units, "l_suppkey").select("entity", "message")


@query(
    "g3_runs",
    """
WITH u AS (SELECT DISTINCT l_suppkey, l_orderkey AS n FROM lineitem), i AS (SELECT *, n - row_number() OVER (PARTITION BY l_suppkey ORDER BY n) AS g FROM u)
SELECT l_suppkey, min(n) AS run_start, max(n) AS run_end, CASE WHEN min(n) = max(n) THEN '第' || min(n) || '章' ELSE '第' || min(n) || '–' || max(n) || '章' END AS label FROM i GROUP BY l_suppkey, g
""",
)
def runs(spark, sf):
    return ops.runs(table(spark, sf, "lineitem"), "l_suppkey", "l_orderkey")


BLOCK_SQL = f"""
WITH l AS ({LOGICAL}), h AS (SELECT {KEYS_SQL}, min(line_no) AS a FROM l WHERE text = '{inputs.REQ_HEADING}' GROUP BY ALL),
z AS (SELECT l.doc_id, l.idx, min(line_no) AS z FROM l JOIN h ON h.doc_id = l.doc_id AND h.idx = l.idx WHERE line_no > a AND kind = 'heading' GROUP BY ALL)
SELECT l.* FROM l JOIN h ON h.doc_id = l.doc_id AND h.idx = l.idx LEFT JOIN z ON z.doc_id = l.doc_id AND z.idx = l.idx WHERE line_no > a AND line_no < coalesce(z, 1000000000)
"""


def block(spark, sf):
    return ops.requirement_block(logical(spark, sf), KEYS, inputs.REQ_HEADING)


def _plain(df):
    return df.withColumn("idx", F.col("idx").cast("bigint"))


@query("g4_requirement_block", BLOCK_SQL)
def requirement_block(spark, sf):
    return _plain(block(spark, sf))


CLASSIFIED_SQL = rf"""
WITH b AS ({BLOCK_SQL}), t AS (SELECT *, CASE WHEN kind = 'section' THEN CASE WHEN regexp_matches(text, '^[0-9]+[.]') THEN regexp_extract(text, '^([0-9]+)[.]', 1) ELSE {CN_TO_INT.format("regexp_extract(text, '^（([^）]+)）', 1)")}::VARCHAR END END AS lab,
  CASE WHEN kind = 'section' THEN trim(regexp_replace(text, '^([0-9]+[.]|（[^）]+）\s*)', '')) END AS ltitle FROM b),
s AS (SELECT *, bool_or(lab IS NOT NULL) OVER (PARTITION BY doc_id, idx) AS numbered, last_value(CASE WHEN lab IS NOT NULL THEN {{'line': line_no, 'index': lab, 'title': ltitle, 'skip': contains(ltitle, '不作考核要求')}} END IGNORE NULLS) OVER w AS sec
  FROM t WINDOW w AS (PARTITION BY doc_id, idx ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
v AS (SELECT *, NOT numbered OR coalesce(NOT sec.skip, false) AS live, coalesce(sec.line, 0) AS section_line FROM s),
q AS (SELECT *, bool_or(kind = 'requirement' AND live) OVER (PARTITION BY doc_id, idx, section_line ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS seen FROM v),
r AS (SELECT *, CASE WHEN lab IS NOT NULL AND sec.skip THEN 'unmodeled' WHEN lab IS NOT NULL THEN 'section' WHEN live AND (kind = 'requirement' OR NOT coalesce(seen, false)) THEN 'requirement' ELSE 'unmodeled' END AS role FROM q)
SELECT doc_id, idx, title, line_no, role, section_line, CASE WHEN numbered THEN sec.index ELSE '1' END AS section_index, CASE WHEN numbered THEN sec.title ELSE title END AS section_title,
 CASE WHEN role = 'requirement' AND kind = 'requirement' THEN substr(text, 1, 2) END AS requirement, CASE WHEN role = 'requirement' THEN CASE WHEN kind = 'requirement' THEN substr(text, 4) ELSE text END END AS body,
 CASE WHEN role = 'unmodeled' THEN CASE WHEN coalesce(sec.skip, false) THEN 'not_assessed' ELSE 'unnumbered_section' END END AS reason, NOT numbered AS unit_level, text FROM r
"""


def classified(spark, sf):
    return ops.classify_block(block(spark, sf), KEYS, "title")


@query("g5_sections", f"SELECT * EXCLUDE (text) FROM ({CLASSIFIED_SQL})")
def sections(spark, sf):
    return _plain(classified(spark, sf)).drop("text", "kind")


POINTS_SQL = f"""
WITH c AS (SELECT * FROM ({CLASSIFIED_SQL}) WHERE role = 'requirement'),
p AS (SELECT doc_id, idx, title AS unit_title, section_line, section_index, requirement, line_no, generate_subscripts(ph, 1) AS k, unnest(ph) AS title FROM (SELECT *, [x FOR x IN [trim(rtrim({inputs.sql_fold('y')}, '。'), ' ') FOR y IN string_split(body, '；')] IF x <> ''] AS ph FROM c)),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, idx, section_line ORDER BY line_no, k) AS seq FROM p)
SELECT doc_id, idx, printf('%05d', doc_id) || '-ch0' || idx || '-s' || section_index || '-p' || seq AS point_id, section_line, section_index, seq, title, requirement, 'L' || line_no AS locator FROM n
"""


def points(spark, sf):
    prefix = F.concat(inputs.padded(F.col("doc_id")), F.lit("-ch0"), F.col("idx").cast("string"))
    return ops.points(classified(spark, sf).withColumnRenamed("title", "unit_title"), ["doc_id", "idx"], prefix)


@query("g6_points", POINTS_SQL)
def model_points(spark, sf):
    return _plain(points(spark, sf)).drop("quote").withColumn("seq", F.col("seq").cast("bigint"))


@query(
    "g7_focus",
    f"""
WITH l AS ({LOGICAL}), h AS (SELECT doc_id, idx, min(line_no) AS a FROM l WHERE kind = 'heading' AND contains(text, '本章重点') GROUP BY ALL),
z AS (SELECT l.doc_id, l.idx, min(line_no) AS z FROM l JOIN h ON h.doc_id = l.doc_id AND h.idx = l.idx WHERE line_no > a AND kind = 'heading' GROUP BY ALL),
r AS (SELECT l.* FROM l JOIN h ON h.doc_id = l.doc_id AND h.idx = l.idx LEFT JOIN z ON z.doc_id = l.doc_id AND z.idx = l.idx WHERE line_no > a AND line_no < coalesce(z, 1000000000))
SELECT doc_id, idx, title, line_no, generate_subscripts(ph, 1) - 1 AS pos, unnest(ph) AS phrase FROM (SELECT *, [x FOR x IN [trim(rtrim({inputs.sql_fold('y')}, '。'), ' ') FOR y IN string_split(text, '；')] IF x <> ''] AS ph FROM r)
""",
)
def focus(spark, sf):
    return _plain(ops.focus(logical(spark, sf), KEYS)).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "g8_declared_vs_produced",
    f"""
WITH c AS ({CLASSIFIED_SQL}), d AS (SELECT doc_id, idx, CASE WHEN regexp_matches(text, '^[0-9]+[.]') THEN [regexp_extract(text, '^([0-9]+)[.]', 1)] ELSE [] END || [{CN_TO_INT.format('x')}::VARCHAR FOR x IN regexp_extract_all(text, '（([一二三四五六七八九十]+)）', 1)] AS ids, role, reason FROM c),
a AS (SELECT DISTINCT doc_id, idx, unnest(ids) AS index FROM d), t AS (SELECT DISTINCT doc_id, idx, unnest(ids) AS index FROM d WHERE reason = 'not_assessed'),
p AS (SELECT DISTINCT doc_id, idx, section_index AS index FROM c WHERE role = 'section' AND length(section_title) % 5 <> 0)
SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.doc_id = a.doc_id AND t.idx = a.idx AND t.index = a.index) AND NOT EXISTS (SELECT 1 FROM p WHERE p.doc_id = a.doc_id AND p.idx = a.idx AND p.index = a.index)
""",
)
def declared_vs_produced(spark, sf):
    # a model that lost every section whose title length is a multiple of five
    lost = (F.col("role") == "section") & (F.length("section_title") % 5 == 0)
    c = classified(spark, sf).withColumn("role", F.when(lost, F.lit("lost")).otherwise(F.col("role")))
    return _plain(ops.unaccounted(ops.section_mentions(c, ["doc_id", "idx"]), ["doc_id", "idx"]))


DENOMINATOR_SQL = f"""
WITH f AS ({sp.FOLDED}), a AS (SELECT doc_id, max(line_no) AS a FROM f WHERE regexp_matches(text, '^[ⅠⅡⅢⅣ]\\s*\\S') AND contains(text, '课程内容与考核要求') GROUP BY doc_id),
z AS (SELECT f.doc_id, min(line_no) AS z FROM f JOIN a USING (doc_id) WHERE line_no > a AND text LIKE 'Ⅳ%' GROUP BY f.doc_id),
i AS (SELECT f.*, max(CASE WHEN text = '{inputs.REQ_HEADING}' THEN line_no END) OVER w AS anc, max(CASE WHEN regexp_matches(text, '^[一二三四五六七八九十]+、') THEN line_no END) OVER w AS top
 FROM f JOIN a USING (doc_id) JOIN z USING (doc_id) WHERE line_no >= a AND line_no < z WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
n AS (SELECT doc_id, anc, CASE WHEN regexp_matches(text, '^[0-9]+[.]') THEN [regexp_extract(text, '^([0-9]+)[.]', 1)] ELSE [] END || [{CN_TO_INT.format('x')}::VARCHAR FOR x IN regexp_extract_all(text, '（([一二三四五六七八九十]+)）', 1)] AS ids, text, line_no FROM i WHERE anc = top),
u AS (SELECT doc_id, anc, count(DISTINCT id) AS k FROM (SELECT doc_id, anc, unnest(CASE WHEN line_no = anc OR contains(text, '不作考核要求') OR len(ids) = 0 THEN [NULL] ELSE ids END) AS id FROM n) GROUP BY ALL)
SELECT doc_id, sum(greatest(k, 1))::BIGINT AS declared_units FROM u GROUP BY doc_id
"""


@query("g9_independent_denominator", DENOMINATOR_SQL)
def independent_denominator(spark, sf):
    return ops.independent_denominator(inputs.syllabus_lines(spark, sf), ["doc_id"], inputs.REQ_HEADING)


@query(
    "g10_denominator_status",
    """
WITH o AS (SELECT o_orderkey, o_orderstatus <> 'P' AS ext, o_orderkey % 3 AS raw, o_custkey % 2 AS norm, o_orderkey % 4 AS official FROM orders),
d AS (SELECT *, CASE WHEN ext THEN CASE WHEN raw > 0 THEN raw WHEN norm > 0 THEN norm END END AS declared FROM o)
SELECT o_orderkey, declared, CASE WHEN ext AND declared IS NULL THEN 'denominator_unreadable' WHEN declared <> official THEN 'denominator_mismatch' END AS problem FROM d
""",
)
def denominator_status(spark, sf):
    k = F.col("o_orderkey")
    s = ops.denominator_status(F.col("o_orderstatus") != "P", k % 3, F.col("o_custkey") % 2, k % 4)
    return table(spark, sf, "orders").select("o_orderkey", s.alias("s")).select("o_orderkey", "s.*")


@query(
    "g11_coverage",
    f"""
WITH c AS ({CLASSIFIED_SQL}), s AS (SELECT DISTINCT doc_id, idx, section_line, unit_level FROM c WHERE role = 'section' OR (unit_level AND role = 'requirement')),
p AS (SELECT DISTINCT doc_id, idx, section_line FROM ({POINTS_SQL})),
g AS (SELECT doc_id, count(*) AS official, count(p.doc_id) AS modeled, bool_and(unit_level) AS by_unit FROM s LEFT JOIN p USING (doc_id, idx, section_line) GROUP BY doc_id)
SELECT doc_id, official, modeled, round_even(modeled / official, 4) AS ratio, CASE WHEN by_unit THEN '考纲「{inputs.REQ_HEADING}」中的章数（该考纲不分子节，章即考核单元）' ELSE '考纲「{inputs.REQ_HEADING}」中带编号的节数' END AS rule FROM g
""",
)
def coverage(spark, sf):
    flagged = ops.section_flags(classified(spark, sf), ["doc_id", "idx"]).withColumn("unit_class", F.lit("chapter"))
    return ops.coverage_counts(flagged, "doc_id", inputs.REQ_HEADING)


# a hand-kept tree per document: heading missing in every seventh, every ninth line unnumbered
MANUAL_SQL = """
SELECT doc_id, 1::BIGINT AS line_no, CASE WHEN doc_id % 7 = 0 THEN '## 知识点总览' ELSE ' ## 章节知识树 ' END AS text FROM documents UNION ALL
SELECT doc_id, i + 1, CASE WHEN i % 9 = 0 THEN '#### x ' || x ELSE '#### ' || (i // 4) || '.' || (i % 4 + 1) || ' ' || x || ' — ' || CASE WHEN i % 2 = 0 THEN '🟢🔴' ELSE '🟡' END END
 FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), unnest(range(1, len(l) + 1)) u(i), (SELECT 1) one, unnest([l[i]]) v(x) UNION ALL
SELECT doc_id, len(string_split(text, chr(10))) + 2, '## end' FROM documents UNION ALL SELECT doc_id, len(string_split(text, chr(10))) + 3, '#### 9.9 after' FROM documents
"""


def manual_lines(spark, sf):
    docs = table(spark, sf, "documents").withColumn("l", F.split("text", "\n", -1))
    head = F.array(F.when(F.col("doc_id") % 7 == 0, "## 知识点总览").otherwise(" ## 章节知识树 "))
    body = F.expr(
        "transform(l, (x, j) -> CASE WHEN (j + 1) % 9 = 0 THEN '#### x ' || x ELSE '#### ' || ((j + 1) div 4) || '.' || ((j + 1) % 4 + 1) || ' ' "
        "|| x || ' — ' || CASE WHEN (j + 1) % 2 = 0 THEN '🟢🔴' ELSE '🟡' END END)"
    )
    whole = F.concat(head, body, F.array(F.lit("## end"), F.lit("#### 9.9 after")))
    return docs.select("doc_id", F.posexplode(whole).alias("_p", "text")).select("doc_id", (F.col("_p") + 1).cast("bigint").alias("line_no"), "text")


@query(
    "g12_parse_manual",
    f"""
WITH m AS ({MANUAL_SQL}), e AS (SELECT * FROM m WHERE doc_id % 7 <> 0 AND text LIKE '#### %' AND text <> '#### 9.9 after')
SELECT 'element' AS rule, doc_id, line_no, regexp_extract(text, '^#### ([0-9]+)', 1) || '.' || regexp_extract(text, '^#### [0-9]+[.]([0-9]+)', 1) AS detail FROM e WHERE regexp_matches(text, '^#### [0-9]+[.][0-9]+\\s+') UNION ALL
SELECT 'manual_unparsed', doc_id, line_no, trim(substr(text, 6)) FROM e WHERE NOT regexp_matches(text, '^#### [0-9]+[.][0-9]+\\s+') UNION ALL
SELECT 'manual_orphans', doc_id, min(line_no), count(*)::VARCHAR FROM m WHERE doc_id % 7 = 0 AND regexp_matches(text, '^#### [0-9]+[.][0-9]+\\s+') GROUP BY doc_id
""",
)
def parse_manual(spark, sf):
    elements, found = ops.parse_manual(manual_lines(spark, sf), ["doc_id"])
    out = elements.select(
        F.lit("element").alias("rule"), "doc_id", "line_no", F.concat_ws(".", F.col("ordinal").cast("string"), "section").alias("detail")
    )
    return out.unionByName(
        found.select("rule", F.col("entity").cast("bigint").alias("doc_id"), F.substring("locator", 2, 20).cast("bigint").alias("line_no"), F.col("message").alias("detail"))
    )


@query(
    "g13_diff_ledger",
    """
WITH m AS (SELECT o_orderkey AS k, '「' || o_orderpriority || '」' AS title, CASE WHEN o_orderstatus = 'F' THEN 'A,R' ELSE 'N' END AS lv FROM orders),
o AS (SELECT l_orderkey AS k, min(l_linenumber) AS fp, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS lv, min(l_partkey) AS pk FROM lineitem GROUP BY 1),
j AS (SELECT coalesce(m.k, o.k) AS k, m.title AS mt, CASE WHEN pk % 3 = 0 THEN m.title WHEN pk % 3 = 1 THEN translate(m.title, '「」', '“”') ELSE 'z' END AS ot, m.lv AS ml, o.lv AS ol, m.k AS mk, o.k AS ok, fp FROM m FULL JOIN o ON m.k = o.k)
SELECT k AS order_key, CASE WHEN mk IS NOT NULL AND ok IS NOT NULL THEN 'matched' WHEN mk IS NOT NULL THEN 'manual_only' ELSE 'model_only' END AS kind, fp AS first_point,
 concat_ws(';', CASE WHEN ml <> ol THEN 'levels_differ' END, CASE WHEN ok IS NOT NULL AND mk IS NOT NULL THEN CASE WHEN ot = mt THEN NULL WHEN ot <> 'z' THEN 'quote_style' ELSE 'title_differs' END END) AS note FROM j
""",
)
def diff_ledger(spark, sf):
    orders = table(spark, sf, "orders")
    shown = F.concat(F.lit("「"), "o_orderpriority", F.lit("」"))
    manual = orders.select(
        F.col("o_orderkey").alias("order_key"), shown.alias("title"),
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("A"), F.lit("R"))).otherwise(F.array(F.lit("N"))).alias("levels"),
    )
    # return flags are a closed list of three, so the level set per order is bounded
    made = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.collect_set("l_returnflag").alias("levels"), F.min("l_linenumber").alias("first_point"), F.min("l_partkey").alias("pk")
    )
    made = made.join(orders, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("l_orderkey").alias("order_key"), "levels", "first_point",
        F.when(F.col("pk") % 3 == 0, shown).when(F.col("pk") % 3 == 1, F.translate(shown, "「」", "“”")).otherwise("z").alias("title"),
    )
    return ops.diff_ledger(manual, made, ["order_key"])


POINT_ROWS = """
SELECT printf('%05d', (p_partkey // 4)) AS code, printf('%05d', (p_partkey // 4 + (p_partkey % 17 = 0)::INT)) || CASE WHEN p_partkey % 13 = 0 THEN '-bad-' ELSE '-ch01-' END || 's1-p' || CASE WHEN p_partkey % 10 = 0 THEN 2 ELSE p_partkey % 4 + 1 END AS point_id,
 CASE WHEN p_partkey % 9 = 0 THEN '  ' WHEN p_partkey % 7 = 0 THEN repeat(p_name, 8) ELSE p_name END AS quote FROM part
"""


@query(
    "g14_validate_points",
    f"""
WITH p AS ({POINT_ROWS}), c AS (SELECT code, (count(*) FILTER (WHERE length(trim(quote)) > 9) / count(*)) AS ratio FROM p GROUP BY code)
SELECT 'point_id' AS rule, code AS entity FROM p WHERE NOT (starts_with(point_id, code || '-') AND regexp_full_match(point_id, '{tx.FIVE_OR_MORE}-(intro|ch[0-9]{{2}}|ap[0-9]{{2}})-s[0-9]+-p[0-9]+')) UNION ALL
SELECT 'quote_missing', code FROM p WHERE trim(quote) = '' UNION ALL SELECT 'quote_long', code FROM p WHERE trim(quote) <> '' AND length(quote) > 60 UNION ALL
SELECT 'point_duplicate', code FROM p GROUP BY code, point_id HAVING count(*) > 1 UNION ALL SELECT 'coverage_low', code FROM c WHERE ratio < 0.9
""",
)
def validate_points(spark, sf):
    k = F.col("p_partkey")
    five = lambda c: inputs.padded(c)
    rows = table(spark, sf, "part").select(
        five(F.expr("p_partkey div 4")).alias("code"),
        F.concat(
            five(F.expr("p_partkey div 4") + F.when(k % 17 == 0, 1).otherwise(0)), F.when(k % 13 == 0, "-bad-").otherwise("-ch01-"), F.lit("s1-p"),
            F.when(k % 10 == 0, F.lit(2)).otherwise(k % 4 + 1).cast("string"),
        ).alias("point_id"),
        F.when(k % 9 == 0, "  ").when(k % 7 == 0, F.repeat("p_name", 8)).otherwise(F.col("p_name")).alias("quote"),
    )
    cover = rows.groupBy("code").agg((F.count_if(F.length(F.trim("quote")) > 9) / F.count(F.lit(1))).alias("ratio"))
    return ops.validate_points(rows, "code", cover, tx.FIVE_OR_MORE).select("rule", "entity")


@query(
    "g15_ordered_list_equal",
    """
WITH l AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS pk FROM lineitem GROUP BY ALL), n AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS pos, pk FROM l),
p AS (SELECT l_orderkey, pos, CASE WHEN pk % 40 = 0 THEN 'other' ELSE '第 ' || pk || ' 章' END AS t FROM n WHERE l_orderkey % 9 <> 0 AND NOT (pos = 5 AND pk % 3 = 0)),
m AS (SELECT l_orderkey, pos, '第' || pk || '章' AS t FROM n), r AS (SELECT DISTINCT l_orderkey FROM p)
SELECT 'page_table_unreadable' AS rule, l_orderkey::VARCHAR AS entity, NULL AS locator, '' AS message FROM (SELECT DISTINCT l_orderkey FROM n WHERE l_orderkey % 2 = 0) WHERE l_orderkey NOT IN (SELECT l_orderkey FROM r) UNION ALL
SELECT 'titles_differ', coalesce(m.l_orderkey, p.l_orderkey)::VARCHAR, min(coalesce(m.pos, p.pos))::VARCHAR, count(*)::VARCHAR FROM m FULL JOIN p ON m.l_orderkey = p.l_orderkey AND m.pos = p.pos
 WHERE m.t IS DISTINCT FROM replace(p.t, ' ', '') AND coalesce(m.l_orderkey, p.l_orderkey) IN (SELECT l_orderkey FROM r) GROUP BY 2
""",
)
def ordered_list_equal(spark, sf):
    # one row per (order, line number), and line numbers run from 1 to 7, so the window of an order is bounded
    items = dealt(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey")
    lines = items.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("pk"))
    n = lines.withColumn("pos", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")).cast("bigint"))
    pk = F.col("pk").cast("string")
    model = n.select("l_orderkey", "pos", F.concat(F.lit("第"), pk, F.lit("章")).alias("title"))
    page = n.filter((F.col("l_orderkey") % 9 != 0) & ~((F.col("pos") == 5) & (F.col("pk") % 3 == 0))).select(
        "l_orderkey", "pos", F.when(F.col("pk") % 40 == 0, "other").otherwise(F.concat(F.lit("第 "), pk, F.lit(" 章"))).alias("title")
    )
    state = n.select("l_orderkey", (F.col("l_orderkey") % 2 == 0).alias("has_table")).distinct()
    return ops.ordered_list_equal(model, page, state, "l_orderkey").select("rule", "entity", "locator", "message")


@query(
    "g16_key_clash",
    "SELECT doc_id, 'ap01' AS slug, 2::BIGINT AS n, min(line_no) AS first_locator, max(line_no) AS last_locator FROM ("
    + inputs.SYLLABUS
    + ") WHERE doc_id % 6 = 0 AND text LIKE '附录一%' GROUP BY doc_id",
)
def key_clash(spark, sf):
    units = sp.appendices(spark, sf).select("doc_id", "anchor", ops.appendix_identity("title").slug.alias("slug")).distinct()
    return ops.key_clash(units, ["doc_id"], "slug", "anchor")


@query(
    "g17_unit_neighbors",
    """
WITH u AS (SELECT DISTINCT l_suppkey, (l_orderkey % 2)::INT AS unit_class, l_orderkey // 2 AS ordinal, 'u' || l_orderkey AS slug FROM lineitem)
SELECT *, lag(slug) OVER w AS previous, lead(slug) OVER w AS following FROM u WINDOW w AS (PARTITION BY l_suppkey ORDER BY unit_class, ordinal)
""",
)
def unit_neighbors(spark, sf):
    units = table(spark, sf, "lineitem").select(
        "l_suppkey", (F.col("l_orderkey") % 2).cast("int").alias("unit_class"), F.expr("l_orderkey div 2").alias("ordinal"),
        F.concat(F.lit("u"), F.col("l_orderkey").cast("string")).alias("slug"),
    ).distinct()
    return ops.unit_neighbors(units, "l_suppkey")
