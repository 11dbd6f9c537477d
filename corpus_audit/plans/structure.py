"""Queries of the structure family (C) and line sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_audit.functions import text as tx
from corpus_audit.operators import structure as ops
from corpus_audit.plans import inputs
from corpus_audit.plans.registry import query, table


@query("a4_physical_lines", inputs.LINES)
def physical_lines(spark, sf):
    return inputs.document_lines(spark, sf)


SCOPE_LEVELS = ", ".join(
    f"max(line_no) FILTER (WHERE lvl <= {n}) OVER w = max(line_no) FILTER (WHERE lvl = {n} AND contains(head, '来源')) OVER w"
    for n in range(1, 7)
)
SCOPE_SQL = (
    "SELECT doc_id, line_no, coalesce(last_value(head IGNORE NULLS) OVER w, '') AS section, lvl IS NULL AND list_bool_or(["
    + SCOPE_LEVELS
    + "]) AS in_scope FROM (SELECT *, CASE WHEN regexp_matches(text, '^#{1,6}\\s+.*\\S\\s*$') THEN length(regexp_extract(text, '^#+')) END AS lvl, "
    "CASE WHEN regexp_matches(text, '^#{1,6}\\s+.*\\S\\s*$') THEN regexp_extract(text, '^#+\\s+(.*\\S)\\s*$', 1) END AS head FROM ("
    + inputs.MD_LINES
    + ")) WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)"
)
SCOPE_SQL = SCOPE_SQL.replace("list_bool_or([", "list_contains([").replace("]) AS in_scope", "], true) AS in_scope")


@query("c1_heading_scope", SCOPE_SQL)
def heading_scope(spark, sf):
    return ops.heading_scope(inputs.markdown_lines(spark, sf), ["doc_id"], ["来源"]).drop("text")


@query(
    "c2_section_slice",
    f"""
WITH m AS ({inputs.MD_LINES}), s AS (SELECT doc_id, min(line_no) AS a FROM m WHERE text LIKE '## %' GROUP BY doc_id),
e AS (SELECT doc_id, min(line_no) AS z FROM m JOIN s USING (doc_id) WHERE line_no > a AND regexp_matches(text, '^#{{1,2}} ') GROUP BY doc_id)
SELECT doc_id, line_no, text FROM m JOIN s USING (doc_id) LEFT JOIN e USING (doc_id) WHERE line_no > a AND line_no < coalesce(z, 1000000000)
""",
)
def section_slice(spark, sf):
    t = F.col("text")
    return ops.section_slice(inputs.markdown_lines(spark, sf), ["doc_id"], t.startswith("## "), t.rlike("^#{1,2} "))


@query(
    "c2_section_bodies",
    f"""
WITH m AS ({inputs.MD_LINES}), s AS (SELECT doc_id, min(line_no) AS a FROM m WHERE text LIKE '## %' GROUP BY doc_id),
e AS (SELECT doc_id, min(line_no) AS z FROM m JOIN s USING (doc_id) WHERE line_no > a AND regexp_matches(text, '^#{{1,2}} ') GROUP BY doc_id),
b AS (SELECT doc_id, string_agg(text, chr(10) ORDER BY line_no) AS body FROM m JOIN s USING (doc_id) LEFT JOIN e USING (doc_id) WHERE line_no > a AND line_no < coalesce(z, 1000000000) GROUP BY doc_id)
SELECT doc_id, coalesce(body, '') AS body FROM s LEFT JOIN b USING (doc_id)
""",
)
def section_bodies(spark, sf):
    t = F.col("text")
    return ops.section_bodies(inputs.markdown_lines(spark, sf), ["doc_id"], t.startswith("## "), t.rlike("^#{1,2} "))


@query(
    "c3_anchor_sections",
    f"""
WITH m AS (SELECT *, count(*) FILTER (WHERE text LIKE '### %') OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS n FROM ({inputs.MD_LINES})),
p AS (SELECT doc_id, n, min(line_no) AS line_no, arg_min(text, line_no) AS head, string_agg(text, chr(10) ORDER BY line_no) AS body FROM m WHERE n > 0 GROUP BY ALL),
a AS (SELECT *, regexp_extract(head, '^### (?:来源 )?([A-Za-z]+)', 1) AS anchor FROM p WHERE regexp_matches(head, '^### (?:来源 )?[A-Za-z]+'))
SELECT doc_id, anchor, max(line_no) AS line_no, sha256(arg_max(body, line_no)) AS body FROM a GROUP BY ALL
""",
)
def anchor_sections(spark, sf):
    out = ops.anchor_sections(inputs.markdown_lines(spark, sf), ["doc_id"], r"^### (?:来源 )?([A-Za-z]+)")
    return out.withColumn("body", F.sha2("body", 256))


# pipe tables from the documents' own " | " rows: header, rule row, then the rows
PIPE_SQL = f"""
SELECT doc_id, line_no * 3 + k AS line_no, CASE k WHEN 0 THEN '| h |' WHEN 1 THEN '| --- | --- |' ELSE CASE WHEN contains(text, ' | ') THEN '| ' || text || ' |' ELSE text END END AS text
FROM ({inputs.LINES}), (SELECT unnest([0, 1, 2]) AS k) WHERE k = 2 OR contains(text, ' | ')
"""


@query(
    "c4_table_rows",
    f"""
WITH p AS ({PIPE_SQL}) SELECT doc_id, line_no, len(c) AS n_cells, c[1] AS first_cell, c[-1] AS last_cell FROM (
 SELECT doc_id, line_no, [trim(x) FOR x IN string_split(trim(trim(text), '|'), '|')] AS c FROM p WHERE text LIKE '| %' AND line_no % 3 = 2 AND contains(text, ' | ')) WHERE len(c) >= 3
""",
)
def table_rows(spark, sf):
    lines = inputs.document_lines(spark, sf)
    has = F.col("text").contains(" | ")
    row = F.when(has, F.concat(F.lit("| "), "text", F.lit(" |"))).otherwise(F.col("text"))
    made = F.when(has, F.array(F.lit("| h |"), F.lit("| --- | --- |"), row)).otherwise(F.array(row))
    piped = lines.select("doc_id", "line_no", has.alias("_has"), F.posexplode(made).alias("_k", "text")).select(
        "doc_id", (F.col("line_no") * 3 + F.when(F.col("_has"), F.col("_k")).otherwise(2)).alias("line_no"), "text"
    )
    rows = ops.table_rows(piped, ["doc_id"], F.col("text") == "| h |", min_cells=3)
    return rows.select(
        "doc_id", "line_no", F.size("cells").cast("bigint").alias("n_cells"),
        F.col("cells")[0].alias("first_cell"), F.element_at("cells", -1).alias("last_cell"),
    )


@query(
    "c4_course_table_rows",
    """
WITH r AS (SELECT p_partkey, p_partkey % 7 AS k, CASE WHEN p_partkey % 5 = 0 THEN '  ' ELSE p_name END AS name, CASE WHEN p_partkey % 3 = 0 THEN 'x' ELSE p_size::VARCHAR END AS credits FROM part)
SELECT p_partkey, 'parsed' AS state, printf('%05d', p_partkey) AS code, nullif(trim(name), '') AS name, TRY_CAST(credits AS INTEGER) AS credits, CASE k % 3 WHEN 0 THEN '笔试' WHEN 1 THEN '实践' ELSE '机考' END AS exam_method, NULL AS reason FROM r WHERE k <> 6
UNION ALL SELECT p_partkey, 'dropped', NULL, NULL, NULL, NULL, '现行课程表行列位不足' FROM r WHERE k = 6
""",
)
def course_table_rows(spark, sf):
    key, k = F.col("p_partkey"), F.col("p_partkey") % 7
    cells = [
        key.cast("string"), inputs.padded(key), F.when(key % 5 == 0, "  ").otherwise(F.col("p_name")),
        F.when(key % 3 == 0, "x").otherwise(F.col("p_size").cast("string")),
        F.when(k == 6, "").when(k % 3 == 0, "笔试").when(k % 3 == 1, "实践").otherwise("机考"),
    ]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    lines = table(spark, sf, "part").select("p_partkey", F.lit(1).cast("bigint").alias("line_no"), row.alias("text"))
    parsed, dropped = ops.course_table_rows(lines, ["p_partkey"], digits=ops.FIVE_OR_MORE)
    none = lambda t: F.lit(None).cast(t)
    return parsed.select(
        "p_partkey", F.lit("parsed").alias("state"), "code", "name", "credits", "exam_method", none("string").alias("reason")
    ).unionByName(dropped.select(
        "p_partkey", F.lit("dropped").alias("state"), none("string").alias("code"), none("string").alias("name"),
        none("int").alias("credits"), none("string").alias("exam_method"), "reason",
    ))


# fixed-width plan lines rendered from part: each part is one sheet of three lines; every fifth name is
# wrapped around its row, every seventh row has two method tokens
PLAN_ROWS = """
SELECT p_brand, p_partkey, k, p_partkey * 3 + k AS line_no, CASE
 WHEN k = 1 THEN '  ' || (p_partkey % 40 + 1) || '   ' || printf('%05d', p_partkey) || '   ' || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name || '   ' END || p_size || '   '
   || CASE WHEN p_partkey % 7 = 0 THEN '笔试 实践' WHEN p_size % 2 = 0 THEN '笔试' ELSE '机考' END
 WHEN p_partkey % 5 = 0 THEN '            ' || CASE WHEN k = 0 THEN split_part(p_name, ' ', 1) ELSE split_part(p_name, ' ', 2) || '  学分' END
 ELSE '' END AS text FROM part, (SELECT unnest([0, 1, 2]) AS k)
"""


def plan_lines(spark, sf):
    key, name = F.col("p_partkey"), F.col("p_name")
    row = F.concat(
        F.lit("  "), (key % 40 + 1).cast("string"), F.lit("   "), inputs.padded(key), F.lit("   "),
        F.when(key % 5 == 0, "").otherwise(F.concat(name, F.lit("   "))), F.col("p_size").cast("string"), F.lit("   "),
        F.when(key % 7 == 0, "笔试 实践").when(F.col("p_size") % 2 == 0, "笔试").otherwise("机考"),
    )
    pad = F.lit("            ")
    before = F.when(key % 5 == 0, F.concat(pad, F.split_part(name, F.lit(" "), F.lit(1)))).otherwise("")
    after = F.when(key % 5 == 0, F.concat(pad, F.split_part(name, F.lit(" "), F.lit(2)), F.lit("  学分"))).otherwise("")
    return table(spark, sf, "part").select("p_partkey", F.posexplode(F.array(before, row, after)).alias("_k", "text")).select(
        "p_partkey", (F.col("p_partkey") * 3 + F.col("_k")).alias("line_no"), "text"
    )


@query(
    "c5_fixed_width_parsed",
    """
SELECT p_partkey, p_partkey * 3 + 1 AS line_no, printf('%05d', p_partkey) AS code, CASE WHEN p_partkey % 5 = 0 THEN replace(p_name, ' ', '') ELSE p_name END AS name,
 p_size AS credits, CASE WHEN p_size % 2 = 0 THEN '笔试' ELSE '机考' END AS exam_method FROM part WHERE p_partkey % 7 <> 0
""",
)
def fixed_width_parsed(spark, sf):
    return ops.fixed_width_rows(plan_lines(spark, sf), ["p_partkey"], digits=ops.FIVE_OR_MORE)[0]


@query(
    "c5_fixed_width_dropped",
    f"SELECT p_partkey, line_no, trim(text) AS raw, '{ops.NO_METHOD}' AS reason FROM ({PLAN_ROWS}) WHERE k = 1 AND p_partkey % 7 = 0",
)
def fixed_width_dropped(spark, sf):
    return ops.fixed_width_rows(plan_lines(spark, sf), ["p_partkey"], digits=ops.FIVE_OR_MORE)[1]


@query(
    "c6_wrapped_value",
    f"""
SELECT p_partkey, line_no, replace(p_name, ' ', '') AS wrapped FROM ({PLAN_ROWS}) JOIN part USING (p_partkey, p_brand) WHERE k = 1 AND p_partkey % 5 = 0
""",
)
def wrapped_value(spark, sf):
    out = ops.wrapped_value(plan_lines(spark, sf), ["p_partkey"], ops.FIVE_OR_MORE)
    return out.filter(F.col("text").rlike(ops.row_head(ops.FIVE_OR_MORE)) & F.col("wrapped").isNotNull()).select("p_partkey", "line_no", "wrapped")


@query(
    "c7_marked_blocks",
    """
SELECT conv_id, turn % 3 AS slot, CASE WHEN count(*) FILTER (WHERE turn >= 4) > 0 THEN arg_max(text, turn) FILTER (WHERE turn >= 4) ELSE arg_max(text, turn) END AS body
FROM conversations GROUP BY ALL
""",
)
def marked_blocks(spark, sf):
    block = F.concat(
        F.lit("<!-- manual:begin id=b"), (F.col("turn") % 3).cast("string"), F.lit(" -->\n"), "text", F.lit("\n<!-- manual:end -->")
    )
    late = F.col("turn") >= 4
    last = lambda c: F.max_by("block", F.when(c, F.col("turn")))
    # the last block of a slot wins, so a page needs only that of each of its three slots
    slots = (
        table(spark, sf, "conversations")
        .withColumn("block", block)
        .groupBy("conv_id", (F.col("turn") % 3).alias("slot"))
        .agg(last(late).alias("late"), last(~late).alias("early"))
    )
    join = lambda c: F.array_join(F.sort_array(F.collect_list(c)), "\n")
    pages = slots.groupBy("conv_id").agg(join("late").alias("target"), join("early").alias("fallback"))
    merged = ops.merge_marked(ops.marked_blocks("fallback"), ops.marked_blocks("target"))
    return pages.select("conv_id", F.explode(merged).alias("id", "body")).select(
        "conv_id", F.substring("id", 2, 9).cast("bigint").alias("slot"), "body"
    )


@query(
    "c8_balanced_region",
    """
WITH x AS (SELECT page_id, html, strpos(html, '<ul>') AS a, strpos(html, '</ul>') + 5 AS z FROM pages)
SELECT page_id, a AS start_at, z - 1 AS end_at, substr(html, a, z - a) AS region FROM x WHERE a > 0
""",
)
def balanced_region(spark, sf):
    out = ops.balanced_region(table(spark, sf, "pages"), "page_id", "html", "ul", begin="<(nav|ul|li|article)>", end="</(?:nav|ul|li|article)>")
    return out.select("page_id", F.col("start_at").cast("bigint"), F.col("end_at").cast("bigint"), "region")


FOLDED = f"SELECT doc_id, line_no, {inputs.sql_fold('text')} AS text FROM ({inputs.SYLLABUS})"
KIND = (
    "CASE WHEN regexp_matches(text, '^[一二三四五六七八九十]+、') THEN 'heading' WHEN regexp_matches(text, '^[0-9]+[.]') OR regexp_matches(text, '^（[一二三四五六七八九十]+）') "
    "THEN 'section' WHEN regexp_matches(text, '^(识记|领会|应用)：') THEN 'requirement' ELSE 'passage' END"
)
LOGICAL_FROM = """
SELECT {keys}, min(line_no) AS line_no, string_agg(text, '' ORDER BY line_no) AS text, arg_min(kind, line_no) AS kind FROM (
 SELECT *, sum(brk) OVER (PARTITION BY {keys} ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS g FROM (
  SELECT *, CASE WHEN kind = 'passage' AND lag(kind) OVER w NOT IN ('heading', 'section') AND NOT regexp_matches(lag(text) OVER w, '[。！？]$') THEN 0 ELSE 1 END AS brk
  FROM (SELECT *, {kind} AS kind FROM ({lines}) WHERE text <> '' AND NOT regexp_full_match(text, '[0-9]{1,3}') AND NOT regexp_full_match(text, '第\\s*[0-9]+\\s*页\\s*共\\s*[0-9]+\\s*页'))
  WINDOW w AS (PARTITION BY {keys} ORDER BY line_no))) GROUP BY {keys}, g
"""


def logical_sql(lines: str, keys: str) -> str:
    return LOGICAL_FROM.replace("{keys}", keys).replace("{kind}", KIND).replace("{lines}", lines)


@query("c9_logical_lines", logical_sql(FOLDED, "doc_id"))
def logical_lines(spark, sf):
    return ops.logical_lines(inputs.syllabus_lines(spark, sf), ["doc_id"])


# titles written from the way the syllabus is generated
TITLES_SQL = """
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS idx, title, CASE WHEN doc_id % 5 = 0 THEN 'body' ELSE 'toc' END AS origin
FROM (SELECT doc_id, 0 AS k, '导论' AS title FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 1, '第一章 基础' FROM documents UNION ALL
 SELECT doc_id, 2, '第二章 ' || lang FROM documents WHERE doc_id % 4 <> 1 UNION ALL SELECT doc_id, 3, '第 3 章 进阶' FROM documents)
"""


def titles(spark, sf):
    return ops.unit_titles(inputs.syllabus_lines(spark, sf), ["doc_id"])


@query("c10_unit_titles", TITLES_SQL)
def unit_titles(spark, sf):
    return titles(spark, sf).select("doc_id", F.col("idx").cast("bigint").alias("idx"), "title", "origin")


@query(
    "c10_missing_titles",
    f"""SELECT 'unit_titles_missing' AS rule, doc_id::VARCHAR AS entity FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM ({TITLES_SQL}) WHERE doc_id % 3 <> 0)""",
)
def missing_titles(spark, sf):
    found = titles(spark, sf).filter(F.col("doc_id") % 3 != 0)
    return ops.missing_titles(inputs.syllabus_lines(spark, sf), found, ["doc_id"]).select("rule", "entity")


# unit bodies by carrying the last title line below the content part forward
SLICES_SQL = f"""
WITH f AS ({FOLDED}), p AS (SELECT doc_id, min(line_no) AS a FROM f WHERE text = 'Ⅲ 课程内容与考核要求' GROUP BY doc_id),
z AS (SELECT doc_id, min(line_no) AS z FROM f WHERE text LIKE '附录%' GROUP BY doc_id),
m AS (SELECT f.*, t.idx, t.title FROM f JOIN p USING (doc_id) JOIN z USING (doc_id) LEFT JOIN ({TITLES_SQL}) t ON t.doc_id = f.doc_id AND t.title = f.text WHERE line_no > a AND line_no < z),
r AS (SELECT doc_id, line_no, text, last_value(idx IGNORE NULLS) OVER w AS idx, last_value(title IGNORE NULLS) OVER w AS title FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING))
SELECT doc_id, idx, title, line_no, text FROM r WHERE idx IS NOT NULL
"""


def slices(spark, sf):
    lines = inputs.syllabus_lines(spark, sf)
    return ops.body_slices(lines, titles(spark, sf), ["doc_id"])


def unit_lines(spark, sf):
    """The same rows by one scan and no shuffle, which the model queries start from."""
    return ops.document_slices(inputs.syllabus_documents(spark, sf), ["doc_id"], F.col("lines"))


@query("c11_document_slices", SLICES_SQL)
def document_slices(spark, sf):
    return unit_lines(spark, sf).select("doc_id", F.col("idx").cast("bigint").alias("idx"), "title", "line_no", tx.fold_ws("text").alias("text"))


@query("c11_body_slices", SLICES_SQL)
def body_slices(spark, sf):
    return slices(spark, sf).select("doc_id", F.col("idx").cast("bigint").alias("idx"), "title", "line_no", tx.fold_ws("text").alias("text"))


APPENDIX_SQL = f"""
WITH f AS ({FOLDED}), e AS (SELECT doc_id, min(line_no) AS z FROM f WHERE text LIKE 'Ⅳ%' GROUP BY doc_id),
a AS (SELECT f.*, CASE WHEN text LIKE '附录%' THEN line_no END AS anc FROM f JOIN e USING (doc_id) WHERE line_no < z),
r AS (SELECT doc_id, line_no, text, max(anc) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS anchor FROM a)
SELECT r.doc_id, r.anchor, t.text AS title, r.line_no, r.text FROM r JOIN f t ON t.doc_id = r.doc_id AND t.line_no = r.anchor WHERE anchor IS NOT NULL
"""


def appendices(spark, sf):
    return ops.appendix_slices(inputs.syllabus_lines(spark, sf), ["doc_id"])


@query("c12_appendix_slices", APPENDIX_SQL)
def appendix_slices(spark, sf):
    return appendices(spark, sf).withColumn("text", tx.fold_ws("text"))


@query(
    "c13_lookahead_merge",
    f"""
SELECT doc_id, min(line_no) AS line_no, doc_id % 3 = 0 AS terminated, CASE WHEN doc_id % 3 = 0 THEN '单项选择题|简答题|论述题' END AS items
FROM ({inputs.SYLLABUS}) WHERE text LIKE '可能采用的题型有：%' GROUP BY doc_id
""",
)
def lookahead_merge(spark, sf):
    out = ops.lookahead_merge(inputs.syllabus_lines(spark, sf), ["doc_id"])
    return out.withColumn("items", F.when(F.col("items").isNotNull(), F.array_join("items", "|")))


@query(
    "c14_nonempty_after",
    f"""
WITH m AS ({inputs.MD_LINES}), s AS (SELECT doc_id, min(line_no) AS a FROM m WHERE contains(text, 'tion') GROUP BY doc_id)
SELECT doc_id, count(*) FILTER (WHERE line_no > a AND line_no <= a + 7 AND trim(text) <> '' AND NOT regexp_matches({inputs.sql_strip('text')}, '^(#|[|]|<!--|>)')) > 0 AS filled
FROM m LEFT JOIN s USING (doc_id) GROUP BY doc_id
""",
)
def nonempty_after(spark, sf):
    lines = inputs.markdown_lines(spark, sf)
    docs = lines.groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda r: r.text), "\n").alias("text")
    )
    return docs.select("doc_id", ops.nonempty_after("text", "tion").alias("filled"))
