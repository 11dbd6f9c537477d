"""Queries of the evidence family (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_audit.functions import text as tx
from corpus_audit.operators import drift
from corpus_audit.operators import evidence as ops
from corpus_audit.plans import inputs
from corpus_audit.plans.registry import query, table, wide
from corpus_audit.plans.text import FILES_SQL, source_files


@query(
    "f1_locate_heading",
    f"""
SELECT doc_id, arg_min(t, line_no) FILTER (WHERE hit) AS heading, 'L' || min(line_no) FILTER (WHERE hit) AS locator, bool_or(contains(text, '重复')) AS has_marker
FROM (SELECT *, {inputs.sql_fold('text')} AS t, regexp_matches({inputs.sql_fold('text')}, '^[一二三四五六七八九十]+、考核知识点与考核要求$') AS hit FROM ({inputs.SYLLABUS})) GROUP BY doc_id
""",
)
def locate_heading(spark, sf):
    return ops.locate_heading(inputs.syllabus_lines(spark, sf), ["doc_id"], marker="重复")


# one textbook sheet of seven lines per part: names above the header are outside the region, every fourth
# sheet lacks the corroborating word, every fifth repeats the header between code and token
def sheet_lines(spark, sf):
    k = F.col("p_partkey")
    code = inputs.padded(k)
    rows = F.array(
        F.concat(code, F.lit("9 出版社 "), code), F.lit("教材代号 书名 出版社"), F.col("p_name"), code,
        F.when(k % 5 == 0, "教材代号 续").otherwise(F.col("p_brand")),
        F.concat(code, F.when(k % 3 == 0, "12").otherwise("1234"), F.lit(" "), "p_type"),
        F.when(k % 4 == 0, "印刷").otherwise("大学出版社 第二版"),
    )
    return table(spark, sf, "part").select("p_partkey", F.posexplode(rows).alias("_p", "text")).select(
        "p_partkey", (F.col("_p") + 1).cast("bigint").alias("line_no"), "text"
    )


@query(
    "f2_windowed_match",
    """
SELECT p_partkey, printf('%05d', p_partkey) AS code, 6::BIGINT AS line_no, substr(r, 1, 200) AS row, length(r) > 200 AS truncated FROM (
 SELECT *, printf('%05d', p_partkey) || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ' ' || p_brand END || ' ' || printf('%05d', p_partkey) || '12 ' || p_type || ' 大学出版社 第二版' AS r
 FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 4 <> 0 AND p_size > 5)
""",
)
def windowed_match(spark, sf):
    codes = table(spark, sf, "part").filter(F.col("p_size") > 5).select(inputs.padded(F.col("p_partkey")).alias("code"))
    return ops.windowed_match(sheet_lines(spark, sf), ["p_partkey"], codes, digits=tx.FIVE_OR_MORE)


@query(
    "f3_canonical_match",
    """
WITH m AS (SELECT l_partkey AS code, l_suppkey % 5 AS doc_id, l_orderkey * 10 + l_linenumber AS line_no, l_returnflag || l_linestatus || ' ' || l_quantity::INT AS row, l_tax = 0 AS truncated FROM lineitem),
c AS (SELECT code, max(doc_id) AS doc_id FROM m GROUP BY code), r AS (SELECT m.* FROM m JOIN c USING (code, doc_id)),
j AS (SELECT code, doc_id, 'p' || doc_id AS path, 'L' || min(line_no) AS locator, string_agg(row, ' / ' ORDER BY line_no, row) AS t, bool_or(truncated) AS cut, count(*) AS n_rows FROM r GROUP BY ALL)
SELECT code, doc_id, path, locator, substr(t, 1, 200) AS row, cut OR length(t) > 200 AS row_truncated, n_rows FROM j
""",
)
def canonical_match(spark, sf):
    m = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("code"), (F.col("l_suppkey") % 5).alias("doc_id"),
        F.concat(F.lit("p"), (F.col("l_suppkey") % 5).cast("string")).alias("path"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_no"),
        F.concat("l_returnflag", "l_linestatus", F.lit(" "), F.col("l_quantity").cast("int").cast("string")).alias("row"),
        (F.col("l_tax") == 0).alias("truncated"),
    )
    return ops.canonical_match(m)


SYL = "CASE WHEN o_orderstatus = 'F' THEN 'extracted' WHEN o_orderstatus = 'O' THEN 'missing' END"
TXT = "CASE WHEN o_orderpriority < '3' THEN 'matched' ELSE 'missing' END"


@query(
    "f4_eligibility",
    f"""
SELECT o_orderkey, CASE WHEN s IS NOT DISTINCT FROM 'extracted' AND t = 'matched' THEN 'L1' ELSE 'blocked' END AS level,
 'syllabus:' || CASE WHEN s IS NOT DISTINCT FROM 'extracted' THEN s ELSE 'missing' END || '|textbook_plan:' || t AS reasons FROM (SELECT o_orderkey, {SYL} AS s, {TXT} AS t FROM orders)
""",
)
def eligibility(spark, sf):
    e = ops.eligibility(F.expr(SYL), F.expr(TXT))
    return table(spark, sf, "orders").select("o_orderkey", e.alias("e")).select(
        "o_orderkey", "e.level", F.array_join("e.reasons", "|").alias("reasons")
    )


CATALOG_SQL = """
SELECT printf('%05d', p_partkey) AS code, CASE WHEN p_partkey % 6 = 0 THEN '' ELSE p_name END AS name, CASE WHEN p_size > 10 THEN p_size END AS credits, p_type AS exam_method,
 CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS doc_id, 'plans/' || p_brand AS path, 'L' || p_partkey AS locator FROM part WHERE p_partkey % 13 <> 0
"""


def catalog(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").filter(k % 13 != 0).select(
        inputs.padded(k).alias("code"), F.when(k % 6 == 0, "").otherwise(F.col("p_name")).alias("name"),
        F.when(F.col("p_size") > 10, F.col("p_size")).alias("credits"), F.col("p_type").alias("exam_method"),
        F.when(k % 11 != 0, F.col("p_brand")).alias("doc_id"), F.concat(F.lit("plans/"), "p_brand").alias("path"),
        F.concat(F.lit("L"), k.cast("string")).alias("locator"),
    )


def codes(spark, sf):
    return table(spark, sf, "part").select(inputs.padded(F.col("p_partkey")).alias("code"))


FACTS_SQL = f"""
SELECT code, field, CASE WHEN known THEN v END AS value, CASE WHEN known THEN 'verified' ELSE 'named_gap' END AS status, CASE WHEN known THEN doc_id END AS doc_id,
 CASE WHEN known THEN path END AS path, CASE WHEN known THEN locator END AS locator,
 CASE WHEN NOT known THEN CASE field WHEN 'name' THEN '读者无法确认该课码对应的官方课程名' WHEN 'credits' THEN '读者无法判断该课的学分权重与备考投入' ELSE '读者无法判断该课是笔试、机考还是实践考核' END END AS gap_impact,
 CASE WHEN NOT known THEN '官方专业计划表中的课程行' END AS next_evidence
FROM (SELECT *, coalesce(v, '') <> '' AND doc_id IS NOT NULL AS known FROM (
 SELECT p.code, f.field, CASE f.field WHEN 'name' THEN c.name WHEN 'credits' THEN c.credits::VARCHAR ELSE c.exam_method END AS v, c.doc_id, c.path, c.locator
 FROM (SELECT printf('%05d', p_partkey) AS code FROM part) p LEFT JOIN ({CATALOG_SQL}) c USING (code), (VALUES ('name'), ('credits'), ('exam_method')) f(field)))
"""


@query("f5_facts", FACTS_SQL)
def facts(spark, sf):
    return ops.facts(codes(spark, sf), catalog(spark, sf))


def cites(spark, sf):
    """Citations of folded line fragments: own line, one off, split over two lines, or nowhere."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id").orderBy("line_no")
    lines = inputs.document_lines(spark, sf).withColumn("t", tx.fold_ws("text"))
    lines = lines.withColumn("above", F.lag("t").over(w)).withColumn("below", F.lead("t").over(w))
    n = F.col("line_no") % 4
    value = (
        F.when(n == 0, F.substring("t", 1, 25)).when(n == 1, F.col("below"))
        .when(n == 2, F.concat(F.substring("above", 1, 9), F.substring("below", -9, 9))).otherwise("no such value ¤")
    )
    return lines.select(
        F.concat_ws("-", F.col("doc_id").cast("string"), F.col("line_no").cast("string")).alias("cite_id"), "doc_id", "line_no", value.alias("value")
    ).filter(F.col("value") != "")


CITES_SQL = f"""
SELECT concat_ws('-', doc_id, line_no) AS cite_id, doc_id, line_no, CASE line_no % 4 WHEN 0 THEN substr(t, 1, 25) WHEN 1 THEN below WHEN 2 THEN substr(above, 1, 9) || right(below, 9) ELSE 'no such value ¤' END AS value
FROM (SELECT doc_id, line_no, t, lag(t) OVER w AS above, lead(t) OVER w AS below FROM (SELECT doc_id, line_no, {inputs.sql_fold('text')} AS t FROM ({inputs.LINES})) WINDOW w AS (PARTITION BY doc_id ORDER BY line_no))
"""


@query(
    "f6_supporting_locator",
    f"""
WITH c AS (SELECT * FROM ({CITES_SQL}) WHERE value <> ''), t AS (SELECT doc_id, line_no AS ln, {inputs.sql_fold('text')} AS t FROM ({inputs.LINES})),
x AS (SELECT cite_id, min((abs(ln - line_no), ln)) AS b FROM c JOIN t ON t.doc_id = c.doc_id AND ln BETWEEN line_no - 2 AND line_no + 2 WHERE contains(t, value) GROUP BY cite_id),
a AS (SELECT cite_id, string_agg(t, ' ' ORDER BY ln) AS after FROM c JOIN t ON t.doc_id = c.doc_id AND ln BETWEEN line_no + 1 AND line_no + 2 GROUP BY cite_id),
w AS (SELECT cite_id, min((n, line_no - ln, ln)) AS b FROM c JOIN a USING (cite_id), unnest(range(1, length(value))) u(n) JOIN t ON t.doc_id = c.doc_id AND ln BETWEEN line_no - 2 AND line_no - 1
 WHERE contains(after, substr(value, n + 1)) AND contains(t, substr(value, 1, n)) GROUP BY cite_id)
SELECT c.cite_id, coalesce(x.b[2], w.b[3], c.line_no) AS line_no, CASE WHEN x.b IS NOT NULL THEN 'line' WHEN w.b IS NOT NULL THEN 'wrapped' ELSE 'original' END AS how
FROM c LEFT JOIN x USING (cite_id) LEFT JOIN w USING (cite_id)
""",
)
def supporting_locator(spark, sf):
    return ops.supporting_locator(cites(spark, sf), inputs.document_lines(spark, sf), "doc_id")


SYL_GAP, BOOK_GAP = ops.SYLLABUS_GAP, ops.TEXTBOOK_GAP


@query(
    "f7_assemble",
    f"""
WITH f AS (SELECT code, count(*) FILTER (WHERE status = 'verified') AS verified_facts, count(*) FILTER (WHERE status = 'named_gap') AS named_gaps, max(value) FILTER (WHERE field = 'name') AS name FROM ({FACTS_SQL}) GROUP BY code),
s AS (SELECT printf('%05d', s_suppkey) AS code, 'syl/' || s_suppkey AS path, sha256(s_name) AS sha, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS heading, s_suppkey % 3 = 0 AS sample, s_suppkey FROM supplier),
t AS (SELECT printf('%05d', l_partkey) AS code, max(l_suppkey) AS doc, max(l_returnflag) AS r FROM lineitem WHERE l_partkey % 9 <> 0 GROUP BY 1),
u AS (SELECT printf('%05d', page_id) AS code, url AS course_url FROM pages)
SELECT f.*, course_url, CASE WHEN heading IS NULL THEN 'missing' ELSE 'extracted' END AS syllabus_status, CASE WHEN heading IS NOT NULL THEN 'syllabus:' || f.code END AS syllabus_doc_id,
 CASE WHEN heading IS NOT NULL THEN path END AS syllabus_path, CASE WHEN heading IS NOT NULL THEN sha END AS syllabus_sha256, CASE WHEN heading IS NULL THEN path END AS candidate_path,
 heading IS NOT NULL AS has_assessment_requirements, coalesce(sample, false) AS has_sample_paper, heading AS requirements_heading, CASE WHEN heading IS NOT NULL THEN 'L' || s_suppkey END AS syllabus_locator,
 CASE WHEN heading IS NULL THEN '{SYL_GAP[0]}' END AS syllabus_gap_impact, CASE WHEN heading IS NULL THEN '{SYL_GAP[1]}' END AS syllabus_next_evidence,
 CASE WHEN t.code IS NULL THEN 'missing' ELSE 'matched' END AS textbook_status, doc AS textbook_doc_id, 'book/' || doc AS textbook_path, 'L' || doc AS textbook_locator, r AS textbook_row, r = 'R' AS row_truncated,
 CASE WHEN t.code IS NULL THEN '{BOOK_GAP[0]}' END AS textbook_gap_impact, CASE WHEN t.code IS NULL THEN '{BOOK_GAP[1]}' END AS textbook_next_evidence,
 CASE WHEN heading IS NOT NULL AND t.code IS NOT NULL THEN 'L1' ELSE 'blocked' END AS level,
 'syllabus:' || CASE WHEN heading IS NULL THEN 'missing' ELSE 'extracted' END || ',textbook_plan:' || CASE WHEN t.code IS NULL THEN 'missing' ELSE 'matched' END AS reasons
FROM f LEFT JOIN s USING (code) LEFT JOIN t USING (code) LEFT JOIN u USING (code)
""",
)
def assemble(spark, sf):
    five = lambda c: inputs.padded(F.col(c)).alias("code")
    key = F.col("s_suppkey")
    named = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    syllabus = table(spark, sf, "supplier").select(
        five("s_suppkey"), named("syl/", key).alias("path"), F.sha2("s_name", 256).alias("sha256"), F.when(key % 4 != 0, F.col("s_name")).alias("heading"),
        named("L", key).alias("locator"), (key % 3 == 0).alias("has_sample"),
    )
    doc = F.col("doc_id")
    textbook = (
        table(spark, sf, "lineitem").where(F.col("l_partkey") % 9 != 0).groupBy(five("l_partkey")).agg(F.max("l_suppkey").alias("doc_id"), F.max("l_returnflag").alias("row"))
    ).select("code", "doc_id", named("book/", doc).alias("path"), named("L", doc).alias("locator"), "row", (F.col("row") == "R").alias("row_truncated"))
    urls = table(spark, sf, "pages").select(five("page_id"), "url")
    out = ops.assemble(codes(spark, sf), syllabus, textbook, urls, ops.facts(codes(spark, sf), catalog(spark, sf)))
    return out.withColumn("reasons", F.concat_ws(",", "reasons"))


FACT_ROWS = """
SELECT o_orderkey, o_orderpriority AS field, CASE o_orderstatus WHEN 'F' THEN 'verified' WHEN 'O' THEN 'named_gap' ELSE CASE WHEN o_custkey % 5 = 0 THEN 'odd' END END AS status,
 CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS value, CASE WHEN o_orderkey % 4 = 0 THEN 'd' END AS doc_id, CASE WHEN o_orderkey % 5 <> 0 THEN 'g' END AS gap_impact, CASE WHEN o_orderkey % 7 <> 0 THEN 'n' END AS next_evidence FROM orders
"""


@query(
    "f8_validate_facts",
    f"""
WITH f AS ({FACT_ROWS})
SELECT 'fact_status' AS rule, o_orderkey::VARCHAR AS entity FROM f WHERE status IS NULL OR status NOT IN ('verified', 'named_gap') UNION ALL
SELECT 'fact_provenance', o_orderkey::VARCHAR FROM f WHERE status = 'verified' AND doc_id IS NULL UNION ALL
SELECT 'fact_gap', o_orderkey::VARCHAR FROM f WHERE status = 'named_gap' AND (gap_impact IS NULL OR next_evidence IS NULL) UNION ALL
SELECT 'fact_value', o_orderkey::VARCHAR FROM f WHERE status = 'named_gap' AND value IS NOT NULL
""",
)
def validate_facts(spark, sf):
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("field"),
        F.when(st == "F", "verified").when(st == "O", "named_gap").when(F.col("o_custkey") % 5 == 0, "odd").alias("status"),
        F.when(k % 3 == 0, F.col("o_orderpriority")).alias("value"), F.when(k % 4 == 0, "d").alias("doc_id"),
        F.when(k % 5 != 0, "g").alias("gap_impact"), F.when(k % 7 != 0, "n").alias("next_evidence"),
    )
    return ops.validate_facts(rows, F.col("o_orderkey")).select("rule", "entity")


@query(
    "f9_rederive",
    f"""
WITH e AS (SELECT o_orderkey, {SYL} AS s, {TXT} AS t, CASE WHEN o_custkey % 4 = 0 THEN 'L1' ELSE 'blocked' END AS level, o_custkey % 6 AS n_reasons, CASE WHEN o_orderkey % 3 > 0 THEN 'x' END AS v FROM orders)
SELECT 'level' AS rule, o_orderkey::VARCHAR AS entity FROM e WHERE level <> CASE WHEN s IS NOT DISTINCT FROM 'extracted' AND t = 'matched' THEN 'L1' ELSE 'blocked' END UNION ALL
SELECT 'reasons', o_orderkey::VARCHAR FROM e WHERE n_reasons = 0 UNION ALL
SELECT 'syllabus_status', o_orderkey::VARCHAR FROM e WHERE s IS NULL UNION ALL
SELECT 'syllabus_extracted_' || k, o_orderkey::VARCHAR FROM e, (SELECT unnest(['path', 'sha256', 'requirements_heading']) AS k) WHERE s = 'extracted' AND v IS NULL UNION ALL
SELECT 'syllabus_missing_' || k, o_orderkey::VARCHAR FROM e, (SELECT unnest(['gap_impact', 'next_evidence']) AS k) WHERE s = 'missing' AND v IS NULL UNION ALL
SELECT 'textbook_matched_' || k, o_orderkey::VARCHAR FROM e, (SELECT unnest(['doc_id', 'path', 'locator', 'row']) AS k) WHERE t = 'matched' AND v IS NULL UNION ALL
SELECT 'textbook_missing_' || k, o_orderkey::VARCHAR FROM e, (SELECT unnest(['gap_impact', 'next_evidence']) AS k) WHERE t = 'missing' AND v IS NULL
""",
)
def rederive(spark, sf):
    v = F.when(F.col("o_orderkey") % 3 > 0, "x")
    names = {f"{part}_{n}" for (part, _), ns in ops.REQUIRED_KEYS.items() for n in ns}
    ev = table(spark, sf, "orders").select(
        "o_orderkey", F.expr(SYL).alias("syllabus_status"), F.expr(TXT).alias("textbook_status"),
        F.when(F.col("o_custkey") % 4 == 0, "L1").otherwise("blocked").alias("level"), (F.col("o_custkey") % 6).alias("n_reasons"),
        *[v.alias(n) for n in sorted(names)],
    )
    return ops.rederive(ev, F.col("o_orderkey")).select("rule", "entity")


@query(
    "f10_digest_drift",
    f"""
SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN path || '.gone' ELSE path END AS path, CASE WHEN doc_id % 9 = 0 THEN 'missing_file' ELSE 'digest_mismatch' END AS problem
FROM ({FILES_SQL}) WHERE doc_id % 10 <> 0 AND (doc_id % 9 = 0 OR doc_id % 4 = 1)
""",
)
def digest_drift(spark, sf):
    d = F.col("doc_id")
    listing = source_files(spark, sf).filter(d % 10 != 0)
    recorded = listing.select(
        "doc_id", F.when(d % 9 == 0, F.concat("path", F.lit(".gone"))).otherwise(F.col("path")).alias("path"),
        F.when(d % 4 == 1, F.lit("0" * 64)).otherwise(F.col("digest")).alias("sha256"),
    )
    return ops.digest_drift(recorded, listing.select("path", "digest"), "doc_id")


@query(
    "f11_url_provenance",
    """
WITH e AS (SELECT o_orderkey, o_custkey, 'https://' || CASE WHEN o_orderkey % 3 = 0 THEN 'evilexample.cn' ELSE 'www.example.cn' END || '/' || o_custkey AS url FROM orders),
b AS (SELECT 'https://' || h || '/' || c_custkey AS url, c_acctbal > 0 AS auth, c_nationkey AS nk FROM customer, (SELECT unnest(['evilexample.cn', 'www.example.cn']) AS h) WHERE c_custkey % 4 <> 0),
j AS (SELECT e.*, b.url IS NOT NULL AS known, auth, nk FROM e LEFT JOIN b USING (url))
SELECT 'url_unknown' AS rule, o_orderkey::VARCHAR AS entity FROM j WHERE NOT known UNION ALL
SELECT 'url_not_authoritative', o_orderkey::VARCHAR FROM j WHERE known AND NOT auth UNION ALL
SELECT 'url_outside_domain', o_orderkey::VARCHAR FROM j WHERE known AND o_orderkey % 3 = 0 UNION ALL
SELECT 'url_code', o_orderkey::VARCHAR FROM j WHERE known AND o_orderkey % 25 <> nk
""",
)
def url_provenance(spark, sf):
    host = F.when(F.col("o_orderkey") % 3 == 0, "evilexample.cn").otherwise("www.example.cn")
    ev = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 25).alias("code"),
        F.concat(F.lit("https://"), host, F.lit("/"), F.col("o_custkey").cast("string")).alias("course_url"),
    )
    entries = table(spark, sf, "customer").filter(F.col("c_custkey") % 4 != 0).select(
        F.explode(F.array(F.lit("evilexample.cn"), F.lit("www.example.cn"))).alias("h"), "c_custkey",
        (F.col("c_acctbal") > 0).alias("authoritative"), F.col("c_nationkey").cast("bigint").alias("code"),
    ).withColumn("url", F.concat(F.lit("https://"), "h", F.lit("/"), F.col("c_custkey").cast("string")))
    found = ops.url_provenance(ev, entries, entries.select("url", "code"), "example.cn", "code", F.col("o_orderkey"))
    return found.select("rule", "entity")


@query(
    "f12_forbidden_artifacts",
    "SELECT DISTINCT l_orderkey, l_returnflag AS artifact FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'F'",
)
def forbidden_artifacts(spark, sf):
    ev = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "F", "L1").otherwise("blocked").alias("level"))
    made = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("artifact"))
    return ops.forbidden_artifacts(ev, made, "l_orderkey")


# stored and fresh evidence as JSON, with one kind of defect per divisor; stamps differ everywhere
DRIFT_SQL = """
SELECT o_orderkey, '' AS path, 'only_left' AS problem FROM orders WHERE o_orderkey % 10 = 0 UNION ALL
SELECT o_orderkey, '/status', 'differs' FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 10 <> 0 UNION ALL
SELECT o_orderkey, '/facts/1/value', 'kind' FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey % 10 <> 0 UNION ALL
SELECT o_orderkey, '/facts/2', 'only_right' FROM orders WHERE o_orderkey % 13 = 0 AND o_orderkey % 10 <> 0 UNION ALL
SELECT o_orderkey, '/syllabus/a~1b', 'only_left' FROM orders WHERE o_orderkey % 17 = 0 AND o_orderkey % 10 <> 0 UNION ALL
SELECT o_orderkey, '/syllabus', 'kind' FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey % 19 = 0 AND o_orderkey % 10 <> 0
"""


@query("f13_drift_paths", DRIFT_SQL)
def drift_paths(spark, sf):
    k = F.col("o_orderkey")

    def side(fresh):
        hit = lambda n: (k % n == 0) if fresh else F.lit(False)
        fact = lambda v: F.concat(F.lit('{"value": '), v, F.lit(f', "generated_at": "{int(fresh)}"}}'))
        facts = F.concat_ws(
            ", ", fact(F.concat(k.cast("string"), F.lit(".0" if fresh else ""))), fact(F.when(hit(11), "null").otherwise('"v"')), F.when(hit(13), '{"more": []}')
        )
        nested = F.concat(F.lit('{"a/b": '), k.cast("string"), F.lit(', "c": {}}'))
        syllabus = F.when(hit(17), '{"c": {}}').when(hit(19), "[1]").otherwise(nested)
        body = F.concat(
            F.lit(f'{{"generated_at": "{int(fresh)}", "status": "'), F.when(hit(7), "X").otherwise(F.col("o_orderstatus")), F.lit('", "facts": ['), facts,
            F.lit('], "syllabus": '), syllabus, F.lit("}"),
        )
        return body.alias("json")

    orders = wide(spark, sf, "orders")
    out = drift.value_drift(orders.select("o_orderkey", side(False)), orders.where(k % 10 != 0).select("o_orderkey", side(True)), "o_orderkey", "json")
    return out.select("o_orderkey", "path", "problem")


@query(
    "f13_fresh_equal",
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'only_left' ELSE 'differs' END AS problem FROM orders WHERE o_orderkey % 10 = 0 OR (o_orderkey % 7 = 0 AND o_orderstatus <> 'X')
""",
)
def fresh_equal(spark, sf):
    orders = table(spark, sf, "orders")

    def side(df, stamp, mark):
        entry = F.struct(F.col("o_totalprice").alias("price"), F.lit(stamp).alias("generated_at"))
        return df.select(
            "o_orderkey", F.lit(stamp).alias("generated_at"), mark.alias("status"), entry.alias("one"), F.array(entry).alias("many"),
            F.create_map(F.lit("k"), entry).alias("keyed"),
        )

    left = side(orders, "2024-01-01", F.col("o_orderstatus"))
    right = side(
        orders.filter(F.col("o_orderkey") % 10 != 0), "2025-05-05",
        F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")),
    )
    return ops.fresh_equal(left, right, "o_orderkey")


@query(
    "f14_publishable_value",
    f"SELECT o_orderkey, CASE WHEN status = 'verified' AND value IS NOT NULL THEN value ELSE o_orderkey::VARCHAR END AS shown FROM ({FACT_ROWS})",
)
def publishable_value(spark, sf):
    st = F.when(F.col("o_orderstatus") == "F", "verified").otherwise("named_gap")
    value = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority"))
    return table(spark, sf, "orders").select(
        "o_orderkey", ops.publishable_value(st, value, F.col("o_orderkey").cast("string")).alias("shown")
    )
