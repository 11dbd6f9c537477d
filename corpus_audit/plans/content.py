"""Queries of the content family (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_audit.functions import text as tx
from corpus_audit.operators import content as ops
from corpus_audit.operators import reach
from corpus_audit.plans import inputs
from corpus_audit.plans.registry import query, table, wide
from corpus_audit.scale import dealt, leaf_bytes

def _grams(id_col: str, name: str) -> str:
    return SQUEEZED_GRAMS.replace("{id}", id_col).replace("{t}", name)


SQUEEZED_GRAMS = (
    "SELECT {id} AS id, ch || lead(ch, 1) OVER w || lead(ch, 2) OVER w || lead(ch, 3) OVER w || lead(ch, 4) OVER w || "
    "lead(ch, 5) OVER w || lead(ch, 6) OVER w || lead(ch, 7) OVER w AS gram FROM ("
    "SELECT {id}, generate_subscripts(c, 1) AS i, unnest(c) AS ch FROM (SELECT {id}, string_split("
    + inputs.sql_squeeze("text")
    + ", '') AS c FROM {t})) WINDOW w AS (PARTITION BY {id} ORDER BY i)"
)
OVERLAP_SQL = f"""
WITH g AS (SELECT * FROM ({_grams('doc_id', 'documents')}) WHERE gram IS NOT NULL),
s AS (SELECT DISTINCT gram FROM ({_grams('item_id', 'benchmark')}) WHERE gram IS NOT NULL),
c AS (SELECT id, count(*) AS n, count(*) FILTER (WHERE gram IN (SELECT gram FROM s)) AS hit FROM g GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_grams, coalesce(hit, 0) AS n_shared,
       CASE WHEN n > 0 THEN hit / n ELSE 0.0 END::DOUBLE AS ratio
FROM documents d LEFT JOIN c ON c.id = d.doc_id
"""


def _overlap(spark, sf, **limits):
    return ops.ngram_overlap(
        wide(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark").select("text"), "doc_id", **limits
    )


@query("h12_ngram_overlap", OVERLAP_SQL)
def ngram_overlap(spark, sf):
    return _overlap(spark, sf)


@query("h12_filtered_overlap", OVERLAP_SQL)
def filtered_overlap(spark, sf):
    """The same where the source's grams are taken as too many to broadcast: a Bloom filter stands before the shuffle."""
    return _overlap(spark, sf, grams_limit=0)


@query(
    "h13_overlap_violations",
    f"SELECT o.doc_id, n_shared, ratio, quality FROM ({OVERLAP_SQL}) o LEFT JOIN labels l USING (doc_id) WHERE ratio > 0.2",
)
def overlap_violations(spark, sf):
    over = ops.overlap_violations(_overlap(spark, sf), "doc_id")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return over.join(labels, "doc_id", "left").select("doc_id", "n_shared", "ratio", "quality")


@query(
    "h13_exempt_samples",
    f"SELECT o.doc_id, n_shared, ratio FROM ({OVERLAP_SQL}) o WHERE ratio > 0.05 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)",
)
def exempt_samples(spark, sf):
    samples = table(spark, sf, "labels").filter(F.col("quality") == 1).select("doc_id")
    return ops.overlap_violations(_overlap(spark, sf), "doc_id", 0.05, samples).select("doc_id", "n_shared", "ratio")


# -- selection, jobs, merging -------------------------------------------------------------------

@query(
    "h1_select_units",
    """
WITH n AS (SELECT lower(n_name) AS slug, n_name AS label, n_nationkey::VARCHAR AS ord, n_regionkey < 3 AS chapter FROM nation),
s AS (SELECT DISTINCT s_nationkey::VARCHAR AS selector FROM supplier UNION SELECT 'nation_' || (s_nationkey * 2) FROM supplier)
SELECT slug AS name, 'picked' AS state FROM n WHERE slug IN (SELECT selector FROM s) OR label IN (SELECT selector FROM s)
   OR (chapter AND ord IN (SELECT selector FROM s))
UNION ALL
SELECT selector, 'unknown' FROM s WHERE selector NOT IN (SELECT slug FROM n UNION SELECT label FROM n UNION SELECT ord FROM n WHERE chapter)
""",
)
def select_units(spark, sf):
    units = table(spark, sf, "nation").select(
        F.lower("n_name").alias("slug"),
        F.col("n_name").alias("label"),
        F.col("n_nationkey").alias("ordinal"),
        F.when(F.col("n_regionkey") < 3, F.lit("chapter")).otherwise(F.lit("appendix")).alias("unit_class"),
    )
    selectors = table(spark, sf, "supplier").select(
        F.explode(
            F.array(
                F.col("s_nationkey").cast("string"),
                F.concat(F.lit("nation_"), (F.col("s_nationkey") * 2).cast("string")),
            )
        ).alias("selector")
    )
    picked, unknown = ops.select_units(units, selectors)
    return picked.select(F.col("slug").alias("name"), F.lit("picked").alias("state")).unionByName(
        unknown.select(F.col("selector").alias("name"), F.lit("unknown").alias("state"))
    )


DECLARED_TYPES = ["单项选择题", "简答题", "材料题", "论述题", "名词解释题"]


def _assign_sql() -> str:
    """The greedy takeover unrolled: one step per declared type, over all units at once."""
    steps = [
        "s0 AS (SELECT l_orderkey, l_linenumber::BIGINT AS pos, CASE min(l_returnflag) WHEN 'A' THEN '单项选择题' WHEN 'N' THEN '简答题' ELSE '材料题' END AS t FROM lineitem GROUP BY ALL)"
    ]
    for n, kind in enumerate(DECLARED_TYPES):
        steps.append(
            f"s{n + 1} AS (SELECT l_orderkey, pos, CASE WHEN NOT has AND pos = donor THEN '{kind}' ELSE t END AS t FROM (SELECT *, bool_or(t = '{kind}') OVER w AS has, "
            f"max(CASE WHEN c > 1 THEN pos END) OVER w AS donor FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, t) AS c FROM s{n}) WINDOW w AS (PARTITION BY l_orderkey)))"
        )
    return f"WITH {', '.join(steps)} SELECT l_orderkey, pos, t AS question_type FROM s{len(DECLARED_TYPES)}"


@query("h2_assign_types", _assign_sql())
def assign_types(spark, sf):
    points = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", F.col("l_linenumber").cast("bigint").alias("pos"))
        .agg(F.min("l_returnflag").alias("flag"))
        .select(
            "l_orderkey",
            "pos",
            F.when(F.col("flag") == "A", F.lit("识记")).when(F.col("flag") == "N", F.lit("领会")).otherwise(F.lit("应用")).alias("requirement"),
        )
    )
    return ops.assign_types(points, "l_orderkey", DECLARED_TYPES)


PROMPTS = {
    "explain": ("explain_point", "v1"), "memorize": ("memorize_point", "v1"), "drill": ("drill_point", "v1"),
    "stage_plan": ("stage_plan", "v1"),
}
JOBS_SQL = """
SELECT p_brand, p_partkey::VARCHAR AS point_id, k.kind_order, k.kind, k.kind || '_point' AS prompt_id, 'v1' AS prompt_version,
 substr(sha256('{"kind":"' || k.kind || '","p_name":"' || p_name || '","point_id":"' || p_partkey || '"}'), 1, 16) AS payload_hash
FROM part, (VALUES (0, 'explain'), (1, 'memorize'), (2, 'drill')) k(kind_order, kind)
UNION ALL
SELECT DISTINCT p_brand, NULL, 3, 'stage_plan', 'stage_plan', 'v1',
 substr(sha256('{"kind":"stage_plan","p_brand":"' || p_brand || '"}'), 1, 16) FROM part
"""


def _jobs(spark, sf):
    points = table(spark, sf, "part").select("p_brand", F.col("p_partkey").cast("string").alias("point_id"), "p_name")
    return ops.worklist(points, PROMPTS, "p_brand", ["point_id", "p_name"])


@query("h3_worklist", JOBS_SQL)
def worklist(spark, sf):
    return _jobs(spark, sf)


@query(
    "h4_replay_join",
    f"""
WITH j AS ({JOBS_SQL}),
r AS (SELECT DISTINCT prompt_id, prompt_version, payload_hash FROM j WHERE point_id::BIGINT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50))
SELECT point_id, kind, p_brand, CASE WHEN r.payload_hash IS NULL THEN 'missing' ELSE 'replayed' END AS state
FROM j LEFT JOIN r USING (prompt_id, prompt_version, payload_hash)
""",
)
def replay_join(spark, sf):
    jobs = _jobs(spark, sf)
    seen = table(spark, sf, "lineitem").filter(F.col("l_quantity") >= 50).select(F.col("l_partkey").cast("string").alias("point_id"))
    responses = jobs.join(seen.distinct(), "point_id", "left_semi").select("prompt_id", "prompt_version", "payload_hash").distinct()
    found, missing = ops.replay_join(jobs, responses)
    cols = ["point_id", "kind", "p_brand"]
    return found.select(*cols, F.lit("replayed").alias("state")).unionByName(
        missing.select(*cols, F.lit("missing").alias("state"))
    )


BLOCKS_OF_ORDERS = (
    "SELECT o_custkey AS course, o_orderpriority AS block_id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS point_id, "
    "o_orderkey FROM orders WHERE o_orderdate {cond}"
)


@query(
    "h5_merge_blocks",
    f"""
WITH e AS ({BLOCKS_OF_ORDERS.format(cond="< TIMESTAMP '1998-01-01'")}), n AS ({BLOCKS_OF_ORDERS.format(cond=">= TIMESTAMP '1997-07-01'")})
SELECT * FROM n UNION ALL
SELECT * FROM e WHERE point_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM n WHERE n.course = e.course AND n.block_id = e.block_id AND n.point_id IS NOT NULL)
""",
)
def merge_blocks(spark, sf):
    blocks = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("course"),
        F.col("o_orderpriority").alias("block_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("point_id"),
        "o_orderkey",
        "o_orderdate",
    )
    old = blocks.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")).drop("o_orderdate")
    new = blocks.filter(F.col("o_orderdate") >= F.lit("1997-07-01").cast("timestamp")).drop("o_orderdate")
    return ops.merge_blocks(old, new, "course")


@query(
    "h5_merge_problems",
    """
WITH b AS (SELECT o_custkey::VARCHAR AS course, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS block_id, o_orderpriority <> '5-LOW' AS point, o_orderdate < TIMESTAMP '1998-01-01' AS old FROM orders)
SELECT 'block_id_missing' AS rule, course AS entity, CASE WHEN old THEN 'existing' ELSE 'new' END AS message FROM b WHERE point AND block_id = '' UNION ALL
SELECT DISTINCT 'entity_mismatch', course, 'not part of this build' FROM b WHERE old AND course NOT IN (SELECT course FROM b WHERE NOT old)
""",
)
def merge_problems(spark, sf):
    blocks = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("course"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "").otherwise(F.col("o_orderpriority")).alias("block_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("point_id"),
        (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")).alias("old"),
    )
    return ops.merge_problems(blocks.filter("old"), blocks.filter("not old"), "course").select("rule", "entity", "message")


@query(
    "h6_canonical_order",
    """
WITH b AS (SELECT l_orderkey || '-' || l_linenumber AS pid, l_orderkey, l_linenumber, min(l_returnflag) AS flag, min(l_tax) AS tax, min(l_linestatus) AS st
           FROM lineitem GROUP BY l_orderkey, l_linenumber),
k AS (SELECT *, CASE WHEN tax = 0 THEN 'essay' WHEN flag = 'A' THEN 'explain' WHEN flag = 'N' THEN 'memorize' ELSE 'drill' END AS kind,
      CASE WHEN NOT (flag = 'N' AND st = 'F') THEN pid END AS point_id FROM b)
SELECT pid AS block_id, point_id, kind, (point_id IS NULL)::INT AS course_level,
 CASE WHEN point_id IS NOT NULL AND l_linenumber < 7 THEN (l_orderkey % 2)::BIGINT ELSE 0 END AS unit_class,
 CASE WHEN point_id IS NOT NULL AND l_linenumber < 7 THEN l_orderkey // 2 ELSE 0 END AS ordinal,
 CASE WHEN point_id IS NOT NULL AND l_linenumber < 7 THEN l_linenumber // 3 ELSE 0 END AS section_pos,
 CASE WHEN point_id IS NOT NULL AND l_linenumber < 7 THEN l_linenumber ELSE 0 END AS point_pos,
 CASE kind WHEN 'explain' THEN 1 WHEN 'memorize' THEN 2 WHEN 'drill' THEN 3 WHEN 'exam_strategy' THEN 4 ELSE 0 END AS kind_order,
 CASE WHEN kind = 'essay' THEN 'unknown kind' WHEN point_id IS NOT NULL AND l_linenumber >= 7 THEN 'unknown point' END AS order_problem
FROM k
""",
)
def canonical_order(spark, sf):
    pid = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_returnflag").alias("flag"), F.min("l_tax").alias("tax"), F.min("l_linestatus").alias("st")
    )
    blocks = lines.select(
        pid.alias("block_id"),
        F.when(~((F.col("flag") == "N") & (F.col("st") == "F")), pid).alias("point_id"),
        F.when(F.col("tax") == 0, F.lit("essay"))
        .when(F.col("flag") == "A", F.lit("explain"))
        .when(F.col("flag") == "N", F.lit("memorize"))
        .otherwise(F.lit("drill"))
        .alias("kind"),
    )
    order = lines.filter(F.col("l_linenumber") < 7).select(
        pid.alias("point_id"),
        (F.col("l_orderkey") % 2).alias("unit_class"),
        F.expr("l_orderkey div 2").alias("ordinal"),
        F.expr("cast(l_linenumber div 3 as int)").alias("section_pos"),
        F.col("l_linenumber").alias("point_pos"),
    )
    return ops.canonical_order(blocks, order, ops.BLOCK_KINDS)


# -- validation ---------------------------------------------------------------------------------

# blocks made from conversation turns: kind by role, marks and answers by text length
BLOCKS_SQL = r"""
SELECT conv_id AS course, conv_id || '-' || turn AS block_id, turn, role,
 CASE WHEN role = 'system' THEN 'exam_strategy' WHEN role = 'user' THEN CASE WHEN turn % 4 = 0 THEN 'explain' ELSE 'memorize' END
      WHEN turn % 9 = 8 THEN 'essay' ELSE 'drill' END AS kind,
 CASE WHEN role <> 'system' THEN 'p' || (turn // 2) END AS point_id,
 text || CASE WHEN length(text) % 2 = 0 THEN chr(10) || '### 要点梳理' || chr(10) || '### 易错点 记忆' ELSE '' END AS text_md,
 CASE WHEN role = 'assistant' AND length(text) % 5 <> 0 THEN
   CASE length(text) % 3 WHEN 0 THEN '**正确答案**：' || substr('ABCD', 1 + (length(text) % 4)::INT, 1) || CASE WHEN length(text) % 7 = 0 THEN '、B' ELSE '。解析 A' END
        WHEN 1 THEN '参考答案：' || CASE WHEN length(text) % 2 = 0 THEN '正确' ELSE '错误，x' END ELSE '略' END END AS answer_md,
 CASE length(text) % 3 WHEN 0 THEN '单项选择题' WHEN 1 THEN '判断题' ELSE '简答题' END AS question_type,
 CASE WHEN length(text) % 11 = 0 THEN 'official_sample' WHEN length(text) % 13 <> 0 THEN 'ai_generated' END AS source_kind,
 length(text) % 13 <> 12 AS ai_generated, CASE WHEN length(text) % 10 = 9 THEN 'approved' ELSE 'machine_draft' END AS review_state
FROM conversations
"""


def blocks(spark, sf):
    n = F.length("text")
    role = F.col("role")
    assistant = role == "assistant"
    answer = (
        F.when(
            n % 3 == 0,
            F.concat(
                F.lit("**正确答案**："), F.expr("substring('ABCD', 1 + length(text) % 4, 1)"),
                F.when(n % 7 == 0, F.lit("、B")).otherwise(F.lit("。解析 A")),
            ),
        )
        .when(n % 3 == 1, F.concat(F.lit("参考答案："), F.when(n % 2 == 0, F.lit("正确")).otherwise(F.lit("错误，x"))))
        .otherwise(F.lit("略"))
    )
    return wide(spark, sf, "conversations").select(
        F.col("conv_id").alias("course"),
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("block_id"),
        "turn",
        "role",
        F.when(role == "system", F.lit("exam_strategy"))
        .when(role == "user", F.when(F.col("turn") % 4 == 0, F.lit("explain")).otherwise(F.lit("memorize")))
        .when(F.col("turn") % 9 == 8, F.lit("essay"))
        .otherwise(F.lit("drill"))
        .alias("kind"),
        F.when(role != "system", F.concat(F.lit("p"), F.expr("turn div 2").cast("string"))).alias("point_id"),
        F.concat("text", F.when(n % 2 == 0, F.lit("\n### 要点梳理\n### 易错点 记忆")).otherwise(F.lit(""))).alias("text_md"),
        F.when(assistant & (n % 5 != 0), answer).alias("answer_md"),
        F.when(n % 3 == 0, F.lit("单项选择题")).when(n % 3 == 1, F.lit("判断题")).otherwise(F.lit("简答题")).alias("question_type"),
        F.when(n % 11 == 0, F.lit("official_sample")).when(n % 13 != 0, F.lit("ai_generated")).alias("source_kind"),
        (n % 13 != 12).alias("ai_generated"),
        F.when(n % 10 == 9, F.lit("approved")).otherwise(F.lit("machine_draft")).alias("review_state"),
    )


VALIDATE_SQL = rf"""
WITH b AS ({BLOCKS_SQL}),
p AS (SELECT DISTINCT course, point_id FROM b WHERE point_id IS NOT NULL AND turn < 6),
x AS (SELECT b.*, p.point_id IS NOT NULL AS known, b.kind IN ('explain', 'memorize', 'drill') AND p.point_id IS NOT NULL AND trim(text_md) <> '' AS live
      FROM b LEFT JOIN p ON p.course = b.course AND p.point_id = b.point_id),
f AS (
 SELECT 'ai_label' AS rule, course, block_id FROM x WHERE NOT ai_generated UNION ALL
 SELECT 'review_state', course, block_id FROM x WHERE review_state <> 'machine_draft' UNION ALL
 SELECT 'kind', course, block_id FROM x WHERE kind NOT IN ('explain', 'memorize', 'drill', 'exam_strategy') UNION ALL
 SELECT 'point_unknown', course, block_id FROM x WHERE kind IN ('explain', 'memorize', 'drill') AND NOT known UNION ALL
 SELECT 'explain_headings', course, block_id FROM x WHERE live AND kind = 'explain' AND NOT (contains(text_md, '### 要点梳理') AND contains(text_md, '### 易错点')) UNION ALL
 SELECT 'explain_short', course, block_id FROM x WHERE live AND kind = 'explain' AND length(text_md) < 120 UNION ALL
 SELECT 'memorize_weak', course, block_id FROM x WHERE live AND kind = 'memorize' AND (length(text_md) < 80 OR NOT regexp_matches(text_md, '记忆|口诀|对比|联想|串联|谐音|关键词|顺口溜')) UNION ALL
 SELECT 'drill_answer', course, block_id FROM x WHERE live AND kind = 'drill' AND answer_md IS NULL UNION ALL
 SELECT 'drill_source_kind', course, block_id FROM x WHERE live AND kind = 'drill' AND source_kind IS NULL UNION ALL
 SELECT 'drill_type', course, block_id FROM x WHERE live AND kind = 'drill' AND question_type = '简答题' UNION ALL
 SELECT 'strategy_short', course, block_id FROM x WHERE kind = 'exam_strategy' AND length(trim(text_md)) < 40)
SELECT rule, course || '/' || block_id AS entity FROM f UNION ALL
SELECT 'strategy_count', course::VARCHAR FROM b GROUP BY course HAVING count(*) FILTER (WHERE kind = 'exam_strategy') <> 1
"""


@query("h7_validate_blocks", VALIDATE_SQL)
def validate_blocks(spark, sf):
    b = blocks(spark, sf)
    points = b.filter((F.col("turn") < 6) & F.col("point_id").isNotNull()).select("course", "point_id")
    declared = (
        b.select("course").distinct()
        .select("course", F.explode(F.array(F.lit("单项选择题"), F.lit("判断题"))).alias("question_type"))
    )
    return ops.validate_blocks(b, points, declared, "course").select("rule", "entity")


@query(
    "h8_coverage_gaps",
    """
SELECT doc_id, kind FROM documents, (VALUES ('explain'), ('memorize')) k(kind)
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id AND ((kind = 'explain' AND quality = 1) OR (kind = 'memorize' AND toxic = 0)))
""",
)
def coverage_gaps(spark, sf):
    labels = table(spark, sf, "labels")
    made = labels.select(
        "doc_id",
        F.explode(
            F.array_compact(
                F.array(F.when(F.col("quality") == 1, F.lit("explain")), F.when(F.col("toxic") == 0, F.lit("memorize")))
            )
        ).alias("kind"),
    )
    return ops.coverage_gaps(table(spark, sf, "documents"), made, ["explain", "memorize"], ["doc_id"])


STAGES_SQL = """
WITH s AS (SELECT o_orderkey AS course, pos, CASE WHEN o_orderstatus = 'P' AND pos = 3 THEN '刷' ELSE name END AS stage,
  o_orderpriority AS goal, CASE WHEN o_totalprice < 10000 THEN ' ' ELSE 'done' END AS done_when,
  [o_orderstatus] AS inputs, CASE WHEN o_custkey % 50 = 0 THEN [] ELSE ['x'] END AS how, CASE WHEN o_custkey % 70 = 0 THEN [''] ELSE ['y'] END AS outputs
 FROM orders, (VALUES (1, '入门'), (2, '精读'), (3, '刷题'), (4, '冲刺'), (5, '复盘')) v(pos, name)
 WHERE NOT (o_orderpriority = '5-LOW' AND pos = 5))
"""


@query(
    "h9_validate_stages",
    STAGES_SQL
    + """
SELECT 'stage_name' AS rule, course::VARCHAR AS entity, pos::VARCHAR AS locator FROM s WHERE stage = '刷' UNION ALL
SELECT 'done_when_empty', course::VARCHAR, pos::VARCHAR FROM s WHERE trim(done_when) = '' UNION ALL
SELECT 'how_empty', course::VARCHAR, pos::VARCHAR FROM s WHERE len(how) = 0 UNION ALL
SELECT 'outputs_empty', course::VARCHAR, pos::VARCHAR FROM s WHERE outputs[1] = '' UNION ALL
SELECT 'stage_count', course::VARCHAR, NULL FROM s GROUP BY course HAVING count(*) <> 5
""",
)
def validate_stages(spark, sf):
    named = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("stage")) for i, n in enumerate(ops.STAGES, 1)])
    empty = F.array().cast("array<string>")
    stages = (
        table(spark, sf, "orders")
        .select("*", F.inline(named))
        .filter(~((F.col("o_orderpriority") == "5-LOW") & (F.col("pos") == 5)))
        .select(
            F.col("o_orderkey").alias("course"),
            "pos",
            F.when((F.col("o_orderstatus") == "P") & (F.col("pos") == 3), F.lit("刷")).otherwise(F.col("stage")).alias("stage"),
            F.col("o_orderpriority").alias("goal"),
            F.when(F.col("o_totalprice") < 10000, F.lit(" ")).otherwise(F.lit("done")).alias("done_when"),
            F.array("o_orderstatus").alias("inputs"),
            F.when(F.col("o_custkey") % 50 == 0, empty).otherwise(F.array(F.lit("x"))).alias("how"),
            F.when(F.col("o_custkey") % 70 == 0, F.array(F.lit(""))).otherwise(F.array(F.lit("y"))).alias("outputs"),
        )
    )
    return ops.validate_stages(stages, "course").select("rule", "entity", "locator")


@query(
    "h10_official_sample_rules",
    """
SELECT 'sample_locator' AS rule, doc_id::VARCHAR AS entity FROM documents WHERE lang = 'fr' UNION ALL
SELECT 'sample_length', doc_id::VARCHAR FROM documents WHERE length(text) + 1 > 200
""",
)
def official_sample_rules(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.col("text").alias("text_md"),
        F.lit(None).cast("string").alias("answer_md"),
        F.col("source").alias("prov_doc_id"),
        F.when(F.col("lang") == "fr", F.lit("")).otherwise(F.lit("L1")).alias("prov_locator"),
        F.lit("official").alias("prov_kind"),
    )
    return ops.official_sample_rules(docs, F.col("doc_id")).select("rule", "entity")


@query(
    "h11_emitted_texts",
    rf"""
WITH b AS ({BLOCKS_SQL})
SELECT label, sha256(text) AS digest FROM (
 SELECT 'block ' || block_id AS label, concat_ws(chr(10), text_md, answer_md) AS text FROM b UNION ALL
 SELECT 'stage_plan[' || (doc_id % 5) || ']·' || lang, concat_ws(chr(10), lang, source, text, 'out') FROM documents UNION ALL
 SELECT 'review_schedule.gap_impact', 'quality ' || quality FROM labels UNION ALL
 SELECT 'review_schedule.next_evidence', 'doc ' || doc_id FROM labels WHERE toxic = 0 UNION ALL
 SELECT 'review_schedule.plans[' || doc_id || 'd].spaced_repetition', '[1,3,7]' FROM labels WHERE quality = 1)
""",
)
def emitted_texts(spark, sf):
    docs = table(spark, sf, "documents")
    stages = docs.select(
        (F.col("doc_id") % 5 + 1).alias("pos"),
        F.col("lang").alias("stage"),
        F.col("source").alias("goal"),
        F.lit(None).cast("string").alias("done_when"),
        F.array("text").alias("inputs"),
        F.array().cast("array<string>").alias("how"),
        F.array(F.lit("out")).alias("outputs"),
    )
    labels = table(spark, sf, "labels").select(
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("gap_impact"),
        F.when(F.col("toxic") == 0, F.concat(F.lit("doc "), F.col("doc_id").cast("string"))).alias("next_evidence"),
        F.when(F.col("quality") == 1, F.concat(F.col("doc_id").cast("string"), F.lit("d"))).alias("tier"),
        F.lit("[1,3,7]").alias("spaced_repetition"),
    )
    return ops.emitted_texts(blocks(spark, sf), stages, labels).select("label", F.sha2("text", 256).alias("digest"))


@query(
    "h14_verbatim_windows",
    """
WITH p AS (SELECT doc_id, k, substr(text, k * 2000 + 1, 2200) AS piece FROM documents, unnest(range(0, length(text) // 2000 + 1)) u(k)),
w AS (SELECT doc_id, k * 2000 + i + 1 AS pos, substr(piece, i + 1, 201) AS g FROM p, unnest(range(0, least(2000, greatest(length(piece) - 200, 0)))) v(i)),
o AS (SELECT g, min(doc_id) AS a, max(doc_id) AS b FROM w GROUP BY g)
SELECT doc_id, count(*) AS n_positions, min(pos) AS first_pos, max(pos) AS last_pos FROM w JOIN o USING (g) WHERE a <> doc_id OR b <> doc_id GROUP BY doc_id
""",
)
def verbatim_windows(spark, sf):
    docs = wide(spark, sf, "documents").select("doc_id", "text")
    hits = ops.copied_windows(docs, "doc_id")
    return hits.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_positions"),
        F.min("pos").cast("bigint").alias("first_pos"),
        F.max("pos").cast("bigint").alias("last_pos"),
    )


@query(
    "h14_benchmark_windows",
    """
WITH b AS (SELECT substr(text, i + 1, 201) AS g FROM benchmark, unnest(range(0, greatest(length(text) - 200, 0))) u(i)),
p AS (SELECT doc_id, k, substr(text, k * 2000 + 1, 2200) AS piece FROM documents, unnest(range(0, length(text) // 2000 + 1)) u(k)),
w AS (SELECT doc_id, k * 2000 + i + 1 AS pos, substr(piece, i + 1, 201) AS g FROM p, unnest(range(0, least(2000, greatest(length(piece) - 200, 0)))) v(i))
SELECT doc_id, pos FROM w WHERE g IN (SELECT g FROM b)
""",
)
def benchmark_windows(spark, sf):
    docs = wide(spark, sf, "documents").select("doc_id", "text")
    bench = table(spark, sf, "benchmark").select("item_id", "text")
    return ops.verbatim_windows(docs, bench, "doc_id", "item_id")


# -- answers ------------------------------------------------------------------------------------

ANSWERS_SQL = rf"""
SELECT *, CASE WHEN contains(question_type, '选择') THEN 'single_choice' WHEN contains(question_type, '判断') THEN 'judgement' END AS family,
 CASE WHEN contains(question_type, '选择') THEN
   CASE WHEN regexp_extract(first, '{{S}}', 2) = '' THEN nullif(regexp_extract(first, '{{S}}', 1), '') END
 WHEN contains(question_type, '判断') THEN nullif(regexp_extract(first, '^\s*[*#\s]*(?:参考|正确)?答案[*\s]*[:：]\s*\**\s*(正确|错误)', 1), '') END AS label
FROM (SELECT *, split_part(answer_md, chr(10), 1) AS first FROM ({BLOCKS_SQL}) WHERE kind = 'drill')
""".replace("{S}", r"^\s*[*#\s]*(?:正确)?答案[*\s]*[:：]\s*\**\s*([A-D])(" + "[" + tx.MULTI_ANSWER_JOINERS + "]*[A-D])?")


@query(
    "b25_answer_label",
    f"SELECT block_id, family, label FROM ({ANSWERS_SQL})",
)
def answer_labels(spark, sf):
    drills = blocks(spark, sf).filter(F.col("kind") == "drill")
    return ops.label_answers(drills).select("block_id", "family", "label")


DIST_SQL = """
WITH a AS (SELECT source, CASE WHEN quality = 1 THEN 'A' ELSE 'B' END AS label FROM labels JOIN documents USING (doc_id) WHERE toxic = 0
  UNION ALL SELECT source, NULL FROM labels JOIN documents USING (doc_id) WHERE toxic = 1),
c AS (SELECT source, label, count(*) AS cnt FROM a GROUP BY ALL),
d AS (SELECT source, sum(cnt) FILTER (WHERE label IS NOT NULL)::BIGINT AS n, coalesce(sum(cnt) FILTER (WHERE label IS NULL), 0)::BIGINT AS unparseable,
  arg_max(label, (cnt, label)) FILTER (WHERE label IS NOT NULL) AS top, max(cnt) FILTER (WHERE label IS NOT NULL) AS top_count FROM c GROUP BY source)
SELECT source, 'single_choice' AS family, coalesce(n, 0) AS n, unparseable, top, coalesce(top_count, 0) AS top_count, top_count / n AS max_share, 40 AS limit_percent,
  CASE WHEN coalesce(n, 0) < 10 THEN 'insufficient-sample' WHEN top_count * 100 > 40 * n THEN 'biased' ELSE 'ok' END AS verdict FROM d
"""


def _answers(spark, sf):
    labels = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    return labels.select(
        "source",
        F.lit("single_choice").alias("family"),
        F.when(F.col("toxic") == 0, F.when(F.col("quality") == 1, F.lit("A")).otherwise(F.lit("B"))).alias("label"),
    )


@query("h15_answer_distribution", DIST_SQL)
def answer_distribution(spark, sf):
    return ops.answer_distribution(_answers(spark, sf), "source")


# both families from the answer lines of drills themselves
LABELLED_DIST_SQL = f"""
WITH a AS (SELECT course, family, label FROM ({ANSWERS_SQL}) WHERE family IS NOT NULL),
c AS (SELECT course, family, label, count(*) AS cnt FROM a GROUP BY ALL),
d AS (SELECT course, family, coalesce(sum(cnt) FILTER (WHERE label IS NOT NULL), 0)::BIGINT AS n, coalesce(sum(cnt) FILTER (WHERE label IS NULL), 0)::BIGINT AS unparseable,
  arg_max(label, (cnt, label)) FILTER (WHERE label IS NOT NULL) AS top, max(cnt) FILTER (WHERE label IS NOT NULL) AS top_count FROM c GROUP BY course, family)
SELECT course, family, n, unparseable, top, coalesce(top_count, 0) AS top_count FROM d
"""


@query("h15_labelled_answers", LABELLED_DIST_SQL)
def labelled_answers(spark, sf):
    drills = ops.label_answers(blocks(spark, sf).filter(F.col("kind") == "drill")).filter(F.col("family").isNotNull())
    return ops.answer_distribution(drills, "course").select("course", "family", "n", "unparseable", "top", "top_count")


@query(
    "h16_family_coverage",
    f"""
SELECT course, count(*) AS drills, count(*) FILTER (WHERE family = 'single_choice') AS single_choice, count(*) FILTER (WHERE family = 'judgement') AS judgement,
 count(*) > 0 AND count(family) = 0 AS family_not_matched FROM ({ANSWERS_SQL}) GROUP BY course
""",
)
def family_coverage(spark, sf):
    return ops.family_coverage(ops.label_answers(blocks(spark, sf).filter(F.col("kind") == "drill")), "course")


@query(
    "h19_ordered_names",
    """
WITH l AS (SELECT l_orderkey, l_linenumber AS pos, min(l_returnflag) AS left_name FROM lineitem GROUP BY ALL),
r AS (SELECT l_orderkey, l_linenumber AS pos, min(CASE WHEN l_partkey % 9 = 0 THEN 'Z' ELSE l_returnflag END) AS right_name FROM lineitem WHERE l_partkey % 11 <> 0 GROUP BY ALL)
SELECT * FROM l FULL JOIN r USING (l_orderkey, pos) WHERE left_name IS DISTINCT FROM right_name
""",
)
def ordered_names(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("pos", F.col("l_linenumber"))
    left = items.groupBy("l_orderkey", "pos").agg(F.min("l_returnflag").alias("name"))
    right = items.filter(F.col("l_partkey") % 11 != 0).groupBy("l_orderkey", "pos").agg(
        F.min(F.when(F.col("l_partkey") % 9 == 0, "Z").otherwise(F.col("l_returnflag"))).alias("name")
    )
    return ops.ordered_names_equal(left, right, ["l_orderkey"], "name")


@query(
    "h16_enforce_scope",
    f"""
WITH d AS ({DIST_SQL}), t AS (SELECT source, CASE WHEN bool_or(lang = 'fr') THEN NULL ELSE min(doc_id) % 2 = 0 END AS tracked FROM documents GROUP BY source),
j AS (SELECT d.* FROM d LEFT JOIN t USING (source) WHERE tracked IS DISTINCT FROM true)
SELECT 'unparseable' AS rule, source AS entity, family AS locator, unparseable::VARCHAR AS message FROM j WHERE unparseable > 0 UNION ALL
SELECT 'biased', source, family, top || ' ' || top_count FROM j WHERE verdict = 'biased'
""",
)
def enforce_scope(spark, sf):
    tracked = table(spark, sf, "documents").groupBy("source").agg(
        F.when(F.bool_or(F.col("lang") == "fr"), F.lit(None)).otherwise(F.min("doc_id") % 2 == 0).alias("tracked")
    )
    dist = ops.answer_distribution(_answers(spark, sf), "source")
    return ops.enforce_scope(dist, tracked, "source").select("rule", "entity", "locator", "message")


# -- page reach ---------------------------------------------------------------------------------

# sections of the "rendered" side: turns below 8, every third without its heading, every fourth emptied
SECTIONS_SQL = f"""
SELECT course, point_id, kind, CASE WHEN length(text_md) % 3 = 0 THEN NULL WHEN length(text_md) % 4 = 0 THEN '  ' ELSE text_md END AS body
FROM ({BLOCKS_SQL}) WHERE turn < 8 AND kind IN ('explain', 'memorize')
"""


def _sections(spark, sf):
    n = F.length("text_md")
    return (
        blocks(spark, sf)
        .filter((F.col("turn") < 8) & F.col("kind").isin("explain", "memorize"))
        .select(
            "course", "point_id", "kind",
            F.when(n % 3 == 0, F.lit(None)).when(n % 4 == 0, F.lit("  ")).otherwise(F.col("text_md")).alias("body"),
        )
    )


@query(
    "h17_point_reach",
    f"""
WITH b AS (SELECT DISTINCT course, point_id, kind FROM ({BLOCKS_SQL}) WHERE kind IN ('explain', 'memorize')), s AS ({SECTIONS_SQL}),
a AS (SELECT DISTINCT course, point_id FROM s), t AS (SELECT course, point_id, kind, max(body) AS body FROM s WHERE body IS NOT NULL GROUP BY ALL),
j AS (SELECT b.*, CASE WHEN a.course IS NULL THEN 'missing_anchor' WHEN t.body IS NULL THEN 'missing_heading' WHEN trim(t.body) = '' THEN 'empty_body' END AS problem
      FROM b LEFT JOIN a USING (course, point_id) LEFT JOIN t USING (course, point_id, kind))
SELECT * FROM j WHERE problem IS NOT NULL
""",
)
def point_reach(spark, sf):
    wanted = blocks(spark, sf).filter(F.col("kind").isin("explain", "memorize"))
    return ops.point_reach(wanted, _sections(spark, sf), ["course", "point_id"])


@query(
    "h18_count_reconcile",
    f"""
WITH e AS (SELECT course, kind, count(*) AS expected FROM ({BLOCKS_SQL}) GROUP BY ALL),
r AS (SELECT course, kind, count(*) AS rendered FROM ({BLOCKS_SQL}) WHERE length(text_md) % 3 <> 0 GROUP BY ALL)
SELECT course, kind, coalesce(expected, 0) AS expected, coalesce(rendered, 0) AS rendered FROM e FULL JOIN r USING (course, kind)
WHERE (kind IN ('explain', 'memorize') AND coalesce(rendered, 0) <> coalesce(expected, 0)) OR (kind = 'drill' AND coalesce(rendered, 0) < coalesce(expected, 0))
""",
)
def count_reconcile(spark, sf):
    b = blocks(spark, sf)
    shown = b.filter(F.length("text_md") % 3 != 0)
    return ops.count_reconcile(b, shown, ["course"], ["explain", "memorize"], ["drill"])


@query(
    "h19_field_reach",
    f"""
WITH b AS ({BLOCKS_SQL}), x AS (SELECT course, point_id, 'answer' AS field, answer_md AS value FROM b WHERE answer_md IS NOT NULL UNION ALL
 SELECT course, point_id, 'lead', substr(text_md, 1, 30) FROM b WHERE point_id IS NOT NULL),
s AS (SELECT course, point_id, max(text_md || coalesce(answer_md, '')) AS body FROM b WHERE role = 'assistant' AND turn < 8 GROUP BY ALL)
SELECT DISTINCT x.* FROM x LEFT JOIN s USING (course, point_id) WHERE NOT coalesce(contains(body, value), false)
""",
)
def field_reach(spark, sf):
    b = blocks(spark, sf).filter(F.col("point_id").isNotNull())
    fields = b.select(
        "course",
        "point_id",
        F.inline(
            F.array(
                F.struct(F.lit("answer").alias("field"), F.col("answer_md").alias("value")),
                F.struct(F.lit("lead").alias("field"), F.substring("text_md", 1, 30).alias("value")),
            )
        ),
    )
    page = (
        b.filter((F.col("role") == "assistant") & (F.col("turn") < 8))
        .groupBy("course", "point_id")
        .agg(F.max(F.concat("text_md", F.coalesce("answer_md", F.lit("")))).alias("body"))
    )
    return reach.missing_values(fields, page, ["course", "point_id"]).select("course", "point_id", "field", "value")


# practice pages made from orders: a heading with the point id for each line number, but for one in eight, which
# every third page has as the head of a longer id
PRACTICE_IDS = "SELECT o_orderkey, j, printf('%05d', o_orderkey) || '-ch01-s2-p' || j AS id, (o_orderkey + j) % 8 = 0 AS lost FROM orders, unnest(range(1, 8)) AS u(j)"


def practice_pages(spark, sf):
    k = F.col("o_orderkey")

    def line(j):
        point = F.concat(F.lit("### "), inputs.padded(k), F.lit(f"-ch01-s2-p{j}"))
        return F.when((k + j) % 8 != 0, point).when(k % 3 == 0, F.concat(point, F.lit("0")))

    fold = F.when(k % 20 == 0, "x <details>").when(k % 10 != 0, "<details><summary>答案</summary>")
    text = F.concat_ws("\n", F.lit("# 练习"), *[line(j) for j in range(1, 8)], fold, F.lit("end"))
    return table(spark, sf, "orders").where(k % 29 != 0).select(k.alias("entity"), F.lit(reach.PRACTICE_PAGE).alias("page"), text.alias("text"))


def drill_blocks(spark, sf):
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    point = F.when(n % 7 != 0, F.concat(inputs.padded(k), F.lit("-ch01-s2-p"), n.cast("string")))
    return table(spark, sf, "lineitem").select(k.alias("entity"), F.when(F.col("l_returnflag") == "N", "explain").otherwise("drill").alias("kind"), point.alias("point_id"))


DRILL_REACH_SQL = f"""
WITH d AS (SELECT l_orderkey AS k, l_linenumber AS j FROM lineitem WHERE l_returnflag <> 'N'),
i AS (SELECT o_orderkey AS k, count(*) FILTER (NOT lost OR o_orderkey % 3 = 0) AS shown FROM ({PRACTICE_IDS}) WHERE o_orderkey % 29 <> 0 GROUP BY 1),
n AS (SELECT k, count(*) AS drills, any_value(coalesce(shown, 0)) AS shown FROM d LEFT JOIN i USING (k) GROUP BY k)
SELECT 'drill_headings' AS rule, k::VARCHAR AS entity, shown || ' of ' || drills AS message FROM n WHERE shown < drills UNION ALL
SELECT 'answers_unfolded', k::VARCHAR, 'practice.md' FROM n WHERE k % 10 = 0 OR k % 29 = 0 UNION ALL
SELECT DISTINCT 'drill_anchor', k::VARCHAR, printf('%05d', k) || '-ch01-s2-p' || j FROM d WHERE j % 7 <> 0 AND (k % 29 = 0 OR ((k + j) % 8 = 0 AND k % 3 <> 0))
"""


def drill_findings(spark, sf):
    return reach.drill_reach(drill_blocks(spark, sf), practice_pages(spark, sf), "entity", tx.FIVE_OR_MORE)


@query("h18_drill_reach", DRILL_REACH_SQL)
def drill_reach(spark, sf):
    return drill_findings(spark, sf).select("rule", "entity", "message")


# study plans made from orders, with one kind of defect per divisor
PLAN_STAGES = ", ".join(f"({i}, '{name}')" for i, name in enumerate(ops.STAGES, 1))
PLAN_REACH_SQL = f"""
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS p FROM orders), s AS (SELECT * FROM (VALUES {PLAN_STAGES}) v(i, stage))
SELECT 'stage_names' AS rule, k::VARCHAR AS entity, (SELECT string_agg(stage, '|' ORDER BY i) FROM s WHERE i <> 3) AS message FROM o WHERE k % 7 = 0 AND k % 31 <> 0 UNION ALL
SELECT 'stage_names', k::VARCHAR, '' FROM o WHERE k % 31 = 0 UNION ALL
SELECT 'done_when', k::VARCHAR, stage FROM o, s WHERE (k % 5 = 0 AND i = 2) OR k % 31 = 0 UNION ALL
SELECT 'inputs', k::VARCHAR, stage FROM o, s WHERE (k % 11 = 0 AND i = 4) OR k % 31 = 0 UNION ALL
SELECT f, k::VARCHAR, stage FROM o, s, unnest(['goal', 'how', 'outputs']) AS u(f) WHERE k % 31 = 0 UNION ALL
SELECT 'strategy_section', k::VARCHAR, 'st' || k FROM o WHERE k % 13 = 0 OR k % 31 = 0 UNION ALL
SELECT 'strategy_text', k::VARCHAR, 'st' || k FROM o WHERE k % 6 = 0 AND k % 13 <> 0 AND k % 31 <> 0 UNION ALL
SELECT 'gap_section', k::VARCHAR, '命名缺口' FROM o WHERE c % 2 = 0 AND k % 17 = 0 UNION ALL
SELECT 'gap_impact', k::VARCHAR, '影响' || k || '。' FROM o WHERE c % 2 = 0 AND k % 17 <> 0 AND k % 9 = 0 UNION ALL
SELECT 'tier', k::VARCHAR, '强化' FROM o WHERE c % 2 <> 0 AND k % 10 = 0
"""


def plan_contents(spark, sf):
    k = F.col("o_orderkey").cast("string")

    def stage(i, name):
        items = {f: F.array(F.concat(F.lit(f"{f}{i}-"), k, F.lit("。"))) for f in reach.STAGE_LISTS}
        items["inputs"] = F.array(F.concat(F.lit(f"inputs{i}-"), k, F.lit("。")), F.lit(""), F.concat(F.lit(f"资料{i}-"), F.col("o_custkey").cast("string"), F.lit("。")))
        done = F.concat(F.lit(f"done{i} "), "o_orderpriority", F.lit("。"))
        return F.struct(F.lit(name).alias("stage"), *[v.alias(f) for f, v in items.items()], done.alias("done_when"))

    gap = F.col("o_custkey") % 2 == 0
    schedule = F.struct(
        F.when(gap, reach.NAMED_GAP).otherwise("planned").alias("status"), F.concat(F.lit("影响"), k, F.lit("。")).alias("gap_impact"),
        F.concat(F.lit("证据"), k, F.lit("。")).alias("next_evidence"), F.array(*map(F.lit, ("基础", "标准", "强化"))).alias("tiers"),
    )
    # shuffled as orders, not as the texts made of them; a plan has about four times the bytes that an order's shuffle is reckoned for
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return dealt(orders, "o_orderkey", size=4 * leaf_bytes(orders)).select(
        F.col("o_orderkey").alias("entity"), "o_custkey", F.array(*[stage(i, n) for i, n in enumerate(ops.STAGES, 1)]).alias("stage_plan"),
        F.array(F.struct(F.concat(F.lit("st"), k).alias("block_id"), F.concat(F.lit(" 策略"), k, F.lit("。\n")).alias("text_md"))).alias("strategies"), schedule.alias("schedule"),
    )


def plan_pages(spark, sf):
    content, k = plan_contents(spark, sf), F.col("entity")

    def lines(i, name):
        s = F.col("stage_plan")[i - 1]
        values = [s["goal"][0], s["how"][0], s["outputs"][0], s["inputs"][0], F.when(F.lit(i != 4) | (k % 11 != 0), s["inputs"][2])]
        return [F.when(F.lit(i != 3) | (k % 7 != 0), f"### 阶段：{name} "), *values, F.when(F.lit(i != 2) | (k % 5 != 0), s["done_when"])]

    text = F.trim(F.col("strategies")[0]["text_md"])
    strategy = [F.when(k % 13 != 0, "## 应试策略"), F.when(k % 6 != 0, text), F.lit("## 其他"), F.when(k % 6 == 0, text)]
    plan = F.concat_ws("\n", F.lit("# 计划"), *[x for i, n in enumerate(ops.STAGES, 1) for x in lines(i, n)], *strategy)
    schedule, gap = F.col("schedule"), F.col("o_custkey") % 2 == 0
    impact = schedule["gap_impact"]
    review = F.when(
        gap, F.concat_ws("\n", F.when(k % 9 == 0, impact), F.when(k % 17 != 0, "## 命名缺口"), F.when(k % 9 != 0, impact), schedule["next_evidence"])
    ).otherwise(F.concat_ws("\n", F.lit("第一档（基础）第二档（标准）"), F.when(k % 10 != 0, "（强化）")))
    both = F.array(F.struct(F.lit(reach.PLAN_PAGE).alias("page"), plan.alias("text")), F.struct(F.lit(reach.REVIEW_PAGE).alias("page"), review.alias("text")))
    return content.select("entity", F.inline(both)).where((F.col("page") != reach.PLAN_PAGE) | (k % 31 != 0))


def plan_findings(spark, sf):
    return reach.plan_reach(plan_contents(spark, sf), plan_pages(spark, sf), "entity")


@query("h19_plan_reach", PLAN_REACH_SQL)
def plan_reach(spark, sf):
    return plan_findings(spark, sf).select("rule", "entity", "message")


@query(
    "h20_page_marks",
    """
WITH p AS (SELECT CASE WHEN page_id % 5 = 0 THEN 'index.md' WHEN page_id % 5 = 1 THEN 'plan.md' WHEN page_id % 5 = 2 THEN 'knowledge/' || page_id || '.md' ELSE 'other-' || page_id || '.md' END AS path,
  contains(html, '<!-- ad ') AS mark, contains(html, 'class="ad"') AS banner FROM pages)
SELECT 'marker_missing' AS rule, path AS entity FROM p WHERE NOT mark UNION ALL
SELECT 'banner_on_official', path FROM p WHERE path = 'index.md' AND banner UNION ALL
SELECT 'banner_missing', path FROM p WHERE (path = 'plan.md' OR path LIKE 'knowledge/%') AND NOT banner
""",
)
def page_marks(spark, sf):
    i = F.col("page_id")
    pages = table(spark, sf, "pages").select(
        F.when(i % 5 == 0, F.lit("index.md"))
        .when(i % 5 == 1, F.lit("plan.md"))
        .when(i % 5 == 2, F.concat(F.lit("knowledge/"), i.cast("string"), F.lit(".md")))
        .otherwise(F.concat(F.lit("other-"), i.cast("string"), F.lit(".md")))
        .alias("path"),
        "html",
    )
    found = ops.page_marks(pages, "path", "html", "<!-- ad ", 'class="ad"', ["plan.md", "knowledge/*.md"], ["index.md"])
    return found.select("rule", "entity")


@query(
    "h21_blockquote_rules",
    f"""
WITH q AS (SELECT doc_id, line_no, {inputs.sql_strip("ltrim(" + inputs.sql_strip('text') + ", '>')")} AS quote FROM ({inputs.MD_LINES})
 WHERE regexp_matches(text, '^{inputs.SQL_SPACE}*>'))
SELECT 'quote_long' AS rule, doc_id::VARCHAR AS entity, 'L' || line_no AS locator FROM q WHERE length(quote) > 80 UNION ALL
SELECT 'quote_question', doc_id::VARCHAR, 'L' || line_no FROM q WHERE regexp_matches(quote, 'the .*that')
""",
)
def blockquote_rules(spark, sf):
    lines = inputs.markdown_lines(spark, sf)
    return ops.blockquote_rules(lines, "doc_id", question="the .*that").select("rule", "entity", "locator")


@query(
    "h22_orphan_products",
    """
WITH s AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P'), r AS (SELECT l_orderkey AS k, count(*) FILTER (WHERE l_returnflag = 'R') AS n FROM lineitem GROUP BY 1)
SELECT coalesce(s.k, r.k) AS order_key, coalesce(n, 0) AS banner_pages, CASE WHEN s.k IS NULL THEN 'source_missing' ELSE 'not_rendered' END AS problem
FROM s FULL JOIN r ON s.k = r.k WHERE (s.k IS NULL AND n > 0) OR r.k IS NULL
""",
)
def orphan_products(spark, sf):
    source = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("order_key"))
    made = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), (F.col("l_returnflag") == "R").alias("has_banner")
    )
    return ops.orphan_products(source, made, "order_key")


@query(
    "h23_filler_lines",
    f"""
SELECT doc_id, count(*) AS filler, count(*) > 2 AS over_budget FROM ({inputs.LINES}) WHERE regexp_matches(text, '^[A-Z][a-z]{{0,3}} .{{0,80}}[.]$') GROUP BY doc_id
""",
)
def filler_lines(spark, sf):
    lines = inputs.document_lines(spark, sf)
    return ops.filler_lines(lines, "doc_id", 2, r"^[A-Z][a-z]{0,3} .{0,80}[.]$")


@query(
    "h24_derived_equals_source",
    """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
 AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
 AND (o_custkey, o_orderstatus) NOT IN (SELECT (o_custkey, o_orderstatus) FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
""",
)
def derived_equals_source(spark, sf):
    orders = table(spark, sf, "orders")
    derived = orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp"))
    source = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp"))
    return ops.derived_equals_source(derived, source, "o_custkey", "o_orderstatus", "o_orderkey")


@query(
    "h25_claim_conflicts",
    """
WITH t AS (SELECT doc_id, 'AI 生成 ' || text || CASE WHEN length(text) % 4 = 0 THEN ' 没有任何 AI 内容' ELSE '' END || CASE WHEN length(text) % 5 = 0 THEN ' 缺少第 6 章' ELSE '' END AS text FROM documents),
j AS (SELECT t.*, CASE WHEN quality = 1 THEN 'matched' WHEN quality = 0 THEN 'missing' END AS st FROM t LEFT JOIN labels USING (doc_id))
SELECT 'claims_matched' AS rule, doc_id::VARCHAR AS entity, coalesce(st, '') AS message FROM j WHERE contains(text, 'tion') AND st IS DISTINCT FROM 'matched' UNION ALL
SELECT 'denies_ai', doc_id::VARCHAR, '没有任何 AI 内容' FROM j WHERE contains(text, '没有任何 AI 内容') UNION ALL
SELECT 'missing_chapter', doc_id::VARCHAR, '缺少第 6 章' FROM j WHERE contains(text, '缺少第 6 章')
""",
)
def claim_conflicts(spark, sf):
    n = F.length("text")
    texts = table(spark, sf, "documents").select(
        "doc_id",
        F.concat(
            F.lit("AI 生成 "), "text", F.when(n % 4 == 0, F.lit(" 没有任何 AI 内容")).otherwise(F.lit("")),
            F.when(n % 5 == 0, F.lit(" 缺少第 6 章")).otherwise(F.lit("")),
        ).alias("text"),
    )
    status = table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, F.lit("matched")).otherwise(F.lit("missing")).alias("plan_status")
    )
    return ops.claim_conflicts(texts, status, "doc_id", "tion").select("rule", "entity", "message")


@query(
    "h26_scope_gaps",
    """
SELECT n_nationkey, template FROM nation, (SELECT unnest(['BUILDING', 'MACHINERY', 'HOUSEHOLD', 'SPACECRAFT']) AS template)
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_mktsegment = template AND c_nationkey = n_nationkey AND c_acctbal > 9000)
""",
)
def scope_gaps(spark, sf):
    scopes = table(spark, sf, "customer").filter(F.col("c_acctbal") > 9000).select(
        F.col("c_mktsegment").alias("template"), F.col("c_nationkey").alias("n_nationkey")
    )
    return ops.scope_gaps(table(spark, sf, "nation"), scopes, ["BUILDING", "MACHINERY", "HOUSEHOLD", "SPACECRAFT"], "n_nationkey")
