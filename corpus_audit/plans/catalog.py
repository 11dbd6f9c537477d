"""Queries of the catalogue family (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_audit.functions import text as tx
from corpus_audit.functions.text import FIVE_OR_MORE
from corpus_audit.operators import catalog as ops
from corpus_audit.operators import structure
from corpus_audit.plans import inputs
from corpus_audit.plans.registry import query, table
from corpus_audit.plans.structure import plan_lines

# catalogue records from lineitem: code = part, tier = return flag, path = supplier, line = order and line number
RECORDS = """
SELECT l_partkey AS code, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS tier, l_suppkey AS path, l_orderkey * 10 + l_linenumber AS line,
 CASE WHEN l_tax > 0 THEN l_quantity::INT END AS credits, CASE WHEN l_discount > 0 THEN l_linestatus END AS method, l_extendedprice AS price FROM lineitem
"""
ORDER = ["tier", "path", "line", "price"]
ORD = "(tier, path, line, price)"


def records(spark, sf):
    flag = F.col("l_returnflag")
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("code"),
        F.when(flag == "A", 1).when(flag == "N", 2).otherwise(3).alias("tier"),
        F.col("l_suppkey").alias("path"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity").cast("int")).alias("credits"),
        F.when(F.col("l_discount") > 0, F.col("l_linestatus")).alias("method"),
        F.col("l_extendedprice").alias("price"),
    )


@query(
    "e1_tier_waterfall",
    f"SELECT path, tier, count(*) AS n FROM ({RECORDS}) r WHERE tier = (SELECT min(tier) FROM ({RECORDS}) b WHERE b.path = r.path AND b.code = r.code) GROUP BY ALL",
)
def tier_waterfall(spark, sf):
    keyed = records(spark, sf).withColumn("entity", F.struct("path", "code"))
    return ops.tier_waterfall(keyed, "entity", "tier").groupBy("path", "tier").agg(F.count(F.lit(1)).alias("n"))


@query(
    "e2_find_declaring_doc",
    """
WITH d AS (SELECT source || '/' || printf('%08d', doc_id) AS path, doc_id % 700 AS k, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'K' ELSE '7' END AS tail FROM documents)
SELECT code, min(path) AS path FROM (SELECT printf('%06d', k) AS code, path FROM d WHERE tail <> '7' UNION ALL SELECT printf('%06d', k) || tail, path FROM d)
WHERE code IN (SELECT printf('%06d', p_partkey) FROM part UNION SELECT printf('%06d', p_partkey) || 'K' FROM part) GROUP BY code
""",
)
def find_declaring_doc(spark, sf):
    d = F.col("doc_id")
    tail = F.when(d % 3 == 0, "").when(d % 3 == 1, "K").otherwise("7")
    docs = table(spark, sf, "documents").select(
        F.concat_ws("/", "source", inputs.padded(d, 8)).alias("path"),
        F.concat("text", F.lit("\n专业代码： "), inputs.padded(d % 700, 6), tail, F.lit("。")).alias("text"),
    )
    code = inputs.padded(F.col("p_partkey"), 6)
    codes = table(spark, sf, "part").select(F.explode(F.array(code, F.concat(code, F.lit("K")))).alias("code"))
    return ops.find_declaring_doc(docs, codes)


@query(
    "e3_dropped_ledger",
    """
SELECT p_brand, count(*) FILTER (WHERE p_partkey % 7 <> 0) AS parsed, count(*) FILTER (WHERE p_partkey % 7 = 0) AS dropped, count(*) AS candidates FROM part GROUP BY p_brand
""",
)
def dropped_ledger(spark, sf):
    brands = table(spark, sf, "part").select("p_partkey", "p_brand")
    parsed, dropped = structure.fixed_width_rows(plan_lines(spark, sf), ["p_partkey"], digits=structure.FIVE_OR_MORE)
    return ops.dropped_ledger(parsed.join(brands, "p_partkey"), dropped.join(brands, "p_partkey"), ["p_brand"])


@query(
    "e4_first_value",
    f"""
SELECT code, arg_min(credits, {ORD}) FILTER (WHERE credits IS NOT NULL) AS credits, arg_min(method, {ORD}) FILTER (WHERE method IS NOT NULL) AS method FROM ({RECORDS}) GROUP BY code
""",
)
def first_value(spark, sf):
    return ops.first_value(records(spark, sf), "code", ["credits", "method"], ORDER)


CONFLICT_SQL = f"""
WITH l AS (SELECT code, 'credits' AS field, credits::VARCHAR AS value, tier, path, line, price FROM ({RECORDS}) WHERE credits IS NOT NULL UNION ALL
 SELECT code, 'method', method, tier, path, line, price FROM ({RECORDS}) WHERE method IS NOT NULL),
v AS (SELECT code, field, value, min({ORD}) AS o FROM l GROUP BY ALL), n AS (SELECT *, count(*) OVER (PARTITION BY code, field) AS n_values, row_number() OVER (PARTITION BY code, field ORDER BY o) AS position FROM v)
"""


@query(
    "e5_conflicts",
    CONFLICT_SQL + "SELECT code, field, value, o[1] AS tier, o[2] AS path, o[3] AS line, n_values, position FROM n WHERE n_values > 1",
)
def conflicts(spark, sf):
    keys = {"credits": F.col("credits"), "method": F.col("method")}
    out = ops.conflicts(records(spark, sf), "code", keys, ORDER).drop("price")
    return out.withColumn("position", F.col("position").cast("bigint"))


@query(
    "e6_consolidate",
    CONFLICT_SQL
    + f""", f AS (SELECT code, arg_min(credits, {ORD}) FILTER (WHERE credits IS NOT NULL) AS credits, arg_min(method, {ORD}) FILTER (WHERE method IS NOT NULL) AS method,
 count(DISTINCT path) AS n_groups, count(*) AS n_sources FROM ({RECORDS}) GROUP BY code),
c AS (SELECT code, count(DISTINCT field) AS n_conflicts FROM n WHERE n_values > 1 GROUP BY code)
SELECT f.*, coalesce(n_conflicts, 0) AS n_conflicts FROM f LEFT JOIN c USING (code)
""",
)
def consolidate(spark, sf):
    keys = {"credits": F.col("credits"), "method": F.col("method")}
    out = ops.consolidate(records(spark, sf), "code", ["credits", "method"], keys, ORDER, ["path"])
    return out


# every part is a record of the course that is its brand; the name is missing in every fourth
NAMED = "SELECT p_brand AS code, p_partkey AS line, CASE WHEN p_partkey % 4 <> 0 THEN p_name || '（' || p_size || '）' END AS name, p_size % 3 AS path FROM part"


@query(
    "e6_course_aliases",
    f"""
WITH c AS (SELECT code, arg_min(name, line) FILTER (WHERE name IS NOT NULL) AS name, count(DISTINCT path) AS n_groups, count(*) AS n_sources, count(DISTINCT lower(name)) > 1 AS clash FROM ({NAMED}) GROUP BY code)
SELECT code, name, n_groups, n_sources, clash::BIGINT AS n_conflicts,
 array_to_string(list_sort(list_distinct([a FOR a IN [replace(name, ' ', ''), replace(replace(name, '（', '('), '）', ')')] IF a <> '' AND a <> name])), '|') AS aliases FROM c
""",
)
def course_aliases(spark, sf):
    """Consolidated courses with the spelling variants of their first name in the row."""
    key = F.col("p_partkey")
    name = F.when(key % 4 != 0, F.concat("p_name", F.lit("（"), F.col("p_size").cast("string"), F.lit("）")))
    rows = table(spark, sf, "part").select(F.col("p_brand").alias("code"), key.alias("line"), name.alias("name"), (F.col("p_size") % 3).alias("path"))
    out = ops.consolidate(rows, "code", ["name"], {"name": tx.name_key("name")}, ["line"], ["path"], name="name")
    return out.withColumn("aliases", F.concat_ws("|", "aliases"))


@query("e6_members", f"SELECT DISTINCT code, path, tier FROM ({RECORDS})")
def members(spark, sf):
    return ops.members(records(spark, sf), "code", ["path", "tier"])


@query(
    "e6_ordered_sources",
    f"SELECT code, path, row_number() OVER (PARTITION BY code ORDER BY min({ORD})) AS position FROM ({RECORDS}) GROUP BY code, path",
)
def ordered_sources(spark, sf):
    return ops.ordered_sources(records(spark, sf), "code", ["path"], ORDER)


@query(
    "e7_group_summary",
    f"""
SELECT path, count(*) AS parsed_rows, count(DISTINCT code) AS n_codes, count(DISTINCT code) FILTER (WHERE method = 'O') AS n_practice FROM ({RECORDS}) GROUP BY path
""",
)
def group_summary(spark, sf):
    rows = records(spark, sf).withColumn("method", F.when(F.col("method") == "O", F.lit(ops.PRACTICE)).otherwise(F.col("method")))
    return ops.group_summary(rows, "path", "code", "method")


# catalogue of parts under brand-qualified names; every third part shares its plain name with others
CATALOG = """
SELECT printf('%05d', p_partkey) AS code, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_name || '（' || p_brand || ' ' || p_size || '）' END AS name, p_size % 3 + 1 AS tier FROM part
"""
QUERIES_SQL = """
SELECT p_partkey AS query_id, CASE p_partkey % 5 WHEN 0 THEN printf('%05d', (p_partkey * 2)) WHEN 1 THEN upper(replace(p_name, ' ', '  ')) WHEN 2 THEN p_name || '(' || p_brand || ' ' || p_size || ')'
 WHEN 3 THEN replace(p_name || '（' || p_brand || ' ' || p_size || '）', ' ', '') ELSE '' END AS query FROM part
"""


def catalog(spark, sf):
    qualified = F.concat("p_name", F.lit("（"), "p_brand", F.lit(" "), F.col("p_size").cast("string"), F.lit("）"))
    return table(spark, sf, "part").select(
        inputs.padded(F.col("p_partkey")).alias("code"),
        F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(qualified).alias("name"),
        (F.col("p_size") % 3 + 1).alias("tier"),
    )


def _norm(c: str) -> str:
    return f"lower(replace(replace({c}, '（', '('), '）', ')'))"


INDEX_SQL = f"""
SELECT key, code, min(name) AS name, min(tier) AS tier, max(hit) AS matched_by FROM (SELECT {_norm('name')} AS key, code, name, tier, 'name' AS hit FROM c UNION ALL
 SELECT {_norm("replace(name, ' ', '')")}, code, name, tier, 'alias' FROM c WHERE contains(name, ' ')) GROUP BY key, code
"""


@query(
    "e8_resolve",
    f"""
WITH c AS ({CATALOG}), q AS ({QUERIES_SQL}), i AS ({INDEX_SQL}),
n AS (SELECT query_id, trim(regexp_replace({_norm('query')}, ' +', ' ', 'g')) AS key FROM q WHERE NOT regexp_full_match(query, '[0-9]{{5}}')),
m AS (SELECT n.query_id, i.*, min(tier) OVER (PARTITION BY n.query_id) AS best FROM n LEFT JOIN i ON i.key = n.key),
b AS (SELECT query_id, count(code) AS k, min(code) AS code, min(name) AS name, min(matched_by) AS hit FROM m WHERE tier IS NOT DISTINCT FROM best GROUP BY query_id)
SELECT query_id, CASE k WHEN 0 THEN 'not_found' WHEN 1 THEN 'resolved' ELSE 'ambiguous' END AS status, CASE WHEN k = 1 THEN code END AS code, CASE WHEN k = 1 THEN name END AS name,
 CASE WHEN k = 1 THEN hit END AS matched_by, k AS n_candidates FROM b
UNION ALL SELECT query_id, CASE WHEN c.code IS NULL THEN 'not_found' ELSE 'resolved' END, c.code, c.name, CASE WHEN c.code IS NOT NULL THEN 'code' END, (c.code IS NOT NULL)::BIGINT
FROM q LEFT JOIN c ON c.code = q.query WHERE regexp_full_match(query, '[0-9]{{5}}')
""",
)
def resolve(spark, sf):
    k, name = F.col("p_partkey"), F.col("p_name")
    tail = F.concat("p_brand", F.lit(" "), F.col("p_size").cast("string"))
    q = (
        F.when(k % 5 == 0, inputs.padded(k * 2))
        .when(k % 5 == 1, F.upper(F.replace(name, F.lit(" "), F.lit("  "))))
        .when(k % 5 == 2, F.concat(name, F.lit("("), tail, F.lit(")")))
        .when(k % 5 == 3, F.replace(F.concat(name, F.lit("（"), tail, F.lit("）")), F.lit(" "), F.lit("")))
        .otherwise("")
    )
    return ops.resolve(table(spark, sf, "part").select(k.alias("query_id"), q.alias("query")), catalog(spark, sf), FIVE_OR_MORE)


@query(
    "e8_resolve_candidates",
    f"""
WITH c AS ({CATALOG}), i AS ({INDEX_SQL}), t AS (SELECT *, min(tier) OVER (PARTITION BY key) AS best FROM i), b AS (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM t WHERE tier = best)
SELECT key, code, name, matched_by FROM b WHERE n > 1
""",
)
def resolve_candidates(spark, sf):
    return ops.resolve_candidates(catalog(spark, sf))


@query(
    "e9_referential_check",
    """
SELECT DISTINCT 'code_unknown' AS rule, l_suppkey::VARCHAR AS entity, l_partkey::VARCHAR AS message FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 45) UNION ALL
SELECT 'code_repeated', l_suppkey::VARCHAR, l_partkey::VARCHAR FROM lineitem GROUP BY l_suppkey, l_partkey HAVING count(*) > 1 UNION ALL
SELECT 'group_empty', s.k::VARCHAR, '' FROM (SELECT s_suppkey * 2 AS k FROM supplier) s WHERE k NOT IN (SELECT l_suppkey FROM lineitem)
""",
)
def referential_check(spark, sf):
    children = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("grp"), F.col("l_partkey").alias("code"))
    parents = table(spark, sf, "part").filter(F.col("p_size") < 45).select(F.col("p_partkey").alias("code"))
    groups = table(spark, sf, "supplier").select((F.col("s_suppkey") * 2).alias("grp"))
    return ops.referential_check(children, parents, groups).select("rule", "entity", "message")


@query(
    "e10_locator_check",
    f"""
WITH l AS (SELECT doc_id, line_no, text || ' ' || printf('%05d', doc_id) || ' ' || printf('%05d', (doc_id * 7)) || '1' AS text FROM ({inputs.LINES})),
c AS (SELECT event_id AS cite_id, user_id AS doc_id, event_id % 12 + 1 AS line_no, printf('%05d', (user_id + (event_id % 3 = 2)::INT)) AS code, CASE WHEN event_id % 4 = 0 THEN printf('%05d', (user_id * 7)) END AS pair_code FROM events)
SELECT cite_id, doc_id, line_no, CASE WHEN text IS NULL THEN 'out_of_range' ELSE 'code_absent' END AS problem FROM c LEFT JOIN l USING (doc_id, line_no)
WHERE text IS NULL OR (pair_code IS NULL AND NOT contains(text, code)) OR (pair_code IS NOT NULL AND NOT (list_contains(string_split_regex(text, '[^0-9]+'), code) AND list_contains(string_split_regex(text, '[^0-9]+'), pair_code)))
""",
)
def locator_check(spark, sf):
    d = F.col("doc_id")
    five = lambda c: inputs.padded(c)
    lines = inputs.document_lines(spark, sf).withColumn(
        "text", F.concat("text", F.lit(" "), five(d), F.lit(" "), five(d * 7), F.lit("1"))
    )
    u, e = F.col("user_id"), F.col("event_id")
    cites = inputs.events(spark, sf).select(
        e.alias("cite_id"), u.alias("doc_id"), (e % 12 + 1).alias("line_no"),
        five(u + F.when(e % 3 == 2, 1).otherwise(0)).alias("code"), F.when(e % 4 == 0, five(u * 7)).alias("pair_code"),
    )
    return ops.locator_check(cites, lines, "doc_id", FIVE_OR_MORE)


@query(
    "e11_supersession",
    """
SELECT n_nationkey, n_name, CASE WHEN n_regionkey < 2 THEN 'NATION_' || (n_nationkey + 100) END AS target, CASE WHEN n_regionkey < 2 THEN 'archived' ELSE 'current' END AS state FROM nation
""",
)
def supersession(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    mapping = nation.filter(F.col("n_regionkey") < 2).select(
        F.col("n_name").alias("old_code"), F.concat(F.lit("NATION_"), (F.col("n_nationkey") + 100).cast("string")).alias("new_code")
    )
    return ops.supersession(nation.drop("n_regionkey"), mapping, "n_name")
