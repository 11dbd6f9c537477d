"""Queries of the scalar families (B: text, status, policy) and of the source readers (A)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_audit.functions import policy as po
from corpus_audit.functions import status as st
from corpus_audit.functions import text as tx
from corpus_audit.operators import schedule as sched
from corpus_audit.plans import inputs
from corpus_audit.plans.registry import query, table
from corpus_audit.session import scratch_dir
from corpus_audit.sources import digests, files

# -- urls and paths -----------------------------------------------------------------------------

URL = "url || CASE page_id % 4 WHEN 0 THEN '。）' WHEN 1 THEN ').,' ELSE '' END"


def _urls(spark, sf):
    i = F.col("page_id")
    raw = F.concat("url", F.when(i % 4 == 0, "。）").when(i % 4 == 1, ").,").otherwise(""))
    return table(spark, sf, "pages").withColumn("raw", raw)


@query("b1_normalize_url", f"SELECT page_id, rtrim({URL}, '{tx.URL_TAIL}') AS url FROM pages")
def normalize_url(spark, sf):
    return _urls(spark, sf).select("page_id", tx.normalize_url("raw").alias("url"))


@query(
    "b2_host_of",
    "SELECT page_id, CASE page_id % 3 WHEN 2 THEN '' ELSE lower(split_part(split_part(url, '/', 3), ':', 1)) END AS host FROM pages",
)
def host_of(spark, sf):
    i = F.col("page_id")
    shaped = (
        F.when(i % 3 == 0, F.upper("url"))
        .when(i % 3 == 1, F.regexp_replace("url", r"^(https?://)([^/]+)", "$1user:pw@$2:8080"))
        .otherwise(F.regexp_replace("url", r"^https?://", ""))
    )
    return table(spark, sf, "pages").select("page_id", tx.host_of(shaped).alias("host"))


@query(
    "b3_is_in_domain",
    "SELECT page_id, split_part(url, '/', 3) = 'spam-farm.example.org' OR split_part(url, '/', 3) LIKE '%.example.net' AS inside, "
    "split_part(url, '/', 3) LIKE '%.ple.org' AS suffix_only FROM pages",
)
def is_in_domain(spark, sf):
    inside = tx.is_in_domain("url", "spam-farm.example.org") | tx.is_in_domain("url", "example.net")
    return table(spark, sf, "pages").select("page_id", inside.alias("inside"), tx.is_in_domain("url", "ple.org").alias("suffix_only"))


SQL_TAIL = "regexp_extract(regexp_extract(url, '^https?://[^/]+([^?#]*)', 1), '([^/]*)/*$', 1)"


@query(
    "b4_url_slug",
    f"""
SELECT page_id, coalesce(nullif(trim(CASE WHEN t LIKE '%.html' THEN replace(t, '.html', '') ELSE t END, '-.'), ''), 'index') AS slug, CASE WHEN t LIKE '%.html' THEN '.html' ELSE '.pdf' END AS ext
FROM (SELECT page_id, {SQL_TAIL} AS t FROM pages)
""",
)
def url_slug(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.url_slug("url").alias("slug"), tx.url_extension("url", ".pdf").alias("ext"))


@query(
    "b5_entity_code_from_path",
    "SELECT page_id, CASE WHEN page_id % 4 < 3 THEN printf('%05d', page_id) END AS code, CASE WHEN page_id % 4 < 3 THEN '/courses/' || printf('%05d', page_id) || '/' END AS route FROM pages",
)
def entity_code(spark, sf):
    i = F.col("page_id")
    code = inputs.padded(i)
    path = (
        F.when(i % 4 == 0, F.concat(F.lit("courses/"), code, F.lit(".md")))
        .when(i % 4 == 1, F.concat(F.lit("x/"), code, F.lit("/sources.MD")))
        .when(i % 4 == 2, code)
        .otherwise(F.concat(F.lit("x/"), code, F.lit("/sources.txt")))
    )
    return table(spark, sf, "pages").select("page_id", tx.entity_code_from_path(path, tx.FIVE_OR_MORE).alias("code"), tx.entity_route(path, tx.FIVE_OR_MORE).alias("route"))


@query(
    "b6_content_fingerprint",
    f"SELECT page_id, sha256({inputs.sql_fold("regexp_replace('id ' || '7777777' || page_id::VARCHAR || html, '[0-9]{6,}', '#', 'g')")}) AS digest FROM pages",
)
def content_fingerprint(spark, sf):
    volatile = F.concat(F.lit(" id  "), F.lit("7777777"), F.col("page_id").cast("string"), "html", F.lit("\n"))
    return table(spark, sf, "pages").select("page_id", tx.content_fingerprint(volatile).alias("digest"))


@query(
    "b7_whitespace",
    f"""
SELECT doc_id, sha256({inputs.sql_fold('t')}) AS folded, sha256({inputs.sql_squeeze('t')}) AS squeezed, sha256({inputs.sql_strip('t')}) AS stripped
FROM (SELECT doc_id, chr(12288) || replace(text, ' ', chr(28) || chr(160)) || chr(8232) AS t FROM documents)
""",
)
def whitespace(spark, sf):
    noisy = F.concat(F.lit("　"), F.replace("text", F.lit(" "), F.lit("\x1c\xa0")), F.lit(" "))
    return table(spark, sf, "documents").select("doc_id", noisy.alias("t")).select(
        "doc_id", F.sha2(tx.fold_ws("t"), 256).alias("folded"), F.sha2(tx.squeeze("t"), 256).alias("squeezed"),
        F.sha2(tx.strip_ws("t"), 256).alias("stripped"),
    )


@query("b8_name_key", "SELECT p_partkey, p_name AS name_key FROM part")
def name_key(spark, sf):
    # full-width capitals on even keys, shouted and padded ASCII on odd ones
    wide = F.translate(F.upper("p_name"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ ", "".join(chr(0xFF21 + n) for n in range(26)) + "　")
    noisy = F.when(F.col("p_partkey") % 2 == 0, wide).otherwise(F.concat(F.lit("  "), F.upper(F.replace("p_name", F.lit(" "), F.lit("  ")))))
    return table(spark, sf, "part").select("p_partkey", tx.name_key(noisy).alias("name_key"))


@query(
    "b9_aliases",
    """
SELECT p_partkey, alias FROM (SELECT p_partkey, unnest(list_distinct([replace(n, ' ', ''), replace(replace(n, '（', '('), '）', ')')])) AS alias, n
 FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name || '（' || p_brand || '）' ELSE p_name END AS n FROM part)) WHERE alias <> '' AND alias <> n
""",
)
def aliases(spark, sf):
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat("p_name", F.lit("（"), "p_brand", F.lit("）"))).otherwise(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", F.explode(tx.aliases_for(name)).alias("alias"))


CN = (
    "CASE WHEN {n} < 10 THEN substr('一二三四五六七八九', {n}, 1) WHEN {n} = 10 THEN '十' WHEN {n} < 20 THEN '十' || substr('一二三四五六七八九', {n} - 10, 1) "
    "ELSE substr('一二三四五六七八九', {n} // 10, 1) || '十' || CASE WHEN {n} % 10 > 0 THEN substr('一二三四五六七八九', {n} % 10, 1) ELSE '' END END"
)


@query(
    "b10_chinese_number",
    "SELECT p_partkey, p_size AS number, p_size AS chapter, CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS appendix FROM part",
)
def chinese_number(spark, sf):
    numeral = F.expr(CN.replace("{n}", "p_size").replace("//", "div"))
    shown = F.when(F.col("p_partkey") % 2 == 0, numeral).otherwise(F.col("p_size").cast("string"))
    label = F.concat(F.lit("第 "), shown, F.lit(" 章"))
    appendix = F.concat(F.lit("附录"), F.when(F.col("p_partkey") % 3 == 0, "：标题").otherwise(F.concat(shown, F.lit(" 标题"))))
    return table(spark, sf, "part").select(
        "p_partkey", tx.chinese_number(numeral).alias("number"), tx.chapter_number(label).alias("chapter"),
        tx.appendix_number(appendix).alias("appendix"),
    )


@query(
    "b11_bounded_quote",
    r"""
SELECT doc_id, line_no, CASE WHEN length(text) <= 60 THEN text WHEN regexp_matches(substr(text, 1, 60), '^(?s:.+)[，、：,;]') THEN
 rtrim(regexp_extract(substr(text, 1, 60), '^((?s:.+))[，、：,;]', 1), '，、：,;') ELSE substr(text, 1, 60) END AS quote FROM ("""
    + inputs.LINES + ")",
)
def bounded_quote(spark, sf):
    return inputs.document_lines(spark, sf).select("doc_id", "line_no", tx.bounded_quote("text").alias("quote"))


@query(
    "b12_split_phrases",
    f"""
SELECT doc_id, line_no, generate_subscripts(p, 1) - 1 AS pos, unnest(p) AS phrase FROM (SELECT doc_id, line_no,
 [x FOR x IN [trim(rtrim({inputs.sql_fold('y')}, '。'), ' ') FOR y IN string_split(replace(text, '. ', '。；'), '；')] IF x <> ''] AS p FROM ({inputs.LINES}))
""",
)
def split_phrases(spark, sf):
    lines = inputs.document_lines(spark, sf).withColumn("text", F.replace("text", F.lit(". "), F.lit("。；")))
    out = lines.select("doc_id", "line_no", F.posexplode(tx.split_phrases("text")).alias("pos", "phrase"))
    return out.withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "b13_ascii_slug",
    """
SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN 'known' WHEN n_nationkey % 5 = 1 THEN 'document-' || substr(sha256('国' || n_nationkey), 1, 12) ELSE 'nation-' || n_nationkey || '-x' END AS slug FROM nation
""",
)
def ascii_slug(spark, sf):
    k = F.col("n_nationkey")
    name = F.when(k % 5 == 1, F.concat(F.lit("国"), F.lit("家"))).otherwise(F.concat("n_name", F.lit("·X! ")))
    empty = F.concat(F.lit("document-"), F.substring(F.sha2(F.concat(F.lit("国"), k.cast("string")), 256), 1, 12))
    return table(spark, sf, "nation").select("n_nationkey", tx.ascii_slug(name, F.when(k % 5 == 0, "known"), empty).alias("slug"))


# -- status -------------------------------------------------------------------------------------

RAW_STATUS = (
    "CASE o_orderkey % 8 WHEN 0 THEN 'publishable' WHEN 1 THEN ' \"yellow\" ' WHEN 2 THEN '🟡 审查中' WHEN 3 THEN '🟢 green' WHEN 4 THEN '🔴 machine_ready' "
    "WHEN 5 THEN 'metadata-only' WHEN 6 THEN NULL ELSE 'nonsense ' || o_orderstatus END"
)
LIFE = (
    "CASE o_orderkey % 8 WHEN 0 THEN 'publishable' WHEN 1 THEN 'machine_ready' WHEN 2 THEN 'in_review' WHEN 3 THEN 'publishable' WHEN 4 THEN 'machine_ready' ELSE 'draft' END"
)
COMP_RAW = "CASE o_orderpriority WHEN '1-URGENT' THEN 'complete' WHEN '2-HIGH' THEN 'missing-source' WHEN '3-MEDIUM' THEN 'metadata-only' ELSE 'odd' END"
COMP = COMP_RAW.replace("'odd'", "'needs-review'")


def _status(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.expr(RAW_STATUS).alias("raw"), F.expr(COMP_RAW).alias("comp"), (F.col("o_custkey") % 3 == 0).alias("thin")
    )


@query(
    "b14_normalize_status",
    f"""
SELECT o_orderkey, {LIFE} AS lifecycle, {COMP} AS completeness,
 CASE o_orderkey % 8 WHEN 0 THEN 'publishable' WHEN 1 THEN 'machine_ready' ELSE 'draft' END AS legacy FROM orders
""",
)
def normalize_status(spark, sf):
    return _status(spark, sf).select(
        "o_orderkey", st.normalize_lifecycle("raw").alias("lifecycle"), st.normalize_completeness("comp").alias("completeness"),
        st.legacy_lifecycle("raw").alias("legacy"),
    )


MATURITY = (
    "CASE WHEN c IN ('missing-source', 'needs-review') AND l = 'draft' THEN 'red' WHEN l = 'publishable' AND c = 'complete' AND NOT thin THEN 'green' ELSE 'yellow' END"
)


@query(
    "b15_maturity_level",
    f"SELECT o_orderkey, {MATURITY} AS maturity FROM (SELECT o_orderkey, {LIFE} AS l, {COMP} AS c, o_custkey % 3 = 0 AS thin FROM orders)",
)
def maturity_level(spark, sf):
    return _status(spark, sf).select(
        "o_orderkey", st.maturity_level(st.normalize_lifecycle("raw"), st.normalize_completeness("comp"), F.col("thin")).alias("maturity")
    )


@query(
    "b16_display_status",
    f"""
SELECT o_orderkey, CASE l WHEN 'draft' THEN '🔴 建设中' WHEN 'machine_ready' THEN '🟡 机器初稿' WHEN 'in_review' THEN '🟡 审查中' ELSE '🟢 可发布' END AS display,
 CASE l WHEN 'draft' THEN 'red' WHEN 'publishable' THEN 'green' ELSE 'yellow' END AS colour,
 CASE o_orderkey % 8 WHEN 2 THEN 'yellow' WHEN 3 THEN 'green' ELSE 'red' END AS raw_colour FROM (SELECT o_orderkey, {LIFE} AS l FROM orders)
""",
)
def display_status(spark, sf):
    shown = st.display_status(st.normalize_lifecycle("raw"))
    return _status(spark, sf).select(
        "o_orderkey", shown.alias("display"), st.status_kind(shown).alias("colour"), st.status_kind(F.coalesce("raw", F.lit(""))).alias("raw_colour")
    )


@query(
    "b17_shapes",
    """
SELECT o_orderkey, regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AS iso, regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(t AS DATE) IS NOT NULL AS day,
 length(o_orderkey::VARCHAR) = 5 AS course, o_orderkey >= 1000 AND o_orderkey < 10000 AS major FROM (SELECT o_orderkey,
 CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') || '-31' WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') ELSE '' END AS t FROM orders)
""",
)
def shapes(spark, sf):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    text = (
        F.when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 4 == 1, F.concat(F.date_format(d, "yyyy-MM"), F.lit("-31")))
        .when(k % 4 == 2, F.date_format(d, "yyyy/MM/dd")).otherwise("")
    )
    code = k.cast("string")
    return table(spark, sf, "orders").select(
        "o_orderkey", tx.is_iso_date(text).alias("iso"), tx.is_calendar_date(text).alias("day"),
        tx.matches_code(code).alias("course"), tx.matches_code(F.concat(code, F.lit("08"), F.when(k >= 1000, "A").otherwise("")), "major").alias("major"),
    )


# -- Markdown fragments made from part / conversations rows -------------------------------------

def _pages(spark, sf):
    """One small Markdown page per part: frontmatter with continuation and duplicate, two tables, a title."""
    k = F.col("p_partkey")
    closing = F.when(k % 9 == 0, "").otherwise("---\n")
    return table(spark, sf, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size",
        F.concat(
            F.lit("---\ntitle: \""), "p_name", F.lit("\"\n  "), "p_brand", F.lit("\nlifecycle: draft\nlifecycle: "), "p_type",
            F.lit("\n\nperiods: [a"), F.col("p_size").cast("string"), F.lit(", 'b']\nno colon\n"), closing,
            F.lit("\n# Part "), "p_brand", F.lit("\n\n| 字段 | 内容 |\n| --- | --- |\n| 名称 | "), "p_name", F.lit(" |\n| 学分 | 1 |\n| 学分 | "),
            F.col("p_size").cast("string"), F.lit(" |\nend\n| 学分 | 99 |\n| 名称 |\n"),
        ).alias("page"),
    )


@query(
    "b18_parse_frontmatter",
    """
SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_name || ' ' || p_brand END AS title, CASE WHEN p_partkey % 9 <> 0 THEN p_type END AS lifecycle,
 CASE WHEN p_partkey % 9 <> 0 THEN 3 ELSE 0 END AS n_keys FROM part
""",
)
def parse_frontmatter(spark, sf):
    fm = tx.parse_frontmatter("page")
    return _pages(spark, sf).select("p_partkey", fm.alias("fm")).select(
        "p_partkey", F.col("fm")["title"].alias("title"), F.col("fm")["lifecycle"].alias("lifecycle"), F.size("fm").alias("n_keys")
    )


@query(
    "b19_frontmatter_list",
    "SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN 'a' || p_size || '|b' ELSE '' END AS periods, p_brand || '|' || p_type AS nested FROM part",
)
def frontmatter_list(spark, sf):
    nested = F.concat(F.lit("items:\n  - '"), "p_brand", F.lit("'\n  - "), "p_type", F.lit("\nnext: x"))
    return _pages(spark, sf).select(
        "p_partkey",
        F.array_join(tx.frontmatter_list(tx.frontmatter_block("page"), "periods"), "|").alias("periods"),
        F.array_join(tx.frontmatter_list(nested, "items"), "|").alias("nested"),
    )


@query("b20_parse_meta_table", "SELECT p_partkey, p_name AS name, p_size::VARCHAR AS credits, 2 AS n_keys FROM part")
def parse_meta_table(spark, sf):
    return _pages(spark, sf).select("p_partkey", tx.parse_meta_table("page").alias("m")).select(
        "p_partkey", F.col("m")["名称"].alias("name"), F.col("m")["学分"].alias("credits"), F.size("m").alias("n_keys")
    )


@query("b21_table_fields", "SELECT p_partkey, p_name AS name, '1' AS credits, 2 AS n_keys FROM part")
def table_fields(spark, sf):
    return _pages(spark, sf).select("p_partkey", tx.table_fields("page").alias("m")).select(
        "p_partkey", F.col("m")["名称"].alias("name"), F.col("m")["学分"].alias("credits"), F.size("m").alias("n_keys")
    )


@query("b22_heading_title", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '课程页' ELSE 'Part ' || p_brand END AS title FROM part")
def heading_title(spark, sf):
    page = F.when(F.col("p_partkey") % 3 == 0, F.replace("page", F.lit("\n# "), F.lit("\n## "))).otherwise(F.col("page"))
    return _pages(spark, sf).select("p_partkey", tx.heading_title(page).alias("title"))


@query(
    "b23_blank_comments",
    r"""
SELECT page_id, sha256(regexp_replace(t, '(?s)<!--.*?-->', chr(10), 'g')) AS digest FROM (SELECT page_id, replace(html, ' -->', chr(10) || '-->') AS t FROM pages)
""",
)
def blank_comments(spark, sf):
    # every comment of the derived text spans exactly one line break
    text = F.replace("html", F.lit(" -->"), F.lit("\n-->"))
    return table(spark, sf, "pages").select("page_id", F.sha2(tx.blank_comments(text), 256).alias("digest"))


@query(
    "b23_visible_lines",
    """
SELECT conv_id, turn, len(string_split(text, chr(10))) + 3 + i AS line_no, l[i] AS text FROM (SELECT conv_id, turn, text, string_split(text, chr(10)) AS l FROM conversations), unnest(range(1, len(l) + 1)) u(i)
UNION ALL
SELECT conv_id, turn, 2 * n + 4 + k, CASE WHEN k = n + 1 THEN 'end' ELSE '' END FROM (SELECT conv_id, turn, len(string_split(text, chr(10))) AS n FROM conversations WHERE turn % 2 = 0), unnest(range(0, n + 2)) u(k)
UNION ALL
SELECT conv_id, turn, 2 * n + 3 + i, CASE i WHEN 1 THEN '<!-- ' ELSE '' END || l[i] FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS l, len(string_split(text, chr(10))) AS n FROM conversations WHERE turn % 2 = 1), unnest(range(1, n + 1)) u(i)
UNION ALL
SELECT conv_id, turn, 3 * n + 3 + k, CASE k WHEN 1 THEN '' ELSE 'end' END FROM (SELECT conv_id, turn, len(string_split(text, chr(10))) AS n FROM conversations WHERE turn % 2 = 1), (SELECT unnest([1, 2]) AS k)
""",
)
def visible_lines(spark, sf):
    return _fenced(spark, sf).select("conv_id", "turn", F.inline(tx.visible_lines("page"))).withColumn("line_no", F.col("line_no").cast("bigint"))


def _fenced(spark, sf):
    """A fence with a look-alike inside, closed by a longer mark; then a comment that only even turns close."""
    return table(spark, sf, "conversations").select(
        "conv_id", "turn",
        F.concat(
            F.lit("```x\n"), "text", F.lit("\n~~~\n````\n"), "text", F.lit("\n<!-- "), "text", F.lit("\n"),
            F.when(F.col("turn") % 2 == 0, "-->").otherwise(""), F.lit("\nend"),
        ).alias("page"),
    )


@query(
    "b24_unclosed_comment",
    "SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN 2 * len(string_split(text, chr(10))) + 4 END AS line_no, turn % 2 = 1 AS hides_content FROM conversations",
)
def unclosed_comment(spark, sf):
    return _fenced(spark, sf).select("conv_id", "turn", tx.unclosed_comment("page").alias("c")).select(
        "conv_id", "turn", F.col("c.line_no").cast("bigint").alias("line_no"), "c.hides_content"
    )


@query(
    "b26_canonical_hash",
    """SELECT p_partkey, substr(sha256('{"brand":"' || p_brand || '","name":null,"size":' || p_size || '}'), 1, 16) AS hash FROM part""",
)
def canonical_hash(spark, sf):
    fields = {"size": F.col("p_size"), "name": F.lit(None).cast("string"), "brand": F.col("p_brand")}
    return table(spark, sf, "part").select("p_partkey", tx.canonical_hash(fields).alias("hash"))


@query(
    "b27_source_tier",
    "SELECT page_id, CASE WHEN url LIKE '%.html' THEN 1 WHEN contains(url, '/fr/') THEN 2 WHEN contains(url, '/de/') THEN 3 ELSE 4 END AS tier FROM pages",
)
def source_tier(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.source_tier("url", [".html", "fr", "de"]).alias("tier"))


@query(
    "b28_drop_sections",
    f"""
WITH m AS ({inputs.MD_LINES}), e AS (SELECT *, CASE WHEN text LIKE '## %' THEN CASE WHEN regexp_matches(text, '^##\\s+(来源|T|E)') THEN 'drop' ELSE 'keep' END WHEN text LIKE '# %' THEN 'keep' END AS ev FROM m)
SELECT doc_id, line_no, text FROM (SELECT *, last_value(ev IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS st FROM e) WHERE st IS DISTINCT FROM 'drop'
""",
)
def drop_sections(spark, sf):
    from corpus_audit.operators.structure import drop_sections as drop

    return drop(inputs.markdown_lines(spark, sf), ["doc_id"], ["来源", "T", "E"])


# -- policy -------------------------------------------------------------------------------------

LEAKY = (
    "CASE doc_id % 6 WHEN 0 THEN 'see https://github.com/o/private-store/blob/x.pdf ' WHEN 1 THEN 'at C:\\books\\e-books\\a ' WHEN 2 THEN 'use papers/' || source || '.pdf ' "
    "WHEN 3 THEN 'materials://e-books/' || source || '.pdf papers/a.pdf ' WHEN 4 THEN 'official.example e-books/a.zip ' ELSE '' END || text"
)


def _leaky(spark, sf):
    d = F.col("doc_id") % 6
    lead = (
        F.when(d == 0, "see https://github.com/o/private-store/blob/x.pdf ").when(d == 1, "at C:\\books\\e-books\\a ")
        .when(d == 2, F.concat(F.lit("use papers/"), "source", F.lit(".pdf ")))
        .when(d == 3, F.concat(F.lit("materials://e-books/"), "source", F.lit(".pdf papers/a.pdf ")))
        .when(d == 4, "official.example e-books/a.zip ").otherwise("")
    )
    return table(spark, sf, "documents").select("doc_id", "source", F.concat(lead, "text").alias("text"))


@query(
    "b29_leak_patterns",
    f"""
WITH l AS (SELECT doc_id, generate_subscripts(s, 1) AS line_no, unnest(s) AS text FROM (SELECT doc_id, string_split({LEAKY}, chr(10)) AS s FROM documents))
SELECT 'private_url' AS rule, doc_id, NULL::BIGINT AS line_no FROM documents WHERE doc_id % 6 = 0 UNION ALL
SELECT 'book_path', doc_id, NULL FROM documents WHERE doc_id % 6 = 1 UNION ALL
SELECT 'pdf_claim', doc_id, NULL FROM documents WHERE contains(text, 'tion') UNION ALL
SELECT 'line_leak', doc_id, line_no FROM l WHERE regexp_matches(text, '(?i)https://github[.]com/.+/(private-store/.+|raw|download)|(?:^|[\\s(])(?:[.][.]/)?(?:materials|e-books|papers|past-papers|syllabus|official-archives|official-packages)/[^\\s)]+[.](?:pdf|zip|rar)\\b')
 AND NOT contains(text, 'materials://') AND NOT contains(text, 'official.example')
""",
)
def leak_patterns(spark, sf):
    docs = _leaky(spark, sf)
    claim = F.concat(F.lit("`e-books\\x/"), F.when(F.col("text").contains("tion"), "a").otherwise("*"), F.lit(".pdf`"))
    flags = F.array_compact(
        F.array(
            F.when(po.has_private_url("text", "private-store"), "private_url"),
            F.when(po.has_windows_book_path("text"), "book_path"),
            F.when(F.size(po.unscoped_pdf_claims(claim)) > 0, "pdf_claim"),
        )
    )
    whole = docs.select(F.explode(flags).alias("rule"), "doc_id", F.lit(None).cast("bigint").alias("line_no"))
    lines = files.read_lines(docs, "doc_id").filter(po.line_leaks("text", "official.example", "private-store"))
    return whole.unionByName(lines.select(F.lit("line_leak").alias("rule"), "doc_id", F.col("line_no").cast("bigint").alias("line_no")))


REFS_SQL = f"""
SELECT page_id, i, href, CASE i % 5 WHEN 0 THEN 'materials://' || ltrim(href, '/') || '。' WHEN 1 THEN 'materials://a/..' || href WHEN 2 THEN 'materials://api-token' || href
 WHEN 3 THEN 'materials://...' ELSE 'materials://x' || href || ').' END AS raw FROM ({inputs.PAGE_LINKS})
"""


def _refs(spark, sf):
    i, href = F.col("i") % 5, F.col("href")
    m = F.lit("materials://")
    raw = (
        F.when(i == 0, F.concat(m, F.ltrim(href, F.lit("/")), F.lit("。"))).when(i == 1, F.concat(m, F.lit("a/.."), href))
        .when(i == 2, F.concat(m, F.lit("api-token"), href)).when(i == 3, F.concat(m, F.lit("...")))
        .otherwise(F.concat(m, F.lit("x"), href, F.lit(").")))
    )
    return inputs.page_links(spark, sf).select("page_id", "i", raw.alias("raw"))


@query(
    "b30_parse_ref",
    f"""
SELECT page_id, i, CASE WHEN i % 5 <> 3 THEN rtrim(substr(raw, 13), '{po.REF_TAIL.replace(chr(39), chr(39) * 2)}') END AS path,
 CASE i % 5 WHEN 1 THEN 'invalid:path-escape' WHEN 2 THEN 'invalid:sensitive' WHEN 3 THEN 'skipped-placeholder' ELSE CASE WHEN regexp_matches(raw, '(?i)secret|token|key|password') THEN 'invalid:sensitive' ELSE 'valid' END END AS state,
 CASE i % 5 WHEN 1 THEN 'bad materials path' WHEN 2 THEN 'sensitive word in path' END AS policy FROM ({REFS_SQL})
""",
)
def parse_ref(spark, sf):
    return _refs(spark, sf).select("page_id", "i", po.parse_ref("raw").alias("r"), po.ref_policy_error(F.substr(F.col("raw"), F.lit(13))).alias("policy")).select(
        "page_id", "i", "r.path", "r.state", "policy"
    )


@query(
    "b31_truncate_flag",
    f"SELECT doc_id, line_no, substr(text, 1, 200) AS value, length(text) > 200 AS truncated FROM ({inputs.LINES})",
)
def truncate_flag(spark, sf):
    return inputs.document_lines(spark, sf).select("doc_id", "line_no", tx.truncate_flag("text", 200).alias("t")).select("doc_id", "line_no", "t.*")


GRADES = [("^ECONOMY", "A"), ("Brand#1", "B"), ("[02468]$", "C")]


@query(
    "b32_classify",
    "SELECT p_partkey, CASE WHEN p_type LIKE 'ECONOMY%' THEN 'A' WHEN contains(p_brand, 'Brand#1') THEN 'B' WHEN p_size % 2 = 0 THEN 'C' ELSE 'D' END AS grade FROM part",
)
def classify(spark, sf):
    text = F.concat("p_type", F.lit(" "), "p_brand", F.lit(" "), F.col("p_size").cast("string"))
    return table(spark, sf, "part").select("p_partkey", tx.classify(text, GRADES, "D").alias("grade"))


@query(
    "b33_keyed_counts",
    """
SELECT event_id, CASE WHEN m < 3 THEN k ELSE 0 END AS normal, CASE WHEN m < 3 AND m <> 1 THEN k + 1 ELSE 0 END AS transition,
 CASE m WHEN 0 THEN 2 * k + 1 WHEN 1 THEN k WHEN 2 THEN 7 ELSE 0 END AS total FROM (SELECT event_id, event_id % 4 AS m, json_extract(props, '$.k')::BIGINT AS k FROM events)
""",
)
def keyed_counts(spark, sf):
    k = F.get_json_object("props", "$.k")
    k1 = (k.cast("bigint") + 1).cast("string")
    m = F.col("event_id") % 4
    text = (
        F.when(m == 0, F.concat(F.lit("x <!-- AUTO_GEN_COUNT: normal="), k, F.lit(" transition = "), k1, F.lit(" -->")))
        .when(m == 1, F.concat(F.lit("| AUTO_GEN_COUNT | normal = "), k, F.lit(" |")))
        .when(m == 2, F.concat(F.lit("auto_gen_count:\n  normal: "), k, F.lit("\n  transition: "), k1, F.lit("\n  total: 7")))
        .otherwise(F.col("props"))
    )
    return inputs.events(spark, sf).select("event_id", tx.keyed_counts(text).alias("c")).select("event_id", "c.*")


@query(
    "b34_normalize_href",
    f"""
SELECT page_id, i, CASE i % 6 WHEN 0 THEN '/base' || href WHEN 1 THEN '/base/majors/m' || page_id || '/#top' WHEN 2 THEN '/base/courses/' || printf('%05d', page_id) || '/'
 WHEN 3 THEN 'notes' || href WHEN 4 THEN url ELSE '#' || i END AS href FROM ({inputs.PAGE_LINKS})
""",
)
def normalize_href(spark, sf):
    i, p = F.col("i") % 6, F.col("page_id").cast("string")
    raw = (
        F.when(i == 0, F.col("href")).when(i == 1, F.concat(F.lit("../../majors/m"), p, F.lit("#top")))
        .when(i == 2, F.concat(F.lit("../courses/"), inputs.padded(F.col("page_id")), F.lit(".md")))
        .when(i == 3, F.concat(F.lit(" notes"), "href", F.lit(".md"))).when(i == 4, F.col("url"))
        .otherwise(F.concat(F.lit("#"), F.col("i").cast("string")))
    )
    return inputs.page_links(spark, sf).select("page_id", "i", tx.normalize_href(raw, "/base", tx.FIVE_OR_MORE).alias("href"))


@query(
    "b35_day_kind",
    """
SELECT p_partkey, d AS day, CASE WHEN d <= ceil(p_size / 2) THEN 'read' WHEN d <= ceil(p_size / 2) + ceil(p_size / 4) THEN 'drill' ELSE 'review' END AS kind
FROM part, unnest(range(1, p_size + 1)) u(d)
""",
)
def day_kind(spark, sf):
    days = table(spark, sf, "part").select("p_partkey", "p_size", F.explode(F.sequence(F.lit(1), "p_size")).alias("day"))
    return days.select("p_partkey", F.col("day").cast("bigint"), sched.day_kind(F.col("day"), F.col("p_size")).alias("kind"))


# -- sources ------------------------------------------------------------------------------------

@query(
    "a2_read_artifacts",
    """
SELECT event_id, CASE WHEN event_id % 7 = 1 THEN NULL WHEN event_id % 7 = 2 THEN NULL ELSE json_extract(props, '$.k')::BIGINT END AS k,
 CASE event_id % 7 WHEN 1 THEN 'undecodable' WHEN 2 THEN 'not an object' END AS problem FROM events
""",
)
def read_artifacts(spark, sf):
    text = F.when(F.col("event_id") % 7 == 1, F.concat(F.lit("{"), "props")).when(
        F.col("event_id") % 7 == 2, F.concat(F.lit("["), "props", F.lit("]"))
    ).otherwise(F.col("props"))
    raw = inputs.events(spark, sf).select("event_id", text.alias("text"))
    good, bad = files.parse_artifacts(raw, "event_id", "text", T.StructType([T.StructField("k", T.LongType())]))
    return good.select("event_id", "k", F.lit(None).cast("string").alias("problem")).unionByName(
        bad.select(F.col("entity").cast("bigint").alias("event_id"), F.lit(None).cast("bigint").alias("k"), F.col("message").alias("problem"))
    )


@query(
    "a5_digest",
    "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN sha256(source) ELSE sha256(text) END AS digest FROM documents",
)
def digest(spark, sf):
    pointer = F.concat(F.lit("version https://git-lfs.github.com/spec/v1\noid sha256:"), F.sha2("source", 256), F.lit("\nsize 12\n"))
    body = F.when(F.col("doc_id") % 3 == 0, pointer).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", body.alias("b")).select(
        "doc_id", files.declared_digest(F.col("b").cast("binary"), F.when(F.length("b") <= 256, F.col("b")).otherwise("")).alias("digest")
    )


@query(
    "a6_explode_keyed_json",
    """
SELECT event_id, 'u' || user_id AS entry_key, 'ok' AS status, json_extract(props, '$.k')::BIGINT AS n FROM events WHERE event_id % 5 <> 0 UNION ALL
SELECT event_id, 'v' || event_id, NULL, NULL FROM events WHERE event_id % 5 <> 0
""",
)
def explode_keyed_json(spark, sf):
    text = F.concat(
        F.lit('{"urls": {"u'), F.col("user_id").cast("string"), F.lit('": {"status": "ok", "n": '), F.get_json_object("props", "$.k"),
        F.lit('}, "v'), F.col("event_id").cast("string"), F.lit('": {}}'), F.when(F.col("event_id") % 5 == 0, "").otherwise("}"),
    )
    df = inputs.events(spark, sf).select("event_id", text.alias("text"))
    return files.explode_keyed_json(df, "event_id", "text", "urls", "struct<status:string,n:bigint>")


MANIFEST_RULES = [("/src[1-4]/", "textbooks"), ("/src[5-8]/", "past-papers"), ("/src9/", "syllabi")]


def source_files(spark, sf):
    """A file listing made from documents: folder = source, name = language and id."""
    return table(spark, sf, "documents").select(
        "doc_id", "text",
        F.concat(F.lit("in/"), "source", F.lit("/"), F.when(F.col("doc_id") % 10 == 0, "文件").otherwise(F.concat("lang", F.lit(" "), F.col("doc_id").cast("string"))), F.lit(".pdf")).alias("path"),
        F.sha2("text", 256).alias("digest"),
    )


FILES_SQL = (
    "SELECT doc_id, text, source, 'in/' || source || '/' || CASE WHEN doc_id % 10 = 0 THEN '文件' ELSE lang || ' ' || doc_id END || '.pdf' AS path, sha256(text) AS digest, "
    "CASE WHEN doc_id % 10 = 0 THEN 'document-' || substr(sha256(text), 1, 12) ELSE lang || '-' || doc_id END AS slug, "
    "CASE WHEN source IN ('src1', 'src2', 'src3', 'src4') THEN 'textbooks' WHEN source IN ('src5', 'src6', 'src7', 'src8') THEN 'past-papers' WHEN source = 'src9' THEN 'syllabi' ELSE 'documents' END AS type FROM documents"
)


@query(
    "a7_build_manifest",
    f"""
SELECT type, path AS source_pdf, o || '/document.raw.xml' AS raw_xml, o || '/document.raw.txt' AS raw_txt, o || '/document.raw.html' AS raw_view_html, o || '/document.extracted.md' AS extracted_md,
 digest AS source_sha256, CASE WHEN type IN ('textbooks', 'past-papers') THEN 'metadata-only' ELSE 'full-text-draft' END AS extraction_policy
FROM (SELECT *, 'processed/' || type || '/' || slug AS o FROM ({FILES_SQL}))
""",
)
def build_manifest(spark, sf):
    return files.build_manifest(source_files(spark, sf).select("path", "digest"), MANIFEST_RULES)


MOVE_RULES = [("major-plans|考试计划", "official/major-plans"), ("directory|mapping", "official/policies"), ("exam|notice", "official/exam-notices")]


@query(
    "a8_plan_moves",
    """
WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'in/exam-' ELSE 'in/' END || page_id || CASE page_id % 3 WHEN 0 THEN '-plan.PDF' WHEN 1 THEN '.txt' ELSE '.major-plans.md' END AS path FROM pages WHERE page_id % 5 <> 0),
q AS (SELECT *, substr(path, 4) AS name, page_id % 3 = 0 AS pdf FROM p)
SELECT path AS old_path, CASE WHEN pdf THEN 'root/' || CASE WHEN contains(path, 'exam') THEN 'official/exam-notices/exam-plan/' ELSE 'official/syllabi/plan/' END || name
 WHEN contains(path, 'major-plans') THEN 'root/processed/major-plans/' || name ELSE 'root/processed/source-records/' || name END AS new_path,
 CASE WHEN pdf THEN 'official-pdf' ELSE 'processed' END AS kind, CASE WHEN pdf THEN 'public-official' ELSE 'derived' END AS public_status, 'mechanical migration' AS notes FROM q
""",
)
def plan_moves(spark, sf):
    i = F.col("page_id")
    path = F.concat(
        F.when(i % 5 == 0, "in/processed/").when(i % 4 == 0, "in/exam-").otherwise("in/"), i.cast("string"),
        F.when(i % 3 == 0, "-plan.PDF").when(i % 3 == 1, ".txt").otherwise(".major-plans.md"),
    )
    listing = table(spark, sf, "pages").select(path.alias("path"))
    return files.plan_moves(listing, MOVE_RULES, "official/syllabi", "root", "/official/|/processed/")


@query(
    "a9_canonical",
    """
SELECT n_nationkey, '{"n_nationkey":' || n_nationkey || ',"segments":[' || coalesce(string_agg(DISTINCT '"' || c_mktsegment || '"', ',' ORDER BY '"' || c_mktsegment || '"'), '') || '],"note":null}' AS json
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey
""",
)
def canonical(spark, sf):
    # market segments are a closed list of five, so the set per nation is bounded
    segments = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.collect_set("c_mktsegment").alias("segments"))
    df = table(spark, sf, "nation").join(segments, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "n_nationkey", F.coalesce("segments", F.array().cast("array<string>")).alias("segments"), F.lit(None).cast("string").alias("note")
    )
    return files.canonical(df, ["n_nationkey"])


@query(
    "a9_output_difference",
    """
SELECT c_custkey, CASE WHEN c_custkey % 101 = 0 THEN 'only_left' ELSE 'differs' END AS problem FROM customer WHERE c_custkey % 101 = 0 OR c_custkey % 97 = 0
UNION ALL SELECT -1 - c_custkey, 'only_right' FROM customer WHERE c_custkey % 103 = 0
""",
)
def output_difference(spark, sf):
    """Two written versions of the customers: changed, dropped and new rows, found by their trees of digests."""
    k = F.col("c_custkey")
    old = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.array("c_mktsegment", F.lit("a")).alias("tags"))
    new = old.where(k % 101 != 0).withColumn("c_mktsegment", F.when(k % 97 == 0, "changed").otherwise(F.col("c_mktsegment")))
    new = new.unionByName(old.where(k % 103 == 0).withColumn("c_custkey", -1 - k))
    places = [scratch_dir(spark, f"output-{name}") for name in ("old", "new")]
    for df, place in zip((old, new), places):
        digests.write_digested(df, ["c_custkey"], place, depth=2)
    return digests.output_difference(spark, *places, ["c_custkey"], "c_custkey bigint", depth=2).select("c_custkey", "problem")


@query(
    "a1_read_tree",
    """
SELECT source, lang, sum(length(text) + 1)::BIGINT AS chars, sum(len(string_split(text, chr(10))))::BIGINT AS lines FROM documents WHERE lang <> 'es' GROUP BY ALL
""",
)
def read_tree(spark, sf):
    """Documents written as a folder tree, then scanned back as whole files; Spanish folders use an excluded name."""
    root = scratch_dir(spark, "tree")
    docs = table(spark, sf, "documents").select("source", "lang", "text")
    docs.write.partitionBy("source", "lang").option("compression", "none").text(root)
    tree = files.read_tree(spark, root, "*.txt").filter(~F.col("path").contains("lang=es/"))
    name = lambda p: F.regexp_extract("path", p, 1)
    return tree.groupBy(name(r"source=([^/]+)/").alias("source"), name(r"lang=([^/]+)/").alias("lang")).agg(
        F.sum(F.length("text")).alias("chars"), F.sum(F.size(F.split("text", "\n", -1)) - 1).cast("bigint").alias("lines")
    )


@query(
    "a3_read_manifest",
    f"""
SELECT type, source_sha256, 'row' AS kind FROM (SELECT type, digest AS source_sha256 FROM ({FILES_SQL})) UNION ALL SELECT 'raw_xml', NULL, 'column_missing'
""",
)
def read_manifest(spark, sf):
    """A manifest written as csv without one of its columns, then read and checked."""
    root = scratch_dir(spark, "manifest")
    made = files.build_manifest(source_files(spark, sf).select("path", "digest"), MANIFEST_RULES).drop("raw_xml")
    made.write.option("header", "true").csv(root)
    rows, found = files.read_manifest(spark, root)
    return rows.select("type", "source_sha256", F.lit("row").alias("kind")).unionByName(
        found.select(F.col("message").alias("type"), F.lit(None).cast("string").alias("source_sha256"), F.col("rule").alias("kind"))
    )
