"""Operator inputs derived from the given tables, as frames and as the SQL text that derives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_audit.functions import text as tx
from corpus_audit.plans.registry import table, wide

# RE2 spelling of "any whitespace" for the SQL side.
SQL_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_fold(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{SQL_SPACE}+', ' ', 'g'), ' ')"


def sql_squeeze(expr: str) -> str:
    return f"regexp_replace({expr}, '{SQL_SPACE}+', '', 'g')"


def sql_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"


# -- document lines -----------------------------------------------------------------------------

LINES = (
    "SELECT doc_id, generate_subscripts(l, 1)::BIGINT AS line_no, unnest(l) AS text "
    "FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)"
)


def document_lines(spark: SparkSession, sf: str) -> DataFrame:
    from corpus_audit.sources.files import read_lines

    return read_lines(wide(spark, sf, "documents"), "doc_id").select("doc_id", F.col("line_no").cast("bigint"), "text")


# Markdown made from document lines: every fifth line is a heading whose level cycles and whose text
# names the source section in every second one; every seventh line is a quote.
MD_LINES = (
    "SELECT doc_id, line_no, CASE WHEN line_no % 5 = 1 THEN repeat('#', 1 + (line_no // 5 % 4)::INT) || ' ' || "
    "CASE WHEN line_no % 10 = 1 THEN '来源 ' ELSE '' END || text WHEN line_no % 7 = 3 THEN '> ' || text "
    f"ELSE text END AS text FROM ({LINES})"
)


def markdown_lines(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("line_no")
    level = (1 + F.floor(n / 5) % 4).cast("int")
    word = F.when(n % 10 == 1, F.lit("来源 ")).otherwise(F.lit(""))
    text = (
        F.when(n % 5 == 1, F.concat(F.expr("repeat('#', cast(1 + (line_no div 5) % 4 as int))"), F.lit(" "), word, F.col("text")))
        .when(n % 7 == 3, F.concat(F.lit("> "), F.col("text")))
        .otherwise(F.col("text"))
    )
    return document_lines(spark, sf).withColumn("text", text)


# -- pages as Markdown source lists -------------------------------------------------------------

HREF = 'href="([^"]*)"'
# one Markdown page per html page: a source heading, one line per link (Markdown link, bare link, or both),
# then an unrelated heading that ends the scope, with one more link below it
PAGE_LINKS = (
    "SELECT page_id, url, regexp_extract(url, '^https?://[^/]+') AS base, i, h[i] AS href FROM ("
    f"SELECT page_id, url, regexp_extract_all(html, '{HREF}', 1) AS h FROM pages), unnest(range(1, len(h) + 1)) AS u(i)"
)


def page_links(spark: SparkSession, sf: str) -> DataFrame:
    pages = wide(spark, sf, "pages")
    return pages.select(
        "page_id",
        "url",
        F.regexp_extract("url", r"^https?://[^/]+", 0).alias("base"),
        F.posexplode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("i", "href"),
    ).withColumn("i", (F.col("i") + 1).cast("bigint"))


def page_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """Lines (page_id, path, line_no, text) of the derived Markdown pages."""
    links = page_links(spark, sf)
    target = F.concat("base", "href")
    body = links.select(
        "page_id",
        (F.col("i") + 1).alias("line_no"),
        F.when(F.col("i") % 3 == 1, F.concat(F.lit("- [label]("), target, F.lit(")")))
        .when(F.col("i") % 3 == 2, F.concat(F.lit("- see "), target, F.lit("；"), F.col("base"), F.lit("/。")))
        .otherwise(F.concat(F.lit("- [label]("), target, F.lit(") "), target))
        .alias("text"),
    )
    pages = table(spark, sf, "pages")
    n = F.size(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).cast("bigint")
    head = pages.select("page_id", F.lit(1).cast("bigint").alias("line_no"), F.lit("## 官方来源").alias("text"))
    tail = pages.select(
        "page_id",
        F.explode(
            F.array(
                F.struct((n + 2).alias("line_no"), F.lit("## 练习").alias("text")),
                F.struct((n + 3).alias("line_no"), F.concat(F.lit("out of scope "), F.col("url")).alias("text")),
            )
        ).alias("e"),
    ).select("page_id", "e.line_no", "e.text")
    lines = body.unionByName(head).unionByName(tail)
    return lines.withColumn("path", page_path(F.col("page_id")))


def padded(key: Column, width: int = 5) -> Column:
    """The number with leading zeros; longer numbers are never cut."""
    return F.when(key.isNotNull(), F.format_string(f"%0{width}d", key.cast("bigint")))


def page_path(page_id: Column) -> Column:
    return F.concat(F.lit("courses/"), padded(page_id), F.lit("/sources.md"))


SQL_PAGE_PATH = "'courses/' || printf('%05d', page_id) || '/sources.md'"

# references written from the link table itself, not by matching Markdown
PAGE_REFS = (
    "SELECT DISTINCT page_id, i + 1 AS line_no, url FROM ("
    f"SELECT page_id, i, rtrim(base || href, '{tx.URL_TAIL}') AS url FROM ({PAGE_LINKS}) UNION ALL "
    f"SELECT page_id, i, rtrim(base || '/', '{tx.URL_TAIL}') AS url FROM ({PAGE_LINKS}) WHERE i % 3 = 2)"
)


def page_refs(spark: SparkSession, sf: str) -> DataFrame:
    from corpus_audit.operators.links import extract
    from corpus_audit.operators.structure import heading_scope

    scoped = heading_scope(page_markdown(spark, sf), ["page_id", "path"], ["来源"])
    return extract(scoped, ["page_id", "path"])


# -- link probes from the event stream ----------------------------------------------------------

STATUS_OF_EVENT = "CASE event_type WHEN 'error' THEN 'dead' WHEN 'view' THEN 'ok' WHEN 'click' THEN 'ok' ELSE 'inconclusive' END"
CUT = "2024-01-16"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


# one probe per event; the page with the user's id is the probed url
PROBES = (
    "SELECT p.url, p.page_id, e.event_id, e.ts, "
    + STATUS_OF_EVENT
    + " AS status, CASE event_type WHEN 'error' THEN 404 + (e.event_id % 2 = 0)::INT * 96 WHEN 'view' THEN 200 "
    "WHEN 'click' THEN 301 END AS http_code, "
    "CASE WHEN event_type IN ('view', 'click') AND p.page_id % 2 = 0 THEN sha256((e.event_id // 3000)::VARCHAR) END AS content_hash, "
    "p.page_id % 2 = 0 AS authoritative FROM events e JOIN pages p ON p.page_id = e.user_id"
)


def probes(spark: SparkSession, sf: str, source: DataFrame | None = None) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    e = F.col("event_type")
    event_id = F.col("event_id")
    ok = e.isin("view", "click")
    authoritative = F.col("page_id") % 2 == 0
    return (
        (events(spark, sf) if source is None else source)
        .join(pages, F.col("user_id") == F.col("page_id"))
        .select(
            "url",
            "page_id",
            "event_id",
            "ts",
            F.when(e == "error", F.lit("dead")).when(ok, F.lit("ok")).otherwise(F.lit("inconclusive")).alias("status"),
            F.when(e == "error", F.when(event_id % 2 == 0, F.lit(500)).otherwise(F.lit(404)))
            .when(e == "view", F.lit(200))
            .when(e == "click", F.lit(301))
            .alias("http_code"),
            F.when(ok & authoritative, F.sha2(F.floor(event_id / 3000).cast("string"), 256)).alias("content_hash"),
            authoritative.alias("authoritative"),
        )
    )


PROBE_SIDE = (
    "SELECT url, any_value(page_id) AS page_id, arg_max(status, event_id) AS status, "
    "arg_max(struct_pack(c := http_code), event_id).c AS http_code, "
    "arg_max(struct_pack(c := content_hash), event_id).c AS content_hash, any_value(authoritative) AS authoritative "
)
CURRENT = f"{PROBE_SIDE} FROM ({PROBES}) WHERE ts >= TIMESTAMP '{CUT}' GROUP BY url"
BASELINE = f"{PROBE_SIDE} FROM ({PROBES}) WHERE ts < TIMESTAMP '{CUT}' AND page_id % 7 <> 3 GROUP BY url"


def _latest(df: DataFrame) -> DataFrame:
    """Latest probe per url as a mergeable aggregate: hot urls combine before the shuffle."""
    payload = F.struct("page_id", "status", "http_code", "content_hash", "authoritative")
    return df.groupBy("url").agg(F.max_by(payload, "event_id").alias("p")).select("url", "p.*")


def current_probes(spark: SparkSession, sf: str) -> DataFrame:
    return _latest(probes(spark, sf).filter(F.col("ts") >= F.lit(CUT).cast("timestamp")))


def baseline_probes(spark: SparkSession, sf: str) -> DataFrame:
    """The state before the cut; every seventh page is unknown to it, so it shows up as new."""
    old = probes(spark, sf).filter((F.col("ts") < F.lit(CUT).cast("timestamp")) & (F.col("page_id") % 7 != 3))
    return _latest(old)


# -- syllabus documents -------------------------------------------------------------------------
# Every document's own lines become a syllabus: contents list, four units in three numbering styles
# (section by number, by bracketed numeral, none), two appendices and a closing part.  Line i of the
# document belongs to unit i % 4.  Documents differ in whether they have an introduction, a second
# chapter, a contents list, an appendix clash, and a terminated question-type sentence.

REQ_HEADING = "二、考核知识点与考核要求"
CN_DIGITS = "一二三四五六七八九"


def _cn(n: str) -> str:
    one = f"substr('{CN_DIGITS}', {{}}, 1)"
    return (
        f"CASE WHEN {n} < 10 THEN {one.format(n)} WHEN {n} = 10 THEN '十' WHEN {n} < 20 THEN '十' || {one.format(f'{n} - 10')} "
        f"ELSE {one.format(f'{n} {{div}} 10')} || '十' || CASE WHEN {n} % 10 > 0 THEN {one.format(f'{n} % 10')} ELSE '' END END"
    )


def _unit(c: int, title: str, style: str, dialect: str) -> str:
    x, i = ("x", "i") if dialect == "duck" else ("e.x", "e.i")
    n = f"({i} {{div}} 4 + 1)"
    label = {
        "number": f"{n} || '.' || substr({x}, 1, 12)",
        "paren": f"'（' || {_cn(n)} || '）' || substr({x}, 1, 12)",
    }.get(style)
    body = f"replace({x}, '. ', '；')"
    level = (
        f"CASE length({x}) % 4 WHEN 0 THEN '识记：' WHEN 1 THEN '领会：' WHEN 2 THEN '应用：' ELSE '' END"
    )
    rows = [f"{level} || substr({body}, 1, 60)", f"substr({body}, 61) || '。'"]
    if label:
        rows.insert(0, f"{label} || CASE WHEN length({x}) % 6 = 0 THEN '（本节内容不作考核要求）' ELSE '' END")
    head = [title, "'一、学习目的与要求'", "'Read ' || source || '.'", f"'{REQ_HEADING}'"]
    tail = ["'三、本章重点'", "source || '；focus'", "'12'"]
    if dialect == "duck":
        inner = f"flatten([[{', '.join(rows)}] FOR x, i IN l IF i % 4 = {c}])"
        text = f"list_concat([{', '.join(head)}], {inner}, [{', '.join(tail)}])"
    else:
        inner = (
            f"flatten(transform(filter(transform(l, (x, i) -> struct(x, i + 1 AS i)), e -> e.i % 4 = {c}), "
            f"e -> array({', '.join(rows)})))"
        )
        text = f"concat(array({', '.join(head)}), {inner}, array({', '.join(tail)}))"
    return text.replace("{div}", "//" if dialect == "duck" else "div")


def _syllabus(dialect: str) -> str:
    duck = dialect == "duck"
    arr = (lambda *xs: "[" + ", ".join(xs) + "]") if duck else (lambda *xs: "array(" + ", ".join(xs) + ")")
    none = "[]::VARCHAR[]" if duck else "cast(array() as array<string>)"
    concat = "list_concat" if duck else "concat"
    unit = lambda c, title, style: _unit(c, title, style, dialect)
    first = "l[1]" if duck else "l[0]"
    intro = lambda a: f"CASE WHEN doc_id % 2 = 0 THEN {a} ELSE {none} END"
    second = lambda a: f"CASE WHEN doc_id % 4 = 1 THEN {none} ELSE {a} END"
    toc = (
        f"CASE WHEN doc_id % 5 = 0 THEN {none} ELSE {concat}({arr(chr(39) + '大纲目录' + chr(39))}, "
        + intro(arr("'导论'")) + f", {arr(chr(39) + '第一章 基础' + chr(39))}, " + second(arr("'第二章 ' || lang"))
        + f", {arr(chr(39) + '第 3 章 进阶' + chr(39), chr(39) + '3' + chr(39))}) END"
    )
    units = ", ".join(
        [
            intro(unit(0, "'导论'", "number")), unit(1, "'第一章 基础'", "number"),
            second(unit(2, "'第二章 ' || lang", "paren")), unit(3, "'第 3 章 进阶'", "none"),
        ]
    )
    closing = arr(
        "'附录一 ' || source", f"'{REQ_HEADING}'", f"'识记：' || substr({first}, 1, 30) || '。'",
        "CASE WHEN doc_id % 6 = 0 THEN '附录一 重复' ELSE '附录二 补充' END", "'tail of appendix'", "'Ⅳ 关于大纲的说明'",
        "'可能采用的题型有：单项选择题、简答'", "'题、综合题型、'", "CASE WHEN doc_id % 3 = 0 THEN '论述题等。' ELSE '论述题' END",
        "'a'", "'b'", "'c'",
    )
    return f"{concat}({toc}, {arr(chr(39) + 'Ⅰ 课程性质' + chr(39), chr(39) + 'Ⅲ 课程内容与考核要求' + chr(39))}, {units}, {closing})"


SYLLABUS = (
    "SELECT doc_id, generate_subscripts(s, 1)::BIGINT AS line_no, unnest(s) AS text FROM (SELECT doc_id, "
    + _syllabus("duck")
    + " AS s FROM (SELECT doc_id, source, lang, string_split(text, chr(10)) AS l FROM documents))"
)


def syllabus_documents(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, lines): the syllabus of each document as an array."""
    docs = wide(spark, sf, "documents").select("doc_id", "source", "lang", F.split("text", "\n", -1).alias("l"))
    return docs.select("doc_id", F.expr(_syllabus("spark")).alias("lines"))


def syllabus_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = syllabus_documents(spark, sf)
    return docs.select("doc_id", F.posexplode("lines").alias("_p", "text")).select(
        "doc_id", (F.col("_p") + 1).cast("bigint").alias("line_no"), "text"
    )
