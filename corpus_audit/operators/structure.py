"""Document structure: lines to sections, tables, slices and regions.

Line frames are (keys..., line_no, text).  Windows partition by document, so a partition is never larger than
one document's text; every operator over the same keys reuses the same exchange and sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_audit.findings import as_findings
from corpus_audit.functions import text as tx

# Headings, labels, line kinds and table patterns of the document format.
HEADING = r"(?U)^(#{1,6})\s+(.*\S)\s*$"
TOP_HEADING = r"^[一二三四五六七八九十]+、"
NUMBERED_SECTION = r"^([0-9]+)\.(.*)$"
PAREN_SECTION = r"^（([一二三四五六七八九十]+)）\s*(.*)$"
REQUIREMENT = r"^(识记|领会|应用)：(.*)$"
PAGE_NUMBER = r"\A[0-9]{1,3}\z"
PAGE_MARK = r"\A第\s*[0-9]+\s*页\s*共\s*[0-9]+\s*页\z"
SENTENCE_END = r"[。！？]\z"
CHAPTER_TITLE = r"^(?:(?:导论|绪\s*论)(?=\s|$)(?:\s+.+)?|第\s*(?:[一二三四五六七八九十]+|[0-9]+)\s*章(?:\s*.+)?)$"
PART_LABEL = r"^[ⅠⅡⅢⅣ]\s*\S"
APPENDIX_TITLE = r"^附\s*录\s*([一二三四五六七八九十]+|[0-9]+)\s*(\S.*)$"
TOC_MARK = "大纲目录"
BODY_MARK = "课程内容与考核要求"
TYPE_DECLARATION = r"(?:主要题型一般有|可能采用的题型有[：:]?)(.+?)(?:等|。|$)"
EXAM_METHODS = "笔试|实践|机考"
FIVE_DIGITS, FIVE_OR_MORE = tx.FIVE_DIGITS, tx.FIVE_OR_MORE
ROW_HEAD = r"^\s*(?:[0-9]{1,3}\s+)?([0-9]{5})(?=\s|$)"
CODE_TOKEN = r"(?<![0-9])[0-9]{5}(?![0-9])"
NO_METHOD = "行内未找到唯一的考试方式单元格"
SHORT_TABLE_ROW = "现行课程表行列位不足"


def _running(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)


def _all(keys: list[str]):
    return Window.partitionBy(*keys)


def contains_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def heading_scope(lines: DataFrame, keys: list[str], keywords: list[str]) -> DataFrame:
    """Adds ``section`` (nearest heading) and ``in_scope``; heading rows are never in scope.

    A line is in scope when some keyword heading of level l has had no later heading of level <= l: then the
    last heading of level <= l is that keyword heading itself.  All twelve running maxima share one sort.
    """
    level = F.when(F.col("text").rlike(HEADING), F.length(F.regexp_extract("text", HEADING, 1)))
    head = F.when(level.isNotNull(), F.regexp_extract("text", HEADING, 2))
    w = _running(keys)
    base = lines.withColumn("_level", level).withColumn("_head", head)
    hit = F.coalesce(contains_any(F.col("_head"), keywords), F.lit(False))

    def open_at(n: int) -> Column:
        any_heading = F.max(F.when(F.col("_level") <= n, F.col("line_no"))).over(w)
        keyword = F.max(F.when((F.col("_level") == n) & hit, F.col("line_no"))).over(w)
        return F.coalesce(any_heading == keyword, F.lit(False))

    scope = reduce(lambda a, b: a | b, [open_at(n) for n in range(1, 7)])
    return base.select(
        *lines.columns,
        F.coalesce(F.last("_head", ignorenulls=True).over(w), F.lit("")).alias("section"),
        (scope & F.col("_level").isNull()).alias("in_scope"),
    )


def section_slice(lines: DataFrame, keys: list[str], start: Column, stop: Column) -> DataFrame:
    """Body lines of the first section whose heading satisfies ``start``, up to the next ``stop`` line."""
    first = F.min(F.when(start, F.col("line_no"))).over(_all(keys))
    marked = lines.withColumn("_start", first).withColumn("_is_stop", stop)
    last_stop = F.max(F.when(F.col("_is_stop") & (F.col("line_no") > F.col("_start")), F.col("line_no"))).over(_running(keys))
    body = marked.withColumn("_stop", last_stop)
    return body.filter((F.col("line_no") > F.col("_start")) & F.col("_stop").isNull()).select(*lines.columns)


def section_bodies(lines: DataFrame, keys: list[str], start: Column, stop: Column) -> DataFrame:
    """One row per document that has the heading: ``body`` is '' for an empty section; no row when absent."""
    present = lines.filter(start).select(*keys).distinct()
    body = section_slice(lines, keys, start, stop).groupBy(*keys).agg(_joined("\n").alias("body"))
    return present.join(body, keys, "left").select(*keys, F.coalesce("body", F.lit("")).alias("body"))


def _joined(separator: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct("line_no", "text")))
    return F.array_join(F.transform(rows, lambda r: r.text), separator)


def anchor_sections(lines: DataFrame, keys: list[str], anchor: str, opener: str = "### ") -> DataFrame:
    """Sections opened by ``opener`` lines, keyed by the anchor id in the opening line; last duplicate wins.

    ``lines`` must be the visible lines.  Output (keys, anchor, line_no, body).
    """
    opens = F.col("text").startswith(opener)
    numbered = lines.withColumn("_n", F.sum(opens.cast("int")).over(_running(keys))).filter(F.col("_n") > 0)
    parts = numbered.groupBy(*keys, "_n").agg(
        F.min("line_no").alias("line_no"),
        F.min_by("text", "line_no").alias("_head"),
        _joined("\n").alias("body"),
    )
    parts = parts.withColumn("anchor", tx.extract_or_null(F.col("_head"), anchor)).filter(F.col("anchor").isNotNull())
    return parts.groupBy(*keys, "anchor").agg(
        F.max("line_no").alias("line_no"), F.max_by("body", "line_no").alias("body")
    )


def pipe_cells(c: Column | str) -> Column:
    return F.transform(F.split(F.btrim(tx.strip_ws(c), F.lit("|")), r"\|", -1), tx.strip_ws)


def table_rows(lines: DataFrame, keys: list[str], header: Column, min_cells: int = 2) -> DataFrame:
    """Rows of the pipe table under a ``header`` line until the first non-pipe line; separator rows skipped."""
    piped = tx.strip_ws("text").startswith("|")
    event = F.when(header, F.lit("in")).when(~piped, F.lit("out"))
    state = F.last(event, ignorenulls=True).over(_running(keys))
    separator = F.col("text").rlike(r"^\s*\|[\s|:\-]*-[\s|:\-]*$")
    return (
        lines.withColumn("_state", state)
        .filter((F.col("_state") == "in") & ~header & ~separator)
        .select(*keys, "line_no", pipe_cells("text").alias("cells"))
        .filter(F.size("cells") >= min_cells)
    )


def row_head(digits: str = FIVE_DIGITS) -> str:
    """``ROW_HEAD`` for codes of these digits."""
    return ROW_HEAD.replace(FIVE_DIGITS, digits)


def course_table_rows(lines: DataFrame, keys: list[str], digits: str = FIVE_DIGITS) -> tuple[DataFrame, DataFrame]:
    """Rows ``| n | code | name | credits | method |`` of a current course table: parsed, and dropped with reason."""
    row = r"^\|\s*[0-9]+\s*\|\s*(" + digits + r")\s*\|\s*([^|]*?)\s*\|\s*([^|]*?)\s*\|\s*(" + EXAM_METHODS + r")\s*\|"
    t = F.col("text")
    candidates = lines.filter(t.rlike(r"^\|\s*[0-9]+\s*\|\s*" + digits + r"\s*\|"))
    parsed = candidates.filter(t.rlike(row)).select(
        *keys, "line_no",
        F.regexp_extract(t, row, 1).alias("code"),
        F.nullif(tx.fold_ws(F.regexp_extract(t, row, 2)), F.lit("")).alias("name"),
        F.regexp_extract(t, row, 3).try_cast("int").alias("credits"),
        F.regexp_extract(t, row, 4).alias("exam_method"),
    )
    dropped = candidates.filter(~t.rlike(row)).select(
        *keys, "line_no", tx.strip_ws(t).alias("raw"), F.lit(SHORT_TABLE_ROW).alias("reason")
    )
    return parsed, dropped


def fixed_width_rows(
    lines: DataFrame, keys: list[str], wrapped: bool = True, digits: str = FIVE_DIGITS
) -> tuple[DataFrame, DataFrame]:
    """Course rows of a fixed-width plan: (parsed, dropped with reason).

    A candidate starts with a standalone code (five digits unless ``digits`` says otherwise); it parses when exactly one method token stands alone
    in the rest.  Left of it: name, then trailing integer credits.  With ``wrapped`` an empty name is rebuilt
    from the neighbouring physical lines.
    """
    head = row_head(digits)
    code = F.regexp_extract("text", head, 1)
    rest = F.regexp_extract("text", r"(?s)" + head + r"(.*)$", 2)
    token = rf"(?:(?<=\s)|^)({EXAM_METHODS})(?=\s|$)"
    source = wrapped_value(lines, keys, digits) if wrapped else lines.withColumn("wrapped", F.lit(None).cast("string"))
    cand = source.filter(F.col("text").rlike(head)).withColumn("_rest", rest)
    cand = cand.withColumn("_methods", F.regexp_extract_all("_rest", F.lit(token), F.lit(1)))
    one = F.size("_methods") == 1
    left = tx.strip_ws(F.regexp_extract("_rest", rf"(?s)^(.*?){token}", 1))
    tail = r"(?s)^(.*?)\s*([0-9]+)$"
    name = F.nullif(tx.fold_ws(F.when(F.col("_left").rlike(tail), F.regexp_extract("_left", tail, 1)).otherwise(F.col("_left"))), F.lit(""))
    parsed = cand.filter(one).withColumn("_left", left).select(
        *keys, "line_no", code.alias("code"),
        F.coalesce(name, F.col("wrapped")).alias("name"),
        tx.extract_or_null(F.col("_left"), tail, 2).try_cast("int").alias("credits"),
        F.col("_methods")[0].alias("exam_method"),
    )
    dropped = cand.filter(~one).select(*keys, "line_no", tx.strip_ws("text").alias("raw"), F.lit(NO_METHOD).alias("reason"))
    return parsed, dropped


def name_fragment(c: Column, digits: str = FIVE_DIGITS) -> Column:
    """First name cell of a neighbouring line; '' when the line is blank or holds a code."""
    line = tx.strip_ws(c)
    cells = F.filter(F.split(line, r"(?U)\s{2,}", -1), lambda x: (x != "") & ~x.rlike(r"^\s*[0-9]+\s*$"))
    first = F.coalesce(F.try_element_at(cells, F.lit(1)), F.lit(""))
    cleaned = F.regexp_replace(first, r"\s+(?:不计学分|不计|学分)$", "")
    return F.when(line.isNull() | (line == "") | line.rlike(CODE_TOKEN.replace(FIVE_DIGITS, digits)), F.lit("")).otherwise(cleaned)


def wrapped_value(lines: DataFrame, keys: list[str], digits: str = FIVE_DIGITS) -> DataFrame:
    """Adds ``wrapped``: the cleaned fragments of the previous and next physical line, null when both are empty."""
    w = Window.partitionBy(*keys).orderBy("line_no")
    joined = F.concat(name_fragment(F.lag("text").over(w), digits), name_fragment(F.lead("text").over(w), digits))
    return lines.withColumn("wrapped", F.nullif(tx.fold_ws(joined), F.lit("")))


# -- marked regions -----------------------------------------------------------------------------

MANUAL_BLOCK = r"(?s)<!--\s*manual:begin\s+id=([A-Za-z0-9_\-]+)\s*-->(.*?)<!--\s*manual:end\s*-->"
DERIVED_BEGIN = r"<!--\s*derived:begin\s+id=([A-Za-z0-9_\-]+)\s*-->"
DERIVED_END = r"<!--\s*derived:end\s*-->"


def marked_blocks(c: Column | str) -> Column:
    """Hand-kept blocks of a text as map id -> body (outer newlines removed, last duplicate wins)."""
    ids = F.regexp_extract_all(tx.col(c), F.lit(MANUAL_BLOCK), F.lit(1))
    bodies = F.regexp_extract_all(tx.col(c), F.lit(MANUAL_BLOCK), F.lit(2))
    entries = F.zip_with(ids, bodies, lambda k, v: F.struct(k.alias("k"), F.btrim(v, F.lit("\n")).alias("v")))
    return tx.last_wins(entries)


def merge_marked(fallback: Column, target: Column) -> Column:
    """Blocks of the target win over blocks of the fallback."""
    kept = F.map_filter(fallback, lambda k, _: ~F.array_contains(F.map_keys(target), k))
    return F.map_concat(kept, target)


def balanced_region(
    docs: DataFrame, key: str, text: str, block_id: str, begin: str = DERIVED_BEGIN, end: str = DERIVED_END
) -> DataFrame:
    """Nesting-aware span of the first region ``block_id``: (key, start_at, end_at, region); null when unbalanced.

    Only the markers of a text are exploded, each with the text before it, so offsets are running sums.
    """
    piece = rf"(?s).*?(?:{begin}|{end})"
    parts = docs.select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(piece), F.lit(0))).alias("line_no", "_part"))
    opens = F.regexp_extract("_part", rf"(?s){begin}\z", 1)
    mark_length = F.length(F.regexp_extract("_part", rf"(?s)(?:{begin}|{end})\z", 0))
    w = _running([key])
    parts = parts.withColumn("_id", opens).withColumn("_step", F.when(F.col("_part").rlike(rf"(?s){begin}\z"), 1).otherwise(-1))
    parts = parts.withColumn("_end", F.sum(F.length("_part")).over(w)).withColumn("_depth", F.sum("_step").over(w))
    parts = parts.withColumn("_from", F.col("_end") - mark_length)
    first = F.min(F.when((F.col("_step") == 1) & (F.col("_id") == block_id), F.struct("line_no", "_from", "_depth"))).over(_all([key]))
    spans = (
        parts.withColumn("_open", first)
        .filter(F.col("_open").isNotNull())
        .groupBy(key)
        .agg(
            F.min("_open._from").alias("start_at"),
            F.min(
                F.when((F.col("line_no") > F.col("_open.line_no")) & (F.col("_depth") == F.col("_open._depth") - 1), F.col("_end"))
            ).alias("end_at"),
        )
    )
    return docs.join(spans, key).select(
        key,
        (F.col("start_at") + 1).alias("start_at"),
        "end_at",
        F.expr(f"substring({text}, cast(start_at + 1 as int), cast(end_at - start_at as int))").alias("region"),
    )


def drop_sections(lines: DataFrame, keys: list[str], titles: list[str]) -> DataFrame:
    """Lines outside H2 sections whose title starts with a listed title; the next H2 or H1 ends a section."""
    line = tx.strip_ws("text")
    title = tx.strip_ws(F.substr(line, F.lit(4)))
    listed = reduce(lambda a, b: a | b, [title.startswith(t) for t in titles])
    event = F.when(line.startswith("## "), F.when(listed, F.lit("drop")).otherwise(F.lit("keep"))).when(
        line.startswith("# "), F.lit("keep")
    )
    state = F.coalesce(F.last(event, ignorenulls=True).over(_running(keys)), F.lit("keep"))
    return lines.withColumn("_state", state).filter(F.col("_state") == "keep").drop("_state")


# -- syllabus structure -------------------------------------------------------------------------

def line_kind(c: Column) -> Column:
    return (
        F.when(c.rlike(TOP_HEADING), F.lit("heading"))
        .when(c.rlike(NUMBERED_SECTION) | c.rlike(PAREN_SECTION), F.lit("section"))
        .when(c.rlike(REQUIREMENT), F.lit("requirement"))
        .otherwise(F.lit("passage"))
    )


def is_noise(folded: Column) -> Column:
    """Blank lines and page numbers."""
    return (folded == "") | folded.rlike(PAGE_NUMBER) | folded.rlike(PAGE_MARK)


def logical_lines(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Physical lines to logical lines (keys, line_no, text, kind): noise dropped, wrapped passages glued.

    A passage joins the line above unless that line is a heading or section or ends a sentence.  Since
    headings and sections never absorb, the decision needs one neighbouring row only.
    """
    w = Window.partitionBy(*keys).orderBy("line_no")
    kept = lines.withColumn("text", tx.fold_ws("text")).filter(~is_noise(F.col("text"))).withColumn("kind", line_kind(F.col("text")))
    above, above_text = F.lag("kind").over(w), F.lag("text").over(w)
    joins = (F.col("kind") == "passage") & ~above.isin("heading", "section") & ~above_text.rlike(SENTENCE_END)
    broken = kept.withColumn("_break", (~F.coalesce(joins, F.lit(False))).cast("int"))
    numbered = broken.withColumn("_group", F.sum("_break").over(_running(keys)))
    return (
        numbered.groupBy(*keys, "_group")
        .agg(F.min("line_no").alias("_line"), F.min_by("kind", "line_no").alias("kind"), _joined("").alias("_text"))
        .select(*keys, F.col("_line").alias("line_no"), F.col("_text").alias("text"), "kind")
    )


def unit_titles(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Unit titles of every document: (keys, idx from 0, title, line_no, origin, slice_start).

    ``toc``: first run of chapter labels after the contents mark.  Otherwise ``body``: distinct chapter labels
    after the content-requirements mark.  ``slice_start`` is the line from which bodies are searched.
    """
    w = _running(keys)
    folded = lines.withColumn("text", tx.fold_ws("text"))
    is_title = F.col("text").rlike(CHAPTER_TITLE)
    base = folded.withColumn("_title", is_title).withColumn(
        "_toc", F.min(F.when(F.col("text") == TOC_MARK, F.col("line_no"))).over(_all(keys))
    ).withColumn("_body", F.min(F.when(F.col("text").contains(BODY_MARK), F.col("line_no"))).over(_all(keys)))
    after_toc = F.col("line_no") > F.col("_toc")
    noise = (F.col("text") == "") | F.col("text").rlike(PAGE_NUMBER)
    base = base.withColumn("_first", F.min(F.when(after_toc & F.col("_title"), F.col("line_no"))).over(_all(keys)))
    breaker = F.when((F.col("line_no") > F.col("_first")) & ~F.col("_title") & ~noise, F.col("line_no"))
    base = base.withColumn("_end", F.min(breaker).over(_all(keys))).withColumn("_lines", F.max("line_no").over(_all(keys)))
    toc = base.filter((F.col("line_no") >= F.col("_first")) & F.col("_title") & (F.col("line_no") < F.coalesce("_end", F.col("_lines") + 1)))
    toc = toc.select(*keys, "line_no", F.col("text").alias("title"), F.lit("toc").alias("origin"), F.coalesce("_end", F.col("_lines") + 1).alias("slice_start"))
    body = base.filter(F.col("_first").isNull() & F.col("_title") & (F.col("line_no") > F.col("_body")))
    body = body.groupBy(*keys, F.col("text").alias("title")).agg(F.min("line_no").alias("line_no"), F.min("_body").alias("slice_start"))
    body = body.select(*keys, "line_no", "title", F.lit("body").alias("origin"), "slice_start")
    both = toc.unionByName(body)
    order = Window.partitionBy(*keys).orderBy("line_no")
    return both.withColumn("idx", F.row_number().over(order) - 1)


def missing_titles(lines: DataFrame, titles: DataFrame, keys: list[str]) -> DataFrame:
    """Documents for which neither derivation found a unit title."""
    bare = lines.select(*keys).distinct().join(titles.select(*keys).distinct(), keys, "left_anti")
    return as_findings(bare, "model", "unit_titles_missing", F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), TOC_MARK)


def body_anchors(lines: DataFrame, titles: DataFrame, keys: list[str]) -> DataFrame:
    """Anchor line of each title: its first equal line after the anchor before it; (keys, idx, title, anchor)."""
    # titles are chapter labels, so only label lines can be anchors and only they are joined
    folded = lines.select(*keys, "line_no", tx.fold_ws("text").alias("title")).filter(F.col("title").rlike(CHAPTER_TITLE))
    places = (
        titles.select(*keys, "idx", "title", "slice_start")
        .join(folded, [*keys, "title"], "left")
        .filter(F.col("line_no").isNull() | (F.col("line_no") >= F.col("slice_start")))
    )
    per_title = places.groupBy(*keys, "idx", "title").agg(F.array_sort(F.collect_list("line_no")).alias("at"))
    per_doc = per_title.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("idx", "title", "at"))).alias("t"))
    start = F.struct(F.lit(0).cast("bigint").alias("cursor"), F.array().cast("array<bigint>").alias("anchors"))

    def step(acc: Column, t: Column) -> Column:
        hit = F.try_element_at(F.filter(t.at, lambda p: p.cast("bigint") > acc.cursor), F.lit(1)).cast("bigint")
        return F.struct(
            F.coalesce(hit, acc.cursor).alias("cursor"), F.concat(acc.anchors, F.array(hit)).alias("anchors")
        )

    walked = per_doc.withColumn("_w", F.aggregate("t", start, step).anchors)
    return walked.select(*keys, F.inline(F.arrays_zip(F.col("t").alias("t"), F.col("_w").alias("anchor")))).select(
        *keys, "t.idx", "t.title", "anchor"
    )


def body_slices(lines: DataFrame, titles: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of each unit body: (keys, idx, title, line_no, text).

    A body runs from its anchor to the next anchor, part label or appendix.  Carrying the last anchor and the
    last boundary forward decides membership without a range join.
    """
    anchors = body_anchors(lines, titles, keys).filter(F.col("anchor").isNotNull())
    marks = anchors.select(*keys, F.col("anchor").alias("line_no"), F.struct("anchor", "idx", "title").alias("_unit"))
    text = tx.fold_ws("text")
    boundary = text.rlike(PART_LABEL) | text.rlike(APPENDIX_TITLE)
    w = _running(keys)
    return (
        lines.join(marks, [*keys, "line_no"], "left")
        .withColumn("_u", F.last("_unit", ignorenulls=True).over(w))
        .withColumn("_b", F.max(F.when(boundary, F.col("line_no"))).over(w))
        .filter(F.col("_u").isNotNull() & (F.coalesce(F.col("_b"), F.lit(-1)) < F.col("_u.anchor")))
        .select(*keys, "_u.idx", "_u.title", "line_no", "text")
    )


def document_slices(docs: DataFrame, keys: list[str], lines: Column) -> DataFrame:
    """The rows of ``body_slices`` of ``unit_titles``, folded from each document's own line array: no shuffle, one scan.

    (keys, idx, title, line_no, text).  ``lines`` is the array of a document's lines; a null array has no units.  The fold
    over the titles carries the line of the last anchor found, so each title looks only below it.
    """
    line = lambda x, i: tx.let(
        tx.fold_ws(x),
        lambda f: F.struct(
            (i + 1).cast("bigint").alias("n"), x.alias("raw"), f.alias("f"), f.rlike(CHAPTER_TITLE).alias("label"),
            (f.rlike(PART_LABEL) | f.rlike(APPENDIX_TITLE)).alias("bound"),
        ),
    )
    rows = docs.select(*keys, F.transform(lines, line).alias("_l")).withColumn("_labels", F.filter("_l", lambda x: x.label))
    first_line = lambda c, test: F.get(F.filter(c, test), F.lit(0)).n
    rows = rows.withColumns({"_toc": first_line("_l", lambda x: x.f == TOC_MARK), "_body": first_line("_l", lambda x: x.f.contains(BODY_MARK))})
    rows = rows.withColumn("_first", first_line("_labels", lambda x: x.n > F.col("_toc")))
    other = lambda x: (x.n > F.col("_first")) & ~x.label & (x.f != "") & ~x.f.rlike(PAGE_NUMBER)
    stop = F.coalesce(first_line("_l", other), F.size("_l").cast("bigint") + 1)
    rows = rows.withColumn("_start", F.when(F.col("_first").isNotNull(), stop).otherwise(F.col("_body")))
    listed = F.transform(F.filter("_labels", lambda x: (x.n >= F.col("_first")) & (x.n < F.col("_start"))), lambda x: x.f)
    found = F.array_distinct(F.transform(F.filter("_labels", lambda x: x.n > F.col("_body")), lambda x: x.f))
    rows = rows.withColumn("_titles", F.when(F.col("_first").isNotNull(), listed).otherwise(found))
    rows = rows.withColumns(
        {
            "_labels": F.filter("_labels", lambda x: x.n >= F.col("_start")),
            "_bounds": F.transform(F.filter("_l", lambda x: x.bound), lambda x: x.n),
        }
    )
    none = F.struct(F.lit(0).cast("bigint").alias("cursor"), F.array().cast("array<bigint>").alias("anchors"))

    def step(acc: Column, title: Column) -> Column:
        hit = first_line("_labels", lambda x: (x.f == title) & (x.n > acc.cursor))
        return tx.let(hit, lambda h: F.struct(F.coalesce(h, acc.cursor).alias("cursor"), F.concat(acc.anchors, F.array(h)).alias("anchors")))

    rows = rows.withColumn("_anchors", F.aggregate("_titles", none, step).anchors)
    unit = F.filter(
        F.transform("_titles", lambda t, i: F.struct(i.alias("idx"), t.alias("title"), F.get("_anchors", i).alias("anchor"))), lambda u: u.anchor.isNotNull()
    )
    rows = rows.select(*keys, "_l", "_anchors", "_bounds", F.explode(unit).alias("_u"))
    after = F.array_min(F.filter("_anchors", lambda a: a > F.col("_u.anchor")))
    edge = F.array_min(F.filter("_bounds", lambda b: b >= F.col("_u.anchor")))
    end = F.least(F.coalesce(after, F.size("_l") + 1), F.coalesce(edge, F.size("_l") + 1))
    cut = F.slice("_l", F.col("_u.anchor").cast("int"), (end - F.col("_u.anchor")).cast("int"))
    rows = rows.select(*keys, "_u.idx", "_u.title", F.explode(cut).alias("_x"))
    return rows.select(*keys, "idx", "title", F.col("_x.n").alias("line_no"), F.col("_x.raw").alias("text"))


def appendix_slices(lines: DataFrame, keys: list[str], starts: DataFrame | None = None) -> DataFrame:
    """Lines of each numbered, titled appendix: (keys, anchor, title, line_no, text).

    ``starts(keys, slice_start)`` excludes appendix lines of the contents pages.
    """
    w = _running(keys)
    base = lines.withColumn("_f", tx.fold_ws("text"))
    opens = F.col("_f").rlike(APPENDIX_TITLE)
    if starts is not None:
        base = base.join(starts.select(*keys, "slice_start").distinct(), keys, "left")
        opens = opens & (F.col("line_no") >= F.coalesce("slice_start", F.lit(0)))
    unit = F.when(opens, F.struct(F.col("line_no").alias("anchor"), F.col("_f").alias("title")))
    part = F.when(F.col("_f").rlike(PART_LABEL), F.col("line_no"))
    return (
        base.withColumn("_unit", unit)
        .withColumn("_u", F.last("_unit", ignorenulls=True).over(w))
        .withColumn("_p", F.max(part).over(w))
        .filter(F.col("_u").isNotNull() & (F.coalesce(F.col("_p"), F.lit(-1)) < F.col("_u.anchor")))
        .select(*keys, "_u.anchor", "_u.title", "line_no", "text")
    )


def lookahead_merge(lines: DataFrame, keys: list[str], lookahead: int = 3, declaration: str = TYPE_DECLARATION) -> DataFrame:
    """First declaration of each document joined with following lines until its sentence ends.

    (keys, line_no, items, terminated): items are split at 、; ``terminated`` is false when no sentence end
    came within the lookahead, and items are then null.
    """
    w = Window.partitionBy(*keys).orderBy("line_no")
    folded = lines.withColumn("text", tx.fold_ws("text"))
    for n in range(1, lookahead + 1):
        folded = folded.withColumn(f"_t{n}", F.coalesce(F.lead("text", n).over(w), F.lit("")))
    hits = folded.filter(F.col("text").rlike(declaration))
    candidates = [F.concat("text", *[f"_t{i}" for i in range(1, n + 1)]) for n in range(lookahead + 1)]

    def done(c: Column) -> Column:
        return _from_match(c, declaration).contains("。")

    merged = F.coalesce(*[F.when(done(c), c) for c in candidates])
    first = hits.groupBy(*keys).agg(F.min_by(F.struct("line_no", merged.alias("m")), "line_no").alias("_f"))
    items = F.filter(
        F.transform(F.split(F.regexp_extract("_f.m", declaration, 1), "、", -1), tx.strip_ws),
        lambda x: (x != "") & ~x.endswith("题型"),
    )
    return first.select(
        *keys,
        F.col("_f.line_no").alias("line_no"),
        F.when(F.col("_f.m").isNotNull(), items).alias("items"),
        F.col("_f.m").isNotNull().alias("terminated"),
    )


def _from_match(c: Column, pattern: str) -> Column:
    """The text from the first match of ``pattern`` on."""
    return F.regexp_extract(c, rf"(?s)(?:{pattern}).*", 0)


def nonempty_after(c: Column | str, word: str, reach: int = 7) -> Column:
    """A content line exists within ``reach`` lines below the line of the first occurrence of ``word``."""
    text = tx.col(c)
    tail = tx.display_lines(F.substr(text, F.greatest(F.instr(text, word), F.lit(1))))
    below = F.slice(tail, 2, reach)
    content = F.exists(below, lambda line: (tx.strip_ws(line) != "") & ~tx.strip_ws(line).rlike(r"^(?:#|\||<!--|>)"))
    return F.coalesce(text.contains(word) & content, F.lit(False))
