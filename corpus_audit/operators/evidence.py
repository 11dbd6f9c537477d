"""Evidence per entity: located headings, matched rows, facts with provenance, eligibility, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_audit.findings import rule_findings
from corpus_audit.functions import text as tx
from corpus_audit.operators.structure import CODE_TOKEN, FIVE_DIGITS, contains_any

# Region header, corroborating words, limits, fields and gap texts.
REQUIREMENTS_HEADING = r"^[一二三四五六七八九十]+、考核知识点与考核要求$"
SAMPLE_MARK = "参考样卷"
REGION_HEADER = "教材代号"
CORROBORATION = ["出版社", "大学出版社", "高纲", "考试指导委员会"]
WINDOW_RADIUS = 2
#: citations and lines meet by blocks of 2 ** BLOCK_BITS line numbers
BLOCK_BITS = 5
ROW_CHARS = 200
FACT_FIELDS = ["name", "credits", "exam_method"]
FACT_GAPS = {
    "name": ("读者无法确认该课码对应的官方课程名", "官方专业计划表中的课程行"),
    "credits": ("读者无法判断该课的学分权重与备考投入", "官方专业计划表中的课程行"),
    "exam_method": ("读者无法判断该课是笔试、机考还是实践考核", "官方专业计划表中的课程行"),
}
SYLLABUS_GAP = (
    "缺官方考纲 → 无章目 / 考核要求 / 题型依据，AI 备考层一律不生成（放行等级非 L1）",
    "jseea.cn 公开的该课自学考试大纲原件（入库并抽取为 document.extracted.md）",
)
TEXTBOOK_GAP = (
    "缺官方教材计划行 → 读者无法核对指定教材，知识点无法与教材章节对齐",
    "官方《开考课程教材计划》抽取件中出现该课码的教材代号行（`<code>\\d{1,3}`）",
)
FACT_STATUSES = ["verified", "named_gap"]
REQUIRED_KEYS = {
    ("syllabus", "extracted"): ["path", "sha256", "requirements_heading"],
    ("syllabus", "missing"): ["gap_impact", "next_evidence"],
    ("textbook", "matched"): ["doc_id", "path", "locator", "row"],
    ("textbook", "missing"): ["gap_impact", "next_evidence"],
}


def locate_heading(lines: DataFrame, keys: list[str], pattern: str = REQUIREMENTS_HEADING, marker: str = SAMPLE_MARK) -> DataFrame:
    """First line whose folded text matches, verbatim, with locator; and whether any line holds ``marker``."""
    folded = tx.fold_ws("text")
    hit = F.when(folded.rlike(pattern), F.col("line_no"))
    found = lines.groupBy(*keys).agg(
        F.min_by(folded, hit).alias("heading"), F.min(hit).alias("_at"), F.bool_or(F.col("text").contains(marker)).alias("has_marker")
    )
    return found.select(*keys, "heading", F.concat(F.lit("L"), F.col("_at").cast("string")).alias("locator"), "has_marker")


def windowed_match(lines: DataFrame, keys: list[str], codes: DataFrame, digits: str = FIVE_DIGITS) -> DataFrame:
    """Rows of a textbook list that name a code: (keys, code, line_no, row, truncated).

    Below the region header a token ``<code><1-3 digits>`` hits when the five lines around it, header lines
    removed and clipped to the region, hold the standalone code and a corroborating word.  The heads of a token that
    have the ``digits`` of a code, one to three digits shorter than it, are joined with the codes.
    """
    whole = Window.partitionBy(*keys)
    w = Window.partitionBy(*keys).orderBy("line_no")
    header = F.col("text").contains(REGION_HEADER)
    region = lines.withColumn("_start", F.min(F.when(header, F.col("line_no"))).over(whole)).filter(F.col("line_no") >= F.col("_start"))
    shown = F.when(~header, F.col("text"))
    offsets = range(-WINDOW_RADIUS, WINDOW_RADIUS + 1)
    region = region.withColumn("_shown", shown)
    around = [F.lag("_shown", -o).over(w) if o < 0 else F.lead("_shown", o).over(w) if o else F.col("_shown") for o in offsets]
    tokens = F.filter(F.split(tx.strip_ws("text"), tx.SPACE + "+", -1), lambda t: t.rlike(rf"\A{digits}[0-9]{{1,3}}\z"))


    def heads(token: Column) -> Column:
        shorter = F.array(*[F.substring(token, F.lit(1), F.length(token) - n) for n in (1, 2, 3)])
        return F.filter(shorter, lambda head: head.rlike(rf"\A{digits}\z"))

    hits = (
        region.withColumn("_near", tx.fold_ws(F.concat_ws(" ", *around)))
        .select(*keys, "line_no", "_near", F.explode(F.array_distinct(F.flatten(F.transform(tokens, heads)))).alias("code"))
        .filter(contains_any(F.col("_near"), CORROBORATION))
        .filter(F.array_contains(F.regexp_extract_all("_near", F.lit(CODE_TOKEN.replace(FIVE_DIGITS, digits)), F.lit(0)), F.col("code")))
    )
    return hits.join(codes.select("code").distinct(), "code", "left_semi").select(
        *keys, "code", "line_no", F.substring("_near", 1, ROW_CHARS).alias("row"), (F.length("_near") > ROW_CHARS).alias("truncated")
    )


def canonical_match(matches: DataFrame) -> DataFrame:
    """Per code the rows of its newest document: (code, doc_id, path, locator, row, row_truncated, n_rows).

    ``matches(code, doc_id, path, line_no, row, truncated)``.  The joined row keeps 200 characters and every row
    adds at least four with its separator, so only the first 50 rows can reach the text; lengths and flags are
    summed over all rows, and all locators stay available as rows of ``matches``.
    """
    newest = matches.groupBy("code").agg(F.max("doc_id").alias("doc_id"))
    rows = matches.join(newest, ["code", "doc_id"], "left_semi")
    totals = rows.groupBy("code", "doc_id").agg(
        F.min("path").alias("path"),
        F.min("line_no").alias("_line"),
        F.count(F.lit(1)).alias("n_rows"),
        (F.sum(F.length("row")) + 3 * (F.count(F.lit(1)) - 1)).alias("_chars"),
        F.bool_or("truncated").alias("_cut"),
    )
    order = Window.partitionBy("code", "doc_id").orderBy("line_no", "row")
    lead = (
        rows.withColumn("_rn", F.row_number().over(order))
        .filter(F.col("_rn") <= ROW_CHARS // 4)
        .groupBy("code", "doc_id")
        .agg(F.array_sort(F.collect_list(F.struct("_rn", "row"))).alias("_rows"))
    )
    text = F.array_join(F.transform("_rows", lambda r: r.row), " / ")
    return totals.join(lead, ["code", "doc_id"]).select(
        "code", "doc_id", "path",
        F.concat(F.lit("L"), F.col("_line").cast("string")).alias("locator"),
        F.substring(text, 1, ROW_CHARS).alias("row"),
        (F.col("_cut") | (F.col("_chars") > ROW_CHARS)).alias("row_truncated"),
        "n_rows",
    )


def eligibility(syllabus_status: Column, textbook_status: Column) -> Column:
    """``struct(level, reasons)``: L1 when the syllabus is extracted and the textbook matched, else blocked."""
    syllabus = F.coalesce(syllabus_status == "extracted", F.lit(False))
    textbook = F.coalesce(textbook_status == "matched", F.lit(False))
    return F.struct(
        F.when(syllabus & textbook, F.lit("L1")).otherwise(F.lit("blocked")).alias("level"),
        F.array(
            F.when(syllabus, F.lit("syllabus:extracted")).otherwise(F.lit("syllabus:missing")),
            F.when(textbook, F.lit("textbook_plan:matched")).otherwise(F.lit("textbook_plan:missing")),
        ).alias("reasons"),
    )


def facts(codes: DataFrame, catalog: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Code x field grid: value with provenance of the best source, or the named gap.

    ``catalog(code, <fields>, doc_id, path, locator)`` holds one row per code with its best source.
    """
    names = fields or FACT_FIELDS
    grid = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"), F.col(f).cast("string").alias("_v"),
                F.lit(FACT_GAPS[f][0]).alias("_gap"), F.lit(FACT_GAPS[f][1]).alias("_next"),
            )
            for f in names
        ]
    )
    rows = codes.select("code").distinct().join(catalog, "code", "left").select("code", "doc_id", "path", "locator", F.inline(grid))
    known = (F.coalesce("_v", F.lit("")) != "") & F.col("doc_id").isNotNull()
    keep = lambda c: F.when(known, F.col(c))
    return rows.select(
        "code", "field",
        keep("_v").alias("value"),
        F.when(known, F.lit("verified")).otherwise(F.lit("named_gap")).alias("status"),
        keep("doc_id").alias("doc_id"), keep("path").alias("path"), keep("locator").alias("locator"),
        F.when(~known, F.col("_gap")).alias("gap_impact"), F.when(~known, F.col("_next")).alias("next_evidence"),
    )


def supporting_locator(cites: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Line that supports a cited value: (cite_id, line_no, how).

    ``cites(cite_id, key, line_no, value)``.  First the nearest line within two that contains the value (ties to
    the lower number); else the value cut once in two, tail in the lines below and head in the nearest line above;
    else the original line.

    Lines and citations meet by blocks of 32 line numbers: a line goes to the block or two blocks it is near to, a
    citation to that of its own line, so either is shuffled once and not once for each line of the window.
    """
    r = WINDOW_RADIUS
    slots = [key, "_block"]
    block = lambda n: F.shiftright(n.cast("bigint"), BLOCK_BITS)
    n = F.col("line_no")
    text = lines.select(
        key, n.cast(cites.schema["line_no"].dataType).alias("line_no"), tx.fold_ws("text").alias("_t"),
        F.explode(F.array_distinct(F.array(block(n - r), block(n + r)))).alias("_block"),
    )
    texts = text.repartition(*slots).groupBy(*slots).agg(F.collect_set(F.struct("line_no", "_t")).alias("_lines"))
    # equal citations of one line are one, but for those without a line near them
    asked = cites.select("cite_id", key, "value", n.alias("_center"), block(n).alias("_block")).repartition(*slots)
    asked = asked.groupBy("cite_id", *slots, "value", "_center").agg(F.count(F.lit(1)).alias("_copies"))
    met = asked.join(texts, slots, "left").withColumn(
        "_near", F.filter(F.coalesce("_lines", F.array()), lambda x: F.abs(x["line_no"] - F.col("_center")) <= r)
    )
    holds = F.filter("_near", lambda x: F.contains(x["_t"], F.col("value")))
    exact = F.array_min(F.transform(holds, lambda x: F.struct(F.abs(x["line_no"] - F.col("_center")).alias("d"), x["line_no"].alias("line_no"))))
    at = lambda o: F.array_max(F.transform(F.filter("_near", lambda x: x["line_no"] == F.col("_center") + o), lambda x: x["_t"]))
    spots = [at(o).alias(f"_p{o + r}") for o in range(-r, r + 1) if o]
    per = met.where(F.size("_near") > 0).select("cite_id", "value", "_center", exact.alias("_exact"), *spots)
    after = F.concat_ws(" ", *[F.col(f"_p{o + r}") for o in range(1, r + 1)])

    def cut(n: Column) -> Column:
        head, tail = F.substr(F.col("value"), F.lit(1), n), F.substr(F.col("value"), n + 1, F.length("value"))
        at = F.coalesce(
            *[F.when(F.col(f"_p{o + r}").contains(head), F.col("_center") + o) for o in range(-1, -r - 1, -1)]
        )
        return F.when(F.contains(F.col("_after"), tail), at)

    splits = F.when(F.length("value") >= 2, F.sequence(F.lit(1), F.length("value") - 1)).otherwise(F.array().cast("array<int>"))
    wrapped = F.try_element_at(F.filter(F.transform(splits, cut), lambda x: x.isNotNull()), F.lit(1))
    out = per.withColumn("_after", after)
    found = out.select(
        "cite_id",
        F.coalesce(F.col("_exact.line_no"), wrapped, F.col("_center")).alias("line_no"),
        F.when(F.col("_exact").isNotNull(), F.lit("line")).when(wrapped.isNotNull(), F.lit("wrapped")).otherwise(F.lit("original")).alias("how"),
    )
    alone = met.where(F.size("_near") == 0).select("cite_id", "_center", F.explode(F.array_repeat(F.lit("original"), F.col("_copies").cast("int"))).alias("how"))
    known = met.where(F.size("_near") > 0).select("cite_id")
    rest = alone.join(known, "cite_id", "left_anti").select("cite_id", F.col("_center").alias("line_no"), "how")
    return found.unionByName(rest)


def assemble(codes: DataFrame, syllabus: DataFrame, textbook: DataFrame, urls: DataFrame, fact_rows: DataFrame) -> DataFrame:
    """One evidence row per code; missing parts become explicit statuses with their gap texts.

    ``syllabus(code, path, sha256, heading, locator, has_sample)``: a document without heading is a candidate only, its digest
    is not evidence; ``textbook(code, doc_id, path, locator, row, row_truncated)``, ``urls(code, url)``, ``facts`` rows.
    Of a code that repeats in a part, the row with the least path (document, url) counts.
    """
    f = fact_rows.groupBy("code").agg(
        F.count_if(F.col("status") == "verified").alias("verified_facts"),
        F.count_if(F.col("status") == "named_gap").alias("named_gaps"),
        F.max(F.when(F.col("field") == "name", F.col("value"))).alias("name"),
    )
    first = lambda df, names, by: df.groupBy("code").agg(F.min_by(F.struct(*names), F.struct(*by)).alias("_x")).select("code", "_x.*")
    s = first(syllabus, ["path", "sha256", "heading", "locator", "has_sample"], ["path"])
    s = s.select("code", *[F.col(c).alias(f"_{c}") for c in s.columns[1:]])
    t = first(textbook, ["doc_id", "path", "locator", "row", "row_truncated"], ["path", "doc_id"])
    t = t.select("code", *[F.col(c).alias(f"textbook_{c}") for c in ("doc_id", "path", "locator", "row")], F.col("row_truncated"))
    u = first(urls.select("code", F.col("url").alias("course_url")), ["course_url"], ["course_url"])
    out = codes.select("code").distinct()
    for part in (f, s, t, u):
        out = out.join(part, "code", "left")
    extracted, matched = F.col("_heading").isNotNull(), F.col("textbook_doc_id").isNotNull()
    out = out.withColumn("syllabus_status", F.when(extracted, F.lit("extracted")).otherwise(F.lit("missing"))).withColumn(
        "textbook_status", F.when(matched, F.lit("matched")).otherwise(F.lit("missing"))
    )
    verdict = eligibility(F.col("syllabus_status"), F.col("textbook_status"))
    return out.select(
        "code", "course_url", "name", "verified_facts", "named_gaps", "syllabus_status",
        F.when(extracted, F.concat(F.lit("syllabus:"), "code")).alias("syllabus_doc_id"),
        F.when(extracted, F.col("_path")).alias("syllabus_path"), F.when(extracted, F.col("_sha256")).alias("syllabus_sha256"),
        F.when(~extracted, F.col("_path")).alias("candidate_path"), extracted.alias("has_assessment_requirements"),
        F.coalesce("_has_sample", F.lit(False)).alias("has_sample_paper"), F.col("_heading").alias("requirements_heading"),
        F.when(extracted, F.col("_locator")).alias("syllabus_locator"),
        F.when(~extracted, F.lit(SYLLABUS_GAP[0])).alias("syllabus_gap_impact"), F.when(~extracted, F.lit(SYLLABUS_GAP[1])).alias("syllabus_next_evidence"),
        "textbook_status", "textbook_doc_id", "textbook_path", "textbook_locator", "textbook_row", "row_truncated",
        F.when(~matched, F.lit(TEXTBOOK_GAP[0])).alias("textbook_gap_impact"), F.when(~matched, F.lit(TEXTBOOK_GAP[1])).alias("textbook_next_evidence"),
        verdict.level.alias("level"), verdict.reasons.alias("reasons"),
    )


# -- validation ---------------------------------------------------------------------------------

def _blank(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")) == ""


def validate_facts(rows: DataFrame, entity: Column) -> DataFrame:
    """``rows(field, status, value, doc_id, gap_impact, next_evidence)``; an unknown status reports nothing else."""
    status = F.col("status")
    known = F.coalesce(status.isin(FACT_STATUSES), F.lit(False))
    rules = [
        ("fact_status", ~known, status),
        ("fact_provenance", known & (status == "verified") & _blank("doc_id"), F.col("field")),
        ("fact_gap", known & (status == "named_gap") & (_blank("gap_impact") | _blank("next_evidence")), F.col("field")),
        ("fact_value", known & (status != "verified") & ~_blank("value"), F.col("field")),
    ]
    return rule_findings(rows, "evidence", entity, rules, locator=F.col("field"))


def rederive(ev: DataFrame, entity: Column) -> DataFrame:
    """Stored level must equal the recomputed one; each status needs its keys.

    ``ev(level, n_reasons, syllabus_status, textbook_status, syllabus_<key>..., textbook_<key>...)``.
    """
    expected = eligibility(F.col("syllabus_status"), F.col("textbook_status")).level
    rules = [
        ("level", ~expected.eqNullSafe(F.col("level")), F.col("level")),
        ("reasons", ~(F.coalesce("n_reasons", F.lit(0)) > 0), "reasons"),
        ("syllabus_status", ~F.coalesce(F.col("syllabus_status").isin("extracted", "missing"), F.lit(False)), F.col("syllabus_status")),
        ("textbook_status", ~F.coalesce(F.col("textbook_status").isin("matched", "missing"), F.lit(False)), F.col("textbook_status")),
    ]
    for (part, state), names in REQUIRED_KEYS.items():
        here = F.coalesce(F.col(f"{part}_status") == state, F.lit(False))
        rules += [(f"{part}_{state}_{n}", here & _blank(f"{part}_{n}"), n) for n in names]
    return rule_findings(ev, "evidence", entity, rules)


def digest_drift(recorded: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """``recorded(key, path, sha256)`` against ``actual(path, digest)``: missing file and mismatch are different."""
    files = actual.select("path", "digest", F.lit(True).alias("_there"))
    joined = recorded.filter(F.col("path").isNotNull() & F.col("sha256").isNotNull()).join(files, "path", "left")
    problem = F.when(F.col("_there").isNull(), F.lit("missing_file")).when(F.col("digest") != F.col("sha256"), F.lit("digest_mismatch"))
    return joined.withColumn("problem", problem).filter(F.col("problem").isNotNull()).select(key, "path", "problem")


def url_provenance(
    ev: DataFrame, baseline: DataFrame, codes: DataFrame, domain: str, key: str, entity: Column | None = None
) -> DataFrame:
    """``ev(key, course_url)`` against ``baseline(url, authoritative)`` and ``codes(url, code)``.

    An empty baseline judges nothing; whether it is empty is a scalar subquery.
    """
    known = baseline.groupBy("url").agg(F.bool_or("authoritative").alias("_auth")).withColumn("_known", F.lit(True))
    listed = codes.select("url", F.col("code").alias(key), F.lit(True).alias("_listed")).distinct()
    any_entry = baseline.limit(1).agg(F.count(F.lit(1)) > 0).scalar()
    joined = (
        ev.filter(F.col("course_url").isNotNull() & any_entry)
        .withColumnRenamed("course_url", "url")
        .join(known, "url", "left")
        .join(listed, ["url", key], "left")
    )
    inside = F.col("_known").isNotNull()
    rules = [
        ("url_unknown", ~inside, F.col("url")),
        ("url_not_authoritative", inside & ~F.coalesce("_auth", F.lit(False)), F.col("url")),
        ("url_outside_domain", inside & ~tx.is_in_domain("url", domain), F.col("url")),
        ("url_code", inside & F.col("_listed").isNull(), F.col("url")),
    ]
    return rule_findings(joined, "evidence", F.col(key) if entity is None else entity, rules)


def forbidden_artifacts(ev: DataFrame, artifacts: DataFrame, key: str) -> DataFrame:
    """Downstream artefacts (key, artifact) of entities that are not L1."""
    ineligible = ev.filter(~F.coalesce(F.col("level") == "L1", F.lit(False))).select(key).distinct()
    return artifacts.select(key, "artifact").distinct().join(ineligible, key, "left_semi")


def without_field(c: Column, dtype: T.DataType, name: str) -> Column:
    """The value with every struct field called ``name`` removed, at any depth."""
    if isinstance(dtype, T.StructType):
        return F.struct(*[without_field(c[f.name], f.dataType, name).alias(f.name) for f in dtype.fields if f.name != name])
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: without_field(x, dtype.elementType, name))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda _, v: without_field(v, dtype.valueType, name))
    return c


def fresh_equal(left: DataFrame, right: DataFrame, key: str, ignore: str = "generated_at") -> DataFrame:
    """Keys whose rows differ, ignoring one field everywhere: (key, problem).  Rows meet as digests only."""

    def digest(df: DataFrame, name: str) -> DataFrame:
        body = [without_field(F.col(f.name), f.dataType, ignore).alias(f.name) for f in df.schema.fields if f.name not in (key, ignore)]
        return df.select(key, F.sha2(F.to_json(F.struct(*body), {"ignoreNullFields": "false"}), 256).alias(name))

    joined = digest(left, "_l").join(digest(right, "_r"), key, "full")
    problem = F.when(F.col("_l").isNull(), F.lit("only_right")).when(F.col("_r").isNull(), F.lit("only_left")).when(
        F.col("_l") != F.col("_r"), F.lit("differs")
    )
    return joined.select(key, problem.alias("problem")).filter(F.col("problem").isNotNull())


def publishable_value(status: Column, value: Column, key: Column) -> Column:
    """The value only when verified and non-empty, else the entity key; nothing else can feed it."""
    return F.coalesce(F.when((status == "verified") & (value != ""), value), key)
