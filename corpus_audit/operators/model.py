"""Unit / section / point models, with denominators counted independently of the parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_audit.findings import as_findings, rule_findings
from corpus_audit.functions import text as tx
from corpus_audit.operators import structure as st
from corpus_audit.scale import neighbors, ranked

# Labels, marks, identifier grammar, limits and rule texts.
CHAPTER_LABEL = r"^(?:导论|绪\s*论|第\s*(?:[一二三四五六七八九十]+|[0-9]+)\s*章)"
NOT_ASSESSED = "不作考核要求"
FOCUS_MARK = "本章重点"
PAREN_LABEL = r"（([一二三四五六七八九十]+)）"
POINT_ID = r"(intro|ch[0-9]{2}|ap[0-9]{2})-s[0-9]+-p[0-9]+"
MIN_COVERAGE = 0.90
GAP_RANGE = 1 << 16
LEVELS = ["识记", "领会", "应用"]
MANUAL_HEADING = "## 章节知识树"
MANUAL_ELEMENT = r"^([0-9]+)\.([0-9]+)\s+(.*)$"
MANUAL_LEVEL_MARKS = {"🟢": "识记", "🟡": "领会", "🔴": "应用"}
RULE_BY_SECTION = "考纲「{}」中带编号的节数"
RULE_BY_UNIT = "考纲「{}」中的章数（该考纲不分子节，章即考核单元）"
RULE_APPENDICES = "，另加 {} 个附录单元（`附录N` 各为一个考核单元）"


def unit_identity(title: Column | str) -> Column:
    """``struct(ordinal, slug, label)`` from the chapter label: introductions are 0 / ``intro``."""

    def label_of(t: Column) -> Column:
        mark = F.nullif(F.regexp_extract(t, CHAPTER_LABEL, 0), F.lit(""))
        return tx.squeeze(F.coalesce(mark, F.split_part(t, F.lit(" "), F.lit(1))))

    def identity(x: Column) -> Column:
        return F.struct(
            F.coalesce(x.number, F.lit(0)).alias("ordinal"),
            F.when(x.number.isNull(), F.lit("intro")).otherwise(F.format_string("ch%02d", x.number)).alias("slug"),
            x.label.alias("label"),
        )

    label = tx.let(tx.strip_ws(title), label_of)
    numbered = tx.let(label, lambda x: F.struct(x.alias("label"), tx.chapter_number(x).alias("number")))
    return tx.let(numbered, identity)


def appendix_identity(title: Column | str) -> Column:
    """``struct(ordinal, slug, label)`` from a numbered, titled appendix heading; nulls for anything else."""

    def identity(x: Column) -> Column:
        return F.struct(
            x.number.alias("ordinal"),
            F.when(x.number.isNotNull(), F.format_string("ap%02d", x.number)).alias("slug"),
            F.when(x.number.isNotNull(), F.concat(F.lit("附录"), x.mark)).alias("label"),
        )

    marked = tx.let(
        tx.fold_ws(title),
        lambda t: F.struct(tx.appendix_number(t).alias("number"), F.regexp_extract(t, st.APPENDIX_TITLE, 1).alias("mark")),
    )
    return tx.let(marked, identity)


def missing_ordinals(units: DataFrame, key: str, block: int = 4096) -> DataFrame:
    """Ordinals absent from a sequence that must start at 0 or 1 and step by 1: (key, missing).

    The predecessor comes from ``neighbors``, so a key with any number of ordinals is cut into slices.
    """
    distinct = units.select(key, F.col("ordinal").cast("bigint").alias("ordinal")).distinct()
    prev = neighbors(distinct, [key], ["ordinal"], ["ordinal"], F.floor(F.col("ordinal") / block), previous="_prev")
    # a first ordinal of 0 or 1 opens no gap; any other first ordinal misses 1 .. first - 1
    start = F.when(F.col("_prev").isNull(), F.lit(1)).otherwise(F.col("_prev.ordinal") + 1)
    gap = prev.filter(F.col("ordinal") > start)
    # a wide gap is cut into ranges that are dealt out first, so that no row or task holds more than its ranges
    last = F.col("ordinal") - 1
    ranges = gap.select(key, last.alias("_last"), F.explode(F.sequence(start, last, F.lit(GAP_RANGE))).alias("_first"))
    ranges = ranges.repartition(key, "_first")
    own = F.sequence("_first", F.least(F.col("_last"), F.col("_first") + (GAP_RANGE - 1)))
    return ranges.select(key, F.explode(own).alias("missing"))


def ordinal_findings(units: DataFrame, key: str, block: int = 4096) -> DataFrame:
    """Row-by-row form: (key, pos, ordinal) whose first ordinal is not 0/1 or whose step is not 1."""
    prev = neighbors(units.select(key, "pos", "ordinal"), [key], ["pos"], ["ordinal"], F.floor(F.col("pos") / block), previous="_prev")
    bad = F.when(F.col("_prev").isNull(), ~F.col("ordinal").isin(0, 1)).otherwise(F.col("ordinal") != F.col("_prev.ordinal") + 1)
    rules = [("ordinal_step", bad, F.col("ordinal"))]
    return rule_findings(prev, "model", F.col(key), rules, locator=F.col("pos"))


def runs(numbers: DataFrame, key: str, number: str, block: int = 4096) -> DataFrame:
    """Consecutive numbers as runs: (key, run_start, run_end, label) with label ``第a–b章`` or ``第a章``."""
    distinct = numbers.select(key, F.col(number).cast("bigint").alias("n")).distinct()
    placed = ranked(distinct, [key], [F.col("n")], F.floor(F.col("n") / block), "_rank")
    islands = placed.groupBy(key, (F.col("n") - F.col("_rank")).alias("_island")).agg(
        F.min("n").alias("run_start"), F.max("n").alias("run_end")
    )
    a, b = F.col("run_start").cast("string"), F.col("run_end").cast("string")
    label = F.when(F.col("run_start") == F.col("run_end"), F.concat(F.lit("第"), a, F.lit("章"))).otherwise(
        F.concat(F.lit("第"), a, F.lit("–"), b, F.lit("章"))
    )
    return islands.select(key, "run_start", "run_end", label.alias("label"))


def requirement_block(logical: DataFrame, keys: list[str], heading: str) -> DataFrame:
    """Logical lines after the heading of each unit, up to the next top heading."""
    return st.section_slice(logical, keys, F.col("text") == heading, F.col("text").rlike(st.TOP_HEADING))


def section_label(c: Column) -> Column:
    """``struct(index, title)`` of ``1.title`` or ``（一）title``, else null."""
    paren = F.regexp_extract(c, st.PAREN_SECTION, 1)
    return F.when(
        c.rlike(st.NUMBERED_SECTION),
        F.struct(F.regexp_extract(c, st.NUMBERED_SECTION, 1).alias("index"), tx.strip_ws(F.regexp_extract(c, st.NUMBERED_SECTION, 2)).alias("title")),
    ).when(
        c.rlike(st.PAREN_SECTION),
        F.struct(
            F.coalesce(tx.chinese_number(paren).cast("string"), paren).alias("index"),
            tx.strip_ws(F.regexp_extract(c, st.PAREN_SECTION, 2)).alias("title"),
        ),
    )


def classify_block(block: DataFrame, keys: list[str], unit_title: str) -> DataFrame:
    """Role of every line of a requirement block.

    Adds ``role`` (section, requirement, unmodeled), ``section_line`` / ``section_index`` / ``section_title``,
    ``requirement``, ``body`` and ``reason``.  A block without any number is one section ``1`` named after the
    unit.  Sections marked as not assessed open no section; what follows them is traced with that reason.
    """
    w = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    label = section_label(F.col("text"))
    base = block.withColumn("_label", label)
    base = base.withColumn("_numbered", F.bool_or(F.col("_label").isNotNull()).over(Window.partitionBy(*keys)))
    opens = F.when(
        F.col("_label").isNotNull(),
        F.struct(
            F.col("line_no").alias("line"), F.col("_label.index").alias("index"), F.col("_label.title").alias("title"),
            F.col("_label.title").contains(NOT_ASSESSED).alias("skipped"),
        ),
    )
    base = base.withColumn("_s", F.last(opens, ignorenulls=True).over(w))
    whole = ~F.col("_numbered") & ~F.col(unit_title).contains(NOT_ASSESSED)
    live = F.coalesce(~F.col("_s.skipped"), F.lit(False)) | whole
    is_req = F.col("text").rlike(st.REQUIREMENT)
    base = base.withColumn("_live", live).withColumn("_req", is_req)
    section_line = F.coalesce(F.col("_s.line"), F.lit(0).cast("bigint"))
    # a requirement seen earlier in the same section ends the unlabelled lead-in
    within = Window.partitionBy(*keys, section_line).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    base = base.withColumn("_seen", F.bool_or(F.col("_req") & F.col("_live")).over(within))
    skipped_label = F.col("_label").isNotNull() & F.col("_s.skipped")
    role = (
        F.when(skipped_label, F.lit("unmodeled"))
        .when(F.col("_label").isNotNull(), F.lit("section"))
        .when(F.col("_live") & (F.col("_req") | ~F.coalesce("_seen", F.lit(False))), F.lit("requirement"))
        .otherwise(F.lit("unmodeled"))
    )
    out = base.withColumn("role", role)
    reason = F.when(F.coalesce(F.col("_s.skipped"), F.lit(False)), F.lit("not_assessed")).otherwise(F.lit("unnumbered_section"))
    modeled = F.col("role") == "requirement"
    return out.select(
        *block.columns,
        "role",
        section_line.alias("section_line"),
        F.when(whole, F.lit("1")).otherwise(F.col("_s.index")).alias("section_index"),
        F.when(whole, F.col(unit_title)).otherwise(F.col("_s.title")).alias("section_title"),
        F.when(modeled & F.col("_req"), F.regexp_extract("text", st.REQUIREMENT, 1)).alias("requirement"),
        F.when(modeled, F.when(F.col("_req"), F.regexp_extract("text", st.REQUIREMENT, 2)).otherwise(F.col("text"))).alias("body"),
        F.when(F.col("role") == "unmodeled", reason).alias("reason"),
        whole.alias("unit_level"),
    )


def sections(classified: DataFrame, keys: list[str]) -> DataFrame:
    """Assessed sections: (keys, section_line, section_index, section_title, unit_level)."""
    rows = classified.filter((F.col("role") == "section") | (F.col("unit_level") & (F.col("role") == "requirement")))
    return rows.select(*keys, "section_line", "section_index", "section_title", "unit_level").distinct()


def points(classified: DataFrame, keys: list[str], prefix: Column) -> DataFrame:
    """Points of a model: phrases numbered per section in (line, phrase) order.

    (keys, point_id, section_line, section_index, seq, title, requirement, quote, locator); a section lies inside
    one document, so its window is bounded by that document.
    """
    rows = classified.filter(F.col("role") == "requirement").select(
        *keys, "section_line", "section_index", "requirement", "line_no", prefix.alias("_prefix"),
        F.posexplode(tx.split_phrases("body")).alias("_p", "title"),
    )
    order = Window.partitionBy(*keys, "section_line").orderBy("line_no", "_p")
    seq = F.row_number().over(order)
    return rows.withColumn("seq", seq).select(
        *keys,
        F.concat(F.col("_prefix"), F.lit("-s"), F.col("section_index"), F.lit("-p"), F.col("seq").cast("string")).alias("point_id"),
        "section_line", "section_index", "seq", "title", "requirement",
        tx.bounded_quote("title").alias("quote"),
        F.concat(F.lit("L"), F.col("line_no").cast("string")).alias("locator"),
    )


def focus(logical: DataFrame, keys: list[str]) -> DataFrame:
    """Phrases between the focus heading and the next heading: (keys, line_no, pos, phrase)."""
    start = (F.col("kind") == "heading") & F.col("text").contains(FOCUS_MARK)
    rows = st.section_slice(logical, keys, start, F.col("kind") == "heading")
    return rows.select(*keys, "line_no", F.posexplode(tx.split_phrases("text")).alias("pos", "phrase"))


def declared_indexes(c: Column) -> Column:
    """Section numbers a line declares, in both grammars; bracketed ones anywhere in the line."""
    numbered = F.when(c.rlike(st.NUMBERED_SECTION), F.array(F.regexp_extract(c, st.NUMBERED_SECTION, 1))).otherwise(
        F.array().cast("array<string>")
    )
    bracketed = F.transform(
        F.regexp_extract_all(c, F.lit(PAREN_LABEL), F.lit(1)),
        lambda x: F.coalesce(tx.chinese_number(x).cast("string"), F.concat(F.lit("（"), x, F.lit("）"))),
    )
    return F.concat(numbered, bracketed)


def unaccounted(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """Section numbers declared and neither produced nor traced, from one pass: (keys, index).

    ``tagged(keys, index, declared, accounted)`` with one row per mention.
    """
    per = tagged.groupBy(*keys, "index").agg(F.bool_or("declared").alias("_d"), F.bool_or("accounted").alias("_a"))
    return per.filter(F.col("_d") & ~F.col("_a")).select(*keys, "index")


def declared_vs_produced(declared: DataFrame, produced: DataFrame, traced: DataFrame, keys: list[str]) -> DataFrame:
    """The same from three separate frames (keys, index)."""
    mention = lambda df, d: df.select(*keys, "index", F.lit(d).alias("declared"), F.lit(not d).alias("accounted"))
    return unaccounted(mention(declared, True).unionByName(mention(produced, False)).unionByName(mention(traced, False)), keys)


def section_mentions(classified: DataFrame, keys: list[str]) -> DataFrame:
    """Mentions of section numbers in a classified block: declared in its text, produced, or traced."""
    text = F.transform(
        declared_indexes(F.col("text")),
        lambda i: F.struct(i.alias("index"), F.lit(True).alias("declared"), F.coalesce(F.col("reason") == "not_assessed", F.lit(False)).alias("accounted")),
    )
    made = F.when(
        F.col("role") == "section",
        F.array(F.struct(F.col("section_index").alias("index"), F.lit(False).alias("declared"), F.lit(True).alias("accounted"))),
    )
    return classified.select(*keys, F.inline(F.concat(text, F.coalesce(made, F.slice(text, 1, 0)))))


def independent_denominator(lines: DataFrame, keys: list[str], heading: str) -> DataFrame:
    """Assessment units counted from raw text: (keys, declared_units).

    Every heading line inside the content part counts the distinct section numbers below it, at least one.
    """
    folded = lines.withColumn("text", tx.fold_ws("text"))
    part = F.col("text").rlike(st.PART_LABEL)
    whole = Window.partitionBy(*keys)
    running = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    base = folded.withColumn("_a", F.max(F.when(part & F.col("text").contains(st.BODY_MARK), F.col("line_no"))).over(whole))
    base = base.withColumn("_z", F.min(F.when(part & F.col("text").startswith("Ⅳ") & (F.col("line_no") > F.col("_a")), F.col("line_no"))).over(whole))
    inside = (F.col("line_no") >= F.col("_a")) & (F.col("_z").isNull() | (F.col("line_no") < F.col("_z")))
    anchor = F.when(inside & (F.col("text") == heading), F.col("line_no"))
    top = F.when(F.col("text").rlike(st.TOP_HEADING) | (F.col("text") == heading), F.col("line_no"))
    base = base.withColumn("_anchor", F.max(anchor).over(running)).withColumn("_top", F.max(top).over(running))
    counted = base.filter(inside & F.col("_anchor").isNotNull() & (F.col("_top") == F.col("_anchor")))
    skipped = F.col("text").contains(NOT_ASSESSED) & (F.size(declared_indexes(F.col("text"))) > 0)
    numbers = F.when((F.col("line_no") > F.col("_anchor")) & ~skipped, declared_indexes(F.col("text")))
    per = counted.select(*keys, "_anchor", F.explode_outer(numbers).alias("index")).groupBy(*keys, "_anchor").agg(
        F.greatest(F.countDistinct("index"), F.lit(1)).alias("_n")
    )
    units = per.groupBy(*keys).agg(F.sum("_n").alias("declared_units"))
    return lines.select(*keys).distinct().join(units, keys, "left").select(
        *keys, F.coalesce("declared_units", F.lit(0).cast("bigint")).alias("declared_units")
    )


def denominator_status(extracted: Column, raw: Column, normalized: Column, official: Column) -> Column:
    """``struct(declared, problem)``: not judged, raw count, normalised count, or a contradiction."""
    declared = F.when(extracted, F.coalesce(F.when(raw > 0, raw), F.when(normalized > 0, normalized)))
    unreadable = extracted & declared.isNull()
    return F.struct(
        declared.alias("declared"),
        F.when(F.coalesce(unreadable, F.lit(False)), F.lit("denominator_unreadable"))
        .when(F.coalesce(declared != official, F.lit(False)), F.lit("denominator_mismatch"))
        .alias("problem"),
    )


def coverage(section_rows: DataFrame, point_rows: DataFrame, key: str, section_keys: list[str], heading: str) -> DataFrame:
    """Coverage per entity from section rows and point rows.

    ``section_rows(key, section_keys..., unit_class, unit_level)``; ``point_rows(key, section_keys...)``.
    """
    has = point_rows.select(key, *section_keys).distinct().withColumn("has_points", F.lit(True))
    flagged = section_rows.join(has, [key, *section_keys], "left")
    return coverage_counts(flagged.withColumn("has_points", F.col("has_points").isNotNull()), key, heading)


def section_flags(classified: DataFrame, keys: list[str]) -> DataFrame:
    """Assessed sections with ``has_points``, straight from the classified lines in one aggregation."""
    modeled = F.col("role") == "requirement"
    per = classified.groupBy(*keys, "section_line").agg(
        F.bool_or((F.col("role") == "section") | (F.col("unit_level") & modeled)).alias("_assessed"),
        F.bool_or(modeled & (F.size(tx.split_phrases("body")) > 0)).alias("has_points"),
        F.bool_or("unit_level").alias("unit_level"),
    )
    return per.filter("_assessed").drop("_assessed")


def coverage_counts(flagged: DataFrame, key: str, heading: str) -> DataFrame:
    """Official and modelled section counts, ratio (4 digits, half-even) and the rule that names the denominator."""
    per = flagged.groupBy(key).agg(
        F.count(F.lit(1)).alias("official"), F.count_if("has_points").alias("modeled"),
        F.bool_and("unit_level").alias("_by_unit"), F.count_if(F.col("unit_class") == "appendix").alias("appendices"),
    )
    base = F.when(F.col("_by_unit"), F.lit(RULE_BY_UNIT.format(heading))).otherwise(F.lit(RULE_BY_SECTION.format(heading)))
    before, after = RULE_APPENDICES.split("{}")
    tail = F.when(F.col("appendices") > 0, F.concat(F.lit(before), F.col("appendices").cast("string"), F.lit(after))).otherwise(F.lit(""))
    return per.select(
        key, "official", "modeled",
        F.when(F.col("official") > 0, F.bround(F.col("modeled") / F.col("official"), 4)).otherwise(F.lit(0.0)).alias("ratio"),
        F.concat(base, tail).alias("rule"),
    )


def parse_manual(lines: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Hand-kept knowledge tree: (elements, findings).

    Elements (keys, line_no, ordinal, section, title, levels) are numbered ``####`` lines under the tree heading.
    ``####`` lines there that do not parse, and numbered ones in a page without the heading, are findings.
    """
    line = tx.strip_ws("text")
    is_heading = line == MANUAL_HEADING
    marked = lines.withColumn("_t", line)
    body = st.section_slice(marked, keys, is_heading, F.col("text").startswith("## "))
    title = tx.strip_ws(F.regexp_replace("_t", "^#### ", ""))
    rows = body.filter(F.col("_t").startswith("#### ")).withColumn("_title", title)
    shown = tx.strip_ws(F.regexp_replace(F.regexp_extract("_title", MANUAL_ELEMENT, 3), r"\s*—\s*[🟢🟡🔴\s]+$", ""))
    levels = F.array_compact(F.array(*[F.when(F.col("_title").contains(m), F.lit(v)) for m, v in MANUAL_LEVEL_MARKS.items()]))
    elements = rows.filter(F.col("_title").rlike(MANUAL_ELEMENT)).select(
        *keys, "line_no", F.regexp_extract("_title", MANUAL_ELEMENT, 1).cast("int").alias("ordinal"),
        F.regexp_extract("_title", MANUAL_ELEMENT, 2).alias("section"), shown.alias("title"), levels.alias("levels"),
    )
    entity = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    where = F.concat(F.lit("L"), F.col("line_no").cast("string"))
    unparsed = as_findings(rows.filter(~F.col("_title").rlike(MANUAL_ELEMENT)), "model", "manual_unparsed", entity, F.col("_title"), where)
    anchored = marked.filter(is_heading).select(*keys).distinct()
    loose = marked.filter(F.col("_t").startswith("#### ") & title.rlike(MANUAL_ELEMENT)).join(anchored, keys, "left_anti")
    orphans = loose.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("line_no").alias("line_no"))
    orphans = as_findings(orphans, "model", "manual_orphans", entity, F.col("n"), where)
    return elements, unparsed.unionByName(orphans)


def diff_ledger(manual: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """matched / manual_only / model_only per key, with notes on levels and titles.

    ``manual(keys, title, levels)``, ``model(keys, title, levels, first_point)``; levels are arrays over the closed
    level list.  Titles that differ only in quote style are told apart from other differences.
    """
    m = manual.select(*keys, F.col("title").alias("manual_title"), F.array_sort("levels").alias("_ml"), F.lit(True).alias("_m"))
    o = model.select(*keys, F.col("title").alias("model_title"), F.array_sort("levels").alias("_ol"), "first_point", F.lit(True).alias("_o"))
    j = m.join(o, keys, "full")
    plain = lambda c: F.translate(c, "「」『』", "“”‘’")
    both = F.col("_m") & F.col("_o")
    note = F.concat_ws(
        ";",
        F.when(both & (F.col("_ml") != F.col("_ol")), F.lit("levels_differ")),
        F.when(both & (F.col("manual_title") != F.col("model_title")),
               F.when(plain(F.col("manual_title")) == plain(F.col("model_title")), F.lit("quote_style")).otherwise(F.lit("title_differs"))),
    )
    kind = F.when(both, F.lit("matched")).when(F.col("_m"), F.lit("manual_only")).otherwise(F.lit("model_only"))
    return j.select(*keys, kind.alias("kind"), "first_point", note.alias("note"))


def validate_points(point_rows: DataFrame, key: str, coverage_rows: DataFrame, digits: str = tx.FIVE_DIGITS) -> DataFrame:
    """Identifier grammar per entity, duplicates, quotes, coverage below the minimum.

    ``point_rows(key, point_id, quote)``, ``coverage_rows(key, ratio)``; the entity code is the id prefix.
    """
    pid, quote = F.col("point_id"), F.col("quote")
    shaped = F.coalesce(pid.startswith(F.concat(F.col(key).cast("string"), F.lit("-"))) & pid.rlike(rf"\A{digits}-{POINT_ID}\z"), F.lit(False))
    blank = F.coalesce(tx.strip_ws(quote), F.lit("")) == ""
    rules = [
        ("point_id", ~shaped, pid),
        ("quote_missing", blank, pid),
        ("quote_long", ~blank & (F.length(quote) > tx.MAX_QUOTE_CHARS), F.length(quote)),
    ]
    rows = rule_findings(point_rows, "model", F.col(key), rules)
    dup = point_rows.groupBy(key, "point_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    low = coverage_rows.filter(F.col("ratio") < MIN_COVERAGE)
    return rows.unionByName(as_findings(dup, "model", "point_duplicate", F.col(key), F.col("point_id"))).unionByName(
        as_findings(low, "model", "coverage_low", F.col(key), F.col("ratio"))
    )


def ordered_list_equal(model: DataFrame, page: DataFrame, page_state: DataFrame, key: str) -> DataFrame:
    """Ordered titles of a model against a second source, whitespace aside.

    ``model(key, pos, title)``, ``page(key, pos, title)``, ``page_state(key, has_table)``: no table = not judged,
    table without readable rows = finding, else every position must agree.  A position that repeats is compared in
    every pair of its titles, reckoned from the counts of equal ones.

    Titles and tables are rows of one union, so all is settled by aggregates and sides dealt by ``key`` are not shuffled again.
    """

    def side(titles: DataFrame, of_model: int) -> DataFrame:
        return titles.select(
            key, "pos", tx.squeeze("title").alias("_t"), F.lit(of_model).alias("_m"), F.lit(1 - of_model).alias("_p"), F.lit(False).alias("_table")
        )

    tables = page_state.filter("has_table").select(
        key, F.lit(None).cast(model.schema["pos"].dataType).alias("pos"), F.lit(None).cast("string").alias("_t"),
        F.lit(0).alias("_m"), F.lit(0).alias("_p"), F.lit(True).alias("_table"),
    )
    rows = side(model, 1).unionByName(side(page, 0)).unionByName(tables)
    titles = rows.groupBy(key, "pos", "_t").agg(F.sum("_m").alias("_m"), F.sum("_p").alias("_p"), F.bool_or("_table").alias("_table"))
    blank = lambda c: F.sum(F.when(F.col("_t").isNull(), F.col(c)).otherwise(0))
    places = titles.groupBy(key, "pos").agg(
        F.sum("_m").alias("_m"), F.sum("_p").alias("_p"), F.sum(F.col("_m") * F.col("_p")).alias("_same"),
        (blank("_m") + blank("_p")).alias("_blank"), F.bool_or("_table").alias("_table"),
    )
    met = F.col("pos").isNotNull() & (F.col("_m") > 0) & (F.col("_p") > 0)
    places = places.withColumn("_n", F.when(met, F.col("_m") * F.col("_p") - F.col("_same")).otherwise(F.col("_m") + F.col("_p") - F.col("_blank")))
    first = places.groupBy(key).agg(
        F.min(F.when(F.col("_n") > 0, F.col("pos"))).alias("pos"), F.sum("_n").alias("n"), F.sum("_p").alias("_p"), F.bool_or("_table").alias("_table")
    )
    readable = F.col(key).isNotNull() & (F.col("_p") > 0)
    rules = [("page_table_unreadable", F.col("_table") & ~readable, ""), ("titles_differ", readable & (F.col("n") > 0), F.col("n"))]
    found = rule_findings(first, "model", F.col(key), rules, locator=F.col("pos"))
    return found.withColumn("locator", F.when(F.col("rule") == "titles_differ", F.col("locator")))


def key_clash(units: DataFrame, keys: list[str], slug: str, locator: str) -> DataFrame:
    """Units of one entity that derive the same slug: (keys, slug, n, first_locator, last_locator)."""
    return (
        units.filter(F.col(slug).isNotNull())
        .groupBy(*keys, slug)
        .agg(F.count(F.lit(1)).alias("n"), F.min(locator).alias("first_locator"), F.max(locator).alias("last_locator"))
        .filter(F.col("n") > 1)
    )


def unit_neighbors(units: DataFrame, key: str, block: int = 4096) -> DataFrame:
    """Reading order (chapters, then appendices) with previous and next slug across the class border.

    ``units(key, unit_class INT 0/1, ordinal, slug)``.
    """
    slice_of = F.struct("unit_class", F.floor(F.col("ordinal") / block))
    out = neighbors(units, [key], ["unit_class", "ordinal"], ["slug"], slice_of, previous="_prev", following="_next")
    return out.select(key, "unit_class", "ordinal", "slug", F.col("_prev.slug").alias("previous"), F.col("_next.slug").alias("following"))
