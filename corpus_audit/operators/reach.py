"""Whether generated content reached its pages: values in their section, drill anchors, folded answers, whole study plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_audit.findings import as_findings, rule_findings
from corpus_audit.functions import text as tx
from corpus_audit.operators.model import POINT_ID

# Pages, headings and marks of the page contract.
PLAN_PAGE, REVIEW_PAGE, PRACTICE_PAGE = "plan.md", "review.md", "practice.md"
STAGE_HEADING = r"(?dmU)^### 阶段：(.+?)\s*$"
DRILL_HEADING = r"(?dm)^### "
FOLD = r"(?dm)^<details[> ]"
STRATEGY_SECTION, GAP_SECTION = "应试策略", "命名缺口"
STAGE_LISTS = ["goal", "inputs", "how", "outputs"]
NAMED_GAP = "named_gap"

#: values of a section that meet its text in one row
VALUES = 256


def section_body(text: Column | str, title: str) -> Column:
    """Text below ``## title`` up to the next ``## `` heading; null where there is no such heading."""
    return tx.extract_or_null(tx.col(text), rf"(?dmsU)^## {title}\s*$(.*?)(?=^## |\z)")


def _given(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) != ""


def _absent(body: Column, value: Column) -> Column:
    return _given(value) & ~F.coalesce(body.contains(value), F.lit(False))


def missing_values(expected: DataFrame, sections: DataFrame, keys: list[str]) -> DataFrame:
    """Expected strings absent from the text of their section: (keys, field, value); an absent section misses them all.

    ``expected(keys, field, value)``, ``sections(keys, body)``.  The distinct values of a section are cut into sets of
    ``VALUES`` by hash and meet its text as sets, so the shuffle carries each value once and a text once per set, and a
    section with a third of all values is spread over its sets.  A value counts where any text of the section has it.
    """
    values = expected.where(_given(F.col("value"))).select(*keys, "field", "value").distinct()
    sets = values.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / VALUES).cast("int").alias("_sets"))
    part = F.pmod(F.xxhash64("field", "value"), F.col("_sets")).cast("int")
    wanted = values.join(sets, keys).withColumn("_set", part).groupBy(*keys, "_set").agg(F.collect_list(F.struct("field", "value")).alias("_values"))
    bodies = sections.join(sets, keys).select(*keys, "body", F.explode(F.sequence(F.lit(0), F.col("_sets") - 1)).alias("_set"))
    met = wanted.join(bodies, [*keys, "_set"], "left")
    absent = met.select(*keys, F.explode(F.filter("_values", lambda v: _absent(F.col("body"), v["value"]))).alias("v"), "body")
    absent = absent.select(*keys, "v.field", "v.value")
    several = sections.groupBy(*keys).agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("_n"))
    counted = absent.groupBy(*keys, "field", "value").agg(F.count(F.lit(1)).alias("_k")).join(several, keys, "left")
    return counted.where(F.col("_k") >= F.coalesce("_n", F.lit(1))).select(*keys, "field", "value")


def page_tokens(pages: DataFrame, keys: list[str], digits: str = tx.FIVE_DIGITS) -> DataFrame:
    """Distinct (keys, point_id): the point ids that stand in a page's text, also as the head of a longer number.

    One scan of the text finds the ids; only they leave it.
    """
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(digits + "-" + POINT_ID), F.lit(0)))
    tokens = pages.select(*keys, F.explode(found).alias("_token"))
    stem = F.regexp_extract("_token", r"^(.*-p)[0-9]+$", 1)
    number = F.regexp_extract("_token", r"([0-9]+)$", 1)
    heads = F.transform(F.sequence(F.lit(1), F.length("_number")), lambda n: F.concat("_stem", F.substring(F.col("_number"), F.lit(1), n)))
    return tokens.select(*keys, stem.alias("_stem"), number.alias("_number")).select(*keys, F.explode(heads).alias("point_id")).distinct()


def drill_reach(blocks: DataFrame, pages: DataFrame, entity: str, digits: str = tx.FIVE_DIGITS) -> DataFrame:
    """Findings of drills that did not reach the practice page of their entity.

    ``blocks(entity, kind, point_id)``, ``pages(entity, page, text)``.  Fewer third-level headings than drills, an id that
    stands nowhere in the page, and answers of which none is folded; an entity without the page misses everything.
    Blocks without an id are only counted.  Where a page repeats, its text with the most headings counts, and an id in any.
    """
    drills = blocks.where(F.col("kind") == "drill")
    practice = pages.where(F.col("page") == PRACTICE_PAGE).select(entity, F.coalesce("text", F.lit("")).alias("text"))
    shown = practice.groupBy(entity).agg(
        F.max(F.size(F.regexp_extract_all("text", F.lit(DRILL_HEADING), F.lit(0)))).alias("_rendered"), F.bool_or(F.col("text").rlike(FOLD)).alias("_folded")
    )
    counted = drills.groupBy(entity).agg(F.count(F.lit(1)).alias("_drills")).join(shown, entity, "left")
    rendered = F.coalesce("_rendered", F.lit(0))
    rules = [
        ("drill_headings", rendered < F.col("_drills"), F.concat_ws(" of ", rendered.cast("string"), F.col("_drills").cast("string"))),
        ("answers_unfolded", ~F.coalesce("_folded", F.lit(False)), PRACTICE_PAGE),
    ]
    ids = drills.where(_given(F.col("point_id"))).select(entity, "point_id").distinct()
    lost = ids.join(page_tokens(practice, [entity], digits), [entity, "point_id"], "left_anti")
    return rule_findings(counted, "content", F.col(entity), rules).unionByName(
        as_findings(lost, "content", "drill_anchor", F.col(entity), F.col("point_id"))
    )


def _stage_hits(plan: Column) -> Column:
    def of(stage: Column) -> Column:
        lists = [
            F.when(F.coalesce(F.exists(stage[name], lambda v: _absent(plan, v)), F.lit(False)), F.struct(F.lit(name).alias("rule"), stage["stage"].alias("message")))
            for name in STAGE_LISTS
        ]
        done = F.when(_absent(plan, stage["done_when"]), F.struct(F.lit("done_when").alias("rule"), stage["stage"].alias("message")))
        return F.array_compact(F.array(done, *lists))

    return F.flatten(F.transform(F.coalesce("stage_plan", F.array()), of))


def _hit(rule: str, condition: Column, message: Column) -> Column:
    return F.when(condition, F.struct(F.lit(rule).alias("rule"), message.alias("message")))


def plan_reach(contents: DataFrame, pages: DataFrame, entity: str) -> DataFrame:
    """Findings of study plans, strategies and review schedules that did not reach their pages.

    ``contents(entity, stage_plan array<struct<stage, goal, inputs, how, outputs array<string>, done_when>>,
    strategies array<struct<block_id, text_md>>, schedule struct<status, gap_impact, next_evidence, tiers array<string>>)``,
    ``pages(entity, page, text)``.  The stage headings of the plan are the stages in order; every done_when and list item
    stands in the plan; a strategy's text stands inside its section; a named gap has both its texts inside its section,
    any other schedule every tier in brackets in the review.  An absent page is an empty one, blank values are not asked
    for; of a page that repeats the greatest text counts.

    One join brings a content and its two pages together; the values stay in their row, so a text is read once for all.
    """
    of = lambda page, name: F.max(F.when(F.col("page") == page, F.col("text"))).alias(name)
    texts = pages.where(F.col("page").isin(PLAN_PAGE, REVIEW_PAGE)).groupBy(entity).agg(of(PLAN_PAGE, "_plan"), of(REVIEW_PAGE, "_review"))
    blank = F.lit("")
    rows = contents.join(texts, entity, "left").withColumns({"_plan": F.coalesce("_plan", blank), "_review": F.coalesce("_review", blank)})
    rows = rows.withColumns({"_strategy": section_body("_plan", STRATEGY_SECTION), "_gap": section_body("_review", GAP_SECTION)})
    plan, review, strategy, gap = (F.col(c) for c in ("_plan", "_review", "_strategy", "_gap"))
    names = F.filter(F.transform(F.coalesce("stage_plan", F.array()), lambda s: s["stage"]), _given)
    shown = F.regexp_extract_all(plan, F.lit(STAGE_HEADING), F.lit(1))
    schedule = F.col("schedule")
    is_gap = F.coalesce(schedule["status"] == NAMED_GAP, F.lit(False))
    strategies = F.transform(
        F.coalesce("strategies", F.array()),
        lambda b: F.coalesce(
            _hit("strategy_section", strategy.isNull(), b["block_id"]), _hit("strategy_text", _absent(strategy, tx.strip_ws(b["text_md"])), b["block_id"])
        ),
    )
    tiers = F.transform(
        F.coalesce(schedule["tiers"], F.array()),
        lambda t: _hit("tier", ~is_gap & _given(t) & ~review.contains(F.concat(F.lit("（"), t, F.lit("）"))), t),
    )
    single = F.array(
        _hit("stage_names", ~names.eqNullSafe(shown), F.array_join(shown, "|")),
        _hit("gap_section", is_gap & gap.isNull(), F.lit(GAP_SECTION)),
        _hit("gap_impact", is_gap & gap.isNotNull() & _absent(gap, schedule["gap_impact"]), schedule["gap_impact"]),
        _hit("next_evidence", is_gap & gap.isNotNull() & _absent(gap, schedule["next_evidence"]), schedule["next_evidence"]),
    )
    hits = F.array_compact(F.concat(single, strategies, tiers, _stage_hits(plan)))
    found = rows.select(F.col(entity).cast("string").alias("entity"), F.explode(hits).alias("h"))
    none = F.lit(None).cast("string")
    return found.select(
        F.lit("content").alias("layer"), F.col("h.rule").alias("rule"), "entity", none.alias("locator"),
        F.coalesce("h.message", blank).alias("message"), F.lit("error").alias("severity"),
    )
