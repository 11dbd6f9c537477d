"""Page maturity: grading, public projection, tally, drift, legacy remap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_audit.functions import status as st
from corpus_audit.operators.evidence import fresh_equal
from corpus_audit.operators.structure import nonempty_after

# Required pages, the word whose section must not be empty, private reason marks.
REQUIRED = ["index.md", "sources.md", "practice.md", "plan.md"]
FILLED_AFTER = {"sources.md": "核验", "practice.md": "真题", "plan.md": "阶段目标"}
PRIVATE_REASONS = ["materials://", "raw.githubusercontent.com"]


def grade(entities: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """(key, lifecycle, completeness, maturity, reasons): missing pages are red, thin pages never green.

    ``entities(key, lifecycle, completeness)`` raw values, ``pages(key, name, text)``.  Pages are reduced to one row
    of flags per entity by mergeable aggregates; the page texts are judged where they are scanned.
    """
    filled = F.coalesce(*[F.when(F.col("name") == n, nonempty_after("text", w)) for n, w in FILLED_AFTER.items()], F.lit(True))
    flags = pages.filter(F.col("name").isin(REQUIRED)).select(key, "name", filled.alias("_filled"))
    has = [F.bool_or(F.col("name") == n).alias(f"_has{i}") for i, n in enumerate(REQUIRED)]
    per = flags.groupBy(key).agg(*has, F.bool_and("_filled").alias("_full"))
    joined = entities.join(per, key, "left")
    missing = F.array_compact(
        F.array(*[F.when(~F.coalesce(F.col(f"_has{i}"), F.lit(False)), F.lit(n)) for i, n in enumerate(REQUIRED)])
    )
    joined = joined.withColumn("_missing", missing).withColumn("lifecycle", st.normalize_lifecycle("lifecycle"))
    joined = joined.withColumn("completeness", st.normalize_completeness("completeness"))
    lacks = F.size("_missing") > 0
    thin = ~lacks & ~F.coalesce("_full", F.lit(False))
    level = F.when(lacks, F.lit("red")).otherwise(st.maturity_level("lifecycle", "completeness", thin))
    reasons = F.array_compact(
        F.array(
            F.when(lacks, F.concat(F.lit("missing:"), F.array_join("_missing", ","))),
            F.when(thin, F.lit("thin-required-pages")),
            F.concat(F.lit("lifecycle:"), "lifecycle"),
            F.concat(F.lit("completeness:"), "completeness"),
        )
    )
    return joined.select(key, "lifecycle", "completeness", level.alias("maturity"), reasons.alias("reasons"))


def project(rows: DataFrame, key: str, private: list[str] | None = None) -> DataFrame:
    """Public columns: private reasons hidden, next step derived from the first actionable reason."""
    marks = private or PRIVATE_REASONS

    def is_private(r: Column) -> Column:
        out = F.lit(False)
        for m in marks:
            out = out | r.contains(m)
        return out

    kept = F.filter("reasons", lambda r: ~is_private(r))
    step = F.filter("reasons", lambda r: r.startswith("missing:") | (r == "thin-required-pages"))
    first = F.try_element_at(step, F.lit(1))
    field = F.coalesce(F.nullif(F.trim(F.split_part(F.substr(first, F.lit(9)), F.lit(","), F.lit(1))), F.lit("")), F.lit("pages"))
    following = (
        F.when(first.startswith("missing:"), F.concat(F.lit("gap: "), field))
        .when(first.isNotNull(), F.lit("gap: 核验"))
        .otherwise(F.concat(F.lit("/courses/"), F.col(key).cast("string"), F.lit("/")))
    )
    return rows.select(
        key, "lifecycle", "completeness", "maturity",
        F.when(F.size(kept) > 0, F.array_join(kept, "; ")).otherwise(F.lit("-")).alias("reasons"),
        following.alias("next_step"),
    )


def tally(rows: DataFrame) -> DataFrame:
    """Count per level, zero included."""
    counts = rows.groupBy("maturity").agg(F.count(F.lit(1)).alias("n"))
    levels = rows.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in st.MATURITY_LEVELS])).alias("maturity"))
    return levels.join(counts, "maturity", "left").select("maturity", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def projection_drift(stored: DataFrame, computed: DataFrame, key: str) -> DataFrame:
    """Rows of a stored projection that differ from the recomputed ones, either side included."""
    return fresh_equal(stored, computed, key)


def remap(pages: DataFrame, generated: DataFrame, key: str) -> DataFrame:
    """Legacy status to lifecycle, never promoted to publishable; entities with generated content are skipped.

    ``pages(key, lifecycle, status, completeness, meta_completeness)``, nulls where the key is absent.
    """
    todo = pages.join(generated.select(key).distinct(), key, "left_anti")
    explicit = F.col("lifecycle").isNotNull()
    old = F.coalesce(F.nullif(F.col("lifecycle"), F.lit("")), F.col("status"), F.lit(""))
    mapped = st.legacy_lifecycle(F.when(explicit, F.col("lifecycle")).otherwise(F.col("status")))
    life = F.when(~explicit & (mapped == "publishable"), F.lit("machine_ready")).otherwise(mapped)
    raw = F.coalesce(F.nullif(F.col("completeness"), F.lit("")), F.nullif(F.col("meta_completeness"), F.lit("")), F.lit("metadata-only"))
    comp = st.normalize_completeness(raw)
    return todo.select(
        key, F.coalesce(F.nullif(old, F.lit("")), F.lit("(none)")).alias("old_status"), life.alias("lifecycle"), comp.alias("completeness"),
        st.display_status(life).alias("display"),
        (~F.col("lifecycle").eqNullSafe(life) | ~F.col("completeness").eqNullSafe(comp)).alias("changed"),
    )


def change_report(remapped: DataFrame) -> DataFrame:
    return remapped.groupBy("old_status", "lifecycle").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if("changed").alias("changed")
    )


