"""Report tables: gap backlog, sitemap, level summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_audit.operators.model import LEVELS


def gap_backlog(gaps: DataFrame, limit: int = 0) -> DataFrame:
    """One issue per entity in backlog order; ``gaps(pos, code, title, priority, gaps ARRAY, materials_hint)``.

    ``limit`` 0 keeps all.
    """
    joined = F.array_join("gaps", "、")
    out = gaps.select(
        "pos",
        F.concat(F.lit("[course-gap] "), "code", F.lit(" "), "title", F.lit("："), joined).alias("issue_title"),
        F.concat_ws(",", F.lit("course-gap"), F.lower("priority"), F.lit("materials-needed")).alias("labels"),
        F.concat(F.lit("课程：`"), "code", F.lit("` "), "title", F.lit("\n\n缺口："), joined, F.lit("\n优先级："), "priority",
                 F.lit("\nmaterials线索："), "materials_hint").alias("body"),
    )
    return out.orderBy("pos").limit(limit) if limit else out


def sitemap(base_url: str, courses: DataFrame, majors: DataFrame) -> DataFrame:
    """(loc, priority): the three index routes, course routes, routes of existing majors.

    ``courses(route)``, ``majors(slug, present)``.
    """
    fixed = courses.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[F.struct(F.lit(base_url + p).alias("loc"), F.lit(w).alias("priority")) for p, w in (("/", "1.0"), ("/courses/", "0.9"), ("/majors/", "0.9"))]
            )
        )
    )
    pages = courses.select(F.concat(F.lit(base_url), "route").alias("loc"), F.lit("0.8").alias("priority"))
    plans = majors.filter("present").select(F.concat(F.lit(base_url + "/majors/"), "slug", F.lit("/")).alias("loc"), F.lit("0.7").alias("priority"))
    return fixed.unionByName(pages).unionByName(plans)


def unit_layers(points: DataFrame, keys: list[str], requirement: str = "requirement", levels: list[str] | None = None) -> DataFrame:
    """Ordered counts per level, ``未分级`` last, zero counts omitted: (keys, n_points, layers)."""
    names = levels or LEVELS
    counts = [F.count_if(F.col(requirement) == n).alias(f"_c{i}") for i, n in enumerate(names)]
    other = F.count_if(~F.coalesce(F.col(requirement).isin(names), F.lit(False))).alias("_other")
    per = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_points"), *counts, other)

    def part(label: str, c: str) -> Column:
        return F.when(F.col(c) > 0, F.concat(F.lit(label + " "), F.col(c).cast("string")))

    return per.select(
        *keys, "n_points",
        F.concat_ws("、", *[part(n, f"_c{i}") for i, n in enumerate(names)], part("未分级", "_other")).alias("layers"),
    )
