"""Study schedules: inputs, spreading points over days, repetition, validation, order checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_audit.findings import as_findings, rule_findings
from corpus_audit.functions import text as tx
from corpus_audit.scale import dealt, leaf_bytes, ranked

# Tiers in days, repetition offsets, item kinds.
HORIZONS = [30, 14, 7]
REPETITION_OFFSETS = [1, 3, 7]
ITEM_KINDS = ["read", "drill", "review"]


def day_kind(day: Column, days: Column) -> Column:
    """First half of the days read, next quarter drill, the rest review."""
    read = F.ceil(days / 2)
    return F.when(day <= read, F.lit("read")).when(day <= read + F.ceil(days / 4), F.lit("drill")).otherwise(F.lit("review"))


def inputs(exams: DataFrame, key: str) -> DataFrame:
    """Typed inputs with ``status`` and the ``missing`` keys; ``exams(key, exam_date TEXT, weekly_hours DOUBLE)``.

    A present but unparseable date is ``invalid``, which is neither missing nor planned.
    """
    raw = F.coalesce("exam_date", F.lit(""))
    parsed = F.when(tx.is_calendar_date(raw), F.try_to_date(raw, "yyyy-MM-dd"))
    invalid = (raw != "") & parsed.isNull()
    hours = F.when(F.col("weekly_hours") > 0, F.col("weekly_hours"))
    missing = F.array_compact(
        F.array(F.when(raw == "", F.lit("exam_date")), F.when(hours.isNull(), F.lit("weekly_hours")))
    )
    return exams.select(
        key,
        parsed.alias("exam_date"),
        hours.alias("weekly_hours"),
        F.when(invalid, F.lit("invalid")).when(F.size(missing) > 0, F.lit("named_gap")).otherwise(F.lit("planned")).alias("status"),
        F.array_join(missing, "、").alias("missing"),
    )


def spread(
    points: DataFrame, plans: DataFrame, key: str, order: list[str], block: Column, horizons: list[int] | None = None
) -> DataFrame:
    """Points over the days of each tier: one row per (key, tier, point).

    ``points(key, point_id, order...)``, ``plans(key, exam_date DATE, weekly_hours)``.  Point i of n falls on
    day ``((i + 1) * h - 1) div n + 1``; days without a point are dropped and the rest renumbered, which is the
    rank among the occupied days: min(n, h) of them are occupied, and with n >= h none is empty.  ``kind`` keeps
    the original day.  Ranks come from ``ranked``, so an entity of any size is spread over blocks of its order.
    """
    tiers = F.explode(F.array(*[F.lit(h) for h in horizons or HORIZONS]))
    totals = points.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    placed = ranked(points, [key], [F.col(c) for c in order], block, "_rank")
    placed = dealt(placed, key, size=leaf_bytes(points)).join(totals, key).join(plans, key)
    i, n, h = F.col("_rank") - 1, F.col("_n"), F.col("horizon_days")
    original = F.expr("((_rank * horizon_days - 1) div _n) + 1")
    # with fewer points than days every point has its own day, so its renumbered day is its own rank
    day = F.when(n < h, i + 1).otherwise(F.col("_day"))
    start = F.date_sub("exam_date", F.col("horizon_days") - 1)
    return (
        placed.withColumn("horizon_days", tiers)
        .withColumn("_day", original)
        .select(
            key, "point_id", "horizon_days",
            day.cast("bigint").alias("day"),
            F.expr("date_add(date_sub(exam_date, horizon_days - 1), cast(CASE WHEN _n < horizon_days THEN _rank ELSE _day END AS int) - 1)").alias("date"),
            start.alias("start_date"),
            F.col("exam_date").alias("end_date"),
            F.bround(F.col("weekly_hours") * 60 / 7).cast("int").alias("daily_minutes"),
            day_kind(F.col("_day"), h).alias("kind"),
        )
    )


def day_items(spread_rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per (key, tier, day): number of points and the first point, whose unit names the focus."""
    return spread_rows.groupBy(key, "horizon_days", "day", "date", "kind").agg(
        F.count(F.lit(1)).alias("n_points"), F.min_by("point_id", order).alias("focus_point")
    )


def spaced_repetition(points: DataFrame, offsets: list[int] | None = None, start: str | None = None) -> DataFrame:
    """Point x offset; with ``start`` (a date column) also the review date."""
    out = points.withColumn("offset_days", F.explode(F.array(*[F.lit(o) for o in offsets or REPETITION_OFFSETS])))
    return out if start is None else out.withColumn("review_date", F.date_add(start, F.col("offset_days")))


def validate(items: DataFrame, plans: DataFrame, points: DataFrame, key: str, horizons: list[int] | None = None) -> DataFrame:
    """Schedule findings.

    ``plans(key, tier_pos, horizon_days, start_date, end_date, exam_date, weekly_hours, daily_minutes)``,
    ``items(key, horizon_days, day, date, kind, point_id)``, ``points(key, point_id)``.
    Days must be 1..m without a hole and dates must rise with days; both are decided from per-day aggregates
    and an equi-join with the next day, without sorting an entity's items.
    """
    tiers = horizons or HORIZONS
    expected = F.try_element_at(F.array(*[F.lit(h) for h in tiers]), F.col("tier_pos").cast("int"))
    rules = [
        ("horizon_order", ~expected.eqNullSafe(F.col("horizon_days")), F.col("horizon_days")),
        ("end_date", ~F.col("end_date").eqNullSafe(F.col("exam_date")), F.col("end_date")),
        ("start_date", ~F.col("start_date").eqNullSafe(F.expr("date_sub(exam_date, horizon_days - 1)")), F.col("start_date")),
        ("weekly_hours", ~(F.col("weekly_hours") > 0), F.col("weekly_hours")),
        ("daily_minutes", F.col("daily_minutes") != F.bround(F.col("weekly_hours") * 60 / 7), F.col("daily_minutes")),
    ]
    where = F.col("horizon_days")
    out = rule_findings(plans, "schedule", F.col(key), rules, locator=where)
    counts = plans.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") != len(tiers))
    out = out.unionByName(as_findings(counts, "schedule", "plan_count", F.col(key), F.col("n")))
    kind_rule = [("kind", ~F.coalesce(F.col("kind").isin(ITEM_KINDS), F.lit(False)), F.col("kind"))]
    out = out.unionByName(rule_findings(items, "schedule", F.col(key), kind_rule, locator=where))
    days = items.groupBy(key, "horizon_days", "day").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    span = days.groupBy(key, "horizon_days").agg(F.count(F.lit(1)).alias("n"), F.min("day").alias("lo"), F.max("day").alias("hi"))
    holes = span.filter((F.col("lo") != 1) | (F.col("hi") != F.col("n")))
    out = out.unionByName(as_findings(holes, "schedule", "day_sequence", F.col(key), F.col("hi"), locator=where))
    following = days.select(key, "horizon_days", (F.col("day") - 1).alias("day"), F.col("first").alias("next_first"))
    steps = days.join(following, [key, "horizon_days", "day"]).filter(F.col("next_first") <= F.col("last"))
    out = out.unionByName(as_findings(steps, "schedule", "date_order", F.col(key), F.col("day"), locator=where))
    known = points.select(key, "point_id").distinct()
    unknown = items.join(known, [key, "point_id"], "left_anti")
    return out.unionByName(as_findings(unknown, "schedule", "point_unknown", F.col(key), F.col("point_id"), locator=where))


def first_divergence(actual: DataFrame, canonical: DataFrame, key: str) -> DataFrame:
    """First position per key where two sequences (key, pos, item) differ; a missing position differs."""
    a = actual.select(key, "pos", F.col("item").alias("actual"))
    c = canonical.select(key, "pos", F.col("item").alias("expected"))
    differs = a.join(c, [key, "pos"], "full").filter(~F.col("actual").eqNullSafe(F.col("expected")))
    return differs.groupBy(key).agg(F.min(F.struct("pos", "actual", "expected")).alias("d")).select(key, "d.*")
