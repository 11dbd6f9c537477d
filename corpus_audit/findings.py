"""One row shape for every violation, and a rule engine that needs one pass over a table.

A rule is ``(name, condition, message)``; all rules of a table become one array expression that is
compacted and exploded, so adding rules adds expressions to the same stage and no further scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FINDING_COLUMNS = ["layer", "rule", "entity", "locator", "message", "severity"]

Rule = tuple[str, Column, Column | str]


def _text(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value.cast("string")


def rule_findings(
    df: DataFrame,
    layer: str,
    entity: Column,
    rules: Sequence[Rule],
    locator: Column | None = None,
    severity: str = "error",
) -> DataFrame:
    """Rows of ``df`` x violated rules.  An undecidable (null) condition counts as a violation."""
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    F.coalesce(condition, F.lit(True)),
                    F.struct(F.lit(name).alias("rule"), F.coalesce(_text(message), F.lit("")).alias("message")),
                )
                for name, condition, message in rules
            ]
        )
    )
    return df.select(
        F.lit(layer).alias("layer"),
        entity.cast("string").alias("entity"),
        (F.lit(None) if locator is None else locator).cast("string").alias("locator"),
        F.explode(hits).alias("hit"),
    ).select(
        "layer",
        F.col("hit.rule").alias("rule"),
        "entity",
        "locator",
        F.col("hit.message").alias("message"),
        F.lit(severity).alias("severity"),
    )


def no_findings(spark: SparkSession) -> DataFrame:
    """A layer that found nothing."""
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in FINDING_COLUMNS))


def whole_findings(rows: DataFrame, layer: str) -> DataFrame:
    """Rows that carry some of the finding columns, with the others as nulls."""
    given = {c: F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string") for c in FINDING_COLUMNS}
    return rows.select(*[(F.lit(layer) if c == "layer" else v).alias(c) for c, v in given.items()])


def as_findings(
    df: DataFrame, layer: str, rule: str, entity: Column, message: Column | str,
    locator: Column | None = None, severity: str = "error",
) -> DataFrame:
    """Every row of ``df`` is one violation of ``rule`` (the shape used after anti joins)."""
    return df.select(
        F.lit(layer).alias("layer"),
        F.lit(rule).alias("rule"),
        entity.cast("string").alias("entity"),
        (F.lit(None) if locator is None else locator).cast("string").alias("locator"),
        F.coalesce(_text(message), F.lit("")).alias("message"),
        F.lit(severity).alias("severity"),
    )
