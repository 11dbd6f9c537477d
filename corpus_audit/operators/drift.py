"""Where two versions of a nested value differ: a walk down both at once, a level a round."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_audit.session import written

GENERATED = "generated_at"


def _kind(json: Column) -> Column:
    """object, array, number, string, boolean or null, by the first character of the value's text."""
    first = F.substring(json, 1, 1)
    return (
        F.when(first == "{", F.lit("object")).when(first == "[", F.lit("array")).when(first == '"', F.lit("string"))
        .when(first.isin("t", "f"), F.lit("boolean")).when(first == "n", F.lit("null")).otherwise(F.lit("number"))
    )


def _same_scalar(left: Column, right: Column, kind: Column) -> Column:
    """Numbers of equal value in different spellings."""
    number = lambda c: F.try_variant_get(c, "$", "double")
    whole = F.schema_of_variant(left).rlike("INT") & F.schema_of_variant(right).rlike("INT")
    return F.coalesce((kind == "number") & ~whole & (number(left) == number(right)), F.lit(False))


def _children(pairs: DataFrame, ignore: list[str]) -> DataFrame:
    """(key, path, left, right, lt, rt): the unequal entries of two containers of one kind, matched inside the row."""
    fields = lambda c: F.try_variant_get(c, "$", "map<string,variant>")
    items = lambda c: F.try_variant_get(c, "$", "array<variant>")
    both = lambda a, b: F.struct(a.alias("left"), b.alias("right"), F.to_json(a).alias("lt"), F.to_json(b).alias("rt"))
    unequal = lambda e: ~e.lt.eqNullSafe(e.rt)
    escaped = lambda k: F.replace(F.replace(k, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
    step = lambda name, e: F.struct(name.alias("step"), *[e[c].alias(c) for c in ("left", "right", "lt", "rt")])
    named = F.map_entries(F.map_zip_with(fields("left"), fields("right"), lambda _, a, b: both(a, b)))
    named = F.filter(named, lambda e: ~e.key.isin(ignore) & unequal(e.value)) if ignore else F.filter(named, lambda e: unequal(e.value))
    placed = F.transform(F.zip_with(items("left"), items("right"), both), lambda e, i: step(i.cast("string"), e))
    entries = F.when(F.col("_l") == "object", F.transform(named, lambda e: step(escaped(e.key), e.value))).otherwise(F.filter(placed, unequal))
    rows = pairs.select("_key", "path", F.explode(entries).alias("e"))
    return rows.select("_key", F.concat_ws("/", "path", "e.step").alias("path"), "e.left", "e.right", "e.lt", "e.rt")


def value_drift(left: DataFrame, right: DataFrame, key: str, text: str, ignore: list[str] | None = None) -> DataFrame:
    """Differences of two JSON values per key: (key, path, problem, left, right).

    ``left(key, text)``, ``right(key, text)``, a key once on each side.  ``path`` is a JSON pointer, empty for the whole value;
    ``problem`` is only_left, only_right, kind (object against array and so on), differs, or unreadable where a text is
    no JSON (on either side; null texts are unreadable).  Values below keys named in ``ignore`` (by default the stamp of
    generation) are not compared.  Numbers are equal by value; arrays are compared position by position.

    A round matches the entries of the containers that differ and are of one kind on both sides, inside their row; equal
    subtrees leave at once.  Each round is written, so there are as many as the values are deep, and a lost executor costs one.
    """
    ignore = [GENERATED] if ignore is None else ignore
    side = lambda df, name: df.select(F.col(key).alias("_key"), F.col(text).alias(f"{name}_text"), F.lit(True).alias(f"has_{name}"))
    both = side(left, "left").join(side(right, "right"), "_key", "full")
    both = both.withColumns({n: F.try_parse_json(f"{n}_text") for n in ("left", "right")}).withColumn("path", F.lit(""))
    there = F.col("has_left").isNotNull() & F.col("has_right").isNotNull()
    broken = (F.col("has_left").isNotNull() & F.col("left").isNull()) | (F.col("has_right").isNotNull() & F.col("right").isNull())
    texts = [F.to_json(n).alias(t) for n, t in (("left", "lt"), ("right", "rt"))]
    pairs = written(both.select("_key", "path", "left", "right", *texts, there.alias("both"), broken.alias("broken")), "drift")

    def found(rows: DataFrame, problem: Column) -> DataFrame:
        return rows.select(F.col("_key").alias(key), "path", problem.alias("problem"), F.col("lt").alias("left"), F.col("rt").alias("right"))

    lonely = F.when(F.col("lt").isNull(), F.lit("only_right")).otherwise(F.lit("only_left"))
    out = [
        found(pairs.where("broken"), F.lit("unreadable")),
        found(pairs.where("NOT broken AND NOT both"), lonely),
    ]
    pairs = pairs.where("both AND NOT broken").drop("both", "broken")
    while True:
        open_ = pairs.where("lt <> rt").withColumns({"_l": _kind(F.col("lt")), "_r": _kind(F.col("rt"))})
        apart = F.col("_l") != F.col("_r")
        scalar = ~apart & ~F.col("_l").isin("object", "array")
        out.append(found(open_.where(apart), F.lit("kind")))
        out.append(found(open_.where(scalar & ~_same_scalar(F.col("left"), F.col("right"), F.col("_l"))), F.lit("differs")))
        deeper = open_.where(~apart & ~scalar).drop("_r")
        entries = written(_children(deeper, ignore), "drift")
        alone = F.col("lt").isNull() | F.col("rt").isNull()
        out.append(found(entries.where(alone), lonely))
        pairs = entries.where(~alone)
        if pairs.isEmpty():
            return reduce(DataFrame.unionByName, out)
