"""Tool-call linking in DataFrame functions alone.

Calls meet their results by (conversation, call id), are put in topological order of their dependencies, have their
arguments validated against the schema of their tool, and are serialised as canonical JSON: no space, keys in order.

The level of a call is one more than the largest level among the calls it depends on.  A call with a single dependency
points at it; chains of such pointers are halved until they end at a call with none or several, so a conversation that
is one long chain takes a logarithmic number of joins.  Only calls with several dependencies are settled in rounds.
Calls on a cycle, or behind one, have no level and come last.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_audit.llm.common import stash
from corpus_audit.scale import ranked

Schema = dict[str, tuple[str, bool]]

#: The variant types that each schema type admits.
KINDS = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DOUBLE", "DECIMAL"),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
}

KEY = ["conv_id", "call_id"]


def argument_errors(name: Column, arguments: Column, schemas: dict[str, Schema]) -> Column:
    """Sorted array of what is wrong with the JSON text ``arguments`` for the tool ``name``."""
    value = F.try_parse_json(arguments)
    keys = F.map_keys(F.from_json(arguments, "map<string,string>"))
    checks, known = [], F.array().cast("array<string>")
    for tool, schema in sorted(schemas.items()):
        for field, (kind, required) in sorted(schema.items()):
            found = F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))
            own = F.when(found.isNull(), F.lit(f"missing {field}") if required else F.lit(None)).when(
                ~F.regexp_extract(found, "^[A-Z]+", 0).isin(*KINDS[kind]), F.lit(f"{field} is not {kind}")
            )
            checks.append(F.when(name == tool, own))
        known = F.when(name == tool, F.array(*[F.lit(f) for f in sorted(schema)]).cast("array<string>")).otherwise(known)
    listed = F.array(*checks, F.lit(None).cast("string"))
    extra = F.transform(F.array_except(F.coalesce(keys, F.array().cast("array<string>")), known), lambda k: F.concat(F.lit("unknown "), k))
    fine = F.array_sort(F.concat(F.filter(listed, lambda e: e.isNotNull()), extra))
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    unknown = ~F.coalesce(name.isin(*schemas), F.lit(False))
    return F.when(unknown, F.array(F.lit("unknown tool"))).when(~is_object, F.array(F.lit("arguments are not a JSON object"))).otherwise(fine)


def levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the calls that have one; ``edges`` is (conv_id, call_id, parent), both ends calls."""
    parents = edges.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("parent"))
    nodes = stash(calls.select(*KEY).join(parents, KEY, "left").withColumn("n", F.coalesce("n", F.lit(0))), "call-nodes")
    # end: the call at which the chain of single dependencies ends, dist: the steps to it
    single = F.col("n") == 1
    chain = nodes.select(*KEY, F.when(single, F.col("parent")).otherwise(F.col("call_id")).alias("end"), single.cast("long").alias("dist"), (~single).alias("open"))
    ends = nodes.select("conv_id", F.col("call_id").alias("end"), (~single).alias("ends"))
    chain = stash(chain.drop("open").join(ends, ["conv_id", "end"]), "chains")
    waiting = chain.where(~F.col("ends")).count()
    for _ in range(math.ceil(math.log2(waiting + 1)) + 1 if waiting else 0):
        step = chain.select("conv_id", F.col("call_id").alias("end"), F.col("end").alias("_end"), F.col("dist").alias("_dist"), F.col("ends").alias("_ends"))
        moved = chain.where(~F.col("ends")).join(step, ["conv_id", "end"])
        moved = moved.select(*KEY, F.col("_end").alias("end"), (F.col("dist") + F.col("_dist")).alias("dist"), F.col("_ends").alias("ends"))
        chain = stash(chain.where(F.col("ends")).select(*KEY, "end", "dist", "ends").unionByName(moved), "chains")
        before, waiting = waiting, chain.where(~F.col("ends")).count()
        if not waiting:
            break
    chain = chain.where(F.col("ends")).drop("ends")
    known = nodes.where(F.col("n") == 0).select(*KEY, F.lit(0).cast("long").alias("level"))
    several = nodes.where(F.col("n") > 1).select(*KEY, "n")
    left = several.count()
    while left:
        at = known.select("conv_id", F.col("call_id").alias("end"), "level")
        reached = chain.join(at, ["conv_id", "end"]).select("conv_id", F.col("call_id").alias("parent"), (F.col("level") + F.col("dist")).alias("level"))
        ready = several.join(known, KEY, "left_anti").join(edges, KEY).join(reached, ["conv_id", "parent"])
        ready = ready.groupBy(*KEY).agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("m"), F.max("level").alias("level"))
        known = stash(known.unionByName(ready.where(F.col("n") == F.col("m")).select(*KEY, (F.col("level") + 1).alias("level"))), "levels")
        before, left = left, several.join(known, KEY, "left_anti").count()
        if left == before:
            break
    at = known.select("conv_id", F.col("call_id").alias("end"), "level")
    return chain.join(at, ["conv_id", "end"]).select(*KEY, (F.col("level") + F.col("dist")).alias("level"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, Schema]) -> DataFrame:
    """One row per call and per result that no call asked for.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), depends_on (array of call ids).  ``results``:
    conv_id, call_id, turn, content.  Returns kind ("call" or "orphan"), conv_id, call_id, name, level, position (from 1
    in each conversation by level, turn and id), n_results, errors (joined by "; ", empty when valid) and message, the
    canonical JSON of id, name, arguments and result.

    Of several results the first by turn and content is linked and all are counted.  Rows without conv_id or call_id
    take no part; of calls that repeat an id the first by turn, name and arguments stands.  A dependency on itself or
    on an id that is no call is an error and orders nothing.  Null arguments or names are errors; empty tables give
    no rows.  Other columns are ignored.
    """
    whole = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    first = F.min_by(F.struct("turn", "name", "arguments", "depends_on"), F.struct("turn", "name", "arguments"))
    asked = calls.where(whole).groupBy(*KEY).agg(first.alias("c")).select(*KEY, "c.*")
    asked = stash(asked.withColumn("depends_on", F.array_distinct(F.filter(F.coalesce("depends_on", F.array().cast("array<string>")), lambda d: d.isNotNull()))), "calls")
    cited = asked.select(*KEY, F.explode("depends_on").alias("parent"))
    exist = asked.select("conv_id", F.col("call_id").alias("parent"), F.lit(True).alias("there"))
    cited = stash(cited.join(exist, ["conv_id", "parent"], "left").withColumn("there", F.coalesce("there", F.lit(False)) & (F.col("parent") != F.col("call_id"))), "cited")
    level = levels(asked, cited.where("there").select(*KEY, "parent"))
    astray = cited.where("not there").groupBy(*KEY).agg(F.array_sort(F.collect_set("parent")).alias("astray"))
    given = results.where(whole).groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_results"), F.min_by("content", F.struct("turn", "content")).alias("content")
    )
    rows = asked.join(given, KEY, "full").join(level, KEY, "left").join(astray, KEY, "left")
    is_call = F.col("turn").isNotNull() | F.col("name").isNotNull() | F.col("depends_on").isNotNull()
    wrong = F.concat(
        argument_errors(F.col("name"), F.col("arguments"), schemas),
        F.transform(F.coalesce("astray", F.array().cast("array<string>")), lambda d: F.concat(F.lit("no call "), d)),
        F.when(F.col("level").isNull(), F.array(F.lit("cycle"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("n_results").isNull(), F.array(F.lit("no result"))).otherwise(F.array().cast("array<string>")),
    )
    message = F.to_json(
        F.struct(F.try_parse_json("arguments").alias("arguments"), F.col("call_id").alias("id"), "name", F.col("content").alias("result"))
    )
    kind = F.when(is_call, F.lit("call")).otherwise(F.lit("orphan"))
    rows = stash(
        rows.select(
            kind.alias("kind"), *KEY, "turn", "name", "level", F.coalesce("n_results", F.lit(0)).alias("n_results"),
            F.when(is_call, F.array_join(wrong, "; ")).alias("errors"), F.when(is_call, message).alias("message"),
        ),
        "linked",
    )
    last = F.coalesce("level", F.lit(2**62))
    asked = ranked(rows.where(F.col("kind") == "call"), ["conv_id"], [last, F.col("turn"), F.col("call_id")], F.struct(last, F.floor(F.col("turn") / 4096)), "position")
    columns = ["kind", *KEY, "name", "level", "position", "n_results", "errors", "message"]
    alone = rows.where(F.col("kind") == "orphan").withColumn("position", F.lit(None).cast("long"))
    return asked.withColumn("position", F.col("position").cast("long")).select(*columns).unionByName(alone.select(*columns))
