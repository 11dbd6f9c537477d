"""Multi-source catalogues: tier choice, merging, conflicts, batch resolution, referential checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_audit.findings import as_findings
from corpus_audit.functions import text as tx
from corpus_audit.operators.structure import CODE_TOKEN
from corpus_audit.scale import ranked

# Source names from most to least trusted, declaration format, practice method.
SOURCE_NAMES = ["index.md", "plan.raw.txt", "major-source"]
CODE_DECLARATION = r"专业代码[：:]\s*([0-9A-Za-z]+)"
PRACTICE = "实践"


def tier_waterfall(candidates: DataFrame, entity: str, tier: str) -> DataFrame:
    """Per entity only the rows of its best tier; any candidate row, parsed or dropped, claims the tier."""
    best = candidates.groupBy(entity).agg(F.min(tier).alias(tier))
    return candidates.join(best, [entity, tier], "left_semi")


def find_declaring_doc(docs: DataFrame, codes: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """First document by path whose text declares the code: (code, path).

    Declared tokens are extracted once.  A code counts when it is the token or a prefix of it that no digit
    follows, so tokens are exploded into those prefixes and the codes join by equality.
    """
    token = F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(CODE_DECLARATION), F.lit(1))))
    declared = docs.select(path, token.alias("_t"))
    prefixes = F.transform(
        F.filter(F.sequence(F.lit(1), F.length("_t")), lambda n: ~F.substr(F.col("_t"), n + 1, F.lit(1)).rlike("[0-9]")),
        lambda n: F.substr(F.col("_t"), F.lit(1), n),
    )
    names = declared.select(path, F.explode(prefixes).alias("code"))
    return names.join(codes.select("code").distinct(), "code").groupBy("code").agg(F.min(path).alias("path"))


def dropped_ledger(parsed: DataFrame, dropped: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates per document = parsed + dropped; the dropped rows keep locator, raw text and reason."""
    p = parsed.groupBy(*keys).agg(F.count(F.lit(1)).alias("parsed"))
    d = dropped.groupBy(*keys).agg(F.count(F.lit(1)).alias("dropped"))
    zero = F.lit(0).cast("bigint")
    return p.join(d, keys, "full").select(
        *keys, F.coalesce("parsed", zero).alias("parsed"), F.coalesce("dropped", zero).alias("dropped"),
        (F.coalesce("parsed", zero) + F.coalesce("dropped", zero)).alias("candidates"),
    )


def first_value(records: DataFrame, entity: str, fields: list[str], order: list[str]) -> DataFrame:
    """Per entity and field the first non-null value in ``order``; a mergeable min-by, no sort per entity."""
    sort_key = F.struct(*order)
    return records.groupBy(entity).agg(
        *[F.min_by(F.col(f), F.when(F.col(f).isNotNull(), sort_key)).alias(f) for f in fields]
    )


def field_values(records: DataFrame, entity: str, fields: dict[str, Column], order: list[str]) -> DataFrame:
    """Distinct normalised values per (entity, field) with the first provenance of each.

    ``fields`` maps a field to the comparison key of its value; output (entity, field, key, value, order...).
    """
    entries = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"), key.cast("string").alias("key")) for f, key in fields.items()]
    )
    long = records.select(entity, *order, F.inline(entries)).filter(F.col("value").isNotNull())
    first = F.min(F.struct(*order, "value")).alias("_f")
    return long.groupBy(entity, "field", "key").agg(first).select(entity, "field", "key", "_f.*")


def conflicts(
    records: DataFrame, entity: str, fields: dict[str, Column], order: list[str], slice_by: list[str] | None = None
) -> DataFrame:
    """Fields with more than one distinct value: one row per value with its first provenance and position.

    Values are reduced to distinct ones first; their number is an aggregate and their position a two-level rank over
    slices by ``slice_by``, leading columns of the order (default: the first two) that cut a busy entity finely.
    """
    values = field_values(records, entity, fields, order)
    # counting the provenance keeps this branch's columns those of the others, so all of them share one reduction
    sizes = values.groupBy(entity, "field").agg(F.count("value").alias("n_values")).filter(F.col("n_values") > 1)
    several = values.join(sizes, [entity, "field"])
    placed = ranked(several, [entity, "field"], [F.col(c) for c in order], F.struct(*(slice_by or order[:2])), "position")
    return placed.select(entity, "field", *order, "value", "n_values", "position")


def consolidate(
    records: DataFrame, entity: str, fields: list[str], keys: dict[str, Column], order: list[str], group: list[str], name: str | None = None
) -> DataFrame:
    """One row per entity: first values, counts of distinct groups, source rows and conflicting fields.

    With ``name``, one of the fields, also ``aliases``: the spelling variants of the first name (none without a name).
    Group and source members are rows of ``members``; they have no size bound, so no array holds them.
    """
    merged = first_value(records, entity, fields, order)
    if name is not None:
        merged = merged.withColumn("aliases", tx.aliases_for(name))
    sizes = records.groupBy(entity, *group).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.groupBy(entity).agg(F.count(F.lit(1)).alias("n_groups"), F.sum("_n").alias("n_sources"))
    clash = field_values(records, entity, keys, order).groupBy(entity, "field").agg(F.count(F.lit(1)).alias("_v"))
    clash = clash.groupBy(entity).agg(F.count_if(F.col("_v") > 1).alias("n_conflicts"))
    zero = F.lit(0).cast("bigint")
    return merged.join(sizes, entity).join(clash, entity, "left").withColumn("n_conflicts", F.coalesce("n_conflicts", zero))


def members(records: DataFrame, entity: str, group: list[str]) -> DataFrame:
    """Distinct (entity, group...) rows: the majors of a course, the files of an entity."""
    return records.select(entity, *group).distinct()


def ordered_sources(records: DataFrame, entity: str, group: list[str], order: list[str]) -> DataFrame:
    """Distinct (entity, group...) rows with their ``position`` from 1, by the first record of each in ``order``."""
    first = records.groupBy(entity, *group).agg(F.min(F.struct(*order)).alias("_first"))
    keys = [F.col(f"_first.{c}") for c in order]
    placed = ranked(first, [entity], keys, F.struct(*keys[:2]), "position")
    return placed.select(entity, *group, F.col("position").cast("bigint").alias("position"))


def group_summary(rows: DataFrame, group: str, code: str = "code", method: str = "exam_method") -> DataFrame:
    """Per group: parsed rows, distinct codes, distinct codes examined by practice."""
    per_code = rows.groupBy(group, code).agg(
        F.count(F.lit(1)).alias("_n"), F.bool_or(F.col(method) == PRACTICE).alias("practice")
    )
    return per_code.groupBy(group).agg(
        F.sum("_n").alias("parsed_rows"), F.count(F.lit(1)).alias("n_codes"), F.count_if("practice").alias("n_practice")
    )


def name_index(catalog: DataFrame) -> DataFrame:
    """Comparison keys of the catalogue: (key, code, name, tier, matched_by); a name match beats an alias match."""
    entries = catalog.filter(F.col("name").isNotNull()).select(
        "code", "name", "tier",
        F.inline(
            F.concat(
                F.array(F.struct(F.lit("name").alias("matched_by"), F.col("name").alias("spelling"))),
                F.transform(tx.aliases_for("name"), lambda a: F.struct(F.lit("alias").alias("matched_by"), a.alias("spelling"))),
            )
        ),
    )
    keyed = entries.withColumn("key", tx.name_key("spelling"))
    # "name" sorts after "alias"
    return keyed.groupBy("key", "code").agg(
        F.min("name").alias("name"), F.min("tier").alias("tier"), F.max("matched_by").alias("matched_by")
    )


def resolve(queries: DataFrame, catalog: DataFrame, digits: str = tx.FIVE_DIGITS) -> DataFrame:
    """Batch lookup ``queries(query_id, query)`` in ``catalog(code, name, tier)``.

    An exact code (five digits unless ``digits`` says otherwise), else name or alias by comparison key; several hits are narrowed to the best
    tier, and several of those stay ambiguous.  The catalogue is reduced to one row per key before the join,
    so a name shared by many codes never multiplies queries by codes; ``resolve_candidates`` lists the codes
    of an ambiguous key once.
    """
    raw = tx.strip_ws(F.coalesce("query", F.lit("")))
    q = queries.select("query_id", raw.alias("_raw")).withColumn("_is_code", tx.matches_code("_raw", digits=digits))
    by_code = catalog.groupBy(F.col("code").alias("_raw")).agg(F.min("name").alias("name"))
    coded = q.filter("_is_code").join(by_code.withColumn("_hit", F.lit(True)), "_raw", "left").select(
        "query_id",
        F.when(F.col("_hit"), F.lit("resolved")).otherwise(F.lit("not_found")).alias("status"),
        F.when(F.col("_hit"), F.col("_raw")).alias("code"),
        "name",
        F.when(F.col("_hit"), F.lit("code")).alias("matched_by"),
        F.when(F.col("_hit"), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("n_candidates"),
    )
    tiers = name_index(catalog).groupBy("key", "tier").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("code", "name", "matched_by")).alias("first")
    )
    best = tiers.groupBy("key").agg(F.min_by(F.struct("n", "first"), "tier").alias("b"))
    named = q.filter(~F.col("_is_code")).withColumn("key", tx.name_key("_raw")).join(best, "key", "left")
    single = F.col("b.n") == 1
    named = named.select(
        "query_id",
        F.when(F.col("b").isNull(), F.lit("not_found")).when(single, F.lit("resolved")).otherwise(F.lit("ambiguous")).alias("status"),
        F.when(single, F.col("b.first.code")).alias("code"),
        F.when(single, F.col("b.first.name")).alias("name"),
        F.when(single, F.col("b.first.matched_by")).alias("matched_by"),
        F.coalesce(F.col("b.n"), F.lit(0).cast("bigint")).alias("n_candidates"),
    )
    return coded.unionByName(named)


def resolve_candidates(catalog: DataFrame) -> DataFrame:
    """All candidates of every ambiguous key at its best tier: (key, code, name, matched_by)."""
    index = name_index(catalog)
    per_tier = index.groupBy("key", "tier").agg(F.count(F.lit(1)).alias("_n"))
    best = per_tier.groupBy("key").agg(F.min_by(F.struct("tier", "_n"), "tier").alias("b")).filter(F.col("b._n") > 1)
    return index.join(best.select("key", "b.tier"), ["key", "tier"], "left_semi").select("key", "code", "name", "matched_by")


def referential_check(children: DataFrame, parents: DataFrame, groups: DataFrame) -> DataFrame:
    """Findings: codes of a group missing in the catalogue, codes repeated in a group, groups without codes.

    ``children(grp, code)``, ``parents(code)``, ``groups(grp)``.
    """
    counts = children.groupBy("grp", "code").agg(F.count(F.lit(1)).alias("n"))
    unknown = counts.join(parents.select("code").distinct(), "code", "left_anti")
    empty = groups.select("grp").distinct().join(counts.select("grp").distinct(), "grp", "left_anti")
    return (
        as_findings(unknown, "catalog", "code_unknown", F.col("grp"), F.col("code"))
        .unionByName(as_findings(counts.filter(F.col("n") > 1), "catalog", "code_repeated", F.col("grp"), F.col("code")))
        .unionByName(as_findings(empty, "catalog", "group_empty", F.col("grp"), ""))
    )


def locator_check(citations: DataFrame, lines: DataFrame, key: str, digits: str = tx.FIVE_DIGITS) -> DataFrame:
    """Citations (cite_id, key, line_no, code, pair_code nullable) whose line is out of range or lacks a code.

    A single citation asks the line to contain the code; a pair asks for both as standalone codes.
    """
    joined = citations.join(lines.select(key, "line_no", F.col("text").alias("_text")), [key, "line_no"], "left")
    standalone = F.regexp_extract_all("_text", F.lit(CODE_TOKEN.replace(tx.FIVE_DIGITS, digits)), F.lit(0))
    single = F.col("_text").contains(F.col("code"))
    pair = F.array_contains(standalone, F.col("code")) & F.array_contains(standalone, F.col("pair_code"))
    holds = F.when(F.col("pair_code").isNull(), single).otherwise(pair)
    problem = F.when(F.col("_text").isNull(), F.lit("out_of_range")).when(~holds, F.lit("code_absent"))
    return joined.withColumn("problem", problem).filter(F.col("problem").isNotNull()).select("cite_id", key, "line_no", "problem")


def supersession(pages: DataFrame, mapping: DataFrame, code: str) -> DataFrame:
    """Pages split into current and archived by an old -> new code map; archived ones carry their target."""
    targets = mapping.select(F.col("old_code").alias(code), F.col("new_code").alias("target"))
    return pages.join(targets, code, "left").withColumn(
        "state", F.when(F.col("target").isNull(), F.lit("current")).otherwise(F.lit("archived"))
    )
