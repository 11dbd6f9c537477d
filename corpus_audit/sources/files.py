"""Readers and writers: document trees, JSON artefacts, manifests, digests, canonical output."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_audit.findings import as_findings
from corpus_audit.functions import text as tx

# Excluded file names, manifest columns, folder policies, pointer format.
EXCLUDED_NAMES = ["plan.extracted.md", "plan.pipeline-notes.md"]
MANIFEST_COLUMNS = [
    "type", "source_pdf", "raw_xml", "raw_txt", "raw_view_html", "extracted_md", "source_sha256", "extraction_policy",
]
METADATA_ONLY_TYPES = ["textbooks", "past-papers"]
POINTER = r"\Aversion https://git-lfs\.github\.com/spec/v1\noid sha256:([0-9a-f]{64})\nsize \d+\n?\z"


def read_tree(spark: SparkSession, root: str, glob: str = "*.md", exclude: list[str] | None = None) -> DataFrame:
    """(path, name, text) of every matching file below ``root``; one row per file, whole text."""
    drop = EXCLUDED_NAMES if exclude is None else exclude
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    path = F.col("_metadata.file_path")
    name = F.col("_metadata.file_name")
    prefix = F.lit(rf"^(?:file:/*)?/*{root.strip('/')}/")
    return files.select(
        F.regexp_replace(path, prefix, F.lit("")).alias("path"), name.alias("name"), F.col("value").alias("text")
    ).filter(~F.col("name").isin(drop))


def write_tree(docs: DataFrame, folder: str) -> int:
    """One file in ``folder`` for each row of ``docs(name, text)``, text and a newline as UTF-8; how many there are.

    Tasks write through ``pyarrow.fs``; a file gets its name when it is whole, so a second attempt leaves the same files.
    Names do not repeat.  Spark's own writer asks several processes of the system for each file, and the driver renames them.
    """
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)

    def run(batches):
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = f"{path}/_{uuid.uuid4().hex}"
                with store.open_output_stream(part) as f:
                    f.write(data)
                store.move(part, f"{path}/{name}")
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], ["n"])

    data = F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).cast("binary")
    done = docs.select("name", data.alias("data")).mapInArrow(run, "n long")
    return done.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n


def read_artifacts(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Typed rows of one-object-per-file JSON, and findings for files that are no JSON object."""
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )
    return parse_artifacts(raw, "path", "text", schema)


def parse_artifacts(raw: DataFrame, key: str, text: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The same over a text column: (key, doc.*) for JSON objects, findings for all other rows."""
    kind = F.try_parse_json(F.col(text))
    is_object = F.coalesce(F.schema_of_variant(kind).startswith("OBJECT"), F.lit(False))
    tagged = raw.select(key, F.col(text).alias("_text"), is_object.alias("_object"), kind.isNull().alias("_broken"))
    good = tagged.filter("_object").select(key, F.from_json("_text", schema).alias("doc")).select(key, "doc.*")
    bad = as_findings(
        tagged.filter(~F.col("_object")), "artifact", "json_object", F.col(key),
        F.when(F.col("_broken"), F.lit("undecodable")).otherwise(F.lit("not an object")),
    )
    return good, bad


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Manifest rows with header, byte-order mark removed; findings for missing columns."""
    raw = spark.read.csv(path, header=True, multiLine=True)
    clean = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    missing = [c for c in MANIFEST_COLUMNS if c not in clean.columns]
    absent = spark.range(1).select(F.explode(F.array(*[F.lit(m) for m in missing]).cast("array<string>")).alias("c"))
    findings = as_findings(absent, "manifest", "column_missing", F.lit(path), F.col("c"))
    for name in missing:
        clean = clean.withColumn(name, F.lit(None).cast("string"))
    return clean, findings


def read_lines(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Physical lines (key, line_no from 1, text), split on ``\\n`` only."""
    return docs.select(key, F.posexplode(tx.physical_lines(text)).alias("_p", "text")).select(
        key, (F.col("_p") + 1).alias("line_no"), "text"
    )


def read_display_lines(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Lines by every Unicode boundary; never mix their numbers with ``L<n>`` locators."""
    return docs.select(key, F.posexplode(tx.display_lines(text)).alias("_p", "text")).select(
        key, (F.col("_p") + 1).alias("line_no"), "text"
    )


def declared_digest(content: Column, head: Column) -> Column:
    """Digest of the bytes, or the digest that a large-file pointer declares."""
    pointed = F.regexp_extract(head, POINTER, 1)
    return F.coalesce(F.nullif(pointed, F.lit("")), F.sha2(content, 256))


def file_digest(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, digest) per file; unreadable files are not part of the listing and join as null."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    head = F.when(F.col("length") <= 256, F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.lit(""))).otherwise(F.lit(""))
    return files.select("path", declared_digest(F.col("content"), head).alias("digest"))


def explode_keyed_json(df: DataFrame, key: str, text: str, map_path: str, entry_ddl: str) -> DataFrame:
    """``{map_path: {key -> entry}}`` to rows (key, entry_key, entry.*); missing or corrupt text gives no row."""
    schema = f"struct<{map_path}:map<string,{entry_ddl}>>"
    parsed = F.from_json(F.col(text), schema).getField(map_path)
    return df.select(key, F.explode(parsed).alias("entry_key", "_entry")).select(key, "entry_key", "_entry.*")


def build_manifest(files: DataFrame, rules: list[tuple[str, str]], default: str = "documents") -> DataFrame:
    """One row per source file: type by folder rule, digest, extraction policy.

    ``files(path, digest)``; ``rules`` are (path regex, type), first match wins.
    """
    kind = tx.classify("path", rules, default)
    policy = F.when(kind.isin(METADATA_ONLY_TYPES), F.lit("metadata-only")).otherwise(F.lit("full-text-draft"))
    stem = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    slug = tx.ascii_slug(stem, empty=F.concat(F.lit("document-"), F.substring("digest", 1, 12)))
    out = F.concat_ws("/", F.lit("processed"), kind, slug)
    return files.select(
        kind.alias("type"),
        F.col("path").alias("source_pdf"),
        F.concat(out, F.lit("/document.raw.xml")).alias("raw_xml"),
        F.concat(out, F.lit("/document.raw.txt")).alias("raw_txt"),
        F.concat(out, F.lit("/document.raw.html")).alias("raw_view_html"),
        F.concat(out, F.lit("/document.extracted.md")).alias("extracted_md"),
        F.col("digest").alias("source_sha256"),
        policy.alias("extraction_policy"),
    )


def plan_moves(files: DataFrame, rules: list[tuple[str, str]], default: str, root: str, skip: str) -> DataFrame:
    """Old path to new path: PDFs into a folder by rule and slug, everything else into a processed folder."""
    path = F.col("path")
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    is_pdf = F.lower(name).endswith(".pdf")
    stem = F.regexp_replace(F.lower(F.regexp_replace(name, r"\.[^.]*$", "")), r"\d+[.、_\-]*", "")
    slug = tx.ascii_slug(stem, empty="source")
    folder = F.when(is_pdf, tx.classify(path, rules, default)).otherwise(
        F.when(path.contains("major-plans"), F.lit("processed/major-plans")).otherwise(F.lit("processed/source-records"))
    )
    new = F.when(is_pdf, F.concat_ws("/", F.lit(root), folder, slug, name)).otherwise(F.concat_ws("/", F.lit(root), folder, name))
    return files.filter(~path.rlike(skip)).select(
        path.alias("old_path"),
        new.alias("new_path"),
        F.when(is_pdf, F.lit("official-pdf")).otherwise(F.lit("processed")).alias("kind"),
        F.when(is_pdf, F.lit("public-official")).otherwise(F.lit("derived")).alias("public_status"),
        F.lit("mechanical migration").alias("notes"),
    )


def canonical_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, json): fixed field order, sorted arrays, one JSON text per row."""
    cols = []
    for field in df.schema.fields:
        c = F.col(field.name)
        cols.append((F.array_sort(c) if isinstance(field.dataType, T.ArrayType) else c).alias(field.name))
    body = df.select(*cols)
    return body.select(*keys, F.to_json(F.struct(*[F.col(c) for c in body.columns]), {"ignoreNullFields": "false"}).alias("json"))


def canonical(df: DataFrame, keys: list[str]) -> DataFrame:
    """``canonical_rows`` range-sorted by key."""
    return canonical_rows(df, keys).orderBy(*keys)


def write_canonical(df: DataFrame, keys: list[str], path: str) -> None:
    """Reproducible text output: part files in key order, equal for equal input."""
    canonical(df, keys).select("json").write.mode("overwrite").text(path)
