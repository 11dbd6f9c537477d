"""Canonical outputs with a tree of digests: two outputs are compared by their trees, and only ranges that differ are read.

A row belongs to a leaf by the first bits of its key's hash.  A leaf's digest is a mergeable sum over its rows, so it
does not depend on how they were partitioned or ordered, and equal rows count; a parent's digest is the hash of those of
its sixteen children.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_audit.sources.files import canonical_rows

#: hex digits of a leaf's name: 16 ** DEPTH leaves, which bounds the tree and the list of leaves that differ
DEPTH = 3


def _leaf(keys: list[str], depth: int) -> Column:
    return F.substring(F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256), 1, depth)


def digest_tree(rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(level, node, n, digest) for canonical ``rows`` (leaf, json): the leaves at level ``depth``, the root at level 0."""
    digest = F.sha2("json", 256)
    parts = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(8)]
    sums = rows.groupBy(F.col("leaf").alias("node")).agg(
        F.count(F.lit(1)).alias("n"), F.concat_ws(",", *[F.sum(p).cast("string") for p in parts]).alias("s")
    )
    levels = [sums.select(F.lit(depth).alias("level"), "node", "n", F.sha2(F.concat_ws(":", F.col("n").cast("string"), "s"), 256).alias("digest"))]
    for level in range(depth - 1, -1, -1):
        children = levels[-1].groupBy(F.substring("node", 1, level).alias("node"))
        joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("node", "digest"))), lambda c: F.concat(c.node, c.digest)), ",")
        levels.append(children.agg(F.sum("n").alias("n"), F.sha2(joined, 256).alias("digest")).select(F.lit(level).alias("level"), "node", "n", "digest"))
    return reduce(DataFrame.unionByName, levels)


def write_digested(df: DataFrame, keys: list[str], path: str, depth: int = DEPTH) -> None:
    """Write ``df`` as canonical JSON rows, a folder per leaf sorted by ``keys``, and the tree beside them.

    Equal tables give equal rows, files of equal content and equal trees whatever their partitioning.
    """
    rows = canonical_rows(df, keys).withColumn("leaf", _leaf(keys, depth))
    ordered = rows.repartition("leaf").sortWithinPartitions("leaf", *keys, "json")
    ordered.write.mode("overwrite").partitionBy("leaf").parquet(f"{path}/rows")
    written = df.sparkSession.read.schema(ordered.schema).parquet(f"{path}/rows")
    digest_tree(written.select("leaf", "json"), depth).write.mode("overwrite").parquet(f"{path}/tree")


def read_tree_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("level int, node string, n bigint, digest string").parquet(f"{path}/tree")


def root_digest(spark: SparkSession, path: str) -> str | None:
    """The digest of the whole output; null for an empty one."""
    row = read_tree_of(spark, path).where("level = 0").select("digest").first()
    return None if row is None else row.digest


def differing_leaves(spark: SparkSession, left: str, right: str, depth: int = DEPTH) -> list[str]:
    """Names of the leaves that differ, from the root down; equal roots end it at once.  At most 16 ** ``depth`` names."""
    side = lambda p, c: read_tree_of(spark, p).select("level", "node", F.col("digest").alias(c))
    both = side(left, "l").join(side(right, "r"), ["level", "node"], "full").where(~F.col("l").eqNullSafe(F.col("r")))
    if both.where("level = 0").isEmpty():
        return []
    return sorted(r.node for r in both.where(F.col("level") == depth).select("node").collect())


def output_difference(spark: SparkSession, left: str, right: str, keys: list[str], schema: str, depth: int = DEPTH) -> DataFrame:
    """(keys, problem, left, right) of two outputs of ``write_digested``: only_left, only_right or differs.

    Only the folders of differing leaves are read.  ``schema`` is the DDL of the keys; a key that repeats is compared as its
    sorted rows.
    """
    leaves = differing_leaves(spark, left, right, depth)

    def side(path: str, name: str) -> DataFrame:
        rows = spark.read.schema(f"{schema}, json string, leaf string").parquet(f"{path}/rows").where(F.col("leaf").isin(leaves))
        return rows.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list("json")), "\n").alias(name))

    a, b = side(left, "left"), side(right, "right")
    same = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])
    joined = a.join(b, same, "full").where(~F.col("left").eqNullSafe(F.col("right")))
    problem = F.when(F.col("right").isNull(), F.lit("only_left")).when(F.col("left").isNull(), F.lit("only_right")).otherwise(F.lit("differs"))
    return joined.select(*[F.coalesce(a[k], b[k]).alias(k) for k in keys], problem.alias("problem"), "left", "right")
