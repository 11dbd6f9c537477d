"""Plan helpers that keep hot keys and small sides safe at cluster size.

* ``ranked`` / ``neighbors`` replace a plain window over a key whose group has no size bound: rows are
  windowed inside (key, block) slices, and only one summary row per slice travels to the key's partition.
* ``dealt`` shuffles by keys into as many partitions as the input's size asks for, so that the sorts of one task
  stay of one size however large the tables are.
* ``broadcast_if_small`` broadcasts a side only when the optimizer's own size estimate, multiplied by a
  stated growth factor, stays under a limit.  Otherwise Spark's adaptive join picks the strategy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the plan (file sizes at the leaves); no job is run."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_if_small(
    df: DataFrame, base: DataFrame | None = None, growth: int = 1, limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Broadcast ``df`` when ``estimate(base or df) * growth <= limit``; otherwise leave the choice to AQE.

    ``base`` is the table ``df`` was exploded from, ``growth`` the largest factor by which the explosion
    can enlarge it.
    """
    if estimated_bytes(base if base is not None else df) * growth <= limit:
        return F.broadcast(df)
    return df


#: bytes of input files behind one partition of a shuffle that is sorted (files are several times smaller than rows)
PARTITION_BYTES = 8 * 1024 * 1024


def leaf_bytes(df: DataFrame) -> int:
    """Catalyst's size of all scans of the plan (joins multiply the estimate of the whole plan); no job is run.

    Leaves of unknown size, which Catalyst takes for as large as can be, are left out.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < 1 << 62)


def dealt(df: DataFrame, *keys: str, size: int | None = None) -> DataFrame:
    """Shuffle by ``keys`` into partitions for ``size`` bytes of input files (default: all that ``df`` scans)."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-(leaf_bytes(df) if size is None else size) // PARTITION_BYTES)), *keys)


def ranked(df: DataFrame, keys: list[str], order: list[Column], block: Column, name: str) -> DataFrame:
    """``row_number`` per key in two levels.

    ``block`` must never decrease along ``order``.  The large shuffle is by (keys, block), so a key that
    holds a third of the table is spread over all its blocks; the per-key window sees one row per block.
    """
    slots = [*keys, "_block"]
    sliced = df.withColumn("_block", block)
    counts = sliced.groupBy(*slots).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*slots, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = dealt(sliced, *slots).withColumn("_local", F.row_number().over(Window.partitionBy(*slots).orderBy(*order)))
    return (
        local.join(offsets, slots)
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_block", "_local", "_offset")
    )


def neighbors(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    payload: list[str],
    block: Column,
    previous: str | None = None,
    following: str | None = None,
) -> DataFrame:
    """Previous / following row's ``payload`` (a struct) per key, in two levels like ``ranked``."""
    sliced = df.withColumn("_block", block).withColumn("_load", F.struct(*payload))
    slots = [*keys, "_block"]
    sort_key = F.struct(*order)
    edges = sliced.groupBy(*slots).agg(
        F.min_by("_load", sort_key).alias("_head"), F.max_by("_load", sort_key).alias("_tail")
    )
    across = Window.partitionBy(*keys).orderBy("_block")
    edges = edges.select(
        *slots,
        F.lag("_tail").over(across).alias("_before"),
        F.lead("_head").over(across).alias("_after"),
    )
    inside = Window.partitionBy(*slots).orderBy(*order)
    out = sliced.withColumn("_lag", F.lag("_load").over(inside)).withColumn("_lead", F.lead("_load").over(inside))
    out = out.join(edges, slots)
    if previous:
        out = out.withColumn(previous, F.coalesce("_lag", "_before"))
    if following:
        out = out.withColumn(following, F.coalesce("_lead", "_after"))
    return out.drop("_block", "_load", "_before", "_after", "_lag", "_lead")


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a scan that has fewer splits than the cluster has cores (few or unsplittable files).

    Only for scans and projections of scans: the split count is then known from file listing alone.  A large
    table has more splits than cores and passes through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
