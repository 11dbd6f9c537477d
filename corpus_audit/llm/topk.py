"""Exact top-k by inner product with a pivot table.

Inner products become distances: with M the longest vector and every candidate c lengthened by one component
sqrt(M^2 - |c|^2), |q - c|^2 = |q|^2 + M^2 - 2 <q, c>, so the largest product is the nearest candidate.  The distances
of all candidates to the pivots are computed once and written with them.  For a query, the maximum over pivots of
|d(q, p) - d(c, p)| is a lower bound of d(q, c).

Candidates and queries meet in bounded blocks.  In a block the candidates are sorted by their nearest pivot and cut into
runs; a run's bound, from the least and largest distance of its candidates to every pivot, holds for each of them.  Runs are
evaluated in the order of their bounds, each only for the queries whose k-th best product the bound can still reach, ties
included.  A query meets one block of its own first; the k-th best product found there is its threshold in all others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_audit.llm.common import stash

#: pivots, candidates and queries of a block, candidates of a run, queries that are evaluated at once
PIVOTS, BLOCK_ROWS, BLOCK_QUERIES, RUN, CHUNK = 24, 8192, 1024, 512, 256

HITS = "query_id long, vec_id long, score long"
_HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_NONE = -(2**63)


def scaled_vectors(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """vec_id, v (array of long): floor(scale * x) of each component x as double.

    A row takes no part when its id or vector is null, or a component is null or not finite.  Empty vectors stay.
    """
    value = F.col(vector).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & value.isNotNull() & finite)
    return rows.select(F.col(key).cast("long").alias("vec_id"), F.transform(value, lambda x: F.floor(x * scale)).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products a @ b.T: in double where no sum can leave its exact range, else in Python's integers."""
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if most * most * max(1, a.shape[1]) < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    wide = a.astype(object) @ b.astype(object).T
    return wide.astype(np.int64)  # raises where a product does not fit a long


def _pivot_distances(points: np.ndarray, norms: np.ndarray, extra: np.ndarray, pivots, pivot_norms, pivot_extra):
    squared = norms[:, None] + pivot_norms[None, :] - 2.0 * (points @ pivots.T) - 2.0 * extra[:, None] * pivot_extra[None, :]
    squared += (extra**2)[:, None] + (pivot_extra**2)[None, :]
    return np.sqrt(np.maximum(squared, 0.0))


def slotted(rows: DataFrame) -> DataFrame:
    """``rows`` with a hash of their place in the table as ``slot``: equal rows and dense ids spread alike.  Write it before use."""
    return rows.withColumn("slot", F.xxhash64(F.monotonically_increasing_id()))


class _Pivots:
    """The pivots of a number of components, and distances to them."""

    def __init__(self, vectors: list, dim: int, longest: float):
        self.points = np.array(vectors, dtype=np.float64).reshape(len(vectors), dim)
        self.longest, self.norms = longest, (self.points**2).sum(1)
        self.extra = np.sqrt(np.maximum(longest - self.norms, 0.0))

    def distances(self, points: np.ndarray, candidates: bool) -> np.ndarray:
        norms = (points**2).sum(1)
        extra = np.sqrt(np.maximum(self.longest - norms, 0.0)) if candidates else np.zeros(len(points))
        return _pivot_distances(points, norms, extra, self.points, self.norms, self.extra)


def _searched(pivots: dict[int, _Pivots], k: int):
    """The k best candidates of a block for each query, as far as they reach its threshold."""

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if block.num_rows and asked.num_rows:
            block, asked = block.combine_chunks(), asked.combine_chunks()
            dim = asked.column("dim")[0].as_py()
            own = pivots[dim]
            table = _table(block.column("far").combine_chunks(), len(own.points))
            near = table.argmin(1) if table.shape[1] else np.zeros(len(table), int)
            order = np.lexsort((table[np.arange(len(table)), near] if table.shape[1] else near, near))
            ids = block.column("vec_id").to_numpy().astype(np.int64)[order]
            points, table = _matrix(block.column("v").combine_chunks(), dim)[order], table[order]
            starts = np.arange(0, len(ids), RUN)
            low, high = np.minimum.reduceat(table, starts), np.maximum.reduceat(table, starts)
            queries = _matrix(asked.column("v").combine_chunks(), dim)
            names = asked.column("vec_id").to_numpy().astype(np.int64)
            floors = asked.column("floor").fill_null(_NONE).to_numpy().astype(np.int64)
            for at in range(0, len(names), CHUNK):
                part = slice(at, at + CHUNK)
                found.append(_chunk(ids, points, starts, low, high, names[part], queries[part], floors[part], own, k))
        columns = [np.concatenate([f[c] for f in found]) if found else np.empty(0, np.int64) for c in range(3)]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_HITS)

    return run


def _table(column: pa.Array, pivots: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), pivots)


def _chunk(ids, points, starts, low, high, names, queries, floors, own: _Pivots, k: int):
    wide = queries.astype(np.float64)
    norms, far = (wide**2).sum(1), own.distances(wide, False)[:, None, :]
    gap = np.maximum(np.maximum(low[None] - far, far - high[None]), 0.0).max(2, initial=0.0)
    # the largest product a candidate of the run can have; the slack covers the rounding of the distances
    scale = (norms + own.longest)[:, None]
    most = (scale - gap**2) / 2 + 1e-6 * scale + 0.5
    least = floors.copy()
    best = np.full((len(names), k), _NONE, np.int64)
    ends = np.append(starts[1:], len(ids))
    out = [[], [], []]
    for r in np.argsort(gap.mean(0), kind="stable"):
        alive = np.flatnonzero(most[:, r] >= least)
        if not len(alive):
            continue
        cut = slice(starts[r], ends[r])
        scores = _exact(queries[alive], points[cut])
        hit = (scores >= least[alive][:, None]) & (ids[cut][None, :] != names[alive][:, None])
        row, column = np.nonzero(hit)
        if not len(row):
            continue
        for kept, value in zip(out, (alive[row], ids[cut][column], scores[row, column])):
            kept.append(value)
        with_hits = np.unique(row)
        merged = np.concatenate([best[alive[with_hits]], np.where(hit, scores, _NONE)[with_hits]], 1)
        best[alive[with_hits]] = np.partition(merged, merged.shape[1] - k, axis=1)[:, -k:]
        least[alive[with_hits]] = np.maximum(floors[alive[with_hits]], best[alive[with_hits]].min(1))
    place, vec, score = (np.concatenate(x) if x else np.empty(0, np.int64) for x in out)
    kept = np.flatnonzero(score >= least[place])
    kept = kept[np.lexsort((vec[kept], -score[kept], place[kept]))]
    place, vec, score = place[kept], vec[kept], score[kept]
    turn = np.arange(len(place)) - np.searchsorted(place, place)
    return names[place[turn < k]], vec[turn < k], score[turn < k]


def top_k(
    vectors: DataFrame,
    is_query,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
    pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest integer inner products of each query, all if fewer.

    ``is_query`` is a condition on vec_id.  Candidates are all rows with another id and the query's number of
    components; ties go to the smaller vec_id.  An id that repeats is one query (its smallest vector), but each of
    its rows is a candidate.  Rows with a null id or vector, or with a null or non-finite component, take no part; other
    columns are not read.  An empty table or no query gives no row.  Queries and candidates meet block by block.
    """
    rows = stash(slotted(scaled_vectors(vectors, key, vector, scale)).withColumn("dim", F.size("v").cast("int")), "vectors")
    square = F.aggregate(F.transform("v", lambda x: x.cast("double") * x), F.lit(0.0), lambda a, x: a + x)
    sizes = rows.groupBy("dim").agg(F.max(square).alias("longest"), F.count(F.lit(1)).alias("n"), F.count_if(is_query(F.col("vec_id"))).alias("q"))
    sizes = {r.dim: r for r in sizes.collect() if r.q}
    # the pivots of a dimension: the rows whose ids hash lowest, few and of a fixed number
    lowest = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "vec_id", "v")
    chosen = rows.withColumn("_n", F.row_number().over(lowest)).where(F.col("_n") <= pivots).select("dim", "v").collect()
    frames = {d: _Pivots([r.v for r in chosen if r.dim == d], d, float(s.longest)) for d, s in sizes.items()}

    def measured(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                if int(dim) not in frames:
                    continue
                part = batch.filter(pa.array(dims == dim))
                far = frames[int(dim)].distances(_matrix(part.column("v"), int(dim)).astype(np.float64), True)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(far), pa.list_(pa.float64()))], [*part.schema.names, "far"])

    candidates = stash(rows.mapInArrow(measured, "vec_id long, v array<long>, slot long, dim int, far array<double>"), "candidates")
    lanes = max((s.n for s in sizes.values()), default=0) // block_rows + 1
    parts = max((s.q for s in sizes.values()), default=0) // BLOCK_QUERIES + 1
    numbers = lambda n: F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>")
    asked = rows.where(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min_by("v", "v").alias("v")).withColumn("dim", F.size("v").cast("int"))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts))).withColumn("home", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(lanes)))
    block = candidates.withColumn("lane", F.pmod("slot", F.lit(lanes))).withColumn("part", F.explode(numbers(parts)))
    ranking = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda hits: hits.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= k)
    keys = ["dim", "part", "lane"]

    def met(queries: DataFrame) -> DataFrame:
        return block.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(_searched(frames, k), HITS)

    near = stash(ranked(met(asked.withColumn("lane", F.col("home")).withColumn("floor", F.lit(None).cast("long")))), "near")
    if lanes > 1:
        floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        others = asked.join(floors, "vec_id", "left").withColumn("lane", F.explode(F.array_remove(numbers(lanes), F.col("home"))))
        near = ranked(near.drop("rank").unionByName(met(others)))
    return near.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
