"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds.

A threshold join finds, for every anchor, the rows whose integer inner product reaches the anchor's threshold.  Anchors and
rows meet in bounded blocks.  In a block the dimensions are ordered by their energy and cut into groups; the index of a row
holds only the groups from the first one on where the norm of the row's dimensions before it, times the longest anchor, can
reach the lowest threshold asked (before that the row cannot be found by those dimensions alone, so they are left out).
Partial scores are accumulated over the indexed groups, last first; after each group a pair stays only while its partial
score plus the product of the norms of what remains reaches the threshold.  What is left is scored exactly.

A window (low, high, need) asks for the ``need`` highest scores within it.  Its threshold starts near the top and is lowered
until the window is filled or its threshold is its low end, so the index is asked for far pairs only where near ones are few.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_audit.llm.common import stash
from corpus_audit.llm.topk import _exact, _matrix

#: rows and anchors of a block, anchors that a task scores at once, groups of dimensions, depths of the thresholds
BLOCK_ROWS, BLOCK_ANCHORS, CHUNK, GROUPS, DEPTHS = 8192, 1024, 256, 8, (0.25, 0.5, 1.0)

_HITS = pa.schema([("anchor_id", pa.int64()), ("w", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
_HITS_SQL = "anchor_id long, w int, vec_id long, score long"


def _prefix_norms(points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Column g: the norm of the components before cut g."""
    total = np.concatenate([np.zeros((len(points), 1)), np.cumsum(points**2, 1)], 1)
    return np.sqrt(total[:, cuts])


def _candidates(rows: np.ndarray, anchors: np.ndarray, floors: np.ndarray) -> np.ndarray:
    """Which (anchor, row) pairs may reach the anchor's threshold: True for every pair that does."""
    order = np.argsort(-(rows**2).sum(0), kind="stable")
    rows, anchors = rows[:, order], anchors[:, order]
    cuts = np.unique(np.linspace(0, rows.shape[1], GROUPS + 1).astype(int))
    row_norms, anchor_norms = _prefix_norms(rows, cuts), _prefix_norms(anchors, cuts)
    # the slack covers the rounding of sums in double
    slack = 1e-9 * (1.0 + row_norms[:, -1].max(initial=0.0) * anchor_norms[:, -1].max(initial=0.0))
    low = floors.min() - slack
    unseen = row_norms * anchor_norms[:, -1].max(initial=0.0) < low
    first = np.maximum(unseen.sum(1) - 1, 0)  # the first indexed group of each row; norms never fall along the groups
    total = np.zeros((len(anchors), len(rows)))
    alive = np.ones(total.shape, bool)
    for g in range(len(cuts) - 2, -1, -1):
        own = np.where((first <= g)[:, None], rows[:, cuts[g] : cuts[g + 1]], 0.0)
        total += anchors[:, cuts[g] : cuts[g + 1]] @ own.T
        left = np.maximum(first, g)
        rest = row_norms[np.arange(len(rows)), left][None, :] * anchor_norms[:, left]
        alive &= total + rest >= (floors - slack)[:, None]
        if not alive.any():
            break
    return alive


def _searched(need: int, same: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The ``need`` highest scores of a block in every window of its anchors, from the window's threshold on."""

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows and asked.num_rows:
            block, asked = block.combine_chunks(), asked.combine_chunks()
            dim = asked.column("dim")[0].as_py()
            ids = block.column("vec_id").to_numpy().astype(np.int64)
            labels = block.column("label").to_numpy()
            points = _matrix(block.column("v").combine_chunks(), dim)
            wide = points.astype(np.float64)
            own_ids, own_labels = asked.column("vec_id").to_pylist(), asked.column("label").to_pylist()
            own = _matrix(asked.column("v").combine_chunks(), dim)
            windows = asked.column("windows").to_pylist()
            floors = np.array([min(x["floor"] for x in w) for w in windows], np.float64)
            for start in range(0, len(own), CHUNK):
                part = slice(start, start + CHUNK)
                alive = _candidates(wide, own[part].astype(np.float64), floors[part])
                for k in range(len(alive)):
                    i = start + k
                    fit = alive[k] & ((labels == own_labels[i]) == same) & (ids != own_ids[i])
                    found = np.flatnonzero(fit)
                    if not len(found):
                        continue
                    scores = _exact(points[found], own[i : i + 1])[:, 0]
                    for w in windows[i]:
                        inside = np.flatnonzero((scores >= w["floor"]) & (scores <= w["high"]))
                        best = inside[np.lexsort((ids[found[inside]], -scores[inside]))[:need]]
                        out += [(own_ids[i], w["w"], int(ids[found[b]]), int(scores[b])) for b in best]
        return pa.Table.from_arrays([pa.array([x[c] for x in out], f.type) for c, f in enumerate(_HITS)], schema=_HITS)

    return run


def fill_windows(rows: DataFrame, n_rows: int, anchors: DataFrame, need: int, same: bool) -> DataFrame:
    """anchor_id, w, vec_id, score, rank: the ``need`` best rows of every window, all that lie in it if fewer.

    ``rows`` (vec_id, label, v, dim, slot); ``anchors`` (vec_id, label, v, dim, w, low, high), one row per window.
    Rows with another label than the anchor, or with ``same`` those with its label, under another id, take part.
    """
    lanes = n_rows // BLOCK_ROWS + 1
    left, done = anchors, []
    for depth in DEPTHS:
        low, high = F.col("low"), F.col("high")
        floor = low if depth == DEPTHS[-1] else high - ((high - low) * F.lit(depth)).cast("long")
        left = stash(left.withColumn("floor", floor), "windows")
        n_anchors = left.select("vec_id").distinct().count()
        if not n_anchors:
            break
        groups = n_anchors // BLOCK_ANCHORS + 1
        window = F.collect_list(F.struct("w", "floor", "high")).alias("windows")  # as many as an anchor has, a small number
        asked = left.groupBy("vec_id", "label", "v", "dim").agg(window)
        asked = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(groups)))
        asked = asked.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)).cast("array<long>")))
        block = rows.withColumn("lane", F.pmod("slot", F.lit(lanes)))
        block = block.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
        keys = ["dim", "part", "lane"]
        met = block.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_searched(need, same), _HITS_SQL)
        best = Window.partitionBy("anchor_id", "w").orderBy(F.desc("score"), "vec_id")
        hits = stash(met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= need), "hits")
        counts = hits.groupBy(F.col("anchor_id").alias("vec_id"), "w").agg(F.count(F.lit(1)).alias("n"))
        state = left.join(counts, ["vec_id", "w"], "left").withColumn("full", (F.coalesce("n", F.lit(0)) >= need) | (F.col("floor") <= low))
        closed = state.where("full").select(F.col("vec_id").alias("anchor_id"), "w")
        done.append(hits.join(closed, ["anchor_id", "w"], "left_semi"))
        left = state.where(~F.col("full")).drop("n", "full", "floor")
    if not done:
        return rows.sparkSession.createDataFrame([], _HITS_SQL + ", rank int")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return stash(out, "filled")


def _floor_percent(value: Column, percent: int) -> Column:
    scaled = value * F.lit(percent)
    return ((scaled - F.pmod(scaled, F.lit(100))) / 100).cast("long")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Callable[[Column], Column],
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are integer inner products of floor(scale * component).  The ``label`` column
    holds integers.  The positives of an anchor are its ``positives``
    best other rows with its label; for each of them the ``negatives`` best rows with another label are returned whose
    score lies within ``low`` and ``high`` percent of the positive's.  Ties go to the smaller id; fewer rows where
    fewer fit, none where the positive's score is negative.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part; only rows with the same
    number of components meet.  An id that repeats is one anchor (its smallest vector, then label) and never its own
    partner, but each of its rows is a partner of others.  Other columns are not read; an empty table gives no row.
    """
    value = F.col(vector).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & value.isNotNull() & finite).select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        F.transform(value, lambda x: F.floor(x * scale)).alias("v"),
        F.size(value).alias("dim"),
        F.xxhash64(F.monotonically_increasing_id()).alias("slot"),
    )
    rows = stash(usable, "vectors")  # written, so that a slot never changes
    square = F.aggregate(F.transform("v", lambda x: x.cast("double") * x), F.lit(0.0), lambda a, x: a + x)
    n_rows, longest = rows.agg(F.count(F.lit(1)), F.coalesce(F.sqrt(F.max(square)), F.lit(0.0))).first()
    first = F.min(F.struct("v", "label", "dim"))
    anchors = rows.where(is_anchor(F.col("vec_id"))).groupBy("vec_id").agg(first.alias("f")).select("vec_id", "f.label", "f.v", "f.dim")
    reach = F.ceil(F.sqrt(square) * F.lit(longest) * (1 + 1e-9)).cast("long") + 1
    near = fill_windows(
        rows, n_rows, anchors.withColumn("w", F.lit(0)).withColumn("low", -reach).withColumn("high", reach), positives, same=True
    )
    near = near.select("anchor_id", F.col("rank").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    bounds = near.select(
        F.col("anchor_id").alias("vec_id"),
        "w",
        (-_floor_percent(-F.col("positive_score"), low)).alias("low"),
        _floor_percent(F.col("positive_score"), high).alias("high"),
    )
    asked = anchors.join(bounds.where(F.col("low") <= F.col("high")), "vec_id")
    far = fill_windows(rows, n_rows, asked, negatives, same=False)
    far = far.select("anchor_id", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = far.join(near, ["anchor_id", "w"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
