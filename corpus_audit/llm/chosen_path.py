"""Near-duplicates by a Chosen Path set similarity join.

A tree starts with one node that holds all sets.  A node draws, from a hash of its path, one or two random orders of all
tokens (1 / similarity on average, as in a branching process that neither dies out nor explodes for sets at the wanted
similarity); the token that comes first in an order among a set's own is the set's minwise token there, and the sets with
the same one form a child.  Two sets of similarity s go to the same child of an order with probability s.  Nodes with few
pairs left to decide are compared exhaustively; the others go down again.  Independent trees are repeated until the wanted
recall is reached: a pair of just the wanted similarity stays together over ``LEVELS`` levels of a tree with probability
at least similarity ** LEVELS.

All trees go down together, a written table of (path, set) per step, so a lost executor costs one step.  Equal sets are one
set.  Each step first compares every set with the nearest centre of its nodes; sets whose links lead to the same centre are
one group, and only pairs between groups are left to decide, so many near copies are settled by their centres, the others
by a spanning forest of the node's pairs, and never expanded to pairs.  The links of all steps make the components in the end.  A pair is dropped without its texts when sizes or the parities of hash classes prove too many
differences; every other pair is verified on the full sets.
"""

from __future__ import annotations

from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_audit.llm.common import keyed_texts, sliced, stash, text_bytes
from corpus_audit.llm.jaccard import MEMBERS, Shingler, _Links, _mixed, _node, parity_of, stars, undecided

#: levels that the recall is reckoned over, levels of a later step
LEVELS, STEP = 3, 2
#: a node is small with so many pairs left to decide (and ``MEMBERS`` sets): what one task compares at once
SMALL = 1 << 21
_P, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def trees_for(recall: float, share: int, levels: int = LEVELS) -> int:
    """Independent trees after which a pair of similarity ``share`` / 100 has met with probability ``recall``."""
    return max(1, ceil(log(1 - recall) / log(1 - (share / 100) ** levels))) if share < 100 else 1


class Chooser:
    """The children that a set goes to from the nodes (paths) it is in."""

    def __init__(self, share: int):
        self.second = np.uint64(min(2**64 - 1, int((100 / share - 1) * 2**64)))

    def orders(self, paths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every order that the paths draw: the place of its path, its number, and the seed it is made of."""
        two = _mixed(paths * _P + _B) < self.second
        at = np.concatenate([np.arange(len(paths)), np.flatnonzero(two)])
        number = np.concatenate([np.zeros(len(paths), np.uint64), np.ones(int(two.sum()), np.uint64)])
        return at, number, _mixed(paths[at] * _A + number * _P + np.uint64(1))

    def down(self, elements: np.ndarray, paths: np.ndarray) -> np.ndarray:
        """Child paths, one for each order of each path."""
        at, number, seed = self.orders(paths)
        factor = _mixed(seed + _A) | np.uint64(1)
        first = np.full(len(at), np.uint64(2**64 - 1))
        block = max(1, 1_000_000 // max(1, len(at)))
        for start in range(0, len(elements), block):
            own = (elements[None, start : start + block] ^ seed[:, None]) * factor[:, None]
            np.minimum(first, own.min(1), out=first)
        return _mixed(paths[at] * _P + _mixed(first + number) * _A)


def roots(trees: int) -> np.ndarray:
    return _mixed(np.arange(1, trees + 1, dtype=np.uint64) * _P)


def described(docs: DataFrame, words: int, share: int, trees: int) -> DataFrame:
    """doc_id, text_hash, n (set size), node (hash of the set, null when empty), parity, paths (first level of all trees)."""
    rows = keyed_texts(docs).withColumn("text_hash", F.xxhash64("text"))

    def run(batches):
        shingles, choose, start = Shingler(words), Chooser(share), roots(trees)
        for batch in sliced(batches):
            sets = [shingles(t) for t in text_bytes(batch.column(1))]
            paths = [choose.down(s, start).view(np.int64) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([parity_of(s) for s in sets], pa.list_(pa.int64())),
                    pa.array(paths, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n", "node", "parity", "paths"],
            )

    return rows.mapInArrow(run, "doc_id long, text_hash long, n long, node long, parity array<long>, paths array<long>")


def _deeper(members: DataFrame, texts: DataFrame, words: int, share: int) -> DataFrame:
    """(path, node, n) some levels below: the children of ``members``, reckoned once for each set and all its nodes."""
    rows = members.groupBy("node", "n").agg(F.collect_list("path").alias("paths"))  # a set is in a few nodes of each tree
    rows = rows.join(texts, "node").select("node", "n", "paths", "text")

    def run(batches):
        import zstandard

        press, shingles, choose = zstandard.ZstdDecompressor(), Shingler(words), Chooser(share)
        for batch in sliced(batches):
            node, n, out = [], [], []
            for k, text in enumerate(batch.column(3).to_pylist()):
                elements = shingles(press.decompress(text))
                paths = np.array(batch.column(2)[k].as_py(), np.int64).view(np.uint64)
                for _ in range(STEP):
                    paths = choose.down(elements, paths)
                node += [batch.column(0)[k].as_py()] * len(paths)
                n += [batch.column(1)[k].as_py()] * len(paths)
                out.append(paths.view(np.int64))
            path = np.concatenate(out) if out else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(node, pa.int64()), pa.array(n, pa.int64())], ["path", "node", "n"])

    return rows.mapInArrow(run, "path long, node long, n long")


def _shared(members: DataFrame) -> DataFrame:
    """Members of nodes that hold more than one set."""
    more = members.groupBy("path").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("path")
    return members.join(more, "path", "left_semi")


def linked_nodes(docs: DataFrame, nodes: DataFrame, words: int, share: int) -> DataFrame:
    """(node, component) of every set that has a link."""
    links = _Links(docs, nodes, words, share)
    members = stash(_shared(nodes.select(F.explode("paths").alias("path"), "node", "n")), "members")
    while not members.isEmpty():
        before = links.known(members) if links.near else members.withColumn("component", F.col("node"))
        links.nearest(stars(before, "path", share))
        left = links.known(members)
        left = stash(left.join(undecided(left, "path"), "path"), "undecided")
        few = (F.col("pairs") <= SMALL) & (F.col("m") <= MEMBERS)
        links.settle(left.where(few), "path")
        large = stash(left.where(~few).select("path", "node", "n"), "large")
        if large.isEmpty():
            break
        links.fetch(large.select("node").distinct())
        members = stash(_shared(_deeper(large, links.texts, words, share)), "members")
    if not links.near:
        return nodes.limit(0).select("node", F.col("node").alias("component"))
    return links.components()


def near_duplicates(docs: DataFrame, words: int = 5, share: int = 85, recall: float = 0.9999) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for every row of ``docs``.

    Two rows link when 100 * |common shingles| >= share * |all shingles|, confirmed on the full sets; ``recall`` is the
    probability with which two sets of just that similarity meet.  ``component_id`` is the smallest doc_id that links
    lead to, the row's own included, and ``kept`` says that it is the row's own.  A text with fewer words than a shingle
    is one shingle; null and empty texts and those without words have none and are linked with nothing.  Rows with the
    same words are linked whether or not their ids repeat (each row of a kept id is kept); a null id is never the
    smallest but where no row of the component has one.  Other columns are not read; an empty table gives no row.
    """
    rows = stash(described(docs, words, share, trees_for(recall, share)), "described")
    first = F.min_by(F.struct("doc_id", "text_hash"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    nodes = stash(
        rows.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(first.alias("f"), *[F.first(c).alias(c) for c in ("n", "parity", "paths")])
        .select("node", "f.doc_id", "f.text_hash", "n", "parity", "paths"),
        "nodes",
    )
    labels = linked_nodes(docs, nodes, words, share)
    known = nodes.select("node", "doc_id").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = known.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    names = stash(known.join(smallest, "component").select("node", "component_id"), "names")
    out = rows.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "node").join(names, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "text_hash", "n_shingles", own.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
