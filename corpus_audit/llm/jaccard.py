"""Jaccard join of word shingle sets by PartEnum signatures.

Sets of at least the wanted similarity differ by few elements, at most k = 2r(1-g)/(1+g) when neither has more than r
elements.  Sizes fall into bands [l, l/g]; sets that may link lie in one band or in neighbours, so a set takes part in
the instances of its own band and of the next.  An instance splits the hash domain into n1 = ceil((k+1)/2) partitions of
three parts each: with at most k differences some partition has at most one, so two of its three parts agree.  The
signatures of a set are, for every partition and every two of its parts, a hash of the elements there.  Parts that hold
``SPARSE`` elements at most say little and would be shared by many unlike sets.  There the next partition is looked at:
on a ring of partitions with fewer than two differences each on average, one starts a chain with at most one difference
in itself and at most three together with the next, so of five finer parts of the next at least two agree, and the
signature is made once for every two of those.

Equal sets are one node.  Nodes that share a signature form a bucket; a bucket emits no pairs but a star: its smallest
member against the others.  Each member first meets the centre with which it shares most buckets; members whose links lead
to the same centre are one group, and only buckets that still hold members of different groups go on.  Those with at most
``SMALL`` pairs left are compared inside one task, which emits the pairs that sizes and parities of hash classes (1,024, or
as many as the set has elements) do not rule out.  A bucket with more than ``DENSE`` pairs left first emits a spanning
forest of them, the most similar first: its links make components, and only pairs between those are left, so that near
copies that miss their centre are not expanded to pairs either.  The members of larger ones
are signed again on the second level: fewer partitions, each cut into ``FINER`` parts, of which all but ``SPARED`` agree in
some partition, so that unlike sets part.  A bucket that is still large there is cut into slices, and each two
slices meet in a task of their own; nothing is dropped.  Every pair that is emitted is verified on the sets.

Shingles and sets are identified by 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_audit.llm.common import keyed_texts, sliced, stash, text_bytes, unused
from corpus_audit.llm.components import connected_components
from corpus_audit.scale import broadcast_if_small

MAX_WORDS, CLASSES = 500_000, 1024
#: pairs and members that a bucket may have left to be compared in one task, members of a slice of a larger one
SMALL, MEMBERS, SLICE = 1 << 21, 1 << 16, 512
#: pairs left from which on a bucket gives a spanning forest before its pairs
DENSE = 1024
SPARSE = 1
#: second level: parts of a partition, and how many of them may differ
FINER, SPARED = 8, 3
_ONE, _OTHER = np.array(list(combinations(range(3), 2))).T  # two of three parts
_FIRST, _SECOND = np.array(list(combinations(range(5), 2))).T  # two of five finer parts
_AGREE = np.array(list(combinations(range(FINER), FINER - SPARED)))
_P, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles; the hash of a word is computed once per task."""

    def __init__(self, words: int):
        import xxhash

        self.words, self.digest, self.known = words, xxhash.xxh3_64_intdigest, {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # bytes: A-Z only, and the six ASCII white-space characters
        if not words:
            return np.empty(0, np.uint64)
        known, digest = self.known, self.digest
        if len(known) > MAX_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = digest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.words, len(h))
        total = h[: len(h) - n + 1].copy()
        for k in range(1, n):
            total = total * _P + h[k : len(h) - n + 1 + k]
        return np.unique(_mixed(total + np.uint64(n)))


class PartEnum:
    """Signatures of sets for the similarity ``share`` / 100."""

    def __init__(self, share: int):
        self.share, self.bands = share, [(1, 100 // share)]

    def band(self, size: int) -> int:
        while self.bands[-1][1] < size:
            low = self.bands[-1][1] + 1
            self.bands.append((low, low * 100 // self.share))
        at = len(self.bands) - 1
        while self.bands[at][0] > size:
            at -= 1
        return at

    def partitions(self, instance: int) -> int:
        """First-level partitions of an instance; 0 where only equal sets can link."""
        self.band(self.bands[-1][1] + 1 if instance >= len(self.bands) else 1)
        k = 2 * self.bands[instance][1] * (100 - self.share) // (100 + self.share)
        return (k + 2) // 2 if k else 0

    def __call__(self, elements: np.ndarray) -> np.ndarray:
        own, out = self.band(len(elements)), []
        content = _mixed(elements * _P)
        for instance in (own, own + 1):
            n1 = self.partitions(instance)
            if not n1:
                continue
            where = (elements % np.uint64(3 * n1)).astype(np.int64)
            parts = np.zeros(3 * n1, np.uint64)
            np.add.at(parts, where, content)
            parts = parts.reshape(n1, 3)
            held = np.bincount(where, minlength=3 * n1).reshape(n1, 3)
            code = np.arange(n1, dtype=np.uint64)[:, None] + np.uint64(instance) * np.uint64(1 << 32)
            code = code * np.uint64(4) + np.arange(3, dtype=np.uint64)
            own_parts = _mixed(_mixed(parts[:, _ONE] + _A) * _P + parts[:, _OTHER] + code * _B)
            thin = held[:, _ONE] + held[:, _OTHER] <= SPARSE
            if n1 > 1 and thin.any():
                fifth = (elements // np.uint64(3 * n1) % np.uint64(5)).astype(np.int64)
                finer = np.zeros(5 * n1, np.uint64)
                np.add.at(finer, where // 3 * 5 + fifth, content)
                row, which = np.nonzero(thin)
                following = finer.reshape(n1, 5)[(row + 1) % n1]
                more = _mixed(_mixed(following[:, _FIRST] + _B) * _P + following[:, _SECOND] + np.arange(1, 11, dtype=np.uint64))
                out.append(_mixed(own_parts[row, which][:, None] * _P + more).ravel())
                out.append(own_parts[~thin])
            else:
                out.append(own_parts.ravel())
        return np.concatenate(out) if out else np.empty(0, np.uint64)

    def finer(self, elements: np.ndarray) -> np.ndarray:
        """Second-level signatures: one partition of n1 = ceil((k + 1) / (SPARED + 1)) has at most ``SPARED`` differences."""
        own, out = self.band(len(elements)), []
        placed, content = _mixed(elements + _B), _mixed(elements * _A)
        for instance in (own, own + 1):
            if not self.partitions(instance):
                continue
            k = 2 * self.bands[instance][1] * (100 - self.share) // (100 + self.share)
            n1 = k // (SPARED + 1) + 1
            parts = np.zeros(FINER * n1, np.uint64)
            np.add.at(parts, (placed % np.uint64(FINER * n1)).astype(np.int64), content)
            parts = _mixed(parts.reshape(n1, FINER) + np.arange(FINER, dtype=np.uint64) * _P)
            sums = np.zeros((n1, len(_AGREE)), np.uint64)
            for c in range(_AGREE.shape[1]):
                sums = _mixed(sums * _P + parts[:, _AGREE[:, c]])
            code = np.arange(n1, dtype=np.uint64)[:, None] + np.uint64(instance) * np.uint64(1 << 32)
            out.append(_mixed(sums + (code * np.uint64(64) + np.arange(len(_AGREE), dtype=np.uint64)) * _A).ravel())
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _node(elements: np.ndarray) -> int:
    import xxhash

    value = xxhash.xxh3_64_intdigest(elements.tobytes())
    return value - (1 << 64) if value >= 1 << 63 else value


def parity_of(elements: np.ndarray) -> np.ndarray:
    """Parities of the elements in hash classes: 1,024, doubled until there are as many as elements.

    Halves of a longer one, joined by exclusive or, are the parities of half as many classes.
    """
    classes = CLASSES
    while classes < len(elements):
        classes *= 2
    where = (elements >> np.uint64(8)).astype(np.int64) % classes
    return np.packbits(np.bincount(where, minlength=classes).astype(np.uint8) & 1).view(np.int64)


def described(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_hash, n (set size), node (hash of the set, null when empty), parity (of hash classes)."""
    rows = keyed_texts(docs).withColumn("text_hash", F.xxhash64("text"))

    def run(batches):
        shingles = Shingler(words)
        for batch in sliced(batches):
            sets = [shingles(t) for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([parity_of(s) for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n", "node", "parity"],
            )

    return rows.mapInArrow(run, "doc_id long, text_hash long, n long, node long, parity array<long>")


def signatures(docs: DataFrame, words: int, share: int) -> DataFrame:
    """(sig, node): the signatures of every set; a task emits those of equal sets once."""

    def run(batches):
        shingles, enum, seen = Shingler(words), PartEnum(share), set()
        for batch in sliced(batches):
            sigs, nodes = [], []
            for text in text_bytes(batch.column(1)):
                elements = shingles(text)
                node = _node(elements)
                if not len(elements) or node in seen:
                    continue
                if len(seen) > MAX_WORDS:
                    seen.clear()
                seen.add(node)
                own = enum(elements)
                sigs.append(own)
                nodes.append(np.full(len(own), node, np.int64))
            if sigs:
                yield pa.RecordBatch.from_arrays([_signed(np.concatenate(sigs)), pa.array(np.concatenate(nodes))], ["sig", "node"])

    return keyed_texts(docs).mapInArrow(run, "sig long, node long")


def first_texts(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(node, text) of the rows named by ``firsts`` (doc_id, text_hash, node); the text as a zstandard frame.

    The names are broadcast where their table is small, so that no other text moves.
    """
    import zstandard

    names = broadcast_if_small(firsts.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "node"))
    rows = keyed_texts(docs).withColumn("text_hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    picked = rows.join(names, same).select("node", "text")

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in sliced(batches):
            frames = [press.compress(t) for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(frames, pa.binary())], ["node", "text"])

    return picked.mapInArrow(run, "node long, text binary")


def _promising(pairs: DataFrame, nodes: DataFrame, share: int) -> DataFrame:
    """Pairs (a, b, ...) that neither their sizes nor their parities rule out."""
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"{s}_n"), F.col("parity").alias(f"{s}_parity"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    width = F.least(F.size("a_parity"), F.size("b_parity"))  # sets of sizes that may link differ by one doubling at most

    def halved(c):
        half = F.zip_with(F.slice(c, F.lit(1), width), F.slice(c, width + 1, width), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(c) > width, half).otherwise(F.col(c))

    odd = F.zip_with(halved("a_parity"), halved("b_parity"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    odd = F.aggregate(odd, F.lit(0), lambda total, x: total + x)
    n = F.col("a_n") + F.col("b_n")
    sizes = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * share
    return both.where(sizes & (odd * (100 + share) <= n * (100 - share))).select(*pairs.columns)


def _verified(pairs: DataFrame, texts: DataFrame, words: int, share: int) -> DataFrame:
    """Pairs (a, b) whose sets reach the similarity.

    The text of b joins its pair first, then that of a; an ``a`` with very many pairs is a skewed key of that join, which
    adaptive execution splits.  A task reads the set of an ``a`` once for its neighbouring pairs.
    """
    other = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
    both = other.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a").select("a", "a_text", "b", "b_text")

    def run(batches):
        import zstandard

        press, shingles = zstandard.ZstdDecompressor(), Shingler(words)
        last, elements = None, None
        for batch in sliced(batches):
            a, b = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            kept = []
            for k, (x, one, other) in enumerate(zip(a, batch.column(1).to_pylist(), batch.column(3).to_pylist())):
                if x != last:
                    last, elements = x, shingles(press.decompress(one))
                others = shingles(press.decompress(other))
                common = len(np.intersect1d(elements, others, assume_unique=True))
                if common * 100 >= (len(elements) + len(others) - common) * share:
                    kept.append(k)
            yield pa.RecordBatch.from_pydict({"a": pa.array([a[k] for k in kept], pa.int64()), "b": pa.array([b[k] for k in kept], pa.int64())})

    return both.mapInArrow(run, "a long, b long")


def _labelled(members: DataFrame, labels: DataFrame, node: str = "node", name: str = "component") -> DataFrame:
    known = labels.select(F.col("node").alias(node), F.col("component").alias(name))
    return members.join(known, node, "left").withColumn(name, F.coalesce(name, node))


def _thinned(buckets: DataFrame) -> DataFrame:
    """One of all buckets that hold the same members: they would only bring the same pairs again."""
    marks = buckets.groupBy("sig").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")
    )
    return buckets.join(marks.groupBy("n", "x", "y").agg(F.min("sig").alias("sig")).select("sig"), "sig", "left_semi")


def pointers(near: DataFrame) -> DataFrame:
    """(node, component): up to four links up from every b of ``near`` (a, b), where a always comes before b in one order.

    It only saves comparisons: the links decide the components.
    """
    up = near.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    for _ in range(2):
        above = up.select(F.col("node").alias("component"), F.col("component").alias("_above"))
        up = up.join(above, "component", "left").select("node", F.coalesce("_above", "component").alias("component"))
    return up


class _Links:
    """The links found so far; texts are fetched once for each node that is asked about."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, words: int, share: int):
        self.docs, self.nodes, self.words, self.share = docs, nodes, words, share
        self.texts = self.labels = None
        self.near, self.others, self.joined = [], [], False

    def fetch(self, asked: DataFrame) -> None:
        """Make sure that ``texts`` holds the texts of the nodes asked for, each once."""
        if self.texts is not None:
            asked = asked.join(self.texts.select("node"), "node", "left_anti")
        firsts = stash(asked.join(self.nodes, "node").select("doc_id", "text_hash", "node"), "firsts")
        texts = stash(first_texts(self.docs, firsts), "texts")
        self.texts = texts if self.texts is None else self.texts.unionByName(texts)

    def verified(self, pairs: DataFrame) -> DataFrame:
        pairs = stash(pairs, "pairs")
        self.fetch(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
        return stash(_verified(pairs, self.texts, self.words, self.share), "links")

    def nearest(self, pairs: DataFrame) -> None:
        """Find links among ``pairs`` (a, b, shared) with a < b: only the most promising of each b is looked at."""
        nearest = F.max_by("a", F.struct("shared", -F.col("a"))).alias("a")
        self.near.append(self.verified(_promising(pairs, self.nodes, self.share).groupBy("b").agg(nearest).select("a", "b")))
        if self.joined:  # pointers know less than the labels did
            self.labels = self.components()
        else:
            self.labels = stash(pointers(reduce(DataFrame.unionByName, self.near)), "pointers")

    def settle(self, left: DataFrame, key: str) -> None:
        """Find all links inside the groups ``left`` (key, node, component, pairs), those of many pairs by a forest first."""
        self.every(exhaustive(left, key, self.nodes, self.share, forest=True))
        dense = left.where(F.col("pairs") > DENSE).select(key, "node")
        if dense.isEmpty():
            return
        self.labels, self.joined = self.components(), True
        again = self.known(dense)
        self.every(exhaustive(stash(again.join(undecided(again, key), key), "again"), key, self.nodes, self.share))

    def every(self, pairs: DataFrame) -> None:
        """Find all links among ``pairs`` (a, b)."""
        self.others.append(self.verified(pairs))

    def known(self, members: DataFrame) -> DataFrame:
        """``members`` with the ``component`` of each as far as it is known."""
        return _labelled(members, self.labels)

    def components(self) -> DataFrame:
        return stash(connected_components(reduce(DataFrame.unionByName, [*self.near, *self.others])), "labels")


def undecided(members: DataFrame, key: str) -> DataFrame:
    """key, pairs: the pairs of each group that lie between components, where there are any."""
    sizes = members.groupBy(key, "component").agg(F.count(F.lit(1)).alias("k"))
    sizes = sizes.groupBy(key).agg(F.sum("k").alias("m"), F.sum(F.col("k") * F.col("k")).alias("own"))
    pairs = (F.col("m") * F.col("m") - F.col("own")) / 2
    return sizes.select(key, F.col("m").cast("long").alias("m"), pairs.cast("long").alias("pairs")).where("pairs > 0")


def stars(members: DataFrame, key: str, share: int) -> DataFrame:
    """(a, b, shared): the smallest node of each group with the members of other components that its size allows."""
    centres = members.groupBy(key).agg(F.min(F.struct("node", "component", "n")).alias("c"))
    star = members.join(centres, key).where(F.col("component") != F.col("c.component"))
    star = star.where(F.least("n", "c.n") * 100 >= F.greatest("n", "c.n") * share)
    return star.groupBy(F.col("c.node").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("shared"))


class _Parities:
    """Parities of the members of a group, of one width or of several."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray):
        self.width = offsets[1:] - offsets[:-1]
        own = int(self.width[0])
        self.one = values.reshape(-1, own) if (self.width == own).all() else None
        if self.one is None:
            self.place, self.whole, self.half = np.zeros(len(self.width), np.int64), {}, {}
            for w in np.unique(self.width):
                at = np.flatnonzero(self.width == w)
                self.place[at] = np.arange(len(at))
                self.whole[w] = whole = np.stack([values[offsets[k] : offsets[k + 1]] for k in at])
                self.half[w] = whole[:, : w // 2] ^ whole[:, w // 2 :]

    def odd(self, i: int, j: np.ndarray) -> np.ndarray:
        """Classes in which i and each of j differ, of as many as the narrower has; widths differ by one doubling at most."""
        if self.one is not None:
            return np.bitwise_count(self.one[j] ^ self.one[i]).sum(1).astype(np.int64)
        out, own, at = np.zeros(len(j), np.int64), self.width[i], self.place[i]
        for w in np.unique(self.width[j]):
            which = np.flatnonzero(self.width[j] == w)
            others = (self.half if w > own else self.whole)[w][self.place[j[which]]]
            out[which] = np.bitwise_count(others ^ (self.half if w < own else self.whole)[own][at]).sum(1)
        return out


def _forest(component: np.ndarray, i: np.ndarray, j: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The places of edges (i, j) that span what they connect between components, the lightest first (Boruvka's steps)."""
    kinds, label = np.unique(component, return_inverse=True)
    at, taken = np.argsort(weight, kind="stable"), []
    while True:
        u, v = label[i[at]], label[j[at]]
        at, u, v = at[u != v], u[u != v], v[u != v]
        if not len(at):
            return np.array(taken, np.int64)
        first = np.full(len(kinds), len(at))
        np.minimum.at(first, u, np.arange(len(at)))
        np.minimum.at(first, v, np.arange(len(at)))
        root = list(range(len(kinds)))

        def top(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for k in np.unique(first[first < len(at)]):
            x, y = top(u[k]), top(v[k])
            if x != y:
                root[x] = y
                taken.append(at[k])
        label = np.array([top(x) for x in range(len(kinds))])[label]


def exhaustive(members: DataFrame, key: str, nodes: DataFrame, share: int, forest: bool = False) -> DataFrame:
    """(a, b) between components of a group that neither sizes nor parities rule out; compared inside the group's task.

    ``members`` (key, node, component, and optionally side) are groups of bounded size; with sides only members of
    different sides meet, or all where the group has one side.  With ``forest`` (and ``pairs``, those of the group), a
    group of more than ``DENSE`` pairs gives only a spanning forest of them.
    """
    extra = ["side"] if "side" in members.columns else []
    extra += [F.coalesce(F.col("pairs") > DENSE, F.lit(False)).alias("dense")] if forest else []
    rows = members.select(F.col(key).alias("key"), "component", "node", *extra).join(nodes.select("node", "n", "parity"), "node")
    rows = rows.repartition("key").sortWithinPartitions("key")
    has_sides = "side" in members.columns

    def pairs(node, component, n, parity, side, dense):
        apart = side is not None and (side != side[0]).any()
        last = len(node) - 1
        if last > 32:  # the largest component comes last: its members need not meet each other
            _, kind, sizes = np.unique(component, return_inverse=True, return_counts=True)
            order = np.argsort(sizes[kind] * len(sizes) + kind, kind="stable")
            last = min(last, len(node) - int(sizes.max()))
        else:
            order = np.arange(len(node))
        found = []
        for at in range(last):
            i, j = order[at], order[at + 1 :]
            other = component[j] != component[i]
            if apart:
                other &= side[j] != side[i]
            j = j[other]
            j = j[np.minimum(n[j], n[i]) * 100 >= np.maximum(n[j], n[i]) * share]
            if not len(j):
                continue
            odd, both = parity.odd(i, j), n[j] + n[i]
            near = odd * (100 + share) <= both * (100 - share)
            if near.any():
                found.append((np.full(int(near.sum()), i), j[near], odd[near] / both[near]))
        if not found:
            return []
        i, j, weight = (np.concatenate(x) for x in zip(*found))
        if dense:
            kept = _forest(component, i, j, weight)
            i, j = i[kept], j[kept]
        return zip(np.minimum(node[i], node[j]).tolist(), np.maximum(node[i], node[j]).tolist())

    def emit(whole):
        if not whole.num_rows:
            return
        key, node, component, n = (whole.column(c).to_numpy() for c in ("key", "node", "component", "n"))
        side = whole.column("side").to_numpy() if has_sides else None
        dense = whole.column("dense").to_numpy() if forest else None
        lists = whole.column("parity").combine_chunks()
        values, offsets = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy().astype(np.int64)
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1), len(key)]
        for start in range(0, len(cuts) - 1, 256):
            found = set()
            for x, y in zip(cuts[start : start + 256], cuts[start + 1 : start + 257]):
                parity = _Parities(values[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x])
                own = None if side is None else side[x:y]
                found.update(pairs(node[x:y], component[x:y], n[x:y], parity, own, forest and dense[x]))
            found = sorted(found)
            yield pa.RecordBatch.from_pydict({c: pa.array([p[k] for p in found], pa.int64()) for k, c in enumerate("ab")})

    def run(batches):
        held = None  # the rows of the last key go on with the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            own = pa.Table.from_batches([batch])
            held = own if held is None else pa.concat_tables([held, own])
            key = held.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            yield from emit(held.slice(0, cut))
            held = held.slice(cut)
        if held is not None:
            yield from emit(held)

    return rows.mapInArrow(run, "a long, b long").distinct()


def _sliced(members: DataFrame) -> DataFrame:
    """Groups (path, node, component, side) in which each two slices of a large bucket (sig, m) meet."""
    slices = F.ceil(F.col("m") / SLICE).cast("int")
    own = F.pmod(F.xxhash64("node"), slices).cast("int")
    cut = members.select("sig", "node", "component", own.alias("side"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("other"))
    return cut.select(F.xxhash64("sig", F.least("side", "other"), F.greatest("side", "other")).alias("path"), "node", "component", "side")


def _signed_again(asked: DataFrame, texts: DataFrame, words: int, share: int) -> DataFrame:
    """(sig, node): the second-level signatures of the nodes asked for."""

    def run(batches):
        import zstandard

        press, shingles, enum = zstandard.ZstdDecompressor(), Shingler(words), PartEnum(share)
        for batch in sliced(batches):
            own = [enum.finer(shingles(press.decompress(t))) for t in batch.column(1).to_pylist()]
            nodes = np.repeat(batch.column(0).to_numpy(), [len(x) for x in own])
            yield pa.RecordBatch.from_arrays([_signed(np.concatenate(own)), pa.array(nodes, pa.int64())], ["sig", "node"])

    return asked.join(texts, "node").select("node", "text").mapInArrow(run, "sig long, node long")


def linked_nodes(docs: DataFrame, nodes: DataFrame, words: int, share: int) -> DataFrame:
    """(node, component) of every node that has a link."""
    links, sizes, bucket = _Links(docs, nodes, words, share), nodes.select("node", "n"), Window.partitionBy("sig")
    first = signatures(docs, words, share).withColumns({"a": F.min("node").over(bucket), "z": F.max("node").over(bucket)})
    members = stash(first.where(F.col("a") != F.col("z")).select("sig", "node", "a").distinct(), "buckets")
    star = members.where(F.col("a") != F.col("node"))
    links.nearest(star.groupBy("a", F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("shared")))
    members = members.select("sig", "node")
    for level in range(2):
        if level:
            links.nearest(stars(links.known(members).join(sizes, "node"), "sig", share))
        left = links.known(members)
        left = stash(_thinned(left.join(undecided(left, "sig"), "sig")), "open")
        few = (F.col("pairs") <= SMALL) & (F.col("m") <= MEMBERS)
        links.settle(left.where(few), "sig")
        large = left.where(~few)
        if level:
            links.every(exhaustive(_sliced(large), "path", nodes, share))
            break
        asked = stash(large.select("node").distinct(), "asked")
        if asked.isEmpty():
            break
        links.fetch(asked)
        members = stash(_shared(_signed_again(asked, links.texts, words, share)), "finer")
    return links.components()


def _shared(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one."""
    more = members.groupBy("sig").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("sig")
    return members.join(more, "sig", "left_semi")


def components(docs: DataFrame, words: int, share: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id for every row of ``docs``: components only, no links.

    Two rows link when 100 * |common shingles| >= share * |all shingles|; ``component_id`` is the smallest doc_id that
    links lead to, the row's own included.  A text with fewer words than a shingle is one shingle; null and empty
    texts, and those without words, have none and are their own component.  Rows with the same words are linked
    whether or not their ids repeat; a null id is never the smallest but where no row of the component has one.
    """
    rows = stash(described(docs, words), "described")
    first = F.min_by(F.struct("doc_id", "text_hash"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    nodes = stash(
        rows.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(first.alias("f"), *[F.min(c).alias(c) for c in ("n", "parity")])
        .select("node", "f.doc_id", "f.text_hash", "n", "parity"),
        "nodes",
    )
    labels = linked_nodes(docs, nodes, words, share)
    known = nodes.select("node", "doc_id").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = known.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    names = stash(known.join(smallest, "component").select("node", "component_id"), "names")
    out = rows.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "node").join(names, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", own.alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, share: int = 80) -> DataFrame:
    """``docs`` with one row of every component, the columns unchanged: the smallest doc_id, then text hash.

    Rows without words (null and empty texts too) stay, repeated ones once; a null id is taken only where a component
    has no other.  Repeated rows and equal texts are one component.  Other columns may have any name; an empty table
    gives no row.
    """
    found = components(docs, words, share)
    alone = found.where(F.col("n_shingles") == 0).select("doc_id", "text_hash")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("_first")
    kept = found.where(F.col("n_shingles") > 0).groupBy("component_id").agg(first).select("_first.doc_id", "_first.text_hash")
    own, text = unused(docs, "_id"), unused(docs, "_hash")
    keys = kept.unionByName(alone).select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash")).distinct()
    marked = docs.withColumn(own, F.col("doc_id").cast("long")).withColumn(text, F.xxhash64(F.col("text").cast("string")))
    same = F.col(f"l.{own}").eqNullSafe(F.col("r.k_id")) & (F.col(f"l.{text}") == F.col("r.k_hash"))
    rows = marked.alias("l").join(keys.alias("r"), same, "left_semi")
    return rows.dropDuplicates([own, text]).drop(own, text)
