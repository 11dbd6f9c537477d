"""Best-two-fit packing of token pieces into sequences of bounded length.

The packing is decided on the histogram of piece lengths, which never has more than ``capacity`` entries however
large the corpus is: each step builds one bin and repeats it as often as the counts allow, which is exactly what
packing one bin after the other would do, since a choice depends only on the lengths still available.  Spark then
deals the pieces out by their rank among the pieces of equal length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpus_audit.llm.common import keyed_texts, sliced, stash, text_bytes, unused
from corpus_audit.llm.encoding import WordEncoder
from corpus_audit.scale import ranked

CAPACITY = 2048
LANES = 256

PIECES = "doc_id long, piece int, start long, length long, ids binary"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian unsigned 32-bit).

    A document is its ids and then ``end_id``; only documents longer than ``capacity`` are cut, into pieces of
    ``capacity`` ids, the last one shorter.  Null and empty texts give one piece that holds the end id alone.
    Repeated rows give their pieces again; a null doc_id stays null; other columns are ignored.
    """

    def run(batches):
        encoder, end = WordEncoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        for batch in sliced(batches):
            keys = batch.column(0).to_pylist()
            rows = []
            for key, ids in zip(keys, encoder.encode(text_bytes(batch.column(1)))):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    rows.append((key, k, at // 4, len(cut) // 4, cut))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids"]
            )

    return keyed_texts(docs).mapInArrow(run, PIECES)


def best_two_fit_bins(counts: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins for ``counts[length]`` pieces: ([(length, how many), ...], how often this bin is repeated).

    A bin starts with the largest piece left and is filled greedily with the largest that fits.  Then its smallest
    piece is taken out if two pieces not yet packed fit the widened gap more tightly than it did; of such pairs the
    one with the largest sum is taken, and of equal sums the one with the largest member.
    """
    counts = counts.astype(np.int64).copy()
    capacity = len(counts) - 1
    every = np.arange(capacity + 1)
    bins = []
    top = capacity
    while True:
        while top and not counts[top]:
            top -= 1
        if not top:
            return bins
        left, gap, used = counts.copy(), capacity, {}
        below = np.maximum.accumulate(np.where(left > 0, every, 0))
        size = top
        while size:
            n = int(min(left[size], gap // size))
            used[size] = n
            left[size] -= n
            gap -= n * size
            # what is smaller than this size is untouched, so the table of available sizes still holds
            size = int(below[min(gap, size - 1)])
        if gap and sum(used.values()) > 1:
            small = min(used)
            wide = gap + small
            below = np.maximum.accumulate(np.where(left > 0, every, 0))
            first = np.flatnonzero(left[: wide + 1])
            other = np.minimum(first, wide - first)
            other = np.where((other == first) & (left[first] < 2), first - 1, other)
            second = below[np.maximum(other, 0)]
            total = np.where(second > 0, first + second, 0)
            best = np.flatnonzero(total == total.max())[-1] if len(total) else 0
            if len(total) and total[best] > small:
                used[small] -= 1
                if not used[small]:
                    del used[small]
                for piece in (int(first[best]), int(second[best])):
                    used[piece] = used.get(piece, 0) + 1
        repeats = int(min(counts[s] // n for s, n in used.items()))
        for s, n in used.items():
            counts[s] -= n * repeats
        bins.append((sorted(used.items(), reverse=True), repeats))


def _slots(bins, capacity: int) -> dict[int, np.ndarray]:
    """Per length: rows (first rank, repeats, first sequence, offset) in order of rank."""
    taken = np.zeros(capacity + 1, dtype=np.int64)
    slots: dict[int, list] = {}
    sequence = 0
    for used, repeats in bins:
        offset = 0
        for size, n in used:
            slots.setdefault(size, []).append((taken[size], repeats, sequence, offset))
            taken[size] += n * repeats
            offset += n * size
        sequence += repeats
    return {size: np.array(rows, dtype=np.int64) for size, rows in slots.items()}


def best_two_fit(pieces: DataFrame, capacity: int = CAPACITY, lanes: int = LANES) -> DataFrame:
    """``pieces`` (doc_id, piece, length and any other columns) with ``sequence_id`` and ``offset``.

    Lengths are 1 to ``capacity``; another length is an error.  Ties in length are dealt out by doc_id and piece
    inside hash lanes, so a length that most pieces share is still spread over ``lanes`` tasks.  No rows, no
    sequences.  Columns called ``sequence_id`` or ``offset`` in the input are replaced.
    """
    data = stash(pieces.drop("sequence_id", "offset"), "pieces")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in data.groupBy("length").count().limit(capacity + 1).collect():
        if size is None or not 1 <= size <= capacity:
            raise ValueError(f"length {size} is not between 1 and {capacity}")
        histogram[size] = n
    slots = _slots(best_two_fit_bins(histogram), capacity)
    lane = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(lanes))
    order = unused(data, "_order")
    placed = ranked(data, ["length"], [F.col("doc_id"), F.col("piece")], lane, order)
    schema = StructType([*data.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    names = data.columns

    def run(batches):
        for batch in batches:
            size = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column(order).to_numpy(zero_copy_only=False) - 1
            sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            for value in np.unique(size):
                own = np.flatnonzero(size == value)
                rows = slots[int(value)]
                at = rows[np.searchsorted(rows[:, 0], rank[own], side="right") - 1]
                turn = rank[own] - at[:, 0]
                sequence[own] = at[:, 2] + turn % at[:, 1]
                offset[own] = at[:, 3] + turn // at[:, 1] * value
            columns = [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    return placed.select(*[F.col(f"`{n}`") for n in names], F.col(order).cast("long").alias(order)).mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, ids: bool = True) -> DataFrame:
    """Tokenize, cut and pack: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset.

    ``ids=False`` leaves the ids themselves out once their checksum is taken, so that placing moves no token.
    """
    pieces = token_pieces(docs, tokenizer, capacity, end_id).withColumn("ids_crc32", F.crc32("ids"))
    return best_two_fit(pieces if ids else pieces.drop("ids"), capacity)
