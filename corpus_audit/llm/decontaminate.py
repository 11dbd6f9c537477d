"""Benchmark decontamination by pigeonhole edit matching.

A test item of L characters may be met with k = floor(rate * L) edits.  It is split into k + 1 pieces: a passage within
k edits of the item leaves at least one piece intact, at most k characters from its place.  The pieces of all items are
found in one pass over a text (Aho-Corasick), and only the windows around hits are verified, by Myers' bit-parallel
distance.  Nothing within the budget can be missed.

Texts are compared in lower case with every run of other characters than letters and digits as one space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from corpus_audit.llm.common import keyed_texts, sliced, unused

RATE, BLOCK_CHARS = 0.06, 2_000_000

MATCHES = "doc_id long, item_id long, distance int, start int, end int, passage string"

_RUN = re.compile(r"[^\W_]+")


def folded(text: str) -> str:
    return " ".join(_RUN.findall(text.lower()))


def budget(length: int, rate: float) -> int:
    return int(rate * length)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): ``k + 1`` pieces of the item whose lengths differ by one at most."""
    cuts = [round(i * len(item) / (k + 1)) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def _marks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(marks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """The least edit distance of the pattern to a substring of ``text`` and the first end at which it is met."""
    mask, top = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = mask, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = marks.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq
        vertical = eq | down
        plus = down | ~(diagonal | up)
        minus = up & diagonal
        if plus & top:
            distance += 1
        elif minus & top:
            distance -= 1
            if distance < best:
                best, end = distance, j + 1
        plus, minus = (plus << 1) & mask, (minus << 1) & mask
        up = (minus | ~(vertical | plus)) & mask
        down = plus & vertical
    return best, end


class Matcher:
    """Finds the items of one block in texts: ``search(folded text)`` gives {item: (distance, start, end)}."""

    def __init__(self, items: list[str], rate: float):
        import ahocorasick

        self.items = items
        self.budgets = [budget(len(x), rate) for x in items]
        self.marks: dict[int, tuple[dict, dict]] = {}
        owners: dict[str, list[tuple[int, int]]] = {}
        for i, (item, k) in enumerate(zip(items, self.budgets)):
            for at, piece in pieces(item, k):
                owners.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def search(self, text: str) -> dict[int, tuple[int, int, int]]:
        windows: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.automaton.iter(text):
            first = last + 1 - size
            for i, at in where:
                k = self.budgets[i]
                a, b = max(0, first - at - k), min(len(text), first - at + len(self.items[i]) + k)
                own = windows.setdefault(i, [])
                if own and a <= own[-1][1] and b >= own[-1][0]:
                    own[-1] = [min(a, own[-1][0]), max(b, own[-1][1])]
                else:
                    own.append([a, b])
        found = {}
        for i, own in windows.items():
            item = self.items[i]
            if i not in self.marks:
                self.marks[i] = _marks(item), _marks(item[::-1])
            ahead, back = self.marks[i]
            hits = []
            for a, b in own:
                distance, end = myers(ahead, len(item), text[a:b])
                if distance <= self.budgets[i]:
                    _, size = myers(back, len(item), text[a : a + end][::-1])
                    hits.append((distance, a + end - size, a + end))
            if hits:
                found[i] = min(hits)
        return found


def item_blocks(benchmark: DataFrame, key: str, text: str, chars: int) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of about ``chars`` characters, so that only one block is held or sent out at a time.

    Items that are null, empty or without a letter or digit can be met nowhere and are left out.
    """
    block, size = [], 0
    rows = benchmark.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    for r in rows.distinct().toLocalIterator():
        item = folded(r.text or "")
        if not item:
            continue
        block.append((r.id, item))
        size += len(item)
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def edit_matches(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, key: str = "item_id", text: str = "text", chars: int = BLOCK_CHARS
) -> DataFrame:
    """doc_id, item_id, distance, start, end, passage: the best place of every item in every document that holds it.

    Best is the least distance, then the first start.  ``start`` and ``end`` count characters of the folded text, of
    which ``passage`` is the cut.  Null and empty texts hold nothing; repeated rows are reported each; an item whose id
    repeats with other texts is reported for each text.  Other columns are ignored.
    """
    out = None
    for block in item_blocks(benchmark, key, text, chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            ids = [i for i, _ in shared.value]
            matcher = Matcher([t for _, t in shared.value], rate)
            for batch in sliced(batches):
                rows = []
                for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    body = folded(body or "")
                    for i, (distance, a, b) in matcher.search(body).items():
                        rows.append({"doc_id": doc, "item_id": ids[i], "distance": distance, "start": a, "end": b, "passage": body[a:b]})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

        part = keyed_texts(docs).mapInArrow(run, MATCHES)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], MATCHES)


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("passage", pa.string())]
)


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text: str = "text", chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with the columns they came with, whatever their names.

    Null and empty texts hold nothing and stay, as all rows do where ``benchmark`` is empty; repeated rows stay or go
    alike; an empty table gives no row.
    """
    name = unused(docs, "_holds")
    for block in item_blocks(benchmark, "item_id", "text", chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        schema = StructType([*docs.schema.fields, StructField(name, BooleanType())])
        at = docs.columns.index(text)

        def run(batches, shared=shared, schema=schema, at=at):
            matcher = Matcher([t for _, t in shared.value], rate)
            for batch in sliced(batches):
                holds = [bool(matcher.search(folded(t or ""))) for t in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(holds, pa.bool_())], schema.names)

        docs = docs.mapInArrow(run, schema).where(~F.col(name)).drop(name)
    return docs
