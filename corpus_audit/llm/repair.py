"""Repair of conversation structure by weighted CYK parsing over spans of turns.

The turns of a conversation are to read ``(s?(ua)+)?`` by the initials of their roles.  The repair grammar in Chomsky normal
form has one nonterminal A[p, q] for each two positions p, q of that pattern (nothing yet, after s, after u, after a): A[p, q]
yields the spans of turns whose edits lead from p to q.  A single turn gives the cells of its edits (keep, rerole, delete), a
binary rule A[p, q] -> A[p, r] A[r, q] joins two neighbouring spans, and every cell is closed under insertions before and
after.  A cell keeps its least (cost, audit), where the audit is the string of the edits' initials.

Spans are combined bottom-up by length: single turns, then spans of two, four, ... turns.  One way to split a span is
enough: a derivation that goes from p to q is in some position r at any cut, so every cut of a span yields the same cell.
Audits of equal cost and the same span are never a prefix of one another (the turns' letters fix the cost but for
insertions), so the least of two joined audits is made of the least of their parts.

Turns are sorted by conversation and turn over ranges, and a range is cut into fragments of at most ``FRAGMENT`` turns, so a
conversation with a third of all turns is parsed by many tasks; only the fragments' cells meet, which are as long as
its audit.  The digest of a repaired conversation is sequential by nature: its turns pass one task, a batch at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_audit.llm.common import stash

#: turns of a fragment
FRAGMENT = 2048

# --- fixed values: costs of the edits, positions of the pattern and the steps between them
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ACCEPTED = (NOTHING, ASSISTANT)
LEGAL = {"su", "ua", "au"}
# --- end of fixed values

Cell = tuple[int, str]
Span = tuple[tuple[Cell | None, ...], ...]  # [p][q]: the least (cost, audit) that leads from p to q


def _least(entries: Iterator[tuple[int, int, Cell]]) -> Span:
    out: list[list[Cell | None]] = [[None] * 4 for _ in range(4)]
    for p, q, cell in entries:
        known = out[p][q]
        if known is None or cell < known:
            out[p][q] = cell
    return tuple(map(tuple, out))


def join(left: Span, right: Span) -> Span:
    """The binary rules: cells of the span that two neighbouring spans make."""
    return _least(
        (p, q, (a[0] + b[0], a[1] + b[1]))
        for p in range(4)
        for r, a in enumerate(left[p])
        if a is not None
        for q, b in enumerate(right[r])
        if b is not None
    )


@cache
def insertions() -> Span:
    """Cells of the empty span: any number of inserted turns, by repeated joining until nothing gets cheaper."""
    one = _least((p, q, (INSERT, "I")) for letter in "ua" for p, q in STEPS[letter].items())
    none = _least((p, p, (0, "")) for p in range(4))
    closed = none
    while True:
        more = join(closed, one)
        wider = _least((p, q, c) for span in (closed, more) for p in range(4) for q, c in enumerate(span[p]) if c is not None)
        if wider == closed:
            return closed
        closed = wider


@cache
def leaf(initial: str, fault: str) -> Span:
    """Cells of one turn, closed under insertions; ``fault`` is blank, duplicate, truncated or empty."""
    edits = [(p, p, (DELETE, "D")) for p in range(4)]
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED if fault == "truncated" else 0
        edits += [(p, q, (KEEP + extra, "K")) for p, q in STEPS.get(initial, {}).items()]
        edits += [(p, q, (REROLE + extra, "R")) for letter in "ua" for p, q in STEPS[letter].items()]
    return join(join(insertions(), _least(iter(edits))), insertions())


def parse(spans: list[Span]) -> Span:
    """The cells of neighbouring spans as one, combined bottom-up."""
    spans = spans or [insertions()]
    while len(spans) > 1:
        spans = [join(spans[k], spans[k + 1]) if k + 1 < len(spans) else spans[k] for k in range(0, len(spans), 2)]
    return spans[0]


def cheapest(span: Span) -> Cell:
    return min(c for q in ACCEPTED if (c := span[NOTHING][q]) is not None)


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present: the rows that a fixed hash of ``conv_id:turn`` leaves, empties, cuts, repeats or reroles.

    Nulls in that name, in roles and in texts stand as one space.  A row that is dropped stays as a row without
    ``present``, turn, role and text, so that its conversation is still named.
    """
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", one("conv_id"), one("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), kind.alias("kind"))
    there = F.col("kind") != 0
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.select(
        "conv_id",
        F.when(there, F.col("turn")).alias("turn"),
        F.when(there, role).alias("role"),
        F.when(there, text).alias("text"),
        there.alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("_again"),
    ).drop("_again")


def _faulted(turns: DataFrame) -> DataFrame:
    """The turns with their first fault and their order: conv_id, turn, role, text, present, said, copy, fault."""
    one = lambda c: F.when(F.col("present"), F.coalesce(F.col(c).cast("string"), F.lit(" ")))
    rows = turns.select("conv_id", F.when(F.col("present"), F.col("turn").cast("long")).alias("turn"), one("role").alias("role"), one("text").alias("text"), "present")
    # equal turns as one row with a count, so that neither a repeated turn nor a dropped conversation makes a large group
    rows = rows.groupBy("conv_id", "turn", "role", "text", "present").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("said", F.md5("text"))
    at = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn"))  # nulls first
    firsts = rows.where("present").groupBy("conv_id", "role", "said").agg(F.min(at).alias("first"))
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("said").alias("s"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("said") == F.col("s"))
    rows = rows.join(firsts, same, "left").drop("c", "r", "s")
    copies = F.when(F.col("present"), F.sequence(F.lit(1), F.col("copies").cast("int"))).otherwise(F.array(F.lit(1)))
    rows = rows.withColumn("copy", F.explode(copies))
    end = F.right(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = (
        F.when(~F.col("present"), F.lit("none"))
        .when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit("blank"))
        .when((F.col("copy") > 1) | ~at.eqNullSafe(F.col("first")), F.lit("duplicate"))
        .when(~end.isin(".", "!", "?"), F.lit("truncated"))
        .otherwise(F.lit(""))
    )
    return rows.select("conv_id", "turn", "role", "text", "said", "copy", fault.alias("fault"))


_SUMMARY = "rows long, blank long, duplicate long, truncated long, illegal long, head string, tail string, low long, high long, turns long"
_CELLS = "costs array<long>, audits array<string>"


class _Fragment:
    """What one pass over the turns of a fragment gathers."""

    def __init__(self):
        self.rows, self.faults, self.spans, self.illegal = 0, dict.fromkeys(("blank", "duplicate", "truncated"), 0), [], 0
        self.head = self.tail = self.low = self.high = None
        self.turns = 0

    def add(self, turn, role: str, fault: str) -> None:
        if fault == "none":
            return
        initial = role[:1]
        self.rows += 1
        if fault:
            self.faults[fault] += 1
        self.spans.append(leaf(initial if initial in STEPS else "", fault))
        if self.tail is None:
            self.head = initial
        elif self.tail + initial not in LEGAL:
            self.illegal += 1
        self.tail = initial
        if turn is not None and turn != self.high:  # turns come in order
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def summary(self) -> dict:
        span = parse(self.spans)
        cells = [c if c is not None else (None, None) for row in span for c in row]
        return {
            **{"rows": self.rows, **self.faults, "illegal": self.illegal, "head": self.head, "tail": self.tail},
            **{"low": self.low, "high": self.high, "turns": self.turns},
            **{"costs": [c[0] for c in cells], "audits": [c[1] for c in cells]},
        }


def fragments(turns: DataFrame) -> DataFrame:
    """The turns in order with ``frag`` (increasing over the turns of a conversation), ``pos`` in it, and on its last row a summary."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("said"), F.col("copy")]
    rows = _faulted(turns).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = rows.schema
    own = f"struct<{', '.join(f'{x.split()[0]}:{x.split()[1]}' for x in (_SUMMARY + ', ' + _CELLS).split(', '))}>"

    def run(batches):
        from pyspark import TaskContext

        frag, pos, held, current = TaskContext.get().partitionId() << 32, 0, _Fragment(), None

        def done(batch, following):
            nonlocal frag, pos, held
            conv, turn, role, fault = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "fault"))
            frags, places, sums = [], [], []
            for k in range(len(conv)):
                held.add(turn[k], role[k], fault[k])
                frags.append(frag)
                places.append(pos)
                after = (conv[k + 1],) if k + 1 < len(conv) else following
                if after != (conv[k],) or pos + 1 == FRAGMENT:
                    sums.append(held.summary())
                    frag, pos, held = frag + 1, 0, _Fragment()
                else:
                    sums.append(None)
                    pos += 1
            extra = [pa.array(frags, pa.int64()), pa.array(places, pa.int64()), pa.array(sums, _arrow_summary())]
            columns = [batch.column(c) for c in ("conv_id", "role", "text", "fault")]
            return pa.RecordBatch.from_arrays([*columns, *extra], ["conv_id", "role", "text", "fault", "frag", "pos", "sums"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if current is not None:
                yield done(current, (batch.column("conv_id")[0].as_py(),))
            current = batch
        if current is not None:
            yield done(current, None)

    kind = schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {kind}, role string, text string, fault string, frag long, pos long, sums {own}")


def _arrow_summary() -> pa.DataType:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.struct([(x.split()[0], kinds[x.split()[1]]) for x in (_SUMMARY + ", " + _CELLS).split(", ")])


def _spans_of(sums: dict) -> Span:
    cells = [None if c is None else (c, a) for c, a in zip(sums["costs"], sums["audits"])]
    return tuple(tuple(cells[4 * p : 4 * p + 4]) for p in range(4))


def _whole(parts: list[dict]) -> dict:
    """The result of a conversation from the summaries of its fragments in order, and the part of the audit of each."""
    out = {c: sum(x[c] for x in parts) for c in ("blank", "duplicate", "truncated", "illegal")}
    filled = [x for x in parts if x["rows"]]
    out["illegal"] += sum(x["tail"] + y["head"] not in LEGAL for x, y in zip(filled, filled[1:]))
    dated = [x for x in filled if x["turns"]]
    different = sum(x["turns"] for x in dated) - sum(x["high"] == y["low"] for x, y in zip(dated, dated[1:]))
    out["gaps"] = dated[-1]["high"] - dated[0]["low"] + 1 - different if dated else 0
    out["cost"], out["audit"] = cheapest(parse([_spans_of(x) for x in filled])) if filled else (0, "")
    kept = sum(letter != "D" for letter in out["audit"])
    pieces, at, before = [], 0, 0
    for k, x in enumerate(parts):
        end, rows = at, 0
        while rows < x["rows"]:
            rows += out["audit"][end] != "I"
            end += 1
        end = len(out["audit"]) if k == len(parts) - 1 else end
        piece = out["audit"][at:end]
        pieces.append({"frag": x["frag"], "piece": piece, "before": before, "odd": bool(kept % 2)})
        at, before = end, before + sum(letter != "D" for letter in piece)
    out["pieces"] = pieces
    return out


def results(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, pieces of every conversation of ``fragments``."""
    sums = turns.where(F.col("sums").isNotNull()).select("conv_id", F.struct("frag", "sums.*").alias("x"))
    whole = sums.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("parts"))  # as long as the audit
    kind = whole.schema["conv_id"].dataType.simpleString()
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    piece = pa.struct([("frag", pa.int64()), ("piece", pa.string()), ("before", pa.int64()), ("odd", pa.bool_())])

    def run(batches):
        for batch in batches:
            found = [_whole(x) for x in batch.column("parts").to_pylist()]
            columns = [pa.array([x[c] for x in found], pa.int64()) for c in longs]
            columns += [pa.array([x["audit"] for x in found], pa.string()), pa.array([x["pieces"] for x in found], pa.list_(piece))]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], ["conv_id", *longs, "audit", "pieces"])

    pieces = "array<struct<frag:long, piece:string, before:long, odd:boolean>>"
    return whole.mapInArrow(run, f"conv_id {kind}, {', '.join(f'{c} long' for c in longs)}, audit string, pieces {pieces}")


def _placed(before: int, odd: bool) -> str:
    """The role of the output turn with so many turns before it, where it is not the turn's own."""
    return "user" if before % 2 == odd else "assistant"


def _replayed(batch_rows) -> Iterator[tuple]:
    """(conv_id, role, text) of the repaired turns, and (conv_id, None, None) where a conversation ends; rows in order."""
    conv, open_, piece, at, before, odd = None, False, "", 0, 0, False

    def inserted():
        nonlocal at, before
        while at < len(piece) and piece[at] == "I":
            yield conv, _placed(before, odd), ""
            at, before = at + 1, before + 1

    for row in batch_rows:
        if not open_ or row["conv_id"] != conv:
            if open_:
                yield from inserted()
                yield conv, None, None
            conv, open_, piece, at, before = row["conv_id"], True, "", 0, 0
        if row["piece"] is not None:  # the first turn of a fragment
            yield from inserted()
            piece, at, before, odd = row["piece"], 0, row["before"], row["odd"]
        if row["fault"] == "none":
            continue
        yield from inserted()
        letter, at = piece[at], at + 1
        if letter != "D":
            yield conv, row["role"] if letter == "K" else _placed(before, odd), row["text"]
            before += 1
    if open_:
        yield from inserted()
        yield conv, None, None


def _in_order(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The turns of each conversation in one task and in order, the pieces of the audit on the first turn of each fragment."""
    pieces = found.select(F.explode("pieces").alias("x")).select("x.*").withColumn("pos", F.lit(0).cast("long"))
    rows = turns.drop("sums").join(pieces, ["frag", "pos"], "left")
    rows = rows.select("conv_id", "frag", "pos", "role", "text", "fault", "piece", "before", "odd")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "frag", "pos")


def _rows(batches) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def parsed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The fragments and the results of ``turns`` (conv_id, turn, role, text, present), written."""
    cut = stash(fragments(turns), "turns")
    return cut, stash(results(cut), "repairs")


def repaired_turns(turns: DataFrame) -> DataFrame:
    """conv_id, position, role, text of the repaired conversations; ``turns`` as in ``repair``."""
    cut, found = parsed(turns)
    rows = _in_order(cut, found)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        out, position = [], 0
        own = pa.schema([("conv_id", batch_type), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        for conv, role, text in _replayed(_rows(batches)):
            if role is None:
                position = 0
                continue
            out.append({"conv_id": conv, "position": position, "role": role, "text": text})
            position += 1
            if len(out) == 256:
                yield pa.RecordBatch.from_pylist(out, own)
                out = []
        yield pa.RecordBatch.from_pylist(out, own)

    batch_type = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    return rows.mapInArrow(run, f"conv_id {kind}, position long, role string, text string")


def repair(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per conversation.

    ``turns`` holds conv_id (long, int or string), turn, role, text and present; rows without ``present`` only name
    their conversation.  Turns are taken by turn, nulls first, then role and md5 of the text.  A turn's first fault counts:
    blank (nothing but white space), duplicate (role and text seen earlier), truncated (its last character is not . ! or ?).
    ``illegal`` counts neighbours whose role initials are not su, ua or au; ``gaps`` the turn numbers that are missing.
    The audit is the cheapest string of edits (least in ASCII order among equals) after which the initials of the roles
    read ``(s?(ua)+)?``; the digest is that of the repaired ``role:text`` lines.

    A null conv_id is a conversation of its own; null roles and texts are one space, empty texts blank, repeated rows
    duplicates.  A conversation without turns has zeros, no edits and the digest of nothing; an empty table gives no row.
    Other columns are not read.
    """
    cut, found = parsed(turns)
    rows = _in_order(cut, found)
    kind = rows.schema["conv_id"].dataType.simpleString()
    batch_type = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()

    def run(batches):
        digest, first, out = hashlib.sha256(), True, []
        own = pa.schema([("conv_id", batch_type), ("repaired_sha256", pa.string())])
        for conv, role, text in _replayed(_rows(batches)):
            if role is None:
                out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                digest, first = hashlib.sha256(), True
            else:
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            if len(out) == 1024:
                yield pa.RecordBatch.from_pylist(out, own)
                out = []
        yield pa.RecordBatch.from_pylist(out, own)

    digests = rows.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string").withColumnRenamed("conv_id", "_c")
    out = found.drop("pieces").join(digests, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
