"""Conversation repair against a search over every sequence of edits, and against one plain pass per conversation."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from corpus_audit.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, frag string, c string"
PATTERN = re.compile(r"(s?(ua)+)?")
NONE = {"", " ", None}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_edit(rows):
    """(cost, audit, lines) of the best of all edits of a short conversation, with up to two insertions at each gap."""
    marks, best = faults(rows), None
    options = []
    for (role, text), mark in zip(rows, marks):
        own = [(3, "D", None)]
        if mark not in ("blank", "duplicate"):
            t = mark == "truncated"
            own += [(t, "K", (role, text)), (2 + t, "R", ("user", text)), (2 + t, "R", ("assistant", text))]
        options.append(own)
    gap = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for edits in itertools.product(*options):
        for gaps in itertools.product(gap, repeat=len(rows) + 1):
            cost = sum(e[0] for e in edits) + 2 * sum(map(len, gaps))
            if best and cost > best[0]:
                continue
            lines, audit = [(r, "") for r in gaps[0]], "I" * len(gaps[0])
            for e, g in zip(edits, gaps[1:]):
                audit += e[1] + "I" * len(g)
                lines += ([e[2]] if e[2] else []) + [(r, "") for r in g]
            if PATTERN.fullmatch("".join(r[:1] or "?" for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def one_pass(rows):
    """The same by a forward pass over all turns, for long conversations."""
    inf = (10**9, "")
    grow = lambda x: [
        x[0],
        x[1],
        min(x[2], *((x[p][0] + 2, x[p][1] + "I") for p in (0, 1, 3))),
        min(x[3], (x[2][0] + 2, x[2][1] + "I"), *((x[p][0] + 4, x[p][1] + "II") for p in (0, 1))),
    ]
    best = grow([(0, ""), inf, inf, inf])
    for (role, _), mark in zip(rows, faults(rows)):
        new = [(c + 3, a + "D") for c, a in best]
        if mark not in ("blank", "duplicate"):
            t, head = int(mark == "truncated"), role[:1]
            for p, q in ((0, 2), (1, 2), (3, 2), (2, 3)):
                keep = head == ("u" if q == 2 else "a")
                new[q] = min(new[q], (best[p][0] + t + 2 * (not keep), best[p][1] + ("K" if keep else "R")))
            if head == "s":
                new[1] = min(new[1], (best[0][0] + t, best[0][1] + "K"))
        best = grow(new)
    return min(best[0], best[3])


def replay(rows, audit):
    kept, odd = 0, sum(x != "D" for x in audit) % 2
    lines, rest = [], iter(rows)
    for x in audit:
        role, text = next(rest) if x != "I" else ("", "")
        if x != "D":
            lines.append((role if x == "K" else "user" if kept % 2 == odd else "assistant", text))
            kept += 1
    return lines


def digest(lines):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()


def expected(conv):
    """From (turn, role, text) in any order."""
    conv = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in conv]
    conv.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).hexdigest()))
    rows, turns = [x[1:] for x in conv], [x[0] for x in conv if x[0] is not None]
    marks, heads = faults(rows), [r[:1] for r, _ in rows]
    cost, audit = one_pass(rows)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:]))
    return (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest(replay(rows, audit)))


def conversation(rng, n):
    rows = []
    for k in range(n):
        role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][k % 2]
        role = rng.choice(["system", "tool", "", None]) if rng.random() < 0.15 else role
        text = rng.choice(["Yes.", "No!", "well", "", " \n", None, f"t{rng.randrange(50)}?", "ünï."])
        rows.append((rng.choice([k, k, k, k + 3, None]), role, text))
    return rows


def run(spark, convs):
    rows = [(c, t, r, x, "f", "c") for c, conv in convs.items() for t, r, x in conv]
    random.Random(0).shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "true AS present")
    return {r[0]: tuple(r)[1:] for r in repair.repair(frame).collect()}


def test_cells_equal_every_sequence_of_edits():
    rng = random.Random(1)
    pool = [("user", "a."), ("assistant", "b."), ("system", "c."), ("user", "d"), ("assistant", ""), ("tool", "e."), ("assistant", "f")]
    for _ in range(60):
        rows = [rng.choice(pool) for _ in range(rng.randint(0, 4))]
        cost, audit, lines = every_edit(rows)
        leaves = [repair.leaf(r[:1] if r[:1] in repair.STEPS else "", f) for (r, _), f in zip(rows, faults(rows))]
        assert repair.cheapest(repair.parse(leaves)) == (cost, audit) == one_pass(rows)
        assert replay(rows, audit) == lines
        # every cut of the span gives the same cell
        for cut in range(1, len(leaves)):
            assert repair.cheapest(repair.join(repair.parse(leaves[:cut]), repair.parse(leaves[cut:]))) == (cost, audit)


@pytest.mark.parametrize("size", [3, 2048])
def test_conversations_equal_a_forward_pass(spark, monkeypatch, size):
    monkeypatch.setattr(repair, "FRAGMENT", size)
    rng = random.Random(size)
    convs = {c: conversation(rng, rng.randint(1, 9)) for c in range(40)}
    convs |= {None: conversation(rng, 6), 900: conversation(rng, 300), 901: [(0, "user", "Hi.")] * 50, 902: [(None, None, None)]}
    got = run(spark, convs)
    assert got == {c: expected(conv) for c, conv in convs.items()}


def test_damage_and_whole_query_on_odd_rows(spark):
    rng = random.Random(7)
    rows = [(c, t, r, x, "f", "c") for c in range(60) for t, r, x in conversation(rng, 5)]
    rows += [(1000 + k, 0, "user", "Only.", "f", "c") for k in range(60)] + [(None, None, None, None, "f", "c")] * 2
    got = {r[0]: tuple(r)[1:] for r in repair.repair(repair.damage(spark.createDataFrame(rows, SCHEMA))).collect()}
    want = {}
    for conv, turn, role, text, *_ in rows:
        own = want.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert any(not v for v in want.values())
    assert got == {c: expected(v) if v else (0, 0, 0, 0, 0, 0, "", digest([])) for c, v in want.items()}


def test_repaired_turns_read_the_pattern(spark):
    rng = random.Random(9)
    rows = [(c, t, r, x, "f", "c", True) for c in range(20) for t, r, x in conversation(rng, 7)]
    out = repair.repaired_turns(spark.createDataFrame(rows, SCHEMA + ", present boolean")).orderBy("conv_id", "position").collect()
    for c in {r.conv_id for r in out}:
        own = [r for r in out if r.conv_id == c]
        assert [r.position for r in own] == list(range(len(own)))
        assert PATTERN.fullmatch("".join(r.role[0] for r in own))


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert repair.repair(repair.damage(frame)).count() == 0
