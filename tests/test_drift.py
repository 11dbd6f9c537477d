"""Drift with a path against a plain recursive comparison."""

import json
import random

from corpus_audit.operators import drift


def plain(a, b, path=""):
    """(path, problem) by recursion; numbers by value, booleans are no numbers."""
    kind = lambda x: "number" if isinstance(x, (int, float)) and not isinstance(x, bool) else type(x).__name__
    if kind(a) != kind(b):
        return [(path, "kind")]
    if isinstance(a, dict):
        out = []
        for k in (a.keys() | b.keys()) - {"generated_at"}:
            at = f"{path}/{k.replace('~', '~0').replace('/', '~1')}"
            out += [(at, "only_left")] if k not in b else [(at, "only_right")] if k not in a else plain(a[k], b[k], at)
        return out
    if isinstance(a, list):
        out = []
        for i in range(max(len(a), len(b))):
            at = f"{path}/{i}"
            out += [(at, "only_left")] if i >= len(b) else [(at, "only_right")] if i >= len(a) else plain(a[i], b[i], at)
        return out
    return [] if a == b else [(path, "differs")]


def value(rng, depth=0):
    pick = rng.random()
    if depth < 3 and pick < 0.35:
        return {rng.choice(["a", "b", "c/d", "~e", "generated_at", "x.y"]): value(rng, depth + 1) for _ in range(rng.randint(0, 4))}
    if depth < 3 and pick < 0.55:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([1, 2, 1.5, 1.0, -3, True, False, None, "", "t", "中", 10**18, 10**18 + 1])


def mutated(rng, x):
    if rng.random() < 0.12:
        return value(rng, 2)
    if isinstance(x, dict):
        return {k: mutated(rng, v) for k, v in x.items() if rng.random() > 0.08}
    if isinstance(x, list):
        return [mutated(rng, v) for v in x] + ([7] if rng.random() < 0.1 else [])
    return x


def test_drift_equals_a_recursive_comparison(spark):
    rng = random.Random(21)
    left = {k: value(rng) for k in range(120)}
    right = {k: mutated(rng, v) for k, v in left.items()}
    frame = lambda d, extra: spark.createDataFrame([(k, json.dumps(v)) for k, v in d.items()] + extra, "k long, j string")
    got = drift.value_drift(
        frame(left, [(900, "{}"), (902, "{broken"), (903, None)]), frame(right, [(901, "[]"), (902, "{}"), (903, "{}")]), "k", "j"
    ).collect()
    want = [(k, *p) for k in left for p in plain(left[k], right[k])]
    want += [(900, "", "only_left"), (901, "", "only_right"), (902, "", "unreadable"), (903, "", "unreadable")]
    assert sorted((r.k, r.path, r.problem) for r in got) == sorted(want)
    one = next(r for r in got if r.problem == "only_left" and r.k == 900)
    assert (one.left, one.right) == ("{}", None)


def test_nothing_to_compare(spark):
    none = spark.createDataFrame([], "k long, j string")
    assert drift.value_drift(none, none, "k", "j").collect() == []
    same = spark.createDataFrame([(1, '{"a": 1, "generated_at": 2}')], "k long, j string")
    other = spark.createDataFrame([(1, '{"generated_at": 3, "a": 1.0}')], "k long, j string")
    assert drift.value_drift(same, other, "k", "j").collect() == []
    assert [r.path for r in drift.value_drift(same, other, "k", "j", ignore=[]).collect()] == ["/generated_at"]


def test_a_round_matches_entries_inside_their_row(spark, monkeypatch):
    from pyspark.sql import functions as F

    from corpus_audit.operators import drift

    plans, keep = [], drift.written
    monkeypatch.setattr(drift, "written", lambda df, name: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), keep(df, name))[1])
    left = spark.createDataFrame([(1, '{"a": [1, null, {"x/y": 1e0}], "b": null, "s": 2}')], "k long, j string")
    right = spark.createDataFrame([(1, '{"a": [1.0, 2, {"x/y": 1, "z~": 3}, 4], "c": null, "s": "2"}')], "k long, j string")
    out = drift.value_drift(left, right, "k", "j").select("path", "problem", F.col("left").alias("l"), F.col("right").alias("r")).collect()
    assert sorted(tuple(x) for x in out) == [
        ("/a/1", "kind", "null", "2"), ("/a/2/z~0", "only_right", None, "3"), ("/a/3", "only_right", None, "4"),
        ("/b", "only_left", "null", None), ("/c", "only_right", None, "null"), ("/s", "kind", "2", '"2"'),
    ]
    assert len(plans) > 2 and not any("Join" in p for p in plans[1:])  # each round joined both sides before
