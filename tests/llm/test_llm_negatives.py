"""Hard negatives against a plain scan of all rows."""

import random
from math import floor

import pytest
from pyspark.sql import functions as F

from corpus_audit.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id string, w string, slot int"


def brute(rows, step, scale=256, low=50, high=95):
    import numpy as np

    ok = []
    for key, v, label in rows:
        if key is None or label is None or v is None or any(x is None or x != x or abs(x) == float("inf") for x in v):
            continue
        ok.append((key, label, [floor(float(np.float32(x)) * scale) for x in v]))
    out = []
    anchors = {}
    for key, label, v in ok:
        if key % step == 0:
            anchors[key] = min(anchors.get(key, (v, label)), (v, label))
    for a, (v, label) in anchors.items():
        scored = [(sum(x * y for x, y in zip(v, c)), -k, lab) for k, lab, c in ok if k != a and len(c) == len(v)]
        scored.sort(reverse=True)
        for p, pk, _ in [s for s in scored if s[2] == label][:5]:
            near = [s for s in scored if s[2] != label and low * p <= 100 * s[0] <= high * p][:3]
            out += [(a, -pk, r + 1, -n[1], p, n[0]) for r, n in enumerate(near)]
    return sorted(out)


def vectors(seed, n, dim=12, labels=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = []
    for k in range(n):
        c = rng.choice(centres)
        rows.append((k, [x + rng.gauss(0, 0.7) for x in c], rng.randrange(labels)))
    return rows


def mined(spark, rows, step):
    frame = spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA)
    out = negatives.hard_negatives(frame, lambda key: key % step == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize(("seed", "small"), [(1, False), (2, True)])
def test_hard_negatives_equal_a_plain_scan(spark, monkeypatch, seed, small):
    if small:  # many blocks of rows and of anchors
        monkeypatch.setattr(negatives, "BLOCK_ROWS", 40)
        monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 5)
    rows = vectors(seed, 300)
    rows += [(k + 1000, v, lab) for k, v, lab in rows[:40]]  # equal vectors under other ids: ties
    rows += [(500, None, 1), (501, [1.0] * 12, None), (None, [1.0] * 12, 1), (510, [float("nan")] * 12, 1)]
    rows += [(520, [None] * 12, 1), (530, [float("inf")] * 12, 1), (540, [0.0] * 12, 1), (550, [2.0], 0), (551, [1.0], 0), (552, [1.5], 1)]
    assert mined(spark, rows, 10) == brute(rows, 10)


def test_repeated_rows_and_ids(spark):
    rows = vectors(3, 60)
    rows += [rows[10]] * 3 + [(20, [9.0] * 12, 0)]  # an id with equal rows, an id with different ones
    got = mined(spark, rows, 10)
    assert [(r[0], r[2], r[4], r[5]) for r in got] == [(r[0], r[2], r[4], r[5]) for r in brute(rows, 10)]


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, [], 10) == []
    assert mined(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 1)], 10) == []
    assert mined(spark, [(0, [1.0, 2.0], 0), (2, [1.0, 2.0], 1)], 10) == []  # no positive


def test_candidates_lose_no_pair_and_leave_dimensions_out():
    import numpy as np

    rng = np.random.default_rng(5)
    rows, anchors = np.floor(rng.normal(0, 60, (400, 32))), np.floor(rng.normal(0, 60, (20, 32)))
    scores = anchors @ rows.T
    for share in (0.3, 0.6, 0.9):
        floors = np.quantile(scores, share, axis=1)
        alive = negatives._candidates(rows, anchors, floors)
        assert alive[scores >= floors[:, None]].all()
    tight = negatives._candidates(rows, anchors, scores.max(1))
    assert tight.sum() < 0.2 * tight.size and (tight.argmax(1) >= 0).all()
