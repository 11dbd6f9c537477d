"""Chosen Path near-duplicates against all pairs."""

import random

import numpy as np
import pytest
from test_llm_tables import brute_components, near_copies

from corpus_audit.llm import chosen_path
from corpus_audit.llm.jaccard import Shingler

SCHEMA = "doc_id long, text string, node string, path string, n int"


def found(spark, rows, **how):
    frame = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA)
    out = chosen_path.near_duplicates(frame, **how).drop("text_hash")
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def wanted(rows, n, share):
    return sorted(((*r, r[0] == r[2]) for r in brute_components(rows, n, share)), key=str)


@pytest.mark.parametrize(("seed", "small"), [(11, 1 << 21), (13, 3)])
def test_groups_equal_all_pairs(spark, monkeypatch, seed, small):
    """With few pairs allowed in an exhaustive node, large nodes go down several steps."""
    monkeypatch.setattr(chosen_path, "SMALL", small)
    rows = near_copies(seed, 60) + [(5000, None), (5001, ""), (5002, " \t"), (5003, "One"), (5004, "one"), (5005, "Ünï ünï"), (5004, "one")]
    assert found(spark, rows, words=5, share=85) == wanted(rows, 5, 85)


def test_large_group_of_unlike_copies(spark, monkeypatch):
    """A third of the rows stem from one text but are too far apart to link with one another, but for a few."""
    monkeypatch.setattr(chosen_path, "SMALL", 64)
    rng = random.Random(3)
    word = lambda: f"w{rng.randint(0, 9000)}"
    first = [word() for _ in range(150)]
    rows = []
    for k in range(60):
        own = list(first)
        for _ in range(rng.choice([0, 1, 2, 5, 8])):
            own[rng.randrange(len(own))] = word()
        rows.append((k, " ".join(own)))
    passage = " ".join(first[:30])
    rows += [(k, f"{passage} {' '.join(word() for _ in range(60))}") for k in range(60, 120)]
    rows += [(k, " ".join(word() for _ in range(80))) for k in range(120, 160)]
    assert found(spark, rows) == wanted(rows, 5, 85)


def test_empty_tables_and_repeated_ids(spark):
    assert found(spark, []) == []
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "A B c d e f"), (2, "q r s t u v w")]
    assert found(spark, rows) == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (2, 3, 2, True)], key=str)


def test_two_sets_meet_in_an_order_as_often_as_they_are_similar():
    rng = np.random.default_rng(4)
    both = rng.integers(0, 2**63, 170, dtype=np.uint64)
    a = np.concatenate([both, rng.integers(0, 2**63, 15, dtype=np.uint64)])
    b = np.concatenate([both, rng.integers(0, 2**63, 15, dtype=np.uint64)])
    choose, start = chosen_path.Chooser(85), chosen_path.roots(2000)
    x, y = choose.down(a, start), choose.down(b, start)
    assert 0.82 < (x == y).mean() < 0.88
    assert 1.14 < len(x) / 2000 < 1.22  # 1 / 0.85 orders a node
    # a pair that stays together in a tree with probability p a step is found by the trees that are asked for
    trees = chosen_path.trees_for(0.9999, 85)
    tree = [set(x[k::2000]) & set(y[k::2000]) for k in range(2000)]
    assert (1 - np.mean([bool(t) for t in tree])) ** trees < 1e-4


def test_order_of_elements_and_blocks_do_not_matter():
    own = Shingler(5)(b" ".join(b"w%d" % k for k in range(3000)))
    choose, paths = chosen_path.Chooser(85), chosen_path.roots(500)
    assert (choose.down(own, paths) == choose.down(own[::-1], paths)).all()
    assert (choose.down(own, paths)[:3] == [choose.down(own, paths[k : k + 1])[0] for k in range(3)]).all()
