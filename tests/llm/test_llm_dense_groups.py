"""Groups with many undecided pairs, and sets that are large for 1,024 hash classes."""

import random

import numpy as np
import pytest
from test_llm_tables import brute_components

from corpus_audit.llm import chosen_path, jaccard


def group(spark, sets, forest=False, key=1):
    """The pairs that one group of the sets, each a component of its own, gives."""
    nodes = [(k, len(s), jaccard.parity_of(s).tolist()) for k, s in enumerate(sets)]
    nodes = spark.createDataFrame(nodes, "node long, n long, parity array<long>")
    pairs = len(sets) * (len(sets) - 1) // 2
    members = spark.createDataFrame([(key, k, k, pairs) for k in range(len(sets))], "sig long, node long, component long, pairs long")
    return {(r.a, r.b) for r in jaccard.exhaustive(members, "sig", nodes, 80, **({"forest": True} if forest else {})).collect()}


def drawn(rng, size):
    return np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))


def test_dense_group_gives_a_spanning_forest(spark):
    rng = np.random.default_rng(1)
    copies = [np.unique(np.concatenate([first[k % 5 :], drawn(rng, 2)])) for first in (drawn(rng, 200), drawn(rng, 200)) for k in range(40)]
    assert len(group(spark, copies)) == 2 * 40 * 39 // 2
    edges = group(spark, copies, forest=True)
    assert len(edges) == 2 * 39
    reached = {0, 40}
    for _ in copies:
        reached |= {x for e in edges if reached & set(e) for x in e}
    assert reached == set(range(80)) and all((a < 40) == (b < 40) for a, b in edges)


def test_large_unlike_sets_are_ruled_out_by_their_parities(spark):
    rng = np.random.default_rng(2)
    one = drawn(rng, 4000)
    half = np.concatenate([one[:2000], drawn(rng, 2000)])
    like = np.unique(np.concatenate([one[:3700], drawn(rng, 500)]))  # of twice as many classes
    sets = [one, np.unique(half), drawn(rng, 4200), like]
    assert len({len(jaccard.parity_of(s)) for s in sets}) == 2
    assert group(spark, sets) == {(0, 3)}
    nodes = spark.createDataFrame([(k, len(s), jaccard.parity_of(s).tolist()) for k, s in enumerate(sets)], "node long, n long, parity array<long>")
    pairs = spark.createDataFrame([(a, b) for b in range(4) for a in range(b)], "a long, b long")
    assert {tuple(r) for r in jaccard._promising(pairs, nodes, 80).collect()} == {(0, 3)}


@pytest.mark.parametrize("dense", [0, 1024])
def test_dense_groups_equal_all_pairs(spark, monkeypatch, dense):
    """Copies that miss their centre, and long ones on both sides of 1,024 shingles."""
    monkeypatch.setattr(jaccard, "DENSE", dense)
    rng = random.Random(8)
    word = lambda: f"w{rng.randint(0, 9000)}"
    rows = []
    for size, copies, most in ((120, 60, 9), (1030, 14, 60)):
        first = [word() for _ in range(size)]
        for _ in range(copies):
            own = list(first)
            for _ in range(rng.randint(0, most)):
                at = rng.randrange(len(own))
                own[at : at + 1] = [word()] * rng.randint(0, 2)
            rows.append((len(rows), " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for found in (jaccard.components(docs, 4, 85), chosen_path.near_duplicates(docs, 4, 85)):
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
        assert got == sorted(brute_components(rows, 4, 85))
