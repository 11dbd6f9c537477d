"""Jaccard join, components, licences, tool calls, top-k, classifiers and the pipeline."""

import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_audit.llm import components, jaccard, licenses, quality, toolcalls, topk, toxicity
from corpus_audit.llm.common import table

SF = "/root/testdata/sf0.001"


def brute_components(rows, n, share):
    """component of each row by comparing all pairs"""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common * 100 >= share * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min(groups[find(i)])) for i in range(len(rows))]


def near_copies(seed, n=70):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "a"]) if rng.random() < 0.2 else f"w{rng.randint(0, 5000)}"
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            body = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 1 + len(body) // 40)):
                body[rng.randrange(len(body)) : rng.randrange(len(body)) + 1] = [word()] if rng.random() < 0.8 else []
                body = body or ["x"]
        else:
            body = [word() for _ in range(rng.choice([1, 3, 6, 15, 40, 120, 400]))]
        rows.append((i * 7 % 1009, " ".join(body)))
    return rows


@pytest.mark.parametrize(("seed", "n", "share", "small"), [(1, 4, 85, 65_536), (2, 5, 80, 0), (3, 2, 60, 4)])
def test_components_match_all_pairs(spark, monkeypatch, seed, n, share, small):
    """With few pairs allowed in a task, buckets go to the second level, and its buckets to slices."""
    rows = near_copies(seed) + [(5000, None), (5001, ""), (5002, " \t"), (5003, "One"), (5004, "one"), (5005, "Ünï ünï")]
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "SLICE", 3)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, node int, component string").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.components(docs, n, share).collect())
    assert got == sorted(brute_components(rows, n, share))


def test_members_that_miss_the_centre_still_meet(spark):
    """One word at the end of many short texts: buckets whose smallest member links with nobody."""
    rng = random.Random(9)
    rows = []
    for i in range(120):
        base = [f"c{k}" for k in range(60)] if i % 3 else [f"d{i}-{k}" for k in range(60)]
        for _ in range(i % 5):
            base[rng.randrange(60)] = f"e{rng.randint(0, 30)}"
        rows.append((i, " ".join(base)))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.components(spark.createDataFrame(rows, "doc_id long, text string"), 1, 85).collect())
    assert got == sorted(brute_components(rows, 1, 85))


def test_similar_sets_share_a_signature():
    rng, enum = np.random.default_rng(4), jaccard.PartEnum(80)
    for _ in range(400):
        size = int(rng.integers(5, 300))
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        drop = int(rng.integers(0, max(1, size // 5) + 1))
        add = int(rng.integers(0, size // 6 + 1))
        b = np.concatenate([a[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)])
        common, union = size - drop, size + add
        if common * 100 >= 80 * union and drop + add:
            assert set(enum(np.unique(a)).tolist()) & set(enum(np.unique(b)).tolist())
            assert set(enum.finer(np.unique(a)).tolist()) & set(enum.finer(np.unique(b)).tolist())


def test_second_level_parts_unlike_sets():
    """Copies of one text that keep three quarters of it share far fewer signatures of the second level."""
    rng, enum = np.random.default_rng(6), jaccard.PartEnum(85)
    first = rng.integers(0, 2**63, 150, dtype=np.uint64)
    copies = [np.unique(np.where(rng.random(150) < 0.75, first, rng.integers(0, 2**63, 150, dtype=np.uint64))) for _ in range(60)]
    meet = lambda sign: sum(bool(set(x.tolist()) & set(y.tolist())) for x, y in combinations([sign(c) for c in copies], 2))
    assert meet(enum.finer) < 0.5 * meet(enum)


def test_third_of_the_rows_in_buckets_of_unlike_sets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 30)
    monkeypatch.setattr(jaccard, "SLICE", 8)
    rng = random.Random(5)
    first = [f"w{rng.randint(0, 9000)}" for _ in range(120)]
    rows = []
    for k in range(60):
        own = list(first)
        for _ in range(rng.choice([0, 1, 3, 6, 9])):
            own[rng.randrange(len(own))] = f"w{rng.randint(0, 9000)}"
        rows.append((k, " ".join(own)))
    rows += [(k, " ".join(f"w{rng.randint(0, 9000)}" for _ in range(60))) for k in range(60, 180)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.components(docs, 4, 85).collect())
    assert got == sorted(brute_components(rows, 4, 85))


def test_filters_leave_columns_of_any_name(spark):
    from corpus_audit.llm import decontaminate, packing

    names = ["_id", "_hash", "_quality", "_toxic", "_holds", "_rank", "_order", "k_id", "node", "component", "l", "r"]
    extra = ", ".join(f"`{n}` long" for n in names)
    rows = [(1, "a b c d e f g", *[5] * len(names)), (2, "a b c d e f g", *[6] * len(names)), (3, None, *[7] * len(names))]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {extra}")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "nothing of this is in any of the documents above")], "item_id long, text string")
    one = jaccard.one_of_each(docs)
    assert one.columns == docs.columns and sorted(tuple(r) for r in one.collect()) == [rows[0], rows[2]]
    for kept in (quality.keep(docs, labels, 0.0), toxicity.keep(docs, labels, 1.1), decontaminate.clean(docs, bench)):
        assert kept.columns == docs.columns
        assert sorted(tuple(r) for r in kept.collect()) == rows
    pieces = spark.createDataFrame([(1, 0, 4, *[8] * len(names)), (2, 0, 4, *[9] * len(names))], f"doc_id long, piece int, length long, {extra}")
    placed = packing.best_two_fit(pieces, 8)
    assert placed.columns == [*pieces.columns, "sequence_id", "offset"]
    got = sorted((r.doc_id, *[r[n] for n in names], r.offset) for r in placed.collect())
    assert [g[:-1] for g in got] == [(1, *[8] * len(names)), (2, *[9] * len(names))] and {g[-1] for g in got} == {0, 4}


def test_one_of_each_keeps_columns_and_one_row(spark):
    rows = near_copies(11, 40) + [(9000, "w1 w2 w3 w4 w5 w6"), (9000, "w1 w2 w3 w4 w5 w6"), (9001, None), (None, "only here with no id at all")]
    docs = spark.createDataFrame([(i, t, "k", 3) for i, t in rows], "doc_id long, text string, _low string, a int")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    found = [(i, c, n) for i, n, c in brute_components([r for r in rows if r[0] is not None], 5, 80)]
    want = sorted({c if n else i for i, c, n in found})
    got = kept.collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == want
    assert sum(r.doc_id is None for r in got) == 1
    assert jaccard.one_of_each(docs.limit(0)).collect() == []


def test_members_meet_where_the_centre_is_ruled_out_for_all(spark):
    # one partition (k = 1): three sets agree in two of its parts, and only the two larger hashes are alike
    shingles, enum, found = jaccard.Shingler(1), jaccard.PartEnum(85), []
    assert enum.partitions(enum.band(6)) == 1
    parts = defaultdict(list)
    for k in range(200):
        parts[int(shingles(f"w{k}".encode())[0] % np.uint64(3))].append(f"w{k}")
    q, r, p = parts[0][0], parts[1][0], parts[2]
    for k in range(0, len(p) - 9, 9):
        texts = [" ".join([q, r, *p[k : k + 4]]), " ".join([q, r, *p[k + 4 : k + 8]]), " ".join([q, r, *p[k + 4 : k + 9]])]
        nodes = [jaccard._node(shingles(t.encode())) for t in texts]
        if nodes[0] < min(nodes[1:]):
            found = list(enumerate(texts, 1))
            break
    assert found
    rows = jaccard.components(spark.createDataFrame(found, "doc_id long, text string"), words=1, share=85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == [(1, 6, 1), (2, 6, 2), (3, 7, 2)]


def test_connected_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(1, 70)] + [(200, 201), (205, 201), (7, 7), (300, 300)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 71)}, 200: 200, 201: 200, 205: 200}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_licences_are_found_and_inherited(spark):
    rows = [
        (1, "p/LICENSE", "Released under the MIT License."),
        (2, "p/a/b/x.txt", "some words\nmore words"),
        (3, "p/a/y.txt", "long text here\nLicensed under CC BY-NC 4.0.\nand so on and on and on and on and on and on and on and on"),
        (4, "p/a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (5, "p/a/b/c/z.txt", None),
        (6, "q/z.txt", ""),
        (7, None, "All rights reserved."),
        (8, None, "nothing"),
        (9, "top.txt", "He was licensed to drive a very old and rusty green bus over the hills."),
        (2, "p/a/b/x.txt", "some words\nmore words"),
        (10, "p/LICENSE.2", "Released under the MIT License."),
        (11, "pp/z.txt", "x"),
    ]
    docs = spark.createDataFrame([(*r, "clash", 1.0) for r in rows], "doc_id long, path string, text string, license string, score double")
    got = sorted((r.doc_id, r.license, r.basis, r.from_path) for r in licenses.scan(docs).collect())
    none = (None, "none", None)
    assert got == sorted([
        (1, "MIT", "own", None), (2, "GPL-3.0", "inherited", "p/a/b/COPYING"), (2, "GPL-3.0", "inherited", "p/a/b/COPYING"),
        (3, "CC-BY-NC-4.0", "own", None), (4, "GPL-3.0", "own", None), (5, "GPL-3.0", "inherited", "p/a/b/COPYING"),
        (6, *none), (7, "proprietary", "own", None), (8, *none), (9, *none), (10, "MIT", "own", None), (11, *none),
    ], key=lambda r: tuple(str(x) for x in r)) or sorted(got, key=str) == sorted([
        (1, "MIT", "own", None), (2, "GPL-3.0", "inherited", "p/a/b/COPYING"), (2, "GPL-3.0", "inherited", "p/a/b/COPYING"),
        (3, "CC-BY-NC-4.0", "own", None), (4, "GPL-3.0", "own", None), (5, "GPL-3.0", "inherited", "p/a/b/COPYING"),
        (6, *none), (7, "proprietary", "own", None), (8, *none), (9, *none), (10, "MIT", "own", None), (11, *none),
    ], key=str)
    assert licenses.scan(docs.limit(0)).collect() == []


def test_licences_without_a_marker_word_or_wrapped_over_lines(spark):
    rows = [
        (1, "m/a.c", "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */\n\nint x;"),
        (2, "c/b.txt", "Dedicated to the public domain."),
        (3, "c/d/e.txt", "nothing of its own"),
        (4, "w/x.txt", "# This work is licensed\n# under the GNU General\n# Public License,\n# version 3.\n#\n# " + "some other words " * 5),
        (5, "w/y.txt", "some use of the others, and more of that"),
        (6, "r/a.txt", "Released under\n\nthe MIT License" + "\n-\n" * 3),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.basis, r.from_path) for r in licenses.scan(docs).collect()}
    assert got == {
        1: ("MPL-2.0", "own", None), 2: ("CC0-1.0", "own", None), 3: ("CC0-1.0", "inherited", "c/b.txt"),
        4: ("GPL-3.0", "own", None), 5: ("GPL-3.0", "inherited", "w/x.txt"), 6: ("MIT", "own", None),
    }


def test_licence_files_stand_for_their_directory_by_name(spark):
    body = "\n\nGranted is a right to deal in it, free of charge, to any person who got a copy of it and its files. " * 20
    rows = [
        (1, "a/LICENSE", "MIT License" + body), (2, "a/b/x.py", "import x"),
        (3, "c/licence.md", "The MIT License" + body), (4, "c/x.py", "import x"),
        (5, "d/license.py", "MIT License" + body), (6, "d/x.py", "import x"),
        (7, "e/COPYING", "no such text"), (8, "e/x.py", "import x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.from_path) for r in licenses.scan(docs).collect()}
    assert got == {
        1: ("MIT", None), 2: ("MIT", "a/LICENSE"), 3: ("MIT", None), 4: ("MIT", "c/licence.md"),
        5: ("MIT", None), 6: (None, None), 7: (None, None), 8: (None, None),
    }


def test_licence_candidates_hold_every_unit_that_reaches_the_threshold(spark):
    rng = random.Random(5)
    words = sorted({w for t in licenses.TEMPLATES.values() for w in t.split()})
    lines = list({" ".join(rng.choices(rng.choice([words, t.split()]), k=rng.randint(1, 12)) + ["x", "y", "z"][: rng.randint(0, 3)]) for t in licenses.TEMPLATES.values() for _ in range(60)})
    rows = spark.createDataFrame([(x,) for x in lines], "line string")
    for threshold in (0.3, 0.6, 0.9):
        reached = {r.line for r in licenses.line_licenses(rows, licenses.TEMPLATES, threshold).collect()}
        kept = {r.line for r in licenses.candidates(rows, licenses.TEMPLATES, threshold).collect()}
        assert reached and reached <= kept and len(kept) < len(lines)


def test_toxicity_sample_draws_and_counts_only_labels_of_given_documents(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400) if i % 4 > 1], "doc_id long, text string")
    for per_class, least in ((40, 40), (1000, 50)):
        sample, n = toxicity.training_sample(docs, labels, "toxic", per_class)
        drawn = {y: sample.where(F.col("y") == y).count() for y in (0, 1)}
        assert drawn == n and min(n.values()) >= least


CALLS = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>, content int"
RESULTS = "conv_id long, call_id string, turn long, content string, name string"
TOOLS = {"f": {"x": ("integer", True), "y": ("string", False)}, "g": {"v": ("number", True), "l": ("array", False)}}


def test_tool_calls_are_linked_ordered_and_validated(spark):
    calls = [
        (1, "a", 0, "f", '{ "y": "é\\n", "x": 1 }', None, 0),
        (1, "d", 1, "g", '{"v": 2.50, "l": [1]}', ["b", "c", "b"], 0),
        (1, "b", 5, "f", '{"x": "1"}', ["a"], 0),
        (1, "c", 4, "f", '{"x": 1, "z": 2}', ["a", "nowhere"], 0),
        (1, "e", 2, "h", "{}", ["d"], 0),
        (1, "p", 7, "g", "[1]", ["q"], 0),
        (1, "q", 8, "g", None, ["p"], 0),
        (1, "r", 9, None, '{"x": 1}', ["q", "a"], 0),
        (1, "s", 9, "f", '{"x": 1}', ["s"], 0),
        (1, "a", 3, "f", '{"x": 9}', ["q"], 0),
        (2, "a", 0, "f", '{"x": null}', [], 0),
        (None, "a", 0, "f", "{}", [], 0),
        (1, None, 0, "f", "{}", [], 0),
    ]
    results = [(1, "a", 2, "second", ""), (1, "a", 1, 'fi"rst', ""), (1, "zz", 1, "lost", ""), (2, "a", 1, None, ""), (1, "d", 4, "", "")]
    out = toolcalls.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), TOOLS).collect()
    by = {(r.conv_id, r.call_id): r for r in out}
    assert len(out) == len(by) == 11
    assert {k[1]: r.level for k, r in by.items() if k[0] == 1} == {"a": 0, "b": 1, "c": 1, "d": 2, "e": 3, "p": None, "q": None, "r": None, "s": 0, "zz": None}
    order = [r.call_id for r in sorted((r for r in out if r.conv_id == 1 and r.kind == "call"), key=lambda r: r.position)]
    assert order == ["a", "s", "c", "b", "d", "e", "p", "q", "r"]
    assert by[1, "a"].n_results == 2 and by[1, "a"].errors == ""
    assert by[1, "a"].message == '{"arguments":{"x":1,"y":"é\\n"},"id":"a","name":"f","result":"fi\\"rst"}'
    assert by[1, "d"].message == '{"arguments":{"l":[1],"v":2.5},"id":"d","name":"g","result":""}'
    assert by[1, "b"].errors == "x is not integer; no result"
    assert by[1, "c"].errors == "unknown z; no call nowhere; no result"
    assert by[1, "e"].errors == "unknown tool; no result"
    assert by[1, "p"].errors == "arguments are not a JSON object; cycle; no result"
    assert by[1, "q"].errors == "arguments are not a JSON object; cycle; no result"
    assert by[1, "r"].errors == "unknown tool; cycle; no result"
    assert by[1, "s"].errors == "no call s; no result"
    assert by[2, "a"].errors == "x is not integer" and by[2, "a"].n_results == 1
    assert by[1, "zz"].kind == "orphan" and by[1, "zz"].errors is None


def test_long_chains_of_calls(spark):
    n = 300
    rng = random.Random(2)
    turns = list(range(n))
    rng.shuffle(turns)
    calls = [(1, f"c{i}", turns[i], "f", '{"x": 1}', [f"c{i - 1}"] if i else [], 0) for i in range(n)]
    out = toolcalls.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), TOOLS).collect()
    assert {r.call_id: (r.level, r.position) for r in out} == {f"c{i}": (i, i + 1) for i in range(n)}
    assert toolcalls.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), TOOLS).collect() == []


def brute_top_k(rows, k, is_query):
    ints = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows]
    out = []
    for q, v in {q: min(w for p, w in ints if p == q) for q, _ in ints if is_query(q)}.items():
        hits = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in ints if c != q and len(w) == len(v))
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(hits[:k])]
    return sorted(out)


def test_top_k_is_exact(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[i % 7][1]) for i in range(300, 330)]  # ties
    rows += [(400, [0.0] * 6), (420, [50.0] * 6), (401, [1.5, -2.0]), (440, [1.0, 1.0]), (460, []), (40, rows[40][1])]
    bad = [(500, None), (None, [1.0] * 6), (520, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (540, [float("nan")] * 6), (560, [float("inf")] * 6)]
    schema = "vec_id long, embedding array<float>, score int, rank int"
    data = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + bad], schema).repartition(3)
    monkeypatch.setattr(topk, "RUN", 16)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 4)
    got = topk.top_k(data, lambda c: c % 20 == 0, k=9, pivots=4, block_rows=60).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_top_k(rows, 9, lambda i: i % 20 == 0)
    few = data.where("vec_id < 5")
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(few, lambda c: c == 0, k=9).collect()) == brute_top_k(rows[:5], 9, lambda i: i == 0)
    assert topk.top_k(data.limit(0), lambda c: c % 20 == 0, k=9).collect() == []


def test_blocks_of_dense_ids_use_most_lanes(spark):
    rows = topk.slotted(spark.range(0, 50 * 40, 1, 3).withColumnRenamed("id", "vec_id"))
    sizes = [r["count"] for r in rows.groupBy(F.pmod("slot", F.lit(50))).count().collect()]
    assert len(sizes) == 50 and max(sizes) < 3 * 40


def test_runs_are_left_out_by_pivots():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 400, (8, 5))
    points = np.floor(np.repeat(centres, 200, 0) + rng.normal(0, 5, (1600, 5))).astype(np.int64)
    own = topk._Pivots(list(points[::200]), 5, float((points.astype(float) ** 2).sum(1).max()))
    far = own.distances(points.astype(float), True)
    order = np.lexsort((far.min(1), far.argmin(1)))
    points, far, starts, asked = points[order], far[order], np.arange(0, 1600, topk.RUN // 8), []
    real = topk._exact
    topk._exact = lambda a, b: asked.append(a.shape[0] * b.shape[0]) or real(a, b)
    try:
        names, vec, score = topk._chunk(
            np.arange(1600), points, starts, np.minimum.reduceat(far, starts), np.maximum.reduceat(far, starts),
            np.arange(5000, 5010), points[:1600:160], np.full(10, topk._NONE), own, 4,
        )
    finally:
        topk._exact = real
    every = points[:1600:160] @ points.T
    for n in range(10):
        want = sorted(((-s, i) for i, s in enumerate(every[n])))[:4]
        assert [(-s, v) for v, s in zip(vec[names == 5000 + n], score[names == 5000 + n])] == want
    assert sum(asked) < 10 * 1600


def scored(spark, query):
    import __spark_entry__

    rows = __spark_entry__.queries()[query](spark, "/root/testdata/sf0.01")
    labels = table(spark, "/root/testdata/sf0.01", "labels").collect()
    got = {r.doc_id: r for r in rows.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 for r in got.values())
    return [(got[r.doc_id], r) for r in labels if got[r.doc_id].held_out]


def test_quality_on_held_out_labels(spark):
    pairs = scored(spark, "op4_quality_discriminant")
    assert np.mean([a.predicted == b.quality for a, b in pairs]) > 0.95


def test_toxicity_on_held_out_labels(spark):
    pairs = scored(spark, "op6_toxicity_instances")
    assert np.mean([a.predicted == b.toxic for a, b in pairs]) > 0.9


ODD = [(1, None), (2, ""), (3, "!!"), (4, "word " * 40000), (4, "x"), (None, "no id")]


def test_classifiers_without_labels_and_on_odd_texts(spark):
    docs = spark.createDataFrame([(i, t, 9.0, "s") for i, t in ODD], "doc_id long, text string, score double, y string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    real = table(spark, SF, "labels").union(spark.createDataFrame([(None, 1, 1), (10**9, None, None)], "doc_id long, quality int, toxic int"))
    for labels, source in ((none, docs), (real, table(spark, SF, "documents"))):
        model = quality.fit(source, labels)
        out = quality.score(docs, model)
        assert sorted(out.columns) == sorted(docs.columns) and out.count() == len(ODD)
        assert all(0 <= r.score <= 1 for r in out.collect())
        assert quality.score(docs.limit(0), model).collect() == []
        bad = toxicity.fit(source, labels)
        out = toxicity.score(docs, bad, offending="where").collect()
        assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)
        assert [r.score for r in out if r.doc_id in (1, 2)] == [0.0, 0.0]
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}


def test_offending_sentences_are_located(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, labels = [], []
    for i in range(300):
        parts = [" ".join(word() for _ in range(6)) for _ in range(5)]
        if i % 2:
            parts[i % 5] += " zoundsface"
        rows.append((i, ". ".join(parts) + "."))
        labels.append((i, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    for r in toxicity.score(docs, model, offending="where").collect():
        assert (r.score >= 0.7) == bool(r.doc_id % 2)
        assert ["zoundsface" in s.sentence for s in r["where"]] == [True] * (r.doc_id % 2)
        assert all(r.text.lower()[s.start : s.end] == s.sentence for s in r["where"])


def test_pipeline_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES][2] == "n-gram Jaccard join" and len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = kept, corpus_pipeline.stash(stage(spark, docs, SF), "stage")
        kept = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns and kept <= before and len(kept) > 0.6 * len(before), name
        if name == "n-gram Jaccard join":
            found = brute_components([(i, text[i]) for i in sorted(before)], 5, 80)
            assert kept == {c for _, _, c in found}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == kept
    empty = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, empty, SF)
        assert result.count() == 0
        empty = result if "text" in result.columns else empty


def marked_documents(seed, n=400):
    """Documents of two kinds that differ in words and layout, with labels of both kinds."""
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        good = rng.random() < 0.6
        words = [rng.choice(["alpha", "beta", "gamma", "delta"] if good or rng.random() < 0.5 else ["BUY!!", "###", "x1x", "click"]) for _ in range(rng.randint(5, 80))]
        text = "".join(w + rng.choice([" ", " ", ". ", "\n"]) for w in words)
        rude = rng.random() < 0.3
        if rude:
            text += f". You {rng.choice(['vile', 'rotten'])} fool."
        text += " More here."
        docs.append((k, text))
        if rng.random() < 0.9:
            labels.append((k, int(good), int(rude)))
    return docs, labels


def test_discriminant_equals_a_direct_fit(spark):
    docs, labels = marked_documents(31)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit(frame, marks)
    own = {k: zlib.crc32(str(k).encode()) % 3 != 1 for k, _ in docs}
    texts = dict(docs)
    train = [(quality.statistics(texts[k]), q) for k, q, _ in labels if own[k]]
    x, y = np.array([t for t, _ in train]), np.array([q for _, q in train])
    center, scale = x.mean(0), np.sqrt(np.maximum(x.var(0), 1e-6))
    z = (x - center) / scale
    covs = [np.cov(z[y == c].T) for c in (0, 1)]
    within = sum((np.sum(y == c) - 1) * covs[c] for c in (0, 1)) / (len(y) - 2)
    d, all_z = z.shape[1], (np.array([quality.statistics(t) for _, t in docs]) - center) / scale
    density = []
    for c in (0, 1):
        cov = (1 - quality.POOLED) * covs[c] + quality.POOLED * within
        cov = (1 - quality.RIDGE) * cov + quality.RIDGE * (np.trace(cov) / d + 1e-3) * np.eye(d)
        gap = all_z - z[y == c].mean(0)
        density.append(-0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap) - 0.5 * np.linalg.slogdet(cov)[1])
    slope, shift = model.line
    want = 1 / (1 + np.exp(-(slope * np.arcsinh(density[1] - density[0]) + shift)))
    got = {r.doc_id: r.score for r in quality.score(frame, model).collect()}
    assert np.allclose([got[k] for k, _ in docs], want, atol=1e-6)
    held = [(got[k] >= 0.5) == bool(q) for k, q, _ in labels if not own[k]]
    assert slope > 0 and np.mean(held) > 0.8


def test_noisy_or_equals_a_plain_loop(spark):
    docs, labels = marked_documents(32)
    frame = spark.createDataFrame(docs + [(9000, None), (9001, "")], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame, marks)

    def plain(text):
        low, clean, spans = text.lower(), 1.0, []
        for a, b in toxicity.sentences(low):
            z = model.bias + sum(model.weights.get(f, 0.0) for w in set(toxicity._WORD.findall(low, a, b)) for f in toxicity.features(w))
            p = 1 - np.exp(-np.logaddexp(0, min(z, 500.0)))
            clean *= 1 - p
            if p >= 0.5:
                spans.append((a, b, low[a:b]))
        return 1 - clean, spans

    got = {r.doc_id: r for r in toxicity.score(frame, model, offending="found").collect()}
    for k, text in docs:
        value, spans = plain(text)
        assert got[k].score == pytest.approx(value, abs=1e-9)
        assert [(s.start, s.end, s.sentence) for s in got[k].found] == spans
    assert got[9000].score == got[9001].score == 0 and got[9000].found == []
    # every held-out toxic document is found, and its sentence is the one that offends
    for k, _, toxic in labels:
        if zlib.crc32(str(k).encode()) % 3 == 1:
            assert (got[k].score >= 0.7) == bool(toxic)
            assert bool(got[k].found) == bool(toxic) and all("fool" in s.sentence for s in got[k].found)


def test_toxicity_recall_on_held_out_labels(spark):
    pairs = scored(spark, "op6_toxicity_instances")
    toxic = [got for got, label in pairs if label.toxic == 1]
    clean = [got for got, label in pairs if label.toxic == 0]
    assert np.mean([g.predicted for g in toxic]) >= 0.75
    assert np.mean([g.predicted for g in clean]) <= 0.01
    assert all(len(g.offending) == g.n_offending for g in toxic + clean)
