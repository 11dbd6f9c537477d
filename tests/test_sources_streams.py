"""Readers, writers and streams over temporary folders."""

import datetime as dt
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_audit import session
from corpus_audit.plans import load_all
from corpus_audit.plans.registry import QUERIES
from corpus_audit.sources import digests, files
from corpus_audit.streaming import monitor


def test_tree_manifest_artifacts_and_digests(spark, tmp_path):
    (tmp_path / "t/15040").mkdir(parents=True)
    (tmp_path / "t/15040/index.md").write_text("# 甲\nline", encoding="utf-8")
    (tmp_path / "t/plan.extracted.md").write_text("skip", encoding="utf-8")
    tree = files.read_tree(spark, str(tmp_path / "t")).collect()
    assert [(r.path, r.text) for r in tree] == [("15040/index.md", "# 甲\nline")]

    csv = tmp_path / "m.csv"
    csv.write_text("﻿type,source_pdf\nx,a.pdf\n", encoding="utf-8")
    rows, found = files.read_manifest(spark, str(csv))
    assert rows.first().type == "x" and found.count() == 6

    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text('{"k": 1}')
    (tmp_path / "j/b.json").write_text("{broken")
    (tmp_path / "j/c.json").write_text("[1]")
    good, bad = files.read_artifacts(spark, str(tmp_path / "j"), T.StructType([T.StructField("k", T.LongType())]))
    assert [r.k for r in good.collect()] == [1] and sorted(r.message for r in bad.collect()) == ["not an object", "undecodable"]

    (tmp_path / "b").mkdir()
    oid = "a" * 64
    (tmp_path / "b/p.pdf").write_text(f"version https://git-lfs.github.com/spec/v1\noid sha256:{oid}\nsize 3\n")
    (tmp_path / "b/q.pdf").write_bytes(b"\x00\xffdata")
    digests = {r.path.rsplit("/", 1)[1]: r.digest for r in files.file_digest(spark, str(tmp_path / "b")).collect()}
    assert digests == {"p.pdf": oid, "q.pdf": hashlib.sha256(b"\x00\xffdata").hexdigest()}


def test_canonical_output_is_reproducible(spark, tmp_path):
    df = spark.createDataFrame([(2, ["b", "a"]), (1, []), (3, None)], "k int, v array<string>")
    for name, parts in (("x", 1), ("y", 5)):
        files.write_canonical(df.repartition(parts), ["k"], str(tmp_path / name))
    read = lambda n: "".join(p.read_text() for p in sorted((tmp_path / n).glob("part-*")))
    assert read("x") == read("y") == '{"k":1,"v":[]}\n{"k":2,"v":["a","b"]}\n{"k":3,"v":null}\n'


def test_outputs_are_compared_by_their_trees(spark, tmp_path):
    rng = random.Random(6)
    data = [(k, rng.choice("abc"), [rng.choice("xyz") for _ in range(3)]) for k in range(300)] + [(7, "dup", []), (7, "dup", []), (None, "n", None)]
    frame = lambda d, parts: spark.createDataFrame(d, "k long, v string, t array<string>").repartition(parts)
    changed = [(k, "new" if k == 40 else v, t) for k, v, t in data if k != 90] + [(7, "dup", [])]
    shuffled = [(k, v, t[::-1] if t else t) for k, v, t in data]
    for name, (d, parts) in {"a": (data, 2), "b": (shuffled, 5), "c": (changed, 3), "none": ([], 1)}.items():
        digests.write_digested(frame(d, parts), ["k"], str(tmp_path / name), depth=1)
    at = lambda n: str(tmp_path / n)
    root = {n: digests.root_digest(spark, at(n)) for n in ("a", "b", "c", "none")}
    assert root["a"] == root["b"] != root["c"] and root["none"] is None
    texts = lambda n: {p.parent.name: [r.json for r in spark.read.parquet(str(p)).collect()] for p in (tmp_path / n / "rows").glob("leaf=*/*.parquet")}
    assert texts("a") == texts("b")
    assert digests.differing_leaves(spark, at("a"), at("b"), 1) == []
    assert digests.output_difference(spark, at("a"), at("b"), ["k"], "k bigint", 1).collect() == []
    assert 1 <= len(digests.differing_leaves(spark, at("a"), at("c"), 1)) <= 3  # a changed, a dropped and a repeated row: of 16 folders
    got = digests.output_difference(spark, at("a"), at("c"), ["k"], "k bigint", 1).collect()
    assert sorted((r.k, r.problem) for r in got) == [(7, "differs"), (40, "differs"), (90, "only_left")]
    assert {r.problem for r in digests.output_difference(spark, at("none"), at("a"), ["k"], "k bigint", 1).collect()} == {"only_right"}


def probes(spark, data):
    ts = lambda m: dt.datetime(2024, 1, 1, 12) + dt.timedelta(days=m)
    rows = [(u, ts(d), s, st, h, a) for u, d, s, st, h, a in data]
    return spark.createDataFrame(rows, "url string, ts timestamp, seq long, status string, content_hash string, authoritative boolean")


HISTORY = [
    ("http://h.cn/a", 0, 1, "ok", "h1", True), ("http://h.cn/a", 1, 2, "inconclusive", None, True), ("http://h.cn/a", 2, 3, "dead", None, True),
    ("http://h.cn/a", 3, 4, "ok", "h1", True), ("http://h.cn/a", 4, 5, "ok", "h2", True), ("http://h.cn/b", 0, 6, "inconclusive", None, False),
    ("http://h.cn/b", 3, 7, "ok", None, False), ("http://h.cn/b", 4, 8, "dead", None, False),
]
CHANGES = [(1, "new"), (3, "went_dead"), (4, "recovered"), (5, "content_changed"), (6, "new"), (8, "went_dead")]


def feed(spark, tmp_path, batches, **how):
    """One run of the stream per batch, then a heartbeat far ahead; the changes as (seq, change)."""
    schema = probes(spark, HISTORY).schema
    (tmp_path / "in").mkdir(exist_ok=True)
    run = lambda: monitor.start_transitions(
        spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "changes"), str(tmp_path / "cp"), beats=str(tmp_path / "beats"), **how
    ).awaitTermination()
    for part in batches:
        probes(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run()
    monitor.heartbeat(spark, str(tmp_path / "beats"), F.lit("2099-01-01"))
    run()
    return sorted((r.seq, r.change) for r in spark.read.parquet(str(tmp_path / "changes")).collect())


def test_stream_in_three_batches_equals_one_batch(spark, tmp_path):
    once, _ = monitor.transitions(probes(spark, HISTORY), monitor.empty_state(spark))
    assert sorted((r.seq, r.change) for r in once.collect()) == CHANGES
    assert feed(spark, tmp_path, [[p for p in HISTORY if lo <= p[1] <= hi] for lo, hi in ((0, 1), (2, 2), (3, 9))]) == CHANGES
    state = {r.url: (r.status, r.content_hash) for r in monitor.current_state(spark, str(tmp_path / "cp")).collect()}
    assert state == {"http://h.cn/a": ("ok", "h2"), "http://h.cn/b": ("dead", None)}


def test_shuffled_late_and_replayed_batches_equal_one_batch(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for k in range(160):
        status = rng.choice(["ok", "ok", "dead", "inconclusive"])
        url = f"http://h.cn/{min(rng.randrange(9), 5)}"  # one url holds a third of the probes
        rows.append((url, k / 8, k, status, f"h{rng.randrange(3)}" if status == "ok" else None, url[-1] in "135"))
    rows += [(None, 3.0, 900, "ok", "h", True)]
    once, _ = monitor.transitions(probes(spark, [r for r in rows if r[0]]), monitor.empty_state(spark))
    want = sorted((r.seq, r.change) for r in once.collect())
    arrival = sorted(rows, key=lambda r: r[1] + rng.random() * 2.5)  # up to two and a half days out of order
    batches = [arrival[k : k + 45] for k in range(0, len(arrival), 45)]
    for k in range(1, len(batches)):
        batches[k] += rng.sample(arrival[: 45 * k], 10)  # seen before
    assert feed(spark, tmp_path, batches, lateness="3 days") == want


def test_a_baseline_to_start_from_and_urls_that_are_forgotten(spark, tmp_path):
    known = spark.createDataFrame([("http://h.cn/a", "dead", None, dt.datetime(2024, 1, 1)), ("http://h.cn/u", "inconclusive", None, dt.datetime(2024, 1, 1))], monitor.STATE_DDL)
    first = [("http://h.cn/a", 0, 1, "ok", "h1", True), ("http://h.cn/u", 0, 2, "ok", "h1", True), ("http://h.cn/z", 0, 3, "ok", "h1", True)]
    later = [("http://h.cn/a", 9, 4, "dead", None, True), ("http://h.cn/z", 30, 5, "dead", None, True)]
    got = feed(spark, tmp_path, [first, later[:1], later[1:]], retention_days=20, initial=known)
    # z was forgotten after 20 days: its later probe is its first again; u never had a definitive probe before
    assert got == [(1, "recovered"), (3, "new"), (4, "went_dead"), (5, "new")]


def test_rot_alerts_as_a_stream(spark, tmp_path):
    data = [(f"http://h.cn/{i}", 0, i, "dead", None, False) for i in range(3)] + [("http://ok.cn/x", 0, 9, "ok", None, False)]
    late = [("http://z.cn/", 40, 99, "ok", None, False)]
    for n, part in enumerate((data, late)):
        probes(spark, part).coalesce(1).write.parquet(str(tmp_path / f"in/p{n}"))
    stream = spark.readStream.schema(probes(spark, data).schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = monitor.rot_alerts(stream).writeStream.format("parquet").outputMode("append")
    query = out.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.host, r.total, r.dead) for r in got] == [("h.cn", 3, 3)]


def test_tree_is_written_a_file_a_row_with_its_name(spark, tmp_path):
    docs = spark.createDataFrame([(f"{i}.txt", f"## 来源\n{i}") for i in range(40)] + [("null.txt", None)], "name string, text string").repartition(5)
    for _ in range(2):  # a second attempt writes the same files
        assert files.write_tree(docs, str(tmp_path / "a b/t")) == 41
        found = {p.name: p.read_text(encoding="utf-8") for p in (tmp_path / "a b/t").iterdir()}
        assert found == {**{f"{i}.txt": f"## 来源\n{i}\n" for i in range(40)}, "null.txt": "\n"}
    assert files.write_tree(docs.limit(0), str(tmp_path / "none")) == 0
    assert list((tmp_path / "none").iterdir()) == []


def test_pages_of_the_intake_land_under_their_ids(spark, tmp_path, monkeypatch):
    load_all()
    pages = [(i, f"http://h{i}.cn/x", f'<a href="/{i}">a</a><a href="/b">b</a>') for i in (*range(7), None)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path / "shared"))
    got = QUERIES["k3_new_documents"](spark, str(tmp_path)).collect()
    assert sorted(p.name for p in tmp_path.glob("shared/intake-*/pages/*")) == sorted([*(f"{i}.txt" for i in range(7)), "null.txt"])
    assert {r.url: r.n_refs for r in got}["http://h3.cn/b"] == 1


def test_new_documents_are_taken_once(spark, tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    run = lambda: monitor.start_link_intake(
        monitor.new_documents(spark, str(folder)), ["来源"], str(tmp_path / "refs"), str(tmp_path / "cp")
    ).awaitTermination()
    (folder / "a.md").write_text("## 来源\nhttp://a.cn/1\n## x\nhttp://no.cn", encoding="utf-8")
    run()
    (folder / "b.md").write_text("## 官方来源\n[b](http://b.cn/2)", encoding="utf-8")
    run()
    got = spark.read.parquet(str(tmp_path / "refs"))
    assert sorted(r.url for r in got.select("url").collect()) == ["http://a.cn/1", "http://b.cn/2"]
    assert got.filter(F.col("section") == "官方来源").count() == 1


def test_contents_are_taken_once_under_any_name(spark, tmp_path):
    folder, state, seen = tmp_path / "docs", str(tmp_path / "state"), {}
    folder.mkdir()

    def put(name, text, age):
        (folder / name).write_bytes(text)
        os.utime(folder / name, (1_700_000_000 + age, 1_700_000_000 + age))

    def take(fail=False):
        def handle(rows, run):
            if fail:
                raise RuntimeError("stopped")
            seen[run] = sorted((r.path.rsplit("/", 1)[1], r.text) for r in rows.collect())

        return seen[monitor.intake_changed(spark, str(folder), state, handle)]

    put("a.md", b"one", 0)
    put("b.md", b"two", 10)
    put("copy.md", b"two", 10)
    assert take() == [("a.md", "one"), ("b.md", "two")]
    assert take() == []
    put("renamed.md", b"one", 20)  # a copy under another name
    put("b.md", b"two", 30)  # only touched
    put("a.md", b"one, changed", 40)
    put("bytes.md", b"\xff\xfe", 41)
    put("c.txt", b"no", 50)
    with pytest.raises(RuntimeError):
        take(fail=True)
    assert take() == [("a.md", "one, changed"), ("bytes.md", None)]  # the failed run is taken again
    put("a.md", b"one", 60)  # back to what it was: known
    assert take() == []
    assert sorted(seen) == [0, 1, 2, 3]
