"""Operators on inline rows: edge cases, one mutation per gate, brute force where there is no SQL."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpus_audit import scale
from corpus_audit.operators import catalog, content, evidence, gates, links, maturity, model, schedule, structure
from corpus_audit.sources import files


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def lines_of(spark, text, key="d"):
    return files.read_lines(spark.createDataFrame([(key, text)], "doc string, text string"), "doc")


# -- scale helpers ------------------------------------------------------------------------------

def test_ranked_and_neighbors_equal_plain_windows_on_a_hot_key(spark):
    rng = random.Random(7)
    data = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}", n) for n in rng.sample(range(5000), 900)]
    df = spark.createDataFrame(data, "k string, n long").repartition(7)
    ranked = scale.ranked(df, ["k"], [F.col("n")], F.floor(F.col("n") / 100), "r")
    near = scale.neighbors(df, ["k"], ["n"], ["n"], F.floor(F.col("n") / 100), "p", "f")
    want_rank, want_near = [], []
    for k in {k for k, _ in data}:
        mine = sorted(n for kk, n in data if kk == k)
        want_rank += [(k, n, i + 1) for i, n in enumerate(mine)]
        want_near += [(k, n, mine[i - 1] if i else -1, mine[i + 1] if i + 1 < len(mine) else -1) for i, n in enumerate(mine)]
    assert rows(ranked, "k", "n", "r") == sorted(want_rank)
    got = near.select("k", "n", F.coalesce("p.n", F.lit(-1)), F.coalesce("f.n", F.lit(-1)))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want_near)


def test_broadcast_is_size_checked(spark):
    small = spark.range(10)
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(scale.broadcast_if_small(small))
    assert not hinted(scale.broadcast_if_small(small, growth=10**9))


# -- content ------------------------------------------------------------------------------------

def overlap(text, source, n=8):
    squeeze = lambda s: "".join(s.split())
    grams = [squeeze(text)[i : i + n] for i in range(len(squeeze(text)) - n + 1)]
    known = {squeeze(source)[i : i + n] for i in range(len(squeeze(source)) - n + 1)}
    return (len(grams), sum(g in known for g in grams))


@pytest.mark.parametrize("slice_chars", [16384, 20])
def test_ngram_overlap_against_brute_force(spark, monkeypatch, slice_chars):
    monkeypatch.setattr(content, "SLICE_CHARS", slice_chars)
    source = "知识点 one two three 😀😀 four five six seven"
    texts = {1: "two three 😀😀 four", 2: "short", 3: "", 4: "zzz one two three 😀😀 four five yyy" * 3, 5: source}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    src = spark.createDataFrame([(source,)], "text string")
    got = {r.id: (r.n_grams, r.n_shared) for r in content.ngram_overlap(df, src, "id").collect()}
    assert got == {i: overlap(t, source) for i, t in texts.items()}
    keyed = content.ngram_overlap(df.withColumn("k", F.col("id") % 2), src.withColumn("k", F.lit(1).cast("long")), "id", key=["k"])
    assert {r.id for r in keyed.filter("n_shared > 0").collect()} <= {1, 3, 5}


SIDES = {"broadcast": {"grams_limit": 2**62}, "filter": {"grams_limit": 0, "filter_limit": 2**62}, "shuffle": {"grams_limit": 0, "filter_limit": 0}}


@pytest.mark.parametrize("side", SIDES)
@pytest.mark.parametrize("key", [None, ["k"]])
def test_overlap_is_the_same_on_every_side(spark, tmp_path, monkeypatch, side, key):
    rng = random.Random(2)
    pick = lambda n: "".join(rng.choice("abcdefgh 中") for _ in range(n))
    sources = [(k % 2, pick(300)) for k in range(6)] + [(0, None), (1, "short")]
    texts = [(i, i % 2, pick(200) + (sources[i % 6][1][50 : 50 + 10 * i] if i % 3 else "")) for i in range(20)] + [(90, 0, None), (91, 1, sources[1][1] * 3)]
    spark.createDataFrame(sources, "k long, text string").coalesce(1).write.parquet(str(tmp_path / "s"))  # a table of known size
    src = spark.read.parquet(str(tmp_path / "s"))
    passed = []
    real = content.pass_filter
    monkeypatch.setattr(content, "pass_filter", lambda *a: passed.append(1) or real(*a))
    got = content.ngram_overlap(spark.createDataFrame(texts, "id long, k long, text string"), src, "id", key=key, **SIDES[side])
    squeeze = lambda t: "".join((t or "").split())
    want = {}
    for i, k, t in texts:
        known = {squeeze(x)[j : j + 8] for g, x in sources if not key or g == k for j in range(len(squeeze(x)) - 7)}
        grams = [squeeze(t)[j : j + 8] for j in range(len(squeeze(t)) - 7)]
        want[i] = (len(grams) if t is not None else None, sum(g in known for g in grams))
    assert {r.id: (r.n_grams, r.n_shared) for r in got.collect()} | {90: (None, 0)} == want
    assert bool(passed) == (side == "filter")


def test_gram_filter_passes_all_of_the_source_and_few_others(spark):
    rows = 3
    full = rows * content.FILTER_WORDS * 64 // content.FILTER_BITS  # as many as it is laid out for
    source = spark.range(full).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("gram"))
    table = content.gram_filter(source, [], rows).cache()
    assert table.count() == rows and {len(r._words) for r in table.collect()} == {content.FILTER_WORDS}
    assert content.pass_filter(source, [], table, rows).count() == full
    others = spark.range(200_000).select(F.concat(F.lit("o"), F.col("id").cast("string")).alias("gram"))
    assert content.pass_filter(others, [], table, rows).count() <= 200_000 * content.FILTER_FALSE
    table.unpersist()


def test_verbatim_run_of_200_passes_and_201_leaks(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefghij 中文") for _ in range(900))
    texts = [(1, "x" * 37 + base[100:300] + "y" * 300), (2, "x" * 51 + base[100:301] + "y" * 300), (3, "q" * 500)]
    df = spark.createDataFrame(texts, "id long, text string")
    src = spark.createDataFrame([(9, base)], "src long, text string")
    assert rows(content.verbatim_windows(df, src, "id", "src"), "id", "pos") == [(2, 52)]


def test_verbatim_windows_against_brute_force_with_copies(spark):
    rng = random.Random(11)
    part = ["".join(rng.choice("ab c") for _ in range(rng.randrange(30, 90))) for _ in range(6)]
    texts = [(i, "".join(rng.choice(part) for _ in range(rng.randrange(1, 9)))) for i in range(40)] + [(40, "a" * 150), (41, "a" * 170)]
    size = 60
    df = spark.createDataFrame(texts, "id long, text string")
    got = content.copied_windows(df, "id", size=size)
    where = {}
    for i, t in texts:
        for p in range(len(t) - size + 1):
            where.setdefault(t[p : p + size], set()).add(i)
    want = [(i, p + 1) for i, t in texts for p in range(len(t) - size + 1) if where[t[p : p + size]] - {i}]
    assert rows(got, "id", "pos") == sorted(want)


def test_copied_windows_travel_as_strips(spark, monkeypatch):
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(3000)) for _ in range(3)]
    texts = [(i, base[i % 3]) for i in range(30)] + [(30, base[0][:1400] + "#" + base[0][1400:]), (31, base[1]), (31, base[2] + "x"), (None, base[0]), (32, None)]
    sizes, keep = [], content.written
    monkeypatch.setattr(content, "written", lambda df, name: (lambda out: (sizes.append(out.count()), out)[1])(keep(df, name)))
    got = rows(content.copied_windows(spark.createDataFrame(texts, "id long, text string"), "id"), "id", "pos")
    want = [(i, p + 1) for i, t in texts if i is not None and t for p in range(len(t) - 200) if not (i == 30 and 1200 <= p <= 1400) and not (i == 31 and p + 200 == 3000)]
    assert got == sorted(want)
    assert sum(sizes) < len(want) / 20  # one row a window before


def greedy(points, declared):
    types = {p: content.PREFERRED_TYPE.get(r) if content.PREFERRED_TYPE.get(r) in declared else declared[0] for p, r in points}
    for kind in [d for d in declared if d not in set(types.values())]:
        for p in reversed([p for p, _ in points]):
            if list(types.values()).count(types[p]) > 1:
                types[p] = kind
                break
    return types


def test_assign_types_equals_the_greedy_definition(spark):
    rng = random.Random(5)
    declared = ["单项选择题", "简答题", "论述题", "名词解释题", "材料题"]
    units = {u: [(p, rng.choice(["识记", "领会", "应用", None])) for p in range(rng.randrange(1, 14))] for u in range(60)}
    df = spark.createDataFrame([(u, p, r) for u, ps in units.items() for p, r in ps], "u long, pos long, requirement string").repartition(5)
    want = sorted((u, p, t) for u, ps in units.items() for p, t in greedy(ps, declared).items())
    assert rows(content.assign_types(df, "u", declared), "u", "pos", "question_type") == want


@pytest.mark.parametrize(
    "counts, family, n, verdict",
    [
        ({"A": 105, "B": 70, "C": 17, "D": 2}, "single_choice", 194, "biased"),
        ({"A": 24, "B": 42, "C": 41, "D": 40}, "single_choice", 147, "ok"),
        ({"正确": 4, "错误": 6}, "judgement", 10, "ok"),
        ({"A": 4, "B": 2, "C": 2, "D": 2}, "single_choice", 10, "ok"),
        ({"A": 9}, "single_choice", 9, "insufficient-sample"),
    ],
)
def test_answer_distribution_golden_values(spark, counts, family, n, verdict):
    data = [("e", family, label) for label, c in counts.items() for _ in range(c)]
    got = content.answer_distribution(spark.createDataFrame(data, "e string, family string, label string"), "e").first()
    assert (got.n, got.verdict, got.unparseable) == (n, verdict, 0)


def test_unknown_tracking_is_enforced(spark):
    dist = content.answer_distribution(spark.createDataFrame([(e, "single_choice", "A") for e in "abc" for _ in range(12)], "e string, family string, label string"), "e")
    tracked = spark.createDataFrame([("a", True), ("b", None)], "e string, tracked boolean")
    assert rows(content.enforce_scope(dist, tracked, "e"), "entity", "rule") == [("b", "biased"), ("c", "biased")]


def test_validate_blocks_clean_then_one_mutation(spark):
    text = "### 要点梳理\n### 易错点\n" + "x" * 130 + "口诀"
    base = [("c", f"b{i}", k, p, text, "答案：A", "t", "ai_generated", True, "machine_draft") for i, (k, p) in enumerate(
        [("explain", "p1"), ("memorize", "p1"), ("drill", "p1"), ("exam_strategy", None)])]
    ddl = ("c string, block_id string, kind string, point_id string, text_md string, answer_md string, question_type string, "
           "source_kind string, ai_generated boolean, review_state string")
    points = spark.createDataFrame([("c", "p1")], "c string, point_id string")
    types = spark.createDataFrame([("c", "t")], "c string, question_type string")

    def found(data):
        return rows(content.validate_blocks(spark.createDataFrame(data, ddl), points, types, "c"), "rule")

    assert found(base) == []
    assert found(base[:-1]) == [("strategy_count",)]
    broken = [list(b) for b in base]
    broken[2][5] = " "
    assert found([tuple(b) for b in broken]) == [("drill_answer",)]
    assert found([*base, base[0]]) == [("block_id_duplicate",)]


# -- links --------------------------------------------------------------------------------------

def test_fullwidth_semicolon_splits_urls_and_scope_nests(spark):
    text = (
        "# T\n## 来源与引用\nhttp://a.cn/1；http://a.cn/2。\n### 其他\n[x](http://a.cn/3) http://a.cn/3 http://a.cn/3\n"
        "## 练习\nhttp://out.cn\n# 来源\n## sub\nhttp://a.cn/4\n# end\nhttp://out.cn/2"
    )
    scoped = structure.heading_scope(lines_of(spark, text), ["doc"], ["来源"])
    got = rows(links.extract(scoped, ["doc"]), "line_no", "section", "url")
    assert got == [(3, "来源与引用", "http://a.cn/1"), (3, "来源与引用", "http://a.cn/2"), (5, "其他", "http://a.cn/3"), (10, "sub", "http://a.cn/4")]


def probe(spark, data):
    return spark.createDataFrame(data, "url string, status string, http_code int, content_hash string, authoritative boolean")


def test_bulk_rot_hosts_are_not_actionable(spark):
    now = probe(spark, [(f"http://h/{i}", "dead", 404, None, False) for i in range(3)])
    old = probe(spark, [(f"http://h/{i}", "ok", 200, None, False) for i in range(3)])
    found = links.diff(now, old)
    rot = links.bulk_rot(found)
    assert rows(rot, "host", "total", "dead") == [("h", 3, 3)]
    assert {r.in_bulk_host for r in links.actionable(found, rot).collect()} == {True}


def test_inconclusive_keeps_prior_state_and_never_reports(spark):
    now = probe(spark, [("u", "inconclusive", None, None, True), ("v", "inconclusive", None, None, True), ("w", "ok", 200, "h2", True)])
    old = probe(spark, [("u", "ok", 200, "h", True), ("w", "ok", 200, "h1", True), ("gone", "ok", 200, None, False)])
    assert rows(links.diff(now, old).filter("change IS NOT NULL"), "url", "change") == [("v", "new"), ("w", "content_changed")]
    assert {r.url: (r.status, r.content_hash) for r in links.next_baseline(now, old).collect()} == {
        "u": ("ok", "h"), "v": ("inconclusive", None), "w": ("ok", "h2")
    }


def test_refused_head_is_decided_by_get(spark):
    data = [("a", 1, "HEAD", 405, None), ("a", 2, "GET", 200, None), ("b", 1, "HEAD", 404, None), ("c", 1, "GET", None, "t1"), ("c", 2, "GET", None, "t2"), ("d", 1, "GET", 403, None)]
    df = spark.createDataFrame(data, "url string, attempt int, method string, http_code int, error string")
    got = links.classify_probes(df.withColumn("content_hash", F.lit("h")).withColumn("authoritative", F.lit(False)))
    assert rows(got, "url", "status") == [("a", "ok"), ("b", "dead"), ("c", "inconclusive"), ("d", "dead")]
    assert got.filter("url = 'c'").first().detail == "t2"


# -- catalogue and evidence ---------------------------------------------------------------------

def test_ambiguous_names_resolve_by_tier_or_stay_ambiguous(spark):
    cat = spark.createDataFrame([("03708", "史 纲", 2), ("15043", "史 纲", 1), ("1", "同名", 1), ("2", "同名", 1), ("3", "法（一）", 1)], "code string, name string, tier int")
    qs = spark.createDataFrame([(1, "史  纲"), (2, "同名"), (3, "法(一)"), (4, "15043"), (5, "99999"), (6, ""), (7, "史纲")], "query_id int, query string")
    got = {r.query_id: (r.status, r.code, r.matched_by, r.n_candidates) for r in catalog.resolve(qs, cat).collect()}
    assert got == {
        1: ("resolved", "15043", "name", 1), 2: ("ambiguous", None, None, 2), 3: ("resolved", "3", "name", 1), 4: ("resolved", "15043", "code", 1),
        5: ("not_found", None, None, 0), 6: ("not_found", None, None, 0), 7: ("resolved", "15043", "alias", 1),
    }
    assert rows(catalog.resolve_candidates(cat), "code") == [("1",), ("2",)]


def test_tier_with_only_dropped_rows_still_claims_the_entity(spark):
    df = spark.createDataFrame([("m", 1, "dropped"), ("m", 2, "parsed"), ("n", 2, "parsed")], "e string, tier int, s string")
    assert rows(catalog.tier_waterfall(df, "e", "tier"), "e", "s") == [("m", "dropped"), ("n", "parsed")]


def test_fixed_width_rows_wrap_and_drop(spark):
    text = "   工程数学（线性\n 5  10993              6  笔试\n   与概率）   学分\n080901 计划\n 6  00023  高等 数学  10  笔试 实践\nX2080901"
    parsed, dropped = structure.fixed_width_rows(lines_of(spark, text), ["doc"])
    assert rows(parsed, "line_no", "code", "name", "credits", "exam_method") == [(2, "10993", "工程数学（线性与概率）", 6, "笔试")]
    assert rows(dropped, "line_no", "reason") == [(5, structure.NO_METHOD)]


def test_supporting_locator_prefers_the_near_line_of_a_wrapped_name(spark):
    text = "前段\n别的\n前段\n 5 10993 6 笔试\n后段）"
    cites = spark.createDataFrame([(1, "d", 4, "前段后段）"), (2, "d", 4, "别的"), (3, "d", 4, "none")], "cite_id int, doc string, line_no int, value string")
    got = evidence.supporting_locator(cites, lines_of(spark, text), "doc")
    assert rows(got, "cite_id", "line_no", "how") == [(1, 3, "wrapped"), (2, 2, "line"), (3, 4, "original")]


def test_supporting_locator_shuffles_a_citation_once_and_equals_a_plain_search(spark):
    rng = random.Random(5)
    words = ["ab", "bc", "cab", "a", ""]
    lines = [(d, n, " ".join(rng.choices(words, k=3))) for d in "xy" for n in range(1, 80) if rng.random() < 0.9]
    lines += [("x", 31, "zz"), ("x", 31, "zy"), (None, 5, "a")]
    cites = [(f"{d}{n}-{i}", d, n, v) for d in "xy" for n in range(-1, 84) for i, v in enumerate([rng.choice("abc z"), "".join(rng.choices("abc ", k=4)), "zyz"])]
    cites += [cites[7]] * 3 + [("none", None, 5, "a")] * 2 + [("far", "x", 500, "a")] * 2 + [("x1-0", "x", 900, "a"), ("null", "x", 3, None)]
    got = evidence.supporting_locator(
        spark.createDataFrame(cites, "cite_id string, doc string, line_no bigint, value string"), spark.createDataFrame(lines, "doc string, line_no int, text string"), "doc"
    )
    texts = [(d, n, " ".join(t.split())) for d, n, t in lines]

    def plain(d, center, value):
        near = {o: [t for k, n, t in texts if d is not None and k == d and n == center + o] for o in range(-2, 3)}
        if not any(near.values()):
            return None
        if value is None:
            return center, "original"
        hits = [(abs(o), center + o) for o, ts in near.items() if any(value in t for t in ts)]
        if hits:
            return min(hits)[1], "line"
        after = " ".join(max(near[o]) for o in (1, 2) if near[o])
        for n in range(1, len(value)):
            for o in (-1, -2):
                if near[o] and value[:n] in max(near[o]) and value[n:] in after:
                    return center + o, "wrapped"
        return center, "original"

    found = {c: plain(*c[1:]) for c in cites}
    want = [(c[0], *f) for c, f in found.items() if f]
    seen = {w[0] for w in want}
    want += [(c[0], c[2], "original") for c in cites if not found[c] and c[0] not in seen]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert {h for _, _, h in want} == {"line", "wrapped", "original"}
    assert "explode(sequence(-2" not in got._jdf.queryExecution().analyzed().toString()  # no row for each line of the window


def test_empty_baseline_judges_no_url(spark):
    ev = spark.createDataFrame([("00001", "https://evilexample.cn/x")], "code string, course_url string")
    none = spark.createDataFrame([], "url string, authoritative boolean")
    codes = spark.createDataFrame([], "url string, code string")
    assert evidence.url_provenance(ev, none, codes, "example.cn", "code").count() == 0
    some = spark.createDataFrame([("https://other", True)], "url string, authoritative boolean")
    assert rows(evidence.url_provenance(ev, some, codes, "example.cn", "code"), "rule") == [("url_unknown",)]


# -- model --------------------------------------------------------------------------------------

SYLLABUS = """大纲目录
第一章 甲
第 2 章 乙
Ⅰ 性质
Ⅲ 课程内容与考核要求
第一章 甲
二、考核知识点与考核要求
1.节一
识记：a；b。
领会：长句续
到下一行。
2.节二（本节内容不作考核要求）
识记：跳过。
三、本章重点
重点一；重点二。
第 2 章 乙
二、考核知识点与考核要求
识记：整章。
12
附录一 报告
二、考核知识点与考核要求
应用：写。
Ⅳ 说明"""


def build(spark, text):
    lines = lines_of(spark, text)
    titles = structure.unit_titles(lines, ["doc"])
    logical = structure.logical_lines(structure.body_slices(lines, titles, ["doc"]), ["doc", "idx", "title"])
    block = model.requirement_block(logical, ["doc", "idx", "title"], "二、考核知识点与考核要求")
    return lines, titles, model.classify_block(block, ["doc", "idx", "title"], "title")


def test_syllabus_to_points(spark):
    _, titles, classified = build(spark, SYLLABUS)
    assert rows(titles, "idx", "title", "origin") == [(0, "第一章 甲", "toc"), (1, "第 2 章 乙", "toc")]
    points = model.points(classified.withColumnRenamed("title", "u"), ["doc", "idx"], F.concat(F.lit("00001-ch0"), (F.col("idx") + 1).cast("string")))
    assert rows(points, "point_id", "title", "requirement", "locator") == [
        ("00001-ch01-s1-p1", "a", "识记", "L9"), ("00001-ch01-s1-p2", "b", "识记", "L9"), ("00001-ch01-s1-p3", "长句续到下一行", "领会", "L10"),
        ("00001-ch02-s1-p1", "整章", "识记", "L18"),
    ]
    assert rows(classified.filter("role = 'unmodeled'"), "reason") == [("not_assessed",), ("not_assessed",)]


def test_independent_denominator_goes_red_on_a_dropped_unit(spark):
    lines, _, classified = build(spark, SYLLABUS)
    declared = model.independent_denominator(lines, ["doc"], "二、考核知识点与考核要求").first().declared_units
    produced = model.sections(classified, ["doc", "idx"]).count()
    assert (declared, produced) == (3, 2)  # the appendix is a unit of its own and is not part of the chapters


def test_coverage_in_one_pass_equals_the_joined_form(spark):
    _, _, classified = build(spark, SYLLABUS)
    keys = ["doc", "idx"]
    once = model.coverage_counts(model.section_flags(classified, keys).withColumn("unit_class", F.lit("chapter")), "doc", "h")
    points = model.points(classified.withColumnRenamed("title", "u"), keys, F.lit("x"))
    joined = model.coverage(model.sections(classified, keys).withColumn("unit_class", F.lit("chapter")), points, "doc", ["idx", "section_line"], "h")
    assert once.collect() == joined.collect() and once.first().ratio == 1.0
    mentions = model.section_mentions(classified, keys)
    assert model.unaccounted(mentions, keys).count() == 0
    lost = mentions.filter("declared OR index <> '1'")
    assert rows(model.unaccounted(lost, keys), "idx", "index") == [(0, "1")]


def test_missing_ordinals_and_runs(spark):
    df = spark.createDataFrame([("a", o) for o in (4, 5, 8)] + [("b", o) for o in (0, 1, 2)] + [("c", 0), ("c", 3)], "k string, ordinal long")
    gaps = model.missing_ordinals(df, "k", block=4)
    assert rows(gaps, "k", "missing") == [("a", 1), ("a", 2), ("a", 3), ("a", 6), ("a", 7), ("c", 1), ("c", 2)]
    assert rows(model.runs(gaps, "k", "missing", block=2), "k", "label") == [("a", "第1–3章"), ("a", "第6–7章"), ("c", "第1–2章")]


# -- schedules ----------------------------------------------------------------------------------

def brute_spread(n, h):
    out, day = {}, 0
    for d in range(1, h + 1):
        chunk = range((d - 1) * n // h, d * n // h)
        if len(chunk):
            day += 1
            out.update({i: (day, d) for i in chunk})
    return out


@pytest.mark.parametrize("n", [1, 5, 7, 14, 29, 30, 31, 100])
def test_spread_equals_the_slice_definition(spark, n):
    points = spark.createDataFrame([("k", f"p{i:03d}", i) for i in range(n)], "k string, point_id string, o long")
    plans = spark.sql("SELECT 'k' AS k, DATE'2026-05-01' AS exam_date, 3.5D AS weekly_hours")
    got = schedule.spread(points, plans, "k", ["o"], F.floor(F.col("o") / 6)).collect()
    assert {r.daily_minutes for r in got} == {30}
    for h in (30, 14, 7):
        want = brute_spread(n, h)
        mine = {int(r.point_id[1:]): (r.day, (r.date - r.start_date).days + 1) for r in got if r.horizon_days == h}
        assert mine == {i: (day, day) for i, (day, _) in want.items()}
        kinds = {int(r.point_id[1:]): r.kind for r in got if r.horizon_days == h}
        read = -(-h // 2)
        expect = lambda d: "read" if d <= read else "drill" if d <= read + -(-h // 4) else "review"
        assert kinds == {i: expect(d) for i, (_, d) in want.items()}


# -- gates and maturity -------------------------------------------------------------------------

def test_run_lists_all_layers_and_rejects_unknown_ones(spark):
    from corpus_audit.findings import rule_findings

    one = rule_findings(spark.range(3), "x", F.col("id"), [("r", F.col("id") > 1, "m"), ("undecidable", F.lit(None).cast("boolean"), "n")])
    _, report = gates.run({"a": one, "b": one.filter("false")})
    assert rows(report, "layer", "n_findings", "state") == [("a", 4, "failed"), ("b", 0, "ok")]
    with pytest.raises(ValueError):
        gates.run({"a": one}, ["a", "zzz"])


def test_schema_rules_bool_is_no_number(spark):
    schema = {"type": "object", "required": ["n"], "properties": {"n": {"type": "number"}, "o": {"type": "object", "properties": {"s": {"type": "string"}}}}}
    data = ['{"n": 1}', '{"n": true}', '{"o": {"s": 1}}', "[1]", '{"n": null}', "broken"]
    df = spark.createDataFrame([(i, j) for i, j in enumerate(data)], "i int, j string")
    got = rows(gates.schema_rules(df, F.col("i"), "j", schema), "entity", "rule", "locator")
    assert got == [("1", "type", "$.n"), ("2", "required", "$.n"), ("2", "type", "$.o.s"), ("3", "type", "$"), ("4", "type", "$.n"), ("5", "type", "$")]


def test_grade_missing_thin_and_green(spark):
    e = spark.createDataFrame([(k, "publishable", "complete") for k in ("ok", "thin", "gone")], "code string, lifecycle string, completeness string")
    full = {"index.md": "x", "sources.md": "核验\n\nfilled", "practice.md": "真题\nfilled", "plan.md": "阶段目标\nfilled"}
    pages = [("ok", n, t) for n, t in full.items()] + [("thin", n, t if n != "plan.md" else "阶段目标\n# h\n| t |\n> q") for n, t in full.items()]
    pages += [("gone", n, t) for n, t in full.items() if n != "sources.md"]
    got = maturity.grade(e, spark.createDataFrame(pages, "code string, name string, text string"), "code")
    assert rows(got, "code", "maturity") == [("gone", "red"), ("ok", "green"), ("thin", "yellow")]
    assert "missing:sources.md" in got.filter("code = 'gone'").first().reasons


def test_results_do_not_depend_on_partitioning(spark):
    recs = [("c", 1, f"p{i % 3}", i, i % 4) for i in range(40)]
    df = spark.createDataFrame(recs, "code string, tier int, path string, line int, credits int")
    order = ["tier", "path", "line"]
    once = rows(catalog.conflicts(df.coalesce(1), "code", {"credits": F.col("credits")}, order), "value", "position", "path", "line")
    for parts in (3, 11):
        assert rows(catalog.conflicts(df.repartition(parts), "code", {"credits": F.col("credits")}, order), "value", "position", "path", "line") == once


def test_units_folded_per_document_equal_the_window_form(spark):
    rng = random.Random(12)
    pool = ["大纲目录", "导论", "绪 论", "第一章 甲", "第 2 章 乙", "第一章 甲 ", "Ⅰ 性质", "Ⅲ 课程内容与考核要求", "附录一 丙", "3", "", "文 字", "1.节", "第二章"]
    texts = [[rng.choice(pool) for _ in range(rng.randint(0, 25))] for _ in range(150)] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, lines array<string>")
    lines = docs.select("k", F.posexplode("lines").alias("p", "text")).select("k", (F.col("p") + 1).cast("long").alias("line_no"), "text")
    want = structure.body_slices(lines, structure.unit_titles(lines, ["k"]), ["k"])
    got = structure.document_slices(docs, ["k"], F.col("lines"))
    columns = ["k", "idx", "title", "line_no", "text"]
    assert rows(got, *columns) == rows(want, *columns) != []


def test_material_findings_name_document_and_line(spark):
    lines = [
        ("d", 1, "ok materials://a/b.pdf and materials://a/b`"), ("d", 2, "materials://a/../x"), ("d", 3, "materials://a/my-secret"),
        ("d", 4, "materials://<path> materials://...x"), ("d", 5, "materials://gone"), ("d", 6, "see (papers/x.pdf"), ("d", 7, "materials://a papers/x.pdf"),
        ("e", 1, "official.example papers/x.pdf"), ("e", 2, None),
    ]
    frame = spark.createDataFrame(lines, "doc string, line_no long, text string")
    files_ = spark.createDataFrame([("a/b.pdf",), ("a/b c.pdf",)], "path string")
    got = gates.material_findings(frame, files_, "doc", "official.example", "private")
    assert rows(got, "rule", "entity", "locator", "message") == [
        ("line_leak", "d", "L6", "private or raw file"), ("ref_policy", "d", "L2", "bad materials path"), ("ref_policy", "d", "L3", "sensitive word in path"),
        ("ref_unresolved", "d", "L2", "invalid:path-escape a/../x"), ("ref_unresolved", "d", "L3", "invalid:sensitive a/my-secret"), ("ref_unresolved", "d", "L5", "missing gone"),
    ]
    assert {r.rule for r in gates.material_findings(frame, None, "doc", "official.example", "private").collect()} == {"ref_policy", "ref_unresolved", "line_leak"}


def test_findings_and_report_come_from_one_write(spark):
    from corpus_audit.findings import as_findings, no_findings

    df = spark.createDataFrame([(k,) for k in range(5)], "k long")
    one = as_findings(df, "x", "odd", F.col("k"), "m")
    two = as_findings(df.where("k < 2"), "x", "low", F.col("k"), "m")
    spark.sparkContext.setJobGroup("gates", "gates")
    findings, report = gates.run({"a": one, "b": two, "c": no_findings(spark)})
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("gates"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 2  # the write, and the listing of what it wrote
    assert rows(report, "layer", "n_findings", "state") == [("a", 5, "failed"), ("b", 2, "failed"), ("c", 0, "ok")]
    assert rows(findings, "layer", "rule", "entity") == sorted([("a", "odd", str(k)) for k in range(5)] + [("b", "low", str(k)) for k in range(2)])


def test_sorted_shuffles_have_partitions_by_input_size(spark, tmp_path, monkeypatch):
    from corpus_audit import scale
    from corpus_audit.operators import schedule

    spark.range(4000).selectExpr("id % 7 AS k", "cast(id AS string) AS point_id", "id").write.parquet(str(tmp_path / "p"))
    points = spark.read.parquet(str(tmp_path / "p"))
    monkeypatch.setattr(scale, "PARTITION_BYTES", scale.leaf_bytes(points) // 40)
    parts = lambda df: df._jdf.queryExecution().toString()
    ranks = scale.ranked(points, ["k"], [F.col("id")], F.floor(F.col("id") / 1000), "r")
    assert re.search(r"hashpartitioning\(k#\d+L, _block#\d+L, 4\d\)", parts(ranks))
    assert rows(ranks, "k", "r") == sorted((i % 7, i // 7 + 1) for i in range(4000))
    plans = spark.range(7).selectExpr("id AS k", "date'2026-03-01' AS exam_date", "7d AS weekly_hours")
    spread = schedule.spread(points, plans, "k", ["id"], F.floor(F.col("id") / 1000))
    items = schedule.day_items(spread.withColumn("_o", F.col("point_id").cast("bigint")), "k", "_o")
    assert re.search(r"hashpartitioning\(k#\d+L, 4\d\)", parts(items))
    assert items.agg(F.sum("n_points")).first()[0] == 12000
