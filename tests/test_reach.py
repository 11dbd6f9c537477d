"""Page reach: values against brute force, one mutation per rule."""

import random

import pytest

from corpus_audit.operators import content, reach

CONTENT = (
    "entity string, stage_plan array<struct<stage:string,goal:array<string>,inputs:array<string>,how:array<string>,outputs:array<string>,done_when:string>>, "
    "strategies array<struct<block_id:string,text_md:string>>, schedule struct<status:string,gap_impact:string,next_evidence:string,tiers:array<string>>"
)


@pytest.mark.parametrize("size", [2, 256])
def test_missing_values_equal_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(reach, "VALUES", size)
    rng = random.Random(size)
    word = lambda n: "".join(rng.choice("ab中") for _ in range(n))
    # one section is asked for a third of all values, one is absent, one has two texts, one a null text
    sections = [(k, word(rng.randint(0, 60))) for k in range(6)] + [(4, word(40)), (7, None)]
    expected = [(rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 7, 9]), rng.choice("fg"), word(rng.randint(1, 5))) for _ in range(150)]
    expected += [(0, "f", ""), (0, "f", None)] + expected[:5]
    got = reach.missing_values(spark.createDataFrame(expected, "k long, field string, value string"), spark.createDataFrame(sections, "k long, body string"), ["k"])
    want = {(k, f, v) for k, f, v in expected if v and not any(v in (b or "") for x, b in sections if x == k)}
    assert sorted(map(tuple, got.collect())) == sorted(want)


def whole():
    stages = [(n, [f"g{i}。"], [f"i{i}a。", f"i{i}b。"], [f"h{i}。"], [f"o{i}。"], f"d{i}。") for i, n in enumerate(content.STAGES)]
    plan = "".join(f"### 阶段：{n}\t\n{''.join(g + '\n' for g in [*goal, *inp, *how, *out, done])}" for n, goal, inp, how, out, done in stages)
    plan += "## 应试策略\n先易\n后难\n## 其他\n尾\n"
    review = "# 复习\n## 命名缺口\n影响。\n证据。\n## 尾\n"
    return ("e", stages, [("b1", " 先易\n后难 \n")], ("named_gap", "影响。", "证据。", ["基础"])), {"plan.md": plan, "review.md": review}


def reached(spark, row, pages):
    pages = [("e", p, t, "x") for p, t in pages.items()]
    out = reach.plan_reach(spark.createDataFrame([row], CONTENT), spark.createDataFrame(pages, "entity string, page string, text string, rule string"), "entity")
    return sorted((r.rule, r.message) for r in out.collect())


def test_a_whole_plan_has_no_finding_and_every_mutation_one(spark):
    row, pages = whole()
    assert reached(spark, row, pages) == []
    cut = lambda page, old, new="": {**pages, page: pages[page].replace(old, new)}
    names = content.STAGES
    cases = [
        (cut("plan.md", "d1。"), [("done_when", names[1])]),
        (cut("plan.md", "g0。"), [("goal", names[0])]),
        (cut("plan.md", "i2b。"), [("inputs", names[2])]),
        (cut("plan.md", "h3。"), [("how", names[3])]),
        (cut("plan.md", "o4。"), [("outputs", names[4])]),
        (cut("plan.md", f"### 阶段：{names[2]}"), [("stage_names", "|".join(names[:2] + names[3:]))]),
        (cut("plan.md", "### 阶段", "#### 阶段"), [("stage_names", "")]),
        (cut("plan.md", "先易\n后难\n## 其他", "## 其他\n先易\n后难"), [("strategy_text", "b1")]),
        (cut("plan.md", "## 应试策略"), [("strategy_section", "b1")]),
        (cut("review.md", "影响。\n证据。\n## 尾", "证据。\n## 尾\n影响。"), [("gap_impact", "影响。")]),
        (cut("review.md", "证据。"), [("next_evidence", "证据。")]),
        (cut("review.md", "## 命名缺口", "## 缺口"), [("gap_section", "命名缺口")]),
    ]
    for mutated, want in cases:
        assert reached(spark, row, mutated) == want
    planned = (*row[:3], ("planned", None, None, ["基础", "标准", None]))
    assert reached(spark, planned, cut("review.md", "# 复习", "（基础）")) == [("tier", "标准")]
    # nothing is asked of empty contents, everything of contents without pages
    assert reached(spark, ("e", None, None, None), {"plan.md": "", "review.md": ""}) == []
    assert {r for r, _ in reached(spark, row, {"other.md": ""})} == {"stage_names", "done_when", *reach.STAGE_LISTS, "strategy_section", "gap_section"}


def drilled(spark, blocks, pages):
    out = reach.drill_reach(
        spark.createDataFrame(blocks, "entity string, kind string, point_id string"), spark.createDataFrame(pages, "entity string, page string, text string"), "entity"
    )
    return sorted((r.rule, r.entity, r.message) for r in out.collect())


def test_drills_reach_their_page(spark):
    blocks = [("e", "drill", "00001-ch01-s1-p1"), ("e", "drill", "00001-ch01-s1-p2"), ("e", "explain", "00001-ch01-s1-p9"), ("e", "drill", None)]
    text = "### 00001-ch01-s1-p1\n### 00001-ch01-s1-p27\n### 三\n<details>\n"
    assert drilled(spark, blocks, [("e", "practice.md", text)]) == []  # an id also stands as the head of a longer one
    assert drilled(spark, blocks, [("e", "practice.md", text.replace("### 三", "#### 三"))]) == [("drill_headings", "e", "2 of 3")]
    assert drilled(spark, blocks, [("e", "practice.md", text.replace("s1-p2", "s2-p2"))]) == [("drill_anchor", "e", "00001-ch01-s1-p2")]
    assert drilled(spark, blocks, [("e", "practice.md", text.replace("<details>", "x <details>"))]) == [("answers_unfolded", "e", "practice.md")]
    assert {r for r, *_ in drilled(spark, blocks, [("e", "plan.md", text), ("f", "practice.md", text)])} == {"drill_headings", "drill_anchor", "answers_unfolded"}
    assert drilled(spark, [("e", "explain", "x")], [("e", "practice.md", None)]) == []
