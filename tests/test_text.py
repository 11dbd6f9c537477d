"""Column functions on inline rows."""

import pytest
from pyspark.sql import functions as F

from corpus_audit.functions import policy as po
from corpus_audit.functions import status as st
from corpus_audit.functions import text as tx


def values(spark, fn, inputs):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", fn("v").alias("o"))
    return [r.o for r in sorted(df.collect(), key=lambda r: r.i)]


CASES = [
    (tx.normalize_url, {"http://a/b).": "http://a/b", "http://a/b；": "http://a/b", "http://a/b": "http://a/b"}),
    (tx.host_of, {"https://sub.domain.com:8080/page": "sub.domain.com", "not a url": "", "HTTP://U:P@Ex.COM/": "ex.com", "//h/x": "h"}),
    (lambda c: tx.is_in_domain(c, "example.cn"), {"https://evilexample.cn/": False, "https://a.example.cn/": True, "https://example.cn": True}),
    (tx.url_slug, {"http://h/a/b.c.html?x": "b.c", "http://h/": "index", "http://h": "index", "http://h/中 文.pdf": "index", "http://h/a b.pdf": "a-b"}),
    (tx.entity_code_from_path, {"c/15040.md": "15040", "c/15040/index.md": "15040", "c/15040/a.txt": None, "c/150401.md": None}),
    (tx.fold_ws, {" a\x0c　b\x1cc ": "a b c", "": ""}),
    (tx.squeeze, {"a  b\tc": "abc"}),
    (tx.name_key, {"ＡＢＣ　Straße": "abc strasse", " Mixed  Case ": "mixed case", "（一）": "(一)"}),
    (tx.chinese_number, {"一": 1, "十": 10, "十七": 17, "二十": 20, "二十三": 23, "x": None, "": None, "百": None}),
    (tx.chapter_number, {"第 16 章": 16, "第十七章": 17, "第 11 章使用": None, "导论": None}),
    (tx.appendix_number, {"附录一 标题": 1, "附录 7 UML": 7, "附录：样卷": None, "附录": None}),
    (tx.bounded_quote, {"a" * 60: "a" * 60, "b" * 61: "b" * 60, "c" * 30 + "，" + "d" * 40: "c" * 30, "，" + "e" * 70: "，" + "e" * 59}),
    (tx.split_phrases, {"甲；乙。； ；丙": ["甲", "乙", "丙"], "": []}),
    (tx.is_calendar_date, {"2024-02-30": False, "2024-02-29": True, "2024/02/01": False, "x": False}),
    (lambda c: tx.matches_code(c, "major"), {"080901K": True, "0809012": False, "080901": True}),
    (tx.display_lines, {"a\x0cb\nc\n": ["a", "b", "c"], "a\r\nb": ["a", "b"], "": []}),
    (tx.physical_lines, {"a\x0cb\nc\n": ["a\x0cb", "c", ""]}),
    (tx.heading_title, {"x\n# T one \n# U": "T one", "## no": "课程页"}),
    (tx.normalize_href, {"../majors/m#a": "/majors/m/#a", "./15040.md": "/courses/15040/", "a/b.md": "a/b", "#x": "#x", "//h": "//h"}),
    (st.normalize_lifecycle, {"🟡 审查中": "in_review", "green": "publishable", '"draft"': "draft", "zzz": "draft", "🔴 machine_ready": "machine_ready"}),
    (st.status_kind, {"🟢 可发布": "green", "done": "red"}),
    (po.ref_policy_error, {"a/../b": "bad materials path", "api-TOKEN/x": "sensitive word in path", "...": None, "a/b.pdf`": None}),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_scalar(spark, case):
    fn, pairs = CASES[case]
    assert values(spark, fn, list(pairs)) == list(pairs.values())


def test_frontmatter_and_tables(spark):
    text = '---\na: "x"\n  more\nb: 1\nb: 2\n---\n| 字段 | 内容 |\n|---|---|\n| k | 1 |\n| k | 2 |\n\n| k | 3 |'
    row = spark.createDataFrame([(text,), ("---\nopen: 1\n",)], "t string").select(
        tx.parse_frontmatter("t").alias("f"), tx.parse_meta_table("t").alias("m"), tx.table_fields("t").alias("g")
    ).collect()
    assert row[0].f == {"a": "x more", "b": "2"} and row[0].m == {"k": "2"} and row[0].g == {"k": "1"}
    assert row[1].f == {} and row[1].m == {}


def test_answer_labels_fail_closed_on_several_letters(spark):
    answers = ["答案：A", "**正确答案**：B 解释", "答案：A、B", "答案：A和B", "答案：AB", "答案：A。解析：A 项符合", "略"]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i int, a string")
    got = [r.l for r in df.select("i", tx.answer_label(F.lit("单项选择题"), "a").label.alias("l")).orderBy("i").collect()]
    assert got == ["A", "B", None, None, None, "A", None]


def test_visible_lines_and_open_comment(spark):
    text = "```\n### in fence\n~~~\n```\n<!-- x\n### hidden -->\n### shown\n<!-- open\n```\n### lost"
    row = spark.createDataFrame([(text,)], "t string").select(tx.visible_lines("t").alias("v"), tx.unclosed_comment("t").alias("c")).first()
    assert [(x.line_no, x.text) for x in row.v if x.text.startswith("#")] == [(7, "### shown")]
    assert row.c.line_no == 8 and row.c.hides_content
    tail = spark.createDataFrame([("a\n<!-- open\n\n",)], "t string").select(tx.unclosed_comment("t").alias("c")).first()
    assert tail.c.line_no == 2 and not tail.c.hides_content


def test_reference_parsing(spark):
    refs = ["materials://a/b.pdf).", "materials://a/../b", "materials://<path>", "materials://x/secret.pdf", "materials://a\\b"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(refs)], "i int, r string").select("i", po.parse_ref("r").alias("p"))
    got = [(r.p.path, r.p.state) for r in df.orderBy("i").collect()]
    assert got == [
        ("a/b.pdf", "valid"), ("a/../b", "invalid:path-escape"), (None, "skipped-placeholder"), ("x/secret.pdf", "invalid:sensitive"), ("a/b", "valid"),
    ]


def test_blanks_are_stripped_without_a_regex_and_lines_split_at_every_boundary(spark):
    blank = r"(?U)[\s\x1c-\x1f]"
    codes = [c for c in range(1, 0x11000) if not 0xD800 <= c <= 0xDFFF]
    rows = [(" " + chr(c) + "\u3000a" + chr(c) + "b\u2028" + chr(c),) for c in codes] + [("",), (" \t",), (None,), ("a\nb\n",), ("a\r\nb\rc\n\n",)]
    df = spark.createDataFrame(rows, "t string").select(
        "t", tx.strip_ws("t").alias("s"), tx.squeeze("t").alias("q"), tx.display_lines("t").alias("l")
    )
    assert "regexp_replace" not in df.select("s")._jdf.queryExecution().optimizedPlan().toString()
    parts = F.split("t", tx.LINE_BREAKS, -1)
    lines = F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    other = ~(
        F.col("s").eqNullSafe(F.regexp_replace("t", rf"^{blank}+|{blank}+\z", ""))
        & F.col("q").eqNullSafe(F.regexp_replace("t", blank + "+", "")) & F.col("l").eqNullSafe(lines)
    )
    assert df.where(other).collect() == []


def test_of_repeated_keys_one_is_kept(spark):
    rows = [("---\na: 1\nb: 2\na: 3\n---\n| k | 1 |\n| k | 2 |\n| j | 3 |\n",), ("---\na: 1\nb: 2\n---\n| k | 1 |\n| j | 3 |\n",)]
    got = spark.createDataFrame(rows, "t string").select(tx.parse_frontmatter("t").alias("f"), tx.table_fields("t").alias("g")).collect()
    assert [(r.f, r.g) for r in got] == [({"b": "2", "a": "3"}, {"k": "1", "j": "3"}), ({"a": "1", "b": "2"}, {"k": "1", "j": "3"})]
