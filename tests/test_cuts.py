"""Nothing is cut: long keys, long references, long lists, wide gaps, many lines, code fences."""

from pyspark.sql import functions as F

from corpus_audit.functions import policy as po
from corpus_audit.functions import text as tx
from corpus_audit.operators import content, maturity, model, structure
from corpus_audit.operators import gates
from corpus_audit.plans import inputs


def test_padding_never_cuts(spark):
    keys = [1, 99999, 100000, 123456, 12345678901, None]
    got = [r.p for r in spark.createDataFrame([(k,) for k in keys], "k long").select(inputs.padded(F.col("k")).alias("p")).collect()]
    assert got == ["00001", "99999", "100000", "123456", "12345678901", None]


def test_whole_reference_is_judged(spark):
    long = "a/" * 600_000
    rows = [("materials://" + long + "../x",), ("materials://" + long + "end",), ("materials://" + long + "my-secret",)]
    got = [r.p for r in spark.createDataFrame(rows, "r string").select(po.parse_ref("r").alias("p")).collect()]
    assert [p.state for p in got] == ["invalid:path-escape", "valid", "invalid:sensitive"]
    assert got[1].path == long + "end"


def test_whole_heading_is_read(spark):
    title = "x" * 1_100_000
    lines = spark.createDataFrame([(1, 1, "## " + title + "y"), (1, 2, "inside"), (1, 3, "## other"), (1, 4, "kept")], "k int, line_no int, text string")
    kept = structure.drop_sections(lines, ["k"], [title + "y"])
    assert [r.line_no for r in kept.orderBy("line_no").collect()] == [3, 4]


def test_long_missing_list_names_its_first_field(spark):
    reasons = ["missing:" + "f" * 1500 + ",other"]
    row = spark.createDataFrame([("1", "a", "b", "c", reasons)], "code string, lifecycle string, completeness string, maturity string, reasons array<string>")
    assert maturity.project(row, "code").first().next_step == "gap: " + "f" * 1500


def test_wide_gap_streams(spark):
    units = spark.createDataFrame([("a", 1), ("a", 3_000_000_002), ("b", 2), ("b", 4)], "k string, ordinal long")
    missing = model.missing_ordinals(units, "k")
    assert len(missing.filter("k = 'a'").limit(5).collect()) == 5
    assert sorted(r.missing for r in missing.filter("k = 'b'").collect()) == [1, 3]


def test_large_ordinals_keep_their_order(spark):
    units = spark.createDataFrame([("a", 0, 2**41, "late"), ("a", 0, 5, "early"), ("a", 1, 1, "annex")], "k string, unit_class int, ordinal long, slug string")
    got = {r.slug: (r.previous, r.following) for r in model.unit_neighbors(units, "k").collect()}
    assert got == {"early": (None, "late"), "late": ("early", "annex"), "annex": ("late", None)}


def test_no_job_before_an_action(spark):
    texts = spark.range(5).select(F.col("id"), F.lit("some text of a kind").alias("text")).groupBy("id").agg(F.max("text").alias("text"))
    sources = spark.range(2).select(F.lit("text of a kind").alias("text"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    content.ngram_overlap(texts, sources, "id")
    assert list(tracker.getJobIdsForGroup("plan-only")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_paths_that_repeat_give_one_finding(spark):
    files = spark.createDataFrame([("p", "d1"), ("p", "d2"), ("p", None)], "path string, digest string")
    rows = [(1, "p", "p", "p", "p", "p", "d2", "x"), (2, "p", "p", "p", "p", "p", "d9", "x"), (3, "", "p", "p", "p", "q", "d1", "x")]
    schema = "row_no int, source_pdf string, raw_xml string, raw_txt string, raw_view_html string, extracted_md string, source_sha256 string, extraction_policy string"
    got = sorted((r.rule, r.entity) for r in gates.manifest_rules(spark.createDataFrame(rows, schema), files).collect() if r.rule != "digest_shape")
    assert got == [("digest_mismatch", "2"), ("path_empty", "3"), ("target_missing", "3")]


def test_fences(spark):
    cases = {
        "a\n```\nb\n```\nc": [(1, "a"), (5, "c")],
        "a\n````\nb\n```\nc\n`````x\nd": [(1, "a"), (7, "d")],
        "   ~~~ lang\n```\n~~\n ~~~~\nend": [(5, "end")],
        "    ```\nnot a fence": [(1, "    ```"), (2, "not a fence")],
        "x\n```\nopen\n\nto the end": [(1, "x")],
        "```\n```\n\n```\r\nin\r\n```\r\nout": [(3, ""), (7, "out")],
        "``\nplain": [(1, "``"), (2, "plain")],
        "": [],
        "\n": [(1, "")],
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", tx.unfenced_lines("t").alias("v")).collect()
    for r in rows:
        assert [(x.line_no, x.text) for x in r.v] == cases[r.t], repr(r.t)


def test_parts_with_keys_of_six_digits_stay_in_course_tables(spark, tmp_path):
    import duckdb

    from corpus_audit.plans import load_all
    from corpus_audit.plans.registry import ORACLES, QUERIES

    load_all()
    keys = [7, 99_999, *range(100_000, 100_040), 1_234_567]
    rows = [(k, f"red {'abcdefg'[k % 7]}x", f"B{k % 3}", "t", k % 50 + 1, 1.0) for k in keys]
    schema = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    for name in ("c5_fixed_width_parsed", "c5_fixed_width_dropped", "c6_wrapped_value", "e3_dropped_ledger"):
        want = con.execute(ORACLES[name])
        names = [d[0] for d in want.description]
        assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)
    got = QUERIES["c4_course_table_rows"](spark, str(tmp_path)).collect()
    assert sorted((r.p_partkey, r.state, r.code) for r in got) == sorted(
        (k, "dropped", None) if k % 7 == 6 else (k, "parsed", f"{k:05d}") for k in keys
    )
