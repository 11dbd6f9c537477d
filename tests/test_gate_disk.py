"""Gates: shuffle files go with the job of their rule group, and wide inputs are dealt by their key before they are made."""

import random
import re
import time
from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from corpus_audit.findings import as_findings, no_findings
from corpus_audit.operators import gates, model
from corpus_audit.plans import load_all
from corpus_audit.plans.registry import QUERIES
from corpus_audit.session import FREED

load_all()


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\((.*?), \d+\), [A-Z_]+", plan)]


def test_shuffle_files_of_rule_groups_go_with_their_job(spark):
    before, freed = shuffle_files(spark), spark.conf.get(FREED)
    group = lambda m: as_findings(spark.range(400).repartition(3, "id").where(F.col("id") % m == 0), "x", f"r{m}", F.col("id"), "m")
    findings, report = gates.run({"a": [group(2), group(100)], "b": group(50), "c": no_findings(spark), "d": [group(1000), no_findings(spark)], "e": []})
    assert rows(report, "layer", "n_findings", "state") == [("a", 204, "failed"), ("b", 8, "failed"), ("c", 0, "ok"), ("d", 1, "failed"), ("e", 0, "ok")]
    late = time.time() + 20  # files are removed in the background
    while shuffle_files(spark) - before and time.time() < late:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(FREED) == freed
    assert Counter(r[0] for r in findings.select("layer", "rule").collect()) == {"a": 204, "b": 8, "d": 1}
    assert rows(findings.groupBy("layer", "rule").count(), "layer", "rule", "count") == [("a", "r100", 4), ("a", "r2", 200), ("b", "r50", 8), ("d", "r1000", 1)]


def test_ordered_lists_equal_pairs_of_titles_without_a_second_shuffle(spark):
    rng = random.Random(5)
    titles = [None, "a", "a b", "ab", " ", "c"]
    make = lambda n: [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, 1, 2]), rng.choice(titles)) for _ in range(n)]
    m, p = make(60), make(25)
    state = [(k, t) for k in (None, 1, 2, 3, 7, 8) for t in (True, k == 8)] + [(9, None), (10, False)]
    tight = lambda t: None if t is None else t.replace(" ", "")
    readable = {k for k, _, _ in p} - {None}
    odd = []
    for mine, other in ((m, p), (p, m)):
        for k, pos, t in mine:
            met = [x for x in other if None not in (k, pos) and x[:2] == (k, pos)]
            odd += [(k, pos)] * (t is not None) if not met else [(k, pos) for x in met if tight(x[2]) != tight(t)] * (mine is m)
    want = [("page_table_unreadable", None if k is None else str(k), None, "") for k in {k for k, t in state if t} if k not in readable]
    for k in readable & {k for k, _ in odd}:
        places = [pos for x, pos in odd if x == k]
        least = min((x for x in places if x is not None), default=None)
        want.append(("titles_differ", str(k), None if least is None else str(least), str(len(places))))
    dealt = lambda data, shape: spark.createDataFrame(data, shape).repartition(4, "k")
    sides = [dealt(x, "k long, pos long, title string") for x in (m, p)]
    got = model.ordered_list_equal(*sides, dealt(state, "k long, has_table boolean"), "k")
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.select("rule", "entity", "locator", "message").collect()), key=order) == sorted(want, key=order)
    assert exchanges(got) == ["k"] * 3


def test_plans_and_list_items_are_shuffled_before_texts_are_made(spark, tmp_path):
    orders = [(k, k * 3, "F", 100.0, datetime(2024, 1, 1), "1-URGENT") for k in range(1, 40)]
    shape = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(orders, shape).write.parquet(f"{tmp_path}/orders.parquet")
    items = [(k, n, 100 * k + n) for k in range(1, 40) for n in range(1, 4)]
    spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans, lists = (QUERIES[q](spark, str(tmp_path)) for q in ("h19_plan_reach", "g15_ordered_list_equal"))
        assert exchanges(plans) == ["o_orderkey"] * 2
        assert exchanges(lists) == ["l_orderkey"] * 3
        lost = {"stage_names": 5 + 1, "strategy_section": 3 + 1}
        found = Counter(r[0] for r in plans.select("rule").collect())
        assert {rule: found[rule] for rule in lost} == lost
        assert lists.where("rule = 'page_table_unreadable'").count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_rule_counts_come_from_jobs_of_single_rule_groups(spark):
    from corpus_audit.plans import gates as gate_plans  # needs the others to be loaded

    layers = gate_plans.layers(spark, "/root/testdata/sf0.001")
    groups = {n: len(v) for n, v in layers.items() if isinstance(v, list)}
    assert groups == {n: len(g) for n, g in gate_plans.GROUPS.items()} and sum(groups.values()) == 23
    few = {"publish": layers["publish"], "evidence": layers["evidence"][:2] + layers["evidence"][4:5]}
    found, report = gates.run(few)
    counted = found.groupBy("layer").agg(F.count("rule").alias("n"))
    assert rows(counted, "layer", "n") == rows(report.where("n_findings > 0"), "layer", "n_findings") != []
