"""Queries equal their SQL where entity keys have six digits (``ALL_QUERIES=1`` runs every query with SQL)."""

import os
import re

import duckdb
import pytest

from check_oracles import TABLES, cell
from corpus_audit.plans import load_all
from corpus_audit.plans.registry import ORACLES, QUERIES

SF, SHIFT = "/root/testdata/sf0.001", 300_000
KEYS = {
    "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"], "events": ["user_id"], "documents": ["doc_id"], "pages": ["page_id"],
    "labels": ["doc_id"], "conversations": ["conv_id"],
}
# those whose keys become codes, paths or routes
CODED = (
    "b5_ b34_ c4_course c5_ c6_ d2_ d7_next d10_ d11_ e3_ e8_ e9_ e10_ f2_ f3_ g14_ j1_run j2_ j9_ j15_"
).split()

load_all()
NAMES = sorted(n for n in ORACLES if os.environ.get("ALL_QUERIES") or any(re.match(p, n) for p in CODED))


@pytest.fixture(scope="module")
def shifted(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shifted")
    con = duckdb.connect()
    for t in TABLES:
        raised = ", ".join(f"{k} + {SHIFT} AS {k}" for k in KEYS.get(t, []))
        con.execute(f"COPY (SELECT * {f'REPLACE ({raised})' if raised else ''} FROM '{SF}/{t}.parquet') TO '{folder}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", NAMES)
def test_keys_of_six_digits(spark, shifted, name):
    folder, con = shifted
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    rows = lambda found: sorted(tuple(map(cell, r)) for r in found)
    assert rows(QUERIES[name](spark, folder).select(*names).collect()) == rows(want.fetchall())
