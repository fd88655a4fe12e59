import hashlib
import re
from collections import defaultdict

from dqloom.llm.exact_dedup import drop_copies, find_copies, op9

from tests.llm.conftest import ROWS


def brute(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), i is None, i or 0, i))
    out = []
    for k, g in groups.items():
        g.sort(key=lambda x: x[:3])
        out += [(x[3], g[0][3], len(g), n == 0, hashlib.sha256(k.encode()).hexdigest()) for n, x in enumerate(g)]
    return sorted(out, key=str)


def test_against_brute_force(spark, sf):
    assert sorted(map(tuple, op9(spark, sf).collect()), key=str) == brute(ROWS)


def test_empty(spark, sf_empty):
    assert op9(spark, sf_empty).count() == 0


def test_tiny_filter_is_exact(docs):
    got = find_copies(docs.repartition(5), max_bits=1, salts=3)
    assert {(r.id, r.keep_id, r.group_size) for r in got.collect()} == {x[:3] for x in brute(ROWS)}


def test_drop_copies_keeps_one_row_and_all_columns(clashing):
    got = drop_copies(clashing)
    assert got.columns == clashing.columns
    want = sorted((x[0] for x in brute(ROWS) if x[3]), key=str)
    assert sorted((r.doc_id for r in got.collect()), key=str) == want
    assert sorted(r.text or "" for r in got.collect()) == sorted(next(y[1] or "" for y in ROWS if y[0] == i) for i in want)


def test_hot_group(spark):
    rows = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same text', concat('t', id)) as text")
    got = find_copies(rows).collect()
    assert sum(r.kept for r in got) == 2001 and sum(r.group_size == 1000 for r in got) == 1000
