import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest

from dqloom.llm import substring_dedup as S

from tests.llm.conftest import ROWS


def brute(rows, window=35):
    texts = [(r[0], re.findall(r"[^\x20\x09-\x0d]+", r[1] or "")) for r in rows]
    seen = Counter(tuple(w[i : i + window]) for _, w in texts for i in range(len(w) - window + 1))
    out = []
    for i, w in texts:
        gone = {j for s in range(len(w) - window + 1) if seen[tuple(w[s : s + window])] > 1 for j in range(s, s + window)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in df.collect()), key=str)


def some_rows(seed, n=300):
    r = random.Random(seed)
    vocab = [f"w{i}é" for i in range(400)] + ["a", "b"]
    shared = [[r.choice(vocab) for _ in range(r.choice([34, 35, 36, 60]))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = [r.choice(vocab) for _ in range(r.choice([0, 5, 34, 35, 80, 300]))]
        for _ in range(r.choice([0, 0, 1, 2])):
            at = r.randint(0, len(words))
            words[at:at] = r.choice(shared)
        rows.append((i, "".join(w + r.choice([" ", "  ", "\n", "\t\x0b"]) for w in words)))
    # copies, near copies, a text that repeats itself
    rows += [(n + i, rows[i % 7][1]) for i in range(40)]
    rows += [(n + 100 + i, re.sub(r"w1\dé", "edited", rows[i][1], count=1)) for i in range(20)]
    rows += [(None, "la " * 50), (n + 200, "x y " * 40), (n + 201, "once " + "x y " * 10)]
    return rows


@pytest.mark.parametrize("max_counters", [S.MAX_COUNTERS, 0])
@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed, max_counters, monkeypatch):
    monkeypatch.setattr(S, "FLUSH", 500)
    monkeypatch.setattr(S, "TEXTS", 3000)
    rows = some_rows(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(S.remove_repeats(docs, max_counters=max_counters)) == brute(rows)


def test_full_filter_and_short_windows(spark, monkeypatch):
    monkeypatch.setattr(S, "pow2_at_least", lambda n: 1)
    rows = some_rows(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(S, "SLICE", 1 << 10)
    assert result(S.remove_repeats(docs, window=9, anchor=3)) == brute(rows, 9)


def test_estimates_are_never_too_small_and_are_checked(spark, monkeypatch):
    """With anchors of one word almost every window is estimated repeated; the result is the same."""
    rows = some_rows(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(S.remove_repeats(docs, anchor=1)) == brute(rows)


def test_odd_input(docs, clashing, spark):
    want = brute(ROWS)
    assert result(S.remove_repeats(docs)) == want
    assert result(S.remove_repeats(clashing.withColumn("once", clashing.doc_id).withColumn("alone", clashing.doc_id))) == want
    assert S.remove_repeats(docs.limit(0)).count() == 0
    named = docs.selectExpr("cast(doc_id as string) as doc_id", "text")
    assert {r.id for r in S.remove_repeats(named).collect()} == {None if r[0] is None else str(r[0]) for r in ROWS}


def test_sql(spark, sf):
    got = sorted(map(tuple, S.op12(spark, sf).collect()), key=str)
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{sf}/documents.parquet/*.parquet'")
    assert got == sorted(c.sql(S.OP12_SQL).fetchall(), key=str)
