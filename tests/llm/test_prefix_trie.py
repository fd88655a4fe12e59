import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from dqloom.llm import prefix_trie as T


def brute(rows, rebuild=True):
    """All nodes by plain dictionaries."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) if children[p] else 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in children[p])
        ends = sorted(c for c in members[p] if len(built[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def some_rows(seed, convs=260, longest=30):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(convs * 2), convs):
        for t in range(r.choice([0, 1, 2, 3, 7, 8, 9, longest])):
            rows.append((c, r.choice([t, t, t, None]), r.choice(["user", "user", None]), r.choice(["hi", "hi", "é" * 5, None, ""])))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, tmp_path, seed):
    rows = some_rows(seed)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert sorted(map(tuple, T.op11(spark, str(tmp_path)).collect()), key=str) == brute(rows)


def test_long_chains_small_pieces_and_streamed_ends(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 4)
    monkeypatch.setattr(T, "IDS", 3)
    rows = [(c, t, "user", "same") for c in range(40) for t in range(60 if c % 4 == 0 else c % 7)] + [(-5, 1, "user", "same"), (-5, 2, "user", "other")]
    got = T.trie(spark.createDataFrame(rows, SCHEMA).repartition(7), block=3)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, rebuild=False)


def test_hot_first_turn_and_long_conversation(spark):
    rows = [(c, t, "user", "start" if t == 0 else f"{c}-{t}") for c in range(1, 600) for t in range(3)] + [(700, t, "user", f"x{t % 5}") for t in range(2500)]
    got = T.trie(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, rebuild=False)


def test_odd_input(spark):
    rows = [(None, 1, "user", "no id"), (1, None, None, None), (1, None, None, None), (2, 1, "user", "a" * 200_000), (2, 1, "user", "a" * 200_000), (3, 5, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("pos", "n", "k0", "block", "depth", "digest", "up", "t1", "head", "h"):
        df = df.withColumn(c, df.turn)
    assert sorted(map(tuple, T.trie(df).collect()), key=str) == brute(rows, rebuild=False)
    assert T.trie(df.limit(0)).count() == 0
