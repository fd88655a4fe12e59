import random
import re
import zlib
from collections import Counter

import pytest

from dqloom.llm import spelling as S

from tests.llm.conftest import ROWS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, noise=199, least=5, shortest=6):
    n = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= shortest and c >= least}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n):
    form, near = {}, {}
    for w in n:
        around = [v for v in n if one_edit(w, v)]
        near[w] = len(around)
        best = min(around, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], near[w], n.get(form[w])))
    return sorted(out, key=str)


def some_words(seed, letters="abé", n=500):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.choice([6, 6, 7, 7, 8, 9, 12]))): r.choice([5, 6, 7, 30, 40, 200, 1100]) for _ in range(n)}


@pytest.mark.parametrize("letters, shard_words", [("abé", 100_000), ("ab", 40), ("abcdefghij", 60)])
def test_against_brute_force(spark, letters, shard_words):
    n = some_words(len(letters), letters) | {"naïveté": 50, "naïvete": 9, "naïvet": 5, "zzzzzz": 6, "zzzzzzz": 7}
    got = S.spelling_variants(spark.createDataFrame(list(n.items()), "word string, n long"), shard_words=shard_words)
    assert sorted(map(tuple, got.collect()), key=str) == brute(n)


def test_wide_intervals_branch_by_the_alphabet(spark, monkeypatch):
    monkeypatch.setattr(S, "NARROW", 1)
    monkeypatch.setattr(S, "TOGETHER", 17)
    n = some_words(9, "abc", 300)
    words = sorted(n)
    index = S.Index(words)
    for side in ("left", "right"):
        a, b = S.search(index, words, side)
        got = {(words[x], words[y]) for x, y in zip(a, b)}
        half = (lambda w: w[: len(w) // 2]) if side == "right" else (lambda w: w[len(w) // 2 :])
        rest = (lambda w, v: one_edit(w[len(w) // 2 :], v[len(w) // 2 :])) if side == "right" else (lambda w, v: one_edit(w[: len(w) // 2], v[: len(v) - (len(w) - len(w) // 2)]))
        same = (lambda w, v: v.startswith(half(w))) if side == "right" else (lambda w, v: v.endswith(half(w)))
        assert got == {(w, v) for w in words for v in words if same(w, v) and rest(w, v)}


def test_words_of_texts(spark, tmp_path):
    r = random.Random(1)
    base = ["Straße", "naïveté", "letters", "lettres", "ÀÉÎÕÜ×ÿ", "x" * 300]
    rows = [(i, " ".join(r.choice(base) + r.choice(["", "s", "1"]) for _ in range(60))) for i in range(200)] + [(None, "letters " * 9), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = counted(rows)
    assert {x.word: x.n for x in S.vocabulary(docs).collect()} == want
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, S.op13(spark, str(tmp_path)).collect()), key=str) == brute(want)


def test_odd_input(docs, clashing):
    want = counted(ROWS, noise=3, least=1, shortest=1)
    for df in (docs, clashing.withColumn("run", clashing.doc_id).withColumn("word", clashing.doc_id)):
        got = S.vocabulary(df, noise=3, least=1, shortest=1)
        assert {x.word: x.n for x in got.collect()} == want
    assert S.spelling_variants(S.vocabulary(docs.limit(0))).count() == 0
