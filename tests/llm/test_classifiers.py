import math
import random
import zlib

import numpy as np
import pytest
from dqloom.llm import language_id, toxicity
from dqloom.llm.toxicity import DRIFT, _Words, decay, isotonic, log_odds, segments, stepped

SYLLABLES = {"aa": "the ing ed ation er", "bb": "der ung keit ein sch", "cc": "que eau oir les ment"}


def text(rng, lang, n):
    s = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(s) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        lang, toxic = rng.choice(list(SYLLABLES)), int(rng.random() < 0.2)
        t = text(rng, lang, rng.randint(5, 200)).split()
        for _ in range(3 * toxic):
            t.insert(rng.randint(0, len(t)), rng.choice(["vilefool", "badscum", "nastything"]))
        rows.append((i, " ".join(t).upper() if i % 10 == 0 else " ".join(t), lang, "s", 0))
        labels.append((i, 1, toxic))
    rows += [(1000, None, "aa", "s", 0), (1001, "", None, None, 0), (1002, "12 34 !!", "bb", "s", 0), (None, "the ing", "aa", "s", 0), (5, rows[5][1], rows[5][2], "s", 0)]
    labels += [(None, 1, 1), (3, None, None), (4, 0, 0), (4, 0, 1)]
    at = tmp_path_factory.mktemp("classes")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at), rows, {i: x for i, _, x in labels}


def test_languages_held_out(spark, corpus):
    at, rows, _ = corpus
    got = language_id.op10(spark, at).collect()
    assert len(got) == len(rows)
    lang = {r[0]: r[2] for r in rows}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in got if r.doc_id in (1000, 1001, 1002))
    assert all(0 <= r.score <= 1 for r in got)


def test_identified_rows_keep_their_columns(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id < 900").count() >= 895 and kept.filter("doc_id >= 1000").count() == 0


def test_toxicity_held_out(spark, corpus):
    at, rows, label = corpus
    got = toxicity.op3(spark, at).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.97 * len(held)


def test_without_labels_or_rows(spark, corpus, tmp_path):
    docs, labels = spark.read.parquet(f"{corpus[0]}/documents.parquet"), spark.read.parquet(f"{corpus[0]}/labels.parquet")
    docs.withColumn("lang", docs.lang.substr(9, 1)).filter("doc_id < 20").selectExpr("doc_id", "text", "cast(null as string) as lang", "source", "n_chars").write.parquet(f"{tmp_path}/a/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/a/labels.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    labels.write.parquet(f"{tmp_path}/b/labels.parquet")
    assert {r.lang_pred for r in language_id.op10(spark, f"{tmp_path}/a").collect()} == {"und"}
    assert len({r.score for r in toxicity.op3(spark, f"{tmp_path}/a").collect()}) == 1
    assert language_id.op10(spark, f"{tmp_path}/b").count() == toxicity.op3(spark, f"{tmp_path}/b").count() == 0


def brute_segments(scores):
    """All maximal segments by their definition: the best one, then the same left and right of it."""
    best = max(((sum(scores[i:j]), -i, -j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 1e-12:
        return []
    i, j = -best[1], -best[2]
    return brute_segments(scores[:i]) + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in brute_segments(scores[j:])]


def test_segments_are_all_maximal_ones():
    rng = random.Random(3)
    for _ in range(200):
        dense = [rng.choice([-0.5, -0.5, -0.5, 1.0 + rng.random(), 0.3 + rng.random()]) for _ in range(rng.randint(0, 14))]
        got = segments(np.array(dense))
        want = brute_segments(dense)
        assert [(f, e + 1) for f, e, _ in got] == [(a, b) for a, b, _ in want]
        assert all(math.isclose(g[2], w[2], abs_tol=1e-9) for g, w in zip(got, want))


def test_log_odds_and_curve():
    s = log_odds({"vile": (9, 10), "vilef": (9, 10), "vilefool$": (9, 9), "the$": (10, 100), "kind$": (0, 90)}, 10, 100, 4.0)
    assert s["vilefool$"] > s["vile"] > 1 and abs(s["the$"]) < 0.1 and s["kind$"] < -1  # clean evidence counts as well
    kept = stepped(s)
    words = _Words(kept)
    assert "the$" not in kept and words["the"] == words["unseen"] == -DRIFT and words["vilefool"] > 0 > -DRIFT > words["kind"]
    knots = isotonic([(0, 1, 50), (1, 0, 5), (2, 4, 5), (3, 3, 5), (9, 9, 9)], 0.1)
    assert all(a[0] < b[0] and a[1] <= b[1] for a, b in zip(knots, knots[1:]))
    assert abs(sum(p * math.exp(decay({1.0: 1, -1.0: 3}) * s) for s, p in ((1.0, 0.25), (-1.0, 0.75))) - 1) < 1e-6 and decay({-1.0: 5}) == 1.0


def test_a_very_long_text_and_clashing_columns(spark):
    model = toxicity.Model({"vile$": 4.0}, 0.1)
    long = "calm words here " * 100_000 + "vile vile vile " * 5 + "calm words here " * 100_000
    rows = toxicity.score(spark.createDataFrame([(1, long, 7.0, "x"), (2, None, None, None)], "doc_id long, text string, score double, p string"), model).collect()
    assert [(x.first, x.last) for x in rows[0].passages] == [(300_000, 300_014)] and rows[0].row.score == 7.0 and rows[1].passages == []


def test_numbers_are_no_letters_and_tiny_languages_are_learned(spark):
    from dqloom.llm import language_id as L
    from pyspark.sql import functions as F

    rows = [(i, f"the quick brown fox number {i} jumps over the lazy dog", "en") for i in range(30)] + [(100, "ja", "xx"), (101, "½ ② ²", None), (102, "Ⅳ 42 _", "en"), (103, "ja ja", None), (104, "x" * 300_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("row", F.lit(1)).withColumn("p", F.lit(2)).withColumn("score", F.lit("x"))
    learned = L.learn(df)
    assert set(learned) == {"en", "xx"} and len(learned["xx"]) >= 8
    got = {r["row"]["doc_id"]: (r.lang_pred, r.score) for r in L.classify(df, learned).collect()}
    assert got[101] == got[102] == ("und", 0.0) and got[103][0] in learned and got[3][0] == "en" and len(got) == len(rows)
