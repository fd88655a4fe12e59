from collections import Counter, defaultdict

import corpus_pipeline as P

from tests.llm.test_ngram_join import variants


def test_stages_against_plain_counterparts(spark, tmp_path):
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in variants(8, 4, 12)]
    rows += [(100 + i, rows[i][1].replace(" ", "  "), "en", "s1", 0) for i in range(5)]  # exact copies but for white space
    rows += [(200, None, "en", "s1", 0), (201, "123 456", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(Counter(r.doc_id for r in docs.collect()))
    assert set(kept[0]) == {r[0] for r in rows} - {200, 201}
    copies = defaultdict(list)
    for i, t, *_ in rows[:-2]:
        copies["".join(t.split())].append((-len(t), i))
    assert set(kept[1]) == {min(g)[1] for g in copies.values()}
    from tests.llm.test_ngram_join import brute

    left = [r for r in rows if r[0] in kept[1]]
    assert set(kept[2]) == {r[2] for r in brute(left)}
    assert set(kept[3]) <= set(kept[2]) and max(kept[3].values()) <= 3
    whole = defaultdict(list)
    packed = P.run(spark, str(tmp_path)).collect()
    for r in packed:
        whole[r.doc_id, r.copy].append((r.piece, r.text))
    texts = {r[0]: r[1] for r in rows}
    assert all("".join(t for _, t in sorted(p)) == texts[i] for (i, _), p in whole.items())
    assert Counter(i for i, _ in whole) == kept[3]


def test_empty_tables_repeated_rows_and_other_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert P.run(spark, f"{tmp_path}/empty").count() == 0
    texts = [" ".join(f"{w}{k}{w}" for k in range(30)) for w in ("alpha", "beta", "gamma", "delta")]
    rows = [(i % 4, texts[i % 4] if i % 8 < 4 else texts[(i + 1) % 4] + " and more", "en", None if i % 3 else "s", 0) for i in range(24)] + [(None, texts[0], "en", "s", 0), (None, None, None, None, None), (7, "", "en", "s", 0), (8, "word " * 9000, "en", "s", 0)]
    docs = spark.createDataFrame(rows, schema)
    for c in ("id", "key", "row", "size", "h", "salt", "kept", "k", "n", "hash", "place"):
        docs = docs.withColumn(c, docs.doc_id)
    docs.write.parquet(f"{tmp_path}/odd/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/odd/documents.parquet")
    # Each text and its variant with two more words are one group; the variant of the next text has the smaller id in all but the first and last group.
    for name, stage in P.STAGES[1:3]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    left = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(left) == len(set(left)) and sum(not (t or "").strip() for _, t in left) == 1 and (8, "word " * 9000) in left
    assert sorted(i for i, t in left if t and not t.startswith("word")) == [0, 0, 1, 2]
    mixed = P.STAGES[3][1](spark, docs, str(tmp_path))
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert P.STAGES[4][1](spark, docs, str(tmp_path)).filter("bin_id is null").count() == 1
