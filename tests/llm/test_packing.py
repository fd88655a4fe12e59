from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from dqloom.llm.packing import Bins, op8, pack, pack_shard, packed_texts


def test_always_the_tightest_compatible_bin():
    rng = np.random.default_rng(0)
    for _ in range(60):
        ours = Bins(50, 2)
        for _ in range(rng.integers(1, 150)):
            size, source, cluster = int(rng.integers(1, 51)), int(rng.integers(0, 3)), int(rng.integers(0, 5))
            bit = 1 << cluster if cluster else 0
            fit = [ours.left[b] for b in range(len(ours.left)) if ours.left[b] >= size and not ours.clusters[b] & bit and ours.counts[b].get(source, 0) < 2]
            n = len(ours.left)
            before = list(ours.left)
            b, _ = ours.add(size, source, bit)
            assert (b == n) if not fit else before[b] == min(fit)


def test_hot_cluster_in_a_shard_is_quick():
    pdf = pd.DataFrame({"id": range(20000), "copy": 0, "piece": 0, "n_words": [700] * 8000 + [40] * 12000, "source": ["hot"] * 12000 + ["a", "b"] * 4000, "cluster": [1] * 8000 + list(range(10, 12010))})
    out = pack_shard(pdf, 2048, 4)
    assert out[out.cluster == 1].bin.nunique() == 8000
    assert out.groupby("bin").n_words.sum().max() <= 2048


def test_texts_come_back_whole(spark, docs):
    rows = packed_texts(docs, capacity=50).collect()
    whole = defaultdict(list)
    for r in rows:
        whole[r.doc_id, r.copy, r.source].append((r.piece, r.text))
    texts = sorted("".join(t or "" for _, t in sorted(p, key=lambda x: x[0])) for p in whole.values())
    assert texts == sorted(r.text or "" for r in docs.collect())
    used = Counter()
    for r in rows:
        if r.bin_id is not None:
            used[r.bin_id] += r.n_words
    assert max(used.values()) <= 50 and all((r.bin_id is None) == (r.n_words == 0) for r in rows)


def test_conflicts_and_query(spark, sf, sf_empty, docs):
    rows = pack(docs).collect()
    for b, n in Counter((r.bin_id, r.cluster) for r in rows if r.bin_id is not None).items():
        assert n == 1
    assert op8(spark, sf).count() == pack(docs).count() and op8(spark, sf_empty).count() == 0


def test_texts_of_one_id_and_columns_of_other_names(spark, clashing):
    """Texts of one id that differ in white space only, so that their pieces differ in number, and columns with names of our own."""
    a, b = " ".join("ab" for _ in range(9)), " ".join("abab" for _ in range(4)) + " ab"
    docs = spark.createDataFrame([(1, a, "s", 0), (1, b, "s", 0), (1, b, "s", 0), (None, a, None, 0)], "doc_id long, text string, source string, piece int")
    rows = packed_texts(docs, capacity=6).collect()
    whole = defaultdict(list)
    for r in rows:
        whole[r.doc_id, r.copy, r.n_words + r.start if r.piece else None, r.source].append(r)
    assert sorted("".join(x.text for x in sorted((r for r in rows if r.doc_id is None), key=lambda r: r.piece)).split()) == ["ab"] * 9
    assert sum(r.n_words for r in rows if r.doc_id == 1) == 9 + 5 + 5 and sum(len(r.text.split()) for r in rows if r.doc_id == 1) == 19
    assert pack(clashing).count() == pack(clashing.select("doc_id", "text", "source")).count()
