import re
from itertools import combinations

import numpy as np
from dqloom.llm import ngram_join as J
from dqloom.llm.components import components

from tests.llm.conftest import ROWS


def shingles(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0d]+", lower)
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute(rows):
    """(id, n_shingles, component, members) of each row."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * len(sets[i] | sets[j]):
            root[top(i)] = top(j)
    out = []
    for i, r in enumerate(rows):
        members = [k for k in range(len(rows)) if top(k) == top(i)]
        ids = [rows[k][0] for k in members if rows[k][0] is not None]
        out.append((r[0], len(sets[i]), min(ids) if ids else None, len(members)))
    return sorted(out, key=str)


def variants(seed, families, size):
    """Texts of families whose members differ in a few words from one base, some of them near the threshold."""
    rng = np.random.default_rng(seed)
    rows, shared = [], " ".join(f"s{k}" for k in range(60))
    for f in range(families):
        base = [f"w{f}_{k}" for k in rng.integers(0, 400, size=120)]
        for _ in range(size):
            words = list(base)
            for k in rng.integers(0, len(words), size=rng.integers(0, 6)):
                words[k] = f"x{rng.integers(1 << 30)}"
            if rng.random() < 0.2:
                words = words[: rng.integers(80, 120)]
            text = " ".join(words)
            rows.append((len(rows), f"{shared} {text}" if f % 2 else text))
    return rows


def test_fixture(spark, sf, sf_empty):
    got = sorted(map(tuple, J.op2(spark, sf).collect()), key=str)
    assert got == brute(ROWS)
    assert J.op2(spark, sf_empty).count() == 0


def test_families_near_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(J, "TILE", 8)  # long lists are cut into tiles
    monkeypatch.setattr(J, "CHUNK_TOKENS", 700)
    monkeypatch.setattr(J, "BATCH_TOKENS", 1500)
    monkeypatch.setattr(J, "HEAVY", 40)
    monkeypatch.setattr(J, "BROADCAST_IDS", 20)  # larger tables are joined by a shuffle
    pieces = []
    monkeypatch.setattr(J, "components", lambda links: pieces.append(links.count()) or components(links))
    rows = variants(3, 6, 25)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.id, r.n_shingles, r.component_id, r.members) for r in J.groups(df).collect()), key=str)
    assert got == brute(rows)
    # Every link comes out of the trees: enough of them to hold the groups together.
    in_groups = {(c, m) for _, _, c, m in got if m > 1}
    distinct = {frozenset(shingles(t)) for _, t in rows}
    assert pieces and pieces[-1] >= len({frozenset(shingles(t)) for i, t in rows if any(r[0] == i and r[3] > 1 for r in got)}) - len(in_groups) > 20
    assert len(distinct) > 100


def test_filter_keeps_every_document_with_a_partner():
    """Two sets with just the least overlap share enough of the n-grams that are sent, in any order of hashes."""
    rng = np.random.default_rng(11)
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        m = int(rng.integers(J.least(n, 80), 100 * n // 80 + 1)) or 1
        both = -(-80 * (n + m) // 180)
        if both > min(n, m):
            continue
        h = rng.permutation(n + m - both)
        a, b = np.sort(h[:n]), np.sort(np.r_[h[:both], h[n:]])
        x, y = a[: J.sent(n, 80)], b[: J.sent(m, 80)]
        assert len(np.intersect1d(x, y)) >= max(J.needed(n, 80), J.needed(m, 80))
        assert len(np.intersect1d(a[: J.met(n, 80)], b[: J.met(m, 80)])) >= 1


def test_one_of_each_tells_texts_of_one_id_apart(spark):
    a, near, other = " ".join(f"w{k}" for k in range(40)), " ".join(f"w{k}" for k in range(39)), "a text of its own that nothing else resembles at all"
    docs = spark.createDataFrame([(3, a), (5, near), (5, other), (None, a), (None, "some text that stands alone without an id"), (9, other)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in J.one_of_each(docs).collect()), key=str)
    assert got == sorted([(3, a), (5, other), (None, "some text that stands alone without an id")], key=str)


def test_trees_lose_no_similar_pair():
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 1 << 63, size=n).astype(np.uint64)) for n in (3, 9, 40, 200, 260)]
    sets = []
    for b in base:
        for _ in range(30):
            keep = b[rng.random(len(b)) < rng.choice([0.75, 0.9, 1.0])]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, size=rng.integers(0, 1 + len(b) // 8)).astype(np.uint64)])))
    sets = [s for s in sets if len(s)]
    label = np.arange(len(sets)) // 2

    def groups_of(links):
        g = label.copy()
        for x, y in links:
            assert J.similar(sets[x], sets[y])
            g[g == g[y]] = g[x]
        return g

    want = [(i, j) for i, j in combinations(range(len(sets)), 2) if J.similar(sets[i], sets[j])]
    links = J.tree_links(sets, label, np.zeros(len(sets), int), 80)
    assert len(links) < len(sets)
    same = groups_of(links)
    assert all(same[i] == same[j] for i, j in want) and len(set(same)) == len(set(groups_of(want)))
    side = np.arange(len(sets)) % 2
    across = groups_of(J.tree_links(sets, label, side, 80))
    assert all(across[i] == across[j] for i, j in want if side[i] != side[j])


def test_one_of_each_keeps_columns(clashing):
    got = J.one_of_each(clashing)
    assert got.columns == clashing.columns
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 8, 9, 10, 11]


def test_components_of_stars_and_of_a_long_chain(spark):
    rng = np.random.default_rng(2)
    chain = [(k, k + 1) for k in range(100, 160)]
    stars = [(1, k) for k in range(2, 30)] + [(25, k) for k in range(40, 60)] + [(59, 3)]
    pairs = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in chain + stars]
    got = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: 100 if n >= 100 else 1 for pair in pairs for n in pair}
