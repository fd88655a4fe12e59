"""Documents whose sets of word n-grams have a Jaccard similarity of THRESHOLD percent or more, and the groups they form.

Exact, in these steps (n-grams are 64-bit hashes throughout; "node" is one distinct set, so exact copies are one node):

1. Overlap filter, one pass over all texts. Similar sets share a known least number of n-grams among the first ``sent(n)`` of either, in
   order of hashes. Chunks of the hash range count from packed 32-bit tails in how many nodes each of those n-grams occurs; a
   document that shares fewer of its own than it must is a group of its own and leaves here. A batch sends an n-gram that several of its nodes
   share once, with a count, so the most frequent one costs a few bytes for each batch.
2. Routing. Two similar sets also share an n-gram among the first ``met(n)`` of either in any one order. Taken is the order of rising
   document frequency (known from step 1, exact for the at most ``HEAVY`` most frequent n-grams, the others before them by hash), so
   that boilerplate comes last. The holders of an n-gram meet in the tree of the least of them, the anchor: the lists of one family mostly
   have one anchor, so its sets meet once and not once for each n-gram.
3. Signature trees find the links. An anchor's holders are the leaves; leaves and inner nodes hold the OR of their sets' token bitmaps, size
   ranges and the least bits that a partner must share. A dual traversal keeps a pair of tree nodes only if sizes fit, the common bits
   can reach the overlap and the two sides are not in one group yet; a pair of sets that comes through is checked on the sets themselves.
   An anchor with more than ``TILE`` sets or ``TILE_BYTES`` of them has several trees, each of which has the anchor too, so that the parts of a
   family come together in linear work. Only where such an anchor's sets are still in several groups do its trees also traverse
   each other: on bitmaps of a byte or two an n-gram first; sets that may have a partner are then sent in full.
4. Components are built from all links. Links inside a group that are not needed to connect it are not listed.

Nulls and odd input: a null or empty text has no n-grams, n_shingles 0 and is its own component; texts of fewer words than n are
one n-gram; very long texts are taken whole (one set is never split, a tree of them has fewer sets); a similarity of exactly
THRESHOLD links; a null id gets the least id of its group, or null; rows that repeat are nodes of one set; rows of one id and
different texts are different documents; an empty table gives an empty result; further columns are ignored by ``groups`` and carried by
``one_of_each``. docs has to give the same rows in the same order when a task is run again, as a table does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import batches_of, discard, freed, release, table, whole, written
from dqloom.llm.components import components, joined_salted

N = 5
THRESHOLD = 80
#: N-grams that a task holds at once, and those that a chunk of the hash range gets on average.
BATCH_TOKENS = 250_000
CHUNK_TOKENS = 1_500_000
#: Parts (a power of two) in which a chunk is sorted, one after the other.
PIECES = 8
#: So many n-grams have an exact place in the order of frequency (12 bytes each are broadcast). It changes work, not results.
HEAVY = 1 << 20
TILE = 1024
TILE_BYTES = 4 << 20
#: Up to so many rows of two or three numbers each are broadcast; beyond that they are joined by a shuffle.
BROADCAST_IDS = 1_000_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 50_000:
            self[word] = h
        return h


_WORDS = _Words()


def ngrams(text: str, n: int = N) -> np.ndarray:
    """Sorted distinct hashes of the text's n-grams of words."""
    words = text.encode("utf-8", "replace").lower().split()  # both as bytes: A-Z only, and the six white-space characters
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(n, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - k + 1, k, np.uint64)
        for i in range(k):
            h = h * _MULTIPLIER + w[i : len(w) - k + 1 + i]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def set_hash(s: np.ndarray) -> bytes:
    return blake2b(s.tobytes(), digest_size=16).digest()


def similar(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    if min(len(a), len(b)) * 100 < threshold * max(len(a), len(b)) or not len(a):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both)


# How many n-grams of a set of n take part. Similar sets of n and m have at least least(n) and least(m) in common, so with l more of
# each than can be without a partner they share l of those: l is a fifth of the set, and a partner is at least of size least(n).


def least(n, threshold: int):
    """The least overlap of a set of n with a similar one."""
    return -(-threshold * n // 100)


def met(n, threshold: int):
    return n - least(n, threshold) + 1


def sent(n: int, threshold: int) -> int:
    return min(n, met(n, threshold) - 1 + max(1, n // 5))


def needed(n: int, threshold: int) -> int:
    return max(1, least(n, threshold) // 5)


# 1. Which documents can have a partner

_PARTS = ", ".join(f"p{i} binary" for i in range(7))
_SCAN = f"slot int, kind int, batch long, {_PARTS}"
_COUNTED = f"kind int, batch long, {_PARTS}"
_FOUND = "kind int, id long, hash long, n long, node binary, possible boolean, chunk long, tails binary, counts binary"


def _chunk_of(h: np.ndarray, chunks: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(chunks)) >> np.uint64(32)


def _tail(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def _scan(chunks: int, n: int, threshold: int):
    """By batch one row of kind 0, with its documents and nodes, and by chunk one of kind 1, with its n-grams: those of one node by node, and those of more nodes with counts."""

    def pack(batch: int, ids: list, hashes: list, which: list[int], nodes: list[bytes], sets: list[np.ndarray]) -> pd.DataFrame:
        known = np.array([x is not None for x in ids])
        sizes = np.array([len(s) for s in sets], np.int64)
        parts = [s[: sent(len(s), threshold)] for s in sets]
        h = np.concatenate(parts)
        node = np.repeat(np.arange(len(sets)), [len(s) for s in parts])
        order = np.argsort(h, kind="stable")
        h, node = h[order], node[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
        times = np.diff(np.r_[first, len(h)])
        single = np.repeat(times == 1, times)
        own = np.bincount(node[~single], minlength=len(sets))
        again, agains = h[first][times > 1], times[times > 1].astype(np.uint32)
        once, node = h[single], node[single]
        rows = [(batch % chunks, 0, batch, np.array([x or 0 for x in ids], np.int64).tobytes(), known.tobytes(), np.array(hashes, np.int64).tobytes(), np.array(which, np.uint32).tobytes(), b"".join(nodes), sizes.tobytes(), own.tobytes())]
        ends, ends2 = (np.searchsorted(_chunk_of(x, chunks), np.arange(chunks + 1, dtype=np.uint64)) for x in (once, again))
        tags = np.frombuffer(b"".join(x[:8] for x in nodes), np.uint64)
        for c in np.flatnonzero((np.diff(ends) > 0) | (np.diff(ends2) > 0)):
            part, more = slice(ends[c], ends[c + 1]), slice(ends2[c], ends2[c + 1])
            by = np.argsort(node[part], kind="stable")
            who, count = np.unique(node[part], return_counts=True)
            rows.append((int(c), 1, batch, who.astype(np.uint32).tobytes(), count.astype(np.uint32).tobytes(), tags[who].tobytes(), _tail(once[part][by]).tobytes(), _tail(again[more]).tobytes(), agains[more].tobytes(), None))
        return _frame(rows, _SCAN)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        batch = TaskContext.get().partitionId() << 32
        ids, hashes, which, number, sets, total = [], [], [], {}, [], 0
        for pdf in batches:
            for x, h, text in zip(pdf["id"], pdf["hash"], pdf["text"], strict=True):
                s = ngrams(text, n)
                node = set_hash(s)
                if node not in number:
                    number[node] = len(sets)
                    sets.append(s)
                    total += len(s)
                ids.append(None if pd.isna(x) else int(x))
                hashes.append(int(h))
                which.append(number[node])
                if total >= BATCH_TOKENS or len(ids) >= BATCH_TOKENS // 4:
                    yield pack(batch, ids, hashes, which, list(number), sets)
                    batch += 1
                    ids, hashes, which, number, sets, total = [], [], [], {}, [], 0
        if ids:
            yield pack(batch, ids, hashes, which, list(number), sets)
        _WORDS.clear()
        release()

    return run


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """For one chunk and each batch: how many of a node's n-grams another node has too; and the chunk's frequent n-grams. Rows of kind 0 pass."""
    out = [(0, *r[2:]) for r in pdf[pdf["kind"] == 0].itertuples(index=False)]
    part = pdf[pdf["kind"] == 1]
    if not len(part):
        return _frame(out, _COUNTED)
    read = lambda column, kind: [np.frombuffer(b, kind) for b in part[column]]
    who, times, tags = read("p0", np.uint32), read("p1", np.uint32), read("p2", np.uint64)
    sizes = np.array([t.sum() for t in times])
    tails, again, agains = np.concatenate(read("p3", np.uint32)), np.concatenate(read("p4", np.uint32)), np.concatenate(read("p5", np.uint32))
    tag, owner = np.concatenate(tags), np.repeat(np.arange(sum(map(len, tags)), dtype=np.uint32), np.concatenate(times))
    shared, frequent = np.zeros(len(tails), bool), []
    for piece in range(PIECES):  # a part of the tails' range at a time, so that a task holds little more than the chunk itself
        at, also = (np.flatnonzero(x >> np.uint32(33 - PIECES.bit_length()) == piece) for x in (tails, again))
        # Nodes of each tail: different tags among single ones, and the counts of the others.
        t, g = tails[at], tag[owner[at]]
        order = np.lexsort((g, t))
        t, g = t[order], g[order]
        other = np.ones(len(t), bool)
        other[1:] = (t[1:] != t[:-1]) | (g[1:] != g[:-1])
        values, place = np.unique(np.concatenate([t[other], again[also]]), return_inverse=True)
        number = np.bincount(place, weights=np.concatenate([np.ones(int(other.sum())), agains[also]]), minlength=len(values)).astype(np.int64)
        if len(at):
            shared[at] = number[np.searchsorted(values, tails[at])] > 1
        often = number >= 16
        frequent.append((values[often], np.minimum(number[often], 0xFFFFFFFF).astype(np.uint32)))
    del tails, owner, tag
    ends = np.cumsum(sizes)
    for batch, w, m, lo, hi in zip(part["batch"], who, times, ends - sizes, ends, strict=True):
        hits = np.bincount(np.repeat(np.arange(len(m)), m), weights=shared[lo:hi], minlength=len(m)).astype(np.uint32)
        if hits.any():
            out.append((1, batch, w[hits > 0].tobytes(), hits[hits > 0].tobytes(), *[None] * 5))
    if any(len(v) for v, _ in frequent):
        out.append((2, -1 - int(part["slot"].iloc[0]), *(np.concatenate(x).tobytes() for x in zip(*frequent, strict=True)), *[None] * 5))
    return _frame(out, _COUNTED)


def _summed(threshold: int):
    """The documents of one batch, and whether each may have a partner; frequent n-grams pass."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kinds = dict(iter(pdf.groupby("kind")))
        out = [(2, None, None, None, None, None, -1 - int(r.batch), r.p0, r.p1) for r in (kinds[2].itertuples(index=False) if 2 in kinds else [])]
        for r in kinds[0].itertuples(index=False) if 0 in kinds else []:
            ids, known, hashes, which = np.frombuffer(r.p0, np.int64), np.frombuffer(r.p1, bool), np.frombuffer(r.p2, np.int64), np.frombuffer(r.p3, np.uint32)
            sizes, found = np.frombuffer(r.p5, np.int64), np.frombuffer(r.p6, np.int64).copy()
            for p in kinds[1].itertuples(index=False) if 1 in kinds else []:
                found[np.frombuffer(p.p0, np.uint32)] += np.frombuffer(p.p1, np.uint32)
            may = [k >= needed(n, threshold) > 0 and n > 0 for n, k in zip(sizes.tolist(), found.tolist(), strict=True)]
            out += [(0, i if k else None, h, int(sizes[w]), r.p4[16 * w : 16 * w + 16], may[w], None, None, None) for i, k, h, w in zip(ids.tolist(), known.tolist(), hashes.tolist(), which.tolist(), strict=True)]
        return _frame(out, _FOUND).astype({c: "Int64" for c in ("id", "hash", "n", "chunk")})

    return run


def _documents(rows: DataFrame, n: int, threshold: int) -> tuple[DataFrame, tuple[int, np.ndarray, np.ndarray]]:
    """(id, hash, n, node, possible) for rows (id, hash, text), and the order of frequent n-grams: number of chunks, their (chunk, tail) keys and frequencies."""
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(0.4 * chars / 6 / CHUNK_TOKENS))
    with batches_of(rows.sparkSession, 500):
        counted = rows.mapInPandas(_scan(chunks, n, threshold), _SCAN).groupBy("slot").applyInPandas(freed(_counted), _COUNTED)
        found = written(counted.groupBy("batch").applyInPandas(freed(_summed(threshold)), _FOUND), "docs")
    return found.filter("kind = 0").select("id", "hash", "n", "node", "possible"), (chunks, *_order(found.filter("kind = 2").select("chunk", "tails", "counts")))


def _order(frequent: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and frequencies of at most HEAVY n-grams: all that are at least as frequent as some power of two."""

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            level = np.concatenate([np.log2(np.frombuffer(b, np.uint32)).astype(np.int64) for b in pdf["counts"]]) if len(pdf) else np.empty(0, np.int64)
            number = np.bincount(level, minlength=33)
            yield pd.DataFrame({"level": np.flatnonzero(number), "number": number[number > 0]})

    levels, cut, total = {r.level: r.number for r in frequent.mapInPandas(sizes, "level long, number long").groupBy("level").agg(F.sum("number").alias("number")).collect()}, 33, 0
    while cut > 0 and total + levels.get(cut - 1, 0) <= HEAVY:
        cut, total = cut - 1, total + levels.get(cut - 1, 0)

    def above(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for chunk, tails, counts in zip(pdf["chunk"], pdf["tails"], pdf["counts"], strict=True):
                t, c = np.frombuffer(tails, np.uint32), np.frombuffer(counts, np.uint32)
                keep = c >= (1 << cut)
                yield pd.DataFrame({"chunk": [chunk], "tails": [t[keep].tobytes()], "counts": [c[keep].tobytes()]})

    rows = frequent.mapInPandas(above, "chunk long, tails binary, counts binary").collect() if total else []  # total <= HEAVY
    keys = [np.frombuffer(r.tails, np.uint32).astype(np.uint64) | (np.uint64(r.chunk) << np.uint64(32)) for r in rows]
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    keys, counts = np.concatenate(keys), np.concatenate([np.frombuffer(r.counts, np.uint32) for r in rows])
    order = np.argsort(keys)
    return keys[order], counts[order]


# 2. Which sets meet


def _sets(rows: DataFrame, n: int) -> DataFrame:
    """(node, k, n, tokens) of the texts' sets; k is a number for the node (two nodes of one number only meet once more)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = {set_hash(s): s for t in pdf["text"] if len(s := ngrams(t, n))}
            keys = np.frombuffer(b"".join(x[:8] for x in found), np.int64)
            yield pd.DataFrame({"node": list(found), "k": keys, "n": [len(s) for s in found.values()], "tokens": [s.tobytes() for s in found.values()]})
        _WORDS.clear()
        release()

    return rows.select("text").mapInPandas(run, "node binary, k long, n long, tokens binary")


def _posts(sets: DataFrame, order: tuple[int, np.ndarray, np.ndarray], threshold: int) -> DataFrame:
    """(token, k, n) of each set's first n-grams in the order of rising frequency."""
    chunks, keys, counts = order
    shared = sets.sparkSession.sparkContext.broadcast((keys, counts))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts = shared.value
        for pdf in batches:
            tokens = []
            for b, n in zip(pdf["tokens"], pdf["n"].tolist(), strict=True):
                s = np.frombuffer(b, np.uint64)
                if len(keys):
                    key = (_chunk_of(s, chunks) << np.uint64(32)) | (s & np.uint64(0xFFFFFFFF))
                    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    s = s[np.argsort(np.where(keys[at] == key, counts[at], 0), kind="stable")]
                tokens.append(s[: met(n, threshold)])
            size = [len(t) for t in tokens]
            yield pd.DataFrame({"token": np.concatenate(tokens).view(np.int64) if tokens else [], "k": np.repeat(pdf["k"].to_numpy(), size), "n": np.repeat(pdf["n"].to_numpy(), size)})

    return sets.select("k", "n", "tokens").mapInPandas(run, "token long, k long, n long")


def _members(posts: DataFrame) -> DataFrame:
    """(anchor, k, n): the sets that meet at each anchor, the least holder of an n-gram."""
    lists = posts.groupBy("token").agg(F.min("k").alias("anchor"), F.max("k").alias("last")).filter("anchor <> last")
    lists = _small(written(lists.select(F.col("token").alias("t"), "anchor"), "lists"))
    return posts.join(lists, F.col("token") == F.col("t")).groupBy("anchor", "k").agg(F.max("n").alias("n"))


def _small(rows: DataFrame, most: int | None = None) -> DataFrame:
    """rows (of a few numbers each) for a broadcast if there are few of them, else as they are."""
    return F.broadcast(rows) if rows.count() <= (BROADCAST_IDS if most is None else most) else rows


# 3. Signature trees


def _bitmap(s: np.ndarray, each: int) -> np.ndarray:
    """At least so many bits for each n-gram, a power of two of them."""
    m = max(64, 1 << (each * len(s) - 1).bit_length())
    bits = np.zeros(m, np.uint8)
    bits[(s & np.uint64(m - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap with fewer bits: the OR of its parts (an n-gram's place is taken modulo the number of bits)."""
    return np.bitwise_or.reduce(bits.reshape(*bits.shape[:-1], -1, words), axis=-2)


class Tree:
    """Signature tree over sets of one bitmap width: level 0 has the sets, each level above the OR of FAN nodes below."""

    FAN = 4

    def __init__(self, n: np.ndarray, bits: np.ndarray, label: np.ndarray, threshold: int, places: np.ndarray):
        order = np.lexsort((n, label))
        n, bits, label = n[order], bits[order], label[order]
        self.places = places[order]
        need = np.bitwise_count(bits).sum(axis=1).astype(np.int64) - ((100 - threshold) * n) // 100
        self.levels = [(bits, n, n, label, label, need)]
        while len(self.levels[-1][1]) > 1:
            b, lo, hi, l0, l1, need = self.levels[-1]
            at = np.arange(0, len(lo), self.FAN)
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.minimum.reduceat(l0, at), np.maximum.reduceat(l1, at), np.minimum.reduceat(need, at)))

    def at(self, level: int) -> tuple:
        return self.levels[min(level, len(self.levels) - 1)]

    def narrowed(self, words: int, threshold: int) -> Tree:
        """The same tree with folded bitmaps (and needs that hold for them)."""
        out = object.__new__(Tree)
        out.places, out.levels = self.places, []
        for i, (b, lo, hi, l0, l1, need) in enumerate(self.levels):
            b = _fold(b, words)
            if i == 0:
                need = np.bitwise_count(b).sum(axis=1).astype(np.int64) - ((100 - threshold) * lo) // 100
            else:
                need = np.minimum.reduceat(out.levels[-1][5], np.arange(0, len(out.levels[-1][1]), self.FAN))
            out.levels.append((b, lo, hi, l0, l1, need))
        return out


def traverse(left: Tree, right: Tree, threshold: int, label: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets, one of each tree, in different groups that may be similar; as places before ordering, in pieces.

    label: groups of left's and right's sets by place (one array for both). It may change between pieces: pairs that were brought
    together meanwhile are left out.
    """
    same, depth = left is right, max(len(left.levels), len(right.levels)) - 1
    work = [(depth, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    step = max(1, 1_000_000 // max(1, left.levels[0][0].shape[1]))
    while work:
        level, i, j = work.pop()
        if len(i) > step:
            work += [(level, i[k : k + step], j[k : k + step]) for k in range(0, len(i), step)]
            continue
        a, b = left.at(level), right.at(level)
        ok = (100 * a[2][i] >= threshold * b[1][j]) & (100 * b[2][j] >= threshold * a[1][i])
        if level:
            ok &= ~((a[3][i] == a[4][i]) & (b[3][j] == b[4][j]) & (a[3][i] == b[3][j]))
        else:
            ok &= label[left.places[i]] != label[right.places[j]]
            ok &= (i < j) if same else True
        i, j = i[ok], j[ok]
        ok = np.bitwise_count(a[0][i] & b[0][j]).sum(axis=1) >= np.maximum(a[5][i], b[5][j])
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if level == 0:
            yield left.places[i], right.places[j]
            continue
        # Children of each side; a tree that is less deep waits at its root.
        grow_l, grow_r = level < len(left.levels), level < len(right.levels)
        fan_l, fan_r = (Tree.FAN if grow_l else 1), (Tree.FAN if grow_r else 1)
        di, dj = (v.ravel() for v in np.meshgrid(np.arange(fan_l), np.arange(fan_r), indexing="ij"))
        i = ((i * fan_l if grow_l else i)[:, None] + di).ravel()
        j = ((j * fan_r if grow_r else j)[:, None] + dj).ravel()
        ok = (i < len(left.at(level - 1)[1])) & (j < len(right.at(level - 1)[1]))
        if same:
            ok &= i <= j
        work.append((level - 1, i[ok], j[ok]))


def tree_pairs(bits: list[np.ndarray], n: np.ndarray, label: np.ndarray, side: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of sets in different groups that may be similar, in pieces; label may change between pieces.

    side: 0 and 1 for a tile of two blocks (pairs across only), else all 0.
    """
    width = np.array([len(b) for b in bits])
    trees: dict[tuple[int, int], Tree] = {}
    for s in np.unique(side):
        for w in np.unique(width[side == s]):
            at = np.flatnonzero((side == s) & (width == w))
            trees[int(s), int(w)] = Tree(n[at], np.stack([bits[k] for k in at]), label[at], threshold, at)
    across = len(np.unique(side)) > 1
    for (s, w), a in trees.items():
        for (s2, w2), b in trees.items():
            # Sizes differ by a quarter at most, so widths by one step at most.
            if (s2 <= s if across else w2 < w) or max(w, w2) > 2 * min(w, w2):
                continue
            one, two = (a.narrowed(w2, threshold), b) if w > w2 else (a, b.narrowed(w, threshold)) if w < w2 else (a, b)
            yield from traverse(one, two, threshold, label)


def tree_links(sets: list[np.ndarray], label: np.ndarray, side: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links that bring different groups together, until no similar pair of sets is left in two of them. Every link is proven on the sets."""
    label, out = label.copy(), []
    for i, j in tree_pairs([_bitmap(s, 16) for s in sets], np.array([len(s) for s in sets]), label, side, threshold):
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            if label[x] != label[y] and similar(sets[x], sets[y], threshold):
                label[label == label[y]] = label[x]
                out.append((x, y))
    return out


# Trees by anchor


def _tiled(tiles: DataFrame, payload: DataFrame, width: int, work, schema: str) -> DataFrame:
    """work over each tile's sets; tiles: (anchor, i, j, side, label, k, n), payload: (key, node, payload) of about width bytes an n-gram."""
    tiles = written(tiles, "tiles")
    buckets = max(1, math.ceil(width * (tiles.agg(F.sum("n")).first()[0] or 0) / (2 * TILE_BYTES)))
    placed = _small(tiles).join(payload, F.col("k") == F.col("key")).select("anchor", "i", "j", "side", "label", "node", "n", "payload")
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("anchor", "i", "j"), F.lit(buckets)))
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        for _, g in pdf.groupby(["anchor", "i", "j"], sort=False):
            number = {x: k for k, x in enumerate(dict.fromkeys(g["label"]))}
            found += work(g, np.array([number[x] for x in g["label"]]))
        return pd.DataFrame(found, columns=columns)

    out = written(placed.groupBy("bucket").applyInPandas(freed(run), schema), "tiled")
    discard(tiles)
    return out


def _links(sets: DataFrame, members: DataFrame, threshold: int) -> DataFrame:
    """(node, label) of the nodes that have links."""

    def links(g: pd.DataFrame, label: np.ndarray) -> list[tuple]:
        """Each set that a link brought into a larger group, with the least of the sets that the tile's links connect it to."""
        nodes, found = g["node"].tolist(), tree_links([np.frombuffer(t, np.uint64) for t in g["payload"]], label, g["side"].to_numpy(), threshold)
        group = {x: {x} for pair in found for x in pair}
        for x, y in found:
            if group[x] is not group[y]:
                group[x] |= group[y]
                for z in group[y]:
                    group[z] = group[x]
        heads = {id(m): min(nodes[x] for x in m) for m in group.values()}
        return [(heads[id(m)], nodes[x]) for x, m in group.items() if nodes[x] != heads[id(m)]]

    def near(g: pd.DataFrame, label: np.ndarray) -> list[tuple]:
        """Sets of a tile that may have a partner in it, by their bitmaps."""
        keep = np.zeros(len(g), bool)
        for i, j in tree_pairs([np.frombuffer(b, np.uint64) for b in g["payload"]], g["n"].to_numpy(), label, g["side"].to_numpy(), threshold):
            keep[i] = keep[j] = True
        g = g[keep]
        return list(zip(g["anchor"], g["i"], g["j"], g["node"], strict=True))

    def bitmaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(payload=[_bitmap(np.frombuffer(b, np.uint64), 8).tobytes() for b in pdf["payload"]])

    full = sets.select(F.col("k").alias("key"), "node", F.col("tokens").alias("payload"))
    # Each anchor's sets in one tree, or in several that all have the anchor.
    blocks = F.greatest(F.ceil(F.count("*") / TILE), F.ceil(8 * F.sum("n") / TILE_BYTES)).cast("int")
    big = _small(written(members.groupBy("anchor").agg(blocks.alias("blocks")).filter("blocks > 1").select(F.col("anchor").alias("at"), "blocks"), "big"))
    placed = members.join(big, F.col("anchor") == F.col("at"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    placed = written(placed.select("anchor", "k", "n", "blocks", "block"), "placed")
    lead = placed.filter("blocks > 1 and k = anchor").select("anchor", "k", "n", F.col("block").alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).filter("block <> own")
    tiles = placed.select("anchor", "k", "n", "block").unionByName(lead.drop("own"))
    tiles = tiles.select("anchor", F.col("block").alias("i"), F.col("block").alias("j"), F.lit(0).alias("side"), F.col("k").alias("label"), "k", "n")
    first = _tiled(tiles, full, 8, links, "a binary, b binary")
    labels = components(first)
    # Trees of one anchor whose sets are still in several groups, with each other.
    parts = placed.filter("blocks > 1")
    if not parts.limit(1).count():
        return labels
    named = sets.select(F.col("k").alias("key"), F.col("node").alias("own")).join(labels, F.col("own") == F.col("node"), "left").select("key", F.coalesce("label", "own").alias("label"))
    parts = written(parts.join(named, F.col("k") == F.col("key")).drop("key"), "parts")
    several = parts.groupBy("anchor").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select(F.col("anchor").alias("at"))
    several = written(several, "several")
    if not several.limit(1).count():
        return labels
    parts = parts.join(_small(several), F.col("anchor") == F.col("at"), "left_semi")
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != F.col("block")))
    pairs = parts.withColumn("other", other).select("anchor", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"), "label", "k", "n")
    pairs = written(pairs, "pairs")
    some = _tiled(pairs, full.mapInPandas(bitmaps, full.schema), 2, near, "anchor long, i int, j int, node binary")
    some = some.join(sets.select("node", F.col("k").alias("key")), "node").select("anchor", "i", "j", F.col("key").alias("k")).distinct()
    second = _tiled(pairs.join(some, ["anchor", "i", "j", "k"], "left_semi"), full, 8, links, "a binary, b binary")
    return components(first.unionByName(second)) if second.limit(1).count() else labels


# Documents


def _grouped(docs: DataFrame, id_col: str, text_col: str, n: int, threshold: int) -> DataFrame:
    """(id, hash, n, component, members, keep): keep is the one document of its group that stays, as (no id, id, hash of the text)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("hash"), whole(F.col(text_col)).alias("text"))
    found, order = _documents(rows, n, threshold)
    who = F.struct(F.col("id").isNull().alias("none"), "id", "hash")
    classes = found.filter("n > 0").groupBy("node").agg(F.min("id").alias("least"), F.min(who).alias("keep"), F.count("*").alias("times"), F.bool_or("possible").alias("possible"))
    classes = written(classes.filter("possible or times > 1"), "classes")
    ids = _small(classes.filter("possible").select(F.col("keep.id").alias("i"), F.col("keep.hash").alias("h")))
    with batches_of(docs.sparkSession, 500):
        sets = written(_sets(rows.join(ids, F.col("id").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("h")), "left_semi"), n), "sets")
    twice = sets.groupBy("node").count().filter("count > 1").select("node")
    if twice.limit(1).count():  # rows that repeat an id and a text
        one = sets.join(twice, "node", "left_semi").dropDuplicates(["node"])
        sets = written(sets.join(twice, "node", "left_anti").unionByName(one), "sets")
    with batches_of(docs.sparkSession, 500):
        posts = written(_posts(sets, order, threshold), "posts")
        members = written(_members(posts), "members")
        discard(posts)
        labels = _links(sets, members, threshold)
    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = written(named, "labelled")
    groups_ = named.groupBy("label").agg(F.min("least").alias("component"), F.min("keep").alias("keep"), F.sum("times").alias("members"))
    named = written(joined_salted(named.select("node", "label"), "label", "node", groups_).select("node", "component", "members", "keep"), "named")
    discard(sets)
    alone = {"component": F.col("id"), "members": F.lit(1).cast("long"), "keep": who}
    out = joined_salted(found.withColumnRenamed("node", "key"), "key", "hash", named.withColumnRenamed("node", "key"), "left")
    return out.select("id", "hash", "n", *[F.when(F.col("members").isNull(), own).otherwise(F.col(c)).alias(c) for c, own in alone.items()])


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id, and members, the number of documents in its group."""
    return _grouped(docs, id_col, text_col, n, threshold).select("id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "members")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, of each group only the document of the least id (rows without one last; then by a hash of the text). Rows are told apart by id
    and text, so another document of the same id stays; rows that repeat both stay or go together."""
    who = F.struct(F.col("id").isNull().alias("none"), "id", "hash")
    gone = _grouped(docs, id_col, text_col, N, THRESHOLD).filter(who != F.col("keep")).select(F.col("id").alias("_gone"), F.col("hash").alias("_hash")).distinct()
    gone = _small(written(gone, "gone"))
    return docs.join(gone, docs[id_col].cast("long").eqNullSafe(F.col("_gone")) & (F.xxhash64(docs[text_col]) == F.col("_hash")), "left_anti")


def op2(spark, sf_dir: str) -> DataFrame:
    found = groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "members")


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 4, 1) + 1), lambda i: array_to_string(ws[i:i + 4], ' '))) AS g
  FROM w WHERE len(ws) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
least AS (SELECT a AS doc_id, min(b) AS component_id, count(*) AS members FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, members
FROM least LEFT JOIN n USING (doc_id)
"""
