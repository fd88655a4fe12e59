"""Substring dedup: words in windows of ``WINDOW`` words that occur more than once are removed, by a count-min prefilter and an exact second pass.

Pass one sketches window counts. A window is counted through its anchor, the least hash among its runs of ``ANCHOR`` words: equal windows have equal
anchors at equal offsets, so an anchor's count is never below its windows' counts, and there are some ten times fewer anchors than windows. Every
task counts the anchors of its own texts in ``DEPTH`` rows of counters and emits them by slices of counters; slices of all tasks are merged,
saturating at two, and of each counter one bit remains: twice or more. Pass two estimates each window by the bits of its anchor: both set means
possibly repeated. Only those windows are grouped, by 128 bits of hash, and the ones that turn out to occur once are sent back to their text.
They stand in one text only, so no hot key comes back, and texts that a filter shows to await nothing don't shuffle. Pass three leaves out what the remaining windows cover.

Nothing is lost: an estimate is never too small, and each estimate is checked. The sketch has ``COUNTERS`` counters in each row for every anchor
expected from the size of all texts, and is broadcast while it has at most ``max_counters`` (64 MB a row as it stands). Beyond that the sketch is a
single sparse row, one counter for each 64-bit anchor hash, kept as a table: anchors that occur once go to their texts by a shuffle on the text's
hash (a tenth of the words, dealt by salts where a text has many copies). Windows are combined in each task before they shuffle, so a passage in
a third of all texts costs a row for each task.

Nulls and odd input: a null or empty text has no words and gives an empty rest; fewer than ``window`` words are kept as they are; a very long text is hashed whole,
in pieces of bytes; repeated rows repeat their windows, so each loses all of them, and so do overlapping windows of one text that
repeats itself; ids (null ones too) are only carried; an empty table gives no rows; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import discard, pow2_at_least, release, table, whole, written
from dqloom.llm.components import joined_salted
from dqloom.llm.exact_dedup import _bit

WINDOW = 35
ANCHOR = 16
DEPTH = 2
COUNTERS = 8
MAX_COUNTERS = 1 << 29
SLICE = 1 << 22  # counters in a slice
BYTES = 1 << 18  # of text that are hashed at once
TEXTS = 1 << 22  # bytes of texts that are worked on at once
FLUSH = 1 << 20  # anchors or windows that a task combines at once
#: Bits for each text to which verdicts go back; texts that miss in the filter of these bits are not shuffled.
FILTER_BITS = 16
_CHARS_A_WORD = 6
_SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _numbers(what: str, n: int) -> np.ndarray:
    return np.array([int.from_bytes(blake2b(f"{what}:{i}".encode(), digest_size=8).digest(), "little") | 1 for i in range(n)], np.uint64)


_BYTE = [_numbers(f"byte{lane}", 256) for lane in range(2)]
_BASE = [int(_numbers(f"base{lane}", 1)[0]) for lane in range(2)]
_ROW = _numbers("row", DEPTH)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2 ** 64, n of them at least."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(pow2_at_least(max(n, BYTES)), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have)
    return have


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of MurmurHash3."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of values[start:end], the same wherever they stand."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _power(base, n)[:n], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * _power(pow(base, -1, 1 << 64), n)[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Hashes of the words of several texts and, by lane, of their windows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lanes: int):
        black = ~_SPACES[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.concatenate(([False], black[:-1])) if len(data) else black
        after = np.concatenate((black[1:], [False])) if len(data) else black
        starts = np.flatnonzero(black & (~before | edge[:-1]))
        ends = np.flatnonzero(black & (~after | edge[1:])) + 1
        self.n = len(starts)
        self.first = np.searchsorted(starts, offsets)
        self.counts = np.diff(self.first)
        self.hashes = [self._hash(data, starts, ends, lane) for lane in range(lanes)]

    def _hash(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int) -> np.ndarray:
        out = np.empty(self.n, np.uint64)
        i = 0
        while i < self.n:
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + BYTES, "right")))
            s = starts[i]
            out[i:j] = _sums(_BYTE[lane][data[s : ends[j - 1]]], starts[i:j] - s, ends[i:j] - s, _BASE[lane])
            i = j
        return out

    def runs(self, length: int, lane: int) -> np.ndarray:
        """Hashes of all runs of so many words, those across two texts too."""
        at = np.arange(max(0, self.n - length + 1))
        return _sums(self.hashes[lane], at, at + length, _BASE[lane])

    def inside(self, length: int) -> np.ndarray:
        """Whether a run of so many words is within one text."""
        last = np.repeat(self.first[1:], self.counts)[: max(0, self.n - length + 1)]
        return np.arange(len(last)) + length <= last


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over values[i : i + width]."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = pick(values[:-step], values[step:]) if len(values) > step else values[:0]
        have += step
    return values


def anchors(words: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchor of each window, whether the window is within one text, and the anchors of all places that are one's."""
    grams, inside = words.runs(anchor, 0), words.inside(window)
    width = window - anchor + 1
    least = _sliding(grams, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    used = np.concatenate((pad, np.where(inside, least, np.uint64(0)), pad)) if len(least) else grams[:0]
    return least, inside, grams[_sliding(used, width, np.maximum) == grams] if len(least) else least


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Groups of texts as (first, end, bytes, offsets)."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + TEXTS, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def _places(anchor: np.ndarray, k: int, counters: int) -> np.ndarray:
    return (_mix(anchor * _ROW[k]) & np.uint64(counters - 1)).astype(np.int64)


def _packed(places: np.ndarray) -> bytes:
    """Ascending numbers below SLICE, by their differences, byte planes apart."""
    return zlib.compress(np.diff(places, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4")[:, 0].astype(np.int64))


def _sketched(docs: DataFrame, counters: int, window: int, anchor: int) -> DataFrame:
    """Partial sketches: rows (k, slice, once, many), packed places of counters at one and at two or more."""

    def rows(found: list[np.ndarray]) -> pa.RecordBatch:
        all_, out = np.concatenate(found), []
        for k in range(DEPTH):
            at, times = np.unique(_places(all_, k, counters), return_counts=True)
            cuts = np.searchsorted(at, np.arange(0, counters + SLICE, SLICE))
            for s in np.flatnonzero(np.diff(cuts)):
                here, n = at[cuts[s] : cuts[s + 1]] - s * SLICE, times[cuts[s] : cuts[s + 1]]
                out.append((k, int(s), _packed(here[n == 1]), _packed(here[n > 1])))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["k", "slice", "once", "many"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for batch in batches:
            for _, _, data, offsets in _texts(batch.column(0)):
                found.append(anchors(Words(data, offsets, 1), window, anchor)[2])
                n += len(found[-1])
                if n >= FLUSH:
                    yield rows(found)
                    found, n = [], 0
        if n:
            yield rows(found)
        release()

    return docs.select("text").mapInArrow(run, "k int, slice int, once binary, many binary")


def _merged(partial: DataFrame) -> DataFrame:
    """Rows (k, slice, bits): a bit for each counter that all partial sketches together bring to two. One slice of counters is held at a time."""

    def run(batches):
        import pandas as pd

        now, sums = None, None
        for pdf in batches:
            done = []
            for k, s, once, many in pdf.itertuples(index=False):
                if (k, s) != now:
                    done += [(*now, zlib.compress(np.packbits(sums > 1), 1))] if now else []
                    now, sums = (k, s), np.zeros(SLICE, np.uint8)
                sums[_unpacked(many)] = 2
                at = _unpacked(once)
                sums[at] = np.minimum(sums[at] + 1, 2)
            yield pd.DataFrame(done, columns=["k", "slice", "bits"])
        if now:
            yield pd.DataFrame([(*now, zlib.compress(np.packbits(sums > 1), 1))], columns=["k", "slice", "bits"])
        release()

    return partial.repartition("k", "slice").sortWithinPartitions("k", "slice").mapInPandas(run, "k int, slice int, bits binary")


def _single_anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """For a sketch that is no longer broadcast: rows (t, once), the anchors of a text that occur nowhere else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.asarray(batch.column(1))
            for i, j, data, offsets in _texts(batch.column(0)):
                words = Words(data, offsets, 1)
                least, inside, places = anchors(words, window, anchor)
                doc = np.repeat(key[i:j], words.counts)[: len(least)]
                a, n = np.unique(places, return_counts=True)
                pairs = np.unique(np.stack((least[inside].view(np.int64), doc[inside])), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.array(n[np.searchsorted(a, pairs[0].view(np.uint64))])], ["a", "t", "n"])
        release()

    rows = docs.select("text", "t").mapInArrow(run, "a long, t long, n long").repartition("a")
    return rows.groupBy("a").agg(F.sum("n").alias("n"), F.min("t").alias("t")).filter("n = 1").groupBy("t").agg(F.collect_list("a").alias("once"))


class _Estimates:
    """Which windows of a group of texts are possibly repeated, and their hashes in two lanes."""

    def __init__(self, sketch, counters: int, window: int, anchor: int):
        self.sketch, self.counters, self.window, self.anchor, self.rows = sketch, counters, window, anchor, None

    def __call__(self, data: np.ndarray, offsets: np.ndarray, once: list | None) -> tuple[Words, np.ndarray, list[np.ndarray]]:
        words = Words(data, offsets, 2)
        least, inside, _ = anchors(words, self.window, self.anchor)
        if once is None:
            if self.rows is None:
                self.rows = [np.frombuffer(b, np.uint8) for b in self.sketch.value]
            at = np.flatnonzero(inside)
            for k, bits in enumerate(self.rows):
                p = _places(least[at], k, self.counters)
                at = at[(bits[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 == 1]
        else:
            hit = inside.copy()
            for d, single in enumerate(once):
                if single is not None and len(single):
                    here = slice(words.first[d], min(words.first[d + 1], len(hit)))
                    hit[here] &= ~np.isin(least[here], np.asarray(single, np.int64).view(np.uint64))
            at = np.flatnonzero(hit)
        lanes = [words.runs(self.window, lane)[at].view(np.int64) if len(at) else np.zeros(0, np.int64) for lane in range(2)]
        return words, at, lanes


def _combined(k1: np.ndarray, k2: np.ndarray, t: np.ndarray) -> pa.RecordBatch:
    """One row for each window of a task; t is null where it occurs again already."""
    order = np.lexsort((k2, k1))
    k1, k2, t = k1[order], k2[order], t[order]
    new = np.ones(len(k1), bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    at = np.flatnonzero(new)
    return pa.RecordBatch.from_arrays([pa.array(k1[at]), pa.array(k2[at]), pa.array(t[at], mask=np.diff(np.append(at, len(k1))) > 1)], ["k1", "k2", "t"])


def _windows(docs: DataFrame, estimates: _Estimates) -> DataFrame:
    """Rows (k1, k2, t): possibly repeated windows, combined by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for batch in batches:
            key, once = np.asarray(batch.column("t")), batch.column("once")
            for i, j, data, offsets in _texts(batch.column("text")):
                words, at, lanes = estimates(data, offsets, None if estimates.sketch else once[i:j].to_pylist())
                kept.append((*lanes, np.repeat(key[i:j], words.counts)[at]))
                n += len(at)
                if n >= FLUSH:
                    yield _combined(*map(np.concatenate, zip(*kept)))
                    kept, n = [], 0
        if n:
            yield _combined(*map(np.concatenate, zip(*kept)))
        release()

    return docs.select("text", "t", "once").mapInArrow(run, "k1 long, k2 long, t long")


def _rest(docs: DataFrame, estimates: _Estimates) -> DataFrame:
    """Rows (id, n_words, n_removed, text) after the covered words are left out."""
    window = estimates.window
    schema = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alone, once = batch.column("alone"), batch.column("once")
            for i, j, data, offsets in _texts(batch.column("text")):
                words, at, (k1, _) = estimates(data, offsets, None if estimates.sketch else once[i:j].to_pylist())
                repeated = np.ones(len(at), bool)
                cuts = np.searchsorted(at, words.first)
                for d, lone in enumerate(alone[i:j].to_pylist()):
                    if lone:
                        repeated[cuts[d] : cuts[d + 1]] = ~np.isin(k1[cuts[d] : cuts[d + 1]], np.asarray(lone, np.int64))
                marks = np.zeros(words.n + 1, np.int64)
                np.add.at(marks, at[repeated], 1)
                np.add.at(marks, at[repeated] + window, -1)
                keep = np.cumsum(marks[:-1]) == 0
                raw, texts, removed = data.tobytes(), [], []
                for d in range(j - i):
                    mine = keep[words.first[d] : words.first[d + 1]]
                    split = raw[offsets[d] : offsets[d + 1]].split()
                    gone = len(mine) - int(np.count_nonzero(mine))
                    texts.append(b" ".join(compress(split, mine.tolist()) if gone else split))
                    removed.append(gone)
                rest = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("id")[i:j], pa.array(words.counts), pa.array(removed, pa.int64()), rest], names=["id", *schema.names])
        release()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text", "once", "alone").mapInArrow(run, f"id {kind}, n_words long, n_removed long, text string")


def _maybe(rows: DataFrame, alone: DataFrame, max_bits: int) -> DataFrame:
    """rows with a boolean ``maybe``: false means that ``alone`` has nothing for their t. The filter is a bitmap of bounded size."""
    place = F.pmod(F.xxhash64("t", F.lit("place")), F.lit(min(max_bits, max(1 << 15, pow2_at_least(FILTER_BITS * alone.count())))))
    bits = alone.select(place.alias("p")).groupBy(F.expr("p div 32768").alias("b")).agg(F.bitmap_construct_agg(F.pmod("p", F.lit(32768))).alias("m"))
    rows = rows.withColumn("p", place).withColumn("b", F.expr("p div 32768")).join(F.broadcast(bits), "b", "left")
    return rows.withColumn("maybe", _bit("m", "p")).drop("p", "b", "m")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, max_counters: int = MAX_COUNTERS) -> DataFrame:
    """One row per row of docs: id, n_words, n_removed, text (the words that stay, by one space)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    counters = max(SLICE, pow2_at_least(COUNTERS * 2 * size // (_CHARS_A_WORD * (window - anchor + 2))))
    keyed = rows.withColumn("t", F.xxhash64(whole(F.col("text")))).withColumn("once", F.lit(None).cast("array<long>"))
    if counters <= max_counters:
        bits = [bytearray(counters // 8) for _ in range(DEPTH)]
        for r in _merged(_sketched(rows, counters, window, anchor)).toLocalIterator():
            bits[r.k][r.slice * SLICE // 8 : (r.slice + 1) * SLICE // 8] = zlib.decompress(r.bits)
        estimates = _Estimates(spark.sparkContext.broadcast([bytes(b) for b in bits]), counters, window, anchor)
    else:
        singles = written(_single_anchors(keyed, window, anchor), "anchors")
        keyed = written(joined_salted(keyed.drop("once"), "t", "id", singles, "left"), "anchored")
        discard(singles)
        estimates = _Estimates(None, 0, window, anchor)
    found = _windows(keyed, estimates).repartition("k1", "k2").groupBy("k1", "k2").agg(F.count("*").alias("n"), F.count("t").alias("m"), F.min("t").alias("t"))
    alone = written(found.filter("n = 1 and m = 1").groupBy("t").agg(F.collect_list("k1").alias("alone")), "alone")
    maybe = _maybe(keyed, alone, max(max_counters, 1))
    sent = joined_salted(maybe.filter("maybe").drop("maybe"), "t", "id", alone, "left")
    keyed = maybe.filter("not maybe").drop("maybe").withColumn("alone", F.lit(None).cast("array<long>")).unionByName(sent)
    return _rest(keyed, estimates)


def op12(spark, sf_dir: str) -> DataFrame:
    rest = remove_repeats(table(spark, sf_dir, "documents"))
    return rest.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, unnest(range(1, len(w) - 33)) AS s FROM t WHERE len(w) >= 35),
g AS (SELECT p.r, p.s, md5(array_to_string(list_slice(t.w, p.s, p.s + 34), ' ')) AS k FROM p JOIN t USING (r)),
b AS (SELECT r, s FROM g QUALIFY count(*) OVER (PARTITION BY k) > 1),
c AS (SELECT r, s, lead(s) OVER (PARTITION BY r ORDER BY s) AS nxt FROM b),
gone AS (SELECT r, list(x) AS xs FROM (SELECT r, unnest(range(s, coalesce(least(nxt, s + 35), s + 35))) AS x FROM c) GROUP BY r),
u AS (SELECT t.doc_id, t.r, t.w, unnest(CASE WHEN len(t.w) = 0 THEN [0] ELSE range(1, len(t.w) + 1) END) AS i FROM t),
f AS (SELECT u.doc_id, u.r, u.i, u.w[u.i] AS word, x.x IS NOT NULL AS out FROM u LEFT JOIN (SELECT r, unnest(xs) AS x FROM gone) x ON x.r = u.r AND x.x = u.i)
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (i > 0) AS n_words, count(*) FILTER (out) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT out AND i > 0), '')) AS kept_sha256
FROM f GROUP BY r
"""
