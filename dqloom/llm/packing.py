"""Conflict-constrained best-fit packing of documents into sequences of ``CAPACITY`` words.

A document longer than a sequence gives full pieces and a rest. Pieces are dealt to shards by a hash, and each shard packs
its pieces in order of falling size: open bins stand in order of what is left in them, and carry a bitmap of the sources that
have reached ``PER_SOURCE`` pieces and a bitmap of duplicate clusters. A successor search over the residuals goes from the
tightest bin upwards until one is compatible: no second piece of a duplicate cluster (texts equal but for white space), and
no source above its limit. Only if there is none, a new bin opens. Bins with equal residual and equal source bitmap are kept
together, and pieces that are alike resume the search where the last one ended, so hot sources and large groups of copies
do not make it quadratic.

A shard holds about ``SHARD_PIECES`` pieces whatever the input; sharding costs a few half-filled bins for each shard. Groups of copies and
hot sources are spread over all shards.

Nulls and odd input: a document without words gets one piece of no words and no bin (null); a null source is a source; a null id is an
id; a very long text is cut into full pieces in one pass; pieces that tie in size go by cluster, source, id and copy; a row that repeats another is
packed as its own copy; an empty table gives an empty result; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import WORD, n_words, release, small_batches, table, written
from dqloom.llm.exact_dedup import text_digest

CAPACITY = 2048
PER_SOURCE = 4
SHARD_PIECES = 20_000
_WORD = re.compile(WORD)
_PIECES = "id long, copy long, piece int, start long, n_words long, source string, cluster long, size long"
_PLACED = "id long, copy long, piece int, start long, n_words long, source string, cluster long, size long, bin_id long, position int"


class Bins:
    """Open bins of one shard in order of their residuals."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.left: list[int] = []  # per bin: residual
        self.full_sources: list[int] = []  # per bin: bitmap of sources at their limit
        self.clusters: list[int] = []  # per bin: bitmap of duplicate clusters
        self.counts: list[dict[int, int]] = []
        self.filled: list[int] = []
        self.residuals: list[int] = []  # sorted; those that have bins
        self.by: dict[int, dict[int, list[int]]] = {}  # residual -> bitmap of full sources -> bins
        self.last: tuple = ()
        self.at: tuple[int, int, int] = (0, 0, 0)

    def _put(self, b: int) -> None:
        r = self.left[b]
        if r not in self.by:
            self.by[r] = {}
            insort(self.residuals, r)
        self.by[r].setdefault(self.full_sources[b], []).append(b)

    def _find(self, size: int, source: int, cluster: int) -> int:
        """Takes the tightest compatible bin out of the order; -1 if there is none. cluster: a bit, or 0 if it has no other piece."""
        like = (size, source, cluster)
        start, skip_maps, skip_bins = self.at if like == self.last and cluster else (size, 0, 0)
        self.last = like
        for i in range(bisect_left(self.residuals, start), len(self.residuals)):
            r = self.residuals[i]
            maps = self.by[r]
            first = r == start
            for j, (full, bins) in enumerate(list(maps.items())):
                if first and j < skip_maps or full >> source & 1:
                    continue
                for k in range(skip_bins if first and j == skip_maps else 0, len(bins)):
                    b = bins[k]
                    if not self.clusters[b] & cluster:
                        bins[k] = bins[-1]
                        bins.pop()
                        self.at = (r, j, k)
                        if not bins:
                            del maps[full]
                            self.at = (r, j, 0)
                            if not maps:
                                del self.by[r]
                                del self.residuals[i]
                        return b
        self.at = (self.capacity + 1, 0, 0)
        return -1

    def add(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and place in it."""
        b = self._find(size, source, cluster)
        if b < 0:
            b = len(self.left)
            self.left.append(self.capacity)
            self.full_sources.append(0)
            self.clusters.append(0)
            self.counts.append({})
            self.filled.append(0)
        self.left[b] -= size
        self.clusters[b] |= cluster
        n = self.counts[b][source] = self.counts[b].get(source, 0) + 1
        if n >= self.per_source:
            self.full_sources[b] |= 1 << source
        if self.left[b]:
            self._put(b)
        self.filled[b] += 1
        return b, self.filled[b] - 1


def pack_shard(pdf: pd.DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> pd.DataFrame:
    """Rows of _PIECES with bin (from 0, in this shard) and position."""
    pdf = pdf.sort_values(["n_words", "cluster", "source", "id", "copy", "piece"], ascending=[False, True, True, True, True, True], na_position="last", kind="stable").reset_index(drop=True)
    sources = {s: i for i, s in enumerate(pdf["source"].map(lambda s: "" if s is None else "s" + s).drop_duplicates())}
    times = pdf["cluster"].value_counts()
    bits = {c: 1 << i for i, c in enumerate(sorted(times.index[times > 1]))}
    bins = Bins(capacity, per_source)
    placed = [
        bins.add(int(n), sources["" if s is None else "s" + s], bits.get(c, 0))
        for n, s, c in zip(pdf["n_words"], pdf["source"], pdf["cluster"], strict=True)
    ]
    return pdf.assign(bin=[b for b, _ in placed], position=[p for _, p in placed])


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", capacity: int = CAPACITY) -> DataFrame:
    """Rows of _PIECES; rows of docs that are alike are numbered by ``copy``."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), n_words(text).alias("size"), F.xxhash64(text_digest(text)).alias("cluster"))
    rows = rows.groupBy("id", "source", "size", "cluster").agg(F.count("*").alias("times"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)).alias("copy"))
    last = F.greatest(F.ceil(F.col("size") / capacity) - 1, F.lit(0)).cast("int")
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("long") * capacity
    return rows.select("id", "copy", "piece", start.alias("start"), F.least(F.lit(capacity).cast("long"), F.col("size") - start).alias("n_words"), "source", "cluster", "size")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Rows of _PLACED: where each piece went. bin_id is null for pieces without words."""
    cut = written(pieces(docs, id_col, text_col, source_col, capacity), "pieces")
    shards = max(1, math.ceil(cut.count() / shard_pieces))
    some = cut.filter("n_words > 0").withColumn("shard", F.pmod(F.xxhash64("id", "copy", "piece", "cluster"), F.lit(shards)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pack_shard(pdf, capacity, per_source)
        out["bin_id"] = out["shard"] * (1 << 32) + out["bin"]
        release()
        return out[["id", "copy", "piece", "start", "n_words", "source", "cluster", "size", "bin_id", "position"]]

    placed = some.groupBy("shard").applyInPandas(run, _PLACED)
    rest = cut.filter("n_words <= 0").select("*", F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("int").alias("position"))
    return placed.unionByName(rest)


def cut_text(text: str, capacity: int) -> list[str]:
    """The text in pieces of so many words, cut before a word in one pass; put together they give the whole text."""
    ends = [m.start() for k, m in enumerate(_WORD.finditer(text)) if k and k % capacity == 0]
    return [text[i:j] for i, j in zip([0, *ends], [*ends, None], strict=True)]


def packed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    """Where each piece went, with the piece's own text. A document's text is cut once, and each part of it is joined to its own piece."""
    small_batches(docs.sparkSession)
    placed = pack(docs, id_col, text_col, source_col, capacity, per_source)
    text = F.col(text_col)
    keys = [F.coalesce(F.col("id"), F.lit(0)).alias("k"), F.col("id").isNull().alias("none"), F.col("cluster").alias("c"), F.col("size").alias("w")]
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_digest(text)).alias("cluster"), n_words(text).alias("size"), F.xxhash64(text).alias("h"), text.alias("text"))

    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in batches:
            yield pd.Series([[None] if t is None else cut_text(t, capacity) for t in some], dtype=object)
        release()

    # A row that repeats id and text has the same parts; of texts of one id that differ in white space only, one is taken.
    parts = texts.select(*keys, "h", F.posexplode(F.pandas_udf(cut, "array<string>")("text")).alias("p", "part"))
    parts = parts.groupBy("k", "none", "c", "w", "p").agg(F.min_by("part", "h").alias("part"))
    joined = placed.select(*placed.columns, *keys, F.col("piece").alias("p")).join(parts, ["k", "none", "c", "w", "p"])
    return joined.select(F.col("id").alias("doc_id"), "copy", "piece", "start", "n_words", "source", "bin_id", "position", F.col("part").alias("text"))


def op8(spark, sf_dir: str) -> DataFrame:
    out = pack(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "copy", "piece", "start", "n_words", "source", "bin_id", "position")
