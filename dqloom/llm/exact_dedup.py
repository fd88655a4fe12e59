"""Exact dedup by two-pass Bloom filtering, in DataFrame operations only.

Pass one writes a digest for every row and counts how many rows hit each position of two filter slices; a position hit
twice or more becomes a set bit. Pass two looks every row up in both slices: a row that misses in either one has no equal
and passes straight through; only the others are shuffled and compared by their full SHA-256.

A position costs a row of pass one about ten bytes to shuffle, counted where it arises first; a digest with its id and length would cost a row
about fifty, and its text thousands. The slices are sized by the number of rows and broadcast. Their size has a fixed bound (``max_bits`` each,
64 MB as it stands, for some sixty million rows); past it the filter only lets more rows through to the exact comparison, the result stays
the same. A group of copies may hold most rows: counts are taken by (digest, salt) first, so no task gets a whole group.

Nulls and odd input: a null text counts as empty; a null id sorts after all others; rows that repeat both id and text
are copies of each other and exactly one of them is kept; an empty table gives an empty result; further columns of any
name are carried along by ``drop_copies`` and ignored by ``find_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import SPACE, pow2_at_least, whole, written

BITS_PER_ROW = 8
MAX_BITS = 1 << 29
SALTS = 64
_BUCKET = 32768  # bits in one bitmap of bitmap_construct_agg


def text_digest(text: Column) -> Column:
    """SHA-256 of the text without white space."""
    return F.unhex(F.sha2(F.regexp_replace(whole(text), SPACE + "+", ""), 256))


def _positions(bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64("key", F.lit(k)), F.lit(bits)) for k in range(2)]


def _slice(keyed: DataFrame, position: Column, k: int) -> DataFrame:
    """Bitmaps of the positions that two or more rows hit, one row for each 32768 bits."""
    hit = keyed.groupBy(position.alias("p")).count().filter("count > 1")
    return hit.groupBy(F.expr(f"p div {_BUCKET}").alias(f"b{k}")).agg(F.bitmap_construct_agg(F.pmod("p", F.lit(_BUCKET))).alias(f"m{k}"))


def _bit(bitmap: str, position: str) -> Column:
    byte = f"cast(conv(hex(substring({bitmap}, cast(pmod({position}, {_BUCKET}) div 8 + 1 as int), 1)), 16, 10) as int)"
    return F.expr(f"coalesce(shiftright({byte}, cast(pmod({position}, 8) as int)) & 1, 0) = 1")


def possibly_repeated(rows: DataFrame, keyed: DataFrame, n_rows: int, max_bits: int = MAX_BITS) -> DataFrame:
    """rows with a boolean ``maybe``: false means that the row's ``key`` occurs once in ``keyed``."""
    bits = min(max_bits, max(_BUCKET, pow2_at_least(BITS_PER_ROW * max(1, n_rows))))
    for k, position in enumerate(_positions(bits)):
        bitmaps = _slice(keyed, position, k)
        rows = rows.withColumn(f"p{k}", position).withColumn(f"b{k}", F.expr(f"p{k} div {_BUCKET}"))
        rows = rows.join(F.broadcast(bitmaps), f"b{k}", "left")
    return rows.withColumn("maybe", _bit("m0", "p0") & _bit("m1", "p1")).drop("p0", "p1", "b0", "b1", "m0", "m1")


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return written(docs.select(F.col(id_col).alias("id"), F.length(whole(text)).alias("len"), text_digest(text).alias("key")), "digests")


def _resolved(repeated: DataFrame, salts: int) -> DataFrame:
    """For rows (id, len, key): the row of each group that stays, the group's size and whether this row is it."""
    order = F.struct((-F.col("len")).alias("l"), F.col("id").isNull().alias("z"), F.col("id").alias("i"))
    one = repeated.groupBy("key", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"), "id", "len").agg(F.count("*").alias("times"))
    some = one.groupBy("key", "salt").agg(F.min(order).alias("best"), F.sum("times").alias("n"))
    full = some.groupBy("key").agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    each = some.select("key", "salt").join(full, "key")
    found = one.join(each, ["key", "salt"])
    first = (F.col("best.i").eqNullSafe(F.col("id"))) & (F.col("best.l") == -F.col("len"))
    copies = found.select("id", "key", F.col("best.i").alias("keep_id"), F.col("n").alias("group_size"), first.alias("first"), F.posexplode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy", "_"))
    return copies.select("id", "key", "keep_id", "group_size", (F.col("first") & (F.col("copy") == 0)).alias("kept"))


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, salts: int = SALTS) -> DataFrame:
    """One row per row of docs: id, key (SHA-256), keep_id, group_size, kept."""
    digests = _digests(docs, id_col, text_col)
    flagged = possibly_repeated(digests, digests, digests.count(), max_bits)
    alone = flagged.filter("not maybe").select("id", "key", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    return alone.unionByName(_resolved(flagged.filter("maybe").drop("maybe"), salts))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, salts: int = SALTS) -> DataFrame:
    """The rows of docs that stay, with all their columns. Texts that occur once are not shuffled."""
    digests = _digests(docs, id_col, text_col)
    n = digests.count()
    rows = docs.select(F.struct("*").alias("row")).select("row", F.col(f"row.{id_col}").alias("id"), text_digest(F.col(f"row.{text_col}")).alias("key"))
    rows = possibly_repeated(rows, digests, n, max_bits)
    stay = _resolved(possibly_repeated(digests, digests, n, max_bits).filter("maybe").drop("maybe"), salts)
    stay = stay.filter("kept").select(F.col("key").alias("k"), F.col("id").alias("i"))
    some = rows.filter("maybe").join(stay, F.col("key").eqNullSafe(F.col("k")) & F.col("id").eqNullSafe(F.col("i")), "left_semi")
    # A row that repeats id and text comes once. Of two texts that differ in white space only, the longer stays.
    some = some.withColumn("len", F.length(whole(F.col(f"row.{text_col}")))).groupBy("key").agg(F.max_by("row", "len").alias("row"))
    return rows.filter("not maybe").select("row.*").unionByName(some.select("row.*"))


def op9(spark, sf_dir: str) -> DataFrame:
    from dqloom.llm.common import table

    found = find_copies(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("key")).alias("text_sha256"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS k
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY k) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(k) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY k ORDER BY n DESC, doc_id)
"""
