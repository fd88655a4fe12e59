"""Language identification by compression.

For each language a zstandard raw-content dictionary is filled with whole training texts, up to ``DICT_BYTES``. A text is
lower-cased, runs of anything but letters become one space, and it is cut into blocks of ``BLOCK`` characters (all of it,
in order). Each block is compressed with every dictionary, and the language whose sizes add up to least is chosen; of equal
ones, the language with more training rows. Where second-best is nearly as small the text is rejected.

Training is bounded: ``SAMPLE`` labelled rows for each language are expected to be looked at (by hash of id and text, the
fraction comes from exact counts; rows that repeat count as one), and ``DICT_BYTES`` of them make the dictionary. Every language that occurs
has one. The dictionaries are the only thing that goes through the driver: DICT_BYTES for each language.

Nulls and odd input: a null text, or one without any letter, is ``und`` with score 0; so is every text if nothing could be
learned; a very long text is compressed whole, block by block; rows with a null lang or null text teach nothing; rows that repeat are each predicted; an empty table gives an
empty result; further columns are ignored by ``classify`` and carried by ``keep_identified``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import release, small_batches, table

DICT_BYTES = 32 * 1024
SAMPLE = 120
#: A shorter dictionary is repeated, as the compressor takes none below eight bytes.
LEAST_BYTES = 8
BLOCK = 1500
#: Level, least match and strategy for texts, and for those under SHORT bytes, where each match counts.
USUAL = (8, 4, "STRATEGY_LAZY2")
FINE = (16, 3, "STRATEGY_BTLAZY2")
SHORT = 300
#: Rejected below this relative distance of the two best sizes.
MARGIN = 0.004
SEED = 5


def in_fold(id_: Column, of: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.coalesce(F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % of == rest, F.lit(False))


_OTHER = re.compile(r"[\W\d_]+")


def plain(text: str) -> str:
    """Lower-case words with one space around each; a space alone if there is no letter."""
    words = _OTHER.sub(" ", f" {text.lower()} ")
    if words == " " or words.replace(" ", "").isalpha():
        return words
    # Numbers such as ², ½ or Ⅳ are word characters to a pattern, but no letters.
    return " ".join(["", *"".join(c if c.isalpha() else " " for c in words).split(), ""]) if any(map(str.isalpha, words)) else " "


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> dict[str, bytes]:
    """The dictionary of each language, from labelled rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row for each language
    if not counts:
        return {}
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, SAMPLE / n)))])
    h = F.pmod(F.xxhash64(F.lit(SEED), "id", "text"), F.lit(1 << 30))
    some = rows.filter(h < F.element_at(share, F.col("lang")) * (1 << 30)).select("lang", h.alias("h"), "text").dropDuplicates(["lang", "h"])

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, got, left = pdf.sort_values(["h", "text"]), [], DICT_BYTES
        for text in pdf["text"]:
            b = plain(text).encode("utf-8", "replace")
            if 1 < len(b) <= left:
                got.append(b)
                left -= len(b)
        if not got and len(pdf):  # every text is longer than the dictionary
            got = [plain(min(pdf["text"], key=len)).encode("utf-8", "replace")[:DICT_BYTES]]
        learned = b"".join(got)
        if 1 < len(learned) < LEAST_BYTES:  # all there is of the language
            learned *= LEAST_BYTES
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "dict": [learned]})

    out = some.groupBy("lang").applyInPandas(fill, "lang string, dict binary").collect()
    return {r["lang"]: bytes(r["dict"]) for r in sorted(out, key=lambda r: (-counts[r["lang"]], r["lang"])) if len(r["dict"]) > 1}


def classify(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """docs as ``row`` with lang_pred, score (0 to 1) and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs, usual, fine = list(shared.value), [], []
        for packers, (level, least, strategy) in ((usual, USUAL), (fine, FINE)):
            for data in shared.value.values():
                d = zstd.ZstdCompressionDict(data, dict_type=zstd.DICT_TYPE_RAWCONTENT)
                how = zstd.ZstdCompressionParameters.from_level(level, min_match=least, strategy=getattr(zstd, strategy), write_content_size=0, write_dict_id=0)
                d.precompute_compress(compression_params=how)
                packers.append(zstd.ZstdCompressor(dict_data=d, compression_params=how))

        def one(text: str | None) -> tuple[str, float, bool]:
            text = plain(text or "")
            if text == " " or not langs:
                return "und", 0.0, True
            blocks = [text[i : i + BLOCK].encode("utf-8", "replace") for i in range(0, len(text), BLOCK)]
            packers = fine if len(blocks) == 1 and len(blocks[0]) < SHORT else usual
            sizes = [sum(len(p.compress(b)) for b in blocks) for p in packers]
            order = sorted(range(len(langs)), key=lambda i: (sizes[i], i))
            best = sizes[order[0]]
            total = sum(math.exp((best - s) / (1 + 0.01 * best)) for s in sizes)
            near = len(order) > 1 and sizes[order[1]] - best <= margin * best
            return langs[order[0]], 1 / total, near

        for batch in batches:
            yield pd.DataFrame([one(t) for t in batch], columns=["lang", "score", "rejected"])
        usual.clear()
        fine.clear()
        release()

    told = F.pandas_udf(run, "lang string, score double, rejected boolean")
    rows = docs.select(F.struct("*").alias("row")).withColumn("p", told(F.col(f"row.{text_col}")))
    return rows.select("row", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))


def keep_identified(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """The rows of docs whose language is told with a sufficient margin, with all their columns."""
    small_batches(docs.sparkSession)
    return classify(docs, learn(docs.filter(~in_fold(F.col("doc_id"), 3, 1))), margin=margin).filter("not rejected").select("row.*")


def op10(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = in_fold(F.col("doc_id"), 3, 1)
    told = classify(docs.select("doc_id", "text"), learn(docs.filter(~held)))
    return told.select("row.doc_id", in_fold(F.col("row.doc_id"), 3, 1).alias("held_out"), "lang_pred", "score", "rejected")
