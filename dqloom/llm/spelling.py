"""Spelling variants: words one edit apart, found by search schemes in bidirectional FM-indexes over the vocabulary.

One edit leaves the left or the right half of a word untouched. So a word is searched twice: its left half exactly from the delimiter on and then on to the
right, allowing one error (substitution, insertion or deletion), and its right half exactly from the other delimiter and then on to the left. A
shard's index holds the suffix ranks of its delimited words in both reading directions; a pattern is an interval of ranks and every step
narrows it by the ranks of one more character. All searches of a shard step together as arrays; branches are the characters that occur in
the interval. The second search leaves out what begins with the left half, so no pair is found twice.

A word is indexed in the shards of the halves that a neighbour of its length or one more or less could share with it (at most four), and searched in the
two of its own halves: a shard holds all words that could answer. Shards are by hash of the half and of about ``SHARD_WORDS`` words; a half that
more words have is split into several indexes, each of which answers all searches of that half. A search returns one row, with the number of near words and the
best one, not the pairs.

Nulls and odd input: a null text has no words; a null id is the empty string in the hash that decides which letter is left out; runs of one character have
an empty rest, which is no word; very long texts are taken whole, very long runs are words like others; words that tie in n go by code point order; repeated rows count
again; an empty table gives no words; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import discard, table, whole, written

LETTERS = r"[A-Za-zÀ-ÿ]+"
SHARD_WORDS = 100_000
#: Searches of a shard that step together.
TOGETHER = 20_000
#: Intervals up to this width are branched by the characters in them, wider ones by the whole alphabet.
NARROW = 64


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int = 199, least: int = 5, shortest: int = 6) -> DataFrame:
    """Rows (word, n): runs of letters in ASCII lower case with at least ``least`` occurrences. One in ``noise`` runs of a document, by crc32 of
    id and run, lacks one letter (0: none)."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text = F.translate(whole(F.col(text_col)), upper, lower)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))
    word = F.col("run")
    if noise:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        cut = F.expr("concat(substring(run, 1, cast(h % length(run) as int)), substring(run, cast(h % length(run) + 2 as int)))")
        word = F.when(F.col("h") % noise == 0, cut).otherwise(word)
    return runs.select(word.alias("word")).filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


class Index:
    """Suffix ranks of words, each between delimiters, in both reading directions.

    A pattern that is read in a direction is the interval of the suffixes, sorted by their text, that start with it.
    """

    def __init__(self, words: list[str]):
        self.words = words
        sizes = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.alphabet, codes = np.unique(points, return_inverse=True)
        self.sigma = len(self.alphabet)
        starts = np.cumsum(sizes + 1) - sizes  # a delimiter before every word and one at the end
        text = np.zeros(int(sizes.sum()) + len(words) + 1, np.int64)
        text[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(len(points))] = codes + 1
        self.owner = np.repeat(np.arange(len(words)), sizes + 1)
        # A search to the left steps backwards through the text, one to the right backwards through the reversed text.
        self.left, self.right = Ranks(text, self.sigma), Ranks(text[::-1].copy(), self.sigma)

    def codes(self, chars: np.ndarray) -> np.ndarray:
        """Codes of code points from 1; characters that no word has get -1."""
        at = np.minimum(np.searchsorted(self.alphabet, chars), max(self.sigma - 1, 0))
        return np.where(self.alphabet[at] == chars, at + 1, -1) if self.sigma else np.full(len(chars), -1)

    def word(self, ranks: np.ndarray, side: str) -> np.ndarray:
        """Numbers of the words of suffixes that start with a delimited word, given that both delimiters are part of the pattern."""
        n = len(self.left.order)
        at = self.left.order[ranks] if side == "left" else n - 1 - self.right.order[ranks]
        # Read to the left, a suffix starts at its word's first delimiter; read to the right, at its last.
        return self.owner[at] if side == "left" else self.owner[at - 1]


class Ranks:
    """An FM-index of a text of codes (0: delimiter): suffix order, the characters before each suffix, and their ranks."""

    def __init__(self, text: np.ndarray, sigma: int):
        n = len(text)
        rank, width = text, 1
        while rank.max() < n - 1:  # doubling; words are distinct, so no part of the text longer than two words repeats
            second = np.zeros(n, np.int64)
            second[:-width] = rank[width:] + 1
            rank = np.unique(rank * (n + 2) + second, return_inverse=True)[1]
            width *= 2
        self.order = np.argsort(rank)
        self.before = text[self.order - 1]
        order = np.argsort(self.before, kind="stable")
        self.n, self.keys = n, self.before[order] * (n + 1) + order

    def step(self, lo: np.ndarray, hi: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more character in front."""
        return np.searchsorted(self.keys, codes * (self.n + 1) + lo), np.searchsorted(self.keys, codes * (self.n + 1) + hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray, sigma: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of the interval, code) for the characters that can come next; the delimiter isn't one."""
        width = hi - lo
        narrow, wide = np.flatnonzero(width <= NARROW), np.flatnonzero(width > NARROW)
        w = width[narrow]
        who = np.repeat(narrow, w)
        at = np.arange(len(who)) - np.repeat(np.cumsum(w) - w, w) + lo[who]
        seen = np.unique(who * (sigma + 1) + self.before[at])
        who, code = seen // (sigma + 1), seen % (sigma + 1)
        who, code = np.concatenate((who, np.repeat(wide, sigma))), np.concatenate((code, np.tile(np.arange(1, sigma + 1), len(wide))))
        return who[code > 0], code[code > 0]


def search(index: Index, words: list[str], side: str) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (number of the searched word, number of the indexed word) that differ by exactly one edit outside the half on the given side."""
    ranks = index.left if side == "left" else index.right
    sizes = np.array([len(w) for w in words], np.int64)
    read = [w[::-1] for w in words] if side == "left" else words
    codes = index.codes(np.frombuffer("".join(read).encode("utf-32-le"), np.uint32))
    first = np.cumsum(sizes) - sizes
    half = sizes - sizes // 2 if side == "left" else sizes // 2  # what is matched exactly: the right half read backwards, or the left half
    n = len(words)
    at, lo, hi, who = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, ranks.n), np.arange(n)
    lo, hi = ranks.step(lo, hi, np.zeros(n, np.int64))  # the delimiter in front
    exact: list = [who, at, lo, hi]
    spent: list = [np.zeros(0, np.int64)] * 4
    out = []

    def narrowed(state: list, code: np.ndarray, forward: int) -> list:
        who, at, lo, hi = state
        lo, hi = ranks.step(lo, hi, code)
        live = (hi > lo) & (code >= 0)
        return [who[live], at[live] + forward, lo[live], hi[live]]

    while len(exact[0]) or len(spent[0]):
        who, at, lo, hi = exact
        ready = at >= half[who]
        free = [x[ready] for x in exact]
        new = []
        if len(free[0]):
            # one character more in the indexed word, or another one
            which, code = ranks.branches(free[2], free[3], index.sigma)
            more = [x[which] for x in free]
            new.append(narrowed(more, code, 0))
            other = more[1] < sizes[more[0]]
            same = np.zeros(len(code), bool)
            same[other] = codes[first[more[0][other]] + more[1][other]] == code[other]
            other &= ~same
            new.append(narrowed([x[other] for x in more], code[other], 1))
            short = free[1] < sizes[free[0]]  # one character less
            new.append([free[0][short], free[1][short] + 1, free[2][short], free[3][short]])
        spent = [np.concatenate(x) for x in zip(spent, *new)] if new else spent
        done = spent[1] == sizes[spent[0]]
        ended = narrowed([x[done] for x in spent], np.zeros(int(done.sum()), np.int64), 0)
        out.append(np.stack((ended[0], index.word(ended[2], side))) if len(ended[0]) else np.zeros((2, 0), np.int64))
        spent = [x[~done] for x in spent]
        exact = [x[at < sizes[who]] for x in exact]
        exact, spent = (narrowed(s, codes[first[s[0]] + s[1]], 1) for s in (exact, spent))
    pairs = np.unique(np.concatenate(out, axis=1), axis=1)
    return pairs[0], pairs[1]


def _near(part: pd.DataFrame) -> pd.DataFrame:
    """For the rows of one shard (word, n, side; side null: indexed): one row for each search with near words."""
    indexed = part[part["side"] == ""].drop_duplicates("word")
    none = pd.DataFrame({"word": pd.Series(dtype=object), "n_near": pd.Series(dtype="int64"), "best_n": pd.Series(dtype="int64"), "best": pd.Series(dtype=object)})
    if indexed.empty:
        return none
    index, counts = Index(list(indexed["word"])), indexed["n"].to_numpy()
    names, out = np.array(index.words, dtype=object), []
    for side, asked in part[part["side"] != ""].groupby("side"):
        asked = list(asked["word"])
        for i in range(0, len(asked), TOGETHER):
            some = asked[i : i + TOGETHER]
            a, b = search(index, some, side)
            if side == "left":  # the other search finds what shares the left half
                keep = np.array([not names[y].startswith(some[x][: len(some[x]) // 2]) for x, y in zip(a, b)], bool)
                a, b = a[keep], b[keep]
            if len(a):
                found = pd.DataFrame({"word": np.array(some, dtype=object)[a], "best": names[b], "best_n": counts[b]})
                found["near"] = 1
                found = found.sort_values(["word", "best_n", "best"], ascending=[True, False, True])
                out.append(found.groupby("word", sort=False).agg(n_near=("near", "sum"), best_n=("best_n", "first"), best=("best", "first")).reset_index())
    return pd.concat(out)[["word", "n_near", "best_n", "best"]] if out else none


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Rows (word, n_near, best_n, best) for the words (word, n) that have others one edit away; best is the most frequent, then the first in code point order."""
    halves = [F.struct(F.lit("right").alias("side"), F.expr(f"substring(word, 1, cast((length(word) + {d}) div 2 as int))").alias("half")) for d in (-1, 0, 1)]
    halves += [F.struct(F.lit("left").alias("side"), F.expr(f"substring(word, -cast((length(word) + {d}) - (length(word) + {d}) div 2 as int))").alias("half")) for d in (-1, 0, 1)]
    indexed = words.select("word", "n", F.explode(F.array_distinct(F.array(*halves))).alias("h")).select("word", "n", "h.side", "h.half")
    asked = words.select("word", "n", F.explode(F.array(halves[1], halves[4])).alias("h")).select("word", "n", "h.side", "h.half")
    counts = indexed.groupBy("side", "half").agg(F.count("*").alias("c"))
    many = counts.filter(F.col("c") > shard_words).select("side", "half", F.expr(f"cast(ceil(c / {shard_words}) as int)").alias("splits"))  # at most one for each shard
    shards = max(1, words.count() * 4 // shard_words)
    key = F.concat_ws("-", F.pmod(F.xxhash64("side", "half"), F.lit(shards)).cast("string"), F.when(F.col("splits").isNotNull(), F.concat_ws(":", "side", "half")))

    left = indexed.join(F.broadcast(many), ["side", "half"], "left").withColumn("split", F.pmod(F.xxhash64("word"), F.coalesce("splits", F.lit(1))))
    right = asked.join(F.broadcast(many), ["side", "half"], "left").withColumn("split", F.explode(F.sequence(F.lit(0), F.coalesce("splits", F.lit(1)) - 1)))
    shard = F.concat_ws("-", key, F.col("split").cast("string")).alias("shard")
    left, right = left.select(shard, "word", "n", F.lit("").alias("side")), right.select(shard, "word", "n", "side")
    found = left.unionByName(right).groupBy("shard").applyInPandas(_near, "word string, n_near long, best_n long, best string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("best"))).alias("b")).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def spelling_variants(words: DataFrame, ratio: int = 5, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) for words (word, n): a word's form is its best near word if that has at least ``ratio`` times its
    occurrences; the root is the last of the forms of forms."""
    words = written(words.select("word", "n"), "words")
    near = written(near_words(words, shard_words), "near")
    formed = words.join(near, "word", "left").withColumn("is_form", F.coalesce(F.col("best_n") >= F.col("n") * ratio, F.lit(False)))
    formed = formed.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("is_form"), F.col("best")).alias("form"), F.when(F.col("is_form"), F.col("best_n")).alias("form_n"))
    formed = written(formed, "formed")
    discard(near)
    up = written(formed.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:  # every round doubles the distance; forms grow by the ratio, so there are few
        above = up.select(F.col("word").alias("root"), F.col("root").alias("above"))
        step = written(up.join(above, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "roots")
        discard(up)
        up = step
        if not step.filter("moved").limit(1).count():
            break
    return formed.join(up.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(vocabulary(table(spark, sf_dir, "documents")))
