"""Toxic passages by maximum-scoring segments.

Each token gets the log-odds of standing in a toxic document, whether they speak for it or against it. They come from document counts with a
Dirichlet prior: the rate of a word is smoothed towards the rate of its longest prefix, that of a prefix towards the next shorter one, and
the first towards the overall rate. A constant drift is taken from every token, so that text falls where nothing speaks for toxicity. A
linear scan of a text's tokens (Ruzzo and Tompa) then gives all maximal segments. Extreme-value statistics calibrate them: lambda solves
E[exp(lambda * score)] = 1 over the tokens of clean texts, and K is the maximum-likelihood value of Gumbel's law for the best segments
of clean texts. A segment of score S in a text of n tokens has the normalised score lambda*S - ln(K*n); it is significant if at most
``MOST_CHANCE`` such segments are expected in a clean text of that length. The significant ones add up, and a non-decreasing curve fitted to a
held-back part of the training rows turns the sum into a probability, above the last point of the curve nearing 1 without end.

Fitting is bounded: at most about ``MAX_LABELS`` labelled rows (by hash of the id). All their tokens and prefixes are counted and scored, on
Spark, a group of words of one first prefix at a time. Scores are held in steps of ``STEP``, and a feature that has the score of the longest prefix
before it is that prefix's; the others are broadcast. Scoring takes every row and its whole text; language, source and id are no inputs.

Nulls and odd input: a null text counts as empty, an empty one gets the score of a text without significant segments; a very long text is
scanned whole, in linear time; rows of ``labels`` with a null are left out, of several for one document the largest counts; without any
label or any toxic one every score is the overall rate; texts that tie get one score; rows that repeat are each scored; an empty table gives
an empty result; further columns of any name are carried in ``row``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import discard, table, whole, written
from dqloom.llm.language_id import in_fold

MAX_LABELS = 60_000
#: Lengths of the prefixes that a word's rate is smoothed towards; strength of the prior, in documents; steps of scores.
PREFIXES = (4, 5, 6, 7, 8)
PRIOR = 50.0
STEP = 0.5
#: Taken from every token's log-odds.
DRIFT = 0.8
#: Segments of such a score that a clean text of the same length may be expected to have.
MOST_CHANCE = 0.05
THRESHOLD = 0.3
SEED = 11
_TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def features(word: str) -> list[str]:
    """The word's prefixes, shortest first, then the word itself (marked by a $)."""
    return [word[:n] for n in PREFIXES if len(word) >= n] + [word + "$"]


def _before(feature: str, known: dict[str, float]) -> str | None:
    """The longest known prefix that a feature goes on."""
    bare = feature.removesuffix("$")
    return next((bare[:n] for n in reversed(PREFIXES) if n < len(feature) and n <= len(bare) and bare[:n] in known), None)


def log_odds(counts: dict[str, tuple[int, int]], toxic: int, total: int, prior: float = PRIOR) -> dict[str, float]:
    """Score of each feature from (toxic documents, documents) that hold it."""
    base = (toxic + 0.5) / (total + 1)
    zero = math.log(base / (1 - base))
    rates: dict[str, float] = {}
    out = {}
    for f in sorted(counts, key=lambda f: (len(f), f)):
        parent = _before(f, rates)
        a, n = counts[f]
        rates[f] = (a + prior * (rates[parent] if parent else base)) / (n + prior)
        out[f] = math.log(rates[f] / (1 - rates[f])) - zero
    return out


def stepped(scores: dict[str, float], step: float = STEP) -> dict[str, float]:
    """Scores rounded to steps, without those that the longest prefix left (or 0, if there is none) says as well."""
    out: dict[str, float] = {}
    for f in sorted(scores, key=lambda f: (len(f), f)):
        s, parent = round(scores[f] / step) * step, _before(f, out)
        if s != (out[parent] if parent else 0.0):
            out[f] = s
    return out


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of a sequence of token scores."""
    sums = np.cumsum(scores)
    stack: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum through
    for at in np.flatnonzero(scores > 0).tolist():
        right = float(sums[at])
        first, last, left = at, at, right - float(scores[at])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j -= 1
            if j < 0 or stack[j][3] >= right:
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((first, last, left, right))
    return [(f, e, r - b) for f, e, b, r in stack]


def decay(scores: dict[float, int]) -> float:
    """lambda of token scores (score: times): the positive root of E[exp(lambda * score)] = 1, or 1 if no score is positive."""
    total = sum(scores.values())
    if not any(s > 0 for s in scores):
        return 1.0
    value = lambda x: sum(n * math.exp(min(700, x * s)) for s, n in scores.items()) / total - 1
    low, high = 1e-4, 1e-4
    while value(high) < 0 and high < 50:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return max(low, 0.05)


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows (id, text, toxic, part); part 1 is held back for the calibration."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(~in_fold(F.col("doc_id"), 4, 2))
    n = known.count()
    share = min(1.0, MAX_LABELS / max(n, 1))
    known = known.filter(F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) < share * (1 << 30))  # about MAX_LABELS rows of 16 bytes
    part = (F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(3)) == 0).cast("int")
    return docs.join(F.broadcast(known.select(F.col("doc_id").alias("i"), (F.col("toxic") > 0).cast("int").alias("toxic"))), F.col("doc_id") == F.col("i")).select("doc_id", whole(F.col("text")).alias("text"), "toxic", part.alias("part"))


def _counted(rows: DataFrame) -> DataFrame:
    """(f, a, n): toxic documents and documents by feature; '' for all."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> Iterator[pd.DataFrame]:
            keys = list(both[1])
            for i in range(0, len(keys), 10_000):
                some = keys[i : i + 10_000]
                yield pd.DataFrame({"f": some, "a": [both[0][k] for k in some], "n": [both[1][k] for k in some]})
            both[0].clear()
            both[1].clear()

        for pdf in batches:
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                seen = {f for w in set(tokens(text)) for f in features(w)} | {""}
                both[1].update(seen)
                if toxic:
                    both[0].update(seen)
                if len(both[1]) > 200_000:
                    yield from flush()
        yield from flush()

    return rows.select("text", "toxic").mapInPandas(run, "f string, a long, n long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("n").alias("n"))


def _lexicon(counts: DataFrame, toxic: int, total: int) -> dict[str, float]:
    """Scores of the features that differ from the prefix before them. A feature's smoothing needs those of its own first prefix only."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kept = stepped(log_odds({f: (a, n) for f, a, n in zip(pdf["f"], pdf["a"].tolist(), pdf["n"].tolist(), strict=True)}, toxic, total))
        return pd.DataFrame({"f": pd.Series(list(kept), dtype=object), "s": pd.Series(list(kept.values()), dtype=float)})

    rows = counts.filter("f <> ''").withColumn("first", F.substring("f", 1, PREFIXES[0]))
    found = rows.groupBy("first").applyInPandas(run, "f string, s double").toArrow()  # features of at most MAX_LABELS rows
    return dict(zip(found["f"].to_pylist(), found["s"].to_pylist(), strict=True))


class _Words(dict):
    """The score of each word, by its most specific feature, less the drift."""

    def __init__(self, scores: dict[str, float]):
        super().__init__()
        self.scores = scores

    def __missing__(self, word: str) -> float:
        s = next((self.scores[f] for f in reversed(features(word)) if f in self.scores), 0.0) - DRIFT
        if len(self) < 100_000:
            self[word] = s
        return s


class Model:
    """Token scores, the constants of their extreme-value law, and the curve from sums to probabilities."""

    def __init__(self, scores: dict[str, float], base: float):
        self.scores, self.base, self.lam, self.k, self.curve = scores, base, 1.0, 0.1, [(0.0, base)]
        self._words: _Words | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_words": None}

    def token_scores(self, text: str) -> np.ndarray:
        if self._words is None:
            self._words = _Words(self.scores)
        words = tokens(text)
        return np.fromiter(map(self._words.__getitem__, words), np.float64, len(words))

    def passages(self, text: str) -> list[tuple[int, int, float]]:
        """The significant segments (first token, last token, normalised score)."""
        s = self.token_scores(text)
        less = math.log(max(self.k * max(len(s), 1), 1e-300))
        found = ((f, e, self.lam * x - less) for f, e, x in segments(s))
        return [x for x in found if x[2] > -math.log(MOST_CHANCE)]

    def probability(self, x: float) -> float:
        """Linear between the curve's knots; beyond the last one it nears 1, so that higher sums still rank higher."""
        knots = self.curve
        if x <= knots[0][0]:
            return knots[0][1]
        for (x0, p0), (x1, p1) in zip(knots, knots[1:], strict=False):
            if x <= x1:
                return p0 + (p1 - p0) * (x - x0) / (x1 - x0)
        last, p = knots[-1]
        return p + (1 - p) * (x - last) / (x - last + 200.0) / 2


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = _labelled(docs, labels)
    counts = written(_counted(rows.filter("part = 0")), "features")
    all_ = counts.filter("f = ''").first()
    toxic, total = (int(all_["a"]), int(all_["n"])) if all_ else (0, 0)
    model = Model(_lexicon(counts, toxic, total) if total else {}, (toxic + 0.5) / (total + 1))
    discard(counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # One pass over the held-back part: the segments of each text, which need no constants, and how often each token score stands in clean texts.
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: Counter = Counter()
            out = []
            for text, toxic in zip(pdf["text"], pdf["toxic"].tolist(), strict=True):
                s = shared.value.token_scores(text)
                out.append((toxic, len(s), [x for *_, x in segments(s)], None, None))
                if not toxic:
                    values, times = np.unique(s, return_counts=True)
                    seen.update(dict(zip(values.tolist(), times.tolist(), strict=True)))
            yield pd.DataFrame(out + [(None, None, None, v, n) for v, n in seen.items()], columns=["toxic", "n", "segments", "value", "times"]).astype({"toxic": "Int64", "n": "Int64", "times": "Int64"})

    back = written(rows.filter("part = 1").select("text", "toxic").mapInPandas(scan, "toxic long, n long, segments array<double>, value double, times long"), "segments")
    clean = {r["value"]: r["times"] for r in back.filter("value is not null").groupBy("value").agg(F.sum("times").alias("times")).collect()}  # as many as steps
    texts = back.filter("value is null").withColumn("n", F.greatest("n", F.lit(1)))
    if clean:
        model.lam = decay(clean)
        best = F.coalesce(F.array_max("segments"), F.lit(0.0))
        law = texts.filter("toxic = 0").agg(F.count("*").alias("texts"), F.sum(F.col("n") * F.exp(-model.lam * best)).alias("sum")).first()
        model.k = law["texts"] / law["sum"] if law["sum"] else model.k
    normalised = F.filter(F.transform("segments", lambda x: F.lit(model.lam) * x - F.log(F.lit(model.k) * F.col("n"))), lambda z: z > -math.log(MOST_CHANCE))
    x = F.aggregate(normalised, F.lit(0.0), lambda a, z: a + z)
    # Points of the curve: sums in tenths, above 20 in steps of a half per cent.
    point = F.when(F.col("x") < 20, F.round("x", 1)).otherwise(F.exp(F.round(200 * F.log("x")) / 200))
    bins = texts.select("toxic", x.alias("x")).groupBy(point.alias("x")).agg(F.sum("toxic").alias("a"), F.count("*").alias("n")).collect()
    model.curve = isotonic([(r["x"], r["a"], r["n"]) for r in bins], model.base)
    discard(back)
    return model


def isotonic(points: list[tuple[float, int, int]], base: float) -> list[tuple[float, float]]:
    """Knots (sum, probability) of the non-decreasing curve nearest to (sum, toxic, all) counts, each block smoothed by one pseudo-document."""
    blocks: list[list[float]] = []  # toxic, all, sum of x * all
    for x, a, n in sorted(points):
        blocks.append([a, n, x * n])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last, strict=True)]
    out: list[tuple[float, float]] = []
    for a, n, x in blocks:
        out.append((x / n, max((a + base) / (n + 1), out[-1][1] if out else 0.0)))
    return out or [(0.0, base)]


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs as ``row`` with score and ``passages``: array of struct(first token, last token, normalised score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            found = [m.passages(t or "") for t in batch]
            yield pd.DataFrame({"score": [m.probability(sum(z for *_, z in x)) for x in found], "passages": [[{"first": f, "last": e, "z": z} for f, e, z in x] for x in found]})

    told = F.pandas_udf(run, "score double, passages array<struct<first:int,last:int,z:double>>")
    return docs.select(F.struct("*").alias("row")).withColumn("p", told(F.col(f"row.{text_col}"))).select("row", "p.score", "p.passages")


def op3(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return found.select("row.doc_id", in_fold(F.col("row.doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
