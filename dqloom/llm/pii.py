"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust a score.

Runs as DataFrame expressions only. Java's ``split`` gives the gaps between matches and ``regexp_extract_all`` the
matches; running sums of their lengths, chunk by chunk, are the offsets in code points. The patterns below use possessive quantifiers and
look-behind so that long runs cost linear time; they match what the plain patterns match.

Base kinds (email, ip, card, phone) are reported whenever their own check holds. Further kinds come only when their
score, raised or lowered by context words, reaches ``MIN_SCORE``: IBAN (mod 97), secret (a long hexadecimal token) and
national number (3-2-4 digits).

Nulls and odd input: a null or empty text has no spans and the digest of the empty string; a null id stays null; rows that
repeat are reported each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import table, whole

#: kind, pattern, cheap test before the pattern runs
BASE = [
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    ("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])", ""),  # the whole run has 12 to 19 digits
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
]
EXTRA = [
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", ""),
    ("secret", r"(?<![A-Za-z0-9])[0-9a-f]{32,64}(?![A-Za-z0-9])", ""),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-"),
]
KINDS = [k for k, _, _ in BASE + EXTRA]
#: Words within CONTEXT characters before a span that make it likelier, and words that make it less likely.
CONTEXT = 40
FOR = {
    "email": "mail|contact|write", "ip": r"\bip\b|address|host|server", "card": "card|visa|credit|payment", "phone": "phone|call|tel|mobile",
    "iban": "iban|bank|account|konto|compte|cuenta", "secret": "token|secret|key|password|api", "ssn": "ssn|social|security|insurance",
}
AGAINST = r"\b(?:order|invoice|version|isbn|part|sample|example)\b"
#: Before context and after a checksum, by kind.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.3, "phone": 0.6, "iban": 0.3, "secret": 0.4, "ssn": 0.4}
CHECKED = {"card": 0.4, "iban": 0.5}
MIN_SCORE = 0.5
#: Matches whose offsets are summed one by one; those of whole chunks come first, so a text of very many matches costs little more than each.
CHUNK = 512
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    back = F.split(F.reverse(number), "")
    total = F.aggregate(
        F.transform(F.filter(back, lambda x: x != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces leaves 1 when divided by 97."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    chars = F.filter(F.split(turned, ""), lambda x: x != "")
    value = F.aggregate(
        chars,
        F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )
    return value == 1


def _valid(kind: str, m: Column) -> Column:
    digits = _digits(m)
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        bare = F.regexp_replace(m, " ", "")
        return F.length(bare).between(15, 34) & mod97(bare)
    if kind == "secret":
        return m.rlike("[0-9]") & m.rlike("[a-f]")
    return F.lit(True)


def _may(text: Column, kind: str, test: str) -> Column:
    """A cheap test that holds wherever the kind's pattern can match."""
    may = text.contains(test) if test else F.lit(True)
    return may if kind == "email" else may & text.rlike("[0-9]")


def _once(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def _running(first: Column, steps: Column, at, step) -> Column:
    """Array of first plus the steps before each of steps, plus what at takes from it. Its cost is the square of the number of steps."""
    start = F.struct(first.alias("sum"), F.array().cast("array<int>").alias("seen"))
    return F.aggregate(steps, start, lambda a, x: F.struct((a["sum"] + step(x)).alias("sum"), F.concat(a["seen"], F.array(a["sum"] + at(x))).alias("seen")), lambda a: a["seen"])


def _starts(steps: Column) -> Column:
    """Offset of each match from (gap before it, gap and match): running sums within chunks of CHUNK, from running sums of whole chunks."""

    def of_chunks(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x["all"]))
        firsts = _running(F.lit(0), totals, lambda x: F.lit(0), lambda x: x)
        return F.flatten(F.zip_with(chunks, firsts, lambda c, first: _running(first, c, lambda x: x["g"], lambda x: x["all"])))

    def of_steps(some: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(some) - 1) / CHUNK).cast("int"))
        return _once(F.transform(numbers, lambda k: F.slice(some, k * CHUNK + 1, F.lit(CHUNK))), of_chunks)

    return _once(steps, of_steps)


def _spans(no: int, kind: str, matches: Column, gaps: Column) -> Column:
    """Array of struct(s, no, e, score) of one kind's valid matches."""
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: F.struct(F.length(g).alias("g"), (F.length(g) + F.length(m)).alias("all")))
    starts = _starts(steps)
    spans = F.arrays_zip(starts.alias("s"), matches.alias("m"), F.slice(gaps, F.lit(1), F.size(matches)).alias("g"))

    def score(x: Column) -> Column:
        near = F.lower(F.substr(x["g"], F.greatest(F.length(x["g"]) - CONTEXT, F.lit(0)) + 1))
        up = F.when(near.rlike(FOR[kind]), 0.2).otherwise(0.0)
        down = F.when(near.rlike(AGAINST), 0.2).otherwise(0.0)
        return F.lit(PRIOR[kind] + CHECKED.get(kind, 0.0)) + up - down

    valid = F.filter(spans, lambda x: _valid(kind, x["m"]))
    out = F.transform(valid, lambda x: F.struct(x["s"].alias("s"), F.lit(no).alias("no"), (x["s"] + F.length(x["m"])).alias("e"), F.round(score(x), 4).alias("score")))
    return F.filter(out, lambda x: x["score"] >= MIN_SCORE) if no >= len(BASE) else out


def find_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs (as ``row``) with ``spans``: array of struct(s, no, e, score) by start, then kind; ``no`` indexes KINDS."""
    kinds = list(enumerate(BASE + EXTRA))
    none = F.array().cast("array<string>")
    rows = docs.select(F.struct("*").alias("row")).withColumn("t", whole(F.col(f"row.{text_col}")))
    # Matches and gaps are columns of their own: each pattern then runs once for either.
    rows = rows.select(
        "row",
        *[F.when(_may(F.col("t"), k, test), F.regexp_extract_all("t", F.lit(p), F.lit(0))).otherwise(none).alias(f"m{i}") for i, (k, p, test) in kinds],
        "t",
    )
    rows = rows.select("row", *[f"m{i}" for i, _ in kinds], *[F.when(F.size(f"m{i}") > 0, F.split("t", p, -1)).otherwise(none).alias(f"g{i}") for i, (_, p, _) in kinds])
    found = [F.when(F.size(f"m{i}") > 0, _spans(i, k, F.col(f"m{i}"), F.col(f"g{i}"))).otherwise(F.array().cast("array<struct<s:int,no:int,e:int,score:double>>")) for i, (k, _, _) in kinds]
    return rows.select("row", F.array_sort(F.concat(*found)).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["no"] + 1), x["s"].cast("string"), x["e"].cast("string"))))


def _equals(i: int):
    return lambda x: x == i


def op1(spark, sf_dir: str) -> DataFrame:
    rows = find_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).select("row.doc_id", "spans")
    numbers = F.transform("spans", lambda x: x["no"])
    n = {f"n_{k}": F.size(F.filter(numbers, _equals(i))).cast("long") for i, k in enumerate(KINDS)}
    base = F.filter("spans", lambda x: x["no"] < len(BASE))
    return rows.select(
        "doc_id", *[n[f"n_{k}"].alias(f"n_{k}") for k in KINDS[:4]], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        *[n[f"n_{k}"].alias(f"n_{k}") for k in KINDS[4:]], F.array_max(F.transform("spans", lambda x: x["score"])).alias("top_score"),
    )
