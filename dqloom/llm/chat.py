"""Reply-ordered conversations without quotes, by linking quotations to the messages they come from.

Each message is parsed into lines with their quote level (leading ``>``, nested ones counted). Lines of one level that stand together
form a passage; passages and their single lines are normalised (ASCII lower case, runs of white space to one space) and hashed. Whole
passages are hashed whatever their length; a line inside a longer passage needs ``MIN_WORDS`` words or, as many languages don't
space them, ``MIN_BYTES`` bytes of UTF-8. A quoted hash is joined to the earliest message of the conversation in whose own lines it
stands. The latest message that is quoted at level 1 is the parent, and following parents (by pointer jumping) gives the
root. Messages are ordered by root, then turn, so that an answer comes after what it answers and threads stay together.

Joins are on (conversation, hash) to at most one row each, so a passage that stands in many messages emits no pairs. A conversation
may hold any share of the rows: the order is taken by ranges of (conversation, root, turn), not in one task for each.

Nulls and odd input: a null text counts as empty; a message with a null conversation or turn has no links and is its own root;
rows that repeat (conversation, turn) share parent and root and are each kept; of messages that tie for the earliest with a passage the
smaller turn counts, and rows that tie in the order stand by text and role; a very long text is parsed whole, line by line; an empty table gives an
empty result; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import table, written

MIN_WORDS = 3
MIN_BYTES = 9
_QUOTE = re.compile(r"(?:[ \t]*>)+")
_SAID = re.compile(r"[ \t]*(?:On|Am|Le|El) .*(?:wrote|schrieb|écrit|escribió)[ \t]*:[ \t]*")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def _hash(text: str, whole: bool) -> int | None:
    words = _SPACE.sub(" ", text).strip(" ")
    data = words.encode("utf-8", "replace").lower()
    if not whole and len(data) < MIN_BYTES and len(words.split(" ")) < MIN_WORDS:
        return None
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "big", signed=True)


def parse(text: str) -> tuple[str, list[int], list[tuple[int, int]]]:
    """Own text, hashes of own passages and lines, (level, hash) of quoted ones."""
    lines = []
    for line in text.split("\n"):
        line = line.rstrip("\r")
        m = _QUOTE.match(line)
        lines.append((m[0].count(">"), line[m.end() :].strip(" \t")) if m else (0, line))
    kept = [(level, s) for i, (level, s) in enumerate(lines) if not (level == 0 and _SAID.fullmatch(s) and i + 1 < len(lines) and lines[i + 1][0] > 0)]
    own = "\n".join(s for level, s in kept if level == 0).strip("\n\r \t")
    runs: list[tuple[int, list[str]]] = []
    before = None
    for level, s in kept:
        blank = not s.strip()
        if not blank and runs and before == level:
            runs[-1][1].append(s)
        elif not blank:
            runs.append((level, [s]))
        before = None if blank else level
    mine, quoted = set(), set()
    for level, run in runs:
        for i, unit in enumerate(["\n".join(run), *run]):
            h = _hash(unit, i == 0)
            if h is not None:
                (quoted.add((level, h)) if level else mine.add(h))
    return own, sorted(mine), sorted(quoted)


def linked(messages: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, parent_turn, root_turn, position, n_quotes, n_linked)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [parse(t or "") for t in pdf["text"]]
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "turn": pdf["turn"], "role": pdf["role"], "own": [o for o, _, _ in found], "mine": [m for _, m, _ in found], "quoted": [[{"level": a, "h": b} for a, b in q] for _, _, q in found]})

    schema = "conv_id long, turn long, role string, own string, mine array<long>, quoted array<struct<level:int,h:long>>"
    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), "text")
    parsed = written(rows.mapInPandas(run, schema), "messages")
    quotes = parsed.filter("size(quoted) > 0 and conv_id is not null and turn is not null").select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", F.col("q.level").alias("level"), F.col("q.h").alias("h"))
    # Only conversations that quote need their own passages.
    quoting = quotes.select("conv_id").distinct()
    origin = parsed.filter("turn is not null").select("conv_id", "turn", F.explode("mine").alias("h")).join(quoting, "conv_id", "left_semi")
    origin = origin.groupBy("conv_id", "h").agg(F.min("turn").alias("from_turn"))
    found = quotes.join(origin, ["conv_id", "h"], "left").withColumn("from_turn", F.when(F.col("from_turn") < F.col("turn"), F.col("from_turn")))
    found = found.groupBy("conv_id", "turn").agg(F.max(F.when(F.col("level") == 1, F.col("from_turn"))).alias("parent_turn"), F.count("*").alias("n_quotes"), F.count("from_turn").alias("n_linked"))
    found = written(found, "replies")
    up = written(found.filter("parent_turn is not null").select("conv_id", "turn", F.col("parent_turn").alias("up")), "up")
    while True:  # each round doubles the distance
        above = up.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("up").alias("up2"))
        step = written(up.join(above, (up.conv_id == above.c) & (up.up == above.t), "left").select("conv_id", "turn", F.coalesce("up2", "up").alias("up"), F.col("up2").isNotNull().alias("moved")), "up")
        up = step.select("conv_id", "turn", "up")
        if not step.filter("moved").limit(1).count():
            break
    out = parsed.select("conv_id", "turn", "role", F.col("own").alias("text"))
    out = out.join(found, ["conv_id", "turn"], "left").join(up.withColumnRenamed("up", "root_turn"), ["conv_id", "turn"], "left")
    out = out.select("conv_id", "turn", "role", "text", "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"))
    return _numbered(out)


def _numbered(rows: DataFrame) -> DataFrame:
    """rows with ``position`` in the conversation, from 1, by (root_turn, turn, text): rows are dealt by ranges of that order."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "root_turn", "turn", "text", "role"]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = written(dealt.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "ordered")
    here = dealt.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("m"))
    here = here.withColumn("before", F.expr("coalesce(sum(m) over (partition by conv_id order by part rows between unbounded preceding and 1 preceding), 0)"))
    here = here.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "first", "before")
    out = dealt.join(here, dealt.conv_id.eqNullSafe(here.c) & (dealt.part == here.p))
    return out.withColumn("position", (F.col("before") + F.col("at") - F.col("first") + 1).cast("long")).drop("at", "part", "c", "p", "first", "before")


def op6(spark, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "conversations")).select("conv_id", "turn", "role", "text", "parent_turn", "root_turn", "position", "n_quotes", "n_linked")
