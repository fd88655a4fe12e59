"""Connected components of a table of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import discard, written

SALTS = 32


def joined_salted(rows: DataFrame, key: str, by: str, facts: DataFrame, how: str = "inner") -> DataFrame:
    """rows with the facts of their key (one row of facts per key), for keys that any share of rows may have: rows are spread by a hash of the
    column by, so a key's rows are dealt over SALTS tasks; only its SALTS copies meet its facts in one."""
    own = [c for c in rows.columns if c != key]
    more = [c for c in facts.columns if c != key]
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    keys = dealt.select(F.col(key).alias("_key"), F.col("_salt").alias("_s")).distinct()
    keys = keys.join(facts, F.col("_key") == facts[key]).select("_key", "_s", *more)
    return dealt.join(keys, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_s")), how).select(key, *own, *more)


#: Rounds of least labels alone; links that come as stars need no more. From then on pointers are jumped as well.
PLAIN_ROUNDS = 2


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node in links (a, b); label is the least node that links lead to. Each round is written to the
    shared folder; the number of rounds grows with the logarithm of the longest path. A large group is one label of many nodes: the join on
    labels is salted."""
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b"), "edges")
    labels = last = written(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    rounds = 0
    while True:
        rounds += 1
        near = edges.join(labels, edges.a == labels.node).groupBy("b").agg(F.min("label").alias("m"))
        new = written(labels.join(near, labels.node == near.b).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")), "labels")
        if rounds > PLAIN_ROUNDS:
            step, up = new, new.select(F.col("node").alias("label"), F.col("label").alias("up"))
            new = written(joined_salted(step, "label", "node", up).select("node", "old", F.least("label", "up").alias("label")), "labels")
            discard(step)
        discard(last)
        changed = new.filter("label <> old").limit(1).count()
        last, labels = new, new.select("node", "label")
        if not changed:
            discard(edges)
            return labels
