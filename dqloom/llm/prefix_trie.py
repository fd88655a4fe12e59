"""The trie of conversation prefixes, by ROLLUP over blocks of positional turn columns.

Every turn gets an id: four 32-bit hashes of its position and of the SHA-256 of role and text. A prefix is known by its length and the sums of
its turns' ids (128 bits), so the prefix that a block of ``BLOCK`` turns stands on is a running sum and all blocks of all
conversations are aggregated at once: ``GROUP BY prefix before the block, ROLLUP(t1, ..., tK)``, where grouping_id() tells how many of the
block's turns a node has. A conversation of any length is just more blocks; no round waits for the one before.

A node belongs to its smallest conversation, and a conversation's own nodes are the end of its path: a chain that hangs on a
node of a smaller conversation. Sums over subtrees are therefore sums along chains (running sums) and over the much smaller forest of chains
(pointer doubling, rounds grow with the logarithm of the times a path changes hands).

Hot keys: a turn, a prefix or a conversation may hold any share of the rows. Turns are numbered by ranges; running sums go over pieces of
``PIECE`` rows and then over the pieces; nodes come from map-side partial aggregates; joins are on keys that both sides
have once, or salted. The ids that end in a node are hashed from pieces of at most ``IDS`` ids: SHA-256 is sequential, so a node's pieces
pass one task in order, as a stream; nothing is collected.

Nulls and odd input: turns stand by turn (null first), role, the first 64 characters of the text and the digest, so repeated rows are turns of
their own and ties have one order; null role or text is empty; rows without a conv_id take no part; empty and very long texts are turns like others, very
long conversations have deep chains; an empty table has no node, not even the root; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import discard, table, whole, written
from dqloom.llm.components import joined_salted

BLOCK = 8
PIECE = 1024
IDS = 8192
_LANES = range(4)
_KEY = ["k0", "k1", "k2", "k3"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, pos, digest, n): the turns of each conversation numbered from 1, with the code points of their text."""
    role, text = whole(F.col("role").cast("string")), whole(F.col("text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.filter("conv_id is not null").select("conv_id", "turn", role.alias("role"), F.substring(text, 1, 64).alias("head"), digest.alias("digest"), F.length(text).cast("long").alias("n"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "role", "head", "digest"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    dealt = written(dealt.select("conv_id", "digest", "n", "at", F.shiftright("at", 33).alias("part")), "dealt")
    here = dealt.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("m"))
    here = here.withColumn("before", F.expr("coalesce(sum(m) over (partition by conv_id order by part rows between unbounded preceding and 1 preceding), 0)"))
    out = written(dealt.join(here, ["conv_id", "part"]).select("conv_id", (F.col("before") + F.col("at") - F.col("first") + 1).alias("pos"), "digest", "n"), "turns")
    discard(dealt)
    return out


def with_shared_heads(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) after every conversation c begins with the first crc32(c) % most turns of conversation c - c % group instead of its own."""
    c = F.col("conv_id")
    base, h = c - c % group, F.crc32(c.cast("string").cast("binary")) % most
    heads = turns.filter((F.col("pos") < most) & (c == base)).groupBy(c.alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "n"))).alias("head"))
    convs = turns.select("conv_id").distinct().withColumn("base", base).withColumn("h", h.cast("int")).join(heads, "base", "left")
    convs = written(convs.select("conv_id", "h", F.slice(F.coalesce("head", F.expr("cast(array() as array<struct<pos:bigint,digest:binary,n:bigint>>)")), F.lit(1), F.col("h")).alias("head")), "conversations")
    shifts = convs.select("conv_id", (F.col("h") - F.size("head")).cast("long").alias("shift"))
    own = joined_salted(turns.filter(F.col("pos") > h), "conv_id", "pos", shifts).select("conv_id", (F.col("pos") - F.col("shift")).alias("pos"), "digest", "n")
    given = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.digest", "t.n")
    return convs.select("conv_id"), own.unionByName(given)


def _running(rows: DataFrame, at: str, sums: dict[str, str], desc: bool = False) -> DataFrame:
    """rows with running sums over each conversation in the order of the column ``at``: of all rows before a row, or from its end up to and with it (desc)."""
    rows = rows.withColumn("piece", F.expr(f"{at} div {PIECE}"))
    way = "desc rows between unbounded preceding and current row" if desc else "rows between unbounded preceding and 1 preceding"
    over = f"over (partition by conv_id, piece order by {at} {way})"
    before = f"over (partition by conv_id order by piece {'desc' if desc else ''} rows between unbounded preceding and 1 preceding)"
    whole_ = rows.groupBy("conv_id", "piece").agg(*[F.sum(v).alias(f"_{k}") for k, v in sums.items()])
    whole_ = whole_.select("conv_id", "piece", *[F.expr(f"coalesce(sum(_{k}) {before}, 0)").alias(f"_{k}") for k in sums])
    rows = rows.withColumns({k: F.expr(f"coalesce(sum({v}) {over}, 0)") for k, v in sums.items()})
    rows = rows.join(whole_, ["conv_id", "piece"])
    return rows.withColumns({k: F.col(k) + F.col(f"_{k}") for k in sums}).drop("piece", *[f"_{k}" for k in sums])


def _blocks(convs: DataFrame, turns: DataFrame, block: int) -> DataFrame:
    """Rows (conv_id, block, k0..k3 of the prefix before it, t1..tK); each conversation has block 0, also one without turns."""
    id_ = F.struct(*[F.expr(f"xxhash64(digest, pos, {i}) & 4294967295").alias(f"h{i}") for i in _LANES], "n")
    none = F.lit(None).cast("struct<h0:bigint,h1:bigint,h2:bigint,h3:bigint,n:bigint>")
    rows = turns.select("conv_id", "pos", id_.alias("t")).unionByName(convs.select("conv_id", F.lit(0).cast("long").alias("pos"), none.alias("t")))
    slot = F.pmod(F.col("pos") - 1, F.lit(block)) + 1
    columns = [F.max(F.when((slot == i) & (F.col("pos") > 0), F.col("t"))).alias(f"t{i}") for i in range(1, block + 1)]
    sums = [F.coalesce(F.sum(f"t.h{i}"), F.lit(0)).alias(f"s{i}") for i in _LANES]
    rows = rows.groupBy("conv_id", F.expr(f"(pos - 1) div {block}").alias("block")).agg(*columns, *sums)
    return _running(rows, "block", {f"k{i}": f"s{i}" for i in _LANES})


def _nodes(blocks: DataFrame, block: int) -> DataFrame:
    """Rows (conv_id, depth, n_convs, n, k0..k3, p0..p3): all prefixes, with their keys and those of their parents."""
    names = ", ".join(f"t{i}" for i in range(1, block + 1))
    rolled = blocks.sparkSession.sql(
        f"select block, k0, k1, k2, k3, {names}, {block} - bit_count(grouping_id()) as level, count(*) as n_convs, min(conv_id) as conv_id from {{blocks}} group by block, k0, k1, k2, k3, rollup({names})",
        blocks=blocks,
    )
    last = F.expr(f"if(level > 0, array({names})[level - 1], null)")
    rolled = rolled.withColumn("last", last).filter("last is not null or (level = 0 and block = 0)")
    key = {f"k{i}": F.expr(f"k{i} + " + " + ".join(f"coalesce(t{j}.h{i}, 0)" for j in range(1, block + 1))) for i in _LANES}
    rolled = rolled.withColumn("depth", F.col("block") * block + F.col("level")).withColumns(key)
    return rolled.select("conv_id", "depth", "n_convs", F.coalesce("last.n", F.lit(0)).alias("n"), *_KEY, *[(F.col(f"k{i}") - F.coalesce(f"last.h{i}", F.lit(0))).alias(f"p{i}") for i in _LANES])


def _ends(blocks: DataFrame, block: int) -> DataFrame:
    """Rows (depth, k0..k3, ends_sha256) for the prefixes that are whole conversations."""
    size = " + ".join(f"if(t{i} is null, 0, 1)" for i in range(1, block + 1))
    full = blocks.groupBy("conv_id").agg(F.sum(F.expr(size)).cast("long").alias("depth"), *[F.sum(f"s{i}").alias(f"k{i}") for i in _LANES])
    key = ["depth", *_KEY]
    pieces = full.groupBy(*key, F.expr(f"conv_id div {IDS}").alias("at")).agg(F.concat_ws(",", F.sort_array(F.collect_list("conv_id")).cast("array<string>")).alias("ids"))
    pieces = written(pieces, "ends")
    some = pieces.groupBy(*key).agg(F.count("*").alias("pieces"), F.max("ids").alias("ids"))
    single = some.filter("pieces = 1").select(*key, F.sha2("ids", 256).alias("ends_sha256"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest = None, None
        for pdf in batches:
            done = []
            for *k, ids in pdf[[*key, "ids"]].itertuples(index=False):
                if k != now:
                    done += [(*now, digest.hexdigest())] if now else []
                    now, digest = k, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield pd.DataFrame(done, columns=[*key, "ends_sha256"])
        if now:
            yield pd.DataFrame([(*now, digest.hexdigest())], columns=[*key, "ends_sha256"])

    many = pieces.join(some.filter("pieces > 1").select(*key), key, "left_semi")
    many = many.repartition(*key).sortWithinPartitions(*key, "at").mapInPandas(run, "depth long, k0 long, k1 long, k2 long, k3 long, ends_sha256 string")
    return single.unionByName(many)


def _forest_sums(chains: DataFrame) -> DataFrame:
    """Rows (conv_id, leaves, saved) summed over each chain and all below it; chains are rows (conv_id, up, leaves, saved)."""
    now = written(chains, "chains")
    while True:
        add = now.filter("up is not null").groupBy(F.col("up").alias("conv_id")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        above = joined_salted(now.filter("up is not null").select("up", "conv_id"), "up", "conv_id", now.select(F.col("conv_id").alias("up"), F.col("up").alias("up2"))).select("conv_id", F.col("up2").alias("up"))
        new = now.drop("up").join(add, "conv_id", "left").join(above, "conv_id", "left")
        new = written(new.select("conv_id", "up", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), "chains")
        discard(now)
        now = new
        if not now.filter("up is not null").limit(1).count():
            return now.drop("up")


def prefix_trie(convs: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of turns (conv_id, pos from 1, digest, n) of the conversations convs (conv_id): rows (conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    blocks = written(_blocks(convs, turns, block), "blocks")
    nodes = written(_nodes(blocks, block), "nodes")
    # A node and its neighbours on its own chain meet by (conversation, depth).
    near = nodes.select("conv_id", F.explode(F.array(*[F.struct((F.col("depth") + d).alias("depth"), F.lit(d).alias("what"), F.when(F.lit(d == 0), F.struct("n_convs", "n", *_KEY, "p0", "p1", "p2", "p3")).alias("node")) for d in (-1, 0, 1)])).alias("x"))
    near = near.groupBy("conv_id", "x.depth").agg(F.max("x.node").alias("node"), F.max(F.expr("x.what = -1")).alias("goes_on"), F.max(F.expr("x.what = 1")).alias("comes_on"))
    near = written(near.filter("node is not null").select("conv_id", "depth", "goes_on", "comes_on", "node.*"), "nodes")
    parent = F.struct((F.col("depth") - 1).alias("depth"), *[F.col(f"p{i}").alias(f"k{i}") for i in _LANES])
    tops = near.filter("not comes_on").select("conv_id", F.col("depth").alias("top"), parent.alias("parent"))
    tops = written(joined_salted(tops, "parent", "conv_id", nodes.select(F.struct("depth", *_KEY).alias("parent"), F.col("conv_id").alias("up")), "left").select("conv_id", "top", "up"), "tops")
    hung = tops.filter("up is not null").groupBy(F.col("up").alias("conv_id"), (F.col("top") - 1).alias("depth")).agg(F.count("*").alias("hung"))
    valued = near.join(hung, ["conv_id", "depth"], "left").join(tops.withColumnRenamed("top", "depth"), ["conv_id", "depth"], "left")
    valued = valued.select(
        "conv_id", "depth", F.when(F.col("comes_on"), F.col("conv_id")).otherwise(F.col("up")).alias("parent_conv_id"), "n_convs", *_KEY,
        (F.coalesce("hung", F.lit(0)) + F.col("goes_on").cast("long")).alias("n_children"), ((F.col("n_convs") - 1) * F.col("n")).alias("saved"),
    )
    valued = written(valued.withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")), "valued")
    chains = valued.groupBy("conv_id").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved")).join(tops.select("conv_id", "up"), "conv_id")
    full = _forest_sums(chains.select("conv_id", "up", "leaves", "saved"))
    below = tops.filter("up is not null").join(full, "conv_id").groupBy(F.col("up").alias("conv_id"), (F.col("top") - 1).alias("depth")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    here = valued.join(below, ["conv_id", "depth"], "left").withColumn("x", F.col("leaf") + F.coalesce("l", F.lit(0))).withColumn("y", F.col("saved") + F.coalesce("s", F.lit(0)))
    out = _running(here.drop("l", "s", "leaf", "saved"), "depth", {"n_leaves": "x", "saved_tokens": "y"}, desc=True)
    out = out.join(_ends(blocks, block), ["depth", *_KEY], "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of conversations as they are."""
    turns = ordered_turns(conversations)
    return prefix_trie(turns.select("conv_id").distinct(), turns, block)


def op11(spark, sf_dir: str) -> DataFrame:
    turns = ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie(*with_shared_heads(turns))
