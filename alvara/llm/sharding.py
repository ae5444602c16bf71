"""Sharding by balanced label propagation.

Documents start in shards by a hash. Links are given as memberships: documents with the
same key are linked (here: equal texts), as a hub would link them, so a group of any
size needs no pairs. In each round the members of every key are counted by shard, and a
document moves to the shard that holds most of its neighbours; of equals a hash of key and
round decides. Between two shards as many may swap as want to go each way; beyond that a
shard takes no more than its quota and a slack leave free. Where more ask, an equal share of them, by
a hash, may move. Rounds go on until ``PATIENCE`` of them in a row have not lowered the cut
links. Documents without links, and what is beyond a quota, group by group, are put where
room is left. In the end all quotas are met exactly: row counts differ by one at most.

Counts by key and shard are summed before they are shuffled, and a key with a third of
all rows is split by the skewed join. Only shard totals reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucketed_rank, materialise, table, tidy

SHARDS = 8
PATIENCE = 2
#: Share of its quota that a shard may hold beyond it until the last step, which moves whole groups.
SLACK = 0.25
#: Groups of more rows are put into the last free places in parts of about so many.
PART_ROWS = 1_000
SEED = 42


def _loads(rows: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["count"] for r in rows.groupBy("shard").count().collect()}
    return [found.get(s, 0) for s in range(shards)]


def _by_shard(values: list[float]):
    """The value of the row's shard, from a literal map with an entry for each shard."""
    return F.create_map(*[F.lit(x) for s, v in enumerate(values) for x in (s, v)])


def _allowed(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many of the ``wanted`` moves (from, to) may be made: swaps, and what room is left for."""
    out = {(s, t): min(n, wanted.get((t, s), 0)) for (s, t), n in wanted.items()}
    for t, free in enumerate(room):
        over = {at: n - out[at] for at, n in wanted.items() if at[1] == t}
        more = sum(over.values())
        for at, n in over.items():
            out[at] += n if more <= free else n * free // more
    return out


def _round(linked: DataFrame, quota: list[int], number: int) -> tuple[DataFrame, int, bool]:
    """One round of moves; the new rows, the links cut before it, and whether any row moves."""
    shards = len(quota)
    room = [max(0, q + int(SLACK * q) - n) for q, n in zip(quota, _loads(linked, shards))]
    cells = linked.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("held"))
    chosen = F.struct("held", F.xxhash64("key", "shard", F.lit(number), F.lit(SEED)).alias("by"), "shard")
    # best place, and what all shards hold
    around = materialise(cells.groupBy("key").agg(F.sum("held").alias("all"), F.max(chosen).alias("best")), "around")
    cut = around.agg(F.sum(F.col("all") - F.col("best.held"))).first()[0] or 0
    asked = linked.join(around.select("key", F.col("best.shard").alias("to")), "key").withColumn(
        "to", F.when(F.col("to") != F.col("shard"), F.col("to")))
    asked = materialise(asked, "asked")
    wanted = {(r["shard"], r["to"]): r["count"] for r in asked.where("to is not null").groupBy("shard", "to").count().collect()}
    allowed = _allowed(wanted, room)
    if not any(allowed.values()):
        return linked, cut, False
    share = [0.0] * (shards * shards)
    for (s, t), n in allowed.items():
        share[s * shards + t] = n / wanted[s, t]
    chance = F.pmod(F.xxhash64("doc_id", "key", F.lit(number), F.lit(SEED)), F.lit(1 << 20)) / float(1 << 20)
    moves = F.col("to").isNotNull() & (chance < _by_shard(share)[F.col("shard") * shards + F.col("to")])
    moved = asked.withColumn("shard", F.when(moves, F.col("to")).otherwise(F.col("shard"))).select(linked.columns)
    return materialise(moved, "moved"), cut, True


def label_propagation(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """(doc_id, size, crc, key, shard, slot) for rows (doc_id, size, crc, key).

    Rows with the same non-null ``key`` are linked; a null key links with nothing.
    ``slot`` counts from 0 within a shard without gaps. Repeated rows are rows of their
    own. An empty table gives an empty result. ``rounds``, if given, is the most there are.
    """
    docs = materialise(docs, "nodes")
    total = docs.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    groups = docs.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = materialise(groups, "groups")
    # neighbours start apart, so that the first round is decided by chance and not by order
    start = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(shards)).cast("int")
    linked = materialise(docs.join(groups, "key").select(
        "doc_id", "size", "crc", "key", start.alias("shard"),
        F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / PART_ROWS)).alias("part")), "linked")
    alone = docs.join(groups, "key", "left_anti").select(
        "doc_id", "size", "crc", "key", F.xxhash64("doc_id").alias("part"))
    number, least, idle, go = 0, None, 0, True
    while go and idle < PATIENCE and (rounds is None or number < rounds):
        linked, cut, go = _round(linked, quota, number)
        idle = 0 if least is None or cut < least else idle + 1
        least, number = cut if least is None else min(cut, least), number + 1
    # the parts of a group stay together where a shard has more rows than its quota
    ranked = materialise(bucketed_rank(linked, ["shard"], ["key", "doc_id"], "slot", ["key", "part"]), "ranked")
    fits = F.col("slot") < _by_shard(quota)[F.col("shard")]
    held = [min(q, n) for q, n in zip(quota, _loads(linked, shards))]
    # what is left fills the shards' free places from the first on
    rest = ranked.where(~fits).select(*alone.columns).unionByName(alone)
    rest = bucketed_rank(rest, [], ["key", "doc_id"], "number", ["key", "part"])
    shard, slot, start_at = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        free = quota[s] - held[s]
        inside = (F.col("number") >= start_at) & (F.col("number") < start_at + free)
        shard = F.when(inside, s).otherwise(shard)
        slot = F.when(inside, F.col("number") - start_at + held[s]).otherwise(slot)
        start_at += free
    columns = ["doc_id", "size", "crc", "key"]
    return ranked.where(fits).select(*columns, "shard", "slot").unionByName(
        rest.select(*columns, shard.cast("int").alias("shard"), slot.cast("long").alias("slot")))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """Shards of documents (doc_id, text), linked where their texts are equal.

    ``size``: UTF-8 bytes plus 1. A null text has no bytes, is linked with nothing, and
    has checksum 0, as the empty text has; empty texts are equal texts.
    """
    rows = tidy(docs, doc_id="long", text="string").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("crc"),
        F.unhex(F.sha2("text", 256)).alias("key"))
    return label_propagation(rows, shards, rounds)


def cut_links(sharded: DataFrame) -> DataFrame:
    """(links, cut): members beyond the first of each key, and those apart from its largest part."""
    cells = sharded.where("key is not null").groupBy("key", "shard").agg(F.count(F.lit(1)).alias("n"))
    keys = cells.groupBy("key").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    return keys.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("links"),
        F.coalesce(F.sum(F.col("n") - F.col("most")), F.lit(0)).alias("cut"))


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents")).select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
