"""Mixing sources to target weights by temperature, in DataFrame code only.

Shares p of the sources' tokens become weights p^a / sum p^a. The exponent a in [0, 1]
is bisected: the smallest (most even) one whose largest repetition stays within a limit,
or the largest one that reaches a target entropy. Each step is one aggregate over the
table of sources. The budget is set so that the source repeated least is seen exactly
once; no document is lost. A source's quota is whole epochs and a part of one more: the
documents that come first in the order of a hash, as long as their tokens fit.

Every epoch of a source is a permutation by a hash. The position of a document in its
source's sequence, as a share of the quota, names the block it goes to, so each block
holds every source at its weight; inside a block another hash permutes. Running sums
are taken within hash buckets and moved up by the sums of the buckets before, so that a
source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BUCKET_ROWS, fresh, materialise, table, tidy, words

REPEAT = 1.5
BLOCK_TOKENS = 1_000_000
SEED = 42
STEPS = 16


def _order(doc_id: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(doc_id, epoch.cast("int"), F.lit(seed))


def _source(source: Column) -> Column:
    return F.coalesce(source.cast("string"), F.lit(""))


def _size(text: Column) -> Column:
    return F.greatest(F.size(words(text)), F.lit(1)).cast("long")


def exponent(shares: DataFrame, repeat: float | None = REPEAT, entropy: float | None = None) -> float:
    """The bisected exponent over ``shares`` (p).

    With ``entropy`` (nats) it is the largest whose weights have at least that entropy,
    0 if none has; otherwise the smallest whose largest repetition is at most ``repeat``.
    """
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        a = (low + high) / 2
        w = F.pow("p", F.lit(a))
        got = shares.agg(
            (F.max(w / F.col("p")) / F.min(w / F.col("p"))).alias("repeat"),
            (F.log(F.sum(w)) - a * F.sum(w * F.log("p")) / F.sum(w)).alias("entropy")).collect()[0]
        if got["repeat"] is None:
            return 1.0
        if entropy is not None:
            low, high = (a, high) if got["entropy"] >= entropy else (low, a)
        else:
            low, high = (low, a) if got["repeat"] <= repeat else (a, high)
    return low if entropy is not None else high


def quotas(sizes: DataFrame, repeat: float | None = REPEAT, entropy: float | None = None) -> DataFrame:
    """(source, tokens, weight, epochs, part) for ``sizes`` (source, tokens): every document
    is seen ``epochs`` times, and of one more epoch ``part`` of the tokens."""
    everything = Window.partitionBy(F.lit(0))  # a row for each source
    shares = materialise(sizes.groupBy("source").agg(F.sum("tokens").alias("tokens")).withColumn(
        "p", F.col("tokens") / F.sum("tokens").over(everything)), "shares")
    a = exponent(shares, repeat, entropy)
    raw = shares.withColumn("w", F.pow("p", F.lit(a)))
    least = raw.agg(F.sum("w").alias("all"), F.min(F.col("w") / F.col("p")).alias("least"))
    seen = F.col("w") / F.col("p") / F.col("least")
    return materialise(
        raw.join(least).select(
            "source", "tokens", (F.col("w") / F.col("all")).alias("weight"),
            F.floor(seen + 1e-9).cast("int").alias("epochs"),
            F.greatest(seen - F.floor(seen + 1e-9), F.lit(0.0)).alias("part")), "quotas")


def _running(rows: DataFrame, name: str) -> DataFrame:
    """Add ``name``: tokens of the rows of the same source and epoch up to this ``key``."""
    buckets = max(1, math.ceil(rows.count() / BUCKET_ROWS))
    # the hash is spread evenly: equal steps of it are buckets of about equal size
    marked = rows.withColumn("bucket", F.floor((F.col("key").cast("double") / 2.0 ** 64 + 0.5) * buckets).cast("int"))
    group = ["source", "epoch"]
    sums = marked.groupBy(*group, "bucket").agg(F.sum("tokens").alias("held"))
    before = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, "bucket", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*group, "bucket").orderBy("key")
    marked = marked.withColumn("inside", F.sum("tokens").over(inside))
    return marked.join(sums, [*group, "bucket"]).withColumn(
        name, F.col("before") + F.col("inside")).drop("bucket", "inside", "before")


def plan(
    docs: DataFrame, repeat: float | None = REPEAT, entropy: float | None = None, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The mixture as rows (doc_id, source, tokens, epoch, key, upto), and the quotas.

    ``docs``: doc_id, text, source. A token is a word; a text without any counts as one.
    A null source is the source ''. Equal doc_ids of one source share their ``key`` and
    are taken or left together in the last epoch. Empty tables give empty results.
    """
    slim = materialise(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"), _source(docs["source"]).alias("source"),
            _size(docs["text"].cast("string")).alias("tokens")), "sizes")
    quota = quotas(slim, repeat, entropy)
    seen = slim.join(quota.select("source", "epochs", "part", F.col("tokens").alias("all")), "source")
    rows = seen.withColumn(
        "epoch", F.explode(F.sequence(F.lit(1), F.col("epochs") + F.when(F.col("part") > 0, 1).otherwise(0))))
    rows = rows.withColumn("key", _order(F.col("doc_id"), F.col("epoch"), seed))
    rows = materialise(_running(rows, "upto").where(
        "epoch <= epochs or upto <= part * all"), "mixture")
    return rows, quota


def blocks(rows: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """Add ``block`` and ``place``: a position in the permuted sequence of blocks."""
    total = rows.agg(F.sum("tokens")).collect()[0][0] or 0
    n = max(1, math.ceil(total / block_tokens))
    start = F.col("upto") - F.col("tokens") + (F.col("epoch") - 1) * F.col("all")
    length = F.col("all") * (F.col("epochs") + F.col("part"))
    put = rows.withColumn("block", F.least(F.floor(start / length * n), F.lit(n - 1)).cast("long"))
    inside = Window.partitionBy("block").orderBy(F.xxhash64("key", F.lit(seed)), "source", "doc_id", "epoch")
    return put.withColumn("place", (F.row_number().over(inside) - 1).cast("long"))


def mixed(docs: DataFrame, repeat: float | None = REPEAT, entropy: float | None = None, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` as often as the mixture has them, all columns.

    Only ids and sizes are shuffled: the last epoch of a source ends at a value of its
    hash, so each row is decided where it is read. Clashing column names do no harm.
    """
    rows, quota = plan(docs, repeat, entropy, seed)
    ends = rows.where("epoch > epochs").groupBy("source").agg(F.max("key").alias("last"))
    quota = materialise(quota.join(ends, "source", "left"), "ends").select(
        F.struct("source", "epochs", "last").alias("quota"))
    own = docs.columns
    row = fresh("row__", own)
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in own]).alias(row))
    joined = packed.join(quota, F.col("quota.source") == _source(F.col(f"{row}.source")))
    last = _order(F.col(f"{row}.doc_id").cast("long"), F.col("quota.epochs") + 1, seed)
    times = F.col("quota.epochs") + F.when(last <= F.col("quota.last"), 1).otherwise(0)
    return joined.select(row, F.explode(F.sequence(F.lit(1), times))).select(f"{row}.*")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows, quota = plan(table(spark, folder, "documents"))
    return blocks(rows).join(quota.select("source", "weight"), "source").select(
        "doc_id", "source", "tokens", "epoch", "block", "place", "weight")
