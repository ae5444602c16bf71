"""SimHash near-duplicates by exact tiled comparison.

Fingerprints are computed in Arrow batches. Equal ones are folded; the distinct ones
are cut into tiles of one population count each. Two fingerprints that differ in at
most r bits have population counts that differ by at most r, so only tile pairs whose
counts are that close meet, and inside a pair the same test on the two halves of the
fingerprint skips most blocks. The rest is numpy exclusive-or and bit counts, without
buckets that could miss a pair. A tile pair gives back a spanning forest of its links,
never the links themselves.

The work of comparing all is quadratic in the number of distinct fingerprints; that is
the price of exactness by this method (see README).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, materialise, table, tidy
from .components import components, forest

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints in a tile, on average.
TILE = 16_384
#: Rows of one side that are compared with the other side at once.
BLOCK = 32


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included; no word: 0.

    Upper-case A-Z count as lower case. Fewer words than a shingle: one of them all.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = (ends - [len(p) + 1 for p in parts]).tolist()
    ends = (ends - 1).tolist()[shingle - 1:] or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(ends))
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):  # a long text in bounded memory
        part = hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column(1)),
                np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])
    return run


def near(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> np.ndarray:
    """Roots over ``a`` followed by ``b`` (once if ``same``) linked within ``radius`` bits."""
    n = len(a)
    root = np.arange(n if same else n + len(b))
    shift = 0 if same else n
    low = np.uint64(0xFFFFFFFF)
    half_a, half_b = np.bitwise_count(a & low), np.bitwise_count(b & low)
    high_a, high_b = np.bitwise_count(a) - half_a, np.bitwise_count(b) - half_b
    order_a, order_b = (np.lexsort((h, l)) for h, l in ((high_a, half_a), (high_b, half_b)))
    key_b = half_b[order_b].astype(np.int64)
    for at in range(0, n, BLOCK):
        rows = order_a[at:at + BLOCK]
        least, most = int(half_a[rows].min()) - radius, int(half_a[rows].max()) + radius
        lo, hi = np.searchsorted(key_b, least), np.searchsorted(key_b, most, "right")
        cols = order_b[lo:hi]
        if not len(cols):
            continue
        close = np.bitwise_count(a[rows][:, None] ^ b[cols][None, :]) <= radius
        i, j = np.nonzero(close)
        i, j = rows[i], cols[j] + shift
        keep = i != j
        root = forest(len(root), i[keep], j[keep], root)
    return root


def _compare(radius: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        upper = group["upper"].to_numpy()
        fp = group["fp"].to_numpy(np.int64).view(np.uint64)
        a, b = fp[~upper], fp[upper]
        first = group.iloc[0]
        same = bool(first["d"] == 0 and first["i"] == first["j"])
        root = near(a, a if same else b, radius, same)
        both = (a if same else np.concatenate([a, b])).view(np.int64)
        linked = root != np.arange(len(root))
        return pd.DataFrame({"a": both[root[linked]], "b": both[linked]})
    return run


def near_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) spanning all distinct ``fp`` that lie within ``radius`` bits of another.

    ``prints``: one row for each distinct fingerprint. Its rows are counted for each of
    the 65 population counts, which fixes how many tiles each count is cut into.
    """
    spark = prints.sparkSession
    counted = prints.withColumn("pop", F.bit_count("fp").cast("int"))
    tiles = {r["pop"]: max(1, -(-r["count"] // tile)) for r in counted.groupBy("pop").count().collect()}
    if not tiles:
        return spark.createDataFrame([], "a long, b long")
    number = F.create_map(*[F.lit(x) for p, n in tiles.items() for x in (p, n)])
    dealt = counted.withColumn("chunk", F.pmod(F.xxhash64("fp"), number[F.col("pop")]).cast("int"))
    dealt = dealt.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(radius))))
    lower = dealt.withColumn("others", number[F.col("pop") + F.col("d")]).where("others is not null").select(
        "fp", F.lit(False).alias("upper"), F.col("pop").alias("p"), "d", F.col("chunk").alias("i"),
        F.explode(F.expr("sequence(if(d = 0, chunk, 0), others - 1)")).alias("j"))
    upper = dealt.withColumn("others", F.when(F.col("d") == 0, F.col("chunk")).otherwise(
        number[F.col("pop") - F.col("d")])).where("others > 0").select(
        "fp", F.lit(True).alias("upper"), (F.col("pop") - F.col("d")).alias("p"), "d",
        F.explode(F.expr("sequence(0, others - 1)")).alias("i"), F.col("chunk").alias("j"))
    return (
        lower.unionByName(upper)
        .groupBy("p", "d", "i", "j")
        .applyInPandas(_compare(radius), "a long, b long")
    )


def simhash_groups(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that can be reached over links, so one row
    of a group may stay. Null and empty texts have no word, hence fingerprint zero, and
    link with each other and with what lies near zero. Repeated rows each get a row.
    Rows without doc_id belong to the group of their fingerprint; a group of only such
    rows has no id. An empty table gives an empty result. Other columns are ignored.
    """
    prints = materialise(
        tidy(docs, doc_id="long", text="string").mapInArrow(_fingerprints(shingle), "doc_id long, fp long"),
        "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    member = components(near_links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    named = distinct.join(member, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = materialise(named, "named")
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return prints.join(named.join(smallest, "component").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id")


def keep_smallest(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``groups`` (doc_id, component_id) names as its group's smallest.

    Of several rows with that doc_id one stays. Rows without doc_id always stay. Texts
    are only shuffled where the ids to be dropped are too many to be broadcast.
    """
    ids = materialise(groups.groupBy("doc_id").agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count(F.lit(1)).alias("n")), "ids")
    once = docs.join(materialise(ids.where("not stays or n > 1").select("doc_id"), "other_ids"), "doc_id", "left_anti")
    several = materialise(ids.where("stays and n > 1").select("doc_id"), "repeated_ids")
    return once.select(docs.columns).unionByName(
        docs.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns))


def one_of_each(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group, all columns (``keep_smallest``)."""
    return keep_smallest(docs, simhash_groups(docs.where("doc_id is not null"), radius, shingle))


def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash_groups(table(spark, folder, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
