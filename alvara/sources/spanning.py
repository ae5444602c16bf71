"""Records whose quoted values span lines, without reading a shard in one task.

Lines end at a line feed and nowhere else: what a value holds stays as it is, carriage
returns too. A line begins a record when an even number of quote characters precedes it in its
shard. Splits count their own quotes; a running sum over the few splits of a shard
tells each split whether it begins inside a value and how many records came before.
The count runs where the split is read, in the order of its lines. So only the lines of
spanning records are shuffled; all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A record longer than this is an unclosed quote, not data, and stops the scan.
RECORD_LIMIT = 2 << 20
SPLIT = ["path", "block"]


def odd_quotes(line: str | Column) -> Column:
    """1 when the line has an odd number of quote characters, else 0."""
    return (F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))) % 2


def without_return(line: str | Column) -> Column:
    """The line without the one carriage return that belongs to its end."""
    line = F.col(line) if isinstance(line, str) else line
    return F.when(F.endswith(line, F.lit("\r")), F.left(line, F.length(line) - 1)).otherwise(line)


def needs_joining(line: str) -> Column:
    """1 where a line is no whole record, or has a carriage return that ends no line."""
    inside = F.contains(without_return(line), F.lit("\r")).cast("int")
    return F.greatest(odd_quotes(line), inside)


def lines(spark: SparkSession, paths: Sequence[str], encoding: str) -> DataFrame:
    """Lines with their place: shard, first byte of the split, order in the split."""
    return spark.read.text(list(paths), lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        odd_quotes(F.col("value")).alias("odd"),
        F.decode(F.col("value").cast("binary"), encoding).alias("line"),
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to the lines of each split, in their order, whether an odd number of quotes
    precedes them, and how many records began so far, should the split begin inside a value
    (``begun_1``) or outside (``begun_0``)."""
    split, quotes, seen, inside = None, 0, 0, 0
    for batch in batches:
        blocks, odd = batch.column(SPLIT[1]).to_numpy(), batch.column("odd").to_numpy()
        paths = batch.column(SPLIT[0])
        at = 0
        inner, begun_0, begun_1 = (np.zeros(len(odd), np.int64) for _ in range(3))
        while at < len(odd):
            place = (paths[at].as_py(), blocks[at])
            # a task reads its splits one after the other
            same = np.flatnonzero(blocks[at:] != blocks[at])
            end = at + (int(same[0]) if len(same) else len(odd) - at)
            if paths[end - 1].as_py() != place[0]:  # two shards in the same block number
                end = at + 1 + next(k for k in range(end - at - 1) if paths[at + 1 + k].as_py() != place[0])
            if place != split:
                split, quotes, seen, inside = place, 0, 0, 0
            total = quotes + np.cumsum(odd[at:end])
            inner[at:end] = (total - odd[at:end]) % 2
            begun_1[at:end] = inside + np.cumsum(inner[at:end])
            begun_0[at:end] = seen + np.arange(1, end - at + 1) - begun_1[at:end]
            quotes, seen, inside = int(total[-1]), seen + end - at, int(begun_1[end - 1])
            at = end
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *map(pa.array, (inner, begun_1, begun_0))],
            [*batch.schema.names, "inner", "begun_1", "begun_0"])


def records(spark: SparkSession, paths: Sequence[str], encoding: str) -> DataFrame:
    """One row ``(file, record)`` per record of the shards, blank lines left out."""
    found = lines(spark, paths, encoding).withColumn("odd", F.col("odd").cast("long"))
    kinds = ", ".join(f"{name} {kind}" for name, kind in found.dtypes)
    counted = found.mapInArrow(_counted, f"{kinds}, inner long, begun_1 long, begun_0 long")
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    splits = (
        counted.groupBy(*SPLIT).agg(
            F.sum("odd").alias("odds"), F.max("begun_0").alias("n0"), F.max("begun_1").alias("n1")
        )
        .withColumn("inside", F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2)
        .withColumn("n", F.when(F.col("inside") == 0, F.col("n0")).otherwise(F.col("n1")))
        .withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .select(*SPLIT, "inside", "offset")
    )
    placed = counted.join(splits, SPLIT).withColumns({
        "begins": F.col("inner") == F.col("inside"),
        "number": F.col("offset") + F.when(F.col("inside") == 0, F.col("begun_0"))
        .otherwise(F.col("begun_1")),
    })
    alone = F.col("begins") & (F.col("odd") == 0)
    single = placed.where(alone & (F.trim(without_return("line")) != "")).select(
        "file", without_return("line").alias("record")
    )
    parts = placed.where(~alone)
    fits = (
        parts.groupBy("path", "number").agg(F.sum(F.length("line") + 1).alias("size"))
        .where(F.when(
            F.col("size") > RECORD_LIMIT,
            F.raise_error(F.concat(F.lit("unclosed quote in "), "path")).cast("boolean"),
        ).otherwise(True))
        .select("path", "number")
    )
    ordered = F.array_sort(F.collect_list(F.struct("block", "at", "line")))
    joined = parts.join(fits, ["path", "number"]).groupBy("path", "number").agg(
        F.max("file").alias("file"),
        F.array_join(F.transform(ordered, lambda part: part["line"]), "\n").alias("record"),
    )
    return single.unionByName(joined.select("file", without_return("record").alias("record")))
