"""Helpers shared by the operators of this package."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alvara.session import materialise, read_in_turn

__all__ = ["materialise", "table", "tidy", "fresh", "bucketed_rank"]

#: Rows of an Arrow batch.
ARROW_ROWS = 1_000
#: Rows that one numbering bucket holds on average.
BUCKET_ROWS = 50_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    read_in_turn(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tidy(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast to the named types; a missing one is null.

    Further columns, whatever their names, can then clash with nothing. Texts may be
    long, so Arrow batches get few rows from here on.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    read_in_turn(df.sparkSession)
    return df.select(*[
        (df[f"`{name}`"] if name in df.columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in kinds.items()
    ])


def fresh(name: str, taken: list[str]) -> str:
    """``name``, or ``name`` with underscores in front until no column has it."""
    lower = {column.lower() for column in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def bucketed_rank(
    df: DataFrame, group: list[str], order: list[str], name: str, deal: list[str] | None = None,
) -> DataFrame:
    """Add ``name``: the row's position from 0 within ``group``, gapless.

    A group of any size is numbered without meeting in one task: rows are dealt
    to buckets by a hash of ``deal`` (by default ``order``), numbered there, and moved up by the sizes
    of the buckets before. The order is that of (bucket, ``order``); equal rows
    share a number's neighbours in any order. The bucket sizes are a table of
    groups x buckets rows, summed up by a window.
    """
    from pyspark.sql import Window

    rows = df.count()
    buckets = max(1, math.ceil(rows / BUCKET_ROWS))
    bucket, inside, before = (fresh(x, df.columns) for x in ("bucket__", "inside__", "before__"))
    marked = df.withColumn(bucket, F.pmod(F.xxhash64(*(deal or order)), F.lit(buckets)).cast("int"))
    sizes = marked.groupBy(*group, bucket).count()
    up_to = Window.partitionBy(*group or [F.lit(0)]).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1)
    sizes = sizes.select(
        *group, bucket, F.coalesce(F.sum("count").over(up_to), F.lit(0)).alias(before))
    numbered = marked.withColumn(
        inside, F.row_number().over(Window.partitionBy(*group, bucket).orderBy(*order)) - 1)
    keys = [*group, bucket]
    return numbered.join(sizes, keys).withColumn(
        name, (F.col(inside) + F.col(before)).cast("long")).drop(bucket, inside, before)


def words(text: Column) -> Column:
    """The maximal runs of anything but space and U+0009 to U+000D; null: none."""
    return F.filter(
        F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
