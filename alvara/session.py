"""Session settings and the shared working folder every job relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Nothing in this package forces a broadcast. Spark broadcasts a side only when
# its estimated (or, under AQE, measured) size is below
# spark.sql.autoBroadcastJoinThreshold; beyond that the join is sort-merge, and
# the skew settings below split a hot key over many tasks.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the next join then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # A Bloom filter of the ids that passed the opening window, applied where the companies
    # and the flags are scanned. Spark judges the filtered side by the size of its files,
    # which the window cuts to a few percent, so its bound has to be that of the files; the
    # filter itself is bounded by its items (8 MB of bits).
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64t",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "67108864",
}

TARGET_PARTITION_BYTES = 128 << 20

#: Spark's own setting: an ended execution's shuffle files go at once, not at the driver's next
#: collection of garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Parquet's reader asks for all ranges of a row group at once. From local disks that goes through a
#: pool of threads, each of which keeps a buffer outside the heap as large as its largest range (a
#: whole column of a row group); in turn, in pieces on the heap, nothing is kept.
AT_ONCE = "parquet.hadoop.vectored.io.enabled"


#: What a task reads at most, in bytes of the files.
READ_BYTES = "spark.sql.files.maxPartitionBytes"


@contextmanager
def held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block; what was set before comes back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def read_in_turn(spark: SparkSession) -> None:
    """Parquet columns are read one after the other, from now on and for tables opened before too."""
    spark.conf.set(AT_ONCE, "false")


def tuned(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the settings; ``shuffle_bytes`` sizes the shuffles of a large run.

    The partition count only ever grows: AQE merges what turns out too small.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_bytes:
        wanted = -(-shuffle_bytes // TARGET_PARTITION_BYTES)
        current = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", str(max(current, wanted)))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor sees, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    missing setting is an error, since a lost executor would take the data along.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="alvara-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Used where several plans read one result: the lineage ends in Parquet, so
    later reads prune columns, push filters, and know the true size. The shuffle
    files behind it are not needed once it is written, so disks hold either them or
    the result's input, never those of all steps.
    """
    spark = df.sparkSession
    read_in_turn(spark)
    path = run_dir(spark, name)
    with held(spark, {DROP_SHUFFLES: "true"}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
