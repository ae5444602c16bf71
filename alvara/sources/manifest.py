"""The manifest of a dump: which archives it has, their sizes and hashes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = T.StructType([
    T.StructField("extracao", T.StringType()),
    T.StructField("base_url", T.StringType()),
    T.StructField("arquivos", T.ArrayType(T.StructType([
        T.StructField("nome", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("sha256", T.StringType()),
    ]))),
    T.StructField("total_bytes", T.LongType()),
])

#: Bytes of an archive that a task holds while hashing it.
HASH_CHUNK = 16 << 20


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per archive: ``nome, bytes, sha256``."""
    manifest = spark.read.schema(MANIFEST).option("multiLine", "true").json(path)
    return manifest.select(F.explode("arquivos").alias("a")).select("a.nome", "a.bytes", "a.sha256")


def listing(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """Archives in a folder: ``nome, bytes``. Contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("nome"), F.col("length").alias("bytes")
    )


def _hashes(chunk: int):
    """SHA-256 of whole files, read in pieces: a row could not hold a large archive."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                system, name = FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
                digest = hashlib.sha256()
                with system.open_input_stream(name, buffer_size=0) as stream:
                    while part := stream.read(chunk):
                        digest.update(part)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string())], ["path", "bytes", "sha256"])
    return run


def hashed_listing(spark: SparkSession, path: str, glob: str = "*.zip",
                   chunk: int = HASH_CHUNK) -> DataFrame:
    """The same with SHA-256 of every file, whatever its size, one task for each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    listed = files.select("path", F.col("length").alias("bytes"))
    spread = listed.repartition(max(1, listed.count()), "path")
    hashed = spread.mapInArrow(_hashes(chunk), "path string, bytes long, sha256 string")
    return hashed.select(F.element_at(F.split("path", "/"), -1).alias("nome"), "bytes", "sha256")


def build(files: DataFrame, extraction: str, base_url: str) -> DataFrame:
    """The one-row manifest of a hashed listing (one entry per archive on disk)."""
    entry = F.struct("nome", "bytes", "sha256")
    return files.agg(
        F.array_sort(F.collect_list(entry)).alias("arquivos"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("total_bytes"),
    ).select(
        F.lit(extraction).alias("extracao"), F.lit(base_url).alias("base_url"),
        "arquivos", "total_bytes",
    )
