"""The weekly aggregate on disk: versions that map weeks to folders, switched by a ledger entry.

Each week of a version is a folder of its own. A version that only renews some weeks takes
over the folders of all others by reference: their files are neither read nor written.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from . import ledger

AGGREGATE = T.StructType([
    T.StructField("semana", T.DateType()),
    T.StructField("uf", T.StringType()),
    T.StructField("municipio_codigo", T.StringType()),
    T.StructField("municipio", T.StringType()),
    T.StructField("cnae_principal", T.StringType()),
    T.StructField("cnae_descricao", T.StringType()),
    T.StructField("contagem", T.LongType()),
    T.StructField("data_extracao", T.DateType()),
    T.StructField("semana_parcial", T.BooleanType()),
])

VERSIONS = T.StructType([
    T.StructField("ordem", T.LongType()), T.StructField("versao", T.StringType()),
    T.StructField("semanas", T.MapType(T.StringType(), T.StringType())),
])
#: Column that names a week's folder; files keep ``semana`` itself.
WEEK = "_w"
STORED_BY = ("semana", "uf", "cnae_principal", "municipio_codigo")


@dataclass(frozen=True)
class Openings:
    """Whole weeks of the aggregate, with the dates every cut needs."""

    cells: DataFrame
    extraction: dt.date
    month: dt.date

    @property
    def previous(self) -> dt.date:
        return dates.previous_month(self.month)

    def in_month(self, month: dt.date | None = None) -> DataFrame:
        return self.cells.where(dates.in_month("semana", month or self.month))

    def sql(self, query: str, **args) -> DataFrame:
        """Any SQL over the view ``agregados``; ``:name`` takes a parameter."""
        self.cells.createOrReplaceTempView("agregados")
        return self.cells.sparkSession.sql(query, args=args)


def whole_weeks(aggregate: DataFrame) -> DataFrame:
    return aggregate.where(~F.col("semana_parcial"))


def opened(aggregate: DataFrame, extraction: dt.date | None = None) -> Openings:
    """Hide partial weeks and find the last closed month.

    Without ``extraction`` one small job reads the newest date.
    """
    cells = whole_weeks(aggregate)
    if extraction is None:
        extraction = cells.agg(F.max("data_extracao")).first()[0]
        if extraction is None:
            raise ValueError("the aggregate has no whole week")
    return Openings(cells, extraction, dates.reference_month(extraction))


def sorted_for_storage(aggregate: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range partitions by week, state, sector; the city splits a heavy range."""
    keys = [F.col(name).asc_nulls_last() for name in STORED_BY]
    spread = (
        aggregate.repartitionByRange(partitions, *keys) if partitions
        else aggregate.repartitionByRange(*keys)
    )
    return spread.sortWithinPartitions(*keys)


def base(spark: SparkSession, root: str) -> int:
    """The number of the published version; 0 before the first."""
    return ledger.newest(spark, f"{root}/versions")


def _weeks(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Week to folder of the published version, or of version number ``version``."""
    records = ledger.read(spark, f"{root}/versions", VERSIONS, version)
    row = records.agg(F.max_by("semanas", "ordem").alias("semanas")).first()
    return row.semanas or {}


def _newest_only(records: DataFrame) -> DataFrame:
    """A version states all of its weeks, so earlier records are not needed."""
    return records.orderBy(F.col("ordem").desc()).limit(1)


def publish(aggregate: DataFrame, root: str, partitions: int | None = None,
            kept_before: dt.date | None = None, after: int | None = None) -> str:
    """Write a new version and then point readers to it; returns the version.

    The plan may read the previous version: nothing of it is overwritten. With
    ``kept_before`` the aggregate only has weeks from that one on; older ones are taken
    over from version number ``after`` (by default the published one) as they are. If
    another version was published after ``after``, nothing changes and ``ledger.Conflict``
    is raised.
    """
    spark = aggregate.sparkSession
    version = uuid.uuid4().hex[:12]
    folder = f"{root}/data/{version}"
    # The same order with the folder's name in front, which is what the writer asks for.
    ordered = sorted_for_storage(aggregate, partitions).withColumn(WEEK, F.col("semana").cast("string")) \
        .sortWithinPartitions(WEEK, *[F.col(name).asc_nulls_last() for name in STORED_BY[1:]])
    ordered.write.option("compression", "zstd").partitionBy(WEEK).parquet(folder)
    mine = [name for name in ledger.names(spark, folder) if name.startswith(f"{WEEK}=")]
    weeks = {name.partition("=")[2]: f"data/{version}/{name}" for name in mine}
    if kept_before is not None:
        limit = kept_before.isoformat()
        if early := [week for week in weeks if week < limit]:
            raise ValueError(f"weeks before {limit} are to be kept, but the aggregate has {min(early)}")
        after = base(spark, root) if after is None else after
        kept = {week: at for week, at in _weeks(spark, root, after).items() if week < limit} if after else {}
        weeks = {**kept, **weeks}
    while True:
        number = base(spark, root) if after is None else after
        try:
            ledger.append(spark, f"{root}/versions", VERSIONS, [(number + 1, version, weeks)], number, _newest_only)
            return version
        except ledger.Conflict:
            if after is not None:
                raise


def current(spark: SparkSession, root: str, since: dt.date | None = None,
            version: int | None = None) -> DataFrame | None:
    """The published aggregate (or version number ``version``), or None before the first.

    With ``since`` only the folders of that week and later ones are looked at.
    """
    if not (base(spark, root) if version is None else version):
        return None
    chosen = [f"{root}/{at}" for week, at in sorted(_weeks(spark, root, version).items())
              if since is None or week >= since.isoformat()]
    if not chosen:
        return spark.createDataFrame([], AGGREGATE)
    return spark.read.schema(AGGREGATE).parquet(*chosen)


def open_aggregate(spark: SparkSession, root: str) -> Openings:
    aggregate = current(spark, root)
    if aggregate is None:
        raise ValueError(f"no aggregate has been published under {root}")
    return opened(aggregate)


def summary(aggregate: DataFrame) -> DataFrame:
    """Rows and weeks of an aggregate.

    Weeks are counted after a ``groupBy`` so that the distinct values, not the
    cells, are what gets shuffled.
    """
    per_week = aggregate.groupBy("semana").agg(F.count(F.lit(1)).alias("n"))
    return per_week.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("linhas"),
        F.count("semana").cast("long").alias("semanas"),
    )


def stored_bytes(aggregate: DataFrame) -> DataFrame:
    """Size on disk of the files behind an aggregate read from Parquet."""
    files = aggregate.select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")
    ).groupBy("f").agg(F.max("b").alias("b"))
    return files.agg(F.coalesce(F.sum("b"), F.lit(0)).cast("long").alias("bytes"))
