"""The monthly run: stage, select, check, aggregate, merge, publish."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.companies import ALLOWED_COLUMNS, new_companies
from ..operators.weekly import first_week, merge_extractions, weekly_aggregate
from ..session import tuned
from ..sources import aggregate_store, ledger, manifest, registry_csv
from ..sources.layout import layout_for


@dataclass(frozen=True)
class Places:
    """Folders of one registry; all of them are shared by the executors."""

    archives: str
    raw: str
    work: str
    aggregate: str

    def companies(self, extraction: str) -> str:
        return f"{self.work}/new_companies/extracao={extraction}"

    def report(self, extraction: str) -> str:
        return f"{self.work}/report/extracao={extraction}"


def file_rules(spark: SparkSession, places: Places, extraction: str,
               verify_hashes: bool = False) -> list[DataFrame]:
    """Rules about archives and shards; they hold before anything is staged.

    Only listings and the manifest are read, and with ``verify_hashes`` the archives. The width of the rows is left to the
    staging, which parses everything once and stops at the first wrong row.
    """
    layout = layout_for(extraction)
    folder = f"{places.archives}/{extraction}"
    try:
        recorded = manifest.read(spark, f"{folder}/manifest.json")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return [quality.missing_manifest(spark, f"{folder}/manifest.json")]
    present = manifest.listing(spark, folder)
    expected = spark.createDataFrame([(n,) for n in layout.archives], "nome string")
    forbidden = spark.createDataFrame([(n,) for n in layout.forbidden], "nome string")
    return [
        quality.complete_load(expected, recorded, present),
        quality.forbidden_files(present, forbidden, "on disk"),
        quality.forbidden_files(recorded, forbidden, "in the manifest"),
        *[
            quality.shard_count(spark, f"{places.raw}/{extraction}/{table}", table, layout)
            for table in layout.tables
        ],
        *([quality.archive_hashes(recorded, manifest.hashed_listing(spark, folder))]
          if verify_hashes else []),
    ]


def control_rules(spark: SparkSession, places: Places, extraction: str) -> DataFrame:
    """Replaced control characters of every shard that has any, as staging counted them."""
    facts = registry_csv.shard_facts(spark, f"{places.work}/staging", extraction)
    return quality.control_rules(facts.where("trocados > 0").select(
        F.col("arquivo").alias("file"), F.col("trocados").alias("replaced")))


def write_companies(raw: Mapping[str, DataFrame], extraction: dt.date, target: str,
                    include_branches: bool = False) -> DataFrame:
    """The new companies as Parquet, read back with their own schema."""
    found = new_companies(raw, extraction, include_branches)
    found.write.mode("overwrite").option("compression", "zstd").parquet(target)
    spark = found.sparkSession
    return spark.read.schema(found.schema).parquet(target).select(*ALLOWED_COLUMNS)


def publish_month(spark: SparkSession, weekly: DataFrame, day: dt.date, root: str,
                  left_edge: str = "replace", attempts: int = 5) -> str:
    """Merge one extraction's weeks into the published aggregate.

    Only weeks that the extraction's window reaches are read, merged and written; a
    version that somebody else publishes meanwhile makes the merge start over from it.
    """
    first = first_week(day)
    for attempt in range(attempts):
        base = aggregate_store.base(spark, root)
        touched = aggregate_store.current(spark, root, since=first, version=base)
        try:
            return aggregate_store.publish(
                merge_extractions(weekly, touched, left_edge), root, kept_before=first, after=base)
        except ledger.Conflict:
            if attempt + 1 == attempts:
                raise
    raise ValueError("attempts has to be positive")


def run_month(spark: SparkSession, places: Places, extraction: str,
              include_branches: bool = False, left_edge: str = "replace",
              bounds: tuple[int, int] = quality.MONTHLY_BOUNDS,
              shuffle_bytes: int | None = None, verify_hashes: bool = False) -> str:
    """One extraction from shards to a published aggregate version.

    File rules gate the staging and data rules gate the aggregate: whatever
    fails, the published version stays as it was. The data rules, the control
    characters of each shard and the size of the new version are stored as a report.
    """
    tuned(spark, shuffle_bytes)
    for rules in file_rules(spark, places, extraction, verify_hashes):
        quality.enforce(rules)
    try:
        raw = registry_csv.stage(spark, places.raw, f"{places.work}/staging", extraction)
    except registry_csv.CrookedRows as error:
        quality.enforce(quality.crooked_rows(spark, error.shards))
        raise
    day = registry_csv.extraction_date(spark, f"{places.raw}/{extraction}", extraction)
    companies = write_companies(raw, day, places.companies(extraction), include_branches)
    report = places.report(extraction)
    quality.report(
        companies, raw, day, [control_rules(spark, places, extraction)], bounds=bounds
    ).write.mode("overwrite").parquet(report)
    quality.enforce(spark.read.parquet(report))
    version = publish_month(spark, weekly_aggregate(companies, day), day, places.aggregate, left_edge)
    size = aggregate_store.stored_bytes(aggregate_store.current(spark, places.aggregate))
    quality.aggregate_size(size).write.mode("append").parquet(report)
    return version
