"""Reading the raw shards: strict, all text, without giving up parallel splits."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..session import DROP_SHUFFLES, READ_BYTES, held
from . import ledger, spanning
from .layout import Layout, TableLayout, layout_for

BAD_ROW = "_bad_row"
SOURCE_FILE = "_file"
#: What staging notes of a row besides its columns.
REPLACED, JOINED = "_replaced", "_joined"
#: Shards that are packed: a task reads a whole one, and they grow to some ten times their bytes.
PACKED = ".gz"
#: Bytes of packed shards, or of staged files, that a task sorts in memory.
SORTED_BYTES = "16m"
FILE_DATE = r"\.D(\d)(\d{2})(\d{2})\."


def unbalanced_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Per shard, the number of lines that are no whole record or hold a carriage return.

    When it is zero every record ends at its line end, and Spark may split the
    shard at any line. Otherwise a quoted value spans lines.
    """
    lines = spark.read.option("pathGlobFilter", glob).text(path, lineSep="\n")
    return (
        lines.select(
            F.col("_metadata.file_path").alias("file"), spanning.needs_joining("value").alias("odd")
        )
        .groupBy("file").agg(F.sum("odd").cast("long").alias("odd_lines"))
    )


def _joined(spark: SparkSession, files: list[str], schema: T.StructType, options: dict) -> DataFrame:
    """Rows of shards with values that span lines, and their file."""
    found = spanning.records(spark, files, options["encoding"])
    parsed = F.from_csv("record", schema.toDDL(), options)
    return found.select(parsed.alias("_row"), F.col("file").alias(SOURCE_FILE)).select("_row.*", SOURCE_FILE)


def _with_bad(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD_ROW, T.StringType())])


def scan(spark: SparkSession, path: str, table: str, layout: Layout,
         mode: str = "FAILFAST", keep_bad: bool = False) -> DataFrame:
    """All shards of one table as text, control characters replaced by ``?``.

    A first look at the quotes tells which shards have values that span lines;
    their names are all that comes to the driver. Both kinds are read in splits.
    In mode FAILFAST a row of the wrong width stops the scan.
    """
    spec = layout.tables[table]
    options = dict(layout.csv, mode=mode)
    schema = spec.schema
    if keep_bad:
        options["columnNameOfCorruptRecord"] = BAD_ROW
        schema = _with_bad(schema)

    even, odd = [], []
    for row in unbalanced_files(spark, path, spec.glob).toLocalIterator():
        (odd if row.odd_lines else even).append(row.file)

    parts = []
    if even or not odd:
        reader = spark.read.schema(schema).options(**options, columnPruning="false")
        plain = reader.option("pathGlobFilter", spec.glob).csv(even if odd else path)
        # File metadata is only known directly above the read, not above a union.
        parts.append(plain.select("*", F.col("_metadata.file_name").alias(SOURCE_FILE)))
    if odd:
        parts.append(_joined(spark, odd, schema, options))
    raw = reduce(DataFrame.unionByName, parts)
    cleaned = [text.scrub_controls(name).alias(name) for name in spec.columns]
    if keep_bad:
        cleaned += [F.col(BAD_ROW), F.col(SOURCE_FILE)]
    return raw.select(*cleaned)


def control_counts(raw: DataFrame, columns: list[str], source: Column) -> DataFrame:
    """Replaced characters per source file; files without any are left out."""
    per_row = sum((text.count_controls(name) for name in columns), F.lit(0))
    return (
        raw.select(source.alias("file"), per_row.alias("n"))
        .groupBy("file").agg(F.sum("n").cast("long").alias("replaced"))
        .where("replaced > 0")
    )


def raw_control_counts(spark: SparkSession, path: str, table: str, layout: Layout) -> DataFrame:
    """The same, from the raw lines of one table's shards: rows of any width count."""
    spec = layout.tables[table]
    lines = spark.read.option("pathGlobFilter", spec.glob).text(path, lineSep="\n")
    raw = lines.select(F.decode(F.col("value").cast("binary"), layout.csv["encoding"]).alias("line"),
                       F.col("_metadata.file_name").alias("file"))
    return control_counts(raw, ["line"], F.col("file"))


def extraction_dates(files: DataFrame) -> DataFrame:
    """Add ``data_extracao`` and ``problema`` to rows of ``(arquivo, extracao)``.

    A file name holds the last digit of the year, the month and the day. It has
    to agree with the ``YYYY-MM`` the file is filed under.
    """
    digit, month, day = (F.regexp_extract("arquivo", FILE_DATE, i) for i in (1, 2, 3))
    year = F.substring("extracao", 1, 4)
    parsed = F.try_to_date(F.concat(year, month, day), "yyyyMMdd")
    problem = (
        F.when(digit == "", "no date in the name")
        .when(F.substring(year, 4, 1) != digit, "year differs from the folder")
        .when(parsed.isNull(), "not a calendar date")
        .when(F.date_format(parsed, "yyyy-MM") != F.col("extracao"), "outside the month")
    )
    return files.withColumn("problema", problem).withColumn(
        "data_extracao", F.when(F.col("problema").isNull(), parsed)
    )


def extraction_date(spark: SparkSession, path: str, extraction: str) -> dt.date:
    """The dump's own date, from the name of the sector file under ``path``."""
    glob = layout_for(extraction).tables["cnaes"].glob
    names = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob)
        .load(f"{path}/cnaes").select("path")
    )
    files = names.select(
        F.element_at(F.split("path", "/"), -1).alias("arquivo"),
        F.lit(extraction).alias("extracao"),
    )
    row = extraction_dates(files).orderBy("arquivo").first()
    if row is None:
        raise ValueError(f"no sector file under {path}/cnaes")
    if row.problema:
        raise ValueError(f"{row.arquivo}: {row.problema}")
    return row.data_extracao


def in_common(rows: DataFrame, spec: TableLayout, columns: Sequence[str]) -> DataFrame:
    """Rows of one layout with the named columns; one that the layout lacks is NULL."""
    own = {common: name for name, common in spec.renamed}
    present = {own.get(name, name): name for name in columns}
    return rows.select(*[
        (F.col(source) if source in rows.columns else F.lit(None).cast("string")).alias(name)
        for source, name in present.items()
    ])


def scan_history(spark: SparkSession, raw_root: str, table: str, layouts: Mapping[str, Layout] | Sequence[str],
                 columns: Sequence[str]) -> DataFrame:
    """One table of several extractions as one relation: ``extracao`` and ``columns``.

    ``layouts``: extractions, or extractions with their layouts. Each dump is read by the
    layout of its time, whose columns are brought to common names.
    """
    if not isinstance(layouts, Mapping):
        layouts = {extraction: layout_for(extraction) for extraction in layouts}
    parts = []
    for extraction, layout in layouts.items():
        rows = in_common(scan(spark, f"{raw_root}/{extraction}/{table}", table, layout), layout.tables[table], columns)
        parts.append(rows.select(F.lit(extraction).alias("extracao"), *columns))
    return reduce(DataFrame.unionByName, parts)


class CrookedRows(ValueError):
    """Rows of the wrong width: ``shards`` is a list of (table, file, bad rows)."""

    def __init__(self, shards: list[tuple[str, str, int]]):
        super().__init__(", ".join(f"{table}/{file}: {bad} rows" for table, file, bad in shards))
        self.shards = shards


def _parsed_lines(spark: SparkSession, path: str, table: str, layout: Layout) -> DataFrame:
    """Every line of a table's shards parsed on its own, with its file and its faults."""
    spec = layout.tables[table]
    lines = spark.read.option("pathGlobFilter", spec.glob).text(path, lineSep="\n")
    # A blank line is no row. It is looked for before all else, or else all is made twice.
    rows = lines.where(F.trim(spanning.without_return("value")) != "").select(
        F.decode(spanning.without_return("value").cast("binary"), layout.csv["encoding"]).alias("_text"),
        F.col("_metadata.file_name").alias(SOURCE_FILE),
        (spanning.needs_joining("value") == 1).alias(JOINED),
    )
    # The text goes no further.
    return _parsed(rows, "_text", spec, layout)


def _parsed(records: DataFrame, record: str, spec: TableLayout, layout: Layout) -> DataFrame:
    """Columns, faults and replaced characters of records.

    Control characters are replaced before the columns are told apart: none of them is part
    of the file's syntax, and a record is looked through once, not column by column.
    """
    options = dict(layout.csv, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_ROW)
    return records.select(
        F.from_csv(text.scrub_controls(record), _with_bad(spec.schema).toDDL(), options).alias("_row"),
        text.count_controls(record).cast("long").alias(REPLACED), SOURCE_FILE, JOINED,
    ).select("_row.*", REPLACED, SOURCE_FILE, JOINED)


def _staged_rows(rows: DataFrame, spec: TableLayout) -> DataFrame:
    """Cleaned columns, sorted inside each task as far as the layout asks for it.

    Without a shuffle: the status and the opening window then skip most pages of a file.
    """
    cleaned = rows.select(
        *spec.columns, REPLACED, F.col(BAD_ROW).isNotNull().alias(BAD_ROW), JOINED, SOURCE_FILE)
    return cleaned.sortWithinPartitions(SOURCE_FILE, *spec.clustered_by)


def _facts(spark: SparkSession, target: str) -> DataFrame:
    """Per shard: rows, rows that are no whole record, rows of the wrong width, replaced characters.

    From four columns of what has been staged, which hold next to nothing.
    """
    kept = f"{SOURCE_FILE} string, {JOINED} boolean, {BAD_ROW} boolean, {REPLACED} long"
    return spark.read.schema(kept).parquet(target).groupBy(SOURCE_FILE).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(JOINED).alias("odd"), F.count_if(BAD_ROW).alias("bad"),
        F.sum(REPLACED).alias("replaced"))


def _stage_table(spark: SparkSession, source: str, target: str, table: str, layout: Layout) -> list:
    """Write one table in one pass over its shards; the facts of each shard.

    Every line is first taken for a whole record. The shards for which that turns out
    wrong are read again, their records put together, and replace what was written of them.
    """
    spec = layout.tables[table]
    settings = {DROP_SHUFFLES: "true"} | ({READ_BYTES: SORTED_BYTES} if spec.glob.endswith(PACKED) else {})

    def write(rows: DataFrame) -> None:
        with held(spark, settings):
            _staged_rows(rows, spec).write.mode("overwrite").option("compression", "zstd") \
                .option("partitionOverwriteMode", "dynamic").partitionBy(SOURCE_FILE).parquet(target)

    # What an attempt that died left behind goes first: only whole tables are in the ledger.
    spark.createDataFrame([], T.StructType([*spec.schema.fields])).write.mode("overwrite").parquet(target)
    write(_parsed_lines(spark, source, table, layout))
    facts = _facts(spark, target).collect()
    odd = [f"{source}/{row[SOURCE_FILE]}" for row in facts if row.odd]
    if odd:
        found = spanning.records(spark, odd, layout.csv["encoding"]).select(
            "record", F.col("file").alias(SOURCE_FILE), F.lit(False).alias(JOINED))
        write(_parsed(found, "record", spec, layout))
        facts = _facts(spark, target).collect()
    bad = [(table, row[SOURCE_FILE], row.bad) for row in facts if row.bad]
    if bad:
        raise CrookedRows(bad)
    return facts


def stage(spark: SparkSession, raw_root: str, stage_root: str, extraction: str,
          layout: Layout | None = None) -> dict[str, DataFrame]:
    """CSV to Parquet once per table and extraction; returns the staged tables.

    A table counts as staged when the ledger says so, which is written after the
    files, with what was seen of each shard. An attempt that died half-way left no entry
    and is overwritten. Rows of the wrong width raise ``CrookedRows`` with their shards.
    """
    layout = layout or layout_for(extraction)
    done_root = f"{stage_root}/staged"
    done = {row.tabela for row in shard_facts(spark, stage_root, extraction).select("tabela").distinct().toLocalIterator()}
    staged = {}
    for table, spec in layout.tables.items():
        target = f"{stage_root}/extracao={extraction}/{table}"
        if table not in done:
            facts = _stage_table(spark, f"{raw_root}/{extraction}/{table}", target, table, layout)
            ledger.append(spark, done_root, STAGED, [
                (extraction, table, row[SOURCE_FILE], row.rows, row.replaced) for row in facts
            ] or [(extraction, table, None, 0, 0)])
        staged[table] = spark.read.schema(spec.schema).parquet(target).select(*spec.columns)
        staged[table].createOrReplaceTempView(table)
    return staged


def shard_facts(spark: SparkSession, stage_root: str, extraction: str) -> DataFrame:
    """(extracao, tabela, arquivo, linhas, trocados) of every staged shard that has rows."""
    return ledger.read(spark, f"{stage_root}/staged", STAGED).where(F.col("extracao") == extraction)


#: Tables that are joined by company, and the id they are joined by.
COMPANY_ID, BY_COMPANY = "cnpj_basico", ("empresas", "estabelecimentos", "simples")


def by_company(spark: SparkSession, staged: dict[str, DataFrame], stage_root: str, extraction: str,
               buckets: int) -> dict[str, DataFrame]:
    """The staged tables with those of companies laid out in ``buckets`` by company id.

    Once for each extraction; joins on the id over these tables then need no shuffle. Nor
    does the layout: each task sorts the few staged files that it reads in memory and writes
    a file a bucket, as compressed columns. Rows that went through a shuffle would lie on disk
    at some eight times those bytes, and a bucket that one task sorts would be spilled. Worth
    it where an extraction is joined more than once, with few buckets: files are tasks times
    buckets. They are found again through the ledger by later sessions with the same ``buckets``.
    """
    root = f"{stage_root}/by_company-{buckets}"
    done = {r.tabela for r in shard_facts(spark, root, extraction).select("tabela").distinct().toLocalIterator()}
    found = dict(staged)
    for table in BY_COMPANY:
        name = f"by_company_{buckets}_{table}_{extraction}".replace("-", "_")
        target = f"{root}/extracao={extraction}/{table}"
        spark.sql(f"drop table if exists {name}")  # the files of such a table stay
        if table not in done:
            with held(spark, {DROP_SHUFFLES: "true", READ_BYTES: SORTED_BYTES}):
                staged[table].write.mode("overwrite").option("path", target).option("compression", "zstd") \
                    .bucketBy(buckets, COMPANY_ID).sortBy(COMPANY_ID).saveAsTable(name)
            ledger.append(spark, f"{root}/staged", STAGED, [(extraction, table, None, None, None)])
        else:
            spark.sql(
                f"create table {name} ({staged[table].schema.toDDL()}) using parquet clustered by ({COMPANY_ID}) "
                f"sorted by ({COMPANY_ID}) into {buckets} buckets location '{target}'")
        found[table] = spark.table(name)
    return found


STAGED = T.StructType([
    T.StructField("extracao", T.StringType()), T.StructField("tabela", T.StringType()),
    T.StructField("arquivo", T.StringType()), T.StructField("linhas", T.LongType()),
    T.StructField("trocados", T.LongType()),
])
