"""Data quality: every check is a frame of rule rows, and one job makes the report.

Hard rules stop the run; soft rules are numbers for a person to look at.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..sources import manifest as manifest_files
from ..sources.layout import Layout
from ..sources.registry_csv import BAD_ROW, SOURCE_FILE, scan
from .companies import (
    ALLOWED_COLUMNS, BRANCH, HEAD_OFFICE, WINDOW_DAYS, active, window_start,
)
from .measures import share_of_total

HARD, SOFT = "hard", "soft"
REPORT_COLUMNS = ["rule", "subject", "observed", "expected", "severity", "ok"]

# Plausible openings per 30 days, and the leading state's share.
MONTHLY_BOUNDS = (150_000, 700_000)
LEADING_STATE = "SP"
SHARE_BOUNDS = (20.0, 40.0)
AGGREGATE_WARNING_BYTES = 50_000_000
TEXT_LIMIT = 280
ALT_LIMIT = 1000


class QualityError(RuntimeError):
    """A hard rule does not hold."""


def _as_text(value: Column | str | int | None) -> Column:
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("string")


def rule_row(rule: str, subject, observed, expected, severity: str, ok: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"), _as_text(subject).alias("subject"),
        _as_text(observed).alias("observed"), _as_text(expected).alias("expected"),
        F.lit(severity).alias("severity"), F.coalesce(ok, F.lit(False)).alias("ok"),
    )


def _rows(df: DataFrame, *rules: Column) -> DataFrame:
    return df.select(F.inline(F.array(*rules)))


def complete_load(expected: DataFrame, manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Every expected archive is in the manifest, and on disk with the same size.

    ``expected(nome)``, ``manifest(nome, bytes)``, ``listing(nome, bytes)``. The
    three lists are stacked and grouped by name: one shuffle, and no join.
    """
    def part(df: DataFrame, role: str, size: Column) -> DataFrame:
        return df.select("nome", *[
            (size if role == name else F.lit(None).cast("long")).alias(name)
            for name in ("_expected", "_manifest", "_disk")
        ])

    size = F.col("bytes").cast("long")
    stacked = (
        part(expected, "_expected", F.lit(1).cast("long"))
        .unionByName(part(manifest, "_manifest", size))
        .unionByName(part(listing, "_disk", size))
    )
    files = stacked.groupBy("nome").agg(
        *[F.max(name).alias(name) for name in ("_expected", "_manifest", "_disk")]
    ).where(F.col("_expected").isNotNull() | F.col("_manifest").isNotNull())
    observed = (
        F.when(F.col("_manifest").isNull(), "not in the manifest")
        .when(F.col("_disk").isNull(), "not on disk")
        .otherwise(F.col("_disk").cast("string"))
    )
    return _rows(files, rule_row(
        "complete_load", F.col("nome"), observed, F.col("_manifest"), HARD,
        F.col("_disk") == F.col("_manifest"),
    ))


def archive_hashes(manifest: DataFrame, hashed: DataFrame) -> DataFrame:
    """A row for every recorded archive: its SHA-256 on disk against the recorded one.

    An archive that is missing, or has no hash on either side, fails the rule.
    """
    both = manifest.select("nome", F.col("sha256").alias("_recorded")).join(
        hashed.select("nome", "sha256", F.lit(True).alias("_there")), "nome", "left"
    )
    observed = F.coalesce("sha256", F.when(F.col("_there"), "no hash").otherwise("not on disk"))
    return _rows(both, rule_row(
        "archive_hash", F.col("nome"), observed, F.coalesce("_recorded", F.lit("no hash")), HARD,
        F.col("sha256") == F.col("_recorded"),
    ))


def missing_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The failing row of a dump that has no manifest."""
    return _rows(spark.range(1), rule_row(
        "manifest", path, "not on disk", "a manifest", HARD, F.lit(False)
    ))


def forbidden_files(names: DataFrame, forbidden: DataFrame, where: str) -> DataFrame:
    """Names that must not exist; an empty result is the good one."""
    found = names.select("nome").distinct().join(forbidden.select("nome"), "nome", "left_semi")
    return _rows(found, rule_row(
        "forbidden_file", F.col("nome"), where, "absent", HARD, F.lit(False)
    ))


def row_widths(spark: SparkSession, path: str, table: str, layout: Layout) -> DataFrame:
    """Rows and malformed rows per shard; all rows are looked at, not the first."""
    rows = scan(spark, path, table, layout, mode="PERMISSIVE", keep_bad=True)
    # Together with a data column, so that the parser reads whole rows.
    bad = F.when(
        F.col(BAD_ROW).isNotNull(), F.coalesce(layout.tables[table].columns[0], BAD_ROW)
    )
    return rows.groupBy(F.col(SOURCE_FILE).alias("file")).agg(
        F.count(F.lit(1)).cast("long").alias("rows"), F.count(bad).cast("long").alias("bad")
    )


def shard_count(spark: SparkSession, path: str, table: str, layout: Layout) -> DataFrame:
    """One shard per archive; fewer would be a partial load that no total betrays.

    Counted from the folder listing, so empty shards count and nothing is read.
    """
    spec = layout.tables[table]
    shards = manifest_files.listing(spark, path, spec.glob).agg(F.count(F.lit(1)).alias("n"))
    wanted = len(spec.archives)
    return _rows(shards, rule_row(
        "shard_count", table, F.col("n"), wanted, HARD, F.col("n") == wanted
    ))


def column_widths(spark: SparkSession, path: str, table: str, layout: Layout) -> DataFrame:
    """Rule rows: the shard count of a table and the width of every row of a shard."""
    per_shard = _rows(row_widths(spark, path, table, layout), rule_row(
        "row_width", F.concat(F.lit(f"{table}/"), F.col("file")), F.col("bad"), 0, HARD,
        F.col("bad") == 0,
    ))
    return per_shard.unionByName(shard_count(spark, path, table, layout))


def crooked_rows(spark: SparkSession, shards: Iterable[tuple[str, str, int]]) -> DataFrame:
    """Failing rows for the shards (table, file, bad rows) that staging refused."""
    frame = spark.createDataFrame(list(shards), "table string, file string, bad long")
    return _rows(frame, rule_row("row_width", F.concat_ws("/", "table", "file"), F.col("bad"), 0, HARD, F.lit(False)))


def foreign_columns(columns: Sequence[str]) -> list[str]:
    return sorted(set(columns) - set(ALLOWED_COLUMNS))


def company_rules(companies: DataFrame, days: int = WINDOW_DAYS,
                  bounds: tuple[int, int] = MONTHLY_BOUNDS) -> DataFrame:
    """Privacy and order of magnitude, from one pass over the new companies."""
    foreign = foreign_columns(companies.columns)
    counts = companies.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("eh_mei") & F.col("endereco").isNotNull()).alias("exposed"),
    ).withColumn("monthly", F.col("n").cast("double") / F.lit(days / 30))
    low, high = bounds
    return _rows(
        counts,
        rule_row("allowed_columns", "new_companies", ",".join(foreign), "", HARD,
                 F.lit(not foreign)),
        rule_row("private_address", "new_companies", F.col("exposed"), 0, HARD,
                 F.col("exposed") == 0),
        rule_row("magnitude", "new_companies", F.round("monthly").cast("long"),
                 f"{low}-{high}", HARD, F.col("monthly").between(low, high)),
    )


def establishment_counts(establishments: DataFrame, extraction: dt.date,
                         days: int = WINDOW_DAYS) -> DataFrame:
    """Reactivations, new head offices and new branches in one pass."""
    start, end = F.lit(window_start(extraction, days)), F.lit(extraction)
    begun = dates.safe_date("data_inicio_atividade")
    changed = dates.safe_date("data_situacao_cadastral")
    kind = F.col("identificador_matriz_filial")
    fresh = begun.between(start, end)
    return active(establishments).agg(
        F.count_if((kind == HEAD_OFFICE) & (changed >= start) & (begun < start))
        .alias("reativadas"),
        F.count_if(fresh & (kind == HEAD_OFFICE)).alias("matrizes"),
        F.count_if(fresh & (kind == BRANCH)).alias("filiais"),
    )


def reactivation(establishments: DataFrame, extraction: dt.date,
                 days: int = WINDOW_DAYS) -> DataFrame:
    """How many companies a filter on the status date would wrongly have taken."""
    return establishment_counts(establishments, extraction, days).select("reativadas")


def head_office_share(establishments: DataFrame, extraction: dt.date,
                      days: int = WINDOW_DAYS) -> DataFrame:
    months = F.lit(days / 30)
    counts = establishment_counts(establishments, extraction, days)
    return counts.select(
        "matrizes", "filiais",
        (F.col("matrizes").cast("double") / months).alias("matrizes_mes"),
        (F.col("filiais").cast("double") / months).alias("filiais_mes"),
        numbers.percent("filiais", F.col("matrizes") + F.col("filiais")).alias("pct_filiais"),
    )


def establishment_rules(establishments: DataFrame, extraction: dt.date,
                        days: int = WINDOW_DAYS) -> DataFrame:
    counts = establishment_counts(establishments, extraction, days)
    share = numbers.percent("filiais", F.col("matrizes") + F.col("filiais"))
    return _rows(
        counts,
        # Informative by design: the opening-date filter leaves them out anyway.
        rule_row("reactivation", "estabelecimentos", F.col("reativadas"), "left out", SOFT,
                 F.lit(True)),
        rule_row("head_offices", "estabelecimentos", F.col("matrizes"), None, SOFT, F.lit(True)),
        rule_row("branches", "estabelecimentos", F.col("filiais"),
                 F.concat(numbers.decimal_comma(share), F.lit("%")), SOFT, F.lit(True)),
    )


def state_share(companies: DataFrame, limit: int = 8) -> DataFrame:
    """The leading states of the new companies with their percentage."""
    return share_of_total(companies, "uf").orderBy(
        F.col("n").desc(), F.col("uf").asc_nulls_last()
    ).limit(limit)


def state_share_rules(companies: DataFrame, leader: str = LEADING_STATE,
                      bounds: tuple[float, float] = SHARE_BOUNDS) -> DataFrame:
    """The leading state's share, from all states; zero if it has no company."""
    share = share_of_total(companies, "uf").agg(
        F.coalesce(F.max(F.when(F.col("uf") == leader, F.col("pct"))), F.lit(0.0)).alias("pct")
    )
    low, high = bounds
    return _rows(share, rule_row(
        "leading_share", leader, numbers.decimal_comma("pct"), f"{low:g}-{high:g}", SOFT,
        F.col("pct").between(low, high),
    ))


def recent_weeks(companies: DataFrame, extraction: dt.date, limit: int = 6) -> DataFrame:
    """Openings of the latest weeks; the one cut by the extraction is marked."""
    weeks = companies.groupBy(dates.week_start("data_abertura").alias("semana")).agg(
        F.count(F.lit(1)).cast("long").alias("n")
    )
    return weeks.orderBy(F.col("semana").desc_nulls_last()).limit(limit).withColumn(
        "parcial", dates.is_partial_week("semana", F.lit(extraction))
    )


def recent_week_rules(companies: DataFrame, extraction: dt.date) -> DataFrame:
    return _rows(recent_weeks(companies, extraction), rule_row(
        "recent_week", F.col("semana"), F.col("n"),
        F.when(F.col("parcial"), "partial").otherwise("whole"), SOFT, F.lit(True),
    ))


def spot_sample(companies: DataFrame, seed: str = "0.42", limit: int = 5) -> DataFrame:
    """A few companies to look up by hand; sole traders, being people, are left out.

    The draw orders by a hash of id and seed: repeatable and, as a bounded top-k,
    never a sort of everything.
    """
    draw = F.md5(F.concat(F.col("cnpj"), F.lit("|"), F.lit(seed)))
    return (
        companies.where(~F.col("eh_mei"))
        .select("cnpj", "razao_social", "data_abertura", "uf", "municipio", "cnae_descricao")
        .orderBy(draw, "data_abertura", F.col("cnae_descricao").asc_nulls_last(),
                 F.col("municipio").asc_nulls_last(), "razao_social")
        .limit(limit)
        .withColumn("cnpj_formatado", text.company_id("cnpj"))
    )


def spot_sample_rules(companies: DataFrame) -> DataFrame:
    return _rows(spot_sample(companies), rule_row(
        "spot_sample", F.col("cnpj_formatado"),
        F.concat_ws(" ", "data_abertura", F.concat("municipio", F.lit("/"), "uf")),
        F.col("razao_social"), SOFT, F.lit(True),
    ))


def duplicate_codes(dimension: DataFrame, name: str) -> DataFrame:
    """Codes that a lookup would find twice, which would multiply rows."""
    repeated = dimension.groupBy("codigo").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _rows(repeated, rule_row(
        "duplicate_code", F.concat(F.lit(f"{name}/"), "codigo"), F.col("n"), 1, HARD,
        F.lit(False),
    ))


def aggregate_size(bytes_frame: DataFrame, limit: int = AGGREGATE_WARNING_BYTES) -> DataFrame:
    return _rows(bytes_frame, rule_row(
        "aggregate_size", "aggregate", F.col("bytes"), limit, SOFT, F.col("bytes") <= limit
    ))


def with_lengths(captions: DataFrame) -> DataFrame:
    """Captions (``texto, alt``) with their lengths and whether both keep the limits.

    A missing text or description fails.
    """
    fits = (F.length("texto") <= TEXT_LIMIT) & (F.length("alt") <= ALT_LIMIT)
    return captions.select(
        "*", F.length("texto").alias("n_texto"), F.length("alt").alias("n_alt"),
        F.coalesce(fits, F.lit(False)).alias("ok"),
    )


def caption_lengths(captions: DataFrame) -> DataFrame:
    """The lengths alone: ``chave, n_texto, n_alt, ok``."""
    return with_lengths(captions).select("chave", "n_texto", "n_alt", "ok")


def caption_status(captions: DataFrame) -> DataFrame:
    """Captions with ``status``: ``too_long`` (or missing) is not to be delivered."""
    checked = with_lengths(captions)
    return checked.withColumn("status", F.when(F.col("ok"), "ok").otherwise("too_long"))


def control_rules(counts: DataFrame) -> DataFrame:
    """How many control characters each file (``file, replaced``) held; they became ``?``."""
    return _rows(counts, rule_row(
        "control_characters", F.col("file"), F.col("replaced"), 0, SOFT, F.lit(False)
    ))


def report(companies: DataFrame, raw: Mapping[str, DataFrame], extraction: dt.date,
           files: Iterable[DataFrame] = (), days: int = WINDOW_DAYS,
           bounds: tuple[int, int] = MONTHLY_BOUNDS, leader: str = LEADING_STATE,
           share_bounds: tuple[float, float] = SHARE_BOUNDS) -> DataFrame:
    """All rules in one frame; ``files`` adds the rules about the files themselves."""
    parts = [
        *files,
        company_rules(companies, days, bounds),
        establishment_rules(raw["estabelecimentos"], extraction, days),
        state_share_rules(companies, leader, share_bounds),
        recent_week_rules(companies, extraction),
        spot_sample_rules(companies),
        *[duplicate_codes(raw[name], name) for name in ("cnaes", "municipios", "naturezas")],
    ]
    return reduce(DataFrame.unionByName, parts).select(*REPORT_COLUMNS)


def enforce(checked: DataFrame, shown: int = 20) -> None:
    """Raise if a hard rule fails. Only a few failing rows reach the driver."""
    failing = checked.where((F.col("severity") == HARD) & ~F.col("ok")).limit(shown).collect()
    if failing:
        lines = [f"{r.rule} {r.subject}: {r.observed} (expected {r.expected})" for r in failing]
        raise QualityError("; ".join(lines))
