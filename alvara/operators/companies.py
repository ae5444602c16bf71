"""New companies: active establishments opened in the window, with their company.

The opening date alone decides. A company that was suspended and came back has
a recent status date and an old opening date; it is not new.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, numbers, text

WINDOW_DAYS = 90

# The only columns that may leave this step, and the registry's codes.
ALLOWED_COLUMNS = [
    "cnpj", "razao_social", "nome_fantasia", "cnae_principal", "cnae_descricao",
    "cnaes_secundarios", "data_abertura", "data_situacao", "natureza_juridica",
    "natureza_descricao", "porte", "capital_social", "municipio_codigo",
    "municipio", "uf", "endereco", "eh_mei",
]
ACTIVE = "02"
HEAD_OFFICE = "1"
BRANCH = "2"
YES = "S"
SOLE_TRADER = "MEI"
SIZE_CLASSES = {"01": "ME", "03": "EPP", "05": "demais"}


def window_start(extraction: dt.date, days: int = WINDOW_DAYS) -> dt.date:
    return extraction - dt.timedelta(days=days)


def active(establishments: DataFrame) -> DataFrame:
    return establishments.where(F.col("situacao_cadastral") == ACTIVE)


def opened_within(establishments: DataFrame, extraction: dt.date,
                  days: int = WINDOW_DAYS) -> DataFrame:
    """Opened in the window, both ends included; unreadable dates drop out.

    The same bounds on the raw text are implied by the parsed test. They are
    stated too because only they reach the Parquet scan and its row groups.
    """
    start = window_start(extraction, days)
    raw = F.col("data_inicio_atividade")
    return establishments.where(
        raw.between(dates.date_text(start), dates.date_text(extraction))
        & dates.safe_date(raw).between(F.lit(start), F.lit(extraction))
    )


def head_offices(establishments: DataFrame) -> DataFrame:
    return establishments.where(F.col("identificador_matriz_filial") == HEAD_OFFICE)


def sole_traders(simples: DataFrame) -> DataFrame:
    """Each sole trader once, so that the flag join cannot multiply rows."""
    return simples.where(F.col("opcao_mei") == YES).select("cnpj_basico").distinct()


def flag_existing(df: DataFrame, keys: DataFrame, on: str, flag: str) -> DataFrame:
    """Add a boolean: does the row's key occur in ``keys``?"""
    marked = keys.select(on).distinct().withColumn(flag, F.lit(True))
    return df.join(marked, on, "left").withColumn(flag, F.col(flag).isNotNull())


def with_description(df: DataFrame, dimension: DataFrame, code: str, name: str) -> DataFrame:
    """Look ``codigo -> descricao`` up; unknown codes keep the row with NULL."""
    named = dimension.select(F.col("codigo").alias(code), F.col("descricao").alias(name))
    return df.join(named, code, "left")


def size_class(is_sole_trader: Column, size_code: str | Column) -> Column:
    size_code = F.col(size_code) if isinstance(size_code, str) else size_code
    chain = F.when(is_sole_trader, SOLE_TRADER)
    for code, label in SIZE_CLASSES.items():
        chain = chain.when(size_code == code, label)
    return chain


def public_address(address: str | Column, is_sole_trader: Column) -> Column:
    """A sole trader is a person, and the address is where the person lives."""
    address = F.col(address) if isinstance(address, str) else address
    return F.when(~is_sole_trader, address)


def new_companies(raw: Mapping[str, DataFrame], extraction: dt.date,
                  include_branches: bool = False, days: int = WINDOW_DAYS) -> DataFrame:
    """The relation every later step reads: ``ALLOWED_COLUMNS`` and nothing else.

    Filters come first and cut the establishments to a few percent; only then do
    the two joins on the company id run, on one partitioning by that id. The code
    tables are small files, so Spark broadcasts them by their size on disk.
    """
    chosen = opened_within(active(raw["estabelecimentos"]), extraction, days)
    if not include_branches:
        chosen = head_offices(chosen)
    chosen = chosen.select(
        "cnpj_basico",
        F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj"),
        text.blank_to_null("nome_fantasia").alias("nome_fantasia"),
        F.col("cnae_fiscal_principal").alias("cnae_principal"),
        text.blank_to_null("cnae_fiscal_secundaria").alias("cnaes_secundarios"),
        dates.safe_date("data_inicio_atividade").alias("data_abertura"),
        dates.safe_date("data_situacao_cadastral").alias("data_situacao"),
        F.col("municipio").alias("municipio_codigo"),
        "uf",
        text.address_line().alias("endereco"),
    )
    companies = raw["empresas"].select(
        "cnpj_basico", "razao_social", "natureza_juridica", "porte",
        numbers.safe_decimal("capital_social").alias("capital_social"),
    )
    joined = flag_existing(
        chosen.join(companies, "cnpj_basico"), sole_traders(raw["simples"]),
        "cnpj_basico", "eh_mei",
    )
    joined = with_description(joined, raw["cnaes"], "cnae_principal", "cnae_descricao")
    joined = with_description(joined, raw["municipios"], "municipio_codigo", "municipio")
    joined = with_description(joined, raw["naturezas"], "natureza_juridica", "natureza_descricao")
    return joined.withColumns({
        "porte": size_class(F.col("eh_mei"), "porte"),
        "endereco": public_address("endereco", F.col("eh_mei")),
    }).select(*ALLOWED_COLUMNS)
