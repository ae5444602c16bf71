"""The two dimensions that live in code: population and friendly sector names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Inhabitants per state, 2022 census. Abroad ("EX") has none.
POPULATION = {
    "SP": 44_411_238,
    "MG": 20_538_718,
    "RJ": 16_054_524,
    "BA": 14_141_626,
    "PR": 11_444_380,
    "RS": 10_882_965,
    "PE": 9_058_931,
    "CE": 8_794_957,
    "PA": 8_120_131,
    "SC": 7_610_361,
    "GO": 7_056_495,
    "MA": 6_776_699,
    "PB": 3_974_687,
    "AM": 3_941_613,
    "ES": 3_833_712,
    "MT": 3_658_649,
    "RN": 3_302_406,
    "PI": 3_269_200,
    "AL": 3_127_683,
    "DF": 2_817_381,
    "MS": 2_757_013,
    "SE": 2_209_558,
    "RO": 1_581_196,
    "TO": 1_511_460,
    "AC": 830_018,
    "AP": 733_759,
    "RR": 636_707,
}
POPULATION_SOURCE = "População: Censo IBGE 2022"
ABROAD = "EX"


@dataclass(frozen=True)
class Sector:
    slug: str
    label: str
    codes: tuple[str, ...]


# Everyday sector names, in the plural, and the codes behind them.
SECTORS = [
    Sector("padaria", "padarias", ("4721101", "4721102", "1091102")),
    Sector("salao-de-beleza", "salões de beleza", ("9602501", "9602502")),
    Sector("petshop", "petshops", ("4789004", "9609208", "9609203")),
    Sector("academia", "academias", ("9313100",)),
    Sector("lanchonete", "lanchonetes", ("5611203",)),
    Sector("restaurante", "restaurantes", ("5611201",)),
    Sector("bar", "bares", ("5611202", "5611204", "5611205")),
    Sector("food-truck", "food trucks", ("5612100",)),
    Sector("tatuagem", "estúdios de tatuagem", ("9609206",)),
    Sector("creche", "creches", ("8511200",)),
    Sector("loja-de-roupa", "lojas de roupa", ("4781400",)),
    Sector("psicologia", "consultórios de psicologia", ("8650003",)),
    Sector("cervejaria", "cervejarias", ("1113502",)),
]


def by_slug(sectors: list[Sector] = SECTORS) -> dict[str, Sector]:
    return {sector.slug: sector for sector in sectors}


def codes_of(slugs: list[str], sectors: list[Sector] = SECTORS) -> list[str]:
    known = by_slug(sectors)
    return [code for slug in slugs for code in known[slug].codes]


def population(spark: SparkSession, inhabitants: dict[str, int] = POPULATION) -> DataFrame:
    return spark.createDataFrame(list(inhabitants.items()), "uf string, hab long")


def sector_dimension(spark: SparkSession, sectors: list[Sector] = SECTORS) -> DataFrame:
    rows = [(s.slug, s.label, list(s.codes)) for s in sectors]
    return spark.createDataFrame(rows, "slug string, rotulo string, codigos array<string>")


def sector_codes(spark: SparkSession, sectors: list[Sector] = SECTORS) -> DataFrame:
    """One row per sector and code."""
    return sector_dimension(spark, sectors).select(
        "slug", "rotulo", F.explode("codigos").alias("cnae_principal")
    )
