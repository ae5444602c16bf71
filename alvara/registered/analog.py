"""A registry made of order data: the raw tables as views over Parquet.

A line item is an establishment, its order gives the opening date, the customer
is the company, the part's brand is the sector and the nation the state.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.companies import new_companies
from ..operators.weekly import weekly_aggregate
from ..plans.catalogue import HERO_CODES, Settings
from ..session import materialise, run_dir
from ..sources import aggregate_store
from ..sources.dimensions import ABROAD, SECTORS, Sector

EXTRACTION = dt.date(2000, 7, 15)
NEWER_EXTRACTION = dt.date(2000, 8, 12)
MONTH = dt.date(2000, 6, 1)
PREVIOUS = dt.date(2000, 5, 1)
ABROAD_NATION = 24
UNDESCRIBED = "Brand#25"

# Floors and bounds for small data; the registry's own are the defaults.
FLOOR = 2
QUOTIENT_FLOORS = (2, 10)
GROWTH_FLOOR = 10
GROWTH_CEILING = 33.0
BOUNDS = (100, 1_000)
LEADER = "NATION_10"
SHARE_BOUNDS = (5.0, 20.0)
FOCUS = "NATION_3"


# Schemas of the tables read, so that no job has to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


def _brands() -> list[Sector]:
    """The friendly sectors with brands in place of the official codes, in order."""
    made, brand = [], 0
    for sector in SECTORS:
        codes = []
        for _ in sector.codes:
            brand += 1
            codes.append(f"Brand#{brand}")
        made.append(Sector(sector.slug, sector.label, tuple(codes)))
    return made


BRAND_SECTORS = _brands()

SETTINGS = Settings(
    sectors=tuple(BRAND_SECTORS),
    leader=LEADER,
    focus=FOCUS,
    ranked_states=tuple(f"NATION_{i}" for i in (10, 3, 1, 7, 12, 21)),
    labelled_states=("NATION_10", "NATION_3", "NATION_1"),
    duels=tuple(
        (f"NATION_{a}", f"NATION_{b}") for a, b in ((10, 3), (1, 12), (7, 21), (0, 5), (8, 14))
    ),
    hero_codes={name: f"Brand#{i}" for i, name in enumerate(HERO_CODES, start=16)},
    floor=FLOOR,
)


def _digits(value: str | Column, width: int) -> Column:
    """Zero-padded to at least ``width``; longer keys stay whole and distinct."""
    digits = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0")


def _day(column: str) -> Column:
    return F.date_format(column, "yyyyMMdd")


@dataclass(frozen=True)
class Analog:
    """The six raw tables and the population over one folder of Parquet files.

    Views are analysed once per session. What a registry has as files of its own
    (code tables, population, the published aggregate) is written once to the
    shared folder, so that later plans know its true size and do not derive it
    again.
    """

    spark: SparkSession
    folder: str

    @cache
    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cache
    def establishments(self) -> DataFrame:
        """All establishments; what the window leaves out is the operators' business."""
        # Orders meet their customers before the line items, which are then shuffled once less.
        # What is only tested goes through the shuffles as the outcome, days as dates.
        owned = (
            self.table("orders").select(
                "o_orderkey", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("opened"),
                (F.col("o_orderstatus") == "P").alias("pending"))
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "o_custkey", "o_orderpriority", "opened", "pending", "c_nationkey")
        )
        items = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", F.to_date("l_shipdate").alias("shipped"),
            (F.col("l_returnflag") == "R").alias("returned"), (F.col("l_linestatus") == "F").alias("final"),
            (F.col("l_quantity") < 5).alias("few"), (F.col("l_quantity") < 10).alias("some"))
        joined = (
            items.join(owned, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        )
        pending, final = F.col("pending"), F.col("final")

        def unless(blank: Column, value: Column) -> Column:
            return F.when(blank, "").otherwise(value)

        return joined.select(
            _digits("o_custkey", 8).alias("cnpj_basico"),
            _digits(F.col("l_orderkey") % 10000, 4).alias("cnpj_ordem"),
            _digits("l_linenumber", 2).alias("cnpj_dv"),
            F.when(F.col("l_linenumber") <= 5, "1").otherwise("2")
            .alias("identificador_matriz_filial"),
            unless(F.col("few"), F.col("p_name")).alias("nome_fantasia"),
            F.when(F.col("returned"), "08").otherwise("02").alias("situacao_cadastral"),
            _day("shipped").alias("data_situacao_cadastral"),
            F.when(F.col("l_orderkey") % 97 == 0, "00000000")
            .when(F.col("l_orderkey") % 101 == 0, "")
            .otherwise(_day("opened")).alias("data_inicio_atividade"),
            F.col("p_brand").alias("cnae_fiscal_principal"),
            unless(final, F.concat("p_brand", F.lit(","), "p_type")).alias("cnae_fiscal_secundaria"),
            unless(pending | final, F.col("p_type")).alias("tipo_logradouro"),
            unless(pending, F.col("p_name")).alias("logradouro"),
            unless(pending, F.col("p_size").cast("string")).alias("numero"),
            unless(pending | F.col("some"), F.col("o_orderpriority"))
            .alias("complemento"),
            F.lit("").alias("bairro"),
            unless(pending, _digits("l_partkey", 8)).alias("cep"),
            F.when(F.col("c_nationkey") == ABROAD_NATION, ABROAD).otherwise(F.col("n_name"))
            .alias("uf"),
            self._city("o_custkey").alias("municipio"),
        )

    @staticmethod
    def _city(customer: str = "c_custkey") -> Column:
        return (F.col("c_nationkey") * 10 + F.col(customer) % 4).cast("string")

    @cache
    def companies(self) -> DataFrame:
        return self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            _digits("c_custkey", 8).alias("cnpj_basico"),
            F.col("c_name").alias("razao_social"),
            F.col("n_regionkey").cast("string").alias("natureza_juridica"),
            F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))
            .alias("capital_social"),
            F.when(F.col("c_mktsegment") == "AUTOMOBILE", "01")
            .when(F.col("c_mktsegment") == "BUILDING", "03")
            .when(F.col("c_mktsegment") == "FURNITURE", "05").otherwise("00").alias("porte"),
        )

    @cache
    def simples(self) -> DataFrame:
        return self.table("customer").select(
            _digits("c_custkey", 8).alias("cnpj_basico"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", "S").otherwise("N").alias("opcao_mei"),
        )

    @cache
    def sectors(self) -> DataFrame:
        brands = self.table("part").where(F.col("p_brand") != UNDESCRIBED)
        named = brands.select("p_brand").distinct().select(
            F.col("p_brand").alias("codigo"),
            F.concat(
                F.lit("Comercio de "), "p_brand",
                F.lit(", exceto usados, nao especificados anteriormente"),
            ).alias("descricao"),
        )
        return materialise(named, "sectors")

    @cache
    def cities(self) -> DataFrame:
        codes = self.table("customer").select(self._city().alias("codigo")).distinct()
        named = codes.withColumn("descricao", F.concat(F.lit("CITY_"), "codigo"))
        return materialise(named, "cities")

    @cache
    def natures(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("string").alias("codigo"), F.col("r_name").alias("descricao")
        )

    @cache
    def population(self) -> DataFrame:
        homes = self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).where(F.col("n_nationkey") != ABROAD_NATION)
        people = homes.groupBy(F.col("n_name").alias("uf")).agg(
            (F.count(F.lit(1)) * 1000).alias("hab")
        )
        return materialise(people, "population")

    def raw(self) -> dict[str, DataFrame]:
        return {
            "estabelecimentos": self.establishments(),
            "empresas": self.companies(),
            "simples": self.simples(),
            "cnaes": self.sectors(),
            "municipios": self.cities(),
            "naturezas": self.natures(),
        }

    @cache
    def new_companies(self, extraction: dt.date = EXTRACTION, branches: bool = False) -> DataFrame:
        return new_companies(self.raw(), extraction, branches)

    @cache
    def weekly(self, extraction: dt.date = EXTRACTION) -> DataFrame:
        return weekly_aggregate(self.new_companies(extraction), extraction)

    @cache
    def openings(self) -> aggregate_store.Openings:
        """The cuts' only input: the aggregate, published and opened."""
        root = run_dir(self.spark, "aggregate")
        aggregate_store.publish(self.weekly(), root)
        return aggregate_store.open_aggregate(self.spark, root)


def forget() -> None:
    """Drop what was built for earlier calls, so that the next one does all its work."""
    for part in vars(Analog).values():
        if hasattr(part, "cache_clear"):
            part.cache_clear()
