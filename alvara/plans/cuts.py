"""Cuts over one month, every entry of a family in the same plan.

A family is one grouping and one ranking whatever the number of entries: the
entries are rows that join to the sums. The result is tidy::

    chave, ordem, rotulo, detalhe, valor, valor_b, n, destaque

``valor`` is what a chart would draw. ``valor_b`` is the second number of a row:
the month total (board), the other sector or state (pairs, duels), the earlier
month (growth), the leading state's position (per capita), a position (focus).
A pair of sectors also has its fitted line, which is the same on all of its rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..operators import measures, picks, rankings
from ..session import materialise
from ..sources.aggregate_store import Openings
from .catalogue import Entry, Settings, as_frame, codes_frame

TIDY = ["chave", "ordem", "rotulo", "detalhe", "valor", "valor_b", "n", "destaque"]
#: The least-squares line of ``valor_b`` over ``valor`` with its two end points.
LINE = ["inclinacao", "intercepto", "x_min", "y_min", "x_max", "y_max"]
DUEL_ROWS = 5

# Fewer rows than this and the entry has no data; 1 where not named.
LEAST_ROWS = {"recorte_cidade": 3, "lqhero": 2, "espuria": 5, "dupla": 2}


class Month:
    """What the families share: the month's sums, the entries and the settings."""

    def __init__(self, d: Openings, population: DataFrame, settings: Settings,
                 entries: Sequence[Entry], quotient_floors: tuple[int, int],
                 growth_floor: int, growth_ceiling: float, duel_other_rows: int | None = None):
        self.d, self.population, self.settings = d, population, settings
        self.entries = list(entries)
        self.quotient_floors = quotient_floors
        self.growth_floor, self.growth_ceiling = growth_floor, growth_ceiling
        self.duel_other_rows = duel_other_rows
        self.spark = d.cells.sparkSession

    def of(self, family: str) -> list[Entry]:
        return [entry for entry in self.entries if entry.family == family]

    @cached_property
    def sides(self) -> DataFrame:
        """Openings per entry, side and state, abroad included, for all entries with codes."""
        codes = codes_frame(self.spark, self.entries)
        return rankings.sector_states(self.d, codes, ["chave", "lado"], abroad=True)

    def by_side(self, family: str, abroad: bool = False) -> DataFrame:
        """The same for the entries of one family."""
        keys = [entry.key for entry in self.of(family)]
        own = self.sides.where(F.col("chave").isin(*keys))
        return own if abroad else own.where(rankings.at_home())

    def floor(self, family: str) -> Column:
        """The floor of each row's entry, as an expression over ``chave``."""
        chain = F.lit(None).cast("int")
        for entry in self.of(family):
            chain = F.when(F.col("chave") == entry.key, entry.floor).otherwise(chain)
        return chain


def tidy(df: DataFrame, label: str | Column, value: str | Column, *, order: str | Column = "posicao",
         detail: Column | None = None, other: str | Column | None = None,
         count: str | Column | None = None, highlight: Column | bool = False) -> DataFrame:
    def col(x, kind):
        column = F.lit(None) if x is None else F.col(x) if isinstance(x, str) else x
        return column.cast(kind)

    return df.select(
        "chave", col(order, "int").alias("ordem"), col(label, "string").alias("rotulo"),
        col(detail, "string").alias("detalhe"), col(value, "double").alias("valor"),
        col(other, "double").alias("valor_b"), col(count, "long").alias("n"),
        (highlight if isinstance(highlight, Column) else F.lit(highlight)).alias("destaque"),
    )


def _leads() -> Column:
    return F.col("posicao") == 1


def national_board(m: Month) -> DataFrame:
    states = m.d.in_month().groupBy("uf").agg(rankings.total().alias("n"))
    whole = rankings.month_total(m.d).scalar()
    top = rankings.ranked(states, "n", "uf", keep=rankings.TOP)
    top = top.withColumn("chave", F.lit("placar_nacional"))
    return tidy(top, "uf", "n", other=whole, count="n")


def _by_place(m: Month, family: str, sums: DataFrame, label: str) -> DataFrame:
    """Rankings of the country and of single states, from sums per state and label."""
    places = m.spark.createDataFrame(
        [(e.key, e.params["uf"]) for e in m.of(family) if "uf" in e.params],
        "chave string, uf string",
    )
    parts = [sums.join(places, "uf").select("chave", label, "n")]
    for entry in m.of(family):
        if "uf" not in entry.params:
            whole = sums.groupBy(label).agg(F.sum("n").alias("n"))
            parts.append(whole.select(F.lit(entry.key).alias("chave"), label, "n"))
    top = rankings.ranked(
        reduce(DataFrame.unionByName, parts), "n", label, ["chave"], rankings.TOP
    )
    return tidy(top, label, "n", count="n")


def sector_rankings(m: Month) -> DataFrame:
    sums = (
        m.d.in_month().where(F.col("cnae_descricao").isNotNull())
        .groupBy("uf", "cnae_descricao").agg(rankings.total().alias("n"))
    )
    return _by_place(m, "ranking_cnae", sums, "cnae_descricao")


def city_rankings(m: Month) -> DataFrame:
    sums = (
        m.d.in_month().where(F.col("municipio").isNotNull())
        .groupBy("uf", rankings.city_label().alias("cidade")).agg(rankings.total().alias("n"))
    )
    return _by_place(m, "recorte_cidade", sums, "cidade")


def sector_spotlights(m: Month) -> DataFrame:
    top = rankings.ranked(m.by_side("setor", abroad=True), "n", "uf", ["chave"], rankings.TOP)
    return tidy(top, "uf", "n", count="n", highlight=_leads())


def duels(m: Month) -> DataFrame:
    """The first sectors of A beside B's count of each.

    With ``duel_other_rows`` sectors outside B's first so many count as 0.
    """
    pairs = m.spark.createDataFrame(
        [(e.key, e.params["uf"], e.params["uf_b"]) for e in m.of("duelo")],
        "chave string, uf_a string, uf_b string",
    )
    states = sorted({uf for e in m.of("duelo") for uf in (e.params["uf"], e.params["uf_b"])})
    sums = (
        m.d.in_month().where(F.col("cnae_descricao").isNotNull() & F.col("uf").isin(*states))
        .groupBy("uf", "cnae_descricao").agg(rankings.total().alias("n"))
    )

    def side(name: str, keep: int | None) -> DataFrame:
        own = sums.join(pairs.select("chave", F.col(name).alias("uf")), "uf")
        return own if keep is None else rankings.ranked(own, "n", "cnae_descricao", ["chave"], keep)

    other = side("uf_b", m.duel_other_rows).select(
        "chave", "cnae_descricao", F.col("n").alias("n_b")
    )
    both = side("uf_a", DUEL_ROWS).drop("uf").join(other, ["chave", "cnae_descricao"], "left")
    return tidy(both, "cnae_descricao", "n", other=F.coalesce("n_b", F.lit(0)), count="n")


def growth(m: Month) -> DataFrame:
    rows = measures.plausible_growth(
        measures.growth_by_sector(m.d, floor=m.growth_floor), m.growth_ceiling
    ).withColumn("chave", F.lit("anomalia"))
    top = rankings.ranked(rows, "variacao", "cnae_descricao", ["chave"])
    return tidy(top, "cnae_descricao", "variacao", other="antes", count="agora",
                highlight=_leads())


def rates(m: Month) -> DataFrame:
    entries = m.of("percapita")
    parts = []
    if any(e.codes for e in entries):
        parts.append(m.by_side("percapita").select("chave", "uf", "n"))
    for entry in entries:
        if not entry.codes:
            whole = rankings.state_totals(m.d)
            parts.append(whole.select(F.lit(entry.key).alias("chave"), "uf", "n"))
    counts = reduce(DataFrame.unionByName, parts).where(F.col("n") >= m.floor("percapita"))
    eligible = measures.per_capita(counts, m.population)
    placed = rankings.ranked(eligible, "por_100k", "uf", ["chave"])
    leader = F.max(F.when(F.col("uf") == m.settings.leader, F.col("posicao"))).over(
        Window.partitionBy("chave")
    )
    placed = placed.withColumn("_leader", leader).where(F.col("posicao") <= rankings.TOP)
    return tidy(placed, "uf", "por_100k", other="_leader", count="n", highlight=_leads())


def ratios(m: Month) -> DataFrame:
    sums = _sides(m, "razao").where(
        (F.col("b") >= m.floor("razao")) & (F.col("b") > 0) & (F.col("a") > 0)
    ).withColumn("razao", numbers.ratio("a", "b"))
    top = rankings.ranked(sums, "razao", "uf", ["chave"], rankings.TOP)
    return tidy(top, "uf", "razao", other="b", count="a", highlight=_leads())


def _sides(m: Month, family: str) -> DataFrame:
    return m.by_side(family).groupBy("chave", "uf").agg(
        *[F.sum(F.when(F.col("lado") == side, F.col("n"))).alias(side) for side in ("a", "b")]
    )


def focus(m: Month) -> DataFrame:
    """Position and rate of one state in two sectors; no floor here."""
    rated = measures.per_capita(m.by_side("dupla"), m.population)
    placed = rankings.ranked(rated, "por_100k", "uf", ["chave", "lado"])
    own = placed.where(F.col("uf") == m.settings.focus)
    return tidy(own, "uf", "por_100k", order=F.when(F.col("lado") == "a", 1).otherwise(2),
                detail=F.col("lado"), other="posicao", count="n")


def signatures(m: Month) -> DataFrame:
    floor, national_floor = m.quotient_floors
    quotients = measures.location_quotient(m.d, floor=floor, national_floor=national_floor)
    chosen = picks.signature_sectors(quotients).withColumn("chave", F.lit("assinatura"))
    return tidy(chosen, "uf", "lq", detail=F.col("descricao"))


def heroes(m: Month) -> DataFrame:
    """Leader and runner-up of each hero sector."""
    codes = codes_frame(m.spark, m.of("lqhero"))
    quotients = measures.sector_quotients(m.d, codes, "chave", floor=0).where(
        F.col("n") >= m.floor("lqhero")
    )
    top = rankings.ranked(quotients, "lq", "uf", ["chave"], 2)
    return tidy(top, "uf", "lq", count="n", highlight=_leads())


def pairs(m: Month) -> DataFrame:
    points = _sides(m, "espuria").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    placed = rankings.ranked(points, "a", "uf", ["chave"])
    return tidy(placed, "uf", "a", other="b", count="a",
                highlight=F.col("uf").isin(*m.settings.labelled_states))


def lines(rows: DataFrame) -> DataFrame:
    """The fitted line of each pair of sectors in tidy ``rows``."""
    points = rows.where("familia = 'espuria'").select(
        "chave", F.col("valor").alias("x"), F.col("valor_b").alias("y"))
    return measures.trend_line(points, ["chave"]).select("chave", *LINE)


FAMILIES: dict[str, Callable[[Month], DataFrame]] = {
    "percapita": rates,
    "assinatura": signatures,
    "razao": ratios,
    "lqhero": heroes,
    "espuria": pairs,
    "dupla": focus,
    "placar_nacional": national_board,
    "ranking_cnae": sector_rankings,
    "recorte_cidade": city_rankings,
    "anomalia": growth,
    "setor": sector_spotlights,
    "duelo": duels,
}
# Families whose labels are official descriptions, which need shortening.
DESCRIBED = ["ranking_cnae", "anomalia", "duelo"]


def two_months(d: Openings) -> Openings:
    """The month and the one before, summed over weeks and city codes, on disk.

    All families read this instead of the aggregate. It has at most one row per
    month, state, city name and sector.
    """
    both = d.cells.where(
        dates.in_month("semana", d.month) | dates.in_month("semana", d.previous)
    )
    summed = both.groupBy(
        F.trunc("semana", "month").alias("semana"), "uf", "municipio", "cnae_principal",
        "cnae_descricao",
    ).agg(rankings.total().alias("contagem"))
    return replace(d, cells=materialise(summed, "months"))


def run(d: Openings, entries: Sequence[Entry], population: DataFrame,
        settings: Settings | None = None,
        quotient_floors: tuple[int, int] = (
            measures.QUOTIENT_FLOOR, measures.QUOTIENT_NATIONAL_FLOOR),
        growth_floor: int = measures.GROWTH_FLOOR,
        growth_ceiling: float = measures.GROWTH_CEILING,
        duel_other_rows: int | None = None, month: dt.date | None = None) -> DataFrame:
    """Rows of every entry, with ``status`` ``ok`` or ``no_data``.

    ``month`` is the first day of the month to show, by default the last closed one.
    An entry without enough data keeps one row, so that no entry disappears and
    none can stop the others.
    """
    d = d if month is None else replace(d, month=month)
    m = Month(two_months(d), population, settings or Settings(), entries,
              quotient_floors, growth_floor, growth_ceiling, duel_other_rows)
    if any(entry.codes for entry in entries):
        m.sides = materialise(m.sides, "sides")
    wanted = [family for family in FAMILIES if m.of(family)]
    rows = materialise(reduce(DataFrame.unionByName, [
        FAMILIES[family](m).withColumn("familia", F.lit(family)) for family in wanted
    ]), "cuts")
    listed = as_frame(m.spark, entries)
    labels = text.distinct_labels(
        rows.where(F.col("familia").isin(*DESCRIBED)), "rotulo", ["chave"]
    )
    least = F.lit(1)
    for family, n in LEAST_ROWS.items():
        least = F.when(F.col("familia") == family, n).otherwise(least)
    enough = (
        rows.groupBy("chave", "familia").agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") >= least).select("chave")
    )
    kept = (
        rows.drop("familia").join(enough, "chave", "left_semi")
        .join(labels, ["chave", "rotulo"], "left")
        .join(lines(rows), "chave", "left")
        .withColumn("detalhe", F.coalesce("label", "detalhe")).drop("label")
    )
    return listed.join(kept.select(*TIDY, *LINE), "chave", "left").select(
        "fila", "posicao", "chave", "familia", *TIDY[1:], *LINE,
        F.when(F.col("ordem").isNull(), "no_data").otherwise("ok").alias("status"),
    )
