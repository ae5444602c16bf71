"""Derived measures: shares, growth, rates, ratios, location quotients, trends."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, numbers
from ..sources.aggregate_store import Openings
from .rankings import at_home, total

GROWTH_FLOOR = 300
GROWTH_ROWS = 5
GROWTH_CEILING = 200.0
QUOTIENT_FLOOR = 40
QUOTIENT_NATIONAL_FLOOR = 150
RATE_FLOOR = 20
HERO_FLOOR = 10


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """Rows per ``key`` and their percentage of all rows.

    The total is a scalar subquery over the per-key counts, not a window over
    everything, so no single task sees more than partial sums.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).cast("long").alias("n"))
    whole = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", numbers.percent("n", whole))


def growth_by_sector(d: Openings, month: dt.date | None = None,
                     previous: dt.date | None = None, floor: int = GROWTH_FLOOR,
                     limit: int = GROWTH_ROWS, ceiling: float | None = None) -> DataFrame:
    """Fastest growing sectors, both months at or above the floor.

    Both months come out of one scan and one grouping. With ``ceiling`` growth beyond
    it is left out before the list is cut to ``limit`` rows; by default the list is cut
    first, and :func:`plausible_growth` looks at what is on it.
    """
    month = month or d.month
    previous = previous or dates.previous_month(month)
    now, before = dates.in_month("semana", month), dates.in_month("semana", previous)
    counts = (
        d.cells.where((now | before) & F.col("cnae_descricao").isNotNull())
        .groupBy("cnae_descricao").agg(
            F.sum(F.when(now, F.col("contagem"))).cast("long").alias("agora"),
            F.sum(F.when(before, F.col("contagem"))).cast("long").alias("antes"),
        )
        .where((F.col("agora") >= floor) & (F.col("antes") >= floor))
        .withColumn("variacao", numbers.growth_percent("agora", "antes"))
    )
    if ceiling is not None:
        counts = counts.where(F.col("variacao") <= ceiling)
    return counts.orderBy(
        F.col("variacao").desc(), F.col("cnae_descricao").asc_nulls_last()
    ).limit(limit)


def plausible_growth(growth: DataFrame, ceiling: float = GROWTH_CEILING) -> DataFrame:
    """Growth up to the ceiling; everything when nothing stays below it."""
    plausible = F.col("variacao") <= ceiling
    some = growth.agg(F.bool_or(plausible)).scalar()
    return growth.where(plausible | ~some)


def location_quotient(d: Openings, month: dt.date | None = None,
                      floor: int = QUOTIENT_FLOOR,
                      national_floor: int = QUOTIENT_NATIONAL_FLOOR) -> DataFrame:
    """How far a sector's weight in a state exceeds its weight in the country.

    Totals are taken before the floors. The cells are grouped once; the state
    and sector totals are windows over that small result, whose partitions hold
    at most one row per sector or per state. The grand total is a sum of sums.
    """
    pairs = (
        d.in_month(month).where(at_home() & F.col("cnae_descricao").isNotNull())
        .groupBy("uf", "cnae_principal").agg(
            F.max("cnae_descricao").alias("descricao"), total().alias("n")
        )
    )
    # The total reads the same columns as the rows, so Spark runs one shuffle for both.
    described = F.when(F.col("descricao").isNotNull(), F.col("n"))
    whole = pairs.agg(F.sum(described)).scalar().cast("double")
    in_state = F.sum("n").over(Window.partitionBy("uf")).cast("double")
    in_sector = F.sum("n").over(Window.partitionBy("cnae_principal"))
    return (
        pairs.withColumn("total_uf", in_state)
        .withColumn("total_setor", in_sector.cast("long"))
        .where((F.col("n") >= floor) & (F.col("total_setor") >= national_floor))
        .withColumn(
            "lq",
            (F.col("n").cast("double") / F.col("total_uf"))
            / (F.col("total_setor").cast("double") / whole),
        )
        .select("uf", "cnae_principal", "descricao", "n", "total_setor", "lq")
    )


def per_capita(counts: DataFrame, population: DataFrame, floor: int = 0) -> DataFrame:
    """Openings per 100 000 inhabitants; the floor is on the raw count.

    States without a known population, abroad for one, drop out of the join.
    """
    return (
        counts.where(F.col("n") >= floor).join(population, "uf")
        .withColumn("por_100k", numbers.per_100k("n", "hab"))
        .where(F.col("por_100k").isNotNull())
        .drop("hab")
    )


def sector_quotients(d: Openings, codes: DataFrame, key: str, floor: int = HERO_FLOOR,
                     month: dt.date | None = None) -> DataFrame:
    """Location quotient of whole sectors (by codes), for every key of ``codes``.

    Unlike :func:`location_quotient` the denominators keep openings without a
    sector description. National shares use all states; the floor only decides
    which states may be named.
    """
    sums = d.in_month(month).where(at_home()).groupBy("uf", "cnae_principal").agg(
        total().alias("n")
    )
    whole = sums.agg(F.sum("n")).scalar().cast("double")
    in_state = F.sum("n").over(Window.partitionBy("uf"))
    in_sector = (
        sums.withColumn("_uf", in_state)
        .join(codes.select(key, "cnae_principal").distinct(), "cnae_principal")
        .groupBy(key, "uf").agg(total("n").alias("n"), F.max("_uf").alias("_uf"))
    )
    national = F.sum("n").over(Window.partitionBy(key))
    return (
        in_sector.withColumn("_br", national.cast("double"))
        .where(F.col("n") >= floor)
        .withColumn(
            "lq", (F.col("n").cast("double") / F.col("_uf").cast("double"))
            / (F.col("_br") / whole),
        )
        .select(key, "uf", "n", "lq")
    )


def trend_line(points: DataFrame, within: Sequence[str] = (), x: str = "x", y: str = "y") -> DataFrame:
    """Least-squares line per group and its two end points; NULL below two points."""
    fitted = points.groupBy(*within).agg(
        F.count(F.lit(1)).cast("long").alias("pontos"),
        F.regr_slope(y, x).alias("_a"),
        F.regr_intercept(y, x).alias("_b"),
        F.min(x).cast("double").alias("x_min"),
        F.max(x).cast("double").alias("x_max"),
    )
    usable = F.col("pontos") >= 2
    return fitted.select(
        *within, "pontos",
        F.when(usable, F.col("_a")).alias("inclinacao"),
        F.when(usable, F.col("_b")).alias("intercepto"),
        "x_min",
        F.when(usable, F.col("_a") * F.col("x_min") + F.col("_b")).alias("y_min"),
        "x_max",
        F.when(usable, F.col("_a") * F.col("x_max") + F.col("_b")).alias("y_max"),
    )
