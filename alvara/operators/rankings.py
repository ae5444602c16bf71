"""Totals and rankings over the weeks of one month.

Each function takes :class:`Openings` and returns a frame; nothing is collected.
Ties are broken by the label, so a ranking is the same on every run. ``month``
defaults to the reference month. ``*_all`` forms answer every state or sector in
one plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.aggregate_store import Openings
from ..sources.dimensions import ABROAD

TOP = 8


def total(n: str = "contagem") -> Column:
    return F.sum(n).cast("long")


def at_home() -> Column:
    return F.col("uf") != ABROAD


def ranked(df: DataFrame, value: str, label: Sequence[str] | str, within: Sequence[str] = (),
           keep: int | None = None, position: str = "posicao") -> DataFrame:
    """1-based position by falling ``value`` within each group, ties by label.

    With ``keep`` Spark cuts every input partition to ``keep`` rows per group
    before the shuffle, so a heavy group never travels whole. Leave it out only
    where the groups are bounded by the number of states or sectors; a ranking of
    everything without it would be one task, and is refused.
    """
    if not within and keep is None:
        raise ValueError("a ranking of everything needs keep")
    labels = [label] if isinstance(label, str) else list(label)
    order = Window.partitionBy(*within).orderBy(
        F.col(value).desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in labels]
    )
    out = df.withColumn(position, F.row_number().over(order))
    return out.where(F.col(position) <= keep) if keep else out


def _top(df: DataFrame, label: str, limit: int | None) -> DataFrame:
    ordered = df.orderBy(F.col("n").desc(), F.col(label).asc_nulls_last())
    return ordered.limit(limit) if limit else ordered


def month_total(d: Openings, month: dt.date | None = None) -> DataFrame:
    """All openings of the month, abroad included; 0 when there are none."""
    return d.in_month(month).agg(
        F.coalesce(F.sum("contagem"), F.lit(0)).cast("long").alias("total")
    )


def top_states(d: Openings, month: dt.date | None = None, limit: int = TOP) -> DataFrame:
    """States by openings, abroad included."""
    return _top(d.in_month(month).groupBy("uf").agg(total().alias("n")), "uf", limit)


def top_sectors(d: Openings, month: dt.date | None = None, uf: str | None = None,
                limit: int = TOP) -> DataFrame:
    """Sectors by openings; codes that share a description count as one."""
    cells = d.in_month(month).where(F.col("cnae_descricao").isNotNull())
    if uf is not None:
        cells = cells.where(F.col("uf") == uf)
    return _top(
        cells.groupBy("cnae_descricao").agg(total().alias("n")), "cnae_descricao", limit
    )


def top_sectors_all(d: Openings, month: dt.date | None = None, limit: int = TOP) -> DataFrame:
    """The leading sectors of every state."""
    per_state = (
        d.in_month(month).where(F.col("cnae_descricao").isNotNull())
        .groupBy("uf", "cnae_descricao").agg(total().alias("n"))
    )
    return ranked(per_state, "n", "cnae_descricao", ["uf"], limit)


def city_label() -> Column:
    return F.concat("municipio", F.lit("/"), "uf")


def top_cities(d: Openings, month: dt.date | None = None, codes: Sequence[str] | None = None,
               uf: str | None = None, limit: int = TOP) -> DataFrame:
    """Cities by openings; a city is its name and state, not its code."""
    cells = d.in_month(month).where(F.col("municipio").isNotNull())
    if codes is not None:
        cells = cells.where(F.col("cnae_principal").isin(*codes))
    if uf is not None:
        cells = cells.where(F.col("uf") == uf)
    cities = cells.groupBy(city_label().alias("cidade")).agg(total().alias("n"))
    return _top(cities, "cidade", limit)


def top_cities_all(d: Openings, month: dt.date | None = None, limit: int = TOP) -> DataFrame:
    """The leading cities of every state."""
    cities = (
        d.in_month(month).where(F.col("municipio").isNotNull())
        .groupBy("uf", city_label().alias("cidade")).agg(total().alias("n"))
    )
    return ranked(cities, "n", "cidade", ["uf"], limit)


def sector_top_states(d: Openings, codes: Sequence[str], month: dt.date | None = None,
                      limit: int = TOP) -> DataFrame:
    """States by openings in a sector given by codes, abroad included."""
    cells = d.in_month(month).where(F.col("cnae_principal").isin(*codes))
    return _top(cells.groupBy("uf").agg(total().alias("n")), "uf", limit)


def state_totals(d: Openings, month: dt.date | None = None) -> DataFrame:
    """Every state, abroad left out: it has no population to compare with."""
    cells = d.in_month(month).where(at_home())
    return _top(cells.groupBy("uf").agg(total().alias("n")), "uf", None)


def with_totals(states: DataFrame, key: str) -> DataFrame:
    """The first states of each ``key``, the total of those shown and of all states."""
    whole = states.groupBy(key).agg(F.sum("n").alias("total_nacional"))
    top = ranked(states, "n", "uf", [key], TOP)
    shown = top.groupBy(key).agg(F.sum("n").alias("total_mostrado"))
    return top.join(shown, key).join(whole, key)


def sector_states(d: Openings, codes: DataFrame, key: Sequence[str],
                  month: dt.date | None = None, abroad: bool = False) -> DataFrame:
    """Openings per ``key`` and state, for all sectors of ``codes`` at once.

    ``codes`` has the key columns and ``cnae_principal``. The cells are summed by
    state and code first, so the lookup multiplies sums, not cells.
    """
    cells = d.in_month(month)
    if not abroad:
        cells = cells.where(at_home())
    sums = cells.groupBy("uf", "cnae_principal").agg(F.sum("contagem").alias("n"))
    return (
        sums.join(codes.select(*key, "cnae_principal").distinct(), "cnae_principal")
        .groupBy(*key, "uf").agg(total("n").alias("n"))
    )
