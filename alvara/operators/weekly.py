"""The weekly aggregate and the merge of overlapping extractions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..sources.aggregate_store import AGGREGATE
from .companies import WINDOW_DAYS

CELL = ["semana", "uf", "municipio_codigo", "municipio", "cnae_principal", "cnae_descricao"]
MERGE_KEY = ["semana", "uf", "municipio_codigo", "cnae_principal"]


def weekly_aggregate(companies: DataFrame, extraction: dt.date) -> DataFrame:
    """Openings per week, state, city and sector; counts combine before the shuffle."""
    day = F.lit(extraction)
    return (
        companies.where(F.col("data_abertura").isNotNull() & F.col("uf").isNotNull())
        .withColumn("semana", dates.week_start("data_abertura"))
        .groupBy(*CELL).agg(F.count(F.lit(1)).alias("contagem"))
        .withColumns({
            "data_extracao": day,
            "semana_parcial": dates.is_partial_week("semana", day),
        })
        .select(*AGGREGATE.names)
    )


def merge_extractions(new: DataFrame, history: DataFrame | None,
                      left_edge: str = "replace", days: int = WINDOW_DAYS,
                      settled_before: dt.date | None = None) -> DataFrame:
    """One row per cell: the newest extraction wins, counts are never added up.

    Between rows of one extraction the new batch wins, so a rerun is repeatable.
    ``left_edge="keep"`` spares whole old counts of the week in which the newer
    window begins: that week is cut on its left, and its short count only stands
    where there is no other.

    ``settled_before`` is a week that the new batch does not reach back beyond.
    Older weeks of a history that was merged before are then passed on as they
    are and stay out of the shuffle.
    """
    if left_edge not in ("replace", "keep"):
        raise ValueError(f"unknown left_edge: {left_edge!r}")
    if history is None:
        return new
    if settled_before is not None:
        settled = history.where(F.col("semana") < F.lit(settled_before))
        touched = history.where(F.col("semana") >= F.lit(settled_before))
        return merge_extractions(new, touched, left_edge, days).unionByName(settled)
    both = new.withColumn("_batch", F.lit(1)).unionByName(
        history.withColumn("_batch", F.lit(0)), allowMissingColumns=True
    )
    order = [
        F.col("data_extracao").desc_nulls_last(), F.col("_batch").desc(),
        F.col("municipio").asc_nulls_last(), F.col("cnae_descricao").asc_nulls_last(),
    ]
    if left_edge == "keep":
        order.insert(0, _cut_on_the_left(days).asc())
    newest = Window.partitionBy(*MERGE_KEY).orderBy(*order)
    return (
        both.withColumn("_rank", F.row_number().over(newest))
        .where("_rank = 1").drop("_rank", "_batch")
    )


def first_week(extraction: dt.date, days: int = WINDOW_DAYS) -> dt.date:
    """The Monday of the week in which the window of an extraction begins."""
    start = extraction - dt.timedelta(days=days)
    return start - dt.timedelta(days=start.weekday())


def _cut_on_the_left(days: int) -> Column:
    return F.col("semana") < F.date_sub("data_extracao", days)
