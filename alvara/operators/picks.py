"""Picking: one signature sector per state, and the next entry of each queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..sources import ledger
from .rankings import ranked

SIGNATURES = 8
USED = T.StructType([
    T.StructField("extracao", T.StringType()), T.StructField("fila", T.StringType()),
    T.StructField("ciclo", T.IntegerType()), T.StructField("chave", T.StringType()),
])


def signature_sectors(quotients: DataFrame, within: Sequence[str] = (),
                      keep: int = SIGNATURES) -> DataFrame:
    """Walk down the quotients; take a row if its state and its trade are both new.

    The walk is sequential, but only few candidates can ever be taken:

    * of rows with the same state and trade, the first;
    * of one state, the first ``keep`` trades, since fewer than ``keep`` trades
      are used up before the walk ends; likewise the first ``keep`` states of a
      trade;
    * so at most ``keep + 2 * (keep - 1) ** 2`` rows come up before the last pick.

    Those cuts are ranked windows that shrink the data where it lies. What is
    gathered for the walk is the bounded rest, per ``within`` group.
    """
    within = list(within)
    ties = ["uf", "cnae_principal"]

    def first(df: DataFrame, group: list[str], n: int) -> DataFrame:
        return ranked(df, "lq", ties, [*within, *group], n, "_rank").drop("_rank")

    rows = quotients.where(F.col("descricao").isNotNull() & F.col("lq").isNotNull()).select(
        *within, "uf", "cnae_principal", "descricao", "lq",
        text.description_key("descricao").alias("_trade"),
    )
    rows = first(rows, ["uf", "_trade"], 1)
    rows = first(rows, ["uf"], keep)
    rows = first(rows, ["_trade"], keep)
    rows = first(rows, [], keep + 2 * (keep - 1) ** 2)

    candidate = F.struct(
        (-F.col("lq")).alias("order"), "uf", "cnae_principal", "descricao", "lq", "_trade"
    )
    gathered = rows.groupBy(*within).agg(F.array_sort(F.collect_list(candidate)).alias("_all"))

    def take(taken: Column, row: Column) -> Column:
        clash = F.exists(
            taken, lambda t: (t["uf"] == row["uf"]) | (t["_trade"] == row["_trade"])
        )
        return F.when((F.size(taken) >= keep) | clash, taken).otherwise(
            F.concat(taken, F.array(row))
        )

    # The empty start has the type of the array it grows into.
    nothing = F.filter("_all", lambda row: F.lit(False))
    return (
        gathered.select(*within, F.posexplode(F.aggregate("_all", nothing, take)))
        .select(
            *within, (F.col("pos") + 1).cast("int").alias("posicao"), "col.uf",
            "col.cnae_principal", "col.descricao", "col.lq",
        )
    )


def next_unused(catalogue: DataFrame, used: DataFrame) -> DataFrame:
    """The entry each queue of each extraction should show next, and its cycle.

    ``catalogue``: ``extracao, fila, posicao, chave``; ``used``: ``extracao, fila,
    ciclo, chave``. The first entry in catalogue order that the current cycle has not
    shown comes next, also one that joined the catalogue late. When all have been
    shown, the next cycle starts with the first entry. A new extraction has no uses
    yet, which resets its queues.
    """
    queue = ["extracao", "fila"]
    current = used.groupBy(*queue).agg(F.max("ciclo").alias("ciclo"))
    entries = catalogue.select(*queue, "posicao", "chave").join(current, queue, "left").withColumn(
        "ciclo", F.coalesce("ciclo", F.lit(1))
    )
    entry = F.min(F.struct("posicao", "chave"))
    left = entries.join(used, [*queue, "ciclo", "chave"], "left_anti").groupBy(*queue).agg(
        entry.alias("_next")
    )
    return (
        entries.groupBy(*queue).agg(entry.alias("_first"), F.max("ciclo").alias("_cycle"))
        .join(left, queue, "left")
        .withColumn("_pick", F.coalesce("_next", "_first"))
        .select(
            *queue, (F.col("_cycle") + F.when(F.col("_next").isNull(), 1).otherwise(0))
            .cast("int").alias("ciclo"),
            F.col("_pick.posicao").alias("posicao"), F.col("_pick.chave").alias("chave"),
        )
    )


def record_use(picks: DataFrame, root: str) -> None:
    """Append picks to the state table; call it after they have been delivered.

    One row for each queue, so they go through the ledger, whole or not at all.
    """
    rows = [tuple(r) for r in picks.select("extracao", "fila", "ciclo", "chave").collect()]
    ledger.append(picks.sparkSession, root, USED, rows)


def read_uses(spark: SparkSession, root: str) -> DataFrame:
    """What has been recorded so far; empty at first."""
    return ledger.read(spark, root, USED)


def read_queue_file(spark: SparkSession, path: str) -> DataFrame:
    """A JSON queue state, which knows its running cycle only, as rows of cycle 1.

    A file of the older shape (one plain list) counts as empty.
    """
    schema = "data_extracao string, usados map<string, array<string>>"
    state = spark.read.schema(schema).option("multiLine", "true").json(path)
    return state.select(
        F.col("data_extracao").alias("extracao"), F.explode("usados").alias("fila", "_keys")
    ).select("extracao", "fila", F.lit(1).alias("ciclo"), F.explode("_keys").alias("chave"))
