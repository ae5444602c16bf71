"""Connected components by repeated contraction, and spanning forests inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def forest(n: int, u: np.ndarray, v: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """Smallest node reachable from each of ``n`` nodes over the links ``u``-``v``.

    ``root`` carries what earlier calls on the same nodes found, so that links may
    come in blocks and never have to be kept.
    """
    root = np.arange(n) if root is None else root
    while len(u):
        a, b = root[u], root[v]
        live = a != b
        if not live.any():
            break
        u, v, a, b = u[live], v[live], a[live], b[live]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable.

    Each round points every node at its smallest neighbour, follows that pointer once
    more, and replaces the ends of all links by where they point; links within one
    node vanish. The link table at least halves its nodes each round, so a few
    rounds are enough; each writes its tables to the shared folder. Nothing but
    row counts reaches the driver, neighbours are folded by ``min`` before the
    shuffle, and no node's links are gathered. Loops and repeated links do no harm;
    a link with a null end is left out.
    """
    links = links.where("a is not null and b is not null").select(
        F.col("a").cast("long"), F.col("b").cast("long"))
    links = materialise(links.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = materialise(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
            .select("node", F.least("node", "near").alias("to")), "hooks")
        second = hook.select(F.col("node").alias("to"), F.col("to").alias("further"))
        hook = materialise(
            hook.join(second, "to").select("node", F.col("further").alias("to")), "hooks")
        if labels is None:
            labels = hook.select("node", F.col("to").alias("component"))
        else:
            step = hook.select(F.col("node").alias("component"), "to")
            labels = materialise(labels.join(step, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")), "labels")
        for end in ("a", "b"):
            links = links.join(hook.select(F.col("node").alias(end), "to"), end).drop(end)\
                .withColumnRenamed("to", end)
        links = materialise(links.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
