"""Embedding near-duplicates: spherical k-means cells, cosine products within cells.

Centres are fitted on a bounded sample and only decide which vectors meet; links do not
depend on them. A vector's home is the cell whose centre it is closest to. Two linked
vectors lie within the angle of the threshold, so the great circle from one home to
another crosses the plane between both centres, and one of the two vectors lies within
half that angle of the plane. Such a vector is also sent to the other cell, as a guest.
So every link is found in some cell, and none is lost at a border.

Equal vectors are folded first. A cell is compared in tiles of bounded size: a hot cell
becomes many tasks. A tile pair gives back counts of links and a spanning forest of
them, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, tidy
from .components import components, forest

COSINE = 0.93
#: Vectors that the centres are fitted on, at most.
SAMPLE = 20_000
#: Vectors for each cell, on average; the number of cells is bounded by the sample.
CELL = 4_096
TILE = 2_048
BLOCK = 256


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, since squares of extreme components leave the range."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def centres(sample: np.ndarray, cells: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Unit centres by spherical k-means; a cell that runs empty keeps its centre."""
    vectors = unit(sample)
    out = vectors[np.random.default_rng(seed).choice(len(vectors), min(cells, len(vectors)), replace=False)]
    for _ in range(rounds):
        home = (vectors @ out.T).argmax(1)
        for k in range(len(out)):
            total = vectors[home == k].sum(0)
            if np.sqrt(total @ total) > 1e-9:
                out[k] = total / np.sqrt(total @ total)
    return out


def places(vectors: np.ndarray, out: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector, and whether it is a guest of each other cell."""
    near = unit(vectors) @ out.T
    home = near.argmax(1)
    # distance from the plane between two centres, as the sine of an angle
    gap = np.sqrt(np.maximum(2 - 2 * out @ out.T, 0))[home]
    half = math.sin(math.acos(cosine) / 2) + 1e-9
    guest = near[np.arange(len(near)), home][:, None] - near <= half * gap
    guest[np.arange(len(near)), home] = False
    return home, guest


def _assign(out: np.ndarray, cosine: float):
    dims = out.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            if frame.empty:
                continue
            # vectors of another length than the centres share one cell for each length
            size = np.array([len(v) for v in frame["vector"]])
            usual = size == dims
            home, guests = -1 - size, [[] for _ in size]
            if usual.any():
                h, g = places(np.stack(list(frame["vector"][usual])).astype(float), out, cosine)
                home[usual] = h
                for at, row in zip(np.nonzero(usual)[0], g):
                    guests[at] = np.nonzero(row)[0].tolist()
            frame["home"], frame["guests"] = home.astype(np.int32), guests
            yield pa.RecordBatch.from_pandas(
                frame[["rep", "label", "vector", "weight", "home", "guests"]], preserve_index=False,
                schema=pa.schema([
                    ("rep", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.float64())),
                    ("weight", pa.int64()), ("home", pa.int32()), ("guests", pa.list_(pa.int32()))]))
    return run


def _compare(cosine: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[0]
        cell = int(first["cell"])
        same = bool(not first["visiting"] and first["i"] == first["j"])
        side = group["second"].to_numpy()
        left, right = group[~side], group[~side] if same else group[side]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        a, b = (np.stack(list(x["vector"])).astype(float) for x in (left, right))
        a, b = unit(a), unit(b)
        wa, wb = left["weight"].to_numpy(np.int64), right["weight"].to_numpy(np.int64)
        ra, rb = left["rep"].to_numpy(np.int64), right["rep"].to_numpy(np.int64)
        allowed = None
        if first["visiting"]:
            # both homes may see a pair: it counts at the lower one then
            home = right["home"].to_numpy()
            allowed = np.array([[cell < h or h not in set(g) for h in np.unique(home)] for g in left["guests"]])
            allowed = allowed[:, np.searchsorted(np.unique(home), home)]
        n = len(a)
        root = np.arange(n if same else n + len(b))
        links_a, links_b = np.zeros(n, np.int64), np.zeros(len(b), np.int64)
        for at in range(0, n, BLOCK):
            rows = slice(at, at + BLOCK)
            close = a[rows] @ b.T >= cosine
            if allowed is not None:
                close &= allowed[rows]
            i, j = np.nonzero(close)
            i += at
            keep = i != j if same else slice(None)
            i, j = i[keep], j[keep]
            np.add.at(links_a, i, wb[j])
            if not same:
                np.add.at(links_b, j, wa[i])
            root = forest(len(root), i, j if same else j + n, root)
        reps = ra if same else np.concatenate([ra, rb])
        counts = links_a if same else np.concatenate([links_a, links_b])
        linked = np.nonzero(root != np.arange(len(root)))[0]
        some = np.nonzero(counts)[0]
        none = np.full(len(some), -1)
        return pd.DataFrame({
            "a": np.concatenate([reps[some], reps[root[linked]]]),
            "b": np.concatenate([none, reps[linked]]),
            "n": np.concatenate([counts[some], np.zeros(len(linked), np.int64)])})
    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label).

    Two vectors are linked if their labels are equal and not null and their cosine in
    double precision is at least ``cosine``. Vectors that are null, empty, zero, or hold
    null or non-finite components are linked with nothing, nor are vectors of different
    length. ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest vec_id reachable, and ``kept`` marks the row that has it. Repeated rows are
    vectors of their own; rows without vec_id get null for both. Further columns are
    ignored, an empty table gives an empty result.
    """
    every = tidy(vectors, vec_id="long", embedding="array<double>", label="long")
    good = F.expr(
        "label is not null and embedding is not null and size(embedding) > 0 and forall(embedding, x -> "
        "x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(embedding, x -> x <> 0)")
    every = materialise(every.withColumn("usable", F.coalesce(good, F.lit(False)) & F.col("vec_id").isNotNull()), "vectors")
    usable = every.where("usable")
    # -0.0 equals 0.0; groups need one form
    folded = materialise(
        usable.withColumn("vector", F.expr("transform(embedding, x -> x + 0D)")).groupBy("label", "vector").agg(
            F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight")), "folded")
    count = folded.count()
    if count:
        dims = folded.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()["size"]
        chosen = folded.where(F.size("vector") == dims).orderBy(F.xxhash64("rep", "label"), "rep").limit(sample)
        fitted = np.array([r["vector"] for r in chosen.select("vector").collect()])
        cells = max(1, min(-(-count // CELL), sample // 16))
        out = centres(fitted, cells)
        placed = materialise(
            folded.select("rep", "label", "vector", "weight").mapInArrow(
                _assign(out, cosine),
                "rep long, label long, vector array<double>, weight long, home int, guests array<int>"), "placed")
        sizes = placed.select("label", F.col("home").alias("cell"), F.lit(0).alias("role")).unionAll(
            placed.select("label", F.explode("guests").alias("cell"), F.lit(1).alias("role"))).groupBy(
            "label", "cell").agg(*[
                F.greatest(F.ceil(F.count_if(F.col("role") == k) / TILE), F.lit(1)).cast("int").alias(n)
                for k, n in enumerate(["homes", "visits"])])
        sizes = materialise(sizes, "sizes")
        home = placed.withColumn("cell", F.col("home")).join(sizes, ["label", "cell"])
        home = home.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("homes")).cast("int"))
        guest = placed.withColumn("cell", F.explode("guests")).join(sizes, ["label", "cell"])
        guest = guest.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("visits")).cast("int"))
        keys = ["label", "cell", "visiting", "i", "j"]
        cols = ["rep", "vector", "weight", "home", "guests"]

        def part(rows, visiting, second, i, j):
            out_rows = rows.select(
                "label", "cell", F.lit(visiting).alias("visiting"), F.lit(second).alias("second"),
                "chunk", *cols, F.explode(F.expr(i if second else j)).alias("other"))
            mine, other = F.col("chunk"), F.col("other")
            return out_rows.select(
                *keys[:3], (other if second else mine).alias("i"), (mine if second else other).alias("j"),
                "second", *cols)

        tiles = part(home, False, False, "", "sequence(chunk, homes - 1)").unionByName(
            part(home.where("chunk > 0"), False, True, "sequence(0, chunk - 1)", "")).unionByName(
            part(home, True, False, "", "sequence(0, visits - 1)")).unionByName(
            part(guest, True, True, "sequence(0, homes - 1)", ""))
        found = materialise(tiles.groupBy(*keys).applyInPandas(_compare(cosine), "a long, b long, n long"), "found")
        links = found.where("b = -1 and n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
        member = components(found.where("n = 0").select("a", "b"))
        reps = folded.join(links, "rep", "left").join(member.withColumnRenamed("node", "rep"), "rep", "left").select(
            "label", "vector", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"))
        named = usable.withColumn("vector", F.expr("transform(embedding, x -> x + 0D)")).join(
            reps, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    else:
        named = every.where("false").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    alone = every.where("not usable").select(
        "vec_id", F.when(F.col("vec_id").isNotNull(), F.lit(0)).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"))
    return named.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))
