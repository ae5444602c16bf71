import collections

import numpy as np
import pytest

from alvara.llm import embeddings as E


def slow(rows, cosine=E.COSINE):
    groups = collections.defaultdict(list)
    root = {r[0]: r[0] for r in rows}
    links = collections.Counter()
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            groups[label, len(v)].append((i, np.array(v, float)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for own in groups.values():
        for i, v in own:
            for j, w in own:
                if i != j and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= cosine:
                    links[i] += 1
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return {i: (links[i], find(i), find(i) == i) for i in root}


@pytest.mark.parametrize("cell, tile", [(4096, 2048), (60, 20)])
def test_equals_brute_force(spark, monkeypatch, cell, tile):
    monkeypatch.setattr(E, "CELL", cell)
    monkeypatch.setattr(E, "TILE", tile)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 16))
    rows = [(i, [float(np.float32(x)) for x in base[rng.integers(12)] + rng.normal(size=16) * 0.18],
             int(i % 2) if i % 50 else None) for i in range(400)]
    rows += [(2000 + i, rows[5][1], 1) for i in range(40)]
    nan, inf = float("nan"), float("inf")
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [nan] * 16, 1), (3003, [1.0, None], 1), (3004, [1.0, 2.0], 1),
             (3005, [2.0, 4.0], 1), (3006, [], 1), (3007, [inf, 1.0], 1), (3008, [0.0, 1.0], 1), (3009, [-0.0, 1.0], 1)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.near_vectors(frame).collect()}
    assert got == slow(rows)


def test_guests_cover_every_border():
    rng = np.random.default_rng(3)
    v = rng.normal(size=(300, 5))
    v = np.concatenate([v, v + rng.normal(size=v.shape) * 0.15])
    out = E.centres(v, 8)
    home, guest = E.places(v, out, 0.93)
    u = E.unit(v)
    for i, j in zip(*np.nonzero(u @ u.T >= 0.93)):
        assert home[i] == home[j] or guest[i, home[j]] or guest[j, home[i]]


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert E.near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = E.near_vectors(spark.createDataFrame([(None, [1.0], 1), (1, [1.0], 1), (1, [1.0], 1)], schema)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(None, None, None, None), (1, 1, 1, True), (1, 1, 1, True)], key=str)


def test_extreme_components(spark):
    rows = [(1, [1e200, 2e200], 1), (2, [1.01e200, 2e200], 1), (3, [1e-200, 2e-200], 1), (4, [0.01, 1.0], 1),
            (5, [5e-324, 0.0], 2), (6, [1e308, 1e300], 2)]
    found = E.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    got = {r.vec_id: (r.n_links, r.component_id) for r in found}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5)}


def test_query(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    rows = duckdb.execute(f"select vec_id, embedding, label from '{folder}/embeddings.parquet'").fetchall()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.op8_embedding_near_dedup(spark, folder).collect()}
    assert got == slow(rows)
