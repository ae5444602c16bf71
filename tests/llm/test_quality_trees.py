import zlib

import numpy as np

from alvara.llm import quality_trees as qt

FOLDER = "/root/testdata/sf0.1"


def area(score, label):
    order = np.argsort(np.argsort(score)) + 1
    good = label == 1
    return (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def walk(trees, row):
    """The same trees, one node after the other."""
    total = trees.start
    for feature, above, value in zip(trees.feature.tolist(), trees.above.tolist(), trees.value.tolist()):
        at = 0
        while at < len(feature):
            at = 2 * at + 1 + int(row[feature[at]] > above[at])
        total += value[at - len(feature)]
    return 1 / (1 + np.exp(-total))


def test_flat_walk_and_gain():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, len(qt.NAMES)))
    y = ((x[:, 3] > 0.2) ^ (x[:, 5] > 0)).astype(float)
    trees = qt.train(x[:400], y[:400], trees=30)
    found = trees.scores(x)
    assert np.allclose(found[:40], [walk(trees, r) for r in x[:40].tolist()])
    assert ((found[400:] > 0.5) == (y[400:] == 1)).mean() > 0.9


def test_first_split_is_the_best_cut():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 9, (200, len(qt.NAMES))).astype(float)
    y = (x[:, 7] > 4).astype(float)
    tree = qt.train(x, y, trees=1, depth=1)
    p = y.mean()
    gain = {}
    for f in range(x.shape[1]):
        for c in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= c
            g, h = p - y, np.full(len(y), p * (1 - p))
            gain[f, c] = sum(g[s].sum() ** 2 / (h[s].sum() + qt.RIDGE) for s in (left, ~left))
    assert max(gain, key=gain.get) == (tree.feature[0, 0], tree.above[0, 0]) == (7, 4)


def test_held_out_labels(spark):
    rows = qt.op12_quality_classifier(spark, FOLDER).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    label = np.array([labels[r["doc_id"]] for r in held])
    score = np.array([r["score"] for r in held])
    print(area(score, label), ((score >= 0.3) == label).mean(), (score[label == 1] >= 0.3).mean(), (score[label == 0] < .3).mean())
    assert area(score, label) > 0.97 and ((score >= 0.3) == label).mean() > 0.95


def test_held_out_labels_have_no_effect(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality", "toxic")
    a, b = (sorted(map(tuple, qt.quality_scores(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_odd_rows(spark):
    odd = [(1, None), (2, ""), (2, ""), (None, "some words"), (3, "word " * 300_000), (4, "\n \n"), (5, "é" * 100_000)]
    docs = spark.createDataFrame([(*r, 0.5, "x") for r in odd], "doc_id long, text string, score double, stats string")
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (2, 0), (3, 1), (4, None), (9, 1), (None, 1)], "doc_id long, quality int")
    found = qt.quality_scores(docs, labels).collect()
    assert len(found) == len(odd) and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (1, 2)}) == 1
    assert {r["score"] for r in qt.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert qt.quality_scores(docs.limit(0), labels).count() == 0
