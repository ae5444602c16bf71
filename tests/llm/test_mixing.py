import collections

from pyspark.sql import functions as F

from alvara.llm import mixing as M


def documents(spark):
    rows = [(k, "w " * (1 + k % 13), "hot" if k % 3 else f"s{k % 7}", 1) for k in range(600)]
    rows += [(600, None, "hot", 1), (601, "", None, 1), (602, "x y", None, 1), (None, "a b c", "s1", 1), (5, "w w", "hot", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int")


def test_weights_budgets_and_blocks(spark):
    docs = documents(spark)
    rows, quota = M.plan(docs)
    quota = {r.source: r for r in quota.collect()}
    seen = {s: q.epochs + q.part for s, q in quota.items()}
    assert abs(min(seen.values()) - 1) < 1e-6 and max(seen.values()) <= M.REPEAT + 1e-9
    assert max(seen.values()) > M.REPEAT - 0.01
    assert abs(sum(q.weight for q in quota.values()) - 1) < 1e-9
    placed = M.blocks(rows, 500).collect()
    per = collections.defaultdict(list)
    for r in placed:
        per[r.source, r.epoch].append(r)
    for (source, epoch), own in per.items():
        q = quota[source]
        tokens = sum(r.tokens for r in own)
        if epoch <= q.epochs:
            assert tokens == q.tokens
        else:
            assert tokens <= q.part * q.tokens + 1e-6
            # what was left out comes later in the order of the hash
            first = {(r.doc_id, r.tokens) for r in own}
            assert len(first) <= len(per[source, 1])
    blocks = collections.defaultdict(list)
    for r in placed:
        blocks[r.block].append(r.place)
    assert all(sorted(v) == list(range(len(v))) for v in blocks.values())
    assert set(blocks) == set(range(max(blocks) + 1))
    hot = {b: sum(r.tokens for r in placed if r.block == b and r.source == "hot") / sum(r.tokens for r in placed if r.block == b)
           for b in blocks}
    assert all(abs(h - quota["hot"].weight) < 0.2 for h in hot.values())


def test_rows_follow_the_plan(spark):
    docs = documents(spark)
    out = M.mixed(docs)
    assert out.columns == docs.columns
    rows, _ = M.plan(docs)
    count = [collections.Counter(r[0] for r in x.select("doc_id").collect()) for x in (out, rows)]
    assert count[0] == count[1] and len(count[0]) == 604
    assert collections.Counter(r[0] for r in M.mixed(docs).select("doc_id").collect()) == count[0]


def test_entropy_and_edges(spark):
    shares = spark.createDataFrame([(0.7,), (0.2,), (0.1,)], "p double")
    a = M.exponent(shares, entropy=1.0)
    weights = [p ** a for p in (0.7, 0.2, 0.1)]
    import math

    entropy = -sum(w / sum(weights) * math.log(w / sum(weights)) for w in weights)
    assert 1.0 <= entropy < 1.001
    assert M.exponent(shares, entropy=9.0) == 0 and M.exponent(shares.where("false")) == 1
    docs = documents(spark)
    assert M.mixed(docs.where("false")).count() == 0
    one = docs.where(F.col("source") == "hot")
    assert M.mixed(one).count() == one.count()
