import collections
import zlib

from alvara.llm import sharding


def shards_of(spark, rows):
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, shard int")
    placed = sharding.shard_documents(docs)
    return placed, placed.collect()


def test_law_slots_and_links(spark):
    rows = [(i, f"text {i % 90}" if i % 2 else ("hot" if i % 3 else f"only {i}")) for i in range(400)]
    rows += [(500, None), (501, None), (502, ""), (503, ""), (7, "text 7"), (7, "text 7"), (None, "é" * 30_000)]
    placed, found = shards_of(spark, rows)
    assert len(found) == len(rows)
    count = collections.Counter(r.shard for r in found)
    assert max(count.values()) - min(count.values()) <= 1 and set(count) == set(range(8))
    for shard, n in count.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
    for r in found:
        if r.doc_id is not None and r.doc_id < 400:
            text = dict(rows[:400])[r.doc_id]
            assert (r.size, r.crc) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
    assert {r.size for r in found if r.doc_id in (500, 502)} == {1}
    cut = sharding.cut_links(placed).first()
    hot = sum(t == "hot" for _, t in rows)
    # a group that fills shards must be cut, others only where it displaced them
    assert hot - max(count.values()) <= cut.cut <= hot - max(count.values()) + 60


def test_few_and_no_rows(spark):
    assert shards_of(spark, [])[1] == []
    assert sorted(r.shard for r in shards_of(spark, [(1, "a"), (2, "a"), (3, None)])[1]) == [0, 1, 2]


def test_query(spark):
    rows = sharding.op1_sharding(spark, "/root/testdata/sf0.001").collect()
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)


def test_few_links_are_cut_where_all_rows_have_copies(spark):
    for size in (2, 5):
        docs = spark.range(20_000).selectExpr("id doc_id", f"'text ' || (id div {size}) text")
        placed = sharding.materialise(sharding.shard_documents(docs), "placed")
        assert {r["count"] for r in placed.groupBy("shard").count().collect()} == {2_500}
        links, cut = sharding.cut_links(placed).first()
        assert links == 20_000 - 20_000 // size
        print("cut", size, cut, links)
        assert cut <= links // 50
