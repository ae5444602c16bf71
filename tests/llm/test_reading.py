import random

from alvara.llm import pieces, secrets
from alvara.llm.common import table
from alvara.session import materialise


def direct_mb(spark):
    """Memory outside the heap that the JVM's buffers hold."""
    kind = spark._jvm.java.lang.Class.forName("java.lang.management.BufferPoolMXBean")
    pools = spark._jvm.java.lang.management.ManagementFactory.getPlatformMXBeans(kind)
    return sum(p.getMemoryUsed() for p in pools if p.getName() == "direct") / 1e6


def test_reading_keeps_no_buffers_outside_the_heap(spark, tmp_path):
    rng = random.Random(1)
    rows = spark.createDataFrame([(k, rng.randbytes(6_000_000).hex()) for k in range(4)], "id int, text string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/long.parquet")
    docs = table(spark, str(tmp_path), "long")
    before = direct_mb(spark)
    assert docs.selectExpr("max(length(text))", "max(id)").first()[0] == 12_000_000
    assert materialise(docs, "long").selectExpr("max(crc32(text))").first()[0]
    assert direct_mb(spark) - before < 16


def test_blocks_of_secrets_keep_no_buffers_outside_the_heap(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame([(k, rng.randbytes(2_000_000).hex()) for k in range(20)], "block long, x string")
    rows = rows.selectExpr("block", "cast(x as binary) x").coalesce(1)
    before = direct_mb(spark)
    with secrets.told(spark, {"spark.sql.parquet.compression.codec": "snappy", **secrets.BLOCK_PAGES}):
        parts = materialise(rows, "blocks")
    assert parts.selectExpr("sum(length(x))", "max(crc32(x))").first()[0] == 20 * 4_000_000
    assert direct_mb(spark) - before < 32


def test_no_table_of_pieces_outlives_its_task():
    import pyarrow as pa

    path = pieces.piece_model()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two", None])], ["doc_id", "text"])
    assert [r["n_tokens"] for b in pieces._run(path, True, True)(iter([batch])) for r in b.to_pylist()] == [3, 1]
    assert pieces.encoded.cache_info().currsize == 0
