import pytest
from pyspark.sql import functions as F

from alvara import session


def test_materialise_keeps_rows_and_settings(spark):
    before = spark.conf.get(session.DROP_SHUFFLES, None)
    rows = spark.range(1_000).select((F.col("id") % 7).alias("k")).groupBy("k").count()
    kept = session.materialise(rows, "counts")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, rows.collect()))
    # written again after its shuffles went
    assert session.materialise(rows, "counts").count() == 7
    assert spark.conf.get(session.DROP_SHUFFLES, None) == before


def test_held_settings_come_back_after_an_error(spark):
    spark.conf.set(session.READ_BYTES, "32m")
    try:
        with pytest.raises(ZeroDivisionError), session.held(spark, {session.READ_BYTES: "1m", session.DROP_SHUFFLES: "true"}):
            assert spark.conf.get(session.READ_BYTES) == "1m"
            1 / 0
        assert spark.conf.get(session.READ_BYTES) == "32m"
    finally:
        spark.conf.unset(session.READ_BYTES)
    assert spark.conf.get(session.DROP_SHUFFLES, None) is None
