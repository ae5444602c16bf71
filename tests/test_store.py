"""The ledger's commits, and versions of the aggregate by week."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alvara.operators.weekly import first_week, merge_extractions
from alvara.plans import monthly
from alvara.sources import aggregate_store as store
from alvara.sources import ledger

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("dia", T.DateType()),
                       T.StructField("nome", T.StringType())])
JULY, AUGUST = dt.date(2026, 7, 11), dt.date(2026, 8, 8)


def test_records_are_numbered_and_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "FOLD_EVERY", 4)
    root = str(tmp_path / "ledger")
    assert ledger.newest(spark, root) == 0 and ledger.read(spark, root, SCHEMA).count() == 0
    for n in range(10):
        assert ledger.append(spark, root, SCHEMA, [(n, dt.date(2026, 1, n + 1), 'ação "x"\n'), (n, None, None)]) == n + 1
    found = ledger.read(spark, root, SCHEMA)
    assert sorted(r.n for r in found.collect()) == sorted([*range(10)] * 2)
    assert {r.nome for r in found.collect()} == {'ação "x"\n', None}
    assert found.where("n = 3").agg(F.max("dia")).first()[0] == dt.date(2026, 1, 4)
    opened = {Path(f).name if f.endswith("json") else Path(f).parent.name for f in found.inputFiles()}
    assert opened == {"000000000008.fold", "000000000009.json", "000000000010.json"}
    assert ledger.read(spark, root, SCHEMA, upto=9).count() == 18


def test_of_two_writers_one_commits(spark, tmp_path):
    root = str(tmp_path / "ledger")
    ledger.append(spark, root, SCHEMA, [(0, None, "first")])
    seen = ledger.newest(spark, root)
    ledger.append(spark, root, SCHEMA, [(1, None, "theirs")], after=seen)
    with pytest.raises(ledger.Conflict):
        ledger.append(spark, root, SCHEMA, [(1, None, "mine")], after=seen)
    assert [r.nome for r in ledger.read(spark, root, SCHEMA).orderBy("n").collect()] == ["first", "theirs"]
    # the rename itself refuses, too, when the other one commits in between
    (tmp_path / "draft").write_text("x")
    assert not ledger._rename_new(spark, str(tmp_path / "draft"), f"{root}/000000000002.json")


def cells(spark, weeks, extraction, count):
    rows = [(week, "SP", str(i), "M", "56", "D", count, extraction, week + dt.timedelta(days=6) > extraction)
            for week in weeks for i in range(20)]
    return spark.createDataFrame(rows, store.AGGREGATE)


def mondays(last, count):
    return [last - dt.timedelta(days=last.weekday() + 7 * k) for k in range(count)]


def files(frame):
    found = {}
    for r in frame.select("semana", F.col("_metadata.file_path").alias("f")).distinct().collect():
        found.setdefault(r.semana, set()).add(r.f)
    return found


def test_settled_weeks_keep_their_files(spark, tmp_path):
    root, history = str(tmp_path), mondays(JULY, 30)
    store.publish(cells(spark, history, JULY, 1), root)
    before, whole = files(store.current(spark, root)), store.current(spark, root)
    new = cells(spark, mondays(AUGUST, 13), AUGUST, 2)
    expected = sorted(map(tuple, merge_extractions(new, whole, settled_before=first_week(AUGUST)).collect()))
    monthly.publish_month(spark, new, AUGUST, root)
    after = files(store.current(spark, root))
    settled = [week for week in history if week < first_week(AUGUST)]
    assert len(settled) > 10 and all(after[week] == before[week] for week in settled)
    assert all(not after[week] & before.get(week, set()) for week in mondays(AUGUST, 13))
    assert sorted(map(tuple, store.current(spark, root).collect())) == expected
    assert store.current(spark, root, since=first_week(AUGUST)).count() == 14 * 20
    assert whole.count() == 600  # a reader of the former version is not disturbed


def test_interleaved_publishers_lose_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    store.publish(cells(spark, mondays(JULY, 20), JULY, 1), root)
    old = store.base(spark, root)
    with pytest.raises(ValueError, match="are to be kept"):
        store.publish(cells(spark, mondays(JULY, 20), AUGUST, 9), root, kept_before=first_week(AUGUST))
    extra, merge, turns = cells(spark, [first_week(JULY)], JULY, 7), monthly.merge_extractions, []

    def slow(*args):
        turns.append(1)
        if len(turns) == 1:  # another publisher is quicker
            store.publish(extra, root, kept_before=first_week(JULY), after=old)
        return merge(*args)

    monkeypatch.setattr(monthly, "merge_extractions", slow)
    monthly.publish_month(spark, cells(spark, mondays(AUGUST, 5), AUGUST, 2), AUGUST, root)
    assert len(turns) == 2 and store.base(spark, root) == old + 2
    sums = dict(store.current(spark, root).groupBy("semana").agg(F.sum("contagem")).collect())
    assert sums[first_week(JULY)] == 140 and sums[mondays(AUGUST, 5)[0]] == 40
    with pytest.raises(ledger.Conflict):
        store.publish(extra, root, kept_before=first_week(JULY), after=old)


def test_an_aggregate_without_rows(spark, tmp_path):
    assert store.current(spark, str(tmp_path)) is None
    store.publish(spark.createDataFrame([], store.AGGREGATE), str(tmp_path))
    assert store.current(spark, str(tmp_path)).count() == 0
