"""What a monthly run reads, and the plans over staged tables."""

import time

import pytest
from pyspark.sql import functions as F
from test_files import LAYOUT, shard, write_month

from alvara import session
from alvara.operators.companies import new_companies
from alvara.plans import monthly
from alvara.registered import queries
from alvara.registered.analog import EXTRACTION, Analog
from alvara.sources import registry_csv, spanning
from alvara.sources.layout import Layout

FOLDER = "/root/testdata/sf0.001"


def executed(spark):
    return spark._jsparkSession.sharedState().statusStore().executionsList()


def raw_scans(spark, since, folder):
    """Reads of raw lines by the executions after number ``since``, by table."""
    found, runs = {}, executed(spark)
    for i in range(runs.size()):
        run = runs.apply(i)
        plan = run.physicalPlanDescription()
        if run.executionId() > since and ("Scan text" in plan or "Scan csv" in plan):
            for table in LAYOUT.tables:
                times = sum(f"{folder}/{table}" in line for line in plan.splitlines() if "Location" in line)
                if times:
                    found[table] = found.get(table, 0) + times
    return found


def last_execution(spark):
    runs = executed(spark)
    return max((runs.apply(i).executionId() for i in range(runs.size())), default=-1)


def test_a_month_reads_every_shard_once(spark, tmp_path):
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    people = [(f"{i:08d}", f"202605{4 + i % 25:02d}") for i in range(60)]
    places = write_month(tmp_path, "2026-06", "60613", people)
    shard(tmp_path / "raw/2026-06/naturezas", "naturezas", ['"2062";"Soc\x80 Limitada\x81"'], 0, "60613")
    since = last_execution(spark)
    monthly.run_month(spark, places, "2026-06", bounds=(10, 100))
    assert raw_scans(spark, since, f"{tmp_path}/raw/2026-06") == dict.fromkeys(LAYOUT.tables, 1)
    report = {r.rule: r for r in spark.read.parquet(places.report("2026-06")).collect()}
    assert report["control_characters"].observed == "2" and "NATJU" in report["control_characters"].subject
    spark.conf.set("spark.sql.maxMetadataStringLength", before)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_only_shards_with_spanning_values_are_read_again(spark, tmp_path, ending):
    raw = tmp_path / "raw" / "2026-06"
    for table, spec in LAYOUT.tables.items():
        shard(raw / table, table, [";".join("x" for _ in spec.columns)])
    spanning = ending.join(['"1";"a', 'b\x85"', "", '"2";"c"', '"3";"d', "", 'e"']) + ending
    for number, text in enumerate((spanning, '"4";"f"' + ending + "  " + ending + '"5";"g\x90"' + ending)):
        (raw / "cnaes" / f"F.K0320{number}$Z.D60613.CNAECSV").write_bytes(text.encode("latin-1"))
    args = (spark, str(tmp_path / "raw"), str(tmp_path / "work"), "2026-06")
    staged = registry_csv.stage(*args)["cnaes"]
    inner = [(r.codigo, r.descricao) for r in staged.where("codigo <> 'x'").orderBy("codigo").collect()]
    assert inner == [("1", f"a{ending}b?"), ("2", "c"), ("3", f"d{ending * 2}e"), ("4", "f"), ("5", "g?")]
    facts = registry_csv.shard_facts(spark, args[2], "2026-06").where("tabela = 'cnaes'")
    assert sorted(tuple(r) for r in facts.select("linhas", "trocados").collect()) == [(1, 0), (2, 1), (3, 1)]
    plain = registry_csv.scan(spark, str(raw / "cnaes"), "cnaes", LAYOUT)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, staged.collect()))


def test_only_spanning_lines_are_shuffled(spark, tmp_path):
    text = "".join(f'"{i}";"{"a" * 50}"\n' for i in range(3000)) + '"x";"1\n2\n3"\n' + '"y";"4\n5"\n'
    (tmp_path / "a.csv").write_text(text)
    (tmp_path / "b.csv").write_text('"z";"6\n7"\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        found = spanning.records(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "ISO-8859-1")
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 3003 and {r.record for r in rows} >= {'"x";"1\n2\n3"', '"y";"4\n5"', '"z";"6\n7"'}
    shuffled = [n for n in nodes(found._jdf.queryExecution().executedPlan()) if n.nodeName() == "Exchange"]
    written = [n.metrics().apply("shuffleRecordsWritten").value() for n in shuffled]
    assert written and max(written) < 100


def test_staging_looks_through_a_line_once(spark, tmp_path):
    """Control characters are replaced and counted in the whole record, not column by column."""
    spec = LAYOUT.tables["estabelecimentos"]
    values = ["a\x80b", "\x9f", "\xe9\x85\xe9", "plain"] + ["x"] * (len(spec.columns) - 4)
    shard(tmp_path, "estabelecimentos", [";".join(f'"{v}"' for v in values)])
    found = registry_csv._staged_rows(
        registry_csv._parsed_lines(spark, str(tmp_path), "estabelecimentos", LAYOUT), spec)
    row = found.first()
    assert row[:4] == ("a?b", "?", "\xe9?\xe9", "plain") and row[registry_csv.REPLACED] == 3
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") <= 4, plan.count("translate(")


def test_shards_are_written_by_the_tasks_that_make_them(spark, tmp_path):
    rows = spark.range(100, numPartitions=3).selectExpr("cast(id as string) codigo", "'d' descricao")
    queries._write_shards(rows, LAYOUT.tables["cnaes"], str(tmp_path / "a"))
    assert len(list((tmp_path / "a").glob("*.csv"))) == 3
    assert spark.read.csv(str(tmp_path / "a"), sep=";").count() == 100


def test_blank_lines_are_looked_for_before_a_line_is_decoded(spark, tmp_path):
    spec = LAYOUT.tables["cnaes"]
    tmp_path.joinpath("F.K03200$Z.D60613.CNAECSV").write_bytes(b'"1";"a"\r\n\r\n   \n\n \r\n"2";"b\n"3";"c"\r\n')
    found = registry_csv._staged_rows(registry_csv._parsed_lines(spark, str(tmp_path), "cnaes", LAYOUT), spec)
    assert [(r.codigo, r[registry_csv.JOINED]) for r in found.orderBy("codigo").collect()] == [
        ("1", False), ("2", True), ("3", False)]
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert [line for line in plan if "Filter" in line] and not any("decode(" in line for line in plan if "Filter" in line)


@pytest.fixture
def packed(spark):
    """The layout of packed shards, of two tables."""
    layout = queries._shards(Analog(spark, FOLDER))
    return Layout({name: layout.tables[name] for name in ("cnaes", "estabelecimentos")}, (), layout.csv)


def test_packed_shards_are_small_and_hold_the_same_rows(spark, packed, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "SHARD_ROWS", 10)
    path = tmp_path / "raw" / "2026-06"
    for table, spec in packed.tables.items():
        values = spark.range(100, numPartitions=3).select(
            F.col("id").cast("string").alias(spec.columns[0]), F.lit('a";\x85é').alias(spec.columns[1]))
        queries._write_shards(values, spec, str(path / table))
        names = [f.name for f in (path / table).glob("part-*")]
        assert len(names) == 12 and all(name.endswith(".csv.gz") for name in names)
    expected = sorted((str(i), 'a";?é') for i in range(100))
    scanned = registry_csv.scan(spark, str(path / "cnaes"), "cnaes", packed)
    assert sorted(map(tuple, scanned.collect())) == expected
    staged = registry_csv.stage(spark, str(tmp_path / "raw"), str(tmp_path / "work"), "2026-06", packed)
    assert sorted(map(tuple, staged["cnaes"].collect())) == expected
    assert staged["estabelecimentos"].count() == 100


def test_packed_shards_are_sorted_few_at_a_time(spark, packed, tmp_path, monkeypatch):
    """A task reads no more packed shards than it can sort in memory, whatever the session's own bound."""
    path = tmp_path / "raw" / "2026-06"
    for table, spec in packed.tables.items():
        rows = spark.range(60, numPartitions=6).select(F.col("id").cast("string").alias(spec.columns[0]))
        queries._write_shards(rows, spec, str(path / table))
    monkeypatch.setattr(registry_csv, "SORTED_BYTES", "1b")
    spark.conf.set(session.READ_BYTES, "128m")
    try:
        registry_csv.stage(spark, str(tmp_path / "raw"), str(tmp_path / "work"), "2026-06", packed)
        assert spark.conf.get(session.READ_BYTES) == "128m"
    finally:
        spark.conf.unset(session.READ_BYTES)
    parts = (tmp_path / "work" / "extracao=2026-06" / "cnaes").rglob("part-*.parquet")
    assert len({f.name.split("-")[1] for f in parts}) == 6  # tasks that wrote


def shuffle_files(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def test_shuffles_behind_shards_go_with_their_write(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(100).repartition(3, "id").select(F.col("id").cast("string").alias("codigo"))
    queries._write_shards(rows, LAYOUT.tables["cnaes"], str(tmp_path / "a"))
    until = time.time() + 20
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.1)
    assert shuffle_files(spark) <= before


def test_line_items_are_shuffled_twice_at_most(no_broadcast):
    plan = Analog(no_broadcast, FOLDER).establishments()._jdf.queryExecution().executedPlan().toString()
    keys = [k for k in ("c_custkey", "o_custkey", "l_orderkey", "l_partkey") if f"hashpartitioning({k}" in plan]
    assert keys == ["c_custkey", "o_custkey", "l_orderkey", "l_partkey"]
    wide = [line for line in plan.splitlines() if "hashpartitioning(o_custkey" in line]
    item = plan[plan.index("hashpartitioning(o_custkey"):].split("hashpartitioning(c_custkey")[0]
    assert len(wide) == 1 and "l_orderkey" not in item


def test_line_items_meet_their_parts_with_few_columns(no_broadcast):
    """What is only tested lies in the shuffles as its outcome, days as dates, names of states not at all."""
    plan = Analog(no_broadcast, FOLDER).establishments()._jdf.queryExecution().executedPlan()
    moved = {
        key: next(n for n in nodes(plan) if n.nodeName() == "Exchange" and f"hashpartitioning({key}" in n.toString().splitlines()[0])
        for key in ("l_orderkey", "l_partkey")}
    kinds = {key: [out.apply(i).dataType().typeName() for i in range(out.size())]
             for key, out in ((key, node.output()) for key, node in moved.items())}
    assert "string" not in kinds["l_orderkey"] and "double" not in kinds["l_orderkey"]
    assert kinds["l_partkey"].count("string") == 1 and "timestamp_ntz" not in kinds["l_partkey"]  # the priority


def test_crooked_rows_are_named_from_the_same_pass(spark, tmp_path):
    raw = tmp_path / "raw" / "2026-06"
    for table, spec in LAYOUT.tables.items():
        shard(raw / table, table, [";".join("x" for _ in spec.columns)])
    shard(raw / "cnaes", "cnaes", ["1;2", "1;2;3", "1"], number=1)
    args = (spark, str(tmp_path / "raw"), str(tmp_path / "work"), "2026-06")
    for _ in range(2):
        with pytest.raises(registry_csv.CrookedRows) as error:
            registry_csv.stage(*args)
        assert [(t, bad) for t, _, bad in error.value.shards] == [("cnaes", 2)]
    shard(raw / "cnaes", "cnaes", ["1;2"], number=1)
    assert registry_csv.stage(*args)["cnaes"].count() == 2


@pytest.fixture
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def staged(spark, tmp_path):
    for name, df in Analog(spark, FOLDER).raw().items():
        df.write.parquet(str(tmp_path / name))
    return {p.name: spark.read.parquet(str(p)) for p in tmp_path.iterdir()}


def nodes(plan):
    """All operators of a plan that has run, with those inside stages."""
    name = plan.getClass().getSimpleName()
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else \
        [plan.plan()] if name.endswith("QueryStageExec") else \
        [plan.children().apply(i) for i in range(plan.children().size())]
    return [plan, *[x for child in inner for x in nodes(child)]]


def test_joins_by_company_need_no_shuffle(no_broadcast, staged, tmp_path):
    spark, root = no_broadcast, str(tmp_path / "work")
    laid_out = registry_csv.by_company(spark, staged, root, "2026-06", 4)
    expected = sorted(map(str, new_companies(staged, EXTRACTION).collect()))
    for _ in range(2):  # the second time the files are found through the ledger
        keys = ["cnpj_basico"]
        sites = laid_out["estabelecimentos"].where("situacao_cadastral = '02'")
        flags = laid_out["simples"].where("opcao_mei = 'S'").select(*keys).distinct().withColumn("flag", F.lit(True))
        both = sites.join(laid_out["empresas"], keys).join(flags, keys, "left")
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and "Bucketed: true" in plan
        found = new_companies(laid_out, EXTRACTION)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(cnpj_basico" not in plan and plan.count("Bucketed: true") == 3
        assert sorted(map(str, found.collect())) == expected
        laid_out = registry_csv.by_company(spark, staged, root, "2026-06", 4)


def test_the_layout_by_company_shuffles_nothing(spark, tmp_path, monkeypatch):
    """Each task writes a file a bucket, of the few staged files that it sorts in memory."""
    monkeypatch.setattr(registry_csv, "SORTED_BYTES", "1b")
    raw, root, ids = tmp_path / "staged", str(tmp_path / "work"), {}
    for table in registry_csv.BY_COMPANY:
        rows = spark.range(300, numPartitions=3).select(
            F.when(F.col("id") % 50 != 0, F.col("id") % 40).cast("string").alias("cnpj_basico"), F.col("id").alias("x"))
        rows.write.parquet(str(raw / table))
        ids[table] = sorted(map(str, rows.collect()))
    staged = {table: spark.read.parquet(str(raw / table)) for table in ids}
    since = last_execution(spark)
    found = registry_csv.by_company(spark, staged, root, "2026-06", 2)
    runs = executed(spark)
    saved = [
        run.physicalPlanDescription() for run in map(runs.apply, range(runs.size()))
        if run.executionId() > since and "by_company-2" in run.physicalPlanDescription()]
    assert len(saved) >= 3 and not any("Exchange" in plan for plan in saved)
    for table, expected in ids.items():
        assert sorted(map(str, found[table].collect())) == expected
        files = list((tmp_path / "work" / "by_company-2" / "extracao=2026-06" / table).glob("part-*"))
        assert len({file.name.split("-")[1] for file in files}) == 3  # tasks
        for file in files:
            keys = [r.cnpj_basico for r in spark.read.parquet(str(file)).collect()]
            assert keys == sorted(keys, key=lambda key: (key is not None, key))


def test_companies_are_cut_by_a_bloom_filter_before_their_shuffle(no_broadcast, staged):
    spark, key = no_broadcast, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    expected = sorted(map(str, new_companies(staged, EXTRACTION).collect()))
    spark.conf.set(key, "0")
    try:
        found = new_companies(staged, EXTRACTION)
        assert sorted(map(str, found.collect())) == expected
        plan = found._jdf.queryExecution().executedPlan()
        heads = [(n, n.toString().splitlines()[0]) for n in nodes(plan) if n.nodeName() == "Filter"]
        cut = [n for n, head in heads if "might_contain" in head and "isnotnull(cnpj_basico" in head]
        assert len(cut) == 2  # the companies and the flags
        rows = [n.metrics().apply("numOutputRows").value() for n in cut]
    finally:
        spark.conf.unset(key)
    hits = found.select(F.substring("cnpj", 1, 8)).distinct().count()
    assert hits < staged["empresas"].count() and max(rows) <= 1.1 * hits + 5
