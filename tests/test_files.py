"""Shards, staging, manifests and the whole monthly run, on files written here."""

import csv
import datetime as dt
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from alvara.operators import companies, quality
from alvara.plans import monthly
from alvara.sources import aggregate_store, manifest, registry_csv, spanning
from alvara.sources.layout import Layout, layout_for

LAYOUT = layout_for("2026-06")
SUFFIX = {
    "empresas": "EMPRECSV", "estabelecimentos": "ESTABELE", "simples": "SIMPLES.CSV",
    "cnaes": "CNAECSV", "municipios": "MUNICCSV", "naturezas": "NATJUCSV",
}


def shard(folder, table, rows, number=0, day="60613"):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"K3241.K03200Y{number}.D{day}.{SUFFIX[table]}"
    path.write_bytes("".join(row + "\n" for row in rows).encode("latin-1"))
    return path


def scan(spark, folder, table="cnaes", **options):
    rows = registry_csv.scan(spark, str(folder), table, LAYOUT, **options).collect()
    return sorted(tuple(row) for row in rows)


def test_quotes_delimiters_accents_and_blanks(spark, tmp_path):
    shard(tmp_path, "cnaes", ['"1";"""AC-S"""', '"2";"a;b"', '"3";"ação"', '"4";""', "5;"])
    assert scan(spark, tmp_path) == [
        ("1", '"AC-S"'), ("2", "a;b"), ("3", "ação"), ("4", None), ("5", None)]


def test_control_characters_become_question_marks_and_are_counted(spark, tmp_path):
    shard(tmp_path, "cnaes", ['"1";"a\x80\x9fb"', '"2";"\xa0"'])
    shard(tmp_path, "cnaes", ['"3";"ok"'], number=1)
    assert scan(spark, tmp_path) == [("1", "a??b"), ("2", "\xa0"), ("3", "ok")]
    counts = registry_csv.raw_control_counts(spark, str(tmp_path), "cnaes", LAYOUT).collect()
    assert [(c.file[-9:], c.replaced) for c in counts] == [("3.CNAECSV", 2)]


def test_control_characters_of_a_row_that_is_too_wide_count(spark, tmp_path):
    shard(tmp_path, "cnaes", ['"1";"\x85";"\x86\x87"'])
    counts = registry_csv.raw_control_counts(spark, str(tmp_path), "cnaes", LAYOUT).collect()
    assert [r.replaced for r in counts] == [3]


def test_values_that_span_lines(spark, tmp_path):
    shard(tmp_path, "cnaes", ['"1";"first\nsecond;still"', '"2";"b"'])
    shard(tmp_path, "cnaes", ['"3";"c"'], number=1)
    shard(tmp_path, "municipios", ['"9";"other table"'])
    odd = {r.file: r.odd_lines for r in
           registry_csv.unbalanced_files(spark, str(tmp_path), "*.CNAECSV").collect()}
    assert sorted(odd.values()) == [0, 2]
    assert scan(spark, tmp_path) == [("1", "first\nsecond;still"), ("2", "b"), ("3", "c")]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [7, 31, 1 << 20])
def test_line_breaks_inside_values_stay(spark, tmp_path, ending, split):
    values = [("1", "a\r\nb"), ("2", "c\rd"), ("3", "e\nf"), ("4", "plain"), ("5", "g\r"), ("6", "\r\n\r\n")]
    with open(tmp_path / "F.CNAECSV", "w", encoding="latin-1", newline="") as f:
        csv.writer(f, delimiter=";", quoting=csv.QUOTE_ALL, lineterminator=ending).writerows(values)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        assert scan(spark, tmp_path) == sorted(values)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("seed, split", [(1, 40), (2, 97), (3, 1 << 20)])
def test_records_may_cross_splits(spark, tmp_path, seed, split):
    dice = random.Random(seed)
    alphabet = ["a", "é", ";", '"', "\n", "\n\n", "x" * 30, " "]
    expected = []
    for number in range(3):
        values = [
            ("".join(dice.choice(alphabet) for _ in range(dice.randint(1, 12))), f"{number}-{i}")
            for i in range(60)
        ]
        expected += values
        with open(tmp_path / f"F{number}.CNAECSV", "w", encoding="latin-1", newline="") as f:
            csv.writer(f, delimiter=";", quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(values)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        assert scan(spark, tmp_path) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bad_rows_next_to_spanning_values(spark, tmp_path):
    shard(tmp_path, "cnaes", ['"1";"first\nsecond"', '"2"', "", '"3";"c"'])
    widths = quality.row_widths(spark, str(tmp_path), "cnaes", LAYOUT).first()
    assert (widths.rows, widths.bad) == (3, 1)
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        scan(spark, tmp_path)


def test_an_unclosed_quote_stops_the_scan(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spanning, "RECORD_LIMIT", 100)
    shard(tmp_path, "cnaes", ['"1";"open'] + [f'"{i}";"text"' for i in range(50)])
    with pytest.raises(Exception, match="unclosed quote"):
        scan(spark, tmp_path)


@pytest.mark.parametrize("bad", ['"2"', '"2";"b";"c"'])
def test_a_row_of_the_wrong_width_stops_the_scan(spark, tmp_path, bad):
    shard(tmp_path, "cnaes", ['"1";"a"', bad])
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        scan(spark, tmp_path)
    widths = quality.row_widths(spark, str(tmp_path), "cnaes", LAYOUT).first()
    assert (widths.rows, widths.bad) == (2, 1)
    rules = quality.column_widths(spark, str(tmp_path), "cnaes", LAYOUT)
    with pytest.raises(quality.QualityError, match="row_width"):
        quality.enforce(rules)


def test_missing_shard(spark, tmp_path):
    shard(tmp_path, "empresas", ["1;a;b;c;d;e;f"])
    rules = {r.rule: r for r in
             quality.column_widths(spark, str(tmp_path), "empresas", LAYOUT).collect()}
    assert not rules["shard_count"].ok and rules["shard_count"].observed == "1"
    assert rules["row_width"].ok


def test_staging_happens_once(spark, tmp_path):
    raw = tmp_path / "raw" / "2026-06"
    for table, spec in LAYOUT.tables.items():
        shard(raw / table, table, [";".join(str(i) for i in range(len(spec.columns)))])
    args = (spark, str(tmp_path / "raw"), str(tmp_path / "work"), "2026-06")
    staged = registry_csv.stage(*args)
    assert staged["simples"].first().opcao_mei == "4"
    shard(raw / "simples", "simples", ["0;1;2;3;CHANGED;5;6"])
    again = registry_csv.stage(*args)
    assert again["simples"].first().opcao_mei == "4"
    assert spark.table("simples").count() == 1


def test_unfinished_staging_is_redone(spark, tmp_path):
    raw = tmp_path / "raw" / "2026-06"
    for table, spec in LAYOUT.tables.items():
        shard(raw / table, table, [";".join("x" for _ in spec.columns)])
    half = tmp_path / "work" / "extracao=2026-06" / "cnaes"
    spark.createDataFrame([("old", "old")], "codigo string, descricao string") \
        .write.parquet(str(half))
    staged = registry_csv.stage(spark, str(tmp_path / "raw"), str(tmp_path / "work"), "2026-06")
    assert [r.codigo for r in staged["cnaes"].collect()] == ["x"]


def test_extraction_dates(spark):
    rows = [("F.K03200$Z.D60613.CNAECSV", "2026-06"), ("CNAECSV", "2026-06"),
            ("F.D50613.CNAECSV", "2026-06"), ("F.D60613.CNAECSV", "2026-07"),
            ("F.D60231.CNAECSV", "2026-02")]
    found = registry_csv.extraction_dates(
        spark.createDataFrame(rows, "arquivo string, extracao string")).collect()
    assert [r.data_extracao for r in found] == [dt.date(2026, 6, 13)] + [None] * 4
    assert [r.problema for r in found] == [
        None, "no date in the name", "year differs from the folder", "outside the month",
        "not a calendar date"]


def test_extraction_date_of_a_folder(spark, tmp_path):
    shard(tmp_path / "cnaes", "cnaes", ["1;a"])
    assert registry_csv.extraction_date(spark, str(tmp_path), "2026-06") == dt.date(2026, 6, 13)
    with pytest.raises(ValueError):
        registry_csv.extraction_date(spark, str(tmp_path), "2027-06")


def archives(folder, names, skip=()):
    folder.mkdir(parents=True, exist_ok=True)
    entries = []
    for name in names:
        content = f"zip of {name}".encode()
        if name not in skip:
            (folder / name).write_bytes(content)
        entries.append({"nome": name, "bytes": len(content),
                        "sha256": hashlib.sha256(content).hexdigest()})
    total = sum(e["bytes"] for e in entries)
    (folder / "manifest.json").write_text(json.dumps(
        {"extracao": "2026-06", "base_url": "u", "arquivos": entries, "total_bytes": total},
        indent=2))
    return entries


def test_manifest_roundtrip(spark, tmp_path):
    entries = archives(tmp_path, ["A.zip", "B.zip"])
    expected = {(e["nome"], e["bytes"], e["sha256"]) for e in entries}
    read = manifest.read(spark, str(tmp_path / "manifest.json"))
    hashed = manifest.hashed_listing(spark, str(tmp_path))
    assert {tuple(r) for r in read.collect()} == expected
    assert {tuple(r) for r in hashed.collect()} == expected
    built = manifest.build(hashed, "2026-06", "u").first()
    assert [a.nome for a in built.arquivos] == ["A.zip", "B.zip"]
    assert built.total_bytes == sum(e["bytes"] for e in entries)
    assert all(r.ok for r in quality.archive_hashes(read, hashed).collect())
    (tmp_path / "B.zip").write_bytes(b"ZIP of B.zip")
    changed = quality.archive_hashes(read, manifest.hashed_listing(spark, str(tmp_path)))
    assert {r.subject: r.ok for r in changed.collect()} == {"A.zip": True, "B.zip": False}
    in_pieces = manifest.hashed_listing(spark, str(tmp_path), chunk=5)
    assert {r.nome: r.sha256 for r in in_pieces.collect()}["A.zip"] == entries[0]["sha256"]
    bare = quality.archive_hashes(read.withColumn("sha256", F.lit(None).cast("string")), hashed)
    assert not any(r.ok for r in bare.collect())
    (tmp_path / "B.zip").unlink()
    gone = quality.archive_hashes(read, manifest.hashed_listing(spark, str(tmp_path)))
    assert {r.subject: (r.observed, r.ok) for r in gone.collect()}["B.zip"] == ("not on disk", False)


def test_complete_load_finds_each_fault(spark):
    frame = spark.createDataFrame
    rules = quality.complete_load(
        frame([("a",), ("b",), ("c",), ("d",)], "nome string"),
        frame([("a", 1), ("b", 2), ("c", 3), ("extra", 9)], "nome string, bytes long"),
        frame([("a", 1), ("b", 1), ("extra", 9), ("unlisted", 1)], "nome string, bytes long"),
    ).collect()
    assert {r.subject: (r.observed, r.ok) for r in rules} == {
        "a": ("1", True), "b": ("1", False), "c": ("not on disk", False),
        "d": ("not in the manifest", False), "extra": ("9", True)}


def test_layout_refuses_forbidden_files():
    with pytest.raises(ValueError, match="Empresas3.zip"):
        Layout(LAYOUT.tables, ("Empresas3.zip",))
    assert len(LAYOUT.archives) == 24
    assert layout_for("2031-01") is LAYOUT and layout_for("2020-01") is LAYOUT


def test_foreign_columns_and_exposed_addresses_fail(spark):
    columns = ", ".join(f"{c} string" for c in companies.ALLOWED_COLUMNS if c != "eh_mei")
    row = tuple("x" for c in companies.ALLOWED_COLUMNS if c != "eh_mei") + (True, "y")
    frame = spark.createDataFrame([row], columns + ", eh_mei boolean, nome_socio string")
    rules = {r.rule: r for r in quality.company_rules(frame, bounds=(0, 10)).collect()}
    assert not rules["allowed_columns"].ok and rules["allowed_columns"].observed == "nome_socio"
    assert not rules["private_address"].ok
    assert rules["magnitude"].ok


def test_forbidden_file_on_disk(spark, tmp_path):
    archives(tmp_path, ["A.zip", "Socios3.zip"])
    forbidden = spark.createDataFrame([(n,) for n in LAYOUT.forbidden], "nome string")
    found = quality.forbidden_files(manifest.listing(spark, str(tmp_path)), forbidden, "on disk")
    with pytest.raises(quality.QualityError, match="Socios3.zip"):
        quality.enforce(found)


def write_month(tmp_path, extraction, day, openings):
    """A complete dump: ten shards of companies and establishments, four code files."""
    places = monthly.Places(*[str(tmp_path / n) for n in ("zips", "raw", "work", "aggregate")])
    archives(tmp_path / "zips" / extraction, LAYOUT.archives)
    raw = tmp_path / "raw" / extraction
    columns = LAYOUT.tables["estabelecimentos"].columns
    for number in range(10):
        people, sites = [], []
        for base, opened in openings:
            if int(base) % 10 != number:
                continue
            people.append(f'"{base}";"NOME {base}";"2062";"49";"1000,00";"01";""')
            site = dict.fromkeys(columns, "")
            site.update(
                cnpj_basico=base, cnpj_ordem="0001", cnpj_dv="90", uf="SP", municipio="7107",
                identificador_matriz_filial="1", situacao_cadastral="02",
                data_situacao_cadastral=opened, data_inicio_atividade=opened,
                cnae_fiscal_principal="5611203", nome_fantasia='""BAR""', logradouro="RUA X")
            sites.append(";".join(f'"{site[c]}"' for c in columns))
        shard(raw / "empresas", "empresas", people, number, day)
        shard(raw / "estabelecimentos", "estabelecimentos", sites, number, day)
    shard(raw / "simples", "simples", ['"00000001";"S";"";"";"S";"";""'], 0, day)
    shard(raw / "cnaes", "cnaes", ['"5611203";"Lanchonetes"'], 0, day)
    shard(raw / "municipios", "municipios", ['"7107";"SÃO PAULO"'], 0, day)
    shard(raw / "naturezas", "naturezas", ['"2062";"Sociedade Limitada"'], 0, day)
    return places


def test_two_months_end_to_end(spark, tmp_path):
    june = [(f"{i:08d}", f"202605{4 + i % 25:02d}") for i in range(60)]
    places = write_month(tmp_path, "2026-06", "60613", june)
    monthly.run_month(spark, places, "2026-06", bounds=(10, 100))
    first = aggregate_store.open_aggregate(spark, places.aggregate)
    assert first.month == dt.date(2026, 5, 1)
    assert first.cells.agg(F.sum("contagem")).first()[0] == 60
    report = {r.rule: r for r in spark.read.parquet(places.report("2026-06")).collect()}
    assert report["magnitude"].ok and report["aggregate_size"].ok
    assert "control_characters" not in report
    kept = spark.read.parquet(places.companies("2026-06"))
    assert kept.columns == companies.ALLOWED_COLUMNS
    assert {r.nome_fantasia for r in kept.select("nome_fantasia").collect()} == {'"BAR"'}
    assert kept.where("eh_mei").select("endereco").first().endereco is None

    late = june + [("00000900", "20260504"), ("00000901", "20260630")]
    write_month(tmp_path, "2026-07", "60711", late)
    monthly.run_month(spark, places, "2026-07", bounds=(10, 100))
    second = aggregate_store.open_aggregate(spark, places.aggregate)
    assert second.month == dt.date(2026, 6, 1)
    assert second.cells.agg(F.sum("contagem")).first()[0] == 62

    # A truncated archive stops the next run and leaves the published version alone.
    (tmp_path / "zips" / "2026-07" / "Simples.zip").write_bytes(b"")
    with pytest.raises(quality.QualityError, match="Simples.zip"):
        monthly.run_month(spark, places, "2026-07", bounds=(10, 100))
    assert aggregate_store.open_aggregate(spark, places.aggregate).cells.count() == \
        second.cells.count()
    with pytest.raises(quality.QualityError, match="magnitude"):
        (tmp_path / "zips" / "2026-07" / "Simples.zip").write_bytes(b"zip of Simples.zip")
        monthly.run_month(spark, places, "2026-07")


def test_a_month_with_a_crooked_row_names_the_shard(spark, tmp_path):
    people = [(f"{i:08d}", "20260601") for i in range(20)]
    places = write_month(tmp_path, "2026-06", "60613", people)
    crooked = tmp_path / "raw" / "2026-06" / "empresas"
    shard(crooked, "empresas", ['"1";"2"'], 7, "60613")
    with pytest.raises(quality.QualityError, match="row_width empresas/K3241.K03200Y7"):
        monthly.run_month(spark, places, "2026-06", bounds=(1, 100))
    (crooked / "K3241.K03200Y7.D60613.EMPRECSV").unlink()
    with pytest.raises(quality.QualityError, match="shard_count empresas"):
        monthly.run_month(spark, places, "2026-06", bounds=(1, 100))


def test_aggregate_files_are_sorted_and_measured(spark, tmp_path):
    rows = [(dt.date(2026, 6, 1) + dt.timedelta(days=7 * (i % 5)), f"U{i % 7}", str(i), "M", f"{i % 11}",
             "D", 1, dt.date(2026, 7, 11), False) for i in range(500)]
    frame = spark.createDataFrame(rows, aggregate_store.AGGREGATE)
    aggregate_store.publish(frame, str(tmp_path), partitions=3)
    stored = aggregate_store.current(spark, str(tmp_path))
    per_file = stored.select("semana", "uf", "cnae_principal", F.col("_metadata.file_path").alias("f"))
    by_file = {}
    for r in per_file.collect():
        by_file.setdefault(r.f, []).append((r.semana, r.uf, r.cnae_principal))
    assert all(values == sorted(values) for values in by_file.values()) and len(by_file) > 1
    size = aggregate_store.stored_bytes(stored)
    assert size.first().bytes > 0
    assert quality.aggregate_size(size).first().ok
    assert not quality.aggregate_size(size, limit=10).first().ok
    assert tuple(aggregate_store.summary(stored).first()) == (500, 5)
    with pytest.raises(ValueError):
        aggregate_store.open_aggregate(spark, str(tmp_path / "nowhere"))


def test_a_dump_without_manifest_fails_a_rule(spark, tmp_path):
    places = monthly.Places(*[str(tmp_path / x) for x in ("zips", "raw", "work", "agg")])
    (tmp_path / "zips" / "2026-06").mkdir(parents=True)
    rule, = monthly.file_rules(spark, places, "2026-06")
    assert [(r.rule, r.severity, r.ok) for r in rule.collect()] == [("manifest", "hard", False)]
    with pytest.raises(quality.QualityError, match="manifest"):
        quality.enforce(rule)
