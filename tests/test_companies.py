"""New companies, weeks and merging, on rows written out by hand."""

import datetime as dt

import pytest

from alvara.operators import companies, weekly
from alvara.sources import aggregate_store
from alvara.sources.layout import layout_for

DAY = dt.date(2026, 7, 11)
COLUMNS = layout_for("2026-06").tables["estabelecimentos"].columns


def establishment(base, opened="20260601", status="02", kind="1", sector="5611203",
                  city="7107", uf="SP", changed="20260601", order="0001", street="FLORES"):
    row = dict.fromkeys(COLUMNS, "")
    row.update(
        cnpj_basico=base, cnpj_ordem=order, cnpj_dv="90", identificador_matriz_filial=kind,
        situacao_cadastral=status, data_situacao_cadastral=changed,
        data_inicio_atividade=opened, cnae_fiscal_principal=sector, municipio=city, uf=uf,
        tipo_logradouro="RUA", logradouro=street, numero="10",
    )
    return tuple(row[name] for name in COLUMNS)


def tables(spark, establishments, people=(), companies_=None, mei=()):
    bases = sorted({row[0] for row in establishments})
    known = companies_ if companies_ is not None else [(b, "NOME", "2062", "1000,00", "01") for b in bases]
    code = "codigo string, descricao string"
    return {
        "estabelecimentos": spark.createDataFrame(
            establishments, ", ".join(f"{c} string" for c in COLUMNS)),
        "empresas": spark.createDataFrame(
            known, "cnpj_basico string, razao_social string, natureza_juridica string, "
                   "capital_social string, porte string"),
        "simples": spark.createDataFrame(
            [(b, "S") for b in mei] + [("99999999", "N")], "cnpj_basico string, opcao_mei string"),
        "cnaes": spark.createDataFrame([("5611203", "Lanchonetes")], code),
        "municipios": spark.createDataFrame([("7107", "SAO PAULO")], code),
        "naturezas": spark.createDataFrame([("2062", "LTDA")], code),
    }


def found(spark, raw, **options):
    rows = companies.new_companies(raw, DAY, **options).collect()
    return {row.cnpj[:8]: row for row in rows}


def test_window_ends_are_included(spark):
    start = DAY - dt.timedelta(days=90)
    text = [d.strftime("%Y%m%d") for d in (start - dt.timedelta(days=1), start, DAY,
                                           DAY + dt.timedelta(days=1))]
    raw = tables(spark, [establishment(f"0000000{i}", opened=t) for i, t in enumerate(text)])
    assert set(found(spark, raw)) == {"00000001", "00000002"}


def test_reactivated_inactive_branch_and_bad_dates_are_left_out(spark):
    raw = tables(spark, [
        establishment("00000001"),
        establishment("00000002", opened="20190101", changed="20260701"),
        establishment("00000003", status="08"),
        establishment("00000004", kind="2"),
        *[establishment(f"0000001{i}", opened=bad)
          for i, bad in enumerate(["00000000", "0", "", "20260630 ", "2026061"])],
    ])
    assert set(found(spark, raw)) == {"00000001"}
    assert set(found(spark, raw, include_branches=True)) == {"00000001", "00000004"}


def test_masking_sizes_and_lookups(spark):
    raw = tables(
        spark,
        [establishment("00000001"), establishment("00000002", sector="0000000", city="1"),
         establishment("00000003"), establishment("00000004"), establishment("00000005")],
        companies_=[("00000001", "A", "2062", "1000,5", "05"),
                    ("00000002", "B", "9999", "x", "03"), ("00000003", "C", "2062", "1", "00"),
                    ("00000004", "D", "2062", "1", "01")],
        mei=["00000001", "00000001"],
    )
    rows = found(spark, raw)
    assert set(rows) == {"00000001", "00000002", "00000003", "00000004"}  # 5 has no company
    one, two = rows["00000001"], rows["00000002"]
    assert (one.porte, one.endereco, one.eh_mei) == ("MEI", None, True)
    assert str(one.capital_social) == "1000.50" and one.municipio == "SAO PAULO"
    assert (two.porte, two.endereco, two.eh_mei) == ("EPP", "RUA FLORES 10", False)
    assert (two.cnae_descricao, two.municipio, two.natureza_descricao, two.capital_social) == (None,) * 4
    assert rows["00000003"].porte is None and rows["00000004"].porte == "ME"
    assert one.cnpj == "00000001000190" and one.nome_fantasia is None


def test_a_twice_listed_sole_trader_stays_one_row(spark):
    raw = tables(spark, [establishment("00000001")], mei=["00000001"] * 3)
    assert companies.new_companies(raw, DAY).count() == 1


def test_only_allowed_columns(spark):
    raw = tables(spark, [establishment("00000001")])
    assert companies.new_companies(raw, DAY).columns == companies.ALLOWED_COLUMNS


def cell(week, uf="SP", city="1", sector="a", n=1, day=DAY, partial=False, name="X", text="A"):
    return (week, uf, city, name, sector, text, n, day, partial)


def aggregate(spark, rows):
    return spark.createDataFrame(rows, aggregate_store.AGGREGATE)


def test_weekly_counts_add_up(spark):
    raw = tables(spark, [establishment(f"000000{i:02d}", opened=f"202607{1 + i % 11:02d}")
                         for i in range(40)])
    new = companies.new_companies(raw, DAY)
    weeks = weekly.weekly_aggregate(new, DAY).collect()
    assert sum(w.contagem for w in weeks) == 40
    assert {w.semana.weekday() for w in weeks} == {0}
    assert {w.semana: w.semana_parcial for w in weeks} == {
        dt.date(2026, 6, 29): False, dt.date(2026, 7, 6): True}


def test_newest_extraction_replaces_and_stale_cells_stay(spark):
    week, older = dt.date(2026, 6, 1), dt.date(2026, 6, 13)
    history = aggregate(spark, [cell(week, n=5, day=older, partial=True), cell(week, city="2", n=7, day=older)])
    new = aggregate(spark, [cell(week, n=9), cell(week, city="3", n=1)])
    merged = weekly.merge_extractions(new, history).collect()
    assert {(r.municipio_codigo, r.contagem, r.data_extracao) for r in merged} == {
        ("1", 9, DAY), ("2", 7, older), ("3", 1, DAY)}


def test_merge_is_idempotent_and_the_rerun_wins(spark):
    week = dt.date(2026, 6, 1)
    first = aggregate(spark, [cell(week, n=5), cell(week, city="2", n=3)])
    rerun = aggregate(spark, [cell(week, n=6), cell(week, city="2", n=3)])
    once = weekly.merge_extractions(rerun, first)
    twice = weekly.merge_extractions(rerun, once)
    expected = {("1", 6), ("2", 3)}
    assert {(r.municipio_codigo, r.contagem) for r in once.collect()} == expected
    assert {(r.municipio_codigo, r.contagem) for r in twice.collect()} == expected
    assert weekly.merge_extractions(first, None) is first


def test_settled_weeks_are_passed_on(spark):
    older = dt.date(2026, 6, 13)
    first = weekly.first_week(DAY)
    assert first == dt.date(2026, 4, 6)
    history = aggregate(spark, [
        cell(first - dt.timedelta(days=7), n=8, day=older), cell(first, n=5, day=older),
        cell(dt.date(2026, 6, 1), n=6, day=older)])
    new = aggregate(spark, [cell(first, n=1), cell(dt.date(2026, 7, 6), n=2)])
    whole = weekly.merge_extractions(new, history)
    split = weekly.merge_extractions(new, history, settled_before=first)
    assert sorted(whole.collect()) == sorted(split.collect()) and whole.count() == 4


def test_left_edge_week(spark):
    # 2026-07-11 less 90 days is Sunday 2026-04-12: its week is cut on the left.
    week, older = dt.date(2026, 4, 6), dt.date(2026, 6, 13)
    history = aggregate(spark, [cell(week, n=50, day=older)])
    new = aggregate(spark, [cell(week, n=4), cell(week, city="2", n=1)])

    def counts(edge):
        return {r.municipio_codigo: r.contagem
                for r in weekly.merge_extractions(new, history, edge).collect()}

    assert counts("replace") == {"1": 4, "2": 1}
    assert counts("keep") == {"1": 50, "2": 1}
    with pytest.raises(ValueError):
        weekly.merge_extractions(new, history, "neither")


def test_a_company_with_most_branches_is_split_over_tasks(spark):
    rows = [establishment("00000001", kind="2", order=f"{i:04d}", street=f"S{i} " * 40)
            for i in range(3000)]
    rows += [establishment(f"{i:08d}") for i in range(2, 1500)]
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        raw = tables(spark, rows)
        new = companies.new_companies(raw, DAY, include_branches=True)
        counts = {r.cnpj_basico: r["count"] for r in
                  new.groupBy(new.cnpj.substr(1, 8).alias("cnpj_basico")).count().collect()}
        new.collect()
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert counts["00000001"] == 3000 and len(counts) == 1499
    assert "skew=true" in plan and "BroadcastHashJoin" not in plan and "Nested" not in plan
