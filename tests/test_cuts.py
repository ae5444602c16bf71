"""Rankings, measures and cuts with the registry's own floors, on rows made here."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from alvara.operators import measures, picks, rankings
from alvara.plans import captions, catalogue, cuts
from alvara.sources import aggregate_store, dimensions

DAY = dt.date(2026, 7, 11)
JUNE, MAY = dt.date(2026, 6, 1), dt.date(2026, 5, 4)


def openings(spark, rows):
    """Rows of ``(week, uf, city, sector code, description, count[, partial])``."""
    full = [(w, uf, city, city, code, text, n, DAY, bool(rest and rest[0]))
            for w, uf, city, code, text, n, *rest in rows]
    frame = spark.createDataFrame(full, aggregate_store.AGGREGATE)
    return aggregate_store.opened(frame)


def june(uf, code, n, text="D", city="C"):
    return (JUNE, uf, city, code, text, n)


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_months_partial_weeks_and_the_reference_month(spark):
    d = openings(spark, [
        june("SP", "1", 5), (dt.date(2026, 6, 29), "SP", "C", "1", "D", 7),
        (dt.date(2026, 7, 6), "SP", "C", "1", "D", 100, True), (MAY, "SP", "C", "1", "D", 3)])
    assert d.month == JUNE and d.previous == dt.date(2026, 5, 1)
    assert rankings.month_total(d).first().total == 12
    assert rankings.month_total(d, dt.date(2026, 1, 1)).first().total == 0
    assert d.sql("select sum(contagem) s from agregados where uf = :uf", uf="SP").first().s == 15


def test_abroad_counts_in_some_rankings_only(spark):
    d = openings(spark, [june("EX", "1", 9), june("SP", "1", 5), june("RJ", "1", 5)])
    assert rows(rankings.top_states(d), "uf", "n") == [("EX", 9), ("RJ", 5), ("SP", 5)]
    assert rows(rankings.sector_top_states(d, ["1"]), "uf") == [("EX",), ("RJ",), ("SP",)]
    assert rows(rankings.state_totals(d), "uf") == [("RJ",), ("SP",)]
    assert rankings.month_total(d).first().total == 19


def test_sectors_and_cities_group_by_name(spark):
    d = openings(spark, [
        june("SP", "1", 2, "Bares", "A"), june("SP", "2", 3, "Bares", "A"),
        june("RJ", "3", 4, "Padarias", "A"), june("RJ", "4", 50, None, None)])
    assert rows(rankings.top_sectors(d), "cnae_descricao", "n") == [("Bares", 5), ("Padarias", 4)]
    assert rows(rankings.top_sectors(d, uf="RJ", limit=1), "n") == [(4,)]
    assert rows(rankings.top_cities(d), "cidade", "n") == [("A/SP", 5), ("A/RJ", 4)]
    assert rows(rankings.top_cities(d, codes=["2"], uf="SP"), "cidade", "n") == [("A/SP", 3)]


def test_growth_floor_limit_ceiling_and_fallback(spark):
    def pair(text, before, now):
        return [(MAY, "SP", "C", text, text, before), (JUNE, "SP", "C", text, text, now)]

    d = openings(spark, [
        *pair("tiny", 1, 4), *pair("burst", 300, 1491), *pair("good", 300, 600),
        *pair("flat", 400, 400), (JUNE, "SP", "C", "new", "new", 900)])
    growth = measures.growth_by_sector(d)
    assert rows(growth, "cnae_descricao", "antes", "agora") == [
        ("burst", 300, 1491), ("good", 300, 600), ("flat", 400, 400)]
    assert round(growth.first().variacao, 6) == 397
    kept = measures.plausible_growth(growth).orderBy(F.col("variacao").desc())
    assert rows(kept, "cnae_descricao") == [("good",), ("flat",)]
    assert measures.plausible_growth(growth, -1).count() == 3
    assert rows(measures.growth_by_sector(d, limit=1, ceiling=200), "cnae_descricao") == [("good",)]
    assert measures.plausible_growth(growth.where("false")).count() == 0


def test_location_quotients_take_totals_before_floors(spark):
    d = openings(spark, [
        june("SE", "t", 100, "Táxi"), june("SE", "b", 100, "Bar"), june("SP", "t", 60, "Táxi"),
        june("SP", "b", 1740, "Bar"), june("SP", "x", 39, "Raro"), june("EX", "t", 500, "Táxi"),
        june("SP", "u", 77, None)])
    found = {(r.uf, r.cnae_principal): r for r in measures.location_quotient(d).collect()}
    assert set(found) == {("SE", "t"), ("SE", "b"), ("SP", "t"), ("SP", "b")}
    total = 100 + 100 + 60 + 1740 + 39
    assert found["SE", "t"].lq == pytest.approx((100 / 200) / (160 / total))
    assert found["SE", "t"].total_setor == 160
    # Weighted by the national shares the quotients of a state average to one.
    every = measures.location_quotient(d, floor=0, national_floor=0).collect()
    for uf in ("SE", "SP"):
        mean = sum(r.lq * r.total_setor / total for r in every if r.uf == uf)
        assert mean == pytest.approx(1)


def test_hero_quotients_keep_undescribed_openings(spark):
    d = openings(spark, [june("SE", "t", 12, "T"), june("SE", "u", 88, None),
                         june("SP", "t", 12, "T"), june("SP", "b", 888, "B"),
                         june("AC", "t", 9, "T")])
    codes = spark.createDataFrame([("taxi", "t")], "k string, cnae_principal string")
    found = {r.uf: r for r in measures.sector_quotients(d, codes, "k").collect()}
    assert set(found) == {"SE", "SP"}
    assert found["SE"].lq == pytest.approx((12 / 100) / (33 / 1009))


def test_per_capita_drops_small_and_unknown_states(spark):
    counts = spark.createDataFrame(
        [("SP", 500), ("RR", 19), ("AC", 20), ("EX", 99)], "uf string, n long")
    found = {r.uf: r.por_100k for r in
             measures.per_capita(counts, dimensions.population(spark), 20).collect()}
    assert set(found) == {"SP", "AC"}
    assert found["AC"] == 20 * 100_000 / 830_018


def test_trend_line(spark):
    points = spark.createDataFrame(
        [("a", 1.0, 3.0), ("a", 2.0, 5.0), ("a", 4.0, 9.0), ("b", 2.0, 1.0), ("c", 1.0, 1.0),
         ("c", 1.0, 2.0)], "k string, x double, y double")
    found = {r.k: r for r in measures.trend_line(points, ["k"]).collect()}
    line = found["a"]
    assert (line.inclinacao, line.intercepto) == (pytest.approx(2), pytest.approx(1))
    assert (line.y_min, line.y_max) == (pytest.approx(3), pytest.approx(9))
    assert found["b"].inclinacao is None and found["c"].inclinacao is None


def walk(candidates, keep=8):
    """The walk over all candidates, one by one."""
    states, trades, taken = set(), set(), []
    for uf, code, text, lq in sorted(candidates, key=lambda c: (-c[3], c[0], c[1])):
        trade = text.split(",")[0][:22].lower()
        if uf not in states and trade not in trades and len(taken) < keep:
            states.add(uf)
            trades.add(trade)
            taken.append((uf, code))
    return taken


@pytest.mark.parametrize("seed, states, trades, keep", [
    (1, 27, 40, 8), (2, 4, 60, 8), (3, 60, 3, 8), (4, 27, 40, 2), (5, 12, 12, 8), (6, 30, 30, 1)])
def test_signatures_equal_the_plain_walk(spark, seed, states, trades, keep):
    dice = random.Random(seed)
    candidates = [
        (f"U{u}", f"c{t}.{copy}", f"Trade {t}, kind {copy}", float(dice.randint(1, 40)))
        for u in range(states) for t in range(trades) for copy in range(2) if dice.random() < 0.8
    ]
    frame = spark.createDataFrame(
        candidates, "uf string, cnae_principal string, descricao string, lq double")
    found = picks.signature_sectors(frame, keep=keep).orderBy("posicao")
    assert rows(found, "uf", "cnae_principal") == walk(candidates, keep)


def test_signatures_within_groups_and_none(spark):
    schema = "m string, uf string, cnae_principal string, descricao string, lq double"
    frame = spark.createDataFrame(
        [("a", "SE", "1", "Táxi", 9.0), ("a", "AL", "1", "táxi, de luxo", 8.0),
         ("a", "AL", "2", "Bar", 2.0), ("b", "AL", "1", "Táxi", 1.0)], schema)
    found = picks.signature_sectors(frame, ["m"]).orderBy("m", "posicao")
    assert rows(found, "m", "posicao", "uf", "cnae_principal") == [
        ("a", 1, "SE", "1"), ("a", 2, "AL", "2"), ("b", 1, "AL", "1")]
    assert picks.signature_sectors(frame.where("lq > 99")).count() == 0


def test_queues_rotate_restart_and_reset(spark, tmp_path):
    entries = spark.createDataFrame(
        [(x, q, i, f"{q}{i}") for x in ("2026-06-13", "2026-07-11")
         for q, size in (("novo", 3), ("classico", 2)) for i in range(1, size + 1)],
        "extracao string, fila string, posicao int, chave string")
    root = str(tmp_path / "state")
    used = picks.read_uses(spark, root)
    seen = []
    for _ in range(7):
        chosen = picks.next_unused(entries.where("extracao = '2026-06-13'"), used)
        seen.append({r.fila: r.chave for r in chosen.collect()})
        picks.record_use(chosen, root)
        used = picks.read_uses(spark, root)
    assert [s["novo"] for s in seen] == ["novo1", "novo2", "novo3"] * 2 + ["novo1"]
    assert [s["classico"] for s in seen] == ["classico1", "classico2"] * 3 + ["classico1"]
    fresh = picks.next_unused(entries, used).where("extracao = '2026-07-11'")
    assert set(rows(fresh, "chave")) == {("novo1",), ("classico1",)}


def test_a_late_entry_is_shown_once(spark):
    uses = [("x", "novo", c, k) for c, k in ((1, "a"), (1, "b"), (2, "a"), (2, "b"))]
    queue = [("x", "novo", 1, "a"), ("x", "novo", 2, "b"), ("x", "novo", 3, "late")]
    entries = spark.createDataFrame(queue, "extracao string, fila string, posicao int, chave string")
    used = spark.createDataFrame(uses, picks.USED)
    assert rows(picks.next_unused(entries, used), "ciclo", "chave") == [(2, "late")]
    used = spark.createDataFrame([*uses, ("x", "novo", 2, "late")], picks.USED)
    assert rows(picks.next_unused(entries, used), "ciclo", "chave") == [(3, "a")]


def test_a_ranking_of_everything_is_refused(spark):
    with pytest.raises(ValueError):
        rankings.ranked(spark.range(3), "id", "id")


def test_queue_files(spark, tmp_path):
    (tmp_path / "s.json").write_text(
        '{"data_extracao": "2026-07-11",\n "usados": {"novo": ["a", "b"], "classico": []}}')
    (tmp_path / "old.json").write_text('{"data_extracao": "2026-07-11", "usados": ["a"]}')
    assert set(rows(picks.read_queue_file(spark, str(tmp_path / "s.json")), "fila", "chave")) == {
        ("novo", "a"), ("novo", "b")}
    assert picks.read_queue_file(spark, str(tmp_path / "old.json")).count() == 0


def test_the_catalogue(spark):
    entries = catalogue.catalogue()
    assert len(entries) == 63 and len({e.key for e in entries}) == 63
    frame = catalogue.as_frame(spark, entries)
    assert {r.fila: r["count"] for r in frame.groupBy("fila").count().collect()} == {
        "novo": 29, "classico": 34}
    floors = {e.key: e.floor for e in entries}
    assert (floors["percapita|total"], floors["percapita|loja-de-roupa"],
            floors["razao|bar-academia"], floors["lqhero|taxi"]) == (20, 60, 15, 10)
    assert sum(len(s.codes) for s in dimensions.SECTORS) == 20
    assert len(dimensions.SECTORS) == 13 and len(dimensions.POPULATION) == 27


def sample(spark):
    """A small country: 27 states, sector counts that grow with the population."""
    data = []
    hero = list(catalogue.HERO_CODES.values())
    for rank, (uf, people) in enumerate(dimensions.POPULATION.items()):
        size = people // 20_000
        for i, sector in enumerate(dimensions.SECTORS):
            for code in sector.codes:
                n = max(1, size * (1 + (i * 7 + rank * 3) % 5) // 6)
                data.append((JUNE, uf, f"CITY {uf} {i % 4}", code, f"Setor {code}, exceto {uf[0]}", n))
                data.append((MAY, uf, "CITY X", code, f"Setor {code}, exceto {uf[0]}", max(1, n - i)))
        for j, code in enumerate(hero):
            data.append((JUNE, uf, "CITY Y", code, f"Heroi {code}", 1 + (rank * 5 + j) % 40))
    data.append((JUNE, "EX", None, "5611203", None, 77))
    return openings(spark, data)


def test_every_entry_runs_and_captions_fit(spark):
    d = sample(spark)
    entries = catalogue.catalogue()
    found = cuts.run(d, entries, dimensions.population(spark)).cache()
    status = {r.chave: r.status for r in found.select("chave", "status").distinct().collect()}
    assert len(status) == 63
    assert {k for k, v in status.items() if v != "ok"} <= {"anomalia"}
    written = captions.captions(found, catalogue.as_frame(spark, entries), d)
    texts = {r.chave: r for r in written.collect()}
    assert len(texts) == sum(v == "ok" for v in status.values())
    for key, caption in texts.items():
        assert caption.texto and caption.alt and "{" not in caption.texto + caption.alt, key
        assert len(caption.texto) <= 280 and len(caption.alt) <= 1000, key
        assert "extração de 11/07/2026" in caption.credito
    assert "Censo" in texts["dupla|DF"].credito and "Censo" not in texts["anomalia" if
        "anomalia" in texts else "assinatura"].credito
    board = texts["placar_nacional"].texto
    assert board.startswith(f"{rankings.month_total(d).first().total:,}".replace(",", "."))
    labels = [r.detalhe for r in found.where("familia = 'ranking_cnae'").collect()]
    assert all(labels)
    found.unpersist()


def test_single_entries_and_no_data(spark):
    d = openings(spark, [june("SP", "5611202", 3)])
    wanted = [e for e in catalogue.catalogue() if e.key in ("setor|bar", "razao|bar-academia",
                                                            "percapita|bar", "recorte_cidade|BR")]
    found = cuts.run(d, wanted, dimensions.population(spark))
    assert {(r.chave, r.status, r.valor) for r in found.collect()} == {
        ("setor|bar", "ok", 3.0), ("razao|bar-academia", "no_data", None),
        ("percapita|bar", "no_data", None), ("recorte_cidade|BR", "no_data", None)}


@pytest.mark.parametrize("counts, expected", [
    ({"SP": 20000, "AC": 30}, "SP é quem mais abre bares"),
    ({"SP": 500, "AC": 300}, "é só o 2º"),
    ({"SP": 10, "AC": 300}, "Esperava esse estado no topo?")])
def test_three_ways_to_tell_a_rate(spark, counts, expected):
    d = openings(spark, [june(uf, "5611202", n) for uf, n in counts.items()])
    wanted = [e for e in catalogue.catalogue() if e.key == "percapita|bar"]
    found = cuts.run(d, wanted, dimensions.population(spark))
    text = captions.captions(found, catalogue.as_frame(spark, wanted), d).first().texto
    assert expected in text


def test_a_duel_counts_zero_where_the_other_state_has_none(spark):
    d = openings(spark, [june("SP", "1", 9, "Bar"), june("SP", "2", 5, "Pão"),
                         june("RJ", "1", 4, "Bar"), june("RJ", "3", 50, "Mar")])
    wanted = [e for e in catalogue.catalogue() if e.key == "duelo|SPxRJ"]
    found = cuts.run(d, wanted, dimensions.population(spark)).orderBy("ordem")
    assert rows(found, "rotulo", "valor", "valor_b") == [("Bar", 9.0, 4.0), ("Pão", 5.0, 0.0)]
