"""Captions: one text and one alternative text per cut, from its tidy rows."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..sources.aggregate_store import Openings
from ..sources.dimensions import POPULATION_SOURCE
from .catalogue import Settings

# The printed texts. A name in braces is filled in.
CREDIT = "Dados abertos da Receita Federal · extração de {data}"
WITH_POPULATION = ("percapita", "dupla")
TEXTS = {
    "placar_nacional": (
        "{total} empresas novas abriram no Brasil em {mes}.\n\n"
        "{lider} sozinho respondeu por {n} delas — {pct}% do país.\n\n"
        "Um estado só concentra {pct}% das aberturas. Isso é demais?"
    ),
    "ranking_cnae": (
        "A atividade que mais abriu empresa {onde} em {mes}:\n\n"
        "{curto60} — {n} CNPJs novos.\n\n"
        "Esperava ver esse setor no topo?"
    ),
    "recorte_cidade": (
        "As cidades que mais abriram empresa em {mes}{so_uf}:\n\n"
        "1. {lider} — {n}\n"
        "2. {segundo} — {n2}\n"
        "3. {terceiro} — {n3}\n\n"
        "Sua cidade entrou na lista?"
    ),
    "setor": (
        "Abriram {soma} {label} no Brasil em {mes}.\n\n"
        "{lider} levou {n} delas.\n\n"
        "Faz sentido {lider} liderar em {label}?"
    ),
    "duelo": (
        "{uf} x {uf_b} em {mes}: os setores que mais abriram em {uf}, "
        "e quanto {uf_b} abriu de cada um.\n\n"
        "Quem você achava que abriria mais?"
    ),
    "anomalia": (
        "O setor que mais acelerou em {mes}:\n\n"
        "{curto55} — {antes} aberturas no mês anterior, {n} agora. +{v0}%.\n\n"
        "Alguém arrisca por quê?"
    ),
    "percapita:lider": (
        "{maior} é quem mais abre {label} por habitante no Brasil: "
        "{v1} por 100 mil hab em {mes}.\n\n"
        "Dessa vez não dá para dizer que é só porque {maior} é grande — a conta "
        "já está dividida por população.\n\n"
        "O que concentra tanto esse setor em {maior}?"
    ),
    "percapita:atras": (
        "Quem mais abre {label} por habitante no Brasil é {lider}: "
        "{v1} por 100 mil hab em {mes}.\n\n"
        "São Paulo, o maior do país, é só o {pos_b}º.\n\n"
        "Você imaginava {lider} na frente de {maior}?"
    ),
    "percapita:fora": (
        "Quem mais abre {label} por habitante no Brasil é {lider}: "
        "{v1} por 100 mil hab em {mes}.\n\n"
        "Esperava esse estado no topo?"
    ),
    "razao": "{frase}\n\n{pergunta}",
    "dupla": (
        "Coincidência de {mes}: {lider} está no topo do país ao mesmo tempo em "
        "{label} e em {label_b}, por habitante.\n\n"
        "Uma coisa não causa a outra — mas que é engraçado, é.\n\n"
        "O que explica {lider} liderar os dois?"
    ),
    "assinatura": (
        "O que cada estado abre MUITO acima da média do Brasil, em {mes}.\n\n"
        "O caso mais extremo: {lider}, com {v0}× a média nacional em {trade40}.\n\n"
        "Achou a cara do seu estado?"
    ),
    "lqhero": (
        "O estado que proporcionalmente mais abre {label} no Brasil é {lider}: "
        "{v1}× a média nacional em {mes}.\n\n"
        "Não é o maior número absoluto — é o mais desproporcional. "
        "O 2º, {segundo}, fica em {w1}×.\n\n"
        "Alguém arrisca por quê?"
    ),
    "espuria": (
        "{Label} e {label_b} não têm nada a ver uma com a outra.\n\n"
        "Mesmo assim andam juntas entre os estados — a linha é quase perfeita.\n\n"
        "Antes que alguém escreva uma tese: é só o tamanho do estado."
    ),
}
ALTS = {
    "placar_nacional": "Gráfico de barras com as aberturas de empresas por estado em {mes}. {lista}.",
    "ranking_cnae": "Ranking de atividades econômicas {onde_curto} em {mes}. Topo: {lider}, {n}.",
    "recorte_cidade": "Ranking de municípios por aberturas em {mes}. Topo: {lider}, {n}.",
    "setor": "Aberturas de {label} por estado em {mes}. Líder: {lider} com {n}.",
    "duelo": "Comparação de aberturas por setor entre {uf} e {uf_b} em {mes}.",
    "anomalia": "Setores com maior crescimento de aberturas em {mes}. Topo: {lider}, +{v0}%.",
    "percapita:lider": (
        "Aberturas de {label} por 100 mil habitantes por estado em {mes}. "
        "Líder: {lider} com {v1}."
    ),
    "percapita:atras": (
        "Aberturas de {label} por 100 mil habitantes por estado em {mes}. "
        "Líder: {lider} com {v1}; São Paulo em {pos_b}º."
    ),
    "percapita:fora": (
        "Aberturas de {label} por 100 mil habitantes por estado em {mes}. "
        "Líder: {lider} com {v1}."
    ),
    "razao": "{titulo} por estado em {mes}. Líder: {lider} com {v1}.",
    "dupla": (
        "{lider} aparece em {pos_b}º em {label} e em {pos_b2}º em {label_b} "
        "por 100 mil habitantes, {mes}."
    ),
    "assinatura": "Setor mais sobre-representado de cada estado em {mes}: {lista_lq}.",
    "lqhero": (
        "{lider} abre {v1} vezes mais {label} que a média nacional, "
        "proporcionalmente, em {mes}; 2º é {segundo} com {w1}."
    ),
    "espuria": (
        "Dispersão por estado de {label} contra {label_b} em {mes}: "
        "correlação alta e espúria."
    ),
}


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """A template as one concatenation of literals and columns."""
    pieces = re.split(r"\{(\w+)\}", template)
    parts = [
        values[piece] if i % 2 else F.lit(piece) for i, piece in enumerate(pieces) if piece
    ]
    return F.concat(*parts)


def summaries(rows: DataFrame) -> DataFrame:
    """One row per entry with its first three rows side by side.

    A cut has at most as many rows as there are states, and only the board and
    the signatures list theirs (eight each).
    """
    def at(position: int, column: str) -> Column:
        return F.max(F.when(F.col("ordem") == position, F.col(column)))

    listed = F.when(
        F.col("familia").isin("placar_nacional", "assinatura") & F.col("ordem").isNotNull(),
        F.struct(
            "ordem",
            F.when(
                F.col("familia") == "assinatura",
                F.concat("rotulo", F.lit(": "), numbers.thousands_free("valor"), F.lit("×")),
            ).otherwise(F.concat("rotulo", F.lit(": "), numbers.thousands("n"))).alias("item"),
        ),
    )
    return rows.groupBy("fila", "posicao", "chave", "familia").agg(
        F.max("status").alias("status"),
        *[at(i, c).alias(f"{c}_{i}") for i in (1, 2, 3) for c in ("rotulo", "n", "valor", "valor_b")],
        at(1, "detalhe").alias("detalhe_1"),
        F.sum("n").alias("soma"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(listed)), lambda e: e["item"]), "; "
        ).alias("lista"),
    )


def captions(rows: DataFrame, entries: DataFrame, d: Openings,
             settings: Settings | None = None) -> DataFrame:
    """``chave, texto, alt, credito`` for every entry that has data.

    ``rows`` is the result of a run, ``entries`` the catalogue as a frame.
    """
    settings = settings or Settings()
    s = summaries(rows).where("status = 'ok'").join(entries.select("chave", "params"), "chave")
    params, lead = F.col("params"), F.col("rotulo_1")
    in_state = params["uf"].isNotNull()
    v1 = numbers.decimal_comma("valor_1")
    values = {
        "mes": dates.month_label(F.lit(d.month)),
        "lider": lead,
        "segundo": F.col("rotulo_2"),
        "terceiro": F.col("rotulo_3"),
        "n": numbers.thousands("n_1"),
        "n2": numbers.thousands("n_2"),
        "n3": numbers.thousands("n_3"),
        "soma": numbers.thousands("soma"),
        "total": numbers.thousands("valor_b_1"),
        "antes": numbers.thousands("valor_b_1"),
        "pct": numbers.thousands_free(numbers.percent("n_1", "valor_b_1")),
        "v0": numbers.thousands_free("valor_1"),
        "v1": v1,
        "w1": numbers.decimal_comma("valor_2"),
        "pos_b": F.col("valor_b_1").cast("int").cast("string"),
        "pos_b2": F.col("valor_b_2").cast("int").cast("string"),
        "curto60": text.shorten(lead, 60),
        "curto55": text.shorten(lead, 55),
        "trade40": F.lower(text.shorten("detalhe_1", 40)),
        "lista": F.col("lista"),
        "lista_lq": F.col("lista"),
        "label": params["label"],
        "label_b": params["label_b"],
        "Label": text.capitalised(params["label"]),
        "uf": params["uf"],
        "uf_b": params["uf_b"],
        "maior": F.lit(settings.leader),
        "onde": F.when(in_state, F.concat(F.lit("em "), params["uf"])).otherwise("no Brasil"),
        "onde_curto": F.coalesce(params["uf"], F.lit("no Brasil")),
        "so_uf": F.when(in_state, F.concat(F.lit(" (só "), params["uf"], F.lit(")"))).otherwise(""),
        "titulo": params["title"],
        "frase": F.replace(
            F.replace(params["sentence"], F.lit("{lider}"), lead), F.lit("{r}"), v1
        ),
        "pergunta": params["question"],
    }
    branch = F.when(
        F.col("familia") == "percapita",
        F.when(lead == settings.leader, "percapita:lider")
        .when(F.col("valor_b_1").isNotNull(), "percapita:atras").otherwise("percapita:fora"),
    ).otherwise(F.col("familia"))

    def chosen(templates: Mapping[str, str]) -> Column:
        chain = F.lit(None).cast("string")
        for name, template in templates.items():
            chain = F.when(F.col("_branch") == name, fill(template, values)).otherwise(chain)
        return chain

    credit = fill(CREDIT, {"data": F.date_format(F.lit(d.extraction), "dd/MM/yyyy")})
    sourced = F.concat(credit, F.lit(f" · {POPULATION_SOURCE}"))
    return s.withColumn("_branch", branch).select(
        "fila", "posicao", "chave", chosen(TEXTS).alias("texto"), chosen(ALTS).alias("alt"),
        F.when(F.col("familia").isin(*WITH_POPULATION), sourced).otherwise(credit).alias("credito"),
    )
