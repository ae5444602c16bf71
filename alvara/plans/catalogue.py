"""The catalogue: which cuts exist, in which queue and order, with which floors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.measures import HERO_FLOOR, RATE_FLOOR
from ..sources.dimensions import SECTORS, Sector, by_slug

NEW, CLASSIC = "novo", "classico"


@dataclass(frozen=True)
class Entry:
    queue: str
    key: str
    family: str
    floor: int = 0
    #: Sector codes by side: one side for most families, two for pairs.
    codes: dict[str, tuple[str, ...]] = field(default_factory=dict)
    params: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Settings:
    """What differs between countries, registries and test data."""

    sectors: Sequence[Sector] = tuple(SECTORS)
    leader: str = "SP"
    focus: str = "DF"
    ranked_states: Sequence[str] = ("SP", "MG", "RJ", "BA", "PR", "RS")
    labelled_states: Sequence[str] = ("SP", "MG", "RJ")
    duels: Sequence[tuple[str, str]] = (
        ("SP", "RJ"), ("MG", "BA"), ("RS", "PR"), ("PE", "CE"), ("SC", "GO"),
    )
    hero_codes: dict[str, str] = field(default_factory=lambda: dict(HERO_CODES))
    #: Replaces every floor of the catalogue, for small data.
    floor: int | None = None


# The hero sectors and their codes.
HERO_CODES = {
    "taxi": "4923001",
    "representante": "4619200",
    "maquina-agricola": "3314711",
    "faccao": "1412603",
    "calcados": "1531902",
    "colheita": "0161003",
}
HERO_LABELS = {
    "taxi": "táxi",
    "representante": "representante comercial",
    "maquina-agricola": "manutenção de máquina agrícola",
    "faccao": "facção de roupa",
    "calcados": "acabamento de calçados",
    "colheita": "serviço de colheita",
}

# The floor of each per-capita ranking.
RATE_FLOORS = {
    "total": RATE_FLOOR,
    "bar": 25,
    "salao-de-beleza": 50,
    "restaurante": 30,
    "academia": 15,
    "loja-de-roupa": 60,
    "lanchonete": 40,
    "padaria": 35,
    "food-truck": 30,
    "petshop": 25,
    "psicologia": 25,
}

# Ratio name -> sectors above, sectors below, floor, title, sentence, question.
RATIOS = {
    "bar-academia": (
        ("bar",), ("academia",), 15,
        "Bares por academia",
        "Em {lider}, abrem {r} bares novos para cada academia nova.",
        "O seu estado escolhe o happy hour ou a esteira?",
    ),
    "social-psicologia": (
        ("bar", "restaurante"), ("psicologia",), 40,
        "Bar e restaurante por psicólogo",
        "Em {lider}, abrem {r} bares e restaurantes para cada consultório de psicologia.",
        "Seu estado resolve no boteco ou no divã?",
    ),
    "padaria-petshop": (
        ("padaria",), ("petshop",), 25,
        "Padarias por petshop",
        "Em {lider}, ainda abrem {r} padarias para cada petshop.",
        "O pet vai passar a padaria no seu estado?",
    ),
    "lanchonete-restaurante": (
        ("lanchonete",), ("restaurante",), 40,
        "Lanchonetes por restaurante",
        "Em {lider}, abrem {r} lanchonetes para cada restaurante.",
        "Seu estado come em pé ou sentado?",
    ),
    "foodtruck-restaurante": (
        ("food-truck",), ("restaurante",), 40,
        "Food trucks por restaurante",
        "Em {lider}, abrem {r} food trucks para cada restaurante.",
        "A rua está ganhando do salão?",
    ),
    "roupa-salao": (
        ("loja-de-roupa",), ("salao-de-beleza",), 60,
        "Lojas de roupa por salão de beleza",
        "Em {lider}, abrem {r} lojas de roupa para cada salão de beleza.",
        "Vestir ou cuidar: o que seu estado escolhe?",
    ),
}

# Pairs of sectors that merely grow with the state.
PAIRS = {
    "padaria-psicologia": ("padaria", "psicologia"),
    "petshop-lanchonete": ("petshop", "lanchonete"),
    "salao-foodtruck": ("salao-de-beleza", "food-truck"),
    "roupa-restaurante": ("loja-de-roupa", "restaurante"),
}
FOCUS_PAIR = ("salao-de-beleza", "psicologia")

# The order of the counterintuitive queue.
NEW_ORDER = [
    "percapita|total", "percapita|bar", "assinatura", "razao|bar-academia", "lqhero|taxi",
    "percapita|salao-de-beleza", "espuria|padaria-psicologia", "percapita|restaurante",
    "dupla|{focus}", "razao|social-psicologia", "percapita|academia",
    "razao|padaria-petshop", "percapita|loja-de-roupa", "percapita|lanchonete",
    "percapita|padaria", "percapita|food-truck", "percapita|petshop",
    "percapita|psicologia", "razao|lanchonete-restaurante", "razao|foodtruck-restaurante",
    "razao|roupa-salao", "lqhero|representante", "lqhero|maquina-agricola",
    "lqhero|faccao", "lqhero|calcados", "lqhero|colheita",
    "espuria|petshop-lanchonete", "espuria|salao-foodtruck", "espuria|roupa-restaurante",
]


def counterintuitive(settings: Settings) -> list[Entry]:
    """Cuts that take the largest state off the top."""
    sectors = by_slug(list(settings.sectors))

    def codes(*slugs: str) -> tuple[str, ...]:
        return tuple(code for slug in slugs for code in sectors[slug].codes)

    def floor(value: int) -> int:
        return value if settings.floor is None else settings.floor

    def entry(key: str) -> Entry:
        family, _, name = key.partition("|")
        if family == "percapita":
            chosen = {} if name == "total" else {"a": codes(name)}
            label = "empresa" if name == "total" else sectors[name].label
            return Entry(NEW, key, family, floor(RATE_FLOORS[name]), chosen, {"label": label})
        if family == "razao":
            above, below, least, title, sentence, question = RATIOS[name]
            return Entry(
                NEW, key, family, floor(least), {"a": codes(*above), "b": codes(*below)},
                {"title": title, "sentence": sentence, "question": question},
            )
        if family == "lqhero":
            return Entry(NEW, key, family, floor(HERO_FLOOR),
                         {"a": (settings.hero_codes[name],)}, {"label": HERO_LABELS[name]})
        if family in ("espuria", "dupla"):
            a, b = FOCUS_PAIR if family == "dupla" else PAIRS[name]
            return Entry(NEW, key, family, 0, {"a": codes(a), "b": codes(b)},
                         {"label": sectors[a].label, "label_b": sectors[b].label})
        return Entry(NEW, key, family)

    return [entry(key.format(focus=settings.focus)) for key in NEW_ORDER]


def classic(settings: Settings) -> list[Entry]:
    """Board, rankings, sectors and duels."""
    entries = [
        Entry(CLASSIC, "placar_nacional", "placar_nacional"),
        Entry(CLASSIC, "ranking_cnae|BR", "ranking_cnae"),
        Entry(CLASSIC, "recorte_cidade|BR", "recorte_cidade"),
        Entry(CLASSIC, "anomalia", "anomalia"),
    ]
    entries += [
        Entry(CLASSIC, f"setor|{s.slug}", "setor", 0, {"a": s.codes}, {"label": s.label})
        for s in settings.sectors
    ]
    for uf in settings.ranked_states:
        entries += [
            Entry(CLASSIC, f"{family}|{uf}", family, params={"uf": uf})
            for family in ("ranking_cnae", "recorte_cidade")
        ]
    entries += [
        Entry(CLASSIC, f"duelo|{a}x{b}", "duelo", params={"uf": a, "uf_b": b})
        for a, b in settings.duels
    ]
    return entries


def catalogue(settings: Settings | None = None) -> list[Entry]:
    settings = settings or Settings()
    return counterintuitive(settings) + classic(settings)


def as_frame(spark: SparkSession, entries: Sequence[Entry]) -> DataFrame:
    """``fila, posicao, chave, familia, piso, params``; positions count per queue."""
    rows, position = [], {}
    for e in entries:
        position[e.queue] = position.get(e.queue, 0) + 1
        rows.append((e.queue, position[e.queue], e.key, e.family, e.floor, e.params))
    return spark.createDataFrame(
        rows, "fila string, posicao int, chave string, familia string, piso int, "
              "params map<string,string>",
    )


def codes_frame(spark: SparkSession, entries: Sequence[Entry]) -> DataFrame:
    """``chave, lado, cnae_principal``: the sector codes on each side of an entry."""
    rows = sorted({
        (e.key, side, code) for e in entries for side, codes in e.codes.items() for code in codes
    })
    return spark.createDataFrame(rows, "chave string, lado string, cnae_principal string")
