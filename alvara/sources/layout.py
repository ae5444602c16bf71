"""Layout versions of the registry dump.

The shards have no header, so the column order below is the contract. A new
layout is a new entry in ``LAYOUTS``; an existing one is never edited.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableLayout:
    columns: tuple[str, ...]
    glob: str
    archives: tuple[str, ...]
    #: Columns that staged files are sorted by, file by file, for page skipping.
    clustered_by: tuple[str, ...] = ()
    #: (own name, name in the relation of all layouts) of columns that are called otherwise there.
    renamed: tuple[tuple[str, str], ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.columns])


@dataclass(frozen=True)
class Layout:
    tables: dict[str, TableLayout]
    forbidden: tuple[str, ...]
    csv: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        """No layout that reads a forbidden file can be made at all."""
        for name in self.forbidden:
            if any(name in table.archives for table in self.tables.values()):
                raise ValueError(f"{name} may not be read")

    @property
    def archives(self) -> list[str]:
        return [name for table in self.tables.values() for name in table.archives]


def _numbered(stem: str, count: int = 10) -> tuple[str, ...]:
    return tuple(f"{stem}{i}.zip" for i in range(count))


# The file contract of the public dump, layout of 2026-06. Every
# column is text. The partners' files (personal data) may never be read.
_V2026_06 = Layout(
    tables={
        "empresas": TableLayout(
            (
                "cnpj_basico", "razao_social", "natureza_juridica",
                "qualificacao_responsavel", "capital_social", "porte",
                "ente_federativo_responsavel",
            ),
            "*.EMPRECSV",
            _numbered("Empresas"),
        ),
        "estabelecimentos": TableLayout(
            (
                "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial",
                "nome_fantasia", "situacao_cadastral", "data_situacao_cadastral",
                "motivo_situacao_cadastral", "nome_cidade_exterior", "pais",
                "data_inicio_atividade", "cnae_fiscal_principal",
                "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero",
                "complemento", "bairro", "cep", "uf", "municipio", "ddd_1",
                "telefone_1", "ddd_2", "telefone_2", "ddd_fax", "fax",
                "correio_eletronico", "situacao_especial", "data_situacao_especial",
            ),
            "*.ESTABELE",
            _numbered("Estabelecimentos"),
            ("situacao_cadastral", "data_inicio_atividade"),
        ),
        "simples": TableLayout(
            (
                "cnpj_basico", "opcao_simples", "data_opcao_simples",
                "data_exclusao_simples", "opcao_mei", "data_opcao_mei",
                "data_exclusao_mei",
            ),
            "*.SIMPLES*",
            ("Simples.zip",),
        ),
        "cnaes": TableLayout(("codigo", "descricao"), "*.CNAECSV", ("Cnaes.zip",)),
        # City codes are the tax agency's, not the census bureau's.
        "municipios": TableLayout(("codigo", "descricao"), "*.MUNICCSV", ("Municipios.zip",)),
        "naturezas": TableLayout(("codigo", "descricao"), "*.NATJUCSV", ("Naturezas.zip",)),
    },
    forbidden=_numbered("Socios"),
    # Quotes inside a value are doubled, so the escape character is the quote.
    csv={
        "sep": ";",
        "header": "false",
        "quote": '"',
        "escape": '"',
        "encoding": "ISO-8859-1",
    },
)

LAYOUTS: dict[str, Layout] = {"2026-06": _V2026_06}


def layout_for(extraction: str) -> Layout:
    """Newest layout not younger than ``YYYY-MM``; before the first, the first.

    An extraction newer than every layout gets the newest one, and the column
    check reports it if the dump has changed since.
    """
    known = sorted(LAYOUTS)
    fitting = [version for version in known if version <= extraction]
    return LAYOUTS[fitting[-1] if fitting else known[0]]
