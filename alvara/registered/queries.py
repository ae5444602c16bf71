"""One query per operator, each over the whole of the tables it reads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..operators import companies, measures, picks, quality, rankings, weekly
from ..plans import captions as caption_plans
from ..plans import catalogue, cuts, monthly
from ..session import DROP_SHUFFLES, held, materialise, run_dir, tuned
from ..sources import aggregate_store, dimensions, manifest, registry_csv
from ..sources.layout import Layout, TableLayout, layout_for
from . import analog
from .analog import Analog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ID = ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]


def registered(function: Callable[[Analog], DataFrame]) -> Callable[[Analog], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return function(Analog(tuned(spark), folder))

    query.__doc__ = function.__doc__
    QUERIES[function.__name__] = query
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in columns})


# --- scans, sources, sinks ------------------------------------------------------


#: Rows of a packed shard, which one task reads: some 200 MB of text.
SHARD_ROWS = 1_000_000


def _shards(a: Analog) -> Layout:
    """The registry's layout, for packed shards named by Spark's own writer."""
    layout = layout_for("2026-06")
    tables = {
        name: replace(spec, glob=f"*.csv{registry_csv.PACKED}")
        for name, spec in layout.tables.items()
    }
    return Layout(tables, layout.forbidden, layout.csv)


def _write_shards(df: DataFrame, spec: TableLayout, path: str) -> None:
    """A raw table as headerless shards, missing columns empty, quotes doubled; a shard a task.

    Where the layout says that shards are packed they are, and of ``SHARD_ROWS`` rows at most.
    """
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": SHARD_ROWS}
    full = df.select(*[
        (F.col(name) if name in df.columns else F.lit("")).alias(name) for name in spec.columns
    ])
    with held(df.sparkSession, {DROP_SHUFFLES: "true"}):
        full.write.options(
            sep=";", header="false", quote='"', escape='"', encoding="ISO-8859-1", quoteAll="true",
            **(packed if spec.glob.endswith(registry_csv.PACKED) else {}),
        ).csv(path)


@registered
def scan_registry_csv(a: Analog) -> DataFrame:
    """Establishments written as raw shards and scanned; quotes, ``;`` and a control byte."""
    layout = _shards(a)
    trade_name = F.concat(
        F.lit('"'), "nome_fantasia", F.lit('"; '), "complemento", F.char(F.lit(133))
    )
    raw = a.establishments().withColumn("nome_fantasia", trade_name)
    path = run_dir(a.spark, "shards")
    _write_shards(raw, layout.tables["estabelecimentos"], path)
    return registry_csv.scan(a.spark, path, "estabelecimentos", layout)


@registered
def staged_roundtrip(a: Analog) -> DataFrame:
    """All six tables through CSV and staging; companies with their codes resolved."""
    layout, root = _shards(a), run_dir(a.spark, "staging")
    for name, df in a.raw().items():
        _write_shards(df, layout.tables[name], f"{root}/raw/2026-06/{name}")
    staged = {}
    for _ in range(2):  # the second pass finds everything done
        staged = registry_csv.stage(a.spark, f"{root}/raw", f"{root}/work", "2026-06", layout)
    named = companies.with_description(
        staged["empresas"], staged["naturezas"], "natureza_juridica", "natureza_descricao"
    )
    return companies.flag_existing(
        named, companies.sole_traders(staged["simples"]), "cnpj_basico", "eh_mei"
    ).select("cnpj_basico", "razao_social", "natureza_descricao", "capital_social", "porte", "eh_mei")


@registered
def new_companies_by_company(a: Analog) -> DataFrame:
    """All tables staged from shards, laid out by company id, and joined without a shuffle."""
    layout, root = _shards(a), run_dir(a.spark, "staging")
    for name, df in a.raw().items():
        _write_shards(df, layout.tables[name], f"{root}/raw/2026-06/{name}")
    staged = registry_csv.stage(a.spark, f"{root}/raw", f"{root}/work", "2026-06", layout)
    laid_out = registry_csv.by_company(a.spark, staged, f"{root}/work", "2026-06", 8)
    return companies.new_companies(laid_out, analog.EXTRACTION)


@registered
def shard_facts(a: Analog) -> DataFrame:
    """Rows and replaced control characters of orders written as shards, a shard a priority."""
    spec = TableLayout(("o_orderkey", "t"), "*.csv", ())
    layout = Layout({"pedidos": spec}, (), layout_for("2026-06").csv)
    root = run_dir(a.spark, "staging")
    control = F.concat(F.char(F.lit(128)), "o_orderpriority", F.char(F.lit(159)))
    dirty = F.when(F.col("o_orderstatus") == "P", control).otherwise(F.col("o_orderpriority"))
    _write_shards(a.table("orders").select("o_orderkey", dirty.alias("t")), spec, f"{root}/raw/2026-06/pedidos")
    registry_csv.stage(a.spark, f"{root}/raw", f"{root}/work", "2026-06", layout)
    facts = registry_csv.shard_facts(a.spark, f"{root}/work", "2026-06")
    return facts.groupBy("extracao", "tabela").agg(
        F.sum("linhas").alias("linhas"), F.sum("trocados").alias("trocados"))


@registered
def scrub_control_chars(a: Analog) -> DataFrame:
    control = F.concat(F.char(F.lit(128)), "o_orderpriority", F.char(F.lit(159)))
    dirty = F.when(F.col("o_orderstatus") == "P", control).otherwise(F.col("o_orderpriority"))
    return a.table("orders").select("o_orderkey", dirty.alias("t")).select(
        "o_orderkey", text.scrub_controls("t").alias("texto"),
        text.count_controls("t").cast("long").alias("trocados"),
    )


@registered
def extraction_date(a: Analog) -> DataFrame:
    """File names made of order dates, some of them misfiled or without a date."""
    day = F.col("o_orderdate").cast("date")
    stem = F.concat(
        F.lit("F.K03200$Z.D"), F.substring(F.date_format(day, "yyyyMMdd"), 4, 5),
        F.lit(".CNAECSV"),
    )
    shift = F.when(F.col("o_orderstatus") == "P", 1).when(
        F.col("o_orderpriority") == "1-URGENT", 12
    ).otherwise(0)
    files = a.table("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", "CNAECSV").otherwise(stem).alias("arquivo"),
        F.date_format(F.add_months(day, shift), "yyyy-MM").alias("extracao"),
    )
    return registry_csv.extraction_dates(files)


@registered
def open_aggregate(a: Analog) -> DataFrame:
    """Whole weeks only, with the month that their extraction closes."""
    cells = aggregate_store.whole_weeks(a.weekly())
    return cells.withColumn("mes_ref", dates.reference_month_col("data_extracao"))


@registered
def aggregate_sorted(a: Analog) -> DataFrame:
    """Published as a sorted version and read back through the ledger."""
    root = run_dir(a.spark, "aggregate")
    aggregate_store.publish(a.weekly(), root)
    return aggregate_store.current(a.spark, root)


@registered
def sector_dimension(a: Analog) -> DataFrame:
    """Friendly sectors and codes, with the parts that carry each code."""
    codes = dimensions.sector_codes(a.spark, analog.BRAND_SECTORS)
    parts = a.table("part").groupBy(F.col("p_brand").alias("cnae_principal")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return codes.join(parts, "cnae_principal", "left").select(
        "slug", "rotulo", F.col("cnae_principal").alias("codigo"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


@registered
def companies_roundtrip(a: Analog) -> DataFrame:
    """New companies as the monthly run stores them, read back."""
    return monthly.write_companies(a.raw(), analog.EXTRACTION, run_dir(a.spark, "companies"))


@registered
def aggregate_size(a: Analog) -> DataFrame:
    """The size rule of the published aggregate, under two limits."""
    size = aggregate_store.stored_bytes(a.openings().cells)
    both = [quality.aggregate_size(size, limit) for limit in (quality.AGGREGATE_WARNING_BYTES, 1)]
    return both[0].unionByName(both[1]).select("rule", "expected", "severity", "ok")


@registered
def manifest_roundtrip(a: Analog) -> DataFrame:
    """A manifest of the orders' clerks' work, an archive a priority, as JSON and back."""
    files = a.table("orders").groupBy(F.col("o_orderpriority").alias("nome")).agg(
        F.count(F.lit(1)).alias("bytes"), F.sha2(F.max("o_orderpriority"), 256).alias("sha256"))
    path = run_dir(a.spark, "manifest")
    manifest.build(files, "2026-06", "https://example.org/").coalesce(1).write.json(path)
    return manifest.read(a.spark, path)


@registered
def scan_layouts(a: Analog) -> DataFrame:
    """Orders in two dumps with unlike columns, read as one relation."""
    csv = layout_for("2026-06").csv
    old = Layout({"pedidos": TableLayout(("chave", "prioridade"), "*.csv", ())}, (), csv)
    new = Layout({"pedidos": TableLayout(("prioridade", "situacao", "id"), "*.csv", (), renamed=(("id", "chave"),))}, (), csv)
    orders, root = a.table("orders"), run_dir(a.spark, "layouts")
    late = F.col("o_orderkey") % 3 == 0
    named = orders.select(
        "o_orderkey", F.col("o_orderkey").alias("chave"), F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("prioridade"), F.col("o_orderstatus").alias("situacao"))
    for month, layout, rows in (("2026-05", old, named.where(~late)), ("2026-06", new, named.where(late))):
        _write_shards(rows, layout.tables["pedidos"], f"{root}/{month}/pedidos")
    return registry_csv.scan_history(
        a.spark, root, "pedidos", {"2026-05": old, "2026-06": new}, ["chave", "prioridade", "situacao"])


# --- filters and projections ----------------------------------------------------


@registered
def new_companies(a: Analog) -> DataFrame:
    return a.new_companies()


@registered
def new_companies_with_branches(a: Analog) -> DataFrame:
    return a.new_companies(branches=True)


@registered
def active_filter(a: Analog) -> DataFrame:
    return companies.active(a.establishments()).select(
        *ID, "situacao_cadastral", "data_situacao_cadastral"
    )


@registered
def opening_window(a: Analog) -> DataFrame:
    kept = companies.opened_within(a.establishments(), analog.EXTRACTION)
    return kept.select(*ID, dates.safe_date("data_inicio_atividade").alias("data_abertura"))


@registered
def privacy_mask(a: Analog) -> DataFrame:
    rows = a.establishments().select(*ID, text.address_line().alias("endereco"))
    flagged = companies.flag_existing(
        rows, companies.sole_traders(a.simples()), "cnpj_basico", "eh_mei"
    )
    return flagged.withColumn(
        "endereco", companies.public_address("endereco", F.col("eh_mei"))
    ).select(*ID, "eh_mei", "endereco")


@registered
def month_filter(a: Analog) -> DataFrame:
    return a.openings().in_month().select("semana", "uf", "municipio_codigo", "cnae_principal",
                                          "contagem")


@registered
def sector_membership(a: Analog) -> DataFrame:
    codes = dimensions.sector_codes(a.spark, analog.BRAND_SECTORS)
    return a.openings().cells.join(codes, "cnae_principal").select(
        "slug", "semana", "uf", "municipio_codigo", "cnae_principal", "contagem"
    )


# --- joins ----------------------------------------------------------------------


@registered
def join_companies(a: Analog) -> DataFrame:
    return a.establishments().join(a.companies(), "cnpj_basico").select(*ID, "razao_social")


@registered
def existence_flag_join(a: Analog) -> DataFrame:
    return companies.flag_existing(
        a.companies(), companies.sole_traders(a.simples()), "cnpj_basico", "eh_mei"
    ).select("cnpj_basico", "eh_mei")


@registered
def dimension_lookup(a: Analog) -> DataFrame:
    rows = a.establishments().select(
        *ID, F.col("cnae_fiscal_principal").alias("cnae_principal"),
        F.col("municipio").alias("municipio_codigo"),
    )
    rows = companies.with_description(rows, a.sectors(), "cnae_principal", "cnae_descricao")
    rows = companies.with_description(rows, a.cities(), "municipio_codigo", "municipio")
    return rows.select(*ID, "cnae_principal", "cnae_descricao", "municipio_codigo", "municipio")


# --- aggregates and rankings ----------------------------------------------------


@registered
def weekly_aggregate(a: Analog) -> DataFrame:
    return a.weekly()


@registered
def merge_extractions(a: Analog) -> DataFrame:
    return weekly.merge_extractions(a.weekly(analog.NEWER_EXTRACTION), a.weekly())


@registered
def merge_by_week(a: Analog) -> DataFrame:
    """The newer extraction published over the older one, week by week, and read back."""
    root = run_dir(a.spark, "aggregate")
    aggregate_store.publish(a.weekly(), root)
    newer = a.weekly(analog.NEWER_EXTRACTION)
    monthly.publish_month(a.spark, newer, analog.NEWER_EXTRACTION, root)
    return aggregate_store.current(a.spark, root)


@registered
def merge_keeping_left_edge(a: Analog) -> DataFrame:
    return weekly.merge_extractions(
        a.weekly(analog.NEWER_EXTRACTION), a.weekly(), left_edge="keep"
    )


@registered
def aggregate_summary(a: Analog) -> DataFrame:
    return aggregate_store.summary(a.weekly())


@registered
def month_total(a: Analog) -> DataFrame:
    return rankings.month_total(a.openings())


@registered
def top_states(a: Analog) -> DataFrame:
    return rankings.top_states(a.openings())


@registered
def top_sectors(a: Analog) -> DataFrame:
    return rankings.top_sectors(a.openings())


@registered
def top_sectors_state(a: Analog) -> DataFrame:
    return rankings.top_sectors_all(a.openings())


@registered
def top_cities(a: Analog) -> DataFrame:
    return rankings.top_cities(a.openings())


@registered
def top_cities_state(a: Analog) -> DataFrame:
    return rankings.top_cities_all(a.openings())


@registered
def sector_top_states(a: Analog) -> DataFrame:
    codes = dimensions.codes_of(["bar", "padaria"], analog.BRAND_SECTORS)
    return rankings.sector_top_states(a.openings(), codes)


@registered
def state_totals(a: Analog) -> DataFrame:
    return rankings.state_totals(a.openings())


@registered
def sector_state_totals(a: Analog) -> DataFrame:
    codes = dimensions.sector_codes(a.spark, analog.BRAND_SECTORS)
    return rankings.sector_states(a.openings(), codes, ["slug"])


@registered
def location_quotient(a: Analog) -> DataFrame:
    floor, national = analog.QUOTIENT_FLOORS
    return rounded(
        measures.location_quotient(a.openings(), floor=floor, national_floor=national), "lq"
    )


@registered
def growth_by_sector(a: Analog) -> DataFrame:
    return rounded(measures.growth_by_sector(a.openings(), floor=analog.GROWTH_FLOOR), "variacao")


@registered
def growth_plausible(a: Analog) -> DataFrame:
    growth = measures.growth_by_sector(a.openings(), floor=analog.GROWTH_FLOOR)
    return rounded(measures.plausible_growth(growth, analog.GROWTH_CEILING), "variacao")


@registered
def sql_extension(a: Analog) -> DataFrame:
    """A user's own parameterised SQL over the aggregate."""
    return a.openings().sql(
        "SELECT uf, municipio_codigo, CAST(sum(contagem) AS BIGINT) AS n FROM agregados "
        "WHERE semana >= :since AND uf <> :abroad GROUP BY uf, municipio_codigo",
        since=analog.MONTH, abroad=dimensions.ABROAD,
    )


# --- cuts -----------------------------------------------------------------------


def _month(a: Analog, entries: Sequence[catalogue.Entry]) -> cuts.Month:
    return cuts.Month(
        a.openings(), a.population(), analog.SETTINGS, entries, analog.QUOTIENT_FLOORS,
        analog.GROWTH_FLOOR, analog.GROWTH_CEILING,
    )


def _cut(a: Analog, family: str, keys: Callable[[str], bool] = lambda key: True) -> DataFrame:
    entries = [
        e for e in catalogue.catalogue(analog.SETTINGS) if e.family == family and keys(e.key)
    ]
    return rounded(cuts.FAMILIES[family](_month(a, entries)), "valor", "valor_b")


@registered
def national_board(a: Analog) -> DataFrame:
    board = _cut(a, "placar_nacional")
    lead = F.round(numbers.percent("valor", "valor_b"), 6)
    return board.withColumn("pct", lead)


@registered
def sector_spotlight(a: Analog) -> DataFrame:
    """Top states per sector, the total of those shown and the national total."""
    codes = dimensions.sector_codes(a.spark, analog.BRAND_SECTORS)
    states = rankings.sector_states(a.openings(), codes, ["slug"], abroad=True)
    return rankings.with_totals(states, "slug").withColumn("destaque", F.col("posicao") == 1)


@registered
def duel(a: Analog) -> DataFrame:
    return _cut(a, "duelo")


@registered
def per_capita_total(a: Analog) -> DataFrame:
    return _cut(a, "percapita", lambda key: key == "percapita|total")


@registered
def per_capita(a: Analog) -> DataFrame:
    return _cut(a, "percapita", lambda key: key != "percapita|total")


@registered
def sector_ratio(a: Analog) -> DataFrame:
    return _cut(a, "razao")


@registered
def focus_position(a: Analog) -> DataFrame:
    return _cut(a, "dupla")


@registered
def signature_sector(a: Analog) -> DataFrame:
    return _cut(a, "assinatura")


@registered
def lq_hero(a: Analog) -> DataFrame:
    return _cut(a, "lqhero")


@registered
def sector_scatter(a: Analog) -> DataFrame:
    return _cut(a, "espuria")


@registered
def trend_line(a: Analog) -> DataFrame:
    points = _cut(a, "espuria").select(
        "chave", F.col("valor").alias("x"), F.col("valor_b").alias("y")
    )
    return rounded(
        measures.trend_line(points, ["chave"]),
        "inclinacao", "intercepto", "x_min", "y_min", "x_max", "y_max",
    )


def _all_cuts(a: Analog, month: dt.date | None = None) -> DataFrame:
    return cuts.run(
        a.openings(), catalogue.catalogue(analog.SETTINGS), a.population(), analog.SETTINGS,
        analog.QUOTIENT_FLOORS, analog.GROWTH_FLOOR, analog.GROWTH_CEILING, month=month,
    )


@registered
def all_cuts(a: Analog) -> DataFrame:
    return rounded(_all_cuts(a), "valor", "valor_b", *cuts.LINE)


@registered
def all_cuts_of_a_month(a: Analog) -> DataFrame:
    """The whole catalogue for a month of choice, here the one before the last."""
    return rounded(_all_cuts(a, analog.PREVIOUS), "valor", "valor_b", *cuts.LINE)


@registered
def caption_length(a: Analog) -> DataFrame:
    """Every caption of the catalogue, its length and the verdict on it."""
    entries = catalogue.as_frame(a.spark, catalogue.catalogue(analog.SETTINGS))
    written = caption_plans.captions(_all_cuts(a), entries, a.openings(), analog.SETTINGS)
    return quality.with_lengths(written.select("chave", "texto", "alt", "credito"))


def _queues(a: Analog) -> tuple[DataFrame, DataFrame]:
    """Customers queue up per nation and segment: the entries and their uses.

    By nation, queues are fresh, partly used, used up but for late entries in one
    segment, and in their second cycle.
    """
    people = a.table("customer").join(
        a.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    entries = people.select(
        F.col("n_name").alias("extracao"), F.col("c_mktsegment").alias("fila"),
        F.col("c_custkey").alias("posicao"), F.col("c_name").alias("chave"),
        (F.col("c_nationkey") % 4).alias("_state"),
    )
    late = (F.col("fila") == "BUILDING") & (F.col("posicao") % 50 == 0)
    part = F.col("posicao") % 3
    first = entries.where(
        ((F.col("_state") == 1) & (part != 0)) | (F.col("_state") == 3)
        | ((F.col("_state") == 2) & ~late)
    ).withColumn("ciclo", F.lit(1))
    second = entries.where((F.col("_state") == 3) & (part == 1)).withColumn("ciclo", F.lit(2))
    return entries, first.unionByName(second).select("extracao", "fila", "ciclo", "chave")


@registered
def next_unused(a: Analog) -> DataFrame:
    return picks.next_unused(*_queues(a))


@registered
def recorded_uses(a: Analog) -> DataFrame:
    """What comes next in each queue, recorded in two deliveries and read back."""
    root = run_dir(a.spark, "uses")
    chosen = picks.next_unused(*_queues(a))
    for part in ("extracao < 'NATION_2'", "extracao >= 'NATION_2'"):
        picks.record_use(chosen.where(part), root)
    return picks.read_uses(a.spark, root)


# --- scalar functions -----------------------------------------------------------


@registered
def safe_date(a: Analog) -> DataFrame:
    return a.establishments().select(
        *ID, dates.safe_date("data_inicio_atividade").alias("data_abertura"),
        dates.safe_date("data_situacao_cadastral").alias("data_situacao"),
    )


@registered
def safe_decimal(a: Analog) -> DataFrame:
    """Order totals as decimal-comma text; pending ones are no numbers at all."""
    amount = F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(","))
    junk = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(amount)
    return a.table("orders").select("o_orderkey", numbers.safe_decimal(junk).alias("valor"))


@registered
def address_concat(a: Analog) -> DataFrame:
    return a.establishments().select(*ID, text.address_line().alias("endereco"))


@registered
def size_class(a: Analog) -> DataFrame:
    flagged = companies.flag_existing(
        a.companies(), companies.sole_traders(a.simples()), "cnpj_basico", "eh_mei"
    )
    return flagged.select(
        "cnpj_basico", companies.size_class(F.col("eh_mei"), "porte").alias("porte")
    )


@registered
def reference_month(a: Analog) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return a.table("orders").select(
        "o_orderkey", dates.week_start(day).alias("semana"),
        dates.reference_month_col(day).alias("mes_ref"),
        dates.is_partial_week(dates.week_start(day), F.lit(analog.EXTRACTION)).alias("parcial"),
    )


@registered
def month_label(a: Analog) -> DataFrame:
    return a.table("orders").select("o_orderkey", dates.month_label("o_orderdate").alias("rotulo"))


@registered
def format_thousands(a: Analog) -> DataFrame:
    return a.table("orders").select(
        "o_orderkey", numbers.thousands("o_orderkey").alias("chave"),
        numbers.thousands("o_totalprice").alias("valor"),
    )


@registered
def format_decimal(a: Analog) -> DataFrame:
    return a.table("orders").select(
        "o_orderkey", numbers.decimal_comma("o_totalprice").alias("valor"),
        numbers.decimal_comma("o_totalprice", 2).alias("valor2"),
    )


@registered
def format_company_id(a: Analog) -> DataFrame:
    return a.establishments().select(
        *ID, text.company_id(F.concat(*ID)).alias("cnpj_formatado")
    )


@registered
def shorten_label(a: Analog) -> DataFrame:
    return a.table("documents").select(
        "doc_id", text.shorten("text").alias("curto"), text.shorten("text", 60).alias("curto60"),
        text.description_key("text").alias("chave"), text.capitalised("lang").alias("idioma"),
    )


def _descriptions(a: Analog) -> DataFrame:
    """Part descriptions in the wording of official sectors, alike up to their tails."""
    kind = F.col("p_type")
    tail = (
        F.when(kind == "ECONOMY", F.concat(F.lit(", exceto "), "p_name", F.lit(", municipal")))
        .when(kind == "LARGE", F.concat(F.lit(", Exceto "), "p_name", F.lit(", municipal.")))
        .when(kind == "PROMO", F.lit(" não especificados\u00a0anteriormente\u00a0"))
        .when(kind == "SMALL", F.lit(", nao especificada anteriormente.\n"))
        .otherwise(F.lit(", municipal"))
    )
    body = F.concat(F.lit(" Transporte de carga "), F.col("p_size").cast("string"), tail)
    return a.table("part").select("p_partkey", "p_brand", body.alias("descricao"))


@registered
def label_variants(a: Analog) -> DataFrame:
    short, specified, whole = text.label_variants("descricao")
    return _descriptions(a).select(
        "p_partkey", short.alias("curta"), specified.alias("media"), whole.alias("completa")
    )


@registered
def distinct_labels(a: Analog) -> DataFrame:
    return text.distinct_labels(_descriptions(a), "descricao", ["p_brand"])


# --- data quality ---------------------------------------------------------------


@registered
def check_complete_load(a: Analog) -> DataFrame:
    """Orders as archives: manifest sizes from all lines, disk sizes without returns."""
    name = F.concat(F.lit("Pedido"), F.col("l_orderkey").cast("string"), F.lit(".zip"))
    size = F.sum("l_quantity").cast("long").alias("bytes")
    lines = a.table("lineitem")
    expected = a.table("orders").select(
        F.concat(F.lit("Pedido"), F.col("o_orderkey").cast("string"), F.lit(".zip")).alias("nome")
    )
    return quality.complete_load(
        expected,
        lines.groupBy(name.alias("nome")).agg(size),
        lines.where(F.col("l_returnflag") != "R").groupBy(name.alias("nome")).agg(size),
    )


@registered
def check_columns(a: Analog) -> DataFrame:
    """Two-column shards in which some rows are short or long; all rows are checked."""
    layout = Layout(
        {"cnaes": TableLayout(("codigo", "descricao"), "*.txt", ("Cnaes.zip",))}, (),
        layout_for("2026-06").csv,
    )
    line = F.concat(
        F.col("o_orderkey").cast("string"),
        F.when(F.col("o_orderstatus") == "F", "")
        .otherwise(F.concat(F.lit(';"'), "o_orderpriority", F.lit('"'))),
        F.when(F.col("o_orderstatus") == "P", ";extra").otherwise(""),
    )
    path = run_dir(a.spark, "widths")
    a.table("orders").select(line.alias("value")).write.text(path)
    widths = quality.row_widths(a.spark, path, "cnaes", layout)
    return widths.agg(F.sum("rows").alias("linhas"), F.sum("bad").alias("tortas"))


@registered
def forbidden_files(a: Analog) -> DataFrame:
    """Customer archives against the numbers of suppliers in debt."""
    def archive(key: str) -> Column:
        return F.concat(F.lit("Socios"), F.col(key).cast("string"), F.lit(".zip")).alias("nome")

    banned = a.table("supplier").where("s_acctbal < 0").select(archive("s_suppkey"))
    return quality.forbidden_files(
        a.table("customer").select(archive("c_custkey")), banned, "on disk"
    )


@registered
def check_privacy(a: Analog) -> DataFrame:
    return quality.company_rules(a.new_companies(), bounds=analog.BOUNDS).where(
        F.col("rule").isin("allowed_columns", "private_address")
    )


@registered
def check_magnitude(a: Analog) -> DataFrame:
    return quality.company_rules(a.new_companies(), bounds=analog.BOUNDS).where("rule = 'magnitude'")


@registered
def check_reactivation(a: Analog) -> DataFrame:
    return quality.reactivation(a.establishments(), analog.EXTRACTION)


@registered
def hq_vs_branch(a: Analog) -> DataFrame:
    return rounded(
        quality.head_office_share(a.establishments(), analog.EXTRACTION),
        "matrizes_mes", "filiais_mes", "pct_filiais",
    )


@registered
def state_share(a: Analog) -> DataFrame:
    return rounded(quality.state_share(a.new_companies()), "pct")


@registered
def recent_weeks(a: Analog) -> DataFrame:
    return quality.recent_weeks(a.new_companies(), analog.EXTRACTION)


@registered
def spot_sample(a: Analog) -> DataFrame:
    return quality.spot_sample(a.new_companies())


@registered
def check_report(a: Analog) -> DataFrame:
    return quality.report(
        materialise(a.new_companies(), "companies"), a.raw(), analog.EXTRACTION, bounds=analog.BOUNDS,
        leader=analog.LEADER, share_bounds=analog.SHARE_BOUNDS,
    )


@registered
def duplicate_codes(a: Analog) -> DataFrame:
    """Part names as codes: most occur many times and would multiply a lookup."""
    names = a.table("part").select(F.col("p_name").alias("codigo"))
    return quality.duplicate_codes(names, "part")
