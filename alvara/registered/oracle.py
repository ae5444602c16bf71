"""The SQL that each registered query is compared with, over the same tables.

Parameters come from :mod:`analog`; the statements are written on their own, one
entry at a time where the Spark plans answer many entries at once.
"""

from __future__ import annotations

import re

from ..functions.dates import previous_month
from ..plans import captions as C
from ..plans.catalogue import Entry, catalogue
from ..sources.dimensions import POPULATION_SOURCE
from . import analog as A

ORACLE: dict[str, str] = {}

NEW, OLD = A.NEWER_EXTRACTION.isoformat(), A.EXTRACTION.isoformat()
MONTH, BEFORE = A.MONTH.isoformat(), A.PREVIOUS.isoformat()
WINDOW = 90


def pad(value: str, width: int) -> str:
    text = f"cast({value} as varchar)"
    return f"lpad({text}, cast(greatest(length({text}), {width}) as integer), '0')"


def date_of(text: str) -> str:
    return (
        f"case when regexp_full_match({text}, '[0-9]{{8}}') "
        f"then cast(try_strptime({text}, '%Y%m%d') as date) end"
    )


CITY = "cast(c_nationkey * 10 + c_custkey % 4 as varchar)"

TABLES = f"""
est as (
  select {pad('o_custkey', 8)} cnpj_basico, {pad('l_orderkey % 10000', 4)} cnpj_ordem,
    {pad('l_linenumber', 2)} cnpj_dv,
    case when l_linenumber <= 5 then '1' else '2' end identificador_matriz_filial,
    case when l_quantity < 5 then '' else p_name end nome_fantasia,
    case when l_returnflag = 'R' then '08' else '02' end situacao_cadastral,
    strftime(l_shipdate, '%Y%m%d') data_situacao_cadastral,
    case when l_orderkey % 97 = 0 then '00000000' when l_orderkey % 101 = 0 then ''
      else strftime(o_orderdate, '%Y%m%d') end data_inicio_atividade,
    p_brand cnae_fiscal_principal,
    case when l_linestatus = 'F' then '' else p_brand || ',' || p_type end cnae_fiscal_secundaria,
    case when o_orderstatus = 'P' or l_linestatus = 'F' then '' else p_type end tipo_logradouro,
    case when o_orderstatus = 'P' then '' else p_name end logradouro,
    case when o_orderstatus = 'P' then '' else cast(p_size as varchar) end numero,
    case when o_orderstatus = 'P' or l_quantity < 10 then '' else o_orderpriority end complemento,
    '' bairro,
    case when o_orderstatus = 'P' then '' else {pad('l_partkey', 8)} end cep,
    case when c_nationkey = 24 then 'EX' else n_name end uf,
    {CITY} municipio
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey),
emp as (
  select {pad('c_custkey', 8)} cnpj_basico, c_name razao_social,
    cast(n_regionkey as varchar) natureza_juridica,
    replace(cast(c_acctbal as varchar), '.', ',') capital_social,
    case c_mktsegment when 'AUTOMOBILE' then '01' when 'BUILDING' then '03'
      when 'FURNITURE' then '05' else '00' end porte
  from customer join nation on c_nationkey = n_nationkey),
mei as (select {pad('c_custkey', 8)} cnpj_basico from customer where c_mktsegment = 'HOUSEHOLD'),
cna as (
  select distinct p_brand codigo,
    'Comercio de ' || p_brand || ', exceto usados, nao especificados anteriormente' descricao
  from part where p_brand <> '{A.UNDESCRIBED}'),
mun as (select distinct {CITY} codigo, 'CITY_' || {CITY} descricao from customer),
nat as (select cast(r_regionkey as varchar) codigo, r_name descricao from region),
pop as (
  select n_name uf, count(*) * 1000 hab from customer join nation on c_nationkey = n_nationkey
  where n_nationkey <> 24 group by n_name),
ender as (
  select *, nullif(trim(array_to_string(list_filter(
      [tipo_logradouro, logradouro, numero, complemento, bairro, cep], lambda p: p <> ''), ' ')), '') endereco,
    {date_of('data_inicio_atividade')} abertura, {date_of('data_situacao_cadastral')} situacao
  from est)"""


def named_in(table: str, value: str, key: str, wanted: str) -> str:
    return f"(select max({value}) from {table} where {table}.{key} = {wanted})"


def companies(name: str, day: str, branches: bool = False) -> str:
    """An active establishment opened in the window, with what its company has on record."""
    company = "e.cnpj_basico"
    office = "in ('1', '2')" if branches else "= '1'"
    return f"""
{name} as (
  select concat(cnpj_basico, cnpj_ordem, cnpj_dv) cnpj, razao_social,
    case when nome_fantasia <> '' then nome_fantasia end nome_fantasia,
    cnae_fiscal_principal cnae_principal,
    {named_in('cna', 'descricao', 'codigo', 'cnae_fiscal_principal')} cnae_descricao,
    case when cnae_fiscal_secundaria <> '' then cnae_fiscal_secundaria end cnaes_secundarios,
    abertura data_abertura, situacao data_situacao, natureza_juridica,
    {named_in('nat', 'descricao', 'codigo', 'natureza_juridica')} natureza_descricao,
    case when eh_mei then 'MEI'
      else map {{'01': 'ME', '03': 'EPP', '05': 'demais'}}[porte] end porte,
    try_cast(replace(capital_social, ',', '.') as decimal(15, 2)) capital_social,
    municipio municipio_codigo, {named_in('mun', 'descricao', 'codigo', 'municipio')} municipio,
    uf, if(eh_mei, null, endereco) endereco, eh_mei
  from (
    select *, {company} in (select cnpj_basico from mei) eh_mei,
      {named_in('emp', 'razao_social', 'cnpj_basico', company)} razao_social,
      {named_in('emp', 'natureza_juridica', 'cnpj_basico', company)} natureza_juridica,
      {named_in('emp', 'capital_social', 'cnpj_basico', company)} capital_social,
      {named_in('emp', 'porte', 'cnpj_basico', company)} porte
    from ender e
    where {company} in (select cnpj_basico from emp) and situacao_cadastral = '02'
      and identificador_matriz_filial {office}
      and date_diff('day', abertura, date '{day}') between 0 and {WINDOW}))"""


def weeks(name: str, source: str, day: str) -> str:
    """Openings counted by the Monday of their week; a week is whole once its Sunday is in."""
    return f"""
{name} as (
  select segunda semana, uf, municipio_codigo, municipio, cnae_principal, cnae_descricao,
    count(*) contagem, date '{day}' data_extracao, date_diff('day', segunda, date '{day}') < 6 semana_parcial
  from (select *, data_abertura - cast(isodow(data_abertura) - 1 as integer) segunda from {source})
  where segunda is not null and uf is not null group by all)"""


AGG = ",".join([TABLES, companies("novas", OLD), weeks("agg", "novas", OLD)])
CELLS = AGG + f""",
cel as (select * from agg where not semana_parcial),
mes as (select * from cel where date_trunc('month', semana) = date '{MONTH}'),
ant as (select * from cel where date_trunc('month', semana) = date '{BEFORE}'),
casa as (select * from mes where uf <> 'EX')"""


def sql(name: str, base: str, query: str) -> None:
    ORACLE[name] = f"with recursive {base.strip()}\n{query.strip()}" if base else query.strip()


def listed(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


SLUGS = "slugs as (select * from (values " + ", ".join(
    f"('{s.slug}', '{s.label}', '{code}')" for s in A.BRAND_SECTORS for code in s.codes
) + ") v(slug, rotulo, codigo))"

# --- scans, sources, sinks ------------------------------------------------------

_empty = [
    "motivo_situacao_cadastral", "nome_cidade_exterior", "pais", "ddd_1", "telefone_1", "ddd_2",
    "telefone_2", "ddd_fax", "fax", "correio_eletronico", "situacao_especial",
    "data_situacao_especial", "bairro",
]
_filled = [
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "situacao_cadastral",
    "data_situacao_cadastral", "data_inicio_atividade", "cnae_fiscal_principal",
    "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero", "complemento", "cep",
    "uf", "municipio",
]
sql("scan_registry_csv", TABLES, f"""
select {', '.join(f"nullif({c}, '') {c}" for c in _filled)},
  {', '.join(f"cast(null as varchar) {c}" for c in _empty)},
  '"' || nome_fantasia || '"; ' || complemento || '?' nome_fantasia
from est""")
sql("staged_roundtrip", TABLES, """
select emp.cnpj_basico, razao_social, descricao natureza_descricao, capital_social, porte,
  exists (select 1 from mei where mei.cnpj_basico = emp.cnpj_basico) eh_mei
from emp left join nat on nat.codigo = emp.natureza_juridica""")
sql("shard_facts", "", """
select '2026-06' extracao, 'pedidos' tabela, count(*) linhas,
  cast(2 * count(case when o_orderstatus = 'P' then 1 end) as bigint) trocados from orders""")
sql("scrub_control_chars", "", r"""
select o_orderkey,
  regexp_replace(case when o_orderstatus = 'P' then chr(128) || o_orderpriority || chr(159)
    else o_orderpriority end, '[\x{80}-\x{9F}]', '?', 'g') texto,
  cast(case when o_orderstatus = 'P' then 2 else 0 end as bigint) trocados
from orders""")
sql("extraction_date", "", """
with f as (
  select o_orderkey,
    case when o_orderpriority = '5-LOW' then 'CNAECSV'
      else 'F.K03200$Z.D' || right(strftime(o_orderdate, '%Y%m%d'), 5) || '.CNAECSV' end arquivo,
    strftime(o_orderdate + to_months(cast(case when o_orderstatus = 'P' then 1
      when o_orderpriority = '1-URGENT' then 12 else 0 end as integer)), '%Y-%m') extracao,
    o_orderpriority = '5-LOW' undated, cast(o_orderdate as date) dia
  from orders),
g as (
  select *, try_cast(left(extracao, 4) || strftime(dia, '-%m-%d') as date) lido from f),
h as (
  select o_orderkey, arquivo, extracao, case when undated then 'no date in the name'
    when substr(extracao, 4, 1) <> substr(strftime(dia, '%Y'), 4, 1)
      then 'year differs from the folder'
    when lido is null then 'not a calendar date'
    when strftime(lido, '%Y-%m') <> extracao then 'outside the month' end problema, lido
  from g)
select o_orderkey, arquivo, extracao, problema,
  case when problema is null then lido end data_extracao from h""")
sql("open_aggregate", AGG, f"""
select *, cast(date_trunc('month', date '{OLD}') - interval 1 month as date) mes_ref
from agg where not semana_parcial""")
sql("aggregate_sorted", AGG, "select * from agg")
sql("sector_dimension", SLUGS, """
select slug, rotulo, codigo, count(p_partkey) n
from slugs left join part on p_brand = codigo group by all""")

sql("companies_roundtrip", TABLES + "," + companies("novas", OLD), "select * from novas")
sql("aggregate_size", "", """
select 'aggregate_size' rule, v.expected, 'soft' severity, v.ok
from (values ('50000000', true), ('1', false)) v(expected, ok)""")
sql("manifest_roundtrip", "", """
select o_orderpriority nome, count(*) bytes, sha256(o_orderpriority) sha256 from orders group by 1""")
sql("scan_layouts", "", """
select case when o_orderkey % 3 = 0 then '2026-06' else '2026-05' end extracao, cast(o_orderkey as varchar) chave,
  o_orderpriority prioridade, case when o_orderkey % 3 = 0 then o_orderstatus end situacao from orders""")

# --- filters and projections ----------------------------------------------------

sql("new_companies", TABLES + "," + companies("novas", OLD), "select * from novas")
sql("new_companies_by_company", TABLES + "," + companies("novas", OLD), "select * from novas")
sql("new_companies_with_branches", TABLES + "," + companies("novas", OLD, True),
    "select * from novas")
sql("active_filter", TABLES, """
select cnpj_basico, cnpj_ordem, cnpj_dv, situacao_cadastral, data_situacao_cadastral
from est where situacao_cadastral = '02'""")
sql("opening_window", TABLES, f"""
select cnpj_basico, cnpj_ordem, cnpj_dv, abertura data_abertura from ender
where abertura >= date '{OLD}' - {WINDOW} and abertura <= date '{OLD}'""")
sql("privacy_mask", TABLES, """
select cnpj_basico, cnpj_ordem, cnpj_dv, cnpj_basico in (from mei) eh_mei,
  case when cnpj_basico not in (from mei) then endereco end endereco from ender""")
sql("month_filter", CELLS, "select semana, uf, municipio_codigo, cnae_principal, contagem from mes")
sql("sector_membership", CELLS + "," + SLUGS, """
select slug, semana, uf, municipio_codigo, cnae_principal, contagem
from cel join slugs on codigo = cnae_principal""")

# --- joins ----------------------------------------------------------------------

sql("join_companies", TABLES, """
select est.cnpj_basico, cnpj_ordem, cnpj_dv, razao_social
from est join emp on est.cnpj_basico = emp.cnpj_basico""")
sql("existence_flag_join", TABLES, """
select emp.cnpj_basico, mei.cnpj_basico is not null eh_mei
from emp left join mei on mei.cnpj_basico = emp.cnpj_basico""")
sql("dimension_lookup", TABLES, """
select cnpj_basico, cnpj_ordem, cnpj_dv, cnae_fiscal_principal cnae_principal,
  cna.descricao cnae_descricao, municipio municipio_codigo, mun.descricao municipio
from est left join cna on cna.codigo = cnae_fiscal_principal
  left join mun on mun.codigo = municipio""")

# --- aggregates and rankings ----------------------------------------------------

sql("weekly_aggregate", AGG, "select * from agg")
_two = ",".join([AGG, companies("novas2", NEW), weeks("agg2", "novas2", NEW)])
_merged = """
select unnest(arg_max(linha, vez)) from (
  select t as linha, t.semana, t.uf, t.municipio_codigo, t.cnae_principal, {turn} vez
  from (select * from agg2 union all by name select * from agg) t)
group by semana, uf, municipio_codigo, cnae_principal"""
sql("merge_extractions", _two, _merged.format(turn="epoch(t.data_extracao)"))
sql("merge_by_week", _two, _merged.format(turn="epoch(t.data_extracao)"))
sql("merge_keeping_left_edge", _two,
    _merged.format(turn=f"epoch(t.data_extracao) + if(t.semana < t.data_extracao - {WINDOW}, 0, 1e12)"))
sql("aggregate_summary", AGG, "select count(*) linhas, count(distinct semana) semanas from agg")
sql("month_total", CELLS, "select cast(coalesce(sum(contagem), 0) as bigint) total from mes")


def top(label: str, source: str, name: str, condition: str = "true", limit: int = 8) -> str:
    return f"""
select {label} {name}, cast(sum(contagem) as bigint) n from {source} where {condition}
group by 1 order by 2 desc, 1 limit {limit}"""


sql("top_states", CELLS, top("uf", "mes", "uf"))
sql("top_sectors", CELLS, top("cnae_descricao", "mes", "cnae_descricao", "cnae_descricao is not null"))
sql("top_cities", CELLS, top("municipio || '/' || uf", "mes", "cidade", "municipio is not null"))


def top_per_state(label: str, name: str, condition: str) -> str:
    return f"""
select * from (
  select uf, {name}, n, cast(row_number() over (partition by uf order by n desc, {name}) as integer)
    posicao
  from (select uf, {label} {name}, cast(sum(contagem) as bigint) n from mes where {condition}
        group by all))
where posicao <= 8"""


sql("top_sectors_state", CELLS,
    top_per_state("cnae_descricao", "cnae_descricao", "cnae_descricao is not null"))
sql("top_cities_state", CELLS,
    top_per_state("municipio || '/' || uf", "cidade", "municipio is not null"))
_codes = [c for s in A.BRAND_SECTORS if s.slug in ("bar", "padaria") for c in s.codes]
sql("sector_top_states", CELLS, top("uf", "mes", "uf", f"cnae_principal in ({listed(_codes)})"))
sql("state_totals", CELLS, "select uf, cast(sum(contagem) as bigint) n from casa group by uf")
sql("sector_state_totals", CELLS + "," + SLUGS, """
select slug, uf, cast(sum(contagem) as bigint) n from casa join slugs on codigo = cnae_principal
group by all""")

LQ = f"""
peso as (
  select uf, cnae_principal, max(cnae_descricao) descricao, cast(sum(contagem) as bigint) n,
    sum(sum(contagem)) over (partition by uf) na_uf,
    cast(sum(sum(contagem)) over (partition by cnae_principal) as bigint) total_setor,
    sum(sum(contagem)) over () ao_todo
  from casa where cnae_descricao is not null group by uf, cnae_principal),
lqs as (
  select uf, cnae_principal, descricao, n, total_setor,
    (n::double / na_uf::double) / (total_setor::double / ao_todo::double) lq
  from peso where n >= {A.QUOTIENT_FLOORS[0]} and total_setor >= {A.QUOTIENT_FLOORS[1]})"""
sql("location_quotient", CELLS + "," + LQ, "select * replace (round(lq, 6) as lq) from lqs")

GROWTH = f"""
cresc as (
  select *, 100.0::double * (agora - antes) / antes variacao from (
    select cnae_descricao,
      cast(sum(contagem) filter (semana >= date '{MONTH}' and semana < date '{MONTH}' + interval 1 month)
        as bigint) agora,
      cast(sum(contagem) filter (semana >= date '{BEFORE}' and semana < date '{MONTH}') as bigint) antes
    from cel where cnae_descricao is not null group by cnae_descricao)
  where agora >= {A.GROWTH_FLOOR} and antes >= {A.GROWTH_FLOOR}
  order by variacao desc, cnae_descricao limit 5),
plaus as (
  select * from cresc
  where variacao <= {A.GROWTH_CEILING} or (select min(variacao) from cresc) > {A.GROWTH_CEILING})"""
sql("growth_by_sector", CELLS + "," + GROWTH,
    "select * replace (round(variacao, 6) as variacao) from cresc")
sql("growth_plausible", CELLS + "," + GROWTH,
    "select * replace (round(variacao, 6) as variacao) from plaus")
sql("sql_extension", CELLS, f"""
select uf, municipio_codigo, cast(sum(contagem) as bigint) n from cel
where semana >= date '{MONTH}' and uf <> 'EX' group by all""")

# --- cuts: one statement per catalogue entry ------------------------------------

PICKED = LQ + """,
ord as (
  select *, lower(left(string_split(descricao, ',')[1], 22)) ramo,
    row_number() over (order by lq desc, uf, cnae_principal) rn from lqs),
anda as (
  select 0::bigint rn, []::varchar[] ufs, []::varchar[] ramos, null::varchar uf,
    null::varchar descricao, null::double lq, false pego
  union all
  select o.rn,
    case when ok then list_append(ufs, o.uf) else ufs end,
    case when ok then list_append(ramos, o.ramo) else ramos end, o.uf, o.descricao, o.lq, ok
  from (
    select o.*, a.ufs, a.ramos, len(a.ufs) < 8 and not list_contains(a.ufs, o.uf)
      and not list_contains(a.ramos, o.ramo) ok
    from anda a join ord o on o.rn = a.rn + 1) o)"""

COLUMNS = "chave, ordem, rotulo, detalhe, valor, valor_b, n, destaque"


def row(key: str, source: str, *, order: str, label: str, value: str, other: str = "null",
        count: str = "null", detail: str = "null", highlight: str = "false", keep: int = 8) -> str:
    return f"""
select * from (
  select '{key}' chave, cast(row_number() over (order by {order}) as integer) ordem,
    cast({label} as varchar) rotulo, cast({detail} as varchar) detalhe,
    round(cast({value} as double), 6) valor, round(cast({other} as double), 6) valor_b,
    cast({count} as bigint) n, {highlight} destaque
  from ({source}) t) where ordem <= {keep}"""


def first(order: str) -> str:
    return f"row_number() over (order by {order}) = 1"


def by_state(codes, source: str = "casa") -> str:
    return (
        f"select uf, sum(contagem)::bigint n from {source} "
        f"where cnae_principal in ({listed(codes)}) group by uf"
    )


def rated(counts: str, floor: int) -> str:
    return (
        f"select c.uf, c.n, c.n * 100000::double / hab taxa from ({counts}) c "
        f"join pop on pop.uf = c.uf where c.n >= {floor}"
    )


SHORT = r"trim(regexp_replace({0}, ',\s*exceto.*$', ''))"
DESCRIBED = "sum(contagem)::bigint n from mes where cnae_descricao is not null"


def statement(e: Entry, shortened: bool) -> str:
    """The rows of one entry; ``shortened`` fills the chart label of descriptions."""
    detail = SHORT.format("cnae_descricao") if shortened else "null"
    if e.family == "placar_nacional":
        return row(e.key, "select uf, sum(contagem)::bigint n from mes group by uf",
                   order="n desc, uf", label="uf", value="n", count="n",
                   other="(select sum(contagem) from mes)")
    if e.family == "ranking_cnae":
        where = f"and uf = '{e.params['uf']}'" if e.params else ""
        return row(e.key, f"select cnae_descricao, {DESCRIBED} {where} group by 1",
                   order="n desc, cnae_descricao", label="cnae_descricao", value="n", count="n",
                   detail=detail)
    if e.family == "recorte_cidade":
        where = f"and uf = '{e.params['uf']}'" if e.params else ""
        return row(e.key, "select municipio || '/' || uf cidade, sum(contagem)::bigint n from mes "
                          f"where municipio is not null {where} group by 1",
                   order="n desc, cidade", label="cidade", value="n", count="n")
    if e.family == "anomalia":
        return row(e.key, "from plaus", order="variacao desc, cnae_descricao",
                   label="cnae_descricao", value="variacao", other="antes", count="agora",
                   highlight=first("variacao desc, cnae_descricao"), detail=detail)
    if e.family == "setor":
        return row(e.key, by_state(e.codes["a"], "mes"), order="n desc, uf", label="uf",
                   value="n", count="n", highlight=first("n desc, uf"))
    if e.family == "duelo":
        a, b = e.params["uf"], e.params["uf_b"]
        side = "select cnae_descricao, {0} and uf = '{1}' group by 1 order by n desc, 1{2}"
        return row(
            e.key,
            f"select a.*, coalesce(b.n, 0) n_b from ({side.format(DESCRIBED, a, ' limit 5')}) a "
            f"left join ({side.format(DESCRIBED, b, '')}) b using (cnae_descricao)",
            order="n desc, cnae_descricao", label="cnae_descricao", value="n", other="n_b",
            count="n", detail=detail,
        )
    if e.family == "percapita":
        counts = (by_state(e.codes["a"]) if e.codes
                  else "select uf, sum(contagem)::bigint n from casa group by uf")
        placed = (
            f"select *, row_number() over (order by taxa desc, uf) p from ({rated(counts, e.floor)})"
        )
        return row(e.key, f"select *, max(case when uf = '{A.LEADER}' then p end) over () lp "
                          f"from ({placed})",
                   order="p", label="uf", value="taxa", other="lp", count="n", highlight="p = 1")
    if e.family == "razao":
        return row(
            e.key,
            f"select d.uf, a.n na, d.n nd, a.n::double / d.n r from ({by_state(e.codes['b'])}) d "
            f"join ({by_state(e.codes['a'])}) a on a.uf = d.uf where d.n >= {e.floor}",
            order="r desc, uf", label="uf", value="r", other="nd", count="na",
            highlight=first("r desc, uf"),
        )
    if e.family == "lqhero":
        counts = by_state(e.codes["a"])
        return row(
            e.key,
            f"select s.uf, s.n, (s.n::double / t.n) / ((select sum(n) from ({counts}))::double "
            f"/ (select sum(contagem) from casa)::double) lq from ({counts}) s "
            "join (select uf, sum(contagem)::double n from casa group by uf) t on t.uf = s.uf "
            f"where s.n >= {e.floor}",
            order="lq desc, uf", label="uf", value="lq", count="n",
            highlight=first("lq desc, uf"), keep=2,
        )
    if e.family == "espuria":
        return row(
            e.key,
            f"select a.uf, a.n a, b.n b from ({by_state(e.codes['a'])}) a "
            f"join ({by_state(e.codes['b'])}) b on b.uf = a.uf",
            order="a desc, uf", label="uf", value="a", other="b", count="a",
            highlight=f"uf in ({listed(A.SETTINGS.labelled_states)})", keep=1000,
        )
    if e.family == "dupla":
        sides = " union all ".join(
            f"select *, '{side}' lado from (select *, row_number() over (order by taxa desc, uf) p "
            f"from ({rated(by_state(e.codes[side]), 0)})) where uf = '{A.FOCUS}'"
            for side in ("a", "b")
        )
        return f"""
select '{e.key}' chave, case lado when 'a' then 1 else 2 end ordem, uf rotulo, lado detalhe,
  round(taxa, 6) valor, p::double valor_b, n, false destaque from ({sides})"""
    return row(e.key, "from anda where pego", order="rn", label="uf", detail="descricao", value="lq")


ENTRIES = catalogue(A.SETTINGS)
CUTS = CELLS + "," + GROWTH + "," + PICKED


def family(name: str, keys=lambda key: True) -> str:
    parts = [statement(e, False) for e in ENTRIES if e.family == name and keys(e.key)]
    return "\nunion all\n".join(parts)


sql("national_board", CUTS,
    f"select *, round(100::double * valor / valor_b, 6) pct from ({family('placar_nacional')})")
sql("sector_spotlight", CELLS + "," + SLUGS, """
select * from (
  select *, cast(sum(n) over (partition by slug) as bigint) total_nacional,
    cast(sum(case when posicao <= 8 then n end) over (partition by slug) as bigint) total_mostrado
  from (
    select slug, uf, cast(sum(contagem) as bigint) n,
      cast(row_number() over (partition by slug order by sum(contagem) desc, uf) as integer) posicao,
      row_number() over (partition by slug order by sum(contagem) desc, uf) = 1 destaque
    from mes join slugs on codigo = cnae_principal group by slug, uf))
where posicao <= 8""")
sql("duel", CUTS, family("duelo"))
sql("per_capita_total", CUTS, family("percapita", lambda key: key == "percapita|total"))
sql("per_capita", CUTS, family("percapita", lambda key: key != "percapita|total"))
sql("sector_ratio", CUTS, family("razao"))
sql("focus_position", CUTS, family("dupla"))
sql("signature_sector", CUTS, family("assinatura"))
sql("lq_hero", CUTS, family("lqhero"))
sql("sector_scatter", CUTS, family("espuria"))
sql("trend_line", CUTS, f"""
select chave, pontos, {', '.join(f'round({c}, 6) {c}' for c in
  ('inclinacao', 'intercepto', 'x_min', 'inclinacao * x_min + intercepto as y_min', 'x_max',
   'inclinacao * x_max + intercepto as y_max') if ' as ' not in c)},
  round(inclinacao * x_min + intercepto, 6) y_min, round(inclinacao * x_max + intercepto, 6) y_max
from (
  select chave, count(*) pontos, min(valor) x_min, max(valor) x_max,
    case when count(*) >= 2 and not isnan(regr_slope(valor_b, valor))
      then regr_slope(valor_b, valor) end inclinacao,
    case when count(*) >= 2 and not isnan(regr_slope(valor_b, valor))
      then regr_intercept(valor_b, valor) end intercepto
  from ({family('espuria')}) group by chave)""")

_position: dict[str, int] = {}
_values = []
for _e in ENTRIES:
    _position[_e.queue] = _position.get(_e.queue, 0) + 1
    _values.append(f"('{_e.queue}', {_position[_e.queue]}, '{_e.key}', '{_e.family}')")
ALL = CUTS + f""",
itens as (select * from (values {', '.join(_values)}) v(fila, posicao, chave, familia)),
bruto as ({' union all '.join(statement(e, True) for e in ENTRIES)}),
basta as (
  select chave from bruto join itens using (chave) group by chave, familia
  having count(*) >= case familia when 'recorte_cidade' then 3 when 'lqhero' then 2
    when 'espuria' then 5 when 'dupla' then 2 else 1 end),
tudo as (
  select fila, posicao, chave, familia, ordem, rotulo, detalhe, valor, valor_b, n, destaque,
    round(a, 6) inclinacao, round(b, 6) intercepto, round(x0, 6) x_min, round(a * x0 + b, 6) y_min,
    round(x1, 6) x_max, round(a * x1 + b, 6) y_max,
    case when ordem is null then 'no_data' else 'ok' end status
  from itens left join (select * from bruto semi join basta using (chave)) using (chave)
  left join (
    select chave, regr_slope(valor_b, valor) a, regr_intercept(valor_b, valor) b,
      min(valor) x0, max(valor) x1
    from bruto semi join basta using (chave) where chave in ({listed([e.key for e in ENTRIES if e.family == 'espuria'])})
    group by chave) using (chave))"""
sql("all_cuts", ALL, "select * from tudo")
_EARLIER = {str(A.MONTH): str(A.PREVIOUS), str(A.PREVIOUS): str(previous_month(A.PREVIOUS))}
sql("all_cuts_of_a_month", re.sub("|".join(_EARLIER), lambda m: _EARLIER[m[0]], ALL), "select * from tudo")

# --- captions -------------------------------------------------------------------


def dotted(value: str) -> str:
    return f"replace(format('{{:,}}', cast(round_even({value}, 0) as bigint)), ',', '.')"


def whole(value: str) -> str:
    return f"cast(cast(round_even({value}, 0) as bigint) as varchar)"


def comma(value: str, places: int = 1) -> str:
    return f"replace(printf('%.{places}f', {value}), '.', ',')"


def cut_at_word(value: str, limit: int) -> str:
    head = f"left({value}, {limit})"
    before = f"regexp_extract({head}, '(?s)^(.*) [^ ]*$', 1)"
    return (
        f"case when length({value}) <= {limit} then {value} else regexp_replace("
        f"case when {before} = '' then {head} else {before} end, '[,;]+$', '') || '…' end"
    )


def lead(column: str, i: int = 1) -> str:
    return f"max(case when ordem = {i} then {column} end)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def caption(e: Entry) -> str:
    """One entry's caption as a grouped select over its rows."""
    uf = e.params.get("uf", "")
    label = e.params.get("label", "")
    month = f"{['', 'janeiro', 'fevereiro', 'março', 'abril', 'maio', 'junho'][A.MONTH.month]}" \
            f"/{A.MONTH.year}"
    v1 = comma(lead("valor"))
    lq_item = "rotulo || ': ' || " + whole("valor") + " || '×'"
    board_item = "rotulo || ': ' || " + dotted("n")
    sentence = e.params.get("sentence", "").replace("{r}", "{v1}")
    fields = {
        "mes": quoted(month), "lider": lead("rotulo"), "segundo": lead("rotulo", 2),
        "terceiro": lead("rotulo", 3), "n": dotted(lead("n")), "n2": dotted(lead("n", 2)),
        "n3": dotted(lead("n", 3)), "soma": dotted("sum(n)"), "total": dotted(lead("valor_b")),
        "antes": dotted(lead("valor_b")),
        "pct": whole(f"100::double * {lead('n')} / {lead('valor_b')}"),
        "v0": whole(lead("valor")), "v1": v1, "w1": comma(lead("valor", 2)),
        "pos_b": whole(lead("valor_b")), "pos_b2": whole(lead("valor_b", 2)),
        "curto60": cut_at_word(lead("rotulo"), 60), "curto55": cut_at_word(lead("rotulo"), 55),
        "trade40": f"lower({cut_at_word(lead('detalhe'), 40)})",
        "lista": f"string_agg({board_item}, '; ' order by ordem)",
        "lista_lq": f"string_agg({lq_item}, '; ' order by ordem)",
        "label": quoted(label), "label_b": quoted(e.params.get("label_b", "")),
        "Label": quoted(label[:1].upper() + label[1:].lower()),
        "uf": quoted(uf), "uf_b": quoted(e.params.get("uf_b", "")), "maior": quoted(A.LEADER),
        "onde": quoted(f"em {uf}" if uf else "no Brasil"), "onde_curto": quoted(uf or "no Brasil"),
        "so_uf": quoted(f" (só {uf})" if uf else ""), "titulo": quoted(e.params.get("title", "")),
        "pergunta": quoted(e.params.get("question", "")),
    }

    def written(template: str) -> str:
        for name, expression in fields.items():
            template = template.replace("{" + name + "}", f"\x00{name}\x00")
        parts = template.split("\x00")
        return " || ".join(
            fields[part] if i % 2 else quoted(part) for i, part in enumerate(parts) if part
        )

    def chosen(templates: dict[str, str]) -> str:
        if e.family == "percapita":
            return (
                f"case when {lead('rotulo')} = '{A.LEADER}' then {written(templates['percapita:lider'])} "
                f"when {lead('valor_b')} is not null then {written(templates['percapita:atras'])} "
                f"else {written(templates['percapita:fora'])} end"
            )
        return written(templates[e.family].replace("{frase}", sentence))

    credit = C.CREDIT.format(data=A.EXTRACTION.strftime("%d/%m/%Y"))
    if e.family in C.WITH_POPULATION:
        credit += f" · {POPULATION_SOURCE}"
    return (
        f"select chave, {chosen(C.TEXTS)} texto, {chosen(C.ALTS)} alt, {quoted(credit)} credito "
        f"from tudo where chave = '{e.key}' and status = 'ok' group by chave"
    )


sql("caption_length", ALL, f"""
select *, cast(length(texto) as integer) n_texto, cast(length(alt) as integer) n_alt,
  length(texto) <= 280 and length(alt) <= 1000 ok
from ({' union all '.join(caption(e) for e in ENTRIES)})""")

# --- queues ---------------------------------------------------------------------

# Shown and not shown are two lists; an empty second list means a new round.
NEXT = """
with fila as (
  select n_name extracao, c_mktsegment fila, c_custkey posicao, c_name chave,
    c_nationkey % 4 estado, c_custkey % 3 k, c_custkey % 50 tarde
  from customer join nation on c_nationkey = n_nationkey),
usos as (
  select *, 1 ciclo from fila
  where estado = 1 and k <> 0 or estado = 3 or estado = 2 and not (fila = 'BUILDING' and tarde = 0)
  union all select *, 2 from fila where estado = 3 and k = 1),
rodada as (select extracao, fila, max(ciclo) ciclo from usos group by all),
vistos as (
  select f.extracao, f.fila, f.posicao, f.chave, coalesce(r.ciclo, 1) ciclo,
    exists (select 1 from usos u where u.extracao = f.extracao and u.fila = f.fila
      and u.chave = f.chave and u.ciclo = coalesce(r.ciclo, 1)) visto
  from fila f left join rodada r on r.extracao = f.extracao and r.fila = f.fila)
select extracao, fila, cast(max(ciclo) + cast(bool_and(visto) as integer) as integer) ciclo,
  coalesce(min(posicao) filter (not visto), min(posicao)) posicao,
  coalesce(arg_min(chave, posicao) filter (not visto), arg_min(chave, posicao)) chave
from vistos group by extracao, fila"""
sql("next_unused", "", NEXT)
sql("recorded_uses", "", f"select extracao, fila, ciclo, chave from ({NEXT})")

# --- scalar functions -----------------------------------------------------------

sql("safe_date", TABLES, """
select cnpj_basico, cnpj_ordem, cnpj_dv, abertura data_abertura, situacao data_situacao from ender""")
sql("safe_decimal", "", """
select o_orderkey, try_cast(case when o_orderstatus = 'P' then o_orderpriority
  else cast(o_totalprice as varchar) end as decimal(15, 2)) valor from orders""")
sql("address_concat", TABLES, "select cnpj_basico, cnpj_ordem, cnpj_dv, endereco from ender")
sql("size_class", TABLES, """
select cnpj_basico, case when cnpj_basico in (from mei) then 'MEI' else
  case porte when '01' then 'ME' when '03' then 'EPP' when '05' then 'demais' end end porte
from emp""")
sql("reference_month", "", f"""
select o_orderkey, cast(date_trunc('week', o_orderdate) as date) semana,
  cast(date_trunc('month', date_trunc('month', o_orderdate) - interval 1 day) as date) mes_ref,
  cast(date_trunc('week', o_orderdate) as date) + 6 > date '{OLD}' parcial
from orders""")
sql("month_label", "", """
select o_orderkey, ['janeiro', 'fevereiro', 'março', 'abril', 'maio', 'junho', 'julho', 'agosto',
  'setembro', 'outubro', 'novembro', 'dezembro'][month(o_orderdate)] || '/' || year(o_orderdate)
  rotulo from orders""")
sql("format_thousands", "", f"""
select o_orderkey, {dotted('o_orderkey')} chave, {dotted('o_totalprice')} valor from orders""")
sql("format_decimal", "", f"""
select o_orderkey, {comma('o_totalprice')} valor, {comma('o_totalprice', 2)} valor2 from orders""")
sql("format_company_id", TABLES, """
select cnpj_basico, cnpj_ordem, cnpj_dv, c[1:2] || '.' || c[3:5] || '.' || c[6:8] || '/' ||
  c[9:12] || '-' || c[13:] cnpj_formatado
from (select *, cnpj_basico || cnpj_ordem || cnpj_dv c from est)""")
sql("shorten_label", "", f"""
select doc_id, {cut_at_word('text', 34)} curto, {cut_at_word('text', 60)} curto60,
  lower(left(string_split(text, ',')[1], 22)) chave,
  upper(left(lang, 1)) || lower(substr(lang, 2)) idioma
from documents""")

PARTS = r"""
descr as (
  select p_partkey, p_brand, ' Transporte de carga ' || p_size || case p_type
    when 'ECONOMY' then ', exceto ' || p_name || ', municipal'
    when 'LARGE' then ', Exceto ' || p_name || ', municipal.'
    when 'PROMO' then ' não especificados' || chr(160) || 'anteriormente' || chr(160)
    when 'SMALL' then ', nao especificada anteriormente.' || chr(10)
    else ', municipal' end descricao from part),
vazio as (select ' ' || chr(160) || chr(10) v),
inteira as (select descr.*, rtrim(trim(descricao, v), '. ') completa from descr, vazio),
media as (
  select inteira.*, rtrim(trim(regexp_replace(completa,
    '[\s\x{A0}]*,?[\s\x{A0}]*n[ãa]o especificad[oa]s?[\s\x{A0}]+anteriormente', '', 'gi'), v), ',. ') media
  from inteira, vazio),
formas as (
  select media.*, rtrim(trim(regexp_replace(media, ',[\s\x{A0}]*exceto[\s\x{A0}]+[^,]+', '', 'gi'), v), ',. ') curta
  from media, vazio)"""
sql("label_variants", PARTS, "select p_partkey, curta, media, completa from formas")
sql("distinct_labels", PARTS, """
, um as (select distinct p_brand, descricao, curta, media, completa from formas),
dois as (select *, count(*) over (partition by p_brand, curta) > 1 sobe from um),
tres as (select *, case when sobe then media else curta end l2 from dois),
quatro as (select *, count(*) over (partition by p_brand, l2) > 1 sobe2 from tres)
select p_brand, descricao, case when not sobe2 then l2 when sobe then completa else media end label
from quatro""")

# --- data quality ---------------------------------------------------------------

sql("check_complete_load", "", """
with arq as (
  select l_orderkey k, cast(sum(l_quantity) as bigint) m,
    cast(sum(case when l_returnflag <> 'R' then l_quantity end) as bigint) d
  from lineitem group by 1)
select 'complete_load' rule, 'Pedido' || coalesce(o_orderkey, k) || '.zip' subject,
  case when k is null then 'not in the manifest' when d is null then 'not on disk'
    else cast(d as varchar) end observed,
  cast(m as varchar) expected, 'hard' severity, coalesce(d = m, false) ok
from orders full join arq on k = o_orderkey""")
sql("check_columns", "", """
select count(*) linhas, count(case when o_orderstatus in ('F', 'P') then 1 end) tortas
from orders""")
sql("forbidden_files", "", """
select 'forbidden_file' rule, 'Socios' || c_custkey || '.zip' subject, 'on disk' observed,
  'absent' expected, 'hard' severity, false ok
from customer where c_custkey in (select s_suppkey from supplier where s_acctbal < 0)""")

low, high = A.BOUNDS
NOVAS = TABLES + "," + companies("novas", OLD)
PRIVACY = """
select 'allowed_columns' rule, 'new_companies' subject, '' observed, '' expected,
  'hard' severity, true ok
union all
select 'private_address', 'new_companies',
  cast(count(case when eh_mei and endereco is not null then 1 end) as varchar), '0', 'hard',
  count(case when eh_mei and endereco is not null then 1 end) = 0 from novas"""
MAGNITUDE = f"""
select 'magnitude' rule, 'new_companies' subject,
  cast(cast(round(count(*)::double / 3) as bigint) as varchar) observed, '{low}-{high}' expected,
  'hard' severity, count(*)::double / 3 between {low} and {high} ok from novas"""
KINDS = f"""
tipos as (
  select count(case when identificador_matriz_filial = '1' and situacao >= date '{OLD}' - {WINDOW}
      and abertura < date '{OLD}' - {WINDOW} then 1 end) reativadas,
    count(case when identificador_matriz_filial = '1' and recente then 1 end) matrizes,
    count(case when identificador_matriz_filial = '2' and recente then 1 end) filiais
  from (select *, abertura between date '{OLD}' - {WINDOW} and date '{OLD}' recente from ender
        where situacao_cadastral = '02'))"""
sql("check_privacy", NOVAS, PRIVACY)
sql("check_magnitude", NOVAS, MAGNITUDE)
sql("check_reactivation", TABLES + "," + KINDS, "select reativadas from tipos")
sql("hq_vs_branch", TABLES + "," + KINDS, """
select matrizes, filiais, round(matrizes / 3::double, 6) matrizes_mes,
  round(filiais / 3::double, 6) filiais_mes,
  round(case when matrizes + filiais > 0
    then 100::double * filiais / (matrizes + filiais) end, 6) pct_filiais
from tipos""")
SHARE = """
select distinct uf, count(*) over (partition by uf) n,
  100::double * count(*) over (partition by uf) / count(*) over () pct
from novas"""
LEADERS = f"select * from ({SHARE}) order by n desc, uf limit 8"
sql("state_share", NOVAS, f"select * replace (round(pct, 6) as pct) from ({LEADERS})")
RECENT = f"""
select semana, len(abertas) n, date_diff('day', semana, date '{OLD}') < 6 parcial from (
  select semana, list(data_abertura) abertas from (
    select data_abertura, data_abertura - cast(isodow(data_abertura) - 1 as integer) semana from novas)
  group by semana)
order by semana desc limit 6"""
sql("recent_weeks", NOVAS, RECENT)
SPOT = """
select cnpj, razao_social, data_abertura, uf, municipio, cnae_descricao,
  c[1:2] || '.' || c[3:5] || '.' || c[6:8] || '/' || c[9:12] || '-' || c[13:] cnpj_formatado
from (select *, cnpj c from novas) where not eh_mei
order by md5(cnpj || '|0.42'), data_abertura, cnae_descricao nulls last, municipio nulls last,
  razao_social limit 5"""
sql("spot_sample", NOVAS, SPOT)
_low, _high = A.SHARE_BOUNDS
sql("check_report", NOVAS + "," + KINDS, f"""
{PRIVACY}
union all {MAGNITUDE}
union all select 'reactivation', 'estabelecimentos', cast(reativadas as varchar), 'left out',
  'soft', true from tipos
union all select 'head_offices', 'estabelecimentos', cast(matrizes as varchar), null, 'soft', true
  from tipos
union all select 'branches', 'estabelecimentos', cast(filiais as varchar),
  {comma('100::double * filiais / (matrizes + filiais)')} || '%', 'soft', true from tipos
union all select 'leading_share', '{A.LEADER}', {comma('p')}, '{_low:g}-{_high:g}', 'soft',
  p between {_low} and {_high}
  from (select coalesce(max(pct) filter (uf = '{A.LEADER}'), 0::double) p from ({SHARE}))
union all select 'recent_week', cast(semana as varchar), cast(n as varchar),
  case when parcial then 'partial' else 'whole' end, 'soft', true from ({RECENT})
union all select 'spot_sample', cnpj_formatado,
  concat_ws(' ', cast(data_abertura as varchar), municipio || '/' || uf), razao_social, 'soft',
  true from ({SPOT})
union all select 'duplicate_code', t || '/' || codigo, cast(count(*) as varchar), '1', 'hard', false
  from (select 'cnaes' t, codigo from cna union all select 'municipios', codigo from mun
        union all select 'naturezas', codigo from nat)
  group by t, codigo having count(*) > 1""")
sql("duplicate_codes", "", """
select 'duplicate_code' rule, 'part/' || p_name subject, cast(count(*) as varchar) observed,
  '1' expected, 'hard' severity, false ok
from part group by p_name having count(*) > 1""")
