"""Registered company lists: the flagship list, filter families, health and MEI lists, counts,
top-K, preview, and the plans without optional tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ._registry import register
from ..functions.identity import cnpj_key
from ..operators.aggregates import export_summary, rows_and_distinct
from ..operators.ordering import top_k
from ..plans.leads import LeadFilter, health_leads, leads
from ..plans.mei import mei_active_leads, mei_inactive_by_status, mei_inactive_total
from .common import (ADDRESS, ALL_JOINED, BY_NAME, CITY, COMPANY, HEAD_OFFICE, IDENTITY, IN_MG, KEY, LEAD_OUTPUT, LEAD_SPEC,
                     NOTHING, PORTE_35, REGIME, SITES, STATUS_LABEL, _cat, _total_order_sql, blanked, code, lead_sql, phones,
                     select, site, yes)


# ---------------------------------------------------------------------------------------------
# flagship: filtered company list
# ---------------------------------------------------------------------------------------------
FLAGSHIP_FILTER = dict(uf="MG", municipio="Uberlandia", situacao=[8], porte=[3, 5])


def among(column: str, *codes: int) -> str:
    """Is the lenient code one of these?"""
    return f"list_contains({list(codes)}, {code(column)})"


def named(column: str, text: str) -> str:
    """Equal but for case."""
    return f"{column} ILIKE '{text}'"


CITY_5403 = f"{code('mun.codigo')} = 5403"
DIVISION_86 = f"{code('substr(est.cnae_fiscal_principal, 1, 2)')} = 86"
ACTIVE = f"{code('est.situacao_cadastral')} = 2"


def every(*conditions: str) -> str:
    return " AND ".join(f"({c})" for c in conditions)


@register("leads_filtered", lead_sql(every(among("est.situacao_cadastral", 8), IN_MG, named("mun.descricao", "Uberlandia"), PORTE_35), BY_NAME))
def q_leads_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads(_cat(spark, sf_dir), LeadFilter(**FLAGSHIP_FILTER))


def _leads_key(name: str, *conditions: str, **filt):
    """Register a lead-list variant: same plan, one filter family switched on."""
    @register(name, lead_sql(every(*conditions), BY_NAME))
    def q(spark, sf_dir):
        return leads(_cat(spark, sf_dir), LeadFilter(**filt))
    q.__name__ = f"q_{name}"
    return q


# F-2 … F-16: one key per filter family (size 3/5 is always on, as in the list it comes from)
_leads_key("filter_state", IN_MG, PORTE_35, uf=" mg ")
_leads_key("filter_city_code", CITY_5403, PORTE_35, municipio="5403")
_leads_key("filter_city_name", named("mun.descricao", "uberlandia"), PORTE_35, municipio="uberlandia")
_leads_key("filter_cnae_division", DIVISION_86, PORTE_35, cnae=86)
_leads_key("filter_size", among("emp.porte_empresa", 0, 1), porte=[1, 0, 1])
_leads_key("filter_status", among("est.situacao_cadastral", 3, 4), PORTE_35, situacao=[4, 3])
_leads_key("filter_active", ACTIVE, PORTE_35, ativos=True)
_leads_key("filter_mei", yes("sim.opcao_mei"), PORTE_35, opcao_sim=True)
_leads_key("filter_opened_between", "starts_with(est.data_inicio_atividade, '1995')", PORTE_35, aberto_de="1995-01-01", aberto_ate="1995-12-31")
_leads_key("filter_nature", "emp.natureza_juridica = '2135'", PORTE_35, natureza="2135")
_leads_key("filter_secondary_cnae", "list_contains(string_split(est.cnae_fiscal_secundaria, ','), '8640202')", PORTE_35,
           cnae_secundario="8640202")
_leads_key("leads_all_filters", ACTIVE, yes("sim.opcao_mei"), IN_MG, CITY_5403, DIVISION_86, among("emp.porte_empresa", 0, 1, 3, 5),
           uf="MG", municipio="5403", cnae=86, porte=[0, 1, 3, 5], ativos=True, opcao_sim=True)


# ---------------------------------------------------------------------------------------------
# health list, MEI lists and counts
# ---------------------------------------------------------------------------------------------

HEALTH_SPEC = {
    **IDENTITY, "porte": "emp.porte_empresa", **site("data_inicio_atividade", "situacao_cadastral", "uf"),
    "municipio": "mun.descricao", **site(*ADDRESS), **phones("telefone1", "telefone2"), "email": "est.correio_eletronico",
    "cnae_principal": "est.cnae_fiscal_principal", "cnae_principal_nome": "cnae.descricao",
    "tipo_saude": "CASE WHEN regexp_matches(upper(ifnull(cnae.descricao, '')), 'CL[ÍI]NIC') THEN 'CLINICA' ELSE 'OUTROS_SAUDE' END",
}
# the site's own city code decides: a joined city has the same one
HEALTH_WHERE = [IN_MG, f"{code('est.municipio')} = 5403", "starts_with(est.cnae_fiscal_principal, '86')", PORTE_35]


def health_sql(branches: bool = False) -> str:
    where = [*HEALTH_WHERE, f"NOT {yes('sim.opcao_mei')}", *([] if branches else [HEAD_OFFICE])]
    return select(HEALTH_SPEC, ALL_JOINED, where, BY_NAME)


@register("health_leads", health_sql())
def q_health_leads(spark, sf_dir):
    return health_leads(_cat(spark, sf_dir))


MEI_SPEC = {
    **IDENTITY, **blanked(site(*ADDRESS)), "uf": "est.uf", "municipio_codigo": "est.municipio", "municipio_nome": "mun.descricao",
    **phones("telefone1", "telefone2", "fax"), **blanked({"email": "est.correio_eletronico"}), **site("situacao_cadastral"),
}
MEI_ACTIVE_SQL = select(MEI_SPEC, SITES + COMPANY + REGIME + CITY, [
    yes("sim.opcao_mei"), IN_MG, f"(upper(est.situacao_cadastral) = 'ATIVA' OR {code('est.situacao_cadastral')} = 2)"])
MEI_OUTPUT = list(MEI_SPEC)


@register("mei_active_leads", MEI_ACTIVE_SQL)
def q_mei_active_leads(spark, sf_dir):
    return mei_active_leads(_cat(spark, sf_dir))


def mei_inactive_sql(spec: dict[str, str], tail: str = "", branches: bool = False) -> str:
    where = [IN_MG, yes("sim.opcao_mei"), f"{code('est.situacao_cadastral')} IN (3, 4, 8)", *([] if branches else [HEAD_OFFICE])]
    return select(spec, SITES + REGIME, where, tail)


BY_STATUS = {"codigo": code("est.situacao_cadastral"), "descricao": STATUS_LABEL, "registros": "count(*)",
             "cnpjs_distintos": f"count(DISTINCT {KEY})"}


@register("mei_inactive_total", mei_inactive_sql({"total_meis_inativos": f"count(DISTINCT {KEY})"}))
def q_mei_inactive_total(spark, sf_dir):
    return mei_inactive_total(_cat(spark, sf_dir))


@register("mei_inactive_by_status", mei_inactive_sql(BY_STATUS, "GROUP BY 1, 2 ORDER BY registros DESC"))
def q_mei_inactive_by_status(spark, sf_dir):
    return mei_inactive_by_status(_cat(spark, sf_dir))


# ---------------------------------------------------------------------------------------------
# optional tables absent: joins elided, NULL/'' columns, code filter on the site's own code
# ---------------------------------------------------------------------------------------------
@register("leads_no_lookups", select(
    {**LEAD_SPEC, "cnae_principal_nome": NOTHING, "municipio_nome": NOTHING, "opcao_simples": "''", "opcao_mei": "''"},
    SITES + COMPANY, [IN_MG, f"{code('est.municipio')} = 5403", PORTE_35], BY_NAME))
def q_leads_no_lookups(spark, sf_dir):
    cat = _cat(spark, sf_dir, "simples", "municipios", "cnaes")
    return leads(cat, LeadFilter(uf="MG", municipio="5403"))


@register("health_leads_no_lookups", select(
    {**HEALTH_SPEC, "municipio": "est.municipio", "cnae_principal_nome": NOTHING, "tipo_saude": "'SAUDE'"},
    SITES + COMPANY, [*HEALTH_WHERE, HEAD_OFFICE], BY_NAME))
def q_health_leads_no_lookups(spark, sf_dir):
    return health_leads(_cat(spark, sf_dir, "simples", "municipios", "cnaes"))


# ---------------------------------------------------------------------------------------------
# counts, top-K, preview
# ---------------------------------------------------------------------------------------------
@register("establishment_count", """
SELECT COUNT(*) AS registros, COUNT(DISTINCT (cnpj_basico || cnpj_ordem || cnpj_dv)) AS cnpjs_distintos
FROM estabelecimentos""")
def q_establishment_count(spark, sf_dir):
    return rows_and_distinct(_cat(spark, sf_dir).est, cnpj_key())


@register("export_summary", f"""
SELECT count(*) AS total, least(count(*), 100) AS exportadas FROM {ALL_JOINED} WHERE {IN_MG} AND {PORTE_35}""")
def q_export_summary(spark, sf_dir):
    return export_summary(leads(_cat(spark, sf_dir), LeadFilter(uf="MG"), sort=False), 100)


@register("leads_top_k", f"""
SELECT * FROM ({lead_sql(f"UPPER(est.uf) = 'MG' AND {PORTE_35}")})
ORDER BY {_total_order_sql('razao_social', LEAD_OUTPUT)} LIMIT 100""")
def q_leads_top_k(spark, sf_dir):
    return leads(_cat(spark, sf_dir), LeadFilter(uf="MG", limit=100))


@register("preview", f"""
SELECT * FROM ({MEI_ACTIVE_SQL}) ORDER BY {_total_order_sql('razao_social', MEI_OUTPUT)} LIMIT 10""")
def q_preview(spark, sf_dir):
    return top_k(mei_active_leads(_cat(spark, sf_dir)), 10, ["razao_social"])


@register("health_leads_with_branches", health_sql(branches=True))
def q_health_leads_with_branches(spark, sf_dir):
    return health_leads(_cat(spark, sf_dir), include_branches=True)


@register("mei_inactive_with_branches", mei_inactive_sql(BY_STATUS, "GROUP BY 1, 2 ORDER BY registros DESC", branches=True))
def q_mei_inactive_with_branches(spark, sf_dir):
    return mei_inactive_by_status(_cat(spark, sf_dir), include_branches=True, uf="mg")
