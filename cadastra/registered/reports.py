"""Registered per-CNPJ report parts, scalar functions over whole tables, and single joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ._registry import register
from ..functions import codes as C
from ..functions.identity import DV1_WEIGHTS, DV2_WEIGHTS, cnpj_key
from ..functions.text import clean_name, clean_name_sql, slug, slug_sql
from ..operators.joins import DEFAULT_SKEW, SkewPolicy, fact_join, lookup_join
from ..operators.ordering import order_nulls_last
from ..plans import report as R
from ..plans.leads import LeadFilter, leads
from ..session import scratch_path
from ..sources.catalog import Catalog
from ..sources.layout import SPLIT_ALREADY, over_parts, write_layout
from .common import BY_NAME, IN_MG, PORTE_35, _cat, _registry_cols, lead_sql


# ---------------------------------------------------------------------------------------------
# per-CNPJ report, re-aimed at a DataFrame of requests (every site's CNPJ + partners' documents)
# ---------------------------------------------------------------------------------------------


def _dv_sql(d: str, weights) -> str:
    total = " + ".join(f"TRY_CAST(substr({d}, {i}, 1) AS INTEGER) * {w}" for i, w in enumerate(weights, 1))
    return f"(CASE WHEN ({total}) % 11 < 2 THEN 0 ELSE 11 - ({total}) % 11 END)"


VALID_SQL = (f"(CASE WHEN length(d) = 14 AND d <> repeat(substr(d, 1, 1), 14) THEN substr(d, 13, 2) = "
             f"CAST({_dv_sql('d', DV1_WEIGHTS)} AS VARCHAR) || CAST({_dv_sql('d', DV2_WEIGHTS)} AS VARCHAR)"
             f" ELSE false END)")

REQUEST_CTES = f""",
requests AS (
  SELECT substr(k, 1, 2) || '.' || substr(k, 3, 3) || '.' || substr(k, 6, 3) || '/' || substr(k, 9, 4)
         || '-' || substr(k, 13, 2) AS cnpj_input
  FROM (SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS k FROM estabelecimentos)
  UNION ALL SELECT cnpj_cpf_socio AS cnpj_input FROM socios
),
norm AS (
  SELECT cnpj_input, regexp_replace(COALESCE(cnpj_input, ''), '[^0-9]', '', 'g') AS d FROM requests
),
keys AS (
  SELECT DISTINCT substr(d, 1, 8) AS cnpj_basico, substr(d, 9, 4) AS cnpj_ordem, substr(d, 13, 2) AS cnpj_dv,
         {VALID_SQL} AS dv_valido
  FROM norm WHERE length(d) = 14
),
matched AS (
  SELECT e.* FROM estabelecimentos e
  WHERE EXISTS (SELECT 1 FROM keys k WHERE k.cnpj_basico = e.cnpj_basico AND k.cnpj_ordem = e.cnpj_ordem
                AND k.cnpj_dv = e.cnpj_dv)
),
found AS (SELECT * FROM matched WHERE cnpj_basico IN (SELECT cnpj_basico FROM empresas)),
comp AS (
  SELECT DISTINCT cnpj_basico, razao_social, natureza_juridica, porte_empresa, capital_social_empresa
  FROM empresas WHERE cnpj_basico IN (SELECT cnpj_basico FROM matched)
),
sim1 AS (
  SELECT * FROM (
    SELECT s.*, row_number() OVER (PARTITION BY cnpj_basico ORDER BY opcao_simples NULLS LAST,
      data_opcao_simples NULLS LAST, data_exclusao_simples NULLS LAST, opcao_mei NULLS LAST,
      data_opcao_mei NULLS LAST, data_exclusao_mei NULLS LAST) AS rn
    FROM simples s WHERE cnpj_basico IN (SELECT cnpj_basico FROM found)) WHERE rn = 1
)
"""


def _req(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return cat, R.site_requests(cat)


@register("cnpj_validate", REQUEST_CTES + f"""
SELECT cnpj_input, d AS cnpj_digitos, length(d) = 14 AS tamanho_ok, {VALID_SQL} AS dv_valido FROM norm""")
def q_cnpj_validate(spark, sf_dir):
    cat, req = _req(spark, sf_dir)
    return R.normalize_requests(req).select("cnpj_input", "cnpj_digitos", "tamanho_ok", "dv_valido")


@register("cnpj_split", REQUEST_CTES + """
SELECT cnpj_input, substr(d, 1, 8) AS cnpj_basico, substr(d, 9, 4) AS cnpj_ordem, substr(d, 13, 2) AS cnpj_dv
FROM norm""")
def q_cnpj_split(spark, sf_dir):
    cat, req = _req(spark, sf_dir)
    return R.normalize_requests(req).select("cnpj_input", "cnpj_basico", "cnpj_ordem", "cnpj_dv")


@register("cnpj_lookup", REQUEST_CTES + """
SELECT cnpj_basico, cnpj_ordem, cnpj_dv, nome_fantasia, situacao_cadastral FROM matched""")
def q_cnpj_lookup(spark, sf_dir):
    cat, req = _req(spark, sf_dir)
    return R.matched_sites(cat, R.requested_keys(req)).select(
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "nome_fantasia", "situacao_cadastral")


@register("companies_of_cnpjs", REQUEST_CTES + "SELECT * FROM comp")
def q_companies_of_cnpjs(spark, sf_dir):
    cat, req = _req(spark, sf_dir)
    return R.companies_of(cat, R.requested_keys(req))


@register("simples_status", REQUEST_CTES + """
SELECT cnpj_basico, COALESCE(opcao_simples, 'N') AS opcao_simples, data_opcao_simples, data_exclusao_simples,
       COALESCE(opcao_mei, 'N') AS opcao_mei, data_opcao_mei, data_exclusao_mei FROM sim1""")
def q_simples_status(spark, sf_dir):
    cat, req = _req(spark, sf_dir)
    return R.simples_status(cat, R.requested_keys(req))


@register("cnpj_report", REQUEST_CTES + """
SELECT k.cnpj_basico || '.' || k.cnpj_ordem || '/' || k.cnpj_dv AS cnpj, 'found' AS status, k.dv_valido,
       c.razao_social, c.natureza_juridica, c.porte_empresa, c.capital_social_empresa,
       COALESCE(s.opcao_simples, 'N') AS opcao_simples, COALESCE(s.opcao_mei, 'N') AS opcao_mei,
       s.data_opcao_simples, s.data_exclusao_simples, s.data_opcao_mei, s.data_exclusao_mei
FROM keys k
JOIN (SELECT DISTINCT cnpj_basico, cnpj_ordem, cnpj_dv FROM found) f USING (cnpj_basico, cnpj_ordem, cnpj_dv)
JOIN comp c ON c.cnpj_basico = k.cnpj_basico
LEFT JOIN sim1 s ON s.cnpj_basico = k.cnpj_basico
UNION ALL
SELECT k.cnpj_basico || '.' || k.cnpj_ordem || '/' || k.cnpj_dv, 'not found', k.dv_valido,
       NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM keys k WHERE (k.cnpj_basico, k.cnpj_ordem, k.cnpj_dv) NOT IN (SELECT (cnpj_basico, cnpj_ordem, cnpj_dv) FROM found)
UNION ALL
SELECT cnpj_input, 'malformed', false, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM (SELECT DISTINCT cnpj_input FROM norm WHERE length(d) <> 14)""")
def q_cnpj_report(spark, sf_dir):
    cat, req = _req(spark, sf_dir)
    return R.cnpj_report(cat, req)


# requests for which something is missing: sites whose company has no row (every fifth company of the
# sites is left out of the companies), companies without a site, and keys that are none
@register("cnpj_report_absent", REQUEST_CTES.replace("FROM empresas)", "FROM empresas WHERE right(cnpj_basico, 1) NOT IN ('0', '5'))") + """
SELECT status, count(*) AS requests, count(razao_social) AS with_company FROM (
  SELECT CASE WHEN f.cnpj_basico IS NULL THEN 'not found' ELSE 'found' END AS status, c.razao_social
  FROM (SELECT cnpj_basico, cnpj_ordem, cnpj_dv FROM keys
        UNION SELECT cnpj_basico, '9999', '99' FROM empresas) k
  LEFT JOIN (SELECT DISTINCT cnpj_basico, cnpj_ordem, cnpj_dv FROM found) f USING (cnpj_basico, cnpj_ordem, cnpj_dv)
  LEFT JOIN comp c ON c.cnpj_basico = f.cnpj_basico
  UNION ALL SELECT 'malformed', NULL FROM (SELECT DISTINCT cnpj_input FROM norm WHERE length(d) <> 14))
GROUP BY status""")
def q_cnpj_report_absent(spark, sf_dir):
    cat, req = _req(spark, sf_dir)
    siteless = cat.emp.select(F.concat("cnpj_basico", F.lit("999999")).alias("cnpj_input"))
    fewer = Catalog({**cat.tables, "empresas": cat.emp.where(~F.right("cnpj_basico", F.lit(1)).isin("0", "5"))}, cat.stats)
    return (R.cnpj_report(fewer, req.unionByName(siteless)).groupBy("status")
            .agg(F.count("*").alias("requests"), F.count("razao_social").alias("with_company")))


@register("sites_of_cnpj", REQUEST_CTES + """
SELECT m.cnpj_basico || '.' || m.cnpj_ordem || '/' || m.cnpj_dv AS cnpj,
  CASE WHEN m.identificador_matriz_filial = '1' THEN 'MATRIZ' WHEN m.identificador_matriz_filial = '2' THEN 'FILIAL'
       ELSE m.identificador_matriz_filial END AS tipo,
  m.identificador_matriz_filial, m.nome_fantasia, m.cnae_fiscal_principal, m.cnae_fiscal_secundaria,
  m.data_inicio_atividade, m.situacao_cadastral,
  COALESCE(m.tipo_logradouro, '') || ' ' || COALESCE(m.logradouro, '') || ', ' || COALESCE(m.numero, '') || ' '
    || COALESCE(m.complemento, '') || ' - ' || COALESCE(m.bairro, '') AS endereco,
  COALESCE(m.cep, '') || ' / ' || COALESCE(m.uf, '') || ' / '
    || COALESCE(NULLIF(mun.descricao, ''), NULLIF(m.municipio, ''), '') AS local,
  'tel1=' || COALESCE(m.ddd_1, '') || COALESCE(m.telefone_1, '') || ' tel2=' || COALESCE(m.ddd_2, '')
    || COALESCE(m.telefone_2, '') || ' fax=' || COALESCE(m.ddd_fax, '') || COALESCE(m.fax, '') || ' email='
    || COALESCE(m.correio_eletronico, '') AS contatos
FROM found m
LEFT JOIN municipios mun ON TRY_CAST(m.municipio AS INTEGER) = TRY_CAST(mun.codigo AS INTEGER)
ORDER BY TRY_CAST(m.identificador_matriz_filial AS INTEGER) NULLS LAST, m.data_inicio_atividade NULLS LAST""")
def q_sites_of_cnpj(spark, sf_dir):
    cat, req = _req(spark, sf_dir)
    return R.sites_of(cat, R.requested_keys(req))


@register("partners_of", REQUEST_CTES + """
SELECT cnpj_basico, identificador_socio, nome_socio_ou_razao_social, cnpj_cpf_socio, qualificacao_socio,
  data_entrada_sociedade, pais, faixa_etaria,
  COALESCE(representante_legal, 'None') || ' - ' || COALESCE(nome_representante, 'None') || ' ('
    || COALESCE(qualificacao_representante_legal, 'None') || ')' AS representante
FROM socios WHERE cnpj_basico IN (SELECT cnpj_basico FROM found)
ORDER BY nome_socio_ou_razao_social NULLS LAST""")
def q_partners_of(spark, sf_dir):
    cat, req = _req(spark, sf_dir)
    return R.partners_of(cat, R.requested_keys(req))


#: rows of a page in the registered query: most companies have several
SHOWN_PAGE = 3

# the flat parts, ranked within a company and cut into pages; arrays shown as lines
@register("cnpj_report_nested", REQUEST_CTES + f"""
, site_rows AS (
  SELECT cnpj_basico, cnpj_basico || '.' || cnpj_ordem || '/' || cnpj_dv AS line, row_number() OVER (PARTITION BY cnpj_basico ORDER BY
    TRY_CAST(identificador_matriz_filial AS INTEGER) NULLS LAST, data_inicio_atividade NULLS LAST, cnpj_ordem, cnpj_dv) - 1 AS nth
  FROM found),
partner_rows AS (
  SELECT cnpj_basico, concat_ws('|', nome_socio_ou_razao_social, cnpj_cpf_socio, qualificacao_socio, data_entrada_sociedade) AS line,
    row_number() OVER (PARTITION BY cnpj_basico ORDER BY nome_socio_ou_razao_social NULLS LAST, cnpj_cpf_socio NULLS LAST,
      identificador_socio NULLS LAST, qualificacao_socio NULLS LAST, data_entrada_sociedade NULLS LAST) - 1 AS nth
  FROM socios WHERE cnpj_basico IN (SELECT cnpj_basico FROM found)),
site_pages AS (SELECT cnpj_basico, nth // {SHOWN_PAGE} + 1 AS page, string_agg(line, chr(10) ORDER BY nth) AS sites, count(*) AS n_sites
               FROM site_rows GROUP BY ALL),
partner_pages AS (SELECT cnpj_basico, nth // {SHOWN_PAGE} + 1 AS page, string_agg(line, chr(10) ORDER BY nth) AS partners, count(*) AS n_partners
                  FROM partner_rows GROUP BY ALL)
SELECT c.cnpj_basico, page::INTEGER AS page, c.razao_social, c.natureza_juridica, c.porte_empresa, c.capital_social_empresa,
  COALESCE(s.opcao_simples, 'N') AS opcao_simples, COALESCE(s.opcao_mei, 'N') AS opcao_mei,
  COALESCE(n_sites, 0)::INTEGER AS n_sites, COALESCE(n_partners, 0)::INTEGER AS n_partners,
  COALESCE(sites, '') AS sites, COALESCE(partners, '') AS partners
FROM comp c JOIN (site_pages FULL JOIN partner_pages USING (cnpj_basico, page)) USING (cnpj_basico)
LEFT JOIN sim1 s USING (cnpj_basico)""")
def q_cnpj_report_nested(spark, sf_dir):
    cat, req = _req(spark, sf_dir)
    nested = R.nested_report(cat, R.requested_keys(req), page_rows=SHOWN_PAGE)
    partner = ("nome_socio_ou_razao_social", "cnpj_cpf_socio", "qualificacao_socio", "data_entrada_sociedade")
    return nested.select(
        "cnpj_basico", "page", *R.COMPANY_FIELDS, "opcao_simples", "opcao_mei",
        F.size("sites").alias("n_sites"), F.size("partners").alias("n_partners"),
        F.array_join(F.transform("sites", lambda s: s["cnpj"]), "\n").alias("sites"),
        F.array_join(F.transform("partners", lambda p: F.concat_ws("|", *[p[c] for c in partner])), "\n").alias("partners"))


# ---------------------------------------------------------------------------------------------
# scalar functions over whole tables
# ---------------------------------------------------------------------------------------------
@register("cnpj_key", """
SELECT cnpj_basico, cnpj_ordem, cnpj_dv, cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj FROM estabelecimentos""")
def q_cnpj_key(spark, sf_dir):
    est = _cat(spark, sf_dir).est
    return est.select("cnpj_basico", "cnpj_ordem", "cnpj_dv", cnpj_key().alias("cnpj"))


@register("contact_fields", """
SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj,
  COALESCE(ddd_1, '') || COALESCE(telefone_1, '') AS telefone1,
  COALESCE(ddd_2, '') || COALESCE(telefone_2, '') AS telefone2,
  COALESCE(ddd_fax, '') || COALESCE(fax, '') AS fax,
  COALESCE(correio_eletronico, '') AS email
FROM estabelecimentos""")
def q_contact_fields(spark, sf_dir):
    est = _cat(spark, sf_dir).est
    return est.select(cnpj_key().alias("cnpj"),
                      F.concat(C.blank("ddd_1"), C.blank("telefone_1")).alias("telefone1"),
                      F.concat(C.blank("ddd_2"), C.blank("telefone_2")).alias("telefone2"),
                      F.concat(C.blank("ddd_fax"), C.blank("fax")).alias("fax"),
                      C.blank("correio_eletronico").alias("email"))


@register("try_int_codes", """
SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj,
  TRY_CAST(situacao_cadastral AS INTEGER) AS situacao_int,
  TRY_CAST(municipio AS INTEGER) AS municipio_int,
  TRY_CAST(cnae_fiscal_principal AS INTEGER) AS cnae_int,
  TRY_CAST(identificador_matriz_filial AS INTEGER) AS matriz_int,
  TRY_CAST(LEFT(COALESCE(cnae_fiscal_principal, ''), 2) AS INTEGER) AS cnae_divisao
FROM estabelecimentos""")
def q_try_int_codes(spark, sf_dir):
    est = _cat(spark, sf_dir).est
    return est.select(cnpj_key().alias("cnpj"),
                      C.try_int("situacao_cadastral").alias("situacao_int"),
                      C.try_int("municipio").alias("municipio_int"),
                      C.try_int("cnae_fiscal_principal").alias("cnae_int"),
                      C.try_int("identificador_matriz_filial").alias("matriz_int"),
                      C.try_int(C.cnae_division("cnae_fiscal_principal")).alias("cnae_divisao"))


@register("status_labels", """
SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, situacao_cadastral,
  CASE TRY_CAST(situacao_cadastral AS INTEGER)
    WHEN 2 THEN 'ATIVA' WHEN 3 THEN 'SUSPENSA' WHEN 4 THEN 'INAPTA' WHEN 8 THEN 'BAIXADA'
    ELSE COALESCE(situacao_cadastral, '(DESCONHECIDA)') END AS descricao,
  (TRY_CAST(situacao_cadastral AS INTEGER) = 2 OR UPPER(situacao_cadastral) = 'ATIVA') AS ativa
FROM estabelecimentos""")
def q_status_labels(spark, sf_dir):
    est = _cat(spark, sf_dir).est
    return est.select(cnpj_key().alias("cnpj"), "situacao_cadastral",
                      C.status_label("situacao_cadastral").alias("descricao"),
                      C.is_active("situacao_cadastral").alias("ativa"))


@register("filter_head_office", """
SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, identificador_matriz_filial FROM estabelecimentos
WHERE TRY_CAST(identificador_matriz_filial AS INTEGER) = 1""")
def q_filter_head_office(spark, sf_dir):
    est = _cat(spark, sf_dir).est
    return est.where(C.is_head_office("identificador_matriz_filial")).select(
        cnpj_key().alias("cnpj"), "identificador_matriz_filial")


@register("clean_names_companies",
          f"SELECT * REPLACE ({clean_name_sql('razao_social')} AS razao_social) FROM empresas")
def q_clean_names_companies(spark, sf_dir):
    emp = _registry_cols(_cat(spark, sf_dir).emp, "empresas")
    return emp.withColumns({"razao_social": clean_name("razao_social")})


@register("clean_names_sites",
          f"SELECT * REPLACE ({clean_name_sql('nome_fantasia')} AS nome_fantasia) FROM estabelecimentos")
def q_clean_names_sites(spark, sf_dir):
    est = _registry_cols(_cat(spark, sf_dir).est, "estabelecimentos")
    return est.withColumns({"nome_fantasia": clean_name("nome_fantasia")})


@register("clean_names_partners",
          f"SELECT * REPLACE ({clean_name_sql('nome_socio_ou_razao_social')} AS nome_socio_ou_razao_social, "
          f"{clean_name_sql('nome_representante')} AS nome_representante) FROM socios")
def q_clean_names_partners(spark, sf_dir):
    soc = _cat(spark, sf_dir).soc
    return soc.withColumns({"nome_socio_ou_razao_social": clean_name("nome_socio_ou_razao_social"),
                            "nome_representante": clean_name("nome_representante")})


@register("slug_values", f"""
SELECT cnpj_basico, razao_social, {slug_sql('razao_social')} AS razao_social_slug FROM empresas""")
def q_slug_values(spark, sf_dir):
    emp = _cat(spark, sf_dir).emp
    return emp.select("cnpj_basico", "razao_social", slug("razao_social").alias("razao_social_slug"))


@register("slug_activities", f"""
SELECT codigo, descricao, {slug_sql('descricao')} AS descricao_slug FROM cnaes""")
def q_slug_activities(spark, sf_dir):
    cnae = _cat(spark, sf_dir).cnae
    return cnae.select("codigo", "descricao", slug("descricao").alias("descricao_slug"))


# ---------------------------------------------------------------------------------------------
# joins one at a time
# ---------------------------------------------------------------------------------------------
@register("join_site_company", """
SELECT est.cnpj_basico || est.cnpj_ordem || est.cnpj_dv AS cnpj, emp.razao_social, emp.porte_empresa, est.uf
FROM estabelecimentos est JOIN empresas emp USING (cnpj_basico)""")
def q_join_site_company(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    df = fact_join(cat.est, [(cat.emp.select("cnpj_basico", "razao_social", "porte_empresa"), "inner")],
                   **cat.skew_inputs("estabelecimentos", "cnpj_basico", DEFAULT_SKEW))
    return df.select(cnpj_key().alias("cnpj"), "razao_social", "porte_empresa", "uf")


# companies with more than three sites are hot here: most rows take the broadcast branch
@register("join_site_company_hot", """
SELECT est.cnpj_basico || est.cnpj_ordem || est.cnpj_dv AS cnpj, emp.razao_social, sim.opcao_mei
FROM estabelecimentos est JOIN empresas emp USING (cnpj_basico) LEFT JOIN simples sim USING (cnpj_basico)""")
def q_join_site_company_hot(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    dims = [(cat.emp.select("cnpj_basico", "razao_social"), "inner"), (cat.sim.select("cnpj_basico", "opcao_mei"), "left")]
    df = fact_join(cat.est.select("cnpj_basico", "cnpj_ordem", "cnpj_dv"), dims, skew=SkewPolicy(hot_rows=3))
    return df.select(cnpj_key().alias("cnpj"), "razao_social", "opcao_mei")


@register("join_tax_regime", """
SELECT est.cnpj_basico || est.cnpj_ordem || est.cnpj_dv AS cnpj, sim.opcao_simples, sim.opcao_mei
FROM estabelecimentos est LEFT JOIN simples sim USING (cnpj_basico)""")
def q_join_tax_regime(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    df = fact_join(cat.est, [(cat.sim.select("cnpj_basico", "opcao_simples", "opcao_mei"), "left")],
                   **cat.skew_inputs("estabelecimentos", "cnpj_basico", DEFAULT_SKEW))
    return df.select(cnpj_key().alias("cnpj"), "opcao_simples", "opcao_mei")


def _layout(spark, sf_dir):
    """The co-located layout with eight buckets; companies with more than three sites are hot."""
    return write_layout(_cat(spark, sf_dir), scratch_path(spark, "layout"), SkewPolicy(hot_rows=3), buckets=8)


@register("join_colocated", """
SELECT est.cnpj_basico || est.cnpj_ordem || est.cnpj_dv AS cnpj, emp.razao_social, sim.opcao_mei
FROM estabelecimentos est JOIN empresas emp USING (cnpj_basico) LEFT JOIN simples sim USING (cnpj_basico)""")
def q_join_colocated(spark, sf_dir):
    def joined(cat):
        dims = [(cat.emp.select("cnpj_basico", "razao_social"), "inner"), (cat.sim.select("cnpj_basico", "opcao_mei"), "left")]
        return fact_join(cat.est.select("cnpj_basico", "cnpj_ordem", "cnpj_dv"), dims, skew=SPLIT_ALREADY)
    return over_parts(_layout(spark, sf_dir), joined).select(cnpj_key().alias("cnpj"), "razao_social", "opcao_mei")


@register("leads_colocated", lead_sql(f"{IN_MG} AND {PORTE_35}", BY_NAME))
def q_leads_colocated(spark, sf_dir):
    found = over_parts(_layout(spark, sf_dir), lambda cat: leads(cat, LeadFilter(uf="MG"), sort=False, skew=SPLIT_ALREADY))
    return order_nulls_last(found, ["razao_social", "cnpj"])


@register("join_city_left", """
SELECT est.cnpj_basico || est.cnpj_ordem || est.cnpj_dv AS cnpj, est.municipio, mun.descricao AS municipio_nome
FROM estabelecimentos est
LEFT JOIN municipios mun ON TRY_CAST(est.municipio AS INTEGER) = TRY_CAST(mun.codigo AS INTEGER)""")
def q_join_city_left(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    df = lookup_join(cat.est, cat.mun, "municipio", "left", prefix="mun")
    return df.select(cnpj_key().alias("cnpj"), "municipio", F.col("mun_descricao").alias("municipio_nome"))


@register("join_activity", """
SELECT est.cnpj_basico || est.cnpj_ordem || est.cnpj_dv AS cnpj, est.cnae_fiscal_principal,
       cnae.descricao AS cnae_nome
FROM estabelecimentos est
LEFT JOIN cnaes cnae ON TRY_CAST(est.cnae_fiscal_principal AS INTEGER) = TRY_CAST(cnae.codigo AS INTEGER)""")
def q_join_activity(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    df = lookup_join(cat.est, cat.cnae, "cnae_fiscal_principal", "left", prefix="cnae")
    return df.select(cnpj_key().alias("cnpj"), "cnae_fiscal_principal", F.col("cnae_descricao").alias("cnae_nome"))
