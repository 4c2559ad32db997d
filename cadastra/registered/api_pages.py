"""Registered API-page queries: flattening, page cut-off and the items of the used pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ._registry import register
from ..functions import codes as C
from ..functions.identity import cnpj_key
from ..operators.joins import DEFAULT_SKEW, fact_join, lookup_join
from ..session import scratch_path
from ..sources import api as API
from .common import _cat


# ---------------------------------------------------------------------------------------------
# landed API pages: one page document per site; searches by state; page number from the site's
# order field (1..25); SP page 16 failed; RJ announces 12 pages, others 40; '09' sites are empty
# ---------------------------------------------------------------------------------------------

API_MAX_PAGES = 45


def _api_pages(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    df = fact_join(cat.est, [(cat.emp.select("cnpj_basico", "razao_social", "porte_empresa"), "inner")],
                   **cat.skew_inputs("estabelecimentos", "cnpj_basico", DEFAULT_SKEW))
    df = lookup_join(df, cat.cnae, "cnae_fiscal_principal", "left", prefix="cnae")
    item = F.struct(cnpj_key().alias("cnpj"), "razao_social", "nome_fantasia", "uf", "municipio",
                    "situacao_cadastral", F.col("porte_empresa").alias("porte"),
                    F.when(F.col("cnae_descricao").isNotNull(),
                           F.struct(F.col("cnae_descricao").alias("descricao"))).alias("atividade_principal"))
    items = F.array(item)
    data = F.when(F.col("cnpj_dv") == "09", F.filter(items, lambda x: F.lit(False))).otherwise(items)
    paginas = F.when(F.col("uf") == "RJ", F.lit(12)).otherwise(F.lit(40))
    body = F.to_json(F.struct(data.alias("data"), F.struct(paginas.alias("paginas")).alias("paginacao")))
    pages = df.select(F.upper("uf").alias("search_id"), (F.floor(C.try_int("cnpj_ordem") / 2).cast("int") + 1).alias("page"),
                      F.when((F.col("uf") == "SP") & (F.col("cnpj_ordem") == "0030"), 500)
                      .otherwise(200).alias("status"), body.alias("body"))
    path = scratch_path(spark, "api-pages")
    pages.write.parquet(path)
    return spark.read.parquet(path)


API_SITES_SQL = """
FROM estabelecimentos est JOIN empresas emp USING (cnpj_basico)
LEFT JOIN cnaes cnae ON TRY_CAST(est.cnae_fiscal_principal AS INTEGER) = TRY_CAST(cnae.codigo AS INTEGER)
"""


@register("flatten_api_pages", """
SELECT UPPER(est.uf) AS search_id, CAST(FLOOR(TRY_CAST(est.cnpj_ordem AS INTEGER) / 2) AS INTEGER) + 1 AS page,
  est.cnpj_basico || est.cnpj_ordem || est.cnpj_dv AS cnpj, emp.razao_social,
  COALESCE(est.nome_fantasia, '') AS nome_fantasia, COALESCE(est.uf, '') AS uf,
  COALESCE(est.municipio, '') AS municipio, COALESCE(est.situacao_cadastral, '') AS situacao_cadastral,
  COALESCE(emp.porte_empresa, '') AS porte, COALESCE(cnae.descricao, '') AS cnae
""" + API_SITES_SQL + "WHERE est.cnpj_dv <> '09'")
def q_flatten_api_pages(spark, sf_dir):
    return API.flatten_pages(_api_pages(spark, sf_dir))


API_CUTOFF_CTES = f""",
pages AS (
  SELECT UPPER(est.uf) AS search_id, CAST(FLOOR(TRY_CAST(est.cnpj_ordem AS INTEGER) / 2) AS INTEGER) + 1 AS page,
    CASE WHEN est.uf = 'SP' AND est.cnpj_ordem = '0030' THEN 500 ELSE 200 END AS status,
    CASE WHEN est.cnpj_dv = '09' THEN 0 ELSE 1 END AS n_items,
    CASE WHEN est.uf = 'RJ' THEN 12 ELSE 40 END AS paginas
  {API_SITES_SQL}
),
per_page AS (
  SELECT search_id, page, (MAX(status) <> 200 OR SUM(n_items) = 0) AS bad, MAX(paginas) AS paginas
  FROM pages GROUP BY search_id, page
),
flags AS (
  -- a used page exists, so the candidates are the existing pages up to the cap
  SELECT c.search_id, c.page AS p,
    (SELECT COUNT(*) FROM per_page q WHERE q.search_id = c.search_id AND q.page <= c.page AND NOT q.bad)
      = c.page AS all_good,
    (SELECT COUNT(*) FROM per_page q WHERE q.search_id = c.search_id AND q.page < c.page AND NOT q.bad
       AND q.page >= q.paginas) = 0 AS not_stopped
  FROM per_page c WHERE c.page BETWEEN 1 AND {API_MAX_PAGES}
),
cut AS (SELECT s.search_id,
  CAST(COALESCE(MAX(CASE WHEN f.all_good AND f.not_stopped THEN f.p END), 0) AS INTEGER) AS ultima_pagina
FROM (SELECT DISTINCT search_id FROM per_page) s LEFT JOIN flags f USING (search_id)
GROUP BY s.search_id)
"""


@register("api_page_cutoff", API_CUTOFF_CTES + "SELECT search_id, ultima_pagina FROM cut")
def q_api_page_cutoff(spark, sf_dir):
    return API.page_cutoff(_api_pages(spark, sf_dir), max_pages=API_MAX_PAGES)


@register("api_results", API_CUTOFF_CTES + """
SELECT UPPER(est.uf) AS search_id, CAST(FLOOR(TRY_CAST(est.cnpj_ordem AS INTEGER) / 2) AS INTEGER) + 1 AS page,
  est.cnpj_basico || est.cnpj_ordem || est.cnpj_dv AS cnpj, emp.razao_social,
  COALESCE(est.nome_fantasia, '') AS nome_fantasia, COALESCE(est.uf, '') AS uf,
  COALESCE(est.municipio, '') AS municipio, COALESCE(est.situacao_cadastral, '') AS situacao_cadastral,
  COALESCE(emp.porte_empresa, '') AS porte, COALESCE(cnae.descricao, '') AS cnae
""" + API_SITES_SQL + """
JOIN cut ON cut.search_id = UPPER(est.uf)
WHERE est.cnpj_dv <> '09' AND CAST(FLOOR(TRY_CAST(est.cnpj_ordem AS INTEGER) / 2) AS INTEGER) + 1 <= cut.ultima_pagina""")
def q_api_results(spark, sf_dir):
    """What the paging client returns: the items of the pages it used."""
    return API.flatten_pages(API.used_pages(_api_pages(spark, sf_dir), API_MAX_PAGES))
