"""MEI (individual micro-entrepreneur) lists and counts.

* :func:`mei_active_leads` – active MEI sites of a state with address and contacts; the site must
  resolve to a known municipality (inner join with the lookup).
* :func:`mei_inactive_sites` / ``_total`` / ``_by_status`` – MEI sites of a state whose status is
  suspended, unfit or closed (3, 4, 8), head offices only by default; counted as distinct CNPJs
  and broken down by status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions.identity import cnpj_key
from ..operators.aggregates import status_breakdown
from ..operators.joins import DEFAULT_SKEW, SkewPolicy, fact_join, lookup_join
from ..sources.catalog import Catalog
from .leads import active, code_of, state_eq


def mei_active_leads(cat: Catalog, uf: str = "MG", skew: SkewPolicy = DEFAULT_SKEW) -> DataFrame:
    cat.require("estabelecimentos", "empresas", "simples", "municipios")
    est = cat.est.where(state_eq(cat.est, uf) & active(cat.est))
    emp = cat.emp.select("cnpj_basico", "razao_social")
    sim = cat.sim.select("cnpj_basico", "opcao_mei").where(C.is_yes("opcao_mei")).drop("opcao_mei")
    df = fact_join(est, [(emp, "inner"), (sim, "inner")], skew=skew,
                   **cat.skew_inputs("estabelecimentos", "cnpj_basico", skew))
    df = lookup_join(df, cat.mun, "municipio", "inner", prefix="mun")
    b = C.blank
    return df.select(
        cnpj_key().alias("cnpj"),
        "razao_social",
        F.coalesce("nome_fantasia", "razao_social").alias("nome_fantasia"),
        b("tipo_logradouro").alias("tipo_logradouro"),
        b("logradouro").alias("logradouro"),
        b("numero").alias("numero"),
        b("complemento").alias("complemento"),
        b("bairro").alias("bairro"),
        b("cep").alias("cep"),
        "uf",
        F.col("municipio").alias("municipio_codigo"),
        F.col("mun_descricao").alias("municipio_nome"),
        F.concat(b("ddd_1"), b("telefone_1")).alias("telefone1"),
        F.concat(b("ddd_2"), b("telefone_2")).alias("telefone2"),
        F.concat(b("ddd_fax"), b("fax")).alias("fax"),
        b("correio_eletronico").alias("email"),
        "situacao_cadastral",
    )


def mei_inactive_sites(cat: Catalog, uf: str = "MG", include_branches: bool = False,
                       codes=C.INACTIVE_CODES, skew: SkewPolicy = DEFAULT_SKEW) -> DataFrame:
    cat.require("estabelecimentos", "simples")
    preds = state_eq(cat.est, uf) & C.code_in(code_of(cat.est, "situacao_cadastral"), codes)
    if not include_branches:
        preds = preds & C.is_head_office(code_of(cat.est, "identificador_matriz_filial"))
    est = cat.est.where(preds).select("cnpj_basico", "cnpj_ordem", "cnpj_dv", "situacao_cadastral", "uf",
                                      "identificador_matriz_filial")
    sim = cat.sim.select("cnpj_basico", "opcao_mei").where(C.is_yes("opcao_mei")).drop("opcao_mei")
    return fact_join(est, [(sim, "inner")], skew=skew, **cat.skew_inputs("estabelecimentos", "cnpj_basico", skew))


def mei_inactive_total(cat: Catalog, **kw) -> DataFrame:
    return mei_inactive_sites(cat, **kw).agg(F.count_distinct(cnpj_key()).alias("total_meis_inativos"))


def mei_inactive_by_status(cat: Catalog, **kw) -> DataFrame:
    return status_breakdown(mei_inactive_sites(cat, **kw), "situacao_cadastral", cnpj_key())
