"""Landed pages of the company-search JSON API.

A page body looks like ``{"data": [{cnpj, razao_social, nome_fantasia, uf, municipio,
situacao_cadastral, porte, atividade_principal: {descricao}}, …], "paginacao": {"paginas": N}}``.

* :func:`flatten_pages` – ``from_json`` + ``explode`` into eight flat columns; missing fields
  become ``''`` except the key and the company name (kept NULL).
* :func:`page_cutoff` – the pages a sequential client would have used for each search: it stops
  at the first failed or empty page, after the last page the API announces, or at ``max_pages``.
  Computed with aggregates per search (no ordering inside a group, no gathering of pages).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import is_small
from ..session import scratch_path

ITEM = T.StructType([
    T.StructField("cnpj", T.StringType()),
    T.StructField("razao_social", T.StringType()),
    T.StructField("nome_fantasia", T.StringType()),
    T.StructField("uf", T.StringType()),
    T.StructField("municipio", T.StringType()),
    T.StructField("situacao_cadastral", T.StringType()),
    T.StructField("porte", T.StringType()),
    T.StructField("atividade_principal", T.StructType([T.StructField("descricao", T.StringType())])),
])
PAGE = T.StructType([
    T.StructField("data", T.ArrayType(ITEM)),
    T.StructField("paginacao", T.StructType([T.StructField("paginas", T.IntegerType())])),
])
DEFAULT_MAX_PAGES = 5


def parse_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    return pages.withColumn("_page", F.from_json(F.col(body), PAGE))


def flatten_pages(pages: DataFrame, body: str = "body", keep=("search_id", "page")) -> DataFrame:
    p = parse_pages(pages, body)
    items = p.select(*[c for c in keep if c in pages.columns], F.explode("_page.data").alias("it"))
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return items.select(
        *[c for c in keep if c in pages.columns],
        F.col("it.cnpj").alias("cnpj"),
        F.col("it.razao_social").alias("razao_social"),
        blank("it.nome_fantasia").alias("nome_fantasia"),
        blank("it.uf").alias("uf"),
        blank("it.municipio").alias("municipio"),
        blank("it.situacao_cadastral").alias("situacao_cadastral"),
        blank("it.porte").alias("porte"),
        blank("it.atividade_principal.descricao").alias("cnae"),
    )


def page_cutoff(pages: DataFrame, max_pages: int = DEFAULT_MAX_PAGES, body: str = "body",
                status: str = "status", search: str = "search_id", page: str = "page") -> DataFrame:
    """Per search: the last page used (``ultima_pagina``); pages ``1..ultima_pagina`` are kept."""
    p = parse_pages(pages, body)
    n_items = F.coalesce(F.size("_page.data"), F.lit(0))
    per_page = (p.groupBy(search, page)
                .agg(F.max(F.when(F.col(status) != 200, 1).otherwise(0)).alias("failed"),
                     F.sum(F.when(n_items > 0, n_items).otherwise(0)).alias("items"),
                     F.max("_page.paginacao.paginas").alias("paginas")))
    # the counts are all that the rest needs: written, so that the bodies are parsed once
    path = scratch_path(pages.sparkSession, "api-pages")
    per_page.write.parquet(path)
    per_page = pages.sparkSession.read.schema(per_page.schema).parquet(path)
    bad = (F.col("failed") == 1) | (F.col("items") == 0)
    stats = per_page.groupBy(search).agg(
        F.min(F.when(bad, F.col(page))).alias("first_bad"),
        F.min(F.when(~bad, F.col(page))).alias("first_ok"),
        # the announced page count is read from each good page; the client stops at the first
        # good page p with p >= paginas
        F.min(F.when(~bad & (F.col(page) >= F.coalesce("paginas", F.col(page))), F.col(page))).alias("last_announced"),
    )
    # pages are fetched 1, 2, …; a missing page number counts as an empty page
    gaps = (per_page.select(search, page)
            .withColumn("_next", F.col(page) + 1)
            .join(per_page.select(search, F.col(page).alias("_next")), [search, "_next"], "left_anti")
            .groupBy(search).agg(F.min("_next").alias("first_missing")))
    first_page_missing = per_page.groupBy(search).agg((F.min(page) > 1).alias("_no_first"))
    s = stats.join(gaps, search, "left").join(first_page_missing, search)
    stop_before = F.least(
        F.coalesce(F.col("first_bad"), F.lit(1 << 30)),
        F.coalesce(F.col("first_missing"), F.lit(1 << 30)),
    )
    last = F.least(stop_before - 1, F.coalesce(F.col("last_announced"), F.lit(1 << 30)), F.lit(int(max_pages)))
    return s.select(search, F.when(F.col("_no_first"), F.lit(0)).otherwise(last).cast("int").alias("ultima_pagina"))


def used_pages(pages: DataFrame, max_pages: int = DEFAULT_MAX_PAGES, search: str = "search_id",
               page: str = "page", **kw) -> DataFrame:
    cut = page_cutoff(pages, max_pages, search=search, page=page, **kw)
    if is_small(cut):  # one row per search: the pages, bodies included, then stay where they are
        cut = F.broadcast(cut)
    return pages.join(cut, search).where(F.col(page) <= F.col("ultima_pagina")).drop("ultima_pagina")
