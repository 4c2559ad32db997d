"""Company lists: the parameterised filtered list and the health-sector list.

Plan shape (both lists): filter the sites first (state, status, activity, municipality code,
head office — all pushed to the scan where the predicate allows), filter companies on size and
tax regime on the MEI flag, join the three on ``cnpj_basico`` (one shuffle per input, shared
partitioning, hot companies split — see ``operators.joins.fact_join``), then resolve the two code
lookups with broadcast joins, project, and sort by company name.

Absent optional tables (tax regime, municipalities, activities) remove their join; their output
columns become NULL or ``''`` and their filters are skipped (a municipality *name* filter is
ignored with a warning, a municipality *code* filter falls back to the site's own code).
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions.identity import cnpj_key
from ..operators.joins import DEFAULT_SKEW, SkewPolicy, fact_join, lookup_join
from ..operators.ordering import order_nulls_last, top_k
from ..sources.catalog import Catalog
from ..sources.landing import CODE_COLUMNS, SECONDARY_KEY


def null_str():
    return F.lit(None).cast("string")


@dataclass
class LeadFilter:
    """Filters of the company list. Values are bound as literals, never spliced into SQL."""
    uf: str | None = None
    municipio: str | None = None          # name (case-insensitive) or numeric code
    cnae: int | None = None               # activity division: first two digits
    porte: list[int] = field(default_factory=lambda: list(C.LARGE_SIZE_CODES))
    situacao: list[int] | None = None
    limit: int | None = None
    opcao_sim: bool = False               # MEI only (the flag tested is opcao_mei)
    ativos: bool = False                  # active only, unless ``situacao`` is given
    # filters of the web form, applied to local data
    cnae_principal: str | None = None     # exact main activity code
    natureza: str | None = None           # legal nature code
    cnae_secundario: str | None = None    # member of the secondary-activity list
    aberto_de: str | None = None          # opening date range, 'YYYY-MM-DD' or 'YYYYMMDD'
    aberto_ate: str | None = None

    def __post_init__(self):
        self.uf = self.uf.strip().upper() if self.uf and self.uf.strip() else None
        self.municipio = self.municipio.strip() if self.municipio and self.municipio.strip() else None
        self.porte = sorted({int(p) for p in (self.porte or C.LARGE_SIZE_CODES)})
        self.situacao = sorted({int(s) for s in self.situacao}) if self.situacao else None
        bad = [p for p in self.porte if p not in C.VALID_SIZE_CODES]
        bad += [s for s in (self.situacao or []) if s not in C.VALID_STATUS_CODES]
        if bad:
            raise ValueError(f"invalid size/status codes {bad}: size codes are {C.VALID_SIZE_CODES}, "
                             f"status codes {C.VALID_STATUS_CODES}")
        self.limit = self.limit if isinstance(self.limit, int) and self.limit > 0 else None
        self.cnae = self.cnae if isinstance(self.cnae, int) and self.cnae > 0 else None

    @property
    def municipio_is_code(self) -> bool:
        return bool(self.municipio) and re.fullmatch(r"\d+", self.municipio) is not None


def _all(preds: list[Column]) -> Column | None:
    return reduce(and_, preds) if preds else None


def _where(df: DataFrame, preds: list[Column]) -> DataFrame:
    p = _all(preds)
    return df if p is None else df.where(p)


def state_eq(est: DataFrame, uf: str) -> Column:
    """State test; on landed sites it reads the partition column, so other states are pruned."""
    if "uf_norm" in est.columns:
        return F.col("uf_norm") == F.lit(uf.upper())
    return F.upper(F.col("uf")) == F.lit(uf.upper())


def code_of(df: DataFrame, column: str) -> Column:
    """The lenient integer of a code column; landed tables hold it, so that filters on it are pushed down."""
    landed = {src: c for codes in CODE_COLUMNS.values() for c, src in codes.items()}.get(column)
    return F.col(landed) if landed in df.columns else C.try_int(column)


def active(est: DataFrame) -> Column:
    """Active by code or by text; landed sites hold the answer."""
    return F.col("ativa") if "ativa" in est.columns else C.is_active("situacao_cadastral", code_of(est, "situacao_cadastral"))


def division(est: DataFrame, number: int) -> Column:
    """Activity division as a number; landed sites hold it."""
    if "divisao_int" in est.columns:
        return F.col("divisao_int") == F.lit(int(number))
    return C.division_eq("cnae_fiscal_principal", number)


def with_secondary_activity(cat: Catalog, est: DataFrame, code: str) -> DataFrame:
    """Sites with ``code`` among their secondary activities. A landed catalog answers from the inverted table: the rows
    of one code are a pruned read, and sites are kept by key and list hash; otherwise every list is split."""
    index = cat.indexes.get("secondary_activity")
    if index is None or "secundaria_id" not in est.columns:
        return est.where(C.in_list_text("cnae_fiscal_secundaria", code))
    wanted = index.where(F.col("codigo") == F.lit(code))
    return est.join(wanted, reduce(and_, [est[c].eqNullSafe(wanted[c]) for c in SECONDARY_KEY]), "left_semi")


def site_predicates(f: LeadFilter, est: DataFrame) -> list[Column]:
    """Predicates that only read site columns (applied before any join)."""
    p: list[Column] = []
    if f.situacao:
        p.append(C.code_in(code_of(est, "situacao_cadastral"), f.situacao))
    elif f.ativos:
        p.append(C.code_eq(code_of(est, "situacao_cadastral"), C.ACTIVE_CODE))
    if f.uf:
        p.append(state_eq(est, f.uf))
    if f.municipio and f.municipio_is_code:
        # with the lookup the code must also exist there (inner semantics, enforced after the join)
        p.append(C.code_eq(code_of(est, "municipio"), int(f.municipio)))
    if f.cnae:
        p.append(division(est, f.cnae))
    if f.cnae_principal:
        p.append(F.col("cnae_fiscal_principal") == F.lit(f.cnae_principal))
    if f.aberto_de:
        p.append(F.col("data_inicio_atividade") >= F.lit(C.date_arg(f.aberto_de)))
    if f.aberto_ate:
        p.append(F.col("data_inicio_atividade") <= F.lit(C.date_arg(f.aberto_ate)))
    return p


def _contact(a: str, b: str) -> Column:
    return F.concat(C.blank(a), C.blank(b))


def leads(cat: Catalog, f: LeadFilter | None = None, sort: bool = True,
          skew: SkewPolicy = DEFAULT_SKEW) -> DataFrame:
    """Filtered company list (one row per site), sorted by company name.

    Equal names are ordered by CNPJ: the sort's range partitioner can then split a name shared
    by many rows (or NULL) over several tasks."""
    f = f or LeadFilter()
    cat.require("empresas", "estabelecimentos")
    has_sim, has_mun, has_cnae = cat.has("simples"), cat.has("municipios"), cat.has("cnaes")
    municipio = f.municipio
    if municipio and not has_mun and not f.municipio_is_code:
        warnings.warn("municipality given by name without a municipality table: filter ignored")
        municipio = None
    f = LeadFilter(**{**f.__dict__, "municipio": municipio})
    if f.opcao_sim and not has_sim:
        warnings.warn("MEI filter given without a tax-regime table: filter ignored")

    est = _where(cat.est, site_predicates(f, cat.est))
    if f.cnae_secundario:
        est = with_secondary_activity(cat, est, f.cnae_secundario)
    emp_preds = [C.code_in(code_of(cat.emp, "porte_empresa"), f.porte)]
    if f.natureza:
        emp_preds.append(F.col("natureza_juridica") == F.lit(f.natureza))
    emp = _where(cat.emp, emp_preds).select("cnpj_basico", "razao_social", "porte_empresa", "natureza_juridica")

    if has_mun and f.municipio:
        # a municipality filter reads the (broadcast) lookup: join it map-side first, so only
        # the matching sites reach the shuffle joins
        est = lookup_join(est, cat.mun, "municipio", "left", prefix="mun")
        if f.municipio_is_code:
            est = est.where(C.try_int("mun_codigo") == F.lit(int(f.municipio)))
        else:
            est = est.where(C.same_text_ci("mun_descricao", f.municipio))

    dims = [(emp, "inner")]
    if has_sim:
        sim = cat.sim.select("cnpj_basico", "opcao_simples", "opcao_mei")
        if f.opcao_sim:
            dims.append((sim.where(C.is_yes("opcao_mei")), "inner"))
        else:
            dims.append((sim, "left"))
    df = fact_join(est, dims, skew=skew, **cat.skew_inputs("estabelecimentos", "cnpj_basico", skew))

    if has_mun and not f.municipio:
        df = lookup_join(df, cat.mun, "municipio", "left", prefix="mun")
    if has_cnae:
        df = lookup_join(df, cat.cnae, "cnae_fiscal_principal", "left", prefix="cnae")

    out = df.select(
        cnpj_key().alias("cnpj"),
        "razao_social",
        F.coalesce("nome_fantasia", "razao_social").alias("nome_fantasia"),
        F.col("cnae_fiscal_principal").alias("cnae_principal"),
        (F.col("cnae_descricao") if has_cnae else null_str()).alias("cnae_principal_nome"),
        "data_inicio_atividade",
        "uf",
        F.col("municipio").alias("municipio_codigo"),
        (F.col("mun_descricao") if has_mun else null_str()).alias("municipio_nome"),
        "tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep",
        _contact("ddd_1", "telefone_1").alias("telefone1"),
        _contact("ddd_2", "telefone_2").alias("telefone2"),
        _contact("ddd_fax", "fax").alias("fax"),
        F.col("correio_eletronico").alias("email"),
        (C.blank("opcao_simples") if has_sim else F.lit("")).alias("opcao_simples"),
        (C.blank("opcao_mei") if has_sim else F.lit("")).alias("opcao_mei"),
    )
    if f.limit:
        return top_k(out, f.limit, ["razao_social"])
    return order_nulls_last(out, ["razao_social", "cnpj"]) if sort else out


def health_leads(cat: Catalog, include_branches: bool = False, uf: str = "MG",
                 municipio_code: int = 5403, division: str = C.HEALTH_DIVISION,
                 sizes=C.LARGE_SIZE_CODES, sort: bool = True,
                 skew: SkewPolicy = DEFAULT_SKEW) -> DataFrame:
    """Health-sector sites (activity division 86) of one municipality, size EPP and above,
    excluding MEI companies; head offices only unless ``include_branches``."""
    cat.require("empresas", "estabelecimentos")
    has_sim, has_mun, has_cnae = cat.has("simples"), cat.has("municipios"), cat.has("cnaes")
    site_preds = [
        state_eq(cat.est, uf),
        # the lookup's code equals the site's code whenever the two joined, so one test suffices
        C.code_eq(code_of(cat.est, "municipio"), municipio_code),
        F.col("cnae_fiscal_principal").startswith(division),
    ]
    if not include_branches:
        site_preds.append(C.is_head_office(code_of(cat.est, "identificador_matriz_filial")))
    est = _where(cat.est, site_preds)
    emp = cat.emp.where(C.code_in(code_of(cat.emp, "porte_empresa"), sizes)).select(
        "cnpj_basico", "razao_social", "porte_empresa")
    dims = [(emp, "inner")]
    if has_sim:
        # left join + filter after it: keeps companies without a tax-regime row, drops MEI ones
        dims.append((cat.sim.select("cnpj_basico", "opcao_mei"), "left"))
    df = fact_join(est, dims, skew=skew, **cat.skew_inputs("estabelecimentos", "cnpj_basico", skew))
    if has_sim:
        df = df.where(~C.is_yes("opcao_mei"))
    if has_mun:
        df = lookup_join(df, cat.mun, "municipio", "left", prefix="mun")
    if has_cnae:
        df = lookup_join(df, cat.cnae, "cnae_fiscal_principal", "left", prefix="cnae")

    out = df.select(
        cnpj_key().alias("cnpj"),
        "razao_social",
        F.coalesce("nome_fantasia", "razao_social").alias("nome_fantasia"),
        F.col("porte_empresa").alias("porte"),
        "data_inicio_atividade",
        "situacao_cadastral",
        "uf",
        (F.col("mun_descricao") if has_mun else F.col("municipio")).alias("municipio"),
        "tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep",
        _contact("ddd_1", "telefone_1").alias("telefone1"),
        _contact("ddd_2", "telefone_2").alias("telefone2"),
        F.col("correio_eletronico").alias("email"),
        F.col("cnae_fiscal_principal").alias("cnae_principal"),
        (F.col("cnae_descricao") if has_cnae else null_str()).alias("cnae_principal_nome"),
        C.health_kind(F.col("cnae_descricao") if has_cnae else None).alias("tipo_saude"),
    )
    return order_nulls_last(out, ["razao_social", "cnpj"]) if sort else out
