"""Per-CNPJ report, for a DataFrame of requested CNPJs instead of one key at a time.

A request is any text holding a CNPJ (punctuation allowed). It is reduced to digits, checked
(14 digits required; a wrong check digit only flags the row) and split into its three parts. It is
*found* when a site has that key and the site's company has a row; only found keys have a report:

* :func:`cnpj_report`      – one row per request and company row: status, company data, tax regime
* :func:`companies_of`     – distinct company rows that own a found site
* :func:`simples_status`   – the tax-regime row of each found company (first row by a stated order)
* :func:`sites_of`         – the found sites with labels and printable address/contact lines
* :func:`partners_of`      – partners of the found companies

* :func:`nested_report`    – found companies with sites and partners as nested arrays, in pages

Requests are few beside the tables. :func:`ask` writes the distinct requested keys once and counts them in
the same pass; every part starts from that small table and is one lazy plan after it. A key set that the
count proves small is broadcast, so the site table is scanned, not shuffled, and up to ``LISTED_KEYS``
company keys also become an IN list, which row-group statistics and the landed Bloom filters answer. The parts
of a report stay flat; the nested form cuts a company with very many sites or partners into pages of
bounded length instead of gathering it into one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions.identity import cnpj_key, cnpj_mask, cnpj_split, digits_are_valid_cnpj, only_digits
from ..operators.joins import lookup_join
from ..operators.ordering import order_nulls_last, pages
from ..session import written
from ..sources.catalog import Catalog

KEY3 = ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]
COMPANY_FIELDS = ["razao_social", "natureza_juridica", "porte_empresa", "capital_social_empresa"]
SIMPLES_FIELDS = ["opcao_simples", "data_opcao_simples", "data_exclusao_simples",
                  "opcao_mei", "data_opcao_mei", "data_exclusao_mei"]


def normalize_requests(req: DataFrame, col: str = "cnpj_input") -> DataFrame:
    """Digits, shape/check-digit flags and the three key parts of each request."""
    # digits are projected first, so the regex runs once per row
    digits = req.select(F.col(col), only_digits(col).alias("cnpj_digitos"))
    d = F.col("cnpj_digitos")
    b, o, v = cnpj_split(d)
    return digits.select(
        F.col(col), d,
        (F.length(d) == 14).alias("tamanho_ok"),
        digits_are_valid_cnpj(d).alias("dv_valido"),
        b.alias("cnpj_basico"), o.alias("cnpj_ordem"), v.alias("cnpj_dv"),
    )


def requested_keys(req: DataFrame, col: str = "cnpj_input", distinct: bool = True) -> DataFrame:
    """Well-formed keys (14 digits) with their check-digit flag; de-duplicated unless the caller
    only semi-joins against them (those joins de-duplicate the key columns they use)."""
    n = normalize_requests(req, col).where("tamanho_ok").select(*KEY3, "dv_valido")
    return n.distinct() if distinct else n


#: company keys up to which a filter lists them, and rows up to which key sets are broadcast
LISTED_KEYS, BROADCAST_KEYS = 10_000, 1_000_000


@dataclass(frozen=True)
class Asked:
    """Requested keys: the written table of distinct (key parts, dv_valido), its number of rows, and the distinct
    company keys if they are few enough to list."""
    rows: DataFrame
    n: int
    listed: list[str] | None

    @property
    def sites(self) -> DataFrame:
        return self._small(self.rows.select(*KEY3).distinct())

    @property
    def companies(self) -> DataFrame:
        return self._small(company_keys(self.rows))

    def _small(self, keys: DataFrame) -> DataFrame:
        """``keys``, of which there are ``n`` at most: broadcast if that is few."""
        return F.broadcast(keys) if self.n <= BROADCAST_KEYS else keys

    def pruned(self, table: DataFrame) -> DataFrame:
        """``table`` without row groups that hold no requested company."""
        return table if self.listed is None else table.where(F.col("cnpj_basico").isin(self.listed))

    def of_companies(self, table: DataFrame) -> DataFrame:
        """Rows of ``table`` that belong to a requested company (whether or not a site of it is found)."""
        return self.pruned(table).join(self.companies, "cnpj_basico", "left_semi")


def ask(keys: DataFrame | Asked) -> Asked:
    """The requested keys, written once: two jobs, three if they are few enough to list."""
    if isinstance(keys, Asked):
        return keys
    rows, n = written(keys.select(*KEY3, "dv_valido").distinct(), "requested-keys")
    listed = sorted({r[0] for r in rows.select("cnpj_basico").collect()}) if n <= LISTED_KEYS else None
    return Asked(rows, n, listed)


def matched_sites(cat: Catalog, keys: DataFrame | Asked) -> DataFrame:
    """Sites whose three key parts equal a requested key."""
    asked = ask(keys)
    return asked.pruned(cat.est).join(asked.sites, KEY3, "left_semi")


def found_sites(cat: Catalog, keys: DataFrame | Asked) -> DataFrame:
    """Matched sites whose company has a row."""
    asked = ask(keys)
    known = asked._small(company_keys(asked.of_companies(cat.emp.select("cnpj_basico"))))
    return matched_sites(cat, asked).join(known, "cnpj_basico", "left_semi")


def found_companies(cat: Catalog, asked: Asked) -> DataFrame:
    """Company keys of the found sites; no more than there are requested keys."""
    return asked._small(company_keys(found_sites(cat, asked)))


def company_keys(df: DataFrame) -> DataFrame:
    """Distinct company keys of ``df``. Used as the filtering side of semi joins: partial
    aggregation collapses a company with very many rows before the shuffle, so the semi join
    never meets a skewed filtering side (AQE can only split the other side)."""
    return df.select("cnpj_basico").distinct()


def companies_of(cat: Catalog, keys: DataFrame | Asked) -> DataFrame:
    asked = ask(keys)
    emp = asked.pruned(cat.emp.select("cnpj_basico", *COMPANY_FIELDS))
    return emp.join(asked._small(company_keys(matched_sites(cat, asked))), "cnpj_basico", "left_semi").distinct()


def _first_row_order(cols: list[str]) -> Column:
    # ascending, NULLs last, column by column
    return F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in cols])


def simples_status(cat: Catalog, keys: DataFrame | Asked) -> DataFrame:
    """One tax-regime row per found company, flags defaulting to ``'N'``.
    With several rows for a company the first in (fields ascending, NULLs last) order is used;
    picking it is an aggregate, so it is combined map-side before the shuffle."""
    cat.require("simples")
    asked = ask(keys)
    return _regime(asked.of_companies(cat.sim).join(found_companies(cat, asked), "cnpj_basico", "left_semi"))


def _regime(sim: DataFrame) -> DataFrame:
    first = (sim.groupBy("cnpj_basico")
             .agg(F.min_by(F.struct(*SIMPLES_FIELDS), _first_row_order(SIMPLES_FIELDS)).alias("s")))
    return first.select(
        "cnpj_basico",
        C.flag("s.opcao_simples").alias("opcao_simples"),
        F.col("s.data_opcao_simples").alias("data_opcao_simples"),
        F.col("s.data_exclusao_simples").alias("data_exclusao_simples"),
        C.flag("s.opcao_mei").alias("opcao_mei"),
        F.col("s.data_opcao_mei").alias("data_opcao_mei"),
        F.col("s.data_exclusao_mei").alias("data_exclusao_mei"),
    )


FOUND, NOT_FOUND, MALFORMED = "found", "not found", "malformed"
REPORT_FIELDS = [*COMPANY_FIELDS, "opcao_simples", "opcao_mei", *[c for c in SIMPLES_FIELDS if c.startswith("data_")]]


def _companies_with_regime(cat: Catalog, asked: Asked) -> DataFrame:
    """(cnpj_basico, REPORT_FIELDS): distinct rows of the requested companies, whether or not a site is found."""
    rows = asked.of_companies(cat.emp.select("cnpj_basico", *COMPANY_FIELDS)).distinct()
    if cat.has("simples"):
        rows = rows.join(_regime(asked.of_companies(cat.sim)), "cnpj_basico", "left")
        flags = [C.flag(c).alias(c) for c in ("opcao_simples", "opcao_mei")]
    else:
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in SIMPLES_FIELDS})
        flags = ["opcao_simples", "opcao_mei"]
    return rows.select("cnpj_basico", *COMPANY_FIELDS, *flags, *REPORT_FIELDS[len(COMPANY_FIELDS) + 2:])


def cnpj_report(cat: Catalog, req: DataFrame, col: str = "cnpj_input", keys: Asked | None = None) -> DataFrame:
    """One row per distinct request: ``status`` says whether it was found (then with the company's data,
    one row per distinct company row), is in no site table, or is no CNPJ (``cnpj`` is then the
    request as given)."""
    requests = normalize_requests(req, col)
    asked = keys or ask(requests.where("tamanho_ok"))
    there = asked._small(asked.pruned(cat.est.select(*KEY3)).join(asked.sites, KEY3, "left_semi").distinct())
    companies = _companies_with_regime(cat, asked).withColumns({"_company": F.lit(True), "_key": F.col("cnpj_basico")})
    # a site without a company row is not found, nor is a company row without the requested site
    rows = (asked.rows.join(there.withColumn("_site", F.lit(True)), KEY3, "left")
            .join(companies.drop("cnpj_basico"), (F.col("cnpj_basico") == F.col("_key")) & F.col("_site"), "left"))
    status = F.when(F.col("_company"), F.lit(FOUND)).otherwise(F.lit(NOT_FOUND)).alias("status")
    answers = rows.select(cnpj_mask("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj"), status, "dv_valido", *REPORT_FIELDS)
    bad = (requests.where("NOT coalesce(tamanho_ok, false)").select(F.col(col).alias("cnpj")).distinct()
           .select("cnpj", F.lit(MALFORMED).alias("status"), F.lit(False).alias("dv_valido")))
    return answers.unionByName(bad, allowMissingColumns=True)


def _or_blank(c: str) -> Column:
    return C.blank(c)


def site_order() -> list:
    return [C.try_int("identificador_matriz_filial"), "data_inicio_atividade", "cnpj"]


PARTNER_ORDER = ["nome_socio_ou_razao_social", "cnpj_basico", "cnpj_cpf_socio"]


def sites_of(cat: Catalog, keys: DataFrame | Asked, sort: bool = True) -> DataFrame:
    out = _shown_sites(cat, found_sites(cat, keys)).drop("cnpj_basico")
    return order_nulls_last(out, site_order()) if sort else out


def _shown_sites(cat: Catalog, sites: DataFrame) -> DataFrame:
    has_mun = cat.has("municipios")
    if has_mun:
        sites = lookup_join(sites, cat.mun, "municipio", "left", prefix="mun")
    mun_name = F.col("mun_descricao") if has_mun else F.lit(None).cast("string")
    b = _or_blank
    return sites.select(
        "cnpj_basico", cnpj_mask("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj"),
        C.site_kind_label("identificador_matriz_filial").alias("tipo"),
        "identificador_matriz_filial", "nome_fantasia", "cnae_fiscal_principal", "cnae_fiscal_secundaria",
        "data_inicio_atividade", "situacao_cadastral",
        F.concat(b("tipo_logradouro"), F.lit(" "), b("logradouro"), F.lit(", "), b("numero"), F.lit(" "),
                 b("complemento"), F.lit(" - "), b("bairro")).alias("endereco"),
        F.concat(b("cep"), F.lit(" / "), b("uf"), F.lit(" / "),
                 F.coalesce(F.nullif(mun_name, F.lit("")), F.nullif(F.col("municipio"), F.lit("")),
                            F.lit(""))).alias("local"),
        F.concat(F.lit("tel1="), b("ddd_1"), b("telefone_1"), F.lit(" tel2="), b("ddd_2"), b("telefone_2"),
                 F.lit(" fax="), b("ddd_fax"), b("fax"), F.lit(" email="),
                 b("correio_eletronico")).alias("contatos"),
    )


def _py_text(c: str) -> Column:
    """Text as a Python f-string prints it (a missing value prints as ``None``)."""
    return F.coalesce(F.col(c), F.lit("None"))


def partners_of(cat: Catalog, keys: DataFrame | Asked, sort: bool = True) -> DataFrame:
    cat.require("socios")
    asked = ask(keys)
    # the filter on requested companies comes first, beside the scan
    soc = asked.of_companies(cat.soc).join(found_companies(cat, asked), "cnpj_basico", "left_semi")
    out = soc.select(
        "cnpj_basico", "identificador_socio", "nome_socio_ou_razao_social", "cnpj_cpf_socio",
        "qualificacao_socio", "data_entrada_sociedade", "pais", "faixa_etaria",
        F.concat(_py_text("representante_legal"), F.lit(" - "), _py_text("nome_representante"),
                 F.lit(" ("), _py_text("qualificacao_representante_legal"), F.lit(")")).alias("representante"),
    )
    return order_nulls_last(out, PARTNER_ORDER) if sort else out


#: rows of one nested array
PAGE_ROWS = 1000


def nested_report(cat: Catalog, keys: DataFrame | Asked, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Found companies with their found sites and their partners as nested arrays.

    One row per distinct company row and page: the company's fields, ``page`` (from 1), ``sites`` and ``partners``,
    each an array of structs in the report's order with at most ``page_rows`` entries. Page ``p`` holds the
    ``p``-th stretch of both lists; the shorter one is empty on further pages. Companies without partners
    have page 1 only for their sites.
    """
    asked = ask(keys)
    sites = pages(_shown_sites(cat, found_sites(cat, asked)), "cnpj_basico", site_order(), "sites", page_rows)
    if cat.has("socios"):
        partners = pages(partners_of(cat, asked, sort=False), "cnpj_basico", PARTNER_ORDER, "partners", page_rows)
        both = sites.join(partners, ["cnpj_basico", "page"], "full")
    else:
        both = sites.withColumn("partners", F.lit(None).cast("array<struct<identificador_socio:string>>"))
    companies = _companies_with_regime(cat, asked)
    empty = lambda c: F.coalesce(c, F.array().cast(both.schema[c].dataType)).alias(c)
    return (companies.join(both, "cnpj_basico")
            .select("cnpj_basico", "page", *REPORT_FIELDS, empty("sites"), empty("partners")))


def site_requests(cat: Catalog) -> DataFrame:
    """Requests as users type them: every site's CNPJ in display form, plus the partners'
    (masked, hence malformed) documents."""
    from ..functions.identity import cnpj_format
    a = cat.est.select(cnpj_format(cnpj_key()).alias("cnpj_input"))
    if cat.has("socios"):
        a = a.unionByName(cat.soc.select(F.col("cnpj_cpf_socio").alias("cnpj_input")))
    return a
