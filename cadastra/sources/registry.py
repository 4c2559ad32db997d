"""Registry tables derived from the driver's TPC-H-style tables.

The driver ships ``customer``, ``orders``, ``supplier``, ``nation`` and ``part`` as Parquet. Each
registry base is a projection of one of them (see FIXTURES.md §5). The projection is kept as a list
of SQL expressions that both Spark and DuckDB evaluate identically, so the Spark side builds the
base with ``selectExpr`` over the Parquet scan (column pruning and pushdown still apply) and the
DuckDB oracle gets the very same text as a ``WITH`` prelude.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ViewSpec:
    source: str                      # driver table, read whole
    columns: tuple[tuple[str, str], ...]  # (alias, SQL expression)

    def select_exprs(self) -> list[str]:
        return [f"{expr} AS {alias}" for alias, expr in self.columns]

    def sql(self) -> str:
        body = ",\n  ".join(self.select_exprs())
        return f"SELECT\n  {body}\nFROM {self.source}"


_KEY8 = "lpad(CAST(c_custkey AS STRING),8,'0')"

VIEWS: dict[str, ViewSpec] = {
    "empresas": ViewSpec("customer", (
        ("cnpj_basico", _KEY8),
        ("razao_social",
         "CASE WHEN c_custkey % 7 = 0 THEN lpad(CAST(c_custkey AS STRING),8,'0') || ' ' || c_mktsegment"
         " || ' ' || CAST(c_custkey % 97 AS STRING) || ' ME'"
         " WHEN c_custkey % 7 = 1 THEN c_mktsegment || ' DA  SILVA ' || lpad(CAST(c_custkey AS STRING),11,'0')"
         " WHEN c_custkey % 7 = 2 THEN '- ' || c_name || ' -'"
         " WHEN c_custkey % 7 = 3 THEN '12.345.678/0001-95 ' || c_name ELSE c_name END"),
        ("natureza_juridica", "CASE WHEN c_nationkey % 2 = 0 THEN '2135' ELSE '2062' END"),
        ("qualificacao_responsavel", "lpad(CAST(c_nationkey AS STRING),2,'0')"),
        ("capital_social_empresa", "CAST(c_custkey * 1000 AS STRING) || ',00'"),
        ("porte_empresa",
         "CASE WHEN c_custkey % 11 = 0 THEN CAST(NULL AS STRING) WHEN c_custkey % 4 = 0 THEN '00'"
         " WHEN c_custkey % 4 = 1 THEN '01' WHEN c_custkey % 4 = 2 THEN '03' ELSE '05' END"),
        ("ente_federativo_responsavel", "CAST(NULL AS STRING)"),
    )),
    "estabelecimentos": ViewSpec("orders", (
        ("cnpj_basico", "lpad(CAST(o_custkey AS STRING),8,'0')"),
        ("cnpj_ordem", "lpad(CAST(o_orderkey % 50 AS STRING),4,'0')"),
        ("cnpj_dv", "lpad(CAST(o_orderkey % 11 AS STRING),2,'0')"),
        ("identificador_matriz_filial", "CASE WHEN o_orderkey % 3 = 0 THEN '2' ELSE '1' END"),
        ("nome_fantasia",
         "CASE WHEN o_orderkey % 5 = 0 THEN CAST(NULL AS STRING) ELSE 'LOJA ' || CAST(o_orderkey AS STRING) END"),
        ("situacao_cadastral",
         "CASE WHEN o_orderkey % 7 = 0 THEN '01' WHEN o_orderkey % 7 = 1 THEN '2' WHEN o_orderkey % 7 = 2 THEN '02'"
         " WHEN o_orderkey % 7 = 3 THEN '03' WHEN o_orderkey % 7 = 4 THEN '04' WHEN o_orderkey % 7 = 5 THEN '08'"
         " ELSE 'ativa' END"),
        ("data_situacao_cadastral",
         "CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 AS STRING)"),
        ("motivo_situacao_cadastral", "lpad(CAST(o_orderkey % 60 AS STRING),2,'0')"),
        ("nome_cidade_exterior", "CASE WHEN o_orderkey % 101 = 0 THEN 'LISBOA' ELSE CAST(NULL AS STRING) END"),
        ("pais", "CASE WHEN o_orderkey % 101 = 0 THEN '607' ELSE CAST(NULL AS STRING) END"),
        ("data_inicio_atividade",
         "CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS STRING)"),
        ("cnae_fiscal_principal",
         "CASE WHEN o_orderkey % 13 = 0 THEN CAST(NULL AS STRING)"
         " WHEN o_orderkey % 9 <= 1 THEN lpad(CAST((192 + o_custkey % 2) * 45000 AS STRING),7,'0')"
         " ELSE lpad(CAST((o_orderkey % 200 + 1) * 45000 AS STRING),7,'0') END"),
        ("cnae_fiscal_secundaria",
         "CASE WHEN o_orderkey % 2 = 0 THEN '6202300,8640202' ELSE CAST(NULL AS STRING) END"),
        ("tipo_logradouro", "'RUA'"),
        ("logradouro", "o_orderpriority"),
        ("numero", "CAST(o_orderkey % 1000 AS STRING)"),
        ("complemento", "CASE WHEN o_orderkey % 4 = 0 THEN 'SALA;1' ELSE CAST(NULL AS STRING) END"),
        ("bairro", "'CENTRO'"),
        ("cep", "lpad(CAST(38400000 + o_orderkey % 1000 AS STRING),8,'0')"),
        ("uf",
         "CASE WHEN o_orderkey % 4 = 0 THEN 'MG' WHEN o_orderkey % 4 = 1 THEN 'mg'"
         " WHEN o_orderkey % 4 = 2 THEN 'SP' ELSE 'RJ' END"),
        ("municipio",
         "CASE WHEN o_custkey % 3 = 0 THEN '5403' WHEN o_orderkey % 17 = 0 THEN '9999'"
         " ELSE lpad(CAST(5400 + o_orderkey % 25 AS STRING),5,'0') END"),
        ("ddd_1", "CASE WHEN o_orderkey % 6 = 0 THEN CAST(NULL AS STRING) ELSE '34' END"),
        ("telefone_1", "CASE WHEN o_orderkey % 6 = 1 THEN CAST(NULL AS STRING) ELSE CAST(30000000 + o_orderkey AS STRING) END"),
        ("ddd_2", "CAST(NULL AS STRING)"),
        ("telefone_2", "CAST(NULL AS STRING)"),
        ("ddd_fax", "CAST(NULL AS STRING)"),
        ("fax", "CAST(NULL AS STRING)"),
        ("correio_eletronico", "'c' || CAST(o_custkey AS STRING) || '@example.com'"),
        ("situacao_especial", "CASE WHEN o_orderkey % 211 = 0 THEN 'FALIDO' ELSE CAST(NULL AS STRING) END"),
        ("data_situacao_especial", "CASE WHEN o_orderkey % 211 = 0 THEN '20200101' ELSE CAST(NULL AS STRING) END"),
    )),
    "simples": ViewSpec("customer", (
        # every eighth row belongs to a company that is in no other table: that many companies have no row
        ("cnpj_basico", f"CASE WHEN c_custkey % 8 = 7 THEN CAST(c_custkey + 50000000 AS STRING) ELSE {_KEY8} END"),
        ("opcao_simples",
         "CASE WHEN c_custkey % 5 = 0 THEN CAST(NULL AS STRING) WHEN c_custkey % 2 = 0 THEN 'S' ELSE 'N' END"),
        ("data_opcao_simples", "'20070701'"),
        ("data_exclusao_simples", "'00000000'"),
        ("opcao_mei",
         "CASE WHEN c_custkey % 5 = 1 THEN CAST(NULL AS STRING) WHEN c_custkey % 5 = 2 THEN 's'"
         " WHEN c_custkey % 5 = 3 THEN 'S' ELSE 'N' END"),
        ("data_opcao_mei", "'20090701'"),
        ("data_exclusao_mei", "'00000000'"),
    )),
    "municipios": ViewSpec("nation", (
        ("codigo", "CAST(5400 + n_nationkey AS STRING)"),
        ("descricao", "CASE WHEN n_nationkey = 3 THEN 'UBERLANDIA' ELSE n_name END"),
    )),
    "cnaes": ViewSpec("part", (
        # one code per part: seven digits, more where the number needs them
        ("codigo", "CASE WHEN p_partkey < 223 THEN lpad(CAST(p_partkey * 45000 AS STRING),7,'0')"
                   " ELSE CAST(p_partkey * 45000 AS STRING) END"),
        ("descricao",
         "CASE WHEN p_partkey % 3 = 0 THEN 'Clínica ' || p_name WHEN p_partkey % 3 = 2 THEN 'Clinica ' || p_name"
         " ELSE p_name END"),
    )),
    "socios": ViewSpec("supplier", (
        ("cnpj_basico", "lpad(CAST(s_suppkey AS STRING),8,'0')"),
        ("identificador_socio", "CASE WHEN s_suppkey % 2 = 0 THEN '2' ELSE '1' END"),
        ("nome_socio_ou_razao_social", "'***' || s_name || ' 12345678909'"),
        ("cnpj_cpf_socio", "'***' || lpad(CAST(s_suppkey AS STRING),6,'0') || '**'"),
        ("qualificacao_socio", "'49'"),
        ("data_entrada_sociedade", "'20100101'"),
        ("pais", "CAST(NULL AS STRING)"),
        ("representante_legal", "'00000000000'"),
        ("nome_representante", "CAST(NULL AS STRING)"),
        ("qualificacao_representante_legal", "'00'"),
        ("faixa_etaria", "CAST(s_suppkey % 9 AS STRING)"),
    )),
}

def _utc_wall_clock(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Timestamps read as session-zone instants become their UTC wall-clock time (NTZ), so date
    parts do not depend on the session time zone (they already are NTZ by default)."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    fixes = {f.name: F.to_utc_timestamp(F.col(f.name), tz).cast("timestamp_ntz")
             for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(fixes) if fixes else df


def registry_view(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """One registry base as a DataFrame over the driver's Parquet table."""
    spec = VIEWS[base]
    df = _utc_wall_clock(spark, spark.read.parquet(f"{sf_dir.rstrip('/')}/{spec.source}.parquet"))
    return df.selectExpr(*spec.select_exprs())


def registry_views(spark: SparkSession, sf_dir: str, bases=None) -> dict[str, DataFrame]:
    return {b: registry_view(spark, sf_dir, b) for b in (bases or VIEWS)}


def oracle_prelude(bases=None) -> str:
    """``WITH`` clause defining the registry bases for DuckDB (driver tables are views there)."""
    parts = [f"{b} AS (\n{VIEWS[b].sql()}\n)" for b in (bases or VIEWS)]
    return "WITH " + ",\n".join(parts) + "\n"
