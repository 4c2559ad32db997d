"""Registered source and sink round trips: Parquet parts, describe, raw dumps (clean, bad rows,
NULL tokens, latin1), header and base detection, links and manifests, CSV export, rename,
zip archives, the ingest stream, column naming and dataset-level cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ._registry import register
from ..functions.text import clean_name_sql, fold_accents, fold_sql
from ..plans.leads import LeadFilter, leads
from ..session import scratch_path
from ..sources import archives as ZIP, dumps as D, links as L
from ..sources.catalog import describe, load_catalog
from ..sources.export import export_csv, read_export
from ..sources.ingest import ingest_directory, profile_sources
from ..sources.parquet_io import clean_dataset, rename_dataset, write_parquet, write_parts
from ..sources.registry import VIEWS, registry_views
from ..sources.schema import CLEAN_BASE_RULES, COLUMNS, INGEST_BASE_RULES, NA_TOKENS, RENAME_BASE_RULES, detect_base
from ..sources.snapshot import ingest_folder, read_snapshot
from ..streaming.ingest_stream import run_folder_stream, run_ingest_stream
from .common import LEAD_OUTPUT, PORTE_35, _cat, _registry_cols, lead_sql


# ---------------------------------------------------------------------------------------------
# sources and sinks: every round trip writes under the shared checkpoint folder and reads back
# ---------------------------------------------------------------------------------------------

TOKENS_SQL = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)


def _tok(expr: str) -> str:
    return f"CASE WHEN {expr} IN ({TOKENS_SQL}) THEN NULL ELSE {expr} END"


def _full(df, base):
    """All dictionary columns of ``base`` in file order (absent ones as NULL)."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in COLUMNS[base]])


def _full_sql(base: str, view: str, override: dict | None = None) -> str:
    have = {c for c, _ in VIEWS[view].columns}
    override = override or {}
    cols = []
    for c in COLUMNS[base]:
        if c in override:
            cols.append(f"{override[c]} AS {c}")
        elif c in have:
            cols.append(f"{_tok(c)} AS {c}")
        else:
            cols.append(f"CAST(NULL AS VARCHAR) AS {c}")
    return ", ".join(cols)


@register("scan_union_parts", "SELECT * FROM estabelecimentos")
def q_scan_union_parts(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    root = scratch_path(spark, "parts")
    write_parts(_registry_cols(cat.est, "estabelecimentos"), root, "estabelecimentos", 3, "cnpj_basico")
    write_parts(cat.emp, root, "empresas", 2, "cnpj_basico")
    return load_catalog(spark, root, bases=("empresas", "estabelecimentos")).est


@register("parquet_roundtrip", "SELECT * FROM empresas")
def q_parquet_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "parquet")
    write_parquet(registry_views(spark, sf_dir, ["empresas"])["empresas"], f"{root}/Empresas.parquet")
    return spark.read.parquet(f"{root}/Empresas.parquet")


@register("describe_tables", " UNION ALL ".join(
    f"SELECT '{b}' AS base, column_name, column_type FROM (DESCRIBE SELECT * FROM {b})"
    for b in ("empresas", "estabelecimentos", "simples", "municipios")))
def q_describe_tables(spark, sf_dir):
    views = registry_views(spark, sf_dir, ["empresas", "estabelecimentos", "simples", "municipios"])
    return describe(spark, views, "empresas|estabelecimentos| simples |municipios").drop("ordinal")


@register("ingest_csv_roundtrip",
          f"SELECT {_full_sql('estabelecimentos', 'estabelecimentos')} FROM estabelecimentos")
def q_ingest_csv_roundtrip(spark, sf_dir):
    est = _full(_cat(spark, sf_dir).est, "estabelecimentos")
    root = scratch_path(spark, "ingest")
    D.write_dump(est, f"{root}/src/Estabelecimentos")
    out = ingest_directory(spark, f"{root}/src", f"{root}/out")
    return spark.read.parquet(out["estabelecimentos"])


@register("ingest_latin1_lookup", f"SELECT {_tok('codigo')} AS codigo, {_tok('descricao')} AS descricao FROM cnaes")
def q_ingest_latin1_lookup(spark, sf_dir):
    root = scratch_path(spark, "ingest-cnaes")
    D.write_dump(_cat(spark, sf_dir).cnae, f"{root}/src/Cnaes")
    out = ingest_directory(spark, f"{root}/src", f"{root}/out")
    return spark.read.parquet(out["cnaes"])


# Damage rules of the bad-row fixture, keyed by the site's check digits:
#   '00' one extra field (or 5,000), '10' one extra empty field (both dropped), '01' only the first 25
#   fields (padded with NULL), '03' a quoted newline and doubled quotes inside a field.
BAD_NEWLINE_SQL = "CASE WHEN cnpj_dv = '03' THEN nome_fantasia || chr(10) || 'say \"hi\"' ELSE nome_fantasia END"


@register("ingest_bad_rows", "SELECT " + ", ".join(
    (f"CASE WHEN cnpj_dv = '01' THEN NULL ELSE {e} END AS {c}" if i >= 25 else f"{e} AS {c}")
    for i, (c, e) in enumerate(
        (c, (_tok(BAD_NEWLINE_SQL) if c == "nome_fantasia" else
             (_tok(c) if c in {x for x, _ in VIEWS['estabelecimentos'].columns} else "CAST(NULL AS VARCHAR)")))
        for c in COLUMNS["estabelecimentos"]))
    + " FROM estabelecimentos WHERE cnpj_dv NOT IN ('00', '10')")
def q_ingest_bad_rows(spark, sf_dir):
    est = _full(_cat(spark, sf_dir).est, "estabelecimentos")
    dv = F.col("cnpj_dv")
    est = est.withColumn("nome_fantasia", F.when(dv == "03", F.concat("nome_fantasia", F.lit('\nsay "hi"')))
                         .otherwise(F.col("nome_fantasia")))
    cols = COLUMNS["estabelecimentos"]
    full, short = D.render_lines(est, cols), D.render_lines(est, cols[:25])
    line = (F.when((dv == "00") & F.col("cnpj_basico").endswith("00"), F.concat(full, F.repeat(F.lit(';"extra"'), F.lit(5000))))
            .when(dv == "00", F.concat(full, F.lit(';"extra"')))
            .when(dv == "10", F.concat(full, F.lit(';""')))
            .when(dv == "01", short).otherwise(full))
    path = scratch_path(spark, "bad-rows") + "/Estabelecimentos"
    D.write_lines(est.select(line.alias("value")), path)
    return D.read_base_dump(spark, path, "estabelecimentos")


# every field of most rows holds a newline, a delimiter or quotes, so most blocks begin inside a record
SPLIT_BYTES = 1 << 17
SPLIT_COLUMNS = {"logradouro": "logradouro || chr(10) || chr(10) || ';' || COALESCE(bairro, '')",
                 "nome_fantasia": "'\"' || nome_fantasia || '\"' || chr(10) || cnpj_dv",
                 "correio_eletronico": "CASE WHEN cnpj_dv > '40' THEN repeat(correio_eletronico || chr(10), 20) ELSE correio_eletronico END"}


@register("ingest_multiline_split", "SELECT " + ", ".join(
    f"{_tok(SPLIT_COLUMNS.get(c, c))} AS {c}" if c in {x for x, _ in VIEWS["estabelecimentos"].columns} else f"CAST(NULL AS VARCHAR) AS {c}"
    for c in COLUMNS["estabelecimentos"]) + " FROM estabelecimentos")
def q_ingest_multiline_split(spark, sf_dir):
    est = _full(_cat(spark, sf_dir).est, "estabelecimentos")
    est = est.withColumns({c: F.expr(e.replace("chr(10)", "char(10)")) for c, e in SPLIT_COLUMNS.items()})
    path = scratch_path(spark, "multiline") + "/Estabelecimentos"
    D.write_dump(est, path)
    return D.read_base_dump(spark, path, "estabelecimentos", multiline="split", block_bytes=SPLIT_BYTES)


# NULL-token fixture: one token per check-digit value ('07' uses 'none', which is not a token).
NULL_TOKEN_RULES = {"02": ("bairro", "NA"), "03": ("logradouro", "NULL"), "04": ("complemento", "nan"),
                    "05": ("nome_fantasia", "None"), "06": ("correio_eletronico", "n/a"),
                    "07": ("bairro", "none"), "08": ("tipo_logradouro", "#N/A"), "09": ("cep", "")}


def _token_override_sql() -> dict:
    by_col: dict[str, list] = {}
    for dv, (c, tok) in NULL_TOKEN_RULES.items():
        by_col.setdefault(c, []).append((dv, tok))
    out = {}
    for c, rules in by_col.items():
        whens = " ".join(f"WHEN cnpj_dv = '{dv}' THEN '{tok}'" for dv, tok in rules)
        out[c] = _tok(f"(CASE {whens} ELSE {c} END)")
    return out


@register("ingest_null_tokens",
          f"SELECT {_full_sql('estabelecimentos', 'estabelecimentos', _token_override_sql())} FROM estabelecimentos")
def q_ingest_null_tokens(spark, sf_dir):
    est = _full(_cat(spark, sf_dir).est, "estabelecimentos")
    for dv, (c, tok) in NULL_TOKEN_RULES.items():
        est = est.withColumn(c, F.when(F.col("cnpj_dv") == dv, F.lit(tok)).otherwise(F.col(c)))
    path = scratch_path(spark, "null-tokens") + "/Estabelecimentos"
    D.write_lines(est.select(D.render_lines(est, COLUMNS["estabelecimentos"]).alias("value")), path)
    return D.read_base_dump(spark, path, "estabelecimentos")


@register("detect_header", """
SELECT * FROM (VALUES ('estabelecimentos', true), ('socios', true), ('municipios', false)) AS t(base, has_header)""")
def q_detect_header(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    root = scratch_path(spark, "headers")
    D.write_dump(_full(cat.est, "estabelecimentos"), f"{root}/Estabelecimentos")  # text fields hold letters
    D.write_dump(cat.soc, f"{root}/Socios", header=True)
    D.write_dump(cat.mun.select("codigo", F.col("codigo").alias("descricao")), f"{root}/Municipios")  # digits only
    return profile_sources(spark, root).where("first_record <> ''").select("base", "has_header").distinct()


# links in the driver's web pages (every href; the zip-only pattern is the default elsewhere)
def _links(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return L.extract_links(pages, suffix="")


ORIGIN_SQL = r"regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1)"
SCHEME_SQL = r"regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1)"
DIR_SQL = r"regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^?#]*/)', 1)"


def _base_case_sql(expr: str, rules) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({expr}), '{k}')" for k in keys) + f" THEN '{base}'"
        for base, keys in rules)
    return f"CASE {whens} ELSE '' END"


LINKS_CTE = f""",
hrefs AS (SELECT url, unnest(regexp_extract_all(html, '(?i)href="([^"]+)"', 1)) AS href FROM pages),
resolved AS (
  SELECT DISTINCT CASE
    WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN href
    WHEN starts_with(href, '//') THEN {SCHEME_SQL} || ':' || href
    WHEN starts_with(href, '/') THEN {ORIGIN_SQL} || href
    ELSE CASE WHEN {DIR_SQL} <> '' THEN {DIR_SQL} ELSE {ORIGIN_SQL} || '/' END || href END AS link
  FROM hrefs
),
links AS (
  SELECT link, regexp_extract(link, '([^/?#]*)(?:[?#].*)?$', 1) AS file_name FROM resolved
)
"""


@register("extract_links", LINKS_CTE + f"""
SELECT link, file_name, {_base_case_sql('file_name', INGEST_BASE_RULES)} AS base FROM links ORDER BY link""")
def q_extract_links(spark, sf_dir):
    return _links(spark, sf_dir)


@register("detect_base", LINKS_CTE + f"""
SELECT file_name,
  {_base_case_sql('file_name', INGEST_BASE_RULES)} AS base_ingest,
  {_base_case_sql('lower(' + fold_sql("regexp_replace(file_name, '\\.[^.]*$', '')") + ')', RENAME_BASE_RULES)} AS base_rename,
  {_base_case_sql('file_name', CLEAN_BASE_RULES)} AS base_clean
FROM links""")
def q_detect_base(spark, sf_dir):
    links = _links(spark, sf_dir)
    # folded stem projected once; the keyword tests read it repeatedly
    links = links.select("file_name", F.lower(fold_accents(F.regexp_replace("file_name", r"\.[^.]*$", "")))
                         .alias("_stem"))
    return links.select(
        "file_name",
        detect_base(F.col("file_name"), INGEST_BASE_RULES).alias("base_ingest"),
        detect_base(F.col("_stem"), RENAME_BASE_RULES).alias("base_rename"),
        detect_base(F.col("file_name"), CLEAN_BASE_RULES).alias("base_clean"))


SOURCE_PATTERN = "/(de|the)"


@register("select_sources", LINKS_CTE + f"""
SELECT link, file_name, {_base_case_sql('file_name', INGEST_BASE_RULES)} AS base FROM links
WHERE regexp_matches(link, '(?i){SOURCE_PATTERN}') ORDER BY link LIMIT 50""")
def q_select_sources(spark, sf_dir):
    return L.select_sources(_links(spark, sf_dir), SOURCE_PATTERN, 50)


@register("pending_sources", LINKS_CTE + f"""
SELECT link, file_name, {_base_case_sql('file_name', INGEST_BASE_RULES)} AS base FROM links
WHERE link NOT IN (SELECT link FROM links WHERE regexp_matches(link, '(?i){SOURCE_PATTERN}') ORDER BY link LIMIT 50)
ORDER BY link""")
def q_pending_sources(spark, sf_dir):
    links = _links(spark, sf_dir)
    # an earlier run ingested the first 50 matching sources and recorded them in its manifest
    manifest = scratch_path(spark, "manifest")
    L.select_sources(links, SOURCE_PATTERN, 50).select("link").write.parquet(manifest)
    return L.pending_sources(links, spark.read.parquet(manifest), key="link")


EXPORTED = "SELECT " + ", ".join(
    f"NULLIF({c}, '') AS {c}" for c in LEAD_OUTPUT) + f""" FROM ({lead_sql(f"UPPER(est.uf) = 'MG' AND {PORTE_35}")})"""


@register("export_csv_roundtrip", EXPORTED)
def q_export_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "export")
    export_csv(leads(_cat(spark, sf_dir), LeadFilter(uf="MG")), path)
    return read_export(spark, path)


@register("export_one_file", EXPORTED)
def q_export_one_file(spark, sf_dir):
    path = scratch_path(spark, "export-one")
    export_csv(leads(_cat(spark, sf_dir), LeadFilter(uf="MG")), path, single_file=True, sort_by=["cnpj"])
    return read_export(spark, path)


@register("rename_dataset", "SELECT * FROM socios")
def q_rename_dataset(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    root = scratch_path(spark, "rename")
    raw = cat.soc.toDF(*[f"_c{i}" for i in range(len(cat.soc.columns))])  # as a headerless CSV reads
    write_parquet(raw, f"{root}/src/Socios.parquet")
    write_parquet(cat.emp, f"{root}/src/Empresas.parquet")
    out = rename_dataset(spark, [f"{root}/src/Socios.parquet", f"{root}/src/Empresas.parquet"], f"{root}/dst")
    return spark.read.parquet(out["Socios.parquet"])


def _zip_fixture(spark, sf_dir):
    root = scratch_path(spark, "zips")
    D.write_dump(_cat(spark, sf_dir).cnae, f"{root}/csv/Cnaes")
    files = D.list_files(spark, f"{root}/csv", "*.csv")
    archives = ZIP.pack_files(files, f"{root}/zip", "F.K03200$Z.D50712.CNAECSV").select(F.col("archive").alias("path"))
    return root, archives


# every line is two quoted fields, a separator and a newline; latin1 takes a byte a character
@register("zip_members", """
SELECT 'F.K03200$Z.D50712.CNAECSV' AS member, CAST(sum(length(codigo) + length(descricao) + 6) AS BIGINT) AS member_bytes
FROM cnaes""")
def q_zip_members(spark, sf_dir):
    root, archives = _zip_fixture(spark, sf_dir)
    archives.write.parquet(f"{root}/archives")
    members = ZIP.zip_members(spark.read.parquet(f"{root}/archives"))
    return members.groupBy("member").agg(F.sum("member_bytes").alias("member_bytes"))


@register("ingest_zip_roundtrip", f"SELECT {_tok('codigo')} AS codigo, {_tok('descricao')} AS descricao FROM cnaes")
def q_ingest_zip_roundtrip(spark, sf_dir):
    root, archives = _zip_fixture(spark, sf_dir)
    landed = ZIP.extract_members(archives, f"{root}/landed")
    landed.write.parquet(f"{root}/landed-manifest")  # runs the extraction once
    return D.read_base_dump(spark, f"{root}/landed/*/*.csv", "cnaes")


@register("ingest_stream",
          f"SELECT {_full_sql('estabelecimentos', 'estabelecimentos')} FROM estabelecimentos")
def q_ingest_stream(spark, sf_dir):
    root = scratch_path(spark, "stream")
    D.write_dump(_full(_cat(spark, sf_dir).est, "estabelecimentos"), f"{root}/src")
    run_ingest_stream(spark, f"{root}/src", f"{root}/out", f"{root}/checkpoint", "estabelecimentos")
    return spark.read.schema(_full(_cat(spark, sf_dir).est, "estabelecimentos").schema).parquet(f"{root}/out")


# the companies as dumps of different make beside each other: two widths and two header orders under
# names that no rule knows, one whose first record holds a newline, one that is empty (reported, not fatal)
PARTS_SQL = "CAST(cnpj_basico AS BIGINT) % 4"


@register("ingest_mixed_files", f"""
SELECT kind, count(*) AS n_rows, count(DISTINCT a) AS keys, CAST(sum(length(b)) AS BIGINT) AS chars FROM (
  SELECT CASE {PARTS_SQL} WHEN 0 THEN 'width 2' WHEN 1 THEN 'width 3' WHEN 2 THEN 'key first' ELSE 'key last' END AS kind,
         {_tok('cnpj_basico')} AS a, CASE WHEN {PARTS_SQL} < 2 THEN {_tok("regexp_replace(natureza_juridica, '[^0-9]', '', 'g')")}
                                         ELSE {_tok('razao_social')} END AS b
  FROM empresas
  UNION ALL SELECT 'newline', {_tok('codigo')}, {_tok("descricao || chr(10) || 'x'")} FROM municipios) GROUP BY kind""")
def q_ingest_mixed_files(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    root = scratch_path(spark, "mixed")
    part = F.col("cnpj_basico").cast("long") % 4
    plain = cat.emp.select("cnpj_basico", F.regexp_replace("natureza_juridica", "[^0-9]", "").alias("n"), "razao_social")
    D.write_dump(plain.where(part == 0).select("cnpj_basico", "n"), f"{root}/src/w2")
    D.write_dump(plain.where(part == 1).select("cnpj_basico", "n", F.lit("7").alias("x")), f"{root}/src/w3")
    D.write_dump(plain.where(part == 2).select("cnpj_basico", F.col("razao_social").alias("nome")), f"{root}/src/h1", header=True)
    D.write_dump(plain.where(part == 3).select(F.col("razao_social").alias("nome"), "cnpj_basico"), f"{root}/src/h2", header=True)
    D.write_dump(cat.mun.select("codigo", F.concat("descricao", F.lit("\nx")).alias("d")), f"{root}/src/Municipios")
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{root}/src/vazio")
    ingest_directory(spark, f"{root}/src", f"{root}/out", errors=[])
    unknown = spark.read.option("mergeSchema", "true").parquet(f"{root}/out/Desconhecido-*.parquet")
    first = F.coalesce("cnpj_basico", "col_00")
    kind = (F.when(F.col("col_02").isNotNull(), "width 3").when(F.col("col_00").isNotNull(), "width 2")
            .when(F.col("cnpj_basico").cast("long") % 4 == 2, "key first").otherwise("key last"))
    rows = unknown.select(kind.alias("kind"), first.alias("a"), F.coalesce("nome", "col_01").alias("b")).unionByName(
        spark.read.parquet(f"{root}/out/Municipios-*.parquet").select(F.lit("newline").alias("kind"),
                                                                     F.col("codigo").alias("a"), F.col("descricao").alias("b")))
    return rows.groupBy("kind").agg(F.count("*").alias("n_rows"), F.count_distinct("a").alias("keys"),
                                    F.sum(F.length("b")).alias("chars"))


# ---------------------------------------------------------------------------------------------
# column naming of unknown dumps, dataset-level cleaning, branch variants
# ---------------------------------------------------------------------------------------------


@register("assign_columns", f"""
SELECT {_tok('cnpj_basico')} AS col_00, {_tok('cnpj_ordem')} AS col_01, {_tok('cnpj_dv')} AS col_02
FROM estabelecimentos""")
def q_assign_columns(spark, sf_dir):
    # a digits-only table dumped under a name no rule recognises and without a header:
    # neither dictionary nor header applies, so the columns get generated names
    root = scratch_path(spark, "naming")
    D.write_dump(_cat(spark, sf_dir).est.select("cnpj_basico", "cnpj_ordem", "cnpj_dv"), f"{root}/src/Tabela")
    out = ingest_directory(spark, f"{root}/src", f"{root}/out")
    return spark.read.parquet(out[""])


@register("assign_columns_from_header", f"""
SELECT {_tok('codigo')} AS codigo, {_tok('descricao')} AS descricao FROM municipios""")
def q_assign_columns_from_header(spark, sf_dir):
    # a lookup under an unrecognised name, written with a header line: the header names win
    root = scratch_path(spark, "naming-header")
    mun = _cat(spark, sf_dir).mun
    D.write_dump(mun, f"{root}/src/Tabela", header=True)
    out = ingest_directory(spark, f"{root}/src", f"{root}/out")
    return spark.read.parquet(out[""]).select("codigo", "descricao")


@register("clean_names_dataset",
          f"SELECT * REPLACE ({clean_name_sql('nome_socio_ou_razao_social')} AS nome_socio_ou_razao_social, "
          f"{clean_name_sql('nome_representante')} AS nome_representante) FROM socios")
def q_clean_names_dataset(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    root = scratch_path(spark, "clean")
    write_parquet(cat.soc, f"{root}/src/Socios0.parquet")
    write_parquet(cat.mun, f"{root}/src/Municipios.parquet")  # not a cleaning target: not written
    out = clean_dataset(spark, [f"{root}/src/Socios0.parquet", f"{root}/src/Municipios.parquet"], f"{root}/dst")
    assert set(out) == {"Socios0.parquet"}
    return spark.read.parquet(out["Socios0.parquet"])


# the sites as one dump a task, lookups with and without a header beside them, taken in by few jobs
def _many_files(spark, sf_dir, root):
    cat = _cat(spark, sf_dir)
    est = _full(cat.est, "estabelecimentos")
    D.write_dump(est.repartition(64), f"{root}/src/Estabelecimentos")
    D.write_dump(cat.mun.repartition(5, "codigo"), f"{root}/src/Municipios")
    D.write_dump(cat.cnae.select("descricao", "codigo").repartition(3, "codigo"), f"{root}/src/atividades", header=True)


MANY_SQL = f"""
SELECT cnpj_basico AS a, {_tok('nome_fantasia')} AS b FROM estabelecimentos
UNION ALL SELECT {_tok('codigo')}, {_tok('descricao')} FROM municipios
UNION ALL SELECT {_tok('codigo')}, {_tok('descricao')} FROM cnaes"""


def _many_rows(spark, out_root):
    est, mun, other = (read_snapshot(spark, out_root, b) for b in ("estabelecimentos", "municipios", ""))
    return (est.select(F.col("cnpj_basico").alias("a"), F.col("nome_fantasia").alias("b"))
            .unionByName(mun.select(F.col("codigo").alias("a"), F.col("descricao").alias("b")))
            .unionByName(other.select(F.col("codigo").alias("a"), F.col("descricao").alias("b"))))


@register("ingest_many_files", MANY_SQL)
def q_ingest_many_files(spark, sf_dir):
    root = scratch_path(spark, "many")
    _many_files(spark, sf_dir, root)
    ingest_folder(spark, f"{root}/src", f"{root}/out")
    return _many_rows(spark, f"{root}/out")


# the same folder by the stream, twice over a new checkpoint: the second run finds every file published
@register("ingest_stream_mixed", MANY_SQL)
def q_ingest_stream_mixed(spark, sf_dir):
    root = scratch_path(spark, "stream-mixed")
    _many_files(spark, sf_dir, root)
    run_folder_stream(spark, f"{root}/src", f"{root}/out", f"{root}/checkpoint", max_files_per_trigger=40)
    run_folder_stream(spark, f"{root}/src", f"{root}/out", f"{root}/checkpoint-2")
    return _many_rows(spark, f"{root}/out")
