"""Command line: ``python -m cadastra <command> [options]``.

Each command reads a folder of landed Parquet parts (``Empresas*.parquet``,
``Estabelecimentos*.parquet`` …), runs one plan on the session the environment provides
(``SparkSession.builder.getOrCreate()``) and writes its result as files — nothing is gathered on
the driver except aggregated counts and file metadata.

    leads        filtered company list → ';' CSV with BOM
    health       health-sector list of one municipality → CSV
    mei-active   active MEI sites of a state → CSV
    mei-inactive inactive MEI counts of a state (printed)
    report       per-CNPJ report parts for one or more CNPJs → one CSV folder per part
    describe     column names and types of bases
    clean-names  copy of the company/site/partner datasets with tax ids removed from names
    rename       copy of datasets with dictionary or normalised column names
    ingest       folder of dump CSVs or zips → Parquet per base (pending sources only)
    curate       landed Parquet → query layout (sites by state, files clustered by company key)
    api-pages    landed search-API pages → the items a paging client would return → CSV
    stream       incremental ingest of a landing folder with the file-source stream
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session() -> SparkSession:
    return SparkSession.builder.appName("cadastra").getOrCreate()


def _catalog(spark, parquet_dir, required=("empresas", "estabelecimentos")):
    from .sources.catalog import load_catalog
    return load_catalog(spark, parquet_dir, required=required)


def _export(df, out: str, single_file: bool, bom: bool = True, sort_by=None) -> int:
    from .sources.export import export_csv
    return export_csv(df, out, bom=bom, single_file=single_file, sort_by=sort_by)


def cmd_leads(a) -> None:
    from .plans.leads import LeadFilter, leads
    spark = _session()
    cat = _catalog(spark, a.parquet_dir)
    f = LeadFilter(uf=a.uf, municipio=a.municipio, cnae=a.cnae, porte=a.porte, situacao=a.situacao,
                   limit=a.limit, opcao_sim=a.opcao_sim, ativos=a.ativos, natureza=a.natureza,
                   cnae_principal=a.cnae_principal, cnae_secundario=a.cnae_secundario,
                   aberto_de=a.aberto_de, aberto_ate=a.aberto_ate)
    n = _export(leads(cat, f), a.out, a.single_file)
    print(f"rows exported: {n}")


def cmd_health(a) -> None:
    from .plans.leads import health_leads
    spark = _session()
    n = _export(health_leads(_catalog(spark, a.parquet_dir), include_branches=a.incluir_filiais, uf=a.uf,
                             municipio_code=a.municipio_codigo, division=a.divisao), a.out, a.single_file)
    print(f"rows exported: {n}")


def cmd_mei_active(a) -> None:
    from .plans.mei import mei_active_leads
    spark = _session()
    cat = _catalog(spark, a.parquet_dir, required=("empresas", "estabelecimentos", "simples", "municipios"))
    n = _export(mei_active_leads(cat, uf=a.uf), a.out, a.single_file, bom=False)
    print(f"rows exported: {n}")


def cmd_mei_inactive(a) -> None:
    from .plans.mei import mei_inactive_by_status, mei_inactive_total
    spark = _session()
    cat = _catalog(spark, a.parquet_dir, required=("estabelecimentos", "simples"))
    kw = dict(uf=a.uf, include_branches=a.incluir_filiais)
    print(f"inactive MEI ({a.uf.upper()}): {mei_inactive_total(cat, **kw).first()[0]}")
    for r in mei_inactive_by_status(cat, **kw).collect():  # one row per status code
        print(f"  {r.codigo} {r.descricao}: rows={r.registros} cnpjs={r.cnpjs_distintos}")


def cmd_report(a) -> None:
    from .plans import report as R
    from .session import written
    spark = _session()
    cat = _catalog(spark, a.parquet_dir)
    req = spark.createDataFrame([(c,) for c in a.cnpj], "cnpj_input string")
    keys = R.ask(R.requested_keys(req))
    # what is exported and what is named as missing are the same written rows
    report, _ = written(R.cnpj_report(cat, req, keys=keys), "report")
    parts = {"report": (report, ["cnpj"]), "sites": (R.sites_of(cat, keys, sort=False), ["tipo", "data_inicio_atividade", "cnpj"])}
    if cat.has("socios"):
        parts["partners"] = (R.partners_of(cat, keys, sort=False), ["nome_socio_ou_razao_social", "cnpj_basico", "cnpj_cpf_socio"])
    for name, (df, order) in parts.items():  # the report of a few requests is small: one sorted file each
        print(f"{name}: {_export(df, f'{a.out}/{name}', True, sort_by=order)} rows")
    missed = report.where(F.col("status") != R.FOUND).select("cnpj", "status")
    _report([(r["cnpj"], r["status"]) for r in missed.toLocalIterator()])


def cmd_describe(a) -> None:
    from .sources.catalog import PART_PREFIX, describe, scan_parts
    spark = _session()
    wanted = [b.strip() for b in a.filter.split("|") if b.strip()]
    by_prefix = {v.lower(): k for k, v in PART_PREFIX.items()}
    tables = {}
    for w in wanted:
        base = by_prefix.get(w.lower(), w.lower())
        tables[w] = scan_parts(spark, a.parquet_dir, base)
    for r in describe(spark, {k: v for k, v in tables.items() if v is not None}, a.filter).collect():
        print(f"{r.base}\t{r.column_name}\t{r.column_type}")


def _parquet_paths(spark, root: str) -> list[str]:
    from .sources.dumps import list_files
    files = list_files(spark, root, "*.parquet").select(F.regexp_extract("path", r"^(.*?\.parquet)(?:/.*)?$", 1))
    return sorted(r[0] for r in files.distinct().collect())  # one row per dataset folder


def _report(errors: list) -> None:
    for *what, message in errors:
        print(f"[ERROR] {' '.join(x or 'unknown' for x in what)}: {message}")
    if errors:
        raise SystemExit(1)


def cmd_clean_names(a) -> None:
    from .sources.parquet_io import clean_dataset
    spark = _session()
    errors: list = []
    for name, dst in clean_dataset(spark, _parquet_paths(spark, a.src), a.dst, a.src, errors).items():
        print(f"cleaned {name} -> {dst}")
    _report(errors)


def cmd_rename(a) -> None:
    from .sources.parquet_io import rename_dataset
    spark = _session()
    errors: list = []
    for name, dst in rename_dataset(spark, _parquet_paths(spark, a.src), a.dst, a.include_e_e_s, a.src, errors).items():
        print(f"renamed {name} -> {dst}")
    _report(errors)


def cmd_ingest(a) -> None:
    from .sources import archives as ZIP
    from .sources.dumps import list_files
    from .sources.ingest import ingest_directory
    from .sources.links import select_sources
    spark = _session()
    t0 = time.time()
    errors: list = []
    written = {}
    zips = list_files(spark, a.src, "*.zip").select(F.col("path").alias("link"))
    chosen = select_sources(zips, a.filter or None, a.limit).withColumnRenamed("link", "path")
    n = chosen.count()
    if n:  # the selection is sorted into few partitions: deal it out, one archive per task
        landed = ZIP.extract_members(chosen.repartition(n), f"{a.work_dir}/csv")
        landed.write.mode("overwrite").parquet(f"{a.work_dir}/_extracted")  # runs the extraction
        failed = spark.read.parquet(f"{a.work_dir}/_extracted").where("failure IS NOT NULL")
        errors += [("archive", r["archive"], r["failure"]) for r in failed.toLocalIterator()]
        written |= ingest_directory(spark, f"{a.work_dir}/csv", a.out_dir, errors=errors)
    # plain dumps beside the archives
    written |= ingest_directory(spark, a.src, a.out_dir, errors=errors, skip=".zip")
    for base, path in written.items():
        print(f"[OK] {base or 'unknown'} -> {path}")
    print(f"done in {time.time() - t0:.1f}s")
    _report(errors)


def cmd_curate(a) -> None:
    from .sources.catalog import load_catalog
    from .sources.landing import curate
    spark = _session()
    cat = curate(spark, load_catalog(spark, a.src, required=()), a.dst)
    for base in cat.tables:
        print(f"curated {base} -> {a.dst}")


def cmd_api_pages(a) -> None:
    from .sources import api as API
    spark = _session()
    if a.src.rstrip("/").endswith(".parquet"):
        pages = spark.read.parquet(a.src)
    else:  # JSON lines: {"search_id": …, "page": …, "status": …, "body": "<page JSON text>"}
        pages = spark.read.schema("search_id string, page int, status int, body string").json(a.src)
    items = API.flatten_pages(API.used_pages(pages, a.max_paginas))
    print(f"items exported: {_export(items, a.out, a.single_file)}")


def cmd_stream(a) -> None:
    from .streaming.ingest_stream import run_ingest_stream, start_ingest_stream
    spark = _session()
    if a.continuous:
        start_ingest_stream(spark, a.src, a.out, a.checkpoint, a.base, available_now=False).awaitTermination()
    else:
        run_ingest_stream(spark, a.src, a.out, a.checkpoint, a.base)


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="python -m cadastra")
    sub = ap.add_subparsers(dest="command", required=True)

    p = sub.add_parser("leads", help="filtered company list")
    p.add_argument("--parquet-dir", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--uf")
    p.add_argument("--municipio", help="name or code")
    p.add_argument("--cnae", type=int, help="activity division (first two digits)")
    p.add_argument("--porte", nargs="+", type=int, choices=[0, 1, 3, 5], default=[3, 5])
    p.add_argument("--situacao", nargs="+", type=int, choices=[1, 2, 3, 4, 8])
    p.add_argument("--limit", type=int)
    p.add_argument("--opcao-sim", action="store_true", help="MEI only")
    p.add_argument("--ativos", action="store_true")
    # filters of the search form, applied to the local tables
    p.add_argument("--natureza", help="legal nature code (e.g. 2135)")
    p.add_argument("--cnae-principal", help="exact main activity code")
    p.add_argument("--cnae-secundario", help="code listed among the secondary activities")
    p.add_argument("--aberto-de", help="opened on or after (YYYY-MM-DD)")
    p.add_argument("--aberto-ate", help="opened on or before (YYYY-MM-DD)")
    p.add_argument("--single-file", action="store_true")
    p.set_defaults(fn=cmd_leads)

    p = sub.add_parser("health", help="health-sector list")
    p.add_argument("--parquet-dir", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--incluir-filiais", action="store_true")
    p.add_argument("--uf", default="MG")
    p.add_argument("--municipio-codigo", type=int, default=5403, help="municipality code in the site table")
    p.add_argument("--divisao", default="86", help="activity division (first two digits)")
    p.add_argument("--single-file", action="store_true")
    p.set_defaults(fn=cmd_health)

    p = sub.add_parser("mei-active", help="active MEI sites of a state")
    p.add_argument("--parquet-dir", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--uf", default="MG")
    p.add_argument("--single-file", action="store_true")
    p.set_defaults(fn=cmd_mei_active)

    p = sub.add_parser("mei-inactive", help="inactive MEI counts")
    p.add_argument("--parquet-dir", required=True)
    p.add_argument("--uf", default="MG")
    p.add_argument("--incluir-filiais", action="store_true")
    p.set_defaults(fn=cmd_mei_inactive)

    p = sub.add_parser("report", help="per-CNPJ report")
    p.add_argument("--parquet-dir", required=True)
    p.add_argument("--cnpj", nargs="+", required=True)
    p.add_argument("--out", required=True)
    p.set_defaults(fn=cmd_report)

    p = sub.add_parser("describe", help="columns of bases")
    p.add_argument("--filter", required=True, help="bases separated by '|'")
    p.add_argument("--parquet-dir", required=True)
    p.set_defaults(fn=cmd_describe)

    p = sub.add_parser("clean-names", help="remove tax ids from name fields")
    p.add_argument("--src", required=True)
    p.add_argument("--dst", required=True)
    p.set_defaults(fn=cmd_clean_names)

    p = sub.add_parser("rename", help="rename dataset columns")
    p.add_argument("--src", required=True)
    p.add_argument("--dst", required=True)
    p.add_argument("--include-e-e-s", action="store_true")
    p.set_defaults(fn=cmd_rename)

    p = sub.add_parser("ingest", help="dumps (CSV or zip) → Parquet")
    p.add_argument("--src", required=True, help="folder of .zip archives or dump files")
    p.add_argument("--out-dir", required=True)
    p.add_argument("--work-dir", help="landing folder for extracted zip members (shared storage)")
    p.add_argument("--filter", default="", help="case-insensitive regex on the archive path")
    p.add_argument("--limit", type=int, default=0)
    p.set_defaults(fn=cmd_ingest)

    p = sub.add_parser("curate", help="rewrite landed Parquet in the query layout")
    p.add_argument("--src", required=True)
    p.add_argument("--dst", required=True)
    p.set_defaults(fn=cmd_curate)

    p = sub.add_parser("api-pages", help="flatten landed search-API pages")
    p.add_argument("--src", required=True, help="landed pages: .parquet folder or JSON lines")
    p.add_argument("--out", required=True)
    p.add_argument("--max-paginas", type=int, default=10)
    p.add_argument("--single-file", action="store_true")
    p.set_defaults(fn=cmd_api_pages)

    p = sub.add_parser("stream", help="incremental ingest of a landing folder")
    p.add_argument("--src", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--base", required=True)
    p.add_argument("--continuous", action="store_true")
    p.set_defaults(fn=cmd_stream)
    return ap


def main(argv=None) -> None:
    a = parser().parse_args(argv)
    if getattr(a, "work_dir", "x") is None:
        a.work_dir = a.out_dir.rstrip("/") + "/_work"
    a.fn(a)


if __name__ == "__main__":
    main(sys.argv[1:])
