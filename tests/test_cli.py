"""Command line over a folder of landed Parquet parts (sf0.001 registry bases)."""
import glob

import pytest

from cadastra.__main__ import main
from cadastra.sources.catalog import PART_PREFIX
from cadastra.sources.registry import registry_views
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landed"))
    for base, df in registry_views(spark, SF_SMALL).items():
        df.write.parquet(f"{root}/{PART_PREFIX[base]}.parquet")
    return root


def _rows(spark, path):
    from cadastra.sources.export import read_export
    return read_export(spark, path).count()


def test_leads_and_health(spark, landed, tmp_dir, capsys):
    main(["leads", "--parquet-dir", landed, "--out", f"{tmp_dir}/l", "--uf", "MG", "--municipio", "Uberlandia",
          "--situacao", "8", "--single-file"])
    assert "rows exported: 20" in capsys.readouterr().out
    assert len(glob.glob(f"{tmp_dir}/l/part-*.csv")) == 1 and _rows(spark, f"{tmp_dir}/l") == 20
    main(["health", "--parquet-dir", landed, "--out", f"{tmp_dir}/h"])
    assert "rows exported: 6" in capsys.readouterr().out


def test_mei(spark, landed, tmp_dir, capsys):
    main(["mei-active", "--parquet-dir", landed, "--out", f"{tmp_dir}/m"])
    assert "rows exported: 93" in capsys.readouterr().out
    main(["mei-inactive", "--parquet-dir", landed])
    out = capsys.readouterr().out
    assert "3 SUSPENSA: rows=29" in out and "4 INAPTA: rows=27" in out and "8 BAIXADA: rows=23" in out


def test_report_describe(spark, landed, tmp_dir, capsys):
    key = spark.read.parquet(f"{landed}/Estabelecimentos.parquet").first()
    cnpj = f"{key.cnpj_basico[:2]}.{key.cnpj_basico[2:5]}.{key.cnpj_basico[5:]}/{key.cnpj_ordem}-{key.cnpj_dv}"
    main(["report", "--parquet-dir", landed, "--cnpj", cnpj, "--out", f"{tmp_dir}/r"])
    out = capsys.readouterr().out
    assert "report: 1 rows" in out and "sites: 1 rows" in out
    main(["describe", "--filter", "Municipios|Cnaes", "--parquet-dir", landed])
    assert "Municipios\tcodigo\tVARCHAR" in capsys.readouterr().out


def test_clean_rename_ingest(spark, landed, tmp_dir, capsys):
    main(["clean-names", "--src", landed, "--dst", f"{tmp_dir}/c"])
    out = capsys.readouterr().out
    assert "cleaned Empresas.parquet" in out and "Municipios" not in out
    main(["rename", "--src", landed, "--dst", f"{tmp_dir}/n"])
    assert "renamed Socios.parquet" in capsys.readouterr().out
    from cadastra.sources.dumps import write_dump
    write_dump(spark.read.parquet(f"{landed}/Cnaes.parquet"), f"{tmp_dir}/dumps/Cnaes")
    main(["ingest", "--src", f"{tmp_dir}/dumps", "--out-dir", f"{tmp_dir}/pq"])
    assert "[OK] cnaes" in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp_dir}/pq/Cnaes*.parquet").count() == \
        spark.read.parquet(f"{landed}/Cnaes.parquet").count()


def test_curate_then_query(spark, landed, tmp_dir, capsys):
    from cadastra.plans.leads import LeadFilter, leads
    from cadastra.sources.catalog import load_catalog
    main(["curate", "--src", landed, "--dst", f"{tmp_dir}/cur"])
    assert "curated estabelecimentos" in capsys.readouterr().out
    cur = load_catalog(spark, f"{tmp_dir}/cur")
    assert "uf_norm" in cur.est.columns
    f = LeadFilter(uf="MG", municipio="Uberlandia", situacao=[8])
    a = sorted(tuple(r) for r in leads(cur, f).collect())
    b = sorted(tuple(r) for r in leads(load_catalog(spark, landed), f).collect())
    assert a == b and len(a) == 20
    assert "PartitionFilters: [isnotnull(uf_norm" in leads(cur, f)._jdf.queryExecution().executedPlan().toString()
    main(["leads", "--parquet-dir", f"{tmp_dir}/cur", "--out", f"{tmp_dir}/l2", "--uf", "MG", "--municipio",
          "Uberlandia", "--situacao", "8"])
    assert "rows exported: 20" in capsys.readouterr().out


def test_api_pages(spark, tmp_dir, capsys):
    import json
    def page(items, n):
        return json.dumps({"data": items, "paginacao": {"paginas": n}})
    rows = [{"search_id": "s", "page": 1, "status": 200, "body": page([{"cnpj": "1"}, {"cnpj": "2"}], 3)},
            {"search_id": "s", "page": 2, "status": 200, "body": page([{"cnpj": "3"}], 3)},
            {"search_id": "s", "page": 3, "status": 500, "body": "{}"},
            {"search_id": "t", "page": 1, "status": 200, "body": page([{"cnpj": "9"}], 1)},
            {"search_id": "t", "page": 2, "status": 200, "body": page([{"cnpj": "10"}], 1)}]
    with open(f"{tmp_dir}/pages.jsonl", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    main(["api-pages", "--src", f"{tmp_dir}/pages.jsonl", "--out", f"{tmp_dir}/items"])
    assert "items exported: 4" in capsys.readouterr().out


def test_leads_form_filters(spark, landed, tmp_dir, capsys):
    from cadastra.plans.leads import LeadFilter, leads
    from cadastra.sources.catalog import load_catalog
    main(["leads", "--parquet-dir", landed, "--out", f"{tmp_dir}/f", "--natureza", "2135",
          "--cnae-secundario", "8640202", "--aberto-de", "1995-01-01", "--aberto-ate", "1996-12-31"])
    n = leads(load_catalog(spark, landed), LeadFilter(natureza="2135", cnae_secundario="8640202",
                                                      aberto_de="19950101", aberto_ate="19961231")).count()
    assert n > 0 and f"rows exported: {n}" in capsys.readouterr().out
