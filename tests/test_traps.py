from cadastra.plans.leads import LeadFilter, health_leads, leads
from cadastra.sources.catalog import Catalog
from cadastra.sources.schema import COLUMNS

EST = COLUMNS["estabelecimentos"]


def _site(**kw):
    row = {c: None for c in EST}
    row.update(cnpj_basico="00000001", cnpj_ordem="0001", cnpj_dv="00", identificador_matriz_filial="1",
               situacao_cadastral="02", uf="MG", municipio="5403", cnae_fiscal_principal="8630501")
    row.update(kw)
    return tuple(row[c] for c in EST)


def _catalog(spark, sites, companies, with_lookups=True):
    schema = ", ".join(f"{c} string" for c in EST)
    t = {
        "estabelecimentos": spark.createDataFrame(sites, schema),
        "empresas": spark.createDataFrame(companies, ", ".join(f"{c} string" for c in COLUMNS["empresas"])),
    }
    if with_lookups:
        t["municipios"] = spark.createDataFrame([("5403", "UBERLANDIA"), ("abc", "JUNK")], "codigo string, descricao string")
        t["cnaes"] = spark.createDataFrame([("8630501", "Clínica médica"), ("", "EMPTY")], "codigo string, descricao string")
    return Catalog(t)


def _company(key, name, porte="05"):
    return (key, name, "2062", "05", "1000,00", porte, None)


def test_junk_codes_never_fail(spark):
    sites = [_site(), _site(cnpj_basico="00000002", cnae_fiscal_principal=""),
             _site(cnpj_basico="00000003", cnae_fiscal_principal="abc", municipio="x", situacao_cadastral="1.5"),
             _site(cnpj_basico="00000004", cnae_fiscal_principal=None, municipio=None, situacao_cadastral=None)]
    comps = [_company(f"0000000{i}", f"C{i}") for i in range(1, 5)]
    cat = _catalog(spark, sites, comps)
    got = leads(cat, LeadFilter(uf="mg", cnae=86, situacao=[2], municipio="5403")).collect()
    assert [r.cnpj for r in got] == ["00000001000100"]
    assert leads(cat, LeadFilter()).count() == 4     # junk never raises, even under ANSI mode
    h = health_leads(cat).collect()
    assert [(r.cnpj, r.tipo_saude) for r in h] == [("00000001000100", "CLINICA")]


def test_nulls_last_and_trade_name_fallback(spark):
    sites = [_site(cnpj_basico=k, nome_fantasia=nf) for k, nf in
             [("00000001", None), ("00000002", "LOJA"), ("00000003", None)]]
    comps = [_company("00000001", "B"), _company("00000002", None), _company("00000003", "A")]
    got = [(r.razao_social, r.nome_fantasia) for r in leads(_catalog(spark, sites, comps), LeadFilter()).collect()]
    assert got == [("A", "A"), ("B", "B"), (None, "LOJA")]


def test_city_code_with_and_without_lookup(spark):
    sites = [_site(), _site(cnpj_basico="00000002", municipio="05403"), _site(cnpj_basico="00000003", municipio="7777")]
    comps = [_company(f"0000000{i}", f"C{i}") for i in range(1, 4)]
    with_lk = _catalog(spark, sites, comps)
    without = _catalog(spark, sites, comps, with_lookups=False)
    # padded and unpadded codes match; unknown code 7777 has no lookup row
    assert leads(with_lk, LeadFilter(municipio="5403")).count() == 2
    assert leads(with_lk, LeadFilter(municipio="7777")).count() == 0      # must exist in the lookup
    assert leads(without, LeadFilter(municipio="7777")).count() == 1      # site's own code only
    assert leads(without, LeadFilter(municipio="Uberlandia")).count() == 3  # name ignored without lookup
    r = leads(without, LeadFilter()).first()
    assert r.municipio_nome is None and r.cnae_principal_nome is None and r.opcao_mei == ""


def test_filters_commute(spark):
    """A combined filter equals the intersection of the single-filter results."""
    from cadastra.sources.landing import landed_registry
    from tests.conftest import SF_SMALL
    cat = landed_registry(spark, SF_SMALL)
    singles = [dict(uf="MG"), dict(municipio="5403"), dict(cnae=86), dict(ativos=True), dict(opcao_sim=True),
               dict(aberto_de="1994-01-01")]
    base = dict(porte=[0, 1, 3, 5])

    def keys(**f):
        return {r.cnpj for r in leads(cat, LeadFilter(**base, **f), sort=False).select("cnpj").collect()}
    combined = {}
    for s in singles:
        combined.update(s)
    expected = set.intersection(*[keys(**s) for s in singles])
    assert keys(**combined) == expected and expected
