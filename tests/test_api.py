"""API pages: flattening defaults and the sequential client's page cut-off."""
import json

from cadastra.sources.api import flatten_pages, page_cutoff


def _page(items, paginas=None):
    body = {"data": items}
    if paginas is not None:
        body["paginacao"] = {"paginas": paginas}
    return json.dumps(body)


def _pages(spark, rows):
    return spark.createDataFrame(rows, "search_id string, page int, status int, body string")


def test_flatten_defaults(spark):
    rows = [("s", 1, 200, _page([{"cnpj": "1", "razao_social": "A", "atividade_principal": {"descricao": "X"}},
                                 {"uf": "MG"}]))]
    got = sorted((tuple(r)[2:] for r in flatten_pages(_pages(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, None, "", "MG", "", "", "", ""), ("1", "A", "", "", "", "", "", "X")], key=repr)


def test_cutoff_rules(spark):
    it = [{"cnpj": "1"}]
    rows = [
        ("fail", 1, 200, _page(it, 9)), ("fail", 2, 500, _page(it, 9)), ("fail", 3, 200, _page(it, 9)),
        ("empty", 1, 200, _page(it, 9)), ("empty", 2, 200, _page([], 9)), ("empty", 3, 200, _page(it, 9)),
        ("announced", 1, 200, _page(it, 2)), ("announced", 2, 200, _page(it, 2)), ("announced", 3, 200, _page(it, 2)),
        ("cap", 1, 200, _page(it, 9)), ("cap", 2, 200, _page(it, 9)), ("cap", 3, 200, _page(it, 9)),
        ("gap", 1, 200, _page(it, 9)), ("gap", 3, 200, _page(it, 9)),
        ("nofirst", 2, 200, _page(it, 9)),
        ("nopag", 1, 200, _page(it)), ("nopag", 2, 200, _page(it)),
    ]
    got = dict(tuple(r) for r in page_cutoff(_pages(spark, rows), max_pages=2).collect())
    assert got == {"fail": 1, "empty": 1, "announced": 2, "cap": 2, "gap": 1, "nofirst": 0, "nopag": 1}
