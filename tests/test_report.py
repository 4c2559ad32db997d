from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadastra.operators.ordering import pages, ranked
from cadastra.plans import report as R
from cadastra.sources.catalog import Catalog
from cadastra.sources.landing import landed_registry
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def cat(spark):
    return landed_registry(spark, SF_SMALL)


def requests(cat, spark, n=40):
    keys = [r[0] for r in cat.est.select(F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv")).orderBy("cnpj_basico").limit(n).collect()]
    return spark.createDataFrame([(k,) for k in [*keys, keys[0], "12", None, keys[0][:8] + "999999"]], "cnpj_input string")


@pytest.mark.parametrize("part", ["report", "sites", "partners", "regime", "nested"])
def test_few_jobs_before_the_result(spark, cat, part):
    """The keys are written and counted in one pass; everything else is one lazy plan."""
    req = requests(cat, spark)
    cat.est.sparkSession.sparkContext.setJobGroup(f"report-{part}", part)
    try:
        keys = R.requested_keys(req)
        {"report": lambda: R.cnpj_report(cat, req), "sites": lambda: R.sites_of(cat, keys), "partners": lambda: R.partners_of(cat, keys),
         "regime": lambda: R.simples_status(cat, keys), "nested": lambda: R.ask(keys)}[part]()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"report-{part}")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 6


def test_the_parts_share_one_written_key_table(spark, cat):
    asked = R.ask(R.requested_keys(requests(cat, spark)))
    assert asked.n == 41 and R.ask(asked) is asked  # forty sites and one key that no site has
    assert R.sites_of(cat, asked).count() == 40


def test_ranks_are_places_within_a_key(spark):
    rows = [("hot", i % 37, f"v{i}") for i in range(3000)] + [(f"k{i % 50}", i % 5, None) for i in range(1000)] + [("one", 1, "x")] * 300 + [(None, 2, "y")] * 900
    df = spark.createDataFrame(rows, "k string, o int, v string")
    found = ranked(df, "k", ["o"]).collect()
    assert len(found) == len(rows) and Counter((r["k"], r["o"], r["v"]) for r in found) == Counter(rows)
    per = {}
    for r in found:
        per.setdefault(r["k"], []).append((r["rank"], r["o"]))
    for places in per.values():
        places.sort()
        assert [p for p, _ in places] == list(range(1, len(places) + 1))
        assert [o for _, o in places] == sorted(o for _, o in places)


def test_a_company_with_many_partners_is_cut_into_pages(spark, cat):
    basico = cat.soc.select("cnpj_basico").join(cat.est, "cnpj_basico", "left_semi").join(cat.emp, "cnpj_basico", "left_semi").first()[0]
    one = cat.soc.where(F.col("cnpj_basico") == basico).limit(1)
    many = one.crossJoin(spark.range(100_000)).withColumn("nome_socio_ou_razao_social", F.format_string("P%06d", "id")).drop("id")
    more = Catalog({**cat.tables, "socios": cat.soc.where(F.col("cnpj_basico") != basico).unionByName(many)}, {})
    site = cat.est.where(F.col("cnpj_basico") == basico).select(F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv")).first()[0]
    keys = R.requested_keys(spark.createDataFrame([(site,)], "cnpj_input string"))
    nested = R.nested_report(more, keys)
    found = (nested.select("page", F.size("sites").alias("s"), F.size("partners").alias("p"),
                           F.col("partners")[0]["nome_socio_ou_razao_social"].alias("first")).orderBy("page").collect())
    assert [(r["page"], r["s"], r["p"], r["first"]) for r in found] == [
        (k + 1, 1 if k == 0 else 0, R.PAGE_ROWS, f"P{k * R.PAGE_ROWS:06d}") for k in range(100)]
    # the rows of that company lie in many partitions before they are gathered
    partners = R.partners_of(more, keys, sort=False)
    assert (ranked(partners, "cnpj_basico", R.PARTNER_ORDER).where("rank % 1000 = 1").count()) == 100


def test_pages_of_an_empty_table_and_of_blank_values(spark):
    df = spark.createDataFrame([], "k string, v string")
    assert pages(df, "k", ["v"], "rows", 10).count() == 0
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, "y")], "k string, v string")
    got = {(r["k"], r["page"]): [x["v"] for x in r["rows"]] for r in pages(df, "k", ["v"], "rows", 1).collect()}
    assert got == {("a", 1): ["x"], ("a", 2): [None], (None, 1): ["y"]}


def test_nested_report_without_partners_or_regime(spark, cat):
    keys = R.requested_keys(requests(cat, spark, 3))
    bare = R.nested_report(cat.without("socios", "simples"), keys)
    assert bare.count() >= 1 and bare.where("size(partners) > 0 OR opcao_mei IS NOT NULL").count() == 0
