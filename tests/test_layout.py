import pytest
from pyspark.sql import functions as F

from cadastra.operators.joins import SkewPolicy, fact_join
from cadastra.plans.leads import LeadFilter, leads
from cadastra.sources.catalog import Catalog
from cadastra.sources.landing import landed_registry, parquet_options
from cadastra.sources.layout import SPLIT_ALREADY, over_parts, read_layout, write_layout
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def cat(spark):
    return landed_registry(spark, SF_SMALL)


@pytest.fixture(scope="module")
def skewed(spark, cat, tmp_path_factory):
    """The registry with one company that owns a third of all sites, and sites without a company key."""
    est = cat.est.drop("uf_norm", "situacao_int", "matriz_int", "municipio_int", "cnae_int", "divisao_int", "ativa")
    basico = est.join(cat.emp, "cnpj_basico", "left_semi").first()["cnpj_basico"]
    rows = est.count()
    more = est.limit(1).crossJoin(spark.range(rows // 2)).withColumn("cnpj_ordem", F.format_string("%04d", F.col("id") % 10000))
    more = more.withColumn("cnpj_basico", F.when(F.col("id") < 20, None).otherwise(F.lit(basico))).drop("id")
    fact = Catalog({**cat.tables, "estabelecimentos": est.unionByName(more)}, {})
    root = str(tmp_path_factory.mktemp("layout"))
    return fact, root + "/l", write_layout(fact, root + "/l", SkewPolicy(hot_rows=200), buckets=6), basico


def joined(cat):
    dims = [(cat.emp.select("cnpj_basico", "razao_social"), "inner"), (cat.sim.select("cnpj_basico", "opcao_mei"), "left")]
    return fact_join(cat.est.select("cnpj_basico", "cnpj_ordem", "uf"), dims, skew=SPLIT_ALREADY)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_shuffle_below_the_joins(spark, skewed):
    _, _, layout, _ = skewed
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cold = plan_of(joined(layout.cold))
        assert cold.count("SortMergeJoin") == 2 and "Exchange" not in cold and "SelectedBucketsCount: 6 out of 6" in cold
        # a state filter still prunes folders
        one = plan_of(leads(layout.cold, LeadFilter(uf="MG"), sort=False, skew=SPLIT_ALREADY))
        assert "PartitionFilters: [isnotnull(uf_norm" in one and "hashpartitioning(cnpj_basico" not in one
        # the hot part is never dealt by its key either
        hot = plan_of(joined(layout.hot))
        assert "hashpartitioning" not in hot and hot.count("BroadcastHashJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_company_with_a_third_of_the_sites_fills_no_bucket(spark, skewed):
    fact, _, layout, basico = skewed
    total = fact.est.count()
    assert {r[0] for r in layout.hot.est.select("cnpj_basico").distinct().collect()} == {basico}
    assert layout.hot.est.count() > total * 0.3 and layout.keyless.est.count() == 20
    per = layout.cold.est.groupBy(F.spark_partition_id()).count().collect()
    cold = sum(r["count"] for r in per)
    assert len(per) == 6 and cold + layout.hot.est.count() + 20 == total
    # 150 companies in six buckets are uneven by chance; the large one alone would be 2.5 times this bound
    assert max(r["count"] for r in per) < 2 * cold / 6 < layout.hot.est.count() / 1.2


def test_the_union_of_the_parts_is_the_plain_join(spark, skewed):
    fact, _, layout, _ = skewed
    rows = lambda df: sorted(map(str, df.collect()))
    plain = fact.est.join(fact.emp, "cnpj_basico").join(fact.sim, "cnpj_basico", "left").select(
        "cnpj_basico", "cnpj_ordem", "uf", "razao_social", "opcao_mei")
    assert rows(over_parts(layout, joined)) == rows(plain)
    f = LeadFilter(uf="MG")
    assert rows(over_parts(layout, lambda c: leads(c, f, sort=False, skew=SPLIT_ALREADY))) == rows(leads(fact, f, sort=False))
    # a left join keeps the sites without a key
    left = over_parts(layout, lambda c: fact_join(c.est.select("cnpj_basico"), [(c.sim.select("cnpj_basico", "opcao_mei"), "left")], skew=SPLIT_ALREADY))
    assert left.count() == fact.est.count()


def test_a_later_session_reads_the_same_layout(spark, skewed):
    fact, root, layout, _ = skewed
    for t in spark.catalog.listTables():
        if t.name.startswith("cadastra_") and not t.isTemporary:
            spark.sql(f"DROP TABLE {t.name}")  # external: the files stay
    again = read_layout(spark, root, fact)
    assert again.buckets == 6 and "Bucketed: true" in plan_of(again.cold.est.join(again.cold.emp.hint("merge"), "cnpj_basico"))
    assert over_parts(again, joined).count() == over_parts(layout, joined).count()
    with pytest.raises(FileExistsError):
        write_layout(fact, root)


def scanned_rows(spark, df):
    """Rows that the file scan of ``df`` gave out: those of the row groups that were not skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while not plan.nodeName().startswith("Scan"):
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_bloom_filters_answer_scattered_keys(spark, tmp_dir):
    """Keys in no order, so that every row group spans the whole range: statistics cannot skip any."""
    n, keys = 400_000, [f"{(i * 7919) % 100_000_000:08d}" for i in range(0, 400_000, 20_000)]
    df = spark.range(n).select(F.format_string("%08d", (F.col("id") * 7919) % 100_000_000).alias("cnpj_basico"), F.col("id").cast("string").alias("x"))
    small = {"parquet.block.size": "65536", "parquet.page.size": "8192", "parquet.block.row.count.limit": "2000", "parquet.enable.dictionary": "false"}
    opts = {k: v for k, v in parquet_options("empresas").items()}
    df.coalesce(1).write.options(**small, **opts).parquet(f"{tmp_dir}/bloom")
    df.coalesce(1).write.options(**small, compression="zstd").parquet(f"{tmp_dir}/plain")
    read = {k: spark.read.parquet(f"{tmp_dir}/{k}").where(F.col("cnpj_basico").isin(keys)) for k in ("bloom", "plain")}
    assert {k: v.count() for k, v in read.items()} == {"bloom": 20, "plain": 20}
    assert scanned_rows(spark, read["bloom"]) < 0.35 * n and scanned_rows(spark, read["plain"]) > 0.95 * n


def test_landed_filters_are_pushed(spark, cat, request):
    from cadastra.plans.leads import health_leads
    from cadastra.plans.mei import mei_active_leads
    pushed = lambda df: plan_of(df).split("PushedFilters: ", 1)[1]
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.maxMetadataStringLength", old))
    assert "EqualTo(divisao_int,86)" in pushed(leads(cat, LeadFilter(cnae=86)))
    assert "StringStartsWith(cnae_fiscal_principal,86)" in plan_of(health_leads(cat))
    assert "ativa" in plan_of(mei_active_leads(cat)).split("PushedFilters: ", 1)[1]


def test_secondary_activities_are_read_from_the_inverted_table(spark, cat, tmp_dir):
    """A pruned read and a semi join; no list of the sites is split."""
    f = LeadFilter(cnae_secundario="8640202")
    plan = plan_of(leads(cat, f, sort=False))
    assert "split(" not in plan and "EqualTo(codigo,8640202)" in plan and "LeftSemi" in plan
    without = Catalog(cat.tables, {})  # no index: the lists are split
    assert "split(" in plan_of(leads(without, f, sort=False))
    rows = lambda c, code: sorted(map(str, leads(c, LeadFilter(cnae_secundario=code), sort=False).collect()))
    codes = [r[0] for r in cat.indexes["secondary_activity"].select("codigo").distinct().limit(5).collect()]
    assert any(rows(cat, c) for c in codes)
    assert all(rows(cat, c) == rows(without, c) for c in [*codes, "0", ""])


def test_the_inverted_table_of_odd_rows(spark, tmp_dir):
    from cadastra.plans.leads import with_secondary_activity
    from cadastra.sources.landing import land
    odd = [("1", "1", "1", "1,2,2"), ("1", "1", "1", "3"), (None, None, None, "1"), ("2", "1", "1", None), ("3", "1", "1", ""),
           ("4", "1", "1", "12,1 ")]
    est = spark.createDataFrame(odd, "cnpj_basico string, cnpj_ordem string, cnpj_dv string, cnae_fiscal_secundaria string")
    landed = land(spark, {"estabelecimentos": est.withColumn("uf", F.lit("MG"))}, f"{tmp_dir}/odd")
    got = lambda code: sorted((r["cnpj_basico"] or "-", r["cnae_fiscal_secundaria"]) for r in
                              with_secondary_activity(landed, landed.est, code).collect())
    assert got("1") == [("-", "1"), ("1", "1,2,2")] and got("2") == [("1", "1,2,2")] and got("") == [("3", "")] and got("1 ") == [("4", "12,1 ")]
