"""Join strategies: hot-key split equals the plain join; lookups broadcast; top-K plan."""
from pyspark.sql import functions as F

from cadastra.operators.joins import SkewPolicy, fact_join, lookup_join
from cadastra.operators.ordering import top_k


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def _skewed(spark):
    # key 'A' holds most fact rows (far more than the hot threshold used below)
    fact = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 != 0, F.lit("A")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("k"), F.col("id").cast("string").alias("v"))
    dim1 = spark.createDataFrame([("A", "x")] + [(f"k{i}", f"d{i}") for i in range(0, 50, 2)], "k string, d1 string")
    dim2 = spark.createDataFrame([("A", "y"), ("A", "y2"), ("k1", "z")], "k string, d2 string")
    return fact, dim1, dim2


def test_hot_key_split_equals_plain_join(spark):
    fact, dim1, dim2 = _skewed(spark)
    dims = [(dim1, "inner"), (dim2, "left")]
    plain = fact_join(fact, dims, "k", SkewPolicy(enabled=False))
    split = fact_join(fact, dims, "k", SkewPolicy(hot_rows=100))
    assert _sorted(split) == _sorted(plain)
    assert split.count() == 2000 * 2 + 25 * 0 + plain.count() - 2000 * 2


def test_hot_keys_are_not_shuffled(spark):
    fact, dim1, _ = _skewed(spark)
    out = fact_join(fact, [(dim1, "inner")], "k", SkewPolicy(hot_rows=100))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "BroadcastHashJoin" in plan


def test_rows_without_a_key(spark):
    fact, dim1, dim2 = _skewed(spark)
    fact = fact.withColumn("k", F.when(F.col("v").cast("int") % 4 == 0, None).otherwise(F.col("k")))
    for dims in ([(dim1, "left"), (dim2, "left")], [(dim1, "inner"), (dim2, "left")]):
        plain = fact_join(fact, dims, "k", SkewPolicy(enabled=False))
        split = fact_join(fact, dims, "k", SkewPolicy(hot_rows=100))
        assert split.columns == plain.columns
        assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_small_means_rows_and_bytes(spark):
    from cadastra.operators.joins import is_small
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert is_small(df, 1000) and not is_small(df, 10) and not is_small(df, 1000, 50_000) and is_small(df, 1000)


def test_lookup_is_broadcast(spark):
    big = spark.range(0, 1000).select(F.lpad((F.col("id") % 30).cast("string"), 4, "0").alias("code"))
    lk = spark.createDataFrame([(str(i), f"n{i}") for i in range(25)], "codigo string, descricao string")
    out = lookup_join(big, lk, "code", "left", prefix="m")
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("m_descricao IS NOT NULL").count() == sum(1 for i in range(1000) if i % 30 < 25)


def test_top_k_plan(spark):
    df = spark.range(0, 500).select((F.col("id") % 7).cast("string").alias("k"), "id")
    out = top_k(df, 5, ["k"])
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in out.collect()] == [("0", 0), ("0", 7), ("0", 14), ("0", 21), ("0", 28)]


def test_plans_with_hot_keys_equal_plain(spark):
    # sf0.001: companies own up to ~30 sites; a threshold of 5 makes many of them hot
    from cadastra.plans.leads import LeadFilter, health_leads, leads
    from cadastra.plans.mei import mei_inactive_by_status
    from cadastra.sources.landing import landed_registry
    from tests.conftest import SF_SMALL
    cat = landed_registry(spark, SF_SMALL)
    hot, plain = SkewPolicy(hot_rows=5), SkewPolicy(enabled=False)
    assert cat.hot_keys("estabelecimentos", "cnpj_basico", 5).count() > 10
    for build in (lambda s: leads(cat, LeadFilter(uf="MG"), skew=s, sort=False),
                  lambda s: health_leads(cat, include_branches=True, skew=s, sort=False),
                  lambda s: mei_inactive_by_status(cat, skew=s)):
        assert _sorted(build(hot)) == _sorted(build(plain))
    assert "Union" in leads(cat, LeadFilter(uf="MG"), skew=hot)._jdf.queryExecution().optimizedPlan().toString()


def test_no_python_in_list_plans(spark):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    for key in ("leads_filtered", "health_leads", "mei_active_leads", "cnpj_report", "clean_names_sites",
                "extract_links"):
        plan = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "PythonUDF" not in plan, key


def test_state_filter_prunes_partitions(spark):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    plan = E.queries()["filter_state"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "uf_norm" in plan and "PartitionFilters: [isnotnull(uf_norm" in plan


def test_code_filters_reach_the_scan(spark, request):
    import __spark_entry__ as E
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")  # the whole list of pushed filters
    request.addfinalizer(lambda: spark.conf.set("spark.sql.maxMetadataStringLength", old))
    from tests.conftest import SF_SMALL
    def pushed(key):
        plan = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        return [x for x in plan.split("PushedFilters: ")[1:]]
    assert any("EqualTo(situacao_int,2)" in p for p in pushed("filter_active"))
    assert any("In(porte_int" in p for p in pushed("filter_size"))
    assert any("EqualTo(municipio_int,5403)" in p for p in pushed("health_leads"))
    assert any("EqualTo(matriz_int,1)" in p for p in pushed("mei_inactive_total"))


def test_one_requested_cnpj_scans_without_shuffling_sites(spark):
    from cadastra.plans import report as R
    from cadastra.sources.landing import landed_registry
    from tests.conftest import SF_SMALL
    cat = landed_registry(spark, SF_SMALL)
    key = cat.est.select(F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv")).first()[0]
    req = spark.createDataFrame([(key,), (key[:8] + "/9999-99",), ("12",), (None,)], "cnpj_input string")
    plan = R.matched_sites(cat, R.requested_keys(req))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "cnpj_basico" in plan.split("PushedFilters: ")[1]
    status = {(r["cnpj"], r["status"]) for r in R.cnpj_report(cat, req).collect()}
    assert {s for _, s in status} == {"found", "not found", "malformed"} and ("12", "malformed") in status
    absent = spark.createDataFrame([(key[:8] + "999999",)], "cnpj_input string")
    keys = R.requested_keys(absent)
    assert [R.sites_of(cat, keys).count(), R.partners_of(cat, keys).count(), R.simples_status(cat, keys).count()] == [0, 0, 0]


def test_lead_filter_validates_codes():
    import pytest
    from cadastra.plans.leads import LeadFilter
    assert LeadFilter(porte=[5, 3, 3]).porte == [3, 5]
    assert LeadFilter(porte=None).porte == [3, 5]
    with pytest.raises(ValueError):
        LeadFilter(porte=[2])
    with pytest.raises(ValueError):
        LeadFilter(situacao=[5])
    f = LeadFilter(uf=" mg ", municipio=" 5403 ", limit=0, cnae=0)
    assert (f.uf, f.municipio, f.municipio_is_code, f.limit, f.cnae) == ("MG", "5403", True, None, None)


def test_hot_key_third_of_rows_is_spread(spark):
    """One key holds a third of all fact rows: its rows stay where they are, and every task small."""
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "16"}
    saved = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        n = 30000
        fact = spark.range(0, n).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 997).cast("string")).alias("k"),
            F.col("id").alias("v"))
        dim = spark.range(0, 997).select(F.col("id").cast("string").alias("k"), F.lit("d").alias("d")) \
            .unionByName(spark.createDataFrame([("HOT", "h")], "k string, d string"))

        def max_share(df):
            counts = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(counts) / sum(counts)
        plain = fact_join(fact, [(dim, "inner")], "k", SkewPolicy(enabled=False))
        split = fact_join(fact, [(dim, "inner")], "k", SkewPolicy(hot_rows=1000))
        assert _sorted(plain) == _sorted(split)
        assert max_share(plain) >= 1 / 3
        assert max_share(split) < 0.2
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_sort_spreads_a_repeated_name(spark):
    from cadastra.operators.ordering import order_nulls_last
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    saved = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        df = spark.range(0, 30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("N"), F.col("id").cast("string")))
            .alias("razao_social"), F.lpad(F.col("id").cast("string"), 14, "0").alias("cnpj"))

        def max_share(d):
            counts = [r["count"] for r in d.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(counts) / sum(counts)
        assert max_share(order_nulls_last(df, ["razao_social"])) >= 1 / 3          # one key: one task
        assert max_share(order_nulls_last(df, ["razao_social", "cnpj"])) < 0.2    # tie-break splits it
        rows = order_nulls_last(df, ["razao_social", "cnpj"]).collect()
        assert rows[-1].razao_social is None and rows[0].razao_social is not None
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
