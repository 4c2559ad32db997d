"""Landing: written once per state of its sources, published by rename, sorted files; curate refuses."""
import glob
import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cadastra.sources.catalog import Catalog, load_catalog
from cadastra.sources.landing import curate, landed_registry, publish, write_base
from cadastra.sources.registry import registry_view
from tests.conftest import SF_SMALL


def test_land_once_and_lose_a_race_cleanly(spark, tmp_dir):
    cat = landed_registry(spark, SF_SMALL, root=f"{tmp_dir}/land", bases=("municipios", "estabelecimentos"))
    root = glob.glob(f"{tmp_dir}/land/*")[0]
    assert {p.rsplit("/", 1)[-1] for p in glob.glob(f"{root}/*")} - {"_stats", "_index"} == {
        "Estabelecimentos.parquet", "Municipios.parquet"}
    assert glob.glob(f"{root}/Estabelecimentos.parquet/uf_norm=MG/*.parquet")
    before = cat.mun.count()
    # a second session finishing later publishes onto the existing folder: its copy is dropped
    tmp = f"{root}/Municipios.parquet.tmp-late"
    write_base(registry_view(spark, SF_SMALL, "municipios"), tmp, "municipios")
    publish(spark, tmp, f"{root}/Municipios.parquet")
    assert not glob.glob(f"{root}/*tmp*") and not glob.glob(f"{root}/Municipios.parquet/*tmp*")
    assert spark.read.parquet(f"{root}/Municipios.parquet").count() == before


def test_an_unfinished_folder_is_replaced(spark, tmp_dir):
    df = spark.createDataFrame([(str(i), "x") for i in range(5)], "codigo string, descricao string")
    os.makedirs(f"{tmp_dir}/M.parquet")
    df.limit(1).write.mode("overwrite").parquet(f"{tmp_dir}/M.parquet")
    os.remove(f"{tmp_dir}/M.parquet/_SUCCESS")
    write_base(df, f"{tmp_dir}/tmp", "municipios")
    publish(spark, f"{tmp_dir}/tmp", f"{tmp_dir}/M.parquet")
    assert spark.read.parquet(f"{tmp_dir}/M.parquet").count() == 5


def test_changed_sources_are_landed_anew(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/sf")
    for t in ("nation", "supplier"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{tmp_dir}/sf")
    land = lambda: landed_registry(spark, f"{tmp_dir}/sf", root=f"{tmp_dir}/land", bases=("municipios",)).mun.count()
    assert land() == land() == 25
    rows = pq.read_table(f"{tmp_dir}/sf/nation.parquet").slice(0, 7)
    os.chmod(f"{tmp_dir}/sf/nation.parquet", 0o644)
    pq.write_table(rows, f"{tmp_dir}/sf/nation.parquet")
    assert land() == 7


def test_curate_refuses_a_used_folder(spark, tmp_dir):
    df = spark.createDataFrame([("1", "x"), ("2", "y")], "codigo string, descricao string")
    cat = Catalog({"municipios": df, "cnaes": None})
    assert curate(spark, cat, f"{tmp_dir}/c").mun.count() == 2
    with pytest.raises(FileExistsError):
        curate(spark, cat, f"{tmp_dir}/c")


def test_files_are_sorted_and_buckets_follow_the_rows(spark, tmp_dir):
    est = registry_view(spark, SF_SMALL, "estabelecimentos")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small buckets stay apart
    try:
        write_base(est, f"{tmp_dir}/E.parquet", "estabelecimentos", rows_per_file=100)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = glob.glob(f"{tmp_dir}/E.parquet/uf_norm=*/*.parquet")
    assert len(files) > 4
    for f in files:
        keys = pq.ParquetFile(f).read(["cnpj_basico"]).column(0).to_pylist()
        assert keys == sorted(keys)
    assert spark.read.parquet(f"{tmp_dir}/E.parquet").count() == est.count()


def test_a_broken_table_is_not_an_absent_one(spark, tmp_dir):
    df = spark.createDataFrame([("1", "x")], "cnpj_basico string, razao_social string")
    df.write.parquet(f"{tmp_dir}/Empresas.parquet")
    df.write.parquet(f"{tmp_dir}/Estabelecimentos.parquet")
    with pytest.warns(UserWarning, match="simples"):
        assert not load_catalog(spark, tmp_dir).has("simples")
    os.makedirs(f"{tmp_dir}/Simples.parquet")
    with pytest.raises(Exception):
        load_catalog(spark, tmp_dir)
    with open(f"{tmp_dir}/Simples.parquet/part-0.parquet", "wb") as f:
        f.write(b"damaged")
    with pytest.raises(Exception):
        load_catalog(spark, tmp_dir)


def test_equal_dataset_names_stay_apart_and_failures_are_told(spark, tmp_dir):
    from cadastra.sources.parquet_io import clean_dataset, rename_dataset
    paths = []
    for k, month in enumerate(("06", "07")):
        df = spark.createDataFrame([(f"- NOME {k} -", None)], "nome_socio_ou_razao_social string, nome_representante string")
        df.write.parquet(f"{tmp_dir}/src/{month}/Socios0.parquet")
        paths.append(f"file:{tmp_dir}/src/{month}/Socios0.parquet")
    os.makedirs(f"{tmp_dir}/src/08/Socios0.parquet")
    paths.append(f"file:{tmp_dir}/src/08/Socios0.parquet")
    for work in (clean_dataset, rename_dataset):
        errors = []
        out = work(spark, paths, f"{tmp_dir}/{work.__name__}", src_root=f"{tmp_dir}/src", errors=errors)
        assert set(out) == {"06/Socios0.parquet", "07/Socios0.parquet"}
        assert sum(spark.read.parquet(p).count() for p in out.values()) == 2
        assert [name for name, _ in errors] == ["08/Socios0.parquet"]
        with pytest.raises(ValueError):
            work(spark, paths, f"{tmp_dir}/x")


def test_no_private_folder_off_local_mode():
    from cadastra.session import checkpoint_root

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "yarn"}.get(key, default))
    with pytest.raises(RuntimeError):
        checkpoint_root(Cluster)


def test_a_task_holds_one_bucket_of_a_state(spark, tmp_dir):
    est = registry_view(spark, SF_SMALL, "estabelecimentos")
    write_base(est, f"{tmp_dir}/E.parquet", "estabelecimentos", rows_per_file=100)
    states = dict(est.groupBy(F.upper("uf")).count().collect())
    for uf, rows in states.items():
        held = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_dir}/E.parquet/uf_norm={uf}/*.parquet")]
        assert len(held) == -(-rows // 100) and max(held) < 200 and sum(held) == rows


def test_states_missing_or_many_are_landed_whole(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr("cadastra.sources.landing.MAX_SMALL_STATES", 3)
    est = spark.range(60).select(F.col("id").cast("string").alias("cnpj_basico"),
                                 F.when(F.col("id") < 40, F.concat(F.lit("s"), "id")).alias("uf"))
    for name, df in (("many", est), ("none", est.where("false"))):
        write_base(df, f"{tmp_dir}/{name}", "estabelecimentos", rows_per_file=50)
    back = spark.read.schema("cnpj_basico string, uf string").parquet(f"{tmp_dir}/many").select("cnpj_basico", "uf")
    assert sorted(map(str, back.collect())) == sorted(map(str, est.collect()))
    tasks = {f.rsplit("/", 1)[1].split("-")[1] for f in glob.glob(f"{tmp_dir}/many/*/*.parquet")}
    assert len(tasks) <= 5
