"""Catalog loading (mandatory/optional bases), describe, CSV export bytes, stream ingest."""
import glob
import os

import pytest

from cadastra.sources.catalog import MissingTableError, describe, load_catalog
from cadastra.sources.export import export_csv, read_export


def test_catalog_mandatory_and_optional(spark, tmp_dir):
    df = spark.createDataFrame([("1", "x")], "cnpj_basico string, razao_social string")
    with pytest.raises(MissingTableError):
        load_catalog(spark, tmp_dir)
    df.write.parquet(f"{tmp_dir}/Empresas0.parquet")
    df.write.parquet(f"{tmp_dir}/Empresas1.parquet")
    spark.createDataFrame([("1", "0001")], "cnpj_basico string, cnpj_ordem string").write.parquet(
        f"{tmp_dir}/Estabelecimentos.parquet")
    cat = load_catalog(spark, tmp_dir)
    assert cat.emp.count() == 2 and cat.est.count() == 1 and not cat.has("simples")
    d = describe(spark, cat.tables, "empresas|estabelecimentos").collect()
    assert [(r.base, r.column_name, r.column_type) for r in d][:2] == [
        ("empresas", "cnpj_basico", "VARCHAR"), ("empresas", "razao_social", "VARCHAR")]


def test_export_bom_and_count(spark, tmp_dir):
    df = spark.createDataFrame([("1", None, ""), ("2", "a;b", "ç")], "cnpj string, b string, c string")
    n = export_csv(df, f"{tmp_dir}/out", single_file=True, sort_by=["cnpj"])
    assert n == 2
    files = glob.glob(f"{tmp_dir}/out/part-*.csv")
    assert len(files) == 1
    raw = open(files[0], "rb").read()
    assert raw.startswith("﻿cnpj;b;c".encode("utf-8"))
    assert b'"a;b"' in raw and b'1;;""' in raw
    back = sorted(tuple(r) for r in read_export(spark, f"{tmp_dir}/out").collect())
    assert back == [("1", None, None), ("2", "a;b", "ç")]


def _one_task(df, path, sort_by):
    """Bytes of the file that one task writes."""
    from pyspark.sql import functions as F

    from cadastra.sources.export import _OPTIONS, BOM
    order = [F.col(c).asc_nulls_last() for c in [*sort_by, *(c for c in df.columns if c not in sort_by)]]
    first = df.columns[0]
    (df.repartition(1).sortWithinPartitions(*order).withColumnRenamed(first, BOM + first)
     .write.options(**_OPTIONS, header="true").csv(path))
    (f,) = glob.glob(f"{path}/part-*.csv")
    return open(f, "rb").read()


@pytest.mark.parametrize("per_file", ["0", "700"])
def test_one_file_equals_that_of_one_task(spark, tmp_dir, monkeypatch, per_file):
    from pyspark.sql import functions as F

    from cadastra.sources import export
    monkeypatch.setattr(export, "COPY_RANGE", 1000)  # a part is copied by several tasks
    spark.conf.set("spark.sql.files.maxRecordsPerFile", per_file)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # one key holds a third of the rows; breaks, quotes, blanks, nulls and letters of several bytes
        df = spark.range(9000, numPartitions=7).select(
            F.when(F.col("id") % 3 == 0, "000").otherwise(F.format_string("%05d", F.col("id") * 7919 % 9000)).alias("key"),
            F.when(F.col("id") % 5 > 0, F.concat(F.lit(' ç"\n;'), F.col("id"))).alias("b"), (F.col("id") % 2).alias("c"))
        assert export_csv(df, f"{tmp_dir}/one", single_file=True, sort_by=["key"]) == 9000
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert not glob.glob(f"{tmp_dir}/one/_export-*")
    raw = open(f"{tmp_dir}/one/part-00000.csv", "rb").read()
    assert raw == _one_task(df, f"{tmp_dir}/plain", ["key"])
    # written again with other rows: the old file is gone
    assert export_csv(df.where("c = 7"), f"{tmp_dir}/one", single_file=True, sort_by=["key"]) == 0
    assert open(f"{tmp_dir}/one/part-00000.csv", "rb").read() == "\ufeffkey;b;c\n".encode()
    # over a folder of many parts; the order of the frame stays where none is asked for
    export_csv(df, f"{tmp_dir}/parts")
    kept = spark.range(100, numPartitions=9).select((F.lit(500) - F.col("id")).alias("n"))
    assert export_csv(kept, f"{tmp_dir}/parts", bom=False, single_file=True) == 100
    assert [os.path.basename(f) for f in glob.glob(f"{tmp_dir}/parts/part-*")] == ["part-00000.csv"]
    assert open(f"{tmp_dir}/parts/part-00000.csv").read().split() == ["n", *(str(500 - i) for i in range(100))]


def test_a_sorted_export_is_written_by_many_tasks(spark, tmp_dir, monkeypatch):
    from cadastra.sources import export
    seen = []
    join = export._copy_to_offsets
    monkeypatch.setattr(export, "_copy_to_offsets", lambda s, parts, target: (seen.extend(parts), join(s, parts, target)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_csv(spark.range(5000), f"{tmp_dir}/out", single_file=True, sort_by=["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = [length for _, length in seen[1:]]  # after the header
    assert len(rows) == 8 and max(rows) < sum(rows) / 4


def test_concatenation_takes_parts_in_order():
    from cadastra.sources.export import _concat

    class Store:
        files = {"h": b"k\n", "r/0": b"1\n", "r/10": b"3\n", "r/2": b"2\n"}

        def concat(self, target, sources):
            assert all(self.files[s] for s in sources)
            self.files[target] += b"".join(self.files.pop(s) for s in sources)

        def rename(self, a, b):
            self.files[b] = self.files.pop(a)
            return True

    store = Store()
    _concat(store, str, lambda _, n: [None] * n, [("h", 2), ("r/0", 2), ("r/2", 2), ("r/10", 2)], "t")
    assert store.files == {"t": b"k\n1\n2\n3\n"}
    _concat(store, str, lambda _, n: [None] * n, [("t", 8)], "u")  # a header alone
    assert list(store.files) == ["u"]


def test_ranges_cover_the_joined_file(monkeypatch):
    from cadastra.sources import export
    monkeypatch.setattr(export, "COPY_RANGE", 10)
    assert export.copy_ranges([("a", 3), ("b", 25), ("c", 10)]) == [
        ("a", 0, 3, 0), ("b", 0, 10, 3), ("b", 10, 10, 13), ("b", 20, 5, 23), ("c", 0, 10, 28)]


def test_stream_ingest_is_incremental(spark, tmp_dir):
    from cadastra.sources.dumps import write_dump
    from cadastra.streaming.ingest_stream import run_ingest_stream
    cols = ["codigo", "descricao"]
    a = spark.createDataFrame([("1", "A"), ("2", "NA")], "codigo string, descricao string")
    write_dump(a, f"{tmp_dir}/src/batch1")
    os.makedirs(f"{tmp_dir}/land", exist_ok=True)
    for f in glob.glob(f"{tmp_dir}/src/batch1/part-*.csv"):
        os.rename(f, f"{tmp_dir}/land/" + os.path.basename(f))
    run_ingest_stream(spark, f"{tmp_dir}/land", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", "cnaes")
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 2
    b = spark.createDataFrame([("3", "C")], ", ".join(f"{c} string" for c in cols))
    write_dump(b, f"{tmp_dir}/src/batch2")
    for f in glob.glob(f"{tmp_dir}/src/batch2/part-*.csv"):
        os.rename(f, f"{tmp_dir}/land/b2-" + os.path.basename(f))
    run_ingest_stream(spark, f"{tmp_dir}/land", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", "cnaes")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert got == [("1", "A"), ("2", None), ("3", "C")]


def test_stream_applies_dump_rules(spark, tmp_dir):
    from cadastra.streaming.ingest_stream import run_ingest_stream
    os.makedirs(f"{tmp_dir}/land", exist_ok=True)
    with open(f"{tmp_dir}/land/a.csv", "wb") as f:
        f.write('"1";"l1\nl2"\n"2";"NA"\n"3";"x";"extra"\n"4"\n"5";"São"\n'.encode("latin1"))
    run_ingest_stream(spark, f"{tmp_dir}/land", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", "cnaes")
    got = sorted((tuple(r) for r in spark.read.parquet(f"{tmp_dir}/out").collect()), key=repr)
    assert got == sorted([("1", "l1\nl2"), ("2", None), ("4", None), ("5", "São")], key=repr)


def test_schema_records_spare_the_footers(spark, tmp_dir):
    from cadastra.sources.catalog import scan_parts
    from cadastra.sources.parquet_io import write_parquet, write_parts
    from cadastra.sources.schemas import record_schemas, recorded_schema
    a = spark.createDataFrame([("1", "x")], "cnpj_basico string, razao_social string")
    write_parts(a, tmp_dir, "empresas", 2, "cnpj_basico")
    b = spark.createDataFrame([("y", "2", "z")], "razao_social string, cnpj_basico string, extra string")  # another order, one more
    write_parquet(b, f"{tmp_dir}/Empresas9.parquet")
    assert recorded_schema(spark, tmp_dir, "Empresas*.parquet") is None  # one part has no record: the parts decide
    assert set(scan_parts(spark, tmp_dir, "empresas").columns) == {"cnpj_basico", "razao_social", "extra"}
    record_schemas(spark, tmp_dir, {"Empresas9.parquet": b.schema})
    assert recorded_schema(spark, tmp_dir, "Empresas*.parquet").names == ["cnpj_basico", "razao_social", "extra"]
    # planning opens no file: damage every part and the plan is still made
    rows = sorted(map(tuple, scan_parts(spark, tmp_dir, "empresas").collect()), key=str)
    assert rows == [("1", "x", None), ("2", "y", "z")]
    for f in glob.glob(f"{tmp_dir}/Empresas*.parquet/part-*"):
        open(f, "wb").write(b"broken")
    assert scan_parts(spark, tmp_dir, "empresas").columns == ["cnpj_basico", "razao_social", "extra"]
    # a dataset that was written again by other means is not described by its old record
    import time
    time.sleep(1.1)
    write_parquet(a.withColumn("new", a.razao_social), f"{tmp_dir}/Empresas9.parquet")
    assert recorded_schema(spark, tmp_dir, "Empresas*.parquet") is None


def test_records_with_two_types_are_left_to_the_parts(spark):
    from cadastra.sources.schemas import merged
    s = [spark.createDataFrame([], ddl).schema for ddl in ("a string, b string", "b string, c string", "a int")]
    assert merged(s[:2]).names == ["a", "b", "c"] and merged(s) is None


def test_a_large_export_is_split_and_read_alike(spark, tmp_dir, monkeypatch):
    from cadastra.sources import dumps
    from cadastra.sources.records import read_records
    rows = [(f"nome\n\"{k}\"; ção" if k % 3 else "", None if k % 5 == 0 else f"v{k}") for k in range(400)]
    df = spark.createDataFrame(rows, "a string, b string")
    export_csv(df, f"{tmp_dir}/one", single_file=True, sort_by=["a"])
    whole = read_export(spark, f"{tmp_dir}/one")
    monkeypatch.setattr(dumps, "WHOLE_BYTES", 1000)
    monkeypatch.setattr("cadastra.sources.export.read_records", lambda s, p: read_records(s, p, 500))
    split = read_export(spark, f"{tmp_dir}/one")
    assert split.columns == whole.columns == ["a", "b"]
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect())) and split.count() == 400
    assert "from_csv" in split._jdf.queryExecution().optimizedPlan().toString().lower()
