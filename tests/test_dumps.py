"""Raw dump reading rules (FIXTURES.md §3): NULL tokens, short/long rows, quotes, latin1."""
import os

from cadastra.sources.dumps import read_dump, render_lines, write_dump

NAMES = ["a", "b", "c"]


def _write(path, lines, encoding="latin1"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part.csv"), "wb") as f:
        f.write(("\n".join(lines) + "\n").encode(encoding))
    return path


def _rows(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: [x or "" for x in r])


def test_null_tokens(spark, tmp_dir):
    p = _write(f"{tmp_dir}/d", ['"1";"";"x"', '"2";;"x"', '"3";"NA";"null"', '"4";"none";"Null"'])
    assert _rows(read_dump(spark, p, NAMES)) == [("1", None, "x"), ("2", None, "x"), ("3", None, None),
                                                ("4", "none", "Null")]


def test_short_padded_long_dropped(spark, tmp_dir):
    p = _write(f"{tmp_dir}/d", ['"1";"a"', '"2";"a";"b";"z"', '"3";"a";"b";""', '"4";"a;b";"c"'])
    assert _rows(read_dump(spark, p, NAMES)) == [("1", "a", None), ("4", "a;b", "c")]


def test_quoted_newline_and_quotes(spark, tmp_dir):
    p = _write(f"{tmp_dir}/d", ['"1";"l1', 'l2";"say ""hi"""', '"2";"x";"y"'])
    assert _rows(read_dump(spark, p, NAMES)) == [("1", "l1\nl2", 'say "hi"'), ("2", "x", "y")]


def test_latin1(spark, tmp_dir):
    p = _write(f"{tmp_dir}/d", ['"1";"São";"Clínica"'])
    assert _rows(read_dump(spark, p, NAMES)) == [("1", "São", "Clínica")]


def test_writer_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("1", "a;b", 'q"q'), ("2", None, "ã")], "a string, b string, c string")
    write_dump(df, f"{tmp_dir}/w")
    assert _rows(read_dump(spark, f"{tmp_dir}/w", NAMES)) == [("1", "a;b", 'q"q'), ("2", None, "ã")]
    line = df.select(render_lines(df).alias("l")).orderBy("l").first()[0]
    assert line == '"1";"a;b";"q""q"'


def test_ingest_directory_incremental_and_isolated(spark, tmp_dir):
    from cadastra.sources.ingest import ingest_directory
    a = spark.createDataFrame([("1", "A"), ("2", "B")], "codigo string, descricao string")
    write_dump(a, f"{tmp_dir}/src/Cnaes")
    errors = []
    out = ingest_directory(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", errors=errors)
    assert errors == [] and spark.read.parquet(out["cnaes"]).count() == 2
    # a second run finds nothing pending and writes nothing new
    assert ingest_directory(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", errors=errors) == {}
    assert spark.read.parquet(out["cnaes"]).count() == 2
    # a new file is picked up on the next run
    write_dump(spark.createDataFrame([("3", "C")], "codigo string, descricao string"), f"{tmp_dir}/src/Cnaes2")
    ingest_directory(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", errors=errors)
    assert spark.read.parquet(out["cnaes"]).count() == 3


def test_multiline_detection_and_bad_row_counts(spark, tmp_dir):
    import warnings as w
    from pyspark.sql import Observation
    from cadastra.sources.dumps import multiline_files
    from cadastra.sources.ingest import ingest_directory
    a = _write(f"{tmp_dir}/src/Cnaes1", ['"1";"plain"', '"2";"say ""hi"""'])
    b = _write(f"{tmp_dir}/src/Cnaes2", ['"3";"l1', 'l2"', '"4";"x";"extra"'])
    flags = {r.path.rsplit("/", 2)[-2]: r.multiline
             for r in multiline_files(spark, [a + "/part.csv", b + "/part.csv"]).collect()}
    assert flags == {"Cnaes1": False, "Cnaes2": True}
    obs = Observation("t")
    df = read_dump(spark, b, ["codigo", "descricao"], observation=obs)
    assert _rows(df) == [("3", "l1\nl2")] and obs.get["long_rows"] == 1
    with w.catch_warnings(record=True) as caught:
        w.simplefilter("always")
        out = ingest_directory(spark, f"{tmp_dir}/src", f"{tmp_dir}/out")
    assert sorted(tuple(r) for r in spark.read.parquet(out["cnaes"]).collect()) == [
        ("1", "plain"), ("2", 'say "hi"'), ("3", "l1\nl2")]
    assert any("too many fields" in str(c.message) for c in caught)


def _dump(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode("latin1"))


def _ingested(spark, root, base=""):
    from cadastra.sources.ingest import dataset_of
    return {os.path.basename(os.path.dirname(p)): spark.read.parquet(dataset_of(f"{root}/out", base, p))
            for p in (f"file:{d}/{n}" for d, _, names in os.walk(f"{root}/src") for n in names)
            if os.path.exists(dataset_of(f"{root}/out", base, p).removeprefix("file:"))}


def test_every_file_keeps_its_own_columns(spark, tmp_dir):
    from cadastra.sources.ingest import ingest_directory
    _dump(f"{tmp_dir}/src/a/x.csv", '"1";"2"\n"3";"4"\n')
    _dump(f"{tmp_dir}/src/b/x.csv", '"5";"6";"7"\n')
    _dump(f"{tmp_dir}/src/c/x.csv", 'id;nome\n1;ana\n9;x;EXTRA\n')
    _dump(f"{tmp_dir}/src/d/x.csv", 'nome;id\nbia;2\nso;\n')
    out = ingest_directory(spark, f"{tmp_dir}/src", f"{tmp_dir}/out")
    assert list(out) == [""]
    got = {k: ([*df.columns], _rows(df)) for k, df in _ingested(spark, tmp_dir).items()}
    assert got == {"a": (["col_00", "col_01"], [("1", "2"), ("3", "4")]), "b": (["col_00", "col_01", "col_02"], [("5", "6", "7")]),
                   "c": (["id", "nome"], [("1", "ana")]), "d": (["nome", "id"], [("bia", "2"), ("so", None)])}


def test_first_record_with_a_newline(spark, tmp_dir):
    from cadastra.sources.ingest import ingest_directory
    row = lambda k, name: ";".join(f'"{x}"' for x in [k, name, "2062", "05", "1,00", "05", ""])
    _dump(f"{tmp_dir}/src/Empresas0.csv", "\n".join([row("00000001", "ACME\nLTDA"), row("00000002", "B"), row("00000003", "C")]) + "\n")
    out = ingest_directory(spark, f"{tmp_dir}/src", f"{tmp_dir}/out")
    df = spark.read.parquet(out["empresas"])
    assert df.columns[:2] == ["cnpj_basico", "razao_social"] and df.count() == 3
    assert df.where("cnpj_basico = '00000001'").first()["razao_social"] == "ACME\nLTDA"


def test_long_first_record_is_read_to_its_end(tmp_dir):
    import io
    from cadastra.sources.dumps import first_record, split_record
    text = '"' + "x" * 300_000 + "\n" * 5 + '";"b"'
    record = first_record(io.BytesIO((text + '\r\n"2";"c"\n').encode()))
    assert record == text and len(split_record(record)) == 2


def test_a_bad_file_stops_no_other_and_is_retried(spark, tmp_dir):
    from cadastra.sources.ingest import ingest_directory
    for name in ("Cnaes1", "Cnaes2"):
        _dump(f"{tmp_dir}/src/{name}.csv", f'"1";"{name}"\n')
    _dump(f"{tmp_dir}/src/Cnaes0.csv", "\n")
    errors = []
    out = ingest_directory(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", errors=errors)
    assert [(b, os.path.basename(p)) for b, p, _ in errors] == [("cnaes", "Cnaes0.csv")]
    assert spark.read.parquet(out["cnaes"]).count() == 2
    _dump(f"{tmp_dir}/src/Cnaes0.csv", '"2";"late"\n')
    ingest_directory(spark, f"{tmp_dir}/src", f"{tmp_dir}/out")
    assert spark.read.parquet(out["cnaes"]).count() == 3


def test_lost_manifest_leaves_no_duplicates(spark, tmp_dir):
    import shutil
    from cadastra.sources.ingest import MANIFEST, ingest_directory
    _dump(f"{tmp_dir}/src/Cnaes1.csv", '"1";"A"\n')
    out = ingest_directory(spark, f"{tmp_dir}/src", f"{tmp_dir}/out")
    shutil.rmtree(f"{tmp_dir}/out/{MANIFEST}")
    _dump(f"{tmp_dir}/src/Cnaes2.csv", '"2";"B"\n')
    ingest_directory(spark, f"{tmp_dir}/src", f"{tmp_dir}/out")
    assert _rows(spark.read.parquet(out["cnaes"])) == [("1", "A"), ("2", "B")]
