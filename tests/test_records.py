"""Records of multi-line dumps over many blocks, held against the csv module and Spark's multi-line mode."""
import csv
import io
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from cadastra.sources import dumps as D
from cadastra.sources.parquet_io import normalize_names
from cadastra.sources.records import BLOCK_BYTES, MAX_SMALL_BLOCKS, block_size, ends_open, first_record_lines, open_blocks, read_records


def by_csv(data: bytes) -> list[list[str]]:
    return [r for r in csv.reader(io.StringIO(data.decode("latin1"), newline=""), delimiter=";") if r]


def random_dump(rng, rows, wild=False):
    out = []
    for i in range(rows):
        fields = [f"{i}"]
        for _ in range(2):
            text = "".join(rng.choice(["a", "b", ";", "\n", '"', "ã", " ", "\n\n", "xyz"]) for _ in range(rng.randint(0, 12)))
            kind = rng.random()
            if kind < 0.6:
                fields.append('"' + text.replace('"', '""') + '"')
            elif kind < 0.8 or not wild:
                fields.append("".join(c for c in text if c not in ';\n"'))
            else:  # quotes that open nothing
                fields.append("q" + text.replace(";", "").replace("\n", ""))
        out.append(";".join(fields))
    return ("\n".join(out) + "\n").encode("latin1")


def test_a_line_ends_open_as_the_csv_module_sees_it():
    rng = random.Random(1)
    for _ in range(20_000):
        line = "".join(rng.choice(['"', ";", "a", '""', " "]) for _ in range(rng.randint(0, 12)))
        for begins in (False, True):
            rows = by_csv((("p;\"o" if begins else "p;") + line + "\nZ;Z\n").encode())
            assert ends_open(line.encode(), begins) == (len(rows) == 1), (line, begins)


@pytest.mark.parametrize("block", [64, 1000, 1 << 20])
@pytest.mark.parametrize("wild", [False, True])
def test_records_are_those_of_the_csv_module(spark, tmp_dir, block, wild):
    rng = random.Random(block)
    os.makedirs(f"{tmp_dir}/d")
    want = []
    for k in range(3):
        data = random_dump(rng, 120, wild)
        if k == 2:
            data = b"\n\n" + data.rstrip(b"\n") + b'\n"open;\nuntil\nthe end'
        with open(f"{tmp_dir}/d/f{k}.csv", "wb") as f:
            f.write(data)
        want += by_csv(data)
    records = [bytes(r["data"]) for r in read_records(spark, f"{tmp_dir}/d", block).collect()]
    got = [by_csv(r + b"\n")[0] if not r.startswith(b'"open') else [r[1:].decode()] for r in records]
    assert sorted(got) == sorted(want)


def test_equal_to_the_multiline_read(spark, tmp_dir):
    rng = random.Random(9)
    os.makedirs(f"{tmp_dir}/d")
    for k in range(2):
        with open(f"{tmp_dir}/d/f{k}.csv", "wb") as f:
            f.write(b"id;um;dois\n" + random_dump(rng, 300) + b'1;2\n3;"a\nb";c;too long\n4;NA;"x"\n')
    for header in (False, True):
        a, b = (D.read_dump(spark, f"{tmp_dir}/d", ["a", "b", "c"], header=header, multiline=m, block_bytes=97) for m in (True, "split"))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_one_file_is_read_by_many_tasks(spark, tmp_dir):
    rng = random.Random(2)
    with open(f"{tmp_dir}/one.csv", "wb") as f:
        f.write(random_dump(rng, 4000))
    whole = D.read_dump(spark, f"{tmp_dir}/one.csv", ["a", "b", "c"])
    split = read_records(spark, f"{tmp_dir}/one.csv", 4096)
    assert whole.rdd.getNumPartitions() == 1 and split.select("block").distinct().count() > 15
    assert split.count() == len(whole.collect())


def test_carriage_returns_and_blank_lines(spark, tmp_dir):
    with open(f"{tmp_dir}/f.csv", "wb") as f:
        f.write(b'\r\n1;"a\r\nb"\r\n\r\n2;c\r\n')
    rows = D.read_dump(spark, f"{tmp_dir}/f.csv", ["a", "b"], multiline="split", block_bytes=5).collect()
    assert sorted(map(tuple, rows)) == [("1", "a\r\nb"), ("2", "c")]


def test_states_are_applied_in_order(spark):
    # identity, then a block that swaps, one that always opens, one that always closes
    states = [(1, 0, False, True), (1, 10, True, False), (1, 20, True, False), (1, 30, True, True), (1, 40, False, False), (1, 50, False, True),
              (2, 0, True, True), (2, 10, False, True)]
    df = spark.createDataFrame(states[::-1], "file long, block long, if_closed boolean, if_opened boolean")
    assert sorted(map(tuple, open_blocks(df).collect())) == [(1, 20), (1, 40), (2, 10)]


def test_first_records():
    first = lambda data: D.first_record(io.BytesIO(data))
    assert first(b'\n\r\n1;"a\nb";2\n3;4\n') == '1;"a\nb";2'
    assert first(b'1;5" pipe;x\n2;y\n') == '1;5" pipe;x'  # a quote inside an unquoted field opens nothing
    assert first(b"") == "" and first(b"\n\n") == ""
    class Counted(io.BytesIO):
        taken = 0
        def readinto(self, b):
            n = super().readinto(b)
            Counted.taken += n
            return n
    D.first_record(Counted(b'1;5" pipe\n' + b"2;x\n" * 1_000_000))
    assert Counted.taken <= 2 * D.BLOCK
    t = time.time()
    assert len(first(b'"' + b"\n" * 3_000_000 + b'";x\n')) == 3_000_004
    assert time.time() - t < 6
    assert first_record_lines(iter([b"a\n", b"b\n"])) == [b"a\n"]


def test_wide_records_are_counted_in_linear_time(spark):
    wide = ['"' + '";"'.join("x;y" for _ in range(n)) + '"' for n in (1, 4_000, 100_000)]
    t = time.time()
    got = spark.createDataFrame([(w,) for w in wide], "raw string").select(D.count_fields("raw")).collect()
    assert [r[0] for r in got] == [1, 4_000, 100_000] and time.time() - t < 10
    rng = random.Random(3)
    rows = ["".join(rng.choice(['"', ";", "a", '""', ' "']) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    want = [len((by_csv(r.encode()) or [[""]])[0]) for r in rows]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, raw string").select("i", D.count_fields("raw").alias("n"))
    assert [r["n"] for r in df.orderBy("i").collect()] == want


def test_a_wide_row_is_dropped_and_nothing_crashes(spark, tmp_dir):
    with open(f"{tmp_dir}/w.csv", "w") as f:
        f.write('"1";"a";"b"\n' + ";".join(['"x"'] * 5000) + '\n"2";"c"\n')
    for mode in (True, False, "split"):
        assert sorted(map(tuple, D.read_dump(spark, f"{tmp_dir}/w.csv", ["a", "b", "c"], multiline=mode).collect())) == [
            ("1", "a", "b"), ("2", "c", None)]


def test_names_are_free():
    assert D.header_names(["a", "a.1", "a"]) == ["a", "a.1", "a.2"]
    assert D.header_names(["a", "a", "a.1"]) == ["a", "a.2", "a.1"]
    assert D.header_names(["Nome", "nome", ""]) == ["Nome", "nome.1", "Unnamed: 2"]
    assert normalize_names(["a", "a_2", "a"]) == ["a", "a_2", "a_3"] and normalize_names(["a", "a", "a"]) == ["a", "a_2", "a_3"]
    assert len(set(normalize_names(["a", "a", "a_2", "a_2", "a"]))) == 5


def test_a_file_with_a_blank_first_line_is_ingested(spark, tmp_dir):
    from cadastra.sources.ingest import ingest_directory
    os.makedirs(f"{tmp_dir}/src")
    with open(f"{tmp_dir}/src/Cnaes.csv", "w") as f:
        f.write('\n"1";"um"\n"2";"dois"\n')
    with open(f"{tmp_dir}/src/Outra.csv", "w") as f:
        f.write('\na;a.1;a\n1;2;3\n')
    out = ingest_directory(spark, f"{tmp_dir}/src", f"{tmp_dir}/out")
    assert sorted(map(tuple, spark.read.parquet(out["cnaes"]).collect())) == [("1", "um"), ("2", "dois")]
    other = spark.read.parquet(out[""])
    assert other.columns == ["a", "a.1", "a.2"] and [tuple(r) for r in other.collect()] == [("1", "2", "3")]


def test_blocks_grow_where_they_would_be_too_many_tasks():
    assert block_size(10 << 20, 1 << 17) == 1 << 17  # few enough
    assert block_size(16 << 30, 1 << 17) == -(-(16 << 30) // MAX_SMALL_BLOCKS)
    assert block_size(1 << 50, 1 << 17) == BLOCK_BYTES
    assert block_size(1 << 30, 256 << 20) == 256 << 20


def test_small_blocks_are_bounded_and_lose_nothing(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr("cadastra.sources.records.MAX_SMALL_BLOCKS", 10)
    data = random_dump(random.Random(4), 2000)
    with open(f"{tmp_dir}/one.csv", "wb") as f:
        f.write(data)
    records = read_records(spark, f"{tmp_dir}/one.csv", 64)
    assert 5 < records.select("block").distinct().count() <= 10
    assert records.count() == len(by_csv(data))


def test_a_large_file_is_split_and_read_alike(spark, tmp_dir, monkeypatch):
    rng = random.Random(9)
    os.makedirs(f"{tmp_dir}/d")
    for k, n in enumerate((300, 3)):
        with open(f"{tmp_dir}/d/f{k}.csv", "wb") as f:
            f.write(b"id;um;dois\n" + random_dump(rng, n) + b'1;2\n3;"a\nb";c;too long\n4;NA;"x"\n')
    for header in (False, True):
        read = lambda: D.read_dump(spark, f"{tmp_dir}/d", ["a", "b", "c"], header=header, block_bytes=97)
        whole = read()
        with monkeypatch.context() as m:
            m.setattr(D, "WHOLE_BYTES", 1000)
            split = read()
            assert "Union" in split._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))


def test_large_files_of_single_lines_are_read_by_lines(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(D, "WHOLE_BYTES", 100)
    os.makedirs(f"{tmp_dir}/d")
    held = {"small": b'"1";"x\ny"\n', "lines": b'"1";"say ""hi"";"\na"b;c\n;""\n' * 20,
            # quotes inside unquoted text do not count: two of them, and the record goes on
            "spans": b'a"b;"c\nd"e;"f"\n' * 20}
    for name, data in held.items():
        with open(f"{tmp_dir}/d/{name}.csv", "wb") as f:
            f.write(data)
    small, lines, spans = D.by_size(spark, f"{tmp_dir}/d")
    assert [[os.path.basename(u) for u in k] for k in (small, lines, spans)] == [["small.csv"], ["lines.csv"], ["spans.csv"]]
    rows = sorted(map(str, D.read_dump(spark, f"{tmp_dir}/d", ["a", "b", "c"]).collect()))
    monkeypatch.setattr(D, "WHOLE_BYTES", 1 << 20)
    assert rows == sorted(map(str, D.read_dump(spark, f"{tmp_dir}/d", ["a", "b", "c"]).collect()))
