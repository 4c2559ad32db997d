"""Many files in few jobs, published at once; the stream over a mixed folder."""
import os
import time

import pytest
from pyspark.sql import functions as F

from cadastra.sources import snapshot as S
from cadastra.streaming.ingest_stream import run_folder_stream


def put(root, name, text):
    os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
    with open(f"{root}/{name}", "wb") as f:
        f.write(text.encode("latin1"))
    return f"{root}/{name}"


def rows(spark, out, base):
    df = S.read_snapshot(spark, out, base)
    return None if df is None else sorted(map(tuple, df.collect()), key=str)


def test_many_files_take_few_jobs(spark, tmp_dir):
    jobs = {}
    for n in (20, 600):
        root = f"{tmp_dir}/src{n}"
        for i in range(n):
            put(root, f"Cnaes{i}.csv", f'"{i}";"a{i}"\n"{i}x";"b"\n')
            if i % 4 == 0:
                put(root, f"outra{i}.csv", f"nome;valor\nn{i};v\n")
        spark.sparkContext.setJobGroup(f"many-{n}", "many")
        S.ingest_folder(spark, root, f"{tmp_dir}/out{n}")
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"many-{n}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(rows(spark, f"{tmp_dir}/out{n}", "cnaes")) == 2 * n and len(rows(spark, f"{tmp_dir}/out{n}", "")) == n // 4
        assert S.read_snapshot(spark, f"{tmp_dir}/out{n}", "").columns == ["nome", "valor"]
        _, live = S.live_sources(spark, f"{tmp_dir}/out{n}")
        assert live.select("dataset").distinct().count() == 2  # one a plan
    assert jobs[600] <= jobs[20] + 4 < 40


def test_changed_files_replace_their_rows_and_readers_keep_theirs(spark, tmp_dir):
    a = put(f"{tmp_dir}/src", "Cnaes1.csv", '"1";"old"\n')
    put(f"{tmp_dir}/src", "Cnaes2.csv", '"2";"stays"\n')
    out = f"{tmp_dir}/out"
    assert S.ingest_folder(spark, f"{tmp_dir}/src", out) == 1
    before = S.read_snapshot(spark, out, "cnaes")
    assert S.ingest_folder(spark, f"{tmp_dir}/src", out) == 1  # nothing is pending
    time.sleep(1.1)
    put(f"{tmp_dir}/src", "Cnaes1.csv", '"1";"newer"\n"1b";"more"\n')
    assert S.ingest_folder(spark, f"{tmp_dir}/src", out) == 2
    # a reader that began before the rewrite sees the old rows, one that begins now the new ones
    assert sorted(map(tuple, before.collect())) == [("1", "old"), ("2", "stays")]
    assert rows(spark, out, "cnaes") == [("1", "newer"), ("1b", "more"), ("2", "stays")]
    assert sorted(map(tuple, S.read_snapshot(spark, out, "cnaes", 1).collect())) == [("1", "old"), ("2", "stays")]
    assert os.path.exists(a) and S.read_snapshot(spark, out, "socios") is None


def test_an_unfinished_run_is_not_seen(spark, tmp_dir):
    put(f"{tmp_dir}/src", "Cnaes1.csv", '"1";"a"\n')
    out = f"{tmp_dir}/out"
    S.ingest_folder(spark, f"{tmp_dir}/src", out)
    os.makedirs(f"{out}/_snapshots/2")  # a snapshot without its mark of success
    os.makedirs(f"{out}/_snapshots/.half-2")
    assert S.live_sources(spark, out)[0] == 1 and rows(spark, out, "cnaes") == [("1", "a")]
    put(f"{tmp_dir}/src", "Cnaes2.csv", '"2";"b"\n')
    assert S.ingest_folder(spark, f"{tmp_dir}/src", out) == 2 and len(rows(spark, out, "cnaes")) == 2


def test_two_runs_at_a_time_lose_nothing(spark, tmp_dir, monkeypatch):
    put(f"{tmp_dir}/a", "Cnaes1.csv", '"1";"a"\n')
    put(f"{tmp_dir}/b", "Cnaes2.csv", '"2";"b"\n')
    out = f"{tmp_dir}/out"
    publish, other = S.publish, []

    def late(*a):  # the other run publishes between this run's write and its rename
        if not other:
            other.append(1)
            S.ingest_folder(spark, f"{tmp_dir}/b", out)
        publish(*a)
    monkeypatch.setattr(S, "publish", late)
    assert S.ingest_folder(spark, f"{tmp_dir}/a", out) == 2
    assert rows(spark, out, "cnaes") == [("1", "a"), ("2", "b")]


def test_failing_files_stand_alone(spark, tmp_dir, monkeypatch):
    for i in range(9):
        put(f"{tmp_dir}/src", f"Cnaes{i}.csv", f'"{i}";"a"\n')
    put(f"{tmp_dir}/src", "Cnaes-empty.csv", "\n\n")  # (files without a byte are not even listed)
    read = S.read_dump

    def broken(spark_, paths, *a, **kw):
        if any("Cnaes5" in p for p in paths):
            raise OSError("cannot read")
        return read(spark_, paths, *a, **kw)
    monkeypatch.setattr(S, "read_dump", broken)
    errors = []
    S.ingest_folder(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", errors=errors)
    assert sorted(e[1].rsplit("/", 1)[1] for e in errors) == ["Cnaes-empty.csv", "Cnaes5.csv"]
    assert [r[0] for r in rows(spark, f"{tmp_dir}/out", "cnaes")] == [str(i) for i in range(9) if i != 5]
    monkeypatch.setattr(S, "read_dump", read)
    with pytest.raises(OSError, match="no record"):  # the mended file is taken in, the empty one reported
        S.ingest_folder(spark, f"{tmp_dir}/src", f"{tmp_dir}/out")
    assert len(rows(spark, f"{tmp_dir}/out", "cnaes")) == 9


def test_multiline_files_of_both_sizes(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 200)
    put(f"{tmp_dir}/src", "Cnaes1.csv", '"1";"a\nb"\n')
    put(f"{tmp_dir}/src", "Cnaes2.csv", "".join(f'"{i}";"c\n\n;d"\n' for i in range(100)))
    S.ingest_folder(spark, f"{tmp_dir}/src", f"{tmp_dir}/out")
    found = rows(spark, f"{tmp_dir}/out", "cnaes")
    assert len(found) == 101 and ("1", "a\nb") in found and ("99", "c\n\n;d") in found


def test_a_replayed_batch_adds_nothing(spark, tmp_dir):
    put(f"{tmp_dir}/src", "Cnaes1.csv", '"1";"a"\n')
    put(f"{tmp_dir}/src", "x/lista.csv", "nome;valor\nn;v\n")
    out = f"{tmp_dir}/out"
    run_folder_stream(spark, f"{tmp_dir}/src", out, f"{tmp_dir}/cp")
    files = S.source_files(S.list_folder(spark, f"{tmp_dir}/src"))
    number, live = S.live_sources(spark, out)
    tags = {r[0] for r in live.select("tag").distinct().collect()}
    assert len(tags) == 1
    # the same batch again, with files that the snapshot holds as changed
    assert S.ingest_files(spark, files.withColumn("length", F.col("length") + 1), out, tag=tags.pop()) == number
    put(f"{tmp_dir}/src", "Cnaes2.csv", '"2";"b"\n')
    run_folder_stream(spark, f"{tmp_dir}/src", out, f"{tmp_dir}/cp")
    assert rows(spark, out, "cnaes") == [("1", "a"), ("2", "b")] and rows(spark, out, "") == [("n", "v")]
