"""Zip archives of the registry dumps.

Each archive is handled by one task (``mapInPandas`` over a DataFrame of archive paths): the task
lists the members, chooses one, and streams it into a landing folder in 1 MiB blocks — an
archive member is never held in memory whole. Spark's CSV reader then parses the landed files
in parallel (see ``sources.dumps``). Member choice, in order: a name ending in ``csv``/``txt``,
else a name containing ``csv``, else the largest member.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import uuid
import zipfile
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMBER_SCHEMA = "archive string, member string, member_bytes long, failure string"
LANDED_SCHEMA = "archive string, member string, member_bytes long, landed string, failure string"
BLOCK = 1 << 20


def member_rank(info: zipfile.ZipInfo, position: int) -> tuple:
    """Preference among the members of an archive, best first."""
    name = info.filename.lower()
    if name.endswith(("csv", ".txt")):
        return 0, position
    if "csv" in name:
        return 1, position
    return 2, -info.file_size, position


def choose_member(infos: list[zipfile.ZipInfo]) -> zipfile.ZipInfo | None:
    files = [(member_rank(info, k), info) for k, info in enumerate(infos) if not info.is_dir()]
    return min(files, key=lambda f: f[0])[1] if files else None


def _open(path: str):
    from pyarrow import fs as pafs
    filesystem, inner = pafs.FileSystem.from_uri(path)
    return filesystem, inner


def _size(fs, path: str) -> int | None:
    from pyarrow import fs as pafs
    info = fs.get_file_info(path)
    return info.size if info.type == pafs.FileType.File else None


def _write_atomically(out_fs, target: str, fill) -> None:
    """Write through a unique temporary name, then move into place: a retried or speculative
    task never leaves a half-written file under the final name."""
    out_fs.create_dir(os.path.dirname(target), recursive=True)
    tmp = f"{target}.{uuid.uuid4().hex}.tmp"
    with out_fs.open_output_stream(tmp) as dst:
        fill(dst)
    if _size(out_fs, target) is not None:
        out_fs.delete_file(target)
    out_fs.move(tmp, target)


def _handled(batches, columns: list[str], handle):
    """One row per archive from ``handle(path)``; a bad archive's row holds its failure instead."""
    for pdf in batches:
        rows = []
        for p in pdf["path"]:
            try:
                rows.append((p, *handle(p), None))
            except (OSError, ValueError, zipfile.BadZipFile, EOFError, RuntimeError, zlib.error) as e:
                rows.append((p, *[None] * (len(columns) - 2), f"{type(e).__name__}: {e}"[:500]))
        yield pd.DataFrame(rows, columns=columns)


def _member_of(path: str) -> tuple:
    filesystem, inner = _open(path)
    with filesystem.open_input_file(inner) as f, zipfile.ZipFile(f) as z:
        m = choose_member(z.infolist())
        return (m.filename, m.file_size) if m else (None, None)


def zip_members(archives: DataFrame, path: str = "path") -> DataFrame:
    """The member each archive contributes; ``failure`` says why an archive could not be read."""
    columns = ["archive", "member", "member_bytes", "failure"]
    return archives.select(F.col(path).alias("path")).mapInPandas(
        lambda batches: _handled(batches, columns, _member_of), MEMBER_SCHEMA)


def landed_folder(archive: str) -> str:
    """Folder of an archive's member: its stem, told apart by a hash of the whole path, so that
    archives of one name in two folders do not meet."""
    stem = archive.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    return f"{stem}-{hashlib.sha1(archive.encode()).hexdigest()[:10]}"


def _landing(landing: str):
    def land(path: str) -> tuple:
        filesystem, inner = _open(path)
        with filesystem.open_input_file(inner) as f, zipfile.ZipFile(f) as z:
            m = choose_member(z.infolist())
            if m is None:
                return None, None, None
            name = os.path.basename(m.filename)
            name = name if name.lower().endswith(".csv") else name + ".csv"
            target = f"{landing.rstrip('/')}/{landed_folder(path)}/{name}"
            out_fs, out_inner = _open(target)

            def fill(dst):
                with z.open(m) as src:
                    shutil.copyfileobj(src, dst, BLOCK)
            _write_atomically(out_fs, out_inner, fill)
            return m.filename, m.file_size, target
    return land


def extract_members(archives: DataFrame, landing: str, path: str = "path") -> DataFrame:
    """Stream each archive's chosen member to ``{landing}/{archive stem}-{hash of its path}/{member}.csv``.
    Every given archive is extracted anew (choosing what is pending is the manifest's work); the result
    lists what was landed, and why a bad archive was not."""
    columns = ["archive", "member", "member_bytes", "landed", "failure"]
    land = _landing(landing)
    return archives.select(F.col(path).alias("path")).mapInPandas(
        lambda batches: _handled(batches, columns, land), LANDED_SCHEMA)


def _pack(target_root: str, member_name: str):
    def run(batches):
        for pdf in batches:
            rows = []
            for p in pdf["path"]:
                filesystem, inner = _open(p)
                stem = os.path.basename(os.path.dirname(inner)) + "-" + os.path.basename(inner).split(".")[0]
                target = f"{target_root.rstrip('/')}/{stem}.zip"
                out_fs, out_inner = _open(target)

                def fill(raw, filesystem=filesystem, inner=inner):
                    with zipfile.ZipFile(raw, "w", compression=zipfile.ZIP_DEFLATED) as z, \
                            z.open(member_name, "w", force_zip64=True) as dst, \
                            filesystem.open_input_stream(inner) as src:
                        shutil.copyfileobj(src, dst, BLOCK)
                _write_atomically(out_fs, out_inner, fill)
                rows.append((p, target))
            yield pd.DataFrame(rows, columns=["source", "archive"])
    return run


def pack_files(files: DataFrame, target_root: str, member_name: str, path: str = "path") -> DataFrame:
    """Zip each file into its own archive under ``target_root`` (one task per file, streamed)."""
    return (files.select(F.col(path).alias("path"))
            .mapInPandas(_pack(target_root, member_name), "source string, archive string"))
