"""Zip member choice and extraction; link resolution against the page URL."""
import os
import zipfile
from urllib.parse import urljoin

import pytest

from cadastra.sources.archives import choose_member, extract_members, zip_members
from cadastra.sources.links import extract_links, resolve


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members:
            if name.endswith("/"):
                z.writestr(zipfile.ZipInfo(name), "")
            else:
                z.writestr(name, data)
    return path


@pytest.mark.parametrize("members,chosen", [
    ([("readme.md", "x"), ("K3241.ESTABELE.CSV", "a;b")], "K3241.ESTABELE.CSV"),
    ([("dir/", ""), ("data.txt", "a;b")], "data.txt"),
    ([("F.K03200$Z.D50712.CNAECSV", "a;b"), ("other.bin", "zz")], "F.K03200$Z.D50712.CNAECSV"),
    ([("x.csv.gz.part", "a"), ("y.bin", "bb")], "x.csv.gz.part"),
    ([("small.bin", "a"), ("big.bin", "bbbbbb")], "big.bin"),
])
def test_choose_member(tmp_dir, members, chosen):
    p = _zip(os.path.join(tmp_dir, "a.zip"), members)
    with zipfile.ZipFile(p) as z:
        assert choose_member(z.infolist()).filename == chosen


def test_extract_streams_member(spark, tmp_dir):
    a = _zip(os.path.join(tmp_dir, "Cnaes.zip"), [("F.K03200$Z.D50712.CNAECSV", '"1";"A"\n"2";"B"\n')])
    b = _zip(os.path.join(tmp_dir, "Empty.zip"), [("dir/", "")])
    paths = spark.createDataFrame([(f"file:{a}",), (f"file:{b}",)], "path string")
    got = {r.archive.rsplit("/", 1)[-1]: r.member for r in zip_members(paths).collect()}
    assert got == {"Cnaes.zip": "F.K03200$Z.D50712.CNAECSV", "Empty.zip": None}
    landed = {r.member: r.landed for r in extract_members(paths, f"file:{tmp_dir}/landed").collect()}
    target = landed["F.K03200$Z.D50712.CNAECSV"]
    assert "/Cnaes-" in target and target.endswith("/F.K03200$Z.D50712.CNAECSV.csv")
    assert open(target.removeprefix("file:"), "rb").read() == b'"1";"A"\n"2";"B"\n'


@pytest.mark.parametrize("base,href", [
    ("https://h.example.com/a/b/index.html?x=1", "/dados/Empresas0.zip"),
    ("https://h.example.com/a/b/index.html", "Empresas1.zip"),
    ("https://h.example.com/a/b/", "Socios.zip"),
    ("http://h.example.com", "Cnaes.zip"),
    ("https://h.example.com/a/", "//cdn.example.com/x/Simples.zip"),
    ("https://h.example.com/a/", "https://other.example.com/Motivos.zip"),
    ("https://h.example.com/a/b/c.html", "../a.zip"),
    ("https://h.example.com/a/b/c.html", "./b.zip"),
    ("https://h.example.com/a/b/c.html", "../../../../c.zip?x=../y#z"),
    ("https://h.example.com/a/b/c.html", "d/./e/../f.zip"),
    ("https://h.example.com/a/b/c.html?q=1", "?f=d.zip"),
    ("https://h.example.com/a/b/c.html?q=1#top", "#g.zip"),
    ("https://h.example.com/a/b/c.html", "/x/../y/./z.zip"),
    ("https://h.example.com/a/b/", ".."),
    ("https://h.example.com/a/b/", "."),
])
def test_resolve_matches_urljoin(spark, base, href):
    df = spark.createDataFrame([(base, href)], "u string, h string")
    assert df.select(resolve(df.h, df.u)).first()[0] == urljoin(base, href)


def test_extract_zip_links_distinct_sorted(spark):
    html = ('<a HREF="/d/Empresas1.zip">x</a><a href="/d/Empresas0.zip">y</a>'
            '<a href="/d/Empresas0.zip">again</a><a href="notes.txt">n</a>')
    pages = spark.createDataFrame([("https://h.example.com/d/", html)], "url string, html string")
    got = [(r.link, r.file_name, r.base) for r in extract_links(pages).collect()]
    assert got == [("https://h.example.com/d/Empresas0.zip", "Empresas0.zip", "empresas"),
                   ("https://h.example.com/d/Empresas1.zip", "Empresas1.zip", "empresas")]


def test_no_links_is_an_error(spark):
    from cadastra.sources.links import NoLinksError, require_links
    pages = spark.createDataFrame([("https://h.example.com/d/", "<p>moved</p>")], "url string, html string")
    with pytest.raises(NoLinksError):
        require_links(extract_links(pages))


def test_equal_archive_names_and_bad_archives(spark, tmp_dir):
    """Months in folders of their own: archives of one name stay apart, a broken one stops no other."""
    paths = []
    for month, data in (("06", '"1";"A"\n'), ("07", '"2";"B"\n')):
        os.makedirs(f"{tmp_dir}/{month}")
        paths.append(_zip(f"{tmp_dir}/{month}/Cnaes0.zip", [("x.CNAECSV", data)]))
    with open(f"{tmp_dir}/bad.zip", "wb") as f:
        f.write(b"no archive")
    df = spark.createDataFrame([(f"file:{p}",) for p in [*paths, f"{tmp_dir}/bad.zip"]], "path string")
    for _ in range(2):  # again, with nothing skipped for being there
        rows = extract_members(df, f"file:{tmp_dir}/landed").collect()
        assert sorted(open(r.landed.removeprefix("file:")).read() for r in rows if r.landed) == ['"1";"A"\n', '"2";"B"\n']
        assert [r.archive.rsplit("/", 1)[-1] for r in rows if r.failure] == ["bad.zip"]
