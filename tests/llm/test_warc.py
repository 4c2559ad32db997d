import hashlib

from cadastra.llm import warc_bundles as W
from cadastra.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string"


def plain(rows):
    data = [(i, (h or "").encode()) for i, _, h, _ in rows]
    first = {}
    for i, b in data:
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    return sorted([(i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if first.get(b, i) != i else "response",
                    first[b] if first.get(b, i) != i else None) for i, b in data], key=str)


def test_round_trip(spark):
    rows = [(i, f"http://h/{i % 3}\r\nx y", None if i % 11 == 0 else ("é" * 80 if i % 3 else f"<p>{i}</p>" * 50), "c") for i in range(200)]
    rows += [(500, None, "", "c"), (501, "u", "x" * 300_000, "c"), (3, "u", "again", "c"), (4, rows[4][1], rows[4][2], "c"),
             (None, "n", "no id " * 40, "c"), (None, "m", "no id " * 40, "c"), (None, "m", rows[4][2], "c"), (900, "u", "y" * 5_000_000, "c")]
    root = scratch_path(spark, "test-warc")
    index = W.write_bundles(spark.createDataFrame(rows, SCHEMA), root, frame_bytes=2000, bundle_bytes=1500)
    back = W.read_bundles(index, root)
    got = sorted([tuple(r) for r in back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()], key=str)
    assert got == plain(rows)
    one = index.where("record_id = '<urn:page:7>'").first()
    r = W.fetch(root, one["bundle"], one["frame"], one["offset"], one["length"])
    assert r["warc-record-id"] == "<urn:page:7>" and index.select("bundle").distinct().count() > 1


def test_frames_are_independent_and_the_table_skippable(spark, tmp_path):
    import zstandard
    w = W.BundleWriter(str(tmp_path), "b.warc.zst", 50)
    places = [w.add(bytes([65 + i]) * 30) for i in range(6)]
    w.close()
    data = (tmp_path / "b.warc.zst").read_bytes()
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole == b"".join(bytes([65 + i]) * 30 for i in range(6))
    with W.filesystem(str(tmp_path))[0].open_input_file(str(tmp_path / "b.warc.zst")) as f:
        table = W.seek_table(f)
        frame, at, n = places[4]
        assert W.read_frame(f, table[frame])[at:at + n] == b"E" * 30


def test_empty_table(spark):
    root = scratch_path(spark, "test-warc")
    index = W.write_bundles(spark.createDataFrame([], SCHEMA), root)
    assert index.count() == 0 and W.read_bundles(index, root).count() == 0
