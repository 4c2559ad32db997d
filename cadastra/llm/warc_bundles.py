"""WARC archives as seekable Zstandard bundles.

``write_bundles`` writes one file per about ``bundle_bytes`` of compressed records under a shared
folder. A bundle is a row of independent Zstandard frames, each holding about ``frame_bytes`` of whole
WARC records, and ends with a seek table in the public seekable format (a skippable frame with the
compressed and plain size of every frame). It returns the index: one row per record with bundle,
frame and offset inside the plain frame, so that one record costs one frame to read.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest id is a
response, the others are revisits that name it and carry no payload. The html travels once, by page
id, which no page shares; equal payloads meet as digests only, pre-aggregated before the shuffle.

File names follow from the task's partition, and the rows of a partition are sorted, so a repeated
attempt writes the same bytes under the same name; a file appears by rename when it is complete.

Defined results: null html is an empty payload; null urls are empty; rows that repeat a page id with
one payload are records of the same kind; rows that share a page id have one WARC-Record-ID and are told apart by
bundle, frame and offset; a row without an id revisits the equal payload of the smallest id, and is a response where
no equal payload has an id; a very long payload is one record in one frame; an empty table writes nothing and has no
records. Columns other than id, url and payload do not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 24
MIN_BYTES = 100
#: fixed values of the public Zstandard seekable format
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
WARC_DATE = "1970-01-01T00:00:00Z"

INDEX_SCHEMA = "record_id string, bundle string, frame int, offset long, length long"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url, payload: bytes, digest: str, revisit: bool, refers_to, n_bytes: int) -> bytes:
    """One WARC/1.1 record; a revisit has the headers of the payload but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}",
            f"WARC-Date: {WARC_DATE}",
            "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or ""),
            f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


class BundleWriter:
    """One bundle file: frames of records, then the seek table."""

    def __init__(self, root: str, name: str, frame_bytes: int):
        self.fs, base = filesystem(root)
        self.name, self.path, self.temporary = name, f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temporary, compression=None)
        self.frame_bytes, self.frames, self.plain, self.size = frame_bytes, [], bytearray(), 0
        self.packer = zstandard.ZstdCompressor(level=3)

    def add(self, data: bytes) -> tuple[int, int, int]:
        """(frame, offset in the plain frame, length) of the record."""
        place = (len(self.frames), len(self.plain), len(data))
        self.plain += data
        if len(self.plain) >= self.frame_bytes:
            self.end_frame()
        return place

    def end_frame(self) -> None:
        if self.plain:
            packed = self.packer.compress(bytes(self.plain))
            self.out.write(packed)
            self.frames.append((len(packed), len(self.plain)))
            self.size += len(packed)
            self.plain = bytearray()

    def close(self) -> None:
        self.end_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        foot = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(foot)) + table + foot)
        self.out.close()
        self.fs.move(self.temporary, self.path)


def seek_table(f) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, from the footer of an open bundle."""
    size = f.size()
    f.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    f.seek(size - 9 - 8 * n)
    sizes = list(struct.iter_unpack("<II", f.read(8 * n)))
    starts = [0]
    for packed, _ in sizes:
        starts.append(starts[-1] + packed)
    return [(s, *x) for s, x in zip(starts, sizes)]


def read_frame(f, entry: tuple[int, int, int]) -> bytes:
    f.seek(entry[0])
    return zstandard.ZstdDecompressor().decompress(f.read(entry[1]), max_output_size=entry[2])


def parse(data: bytes) -> dict:
    """Headers of one record in lower case, with ``payload``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    found = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])}
    block = rest[:int(found["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return found | {"payload": payload, "http-length": int(re.search(rb"Content-Length: (\d+)", http)[1])}


def write_bundles(pages: DataFrame, root: str, min_bytes: int = MIN_BYTES, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> DataFrame:
    """Write the bundles and the index (returned, as read from the shared folder)."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    digests = materialise(rows.select("page_id", F.sha2("payload", 256).alias("digest"),
                                      F.octet_length("payload").alias("n_bytes")), "warc-digests")
    long = digests.where(F.col("n_bytes") >= min_bytes)
    first = (long.groupBy("digest", "n_bytes").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    revisits = materialise(long.distinct().join(first, ["digest", "n_bytes"])
                           .where("refers_to IS NOT NULL AND NOT page_id <=> refers_to")
                           .select(F.col("page_id").alias("of"), F.col("digest").alias("of_digest"), "refers_to"), "warc-revisits")
    keyed = rows.withColumn("digest", F.sha2("payload", 256))
    todo = (keyed.join(revisits, keyed.page_id.eqNullSafe(revisits["of"]) & (keyed.digest == revisits.of_digest), "left")
            .drop("of", "of_digest").sortWithinPartitions("page_id", "digest", "url"))
    filesystem(root)[0].create_dir(filesystem(root)[1], recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, bundle = TaskContext.get().partitionId(), 0, None
        for b in batches:
            placed = []
            for row in b.to_pylist():
                if bundle is None:
                    bundle = BundleWriter(root, f"bundle-{part:06d}-{number:06d}.warc.zst", frame_bytes)
                    number += 1
                data = record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"] is not None,
                              row["refers_to"], len(row["payload"]))
                placed.append((urn(row["page_id"]), bundle.name, *bundle.add(data)))
                if bundle.size >= bundle_bytes:
                    bundle.close()
                    bundle = None
            if placed:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*placed), (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                    names=["record_id", "bundle", "frame", "offset", "length"])
        if bundle is not None:
            bundle.close()

    return materialise(todo.mapInArrow(write, INDEX_SCHEMA), "warc-index")


def fetch(root: str, bundle: str, frame: int, offset: int, length: int) -> dict:
    """One record by its index row: reads the seek table and one frame."""
    fs, base = filesystem(root)
    with fs.open_input_file(f"{base}/{bundle}") as f:
        return parse(read_frame(f, seek_table(f)[frame])[offset:offset + length])


READ_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
               "bundle string, frame int, offset long")


def read_bundles(index: DataFrame, root: str) -> DataFrame:
    """Every record read back from the archives, frame by frame, a bundle per row of work.

    The digest of a response is computed from the payload that was read and must equal its header's.
    """
    n = shuffle_partitions(index.sparkSession)
    frames = index.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("at"))
    work = frames.repartition(n, "bundle").sortWithinPartitions("bundle", "frame")
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64()]

    def number(s: str | None) -> int | None:
        digits = s[len("<urn:page:"):-1] if s else ""
        return int(digits) if digits else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(root)
        name, f, table = None, None, []
        for b in batches:
            for row in b.to_pylist():
                if row["bundle"] != name:
                    if f:
                        f.close()
                    name = row["bundle"]
                    f = fs.open_input_file(f"{base}/{name}")
                    table = seek_table(f)
                plain, out = read_frame(f, table[row["frame"]]), []
                for at in row["at"]:
                    r = parse(plain[at["offset"]:at["offset"] + at["length"]])
                    digest, kind = r["warc-payload-digest"].removeprefix("sha256:"), r["warc-type"]
                    if kind == "response" and hashlib.sha256(r["payload"]).hexdigest() != digest:
                        raise ValueError(f"{name}: {r['warc-record-id']} is damaged")
                    out.append((number(r["warc-record-id"]), len(r["payload"]) if kind == "response" else r["http-length"],
                                digest, kind, number(r.get("warc-refers-to")), name, row["frame"], at["offset"]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        if f:
            f.close()

    return work.mapInArrow(read, READ_SCHEMA)
