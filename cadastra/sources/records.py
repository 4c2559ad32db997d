"""Records of dumps whose quoted fields hold newlines, read by many tasks per file.

Spark's ``multiLine`` mode gives a whole file to one task, because a newline only ends a record outside
quotes and whether a place is inside quotes depends on everything before it. That dependency is small: a
stretch of lines is a function from "begins inside quotes?" to "ends inside quotes?".

1. *States.* One splittable text scan gives, for every block of a file, the end state for both start states.
2. *Prefix.* Per file, these functions are applied one after another (one entry a block): every block's start state.
3. *Records.* A second scan over the same blocks knows its start state and joins lines into records. Only a
   record that crosses the end of a block is made of pieces, at most two a block, which are grouped and joined.

The records are written to the shared scratch folder (both scans must see the same blocks, and later plans should not scan
twice) and parsed by Spark's own CSV parser (:func:`~cadastra.sources.dumps.read_dump`).

A quote opens a field only at the field's start; inside, a doubled quote stands for itself; after the closing quote the
field goes on unquoted until the next delimiter. Blank lines outside quotes are no records. A record that is still open at the
end of its file ends there.
"""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written

BLOCK_BYTES = 128 << 20
#: blocks, and so tasks, that a scan of smaller ones is cut into at most
MAX_SMALL_BLOCKS = 1_000
#: blocks that begin inside a record are told to all tasks: (file, block) pairs, one for BLOCK_BYTES of input at most
MAX_OPEN_BLOCKS = 2_000_000

# fixed values of the dump format: quote and delimiter
_TO_CLOSING = re.compile(rb'[^"]*+(?:""[^"]*+)*+"')
_QUOTED = re.compile(rb'(^|;)"[^"]*+(?:""[^"]*+)*+"')
_OPENED = re.compile(rb'(?:^|;)"')


def ends_open(line: bytes, begins_open: bool) -> bool:
    """Is the end of ``line`` inside quotes?"""
    if b'"' not in line:
        return begins_open
    if begins_open:
        closing = _TO_CLOSING.match(line)
        if closing is None:
            return True
        line = b"-" + line[closing.end():]  # the rest does not begin a field
    return _OPENED.search(_QUOTED.sub(rb"\1", line)) is not None


def first_record_lines(lines: Iterator[bytes]) -> list[bytes]:
    """The lines of the first record that is not blank."""
    found: list[bytes] = []
    inside = False
    for line in lines:
        if not found and not line.strip(b"\r\n"):
            continue
        found.append(line)
        inside = ends_open(line.rstrip(b"\r\n"), inside)
        if not inside:
            break
    return found


@contextlib.contextmanager
def _blocks_of(spark: SparkSession, size: int):
    """Splits of ``size`` bytes, whatever the number of cores."""
    wanted = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def block_size(total: int, wanted: int) -> int:
    """Bytes of a block for ``total`` bytes: ``wanted``, or more (up to ``BLOCK_BYTES``) where those would be too many
    tasks, as each costs a start, a file of states and one of pieces."""
    return max(wanted, min(BLOCK_BYTES, -(-total // MAX_SMALL_BLOCKS)))


def _total_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.agg(F.sum("length")).first()[0] or 0


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, block, line): physical lines as bytes, without the newline; in order inside a task."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"))


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    here, closed, opened, out = None, False, True, []
    for b in batches:
        for file, block, line in zip(*(b.column(c).to_pylist() for c in ("file", "block", "line"))):
            if (file, block) != here:
                out += [] if here is None else [(*here, closed, opened)]
                here, closed, opened = (file, block), False, True
            if closed == opened:  # one state is left
                closed = opened = ends_open(line, closed)
            else:
                closed, opened = ends_open(line, closed), ends_open(line, opened)
    out += [] if here is None else [(*here, closed, opened)]
    types = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)],
                                     names=["file", "block", "if_closed", "if_opened"])


def open_blocks(states: DataFrame) -> DataFrame:
    """(file, block): the blocks that begin inside a record, from (file, block, if_closed, if_opened)."""
    row = F.struct("block", "if_closed", "if_opened")
    in_order = states.groupBy("file").agg(F.sort_array(F.collect_list(row)).alias("s"))  # one entry a block
    begins = F.expr("""aggregate(s, named_struct('open', false, 'at', cast(array() as array<bigint>)), (a, b) -> named_struct(
        'open', if(a.open, b.if_opened, b.if_closed), 'at', if(a.open, concat(a.at, array(b.block)), a.at)))""")
    return in_order.select("file", F.explode(begins["at"]).alias("block"))


#: kinds of pieces: a whole record, the end of an earlier block's record (which may go on), the begin of a later one's
WHOLE, HEAD, TAIL = 0, 1, 2


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    here, held, inside, kind, n = None, [], False, WHOLE, 0
    out: list[tuple] = []

    def close(piece: int) -> None:
        nonlocal n
        data = b"\n".join(held)
        held.clear()
        if piece != HEAD and not data.strip(b"\r"):
            return
        out.append((*here, n, piece, data))
        n += piece != HEAD

    def batch() -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        made = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)],
                                          names=["file", "block", "n", "kind", "data"])
        out.clear()
        return made

    for b in batches:
        for file, block, begins, line in zip(*(b.column(c).to_pylist() for c in ("file", "block", "begins", "line"))):
            if (file, block) != here:
                if held:
                    close(HEAD if kind == HEAD else TAIL)
                here, inside, n = (file, block), begins, 0
                kind = HEAD if begins else WHOLE
            held.append(line)
            inside = ends_open(line, inside)
            if not inside:
                close(kind)
                kind = WHOLE
        if out:
            yield batch()
    if held:
        close(HEAD if kind == HEAD else TAIL)
    if out:
        yield batch()


def read_records(spark: SparkSession, paths: str | Sequence[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, block, n, data): every record of the files as bytes, written; ``n`` counts the records that begin in a block.
    Blocks are of ``block_bytes``, larger where that many would be too many tasks (:func:`block_size`)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    block_bytes = block_size(_total_bytes(spark, paths) if block_bytes < BLOCK_BYTES else 0, block_bytes)
    with _blocks_of(spark, block_bytes):
        lines = _lines(spark, paths)
        states, _ = written(lines.mapInArrow(_states, "file long, block long, if_closed boolean, if_opened boolean"), "block-states")
        begun, count = written(open_blocks(states), "open-blocks")
        if count > MAX_OPEN_BLOCKS:
            raise ValueError(f"{count} blocks begin inside a record: read with larger blocks")
        marked = lines.join(F.broadcast(begun.withColumn("_open", F.lit(True))), ["file", "block"], "left").select(
            "file", "block", F.coalesce("_open", F.lit(False)).alias("begins"), "line")
        pieces, _ = written(marked.mapInArrow(_pieces, "file long, block long, n long, kind int, data binary"), "record-pieces")
    # a tail and the heads after it are one record: at most two pieces a block
    order = Window.partitionBy("file").orderBy("block", "kind")
    parts = (pieces.where(F.col("kind") != WHOLE)
             .withColumn("record", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order)))
    text = F.decode("data", "ISO-8859-1")  # one character a byte
    joined = (parts.groupBy("file", "record").agg(F.min(F.struct("block", "n")).alias("at"),
                                                  F.sort_array(F.collect_list(F.struct("block", "kind", text.alias("t")))).alias("ps"))
              .select("file", "at.block", "at.n", F.encode(F.array_join(F.transform("ps", lambda p: p["t"]), "\n"), "ISO-8859-1").alias("data")))
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "block", "n", "data")
    return whole.unionByName(joined)
