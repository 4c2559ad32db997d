"""Exact de-duplication with an extendible-hash index on shared files.

Texts are equal when identical after each run of space or U+0009..U+000D becomes one space (null
counts as empty). The index is built in four steps, all of them DataFrame operations:

1. *Entries*: every row's 64-bit key hash, digest and byte length, written to the shared folder.
2. *Directory*: starts as one bucket; every bucket with more than ``capacity`` keys is split on one
   more leading hash bit (directory doubling) until none is overfull or ``max_depth`` bits are used. By default
   that depth follows from the number of rows, so buckets stay within ``capacity`` at any size.
3. *Owners*: the directory routes every text to its bucket, and ranges of (bucket, key hash) to tasks: each owner
   has a range of keys. It orders the texts of one hash as a chain and compares the bytes of neighbours; a text that
   differs begins the next link. The links are written in key order, each file holding a key range. A text
   with more than ``HOT`` copies is first aggregated map-side, so no owner receives more copies of a text.
4. *Lookup*: the directory gives an entry's bucket, and the links of (bucket, hash, digest, length) in the index files
   answer it; links of hot texts are few and are broadcast after a count. Where the byte comparison found several
   texts under one digest, the texts themselves tell the links apart.

Defined results: no rows in, no rows out; null text equals the empty text; rows that repeat a doc_id
with equal text are one document reported once per row (kept on each of them if it is the smallest);
a null doc_id stays only in a group without any id. Extra input columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions

CAPACITY = 1 << 16
#: copies of a text beyond which it is aggregated before it is routed
HOT = 256
#: rows up to which the directory, hot hashes and hot links are broadcast
SMALL_ROWS = 1 << 17


def normalised(text: Column) -> Column:
    """Each run of white space as one space; a run that is one space already is not matched at all."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x09-\x0D ]*| [\x09-\x0D ]+", " ")


def build_directory(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = 16) -> DataFrame:
    """(slot, bucket, local_depth) from the distinct ``key_hash`` values in ``keys``.

    A slot is the leading ``max_depth`` bits of a hash; a bucket is named by a 1 followed by its
    leading ``local_depth`` bits.
    """
    counted = keys.groupBy(slot_of(F.col("key_hash"), max_depth).alias("slot")).agg(F.count("*").alias("keys"))
    open_slots = materialise(counted, "dedup-slots")  # at most 2 ** max_depth rows
    closed = None
    for depth in range(max_depth + 1):
        prefix = F.shiftright("slot", max_depth - depth)
        filled = open_slots.withColumn("filled", F.sum("keys").over(Window.partitionBy(prefix)))
        full = (F.col("filled") > capacity) if depth < max_depth else F.lit(False)
        done = filled.where(~full).select("slot", (F.lit(1 << depth) + prefix).cast("long").alias("bucket"),
                                          F.lit(depth).alias("local_depth"))
        closed = done if closed is None else closed.unionByName(done)
        open_slots = filled.where(full).select("slot", "keys")
        if open_slots.isEmpty():
            break
    return materialise(closed, "dedup-directory")


def slot_of(key_hash: Column, max_depth: int) -> Column:
    return F.shiftrightunsigned(key_hash, 64 - max_depth)


def depth_for(rows: int, capacity: int) -> int:
    """Leading bits with which buckets of ``rows`` evenly hashed keys are far below ``capacity``."""
    return min(40, 4 + max(0, math.ceil(math.log2(max(rows, 1) / capacity))))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def owned_links(rows: DataFrame, hot: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """The index from ``rows`` (doc_id, norm, key_hash, bucket): a row per distinct text, found by its owner task.

    (bucket, key_hash, link, digest, n_bytes, keep_id, group_size, texts): ``link`` counts along the chain of a hash,
    ``texts`` the links that share digest and length. Written, in order of (bucket, key_hash).
    """
    text = ["bucket", "key_hash", "norm"]
    few = materialise(rows.join(hot, "key_hash", "left_semi").groupBy(*text)
                      .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("copies")), "dedup-hot-texts")
    routed = (rows.join(hot, "key_hash", "left_anti")
              .select(*text, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("copies")).unionByName(few))
    owned = routed.repartitionByRange(shuffle_partitions(rows.sparkSession), "bucket", "key_hash")
    chain = Window.partitionBy("bucket", "key_hash").orderBy("norm")
    differs = F.when(F.col("norm") == F.lag("norm").over(chain), 0).otherwise(1)
    links = (owned.withColumn("begins", differs)
             .withColumn("link", F.sum("begins").over(chain.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .withColumn("head", F.when(F.col("begins") == 1, F.struct(digest(F.col("norm")).alias("digest"),
                                                                      F.octet_length("norm").alias("n_bytes"))))
             .groupBy("bucket", "key_hash", "link")
             .agg(F.max("head").alias("head"), F.min("keep_id").alias("keep_id"), F.sum("copies").alias("group_size")))
    alike = Window.partitionBy("bucket", "key_hash", "head")
    return materialise(links.withColumn("texts", F.count("*").over(alike))
                       .select("bucket", "key_hash", "link", "head.digest", "head.n_bytes", "keep_id", "group_size", "texts")
                       .sortWithinPartitions("bucket", "key_hash", "link"), "dedup-index")


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                max_depth: int | None = None, key_hash: Callable[[Column], Column] = F.xxhash64,
                digest: Callable[[Column], Column] = lambda c: F.sha2(c, 256), hot_copies: int = HOT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, bucket.

    ``key_hash`` and ``digest`` are parameters so that tests can force collisions.
    """
    text = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    hashed = text.select("doc_id", "norm", key_hash(F.col("norm")).cast("long").alias("key_hash"))
    entries = materialise(hashed.select(
        "doc_id", "key_hash", digest(F.col("norm")).alias("digest"), F.octet_length("norm").alias("n_bytes"),
        F.sha2("norm", 256).alias("text_sha256")), "dedup-entries")
    depth = max_depth if max_depth is not None else depth_for(entries.count(), capacity)
    keys = materialise(entries.groupBy("key_hash").agg(F.count("*").alias("copies")), "dedup-keys")
    directory = _few(build_directory(keys, capacity, depth).select("slot", "bucket"))
    hot = _few(keys.where(F.col("copies") > hot_copies).select("key_hash"))

    def in_bucket(df: DataFrame) -> DataFrame:
        return df.withColumn("slot", slot_of(F.col("key_hash"), depth)).join(directory, "slot").drop("slot")

    index = owned_links(in_bucket(hashed), hot, digest)
    link = ["bucket", "key_hash", "digest", "n_bytes"]
    out = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
           "text_sha256", "bucket"]
    found = look_up(in_bucket(entries), index.where("texts = 1"), hot_copies).select(*out)
    clash = index.where("texts > 1").select(*link).distinct()
    if clash.isEmpty():
        return found
    # several texts under one digest: told apart by the texts themselves
    rows = in_bucket(hashed.withColumns({"digest": digest(F.col("norm")), "n_bytes": F.octet_length("norm")})).join(clash, link)
    groups = rows.groupBy(*link, "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    told = (rows.join(groups, [*link, "norm"]).withColumn("text_sha256", F.sha2("norm", 256)).select(*out))
    return found.unionByName(told)


def look_up(entries: DataFrame, index: DataFrame, hot_copies: int = HOT) -> DataFrame:
    """``entries`` (bucket, key_hash, digest, n_bytes, …) with keep_id and group_size from the index files alone."""
    link = ["bucket", "key_hash", "digest", "n_bytes"]
    answers = index.select(*link, "keep_id", "group_size")
    large = answers.where(F.col("group_size") > hot_copies)
    few = _few(large)
    rest = entries.join(few, link, "left_anti").join(answers.where(F.col("group_size") <= hot_copies), link)
    return entries.join(few, link).unionByName(rest)
