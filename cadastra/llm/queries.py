"""Registered queries of the operators: each applies one operator to its whole table.

``QUERIES`` and ``ORACLE`` are what ``__spark_entry__`` adds. The operators keep their own interfaces;
a query only picks parameters and the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.session import scratch_path

import public_tokenizers

from . import (bpe_codec, chat_trees, exact_dedup, fingerprints, hard_negatives, jaccard_join, line_dedup, mixing, packing,
               quality_pu, toxicity, warc_bundles, whitening)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def held_out(modulus: int, remainder: int):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out(4, 2)
    scores = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: op2: the mixture keeps at least this part of the largest possible entropy ...
TARGET_ENTROPY = 0.95
#: ... and repeats no source more often than this
MAX_REPEATS = 4.0


@query("op2_mixing", sql=mixing.oracle_sql(TARGET_ENTROPY, MAX_REPEATS))
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    budget = docs.agg(F.sum(mixing.token_count(F.col("text")))).first()[0] or 0
    return mixing.mix_sources(docs, budget=budget, target_entropy=TARGET_ENTROPY, max_repeats=MAX_REPEATS)


@query("op3_exact_dedup", sql=r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
             sha256(norm) AS text_sha256 FROM t)""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_exact(table(spark, sf_dir, "documents")).drop("bucket")


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out(3, 1)
    scores = quality_pu.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op5_line_dedup", sql=line_dedup.oracle_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_deleted")


@query("op6_warc")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc-bundles")
    index = warc_bundles.write_bundles(table(spark, sf_dir, "pages"), root)
    return warc_bundles.read_bundles(index, root)


@query("op7_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_pairs(table(spark, sf_dir, "documents"))


#: op8: the tokenizer file; a parameter of the operator
TOKENIZER = "byte_bpe_50k.json"


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenized_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                                      public_tokenizers.PATTERN)
    return packing.pack(pieces)


#: op9: a conversation that holds control strings of other templates (conv_id, turn, role, text)
CONTROL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query("op9_chat_formatting")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")
    nodes = chat_trees.reply_chains(turns.unionByName(extra))
    return chat_trees.read_back(chat_trees.format_paths(nodes)).drop("path", "rank")


@query("op10_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.linked_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_hard_negatives")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    items = hard_negatives.integer_rows(table(spark, sf_dir, "embeddings"), label, scale=256)
    return hard_negatives.mine(items, F.col("vec_id") % 100 == 0)


@query("op13_bpe_codec")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    encoded = bpe_codec.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    decoded = bpe_codec.decode_documents(encoded, path, public_tokenizers.PATTERN)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
                          F.sha2("text", 256).alias("decoded_sha256"))
