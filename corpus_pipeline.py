"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, all
but the last with the columns of ``docs``. Each stage works on all rows that its predecessor kept; rows
are told apart by doc_id and a hash of the text, so repeated ids are handled. Null and empty texts pass
the first two stages and are packed as one end id each.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import jaccard_join, line_dedup, mixing, packing, quality_pu
from cadastra.llm.common import free_names, materialise, table
from cadastra.llm.queries import TOKENIZER, held_out

#: documents with a lower chance of being good are rejected
LEAST_QUALITY = 0.5
#: a small source is read at most this often; the least repeated one is read exactly once
MAX_REPEATS = 2.0


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows named by (doc_id, tie)."""
    gone = dropped.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie")).distinct()
    return docs.join(gone, docs.doc_id.eqNullSafe(gone["__id"]) & (F.xxhash64(docs.text) == gone["__tie"]), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scores = quality_pu.score_quality(docs, table(spark, sf_dir, "labels"), ~held_out(3, 1))
    return _without(docs, scores.where(F.col("score") < LEAST_QUALITY))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; documents of which nothing is left go."""
    # columns of the operator's names are set aside
    own = {c: free_names(docs, f"own_{c}")[0] for c in docs.columns if c.lower() in ("n_lines", "n_deleted")}
    cut = line_dedup.dedup_lines(docs.withColumnsRenamed(own)).where("n_deleted = 0 OR text <> ''")
    n_chars = F.when(F.col("n_deleted") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return (cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
            .select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns]))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of links."""
    rows = materialise(jaccard_join.linked_components(docs), "pipeline-components")
    kept = _without(docs, rows.where("NOT first"))
    again = materialise(rows.where("first AND n_shingles > 0").groupBy("doc_id", "tie").agg(F.count("*").alias("n"))
                        .where("n > 1"), "pipeline-repeated")
    if again.isEmpty():
        return kept
    # rows that are equal in id and text: one of them
    same = again.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"))
    one = (kept.join(same, kept.doc_id.eqNullSafe(same["__id"]) & (F.xxhash64(kept.text) == same["__tie"]), "left_semi")
           .dropDuplicates(["doc_id", "text"]))
    return _without(kept, again).unionByName(one)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources up to ``MAX_REPEATS`` times."""
    return mixing.mixed_documents(docs, max_repeats=MAX_REPEATS, target_entropy=1.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences: one row per piece of a document."""
    return packing.pack(packing.tokenized_pieces(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources to target weights", mix), ("best-fit packing", pack)]

#: a trained classifier and a tokenizer cannot be stated in SQL; tests hold the stages against plain code
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
