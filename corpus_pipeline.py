"""From raw documents to packed sequences, in five stages.

Each stage takes the documents its predecessor kept and returns those it keeps, with all their
columns; the last returns the pieces of the packed sequences. A stage's result is written to the
shared folder and read back, so a lost executor never sets the work back by more than a stage.

Null, empty and very long texts, null and repeated ids, empty tables: as each operator states. Rows
that repeat an id and a text become one in the near-duplicate stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bercario.llm import decontaminate, line_dedup, minhash, packing, quality
from bercario.llm.queries import classifier
from bercario.llm.tables import documents, stored


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts; it learns from labels outside the held-out third."""
    ensemble = classifier(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, ensemble)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, without passages that an earlier one has; n_chars follows the text.

    A document of which no line is left was all passages of others, and goes. One that was blank before
    stays, as nothing was removed from it.
    """
    cleaned = line_dedup.without_repeated_lines(docs)
    # Told by the number of lines, not by the text: Spark would move a test of the text below its
    # making, and make the text once more for it, line by line.
    cleaned = cleaned.filter(~((F.col("ld_removed") > 0) & (F.col("ld_removed") == F.col("ld_lines"))))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length("text").cast(kind)
        cleaned = cleaned.withColumn(
            "n_chars", F.when(F.col("ld_removed") > 0, length).otherwise(F.col("n_chars"))
        )
    return cleaned.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of least id, then text hash."""
    found = minhash.near_duplicates(docs).filter("kept")
    # The kept rows of a group share the least id. Texts without shingles are groups by themselves.
    own = F.when(F.col("component").isNull(), F.col("text_key")).alias("llm_own")
    found = found.groupBy("component", F.col("doc_id").alias("llm_id"), own).agg(
        F.min("text_key").alias("llm_key")
    )
    body = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    kept = docs.withColumn("llm_text", body).join(
        found, F.col("doc_id").eqNullSafe(F.col("llm_id")) & (F.col("llm_text") == F.col("llm_key")), "left_semi"
    )
    same = W.partitionBy("doc_id", "llm_text").orderBy(F.lit(0))
    kept = kept.withColumn("llm_copy", F.row_number().over(same)).filter("llm_copy = 1")
    return kept.select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, each with its sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality", reject_low_quality),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("packing", pack_sequences),
]

# Signatures, tokenizers and fitted rules have no SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(result, f"pipeline-{name}")
    return result
