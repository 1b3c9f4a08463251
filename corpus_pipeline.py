"""The corpus pipeline: quality rules, line dedup, near duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
documents. Rows are named by doc_id and a hash of the text: rows equal in both are alike and share their decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import DOCUMENT_COLUMNS, broadcast_if_small, materialize, row_keys, table
from ledgerline.llm.decontam import contamination
from ledgerline.llm.jaccard import near_duplicates
from ledgerline.llm.linededup import dedup_lines
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.quality import quality_rules


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents without the rows (doc_id, text_hash) named."""
    named = rows.select(F.coalesce("doc_id", F.lit(-(1 << 62))).alias("_d"), F.col("text_hash").alias("_t")).distinct()
    return docs.withColumns(row_keys()).join(broadcast_if_small(materialize(named)), ["_d", "_t"], "left_anti").select(*DOCUMENT_COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null texts and texts under ten words go."""
    return _without(docs, quality_rules(docs).where("not kept"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the multi-line chunks that stand in an earlier document; texts of nothing else go. n_chars follows."""
    cleaned = dedup_lines(docs.select(*DOCUMENT_COLUMNS)).where("removed_lines = 0 or trim(text) <> ''")
    return cleaned.withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*DOCUMENT_COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts, the one with the smallest doc_id; texts without words all stay."""
    rows = materialize(near_duplicates(docs).where("n_shingles > 0").select("component_id", "doc_id", "text_hash"))
    first = rows.groupBy("component_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("f"))
    kept = _without(docs, rows.join(first, "component_id").where("not (doc_id <=> f.doc_id and text_hash <=> f.text_hash)"))
    # Repeated rows of one document that stays: one of them.
    again = materialize(rows.groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash"))
    if again.isEmpty():
        return kept
    named = again.select(F.coalesce("doc_id", F.lit(-(1 << 62))).alias("_d"), F.col("text_hash").alias("_t"))
    twice = kept.withColumns(row_keys()).join(named, ["_d", "_t"], "left_semi").dropDuplicates(["_d", "_t"]).select(*DOCUMENT_COLUMNS)
    return _without(kept, again).unionByName(twice)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands within its edit budget."""
    return _without(docs, contamination(docs, table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram jaccard join", near), ("benchmark decontamination", decontaminate), ("best-fit packing", pack)]
ORACLE_SQL = None  # tokenizing and alignment are beyond SQL: tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
