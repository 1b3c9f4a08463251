"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.balltree import RANKS_SQL, rank_documents
from ledgerline.llm.common import table
from ledgerline.llm.decontam import contamination
from ledgerline.llm.htmltext import extract_text
from ledgerline.llm.jaccard import near_duplicates
from ledgerline.llm.langid import predict_languages
from ledgerline.llm.linededup import dedup_lines
from ledgerline.llm.lmscore import cross_entropy_difference
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.pairwise import classify_quality
from ledgerline.llm.quality import quality_rules
from ledgerline.llm.runs import run_digests
from ledgerline.llm.sharding import shard_by_bytes
from ledgerline.llm.urlfilter import VERDICTS_SQL, judge_urls


def op1_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), 40)


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


def op3_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op6_qgram_lemma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op8_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).drop("component")


def op9_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "text", "removed_lines", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))


def op11_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_seed_extend_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


def op13_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def llm_oracle_sql() -> dict[str, str]:
    return {"op8_redirect_equivalence": VERDICTS_SQL, "op13_ball_tree_search": RANKS_SQL}
