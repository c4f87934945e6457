"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitbars.llm import best_two_fit, bpe, filter_audit, laesa, line_dedup, maxscore, order_minhash, packing, quality_rules, secrets_scan, token_output, toxicity, url_filter
from pitbars.llm.common import shipped, table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of every document."""
    return bpe.digest(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that came before."""
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_deleted")


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every sequence of every document lies in the shards that this writes."""
    return token_output.ordered(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or model verdict on every page's URL."""
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets_scan.report(table(spark, sf_dir, "documents"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of copies and near copies of every document."""
    return order_minhash.classes(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows of every hundredth vector."""
    return maxscore.search(table(spark, sf_dir, "embeddings"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters does in every order, by source."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_laesa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector."""
    return laesa.report(table(spark, sf_dir, "embeddings"))


def op13_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in as few sequences as can be."""
    return best_two_fit.pack(table(spark, sf_dir, "documents"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: shipped(f)
    for f in (
        op1_bpe, op2_line_dedup, op3_token_output, op4_url_filter, op5_secrets, op6_order_minhash, op7_quality_rules, op8_toxicity, op9_packing, op10_maxscore,
        op11_filter_audit, op12_laesa, op13_best_two_fit,
    )
}

#: Tokenizers, spans in code points, alignments, learned lists and weights have no SQL form.
ORACLE: dict[str, str] = {"op4_url_filter": url_filter.SQL, "op10_maxscore": maxscore.SQL, "op11_filter_audit": filter_audit.SQL, "op12_laesa": laesa.SQL}
