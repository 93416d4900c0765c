"""The queries of the subpackage, by name, and their DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airshed.llm import bpe, cascade, gam, jaccard, lexical, logbilinear, mixing, pii, repair, simhash, snapshots, topk, toxicity
from airshed.llm.common import prepare, table


def vocabulary() -> str:
    """The path of the byte-level vocabulary on the driver."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7, mod=3, held_out=1)


def op2_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation that no other continues, rendered."""
    return snapshots.format_chats(table(spark, sf_dir, "conversations"))


def op3_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document."""
    return logbilinear.token_scores(table(spark, sf_dir, "documents"), mod=7, held_out=2)


def op4_bootstrap_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return pii.digest(table(spark, sf_dir, "documents"))


def op5_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best candidates of every hundredth vector among all vectors."""
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows.where("vec_id % 100 = 0"), rows, k=10)


def op6_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    return cascade.judged(table(spark, sf_dir, "documents"))


def op7_soft_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior, rate and copies of every document for the production mixture."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("h")


def op8_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op9_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return gam.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3, mod=5, held_out=0)


def op10_segment_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op11_length_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"), k=10)


def op12_branch_bound_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, and its cheapest repair."""
    rows = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damage(rows), rows)


def op13_adaptive_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document at a Jaccard similarity of 0.9."""
    return jaccard.similar_components(table(spark, sf_dir, "documents"), shingle=3, percent=90)


def _prepared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _prepared(f) for f in (op1_toxicity_fm, op2_snapshot_collapse, op3_log_bilinear, op4_bootstrap_pii, op5_histogram_topk, op6_rule_cascade,
                              op7_soft_mix, op8_covering_simhash, op9_gam_quality, op10_segment_bpe,
                              op11_length_strata, op12_branch_bound_repair, op13_adaptive_prefixes)}

ORACLES: dict[str, str] = {"op2_snapshot_collapse": snapshots.SQL, "op6_rule_cascade": cascade.SQL, "op11_length_strata": lexical.SQL}
