"""The operators over the test tables: one query each, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threatlake.llm import (chat, decontaminate, divergence, jaccard, line_dedup, mixing, pst, quality, repair, sharding,
                            simhash, suffix_family, toxicity)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark, sf_dir):
    return quality.audit(_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(_table(spark, sf_dir, "documents"), max_bits=None)


def op3_simhash(spark, sf_dir):
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op4_decontaminate(spark, sf_dir):
    return (decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
            .drop("spans"))


def op5_chat(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_chat(turns.unionByName(chat.probe(spark))))


def op6_sharding(spark, sf_dir):
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op7_mixing(spark, sf_dir):
    return mixing.mixture(_table(spark, sf_dir, "documents")).drop("h")


def op8_lm_scoring(spark, sf_dir):
    return pst.score(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark, sf_dir):
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_suffix_dedup(spark, sf_dir):
    return suffix_family.repeated_passages(_table(spark, sf_dir, "documents"))


def op11_structure_repair(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.audit(turns, repair.damage(turns))


def op12_source_divergence(spark, sf_dir):
    return divergence.divergence(_table(spark, sf_dir, "documents"))


def op13_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline  # the file at the repository's top, which imports this package
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_line_dedup, op3_simhash, op4_decontaminate, op5_chat,
                                   op6_sharding, op7_mixing, op8_lm_scoring, op9_toxicity,
                                   op10_suffix_dedup, op11_structure_repair, op12_source_divergence, op13_jaccard_join,
                                   pipeline)}
ORACLE: dict[str, str] = {"op1_quality_rules": quality.ORACLE, "op4_decontaminate": decontaminate.ORACLE, "op5_chat": chat.ORACLE,
                          "op12_source_divergence": divergence.ORACLE, "op13_jaccard_join": jaccard.ORACLE}
