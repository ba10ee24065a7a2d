"""Registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chat_format, mixing, near_duplicates, packing, personal_data, phrase_mining, quality, resampling, secret_scan, sharding, substring_dedup, topk_search, url_reputation


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.FEATURES)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def op3_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"))


#: Both say what looks like a turn of many templates.
CONTROL_TURNS = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    turns = turns.unionByName(spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string"))
    return chat_format.digest(chat_format.examples(turns))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.digest(near_duplicates.classes(table(spark, sf_dir, "documents")))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.Mix(table(spark, sf_dir, "documents")).taken())


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.detect(table(spark, sf_dir, "documents")))


def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_reputation.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.dedup_passages(table(spark, sf_dir, "documents")))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.digest(resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.detect(table(spark, sf_dir, "documents")))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_shard_lookup": op3_shard_lookup,
        "op4_chat_format": op4_chat_format,
        "op5_near_duplicates": op5_near_duplicates,
        "op6_topk_search": op6_topk_search,
        "op7_source_mix": op7_source_mix,
        "op8_personal_data": op8_personal_data,
        "op9_url_reputation": op9_url_reputation,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_secret_scan": op12_secret_scan,
        "op13_phrase_mining": op13_phrase_mining,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where it can say the same: the other operators rest on hashes
    or token ids, and are tested against plain versions."""
    from tessera.llm import oracle

    return {
        "op4_chat_format": oracle.CHAT_FORMAT,
        "op6_topk_search": oracle.TOPK_SEARCH,
        "op9_url_reputation": oracle.url_reputation(),
        "op10_substring_dedup": oracle.SUBSTRING_DEDUP,
        "op11_importance_resampling": oracle.importance_resampling(),
        "op13_phrase_mining": oracle.phrase_mining(),
    }
