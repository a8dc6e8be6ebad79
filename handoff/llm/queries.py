"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from handoff.llm import (
    cgk_decontam,
    chat_windows,
    ctw_scoring,
    elias_fano,
    hd_langid,
    hilbert_shards,
    hyperplane_dedup,
    lexical_search,
    license_templates,
    simhash_blocks,
    source_divergence,
    toxicity_fst,
    variable_packing,
)
from handoff.llm.common import id_remainder, shared_path, table


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    turns = turns.unionByName(spark.createDataFrame(hard, "conv_id long, turn long, role string, text string"))
    tokens = chat_windows.token_count(public_tokenizers.path("byte_bpe_50k.json"))
    return chat_windows.digests(chat_windows.windows(turns, tokens, budget=1024, history=256))


def op2_hd_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = hd_langid.fit(docs, train=id_remainder("doc_id", 3) != 1)
    held_out = (id_remainder("doc_id", 3) == 1).alias("held_out")
    return hd_langid.identify(docs, prototypes).select("doc_id", held_out, "lang_pred", "score")


def op3_elias_fano_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return elias_fano.write_and_read(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op4_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cgk_decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_hyperplane_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperplane_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_toxicity_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_fst.fit(docs, table(spark, sf_dir, "labels"), train=id_remainder("doc_id", 5) != 0)
    held_out = (id_remainder("doc_id", 5) == 0).alias("held_out")
    return toxicity_fst.score(docs, model).select("doc_id", held_out, "score", "predicted")


def op7_variable_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    length = variable_packing.token_length(public_tokenizers.path("byte_bpe_50k.json"))
    return variable_packing.pack(table(spark, sf_dir, "documents"), length=length)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_blocks.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_ctw_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ctw_scoring.score(table(spark, sf_dir, "documents"), id_remainder("doc_id", 10) != 0)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hilbert_shards.write_shards(table(spark, sf_dir, "documents"), ["lang", "source", "n_chars"], 40, shared_path(spark, "shards"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return rows.select("doc_id", size.alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op11_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_templates.licenses(table(spark, sf_dir, "documents")).drop("places")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


def all_queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def all_sql() -> dict:
    """Operators with an SQL form; learned scores, fingerprints, files and packings have none."""
    return {"op11_license_templates": license_templates.oracle_sql(), "op12_lexical_search": lexical_search.oracle_sql(),
            "op13_source_divergence": source_divergence.oracle_sql()}
