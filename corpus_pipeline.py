"""Corpus pipeline: documents to packed training sequences, each stage on all that the one before kept.

language ID -> toxicity -> SimHash near-duplicates -> benchmark decontamination -> best-fit packing.
The first four return the columns of ``documents``; the last returns the place of every piece. Each
stage's rows are written as Parquet to the shared folder and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from handoff.llm import cgk_decontam, hd_langid, simhash_blocks, toxicity_fst, variable_packing
from handoff.llm.common import table, write_shared

#: Shingle words and bit distance of the near-duplicate stage, as in the operator's query.
SHINGLE, DISTANCE = 3, 3
#: Vocabulary whose ids are packed.
TOKENIZER = "byte_bpe_50k.json"
#: Words whose ids a packing task keeps; its worker also holds what the stages before left there.
KEPT_WORDS = 300_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; texts without letters and texts below the learned floors on the cosine go.

    Prototypes and floors are learned from all labelled rows.
    """
    return hd_langid.keep_above_floors(docs, hd_langid.fit(docs, fit_rows=None))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar does not mark."""
    return toxicity_fst.keep_clean(docs, toxicity_fst.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash_blocks.keep_first(docs, shingle=SHINGLE, distance=DISTANCE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return cgk_decontam.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's pieces in sequences of the permitted lengths."""
    import public_tokenizers

    return variable_packing.pack(docs, length=variable_packing.token_length(public_tokenizers.path(TOKENIZER), kept=KEPT_WORDS))


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]
#: Learned scores, fingerprints and best fit have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), name)
    return docs


def all_queries() -> dict:
    return {"pipeline": run}


def all_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
