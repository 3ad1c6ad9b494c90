"""A training-data pipeline over ``documents``: each stage calls one operator of ``arrivals_mart.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame, which is written as Parquet and reread as the next one's docs. All but
the last return the columns of ``documents``.

Nulls and repeated rows, stage by stage: null texts are scored as empty ones (quality), equal the empty text (exact
dedup), have fingerprint 0 (near dedup), have no words, so the mix never takes them (mixing), and would encode to no ids
(encode). Null ids are smaller than any other id where the largest stays, and stay only if no numbered document
of their group does where the smallest stays. Null sources mix as a source of their own; null langs pass through.
Rows that repeat are one after exact dedup; the mix may repeat a document up to three times, as rows that are
encoded each. Empty tables pass every stage as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals_mart.llm import bpe_automaton, grace_dedup, mix_apportion, quality_crf, simhash_bktree
from arrivals_mart.llm._common import read_table, written
from arrivals_mart.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality is below one half go. The classifier learns from the labelled rows among ``docs``."""
    model = quality_crf.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_crf.keep_good(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return grace_dedup.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints the one with the smallest doc_id stays."""
    return simhash_bktree.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stays as often (0 to 3 times) as the mix of sources takes it."""
    return mix_apportion.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and the text decoded from the ids."""
    coded = bpe_automaton.encode_decode(docs, tokenizer_path())
    return coded.select("row.doc_id", "row.lang", "row.source", F.size("ids").cast("bigint").alias("n_tokens"),
                        "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: SQL cannot express the stages; ``tests/llm`` holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
