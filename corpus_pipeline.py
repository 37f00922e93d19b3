"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``, whatever these are:

1. toxicity      documents that the pattern grammar scores 0.3 or more go
2. near_dedup    one document of each class of near-duplicates stays
3. pii           personal data in texts is replaced by its kind in brackets
4. mixing        sources are mixed to their target weights, repeating epochs
5. packing       texts become token pieces, packed into 2048-token sequences

Null texts count as empty; rows with null or repeated ids pass like others; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwise.llm import minhash, mixing, packing, pii, toxicity
from tickwise.llm.common import materialise, prepare, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash.deduplicated(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pii.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset; a document
    that the mix repeats is packed once per copy."""
    prepare(spark)
    return packing.pack(materialise(packing.tokenize(docs, added=True)))


STAGES = [("toxicity", remove_toxic), ("near_dedup", remove_near_duplicates), ("pii", redact_personal_data),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Fitted models, components and tokenizers can't be written as SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
