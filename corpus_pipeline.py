"""From raw documents to training ids: filter, de-duplicate, mask, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before kept; all but
the last return the columns of documents. A table with clashing extra columns passes
through whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockweave.llm import mixing, pieces, queries, secret_scan, simhash, toxicity
from stockweave.llm.common import tuned
from stockweave.session import settle_table
from stockweave.sources.tables import load_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the lexicon, learned from labels that are not held out, rejects."""
    labels = load_table(tuned(spark), sf_dir, "labels").filter(~toxicity.held_out())
    return toxicity.drop_toxic(docs, toxicity.learn(toxicity.training_rows(docs, labels)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest doc_id, of every group that SimHash fingerprints link."""
    tuned(spark)
    return simhash.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets masked."""
    tuned(spark)
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    tuned(spark)
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids and exact (decoding gives the text back)."""
    tuned(spark)
    return pieces.encode(docs, pieces.load_model(queries.PIECES_MODEL))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mix", mix_sources),
    ("sentencepiece", encode_pieces),
]

# learning, components, dependent rounding and the piece search have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(tuned(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
