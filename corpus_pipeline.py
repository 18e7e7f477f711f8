"""From raw documents to packed sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``.
Rows with null or empty texts, repeated rows and further columns pass through a stage by the
rules its operator states; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickbasin.llm import ngram_join, packing, pii, quality_cnn, toxicity
from clickbasin.llm.entries import QUALITY_FOLDS, QUALITY_HELD_OUT, TOXIC_FOLDS, TOXIC_HELD_OUT
from clickbasin.llm.support import labelled_sample, prepared, stored, table

# A document is rejected for quality below the first, for toxicity from the second on.
LEAST_QUALITY, MOST_TOXICITY = 0.5, 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality network rejects. Empty texts are scored like others."""
    labels = table(spark, sf_dir, "labels")
    sample = labelled_sample(docs, labels, "quality", QUALITY_FOLDS, QUALITY_HELD_OUT, quality_cnn.SAMPLE_ROWS)
    return docs.where(quality_cnn.quality(quality_cnn.train(sample), F.col("text")) >= LEAST_QUALITY)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity lexicon rejects; it is learned from what is left of the labelled ones."""
    labels = table(spark, sf_dir, "labels")
    sample = labelled_sample(docs, labels, "toxic", TOXIC_FOLDS, TOXIC_HELD_OUT, toxicity.SAMPLE_ROWS)
    return docs.where(toxicity.toxicity(toxicity.learn(sample), F.col("text")) < MOST_TOXICITY)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data; ``n_chars`` follows the text."""
    return pii.masked(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token runs of all documents, packed into sequences."""
    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("toxicity", clean),
    ("near_duplicates", distinct),
    ("personal_data", private),
    ("packing", packed),
]

# The stages train models, sketch and tokenize: tests hold them against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
