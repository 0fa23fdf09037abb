"""From raw documents to tokens: five stages, each over all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return rows with the
columns of ``docs``, extra ones included. What a stage returns is written as Parquet
and reread as the next one's ``docs``.

- Null texts and texts without a letter leave at the first stage. An empty table
  passes through all stages and stays empty.
- Of each near-duplicate group the row of smallest ``doc_id`` stays, then of smallest
  hash of all columns; rows without an id come last. Rows that share a ``doc_id``
  without being near duplicates all stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthstar.llm import bpe, contamination, language, pii, simhash
from monthstar.llm.tables import held_out, kept_rows, stored, table

#: SQL cannot express rank-order profiles, connected fingerprints or merges of ranked pairs.
ORACLE_SQL = None

#: Distinct words that a task of the last stage remembers; executors still hold what earlier stages left.
TASK_WORDS = 200_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language can be told; profiles come from the labelled rows not held out.

    Where none of these has a language, all texts with a letter are kept.
    """
    profiles = language.learn(docs.where(~held_out()))

    def keep(texts: list) -> list[bool]:
        if not profiles:
            return [len(language.grams(text)[0]) > 0 for text in texts]
        return [language.classify(text, profiles)[0] != language.UNDETERMINED for text in texts]

    return kept_rows(docs, "text", keep)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked fingerprints, that of smallest id."""
    return simhash.first_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the rule of the operator calls contaminated by a benchmark item."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"), unnamed=True)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; all documents stay, ``n_chars`` is counted anew."""
    return pii.redacted(docs, size_col="n_chars")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)``: token ids, and the text that they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, task_words=TASK_WORDS)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        bpe.decode(F.col("ids"), ranks).cast("string").alias("decoded"),
    )


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
