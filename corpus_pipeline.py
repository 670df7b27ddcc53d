"""The training-data pipeline over ``documents``: five stages, each reading what its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and reread as the next stage's documents. All but the last return the columns
of documents.

1. ``language_id``: documents without a determinable language go.
2. ``line_dedup``: later copies of repeated line runs are deleted; a document that has no word left goes.
3. ``near_dedup``: one row of each near-duplicate component stays, the first by doc_id (nulls last) and text hash.
4. ``decontamination``: documents that hold a benchmark item go.
5. ``sentencepiece``: the remaining texts are encoded; token counts, ids and a round-trip flag are added.

Null texts go in the first stage; texts that are empty there have no language and go too. The stages'
treatment of ties, repeated rows, very long texts and empty tables is that of their operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.llm.decontam import decontaminate
from ratewatch.llm.langid import UNDETERMINED, fit_profiles, held_out, identify
from ratewatch.llm.linededup import WORD, dedup_lines
from ratewatch.llm.neardup import leave_one
from ratewatch.llm.pieces import encode
from ratewatch.llm.queries import VOCABULARY
from ratewatch.llm.runtime import cut, table, tune


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: keep documents whose language can be told."""
    tune(spark)
    judged = identify(docs, fit_profiles(docs.where(~held_out())))
    return judged.where(F.col("lang_pred") != UNDETERMINED).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: delete later copies of repeated line runs, and documents that lose every word."""
    tune(spark)
    kept = dedup_lines(docs)
    # n_chars counts the text as it is now
    kept = kept.where((F.col("n_deleted") == 0) | F.col("text").rlike(WORD)).select(*docs.columns)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one row of each near-duplicate component stays."""
    tune(spark)
    return leave_one(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: token ids of every remaining text."""
    tune(spark)
    return encode(docs, VOCABULARY)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("sentencepiece", sentencepiece)]

#: SQL can't express rank-order profiles or the segmentation; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
