"""Registered queries of the operators: thin, each over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .runtime import table

#: Public subword vocabulary with byte fallback; only its place is known here.
VOCABULARY = os.environ.get("LLM_VOCABULARY", "/opt/tokenizers/piece_bpe_32k.model")
#: Rules of op4, as its contract gives them: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 40 shards along a Hilbert curve; law ``rows``."""
    from pyspark.sql import functions as F

    from .hilbert import shard_documents
    return shard_documents(table(spark, sf_dir, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    from .neardup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents")).drop("tk")


def op3_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the filter's pair model, and the exact base score."""
    from .bloomlm import score_documents
    return score_documents(table(spark, sf_dir, "documents"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the four rules."""
    from .urlrules import judge_urls
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op6_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 200-byte strings."""
    from .substrings import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokeniser fertility and base rules of every document."""
    from pyspark.sql import functions as F

    from .fertility import FIELDS, measure, verdicts
    judged = verdicts(measure(table(spark, sf_dir, "documents"), VOCABULARY))
    counts = [F.col("fertility")[f].alias(f) for f in FIELDS]
    return judged.select("doc_id", *counts, F.col("fertility")["script"].alias("script"),
                         "chars_per_token", "byte_share", "entropy_share", "base_failed", "kept")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, its ids decoded again and compared."""
    from .pieces import encode
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY)
    return coded.select("doc_id", "n_tokens", "n_byte_tokens", "round_trip", "token_ids")


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later copies of repeated line runs."""
    from pyspark.sql import functions as F

    from .linededup import dedup_lines
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_deleted", "n_runs", F.length("text").cast("long").alias("kept_chars"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and benchmark items that they hold."""
    from .decontam import contaminated_pairs
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_k")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank-order language profiles, learned from three quarters of the documents, on all of them."""
    from .langid import held_out, predict_languages
    predicted = predict_languages(table(spark, sf_dir, "documents"))
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    from .lexical import ranked_search
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, equal payloads once, and read back."""
    import uuid

    from .runtime import shared_dir
    from .warc import resolve, write_archive
    path = f"{shared_dir(spark).rstrip('/')}/llm-archive-{uuid.uuid4().hex}"
    write_archive(table(spark, sf_dir, "pages"), path)
    return resolve(spark, path)


def planted_runs(docs: DataFrame) -> DataFrame:
    """The documents of op13's contract: in one of ten by crc32 of doc_id, a tail of the words is made periodic."""
    from pyspark.sql import functions as F

    key = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8"))
    docs = docs.select("doc_id", "text", key.alias("h"), F.floor(key / 10).alias("g"))
    words = F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    docs = docs.select("doc_id", "text", "g", words.alias("w"))
    docs = docs.select("*", F.size("w").cast("long").alias("n"))
    docs = docs.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).alias("a"))
    docs = docs.select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    a, p = F.col("a"), F.col("p")
    periodic = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get(
        "w", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")
    return docs.select("doc_id", F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, and the text without their repeats."""
    from pyspark.sql import functions as F

    from .periodic import longest, periodic_runs, runs_text
    found = periodic_runs(planted_runs(table(spark, sf_dir, "documents")))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest(F.col("runs")).alias("top"),
                         F.sha2(runs_text(F.col("runs")), 256).alias("runs_sha256"),
                         F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", F.col("top.start").alias("start"), F.col("top.length").alias("length"),
                        F.col("top.period").alias("period"),
                        F.expr("(1000 * top.length) div top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES = {f.__name__: f for f in (op1_hilbert_shards, op2_near_duplicates, op3_bloom_lm, op4_url_rules, op5_fertility, op6_repeated_substrings, op7_sentencepiece,
                                   op8_line_runs, op9_decontamination, op10_language_id, op11_ranked_search, op12_warc,
                                   op13_periodic_runs)}
