"""Operator 9, benchmark decontamination: size-partitioned MinHash containment search.

A test item is short and a document long, so their Jaccard similarity says little; what counts is the
share of the item's five-word shingles that the document has. Under each of a number of hash
functions an item is represented by its shingle of least hash: a document that holds a share t of the
item holds each representative with probability t. Items are partitioned by size (``part``, log2 of the number of
shingles), and each partition has its own search:

* items of at most ``WHOLE`` shingles stand for themselves entirely; a candidate has the share's number of them;
* larger ones have ``coordinates(part)`` representatives, more in the partitions of larger items, where a candidate costs
  more to verify, and need ``least_hits(part)`` of them, the most that a document at the threshold
  reaches but for a chance below ``MISS``;
* a document with fewer shingles than the share of the item's can't hold it and makes no candidate.

The exact count of common distinct shingles then decides on every candidate.

DataFrame functions only. Documents are read once, in one stage: words, shingle hashes and the probe of the
items' shingles run without moving a text; only shingles that some item has go on. The items' shingle hashes are
broadcast up to ``BROADCAST_ROWS`` rows, counted first; beyond that the same join shuffles. A passage
found in a third of all documents gives rows in proportion to the documents, pre-aggregated by document.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text, lower-cased by Unicode rules (not only A-Z); a text of one to four
words is a single shingle, a null, empty or blank one has none and matches nothing. Rows with the same doc_id and text
are one document. Items are told apart by item_id and text: items that share an id, or have none, are searched each, and
rows with the same id and text are one item. Empty tables give no pairs. Extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linededup import NO_ID
from .runtime import cut, packed, row_key, unpacked

WORDS, CONTAINMENT = 5, 0.75
#: Items up to this size go whole; larger ones go by representatives and are missed with a chance below MISS.
WHOLE, MISS = 32, 1e-6
#: Size partitions that differ; items of 2**20 shingles and more are one partition.
PARTS = 21
#: A document, and an item: id (NO_ID: null) and hash of the text.
DOC, ITEM = ["_d", "_k"], ["_i", "_t"]
#: Item shingles that are broadcast (some 100 MB in memory at most).
BROADCAST_ROWS = 1 << 21
BLANK = " \t\n\x0b\f\r"


def shingles(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per shingle of ``text``, with repeats: ``keys``, the number of such rows ``n_doc``, and its 64-bit hash ``sh``."""
    words = F.split(F.btrim(F.lower("text"), F.lit(BLANK)), r"[\x20\x09-\x0D]+")
    df = df.select(*keys, words.alias("w")).where(F.get("w", F.lit(0)) != "")
    n = F.greatest(F.size("w") - WORDS, F.lit(0)) + 1
    at = df.select(*keys, "w", n.alias("n_doc"), F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - WORDS, F.lit(0)))).alias("i"))
    return at.select(*keys, "n_doc", F.xxhash64(F.least(F.size("w"), F.lit(WORDS)),
                                       *[F.get("w", F.col("i") + j) for j in range(WORDS)]).alias("sh"))


def coordinates(part: int) -> int:
    """Representatives of an item of 2**part to 2**(part + 1) - 1 shingles."""
    return min(64, WHOLE + 4 * max(0, part - int(math.log2(WHOLE))))


def least_hits(part: int) -> int:
    """The greatest h with P(Binomial(coordinates, CONTAINMENT) < h) < MISS."""
    n, below, h = coordinates(part), 0.0, 0
    while True:
        below += math.comb(n, h) * CONTAINMENT ** h * (1 - CONTAINMENT) ** (n - h)
        if below >= MISS:
            return h
        h += 1


def item_shingles(items: DataFrame) -> DataFrame:
    """(_i, _t, sh, n_item, part): distinct shingles, their number, and the item's size partition."""
    from pyspark.sql import Window
    keyed = items.select(F.coalesce(F.col("item_id").cast("long"), F.lit(NO_ID)).alias("_i"), row_key().alias("_t"), "text")
    distinct = shingles(keyed, ITEM).select(*ITEM, "sh").distinct()
    n = F.count(F.lit(1)).over(Window.partitionBy(*ITEM))
    return distinct.withColumn("n_item", n).withColumn("part", F.least(F.floor(F.log2("n_item")), F.lit(PARTS - 1)).cast("int"))


def sketch(own: DataFrame) -> DataFrame:
    """(_i, _t, coordinate, sh, n_item, least): representatives and the hits that make a candidate, by partition."""
    small = own.where(F.col("n_item") <= WHOLE).select(
        *ITEM, F.col("sh").alias("coordinate"), "sh", "n_item", F.ceil(F.col("n_item") * CONTAINMENT).cast("long").alias("least"))
    count = F.array(*[F.lit(coordinates(p)) for p in range(PARTS)])
    least = F.array(*[F.lit(least_hits(p)).cast("long") for p in range(PARTS)])
    most = coordinates(PARTS - 1)
    large = own.where(F.col("n_item") > WHOLE).groupBy("part", *ITEM, "n_item").agg(
        F.array(*[F.min(F.struct(F.xxhash64("sh", F.lit(j)), "sh"))["sh"] for j in range(most)]).alias("minima"))
    large = large.select(*ITEM, F.posexplode(F.slice("minima", F.lit(1), F.get(count, F.col("part")))).alias("coordinate", "sh"),
                         "n_item", F.get(least, F.col("part")).alias("least"))
    return small.unionByName(large.withColumn("coordinate", F.col("coordinate").cast("long")))


def contaminated_pairs(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, _k, item_id, n_item, n_shared, containment) of documents that hold an item."""
    own = cut(item_shingles(items), "items")
    index = own.select("sh").distinct()
    if index.count() <= BROADCAST_ROWS:
        index = F.broadcast(index)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_d"), row_key().alias("_k"), "text")
    # n_doc counts repeats: at least the number of distinct shingles
    hits = cut(shingles(keyed, DOC).join(index, "sh", "left_semi").groupBy(*DOC, "n_doc", "sh").agg(
        F.count(F.lit(1)).alias("times")).drop("times"), "hits")
    candidates = (hits.join(sketch(own), "sh").where(F.col("n_doc") >= CONTAINMENT * F.col("n_item"))
                  .groupBy(*DOC, *ITEM, "n_item", "least")
                  .agg(F.countDistinct("coordinate").alias("hits")).where("hits >= least"))
    shared = (candidates.join(hits.select(*DOC, "sh"), DOC).join(own.select(*ITEM, "sh"), [*ITEM, "sh"])
              .groupBy(*DOC, *ITEM, "n_item").agg(F.count(F.lit(1)).alias("n_shared")))
    return shared.where(F.col("n_shared") >= CONTAINMENT * F.col("n_item")).select(
        F.when(F.col("_d") != NO_ID, F.col("_d")).alias("doc_id"), "_k", F.when(F.col("_i") != NO_ID, F.col("_i")).alias("item_id"),
        "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that hold no item."""
    bad = cut(contaminated_pairs(docs, items).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_d"), "_k").distinct(), "bad")
    keyed = packed(docs, _d=F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), _k=row_key())
    return unpacked(keyed.join(bad, ["_d", "_k"], "left_anti"), docs.columns)
