"""Operator 11, ranked lexical search: term owners in a pipeline, item bundles with sparse accumulators.

The index is split by term: every term belongs to one of ``OWNERS`` owners, by the share of the documents
that hold it, rarest first. An item travels through the owners as a bundle: its terms and a sparse list
of document accumulators. At each stage bundles and the owner's postings meet in a cogroup, every posting adds its
integer contribution, and the bundle goes on to the next owner; after the last one the best are selected.

No stage holds a whole item or a whole term: documents are dealt into slices of some ``SLICE`` documents and
items into blocks of some ``BLOCK``, and a bundle stands for one item on one slice. So a group is bounded by
slice and block size, whatever the frequency of a term, and the number of groups grows with the input.
Accumulators are dropped only where that is exact: an accumulator plus the greatest contributions of all
owners to come (the owners' terms carry their exact maxima) that stays below the ``top``-th best of
its own slice can't be among the best. Documents that come back later with part of their score stay below for the
same reason. Equal scores are kept until the order by doc_id decides.

Score of a document for an item: the sum over the item's distinct terms of
``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` with ``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))`` and
``m = 10 + (90 * n * N) div L``: integers from 64-bit arithmetic, except for the logarithm.

Terms are runs of ASCII letters and digits and of all characters above 0x7F; only A-Z are lower-cased. Rows
without a term, null texts among them, are no documents of the count N and are never found. Every row of
either table stands for itself: rows that repeat an id are ranked and answered each; null doc_ids come
last among equal scores. Items without terms and items that match nothing give no rows; empty tables neither.
Extra columns aren't read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import cut, tune
from .textbatch import LOWER

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
OWNERS, SLICE, BLOCK, TOP = 4, 8192, 1024, 10
#: Rows of counted terms in an Arrow batch.
ROWS_OUT = 1 << 17
NO_ID = (1 << 63) - 1
PLAN = pa.list_(pa.struct([("owner", pa.int32()), ("tid", pa.int64()), ("w", pa.int64()), ("most", pa.int64())]))
ACCUMULATORS = "rows array<long>, ids array<long>, scores array<long>"
BUNDLE = f"iid long, item_id {{}}, slice long, block long, plan array<struct<owner:int,tid:long,w:long,most:long>>, {ACCUMULATORS}"


def _counted(batches):
    """(key, n, term, tf) of every text with a term: one row for each distinct term, and one in front with the empty
    term, which stands for the text itself."""
    for batch in batches:
        keys, n, terms, times = [], [], [], []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
            found = Counter(TERM.findall(text.as_py().translate(LOWER)) if text.is_valid else ())
            if found:
                total = found.total()
                keys += [key] * (len(found) + 1)
                n += [total] * (len(found) + 1)
                terms += [b"", *found]
                times += [total, *found.values()]
            if len(keys) >= ROWS_OUT:
                yield _terms_batch(keys, n, terms, times)
                keys, n, terms, times = [], [], [], []
        if keys:
            yield _terms_batch(keys, n, terms, times)


def _terms_batch(keys, n, terms, times):
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.binary()).cast(pa.string()),
                                       pa.array(times, pa.int64())], ["key", "n", "term", "tf"])


def text_terms(df: DataFrame, key) -> DataFrame:
    """One row per text and distinct term, and one with the empty term per text that has any."""
    raw = df.select(key.alias("key"), F.encode("text", "UTF-8").alias("text"))
    return raw.mapInArrow(_counted, "key long, n long, term string, tf long")


def postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(row, id, n, tid, tf) of the documents' terms that are in ``vocabulary`` (term, tid). ``row`` tells documents
    apart and is negative where doc_id is null; ``id`` is the doc_id (null: the greatest long)."""
    serial, doc_id = F.monotonically_increasing_id(), F.col("doc_id").cast("long")
    keyed = docs.select("text", F.struct(F.when(doc_id.isNull(), -1 - serial).otherwise(serial).alias("row"),
                                         F.coalesce(doc_id, F.lit(NO_ID)).alias("id")).alias("key"))

    def count(batches):
        for batch in batches:
            key = batch.column("key")
            place = pa.array(np.arange(batch.num_rows), pa.int64())
            plain = pa.RecordBatch.from_arrays([place, batch.column("text")], ["key", "text"])
            for part in _counted([plain]):
                own = key.take(part.column("key"))
                yield pa.RecordBatch.from_arrays([own.field("row"), own.field("id"), *part.columns[1:]], ["row", "id", "n", "term", "tf"])

    raw = keyed.select("key", F.encode("text", "UTF-8").alias("text"))
    found = raw.mapInArrow(count, "row long, id long, n long, term string, tf long")
    return found.join(vocabulary, "term").select("row", "id", "n", "tid", "tf")


def _sorted_postings(right: pa.Table):
    tid = right.column("tid").to_numpy()
    order = np.argsort(tid, kind="stable")
    tid = tid[order]
    return tid, [right.column(c).to_numpy()[order] for c in ("row", "id", "impact")]


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` best: highest score, then least id, then row."""
    return np.lexsort((rows, ids, -scores))[:top]


def _stage(owner: int, top: int):
    """Bundles of one slice and block through one owner."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tid, (row, id_, impact) = _sorted_postings(right)
        held = [(np.asarray(r.values), np.asarray(i.values), np.asarray(s.values)) for r, i, s in
                zip(left.column("rows"), left.column("ids"), left.column("scores"))]
        every = np.concatenate([row, *[h[0] for h in held]])
        docs, at = np.unique(every, return_index=True)
        ids = np.concatenate([id_, *[h[1] for h in held]])[at]
        place = np.searchsorted(docs, row)
        out = []
        plans = left.column("plan").to_pylist()
        for plan, (own, _, scores) in zip(plans, held):
            sums = np.zeros(len(docs), np.int64)
            sums[np.searchsorted(docs, own)] = scores
            to_come = 0
            for term in plan:
                if term["owner"] == owner:
                    a, b = np.searchsorted(tid, [term["tid"], term["tid"] + 1])
                    sums[place[a:b]] += term["w"] * impact[a:b]      # a document holds a term once
                elif term["owner"] > owner:
                    to_come += term["most"]
            live = np.flatnonzero(sums)
            if len(live) > top:
                least = np.partition(sums[live], len(live) - top)[len(live) - top]
                live = live[sums[live] + to_come >= least]
            if owner == OWNERS - 1:
                live = live[best(sums[live], ids[live], docs[live], top)]
            out.append((docs[live], ids[live], sums[live]))
        lists = []
        for i in range(3):
            parts = [o[i] for o in out]
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
            lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))))
        keep = [left.column(c) for c in ("iid", "item_id", "slice", "block")]
        return pa.Table.from_arrays([*keep, pa.array(plans, PLAN), *lists], ["iid", "item_id", "slice", "block", "plan", "rows", "ids", "scores"])
    return run


def _numbers(n: int):
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item."""
    spark = tune(docs.sparkSession)
    items = cut(items.select(F.monotonically_increasing_id().alias("iid"), "item_id", "text"), "items")
    item_terms = cut(text_terms(items, F.col("iid")).where("term <> ''").select(F.col("key").alias("iid"), "term"), "item-terms")
    vocabulary = item_terms.select("term").distinct().select("term", F.monotonically_increasing_id().alias("tid"))
    whole = spark.createDataFrame([("", -1)], "term string, tid long")
    vocabulary = cut(vocabulary.unionByName(whole), "vocabulary")
    raw = cut(postings(docs, vocabulary), "postings")

    total = raw.where("tid = -1").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs, n_terms = int(total[0]), int(total[1])
    m = F.lit(10) + F.expr(f"(90 * n * {n_docs}L) div {max(1, n_terms)}L")
    raw = raw.where("tid >= 0").withColumn("m", m).select(
        "row", "id", "tid", F.expr("(1000000000L * tf) div (1000 * tf + 8 * m)").alias("impact"))
    terms = raw.groupBy("tid").agg(F.count(F.lit(1)).alias("df"), F.max("impact").alias("impact"))
    w = F.floor(F.lit(1000) * F.log((F.lit(2.0 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")))
    # owners by document frequency: up to 1/64, 1/16, 1/4 of the documents, and the rest
    owner = sum((F.when(F.col("df") * 4 ** (OWNERS - 1 - o) > n_docs, 1).otherwise(0) for o in range(OWNERS - 1)), F.lit(0))
    terms = cut(terms.select("tid", w.cast("long").alias("w"), (w * F.col("impact")).cast("long").alias("most"),
                             owner.cast("int").alias("owner")), "terms")
    slices = max(1, -(-n_docs // SLICE))
    index = cut(raw.join(terms.select("tid", "owner"), "tid").select(
        "owner", F.pmod(F.xxhash64("row"), F.lit(slices)).alias("slice"), "row", "id", "tid", "impact"), "index")

    plan = (item_terms.join(vocabulary, "term").join(terms, "tid").groupBy("iid")
            .agg(F.collect_list(F.struct("owner", "tid", "w", "most")).alias("plan")))
    blocks = max(1, -(-items.count() // BLOCK))
    none = F.array().cast("array<long>")
    bundles = items.select("iid", "item_id").join(plan, "iid").select(
        "iid", "item_id", F.explode(_numbers(slices)).alias("slice"),
        F.pmod(F.xxhash64("iid"), F.lit(blocks)).cast("long").alias("block"), "plan",
        none.alias("rows"), none.alias("ids"), none.alias("scores"))
    schema = BUNDLE.format(items.schema["item_id"].dataType.simpleString())
    every = F.explode(_numbers(blocks)).alias("block")
    for o in range(OWNERS):
        own = index.where(F.col("owner") == o).select("slice", "row", "id", "tid", "impact", every)
        bundles = bundles.groupBy("slice", "block").cogroup(own.groupBy("slice", "block")).applyInArrow(_stage(o, top), schema)
    found = bundles.select("iid", "item_id", F.inline(F.arrays_zip("rows", "ids", "scores")))
    order = Window.partitionBy("iid").orderBy(F.desc("scores"), "ids", "rows")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"),
                         F.when(F.col("rows") >= 0, F.col("ids")).alias("doc_id"), F.col("scores").alias("score"))
