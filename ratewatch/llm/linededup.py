"""Operator 8, line dedup: repeated runs of lines, found by prefix doubling over line IDs.

A document is its sequence of lines with a word (blank lines belong to the line before them). Every
line gets as ID the first place, (doc_id, text hash, line number), where that line occurs anywhere.
Prefix doubling then names blocks of 2, 4, 8 ... lines by the pair of their halves' names, a name
being again the first place of that block, and places whose block occurs once drop out: what stays
at depth d are the suffix array's intervals with a longest common prefix of d lines or more.

A run of lines counts as repeated when it has ``min_chars`` characters or more and occurs at an
earlier place; all its lines are deleted there, the first copy stays. It is enough to look at the
shortest blocks of ``min_chars`` from each line on, and up to each line: every line of a repeated
run lies in one such block inside the run. Blocks are at most ``min_chars`` lines, so depth is
bounded. A block of any length is named by the two overlapping power-of-two blocks that cover it.
Every different line stays in the corpus once at least.

DataFrame functions only. Lines travel as two 64-bit hashes; counts are summed before the shuffle,
and joins back are plain ones, in which Spark splits a hot line. Steps are written in the shared folder, so lost
executors cost no long lineage. Only the last join moves texts.

Null and empty texts have no lines and stay as they are. Ties: places are compared by doc_id (null
first), text hash, line number; rows with the same doc_id and text are one document and get equal
results. Empty tables give no rows. Extra columns pass through; ``text`` is replaced and
``n_lines``, ``n_deleted`` and ``n_runs`` are set, also where the input has columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import cut, packed, row_key, unpacked

#: Characters from which a repeated run is deleted.
MIN_CHARS = 100
#: A line end before a line that has a word.
LINE = r"\n(?=[ \t\x0B\f\r]*[^ \t\n\x0B\f\r])"
WORD = r"[^\x20\x09-\x0D]"
NO_ID = -(1 << 63)
PLACE = ["_d", "_k", "_s"]


def _shortest(lengths: Column, least: int) -> Column:
    """How many leading entries of an array sum to ``least``; 0: all together don't."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
    return F.aggregate(
        lengths, start,
        lambda a, x: F.when(a["sum"] >= least, a).otherwise(F.struct((a["sum"] + x).alias("sum"), (a["n"] + 1).alias("n"))),
        lambda a: F.when(a["sum"] >= least, a["n"]).otherwise(F.lit(0)))


def line_table(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line with a word: place, two line hashes, lengths of the shortest blocks of
    ``min_chars`` that begin and that end with it."""
    split = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_d"), row_key().alias("_k"),
                        F.transform(F.split("text", LINE), lambda u: F.substring_index(u, "\n", 1)).alias("lines"))
    split = split.withColumn("n", F.transform("lines", lambda x: F.when(x.rlike(WORD), F.length(x)).otherwise(F.lit(0))))
    n, m = F.col("n"), min_chars
    ahead = F.transform(n, lambda x, i: F.when(x >= m, F.lit(1)).otherwise(_shortest(F.slice(n, i + 1, F.lit(m)), m)))
    behind = F.transform(n, lambda x, i: F.when(x >= m, F.lit(1)).otherwise(
        _shortest(F.reverse(F.slice(n, F.greatest(F.lit(1), i + 2 - m), F.least(i + 1, F.lit(m)))), m)))
    rows = split.select("_d", "_k", F.posexplode(F.arrays_zip(F.col("lines").alias("line"), n.alias("n"), ahead.alias("ahead"),
                                                               behind.alias("behind"))).alias("_s", "x"))
    return rows.where(F.col("x.n") > 0).select(
        *PLACE, F.xxhash64("x.line").alias("h1"), F.xxhash64(F.lit(1), "x.line").alias("h2"), "x.ahead", "x.behind")


def _named(rows: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
    """Rows whose key occurs again, with ``name``, the first place of the key."""
    first = rows.groupBy(*by).agg(F.min(F.struct(*PLACE)).alias("name"), F.count(F.lit(1)).alias("n"))
    # written: both sides of the join are then plain exchanges, and Spark splits the rows of a hot key
    return rows.join(cut(first.where("n > 1").drop("n"), "first"), by).select(*PLACE, "name", *keep)


def repeated_blocks(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Blocks (_d, _k, _s, size) of the shortest qualifying lengths that occur at an earlier place."""
    lines = cut(_named(line_table(docs, min_chars), ["h1", "h2"], ["ahead", "behind"]).dropDuplicates(PLACE), "lines")
    blocks = lines.select("_d", "_k", "_s", F.col("ahead").alias("size")).unionByName(
        lines.select("_d", "_k", (F.col("_s") - F.col("behind") + 1).alias("_s"), F.col("behind").alias("size")))
    blocks = blocks.where("size > 1").dropDuplicates()
    later = F.col("name") < F.struct(*PLACE)
    found = [lines.where(later & (F.col("ahead") == 1)).select(*PLACE, F.lit(1).alias("size"))]
    longest = blocks.agg(F.max("size")).first()[0] or 1
    names, depth = lines.select(*PLACE, "name"), 1
    while longest > 1:
        # blocks of depth .. 2 depth - 1 lines: the names of their first and last ``depth`` lines
        now = blocks.where(F.col("size").between(max(2, depth), 2 * depth - 1))
        if depth > 1:
            heads = now.join(names.withColumnRenamed("name", "head"), PLACE)
            tails = names.select("_d", "_k", F.col("_s").alias("_e"), F.col("name").alias("tail"))
            whole = heads.withColumn("_e", F.col("_s") + F.col("size") - depth).join(tails, ["_d", "_k", "_e"])
            found.append(cut(_named(whole, ["size", "head", "tail"], ["size"]).where(later).select(*PLACE, "size"), "later"))
        if 2 * depth > longest:
            break
        nexts = names.select("_d", "_k", (F.col("_s") - depth).alias("_s"), F.col("name").alias("tail"))
        pairs = names.withColumnRenamed("name", "head").join(nexts, PLACE)
        names, depth = cut(_named(pairs, ["head", "tail"], []), "names"), 2 * depth
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def runs(blocks: DataFrame) -> DataFrame:
    """Overlapping or touching blocks of a document joined to maximal runs [start, stop)."""
    order = Window.partitionBy("_d", "_k").orderBy("_s", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(before >= F.col("_s"), 0).otherwise(1)
    return (blocks.withColumn("stop", F.col("_s") + F.col("size")).withColumn("opens", opened)
            .withColumn("run", F.sum("opens").over(order)).groupBy("_d", "_k", "run")
            .agg(F.min("_s").alias("start"), F.max("stop").alias("stop")).drop("run"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Documents without the later copies of repeated runs, with ``n_lines`` (lines with a word in
    the input), ``n_deleted`` and ``n_runs``."""
    found = runs(repeated_blocks(docs, min_chars))
    per_doc = cut(found.groupBy("_d", "_k").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("_runs")), "runs")
    keyed = packed(docs, text=F.col("text"), _d=F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), _k=row_key())
    joined = keyed.join(per_doc.hint("shuffle_hash"), ["_d", "_k"], "left").withColumn("_units", F.split("text", LINE))
    gaps = F.transform(                            # what lies between the runs
        F.arrays_zip(F.concat(F.array(F.lit(0)), F.transform("_runs", lambda r: r["stop"])).alias("a"),
                     F.concat(F.transform("_runs", lambda r: r["start"]), F.array(F.size("_units"))).alias("b")),
        lambda g: F.slice("_units", g["a"] + 1, g["b"] - g["a"]))
    text = F.when(F.col("_runs").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(gaps), "\n"))
    deleted = F.aggregate("_runs", F.lit(0), lambda s, r: s + r["stop"] - r["start"])
    blank = F.when(F.col("text").rlike(r"\A[ \t\x0B\f\r]*(\n|\z)"), 1).otherwise(0)
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("_units") - blank)
    return unpacked(joined, docs.columns, text=text, n_lines=lines.cast("long"),
                    n_deleted=F.coalesce(deleted, F.lit(0)).cast("long"),
                    n_runs=F.when(F.col("_runs").isNull(), 0).otherwise(F.size("_runs")).cast("long"))
