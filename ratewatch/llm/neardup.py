"""Operator 2, MinHash near-dedup by an inverted join over signature coordinates.

Every document becomes the set of its distinct five-word shingles and a MinHash signature of
``COORDINATES`` numbers. Documents with equal sets form one class. Classes are posted under their
(coordinate, value) pairs; two classes that collide in ``LEAST_MATCHES`` pairs or more are candidates.

Counting collisions is pruned by two rules. Prefix: a class's pairs are put in order, rarest first,
pairs that only one class has are left out, and of the m that remain only the first
m - LEAST_MATCHES + 1 are posted, since two candidates must meet in one of those. Skip: the long lists
of frequent pairs, at the end of that order, are never merged; a candidate's remaining collisions are
counted by intersecting the two signatures.

Groups of near copies are joined without all their pairs. First each posted list is linked to one hub,
the class that shares most of its coordinates with others: the text that the copies were made from,
if it is there. Then classes of a list that lie in *different* components are paired, once, where
they first meet. So links between different texts aren't lost: a pair in one component needs no
comparison. For that last step the shingles that occur twice among the classes in question are counted
and set as bits for each class: sets of n and m shingles that are similar enough have 3/7 (n + m) in
common, and a pair whose counts and bitmaps leave less room is no candidate. Every link is confirmed on
the full shingle sets. A third of all documents in one group costs about as many rows as documents.

At similarity 0.75 a pair collides in 30 of 64 coordinates but with a chance below 1e-6; shingles are
compared by 56-bit hashes.

Null, empty and blank texts have no shingle and are linked with nothing; a text of one to four words is one
shingle. Rows that repeat a doc_id are documents of their own with one name; a null doc_id stays
null unless its component has another. Very long texts are handled in one row's arrays. Empty
tables give no rows. Extra columns aren't read; ``keep_one`` and ``leave_one`` pass them through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .runtime import cut, packed, row_key, unpacked
from .textbatch import U, buffers, mix, row_groups, shingle_hashes, span_hashes, word_bounds

WORDS, COORDINATES, LEAST_MATCHES = 5, 64, 30
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Longs of a class's bitmap of shared shingles.
BITMAP = 16
#: Rows and bytes worked on at once; eight bits tell the rows of a chunk apart in a sort.
CHUNK_ROWS, CHUNK = 256, 1 << 21
_RANDOM = np.random.default_rng(20240229)
FACTORS = _RANDOM.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * U(2) + U(1)
OFFSETS = _RANDOM.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def shingle_sets(column: pa.Array):
    """(first row, row offsets, 56-bit hashes): the distinct shingles of chunks of rows, sorted."""
    buf, off = buffers(column, lower=True)
    for i, j in row_groups(off, CHUNK, CHUNK_ROWS):
        b, o = buf[off[i]:off[j]], off[i:j + 1] - off[i]
        starts, ends, first = word_bounds(b, o)
        hashes, rows = shingle_hashes(span_hashes(b, starts, ends), first, WORDS)
        keyed = np.unique(rows.astype(U) << U(56) | hashes >> U(8))
        yield i, np.searchsorted(keyed >> U(56), np.arange(j - i + 1)), keyed & U((1 << 56) - 1)


def _sketch(batches):
    for batch in batches:
        n = batch.num_rows
        size, set_hash = np.zeros(n, np.int64), np.zeros((n, 2), U)
        signature = np.zeros((n, COORDINATES), np.int32)
        for i, off, hashes in shingle_sets(batch.column("text")):
            rows = np.flatnonzero(np.diff(off)) + i
            if not len(rows):
                continue
            size[i:i + len(off) - 1] = np.diff(off)
            at = off[:-1][np.diff(off) > 0]
            set_hash[rows, 0] = np.add.reduceat(mix(hashes + U(1)), at)
            set_hash[rows, 1] = np.add.reduceat(mix(hashes ^ U(0xA5A5A5A5A5A5A5A5)), at)
            for c in range(COORDINATES):
                value = np.minimum.reduceat(hashes * FACTORS[c] + OFFSETS[c] >> U(32), at)
                signature[rows, c] = value.astype(np.uint32).view(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * COORDINATES + 1, COORDINATES, dtype=np.int32)),
                                         pa.array(signature.ravel()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tk"), pa.array(size), pa.array(set_hash[:, 0].view(np.int64)),
             pa.array(set_hash[:, 1].view(np.int64)), lists], ["doc_id", "tk", "n", "h1", "h2", "signature"])


def _confirm(batches):
    """Pairs with both texts -> pairs whose full sets are similar enough."""
    for whole in batches:
        for start in range(0, whole.num_rows, CHUNK_ROWS):
            batch = whole.slice(start, CHUNK_ROWS)
            sets = []
            for name in ("text_a", "text_b"):
                own: list[np.ndarray] = []
                for _, off, hashes in shingle_sets(batch.column(name)):
                    own += np.split(hashes, off[1:-1])
                sets.append(own)
            keep = np.zeros(batch.num_rows, bool)
            for r, (x, y) in enumerate(zip(*sets)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[r] = common > 0 and 100 * common >= PERCENT * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))


def _spread(batches):
    """Classes' texts -> one row for each distinct shingle."""
    for batch in batches:
        ids = batch.column("k")
        for i, off, hashes in shingle_sets(batch.column("text")):
            rows = pa.array(np.repeat(np.arange(len(off) - 1), np.diff(off)) + i)
            yield pa.RecordBatch.from_arrays([ids.take(rows), pa.array(hashes.view(np.int64))], ["k", "sh"])


def _similar_sizes(x: str, y: str):
    """Similar enough sets can't differ more in size than this."""
    return 100 * F.least(x, y) >= PERCENT * F.greatest(x, y)


def _posted(tokens: DataFrame) -> DataFrame:
    """(k, n, tokens, prefix): each class's shared pairs, rarest first, and how many are posted."""
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # written, like the other sums joined back: Spark can then split the rows of a hot pair
    return (tokens.join(cut(shared, "df"), "token").groupBy("k", "n")
            .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
            .where(F.size("t") >= LEAST_MATCHES)
            .select("k", "n", F.col("t.token").alias("tokens"), (F.size("t") - LEAST_MATCHES + 1).alias("prefix")))


def link_classes(posted: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root) of the classes' components; ``texts`` (k, n, tokens, text) has a row for every posted class."""
    lists = posted.select("k", "n", (-F.size("tokens")).alias("o"),
                          F.explode(F.slice("tokens", F.lit(1), F.col("prefix"))).alias("token"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that collide often enough and whose sets are similar, written."""
        near = (pairs.join(texts.toDF("a", "na", "ta", "text_a"), "a").join(texts.toDF("b", "nb", "tb", "text_b"), "b")
                .where(_similar_sizes("na", "nb") & (F.size(F.array_intersect("ta", "tb")) >= LEAST_MATCHES)))
        return cut(near.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long"), "links")

    def open_lists(roots: DataFrame) -> DataFrame:
        """Lists whose classes lie in several components, with the component of each class."""
        placed = lists.join(roots.withColumnRenamed("node", "k"), "k", "left").withColumn("root", F.coalesce("root", "k"))
        several = placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        return cut(placed.join(cut(several.select("token"), "several"), "token"), "open")

    hubs = lists.groupBy("token").agg(F.min(F.struct("o", "k", "n")).alias("hub"))
    links = confirmed(lists.join(cut(hubs, "hubs"), "token").where((F.col("hub.k") != F.col("k")) & _similar_sizes("n", "hub.n"))
                      .select(F.greatest("k", "hub.k").alias("a"), F.least("k", "hub.k").alias("b")).distinct())
    roots = components(links)
    # what is left: pairs of one list in different components, taken where they first meet
    left = open_lists(roots)
    spread = cut(texts.select("k", "text").join(left.select("k").distinct(), "k", "left_semi").mapInArrow(_spread, "k long, sh long"), "shingles")
    twice = spread.groupBy("sh").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("sh")
    # the shingles that a class may share: their number, and a bitmap of them in BITMAP longs
    word = F.col("sh") % BITMAP
    shared = spread.join(cut(twice, "twice"), "sh").groupBy("k").agg(F.count(F.lit(1)).alias("shared"), *[
        F.bit_or(F.when(word == i, F.expr("shiftleft(1L, CAST(shiftright(sh, 6) % 64 AS INT))")).otherwise(F.lit(0).cast("long"))).alias(f"b{i}")
        for i in range(BITMAP)])
    bits = [f"b{i}" for i in range(BITMAP)]
    able = posted.join(shared, "k").where(F.col("shared") * 100 >= PERCENT * F.col("n")).select("k", "tokens", "prefix", "shared", *bits)
    left = cut(left.join(able, "k"), "left")

    def common(x: str, y: str):
        """At most so many shingles of x are in y: each bit that only x has is one that isn't."""
        return F.col(f"{x}.shared") - sum(F.bit_count(F.col(f"{x}.{b}").bitwiseAND(F.bitwise_not(F.col(f"{y}.{b}")))) for b in bits)

    needed = PERCENT * (F.col("x.n") + F.col("y.n"))
    enough = (common("x", "y") * (100 + PERCENT) >= needed) & (common("y", "x") * (100 + PERCENT) >= needed)
    x, y = left.alias("x"), left.alias("y")
    head = F.array_intersect(F.slice("x.tokens", F.lit(1), F.col("x.prefix")), F.slice("y.tokens", F.lit(1), F.col("y.prefix")))
    rest = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.k") > F.col("y.k"))
                  & (F.col("x.root") != F.col("y.root")) & _similar_sizes("x.n", "y.n") & enough
                  & (F.size(F.array_intersect("x.tokens", "y.tokens")) >= LEAST_MATCHES)
                  & (F.get(head, F.lit(0)) == F.col("x.token"))).select(F.col("x.k").alias("a"), F.col("y.k").alias("b"))
    rest = cut(rest, "rest")
    if rest.isEmpty():
        return roots
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(confirmed(rest)))


def _placed(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, tk (text hash), n (shingles), component_id, and ``first``, the
    (no_id, doc_id, tk) of its component's first document; the last two are null without shingles."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("tk"), "text")
    sketched = cut(keyed.mapInArrow(_sketch, "doc_id long, tk long, n long, h1 long, h2 long, signature array<int>"), "sketch")
    # classes of equal sets; k numbers them within this run only
    own = ["n", "h1", "h2"]
    classes = cut(sketched.where("n > 0").groupBy(*own).agg(
        F.min(F.struct("doc_id", "tk", "signature")).alias("r"), F.min("doc_id").alias("least"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tk")).alias("first"))
        .select(*own, F.col("r.doc_id").alias("doc_id"), F.col("r.tk").alias("tk"), F.col("r.signature").alias("signature"), "least", "first")
        .withColumn("k", F.monotonically_increasing_id()), "classes")
    tokens = classes.select("k", "n", F.posexplode("signature").alias("c", "v")).select(
        "k", "n", F.shiftleft(F.col("c").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("token"))
    posted = cut(_posted(tokens), "posted")
    wanted = classes.select("k", "doc_id", "tk").join(posted.select("k", "n", "tokens"), "k")
    texts = keyed.join(wanted.withColumnRenamed("doc_id", "_d").withColumnRenamed("tk", "_t").hint("shuffle_hash"),
                       F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tk") == F.col("_t"))).select("k", "n", "tokens", "text")
    texts = cut(texts.dropDuplicates(["k"]), "texts")
    roots = link_classes(posted, texts)
    named = classes.join(roots.withColumnRenamed("node", "k"), "k", "left").withColumn("root", F.coalesce("root", "k"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("first"))
    member = named.select(*own, "root").join(names, "root").select(*own, "component_id", "first")
    return sketched.drop("signature").join(member, own, "left")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, tk (text hash), n_shingles, component_id, kept."""
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (_placed(docs).withColumn("component_id", component)
            .select("doc_id", "tk", F.col("n").alias("n_shingles"), "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with the least doc_id of their component: all rows that have it."""
    drop = cut(near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("_d"), F.col("tk").alias("_t")).distinct(), "drop")
    keyed = packed(docs, _tk=row_key(), _id=F.col("doc_id").cast("long"))
    gone = (F.col("_tk") == F.col("_t")) & F.col("_id").eqNullSafe(F.col("_d"))
    return unpacked(keyed.join(drop, gone, "left_anti"), docs.columns)


def leave_one(docs: DataFrame) -> DataFrame:
    """One row of each component: the first by doc_id (nulls last), text hash, and a hash of the whole
    row among rows equal in both. Rows without a shingle are linked with nothing and stay."""
    first = F.col("first")
    held = (_placed(docs).where("n > 0")
            .select("doc_id", "tk", (first["doc_id"].eqNullSafe(F.col("doc_id")) & (first["tk"] == F.col("tk"))).alias("is_first"))
            .groupBy("doc_id", "tk", "is_first").agg(F.count(F.lit(1)).alias("times")))
    held = cut(held.select(F.col("doc_id").alias("_d"), F.col("tk").alias("_t"), "is_first", "times").where("NOT is_first OR times > 1"), "held")
    keyed = packed(docs, _tk=row_key(), _id=F.col("doc_id").cast("long"))
    same = (F.col("_tk") == F.col("_t")) & F.col("_id").eqNullSafe(F.col("_d"))
    single = keyed.join(held.select("_d", "_t"), same, "left_anti")
    # written, so that the rows of a hot group can be split; each task then sends one row of it
    repeats = cut(keyed.join(held.where("is_first").select("_d", "_t"), same, "left_semi"), "repeats")
    one = repeats.groupBy("_id", "_tk").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return unpacked(single.select("row").unionByName(one.select("row")), docs.columns)
