"""Follow next-page links, with loop detection and an optional page cap.

A walk starts at its first-page URL and follows ``next`` links. It ends after a page with no next link
or an unusable response, or when the next URL was already visited (audit row "loop"). A caller may
also pass ``cap``: then it ends there with the audit row "limit exceeded" (checked first).

Walks are kept apart by ``keys``, provider by default; with several runs in the link table, give
(run, provider). Equal links count once; of differing links of one page the least next URL is followed.

Walks of up to ``MOST_LINKS`` links are followed in one pass, several walks in a group of some ``GROUP_LINKS``
links. Longer walks are followed by joins, so no walk has to fit a task: walks and their pages are numbered once, and
the rounds move a few longs instead of keys and URLs, which come back at the end. The visited block doubles: positions
[0, 2^k) joined to the 2^k-step jump table give the next 2^k positions, and the jump table joined to itself gives
the next jump. Only walks that are still open go on, and only links with a successor, so rounds are log2 of the
longest walk and each is two joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The audit texts.
LIMIT_TEXT = "Pagination limit exceeded ({cap})"
LOOP_TEXT = "Pagination loop detected from links.next"
#: Links of a walk that is followed in one pass, and of a group of such walks.
MOST_LINKS, GROUP_LINKS = 10_000, 1 << 16


def follow_links(starts: DataFrame, links: DataFrame, cap: int | None = None,
                 keys: Sequence[str] = ("provider_id",)) -> DataFrame:
    """starts(*keys, url); links(*keys, url, next_url, usable).

    Returns one row per visited page (kind='page', page_num 1..) and one per audit stop
    (kind='audit', http_status 0, error text). ``next_url`` should already be resolved (absolute);
    '' or NULL ends the walk, and an unusable page ends it after being visited.
    """
    from ratewatch.session import checkpoint_dir
    checkpoint_dir(links.sparkSession)
    keys = list(keys)
    successors = (links.filter(F.col("usable") & (F.coalesce(F.col("next_url"), F.lit("")) != ""))
                  .groupBy(*keys, "url").agg(F.min("next_url").alias("nxt")))
    walks = (starts.filter(F.col("url").isNotNull()).groupBy(*keys).agg(F.min("url").alias("_first"))
             .withColumn("_walk", F.monotonically_increasing_id()).checkpoint(eager=True))
    # a null key equals none, so such a walk has its first page only
    successors = (successors.filter(F.col("url").isNotNull()).join(walks.select(*keys, "_walk"), keys)
                  .select("_walk", "url", "nxt").checkpoint(eager=True))
    first = walks.select("_walk", F.col("_first").alias("url"))
    long_walks = successors.groupBy("_walk").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > MOST_LINKS).select("_walk").checkpoint(eager=True)
    if long_walks.isEmpty():
        walked = _in_groups(first, successors, cap)
    else:
        walked = _in_groups(first.join(long_walks, "_walk", "left_anti"), successors.join(long_walks, "_walk", "left_anti"), cap).unionByName(
            _by_doubling(first.join(long_walks, "_walk", "left_semi"), successors.join(long_walks, "_walk", "left_semi").checkpoint(eager=True), cap))

    at_cap = F.lit(False) if cap is None else F.col("p") == cap
    walked = walked.join(walks.drop("_first"), "_walk").withColumn(
        "_audit", F.when(at_cap, F.lit(LIMIT_TEXT.format(cap=cap))).when(F.col("again"), F.lit(LOOP_TEXT)))
    audit = F.col("_audit").isNotNull()
    return walked.select(
        *keys, (F.col("p") + 1).cast("int").alias("page_num"), "url",
        F.when(audit, F.lit("audit")).otherwise(F.lit("page")).alias("kind"),
        F.when(audit, F.lit(0)).alias("http_status"), F.col("_audit").alias("error"))


def _in_groups(first: DataFrame, successors: DataFrame, cap: int | None) -> DataFrame:
    """(_walk, p, url, again) of walks whose links fit a group."""
    def follow(group: pa.Table) -> pa.Table:
        starts, nexts = {}, {}
        for walk, url, nxt in zip(*(group.column(c).to_pylist() for c in ("_walk", "url", "nxt"))):
            if url is None:
                starts[walk] = nxt
            else:
                nexts[walk, url] = nxt
        walks, places, urls, agains = [], [], [], []
        for walk, url in starts.items():
            visited, p = set(), 0
            while url is not None:
                again = url in visited
                visited.add(url)
                walks.append(walk)
                places.append(p)
                urls.append(url)
                agains.append(again)
                if again or (cap is not None and p >= cap):
                    break
                url, p = nexts.get((walk, url)), p + 1
        return pa.table([pa.array(walks, pa.int64()), pa.array(places, pa.int64()), pa.array(urls, pa.string()), pa.array(agains, pa.bool_())],
                        ["_walk", "p", "url", "again"])

    rows = successors.unionByName(first.select("_walk", F.lit(None).cast("string").alias("url"), F.col("url").alias("nxt")))
    groups = max(1, -(-rows.count() // GROUP_LINKS))
    group = F.pmod(F.xxhash64("_walk"), F.lit(groups))
    return rows.groupBy(group.alias("_group")).applyInArrow(follow, "_walk long, p long, url string, again boolean")


def _by_doubling(first: DataFrame, successors: DataFrame, cap: int | None) -> DataFrame:
    """(_walk, p, url, again) of walks of any length."""
    pages = (successors.select("_walk", "url").unionByName(successors.select("_walk", F.col("nxt").alias("url")))
             .unionByName(first).distinct()
             .withColumn("_page", F.monotonically_increasing_id()).checkpoint(eager=True))
    jump = (successors.join(pages.withColumnRenamed("_page", "node"), ["_walk", "url"])
            .join(pages.select("_walk", F.col("url").alias("nxt"), F.col("_page").alias("_next")), ["_walk", "nxt"])
            .select("_walk", "node", F.col("_next").alias("nxt")).checkpoint(eager=True))
    seen = (first.join(pages, ["_walk", "url"])
            .select("_walk", F.col("_page").alias("node"), F.lit(0).cast("long").alias("p")).checkpoint(eager=True))
    size, ended = 1, []
    while True:
        more = seen.join(jump, ["_walk", "node"]).select("_walk", F.col("nxt").alias("node"), (F.col("p") + size).alias("p"))
        # a walk is cut at its first repeated page, and at the cap
        again = F.row_number().over(Window.partitionBy("node").orderBy("p")) > 1
        seen = seen.unionByName(more).withColumn("again", again)
        ends = (seen.filter("again" if cap is None else F.col("again") | (F.col("p") >= cap))
                .groupBy("_walk").agg(F.min("p").alias("_end")))
        size *= 2
        # only a walk that filled its block and wasn't cut can go on
        full = seen.filter(F.col("p") == size - 1).select("_walk").distinct().withColumn("_full", F.lit(True))
        seen = (seen.join(ends, "_walk", "left").filter(F.col("_end").isNull() | (F.col("p") <= F.col("_end")))
                .join(full, "_walk", "left").withColumn("open", F.col("_full").isNotNull() & F.col("_end").isNull())
                .select("_walk", "node", "p", "again", "open").checkpoint(eager=True))
        ended.append(seen.filter(~F.col("open")).drop("open"))
        seen = seen.filter("open").drop("open", "again")
        open_walks = seen.filter(F.col("p") == 0).select("_walk")
        if open_walks.isEmpty():
            break
        second = jump.select("_walk", F.col("node").alias("nxt"), F.col("nxt").alias("_far"))
        jump = (jump.join(open_walks, "_walk", "left_semi").join(second, ["_walk", "nxt"])
                .select("_walk", "node", F.col("_far").alias("nxt")).checkpoint(eager=True))

    walked = reduce(DataFrame.unionByName, ended).withColumnRenamed("node", "_page")
    return walked.join(pages, ["_walk", "_page"]).select("_walk", "p", "url", "again")
