"""Operator 4, URL filters: sort-merge range join of URLs with allow / block rules.

A host is written backwards by labels (``m.example.net`` -> ``net.example.m.``), so a rule for a
host and all its subdomains is a key prefix, and a prefix is an interval of the sort order. URLs are
range-partitioned and sorted by that key; each partition gets the rules whose intervals touch it,
and one sweep over the merged order keeps a stack of the open, nested rule hosts: a rule opens at
its key and closes at the first key that it isn't a prefix of. Only the open hosts' paths are then
compared with the URL's path.

The sort goes on to path and page key, so one host with a third of all URLs spreads over tasks.
Rules reach only the partitions that their interval touches: together as many rows as rules, plus at
most the nesting depth for each partition. Neither side is broadcast, so rules can be many.

Among rules that fit, the longest (host and path) wins, then the longer host. A path fits by plain
prefix; an empty path (``http://a.net``) does not start with ``/``. Null URLs and URLs without
``://`` have an empty host and path and no rule. Repeated rows each get a row. No URLs: no rows. No
rules, null rules: the default verdict. Extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import checkpointed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT_VERDICT = "allow"
#: Sorts after every key that goes on from a prefix.
AFTER = chr(0x10FFFF)
OUT = "page_id long, host string, path string, rule string, verdict string"


def url_host(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each with a closing dot: a subdomain's key goes on from
    its parent's."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _sweep(default: str):
    """Merged, sorted rules and URLs of whole ranges -> judged URLs."""
    def run(batches):
        part, stack = None, []          # stack: [key, host, {path: verdict}, path lengths]
        for batch in batches:
            out = []
            for p, key, is_url, page_id, host, path, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if not is_url:
                    if not stack or stack[-1][0] != key:
                        stack.append([key, host, {}, ()])
                    paths = stack[-1][2]
                    # the same rule with both verdicts: block wins
                    paths[path] = min(verdict, paths.get(path, verdict), key=("block", "allow").index)
                    stack[-1][3] = sorted({len(x) for x in paths}, reverse=True)
                    continue
                best, rule, said = (-1, -1), None, default
                for _, rule_host, paths, lengths in stack:
                    for n in lengths:
                        if n <= len(path) and path[:n] in paths:
                            if (len(rule_host) + n, len(rule_host)) > best:
                                best = (len(rule_host) + n, len(rule_host))
                                rule, said = rule_host + path[:n], paths[path[:n]]
                            break
                out.append((page_id, host, path, rule, said))
            cols = list(zip(*out)) or [()] * 5
            types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["page_id", "host", "path", "rule", "verdict"])
    return run


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """``pages`` (page_id, url) and ``rules`` (verdict, host, path) -> one judged row per page."""
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    urls = urls.withColumn("key", host_key(F.col("host")))
    urls = urls.repartitionByRange("key", "path", "page_id").sortWithinPartitions("key", "path", "page_id")
    urls = checkpointed(urls.withColumn("part", F.spark_partition_id()))
    # ends of each range: as many rows as partitions
    ends = sorted((r["lo"], r["hi"], r["part"]) for r in urls.groupBy("part").agg(
        F.min("key").alias("lo"), F.max("key").alias("hi")).collect())
    los, his, parts = [e[0] for e in ends], [e[1] for e in ends], [e[2] for e in ends]

    @F.pandas_udf("array<int>")
    def touched(keys: pd.Series) -> pd.Series:
        return pd.Series([parts[bisect_left(his, k):bisect_right(los, k + AFTER)] for k in keys], dtype=object)

    given = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()
                         & F.col("verdict").isin("allow", "block"))
             .withColumn("host", F.translate("host", UPPER, LOWER))
             .withColumn("key", host_key(F.col("host")))
             .withColumn("part", F.explode(touched("key"))))
    cols = ["part", "key", "is_url", "page_id", "host", "path", "verdict"]
    merged = (urls.withColumn("is_url", F.lit(True)).withColumn("verdict", F.lit(None).cast("string")).select(cols)
              .unionByName(given.withColumn("is_url", F.lit(False))
                           .withColumn("page_id", F.lit(None).cast("long")).select(cols)))
    swept = merged.repartition(max(1, len(parts)), "part").sortWithinPartitions("part", "key", "is_url")
    return swept.mapInArrow(_sweep(default), OUT)
