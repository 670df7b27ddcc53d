"""Differences between consecutive snapshots of an entity (the rate-change mart).

For every entity (provider), snapshots are its distinct dates; each date is compared with the
entity's previous date. Rows are matched on key columns; a key present only in the current
snapshot is "added" (previous value NULL), only in the previous one "removed" (current NULL);
matched keys whose values differ are "changed". Unchanged keys are dropped.

A key may occur several times inside a snapshot. Then values that both snapshots hold under the key
cancel out first, so a value that stays is never reported; what is left is ranked by value on each
side and paired by rank. {0.02, 0.05} -> {0.05} is one removal of 0.02, and {0.02, 0.05} ->
{0.01, 0.02, 0.05} one addition. Each value gives one row at most, never all current x previous
pairs. When keys are unique per snapshot (the mart's declared contract) the result is the full outer
join on the keys.

Plan shape: snapshot dates joined to the facts (worked out first, from a stored ``snapshots`` table or the facts, and
broadcast up to a counted bound as one row of dates per entity, with ``as_of`` or ``current`` as the pairs that end there;
beyond, a plain join), then one exchange of the facts by (entity, keys). It belongs to an
aggregate that collects the distinct rows of a key, so repeated rows collapse before the shuffle;
cancelling, ranking and pairing all work inside that partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date as _date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewatch.session import checkpoint_dir


#: (entity, date) pairs that go out by broadcast when there are no more of them; beyond, the join shuffles.
BROADCAST_PAIRS = 1 << 20
#: Entities, and dates of all of them, that go out by broadcast as one array of dates (four bytes each) per entity.
BROADCAST_ENTITIES, BROADCAST_DATES = 1 << 20, 1 << 24
#: Snapshot dates that a filter names, or one entity's array holds; more are left to the join.
MOST_DATES = 1000
#: Sides of a change.
CURRENT, PREVIOUS = 0, 1


def snapshot_pairs(df: DataFrame, entity: str, date: str, as_of: _date | None = None, current: DataFrame | None = None) -> DataFrame:
    """(entity, date, _prev, _next): each snapshot date with its neighbours for that entity. With ``as_of`` or
    ``current`` (entity, date) only the pairs that end there are left."""
    d = df.select(entity, date).distinct()
    w = Window.partitionBy(entity).orderBy(date)
    d = d.select(entity, date, F.lag(date).over(w).alias("_prev"), F.lead(date).over(w).alias("_next"))
    if as_of is None and current is None:
        return d
    if current is None:
        is_end, next_is_end = F.col(date) == F.lit(as_of).cast("date"), F.col("_next") == F.lit(as_of).cast("date")
    else:
        ends = current.select(F.col(entity), F.col(date)).distinct()
        d = (d.join(ends.withColumn("_e", F.lit(True)), [entity, date], "left")
             .join(ends.select(entity, F.col(date).alias("_next"), F.lit(True).alias("_ne")), [entity, "_next"], "left"))
        is_end, next_is_end = F.col("_e").isNotNull(), F.col("_ne").isNotNull()
    return d.filter(is_end | next_is_end).select(entity, date, F.when(is_end, F.col("_prev")).alias("_prev"),
                                                 F.when(next_is_end, F.col("_next")).alias("_next"))


def _small(pairs: DataFrame) -> DataFrame:
    """Pairs worked out once, and sent to every task if there are few."""
    checkpoint_dir(pairs.sparkSession)
    pairs = pairs.checkpoint()
    return F.broadcast(pairs) if pairs.count() <= BROADCAST_PAIRS else pairs


def _with_neighbours(facts: DataFrame, dated: DataFrame, entity: str, date: str) -> DataFrame:
    """``facts`` with the entity's snapshot dates before and after (``_prev``, ``_next``), of those in ``dated``."""
    checkpoint_dir(facts.sparkSession)
    dated = dated.select(entity, date).distinct().checkpoint()
    few = dated.groupBy(entity).count().agg(F.count(F.lit(1)), F.sum("count"), F.max("count")).first()
    if any((n or 0) > most for n, most in zip(few, (BROADCAST_ENTITIES, BROADCAST_DATES, MOST_DATES))):
        # the facts are exchanged and sorted by date for this join alone
        return facts.join(snapshot_pairs(dated, entity, date), [entity, date])
    days = dated.groupBy(entity).agg(F.sort_array(F.collect_list(date)).alias("_days")).checkpoint()
    at = F.array_position("_days", F.col(date))
    found = facts.join(F.broadcast(days), entity).withColumn("_at", at).filter(F.col("_at") > 0)
    return found.select(*facts.columns, F.get("_days", F.col("_at") - 2).alias("_prev"), F.get("_days", F.col("_at")).alias("_next"))


def snapshot_changes(
    df: DataFrame,
    *,
    entity: str,
    date: str,
    keys: Sequence[str],
    value: str,
    sentinel_keys: Mapping[str, object] | None = None,
    carry: Sequence[str] = (),
    previous_date_name: str | None = None,
    current_date_name: str | None = None,
    previous_value_name: str | None = None,
    current_value_name: str | None = None,
    as_of: _date | None = None,
    snapshots: DataFrame | None = None,
    current: DataFrame | None = None,
) -> DataFrame:
    """Rows that differ between each entity's consecutive snapshots.

    keys           strict keys: compared with '=', a NULL never matches anything
    sentinel_keys  keys compared as coalesce(key, sentinel): NULL matches NULL (and the sentinel)
    carry          descriptive columns, output as coalesce(current, previous)
    snapshots      (entity, date) of all snapshots, where a table of them is stored; else read off the facts
    as_of          only changes that become current on this date
    current        only changes that become current on these (entity, date)
    """
    sentinel_keys = dict(sentinel_keys or {})
    keys, carry = list(keys), list(carry)
    pd_name = previous_date_name or f"previous_{date}"
    cd_name = current_date_name or f"current_{date}"
    pv_name = previous_value_name or f"previous_{value}"
    cv_name = current_value_name or f"current_{value}"

    norm = [f"_k{i}" for i in range(len(keys) + len(sentinel_keys))]
    norm_exprs = [F.col(k) for k in keys] + [F.coalesce(F.col(k), F.lit(s)) for k, s in sentinel_keys.items()]
    facts = df.select(entity, date, *keys, *sentinel_keys, value, *carry)
    if as_of is not None:
        facts = facts.filter(F.col(date) <= F.lit(as_of))
        snapshots = None if snapshots is None else snapshots.filter(F.col(date) <= F.lit(as_of))
    dated = facts if snapshots is None else snapshots
    if as_of is None and current is None:
        facts = _with_neighbours(facts, dated, entity, date)
    else:
        pairs = _small(snapshot_pairs(dated, entity, date, as_of, current))
        # only the dates of these pairs are read: stored facts are pruned by partition, pages before they are parsed
        dates = [r[0] for r in pairs.select(date).distinct().limit(MOST_DATES + 1).collect()]
        if len(dates) <= MOST_DATES:
            facts = facts.filter(F.col(date).isin(dates))
        if dates:
            # bounds reach the files also where the date is worked out from an instant, which a list of dates does not
            ends = pairs.agg(F.min(date), F.max(date)).first()
            facts = facts.filter(F.col(date).between(*ends))
        facts = facts.join(pairs, [entity, date])
    facts = facts.select("*", *[e.alias(n) for e, n in zip(norm_exprs, norm)])

    # a key and a description are one column each: the sorts below hand them on as they are, field by field they would be
    # taken apart and written anew at every step, decimals with most effort. The key's hash goes first in all of them, so
    # keys themselves are compared only where it is equal. A sentinel key is told from its sentinel by a bit.
    types = dict(facts.dtypes)
    bits = [k for k, n in zip(sentinel_keys, norm[len(keys):]) if types[k] == types[n] and types[k] not in ("float", "double")]
    bits = bits if len(bits) == len(sentinel_keys) else []      # descriptions are ordered by all of them, in their order
    absent = F.lit(0)
    for k in bits:
        absent = absent * 2 + F.col(k).isNull().cast("int")
    own = [k for k in sentinel_keys if k not in bits]
    described = [c for name in carry for c in (F.col(name).isNull().alias(f"_no_{name}"), F.col(name))]
    described += [c for name in own for c in (F.col(name).isNull().alias(f"_no_{name}"), F.col(name))]
    facts = facts.select(F.xxhash64(entity, *norm).alias("_h"), F.struct(entity, *norm).alias("_key"), date, "_prev", "_next",
                         F.col(value).alias("_value"), F.struct(*described, absent.alias("_absent")).alias("_about"))

    # one exchange, by entity and keys; equal rows of a task are one row in it
    part = ["_h", "_key"]
    facts = (facts.groupBy(*part).agg(F.collect_set(F.struct(date, "_prev", "_next", "_value", "_about")).alias("_rows"))
             .select(*part, F.inline("_rows")))
    # one row per value and snapshot: the least description
    # (value before date, so the next windows find the rows in their order)
    first = Window.partitionBy(*part, "_value", date).orderBy("_about")
    facts = facts.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")

    strict_null = F.lit(False)
    for n in norm[:len(keys)]:
        strict_null = strict_null | F.col("_key")[n].isNull()
    same = Window.partitionBy(*part, "_value").orderBy(date)
    stayed = ~strict_null & F.coalesce(F.lag(date).over(same) == F.col("_prev"), F.lit(False))
    stays = ~strict_null & F.coalesce(F.lead(date).over(same) == F.col("_next"), F.lit(False))
    facts = facts.withColumn("_stayed", stayed).withColumn("_stays", stays)

    def side(name, cond, previous, current):
        return F.when(cond, F.struct(F.lit(name).alias("_side"), previous.alias("_pd"), current.alias("_cd")))

    events = F.array(side(CURRENT, F.col("_prev").isNotNull() & ~F.col("_stayed"), F.col("_prev"), F.col(date)),
                     side(PREVIOUS, F.col("_next").isNotNull() & ~F.col("_stays"), F.col(date), F.col("_next")))
    left = facts.select(*part, "_value", "_about", F.inline(events)).filter(F.col("_side").isNotNull())
    rank = F.row_number().over(Window.partitionBy(*part, "_cd", "_side").orderBy(F.col("_value").asc_nulls_last()))
    alone = F.when(strict_null, F.col("_side"))
    left = left.withColumn("_rank", rank).withColumn("_alone", alone)

    def of(side, c):
        return F.max(F.when(F.col("_side") == side, F.col(c)))

    out = left.groupBy(*part, "_cd", "_pd", "_rank", "_alone").agg(
        of(PREVIOUS, "_value").alias(pv_name), of(CURRENT, "_value").alias(cv_name),
        of(PREVIOUS, "_about").alias("_was"), of(CURRENT, "_about").alias("_is"))
    out = out.filter(~F.col(pv_name).eqNullSafe(F.col(cv_name)))

    def about(name):
        return F.coalesce(F.col("_is")[name], F.col("_was")[name])

    def sentinel(name, n):
        if name not in bits:
            return about(name)
        bit = 1 << (len(bits) - 1 - bits.index(name))
        held = [F.coalesce(F.col(s)["_absent"].bitwiseAND(F.lit(bit)) == 0, F.lit(False)) for s in ("_is", "_was")]
        return F.when(held[0] | held[1], F.col("_key")[n])

    return out.select(F.col("_key")[entity].alias(entity), *[F.col("_key")[n].alias(k) for n, k in zip(norm, keys)],
                      *[sentinel(k, n).alias(k) for k, n in zip(sentinel_keys, norm[len(keys):])],
                      *[about(c).alias(c) for c in carry],
                      F.col("_pd").alias(pd_name), F.col("_cd").alias(cd_name), pv_name, cv_name)


# The pricing mart: keys and output names of ``mart_rate_changes``.
RATE_CHANGE_COLUMNS = [
    "provider_id", "brand_name", "product_id", "product_name", "product_category", "rate_kind",
    "rate_type", "tier_name", "tier_unit_of_measure", "tier_minimum_value", "tier_maximum_value",
    "previous_as_of_date", "current_as_of_date", "previous_rate", "current_rate",
]

#: Columns of the rate fact that the mart is made from.
RATE_INPUT_COLUMNS = ["as_of_date", "rate", *[c for c in RATE_CHANGE_COLUMNS if "as_of_date" not in c and c not in ("previous_rate", "current_rate")]]


def rate_changes(rate_fact: DataFrame, as_of: _date | None = None, extra_keys: Sequence[str] = (), **kw) -> DataFrame:
    """``mart_rate_changes`` over the rate fact (tier keys matched with '' / -1 sentinels).
    ``extra_keys`` (``additional_value``, say) tell rates apart that the mart's own keys don't."""
    out = snapshot_changes(
        rate_fact, entity="provider_id", date="as_of_date",
        keys=["product_id", "rate_kind", "rate_type"],
        sentinel_keys={"tier_name": "", "tier_unit_of_measure": "",
                       "tier_minimum_value": -1, "tier_maximum_value": -1, **{k: "" for k in extra_keys}},
        value="rate", carry=["brand_name", "product_name", "product_category"],
        previous_date_name="previous_as_of_date", current_date_name="current_as_of_date",
        previous_value_name="previous_rate", current_value_name="current_rate",
        as_of=as_of, **kw)
    return out.select(*RATE_CHANGE_COLUMNS, *extra_keys)
