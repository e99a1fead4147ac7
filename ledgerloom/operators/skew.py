"""Joins and aggregates that stay balanced when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it holds at least one HEAVY-th of all rows, so there are at most HEAVY heavy keys at any size of
#: input. That is the proven bound under which their lookup rows are broadcast.
HEAVY = 1000


def _hash(on: Sequence[str]) -> Column:
    return F.col(on[0]) if len(on) == 1 else F.xxhash64(*on)


def heavy_keys(df: DataFrame, on: Sequence[str], heavy: int = HEAVY) -> list:
    """The non-null values of the key (a hash of it, if it has several columns) that each hold at least 1/heavy of the rows.

    At most `heavy` values, by arithmetic; none for fewer than 10 * heavy rows, where no key can matter.
    """
    total = df.count()
    if total < heavy * 10:
        return []
    counts = df.dropna(subset=list(on)).groupBy(_hash(on).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    return [r[0] for r in counts.where(F.col("__n") * heavy >= total).select("__k").collect()]


def lookup_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left", heavy: int = HEAVY) -> DataFrame:
    """Join left, in which few keys may hold most rows, to right, in which the key is unique.

    Rows of heavy keys meet their at most `heavy` lookup rows by broadcast and are never shuffled; the others are
    shuffled by key, where no key holds more than 1/heavy of the rows. how is `left` or `inner`. left is read several
    times (count, heavy, light), so pass a stored or checkpointed table. A null key matches nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how is left or inner, not {how}")
    on = [on] if isinstance(on, str) else list(on)
    keys = heavy_keys(left, on, heavy)
    if not keys:
        return left.join(right, on, how)
    is_heavy = F.coalesce(_hash(on).isin(keys), F.lit(False))
    hot = left.where(is_heavy).join(F.broadcast(right.where(is_heavy)), on, how)
    return hot.unionByName(left.where(~is_heavy).join(right, on, how))


def eager_join_aggregate(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str],
    left_sums: Mapping[str, str] | None = None,
    right_sums: Mapping[str, str] | None = None,
) -> DataFrame:
    """Aggregates of `left LEFT JOIN right USING (on)` grouped by columns of left, without ever forming the join.

    Both inputs are first reduced by the join key (with partial aggregation before the shuffle), the compact states are
    joined one to few, counts are multiplied and sums scaled by the other side's count, and the products are rolled up:
    for a join key with l rows on the left and r on the right, l + r rows become two states instead of l * r pairs.

    Returns by, left_rows (rows of left), left_keys (distinct non-null values of on), pairs (rows an inner join would
    have), then for each item name -> column of left_sums the sum over rows of left, and for each item of right_sums the
    sum over the joined rows. Null and blank group values form groups of their own; a null join key matches nothing;
    nulls in summed columns count as 0; an empty input gives an empty result.
    """
    by, left_sums, right_sums = list(by), dict(left_sums or {}), dict(right_sums or {})
    # names of our own, so that extra columns of either input can't clash
    names = [f"__by{i}" for i in range(len(by))]
    l_state = left.groupBy(F.col(on).alias("__on"), *(F.col(c).alias(n) for c, n in zip(by, names, strict=True))).agg(
        F.count(F.lit(1)).alias("__l"), *(F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"__ls_{n}") for n, c in left_sums.items())
    )
    r_state = (
        right.where(F.col(on).isNotNull())
        .groupBy(F.col(on).alias("__on"))
        .agg(F.count(F.lit(1)).alias("__r"), *(F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"__rs_{n}") for n, c in right_sums.items()))
    )
    # a null key is spread by what it is grouped by, as its states, one for each group, would all meet in one task
    salt = F.when(F.col("__on").isNull(), F.pmod(F.xxhash64(*names), F.lit(HEAVY)).cast("int")).otherwise(-1)
    joined = l_state.withColumn("__salt", salt).join(r_state.withColumn("__salt", F.lit(-1)), ["__on", "__salt"], "left")
    r = F.coalesce(F.col("__r"), F.lit(0))
    return joined.groupBy(*(F.col(n).alias(c) for c, n in zip(by, names, strict=True))).agg(
        F.sum("__l").alias("left_rows"),
        F.count("__on").alias("left_keys"),  # (on, by) is unique in l_state
        F.sum(F.col("__l") * r).alias("pairs"),
        *(F.sum(f"__ls_{n}").alias(n) for n in left_sums),
        *(F.sum(F.coalesce(F.col(f"__rs_{n}"), F.lit(0)) * F.col("__l")).alias(n) for n in right_sums),
    )
