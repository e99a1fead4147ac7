"""Joins of messy tables: updates, decodes, overrides, fuzzy matches within blocks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.similarity import name_similarity


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key: the first in a total order the caller gives.

    The filter on the row number becomes a group limit before the shuffle: each task sends its first row of a key only,
    so a hot key costs as many rows as there are tasks.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def update_join(target: DataFrame, source: DataFrame, keys: dict[str, str], values: dict[str, str], order: Sequence[Column] | None = None) -> DataFrame:
    """UPDATE target FROM source: values (target column -> source column) are overwritten where keys (target -> source) match.

    source is first reduced to one row for each key, the first in `order` (by default the smallest values), so target
    keeps its rows. A null in the source does overwrite; a null key never matches; missing target columns are added.
    """
    order = order or [F.col(c).asc_nulls_last() for c in values.values()]
    one = one_per_key(source.dropna(subset=list(keys.values())), list(keys.values()), order)
    one = one.select(*(F.col(s).alias(f"__k{i}") for i, s in enumerate(keys.values())), *(F.col(s).alias(f"__v{i}") for i, s in enumerate(values.values())), F.lit(True).alias("__hit"))
    joined = target.join(one, [F.col(t) == F.col(f"__k{i}") for i, t in enumerate(keys)], "left")
    new = {t: F.when(F.col("__hit"), F.col(f"__v{i}")).otherwise(F.col(t) if t in target.columns else F.lit(None)) for i, t in enumerate(values)}
    kept = [new[c].alias(c) if c in new else F.col(c) for c in target.columns]
    return joined.select(*kept, *(v.alias(t) for t, v in new.items() if t not in target.columns))


def update_join_cascade(target: DataFrame, steps: Sequence[tuple[DataFrame, dict[str, str], dict[str, str]]]) -> DataFrame:
    """Update joins in order, from the least to the most specific key; later ones override."""
    return reduce(lambda t, s: update_join(t, *s), steps, target)


def join_on(tables: Sequence[DataFrame], keys: Sequence[Sequence[str]], how: str = "inner") -> DataFrame:
    """tables[0] joined with each further table on its own list of keys."""
    return reduce(lambda a, b: a.join(b[0], list(b[1]), how), zip(tables[1:], keys, strict=True), tables[0])


def join_disjoint(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Tables of the same entities with different value columns, side by side: each is stacked, then regrouped once by key.

    One shuffle instead of a chain of full outer joins. Keys must be unique in each table; nulls among them are equal.
    """
    values = [c for t in tables for c in t.columns if c not in keys]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return stacked.groupBy(*keys).agg(*(F.max(c).alias(c) for c in values))


def decode(facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str, prefix: str = "") -> DataFrame:
    """Append a dimension's columns by trimmed code; unknown codes get nulls. The dimension is one row for each code.

    Whether it is broadcast is left to the planner, which knows its size.
    """
    dim = one_per_key(dimension.withColumn("__code", F.trim(dim_key)), ["__code"], [F.col(c).asc_nulls_last() for c in dimension.columns])
    dim = dim.select("__code", *(F.col(c).alias(prefix + c) for c in dimension.columns if c != dim_key))
    return facts.join(dim, F.trim(facts[fact_key]) == F.col("__code"), "left").drop("__code")


def decode_misses(facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Codes of facts that the dimension doesn't have, with their number of rows."""
    known = dimension.select(F.trim(dim_key).alias("code")).distinct()
    used = facts.groupBy(F.trim(fact_key).alias("code")).agg(F.count(F.lit(1)).alias("n_rows"))
    return used.join(known, "code", "left_anti")


def decode_pattern(c: Column, exact: dict[str, str], patterns: dict[str, str]) -> Column:
    """Meaning of a code: exact codes first, then regular expressions in their order; null for none."""
    out = F.lit(None).cast("string")
    for p, v in reversed(patterns.items()):
        out = F.when(c.rlike(p), v).otherwise(out)
    for k, v in exact.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def override(df: DataFrame, additions: DataFrame, key: str, column: str) -> DataFrame:
    """column from additions where key matches and it isn't null there, else as it is."""
    add = one_per_key(additions.select(F.col(key).alias("__key"), F.col(column).alias("__new")), ["__key"], [F.col("__new").asc_nulls_last()])
    return df.join(add, F.col(key) == F.col("__key"), "left").withColumn(column, F.coalesce("__new", column)).drop("__key", "__new")


def set_key(df: DataFrame, clusters: DataFrame, name: str, key: str, out: str) -> DataFrame:
    """out: the key that clusters (name, key) gives to a row's name, '' where it has none."""
    known = one_per_key(clusters.select(F.col(name).alias("__name"), F.col(key).alias("__value")), ["__name"], [F.col("__value")])
    return df.join(known, F.col(name) == F.col("__name"), "left").withColumn(out, F.coalesce("__value", F.lit(""))).drop("__name", "__value")


def not_yet_in(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys aren't in done; rows with a null key always stay."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")


def key_pairs(df: DataFrame, key: str, ident: str, carry: Sequence[str] = ()) -> DataFrame:
    """Pairs of rows with the same key, the larger id first: for blocks that are small by the choice of key."""
    a = df.select(F.col(key).alias("__key"), F.col(ident).alias("id_a"), *(F.col(c).alias(f"{c}_a") for c in carry))
    b = df.select(F.col(key).alias("__key"), F.col(ident).alias("id_b"), *(F.col(c).alias(f"{c}_b") for c in carry))
    return a.join(b, "__key").where("id_a > id_b").drop("__key")


def fuzzy_join(left: DataFrame, right: DataFrame, block: tuple[Column, Column], names: tuple[str, str], ident: str, least: float) -> DataFrame:
    """The most similar row of right for each row of left in the same block, if it reaches `least`.

    left and right are compared by the columns in names; the block keys are an equi-join, the similarity runs over Arrow
    batches behind it. Ties go to the alphabetically first name. Right columns get the prefix r_.
    """
    l = left.withColumn("__block", block[0])
    r = right.withColumn("__block", block[1]).select("__block", *(F.col(c).alias(f"r_{c}") for c in right.columns))
    pairs = l.join(r, "__block").withColumn("score", name_similarity(F.col(names[0]), F.col(f"r_{names[1]}"))).where(F.col("score") >= least)
    return one_per_key(pairs.drop("__block"), [ident], [F.col("score").desc(), F.col(f"r_{names[1]}"), *(F.col(f"r_{c}") for c in right.columns)])


def by_number(left: DataFrame, right: DataFrame, left_zip: str, right_zip: str) -> DataFrame:
    """Join on postal codes as numbers; the left may hold several between commas or bars, of which the first counts."""
    first = F.regexp_replace(F.split(F.col(left_zip), "[,|]").getItem(0), r"\s", "").try_cast("int")
    r = right.withColumn("__zip", F.col(right_zip).try_cast("int"))
    return left.withColumn("__zip", first).where("__zip IS NOT NULL").join(r, "__zip").drop("__zip")
