"""Aggregates that need a rule: representatives, concatenations, token statistics, metadata factoring."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import one_per_key


def argmax(df: DataFrame, keys: Sequence[str], score: str, ties: Sequence[str]) -> DataFrame:
    """The row of the highest score for each key; ties go by the columns given, ascending."""
    return one_per_key(df, keys, [F.col(score).desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in ties)])


def first_by(value: str, *order: str) -> Column:
    """Aggregate: value of the row that comes first by order."""
    return F.min_by(value, F.struct(*order))


def joined(value: str, order: str, sep: str = "|") -> Column:
    """Aggregate: texts of a group in order, between separators."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).cast("string").alias("v"))))
    return F.array_join(F.transform(pairs, lambda p: p["v"]), sep)


def labelled(label: str, text: str, order: str, sep: str = "\n") -> Column:
    """Aggregate: `label: text` lines of a group in order."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.concat_ws(": ", label, text).alias("v"))))
    return F.array_join(F.transform(pairs, lambda p: p["v"]), sep)


def nested(order: str, *columns: str) -> Column:
    """Aggregate: the group's rows as an array of structs in order."""
    return F.array_sort(F.collect_list(F.struct(order, *columns)))


def distinct_in_order(value: str, order: str) -> Column:
    """Aggregate: distinct values by first appearance."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return F.array_distinct(F.transform(pairs, lambda p: p["v"]))


def several(value: str, sep: str = "|") -> Column:
    """Aggregate: upper-cased distinct values between bars if there are two or more, else ''."""
    values = F.array_sort(F.collect_set(F.upper(value)))
    return F.when(F.size(values) > 1, F.array_join(values, sep)).otherwise("")


def frequency(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of each combination, most frequent first."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), *columns)


def token_frequency(df: DataFrame, name: str, weight: str | None = None) -> DataFrame:
    """(word, count, countf): occurrences of each blank-separated word over names, and the same with names weighted.

    A word repeated in a name counts each time.
    """
    w = F.col(weight) if weight else F.lit(1)
    words = df.where(F.col(name).isNotNull()).select(F.explode(F.split(name, " ")).alias("word"), w.alias("w"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"), F.sum("w").cast("long").alias("countf"))


def outliers(df: DataFrame, value: str, deviations: float = 3.0) -> DataFrame:
    """Rows whose value exceeds the mean by so many standard deviations of the population. The limit, one number, is found first."""
    limit = df.agg(F.avg(value) + deviations * F.stddev_pop(value)).first()[0]
    return df.where(F.col(value) > F.lit(limit))


def greatest_or_null(*columns: Column) -> Column:
    """The largest value, null if any is null."""
    return F.when(reduce(lambda a, b: a | b, (c.isNull() for c in columns)), F.lit(None)).otherwise(F.greatest(*columns))


def factor_metadata(meta: DataFrame, table: str, key: str, value: str) -> DataFrame:
    """Metadata rows with those that all tables share moved to the table '': (table, key, value).

    A key moves if every table has it with one and the same value.
    """
    tables = meta.agg(F.count_distinct(table)).first()[0]
    common = meta.groupBy(key).agg(F.count_distinct(table).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).where(f"n = {tables} AND lo = hi")
    local = meta.join(common.select(key), key, "left_anti").select(table, key, value)
    return local.unionByName(common.select(F.lit("").alias(table), key, F.col("lo").alias(value)))


def union_of_columns(groups: Sequence[dict[str, list[str]]]) -> dict[str, list[str]]:
    """Column groups of several tables merged, columns in order of first appearance."""
    out: dict[str, list[str]] = {}
    for g in groups:
        for name, columns in g.items():
            have = out.setdefault(name, [])
            have += [c for c in columns if c not in have]
    return out


def by_depth(df: DataFrame, columns: Sequence[str], *aggregates: Column) -> DataFrame:
    """Aggregates for each prefix of a hierarchy of columns, and how deep it is (0: all rows): one pass with grouping sets."""
    grouped = df.rollup(*columns).agg(F.grouping_id().alias("__g"), *aggregates)
    depth = F.lit(len(columns)) - F.bit_count(F.col("__g"))
    return grouped.withColumn("depth", depth.cast("int")).drop("__g")
