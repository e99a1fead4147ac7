"""Several values packed into one field."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.skew import lookup_join
from ledgerloom.session import cut

#: What separates values: signs, or the word "and" between blanks, in any case.
DELIMITERS = r"[;,|/&+\t\n\r]|(?<=[\s\p{Z}])(?i:and)(?=[\s\p{Z}])"
#: Unicode non-characters, which text can't hold: the one encloses literals, the other ends values.
LITERAL, END = "﷐", "﷑"
#: Where a protected name may begin (this is consumed and put back) and must end.
BEFORE = r"(^|[;,|/&+\t\n\r]|[\s\p{Z}](?i:and)(?=[\s\p{Z}]))([\s\p{Z}]*+)"
AFTER = r"(?=[\s\p{Z}]*(?:$|[;,|/&+\t\n\r]|[\s\p{Z}](?i:and)[\s\p{Z}]))"


def _alternatives(names: Column) -> Column:
    """A regular expression of the names, each quoted, the longest first; one that matches nothing if there are none."""
    by_length = F.transform(F.array_sort(F.transform(F.array_distinct(names), lambda n: F.struct(-F.length(n), n.alias("n")))), lambda x: x["n"])
    quoted = F.transform(by_length, lambda n: F.concat(F.lit("\\Q"), F.replace(n, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    return F.when(F.size(names) > 0, F.array_join(quoted, "|")).otherwise(F.lit("(?!)"))


def split_values(c: Column, protected: Iterable[str] | Column = (), delimiters: str = DELIMITERS) -> Column:
    """The values in a field, as an array in their order.

    The text is split on quote characters: odd pieces are literals, even pieces are split on delimiters, and folds over
    the pieces put the values together again. An empty even piece between two literals is a doubled quote and stands for
    one. A last quote that nothing closes is an ordinary character. Names of `protected` (a list, or an array column of
    trimmed names) that stand as a whole value (case aside), whatever blanks are around, aren't split. Values lose
    surrounding blanks; empty ones are left out. Null gives null, a blank field an empty array.
    """
    if isinstance(protected, Column):
        names = _alternatives(protected)
    else:
        listed = sorted({n.strip() for n in protected if n and n.strip()}, key=lambda n: (-len(n), n))
        names = F.lit("|".join(map(re.escape, listed)) or "(?!)")
    marked_name = F.concat(F.lit(BEFORE + "((?iu:"), names, F.lit("))" + AFTER))
    pieces = F.split(c, '"')
    last = F.size(pieces) - 1

    def piece(x: Column, i: Column) -> Column:
        unclosed = (i % 2 == 1) & (i == last)
        doubled = (i % 2 == 0) & (x == "") & (i > 0) & (i < last)
        even = F.regexp_replace(x, marked_name, F.lit(f"$1$2{LITERAL}$3{LITERAL}"))
        return (
            F.when(unclosed, F.concat(F.lit('"'), even))
            .when(i % 2 == 1, F.concat(F.lit(LITERAL), x, F.lit(LITERAL)))
            .when(doubled, F.lit(f'{LITERAL}"{LITERAL}'))
            .otherwise(even)
        )

    marked = F.split(F.array_join(F.transform(pieces, piece), ""), LITERAL)
    ended = F.transform(marked, lambda x, i: F.when(i % 2 == 0, F.regexp_replace(x, delimiters, END)).otherwise(x))
    values = F.transform(F.split(F.array_join(ended, ""), END), lambda x: F.regexp_replace(x, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return F.filter(values, lambda x: x != "")


def _trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def _caseless(c: Column) -> Column:
    return F.lower(F.upper(c))


def with_values(df: DataFrame, column: str, out: str, names: DataFrame | None = None, name: str | None = None, in_expression: int = 1000) -> DataFrame:
    """df with out: the values of a multi-valued column; see split_values. names holds protected names in its column `name`.

    Up to in_expression names that hold a delimiter stand in one regular expression: a narrow operator without a shuffle.
    More are found by an exact join: runs of neighbouring pieces of each distinct field, up to the pieces of the longest
    name, meet the names; each field is then split with the names found in it. The result is the same.
    """
    if names is None:
        return df.withColumn(out, split_values(F.col(column)))
    held = names.where(F.col(name).rlike(DELIMITERS)).select(_trimmed(F.col(name)).alias("__name")).where("__name <> ''").distinct()
    few = [r[0] for r in held.limit(in_expression + 1).collect()]
    if len(few) <= in_expression:
        return df.withColumn(out, split_values(F.col(column), few))
    held = cut(held.select("__name", _caseless(F.col("__name")).alias("__key")))
    most = held.agg(F.max(F.size(F.split("__name", DELIMITERS)))).first()[0]
    base = cut(df.withColumn("__value", F.col(column)))
    # pieces and what separates them in turn; quote characters separate too
    pieces = F.split(F.regexp_replace("__value", f'"|{DELIMITERS}', f"{END}$0{END}"), END)
    at = F.sequence(F.lit(0), F.size(pieces) - 1, F.lit(2))
    long = F.least(F.lit(most), F.floor(F.size(pieces) / 2).cast("int") + 1)
    runs = F.flatten(F.transform(at, lambda i: F.transform(F.sequence(F.lit(1), long), lambda n: _caseless(_trimmed(F.array_join(F.slice(pieces, i + 1, 2 * n - 1), ""))))))
    values = base.where(F.col("__value").rlike(DELIMITERS)).select("__value").distinct()
    found = values.select("__value", F.explode(F.array_distinct(runs)).alias("__key")).join(held, "__key")
    # as many as there are runs in a field
    found = cut(found.groupBy("__value").agg(F.collect_set("__name").alias("__names")))
    split = lookup_join(base, found, "__value")
    return split.withColumn(out, split_values(F.col("__value"), F.coalesce("__names", F.array().cast("array<string>")))).drop("__value", "__names")


def explode_values(
    df: DataFrame, column: str, keep: Iterable[str], names: DataFrame | None = None, name: str | None = None, pos: str = "pos", val: str = "val", at_least: int = 1, in_expression: int = 1000
) -> DataFrame:
    """One row for each value of a multi-valued column: the columns in keep, pos from 1, val. See with_values.

    Rows with fewer than at_least values are left out.
    """
    keep = list(keep)
    named = df.select(*(F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)), F.col(column).alias("__column"))
    wide = with_values(named, "__column", "__values", names, name, in_expression).where(F.size("__values") >= at_least)
    wide = wide.select(*(F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)), F.posexplode("__values").alias("__pos", val))
    return wide.select(*keep, (F.col("__pos") + 1).alias(pos), val)


def names_with_delimiters(df: DataFrame, column: str, at_most: int = 5000) -> list[str]:
    """Distinct names of a reference list that hold a delimiter, for `protected`; an error if there are more than at_most: use with_values then."""
    names = [r[0] for r in df.where(F.col(column).rlike(DELIMITERS)).select(column).distinct().limit(at_most + 1).collect()]
    if len(names) > at_most:
        raise ValueError(f"more than {at_most} reference names hold delimiters: use with_values")
    return names
