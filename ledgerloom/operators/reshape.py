"""Wide, long and nested forms of the same data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "name", value: str = "value", keep_nulls: bool = True) -> DataFrame:
    """One row for each value column."""
    out = df.unpivot(list(ids), list(values), name, value)
    return out if keep_nulls else out.where(F.col(value).isNotNull())


def cells_to_long(df: DataFrame, ids: Sequence[str], arrays: dict[str, str], pos: str = "pos") -> DataFrame:
    """Parallel arrays (name -> column) as rows with their position from 1."""
    zipped = F.arrays_zip(*(F.col(c).alias(n) for n, c in arrays.items()))
    out = df.select(*ids, F.posexplode(zipped).alias("__pos", "__cell"))
    return out.select(*ids, (F.col("__pos") + 1).alias(pos), *(F.col(f"__cell.{n}") for n in arrays))


def to_wide(df: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column for each of names; the first value by size where a cell has several. Giving names saves a pass over the data."""
    return df.groupBy(*ids).pivot(name, list(names)).agg(F.min(value))


def series_map(df: DataFrame, ids: Sequence[str], time: str, value: str) -> DataFrame:
    """One map of time -> value for each series, in order of time; blank values are left out, a repeated time keeps its smallest value."""
    clean = df.where(F.col(value).isNotNull() & (F.trim(F.col(value).cast("string")) != ""))
    one = clean.groupBy(*ids, time).agg(F.min(value).alias("__v"))
    return one.groupBy(*ids).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(time, "__v")))).alias("values"))


def attributes_to_columns(df: DataFrame, key: str, name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Key/value records as rows with a column for each name."""
    return df.where(F.col(name).isin(list(names))).groupBy(key).pivot(name, list(names)).agg(F.min(value))


def struct_of(df: DataFrame, out: str, fields: dict[str, str]) -> DataFrame:
    """A map of the fields that aren't empty (name -> column), as a location or another loose record."""
    entries = F.array(*(F.struct(F.lit(n).alias("key"), F.col(c).cast("string").alias("value")) for n, c in fields.items()))
    return df.withColumn(out, F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull() & (F.trim(e["value"]) != ""))))


def level_map(names: Sequence[str], levels: Column) -> Column:
    """Levels of a path by name; empty ones are left out."""
    made = F.map_from_arrays(F.array(*(F.lit(n) for n in names)), F.transform(F.array(*(F.lit(i) for i in range(len(names)))), lambda i: F.coalesce(F.get(levels, i), F.lit(""))))
    return F.map_filter(made, lambda _, v: v != "")


def attach_children(parent: DataFrame, key: str, children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Each parent with an array of structs for each kind of child (name -> (table with key, column of order)).

    Children are grouped once each; parents without any get an empty array; children without a parent are left out. A
    document holds its children, so a key's children must fit in a row.
    """
    out = parent
    for name, (child, order) in children.items():
        rest = [c for c in child.columns if c not in (key, order)]
        rows = F.collect_list(F.struct(order, *rest))
        if any("map<" in t for c, t in child.dtypes if c in rest):  # maps have no order, so that of the column alone counts
            ordered = F.array_sort(rows, lambda x, y: F.when(x[order] < y[order], -1).when(x[order] > y[order], 1).otherwise(0))
        else:
            ordered = F.array_sort(rows)
        grouped = child.groupBy(key).agg(ordered.alias(name))
        out = out.join(grouped, key, "left").withColumn(name, F.coalesce(F.col(name), F.array().cast(grouped.schema[name].dataType)))
    return out


def crosstab_to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], sep: str = " - ", group: str = "group", year: str = "year", value: str = "value") -> DataFrame:
    """Columns named `Group - Year` as rows of group, year and value."""
    long = to_long(df, ids, columns, "__name", value)
    return long.select(*ids, F.substring_index("__name", sep, 1).alias(group), F.substring_index("__name", sep, -1).alias(year), value)


def flatten_all(c: Column, depth: int) -> Column:
    """Nested arrays as one array."""
    for _ in range(depth):
        c = F.flatten(c)
    return c
