"""Operators on lines in order. Each takes the column that orders rows and, where tables hold several texts, their key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _window(order: str, by: Sequence[str]):
    return Window.partitionBy(*by).orderBy(order)


def fill_down(df: DataFrame, column: str, order: str, by: Sequence[str] = (), drop_leading: bool = True) -> DataFrame:
    """Empty values take the previous one that isn't; leading empty rows are left out, as nothing comes before them."""
    w = _window(order, by).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn(column, F.last(F.when(F.col(column) != "", F.col(column)), ignorenulls=True).over(w))
    return out.where(F.col(column).isNotNull()) if drop_leading else out


def indent_of(text: Column, unit: str = " ") -> Column:
    """Number of units (blanks, tabs, `&nbsp;`) a text begins with."""
    found = F.regexp_extract(text, f"^((?:{unit})*)", 1)
    return (F.length(found) / len(unit)).cast("int")


def hierarchy(df: DataFrame, text: str, indent: str, order: str, depth: int, by: Sequence[str] = ()) -> DataFrame:
    """Add level and path (an array of the texts above and of the row itself) from indentation.

    A new section begins with the first row and each row of the smallest indentation; inside a section distinct
    indentations are numbered, and at each level the last text seen counts, '' where there was none.
    """
    least = df.withColumn("__least", F.min(indent).over(Window.partitionBy(*by)))
    w = _window(order, by)
    opens = (F.col(indent) == F.col("__least")) | (F.row_number().over(w) == 1)
    section = F.sum(opens.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = least.withColumn("__section", section)
    inside = [*by, "__section"]
    out = out.withColumn("level", F.dense_rank().over(Window.partitionBy(*inside).orderBy(indent)) - 1)
    so_far = _window(order, inside).rowsBetween(Window.unboundedPreceding, 0)
    steps = [F.when(F.col("level") >= i, F.coalesce(F.last(F.when(F.col("level") == i, F.col(text)), ignorenulls=True).over(so_far), F.lit(""))) for i in range(depth)]
    return out.withColumn("path", F.filter(F.array(*steps), lambda x: x.isNotNull())).drop("__least", "__section")


def level_columns(path: Column, depth: int, name: str = "Level") -> list[Column]:
    """Columns Level_0, Level_1, ... of a path, '' beyond its end."""
    return [F.coalesce(F.get(path, F.lit(i)), F.lit("")).alias(f"{name}_{i}") for i in range(depth)]


def deepest_level(columns: Sequence[Column]) -> Column:
    """Number of the last level that isn't empty, counted from 0; -1 if all are."""
    return F.greatest(F.lit(-1), *(F.when(c != "", i).otherwise(-1) for i, c in enumerate(columns)))


def header_paths(df: DataFrame, title: str, line: str, order: str, by: str) -> DataFrame:
    """Column titles of tables as `subject|title|group|subgroup|name` paths, with the ordinal of each data cell.

    In each table the first two rows without a line number are its subject and title; a title that ends in a colon
    opens a group (a subgroup inside a group), any other is a cell; lines with .5 are remarks. Points are taken out.
    """
    rows = df.where(~F.col(line).contains(".5") & (F.trim(title) != "")).withColumn("__t", F.replace(F.trim(title), F.lit("."), F.lit("")))
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    head = F.trim(line) == ""
    rows = rows.withColumn("__heads", F.sum(head.cast("int")).over(w)).withColumn("__head", head)
    is_group = ~F.col("__head") & F.col("__t").endswith(":")
    keep = lambda cond: F.coalesce(F.last(F.when(cond, F.col("__t")), ignorenulls=True).over(w), F.lit(""))
    rows = rows.withColumns({"__subject": keep(F.col("__head") & (F.col("__heads") == 1)), "__title": keep(F.col("__head") & (F.col("__heads") >= 2)), "__group": keep(is_group)})
    cells = rows.where(~F.col("__head"))
    parts = [F.col("__subject"), F.col("__title"), F.when(is_group, "").otherwise(F.regexp_replace("__group", ":$", "")), F.regexp_replace("__t", ":$", "")]
    return cells.select(by, F.row_number().over(Window.partitionBy(by).orderBy(order)).alias("cell"), F.array_join(F.array(*parts), "|").alias("path"))


def unique_labels(df: DataFrame, levels: Sequence[str], out: str, by: Sequence[str] = ()) -> DataFrame:
    """Labels made unique: the deepest level, and while labels repeat, ` - ` and the level above.

    levels go from the top down. As many passes as there are levels, each one count over a window.
    """
    df = df.withColumn(out, F.col(levels[-1]))
    for above in reversed(levels[:-1]):
        n = F.count(F.lit(1)).over(Window.partitionBy(*by, out))
        df = df.withColumn("__n", n).withColumn(out, F.when((F.col("__n") > 1) & (F.col(above) != ""), F.concat_ws(" - ", out, above)).otherwise(F.col(out))).drop("__n")
    return df


def change_runs(df: DataFrame, column: str, order: str, by: Sequence[str] = (), out: str = "run") -> DataFrame:
    """Number the runs of equal values from 1."""
    w = _window(order, by)
    change = (~F.lag(column).over(w).eqNullSafe(F.col(column)) | (F.row_number().over(w) == 1)).cast("int")
    return df.withColumn("__new", change).withColumn(out, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def footer_rows(df: DataFrame, width: str, expected: int, order: str, by: Sequence[str] = ()) -> DataFrame:
    """Add is_footer: the row comes after the last row of the expected width."""
    last = F.max(F.when(F.col(width) == expected, F.col(order))).over(Window.partitionBy(*by))
    return df.withColumn("is_footer", F.col(order) > F.coalesce(last, F.lit(-1)))


def without_blank_edges(df: DataFrame, text: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows between the first and the last that aren't blank."""
    w, filled = Window.partitionBy(*by), F.when(F.trim(text) != "", F.col(order))
    out = df.withColumn("__a", F.min(filled).over(w)).withColumn("__b", F.max(filled).over(w))
    return out.where(F.col(order).between(F.col("__a"), F.col("__b"))).drop("__a", "__b")


def numbered(df: DataFrame, items: str, pos: str, item: str) -> DataFrame:
    """Items of an array as rows, numbered from 0."""
    return df.select(*(c for c in df.columns if c != items), F.posexplode(items).alias(pos, item))
