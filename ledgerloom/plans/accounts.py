"""Economic accounts: sectioned tables with indented categories into long series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import footnotes
from ledgerloom.functions.timecode import account_period
from ledgerloom.operators.ordered import hierarchy, indent_of, unique_labels
from ledgerloom.sources.texts import csv_cells, head_metadata, lines, sections

#: Most cells of a line that are read.
WIDEST = 400


def account_tables(whole: DataFrame, header: str = r"^\"?Line\b", depth: int = 8) -> tuple[DataFrame, DataFrame]:
    """(long, metadata) of account tables (file, text).

    long: file, pos, line, label (unique in its file), path (array), level, notes, time (period code), value (null where
    missing). A table begins with the header line; the second column holds the category, indented by blanks; --- and
    empty cells are missing; footnote markers follow a backslash. Lines after the last full one are notes.
    """
    sectioned = sections(lines(whole), header)
    cells = sectioned.withColumn("cells", csv_cells(F.col("line"), WIDEST)).withColumn("raw", F.regexp_extract("line", r"^[^,]*,(\"[^\"]*\"|[^,]*)", 1))
    names = cells.where("section = 'names'").select("file", F.col("cells").alias("names"))
    data = cells.where("section = 'data'").select("file", "pos", "cells", F.regexp_replace("raw", '"', "").alias("category"))
    data = data.withColumn("indent", indent_of(F.col("category")))
    marked = footnotes(F.trim("category"), "\\")
    data = data.withColumn("text", marked["text"]).withColumn("notes", marked["notes"])
    tree = hierarchy(data, "text", "indent", "pos", depth, ["file"])
    for i in range(depth):
        tree = tree.withColumn(f"L{i}", F.coalesce(F.get("path", F.col("level") - (depth - 1 - i)), F.lit("")))
    tree = unique_labels(tree, [f"L{i}" for i in range(depth)], "label", ["file"])
    wide = tree.join(names, "file")
    pairs = F.arrays_zip(F.col("names").alias("n"), F.col("cells").alias("v"))
    long = wide.select("file", "pos", F.get("cells", F.lit(0)).alias("line"), "label", "path", "level", "notes", F.explode(pairs).alias("p"))
    long = long.withColumn("time", account_period(F.trim("p.n"))).where("time IS NOT NULL")
    return long.select("file", "pos", "line", "label", "path", "level", "notes", "time", F.replace("p.v", F.lit(","), F.lit("")).try_cast("double").alias("value")), head_metadata(sectioned)


def place_of(fips: Column, name: Column, level: str) -> Column:
    """struct(names, f): maps of the kind of place to its name and code. A county's code is that of the state and its own,
    its name ends with the state's after the last comma.
    """
    code = {"state": "s", "metro": "m", "csa": "b", "mdiv": "B", "econ": "X"}
    if level == "county":
        short = F.trim(F.regexp_replace(name, r",[^,]*$", ""))
        state = F.trim(F.regexp_extract(name, r",([^,]*)$", 1))
        return F.struct(F.create_map(F.lit("c"), short, F.lit("s"), state).alias("names"), F.create_map(F.lit("s"), F.left(fips, F.lit(2)), F.lit("c"), F.right(fips, F.lit(3))).alias("f"))
    k = F.lit(code[level])
    return F.struct(F.create_map(k, name).alias("names"), F.create_map(k, fips).alias("f"))


def investment_place(levels: Column) -> Column:
    """A map of region (R), country or group (C), part (c) and `other`, of the levels of a table's place column.

    levels is an array padded with '' to the depth of the table. Under a first level of others, the group is one level
    down; a level `Other` is named by the one below it. Canada and the United States are parts of North America. Empty
    parts are left out.
    """
    at = lambda i: F.coalesce(F.get(levels, F.lit(i)), F.lit(""))
    n, none = F.size(levels), F.lit("")
    others = F.contains(F.lower(at(0)), F.lit("other")) & (n > 2)
    skip = F.when(others, (at(2) == "Other") & (n > 3)).otherwise((at(1) == "Other") & (n > 2) & (at(2) != ""))
    group = F.when(others, at(1)).when(n > 1, at(0)).otherwise(none)
    part = F.when(others, F.when(skip, at(3)).otherwise(at(2))).when(n > 1, F.when(skip, at(2)).otherwise(at(1))).otherwise(at(0))
    north = group.isin("Canada", "United States")
    parts = F.create_map(
        F.lit("R"), F.when(others, at(0)).otherwise(none), F.lit("C"), F.when(north, "North America").otherwise(group),
        F.lit("c"), F.when(north, group).otherwise(part), F.lit("other"), F.when(skip, "true").otherwise(none),
    )
    return F.map_filter(parts, lambda _, v: v != "")


def crosstab(whole: DataFrame, header: str, width: int, depth: int = 4) -> DataFrame:
    """Rows (file, pos, path, group, year, value) of cross-tabs whose columns are `Group - Year` and whose first cell is indented."""
    sectioned = sections(lines(whole), header).withColumn("cells", csv_cells(F.col("line"), width)).withColumn("raw", F.regexp_replace(F.regexp_extract("line", r"^(\"[^\"]*\"|[^,]*)", 1), '"', ""))
    names = sectioned.where("section = 'names'").select("file", F.col("cells").alias("names"))
    data = sectioned.where("section = 'data'").withColumn("indent", indent_of(F.col("raw"))).withColumn("text", F.trim("raw"))
    tree = hierarchy(data, "text", "indent", "pos", depth, ["file"]).join(names, "file")
    long = tree.select("file", "pos", "path", F.explode(F.arrays_zip(F.col("names").alias("n"), F.col("cells").alias("v"))).alias("p")).where("p.n LIKE '% - %'")
    return long.select("file", "pos", "path", F.substring_index("p.n", " - ", 1).alias("group"), F.substring_index("p.n", " - ", -1).alias("year"), F.replace("p.v", F.lit(","), F.lit("")).try_cast("double").alias("value"))


def stages(tables: Sequence[str], areas: Sequence[str]) -> list[tuple[str, str]]:
    """Every table with every kind of area, in order: the steps of a pipeline over both."""
    return [(t, a) for t in tables for a in areas]
