"""Census survey: geography, estimates and margins by cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.reshape import struct_of
from ledgerloom.sources.texts import csv_cells, fixed_width

# Start (from 1) and width of the coded fields of the geography file, and the record number.
GEOGRAPHY = {
    "LOGRECNO": (14, 7), "C": (21, 1), "r": (22, 1), "D": (23, 1), "s": (26, 2), "c": (28, 3), "j": (31, 5), "i": (36, 5), "T": (41, 6),
    "G": (47, 1), "W": (48, 5), "m": (76, 5), "b": (81, 3), "B": (84, 5), "n": (91, 5), "u": (104, 5), "g": (114, 2), "L": (116, 3),
    "l": (119, 3), "q": (141, 5), "Q": (146, 5), "k": (151, 5), "e": (169, 5),
}


def geography(ls: DataFrame) -> DataFrame:
    """(LOGRECNO, geo map) of fixed-width lines; codes are case-sensitive, blank fields are left out."""
    cells = {f"f{i}": at for i, at in enumerate(GEOGRAPHY.values())}
    g = fixed_width(ls.select("line"), "line", cells)
    names = list(GEOGRAPHY)
    return struct_of(g, "geo", {n: f"f{i}" for i, n in enumerate(names) if n != "LOGRECNO"}).select(F.col("f0").alias("LOGRECNO"), "geo")


def cells(ls: DataFrame, value: str, width: int = 300) -> DataFrame:
    """(time, seq, LOGRECNO, cell, value) of estimate or margin lines; cells are numbered from 1, short lines left out."""
    row = ls.select(csv_cells(F.col("line"), width).alias("c"), F.size(F.split("line", ",")).alias("n")).where("n > 6")
    out = row.select(F.get("c", F.lit(0)).alias("time"), F.regexp_replace(F.get("c", F.lit(3)), "^0+", "").alias("seq"), F.get("c", F.lit(4)).alias("LOGRECNO"), F.posexplode(F.slice("c", F.lit(7), F.col("n") - 6)).alias("k", value))
    return out.withColumn("cell", F.col("k") + 1).drop("k")


def survey_cells(estimates: DataFrame, margins: DataFrame, headers: DataFrame, geo: DataFrame) -> DataFrame:
    """(geo, time, title, estimate, margin): estimates and margins meet by record and cell, not by line number.

    headers (seq, cell, path); records without geography keep a null geo instead of another record's.
    """
    keys = ["time", "seq", "LOGRECNO", "cell"]
    both = estimates.join(margins, keys, "left").join(headers, ["seq", "cell"])
    return both.join(geo, "LOGRECNO", "left").select("geo", "time", F.col("path").alias("title"), "estimate", "margin")
