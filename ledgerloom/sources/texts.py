"""Sources of lines and sections: fixed width, dirty tables, sectioned files, outlines, prose."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def texts(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, text) of whole files; path may be a pattern or a folder. Bytes are decoded by the encoding."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.decode("content", encoding).alias("text"))


def lines(whole: DataFrame) -> DataFrame:
    """(file, pos, line) of (file, text), pos from 0; NULs and line ends of all kinds go."""
    clean = F.replace("text", F.lit("\0"), F.lit(""))
    return whole.select("file", F.posexplode(F.split(F.regexp_replace(clean, r"(\r\n|\r|\n)$", ""), r"\r\n|\r|\n")).alias("pos", "line"))


def line_source(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, line) of splittable text files, for formats in which order doesn't count."""
    df = spark.read.option("encoding", encoding).text(path)
    return df.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.replace("value", F.lit("\0"), F.lit("")).alias("line"))


def fixed_width(df: DataFrame, line: str, fields: dict[str, tuple[int, int]]) -> DataFrame:
    """Fields (name -> start from 1, width) of a line, trimmed; other columns stay."""
    cut = {n: F.trim(F.substr(F.col(line), F.lit(a), F.lit(w))) for n, (a, w) in fields.items()}
    return df.withColumns(cut).drop(line)


def delimited(df: DataFrame, line: str, names: Sequence[str], sep: str = "\t") -> DataFrame:
    """Cells of a dirty line by position: surplus cells are cut off, missing ones null, texts trimmed; blank lines are left out."""
    cells = F.split(F.col(line), re.escape(sep), -1)
    out = df.where(F.trim(line) != "").withColumn("__cells", cells)
    return out.withColumns({n: F.trim(F.get("__cells", F.lit(i))) for i, n in enumerate(names)}).drop("__cells", line)


def csv_cells(line: Column, width: int) -> Column:
    """Cells of a CSV line as an array of texts; quotes may hold commas. A line is parsed once, however wide it is."""
    names = [f"c{i}" for i in range(width)]
    row = F.from_csv(line, ", ".join(f"{n} string" for n in names), {"quote": '"', "escape": '"'})
    cells = F.transform(F.array(row), lambda r: F.array(*(r[n] for n in names)))
    return F.transform(F.get(cells, F.lit(0)), lambda x: F.coalesce(F.trim(x), F.lit("")))


def csv_with_dated_header(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """A CSV whose last header cell is the date of update: (rows, date)."""
    df = spark.read.csv(path, header=True, quote='"', escape='"')
    return df.drop(df.columns[-1]), df.columns[-1]


def name_parts(file: Column, sep: str = "_") -> Column:
    """Parts of a file name without its ending."""
    return F.split(F.regexp_replace(file, r"\.[^.]*$", ""), re.escape(sep))


def sections(ls: DataFrame, header: str, expected: Column | None = None) -> DataFrame:
    """Add section to (file, pos, line): `head` before the line that matches header, `names` for it, then `data`, and
    `foot` after the last line with as many cells as the names line (or, with `expected`, after the last line it holds for).
    """
    by = Window.partitionBy("file")
    at = F.min(F.when(F.col("line").rlike(header), F.col("pos"))).over(by)
    cells = F.size(F.split("line", ","))
    df = ls.withColumn("__at", at).withColumn("__n", cells)
    df = df.withColumn("__width", F.max(F.when(F.col("pos") == F.col("__at"), F.col("__n"))).over(by))
    full = expected if expected is not None else F.col("__n") >= F.col("__width")
    last = F.max(F.when((F.col("pos") > F.col("__at")) & full, F.col("pos"))).over(by)
    section = F.when(F.col("pos") < F.col("__at"), "head").when(F.col("pos") == F.col("__at"), "names").when(F.col("pos") <= last, "data").otherwise("foot")
    return df.withColumn("section", section).drop("__at", "__n", "__width")


def head_metadata(sectioned: DataFrame) -> DataFrame:
    """(file, title, units, revised, notes) from head lines: the first line, what stands in square brackets, the date
    after `Last Revised`, and all other lines that aren't blank.
    """
    head = sectioned.where("section = 'head' AND trim(line) <> ''")
    h = head.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("ls")).withColumn("ls", F.transform("ls", lambda x: F.btrim(x["line"], F.lit(' ",'))))
    text = F.array_join("ls", "\n")
    rest = F.filter(F.slice("ls", F.lit(2), F.size("ls")), lambda x: ~x.rlike(r"^\[.*\]$|Last Revised"))
    return h.select("file", F.get("ls", F.lit(0)).alias("title"), F.regexp_extract(text, r"\[([^\]]*)\]", 1).alias("units"), F.regexp_extract(text, r"Last Revised[: ]+(.*)", 1).alias("revised"), F.array_join(rest, "\n").alias("notes"))


def prose_sections(ls: DataFrame, marks: dict[str, str]) -> DataFrame:
    """(file, section, text): lines under the last mark before them (name -> regular expression of the mark's line)."""
    mark = F.lit(None).cast("string")
    for n, p in marks.items():
        mark = F.when(F.col("line").rlike(p), n).otherwise(mark)
    w = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    df = ls.withColumn("__mark", mark).withColumn("section", F.last("__mark", ignorenulls=True).over(w))
    body = df.where("section IS NOT NULL AND __mark IS NULL AND trim(line) <> ''")
    return body.groupBy("file", "section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: F.trim(x["line"])), "\n").alias("text"))


def glossary(ls: DataFrame, entry: str = r"^\s*(\S+)\s+-\s+(.*)$") -> DataFrame:
    """(file, name, text) of entries `name - text`, whose text may go on in the lines below."""
    w = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    name = F.regexp_extract("line", entry, 1)
    df = ls.where("trim(line) <> ''").withColumn("__new", F.when(name != "", 1).otherwise(0)).withColumn("__k", F.sum("__new").over(w)).where("__k > 0")
    part = F.when(F.col("__new") == 1, F.regexp_extract("line", entry, 2)).otherwise(F.trim("line"))
    g = df.groupBy("file", "__k").agg(F.max(name).alias("name"), F.array_sort(F.collect_list(F.struct("pos", part.alias("t")))).alias("ts"))
    return g.select("file", "name", F.array_join(F.transform("ts", lambda x: x["t"]), " ").alias("text"))
