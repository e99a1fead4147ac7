"""Columns, unions and keyed writes of tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.joins import one_per_key


def add_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns (name -> type) that df lacks, as nulls; names compare without case."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c.lower() not in have})


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """df without the names, compared without case; unknown ones are no error."""
    gone = {n.lower() for n in names}
    return df.select(*(F.col(c) for c in df.columns if c.lower() not in gone))


def with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def info_and_data(columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns before the first whose name begins with four digits are Info, it and the others Data."""
    at = next((i for i, c in enumerate(columns) if re.match(r"\d{4}", c)), len(columns))
    return {"Info": list(columns[:at]), "Data": list(columns[at:])}


def stack(tables: Sequence[DataFrame], common_only: bool = False) -> DataFrame:
    """UNION ALL by name: of the columns all tables share, or of all columns with nulls for what a table lacks."""
    if common_only:
        common = [c for c in tables[0].columns if all(c in t.columns for t in tables)]
        return reduce(DataFrame.unionByName, (t.select(*common) for t in tables))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """target and the rows of batch whose key is new: the first of each key by order, none whose key target has. Null keys are new each time."""
    null_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    fresh = one_per_key(batch.where(~null_key), keys, order).join(target.select(*keys).distinct(), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns)).unionByName(batch.where(null_key).select(*target.columns))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of batch (the first of each key by order) replace those of target with the same key; others are kept."""
    new = one_per_key(batch, keys, order)
    return target.join(new.select(*keys), list(keys), "left_anti").unionByName(new.select(*target.columns))


def type_of_values(c: Column) -> Column:
    """Aggregate: INTEGER if all values are digits once signs are gone, REAL if they have at most one point, else VARCHAR."""
    plain = F.regexp_replace(F.trim(c), r"^-|,", "")
    whole, real = plain.rlike(r"^[0-9]+$"), plain.rlike(r"^[0-9]*\.?[0-9]*$") & plain.rlike("[0-9]")
    filled = F.when(F.trim(c) != "", True)
    return F.when(F.coalesce(F.bool_and(F.when(filled, whole)), F.lit(False)), "INTEGER").when(F.coalesce(F.bool_and(F.when(filled, real)), F.lit(False)), "REAL").otherwise("VARCHAR")


def infer_types(df: DataFrame) -> DataFrame:
    """(column, type) of a table of texts, from all its rows."""
    kinds = df.agg(*(type_of_values(F.col(c)).alias(c) for c in df.columns))
    return kinds.unpivot([], list(df.columns), "column", "type")


def header_names(names: Sequence[str]) -> list[str]:
    """Names usable as columns: signs become underscores, repeated names get a number."""
    out: list[str] = []
    for n in names:
        base = re.sub(r"\W+", "_", n.strip()).strip("_") or "col"
        name, k = base, 1
        while name.lower() in (x.lower() for x in out):
            k += 1
            name = f"{base}{k}"
        out.append(name)
    return out


def top_with_members(df: DataFrame, group: str, member: str, weight: str, n: int) -> DataFrame:
    """The n heaviest groups with all their members: (rank, group, total, member, weight)."""
    totals = df.groupBy(group).agg(F.sum(weight).alias("total")).orderBy(F.desc("total"), group).limit(n)
    ranked = totals.withColumn("rank", F.expr(f"row_number() OVER (ORDER BY total DESC, {group})"))
    return df.join(F.broadcast(ranked), group).select("rank", group, "total", member, weight)


def rename_columns(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Columns renamed by a rule of names; two that would get one name are an error."""
    new = {c: rule(c) for c in df.columns}
    if len({n.lower() for n in new.values()}) < len(new):
        raise ValueError("the rule gives two columns the same name")
    return df.withColumnsRenamed({c: n for c, n in new.items() if c != n})


def overwrite_where(df: DataFrame, column: str, mask: Column, value: object) -> DataFrame:
    """column overwritten by a value where the mask holds; where the mask is null it stays."""
    return df.withColumn(column, F.when(mask, F.lit(value)).otherwise(F.col(column)))


def stack_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Columns computed apart side by side with those of df: all come from the same rows, so nothing is aligned by position."""
    return df.withColumns(columns)


def choose_files(df: DataFrame, name: str, folder: str, without: str = "Current", whole: str = "AllData", part: str = ".data.") -> DataFrame:
    """Rows of files to load: none whose name has the token `without` between points; in a folder with a file of all data
    (`whole`) the other data files (`part`) are left out, as they repeat it.
    """
    kept = df.where(~F.array_contains(F.split(name, r"\."), without))
    has = F.bool_or(F.contains(F.col(name), F.lit(whole)))
    folders = kept.groupBy(F.col(folder).alias("__folder")).agg(has.alias("__whole")).where("__whole").select("__folder")
    apart = F.contains(F.col(name), F.lit(part)) & ~F.contains(F.col(name), F.lit(whole))
    return kept.where(~apart).unionByName(kept.where(apart).join(folders, F.col(folder).eqNullSafe(F.col("__folder")), "left_anti"))


def replicate(spark: SparkSession, table: str, new: str) -> None:
    """An empty table with the columns of another."""
    spark.table(table).limit(0).write.saveAsTable(new)


def write_ascii_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, texts in ASCII."""
    from ledgerloom.functions.text import to_ascii

    texts = {c for c, t in df.dtypes if t == "string"}
    df.select(*(to_ascii(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns)).write.mode("overwrite").csv(path, header=True)


def append_delimited(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Rows appended to a set of delimited files with headers."""
    df.write.mode("append").csv(path, sep=sep, header=True)


def write_documents(df: DataFrame, path: str) -> None:
    """One JSON document a row; attributes that are null, or empty texts, are left out."""
    filled = [F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes]
    df.select(*filled).write.mode("append").option("ignoreNullFields", "true").json(path)


def write_with_metadata(df: DataFrame, path: str, metadata: dict[str, str]) -> None:
    """A Parquet table with its metadata beside it, as a table of key and value."""
    df.write.mode("overwrite").parquet(f"{path}/data")
    df.sparkSession.createDataFrame(sorted(metadata.items()), "key string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")
