"""Labour-statistics series: codes decoded, periods coded, one record for each series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.timecode import survey_period
from ledgerloom.operators.joins import decode
from ledgerloom.operators.reshape import series_map

# Words of a column name that make it a place, in order of preference, with the code of the kind of place.
SPACE_WORDS = [("state", "s"), ("county", "c"), ("msa", "m"), ("region", "r"), ("division", "D"), ("area", "X"), ("city", "i")]


def space_code(column: str) -> str | None:
    """Kind of place that a column holds, by its name; `f.` before it for codes."""
    name = column.lower()
    found = next((c for w, c in SPACE_WORDS if w in name), None)
    return f"f.{found}" if found and ("code" in name or "fips" in name) else found


def dimension_of(column: str, dimensions: list[str]) -> str | None:
    """The dimension whose codes a column holds: x_code, x_codes or x of a table x."""
    base = column.lower().removesuffix("s").removesuffix("_code")
    return next((d for d in dimensions if d.lower() in (base, column.lower())), None)


def decoded_series(series: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """series with the columns of every dimension it has codes of; unknown codes give nulls, no row is lost."""
    out = series
    for column in series.columns:
        name = dimension_of(column, list(dimensions))
        if name and column != name:
            dim = dimensions[name]
            key = next(c for c in dim.columns if dimension_of(c, [name]))
            out = decode(out, dim.select(key, *(F.col(c).alias(c if c not in out.columns else f"{name}_{c}") for c in dim.columns if c != key)), column, key)
    return out


def survey_records(series: DataFrame, data: DataFrame, dimensions: dict[str, DataFrame], key: str = "series_id") -> DataFrame:
    """One record for each series: decoded attributes and values, a map of period code -> value.

    data has key, year, period, value. Series without data have an empty map; data without series is left out.
    """
    coded = data.select(F.trim(key).alias(key), survey_period(F.trim("year"), F.col("period")).alias("time"), F.btrim("value").alias("value"))
    values = series_map(coded, [key], "time", "value")
    trimmed = decoded_series(series, dimensions).withColumn(key, F.trim(key))
    empty = F.create_map().cast("map<string,string>")
    return trimmed.join(values, key, "left").withColumn("values", F.coalesce("values", empty))


def with_units(df: DataFrame, rule: str | dict[str, str], text: str | None = None, default: str = "") -> DataFrame:
    """units: a constant, or by words that a text column holds (word -> unit, the first that fits)."""
    if isinstance(rule, str):
        return df.withColumn("units", F.col(rule) if rule in df.columns else F.lit(rule))
    out = F.lit(default)
    for word, unit in reversed(rule.items()):
        out = F.when(F.contains(F.lower(text), F.lit(word.lower())), unit).otherwise(out)
    return df.withColumn("units", out)


def keywords(df: DataFrame, code: str) -> DataFrame:
    """Keywords of a programme, one a row in their order."""
    k = df.where(F.lower(F.trim("Code")) == code.lower()).select(F.posexplode(F.split("Keywords", ",")).alias("pos", "keyword"))
    return k.select("pos", F.trim("keyword").alias("keyword")).where("keyword <> ''")
