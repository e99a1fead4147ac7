"""Facilities and releases, health indicators and water systems."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import number_with_unit
from ledgerloom.operators.aggregate import nested
from ledgerloom.operators.reshape import struct_of
from ledgerloom.sources.markup import html_pairs, html_rows


def facilities(single: DataFrame, interests: DataFrame, contacts: DataFrame) -> DataFrame:
    """Facilities by registry number with their programme interests and each interest's contacts as an array of structs."""
    keys = ["PGM_SYS_ID", "INTEREST_TYPE"]
    people = contacts.groupBy(*keys).agg(nested("EMAIL_ADDRESS", "MAILING_ADDRESS").alias("contacts"))
    single = single.withColumnsRenamed({"CREATE_DATE": "FACILITY_CREATED", "UPDATE_DATE": "FACILITY_UPDATED"})
    return single.join(interests, "REGISTRY_ID").join(people, keys, "left")


def industry_code(sic: Column, naics: Column) -> Column:
    """struct(type, code): the SIC where there is one, else the NAICS."""
    has = sic.isNotNull() & (F.trim(sic) != "")
    return F.struct(F.when(has, "SIC").otherwise("NAICS").alias("type"), F.when(has, F.trim(sic)).otherwise(F.trim(naics)).alias("code"))


def releases(df: DataFrame, more: Sequence[int] = (2, 3, 4, 5, 6)) -> DataFrame:
    """Release inventory rows with industry codes (primary first) and the place as a map."""
    codes = [industry_code(F.col("Primary SIC"), F.col("Primary NAICS")), *(industry_code(F.col(f"SIC {i}"), F.col(f"NAICS {i}")) for i in more)]
    out = df.withColumn("industries", F.filter(F.array(*codes), lambda c: c["code"].isNotNull() & (c["code"] != "")))
    return struct_of(out, "place", {"a": "Street Address", "i": "City", "c": "County", "S": "ST", "p": "ZIP"})


def health_indicators(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Indicators with the place as maps of names and codes; descriptions of the dictionary become column comments."""
    known = {r["COLUMN_NAME"].upper(): r["DESCRIPTION"] for r in dictionary.where("COLUMN_NAME IS NOT NULL").select("COLUMN_NAME", "DESCRIPTION").collect()}
    out = struct_of(struct_of(df, "names", {"s": "CHSI_State_Name", "c": "CHSI_County_Name"}), "codes", {"s": "State_FIPS_Code", "c": "County_FIPS_Code"})
    out = out.withColumn("place", F.struct("names", F.col("codes").alias("f"))).drop("names", "codes")
    return out.select(*(F.col(c).alias(c, metadata={"comment": known.get(c.upper()) or ""}) for c in out.columns))


def water_systems(pages: DataFrame, html: str = "html") -> DataFrame:
    """(link, name, state, number, county) of the listed systems: grey table rows, number as `State NNN`."""
    rows = html_rows(pages, html, "#F5F5F5")
    cell = lambda i: F.get("cells", F.lit(i))
    return rows.select("link", cell(1).alias("name"), F.trim(F.regexp_replace(cell(2), r"[0-9]+$", "")).alias("state"), F.regexp_extract(cell(2), r"([0-9]+)$", 1).alias("number"), cell(3).alias("county"))


def water_details(pages: DataFrame, key: str, html: str = "html", concentration: str = "Fluoride concentration") -> DataFrame:
    """Details of each system as a map, and the concentration as a number (0 where it is blank)."""
    m = pages.select(key, html_pairs(F.col(html)).alias("details"))
    c = F.try_element_at("details", F.lit(concentration))
    return m.withColumn("concentration", F.when(F.coalesce(F.trim(c), F.lit("")) == "", 0.0).otherwise(number_with_unit(c)))
