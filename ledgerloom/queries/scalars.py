"""Queries of the scalar functions: text, numbers of patents, periods and dates. Each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.functions import timecode as C
from ledgerloom.functions.similarity import name_similarity
from ledgerloom.operators import joins as J
from ledgerloom.queries.common import table as t

QUERIES, SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def sql_replace(c: str, *rules: tuple[str, str]) -> str:
    for a, b in rules:
        c = f"regexp_replace({c}, '{a}', '{b}', 'g')"
    return c


_ACCENT = (r"\{{[^}}(]*\(([^)]*)\)[^}}]*\}}".replace("{{", "{").replace("}}", "}"), r"\1")
_NAME = sql_replace("upper(assignee)", _ACCENT, (r" *([,|-])", r"\1"), (r"\([^)]*\)|\{[^}]*\}", ""), (r"[^A-Za-z0-9 ]", " "), (r"  +", " "), (r"([ ,|-])[ ,|-]+", r"\1"))


@query(f"SELECT DISTINCT assignee, trim({_NAME}) AS clean FROM assignee")
def ascit_clean(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "assignee").select("assignee", X.clean_name(F.col("assignee"), ascii_only=False).alias("clean")).distinct()


@query(None)
def ascii_names(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "assignee").select("rid", X.clean_name(F.col("assignee")).alias("clean"), X.to_ascii(F.col("city")).alias("city"))


_PLACE = sql_replace("upper(city)", _ACCENT, (r"\b[A-Z]{1,5} ?-{0,2} ?[0-9]+\b|\b[0-9]+ ?-{1,2} ?[A-Z]{1,5}\b|\b[0-9]+[A-Z]{1,5}\b", ""), ("[0-9]", ""), (r"\b[A-Z]+,? +I?OF ", ""), (r"\([^)]*\)", ""), (r"""[.()`''#"&]|-{2,}|/-""", ""), (r" *([,|-]) *", r"\1"), (r"([ ,|-])[ ,|-]+", r"\1"), (r"^[,|-]+|[,|-]+$", ""))


@query(f"SELECT loc_id, trim({_PLACE}) AS place FROM loc")
def place_clean(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "loc").select("loc_id", X.clean_place(F.col("city"), ascii_only=False).alias("place"))


@query(None)
def city_rules(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "loc").select("loc_id", X.clean_city(F.col("city"), F.col("country")).alias("city"), X.clean_country(F.col("country"), F.col("city")).alias("country"))


@query("""
SELECT asgnum, replace(assignee, ' ', '') AS block1,
  CASE WHEN len(list_filter(string_split(assignee, ' '), lambda w: length(w) >= 4)) >= 4 THEN array_to_string(list_transform(list_filter(string_split(assignee, ' '), lambda w: length(w) >= 4)[1:4], lambda w: left(w, 2)), '') ELSE assignee END AS block2,
  CASE WHEN length(assignee) >= 25 AND len(string_split(assignee, ' ')) >= 2 THEN left(reverse(assignee), 25) ELSE assignee END AS block3,
  left(reverse(upper(assignee)), 4) AS ending FROM grp""")
def block_keys(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("assignee")
    return t(spark, d, "grp").select("asgnum", X.without_blanks(c).alias("block1"), X.letters_block(c).alias("block2"), X.backwards_block(c, c).alias("block3"), X.reversed_prefix(c, 4).alias("ending"))


@query(r"""
WITH p AS (SELECT rid, patent, regexp_replace(patent, '[^A-Za-z0-9]', '', 'g') AS plain FROM inventor),
s AS (SELECT *, CASE WHEN regexp_matches(plain, '^[A-Za-z]*[0-9]+$') THEN regexp_replace(plain, '^([A-Za-z]*)0*([0-9])', '\1\2') ELSE plain END AS simple FROM p),
l AS (SELECT *, regexp_extract(simple, '^[A-Za-z]*') AS a FROM s)
SELECT rid, simple, CASE WHEN regexp_matches(substr(simple, length(a) + 1), '^[0-9]+$') THEN a || lpad(substr(simple, length(a) + 1), CAST(greatest(8, length(simple)) - length(a) AS INTEGER), '0') ELSE simple END AS padded,
  CASE WHEN regexp_matches(patent, '^[0-9]') THEN 'U' ELSE left(patent, 1) END AS type FROM l""")
def pat8(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("patent")
    return t(spark, d, "inventor").select("rid", X.patent_plain(c).alias("simple"), X.patent_8(c).alias("padded"), X.patent_type(c).alias("type"))


@query(r"""SELECT rid, CASE WHEN cit_country <> 'US' OR contains(citation, '/') OR length(citation) = 8 THEN citation ELSE regexp_extract(citation, '[A-Z]+') || lpad(regexp_extract(citation, '[0-9]+'), CAST(greatest(8 - length(regexp_extract(citation, '[A-Z]+')), length(regexp_extract(citation, '[0-9]+'))) AS INTEGER), '0') END AS number FROM citation""")
def cited_numbers(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "citation").select("rid", X.patent_number(F.col("citation"), F.col("cit_country")).alias("number"))


@query("SELECT asgnum, 'H' || lpad(CAST(asgnum AS VARCHAR), 12, '0') AS key, CASE WHEN cnt > 1 THEN 'A' || lpad(CAST(cnt AS VARCHAR), 12, '0') ELSE 'H' || lpad(CAST(asgnum AS VARCHAR), 12, '0') END AS made FROM grp")
def generated_keys(spark: SparkSession, d: str) -> DataFrame:
    g = t(spark, d, "grp")
    external = F.when(F.col("cnt") > 1, F.col("cnt").cast("string"))
    return g.select("asgnum", X.pad_key(F.concat(F.lit("H"), F.col("asgnum").cast("string"))).alias("key"), X.generated_key(F.lit(""), external, F.col("asgnum")).alias("made"))


@query("SELECT loc_id, length(regexp_replace(city, '[^,|]', '', 'g')) AS n, city AS whole, coalesce(regexp_split_to_array(city, ' *[,|] *')[1], '') AS first, coalesce(regexp_split_to_array(city, ' *[,|] *')[2], '') AS second FROM loc")
def field_parts(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("city")
    return t(spark, d, "loc").select("loc_id", X.count_separators(c).cast("long").alias("n"), X.part_of(c, -1).alias("whole"), X.part_of(c, 0).alias("first"), X.part_of(c, 1).alias("second"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y') || 'XX' || strftime(o_orderdate, '%m') AS monthly, strftime(o_orderdate, '%Y') || 'X' || quarter(o_orderdate) || 'XX' AS quarterly,
  strftime(o_orderdate, '%Y') || CASE WHEN month(o_orderdate) <= 6 THEN '1' ELSE '2' END || 'XXX' AS halves, strftime(o_orderdate, '%Y') || 'XXXX' AS yearly FROM orders""")
def tval_codes(spark: SparkSession, d: str) -> DataFrame:
    m, y = F.month("o_orderdate"), F.year("o_orderdate")
    code = lambda p: C.survey_period(y, p)
    return t(spark, d, "orders").select(
        "o_orderkey",
        code(F.concat(F.lit("M"), F.lpad(m.cast("string"), 2, "0"))).alias("monthly"),
        code(F.concat(F.lit("Q"), F.quarter("o_orderdate"))).alias("quarterly"),
        code(F.when(m <= 6, "S1").otherwise("S2")).alias("halves"),
        code(F.lit("M13")).alias("yearly"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y') || 'X' || strftime(o_orderdate, '%m') AS month_code, strftime(o_orderdate, '%Y') || quarter(o_orderdate) || 'XX' AS quarter_code, strftime(o_orderdate, '%Y') || 'XXX' AS year_code, strftime(o_orderdate, '%Y') || quarter(o_orderdate) || 'XX' AS income_code, strftime(o_orderdate, '%Y') AS last_year FROM orders""")
def nea_codes(spark: SparkSession, d: str) -> DataFrame:
    y = F.year("o_orderdate").cast("string")
    roman = F.element_at(F.array(*(F.lit(r) for r in C.ROMAN)), F.quarter("o_orderdate"))
    return t(spark, d, "orders").select(
        "o_orderkey",
        C.account_period(F.concat_ws("-", y, F.date_format("o_orderdate", "MMM"))).alias("month_code"),
        C.account_period(F.concat_ws("-", y, roman)).alias("quarter_code"),
        C.account_period(y).alias("year_code"),
        C.income_period(F.concat_ws(".", y, F.quarter("o_orderdate"))).alias("income_code"),
        C.last_of_range(F.concat_ws("-", F.lit("1969"), y)).alias("last_year"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS short, strftime(o_orderdate, '%Y-%m-%d') AS slashed, strftime(o_orderdate, '%Y-%m-%d') AS digits, strftime(o_orderdate, '%Y%m%d') AS plain, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def date_vert(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("o_orderdate")
    iso = F.date_format(c, "yyyy-MM-dd")
    return t(spark, d, "orders").select(
        "o_orderkey",
        C.typed_date(F.date_format(c, "d-MMM-yy")).alias("short"),
        C.typed_date(F.date_format(c, "M/d/yyyy")).alias("slashed"),
        C.typed_date(F.date_format(c, "yyyyMMdd")).alias("digits"),
        C.without_dashes(iso).alias("plain"),
        C.year_of(iso).alias("year"),
    )


@query(r"SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '((?:[A-Z](?:\.[0-9]+)+)+)', 1))), ',') AS codes FROM documents WHERE text IS NOT NULL")
def release_codes(spark: SparkSession, d: str) -> DataFrame:
    docs = t(spark, d, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.array_join(F.array_sort(X.release_codes(F.col("text"))), ",").alias("codes"))


@query("SELECT p_partkey, p_name AS rel, p_brand AS segment FROM part")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    url = F.concat(F.lit("http://example.org/"), F.replace("p_brand", F.lit("#"), F.lit("%23")), F.lit("/view.aspx?rel="), F.url_encode("p_name"))
    return t(spark, d, "part").select("p_partkey", F.url_decode(X.query_value(url)).alias("rel"), F.url_decode(X.path_segment(url)).alias("segment"))


@query("SELECT p_partkey, p_name AS name, CAST(p_size AS VARCHAR) AS unit, CAST(p_size AS DOUBLE) AS amount FROM part")
def units(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    u = X.unit_in_brackets(F.concat("p_name", F.lit(" ("), size, F.lit(")")))
    return t(spark, d, "part").select("p_partkey", u["name"].alias("name"), u["unit"].alias("unit"), X.number_with_unit(F.concat(size, F.lit(" mg/L"))).alias("amount"))


@query("SELECT p_partkey, p_name AS text, p_size || ',' || (p_size + 1) AS notes FROM part")
def footnotes(spark: SparkSession, d: str) -> DataFrame:
    f = X.footnotes(F.concat("p_name", F.lit(" "), F.col("p_size"), F.lit("/ "), F.col("p_size") + 1, F.lit("/")))
    return t(spark, d, "part").select("p_partkey", f["text"].alias("text"), F.array_join(f["notes"], ",").alias("notes"))


@query(None)
def fuzzy_join(spark: SparkSession, d: str) -> DataFrame:
    """Typed cities of loc against the reference list, within the first three letters of clean names."""
    ref = t(spark, d, "placeref").select("place_id", X.clean_name(F.col("city")).alias("name"))
    loc = t(spark, d, "loc").where("trim(city) <> ''").select("loc_id", X.clean_place(F.col("city")).alias("name"))
    blocks = (F.left("name", F.lit(3)), F.left("name", F.lit(3)))
    return J.fuzzy_join(loc, ref, blocks, ("name", "name"), "loc_id", 0.92).select("loc_id", "r_place_id", F.round("score", 6).alias("score"))


@query(None)
def name_similarities(spark: SparkSession, d: str) -> DataFrame:
    g = t(spark, d, "grp").select("asgnum", "assignee", F.upper("assignee").alias("b"))
    return g.select("asgnum", F.round(name_similarity(F.col("assignee"), F.reverse("b")), 6).alias("score"))
