"""Queries of the sources and sinks: test tables are written in a source's format, read by its reader, and compared with SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators import ordered as W
from ledgerloom.operators import reshape as R
from ledgerloom.operators import tables as T
from ledgerloom.plans import accounts, census, environment, patents, surveys
from ledgerloom.queries.common import table as t
from ledgerloom.session import scratch
from ledgerloom.sources import markup, texts

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _text(c: str | Column) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def _whole(lines: DataFrame, file: str, order: str, line: Column, head: Column, foot: Column) -> DataFrame:
    """(file, text): lines of a file in order, between its head and foot."""
    g = lines.select(F.col(file).alias("file"), F.struct(order, line.alias("l")).alias("x")).groupBy("file").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return g.select(F.col("file").cast("string").alias("file"), F.concat(head, F.array_join(F.transform("xs", lambda x: x["l"]), "\n"), foot).alias("text"))


# ---- lines


@query("SELECT CAST(p_partkey AS VARCHAR) AS partkey, p_name AS name, p_brand AS brand FROM part")
def src_dirty_table(spark: SparkSession, d: str) -> DataFrame:
    """A table of tabs with NULs, blanks around cells, blank lines and surplus cells."""
    home = scratch(spark)
    line = F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit("\t"), F.col("p_name"), F.lit(" \0\t"), F.col("p_brand"), F.lit("\tsurplus\tcells"))
    t(spark, d, "part").select(F.explode(F.array(line, F.lit("  "))).alias("value")).write.text(home)
    return texts.delimited(texts.line_source(spark, home).select("line"), "line", ["partkey", "name", "brand"])


@query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey, '2010-03-01' AS updated FROM supplier")
def src_dated_csv(spark: SparkSession, d: str) -> DataFrame:
    """A CSV whose last header cell is the date of its update."""
    home = scratch(spark)
    t(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", F.lit("").alias("2010-03-01")).write.csv(home, header=True)
    rows, date = texts.csv_with_dated_header(spark, home)
    return rows.withColumn("updated", F.lit(date))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS status, CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR) AS price FROM orders")
def src_fixed_width(spark: SparkSession, d: str) -> DataFrame:
    home = scratch(spark)
    price = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    t(spark, d, "orders").select(F.concat(F.rpad(F.col("o_orderkey").cast("string"), 12, " "), F.col("o_orderstatus"), F.lpad(price, 20, " ")).alias("value")).write.text(home)
    return texts.fixed_width(texts.line_source(spark, home).select("line"), "line", {"k": (1, 12), "status": (13, 1), "price": (14, 20)})


@query("SELECT CAST(loc_id AS VARCHAR) AS loc_id, trim(coalesce(city, ''), ' ') AS city, trim(coalesce(zipcode, ''), ' ') AS zipcode FROM loc")
def src_csv_cells(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a CSV whose cells hold commas and quotes; line ends inside cells are written as a sign."""
    plain = lambda c: F.replace(_text(c), F.lit("\n"), F.lit("␊"))
    quoted = lambda c: F.concat(F.lit('"'), F.replace(plain(c), F.lit('"'), F.lit('""')), F.lit('"'))
    home = scratch(spark)
    t(spark, d, "loc").select(F.concat_ws(",", F.col("loc_id").cast("string"), quoted("city"), quoted("zipcode")).alias("value")).write.text(home)
    cells = texts.line_source(spark, home).select(texts.csv_cells(F.col("line"), 3).alias("c"))
    back = lambda i: F.replace(F.get("c", F.lit(i)), F.lit("␊"), F.lit("\n"))
    return cells.select(back(0).alias("loc_id"), back(1).alias("city"), back(2).alias("zipcode"))


@query("SELECT p_partkey, string_split(p_brand || '_' || p_size, '_')[1] AS brand, CAST(p_size AS VARCHAR) AS size FROM part")
def src_name_parts(spark: SparkSession, d: str) -> DataFrame:
    parts = texts.name_parts(F.concat("p_brand", F.lit("_"), F.col("p_size").cast("string"), F.lit(".txt")))
    return t(spark, d, "part").select("p_partkey", F.get(parts, F.lit(0)).alias("brand"), F.get(parts, F.lit(1)).alias("size"))


# ---- sections


def _account_files(spark: SparkSession, d: str) -> DataFrame:
    """A sectioned file for each nation, a line for each supplier."""
    s = t(spark, d, "supplier")
    line = F.concat_ws(",", F.col("s_suppkey").cast("string"), F.col("s_name"), F.col("s_suppkey").cast("string"))
    head = F.concat(F.lit('"Table '), F.col("file").cast("string"), F.lit('"\n[Thousands of units]\n"Last Revised March 1, 2010"\nSee remarks\n\nLine,Name,Key\n'))
    return _whole(s, "s_nationkey", "s_suppkey", line, head, F.lit("\nSource: made up\n"))


@query("""
WITH n AS (SELECT CAST(s_nationkey AS VARCHAR) AS file, count(*) AS n FROM supplier GROUP BY 1)
SELECT file, 'head' AS section, 5 AS n FROM n UNION ALL SELECT file, 'names', 1 FROM n UNION ALL SELECT file, 'data', n FROM n UNION ALL SELECT file, 'foot', 1 FROM n""")
def src_sections(spark: SparkSession, d: str) -> DataFrame:
    return texts.sections(texts.lines(_account_files(spark, d)), "^Line,").groupBy("file", "section").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(s_nationkey AS VARCHAR) AS file, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) + 5 AS INTEGER) AS pos, CAST(s_suppkey AS VARCHAR) AS k, s_name AS name FROM supplier")
def src_section_data(spark: SparkSession, d: str) -> DataFrame:
    data = texts.sections(texts.lines(_account_files(spark, d)), "^Line,").where("section = 'data'").select("file", "pos", texts.csv_cells(F.col("line"), 3).alias("c"))
    return data.select("file", "pos", F.get("c", F.lit(0)).alias("k"), F.get("c", F.lit(1)).alias("name"))


@query("SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS file, 'Table ' || s_nationkey AS title, 'Thousands of units' AS units, 'March 1, 2010' AS revised, 'See remarks' AS notes FROM supplier")
def src_head_metadata(spark: SparkSession, d: str) -> DataFrame:
    return texts.head_metadata(texts.sections(texts.lines(_account_files(spark, d)), "^Line,"))


@query("""
SELECT CAST(s_nationkey AS VARCHAR) AS file, 'All|' || s_name AS path, 'A' AS "group", y AS year, CAST(CASE WHEN y = '2001' THEN s_suppkey ELSE s_suppkey * 2 END AS DOUBLE) AS value
FROM supplier, (VALUES ('2001'), ('2002')) v(y) UNION ALL SELECT DISTINCT CAST(s_nationkey AS VARCHAR), 'All', 'A', y, NULL::DOUBLE FROM supplier, (VALUES ('2001'), ('2002')) v(y)""")
def src_crosstab(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat_ws(",", F.concat(F.lit("  "), F.col("s_name")), F.col("s_suppkey").cast("string"), (F.col("s_suppkey") * 2).cast("string"))
    files = _whole(t(spark, d, "supplier"), "s_nationkey", "s_suppkey", line, F.lit("Title\n\nName,A - 2001,A - 2002\nAll,(D),\n"), F.lit("\n\nfoot"))
    return accounts.crosstab(files, "^Name,", 3).select("file", F.array_join("path", "|").alias("path"), "group", "year", "value")


@query("""
SELECT CAST(s_nationkey AS VARCHAR) AS file, 'Total|' || s_name || ' Co' AS path, '1' AS notes, CAST(y AS VARCHAR) || 'XXX' AS time, CASE y WHEN 1929 THEN CAST(s_suppkey AS DOUBLE) END AS value FROM supplier, (VALUES (1929), (1930)) v(y)
UNION ALL SELECT DISTINCT CAST(s_nationkey AS VARCHAR), 'Total', '', CAST(y AS VARCHAR) || 'XXX', CASE y WHEN 1929 THEN 1000.0 ELSE 2.0 END FROM supplier, (VALUES (1929), (1930)) v(y)""")
def account_series(spark: SparkSession, d: str) -> DataFrame:
    """Account tables of indented categories with footnotes as long series."""
    line = F.concat(F.col("s_suppkey").cast("string"), F.lit(',"  '), F.col("s_name"), F.lit(' Co\\1\\",'), F.col("s_suppkey").cast("string"), F.lit(",---"))
    files = _whole(t(spark, d, "supplier"), "s_nationkey", "s_suppkey", line, F.lit('"Table"\n\nLine,,1929,1930\n0,"Total","1,000",2\n'), F.lit("\n1. A note"))
    long, _ = accounts.account_tables(files)
    return long.select("file", F.array_join("path", "|").alias("path"), F.array_join("notes", ",").alias("notes"), "time", "value")


@query("""
SELECT CAST(s_nationkey AS VARCHAR) AS file, 'Contents' AS section, string_agg('about ' || s_name, chr(10) ORDER BY s_suppkey) AS text FROM supplier GROUP BY 1
UNION ALL SELECT DISTINCT CAST(s_nationkey AS VARCHAR), 'Contact', 'write to us' FROM supplier""")
def src_prose(spark: SparkSession, d: str) -> DataFrame:
    files = _whole(t(spark, d, "supplier"), "s_nationkey", "s_suppkey", F.concat(F.lit("  about "), F.col("s_name")), F.lit("preamble\nSection 1\n\n"), F.lit("\nSection 2\nwrite to us\n"))
    return texts.prose_sections(texts.lines(files), {"Contents": "^Section 1", "Contact": "^Section 2"})


@query("SELECT CAST(s_nationkey AS VARCHAR) AS file, 'f.' || s_suppkey AS name, s_name || ' more' AS text FROM supplier")
def src_glossary(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit("f."), F.col("s_suppkey").cast("string"), F.lit(" - "), F.col("s_name"), F.lit("\n      more"))
    return texts.glossary(texts.lines(_whole(t(spark, d, "supplier"), "s_nationkey", "s_suppkey", line, F.lit("Files:\n"), F.lit(""))))


@query("SELECT s_suppkey, s_suppkey % 5 AS level, s_name AS text FROM supplier")
def src_outline(spark: SparkSession, d: str) -> DataFrame:
    s = t(spark, d, "supplier").withColumn("raw", F.concat(F.repeat(F.lit("&nbsp;&nbsp;"), (F.col("s_suppkey") % 5).cast("int")), F.col("s_name")))
    return s.select("s_suppkey", (W.indent_of(F.col("raw"), "&nbsp;") / 2).cast("long").alias("level"), F.regexp_replace("raw", "^(?:&nbsp;)+", "").alias("text"))


# ---- XML and HTML

_XML_SAFE = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


def _tag(name: str, c: str) -> Column:
    x = F.regexp_replace(_text(c), _XML_SAFE, "")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.concat(F.lit(f"<{name}>"), x, F.lit(f"</{name}>"))


def _grant_files(spark: SparkSession, d: str) -> DataFrame:
    """A file of grants for each load, a document for each inventor row, numbered by rid."""
    parts = [
        F.lit('<?xml version="1.0"?>\n<us-patent-grant id="x"><us-bibliographic-data-grant><publication-reference><document-id>'), _tag("doc-number", "rid"),
        F.lit("</document-id></publication-reference><parties><applicants><applicant><addressbook>"), _tag("last-name", "lastname"), _tag("first-name", "firstname"),
        F.lit("<address>"), _tag("city", "city"), _tag("country", "country"), F.lit("</address></addressbook></applicant></applicants></parties></us-bibliographic-data-grant></us-patent-grant>"),
    ]
    return _whole(t(spark, d, "inventor"), "loadfile", "rid", F.concat(*parts), F.lit(""), F.lit("\n"))


_CLEAN = r"regexp_replace(regexp_replace(coalesce({0}, ''), '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g'), '^[\s\p{{Z}}\x85\x1c-\x1f]+|[\s\p{{Z}}\x85\x1c-\x1f]+$', '', 'g')"


@query(f"SELECT CAST(rid AS VARCHAR) AS patent, {_CLEAN.format('firstname')} AS firstname, {_CLEAN.format('lastname')} AS lastname, {_CLEAN.format('city')} AS city, {_CLEAN.format('country')} AS country, 0 AS invseq FROM inventor")
def src_grants(spark: SparkSession, d: str) -> DataFrame:
    """Inventors out of files of many XML documents."""
    tables = patents.patent_tables(markup.grants(markup.xml_documents(_grant_files(spark, d))))
    return tables["inventor"].select("patent", "firstname", "lastname", "city", "country", "invseq")


_FILLED = r"count(*) FILTER (regexp_matches(coalesce({0}, ''), '[\p{{L}}\p{{N}}_]'))"
_TOP = "/us-patent-grant/us-bibliographic-data-grant"


@query(f"""
WITH p AS (
  SELECT unnest([
    ('/us-patent-grant', count(*)), ('{_TOP}', count(*)), ('{_TOP}/publication-reference', count(*)), ('{_TOP}/publication-reference/document-id', count(*)), ('{_TOP}/publication-reference/document-id/doc-number', count(*)),
    ('{_TOP}/parties/applicants/applicant/addressbook/last-name', {_FILLED.format('lastname')}), ('{_TOP}/parties/applicants/applicant/addressbook/first-name', {_FILLED.format('firstname')}),
    ('{_TOP}/parties/applicants/applicant/addressbook/address/city', {_FILLED.format('city')}), ('{_TOP}/parties/applicants/applicant/addressbook/address/country', {_FILLED.format('country')}),
    ('{_TOP}/parties/applicants/applicant/addressbook/address', {_FILLED.format("coalesce(city, '') || coalesce(country, '')")}),
    ('{_TOP}/parties', {_FILLED.format("concat(lastname, firstname, city, country)")}), ('{_TOP}/parties/applicants', {_FILLED.format("concat(lastname, firstname, city, country)")}),
    ('{_TOP}/parties/applicants/applicant', {_FILLED.format("concat(lastname, firstname, city, country)")}), ('{_TOP}/parties/applicants/applicant/addressbook', {_FILLED.format("concat(lastname, firstname, city, country)")})]) AS x FROM inventor)
SELECT x[1] AS path, x[2] AS n FROM p WHERE x[2] > 0""")
def src_tag_paths(spark: SparkSession, d: str) -> DataFrame:
    return markup.tag_paths(markup.xml_documents(_grant_files(spark, d)))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    row = F.concat(F.lit('<tr bgcolor="#ffcc00"><td>'), F.col("s_suppkey").cast("string"), F.lit('</td><td><a href="/s/'), F.col("s_suppkey").cast("string"), F.lit('">'), F.col("s_name"), F.lit("</a></td></tr><tr><td>other</td></tr>"))
    head = F.concat(F.lit("<html><b>Nation:</b> "), F.col("file").cast("string"), F.lit("<br><b>Remark</b> none <b>Unit:</b>USD<table>"))
    return _whole(t(spark, d, "supplier"), "s_nationkey", "s_suppkey", row, head, F.lit("</table></html>"))


@query("SELECT CAST(s_nationkey AS VARCHAR) AS file, CAST(s_suppkey AS VARCHAR) AS k, s_name AS name, '/s/' || s_suppkey AS link FROM supplier")
def src_html_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = markup.html_rows(_pages(spark, d), "text", "#FFCC00")
    return rows.select("file", F.get("cells", F.lit(0)).alias("k"), F.get("cells", F.lit(1)).alias("name"), "link")


@query("SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS file, CAST(s_nationkey AS VARCHAR) AS nation, 'USD' AS unit, 2 AS n FROM supplier")
def src_html_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d).select("file", markup.html_pairs(F.col("text")).alias("p"))
    return p.select("file", F.col("p")["Nation"].alias("nation"), F.col("p")["Unit"].alias("unit"), F.size("p").alias("n"))


@query("SELECT CAST(s_nationkey AS VARCHAR) AS file, '/s/' || s_suppkey AS url, s_name AS text FROM supplier")
def src_html_links(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select("file", F.inline(markup.html_links(F.col("text"))))


# ---- pipelines over sources


@query("""
SELECT n_nationkey AS geo_code, o_orderkey AS rec, 'Title ' || cell AS title, CAST(o_custkey * cell AS VARCHAR) AS estimate, CAST(o_orderkey % 7 AS VARCHAR) AS margin
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey, (VALUES (1), (2)) v(cell)""")
def survey_cells(spark: SparkSession, d: str) -> DataFrame:
    """Estimates and margins of a survey meet by record and cell, with their geography from fixed-width lines."""
    o = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    record = F.lpad(F.col("o_orderkey").cast("string"), 7, "0")
    made = lambda a, b: o.select(F.concat_ws(",", F.lit("2005"), F.lit("f"), F.lit("x"), F.lit("0001"), record, F.lit("000"), a.cast("string"), b.cast("string")).alias("line"))
    estimates, margins = census.cells(made(F.col("o_custkey"), F.col("o_custkey") * 2), "estimate", 12), census.cells(made(F.col("o_orderkey") % 7, F.col("o_orderkey") % 7), "margin", 12)
    geo = census.geography(o.select(F.concat(F.repeat(F.lit(" "), F.lit(13)), record, F.repeat(F.lit(" "), F.lit(5)), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.repeat(F.lit(" "), F.lit(150))).alias("line")))
    headers = spark.createDataFrame([("1", 1, "Title 1"), ("1", 2, "Title 2")], "seq string, cell int, path string")
    out = census.survey_cells(estimates, margins, headers, geo.withColumn("rec", F.col("LOGRECNO")).select("LOGRECNO", F.struct("geo", "rec").alias("geo")))
    return out.select(F.col("geo.geo")["s"].cast("long").alias("geo_code"), F.col("geo.rec").cast("long").alias("rec"), "title", "estimate", "margin")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS series_id, n_name AS nation_name, coalesce(v, '') AS series FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (
  SELECT o_custkey, string_agg(time || '=' || v, ';' ORDER BY time) AS v FROM (SELECT o_custkey, strftime(o_orderdate, '%Y') || 'XX' || strftime(o_orderdate, '%m') AS time, CAST(min(o_orderkey) AS VARCHAR) AS v FROM orders GROUP BY 1, 2) GROUP BY 1) ON c_custkey = o_custkey""")
def survey_series(spark: SparkSession, d: str) -> DataFrame:
    """A series file and a data file merged into one record for each series, with codes decoded."""
    series = t(spark, d, "customer").select(F.concat(F.col("c_custkey").cast("string"), F.lit("  ")).alias("series_id"), F.concat(F.lit(" "), F.col("c_nationkey").cast("string")).alias("nation_code"))
    nation = t(spark, d, "nation").select(F.concat(F.col("n_nationkey").cast("string"), F.lit(" ")).alias("nation_code"), F.col("n_name").alias("nation_name"))
    first = t(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").cast("string").alias("year"), F.concat(F.lit("M"), F.date_format("o_orderdate", "MM")).alias("period")).agg(F.min("o_orderkey").cast("string").alias("value"))
    got = surveys.survey_records(series, first.select(F.col("o_custkey").cast("string").alias("series_id"), "year", "period", "value"), {"nation": nation})
    return got.select("series_id", "nation_name", F.array_join(F.transform(F.map_entries("values"), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("series"))


@query("SELECT CAST(s_nationkey AS VARCHAR) AS seq, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) + 1 AS INTEGER) AS cell, 'Subject|Table|Total|' || s_name AS path FROM supplier UNION ALL SELECT DISTINCT CAST(s_nationkey AS VARCHAR), 1, 'Subject|Table||Total' FROM supplier")
def header_tree(spark: SparkSession, d: str) -> DataFrame:
    """Titles of survey columns by a table's subject, title and group."""
    s = t(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("seq"), (F.col("s_suppkey") + 10).alias("pos"), F.lit("9").alias("line"), F.concat("s_name", F.lit(".")).alias("title"))
    heads = s.select("seq").distinct().select("seq", F.inline(F.array(*(F.struct(F.lit(i).cast("long").alias("pos"), F.lit(a).alias("line"), F.lit(b).alias("title")) for i, (a, b) in enumerate([(" ", "Subject"), ("", "Table"), ("1", "Total:"), ("1.5", "a remark")])))))
    return W.header_paths(s.unionByName(heads), "title", "line", "pos", "seq")


@query("SELECT user_id, event_id, event_id > coalesce(max(CASE WHEN event_type = 'click' THEN event_id END) OVER (PARTITION BY user_id), -1) AS is_footer FROM events")
def footer_rows(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events").withColumn("width", F.when(F.col("event_type") == "click", 5).otherwise(1))
    return W.footer_rows(e, "width", 5, "event_id", ["user_id"]).select("user_id", "event_id", "is_footer")


@query("""WITH w AS (SELECT user_id, event_id, min(CASE WHEN event_type <> 'view' THEN event_id END) OVER (PARTITION BY user_id) AS a, max(CASE WHEN event_type <> 'view' THEN event_id END) OVER (PARTITION BY user_id) AS b FROM events) SELECT user_id, event_id FROM w WHERE event_id BETWEEN a AND b""")
def blank_edges(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events").withColumn("line", F.when(F.col("event_type") == "view", " ").otherwise(F.col("event_type")))
    return W.without_blank_edges(e, "line", "event_id", ["user_id"]).select("user_id", "event_id")


@query("SELECT loc_id, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, unnest(v) AS word FROM (SELECT loc_id, string_split(city, ' ') AS v FROM loc)")
def numbered_items(spark: SparkSession, d: str) -> DataFrame:
    return W.numbered(t(spark, d, "loc").select("loc_id", F.split("city", " ").alias("words")), "words", "pos", "word")


@query("SELECT p_partkey, CAST(CASE WHEN p_size % 3 = 0 THEN 0 WHEN p_size % 3 = 1 THEN 1 ELSE 2 END AS INTEGER) AS deepest, p_brand AS Level_0, CASE WHEN p_size % 3 > 0 THEN p_type ELSE '' END AS Level_1, CASE WHEN p_size % 3 > 1 THEN p_name ELSE '' END AS Level_2 FROM part")
def outline_levels(spark: SparkSession, d: str) -> DataFrame:
    """A path as columns of levels, and the deepest that isn't empty."""
    p = t(spark, d, "part").withColumn("path", F.slice(F.array("p_brand", "p_type", "p_name"), F.lit(1), (F.col("p_size") % 3 + 1).cast("int")))
    p = p.select("p_partkey", *W.level_columns(F.col("path"), 3))
    return p.select("*", W.deepest_level([F.col(f"Level_{i}") for i in range(3)]).alias("deepest"))


@query("SELECT user_id, min(CASE WHEN event_type = 'click' THEN event_id END) AS click, min(CASE WHEN event_type = 'purchase' THEN event_id END) AS purchase FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1")
def key_value_columns(spark: SparkSession, d: str) -> DataFrame:
    return R.attributes_to_columns(t(spark, d, "events"), "user_id", "event_type", "event_id", ["click", "purchase"])


@query("SELECT o_custkey, CAST(count(*) * 2 AS INTEGER) AS n, CAST(2 * sum(o_orderkey) AS BIGINT) AS total FROM orders GROUP BY 1")
def flattened_lists(spark: SparkSession, d: str) -> DataFrame:
    g = t(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.array(F.array("o_orderkey", "o_orderkey"))).alias("x"))
    flat = R.flatten_all(F.col("x"), 2)
    return g.select("o_custkey", F.size(flat).alias("n"), F.aggregate(flat, F.lit(0).cast("long"), lambda a, b: a + b).alias("total"))


@query("SELECT s_suppkey, 1 + (CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END) AS n, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS s FROM supplier")
def named_levels(spark: SparkSession, d: str) -> DataFrame:
    path = F.when(F.col("s_suppkey") % 2 == 0, F.array(F.lit("US"), "s_name")).otherwise(F.array(F.lit("US")))
    m = R.level_map(["D", "s"], path)
    return t(spark, d, "supplier").select("s_suppkey", F.size(m).alias("n"), F.try_element_at(m, F.lit("s")).alias("s"))


# ---- sinks


@query("SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def sink_append(spark: SparkSession, d: str) -> DataFrame:
    """Delimited rows appended to a file set in two steps."""
    home, rows = scratch(spark), t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    T.append_delimited(rows.where("l_returnflag = 'R'"), home)
    T.append_delimited(rows.where("l_returnflag <> 'R'"), home)
    return spark.read.csv(home, sep="\t", header=True, schema=rows.schema)


@query("SELECT loc_id, zipcode FROM loc")
def sink_ascii_csv(spark: SparkSession, d: str) -> DataFrame:
    home = scratch(spark)
    T.write_ascii_csv(t(spark, d, "loc").select("loc_id", F.concat(F.lit("="), "zipcode").alias("zipcode")), home)
    return spark.read.csv(home, header=True, schema="loc_id long, zipcode string").select("loc_id", F.substr("zipcode", F.lit(2)).alias("zipcode"))


@query("SELECT 'data' AS part, CAST(p_partkey AS VARCHAR) AS k, p_name AS v FROM part UNION ALL SELECT 'metadata', 'rows', CAST(count(*) AS VARCHAR) FROM part UNION ALL SELECT 'metadata', 'title', 'Parts'")
def sink_with_metadata(spark: SparkSession, d: str) -> DataFrame:
    home, part = scratch(spark), t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("k"), F.col("p_name").alias("v"))
    T.write_with_metadata(part, home, {"title": "Parts", "rows": str(part.count())})
    return spark.read.parquet(f"{home}/data").select(F.lit("data").alias("part"), "k", "v").union(spark.read.parquet(f"{home}/metadata").select(F.lit("metadata"), "key", "value"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END AS status, CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 3 END AS n FROM orders")
def sink_documents(spark: SparkSession, d: str) -> DataFrame:
    """One JSON document for each row, without attributes that are null or empty."""
    home = scratch(spark)
    o = t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus")).alias("status"), F.lit("x").alias("kind"))
    T.write_documents(o, home)
    lines = spark.read.text(home)
    doc = F.from_json("value", "o_orderkey long, status string, kind string")
    return lines.select(doc["o_orderkey"].alias("o_orderkey"), doc["status"].alias("status"), F.json_object_keys("value").alias("ks")).select("o_orderkey", "status", F.size("ks").alias("n"))


# ---- columns and small rules


@query("SELECT o_orderkey AS \"key\", o_totalprice AS \"1995XXX\", CASE WHEN o_orderstatus = 'P' THEN '-' ELSE o_orderpriority END AS priority FROM orders")
def renamed_and_masked(spark: SparkSession, d: str) -> DataFrame:
    """Columns renamed in bulk by a rule, and a value overwritten where a mask holds."""
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("1995"), F.col("o_orderpriority").alias("priority"), "o_orderstatus")
    out = T.rename_columns(o, lambda c: f"{c}XXX" if c.isdigit() else c)
    return T.overwrite_where(out, "priority", F.col("o_orderstatus") == "P", "-").drop("o_orderstatus")


@query("""
WITH f AS (SELECT doc_id, p_mfgr_, 'x.data.' || (doc_id % 4) || CASE WHEN doc_id % 3 = 0 THEN '.Current' WHEN doc_id % 5 = 0 THEN '.AllData' ELSE '.Part' END AS name FROM (SELECT doc_id, doc_id % 11 AS p_mfgr_ FROM documents)),
k AS (SELECT *, bool_or(contains(name, 'AllData')) OVER (PARTITION BY p_mfgr_) AS whole FROM f WHERE NOT list_contains(string_split(name, '.'), 'Current'))
SELECT p_mfgr_ AS folder, name, doc_id FROM k WHERE NOT whole OR contains(name, 'AllData') OR NOT contains(name, '.data.')""")
def chosen_files(spark: SparkSession, d: str) -> DataFrame:
    """File names without the token `Current`; where a folder has one with all data, only that and those that hold no data."""
    i = F.col("doc_id")
    name = F.concat(F.lit("x.data."), (i % 4).cast("string"), F.when(i % 3 == 0, ".Current").when(i % 5 == 0, ".AllData").otherwise(".Part"))
    return T.choose_files(t(spark, d, "documents").select((i % 11).alias("folder"), name.alias("name"), "doc_id"), "name", "folder")


@query("SELECT p_partkey, CAST(p_partkey AS VARCHAR) || '/' || p_name AS both FROM part")
def column_stack(spark: SparkSession, d: str) -> DataFrame:
    """Columns computed apart for the same rows, side by side."""
    p = t(spark, d, "part").select("p_partkey", "p_name")
    return T.stack_columns(p, {"key": F.col("p_partkey").cast("string"), "label": F.col("p_name")}).select("p_partkey", F.concat_ws("/", "key", "label").alias("both"))


@query("SELECT rid, CASE WHEN cit_date IS NOT NULL THEN CAST(cit_date AS VARCHAR) ELSE CAST(citseq AS VARCHAR) END AS code, CASE WHEN cit_date IS NOT NULL THEN 'SIC' ELSE 'NAICS' END AS kind FROM citation")
def industry_codes(spark: SparkSession, d: str) -> DataFrame:
    code = environment.industry_code(F.col("cit_date").cast("string"), F.col("citseq").cast("string"))
    return t(spark, d, "citation").select("rid", code["code"].alias("code"), code["type"].alias("kind"))


@query("""
WITH l AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'Canada' WHEN 1 THEN 'Other places' ELSE 'Europe' END AS a, CASE WHEN s_suppkey % 3 = 0 THEN 'Other' ELSE n_name END AS b, CASE WHEN s_suppkey % 5 = 0 THEN 'Other' WHEN s_suppkey % 5 = 1 THEN '' ELSE 'x' END AS c, s_name AS d FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, CASE WHEN a LIKE 'Other%' THEN a END AS region, CASE WHEN a LIKE 'Other%' THEN b WHEN a = 'Canada' THEN 'North America' ELSE a END AS country,
  nullif(CASE WHEN a = 'Canada' THEN a WHEN a LIKE 'Other%' THEN CASE WHEN c = 'Other' THEN d ELSE c END WHEN b = 'Other' AND c <> '' THEN c ELSE b END, '') AS part,
  CASE WHEN a LIKE 'Other%' THEN CASE WHEN c = 'Other' THEN 'true' END WHEN b = 'Other' AND c <> '' THEN 'true' END AS other FROM l""")
def investment_places(spark: SparkSession, d: str) -> DataFrame:
    """Places of investment tables from the levels of their outline."""
    k, n = F.col("s_suppkey"), t(spark, d, "nation")
    s = t(spark, d, "supplier").join(n, F.col("s_nationkey") == n.n_nationkey)
    a = F.when(k % 4 == 0, "Canada").when(k % 4 == 1, "Other places").otherwise("Europe")
    levels = F.array(a, F.when(k % 3 == 0, "Other").otherwise(F.col("n_name")), F.when(k % 5 == 0, "Other").when(k % 5 == 1, "").otherwise("x"), F.col("s_name"))
    m = accounts.investment_place(levels)
    at = lambda x: F.try_element_at(m, F.lit(x))
    return s.select("s_suppkey", at("R").alias("region"), at("C").alias("country"), at("c").alias("part"), at("other").alias("other"))
