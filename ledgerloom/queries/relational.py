"""Queries of the relational operators: joins, aggregates, order, reshaping, keyed writes. Each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators import aggregate as A
from ledgerloom.operators import joins as J
from ledgerloom.operators import ordered as W
from ledgerloom.operators import reshape as R
from ledgerloom.operators import tables as T
from ledgerloom.operators.metadata import Dataset, merge_metadata
from ledgerloom.queries.common import table as t

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


# ---- joins


@query("""SELECT o.o_orderkey, o.o_custkey, c.c_name, coalesce(c.c_mktsegment, NULL) AS segment FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def update_join(spark: SparkSession, d: str) -> DataFrame:
    orders = t(spark, d, "orders").select("o_orderkey", "o_custkey").withColumn("c_name", F.lit(None).cast("string"))
    return J.update_join(orders, t(spark, d, "customer"), {"o_custkey": "c_custkey"}, {"c_name": "c_name", "segment": "c_mktsegment"})


@query("""
WITH i AS (SELECT rid, patent, invseq, city FROM inventor),
a AS (SELECT patent, min(city) AS v FROM assignee WHERE patent IS NOT NULL GROUP BY patent),
b AS (SELECT patent, asgseq, min(city) AS v FROM assignee WHERE patent IS NOT NULL AND asgseq IS NOT NULL GROUP BY patent, asgseq)
SELECT i.rid, CASE WHEN b.patent IS NOT NULL THEN b.v WHEN a.patent IS NOT NULL THEN a.v ELSE i.city END AS city
FROM i LEFT JOIN a ON i.patent = a.patent LEFT JOIN b ON i.patent = b.patent AND i.invseq = b.asgseq""")
def update_join_cascade(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "assignee")
    i = t(spark, d, "inventor").select("rid", "patent", "invseq", "city")
    steps = [(a, {"patent": "patent"}, {"city": "city"}), (a, {"patent": "patent", "invseq": "asgseq"}, {"city": "city"})]
    return J.update_join_cascade(i, steps).select("rid", "city")


@query("""
WITH p AS (SELECT patent, gyear, appyear, row_number() OVER (PARTITION BY patent ORDER BY loaded_at DESC, rid DESC) AS k FROM patent WHERE deleted_at IS NULL),
a AS (SELECT patent, assignee, row_number() OVER (PARTITION BY patent ORDER BY asgseq, rid) AS k FROM assignee WHERE patent IS NOT NULL),
c AS (SELECT patent, class, row_number() OVER (PARTITION BY patent ORDER BY prim DESC, rid) AS k FROM patclass WHERE patent IS NOT NULL)
SELECT i.rid, i.patent || '-' || i.invseq AS invnum, p.gyear, p.appyear, a.assignee, c.class
FROM inventor i LEFT JOIN p ON i.patent = p.patent AND p.k = 1 LEFT JOIN a ON i.patent = a.patent AND a.k = 1 LEFT JOIN c ON i.patent = c.patent AND c.k = 1""")
def star_denorm(spark: SparkSession, d: str) -> DataFrame:
    i = t(spark, d, "inventor").select("rid", "patent", F.concat("patent", F.lit("-"), "invseq").alias("invnum"))
    key = {"patent": "patent"}
    i = J.update_join(i, t(spark, d, "patent").where("deleted_at IS NULL"), key, {"gyear": "gyear", "appyear": "appyear"}, [F.desc("loaded_at"), F.desc("rid")])
    i = J.update_join(i, t(spark, d, "assignee"), key, {"assignee": "assignee"}, [F.asc_nulls_last("asgseq"), F.asc("rid")])
    i = J.update_join(i, t(spark, d, "patclass"), key, {"class": "class"}, [F.desc_nulls_last("prim"), F.asc("rid")])
    return i.drop("patent")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def anti_join(spark: SparkSession, d: str) -> DataFrame:
    return J.not_yet_in(t(spark, d, "customer").select("c_custkey", "c_name"), t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT a.p_partkey AS id_a, b.p_partkey AS id_b FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_type = b.p_type AND a.p_partkey > b.p_partkey")
def self_pairs(spark: SparkSession, d: str) -> DataFrame:
    return J.key_pairs(t(spark, d, "part").withColumn("k", F.struct("p_brand", "p_size", "p_type")), "k", "p_partkey")


@query("SELECT s.s_suppkey, s.s_name, n.n_name, n.n_regionkey, r.r_name FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey")
def dim_decode_left(spark: SparkSession, d: str) -> DataFrame:
    s = J.decode(t(spark, d, "supplier"), t(spark, d, "nation"), "s_nationkey", "n_nationkey")
    return J.decode(s, t(spark, d, "region"), "n_regionkey", "r_regionkey").select("s_suppkey", "s_name", "n_name", "n_regionkey", "r_name")


@query("SELECT trim(country) AS code, count(*) AS n_rows FROM loc WHERE trim(country) IS NULL OR trim(country) NOT IN (SELECT country FROM placeref) GROUP BY 1")
def decode_misses(spark: SparkSession, d: str) -> DataFrame:
    return J.decode_misses(t(spark, d, "loc"), t(spark, d, "placeref"), "country", "country")


@query("""SELECT rid, CASE WHEN kind = 'B1' THEN 'granted, not published before' WHEN regexp_matches(kind, '^B[1-9]$') THEN 'granted' WHEN regexp_matches(kind, '^S[1-9]?$') THEN 'design' WHEN regexp_matches(kind, '^E[1-9]?$') THEN 'reissue' END AS meaning FROM patent""")
def pattern_decode(spark: SparkSession, d: str) -> DataFrame:
    kinds = J.decode_pattern(F.col("kind"), {"B1": "granted, not published before"}, {"^B[1-9]$": "granted", "^S[1-9]?$": "design", "^E[1-9]?$": "reissue"})
    return t(spark, d, "patent").select("rid", kinds.alias("meaning"))


@query("""
WITH k AS (SELECT assignee, min(asgnum) AS n FROM grp WHERE cnt > 1 GROUP BY assignee)
SELECT a.rid, coalesce(CAST(k.n AS VARCHAR), '') AS cluster FROM assignee a LEFT JOIN k ON a.assignee = k.assignee""")
def set_key(spark: SparkSession, d: str) -> DataFrame:
    known = t(spark, d, "grp").where("cnt > 1").groupBy("assignee").agg(F.min("asgnum").cast("string").alias("n"))
    return J.set_key(t(spark, d, "assignee"), known, "assignee", "n", "cluster").select("rid", "cluster")


@query("""SELECT l.loc_id, coalesce(p.v, l.zipcode) AS zipcode FROM loc l LEFT JOIN (SELECT city, min(zipcode) AS v FROM placeref GROUP BY city) p ON l.city = p.city""")
def override_join(spark: SparkSession, d: str) -> DataFrame:
    return J.override(t(spark, d, "loc").select("loc_id", "city", "zipcode"), t(spark, d, "placeref").select("city", "zipcode"), "city", "zipcode").drop("city")


@query(r"""SELECT l.loc_id, p.place_id FROM (SELECT *, TRY_CAST(regexp_replace(split_part(replace(zipcode, '|', ','), ',', 1), '\s', '', 'g') AS INTEGER) AS z FROM loc) l JOIN placeref p ON l.z = TRY_CAST(p.zipcode AS INTEGER)""")
def zip_join(spark: SparkSession, d: str) -> DataFrame:
    ref = t(spark, d, "placeref").select("place_id", F.col("zipcode").alias("ref_zip"))
    return J.by_number(t(spark, d, "loc"), ref, "zipcode", "ref_zip").select("loc_id", "place_id")


@query("""
SELECT o_orderkey AS k, max(a) AS total, max(b) AS lines, max(c) AS latest FROM (
  SELECT o_orderkey, o_totalprice AS a, NULL AS b, NULL AS c FROM orders
  UNION ALL SELECT l_orderkey, NULL, count(*), NULL FROM lineitem GROUP BY l_orderkey
  UNION ALL SELECT l_orderkey, NULL, NULL, max(l_linenumber) FROM lineitem GROUP BY l_orderkey) GROUP BY o_orderkey""")
def disjoint_join(spark: SparkSession, d: str) -> DataFrame:
    lines = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k"))
    tables = [t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("total")), lines.agg(F.count(F.lit(1)).alias("lines")), lines.agg(F.max("l_linenumber").alias("latest"))]
    return J.join_disjoint(tables, ["k"])


@query("SELECT l_orderkey, l_linenumber, p_name, s_name FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey")
def multi_key_join(spark: SparkSession, d: str) -> DataFrame:
    part = t(spark, d, "part").withColumnRenamed("p_partkey", "l_partkey")
    supplier = t(spark, d, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    return J.join_on([t(spark, d, "lineitem"), part, supplier], [["l_partkey"], ["l_suppkey"]]).select("l_orderkey", "l_linenumber", "p_name", "s_name")


# ---- graph


@query("""
WITH i AS (SELECT DISTINCT invnum_n AS vx, patent AS ed, gyear AS y FROM invpat WHERE invnum_n IS NOT NULL)
SELECT a.vx AS v1, b.vx AS v2, count(*) AS weight, min(a.y) AS first_year FROM i a JOIN i b ON a.ed = b.ed AND a.vx < b.vx GROUP BY 1, 2""")
def cooccurrence_edges(spark: SparkSession, d: str) -> DataFrame:
    from ledgerloom.operators.graph import cooccurrence

    return cooccurrence(t(spark, d, "invpat"), "invnum_n", "patent", "gyear")[1]


@query("SELECT invnum_n AS vertex, count(DISTINCT patent) AS n FROM invpat WHERE invnum_n IS NOT NULL GROUP BY 1")
def cooccurrence_vertices(spark: SparkSession, d: str) -> DataFrame:
    from ledgerloom.operators.graph import cooccurrence

    return cooccurrence(t(spark, d, "invpat"), "invnum_n", "patent", "gyear")[0]


# ---- aggregates


@query("SELECT cit_country AS country, count(*) AS n, min(cit_date) AS first_date, CAST(sum(citseq) AS BIGINT) AS seqs FROM citation GROUP BY 1 HAVING count(*) > 20")
def group_having(spark: SparkSession, d: str) -> DataFrame:
    g = t(spark, d, "citation").groupBy(F.col("cit_country").alias("country"))
    return g.agg(F.count(F.lit(1)).alias("n"), F.min("cit_date").alias("first_date"), F.sum("citseq").alias("seqs")).where("n > 20")


@query("""SELECT place, CAST(sum(n) AS BIGINT) AS n FROM (SELECT upper(trim(city)) AS place, country, count(*) AS n FROM inventor GROUP BY city, country) GROUP BY place""")
def two_level_agg(spark: SparkSession, d: str) -> DataFrame:
    first = t(spark, d, "inventor").groupBy("city", "country").agg(F.count(F.lit(1)).alias("n"))
    return first.groupBy(F.upper(F.trim("city")).alias("place")).agg(F.sum("n").alias("n"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS k FROM orders) WHERE k = 1""")
def argmax_per_group(spark: SparkSession, d: str) -> DataFrame:
    return A.argmax(t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice", ["o_orderkey"])


@query("SELECT o_custkey, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS first_status FROM orders GROUP BY 1")
def first_per_group(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").groupBy("o_custkey").agg(A.first_by("o_orderstatus", "o_orderdate", "o_orderkey").alias("first_status"))


@query("SELECT o_custkey, string_agg(o_orderstatus, '|' ORDER BY o_orderkey) AS states FROM orders GROUP BY 1")
def concat_agg(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").groupBy("o_custkey").agg(A.joined("o_orderstatus", "o_orderkey").alias("states"))


@query("SELECT s_nationkey, string_agg(s_suppkey || ': ' || s_name, chr(10) ORDER BY s_suppkey) AS lines FROM supplier GROUP BY 1")
def labelled_lines(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "supplier").groupBy("s_nationkey").agg(A.labelled("s_suppkey", "s_name", "s_suppkey").alias("lines"))


@query("""SELECT patent, count(*) AS n, string_agg(invseq || ':' || coalesce(lastname, ''), ';' ORDER BY invseq, rid) AS digest FROM inventor WHERE patent IS NOT NULL AND invseq IS NOT NULL GROUP BY 1""")
def nested_collect(spark: SparkSession, d: str) -> DataFrame:
    g = t(spark, d, "inventor").where("patent IS NOT NULL AND invseq IS NOT NULL").groupBy("patent").agg(A.nested("invseq", "rid", "lastname").alias("people"))
    digest = F.array_join(F.transform("people", lambda p: F.concat(p["invseq"], F.lit(":"), F.coalesce(p["lastname"], F.lit("")))), ";")
    return g.select("patent", F.size("people").cast("long").alias("n"), digest.alias("digest"))


@query("SELECT user_id, CASE WHEN count(DISTINCT upper(event_type)) > 1 THEN string_agg(DISTINCT upper(event_type), '|' ORDER BY upper(event_type)) ELSE '' END AS types FROM events GROUP BY 1")
def uq_values(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").groupBy("user_id").agg(A.several("event_type").alias("types"))


@query("""SELECT user_id, string_agg(event_type, ',' ORDER BY k) AS types FROM (SELECT user_id, event_type, min((ts, event_id)) AS k FROM events GROUP BY 1, 2) GROUP BY 1""")
def ordered_distinct(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events").withColumn("k", F.struct("ts", "event_id"))
    return e.groupBy("user_id").agg(F.array_join(A.distinct_in_order("event_type", "k"), ",").alias("types"))


@query("SELECT p_brand, count(*) AS count FROM part GROUP BY 1")
def frequency_table(spark: SparkSession, d: str) -> DataFrame:
    return A.frequency(t(spark, d, "part"), "p_brand")


_TOKENS = "SELECT word, count(*) AS count, CAST(sum(w) AS BIGINT) AS countf FROM (SELECT unnest(string_split(assignee, ' ')) AS word, cnt AS w FROM grp WHERE assignee IS NOT NULL) GROUP BY 1"


@query(_TOKENS)
def token_freq(spark: SparkSession, d: str) -> DataFrame:
    return A.token_frequency(t(spark, d, "grp"), "assignee", "cnt")


@query(f"WITH f AS ({_TOKENS}) SELECT word, count FROM f WHERE count > (SELECT avg(count) + 3 * stddev_pop(count) FROM f)")
def outlier_tokens(spark: SparkSession, d: str) -> DataFrame:
    return A.outliers(A.token_frequency(t(spark, d, "grp"), "assignee", "cnt"), "count").select("word", "count")


@query("SELECT rid, CASE WHEN gyear IS NULL OR appyear IS NULL THEN NULL ELSE greatest(gyear, appyear) END AS latest FROM patent")
def rowwise_max(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "patent").select("rid", A.greatest_or_null(F.col("gyear"), F.col("appyear")).alias("latest"))


@query("SELECT max(length(regexp_replace(city, '[^,|]', '', 'g'))) AS most FROM loc")
def max_separators(spark: SparkSession, d: str) -> DataFrame:
    from ledgerloom.functions.text import count_separators

    return t(spark, d, "loc").agg(F.max(count_separators(F.col("city"))).cast("long").alias("most"))


@query("""
WITH m AS (SELECT r_name AS tab, 'rows' AS k, CAST(count(*) AS VARCHAR) AS v FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1 UNION ALL SELECT r_name, 'kind', 'region' FROM region UNION ALL SELECT r_name, 'name', r_name FROM region),
c AS (SELECT k, min(v) AS v FROM m GROUP BY k HAVING count(DISTINCT tab) = (SELECT count(DISTINCT tab) FROM m) AND min(v) = max(v))
SELECT tab, k, v FROM m WHERE k NOT IN (SELECT k FROM c) UNION ALL SELECT '', k, v FROM c""")
def metadata_factor(spark: SparkSession, d: str) -> DataFrame:
    r, n = t(spark, d, "region"), t(spark, d, "nation")
    sizes = n.join(r, n.n_regionkey == r.r_regionkey).groupBy(F.col("r_name").alias("tab")).agg(F.count(F.lit(1)).cast("string").alias("v")).select("tab", F.lit("rows").alias("k"), "v")
    meta = sizes.union(r.select("r_name", F.lit("kind"), F.lit("region"))).union(r.select("r_name", F.lit("name"), "r_name"))
    return A.factor_metadata(meta, "tab", "k", "v")


@query("SELECT l_returnflag, l_linestatus, CAST(2 - grouping(l_returnflag) - grouping(l_linestatus) AS INTEGER) AS depth, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def slice_prefixes(spark: SparkSession, d: str) -> DataFrame:
    return A.by_depth(t(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


# ---- order


@query("""
WITH e AS (SELECT event_id, user_id, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS v FROM events),
f AS (SELECT event_id, user_id, last_value(nullif(v, '') IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS v FROM e)
SELECT event_id, user_id, v FROM f WHERE v IS NOT NULL""")
def fill_down(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events").select("event_id", "user_id", F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("v"))
    return W.fill_down(e, "v", "event_id", ["user_id"])


@query("""
SELECT event_id, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM (
  SELECT event_id, user_id, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))""")
def change_runs(spark: SparkSession, d: str) -> DataFrame:
    return W.change_runs(t(spark, d, "events"), "event_type", "event_id", ["user_id"]).select("event_id", "run")


_OUTLINE = """
WITH o AS (
  SELECT r_regionkey * 1000000000000000 AS pos, r_regionkey AS region, 0 AS indent, r_name AS label FROM region
  UNION ALL SELECT n_regionkey * 1000000000000000 + (n_nationkey + 1) * 1000000000000, n_regionkey, 4, n_name FROM nation
  UNION ALL SELECT n_regionkey * 1000000000000000 + (n_nationkey + 1) * 1000000000000 + 1 + s_suppkey, n_regionkey, 8, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


@query(_OUTLINE + """,
l AS (SELECT *, last_value(CASE WHEN indent = 0 THEN label END IGNORE NULLS) OVER w AS l0, last_value(CASE WHEN indent = 4 THEN label END IGNORE NULLS) OVER w AS l1 FROM o WINDOW w AS (PARTITION BY region ORDER BY pos ROWS UNBOUNDED PRECEDING))
SELECT CAST(pos AS BIGINT) AS pos, CAST(indent // 4 AS INTEGER) AS level, CASE indent WHEN 0 THEN l0 WHEN 4 THEN l0 || '|' || l1 ELSE l0 || '|' || l1 || '|' || label END AS path FROM l""")
def indent_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    """Regions, their nations and these' suppliers as an outline, a text for each region."""
    r, n, s = t(spark, d, "region"), t(spark, d, "nation"), t(spark, d, "supplier")
    at = F.col("n_regionkey").cast("long") * 10**15 + (F.col("n_nationkey") + 1).cast("long") * 10**12
    lines = (
        r.select((F.col("r_regionkey").cast("long") * 10**15).alias("pos"), F.col("r_regionkey").alias("region"), F.col("r_name").alias("text"))
        .union(n.select(at, "n_regionkey", F.concat(F.lit("    "), "n_name")))
        .union(s.join(n, s.s_nationkey == n.n_nationkey).select(at + 1 + F.col("s_suppkey"), "n_regionkey", F.concat(F.lit("        "), "s_name")))
    )
    lines = lines.withColumn("indent", W.indent_of(F.col("text"))).withColumn("text", F.trim("text"))
    return W.hierarchy(lines, "text", "indent", "pos", 3, ["region"]).select("pos", F.col("level").cast("int").alias("level"), F.array_join("path", "|").alias("path"))


@query("""
WITH a AS (SELECT p_partkey, p_name, p_type, p_brand, CASE WHEN count(*) OVER (PARTITION BY p_name) > 1 AND p_type <> '' THEN p_name || ' - ' || p_type ELSE p_name END AS label FROM part)
SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY label) > 1 AND p_brand <> '' THEN label || ' - ' || p_brand ELSE label END AS label FROM a""")
def disambiguate_labels(spark: SparkSession, d: str) -> DataFrame:
    return W.unique_labels(t(spark, d, "part"), ["p_brand", "p_type", "p_name"], "label").select("p_partkey", "label")


@query("SELECT c_mktsegment, rank, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) WHERE rank <= 5")
def topk_per_group(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("c_mktsegment").orderBy(F.desc("c_acctbal"), "c_custkey")
    return t(spark, d, "customer").select("c_mktsegment", F.row_number().over(w).alias("rank"), "c_custkey", "c_acctbal").where("rank <= 5")


@query("""
WITH g AS (SELECT p_brand, sum(p_size) AS total FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5), r AS (SELECT *, row_number() OVER (ORDER BY total DESC, p_brand) AS rank FROM g)
SELECT CAST(rank AS INTEGER) AS rank, p_brand, CAST(total AS BIGINT) AS total, p_partkey, p_size FROM r JOIN part USING (p_brand)""")
def top_groups_members(spark: SparkSession, d: str) -> DataFrame:
    return T.top_with_members(t(spark, d, "part"), "p_brand", "p_partkey", "p_size", 5)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sorted_table(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


# ---- reshape


@query("SELECT l_orderkey, l_linenumber, l_partkey, name, value FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax FROM lineitem) UNPIVOT (value FOR name IN (l_quantity, l_discount, l_tax))")
def unpivot_measures(spark: SparkSession, d: str) -> DataFrame:
    return R.to_long(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_discount", "l_tax"], keep_nulls=False)


@query("SELECT user_id, min(CASE WHEN event_type = 'click' THEN value END) AS click, min(CASE WHEN event_type = 'view' THEN value END) AS view, min(CASE WHEN event_type = 'purchase' THEN value END) AS purchase FROM events GROUP BY 1")
def pivot_series(spark: SparkSession, d: str) -> DataFrame:
    return R.to_wide(t(spark, d, "events"), ["user_id"], "event_type", "value", ["click", "view", "purchase"])


@query("""SELECT user_id, string_agg(event_type || '=' || v, ';' ORDER BY event_type) AS series FROM (SELECT user_id, event_type, min(event_id) AS v FROM events GROUP BY 1, 2) GROUP BY 1""")
def series_map(spark: SparkSession, d: str) -> DataFrame:
    m = R.series_map(t(spark, d, "events"), ["user_id"], "event_type", "event_id")
    return m.select("user_id", F.array_join(F.transform(F.map_entries("values"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";").alias("series"))


@query("""
SELECT o.o_orderkey, coalesce(n, 0) AS n_lines, coalesce(digest, '') AS digest FROM orders o LEFT JOIN (
  SELECT l_orderkey, count(*) AS n, string_agg(l_linenumber || ':' || l_partkey, ';' ORDER BY l_linenumber, l_partkey) AS digest FROM lineitem GROUP BY 1) l ON o.o_orderkey = l.l_orderkey""")
def doc_assembly(spark: SparkSession, d: str) -> DataFrame:
    lines = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    docs = R.attach_children(t(spark, d, "orders"), "o_orderkey", {"lines": (lines, "l_linenumber")})
    digest = F.array_join(F.transform("lines", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"))), ";")
    return docs.select("o_orderkey", F.size("lines").cast("long").alias("n_lines"), digest.alias("digest"))


@query("""SELECT loc_id, (CASE WHEN trim(city) <> '' THEN 1 ELSE 0 END) + (CASE WHEN trim(state) <> '' THEN 1 ELSE 0 END) + (CASE WHEN trim(country) <> '' THEN 1 ELSE 0 END) AS n_parts, CASE WHEN trim(state) <> '' THEN state END AS state FROM loc""")
def location_map(spark: SparkSession, d: str) -> DataFrame:
    m = R.struct_of(t(spark, d, "loc"), "place", {"c": "city", "s": "state", "C": "country"})
    return m.select("loc_id", F.size("place").alias("n_parts"), F.try_element_at("place", F.lit("s")).alias("state"))


@query("""
SELECT patent, citseq, kind, row_number() OVER (PARTITION BY patent, kind ORDER BY citseq, rid) - 1 AS seq FROM (
  SELECT patent, citseq, rid, CASE WHEN trim(cit_country) = '' OR cit_country IS NULL THEN 'other' ELSE 'patent' END AS kind FROM citation)""")
def split_citations(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "citation").withColumn("kind", F.when(F.coalesce(F.trim("cit_country"), F.lit("")) == "", "other").otherwise("patent"))
    seq = F.row_number().over(Window.partitionBy("patent", "kind").orderBy(F.asc_nulls_last("citseq"), "rid")) - 1
    return c.select("patent", "citseq", "kind", seq.cast("long").alias("seq"))


# ---- unions and keyed writes


def _first_loads(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Inventor rows of loads to the tenth, one for each key, and those of later loads."""
    i = t(spark, d, "inventor").select("rid", "patent", "invseq", "lastname", "loadfile").where("patent IS NOT NULL AND invseq IS NOT NULL")
    early = J.one_per_key(i.where("loadfile <= 'ipgb000002'"), ["patent", "invseq"], [F.col("rid")])
    return early, i.where("loadfile > 'ipgb000002'")


_KEYED = """
WITH i AS (SELECT rid, patent, invseq, lastname, loadfile FROM inventor WHERE patent IS NOT NULL AND invseq IS NOT NULL),
a AS (SELECT rid, patent, invseq, lastname, loadfile FROM (SELECT *, row_number() OVER (PARTITION BY patent, invseq ORDER BY rid) AS k FROM i WHERE loadfile <= 'ipgb000002') WHERE k = 1),
b AS (SELECT *, row_number() OVER (PARTITION BY patent, invseq ORDER BY {order}) AS k FROM i WHERE loadfile > 'ipgb000002')
"""


@query(_KEYED.format(order="rid") + "SELECT * FROM a UNION ALL SELECT b.* EXCLUDE (k) FROM b WHERE k = 1 AND NOT EXISTS (SELECT 1 FROM a WHERE a.patent = b.patent AND a.invseq = b.invseq)")
def insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    early, late = _first_loads(spark, d)
    return T.insert_ignore(early, late, ["patent", "invseq"], [F.col("rid")])


@query(_KEYED.format(order="rid DESC") + "SELECT b.* EXCLUDE (k) FROM b WHERE k = 1 UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.patent = b.patent AND a.invseq = b.invseq)")
def upsert_replace(spark: SparkSession, d: str) -> DataFrame:
    early, late = _first_loads(spark, d)
    return T.upsert(early, late, ["patent", "invseq"], [F.col("rid").desc()])


@query("SELECT city, state, country, zipcode FROM inventor UNION ALL SELECT city, state, country, zipcode FROM loc")
def common_columns(spark: SparkSession, d: str) -> DataFrame:
    return T.stack([t(spark, d, "inventor").drop("rid"), t(spark, d, "loc")], common_only=True).select("city", "state", "country", "zipcode")


@query("SELECT patent, gyear, kind FROM patent UNION ALL SELECT patent, gyear, NULL FROM backfile")
def stacked_tables(spark: SparkSession, d: str) -> DataFrame:
    return T.stack([t(spark, d, "patent").select("patent", "gyear", "kind"), t(spark, d, "backfile").select("patent", "gyear")])


_TYPE = """SELECT '{0}' AS "column", CASE WHEN coalesce(bool_and(CASE WHEN trim({0}) <> '' THEN regexp_matches(regexp_replace(trim({0}), '^-|,', '', 'g'), '^[0-9]+$') END), false) THEN 'INTEGER'
  WHEN coalesce(bool_and(CASE WHEN trim({0}) <> '' THEN regexp_matches(regexp_replace(trim({0}), '^-|,', '', 'g'), '^[0-9]*\\.?[0-9]*$') AND regexp_matches(trim({0}), '[0-9]') END), false) THEN 'REAL' ELSE 'VARCHAR' END AS type
FROM (SELECT CAST(rid AS VARCHAR) AS rid, cit_date::VARCHAR AS cit_date, citation, CAST(CAST(citseq AS DECIMAL(12, 2)) AS VARCHAR) AS amount FROM citation)"""


@query(" UNION ALL ".join(_TYPE.format(c) for c in ("rid", "cit_date", "citation", "amount")))
def infer_types(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "citation")
    return T.infer_types(c.select(F.col("rid").cast("string"), F.col("cit_date").cast("string"), "citation", F.col("citseq").cast("decimal(12,2)").cast("string").alias("amount")))


# ---- metadata


@query("SELECT patent, invseq, count(*) AS n_rows FROM inventor GROUP BY 1, 2 HAVING count(*) > 1")
def unique_violations(spark: SparkSession, d: str) -> DataFrame:
    return Dataset(["patent", "invseq"]).violations(t(spark, d, "inventor"))


@query("SELECT country, state, CAST(2 - grouping(country) - grouping(state) AS INTEGER) AS depth, count(*) AS n_rows FROM placeref GROUP BY ROLLUP (country, state)")
def slice_counts(spark: SparkSession, d: str) -> DataFrame:
    return Dataset(["place_id"], [["country", "state"]]).counts(t(spark, d, "placeref"))


@query("SELECT source, string_agg(DISTINCT lang, ', ' ORDER BY lang) AS lang FROM documents WHERE lang IS NOT NULL GROUP BY 1")
def merged_metadata(spark: SparkSession, d: str) -> DataFrame:
    return merge_metadata(t(spark, d, "documents").where("lang IS NOT NULL"), ["source"], "lang", "lang")
