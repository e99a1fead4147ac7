"""Queries of the general data problems: orphan references (p1), packed values (p4), heavy keys (p6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.patents import key_code, patent_key
from ledgerloom.operators.multivalue import explode_values
from ledgerloom.operators.orphans import ALWAYS, instants, orphan_report, orphan_rows
from ledgerloom.operators.skew import eager_join_aggregate
from ledgerloom.queries.common import table
from ledgerloom.session import cut


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    def refs(name: str, column: str, scope: str, df: DataFrame) -> DataFrame:
        df = df.where(F.trim(F.regexp_replace(column, r"[\s\p{Z}]+", " ")) != "")
        return df.select(F.lit(name).alias("src"), F.lit(scope).alias("scope"), "rid", patent_key(F.col(column)).alias("key"), instants(F.col("loaded_at")).alias("at"))

    citation = table(spark, d, "citation").where(F.upper(F.trim(F.regexp_replace("cit_country", r"[\s\p{Z}]+", " "))) == "US")
    all_refs = (
        refs("citation", "citation", "wide", citation)
        .unionByName(refs("inventor", "patent", "narrow", table(spark, d, "inventor")))
        .unionByName(refs("patclass", "patent", "narrow", table(spark, d, "patclass")))
        .withColumn("code", key_code(F.col("key")))
    )
    live = table(spark, d, "patent").where(F.col("deleted_at").isNull()).select(patent_key(F.col("patent")).alias("key"), instants(F.col("loaded_at")).alias("at"))
    parents = (
        live.select(F.lit("narrow").alias("scope"), "key", "at")
        .unionByName(live.select(F.lit("wide").alias("scope"), "key", "at"))
        .unionByName(table(spark, d, "backfile").select(F.lit("wide").alias("scope"), patent_key(F.col("patent")).alias("key"), F.lit(ALWAYS).alias("at")))
        .withColumn("code", key_code(F.col("key")))
    )
    return orphan_rows(all_refs, parents)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("src", "rid").distinct()


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(_orphans(spark, d))


_P1 = r"""
WITH n AS (
  SELECT 'citation' AS src, rid, citation AS v, loaded_at FROM citation WHERE upper(trim(regexp_replace(cit_country, '[\s\p{Z}]+', ' ', 'g'))) = 'US'
  UNION ALL SELECT 'inventor', rid, patent, loaded_at FROM inventor
  UNION ALL SELECT 'patclass', rid, patent, loaded_at FROM patclass),
p AS (
  SELECT patent AS v, loaded_at, 'patent' AS t FROM patent WHERE deleted_at IS NULL
  UNION ALL SELECT patent, TIMESTAMP '0001-01-01', 'backfile' FROM backfile),
pk AS (
  SELECT regexp_replace(regexp_replace(upper(v), '[\p{P}\p{S}\p{Z}\p{C}\s]+', '', 'g'), '^(?:US)?([A-Z]*)0*([0-9]+)(?:[A-Z][0-9]?)?$', '\1:\2') AS k, t, min(loaded_at) AS first_at
  FROM p GROUP BY ALL),
nk AS (
  SELECT src, rid, loaded_at, regexp_replace(regexp_replace(upper(v), '[\p{P}\p{S}\p{Z}\p{C}\s]+', '', 'g'), '^(?:US)?([A-Z]*)0*([0-9]+)(?:[A-Z][0-9]?)?$', '\1:\2') AS k
  FROM n WHERE trim(regexp_replace(v, '[\s\p{Z}]+', ' ', 'g')) <> ''),
orphan AS (
  SELECT src, rid, loaded_at FROM nk
  WHERE NOT (contains(k, ':') AND EXISTS (
    SELECT 1 FROM pk WHERE pk.k = nk.k AND (pk.t = 'patent' OR nk.src = 'citation') AND pk.first_at <= nk.loaded_at)))
"""


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return explode_values(table(spark, d, "loc"), "city", ["loc_id"], table(spark, d, "placeref"), "city", at_least=2)


def p4_all(spark: SparkSession, d: str) -> DataFrame:
    """Every value of every loc row, single ones included."""
    return explode_values(table(spark, d, "loc"), "city", ["loc_id"], table(spark, d, "placeref"), "city")


def _by_assignee(spark: SparkSession, d: str) -> DataFrame:
    """Totals per assignee string over assignee joined with inventor by patent."""
    a = table(spark, d, "assignee").select("assignee", patent_key(F.col("patent")).alias("key"), "asgseq")
    i = table(spark, d, "inventor").select(patent_key(F.col("patent")).alias("key"), F.when(F.col("invseq") == 0, 1).otherwise(0).alias("lead"))
    totals = eager_join_aggregate(a, i, "key", ["assignee"], right_sums={"lead_inventors": "lead"})
    return totals.select("assignee", F.col("left_rows").alias("n_rows"), F.col("left_keys").alias("n_patents"), F.col("pairs").alias("n_inventors"), "lead_inventors")


def p6_totals(spark: SparkSession, d: str) -> DataFrame:
    return _by_assignee(spark, d)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    totals = cut(_by_assignee(spark, d))
    rows = totals.agg(F.sum("n_rows")).first()[0] or 0
    blank = F.trim(F.regexp_replace("assignee", r"[\s\p{Z}]+", " ")) == ""
    return totals.where(~blank & (F.col("n_rows") * 50 >= rows)).select("assignee")


_KEY = r"CASE WHEN regexp_matches(regexp_replace(upper({0}), '[\p{{P}}\p{{S}}\p{{Z}}\p{{C}}\s]+', '', 'g'), '^(?:US)?([A-Z]*)0*([0-9]+)(?:[A-Z][0-9]?)?$') THEN regexp_replace(regexp_replace(upper({0}), '[\p{{P}}\p{{S}}\p{{Z}}\p{{C}}\s]+', '', 'g'), '^(?:US)?([A-Z]*)0*([0-9]+)(?:[A-Z][0-9]?)?$', '\1:\2') END"

QUERIES = {"p1_found": p1_found, "p1_report": p1_report, "p4_found": p4_found, "p4_all": p4_all, "p6_found": p6_found, "p6_totals": p6_totals}
SQL = {
    "p1_found": _P1 + "SELECT DISTINCT src, rid FROM orphan",
    "p1_report": _P1 + "SELECT src, CAST(year(loaded_at) AS INTEGER) AS year, count(*) AS orphans FROM orphan GROUP BY ALL",
    "p6_found": r"SELECT assignee FROM assignee WHERE trim(regexp_replace(assignee, '[\s\p{Z}]+', ' ', 'g')) <> '' GROUP BY assignee HAVING count(*) * 50 >= (SELECT count(*) FROM assignee)",
    "p6_totals": f"""
WITH a AS (SELECT row_number() OVER () AS id, assignee, {_KEY.format("patent")} AS key FROM assignee),
i AS (SELECT {_KEY.format("patent")} AS key, CASE WHEN invseq = 0 THEN 1 ELSE 0 END AS lead FROM inventor)
SELECT assignee, count(DISTINCT a.id) AS n_rows, count(DISTINCT a.key) AS n_patents, count(i.key) AS n_inventors, CAST(coalesce(sum(i.lead), 0) AS BIGINT) AS lead_inventors
FROM a LEFT JOIN i ON a.key = i.key GROUP BY assignee""",
}
