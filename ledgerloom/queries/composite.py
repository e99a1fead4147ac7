"""Queries of the composite operators: cascaded matching, disambiguation, label propagation, event windows, incremental load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.countries import country_code, state_code
from ledgerloom.functions.text import clean_place
from ledgerloom.operators import entity as E
from ledgerloom.operators.graph import min_labels
from ledgerloom.queries.common import table as t
from ledgerloom.session import cut, scratch
from ledgerloom.streaming.ledger import event_windows, load_new_files, loaded


def geocode_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Typed places of loc against the reference list by stages; loc rows without a country look everywhere."""
    loc = t(spark, d, "loc").select(
        "loc_id",
        clean_place(F.col("city")).alias("city"),
        # a state typed as country is the state where that field names none
        F.coalesce(state_code(F.col("state")), state_code(F.col("country"))).alias("state"),
        country_code(F.col("country"), F.col("city")).alias("country"),
        F.trim("zipcode").alias("zipcode"),
        clean_place(F.col("ncity")).alias("ncity"),
        state_code(F.col("nstate")).alias("nstate"),
        country_code(F.col("ncountry"), F.col("ncity")).alias("ncountry"),
    )
    loc = cut(loc.where("city <> ''")).withColumn("id", F.xxhash64(*(F.coalesce(c, F.lit("\0")) for c in loc.columns[1:])))
    ref = t(spark, d, "placeref").select(F.col("place_id").alias("ref_id"), clean_place(F.col("city")).alias("r_city"), F.upper("state").alias("state"), F.upper("country").alias("country"), "zipcode")
    found = E.geocode(loc.drop("loc_id").distinct(), ref)
    return loc.join(found, "id").select("loc_id", "ref_id", "stage", F.round("score", 6).alias("score"), "candidates")


def disambiguate(spark: SparkSession, d: str) -> DataFrame:
    return E.disambiguate(t(spark, d, "grp").select(F.col("assignee").alias("name"), "cnt"))


def top_clusters(spark: SparkSession, d: str) -> DataFrame:
    return E.cluster_names(disambiguate(spark, d)).orderBy(F.desc("cnt"), "cluster").limit(20)


def label_propagation(spark: SparkSession, d: str) -> DataFrame:
    """Organisations linked by patents they share, directly or through others."""
    a = t(spark, d, "assignee").where("patent IS NOT NULL AND assignee <> ''")
    first = a.groupBy("patent").agg(F.min("assignee").alias("b"))
    return min_labels(a.join(first, "patent").where("assignee <> b").select(F.col("assignee").alias("a"), "b"))


def windows_per_hour(spark: SparkSession, d: str) -> DataFrame:
    """An extra: events per hour and type."""
    w = event_windows(t(spark, d, "events"), "ts", "1 hour", "1 hour", "event_type")
    return w.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def incremental_load(spark: SparkSession, d: str) -> DataFrame:
    """Inventor rows loaded from files through the ledger, each key once; a second run adds nothing."""
    home = scratch(spark)
    rows = t(spark, d, "inventor").where("patent IS NOT NULL AND invseq IS NOT NULL").select("rid", "patent", "invseq", "lastname")
    rows.write.parquet(f"{home}/in")
    for _ in range(2):
        load_new_files(spark, f"{home}/in", f"{home}/out", f"{home}/ledger", "rid long, patent string, invseq int, lastname string", ["patent", "invseq"], [F.col("rid")])
    return loaded(spark, f"{home}/out").select("rid", "patent", "invseq", "lastname")


QUERIES = {f.__name__: f for f in (geocode_cascade, disambiguate, top_clusters, label_propagation, windows_per_hour, incremental_load)}
SQL = {
    "label_propagation": """
WITH RECURSIVE a AS (SELECT patent, assignee, min(assignee) OVER (PARTITION BY patent) AS b FROM assignee WHERE patent IS NOT NULL AND assignee <> ''),
e AS (SELECT DISTINCT assignee AS u, b AS v FROM a WHERE assignee <> b UNION SELECT DISTINCT b, assignee FROM a WHERE assignee <> b),
r(id, label) USING KEY (id) AS (
  SELECT u, u FROM (SELECT DISTINCT u FROM e)
  UNION
  SELECT e.v, min(r.label) FROM r JOIN e ON e.u = r.id JOIN recurring.r AS now ON now.id = e.v WHERE r.label < now.label GROUP BY e.v)
SELECT id, label FROM r""",
    "windows_per_hour": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "incremental_load": "SELECT rid, patent, invseq, lastname FROM (SELECT *, row_number() OVER (PARTITION BY patent, invseq ORDER BY rid) AS k FROM inventor WHERE patent IS NOT NULL AND invseq IS NOT NULL) WHERE k = 1",
}
