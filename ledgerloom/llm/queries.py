"""Queries of the llm problems and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components, groups
from ledgerloom.llm.mixing import mix_documents, shares
from ledgerloom.llm.names import resolve_names, spelling_pairs
from ledgerloom.llm.places import match_places
from ledgerloom.llm.spans import shared_share, shared_spans
from ledgerloom.llm.terms import mark_terms, normal_word, term_frequencies
from ledgerloom.llm.tokens import token_ids, token_text
from ledgerloom.operators.multivalue import with_values
from ledgerloom.queries.common import table
from ledgerloom.session import cut


def _single_places(spark: SparkSession, d: str) -> DataFrame:
    """loc rows whose city names one place, with the place each denotes."""
    ref = table(spark, d, "placeref")
    loc = table(spark, d, "loc").select("loc_id", "city", "state", "country", "zipcode").where(F.col("city").rlike(r"[^\s\p{Z}]"))
    one = with_values(loc, "city", "values", ref, "city").where(F.size("values") <= 1)
    one = one.withColumn("value", F.coalesce(F.get("values", F.lit(0)), F.lit("")))
    return match_places(one, ref, "value", "state", "country", "zipcode")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _single_places(spark, d).select("loc_id", "place_id")


def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Typed values that denote no place of the list, with the number of loc rows that have them."""
    return _single_places(spark, d).where("place_id = -1").groupBy("value", "state", "country").agg(F.count(F.lit(1)).alias("n_rows"))


def _entities(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "assignee").select(F.lit("assignee").alias("src"), F.col("assignee").alias("name"))
    i = table(spark, d, "inventor").select(F.lit("inventor").alias("src"), F.concat(F.coalesce("lastname", F.lit("")), F.lit("|"), F.coalesce("firstname", F.lit(""))).alias("name"))
    return resolve_names(a.unionByName(i))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return spelling_pairs(_entities(spark, d))


def p3_entities(spark: SparkSession, d: str) -> DataFrame:
    """Every spelling with the smallest spelling of its entity."""
    return _entities(spark, d).select("src", "name", F.min("name").over(Window.partitionBy("src", "entity")).alias("leader"))


def _id(name: str):
    """Ids are compared in upper case without surrounding blanks; a blank id is none."""
    x = F.regexp_replace(F.upper(name), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return F.when(x != "", x).alias(name)


def _components(spark: SparkSession, d: str) -> DataFrame:
    return connected_components(table(spark, d, "invpat").select(_id("invnum"), _id("invnum_n")), "invnum", "invnum_n")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return groups(_components(spark, d))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every id with its group and the group's size."""
    labels = _components(spark, d)
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    return labels.join(sizes, "label").select("id", F.col("label").alias("group_id"), "size")


def _words(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "wrd").select(normal_word(F.col("word")).alias("term"), "loadfile", "word", "count", "countf").where("term <> ''")
    return term_frequencies(words, "term", "loadfile", F.col("count"), F.col("countf"), item="word")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "assignee").where("assignee <> ''").count()
    marked = mark_terms(_words(spark, d), 2, F.col("weight") * 20 > named)
    return marked.select(F.col("term").alias("word"), F.explode("marks").alias("mark"))


def p7_words(spark: SparkSession, d: str) -> DataFrame:
    """Totals of every word over all loads: loads is the number of loads that hold it."""
    return _words(spark, d).select(F.col("term").alias("word"), F.col("occurrences").alias("count"), F.col("weight").alias("countf"), F.col("records").alias("loads"))


def p7_terms(spark: SparkSession, d: str) -> DataFrame:
    """Every term of the documents: occurrences, number of texts, and whether it is in one text or in more than a tenth of them."""
    docs = table(spark, d, "documents").where(F.col("text").isNotNull())
    terms = docs.select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).alias("term"))
    marked = mark_terms(term_frequencies(terms, "term", "doc_id"), 1, F.col("records") * 10 > docs.count())
    return marked.select("term", "occurrences", "records", F.array_join("marks", ",").alias("marks"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", token_ids(F.col("text")).alias("ids"))


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Round trip: whether the ids of each text spell it again."""
    docs = table(spark, d, "documents").select("doc_id", "text", token_ids(F.col("text")).alias("ids"))
    return docs.select("doc_id", F.size("ids").alias("n_ids"), (token_text(F.col("ids")) == F.coalesce("text", F.lit(""))).alias("same"))


def _mix(spark: SparkSession, d: str):
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return mix_documents(docs, table(spark, d, "mixtarget"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    mixed, plan, _ = _mix(spark, d)
    return shares(spark, mixed, plan)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans(table(spark, d, "documents").select("doc_id", "text"))


def p10_share(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return shared_share(docs, cut(shared_spans(docs)))


QUERIES = {"p2_found": p2_found, "p2_unmatched": p2_unmatched, "p3_found": p3_found, "p3_entities": p3_entities, "p8_ids": p8_ids, "p8_decoded": p8_decoded, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_share": p10_share, "p5_found": p5_found, "p5_groups": p5_groups, "p7_found": p7_found, "p7_words": p7_words, "p7_terms": p7_terms}

_EDGES = r"""
ids AS (SELECT nullif(regexp_replace(upper(invnum), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '') AS a, nullif(regexp_replace(upper(invnum_n), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '') AS b FROM invpat),
e AS (SELECT DISTINCT a AS u, b AS v FROM ids WHERE a <> b UNION SELECT DISTINCT b, a FROM ids WHERE a <> b),
n AS (SELECT a AS id FROM ids WHERE a IS NOT NULL UNION SELECT b FROM ids WHERE b IS NOT NULL),
r(id, label) USING KEY (id) AS (
  SELECT id, id AS label FROM n
  UNION
  SELECT e.v, min(r.label) FROM r JOIN e ON e.u = r.id JOIN recurring.r AS now ON now.id = e.v WHERE r.label < now.label GROUP BY e.v)
"""
_WORDS = r"""
w AS (SELECT loadfile, regexp_replace(upper(word), '[^\p{L}\p{N}]+', '', 'g') AS term, max(count) AS c, max(countf) AS f FROM wrd GROUP BY loadfile, word),
t AS (SELECT term, CAST(sum(c) AS BIGINT) AS c, CAST(sum(f) AS BIGINT) AS f, count(DISTINCT loadfile) AS loads FROM w WHERE term <> '' GROUP BY term)
"""
SQL = {
    "p5_found": "WITH RECURSIVE " + _EDGES + "SELECT label AS leader, id AS member FROM r WHERE id <> label",
    "p5_groups": "WITH RECURSIVE " + _EDGES + "SELECT id, label AS group_id, count(*) OVER (PARTITION BY label) AS size FROM r",
    "p7_found": "WITH" + _WORDS + "SELECT term AS word, 'rare' AS mark FROM t WHERE c <= 2 UNION ALL SELECT term, 'common' FROM t WHERE f * 20 > (SELECT count(*) FROM assignee WHERE assignee <> '')",
    "p7_words": "WITH" + _WORDS + "SELECT term AS word, c AS count, f AS countf, loads FROM t",
    "p7_terms": r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents WHERE text IS NOT NULL),
t AS (SELECT term, count(*) AS occurrences, count(DISTINCT doc_id) AS records FROM d GROUP BY term)
SELECT term, occurrences, records, concat_ws(',', CASE WHEN occurrences <= 1 THEN 'rare' END, CASE WHEN records * 10 > (SELECT count(*) FROM documents WHERE text IS NOT NULL) THEN 'common' END) AS marks FROM t""",
}
