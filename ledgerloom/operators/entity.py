"""Composite operators: a cascade of matches against gazetteers, and the disambiguation of organisations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.similarity import name_similarity
from ledgerloom.functions.text import backwards_block, letters_block, part_of, reversed_prefix, without_blanks
from ledgerloom.operators.aggregate import token_frequency
from ledgerloom.operators.graph import min_labels
from ledgerloom.operators.joins import one_per_key
from ledgerloom.session import cut


@dataclass(frozen=True)
class Stage:
    """One attempt of a cascade: equal keys (functions of the name columns), and a least similarity for fuzzy stages.

    The score is base, plus the similarity in fuzzy stages.
    """

    name: str
    base: float
    left: Column
    right: Column
    least: float | None = None
    #: what fuzzy stages compare
    typed: Column = field(default_factory=lambda: F.col("city"))
    ref: Column = field(default_factory=lambda: F.col("r_city"))


def place_stages(seq: int, foreign: bool) -> list[Stage]:
    """Exact, without blanks, by the first three letters, by the last four: for the seq-th part of the typed city (-1: all)."""
    base = 20.0 if foreign else 10.0
    typed, ref = part_of(F.col("city"), seq), F.col("r_city")
    joined, r_joined = without_blanks(typed), without_blanks(ref)
    kind = "foreign" if foreign else "domestic"
    return [
        Stage(f"{kind} exact {seq}", base + 1, typed, ref),
        Stage(f"{kind} joined {seq}", base + 1, joined, r_joined),
        Stage(f"{kind} first letters {seq}", base, F.left(joined, F.lit(3)), F.left(r_joined, F.lit(3)), 0.92, joined, r_joined),
        Stage(f"{kind} last letters {seq}", base, reversed_prefix(joined, 4), reversed_prefix(r_joined, 4), 0.90, joined, r_joined),
    ]


def cascade(places: DataFrame, ref: DataFrame, ident: str, stages: Sequence[Stage], within: Sequence[str], alike: Sequence[str] = ()) -> DataFrame:
    """(ident, ref_id, stage, score, candidates): the best reference row of the first stage that finds one.

    places has ident, city and the columns of `within`; ref has ref_id, r_city and the same columns. Every stage is an
    equi-join on its key and on `within`; what it finds is written out and leaves the work set, so later (dearer) stages
    see only what is left. Ties go to rows of the same `alike` columns, where places and ref have them, then to the
    smallest name, then the smallest ref_id.
    """
    found = None
    base = cut(places.select(ident, "city", *within, *alike))
    ref = ref.withColumnsRenamed({a: f"__{a}" for a in alike})
    same = [F.desc_nulls_last(F.col(a) == F.col(f"__{a}")) for a in alike]
    for s in stages:
        left = base if found is None else base.join(found.select(ident), ident, "left_anti")
        # the seq-th part of a name that has none is '', which is no key
        l = left.withColumn("__key", s.left).where("__key <> ''")
        pairs = l.join(ref.withColumn("__key", s.right), ["__key", *within])
        if s.least is None:
            pairs = pairs.withColumn("score", F.lit(s.base))
        else:
            pairs = pairs.withColumn("__sim", name_similarity(s.typed, s.ref)).where(F.col("__sim") > s.least).withColumn("score", F.lit(s.base) + F.col("__sim"))
        n = pairs.groupBy(ident).agg(F.count(F.lit(1)).alias("candidates"))
        best = one_per_key(pairs, [ident], [F.desc("score"), *same, F.asc("r_city"), F.asc("ref_id")]).join(n, ident)
        hit = cut(best.select(ident, "ref_id", F.lit(s.name).alias("stage"), "score", "candidates"))
        found = hit if found is None else found.unionByName(hit)
    return found


def geocode(places: DataFrame, ref: DataFrame) -> DataFrame:
    """(id, ref_id, stage, score, candidates) of places (id, city, state, country, zipcode, ncity, ncountry), codes of states and countries.

    ref has ref_id, r_city, state, country, zipcode. Stages in order: for the whole name (-1) and each part between
    commas or bars (0 to the last) those of place_stages; names corrected before (ncity in ncountry) as they are, without
    blanks (foreign only) and by the first three letters; the ZIP of places of the US. Places of the US, of other
    countries and without a country (which may be anywhere) score from 10, 20 and 40 on; corrected names 4 more, ZIP 31.

    A name is matched once however many parts it is; a place takes what its first part with a match found, as if parts
    came one after the other. Among equal scores places of the typed state come first.
    """
    ANYWHERE = ""
    kind = F.when(F.col("country") == "US", "domestic").when(F.col("country") == ANYWHERE, "anywhere").otherwise("foreign")
    more = F.when(F.col("country") == "US", 0.0).when(F.col("country") == ANYWHERE, 30.0).otherwise(10.0)
    refs = cut(ref.withColumn("country", F.explode(F.array("country", F.lit(ANYWHERE)))))
    within, alike = ["country"], ["state"]

    def matched(named: DataFrame, stages: Sequence[Stage]) -> DataFrame:
        """The rows of named (id, city, state, country, ...) with what their name finds."""
        key = F.xxhash64("city", "country", "state")
        names = named.select(key.alias("name"), "city", *within, *alike).distinct()
        found = cascade(names, refs, "name", stages, within, alike)
        return named.withColumn("name", key).join(found, "name").drop("name")

    base = cut(places.withColumn("country", F.coalesce("country", F.lit(ANYWHERE))))
    cells = F.split("city", r" *[,|] *")
    parts = F.when(F.size(cells) > 1, F.concat(F.array("city"), cells)).otherwise(F.array("city"))
    names = base.select("id", "state", "country", F.posexplode(parts).alias("seq", "city")).withColumn("seq", F.col("seq") - 1)
    stages = [replace(s, name=s.name.removeprefix("domestic ").removesuffix(" -1")) for s in place_stages(-1, False)]
    hit = one_per_key(matched(names, stages), ["id"], [F.asc("seq")])
    first = cut(hit.select("id", "ref_id", F.concat_ws(" ", kind, "stage", "seq").alias("stage"), (F.col("score") + more).alias("score"), "candidates"))

    corrected = base.join(first, "id", "left_anti").where("ncity <> ''").select("id", F.col("ncity").alias("city"), F.col("nstate").alias("state"), F.coalesce("ncountry", "country").alias("country"))
    exact, joined, letters, _ = [replace(s, base=s.base + 4) for s in stages]
    joined = replace(joined, left=F.when(F.col("country") != "US", joined.left))
    hit = matched(corrected, [exact, joined, replace(letters, least=0.95)])
    second = cut(hit.select("id", "ref_id", F.concat_ws(" ", kind, "stage", F.lit("corrected")).alias("stage"), (F.col("score") + more).alias("score"), "candidates"))

    number = F.regexp_extract("zipcode", "^ *([0-9]+)", 1).try_cast("long").alias("zip")
    left = base.join(first.unionByName(second), "id", "left_anti").where("country = 'US'").select("id", number)
    zips = ref.where("country = 'US'").select(number, "ref_id")
    by_zip = left.join(zips, "zip").groupBy("id").agg(F.min("ref_id").alias("ref_id"), F.lit("domestic zip").alias("stage"), F.lit(31.0).alias("score"), F.count(F.lit(1)).alias("candidates"))
    return first.unionByName(second).unionByName(by_zip)


def without_common_words(names: DataFrame, name: str, out: str, words: DataFrame, common_over: float) -> DataFrame:
    """out: the name without words counted more than common_over, numbers kept; its rarest word if all are common."""
    tokens = names.select(name, F.posexplode(F.split(name, " ")).alias("pos", "word")).distinct()
    counted = tokens.join(words.select("word", "count"), "word", "left")
    kept = F.array_sort(F.collect_list(F.when((F.coalesce("count", F.lit(0)) <= common_over) | F.col("word").rlike("^[0-9]+$"), F.struct("pos", "word"))))
    g = counted.groupBy(name).agg(kept.alias("kept"), F.min_by("word", F.struct(F.coalesce("count", F.lit(0)), "word")).alias("rarest"))
    text = F.array_join(F.transform("kept", lambda k: k["word"]), " ")
    return names.join(g.select(name, F.when(F.size("kept") > 0, text).otherwise(F.col("rarest")).alias(out)), name, "left")


def words_in_order(names: DataFrame, name: str, out: str, words: DataFrame, common_over: float) -> DataFrame:
    """out: the words from rare to frequent, up to half of them dropped from the frequent end while above common_over."""
    tokens = names.select(name, F.posexplode(F.split(name, " ")).alias("pos", "word")).distinct()
    counted = tokens.join(words.select("word", "count"), "word", "left")
    listed = counted.groupBy(name).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "word", "pos"))).alias("ws"))
    frequent = F.size(F.filter("ws", lambda w: w["n"] > common_over))
    keep = F.size("ws") - F.least(frequent, F.floor(F.size("ws") / 2).cast("int"))
    return names.join(listed.select(name, F.array_join(F.transform(F.slice("ws", F.lit(1), keep), lambda w: w["word"]), " ").alias(out)), name, "left")


def typo_words(words: DataFrame, common_over: float) -> DataFrame:
    """(word, count): words of five letters or more that aren't common and begin with the two letters of a common word to
    which they are more than 0.95 similar, with the count of the most similar one. Common words are few by their limit.
    """
    top = words.where(F.col("count") > common_over).select(F.col("word").alias("top"), "count", F.left("word", F.lit(2)).alias("key"))
    rare = words.where((F.col("count") < common_over) & (F.length("word") >= 5)).select("word", F.left("word", F.lit(2)).alias("key"))
    near = rare.join(top, "key").withColumn("sim", name_similarity(F.col("word"), F.col("top"))).where("sim > 0.95")
    return one_per_key(near, ["word"], [F.desc("sim"), F.asc("top")]).select("word", "count")


def block_pairs(rows: DataFrame, key: str, ident: str, part: int = 500) -> DataFrame:
    """Columns l and r (structs of rows): every two rows of a block once, l.ident < r.ident.

    Blocks are cut into parts of about `part` rows by hash, and each two parts meet in a task of their own, so the pairs
    of a large block are spread over many tasks.
    """
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    k = F.ceil(F.col("__n") / part).cast("int")
    at = rows.join(n, key).withColumn("__k", k).withColumn("__at", F.pmod(F.xxhash64(ident), "__k").cast("int"))
    row = F.struct(*rows.columns)
    left = at.select(key, F.col("__at").alias("__i"), F.explode(F.sequence(F.lit(0), F.col("__k") - 1)).alias("__j"), row.alias("l"))
    right = at.select(key, F.explode(F.sequence(F.lit(0), F.col("__k") - 1)).alias("__i"), F.col("__at").alias("__j"), row.alias("r"))
    return left.join(right, [key, "__i", "__j"]).where(f"l.{ident} < r.{ident}").select("l", "r")


def disambiguate(names: DataFrame, name: str = "name", weight: str = "cnt") -> DataFrame:
    """(name, cluster): organisations by blocked matching rounds; cluster is the smallest name of the group.

    Words more frequent than the mean by three deviations count as common. Rounds link names with the same rare words in
    order, the same text without common words, the same letters, the same beginnings of words, and the same reversed
    text, where one of two similarities (whole names, names without common words) exceeds 0.95 or both exceed 0.9.
    Rare words that are nearly a common one (see typo_words) count as that one. In a block with similarities every two
    names are compared, in the first two rounds, where a block's names are all alike, each with the smallest; groups are
    what links join, directly or not, so no round needs repeating.
    """
    base = names.where(F.col(name).isNotNull() & (F.trim(name) != "")).groupBy(F.col(name).alias("name")).agg(F.sum(weight).alias("cnt"))
    base = cut(base.withColumn("clean", F.trim(F.regexp_replace(F.regexp_replace(F.upper("name"), r"[^\p{L}\p{N} ]", " "), " +", " "))).where("clean <> ''"))
    words = cut(token_frequency(base, "clean", "cnt"))
    limit = words.agg(F.avg("count") + 3 * F.stddev_pop("count")).first()[0] or 0.0
    typos = typo_words(words, limit).withColumnRenamed("count", "top")
    words = cut(words.join(typos, "word", "left").select("word", F.coalesce("top", "count").alias("count")))
    keyed = without_common_words(base, "clean", "fld2", words, limit)
    keyed = cut(words_in_order(keyed, "clean", "fld3", words, limit).withColumns({"block1": without_blanks(F.col("clean")), "block2": letters_block(F.col("clean")), "block3": backwards_block(F.col("clean"), F.col("fld2"))}))
    links = None
    # names with the same fld2 have similarity 1 by it
    for key in ("fld3", "fld2"):
        lead = keyed.where(F.col(key) != "").groupBy(key).agg(F.min("name").alias("b"))
        pairs = keyed.join(lead, key).where("name <> b").select(F.col("name").alias("a"), "b")
        links = pairs if links is None else links.unionByName(pairs)
    for key in ("block1", "block2", "block3"):
        pairs = block_pairs(keyed.where(F.col(key) != "").select("name", "clean", "fld2", key), key, "name")
        j1, j2 = name_similarity(F.col("l.clean"), F.col("r.clean")), name_similarity(F.col("l.fld2"), F.col("r.fld2"))
        near = pairs.where("l.fld2 <> r.fld2").withColumns({"j1": j1, "j2": j2}).where("j1 > 0.95 OR j2 > 0.95 OR (j1 > 0.9 AND j2 > 0.9)")
        links = links.unionByName(near.select(F.col("l.name").alias("a"), F.col("r.name").alias("b")))
    labels = min_labels(cut(links))
    return base.select("name", "cnt").join(labels.withColumnRenamed("id", "name"), "name", "left").select("name", "cnt", F.coalesce("label", "name").alias("cluster"))


def cluster_names(clusters: DataFrame) -> DataFrame:
    """(cluster, title, members, cnt): each cluster by its most frequent name."""
    return clusters.groupBy("cluster").agg(F.max_by("name", F.struct("cnt", "name")).alias("title"), F.count(F.lit(1)).alias("members"), F.sum("cnt").alias("cnt"))


def merge_clusters(clusters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The given clusters as one, under the smallest of their keys."""
    return clusters.withColumn("cluster", F.when(F.col("cluster").isin(list(keys)), min(keys)).otherwise(F.col("cluster")))


def find_clusters(clusters: DataFrame, text: str) -> DataFrame:
    """Rows whose name holds the text, in any case, most frequent first."""
    return clusters.where(F.contains(F.upper("name"), F.lit(text.upper()))).orderBy(F.desc("cnt"), "name")
