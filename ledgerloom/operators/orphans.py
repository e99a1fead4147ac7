"""References to records that don't exist, by compressed bitmaps of keys per key range and period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.skew import HEAVY
from ledgerloom.session import cut

#: The instant of parents that were always there.
ALWAYS = -(2**63)


def instants(c):
    """Microseconds of a timestamp with or without zone, so that instants compare as integers."""
    return F.unix_micros(c.cast("timestamp"))


def orphan_rows(refs: DataFrame, parents: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """The rows of refs whose key names no parent of the same scope that exists at the row's instant.

    refs has src, scope, rid, code (long), key (string) and at (microseconds); parents has scope, code, key and at.
    A parent exists from its smallest `at` on. code is the integer a dictionary gives to key; a key that can't be read
    has neither and is an orphan; a key the dictionary can't hold has key alone and goes through an exact join.

    Method: references and parents become bitmaps per key range (the 64 codes of a word) and period (an instant of
    loading), of which only words with a set bit are stored. Running along the periods of a range, a word of references
    AND NOT the OR of all parent words so far leaves the orphans, whose codes are decoded from the surviving bits. Many
    references to one key at one instant are one bit, so hot keys vanish in the partial aggregation before the shuffle.
    Rows are then fetched by (src, code, at): combinations that hold 1/heavy of the rows or more, at most `heavy` of
    them, by broadcast; the others by a shuffle in which each is small.

    A reference with null `at` sees only parents that were always there; a parent with null `at` never exists. Repeated
    rows come out each. Empty inputs are fine: without parents all references are orphans. Returns src, rid, at.
    """
    # keys are read once; the string is needed only where there is no code
    refs = cut(refs.select("src", "scope", "rid", F.when(F.col("code").isNull(), F.col("key")).alias("key"), "code", F.coalesce("at", F.lit(ALWAYS)).alias("at")))
    parents = parents.where(F.col("at").isNotNull() & F.col("key").isNotNull())
    coded = refs.where(F.col("code").isNotNull())
    out = ["src", "rid", "at"]
    unread = refs.where(F.col("key").isNull() & F.col("code").isNull()).select(*out)

    per_key = cut(coded.groupBy("src", "scope", "code", "at").agg(F.count(F.lit(1)).alias("n")))
    bit = F.expr("shiftleft(1L, cast(code & 63 as int))")
    word = F.expr("shiftright(code, 6)")
    ref_words = per_key.groupBy("scope", word.alias("word"), "at", "src").agg(F.bit_or(bit).alias("ref_bits"), F.lit(None).cast("long").alias("parent_bits"))
    first = parents.where(F.col("code").isNotNull()).groupBy("scope", "code").agg(F.min("at").alias("at"))
    parent_words = first.groupBy("scope", word.alias("word"), "at").agg(F.bit_or(bit).alias("parent_bits")).select("scope", "word", "at", F.lit(None).cast("string").alias("src"), F.lit(None).cast("long").alias("ref_bits"), "parent_bits")
    words = ref_words.unionByName(parent_words).withColumn(
        "so_far", F.expr("bit_or(parent_bits) OVER (PARTITION BY scope, word ORDER BY at RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    )
    survivors = (
        words.where(F.col("src").isNotNull())
        .withColumn("bits", F.expr("ref_bits & ~coalesce(so_far, 0L)"))
        .where("bits <> 0")
        .select("src", "scope", "at", F.explode(F.expr("transform(filter(sequence(0, 63), i -> shiftright(bits, i) & 1L = 1L), i -> shiftleft(word, 6) + i)")).alias("code"))
    )
    on = ["src", "scope", "at", "code"]
    survivors = cut(per_key.join(survivors, on).select(*on, "n"))

    total = per_key.agg(F.sum("n")).first()[0] or 0
    hot = per_key.where(F.col("n") * heavy >= max(total, heavy * 10)).select(*on)  # at most `heavy` rows
    rows = coded.select(*on, "rid")
    heavy_rows = rows.join(F.broadcast(survivors.where(F.col("n") * heavy >= max(total, heavy * 10)).select(*on)), on)
    light_rows = rows.join(F.broadcast(hot), on, "left_anti").join(survivors.where(F.col("n") * heavy < max(total, heavy * 10)).select(*on), on)

    long_refs = refs.where(F.col("code").isNull() & F.col("key").isNotNull())
    long_parents = parents.where(F.col("code").isNull()).groupBy("scope", "key").agg(F.min("at").alias("first_at"))
    long_rows = long_refs.join(long_parents, ["scope", "key"], "left").where(F.col("first_at").isNull() | (F.col("first_at") > F.col("at")))
    return unread.unionByName(heavy_rows.select(*out)).unionByName(light_rows.select(*out)).unionByName(long_rows.select(*out))


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Number of orphan rows per src and year of loading: src, year (null where the instant is unknown), orphans."""
    year = F.year(F.timestamp_micros(F.when(F.col("at") > ALWAYS, F.col("at"))))
    return orphans.groupBy("src", year.alias("year")).agg(F.count(F.lit(1)).alias("orphans"))
