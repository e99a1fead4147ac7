"""Components and term frequencies."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components, groups
from ledgerloom.llm.terms import mark_terms, normal_word, term_frequencies
from tests.conftest import rows


def union_find(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        for x in (a, b):
            if x is not None:
                find(x)
        if a is not None and b is not None:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return sorted((x, find(x)) for x in parent)


def check(spark, edges, kind="string"):
    got = connected_components(spark.createDataFrame(edges, f"a {kind}, b {kind}").withColumn("label", F.lit(1)))
    assert sorted(tuple(r) for r in got.select("id", "label").collect()) == union_find(edges)


def test_components_of_random_links(spark):
    rng = random.Random(3)
    edges = [(f"n{rng.randint(0, 400):03}", f"n{rng.randint(0, 400):03}") for _ in range(300)]
    check(spark, edges + edges[:50] + [("x", "x"), ("y", None), (None, "z"), (None, None)])


def test_a_long_chain_in_random_order(spark):
    n = list(range(600))
    random.Random(1).shuffle(n)
    check(spark, list(zip(n, n[1:], strict=False)), "long")


def test_a_star_of_a_third_of_all_links(spark):
    check(spark, [("hub", f"m{i:05}") for i in range(11_000)] + [(f"p{i:05}", f"q{i:05}") for i in range(5_000)])


def test_no_links(spark):
    assert rows(groups(connected_components(spark.createDataFrame([], "a string, b string")))) == []


def test_terms_against_counting(spark):
    rng = random.Random(4)
    data = [(rng.choice(["the", "of", None, "", "x", f"w{rng.randint(0, 99)}"]), rng.choice([1, 2, 3, None, *range(10, 60)])) for _ in range(4000)]
    data += [("hot", i % 700) for i in range(3000)]
    df = spark.createDataFrame(data, "t string, r int").withColumn("record", F.lit(0))
    n, docs = defaultdict(int), defaultdict(set)
    for t, r in data:
        if t is not None:
            n[t] += 1
            docs[t].add(r)
    for parts in (1, 7):
        got = {r["term"]: (r["occurrences"], r["records"], r["weight"]) for r in term_frequencies(df, "t", "r", partitions=parts).collect()}
        assert got == {t: (n[t], len(docs[t]), 0) for t in n}


def test_runs_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        df = spark.createDataFrame([(t, i) for t in ("a", "b", "c") for i in range(10)], "t string, r int")
        assert rows(term_frequencies(df, "t", "r", partitions=2), "term", "occurrences", "records") == [("a", 10, 10), ("b", 10, 10), ("c", 10, 10)]
        # tallies stored repeatedly count once, by their largest values; another item of the same term and record counts too
        tallies = [("a", "f1", "a.", n, w) for n, w in ((2, 5), (2, 5), (3, 4), (None, None), (1, 1), (2, 5), (3, 5))] + [("a", "f1", "A", 10, 1), ("a", None, "a.", 7, 1), ("b", "f1", None, 1, 1), ("b", "f1", None, 1, 1)]
        df = spark.createDataFrame(tallies, "t string, r string, i string, n int, w int")
        got = term_frequencies(df, "t", "r", F.col("n"), F.col("w"), item="i", partitions=2)
        assert rows(got, "term", "occurrences", "weight", "records") == [("a", 20, 7, 2), ("b", 1, 1, 1)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_marks_and_words(spark):
    freq = spark.createDataFrame([("a", 1, 10), ("b", 3, 10), ("c", 1, 0)], "term string, occurrences long, weight long")
    assert rows(mark_terms(freq, 1, F.col("weight") > 5), "term", "marks") == [("a", ["rare", "common"]), ("b", ["common"]), ("c", ["rare"])]
    df = spark.createDataFrame([("Smaü-blek,",), ("!",), (None,)], "w string")
    assert [r[0] for r in df.select(normal_word(F.col("w"))).collect()] == ["SMAÜBLEK", "", None]
    assert rows(term_frequencies(df.limit(0).withColumn("r", F.lit(1)), "w", "r")) == []
