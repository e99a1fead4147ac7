"""Orphans, packed values, heavy keys."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.patents import key_code, patent_key
from ledgerloom.operators.multivalue import explode_values, split_values, with_values
from ledgerloom.operators.orphans import ALWAYS, orphan_report, orphan_rows
from ledgerloom.operators.skew import eager_join_aggregate, heavy_keys, lookup_join
from tests.conftest import rows


def test_patent_numbers(spark):
    same = ["03000065", "3,000,065", " 3000 065", "US 3,000,065 B1", "us-3000065-A", "US3000065", "3000065 "]
    other = {"D0000105": "D:105", "us-D105-E": "D:105", "RE000002": "RE:2", "0": ":0", "EP571363": "EP:571363", "03O00065": None, "--": None, "": None, None: None, "US": None, "３０": None}
    df = spark.createDataFrame([(x,) for x in [*same, *other]], "n string")
    got = {r["n"]: r["k"] for r in df.select("n", patent_key(F.col("n")).alias("k")).collect()}
    assert {got[x] for x in same} == {":3000065"}
    assert {x: got[x] for x in other} == other
    keys = [":0", ":1", "A:1", "Z:999999999999", "AA:1", "ZZZZ:999999999999", "ABCDE:1", ":1234567890123"]
    codes = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").select(key_code(F.col("k"))).collect()]
    assert codes[-2:] == [None, None] and len(set(codes[:-2])) == len(keys) - 2 and min(codes[:-2]) >= 0


@pytest.mark.parametrize("heavy", [3, 1000])
def test_orphans_against_brute_force(spark, heavy):
    rng = random.Random(heavy)
    key = lambda: rng.choice([None, ":7", *(f"{rng.choice(['', 'D', 'LONGER'])}:{rng.randint(1, 150)}" for _ in range(3))])
    parents = [(rng.choice("ab"), key(), rng.choice([None, ALWAYS, *range(10)])) for _ in range(300)]
    refs = [(s, rng.choice("ab"), i, key() if rng.random() < 0.7 else ":7", rng.choice([None, *range(12)])) for s in ("x", "y") for i in range(800)]
    first = {}
    for scope, k, at in parents:
        if k and at is not None:
            first[scope, k] = min(at, first.get((scope, k), at))
    want = sorted((s, i) for s, scope, i, k, at in refs if k is None or (scope, k) not in first or first[scope, k] > (ALWAYS if at is None else at))
    r = spark.createDataFrame(refs, "src string, scope string, rid long, key string, at long").withColumn("code", key_code(F.col("key"))).withColumn("n", F.lit("clash"))
    p = spark.createDataFrame(parents, "scope string, key string, at long").withColumn("code", key_code(F.col("key")))
    got = orphan_rows(r, p, heavy)
    assert sorted((x["src"], x["rid"]) for x in got.collect()) == want
    assert sum(x["orphans"] for x in orphan_report(got).collect()) == len(want)
    assert orphan_rows(r.limit(0), p).count() == 0
    assert orphan_rows(r, p.limit(0)).count() == len(refs)


CASES = {
    "A; B|C": ["A", "B", "C"],
    "A and B AND  C": ["A", "B", "C"],
    "Sandy, , Band;": ["Sandy", "Band"],
    '"A, B" / C': ["A, B", "C"],
    '"OLD ""MILL"" X"; Y': ['OLD "MILL" X', "Y"],
    'x\n"y"\tz': ["x", "y", "z"],
    "Smith, Wesson": ["Smith, Wesson"],
    "A;" + " " * 40 + "Smith, Wesson": ["A", "Smith, Wesson"],
    "Smith, Wesson;Smith, Wesson and" + "\u00a0" * 30 + "up AND down": ["Smith, Wesson", "Smith, Wesson", "up AND down"],
    'A "q" Smith, Wesson': ["A q Smith, Wesson"],
    '"q", Smith, Wesson': ["q", "Smith, Wesson"],
    "b; SMITH, wesson ; c": ["b", "SMITH, wesson", "c"],
    "Smith, Wessonia": ["Smith", "Wessonia"],
    "Up and Down and Left": ["Up and Down", "Left"],
    '5" pipe; a': ['5" pipe; a'.split(";")[0], "a"],
    "": [],
    "  ": [],
    '""': [],
    None: None,
    "; , ;": [],
}


def test_split_values(spark):
    df = spark.createDataFrame([(i, x, "extra") for i, x in enumerate(CASES)], "id int, city string, pos string")
    got = {r["city"]: r["v"] for r in df.select("city", split_values(F.col("city"), ["Smith, Wesson", "Up and Down", None, ""]).alias("v")).collect()}
    assert got == CASES
    names = spark.createDataFrame([(x,) for x in ["Smith, Wesson", "Up and Down", None, "", "plain", "a\\E, b.*", "Smith, Wesson"]], "name string")
    # by one expression, and by the join that stands in for it beyond a number of names
    for at_most in (1000, 1):
        got = {r["city"]: r["v"] for r in with_values(df, "city", "v", names, "name", at_most).collect()}
        assert got == CASES
    odd = spark.createDataFrame([(1, "x;A\\e, B.*;y")], "id int, city string")
    assert [r["v"] for r in with_values(odd, "city", "v", names, "name", 1).collect()] == [["x", "A\\e, B.*", "y"]]
    out = explode_values(df, "city", ["id"], names, "name", at_least=2)
    assert [tuple(r) for r in out.where("id = 0").orderBy("pos").collect()] == [(0, 1, "A"), (0, 2, "B"), (0, 3, "C")]
    assert explode_values(df.limit(0), "city", ["id"]).collect() == []


def test_split_values_against_a_plain_reader(spark):
    rng = random.Random(9)
    cities = ["".join(rng.choice(["ab", " ", ";", ",", '"', " and ", "x/y", "é", "\t"]) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    cities.append("long name; " * 3000)

    def read(s):
        pieces, out = s.split('"'), []
        cur = []  # (text, literal)
        for i, p in enumerate(pieces):
            last = i == len(pieces) - 1
            if i % 2 and last:
                cur.append(('"', False))
                cur.append((p, False))
            elif i % 2:
                cur.append((p, True))
            elif p == "" and 0 < i < len(pieces) - 1:
                cur.append(('"', True))
            else:
                cur.append((p, False))
        merged = []
        for text, lit in cur:
            if merged and merged[-1][1] == lit and not lit:
                merged[-1][0] += text
            else:
                merged.append([text, lit])
        value = ""
        for text, lit in merged:
            parts = [text] if lit else re.split(r"[;,|/&+\t\n\r]|(?<=\s)(?i:and)(?=\s)", text)
            value += parts[0]
            for more in parts[1:]:
                out.append(value)
                value = more
        return [v.strip() for v in [*out, value] if v.strip()]

    df = spark.createDataFrame([(c,) for c in cities], "city string")
    for r in df.select("city", split_values(F.col("city")).alias("v")).collect():
        assert r["v"] == read(r["city"]), repr(r["city"])


def test_eager_aggregation_equals_the_join(spark):
    rng = random.Random(2)
    left = [(rng.choice([None, 1, 2, 3, rng.randint(4, 60)]), rng.choice(["a", "b", None, " "]), rng.choice([None, 1, 5])) for _ in range(900)]
    right = [(rng.choice([None, 1, 1, 1, rng.randint(2, 50)]), rng.choice([None, 2, 7])) for _ in range(700)]
    l = spark.createDataFrame(left, "k int, g string, x int").withColumn("n", F.lit(0))
    r = spark.createDataFrame(right, "k int, y int").withColumn("g", F.lit("clash"))
    by = Counter(k for k, _ in right if k is not None)
    ys = defaultdict(int)
    for k, y in right:
        ys[k] += y or 0
    want = {}
    for k, g, x in left:
        w = want.setdefault(g, [0, set(), 0, 0, 0])
        w[0] += 1
        w[1] |= {k} - {None}
        w[2] += by[k] if k is not None else 0
        w[3] += x or 0
        w[4] += ys[k] if k is not None else 0
    got = eager_join_aggregate(l, r, "k", ["g"], {"xs": "x"}, {"ys": "y"})
    assert {t["g"]: (t["left_rows"], t["left_keys"], t["pairs"], t["xs"], t["ys"]) for t in got.collect()} == {g: (a, len(b), c, d, e) for g, (a, b, c, d, e) in want.items()}
    assert eager_join_aggregate(l.limit(0), r, "k", ["g"]).collect() == []


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_with_hot_keys(spark, how):
    data = [("hot", i) for i in range(5000)] + [(f"k{i % 900}", i) for i in range(6000)] + [(None, 1)] * 3000 + [("lost", 2)] * 40
    left = spark.createDataFrame(data, "k string, v int")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(900)], "k string, w int")
    assert heavy_keys(left, ["k"], 1000) and "hot" in heavy_keys(left, ["k"], 10)
    for heavy in (10, 1000):
        assert Counter(map(tuple, lookup_join(left, right, "k", how, heavy).select("k", "v", "w").collect())) == Counter(map(tuple, left.join(right, "k", how).select("k", "v", "w").collect()))
    two = lookup_join(left.withColumn("j", F.lit(1)), right.withColumn("j", F.lit(1)), ["k", "j"], how, 10)
    assert two.count() == left.join(right, "k", how).count()
