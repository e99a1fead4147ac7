"""Places and names."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.names import _NEAR, _slip_members, parse_organisation, parse_person, resolve_names, spelling_pairs, swapped
from ledgerloom.llm.places import Gazetteer, distance, fold, match_places
from tests.conftest import rows

REF = [
    (1, "North Falls", "WI", "US", "18200"), (2, "North Falls", "OH", "US", "55500"), (3, "Klaurcheon", None, "KR", ""), (4, "Saint-Corncourt", None, "FR", ""),
    (0, "Lyon", None, "FR", ""), (5, "Snamor Heights", "CO", "US", "62007"), (6, "Shumwood, Greared Park", "CO", "US", "81000"), (7, "Skúrnac", None, "FR", ""), (8, None, None, "FR", ""), (None, "X", None, "FR", ""),
]
CASES = [
    (("North Falls", "WI", "US", None), 1), (("NORTH  FALLS", "oh", None, ""), 2), (("N. Falls", "Wisconsin", "U.S.A.", ""), 1), (("North Falls WI", None, None, ""), 1),
    (("North Falls", None, "OH", ""), 2), (("North Falls", None, "US", "18211-1234"), 1), (("North Falls", None, "US", ""), -1), (("North Falls", "TX", "US", ""), -1),
    (("18233 North Falls", None, "US", ""), 1), (("NorthFalls", "W.I.", "US", ""), 1), (("Norht Fals", "WI", "US", ""), 1), (("East North Falls", "WI", "US", ""), -1),
    (("City of Klaurcheon", None, "Rep. of Korea", ""), 3), (("Klaurcheon (KR)", None, None, ""), 3), (("KR-91761 klaurchoen", None, "KRX", ""), 3), (("Klaurcheon", None, "JP", ""), -1),
    (("St Corncourt", None, "France", ""), 4), (("Snamor Hts.", "CO", "US", ""), 5), (("shumwood, greared park", "CO", "US", ""), 6), (("Skurnac?", None, "FR", ""), 7), (("SkÃºrnac", None, "FR", ""), 7),
    (("Lyon", None, "FR", ""), 0), (("Lyon Cedex 07", None, "FR", ""), 0), (("Research Park, Lyon", None, "FR", ""), 0), (("Greater Lyon Area", None, "France", ""), 0), (("Lyoon Cedex", None, "FR", ""), 0), (("Research Park Lyon", None, "FR", ""), -1),
    (("Lyon Cedex 07", None, None, ""), -1), (("Lyon Cedex", None, "DE", ""), -1), (("Upper Lyon", None, "FR", ""), -1), (("Lyon-Klaurcheon area", None, "FR", ""), -1), (("Ly on", None, "FR", ""), 0),
    (("Downtown Klaurchoen area", None, "KR", ""), 3), (("Snamor Hgts Plaza", "CO", "US", ""), 5), (("Snamor Plaza", "CO", "US", ""), -1), (("Norht Falls Plaza", "WI", "US", ""), 1), (("North Falls, Wisconsin", None, None, ""), 1),
    ((None, "WI", "US", ""), -1), (("  ", None, None, None), -1), (("unknown", "WI", "US", ""), -1), (("?", None, None, None), -1), (("0", None, None, None), -1), (("x" * 50_000, None, "FR", ""), -1), (("word " * 9000, None, "FR", ""), -1),
]


def test_places(spark):
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(CASES)] + [(99, *CASES[0][0])], "id int, city string, state string, country string, zip string").withColumn("lat", F.lit("clash"))
    ref = spark.createDataFrame(REF, "place_id int, city string, state string, country string, zipcode string")
    got = {r["id"]: r["place_id"] for r in match_places(df, ref, "city", "state", "country", "zip").collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)} | {99: 1}
    assert match_places(df.limit(0), ref, "city", "state", "country", "zip").count() == 0
    assert {r["place_id"] for r in match_places(df, ref.limit(0), "city", "state", "country", "zip").collect()} == {-1}
    # the same result however many slices the reference is looked at in
    got = {r["id"]: r["place_id"] for r in match_places(df, ref, "city", "state", "country", "zip", slice_rows=3).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)} | {99: 1}


def test_long_words_of_the_reference(spark):
    long = "q" * 70
    ref = spark.createDataFrame([(1, long, None, "FR", ""), (2, "Blar " + "w" * 45, None, "FR", "")], "place_id int, city string, state string, country string, zipcode string")
    df = spark.createDataFrame([(1, long + "q"), (2, "w" * 44 + "v Blar"), (3, "q" * 67 + "x")], "id int, city string").withColumns({"s": F.lit(""), "n": F.lit("FR"), "z": F.lit("")})
    assert rows(match_places(df, ref, "city", "s", "n", "z"), "id", "place_id") == [(1, 1), (2, 2), (3, -1)]


def test_every_reference_name_finds_itself(sf, spark):
    ref = [tuple(r) for r in spark.read.parquet(f"{sf}/placeref.parquet").select("place_id", "city", "state", "country", "zipcode").collect()]
    g = Gazetteer(ref)
    found = [g.find(city, state, country, z) == pid for pid, city, state, country, z in ref]
    # spoilt names of the list still find it: words put in, letters swapped, short forms
    spoilt = [g.find(f"{city} Cedex 4", state, country, z) == pid for pid, city, state, country, z in ref]
    assert sum(spoilt) / len(spoilt) > 0.98
    assert sum(found) / len(found) > 0.99


def test_distance_and_fold():
    assert [distance(*x, 2) for x in [("abc", "abc"), ("abc", "acb"), ("abc", "xyz"), ("", "ab")]] == [0, 1, 3, 2]
    assert fold("Sma{umlaut over (u)}blek  Ø-x") == "smaublek o x" and fold(None) == ""


def slip(a: str, b: str) -> bool:
    """Whether one slip makes b of a: a letter too many or too few, two swapped, or a neighbouring key hit."""
    if len(a) > len(b):
        a, b = b, a
    n = len(a)
    if len(b) - n > 1 or n < 3:
        return False
    i = 0
    while i < n and a[i] == b[i]:
        i += 1
    if len(b) > n:
        return a[i:] == b[i + 1 :]
    if i == n:
        return True
    if a[i + 1 :] == b[i + 1 :]:
        return b[i] in _NEAR.get(a[i], ())
    return i + 1 < n and a[i] == b[i + 1] and a[i + 1] == b[i] and a[i + 2 :] == b[i + 2 :]


def test_slips_meet_in_their_blocks(spark):
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abesd") for _ in range(rng.randint(4, 6))) for _ in range(500)})
    empty = {k: "" for k in ("k3", "k4")}
    f = spark.createDataFrame([(i, "org", "s", w) for i, w in enumerate(words)], "p long, kind string, src string, k1 string").withColumns({k: F.lit(v) for k, v in (empty | {"k2": ""}).items()})
    got = {(r["x"], r["y"]) for r in _slip_members(f).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(words, 2) if slip(a, b)}


def test_parsing():
    assert parse_organisation("KLOMMECKOPTICAL INT'L L.L.C.") == ("org", "klommeck", "optical", "international", "llc")
    assert parse_organisation("Optical International Kl-ommeck, Limted") == ("org", "klommeck", "optical", "international", "ltd")
    assert parse_organisation("Doe, John") is None and parse_organisation("-") is None and parse_organisation("") is None
    assert parse_person("Doe, Jr.", "Prof. Ann B.") == ("person", "doe", "ann", "b", "")
    assert parse_person("Doe, Ann", "") == ("person", "doe", "ann", "", "") and parse_person("Doe", "AB") == ("person", "doe", "a", "b", "")
    assert parse_person("", "") is None
    assert swapped("Ann B.|Doe") == ("doe", "ann", "b") and swapped("Doe, Ann|") == ("", "", "")
    assert slip("smith", "smiht") and slip("smith", "smth") and slip("smith", "smoth") and not slip("smith", "smxth") and not slip("smith", "jones")


def entity_sets(spark, names):
    df = spark.createDataFrame(names, "src string, name string").withColumn("entity", F.lit("clash"))
    got = {}
    for r in resolve_names(df.select("src", "name")).collect():
        got.setdefault((r["src"], r["entity"]), set()).add(r["name"])
    return sorted(sorted(x) for x in got.values())


def test_entities(spark):
    a = [["Acme Tool Works GmbH", "ACME TOOL WORKS G.M.B.H.", "Acme Tool GmbH", "Tool Works Acme Gesellschaft mbH", "Acmme Tool Works GmbH"], ["Acme Paper Works GmbH"], ["Doe, John", "DOE, JOHN"]]
    i = [["Doherty|John", "Doherty, John|", "Doherty|J.", "Doherty|Dr. John", "Dohetry|John", "John|Doherty"], ["Roe|Anthony B.", "Roe|Tony", "Roe|A. B.", "ROE|ANTHONY"], ["Poe|Ann C."], ["Poe|Ann D."], ["Poe|Amy"], ["Poe|A."]]
    names = [("assignee", n) for x in a for n in x] + [("inventor", n) for x in i for n in x]
    names += names[:3] + [("assignee", None), ("assignee", "-"), ("assignee", ""), (None, "x"), ("inventor", "|")]
    assert entity_sets(spark, names) == sorted(sorted(x) for x in a + i)


def test_slip_of_a_last_name_with_two_bearers(spark):
    # the misspelt last name is borne by two persons, both known under the right one
    right = [("inventor", f"Taunglient|{g}") for g in ("Robert", "Maria", "Pedro", "Helga", "Oskar")]
    slips = [("inventor", f"Taugnlient|{g}") for g in ("Robert", "Maria")]
    got = entity_sets(spark, right + slips)
    assert ["Taugnlient|Maria", "Taunglient|Maria"] in got and ["Taugnlient|Robert", "Taunglient|Robert"] in got and len(got) == 5


def test_rounds_go_on_until_nothing_merges(spark, monkeypatch):
    from ledgerloom.llm import names
    from ledgerloom.session import cut

    def one_link(f, slips):
        two = f.select("e").distinct().orderBy("e").limit(2).agg(F.min("e").alias("a"), F.max("e").alias("b"))
        return cut(two.where("a < b"))

    monkeypatch.setattr(names, "_links", one_link)
    assert len(entity_sets(spark, [("inventor", f"{x * 5}|Ann") for x in "BCDFGHJKLM"])) == 1


def test_pairs(spark):
    e = spark.createDataFrame([("s", "b", 1), ("s", "a", 1), ("s", "c", 1), ("t", "a", 1), ("s", "z", 2)], "src string, name string, entity long")
    assert rows(spelling_pairs(e)) == [("s", "a", "b"), ("s", "a", "c"), ("s", "b", "c")]
    assert rows(spelling_pairs(resolve_names(e.select("src", "name").limit(0)))) == []


def test_words_outside_the_lists(spark):
    a = [
        ["Nordfoss Ceramics Oyj", "NORDFOSS CERAMICS OYJ", "Nordfoss Ceram. Oyj", "Nordfos Ceramics Oyj", "Ceramics Oyj Nordfoss", "Nordfoss Ceramics"],
        ["Sudfjell Ceramics Oyj", "Sudfjell Ceramics"], ["Nord Ceramics Oyj"], ["Nordfoss Timber Oyj"],
    ]
    assert entity_sets(spark, [("assignee", n) for x in a for n in x]) == sorted(sorted(x) for x in a)


#: A labelled set none of whose words is in the fixed lists: cores, trades, forms.
TRADES = ["ceramics", "brewing", "forestry", "shipping", "carpets", "printing", "leather", "mining", "bakery", "cables", "candles", "ropes"]
FORMS = ["oyj", "kft", "sarl", "aps", "zrt", "dooel"]


def made_up_names(seed: int, entities: int):
    rng = random.Random(seed)
    part = lambda: rng.choice(["br", "kl", "sm", "tr", "v", "d", "st", "pl", "gr", "m"]) + rng.choice(["a", "e", "i", "o", "u", "ai", "ou"]) + rng.choice(["nd", "lk", "rt", "m", "st", "v", "ss", "nt"])
    seen, out = set(), []
    while len(seen) < entities:
        core, trade, form = part() + part() + rng.choice(["", "en", "or", "ik"]), rng.choice(TRADES), rng.choice(FORMS)
        if core in seen:
            continue
        seen.add(core)

        def spelling():
            c, t, f = core, trade, form
            kind = rng.choice(["plain", "upper", "order", "short", "slip", "none", "dots", "short upper"])
            if "short" in kind:
                t = t[: rng.randint(3, 5)] + "."
            if kind == "slip":
                i = rng.randint(1, len(c) - 2)
                c = rng.choice([c[:i] + c[i + 1 :], c[:i] + c[i] + c[i:], c[:i] + c[i + 1] + c[i] + c[i + 2 :]])
            words = [c.title(), t.title(), f.title()]
            if kind == "order":
                words = [words[1], words[0], words[2]]
            if kind == "none":
                words = words[:2]
            text = " ".join(words)
            return text.upper() if "upper" in kind else text.replace(" ", ",  ") if kind == "dots" else text

        out.append(sorted({f"{core.title()} {trade.title()} {form.title()}", *(spelling() for _ in range(rng.randint(1, 7)))}))
    return out


def test_recall_on_a_labelled_set_outside_the_lists(spark):
    truth = made_up_names(2, 600)
    owners = {}
    for i, names in enumerate(truth):
        for n in names:
            owners.setdefault(n, set()).add(i)
    want = {(a, b) for names in truth for a, b in itertools.combinations(names, 2)}
    got = {(a, b) for x in entity_sets(spark, [("assignee", n) for x in truth for n in x]) for a, b in itertools.combinations(x, 2)}
    right = {(a, b) for a, b in got if owners[a] & owners[b]}
    print("pairs", len(want), "recall", len(want & got) / len(want), "precision", len(right) / len(got))
    assert len(want & got) / len(want) >= 0.9 and len(right) / len(got) >= 0.97
