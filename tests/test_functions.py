"""Goldens of scalar functions."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.functions import timecode as C
from ledgerloom.functions.similarity import any_unlike, inventor_similarity, jaro_winkler, name_similarity, person_similarity


def value(spark, column, *given):
    df = spark.createDataFrame([given], ", ".join(f"c{i} {'string' if x is None or isinstance(x, str) else 'binary' if isinstance(x, bytes) else 'int'}" for i, x in enumerate(given)))
    return df.select(column.alias("x")).first()["x"]


def c_():
    return F.col("c0")


def c1_():
    return F.col("c1")


GOLDENS = [
    (lambda c, c1: X.to_ascii(c), ("Smaüblek",), "Smaublek"),
    (lambda c, c1: X.clean_name(c), ("Sma{umlaut over (u)}blek , Opt. (old)",), "SMAUBLEK OPT"),
    (lambda c, c1: X.clean_name(c, keep_gap=False), ("A.B. Co",), "AB CO"),
    (lambda c, c1: X.clean_place(c), ("TOWN OF Fóo-1234 (x), ",), "FOO"),
    (lambda c, c1: X.clean_city(c, c1), ("St. Gallen", "CH"), "SAINT GALLEN"),
    (lambda c, c1: X.clean_city(c, c1), ("Ft. Worth Hts", "us"), "FORT WORTH HEIGHTS"),
    (lambda c, c1: X.clean_city(c, c1), ("Muenchen", "DE"), "MUNCHEN"),
    (lambda c, c1: X.clean_city(c, c1), ("Lyon Cedex 07", "FR"), "LYON"),
    (lambda c, c1: X.clean_city(c, c1, provinces={"CA": {"ON|ONT|ONTARIO": "ONTARIO"}}), ("Ottawa, ON", "CA"), "OTTAWA,ONTARIO"),
    (lambda c, c1: X.clean_country(c, c1), ("CN", "Hong Kong"), "HK"),
    (lambda c, c1: X.clean_country(c, c1), ("SU", "x"), "RU"),
    (lambda c, c1: X.part_of(c, 1), ("a , b|c",), "b"),
    (lambda c, c1: X.part_of(c, 5), ("a",), ""),
    (lambda c, c1: X.reversed_prefix(c, 4), ("Berlin",), "NILR"),
    (lambda c, c1: X.letters_block(c), ("Alpha Beta Gamma Delta Eps",), "AlBeGaDe"),
    (lambda c, c1: X.letters_block(c), ("Alpha Beta",), "Alpha Beta"),
    (lambda c, c1: X.backwards_block(c, c), ("abcdefghij klmnopqrstuvwxyz",), "zyxwvutsrqponmlk jihgfedcb"[:25]),
    (lambda c, c1: X.pad_key(c), ("H12",), "H000000000012"),
    (lambda c, c1: X.patent_plain(c), ("RE0,012",), "RE12"),
    (lambda c, c1: X.patent_8(c), ("D-105",), "D0000105"),
    (lambda c, c1: X.patent_number(c, c1), ("D105", "US"), "D0000105"),
    (lambda c, c1: X.patent_number(c, c1), ("12/345", "US"), "12/345"),
    (lambda c, c1: X.patent_type(c), ("3000",), "U"),
    (lambda c, c1: X.hex_between("#000000", "#FF0000", F.lit(50)), ("",), "#7f0000"),
    (lambda c, c1: X.number_with_unit(c), ("0.70 mg/L",), 0.7),
    (lambda c, c1: X.number_with_unit(c), ("n/a",), None),
    (lambda c, c1: X.release_codes(c), ("H.4.1 and G.17, H.4.1",), ["H.4.1", "G.17"]),
    (lambda c, c1: X.path_segment(c), ("a/b/c",), "b"),
    (lambda c, c1: X.split_camel(c), ("AllDataHere",), "All Data Here"),
    (lambda c, c1: X.label_of(c), ("area_name",), "Area"),
    (lambda c, c1: X.category_code(c), ("7",), "007"),
    (lambda c, c1: X.html_inner(c, "p"), ("<p a='1'>x <b>y</b></p><p>z</p>",), "x <b>y</b>"),
    (lambda c, c1: X.decode_text(c), ("é".encode("latin-1"),), "é"),
    (lambda c, c1: X.decode_or_empty(c), ("é".encode("latin-1"),), ""),
    (lambda c, c1: C.survey_period(c, c1), ("1999", "M01"), "1999XX01"),
    (lambda c, c1: C.survey_period(c, c1), ("1999", "Q4"), "1999X4XX"),
    (lambda c, c1: C.survey_period(c, c1), ("1999", "S2"), "19992XXX"),
    (lambda c, c1: C.survey_period(c, c1), ("1999", "M13"), "1999XXXX"),
    (lambda c, c1: C.survey_period(c, c1), ("1999", "A1"), "1999XXXX"),
    (lambda c, c1: C.account_period(c), ("1929",), "1929XXX"),
    (lambda c, c1: C.account_period(c), ("1947-IV",), "19474XX"),
    (lambda c, c1: C.account_period(c), ("1959-Jan",), "1959X01"),
    (lambda c, c1: C.account_period(c), ("Line",), None),
    (lambda c, c1: C.income_period(c), ("2009.1",), "20091XX"),
    (lambda c, c1: C.last_of_range(c), ("1969-1999",), "1999"),
    (lambda c, c1: C.last_of_range(c), ("1969-",), None),
    (lambda c, c1: C.typed_date(c), ("1-Jan-49",), "20490101"),
    (lambda c, c1: C.typed_date(c), ("31-dec-50",), "19501231"),
    (lambda c, c1: C.typed_date(c), ("1/10/2001",), "2001-01-10"),
    (lambda c, c1: C.typed_date(c), ("20010110",), "2001-01-10"),
    (lambda c, c1: C.typed_date(c), ("soon",), "soon"),
]


def test_goldens(spark):
    columns = [f(*(F.lit(g) for g in (*given, None)[:2])).alias(f"x{i}") for i, (f, given, _) in enumerate(GOLDENS)]
    got = spark.range(1).select(*columns).first()
    assert {i: got[i] for i in range(len(GOLDENS))} == {i: want for i, (_, _, want) in enumerate(GOLDENS)}


def test_unknown_period_fails(spark):
    with pytest.raises(Exception, match="no period code"):
        value(spark, C.survey_period(c_(), c1_()), "1999", "M14")


def test_similarity():
    for a, b, want in [("MARTHA", "MARHTA", 0.961111), ("AB", "AC", 0.70), ("ABC", "ABCD", 0.933333), ("", "A", 0.0), ("x", "X", 1.0)]:
        assert round(jaro_winkler(a, b), 6) == want
    assert person_similarity("Smith, John", "Smith, Mary") == 0
    assert person_similarity("Smith, John", "Smith, John") == 1


def test_similarity_columns(spark):
    df = spark.createDataFrame([("MARTHA", "MARHTA"), (None, "A")], "c0 string, c1 string")
    assert [r[0] and round(r[0], 6) for r in df.select(name_similarity(c_(), c1_())).collect()] == [0.961111, None]
    assert df.select(inventor_similarity(c_(), c1_())).count() == 2
    names = spark.createDataFrame([("Smith, J|Smith, M",), ("Smith, J|Smith, J",)], "c0 string")
    assert [r[0] for r in names.select(any_unlike(c_())).collect()] == [True, False]


def test_footnotes_and_units(spark):
    assert tuple(value(spark, X.footnotes(c_()), "Wages 1/ 2/")) == ("Wages", ["1", "2"])
    assert tuple(value(spark, X.footnotes(c_()), "Wages 3")) == ("Wages 3", [])
    assert tuple(value(spark, X.unit_in_brackets(c_()), "GDP (millions)")) == ("GDP", "millions")
    assert tuple(value(spark, C.period_parts(c_()), "1999X4XX")) == (1999, None, 4, None)
