"""Cleaning of typed text: names, places, documents. All but NFKD are built-in expressions and stay in generated code."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _ascii(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(lambda x: None if x is None else x if x.isascii() else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


def to_ascii(c: Column) -> Column:
    """Compatibility decomposition with everything outside ASCII dropped. Null stays null."""
    return F.when(c.rlike(r"^\p{ASCII}*$"), c).otherwise(_ascii(c))


def replace_each(c: Column, *rules: tuple[str, str]) -> Column:
    """Regular-expression replacements, one after the other."""
    for pattern, by in rules:
        c = F.regexp_replace(c, pattern, by)
    return c


#: {UMLAUT OVER (A)} -> A
SPELLED_ACCENT = (r"\{[^}(]*\(([^)]*)\)[^}]*\}", "$1")


def clean_name(c: Column, strict: bool = True, keep_gap: bool = True, ascii_only: bool = True) -> Column:
    """Upper-case ASCII form of a name, one blank between words.

    Spelled-out accents become their letter and blanks before a comma, bar or dash go. strict also drops what stands in
    brackets and turns every other sign into a blank (keep_gap) or into nothing.
    """
    c = replace_each(F.upper(c), SPELLED_ACCENT, (r" *([,|-])", "$1"))
    if strict:
        c = replace_each(c, (r"\([^)]*\)|\{[^}]*\}", ""), (r"[^A-Za-z0-9 \x{80}-\x{10FFFF}]", " " if keep_gap else ""))
        if not ascii_only:
            c = F.regexp_replace(c, r"[^A-Za-z0-9 ]", " " if keep_gap else "")
    c = replace_each(c, (r"  +", " "), (r"([ ,|-])[ ,|-]+", "$1"))
    return F.trim(to_ascii(c) if ascii_only else c)


def clean_place(c: Column, ascii_only: bool = True) -> Column:
    """Upper-case form of a place name: no postal codes, digits, `TOWN OF`, bracketed remarks or stray signs."""
    c = replace_each(
        F.upper(c),
        SPELLED_ACCENT,
        (r"\b[A-Z]{1,5} ?-{0,2} ?[0-9]+\b|\b[0-9]+ ?-{1,2} ?[A-Z]{1,5}\b|\b[0-9]+[A-Z]{1,5}\b", ""),
        (r"[0-9]", ""),
        (r"\b[A-Z]+,? +I?OF ", ""),
        (r"\([^)]*\)", ""),
        (r"""[.()`'#"&]|-{2,}|/-""", ""),
        (r" *([,|-]) *", "$1"),
        (r"([ ,|-])[ ,|-]+", "$1"),
        (r"^[,|-]+|[,|-]+$", ""),
    )
    return F.trim(to_ascii(c) if ascii_only else c)


# Short words in US place names, as whole words.
US_WORDS = {
    "COLO": "COLORADO", "SPGS": "SPRINGS", "JCT": "JUNCTION", "JCTN": "JUNCTION", "MTN": "MOUNTAIN", "MT": "MOUNT", "HTS": "HEIGHTS", "HGTS": "HEIGHTS",
    "COUNTY": "", "GDNS": "GARDENS", "SLC": "SALT LAKE CITY", "LV": "LAS VEGAS", "SF": "SAN FRANCISCO", "TOWNSEND": "", "TOWNS": "", "TOWNSH": "", "TOWNSHI": "",
    "TOWNSHIP": "", "FT": "FORT", "N": "NORTH", "NO": "NORTH", "E": "EAST", "S": "SOUTH", "SO": "SOUTH", "W": "WEST", "U": "UPPER", "IS": "ISLAND", "PK": "PARK",
    "OKLA": "OKLAHOMA", "PO BOX": "",
}
# What is taken out of or unified in city names, by country, in order. Patterns over the result of clean_place.
CITY_RULES: dict[str, list[tuple[str, str]]] = {
    "AR": [(r"(CIUDAD|PROVINCIA)( DE)?", "")],
    "AT": [(r"(, ?|/)OSTERREICH", ""), (r"/| ?AN DER ?", ",")],
    "AU": [(r"\bMTN\b", "MOUNTAIN"), (r"\bMT\b", "MOUNT")],
    "BE": [(r"/| ?SUR ?", ",")],
    "BR": [(r"\bCITY[ ,]", "")],
    "CN": [(r"\bCITY[ ,]", "")],
    "DE": [(r"/| ?AN DER ?", ",")],
    "DK": [(r"^.*AARHUS.*$", "AARHUS"), (r"^.*\bCOPPENHAGEN\b.*$", "COPPENHAGEN")],
    "EI": [(r"\bCOUNTY\b", "")],
    "FR": [(r"/| ?SUR ?", ","), (r"\b(CEDEX|ALL)\b", "")],
    "GB": [(r"COUNTY( OF)?", ""), (r"SHIR+E", "SHIRE")],
    "HK": [(r",?\b(HK|HONG KONG)\b", "")],
    "JP": [(r"\bCITY[ ,]", ""), (r"ALL( OR)?|-?PREF(ECTURE)?", "")],
    "KR": [(r"-?(MEGA)?CITY", ""), (r"BUK|BOOK|BUKE|BOK", "BUG"), (r"[-,]? *(DO[ME]?|DU|DI)\b", "DO"), (r"\bCHEJU\b", "JEJU")],
    "LU": [(r"/| ?AN DER ?", ",")],
    "NL": [(r"AM(ER)?STERDA[MN]{0,2}", "AMSTERDAM")],
    "RU": [(r"\bCITY[ ,]", "")],
    "TW": [(r",?\b(TW|TAIWAN)\b", ""), (r"\b(AREA|INDUSTRIAL|TOWN|CITY|COUNTY|DIST(RICT)?|COUNTRY)\b", ""), (r"\bSHIEN\b", "HSIEN")],
    "US": [(r"^ST\b", "SAINT"), (r"^LA$", "LOS ANGELES"), *((rf"\b{a}\b", b) for a, b in US_WORDS.items())],
}
#: German spellings of umlauts become the plain vowel, but in names that hold one of these words.
KEEP_E = r"\b(ITZEHOE|AUE|EUE)\b"


def clean_city(city: Column, country: Column, ascii_only: bool = True, provinces: dict[str, dict[str, str]] | None = None) -> Column:
    """clean_place, then the rules of the row's country; ST means SAINT outside the US. Edge signs and runs of blanks go.

    provinces (country -> pattern -> name) puts the first that a city holds between commas.
    """
    c, ctry = clean_place(city, ascii_only), F.upper(F.trim(country))
    c = F.when(ctry == "US", c).otherwise(F.regexp_replace(c, r"\bST\b", "SAINT"))
    out = c
    for code, rules in CITY_RULES.items():
        by_rule = replace_each(c, *rules)
        if code == "DE":
            by_rule = F.when(c.rlike(KEEP_E), by_rule).otherwise(F.regexp_replace(by_rule, "([AOU])E", "$1"))
        out = F.when(ctry == code, by_rule).otherwise(out)
    for code, names in (provinces or {}).items():
        marked = out
        for pattern, name in reversed(names.items()):
            whole = rf"(?:^|[, ]+)(?:{pattern})(?=$|[, ])"
            marked = F.when(out.rlike(whole), F.regexp_replace(out, whole, f",{name},")).otherwise(marked)
        out = F.when(ctry == code, marked).otherwise(out)
    return F.trim(replace_each(out, (r"^[,|-]+|[,|-]+$", ""), (r"[- ]+", " "), (r",+", ",")))


def clean_country(country: Column, city: Column) -> Column:
    """Country codes as they are today; the city tells Hong Kong and Taiwan from China, and the capitals of old Yugoslavia."""
    c, place = F.trim(F.upper(country)), F.upper(city)
    return (
        F.when(c == "CS", "CZ")
        .when((c == "CN") & place.rlike(r"\b(HONG KONG|HK)\b"), "HK")
        .when((c == "CN") & place.rlike(r"\b(TAIWAN|TW)\b"), "TW")
        .when(c == "SU", "RU")
        .when(c == "USA", "US")
        .when((c == "YI") & place.rlike(r"\bBELGRAD\b"), "YU")
        .when((c == "HR") & place.rlike(r"\bZAGREB\b"), "YU")
        .when((c == "SI") & place.rlike(r"\bLJUBLJANA\b"), "YU")
        .otherwise(c)
    )


def part_of(c: Column, seq: int) -> Column:
    """The seq-th part between commas or bars, all of it for -1, '' if there is no such part."""
    return c if seq == -1 else F.coalesce(F.get(F.split(c, r" *[,|] *"), F.lit(seq)), F.lit(""))


def count_separators(c: Column) -> Column:
    return F.regexp_count(c, F.lit("[,|]"))


def without_blanks(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def reversed_prefix(c: Column, n: int) -> Column:
    """The first n letters of the upper-cased text read backwards: a key for blocking on endings."""
    return F.left(F.reverse(F.upper(c)), F.lit(n))


def backwards_block(c: Column, trimmed: Column, least: int = 25, words: int = 2) -> Column:
    """First `least` letters backwards of names with that length and number of words, else the name."""
    return F.when((F.length(c) >= least) & (F.size(F.split(c, " ")) >= words), F.left(F.reverse(c), F.lit(least))).otherwise(c)


def letters_block(c: Column, letters: int = 2, times: int = 2) -> Column:
    """The first letters of the first 8 / letters words of length times * letters or more, if there are so many; else the name."""
    n = 8 // letters
    words = F.filter(F.split(c, " "), lambda w: F.length(w) >= letters * times)
    return F.when(F.size(words) >= n, F.array_join(F.transform(F.slice(words, 1, n), lambda w: F.left(w, F.lit(letters))), "")).otherwise(c)


def generated_key(current: Column, external: Column, row: Column) -> Column:
    """The key there is; else A and the external number, else H and the row number, zero-padded to twelve digits."""
    pad = lambda x: F.lpad(x.cast("string"), 12, "0")
    return F.when(current != "", current).when(F.coalesce(external.cast("string"), F.lit("")) != "", F.concat(F.lit("A"), pad(external))).otherwise(F.concat(F.lit("H"), pad(row)))


def pad_key(c: Column, width: int = 12) -> Column:
    """A letter and digits as the letter and `width` digits, if it is shorter than that."""
    short = c.rlike(r"^[A-Za-z][0-9]+$") & (F.length(c) < width + 1)
    return F.when(short, F.concat(F.left(c, F.lit(1)), F.lpad(F.substr(c, F.lit(2)), width, "0"))).otherwise(c)


def patent_plain(c: Column) -> Column:
    """Letters, then the number without leading zeros."""
    plain = F.regexp_replace(c, "[^A-Za-z0-9]", "")
    return F.when(plain.rlike("^[A-Za-z]*[0-9]+$"), F.regexp_replace(plain, "^([A-Za-z]*)0*([0-9])", "$1$2")).otherwise(plain)


def patent_8(c: Column) -> Column:
    """Letters, then the number zero-padded to eight characters in all."""
    plain = patent_plain(c)
    letters = F.regexp_extract(plain, "^[A-Za-z]*", 0)
    digits = F.substr(plain, F.length(letters) + 1)
    width = F.greatest(F.lit(8), F.length(plain))
    return F.when(digits.rlike("^[0-9]+$"), F.concat(letters, F.lpad(digits, width - F.length(letters), "0"))).otherwise(plain)


def patent_number(c: Column, country: Column) -> Column:
    """US numbers padded to eight characters, but for applications (with a slash) and those of that length; others as they are."""
    letters, digits = F.regexp_extract(c, "[A-Z]+", 0), F.regexp_extract(c, "[0-9]+", 0)
    padded = F.concat(letters, F.lpad(digits, F.greatest(8 - F.length(letters), F.length(digits)), "0"))
    return F.when((country != "US") | c.contains("/") | (F.length(c) == 8), c).otherwise(padded)


def patent_type(c: Column) -> Column:
    """U for numbers, else the first letter."""
    return F.when(c.rlike("^[0-9]"), "U").otherwise(F.left(c, F.lit(1)))


def hex_between(a: str, b: str, percent: Column) -> Column:
    """Colour between two #rrggbb colours at a percentage, each channel rounded down."""
    parts = []
    for i in (1, 3, 5):
        x, y = int(a[i : i + 2], 16), int(b[i : i + 2], 16)
        parts.append(F.lpad(F.lower(F.hex((F.floor(F.lit(y - x) * percent / 100) + x).cast("long"))), 2, "0"))
    return F.concat(F.lit("#"), *parts)


def footnotes(c: Column, splitter: str = "/") -> Column:
    """struct(text, notes) of `text n/ m/`: markers after the text that end in the splitter, and may begin with it."""
    sign = "\\" + splitter
    mark = rf"\s*{sign}?([0-9]+(?:, ?[0-9]+)*){sign}"
    text = F.trim(F.regexp_replace(c, rf"(?:{mark})+\s*$", ""))
    notes = F.when(c.rlike(rf"{mark}\s*$"), F.regexp_extract_all(F.substr(c, F.length(F.rtrim(text)) + 1), F.lit(r"[0-9]+"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return F.struct(text.alias("text"), notes.alias("notes"))


def unit_in_brackets(c: Column) -> Column:
    """struct(name, unit) of `Name (unit)`, from the first opening to the last closing bracket; unit '' if there is none."""
    return F.struct(F.trim(F.regexp_replace(c, r"\(.*\)", "")).alias("name"), F.regexp_extract(c, r"\((.*)\)", 1).alias("unit"))


def number_with_unit(c: Column, unit: str = " mg/L") -> Column:
    """The number of a text with any of the unit's characters around it; null if that is none."""
    return F.btrim(c, F.lit(unit)).try_cast("double")


def release_codes(c: Column) -> Column:
    """Distinct codes of the form H.4.1 in their order."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"((?:[A-Z](?:\.[0-9]+)+)+)"), F.lit(1)))


def query_value(url: Column, key: str = "rel") -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(key))


def path_segment(url: Column, from_end: int = 2) -> Column:
    """Segment of a path counted from its end, from 1."""
    return F.try_element_at(F.split(url, "/"), F.lit(-from_end))


def squeeze(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def split_camel(c: Column) -> Column:
    """A blank before each capital after the first."""
    return F.regexp_replace(c, r"(?<=.)(?=[A-Z])", " ")


def label_of(c: Column) -> Column:
    """A column name as a label: without _name, _text or _code at its end, with a capital."""
    return F.initcap(F.replace(F.regexp_replace(c, "_(name|text|code)s?$", ""), F.lit("_"), F.lit(" ")))


def category_code(c: Column) -> Column:
    """Zero-padded to three characters, lower case."""
    return F.lower(F.when(F.length(c) < 3, F.lpad(c, 3, "0")).otherwise(c))


def html_inner(xml: Column, tag: str) -> Column:
    """Markup inside the first `tag` element, inner tags kept."""
    return F.regexp_extract(xml, rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)


def decode_text(c: Column) -> Column:
    """Binary as UTF-8 where it is valid, else as Latin-1."""
    return F.when(F.is_valid_utf8(c.cast("string")), c.cast("string")).otherwise(F.decode(c, "ISO-8859-1"))


def decode_or_empty(c: Column) -> Column:
    """Binary as UTF-8, '' where it isn't valid or null."""
    return F.coalesce(F.when(F.is_valid_utf8(c.cast("string")), c.cast("string")), F.lit(""))
