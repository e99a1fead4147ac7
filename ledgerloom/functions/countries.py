"""Countries and states of the US as they are typed, as codes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import clean_country, to_ascii

# Postal codes and names of the states of the US.
STATES = {
    "AL": "ALABAMA", "AK": "ALASKA", "AZ": "ARIZONA", "AR": "ARKANSAS", "CA": "CALIFORNIA", "CO": "COLORADO", "CT": "CONNECTICUT",
    "DE": "DELAWARE", "DC": "DISTRICT OF COLUMBIA", "FL": "FLORIDA", "GA": "GEORGIA", "HI": "HAWAII", "ID": "IDAHO", "IL": "ILLINOIS",
    "IN": "INDIANA", "IA": "IOWA", "KS": "KANSAS", "KY": "KENTUCKY", "LA": "LOUISIANA", "ME": "MAINE", "MD": "MARYLAND",
    "MA": "MASSACHUSETTS", "MI": "MICHIGAN", "MN": "MINNESOTA", "MS": "MISSISSIPPI", "MO": "MISSOURI", "MT": "MONTANA",
    "NE": "NEBRASKA", "NV": "NEVADA", "NH": "NEW HAMPSHIRE", "NJ": "NEW JERSEY", "NM": "NEW MEXICO", "NY": "NEW YORK",
    "NC": "NORTH CAROLINA", "ND": "NORTH DAKOTA", "OH": "OHIO", "OK": "OKLAHOMA", "OR": "OREGON", "PA": "PENNSYLVANIA",
    "RI": "RHODE ISLAND", "SC": "SOUTH CAROLINA", "SD": "SOUTH DAKOTA", "TN": "TENNESSEE", "TX": "TEXAS", "UT": "UTAH",
    "VT": "VERMONT", "VA": "VIRGINIA", "WA": "WASHINGTON", "WV": "WEST VIRGINIA", "WI": "WISCONSIN", "WY": "WYOMING", "PR": "PUERTO RICO",
}
# Other spellings of countries, without signs and accents.
COUNTRIES = {
    "US": ["USA", "U S", "U S A", "UNITED STATES", "UNITED STATES OF AMERICA", "AMERICA"],
    "GB": ["UK", "U K", "UNITED KINGDOM", "GREAT BRITAIN", "ENGLAND", "BRITAIN", "GBR"],
    "DE": ["GERMANY", "DEUTSCHLAND", "DEU", "GER", "FED REP GERMANY"],
    "FR": ["FRANCE", "FRA", "REPUBLIQUE FRANCAISE"],
    "IT": ["ITALY", "ITALIA", "ITA"],
    "ES": ["SPAIN", "ESPANA", "ESP"],
    "CH": ["SWITZERLAND", "SCHWEIZ", "SUISSE", "SVIZZERA", "CHE", "SWI"],
    "NL": ["NETHERLANDS", "THE NETHERLANDS", "NEDERLAND", "HOLLAND", "NLD"],
    "SE": ["SWEDEN", "SVERIGE", "SWE"],
    "DK": ["DENMARK", "DANMARK", "DNK"],
    "CA": ["CANADA", "CAN"],
    "JP": ["JAPAN", "NIPPON", "NIHON", "JPN"],
    "KR": ["KOREA", "SOUTH KOREA", "REP OF KOREA", "REPUBLIC OF KOREA", "KOREA REPUBLIC OF", "KOR", "R O K", "ROK"],
    "AT": ["AUSTRIA", "OSTERREICH", "AUT"],
    "BE": ["BELGIUM", "BELGIQUE", "BELGIE", "BEL"],
    "CN": ["CHINA", "P R CHINA", "PRC", "CHN"],
    "TW": ["TAIWAN", "TWN", "R O C"],
}


def _coded(c: Column, codes: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in codes.items() for x in kv)), c)


def _plain(c: Column) -> Column:
    """Upper case without accents; other signs are one blank."""
    return F.trim(F.regexp_replace(to_ascii(F.upper(c)), "[^A-Z]+", " "))


def _bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c), with c computed once however often f uses it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def state_code(state: Column) -> Column:
    """The code of a state of the US, null if it is none."""
    codes = {x: x for x in STATES} | {x: s for s, x in STATES.items()} | {" ".join(x): x for x in STATES}
    return _coded(_plain(state), codes)


def country_code(country: Column, city: Column) -> Column:
    """Today's code of a country typed as code, code and X, or name; US for a state of the US whose code is no country's;
    other texts as they are, null for blank ones."""
    codes = {s: "US" for s in [*STATES, *STATES.values()]} | {x: k for k, xs in COUNTRIES.items() for x in [k, f"{k}X", " ".join(k), *xs]}
    code = _bound(_plain(country), lambda c: F.when(c != "", F.coalesce(_coded(c, codes), c)))
    return _bound(code, lambda c: clean_country(c, city))
