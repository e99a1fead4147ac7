"""Mapping of freely typed places to the entries of a reference list."""

from __future__ import annotations

import functools
import itertools
import math
import pickle
import re
import unicodedata
import uuid
from collections import OrderedDict, defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.skew import lookup_join
from ledgerloom.session import cut, release

# Postal codes and names of the states of the US.
STATES = {
    "AL": "alabama", "AK": "alaska", "AZ": "arizona", "AR": "arkansas", "CA": "california", "CO": "colorado", "CT": "connecticut",
    "DE": "delaware", "DC": "district of columbia", "FL": "florida", "GA": "georgia", "HI": "hawaii", "ID": "idaho", "IL": "illinois",
    "IN": "indiana", "IA": "iowa", "KS": "kansas", "KY": "kentucky", "LA": "louisiana", "ME": "maine", "MD": "maryland",
    "MA": "massachusetts", "MI": "michigan", "MN": "minnesota", "MS": "mississippi", "MO": "missouri", "MT": "montana",
    "NE": "nebraska", "NV": "nevada", "NH": "new hampshire", "NJ": "new jersey", "NM": "new mexico", "NY": "new york",
    "NC": "north carolina", "ND": "north dakota", "OH": "ohio", "OK": "oklahoma", "OR": "oregon", "PA": "pennsylvania",
    "RI": "rhode island", "SC": "south carolina", "SD": "south dakota", "TN": "tennessee", "TX": "texas", "UT": "utah",
    "VT": "vermont", "VA": "virginia", "WA": "washington", "WV": "west virginia", "WI": "wisconsin", "WY": "wyoming", "PR": "puerto rico",
}
# Other spellings of countries, folded (see fold).
COUNTRIES = {
    "US": ["usa", "u s", "u s a", "united states", "united states of america", "america"],
    "GB": ["uk", "u k", "united kingdom", "great britain", "england", "britain", "gbr"],
    "DE": ["germany", "deutschland", "deu", "ger", "fed rep germany"],
    "FR": ["france", "fra", "republique francaise"],
    "IT": ["italy", "italia", "ita"],
    "ES": ["spain", "espana", "esp"],
    "CH": ["switzerland", "schweiz", "suisse", "svizzera", "che", "swi"],
    "NL": ["netherlands", "the netherlands", "nederland", "holland", "nld"],
    "SE": ["sweden", "sverige", "swe"],
    "DK": ["denmark", "danmark", "dnk"],
    "CA": ["canada", "can"],
    "JP": ["japan", "nippon", "nihon", "jpn"],
    "KR": ["korea", "south korea", "rep of korea", "republic of korea", "korea republic of", "kor", "r o k", "rok"],
    "AT": ["austria", "osterreich", "aut"],
    "BE": ["belgium", "belgique", "belgie", "bel"],
    "CN": ["china", "p r china", "prc", "chn"],
    "TW": ["taiwan", "twn", "r o c"],
}
# Short forms of words in place names.
SHORT = {
    "st": "saint", "ste": "sainte", "ft": "fort", "mt": "mount", "mtn": "mountain", "n": "north", "s": "south", "e": "east", "w": "west",
    "no": "north", "so": "south", "nw": "new", "gt": "great", "gr": "great", "grv": "grove", "gr.": "grove", "vly": "valley", "vy": "valley",
    "hts": "heights", "hgts": "heights", "ht": "heights", "spgs": "springs", "spg": "springs", "spr": "springs", "sprs": "springs",
    "jct": "junction", "jctn": "junction", "jn": "junction", "junc": "junction", "pk": "park", "prk": "park", "fls": "falls", "fl": "falls",
    "riv": "river", "rvr": "river", "lk": "lake", "is": "island", "pt": "port", "bch": "beach", "ctr": "center", "vil": "village",
}
#: Words around a name that don't change what it denotes, and fields that denote nothing.
NOISE = {"city", "of", "town", "township", "twp", "village", "municipality", "county", "borough", "near", "the"}
NOTHING = {"", "unknown", "none", "none given", "not given", "na", "n a", "xxx", "same as above", "see above", "null", "various", "nil"}
_PLAIN = str.maketrans({"ø": "o", "Ø": "O", "æ": "ae", "Æ": "AE", "œ": "oe", "ß": "ss", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "þ": "th", "ı": "i", "'": "", "’": ""})


def fold(text: str | None) -> str:
    """Lower case without accents; signs become blanks, runs of blanks one."""
    if not text:
        return ""
    text = _mended(text).translate(_PLAIN)
    text = "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))
    return " ".join(re.sub(r"[\W_]+", " ", text.lower()).split())


def _mended(text: str) -> str:
    """Undo UTF-8 read as Latin-1 (or its Windows form), where that gives text again."""
    if any(c in text for c in "ÃÂÅÄ") and any("\x80" <= c <= "™" for c in text):
        for codec in ("cp1252", "latin-1"):
            try:
                return text.encode(codec).decode("utf-8")
            except UnicodeError:
                pass
    return re.sub(r"\{(?:[a-z]+ )*(?:over|above|under) \(?(\w+)\)?\}", r"\1", text)


def distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) from a to b; most + 1 if more than most."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    before, prev = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            c = min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                c = min(c, before[j - 2] + 1)
            cur.append(c)
        if min(cur) > most:
            return most + 1
        before, prev = prev, cur
    return min(prev[-1], most + 1)


def _deletes(word: str, most: int) -> set[str]:
    out, last = {word}, {word}
    for _ in range(most):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out |= last
    return out


#: Words that make another name of the one they stand beside, whether the reference list has them or not.
QUALIFIERS = {*SHORT.values()} | {"old", "upper", "lower", "little", "big", "san", "santa", "los", "las"}
_SHORTS: dict[str, list[str]] = defaultdict(list)
for _short, _long in SHORT.items():
    _SHORTS[_long].append(_short)
STATE_OF = {n: s for s, n in STATES.items()} | {s.lower(): s for s in STATES} | {" ".join(s.lower()): s for s in STATES}


class Place(NamedTuple):
    place_id: int
    name: str  # folded
    state: str
    country: str
    zipcode: str


class Mention(NamedTuple):
    """Words lo to hi (exclusive) of a reading spell a name or alias of the places; exact if letter for letter, blanks included."""

    lo: int
    hi: int
    size: int
    exact: bool
    places: tuple[Place, ...]


class Evidence(NamedTuple):
    """What a (part of a) reference list says about a typed value."""

    mentions: list[list[Mention]]  # for each reading, see readings
    similar: list[tuple[int, tuple[str, ...], Place]]  # cost, words of the value that pair with none of the name, place
    known: set[str]  # words of the value that are words of the list, or one edit from it

    def plus(self, other: Evidence) -> Evidence:
        return Evidence([a + b for a, b in zip(self.mentions, other.mentions, strict=True)], self.similar + other.similar, self.known | other.known)


def edits(word: str) -> int:
    """Edits allowed in a word."""
    return 0 if len(word) < 3 else 1 if len(word) < 7 else 2


def bare(words: Iterable[str]) -> list[str]:
    return [w for w in words if not w.isdigit() and w not in NOISE]


class Typed:
    """A typed place: its readings (words as they are; without noise and digits) and what its other fields hint at."""

    def __init__(self, city: str | None, state: str | None, country: str | None, zipcode: str | None, country_of: dict[str, str]) -> None:
        self.text, self.country_of = fold(city), country_of
        # parts between signs that don't stand inside names; the part each word is in
        parts = [fold(x).split() for x in re.split(r"[,;|/()\[\]]", _mended(city or ""))]
        words = [w for x in parts for w in x]
        self.part = [i for i, x in enumerate(parts) for _ in x]
        self.readings = [words, bare(words)]
        self.states, self.countries = self._hints(state, country)
        self.zipcode = zipcode or next(iter(re.findall(r"\d{4,}", city or "")), None)

    def _hints(self, state: str | None, country: str | None) -> tuple[set[str], set[str]]:
        """States and countries that the two fields may mean; either field may hold the other's value."""
        states, countries = set(), set()
        for value, is_state in ((state, True), (country, False)):
            x = fold(value)
            if not x:
                continue
            s, c = STATE_OF.get(x), self.country_of.get(x) or (self.country_of.get(x[:2]) if len(x) == 3 and x.endswith("x") else None)
            if is_state and s:
                states.add(s)
            elif not is_state and c:
                countries.add(c)
                if s and c != "US":  # a state in the field of the country
                    states.add(s)
            elif s:
                states.add(s)
            elif c:
                countries.add(c)
        return states, countries

    def without_regions(self, words: list[str], keep: tuple[int, int] | None = None) -> tuple[list[int], set[str], set[str]]:
        """Indexes of words, less a state or country at either end that agrees with the hints, and the hints with what
        those say where the fields give none. Words in the span `keep` stay."""
        left, states, countries = list(range(len(words))), self.states, self.countries
        for last in (True, False):
            for n in (4, 3, 2, 1):
                at = left[-n:] if last else left[:n]
                if len(at) < n or len(left) == n or (keep and any(keep[0] <= i < keep[1] for i in at)):
                    continue
                x = " ".join(words[i] for i in at)
                s, c = STATE_OF.get(x), self.country_of.get(x)
                if (s and (s in states or not states)) or (c and (c in countries or not countries)):
                    left = left[:-n] if last else left[n:]
                    if s and not states:
                        states = {s}
                    elif c and not s and not countries:
                        countries = {c}
                    break
        return left, states, countries


def fits(p: Place, states: set[str], countries: set[str]) -> bool:
    """No hint speaks against the place."""
    if p.state:  # of the US
        return (not states or p.state in states) and (not countries or p.country in countries or bool(states & {p.state}))
    return not countries or p.country in countries


def confirmed(p: Place, states: set[str], countries: set[str]) -> bool:
    """A hint speaks for the place, and none against it."""
    return fits(p, states, countries) and (p.state in states if p.state else p.country in countries)


def choose(places: Iterable[Place], states: set[str], countries: set[str], zipcode: str | None) -> int:
    """The one place that the hints leave; where they leave several, the postal code decides by its longest prefix; else -1."""
    left = sorted({p for p in places if fits(p, states, countries)})
    if len(left) > 1 and states:
        left = [p for p in left if p.state in states] or left
    if len(left) > 1:
        digits = re.sub(r"\D", "", zipcode or "")

        def common(p: Place) -> int:
            n = 0
            while n < min(len(p.zipcode), len(digits)) and p.zipcode[n] == digits[n]:
                n += 1
            return n

        best = max(map(common, left))
        closest = [p for p in left if common(p) == best]
        left = closest if best >= 2 and len(closest) == 1 else []
    return left[0].place_id if left else -1


def longest(mentions: list[Mention]) -> list[Mention]:
    """Mentions that don't overlap, taken longest first; of those over the same words the exact ones, if there are any."""
    spans: dict[tuple[int, int], list[Mention]] = defaultdict(list)
    for m in mentions:
        spans[m.lo, m.hi].append(m)
    out: list[Mention] = []
    for (lo, hi), same in sorted(spans.items(), key=lambda x: (-x[1][0].size, x[0])):
        if all(hi <= m.lo or m.hi <= lo for m in out):
            best = [m for m in same if m.exact] or same
            out.append(best[0]._replace(places=tuple(sorted({p for m in best for p in m.places}))))
    return out


def decide(typed: Typed, seen: Evidence) -> int:
    """place_id, or -1.

    In order: a mention that with noise, digits and codes of the place's region makes up the value; a name whose words
    pair with all words of the value; a mention, then a name, beside words that are no words of any name, if it is the
    only one and the hints confirm it. Beside a mention, only words of the same part (between commas and the like) count.
    """
    if typed.text in NOTHING:
        return -1
    for words, mentions in zip(typed.readings, seen.mentions, strict=True):
        chosen = longest(mentions)
        if len(chosen) == 1:
            m = chosen[0]
            left, states, countries = typed.without_regions(words, (m.lo, m.hi))
            if not bare(words[i] for i in left if not m.lo <= i < m.hi):
                return choose(m.places, states, countries, typed.zipcode)
    words = typed.readings[1]
    left, states, countries = typed.without_regions(words)
    whole = [(cost, p) for cost, rest, p in seen.similar if not rest and fits(p, states, countries)]
    if whole:
        return choose([p for c, p in whole if c == min(whole)[0]], states, countries, typed.zipcode)

    def foreign(rest: Iterable[str]) -> bool:
        """Whether the words have no part in any name of the list."""
        return not any(w in seen.known or SHORT.get(w, w) in QUALIFIERS for w in rest)

    chosen = longest(seen.mentions[0])
    if len(chosen) == 1:
        m = chosen[0]
        words = typed.readings[0]
        left, states, countries = typed.without_regions(words, (m.lo, m.hi))
        places = [p for p in m.places if confirmed(p, states, countries)]
        beside = {typed.part[i] for i in range(m.lo, m.hi)}
        if places and foreign(bare(words[i] for i in left if typed.part[i] in beside and not m.lo <= i < m.hi)):
            return choose(places, states, countries, typed.zipcode)
    elif not chosen:
        part = [(cost, p) for cost, rest, p in seen.similar if rest and confirmed(p, states, countries) and foreign(rest)]
        if part:
            return choose([p for c, p in part if c == min(part)[0]], states, countries, typed.zipcode)
    return -1


class Gazetteer:
    """Finds the places of (a part of) a reference list that a typed value may denote.

    An automaton over the folded names and their aliases (words in their short forms), all without blanks, finds the
    mentions that begin and end with words of the value, so blanks lost or put in don't matter. Beside it words are
    compared as sets: each word of a name with its closest word of the value, allowing for edits; all words of the name
    must pair, and the value's other words are told apart.
    """

    def __init__(self, rows: list[tuple], countries: Iterable[str] | None = None) -> None:
        """rows: (place_id, city, state, country, zipcode); countries: all codes of the list, if rows are only a part."""
        import ahocorasick

        self.places = [
            Place(r[0], fold(r[1]), (r[2] or "").strip().upper(), (r[3] or "").strip().upper(), (r[4] or "").strip()) for r in rows if r[0] is not None and fold(r[1])
        ]
        known = {p.country for p in self.places} if countries is None else set(countries)
        self.country_of = country_names(known)
        by_name: dict[str, list[Place]] = defaultdict(list)
        for p in sorted(self.places):
            by_name[p.name].append(p)
        patterns: dict[str, dict[str, None]] = defaultdict(dict)  # names by what they look like without blanks
        for name in by_name:
            for alias in itertools.product(*([w, *_SHORTS.get(w, ())] for w in name.split())):
                patterns["".join(alias)][name] = None
        self.by_name = by_name
        self.automaton = ahocorasick.Automaton()
        for x, names in patterns.items():
            self.automaton.add_word(x, (len(x), list(names)))
        if patterns:
            self.automaton.make_automaton()
        self.joined: dict[str, list[Place]] = defaultdict(list)
        for name, places in by_name.items():
            self.joined[name.replace(" ", "")] += places
        count: dict[str, int] = defaultdict(int)
        for name in by_name:
            for w in {*name.split()}:
                count[w] += 1
        self.rarest: dict[str, list[str]] = defaultdict(list)  # names by their rarest word
        for name in by_name:
            self.rarest[min(name.split(), key=lambda w: (count[w], w))].append(name)
        self.near_words, self.near_joined = _variants(count), _variants(self.joined)
        # a word longer than all of these by more than two letters is near none
        self.long_word, self.long_joined = (2 + max(map(len, x), default=-2) for x in (count, self.joined))
        self.close = functools.lru_cache(100_000)(self._close)

    def _close(self, word: str) -> dict[str, int]:
        """Words of the list within the edits that both words allow, with their distance."""
        if len(word) > self.long_word:
            return {}
        near = {v: distance(word, v, 2) for v in {v for x in _deletes(word, edits(word)) for v in self.near_words.get(x, ())}}
        return {v: d for v, d in near.items() if d <= min(edits(v), edits(word))}

    def _mentions(self, words: list[str]) -> list[Mention]:
        if not self.by_name or not words:
            return []
        ends = list(itertools.accumulate(map(len, words)))
        first = {0: 0} | {e: i + 1 for i, e in enumerate(ends)}  # word that begins at an offset
        out = []
        for end, (size, names) in self.automaton.iter("".join(words)):
            lo, hi = first.get(end + 1 - size), first.get(end + 1)
            if lo is not None and hi is not None:
                text = " ".join(words[lo:hi])
                out += [Mention(lo, hi, size, name == text, tuple(self.by_name[name])) for name in names]
        return out

    def _similar(self, words: list[str]) -> list[tuple[int, tuple[str, ...], Place]]:
        words = [SHORT.get(w, w) for w in words]
        close = {w: self.close(w) for w in {*words}}
        out = []
        for name in {n for c in close.values() for v in c for n in self.rarest.get(v, ())}:
            rest, cost = list(words), 0
            options = {t: [w for w in close if t in close[w]] for t in {*name.split()}}
            for t in sorted(name.split(), key=lambda t: len(options[t])):
                best = min(((close[w][t], w) for w in options[t] if w in rest), default=None)
                if best is None:
                    break
                rest.remove(best[1])
                cost += best[0]
            else:
                if cost <= 2 + (len(name.split()) > 2):
                    out += [(cost, tuple(rest), p) for p in self.by_name[name]]
        whole = "".join(words)
        if len(whole) <= self.long_joined:
            most = edits(whole)
            for v in {v for x in _deletes(whole, most) for v in self.near_joined.get(x, ())}:
                if (d := distance(whole, v, most)) <= most:
                    out += [(d, (), p) for p in self.joined[v]]
        return out

    def evidence(self, typed: Typed) -> Evidence:
        mentions = [self._mentions(words) for words in typed.readings]
        words = typed.readings[1]
        left, *_ = typed.without_regions(words)
        known = {w for w in {*words} if min((*self.close(w).values(), *self.close(SHORT.get(w, w)).values()), default=2) < 2}
        return Evidence(mentions, self._similar([words[i] for i in left]) if left else [], known)

    def find(self, city: str | None, state: str | None, country: str | None, zipcode: str | None) -> int:
        """place_id, or -1."""
        typed = Typed(city, state, country, zipcode, self.country_of)
        return -1 if typed.text in NOTHING else decide(typed, self.evidence(typed))


def country_names(codes: Iterable[str]) -> dict[str, str]:
    """Codes of countries by their folded names and themselves."""
    return {x: c for c, xs in COUNTRIES.items() for x in [*xs, c.lower()]} | {c.lower(): c for c in codes}


def _variants(words: Iterable[str]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = defaultdict(list)
    for w in words:
        for x in _deletes(w, edits(w)):
            out[x].append(w)
    return dict(out)


_BUILT: OrderedDict[str, Gazetteer] = OrderedDict()


def _gazetteer(token: str, rows: list[tuple], countries: list[str]) -> Gazetteer:
    """The worker's gazetteer of a broadcast list, built once for each; the last two are kept."""
    if token not in _BUILT:
        while len(_BUILT) > 1:
            _BUILT.popitem(last=False)
        _BUILT[token] = Gazetteer(rows, countries)
    return _BUILT[token]


FIELDS = ["__c", "__s", "__n", "__z"]


def _typed_rows(batch: pd.DataFrame) -> Iterator[tuple[str | None, ...]]:
    """Fields as typed, from their keys: `=` and the value, or '' for null."""
    return zip(*([x[1:] if x else None for x in batch[f]] for f in FIELDS), strict=True)


def match_places(rows: DataFrame, ref: DataFrame, city: str, state: str, country: str, zipcode: str, out: str = "place_id", slice_rows: int = 200_000) -> DataFrame:
    """rows with out: the place_id of ref that each row's fields denote, -1 for none or for several alike.

    Equal spellings are matched once: distinct fields are taken before the matching and joined back, hot spellings by
    broadcast. ref (place_id, city, state, country, zipcode) is counted and sent to the workers in slices of about
    slice_rows rows, one after the other; what each slice says about a value (mentions, similar names, known words) is
    put together before the decision, so the result doesn't depend on the number of slices.

    A null or blank city gives -1. Reference rows with a null id or name are skipped. An empty reference gives -1.
    """
    spark = rows.sparkSession
    listed = ref.select("place_id", "city", "state", "country", "zipcode")
    countries = sorted(r[0] for r in listed.select(F.upper(F.trim("country")).alias("c")).where(F.col("c") != "").distinct().collect())  # the world has few
    slices = max(1, math.ceil(listed.count() / slice_rows))
    keys = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")).alias(f) for c, f in zip((city, state, country, zipcode), FIELDS, strict=True)]
    keyed = cut(rows.select("*", *keys))
    # matching is much work for few bytes, so it gets the partitions of a full shuffle
    distinct = keyed.select(*FIELDS).distinct().repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    if slices > 1:
        distinct = cut(distinct)
    key_schema = ", ".join(f"{f} string" for f in FIELDS)

    def part(i: int) -> DataFrame:
        mine = listed if slices == 1 else listed.where(F.pmod(F.xxhash64("place_id"), F.lit(slices)) == i)
        shared, token = spark.sparkContext.broadcast([tuple(r) for r in mine.collect()]), uuid.uuid4().hex

        def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            g = _gazetteer(token, shared.value, countries)
            for batch in batches:
                if slices == 1:
                    yield batch[FIELDS].assign(**{out: [g.find(*x) for x in _typed_rows(batch)]})
                else:
                    yield batch[FIELDS].assign(seen=[pickle.dumps(g.evidence(Typed(*x, g.country_of))) for x in _typed_rows(batch)])

        return cut(distinct.mapInPandas(look, f"{key_schema}, {f'{out} int' if slices == 1 else 'seen binary'}"))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = country_names(countries)
        for batch in batches:
            seen = (functools.reduce(Evidence.plus, map(pickle.loads, x)) for x in batch["seen"])
            yield batch[FIELDS].assign(**{out: [decide(Typed(*x, names), e) for x, e in zip(_typed_rows(batch), seen, strict=True)]})

    parts = [part(i) for i in range(slices)]
    found = parts[0]
    if slices > 1:
        together = functools.reduce(DataFrame.unionByName, parts).groupBy(*FIELDS).agg(F.collect_list("seen").alias("seen"))  # one for each slice
        found = cut(together.mapInPandas(join, f"{key_schema}, {out} int"))
        release(distinct, *parts)
    return lookup_join(keyed, found, FIELDS).drop(*FIELDS)
