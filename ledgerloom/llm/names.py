"""Variant spellings of persons and organisations, linked by merging and matching again."""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.places import distance, fold
from ledgerloom.session import cut, release

# Legal forms by their spellings, folded and without blanks.
LEGAL = {
    "ag": ["ag", "aktiengesellschaft"],
    "gmbh": ["gmbh", "gesellschaftmbh", "gesellschaftmitbeschrankterhaftung", "mbh"],
    "sa": ["sa", "societeanonyme", "sociedadanonima"],
    "kk": ["kk", "kabushikikaisha", "kabushikigaisha"],
    "inc": ["inc", "incorporated", "incorporation"],
    "corp": ["corp", "corporation"],
    "co": ["co", "company", "comp", "cie"],
    "ltd": ["ltd", "limited"],
    "llc": ["llc", "limitedliabilitycompany"],
    "plc": ["plc", "publiclimitedcompany"],
    "nv": ["nv", "naamlozevennootschap"],
    "bv": ["bv", "beslotenvennootschap"],
    "spa": ["spa", "societaperazioni"],
    "ab": ["ab", "aktiebolag"],
    "as": ["as", "aktieselskab"],
}
# Words of fields of business, with their short forms.
FIELDS = {
    "aviation": ["avn"], "chemical": ["chem", "chemicals"], "electric": ["elec", "electrical", "elect"], "electronic": ["electronics"],
    "energy": [], "foods": ["food"], "glass": [], "instrument": ["instr", "instruments", "inst"], "medical": ["med"], "motor": ["motors"],
    "optical": ["opt", "optics"], "paper": [], "petroleum": ["petrol", "petr"], "pharma": ["pharmaceutical", "pharmaceuticals", "pharm"],
    "plastics": ["plastic"], "power": [], "rubber": [], "semiconductor": ["semicond", "semiconductors", "semicon"], "software": ["softw"],
    "steel": [], "telecom": ["telecommunications"], "textile": ["text", "textiles"], "tool": ["tools"],
}
# Words of kinds of activity, with their short forms.
ACTIVITIES = {
    "devices": ["dev", "device"], "engineering": ["engrg", "eng", "engng", "engg"], "holdings": ["holding"], "industries": ["ind", "inds", "industry"],
    "international": ["intl", "int"], "laboratories": ["labs", "lab", "laboratory"], "manufacturing": ["mfg", "manuf", "manufg"],
    "products": ["prod", "prods", "product"], "research": ["res", "rsch"], "services": ["svc", "svcs"], "solutions": [],
    "systems": ["sys", "syst", "system"], "technologies": ["tech", "techs", "technology", "technol"], "works": ["work", "wks"],
}
# Short forms of given names.
NICKNAMES = {
    "al": "albert alan alfred alexander", "alex": "alexander", "andy": "andrew", "abby": "abigail", "art": "arthur", "barb": "barbara",
    "becky": "rebecca", "ben": "benjamin", "bert": "albert robert herbert", "beth": "elizabeth", "betsy": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert",
    "bobby": "robert", "carl": "carla", "cathy": "catherine", "charlie": "charles", "chas": "charles", "chris": "christopher christine", "chuck": "charles",
    "cindy": "cynthia", "dan": "daniel", "danny": "daniel", "dave": "david", "deb": "deborah", "debbie": "deborah", "dick": "richard", "don": "donald",
    "doug": "douglas", "ed": "edward edwin", "eddie": "edward", "eliza": "elizabeth", "fred": "frederick", "gene": "eugene", "geoff": "geoffrey",
    "gerry": "gerald", "greg": "gregory", "hal": "harold henry", "hank": "henry", "harry": "harold henry", "isa": "isabel", "jack": "john", "jake": "jacob",
    "jeff": "jeffrey", "jerry": "gerald jerome", "jim": "james", "jimmy": "james", "joe": "joseph", "jon": "jonathan", "josh": "joshua", "kate": "katarina catherine", "kathy": "catherine",
    "katy": "catherine", "ken": "kenneth", "kim": "kimberly", "larry": "lawrence", "len": "leonard", "lenny": "leonard", "leo": "leonard", "liz": "elizabeth", "maggie": "margaret",
    "marge": "margaret", "matt": "matthew", "meg": "margaret", "mike": "michael", "mick": "michael", "nan": "nancy", "nat": "nathaniel", "nate": "nathaniel", "nick": "nicholas",
    "olly": "oliver", "ollie": "oliver", "pat": "patricia patrick", "patty": "patricia", "peggy": "margaret", "pete": "peter", "phil": "philip", "ray": "raymond", "rich": "richard",
    "rick": "richard", "rob": "robert", "ron": "ronald", "sam": "samuel samantha", "sandy": "sandra", "steve": "stephen steven", "sue": "susan", "ted": "edward theodore",
    "terry": "terence", "theo": "theodore", "tim": "timothy", "tom": "thomas", "tommy": "thomas", "tony": "anthony", "tricia": "patricia", "trish": "patricia", "ulla": "ursula", "vicky": "victoria",
    "vic": "victor victoria", "vince": "vincent", "vin": "vincent", "walt": "walter", "wally": "walter", "will": "william", "wolf": "wolfgang", "zack": "zachary",
}
#: Words that say nothing of who someone is.
TITLES = {"dr", "prof", "professor", "mr", "mrs", "ms", "sir", "ing", "dipl"}
SUFFIXES = {"jr", "sr", "ii", "iii", "iv", "phd", "md", "esq"}
FILLERS = {"the", "and", "of", "for", "america", "usa"}

_WORD = {s: ("legal", k) for k, v in LEGAL.items() for s in v} | {s: ("field", k) for k, v in FIELDS.items() for s in [k, *v]} | {s: ("activity", k) for k, v in ACTIVITIES.items() for s in [k, *v]}
#: Neighbours of each key on the usual keyboard, for slips of the finger.
_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
_NEAR = defaultdict(set)
for _r, _row in enumerate(_ROWS):
    for _i, _c in enumerate(_row):
        for _rr in (_r - 1, _r, _r + 1):
            if 0 <= _rr < 3:
                for _j in (_i - 1, _i, _i + 1):
                    if 0 <= _j < len(_ROWS[_rr]) and _ROWS[_rr][_j] != _c:
                        _NEAR[_c].add(_ROWS[_rr][_j])
_NEAR = {c: frozenset(x) for c, x in _NEAR.items()}


@functools.lru_cache(100_000)
def _word(w: str) -> tuple[str, str] | None:
    """Kind and canonical form of a word of business, allowing for one edit in longer words."""
    if w in _WORD:
        return _WORD[w]
    if len(w) >= 5:
        for s, kind in _WORD.items():
            if len(s) >= 5 and s[0] == w[0] and distance(w, s, 1) <= 1:
                return kind
        for s, kind in _WORD.items():
            if len(s) >= 5 and distance(w, s, 1) <= 1:
                return kind
    return None


def _words(name: str) -> list[str]:
    """Folded words; single letters in a row (g m b h) become one word."""
    out: list[str] = []
    letters = False
    for w in fold(name.replace("&", " and ")).split():
        if len(w) == 1 and letters:
            out[-1] += w
        else:
            out.append(w)
        letters = len(w) == 1
    return out


def parse_organisation(name: str) -> tuple[str, str, str, str, str] | None:
    """(`org`, core, field, activity, legal form) of a name with at least one word of business; else None."""
    got = _organisation(name)
    return got and got[:-1]


def _organisation(name: str) -> tuple[str, str, str, str, str, str] | None:
    """What parse_organisation gives, and the words of the core with blanks between them."""
    parts: dict[str, list[str]] = {"field": [], "activity": [], "legal": []}
    core: list[str] = []
    words = _words(re.sub(r"(?<=[a-zß-ÿ]{3})(?=[A-ZÀ-Þ][a-zß-ÿ]{3})", " ", name))
    i = 0
    while i < len(words):
        pair = "".join(words[i : i + 2])
        kind = _word(pair) if i + 1 < len(words) and pair in _WORD else None
        if kind:
            i += 1
        else:
            kind = _word(words[i])
        if kind:
            parts[kind[0]].append(kind[1])
        elif words[i] not in FILLERS:
            core.append(words[i])
        i += 1
    whole = []
    for w in core:  # a blank lost between two words
        for s in sorted((s for s, k in _WORD.items() if k[0] != "legal" and len(s) >= 5), key=len, reverse=True):
            if len(w) > len(s) + 2 and (w.endswith(s) or w.startswith(s)):
                parts[_WORD[s][0]].append(_WORD[s][1])
                w = w[: -len(s)] if w.endswith(s) else w[len(s) :]
                break
        whole.append(w)
    if not any(parts.values()):
        return None
    one = lambda xs: " ".join(sorted(set(xs)))
    legal = [x for x in parts["legal"] if x != "co"] or parts["legal"]
    return "org", "".join(whole) or one(parts["field"] + parts["activity"]), one(parts["field"]), one(parts["activity"]), one(legal), " ".join(whole)


def parse_person(last: str, first: str) -> tuple[str, str, str, str, str] | None:
    """(`person`, last name, first name or initial, middle initials, ``) without titles and suffixes; None if there is no name."""
    if not first.strip() and "," in last:
        head, _, tail = last.partition(",")
        if fold(tail) and not set(_words(tail)) <= SUFFIXES:
            last, first = head, tail
    if re.fullmatch(r"\s*[A-Z]{2}\s*", first) and not last.isupper():  # initials without points
        first = ". ".join(first.strip())
    lasts = [w for w in fold(last.replace("Ph.D", "phd")).split() if w not in SUFFIXES]
    firsts = [w for w in fold(first).split() if w not in TITLES and w not in SUFFIXES]
    if not lasts and not firsts:
        return None
    return "person", "".join(lasts), firsts[0] if firsts else "", "".join(w[0] for w in firsts[1:]), ""


def swapped(name: str) -> tuple[str, str, str]:
    """Last name, first name and initials of `last|first` if it was typed the other way round; '' where that can't be."""
    first, _, last = name.partition("|")
    words = [w for w in fold(first).split() if w not in TITLES and w not in SUFFIXES]
    if "," in first or not words or len(words[0]) < 2 or any(len(w) > 1 for w in words[1:]):
        return "", "", ""
    return "".join(w for w in fold(last).split() if w not in SUFFIXES), words[0], "".join(words[1:])


KEYS = ["kind", "k1", "k2", "k3", "k4", "s1", "s2", "s3", "w"]
FEATURES = "src string, name string, " + ", ".join(f"{k} string" for k in KEYS)


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Profiles of names: kind, parts (k1 to k4), a person's parts typed the other way round (s1 to s3), words of an
    organisation's core (w; for a person between commas, who may be an organisation, the words in alphabetical order as one)."""
    for df in batches:
        rows = []
        for src, name in zip(df["src"], df["name"], strict=True):
            turned, words = ("", "", ""), ""
            if src == "assignee":
                got = _organisation(name)
                if got:
                    got, words = got[:-1], got[-1]
                elif "," in name:
                    got = parse_person(name, "")
                    words = "".join(sorted({*_words(name)}))
                elif fold(name):
                    got = ("org", "".join(_words(name)), "", "", "")
                    words = " ".join(w for w in _words(name) if w not in FILLERS)
            else:
                last, _, first = name.partition("|")
                got, turned = parse_person(last, first), swapped(name)
            if got:
                rows.append((src, name, *got, *turned, words))
        yield pd.DataFrame(rows, columns=["src", "name", *KEYS])


def _key(kind: str, *parts: str | Column) -> Column:
    """A block: its kind, and what its members share. Parts are folded, so none holds the separator."""
    return F.concat_ws("\x01", F.lit(kind), *(F.col(p) if isinstance(p, str) else p for p in parts))


# ---- what the corpus says about words: short forms, words left out


def _learn(f: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the corpus says about organisations with two or more words in their core: (links (a, b), forms).

    Two profiles that differ in one word, where one word is a short form of the other (its beginning from three letters
    on, or its first, last and some letters between in their order), are one, if the long word isn't the rarest of its
    name: what names differ in by its rarest word are different names. A short form that stands so for one long word in
    three or more different names stands for it everywhere.

    forms has p, ks (the core as one word: with its words in alphabetical order, and with long forms), ws (a key of its
    words as a set) and rest (that key without the last word, if that isn't the rarest). A set of words is known by the
    exclusive or of two hashes of each and its size, so a name of any length gives one key for each of its words.
    """
    hashes = lambda x: (F.xxhash64(x), F.xxhash64(F.lit("second"), x))
    words = F.array_distinct(F.split("w", " "))
    g = f.where("kind = 'org'").withColumn("xs", words).where(F.size("xs") > 1)
    tokens = cut(g.select("e", "p", "src", "k2", "k3", "k4", F.element_at(F.split("w", " "), -1).alias("last"), F.explode("xs").alias("x")))
    uses = tokens.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    tokens_n = tokens.join(uses, "x")
    h1, h2 = hashes(F.col("x"))
    sets = tokens_n.groupBy("p").agg(F.bit_xor(h1).alias("h1"), F.bit_xor(h2).alias("h2"), F.count(F.lit(1)).alias("size"), F.slice(F.array_sort(F.collect_list(F.struct("n", "x"))), 1, 2).alias("rare"))
    listed = cut(tokens_n.join(sets, "p"))
    others = F.when(F.col("rare")[0]["x"] == F.col("x"), F.col("rare")[1]["n"]).otherwise(F.col("rare")[0]["n"])
    rest = F.concat_ws("/", F.col("h1").bitwiseXOR(h1).cast("string"), F.col("h2").bitwiseXOR(h2).cast("string"), (F.col("size") - 1).cast("string"))
    holes = cut(listed.select("e", "p", "x", _key("hole", "src", "k2", "k3", "k4", rest).alias("hole"), (F.col("n") >= others).alias("common"), (F.col("x") == F.col("last")).alias("is_last"), rest.alias("rest")))
    tags = F.array(F.concat(F.lit("begins "), F.left("x", F.lit(3))), F.concat(F.left("x", F.lit(1)), F.right("x", F.lit(1))))
    tagged = holes.select("e", "x", "hole", "common", F.explode(tags).alias("tag"))
    long, short = tagged.where("common").select("hole", "tag", F.col("e").alias("a"), F.col("x").alias("long")), tagged.select("hole", "tag", F.col("e").alias("b"), F.col("x").alias("short"))
    inside = F.concat(F.lit("^"), F.regexp_replace("short", "(.)", "$1.*"))
    is_short = (F.length("short") > 1) & (F.length("short") < F.length("long")) & F.when(F.col("tag").startswith("begins"), (F.length("short") > 2) & F.startswith("long", "short")).otherwise(F.rlike("long", inside))
    pairs = cut(long.join(short, ["hole", "tag"]).where("a <> b").where(is_short).select("hole", "short", "long", "a", "b").distinct())
    one = pairs.groupBy("hole", "short").agg(F.max("long").alias("long"), F.min("long").alias("a")).where("startswith(long, a)").drop("a")
    links = cut(pairs.join(one, ["hole", "short", "long"]).select("a", "b").distinct())
    counted = pairs.groupBy("short", "long").agg(F.count_distinct("hole").alias("n")).where("n > 2")
    stands = counted.groupBy("short").agg(F.max("long").alias("long"), F.min("long").alias("a")).where("startswith(long, a)").select(F.col("short").alias("x"), "long")
    again = listed.select("p", "x").join(stands, "x", "left").groupBy("p").agg(
        F.array_join(F.array_sort(F.collect_list("x")), "").alias("k_sorted"), F.array_join(F.array_sort(F.collect_list(F.coalesce("long", "x"))), "").alias("k_long")
    )
    lasts = holes.where("is_last AND common").groupBy("p").agg(F.min("rest").alias("rest"))
    whole = F.concat_ws("/", F.col("h1").cast("string"), F.col("h2").cast("string"), F.col("size").cast("string"))
    forms = sets.select("p", F.when(F.col("size") > 1, whole).alias("ws"), F.col("size").alias("n_words")).join(again, "p").join(lasts, "p", "left")
    forms = cut(forms.select("p", F.array("k_sorted", "k_long").alias("ks"), "ws", F.when(F.col("n_words") > 2, F.col("rest")).alias("rest")))
    release(tokens, listed, holes, pairs)
    return links, forms


# ---- blocks


def _nicknames() -> Column:
    """The long forms a given name (k2) may stand for, from the fixed list."""
    pairs = [x for n, xs in NICKNAMES.items() for x in (F.lit(n), F.array(*map(F.lit, xs.split())))]
    return F.try_element_at(F.create_map(*pairs), F.col("k2"))


def _row(when: Column, key: Column, role: str, blank: Column | None = None, v: str | None = None, w: str | None = None, rule: int = 0, want_blank: bool = False) -> Column:
    """A profile's entry in a block, null unless `when`. Roles: `member` (linked with the others), `target` (only found), `seeker` (finds)."""
    none = F.lit(None).cast("string")
    col = lambda x: none if x is None else F.nullif(F.col(x), F.lit(""))
    entry = F.struct(
        key.alias("key"), F.lit(role).alias("role"), (blank if blank is not None else F.lit(False)).alias("blank"), col(v).alias("v"), col(w).alias("w"), F.lit(rule).alias("rule"), F.lit(want_blank).alias("want_blank")
    )
    return F.when(when, entry)


def _agree(x: str) -> Column:
    """Aggregate: at most one distinct value of x that isn't null, known by 128 bits, so that the aggregate can hash."""
    h = lambda *salt: F.when(F.col(x).isNotNull(), F.xxhash64(*salt, x))
    one, two = h(), h(F.lit("second"))
    return F.coalesce((F.min(one) == F.max(one)) & (F.min(two) == F.max(two)), F.lit(True))


def _entries(f: DataFrame) -> DataFrame:
    """All profiles' entries in all blocks: e, key, role, blank, v, w, rule, want_blank."""
    org, person = F.col("kind") == "org", F.col("kind") == "person"
    core = F.col("core")
    orgs = [
        _row(org, _key("org", "src", core, "k2", "k4", "k3"), "member"),
        _row(org, _key("activity left out", "src", core, "k2", "k4"), "member", v="k3"),
        _row(org, _key("form left out", "src", core, "k2"), "member", v="k3", w="k4"),
    ]
    left = [
        _row(org & F.col("ws").isNotNull(), _key("word left out", "src", "ws", "k2", "k3", "k4"), "seeker", rule=1),
        _row(org & F.col("rest").isNotNull(), _key("word left out", "src", "rest", "k2", "k3", "k4"), "target"),
    ]
    full, short, none = person & (F.length("k2") > 1), person & (F.length("k2") == 1), person & (F.col("k2") == "")
    blank = F.col("m") == ""
    initial = F.left("k2", F.lit(1))
    named, name = _key("person", "src", "k1", "k2", "m"), _key("name", "src", "k1", "k2")
    people = [
        _row(full | short, named, "member"),
        _row(full, name, "member", blank, v="m"),
        _row(full, _key("initials", "src", "k1", initial, "m"), "target"),
        _row(full, _key("initial", "src", "k1", initial), "target", blank),
        _row(none, _key("last name", "src", "k1"), "member"),
        # an initial stands for the only person it fits, with the same middle initials or none
        _row(short & ~blank, _key("initials", "src", "k1", "k2", "m"), "seeker", rule=2),
        _row(short & ~blank, _key("initial", "src", "k1", "k2"), "seeker", rule=3, want_blank=True),
        _row(short & blank, _key("initial", "src", "k1", "k2"), "seeker", rule=4),
    ]
    turned = person & (F.col("s1") != "") & (F.col("s1") != F.col("k1"))
    people += [  # first and last name typed the other way round
        _row(turned, _key("person", "src", "s1", "s2", "s3"), "seeker", rule=5),
        _row(turned, _key("name", "src", "s1", "s2"), "seeker", rule=6),
    ]
    # what looks like `last name, first name` is an organisation if one without a comma has the same words
    people.append(_row(person & (F.col("w") != ""), _key("org", "src", "w", F.lit(""), F.lit(""), F.lit("")), "seeker", rule=10))
    long = F.col("long")
    nicks = [  # a short form of a given name stands for the only long form there is
        _row(full, _key("person", "src", "k1", long, "m"), "seeker", rule=7),
        _row(full & blank, _key("name", "src", "k1", long), "seeker", rule=8),
        _row(full & ~blank, _key("name", "src", "k1", long), "seeker", rule=9, want_blank=True),
    ]

    def made(df: DataFrame, entries: list[Column]) -> DataFrame:
        return df.select("e", F.explode(F.array_compact(F.array(*entries))).alias("x")).select("e", "x.*")

    cores = f.where(org).withColumn("core", F.explode(F.array_distinct(F.concat(F.array("k1"), F.coalesce("ks", F.array().cast("array<string>"))))))
    nicked = f.where(full).withColumn("long", F.explode(_nicknames()))
    parts = [made(cores, orgs), made(f.where(F.col("ws").isNotNull()), left), made(f.where(person), people), made(nicked, nicks)]
    return reduce(DataFrame.unionByName, parts)


def _block_links(f: DataFrame) -> DataFrame:
    """Links (a, b) of all rules in which profiles agree: one aggregate over the blocks, joined back to their entries.

    Members of a block are linked with its smallest entity, if no two of them contradict each other in v or w; a seeker
    with the block's only entity, if all it finds by a rule is one. After the first round only blocks are looked at that
    hold, or held, a profile whose entity or initials the last merge changed: the others give what they gave before.
    """
    entries = _entries(f)
    if "m0" in f.columns and (n := f.agg(F.count_if("moved").alias("moved"), F.count(F.lit(1)).alias("all")).first())["moved"] * 4 < n["all"]:  # else nearly all blocks are
        moved = f.where("moved")
        touched = _entries(moved).select("key").unionByName(_entries(moved.withColumn("m", F.col("m0"))).select("key")).distinct()
        entries = entries.join(touched, "key", "left_semi")
    entries = cut(entries)
    found, empty = F.col("role") != "seeker", F.col("blank")
    e = lambda cond: F.when(cond, F.col("e"))
    stats = entries.groupBy("key").agg(
        F.min(e(found)).alias("lead"), F.max(e(found)).alias("top"), F.min(e(found & empty)).alias("lead0"), F.max(e(found & empty)).alias("top0"),
        _agree("v").alias("v_one"), _agree("w").alias("w_one"),
        F.bool_or(~found).alias("sought"),
    ).select("key", "lead", "top", "lead0", "top0", (F.col("v_one") & F.col("w_one")).alias("agree"), "sought").where("lead IS NOT NULL AND (sought OR (agree AND lead <> top))")
    hits = entries.where("role <> 'target'").select("e", "key", "role", "rule", "want_blank").join(stats, "key")
    star = (F.col("role") == "member") & F.col("agree")
    a = F.when(star, F.col("lead")).when((F.col("role") == "seeker") & F.col("want_blank"), F.when(F.col("lead0") == F.col("top0"), F.col("lead0"))).when(F.col("role") == "seeker", F.when(F.col("lead") == F.col("top"), F.col("lead")))
    hits = cut(hits.select("rule", a.alias("a"), F.col("e").alias("b")).where("a IS NOT NULL"))
    release(entries)
    one = hits.where("rule > 0").groupBy("rule", "b").agg(F.min("a").alias("a"), F.max("a").alias("z")).where("a = z")
    return hits.where("rule = 0").select("a", "b").unionByName(one.select("a", "b")).where("a <> b").distinct()


# ---- slips


def _near(a: Column, b: Column) -> Column:
    """Whether two words that are alike without one letter (word, at, ch: the letter that went, at -1 none) are a slip apart:
    a letter too many or too few, two neighbours swapped, or a neighbouring key hit."""
    whole = (a["at"] < 0) != (b["at"] < 0)
    keys = F.instr(F.lit(_BESIDE), F.concat(F.lit(" "), a["ch"], b["ch"], F.lit(" "))) > 0
    return whole | ((a["at"] >= 0) & (b["at"] >= 0) & (((a["at"] == b["at"]) & keys) | ((F.abs(a["at"] - b["at"]) == 1) & (a["ch"] == b["ch"]))))


_BESIDE = " " + "  ".join(a + b for a, near in sorted(_NEAR.items()) for b in sorted(near)) + " "


def _slip_members(f: DataFrame) -> DataFrame:
    """(block, x, y, is_x, p, wx, wy): the profiles (p) of words x and y one slip apart in the same block; is_x tells which.

    Words don't change from round to round, so this is found once. The distinct words of a block meet where deleting one
    letter leaves the same; those that can meet are made by putting a letter into one word, a bounded number. wx and wy
    are the names whose bearers decide whether a slip is likely, null for organisations.
    """
    org, full = f.where("kind = 'org'"), f.where((F.col("kind") == "person") & (F.length("k2") > 1))
    nicked = full.withColumn("k2", F.explode(_nicknames()))
    none = F.lit(None).cast("string")
    rows = [
        org.select(_key("core", "src", "k2").alias("block"), F.col("k1").alias("word"), "p", none.alias("who")),
        full.unionByName(nicked).select(_key("last", "src", "k2").alias("block"), F.col("k1").alias("word"), "p", _key("last", "src", "k1").alias("who")),
        full.select(_key("first", "src", "k1").alias("block"), F.col("k2").alias("word"), "p", _key("first", "k2").alias("who")),
    ]
    rows = cut(reduce(DataFrame.unionByName, rows).where(F.length("word") >= 4).distinct())
    at = F.concat(F.array(F.lit(-1)), F.sequence(F.lit(0), F.length("word") - 1))
    gone = F.transform(at, lambda i: F.struct(F.concat(F.substr("word", F.lit(1), i), F.substr("word", i + 2)).alias("left"), i.alias("at"), F.substr("word", i + 1, F.lit(1)).alias("ch")))
    gone = F.transform(gone, lambda x: F.when(x["at"] < 0, F.struct(F.col("word").alias("left"), x["at"], F.lit("").alias("ch"))).otherwise(x))
    made = cut(rows.select("block", "word", "who").distinct().select("block", "word", "who", F.inline(gone)).withColumn("h", F.xxhash64("block", "left")))
    # most are alone in their place; a hash tells so, and what it lets through is compared in full
    crowded = made.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    met = made.join(crowded, "h", "left_semi").groupBy("block", "left").agg(F.collect_list(F.struct("word", "who", "at", "ch")).alias("ws")).where(F.size("ws") > 1)
    pair = lambda a, b: F.struct(a["word"].alias("x"), b["word"].alias("y"), a["who"].alias("wx"), b["who"].alias("wy"))
    pairs = F.flatten(F.transform("ws", lambda a: F.transform(F.filter("ws", lambda b: (a["word"] < b["word"]) & _near(a, b)), lambda b: pair(a, b))))
    pairs = met.select("block", F.inline(pairs)).distinct()
    sides = pairs.select("*", F.inline(F.array(F.struct(F.lit(True).alias("is_x"), F.col("x").alias("word")), F.struct(F.lit(False).alias("is_x"), F.col("y").alias("word")))))
    out = cut(sides.join(rows.drop("who"), ["block", "word"]).drop("word"))
    release(rows, made)
    return out


def _slip_links(f: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) between entities whose cores, last names or given names are one slip apart and whose other parts agree.

    Entities of two near words are linked if the rest of their profiles is equal; where one says less (no legal form, no
    middle initial), with the only entity of the other word that agrees with what it says. A last or given name must be
    rare, or rare beside the other; bearers are counted by entity.
    """
    full = f.where((F.col("kind") == "person") & (F.length("k2") > 1))
    bearers = full.groupBy(_key("last", "src", "k1").alias("who")).agg(F.count_distinct("e").alias("n"))
    uses = full.groupBy(_key("first", "k2").alias("who")).agg(F.count_distinct("k1").alias("n"))
    counts = bearers.unionByName(uses)
    likely = members.join(counts.withColumnsRenamed({"who": "wx", "n": "nx"}), "wx", "left").join(counts.withColumnsRenamed({"who": "wy", "n": "ny"}), "wy", "left")
    likely = likely.where("wx IS NULL OR least(nx, ny) * 5 <= greatest(nx, ny) OR least(nx, ny) <= 2").select("block", "x", "y", "is_x", "p")
    org = F.col("kind") == "org"
    now = f.select("p", "e", F.when(org, F.col("k3")).otherwise(F.col("m")).alias("c"), F.when(org, F.col("k4")).otherwise("").alias("d"))
    members = likely.join(now, "p")
    # levels: which of c and d must be equal; what is left out is blank on the side that seeks
    level = lambda a, b, seeks: F.struct(F.when(F.lit(a), F.col("c")).alias("c"), F.when(F.lit(b), F.col("d")).alias("d"), seeks.alias("seeks"), F.lit(a and b).alias("all"))
    no_c, no_d = F.col("c") == "", F.col("d") == ""
    levels = F.array(level(True, True, F.lit(True)), level(False, True, no_c), level(True, False, no_d), level(False, False, no_c & no_d))
    by = members.select("block", "x", "y", "is_x", "e", F.inline(levels).alias("c", "d", "seeks", "all"))
    e = lambda cond: F.when(cond, F.col("e"))
    x = F.col("is_x")
    met = by.groupBy("block", "x", "y", "all", "c", "d").agg(
        F.min(e(x)).alias("x1"), F.max(e(x)).alias("x2"), F.min(e(~x)).alias("y1"), F.max(e(~x)).alias("y2"), F.min(e(x & F.col("seeks"))).alias("xs"), F.min(e(~x & F.col("seeks"))).alias("ys")
    ).where("x1 IS NOT NULL AND y1 IS NOT NULL")
    links = F.array(
        F.struct(F.when(F.col("all") | (F.col("y1") == F.col("y2")), F.col("y1")).alias("a"), F.col("xs").alias("b")),
        F.struct(F.when(F.col("all") | (F.col("x1") == F.col("x2")), F.col("x1")).alias("a"), F.col("ys").alias("b")),
    )
    out = cut(met.select(F.inline(links)).where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct())
    return out


def _links(f: DataFrame, slips: DataFrame) -> DataFrame:
    """Links (a, b) between entities, from the profiles as they are now; slips are their _slip_members."""
    return cut(_block_links(f).unionByName(_slip_links(f, slips)).distinct())


def _merged(f: DataFrame, links: DataFrame) -> DataFrame:
    """Profiles under the entities that links make of theirs; middle initials gathered by an entity count for all its profiles."""
    labels = connected_components(links)
    old = f.drop("moved", "m0").withColumnsRenamed({"e": "e0", "m": "m0"})
    own = cut(old.join(labels.withColumnsRenamed({"id": "e0", "label": "e"}), "e0", "left").withColumn("e", F.coalesce("e", "e0")))
    middle = own.where("kind = 'person' AND k3 <> ''").groupBy("e").agg(F.max("k3").alias("m"))
    new = own.join(middle, "e", "left").withColumn("m", F.coalesce("m", F.lit("")))
    out = cut(new.withColumn("moved", F.expr("e <> e0 OR m <> m0")).drop("e0"))
    release(labels, own, links, f)
    return out


def resolve_names(names: DataFrame) -> DataFrame:
    """names (src, name) -> (src, name, entity): spellings of one entity share a number.

    Merge and rematch: every spelling is parsed into a profile (for organisations core, field, activity and legal form;
    for persons last name, first name and middle initials) and distinct profiles start as entities. A round enters all
    profiles into their blocks under their present entity, links what agrees there, and merges linked entities; a merged
    entity owns all spellings and initials of its members and enters the blocks of the next round with each of them, so
    that an initial that fitted two entities may now fit one, and initials gathered from one spelling keep another's
    namesakes apart. Rounds end when no entity merges, however many they are: each merges at least two.

    Words of business and short given names that are known beforehand are fixed lists. What they don't hold is learned
    from the corpus (see _learn): order of words, short forms, last words left out. Blocks link to their smallest entity
    or look up the only entity of a key, so a hot block gives as many links as it has entries; only distinct words that
    are alike without one letter are paired.

    Null and blank names and names without letters or digits are left out; equal rows count once. src `assignee` holds
    organisations and persons in one field, any other src `last|first`. Entities of different src aren't linked.
    """
    raw = names.where(F.col("src").isNotNull() & F.col("name").isNotNull()).select("src", "name").distinct()
    parsed = cut(raw.repartition(int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))).mapInPandas(_features, FEATURES))
    keys = ["src", *KEYS]
    # p numbers the profiles, e is the entity as it is now, m its middle initials (k3 of persons); numbers are given as the
    # table is written. Profiles with the same parts are one entity from the start.
    numbered = cut(parsed.select(*keys).distinct().withColumn("p", F.monotonically_increasing_id()))
    same = ["src", "kind", "k1", "k2", "k3", "k4"]
    first = cut(numbered.join(numbered.groupBy(*same).agg(F.min("p").alias("e")), same))
    links, forms = _learn(first)
    f = cut(first.join(forms, "p", "left").withColumn("m", F.when(F.col("kind") == "person", F.col("k3")).otherwise("")))
    release(numbered, first, forms)
    slips = _slip_members(f)
    if not links.isEmpty():
        f = _merged(f, links).drop("moved", "m0")
    while True:
        links = _links(f, slips)
        if links.isEmpty():
            release(slips, links)
            return parsed.join(f.select(*keys, F.col("e").alias("entity")), keys).select("src", "name", "entity")
        f = _merged(f, links)


def spelling_pairs(entities: DataFrame) -> DataFrame:
    """(src, name_a, name_b) for every two spellings of an entity, name_a < name_b: what the caller asks for in full."""
    n = F.count(F.lit(1)).over(Window.partitionBy("src", "entity"))
    many = entities.withColumn("n", n).where("n > 1").drop("n")
    a, b = many.withColumnRenamed("name", "name_a"), many.withColumnRenamed("name", "name_b")
    return a.join(b, ["src", "entity"]).where("name_a < name_b").select("src", "name_a", "name_b")
