"""Same postal address written differently: components, blocks, linkage weights by expectation-maximization."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtloom.llm.graph import connected_components
from debtloom.llm.linkage import with_probability
from debtloom.session import settle

#: Street types and their abbreviations.
TYPES = {
    w: full
    for full, words in {
        "street": "street str st", "road": "road rd", "lane": "lane la ln", "court": "court ct crt", "parade": "parade pde", "crescent": "crescent cr cres", "avenue": "avenue ave av",
        "terrace": "terrace tce terr", "place": "place pl plc", "drive": "drive dr drv", "highway": "highway hwy hway", "boulevard": "boulevard blvd bvd boul", "close": "close cl",
        "grove": "grove gr", "circuit": "circuit cct", "square": "square sq", "esplanade": "esplanade esp", "way": "way", "walk": "walk", "mews": "mews", "rise": "rise", "loop": "loop", "track": "track",
    }.items()
    for w in words.split()
}
#: Words in names of localities.
PLACE_WORDS = {"nth": "north", "n": "north", "sth": "south", "s": "south", "e": "east", "w": "west", "mt": "mount", "pt": "port", "st": "saint", "pk": "park", "hts": "heights", "jctn": "junction", "jn": "junction", "bch": "beach", "hse": "house"}
#: Kinds of unit.
UNITS = {w: full for full, words in {"unit": "unit u un flat apartment apt", "shop": "shop shp", "level": "level lvl lv l floor", "factory": "factory fcty fac", "suite": "suite ste", "office": "office off"}.items() for w in words.split()}
#: States and territories.
STATES = {"new south wales": "nsw", "victoria": "vic", "queensland": "qld", "south australia": "sa", "western australia": "wa", "tasmania": "tas", "northern territory": "nt", "australian capital territory": "act"}

_CARE = re.compile(r"\b(?:c/-|c/o|care of|attn|attention|deliver to)[:.,]?\s*(?:(?:the )?(?:registered office|accountants?|accounts(?: dept| department| payable)?|manager|reception)\b[.,]?)?\s*")
_BOX = re.compile(r"\b(g\.?\s*p\.?\s*o\.?\s*box|p\.?\s*o\.?\s*box|post office box|lo?c?ke?d bag|private bag)\s*(?:no\.?\s*)?(\d+)\b")
_STATE_NAMES = re.compile(r"\b(?:" + "|".join(sorted(STATES, key=len, reverse=True)) + r")\b")
_STATE = re.compile(r"\b(nsw|vic|qld|sa|wa|tas|nt|act)\b")
_COUNTRY = re.compile(r"\b(?:australia|aust|au)\b\.?")
_POSTCODE = re.compile(r"(?<![\d/-])\b(\d{4})\b(?![\d/-])")
_UNIT = re.compile(r"\b(" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")\.?\s*(?:no\.?\s*)?(\d+[a-z]?)\b\s*[/,]?\s*(?:no\b\.?\s*)?(?=\d)")
_BEHIND = re.compile(r"\((" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")\.?\s*(\d+[a-z]?)\)")
_MISREAD = re.compile(r"\b(?=[a-z\d]*[a-z]{2})[a-z]+[\d]+[a-z]+[a-z\d]*\b|\b[015][a-z]{3,}\b")
_SLASH = re.compile(r"\b(\d+[a-z]?)\s*/\s*(?=\d)")
_NUMBER = re.compile(r"\b(?:no\b\.?\s*)?(\d+)(?:\s*-?\s*([a-h])\b(?!'))?(?:\s*(?:-|–|—|to)\s*(\d+)([a-h])?\b)?")
_WORD = re.compile(r"[^\W\d_]+")


class Address(NamedTuple):
    """Components, each empty where missing."""

    box: str
    unit_kind: str
    unit: str
    number: str
    street: str
    type: str
    suburb: str
    state: str
    postcode: str


def _locality(text: str) -> str:
    words = [PLACE_WORDS.get(w, w) for w in _WORD.findall(text)]
    return " ".join(w for w in words if w != "no")


def parse(address: str | None) -> Address:
    """The components of an address in any order, lower case, abbreviations written out."""
    t = re.sub(r"\s*[\n\r]+\s*", " , ", (address or "").lower().replace("’", "'").replace("h'way", "hway"))
    t = re.sub(r"\s+", " ", _CARE.sub(" ", re.sub(r"\s+", " ", t))).replace("pobox", "po box")
    # Digits that a reader took for letters.
    t = _MISREAD.sub(lambda m: m[0].translate({48: "o", 49: "l", 53: "s"}), t)
    behind = _BEHIND.search(t)
    if behind:
        t = f"{behind[1]} {behind[2]}, {t[: behind.start()]} , {t[behind.end() :]}"
    state = ""
    names = list(_STATE_NAMES.finditer(t))
    if names:
        state = STATES[names[-1][0]]
        t = t[: names[-1].start()] + " , " + t[names[-1].end() :]
    else:
        short = list(_STATE.finditer(t))
        if short:
            state = short[-1][1]
            t = t[: short[-1].start()] + " , " + t[short[-1].end() :]
    t = _COUNTRY.sub(" ", t)
    box = _BOX.search(t)
    kind = unit = number = street = street_type = ""
    if box:
        left, right = t[: box.start()], t[box.end() :]
        label = re.sub(r"[^a-z]", "", box[1])
        number = box[2]
        which = "bag" if label.endswith("bag") else "box"
    else:
        which = ""
    # The postcode: the last free number of four digits; one that only a street number could be is left.
    codes = [m for m in _POSTCODE.finditer(t) if not (box and box.start() <= m.start() < box.end())]
    postcode = ""
    if codes:
        m = codes[-1]
        if box or len(re.findall(r"\d+", t)) > 1:
            postcode = m[1]
            t = t[: m.start()] + " , " + t[m.end() :]
            if box:
                again = _BOX.search(t)
                left, right = t[: again.start()], t[again.end() :]
    if box:
        return Address(which, "", "", number, "", "", _locality(left + " " + right), state, postcode)
    first = _UNIT.search(t)
    start = None
    if first:
        kind, unit = UNITS[first[1]], first[2]
        start, rest = first.start(), first.end()
    else:
        slash = _SLASH.search(t)
        if slash:
            unit, start, rest = slash[1], slash.start(), slash.end()
        else:
            rest = 0
    m = _NUMBER.search(t, rest)
    if not m:
        return Address("", kind, unit, "", "", "", _locality(t), state, postcode)
    start = m.start() if start is None else start
    number = m[1] + (m[2] or "") + (f"-{m[3]}{m[4] or ''}" if m[3] else "")
    left, right = t[:start], t[m.end() :]
    segment, _, after = right.strip(" .,").partition(",")
    words = _WORD.findall(segment)
    at = next((i for i, w in enumerate(words) if i and w in TYPES), None)
    if at is None:
        street, rest_words = words[:1], words[1:]
        following = _WORD.findall(after)
        if not rest_words and following and following[0] in TYPES and following[0] != "st":
            street_type, after = TYPES[following[0]], " ".join(following[1:])
    else:
        street, street_type, rest_words = words[:at], TYPES[words[at]], words[at + 1 :]
    suburb = _locality(f"{left} {' '.join(rest_words)} {after}")
    return Address("", kind, unit, number, " ".join(street), street_type, suburb, state, postcode)


#: Expected shares of the levels among matches, to begin with. 0: differ, 1: missing on one side, 2: missing on both, 3: close, 4: equal.
_EXPECTED = {
    "street": {4: 0.7, 3: 0.25, 2: 0.05},
    "type": {4: 0.8, 1: 0.1, 2: 0.1},
    "suburb": {4: 0.7, 3: 0.15, 1: 0.1, 2: 0.05},
    "postcode": {4: 0.5, 1: 0.35, 2: 0.15},
    "state": {4: 0.5, 1: 0.35, 2: 0.15},
    "unit_kind": {4: 0.6, 1: 0.2, 2: 0.2},
}
_TAGS = sorted({v for v in PLACE_WORDS.values() if v != "house"})
_PARSED = ", ".join(f"{f} string" for f in Address._fields) + ", core string, tags string"


def parsed(addresses: DataFrame, address: str) -> DataFrame:
    """``address`` with its components; the locality also as ``core`` and ``tags`` (its compass points and the like)."""
    only = addresses.select(F.col(address).alias("address"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                a = parse(text)
                words = a.suburb.split()
                tags = sorted(w for w in words if w in _TAGS)
                rows.append((*a, "".join(w for w in words if w not in _TAGS), " ".join(tags)))
            columns = list(zip(*rows)) if rows else [[] for _ in range(len(Address._fields) + 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.string()) for c in columns]], ["address", *Address._fields, "core", "tags"])

    return only.mapInArrow(run, f"address string, {_PARSED}")


def sound(c: Column) -> Column:
    """What is heard of a name: its first four consonants, doubled and like ones once."""
    s = F.regexp_replace(F.translate(c, "ckqzvpbdg", "kkksfpptk"), "[aeiouhwy]", "")
    return F.substring(F.regexp_replace(s, r"(.)\1+", "$1"), 1, 4)


def _level(a: Column, b: Column, close: Column | None = None) -> Column:
    level = F.when((a == "") & (b == ""), 2).when((a == "") | (b == ""), 1).when(a == b, 4)
    return (level.when(close, 3) if close is not None else level).otherwise(0)


def _near(a: Column, b: Column) -> Column:
    """At most two wrong letters (of five or more), or three of eight."""
    n = F.greatest(F.length(a), F.length(b))
    return F.levenshtein(a, b) <= F.when(n >= 8, 3).when(n >= 5, 2).otherwise(1)


def same_place(addresses: DataFrame, address: str, least: float = 0.5) -> DataFrame:
    """``address, place``: every distinct address string with the name of its place; strings of one place share it.

    Addresses with equal components are one record. Records are paired that have the same number, unit and box, and either
    the postcode, the locality or the sound of the street in common. Their components are compared (equal, close, missing on one
    side or both, differing), and the weights of these levels estimated by expectation-maximization over all pairs. Pairs with a
    probability of at least ``least`` are links, unless street, type, locality, state or postcode differ outright; so are not the
    links of a record that lacks the part by which the places it is linked to differ from one another.

    Defined cases: null and blank addresses have no row; an address without any number is a place by its text alone; repeated
    rows count once; empty tables give no rows.
    """
    texts = addresses.select(F.col(address).alias("address")).where("length(trim(address)) > 0").distinct()
    raw = parsed(texts, "address")
    parts = [f for f in Address._fields if f != "suburb"] + ["core", "tags"]
    raw = settle(raw.withColumn("node", F.when(F.col("number") == "", F.xxhash64(F.lit("text"), "address")).otherwise(F.xxhash64(*parts))), "addresses")
    nodes = raw.where("number != ''").groupBy("node", *parts).agg(F.count("*").alias("n"))
    base = F.concat_ws("|", "box", "unit", "number")
    keys = F.array(
        F.when(F.col("postcode") != "", F.concat_ws("|", F.lit("p"), base, "postcode")),
        F.when(F.col("core") != "", F.concat_ws("|", F.lit("c"), base, F.col("tags"), sound(F.col("core")))),
        F.when(F.col("street") != "", F.concat_ws("|", F.lit("s"), base, sound(F.col("street")))),
    )
    keyed = nodes.drop("n").withColumn("key", F.explode(F.filter(keys, lambda k: k.isNotNull()))).withColumn("key", F.xxhash64("key"))
    a, b = keyed.alias("a"), keyed.alias("b")
    x, y = (lambda f: F.col(f"a.{f}")), (lambda f: F.col(f"b.{f}"))
    boxed = x("box") != ""
    # What is exploded is never broadcast: its size isn't known beforehand.
    compared = a.join(b.hint("merge"), (x("key") == y("key")) & (x("node") < y("node"))).select(
        x("node").alias("a"),
        y("node").alias("b"),
        boxed.alias("boxed"),
        # A box stands for the street; blocks have it in common.
        F.when(boxed, 4).otherwise(_level(x("street"), y("street"), _near(x("street"), y("street")))).alias("street"),
        _level(x("type"), y("type")).alias("type"),
        F.when((x("core") != "") & (y("core") != "") & (x("tags") != y("tags")), 0).otherwise(_level(x("core"), y("core"), _near(x("core"), y("core")))).alias("suburb"),
        _level(x("postcode"), y("postcode")).alias("postcode"),
        _level(x("state"), y("state")).alias("state"),
        _level(x("unit_kind"), y("unit_kind")).alias("unit_kind"),
        *[F.struct(*[F.when(side(f) != "", side(f)).alias(f) for f in ("type", "postcode", "core", "unit_kind")]).alias(f"of_{n}") for n, side in (("a", x), ("b", y))],
    )
    compared = settle(compared.distinct(), "address-pairs")
    sure = with_probability(compared, _EXPECTED).where(F.col("probability") >= least)
    for f in ("street", "type", "suburb", "postcode", "state", "unit_kind"):
        sure = sure.where(F.col(f) != 0)
    # Something besides the number must agree: a street or box and the locality, or the street with its type.
    sure = sure.where("street >= 3").where("suburb >= 3 or postcode = 4 or (not boxed and (type = 4 or street = 4))")
    seen = sure.select(F.col("a").alias("node"), "of_a", F.col("of_b").alias("other")).unionByName(sure.select(F.col("b").alias("node"), F.col("of_b").alias("of_a"), F.col("of_a").alias("other")))
    torn = F.lit(False)
    for own, other in (("type", "type"), ("unit_kind", "unit_kind")):
        torn = torn | (F.first(F.col(f"of_a.{own}")).isNull() & (F.min(f"other.{other}") != F.max(f"other.{other}")))
    torn = torn | (F.first("of_a.postcode").isNull() & F.first("of_a.core").isNull() & (F.min("other.postcode") != F.max("other.postcode")))
    ambiguous = seen.groupBy("node").agg(F.coalesce(torn, F.lit(False)).alias("torn")).where("torn").select("node")
    links = sure.join(ambiguous.withColumnRenamed("node", "a"), "a", "left_anti").join(ambiguous.withColumnRenamed("node", "b"), "b", "left_anti")
    places = connected_components(links.select("a", "b"), "a", "b")
    return raw.select("address", "node").join(places, "node", "left").select(F.col("address").alias(address), F.coalesce("component", "node").alias("place"))


def same_place_pairs(addresses: DataFrame, address: str, least: float = 0.5) -> DataFrame:
    """``address_a, address_b``: all pairs of different strings for one place, the smaller first."""
    found = settle(same_place(addresses, address, least), "places")
    several = found.groupBy("place").count().where("count > 1").select("place")
    known = found.join(several, "place")
    a, b = known.select("place", F.col(address).alias("address_a")), known.select("place", F.col(address).alias("address_b"))
    return a.join(b, "place").where("address_a < address_b").select("address_a", "address_b")
