"""The parts of names typed by people: what distinguishes a company, public body or person, and what does not."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words for a trade, with abbreviations.
_TRADES = (
    "windows wdws wdw;electrical elec elect;marine mar;glass gls;automotive auto autos;waste wst;recruitment recruit rec;irrigation irrig;steel stl;concrete conc;foods fds food;building bldg;timber tmbr;"
    "furniture furn;nurseries nurs nursery;catering cater;joinery join;cleaning clng;roofing roof;printing prtg print;fabrication fab;refrigeration refrig rfrg;hire hr;insulation insul;plumbing plmb plumb;"
    "tiles tls tile;surveying surv survey;paints pnts paint;produce prod;logistics log logist;scaffolding scaff;engineering eng engr;quarries qry quarry;freight frt;earthmoving earthmvg;security sec;"
    "tyres tyr tyre;textiles text;fuel fl;packaging pkg pack"
)
#: Words for a company's role, with abbreviations.
_ROLES = (
    "industries ind inds industry;international intl int;systems sys system;supplies supp supply;management mgmt mgt;contractors contr contractor;merchants mchts merchant;equipment equip eqpt;services serv svcs service;"
    "works wks wrks;distributors dist distrib;solutions soln solns solution;wholesale wsale whsale;holdings hldgs holding;group grp;trading tdg"
)
#: Words for a public body, with abbreviations.
_BODIES = "shire;council cncl;city cty;regional reg;library lib;university uni univ;water wtr;corporation corp;hills hls;commissioner commr comm comr;office off;department;authority auth;district;taxation;revenue;levies levy levys;trade;state;government govt"
#: Given names, with short forms.
_GIVEN = (
    "francis frank fran;deborah deb debbie;leonard leo len;yvonne von vonnie;nicholas nick nic;william bill will wm;jennifer jen jenny;harold hal harry;margaret maggie marg peg;susannah sue susie zanna;"
    "elizabeth liz beth;thomas tom;robert rob bob;victoria vicky tori;katherine kate kathy kath;ivan van;patricia pat trish;gregory greg;alexander alex sandy;oliver ollie;"
    "grace;anne;hope;lee;keith;ray;joy;neil;dale;fay"
)
#: Words that say nothing of who it is.
_LEGAL = frozenset("pty ltd limited lmt proprietary pl inc incorporated nl co company the aust australia".split())
_KIN = frozenset("bros brothers bro sons son daughters daughter and of".split())
_TITLES = frozenset("mr mrs ms miss mx dr prof".split())

_ENTITY = {"&amp;": " & ", "&#38;": " & ", "&nbsp;": " ", "&#39;": "'", "&apos;": "'", "&quot;": " "}
_NOTE = re.compile(
    r"\s+[-–—]\s+[^-–—]*\b(?:branch|accounts?|dept|department|sales|finance|rates|division|office)\b[^-–—]*$|\((?:in liq\w*\.?|sales|accounts?|administrators? appointed|receivers?[^)]*|sole trader|abn holder|in administration|under[^)]*|deregistered)\)"
    r"|\bc/[o-]\s.*$|\b(?:t/as?|trading as)\b.*$|\babn holder\b|\bsole trader\b|\bin liq(?:uidation)?\b\.?"
)
_PARTNERS = re.compile(r"(?<!\w)([a-z])\s*(?:&|\+|\band\b)\s*([a-z])(?!\w)")
_SPLIT = re.compile(r"[^\w.&+']+|_")
_DOTTED = re.compile(r"^(?:[a-z]\.){2,3}$|^(?:[a-z]\.){1,2}[a-z]$")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z][a-z])")
_MISREAD = re.compile(r"(?=[a-z\d]*[a-z]{2})[a-z\d]*[a-z][a-z\d]*\d[a-z\d]*|\d[a-z]{3,}")


def _table(text: str, kind: str) -> dict[str, tuple[str, str]]:
    return {w: (kind, entry.split()[0]) for entry in text.split(";") for w in entry.split()}


#: The words of the lists; a short form of several trades is the letter they begin with.
LISTED: dict[str, tuple[str, str]] = {**_table(_GIVEN, "given"), **_table(_BODIES, "body"), **_table(_ROLES, "role"), **_table(_TRADES, "trade"), "rfg": ("trade", "r")}


def _deletions(word: str, depth: int) -> set[str]:
    out = {word}
    edge = {word}
    for _ in range(depth):
        edge = {w[:i] + w[i + 1 :] for w in edge for i in range(len(w))}
        out |= edge
    return out


def edits(a: str, b: str) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours between two words."""
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], before[j - 2] + 1)
        before, last = last, row
    return last[-1]


class Vocabulary:
    """Words that many names share: what kind each is, and which word it stands for."""

    def __init__(self, words: Mapping[str, tuple[str, str]]):
        self.words = dict(words)
        self.full = {w: k for w, k in self.words.items() if len(w) >= 4 and w == k[1]}
        #: No word of the vocabulary is longer, so longer tokens need not be looked at letter by letter.
        self.longest = max(map(len, self.words), default=0)
        self.neighbours: dict[str, list[str]] = {}
        for w in self.full:
            for d in _deletions(w, 1 if len(w) < 7 else 2):
                self.neighbours.setdefault(d, []).append(w)
        self.known_word = lru_cache(maxsize=200_000)(self._known_word)
        self.parts_of = lru_cache(maxsize=200_000)(self._parts_of)
        self.parse = lru_cache(maxsize=100_000)(self._parse)

    def _known_word(self, token: str) -> tuple[str, str, int] | None:
        """``(kind, word, errors)`` of a word as it is, abbreviated, or with a typing error (two in long words)."""
        found = self.words.get(token)
        if found:
            return *found, 0
        if not 3 <= len(token) <= self.longest + 2:
            return None
        if len(token) >= 4:
            # Cut off at the end of a field.
            longer = {w for w, k in self.full.items() if w.startswith(token) and k[0] != "given"}
            if len(longer) == 1:
                return *self.full[longer.pop()], 1
        near = {w for d in _deletions(token, 1 if len(token) < 6 else 2) for w in self.neighbours.get(d, ())}
        best = min(((edits(token, w), w[0] != token[0], w) for w in near), default=None)
        if best and best[0] <= (1 if len(best[2]) < 7 else 2) and (best[0] == 1 or not best[1]):
            return *self.full[best[2]], best[0]
        return None

    def _parts_of(self, token: str) -> tuple[str, ...]:
        """A run-together token parted at known words at its end or beginning."""
        heads: list[str] = []
        tails: list[str] = []
        while len(token) >= 8 and not self.known_word(token):
            ends = (cut for cut in range(max(3, len(token) - max(self.longest, 9)), len(token) - 3) if self._is_tail(token[cut:]))
            cut = next(ends, None)
            if cut is not None:
                tails.append(token[cut:])
                token = token[:cut]
                continue
            begins = (cut for cut in range(min(len(token) - 3, self.longest), 4, -1) if self.full.get(token[:cut], ("",))[0] in ("trade", "role"))
            cut = next(begins, None)
            if cut is None:
                break
            heads.append(token[:cut])
            token = token[cut:]
        return *heads, token, *reversed(tails)

    def _is_tail(self, word: str) -> bool:
        return self.full.get(word, ("given",))[0] != "given" or word in ("sons", "bros", "daughters", "brothers")

    def _parse(self, name: str | None) -> Name:
        return _parse_with(name, self)


class Name(NamedTuple):
    """What a name is made of; parts are empty where missing, a lone letter where only an initial is given."""

    kind: str  #: company, body, person or other
    core: str  #: what is rare in it: the invented word, the surname
    head: str  #: what tells sisters apart: the trade, the kind of body, the given name
    rest: str  #: what may be missing: the role, the middle name


def _parse_with(name: str | None, vocabulary: Vocabulary) -> Name:
    """The parts of a name in any order, with annotations, legal forms and family words left out."""
    known_word, full = vocabulary.known_word, vocabulary.full
    t = name or ""
    if "&" in t:
        for entity, sign in _ENTITY.items():
            t = re.sub(re.escape(entity), sign, t, flags=re.I)
    if not t.isupper():
        t = _CAMEL.sub(" ", t)
    t = re.sub(r"\s+", " ", t.lower().replace("’", "'")).strip()
    t = _NOTE.sub(" ", t).strip()
    t = re.sub(r"\bp\s*/\s*l\b|\bp l$", " pl ", t).replace("w/sale", "wsale")
    if any(c.isdigit() for c in t):
        t = re.sub(r"[a-z\d]+", lambda m: _MISREAD.sub(lambda x: x[0].translate({48: "o", 49: "l", 53: "s"}), m[0]), t)
    partners = _PARTNERS.search(t)
    if partners:
        t = t[: partners.start()] + " " + t[partners.end() :]
    comma = re.match(r"\s*((?:mr|mrs|ms|miss|dr|prof)\.?\s+)?([^,]+),\s*(\S.*)$", t)
    tokens: list[str] = []
    for raw in _SPLIT.split(t):
        token = raw.strip("'&+")
        if not token or token in (".", "&", "+"):
            continue
        if _DOTTED.match(token):
            tokens += [c for c in token if c != "."]
            continue
        token = token.replace(".", "").replace("'", "").replace("&", "").replace("+", "")
        tokens += vocabulary.parts_of(token) if token else ()
    if len(tokens) > 2 and len(tokens[-1]) > 1 and tokens[-1] not in _LEGAL and not known_word(tokens[-1]):
        # The end of a field may cut the last word.
        if "limited".startswith(tokens[-1]) or "proprietary".startswith(tokens[-1]) or "pty".startswith(tokens[-1]):
            tokens[-1] = "limited"
        elif len(tokens[-1]) == 3:
            longer = [w for w, k in full.items() if w.startswith(tokens[-1]) and k[0] in ("trade", "role")]
            if len(longer) == 1:
                tokens[-1] = longer[0]
    legal = any(w in _LEGAL and w not in ("co", "the") for w in tokens)
    words = [w for w in tokens if w not in _LEGAL]
    titled = any(w in _TITLES for w in words)
    words = [w for w in words if w not in _TITLES]
    found = [(w, None if w in _KIN or len(w) == 1 else known_word(w)) for w in words if w not in _KIN]
    kin = any(w in _KIN and w not in ("and", "of") for w in words) or partners is not None
    has = {k[0] for _, k in found if k}
    sure = {k[0] for _, k in found if k and not k[2]}
    business = legal or kin or bool(sure & {"trade", "role", "body"}) or len(has & {"trade", "role"}) == 2
    single = [w for w, _ in found if len(w) == 1]
    if not business and (titled or comma or "given" in has or (single and 0 < len(found) - len(single) <= 2 and len(found[0][0]) == 1)):
        if comma:
            family = [w for w in _words(comma[2]) if w not in _TITLES]
            first = [w for w in _words(comma[3]) if w not in _TITLES]
        else:
            family = [w for w, k in found if len(w) > 1 and not (k and k[0] == "given")]
            first = [w for w, k in found if len(w) == 1 or (k and k[0] == "given")]
            if not family and len(first) > 1:
                family, first = [first[-1]], first[:-1]
            elif len(family) > 1 and not first:
                family, first = family[-1:], family[:-1]
            elif len(family) > 1 and found and found[0][0] in family and len(found[0][0]) > 1 and not titled and found[-1][0] in family:
                first = [family[0], *first]
                family = family[1:]
        given = [k[1] if len(w) > 1 and (k := known_word(w)) and k[0] == "given" else w for w in first]
        return Name("person", "".join(family), given[0] if given else "", given[1] if len(given) > 1 else "")
    core: list[tuple[str, int]] = []
    trades: list[str] = []
    roles: list[str] = []
    bodies: list[str] = []
    initials: list[str] = []
    for w, k in found:
        if len(w) == 1:
            initials.append(w)
        elif k and k[0] == "trade" and not trades:
            trades.append(k[1])
        elif k and k[0] == "role" and not roles:
            roles.append(k[1])
        elif k and k[0] == "body" and not (k[2] and (trades or legal)):
            bodies.append(k[1])
        else:
            core.append((w, 0))
    if not core:
        # A word taken for a known one by its errors is the rare one after all.
        wrong = [(k[2], w, k) for w, k in found if k and k[2]]
        if wrong:
            _, w, k = max(wrong)
            core = [(w, 0)]
            for group in (trades, roles, bodies):
                if k[1] in group:
                    group.remove(k[1])
    text = "".join(w for w, _ in core)
    if not trades and not initials and not bodies and len(text) > 7:
        # Run together with a short or misspelt trade word.
        for cut in range(max(4, len(text) - vocabulary.longest - 2), len(text) - 2):
            k = known_word(text[cut:])
            if k and k[0] == "trade" and (not k[2] or len(text) - cut >= 6):
                text, trades = re.sub(r"(?<=\w{4})(?:bros|sons|brothers|daughters)$", "", text[:cut]), [k[1]]
                break
    if bodies and not text and not trades:
        named = [b for b in bodies if b not in ("commissioner", "office", "department", "state", "trade", "government")]
        return Name("body", "".join(sorted(set(named or bodies))), "", "")
    if bodies and not trades and not legal:
        main = [b for b in bodies if b not in ("city", "regional", "shire", "state")]
        return Name("body", text, " ".join(sorted(set(main or bodies))), " ".join(sorted(set(bodies) - set(main))) if main else "")
    if initials and not trades:
        trades, initials = [initials[0]], initials[1:]
    if initials and not roles:
        roles = [initials[0]]
    if bodies:
        text += "".join(bodies)
    return Name("company" if trades or roles or legal or kin else "other", text, trades[0] if trades else "", roles[0] if roles else "")


DEFAULT = Vocabulary(LISTED)


def parse_name(name: str | None) -> Name:
    """The parts of a name by the lists."""
    return DEFAULT.parse(name)


def known_word(token: str) -> tuple[str, str, int] | None:
    return DEFAULT.known_word(token)


@lru_cache(maxsize=8)
def extended(learnt: tuple[tuple[str, str, str], ...]) -> Vocabulary:
    """The lists with words learnt (``word, kind, stands_for``), one for all batches of a process."""
    return Vocabulary({**{w: (kind, full) for w, kind, full in learnt}, **LISTED})


@lru_cache(maxsize=100_000)
def parse_person(name: str | None) -> Name:
    """The parts of what is known to be a person's name: the surname is before a comma, else the last word."""
    found = parse_name(name)
    if found.kind == "person" or not name:
        return found
    before, comma, behind = name.lower().partition(",")
    words = [w for w in _words(f"{behind} {before}" if comma else before) if w not in _TITLES]
    if not words:
        return found
    given = [k[1] if (k := known_word(w)) and k[0] == "given" and len(w) > 1 else w for w in words[:-1]]
    return Name("person", words[-1], given[0] if given else "", given[1] if len(given) > 1 else "")


def _words(t: str) -> list[str]:
    return [w for w in (x.strip(".'") for x in re.split(r"[^\w']+|_", t)) if w]


NAME_FIELDS = "kind string, core string, head string, rest string"


def with_name_parts(df: DataFrame, key: str, name: str, parser: Callable[[str | None], Name] = parse_name, learnt: tuple[tuple[str, str, str], ...] = ()) -> DataFrame:
    """``key`` and the parts of ``name``, parsed in Arrow batches, by the lists and the words ``learnt``. Null names have empty parts."""
    only = df.select(F.col(key).alias("k"), F.col(name).alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parse = extended(learnt).parse if learnt else parser
        for batch in batches:
            rows = [parse(n) for n in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), pa.string()) for c in columns]], ["k", "kind", "core", "head", "rest"])

    out = only.mapInArrow(run, f"k {only.schema['k'].dataType.simpleString()}, {NAME_FIELDS}")
    return out.withColumnRenamed("k", key)


def grams(c: Column, q: int = 3) -> Column:
    """The distinct q-grams of a word, its two ends marked."""
    padded = F.concat(F.lit("^"), c, F.lit("$"))
    return F.when(F.length(padded) < q, F.array(padded)).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - q + 1, F.lit(1))), lambda i: F.substring(padded, i, F.lit(q))))
    )


def agrees(a: Column, b: Column) -> Column:
    """Whether two parts can be one: equal, or one the initial of the other. Null where either is missing."""
    initial = ((F.length(a) == 1) & b.startswith(a)) | ((F.length(b) == 1) & a.startswith(b))
    return F.when((a != "") & (b != ""), (a == b) | initial)
