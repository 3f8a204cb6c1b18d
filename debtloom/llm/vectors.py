"""Bit vectors of q-grams, and exact searches for near ones by multi-index hashing: of any vectors, and of those of near words."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtloom.llm.names import agrees, grams

BITS = 64
#: Two rare words whose vectors differ in at most RADIUS bits are found: two wrong letters change at most eight bigrams.
RADIUS = 8
#: Parts of a vector, in bits: one more than RADIUS, so that any two vectors within RADIUS are equal in one part at least.
PARTS = (8, 7, 7, 7, 7, 7, 7, 7, 7)


def bit_vector(word: Column) -> Column:
    """The bigrams of a word as bits of one long."""
    one = F.lit(1).cast("bigint")
    return F.aggregate(grams(word, 2), F.lit(0).cast("bigint"), lambda acc, g: acc.bitwiseOR(F.call_function("shiftleft", one, F.pmod(F.xxhash64(g), F.lit(BITS)).cast("int"))))


def dice(a: Column, b: Column) -> Column:
    """Dice's coefficient of two bit vectors; null where either is."""
    return F.try_divide(2 * F.bit_count(a.bitwiseAND(b)), F.bit_count(a) + F.bit_count(b))


def _parts(v: Column) -> list[Column]:
    out, at = [], 0
    for i, width in enumerate(PARTS):
        out.append(F.xxhash64(F.lit(i), F.call_function("shiftrightunsigned", v, F.lit(at)).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))))
        at += width
    return out


def head_contexts(left: bool) -> Column:
    """What two heads must have in common to be compared: the whole head, its initial if one side has no more, or nothing if one has none."""
    head, letter = F.col("head"), F.substring("head", 1, 1)
    tag = lambda t, c=None: F.concat(F.lit(t), c) if c is not None else F.lit(t)
    if left:
        known, initial, missing = [tag("T", head), tag("k", letter), tag("K")], [tag("i", letter), tag("I")], [tag("M")]
    else:
        known, initial, missing = [tag("T", head), tag("i", letter), tag("M")], [tag("k", letter), tag("i", letter), tag("M")], [tag("K"), tag("I"), tag("M")]
    return F.when(F.length("head") > 1, F.array(*known)).when(F.length("head") == 1, F.array(*initial)).otherwise(F.array(*missing))


def hamming_cores(units: DataFrame, verified: Column | None = None, radius: int = RADIUS) -> DataFrame:
    """``a, b``: units (``u, family, core, head, sought``) that are ``sought``, with all units whose vectors differ in at most ``radius`` bits.

    The search is exact among words that begin or end with the same letter (or are equal but for both ends) and whose heads don't rule each other
    out. A vector is cut into PARTS, one more than the radius; two vectors within it are equal in one part at least, so each part is looked up as it
    is, and what is found is compared in full. A bit vector of a short word is mostly zeros, and a part of zeros says little: the letter is
    part of the key to keep the lists short. ``verified`` is a condition on ``a.core`` and ``b.core``.
    """
    if radius >= len(PARTS):
        raise ValueError("PARTS don't provide for this radius")

    def keyed(df: DataFrame, left: bool) -> DataFrame:
        v = df.select("u", "family", "core", bit_vector(F.col("core")).alias("v"), "head")
        ends = [F.xxhash64(F.lit("first"), F.substring("core", 1, 1)), F.xxhash64(F.lit("last"), F.substring("core", -1, 1))]
        inner = F.array(F.xxhash64(F.lit("inner"), F.expr("substring(core, 2, length(core) - 2)")))
        places = F.concat(*[F.array(*[F.xxhash64(p, e) for p in _parts(F.col("v"))]) for e in ends], F.when(F.length("core") > 4, inner).otherwise(F.array().cast("array<bigint>")))
        each = v.select("u", "core", "v", F.explode(head_contexts(left)).alias("c"), "family", places.alias("places"))
        return each.select("u", "core", "v", F.transform("places", lambda p: F.xxhash64(p, F.col("c"), F.col("family"))).alias("keys")).select("u", "core", "v", F.explode("keys").alias("key"))

    a, b = keyed(units.where("sought"), True).alias("a"), keyed(units, False).alias("b")
    x, y = (lambda f: F.col(f"a.{f}")), (lambda f: F.col(f"b.{f}"))
    close = (x("key") == y("key")) & (x("u") != y("u")) & (F.bit_count(x("v").bitwiseXOR(y("v"))) <= radius)
    # What is exploded is never broadcast: its size isn't known beforehand.
    found = a.join(b.hint("merge"), close).select(x("u").alias("a"), y("u").alias("b"), x("core").alias("x"), y("core").alias("y"))
    found = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    return (found if verified is None else found.where(verified)).select("a", "b")


def _most(n: int, m: int) -> int:
    """The most wrong letters of near words of two lengths that begin with the same letter."""
    longer = max(n, m)
    return 3 if longer >= 11 else 2 if longer >= 6 else 1


def _less_one(word: str) -> set[str]:
    """A word, and what is left without any one of its letters."""
    return {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}


def whole_keys(word: str) -> set[str]:
    """Keys of which two words have one in common where their letters are the same but for one, or their first letters differ and near words they are,
    or both are short: the first letter is one of the wrong ones then, and of what is behind it one more at most."""
    n = len(word)
    out = {"w" + k for k in (_less_one(word) if n <= 5 or n >= 8 else {word}) | (_less_one(word[1:]) if n >= 8 else {word[1:]})}
    return out | ({"s" + k for k in _less_one("".join(sorted(word)))} if n >= 5 else set())


def _cut(n: int, most: int, i: int) -> tuple[int, int]:
    """Where piece ``i`` of ``most + 1`` of a word of ``n`` letters stands behind its first letter."""
    return 1 + i * (n - 1) // (most + 1), 1 + (i + 1) * (n - 1) // (most + 1)


@lru_cache(maxsize=1024)
def _pieces(n: int) -> tuple[tuple[str, int, int], ...]:
    """The pieces of a word of ``n`` letters for each number of wrong letters that can be: a tag, where they start and end."""
    counts = sorted({_most(n, m) for m in range(max(1, n - 3), n + 4) if abs(n - m) <= _most(n, m) and max(n, m) >= 6})
    return tuple((f"{most}{i}", *_cut(n, most, i)) for most in counts for i in range(most + 1))


@lru_cache(maxsize=1024)
def _places(m: int) -> tuple[tuple[str, int, int], ...]:
    """Where the pieces of near words can stand in a word of ``m`` letters."""
    out = set()
    for n in range(max(1, m - 3), m + 4):
        most = _most(n, m)
        if abs(n - m) > most or max(n, m) < 6:
            continue
        for i in range(most + 1):
            start, end = _cut(n, most, i)
            out |= {(f"{most}{i}", start + moved, end + moved) for moved in range(-i, i + 1) if abs(m - n - moved) <= most - i and start + moved >= 1 and end + moved <= m}
    return tuple(sorted(out))


def piece_keys(word: str) -> set[str]:
    """A word's first letter with each of its pieces, one more than letters can be wrong."""
    first = word[0]
    return {tag + first + word[start:end] for tag, start, end in _pieces(len(word))}


def place_keys(word: str) -> set[str]:
    """The pieces that any near word with the same first letter can have in common with ``word``.

    The first piece up to which there are no more wrong letters than pieces before it is untouched, and has just one for each of those before it: so
    piece ``i`` is moved by ``i`` places at most, and the rest suffice for what the lengths differ by behind it.
    """
    first = word[0]
    return {tag + first + word[start:end] for tag, start, end in _places(len(word))}


def _keys(core: Column) -> Column:
    """The three sets of keys of a word."""

    @F.arrow_udf("struct<whole: array<string>, pieces: array<string>, places: array<string>>")
    def run(words: pa.Array) -> pa.Array:
        texts = words.to_pylist()
        return pa.StructArray.from_arrays([pa.array([list(of(w)) if w else [] for w in texts], pa.list_(pa.string())) for of in (whole_keys, piece_keys, place_keys)], names=["whole", "pieces", "places"])

    return run(core)


def near_word_cores(units: DataFrame, verified: Column, radius: int = RADIUS) -> DataFrame:
    """``a, b``: as ``hamming_cores``, for near words (``near_words``, to which ``verified`` comes down): what it gives, from shorter lists.

    The parts of sparse vectors have few values, so their lists grow with the table and the pairs in them with its square. Near words
    have whole words but for a letter or two in common, or else the first letter and a piece; those are the keys here, and what has a key in common
    is compared by its vectors as there. Pieces are looked up under the head; where a head is an initial or missing, under that.
    """
    of = units.select("u", "family", "core", "head", "sought", bit_vector(F.col("core")).alias("v"))
    # Words are cut once, however many heads they stand with.
    words = units.select("core").distinct().repartition(units.sparkSession.sparkContext.defaultParallelism).select("core", _keys(F.col("core")).alias("keys"))
    of = of.join(words.select("core", "keys.*").hint("merge"), "core")
    known = F.length("head") > 1
    under = lambda keys, context: F.transform(F.col(keys), lambda k: F.xxhash64(k, context, F.col("family")))
    whole, head = under("whole", F.lit("")), F.concat(F.lit("T"), F.col("head"))
    left = F.when(known, F.concat(whole, under("pieces", head), under("pieces", F.lit("A")))).otherwise(F.concat(whole, under("places", F.lit("B"))))
    right = F.concat(whole, under("pieces", F.lit("B")), under("places", F.when(known, head).otherwise("A")))
    keyed = lambda df, keys: df.select("u", "core", "head", "v", F.explode(keys).alias("key"))
    x, y = (lambda f: F.col(f"a.{f}")), (lambda f: F.col(f"b.{f}"))
    inner = lambda c: F.substring(c, F.lit(2), F.length(c) - 2)
    ends = (F.substring(x("core"), 1, 1) == F.substring(y("core"), 1, 1)) | (F.substring(x("core"), -1, 1) == F.substring(y("core"), -1, 1))
    ends = ends | ((F.length(x("core")) > 4) & (F.length(y("core")) > 4) & (inner(x("core")) == inner(y("core"))))
    close = (x("key") == y("key")) & (F.bit_count(x("v").bitwiseXOR(y("v"))) <= radius) & (x("u") != y("u")) & ends & F.coalesce(agrees(x("head"), y("head")), F.lit(True))
    # What is exploded is never broadcast: its size isn't known beforehand.
    found = keyed(of.where("sought"), left).alias("a").join(keyed(of, right).alias("b").hint("merge"), close)
    found = found.select(F.least(x("u"), y("u")).alias("a"), F.greatest(x("u"), y("u")).alias("b"), F.least(x("core"), y("core")).alias("x"), F.greatest(x("core"), y("core")).alias("y")).distinct()
    return found.where(verified).select("a", "b")
