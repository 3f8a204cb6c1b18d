"""Names against a list of names: equal keys, the best near key, a unique longer key; and organisations by identifier or name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtloom.functions.text import distinctive, identifier, letter_bits, name_key, token_sort, token_sort_ratio
from debtloom.operators.state import first_by
from debtloom.session import settle

CUTOFF = 92


def key_list(df: DataFrame, names: list[str], order: list[str]) -> DataFrame:
    """``key, original, pos``: the keys of several name columns in row order, then column order; the first spelling of a key stays."""
    each = df.select(F.struct(*order).alias("row"), F.posexplode(F.array(*names)).alias("col", "original"))
    keyed = each.select("row", "col", F.trim("original").alias("original"), name_key(F.col("original")).alias("key")).where("length(key) > 0")
    first = first_by(keyed, ["key"], [F.col("row"), F.col("col"), F.col("original")])
    return first.select("key", "original", F.struct("row", "col").alias("pos"))


def _most_edits(n: Column, m: Column, cutoff: float) -> Column:
    """The most insertions and deletions between texts of two lengths that the cutoff allows: their number is as odd or even as the lengths' sum."""
    most = F.floor((1 - cutoff / 100) * (n + m) + 1e-6).cast("int")
    return most - (most + n + m) % 2


def _lengths(n: Column, cutoff: float) -> Column:
    """The lengths of the texts that can be near one of length ``n``."""
    lost = 1 - cutoff / 100
    each = F.sequence(F.greatest(F.lit(1), F.floor(n * (1 - lost) / (1 + lost)).cast("int")), F.ceil(n * (1 + lost) / (1 - lost)).cast("int"))
    return F.filter(each, lambda m: _most_edits(n, m, cutoff) >= F.abs(n - m))


def _piece(text: Column, n: Column, d: Column, i: Column, shift: Column) -> Column:
    """The hash of what stands in ``text``, moved by ``shift``, at the place of piece ``i`` of a text of length ``n`` cut into ``d + 1``; null outside of it."""
    start, end = F.floor(i * n / (d + 1)).cast("int"), F.floor((i + 1) * n / (d + 1)).cast("int")
    return F.when((start + shift >= 0) & (end + shift <= F.length(text)), F.xxhash64(n, d, i, F.substring(text, start + shift + 1, end - start)))


def _posted(texts: DataFrame, cutoff: float) -> DataFrame:
    """``texts`` (``t``) with ``n``, ``bits`` and a row for each piece ``h``, cut for each number of edits that can be."""
    n = F.col("n")
    each = texts.withColumn("n", F.length("t")).withColumn("bits", letter_bits(F.col("t")))
    each = each.withColumn("d", F.explode(F.array_distinct(F.transform(_lengths(n, cutoff), lambda m: _most_edits(n, m, cutoff)))))
    return each.withColumn("h", F.explode(F.transform(F.sequence(F.lit(0), F.col("d")), lambda i: _piece(F.col("t"), n, F.col("d"), i, F.lit(0))))).drop("d")


def _looked_up(texts: DataFrame, cutoff: float) -> DataFrame:
    """``texts`` (``s``) with ``m``, ``bits`` and a row for each piece ``h`` that a near text can have in common."""
    m, n, d = F.col("m"), F.col("n"), F.col("d")
    each = texts.withColumn("m", F.length("s")).withColumn("bits", letter_bits(F.col("s"))).withColumn("n", F.explode(_lengths(m, cutoff))).withColumn("d", _most_edits(n, m, cutoff))
    gone, come = ((d + n - m) / 2).cast("int"), ((d - n + m) / 2).cast("int")
    places = F.transform(F.sequence(F.lit(0), d), lambda i: F.transform(F.sequence(F.greatest(F.lit(0), i - come), F.least(i, gone)), lambda lost: _piece(F.col("s"), n, d, i, i - 2 * lost)))
    return each.withColumn("h", F.explode(F.array_distinct(F.flatten(places)))).where("h is not null").drop("n", "d")


def near_keys(left: DataFrame, right: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``key, candidate, score``: all keys of both lists whose token-sorted ratio is at least ``cutoff``, without comparing all pairs.

    The ratio bounds the insertions and deletions ``d`` between two texts by a share of their lengths. A text of ``left`` is cut into ``d + 1`` pieces. The
    first piece up to which there are no more edits than pieces before it is untouched, and has just one edit for each of those before it; so piece ``i`` is
    looked up in ``right`` where ``i`` edits can have moved it and the rest suffice behind it, a few places for each length. What shares a piece is
    compared by its letters as bits first, then by edits; what is left is scored in full.
    """
    a = left.select("key").distinct().select("key", token_sort(F.col("key")).alias("t")).where("length(t) > 0")
    b = right.select(F.col("key").alias("candidate")).distinct().select("candidate", token_sort(F.col("candidate")).alias("s")).where("length(s) > 0")
    x, y = _posted(a, cutoff).alias("x"), _looked_up(b, cutoff).alias("y")
    n, m, p, q = F.col("x.n"), F.col("y.m"), F.col("x.bits"), F.col("y.bits")
    d = _most_edits(n, m, cutoff)
    # No letters are missing on a side but for the edits, and no text is nearer by substitutions too than the bound on insertions and deletions.
    letters = (2 * F.bit_count(p.bitwiseAND(F.bitwise_not(q))) <= d + n - m) & (2 * F.bit_count(q.bitwiseAND(F.bitwise_not(p))) <= d - n + m)
    # In one condition, which is taken from left to right; a filter behind the join would come first.
    close = (F.col("x.h") == F.col("y.h")) & letters & (F.call_function("levenshtein", F.col("t"), F.col("s"), d) >= 0)
    # What is exploded is never broadcast: its size isn't known beforehand.
    pairs = x.join(y.hint("merge"), close).select("key", "candidate").distinct()
    return pairs.withColumn("score", F.when(F.col("key") == F.col("candidate"), 100.0).otherwise(token_sort_ratio(F.col("key"), F.col("candidate")))).where(F.col("score") >= cutoff)


def longer_key(left: DataFrame, right: DataFrame) -> DataFrame:
    """``key, candidate``: the only key of ``right`` that goes on behind a distinctive key and a space. Keys are joined by their beginnings of whole words."""
    a = left.select("key").distinct().where(distinctive(F.col("key")))
    words = F.split("candidate", " ")
    b = right.select(F.col("key").alias("candidate")).distinct().where(F.size(words) > 1)
    starts = b.select("candidate", F.explode(F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))).alias("key"))
    return a.join(starts, "key").groupBy("key").agg(F.count("*").alias("n"), F.min("candidate").alias("candidate")).where("n = 1").select("key", "candidate")


def match_names(left: DataFrame, right: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``key, original, rung``: each key of ``left`` with the list's spelling by the first rung that gives one: exact, near (best score, then list order), longer."""
    # Both are read once for each rung.
    left, right = settle(left.select("key").distinct(), "name-keys"), settle(right.select("key", "original", "pos"), "name-list")
    exact = left.join(right, "key").select("key", F.col("original").alias("exact"))
    rest = left.where("length(key) > 0").join(exact.select("key"), "key", "left_anti")
    listed = right.select(F.col("key").alias("candidate"), "original", "pos")
    near = near_keys(rest, right, cutoff).join(listed, "candidate").groupBy("key").agg(F.min_by("original", F.struct((-F.col("score")).alias("s"), "pos")).alias("near"))
    longer = longer_key(rest, right).join(listed, "candidate").select("key", F.col("original").alias("longer"))
    found = left.join(exact, "key", "left").join(near, "key", "left").join(longer, "key", "left")
    return found.select("key", F.coalesce("exact", "near", "longer").alias("original"), F.when(F.col("exact").isNotNull(), "exact").when(F.col("near").isNotNull(), "near").when(F.col("longer").isNotNull(), "longer").alias("rung")).where("original is not null")


def org_identifiers(orgs: DataFrame) -> DataFrame:
    """``org_id, number``: the nine digits of every identifier among an organisation's custom fields."""
    ids = orgs.select("org_id", F.explode("custom_fields").alias("f")).select("org_id", identifier(F.col("f")).alias("d"))
    return ids.where("d != ''").select("org_id", F.expr("right(d, 9)").alias("number")).distinct()


def org_names(orgs: DataFrame) -> DataFrame:
    """``key, org_id, original``: an organisation's name and the custom fields that could be names; the first organisation of a key stays."""
    shaped = F.filter(F.coalesce("custom_fields", F.array().cast("array<string>")), lambda f: ~f.contains("@") & ~f.rlike(r"(?i)^(https?://|www\.)") & (identifier(f) == "") & f.rlike("[A-Za-z]{3}"))
    each = orgs.select("org_id", F.posexplode(F.concat(F.array("org_name"), shaped)).alias("pos", "original")).where("original is not null")
    keyed = each.select("org_id", "pos", "original", name_key(F.col("original")).alias("key")).where("length(key) > 0")
    return first_by(keyed, ["key"], [F.col("org_id"), F.col("pos")]).select("key", "org_id", "original")
