"""Words that many names share, learnt from the names: trades and roles of any domain, with their short forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtloom.llm.names import _KIN, _LEGAL, _TITLES, edits, known_word

#: A word is common that stands in this share of all names, in LEAST names at any rate, beside a different rare word in every fifth of them. A name has a
#: handful of words, so there are no more common ones than that over the share: a bound for what the driver holds.
SHARE, LEAST, VARIETY = 0.005, 40, 0.2
#: A short form stands beside the same rare words as the full one, this share of them at least.
TOGETHER = 0.3
#: Words of notes beside names, which are no part of them.
_NOTES = frozenset("amp nbsp quot apos branch account accounts dept department sale sales finance rates division office liq liquidation sole trader abn holder trading administrators appointed receivers administration deregistered".split())


def _words(name: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(name), F.lit(r"\p{L}{3,}"), F.lit(0)))


def stands_for(short: str, full: str) -> bool:
    """Whether a word could be a short form or a misspelling of another: its letters in order from the same first one, or a slip apart."""
    if short[0] == full[0] and len(short) < len(full):
        rest = iter(full)
        if all(c in rest for c in short):
            return True
    return edits(short, full) <= (1 if len(full) < 7 else 2)


def learn_words(names: DataFrame, name: str) -> tuple[tuple[str, str, str], ...]:
    """``(word, kind, stands_for)`` of common words that the lists don't know: ``role`` for what mostly ends a name of several common words, else ``trade``.

    ``names`` are distinct. Common words are counted over all of them. A word that could be a short form of a more frequent one, and
    stands beside the same rare words, stands for it. Names whose words are all rare, or all listed, teach nothing; so does an empty table.
    """
    tokens = names.select(_words(F.col(name)).alias("ws"))
    n = names.count()
    counts = tokens.select(F.explode("ws").alias("w")).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= max(LEAST, SHARE * n))
    often = {r["w"]: r["n"] for r in counts.collect() if r["w"] not in _NOTES | _LEGAL | _KIN | _TITLES and known_word(r["w"]) is None}
    if not often:
        return ()
    listed = sorted(often)
    common = F.filter("ws", lambda w: w.isin(*listed))
    rare = F.filter("ws", lambda w: ~w.isin(*listed, *_NOTES, *_LEGAL, *_KIN, *_TITLES))
    each = tokens.select(common.alias("cs"), F.array_join(rare, " ").alias("rare")).where("size(cs) > 0").select("rare", F.size("cs").alias("k"), F.posexplode("cs").alias("i", "c"))
    beside = each.where("rare != ''").select("c", "rare").distinct()
    stats = {r["c"]: r for r in each.groupBy("c").agg(F.avg(F.when(F.col("k") > 1, (F.col("i") == F.col("k") - 1).cast("double"))).alias("last")).join(beside.groupBy("c").agg(F.count("*").alias("partners")), "c", "left").collect()}
    a, b = beside.alias("a"), beside.alias("b")
    both = {(r["x"], r["y"]): r["n"] for r in a.join(b, (F.col("a.rare") == F.col("b.rare")) & (F.col("a.c") < F.col("b.c"))).groupBy(F.col("a.c").alias("x"), F.col("b.c").alias("y")).agg(F.count("*").alias("n")).collect()}
    partners = {w: stats[w]["partners"] or 0 for w in listed}
    kept = sorted((w for w in listed if partners[w] >= VARIETY * often[w]), key=lambda w: (-often[w], w))
    full: dict[str, str] = {}
    for i, w in enumerate(kept):
        like = [f for f in kept[:i] if full[f] == f and stands_for(w, f) and both.get((min(w, f), max(w, f)), 0) >= TOGETHER * partners[w]]
        full[w] = max(like, key=lambda f: both[min(w, f), max(w, f)], default=w)
    kind = lambda w: "role" if (stats[w]["last"] or 0) > 0.6 else "trade"
    return tuple(sorted((w, kind(full[w]), full[w]) for w in kept))
