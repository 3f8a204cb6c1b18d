"""Matching entities across sources without keys: q-gram bit vectors, multi-index Hamming hashing, calibrated confidences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debtloom.llm.companies import split_by_number
from debtloom.llm.names import agrees
from debtloom.llm.variants import near_words, parsed_entities
from debtloom.llm.vectors import bit_vector, dice, near_word_cores
from debtloom.session import settle

#: Weights of the parts of a name: its rare word, what tells sisters apart, what may be missing.
FIELD_WEIGHTS = {"core": 3.0, "head": 2.0, "rest": 1.0}
BINS = 20


def near_cores(units: DataFrame) -> DataFrame:
    return near_word_cores(units, near_words(F.col("x"), F.col("y")))


def weighted_dice(a: str, b: str) -> Column:
    """The mean of Dice's coefficients of the parts that both names have, by field weight; an initial is nine tenths of its word."""
    of = lambda side, f: F.col(f"{side}.{f}")
    top, bottom = F.lit(0.0), F.lit(0.0)
    for f, w in FIELD_WEIGHTS.items():
        both = (of(a, f) != "") & (of(b, f) != "")
        initial = (F.length(of(a, f)) == 1) | (F.length(of(b, f)) == 1)
        alike = F.when(initial, F.when(agrees(of(a, f), of(b, f)), 0.9).otherwise(0.0)).otherwise(dice(bit_vector(of(a, f)), bit_vector(of(b, f))))
        top, bottom = top + F.when(both, w * alike).otherwise(0.0), bottom + F.when(both, w).otherwise(0.0)
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def calibrated(scored: DataFrame, score: str, label: str, route: str = "route", chance: float = 0.0, bins: int = BINS) -> DataFrame:
    """Adds ``confidence``: the share of true pairs among those of like score by one route, made to rise with the score (pool adjacent violators).

    ``label`` tells of a pair whether a sign of truth is there, which is so by ``chance`` for wrong pairs too; null where nothing is known. All labelled
    pairs count. The driver holds a count per route and bin; where labels are few a little of the score itself is mixed in, and without labels it is the confidence.
    """
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    counts: dict[str, dict[int, tuple[int, int]]] = {}
    for r in scored.groupBy(route, at.alias("bin")).agg(F.count_if(label).alias("yes"), F.count(label).alias("n")).collect():
        counts.setdefault(r[route], {})[r["bin"]] = (r["yes"], r["n"])
    steps: dict[str, list[float]] = {}
    for name, found in counts.items():
        blocks: list[list[float]] = []
        for k in range(bins):
            yes, n = found.get(k, (0, 0))
            blocks.append([min(n, max(0.0, (yes - n * chance) / (1 - chance))) + (k + 0.5) / bins, n + 1.0, 1])
            while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
                last = blocks.pop()
                blocks[-1] = [blocks[-1][i] + last[i] for i in range(3)]
        steps[name] = [b[0] / b[1] for b in blocks for _ in range(int(b[2]))]
    known = reduce(lambda rest, item: F.when(F.col(route) == item[0], F.element_at(F.lit(item[1]), at + 1)).otherwise(rest), steps.items(), F.col(score))
    return scored.withColumn("confidence", known.cast("double"))


def match_entities(
    left: DataFrame, left_id: str, left_name: str, left_number: Column, right: DataFrame, right_id: str, right_name: str, aliases: Sequence[tuple[DataFrame, str, str]], numbers: DataFrame, number_column: str, least: float = 0.5,
    check: tuple[str, str] | None = None,
) -> DataFrame:
    """``left_id, right_id, confidence``: rows of two sources that stand for the same entity.

    ``aliases`` are further names of right rows: a DataFrame with ``right_id``, the column of the name and a label; ``numbers`` has identifiers of
    right rows. The bigrams of the parts of all names are vectors of 64 bits. Names whose rare words are near by ``near_word_cores`` are put together
    (``parsed_entities``), then parted and joined by the left rows' numbers (``split_by_number``), so that each left row and each
    right name belongs to one entity at most. Right rows whose own names are of one entity share what any of them leads to. Routes from a right row to an entity:

    * ``own``: its own name; each label of ``aliases``: that name, however unlike the own one; the score is the field-weighted Dice coefficient
      of the name and the entity's most frequent one;
    * ``number``: one of its identifiers, which belongs to the entity that uses it most; the score is Dice's coefficient of the left
      rows that have the number and those of the entity that have one. A number that another right row of the entity's own name holds is that one's.

    Scores become confidences by route: ``check`` names a left and a right column that agree for one entity, and what their agreement exceeds chance by
    is the share of true pairs (``calibrated``). Routes that lead to one entity strengthen each other, as independent signs do: the pair is wrong only if
    each of them is. Pairs of at least ``least`` are returned, all rows of both sides.

    Defined cases: rows with a null id match nothing, left rows without a name only by their number, right rows without one by what they lead to; repeated
    rows match like the first; empty tables give no rows.
    """
    lrows = left.select(F.col(left_id).alias("l"), F.col(left_name).alias("name"), left_number.alias("number"), *([F.upper(F.trim(check[0])).alias("sign")] if check else [F.lit(None).cast("string").alias("sign")])).where("l is not null").distinct()
    rrows = right.select(F.col(right_id).alias("r"), F.col(right_name).alias("name"), *([F.upper(F.trim(check[1])).alias("sign")] if check else [F.lit(None).cast("string").alias("sign")])).where("r is not null").distinct()
    others = [df.select(F.col(right_id).alias("r"), F.col(c).alias("name"), F.lit(label).alias("route")) for df, c, label in aliases]
    others = settle(reduce(DataFrame.unionByName, others).where("r is not null and length(trim(name)) > 0").distinct(), "aliases")
    ids = settle(numbers.select(F.col(right_id).alias("r"), F.col(number_column).alias("number")).where("r is not null and number is not null").distinct(), "identifiers")
    # Spellings are sought of left names, and of right rows that lead on: what one spelling leads to holds for all.
    leading = rrows.join(others.select("r").unionByName(ids.select("r")).distinct(), "r", "left_semi")
    names = parsed_entities([(lrows, "name"), (rrows, "name"), (others, "name")], pairs_of=near_cores, sought=lrows.select("name").unionByName(leading.select("name")))
    names = settle(names, "entities").select("name", "entity", "node", "u", "core", "head", "rest")
    l = settle(lrows.join(names, "name", "left"), "left-rows")
    by_node, by_number = split_by_number(l)
    l = settle(l.join(by_node, "node", "left").join(by_number.withColumnRenamed("company", "other"), "number", "left").withColumn("c", F.coalesce("company", F.when(F.col("entity").isNull(), F.col("other")))).where("c is not null").select("l", "number", "sign", "c", "entity", "node", "u", "core", "head", "rest"), "left-companies")
    known = l.where("node is not null").groupBy("c", "entity", "u", "node", "core", "head", "rest").agg(F.count("*").alias("n"))
    known = settle(known, "company-names")
    faces = known.groupBy("c").agg(F.max_by(F.struct("core", "head", "rest"), F.struct("n", "node")).alias("face")).select("c", "face.*")
    # A right name is of the company that has its very parts, else of one with its rare word and trade, else the one of the entity whose usual rare word is nearest.
    rnames = rrows.select("r", "name", F.lit("own").alias("route")).unionByName(others).join(names, "name").select("r", "route", "entity", "u", "node", "core", "head", "rest")
    rnames = settle(rnames, "right-names")
    nodes = rnames.select("entity", "u", "node", "core", "head", "rest").distinct()
    several = known.groupBy("entity").agg(F.count_distinct("c").alias("k"), F.min("c").alias("c"))
    one = nodes.join(several.where("k = 1").select("entity", "c"), "entity").select("node", "c")
    torn = nodes.join(several.where("k > 1").select("entity"), "entity", "left_semi")
    usual = known.join(several.where("k > 1").select("entity"), "entity", "left_semi").groupBy("entity", "c").agg(F.max_by("core", F.struct("n", "core")).alias("core"), F.sum("n").alias("n"))
    nearest = torn.alias("t").join(usual.alias("k"), "entity")
    nearest = nearest.groupBy("node").agg(F.min_by("c", F.struct(F.levenshtein("t.core", "k.core"), (-F.col("n")).alias("n"), "c")).alias("near"))
    exact = torn.join(known.groupBy("node").agg(F.max_by("c", F.struct("n", "c")).alias("same")), "node", "left").select("node", "same")
    placed = settle(one.unionByName(nearest.join(exact, "node").select("node", F.coalesce("same", "near").alias("c"))), "placed-names")
    rnames = settle(rnames.join(placed, "node", "left").withColumn("g", F.coalesce("c", "entity")), "placed-rows")
    groups = rrows.select("r", "sign").join(rnames.where("route = 'own'").select("r", "g").distinct(), "r", "left").select("r", "sign", F.coalesce("g", F.xxhash64(F.lit("row"), "r")).alias("g"))
    groups = settle(groups, "right-groups")
    members = groups.select("r", "g").distinct()
    leads = rnames.where("c is not null").select("r", "route", "c", "core", "head", "rest").join(members, "r").select("g", "route", "c", "core", "head", "rest").distinct()
    # Each step is settled by itself: a plan of few exchanges at a time is kind to the driver.
    by_name = settle(leads.alias("x").join(faces.alias("y"), "c").select("g", "c", "route", weighted_dice("x", "y").alias("score")), "by-name")
    by_id = settle(_by_number(l, members, ids), "by-number")
    lsigns, rsigns = settle(_usual(l, "c"), "left-signs"), settle(_usual(groups, "g"), "right-signs")
    routes = by_name.unionByName(by_id).groupBy("g", "c", "route").agg(F.max("score").alias("score"))
    scored = calibrated(settle(_signed(routes, lsigns, rsigns), "routes"), "score", "label", chance=_chance(lsigns, rsigns))
    found = scored.groupBy("g", "c").agg((1 - F.exp(F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(0.9999)))))).alias("confidence")).where(F.col("confidence") >= least)
    out = l.select("l", "c").distinct().join(found, "c").join(members, "g")
    return out.groupBy(F.col("l").alias(left_id), F.col("r").alias(right_id)).agg(F.round(F.max("confidence"), 6).alias("confidence"))


def _by_number(l: DataFrame, members: DataFrame, ids: DataFrame) -> DataFrame:
    """``g, c, route, score``: right groups with a number of the left entity ``c``."""
    known = l.where("number is not null").select("l", "number", "c").distinct()
    shares = known.groupBy("number", "c").agg(F.count("*").alias("n")).join(known.groupBy("number").agg(F.count("*").alias("n_number")), "number").join(known.groupBy("c").agg(F.count("*").alias("n_entity")), "c")
    shares = shares.select("number", "c", (2 * F.col("n") / (F.col("n_number") + F.col("n_entity"))).alias("score"))
    owners = shares.groupBy("number").agg(F.max(F.struct("score", "c")).alias("m")).select("number", F.col("m.c").alias("c"), F.col("m.score").alias("score"))
    held = ids.join(members, "r").select("number", "g").distinct().join(owners, "number")
    named = held.where("g = c").select("number").distinct()
    kept = held.join(named.withColumn("taken", F.lit(True)), "number", "left").where("taken is null or g = c")
    return kept.select("g", "c", F.lit("number").alias("route"), "score")


def _usual(df: DataFrame, key: str) -> DataFrame:
    """The most frequent ``sign`` of a group."""
    return df.where("length(sign) > 0").groupBy(key, "sign").agg(F.count("*").alias("n")).groupBy(key).agg(F.max_by("sign", F.struct("n", "sign")).alias("sign"))


def _signed(routes: DataFrame, lsigns: DataFrame, rsigns: DataFrame) -> DataFrame:
    """``routes`` with ``label``: whether the signs of both sides agree."""
    a, b = lsigns.withColumnRenamed("sign", "lsign"), rsigns.withColumnRenamed("sign", "rsign")
    return routes.join(a, "c", "left").join(b, "g", "left").select("g", "c", "route", "score", (F.col("lsign") == F.col("rsign")).alias("label"))


def _chance(lsigns: DataFrame, rsigns: DataFrame) -> float:
    """How likely the signs of two entities agree that have nothing to do with each other."""
    spread = lambda df, c: df.groupBy("sign").agg(F.count("*").alias("n")).select("sign", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias(c))
    return min(0.99, spread(lsigns, "p").join(spread(rsigns, "q"), "sign").agg(F.coalesce(F.sum(F.col("p") * F.col("q")), F.lit(0.0))).first()[0])
