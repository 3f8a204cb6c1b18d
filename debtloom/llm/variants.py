"""Variant spellings of names: a prefix-filtered set-similarity join, verified by soft weighted similarity."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtloom.functions.text import letter_bits
from debtloom.llm.graph import connected_components
from debtloom.llm.names import agrees, grams, with_name_parts
from debtloom.llm.vocabulary import learn_words
from debtloom.session import settle

#: Least Jaccard similarity of the q-grams of two rare parts, and least weighted similarity of two names.
GRAM_SIMILARITY, NAME_SIMILARITY = 0.35, 0.78
#: Two rare words that two letters or more part are both right if the less used has more than one writing, and more than this share of the other's.
SHARE = 0.1


def letters(c: Column) -> Column:
    """The letters of a word in the order of the alphabet."""
    return F.array_join(F.array_sort(F.split(c, "")), "")


def near_words(a: Column, b: Column) -> Column:
    """At most one wrong letter in short words, two from six letters (nine if the first differs), three from eleven with the same first;
    from six letters on also up to four where the letters are the same but for one, only in another order."""
    n, d = F.greatest(F.length(a), F.length(b)), F.levenshtein(a, b, 4)
    first = F.substring(a, 1, 1) == F.substring(b, 1, 1)
    most = F.when((n >= 11) & first, 3).when((n >= 9) | ((n >= 6) & first), 2).otherwise(1)
    return (d >= 0) & ((d <= most) | ((n >= 6) & (F.levenshtein(letters(a), letters(b), 1) >= 0)))


def may_be_near(a: Column, b: Column, bits_a: Column, bits_b: Column) -> Column:
    """Whether two words can be ``near_words`` by their letters as bits (``letter_bits``): each wrong letter takes away one at most. Cheap, and false for most."""
    n = F.greatest(F.length(a), F.length(b))
    most = F.when(n >= 11, 3).when(n >= 6, 2).otherwise(1)
    return (F.bit_count(bits_a.bitwiseAND(F.bitwise_not(bits_b))) <= most) & (F.bit_count(bits_b.bitwiseAND(F.bitwise_not(bits_a))) <= most)


def _prefixes(units: DataFrame, least: float) -> DataFrame:
    """``units`` with ``prefix``: the rarest q-grams of ``core``, of which two similar cores have one in common."""
    each = units.select("u", F.explode(grams(F.col("core"), 2)).alias("g"))
    rarity = each.groupBy("g").agg(F.count("*").alias("n"))
    ordered = each.join(rarity, "g").groupBy("u").agg(F.sort_array(F.collect_list(F.struct("n", "g"))).alias("s"))
    keep = F.size("s") - F.ceil(F.lit(least) * F.size("s")).cast("int") + 1
    return units.join(ordered.select("u", F.size("s").alias("size"), F.transform(F.slice("s", F.lit(1), F.least(F.size("s"), keep)), lambda x: x["g"]).alias("prefix")), "u")


def similar_cores(units: DataFrame, least: float = GRAM_SIMILARITY) -> DataFrame:
    """``a, b``: units (``u, family, core, head``) whose cores are near and whose heads do not rule each other out.

    Cores are sets of q-grams in the order of their rarity over all units. Sets of a Jaccard similarity of at least ``least``
    share a gram among their first ``n - ceil(least * n) + 1``, and their sizes differ by that factor at most; so only these
    prefixes are joined. Where both heads are known they are part of the key; an initial is looked up among heads of that letter, and a
    missing head among all. Equal cores are paired without grams.
    """
    u = settle(_prefixes(units, least), "name-units").withColumn("known", F.length("head")).select("u", "family", "core", "head", "size", "prefix", F.least(F.col("known"), F.lit(2)).alias("known"), letter_bits(F.col("core")).alias("bits"))
    posted = u.select("u", "family", "core", "head", "size", "known", "bits", F.explode("prefix").alias("g"))
    # What is exploded is never broadcast: its size isn't known beforehand.
    a, b = posted.alias("a"), posted.hint("merge").alias("b")
    x, y = (lambda f: F.col(f"a.{f}")), (lambda f: F.col(f"b.{f}"))
    close = (x("u") != y("u")) & (x("size") >= F.lit(least) * y("size")) & (y("size") >= F.lit(least) * x("size")) & may_be_near(x("core"), y("core"), x("bits"), y("bits")) & near_words(x("core"), y("core"))
    same = (x("family") == y("family")) & (x("g") == y("g"))
    full = a.where("known = 2").join(b.where("known = 2"), same & (x("head") == y("head")) & (x("u") < y("u")) & close)
    letter = a.where("known = 1").join(b.where("known >= 1"), same & (x("head") == F.substring(y("head"), 1, 1)) & close)
    missing = a.where("known = 0").join(b, same & close)
    pairs = [d.select(x("u").alias("a"), y("u").alias("b")) for d in (full, letter, missing)]
    whole = u.select("u", "family", "core", "head", "known")
    a, b = whole.alias("a"), whole.alias("b")
    equal = a.where("known < 2").join(b, (x("family") == y("family")) & (x("core") == y("core")) & (x("u") != y("u")) & ((x("known") == 0) | (x("head") == F.substring(y("head"), 1, 1))))
    pairs.append(equal.select(x("u").alias("a"), y("u").alias("b")))
    both = reduce(DataFrame.unionByName, pairs)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def entities_of_names(columns: Sequence[tuple[DataFrame, str]], least: float = NAME_SIMILARITY, pairs_of: Callable[[DataFrame], DataFrame] = similar_cores) -> DataFrame:
    """``name, entity``: as ``parsed_entities``, without the parts."""
    return parsed_entities(columns, least, pairs_of).select("name", "entity")


def _sure() -> Column:
    """Whether a pair of names may be one in spite of the letters ``d`` that part their rare words.

    Where any part them, other parts must not contradict each other. Two or more need a word that is written less often than the other,
    as misspellings are, and further evidence: a third part that both have; or a given name and the same first letter; or the same first letter and
    different last ones (endings are what invented names and surnames share by chance). Three need the third part and the same first letter.
    """
    rest = agrees(F.col("of_a.rest"), F.col("of_b.rest"))
    few = (F.least("m_a", "m_b") == 1) | (F.least("m_a", "m_b") <= SHARE * F.greatest("m_a", "m_b"))
    first = F.substring("core_a", 1, 1) == F.substring("core_b", 1, 1)
    last = F.substring("core_a", -1, 1) == F.substring("core_b", -1, 1)
    third = F.coalesce(rest, F.lit(False))
    person = (F.col("of_a.family") == "person") & F.coalesce(agrees(F.col("of_a.head"), F.col("of_b.head")), F.lit(False))
    return (F.col("d") == 0) | (F.coalesce(rest, F.lit(True)) & ((F.col("d") == 1) | (few & ((third & first) | ((F.col("d") == 2) & (third | (first & (person | ~last))))))))


def parsed_entities(columns: Sequence[tuple[DataFrame, str]], least: float = NAME_SIMILARITY, pairs_of: Callable[[DataFrame], DataFrame] = similar_cores, sought: DataFrame | None = None) -> DataFrame:
    """``name, entity, node, u, family, core, head, rest``: every distinct string of the given columns, with one entity for all spellings of one
    name; ``node`` stands for equal parts, ``u`` for equal parts but ``rest``. ``pairs_of`` gets the units (``u, family, core, head, sought``); of
    those ``sought``, in which a name of the table ``sought`` (``name``) stands, it has to give all near ones.

    Words that many names share and no list knows are learnt first (``learn_words``). A name's parts are its rare word (the invented word or surname), what tells sisters apart (trade, kind of body, given name) and
    what may be missing (role, middle name). Pairs with near rare words come from ``pairs_of``. Their similarity is the mean
    over parts, each weighed by the logarithm of its rarity among all names, so that rare words count most; equal parts count
    1, initials 0.9, near words the share of letters they have in common; a part missing on one side counts nothing. Pairs from
    ``least`` on are links, unless given parts contradict each other, or the letters that part two rare words want more evidence (``_sure``). Of its links to names with more writings a name keeps the best, so that no misspelling joins two
    well-known names. A name that lacks the part by which the names it is linked
    to differ belongs to none of them.

    Defined cases: null and blank names have no row; names without a rare word are one entity if their parts are equal; repeated rows
    count once; empty tables give no rows.
    """
    texts = reduce(DataFrame.unionByName, [df.select(F.col(c).alias("name")) for df, c in columns]).where("length(trim(name)) > 0").distinct()
    texts = settle(texts, "name-texts")
    named = with_name_parts(texts, "name", "name", learnt=learn_words(texts, "name")).withColumn("family", F.when(F.col("kind").isin("person", "body"), F.col("kind")).otherwise("company"))
    part = ["family", "core", "head", "rest"]
    named = named.withColumn("node", F.xxhash64(*part)).withColumn("u", F.xxhash64("family", "core", "head"))
    if sought is not None:
        named = named.join(sought.select("name", F.lit(True).alias("sought")).distinct(), "name", "left")
    named = settle(named.withColumn("sought", F.coalesce("sought", F.lit(False)) if sought is not None else F.lit(True)), "name-parts")
    nodes = settle(named.groupBy("node", "u", *part).agg(F.count("*").alias("n"), F.bool_or("sought").alias("sought")), "name-nodes")
    pairs = pairs_of(nodes.where("core != ''").groupBy("u", "family", "core", "head").agg(F.bool_or("sought").alias("sought")))
    own = nodes.groupBy("u").agg(F.count("*").alias("k")).where("k > 1").select(F.col("u").alias("a"), F.col("u").alias("b"))
    total = F.lit(float(max(1, named.count())))
    rarity = {f: settle(nodes.groupBy("family", F.col(f)).agg(F.log(total / F.sum("n")).alias(f"w_{f}")), "rarity") for f in ("core", "head", "rest")}
    weighed = nodes.join(nodes.groupBy("u").agg(F.sum("n").alias("m")), "u")
    for f, r in rarity.items():
        weighed = weighed.join(r, ["family", f], "left")
    weighed = settle(weighed, "name-weights")
    a, b = weighed.alias("a"), weighed.alias("b")
    x, y = (lambda f: F.col(f"a.{f}")), (lambda f: F.col(f"b.{f}"))
    joined = pairs.unionByName(own).alias("p").join(a, F.col("p.a") == x("u")).join(b, (F.col("p.b") == y("u")) & (x("node") != y("node")) & ((F.col("p.a") != F.col("p.b")) | (x("node") < y("node"))))
    weight = {f: (x(f"w_{f}") + y(f"w_{f}")) / 2 for f in ("core", "head", "rest")}
    alike = {"core": 1 - F.levenshtein(x("core"), y("core")) / F.greatest(F.length(x("core")), F.length(y("core")), F.lit(1))}
    for f in ("head", "rest"):
        alike[f] = F.when((x(f) == "") | (y(f) == ""), None).when(x(f) == y(f), 1.0).when(agrees(x(f), y(f)), 0.9).otherwise(0.0)
    top = sum((F.coalesce(weight[f] * alike[f], F.lit(0.0)) for f in alike), F.lit(0.0))
    bottom = sum((F.when(alike[f].isNotNull(), weight[f]).otherwise(0.0) for f in alike), F.lit(0.0))
    agree = F.coalesce(agrees(x("head"), y("head")), F.lit(True)) & ((x("family") != "person") | F.coalesce(agrees(x("rest"), y("rest")), F.lit(True)))
    links = joined.where(agree).select(
        x("node").alias("a"), y("node").alias("b"), x("m").alias("m_a"), y("m").alias("m_b"), x("n").alias("n_a"), y("n").alias("n_b"), (F.levenshtein(x("core"), y("core")) - F.when((letters(x("core")) == letters(y("core"))) & (x("core") != y("core")), 1).otherwise(0)).alias("d"), F.when(bottom > 0, top / bottom).otherwise(1.0).alias("similarity"),
        x("core").alias("core_a"), y("core").alias("core_b"), *[F.struct(*[side(f).alias(f) for f in ("family", "head", "rest")]).alias(f"of_{n}") for n, side in (("a", x), ("b", y))],
    ).where((F.col("similarity") >= least) & _sure())
    links = settle(links, "name-links")
    seen = links.select(F.col("a").alias("node"), F.col("of_a").alias("own"), F.col("of_b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("of_b").alias("own"), F.col("of_a").alias("other")))
    full = lambda f: F.when(F.length(f"other.{f}") > 1, F.col(f"other.{f}"))
    lacks = lambda f: F.length(F.first(f"own.{f}")) <= 1
    torn = (lacks("head") & (F.min(full("head")) != F.max(full("head")))) | ((F.first("own.family") == "person") & lacks("rest") & (F.min(full("rest")) != F.max(full("rest"))))
    ambiguous = seen.groupBy("node").agg(F.coalesce(torn, F.lit(False)).alias("torn")).where("torn").select("node")
    clear = links.join(ambiguous.withColumnRenamed("node", "a"), "a", "left_anti").join(ambiguous.withColumnRenamed("node", "b"), "b", "left_anti")
    up = F.struct("m_a", "n_a", "a") < F.struct("m_b", "n_b", "b")
    upward = clear.select(F.when(up, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(up, F.col("b")).otherwise(F.col("a")).alias("b"), F.struct(F.round("similarity", 6).alias("s"), F.when(up, F.col("m_b")).otherwise(F.col("m_a")).alias("m")).alias("by"))
    entities = connected_components(upward.groupBy("a").agg(F.max_by("b", F.struct("by", "b")).alias("b")), "a", "b")
    return named.join(entities, "node", "left").select("name", F.coalesce("component", "node").alias("entity"), "node", "u", *part)


def variant_pairs(columns: Sequence[tuple[DataFrame, str]], least: float = NAME_SIMILARITY) -> DataFrame:
    """``name_a, name_b``: all pairs of different strings for one entity, the smaller first."""
    found = settle(entities_of_names(columns, least), "name-entities")
    several = found.groupBy("entity").count().where("count > 1").select("entity")
    known = found.join(several, "entity")
    a, b = known.select("entity", F.col("name").alias("name_a")), known.select("entity", F.col("name").alias("name_b"))
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b")
