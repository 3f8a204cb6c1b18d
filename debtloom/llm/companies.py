"""Rows of one company, by name and number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtloom.functions.canon import squeeze
from debtloom.llm.graph import connected_components
from debtloom.llm.names import agrees, grams
from debtloom.llm.variants import parsed_entities
from debtloom.llm.vectors import bit_vector, dice
from debtloom.session import settle

#: Digits that a slip changes at most in a number; LENGTH is that of a whole one.
SLIP, LENGTH = 2, 9
#: Minwise hashes of a rare word under which names that share a number are compared.
HASHES = 6


def _most(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """The value of a key with the largest ``n``."""
    return df.groupBy(*key, value).agg(F.sum("n").alias("n")).groupBy(*key).agg(F.max_by(value, F.struct("n", value)).alias(value))


def number_classes(use: DataFrame) -> DataFrame:
    """``entity, number, owner``: the numbers of each entity (``entity, number, n``), each with the most used number that it is a slip of.

    Numbers within SLIP edits are equal in one of their three thirds, so each is compared with the most used number of each
    third only; no pairs are made. A slip of a slip leads on to the same owner.
    """
    thirds = F.array(*[F.concat(F.lit(str(i)), F.substring("number", 1 + 3 * i, 3)) for i in range(3)])
    each = use.select("entity", "number", "n", F.explode(thirds).alias("third"))
    leaders = each.groupBy("entity", "third").agg(F.max(F.struct("n", "number")).alias("m"))
    near = F.when(F.levenshtein(F.col("number"), F.col("m.number")) <= SLIP, F.struct("m.n", "m.number"))
    first = settle(each.join(leaders.hint("merge"), ["entity", "third"]).groupBy("entity", "number").agg(F.max(near)["number"].alias("owner")), "number-owners")
    again = first.select("entity", F.col("number").alias("owner"), F.col("owner").alias("last"))
    return first.join(again, ["entity", "owner"]).select("entity", "number", F.col("last").alias("owner"))


def split_by_number(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``node, company`` of every parsed name, and ``number, company`` of rows without a name, from rows ``number, entity, u, node, core, head``.

    Names of one entity that keep to different numbers, no slips of each other, are different companies after all: each parsed name belongs to the
    number it is used with most; one without numbers to that of the names with the same rare word and trade, else of the entity. Names of
    different entities with one number are one company if half alike and of one trade. Numbers that are not whole say nothing.
    """
    use = settle(known.where("entity is not null").groupBy("entity", "u", "node", "core", "head", "number").agg(F.count("*").alias("n")), "company-numbers")
    numbered = use.where(F.length("number") == LENGTH)
    used = numbered.groupBy("entity", "number").agg(F.sum("n").alias("n"))
    several = used.groupBy("entity").agg(F.count("*").alias("k")).where("k > 1").select("entity")
    owned = settle(numbered.join(number_classes(used.join(several, "entity", "left_semi")), ["entity", "number"]), "owned-numbers")
    of_node, of_unit, of_entity = (settle(_most(owned, key, "owner"), "number-owner") for key in (["entity", "node"], ["entity", "u"], ["entity"]))
    torn = of_node.groupBy("entity").agg(F.count_distinct("owner").alias("k")).where("k > 1").select("entity")
    nodes = use.select("entity", "u", "node").distinct().join(torn, "entity", "left_semi")
    split = (
        nodes.join(of_node.withColumnRenamed("owner", "o1"), ["entity", "node"], "left").join(of_unit.withColumnRenamed("owner", "o2"), ["entity", "u"], "left").join(of_entity.withColumnRenamed("owner", "o3"), "entity", "left")
        .select("node", F.xxhash64("entity", F.coalesce("o1", "o2", "o3")).alias("own"))
    )
    each = settle(use.join(split, "node", "left").select("node", F.coalesce("own", "entity").alias("e"), "core", "head", "number", "n"), "number-names")
    nameless = known.where(F.col("entity").isNull() & (F.length("number") == LENGTH)).select("number", F.xxhash64(F.lit("number"), "number").alias("e"), F.lit("").alias("core"), F.lit("").alias("head"), F.lit(0).cast("bigint").alias("n")).distinct()
    whole = each.where(F.length("number") == LENGTH).groupBy("number", "e", "core", "head").agg(F.sum("n").alias("n"))
    joined = connected_components(_same_number(settle(whole.unionByName(nameless), "number-entities")), "e", "f").select(F.col("node").alias("e"), "component")
    company = F.coalesce("component", "e").alias("company")
    return settle(each.select("node", "e").distinct().join(joined, "e", "left").select("node", company), "node-companies"), nameless.join(joined, "e", "left").select("number", company)


def companies(rows: DataFrame, row_id: str, name: str, number: Column) -> DataFrame:
    """``row_id, company``: the rows of each company, by name as in ``parsed_entities`` and by number as in ``split_by_number``.

    Defined cases: rows without a name belong to the company of their number, or else stand alone; rows without an id are left out;
    numbers that are not whole say nothing; repeated rows count as they come; empty tables give no rows.
    """
    said = rows.select(F.col(row_id).alias("r"), squeeze(F.col(name)).alias("name"), F.when(F.length(number) == LENGTH, number).alias("number")).where("r is not null")
    known = settle(said.join(parsed_entities([(said, "name")]), "name", "left").drop("name"), "company-rows")
    named, nameless = split_by_number(known)
    alone = F.when(F.col("entity").isNull() & F.col("number").isNull(), F.xxhash64(F.lit("row"), "r"))
    found = known.join(named, "node", "left").join(nameless.withColumnRenamed("company", "other"), "number", "left")
    return found.select(F.col("r").alias(row_id), F.coalesce("company", F.when(F.col("entity").isNull(), F.col("other")), alone).alias("company"))


def _same_number(use: DataFrame) -> DataFrame:
    """``e, f``: names with one number that are alike. Each is compared with the most used name of the number and of each minwise hash of its
    rare word, so the links are stars and no pairs of a group are made; a row without a name goes with the most used."""
    bands = F.transform(F.lit(list(range(HASHES))), lambda i: F.xxhash64(i, F.array_min(F.transform(grams(F.col("core"), 2), lambda g: F.xxhash64(i, g)))))
    each = use.select("*", bit_vector(F.col("core")).alias("v"), F.explode(F.concat(F.array(F.lit(0).cast("bigint")), bands)).alias("band"))
    leaders = each.groupBy("number", "band").agg(F.max(F.struct("n", "e", "v", "core", "head")).alias("m"))
    like = (F.col("core") == "") | ((dice(F.col("v"), F.col("m.v")) >= 0.4) & F.coalesce(agrees(F.col("head"), F.col("m.head")), F.lit(True)))
    return each.join(leaders.hint("merge"), ["number", "band"]).where((F.col("e") != F.col("m.e")) & (F.col("m.core") != "") & like).select("e", F.col("m.e").alias("f")).distinct()
