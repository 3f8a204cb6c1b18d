"""Debts rolled up to companies, rules in order, and the rank of what remains."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtloom.functions.people import is_person
from debtloom.functions.text import exposure_score, money, name_key
from debtloom.operators.name_match import match_names
from debtloom.session import settle

MATTER_FIELDS = ("matter_id", "debtor_company", "amount_aud", "amount_known", "source", "source_document", "debtor_industry", "debtor_state")


def admissible(creditors: DataFrame, key: Column | None = None) -> DataFrame:
    """Rows of other parties with a key; the key is made of the name unless given."""
    # Behind a generator: a filter on a plain column is pushed down, and the key would be made twice.
    keyed = creditors.withColumn("name_key", F.explode(F.array(key if key is not None else name_key(F.col("creditor_name")))))
    return keyed.where(~F.coalesce("related_party", F.lit(False)) & (F.length("name_key") > 0))


def roll_up(creditors: DataFrame, order: str) -> DataFrame:
    """One row per key: the longest spelling (ties: the first by ``order``), the sum of known amounts, whether any is known, matters, industries.

    An unknown amount is no zero: it adds nothing, and a key of only unknown amounts has no known exposure. Amounts are summed as decimals,
    so the order of rows doesn't matter. One aggregation, combined before the shuffle; a key that holds a tenth of the rows is
    merged from partial results.
    """
    amount = F.when(F.coalesce("amount_known", F.lit(True)), F.col("amount_aud").cast("decimal(18,2)"))
    spelling = F.trim("creditor_name")
    return creditors.groupBy("name_key").agg(
        F.max_by(spelling, F.struct(F.length(spelling), (-F.col(order)).alias("o"))).alias("display_name"),
        F.coalesce(F.sum(amount), F.lit(0).cast("decimal(28,2)")).cast("double").alias("total_exposure_aud"),
        F.coalesce(F.bool_or(F.coalesce("amount_known", F.lit(True))), F.lit(False)).alias("exposure_known"),
        F.count_distinct("matter_id").alias("matter_count"),
        F.array_sort(F.collect_set(F.nullif("debtor_industry", F.lit("")))).alias("debtor_industries"),
        F.count("*").alias("n_rows"),
    )


def scored(prospects: DataFrame) -> DataFrame:
    return prospects.withColumn("score", exposure_score(F.col("matter_count"), F.col("total_exposure_aud"), F.col("exposure_known")))


def first_rule(name: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Category and reason of the first rule, in order, whose pattern is found in a name; null where none is."""
    category, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
    for pattern, cat, why in reversed(rules):
        hit = name.rlike(f"(?i){pattern}")
        category, reason = F.when(hit, cat).otherwise(category), F.when(hit, why).otherwise(reason)
    return category, reason


def cascade(prospects: DataFrame, steps: Sequence[tuple[Column, Column]]) -> DataFrame:
    """Adds ``disqualified_reason``, that of the first step whose condition holds, and ``qualified``; every row is kept."""
    reason = reduce(lambda rest, step: F.when(step[0], step[1]).otherwise(rest), reversed(list(steps)), F.lit(None).cast("string"))
    return prospects.withColumn("disqualified_reason", reason).withColumn("qualified", F.col("disqualified_reason").isNull())


def below_floor(floor: float) -> tuple[Column, Column]:
    """A known exposure below the floor; an unknown one passes."""
    return F.col("exposure_known") & (F.col("total_exposure_aud") < floor), F.concat(F.lit("Exposure "), money(F.col("total_exposure_aud")), F.lit(f" is below ${floor:,.0f}"))


def qualify(prospects: DataFrame, floor: float, rules: Sequence[tuple[str, str, str]], clients: DataFrame | None = None) -> DataFrame:
    """Prospects with the first reason against each: a small exposure, a rule, a person, a client; every row is kept.

    ``clients`` is a list of names (``key_list``); a prospect is a client by an equal, a near or a longer name.
    """
    name = F.col("display_name")
    _, reason = first_rule(name, rules)
    steps = [below_floor(floor), (reason.isNotNull(), reason), (is_person(name), F.lit("Individual"))]
    judged = cascade(prospects, steps)
    if clients is None:
        return judged
    # Read by the match and by the join with it. A client counts last, so only those are looked up against whom there is no other reason.
    judged = settle(judged, "prospects")
    matched = match_names(judged.where("qualified").select(F.col("name_key").alias("key")), clients).select(F.col("key").alias("name_key"), F.col("original").alias("client"))
    found = judged.join(matched, "name_key", "left")
    return cascade(found, [(~F.col("qualified"), F.col("disqualified_reason")), (F.col("client").isNotNull(), F.concat(F.lit("Client: "), F.col("client")))])


def ranked(prospects: DataFrame, limit: int | None = None) -> DataFrame:
    """Qualified rows first, then by score, exposure and key; with ``limit`` a top-k without a full sort."""
    order = prospects.orderBy(F.desc("qualified"), F.desc("score"), F.desc("total_exposure_aud"), F.asc("name_key"))
    return order.limit(limit) if limit else order
