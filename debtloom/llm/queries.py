"""Queries of the problems tagged llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debtloom.llm.addresses import same_place_pairs
from debtloom.llm.leaks import leaks
from debtloom.functions.canon import acn_canon, digits
from debtloom.llm.history import known_notices
from debtloom.llm.matching import match_entities
from debtloom.llm.truth import best_records, judged_rows
from debtloom.llm.variants import variant_pairs
from debtloom.llm.packing import pack, token_counts
from debtloom.llm.sentences import sentence_units
from debtloom.session import settle, table


def company_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matter rows with the prospects that are the same company, and how sure that is."""
    prospects, orgs = table(spark, sf_dir, "prospect"), table(spark, sf_dir, "crm_org")
    linked = prospects.where("pipedrive_org_id is not null").select("prospect_id", F.col("pipedrive_org_id").alias("org_id")).join(orgs, "org_id")
    policies = prospects.where("policylist_match is not null").select("prospect_id", F.col("policylist_match").alias("policy_name"))
    clients = policies.join(table(spark, sf_dir, "policy_list").select("policy_name", "client_name"), "policy_name")
    fields = linked.select("prospect_id", F.explode("custom_fields").alias("field")).where(~F.col("field").contains("@"))
    named = fields.where(~F.col("field").rlike(r"(?i)^(https?://|www\.)") & ~F.coalesce(F.length(digits("field")), F.lit(0)).isin(8, 9, 11) & F.col("field").rlike("[A-Za-z]{3}"))
    of_org = fields.select("prospect_id", digits("field").alias("d")).where(F.length("d").isin(8, 9, 11)).select("prospect_id", F.lpad(F.expr("right(d, 9)"), 9, "0").alias("acn"))
    of_abn = prospects.select("prospect_id", digits("abn").alias("d")).where("length(d) = 11").select("prospect_id", F.expr("right(d, 9)").alias("acn"))
    return match_entities(
        table(spark, sf_dir, "matter"), "matter_row", "company_name", acn_canon(F.col("acn")), prospects, "prospect_id", "display_name",
        [(linked, "org_name", "org"), (policies, "policy_name", "policy"), (clients, "client_name", "client"), (named, "field", "field")], of_org.unionByName(of_abn), "acn", check=("state", "state"),
    )


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return company_matches(spark, sf_dir).select("matter_row", "prospect_id")


def p2_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches with their confidences."""
    return company_matches(spark, sf_dir)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_pairs([(table(spark, sf_dir, "creditor"), "creditor_name"), (table(spark, sf_dir, "prospect"), "display_name")])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judged_rows(table(spark, sf_dir, "matter"))
    return judged.where("value != true_value").select("matter_row", "field_name").distinct()


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per company with its true present values and all its states."""
    return best_records(table(spark, sf_dir, "matter"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_place_pairs(table(spark, sf_dir, "creditor"), "address")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_notices(table(spark, sf_dir, "matter_batch"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document, or piece of one, for each capacity."""
    counts = settle(token_counts(table(spark, sf_dir, "documents"), "doc_id", "text"), "token-counts")
    return pack(counts, "doc_id", "n_tokens", table(spark, sf_dir, "pack_size"), "pack_id", "capacity_tokens")


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are, and how many there would be at least, all tokens being poured in without regard to texts."""
    each = p8_containers(spark, sf_dir).groupBy("pack_id", "container_id").agg(F.sum(F.col("token_end") - F.col("token_start")).alias("tokens"))
    sizes = table(spark, sf_dir, "pack_size")
    total = each.groupBy("pack_id").agg(F.count("*").alias("n_containers"), F.sum("tokens").alias("n_tokens"), F.max("tokens").alias("fullest"))
    least = F.ceil(F.col("n_tokens") / F.col("capacity_tokens"))
    return total.join(sizes, "pack_id").select(
        "pack_id", "capacity_tokens", "n_containers", least.alias("least_containers"), "n_tokens", "fullest", F.round(F.col("n_tokens") / F.col("n_containers") / F.col("capacity_tokens"), 4).alias("fill")
    )


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_item"), "item_id", "text")
    return found.select("doc_id", "item_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_units(table(spark, sf_dir, "documents"), "doc_id", "text")


def queries() -> dict:
    return {"p2_found": p2_found, "p2_confidence": p2_confidence, "p3_found": p3_found, "p4_found": p4_found, "p4_records": p4_records, "p6_found": p6_found, "p7_found": p7_found, "p8_containers": p8_containers, "p8_fill": p8_fill, "p9_found": p9_found, "p10_found": p10_found}


def oracle_sql() -> dict[str, str]:
    return {}
