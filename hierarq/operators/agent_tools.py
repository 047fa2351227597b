"""The tools an agent calls, by name. Those that read take the session and the tables' folder; those
that change plans are functions of a snapshot and return the new one with the results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hierarq.common import current_version, table
from hierarq.operators.ordered import numbered
from hierarq.operators.serve import first_delivery
from hierarq.operators.snapshot import plan_changes


def available_states(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "source_documents").select("state").where("state IS NOT NULL").distinct()


def age_ranges(s: SparkSession, d: str, state: str) -> DataFrame:
    own = table(s, d, "source_documents").where(F.col("state") == state)
    return own.where("trim(coalesce(age_band, '')) <> ''").select(F.col("age_band").alias("age_range")).distinct()


def indicators(s: SparkSession, d: str, state: str, age_range: str | None = None) -> DataFrame:
    """Leaves of a state (and age range) with the names above them, by inner joins: a leaf without a whole chain
    is not there. ``place`` is the order by domain name, strand name and code. Deleted ones stay."""
    docs = first_delivery(table(s, d, "source_documents"), "id", "loaded_at", ["id", "state", "age_band"]).where(F.col("state") == state)
    if age_range is not None:
        docs = docs.where(F.col("age_band") == age_range)
    cur = lambda name, parent: current_version(table(s, d, name), columns=[parent, "code", "name"])
    dom = cur("domains", "document_id").select(F.col("id").alias("domain_id"), "document_id", F.col("name").alias("domain_name"))
    st = cur("strands", "domain_id").select(F.col("id").alias("strand_id"), "domain_id", F.col("name").alias("strand_name"))
    sub = cur("sub_strands", "strand_id").select(F.col("id").alias("sub_strand_id"), "strand_id", "code", F.col("name").alias("sub_strand_name"))
    rows = docs.withColumnRenamed("id", "document_id").join(dom, "document_id").join(st, "domain_id").join(sub, "strand_id")
    order = [F.col(c) for c in ("domain_name", "strand_name", "code", "sub_strand_id")]
    return numbered(rows.select("state", "age_band", "sub_strand_id", "code", "domain_name", "strand_name", "sub_strand_name"), ["state"], order)


def _one(op: str):  # noqa: ANN202
    def change(plans: DataFrame, changes: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
        return plan_changes(plans, changes.withColumn("op", F.lit(op)), at)

    return change


def get_plan(plans: DataFrame, plan_id: object, user_id: object) -> DataFrame:
    """A user's own plan; another's is not found."""
    return plans.where((F.col("plan_id") == F.lit(plan_id)) & (F.col("user_id") == F.lit(user_id)))


TOOLS = {"getAvailableStates": available_states, "getAgeRanges": age_ranges, "getIndicators": indicators, "createPlan": _one("create"),
         "updatePlan": _one("update"), "deletePlan": _one("delete"), "getPlan": get_plan}
