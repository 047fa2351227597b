"""References to records that do not exist, are deleted, or came later (problem 3).

Distinct non-null foreign keys are anti-joined with the parent keys; what the distinct keys
turned out to be is joined back to the rows for counts per table and period. Only distinct
keys are shuffled against the parents; keys with very many rows are known by their counts, and
the join back deals their rows over several tasks.

Defined results: null and blank references are no case; copies of a row count once; ties
between versions go to the greater row (``current_version``); a parent whose deleted flag
is null is not deleted; empty tables give empty reports; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hierarq.common import code_key, current_version, salted_join, staged


def parent_state(parents: DataFrame, key: list[str], at: str = "loaded_at", deleted: str | None = "deleted") -> DataFrame:
    """(key..., first_at, gone): when a key first came, and whether its current version is deleted."""
    gone = F.coalesce(F.max_by(F.col(deleted), F.col(at)), F.lit(False)) if deleted else F.lit(False)
    known = parents
    for k in key:
        known = known.where(F.col(k).isNotNull())
    return known.groupBy(*key).agg(F.min(at).alias("first_at"), gone.alias("gone"))


def orphans(rows: DataFrame, key: list[str], state: DataFrame) -> DataFrame:
    """``rows`` (key..., row_key, loaded_at) whose key is missing among the parents' ``state``,
    deleted, or came later than the row, with the ``reason``."""
    wanted = rows
    for k in key:
        wanted = wanted.where(F.col(k).isNotNull())
    keys = staged(wanted.groupBy(*key).agg(F.min("loaded_at").alias("earliest"), F.count("*").alias("n")), "reference-keys")
    missing = keys.join(state, key, "left_anti").select(*key, F.lit("missing").alias("why"),
                                                        F.lit(None).cast(state.schema["first_at"].dataType).alias("first_at"))
    known = keys.join(state, key).where(F.col("gone") | (F.col("first_at") > F.col("earliest"))).select(
        *key, F.when(F.col("gone"), "deleted").otherwise("late").alias("why"), "first_at")
    back = salted_join(wanted, missing.unionByName(known), key, F.col("row_key"), counts=keys)
    return back.where((F.col("why") != "late") | (F.col("first_at") > F.col("loaded_at"))).select(
        *[F.col(c) for c in rows.columns], F.col("why").alias("reason"))


def _cases(table_name: str, found: DataFrame) -> DataFrame:
    period: Column = F.date_format("loaded_at", "yyyy-MM")
    return found.select(F.lit(table_name).alias("table_name"), period.alias("period"), F.col("row_key"), "reason").distinct()


def broken_references(domains: DataFrame, strands: DataFrame, sub_strands: DataFrame, golden: DataFrame,
                      state: str = "AZ") -> DataFrame:
    """(table_name, period, row_key, reason) of all three tables."""
    parts = []
    for name, rows, parents, fk in (("strands", strands, domains, "domain_id"), ("sub_strands", sub_strands, strands, "strand_id")):
        own = current_version(rows.select("id", fk, "deleted", "loaded_at")).where("NOT coalesce(deleted, false)")
        own = own.select(F.col(fk).alias("key"), F.col("id").cast("string").alias("row_key"), "loaded_at")
        parents_state = parent_state(parents.select(F.col("id").alias("key"), "deleted", "loaded_at"), ["key"])
        parts.append(_cases(name, orphans(own, ["key"], parents_state)))
    coded = golden.select("set_id", "state", F.col("test_case_id").alias("row_key"), code_key(F.col("code")).alias("code"),
                          code_key(F.col("parent_code")).alias("parent"), "loaded_at")
    rows = coded.where(F.col("state") == state).select("set_id", F.col("parent").alias("key"), "row_key", "loaded_at").distinct()
    known = parent_state(coded.select("set_id", F.col("code").alias("key"), "loaded_at"), ["set_id", "key"], deleted=None)
    parts.append(_cases("golden_elements", orphans(rows, ["set_id", "key"], known)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def reference_report(cases: DataFrame) -> DataFrame:
    """Cases per table, period and reason."""
    return cases.groupBy("table_name", "period", "reason").agg(F.count("*").alias("cases"))
