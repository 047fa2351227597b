"""Data modification without a transactional store: new snapshot = f(old snapshot, changes).

Keys are unique in a snapshot; of several changes to one key the last by ``seq`` counts. Null
keys are equal to each other. A snapshot is written to a new place and then pointed at, so
a job that is lost half-way leaves the old one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, changes: DataFrame, key: list[str], overwrite: list[str], keep_old_if_null: list[str] = (),
           seq: str | None = None) -> DataFrame:
    """Rows of ``old`` with the changed columns replaced, and new keys appended. Columns in
    ``overwrite`` take the new value, those in ``keep_old_if_null`` the new value unless it is
    null; all others (audit, ids) stay, or are null in new rows."""
    if seq:
        rest = [c for c in changes.columns if c not in key]
        changes = changes.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_r")).select(
            *key, *[F.col(f"_r.{c}").alias(c) for c in rest if c != seq])
    new = changes.select(*[F.col(c).alias(f"_n_{c}") for c in [*key, *overwrite, *keep_old_if_null]], F.lit(True).alias("_new"))
    same = F.lit(True)
    for c in key:
        same = same & old[c].eqNullSafe(new[f"_n_{c}"])
    j = old.withColumn("_old", F.lit(True)).join(new, same, "full")

    def value(c: str) -> Column:
        if c in key:
            return F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_n_{c}"))
        if c in overwrite:
            return F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c))
        if c in keep_old_if_null:
            return F.coalesce(F.col(f"_n_{c}"), F.col(c))
        return F.col(c)

    return j.select(*[value(c).alias(c) for c in old.columns])


def soft_delete(df: DataFrame, where: Column, by: str, at: Column) -> DataFrame:
    """Marks the rows that meet ``where`` and are not deleted yet."""
    hit = F.coalesce(where, F.lit(False)) & ~F.coalesce(F.col("deleted"), F.lit(False))
    return df.withColumns({"deleted": F.when(hit, True).otherwise(F.col("deleted")),
                           "deleted_at": F.when(hit, at).otherwise(F.col("deleted_at")),
                           "deleted_by": F.when(hit, F.lit(by)).otherwise(F.col("deleted_by"))})


def hard_delete(df: DataFrame, where: Column) -> DataFrame:
    return df.where(~F.coalesce(where, F.lit(False)))


def marked(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``df`` with the boolean ``_hit``: its ``column`` is among ``keys`` (one column)."""
    k = keys.select(F.col(keys.columns[0]).alias(column)).where(F.col(column).isNotNull()).distinct().withColumn("_hit", F.lit(True))
    return df.join(k, column, "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))


def cascade_delete(tables: dict[str, DataFrame], level: str, which: Column, by: str, at: Column) -> dict[str, DataFrame]:
    """Soft deletion of the nodes of a ``level`` (domain, strand or sub_strand) that meet ``which``, with
    everything below: ``tables`` holds domain, strand, sub_strand and indicator.

    Strands and sub-strands go by their parent; an indicator goes by its own link to the level that is
    deleted, so one that hangs on a sub-strand of a deleted strand but has no strand of its own
    stays. Semi-joins along the keys, one projection per table."""
    order = ["domain", "strand", "sub_strand"]
    out = dict(tables)
    gone = tables[level].where(which & ~F.coalesce(F.col("deleted"), F.lit(False))).select("id")
    out[level] = soft_delete(tables[level], which, by, at)
    hit = marked(tables["indicator"], gone, f"{level}_id")
    out["indicator"] = soft_delete(hit, F.col("_hit"), by, at).select(*tables["indicator"].columns)
    for above, below in zip(order, order[1:]):
        if order.index(above) >= order.index(level):
            hit = marked(tables[below], gone, f"{above}_id")
            gone = hit.where("_hit").select("id")
            out[below] = soft_delete(hit, F.col("_hit"), by, at).select(*tables[below].columns)
    return out


def affected(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """(inserted, updated, deleted): how many rows of a snapshot a change touched, by its unique key."""
    rest = [c for c in old.columns if c not in key]
    a = old.select(*key, F.xxhash64(*rest).alias("_a"), F.lit(True).alias("_old"))
    b = new.select(*key, F.xxhash64(*rest).alias("_b"), F.lit(True).alias("_new"))
    j = a.join(b, key, "full")
    return j.agg(F.count_if(F.col("_old").isNull()).alias("inserted"),
                 F.count_if(F.col("_old").isNotNull() & F.col("_new").isNotNull() & (F.col("_a") != F.col("_b"))).alias("updated"),
                 F.count_if(F.col("_new").isNull()).alias("deleted"))


# What a new plan must have.
PLAN_NEEDS = ["user_id", "child_name", "child_age", "state", "duration", "content"]
NOT_OWNED = "Plan not found or not owned by user"


def plan_changes(plans: DataFrame, changes: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """(plans, results) after creates, updates and deletes, each scoped to its owner.

    ``changes`` has op (create, update or delete), the plan's columns and ``seq``; of several to one plan
    the last by seq counts. A create needs all of ``PLAN_NEEDS``; an update sets content and, of duration,
    interests and concerns, those that are given. Changes to plans that are not there or belong to
    another user change nothing. Results are (plan_id, op, action, error)."""
    cols = [c for c in plans.columns if c != "plan_id"]
    rest = [c for c in changes.columns if c not in ("plan_id", "seq")]
    one = changes.groupBy("plan_id").agg(F.max_by(F.struct(*rest), "seq").alias("_c"))
    j = plans.select("plan_id", F.struct(*cols).alias("_p")).join(one, "plan_id", "full")
    op = F.col("_c.op")
    lacks: Column = F.lit(None).cast("string")
    for n in reversed(PLAN_NEEDS):
        lacks = F.when(F.coalesce(F.col(f"_c.{n}").cast("string"), F.lit("")) == "", F.lit(f"{n} is required")).otherwise(lacks)
    owned = F.coalesce(F.col("_p.user_id") == F.col("_c.user_id"), F.lit(False))
    taken = F.when(F.col("_p").isNotNull(), F.lit("plan exists"))
    error = F.when(op == "create", F.coalesce(lacks, taken)).when(~owned, F.lit(NOT_OWNED))
    done = op.isNotNull() & error.isNull()

    def value(c: str) -> Column:
        old, new = F.col(f"_p.{c}"), F.col(f"_c.{c}") if c in rest else F.lit(None)
        if c == "updated_at":
            return F.when(done, at).otherwise(old)
        if c == "created_at":
            return F.when(done & (op == "create"), at).otherwise(old)
        changed = new if c == "content" else F.coalesce(new, old) if c in ("duration", "interests", "concerns") else old
        return F.when(done & (op == "create"), new).when(done & (op == "update"), changed).otherwise(old)

    kept = j.where((F.col("_p").isNotNull() | done) & ~(done & (op == "delete")))
    results = j.where(op.isNotNull()).select("plan_id", op.alias("op"), F.when(done, F.concat(F.rtrim(op, F.lit("e")), F.lit("ed"))).alias("action"),
                                             error.alias("error"))
    return kept.select("plan_id", *[value(c).alias(c) for c in cols]), results


def persisted(records: DataFrame, key: str, error: Column) -> tuple[DataFrame, DataFrame]:
    """(rows to store, errors (key, error)): a record that fails does not stop the others."""
    tried = records.withColumn("_error", error)
    return tried.where("_error IS NULL").drop("_error"), tried.where("_error IS NOT NULL").select(key, F.col("_error").alias("error"))


def recorded_runs(runs: DataFrame, outcomes: DataFrame, at: Column) -> DataFrame:
    """``runs`` with one row per run of ``outcomes`` (run_id, country, state, version_year, total, stored, failed): a
    known run gets its status, totals and time of completion anew, the rest stays."""
    new = outcomes.select("run_id", "country", "state", "version_year", F.when(F.col("failed") > 0, "partial").otherwise("completed").alias("status"),
                          F.col("total").alias("total_indicators"), F.col("stored").alias("total_validated"), at.alias("completed_at"))
    known = upsert(runs, new, ["run_id"], ["status", "total_indicators", "total_validated", "completed_at"])
    fresh = new.select("run_id", *[F.col(c).alias(f"_{c}") for c in ("country", "state", "version_year")])
    return known.join(fresh, "run_id", "left").select(*[F.coalesce(c, f"_{c}").alias(c) if c in ("country", "state", "version_year") else F.col(c)
                                                        for c in runs.columns])


def verify(df: DataFrame, where: Column, on: bool, by: str, at: Column) -> DataFrame:
    """Sets or clears the verification of the rows that meet ``where``."""
    hit = F.coalesce(where, F.lit(False))
    return df.withColumns({
        "human_verified": F.when(hit, F.lit(on)).otherwise(F.col("human_verified")),
        "verified_at": F.when(hit, at if on else F.lit(None)).otherwise(F.col("verified_at")),
        "verified_by": F.when(hit, F.lit(by) if on else F.lit(None)).otherwise(F.col("verified_by"))})


def edit(df: DataFrame, where: Column, values: dict[str, Column], by: str, at: Column) -> DataFrame:
    """Changes columns of the rows that meet ``where`` and stamps the edit; no values, no change."""
    if not values:
        return df
    hit = F.coalesce(where, F.lit(False))
    stamped = {**values, "edited_at": at, "edited_by": F.lit(by)}
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in stamped.items()})


def reorder(domains: DataFrame, places: DataFrame) -> DataFrame:
    """Domains named in ``places`` (document_id, id, place from 0) take their place as display order, if
    they belong to that document; others keep theirs. An id stands in ``places`` once."""
    p = places.select(F.col("document_id").alias("_d"), F.col("id").alias("_i"), F.col("place").cast("int").alias("_place"))
    j = domains.join(p, (F.col("id") == F.col("_i")) & (F.col("document_id") == F.col("_d")), "left")
    return j.withColumn("display_order", F.coalesce("_place", "display_order")).select(*domains.columns)


def insert(df: DataFrame, rows: DataFrame) -> DataFrame:
    return df.unionByName(rows, allowMissingColumns=True)
