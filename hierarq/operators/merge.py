"""Merging partial results: stable deduplication, status, canonical codes, routing to domains.

Every choice of a first row goes by an explicit order, so results do not depend on
partitioning. Choices by key combine map-side (min_by), so no key's rows are collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hierarq.functions.text import has_camel_case, squeezed, without_age_prefix
from hierarq.operators.ordered import filled_forward, numbered


def first_wins(df: DataFrame, key: list[str], order: list[str], keep: str = "first") -> DataFrame:
    """One row per key (nulls compare equal): the first in ``order``, or with
    ``keep="max_confidence"`` the most confident, then the first."""
    rank = [F.col(c) for c in order]
    if keep == "max_confidence":
        rank = [-F.coalesce(F.col("confidence"), F.lit(-1.0)), *rank]
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*rank)).alias("_r"))
    return best.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def concatenated(outputs: list[DataFrame], scope: list[str], batch: str, key: str) -> DataFrame:
    """Outputs of one form put together, nothing dropped, with their ``place`` in a scope: by batch, then by
    output, then by key."""
    parts = [o.withColumn("_output", F.lit(i)) for i, o in enumerate(outputs)]
    return numbered(reduce(DataFrame.unionByName, parts), scope, [F.col(batch), F.col("_output"), F.col(key)]).drop("_output")


def status_of(errors: Column, rows: Column) -> Column:
    """error, partial or success from the counts of errors and of rows."""
    return F.when((errors > 0) & (rows > 0), "partial").when(errors > 0, "error").otherwise("success")


def canonical_codes_by(df: DataFrame, scope: list[str], name_key: Column, code: Column) -> DataFrame:
    """(scope..., name_key, canonical): among the codes a name goes by, the one that is no slug,
    most frequent, shortest, first; a slug is longer than ten characters or has camel case."""
    rows = df.select(*scope, name_key.alias("name_key"), code.alias("_code")).where("name_key IS NOT NULL AND _code IS NOT NULL")
    counts = rows.groupBy(*scope, "name_key", "_code").agg(F.count("*").alias("n"))
    slug = (F.length("_code") > 10) | has_camel_case(F.col("_code"))
    return counts.groupBy(*scope, "name_key").agg(
        F.min_by("_code", F.struct(slug, -F.col("n"), F.length("_code"), F.col("_code"))).alias("canonical"))


def canonical_codes(df: DataFrame, scope: list[str], name: str = "title", code: str = "code") -> DataFrame:
    """``canonical_codes_by`` the squeezed name."""
    return canonical_codes_by(df, scope, squeezed(F.col(name)), F.col(code))


def with_canonical_codes(df: DataFrame, scope: list[str], name: str = "title", code: str = "code") -> DataFrame:
    names = canonical_codes(df, scope, name, code)
    keyed = df.withColumn("name_key", squeezed(F.col(name)))
    return keyed.join(names, [*scope, "name_key"], "left").withColumn(
        "canonical_code", F.coalesce("canonical", F.col(code))).drop("canonical", "name_key")


def longest_description(domains: DataFrame, key: list[str], order: str) -> DataFrame:
    """Repeated domains: the longest description wins, the first of equal length."""
    rest = [c for c in domains.columns if c not in key]
    best = domains.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(
        -F.length(F.coalesce("description", F.lit(""))), F.col(order))).alias("_r"))
    return best.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def route_by_prefix(elements: DataFrame, domains: DataFrame, scope: list[str], code: str = "code") -> DataFrame:
    """The longest domain code that is the element's code or a prefix of it up to ``.``, ``-`` or
    ``_``: instead of a prefix join, each element looks up the few prefixes its code has by an
    equi-join. Elements without one keep a null ``routed``."""
    bare = without_age_prefix(F.col(code))
    cuts = F.filter(F.sequence(F.lit(1), F.length(bare)), lambda i: (i == F.length(bare)) | F.substring(bare, i + 1, F.lit(1)).isin(
        ".", "-", "_"))
    known = domains.select(*scope, F.col(code).alias("_p")).distinct()
    probes = elements.where(F.length(F.coalesce(bare, F.lit(""))) > 0).select("element_id", *scope, F.explode(
        F.transform(cuts, lambda i: F.substring(bare, F.lit(1), i))).alias("_p"))
    hit = probes.join(known, [*scope, "_p"]).groupBy("element_id").agg(F.max_by("_p", F.length("_p")).alias("routed"))
    return elements.join(hit, "element_id", "left")


def filled_domain(elements: DataFrame, scope: list[str], order: list[str]) -> DataFrame:
    """The code of the most recent domain element in document order (at first, the first one)."""
    own = elements.withColumn("_own_code", F.when(F.col("level") == "domain", F.col("code")))
    return filled_forward(own, scope, [F.col(c) for c in order], "_own_code", "current_domain").drop("_own_code")
