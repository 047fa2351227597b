"""Positions, running sums and forward fills in groups of any size.

A window over a group is one task's work; here a group is first cut into ranges of its
order, each of the size of a partition, and what the ranges before add is found from one
row per range. An entry of an order is a column, or a column and "desc". Rows that are equal in
keys and order stay together, ties are decided by the order given, which should end in a
unique column. Null keys form a group; empty tables
give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hierarq.common import staged


Order = list[Column | tuple[Column, str]]


def _by(order: Order) -> list[Column]:
    return [F.col(f"_o{i}").desc() if isinstance(o, tuple) and o[1] == "desc" else F.col(f"_o{i}").asc() for i, o in enumerate(order)]


def _ranges(df: DataFrame, keys: list[str], order: Order) -> DataFrame:
    named = df.withColumns({f"_o{i}": o[0] if isinstance(o, tuple) else o for i, o in enumerate(order)})
    by = [*map(F.col, keys), *_by(order)]
    return staged(named.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()), "ranges")


def _joined(rows: DataFrame, per: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with what is known per range; one row per key and range, so nothing is hot."""
    p = per.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"),
                   *[c for c in per.columns if c not in (*keys, "_range")])
    on = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(p, on).drop("_r", *[f"_k{i}" for i in range(len(keys))])


def _clean(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_o") and c[2:].isdigit()], "_range")


def _windows(keys: list[str], order: Order):  # noqa: ANN202
    inside = Window.partitionBy(*keys, "_range").orderBy(*_by(order))
    over = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return inside, over


def numbered(df: DataFrame, keys: list[str], order: Order, name: str = "place") -> DataFrame:
    """``df`` with the position of each row in its group, from 1."""
    rows = _ranges(df, keys, order)
    inside, over = _windows(keys, order)
    per = rows.groupBy(*keys, "_range").agg(F.count("*").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(over), F.lit(0))).drop("_n")
    local = rows.withColumn("_at", F.row_number().over(inside))
    return _clean(_joined(local, per, keys).withColumn(name, F.col("_at") + F.col("_base")).drop("_at", "_base"))


def joined_parts(df: DataFrame, keys: list[str], order: Order, value: Column, separator: str, name: str, size: int = 100) -> DataFrame:
    """(keys..., part, ``name``): the values of a group in order, ``size`` of them joined to one text
    per part (from 0). What is collected is one part, whatever the size of the group."""
    rows = numbered(df.withColumn("_value", value), keys, order, "_place").withColumn("part", F.floor((F.col("_place") - 1) / size))
    g = rows.groupBy(*keys, "part").agg(F.array_sort(F.collect_list(F.struct("_place", "_value"))).alias("_x"))
    return g.select(*keys, "part", F.array_join(F.transform("_x", lambda r: r["_value"]), separator).alias(name))


def sum_before(df: DataFrame, keys: list[str], order: Order, value: str, name: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before each row in its group."""
    rows = _ranges(df, keys, order)
    inside, over = _windows(keys, order)
    per = rows.groupBy(*keys, "_range").agg(F.sum(value).alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(over), F.lit(0))).drop("_n")
    local = rows.withColumn("_in", F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return _clean(_joined(local, per, keys).withColumn(name, F.col("_in") + F.col("_base")).drop("_in", "_base"))


def placed_in_ranges(df: DataFrame, keys: list[str], order: Order, value: str) -> DataFrame:
    """``df`` with ``_range``, the range of the order a row is in, ``n``, its place in its group from 0, and
    ``before``, the sum of ``value`` before it."""
    rows = _ranges(df, keys, order)
    inside, over = _windows(keys, order)
    per = rows.groupBy(*keys, "_range").agg(F.count("*").alias("_c"), F.coalesce(F.sum(value), F.lit(0)).alias("_s")).withColumns(
        {"_n0": F.coalesce(F.sum("_c").over(over), F.lit(0)), "_s0": F.coalesce(F.sum("_s").over(over), F.lit(0))}).drop("_c", "_s")
    up = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumns({"n": F.row_number().over(inside) - 1, "before": F.coalesce(F.sum(value).over(up), F.lit(0))})
    whole = _joined(local, per, keys).withColumns({"n": F.col("n") + F.col("_n0"), "before": F.col("before") + F.col("_s0")}).drop("_n0", "_s0")
    return whole.drop(*[f"_o{i}" for i in range(len(order))])


def filled_forward(df: DataFrame, keys: list[str], order: Order, value: str, name: str) -> DataFrame:
    """``df``, in rising order, with the last ``value`` up to each row that is not null, at first the first one."""
    rows = _ranges(df, keys, order)
    inside, over = _windows(keys, order)
    at = F.struct(*[f"_o{i}" for i in range(len(order))])
    given = F.when(F.col(value).isNotNull(), at)
    per = rows.groupBy(*keys, "_range").agg(F.max_by(value, given).alias("_last"), F.min_by(value, given).alias("_head"))
    whole = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumns({"_carry": F.last("_last", ignorenulls=True).over(over), "_first": F.first("_head", ignorenulls=True).over(whole)})
    local = rows.withColumn("_own", F.last(value, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    filled = F.coalesce("_own", "_carry", "_first")
    return _clean(_joined(local, per.drop("_last", "_head"), keys).withColumn(name, filled).drop("_own", "_carry", "_first"))


def following(df: DataFrame, keys: list[str], order: Order, columns: list[str]) -> DataFrame:
    """``df``, in rising order, with ``next``, the struct of ``columns`` of the row after in its group, null at its end."""
    rows = _ranges(df, keys, order)
    inside, _ = _windows(keys, order)
    at = F.struct(*[f"_o{i}" for i in range(len(order))])
    after = Window.partitionBy(*keys).orderBy("_range")
    per = rows.groupBy(*keys, "_range").agg(F.min_by(F.struct(*columns), at).alias("_first")).withColumn("_ahead", F.lead("_first").over(after)).drop("_first")
    local = rows.withColumn("_next", F.lead(F.struct(*columns)).over(inside))
    return _clean(_joined(local, per, keys).withColumn("next", F.coalesce("_next", "_ahead")).drop("_next", "_ahead"))


def previous(df: DataFrame, keys: list[str], order: Order, value: str, name: str) -> DataFrame:
    """``df`` with ``value`` of the row before in its group, by an equi-join on positions."""
    rows = staged(numbered(df, keys, order, "_place"), "places")
    before = rows.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], (F.col("_place") + 1).alias("_p"), F.col(value).alias(name))
    on = F.col("_place") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(before, on, "left").drop("_p", "_place", *[f"_k{i}" for i in range(len(keys))])
