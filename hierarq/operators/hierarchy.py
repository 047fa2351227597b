"""Parent-child rows as full hierarchies (problem 6).

Fragment contraction: rows are range-partitioned by key; each task follows its parent
chains as far as they stay in its partition and writes, per node, the path within the
fragment and the exit (the first ancestor elsewhere). The exits form a smaller forest, which
is solved in the same way until nothing is open; then the paths of the exits are put before
the fragment paths. A chain that comes back to itself, in a fragment or in a smaller forest,
is a circle: all nodes on it are named. When a forest does not shrink by contraction (long
chains in scattered key order), its pointers are doubled by joins instead.

Defined results: codes compare without blanks and letter case; a node given by several rows is
one node, with the smallest of their parents if they differ; a blank, null or unknown
parent makes a root; a node whose parent is itself is a circle of one; nodes on and below
circles have no root, depth or path; nodes below a circle have descendants as in a forest
whose roots hang on the circle, nodes on it have none counted (0), since everything on and below
their circle is below them; rows without a code are left out; empty tables give empty tables;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hierarq.common import code_key, salted_join, staged

#: Rows of a forest that one task may hold, and partitions of a forest at least.
FRAGMENT_ROWS, FRAGMENTS = 100_000, 4
_SEP = "\x01"
_FRAGMENT = "k string, p string, seg array<string>, status string"


def contract(rows: list[tuple[str, str | None, list[str], str]]) -> list[tuple[str, str | None, list[str], str]]:
    """Chains of one partition. A row is (key, parent, segment, status): ``segment`` leads from
    below the parent to the node, ``status`` is open, or says how the chain ends: tree (at a root),
    cycle (the node is on a circle) or below (its chain runs into one)."""
    here = {k: (p, seg, st) for k, p, seg, st in rows}
    done: dict[str, tuple[str | None, list[str], str]] = {}
    for start in here:
        walk: list[str] = []
        at: dict[str, int] = {}
        k = start
        while k in here and k not in done and k not in at:
            p, seg, st = here[k]
            if st != "open" or p is None:
                done[k] = (None, seg, "tree" if st == "open" else st)
                break
            at[k] = len(walk)
            walk.append(k)
            k = p
        if k in at:  # a circle within the partition
            for x in walk[at[k] :]:
                done[x] = (None, here[x][1], "cycle")
            walk = walk[: at[k]]
        if walk and k not in here:
            x = walk.pop()
            done[x] = (k, here[x][1], "open")
        for x in reversed(walk):
            p, path, st = done[here[x][0]]
            done[x] = (p, [*path, *here[x][1]], st) if st in ("open", "tree") else (None, here[x][1], "below")
    return [(k, *done[k]) for k in here]


def _contracted(nodes: DataFrame, parts: int, by: Column) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for f in frames:
            rows += zip(f.k, f.p, (list(s) for s in f.seg), f.status, strict=True)
        out = contract([(k, p if isinstance(p, str) else None, s, st) for k, p, s, st in rows])
        for i in range(0, len(out), 10_000):
            yield pd.DataFrame(out[i : i + 10_000], columns=["k", "p", "seg", "status"])

    return nodes.repartitionByRange(parts, by).mapInPandas(run, _FRAGMENT)


def _members(local: DataFrame) -> DataFrame:
    tree = F.substring_index("k", _SEP, 1)
    return local.where("status = 'cycle'").select(F.explode("seg").alias("c"), tree.alias("t")).select(
        F.concat("t", F.lit(_SEP), "c").alias("k"))


def _expand(open_: DataFrame, solved: DataFrame) -> DataFrame:
    above = solved.select(F.col("k").alias("p"), F.col("seg").alias("_above"), F.col("status").alias("_st"))
    met = salted_join(open_, above, ["p"], F.col("k"), "left")
    ends = F.coalesce("_st", F.lit("tree"))
    circular = ends.isin("cycle", "below")
    return met.select("k", F.when(circular, F.col("seg")).otherwise(
        F.concat(F.coalesce("_above", F.array().cast("array<string>")), "seg")).alias("seg"),
        F.when(circular, "below").otherwise("tree").alias("status"))


def _double(nodes: DataFrame, n: int, level: int) -> tuple[DataFrame, DataFrame]:
    """Pointer doubling: exact for any forest, about log2(n) joins of its rows, each staged.

    First bare pointers are doubled until every chain that ends has ended: what still points
    somewhere points at a circle, and every node of a circle is pointed at. With the circles
    cut, the paths are doubled; they never grow beyond the result."""
    first = nodes.select("k", F.when(F.col("status") == "open", F.col("p")).alias("p"))
    ptr = first
    for i in range(n.bit_length() + 1):
        up = ptr.select(F.col("k").alias("p"), F.col("p").alias("_p"))
        ptr = staged(salted_join(ptr.where("p IS NOT NULL"), up, ["p"], F.col("k")).where("_p IS NOT NULL").select(
            "k", F.col("_p").alias("p")).unionByName(ptr.where("p IS NULL")), f"pointers-{level}-{i}")
        if not ptr.where("p IS NOT NULL").take(1):
            break
        gone = first.join(ptr, "k", "left_anti").select("k", F.lit(None).cast("string").alias("p"))
        ptr = ptr.unionByName(gone)
    circle = staged(ptr.where("p IS NOT NULL").select(F.col("p").alias("k")).distinct(), f"circle-{level}")
    cut = nodes.join(circle.withColumn("_on", F.lit(True)), "k", "left").select(
        "k", F.when(F.col("_on").isNull() & (F.col("status") == "open"), F.col("p")).alias("p"), "seg",
        F.when(F.col("_on"), "cycle").otherwise(F.col("status")).alias("status"))
    now = staged(cut, f"double-{level}")
    members = _members(now)
    i = 0
    while now.where("status = 'open'").take(1):
        up = now.select(F.col("k").alias("p"), F.col("p").alias("_p"), F.col("seg").alias("_seg"), F.col("status").alias("_s"))
        met = salted_join(now.where("status = 'open'"), up, ["p"], F.col("k"), "left")
        circular = F.coalesce(F.col("_s").isin("cycle", "below"), F.lit(False))
        moved = met.select("k", F.when(F.col("_s") == "open", F.col("_p")).alias("p"), F.when(circular, F.col("seg")).otherwise(
            F.concat(F.coalesce("_seg", F.array().cast("array<string>")), "seg")).alias("seg"),
            F.when(circular, "below").when(F.col("_s") == "open", "open").otherwise("tree").alias("status"))
        now = staged(now.where("status <> 'open'").unionByName(moved), f"double-{level}-{i}")
        i += 1
    return now.select("k", "seg", "status"), members


def _solve(nodes: DataFrame, n: int, level: int, fragment_rows: int, fragments: int) -> tuple[DataFrame, DataFrame]:
    parts = max(fragments if n > fragments else 1, -(-n // fragment_rows))
    local = staged(_contracted(nodes, parts, F.col("k") if level % 2 == 0 else F.reverse("k")), f"fragments-{level}")
    members = _members(local)
    open_ = local.where("status = 'open'")
    exits = open_.select(F.col("p").alias("k")).distinct()
    quotient = staged(local.join(exits, "k", "left_semi"), f"exits-{level}")
    size = quotient.count()
    ended = local.where("status <> 'open'").select("k", "seg", "status")
    if not open_.take(1):
        return ended, members
    if not size:  # the exits are unknown parents
        return ended.unionByName(_expand(open_, quotient.select("k", "seg", "status"))), members
    if parts > 1 and size > 0.8 * n and n > fragment_rows:
        solved, more = _double(quotient, size, level + 1)
    elif size <= fragment_rows:
        solved, more = _solve(quotient, size, level + 1, fragment_rows, 1)
    else:
        solved, more = _solve(quotient, size, level + 1, fragment_rows, fragments)
    solved = staged(solved, f"solved-{level}")
    return ended.unionByName(_expand(open_, solved)), members.unionByName(more)


def edges(rows: DataFrame, tree: str = "set_id", code: str = "code", parent: str = "parent_code") -> DataFrame:
    """(k, p, seg, status) of the distinct nodes."""
    t = rows.select(F.coalesce(F.col(tree).cast("string"), F.lit("")).alias("t"), code_key(F.col(code)).alias("c"),
                    code_key(F.col(parent)).alias("pc")).where("c IS NOT NULL")
    one = t.groupBy("t", "c").agg(F.min("pc").alias("pc"))
    key = lambda c: F.concat("t", F.lit(_SEP), c)
    return one.select(key("c").alias("k"), F.when(F.col("pc").isNotNull(), key("pc")).alias("p"), F.array("c").alias("seg"),
                      F.lit("open").alias("status"))


def _below(nodes: DataFrame, full: DataFrame, fragment_rows: int, fragments: int) -> DataFrame:
    """(k, seg) of the nodes below circles: the path from the node that hangs on the circle. Links
    into the circle lead to no node here, so each subtree is solved as a tree of its own."""
    keys = full.where("NOT _on AND status <> 'tree'").select("k")
    rows = staged(nodes.join(keys, "k", "left_semi"), "below")
    n = rows.count()
    return _solve(rows, n, 0, fragment_rows, fragments)[0].select("k", "seg") if n else rows.select("k", "seg")


def hierarchies(rows: DataFrame, tree: str = "set_id", code: str = "code", parent: str = "parent_code",
                fragment_rows: int = FRAGMENT_ROWS, fragments: int = FRAGMENTS, below: bool = True) -> DataFrame:
    """(tree, code, root, depth, path array, on_circle, below_circle, below_path array) of every
    node; roots have depth 0. ``below_path`` leads from a circle to a node below it and is there
    only with ``below``."""
    nodes = staged(edges(rows, tree, code, parent), "forest")
    solved, members = _solve(nodes, nodes.count(), 0, fragment_rows, fragments)
    circle = members.distinct().withColumn("_on", F.lit(True))
    full = solved.join(circle, "k", "left").withColumn("_on", F.coalesce("_on", F.lit(False)))
    if below:
        full = staged(full, "solved")
        hung = _below(nodes, full, fragment_rows, fragments).select("k", F.col("seg").alias("_below"))
        full = full.join(hung, "k", "left")
    else:
        full = full.withColumn("_below", F.lit(None).cast("array<string>"))
    on = F.col("_on")
    lost = on | (F.col("status") != "tree")
    return full.select(F.substring_index("k", _SEP, 1).alias(tree), F.substring_index("k", _SEP, -1).alias(code),
                       F.when(~lost, F.col("seg")[0]).alias("root"), F.when(~lost, F.size("seg") - 1).alias("depth"),
                       F.when(~lost, F.col("seg")).alias("path"), on.alias("on_circle"), (lost & ~on).alias("below_circle"),
                       F.col("_below").alias("below_path"))


def circles(full: DataFrame, tree: str = "set_id", code: str = "code") -> DataFrame:
    return full.where("on_circle").select(tree, code)


def descendants(full: DataFrame, tree: str = "set_id", code: str = "code") -> DataFrame:
    """(tree, code, descendant, distance) of every pair of a node that is on no circle and one below it."""
    line = F.coalesce("path", "below_path")
    steps = full.where(line.isNotNull()).select(tree, F.col(code).alias("descendant"), (F.size(line) - 1).alias("depth"),
                                                F.posexplode(line).alias("at", code))
    return steps.where("at < depth").select(tree, code, "descendant", (F.col("depth") - F.col("at")).alias("distance"))


def paths(full: DataFrame, tree: str = "set_id", code: str = "code") -> DataFrame:
    """One row per node: path as text, depth, root, number of descendants, and its part in circles."""
    below = descendants(full, tree, code).groupBy(tree, code).agg(F.count("*").alias("descendants"))
    return full.join(below, [tree, code], "left").select(
        tree, code, F.array_join("path", " > ").alias("path"), "depth", "root",
        F.coalesce("descendants", F.lit(0)).alias("descendants"), "on_circle", "below_circle")
