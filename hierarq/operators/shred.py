"""Deeply nested records as related flat tables (problem 5): adjacency-table shredding.

Every JSON value of a record is one row of a node table: record, node, parent, label,
ordinal (in an array), kind and scalar. Entity tables come from it by joining object nodes
with their scalar children and pivoting the labels. The node table is staged, so records
are parsed once.

Defined results: payloads that do not parse or hold no object or array give no nodes, as do
null payloads and null record ids; copies of a record count once (the earliest
``received_at``); of a repeated field the last value counts; a JSON object written as a
string counts as that object; a lone object in a field that elsewhere holds an array of
objects counts as its element 0; null elements keep their index; the control characters
U+001E and U+001F in field names are blanks in paths; records nested
deeper than the parser's stack do not parse; empty tables give empty tables. An entity is a
path of labels in which a label that comes again leads back to its first place, so replies to
replies are one entity; ``$`` is the root (object or array) and has no parent.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hierarq.common import salted_join, staged

NODES_SCHEMA = ("record_id long, node_id int, parent_id int, label string, ordinal int, kind string, scalar string, "
                "field string, chain string")
#: In a chain, steps end with STEP; a step is its mark (``e`` an object in an array, ``l`` a lone
#: object, ``a`` an array in an array), its ordinal, MARK, and its label.
STEP, MARK = "\x1e", "\x1f"
_NO_CONTROL = str.maketrans(STEP + MARK, "  ")
#: Field names that may be told to every task at once; beyond, they are joined.
MAX_FIELDS = 10_000
#: Labels an entity may have as columns; beyond, its scalars stand in one map.
MAX_COLUMNS = 1_000
#: Records whose nodes are handed on together.
PARSED_AT_ONCE = 1_000


def _parse(text: str) -> object:
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return None


def _embedded(value: object) -> object:
    """A JSON object written as a string, as that object."""
    if isinstance(value, str):
        t = value.strip()
        if t[:1] == "{" and t[-1:] == "}":
            inner = _parse(t)
            if isinstance(inner, dict):
                return inner
    return value


def shred(payload: str) -> list[tuple]:
    """Node rows of one payload, parents before children."""
    root = _embedded(_parse(payload))
    if isinstance(root, str):
        root = _embedded(root)
    if not isinstance(root, (dict, list)):
        return []
    out: list[tuple] = []
    stack: list[tuple] = [(root, None, None, None, "$", "")]
    while stack:
        value, parent, label, ordinal, field, above = stack.pop()
        node = len(out)
        kind = "object" if isinstance(value, dict) else "array" if isinstance(value, list) else "scalar"
        chain = above
        if parent is not None and (kind == "object" or ordinal is not None):
            mark = ("l" if ordinal is None else "e") if kind == "object" else "a"
            name = "" if label is None else MARK + label.translate(_NO_CONTROL)
            chain = f"{above}{mark}{'' if ordinal is None else ordinal}{name}{STEP}"
        scalar = None
        if kind == "scalar" and value is not None:
            scalar = value if isinstance(value, str) else json.dumps(value)
        out.append((node, parent, label, ordinal, kind, scalar, field, chain if kind == "object" else None))
        if kind == "object":
            stack += [(_embedded(v), node, k, None, f"{field}.{k}", chain) for k, v in reversed(value.items())]
        elif kind == "array":
            # The elements carry the label of their array, inner arrays of arrays have none.
            inner = label if ordinal is None else None
            stack += [(_embedded(v), node, inner, i, field, chain) for i, v in reversed(list(enumerate(value)))]
    return out


def nodes(records: DataFrame) -> DataFrame:
    """The staged node table of ``records`` (record_id, payload, received_at). ``chain`` holds
    the steps from the root to an object, ``field`` its path without indexes."""
    one = records.where("record_id IS NOT NULL AND payload IS NOT NULL").groupBy("record_id").agg(
        F.min(F.struct("received_at", "payload")).alias("r")).select("record_id", F.col("r.payload").alias("payload"))

    names = [x.split()[0] for x in NODES_SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    types = [kinds[x.split()[1]] for x in NODES_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, payloads = (c.to_pylist() for c in batch.columns)
            for at in range(0, len(ids), PARSED_AT_ONCE):
                rows = [(r, *n) for r, p in zip(ids[at : at + PARSED_AT_ONCE], payloads[at : at + PARSED_AT_ONCE], strict=True)
                        for n in shred(p)]
                cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return staged(one.mapInArrow(run, NODES_SCHEMA), "nodes")


def _lone_array_fields(n: DataFrame) -> DataFrame:
    """Names of fields that hold a lone object here and an array of objects elsewhere. Names and
    not paths: in a recursive record (replies to replies) a field has ever new paths."""
    objects = n.where("kind = 'object' AND parent_id IS NOT NULL AND label IS NOT NULL")
    arrays = objects.where("ordinal IS NOT NULL").select("label").distinct()
    return objects.where("ordinal IS NULL").select("label").distinct().join(arrays, "label", "left_semi")


def _walk(chain: Column, as_element: Column | None) -> Column:
    """struct(path, element, parent, is_element) of the object at the end of ``chain``."""

    def step(acc: Column, s: Column) -> Column:
        label = F.substring_index(s, MARK, -1)
        named = F.instr(s, MARK) > 0
        ordinal = F.substring_index(F.substring(s, 2, 12), MARK, 1)
        lone = s.startswith("l") & (F.array_contains(as_element, label) if as_element is not None else F.lit(False))
        element = s.startswith("e") | lone
        path = F.concat(acc["path"], F.when(named, F.concat(F.lit("."), label)).otherwise(""),
                        F.when(~s.startswith("l"), F.concat(F.lit("["), ordinal, F.lit("]"))).when(lone, "[0]").otherwise(""))
        return F.struct(path.alias("path"), F.when(element, path).otherwise(acc["element"]).alias("element"),
                        F.when(element, acc["element"]).otherwise(acc["parent"]).alias("parent"),
                        F.coalesce(element, F.lit(False)).alias("is_element"))

    start = F.struct(F.lit("$").alias("path"), F.lit("$").alias("element"), F.lit("$").alias("parent"), F.lit(False).alias("is_element"))
    steps = F.filter(F.split(chain, STEP), lambda x: x != "")
    return F.aggregate(steps, start, step)


def _folded(chain: Column) -> Column:
    """The entity of the object at the end of ``chain``."""
    named = F.filter(F.split(chain, STEP), lambda x: F.instr(x, MARK) > 0)
    labels = F.transform(named, lambda x: F.replace(F.substring_index(x, MARK, -1), F.lit("."), F.lit("\\.")))
    back = lambda acc, x: F.slice(acc, 1, F.array_position(acc, x).cast("int"))
    place = F.aggregate(labels, F.array().cast("array<string>"), lambda acc, x: F.when(
        F.array_contains(acc, x), back(acc, x)).otherwise(F.concat(acc, F.array(x))))
    return F.concat_ws(".", F.lit("$"), place)


def object_paths(n: DataFrame) -> DataFrame:
    """(record_id, node_id, parent_id, field, entity, node_path, parent_path, is_element) of every
    object: ``parent_path`` is that of the nearest enclosing array element, or ``$``; null for ``$``."""
    fields = staged(_lone_array_fields(n), "lone-fields")
    known = [r.label for r in fields.limit(MAX_FIELDS + 1).collect()]
    objects = n.where("kind = 'object'").select("record_id", "node_id", "parent_id", "field", "chain")
    if len(known) <= MAX_FIELDS:
        objects = objects.withColumn("hits", F.array(*map(F.lit, known)).cast("array<string>"))
    else:  # too many to send along: what each object's steps meet is joined
        lone = F.filter(F.split("chain", STEP), lambda x: x.startswith("l"))
        steps = objects.select("record_id", "node_id", F.explode(lone).alias("s")).select(
            "record_id", "node_id", F.substring_index("s", MARK, -1).alias("label"))
        met = salted_join(steps, fields, ["label"], F.struct("record_id", "node_id")).groupBy("record_id", "node_id").agg(
            F.collect_set("label").alias("hits"))
        objects = objects.join(met, ["record_id", "node_id"], "left").withColumn(
            "hits", F.coalesce("hits", F.array().cast("array<string>")))
    walked = objects.withColumn("w", _walk(F.col("chain"), F.col("hits")))
    above = F.when(F.col("w.is_element"), F.col("w.parent")).otherwise(F.col("w.element"))
    return walked.select("record_id", "node_id", "parent_id", "field", _folded(F.col("chain")).alias("entity"),
                         F.col("w.path").alias("node_path"), F.when(F.col("parent_id").isNotNull(), above).alias("parent_path"),
                         F.col("w.is_element").alias("is_element"))


def array_elements(records: DataFrame) -> DataFrame:
    """(record_id, parent_path, node_path) of every object that is an element of an array."""
    return object_paths(nodes(records)).where("is_element").select("record_id", "parent_path", "node_path").distinct()


def _keyed(n: DataFrame, paths: DataFrame) -> DataFrame:
    """(record_id, node_id, entity, node_path, parent_path) of every object, and of roots that are arrays."""
    lists = n.where("parent_id IS NULL AND kind = 'array'").select(
        "record_id", "node_id", F.lit("$").alias("entity"), F.lit("$").alias("node_path"), F.lit(None).cast("string").alias("parent_path"))
    return paths.select("record_id", "node_id", "entity", "node_path", "parent_path").unionByName(lists)


def _scalars(n: DataFrame) -> DataFrame:
    return n.where("kind = 'scalar' AND ordinal IS NULL AND label IS NOT NULL AND scalar IS NOT NULL").select(
        "record_id", F.col("parent_id").alias("node_id"), "label", "scalar")


def _as_map(scalars: DataFrame) -> DataFrame:
    return scalars.groupBy("record_id", "node_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "scalar")))).alias("scalars"))


def objects(n: DataFrame, paths: DataFrame) -> DataFrame:
    """All entities in one table: record_id, entity, node_path, parent_path and the scalar children as a map."""
    return _keyed(n, paths).join(_as_map(_scalars(n)), ["record_id", "node_id"], "left").drop("node_id")


def entity(n: DataFrame, paths: DataFrame, name: str, labels: list[str] | None = None) -> DataFrame:
    """The flat table of the objects of an entity: record_id, node_path (its key), parent_path (its
    parent's key) and one column per scalar child in ``labels``, by default per label the data
    have there. A label that is taken but for its case, or by a key, gets underscores."""
    own = _keyed(n, paths).where(F.col("entity") == name).drop("entity")
    scalars = _scalars(n)
    if labels is None:
        met = scalars.join(own.select("record_id", "node_id"), ["record_id", "node_id"], "left_semi").select("label").distinct()
        labels = sorted(r.label for r in met.limit(MAX_COLUMNS + 1).collect())
        if len(labels) > MAX_COLUMNS:
            return own.join(_as_map(scalars), ["record_id", "node_id"], "left").drop("node_id")
    taken = {"record_id", "node_id", "node_path", "parent_path"}
    cells = []
    for label in labels:
        column = label
        while column.lower() in taken:
            column += "_"
        taken.add(column.lower())
        cells.append(F.max(F.when(F.col("label") == label, F.col("scalar"))).alias(column))
    if not cells:
        return own.drop("node_id")
    wide = scalars.where(F.col("label").isin(labels)).groupBy("record_id", "node_id").agg(*cells)
    return own.join(wide, ["record_id", "node_id"], "left").drop("node_id")


def scalar_lists(n: DataFrame, paths: DataFrame) -> DataFrame:
    """(record_id, parent_path, label, ordinal, scalar) of the scalar elements of arrays;
    ``parent_path`` is the path of the object the array belongs to."""
    items = n.where("kind = 'scalar' AND ordinal IS NOT NULL AND scalar IS NOT NULL").select(
        "record_id", F.col("parent_id").alias("array_id"), "label", "ordinal", "scalar")
    arrays = n.where("kind = 'array'").select("record_id", F.col("node_id").alias("array_id"), F.col("parent_id").alias("node_id"))
    return items.join(arrays, ["record_id", "array_id"]).join(
        paths.select("record_id", "node_id", F.col("node_path").alias("parent_path")), ["record_id", "node_id"]).select(
        "record_id", "parent_path", "label", "ordinal", "scalar")
