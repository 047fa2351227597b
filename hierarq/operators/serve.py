"""Serving operators over the versioned hierarchy tables: filters, joins, nesting, search."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hierarq.common import current_version, staged
from hierarq.operators.ordered import numbered

#: Stands for a display order that is not set (after all others).
NO_ORDER = 2147483647


def live(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Current versions that are not deleted, with ``columns`` and the id, by default all."""
    kept = None if columns is None else [*dict.fromkeys([*columns, "deleted"])]
    rows = current_version(df, columns=kept).where("NOT coalesce(deleted, false)")
    return rows if columns is None or "deleted" in columns else rows.drop("deleted")


def first_delivery(df: DataFrame, key: str, at: str, columns: list[str] | None = None) -> DataFrame:
    """One row per key of a table whose copies differ in the arrival time only.

    With ``columns`` the key and these come out, and only these (and the arrival time) are read
    and shuffled. Copies that arrive at one time and differ are decided by the rest of the row
    among ``columns``."""
    rest = [c for c in (df.columns if columns is None else columns) if c not in (key, at)]
    best = df.groupBy(key).agg(F.min(F.struct(at, *rest)).alias("_v"))
    out = df.columns if columns is None else [key, *[c for c in columns if c != key]]
    return best.select(*[F.col(key) if c == key else F.col(f"_v.{c}").alias(c) for c in out])


def where_all(df: DataFrame, **wanted: object) -> DataFrame:
    """Equality filters on the columns whose wanted value is given."""
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    return df


def contains_text(query: str, *columns: str) -> Column:
    """Case-insensitive substring search in any of the columns; a blank query matches all.
    Signs of LIKE patterns have no meaning in it."""
    q = query.strip().lower()
    if not q:
        return F.lit(True)
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.lower(F.col(c)).contains(q), F.lit(False))
    return hit


def verified_is(status: str) -> Column:
    """all, verified or unverified."""
    v = F.coalesce(F.col("human_verified"), F.lit(False))
    return {"all": F.lit(True), "verified": v, "unverified": ~v}[status]


def hierarchy_rows(documents: DataFrame, domains: DataFrame, strands: DataFrame, subs: DataFrame) -> DataFrame:
    """Live sub-strands attached to the chain of their live ancestors, flat."""
    d = live(domains, ["document_id", "code", "name", "display_order"]).select(F.col("id").alias("domain_id"), "document_id", F.col("code").alias("domain_code"),
                             F.col("name").alias("domain_name"), "display_order")
    s = live(strands, ["domain_id", "code", "name"]).select(F.col("id").alias("strand_id"), "domain_id", F.col("code").alias("strand_code"),
                             F.col("name").alias("strand_name"))
    u = live(subs, ["strand_id", "code", "name"]).select(F.col("id").alias("sub_strand_id"), "strand_id", F.col("code").alias("sub_strand_code"),
                          F.col("name").alias("sub_strand_name"))
    return documents.join(d, "document_id").join(s, "domain_id").join(u, "strand_id")


def nested_hierarchy(documents: DataFrame, domains: DataFrame, strands: DataFrame, subs: DataFrame) -> DataFrame:
    """One row per document: domains (by display order, then code) with their strands with
    their sub-strands (by code), live nodes only, each once. Arrays are built bottom-up, so
    every group that is collected is the children of one node."""
    u = live(subs, ["strand_id", "code", "name"]).groupBy("strand_id").agg(F.array_sort(F.collect_list(F.struct("code", "id", "name"))).alias("sub_strands"))
    s = live(strands, ["domain_id", "code", "name"]).join(u, F.col("id") == u.strand_id, "left").groupBy("domain_id").agg(F.array_sort(F.collect_list(F.struct(
        "code", "id", "name", F.coalesce("sub_strands", F.array().cast("array<struct<code:string,id:bigint,name:string>>"))
        .alias("sub_strands")))).alias("strands"))
    none = "array<struct<code:string,id:bigint,name:string,sub_strands:array<struct<code:string,id:bigint,name:string>>>>"
    d = live(domains, ["document_id", "code", "name", "display_order"]).withColumnRenamed("id", "domain").join(s, F.col("domain") == s.domain_id, "left").groupBy("document_id").agg(
        F.array_sort(F.collect_list(F.struct(
            F.coalesce("display_order", F.lit(NO_ORDER)).alias("rank"), "code", F.col("domain").alias("id"), "name",
            F.coalesce("strands", F.array().cast(none)).alias("strands")))).alias("domains"))
    return documents.join(d, "document_id", "left")


def visible(domains: DataFrame, strands: DataFrame, subs: DataFrame, query: str, status: str = "all") -> DataFrame:
    """(level, id, itself) of the nodes that show for a search: those that match themselves,
    or have a descendant that does. Matches go up the foreign keys by semi-joins."""
    # What is asked of a version is decided before the versions are compared: texts are not shuffled.
    hit = contains_text(query, "code", "name", "description") & verified_is(status)
    u = live(subs.withColumns({"itself": hit, "parent": F.col("strand_id")}), ["parent", "itself"])
    s = live(strands.withColumns({"itself": hit, "parent": F.col("domain_id")}), ["parent", "itself"])
    d = live(domains.withColumn("itself", hit), ["itself"])
    shown_u = u.where("itself")
    shown_s = s.join(shown_u.select(F.col("parent").alias("id")).distinct().withColumn("below", F.lit(True)), "id", "left").where(
        "itself OR below")
    shown_d = d.join(shown_s.select(F.col("parent").alias("id")).distinct().withColumn("below", F.lit(True)), "id", "left").where(
        "itself OR below")
    out = [x.select(F.lit(n).alias("level"), "id", "itself") for n, x in (
        ("domain", shown_d), ("strand", shown_s), ("sub_strand", shown_u))]
    return out[0].unionByName(out[1]).unionByName(out[2])


def sorted_nodes(nodes: DataFrame, group: str, field: str, descending: bool = False, tie: str = "id") -> DataFrame:
    """(id, group, place): nodes of a group in the order a user chose: texts without letter case, truth values false first
    (null is false), null texts last from the end and first from the start; ties by ``tie``, rising."""
    truth = nodes.schema[field].dataType.simpleString() == "boolean"
    value = F.coalesce(F.col(field), F.lit(False)) if truth else F.lower(F.col(field))
    rows = nodes.select(*dict.fromkeys(["id", group, tie]), value.alias("_by"))
    return numbered(rows, [group], [(F.col("_by"), "desc") if descending else F.col("_by"), F.col(tie)]).select("id", group, "place")


def parent_chain(subs: DataFrame, strands: DataFrame, domains: DataFrame, documents: DataFrame) -> DataFrame:
    """Each live sub-strand with its strand, domain and document; what is deleted or missing is null."""
    s = live(strands, ["code", "domain_id"]).select(F.col("id").alias("strand_id"), F.col("code").alias("strand_code"), "domain_id")
    d = live(domains, ["code", "document_id"]).select(F.col("id").alias("domain_id"), F.col("code").alias("domain_code"), "document_id")
    o = documents.select("document_id", F.col("title").alias("document_title"))
    live_s = s.withColumnRenamed("domain_id", "_d").join(d.withColumnRenamed("domain_id", "_d"), "_d", "left").join(
        o, "document_id", "left")
    return live(subs, ["code", "strand_id"]).select(F.col("id").alias("sub_strand_id"), "code", "strand_id").join(live_s, "strand_id", "left").select(
        "sub_strand_id", "code", F.when(F.col("strand_code").isNotNull(), F.col("strand_id")).alias("strand_id"), "strand_code",
        F.when(F.col("domain_code").isNotNull(), F.col("_d")).alias("domain_id"), "domain_code", "document_title")


def top_k_cosine(vectors: DataFrame, query: list[float], k: int, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The ``k`` rows most similar to ``query`` by cosine, exactly: a partial top-k per task,
    then one merge. Vectors of another width, without length or null are left out."""
    q = F.array(*[F.lit(float(x)) for x in query])
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    dot = F.aggregate(F.zip_with(v, q, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    size = sum(float(x) ** 2 for x in query) ** 0.5
    scored = vectors.where(F.size(column) == len(query)).withColumn("_norm", norm).where("_norm > 0").withColumn(
        "similarity", dot / (F.col("_norm") * F.lit(size))).drop("_norm")
    return scored.orderBy(F.desc("similarity"), key).limit(k)


#: Query vectors that are sent to the tasks at once, on average.
QUERY_BLOCK = 1_000
#: Rows that are held against a block at once.
ROWS_AT_ONCE = 2_000


def _best(q: np.ndarray, sim: np.ndarray, key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` first per query by similarity, then key."""
    order = np.lexsort((key, -sim, q))
    q, sim, key = q[order], sim[order], key[order]
    at = np.arange(len(q))
    starts = np.maximum.accumulate(np.where(np.r_[True, q[1:] != q[:-1]], at, 0)) if len(q) else at
    kept = at - starts < k
    return q[kept], sim[kept], key[kept]


def _widths(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for each width; vectors without length, with nulls or not finite are left out."""
    lengths = np.nan_to_num(pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype("float64"), nan=-1)
    for w in np.unique(lengths[lengths > 0]).astype(int):
        rows = np.flatnonzero(lengths == w)
        m = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, w)
        norm = np.sqrt((m * m).sum(axis=1))
        sound = np.isfinite(norm) & (norm > 0)
        yield rows[sound], m[sound] / norm[sound, None]


def top_k_cosine_of_many(vectors: DataFrame, queries: DataFrame, k: int, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(query_id, ``key``, similarity) of the ``k`` rows of ``vectors`` most similar to each row of
    ``queries``, exactly: blocks of queries are broadcast one after the other, each task keeps a
    partial top-k per query, and one merge follows. ``key`` (a long) is unique in both. Similarities
    equal to twelve places go by ``key``; only vectors of one width compare."""
    spark = vectors.sparkSession
    q = staged(queries.where(F.col(key).isNotNull() & (F.size(column) > 0)).select(key, column), "queries")
    blocks = max(1, -(-q.count() // QUERY_BLOCK))
    rows = vectors.where(F.col(key).isNotNull() & (F.size(column) > 0)).select(key, column)
    parts = []
    for i in range(blocks):
        block = q.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == i).toArrow().combine_chunks()
        if not block.num_rows:
            continue
        ids, vecs = block.column(0).to_numpy(), block.column(1).chunk(0)
        sent = spark.sparkContext.broadcast({m.shape[1]: (ids[r], m) for r, m in _widths(vecs)})
        part = rows.mapInArrow(_partial(sent, k, key), f"query_id long, {key} long, similarity double")
        parts.append(staged(part, f"partial-{i}"))
        sent.unpersist()
    if not parts:
        return spark.createDataFrame([], f"query_id long, {key} long, similarity double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), key))
    merged = [p.withColumn("_place", place).where(F.col("_place") <= k).drop("_place") for p in parts]
    return reduce(DataFrame.unionByName, merged)


def _partial(sent: Broadcast, k: int, key: str):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (np.empty(0, "int64"), np.empty(0), np.empty(0, "int64"))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                keys = batch.column(0).to_numpy()
                for r, m in _widths(batch.column(1)):
                    ids, asked = sent.value.get(m.shape[1], (None, None))
                    if ids is None or not len(r):
                        continue
                    sims = np.round(asked @ m.T, 12)
                    least = np.partition(sims, -k, axis=1)[:, -k] if len(r) > k else np.full(len(ids), -np.inf)
                    x, y = np.nonzero(sims >= least[:, None])
                    best = _best(*(np.concatenate(p) for p in zip(best, (ids[x], sims[x, y], keys[r[y]]), strict=True)), k)
        yield pa.RecordBatch.from_arrays([pa.array(best[0]), pa.array(best[2]), pa.array(best[1])],
                                         schema=pa.schema([("query_id", pa.int64()), (key, pa.int64()), ("similarity", pa.float64())]))

    return run
