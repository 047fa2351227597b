"""Text blocks: parsing, reading order, greedy chunks, batches, manifests, samples.

Nulls: a block without text has no tokens; missing geometry counts as 0; an empty document
has no chunks. Copies of a block count once. Ties in reading order go to the position, then
to the block id.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hierarq.common import staged
from hierarq.functions.text import tokens_of
from hierarq.operators.ordered import numbered, placed_in_ranges, sum_before

CHUNK_TOKENS, OVERLAP_TOKENS, SAMPLE_TOKENS = 2000, 500, 6000


def parsed(raw: DataFrame) -> DataFrame:
    """Blocks out of nested service answers: lines and cells with text, confidence 0-1, rows and
    columns from 0, page 1 by default. ``raw`` has blocks array<struct<BlockType, Text, Page,
    Confidence, RowIndex, ColumnIndex>>."""
    b = raw.select("document_s3_key", F.posexplode("blocks").alias("pos", "b")).where(
        F.col("b.BlockType").isin("LINE", "CELL") & (F.coalesce("b.Text", F.lit("")) != ""))
    cell = F.when(F.col("b.BlockType") == "CELL", "TABLE_CELL").otherwise(F.col("b.BlockType"))
    return b.select("document_s3_key", "pos", F.col("b.Text").alias("text"), F.coalesce("b.Page", F.lit(1)).alias("page_number"),
                    cell.alias("block_type"), (F.col("b.RowIndex") - 1).alias("row_index"),
                    (F.col("b.ColumnIndex") - 1).alias("col_index"), (F.col("b.Confidence") / 100).alias("confidence"))


def reading_order(blocks: DataFrame) -> list:
    """Sort keys: page, top, left, position, id."""
    zero = F.lit(0.0)
    return [F.col("page_number"), F.coalesce(F.col("geometry.bounding_box.top"), zero),
            F.coalesce(F.col("geometry.bounding_box.left"), zero), F.col("pos"), F.col("block_id")]


def _halos(frames: Iterator[pd.DataFrame], overlap: int) -> Iterator[pd.DataFrame]:
    """Per range of a document, in order: (sums, places) of the blocks before it that lie within
    the overlap of its start, a place per sum of tokens. Holds one document's overlap."""
    now, sums, places = None, [], []
    for f in frames:
        out = []
        for d, r, base, tail in zip(f.doc, f._range, f.base, f["tail"], strict=True):
            if d != now:
                now, sums, places = d, [], []
            cut = bisect_left(sums, base - overlap)
            sums, places = sums[cut:], places[cut:]
            out.append((d, r, base, list(sums), list(places)))
            for x in tail:
                if not sums or x["before"] > sums[-1]:
                    sums.append(x["before"])
                    places.append(x["n"])
        yield pd.DataFrame(out, columns=["doc", "_range", "base", "sums", "places"])


def _table(base: int, halo: list[int], before: np.ndarray, tok: np.ndarray, limit: int, overlap: int, opens: bool) -> list[tuple[int, int, int]]:
    """What a range does to whatever enters it: (held, start, closed) by rising ``held``, the tokens the
    open chunk holds at the range's start. From that many on, ``closed`` chunks end in the
    range and the last to begin does so at the sum ``start``. Fewer close none. A range that
    ``opens`` its document is entered with nothing, and its first block closes none."""
    ends = before + tok
    sums = np.union1d(np.array(halo, dtype="int64"), before)
    starts = sums[np.searchsorted(sums, before - overlap, side="left")]  # where the chunk that opens at a block begins
    after = np.maximum(np.arange(len(ends)) + 1, np.searchsorted(ends, limit + starts, side="right"))
    known: dict[int, tuple[int, int]] = {}

    def outcome(i: int) -> tuple[int, int]:
        walk = []
        while i < len(ends) and i not in known:
            walk.append(i)
            i = int(after[i])
        last, n = known[i] if i < len(ends) else (None, 0)
        for x in reversed(walk):
            last, n = (int(starts[x]) if last is None else last), n + 1
            known[x] = (last, n)
        return last, n

    if opens:
        i = max(1, int(np.searchsorted(ends, limit, side="right")))
        return [(0, *outcome(i))] if i < len(ends) else []
    first = np.flatnonzero(np.diff(ends, prepend=base - 1) > 0)  # blocks that can be the first to close a chunk
    first = first[: np.searchsorted(ends[first] - base, limit, side="right") + 1]
    return [(max(0, limit - int(ends[i] - base) + 1), *outcome(int(i))) for i in reversed(first)]


def _entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tables of a document's ranges composed in order: (start, chunk) with which each is entered."""
    now, start, chunk = None, 0, 0
    for f in frames:
        out = []
        for d, r, base, table in zip(f.doc, f._range, f.base, f.table, strict=True):
            if d != now:
                now, start, chunk = d, 0, 0
            out.append((d, r, start, chunk))
            at = bisect_right([x["held"] for x in table], base - start) - 1
            if at >= 0:
                start, chunk = table[at]["start"], chunk + table[at]["closed"]
        yield pd.DataFrame(out, columns=["doc", "_range", "start", "chunk"])


_CHUNK_COLUMNS = ["doc", "chunk_id", "ord", "block_id", "tok", "seed"]
_CHUNK = "doc string, chunk_id int, ord long, block_id long, tok long, seed boolean, low long, high long"


def greedy_chunks(blocks: DataFrame, doc: str = "document_s3_key", order: str = "pos", limit: int = CHUNK_TOKENS,
                  overlap: int = OVERLAP_TOKENS) -> DataFrame:
    """(doc, chunk_id, ord, block_id, tok, seed): greedy chunks with a tail of the last chunk as the
    seed of the next.

    Where a chunk closes depends on all before it, so documents are cut into ranges of their
    order and each range is first turned into a table: for what the open chunk holds at its
    start, which chunk is open at its end. The tables (at most ``limit`` rows a range) are composed
    in order, and then every range is chunked by itself from the state it is entered with. A
    chunk that opens at block i always begins at the earliest block from which ``overlap``
    tokens reach to i, whatever the chunk before held, since that place only moves forward."""
    rows = blocks.where(F.col(doc).isNotNull()).select(F.col(doc).cast("string").alias("doc"), F.col(order).cast("long").alias("ord"), "block_id",
                                                       tokens_of(F.col("text")).alias("tok"))
    placed = staged(placed_in_ranges(rows, ["doc"], [F.col("ord"), F.col("block_id")], "tok"), "chunk-places")
    per = placed.groupBy("doc", "_range").agg(F.min("before").alias("base"), F.max(F.col("before") + F.col("tok")).alias("end"))
    wide = per.groupBy("doc").agg(F.count("*").alias("ranges")).where("ranges > 1").select("doc")
    if not wide.take(1):  # every document lies in one range
        alone = placed.select("doc", "_range", "n", "ord", "block_id", "tok", "before", *[F.lit(None).cast("long").alias(c) for c in ("start", "chunk")],
                              *[F.lit(None).cast("array<long>").alias(c) for c in ("sums", "places")])
        got = alone.repartition("doc", "_range").sortWithinPartitions("doc", "_range", "n").mapInPandas(lambda frames: _chunked(frames, limit, overlap), _CHUNK)
        return got.select(*_CHUNK_COLUMNS).withColumnRenamed("doc", doc)
    cut = staged(per.join(wide, "doc", "left_semi"), "chunk-ranges")  # documents in several ranges: two per task
    own = placed.join(cut, ["doc", "_range"])
    tail = own.where(F.col("before") >= F.col("end") - overlap).groupBy("doc", "_range", "before").agg(F.min("n").alias("n")).groupBy(
        "doc", "_range").agg(F.array_sort(F.collect_list(F.struct("before", "n"))).alias("tail"))
    none = F.array().cast("array<struct<before:bigint,n:bigint>>")
    along = cut.join(tail, ["doc", "_range"], "left").select("doc", "_range", "base", F.coalesce("tail", none).alias("tail"))
    halos = staged(along.repartition("doc").sortWithinPartitions("doc", "_range").mapInPandas(
        lambda frames: _halos(frames, overlap), "doc string, _range int, base long, sums array<long>, places array<long>"), "chunk-halos")

    def tabulate(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        h, b = left.iloc[0], right.sort_values("n")
        table = _table(int(h.base), [int(x) for x in h.sums], b.before.to_numpy(), b.tok.to_numpy(), limit, overlap, b.n.iloc[0] == 0)
        return pd.DataFrame([(h.doc, h._range, h.base, [{"held": x, "start": y, "closed": z} for x, y, z in table])],
                            columns=["doc", "_range", "base", "table"])

    tables = halos.groupBy("doc", "_range").cogroup(own.select("doc", "_range", "n", "before", "tok").groupBy("doc", "_range")).applyInPandas(
        tabulate, "doc string, _range int, base long, table array<struct<held:long,start:long,closed:int>>")
    entries = tables.repartition("doc").sortWithinPartitions("doc", "_range").mapInPandas(_entries, "doc string, _range int, start long, chunk int")
    entered = halos.join(entries, ["doc", "_range"]).select(
        "doc", "_range", F.lit(-1).cast("long").alias("n"), "start", "chunk", "sums", "places")
    every = placed.select("doc", "_range", "n", "ord", "block_id", "tok", "before").unionByName(entered, allowMissingColumns=True)
    out = staged(every.repartition("doc", "_range").sortWithinPartitions("doc", "_range", "n").mapInPandas(
        lambda frames: _chunked(frames, limit, overlap), _CHUNK), "chunks")
    # Seeds that lie in the range before: their places are looked up.
    back = out.where("low IS NOT NULL").select("doc", "chunk_id", F.explode(F.sequence("low", "high")).alias("n"))
    seeds = back.join(placed.select("doc", "n", "ord", "block_id", "tok"), ["doc", "n"]).withColumn("seed", F.lit(True))
    return out.where("low IS NULL").select(*_CHUNK_COLUMNS).unionByName(seeds.select(*_CHUNK_COLUMNS)).withColumnRenamed("doc", doc)


def _chunked(frames: Iterator[pd.DataFrame], limit: int, overlap: int) -> Iterator[pd.DataFrame]:
    """Ranges chunked from the state they are entered with (the row n = -1, if any). ``low`` to ``high`` are
    places of a seed before the range."""
    now, chunk, start = None, 0, 0
    sums: deque = deque()  # (sum, place) within the overlap, a place per sum
    near: deque = deque()  # this range's blocks within the overlap
    for f in frames:
        out = []
        for d, r, n, o, b, t, before, s, c, hs, hp in zip(f.doc, f._range, f.n, f.ord, f.block_id, f.tok, f.before, f.start, f.chunk,
                                                          f.sums, f.places, strict=True):
            if (d, r) != now:
                now, chunk, start = (d, r), 0, 0
                sums.clear()
                near.clear()
            if n < 0:
                chunk, start = int(c), int(s)
                sums.extend(zip(hs, hp, strict=True))
                continue
            if not sums or before > sums[-1][0]:
                sums.append((before, n))
            while sums[0][0] < before - overlap:
                sums.popleft()
            while near and near[0][0] < sums[0][1]:
                near.popleft()
            if n > 0 and before + t - start > limit:
                start, place = sums[0]
                chunk += 1
                here = near[0][0] if near else n
                if place < here:
                    out.append((d, chunk, None, None, None, True, place, here - 1))
                out += [(d, chunk, x[1], x[2], x[3], True, None, None) for x in near]
            near.append((n, int(o), int(b), int(t)))
            out.append((d, chunk, int(o), int(b), int(t), False, None, None))
        got = pd.DataFrame(out, columns=["doc", "chunk_id", "ord", "block_id", "tok", "seed", "low", "high"])
        yield got.astype({c: "Int64" for c in ("ord", "block_id", "tok", "low", "high")})


def manifest(chunks: DataFrame, doc: str = "document_s3_key", per_batch: int = 5) -> DataFrame:
    """Batches of consecutive chunks with their totals."""
    batch = F.floor(F.col("chunk_id") / per_batch).cast("int")
    return chunks.groupBy(doc, batch.alias("batch_index")).agg(
        F.countDistinct("chunk_id").alias("chunk_count"), F.count("*").alias("block_count"), F.sum("tok").alias("tokens"))


def missing_results(expected: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """Batches of a manifest without a result: if there is any, the merge is an error."""
    return expected.join(results.select(*keys).distinct(), keys, "left_anti")


def strided_sample(blocks: DataFrame, doc: str = "document_s3_key", target: int = SAMPLE_TOKENS) -> DataFrame:
    """Every stride-th block of a document from the start until the target is reached; the stride is
    the document's tokens by the target, at least 1. Positions count from 0 without gaps."""
    rows = blocks.select(doc, "pos", "block_id", tokens_of(F.col("text")).alias("tok"))
    total = rows.groupBy(doc).agg(F.greatest(F.lit(1), F.floor(F.sum("tok") / target)).alias("stride"))
    order = [F.col("pos"), F.col("block_id")]
    placed = numbered(rows, [doc], order, "n").join(total, doc)
    taken = placed.where((F.col("n") - 1) % F.col("stride") == 0).select(doc, "pos", "block_id", "tok")
    return sum_before(taken, [doc], order, "tok").where(F.col("before") < target).select(doc, "pos", "block_id", "tok")
