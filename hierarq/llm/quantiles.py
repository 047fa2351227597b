"""Percentiles of very large numeric columns by relative-rank compactors (problem 4).

A sketch is a stack of compactors. A full compactor sorts its buffer, leaves the upper
part alone and promotes every other item of the lower part to the next level with twice
the weight. How much it leaves alone follows a schedule that compacts the low sections
often and the high ones rarely, so the rank error is multiplicative at the upper tail:
the rank of a value estimated at q is off by at most ``ERROR_SIGMAS * 0.1306 / k * (1 - q)``
of the count (three standard deviations; ranks within the top ``k`` items are exact).
Sketches of partitions or days merge without losing this bound.

Defined results: null, NaN, infinite and negative values are failed readings and are
left out; a null stage or model forms a group of its own; repeated deliveries of one
call_id count once (rows without a call_id count each); a group without any measured
value has no row; an empty table gives an empty table; ties keep their multiplicity.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Section size of a fresh compactor: larger is more exact and larger.
DEFAULT_K = 64
ERROR_SIGMAS = 3.0
INITIAL_SECTIONS = 3


def rank_error(k: int = DEFAULT_K) -> float:
    """Bound on |estimated - true rank| / (n * (1 - q)), three standard deviations."""
    return ERROR_SIGMAS * (0.0512 / INITIAL_SECTIONS) ** 0.5 / k


class _Level:
    __slots__ = ("buffer", "sections", "size", "state")

    def __init__(self, k: int) -> None:
        self.buffer = np.empty(0)
        self.sections = INITIAL_SECTIONS
        self.size = float(k)
        self.state = 0

    @property
    def section(self) -> int:
        return max(4, 2 * round(self.size / 2))

    @property
    def capacity(self) -> int:
        return 2 * self.sections * self.section

    def grow(self) -> None:
        while self.state >= 1 << (self.sections - 1) and self.section > 4:
            self.sections *= 2
            self.size /= 2**0.5


class RankSketch:
    """Mergeable quantile sketch with relative rank error at the upper end."""

    def __init__(self, k: int = DEFAULT_K) -> None:
        self.k = k
        self.n = 0
        self.low, self.high = np.inf, -np.inf
        self.levels = [_Level(k)]

    def update(self, values: np.ndarray) -> RankSketch:
        values = np.asarray(values, dtype=np.float64)
        values = values[np.isfinite(values)]
        if len(values):
            self.n += len(values)
            self.low, self.high = min(self.low, values.min()), max(self.high, values.max())
            at = 0
            while at < len(values):  # fill the lowest buffer up to its capacity, then compact
                base = self.levels[0]
                room = max(1, base.capacity - len(base.buffer))
                base.buffer = np.concatenate([base.buffer, values[at : at + room]])
                at += room
                self._compress()
        return self

    def merge(self, other: RankSketch) -> RankSketch:
        self.n += other.n
        self.low, self.high = min(self.low, other.low), max(self.high, other.high)
        while len(self.levels) < len(other.levels):
            self.levels.append(_Level(self.k))
        for mine, theirs in zip(self.levels, other.levels, strict=False):
            mine.buffer = np.concatenate([mine.buffer, theirs.buffer])
            mine.state |= theirs.state
            if theirs.sections > mine.sections:
                mine.sections, mine.size = theirs.sections, theirs.size
            mine.grow()
        self._compress()
        return self

    def _compress(self) -> None:
        i = 0
        while i < len(self.levels):
            lv = self.levels[i]
            if len(lv.buffer) >= lv.capacity:
                if i + 1 == len(self.levels):
                    self.levels.append(_Level(self.k))
                trailing = (~lv.state & (lv.state + 1)).bit_length() - 1
                free = min(lv.sections, trailing + 1) * lv.section
                keep = lv.capacity - lv.capacity // 2 + lv.sections * lv.section - free
                keep = min(keep, len(lv.buffer) - 2)
                cut = len(lv.buffer) - keep
                cut -= cut % 2
                items = np.sort(lv.buffer)
                # A coin from the level and the pair of compactions, the second of a pair
                # takes the other side: errors cancel, and a rerun gives the same sketch.
                coin = ((lv.state >> 1) * 0x9E3779B1 + i * 0x85EBCA6B) >> 15 & 1
                offset = coin ^ (lv.state & 1)
                up = items[offset:cut:2]
                lv.buffer = items[cut:]
                lv.state += 1
                lv.grow()
                self.levels[i + 1].buffer = np.concatenate([self.levels[i + 1].buffer, up])
            i += 1

    def quantile(self, q: float) -> float:
        return self.quantiles([q])[0]

    def quantiles(self, qs: list[float]) -> list[float]:
        """The values at ranks ceil(q * n) of the weighted items (smallest at q = 0)."""
        if not self.n:
            return [float("nan")] * len(qs)
        if len(self.levels) == 1:
            items = np.sort(self.levels[0].buffer)
            at = np.clip(np.ceil(np.array(qs) * self.n).astype(np.int64) - 1, 0, len(items) - 1)
            return items[at].tolist()
        items = np.concatenate([lv.buffer for lv in self.levels])
        weights = np.repeat(1 << np.arange(len(self.levels), dtype=np.int64), [len(lv.buffer) for lv in self.levels])
        order = np.argsort(items, kind="stable")
        ranks = np.cumsum(weights[order])
        at = np.minimum(np.searchsorted(ranks, np.ceil(np.array(qs) * self.n), side="left"), len(items) - 1)
        return [float(self.low) if q <= 0 else float(self.high) if q >= 1 else float(items[order[i]])
                for q, i in zip(qs, at, strict=True)]

    def to_bytes(self) -> bytes:
        head = struct.pack("<iqddi", self.k, self.n, self.low, self.high, len(self.levels))
        body = [struct.pack("<idqi", lv.sections, lv.size, lv.state, len(lv.buffer)) + lv.buffer.tobytes()
                for lv in self.levels]
        return head + b"".join(body)

    @classmethod
    def from_bytes(cls, data: bytes) -> RankSketch:
        at = struct.calcsize("<iqddi")
        k, n, low, high, count = struct.unpack_from("<iqddi", data)
        out = cls(k)
        out.n, out.low, out.high, out.levels = n, low, high, []
        for _ in range(count):
            lv = _Level(k)
            lv.sections, lv.size, lv.state, m = struct.unpack_from("<idqi", data, at)
            at += struct.calcsize("<idqi")
            lv.buffer = np.frombuffer(data, dtype=np.float64, count=m, offset=at).copy()
            at += 8 * m
            out.levels.append(lv)
        return out


def measured_calls(calls: DataFrame) -> DataFrame:
    """(stage, model_id, day, latency_ms) of each call once, measured values only.

    Deliveries of one call are equal but for ``ingested_at``, so the filter may come
    first and the narrow columns are all that is shuffled, on call_id (no hot key).
    """
    good = F.col("latency_ms").isNotNull() & ~F.isnan("latency_ms") & (F.col("latency_ms") >= 0) \
        & (F.col("latency_ms") < float("inf"))
    df = calls.where(good).select("call_id", "stage", "model_id", F.to_date("called_at").alias("day"), "latency_ms")
    keyed = df.where("call_id IS NOT NULL").groupBy("call_id").agg(
        F.min(F.struct("day", "stage", "model_id", "latency_ms")).alias("_r"))
    keyed = keyed.select("_r.stage", "_r.model_id", "_r.day", "_r.latency_ms")
    return keyed.unionByName(df.where("call_id IS NULL").drop("call_id"))


def _partial(keys: list[str], value: str, k: int):
    """Sketches of one task's rows: map-side pre-aggregation, so a hot group never moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches: dict[tuple, RankSketch] = {}
        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.schema.field(c).type for c in keys]
            t = pa.table({**{c: batch.column(c) for c in keys}, "_v": batch.column(value)})
            g = t.group_by(keys).aggregate([("_v", "list")])
            for row in zip(*[g.column(c).to_pylist() for c in keys], g.column("_v_list").chunks[0] if g.num_rows else [],
                           strict=True):
                sk = sketches.get(row[:-1])
                if sk is None:
                    sk = sketches[row[:-1]] = RankSketch(k)
                sk.update(np.sort(row[-1].values.to_numpy(zero_copy_only=False)))
        if sketches:
            cols = [pa.array([r[i] for r in sketches], type=kinds[i]) for i in range(len(keys))]
            cols.append(pa.array([s.to_bytes() for s in sketches.values()], type=pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=[*keys, "sketch"])

    return run


def merge_sketches(parts: DataFrame, keys: list[str], k: int = DEFAULT_K) -> DataFrame:
    """One sketch per combination of ``keys`` (nulls form a group) out of many.

    Rows come sorted by key and are merged as they stream by, so a task holds one open sketch
    of bounded size, however many sketches a group has."""
    fields = {f.name: f for f in parts.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in keys) + ", sketch binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key: tuple | None = None
        data: bytes | None = None
        sk: RankSketch | None = None
        for batch in batches:
            done: list[tuple] = []
            kinds = [batch.schema.field(c).type for c in keys]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:-1] == open_key:
                    sk = (sk or RankSketch.from_bytes(data)).merge(RankSketch.from_bytes(row[-1]))
                    continue
                if open_key is not None:
                    done.append((*open_key, sk.to_bytes() if sk else data))
                open_key, data, sk = row[:-1], row[-1], None
            if done:
                yield _batch(done, kinds)
        if open_key is not None:
            yield _batch([(*open_key, sk.to_bytes() if sk else data)], kinds)

    def _batch(rows: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
        cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [*kinds, pa.binary()], strict=True)]
        return pa.RecordBatch.from_arrays(cols, names=[*keys, "sketch"])

    ordered = parts.select(*keys, "sketch").repartition(*keys).sortWithinPartitions(*keys, "sketch")
    return ordered.mapInArrow(run, schema)


def sketches(values: DataFrame, keys: list[str], value: str, k: int = DEFAULT_K) -> DataFrame:
    """(keys..., sketch) of a numeric column: per task first, then merged."""
    fields = {f.name: f for f in values.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in keys) + ", sketch binary"
    parts = values.select(*keys, F.col(value).cast("double").alias(value)).mapInArrow(_partial(keys, value, k), schema)
    return merge_sketches(parts, keys, k)


def estimates(sk: DataFrame, keys: list[str], qs: dict[str, float], k: int = DEFAULT_K) -> DataFrame:
    """(keys..., n, one column per entry of ``qs``, rank_error)."""
    fields = {f.name: f for f in sk.schema.fields}
    bound = rank_error(k)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = [RankSketch.from_bytes(x) for x in frame["sketch"]]
            out = frame[keys].copy()
            out["n"] = [s.n for s in own]
            got = [s.quantiles(list(qs.values())) for s in own]
            for i, name in enumerate(qs):
                out[name] = [g[i] for g in got]
            out["rank_error"] = bound
            yield out

    schema = ", ".join([*(f"`{c}` {fields[c].dataType.simpleString()}" for c in keys), "n long",
                        *(f"{c} double" for c in qs), "rank_error double"])
    return sk.select(*keys, "sketch").mapInPandas(run, schema)


LATENCY_QUANTILES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


def latency_percentiles(calls: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Median, 90th and 99th percentile of latency_ms per stage and model_id for each
    day, month and the whole time (``grain``, ``period``). Months and the whole time are
    merged from the daily sketches, the values themselves are read once."""
    keys = ["stage", "model_id", "day"]
    daily = sketches(measured_calls(calls), keys, "latency_ms", k)
    grains = F.array(
        F.struct(F.lit("day").alias("grain"), F.date_format("day", "yyyy-MM-dd").alias("period")),
        F.struct(F.lit("month").alias("grain"), F.date_format("day", "yyyy-MM").alias("period")),
        F.struct(F.lit("all").alias("grain"), F.lit("all").alias("period")))
    spread = daily.select("stage", "model_id", F.explode(grains).alias("g"), "sketch").select(
        "stage", "model_id", "g.grain", "g.period", "sketch")
    out = ["stage", "model_id", "grain", "period"]
    return estimates(merge_sketches(spread, out, k), out, LATENCY_QUANTILES, k)
