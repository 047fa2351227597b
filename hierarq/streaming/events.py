"""Event streams: windowed sums with watermark, and folds of message frames per session.

Late rows: a row later than the watermark is dropped by the append and update modes; the
complete mode used for dashboards keeps all. Frames: ``text`` appends to the open answer, ``error``
and ``done`` end it, anything else is ignored, as are frames after the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hierarq.common import shared_path
from hierarq.operators.ordered import filled_forward, joined_parts, previous


def event_stream(spark: SparkSession, path: str, schema: str, at: str = "ts") -> DataFrame:
    """A file stream with ``at`` as event time."""
    return spark.readStream.schema(schema).parquet(path).withColumn(at, F.col(at).cast("timestamp"))


def windowed_sums(events: DataFrame, length: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", lateness).groupBy(F.window("ts", length).alias("w"), "event_type").agg(
        F.count("*").alias("n"), F.sum("value").alias("total")).select(
        F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("bucket"), "event_type", "n", F.round("total", 4).alias("total"))


def run_to_end(stream: DataFrame, label: str, mode: str = "complete") -> DataFrame:
    """Processes what is there and returns the sink's table. Every batch replaces its own folder,
    so a repeated batch changes nothing."""
    base = shared_path(stream.sparkSession, "stream", label)

    def sink(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/{'last' if mode == 'complete' else f'batch={n}'}")

    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(sink).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{base}/out/last" if mode == "complete" else f"{base}/out/*")


def fold_frames(frames: DataFrame) -> DataFrame:
    """Batch fold of (session, seq, kind, text): (session, part, answer, state), the answer so far in parts of a
    hundred frames, so that no session is collected; one without text has one empty part.

    Frames after the first error or end are cut by its position, an aggregate that combines map-side."""
    end = frames.where(F.col("kind").isin("done", "error")).groupBy("session").agg(F.min(F.struct("seq", "kind")).alias("e"))
    text = frames.where("kind = 'text' AND text IS NOT NULL").join(end, "session", "left").where(
        F.col("e").isNull() | (F.col("seq") < F.col("e.seq")))
    body = joined_parts(text.select("session", "seq", "text"), ["session"], [F.col("seq")], F.col("text"), "", "answer")
    return frames.select("session").distinct().join(body, "session", "left").join(end, "session", "left").select(
        "session", F.coalesce("part", F.lit(0).cast("long")).alias("part"), F.coalesce("answer", F.lit("")).alias("answer"),
        F.coalesce("e.kind", F.lit("open")).alias("state"))


def fold_frame_stream(frames: DataFrame) -> DataFrame:
    """The same fold as a stateful stream: state per session is the answer and whether it ended."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        answer, ended = state.get if state.exists else ("", "open")
        for p in parts:
            for _, kind, text in sorted(zip(p["seq"], p["kind"], p["text"], strict=True), key=lambda r: r[0]):
                if ended == "open":
                    if kind == "text" and text is not None:
                        answer += text
                    elif kind in ("done", "error"):
                        ended = kind
        state.update((answer, ended))
        yield pd.DataFrame([(key[0], answer, ended)], columns=["session", "answer", "state"])

    return frames.groupBy("session").applyInPandasWithState(
        step, "session long, answer string, state string", "answer string, ended string", "update", GroupStateTimeout.NoTimeout)


def enriched(message: Column, plan_id: Column) -> Column:
    """A message after its session's context; null for blank messages."""
    words = F.trim(F.coalesce(message, F.lit("")))
    context = F.when(F.coalesce(plan_id, F.lit("")) != "", F.concat(F.lit("[Session context: planId="), plan_id, F.lit("]\n\n"))).otherwise("")
    return F.when(words != "", F.concat(context, words))


def agent_frames(messages: DataFrame) -> DataFrame:
    """``messages`` (message, chunks array<string>, error, ...) as frames (step from 1, type, text): the answer's chunks as
    ``text`` and a ``done``, or an ``error`` and a ``done``. Blank messages are passed over. Works on streams too."""
    frame = lambda t, x: F.struct(F.lit(t).alias("type"), x.cast("string").alias("text"))
    done = F.array(frame("done", F.lit(None)))
    texts = F.transform(F.coalesce("chunks", F.array().cast("array<string>")), lambda x: frame("text", x))
    frames = F.when(F.col("error").isNotNull(), F.concat(F.array(frame("error", F.col("error"))), done)).otherwise(F.concat(texts, done))
    asked = messages.where(F.trim(F.coalesce("message", F.lit(""))) != "")
    rest = [c for c in messages.columns if c not in ("message", "chunks", "error")]
    return asked.select(*rest, F.posexplode(frames).alias("_at", "_f")).select(*rest, (F.col("_at") + 1).alias("step"), "_f.type", "_f.text")


def renewals(asks: DataFrame, session: str, at: str, ttl: int) -> DataFrame:
    """(session, renewed_at, expires_at): a link is made at a session's first ask (``at`` in seconds) and made anew at the
    first ask once it has expired.

    A pause of at least ``ttl`` makes the next ask a renewal whatever came before, so sessions are cut
    there and the pieces, not the sessions, are gone through one after the other."""
    rows = asks.where(F.col(session).isNotNull() & F.col(at).isNotNull()).select(F.col(session).alias("s"), F.col(at).cast("long").alias("t")).distinct()
    cut = previous(rows, ["s"], [F.col("t")], "t", "_before")
    begins = F.when(F.col("_before").isNull() | (F.col("t") - F.col("_before") >= ttl), F.col("t"))
    pieces = filled_forward(cut.withColumn("_begin", begins), ["s"], [F.col("t")], "_begin", "piece")
    kind = asks.schema[session].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, ends = None, 0
        for f in frames:
            out = []
            for s, p, t in zip(f.s, f.piece, f.t, strict=True):
                if (s, p) != now or t >= ends:
                    now, ends = (s, p), t + ttl
                    out.append((s, t, ends))
            yield pd.DataFrame(out, columns=[session, "renewed_at", "expires_at"])

    ordered = pieces.select("s", "piece", "t").repartition("s", "piece").sortWithinPartitions("s", "piece", "t")
    return ordered.mapInPandas(run, f"`{session}` {kind}, renewed_at long, expires_at long")


def renewal_stream(asks: DataFrame, session: str, at: str, ttl: int) -> DataFrame:
    """``renewals`` as a stateful stream: a session's state is when its link expires."""
    kind = asks.schema[session].dataType.simpleString()

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ends = state.get[0] if state.exists else 0
        out = []
        for t in sorted(t for p in parts for t in p[at]):
            if t >= ends:
                ends = t + ttl
                out.append((key[0], t, ends))
        state.update((ends,))
        yield pd.DataFrame(out, columns=[session, "renewed_at", "expires_at"])

    return asks.groupBy(session).applyInPandasWithState(step, f"`{session}` {kind}, renewed_at long, expires_at long", "ends long", "append",
                                                        GroupStateTimeout.NoTimeout)
