"""Cost, latency and usage of model calls: prices, rollups, windows, logs.

Copies of a call count once. Models without a price cost nothing; null tokens count 0. Null
times fall into no window. Percentiles here are exact, for dashboards over short windows;
sketches for long ranges are elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Price per thousand tokens in and out by class of model, a part of the model's id.
PRICES = [("large", 0.005, 0.025), ("medium", 0.003, 0.015)]


#: Values a percentile summary keeps: rank error at most one in so many.
SUMMARY = 10_000


def percentile_of(c: Column, q: float, exact: bool = False) -> Column:
    """The value of rank ceil(q n), from a mergeable summary of bounded size; with ``exact`` all values
    of a group are held, which only short windows bear."""
    return F.percentile(c, q) if exact else F.percentile_approx(c, q, SUMMARY)


def once(calls: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per call_id, the first to arrive, with ``columns`` (by default all), of which only these are read."""
    rest = [c for c in dict.fromkeys(calls.columns if columns is None else columns) if c not in ("call_id", "ingested_at")]
    return calls.where("call_id IS NOT NULL").groupBy("call_id").agg(F.min(F.struct("ingested_at", *rest)).alias("r")).select(
        "call_id", *[F.col(f"r.{c}").alias(c) for c in rest])


def priced(calls: DataFrame, prices: list[tuple[str, float, float]] = PRICES) -> DataFrame:
    """``calls`` with cost_usd; the price list is a setting of a few rows, broadcast."""
    p = calls.sparkSession.createDataFrame(prices, "_class string, p_in double, p_out double")
    named = calls.withColumn("_class", F.regexp_extract("model_id", "|".join(c for c, _, _ in prices), 0))
    cost = F.coalesce(F.col("input_tokens"), F.lit(0)) / 1000 * F.coalesce("p_in", F.lit(0.0)) + F.coalesce(
        F.col("output_tokens"), F.lit(0)) / 1000 * F.coalesce("p_out", F.lit(0.0))
    return named.join(F.broadcast(p), "_class", "left").withColumn("cost_usd", cost).drop("_class", "p_in", "p_out")


def measured(latency: Column) -> Column:
    return F.when(~F.isnan(latency) & (latency >= 0), latency)


def run_rollup(calls: DataFrame) -> DataFrame:
    """Totals per run and per stage of a run, in one pass; ``stage`` is ``all`` in a run's total."""
    t = calls.withColumn("stage", F.coalesce("stage", F.lit("none"))).withColumn("run_id", F.coalesce("run_id", F.lit("none")))
    r = t.rollup("run_id", "stage").agg(
        F.count("*").alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"),
        F.round(F.sum("cost_usd"), 6).alias("cost_usd"), F.round(F.sum(measured(F.col("latency_ms"))), 1).alias("latency_ms"))
    return r.where("run_id IS NOT NULL").withColumn("stage", F.coalesce("stage", F.lit("all")))


def windows(calls: DataFrame, length: str, keys: list[str], aggs: list[Column], at: str = "called_at") -> DataFrame:
    """Tumbling windows by event time."""
    return calls.where(F.col(at).isNotNull()).groupBy(F.window(F.col(at).cast("timestamp"), length).alias("w"), *keys).agg(*aggs).select(
        F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("bucket"), *keys, *[c for c in [_name(a) for a in aggs]])


def _name(c: Column) -> str:
    return c._jc.toString().rsplit(" AS ", 1)[-1].strip("`")


def fan_out(calls: DataFrame) -> DataFrame:
    """Each call as rows of (dimension set, metric, value): five metrics, retries and errors where
    there are any, for the stage alone and for stage and model."""
    def item(name: str, value: Column) -> Column:
        return F.named_struct(F.lit("metric"), F.lit(name), F.lit("value"), value.cast("double"))

    base = F.array(item("InputTokens", F.col("input_tokens")), item("OutputTokens", F.col("output_tokens")),
                   item("LatencyMs", measured(F.col("latency_ms"))), item("CostUSD", F.round("cost_usd", 6)), item("CallCount", F.lit(1)))
    extra = F.array_compact(F.array(F.when(F.col("retry_count") > 0, item("RetryCount", F.col("retry_count"))),
                                    F.when(~F.col("success"), item("ErrorCount", F.lit(1)))))
    dims = F.array(F.concat(F.lit("stage="), F.coalesce("stage", F.lit("none"))), F.concat(
        F.lit("stage="), F.coalesce("stage", F.lit("none")), F.lit(",model="), F.coalesce("model_id", F.lit("none"))))
    return calls.select("call_id", F.explode(dims).alias("dimensions"), F.concat(base, extra).alias("m")).select(
        "call_id", "dimensions", F.explode("m").alias("m")).select("call_id", "dimensions", "m.metric", "m.value")


def log_lines(calls: DataFrame) -> DataFrame:
    """One JSON line per call."""
    return calls.select("call_id", F.to_json(F.struct(
        F.lit("llm_call").alias("event"), "run_id", "stage", "model_id", "input_tokens", "output_tokens",
        F.col("cost_usd").cast("decimal(18,6)").cast("string").alias("cost_usd"), "retry_count", "success")).alias("line"))


def latest_totals(calls: DataFrame) -> DataFrame:
    """Fold of a run's history: of each field the last value that is not null, by time and id."""
    order = F.struct("called_at", "call_id")
    keep = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
    return calls.where("run_id IS NOT NULL").groupBy("run_id").agg(keep("batch_index"), keep("chunk_index"), keep("error"))
