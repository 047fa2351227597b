"""Mixing sources to target weights (problem 9).

Sizes are tokens of a public tokenizer. Targets whose source has no documents get no share
and the rest is scaled to one; documents of sources without a target are left out. The
mix is as large as the caps allow: total = min over sources of (repeats * tokens) / share.
Every source passes over its documents in hash order, pass after pass, until its quota is
reached; a document is never taken more than ``max_repeats`` times.

Pfair scheduling orders the mix: a source with weight w releases its j-th block at slot
floor((j - 1) / w) and must have it placed by slot ceil(j / w); of the released blocks the
one with the earliest deadline goes first. So at any slot each source is less than one
block of ``BLOCK`` tokens from its share, whatever the size of the corpus, the number of sources and the weights. The
schedule repeats itself: after as many slots as the least common multiple of the weights' denominators every source has had just its
share. One period is scheduled, and the blocks after the last whole one of the mix, whose start is like the first slot; all others follow.
A period longer than the mix never ends, then the latter are all blocks. A slot depends on all before it, so one task does this, in a
stream of at most one small row per ``BLOCK`` tokens, holding one block per source. Documents find their block by prefix sums.

Defined results: null and empty texts have no tokens and are left out; a null source is in
no target; repeated rows of one doc_id count once; max_repeats under 1 or null and shares
that are null, NaN or not above 0 count as no target; repeated targets of one source
add their shares and take the greatest max_repeats; no documents or no targets give an
empty mix; equal deadlines go to the greater weight, then to the source name.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hierarq.common import staged
from hierarq.llm.tokenize import VOCABULARY_DIR, count_tokens

#: Tokens of a block, and slots of a schedule that is broadcast; a longer one meets the blocks by a shuffled join.
BLOCK, MAX_PERIOD = 2_048, 200_000
#: Documents per bucket of the two-level prefix sums.
BUCKET_DOCS = 20_000
#: Slots that are scheduled between two batches of rows.
SLOTS_AT_ONCE = 50_000


def _scheduled(weights: dict[str, Fraction], blocks: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """(source, j, slot) in slot order, j from 1, slot from 0: earliest deadline first among released blocks."""
    whole = math.lcm(*[w.denominator for w in weights.values()])
    parts = [(s, int(weights[s] * whole), blocks.get(s, 0)) for s in sorted(weights, key=lambda s: (-weights[s], s))]
    waiting = [(0, o, 1) for o, (_, _, most) in enumerate(parts) if most > 0]  # (release, order of the source, j)
    ready: list[tuple[int, int, int]] = []
    heapq.heapify(waiting)
    slot = 0
    while waiting or ready:
        while waiting and waiting[0][0] <= slot:
            _, o, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-j * whole // parts[o][1]), o, j))
        if not ready:
            slot = waiting[0][0]
            continue
        _, o, j = heapq.heappop(ready)
        source, part, most = parts[o]
        yield source, j, slot
        if j < most:
            heapq.heappush(waiting, (j * whole // part, o, j + 1))
        slot += 1


def pfair(weights: dict[str, Fraction], blocks: dict[str, int]) -> list[tuple[str, int]]:
    """(source, j) in slot order, j from 1: earliest deadline first among released blocks."""
    return [(s, j) for s, j, _ in _scheduled(weights, blocks)]


def sized_documents(docs: DataFrame, vocabulary_dir: str = VOCABULARY_DIR) -> DataFrame:
    """(doc_id, source, n_tokens) of the documents that have tokens, once each."""
    kept = docs.where("doc_id IS NOT NULL AND source IS NOT NULL AND text IS NOT NULL AND text <> ''")
    sizes = count_tokens(kept.select("doc_id", "source", "text"), ["doc_id", "source"], vocabulary_dir=vocabulary_dir)
    return sizes.where("n_tokens > 0").groupBy("doc_id").agg(F.max(F.struct("source", "n_tokens")).alias("_r")).select(
        "doc_id", "_r.source", "_r.n_tokens")


def plan(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, share, max_repeats, docs, tokens, quota) per target source, one row each, staged. ``share`` is the part of
    the sum of the shares of the sources that have tokens; others have none."""
    good = targets.where("source IS NOT NULL AND target_share > 0 AND NOT isnan(target_share) AND max_repeats >= 1")
    want = good.groupBy("source").agg(F.sum(F.col("target_share").cast("decimal(20,10)")).alias("target"), F.max("max_repeats").alias("max_repeats"))
    have = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))
    rows = staged(want.join(have, "source").where("tokens > 0"), "mix-sources")
    whole = rows.agg(F.sum("target").alias("all_targets"))
    shared = rows.join(whole, how="cross").withColumn("share", F.col("target").cast("double") / F.col("all_targets").cast("double"))  # one row joined on
    least = shared.agg(F.min(F.col("tokens") * F.col("max_repeats") / F.col("share")).alias("total"))
    return staged(shared.join(least, how="cross").select("source", "target", "share", "max_repeats", "docs", "tokens", F.floor(F.col("total") * F.col("share")).alias("quota")).where(
        "quota > 0"), "mix-plan")


def _schedule(quotas: DataFrame) -> DataFrame:
    """(source, rest, turn, at, turns, whole, length, start), staged. In a period of ``length`` slots a source has ``turns`` blocks; the mix
    has whole periods up to slot ``start``, with ``whole`` blocks of the source, and a rest. The block ``turn`` of a period, or of the ``rest``,
    has slot ``at`` in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        if not rows:
            return
        exact = {r["source"]: Fraction(str(r["target"])) for r in rows}
        total = sum(exact.values())
        weights = {s: w / total for s, w in exact.items()}
        blocks = {r["source"]: -(-r["quota"] // BLOCK) for r in rows}
        length = math.lcm(*[w.denominator for w in weights.values()])
        turns = {s: int(w * length) for s, w in weights.items()}
        rounds = min(n // turns[s] for s, n in blocks.items())
        start, whole = rounds * length, {s: rounds * n for s, n in turns.items()}
        parts = [(True, _scheduled(weights, {s: n - whole[s] for s, n in blocks.items()}))]
        if rounds:
            parts.append((False, _scheduled(weights, turns)))
        else:
            length, turns = 1, dict.fromkeys(turns, 1)  # no period is used, it may be longer than any long
        for rest, placed in parts:
            while some := list(islice(placed, SLOTS_AT_ONCE)):
                source, turn, at = zip(*some, strict=True)
                same = len(some)
                longs = [turn, at, [turns[s] for s in source], [whole[s] for s in source], [length] * same, [start] * same]
                yield pa.RecordBatch.from_arrays([pa.array(source), pa.array([rest] * same), *[pa.array(x, pa.int64()) for x in longs]], names=names)

    schema = "source string, rest boolean, turn long, at long, turns long, whole long, length long, start long"
    names = [x.split()[0] for x in schema.split(", ")]
    return staged(quotas.select("source", "target", "quota").coalesce(1).mapInArrow(run, schema), "mix-schedule")


def _slots(quotas: DataFrame, blocks: DataFrame) -> DataFrame:
    """``blocks`` (source, block_no) with their ``slot``."""
    schedule = _schedule(quotas)
    of = schedule.where("turn = 1").select("source", "turns", "whole", "length", "start").distinct()  # one row per source
    before = F.col("block_no") - 1
    turned = blocks.join(of, "source").withColumn("rest", before >= F.col("whole")).withColumn(
        "turn", F.when(F.col("rest"), before - F.col("whole")).otherwise(before % F.col("turns")) + 1)
    at = schedule.select("source", "rest", "turn", "at")
    met = turned.join(F.broadcast(at) if schedule.count() <= MAX_PERIOD else at, ["source", "rest", "turn"])
    first = F.when(F.col("rest"), F.col("start")).otherwise(F.floor(before / F.col("turns")) * F.col("length"))
    return met.withColumn("slot", first + F.col("at")).drop("rest", "turn", "turns", "whole", "length", "start", "at")


def mixture(docs: DataFrame, targets: DataFrame, vocabulary_dir: str = VOCABULARY_DIR) -> DataFrame:
    """(position, source, doc_id, pass_no, block_no, slot, n_tokens): the mix in order."""
    return _mixture(staged(sized_documents(docs, vocabulary_dir), "mix-sizes"), targets)


def _mixture(sized: DataFrame, targets: DataFrame) -> DataFrame:
    quotas = plan(sized, targets)
    most = quotas.agg(F.max("docs")).first()[0] or 1
    buckets = max(1, -(-most // BUCKET_DOCS))
    # Two-level prefix sums: no task sees more than one bucket of a source.
    hashed = sized.join(quotas.select("source", "quota", "tokens", "max_repeats"), "source").withColumn("_h", F.xxhash64("doc_id")).withColumn(
        "_b", F.pmod(F.shiftright("_h", 16), F.lit(buckets)))
    sums = hashed.groupBy("source", "_b").agg(F.sum("n_tokens").alias("_t"))
    before = sums.select("source", "_b", (F.sum("_t").over(
        Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_t")).alias("_base"))
    inside = Window.partitionBy("source", "_b").orderBy("_h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = hashed.withColumn("_in", F.sum("n_tokens").over(inside)).join(before, ["source", "_b"]).withColumn(
        "_end", F.col("_base") + F.col("_in"))
    passes = placed.withColumn("pass_no", F.explode(F.sequence(
        F.lit(1), F.least(F.col("max_repeats").cast("long"), F.ceil(F.col("quota") / F.col("tokens")))))).withColumn(
        "_stop", (F.col("pass_no") - 1) * F.col("tokens") + F.col("_end")).where(F.col("_stop") <= F.col("quota"))
    blocked = passes.withColumn("block_no", F.floor((F.col("_stop") - F.col("n_tokens")) / BLOCK) + 1)
    timed = _slots(quotas, blocked)
    order = Window.partitionBy("slot").orderBy("_stop", "doc_id")
    # Every document has a token at least, so a block begins at most BLOCK of them.
    return timed.withColumn("_n", F.row_number().over(order)).select(
        (F.col("slot") * F.lit(BLOCK) + F.col("_n") - 1).alias("position"), "source", "doc_id", "pass_no", "block_no",
        "slot", "n_tokens")


def actual_shares(docs: DataFrame, targets: DataFrame, vocabulary_dir: str = VOCABULARY_DIR) -> DataFrame:
    """Per source of documents or targets: target share, tokens and documents there are,
    tokens, documents and repeats in the mix, and the actual share of the mix."""
    sized = staged(sized_documents(docs, vocabulary_dir), "mix-sizes")
    used = staged(_mixture(sized, targets).groupBy("source", "doc_id").agg(F.count("*").alias("times"), F.sum("n_tokens").alias("t")).groupBy(
        "source").agg(F.sum("t").alias("mix_tokens"), F.count("*").alias("mix_docs"), F.max("times").alias("most_repeats")), "mix-used")
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    want = targets.groupBy("source").agg(F.sum("target_share").alias("target_share"),
                                         F.max("max_repeats").alias("max_repeats"))
    total = used.agg(F.sum("mix_tokens").alias("all_tokens")).first()[0] or 0
    every = have.join(want, "source", "full").join(used, "source", "left")
    zero = [c for c in ("tokens", "docs", "mix_tokens", "mix_docs", "most_repeats")]
    return every.select("source", "target_share", "max_repeats", *[F.coalesce(c, F.lit(0)).alias(c) for c in zero],
                        F.round(F.coalesce("mix_tokens", F.lit(0)) / F.lit(max(total, 1)), 6).alias("actual_share"))
