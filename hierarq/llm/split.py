"""Splitting oversized texts at natural boundaries (problem 1).

Dynamic programming over boundary positions: a cut costs the penalty of its boundary
kind, the penalty of the boundary the next piece starts at, and the squared deviation of the
piece from the ideal size, subject to the maximum length; each piece after the first starts up
to ``overlap`` tokens before the cut, at the natural boundary in that span with the least
penalty and loss of overlap.

A token is ``chars_per_token`` code points, rounded down, so a limit of T tokens
admits T * chars_per_token + chars_per_token - 1 code points.

Defined results: null and empty texts, and texts within the limit, are one piece
(``pieces``) or are left out (``oversized_only=True``); ties between cuts of equal cost
go to the earlier position; repeated rows of one block_id count once (the earliest
``extracted_at``); a text without any boundary is cut at code points, never inside a
combining sequence; an empty table gives an empty table. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SplitLimits:
    max_tokens: int = 2000
    overlap_tokens: int = 500
    chars_per_token: int = 4
    #: Cut candidates inside a span without natural boundaries, one per so many code points.
    hard_step: int = 64
    #: Spans up to so many code points between good boundaries are not searched for weaker ones.
    fine_gap: int = 400
    balance_weight: float = 4.0

    @property
    def max_chars(self) -> int:
        return self.max_tokens * self.chars_per_token + self.chars_per_token - 1

    @property
    def overlap_chars(self) -> int:
        return self.overlap_tokens * self.chars_per_token + self.chars_per_token - 1


#: Boundary kinds from best to worst: pattern whose end is a cut position, and penalty.
BOUNDARIES = [
    (re.compile(r"(?:\r\n|\n|\r)[ \t]*(?:\r\n|\n|\r)\s*"), 0.0),
    (re.compile(r"[.!?…][\"'”’)\]»]*\s+|[。！？][”’）」』]*\s*"), 0.1),
    (re.compile(r"\r\n|\n|\r"), 0.4),
    (re.compile(r"[;:][ \t]*|[；：]"), 0.6),
    (re.compile(r"[,][ \t]+|[，、]"), 0.8),
    (re.compile(r"[ \t ]+"), 1.0),
]
HARD_PENALTY = 6.0
#: Code points that continue the one before: marks, joiners, variation selectors, skin tones.
_CONTINUES = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u20d0-\u20ff\ufe00-\ufe0f\u200d\U0001f3fb-\U0001f3ff]")


def boundaries(text: str, limits: SplitLimits) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions (0 and the length included, sorted) and their penalties.

    A weaker kind is searched only in spans wider than ``limits.fine_gap`` between the
    boundaries of better kinds, which keeps the positions proportional to the length.
    """
    n = len(text)
    pos, pen = np.array([0, n]), np.zeros(2)
    for pattern, penalty in [*BOUNDARIES, (None, HARD_PENALTY)]:
        wide = np.flatnonzero(np.diff(pos) > limits.fine_gap)
        new: list[int] = []
        for g in wide:
            a, z = int(pos[g]), int(pos[g + 1])
            if pattern is None:
                for p in range(a + limits.hard_step, z, limits.hard_step):
                    while p < z and (_CONTINUES.match(text, p) or text[p - 1] == "\u200d"):
                        p += 1
                    if p < z:
                        new.append(p)
            else:
                new += [m.end() for m in pattern.finditer(text, a, z) if a < m.end() < z]
        if new:
            add = np.setdiff1d(np.array(new), pos)
            order = np.argsort(both := np.concatenate([pos, add]), kind="stable")
            pos, pen = both[order], np.concatenate([pen, np.full(len(add), penalty)])[order]
    return pos, pen


def split_points(text: str, limits: SplitLimits = SplitLimits()) -> list[tuple[int, int]]:
    """(start, end) of each piece. The ends rise, each start is at most the overlap
    before the end of the piece before, and no piece is longer than the limit."""
    n = len(text)
    if n <= limits.max_chars:
        return [(0, n)]
    pos, pen = boundaries(text, limits)
    if np.diff(pos).max() > limits.max_chars - limits.overlap_chars:  # one endless combining sequence
        extra = np.arange(0, n, limits.hard_step)
        merged = np.union1d(pos, extra)
        at = dict(zip(pos.tolist(), pen.tolist(), strict=True))
        pos, pen = merged, np.array([at.get(int(p), 2 * HARD_PENALTY) for p in merged])
    # Start of a piece that follows a cut at pos[i]: of each kind of boundary the earliest in the span is the best.
    starts, toll, best = pos.copy(), np.full(len(pos), HARD_PENALTY), np.full(len(pos), np.inf)
    for penalty in np.unique(pen[pen < HARD_PENALTY]):
        of_kind = pos[pen == penalty]
        at = of_kind[np.minimum(np.searchsorted(of_kind, pos - limits.overlap_chars, side="left"), len(of_kind) - 1)]
        lost = penalty + (at - (pos - limits.overlap_chars)) / max(1, limits.overlap_chars)
        better = (at < pos) & (at >= pos - limits.overlap_chars) & (lost < best)
        starts, toll, best = np.where(better, at, starts), np.where(better, penalty, toll), np.where(better, lost, best)
    bare = starts >= pos  # no natural boundary before the cut within the overlap
    starts = np.where(bare, np.maximum(0, pos - limits.overlap_chars), starts)
    while bare.any():  # a start inside a combining sequence moves to the right
        inside = np.array([b and s < p and bool(_CONTINUES.match(text, int(s)))
                           for b, s, p in zip(bare, starts, pos, strict=True)])
        if not inside.any():
            break
        starts = starts + inside
    starts[0], toll[0] = 0, 0.0
    count = int(np.ceil((n - limits.overlap_chars) / (limits.max_chars - limits.overlap_chars)))
    ideal = min(limits.max_chars, (n + (count - 1) * limits.overlap_chars) / count)
    cost = np.full(len(pos), np.inf)
    back = np.zeros(len(pos), dtype=np.int64)
    cost[0] = 0.0
    low = np.searchsorted(np.maximum.accumulate(starts), pos - limits.max_chars, side="left")
    for j in range(1, len(pos)):
        lo = int(low[j])
        if lo >= j:
            continue
        sizes = pos[j] - starts[lo:j]
        total = cost[lo:j] + toll[lo:j] + 1.0 + limits.balance_weight * ((sizes - ideal) / ideal) ** 2
        total = np.where(sizes <= limits.max_chars, total, np.inf)
        k = int(np.argmin(total))
        cost[j], back[j] = total[k] + pen[j], lo + k
    cuts, j = [], len(pos) - 1
    while j > 0:
        cuts.append((int(starts[back[j]]), int(pos[j])))
        j = int(back[j])
    return cuts[::-1]


PIECES_SCHEMA = ("block_id long, page_number int, piece_no int, n_pieces int, char_start int, "
                 "char_end int, n_tokens int, text string")


def pieces(blocks: DataFrame, limits: SplitLimits = SplitLimits(), oversized_only: bool = False) -> DataFrame:
    """One row per piece of each block of ``blocks`` (block_id, page_number, text,
    extracted_at). The size test and the choice of one row per block_id run in the
    JVM, so only oversized texts reach Python when ``oversized_only`` is set."""
    size = F.floor(F.length("text") / limits.chars_per_token)
    df = blocks.select("block_id", "page_number", "text", "extracted_at")
    if oversized_only:
        df = df.where(size > limits.max_tokens)
    df = (df.where("block_id IS NOT NULL").groupBy("block_id")
          .agg(F.min_by(F.struct("page_number", "text"), F.col("extracted_at")).alias("_r"),
               F.max(F.struct("page_number", "text")).alias("_any"))
          .select("block_id", F.coalesce("_r", "_any").alias("_r"))
          .select("block_id", "_r.page_number", "_r.text"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for block, page, text in zip(frame.block_id, frame.page_number, frame.text, strict=True):
                if text is None:
                    rows.append((block, page, 0, 1, 0, 0, 0, None))
                    continue
                spans = split_points(text, limits)
                rows += [(block, page, i, len(spans), a, b, (b - a) // limits.chars_per_token, text[a:b])
                         for i, (a, b) in enumerate(spans)]
            out = pd.DataFrame(rows, columns=["block_id", "page_number", "piece_no", "n_pieces", "char_start",
                                              "char_end", "n_tokens", "text"])
            out["page_number"] = out["page_number"].astype("Int32")
            yield out

    return df.mapInPandas(cut, PIECES_SCHEMA)
