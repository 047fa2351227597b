"""Queries of the training-data operators: their SQL, and properties on the whole small tables."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from hierarq.llm import quantiles
from hierarq.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, small, name) -> None:  # noqa: ANN001
    con = duckdb.connect()
    for t in ("text_blocks", "llm_call_metrics"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    df = QUERIES[name](spark, small)
    result = con.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr) == sorted(result.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name) -> None:  # noqa: ANN001
    df = QUERIES[name](spark, small)
    assert df.columns and df.count() >= 0


def test_percentiles_against_exact_ranks(spark) -> None:  # noqa: ANN001
    d = "/root/testdata/sf0.01"
    got = QUERIES["p4_percentiles"](spark, d).where("grain = 'all'").collect()
    calls = quantiles.measured_calls(spark.read.parquet(f"{d}/llm_call_metrics.parquet")).toPandas()
    assert len(got) > 5
    for r in got:
        own = calls[(calls.stage == r.stage) if r.stage is not None else calls.stage.isna()]
        own = np.sort(own[(own.model_id == r.model_id) if r.model_id is not None else own.model_id.isna()].latency_ms.to_numpy())
        assert len(own) == r.n
        for q, v in ((0.5, r.p50), (0.9, r.p90), (0.99, r.p99)):
            want = int(np.ceil(q * len(own)))
            low, high = np.searchsorted(own, v, "left") + 1, np.searchsorted(own, v, "right")
            assert max(low - want, want - high, 0) <= quantiles.rank_error() * (1 - q) * len(own) + 1


def test_pieces_cover_their_texts(spark) -> None:  # noqa: ANN001
    d = "/root/testdata/sf0.01"
    pieces = QUERIES["p1_pieces"](spark, d).toPandas().sort_values(["block_id", "piece_no"])
    texts = {r.block_id: r.text for r in spark.read.parquet(f"{d}/text_blocks.parquet").where(F.length("text") > 8003).select("block_id", "text").distinct().collect()}
    assert set(pieces.block_id) == set(texts)
    for block, p in pieces.groupby("block_id"):
        spans = list(zip(p.char_start, p.char_end, p.text, strict=True))
        assert spans[0][0] == 0 and spans[-1][1] == len(texts[block]) and (p.n_tokens <= 2000).all()
        for (_, b, _), (c, e, t) in zip(spans, spans[1:], strict=False):
            assert c <= b < e and b - c <= 2003 and t == texts[block][c:e]
