"""Queries that do the whole of what they are named for."""

from __future__ import annotations

import numpy as np

from hierarq.operators import serve
from hierarq.plans import sessions


def test_plans_of_all_owners_and_of_one(spark, small) -> None:  # noqa: ANN001
    every = [tuple(r) for r in sessions.QUERIES["plan_activities_all"](spark, small).collect()]
    assert {r[0] % 10 for r in every} > {3}
    owner = next(r[0] for r in every if r[0] % 10 != 3)
    own = [tuple(r) for r in sessions.flattened(sessions._plans(spark, small), owner).collect()]
    assert own and sorted(own) == sorted(r for r in every if r[0] == owner)


def test_top_k_of_many_matches_brute_force(spark, monkeypatch) -> None:  # noqa: ANN001
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(120)]
    rows += [(120, None), (121, [0.0, 0.0, 0.0]), (122, [1.0, 2.0]), (123, [1.0, None, 2.0]), (124, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    sound = {i: np.array(v) for i, v in rows if v and None not in v and any(v)}

    def cosine(a, b):  # noqa: ANN001, ANN202
        return round(float(a @ b / np.sqrt((a @ a) * (b @ b))), 12)

    want = set()
    for q in (i for i in sound if i % 20 in (0, 2)):
        near = sorted((-cosine(sound[q], v), i) for i, v in sound.items() if len(v) == len(sound[q]))[:5]
        want |= {(q, i, round(-c, 9)) for c, i in near}
    asked = df.where("vec_id % 20 IN (0, 2)")
    for block, at_once in ((1_000, 2_000), (2, 7)):
        monkeypatch.setattr(serve, "QUERY_BLOCK", block)
        monkeypatch.setattr(serve, "ROWS_AT_ONCE", at_once)
        got = [(r.query_id, r.vec_id, round(r.similarity, 9)) for r in serve.top_k_cosine_of_many(df, asked, 5).collect()]
        assert len(got) == len(want) and {x[:2] for x in got} == {x[:2] for x in want} and set(got) == want
