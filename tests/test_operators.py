"""Chunks, snapshots, validation, merging, providers and streams on small literal inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hierarq.common import current_version, salted_join
from hierarq.functions import text
from hierarq.operators import blocks, canonical, detect, evaluate, merge, serve, snapshot
from hierarq.sources import objects, providers


def test_greedy_chunks_of_the_worked_example(spark) -> None:  # noqa: ANN001
    sizes = [900, 700, 600, 300, 250, 1700, 50, 2500, 10, 400]
    df = spark.createDataFrame([("d", i, i, "x" * (4 * n)) for i, n in enumerate(sizes)] + [("e", 0, 99, None)],
                               "document_s3_key string, pos long, block_id long, text string")
    got: dict = {}
    for r in blocks.greedy_chunks(df).collect():
        got.setdefault((r.document_s3_key, r.chunk_id), []).append(r.ord)
    assert {k: sorted(v) for k, v in got.items()} == {("d", 0): [0, 1], ("d", 1): [2, 3, 4], ("d", 2): [4, 5, 6], ("d", 3): [6, 7],
                                                      ("d", 4): [8, 9], ("e", 0): [0]}
    assert blocks.greedy_chunks(df.limit(0)).count() == 0


def test_upsert_keeps_audit_and_takes_the_last_change(spark) -> None:  # noqa: ANN001
    old = spark.createDataFrame([(1, "a", "x", "k", True), (2, None, "y", None, False)], "id long, key string, name string, s3 string, verified boolean")
    new = spark.createDataFrame([("a", "x2", None, 1), ("a", "x3", "k3", 2), (None, "y2", "n", 1), ("c", "z", None, 1)], "key string, name string, s3 string, seq long")
    got = sorted(map(tuple, snapshot.upsert(old, new, ["key"], ["name"], ["s3"], "seq").collect()), key=str)
    assert got == sorted([(1, "a", "x3", "k3", True), (2, None, "y2", "n", False), (None, "c", "z", None, None)], key=str)


def test_verify_restores_nulls(spark) -> None:  # noqa: ANN001
    df = spark.createDataFrame([(1, False, None, None)], "id long, human_verified boolean, verified_at timestamp, verified_by string")
    on = snapshot.verify(df, F.col("id") == 1, True, "me", F.current_timestamp())
    assert on.first().verified_by == "me"
    assert snapshot.verify(on, F.col("id") == 1, False, "me", F.current_timestamp()).collect() == df.collect()


@pytest.mark.parametrize(("payload", "errors"), [
    ("nonsense", {("$", "invalid_type")}), (None, {("$", "invalid_type")}), ("[1]", {("$", "invalid_type")}),
    ("{}", {(n, "missing_field") for n in ("country", "state", "document", "standard", "metadata")}),
    ('{"country":"us","state":"","document":{"title":"t","source_url":"u","age_band":"a","publishing_agency":null,"version_year":"2020"},'
     '"standard":{"standard_id":"i","domain":{"code":"c","name":"n"},"strand":null,"sub_strand":5,"indicator":{"code":"c","name":7}},"metadata":{"page":1}}',
     {("country", "format"), ("state", "invalid_type"), ("document.publishing_agency", "invalid_type"), ("document.version_year", "invalid_type"),
      ("standard.sub_strand", "invalid_type"), ("standard.indicator.name", "invalid_type")}),
])
def test_validation_collects_all_errors(spark, payload, errors) -> None:  # noqa: ANN001
    df = canonical.validated(spark.createDataFrame([(payload,)], "payload string"))
    assert {(e.field_path, e.error_type) for e in df.first().errors} == errors


def test_answers_are_parsed_and_filtered(spark) -> None:  # noqa: ANN001
    good = '{"level":"domain","code":"A","title":"t","description":"d","confidence":1.7,"source_page":1,"source_text":"s","age_band":"  "}'
    odd = '{"level":"chapter","code":"A","title":"t","description":"d","confidence":0.5,"source_page":1,"source_text":"s"}'
    short = '{"level":"domain","code":"A"}'
    df = spark.createDataFrame([(1, f"```json\n[{good},{odd},{short}]\n```"), (2, "no array"), (3, None), (4, f"Sure: [{good}] done")], "id long, answer string")
    rows = detect.parsed_answers(df).orderBy("id").collect()
    assert [(r.id, r.confidence, r.needs_review, r.age_band) for r in rows] == [(1, 1.0, False, None), (4, 1.0, False, None)]


def test_rules_in_order(spark) -> None:  # noqa: ANN001
    df = spark.createDataFrame([("I. Social life",), ("PK3.I.A x",), ("A.1 x",), ("Domain 2: Health",), ("ab",), (None,)], "text string")
    assert {r.text: r.level for r in detect.detected(df).collect()} == {"I. Social life": "strand", "PK3.I.A x": "indicator", "Domain 2: Health": "domain"}


def test_first_wins_with_null_keys_and_ties(spark) -> None:  # noqa: ANN001
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), ("k", 1, "c"), ("k", 1, "c")], "key string, o int, v string")
    assert sorted((r.key or "", r.v) for r in merge.first_wins(df, ["key"], ["o"]).collect()) == [("", "a"), ("k", "c")]


def test_prefix_routing_needs_a_separator(spark) -> None:  # noqa: ANN001
    e = spark.createDataFrame([(1, "d", "AB.1"), (2, "d", "ABC.1"), (3, "d", "PK3.AB.C-1"), (4, "d", None)], "element_id long, doc string, code string")
    d = spark.createDataFrame([("d", "AB"), ("d", "AB.C"), ("other", "ABC")], "doc string, code string")
    assert {r.element_id: r.routed for r in merge.route_by_prefix(e, d, ["doc"]).collect()} == {1: "AB", 2: None, 3: "AB.C", 4: None}


def test_scores_of_nothing(spark) -> None:  # noqa: ANN001
    df = spark.createDataFrame([(0, 0, 0), (1, 0, 1)], "tp long, fp long, fn long").select("*", *evaluate.scores(F.col("tp"), F.col("fp"), F.col("fn")))
    assert [(r.precision, r.recall, r.f1) for r in df.collect()] == [(0.0, 0.0, 0.0), (1.0, 0.5, 0.6667)]


def test_current_version_and_salted_join(spark) -> None:  # noqa: ANN001
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "b", 2), (None, "c", 3)], "id long, v string, loaded_at int")
    assert [tuple(r) for r in current_version(df).collect()] == [(1, "b", 2)]
    rows = spark.range(100).selectExpr("1 AS k", "id")
    assert salted_join(rows, spark.createDataFrame([(1, "x")], "k int, v string"), ["k"], F.col("id")).count() == 100
    assert salted_join(rows, spark.createDataFrame([(2, "x")], "k int, v string"), ["k"], F.col("id"), "left_anti").count() == 100


def test_search_has_no_wildcards(spark) -> None:  # noqa: ANN001
    df = spark.createDataFrame([("50% of",), ("5 of",), (None,)], "t string")
    assert [r.t for r in df.where(serve.contains_text("50%", "t")).collect()] == ["50% of"]
    assert df.where(serve.contains_text("  ", "t")).count() == 3


def test_provider_errors_are_rows(spark) -> None:  # noqa: ANN001
    def odd(x: str) -> str:
        if x == "b":
            raise RuntimeError("no")
        return x * 2

    got = {r.id: (r.answer, r.attempts) for r in providers.call_provider(spark.createDataFrame([(1, "a"), (2, "b")], "id long, t string"), "id", "t", odd).collect()}
    assert got == {1: ("aa", 1), 2: (None, 3)}


def test_raw_files(spark, tmp_path) -> None:  # noqa: ANN001
    for name, body in (("a.pdf", b"x"), ("b.txt", b"x"), ("c.HTML", b"y"), ("d.html", b"")):
        (tmp_path / name).write_bytes(body)
    files = objects.raw_files(spark, str(tmp_path))
    got = objects.ingest(files, {"country": "US", "state": "CA", "version_year": "2020"}, str(tmp_path / "out"))
    assert {r.path.rsplit("/", 1)[1]: r.status for r in got.collect()} == {"a.pdf": "success", "b.txt": "error", "c.HTML": "success"}
    assert objects.read_json(spark, str(tmp_path / "none"), "id long", missing_ok=True).count() == 0


def test_jdbc_table_in_ranges(spark) -> None:  # noqa: ANN001
    url = "jdbc:derby:memory:hierarq;create=true"
    rows = spark.range(40).selectExpr("id", "concat('n', id) AS name")
    rows.write.jdbc(url, "nodes", mode="overwrite", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    got = objects.jdbc_table(spark, url, "SELECT * FROM nodes", key="ID", bounds=(0, 40), partitions=4, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert got.rdd.getNumPartitions() == 4 and got.count() == 40 and got.where("id = 7").first().name == "n7"


def test_text_recognition_and_paged_jobs(spark) -> None:  # noqa: ANN001
    def read(k: int) -> list[dict]:
        if k == 2:
            raise OSError("down")
        return [{"page": p, "text": f"{k}.{p}"} for p in range(1, k + 1)]

    docs = spark.createDataFrame([(0,), (1,), (2,), (3,)], "id int")
    got = sorted((r.id, r.page, r.text, r.error) for r in providers.recognised(docs, "id", read).collect() if r.id != 3)
    assert got == [(0, None, None, "no text found"), (1, 1, "1.1", None), (2, None, None, "OSError: down")]
    assert providers.recognised(docs.where("id = 3"), "id", read).count() == 3


def test_following_rows(spark, monkeypatch) -> None:  # noqa: ANN001
    from pyspark.sql import Window

    from hierarq.operators import ordered

    df = spark.range(300).selectExpr("id", "CASE WHEN id % 7 = 0 THEN 'a' WHEN id % 50 = 1 THEN NULL ELSE 'hot' END AS k", "(id * 37) % 101 AS o")
    w = Window.partitionBy("k").orderBy("o", "id")
    want = {r.id: r.n for r in df.select("id", F.lead("id").over(w).alias("n")).collect()}
    got = {r.id: r.next.id if r.next is not None else None for r in ordered.following(df, ["k"], [F.col("o"), F.col("id")], ["id"]).collect()}
    assert got == want


def test_hot_keys_are_dealt(spark, monkeypatch) -> None:  # noqa: ANN001
    from hierarq import common

    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rows = spark.range(200).selectExpr("CASE WHEN id < 120 THEN 'hot' WHEN id < 125 THEN NULL ELSE concat('k', id) END AS k", "id")
    look = spark.createDataFrame([("hot", 1), ("k130", 2), ("none", 3)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = sorted(map(tuple, salted_join(rows, look, ["k"], F.col("id"), how).collect()), key=str)
        assert got == sorted(map(tuple, rows.join(look, ["k"], how).select(*(["k", "id", "v"] if how in ("inner", "left") else ["k", "id"])).collect()), key=str), how


def test_changed_plans_and_affected_rows(spark) -> None:  # noqa: ANN001
    old = spark.createDataFrame([(1, "u", "CA", "c", None, None, "Kim", "4", "d", None, None)],
                                "plan_id int, user_id string, state string, content string, interests string, concerns string, child_name string, child_age string, duration string, created_at timestamp, updated_at timestamp")
    cols = "plan_id int, op string, user_id string, child_name string, child_age string, state string, duration string, content string, interests string, concerns string, seq int"
    ch = spark.createDataFrame([(1, "update", "u", None, None, None, None, "c2", "i", None, 1), (1, "update", "u", None, None, None, None, "c3", None, None, 2),
                                (2, "create", "u", "Bo", "3", "CA", "d", "x", None, None, 1), (3, "create", "u", "Bo", "3", "CA", "", "x", None, None, 1), (4, "delete", "v", None, None, None, None, None, None, None, 1)], cols)
    new, results = snapshot.plan_changes(old, ch, F.lit("2025-01-01").cast("timestamp"))
    assert sorted((r.plan_id, r.content, r.interests) for r in new.collect()) == [(1, "c3", None), (2, "x", None)]
    assert sorted((r.plan_id, r.action, r.error) for r in results.collect()) == [
        (1, "updated", None), (2, "created", None), (3, None, "duration is required"), (4, None, snapshot.NOT_OWNED)]
    assert tuple(snapshot.affected(old, new, ["plan_id"]).first()) == (1, 1, 0)


def test_standard_ids(spark) -> None:  # noqa: ANN001
    df = spark.createDataFrame([("US", "CA", 2020, "D", "I", ""), ("US", "CA", 2020, "D", "I", "PK3")], "c string, s string, y int, d string, i string, a string")
    got = [r[0] for r in df.select(text.standard_id(*[F.col(c) for c in "csydia"])).collect()]
    assert got == ["US-CA-2020-D-I", "US-CA-2020-D-I-PK3"]


def test_positions_sums_and_fills_over_ranges(spark) -> None:  # noqa: ANN001
    from pyspark.sql import Window

    from hierarq.operators import ordered

    df = spark.range(400).select(F.when(F.col("id") % 5 > 0, F.lit("hot")).when(F.col("id") % 10 == 0, F.lit("b")).alias("k"),
                                 F.expr("hash(id) % 50").alias("o"), "id", F.expr("CASE WHEN id % 17 = 0 THEN id END").alias("v"))
    order = [F.col("o"), F.col("id")]
    w = Window.partitionBy("k").orderBy("o", "id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = {r.id: (r.a, r.b, r.c, r.d, r.e) for r in df.select(
        "id", F.row_number().over(w).alias("a"), F.coalesce(F.sum("id").over(before), F.lit(0)).alias("b"),
        F.coalesce(F.last("v", True).over(w), F.first("v", True).over(whole)).alias("c"), F.lag("id").over(w).alias("d"),
        F.row_number().over(Window.partitionBy("k").orderBy(F.desc("o"), "id")).alias("e")).collect()}
    got = [{r.id: r[-1] for r in x.select("id", n).collect()} for n, x in (
        ("a", ordered.numbered(df, ["k"], order, "a")), ("b", ordered.sum_before(df, ["k"], order, "id", "b")),
        ("c", ordered.filled_forward(df, ["k"], order, "v", "c")), ("d", ordered.previous(df, ["k"], order, "id", "d")),
        ("e", ordered.numbered(df, ["k"], [(F.col("o"), "desc"), F.col("id")], "e")))]
    assert {i: tuple(g[i] for g in got) for i in want} == want
    assert ordered.numbered(df.limit(0), ["k"], order).count() == 0


def _greedy(sizes: list[int], limit: int, overlap: int) -> list[tuple[int, int, bool]]:
    """Chunks one block after the other: (chunk, block, seed)."""
    out, held, total, chunk = [], [], 0, 0
    for i, t in enumerate(sizes):
        if held and total + t > limit:
            seed, size = [], 0
            for x in reversed(held):
                if size + sizes[x] > overlap:
                    break
                seed.insert(0, x)
                size += sizes[x]
            chunk, held, total = chunk + 1, seed, size
            out += [(chunk, x, True) for x in seed]
        held.append(i)
        total += t
        out.append((chunk, i, False))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_greedy_chunks_over_many_ranges(spark, seed) -> None:  # noqa: ANN001
    import random

    rng = random.Random(seed)
    docs = {f"d{k}": [rng.choice([0, 0, 1, 2, 3, 5, 8, 13, 21, 30]) for _ in range(n)] for k, n in enumerate((400, 3, 1, 60))}
    rows = [(d, i, 1000 * int(d[1:]) + i, "x" * (4 * t)) for d, sizes in docs.items() for i, t in enumerate(sizes)]
    df = spark.createDataFrame(rows, "document_s3_key string, pos long, block_id long, text string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = sorted((r.document_s3_key, r.chunk_id, r.ord, r.seed) for r in blocks.greedy_chunks(df, limit=20, overlap=6).collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted((d, *x) for d, sizes in docs.items() for x in _greedy(sizes, 20, 6))


def test_detector_output_in_full(spark) -> None:  # noqa: ANN001
    texts = ["Small group time", "The child plays. Often.", "AB.1: Title here", "PK3.I.A.1 Names letters\n  and sounds \n\nwell", "Domain 2: Health",
             "Sub-Strand: Phonics - ", "1.2.3) x", " \n A. Self concept", "Topic " + "y" * 300, "I.A " + "z" * 700]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r.id: r for r in detect.detected(df).collect()}
    assert set(got) == {3, 4, 5, 6, 7, 8, 9}  # no level for "Small group time", "The child" and "AB.1: Title"
    assert (got[3].level, got[3].code, got[3].title, got[3].description, got[3].confidence) == ("indicator", "I.A.1", "Names letters", "and sounds well", 0.85)
    assert (got[4].level, got[4].code, got[4].title, got[4].confidence, got[4].needs_review) == ("domain", "HEALT", "Health", 0.85, False)
    assert (got[5].level, got[5].title, got[5].code) == ("sub_strand", "Phonics", "PHONI")
    assert got[8].title == "y" * 200  # of more than these: a letter right after a keyword is taken for its number
    assert (got[6].code, got[6].title) == ("1.2.3", "x")
    assert (got[7].level, got[7].code, got[7].title) == ("strand", "A", "Self concept")
    assert len(got[8].title) == 200 and len(got[9].source_text) == 500
    assert (got[9].level, got[9].confidence, got[9].needs_review) == ("sub_strand", 0.7, False)


def test_cases_of_a_registry(spark) -> None:  # noqa: ANN001
    rows = [("s", "indicator", "A.1", "t", "x", "Early 3"), ("s", "indicator", "A.1 ", "t", "x", "Later 4"), ("s", "indicator", "A.2", "Later (4)", "a. x", "Early 3"),
            ("s", "strand", "B", "t", "1. Big: y", None), ("s", "domain", "B", "t", "1. Big: y", None), (None, "indicator", "PK3.1", None, None, "PK3")]
    df = spark.createDataFrame(rows, "set_id string, level string, code string, title string, source_text string, age_band string")
    got = {(r.set_id, r.case_id): (r.status, r.wrong) for r in evaluate.checks(df, ["set_id"]).collect()}
    assert got["s", "ca_age_columns_emitted"] == ("FAIL", 1) and got["s", "ca_age_label_not_in_title"] == ("FAIL", 1)
    assert got["s", "ca_no_lettered_examples_as_indicators"] == ("FAIL", 1) and got["s", "co_numeric_strands"] == ("FAIL", 1)
    assert got["s", "co_no_sub_strand"] == ("PASS", 0) and got["s", "ca_four_level_hierarchy"] == ("FAIL", 1)
    assert got[None, "ca_age_label_not_in_title"] == ("ERROR", None) and got[None, "tx_age_band_set"] == ("PASS", 0)
    assert evaluate.checks(df, ["set_id"], ["NO-SUCH"]).first().status == "SKIP" and evaluate.checks(df.limit(0), ["set_id"]).count() == 0
