"""Training-data operators against brute force, libraries, round trips and held-out accuracy."""

from __future__ import annotations

import random
import re
from datetime import datetime
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hierarq.llm import boost, canonical_values, mix, quantiles, scan_repair, split, tokenize, truncation

T = datetime(2024, 1, 1)
SMALL = split.SplitLimits(max_tokens=20, overlap_tokens=5, hard_step=4, fine_gap=12)


# --- problem 1 ---


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=list("ab .,;\n!?中́‍👩"), max_size=600))
def test_split_invariants(text: str) -> None:
    spans = split.split_points(text, SMALL)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(b - a <= SMALL.max_chars for a, b in spans)
    for (a, b), (c, d) in zip(spans, spans[1:], strict=False):
        assert b - SMALL.overlap_chars <= c <= b < d and a <= c
    if len(text) <= SMALL.max_chars:
        assert len(spans) == 1


def test_split_prefers_paragraphs() -> None:
    text = "\n\n".join(["Some words in a row. Here is more of it."] * 40)
    spans = split.split_points(text, split.SplitLimits(max_tokens=80, overlap_tokens=20))
    assert len(spans) > 3 and all(text[:b].endswith("\n\n") for _, b in spans[:-1])


def _blocks(spark, rows):  # noqa: ANN001, ANN202
    return spark.createDataFrame(rows, "block_id long, page_number int, text string, extracted_at timestamp_ntz, piece_no string")


def test_pieces_edges(spark) -> None:  # noqa: ANN001
    long = "Word after word. " * 1000
    rows = [(1, 1, long, T, "x"), (1, 1, long, datetime(2024, 1, 2), "x"), (2, None, None, T, "x"), (3, 1, "", T, "x"), (4, 1, "a" * 8003, T, "x"),
            (5, 1, "a" * 8004, T, "x"), (None, 1, long, T, "x"), (6, None, "中" * 9000, None, "x")]
    got = split.pieces(_blocks(spark, rows)).toPandas()
    assert got.groupby("block_id").n_pieces.first().to_dict() == {1: 3, 2: 1, 3: 1, 4: 1, 5: 2, 6: 2}
    assert set(split.pieces(_blocks(spark, rows), oversized_only=True).toPandas().block_id) == {1, 5, 6}
    assert (got.n_tokens <= 2000).all()
    assert split.pieces(_blocks(spark, [])).count() == 0


# --- problem 2 ---

B = "block_id long, document_s3_key string, pos long, text string, page_number int, block_type string, doc string"
E = "element_id long, document_s3_key string, source_page int, source_text string, kind string"


def _scan(spark):  # noqa: ANN001, ANN202
    sound = "Children explore familiar materials during the morning while families provide learning support at home in a small group."
    rows = [(i, "d", i, f"{sound} It was day {i} of the year.", i, "LAYOUT_TEXT", "x") for i in range(30)]
    lines = [(100, 1, "Green Hills Early Learning Council"), (101, 1, "Children explore famil-"), (102, 1, "iar materials. Three-"), (103, 1, "and four-year groups explore."),
             (104, 1, "7"), (105, 2, "Green Hills Early Learning Council | 8"), (106, 2, "Children exp1ore the m0rning with farnilies."), (107, 2, "Section A2.1: Small Group"),
             (108, 2, "Children support learn­"), (109, 2, "- 8 -"), (110, 3, "Green Hills Early Learning Council"), (111, 3, "ing at home.")]
    rows += [(i, "e", i, t, p, "LINE", "x") for i, p, t in lines]
    rows += [(200, "e", 200, "12", 3, "CELL", "x"), (201, "e", 201, None, 3, "LINE", "x"), (202, "e", 202, "", 3, "LINE", "x"), (101, "e", 101, "Children explore famil-", 1, "LINE", "x")]
    # Documents that teach the models: pages with a header, a printed number, sentences over lines, headings.
    n = 1000
    for k, (doc, head) in enumerate((("f", "Blue River Learning Standards"), ("g", "Stone Valley Office of Early Years"), ("h", "Low Field Agency for Families"))):
        for p in range(1, 21):
            shape = ("{}", "- {} -", "Page {}")[k]
            page = [head, f"Children of {20 + p} to", f"{30 + p * 7 % 19} months.", f"Goal {'ABC'[k]}{p * 7 % 13}.{p * 5 % 11}: Small Group", f"In week {p} two- and three- and four-year groups explore", "familiar materials during the morning",
                    "with learning support at home.", shape.format(p + 4)]
            for t in page:
                rows.append((n, doc, n, t, p, "LINE", "x"))
                n += 1
    elements = [(1, "e", 1, "AB.1 Title. Children explore\nGreen Hills Early Learning Council\nmaterials for ages 3-\n4 in the room PK3.\nPage 3", "x"), (2, "e", None, None, "x"),
                (3, "zz", 1, "Plain text of children at home.", "x")]
    return spark.createDataFrame(rows, B), spark.createDataFrame(elements, E)


def test_noise_found(spark) -> None:  # noqa: ANN001
    got = {tuple(r) for r in scan_repair.noise(*_scan(spark)).collect()}
    blocks = {(i, n) for t, i, n in got if t == "text_blocks" and i < 1000}
    assert blocks == {(100, "header"), (105, "header"), (105, "page_number"), (110, "header"), (101, "hyphen"), (108, "hyphen"), (104, "page_number"),
                      (109, "page_number"), (106, "misread")}
    assert {(i, n) for t, i, n in got if t == "detected_elements"} == {(1, "header"), (1, "page_number")}
    taught = [n for t, i, n in got if t == "text_blocks" and i >= 1000]
    assert taught.count("header") == 60 and taught.count("page_number") == 60 and len(taught) == 120


def test_candidates_within_the_edits_are_not_lost(spark) -> None:  # noqa: ANN001
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 11))) for _ in range(150)]
    near = words[:60] + [w[:i] + rng.choice("abcdefgh") + w[i + 1 :] for w in words for i in (rng.randrange(len(w)),)] + [w[1:] for w in words] + [w[:2] + w[4:] for w in words]
    a, b = (spark.createDataFrame([(w,) for w in set(x)], "skel string") for x in (near, words))

    def edits(n: int) -> int:
        return max([e for least, e in scan_repair.SKELETON_EDITS.items() if n >= least], default=0)

    want = {(x, y) for x in set(near) for y in set(words) if canonical_values.levenshtein(x, y) <= edits(min(len(x), len(y)))}
    got = {tuple(r) for r in scan_repair.candidate_pairs(a, b).collect()}
    assert got <= want and len(got & want) >= 0.99 * len(want)  # words whose grams repeat may lack a gram
    assert len(want) > 300


def test_blocks_without_a_page_stand_alone(spark) -> None:  # noqa: ANN001
    blocks = spark.createDataFrame([(i, "d", i, f"Plain words number {w}.", None, "LINE", "x") for i, w in enumerate(("one", "two", "three"))], B)
    got = scan_repair.paragraphs(blocks, _scan(spark)[1].limit(0)).collect()
    assert sorted((r.row_id, r.text) for r in got) == [(0, "Plain words number one."), (1, "Plain words number two."), (2, "Plain words number three.")]


def test_paragraphs(spark) -> None:  # noqa: ANN001
    rows = scan_repair.paragraphs(*_scan(spark)).where("document = 'e' AND page <= 2").orderBy("table_name", "page", "paragraph_no").collect()
    text = " | ".join(r.text for r in rows)
    assert "Children explore familiar materials. Three- and four-year groups explore." in text
    assert "Children explore the morning with families." in text
    assert "Council" not in text and "Section A2.1: Small Group" in text and "ages 3-4" in text.replace("3- 4", "3-4")


def test_headers_that_read_like_prose(spark) -> None:  # noqa: ANN001
    blocks, elements = _scan(spark)
    heads = [f"Guidance on {a} learning and {b} growth of {c} children" for a, b, c in (
        ("early", "healthy", "young"), ("outdoor", "language", "small"), ("musical", "social", "little"), ("playful", "physical", "older"))]
    more = [(9000 + 100 * k + p, f"p{k}", p, head, p, "LINE", "x") for k, head in enumerate(heads) for p in range(1, 31)]
    got = scan_repair.noise(blocks.unionByName(spark.createDataFrame(more, B)), elements)
    assert got.where("row_id >= 9000 AND noise = 'header'").count() == len(more)


def test_trees_are_taught_by_all_rows(spark) -> None:  # noqa: ANN001
    # 60,000 rows of which few are distinct; a shape that stands in 24 of them decides alone.
    rows = spark.range(60_000).select(
        (F.col("id") % 2500 == 7).alias("y"), F.array((F.col("id") % 7), (F.col("id") % 2500 == 7).cast("long") * 3, F.col("id") % 11).cast("array<float>").alias("x"))
    whole = rows.toPandas()
    want = boost.BoostedTrees().fit(np.array(whole.x.tolist()), whole.y.to_numpy(dtype=float))
    asked = np.array([[a, b, c] for a in range(7) for b in (0, 3) for c in range(11)], dtype=float)
    assert np.allclose(scan_repair._taught(rows, "y", "x").predict(asked), want.predict(asked), atol=1e-9)
    weighted = rows.groupBy("y", "x").agg(F.count("*").alias("times"))
    assert np.allclose(scan_repair._taught(weighted, "y", "x", weight="times").predict(asked), want.predict(asked), atol=1e-9)


class _Task:
    """Takes the function that tasks run from a plan, and runs it on texts."""

    def select(self, *_) -> _Task:  # noqa: ANN002
        return self

    groupBy = agg = select  # noqa: N815

    def mapInArrow(self, run, schema) -> _Task:  # noqa: ANN001, N802
        self.run = run
        return self

    def rows(self, names: str, *batches: list[tuple]) -> list[tuple]:
        made = (pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*b, strict=True)], names=names.split()) for b in batches)
        return [r for b in self.run(made) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]


def test_words_are_looked_at_once_per_task(spark, monkeypatch) -> None:  # noqa: ANN001
    class Scans:
        def __init__(self, pattern: re.Pattern) -> None:
            self.pattern, self.signs = pattern, 0

        def findall(self, text: str) -> list[str]:
            self.signs += len(text)
            return self.pattern.findall(text)

        def search(self, text: str) -> re.Match | None:
            self.signs += len(text)
            return self.pattern.search(text)

    scans = Scans(scan_repair.TOKEN)
    monkeypatch.setattr(scan_repair, "TOKEN", scans)
    sound = "Children explore familiar materials, and families\u2003provide\x1clearning support."
    texts = [sound] * 300 + [f"{sound} F\u00e9 m0rning{i}\ngarden-\ning exp1ore" for i in range(4)]
    words = [*sound.lower().replace(",", "").replace(".", "").split(), "f\u00e9", "gardening", "exp1ore"]
    counted = _Task()
    scan_repair.word_counts(counted)
    rows = counted.rows("text", [(t,) for t in texts[:150]], [(t,) for t in texts[150:]])
    assert {w: n for k, w, n in rows if k == "word"} == {w: 304 if w in sound.lower() else 4 for w in words if len(w) > 2} | {f"m0rning{i}": 1 for i in range(4)}
    signs = _Task()
    scan_repair.line_signs(signs, frozenset(words) - {"exp1ore"})
    blocks = [("text_blocks", i, "d", "LAYOUT_TEXT", 1, i, t) for i, t in enumerate(texts)]
    rows = signs.rows("table_name row_id doc kind page pos text", blocks[:150], blocks[150:])
    assert sorted((r[1], r[7]) for r in rows if r[6] == "word") == sorted((300 + i, w) for i in range(4) for w in ("exp1ore", f"m0rning{i}"))
    assert [(r[1], re.split("[\x1d\x1f]", r[7])[:3]) for r in rows if r[6] == "pair"] == [(300 + i, ["garden", "-", "ing"]) for i in range(4)]
    assert scans.signs < 0.05 * sum(map(len, texts))


def test_keys_and_scores_without_rows_in_python(spark) -> None:  # noqa: ANN001
    for line in ("Ages 30\u201347  \u00a7 5!", "\u00c9arn rtnn mwvd @q9 Cu2|t", "", "\u0130l\u1e9e"):
        want = line_key_by_table(line)
        assert scan_repair.line_key(line) == want
    rows = spark.range(500).select("id", F.array(F.col("id") % 7, F.col("id") % 3).cast("array<float>").alias("x"))
    whole = rows.toPandas()
    x = np.array(whole.x.tolist(), dtype=float)
    model = boost.BoostedTrees().fit(x, (x[:, 0] > 3) & (x[:, 1] > 0))
    scored = scan_repair._scored(rows, model, "x")
    assert "MapInArrow" in scored._jdf.queryExecution().toString()
    got = scored.orderBy("id").toPandas()
    assert got.columns.tolist() == ["id", "x", "score"] and np.allclose(got.score, model.predict(x))
    assert scan_repair._scored(rows.where("id < 0"), model, "x").count() == 0


def line_key_by_table(line: str) -> str:
    t = " ".join(line.lower().split())
    for a, b in scan_repair._PARTS:
        t = t.replace(a, b)
    return t.translate(str.maketrans(scan_repair._SAME, scan_repair._AS))


def test_noise_of_empty_tables(spark) -> None:  # noqa: ANN001
    a, b = _scan(spark)
    assert scan_repair.noise(a.limit(0), b.limit(0)).count() == 0
    assert scan_repair.paragraphs(a.limit(0), b.limit(0)).count() == 0


def test_ranker_on_held_out_words() -> None:
    words = ("children explore familiar materials during morning families provide learning support small group language classroom building "
             "movement community number similar attention describe practise musical between together gradually confidence").split()
    model = scan_repair.fit_ranker([(w, 500) for w in words[:18]])
    held = words[18:]
    bad = [scan_repair.pair_features(w.replace(x, y, 1), 3, w, 500) for w in held for x, y in (("e", "€"), ("i", "1"), ("m", "rn")) if x in w]
    sound = [scan_repair.pair_features(v, 40, w, 500) for w in held for v in (w + "s", "re" + w, w[1:])]
    assert (model.predict(np.array(bad)) >= 0.5).mean() >= 0.9
    assert (model.predict(np.array(sound)) < 0.5).mean() >= 0.9


def test_boosting_learns_a_rule() -> None:
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = boost.BoostedTrees().fit(x[:1000], y[:1000])
    assert ((m.predict(x[1000:]) > 0.5) == y[1000:]).mean() > 0.95
    assert boost.BoostedTrees().fit(np.zeros((0, 2)), np.zeros(0)).predict(np.zeros((2, 2))).shape == (2,)


# --- problem 4 ---


@pytest.mark.parametrize("shape", ["lognormal", "peaks", "ties", "sorted"])
def test_rank_error_and_merging(shape: str) -> None:
    rng = np.random.default_rng(1)
    x = {"lognormal": rng.lognormal(5, 2, 200_000), "peaks": np.concatenate([rng.normal(10, 1, 100_000), rng.normal(90, 5, 100_000)]),
         "ties": rng.integers(0, 9, 200_000).astype(float), "sorted": np.arange(200_000.0)}[shape]
    merged = quantiles.RankSketch()
    for part in np.array_split(x, 23):
        merged.merge(quantiles.RankSketch.from_bytes(quantiles.RankSketch().update(part).to_bytes()))
    ordered = np.sort(x)
    for sketch in (merged, quantiles.RankSketch().update(x)):
        assert sum(len(lv.buffer) << i for i, lv in enumerate(sketch.levels)) == len(x)
        for q in (0.01, 0.5, 0.9, 0.99, 0.999):
            v, want = sketch.quantile(q), int(np.ceil(q * len(x)))
            low, high = np.searchsorted(ordered, v, "left") + 1, np.searchsorted(ordered, v, "right")
            off = 0 if low <= want <= high else min(abs(low - want), abs(high - want))
            assert off <= quantiles.rank_error() * (1 - q) * len(x) + 1


CALLS = "call_id long, stage string, model_id string, called_at timestamp_ntz, ingested_at timestamp_ntz, latency_ms double, n string"


def test_percentiles_edges(spark) -> None:  # noqa: ANN001
    bad = [None, float("nan"), -1.0, float("inf")]
    rows = [(i, "s", "m", T, T, v, "x") for i, v in enumerate(bad)] + [(10, "s", "m", T, T, 5.0, "x"), (10, "s", "m", T, datetime(2025, 1, 1), 5.0, "x"),
                                                                      (11, None, None, T, T, 7.0, "x"), (12, "s", "m", datetime(2024, 2, 1), T, 9.0, "x"),
                                                                      (None, "s", "m", T, T, 6.0, "x"), (None, "s", "m", T, T, 6.0, "x"), (13, "only bad", "m", T, T, -3.0, "x")]
    got = {(r.stage, r.grain, r.period): (r.n, r.p50, r.p99) for r in quantiles.latency_percentiles(spark.createDataFrame(rows, CALLS)).collect()}
    assert got[("s", "all", "all")] == (4, 6.0, 9.0) and got[("s", "day", "2024-01-01")] == (3, 6.0, 6.0) and got[("s", "month", "2024-02")] == (1, 9.0, 9.0)
    assert got[(None, "all", "all")] == (1, 7.0, 7.0) and not any(k[0] == "only bad" for k in got)
    assert quantiles.latency_percentiles(spark.createDataFrame([], CALLS)).count() == 0


# --- problem 7 ---


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("abc", max_size=6), max_size=25), st.text("abc", max_size=6), st.integers(0, 3))
def test_bk_tree_finds_all_within(words, query, limit) -> None:  # noqa: ANN001
    tree = canonical_values.BKTree([(w, i) for i, w in enumerate(words)])
    want = {(canonical_values.levenshtein(query, w), i) for i, w in enumerate(words) if canonical_values.levenshtein(query, w) <= limit}
    assert {(d, i) for d, i, _ in tree.within(query, limit)} == want


@pytest.mark.parametrize(("typed", "band"), [
    ("Later Preschool (4 to 5 Years)", 6), ("  laetr preschool. ", 6), ("48–60 mos", 6), ("4 y/o to 5 y/o", 6), ("four to five years", 6), ("48 a 60 meses", 6),
    ("4 years—60 months", 6), ("P.K.3", 7), ("pre kindergarten three", 7), ("Pre-K 4", 8), ("By 36 Mnoths", 10), ("a los 48 meses", 11), ("by age five", 12),
    ("3 ½ a 4 1/2 años", 13), ("three and a half to four and a half years", 13), ("Birth to Three", 16), ("newborn–36 months", 16), ("thre to five", 17),
    ("Early Preschool - 3 a 4 años", 5), ("2½ - 5yr olds", 18), ("3 to 4 months", 0), ("36-48 hours", 0), ("School Age (9 to 12 Years)", 0), ("By 18 Months", 0),
    ("quince a treinta meses", 0), ("dieciocho a treinta meses", 3), ("cuarenta y ocho a sesenta meses", 6), ("thirty-six to forty eight months", 5),
    ("eigteen to thirty months", 3), ("from 36 to 48 months", 5), ("từ 36 đến 48 tháng", 5), ("năm đến sáu tuổi", 9), ("3 năm đến 5 năm tuổi", 17), ("trước 48 tháng", 11),
    ("hai mươi bốn tháng", 0), ("三岁至四岁", 5), ("四岁半至五岁半", 14), ("三十六至四十八个月", 5), ("出生至八个月", 1), ("48个月之前", 11),
    ("PK5", 0), ("all ages", 0), ("Grade 3", 0), ("??", 0), ("x" * 5000, 0), ("Later Preschool (3 to 4 Years)", 0),
])
def test_bands(typed: str, band: int) -> None:
    rows = pd.read_parquet("/root/testdata/sf0.001/age_bands.parquet")
    tree = canonical_values.BKTree(canonical_values.band_forms([tuple(r) for r in rows.itertuples(index=False)]))
    assert canonical_values.match_band(typed, tree)[0] == band


def test_bands_rows_and_shards(spark, monkeypatch) -> None:  # noqa: ANN001
    rows = spark.createDataFrame([("t", 1, "pk 3", "x"), ("t", 1, "pk 3", "x"), ("t", 2, None, "x"), ("t", 3, "  ", "x"), ("t", 4, "none", "x")],
                                 "table_name string, row_id long, age_band string, band_id string")
    bands = spark.read.parquet("/root/testdata/sf0.001/age_bands.parquet")
    want = {(1, 7), (4, 0)}
    assert {(r.row_id, r.band_id) for r in canonical_values.map_to_bands(rows, bands).collect()} == want
    assert {r.band_id for r in canonical_values.map_to_bands(rows, bands.limit(0)).collect()} == {0}
    assert canonical_values.map_to_bands(rows.limit(0), bands).count() == 0
    # The result is the same however the list is cut.
    typed = spark.read.parquet("/root/testdata/sf0.01/detected_elements.parquet").select(
        F.lit("t").alias("table_name"), F.col("element_id").alias("row_id"), "age_band").union(rows.select("table_name", -F.col("row_id"), "age_band"))
    whole = {(r.row_id, r.band_id, r.distance) for r in canonical_values.map_to_bands(typed, bands).collect()}
    for size in (5, 10, 20):
        monkeypatch.setattr(canonical_values, "MAX_BROADCAST", size)
        monkeypatch.setattr(canonical_values, "SHARD_FORMS", size)
        assert {(r.row_id, r.band_id, r.distance) for r in canonical_values.map_to_bands(typed, bands).collect()} == whole
    assert {r.band_id for r in canonical_values.map_to_bands(rows.limit(0), bands).collect()} == set()


# --- problem 8 ---


def test_ids_equal_the_library(spark) -> None:  # noqa: ANN001
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokenize.VOCABULARY_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    rng = random.Random(0)
    texts = ["", None, " ", "\n\n \t", "a" * 3000, "<|endoftext|> x", "I'm we'LL they'd", "中文" * 200, "👩‍👩‍👧‍👦﻿", "\x00\x01", "word " * 500]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x500), rng.randrange(0x4E00, 0x9000), 32, 10])) for _ in range(80)) for _ in range(60)]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: r.ids for r in tokenize.encode_corpus(df).collect()}
    assert got == {i: t.encode(x, add_special_tokens=False).ids if x else [] for i, x in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in tokenize.count_tokens(df, ["doc_id"]).collect()} == {i: len(x) for i, x in got.items()}
    assert tokenize.encode_corpus(df.limit(0)).count() == 0


def test_word_memory_is_bounded() -> None:
    enc = tokenize.BlockEncoder(f"{tokenize.VOCABULARY_DIR}/byte_bpe_50k.json", max_words=2)
    first = [x.tolist() for x in enc.encode(["one two three"])]
    assert [x.tolist() for x in enc.encode(["one two three"])] == first


# --- problem 9 ---


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=6), st.integers(1, 300))
def test_pfair_lag(weights, n) -> None:  # noqa: ANN001
    total = sum(weights)
    w = {f"s{i}": Fraction(x, total) for i, x in enumerate(weights)}
    placed = mix.pfair(w, {s: int(n * x) + 1 for s, x in w.items()})
    have = dict.fromkeys(w, 0)
    for slot, (s, j) in enumerate(placed[: n], 1):
        have[s] += 1
        assert j == have[s]
        assert all(abs(have[k] - slot * w[k]) < 1 for k in w if have[k] <= int(n * w[k]))


def test_schedule_repeats_and_long_periods(spark, monkeypatch) -> None:  # noqa: ANN001
    docs = spark.createDataFrame([(i, "word " * 300, "abc"[i % 3]) for i in range(900)], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 9), ("b", 0.3, 9), ("c", 0.2, 9)], "source string, target_share double, max_repeats int")

    def lag(out: pd.DataFrame) -> float:
        slots = out.drop_duplicates(["source", "block_no"]).sort_values("slot")
        assert slots.slot.is_unique
        have, worst = dict.fromkeys("abc", 0), 0.0
        for r in slots.itertuples():
            have[r.source] += 1
            worst = max(worst, *(abs(have[s] - (r.slot + 1) * w) for s, w in (("a", 0.5), ("b", 0.3), ("c", 0.2))))
        return worst

    out = mix.mixture(docs, targets).toPandas()
    assert out.slot.max() > 30 and lag(out) < 1 and out.position.is_unique
    monkeypatch.setattr(mix, "MAX_PERIOD", 5)
    other = mix.mixture(docs, targets).toPandas()
    assert len(other) == len(out) and lag(other) < 3 and other.position.is_unique


def test_long_periods_keep_the_lag(spark) -> None:  # noqa: ANN001
    docs = spark.createDataFrame([(i, "word " * 300, "abcd"[i % 4]) for i in range(900)], "doc_id long, text string, source string")
    shares = {"a": 0.700001, "b": 0.1, "c": 0.1, "d": 0.099999}  # a period of 1,000,000 slots
    out = mix.mixture(docs, spark.createDataFrame([(s, x, 9) for s, x in shares.items()], "source string, target_share double, max_repeats int")).toPandas()
    slots = out.drop_duplicates(["source", "block_no"]).sort_values("slot")
    assert slots.slot.is_unique and out.position.is_unique and slots.slot.max() > 100
    have = dict.fromkeys(shares, 0)
    for r in slots.itertuples():
        have[r.source] += 1
        assert all(abs(have[s] - (r.slot + 1) * w) < 1 for s, w in shares.items())


@pytest.mark.parametrize("many", [3, 12_000])
def test_slots_are_in_their_windows(spark, many) -> None:  # noqa: ANN001
    quotas = spark.range(many).select(F.format_string("s%d", "id").alias("source"), F.when(F.col("id") % 2 == 0, 0.3).otherwise(0.1).cast("decimal(20,10)").alias("target"),
                                      (F.when(F.col("id") % 2 == 0, 15).otherwise(5) * mix.BLOCK).cast("long").alias("quota"))
    blocks = quotas.select("source", "target", F.explode(F.sequence(F.lit(1).cast("long"), (F.col("quota") / mix.BLOCK).cast("long"))).alias("block_no"))
    got = mix._slots(quotas.select("source", "target", F.col("target").cast("double").alias("share"), "quota"), blocks).toPandas()
    whole = quotas.agg(F.sum("target")).first()[0]
    assert len(got) == got.slot.nunique() == blocks.count()
    for b, t, slot in zip(got.block_no, got.target, got.slot, strict=True):
        assert (b - 1) * whole // t <= slot < -(-b * whole // t)


def test_mixture_shares_and_caps(spark) -> None:  # noqa: ANN001
    docs = spark.createDataFrame([(i, "word " * 20, "a" if i < 300 else "b" if i < 400 else "c", "x") for i in range(500)] + [(900, None, "a", "x"), (901, "", "a", "x"), (902, "x", None, "x"), (1, "word " * 20, "a", "x")],
                                 "doc_id long, text string, source string, slot string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2), ("gone", 0.3, 5), ("c", float("nan"), 3), (None, 0.2, 1), ("c", 0.0, 2)], "source string, target_share double, max_repeats int")
    out = mix.mixture(docs, targets).toPandas()
    assert set(out.source) == {"a", "b"} and out.position.is_unique
    used = out.groupby(["source", "doc_id"]).size().groupby("source").max()
    assert used["a"] == 1 and used["b"] == 2
    tokens = out.groupby("source").n_tokens.sum()
    assert abs(tokens["a"] / tokens.sum() - 0.5) < 0.02
    shares = {r.source: r.actual_share for r in mix.actual_shares(docs, targets).collect()}
    assert shares["c"] == 0 and shares["gone"] == 0
    assert mix.mixture(docs.limit(0), targets).count() == 0 and mix.mixture(docs, targets.limit(0)).count() == 0


# --- problem 10 ---

TAIL = "Children explore the garden in the morning. "


@pytest.mark.parametrize(("text", "verdict"), [
    (TAIL, "whole"), (TAIL + "Families expl", "cut"), (TAIL + "“Let us go,", "cut"), (TAIL + "“Let us go.”", "whole"), (TAIL + "It is big (so", "cut"),
    (TAIL + "�", "cut"), (TAIL + "A&am", "cut"), (TAIL + "caf\\u00", "cut"), (TAIL + "go <b", "cut"), (TAIL + "🌱", "whole"), (TAIL + "\n\n* * *", "whole"),
    ("| a | b |\n| c | d |\n| e | f |", "whole"), ("| a | b |\n| c | d |\n| e | f", "cut"), ("| a | b |\n| c | d |\n| e |", "cut"), (TAIL + "See it, e.g.", "cut"), (TAIL + "About 8.", "cut"),
    (TAIL + "Goal D.", "cut"), ("1. Go.\n2. Run.\n3. Ju", "cut"), ("1. Go.\n2. Run.\n3.", "cut"), (TAIL + "\n#play #fun", "whole"), ("<|endoftext|>", "ask"), (TAIL + "\n(end)", "ask"),
    ("每天早晨，孩子们探索，", "cut"), ("每天早晨，孩子们探索。", "whole"), ("aaaa!", "whole"),
    (TAIL + 'She said "let us go.', "cut"), (TAIL + 'She said "let us go."', "whole"), (TAIL + '"Now," they said, "we go."', "whole"), (TAIL + 'It is 5" long.', "whole"),
    (TAIL + "<b>go out.", "cut"), (TAIL + "<b>go out.</b>", "whole"), ("<p>" + TAIL, "whole"), ("<div>" + TAIL + "\n\n" + TAIL, "cut"), (TAIL + "<name> goes out.", "whole"),
    (TAIL + "\n```\nx = (1\n\ny", "cut"), (TAIL + "\n```\nx = (1\n```\nDone.", "whole"), (TAIL + "It was 50%", "cut"), (TAIL + "caf\\u00e9.", "whole"),
])
def test_ends(text: str, verdict: str) -> None:
    assert truncation.judge(text)[0] == verdict


def test_truncated_documents(spark) -> None:  # noqa: ANN001
    whole = [TAIL * 3 + f"\n\n— {p} Early Childhood Council" for p in ("North", "South", "East", "West")] + [TAIL + "\n- red boats\n- blue cars", TAIL + "\n- blue cars\n- red boats"] * 3
    cut = [TAIL + "\n\n— North Early Childh", TAIL + "\n- blue cars\n- red bo", TAIL + "\n- red boats\n- blue"]
    dots = [("Children see the garden and play " * 9)[:97] + "..." for _ in range(8)] + [TAIL + "and so on..."]
    rows = [(i, t, "s", "x") for i, t in enumerate(whole + cut + dots)] + [(100, None, "s", "x"), (101, "  ", "s", "x"), (102, "", None, "x"), (0, whole[0], "s", "x"), (103, "No end", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, cut string")
    n = len(whole)
    assert {r.doc_id for r in truncation.truncated(df).collect()} - {103} == set(range(n, n + 3 + 8))
    assert truncation.truncation_shares(df).where("source = 's'").first().texts == len(rows) - 5
    assert truncation.truncated(df.limit(0)).count() == 0


def test_queries_cover_whole_tables(spark) -> None:  # noqa: ANN001
    from hierarq.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    assert QUERIES["p8_ids"](spark, d).count() == spark.read.parquet(f"{d}/documents.parquet").count()
    assert QUERIES["p10_shares"](spark, d).agg(F.sum("texts")).first()[0] == spark.read.parquet(f"{d}/documents.parquet").where("trim(text) <> ''").count()
