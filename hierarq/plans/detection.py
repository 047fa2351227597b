"""Queries of the block, detection, merge and routing operators."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hierarq.common import table
from hierarq.functions import text
from hierarq.operators import blocks, detect, merge, ordered
from hierarq.operators.serve import first_delivery
from hierarq.plans.registry import Registry

R = Registry()
_B = "b AS (SELECT * FROM text_blocks QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY extracted_at) = 1)"
_E = "e AS (SELECT * FROM detected_elements QUALIFY row_number() OVER (PARTITION BY element_id ORDER BY detected_at) = 1)"


def _blocks(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return first_delivery(table(s, d, "text_blocks"), "block_id", "extracted_at", ["block_id", *columns])


def _elements(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return first_delivery(table(s, d, "detected_elements"), "element_id", "detected_at", ["element_id", *columns])


@R.add("s6_parsed_blocks", f"""
    WITH {_B} SELECT block_id, text, coalesce(page_number, 1) AS page_number,
      CASE WHEN block_type = 'CELL' THEN 'TABLE_CELL' ELSE block_type END AS block_type, row_index, col_index
    FROM b WHERE block_type IN ('LINE', 'CELL') AND coalesce(text, '') <> ''""")
def s6_parsed_blocks(s: SparkSession, d: str) -> DataFrame:
    b = _blocks(s, d, "block_type", "text", "page_number", "confidence", "row_index", "col_index")
    raw = b.select(F.col("block_id").cast("string").alias("document_s3_key"), F.array(F.struct(
        F.col("block_type").alias("BlockType"), F.col("text").alias("Text"), F.col("page_number").alias("Page"),
        (F.col("confidence") * 100).alias("Confidence"), (F.col("row_index") + 1).alias("RowIndex"),
        (F.col("col_index") + 1).alias("ColumnIndex"))).alias("blocks"))
    got = blocks.parsed(raw)
    return got.select(F.col("document_s3_key").cast("long").alias("block_id"), "text", "page_number", "block_type", "row_index",
                      "col_index")


@R.add("o1_reading_order", f"""
    WITH {_B} SELECT block_id, document_s3_key, row_number() OVER (PARTITION BY document_s3_key ORDER BY page_number,
      coalesce(geometry.bounding_box.top, 0.0), coalesce(geometry.bounding_box.left, 0.0), pos, block_id) AS place FROM b""")
def o1_reading_order(s: SparkSession, d: str) -> DataFrame:
    b = _blocks(s, d, "document_s3_key", "page_number", "geometry", "pos")
    return ordered.numbered(b, ["document_s3_key"], blocks.reading_order(b)).select("block_id", "document_s3_key", "place")


@R.add("a4_token_sums", f"""
    WITH {_B} SELECT document_s3_key, sum(length(coalesce(text, '')) // 4)::BIGINT AS tokens, max(page_number) AS pages FROM b
    GROUP BY document_s3_key""")
def a4_token_sums(s: SparkSession, d: str) -> DataFrame:
    """A3 A4."""
    return _blocks(s, d, "document_s3_key", "page_number", "text").groupBy("document_s3_key").agg(F.sum(text.tokens_of(F.col("text"))).alias("tokens"),
                                                        F.max("page_number").alias("pages"))


_W1 = f"""
    {_B}, r AS (SELECT document_s3_key AS doc, pos AS ord, block_id, length(coalesce(text, '')) // 4 AS tok, row_number() OVER w - 1 AS n,
      coalesce(sum(length(coalesce(text, '')) // 4) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM b WHERE document_s3_key IS NOT NULL WINDOW w AS (PARTITION BY document_s3_key ORDER BY pos, block_id)),
    f AS (SELECT i.doc, i.n, i.before, i.tok, min(s.n) AS low, min(s.before) AS start FROM r i JOIN r s ON s.doc = i.doc AND s.n <= i.n
      AND s.before BETWEEN i.before - 500 AND i.before GROUP BY ALL),
    nx AS (SELECT f.doc, f.n, f.low, f.start, (SELECT min(j.n) FROM r j WHERE j.doc = f.doc AND j.n > f.n AND j.before + j.tok - f.start > 2000) AS after FROM f),
    open AS (SELECT doc, min(n) FILTER (WHERE n > 0 AND before + tok > 2000) AS first FROM r GROUP BY doc),
    c AS (SELECT o.doc, 1 AS chunk_id, o.first AS n FROM open o WHERE o.first IS NOT NULL
      UNION ALL SELECT c.doc, c.chunk_id + 1, nx.after FROM c JOIN nx ON nx.doc = c.doc AND nx.n = c.n WHERE nx.after IS NOT NULL),
    k AS (SELECT c.*, nx.low FROM c JOIN nx USING (doc, n)),
    w AS (SELECT r.doc AS document_s3_key, coalesce((SELECT max(chunk_id) FROM c WHERE c.doc = r.doc AND c.n <= r.n), 0)::INT AS chunk_id, ord, block_id,
      tok, false AS seed FROM r
      UNION ALL SELECT r.doc, k.chunk_id::INT, ord, block_id, tok, true FROM k JOIN r ON r.doc = k.doc AND r.n BETWEEN k.low AND k.n - 1)"""


@R.add("w1_greedy_chunks", f"WITH RECURSIVE {_W1} SELECT * FROM w")
def w1_greedy_chunks(s: SparkSession, d: str) -> DataFrame:
    return blocks.greedy_chunks(_blocks(s, d, "document_s3_key", "pos", "text"))


@R.add("w2_manifest", f"""
    WITH RECURSIVE {_W1} SELECT document_s3_key, chunk_id // 5 AS batch_index, count(DISTINCT chunk_id) AS chunk_count, count(*) AS block_count,
      sum(tok)::BIGINT AS tokens FROM w GROUP BY ALL""")
def w2_manifest(s: SparkSession, d: str) -> DataFrame:
    """W2 A24."""
    return blocks.manifest(blocks.greedy_chunks(_blocks(s, d, "document_s3_key", "pos", "text")))


@R.add("w2_fixed_groups", f"""
    WITH {_E}, k AS (SELECT *, row_number() OVER (PARTITION BY document_s3_key ORDER BY code, element_id) AS n FROM e WHERE level = 'domain')
    SELECT document_s3_key, ((n - 1) // 3)::INT AS batch_index, count(*) AS domains FROM k GROUP BY ALL""")
def w2_fixed_groups(s: SparkSession, d: str) -> DataFrame:
    own = _elements(s, d, "document_s3_key", "level", "code").where("level = 'domain'").drop("level")
    k = ordered.numbered(own, ["document_s3_key"], [F.col("code"), F.col("element_id")], "n")
    return k.groupBy("document_s3_key", F.floor((F.col("n") - 1) / 3).cast("int").alias("batch_index")).agg(F.count("*").alias("domains"))


@R.add("w3_strided_sample", f"""
    WITH {_B}, r AS (SELECT document_s3_key, pos, block_id, length(coalesce(text, '')) // 4 AS tok FROM b),
    t AS (SELECT document_s3_key, greatest(1, sum(tok)::BIGINT // 6000) AS stride FROM r GROUP BY ALL),
    n AS (SELECT r.*, stride, row_number() OVER (PARTITION BY document_s3_key ORDER BY pos, block_id) - 1 AS n
          FROM r JOIN t USING (document_s3_key)),
    k AS (SELECT *, coalesce(sum(tok) OVER (PARTITION BY document_s3_key ORDER BY pos, block_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n WHERE n % stride = 0)
    SELECT document_s3_key, pos, block_id, tok::BIGINT AS tok FROM k WHERE before < 6000""")
def w3_strided_sample(s: SparkSession, d: str) -> DataFrame:
    return blocks.strided_sample(_blocks(s, d, "document_s3_key", "pos", "text"))


@R.add("s15_missing_batches", f"""
    WITH {_E} SELECT DISTINCT o.s3_key AS document_s3_key FROM source_documents o WHERE o.s3_key IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM e WHERE e.document_s3_key = o.s3_key AND e.batch_index = 1)""")
def s15_missing_batches(s: SparkSession, d: str) -> DataFrame:
    expected = table(s, d, "source_documents").where("s3_key IS NOT NULL").select(F.col("s3_key").alias("document_s3_key")).distinct()
    return blocks.missing_results(expected, _elements(s, d, "document_s3_key", "batch_index").where("batch_index = 1"), ["document_s3_key"])


@R.add("a28_block_types", f"""
    WITH {_B} SELECT block_type, count(*) AS n FROM b GROUP BY block_type""")
def a28_block_types(s: SparkSession, d: str) -> DataFrame:
    return _blocks(s, d, "block_type").groupBy("block_type").agg(F.count("*").alias("n"))


@R.add("a28_first_blocks", f"""
    WITH {_B} SELECT document_s3_key, block_id, block_type, substring(text, 1, 80) AS head, row_number() OVER (
      PARTITION BY document_s3_key ORDER BY pos, block_id) AS place FROM b WHERE page_number = 1 AND document_s3_key IS NOT NULL QUALIFY place <= 5""")
def a28_first_blocks(s: SparkSession, d: str) -> DataFrame:
    """The first five blocks of page 1 of every document (the report's own limit)."""
    b = _blocks(s, d, "document_s3_key", "page_number", "pos", "block_type", "text").where("page_number = 1 AND document_s3_key IS NOT NULL")
    rows = b.select("document_s3_key", "pos", "block_id", "block_type", F.substring("text", 1, 80).alias("head"))
    return ordered.numbered(rows, ["document_s3_key"], [F.col("pos"), F.col("block_id")]).where("place <= 5").drop("pos")


# The shapes as another engine writes them, independent of the operator: W is a word sign, S white space.
_W, _S = r"[\p{L}\p{M}\p{N}_]", r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
_SHAPES = [
    (r"^(?:PK[0-9]+[.])?[A-Z0-9]{1,5}[.][A-Za-z0-9]{1,5}[.][A-Za-z0-9]{1,5}(?:S|[.)])", "indicator", "0.75"),
    (r"^(?:PK[0-9]+[.])?[A-Z0-9]{1,5}[.][A-Za-z]{1,5}(?:S|[.)])", "sub_strand", "0.65"),
    (r"^[A-Z][.]S+[A-Z][a-z]", "strand", "0.70"),
    (r"^(?:Domain|Area|DOMAIN|AREA)S*(?:[0-9]+|[IVX]+)?S*[:—-]?S*W", "domain", "0.80"),
    (r"^[IVX]{1,4}[.]S+[A-Z][a-z]", "domain", "0.70"),
    (r"^(?:Strand|STRAND|Standard|STANDARD)S*(?:[0-9]+|[A-Z])?S*[:—-]?S*W", "strand", "0.75"),
    (r"^(?:Sub-?Strand|SUB-?STRAND|Topic|TOPIC|Concept|CONCEPT)S*(?:[0-9]+|[A-Z])?S*[:—-]?S*W", "sub_strand", "0.70"),
    (r"^(?:Indicator|INDICATOR|Foundation|FOUNDATION|Benchmark|BENCHMARK|Objective|OBJECTIVE)S*(?:[0-9]+|[A-Z])?S*[:—-]?S*W", "indicator", "0.70"),
]


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_S}+|{_S}+$', '', 'g')"


def _shape(p: str) -> str:
    """``S`` and ``W`` that stand for a class are those before a quantifier, a bar or the end."""
    return re.sub(r"(?<![A-Za-z-])S(?=[*+|])", lambda _: _S, re.sub(r"(?<=[*])W$", lambda _: _W, p))


def _sql_case(at: int) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(t, '{_shape(r[0])}', 'm') THEN {r[at] if at == 2 else repr(r[at])}" for r in _SHAPES) + " END"


_CODE_SQL = f"^(?:PK[0-9]+[.])?([A-Z0-9]{{1,5}}(?:[.][A-Za-z0-9]{{1,5}})*)(?:{_S}|[.):-])"
_KEYWORD_SQL = (f"^(?:Domain|Strand|Sub-?Strand|Standard|Indicator|Foundation|Benchmark|Objective|Topic|Concept|Area){_S}*"
                f"(?:[0-9]+|[IVX]+|[A-Z])?{_S}*[:—-]?{_S}*")
_F7 = f"""
    {_B}, t AS (SELECT block_id, document_s3_key, page_number, {_strip("coalesce(text, '')")} AS t FROM b),
    r AS (SELECT *, {_sql_case(1)} AS level, {_sql_case(2)}::DOUBLE AS base,
      nullif(regexp_extract(t, '{_CODE_SQL}', 1), '') AS found, {_strip("split_part(t, chr(10), 1)")} AS line FROM t WHERE length(t) >= 3),
    u AS (SELECT *, {_strip(f"CASE WHEN regexp_matches(line, '{_CODE_SQL}') THEN regexp_replace(line, '{_CODE_SQL}', '') ELSE regexp_replace(line, '{_KEYWORD_SQL}', '', 'i') END")} AS cut
      FROM r WHERE level IS NOT NULL),
    v AS (SELECT *, substring(coalesce(nullif(regexp_replace(cut, '^[ :—.-]+|[ :—.-]+$', '', 'g'), ''), line), 1, 200) AS title,
      array_to_string(list_filter(list_transform(string_split(t, chr(10))[2:], lambda x: {_strip('x')}), lambda x: x <> ''), ' ') AS description,
      round(least(1.0, base + CASE WHEN length(t) < 100 THEN 0.05 ELSE 0 END + CASE WHEN found IS NOT NULL THEN 0.05 ELSE 0 END), 4)::DOUBLE AS confidence FROM u)"""


@R.add("f7_detected", f"""
    WITH {_F7} SELECT block_id, level, coalesce(found, replace(upper(substring(title, 1, 5)), ' ', '')) AS code, title, description, confidence,
      confidence < 0.7 AS needs_review, page_number AS source_page, substring(t, 1, 500) AS source_text FROM v""")
def f7_detected(s: SparkSession, d: str) -> DataFrame:
    """The rule-based detector over all blocks, with its whole output."""
    return detect.detected(_blocks(s, d, "text", "page_number"), page="page_number").select(
        "block_id", "level", "code", "title", "description", "confidence", "needs_review", "source_page", "source_text")


@R.add("f7_results", f"""
    WITH {_F7}, n AS (SELECT document_s3_key, count(*) AS elements, count(*) FILTER (WHERE confidence < 0.7) AS review_count FROM v GROUP BY ALL)
    SELECT DISTINCT b.document_s3_key, coalesce(elements, 0) AS elements, coalesce(review_count, 0) AS review_count, 'success' AS status
    FROM b LEFT JOIN n USING (document_s3_key) WHERE b.document_s3_key IS NOT NULL""")
def f7_results(s: SparkSession, d: str) -> DataFrame:
    """Elements and review counts per document."""
    return detect.detection_results(_blocks(s, d, "document_s3_key", "text"))


@R.add("p1_p5_answers", f"""
    WITH {_E} SELECT element_id, level, code, title, greatest(0.0, least(1.0, confidence)) AS confidence,
      greatest(0.0, least(1.0, confidence)) < 0.7 AS needs_review,
      CASE WHEN regexp_matches(age_band, '[^ ]') THEN age_band END AS age_band
    FROM e WHERE level IN ('domain', 'strand', 'sub_strand', 'indicator') AND code IS NOT NULL AND title IS NOT NULL
    AND description IS NOT NULL AND confidence IS NOT NULL AND source_page IS NOT NULL AND source_text IS NOT NULL""")
def p1_p5_answers(s: SparkSession, d: str) -> DataFrame:
    """Elements written as a fenced model answer each, parsed and filtered."""
    fields = ["level", "code", "title", "description", "confidence", "source_page", "source_text", "age_band"]
    e = _elements(s, d, *fields)
    answers = e.select("element_id", F.concat(F.lit("```json\nHere: "), F.to_json(F.array(F.struct(*fields))),
                                              F.lit("\n```")).alias("answer"))
    answers = answers.withColumn("answer", F.regexp_replace("answer", "Here: ", ""))
    return detect.parsed_answers(answers).select("element_id", "level", "code", "title", "confidence", "needs_review", "age_band")


@R.add("a1_levels", f"WITH {_E} SELECT level, count(*) AS n FROM e GROUP BY level")
def a1_levels(s: SparkSession, d: str) -> DataFrame:
    return _elements(s, d, "level").groupBy("level").agg(F.count("*").alias("n"))


@R.add("a2_review_counts", f"""
    WITH {_E} SELECT document_s3_key, count(*) FILTER (WHERE confidence < 0.5) AS low, count(*) FILTER (WHERE needs_review) AS flagged,
      count(*) FILTER (WHERE NOT needs_review) AS kept FROM e GROUP BY ALL""")
def a2_review_counts(s: SparkSession, d: str) -> DataFrame:
    """A2 P4 P6."""
    return _elements(s, d, "document_s3_key", "confidence", "needs_review").groupBy("document_s3_key").agg(
        F.count_if(F.col("confidence") < detect.REVIEW_COUNT).alias("low"), F.count_if("needs_review").alias("flagged"),
        F.count_if(~F.col("needs_review")).alias("kept"))


@R.add("a7_merged", f"""
    WITH {_E} SELECT document_s3_key, code, title, source_page, element_id, level FROM e
    QUALIFY row_number() OVER (PARTITION BY document_s3_key, code, title, source_page ORDER BY batch_index, element_id) = 1""")
def a7_merged(s: SparkSession, d: str) -> DataFrame:
    """Of each key in the batches the first wins."""
    e = _elements(s, d, "document_s3_key", "code", "title", "source_page", "level", "batch_index")
    return merge.first_wins(e, ["document_s3_key", "code", "title", "source_page"], ["batch_index", "element_id"]).drop("batch_index")


@R.add("a7_most_confident", f"""
    WITH {_E} SELECT document_s3_key, code, element_id, confidence FROM e
    QUALIFY row_number() OVER (PARTITION BY document_s3_key, code ORDER BY coalesce(confidence, -1.0) DESC, element_id) = 1""")
def a7_most_confident(s: SparkSession, d: str) -> DataFrame:
    e = _elements(s, d, "document_s3_key", "code", "confidence")
    return merge.first_wins(e, ["document_s3_key", "code"], ["element_id"], keep="max_confidence")


@R.add("a8_domain_dedup", f"""
    WITH {_E} SELECT document_s3_key, level, code, min(element_id) AS element_id FROM e GROUP BY ALL""")
def a8_domain_dedup(s: SparkSession, d: str) -> DataFrame:
    e = _elements(s, d, "document_s3_key", "level", "code")
    return merge.first_wins(e, ["document_s3_key", "level", "code"], ["element_id"])


@R.add("a9_longest_description", f"""
    WITH {_E} SELECT document_s3_key, code, element_id, description FROM e WHERE level = 'domain'
    QUALIFY row_number() OVER (PARTITION BY document_s3_key, code ORDER BY length(coalesce(description, '')) DESC, element_id) = 1""")
def a9_longest_description(s: SparkSession, d: str) -> DataFrame:
    e = _elements(s, d, "document_s3_key", "level", "code", "description").where("level = 'domain'").drop("level")
    return merge.longest_description(e, ["document_s3_key", "code"], "element_id")


@R.add("a10_code_frequency", f"""
    WITH {_E} SELECT level, lower(trim(title)) AS name, code, count(*) AS n FROM e WHERE code IS NOT NULL AND title IS NOT NULL GROUP BY ALL""")
def a10_code_frequency(s: SparkSession, d: str) -> DataFrame:
    return _elements(s, d, "level", "code", "title").where("code IS NOT NULL AND title IS NOT NULL").groupBy(
        "level", F.lower(F.trim("title")).alias("name"), "code").agg(F.count("*").alias("n"))


@R.add("a11_canonical_codes", f"""
    WITH {_E}, c AS (SELECT document_s3_key, level, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS name_key, code, count(*) AS n
      FROM e WHERE code IS NOT NULL AND title IS NOT NULL GROUP BY ALL)
    SELECT document_s3_key, level, name_key, code AS canonical FROM c QUALIFY row_number() OVER (
      PARTITION BY document_s3_key, level, name_key ORDER BY length(code) > 10 OR regexp_matches(code, '[a-z][A-Z]'), n DESC, length(code), code) = 1""")
def a11_canonical_codes(s: SparkSession, d: str) -> DataFrame:
    return merge.canonical_codes(_elements(s, d, "document_s3_key", "level", "code", "title"), ["document_s3_key", "level"])


@R.add("a12_recoded_ids", f"""
    WITH {_E}, x AS (SELECT element_id, document_s3_key, level, code, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS k FROM e),
    c AS (SELECT level, k, code, count(*) AS n FROM x WHERE code IS NOT NULL AND k IS NOT NULL GROUP BY ALL),
    b AS (SELECT level, k, code AS canonical FROM c QUALIFY row_number() OVER (PARTITION BY level, k
      ORDER BY length(code) > 10 OR regexp_matches(code, '[a-z][A-Z]'), n DESC, length(code), code) = 1)
    SELECT x.element_id, coalesce(b.canonical, x.code) AS canonical_code FROM x LEFT JOIN b USING (level, k)""")
def a12_recoded_ids(s: SparkSession, d: str) -> DataFrame:
    """Codes made canonical by level and name."""
    return merge.with_canonical_codes(_elements(s, d, "level", "code", "title"), ["level"]).select("element_id", "canonical_code")


@R.add("a22_batch_status", f"""
    WITH {_E} SELECT document_s3_key, batch_index, count(*) FILTER (WHERE title IS NULL OR source_text IS NULL) AS errors, count(*) AS n,
      CASE WHEN count(*) FILTER (WHERE title IS NULL OR source_text IS NULL) > 0 AND count(source_text) > 0 THEN 'partial'
           WHEN count(*) FILTER (WHERE title IS NULL OR source_text IS NULL) > 0 THEN 'error' ELSE 'success' END AS status
    FROM e GROUP BY ALL""")
def a22_batch_status(s: SparkSession, d: str) -> DataFrame:
    g = _elements(s, d, "document_s3_key", "batch_index", "title", "source_text").groupBy("document_s3_key", "batch_index").agg(
        F.count_if(F.col("title").isNull() | F.col("source_text").isNull()).alias("errors"), F.count("*").alias("n"),
        F.count("source_text").alias("good"))
    return g.select("document_s3_key", "batch_index", "errors", "n", merge.status_of(F.col("errors"), F.col("good")).alias("status"))


@R.add("a23_error_text", f"""
    WITH {_E}, n AS (SELECT document_s3_key, code, element_id, (row_number() OVER (PARTITION BY document_s3_key ORDER BY element_id) - 1) // 100 AS part
      FROM e WHERE source_text IS NULL AND code IS NOT NULL)
    SELECT document_s3_key, part, string_agg(code, '; ' ORDER BY element_id) AS codes FROM n GROUP BY ALL""")
def a23_error_text(s: SparkSession, d: str) -> DataFrame:
    """The errors of a document in one text, a part per hundred, so that no document's errors
    are collected into one row."""
    bad = _elements(s, d, "document_s3_key", "code", "source_text").where("source_text IS NULL AND code IS NOT NULL")
    return ordered.joined_parts(bad, ["document_s3_key"], [F.col("element_id")], F.col("code"), "; ", "codes")


@R.add("j12_routed", f"""
    WITH {_E}, dom AS (SELECT DISTINCT document_s3_key, code FROM e WHERE level = 'domain'),
    x AS (SELECT element_id, document_s3_key, regexp_replace(code, '^PK\\d+\\.', '') AS c FROM e WHERE level <> 'domain')
    SELECT x.element_id, arg_max(d.code, length(d.code)) AS routed FROM x LEFT JOIN dom d ON d.document_s3_key = x.document_s3_key
      AND (x.c = d.code OR starts_with(x.c, d.code || '.') OR starts_with(x.c, d.code || '-') OR starts_with(x.c, d.code || '_'))
    GROUP BY x.element_id""")
def j12_routed(s: SparkSession, d: str) -> DataFrame:
    e = _elements(s, d, "document_s3_key", "level", "code")
    return merge.route_by_prefix(e.where("level <> 'domain'"), e.where("level = 'domain'"), ["document_s3_key"]).select(
        "element_id", "routed")


@R.add("w4_filled_domain", f"""
    WITH {_E}, x AS (SELECT element_id, document_s3_key, source_page, CASE WHEN level = 'domain' THEN code END AS own FROM e)
    SELECT element_id, coalesce(last_value(own IGNORE NULLS) OVER w,
      first_value(own IGNORE NULLS) OVER (PARTITION BY document_s3_key ORDER BY source_page NULLS FIRST, element_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS current_domain
    FROM x WINDOW w AS (PARTITION BY document_s3_key ORDER BY source_page NULLS FIRST, element_id ROWS UNBOUNDED PRECEDING)""")
def w4_filled_domain(s: SparkSession, d: str) -> DataFrame:
    e = _elements(s, d, "document_s3_key", "level", "code", "source_page")
    return merge.filled_domain(e, ["document_s3_key"], ["source_page", "element_id"]).select("element_id", "current_domain")


@R.add("f2_prompt_lines", f"""
    WITH {_B}, n AS (SELECT *, (row_number() OVER (PARTITION BY document_s3_key, page_number ORDER BY pos, block_id) - 1) // 100 AS part
      FROM b WHERE text IS NOT NULL AND block_type = 'LINE')
    SELECT document_s3_key, page_number, part, string_agg('[Page ' || page_number || '] ' || text, chr(10) ORDER BY pos, block_id) AS prompt
    FROM n GROUP BY ALL""")
def f2_prompt_lines(s: SparkSession, d: str) -> DataFrame:
    """Prompt assembly for a model provider, page by page, a part per hundred lines."""
    b = _blocks(s, d, "document_s3_key", "page_number", "pos", "block_type", "text").where("text IS NOT NULL AND block_type = 'LINE'")
    line = text.page_line(F.col("page_number"), F.col("text"))
    return ordered.joined_parts(b, ["document_s3_key", "page_number"], [F.col("pos"), F.col("block_id")], line, "\n", "prompt")


QUERIES, SQL = R.queries, R.sql
