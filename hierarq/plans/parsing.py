"""Queries of what becomes of providers' answers: standards, retries, depth maps, batches, stored runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hierarq.common import table
from hierarq.operators import canonical, merge, parse, snapshot
from hierarq.operators.ordered import numbered
from hierarq.operators.serve import first_delivery
from hierarq.plans.registry import Registry
from hierarq.sources import providers

R = Registry()
_FIELDS = ["domain_code", "domain_name", "strand_code", "strand_name", "sub_strand_code", "sub_strand_name", "indicator_code", "indicator_name", "age_band",
           "source_page", "source_text"]
#: Golden indicators as parsed rows; a domain's name is made so that it goes by several codes.
_ROWS = """rows AS (SELECT DISTINCT test_case_id, set_id, country, state, version_year, domain_code, 'Domain ' || (length(domain_code) + ascii(right(domain_code, 1)) % 4) AS domain_name,
      strand_code, CASE WHEN source_page % 3 <> 0 THEN 'Strand ' || strand_code END AS strand_name, sub_strand_code, 'Sub ' || sub_strand_code AS sub_strand_name,
      code AS indicator_code, title AS indicator_name, age_band, source_page, description AS source_text FROM golden_elements WHERE level = 'indicator')"""
_STANDARDS = f"""{_ROWS}, std AS (SELECT test_case_id, set_id, country, state, version_year, domain_code, domain_name, CASE WHEN strand_code <> '' AND strand_name <> '' THEN strand_code END AS strand_code,
      CASE WHEN strand_code <> '' AND strand_name <> '' THEN strand_name END AS strand_name,
      CASE WHEN sub_strand_code <> '' AND sub_strand_name <> '' THEN sub_strand_code END AS sub_strand_code,
      CASE WHEN sub_strand_code <> '' AND sub_strand_name <> '' THEN sub_strand_name END AS sub_strand_name,
      indicator_code, coalesce(nullif(age_band, ''), 'PK') AS age_band, coalesce(source_page, 1) AS source_page FROM rows
      WHERE domain_code IS NOT NULL AND domain_name IS NOT NULL AND indicator_code IS NOT NULL AND indicator_name IS NOT NULL AND coalesce(source_page, 1) > 0),
    ids AS (SELECT *, concat_ws('-', country, state, version_year::VARCHAR, domain_code, indicator_code, age_band) AS standard_id FROM std)"""


def _rows(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "golden_elements").where("level = 'indicator'")
    kind = F.length("domain_code") + F.ascii(F.right("domain_code", F.lit(1))) % 4
    return g.select("test_case_id", "set_id", "country", "state", "version_year", "domain_code", F.concat(F.lit("Domain "), kind.cast("string")).alias("domain_name"),
                    "strand_code", F.when(F.col("source_page") % 3 != 0, F.concat(F.lit("Strand "), "strand_code")).alias("strand_name"), "sub_strand_code",
                    F.concat(F.lit("Sub "), "sub_strand_code").alias("sub_strand_name"), F.col("code").alias("indicator_code"),
                    F.col("title").alias("indicator_name"), "age_band", "source_page", F.col("description").alias("source_text")).distinct()


def _answer() -> Column:
    """One row as a model's answer: fenced, with items beside it that must be skipped."""
    return F.concat(F.lit("```json\nHere: [17, \"stray\", {\"domain_code\": \"X\"}, {\"domain_code\": \"X\", \"domain_name\": 5, \"indicator_code\": \"I\", \"indicator_name\": \"N\"}, "),
                    F.to_json(F.struct(*_FIELDS)), F.lit("]\n```"))


def _standards(s: SparkSession, d: str) -> DataFrame:
    answers = _rows(s, d).select("test_case_id", "set_id", "country", "state", "version_year", F.lit("PK").alias("fallback_age_band"),
                                 F.replace(_answer(), F.lit("Here: "), F.lit("")).alias("answer"))
    return parse.standards_of(answers)


@R.add("p7_f4_standards", f"WITH {_STANDARDS} SELECT test_case_id, standard_id, domain_code, strand_code, sub_strand_code, indicator_code, age_band, source_page FROM ids")
def p7_f4_standards(s: SparkSession, d: str) -> DataFrame:
    """Answers of the hierarchy step as standards; unsound items are skipped."""
    return _standards(s, d).select("test_case_id", "standard_id", "domain_code", "strand_code", "sub_strand_code", "indicator_code", "age_band", "source_page")


def _best(v: str) -> str:
    return f"""{v}_c AS (SELECT set_id, lower(trim({v}_name)) AS k, {v}_code AS c, count(*) AS n FROM std WHERE {v}_code IS NOT NULL AND {v}_name IS NOT NULL GROUP BY ALL),
    {v}_b AS (SELECT set_id, k, c AS best FROM {v}_c QUALIFY row_number() OVER (PARTITION BY set_id, k
      ORDER BY length(c) > 10 OR regexp_matches(c, '[a-z][A-Z]'), n DESC, length(c), c) = 1)"""


@R.add("a12_normalized", f"""
    WITH {_STANDARDS}, {_best('domain')}, {_best('strand')}, {_best('sub_strand')}
    SELECT test_case_id, coalesce(a.best, domain_code) AS domain_code, coalesce(b.best, strand_code) AS strand_code, coalesce(c.best, sub_strand_code) AS sub_strand_code,
      concat_ws('-', country, state, version_year::VARCHAR, coalesce(a.best, domain_code), indicator_code, age_band) AS standard_id
    FROM std LEFT JOIN domain_b a ON a.set_id = std.set_id AND a.k = lower(trim(domain_name)) LEFT JOIN strand_b b ON b.set_id = std.set_id AND b.k = lower(trim(strand_name))
    LEFT JOIN sub_strand_b c ON c.set_id = std.set_id AND c.k = lower(trim(sub_strand_name))""")
def a12_normalized(s: SparkSession, d: str) -> DataFrame:
    """One code per name of a domain, strand and sub-strand in a set, ids made anew."""
    return parse.normalized_standards(_standards(s, d), ["set_id"]).select("test_case_id", "domain_code", "strand_code", "sub_strand_code", "standard_id")


@R.add("f4_batches", f"""
    WITH {_STANDARDS}, ch AS (SELECT DISTINCT set_id, test_case_id, ascii(right(test_case_id, 1)) % 5 AS bad FROM rows),
    b AS (SELECT set_id, count(*) FILTER (WHERE bad >= 3) AS errors FROM ch GROUP BY set_id),
    n AS (SELECT ids.set_id, count(*) AS standards FROM ids JOIN ch USING (test_case_id) WHERE bad < 3 GROUP BY ids.set_id)
    SELECT set_id, set_id || '/result-0.json' AS result_key, coalesce(standards, 0) AS standards, errors,
      CASE WHEN errors = 0 THEN 'success' WHEN coalesce(standards, 0) > 0 THEN 'partial' ELSE 'error' END AS status FROM b LEFT JOIN n USING (set_id)""")
def f4_batches(s: SparkSession, d: str) -> DataFrame:
    """every chunk gets up to four answers, of which the first ones do not parse; three are looked at."""
    bad = F.ascii(F.right("test_case_id", F.lit(1))) % 5
    chunks = _rows(s, d).select("set_id", F.concat("set_id", F.lit("/batch-0.json")).alias("batch_key"), F.col("test_case_id").alias("chunk_index"), "country", "state",
                                "version_year", F.lit("PK").alias("fallback_age_band"), F.explode(F.sequence(F.lit(0), bad)).alias("attempt"), bad.alias("_bad"),
                                F.replace(_answer(), F.lit("Here: "), F.lit("")).alias("_good"))
    answers = chunks.withColumn("answer", F.when(F.col("attempt") < F.col("_bad"), "no array here").otherwise(F.col("_good"))).drop("_bad", "_good")
    return parse.batch_results(answers, ["set_id"])[1]


@R.add("f2_depth_maps", """
    WITH l AS (SELECT DISTINCT set_id, level FROM golden_elements WHERE level IN ('domain', 'strand', 'sub_strand', 'indicator')),
    o AS (SELECT set_id, level, row_number() OVER (PARTITION BY set_id ORDER BY list_position(['domain', 'strand', 'sub_strand', 'indicator'], level)) AS depth FROM l),
    s AS (SELECT set_id, string_agg(level, ' > ' ORDER BY depth) AS levels, count(*) AS depths FROM o GROUP BY set_id)
    SELECT set_id, CASE WHEN ascii(right(set_id, 1)) % 4 <> 0 THEN levels END AS levels, CASE WHEN ascii(right(set_id, 1)) % 4 <> 0 THEN depths::INT END AS depths,
      CASE WHEN ascii(right(set_id, 1)) % 4 <> 0 THEN 'n' END AS notes FROM s""")
def f2_depth_maps(s: SparkSession, d: str) -> DataFrame:
    """depth maps out of answers, of which every fourth holds none."""
    order = F.array(*map(F.lit, parse._LEVELS))
    l = table(s, d, "golden_elements").where(F.col("level").isin(*parse._LEVELS)).groupBy("set_id").agg(F.collect_set("level").alias("have"))
    levels = F.filter(order, lambda x: F.array_contains("have", x))
    depths = F.transform(levels, lambda x, i: F.struct((i + 1).alias("depth"), x.alias("canonical_level")))
    whole = F.concat(F.lit("```\nThe map: "), F.to_json(F.struct(depths.alias("doc_depths"), F.lit("n").alias("notes"))), F.lit("\n```"))
    answers = l.select("set_id", F.when(F.ascii(F.right("set_id", F.lit(1))) % 4 != 0, whole).otherwise('Sorry: {"depths": []}').alias("answer"))
    m = answers.select("set_id", parse.depth_map(F.col("answer")).alias("m"))
    return m.select("set_id", F.array_join("m.doc_depths.canonical_level", " > ").alias("levels"), F.when(F.col("m").isNotNull(), F.size("m.doc_depths")).alias("depths"), "m.notes")


@R.add("f3_parse_retries", """
    SELECT id, CASE WHEN id % 5 < 3 THEN (id % 5 + 1)::INT ELSE 3 END AS attempts, id % 5 < 3 AS parsed,
      CASE WHEN id % 5 >= 3 THEN 'ValueError: no JSON array' END AS error FROM (SELECT DISTINCT id FROM source_documents)""")
def f3_parse_retries(s: SparkSession, d: str) -> DataFrame:
    """A provider whose first answers do not parse; an attempt counts if its answer is accepted."""

    def provider(x: str, attempt: int) -> str:
        return "no array" if attempt < int(x) % 5 else f"[{x}]"

    def accept(answer: str) -> None:
        if not answer.startswith("["):
            raise ValueError("no JSON array")

    docs = table(s, d, "source_documents").select("id", F.col("id").cast("string").alias("x")).distinct()
    got = providers.call_provider(docs, "id", "x", provider, accept=accept, numbered=True)
    return got.select("id", "attempts", F.col("answer").isNotNull().alias("parsed"), "error")


@R.add("p11_passed_through", """
    WITH docs AS (SELECT * FROM source_documents QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1)
    SELECT id, CASE WHEN id % 2 = 0 THEN 'kept' ELSE title END AS title, CASE WHEN id % 2 = 0 THEN NULL ELSE 'PK' END AS age_band FROM docs WHERE title IS NOT NULL""")
def p11_passed_through(s: SparkSession, d: str) -> DataFrame:
    """Records that are canonical already stay as they are, flat ones are nested."""
    docs = first_delivery(table(s, d, "source_documents"), "id", "loaded_at", ["id", "country", "state", "title", "version_year"]).where("title IS NOT NULL")
    flat = ("country string, state string, title string, version_year int, source_url string, age_band string, document_age_band string, publishing_agency string, "
            "standard_id string, domain_code string, domain_name string, strand_code string, strand_name string, sub_strand_code string, sub_strand_name string, "
            "indicator_code string, indicator_name string, indicator_description string, source_page int, source_text string")
    payload = F.when(F.col("id") % 2 == 0, '{"document": {"title": "kept"}, "standard": {}, "metadata": {"x": 1}}').otherwise(
        F.to_json(F.struct("country", "state", "title", "version_year")))
    got = canonical.passed_through(docs.select("id", payload.alias("payload")), flat)
    return got.select("id", F.get_json_object("payload", "$.document.title").alias("title"), F.get_json_object("payload", "$.document.age_band").alias("age_band"))


_STORED = """c AS (SELECT record_id, arg_min(payload, received_at) AS payload, arg_min(s3_key, received_at) AS run_id FROM canonical_records GROUP BY record_id),
    x AS (SELECT record_id, coalesce(run_id, 'none') AS run_id, payload IS NOT NULL AND json_valid(payload) AND json_type(CASE WHEN json_valid(payload) THEN payload END) = 'OBJECT' AS good FROM c)"""


def _tried(s: SparkSession, d: str) -> DataFrame:
    records = first_delivery(table(s, d, "canonical_records"), "record_id", "received_at", ["record_id", "payload", "s3_key"])
    return canonical.validated(records).withColumn("_at", F.filter("errors", lambda e: e["field_path"] == "$"))


@R.add("m7_store_errors", f"WITH {_STORED} SELECT record_id, 'record must be an object' AS error FROM x WHERE NOT coalesce(good, false)")
def m7_store_errors(s: SparkSession, d: str) -> DataFrame:
    """M7: records that cannot be stored are told apart, the others go on."""
    return snapshot.persisted(_tried(s, d), "record_id", F.try_element_at("_at", F.lit(1))["message"])[1]


@R.add("m6_recorded_runs", f"""
    WITH {_STORED}, n AS (SELECT run_id, count(*) AS total, count(*) FILTER (WHERE good) AS stored FROM x GROUP BY run_id)
    SELECT run_id, CASE WHEN run_id IN (SELECT run_id FROM x WHERE record_id % 2 = 0) THEN 'XX' ELSE 'US' END AS country, CASE WHEN stored < total THEN 'partial' ELSE 'completed' END AS status, total AS total_indicators, stored AS total_validated,
      '2025-01-01' AS completed_on FROM n UNION ALL SELECT 'old-run', 'XX', 'running', 0, 0, NULL""")
def m6_recorded_runs(s: SparkSession, d: str) -> DataFrame:
    """M6: runs are recorded with status, totals and time of completion; known ones anew."""
    good, bad = snapshot.persisted(_tried(s, d), "record_id", F.try_element_at("_at", F.lit(1))["message"])
    run = F.coalesce("s3_key", F.lit("none")).alias("run_id")
    every = good.select(run, F.lit(1).alias("ok")).unionByName(
        bad.join(_tried(s, d).select("record_id", "s3_key"), "record_id").select(run, F.lit(0).alias("ok")))
    n = every.groupBy("run_id").agg(F.count("*").alias("total"), F.sum("ok").alias("stored"), F.count_if(F.col("ok") == 0).alias("failed"))
    outcomes = n.select("run_id", F.lit("US").alias("country"), F.lit("CA").alias("state"), F.lit(2020).alias("version_year"), "total", "stored", "failed")
    known = _tried(s, d).where("record_id % 2 = 0").select(run).distinct().unionByName(s.range(1).select(F.lit("old-run").alias("run_id")))
    zero = F.lit(0).cast("long")
    runs = known.select("run_id", F.lit("XX").alias("country"), F.lit("CA").alias("state"), F.lit(2020).alias("version_year"), F.lit("running").alias("status"),
                        zero.alias("total_indicators"), zero.alias("total_validated"), F.lit(None).cast("timestamp_ntz").alias("completed_at"))
    got = snapshot.recorded_runs(runs, outcomes, F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    return got.select("run_id", "country", "status", "total_indicators", "total_validated", F.date_format("completed_at", "yyyy-MM-dd").alias("completed_on"))


@R.add("m5_recommendations", """
    SELECT p_partkey AS recommendation_id, p_type AS audience, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS activity_description,
      CASE WHEN p_partkey % 3 = 0 THEN 'new' ELSE p_brand END AS generation_model FROM part
    UNION ALL SELECT 100000000 + p_partkey, 'ALL', upper(p_name), 'new' FROM part WHERE p_partkey % 3 = 0""")
def m5_recommendations(s: SparkSession, d: str) -> DataFrame:
    """M5: of a known recommendation two columns are set anew, the rest stays; unknown ones are added."""
    old = table(s, d, "part").select(F.col("p_partkey").alias("recommendation_id"), F.col("p_type").alias("audience"),
                                     F.col("p_name").alias("activity_description"), F.col("p_brand").alias("generation_model"))
    ch = old.where("recommendation_id % 3 = 0").select("recommendation_id", F.upper("activity_description").alias("activity_description"),
                                                       F.lit("new").alias("generation_model"))
    fresh = ch.withColumn("recommendation_id", F.col("recommendation_id") + 100_000_000)
    got = snapshot.upsert(old, ch.unionByName(fresh), ["recommendation_id"], ["activity_description", "generation_model"])
    return got.select("recommendation_id", F.coalesce("audience", F.lit("ALL")).alias("audience"), "activity_description", "generation_model")


@R.add("u1_concatenated", """
    WITH e AS (SELECT * FROM detected_elements QUALIFY row_number() OVER (PARTITION BY element_id ORDER BY detected_at) = 1),
    a AS (SELECT document_s3_key, batch_index, 0 AS seq, element_id FROM e WHERE needs_review UNION ALL SELECT document_s3_key, batch_index, 1, element_id FROM e)
    SELECT document_s3_key, element_id, row_number() OVER (PARTITION BY document_s3_key ORDER BY batch_index, seq, element_id) AS place FROM a""")
def u1_concatenated(s: SparkSession, d: str) -> DataFrame:
    """Outputs of batches put together in the manifest's order, repeated rows kept."""
    e = first_delivery(table(s, d, "detected_elements"), "element_id", "detected_at", ["element_id", "document_s3_key", "batch_index", "needs_review"])
    outputs = [e.where("needs_review").drop("needs_review"), e.drop("needs_review")]
    return merge.concatenated(outputs, ["document_s3_key"], "batch_index", "element_id").select("document_s3_key", "element_id", "place")


@R.add("o7_by_standard_id", f"""
    WITH {_STANDARDS} SELECT test_case_id, standard_id, row_number() OVER (ORDER BY standard_id, test_case_id) AS place FROM ids WHERE country = 'US' AND state = 'TX'""")
def o7_by_standard_id(s: SparkSession, d: str) -> DataFrame:
    """The standards of a country and state in the order of their ids."""
    own = _standards(s, d).where("country = 'US' AND state = 'TX'").select("country", "test_case_id", "standard_id")
    return numbered(own, ["country"], [F.col("standard_id"), F.col("test_case_id")]).select("test_case_id", "standard_id", "place")


QUERIES, SQL = R.queries, R.sql
