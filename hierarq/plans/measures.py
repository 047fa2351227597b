"""Queries of the evaluation and metrics operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hierarq.common import table
from hierarq.operators import evaluate, metrics
from hierarq.operators.ordered import previous
from hierarq.operators.serve import first_delivery
from hierarq.plans.registry import Registry

R = Registry()
_G = """g AS (SELECT DISTINCT test_case_id AS id, test_case_id AS seq, set_id, state, level, code, title, source_page, age_band,
      domain_code, strand_code, sub_strand_code FROM golden_elements),
    p AS (SELECT * EXCLUDE (level, code), CASE WHEN source_page % 7 = 0 THEN 'strand' ELSE level END AS level,
      CASE WHEN source_page % 5 = 0 THEN code || 'X' ELSE code END AS code FROM g WHERE coalesce(source_page, 1) % 4 <> 0),
    k AS (SELECT *, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) || '|' || coalesce(source_page::VARCHAR, '') AS k1,
      concat_ws('|', level, code) AS k2 FROM g),
    q AS (SELECT *, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) || '|' || coalesce(source_page::VARCHAR, '') AS k1,
      concat_ws('|', level, code) AS k2 FROM p),
    a AS (SELECT set_id, k1, max(seq) AS g_id FROM k GROUP BY ALL), b AS (SELECT set_id, k2, max(seq) AS g_id FROM k GROUP BY ALL),
    m AS (SELECT q.*, coalesce(a.g_id, b.g_id) AS g_id FROM q LEFT JOIN a USING (set_id, k1) LEFT JOIN b USING (set_id, k2))"""
_M = """c AS (SELECT * FROM llm_call_metrics QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY ingested_at) = 1),
    x AS (SELECT *, coalesce(input_tokens, 0) / 1000 * coalesce(pi, 0) + coalesce(output_tokens, 0) / 1000 * coalesce(po, 0) AS cost_usd,
      CASE WHEN NOT isnan(latency_ms) AND latency_ms >= 0 THEN latency_ms END AS ms
      FROM c LEFT JOIN (VALUES ('large', 0.005::DOUBLE, 0.025::DOUBLE), ('medium', 0.003, 0.015)) t(kind, pi, po)
      ON t.kind = regexp_extract(c.model_id, 'large|medium'))"""


def _golden(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "golden_elements").select(F.col("test_case_id").alias("id"), F.col("test_case_id").alias("seq"), "set_id", "state",
                                                 "level", "code", "title", "source_page", "age_band", "domain_code", "strand_code",
                                                 "sub_strand_code").distinct()


def _predicted(s: SparkSession, d: str) -> DataFrame:
    """A stand-in for a detector's output: golden rows, some lost, some with another level or code."""
    g = _golden(s, d).where(F.coalesce("source_page", F.lit(1)) % 4 != 0)
    page = F.coalesce("source_page", F.lit(1))
    return g.withColumn("level", F.when(page % 7 == 0, "strand").otherwise(F.col("level"))).withColumn(
        "code", F.when(page % 5 == 0, F.concat("code", F.lit("X"))).otherwise(F.col("code")))


def _once(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return metrics.once(table(s, d, "llm_call_metrics"), [*columns])


def _calls(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return metrics.priced(_once(s, d, "model_id", "input_tokens", "output_tokens", *columns))


@R.add("j14_detection_scores", f"""
    WITH {_G}, t AS (SELECT set_id, count(g_id) AS tp, count(*) FILTER (WHERE g_id IS NULL) AS fp FROM m GROUP BY ALL),
    f AS (SELECT set_id, count(*) AS fn FROM g WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.set_id = g.set_id AND m.g_id = g.id) GROUP BY ALL),
    r AS (SELECT set_id, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn FROM t FULL JOIN f USING (set_id)),
    s AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r FROM r)
    SELECT set_id, tp, fp, fn, round(p, 4)::DOUBLE AS precision, round(r, 4)::DOUBLE AS recall,
      round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 4)::DOUBLE AS f1 FROM s""")
def j14_detection_scores(s: SparkSession, d: str) -> DataFrame:
    """J14 A19."""
    return evaluate.detection_scores(_golden(s, d), _predicted(s, d), ["set_id"])


_REPORT = """
    h AS (SELECT m.set_id, m.level AS p_level, coalesce(m.level = g.level, false) AS l, coalesce(trim(m.code) = trim(g.code), false) AS c FROM m JOIN g ON g.id = m.g_id AND g.set_id = m.set_id),
    z AS (SELECT set_id, 'element_detection' AS dimension, 'tp' AS kind FROM h UNION ALL SELECT set_id, 'level_classification', CASE WHEN l THEN 'tp' ELSE 'fp' END FROM h
      UNION ALL SELECT set_id, 'code_extraction', CASE WHEN c THEN 'tp' ELSE 'fp' END FROM h UNION ALL SELECT set_id, 'level_' || p_level, 'tp' FROM h WHERE l
      UNION ALL SELECT set_id, 'element_detection', 'fp' FROM m WHERE g_id IS NULL
      UNION ALL SELECT set_id, unnest(['element_detection', 'level_classification', 'code_extraction', 'level_' || coalesce(level, 'unknown')]), 'fn' FROM lost),
    n AS (SELECT set_id, dimension, count(*) FILTER (WHERE kind = 'tp') AS tp, count(*) FILTER (WHERE kind = 'fp') AS fp, count(*) FILTER (WHERE kind = 'fn') AS fn FROM z GROUP BY ALL),
    s AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r FROM n)
    SELECT set_id, dimension, tp, fp, fn, round(p, 4)::DOUBLE AS precision, round(r, 4)::DOUBLE AS recall, round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 4)::DOUBLE AS f1 FROM s"""


@R.add("j14_report_strict", f"""
    WITH {_G}, lost AS (SELECT set_id, level FROM g WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.set_id = g.set_id AND m.g_id = g.id)), {_REPORT}""")
def j14_report_strict(s: SparkSession, d: str) -> DataFrame:
    """All dimensions, per level too; a golden row is missed once."""
    return evaluate.detection_report(_golden(s, d), _predicted(s, d), ["set_id"])


@R.add("j14_report_by_keys", f"""
    WITH {_G}, every AS (SELECT set_id, k, arg_max(level, (o, seq)) AS level FROM (SELECT set_id, k1 AS k, 1 AS o, seq, level FROM k UNION ALL SELECT set_id, k2, 0, seq, level FROM k) GROUP BY ALL),
    used AS (SELECT DISTINCT q.set_id, CASE WHEN a.g_id IS NOT NULL THEN k1 ELSE k2 END AS k FROM q LEFT JOIN a USING (set_id, k1)),
    lost AS (SELECT set_id, level FROM every ANTI JOIN used USING (set_id, k)), {_REPORT}""")
def j14_report_by_keys(s: SparkSession, d: str) -> DataFrame:
    """The same with what is missed counted by keys."""
    return evaluate.detection_report(_golden(s, d), _predicted(s, d), ["set_id"], strict=False)


@R.add("a19_confusion", f"""
    WITH {_G} SELECT coalesce(g.level, 'none') AS golden_level, m.level AS predicted_level, count(*) AS n
    FROM m LEFT JOIN g ON g.id = m.g_id AND g.set_id = m.set_id GROUP BY ALL""")
def a19_confusion(s: SparkSession, d: str) -> DataFrame:
    return evaluate.confusion(_golden(s, d), _predicted(s, d), ["set_id"])


@R.add("u4_missed_and_extra", f"""
    WITH {_G} SELECT 'extra' AS side, id FROM m WHERE g_id IS NULL
    UNION ALL SELECT 'missed', id FROM g WHERE id NOT IN (SELECT g_id FROM m WHERE g_id IS NOT NULL)""")
def u4_missed_and_extra(s: SparkSession, d: str) -> DataFrame:
    """Set differences in both directions."""
    g, p = _golden(s, d), _predicted(s, d)
    m = evaluate.match(g, p, ["set_id"])
    missed = g.join(m.where("g_id IS NOT NULL").select(F.col("g_id").alias("id")).distinct(), "id", "left_anti")
    return m.where("g_id IS NULL").select(F.lit("extra").alias("side"), F.col("p_id").alias("id")).unionByName(
        missed.select(F.lit("missed").alias("side"), "id"))


@R.add("j13_graded", f"""
    WITH {_G}, gg AS (SELECT *, coalesce(nullif(age_band, ''), '-') AS band, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS t FROM g
      WHERE level IS NOT NULL AND title IS NOT NULL),
    pp AS (SELECT *, coalesce(nullif(age_band, ''), '-') AS band, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS t FROM p),
    h AS (SELECT gg.set_id, gg.level, EXISTS (SELECT 1 FROM pp WHERE pp.set_id = gg.set_id AND pp.level = gg.level AND pp.band = gg.band
      AND pp.code = gg.code) OR EXISTS (SELECT 1 FROM pp WHERE pp.set_id = gg.set_id AND pp.level = gg.level AND pp.band = gg.band AND pp.t = gg.t) AS hit FROM gg)
    SELECT set_id, level, count(*) FILTER (WHERE hit) AS found, count(*) FILTER (WHERE NOT hit) AS missed FROM h GROUP BY ALL""")
def j13_graded(s: SparkSession, d: str) -> DataFrame:
    return evaluate.grade(_golden(s, d), _predicted(s, d), ["set_id"])


@R.add("j15_hierarchy_agreement", f"""
    WITH {_G}, x AS (SELECT set_id, id AS code, concat_ws('|', coalesce(domain_code, ''), coalesce(strand_code, ''), coalesce(sub_strand_code, '')) AS c FROM g
      WHERE level = 'indicator'),
    y AS (SELECT set_id, id AS code, concat_ws('|', coalesce(domain_code, ''), coalesce(CASE WHEN coalesce(source_page, 1) % 3 = 0 THEN NULL
      ELSE strand_code END, ''), coalesce(sub_strand_code, '')) AS c FROM g WHERE level = 'indicator' AND coalesce(source_page, 1) % 4 <> 0)
    SELECT set_id, count(*) FILTER (WHERE x.c = y.c) AS tp, count(*) FILTER (WHERE y.c IS NOT NULL AND (x.c IS NULL OR x.c <> y.c)) AS fp,
      count(*) FILTER (WHERE y.c IS NULL) AS fn FROM x FULL JOIN y USING (set_id, code) GROUP BY ALL""")
def j15_hierarchy_agreement(s: SparkSession, d: str) -> DataFrame:
    g = _golden(s, d).where("level = 'indicator'").withColumn("code", F.col("id"))
    page = F.coalesce("source_page", F.lit(1))
    p = g.where(page % 4 != 0).withColumn("strand_code", F.when(page % 3 != 0, F.col("strand_code")))
    return evaluate.hierarchy_agreement(g, p, ["set_id"])


@R.add("j18_a21_stability", f"""
    WITH {_G}, r AS (SELECT set_id, 1 AS run, level, code, title FROM g UNION ALL SELECT set_id, 2, level, code, title FROM p),
    z AS (SELECT set_id, run, count(*) AS n FROM r GROUP BY ALL), zs AS (SELECT set_id, round(stddev_pop(n), 6) AS size_stddev FROM z GROUP BY ALL),
    l AS (SELECT set_id, code, title, min(level) AS a, max(level) AS b FROM r GROUP BY ALL HAVING count(DISTINCT run) > 1),
    ls AS (SELECT set_id, round(avg((a <> b)::INT), 6) AS disagreement FROM l GROUP BY ALL)
    SELECT set_id, size_stddev, coalesce(disagreement, 0) AS disagreement FROM zs LEFT JOIN ls USING (set_id)""")
def j18_a21_stability(s: SparkSession, d: str) -> DataFrame:
    cols = ["set_id", "level", "code", "title"]
    runs = _golden(s, d).select(*cols, F.lit(1).alias("run")).unionByName(_predicted(s, d).select(*cols, F.lit(2).alias("run")))
    return evaluate.stability(runs, ["set_id"])


@R.add("a27_detector_delta", f"""
    WITH {_G}, one AS (SELECT level, count(*) AS first FROM g GROUP BY ALL), two AS (SELECT level, count(*) AS second FROM p GROUP BY ALL)
    SELECT level, coalesce(first, 0) AS first, coalesce(second, 0) AS second, coalesce(second, 0) - coalesce(first, 0) AS delta FROM one FULL JOIN two USING (level)""")
def a27_detector_delta(s: SparkSession, d: str) -> DataFrame:
    a = _golden(s, d).groupBy("level").agg(F.count("*").alias("first"))
    b = _predicted(s, d).groupBy("level").agg(F.count("*").alias("second"))
    f, n = (F.coalesce(c, F.lit(0)) for c in ("first", "second"))
    return a.join(b, "level", "full").select("level", f.alias("first"), n.alias("second"), (n - f).alias("delta"))


_CASES = """
    t AS (SELECT scope, count(*) FILTER (WHERE level = 'indicator' AND regexp_matches(title, '\\b(Early|Later)\\s*\\(')) AS band_title,
      count(*) FILTER (WHERE level = 'indicator' AND title IS NULL) AS no_title,
      count(*) FILTER (WHERE level = 'indicator' AND regexp_matches(source_text, '^\\s*[a-z]\\.\\s')) AS lettered,
      count(*) FILTER (WHERE level = 'indicator' AND source_text IS NULL) AS no_source,
      4 - count(DISTINCT level) FILTER (WHERE level IN ('domain', 'strand', 'sub_strand', 'indicator')) AS absent,
      count(*) FILTER (WHERE level = 'sub_strand') AS subs,
      count(*) FILTER (WHERE regexp_matches(source_text, '^\\s*[0-9]+\\.\\s+[A-Z][^\\n]*:') AND level IS DISTINCT FROM 'strand') AS numbered,
      count(*) FILTER (WHERE source_text IS NULL) AS any_no_source,
      count(*) FILTER (WHERE level = 'indicator' AND starts_with(code, 'PK3.')) AS pk3,
      count(*) FILTER (WHERE level = 'indicator' AND starts_with(code, 'PK4.')) AS pk4,
      count(*) FILTER (WHERE level = 'indicator' AND coalesce(age_band, '') NOT IN ('PK3', 'PK4')) AS other_band,
      count(*) FILTER (WHERE level = 'indicator' AND trim(title) IN ('PK3 Outcome', 'PK4 Outcome', 'PK3', 'PK4')) AS column_header,
      count(*) FILTER (WHERE contains(title, 'Indicators and Examples in the Context')) AS examples_header FROM e GROUP BY scope),
    c AS (SELECT scope, trim(code) AS code, bool_or(contains(coalesce(age_band, ''), 'Early')) AND bool_or(contains(coalesce(age_band, ''), 'Later')) AS complete
      FROM e WHERE level = 'indicator' AND coalesce(trim(code), '') <> '' GROUP BY ALL),
    l AS (SELECT scope, count(*) FILTER (WHERE NOT complete) AS lone FROM c GROUP BY scope),
    w AS (SELECT t.*, coalesce(lone, 0) AS lone FROM t LEFT JOIN l ON l.scope IS NOT DISTINCT FROM t.scope),
    r AS (SELECT scope, unnest([
      {'id': 'ca_age_columns_emitted', 'x': lone, 'broken': false}, {'id': 'ca_age_label_not_in_title', 'x': band_title, 'broken': no_title > 0},
      {'id': 'ca_no_lettered_examples_as_indicators', 'x': lettered, 'broken': no_source > 0}, {'id': 'ca_four_level_hierarchy', 'x': absent, 'broken': false},
      {'id': 'co_no_sub_strand', 'x': subs, 'broken': false}, {'id': 'co_numeric_strands', 'x': numbered, 'broken': any_no_source > 0},
      {'id': 'co_indicator_parent_is_strand', 'x': 0, 'broken': false}, {'id': 'tx_pk3_pk4_distinct', 'x': (pk3 = 0 OR pk4 = 0)::BIGINT, 'broken': false},
      {'id': 'tx_age_band_set', 'x': other_band, 'broken': false}, {'id': 'tx_no_column_header_as_indicator', 'x': column_header, 'broken': false},
      {'id': 'az_no_lettered_examples', 'x': lettered, 'broken': no_source > 0}, {'id': 'az_no_examples_header_as_element', 'x': examples_header, 'broken': false},
      {'id': 'az_four_level_hierarchy', 'x': absent, 'broken': false}]) AS k FROM w),
    s AS (SELECT scope, k.id AS case_id, CASE WHEN k.broken THEN 'ERROR' WHEN k.x = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
      CASE WHEN NOT k.broken THEN k.x END AS wrong FROM r)"""


@R.add("p28_f8_checks", f"""
    WITH e AS (SELECT *, document_s3_key AS scope FROM detected_elements QUALIFY row_number() OVER (PARTITION BY element_id ORDER BY detected_at) = 1),
    {_CASES} SELECT scope AS document_s3_key, case_id, status, wrong FROM s""")
def p28_f8_checks(s: SparkSession, d: str) -> DataFrame:
    """All registered cases on each document's elements."""
    cols = ["document_s3_key", "level", "code", "title", "source_text", "age_band"]
    return evaluate.checks(first_delivery(table(s, d, "detected_elements"), "element_id", "detected_at", cols), ["document_s3_key"])


@R.add("f8_golden_cases", f"""
    WITH e AS (SELECT DISTINCT test_case_id, level, code, title, description AS source_text, age_band, set_id AS scope FROM golden_elements),
    {_CASES} SELECT scope AS set_id, upper(replace(case_id, '_', '-')) AS case_id, status, wrong FROM s
    WHERE case_id IN ('ca_age_columns_emitted', 'co_no_sub_strand', 'tx_age_band_set')
    UNION ALL SELECT DISTINCT scope, 'ZZ-NO-SUCH-CASE', 'SKIP', NULL FROM s""")
def f8_golden_cases(s: SparkSession, d: str) -> DataFrame:
    """F8: cases named by their ids on the golden sets; an unknown id is skipped."""
    g = table(s, d, "golden_elements").select("set_id", "test_case_id", "level", "code", "title", F.col("description").alias("source_text"), "age_band")
    return evaluate.checks(g.distinct(), ["set_id"], ["CA-AGE-COLUMNS-EMITTED", "CO-NO-SUB-STRAND", "TX-AGE-BAND-SET", "ZZ-NO-SUCH-CASE"])


@R.add("a20_bands_complete", """
    WITH g AS (SELECT set_id, trim(code) AS code, age_band FROM golden_elements WHERE level = 'indicator' AND trim(code) <> '')
    SELECT set_id, code, coalesce(bool_or(contains(age_band, 'Early')), false) AND coalesce(bool_or(contains(age_band, 'Later')), false) AS complete
    FROM g GROUP BY set_id, code""")
def a20_bands_complete(s: SparkSession, d: str) -> DataFrame:
    """Every indicator code, those on one row only included."""
    return evaluate.bands_complete(table(s, d, "golden_elements").select("set_id", "level", "code", "age_band"), ["set_id"])


@R.add("j16_costs", f"WITH {_M} SELECT call_id, round(cost_usd, 6) AS cost_usd FROM x")
def j16_costs(s: SparkSession, d: str) -> DataFrame:
    return _calls(s, d).select("call_id", F.round("cost_usd", 6).alias("cost_usd"))


@R.add("a13_run_rollup", f"""
    WITH {_M}, y AS (SELECT coalesce(run_id, 'none') AS run_id, coalesce(stage, 'none') AS stage, input_tokens, output_tokens, cost_usd, ms FROM x)
    SELECT run_id, coalesce(stage, 'all') AS stage, count(*) AS calls, sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens,
      round(sum(cost_usd), 6) AS cost_usd, round(sum(ms), 1) AS latency_ms FROM y GROUP BY GROUPING SETS ((run_id, stage), (run_id))""")
def a13_run_rollup(s: SparkSession, d: str) -> DataFrame:
    return metrics.run_rollup(_calls(s, d, "run_id", "stage", "latency_ms"))


@R.add("a16_top_runs", f"""
    WITH {_M} SELECT run_id, round(sum(cost_usd), 6) AS cost_usd, sum(input_tokens)::BIGINT AS input_tokens, count(*) AS calls FROM x
    WHERE run_id IS NOT NULL GROUP BY run_id ORDER BY round(sum(cost_usd), 6) DESC, run_id LIMIT 20""")
def a16_top_runs(s: SparkSession, d: str) -> DataFrame:
    """The dearest runs."""
    g = _calls(s, d, "run_id").where("run_id IS NOT NULL").groupBy("run_id").agg(
        F.round(F.sum("cost_usd"), 6).alias("cost_usd"), F.sum("input_tokens").alias("input_tokens"), F.count("*").alias("calls"))
    return g.orderBy(F.desc("cost_usd"), "run_id").limit(20)


@R.add("a17_by_state", f"""
    WITH {_M} SELECT state, round(sum(cost_usd), 6) AS cost_usd, sum(output_tokens)::BIGINT AS output_tokens, count(*) AS calls FROM x GROUP BY state""")
def a17_by_state(s: SparkSession, d: str) -> DataFrame:
    return _calls(s, d, "state").groupBy("state").agg(F.round(F.sum("cost_usd"), 6).alias("cost_usd"),
                                             F.sum("output_tokens").alias("output_tokens"), F.count("*").alias("calls"))


@R.add("a18_by_stage", f"""
    WITH {_M} SELECT stage, round(avg(ms), 4) AS mean_ms, max(ms) AS max_ms, count(*) AS calls FROM x GROUP BY stage""")
def a18_by_stage(s: SparkSession, d: str) -> DataFrame:
    ms = metrics.measured(F.col("latency_ms"))
    return _once(s, d, "stage", "latency_ms").groupBy("stage").agg(F.round(F.avg(ms), 4).alias("mean_ms"), F.max(ms).alias("max_ms"), F.count("*").alias("calls"))


@R.add("t1_hourly_sums", f"""
    WITH {_M} SELECT strftime(time_bucket(INTERVAL 1 HOUR, called_at), '%Y-%m-%d %H:%M') AS bucket, stage, round(sum(cost_usd), 6) AS cost_usd,
      sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens, sum(retry_count)::BIGINT AS retries,
      count(*) FILTER (WHERE NOT success) AS errors FROM x WHERE called_at IS NOT NULL GROUP BY ALL""")
def t1_hourly_sums(s: SparkSession, d: str) -> DataFrame:
    return metrics.windows(_calls(s, d, "called_at", "stage", "retry_count", "success"), "1 hour", ["stage"], [
        F.round(F.sum("cost_usd"), 6).alias("cost_usd"), F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"), F.sum("retry_count").alias("retries"),
        F.count_if(~F.col("success")).alias("errors")])


@R.add("t2_daily_totals", f"""
    WITH {_M} SELECT strftime(time_bucket(INTERVAL 24 HOUR, called_at, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M') AS bucket, round(sum(cost_usd), 6) AS cost_usd,
      count(*) AS calls, count(*) FILTER (WHERE NOT success) AS errors FROM x WHERE called_at IS NOT NULL GROUP BY ALL""")
def t2_daily_totals(s: SparkSession, d: str) -> DataFrame:
    return metrics.windows(_calls(s, d, "called_at", "success"), "24 hours", [], [F.round(F.sum("cost_usd"), 6).alias("cost_usd"), F.count("*").alias("calls"),
                                                          F.count_if(~F.col("success")).alias("errors")])


@R.add("t3_latency_percentiles", f"""
    WITH {_M} SELECT strftime(time_bucket(INTERVAL 5 MINUTE, called_at), '%Y-%m-%d %H:%M') AS bucket, round(quantile_disc(ms, 0.5), 3) AS p50,
      round(quantile_disc(ms, 0.9), 3) AS p90, round(quantile_disc(ms, 0.99), 3) AS p99, max(ms) AS top FROM x WHERE ms IS NOT NULL
      AND called_at IS NOT NULL GROUP BY ALL""")
def t3_latency_percentiles(s: SparkSession, d: str) -> DataFrame:
    """By a mergeable summary of bounded size per window, exact while a window holds fewer values than it keeps."""
    c = _once(s, d, "called_at", "latency_ms").withColumn("ms", metrics.measured(F.col("latency_ms"))).where("ms IS NOT NULL")
    return metrics.windows(c, "5 minutes", [], [F.round(metrics.percentile_of(F.col("ms"), q), 3).alias(n) for n, q in (
        ("p50", 0.5), ("p90", 0.9), ("p99", 0.99))] + [F.max("ms").alias("top")])


@R.add("t4_duration_errors", """
    SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M') AS bucket, event_type, round(avg(value), 6) AS mean_value,
      count(*) FILTER (WHERE value > 50) AS errors FROM events GROUP BY ALL""")
def t4_duration_errors(s: SparkSession, d: str) -> DataFrame:
    return metrics.windows(table(s, d, "events"), "5 minutes", ["event_type"], [
        F.round(F.avg("value"), 6).alias("mean_value"), F.count_if(F.col("value") > 50).alias("errors")], at="ts")


@R.add("t5_executions", """
    SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS bucket, count(*) FILTER (WHERE event_type = 'signup') AS started,
      count(*) FILTER (WHERE event_type = 'purchase') AS succeeded, count(*) FILTER (WHERE event_type = 'error') AS failed,
      round(avg(value), 6) AS mean_value, max(value) AS max_value FROM events GROUP BY ALL""")
def t5_executions(s: SparkSession, d: str) -> DataFrame:
    kind = lambda k: F.count_if(F.col("event_type") == k)
    return metrics.windows(table(s, d, "events"), "1 hour", [], [
        kind("signup").alias("started"), kind("purchase").alias("succeeded"), kind("error").alias("failed"),
        F.round(F.avg("value"), 6).alias("mean_value"), F.max("value").alias("max_value")], at="ts")


@R.add("t6_last_week", """
    SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events
    WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY event_type""")
def t6_last_week(s: SparkSession, d: str) -> DataFrame:
    """Relative range; its end is one aggregated value."""
    e = table(s, d, "events")
    end = e.agg(F.max("ts").alias("m")).first()[0]
    recent = e.where(F.col("ts") > F.lit(end) - F.expr("INTERVAL 7 DAY")) if end else e.limit(0)
    return recent.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@R.add("s18_fan_out", f"""
    WITH {_M}, l AS (SELECT call_id, coalesce(stage, 'none') AS stage, coalesce(model_id, 'none') AS model, input_tokens::DOUBLE AS i, output_tokens::DOUBLE AS o,
      ms, round(cost_usd, 6) AS cost, retry_count, success FROM x),
    r AS (SELECT call_id, stage, model, unnest([{{'metric': 'InputTokens', 'value': i}}, {{'metric': 'OutputTokens', 'value': o}},
      {{'metric': 'LatencyMs', 'value': ms}}, {{'metric': 'CostUSD', 'value': cost}}, {{'metric': 'CallCount', 'value': 1.0::DOUBLE}}]) AS m FROM l
      UNION ALL SELECT call_id, stage, model, {{'metric': 'RetryCount', 'value': retry_count::DOUBLE}} FROM l WHERE retry_count > 0
      UNION ALL SELECT call_id, stage, model, {{'metric': 'ErrorCount', 'value': 1.0::DOUBLE}} FROM l WHERE NOT success)
    SELECT call_id, 'stage=' || stage AS dimensions, m.metric AS metric, m.value AS value FROM r
    UNION ALL SELECT call_id, 'stage=' || stage || ',model=' || model, m.metric, m.value FROM r""")
def s18_fan_out(s: SparkSession, d: str) -> DataFrame:
    return metrics.fan_out(_calls(s, d, "stage", "latency_ms", "retry_count", "success"))


@R.add("s19_log_lines", f"""
    WITH {_M} SELECT call_id, CAST(json_merge_patch('{{}}', json_object('event', 'llm_call', 'run_id', run_id, 'stage', stage, 'model_id', model_id, 'input_tokens', input_tokens,
      'output_tokens', output_tokens, 'cost_usd', round(cost_usd, 6)::DECIMAL(18, 6)::VARCHAR, 'retry_count', retry_count, 'success', success)) AS VARCHAR) AS line FROM x""")
def s19_log_lines(s: SparkSession, d: str) -> DataFrame:
    """The line of every call; costs as text with six places."""
    return metrics.log_lines(_calls(s, d, "run_id", "stage", "retry_count", "success"))


@R.add("a25_latest_totals", """
    WITH c AS (SELECT * FROM llm_call_metrics QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY ingested_at) = 1)
    SELECT run_id, arg_max(batch_index, (called_at, call_id)) FILTER (WHERE batch_index IS NOT NULL) AS batch_index,
      arg_max(chunk_index, (called_at, call_id)) FILTER (WHERE chunk_index IS NOT NULL) AS chunk_index,
      arg_max(error, (called_at, call_id)) FILTER (WHERE error IS NOT NULL) AS error FROM c WHERE run_id IS NOT NULL GROUP BY run_id""")
def a25_latest_totals(s: SparkSession, d: str) -> DataFrame:
    return metrics.latest_totals(_once(s, d, "run_id", "called_at", "batch_index", "chunk_index", "error"))


@R.add("a26_persisted", f"""
    WITH {_M} SELECT stage, count(*) FILTER (WHERE success) AS persisted, count(*) FILTER (WHERE NOT success) AS failed FROM c GROUP BY stage""")
def a26_persisted(s: SparkSession, d: str) -> DataFrame:
    c = _once(s, d, "stage", "success")
    return c.groupBy("stage").agg(F.count_if("success").alias("persisted"), F.count_if(~F.col("success")).alias("failed"))


@R.add("w7_previous_stage", """
    WITH c AS (SELECT * FROM llm_call_metrics QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY ingested_at) = 1)
    SELECT call_id, lag(stage) OVER (PARTITION BY run_id, batch_index ORDER BY called_at, call_id) AS previous_stage FROM c
    WHERE run_id IS NOT NULL""")
def w7_previous_stage(s: SparkSession, d: str) -> DataFrame:
    c = _once(s, d, "run_id", "batch_index", "called_at", "stage").where("run_id IS NOT NULL")
    return previous(c, ["run_id", "batch_index"], [F.col("called_at"), F.col("call_id")], "stage", "previous_stage").select(
        "call_id", "previous_stage")


QUERIES, SQL = R.queries, R.sql
