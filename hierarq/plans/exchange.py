"""Queries of sources, sinks, sessions, plans and executions that come and go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hierarq.common import shared_path, table
from hierarq.functions import text
from hierarq.operators import snapshot
from hierarq.operators.ordered import numbered
from hierarq.operators.serve import first_delivery
from hierarq.plans.registry import CURRENT, Registry
from hierarq.sources import objects, providers
from hierarq.streaming import events as ev

R = Registry()


@R.add("s3_ingested", f"""
    WITH {CURRENT}, k AS (SELECT id, coalesce(s3_key, 'none-' || id || '.txt') AS path, version_year % 5 AS size FROM docs)
    SELECT id, CASE WHEN NOT regexp_matches(lower(path), '\\.(pdf|html)$') OR size = 0 THEN 'error' ELSE 'success' END AS status,
      CASE WHEN NOT regexp_matches(lower(path), '\\.(pdf|html)$') THEN 'unsupported format' WHEN size = 0 THEN 'empty file' END AS reason,
      CASE WHEN regexp_matches(lower(path), '\\.(pdf|html)$') AND size > 0 THEN CASE WHEN id % 2 = 0 THEN 'replace metadata' ELSE 'put' END END AS action FROM k""")
def s3_ingested(s: SparkSession, d: str) -> DataFrame:
    """S3: what is to be done with each file: put, or only its metadata replaced where it is already in its place."""
    docs = first_delivery(table(s, d, "source_documents"), "id", "loaded_at", ["id", "s3_key", "version_year"])
    path = F.coalesce("s3_key", F.concat(F.lit("none-"), "id", F.lit(".txt")))
    files = docs.select("id", path.alias("path"), (F.col("version_year") % 5).alias("size"))
    there = files.where("id % 2 = 0").select("path")
    return objects.ingest_plan(files, there).select("id", "status", "reason", "action")


@R.add("s4_extractions", """
    WITH b AS (SELECT DISTINCT block_id, document_s3_key, page_number FROM text_blocks WHERE coalesce(text, '') <> '')
    SELECT o.s3_key, count(b.block_id) AS total_blocks, max(b.page_number) AS total_pages, CASE WHEN regexp_matches(lower(o.s3_key), '\\.pdf$') THEN 'job' ELSE 'direct' END AS way,
      CASE WHEN count(b.block_id) = 0 THEN 'error' ELSE 'success' END AS status
    FROM (SELECT DISTINCT s3_key FROM source_documents WHERE s3_key IS NOT NULL) o LEFT JOIN b ON b.document_s3_key = o.s3_key GROUP BY o.s3_key""")
def s4_extractions(s: SparkSession, d: str) -> DataFrame:
    """Documents and what was read from them; one without text is an error."""
    docs = table(s, d, "source_documents").where("s3_key IS NOT NULL").select("s3_key").distinct()
    blocks = table(s, d, "text_blocks").where("coalesce(text, '') <> ''").select("block_id", F.col("document_s3_key").alias("s3_key"), "page_number").distinct()
    return objects.extraction_results(docs, blocks, "s3_key")


@R.add("s5_paged", """
    WITH j AS (SELECT n_nationkey AS k FROM nation)
    SELECT k AS job, p::INT AS page_no, i::INT AS item_no, 'item ' || k || '.' || p || '.' || i AS item, NULL AS error
    FROM j, range(k % 4 + 1) t(p), range(3) u(i) WHERE k % 7 NOT IN (5, 6)
    UNION ALL SELECT k, NULL, NULL, NULL, CASE WHEN k % 7 = 5 THEN 'failed' ELSE 'not done after 4 polls' END FROM j WHERE k % 7 IN (5, 6)""")
def s5_paged(s: SparkSession, d: str) -> DataFrame:
    """Jobs that are polled and read page by page; here a service of the nations' making."""

    def poll(k: int, n: int) -> str:
        return "failed" if k % 7 == 5 else "waiting" if k % 7 == 6 or n < k % 3 else "done"

    def fetch(k: int, token: str | None) -> tuple[list[str], str | None]:
        page = int(token or 0)
        return [f"item {k}.{page}.{i}" for i in range(3)], str(page + 1) if page < k % 4 else None

    jobs = table(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("job"))
    return providers.paged(jobs, "job", poll, fetch, polls=4, wait=0.0)


@R.add("s13_affected", """
    SELECT count(*) FILTER (WHERE label = 0)::BIGINT AS updated, count(*) FILTER (WHERE label = 1)::BIGINT AS deleted, count(*) FILTER (WHERE label = 2)::BIGINT AS inserted FROM embeddings""")
def s13_affected(s: SparkSession, d: str) -> DataFrame:
    """How many rows a change inserted, updated and deleted."""
    old = table(s, d, "embeddings").select("vec_id", "label")
    new = old.where("label <> 1").withColumn("label", F.when(F.col("label") == 0, -1).otherwise(F.col("label"))).unionByName(
        old.where("label = 2").withColumn("vec_id", F.col("vec_id") + 100_000_000))
    return snapshot.affected(old, new, ["vec_id"])


@R.add("s14_one_and_many", """
    SELECT 'one' AS kind, o_orderkey, o_custkey FROM (SELECT * FROM orders WHERE o_custkey = 7 ORDER BY o_orderkey LIMIT 1)
    UNION ALL SELECT 'many', o_orderkey, o_custkey FROM orders WHERE o_custkey = 7""")
def s14_one_and_many(s: SparkSession, d: str) -> DataFrame:
    """A statement for its first row (the operator's own limit), and for all."""
    sql = f"SELECT o_orderkey, o_custkey FROM parquet.`{d}/orders.parquet` WHERE o_custkey = :c ORDER BY o_orderkey"
    one, many = objects.statement_one(s, sql, c=7), objects.statement(s, sql, c=7)
    return one.select(F.lit("one").alias("kind"), "*").unionByName(many.select(F.lit("many").alias("kind"), "*"))


@R.add("s16_golden_sets", """
    SELECT DISTINCT state, test_case_id, code FROM golden_elements WHERE state IN ('AZ', 'CA')""")
def s16_golden_sets(s: SparkSession, d: str) -> DataFrame:
    """Golden sets as JSON objects per state; a state without one is skipped."""
    base = shared_path(s, "golden")
    for state in ("AZ", "CA"):
        objects.write_json(table(s, d, "golden_elements").where(F.col("state") == state).select("test_case_id", "code").distinct(), f"{base}/{state}")
    return objects.read_golden(s, base, ["AZ", "CA", "ZZ"], "test_case_id string, code string")


@R.add("s20_signed_urls", f"""
    WITH {CURRENT} SELECT id, floor(epoch(loaded_at))::BIGINT + 3600 AS expires_at FROM docs WHERE s3_key IS NOT NULL AND NOT contains(s3_key, '://')""")
def s20_signed_urls(s: SparkSession, d: str) -> DataFrame:
    """Documents with a file, and when a link made at their loading expires; signing is the store's."""
    docs = first_delivery(table(s, d, "source_documents"), "id", "loaded_at", ["id", "s3_key", "loaded_at"])
    return docs.where("s3_key IS NOT NULL AND NOT contains(s3_key, '://')").select("id", text.expiry(F.col("loaded_at"), 3600).alias("expires_at"))


@R.add("s21_fetched", f"""
    WITH {CURRENT} SELECT o.id AS document_id, count(d.id) AS domains FROM docs o LEFT JOIN cur_domains d ON d.document_id = o.id AND NOT d.deleted
    WHERE o.id % 6 <> 0 GROUP BY o.id""")
def s21_fetched(s: SparkSession, d: str) -> DataFrame:
    """Every document with its hierarchy in one join; documents whose fetch fails are dropped (here every sixth)."""

    def fetch(x: str) -> str:
        if int(x) % 6 == 0:
            raise RuntimeError("unreachable")
        return x

    from hierarq.operators.serve import live

    docs = first_delivery(table(s, d, "source_documents"), "id", "loaded_at", ["id"])
    got = providers.call_provider(docs.select("id", F.col("id").cast("string").alias("x")), "id", "x", fetch).where("error IS NULL").select(F.col("id").alias("document_id"))
    return got.join(live(table(s, d, "domains"), ["document_id"]), "document_id", "left").groupBy("document_id").agg(F.count("id").alias("domains"))


@R.add("o12_recent_executions", """
    WITH c AS (SELECT * FROM llm_call_metrics QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY ingested_at) = 1),
    r AS (SELECT run_id, min(called_at) AS started FROM c WHERE run_id IS NOT NULL GROUP BY run_id),
    t AS (SELECT * FROM r ORDER BY started DESC, run_id LIMIT 100) SELECT run_id FROM t WHERE contains(run_id, '1')""")
def o12_recent_executions(s: SparkSession, d: str) -> DataFrame:
    """Executions by name among the latest hundred (the lookup's own limit)."""
    from hierarq.operators import metrics

    c = metrics.once(table(s, d, "llm_call_metrics"), ["run_id", "called_at"]).where("run_id IS NOT NULL")
    runs = c.groupBy("run_id").agg(F.min("called_at").alias("started"))
    return runs.orderBy(F.desc("started"), "run_id").limit(100).where(F.col("run_id").contains("1")).select("run_id")


_PLANS = """p AS (SELECT o_orderkey AS plan_id, o_custkey AS user_id, o_orderpriority AS duration, o_orderstatus AS content FROM orders),
    c AS (SELECT CASE WHEN plan_id % 6 = 3 THEN plan_id + 100000000 ELSE plan_id END AS plan_id, CASE plan_id % 6 WHEN 0 THEN 'update' WHEN 1 THEN 'delete' WHEN 2 THEN 'update' ELSE 'create' END AS op,
      CASE WHEN plan_id % 6 = 2 THEN user_id + 1 ELSE user_id END AS user_id, CASE WHEN plan_id % 12 = 0 THEN 'long' WHEN plan_id % 6 = 3 THEN 'short' END AS duration,
      'new ' || plan_id AS content, CASE WHEN plan_id % 12 = 3 THEN '' ELSE 'Kim' END AS child_name FROM p WHERE plan_id % 6 < 4)"""


def _plan_state(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = table(s, d, "orders")
    plans = o.select(F.col("o_orderkey").alias("plan_id"), F.col("o_custkey").alias("user_id"), F.lit("Kim").alias("child_name"), F.lit("4").alias("child_age"),
                     F.lit("CA").alias("state"), F.lit(None).cast("string").alias("interests"), F.lit(None).cast("string").alias("concerns"),
                     F.col("o_orderpriority").alias("duration"), F.col("o_orderstatus").alias("content"),
                     F.lit(None).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    kind = F.col("plan_id") % 6
    ch = plans.where("plan_id % 6 < 4").select(
        F.when(kind == 3, F.col("plan_id") + 100_000_000).otherwise(F.col("plan_id")).alias("plan_id"),
        F.when(kind.isin(0, 2), "update").when(kind == 1, "delete").otherwise("create").alias("op"),
        F.when(kind == 2, F.col("user_id") + 1).otherwise(F.col("user_id")).alias("user_id"),
        F.when(F.col("plan_id") % 12 == 3, "").otherwise(F.col("child_name")).alias("child_name"), "child_age", "state", "interests", "concerns",
        F.when(F.col("plan_id") % 12 == 0, "long").when(kind == 3, "short").alias("duration"), F.concat(F.lit("new "), F.col("plan_id").cast("string")).alias("content"),
        F.lit(1).alias("seq"))
    return plans, ch


@R.add("m18_plans", f"""
    WITH {_PLANS} SELECT p.plan_id, p.user_id, coalesce(c.duration, p.duration) AS duration, coalesce(c.content, p.content) AS content
    FROM p LEFT JOIN c ON c.plan_id = p.plan_id AND c.op = 'update' AND c.user_id = p.user_id WHERE p.plan_id % 6 <> 1
    UNION ALL SELECT plan_id, user_id, duration, content FROM c WHERE op = 'create' AND child_name <> ''""")
def m18_plans(s: SparkSession, d: str) -> DataFrame:
    """Plans after creates, updates and deletes, each by its owner."""
    plans, ch = _plan_state(s, d)
    return snapshot.plan_changes(plans, ch, F.lit("2025-01-01").cast("timestamp_ntz"))[0].select("plan_id", "user_id", "duration", "content")


@R.add("m18_results", f"""
    WITH {_PLANS} SELECT plan_id, op, CASE WHEN op = 'create' AND child_name = '' THEN NULL WHEN plan_id % 6 = 2 AND plan_id < 100000000 THEN NULL WHEN op = 'create' THEN 'created'
      WHEN op = 'update' THEN 'updated' ELSE 'deleted' END AS action,
      CASE WHEN op = 'create' AND child_name = '' THEN 'child_name is required' WHEN plan_id % 6 = 2 AND plan_id < 100000000 THEN 'Plan not found or not owned by user' END AS error FROM c""")
def m18_results(s: SparkSession, d: str) -> DataFrame:
    """What became of each change."""
    plans, ch = _plan_state(s, d)
    return snapshot.plan_changes(plans, ch, F.lit("2025-01-01").cast("timestamp_ntz"))[1]


@R.add("t8_agent_frames", """
    WITH e AS (SELECT event_id, user_id, trim(coalesce(props, '')) AS words, event_type FROM events WHERE trim(coalesce(props, '')) <> ''),
    f AS (SELECT event_id, unnest(CASE WHEN event_type = 'error' THEN [{'step': 1, 'type': 'error', 'text': 'refused'}, {'step': 2, 'type': 'done', 'text': NULL}]
      ELSE list_concat(list_transform(string_split(words, ' '), lambda x, i: {'step': i::INT, 'type': 'text', 'text': x}),
        [{'step': (len(string_split(words, ' ')) + 1)::INT, 'type': 'done', 'text': NULL}]) END) AS f FROM e)
    SELECT event_id, f.step AS step, f.type AS type, f.text AS text FROM f""")
def t8_agent_frames(s: SparkSession, d: str) -> DataFrame:
    """Messages answered as frames: text as it comes, an end, or an error and an end; blank messages give none."""
    e = table(s, d, "events").select("event_id", F.col("user_id").cast("string").alias("plan_id"), F.col("props").alias("message"), F.split(F.trim("props"), " ").alias("chunks"),
                                     F.when(F.col("event_type") == "error", "refused").alias("error"))
    return ev.agent_frames(e).select("event_id", "step", "type", "text")


@R.add("t8_enriched", """
    SELECT event_id, '[Session context: planId=' || user_id || ']' || chr(10) || chr(10) || trim(props) AS prompt FROM events WHERE trim(coalesce(props, '')) <> ''""")
def t8_enriched(s: SparkSession, d: str) -> DataFrame:
    """What the agent is asked: the message after its session's context."""
    e = table(s, d, "events").select("event_id", F.col("user_id").cast("string").alias("plan_id"), F.col("props").alias("message"))
    return e.select("event_id", ev.enriched(F.col("message"), F.col("plan_id")).alias("prompt")).where("prompt IS NOT NULL")


_T9 = """
    WITH RECURSIVE e AS (SELECT user_id, event_id, floor(epoch(ts))::BIGINT AS t FROM events),
    r AS (SELECT user_id, min(t) AS t FROM e GROUP BY user_id
      UNION ALL SELECT r.user_id, (SELECT min(e.t) FROM e WHERE e.user_id = r.user_id AND e.t >= r.t + 20000) FROM r WHERE r.t IS NOT NULL)
    SELECT user_id, t AS renewed_at, t + 20000 AS expires_at FROM r WHERE t IS NOT NULL"""


def _asks(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select("user_id", "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"))


@R.add("t9_url_renewals", _T9)
def t9_url_renewals(s: SparkSession, d: str) -> DataFrame:
    """When a session's link is renewed: at the first ask, then at the first after it expired (20,000 s here)."""
    return ev.renewals(_asks(s, d), "user_id", "t", 20_000)


@R.add("t9_url_stream", _T9)
def t9_url_stream(s: SparkSession, d: str) -> DataFrame:
    """T9 as a stateful stream: the state of a session is when its link expires."""
    schema = table(s, d, "events").schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    asks = ev.event_stream(s, f"{d}/event[s].parquet", schema).select("user_id", F.unix_timestamp("ts").alias("t"))
    return ev.run_to_end(ev.renewal_stream(asks, "user_id", "t", 20_000), "urls", "append")


@R.add("scalar_ids_and_times", """
    WITH c AS (SELECT DISTINCT call_id, country, state, batch_index, called_at FROM llm_call_metrics)
    SELECT call_id, CASE WHEN country IS NOT NULL AND state IS NOT NULL THEN 'run' END AS head, country AS run_country, state AS run_state,
      batch_index AS run_batch, 'part-' || call_id || '.json' AS file_name, 'a/result-' || call_id AS result_key, strftime(called_at, '%Y-%m-%dT%H:%M:%S') AS iso,
      floor(epoch(called_at))::BIGINT + 300 AS expires_at, true AS uuid_ok, 12 AS short_id_size FROM c WHERE country IS NOT NULL AND state IS NOT NULL AND batch_index IS NOT NULL AND called_at IS NOT NULL""")
def scalar_ids_and_times(s: SparkSession, d: str) -> DataFrame:
    """Positional parse, replace, uuid, ISO time and expiry."""
    c = table(s, d, "llm_call_metrics").select("call_id", "country", "state", "batch_index", "called_at").distinct().where(
        "country IS NOT NULL AND state IS NOT NULL AND batch_index IS NOT NULL AND called_at IS NOT NULL")
    c = c.withColumns({"run": F.concat_ws("-", F.lit("pipeline"), "country", "state", F.col("batch_index").cast("string"), F.lit("x7")),
                       "path": F.concat(F.lit("in/of/part-"), "call_id", F.lit(".json")), "u": F.uuid()})
    part = text.run_parts(F.col("run"))
    return c.select("call_id", F.when(part.isNotNull(), "run").alias("head"), part["country"].alias("run_country"), part["state"].alias("run_state"),
                    part["year"].alias("run_batch"), text.file_name(F.col("path")).alias("file_name"), text.result_key(F.concat(F.lit("a/batch-"), "call_id")).alias("result_key"),
                    text.iso_time(F.col("called_at")).alias("iso"), text.expiry(F.col("called_at"), 300).alias("expires_at"),
                    F.col("u").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("uuid_ok"), F.length(text.short_id(F.col("u"))).alias("short_id_size"))


@R.add("o6_agent_indicators", """
    WITH docs AS (SELECT * FROM source_documents QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1),
    cur_domains AS (SELECT * FROM domains QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1),
    cur_strands AS (SELECT * FROM strands QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1),
    cur_subs AS (SELECT * FROM sub_strands QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1)
    SELECT u.id AS sub_strand_id, d.name AS domain_name, s.name AS strand_name, u.code, row_number() OVER (ORDER BY d.name, s.name, u.code, u.id) AS place
    FROM cur_subs u JOIN cur_strands s ON s.id = u.strand_id JOIN cur_domains d ON d.id = s.domain_id JOIN docs o ON o.id = d.document_id WHERE o.state = 'CA'""")
def o6_agent_indicators(s: SparkSession, d: str) -> DataFrame:
    """What an agent is told of a state, in the order of domain, strand and code, deleted or not."""
    from hierarq.operators import agent_tools

    return agent_tools.TOOLS["getIndicators"](s, d, "CA").select("sub_strand_id", "domain_name", "strand_name", "code", "place")


@R.add("f9_states_and_ages", """
    SELECT 'state' AS kind, state AS value FROM (SELECT DISTINCT state FROM source_documents WHERE state IS NOT NULL)
    UNION ALL SELECT 'age', age_band FROM (SELECT DISTINCT age_band FROM source_documents WHERE state = 'CA' AND trim(coalesce(age_band, '')) <> '')""")
def f9_states_and_ages(s: SparkSession, d: str) -> DataFrame:
    """the agent's tools for states and age ranges."""
    from hierarq.operators import agent_tools

    states = agent_tools.TOOLS["getAvailableStates"](s, d).select(F.lit("state").alias("kind"), F.col("state").alias("value"))
    return states.unionByName(agent_tools.TOOLS["getAgeRanges"](s, d, "CA").select(F.lit("age").alias("kind"), F.col("age_range").alias("value")))


QUERIES, SQL = R.queries, R.sql
