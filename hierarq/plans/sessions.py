"""Queries of streams, conversations, plans, guards, text functions and objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hierarq.common import shared_path, table
from hierarq.functions import text
from hierarq.operators.ordered import numbered
from hierarq.operators.serve import first_delivery
from hierarq.plans.registry import CURRENT, Registry
from hierarq.sources import objects, providers
from hierarq.streaming import events as ev

R = Registry()
# Shapes of personal data that must not pass.
GUARDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"(\+?1[-\s.]?)?\(?\d{3}\)?[-\s.]?\d{3}[-\s.]?\d{4}",
    "ssn": r"\b\d{3}[-\s]?\d{2}[-\s]?\d{4}\b",
    "birth_date": r"\b(0[1-9]|1[0-2])[/\-](0[1-9]|[12]\d|3[01])[/\-](19|20)\d{2}\b",
    "street": r"\b\d{1,5}\s[A-Za-z]+\s(St|Street|Ave|Avenue|Blvd|Boulevard|Dr|Drive|Ln|Lane|Rd|Road|Ct|Court|Way|Pl|Place)\b",
}


@R.add("t1_stream_windows", """
    SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS bucket, event_type, count(*) AS n, round(sum(value), 4) AS total
    FROM events GROUP BY ALL""")
def t1_stream_windows(s: SparkSession, d: str) -> DataFrame:
    """T1 as a stream, run to the end of what is there."""
    schema = table(s, d, "events").schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    return ev.run_to_end(ev.windowed_sums(ev.event_stream(s, f"{d}/event[s].parquet", schema)), "windows")


_FRAMES = """f AS (SELECT user_id AS session, event_id AS seq, CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'done'
      WHEN 'view' THEN 'odd' ELSE 'text' END AS kind, props AS text FROM events)"""


def _frames(e: DataFrame) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "purchase", "done").when(
        F.col("event_type") == "view", "odd").otherwise("text")
    return e.select(F.col("user_id").alias("session"), F.col("event_id").alias("seq"), kind.alias("kind"), F.col("props").alias("text"))


_FOLD = f"""
    WITH {_FRAMES}, e AS (SELECT session, min(seq) AS stop, arg_min(kind, seq) AS state FROM f WHERE kind IN ('done', 'error') GROUP BY session)
    SELECT f.session, coalesce(string_agg(f.text, '' ORDER BY f.seq) FILTER (WHERE f.kind = 'text' AND f.text IS NOT NULL AND (e.stop IS NULL OR f.seq < e.stop)), '') AS answer,
      coalesce(any_value(e.state), 'open') AS state FROM f LEFT JOIN e USING (session) GROUP BY f.session"""


@R.add("t7_folded_sessions", f"""
    WITH {_FRAMES}, e AS (SELECT session, min(seq) AS stop, arg_min(kind, seq) AS state FROM f WHERE kind IN ('done', 'error') GROUP BY session),
    t AS (SELECT f.session, f.seq, f.text, (row_number() OVER (PARTITION BY f.session ORDER BY f.seq) - 1) // 100 AS part FROM f LEFT JOIN e USING (session)
      WHERE f.kind = 'text' AND f.text IS NOT NULL AND (e.stop IS NULL OR f.seq < e.stop)),
    a AS (SELECT session, part, string_agg(text, '' ORDER BY seq) AS answer FROM t GROUP BY ALL)
    SELECT s.session, coalesce(a.part, 0) AS part, coalesce(a.answer, '') AS answer, coalesce(e.state, 'open') AS state
    FROM (SELECT DISTINCT session FROM f) s LEFT JOIN a USING (session) LEFT JOIN e USING (session)""")
def t7_folded_sessions(s: SparkSession, d: str) -> DataFrame:
    """Frames of a session folded into its answer, in parts of a hundred frames."""
    return ev.fold_frames(_frames(table(s, d, "events")))


@R.add("t8_stream_fold", _FOLD)
def t8_stream_fold(s: SparkSession, d: str) -> DataFrame:
    """T7 as a stateful stream; of each session the last state counts."""
    schema = table(s, d, "events").schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    out = ev.run_to_end(ev.fold_frame_stream(_frames(ev.event_stream(s, f"{d}/event[s].parquet", schema))), "fold", "update")
    return out.groupBy("session").agg(F.max_by(F.struct("answer", "state"), F.length("answer")).alias("r")).select("session", "r.*")


@R.add("w8_without_last_two", """
    SELECT event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) > 2""")
def w8_without_last_two(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select("event_id", "user_id", "ts")
    return numbered(e, ["user_id"], [(F.col("ts"), "desc"), (F.col("event_id"), "desc")], "n").where("n > 2").select("event_id", "user_id")


@R.add("w9_new_since", """
    SELECT event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) > 50""")
def w9_new_since(s: SparkSession, d: str) -> DataFrame:
    """Events after the last offset a session was told of (50 here)."""
    e = table(s, d, "events").select("event_id", "user_id", "ts")
    return numbered(e, ["user_id"], [F.col("ts"), F.col("event_id")], "n").where("n > 50").select("event_id", "user_id")


@R.add("p30_visible_messages", """
    SELECT event_id FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
    WHERE NOT (n = 1 AND event_type = 'view')""")
def p30_visible_messages(s: SparkSession, d: str) -> DataFrame:
    last = table(s, d, "events").groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("last"))
    e = table(s, d, "events").select("event_id", "event_type", "user_id").join(last, "user_id")
    return e.where(~((F.col("event_id") == F.col("last")) & (F.col("event_type") == "view"))).select("event_id")


@R.add("p29_guarded_texts", " UNION ALL ".join(
    f"SELECT doc_id, '{n}' AS guard FROM documents WHERE regexp_matches(text, '{p}')" for n, p in GUARDS.items()))
def p29_guarded_texts(s: SparkSession, d: str) -> DataFrame:
    """Which guards each text meets."""
    return table(s, d, "documents").select("doc_id", F.explode(guards_met(F.col("text"))).alias("guard"))


_CONTACT = "'No ' || c_custkey || ': ' || CASE c_custkey % 7 WHEN 0 THEN 'mail kim.' || c_custkey || '@example.org' WHEN 1 THEN 'call (212) 555-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') WHEN 2 THEN 'id 123-45-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') WHEN 3 THEN 'born 02/03/1999' WHEN 4 THEN 'at ' || (c_custkey % 900 + 1) || ' Oak Street' ELSE 'nothing' END"


@R.add("p29_guarded_contacts", f"WITH t AS (SELECT c_custkey, {_CONTACT} AS text FROM customer) " + " UNION ALL ".join(
    f"SELECT c_custkey, '{n}' AS guard FROM t WHERE regexp_matches(text, '{p}')" for n, p in GUARDS.items()))
def p29_guarded_contacts(s: SparkSession, d: str) -> DataFrame:
    """P29 on made-up contact lines that hold each kind of personal data."""
    k = F.col("c_custkey")
    four = F.lpad((k % 10000).cast("string"), 4, "0")
    kinds = [F.concat(F.lit("mail kim."), k, F.lit("@example.org")), F.concat(F.lit("call (212) 555-"), four), F.concat(F.lit("id 123-45-"), four),
             F.lit("born 02/03/1999"), F.concat(F.lit("at "), k % 900 + 1, F.lit(" Oak Street")), F.lit("nothing"), F.lit("nothing")]
    line = F.concat(F.lit("No "), k, F.lit(": "), F.element_at(F.array(*kinds), (k % 7 + 1).cast("int")))
    t = table(s, d, "customer").select("c_custkey", line.alias("text"))
    return t.select("c_custkey", F.explode(guards_met(F.col("text"))).alias("guard"))


def guards_met(c: Column, classifiers: dict[str, Column] | None = None) -> Column:
    """Names of the guards a text meets; ``classifiers`` are further ones, given as boolean columns (such as
    the answers of a moderation service joined to the rows)."""
    every = [F.when(c.rlike(p), F.lit(n)) for n, p in GUARDS.items()] + [F.when(v, F.lit(n)) for n, v in (classifiers or {}).items()]
    return F.array_compact(F.array(*every))


_PLAN = "array<struct<label:string,description:string,activities:array<string>>>"


def _plans(s: SparkSession, d: str) -> DataFrame:
    """Plans stand-in: a user's orders as sections, their lines as activities, content as JSON."""
    lines = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.concat(
        F.lpad("l_linenumber", 2, "0"), F.lit("-"), F.col("l_returnflag")))).alias("activities"))
    o = table(s, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return o.groupBy(F.col("o_custkey").alias("user_id"), F.date_format("o_orderdate", "yyyy").alias("plan_id")).agg(
        F.to_json(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").cast("string").alias("label"), F.col("o_orderstatus").alias("description"),
                                                       "activities")))).alias("content"))


def flattened(plans: DataFrame, owner: int | None = None) -> DataFrame:
    """(user_id, plan_id, label, activity) of the plans, or of one owner's (P20)."""
    mine = plans if owner is None else plans.where(F.col("user_id") == owner)
    p = mine.select("user_id", "plan_id", F.explode(F.from_json("content", _PLAN)).alias("x"))
    return p.select("user_id", "plan_id", F.col("x.label").alias("label"), F.explode("x.activities").alias("activity"))


@R.add("plan_activities", """
    SELECT o_custkey AS user_id, strftime(o_orderdate, '%Y') AS plan_id, o_orderkey::VARCHAR AS label,
      lpad(l_linenumber::VARCHAR, 2, '0') || '-' || l_returnflag AS activity FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = 7""")
def plan_activities(s: SparkSession, d: str) -> DataFrame:
    """P20: the plans of one owner."""
    return flattened(_plans(s, d), owner=7)


@R.add("plan_activities_all", """
    SELECT o_custkey AS user_id, strftime(o_orderdate, '%Y') AS plan_id, o_orderkey::VARCHAR AS label,
      lpad(l_linenumber::VARCHAR, 2, '0') || '-' || l_returnflag AS activity FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def plan_activities_all(s: SparkSession, d: str) -> DataFrame:
    """The content of all plans parsed and flattened."""
    return flattened(_plans(s, d))


@R.add("o8_latest_orders", """
    SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders""")
def o8_latest_orders(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return numbered(o, ["o_custkey"], [(F.col("o_orderdate"), "desc"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "place")


@R.add("scalar_functions", """
    WITH e AS (SELECT * FROM detected_elements QUALIFY row_number() OVER (PARTITION BY element_id ORDER BY detected_at) = 1)
    SELECT element_id, (length(coalesce(source_text, '')) // 4)::BIGINT AS tokens, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS key,
      regexp_replace(code, '^PK\\d+\\.', '') AS bare, regexp_matches(code, '[a-z][A-Z]') AS camel,
      upper(substring(replace(title, ' ', ''), 1, 5)) AS fallback_code, substring(sha256(coalesce(title, '')), 1, 16) AS hash,
      regexp_replace(coalesce(description, ''), '([.!])([A-Z])', '\\1 \\2', 'g') AS spaced FROM e""")
def scalar_functions(s: SparkSession, d: str) -> DataFrame:
    """The scalar functions of section 2.9."""
    e = first_delivery(table(s, d, "detected_elements"), "element_id", "detected_at", ["element_id", "source_text", "title", "code", "description"])
    return e.select("element_id", text.tokens_of(F.col("source_text")).alias("tokens"), text.squeezed(F.col("title")).alias("key"),
                    text.without_age_prefix(F.col("code")).alias("bare"), text.has_camel_case(F.col("code")).alias("camel"),
                    F.upper(F.substring(F.replace("title", F.lit(" "), F.lit("")), 1, 5)).alias("fallback_code"),
                    F.substring(F.sha2(F.coalesce("title", F.lit("")), 256), 1, 16).alias("hash"),
                    text.spaced_sentences(F.coalesce("description", F.lit(""))).alias("spaced"))


@R.add("s7_s8_json_roundtrip", f"WITH {CURRENT} SELECT id, title, version_year FROM docs")
def s7_s8_json_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """Written as JSON objects and read with a declared schema."""
    path = shared_path(s, "json")
    objects.write_json(first_delivery(table(s, d, "source_documents"), "id", "loaded_at", ["id", "title", "version_year"]), path)
    return objects.read_json(s, path, "id long, title string, version_year int")


@R.add("s10_canonical_sink", """
    WITH r AS (SELECT DISTINCT country || '-' || state || '-' || (id % 100) AS standard_id, country, state, version_year, id AS seq FROM source_documents)
    SELECT standard_id, country, state, version_year, seq AS seq_kept FROM r QUALIFY row_number() OVER (PARTITION BY standard_id ORDER BY seq DESC) = 1""")
def s10_canonical_sink(s: SparkSession, d: str) -> DataFrame:
    """Partitioned sink where the last record of an id wins."""
    rec = table(s, d, "source_documents").select(F.concat_ws("-", "country", "state", (F.col("id") % 100).cast("string")).alias("standard_id"),
                                                "country", "state", "version_year", F.col("id").alias("seq"), F.col("id").alias("seq_kept"))
    path = shared_path(s, "canonical")
    objects.write_canonical(rec, path)
    return s.read.schema("standard_id string, seq_kept long, country string, state string, version_year int").json(path).select(
        "standard_id", "country", "state", "version_year", "seq_kept")


@R.add("s12_named_parameters", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 100000""")
def s12_named_parameters(s: SparkSession, d: str) -> DataFrame:
    """Parameters by name, never spliced into the text."""
    return objects.statement(s, f"SELECT o_orderkey, o_totalprice FROM parquet.`{d}/orders.parquet` WHERE o_orderpriority = :p AND o_totalprice > :v",
                             p="1-URGENT", v=100000)


@R.add("s17_cache_keys", f"""
    WITH {CURRENT} SELECT id, state || '-' || substring(sha256(coalesce(title, '')), 1, 16) AS cache_key FROM docs""")
def s17_cache_keys(s: SparkSession, d: str) -> DataFrame:
    docs = first_delivery(table(s, d, "source_documents"), "id", "loaded_at", ["id", "state", "title"])
    return objects.content_key(docs, "state", "title").select("id", "cache_key")


@R.add("f5_provider_calls", """
    SELECT id, CASE WHEN good THEN upper(title) END AS answer, CASE WHEN NOT good THEN 'ValueError: no text' END AS error, CASE WHEN good THEN 1 ELSE 3 END AS attempts
    FROM (SELECT DISTINCT id, title, coalesce(regexp_matches(title, '\\p{L}'), false) AS good FROM source_documents)""")
def f5_provider_calls(s: SparkSession, d: str) -> DataFrame:
    """The provider hook with retries; this provider fails on texts without a letter."""

    def shout(x: str) -> str:
        if not x or not any(c.isalpha() for c in x):
            raise ValueError("no text")
        return x.upper()

    return providers.call_provider(table(s, d, "source_documents").select("id", "title").distinct(), "id", "title", shout)


@R.add("f6_embeddings", "SELECT id, [" + ", ".join(
    f"(length(t) - length(replace(t, '{c}', '')))::FLOAT" for c in "abcdefgh") + "] AS embedding FROM (SELECT DISTINCT id, lower(coalesce(title, '')) AS t FROM source_documents)")
def f6_embeddings(s: SparkSession, d: str) -> DataFrame:
    """the embedder hook, here with letter frequencies."""

    def letters(texts: list[str]) -> list[list[float]]:
        return [[float(t.lower().count(c)) for c in "abcdefgh"] for t in texts]

    return providers.embed(table(s, d, "source_documents").select("id", "title").distinct(), "id", "title", letters, 8)


QUERIES, SQL = R.queries, R.sql
