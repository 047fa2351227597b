"""Queries of the validation, reshaping and modification operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hierarq.common import current_version, table
from hierarq.functions import text
from hierarq.operators import canonical, snapshot
from hierarq.operators.ordered import numbered
from hierarq.operators.serve import first_delivery
from hierarq.plans.registry import CURRENT, Registry

R = Registry()
_C = """c AS (SELECT record_id, arg_min(payload, received_at) AS payload FROM canonical_records GROUP BY record_id),
    j AS (SELECT record_id, CASE WHEN json_valid(payload) THEN payload::JSON END AS p FROM c)"""


def _now() -> Column:
    """The time of the change: fixed here, so that the result can be checked."""
    return F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")


def _records(s: SparkSession, d: str) -> DataFrame:
    return first_delivery(table(s, d, "canonical_records").select("record_id", "payload", "received_at"), "record_id", "received_at")


def _cur(s: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    return current_version(table(s, d, name), columns=[*columns])


def _docs(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return first_delivery(table(s, d, "source_documents"), "id", "loaded_at", ["id", *columns])


_AUDIT = ("human_verified", "verified_at", "verified_by", "edited_at", "edited_by", "deleted", "deleted_at", "deleted_by")


@R.add("p10_standard_ids", """
    SELECT DISTINCT test_case_id, country || '-' || state || '-' || version_year || '-' || coalesce(domain_code || '-', '') || code
      || CASE WHEN coalesce(age_band, '') <> '' THEN '-' || age_band ELSE '' END AS standard_id FROM golden_elements WHERE code IS NOT NULL""")
def p10_standard_ids(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "golden_elements").where("code IS NOT NULL")
    return g.select("test_case_id", text.standard_id(*[F.col(c) for c in ("country", "state", "version_year", "domain_code", "code", "age_band")])
                    .alias("standard_id")).distinct()


_DOC_TEXT = "".join(f"""
    UNION ALL SELECT record_id, 'document.{f}', CASE WHEN json_type(d, '{f}') IS NULL THEN 'missing_field' ELSE 'invalid_type' END
    FROM x WHERE json_type(d) = 'OBJECT' AND (json_type(d, '{f}') IS NULL OR json_type(d, '{f}') <> 'VARCHAR' OR (d->>'{f}') = '')"""
                    for f in ("title", "source_url", "age_band", "publishing_agency"))


@R.add("p14_document_errors", f"""
    WITH {_C}, x AS (SELECT record_id, p->'document' AS d FROM j WHERE json_type(p) = 'OBJECT'),
    e AS (SELECT record_id, 'document.version_year' AS field_path,
      CASE WHEN json_type(d, 'version_year') IS NULL THEN 'missing_field' ELSE 'invalid_type' END AS error_type FROM x
      WHERE json_type(d) = 'OBJECT' AND (json_type(d, 'version_year') IS NULL OR json_type(d, 'version_year') NOT IN ('UBIGINT', 'BIGINT'))
      {_DOC_TEXT})
    SELECT * FROM e""")
def p14_document_errors(s: SparkSession, d: str) -> DataFrame:
    """The rules on the document part, one row per error."""
    got = canonical.validated(_records(s, d)).select("record_id", F.explode("errors").alias("e")).select("record_id", "e.*")
    return got.where("field_path LIKE 'document.%'").drop("message")


_TEXT_RULE = """
    SELECT record_id, '{p}.{f}' AS field_path, CASE WHEN json_type(v, '{f}') IS NULL THEN 'Missing required field: {p}.{f}'
      ELSE '{p}.{f} must be a non-empty string' END AS message, CASE WHEN json_type(v, '{f}') IS NULL THEN 'missing_field' ELSE 'invalid_type' END AS error_type
    FROM (SELECT record_id, {v} AS v FROM o) WHERE json_type(v) = 'OBJECT' AND (json_type(v, '{f}') IS NULL OR json_type(v, '{f}') <> 'VARCHAR' OR (v->>'{f}') = '')"""
_ABSENT = """
    SELECT record_id, '{p}' AS field_path, 'Missing required field: {p}' AS message, 'missing_field' AS error_type FROM {t} WHERE json_type({v}, '{f}') IS NULL"""
_ODD_LEVEL = """
    SELECT record_id, 'standard.{f}' AS field_path, 'standard.{f} must be {what}' AS message, 'invalid_type' AS error_type FROM st WHERE json_type(s, '{f}') NOT IN ({good})"""
_RULES = [
    "SELECT record_id, '$' AS field_path, 'record must be an object' AS message, 'invalid_type' AS error_type FROM j WHERE p IS NULL OR json_type(p) <> 'OBJECT'",
    *[_ABSENT.format(p=f, t="o", v="p", f=f) for f in ("country", "state", "document", "standard", "metadata")],
    *[f"SELECT record_id, '{f}', 'Field cannot be empty: {f}', 'invalid_type' FROM o WHERE json_type(p, '{f}') = 'NULL' OR (p->'{f}')::VARCHAR IN ('\"\"', '{{}}', '[]', '0', 'false')"
      for f in ("country", "state", "document", "standard", "metadata")],
    """SELECT record_id, 'country', 'country must be a two-letter ISO 3166-1 alpha-2 code', 'invalid_type' FROM o
       WHERE json_type(p, 'country') IS NOT NULL AND (json_type(p, 'country') <> 'VARCHAR' OR length((p->>'country')) <> 2)""",
    """SELECT record_id, 'country', 'country must be uppercase letters only', 'format' FROM o
       WHERE json_type(p, 'country') = 'VARCHAR' AND length(p->>'country') = 2 AND NOT regexp_matches((p->>'country'), '^[A-Z]{2}$')""",
    """SELECT record_id, 'state', 'state must be a non-empty string', 'invalid_type' FROM o
       WHERE json_type(p, 'state') IS NOT NULL AND (json_type(p, 'state') <> 'VARCHAR' OR (p->>'state') = '')""",
    *[f"SELECT record_id, '{f}', '{f} must be an object', 'invalid_type' FROM o WHERE json_type(p, '{f}') <> 'OBJECT'" for f in ("document", "standard", "metadata")],
    *[_TEXT_RULE.format(p="document", f=f, v="p->'document'") for f in ("title", "source_url", "age_band", "publishing_agency")],
    "SELECT record_id, 'document.version_year', 'Missing required field: document.version_year', 'missing_field' FROM dc WHERE json_type(d, 'version_year') IS NULL",
    """SELECT record_id, 'document.version_year', 'document.version_year must be an integer', 'invalid_type' FROM dc
       WHERE json_type(d, 'version_year') NOT IN ('UBIGINT', 'BIGINT', 'HUGEINT')""",
    _TEXT_RULE.format(p="standard", f="standard_id", v="p->'standard'"),
    *[_TEXT_RULE.format(p=f"standard.{n}", f=f, v=f"p->'standard'->'{n}'") for n in ("domain", "strand", "sub_strand") for f in ("code", "name")],
    _TEXT_RULE.format(p="standard.indicator", f="code", v="p->'standard'->'indicator'"),
    *[_ABSENT.format(p=f"standard.{f}", t="st", v="s", f=f) for f in ("domain", "indicator")],
    *[_ODD_LEVEL.format(f=f, what="an object", good="'OBJECT'") for f in ("domain", "indicator")],
    *[_ODD_LEVEL.format(f=f, what="an object or null", good="'OBJECT', 'NULL'") for f in ("strand", "sub_strand")],
    *[f"""SELECT record_id, 'standard.indicator.{f}', 'standard.indicator.{f} must be a string or null', 'invalid_type' FROM st
          WHERE json_type(s->'indicator', '{f}') NOT IN ('VARCHAR', 'NULL')""" for f in ("description", "name")],
]
_P14 = f"""{_C}, o AS (SELECT * FROM j WHERE json_type(p) = 'OBJECT'), dc AS (SELECT record_id, p->'document' AS d FROM o WHERE json_type(p->'document') = 'OBJECT'),
    st AS (SELECT record_id, p->'standard' AS s FROM o WHERE json_type(p->'standard') = 'OBJECT'),
    e AS ({' UNION ALL '.join(_RULES)})"""


@R.add("p14_errors", f"WITH {_P14} SELECT * FROM e")
def p14_errors(s: SparkSession, d: str) -> DataFrame:
    """Every rule every record breaks, with its message."""
    return canonical.validated(_records(s, d)).select("record_id", F.explode("errors").alias("e")).select("record_id", "e.*")


@R.add("p15_split", f"""
    WITH {_P14}, n AS (SELECT record_id, count(*) AS n FROM e GROUP BY record_id)
    SELECT n IS NULL AS is_valid, count(*) AS records, coalesce(sum(n), 0)::BIGINT AS errors FROM c LEFT JOIN n USING (record_id) GROUP BY ALL""")
def p15_split(s: SparkSession, d: str) -> DataFrame:
    """Valid and invalid records by state of the payload."""
    v = canonical.validated(_records(s, d))
    return v.groupBy((F.size("errors") == 0).alias("is_valid")).agg(F.count("*").alias("records"), F.sum(F.size("errors")).alias("errors"))


@R.add("p16_not_unique", f"""
    WITH {_C}, k AS (SELECT record_id, p->>'country' AS c, p->>'state' AS s, p->'document'->>'version_year' AS y, p->'standard'->>'standard_id' AS i FROM j
      WHERE json_type(p) = 'OBJECT' AND json_type(p->'document') = 'OBJECT' AND json_type(p->'standard') = 'OBJECT'),
    old AS (SELECT DISTINCT c, s, y, i FROM k WHERE record_id % 3 = 0 AND c IS NOT NULL AND s IS NOT NULL AND y IS NOT NULL AND i IS NOT NULL)
    SELECT record_id, 'standard.standard_id' AS field_path, 'Duplicate standard_id: ' || i || ' for country=' || c || ', state=' || s || ', year=' || y AS message,
      'uniqueness' AS error_type FROM k JOIN old USING (c, s, y, i) WHERE c <> '' AND s <> '' AND i <> '' AND y NOT IN ('', '0')""")
def p16_not_unique(s: SparkSession, d: str) -> DataFrame:
    """Records whose id is stored already get a uniqueness error; every third record stands in for the stored ones."""
    records = _records(s, d)
    get = lambda *path: F.try_variant_get(F.try_parse_json("payload"), "$." + ".".join(path), "string")
    stored = records.where("record_id % 3 = 0").select(get("country").alias("country"), get("state").alias("state"), get("document", "version_year")
                                                      .alias("version_year"), get("standard", "standard_id").alias("standard_id"))
    errors = canonical.validated(records, stored).select("record_id", F.explode("errors").alias("e")).select("record_id", "e.*")
    return errors.where("error_type = 'uniqueness'")


def _flat(s: SparkSession, d: str) -> DataFrame:
    e = first_delivery(table(s, d, "detected_elements"), "element_id", "detected_at", [
        "element_id", "document_s3_key", "level", "code", "title", "description", "age_band", "source_page", "source_text"])
    e = e.where("level = 'indicator' AND code IS NOT NULL")
    docs = _docs(s, d, "country", "state", "title", "version_year", "source_url", "publishing_agency", "age_band", "s3_key").where("s3_key IS NOT NULL")
    one = docs.groupBy("s3_key").agg(F.min_by(F.struct("country", "state", "title", "version_year", "source_url", "publishing_agency",
                                                       F.col("age_band").alias("document_age_band")), "id").alias("o"))
    j = e.join(one, e.document_s3_key == one.s3_key).select("element_id", "code", F.col("title").alias("indicator_name"),
                                                            "description", "age_band", "source_page", "source_text", "o.*")
    part = F.split("code", "\\.")
    return j.select("country", "state", "title", "version_year", "source_url", "publishing_agency", "document_age_band", "age_band",
                    "source_page", "source_text", part[0].alias("domain_code"), F.concat(F.lit("Domain "), part[0]).alias("domain_name"),
                    F.concat_ws(".", part[0], part[1]).alias("strand_code"), F.lit("").alias("strand_name"),
                    F.lit(None).cast("string").alias("sub_strand_code"), F.lit(None).cast("string").alias("sub_strand_name"),
                    F.col("code").alias("indicator_code"), "indicator_name", F.col("description").alias("indicator_description"),
                    F.concat(F.lit("E-"), F.col("element_id").cast("string")).alias("standard_id"))


@R.add("p11_canonical", """
    WITH e AS (SELECT * FROM detected_elements QUALIFY row_number() OVER (PARTITION BY element_id ORDER BY detected_at) = 1),
    docs AS (SELECT * FROM source_documents QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1),
    o AS (SELECT * FROM docs WHERE s3_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY s3_key ORDER BY id) = 1)
    SELECT 'E-' || e.element_id AS standard_id, CAST(json_merge_patch('{}', json_object('country', o.country, 'state', o.state,
      'document', json_object('title', coalesce(nullif(o.title, ''), o.state || ' Early Learning Standards'), 'version_year', o.version_year, 'source_url', coalesce(o.source_url, ''),
        'age_band', coalesce(nullif(e.age_band, ''), nullif(o.age_band, ''), 'PK'), 'publishing_agency', coalesce(o.publishing_agency, '')),
      'standard', json_object('standard_id', 'E-' || e.element_id, 'domain', CASE WHEN split_part(e.code, '.', 1) <> '' THEN json_object('code', split_part(e.code, '.', 1), 'name', 'Domain ' || split_part(e.code, '.', 1)) END,
        'indicator', json_object('code', e.code, 'name', nullif(e.title, ''), 'description', coalesce(nullif(e.description, ''), nullif(e.title, ''), ''))),
      'metadata', json_object('page_number', coalesce(e.source_page, 1), 'source_text', coalesce(e.source_text, '')))) AS VARCHAR) AS payload
    FROM e JOIN o ON o.s3_key = e.document_s3_key WHERE e.level = 'indicator' AND e.code IS NOT NULL""")
def p11_canonical(s: SparkSession, d: str) -> DataFrame:
    """Flat rows as canonical JSON."""
    return canonical.serialised(canonical.to_canonical(_flat(s, d)))


@R.add("p13_roundtrip", """
    WITH e AS (SELECT * FROM detected_elements QUALIFY row_number() OVER (PARTITION BY element_id ORDER BY detected_at) = 1),
    docs AS (SELECT * FROM source_documents QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1),
    o AS (SELECT * FROM docs WHERE s3_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY s3_key ORDER BY id) = 1)
    SELECT 'E-' || e.element_id AS standard_id, coalesce(nullif(e.age_band, ''), nullif(o.age_band, ''), 'PK') AS age_band,
      split_part(e.code, '.', 1) AS domain_code, coalesce(nullif(e.description, ''), nullif(e.title, ''), '') AS description,
      coalesce(e.source_page, 1) AS page_number FROM e JOIN o ON o.s3_key = e.document_s3_key
    WHERE e.level = 'indicator' AND e.code IS NOT NULL""")
def p13_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """To JSON and back."""
    back = canonical.deserialised(canonical.serialised(canonical.to_canonical(_flat(s, d))))
    return back.select("standard.standard_id", "document.age_band", F.col("standard.domain.code").alias("domain_code"),
                       "standard.indicator.description", "metadata.page_number")


@R.add("m1_upsert_documents", f"""
    WITH {CURRENT}, ch AS (SELECT country, state, version_year, title, 'https://new/' || id AS source_url,
      CASE WHEN id % 2 = 0 THEN 'new/' || id END AS s3_key FROM docs WHERE state = 'CA'
      QUALIFY row_number() OVER (PARTITION BY country, state, version_year, title ORDER BY id DESC) = 1)
    SELECT o.id, o.title, coalesce(ch.source_url, o.source_url) AS source_url, coalesce(ch.s3_key, o.s3_key) AS s3_key
    FROM docs o LEFT JOIN ch USING (country, state, version_year, title)
    UNION ALL SELECT NULL, 'Brand New', 'https://x', NULL""")
def m1_upsert_documents(s: SparkSession, d: str) -> DataFrame:
    """M1: document upsert; the url is overwritten, the key kept where the new one is null."""
    docs = _docs(s, d, "country", "state", "version_year", "title", "source_url", "s3_key")
    key = ["country", "state", "version_year", "title"]
    ch = docs.where("state = 'CA'").select(*key, F.concat(F.lit("https://new/"), "id").alias("source_url"),
                                          F.when(F.col("id") % 2 == 0, F.concat(F.lit("new/"), "id")).alias("s3_key"), F.col("id").alias("seq"))
    new = s.createDataFrame([("US", "ZZ", 2030, "Brand New", "https://x", None, 0)], ch.schema)
    return snapshot.upsert(docs, ch.unionByName(new), key, ["source_url"], ["s3_key"], seq="seq").select(
        "id", "title", "source_url", "s3_key")


@R.add("m2_m3_upsert_levels", f"""
    WITH {CURRENT}, ch AS (SELECT domain_id, code, 'N' || max(id) AS name FROM cur_strands WHERE deleted AND domain_id IS NOT NULL GROUP BY ALL)
    SELECT t.id, coalesce(ch.name, t.name) AS name, t.human_verified FROM cur_strands t LEFT JOIN ch
      ON ch.domain_id = t.domain_id AND ch.code = t.code""")
def m2_m3_upsert_levels(s: SparkSession, d: str) -> DataFrame:
    """M2 M3: natural keys; ids and audit columns stay."""
    st = _cur(s, d, "strands", "domain_id", "code", "name", "human_verified", "deleted")
    ch = st.where("deleted AND domain_id IS NOT NULL").groupBy("domain_id", "code").agg(F.concat(F.lit("N"), F.max("id")).alias("name"))
    return snapshot.upsert(st, ch, ["domain_id", "code"], ["name"]).select("id", "name", "human_verified")


@R.add("m4_inserted", """
    SELECT vec_id, label FROM embeddings UNION ALL SELECT vec_id + 1000000, label FROM embeddings WHERE label = 1""")
def m4_inserted(s: SparkSession, d: str) -> DataFrame:
    """M4 M8 M16."""
    e = table(s, d, "embeddings").select("vec_id", "label")
    return snapshot.insert(e, e.where("label = 1").withColumn("vec_id", F.col("vec_id") + 1000000))


@R.add("m10_soft_deleted", f"""
    WITH {CURRENT} SELECT id, CASE WHEN NOT deleted AND human_verified THEN true ELSE deleted END AS deleted,
      CASE WHEN NOT deleted AND human_verified THEN 'clerk' ELSE deleted_by END AS deleted_by FROM cur_subs""")
def m10_soft_deleted(s: SparkSession, d: str) -> DataFrame:
    return snapshot.soft_delete(_cur(s, d, "sub_strands", "human_verified", "deleted", "deleted_at", "deleted_by"), F.col("human_verified"), "clerk", _now()).select("id", "deleted", "deleted_by")


@R.add("m11_hard_deleted", f"WITH {CURRENT} SELECT id, code FROM cur_domains WHERE NOT deleted")
def m11_hard_deleted(s: SparkSession, d: str) -> DataFrame:
    return snapshot.hard_delete(_cur(s, d, "domains", "code", "deleted"), F.col("deleted")).select("id", "code")


_IND = """ind AS (SELECT u.id + 1000000000 AS id, s.domain_id, CASE WHEN u.id % 3 <> 0 THEN u.strand_id END AS strand_id, u.id AS sub_strand_id
      FROM cur_subs u LEFT JOIN cur_strands s ON s.id = u.strand_id)"""


@R.add("m12_cascade", f"""
    WITH {CURRENT}, {_IND}, d AS (SELECT id FROM cur_domains WHERE display_order = 1 AND NOT deleted), s AS (SELECT id FROM cur_strands WHERE domain_id IN (SELECT id FROM d))
    SELECT 'indicator' AS level, id, coalesce(domain_id IN (SELECT id FROM d), false) AS deleted,
      CASE WHEN domain_id IN (SELECT id FROM d) THEN 'clerk' END AS deleted_by FROM ind
    UNION ALL SELECT 'domain' AS level, id, deleted OR coalesce(display_order = 1, false) AS deleted,
      CASE WHEN NOT deleted AND display_order = 1 THEN 'clerk' ELSE deleted_by END AS deleted_by FROM cur_domains
    UNION ALL SELECT 'strand', id, deleted OR id IN (SELECT id FROM s), CASE WHEN NOT deleted AND id IN (SELECT id FROM s) THEN 'clerk'
      ELSE deleted_by END FROM cur_strands
    UNION ALL SELECT 'sub_strand', id, deleted OR coalesce(strand_id IN (SELECT id FROM s), false), CASE WHEN NOT deleted
      AND strand_id IN (SELECT id FROM s) THEN 'clerk' ELSE deleted_by END FROM cur_subs""")
def m12_cascade(s: SparkSession, d: str) -> DataFrame:
    """Domains with everything below."""
    return _cascade(s, d, "domain", F.col("display_order") == 1)


@R.add("m13_cascade_strand", f"""
    WITH {CURRENT}, {_IND}, s AS (SELECT id FROM cur_strands WHERE contains(code, '.1') AND NOT deleted)
    SELECT 'indicator' AS level, id, coalesce(strand_id IN (SELECT id FROM s), false) AS deleted,
      CASE WHEN strand_id IN (SELECT id FROM s) THEN 'clerk' END AS deleted_by FROM ind
    UNION ALL SELECT 'domain', id, deleted, deleted_by FROM cur_domains
    UNION ALL SELECT 'strand', id, deleted OR id IN (SELECT id FROM s), CASE WHEN id IN (SELECT id FROM s) THEN 'clerk' ELSE deleted_by END FROM cur_strands
    UNION ALL SELECT 'sub_strand', id, deleted OR coalesce(strand_id IN (SELECT id FROM s), false), CASE WHEN NOT deleted
      AND strand_id IN (SELECT id FROM s) THEN 'clerk' ELSE deleted_by END FROM cur_subs""")
def m13_cascade_strand(s: SparkSession, d: str) -> DataFrame:
    """Strands; indicators of their sub-strands that name no strand stay."""
    return _cascade(s, d, "strand", F.col("code").contains(".1"))


@R.add("m13_cascade_sub_strand", f"""
    WITH {CURRENT}, {_IND}, u AS (SELECT id FROM cur_subs WHERE contains(code, '.2') AND NOT deleted)
    SELECT 'indicator' AS level, id, coalesce(sub_strand_id IN (SELECT id FROM u), false) AS deleted,
      CASE WHEN sub_strand_id IN (SELECT id FROM u) THEN 'clerk' END AS deleted_by FROM ind
    UNION ALL SELECT 'domain', id, deleted, deleted_by FROM cur_domains UNION ALL SELECT 'strand', id, deleted, deleted_by FROM cur_strands
    UNION ALL SELECT 'sub_strand', id, deleted OR id IN (SELECT id FROM u), CASE WHEN id IN (SELECT id FROM u) THEN 'clerk' ELSE deleted_by END FROM cur_subs""")
def m13_cascade_sub_strand(s: SparkSession, d: str) -> DataFrame:
    return _cascade(s, d, "sub_strand", F.col("code").contains(".2"))


def _cascade(s: SparkSession, d: str, level: str, which: Column) -> DataFrame:
    """All four levels after a cascade. Indicators stand in for by one per sub-strand, of which every third
    names no strand."""
    flags = ("deleted", "deleted_at", "deleted_by")
    subs = _cur(s, d, "sub_strands", "strand_id", "code", *flags)
    strands = _cur(s, d, "strands", "domain_id", "code", *flags)
    by_strand = strands.select(F.col("id").alias("strand_id"), "domain_id")
    ind = subs.select("id", "strand_id").join(by_strand, "strand_id", "left").select(
        (F.col("id") + 1_000_000_000).alias("id"), "domain_id", F.when(F.col("id") % 3 != 0, F.col("strand_id")).alias("strand_id"),
        F.col("id").alias("sub_strand_id"), F.lit(False).alias("deleted"), F.lit(None).cast("timestamp_ntz").alias("deleted_at"),
        F.lit(None).cast("string").alias("deleted_by"))
    tables = {"domain": _cur(s, d, "domains", "display_order", "code", *flags), "strand": strands, "sub_strand": subs, "indicator": ind}
    parts = snapshot.cascade_delete(tables, level, which, "clerk", _now())
    return reduce(DataFrame.unionByName, [p.select(F.lit(n).alias("level"), "id", "deleted", "deleted_by") for n, p in parts.items()])


@R.add("m14_verify_toggle", f"""
    WITH {CURRENT} SELECT id, CASE WHEN document_id % 2 = 0 THEN true ELSE human_verified END AS human_verified,
      CASE WHEN document_id % 2 = 0 THEN 'clerk' ELSE verified_by END AS verified_by,
      CASE WHEN document_id % 2 = 0 THEN false ELSE human_verified END AS after_off FROM cur_domains""")
def m14_verify_toggle(s: SparkSession, d: str) -> DataFrame:
    own = F.col("document_id") % 2 == 0
    on = snapshot.verify(_cur(s, d, "domains", "document_id", *_AUDIT), own, True, "clerk", _now())
    off = snapshot.verify(on, own, False, "clerk", _now()).select("id", F.col("human_verified").alias("after_off"))
    return on.join(off, "id").select("id", "human_verified", "verified_by", "after_off")


@R.add("m9_m15_edited", f"""
    WITH {CURRENT} SELECT id, CASE WHEN starts_with(code, 'SC') THEN upper(name) ELSE name END AS name,
      CASE WHEN starts_with(code, 'SC') THEN 'clerk' ELSE edited_by END AS edited_by,
      strftime(CASE WHEN starts_with(code, 'SC') THEN TIMESTAMP '2025-01-01' ELSE edited_at END, '%Y-%m-%d') AS edited_on FROM cur_domains""")
def m9_m15_edited(s: SparkSession, d: str) -> DataFrame:
    return snapshot.edit(_cur(s, d, "domains", "code", "name", *_AUDIT), F.col("code").startswith("SC"), {"name": F.upper("name")}, "clerk", _now()).select(
        "id", "name", "edited_by", F.date_format("edited_at", "yyyy-MM-dd").alias("edited_on"))


@R.add("m17_reordered", f"""
    WITH {CURRENT}, w AS (SELECT document_id FROM cur_domains GROUP BY document_id ORDER BY count(*) DESC, document_id LIMIT 1),
    p AS (SELECT id, row_number() OVER (ORDER BY code DESC, id) - 1 AS place FROM cur_domains WHERE document_id = (SELECT document_id FROM w))
    SELECT d.id, coalesce(p.place, d.display_order)::INT AS display_order FROM cur_domains d LEFT JOIN p USING (id)""")
def m17_reordered(s: SparkSession, d: str) -> DataFrame:
    """The largest document's domains are put in a new order."""
    dom = _cur(s, d, "domains", "document_id", "code", "display_order")
    top = dom.groupBy("document_id").count().orderBy(F.desc("count"), "document_id").limit(1)
    own = dom.join(F.broadcast(top.select(F.col("document_id").alias("_top"))), F.col("document_id") == F.col("_top"))
    places = numbered(own.select("document_id", "code", "id"), ["document_id"], [(F.col("code"), "desc"), F.col("id")])
    return snapshot.reorder(dom, places.select("document_id", "id", (F.col("place") - 1).alias("place"))).select("id", "display_order")


@R.add("m20_backfilled", f"""
    WITH {CURRENT} SELECT id, CASE WHEN s3_key IS NULL AND NOT contains(coalesce(source_url, '://'), '://') THEN source_url ELSE s3_key END AS s3_key FROM docs""")
def m20_backfilled(s: SparkSession, d: str) -> DataFrame:
    docs = _docs(s, d, "s3_key", "source_url")
    fill = F.col("s3_key").isNull() & ~F.coalesce("source_url", F.lit("://")).contains("://")
    return docs.select("id", F.when(fill, F.col("source_url")).otherwise(F.col("s3_key")).alias("s3_key"))


@R.add("m19_patched_tree", f"""
    WITH {CURRENT} SELECT domain_id, list(CASE WHEN code LIKE '%.1' THEN upper(name) ELSE name END ORDER BY code, id) AS names
    FROM cur_strands WHERE NOT deleted AND domain_id IS NOT NULL AND name <> 'Number Sense' GROUP BY domain_id""")
def m19_patched_tree(s: SparkSession, d: str) -> DataFrame:
    """Nested nodes patched and dropped in place by array functions."""
    st = _cur(s, d, "strands", "deleted", "domain_id", "code", "name").where("NOT deleted AND domain_id IS NOT NULL")
    tree = st.groupBy("domain_id").agg(F.array_sort(F.collect_list(F.struct("code", "id", "name"))).alias("t"))
    kept = F.filter("t", lambda x: x["name"] != "Number Sense")
    named = F.transform(kept, lambda x: F.when(x["code"].like("%.1"), F.upper(x["name"])).otherwise(x["name"]))
    return tree.select("domain_id", named.alias("names")).where(F.size("names") > 0)


@R.add("p27_checked_rows", f"""
    WITH {CURRENT} SELECT id, regexp_matches(country, '^[A-Z]{{2}}$') AND version_year BETWEEN 2000 AND 2100 AS passes,
      length(title) <= 255 AS fits FROM docs""")
def p27_checked_rows(s: SparkSession, d: str) -> DataFrame:
    """P27 and the length and range rules of the data model."""
    docs = _docs(s, d, "country", "version_year", "title")
    return docs.select("id", (F.col("country").rlike("^[A-Z]{2}$") & F.col("version_year").between(2000, 2100)).alias("passes"),
                       (F.length("title") <= 255).alias("fits"))


@R.add("s2_object_keys", f"""
    WITH {CURRENT} SELECT id, concat_ws('/', country, state, version_year::VARCHAR, 'doc-' || id || '.pdf') AS raw_key,
      concat_ws('/', country, state, version_year::VARCHAR, 'intermediate', 'detect', 'run-' || id || '.json') AS stage_key FROM docs""")
def s2_object_keys(s: SparkSession, d: str) -> DataFrame:
    """Keys of raw and intermediate objects."""
    docs = _docs(s, d, "country", "state", "version_year")
    c, st, y = F.concat(F.lit("/"), "country"), F.concat("state", F.lit("/")), F.col("version_year")
    return docs.select("id", text.object_key(c, st, y, F.concat(F.lit("doc-"), "id", F.lit(".pdf"))).alias("raw_key"), text.object_key(
        c, st, y, F.lit("intermediate"), F.lit("detect"), F.concat(F.lit("run-"), "id", F.lit(".json"))).alias("stage_key"))


@R.add("s1_accepted_files", f"""
    WITH {CURRENT} SELECT id, coalesce(regexp_extract(lower(s3_key), '\\.[^.]+$') IN ('.pdf', '.html'), false) AS accepted FROM docs""")
def s1_accepted_files(s: SparkSession, d: str) -> DataFrame:
    docs = _docs(s, d, "s3_key")
    return docs.select("id", F.coalesce(F.regexp_extract(F.lower("s3_key"), "\\.[^.]+$", 0).isin(".pdf", ".html"), F.lit(False)).alias("accepted"))


QUERIES, SQL = R.queries, R.sql
