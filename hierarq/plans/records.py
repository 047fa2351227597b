"""Queries of the record operators (problems 3, 5, 6) on their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hierarq.common import kept, staged, table
from hierarq.operators import hierarchy, references, shred


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return references.broken_references(*(table(spark, d, t) for t in ("domains", "strands", "sub_strands", "golden_elements")))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return references.reference_report(p3_found(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return shred.array_elements(table(spark, d, "canonical_records"))


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    """The node table, made once for all queries on the same files."""
    return kept(spark, f"{d}/canonical_records.parquet", "nodes", lambda: shred.nodes(table(spark, d, "canonical_records")))


def _paths(spark: SparkSession, d: str) -> DataFrame:
    return kept(spark, f"{d}/canonical_records.parquet", "object-paths", lambda: staged(shred.object_paths(_nodes(spark, d)), "object-paths"))


def p5_nodes(spark: SparkSession, d: str) -> DataFrame:
    return _nodes(spark, d).drop("chain")


def p5_objects(spark: SparkSession, d: str) -> DataFrame:
    """All entities of the data, also those without a table of their own below."""
    return shred.objects(_nodes(spark, d), _paths(spark, d))


#: Names of the tables of the entities of the canonical schema; their columns come from the data.
ENTITIES = {
    "p5_roots": "$", "p5_documents": "$.document", "p5_standards": "$.standard", "p5_domains": "$.standard.domain",
    "p5_strands": "$.standard.strand", "p5_sub_strands": "$.standard.sub_strand", "p5_indicators": "$.standard.indicator",
    "p5_domain_attachments": "$.standard.domain.attachments", "p5_strand_attachments": "$.standard.strand.attachments",
    "p5_sub_strand_attachments": "$.standard.sub_strand.attachments", "p5_indicator_attachments": "$.standard.indicator.attachments",
    "p5_metadata": "$.metadata", "p5_crosswalks": "$.metadata.crosswalks", "p5_frameworks": "$.metadata.crosswalks.framework",
    "p5_contacts": "$.metadata.crosswalks.framework.contact", "p5_targets": "$.metadata.crosswalks.framework.targets",
    "p5_reviews": "$.metadata.reviews", "p5_comments": "$.metadata.reviews.comments", "p5_replies": "$.metadata.reviews.comments.replies",
    "p5_histories": "$.metadata.history", "p5_revisions": "$.metadata.history.revisions",
    "p5_changes": "$.metadata.history.revisions.changes", "p5_evidence": "$.metadata.history.revisions.changes.evidence",
}


def _entity(name: str):  # noqa: ANN202
    def run(spark: SparkSession, d: str) -> DataFrame:
        return shred.entity(_nodes(spark, d), _paths(spark, d), name)

    return run


def p5_lists(spark: SparkSession, d: str) -> DataFrame:
    return shred.scalar_lists(_nodes(spark, d), _paths(spark, d))


def _full(spark: SparkSession, d: str, below: bool = True) -> DataFrame:
    return hierarchy.hierarchies(table(spark, d, "golden_elements").where(F.col("state") == "CA"), below=below)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.circles(_full(spark, d, below=False))


def p6_paths(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.paths(_full(spark, d))


def p6_descendants(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.descendants(_full(spark, d))


QUERIES = {
    "p3_found": p3_found, "p3_report": p3_report, "p5_found": p5_found, "p5_nodes": p5_nodes,
    **{table_name: _entity(name) for table_name, name in ENTITIES.items()}, "p5_objects": p5_objects,
    "p5_lists": p5_lists, "p6_found": p6_found, "p6_paths": p6_paths, "p6_descendants": p6_descendants,
}

_CODE = "nullif(upper(regexp_replace({0}, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g')), '')"
_P3 = f"""
    WITH dv AS (SELECT id, arg_max(deleted, loaded_at) AS gone, min(loaded_at) AS first_at FROM domains GROUP BY id),
    sv AS (SELECT id, arg_max(deleted, loaded_at) AS gone, min(loaded_at) AS first_at, max(loaded_at) AS loaded_at
           FROM strands GROUP BY id),
    sc AS (SELECT DISTINCT s.id, s.domain_id, s.loaded_at FROM strands s JOIN sv USING (id, loaded_at) WHERE NOT s.deleted),
    uv AS (SELECT id, max(loaded_at) AS loaded_at FROM sub_strands GROUP BY id),
    uc AS (SELECT DISTINCT s.id, s.strand_id, s.loaded_at FROM sub_strands s JOIN uv USING (id, loaded_at) WHERE NOT s.deleted),
    g AS (SELECT set_id, state, test_case_id, {_CODE.format('code')} AS c, {_CODE.format('parent_code')} AS p, loaded_at
          FROM golden_elements),
    gp AS (SELECT set_id, c, min(loaded_at) AS first_at FROM g GROUP BY ALL),
    every AS (
      SELECT 'strands' AS table_name, c.id::VARCHAR AS row_key, c.loaded_at, p.id IS NULL AS missing, p.gone, p.first_at
      FROM sc c LEFT JOIN dv p ON p.id = c.domain_id WHERE c.domain_id IS NOT NULL
      UNION ALL
      SELECT 'sub_strands', c.id::VARCHAR, c.loaded_at, p.id IS NULL, p.gone, p.first_at
      FROM uc c LEFT JOIN sv p ON p.id = c.strand_id WHERE c.strand_id IS NOT NULL
      UNION ALL
      SELECT 'golden_elements', g.test_case_id, g.loaded_at, gp.c IS NULL, false, gp.first_at
      FROM g LEFT JOIN gp ON gp.set_id = g.set_id AND gp.c = g.p WHERE g.state = 'AZ' AND g.p IS NOT NULL),
    p3 AS (SELECT DISTINCT table_name, strftime(loaded_at, '%Y-%m') AS period, row_key,
           CASE WHEN missing THEN 'missing' WHEN gone THEN 'deleted' ELSE 'late' END AS reason
    FROM every WHERE missing OR gone OR first_at > loaded_at)"""
_P6 = f"""
    WITH RECURSIVE n AS (
      SELECT set_id, c, min(p) AS p FROM (SELECT set_id, {_CODE.format('code')} AS c, {_CODE.format('parent_code')} AS p
      FROM golden_elements WHERE state = 'CA') WHERE c IS NOT NULL GROUP BY ALL),
    e AS (SELECT n.set_id, n.c, q.c AS p FROM n LEFT JOIN n q ON q.set_id = n.set_id AND q.c = n.p),
    up AS (SELECT set_id, c AS start, p AS ahead FROM e WHERE p IS NOT NULL
      UNION SELECT up.set_id, up.start, e.p FROM up JOIN e ON e.set_id = up.set_id AND e.c = up.ahead WHERE e.p IS NOT NULL AND up.ahead <> up.start),
    circ AS (SELECT DISTINCT set_id, start FROM up WHERE ahead = start),
    tree AS (SELECT set_id, c, [c] AS line FROM e WHERE p IS NULL
      UNION ALL SELECT e.set_id, e.c, list_append(tree.line, e.c) FROM tree JOIN e ON e.set_id = tree.set_id AND e.p = tree.c),
    free AS (SELECT e.* FROM e ANTI JOIN circ ON circ.set_id = e.set_id AND circ.start = e.c),
    below AS (SELECT set_id, p AS code, c AS descendant, 1 AS distance FROM free WHERE p IS NOT NULL AND EXISTS (SELECT 1 FROM free f WHERE f.set_id = free.set_id AND f.c = free.p)
      UNION ALL SELECT b.set_id, b.code, f.c, b.distance + 1 FROM below b JOIN free f ON f.set_id = b.set_id AND f.p = b.descendant)"""
_INNER = "TRY_CAST(trim({0}->>'$') AS JSON)"
_EMBEDDED = f"CASE WHEN json_type({{0}}) = 'VARCHAR' AND starts_with(trim({{0}}->>'$'), '{{{{') AND json_type({_INNER}) = 'OBJECT' THEN {_INNER} ELSE {{0}} END"
#: Every value of every payload with the steps that lead to it: text, whether it is an element of an array, and
#: the field of a lone object. ``names`` are fields that hold lone objects here and arrays of objects there.
_P5 = f"""
    WITH RECURSIVE r AS (SELECT record_id, TRY_CAST(arg_min(payload, received_at) AS JSON) AS p FROM canonical_records WHERE payload IS NOT NULL AND record_id IS NOT NULL GROUP BY record_id),
    w AS (SELECT record_id, {_EMBEDDED.format('p')} AS v, NULL::VARCHAR AS label, NULL::BIGINT AS ordinal, []::STRUCT(t VARCHAR, e BOOLEAN, l VARCHAR)[] AS steps FROM r
      UNION ALL SELECT record_id, v, label, ordinal, list_append(steps, {{'t': coalesce('.' || k, '[' || o || ']'), 'e': k IS NULL AND json_type(v) = 'OBJECT',
        'l': CASE WHEN k IS NOT NULL AND json_type(v) = 'OBJECT' THEN label END}}) FROM (
        SELECT record_id, k, o, {_EMBEDDED.format('x')} AS v, CASE WHEN k IS NOT NULL THEN k WHEN ordinal IS NULL THEN label END AS label, o AS ordinal, steps FROM (
          SELECT record_id, steps, label, ordinal, c.k AS k, c.o AS o, CASE WHEN c.k IS NOT NULL THEN json_extract(v, '$."' || c.k || '"') ELSE json_extract(v, '$[' || c.o || ']') END AS x
          FROM (SELECT *, unnest(CASE json_type(v) WHEN 'OBJECT' THEN list_transform(json_keys(v), lambda a: {{'k': a, 'o': NULL::BIGINT}})
            WHEN 'ARRAY' THEN list_transform(range(json_array_length(v)::BIGINT), lambda a: {{'k': NULL::VARCHAR, 'o': a}}) END) AS c FROM w WHERE json_type(v) IN ('OBJECT', 'ARRAY'))))),
    names AS (SELECT coalesce(list(DISTINCT label), []) AS names FROM w WHERE json_type(v) = 'OBJECT' AND ordinal IS NULL AND label IN (
      SELECT label FROM w WHERE json_type(v) = 'OBJECT' AND ordinal IS NOT NULL)),
    x AS (SELECT record_id, v, label, ordinal, len(steps) AS n, list_transform(steps, lambda s: s.e OR coalesce(list_contains(names, s.l), false)) AS el,
      list_transform(steps, lambda s: s.t || CASE WHEN NOT s.e AND coalesce(list_contains(names, s.l), false) THEN '[0]' ELSE '' END) AS piece, steps FROM w, names WHERE len(steps) > 0)"""
#: Scalar fields of the entities in the checked tables, for the SQL alone: the operator finds them in the data.
_FIELDS = {
    "p5_roots": "country state", "p5_documents": "age_band publishing_agency source_url title version_year", "p5_standards": "standard_id",
    **dict.fromkeys(("p5_domains", "p5_strands", "p5_sub_strands", "p5_indicators"), "code description name"),
    **dict.fromkeys(("p5_domain_attachments", "p5_strand_attachments", "p5_sub_strand_attachments", "p5_indicator_attachments"), "label page"),
    "p5_metadata": "page_number source_text", "p5_crosswalks": "", "p5_frameworks": "name", "p5_contacts": "office", "p5_targets": "code weight",
    "p5_reviews": "id role score", "p5_comments": "author text", "p5_replies": "author text", "p5_histories": "owner", "p5_revisions": "on rev",
    "p5_changes": "field from to", "p5_evidence": "page quote",
}


def _entity_sql(table_name: str) -> str:
    field = ENTITIES[table_name][1:]
    cells = "".join(f""", CASE WHEN json_type(v, '{f}') NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN v->>'{f}' END AS "{f}\"""" for f in _FIELDS[table_name].split())
    if not field:
        return f"{_P5} SELECT record_id, '$' AS node_path, NULL::VARCHAR AS parent_path{cells} FROM w WHERE len(steps) = 0 AND json_type(v) IN ('OBJECT', 'ARRAY')"
    path = "array_to_string(list_transform(list_filter(steps, lambda s: starts_with(s.t, '.')), lambda s: s.t), '')"
    met = f"regexp_full_match({path}, '{field.replace('.replies', '').replace('.', '[.]')}([.]replies)+')" if field.endswith(".replies") else f"{path} = '{field}'"
    return f"""{_P5} SELECT record_id, '$' || array_to_string(piece, '') AS node_path, '$' || array_to_string(piece[1:coalesce(list_max(list_filter(range(1, n), lambda i: el[i])), 0)], '')
      AS parent_path{cells} FROM x WHERE json_type(v) = 'OBJECT' AND {met}"""


SQL = {
    **{name: _entity_sql(name) for name in ENTITIES},
    "p5_found": _P5 + """
    SELECT DISTINCT record_id, '$' || array_to_string(piece[1:coalesce(list_max(list_filter(range(1, n), lambda i: el[i])), 0)], '') AS parent_path,
      '$' || array_to_string(piece, '') AS node_path FROM x WHERE el[n]""",
    "p5_lists": _P5 + """
    SELECT record_id, '$' || array_to_string(piece[1:n - 2], '') AS parent_path, label, ordinal::INT AS ordinal, v->>'$' AS scalar FROM x
    WHERE ordinal IS NOT NULL AND json_type(v) NOT IN ('OBJECT', 'ARRAY', 'NULL') AND (n < 2 OR NOT starts_with(steps[n - 1].t, '[')) AND n >= 2""",
    "p3_found": _P3 + " SELECT * FROM p3",
    "p3_report": _P3 + " SELECT table_name, period, reason, count(*) AS cases FROM p3 GROUP BY ALL",
    "p6_found": f"""
    WITH RECURSIVE e AS (
      SELECT set_id, c, min(p) AS p FROM (SELECT set_id, {_CODE.format('code')} AS c, {_CODE.format('parent_code')} AS p
      FROM golden_elements WHERE state = 'CA') WHERE c IS NOT NULL GROUP BY ALL),
    up AS (SELECT set_id, c AS start, p AS ahead FROM e WHERE p IS NOT NULL
      UNION SELECT up.set_id, up.start, e.p FROM up JOIN e ON e.set_id = up.set_id AND e.c = up.ahead
      WHERE e.p IS NOT NULL AND up.ahead <> up.start)
    SELECT DISTINCT set_id, start AS code FROM up WHERE ahead = start""",
    "p6_paths": _P6 + """
    SELECT e.set_id, e.c AS code, CASE WHEN t.line IS NOT NULL THEN array_to_string(t.line, ' > ') END AS path, (len(t.line) - 1)::INT AS depth, t.line[1] AS root,
      (SELECT count(*) FROM below b WHERE b.set_id = e.set_id AND b.code = e.c) AS descendants, c.start IS NOT NULL AS on_circle, c.start IS NULL AND t.line IS NULL AS below_circle
    FROM e LEFT JOIN tree t USING (set_id, c) LEFT JOIN circ c ON c.set_id = e.set_id AND c.start = e.c""",
    "p6_descendants": _P6 + " SELECT * FROM below",
}
