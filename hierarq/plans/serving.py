"""Serving queries: document lists, hierarchies, details, search, plans of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hierarq.common import current_version, table
from hierarq.operators import serve
from hierarq.operators.ordered import numbered
from hierarq.operators.serve import first_delivery, live
from hierarq.plans.registry import CURRENT, Registry

R = Registry()


def _docs(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return first_delivery(table(s, d, "source_documents"), "id", "loaded_at", ["id", *columns])


def _chain(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(s, d, "domains"), table(s, d, "strands"), table(s, d, "sub_strands")


@R.add("serve_indicators_by_region", """
    SELECT o.o_orderkey AS indicator_id, o.o_totalprice AS value, c.c_name AS domain, n.n_name AS document,
           l.l_partkey AS strand_id, l.l_quantity AS strand_value
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
    JOIN region r ON r.r_regionkey = n.n_regionkey
    LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_linenumber = 1 WHERE r.r_name = 'ASIA'""")
def serve_indicators_by_region(s: SparkSession, d: str) -> DataFrame:
    """Leaves with their domain and document, optional level left-joined."""
    leaf = table(s, d, "orders").join(table(s, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(
        table(s, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(
        table(s, d, "region").where("r_name = 'ASIA'"), F.col("r_regionkey") == F.col("n_regionkey"))
    first = table(s, d, "lineitem").where("l_linenumber = 1")
    return leaf.join(first, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        F.col("o_orderkey").alias("indicator_id"), F.col("o_totalprice").alias("value"), F.col("c_name").alias("domain"),
        F.col("n_name").alias("document"), F.col("l_partkey").alias("strand_id"), F.col("l_quantity").alias("strand_value"))


@R.add("serve_inner_chain", """
    SELECT l_orderkey AS indicator_id, l_linenumber AS line, o_orderpriority AS sub_strand, c_mktsegment AS strand,
           n_name AS domain, r_name AS document
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    WHERE r_name = 'EUROPE' AND l_returnflag = 'R'""")
def serve_inner_chain(s: SparkSession, d: str) -> DataFrame:
    """Five inner joins, leaves without a middle level vanish."""
    return table(s, d, "lineitem").where("l_returnflag = 'R'").join(
        table(s, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(
        table(s, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(
        table(s, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(
        table(s, d, "region").where("r_name = 'EUROPE'"), F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.col("l_orderkey").alias("indicator_id"), F.col("l_linenumber").alias("line"),
        F.col("o_orderpriority").alias("sub_strand"), F.col("c_mktsegment").alias("strand"), F.col("n_name").alias("domain"),
        F.col("r_name").alias("document"))


@R.add("a5_filter_values", """
    SELECT DISTINCT country, state FROM source_documents""")
def a5_filter_values(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "source_documents").select("country", "state").distinct()


@R.add("a6_age_bands_of_state", """
    SELECT DISTINCT age_band FROM source_documents WHERE state = 'CA' AND nullif(trim(age_band), '') IS NOT NULL""")
def a6_age_bands_of_state(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "source_documents").where("state = 'CA' AND nullif(trim(age_band), '') IS NOT NULL").select("age_band").distinct()


@R.add("p17_documents", f"""
    WITH {CURRENT} SELECT id, country, state, title, version_year,
    row_number() OVER (ORDER BY country, state, title, id) AS place FROM docs WHERE country = 'US' AND state = 'TX'""")
def p17_documents(s: SparkSession, d: str) -> DataFrame:
    """The documents of a country and state in their order."""
    got = serve.where_all(_docs(s, d, "country", "state", "title", "version_year"), country="US", state="TX", age_band=None)
    return numbered(got, ["country", "state"], [F.col("title"), F.col("id")])


@R.add("j4_j6_live_nodes", f"""
    WITH {CURRENT}
    SELECT 'domain' AS level, id, document_id AS root FROM cur_domains WHERE NOT deleted
    UNION ALL SELECT 'strand', s.id, d.document_id FROM cur_strands s JOIN cur_domains d ON d.id = s.domain_id
      WHERE NOT s.deleted AND NOT d.deleted
    UNION ALL SELECT 'sub_strand', u.id, d.document_id FROM cur_subs u JOIN cur_strands s ON s.id = u.strand_id
      JOIN cur_domains d ON d.id = s.domain_id WHERE NOT u.deleted AND NOT s.deleted AND NOT d.deleted""")
def j4_j6_live_nodes(s: SparkSession, d: str) -> DataFrame:
    """Nodes that are live and whose ancestors are."""
    dom, st, su = (live(t, [c]) for t, c in zip(_chain(s, d), ("document_id", "domain_id", "strand_id"), strict=True))
    a = dom.select(F.lit("domain").alias("level"), "id", F.col("document_id").alias("root"))
    ds = st.join(dom.select(F.col("id").alias("domain_id"), F.col("document_id").alias("root")), "domain_id")
    b = ds.select(F.lit("strand").alias("level"), "id", "root")
    c = su.join(ds.select(F.col("id").alias("strand_id"), "root"), "strand_id").select(
        F.lit("sub_strand").alias("level"), "id", "root")
    return a.unionByName(b).unionByName(c)


@R.add("j7_domain_documents", f"""
    WITH {CURRENT} SELECT d.id AS domain_id, d.code, o.country, o.state, o.version_year, o.title
    FROM cur_domains d JOIN docs o ON o.id = d.document_id""")
def j7_domain_documents(s: SparkSession, d: str) -> DataFrame:
    dom = current_version(table(s, d, "domains"), columns=["code", "document_id"]).select(
        F.col("id").alias("domain_id"), "code", F.col("document_id").alias("id"))
    return dom.join(_docs(s, d, "country", "state", "version_year", "title"), "id").select("domain_id", "code", "country", "state", "version_year", "title")


@R.add("hierarchy_flat", f"""
    WITH {CURRENT}
    SELECT o.id AS document_id, o.title, d.code AS domain_code, s.code AS strand_code, u.id AS sub_strand_id,
      row_number() OVER (PARTITION BY o.id ORDER BY coalesce(d.display_order, 2147483647), d.code, d.id, s.code, s.id,
                         u.code, u.id) AS place
    FROM docs o JOIN cur_domains d ON d.document_id = o.id JOIN cur_strands s ON s.domain_id = d.id
    JOIN cur_subs u ON u.strand_id = s.id WHERE NOT d.deleted AND NOT s.deleted AND NOT u.deleted""")
def hierarchy_flat(s: SparkSession, d: str) -> DataFrame:
    """The hierarchy of every document, flat, in display order."""
    docs = _docs(s, d, "title").withColumnRenamed("id", "document_id")
    rows = serve.hierarchy_rows(docs, *_chain(s, d))
    order = [F.coalesce("display_order", F.lit(serve.NO_ORDER)), *map(F.col, (
        "domain_code", "domain_id", "strand_code", "strand_id", "sub_strand_code", "sub_strand_id"))]
    return numbered(rows, ["document_id"], order).select("document_id", "title", "domain_code", "strand_code", "sub_strand_id", "place")


@R.add("hierarchy_nested")
def hierarchy_nested(s: SparkSession, d: str) -> DataFrame:
    """One nested row per document."""
    docs = _docs(s, d, "country", "state", "title").withColumnRenamed("id", "document_id")
    return serve.nested_hierarchy(docs, *_chain(s, d))


@R.add("a14_children", f"""
    WITH {CURRENT} SELECT s.domain_id, list(s.code ORDER BY s.code, s.id) AS codes FROM cur_strands s
    WHERE NOT s.deleted AND s.domain_id IS NOT NULL GROUP BY s.domain_id""")
def a14_children(s: SparkSession, d: str) -> DataFrame:
    st = live(table(s, d, "strands"), ["domain_id", "code"]).where("domain_id IS NOT NULL")
    sorted_rows = F.array_sort(F.collect_list(F.struct("code", "id")))
    return st.groupBy("domain_id").agg(F.transform(sorted_rows, lambda x: x["code"]).alias("codes"))


@R.add("j9_parent_chain", f"""
    WITH {CURRENT}
    SELECT u.id AS sub_strand_id, u.code, s.id AS strand_id, s.code AS strand_code, d.id AS domain_id,
           d.code AS domain_code, o.title AS document_title
    FROM cur_subs u LEFT JOIN cur_strands s ON s.id = u.strand_id AND NOT s.deleted
    LEFT JOIN cur_domains d ON d.id = s.domain_id AND NOT d.deleted LEFT JOIN docs o ON o.id = d.document_id
    WHERE NOT u.deleted""")
def j9_parent_chain(s: SparkSession, d: str) -> DataFrame:
    dom, st, su = _chain(s, d)
    return serve.parent_chain(su, st, dom, _docs(s, d, "title").withColumnRenamed("id", "document_id"))


@R.add("j10_strands_of_domains_semi", f"""
    WITH {CURRENT} SELECT id, strand_id FROM cur_subs WHERE strand_id IN (
      SELECT id FROM cur_strands WHERE domain_id IN (SELECT id FROM cur_domains WHERE deleted))""")
def j10_strands_of_domains_semi(s: SparkSession, d: str) -> DataFrame:
    """What hangs below deleted domains, by semi-joins."""
    dom, st, su = (current_version(t, columns=[c]) for t, c in zip(_chain(s, d), ("deleted", "domain_id", "strand_id"), strict=True))
    gone = dom.where("deleted").select(F.col("id").alias("domain_id"))
    strands = st.join(gone, "domain_id", "left_semi").select(F.col("id").alias("strand_id"))
    return su.join(strands, "strand_id", "left_semi").select("id", "strand_id")


@R.add("j19_unknown_documents", """
    SELECT DISTINCT element_id, document_s3_key FROM detected_elements e WHERE document_s3_key IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM source_documents o WHERE o.s3_key = e.document_s3_key AND o.state <> 'CA')""")
def j19_unknown_documents(s: SparkSession, d: str) -> DataFrame:
    """Elements whose document is not among the known ones, here those of other states than CA."""
    docs = table(s, d, "source_documents").where("state <> 'CA'").select(F.col("s3_key").alias("document_s3_key"))
    e = table(s, d, "detected_elements").where("document_s3_key IS NOT NULL")
    return e.join(docs, "document_s3_key", "left_anti").select("element_id", "document_s3_key").distinct()


@R.add("p21_search", """
    SELECT DISTINCT element_id, code, title FROM detected_elements
    WHERE contains(lower(coalesce(code, '')), 'music') OR contains(lower(coalesce(title, '')), 'music')
       OR contains(lower(coalesce(description, '')), 'music')""")
def p21_search(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "detected_elements")
    return e.where(serve.contains_text(" Music", "code", "title", "description")).select("element_id", "code", "title").distinct()


@R.add("p22_verification", f"""
    WITH {CURRENT} SELECT state, count(*) AS n FROM (
      SELECT CASE WHEN human_verified THEN 'verified' ELSE 'unverified' END AS state FROM cur_strands WHERE NOT deleted
      UNION ALL SELECT 'all' FROM cur_strands WHERE NOT deleted) GROUP BY state""")
def p22_verification(s: SparkSession, d: str) -> DataFrame:
    names = ("all", "verified", "unverified")
    one = live(table(s, d, "strands"), ["human_verified"]).agg(*[F.count_if(serve.verified_is(n)).alias(n) for n in names])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("state"), F.col(n).alias("n")) for n in names])).alias("x")).select("x.*")


@R.add("p23_title_search", f"""
    WITH {CURRENT} SELECT id, title FROM docs WHERE contains(lower(title), 'early learning')""")
def p23_title_search(s: SparkSession, d: str) -> DataFrame:
    return _docs(s, d, "title").where(serve.contains_text(" early LEARNING ", "title")).select("id", "title")


@R.add("p24_option_labels", f"""
    WITH {CURRENT} SELECT id, concat_ws(' — ', code, name) AS label FROM cur_domains
    WHERE contains(lower(concat_ws(' — ', code, name)), 'la')""")
def p24_option_labels(s: SparkSession, d: str) -> DataFrame:
    labelled = current_version(table(s, d, "domains"), columns=["code", "name"]).select("id", F.concat_ws(" — ", "code", "name").alias("label"))
    return labelled.where(serve.contains_text("LA", "label"))


@R.add("p25_mapped_rows", f"""
    WITH {CURRENT} SELECT id, title, coalesce(source_url, '') AS "sourceUrl", version_year AS "versionYear",
      coalesce(nullif(trim(publishing_agency), ''), 'unknown') AS "publishingAgency" FROM docs""")
def p25_mapped_rows(s: SparkSession, d: str) -> DataFrame:
    return _docs(s, d, "title", "source_url", "version_year", "publishing_agency").select("id", "title", F.coalesce("source_url", F.lit("")).alias("sourceUrl"),
                              F.col("version_year").alias("versionYear"),
                              F.coalesce(F.expr("nullif(trim(publishing_agency), '')"), F.lit("unknown")).alias("publishingAgency"))


@R.add("p26_visible_nodes", f"""
    WITH {CURRENT},
    u AS (SELECT id, strand_id AS parent, contains(lower(concat_ws(chr(1), code, name, description)), 'shape') AS itself
          FROM cur_subs WHERE NOT deleted),
    s AS (SELECT id, domain_id AS parent, contains(lower(concat_ws(chr(1), code, name, description)), 'shape') AS itself
          FROM cur_strands WHERE NOT deleted),
    d AS (SELECT id, contains(lower(concat_ws(chr(1), code, name, description)), 'shape') AS itself FROM cur_domains WHERE NOT deleted),
    vs AS (SELECT * FROM s WHERE itself OR EXISTS (SELECT 1 FROM u WHERE u.parent = s.id AND u.itself))
    SELECT 'sub_strand' AS level, id, itself FROM u WHERE itself
    UNION ALL SELECT 'strand', id, itself FROM vs
    UNION ALL SELECT 'domain', id, itself FROM d WHERE itself OR EXISTS (SELECT 1 FROM vs WHERE vs.parent = d.id)""")
def p26_visible_nodes(s: SparkSession, d: str) -> DataFrame:
    return serve.visible(*_chain(s, d), "shape")


@R.add("o9_sorted_nodes", f"""
    WITH {CURRENT}, m AS (SELECT *, max(display_order IS NOT NULL) OVER (PARTITION BY document_id) AS ordered
      FROM cur_domains WHERE NOT deleted)
    SELECT id, document_id, row_number() OVER (PARTITION BY document_id ORDER BY
      CASE WHEN ordered THEN coalesce(display_order, 2147483647) ELSE 0 END, code DESC, id) AS place FROM m""")
def o9_sorted_nodes(s: SparkSession, d: str) -> DataFrame:
    """Sort by code, descending; a custom order set in a document goes first."""
    dom = live(table(s, d, "domains"), ["document_id", "display_order", "code"])
    custom = dom.groupBy("document_id").agg(F.max(F.col("display_order").isNotNull()).alias("ordered"))
    rank = F.when(F.col("ordered"), F.coalesce("display_order", F.lit(serve.NO_ORDER))).otherwise(0)
    rows = dom.select("id", "document_id", "display_order", "code").join(custom, "document_id")
    return numbered(rows, ["document_id"], [rank, (F.col("code"), "desc"), F.col("id")]).select("id", "document_id", "place")


@R.add("a15_grouped_documents", f"""
    WITH {CURRENT} SELECT country, state, id, row_number() OVER (PARTITION BY country, state ORDER BY version_year DESC, id) AS place FROM docs""")
def a15_grouped_documents(s: SparkSession, d: str) -> DataFrame:
    """Documents by country and state, as rows with their place in the group, so that no group is collected."""
    docs = _docs(s, d, "country", "state", "version_year")
    return numbered(docs, ["country", "state"], [(F.col("version_year"), "desc"), F.col("id")]).select("country", "state", "id", "place")


@R.add("s20_downloadable", f"""
    WITH {CURRENT} SELECT id, s3_key IS NOT NULL AND NOT contains(s3_key, '://') AS has_file FROM docs""")
def s20_downloadable(s: SparkSession, d: str) -> DataFrame:
    return _docs(s, d, "s3_key").select("id", (F.col("s3_key").isNotNull() & ~F.coalesce(F.col("s3_key").contains("://"), F.lit(False)))
                              .alias("has_file"))


@R.add("j17_resolved_domain", f"""
    WITH {CURRENT} SELECT u.id, coalesce(s.domain_id, -1) AS domain_id FROM cur_subs u LEFT JOIN cur_strands s ON s.id = u.strand_id""")
def j17_resolved_domain(s: SparkSession, d: str) -> DataFrame:
    st = current_version(table(s, d, "strands"), columns=["domain_id"]).withColumnRenamed("id", "strand_id")
    return current_version(table(s, d, "sub_strands"), columns=["strand_id"]).join(st, "strand_id", "left").select(
        "id", F.coalesce("domain_id", F.lit(-1)).alias("domain_id"))


@R.add("a29_id_uniqueness", """
    SELECT count(*) AS total, count(DISTINCT element_id) AS ids, count(*) = count(DISTINCT element_id) AS is_unique FROM detected_elements""")
def a29_id_uniqueness(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "detected_elements").agg(F.count("*").alias("total"), F.countDistinct("element_id").alias("ids")).select(
        "total", "ids", (F.col("total") == F.col("ids")).alias("is_unique"))


def _query_vector(s: SparkSession, d: str, key: int = 0) -> list[float]:
    row = table(s, d, "embeddings").orderBy("vec_id").where(F.col("vec_id") >= key).limit(1).collect()
    return [float(x) for x in row[0].embedding] if row else [0.0]


_COSINE = """list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))
    / sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[]))
         * list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])))"""


@R.add("o2_vector_topk", f"""
    SELECT e.vec_id, e.label, round({_COSINE}, 4) AS similarity
    FROM embeddings e, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q ORDER BY {_COSINE} DESC, e.vec_id LIMIT 10""")
def o2_vector_topk(s: SparkSession, d: str) -> DataFrame:
    """O2: cosine top-k over all vectors."""
    got = serve.top_k_cosine(table(s, d, "embeddings"), _query_vector(s, d), 10)
    return got.select("vec_id", "label", F.round("similarity", 4).alias("similarity"))


@R.add("p18_vector_topk_filtered", f"""
    SELECT e.vec_id, e.label, n.n_name AS name, round({_COSINE}, 4) AS similarity
    FROM embeddings e JOIN nation n ON n.n_nationkey = e.label, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q
    WHERE e.label IN (1, 2, 3) ORDER BY {_COSINE} DESC, e.vec_id LIMIT 10""")
def p18_vector_topk_filtered(s: SparkSession, d: str) -> DataFrame:
    """Filter first, then top-k, joined with what the vectors stand for."""
    kept = table(s, d, "embeddings").where(F.col("label").isin(1, 2, 3)).join(
        table(s, d, "nation").select(F.col("n_nationkey").alias("label"), F.col("n_name").alias("name")), "label")
    got = serve.top_k_cosine(kept, _query_vector(s, d), 10)
    return got.select("vec_id", "label", "name", F.round("similarity", 4).alias("similarity"))


def _of_many(s: SparkSession, d: str, vectors: DataFrame) -> DataFrame:
    """The 10 of ``vectors`` most similar to each row of embeddings whose vec_id is divisible by 20."""
    asked = table(s, d, "embeddings").where("vec_id % 20 = 0")
    got = serve.top_k_cosine_of_many(vectors, asked, 10)
    return got.join(vectors.drop("embedding"), "vec_id").withColumn("similarity", F.round("similarity", 4))


_PLACE = f"row_number() OVER (PARTITION BY q.vec_id ORDER BY round({_COSINE}, 12) DESC, e.vec_id) AS place"


@R.add("o2_vector_topk_all", f"""
    SELECT query_id, vec_id, label, similarity FROM (
      SELECT q.vec_id AS query_id, e.vec_id, e.label, round({_COSINE}, 4) AS similarity, {_PLACE}
      FROM embeddings e, embeddings q WHERE q.vec_id % 20 = 0) WHERE place <= 10""")
def o2_vector_topk_all(s: SparkSession, d: str) -> DataFrame:
    """O2 for the whole query set, each query against all vectors."""
    got = _of_many(s, d, table(s, d, "embeddings"))
    return got.select("query_id", "vec_id", "label", "similarity")


@R.add("p18_vector_topk_filtered_all", f"""
    SELECT query_id, vec_id, label, name, similarity FROM (
      SELECT q.vec_id AS query_id, e.vec_id, e.label, n.n_name AS name, round({_COSINE}, 4) AS similarity, {_PLACE}
      FROM embeddings e JOIN nation n ON n.n_nationkey = e.label, embeddings q WHERE q.vec_id % 20 = 0 AND e.label IN (1, 2, 3))
    WHERE place <= 10""")
def p18_vector_topk_filtered_all(s: SparkSession, d: str) -> DataFrame:
    """J1 P18 for the whole query set: filter first, then top-k per query."""
    kept = table(s, d, "embeddings").where(F.col("label").isin(1, 2, 3)).join(
        table(s, d, "nation").select(F.col("n_nationkey").alias("label"), F.col("n_name").alias("name")), "label")
    return _of_many(s, d, kept).select("query_id", "vec_id", "label", "name", "similarity")


_SIMILAR = f"""
    WITH docs AS (SELECT * FROM source_documents WHERE s3_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY s3_key ORDER BY id, loaded_at) = 1),
    e AS (SELECT * FROM detected_elements QUALIFY row_number() OVER (PARTITION BY element_id ORDER BY detected_at) = 1),
    dom AS (SELECT document_s3_key, code, min(title) AS name FROM e WHERE level = 'domain' AND code IS NOT NULL GROUP BY ALL),
    j AS (SELECT v.vec_id, i.code, dom.code AS domain_code, dom.name AS domain_name, o.country, o.state, o.age_band, o.version_year, v.embedding
      FROM embeddings v JOIN e i ON i.element_id = v.vec_id AND i.level = 'indicator' JOIN dom ON dom.document_s3_key = i.document_s3_key AND dom.code = split_part(i.code, '.', 1)
      JOIN docs o ON o.s3_key = dom.document_s3_key)
    SELECT e.vec_id, e.code, domain_code, domain_name, country, state, age_band, version_year, round({_COSINE}, 4) AS similarity
    FROM j e, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q WHERE {{0}} ORDER BY {_COSINE} DESC, e.vec_id LIMIT 10"""


def similar_indicators(s: SparkSession, d: str, vector: list[float], top_k: int = 10, country: str | None = None, state: str | None = None,
                       age_band: str | None = None, domain: str | None = None, version_year: int | None = None) -> DataFrame:
    """Vectors joined with their indicators, these with their domains and documents, all inner; filters that are given
    first, then the most similar."""
    docs = serve.where_all(table(s, d, "source_documents").where("s3_key IS NOT NULL").groupBy("s3_key").agg(
        F.min_by(F.struct("country", "state", "age_band", "version_year"), F.struct("id", "loaded_at")).alias("o")).select("s3_key", "o.*"),
        country=country, state=state, age_band=age_band, version_year=version_year)
    e = first_delivery(table(s, d, "detected_elements"), "element_id", "detected_at", ["element_id", "document_s3_key", "level", "code", "title"])
    dom = e.where("level = 'domain' AND code IS NOT NULL").groupBy("document_s3_key", F.col("code").alias("domain_code")).agg(F.min("title").alias("domain_name"))
    if domain is not None:
        dom = dom.where(F.col("domain_code") == domain)
    ind = e.where("level = 'indicator'").select(F.col("element_id").alias("vec_id"), "document_s3_key", "code",
                                                F.substring_index("code", ".", 1).alias("domain_code"))
    rows = ind.join(dom, ["document_s3_key", "domain_code"]).join(docs, F.col("s3_key") == F.col("document_s3_key"))
    joined = table(s, d, "embeddings").select("vec_id", "embedding").join(rows, "vec_id")
    return serve.top_k_cosine(joined, vector, top_k).select("vec_id", "code", "domain_code", "domain_name", "country", "state", "age_band", "version_year",
                                                            F.round("similarity", 4).alias("similarity"))


@R.add("j1_similar_indicators", _SIMILAR.format("country = 'US' AND state = 'CA'"))
def j1_similar_indicators(s: SparkSession, d: str) -> DataFrame:
    """The four-way join with two of the filters given."""
    return similar_indicators(s, d, _query_vector(s, d), country="US", state="CA")


@R.add("p18_five_filters", _SIMILAR.format("country = 'US' AND state = 'CA' AND age_band = 'Early Preschool (3 to 4 Years)' AND domain_code = 'SE' AND version_year = 2004"))
def p18_five_filters(s: SparkSession, d: str) -> DataFrame:
    """All five filters given."""
    return similar_indicators(s, d, _query_vector(s, d), country="US", state="CA", age_band="Early Preschool (3 to 4 Years)", domain="SE",
                              version_year=2004)


def _o9(order: str) -> str:
    return f"""WITH {CURRENT} SELECT id, document_id, row_number() OVER (PARTITION BY document_id ORDER BY {order}, id) AS place FROM cur_domains WHERE NOT deleted"""


@R.add("o9_by_name_descending", _o9("lower(name) DESC NULLS LAST"))
def o9_by_name_descending(s: SparkSession, d: str) -> DataFrame:
    """By name without letter case, from the last."""
    return serve.sorted_nodes(live(table(s, d, "domains"), ["document_id", "name"]), "document_id", "name", descending=True)


@R.add("o9_by_verified", _o9("coalesce(human_verified, false) ASC"))
def o9_by_verified(s: SparkSession, d: str) -> DataFrame:
    """By verification, those without first."""
    return serve.sorted_nodes(live(table(s, d, "domains"), ["document_id", "human_verified"]), "document_id", "human_verified")


QUERIES, SQL = R.queries, R.sql
