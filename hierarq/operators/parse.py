"""Answers of model providers as normalised rows: standards, depth maps, batches with retries.

Answers are JSON inside talk and code fences. They are read as variants, so that a field that is
absent, null or of another type differs. Defined results: an answer without a JSON array (or
object) is a failed attempt; items that are no objects, lack a required field or hold another
type in a field are dropped, the others stay; null answers fail; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hierarq.functions.text import json_array_of, json_object_of, standard_id
from hierarq.operators.merge import canonical_codes_by, status_of

REQUIRED = ("domain_code", "domain_name", "indicator_code", "indicator_name")
_LEVELS = ("domain", "strand", "sub_strand", "indicator")
#: Attempts at an answer that parses.
PARSE_ATTEMPTS = 3


def _field(item: Column, name: str) -> tuple[Column, Column]:
    """(kind, text) of a field: the kind is null if it is absent and VOID if it is null."""
    x = F.try_variant_get(item, f"$.{name}", "variant")
    return F.schema_of_variant(x), F.try_variant_get(item, f"$.{name}", "string")


def _array_of(answer: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(json_array_of(answer)), "$", "array<variant>")


def parses(answer: Column) -> Column:
    """Whether an answer holds a JSON array."""
    return _array_of(answer).isNotNull()


def standards_of(answers: DataFrame, answer: str = "answer", fallback: str = "fallback_age_band") -> DataFrame:
    """Standards out of answers, one row per sound item: the columns of ``answers`` (country, state and
    version_year among them) without the answer, and standard_id, code, name and description of each
    level, age_band, source_page and source_text. A level needs a code and a name, which may not be
    empty below the domain; a blank age band is the fallback; the page is 1 by default and above 0."""
    rows = answers.withColumn("_item", F.explode(_array_of(F.col(answer)))).drop(answer)
    item = F.col("_item")
    sound = F.schema_of_variant(item).startswith("OBJECT")
    texts: dict[str, Column] = {}
    for name in (*REQUIRED, *[f"{v}_{p}" for v in ("strand", "sub_strand") for p in ("code", "name")],
                 *[f"{v}_description" for v in _LEVELS], "age_band"):
        kind, text = _field(item, name)
        sound = sound & (kind == "STRING" if name in REQUIRED else kind.isNull() | kind.isin("STRING", "VOID"))
        texts[name] = F.when(kind == "STRING", text)
    page_kind, page = F.schema_of_variant(F.try_variant_get(item, "$.source_page", "variant")), F.try_variant_get(item, "$.source_page", "int")
    text_kind, text = _field(item, "source_text")
    sound = sound & (page_kind.isNull() | F.coalesce(page > 0, F.lit(False))) & (text_kind.isNull() | (text_kind == "STRING"))
    got = rows.where(F.coalesce(sound, F.lit(False)))
    cols = {"age_band": F.coalesce(F.nullif(texts["age_band"], F.lit("")), F.col(fallback)), "source_page": F.coalesce(page, F.lit(1)),
            "source_text": F.coalesce(text, F.lit(""))}
    for v in _LEVELS:
        both = F.lit(True) if v in ("domain", "indicator") else F.coalesce((texts[f"{v}_code"] != "") & (texts[f"{v}_name"] != ""), F.lit(False))
        cols |= {f"{v}_{p}": F.when(both, texts[f"{v}_{p}"]) for p in ("code", "name", "description")}
    out = got.withColumns(cols).drop("_item", fallback)
    return out.withColumn("standard_id", _id())


def _id() -> Column:
    return standard_id(*[F.col(c) for c in ("country", "state", "version_year", "domain_code", "indicator_code", "age_band")])


def normalized_standards(standards: DataFrame, scope: list[str]) -> DataFrame:
    """``standards`` in which a domain, strand or sub-strand of one name has one code in a ``scope``: the
    best of those it goes by; ids are made anew from the new codes."""
    out = standards
    for v in ("domain", "strand", "sub_strand"):
        key = F.lower(F.trim(F.col(f"{v}_name")))
        names = canonical_codes_by(standards, scope, key, F.col(f"{v}_code")).withColumnsRenamed({"name_key": "_k", "canonical": "_best"})
        names = names.withColumnsRenamed({c: f"_s{i}" for i, c in enumerate(scope)})
        same = F.col("_k") == F.lower(F.trim(F.col(f"{v}_name")))
        for i, c in enumerate(scope):
            same = same & F.col(c).eqNullSafe(F.col(f"_s{i}"))
        out = out.join(names, same, "left").withColumn(f"{v}_code", F.coalesce("_best", f"{v}_code")).select(*standards.columns)
    return out.withColumn("standard_id", _id())


def first_parsed(answers: DataFrame, keys: list[str], attempt: str = "attempt", answer: str = "answer", attempts: int = PARSE_ATTEMPTS) -> DataFrame:
    """(keys..., answer, attempts, error): of the answers to one chunk the first that parses, among its
    first ``attempts``; without one the error and no answer."""
    tried = answers.where(F.col(attempt) < attempts).withColumn("_ok", parses(F.col(answer)))
    g = tried.groupBy(*keys).agg(F.min_by(answer, F.when(F.col("_ok"), F.col(attempt))).alias("_a"),
                                 F.min(F.when(F.col("_ok"), F.col(attempt))).alias("_at"), F.count("*").alias("_n"))
    return g.select(*keys, F.when(F.col("_at").isNotNull(), F.col("_a")).alias(answer), F.coalesce(F.col("_at") + 1, "_n").alias("attempts"),
                    F.when(F.col("_at").isNull(), F.concat(F.lit("failed after "), F.col("_n").cast("string"), F.lit(" attempts: no JSON array")))
                    .alias("error"))


def batch_results(chunks: DataFrame, batch: list[str], key: str = "batch_key", attempts: int = PARSE_ATTEMPTS) -> tuple[DataFrame, DataFrame]:
    """(standards, results) of batches whose chunks were answered: ``chunks`` has the batch's columns, ``key``
    (an object key), chunk_index, attempt, answer, country, state, version_year and fallback_age_band.
    Results are (batch..., result_key, standards, errors, status)."""
    along = [*batch, key, "chunk_index", "country", "state", "version_year", "fallback_age_band"]
    first = first_parsed(chunks, along, attempts=attempts)
    standards = standards_of(first.where("error IS NULL").drop("attempts", "error"))
    made = standards.groupBy(*batch, key).agg(F.count("*").alias("standards"))
    failed = first.groupBy(*batch, key).agg(F.count("error").alias("errors"))
    n = F.coalesce("standards", F.lit(0).cast("long"))
    results = failed.join(made, [*batch, key], "left").select(
        *batch, F.replace(F.col(key), F.lit("/batch-"), F.lit("/result-")).alias("result_key"), n.alias("standards"), "errors",
        status_of(F.col("errors"), n).alias("status"))
    return standards, results


def depth_map(answer: Column) -> Column:
    """The depth map in an answer: an object with ``doc_depths``, else null."""
    v = F.try_parse_json(json_object_of(answer))
    depths = F.try_variant_get(v, "$.doc_depths", "array<struct<depth:int,canonical_level:string,label_in_doc:string,prefix_pattern:string,example:string>>")
    return F.when(depths.isNotNull(), F.struct(depths.alias("doc_depths"), F.try_variant_get(v, "$.notes", "string").alias("notes")))
