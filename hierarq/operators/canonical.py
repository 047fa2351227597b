"""Canonical records: reshaping, serialisation, validation with all errors, uniqueness.

Validation reads the JSON text, so that absent, null and wrongly typed fields differ. Nulls:
a payload that does not parse or holds no object gets one error on ``$``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fields of a record, and what is asked of the fields of its parts: (part, field, rule).
_PARTS = ("country", "state", "document", "standard", "metadata")
_DOCUMENT = ("title", "version_year", "source_url", "age_band", "publishing_agency")
Error = tuple[str, str, str]


def _absent(path: str) -> Error:
    return path, f"Missing required field: {path}", "missing_field"


def _wrong(path: str, what: str) -> Error:
    return path, f"{path} must be {what}", "invalid_type"


def _texts(part: dict, path: str, names: tuple[str, ...]) -> Iterator[Error]:
    for n in names:
        if n not in part:
            yield _absent(f"{path}.{n}")
        elif not isinstance(part[n], str) or not part[n]:
            yield _wrong(f"{path}.{n}", "a non-empty string")


def _level(standard: dict, name: str, texts: tuple[str, ...], optional: bool) -> Iterator[Error]:
    path, value = f"standard.{name}", standard.get(name)
    if isinstance(value, dict):
        yield from _texts(value, path, texts)
    elif name not in standard:
        if not optional:
            yield _absent(path)
    elif value is not None or not optional:
        yield _wrong(path, "an object or null" if optional else "an object")


def _errors(record: dict) -> Iterator[Error]:
    for n in _PARTS:
        if n not in record:
            yield _absent(n)
        elif not record[n]:
            yield n, f"Field cannot be empty: {n}", "invalid_type"
    if "country" in record:
        country = record["country"]
        if not isinstance(country, str) or len(country) != 2:
            yield _wrong("country", "a two-letter ISO 3166-1 alpha-2 code")
        elif not (country.isupper() and country.isalpha()):
            yield "country", "country must be uppercase letters only", "format"
    if "state" in record and (not isinstance(record["state"], str) or not record["state"]):
        yield _wrong("state", "a non-empty string")
    document, standard = record.get("document"), record.get("standard")
    for n in ("document", "standard", "metadata"):
        if n in record and not isinstance(record[n], dict):
            yield _wrong(n, "an object")
    if isinstance(document, dict):
        yield from _texts(document, "document", tuple(n for n in _DOCUMENT if n != "version_year"))
        if "version_year" not in document:
            yield _absent("document.version_year")
        elif type(document["version_year"]) is not int:
            yield _wrong("document.version_year", "an integer")
    if isinstance(standard, dict):
        yield from _texts(standard, "standard", ("standard_id",))
        yield from _level(standard, "domain", ("code", "name"), False)
        yield from _level(standard, "strand", ("code", "name"), True)
        yield from _level(standard, "sub_strand", ("code", "name"), True)
        yield from _level(standard, "indicator", ("code",), False)
        indicator = standard.get("indicator")
        if isinstance(indicator, dict):
            for n in ("description", "name"):
                if not isinstance(indicator.get(n), (str, type(None))):
                    yield _wrong(f"standard.indicator.{n}", "a string or null")


def _key(record: dict) -> list[str] | None:
    """country, state, year and id of a record that has them all."""
    document, standard = record.get("document"), record.get("standard")
    if not isinstance(document, dict) or not isinstance(standard, dict):
        return None
    key = [record.get("country"), record.get("state"), document.get("version_year"), standard.get("standard_id")]
    return [str(x) for x in key] if all(isinstance(x, (str, int)) and x for x in key) else None


def record_errors(payload: str | None) -> tuple[list[Error], list[str] | None]:
    """All (field_path, message, error_type) of a payload, each once, and its key."""
    try:
        r = json.loads(payload) if payload is not None else None
    except (ValueError, RecursionError):
        r = None
    if not isinstance(r, dict):
        return [("$", "record must be an object", "invalid_type")], None
    return list(dict.fromkeys(_errors(r))), _key(r)


def validated(records: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``records`` with the array ``errors`` (field_path, message, error_type); a record is valid if it is empty.

    Sixty rules on one parsed payload: as Column expressions they outgrow the code generator,
    so they run in Arrow batches, each payload parsed once. With ``existing`` (country, state,
    version_year, standard_id) a record whose key is among them gets a ``uniqueness`` error."""
    fields = ("field_path", "message", "error_type")
    errors = pa.list_(pa.struct([(f, pa.string()) for f in fields]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [record_errors(x) for x in batch.column("payload").to_pylist()]
            rows = [[dict(zip(fields, e, strict=True)) for e in got] for got, _ in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, errors), pa.array([k for _, k in found], pa.list_(pa.string()))],
                                             names=[*batch.schema.names, "errors", "_key"])

    error = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    schema = T.StructType([*records.schema.fields, T.StructField("errors", T.ArrayType(error)), T.StructField("_key", T.ArrayType(T.StringType()))])
    got = records.mapInArrow(run, schema)
    if existing is None:
        return got.drop("_key")
    known = existing.select(F.array(*[F.col(c).cast("string") for c in ("country", "state", "version_year", "standard_id")]).alias("_key"),
                            F.lit(True).alias("_twice")).where("forall(_key, x -> x IS NOT NULL)").distinct()
    message = F.format_string("Duplicate standard_id: %s for country=%s, state=%s, year=%s", F.col("_key")[3], F.col("_key")[0], F.col("_key")[1], F.col("_key")[2])
    more = F.array(F.struct(F.lit("standard.standard_id").alias("field_path"), message.alias("message"), F.lit("uniqueness").alias("error_type")))
    return got.join(known, "_key", "left").withColumn("errors", F.when(F.col("_twice"), F.concat("errors", more)).otherwise(F.col("errors"))).select(
        *records.columns, "errors")


def not_unique(records: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Records whose key is among the existing ones."""
    return records.join(existing.select(*key).distinct(), key, "left_semi")


def is_canonical(payload: Column) -> Column:
    """Whether a JSON text already has the three parts of a canonical record."""
    v = F.try_parse_json(payload)
    has = F.lit(True)
    for n in ("document", "standard", "metadata"):
        has = has & F.try_variant_get(v, f"$.{n}", "variant").isNotNull()
    return F.coalesce(has, F.lit(False))


def passed_through(records: DataFrame, flat: str, payload: str = "payload") -> DataFrame:
    """``records`` whose payload is canonical as it is, others nested from the flat JSON by the struct schema ``flat``."""
    whole = records.withColumn("_done", is_canonical(F.col(payload)))
    rest = [c for c in records.columns if c != payload]
    parsed = whole.where("NOT _done").select(F.struct(*rest).alias("_keep"), F.from_json(payload, flat).alias("_f")).select("_keep", "_f.*")
    nested = to_canonical(parsed, ["_keep"])
    made = nested.select("_keep.*", F.to_json(F.struct(*[c for c in nested.columns if c != "_keep"])).alias(payload))
    return whole.where("_done").select(*rest, payload).unionByName(made.select(*rest, payload))


def to_canonical(flat: DataFrame, along: list[str] = ()) -> DataFrame:
    """Flat rows nested into document, standard and metadata: the description falls back to the
    name, then to an empty text; optional levels need a code and a name; the age band falls
    back to the document's, then to ``PK``; an empty indicator name is null."""
    text = lambda c: F.nullif(F.col(c), F.lit(""))
    level = lambda c, n: F.when(text(c).isNotNull() & text(n).isNotNull(), F.struct(
        F.col(c).alias("code"), F.col(n).alias("name")))
    return flat.select(
        *along, "country", "state",
        F.struct(F.coalesce(text("title"), F.concat("state", F.lit(" Early Learning Standards"))).alias("title"), "version_year",
                 F.coalesce("source_url", F.lit("")).alias("source_url"),
                 F.coalesce(text("age_band"), text("document_age_band"), F.lit("PK")).alias("age_band"),
                 F.coalesce("publishing_agency", F.lit("")).alias("publishing_agency")).alias("document"),
        F.struct("standard_id", level("domain_code", "domain_name").alias("domain"), level("strand_code", "strand_name").alias("strand"),
                 level("sub_strand_code", "sub_strand_name").alias("sub_strand"),
                 F.struct(F.col("indicator_code").alias("code"), text("indicator_name").alias("name"),
                          F.coalesce(text("indicator_description"), text("indicator_name"), F.lit("")).alias("description"))
                 .alias("indicator")).alias("standard"),
        F.struct(F.coalesce("source_page", F.lit(1)).alias("page_number"), F.coalesce("source_text", F.lit("")).alias("source_text"))
        .alias("metadata"))


CANONICAL = ("country string, state string, document struct<title:string,version_year:int,source_url:string,age_band:string,"
             "publishing_agency:string>, standard struct<standard_id:string,domain:struct<code:string,name:string>,"
             "strand:struct<code:string,name:string>,sub_strand:struct<code:string,name:string>,"
             "indicator:struct<code:string,name:string,description:string>>, metadata struct<page_number:int,source_text:string>")


def serialised(canonical: DataFrame) -> DataFrame:
    return canonical.select(F.col("standard.standard_id").alias("standard_id"), F.to_json(F.struct(*canonical.columns)).alias("payload"))


def deserialised(records: DataFrame) -> DataFrame:
    """The inverse: canonical fields out of JSON, page 1 and empty text by default."""
    r = records.select(F.from_json("payload", CANONICAL).alias("r")).select("r.*")
    return r.withColumn("metadata", F.struct(F.coalesce("metadata.page_number", F.lit(1)).alias("page_number"),
                                             F.coalesce("metadata.source_text", F.lit("")).alias("source_text")))
