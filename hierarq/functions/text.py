"""Scalar functions on text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens_of(c: Column) -> Column:
    """Estimated tokens: four code points each, rounded down; null counts as empty."""
    return F.floor(F.length(F.coalesce(c, F.lit(""))) / 4).cast("long")


def squeezed(c: Column) -> Column:
    """Lower case, trimmed, single blanks: the key by which titles compare."""
    return F.trim(F.regexp_replace(F.lower(c), "\\s+", " "))


def unfenced(c: Column) -> Column:
    """A model's answer without the code fence around it: if it starts with a fence, the first
    line and every line that is a fence go."""
    lines = F.split(F.trim(c), "\n")
    kept = F.filter(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: ~F.trim(x).startswith("```"))
    return F.when(F.trim(c).startswith("```"), F.trim(F.array_join(kept, "\n"))).otherwise(F.trim(c))


def json_array_of(c: Column) -> Column:
    """From the first ``[`` to the last ``]``; empty if there is none."""
    return F.regexp_extract(unfenced(c), "(?s)\\[.*\\]", 0)


def json_object_of(c: Column) -> Column:
    return F.regexp_extract(unfenced(c), "(?s)\\{.*\\}", 0)


def without_age_prefix(code: Column) -> Column:
    return F.regexp_replace(code, "^PK\\d+\\.", "")


def has_camel_case(c: Column) -> Column:
    return c.rlike("[a-z][A-Z]")


def blank_to_null(c: Column) -> Column:
    """Null for blank values; others stay as they are, blanks around them included."""
    return F.when(F.trim(c) != "", c)


def standard_id(country: Column, state: Column, year: Column, domain: Column, indicator: Column, age: Column) -> Column:
    """``C-S-Y-DOMAIN-INDICATOR`` and ``-AGE`` where there is one."""
    return F.concat_ws("-", country, state, year.cast("string"), domain, indicator, F.nullif(age, F.lit("")))


def spaced_sentences(c: Column) -> Column:
    """A blank after a full stop or exclamation mark that runs into a capital."""
    return F.regexp_replace(c, "([.!])([A-Z])", "$1 $2")


def object_key(*parts: Column) -> Column:
    """Path of parts without the slashes around them."""
    return F.concat_ws("/", *[F.regexp_replace(p.cast("string"), "^/+|/+$", "") for p in parts])


def page_line(page: Column, text: Column) -> Column:
    return F.concat(F.lit("[Page "), page.cast("string"), F.lit("] "), text)


def run_parts(run_id: Column) -> Column:
    """country, state and year of ``pipeline-COUNTRY-STATE-YEAR-SUFFIX``; null for ids of another form."""
    parts = F.split(run_id, "-")
    year = F.try_element_at(parts, F.lit(4)).try_cast("int")
    ok = (F.size(parts) >= 5) & (parts[0] == "pipeline") & year.isNotNull()
    return F.when(ok, F.struct(F.try_element_at(parts, F.lit(2)).alias("country"), F.try_element_at(parts, F.lit(3)).alias("state"), year.alias("year")))


def file_name(path: Column) -> Column:
    """What stands after the last slash."""
    return F.element_at(F.split(path, "/"), -1)


def result_key(batch_key: Column) -> Column:
    return F.replace(batch_key, F.lit("/batch-"), F.lit("/result-"))


def short_id(uuid: Column) -> Column:
    """Twelve hexadecimal signs of a uuid."""
    return F.substring(F.replace(uuid, F.lit("-"), F.lit("")), 1, 12)


def iso_time(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")


def expiry(at: Column, seconds: int) -> Column:
    """Seconds of the epoch at which what was made at ``at`` expires."""
    return F.unix_timestamp(at.cast("timestamp")) + F.lit(seconds)
