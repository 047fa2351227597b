"""Evaluation of detected elements against golden ones.

Keys compare trimmed, in lower case, with single blanks. Of several golden rows with one key
the last by ``seq`` counts. A quotient with nothing below the line is 0. Null and empty age
bands are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hierarq.functions.text import squeezed


def quotient(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def scores(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """precision, recall and f1, rounded to four places."""
    p, r = quotient(tp, tp + fp), quotient(tp, tp + fn)
    f1 = F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))
    return [F.round(x, 4).alias(n) for x, n in ((p, "precision"), (r, "recall"), (f1, "f1"))]


def match(golden: DataFrame, predicted: DataFrame, scope: list[str]) -> DataFrame:
    """Each prediction with the golden row of the same title and page, else of the same level and
    code: (scope..., p_id, g_id, p_level, g_level, p_code, g_code). Two equi-joins on unique keys."""
    page = F.coalesce(F.col("source_page").cast("string"), F.lit(""))
    g = golden.select(*scope, F.col("id").alias("g_id"), "seq", F.col("level").alias("g_level"), F.col("code").alias("g_code"),
                      F.concat_ws("|", squeezed(F.col("title")), page).alias("k1"), F.concat_ws("|", "level", "code").alias("k2"))
    p = predicted.select(*scope, F.col("id").alias("p_id"), F.col("level").alias("p_level"), F.col("code").alias("p_code"),
                         F.concat_ws("|", squeezed(F.col("title")), page).alias("k1"), F.concat_ws("|", "level", "code").alias("k2"))

    def last(key: str, n: str) -> DataFrame:
        return g.groupBy(*scope, key).agg(F.max_by(F.struct("g_id", "g_level", "g_code"), F.col("seq")).alias(n))

    m = p.join(last("k1", "_a"), [*scope, "k1"], "left").join(last("k2", "_b"), [*scope, "k2"], "left")
    hit = F.coalesce("_a", "_b")
    return m.select(*scope, "p_id", "p_level", "p_code", hit["g_id"].alias("g_id"), hit["g_level"].alias("g_level"),
                    hit["g_code"].alias("g_code"))


def detection_scores(golden: DataFrame, predicted: DataFrame, scope: list[str]) -> DataFrame:
    """Per scope: tp, fp, fn (golden rows no prediction met), and precision, recall, f1."""
    m = match(golden, predicted, scope)
    found = m.groupBy(*scope).agg(F.count("g_id").alias("tp"), F.count_if(F.col("g_id").isNull()).alias("fp"))
    missed = golden.join(m.where("g_id IS NOT NULL").select(*scope, F.col("g_id").alias("id")).distinct(), [*scope, "id"], "left_anti")
    lost = missed.groupBy(*scope).agg(F.count("*").alias("fn"))
    zero = F.lit(0)
    t = found.join(lost, scope, "full").select(*scope, *[F.coalesce(c, zero).alias(c) for c in ("tp", "fp", "fn")])
    return t.select("*", *scores(F.col("tp"), F.col("fp"), F.col("fn")))


def detection_report(golden: DataFrame, predicted: DataFrame, scope: list[str], strict: bool = True) -> DataFrame:
    """(scope..., dimension, tp, fp, fn, precision, recall, f1) of element_detection, level_classification,
    code_extraction and level_<name>.

    A prediction's level and code are right or wrong where it met a golden row. With ``strict`` what is missed are
    golden rows that no prediction met. Without, it is their keys, by title and by code: a row met
    by one of its keys is missed by the other, one that is not met twice."""
    m = match(golden, predicted, scope).withColumn("_met", F.col("g_id").isNotNull())
    right, same = F.col("p_level") == F.col("g_level"), F.trim("p_code") == F.trim("g_code")
    hits = m.where("_met").select(*scope, F.coalesce("p_level", F.lit("unknown")).alias("level"), F.coalesce(right, F.lit(False)).alias("_l"),
                                  F.coalesce(same, F.lit(False)).alias("_c"))
    if strict:
        lost = golden.select(*scope, "id", "level").join(m.where("_met").select(*scope, F.col("g_id").alias("id")).distinct(), [*scope, "id"], "left_anti")
    else:
        page = F.coalesce(F.col("source_page").cast("string"), F.lit(""))
        k1, k2 = F.concat_ws("|", squeezed(F.col("title")), page), F.concat_ws("|", "level", "code")
        keyed = golden.select(*scope, "seq", "level", k1.alias("k1"), k2.alias("k2"))
        both = F.array(F.struct(F.col("k1").alias("key"), F.lit(1).alias("by")), F.struct(F.col("k2").alias("key"), F.lit(0).alias("by")))
        keys = keyed.select(*scope, "seq", "level", F.explode(both).alias("k"))
        every = keys.groupBy(*scope, F.col("k.key").alias("key")).agg(F.max_by("level", F.struct("k.by", "seq")).alias("level"))
        by_title = keyed.select(*scope, "k1").distinct().withColumn("_t", F.lit(True))
        p = predicted.select(*scope, k1.alias("k1"), k2.alias("k2")).join(by_title, [*scope, "k1"], "left")
        used = p.select(*scope, F.when(F.col("_t"), F.col("k1")).otherwise(F.col("k2")).alias("key")).distinct()
        lost = every.join(used, [*scope, "key"], "left_anti")
    n = F.array(F.struct(F.lit("element_detection").alias("dimension"), F.lit("tp").alias("kind")),
                F.struct(F.lit("level_classification").alias("dimension"), F.when(F.col("_l"), "tp").otherwise("fp").alias("kind")),
                F.struct(F.lit("code_extraction").alias("dimension"), F.when(F.col("_c"), "tp").otherwise("fp").alias("kind")),
                F.struct(F.when(F.col("_l"), F.concat(F.lit("level_"), "level")).alias("dimension"), F.lit("tp").alias("kind")))
    whole = [F.struct(F.lit(x).alias("dimension"), F.lit("fn").alias("kind")) for x in ("element_detection", "level_classification", "code_extraction")]
    gone = F.array(*whole, F.struct(F.concat(F.lit("level_"), F.coalesce("level", F.lit("unknown"))).alias("dimension"), F.lit("fn").alias("kind")))
    extra = m.where("NOT _met").select(*scope, F.lit("element_detection").alias("dimension"), F.lit("fp").alias("kind"))
    rows = hits.select(*scope, F.inline(n)).unionByName(lost.select(*scope, F.inline(gone))).unionByName(extra).where("dimension IS NOT NULL")
    t = rows.groupBy(*scope, "dimension").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("tp", "fp", "fn")])
    return t.select("*", *scores(F.col("tp"), F.col("fp"), F.col("fn")))


def confusion(golden: DataFrame, predicted: DataFrame, scope: list[str]) -> DataFrame:
    """How often a golden level was predicted as which level; ``none`` where there is no match."""
    m = match(golden, predicted, scope)
    return m.groupBy(F.coalesce("g_level", F.lit("none")).alias("golden_level"), F.col("p_level").alias("predicted_level")).agg(
        F.count("*").alias("n"))


def grade(golden: DataFrame, detected: DataFrame, scope: list[str]) -> DataFrame:
    """Golden rows by (level, code, age band), else by title with the same level and band:
    (scope..., level, found, missed). Rows without level or title are left out."""
    band = F.coalesce(F.nullif(F.col("age_band"), F.lit("")), F.lit("-"))
    g = golden.where("level IS NOT NULL AND title IS NOT NULL").withColumn("band", band).withColumn("t", squeezed(F.col("title")))
    x = detected.withColumn("band", band).withColumn("t", squeezed(F.col("title")))
    by_code = x.select(*scope, "level", "code", "band").distinct().withColumn("_c", F.lit(1))
    by_title = x.select(*scope, "level", "t", "band").distinct().withColumn("_t", F.lit(1))
    m = g.join(by_code, [*scope, "level", "code", "band"], "left").join(by_title, [*scope, "level", "t", "band"], "left")
    hit = F.col("_c").isNotNull() | F.col("_t").isNotNull()
    return m.groupBy(*scope, "level").agg(F.count_if(hit).alias("found"), F.count_if(~hit).alias("missed"))


def hierarchy_agreement(golden: DataFrame, parsed: DataFrame, scope: list[str]) -> DataFrame:
    """Parsed against golden parents per indicator code; null and empty codes are equal."""
    cols = ["domain_code", "strand_code", "sub_strand_code"]
    g = golden.select(*scope, "code", *[F.coalesce(c, F.lit("")).alias(f"g_{c}") for c in cols])
    p = parsed.select(*scope, "code", *[F.coalesce(c, F.lit("")).alias(f"p_{c}") for c in cols])
    same = F.lit(True)
    for c in cols:
        same = same & (F.col(f"g_{c}") == F.col(f"p_{c}"))
    j = g.withColumn("_g", F.lit(1)).join(p.withColumn("_p", F.lit(1)), [*scope, "code"], "full")
    both = F.col("_g").isNotNull() & F.col("_p").isNotNull()
    return j.groupBy(*scope).agg(F.count_if(both & same).alias("tp"), F.count_if(F.col("_p").isNotNull() & ~(both & same)).alias("fp"),
                                 F.count_if(F.col("_p").isNull()).alias("fn"))


def stability(runs: DataFrame, scope: list[str]) -> DataFrame:
    """Spread of output sizes over runs, and how often two runs disagree on the level of an
    element with the same code and title. ``runs`` has ``run``."""
    sizes = runs.groupBy(*scope, "run").agg(F.count("*").alias("n")).groupBy(*scope).agg(
        F.round(F.stddev_pop("n"), 6).alias("size_stddev"))
    levels = runs.groupBy(*scope, "code", "title").agg(F.min("level").alias("a"), F.max("level").alias("b"),
                                                      F.countDistinct("run").alias("r")).where("r > 1")
    rate = levels.groupBy(*scope).agg(F.round(F.avg((F.col("a") != F.col("b")).cast("double")), 6).alias("disagreement"))
    return sizes.join(rate, scope, "left").withColumn("disagreement", F.coalesce("disagreement", F.lit(0.0)))


#: Sentinel of checks that meet a null text where a text is needed.
_BROKEN = -1
# What the checks look for.
BAND_IN_TITLE, LETTERED, NUMBERED = r"(?U)\b(Early|Later)\s*\(", r"(?U)^\s*[a-z]\.\s", r"(?Ud)^\s*\d+\.\s+[A-Z].*:"
EXAMPLES_HEADER = "Indicators and Examples in the Context"
COLUMN_HEADERS = ["PK3 Outcome", "PK4 Outcome", "PK3", "PK4"]
LEVEL_NAMES = ["domain", "strand", "sub_strand", "indicator"]


def _counters() -> dict[str, Column]:
    """What the checks count, over rows; a null where a text is needed makes ``*_null``."""
    ind = F.col("level") == "indicator"
    title, source, code = F.col("title"), F.col("source_text"), F.coalesce(F.col("code"), F.lit(""))
    n = {f"is_{level}": F.col("level") == level for level in LEVEL_NAMES}
    n |= {"band_title": ind & title.rlike(BAND_IN_TITLE), "band_title_null": ind & title.isNull(),
          "lettered": ind & source.rlike(LETTERED), "lettered_null": ind & source.isNull(),
          "numbered": source.rlike(NUMBERED) & ~F.coalesce(F.col("level") == "strand", F.lit(False)), "numbered_null": source.isNull(),
          "pk3": ind & code.startswith("PK3."), "pk4": ind & code.startswith("PK4."),
          "other_band": ind & ~F.coalesce(F.col("age_band").isin("PK3", "PK4"), F.lit(False)),
          "column_header": ind & F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)^\s+|\s+$", "").isin(COLUMN_HEADERS),
          "examples_header": F.coalesce(title, F.lit("")).contains(EXAMPLES_HEADER)}
    return n


def _verdicts() -> dict[str, Column]:
    """Cases by id: how much of it is wrong (0 passes, ``_BROKEN`` could not be decided)."""
    c = F.col
    unless = lambda null, bad: F.when(c(null) > 0, _BROKEN).otherwise(c(bad))
    absent = sum((F.when(c(f"is_{level}") == 0, 1).otherwise(0) for level in LEVEL_NAMES), F.lit(0))
    return {
        "ca_age_columns_emitted": c("lone_bands"), "ca_age_label_not_in_title": unless("band_title_null", "band_title"),
        "ca_no_lettered_examples_as_indicators": unless("lettered_null", "lettered"), "ca_four_level_hierarchy": absent,
        "co_no_sub_strand": c("is_sub_strand"), "co_numeric_strands": unless("numbered_null", "numbered"),
        "co_indicator_parent_is_strand": F.lit(0), "tx_pk3_pk4_distinct": F.when((c("pk3") > 0) & (c("pk4") > 0), 0).otherwise(1),
        "tx_age_band_set": c("other_band"), "tx_no_column_header_as_indicator": c("column_header"),
        "az_no_lettered_examples": unless("lettered_null", "lettered"), "az_no_examples_header_as_element": c("examples_header"),
        "az_four_level_hierarchy": absent,
    }


def case_name(case_id: str) -> str:
    """The name under which a case is registered: lower case, with underscores."""
    return case_id.lower().replace("-", "_")


def checks(elements: DataFrame, scope: list[str], case_ids: list[str] | None = None) -> DataFrame:
    """(scope..., case_id, status, wrong) of registered cases, by default all: PASS, FAIL, ERROR
    (a null where the case needs a text) or SKIP (an id that names no case). ``wrong`` counts what
    fails. Rows are counted per scope and code first, so no scope is collected."""
    code = F.regexp_replace(F.coalesce("code", F.lit("")), r"(?U)^\s+|\s+$", "")
    band = F.coalesce("age_band", F.lit(""))
    own = elements.withColumn("_code", F.when(F.col("level") == "indicator", F.nullif(code, F.lit(""))))
    counters = _counters()
    per_code = own.groupBy(*scope, "_code").agg(
        *[F.count_if(v).alias(k) for k, v in counters.items()], F.max(band.contains("Early")).alias("_early"), F.max(band.contains("Later")).alias("_later"))
    lone = F.col("_code").isNotNull() & ~(F.col("_early") & F.col("_later"))
    total = per_code.groupBy(*scope).agg(*[F.sum(k).alias(k) for k in counters], F.count_if(lone).alias("lone_bands"))
    known = _verdicts()
    asked = list(known) if case_ids is None else case_ids
    rows = F.array(*[F.struct(F.lit(i).alias("case_id"), known[case_name(i)].cast("long").alias("wrong") if case_name(i) in known
                              else F.lit(None).cast("long").alias("wrong")) for i in asked])
    status = F.when(F.col("wrong").isNull(), "SKIP").when(F.col("wrong") == _BROKEN, "ERROR").when(F.col("wrong") == 0, "PASS").otherwise("FAIL")
    return total.select(*scope, F.explode(rows).alias("c")).select(*scope, "c.case_id", "c.wrong").select(
        *scope, "case_id", status.alias("status"), F.nullif(F.col("wrong"), F.lit(_BROKEN).cast("long")).alias("wrong"))


def bands_complete(elements: DataFrame, scope: list[str]) -> DataFrame:
    """(scope..., code, complete) of every indicator code: whether an earlier and a later band stand on it."""
    code = F.regexp_replace("code", r"(?U)^\s+|\s+$", "")
    band = F.coalesce("age_band", F.lit(""))
    t = elements.where("level = 'indicator'").withColumn("code", code).where("code <> ''").groupBy(*scope, "code").agg(
        F.max(band.contains("Early")).alias("_e"), F.max(band.contains("Later")).alias("_l"))
    return t.select(*scope, "code", (F.col("_e") & F.col("_l")).alias("complete"))
