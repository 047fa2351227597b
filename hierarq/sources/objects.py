"""Object sources and sinks: raw files with metadata, JSON objects, canonical records, JDBC.

A missing object reads as an empty table (``missing_ok``) or raises; writes replace the whole
target, a job lost half-way leaves no partial target visible to readers of its success file.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ACCEPTED = (".pdf", ".html")


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, modified, size, content, accepted) of the files under ``path``; empty files do not show."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return b.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"), "content",
                    F.regexp_extract(F.lower("path"), "\\.[^.]+$", 0).isin(*ACCEPTED).alias("accepted"))


def ingest(files: DataFrame, meta: dict[str, str], target: str) -> DataFrame:
    """Accepted files with their metadata, written by country, state and year; returns all
    files with a status: success, or error with the reason."""
    ok = F.col("accepted") & (F.col("size") > 0)
    tagged = files.select("*", *[F.lit(v).alias(k) for k, v in meta.items()])
    tagged.where(ok).write.mode("append").partitionBy("country", "state", "version_year").parquet(target)
    return files.select("path", F.when(ok, "success").otherwise("error").alias("status"),
                        F.when(~F.col("accepted"), "unsupported format").when(F.col("size") == 0, "empty file").alias("reason"))


def read_json(spark: SparkSession, path: str, schema: str, missing_ok: bool = False, whole_files: bool = False) -> DataFrame:
    """JSON objects, one per line or one per file (``whole_files``), with a declared schema."""
    try:
        return spark.read.schema(schema).json(path, multiLine=whole_files)
    except AnalysisException:
        if missing_ok:
            return spark.createDataFrame([], schema)
        raise


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_canonical(records: DataFrame, path: str) -> None:
    """Canonical records by country, state and year; of one id the last by ``seq`` counts."""
    rest = [c for c in records.columns if c not in ("standard_id", "seq")]
    last = records.groupBy("standard_id").agg(F.max_by(F.struct(*rest), F.col("seq")).alias("r")).select("standard_id", "r.*")
    last.write.mode("overwrite").partitionBy("country", "state", "version_year").json(path)


def jdbc_table(spark: SparkSession, url: str, query: str, key: str | None = None, bounds: tuple[int, int] = (0, 0),
               partitions: int = 1, timeout_s: int = 30, driver: str | None = None) -> DataFrame:
    """A table or query of a relational store; with ``key`` it is read in parallel ranges."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) t").option("queryTimeout", timeout_s)
    if driver:
        r = r.option("driver", driver)
    if key:
        r = r.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return r.load()


def statement(spark: SparkSession, sql: str, **params: object) -> DataFrame:
    """A SQL statement with named parameters (``:name``), never spliced into the text."""
    return spark.sql(sql, args=params)


def content_key(df: DataFrame, state: str, text: str) -> DataFrame:
    """Cache key of an extraction: state and the first 16 signs of the hash of its text."""
    return df.withColumn("cache_key", F.concat(F.col(state), F.lit("-"), F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 16)))


def ingest_plan(files: DataFrame, there: DataFrame) -> DataFrame:
    """``files`` (path, size, ...) with status, reason and action: files of another format or without content are
    errors; a file whose path is among ``there`` (path) gets its metadata replaced, others are put."""
    known = there.select("path").distinct().withColumn("_there", F.lit(True))
    form = F.regexp_extract(F.lower("path"), "\\.[^.]+$", 0).isin(*ACCEPTED)
    ok = form & (F.col("size") > 0)
    return files.join(known, "path", "left").withColumns({
        "status": F.when(ok, "success").otherwise("error"),
        "reason": F.when(~form, "unsupported format").when(~(F.col("size") > 0), "empty file"),
        "action": F.when(ok, F.when(F.col("_there"), "replace metadata").otherwise("put"))}).drop("_there")


def extraction_results(documents: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Per document: blocks, pages (the last page number), the way it is read (a job for PDF, else directly) and
    status; one without any block is an error."""
    got = blocks.groupBy(key).agg(F.count("*").alias("total_blocks"), F.max("page_number").alias("total_pages"))
    n = F.coalesce("total_blocks", F.lit(0).cast("long"))
    return documents.join(got, key, "left").select(
        key, n.alias("total_blocks"), "total_pages", F.when(F.lower(key).endswith(".pdf"), "job").otherwise("direct").alias("way"),
        F.when(n == 0, "error").otherwise("success").alias("status"))


def statement_one(spark: SparkSession, sql: str, **params: object) -> DataFrame:
    """The first row of a statement, or none."""
    return statement(spark, sql, **params).limit(1)


def read_golden(spark: SparkSession, base: str, states: list[str], schema: str) -> DataFrame:
    """Golden sets under ``base``, one folder or file per state; states without one are skipped."""
    out = read_json(spark, f"{base}/none", schema, missing_ok=True).withColumn("state", F.lit(""))
    for state in states:
        out = out.unionByName(read_json(spark, f"{base}/{state}", schema, missing_ok=True).withColumn("state", F.lit(state)))
    return out
