"""Small helpers every operator uses: table access, staging, versions of rows."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: Blank characters that people and scanners leave around codes: white space,
#: no-break spaces, zero-width characters and the byte order mark.
BLANKS = r"[\s\u00a0\u2000-\u200d\u202f\u2060\u3000\ufeff]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` (a file or a directory of part files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    A session without one must be local (tests, a laptop): a temporary folder is made then, and
    removed at exit. On a cluster there is no folder that every executor is sure to see, so
    this raises."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="hierarq-"))
        atexit.register(shutil.rmtree, _own_dir[0], True)
    return _own_dir[0]


def shared_path(spark: SparkSession, kind: str, label: str = "") -> str:
    """A new path in the shared folder. It is registered for deletion when the driver's JVM ends, since results
    that are still to be computed may read it until then; a driver that is killed leaves it."""
    path = f"{shared_dir(spark).rstrip('/')}/hierarq-{kind}/{label}{'-' if label else ''}{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target)  # only a path that exists can be registered
    files.deleteOnExit(target)
    return path


def staged(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and the rows outlive any executor
    (unlike a local checkpoint). The job runs at once, while a query is being put together. With ``by`` (a
    column of few values that is not null) a reader of some values reads only their files."""
    spark = df.sparkSession
    path = shared_path(spark, "stage", label)
    out = df.write.mode("overwrite")
    (out.partitionBy(by) if by else out).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_kept: dict[tuple, DataFrame] = {}


def kept(spark: SparkSession, source: str, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The staged table ``make`` returns, made once per application and state of the files at ``source``; made
    anew if they have changed, or if the staged files are gone."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def files(path: str) -> list[tuple]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        return [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)] if fs.exists(p) else []

    key = (spark.sparkContext.applicationId, label, source, tuple(files(source)))
    had = _kept.get(key)
    if had is None or not any(files(f.rsplit("/", 1)[0]) for f in had.inputFiles()[:1]):
        had = _kept[key] = make()
    return had


def code_key(c: Column) -> Column:
    """Codes compare without surrounding blanks and letter case; blank gives null."""
    t = F.upper(F.regexp_replace(c, f"^{BLANKS}+|{BLANKS}+$", ""))
    return F.when(t == "", None).otherwise(t)


def current_version(df: DataFrame, key: str = "id", at: str = "loaded_at", columns: list[str] | None = None) -> DataFrame:
    """The version with the latest ``at`` of each ``key``; equal copies count once.

    With ``columns`` the key and these come out, and only these and ``at`` are read and shuffled.
    Versions that tie on ``at`` are decided by the greatest row in column order, so
    the result never depends on partitioning. Rows with a null key are dropped. The
    aggregation combines map-side: a key with many versions costs one row per task.
    """
    rest = [c for c in (df.columns if columns is None else columns) if c not in (key, at)]
    packed = F.struct(F.col(at), *[F.col(c) for c in rest])
    best = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(packed).alias("_v"))
    out = [c for c in (df.columns if columns is None else columns) if c != key]
    return best.select(key, *[F.col(f"_v.{c}").alias(c) for c in out])


#: A key is hot when it has more rows than this and more than one in ``HOT_PART`` of all; so at most
#: ``HOT_PART`` keys are. Its rows are dealt into ``SALTS`` shares.
HOT_ROWS, HOT_PART, SALTS = 1_000_000, 1_000, 64


def hot_keys(counts: DataFrame, on: list[str]) -> list[Row]:
    """The hot keys of ``counts`` (on..., n), at most ``HOT_PART``."""
    most = counts.agg(F.max("n").alias("most"), F.sum("n").alias("total")).first()
    if not most.most or most.most <= HOT_ROWS:
        return []
    return counts.where(F.col("n") > max(HOT_ROWS, most.total / HOT_PART)).select(*on).collect()


def _surely_small(df: DataFrame) -> bool:
    """Whether, by the optimizer's estimate, there are not even bytes enough for one hot key."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) < 8 * HOT_ROWS


def salted_join(rows: DataFrame, lookup: DataFrame, on: list[str], spread: Column, how: str = "inner",
                counts: DataFrame | None = None) -> DataFrame:
    """Join of many ``rows`` per key with a ``lookup`` that is unique on ``on``.

    Rows are first counted per key (or ``counts`` (on..., n) says how many there are), unless there are too few
    for a hot key. Without one this is a plain join. Only the rows of hot keys are dealt over shares, by ``spread`` (a column
    that differs between them), and only their lookup rows are repeated, once per share. ``how`` is
    inner, left, left_semi or left_anti."""
    if _surely_small(rows):
        return rows.join(lookup, on, how)
    hot = hot_keys(rows.groupBy(*on).agg(F.count("*").alias("n")) if counts is None else counts, on)
    if not hot:
        return rows.join(lookup, on, how)
    spark = rows.sparkSession
    schema = rows.select(*on).schema.add("_hot", "boolean")
    named = F.broadcast(spark.createDataFrame([(*h, True) for h in hot], schema))

    def marked(df: DataFrame) -> DataFrame:
        same = F.lit(True)
        for c in on:
            same = same & df[c].eqNullSafe(named[c])
        return df.join(named, same, "left").select(*[df[c] for c in df.columns], F.coalesce("_hot", F.lit(False)).alias("_hot"))

    share = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    a = marked(rows).withColumn("_salt", F.when(F.col("_hot"), share).otherwise(0)).drop("_hot")
    shares = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    b = marked(lookup).withColumn("_salt", F.explode(shares)).drop("_hot")
    return a.join(b, [*on, "_salt"], how).drop("_salt")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that workers can import it
    wherever they run. The driver's file server hands it out; nothing is read from a shared disk."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = Path(__file__).resolve().parent
    if root.suffix == ".zip" or not root.is_dir():
        return
    folder = tempfile.mkdtemp(prefix="hierarq-ship-")
    atexit.register(shutil.rmtree, folder, True)
    target = Path(folder) / f"hierarq_{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
