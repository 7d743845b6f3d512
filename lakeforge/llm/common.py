"""Shared helpers: shared-folder staging, word rules, connected components."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs without blank and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of an Arrow batch handed to Python, about, so that batches of long texts stay small.
ARROW_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's bound of Arrow batches to ``ARROW_BYTES`` (for good: frames are run after they are returned)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    bound = spark.conf.get(key, None)
    if bound is None or not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(bound) <= ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only where that is unset (tests), a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Spark deletes a query's shuffle files as soon as it has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged(df: DataFrame, *used: DataFrame, by: str | None = None) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: cuts lineage, survives lost executors.

    ``by``: a column with few values, for a folder each. Staged tables ``used``, which nothing else needs, are deleted then.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(path, partitionBy=by)
    dropped(*used)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of staged tables."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.staged_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def n_words(text: Column) -> Column:
    """Number of words (null text: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc32_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as decimal text; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def components(edges: DataFrame, roots: bool = True) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges`` has long columns ``a`` and ``b``. Returns ``id, component_id`` (smallest id reachable) for every
    id of an edge between two different ids; without ``roots``, those that are their component's are left out. Every step is joins and min aggregates, so a hub with many
    edges is combined before the shuffle and its join side can be split; nothing reaches the driver but
    one count per round.
    """
    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        # done when all edges go from ids with one edge to ids that are no such ends: each to the smallest of its component
        ends = e.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(e.select("v", F.lit(0), F.lit(1)))
        ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not ends.where("up > 1 or (up > 0 and down > 0)").agg(F.count("*")).first()[0]:
            out = e.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
            if roots:
                return staged(out.unionAll(e.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()), e)
            out.staged_path = e.staged_path
            return out
        # large star: each larger neighbour goes to the smallest id around
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        big = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        big = staged(big, e)  # as many rows as edges at most
        # small star: the smaller neighbours and the id itself go to the smallest of them
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").select(F.inline(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
        e = staged(small.where("u <> v").distinct(), big)
