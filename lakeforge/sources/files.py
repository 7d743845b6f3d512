"""Sources: payload and manifest JSON, id lists, file facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.functions.scalars import strip

MANIFEST = "*_manifest_*.json"


def scan_json(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """One row for each file: ``file, path, size, value``."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), "value")


def scan_payload(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Parseable payload files with a load id; manifests left out."""
    files = scan_json(spark, path, glob).where(~F.col("file").contains("_manifest_"))
    return files.where(F.try_variant_get(F.try_parse_json("value"), "$.metadata.load_id", "string").isNotNull())


def scan_quarantine(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """The payload files that :func:`scan_payload` leaves out, with the reason."""
    files = scan_json(spark, path, glob).where(~F.col("file").contains("_manifest_"))
    v = F.try_parse_json("value")
    reason = F.when(v.isNull(), "malformed").when(F.try_variant_get(v, "$.metadata.load_id", "string").isNull(), "no load_id")
    return files.withColumn("reason", reason).where("reason is not null")


def scan_manifest(spark: SparkSession, path: str, glob: str = MANIFEST) -> DataFrame:
    return scan_json(spark, path, glob)


def scan_ids(spark: SparkSession, path: str) -> DataFrame:
    """One id a line, stripped, blank lines dropped."""
    return spark.read.text(path).select(strip(F.col("value")).alias("id")).where("id <> ''")


def distinct_in_order(ids: DataFrame, pos: str = "pos") -> DataFrame:
    """Each id once, at its first place."""
    return ids.groupBy("id").agg(F.min(pos).alias(pos))


def with_file_stats(names: DataFrame, files: DataFrame) -> DataFrame:
    """Each named file's size in KB, rounded up; null when it is missing."""
    return names.join(files.select("path", F.ceil(F.col("size") / 1024).alias("size_kb")), "path", "left")


def scan_table(df: DataFrame, sample: int | None = None) -> DataFrame:
    """A table in full, or ``sample`` rows of it to look at."""
    return df if sample is None else df.limit(sample)


def dated_files(spark: SparkSession, path: str, day: str, glob: str = "*") -> DataFrame:
    """Lines of one day's files in a yyyymm/dd layout, by file name; other partitions are not read."""
    return spark.read.text(path, pathGlobFilter=glob).where((F.col("yyyymm") == int(day[:6])) & (F.col("dd") == int(day[6:])))
