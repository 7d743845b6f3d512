"""Sinks: keyed merges on plain tables, reloads, dated layouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.types import StructType


def last_by(updates: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """One row for each key: the greatest by ``order``, then by a hash of the row (so that reruns agree)."""
    at = [F.col(order)] if order else []
    row = F.struct(*updates.columns)
    return updates.groupBy(*keys).agg(F.max_by(row, F.struct(*at, F.xxhash64(F.to_json(row)))).alias("row")).select("row.*")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], keep: Sequence[str] = (), order: str | None = None) -> DataFrame:
    """``target`` with ``updates`` by key. Updates win (nulls too), but for ``keep``, which rows that exist retain.

    Of updates with one key the last by ``order`` counts. Rows with a null key never match and are added.
    """
    new = last_by(updates, keys, order).select(*keys, F.struct(*(c for c in target.columns if c not in keys)).alias("new"))
    old = target.select(*keys, F.struct(*(c for c in target.columns if c not in keys)).alias("old"))
    both = old.join(new, list(keys), "full_outer")
    value = lambda c: F.col(f"old.{c}") if c in keep else F.col(f"new.{c}")
    return both.select(*(F.col(c) if c in keys else F.when(F.col("new").isNull(), F.col(f"old.{c}")).when(F.col("old").isNull(), F.col(f"new.{c}")).otherwise(value(c)).alias(c) for c in target.columns))


def insert_or_replace(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole rows by key; the update replaces, of several the last by a hash of the row."""
    updates = last_by(updates, keys)
    return target.join(updates, list(keys), "left_anti").unionByName(updates)


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``source`` whose key ``target`` lacks, by name in ``target``'s columns, missing ones null; no null keys."""
    new = source.where(" and ".join(f"`{k}` is not null" for k in keys)).join(target, list(keys), "left_anti")
    return new.select(*(F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns))


def run_status(inserted, total):
    return F.when(inserted == 0, "idempotent").when(inserted == total, "all_new").otherwise("partial")


def version_flip(versions: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """``is_current`` true for the newest version of each group alone."""
    w = Window.partitionBy(*by).orderBy(F.desc(order))
    return versions.withColumn("is_current", F.row_number().over(w) == 1)


def flag_update(target: DataFrame, flags: DataFrame, key: str, flag: str) -> DataFrame:
    """One column replaced for the keys in ``flags``."""
    return target.join(flags.select(key, F.col(flag).alias("__new")), key, "left").withColumn(flag, F.coalesce("__new", flag)).drop("__new")


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """Names, order and types of a fixed schema; columns that are absent become null."""
    return df.select(*((F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema))


def reload(df: DataFrame, path: str) -> DataFrame:
    """Truncates and loads a Parquet table; returns it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_dated(df: DataFrame, ts: str, path: str, form: str = "parquet") -> None:
    """A yyyymm/dd directory layout."""
    dated = df.withColumn("yyyymm", F.date_format(ts, "yyyyMM").cast("int")).withColumn("dd", F.dayofmonth(ts))
    dated.write.mode("overwrite").partitionBy("yyyymm", "dd").format(form).save(path)


def report_names(df: DataFrame, table: str, load: str, ts: str) -> DataFrame:
    """``report``: table, load and second of each report; where several share it, all but the first by time get a counter."""
    base = F.concat_ws("_", F.col(table), F.col(load), F.date_format(ts, "yyyyMMdd_HHmmss"))
    w = Window.partitionBy("report").orderBy(ts, F.xxhash64(F.to_json(F.struct(*df.columns))))
    named = df.withColumn("report", base).withColumn("__n", F.row_number().over(w) - 1)
    return named.withColumn("report", F.when(F.col("__n") > 0, F.concat_ws("_", "report", F.col("__n").cast("string"))).otherwise(F.col("report"))).drop("__n")


def read_range(spark: SparkSession, path: str, ts: str, low: str, high: str) -> DataFrame:
    """Rows of a dated table with ``low <= ts < high``; only the days' folders are read."""
    day = F.col("yyyymm") * 100 + F.col("dd")
    bound = lambda x: int(x[:10].replace("-", ""))
    time = lambda x: F.lit(x).cast("timestamp_ntz")
    return spark.read.parquet(path).where((day >= bound(low)) & (day <= bound(high)) & (F.col(ts) >= time(low)) & (F.col(ts) < time(high))).drop("yyyymm", "dd")


def read_days(spark: SparkSession, path: str, days: DataFrame) -> DataFrame:
    """Rows of a dated table of the days in ``days`` (``yyyymm, dd``), found at run time; only their folders are read."""
    return spark.read.parquet(path).join(days.distinct(), ["yyyymm", "dd"], "left_semi").drop("yyyymm", "dd")


def write_reports(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("load_id").json(path)


def write_sorted_ids(ids: DataFrame, path: str) -> None:
    ids.select(F.col("id").cast("string")).orderBy("id").write.mode("overwrite").text(path)


def constrained(df: DataFrame, schema: StructType, key: Sequence[str], defaults: Mapping[str, object] = {}) -> DataFrame:
    """``df`` in a fixed schema: defaults for what is null or absent; a null in a column that is not nullable, and a key that
    rows share, stop the job that writes it."""
    rows = typed(df, schema).withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(schema[c].dataType)) for c, v in defaults.items()})
    needed = [f.name for f in schema if not f.nullable]
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.raise_error(F.lit(f"null in {c}")).cast(schema[c].dataType)) for c in needed})
    n = F.count(F.lit(1)).over(Window.partitionBy(*key))
    said = F.concat(F.lit(f"repeated key {', '.join(key)}: "), F.to_json(F.struct(*key)))
    first = key[0]
    checked = rows.withColumn("__n", n).withColumn(first, F.when(F.col("__n") > 1, F.raise_error(said).cast(schema[first].dataType)).otherwise(F.col(first)))
    return checked.select(*schema.names)


def append_missing(target: DataFrame, source: DataFrame, keys: Sequence[str], path: str) -> dict[str, int]:
    """Appends the rows of ``source`` whose key ``target`` lacks to the table at ``path``.

    Returns ``total``, ``inserted``, ``skipped`` and ``invalid`` (null key), as counted by the write itself.
    """
    known = target.select(*keys).distinct().withColumn("__known", F.lit(True))
    valid = F.lit(True)
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    marked = source.withColumn("__valid", valid).join(known, list(keys), "left")
    seen, fresh = Observation(), F.col("__valid") & F.col("__known").isNull()
    counts = {"total": F.count(F.lit(1)), "inserted": F.count_if(fresh), "skipped": F.count_if(F.col("__known").isNotNull()), "invalid": F.count_if(~F.col("__valid"))}
    new = marked.observe(seen, *(c.alias(n) for n, c in counts.items())).where(fresh)
    new.select(*(F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns)).write.mode("append").parquet(path)
    return dict(seen.get)
