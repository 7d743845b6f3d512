"""Joins, windows and set operations that ingestion and resume need."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.types import StringType, StructField, StructType


def incomplete(ids: DataFrame, states: DataFrame, key: str, completed: str = "completed") -> DataFrame:
    """Ids without a completed state; repeated ids stay."""
    return ids.join(states.where(completed).select(key), key, "left_anti")


def absent(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys ``others`` lacks; repeated rows stay, and so do those with a null key, which equals none."""
    return rows.join(others.select(*keys), list(keys), "left_anti")


def numbered(df: DataFrame, order: str, name: str = "pos", parts: int | None = None) -> DataFrame:
    """Adds a global row number from 1 in the order of one column, without bringing all rows to one task.

    Rows are range-partitioned and numbered within; the partitions' sizes (one row each) are summed.
    """
    ranged = df.repartitionByRange(parts, order) if parts else df.repartitionByRange(order)
    inside = ranged.withColumn("__part", F.spark_partition_id())
    rn = F.row_number().over(Window.partitionBy("__part").orderBy(order))
    sizes = inside.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return inside.withColumn(name, rn).join(F.broadcast(before), "__part").withColumn(name, F.col(name) + F.col("__before")).drop("__part", "__before")


def chunked(ids: DataFrame, order: str, size: int = 25) -> DataFrame:
    return numbered(ids, order).withColumn("chunk", F.floor((F.col("pos") - 1) / size) + 1)


def update_from(target: DataFrame, updates: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """A column overwritten where ``updates`` has the key and a value."""
    new = updates.select(*keys, F.col(column).alias("__new"))
    return target.join(new, list(keys), "left").withColumn(column, F.coalesce("__new", column)).drop("__new")


def coverage(requested: DataFrame, returned: DataFrame, key: str) -> DataFrame:
    """Requested, matched, unmatched ids and the rate, over distinct ids."""
    joined = requested.select(key).distinct().join(returned.select(key, F.lit(1).alias("hit")).distinct(), key, "left")
    n = joined.agg(F.count("*").alias("requested"), F.count("hit").alias("matched"))
    return n.select("requested", "matched", (F.col("requested") - F.col("matched")).alias("unmatched"), F.round(100.0 * F.col("matched") / F.col("requested"), 2).alias("rate"))


def rehydrate(results: DataFrame, completed: DataFrame, key: str) -> DataFrame:
    """This run's results, and those completed before that it lacks."""
    return results.unionByName(completed.join(results.select(key), key, "left_anti"))


def fresh_lookup(requests: DataFrame, cached: DataFrame, key: Sequence[str], ts: str, ttl_seconds: int, value: str) -> DataFrame:
    """Each request with the newest cached value of its key that is older than the request by at most ``ttl_seconds``.

    Both sides are cut into stretches of the time to live. An entry goes to its own stretch and the next one, so a request finds
    all that can be fresh in its own; a running last value over both sides together then needs no pairs, and a hot key
    is as many groups as it has stretches. A null key matches nothing.
    """
    t, ttl = F.unix_micros(F.col(ts).cast("timestamp")), ttl_seconds * 1_000_000
    stretch = F.floor(F.col("__t") / ttl)
    a = requests.select("*", t.alias("__t"), F.lit(1).alias("__side"), F.lit(None).cast(cached.schema[value].dataType).alias("__v"), F.lit(None).cast("long").alias("__at")).withColumn("__stretch", stretch)
    b = cached.where(" and ".join(f"`{k}` is not null" for k in [*key, ts])).select(*(F.col(c) if c in key else F.lit(None).cast(requests.schema[c].dataType).alias(c) for c in requests.columns), t.alias("__t"), F.lit(0).alias("__side"), F.col(value).alias("__v"), t.alias("__at"))
    b = b.withColumn("__stretch", F.explode(F.array(stretch, stretch + 1)))
    w = Window.partitionBy(*key, "__stretch").orderBy("__t", F.desc("__side")).rowsBetween(Window.unboundedPreceding, -1)
    both = a.unionByName(b).withColumn("hit", F.last("__v", ignorenulls=True).over(w)).withColumn("__hit_at", F.last("__at", ignorenulls=True).over(w))
    ok = F.col("__t") - F.col("__hit_at") <= ttl
    return both.where("__side = 1").withColumn("hit", F.when(ok, F.col("hit"))).drop("__t", "__side", "__v", "__at", "__hit_at", "__stretch")


def usage(log: DataFrame, by: str, ts: str, seconds: int, limit: int, stretch: int = 86_400) -> DataFrame:
    """Requests in the trailing window (bound included) of each request, and whether that is within the limit.

    A sweep: the requests of a second come in at it and go out after the window, so usage is one running sum. Groups are cut
    into stretches of time, each with the sum of those before it carried in; work is linear, and a task has at most two
    rows for each second of a stretch, however large a group is. Requests without a time only see each other.
    """
    second = F.unix_timestamp(F.col(ts).cast("timestamp"))
    each = log.groupBy(F.col(by).alias("__by"), second.alias("__at")).agg(F.count("*").alias("__n"))
    step = F.explode(F.array(F.struct(F.col("__at").alias("at"), F.col("__n").alias("n"), F.lit(True).alias("own")), F.struct((F.col("__at") + seconds + 1).alias("at"), (-F.col("__n")).alias("n"), F.lit(False).alias("own"))))
    steps = each.select("__by", step.alias("x")).select("__by", "x.*").where("own or at is not null").withColumn("__stretch", F.floor(F.col("at") / stretch))
    whole = steps.groupBy("__by", "__stretch").agg(F.sum("n").alias("sum"))
    earlier = Window.partitionBy("__by", F.col("__stretch").isNull()).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select(F.col("__by").alias("__of"), F.col("__stretch").alias("__in"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"))
    running = F.sum("n").over(Window.partitionBy("__by", "__stretch").orderBy("at"))  # with all steps at the same second
    inside = steps.withColumn("inside", running).where("own")
    known = inside.join(carried, F.col("__by").eqNullSafe(F.col("__of")) & F.col("__stretch").eqNullSafe(F.col("__in")))
    used = known.select("__by", F.col("at").alias("__at"), (F.col("inside") + F.col("before")).alias("used"))
    joined = log.withColumn("__s", second).join(used, F.col(by).eqNullSafe(F.col("__by")) & F.col("__s").eqNullSafe(F.col("__at")))
    return joined.withColumn("within", F.col("used") < limit).drop("__s", "__by", "__at")


def first_by(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__rn = 1").drop("__rn")


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All sources by name with a ``source`` column; columns that one lacks are null."""
    out = None
    for name, df in sources.items():
        df = df.withColumn("source", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def union_isolated(sources: Mapping[str, Callable[[], DataFrame]], schema: StructType, folder: str) -> tuple[DataFrame, DataFrame]:
    """All sources that can be read and cast to ``schema``, with a ``source`` column, and a status row of each source.

    Each source is made and stored by itself below ``folder``, so one that fails, whether when it is opened or at some row,
    leaves the others as they are: ``source, status (loaded, failed), rows, error``.
    """
    spark, out, said = SparkSession.active(), None, []
    for name, make in sources.items():
        seen, path = Observation(), f"{folder}/{name}"
        try:
            df = make()
            rows = df.select(*(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
            rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
        except PySparkException as e:
            said.append((name, "failed", None, e.getCondition() or str(e).splitlines()[0]))
            continue
        said.append((name, "loaded", seen.get["n"], None))
        stored = spark.read.schema(schema).parquet(path).withColumn("source", F.lit(name))
        out = stored if out is None else out.unionAll(stored)
    if out is None:
        out = spark.createDataFrame([], StructType([*schema.fields, StructField("source", StringType())]))
    return out, spark.createDataFrame(said, "source string, status string, rows long, error string")


# Data Vault

def hash_key(*columns: Column) -> Column:
    return F.sha2(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("\u0000")) for c in columns)), 256)


def hub_load(hub: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Distinct business keys that the hub lacks."""
    return source.select(key).where(F.col(key).isNotNull()).distinct().join(hub.select(key), key, "left_anti").withColumn("hub_key", hash_key(F.col(key)))


def link_load(link: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return source.select(*keys).distinct().join(link.select(*keys), list(keys), "left_anti").withColumn("link_key", hash_key(*map(F.col, keys)))


def satellite_load(satellite: DataFrame, source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Source rows whose attributes differ from the newest satellite row (``load_ts``) of their key."""
    newest = satellite.groupBy(key).agg(F.max_by("hash_diff", "load_ts").alias("__old"))
    new = source.withColumn("hash_diff", hash_key(*map(F.col, columns)))
    return new.join(newest, key, "left").where(~F.col("hash_diff").eqNullSafe(F.col("__old"))).drop("__old")


def rolled_up(facts: DataFrame, by: Sequence[str], metrics: Mapping[str, Column]) -> DataFrame:
    """Metrics of each group, of each leading part of ``by`` (the rest null), and of all."""
    return facts.rollup(*by).agg(*(c.alias(n) for n, c in metrics.items()))
