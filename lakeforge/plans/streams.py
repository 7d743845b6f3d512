"""Streaming queries over ``events``, run to the end of what is there in several micro-batches: SS queries.

Events arrive up to twelve hours after their time, within the watermark's day. Those of ``TARDY`` arrive after all others, when their
windows have long been closed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.operators import dq
from lakeforge.plans.registry import Tables, query
from lakeforge.sources.scratch import scratch
from lakeforge.streaming import streams as X

FILES, FILES_A_BATCH = 8, 2
TARDY = "event_id % 50 = 0 and ts < timestamp_ntz '2024-01-11 00:00:00'"
TARDY_SQL = "event_id % 50 = 0 and ts < timestamp '2024-01-11'"
ON_TIME = f"(select * from events where not ({TARDY_SQL}))"
#: What a watermark of one day has reached in the end.
CLOSED = f"(select date_trunc('millisecond', max(ts)) - interval 1 day from {ON_TIME})"


def dated(t: Tables, path: str, begin: int) -> int:
    """Gives the files of ``path`` that have no time of this kind yet times in the order of their names, as streams read files by time."""
    folder = t.spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(t.spark._jsc.hadoopConfiguration())
    files = sorted((f.getPath().getName(), f.getPath()) for f in fs.listStatus(folder) if f.getPath().getName().endswith(".parquet") and f.getModificationTime() > 1_700_000_100_000)
    for i, (_, file) in enumerate(files, begin):
        fs.setTimes(file, 1_700_000_000_000 + i * 1000, -1)
    return begin + len(files)


def stream(t: Tables) -> DataFrame:
    """``events`` in files by arrival, ``FILES_A_BATCH`` of them a batch, those of ``TARDY`` last."""
    path = scratch(t.spark, "events")
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") * 7919 % 43200 * 1_000_000
    late = F.expr(TARDY)
    t.events.where(~late).repartitionByRange(FILES, arrival).write.parquet(path)
    n = dated(t, path, 0)
    t.events.where(late).coalesce(FILES_A_BATCH).write.mode("append").parquet(path)
    dated(t, path, n)
    return X.events_stream(t.spark, path, t.events.schema, files=FILES_A_BATCH)


def paths(t: Tables) -> tuple[str, str]:
    return scratch(t.spark, "out"), scratch(t.spark, "progress")


@query("stream_land_payload", "select event_id, user_id, event_type from events")
def _(t):
    return X.land(stream(t).select("event_id", "user_id", "event_type"), ["event_id"], *paths(t), buckets=16)


@query("stream_dedup_hash", "select count(distinct (user_id, event_type, props)) as n from events")
def _(t):
    s = X.dedup_hash(stream(t), "ts", ["user_id", "event_type", "props"], "60 days")
    return X.run_to_end(s.select("user_id", "event_type", "props"), *paths(t)).agg(F.count("*").alias("n"))


@query("stream_usage_window", f"select event_type, start, used, used > 300 as over_limit from (select event_type, start, count(*) as used from (select event_type, unnest(range(cast(date_trunc('day', ts) as timestamp) - interval 6 days, cast(date_trunc('day', ts) as timestamp) + interval 1 day, interval 1 day)) as start from {ON_TIME}) group by 1, 2) where start + interval 7 days <= {CLOSED}")
def _(t):
    """Windows that the watermark has closed; tardy rows do not count."""
    out = X.run_to_end(X.usage_window(stream(t), "event_type", "ts", 300), *paths(t))
    return out.select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "used", "over_limit")


@query("stream_error_tumbling", f"select event_type, start, n from (select event_type, cast(date_trunc('day', ts) as timestamp) as start, count(*) as n from {ON_TIME} where event_type = 'error' group by 1, 2) where start + interval 1 day <= (select date_trunc('millisecond', max(ts)) - interval 1 day from {ON_TIME} where event_type = 'error')")
def _(t):
    out = X.run_to_end(X.tumbling(stream(t).where("event_type = 'error'"), "event_type", "ts"), *paths(t))
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("stream_run_sessions", f"with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minutes then 0 else 1 end as fresh from {ON_TIME}), s as (select user_id, ts, sum(fresh) over (partition by user_id order by ts) as k from g) select user_id, min(ts) as start, count(*) as n from s group by user_id, k having max(ts) + interval 30 minutes <= {CLOSED}")
def _(t):
    out = X.run_to_end(X.sessions(stream(t), "user_id", "ts"), *paths(t))
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("stream_entity_state", "select user_id, count(*) as pages, cast(sum(event_id % 7) as bigint) as items, count(*) filter (event_type = 'error') as errors, bool_or(event_type = 'purchase' and event_id % 20 = 0) as completed from events group by 1")
def _(t):
    path, progress = paths(t)

    def keep(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={n}")

    kind = F.col("event_type")
    states = X.entity_state(stream(t), "user_id", F.col("event_id") % 7, kind == "error", (kind == "purchase") & (F.col("event_id") % 20 == 0))
    X.for_each_batch(states, keep, progress, "update")
    return t.spark.read.parquet(path).groupBy("user_id").agg(F.max_by(F.struct("pages", "items", "errors", "completed"), "batch").alias("last")).select("user_id", "last.*")


@query("stream_dq", f"select case when {TARDY_SQL} then 'bad' else 'good' end as route, count(*) as n from events group by 1")
def _(t):
    """Batches with tardy rows fail the gate, others pass."""
    paths = {x: scratch(t.spark, x) for x in ("good", "bad")}
    checks = [dq.Check("critical", "ids", "missing_count", "event_id", fail_high=0), dq.Check("critical", "in_time", "invalid_count", "ts", valid=f"not ({TARDY})", fail_high=0)]
    X.gate(stream(t), checks, paths["good"], paths["bad"], scratch(t.spark, "progress"))
    out = [t.spark.read.parquet(p).agg(F.lit(x).alias("route"), F.count("*").alias("n")) for x, p in paths.items()]
    return out[0].unionAll(out[1])
