"""Structured Streaming forms of landing, deduplication, usage windows, sessions, keyed progress and quality gates."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.streaming.query import StreamingQuery

from lakeforge.operators import dq
from lakeforge.sources.sinks import upsert


def events_stream(spark: SparkSession, path: str, schema, ts: str = "ts", files: int | None = None) -> DataFrame:
    """A Parquet folder as a stream, at most ``files`` files a batch; the event time becomes a zoned timestamp, as watermarks need."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))


def finished(writer) -> StreamingQuery:
    """The query after all that is there now has been processed."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Processes what is there in append mode (windows that the watermark has closed) and returns the written rows."""
    finished(stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).option("path", path))
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def for_each_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    return finished(stream.writeStream.outputMode(mode).foreachBatch(fn).option("checkpointLocation", checkpoint))


# A table of hash buckets by key


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    at, fs = _files(spark, path)
    new, _ = _files(spark, f"{path}.new")
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(at, False)
    fs.rename(new, at)


def _delete(spark: SparkSession, path: str) -> None:
    at, fs = _files(spark, path)
    fs.delete(at, True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed batches that are still on storage, ascending."""
    at, fs = _files(spark, f"{path}/versions")
    names = [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def current(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    """The batch that last wrote each bucket, as of a version."""
    text = spark.read.text(f"{path}/versions/{version}.json", wholetext=True).first()[0]
    return {int(k): v for k, v in json.loads(text).items()}


def _rows(spark: SparkSession, path: str, schema, buckets: dict[int, int]) -> DataFrame:
    folders = [f"{path}/data/{v}/__bucket={b}" for b, v in sorted(buckets.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def landed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table as of the last committed batch; empty where there is none."""
    found = versions(spark, path)
    return _rows(spark, path, schema, current(spark, path, found[-1]) if found else {})


def land(stream: DataFrame, keys: Sequence[str], path: str, checkpoint: str, keep: Sequence[str] = (), order: str | None = None, buckets: int = 64) -> DataFrame:
    """Micro-batches upserted by key into a table of hash buckets; of rows with one key the last by ``order`` counts.

    A batch writes anew only the buckets that its keys fall into, so what it writes is bounded by them and not by the table,
    then a small file that names the batch which last wrote each bucket. What a batch starts from is found on storage: the
    newest such file with a smaller number. So restarts go on from there, a batch run again makes the same version again,
    and a start without new data returns what is there. Buckets that neither the last version nor the one before it names are deleted.
    """
    spark = stream.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def merge(batch: DataFrame, n: int) -> None:
        batch = batch.persist()
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
        before = [v for v in versions(spark, path) if v < n]
        old = current(spark, path, before[-1]) if before else {}
        rows = upsert(_rows(spark, path, batch.schema, {b: old[b] for b in touched if b in old}), batch, keys, keep, order)
        rows.withColumn("__bucket", bucket).repartition(max(1, len(touched)), "__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(f"{path}/data/{n}")
        _put(spark, f"{path}/versions/{n}.json", json.dumps(old | dict.fromkeys(touched, n)))
        batch.unpersist()
        named = set(old.items()) | {(b, n) for b in touched}
        for v in before[:-1]:
            for b, at in set(current(spark, path, v).items()) - named:
                _delete(spark, f"{path}/data/{at}/__bucket={b}")
            _delete(spark, f"{path}/versions/{v}.json")

    for_each_batch(stream, merge, checkpoint)
    return landed(spark, path, stream.schema)


# Event-time operators


def dedup_hash(stream: DataFrame, ts: str, key: Sequence[str], horizon: str) -> DataFrame:
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(list(key))


def usage_window(stream: DataFrame, by: str, ts: str, limit: int, length: str = "7 days", slide: str = "1 day", late: str = "1 day") -> DataFrame:
    w = F.window(ts, length, slide)
    n = stream.withWatermark(ts, late).groupBy(by, w).agg(F.count("*").alias("used"))
    return n.select(by, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "used", (F.col("used") > limit).alias("over_limit"))


def tumbling(stream: DataFrame, by: str, ts: str, length: str = "1 day", late: str = "1 day") -> DataFrame:
    n = stream.withWatermark(ts, late).groupBy(by, F.window(ts, length)).agg(F.count("*").alias("n"))
    return n.select(by, F.col("window.start").alias("start"), "n")


def sessions(stream: DataFrame, by: str, ts: str, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    n = stream.withWatermark(ts, late).groupBy(by, F.session_window(ts, gap)).agg(F.count("*").alias("n"))
    return n.select(by, F.col("session_window.start").alias("start"), "n")


def entity_state(stream: DataFrame, by: str, items: Column, error: Column, done: Column) -> DataFrame:
    """Running pages, items and errors of each entity and whether it is completed (update mode: a row for each entity that a batch touches, the last is current)."""
    some = F.coalesce(F.max(F.coalesce(done, F.lit(False))), F.lit(False))
    return stream.groupBy(by).agg(F.count("*").alias("pages"), F.coalesce(F.sum(items), F.lit(0)).alias("items"), F.count_if(error).alias("errors"), some.alias("completed"))


def gate(stream: DataFrame, checks: Sequence[dq.Check], good: str, bad: str, checkpoint: str) -> list[dict]:
    """Batches that pass all checks go to ``good``, others to ``bad``, each in a folder of its number; the outcomes of the checks.

    A batch is written once: its checks are taken from that write, then its folder is given its place. Checks on duplicates, which need
    a shuffle, read what has been written.
    """
    spark, said = stream.sparkSession, []
    observed = [c for c in checks if dq.metric(c) is not None]
    rest = [c for c in checks if dq.metric(c) is None]

    def route(batch: DataFrame, n: int) -> None:
        seen = Observation()
        pending = f"{checkpoint}/pending/batch={n}"
        watched = batch.observe(seen, F.count(F.lit(1)).alias("n_rows"), *(dq.metric(c).alias(f"m{i}") for i, c in enumerate(observed)))
        watched.write.mode("overwrite").parquet(pending)
        values = seen.get
        found = [dict(batch=n, check_name=c.name, value=values[f"m{i}"], outcome=dq.judged(values[f"m{i}"], c)) for i, c in enumerate(observed)]
        if rest:
            found += [dict(batch=n, check_name=r.check_name, value=r.value, outcome=r.outcome) for r in dq.run_checks(spark.read.schema(batch.schema).parquet(pending), rest).collect()]
        place = bad if any(f["outcome"] in ("fail", "error") for f in found) else good
        said.extend(found)
        for old in (good, bad):
            _delete(spark, f"{old}/batch={n}")
        new, fs = _files(spark, f"{place}/batch={n}")
        fs.mkdirs(new.getParent())
        if not fs.rename(_files(spark, pending)[0], new):
            raise OSError(f"could not move batch {n} to {place}")

    for_each_batch(stream, route, checkpoint)
    return said
