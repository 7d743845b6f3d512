"""Manifests, restarts and run figures of ingestion tables, whatever their columns are called."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(100.0 * part, whole), 2)


def seconds(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6


def summary(entities: DataFrame, by: Sequence[str], status: str = "status", pages: str = "pages") -> DataFrame:
    """Entities by status, share of completed ones, pages."""
    n = lambda s: F.count_if(F.col(status) == s)
    return entities.groupBy(*by).agg(
        F.count("*").alias("entities"), n("completed").alias("completed"), n("failed").alias("failed"), n("partial").alias("partial_count"),
        percent(n("completed"), F.count("*")).alias("success_percent"), F.sum(pages).alias("pages"), F.round(F.avg(pages), 2).alias("pages_per_entity"))


def error_types(errors: DataFrame, by: Sequence[str], kind: Column, entity: str) -> DataFrame:
    """Errors of each kind and entities that have them."""
    return errors.groupBy(*by, kind.alias("error_type")).agg(F.count("*").alias("errors"), F.count_distinct(entity).alias("entities"))


def durations(entities: DataFrame, by: Sequence[str], start: str = "start_time", end: str = "end_time") -> DataFrame:
    """First start, last end, seconds in all and for each entity."""
    g = entities.groupBy(*by).agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("__n"))
    s = seconds(F.col(start), F.col(end))
    return g.select(*by, start, end, F.round(s, 2).alias("seconds"), F.round(s / F.col("__n"), 2).alias("seconds_per_entity"))


def with_error_list(entities: DataFrame, errors: DataFrame, keys: Sequence[str], error: str) -> DataFrame:
    """Entities with the different errors of each, sorted (empty without any)."""
    lists = errors.groupBy(*keys).agg(F.sort_array(F.collect_set(error)).alias("error_list"))
    return entities.join(lists, list(keys), "left").withColumn("error_list", F.coalesce("error_list", F.array().cast("array<string>")))


def authors(rows: DataFrame, author: Column, publication: str, identifier: str, failed: Column) -> DataFrame:
    """Publications, identifiers and failures of each author."""
    return rows.groupBy(author.alias("author_id")).agg(
        F.count_distinct(publication).alias("publications"), F.count_distinct(identifier).alias("unique_ids"), F.count("*").alias("ids"),
        F.count_distinct(F.when(failed, F.col(publication))).alias("failed"), F.coalesce(F.bool_or(failed), F.lit(False)).alias("with_errors"))


def hits(rows: DataFrame, by: Sequence[Column | str], hit: Column, all_: str = "ids", some: str = "results", share: str = "coverage", **more: Column) -> DataFrame:
    """Rows, rows with a hit and their share in each group, and further aggregates."""
    return rows.groupBy(*by).agg(F.count("*").alias(all_), F.count_if(hit).alias(some), percent(F.count_if(hit), F.count("*")).alias(share), *(c.alias(n) for n, c in more.items()))


def params_by_page(rows: DataFrame, by: Column, number: str, size: int = 1000) -> DataFrame:
    """Query parameters of each load in pages of ``size`` numbers, so that no row holds all of a load."""
    ids = F.transform(F.sort_array(F.collect_list(number)), lambda x: x.cast("string"))
    return rows.groupBy(by.alias("load_id"), F.floor(F.col(number) / size).alias("page")).agg(F.array_join(ids, ",").alias("params"))


def payload_files(files: DataFrame, by: Sequence[str], name: str, size_bytes: str) -> DataFrame:
    """``payload_files``: file and size in KB of each payload, as JSON sorted by name."""
    row = F.struct(F.col(name).alias("file"), F.round(F.col(size_bytes) / 1024, 2).alias("size_kb"))
    return files.groupBy(*by).agg(F.to_json(F.sort_array(F.collect_list(row))).alias("payload_files"))


def page_plan(totals: DataFrame, keys: Sequence[str], total: str, size: int = 25) -> DataFrame:
    """One row for each page to fetch, with its offset; none for entities without results."""
    last = F.ceil(F.col(total) / size).cast("long")
    pages = totals.where(last > 0).select(*keys, F.explode(F.sequence(F.lit(1).cast("long"), last)).alias("page"))
    return pages.withColumn("offset_at", (F.col("page") - 1) * size)


def resume_points(pages: DataFrame, keys: Sequence[str], page: str, invalid: Column) -> DataFrame:
    """Where each entity goes on: the page after the last stored one, and the first invalid one."""
    return pages.groupBy(*keys).agg((F.max(page) + 1).cast("long").alias("next_page"), F.min(F.when(invalid, F.col(page))).cast("long").alias("first_invalid"))


def trimmed(states: DataFrame, restart: Column, files: str = "files", hashes: str = "hashes", errors: str = "errors") -> DataFrame:
    """State rows as they were before the page ``restart``: files, hashes and errors (arrays of structs with ``page``) of that page and later ones go.

    ``last_page`` becomes the page before, ``completed`` false.
    """
    at = states.withColumn("__restart", restart)
    return at.withColumns({c: F.filter(c, lambda x: x["page"] < F.col("__restart")) for c in (files, hashes, errors)} | {"last_page": F.col("__restart") - 1, "completed": F.lit(False)}).drop("__restart")


def failed_items(rows: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """The different failed items of each entity, sorted."""
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_set(item)).alias("failed"))


def with_defaults(rows: DataFrame, defaults: Mapping[str, float], flag: str = "has_metrics") -> DataFrame:
    """Missing metrics get their default; ``flag`` tells rows in which some metric differs from it."""
    out, any_ = rows, F.lit(False)
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
        any_ = any_ | (F.col(c) != v)
    return out.withColumn(flag, any_)


def rows_exist(left: DataFrame, right: DataFrame, keys: Sequence[str], flag: str = "there") -> DataFrame:
    """Whether ``right`` has a row with each key."""
    return left.join(right.select(*keys).distinct().withColumn(flag, F.lit(True)), list(keys), "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def rows_intact(rows: DataFrame, keys: Sequence[str], raw: Column) -> DataFrame:
    """Whether no row of a key lacks its raw payload."""
    return rows.groupBy(*keys).agg((F.count(raw) == F.count("*")).alias("ok"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def rows_per(df: DataFrame, by: Column, name: str = "load_id") -> DataFrame:
    return df.groupBy(by.alias(name)).agg(F.count("*").alias("n"))


def operations(df: DataFrame, ts: str, as_of: Column, source: str, recent: str = "interval 24 hours") -> DataFrame:
    """Rows in all and in the time before ``as_of``, oldest and newest, sources."""
    inside = (F.col(ts) > as_of - F.expr(recent)) & (F.col(ts) <= as_of)
    return df.agg(F.count("*").alias("total"), F.count_if(inside).alias("last_day"), F.min(ts).alias("oldest"), F.max(ts).alias("newest"), F.count_distinct(source).alias("sources"))


def run_statistics(runs: DataFrame, status: str = "status", rows: str = "pages", start: str = "start_time", end: str = "end_time") -> DataFrame:
    n = lambda s: F.count_if(F.col(status) == s)
    return runs.agg(F.count("*").alias("runs"), n("completed").alias("successes"), n("failed").alias("failures"), F.sum(rows).alias("rows_inserted"), F.round(F.avg(seconds(F.col(start), F.col(end))), 2).alias("mean_seconds"))
