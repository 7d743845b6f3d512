"""Tiered data quality: declarative checks compiled into one aggregate, outcomes, decision, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIERS = ("critical", "quality", "monitoring")


@dataclass(frozen=True)
class Check:
    """``metric`` is one of the names in :func:`metric`; a value outside [fail_low, fail_high] fails, outside the warn bounds warns."""

    tier: str
    name: str
    metric: str
    column: str = ""
    valid: str = "true"  # SQL condition for invalid_count, or a whole check for custom
    fail_low: float | None = None
    fail_high: float | None = None
    warn_low: float | None = None
    warn_high: float | None = None


SPEC = "tier string, name string, metric string, column string, valid string, fail_low double, fail_high double, warn_low double, warn_high double"


def compiled(spec: DataFrame) -> list[Check]:
    """Checks from rows of a check table; the rows, one for each check of a table, come to the driver."""
    return [Check(**{k: v for k, v in row.asDict().items() if v is not None}) for row in spec.orderBy("tier", "name").collect()]


def metric(check: Check) -> Column | None:
    """The aggregate of a check; None for those that need their own pass (duplicates)."""
    c = F.col(f"`{check.column}`") if check.column else F.lit(1)
    made = {
        "row_count": lambda: F.count(F.lit(1)),
        "missing_count": lambda: F.count_if(c.isNull()),
        "missing_percent": lambda: F.round(F.try_divide(100.0 * F.count_if(c.isNull()), F.count(F.lit(1))), 4),
        "invalid_count": lambda: F.count_if(c.isNotNull() & ~F.coalesce(F.expr(check.valid), F.lit(False))),
        "min": lambda: F.min(c),
        "max": lambda: F.max(c),
        "min_length": lambda: F.min(F.length(c.cast("string"))),
        "max_length": lambda: F.max(F.length(c.cast("string"))),
        "custom": lambda: F.count_if(~F.coalesce(F.expr(check.valid), F.lit(False))),
    }.get(check.metric)
    return None if made is None else made().cast("double")


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, duplicates, rows``: values of each column that occur more than once; one pass over all columns."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns))).alias("x")).select("x.*")
    n = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    return n.groupBy("column").agg(F.count_if((F.col("n") > 1) & F.col("value").isNotNull()).alias("duplicates"), F.sum("n").alias("rows"))


def outcome(value: Column, check: Check) -> Column:
    """Fail wins over warn; no value is an error."""
    beyond = lambda low, high: (value < low if low is not None else F.lit(False)) | (value > high if high is not None else F.lit(False))
    return F.when(value.isNull(), "error").when(beyond(check.fail_low, check.fail_high), "fail").when(beyond(check.warn_low, check.warn_high), "warn").otherwise("pass")


def judged(value, check: Check) -> str:
    """:func:`outcome` of a value that is known."""
    beyond = lambda low, high: low is not None and value < low or high is not None and value > high
    if value is None:
        return "error"
    return "fail" if beyond(check.fail_low, check.fail_high) else "warn" if beyond(check.warn_low, check.warn_high) else "pass"


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``tier, check_name, column_name, metric, value, outcome``; a check on an absent column is an error."""
    known = set(df.columns)
    ok = [c for c in checks if not c.column or c.column in known]
    plain = [c for c in ok if not c.metric.startswith("duplicate")]
    row = lambda c, value: F.struct(F.lit(c.tier).alias("tier"), F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"), F.lit(c.metric).alias("metric"), value.alias("value"), outcome(value, c).alias("outcome"))
    parts = []
    if plain:
        wide = df.agg(*(metric(c).alias(f"m{i}") for i, c in enumerate(plain)))
        parts.append(wide.select(F.inline(F.array(*(row(c, F.col(f"m{i}")) for i, c in enumerate(plain))))))
    twice = [c for c in ok if c.metric.startswith("duplicate")]
    if twice:
        columns = sorted({c.column for c in twice})
        of = lambda c, field: F.max(F.when(F.col("column") == c, F.col(field)))
        counted = duplicates(df, columns).agg(*(of(c, f).alias(f"{i}{f}") for i, c in enumerate(columns) for f in ("duplicates", "rows")))
        n = lambda c, field: F.coalesce(F.col(f"{columns.index(c.column)}{field}"), F.lit(0))
        value = lambda c: n(c, "duplicates").cast("double") if c.metric == "duplicate_count" else F.try_divide(100.0 * n(c, "duplicates"), n(c, "rows"))
        parts.append(counted.select(F.inline(F.array(*(row(c, value(c)) for c in twice)))))
    absent = [c for c in checks if c.column and c.column not in known]
    if absent:
        parts.append(df.sparkSession.range(1).select(F.inline(F.array(*(row(c, F.lit(None).cast("double")) for c in absent)))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The required columns that are missing."""
    want = df.sparkSession.createDataFrame([(c,) for c in required], "column_name string")
    have = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column_name string")
    return want.join(have, "column_name", "left_anti")


def missing_columns(catalogue: DataFrame, required: Sequence[str]) -> DataFrame:
    """``table_name, column_name``: required columns that tables of a catalogue (``table_name, name``) lack."""
    want = F.array(*(F.lit(c) for c in required))
    have = catalogue.groupBy("table_name").agg(F.collect_set(F.when(F.col("name").isin(*required), F.col("name"))).alias("have"))
    return have.select("table_name", F.explode(F.array_except(want, "have")).alias("column_name"))


def whitespace_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``keys, column, n, trimmed``: values with blanks at an end, with their lengths as they are and trimmed; one pass."""
    each = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns))
    long = df.select(*keys, F.inline(each)).where(F.col("value") != F.trim("value"))
    return long.select(*keys, "column", F.length("value").cast("long").alias("n"), F.length(F.trim("value")).cast("long").alias("trimmed"))


def validate_audit(audit: DataFrame, required: Sequence[str], latest: Column) -> DataFrame:
    """``check_name, ok`` of six checks on an audit table; repeated load ids come from one count by load id."""
    some = lambda c: F.max(F.coalesce(c, F.lit(False)))
    lacks = F.lit(False)
    for c in required:
        lacks = lacks | F.col(c).isNull()
    ts, params = F.col("ingest_timestamp"), F.col("query_parameters")
    by_id = audit.groupBy("load_id").agg(
        F.count("*").alias("n"), some(lacks).alias("lacks"), some((ts > latest) | (ts < F.lit("2020-01-01").cast("timestamp_ntz"))).alias("late"),
        some(params.isNotNull() & F.try_parse_json(params).isNull()).alias("broken"), some(F.col("is_reprocessed") & F.col("reprocessing_reason").isNull()).alias("unexplained"))
    none = lambda c: ~F.coalesce(F.max(c), F.lit(False))
    checks = {"no_duplicates": none(F.col("n") > 1), "all_fields_populated": none("lacks"), "valid_timestamps": none("late"), "valid_json": none("broken"), "reprocessed_flag_consistent": none("unexplained"), "has_data": F.count("*") > 0}
    return by_id.agg(*(c.alias(k) for k, c in checks.items())).unpivot([], list(checks), "check_name", "ok")


def tier_counts(results: DataFrame) -> DataFrame:
    count = lambda o: F.count_if(F.col("outcome") == o).alias({"pass": "passed", "fail": "failed", "error": "errors", "warn": "warned"}[o])
    return results.groupBy("tier").agg(*(count(o) for o in ("pass", "fail", "error", "warn")))


def decision(results: DataFrame) -> DataFrame:
    """``tier, status`` of all three tiers and ``overall``; tiers after a critical stop have not run, errors count as failures."""
    bad = lambda t: F.count_if((F.col("tier") == t) & F.col("outcome").isin("fail", "error"))
    n = results.agg(*(bad(t).alias(t) for t in TIERS), F.count_if((F.col("tier") == "monitoring") & (F.col("outcome") == "warn")).alias("warned"))
    stop = F.col("critical") > 0
    quality = F.when(stop, "NOT_RUN").when(F.col("quality") > 0, "FAIL").otherwise("PASS")
    monitoring = F.when(stop, "NOT_RUN").when(F.col("monitoring") > 0, "FAIL").when(F.col("warned") > 0, "WARNING").otherwise("PASS")
    overall = F.when(stop, "CRITICAL_FAIL").when((F.col("quality") > 0) | (F.col("monitoring") > 0), "QUALITY_FAIL").when(F.col("warned") > 0, "WARNING").otherwise("PASS")
    row = lambda t, s: F.struct(F.lit(t).alias("tier"), s.alias("status"))
    return n.select(F.inline(F.array(row("critical", F.when(stop, "FAIL").otherwise("PASS")), row("quality", quality), row("monitoring", monitoring), row("overall", overall))))


def report(results: DataFrame, n_rows: DataFrame, n_columns: int) -> DataFrame:
    """One row: totals, pass rate, table size, names of what did not pass, each with its tier (``tier:name``)."""
    names = lambda o: F.array_join(F.sort_array(F.collect_list(F.when(F.col("outcome") == o, F.concat_ws(":", "tier", "check_name")))), ",").alias(f"{o}_checks")
    total = F.count(F.lit(1))
    one = results.agg(total.alias("total_checks"), F.round(100.0 * F.count_if(F.col("outcome") == "pass") / total, 2).alias("pass_rate"), names("fail"), names("error"), names("warn"))
    return one.crossJoin(n_rows).withColumn("column_count", F.lit(n_columns))  # one row each
