"""Column profiles in one wide pass and one long one, suggested expectations, checksums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from lakeforge.functions.scalars import stable_bits


def _unpivot(df: DataFrame, columns: Sequence[str], fields: dict) -> DataFrame:
    """Wide aggregates ``{column}#{field}`` as one row for each column."""
    rows = [F.struct(F.lit(c).alias("column_name"), *(F.col(f"`{c}#{f}`").alias(f) for f in fields)) for c in columns]
    return df.select(F.inline(F.array(*rows)))


def _wide(df: DataFrame, columns: Sequence[str], fields: dict) -> DataFrame:
    return _unpivot(df.agg(*(make(F.col(f"`{c}`")).alias(f"{c}#{f}") for c in columns for f, make in fields.items())), columns, fields)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, value, n`` of non-null values; one shuffle for all columns, combined before it."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns))).alias("x")).select("x.*").where("value is not null")
    return long.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def basic(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Totals, nulls, completeness, distinct values and uniqueness of each column."""
    columns = list(columns or df.columns)
    fields = {"total": lambda c: F.count(F.lit(1)), "non_null": F.count}
    if approximate:
        fields["distinct_count"] = F.approx_count_distinct
        wide = _wide(df, columns, fields)
    else:
        distinct = value_counts(df, columns).groupBy("column_name").agg(F.count("*").alias("distinct_count"))
        wide = _wide(df, columns, fields).join(distinct, "column_name", "left").withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)))
    percent = lambda a, b: F.coalesce(F.round(F.try_divide(100.0 * F.col(a), F.col(b)), 2), F.lit(0.0))
    wide = wide.withColumn("null_count", F.col("total") - F.col("non_null"))
    return wide.select("column_name", "total", "null_count", "non_null", percent("null_count", "total").alias("null_percent"), percent("non_null", "total").alias("completeness"), "distinct_count", percent("distinct_count", "non_null").alias("uniqueness"))


def numeric(df: DataFrame) -> DataFrame:
    columns = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    d = lambda make: lambda c: make(c).cast("double")
    return _wide(df, columns, {"min_value": d(F.min), "max_value": d(F.max), "avg_value": lambda c: F.round(F.avg(c), 2), "value_range": lambda c: (F.max(c) - F.min(c)).cast("double")})


def lengths(df: DataFrame) -> DataFrame:
    columns = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    n = lambda c: F.when(c != "", F.length(c))
    return _wide(df, columns, {"min_length": lambda c: F.min(n(c)), "max_length": lambda c: F.max(n(c)), "avg_length": lambda c: F.round(F.avg(n(c)), 1)})


def samples(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` smallest different values of each column."""
    from pyspark.sql import Window

    w = Window.partitionBy("column_name").orderBy("value")
    return value_counts(df, columns).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).select("column_name", "rn", "value")


def distribution(df: DataFrame, columns: Sequence[str], most: int = 10) -> DataFrame:
    """Value counts of columns with at most ``most`` different values."""
    n = value_counts(df, columns)
    few = n.groupBy("column_name").agg(F.count("*").alias("d")).where(F.col("d") <= most)
    return n.join(few.select("column_name"), "column_name", "left_semi")


def range_buffer(low: Column, high: Column) -> tuple[Column, Column]:
    """A tenth of the span (1 if there is none) beyond both ends."""
    pad = F.when(high == low, 1.0).otherwise((high - low) * 0.1)
    return low - pad, high + pad


def suggest(profile: DataFrame) -> DataFrame:
    """Expectations that a basic profile supports: ``column_name, expectation, strength``."""
    c = F.col
    rule = lambda cond, name, strength: F.when(cond, F.struct(F.lit(name).alias("expectation"), F.lit(strength).alias("strength")))
    found = F.array(
        rule(c("null_percent") == 0, "not_null", "strict"),
        rule((c("null_percent") > 0) & (c("null_percent") < 5), "not_null", "mostly"),
        rule((c("uniqueness") == 100) & (c("non_null") > 0), "unique", "strict"),
        rule((c("uniqueness") > 95) & (c("uniqueness") < 100), "unique", "mostly"),
        rule((c("distinct_count") > 0) & (c("distinct_count") <= 10), "in_set", "strict"),
    )
    return profile.select("column_name", F.inline(F.filter(found, lambda x: x.isNotNull())))


def suggest_all(df: DataFrame, columns: Sequence[str] | None = None, patterns: dict | None = None) -> DataFrame:
    """:func:`suggest`, and types, ranges, lengths and patterns: ``column_name, expectation, strength, detail``.

    ``patterns`` maps a column to (regular expression, completeness in percent above which it is suggested, strength).
    """
    columns = list(columns or df.columns)
    kinds = {f.name: f.dataType for f in df.schema if f.name in columns}
    row = lambda c, name, strength, detail: F.struct(F.lit(c).alias("column_name"), F.lit(name).alias("expectation"), F.lit(strength).alias("strength"), detail.cast("string").alias("detail"))
    span = lambda low, high: F.concat(low.cast("string"), F.lit(".."), high.cast("string"))
    exact = lambda x: x.cast("decimal(20,1)")
    numbers = [c for c in columns if isinstance(kinds[c], NumericType)]
    texts = [c for c in columns if isinstance(kinds[c], StringType)]
    n = lambda c: F.length(F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")))
    aggs = [F.count(F.lit(1)).alias("all")] + [f(F.col(f"`{c}`")).alias(f"{c}#{k}") for c in numbers for k, f in (("low", F.min), ("high", F.max))]
    aggs += [f(n(c)).alias(f"{c}#{k}") for c in texts for k, f in (("short", F.min), ("long", F.max))]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"{c}#some") for c in patterns or {}]
    found = [row(c, "of_type", "strict", F.lit(kinds[c].simpleString())) for c in columns]
    for c in numbers:
        low, high = range_buffer(F.col(f"`{c}#low`"), F.col(f"`{c}#high`"))
        found.append(F.when(F.col(f"`{c}#low`").isNotNull(), row(c, "between", "strict", span(exact(low), exact(high)))))
    found += [F.when(F.col(f"`{c}#short`") > 0, row(c, "length_between", "strict", span(F.col(f"`{c}#short`"), F.col(f"`{c}#long`") + 5))) for c in texts]
    found += [F.when(100.0 * F.col(f"`{c}#some`") > least * F.col("all"), row(c, "matches", strength, F.lit(regex))) for c, (regex, least, strength) in (patterns or {}).items()]
    more = df.agg(*aggs).select(F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))
    values = distribution(df, columns).groupBy("column_name").agg(F.to_json(F.array_sort(F.collect_list("value"))).alias("detail"))  # at most ten each
    listed = suggest(basic(df, columns)).join(values.withColumn("expectation", F.lit("in_set")), ["column_name", "expectation"], "left")
    return listed.unionByName(more)


NULL_MARK = "\u0000"


def row_bits(columns: Sequence[str], null_mode: str = "mark") -> Column:
    """48 bits for a row: columns in name order as text, each with its length before it; nulls are marked, or skipped on request.

    ``skip`` joins the bare texts, as the outcomes that it reproduces do.
    """
    texts = [F.col(f"`{c}`").cast("string") for c in sorted(columns)]
    whole = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(NULL_MARK)) for t in texts]
    return stable_bits(F.concat_ws("|", *(texts if null_mode == "skip" else whole)))


def multiset_hash(columns: Sequence[str], null_mode: str = "mark") -> list[Column]:
    """Aggregates that no order of rows changes: count, sum and xor of row hashes."""
    bits = row_bits(columns, null_mode)
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(bits.cast("decimal(38,0)")).cast("string").alias("hash_sum"), F.bit_xor(bits).alias("hash_xor")]


def table_checksum(df: DataFrame, columns: Sequence[str] | None = None, key: str | None = None, null_mode: str = "mark") -> DataFrame:
    """One row; ``status`` is ``error`` for an empty table or a null key."""
    columns = list(columns or df.columns)
    bad = F.count_if(F.col(key).isNull()) > 0 if key else F.lit(False)
    status = F.when((F.count(F.lit(1)) == 0) | bad, "error").otherwise("ok")
    return df.agg(*multiset_hash(columns, null_mode), status.alias("status"))


def compare_checksums(a: DataFrame, b: DataFrame) -> DataFrame:
    """PASSED when count and hashes agree; two rows meet."""
    x, y = a.select(F.struct("*").alias("a")), b.select(F.struct("*").alias("b"))
    same = (F.col("a.n_rows") == F.col("b.n_rows")) & F.col("a.hash_sum").eqNullSafe(F.col("b.hash_sum")) & F.col("a.hash_xor").eqNullSafe(F.col("b.hash_xor"))
    verdict = F.when((F.col("a.status") == "error") | (F.col("b.status") == "error"), "error").when(same, "PASSED").otherwise("FAILED")
    return x.crossJoin(y).select(verdict.alias("verdict"), F.col("a.n_rows").alias("source_rows"), F.col("b.n_rows").alias("target_rows"))


def diff_rows(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose rows differ, with the side that has them: source, target, or both."""
    cols = [c for c in a.columns]
    x = a.select(*keys, row_bits(cols).alias("x"))
    y = b.select(*keys, row_bits(cols).alias("y"))
    side = F.when(F.col("y").isNull(), "source").when(F.col("x").isNull(), "target").otherwise("both")
    return x.join(y, list(keys), "full_outer").where(~F.col("x").eqNullSafe(F.col("y"))).select(*keys, side.alias("side"))


def checksum_leaves(df: DataFrame, key: str, low: int, width: int) -> DataFrame:
    """Leaves of a checksum tree: ``leaf`` (stretch of ``width`` keys from ``low`` on, null for null keys), count and hashes."""
    leaf = F.floor((F.col(key) - F.lit(low)) / F.lit(width)).alias("leaf")
    return df.groupBy(leaf).agg(*multiset_hash(df.columns))


def differing(a: DataFrame, b: DataFrame, key: str, leaves: int = 4096) -> Column | None:
    """A condition on an integer key that holds for all stretches in which two tables differ; None where they are equal.

    One pass of sums over each table; of at most ``leaves`` stretches those that differ come to the driver, neighbours as one.
    """
    low, high = a.select(key).unionAll(b.select(key)).agg(F.min(key), F.max(key)).first()
    low, high = (0, 0) if low is None else (low, high)
    width = -(-(high - low + 1) // leaves)
    x, y = (checksum_leaves(df.select(*a.columns), key, low, width).select("leaf", F.struct("n_rows", "hash_sum", "hash_xor").alias(s)) for df, s in ((a, "x"), (b, "y")))
    found = x.withColumnRenamed("leaf", "at").join(y, F.col("at").eqNullSafe(F.col("leaf")), "full_outer").where(~F.col("x").eqNullSafe(F.col("y")))
    bad = [r[0] for r in found.select(F.coalesce("at", "leaf")).collect()]
    spans: list[list[int]] = []
    for leaf in sorted(x for x in bad if x is not None):
        if spans and spans[-1][1] == leaf - 1:
            spans[-1][1] = leaf
        else:
            spans.append([leaf, leaf])
    cond = F.col(key).isNull() if None in bad else None
    for first, last in spans:
        part = F.col(key).between(low + first * width, low + (last + 1) * width - 1)
        cond = part if cond is None else cond | part
    return cond


def diff_by_range(a: DataFrame, b: DataFrame, key: str, leaves: int = 4096) -> DataFrame:
    """:func:`diff_rows` by an integer key, for tables that differ in few places.

    Sums tell which stretches of keys differ; only those are read again, with a filter that scans push down (tables sorted
    or partitioned by the key skip the rest). Rows with a null key match no row of the other table.
    """
    cond = differing(a, b, key, leaves)
    near = lambda df: df.where(F.lit(False) if cond is None else cond)
    return diff_rows(near(a), near(b), [key])


# Profiles that are united from sketches of loads

#: Values that a sketch of frequent values tracks; columns with few values are exact.
TRACKED = 100


def sketches(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """A row of mergeable sketches for each column (and group ``by``): counts, distinct values, quantiles of numbers, frequent values.

    They are small and can be stored with each load; :func:`united` makes one profile of many without reading rows again.
    """
    columns = [c for c in columns or df.columns if c not in by]
    kinds = {f.name: f.dataType for f in df.schema}
    number = lambda c: F.col(f"`{c}`").cast("double") if isinstance(kinds[c], NumericType) else F.lit(None).cast("double")
    row = lambda c: F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"), number(c).alias("number"))
    long = df.select(*by, F.inline(F.array(*map(row, columns))))
    return long.groupBy(*by, "column_name").agg(
        F.count(F.lit(1)).alias("total"), F.count("value").alias("non_null"), F.min("number").alias("min_value"), F.max("number").alias("max_value"),
        F.hll_sketch_agg("value", 14).alias("distinct"), F.kll_sketch_agg_double("number", 400).alias("quantiles"), F.expr(f"approx_top_k_accumulate(value, {TRACKED})").alias("frequent"))


def united(stored: DataFrame) -> DataFrame:
    """One row of sketches for each column from those of all loads."""
    merged = F.reduce(F.collect_list("quantiles"), F.lit(None).cast("binary"), lambda a, b: F.when(a.isNull(), b).otherwise(F.kll_sketch_merge_double(a, b)))
    return stored.groupBy("column_name").agg(
        F.sum("total").alias("total"), F.sum("non_null").alias("non_null"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.hll_union_agg("distinct").alias("distinct"), merged.alias("quantiles"), F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"))


def from_sketches(sketch: DataFrame, most: int = 10) -> DataFrame:
    """The profile that sketches stand for: nulls, distinct values (standard error 0.8 %), median (rank error 1 %), values where they are at most ``most``."""
    d = F.hll_sketch_estimate("distinct")
    top = F.expr(f"approx_top_k_estimate(frequent, {most + 1})")  # null may be one
    number = F.col("min_value").isNotNull()
    return sketch.select(
        "column_name", "total", (F.col("total") - F.col("non_null")).alias("null_count"), d.alias("distinct_count"), "min_value", "max_value",
        F.when(number, F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5))).alias("median"),
        F.when((d > 0) & (d <= most), F.array_sort(F.array_compact(F.transform(top, lambda x: x["item"])))).alias("values"))
