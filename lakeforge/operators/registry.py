"""Schema registry: catalogues, changes, rules, compatibility, versions - for many tables at once."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udtf
from pyspark.sql.types import ArrayType, BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegralType, MapType, StringType, StructType, TimestampNTZType, TimestampType, VariantType

from lakeforge.functions.scalars import varchar_length

CATALOGUE = "table_name string, name string, data_type string, is_nullable boolean, default_value string, position int, type_category string, max_length int"
# The seed compatibility rules (id, change, from constraint, to constraint, category, level, action).
RULES = (
    ("R001", "add_column", "any", "nullable", "any", "safe", "proceed"),
    ("R002", "add_column", "any", "not_null", "any", "breaking", "halt"),
    ("R003", "remove_column", "any", "any", "any", "breaking", "halt"),
    ("R004", "change_datatype", "any", "any", "string_to_numeric", "breaking", "halt"),
    ("R005", "change_datatype", "varchar_small", "varchar_large", "string", "safe", "proceed"),
    ("R006", "change_datatype", "varchar_large", "varchar_small", "string", "warning", "warn_proceed"),
    ("R007", "change_datatype", "integer", "bigint", "numeric", "safe", "proceed"),
    ("R008", "change_nullable", "not_null", "nullable", "any", "safe", "proceed"),
    ("R009", "change_nullable", "nullable", "not_null", "any", "breaking", "halt"),
    ("R010", "reorder_columns", "any", "any", "any", "safe", "proceed"),
    ("R011", "add_index", "any", "any", "any", "safe", "proceed"),
    ("R012", "change_primary_key", "any", "any", "any", "breaking", "halt"),
)
# Levels from loose to strict; (level, method, severity, mail, halt); levels without a rule; base severities.
LEVELS = ("safe", "warning", "breaking")
POLICIES = (("safe", "log", "info", False, False), ("warning", "both", "warning", True, False), ("breaking", "both", "error", True, True))
HEURISTICS = {"add_column": "warning", "remove_column": "breaking", "change_datatype": "breaking", "change_nullable": "warning", "change_default": "safe", "reorder_columns": "safe"}
ACTIONS = {"safe": "proceed", "warning": "warn_proceed", "breaking": "halt"}
SEVERITY = {"add_column": "safe", "remove_column": "breaking", "change_datatype": "breaking", "change_nullable": "warning", "change_default": "safe", "change_constraint": "warning", "reorder_columns": "safe"}
#: Order in which a table's changes are reported.
KINDS = ("add_column", "remove_column", "change_datatype", "change_nullable", "change_default", "change_constraint", "reorder_columns")


def category(kind) -> str:
    if isinstance(kind, StringType):
        return "string"
    if isinstance(kind, IntegralType):
        return "integer"
    if isinstance(kind, (DoubleType, FloatType, DecimalType)):
        return "numeric"
    if isinstance(kind, BooleanType):
        return "boolean"
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return "datetime"
    return "json" if isinstance(kind, (ArrayType, MapType, StructType, VariantType)) else "other"


def catalogue(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column rows of all tables, from their schemas alone."""
    rows = [(t, f.name, f.dataType.simpleString(), f.nullable, None, i + 1, category(f.dataType), None) for t, df in tables.items() for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, CATALOGUE)


def schema_hash(columns: DataFrame) -> DataFrame:
    row = F.struct("position", "name", "data_type", "is_nullable")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(row)), lambda x: F.concat_ws(":", x["position"].cast("string"), x["name"], x["data_type"], x["is_nullable"].cast("string"))), "|")
    return columns.groupBy("table_name").agg(F.sha2(text, 256).alias("schema_hash"))


def pk_candidates(df: DataFrame) -> DataFrame:
    """Columns named like keys whose values are all there and all different."""
    names = [c for c in df.columns if c.lower().endswith(("id", "key"))]
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, n long")
    # one pass: rows of (column, value), counted by value, then by column
    values = df.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in names))))
    by_value = values.groupBy("column_name", "value").agg(F.count("*").alias("m"))
    return by_value.groupBy("column_name").agg(F.sum("m").alias("n"), F.max("m").alias("most"), F.count_if(F.col("value").isNull()).alias("nulls")).where("most = 1 and nulls = 0").select("column_name", "n")


def compare(old: DataFrame, new: DataFrame) -> DataFrame:
    """Change rows between two catalogues: ``table_name, name, change_type, from_value, to_value, from_category, to_category, nullable, to_default, relative_reorder``."""
    cols = ["data_type", "is_nullable", "default_value", "position", "type_category", "max_length"]
    side = lambda df, s: df.select("table_name", "name", F.struct(*cols).alias(s))
    both = side(old, "o").join(side(new, "n"), ["table_name", "name"], "full_outer")
    o, n = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}"))
    common = F.col("o").isNotNull() & F.col("n").isNotNull()
    rank = lambda c: F.when(common, F.row_number().over(Window.partitionBy("table_name", common).orderBy(c)))
    both = both.withColumn("moved", F.coalesce(rank(o("position")) != rank(n("position")), F.lit(False)))

    def change(when: Column, name: str, a: Column, b: Column) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("change_type"), a.cast("string").alias("from_value"), b.cast("string").alias("to_value")))

    nothing = F.lit(None)
    word = lambda c: F.when(c, "nullable").otherwise("not_null")
    rows = F.array(
        change(F.col("o").isNull(), "add_column", nothing, n("data_type")),
        change(F.col("n").isNull(), "remove_column", o("data_type"), nothing),
        change(common & (o("data_type") != n("data_type")), "change_datatype", o("data_type"), n("data_type")),
        change(common & (o("is_nullable") != n("is_nullable")), "change_nullable", word(o("is_nullable")), word(n("is_nullable"))),
        change(common & ~o("default_value").eqNullSafe(n("default_value")), "change_default", o("default_value"), n("default_value")),
        change(common & ~o("max_length").eqNullSafe(n("max_length")), "change_constraint", o("max_length"), n("max_length")),
        change(common & (o("position") != n("position")), "reorder_columns", o("position"), n("position")),
    )
    found = both.select("table_name", "name", o("type_category").alias("from_category"), n("type_category").alias("to_category"), n("is_nullable").alias("nullable"), n("default_value").alias("to_default"), "moved", F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("c"))
    return found.select("table_name", "name", "c.*", "from_category", "to_category", "nullable", "to_default", ((F.col("c.change_type") == "reorder_columns") & F.col("moved")).alias("relative_reorder"))


PAIR = ("data_type", "is_nullable", "default_value", "max_length", "position")


def paired(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns of two catalogues side by side: ``table_name, name, in_old, in_new``, and ``old_*`` and ``new_*`` of what can change."""
    side = lambda df, s: df.select("table_name", "name", F.lit(True).alias(f"in_{s}"), *(F.col(c).cast("string").alias(f"{s}_{c}") for c in PAIR))
    both = side(old, "old").join(side(new, "new"), ["table_name", "name"], "full_outer")
    return both.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_old", "in_new")})


@arrow_udtf(returnType="table_name string, name string, change_type string")
class ExpandChanges:
    """Change rows of all kinds from :func:`paired` columns, by Arrow batches, for SQL callers: ``expand_changes(table(pairs))``."""

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        pairs = pa.table(batch)
        both = pc.and_(pairs["in_old"], pairs["in_new"])

        def differ(c: str) -> pa.ChunkedArray:
            a, b = pairs[f"old_{c}"], pairs[f"new_{c}"]
            one_null = pc.xor(pc.is_null(a), pc.is_null(b))
            return pc.and_(both, pc.or_(one_null, pc.fill_null(pc.not_equal(a, b), False)))

        found = dict(zip(KINDS, (pc.invert(pairs["in_old"]), pc.invert(pairs["in_new"]), *map(differ, PAIR)), strict=True))
        for kind, rows in found.items():
            some = pairs.filter(rows).select(["table_name", "name"])
            yield some.append_column("change_type", pa.array([kind] * len(some), pa.string()))


def looked_up(values: Mapping[str, str], key: Column, default: str | None = None) -> Column:
    out = F.lit(default)
    for k, v in values.items():
        out = F.when(key == k, v).otherwise(out)
    return out


def base_severity(change: Column, nullable: Column, default_value: Column, to_value: Column) -> Column:
    """Severity before any rule: added NOT NULL columns without a default break, and so does a column that becomes NOT NULL."""
    breaks = ((change == "add_column") & ~nullable & default_value.isNull()) | ((change == "change_nullable") & (to_value == "not_null"))
    return F.when(breaks, "breaking").when((change == "change_nullable") & (to_value == "nullable"), "safe").otherwise(looked_up(SEVERITY, change, "warning"))


def rules(spark: SparkSession) -> DataFrame:
    """The seed rules, all active."""
    return spark.createDataFrame([(*r, True) for r in RULES], "rule_id string, rule_type string, from_constraint string, to_constraint string, category string, level string, action string, is_active boolean")


# Kinds of change that every rule table should speak of.
EXPECTED = ("add_column", "remove_column", "change_datatype", "change_nullable")


def active_rules(rule_table: DataFrame, change_type: str | None = None) -> DataFrame:
    """The active rules, of one kind of change or of all, by kind and time of creation."""
    on = rule_table.where("is_active")
    return (on if change_type is None else on.where(F.col("rule_type") == change_type)).orderBy("rule_type", "created_at")


def missing_types(rule_table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Expected kinds of change without any rule, in the whole table or in each group ``by``."""
    seen = rule_table.groupBy(*by).agg(F.collect_set(F.when(F.col("rule_type").isin(*EXPECTED), F.col("rule_type"))).alias("seen"))
    return seen.select(*by, F.explode(F.array_except(F.array(*(F.lit(x) for x in EXPECTED)), "seen")).alias("missing"))


def log_evolution(evaluated: DataFrame, path: str) -> None:
    """Appends one row for each table: its changes, and the evaluation, nested. A table has as many changes as columns at most."""
    log = evaluated.groupBy("table_name").agg(F.collect_list(F.struct("name", "change_type", "level", "action")).alias("changes"))
    log.join(overall(evaluated).select("table_name", F.struct("level", "action").alias("evaluation")), "table_name").write.mode("append").parquet(path)


def meets(constraint: Column, value: Column) -> Column:
    """Whether a nullability (``nullable``, ``not_null``) or data type meets a rule's constraint."""
    length, kind = varchar_length(value), F.upper(value)
    kinds = F.when(constraint == "varchar_small", length <= 50).when(constraint == "varchar_large", length > 50).when(constraint == "integer", kind.isin("INT", "INTEGER")).when(constraint == "bigint", kind == "BIGINT")
    return (constraint == "any") | F.coalesce(kinds, value == constraint, F.lit(False))


def matches(changes: DataFrame, rule_table: DataFrame) -> DataFrame:
    """Change x rule: type equal or any, constraints and category as far as the rule names them. Rules are few and hand-made.

    ``numeric`` takes integers too, as the rule from integer to bigint needs it.
    """
    c, r = changes, rule_table.where("is_active")
    to_state = F.when(c.change_type == "add_column", F.when(c.nullable, "nullable").otherwise("not_null")).otherwise(c.to_value)
    number = lambda x: x.isin("integer", "numeric")
    target = F.coalesce(c.to_category, c.from_category)
    fits = F.when(r.category == "any", True).when(r.category == "string_to_numeric", (c.from_category == "string") & number(c.to_category)).when(r.category == "numeric_to_string", number(c.from_category) & (c.to_category == "string")).when(r.category == "numeric", number(target)).otherwise(target == r.category)
    on = ((r.rule_type == c.change_type) | (r.rule_type == "any")) & meets(r.from_constraint, c.from_value) & meets(r.to_constraint, to_state) & F.coalesce(fits, F.lit(False))
    return c.join(F.broadcast(r), on)


def best_rule(matched: DataFrame) -> DataFrame:
    """The most specific rule for each change; ties by rule type, then by time of creation where rules have one, then id."""
    score = F.when(F.col("rule_type") != "any", 10).otherwise(0) + sum(F.when(F.col(c) != "any", p).otherwise(0) for c, p in (("from_constraint", 5), ("to_constraint", 5), ("category", 3)))
    w = Window.partitionBy("table_name", "name", "change_type").orderBy(F.desc("score"), "rule_type", *(["created_at"] if "created_at" in matched.columns else []), "rule_id")
    return matched.withColumn("score", score).withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def evaluate(changes: DataFrame, rule_table: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Level, action and rule of each change; without a matching rule, level and action by the kind of change.

    ``strict_reference`` leaves out the three rules that could never match in the system whose outcomes it reproduces.
    """
    r = rule_table.where(~F.col("rule_id").isin("R002", "R007", "R009")) if strict_reference else rule_table
    best = best_rule(matches(changes, r)).select("table_name", "name", "change_type", "rule_id", "level", "action")
    joined = changes.join(best, ["table_name", "name", "change_type"], "left")
    level = F.coalesce("level", looked_up(HEURISTICS, F.col("change_type"), "warning"))
    return joined.withColumn("action", F.coalesce("action", looked_up(ACTIONS, level))).withColumn("level", level)


def overall(evaluated: DataFrame) -> DataFrame:
    """The most restrictive level of each table and the action of the first change that reaches it (by kind, then name)."""
    rank = F.array_position(F.array(*map(F.lit, LEVELS)), F.col("level"))
    first = F.struct((-rank).alias("rank"), F.array_position(F.array(*map(F.lit, KINDS)), F.col("change_type")).alias("kind"), F.col("name"))
    return evaluated.groupBy("table_name").agg(F.min_by("level", first).alias("level"), F.min_by("action", first).alias("action"))


def recommend(evaluated: DataFrame) -> DataFrame:
    """A rule for each change that none matched."""
    nullable = F.coalesce("nullable", F.lit(True))
    level = F.when(F.col("change_type") != "add_column", "warning").when(nullable, "safe").otherwise("breaking")
    return evaluated.where("rule_id is null").select("table_name", "name", "change_type", level.alias("suggested_level"), looked_up(ACTIONS, level).alias("suggested_action"))


def notification(levels: DataFrame) -> DataFrame:
    """Method, severity, mail and halt flags by level; unknown levels get the policy of safe ones."""
    p = levels.sparkSession.createDataFrame(list(POLICIES), "level string, method string, severity string, email boolean, halt boolean")
    known = F.when(F.col("level").isin(*LEVELS), F.col("level")).otherwise("safe")
    return levels.withColumn("known", known).join(F.broadcast(p.withColumnRenamed("level", "known")), "known").drop("known")
