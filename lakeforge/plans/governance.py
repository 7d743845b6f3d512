"""Schema registry and extension points: RG, AG-34..38, JN-7..8, WN-4 and UD queries.

Catalogues come from the rows of ``events``: a user is a table, a kind of event with a residue of its id a column, whose type,
nullability, default and place follow from the values seen. The old catalogue holds what came before January 20, the new one
what came from January 11 on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.functions import scalars as S
from lakeforge.operators import dq, profile, registry as R
from lakeforge.plans.registry import Tables, query
from lakeforge.sources import sinks as K
from lakeforge.sources.scratch import scratch


def observed(t: Tables, condition: str) -> DataFrame:
    name = F.concat_ws("_", "event_type", (F.col("event_id") % 4).cast("string"))
    seen = t.events.where(condition).groupBy(F.concat(F.lit("u"), F.col("user_id")).alias("table_name"), name.alias("name")).agg(F.max("value").alias("m"), F.count("*").alias("n"), F.min("event_id").alias("f"))
    m, n, f = F.col("m"), F.col("n"), F.col("f")
    kind = F.when(m < 40, F.concat(F.lit("VARCHAR("), (20 * n).cast("string"), F.lit(")"))).when(m < 80, "INTEGER").when(m < 120, "BIGINT").when(m < 200, "DOUBLE").otherwise("BOOL")
    place = F.row_number().over(Window.partitionBy("table_name").orderBy("f"))  # at most 20 columns each
    return seen.select("table_name", "name", kind.alias("data_type"), (f % 3 != 0).alias("is_nullable"), F.when(n % 2 == 0, F.concat(F.lit("d"), (f % 2).cast("string"))).alias("default_value"), place.alias("position")).withColumns({"type_category": S.type_category(F.col("data_type")), "max_length": S.varchar_length(F.col("data_type"))})


BEFORE, SINCE = "ts < timestamp '2024-01-20'", "ts >= timestamp '2024-01-11'"


def versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    return observed(t, BEFORE), observed(t, SINCE)


def catalogue_sql(condition: str) -> str:
    return f"""(select table_name, name, is_nullable, default_value, position, data_type,
  case when data_type like 'VARCHAR%' then 'string' when data_type in ('INTEGER', 'BIGINT') then 'integer' when data_type = 'DOUBLE' then 'numeric' else 'boolean' end as category,
  try_cast(nullif(regexp_extract(data_type, '\\((\\d+)\\)', 1), '') as integer) as len
 from (select 'u' || user_id as table_name, event_type || '_' || (event_id % 4) as name, min(event_id) % 3 <> 0 as is_nullable, case when count(*) % 2 = 0 then 'd' || (min(event_id) % 2) end as default_value,
  row_number() over (partition by user_id order by min(event_id)) as position,
  case when max(value) < 40 then 'VARCHAR(' || (20 * count(*)) || ')' when max(value) < 80 then 'INTEGER' when max(value) < 120 then 'BIGINT' when max(value) < 200 then 'DOUBLE' else 'BOOL' end as data_type
  from events where {condition} group by user_id, 1, 2))"""


PAIRS = f"""(select coalesce(a.table_name, b.table_name) as table_name, coalesce(a.name, b.name) as name, a.name is not null as in_old, b.name is not null as in_new, a.data_type as t0, b.data_type as t1, a.category as c0, b.category as c1,
 case when a.is_nullable then 'nullable' when not a.is_nullable then 'not_null' end as n0, case when b.is_nullable then 'nullable' when not b.is_nullable then 'not_null' end as n1,
 a.default_value as d0, b.default_value as d1, a.len as l0, b.len as l1, a.position as p0, b.position as p1
 from {catalogue_sql(BEFORE)} a full outer join {catalogue_sql(SINCE)} b on a.table_name = b.table_name and a.name = b.name)"""
CHANGES = f"""(with p as {PAIRS} select table_name, name, c0, c1, n1, d1, v.* from p, lateral (values
 (1, 'add_column', not in_old, null, n1), (2, 'remove_column', not in_new, n0, null), (3, 'change_datatype', in_old and in_new and t0 <> t1, t0, t1), (4, 'change_nullable', in_old and in_new and n0 <> n1, n0, n1),
 (5, 'change_default', in_old and in_new and d0 is distinct from d1, d0, d1), (6, 'change_constraint', in_old and in_new and l0 is distinct from l1, l0::varchar, l1::varchar), (7, 'reorder_columns', in_old and in_new and p0 <> p1, p0::varchar, p1::varchar)) v(seq, change_type, found, v0, v1) where v.found)"""
SEVERITY = f"""(select table_name, name, change_type, case when change_type = 'add_column' then case when n1 = 'not_null' and d1 is null then 'breaking' else 'safe' end when change_type in ('remove_column', 'change_datatype') then 'breaking'
 when change_type = 'change_nullable' then case v1 when 'nullable' then 'safe' else 'breaking' end when change_type = 'change_constraint' then 'warning' else 'safe' end as base_severity from {CHANGES})"""
# the rule that decides, by what it is meant to match
LEVEL = f"""(select *, case when rule_id in ('R001', 'R005', 'R007', 'R008', 'R010') then 'safe' when rule_id = 'R006' then 'warning' when rule_id is not null then 'breaking'
  else case change_type when 'change_datatype' then 'breaking' when 'change_default' then 'safe' else 'warning' end end as level
 from (select *, case change_type when 'add_column' then case v1 when 'nullable' then 'R001' else 'R002' end when 'remove_column' then 'R003'
  when 'change_datatype' then case when c0 = 'string' and c1 in ('integer', 'numeric') then 'R004' when c0 = 'string' and c1 = 'string' and regexp_extract(v0, '\\d+')::int <= 50 and regexp_extract(v1, '\\d+')::int > 50 then 'R005'
   when c0 = 'string' and c1 = 'string' and regexp_extract(v0, '\\d+')::int > 50 and regexp_extract(v1, '\\d+')::int <= 50 then 'R006' when v0 = 'INTEGER' and v1 = 'BIGINT' then 'R007' end
  when 'change_nullable' then case v1 when 'nullable' then 'R008' else 'R009' end when 'reorder_columns' then 'R010' end as rule_id from {CHANGES}))"""
ACTION = "case level when 'safe' then 'proceed' when 'warning' then 'warn_proceed' else 'halt' end"
RANK = "case level when 'breaking' then 1 when 'warning' then 2 else 3 end"
OVERALL = f"(select table_name, level, {ACTION} as action from (select *, row_number() over (partition by table_name order by {RANK}, seq, name) as rn from {LEVEL}) where rn = 1)"
HASHES = f"""(select table_name, max(h) filter (side = 0) as h0, max(h) filter (side = 1) as h1 from (
 select table_name, 0 as side, sha256(string_agg(position || ':' || name || ':' || data_type || ':' || is_nullable, '|' order by position)) as h from {catalogue_sql(BEFORE)} group by 1
 union all select table_name, 1, sha256(string_agg(position || ':' || name || ':' || data_type || ':' || is_nullable, '|' order by position)) from {catalogue_sql(SINCE)} group by 1) group by 1)"""


def changes(t: Tables) -> DataFrame:
    return R.compare(*versions(t))


def evaluated(t: Tables) -> DataFrame:
    return R.evaluate(changes(t), R.rules(t.spark))


DETECTED = " union all ".join(f"select '{t}' as table_name, column_name as name, row_number() over () as position, column_type as kind, (select count(*) from {t}) as row_count, {keys} as is_key_candidate from (describe {t})" for t, keys in (
    ("customer", "column_name = 'c_custkey' and (select count(*) = count(distinct c_custkey) from customer)"),
    ("orders", "column_name = 'o_orderkey' and (select count(*) = count(distinct o_orderkey) from orders) or column_name = 'o_custkey' and (select count(*) = count(distinct o_custkey) from orders)")))


@query("detect_schema", f"select table_name, name, cast(position as integer) as position, case kind when 'VARCHAR' then 'string' when 'INTEGER' then 'int' when 'TIMESTAMP' then 'timestamp_ntz' else lower(kind) end as data_type, case when kind = 'VARCHAR' then 'string' when kind in ('BIGINT', 'INTEGER') then 'integer' when kind = 'DOUBLE' or kind like 'DECIMAL%' then 'numeric' when kind in ('DATE', 'TIMESTAMP') then 'datetime' else 'other' end as type_category, row_count, is_key_candidate from ({DETECTED})")
def _(t):
    tables, counts, keys = {"customer": t.customer, "orders": t.orders}, None, None
    for name, df in tables.items():
        n = df.agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(name))
        k = R.pk_candidates(df).select(F.lit(name).alias("table_name"), F.col("column_name").alias("name"), F.lit(True).alias("is_key"))
        counts, keys = (n, k) if counts is None else (counts.unionByName(n), keys.unionAll(k))
    found = R.catalogue(t.spark, tables).join(counts, "table_name").join(keys, ["table_name", "name"], "left")
    return found.select("table_name", "name", "position", "data_type", "type_category", "row_count", F.coalesce("is_key", F.lit(False)).alias("is_key_candidate"))


@query("compare_schemas", f"select table_name, name, change_type from {CHANGES}")
def _(t):
    return changes(t).select("table_name", "name", "change_type")


@query("schema_diff_outer", f"select table_name, name, in_old, in_new from {PAIRS}")
def _(t):
    old, new = versions(t)
    both = old.select("table_name", "name", F.lit(1).alias("o")).join(new.select("table_name", "name", F.lit(1).alias("n")), ["table_name", "name"], "full_outer")
    return both.select("table_name", "name", F.col("o").isNotNull().alias("in_old"), F.col("n").isNotNull().alias("in_new"))


@query("base_severity", f"select * from {SEVERITY}")
def _(t):
    return changes(t).select("table_name", "name", "change_type", R.base_severity(F.col("change_type"), F.col("nullable"), F.col("to_default"), F.col("to_value")).alias("base_severity"))


@query("scan_rule_table", "select event_id, 'remove_column' as rule_type, ts as created_at from events where event_id % 3 <> 0 and event_type = 'error'")
def _(t):
    """Events as rules: errors speak of removed columns, the others of added ones; every third is off."""
    kind = F.when(F.col("event_type") == "error", "remove_column").otherwise("add_column")
    table = t.events.select("event_id", kind.alias("rule_type"), F.col("ts").alias("created_at"), (F.col("event_id") % 3 != 0).alias("is_active"))
    return R.active_rules(table, "remove_column").drop("is_active")


@query("rule_match_theta", f"select table_name, name, change_type, count(*) as rules from {LEVEL} where rule_id is not null group by all")
def _(t):
    return R.matches(changes(t), R.rules(t.spark)).groupBy("table_name", "name", "change_type").agg(F.count("*").alias("rules"))


@query("best_rule", f"select table_name, name, change_type, rule_id from {LEVEL} where rule_id is not null")
def _(t):
    return R.best_rule(R.matches(changes(t), R.rules(t.spark))).select("table_name", "name", "change_type", "rule_id")


@query("evaluate_changes", f"select table_name, name, change_type, level, {ACTION} as action from {LEVEL}")
def _(t):
    return evaluated(t).select("table_name", "name", "change_type", "level", "action")


@query("overall_compatibility", f"select * from {OVERALL}")
def _(t):
    return R.overall(evaluated(t))


@query("change_summary", f"select table_name, count(*) filter (change_type = 'add_column') as added, count(*) filter (change_type = 'remove_column') as removed, count(*) filter (seq between 3 and 6) as modified, count(*) filter (seq = 7) as reordered, count(*) filter (base_severity = 'safe') as safe, count(*) filter (base_severity = 'warning') as warning, count(*) filter (base_severity = 'breaking') as breaking from {CHANGES} join {SEVERITY} using (table_name, name, change_type) group by 1")
def _(t):
    n = lambda *k: F.count_if(F.col("change_type").isin(*k))
    severity = R.base_severity(F.col("change_type"), F.col("nullable"), F.col("to_default"), F.col("to_value"))
    return changes(t).groupBy("table_name").agg(n("add_column").alias("added"), n("remove_column").alias("removed"), n("change_datatype", "change_nullable", "change_default", "change_constraint").alias("modified"), n("reorder_columns").alias("reordered"), *(F.count_if(severity == x).alias(x) for x in R.LEVELS))


@query("schema_hash", f"select table_name, h0 as schema_hash from {HASHES} where h0 is not null")
def _(t):
    return R.schema_hash(versions(t)[0])


INVENTORY = "(select user_id, case event_id % 5 when 0 then 'add_column' when 1 then 'remove_column' when 2 then 'change_datatype' when 3 then 'change_nullable' else 'reorder_columns' end as rule_type, event_id % 3 <> 0 as is_active from events where event_type <> 'view')"


@query("rule_inventory", f"""select user_id, rule_type as kind, count(*) as rules, count(*) filter (is_active) as active, false as missing from {INVENTORY} group by 1, 2
union all select user_id, kind, 0, 0, true from (select distinct user_id from {INVENTORY}) u, (values ('add_column'), ('remove_column'), ('change_datatype'), ('change_nullable')) e(kind) where not exists (select 1 from {INVENTORY} i where i.user_id = u.user_id and i.rule_type = e.kind)""")
def _(t):
    """Events other than views as rules, each user's as a table of its own: counts by kind, and the expected kinds that lack."""
    r = F.col("event_id") % 5
    kind = F.when(r == 0, "add_column").when(r == 1, "remove_column").when(r == 2, "change_datatype").when(r == 3, "change_nullable").otherwise("reorder_columns")
    table = t.events.where("event_type <> 'view'").select("user_id", kind.alias("rule_type"), (F.col("event_id") % 3 != 0).alias("is_active"))
    counts = table.groupBy("user_id", F.col("rule_type").alias("kind")).agg(F.count("*").alias("rules"), F.count_if("is_active").alias("active"), F.lit(False).alias("missing"))
    zero = F.lit(0).cast("long")
    return counts.unionAll(R.missing_types(table, ["user_id"]).select("user_id", "missing", zero, zero, F.lit(True)))


def validated(t: Tables) -> DataFrame:
    """Tables that both catalogues have: whether the hash changed, with level, action and next version."""
    old, new = versions(t)
    h = R.schema_hash(old).withColumnRenamed("schema_hash", "before").join(R.schema_hash(new), "table_name")
    touched = h.where("before <> schema_hash").select("table_name")
    ev = R.evaluate(R.compare(old.join(touched, "table_name", "left_semi"), new.join(touched, "table_name", "left_semi")), R.rules(t.spark))
    out = h.join(R.overall(ev), "table_name", "left")
    level = F.coalesce("level", F.lit("safe"))
    version = F.when(F.col("before") == F.col("schema_hash"), "1.0.0").otherwise(S.semver_bump(F.lit("1.0.0"), level))
    return out.select("table_name", (F.col("before") != F.col("schema_hash")).alias("changed"), level.alias("level"), F.coalesce("action", F.lit("proceed")).alias("action"), version.alias("version"))


@query("validate_schema", f"select table_name, h0 <> h1 as changed, case when h0 <> h1 then level else 'safe' end as level, case when h0 <> h1 then action else 'proceed' end as action, case when h0 = h1 then '1.0.0' when level = 'breaking' then '2.0.0' when level = 'warning' then '1.1.0' else '1.0.1' end as version from {HASHES} left join {OVERALL} using (table_name) where h0 is not null and h1 is not null")
def _(t):
    return validated(t)


@query("log_evolution", f"select table_name, count(*) as changes, any_value(o.level) as level, any_value(o.action) as action from {CHANGES} join {OVERALL} o using (table_name) group by 1")
def _(t):
    """Two runs append to one log, each for its half of the tables; the log is read back."""
    path = scratch(t.spark, "evolution")
    half = F.abs(F.xxhash64("table_name")) % 2
    for i in (0, 1):
        R.log_evolution(evaluated(t).where(half == i), path)
    return t.spark.read.parquet(path).select("table_name", F.size("changes").alias("changes"), "evaluation.level", "evaluation.action")


@query("force_update", "select user_id, v as version, cur as is_current from (select user_id, '0.' || count(*) || '.0' as v, false as cur from events group by 1 union all select user_id, '0.' || count(*) || '.1', true from events group by 1)")
def _(t):
    """The number of events as each user's version; an update by hand bumps it and becomes the current one."""
    old = t.events.groupBy("user_id").agg(F.concat(F.lit("0."), F.count("*").cast("string"), F.lit(".0")).alias("version")).withColumn("seq", F.lit(1))
    new = old.select("user_id", S.semver_bump(F.col("version"), F.lit("safe")).alias("version"), (F.col("seq") + 1).alias("seq"))
    return K.version_flip(old.unionByName(new), ["user_id"], "seq").select("user_id", "version", "is_current")


@query("recommend_rules", f"select table_name, name, change_type, case when change_type <> 'add_column' then 'warning' when n1 = 'nullable' then 'safe' else 'breaking' end as suggested_level, case when change_type <> 'add_column' then 'warn_proceed' when n1 = 'nullable' then 'proceed' else 'halt' end as suggested_action from {LEVEL} where rule_id is null or change_type = 'add_column'")
def _(t):
    """With the rules on added columns taken out."""
    ev = R.evaluate(changes(t), R.rules(t.spark).where("rule_type <> 'add_column'"))
    return R.recommend(ev)


@query("add_rule", "select 12 + count(*) as rules, count(*) as own from (select distinct event_type, user_id from events)")
def _(t):
    """A custom rule for each kind of event and user, with an id made from what it says."""
    own = t.events.select("event_type", "user_id").distinct().select(F.lit("any").alias("rule_type"), F.col("event_type").alias("from_constraint"), F.col("user_id").cast("string").alias("to_constraint"), F.lit("any").alias("category"), F.lit("warning").alias("level"), F.lit("warn_proceed").alias("action"), F.lit(True).alias("is_active"))
    own = own.withColumn("rule_id", F.concat(F.lit("U"), F.md5(F.concat_ws("|", "from_constraint", "to_constraint").cast("binary"))))
    both = K.insert_or_replace(R.rules(t.spark), own, ["rule_id"])
    return both.agg(F.count("*").alias("rules"), F.count_if(F.startswith("rule_id", F.lit("U"))).alias("own"))


@query("notification_policy", f"select table_name, name, change_type, level, case level when 'safe' then 'log' else 'both' end as method, case level when 'safe' then 'info' when 'warning' then 'warning' else 'error' end as severity, level <> 'safe' as email, level = 'breaking' as halt from {LEVEL}")
def _(t):
    return R.notification(evaluated(t).select("table_name", "name", "change_type", "level"))


# extension points

@query("udf_clean_entry", "select event_id, replace(props, '\"k\"', '\"key\"') as props from events")
def _(t):
    return t.events.select("event_id", S.clean_json(drop=["@_fa"], rename={"k": "key"})("props").alias("props"))


@query("udaf_multiset_hash", "select event_type, count(*) as n_rows, bit_xor(cast('0x' || substr(md5(coalesce(length(cast(event_id as varchar)) || ':' || cast(event_id as varchar), chr(0)) || '|' || coalesce(length(props) || ':' || props, chr(0))), 1, 12) as bigint)) as hash_xor from events group by 1")
def _(t):
    n, _, x = profile.multiset_hash(["event_id", "props"])
    return t.events.groupBy("event_type").agg(n, x)


@query("udtf_expand_changes", f"select name, change_type, count(*) as n from {CHANGES} group by 1, 2")
def _(t):
    old, new = versions(t)
    t.spark.udtf.register("expand_changes", R.ExpandChanges)
    R.paired(old, new).createOrReplaceTempView("column_pairs")
    return t.spark.sql("select name, change_type, count(*) as n from expand_changes(table(column_pairs)) group by 1, 2")


@query("dq_custom_check", "select 'value_vs_type' as check_name, cast(count(*) filter (not (value > 10 or event_type <> 'click')) as double) as value from events")
def _(t):
    return dq.run_checks(t.events, [dq.Check("quality", "value_vs_type", "custom", valid="value > 10 or event_type <> 'click'", fail_high=0)]).select("check_name", "value")
