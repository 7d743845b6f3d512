"""Predicates, data quality, profiles, checksums and manifests: FL and AG queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.functions import predicates as P
from lakeforge.functions import scalars as S
from lakeforge.operators import dq, profile, registry
from lakeforge.operators import manifests as M
from lakeforge.plans.fixtures import PAGES_SQL, pages, states
from lakeforge.plans.landing import AUDIT, audits
from lakeforge.plans.registry import Tables, query
from lakeforge.sources import sinks as K
from lakeforge.sources.scratch import scratch


def holey(t: Tables) -> DataFrame:
    return t.events.withColumn("event_type", F.when(F.col("event_id") % 17 != 0, F.col("event_type")))


HOLEY = "(select event_id, ts, user_id, case when event_id % 17 <> 0 then event_type end as event_type, value, props from events)"


@query("valid_length", "select doc_id, length(text) between 50 and 2000 as ok from documents")
def _(t):
    return t.documents.select("doc_id", P.valid_length(F.col("text"), 50, 2000).alias("ok"))


@query("valid_regex", "select page_id, regexp_full_match(url, 'https?://.*') as ok from pages")
def _(t):
    return t.pages.select("page_id", P.valid_regex(F.col("url"), "https?://.*").alias("ok"))


@query("valid_values", "select event_id, event_type in ('click', 'view', 'purchase') as ok from events")
def _(t):
    return t.events.select("event_id", P.valid_values(F.col("event_type"), ["click", "view", "purchase"]).alias("ok"))


def responses(t: Tables) -> DataFrame:
    """A user's events of a day as a response in one of three shapes; the announced total is one too high for every fifth user.

    Payloads are broken for every seventh user, empty for every eleventh, without results for every thirteenth.
    """
    day = F.to_date("ts").alias("day")
    n = t.events.groupBy("user_id", day).agg(F.count("*").alias("n"), F.transform(F.sort_array(F.collect_list("event_id")), lambda x: F.struct(x.alias("id"))).alias("items"))
    u, total = F.col("user_id"), F.col("n") + (F.col("user_id") % 5 == 0).cast("int")
    search = F.struct(F.struct(total.cast("string").alias("opensearch:totalResults"), F.col("items").alias("entry")).alias("search-results"))
    results = F.struct(F.struct(total.alias("totalCount"), F.col("items").alias("data")).alias("results"))
    body = F.when(u % 3 == 0, F.to_json(search)).when(u % 3 == 1, F.to_json(results)).otherwise(F.to_json(F.struct(F.col("items").alias("data"))))
    return n.select("user_id", "day", "n", F.when(u % 7 == 0, "oops").when(u % 11 == 0, "{}").when(u % 13 == 0, '{"note": 1}').otherwise(body).alias("raw"))


USERS = "(select user_id, cast(ts as date) as day, count(*) as n from events group by 1, 2)"
SOUND = "user_id % 7 <> 0 and user_id % 11 <> 0 and user_id % 13 <> 0"


@query("response_complete_page", f"select user_id, day, user_id % 3 = 0 and user_id % 5 <> 0 and {SOUND} as ok from {USERS}")
def _(t):
    return responses(t).select("user_id", "day", P.response_complete(F.col("raw")).alias("ok"))


@query("response_complete_entity", f"select user_id as entity, sum(n + case when user_id % 5 = 0 then 1 else 0 end)::bigint as total, sum(n)::bigint as items, user_id % 5 <> 0 as ok from {USERS} where user_id % 3 = 0 and {SOUND} group by 1")
def _(t):
    r = responses(t).withColumn("v", F.try_parse_json("raw"))
    g = r.groupBy(F.col("user_id").alias("entity")).agg(F.sum(P.total_of(F.col("v"))).alias("total"), F.sum(P.items_of(F.col("v"))).alias("items"))
    return g.where("total is not null").withColumn("ok", F.col("total") == F.col("items"))


@query("response_empty", f"select user_id, day, user_id % 7 = 0 or user_id % 11 = 0 as ok from {USERS}")
def _(t):
    return responses(t).select("user_id", "day", P.response_empty(F.col("raw")).alias("ok"))


@query("response_structure", f"select user_id, day, {SOUND} as ok from {USERS}")
def _(t):
    return responses(t).select("user_id", "day", P.response_structure(F.col("raw")).alias("ok"))


@query("header_present", "select event_id, event_id % 2 = 0 as ok from events")
def _(t):
    h = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("X-Id"), F.lit("1"))).otherwise(F.create_map(F.lit("Other"), F.lit("1")))
    return t.events.select("event_id", P.header_present(h, "X-Id").alias("ok"))


@query("response_valid", f"select user_id, day, {SOUND} and (n % 2 <> 0 or user_id % 3 = 0 and user_id % 5 <> 0) and user_id % 7 <> 0 as ok from {USERS}")
def _(t):
    """Completeness is enabled for responses of an even number of events; those of some users lack a header."""
    headers = F.create_map(F.when(F.col("user_id") % 7 != 0, "X-Id").otherwise("Other"), F.lit("1"))
    ok = P.response_valid(F.col("raw"), F.col("n") % 2 == 0, F.lit(True), F.lit(True), headers=headers, required="X-Id")
    return responses(t).select("user_id", "day", ok.alias("ok"))


@query("error_is_critical", "select event_id, event_id % 4 <> 2 as critical from events")
def _(t):
    r = F.col("event_id") % 4
    m = F.when(r == 0, "Rate Limit exceeded").when(r == 1, "missing author").otherwise("other")
    k = F.when(r == 3, "PermanentAPIError").otherwise("TimeoutError")
    return t.events.select("event_id", P.error_is_critical(m, k).alias("critical"))


@query("rows_exist", "select c_custkey, c_custkey in (select o_custkey from orders) as there from customer")
def _(t):
    return M.rows_exist(t.customer.select("c_custkey"), t.orders.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("rows_integrity", f"select load_id, entity_id, count(*) > 0 and sum(case when event_id % 17 = 0 then 1 else 0 end) = 0 as ok from ({PAGES_SQL}) group by 1, 2")
def _(t):
    return M.rows_intact(pages(t), ["load_id", "entity_id"], F.when(F.col("event_id") % 17 != 0, F.col("props")))


@query("file_integrity", "select event_id, event_id % 13 <> 0 and event_id % 7 <> 0 and event_id % 11 <> 0 as ok from events")
def _(t):
    """Every 13th stored hash is stale, every 7th file lacks its metadata, every 11th is missing."""
    result = F.struct(F.struct(F.col("props").alias("entry")).alias("search-results"))
    whole = F.to_json(F.struct(F.struct(F.col("event_type").alias("load_id")).alias("metadata"), result.alias("raw_response")))
    n = F.col("event_id")
    found = t.events.where(n % 11 != 0).select("event_id", F.when(n % 7 == 0, F.to_json(F.struct(result.alias("raw_response")))).otherwise(whole).alias("raw"))
    stored = t.events.select("event_id", F.when(n % 13 == 0, "stale").when(n % 7 == 0, S.content_hash(F.to_json(F.struct(result.alias("raw_response"))))).otherwise(S.content_hash(whole)).alias("stored"))
    ok = P.envelope(F.col("raw")) & S.hash_equal(F.col("stored"), S.content_hash(F.col("raw")))
    return stored.join(found, "event_id", "left").select("event_id", F.coalesce(ok, F.lit(False)).alias("ok"))


@query("range_extract", "select event_id, event_type from events where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-12' and event_type = 'click'")
def _(t):
    """From a dated layout, of which only the days' folders are read."""
    path = scratch(t.spark, "dated")
    K.write_dated(t.events, "ts", path)
    return K.read_range(t.spark, path, "ts", "2024-01-10", "2024-01-12").where("event_type = 'click'").select("event_id", "event_type")


@query("whitespace_rows", "select event_id, length(v) as n, length(trim(v)) as trimmed from (select event_id, case when event_id % 11 = 3 then ' x ' else event_type end as v from events) where v <> trim(v)")
def _(t):
    v = F.when(F.col("event_id") % 11 == 3, " x ").otherwise(F.col("event_type"))
    return dq.whitespace_rows(t.events.select("event_id", v.alias("v")), ["event_id"], ["v"]).select("event_id", "n", "trimmed")


# data quality

def value_of(df: DataFrame, *checks: dq.Check) -> DataFrame:
    return dq.run_checks(df, checks).select("check_name", "value")


@query("dq_row_count", "select 'rows' as check_name, cast(count(*) as double) as value from events")
def _(t):
    return value_of(t.events, dq.Check("critical", "rows", "row_count", fail_low=1))


@query("dq_missing_count", f"select 'missing' as check_name, cast(count(*) filter (event_type is null) as double) as value from {HOLEY}")
def _(t):
    return value_of(holey(t), dq.Check("critical", "missing", "missing_count", "event_type", fail_high=0))


@query("dq_duplicate_count", "select 'duplicates' as check_name, cast(count(*) filter (n > 1) as double) as value from (select props, count(*) as n from events group by 1)")
def _(t):
    return value_of(t.events, dq.Check("critical", "duplicates", "duplicate_count", "props", fail_high=0))


@query("dq_duplicate_percent", "select 'duplicates' as check_name, 100.0::double * count(*) filter (n > 1) / sum(n)::double as value from (select props, count(*) as n from events group by 1)")
def _(t):
    return value_of(t.events, dq.Check("quality", "duplicates", "duplicate_percent", "props", warn_high=5))


@query("dq_invalid_count", f"select 'invalid' as check_name, cast(count(*) filter (event_type not in ('click', 'view')) as double) as value from {HOLEY}")
def _(t):
    return value_of(holey(t), dq.Check("quality", "invalid", "invalid_count", "event_type", valid="event_type in ('click', 'view')"))


@query("dq_min_max", "select 'low' as check_name, min(value) as value from events union all select 'high', max(value) from events")
def _(t):
    return value_of(t.events, dq.Check("quality", "low", "min", "value"), dq.Check("quality", "high", "max", "value"))


@query("dq_length_min_max", "select 'low' as check_name, cast(min(length(text)) as double) as value from documents union all select 'high', cast(max(length(text)) as double) from documents")
def _(t):
    return value_of(t.documents, dq.Check("critical", "low", "min_length", "text"), dq.Check("critical", "high", "max_length", "text"))


@query("dq_required_columns", "select u.table_name, r.column_name from (select distinct user_id || '/' || strftime(ts, '%Y%m%d') as table_name from events) u, (values ('click'), ('purchase')) r(column_name) where not exists (select 1 from events e where e.user_id || '/' || strftime(e.ts, '%Y%m%d') = u.table_name and e.event_type = r.column_name)")
def _(t):
    """A user's day as a table, its kinds of events as columns."""
    catalogue = t.events.select(F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("table_name"), F.col("event_type").alias("name"))
    return dq.missing_columns(catalogue, ["click", "purchase"])


CHECKS = (
    dq.Check("critical", "has_rows", "row_count", fail_low=1),
    dq.Check("critical", "type_missing", "missing_count", "event_type", fail_high=1e12),
    dq.Check("critical", "id_unique", "duplicate_count", "event_id", fail_high=0),
    dq.Check("quality", "type_known", "invalid_count", "event_type", valid="event_type in ('signup', 'error', 'click', 'view', 'purchase')", fail_high=0),
    dq.Check("quality", "value_low", "min", "value", fail_low=-1e12),
    dq.Check("monitoring", "type_mostly", "missing_percent", "event_type", warn_high=5),
    dq.Check("monitoring", "props_repeat", "duplicate_percent", "props", warn_high=1000, fail_high=2000),
)


def results(t: Tables) -> DataFrame:
    return dq.run_checks(holey(t), CHECKS)


OUTCOMES = f"""
select 'critical' as tier, 'has_rows' as check_name, case when count(*) < 1 then 'fail' else 'pass' end as outcome from events
union all select 'critical', 'type_missing', case when count(*) filter (event_type is null) > 1e12 then 'fail' else 'pass' end from {HOLEY}
union all select 'critical', 'id_unique', case when count(*) > count(distinct event_id) then 'fail' else 'pass' end from events
union all select 'quality', 'type_known', case when count(*) filter (event_type not in ('signup', 'error', 'click', 'view', 'purchase')) > 0 then 'fail' else 'pass' end from {HOLEY}
union all select 'quality', 'value_low', case when min(value) < -1e12 then 'fail' else 'pass' end from events
union all select 'monitoring', 'type_mostly', case when round(100.0 * count(*) filter (event_type is null) / count(*), 4) > 5 then 'warn' else 'pass' end from {HOLEY}
union all select 'monitoring', 'props_repeat', case when p > 2000 then 'fail' when p > 1000 then 'warn' else 'pass' end from (select 100.0::double * count(*) filter (n > 1 and props is not null) / sum(n)::double as p from (select props, count(*) as n from events group by 1))"""


@query("dq_threshold_outcome", OUTCOMES)
def _(t):
    return results(t).select("tier", "check_name", "outcome")


@query("dq_tier_counts", f"select tier, count(*) filter (outcome = 'pass') as passed, count(*) filter (outcome = 'fail') as failed, count(*) filter (outcome = 'error') as errors, count(*) filter (outcome = 'warn') as warned from ({OUTCOMES}) group by 1")
def _(t):
    return dq.tier_counts(results(t))


@query("dq_tier_decision", f"""with o as ({OUTCOMES}), n as (select count(*) filter (tier = 'critical' and outcome in ('fail', 'error')) as c, count(*) filter (tier = 'quality' and outcome in ('fail', 'error')) as q, count(*) filter (tier = 'monitoring' and outcome in ('fail', 'error')) as m, count(*) filter (tier = 'monitoring' and outcome = 'warn') as w from o)
select 'critical' as tier, case when c > 0 then 'FAIL' else 'PASS' end as status from n
union all select 'quality', case when c > 0 then 'NOT_RUN' when q > 0 then 'FAIL' else 'PASS' end from n
union all select 'monitoring', case when c > 0 then 'NOT_RUN' when m > 0 then 'FAIL' when w > 0 then 'WARNING' else 'PASS' end from n
union all select 'overall', case when c > 0 then 'CRITICAL_FAIL' when q > 0 or m > 0 then 'QUALITY_FAIL' when w > 0 then 'WARNING' else 'PASS' end from n""")
def _(t):
    return dq.decision(results(t))


@query("dq_report", f"select count(*) as total_checks, round(100.0::double * count(*) filter (outcome = 'pass') / count(*), 2) as pass_rate, coalesce(string_agg(case when outcome = 'fail' then tier || ':' || check_name end, ',' order by tier || ':' || check_name), '') as fail_checks, coalesce(string_agg(case when outcome = 'error' then tier || ':' || check_name end, ',' order by tier || ':' || check_name), '') as error_checks, coalesce(string_agg(case when outcome = 'warn' then tier || ':' || check_name end, ',' order by tier || ':' || check_name), '') as warn_checks, (select count(*) from events) as row_count, 6 as column_count from ({OUTCOMES})")
def _(t):
    return dq.report(results(t), t.events.agg(F.count("*").alias("row_count")), len(t.events.columns))


# profiles

PROFILED = ("event_type", "user_id", "props")
BASIC = " union all ".join(f"select '{c}' as column_name, count(*) as total, count(*) - count({c}) as null_count, count({c}) as non_null, round(100.0::double * (count(*) - count({c})) / count(*), 2) as null_percent, round(100.0::double * count({c}) / count(*), 2) as completeness, count(distinct {c}) as distinct_count, round(100.0::double * count(distinct {c}) / count({c}), 2) as uniqueness from {HOLEY}" for c in PROFILED)


@query("profile_basic", BASIC)
def _(t):
    return profile.basic(holey(t), PROFILED)


NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("profile_numeric", " union all ".join(f"select '{c}' as column_name, min({c}) as min_value, max({c}) as max_value, round(avg({c}), 2) as avg_value, max({c}) - min({c}) as value_range from lineitem" for c in NUMBERS))
def _(t):
    return profile.numeric(t.lineitem.select(*NUMBERS))


@query("profile_length", " union all ".join(f"select '{c}' as column_name, cast(min(length({c})) as integer) as min_length, cast(max(length({c})) as integer) as max_length, round(avg(length({c})), 1) as avg_length from part" for c in ("p_name", "p_brand", "p_type")))
def _(t):
    return profile.lengths(t.part.select("p_name", "p_brand", "p_type"))


@query("profile_samples", " union all ".join(f"select '{c}' as column_name, cast(row_number() over (order by v) as integer) as rn, v as value from (select distinct cast({c} as varchar) as v from {HOLEY} where {c} is not null) qualify row_number() over (order by v) <= 5" for c in PROFILED))
def _(t):
    return profile.samples(holey(t), PROFILED)


@query("profile_distribution", f"select 'event_type' as column_name, event_type as value, count(*) as n from {HOLEY} where event_type is not null group by 2")
def _(t):
    return profile.distribution(holey(t), PROFILED)


BOUNDS = " union all ".join(f"select '{c}' as column_name, '{kind}' as data_type, {low} as low, {high} as high, {short} as short, {long} as long from {HOLEY}" for c, kind, low, high, short, long in (("event_type", "string", "null", "null", "min(length(event_type))", "max(length(event_type))"), ("user_id", "bigint", "min(user_id)", "max(user_id)", "null", "null"), ("props", "string", "null", "null", "min(length(props))", "max(length(props))")))


VALUES = " union all ".join(f"select '{c}' as column_name, to_json(list(distinct cast({c} as varchar) order by cast({c} as varchar)) filter ({c} is not null))::varchar as vals from {HOLEY}" for c in PROFILED)


@query("suggest_expectations", f"""with p as ({BASIC}), b as ({BOUNDS})
select column_name, 'not_null' as expectation, 'strict' as strength, cast(null as varchar) as detail from p where null_percent = 0 union all select column_name, 'not_null', 'mostly', null from p where null_percent > 0 and null_percent < 5
union all select column_name, 'unique', 'strict', null from p where uniqueness = 100 union all select column_name, 'unique', 'mostly', null from p where uniqueness > 95 and uniqueness < 100
union all select column_name, 'in_set', 'strict', vals from p join ({VALUES}) using (column_name) where distinct_count between 1 and 10
union all select column_name, 'of_type', 'strict', data_type from b
union all select column_name, 'between', 'strict', cast(cast(low - pad as decimal(20, 1)) as varchar) || '..' || cast(cast(high + pad as decimal(20, 1)) as varchar) from (select *, case when high = low then 1 else (high - low) * 0.1 end as pad from b) where low is not null
union all select column_name, 'length_between', 'strict', short || '..' || (long + 5) from b where short > 0
union all select column_name, 'matches', 'mostly', '^[{{]' from p where column_name = 'props' and completeness > 50""")
def _(t):
    return profile.suggest_all(holey(t).select(*PROFILED), patterns={"props": ("^[{]", 50.0, "mostly")})


BITS = "cast('0x' || substr(md5(concat_ws('|', coalesce(length(cast(c_custkey as varchar)) || ':' || cast(c_custkey as varchar), chr(0)), coalesce(length(c_mktsegment) || ':' || c_mktsegment, chr(0)), coalesce(length(c_name) || ':' || c_name, chr(0)))), 1, 12) as bigint)"


@query("table_checksum", f"select count(*) as n_rows, cast(sum({BITS}) as varchar) as hash_sum, bit_xor({BITS}) as hash_xor, 'ok' as status from customer")
def _(t):
    return profile.table_checksum(t.customer, ["c_custkey", "c_name", "c_mktsegment"], key="c_custkey")


@query("checksum_compare", "select 'same' as pair, 'PASSED' as verdict, count(*) as source_rows, count(*) as target_rows from customer union all select 'changed', 'FAILED', count(*), count(*) from customer union all select 'short', 'FAILED', count(*), count(*) filter (c_custkey % 7 <> 0) from customer union all select 'empty', 'error', count(*), 0 from customer")
def _(t):
    """Customers against the same rows in other partitions, with one column changed, with rows lost, and against none."""
    whole = profile.table_checksum(t.customer)
    others = {"same": t.customer.repartition(5, "c_name"), "changed": t.customer.withColumn("c_name", F.upper(F.concat("c_name", F.lit("!")))), "short": t.customer.where("c_custkey % 7 <> 0"), "empty": t.customer.where("c_custkey < 0")}
    out = None
    for pair, df in others.items():
        one = profile.compare_checksums(whole, profile.table_checksum(df)).select(F.lit(pair).alias("pair"), "*")
        out = one if out is None else out.unionAll(one)
    return out


@query("checksum_diff_rows", "select c_custkey, case when c_custkey % 10 = 0 then 'both' when c_custkey % 10 = 1 then 'source' else 'target' end as side from customer where c_custkey % 10 in (0, 1, 2)")
def _(t):
    a = t.customer.where("c_custkey % 10 <> 2")
    b = t.customer.where("c_custkey % 10 <> 1").withColumn("c_acctbal", F.when(F.col("c_custkey") % 10 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return profile.diff_by_range(a, b, "c_custkey", 64)


# manifests

def entities(t: Tables) -> DataFrame:
    share = F.col("errors") / F.col("pages")
    status = F.when(F.col("errors") == 0, "completed").when(share > 0.3, "failed").otherwise("partial")
    return states(t).withColumn("status", status).withColumn("load_id", (F.col("user_id") % 4).cast("string"))


ENTITIES = "(select user_id, cast(user_id % 4 as varchar) as load_id, count(*) as pages, count(*) filter (event_type = 'error') as errors, min(ts) as start_time, max(ts) as end_time, case when count(*) filter (event_type = 'error') = 0 then 'completed' when count(*) filter (event_type = 'error') / count(*)::double > 0.3 then 'failed' else 'partial' end as status from events group by 1)"


@query("manifest_summary", f"select load_id, count(*) as entities, count(*) filter (status = 'completed') as completed, count(*) filter (status = 'failed') as failed, count(*) filter (status = 'partial') as partial_count, round(100.0::double * count(*) filter (status = 'completed') / count(*), 2) as success_percent, sum(pages)::bigint as pages, round(avg(pages), 2) as pages_per_entity from {ENTITIES} group by 1")
def _(t):
    return M.summary(entities(t), ["load_id"])


@query("manifest_errors", "select cast(user_id % 4 as varchar) as load_id, props as error_type, count(*) as errors, count(distinct user_id) as entities from events where event_type = 'error' group by 1, 2")
def _(t):
    e = t.events.where("event_type = 'error'").withColumn("load_id", (F.col("user_id") % 4).cast("string"))
    return M.error_types(e, ["load_id"], F.col("props"), "user_id")


@query("manifest_duration", f"select load_id, min(start_time) as start_time, max(end_time) as end_time, round((epoch_us(max(end_time)) - epoch_us(min(start_time))) / 1e6, 2) as seconds, round((epoch_us(max(end_time)) - epoch_us(min(start_time))) / 1e6 / count(*), 2) as seconds_per_entity from {ENTITIES} group by 1")
def _(t):
    return M.durations(entities(t), ["load_id"])


@query("manifest_entities", f"select load_id, user_id, status, pages, errors, coalesce(error_list, '') as error_list from {ENTITIES} left join (select user_id, string_agg(distinct props, ',' order by props) as error_list from events where event_type = 'error' group by 1) using (user_id)")
def _(t):
    """The errors of each entity as a list."""
    e = M.with_error_list(entities(t), t.events.where("event_type = 'error'"), ["user_id"], "props")
    return e.select("load_id", "user_id", "status", "pages", "errors", F.array_join("error_list", ",").alias("error_list"))


@query("manifest_authors", "select o_custkey % 20 as author_id, count(distinct o_orderkey) as publications, count(distinct l_partkey) as unique_ids, count(*) as ids, count(distinct case when l_returnflag = 'R' then o_orderkey end) as failed, count(*) filter (l_returnflag = 'R') > 0 as with_errors from orders join lineitem on o_orderkey = l_orderkey group by 1")
def _(t):
    """Lines that came back stand for errors."""
    j = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return M.authors(j, F.col("o_custkey") % 20, "o_orderkey", "l_partkey", F.col("l_returnflag") == "R")


@query("manifest_chunks", "with c as (select doc_id, (row_number() over (order by doc_id) - 1) // 25 + 1 as chunk from documents), l as (select distinct doc_id, 1 as hit from labels) select cast(chunk as bigint) as chunk, count(*) as ids, count(hit) as results, round(100.0::double * count(hit) / count(*), 2) as coverage from c left join l using (doc_id) group by 1")
def _(t):
    from lakeforge.operators.relational import chunked

    c = chunked(t.documents.select("doc_id"), "doc_id")
    j = c.join(t.labels.select("doc_id", F.lit(1).alias("hit")).distinct(), "doc_id", "left")
    return M.hits(j, ["chunk"], F.col("hit").isNotNull())


@query("manifest_batches", "select cast(p_partkey // 25 as bigint) as batch, count(*) as ids, count(c) as cited, round(100.0::double * count(c) / count(*), 2) as cited_percent, coalesce(sum(c), 0)::bigint as citations from part left join (select l_partkey, count(*) as c from lineitem group by 1) on p_partkey = l_partkey group by 1")
def _(t):
    cited = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("c"))
    j = t.part.select("p_partkey").join(cited, "p_partkey", "left")
    return M.hits(j, [F.floor(F.col("p_partkey") / 25).alias("batch")], F.col("c").isNotNull(), "ids", "cited", "cited_percent", citations=F.coalesce(F.sum("c"), F.lit(0)))


@query("manifest_items", "select event_type, count(*) as items, count(*) filter (value > 50) as with_metrics, round(100.0::double * count(*) filter (value > 50) / count(*), 2) as coverage, round(sum(value), 2) as mentions from events group by 1")
def _(t):
    return M.hits(t.events, ["event_type"], F.col("value") > 50, "items", "with_metrics", mentions=F.round(F.sum("value"), 2))


@query("manifest_rebuild", "select user_id % 20 as author_id, count(*) as pages, count(distinct event_type) as kinds from events where event_id % 13 <> 0 group by 1")
def _(t):
    stored = t.events.select("event_id", "user_id", "event_type", F.when(F.col("event_id") % 13 != 0, S.content_hash(F.col("props"))).otherwise("stale").alias("stored"))
    valid = t.events.select("event_id", S.content_hash(F.col("props")).alias("stored"))
    return stored.join(valid, ["event_id", "stored"], "left_semi").groupBy((F.col("user_id") % 20).alias("author_id")).agg(F.count("*").alias("pages"), F.count_distinct("event_type").alias("kinds"))


@query("collect_query_params", "select event_type as load_id, event_id // 1000 as page, string_agg(cast(event_id as varchar), ',' order by event_id) as params from events group by 1, 2")
def _(t):
    """In pages of a thousand ids, so that no row holds all of a load."""
    return M.params_by_page(t.events, F.col("event_type"), "event_id")


@query("collect_payload_audit", f"select load_id, entity_id, '[' || string_agg('{{\"file\":\"' || entity_id || '_' || lpad(cast(page_number as varchar), 6, '0') || '\",\"size_kb\":' || cast(length(props)::double as varchar) || '}}', ',' order by page_number) || ']' as payload_files from ({PAGES_SQL}) group by 1, 2")
def _(t):
    """Files and sizes of each entity of a load."""
    files = pages(t).select("load_id", "entity_id", F.concat_ws("_", F.col("entity_id").cast("string"), F.lpad(F.col("page_number").cast("string"), 6, "0")).alias("name"), (F.length("props") * 1024).alias("bytes"))
    return M.payload_files(files, ["load_id", "entity_id"], "name", "bytes")


@query("distinct_load_ids", f"select distinct load_id from ({PAGES_SQL})")
def _(t):
    return t.events.select(F.date_format("ts", "yyyyMMdd").alias("load_id")).where("load_id is not null").distinct()


@query("pk_candidates", "select 'event_id' as column_name, count(*) as n from events having count(*) = count(distinct event_id)")
def _(t):
    return registry.pk_candidates(t.events)


@query("rows_per_load", f"select load_id, count(*) as n from ({PAGES_SQL}) group by 1")
def _(t):
    return M.rows_per(t.events, F.date_format("ts", "yyyyMMdd"))


@query("duplicate_keys", "select user_id, event_type, count(*) as n from events group by 1, 2 having count(*) > 1")
def _(t):
    return M.duplicate_keys(t.events, ["user_id", "event_type"])


AUDITED = "(select case when event_id % 501 = 0 then 'again' else cast(event_id as varchar) end as load_id, case when event_id % 17 <> 0 then event_type end as data_source, ts as ingest_timestamp, case when event_id % 19 = 0 then 'broken' else props end as query_parameters, event_id % 3 = 0 as is_reprocessed, case when event_id % 6 = 0 then 'manual' end as reprocessing_reason from events)"


@query("audit_validation", f"select 'no_duplicates' as check_name, count(*) = count(distinct load_id) as ok from {AUDITED} union all select 'all_fields_populated', count(*) filter (load_id is null or data_source is null or ingest_timestamp is null) = 0 from {AUDITED} union all select 'valid_timestamps', count(*) filter (ingest_timestamp < timestamp '2020-01-01' or ingest_timestamp > timestamp '2030-01-01') = 0 from {AUDITED} union all select 'valid_json', count(*) filter (query_parameters is not null and not json_valid(query_parameters)) = 0 from {AUDITED} union all select 'reprocessed_flag_consistent', count(*) filter (is_reprocessed and reprocessing_reason is null) = 0 from {AUDITED} union all select 'has_data', count(*) > 0 from {AUDITED}")
def _(t):
    n = F.col("event_id")
    a = t.events.select(F.when(n % 501 == 0, "again").otherwise(n.cast("string")).alias("load_id"), F.when(n % 17 != 0, F.col("event_type")).alias("data_source"), F.col("ts").alias("ingest_timestamp"), F.when(n % 19 == 0, "broken").otherwise(F.col("props")).alias("query_parameters"), (n % 3 == 0).alias("is_reprocessed"), F.when(n % 6 == 0, "manual").alias("reprocessing_reason"))
    return dq.validate_audit(a, ["load_id", "data_source", "ingest_timestamp"], F.expr("timestamp_ntz '2030-01-01 00:00:00'"))


@query("ops_metrics", "select count(*) as total, count(*) filter (ts > timestamp '2024-01-30' - interval 24 hours and ts <= timestamp '2024-01-30') as last_day, min(ts) as oldest, max(ts) as newest, count(distinct event_type) as sources from events")
def _(t):
    return M.operations(t.events, "ts", F.expr("timestamp_ntz '2024-01-30 00:00:00'"), "event_type")


@query("run_statistics", f"select count(*) as runs, count(*) filter (status = 'completed') as successes, count(*) filter (status = 'failed') as failures, sum(pages)::bigint as rows_inserted, round(avg((epoch_us(end_time) - epoch_us(start_time)) / 1e6), 2) as mean_seconds from {ENTITIES}")
def _(t):
    return M.run_statistics(entities(t))
