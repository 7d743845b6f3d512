"""Joins, windows, limits, sets and vault loads: JN, WN, SO, ST and DV queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakeforge.functions import scalars as S
from lakeforge.operators import relational as J
from lakeforge.operators import manifests as M
from lakeforge.operators import versions as V
from lakeforge.plans.fixtures import PAGES_SQL, pages, states
from lakeforge.plans.landing import AUDIT, audits
from lakeforge.plans.registry import Tables, query
from lakeforge.sources import sinks as K
from lakeforge.sources.scratch import scratch


@query("anti_incomplete", "select user_id, event_id from events where user_id % 3 = 0")
def _(t):
    return J.incomplete(t.events.select("user_id", "event_id"), states(t), "user_id")


@query("anti_incomplete_chunks", "select cast(chunk as bigint) as chunk, count(*) as ids from (select (row_number() over (order by doc_id) - 1) // 25 + 1 as chunk from documents) where chunk % 2 = 1 group by 1")
def _(t):
    c = J.chunked(t.documents.select("doc_id"), "doc_id")
    done = c.select("chunk").distinct().select("chunk", (F.col("chunk") % 2 == 0).alias("completed"))
    return J.incomplete(c, done, "chunk").groupBy("chunk").agg(F.count("*").alias("ids"))


@query("anti_not_exists", f"select load_id, orders from ({AUDIT}) where d % 2 = 0")
def _(t):
    a = audits(t)
    return J.absent(a, a.where("d % 2 = 1"), ["load_id"]).select("load_id", "orders")


@query("update_from", "select c_custkey, case when c_custkey % 3 = 0 then 'X' else c_mktsegment end as c_mktsegment from customer")
def _(t):
    c = t.customer.select("c_custkey", "c_mktsegment")
    return J.update_from(c, c.where("c_custkey % 3 = 0").withColumn("c_mktsegment", F.lit("X")), ["c_custkey"], "c_mktsegment")


@query("lookup_default", "select c_custkey, coalesce(o_orderstatus, 'scopus_search_api') as source, case c_custkey % 3 when 0 then '[\"a\",\"b\"]' when 1 then '[\"' || c_mktsegment || '\"]' else '[]' end as query_parameters from customer left join (select o_custkey, max(o_orderstatus) as o_orderstatus from orders group by 1) on c_custkey = o_custkey")
def _(t):
    """Manifests in three forms: with all parameters, with the one of the query, with none."""
    r = F.col("c_custkey") % 3
    manifest = F.when(r == 0, F.to_json(F.struct(F.array(F.lit("a"), F.lit("b")).alias("all_query_parameters")))).when(r == 1, F.to_json(F.struct(F.col("c_mktsegment").alias("query_parameters")))).otherwise("{}")
    m = t.customer.select("c_custkey", manifest.alias("m"))
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderstatus").alias("s"))
    return m.join(o, "c_custkey", "left").select("c_custkey", F.coalesce("s", F.lit("scopus_search_api")).alias("source"), S.query_parameters(F.col("m")).alias("query_parameters"))


@query("log_with_version", "select l_orderkey, l_linenumber, o_orderstatus from lineitem join orders on l_orderkey = o_orderkey where o_orderpriority = '1-URGENT'")
def _(t):
    o = t.orders.where("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_orderstatus")
    log = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_orderkey").alias("o_orderkey"))
    return V.logged(log, o, "o_orderkey", ["o_orderstatus"]).drop("o_orderkey")


@query("semi_cited_dois", "select p_partkey from part where p_partkey in (select l_partkey from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'F')")
def _(t):
    closed = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return V.cited(t.part.select("p_partkey"), "p_partkey", t.lineitem, "l_partkey", closed, "l_orderkey")


@query("coverage_join", "select count(*) as requested, count(hit) as matched, count(*) - count(hit) as unmatched, round(100.0::double * count(hit) / count(*), 2) as rate from (select distinct doc_id from documents) left join (select distinct doc_id, 1 as hit from labels) using (doc_id)")
def _(t):
    return J.coverage(t.documents.unionByName(t.documents.where("doc_id % 10 = 0")), t.labels, "doc_id")


@query("rehydrate_results", "select c_custkey, case when c_custkey % 2 = 0 then 'run' else 'kept' end as origin from customer")
def _(t):
    c = t.customer.select("c_custkey")
    return J.rehydrate(c.where("c_custkey % 2 = 0").withColumn("origin", F.lit("run")), c.withColumn("origin", F.lit("kept")), "c_custkey")


@query("file_manifest_join", f"select load_id, cast(entity_id as varchar) || '_' || page_number as file, case when event_id % 3 = 0 then cast(length(props) as bigint) end as size from ({PAGES_SQL})")
def _(t):
    p = pages(t).withColumn("file", F.concat_ws("_", F.col("entity_id").cast("string"), F.col("page_number").cast("string")))
    names = p.select("load_id", "file")
    stats = p.where("event_id % 3 = 0").select("load_id", "file", F.length("props").cast("long").alias("size"))
    return names.join(stats, ["load_id", "file"], "left")


@query("cache_fresh_lookup", "select a.event_id, max(b.event_id) as hit from events a left join (select user_id, event_type, ts, max(event_id) as event_id from events group by 1, 2, 3) b on a.user_id = b.user_id and a.event_type = b.event_type and b.ts < a.ts and b.ts >= a.ts - interval 3600 seconds and not exists (select 1 from events c where c.user_id = a.user_id and c.event_type = a.event_type and c.ts < a.ts and c.ts > b.ts) group by 1")
def _(t):
    e = t.events.select("user_id", "event_type", "ts", "event_id")
    cached = e.groupBy("user_id", "event_type", "ts").agg(F.max("event_id").alias("event_id"))
    return J.fresh_lookup(e, cached, ["user_id", "event_type"], "ts", 3600, "event_id").select("event_id", "hit")


@query("usage_7d", "select event_id, count(*) over (partition by event_type order by epoch(date_trunc('second', ts)) range between 604800 preceding and current row) as used, count(*) over (partition by event_type order by epoch(date_trunc('second', ts)) range between 604800 preceding and current row) < 400 as within from events")
def _(t):
    return J.usage(t.events.select("event_id", "event_type", "ts"), "event_type", "ts", 7 * 86400, 400).select("event_id", "used", "within")


@query("chunk_ids", "select doc_id, cast((row_number() over (order by doc_id) - 1) // 25 + 1 as bigint) as chunk from documents")
def _(t):
    return J.chunked(t.documents.select("doc_id"), "doc_id").select("doc_id", "chunk")


@query("current_version", "select user_id, event_type, max_by(event_id, (ts, event_id)) as event_id from events group by 1, 2")
def _(t):
    return V.current(t.events.select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("resume_point", f"select load_id, entity_id, max(page_number) + 1 as next_page, min(case when event_type = 'error' then page_number end) as first_invalid from ({PAGES_SQL}) group by 1, 2")
def _(t):
    return M.resume_points(pages(t), ["load_id", "entity_id"], "page_number", F.col("event_type") == "error")


@query("version_delta", "select event_id, lag(props) over (partition by user_id order by event_id) as previous, props is distinct from lag(props) over (partition by user_id order by event_id) as changed from events")
def _(t):
    return V.deltas(t.events.select("user_id", "event_id", "props"), ["user_id"], "event_id", "props", 10_000).select("event_id", "previous", "changed")


@query("history_limit", "select event_id, event_type from events order by ts desc, event_id desc limit 10")
def _(t):
    return V.newest(t.events, ["ts", "event_id"], 10).select("event_id", "event_type")


@query("recent_changes", "select event_id, c_mktsegment from events join customer on user_id = c_custkey where event_type = 'click' order by ts desc, event_id desc limit 20")
def _(t):
    j = V.logged(t.events, t.customer.withColumnRenamed("c_custkey", "user_id"), "user_id", ["c_mktsegment"])
    return V.newest(j, ["ts", "event_id"], 20, F.col("event_type") == "click").select("event_id", "c_mktsegment")


@query("recent_loads", f"select load_id, orders from ({AUDIT}) order by load_id desc limit 10")
def _(t):
    return V.newest(audits(t), ["load_id"], 10).select("load_id", "orders")


@query("any_load_id", f"select min(load_id) as load_id from ({PAGES_SQL})")
def _(t):
    return t.events.agg(F.min(F.date_format("ts", "yyyyMMdd")).alias("load_id"))


@query("unique_identifiers", "select distinct 'part' as kind, l_partkey as id from lineitem union all select distinct 'supplier', l_suppkey from lineitem")
def _(t):
    return V.identifiers(t.lineitem, {"part": "l_partkey", "supplier": "l_suppkey"})


@query("union_doi_sets", "select count(distinct l_partkey) as n from lineitem")
def _(t):
    return t.lineitem.select("l_partkey").distinct().agg(F.count("*").alias("n"))


@query("missing_in_destination", "select doc_id from documents except select doc_id from labels")
def _(t):
    return t.documents.select("doc_id").subtract(t.labels.select("doc_id"))


OLD, NEW = ("(select distinct event_type || '_' || user_id || '_' || (event_id %% 8) as name from events where ts %s timestamp '2024-01-15')" % op for op in ("<", ">="))


def names(t: Tables, cond: str):
    """Column names seen in a load: those of events of one half of the month."""
    return t.events.where(f"ts {cond} timestamp_ntz '2024-01-15 00:00:00'").select(F.concat_ws("_", "event_type", F.col("user_id").cast("string"), (F.col("event_id") % 8).cast("string")).alias("name"))


@query("schema_added", f"select name from {NEW} except select name from {OLD}")
def _(t):
    return V.compared(names(t, "<"), names(t, ">="), "name").where("change = 'added'").select("name")


@query("schema_removed", f"select name from {OLD} except select name from {NEW}")
def _(t):
    return V.compared(names(t, "<"), names(t, ">="), "name").where("change = 'removed'").select("name")


@query("schema_common", f"select name from {OLD} intersect select name from {NEW}")
def _(t):
    return V.compared(names(t, "<"), names(t, ">="), "name").where("change = 'common'").select("name")


@query("multi_source_union", "select c_custkey as id, c_mktsegment as segment, null::bigint as size, 'customer' as source from customer union all select p_partkey, null, p_size, 'part' from part")
def _(t):
    """Two sources that load; one that is not there and one with a value that is no number do not."""
    schema = StructType([StructField("id", LongType()), StructField("segment", StringType()), StructField("size", LongType())])
    sources = {
        "customer": lambda: t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")),
        "absent": lambda: t.spark.read.parquet(scratch(t.spark, "absent")),
        "part": lambda: t.part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size")),
        "broken": lambda: t.customer.select(F.col("c_name").alias("id")),
    }
    rows, _ = J.union_isolated(sources, schema, scratch(t.spark, "sources"))
    return rows


@query("dedup_content_hash", "select user_id, min(event_id) as event_id from events group by user_id, props")
def _(t):
    from lakeforge.functions.scalars import content_hash

    return J.first_by(t.events.select("user_id", "event_id", content_hash(F.col("props")).alias("h")), ["user_id", "h"], [F.col("event_id")]).select("user_id", "event_id")


# vault

@query("hub_load", "select distinct o_custkey, sha256(cast(o_custkey as varchar)) as hub_key from orders where o_custkey % 2 = 0")
def _(t):
    o = t.orders.select("o_custkey")
    return J.hub_load(o.where("o_custkey % 2 = 1"), o, "o_custkey")


@query("link_load", "select distinct l_partkey, l_suppkey, sha256(l_partkey || '|' || l_suppkey) as link_key from lineitem where l_partkey % 2 = 0")
def _(t):
    pairs = t.lineitem.select("l_partkey", "l_suppkey")
    return J.link_load(pairs.where("l_partkey % 2 = 1"), pairs, ["l_partkey", "l_suppkey"])


@query("satellite_load", "select c_custkey, c_mktsegment from customer where c_custkey % 5 <> 1")
def _(t):
    old = t.customer.where("c_custkey % 5 in (0, 1)").select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, "old").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    old = old.select("c_custkey", J.hash_key(F.col("c_mktsegment")).alias("hash_diff"), F.lit(1).alias("load_ts"))
    return J.satellite_load(old, t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", ["c_mktsegment"]).select("c_custkey", "c_mktsegment")


@query("gold_metrics", "select o_custkey as entity, cast(year(o_orderdate) as integer) as year, count(*) as orders, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as total from orders group by rollup (1, 2)")
def _(t):
    """By customer and year, with sums of each customer and of all."""
    years = t.orders.select(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("year"), "o_totalprice")
    return J.rolled_up(years, ["entity", "year"], {"orders": F.count("*"), "total": F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")})
