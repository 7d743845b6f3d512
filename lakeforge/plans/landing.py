"""Sources, sinks and scalar shaping: SR, SK and SC queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lakeforge.functions import scalars as S
from lakeforge.operators import dq, staging
from lakeforge.operators import manifests as M
from lakeforge.plans.fixtures import PAGES_SQL, entries, pages, payload_files, states
from lakeforge.plans.registry import Tables, query
from lakeforge.sources import files as R
from lakeforge.sources import sinks as K
from lakeforge.sources.scratch import scratch

GROUPS = "select distinct o_custkey % 50 as grp from orders where o_orderkey in (select l_orderkey from lineitem)"


def landed(t: Tables) -> str:
    path = scratch(t.spark, "payload")
    payload_files(t, path)
    return path


def text_of(files: DataFrame) -> DataFrame:
    return files.select(F.regexp_replace("value", r"\s+$", "").alias("value"), "size")


@query("scan_payload_json", f"with g as ({GROUPS}) select count(*) as files from g where grp not in (48, 49)")
def _(t):
    # part files of the text writer stand for the payload files
    return R.scan_payload(t.spark, landed(t), "*.txt").agg(F.count("*").alias("files"))


@query("scan_quarantine", f"with g as ({GROUPS}) select case grp when 48 then 'malformed' else 'no load_id' end as reason, count(*) as files from g where grp in (48, 49) group by 1")
def _(t):
    return R.scan_quarantine(t.spark, landed(t), "*.txt").groupBy("reason").agg(F.count("*").alias("files"))


@query("scan_manifest_json", "select strftime(o_orderdate, '%Y%m') as load_id, count(*) as n from orders group by 1")
def _(t):
    path = scratch(t.spark, "manifest")
    n = t.orders.groupBy(F.date_format("o_orderdate", "yyyyMM").alias("load_id")).agg(F.count("*").alias("n"))
    n.select(F.to_json(F.struct("load_id", "n")).alias("value"), F.concat(F.lit("x_manifest_"), F.col("load_id")).alias("of")).repartition("of").write.partitionBy("of").text(path)
    files = R.scan_manifest(t.spark, path, "*.txt").where(F.col("path").contains("_manifest_"))
    rows = F.explode(F.split(F.trim(F.regexp_replace("value", r"\s+$", "")), "\n"))
    return files.select(rows.alias("value")).select(F.from_json("value", "load_id string, n long").alias("m")).select("m.*")


@query("scan_id_list", "select cast(doc_id as varchar) as id from documents union all select cast(doc_id as varchar) from documents where doc_id % 10 = 0")
def _(t):
    path = scratch(t.spark, "ids")
    ids = t.documents.select(F.concat(F.lit("  "), F.col("doc_id").cast("string"), F.lit("\t")).alias("value"))
    ids.unionAll(ids.where(F.trim(F.regexp_replace("value", "\t", "")).cast("long") % 10 == 0)).unionAll(t.documents.limit(1).select(F.lit("   "))).write.text(path)
    return R.scan_ids(t.spark, path)


@query("scan_id_list_dedup", "select cast(user_id as varchar) as id, min(event_id) as pos from events group by 1")
def _(t):
    return R.distinct_in_order(t.events.select(F.col("user_id").cast("string").alias("id"), F.col("event_id").alias("pos")))


@query("scan_date_partition", "select cast(event_id as varchar) as value from events where cast(ts as date) = date '2024-01-05'")
def _(t):
    path = scratch(t.spark, "dated")
    dated = t.events.select(F.col("event_id").cast("string").alias("value"), F.date_format("ts", "yyyyMM").cast("int").alias("yyyymm"), F.dayofmonth("ts").alias("dd"))
    dated.write.partitionBy("yyyymm", "dd").text(path)
    return R.dated_files(t.spark, path, "20240105", "part-*.txt").select("value")


@query("scan_table", "select count(*) as n, count(distinct l_orderkey) as orders, sum(l_quantity) as quantity, least(count(*), 1000) as sampled from lineitem")
def _(t):
    whole = R.scan_table(t.lineitem).agg(F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("orders"), F.sum("l_quantity").alias("quantity"))
    return whole.crossJoin(R.scan_table(t.lineitem, 1000).agg(F.count("*").alias("sampled")))  # one row each


@query("scan_file_stats", f"with g as ({GROUPS}) select count(*) as files, true as all_sized from g")
def _(t):
    files = R.scan_json(t.spark, landed(t), "*.txt")
    sized = R.with_file_stats(files.select("path"), files)
    return sized.agg(F.count("*").alias("files"), F.bool_and(F.col("size_kb") > 0).alias("all_sized"))


@query("scan_check_spec", "select 'known' as check_name, cast(count(*) filter (event_type not in ('click', 'view')) as double) as value, case when count(*) filter (event_type not in ('click', 'view')) > 0 then 'fail' else 'pass' end as outcome from events union all select 'low', min(value), case when min(value) < 0 then 'fail' when min(value) < 1 then 'warn' else 'pass' end from events union all select 'users', cast(count(*) filter (user_id is null) as double), case when count(*) filter (user_id is null) > 0 then 'fail' else 'pass' end from events union all select 'high', max(value), case when max(value) > 1 then 'warn' else 'pass' end from events")
def _(t):
    """Checks written as rows of JSON, read back and compiled to one aggregate."""
    path = scratch(t.spark, "checks")
    spec = [("quality", "known", "invalid_count", "event_type", "event_type in ('click', 'view')", None, 0.0, None, None), ("quality", "low", "min", "value", None, 0.0, None, 1.0, None), ("critical", "users", "missing_count", "user_id", None, None, 0.0, None, None), ("monitoring", "high", "max", "value", None, None, None, None, 1.0)]
    t.spark.createDataFrame(spec, dq.SPEC).write.json(path)
    return dq.run_checks(t.events, dq.compiled(t.spark.read.schema(dq.SPEC).json(path))).select("check_name", "value", "outcome")


# sinks

@query("sink_truncate_reload", "select n_nationkey, n_name from nation")
def _(t):
    path = scratch(t.spark, "staging")
    K.reload(t.region.selectExpr("r_regionkey as n_nationkey", "r_name as n_name"), path)
    return K.reload(t.nation.select("n_nationkey", "n_name"), path)


UPSERT = f"with p as ({PAGES_SQL}) select load_id, entity_id, page_number, case when event_id % 5 = 0 then value + 1 else value end as value, event_type as data_source from p"


@query("sink_upsert_response", UPSERT)
def _(t):
    p = pages(t).select("load_id", "entity_id", "page_number", "value", F.col("event_type").alias("data_source"), "event_id")
    new = p.where("event_id % 5 = 0").withColumn("value", F.col("value") + 1).withColumn("data_source", F.lit("other"))
    return K.upsert(p.drop("event_id"), new.drop("event_id"), ["load_id", "entity_id", "page_number"], keep=["data_source"])


@query("sink_upsert_state", "select user_id, case when user_id % 2 = 0 then 0 else count(*) end as pages, min(ts) as created from events group by 1")
def _(t):
    s = states(t).select("user_id", "pages", F.col("start_time").alias("created"))
    return K.upsert(s, s.where("user_id % 2 = 0").select("user_id", F.lit(0).cast("long").alias("pages"), F.lit(None).cast("timestamp_ntz").alias("created")), ["user_id"], keep=["created"])


@query("sink_insert_or_replace", "select c_custkey, case when c_custkey % 4 = 0 then 'NEW' else c_mktsegment end as c_mktsegment from customer")
def _(t):
    c = t.customer.select("c_custkey", "c_mktsegment")
    return K.insert_or_replace(c, c.where("c_custkey % 4 = 0").withColumn("c_mktsegment", F.lit("NEW")), ["c_custkey"])


AUDIT = "select strftime(o_orderdate, '%Y%m%d') as load_id, count(*) as orders, sum(o_totalprice) as total, day(o_orderdate) as d from orders group by 1, 4"


def audits(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("load_id"), F.dayofmonth("o_orderdate").alias("d")).agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("total"))


@query("sink_insert_missing", f"select load_id, orders, cast(null as varchar) as reprocessing_reason from ({AUDIT}) where d % 2 = 0")
def _(t):
    a = audits(t)
    target = a.where("d % 2 = 1").select("load_id", "orders", F.lit(None).cast("string").alias("reprocessing_reason"))
    return K.insert_missing(target, a.select("load_id", "orders"), ["load_id"])


@query("sink_run_status", f"select case when i = 0 then 'idempotent' when i = n then 'all_new' else 'partial' end as status, cast(i as bigint) as inserted, n - cast(i as bigint) as skipped, n as total from (select sum(case when d % 2 = 0 then 1 else 0 end) as i, count(*) as n from ({AUDIT}))")
def _(t):
    """The counts come from the write that appends the missing rows."""
    a, path = audits(t), scratch(t.spark, "audit")
    target = K.reload(a.where("d % 2 = 1").select("load_id", "orders"), path)
    n = K.append_missing(target, a.select("load_id", "orders"), ["load_id"], path)
    one = t.spark.range(1).select(*(F.lit(n[c]).cast("long").alias(c) for c in ("inserted", "skipped", "total")))
    return one.select(K.run_status(F.col("inserted"), F.col("total")).alias("status"), "inserted", "skipped", "total")


@query("sink_version_flip", "select user_id, event_id, row_number() over (partition by user_id order by event_id desc) = 1 as is_current from events")
def _(t):
    return K.version_flip(t.events.select("user_id", "event_id"), ["user_id"], "event_id")


@query("sink_flag_update", "select user_id, user_id % 3 <> 0 or count(*) > 60 as completed from events group by 1")
def _(t):
    s = states(t).select("user_id", "pages", "completed")
    return K.flag_update(s, s.where("pages > 60").withColumn("completed", F.lit(True)), "user_id", "completed").select("user_id", "completed")


@query("sink_report_json", "select report || case when rn > 1 then '_' || (rn - 1) else '' end as report, count(*) as n from (select report, row_number() over (partition by report) as rn from (select event_type || '_' || strftime(ts, '%Y%m%d') || '_' || strftime(date_trunc('hour', ts), '%Y%m%d_%H%M%S') as report from events)) group by 1")
def _(t):
    """A report for each event, its time cut to the hour so that names are taken more than once."""
    path = scratch(t.spark, "reports")
    named = t.events.select("event_type", F.date_format("ts", "yyyyMMdd").alias("load_id"), F.date_trunc("hour", "ts").alias("at"), "event_id")
    K.write_reports(K.report_names(named, "event_type", "load_id", "at").select("report", "load_id"), path)
    return t.spark.read.schema("report string, load_id string").json(path).groupBy("report").agg(F.count("*").alias("n"))


@query("sink_sorted_text", "select cast(doc_id as varchar) as id from documents")
def _(t):
    path = scratch(t.spark, "sorted")
    K.write_sorted_ids(t.documents.select(F.col("doc_id").alias("id")), path)
    return R.scan_ids(t.spark, path)


@query("sink_date_partitioned", "select event_id, cast(strftime(ts, '%Y%m') as integer) as yyyymm, cast(day(ts) as integer) as dd from events")
def _(t):
    path = scratch(t.spark, "layout")
    K.write_dated(t.events.select("event_id", "ts"), "ts", path)
    return t.spark.read.parquet(path).select("event_id", "yyyymm", "dd")


@query("sink_typed_table", "select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, cast(0 as double) as score from customer")
def _(t):
    """A key that is never null or repeated, and a default for a column that the source lacks."""
    schema = StructType([StructField("c_custkey", LongType(), False), StructField("c_name", StringType()), StructField("c_nationkey", LongType()), StructField("score", DoubleType())])
    return K.constrained(t.customer, schema, ["c_custkey"], {"score": 0.0})


# scalar functions

@query("json_drop_keys", "select event_id, '{}' as props from events")
def _(t):
    return t.events.select("event_id", S.clean_json_column(t.events, "props", drop=["k"]).alias("props"))


@query("json_drop_patterns", "select event_id, case event_type when 'click' then '{}' when 'view' then replace(props, ': ', ':') else props end as props from events")
def _(t):
    """Keys to drop by source: one row each."""
    listed = t.spark.createDataFrame([("click", ["k", "debug"]), ("view", ["debug"])], "event_type string, keys array<string>")
    return t.events.join(F.broadcast(listed), "event_type", "left").select("event_id", S.drop_listed(F.col("props"), F.col("keys")).alias("props"))


AUTHORS = "select '2-s2.0-' || l_orderkey as eid, cast(l_linenumber as varchar) as author_list_position, cast(l_suppkey as varchar) as author_id, cast(l_partkey as varchar) as affiliation, trim(l_returnflag || ' ' || l_linestatus) as author_name from lineitem join orders on l_orderkey = o_orderkey"


def authors(t: Tables) -> DataFrame:
    renamed = lambda a: F.struct(a["@seq"].alias("author_list_position"), a["authid"].alias("author_id"), F.transform(a["afid"], lambda x: F.to_variant_object(x)).alias("scopus_affiliation_id"), S.author_name(a["given-name"], a["surname"]).alias("author_name"))
    return entries(t).select("eid", F.transform("author", renamed).alias("author")).select("eid", F.inline("author"))


@query("json_rename_keys", "select '{\"eid\": \"2-s2.0-' || o_orderkey || '\", \"publication_keywords\": \"' || o_orderpriority || '\", \"open_access_status\": {\"value\": \"' || o_orderstatus || '\"}, \"author\": [{\"author_list_position\": \"1\", \"scopus_author_id\": \"' || o_custkey || '\", \"scopus_author_page_url\": \"u\", \"scopus_affiliation_id\": [\"7\"]}], \"affiliation\": {\"scopus_affiliation_name\": \"n\", \"scopus_affiliation_city\": \"c\", \"scopus_affiliation_country\": \"d\", \"scopus_affiliation_url\": \"u\"}}' as entry from orders")
def _(t):
    """All ten renames, at every depth."""
    s = lambda name, v: F.lit(v).alias(name)
    author = F.struct(s("@seq", "1"), F.col("o_custkey").cast("string").alias("authid"), s("author-url", "u"), F.array(F.lit("7")).alias("afid"))
    place = F.struct(s("affilname", "n"), s("affiliation-city", "c"), s("affiliation-country", "d"), s("affiliation-url", "u"))
    entry = F.struct(F.concat(F.lit("2-s2.0-"), F.col("o_orderkey").cast("string")).alias("eid"), F.col("o_orderpriority").alias("authkeywords"), F.struct(F.col("o_orderstatus").alias("value")).alias("freetoreadLabel"), F.array(author).alias("author"), place.alias("affiliation"))
    return t.orders.select(S.clean_json(rename=S.RENAMES)(F.to_json(entry)).alias("entry"))


COUNT = "select '2-s2.0-' || l_orderkey as eid, '100' as scopus_exported_authors_limit, cast(count(*) as varchar) as scopus_total_authors_count, cast(count(*) as varchar) as scopus_exported_authors_count from lineitem join orders on l_orderkey = o_orderkey group by l_orderkey"


@query("json_rename_context", COUNT)
def _(t):
    return entries(t).select("eid", S.rename_fields(F.col("author-count"), S.COUNT_RENAMES).alias("c")).select("eid", "c.*")


@query("array_unwrap_dollar", f"select eid, author_id, affiliation, 'plain' as other from ({AUTHORS})")
def _(t):
    """Each list with an item that is not wrapped at its end."""
    items = S.unwrap_dollar(F.concat("scopus_affiliation_id", F.array(F.parse_json(F.lit('"plain"')))))
    return authors(t).select("eid", "author_id", F.transform(items, lambda x: F.variant_get(x, "$", "string")).alias("a")).select("eid", "author_id", F.col("a")[0].alias("affiliation"), F.col("a")[1].alias("other"))


@query("struct_value_unwrap", "select '2-s2.0-' || o_orderkey as eid, case when o_orderkey % 3 = 0 then '{\"none\":\"' || o_orderstatus || '\"}' else '[\"' || o_orderstatus || '\"]' end as status from orders where o_orderkey in (select l_orderkey from lineitem)")
def _(t):
    """Every third label has no value and stays as it is."""
    label = F.when(F.col("o_orderkey") % 3 == 0, F.to_json(F.struct(F.col("freetoreadLabel.value")[0]["$"].alias("none")))).otherwise(F.to_json("freetoreadLabel"))
    return entries(t).select("eid", S.unwrap_value(F.parse_json(label)).alias("status"))


@query("split_keywords", "select '2-s2.0-' || o_orderkey as eid, case when o_orderkey % 7 = 0 or o_orderkey % 5 = 0 then null else o_orderstatus || ';' || o_orderpriority end as keywords from orders where o_orderkey in (select l_orderkey from lineitem)")
def _(t):
    k = S.split_keywords(F.col("authkeywords"))
    return entries(t).select("eid", F.when(k.isNotNull(), F.array_join(k, ";")).alias("keywords"))


@query("author_name", f"select eid, author_list_position, author_name from ({AUTHORS})")
def _(t):
    return authors(t).select("eid", "author_list_position", "author_name")


@query("json_array_map", "select event_id, case when event_id % 9 = 0 then 'broken' else '[{\"name\":\"' || event_type || ' x\"}]' end as names from events")
def _(t):
    s = F.when(F.col("event_id") % 9 == 0, "broken").otherwise(F.to_json(F.array(F.struct(F.col("event_type").alias("given"), F.lit("x").alias("surname")))))
    out = S.mapped_json(F.col("s"), "array<struct<given:string,surname:string>>", lambda a: F.struct(S.author_name(a["given"], a["surname"]).alias("name")))
    return t.events.select("event_id", s.alias("s")).select("event_id", out.alias("names"))


DIRTY = "case event_id % 11 when 0 then 'undefined' when 1 then '' when 2 then '[]' when 3 then ' null ' else event_type end"


def dirty(t: Tables) -> DataFrame:
    r = F.col("event_id") % 11
    c = F.when(r == 0, "undefined").when(r == 1, "").when(r == 2, "[]").when(r == 3, " null ").otherwise(F.col("event_type"))
    return t.events.withColumn("event_type", c)


@query("null_normalise", f"select event_id, case when trim({DIRTY}) in ('undefined', '', '[]', 'null') then null else {DIRTY} end as event_type, value from events")
def _(t):
    return S.null_normalise(dirty(t).select("event_id", "event_type", "value"), keep=["event_id"])


STAGED = """with a as (select l_orderkey, '[' || string_agg('{"@seq":"' || l_linenumber || '","afid":[{"$":"' || l_partkey || '"}],"authid":"' || l_suppkey || '","given-name":"' || l_returnflag || '","surname":"' || l_linestatus || '"}', ',' order by cast(l_linenumber as varchar), cast(l_suppkey as varchar), l_returnflag, l_linestatus, cast(l_partkey as varchar)) || ']' as authors, count(*) as n from lineitem group by 1)
select 'scopus_20240101000000' as load_id, 'scopus_search_api' as data_source, '2-s2.0-' || o_orderkey as eid, o_orderpriority as title, o_orderstatus as first_author, 'J' || o_custkey % 50 as journal_name, cast(null as varchar) as issn, cast(null as varchar) as eissn, case when o_orderkey % 6 <> 0 then cast(o_orderkey % 40 as integer) end as journal_volume, cast(null as varchar) as journal_issue, o_orderkey || '-' || (o_orderkey + 9) as journal_page_range, case when o_orderkey % 4 <> 0 then cast(o_orderdate as date) end as publication_date, '10.1/' || o_orderkey as doi, cast(null as varchar) as abstract, cast(o_orderkey as integer) as citations, '{"a":1,"b":"' || o_orderstatus || '"}' as affiliations, case when o_orderkey % 5 <> 0 then cast(o_orderkey as bigint) end as pubmed_id, 'Journal' as publishing_format, cast(null as varchar) as document_type, '{"$":"' || n || '","@limit":"100","@total":"' || n || '"}' as author_count, authors, cast(null as varchar) as publication_keywords, cast(null as varchar) as funder_source_id, cast(null as varchar) as funder_acronym, cast(null as varchar) as funder_number, cast(null as varchar) as funder_name, o_orderkey % 2 = 0 as open_access_flag, '{"value":[{"$":"' || o_orderstatus || '"}]}' as open_access_status
from orders join a on o_orderkey = l_orderkey"""


@query("stage_projection", STAGED)
def _(t):
    """Volumes, dates and ids that do not parse, and columns that payloads lack, are null; affiliations come as text, other JSON nested."""
    k = F.col("o_orderkey")
    odd = lambda m, c: F.when(k % m == 0, "none").otherwise(c)
    e = entries(t).withColumns({
        "load_id": F.lit("scopus_20240101000000"), "data_source": F.lit("scopus_search_api"), "dc:creator": F.col("freetoreadLabel.value")[0]["$"], "prism:publicationName": F.concat(F.lit("J"), F.col("grp").cast("string")),
        "prism:volume": odd(6, (k % 40).cast("string")), "prism:pageRange": F.concat_ws("-", k.cast("string"), (k + 9).cast("string")), "prism:coverDate": odd(4, F.col("`prism:coverDate`")), "prism:doi": F.concat(F.lit("10.1/"), k.cast("string")),
        "affiliation": F.to_json(F.struct(F.col("freetoreadLabel.value")[0]["$"].alias("b"), F.lit(1).alias("a"))), "pubmed-id": odd(5, k.cast("string")), "prism:aggregationType": F.lit("Journal"),
        "openaccessFlag": (k % 2 == 0).cast("string"), "open_access_status": F.col("freetoreadLabel")})
    return staging.stage(e)


def manifests(t: Tables) -> DataFrame:
    a = audits(t)
    return a.select("load_id", F.lit("orders").alias("data_source"), F.regexp_replace("load_id", r"(\d{4})(\d\d)(\d\d)", "$1-$2-$3 00:00:00").alias("ingest_timestamp"), F.to_json(F.struct(F.col("orders").alias("n"))).alias("query_parameters"), (F.col("orders") / 4).alias("ingestion_time"), F.to_json(F.array(F.concat("load_id", F.lit(".json")))).alias("payload_files"), F.md5(F.col("load_id").cast("binary")).alias("audit_schema_hash_value"))


@query("audit_projection", f"select load_id, 'orders' as data_source, cast(strptime(load_id, '%Y%m%d') as timestamp) as ingest_timestamp, '{{\"n\":' || orders || '}}' as query_parameters, 1 as audit_schema_version, cast(orders as double) / 4 as ingestion_time, '[\"' || load_id || '.json\"]' as payload_files, cast(null as varchar) as payload_results, md5(load_id) as audit_schema_hash_value from ({AUDIT})")
def _(t):
    return staging.audit(manifests(t))


@query("nest_to_json", "select '2-s2.0-' || o_orderkey as eid, '{\"value\":[{\"$\":\"' || o_orderstatus || '\"}]}' as label from orders where o_orderkey in (select l_orderkey from lineitem)")
def _(t):
    return S.nested_as_json(entries(t).select("eid", F.col("freetoreadLabel").alias("label")), ["label"])


@query("json_array_length", "select '2-s2.0-' || l_orderkey as eid, cast(count(*) as integer) as n from lineitem join orders on l_orderkey = o_orderkey group by l_orderkey")
def _(t):
    return entries(t).select("eid", S.json_items(F.to_json("author")).alias("n"))


@query("json_path_int", "select event_id, case event_id % 4 when 0 then null when 1 then null else cast(user_id as integer) end as total from events")
def _(t):
    """Every fourth total is missing, every fourth no number."""
    r = F.col("event_id") % 4
    total = F.when(r == 1, "many").when(r > 1, F.col("user_id").cast("string"))
    raw = F.to_json(F.struct(F.struct(total.alias("opensearch:totalResults")).alias("search-results")))
    return t.events.select("event_id", S.json_path_int(F.try_parse_json(raw), "search-results.opensearch:totalResults").alias("total"))


@query("first_non_empty", f"select event_id, coalesce(nullif({DIRTY}, ''), nullif(props, ''), '') as v from events")
def _(t):
    return dirty(t).select("event_id", S.first_non_empty(F.col("event_type"), F.col("props")).alias("v"))


@query("strip_prefix", "select o_orderkey, cast(o_orderkey as varchar) as id from orders where o_orderkey in (select l_orderkey from lineitem)")
def _(t):
    return entries(t).select("o_orderkey", S.strip_prefix(F.col("eid"), "2-s2.0-").alias("id"))


@query("page_from_filename", "select doc_id, case when doc_id % 6 < 5 then cast(doc_id as integer) end as page from documents")
def _(t):
    n, r = F.col("doc_id").cast("string"), F.col("doc_id") % 6
    forms = [("X_PAGE", ".json"), ("a_page_", ".txt"), ("p", "-x"), ("a_", ".json"), ("a_", "_b.txt")]
    name = F.lit("none.txt")
    for i, (head, tail) in enumerate(forms):
        name = F.when(r == i, F.concat(F.lit(head), n, F.lit(tail))).otherwise(name)
    return t.documents.select("doc_id", S.page_from_filename(name).alias("page"))


@query("page_plan", "select user_id, p as page, (p - 1) * 25 as offset_at from (select user_id, unnest(range(1, cast(ceil(count(*) / 25.0) as bigint) + 1)) as p from events group by 1)")
def _(t):
    return M.page_plan(t.events.groupBy("user_id").agg(F.count("*").alias("total")), ["user_id"], "total")


LOADS = "select event_id, event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '_' || substr(md5(cast(event_id as varchar)), 1, 8) as load_id from events"


@query("load_id_build", LOADS)
def _(t):
    return t.events.select("event_id", S.load_id(F.col("event_type"), F.col("ts"), F.col("event_id").cast("string").cast("binary")).alias("load_id"))


@query("load_id_parse", "select event_id, event_type as source, date_trunc('second', ts) as ts from events")
def _(t):
    made = t.events.select("event_id", S.load_id(F.col("event_type"), F.col("ts"), F.col("event_id").cast("string").cast("binary")).alias("id"))
    source, ts = S.load_id_parts(F.col("id"))
    return made.select("event_id", source.alias("source"), ts.cast("timestamp_ntz").alias("ts"))


@query("content_hash", "select cast(json_extract_string(props, '$.k') as bigint) % 10 as k, count(distinct md5(props)) as hashes from events group by 1")
def _(t):
    spaced = F.when(F.col("event_id") % 2 == 0, F.replace("props", F.lit(": "), F.lit(":   "))).otherwise(F.col("props"))
    h = t.events.select((F.get_json_object("props", "$.k").cast("long") % 10).alias("k"), S.content_hash(spaced).alias("h"))
    return h.groupBy("k").agg(F.count_distinct("h").alias("hashes"))


@query("hash_equal", "select event_id, event_id % 17 <> 0 and event_id % 3 = 0 as same from events")
def _(t):
    a = F.when(F.col("event_id") % 17 != 0, F.md5("props"))
    b = F.when(F.col("event_id") % 3 == 0, F.md5("props")).otherwise("x")
    return t.events.select("event_id", S.hash_equal(a, b).alias("same"))


@query("request_fingerprint", "select event_id, md5('GET|' || event_type || '|{\"a\":\"1\",\"b\":\"' || user_id || '\"}|' || case when event_id % 2 = 0 then '{\"A\":\"1\",\"B\":\"2\"}' else '{}' end) as fingerprint from events")
def _(t):
    params = F.create_map(F.lit("b"), F.col("user_id").cast("string"), F.lit("a"), F.lit("1"))
    headers = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("B"), F.lit("2"), F.lit("A"), F.lit("1")))
    return t.events.select("event_id", S.request_fingerprint(F.col("event_type"), F.lit("GET"), params, headers).alias("fingerprint"))


@query("safe_name", "select page_id, replace(url, '/', '_') as name from pages")
def _(t):
    return t.pages.select("page_id", S.safe_name(F.col("url")).alias("name"))


TYPES = [("VARCHAR(20)", "string"), ("BIGINT", "integer"), ("DECIMAL(10,2)", "numeric"), ("BOOLEAN", "boolean"), ("TIMESTAMP", "datetime"), ("JSON", "json"), ("BLOB", "other")]


def typed_events(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.element_at(F.array(*(F.lit(x) for x, _ in TYPES)), (F.col("event_id") % 7 + 1).cast("int")).alias("kind"))


@query("type_category", f"select event_id, [{', '.join(repr(c) for _, c in TYPES)}][event_id % 7 + 1] as category from events")
def _(t):
    return typed_events(t).select("event_id", S.type_category(F.col("kind")).alias("category"))


@query("varchar_max_length", "select event_id, case when event_id % 7 = 0 then 20 end as n from events")
def _(t):
    return typed_events(t).select("event_id", S.varchar_length(F.col("kind")).alias("n"))


@query("semver_bump", "select event_id, case event_id % 4 when 0 then '2.0.0' when 1 then '1.' || (user_id + 1) || '.0' when 2 then '1.' || user_id || '.8' else '1.0.0' end as version from events")
def _(t):
    v = F.when(F.col("event_id") % 4 == 3, "bad").otherwise(F.concat_ws(".", F.lit("1"), F.col("user_id").cast("string"), F.lit("7")))
    level = F.element_at(F.array(F.lit("breaking"), F.lit("warning"), F.lit("safe"), F.lit("safe")), (F.col("event_id") % 4 + 1).cast("int"))
    return t.events.select("event_id", S.semver_bump(v, level).alias("version"))


@query("metric_defaults", "select event_id, coalesce(case when event_id % 17 <> 0 then value end, 0) as score, coalesce(case when event_id % 17 <> 0 then value end, 0) <> 0 as has_metrics from events")
def _(t):
    e = t.events.select("event_id", F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("score"))
    return M.with_defaults(e, {"score": 0.0})


@query("duration_seconds", "select user_id, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 2) as seconds from events group by 1")
def _(t):
    return states(t).select("user_id", S.duration_seconds(F.col("start_time"), F.col("end_time")).alias("seconds"))


@query("explode_entries", f"select '2-s2.0-' || o_orderkey as eid, 'scopus_20240101000000' as load_id from orders where o_orderkey in (select l_orderkey from lineitem) and o_custkey % 50 not in (48, 49)")
def _(t):
    schema = "metadata struct<load_id:string,data_source:string>, raw_response struct<`search-results`:struct<entry:array<struct<eid:string>>>>"
    p = R.scan_json(t.spark, landed(t), "*.txt").select(F.from_json("value", schema).alias("p"))
    return p.where("p.metadata.load_id is not null").select(F.explode(F.col("p.raw_response")["search-results"]["entry"]["eid"]).alias("eid"), F.col("p.metadata.load_id").alias("load_id"))


@query("explode_errors", f"select load_id, entity_id, array_to_string(list_sort(list(distinct page_number)), ',') as failed from ({PAGES_SQL}) where event_type = 'error' group by 1, 2")
def _(t):
    failed = M.failed_items(pages(t).where("event_type = 'error'"), ["load_id", "entity_id"], "page_number")
    return failed.select("load_id", "entity_id", F.array_join(F.col("failed").cast("array<string>"), ",").alias("failed"))


@query("array_append_distinct", "select user_id, string_agg(distinct event_type, ',' order by event_type) || case when max(case when event_type = 'view' then 1 else 0 end) = 0 then ',view' else '' end as types from events group by 1")
def _(t):
    a = t.events.groupBy("user_id").agg(F.sort_array(F.collect_set("event_type")).alias("a"))
    return a.select("user_id", F.array_join(S.append_distinct(F.col("a"), F.lit("view")), ",").alias("types"))


@query("map_upsert", "select event_id, event_type as old_value, 'new' as new_value, 2 as n from events where event_id % 2 = 0 union all select event_id, null, 'new', 1 from events where event_id % 2 = 1")
def _(t):
    m = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("a"), F.col("event_type"), F.lit("b"), F.lit("old"))).otherwise(F.create_map(F.lit("b"), F.lit("old")))
    u = S.map_upsert(F.col("m"), F.lit("b"), F.lit("new"))
    return t.events.select("event_id", m.alias("m")).select("event_id", F.try_element_at(u, F.lit("a")).alias("old_value"), F.try_element_at(u, F.lit("b")).alias("new_value"), F.size(u).alias("n"))


@query("restart_trim", f"select load_id, entity_id, entity_id % 5 as last_page, count(*) filter (page_number <= entity_id % 5) as files, count(distinct case when page_number <= entity_id % 5 then md5(props) end) as hashes, count(*) filter (event_type = 'error' and page_number <= entity_id % 5) as errors, false as completed from ({PAGES_SQL}) group by 1, 2")
def _(t):
    """Each entity restarts at its own page; what earlier pages left stays."""
    page, kept = F.col("page_number").alias("page"), lambda c: F.collect_list(c)
    s = pages(t).groupBy("load_id", "entity_id").agg(
        kept(F.struct(page, F.col("event_id").alias("file"))).alias("files"), kept(F.struct(page, F.md5(F.col("props").cast("binary")).alias("hash"))).alias("hashes"),
        kept(F.when(F.col("event_type") == "error", F.struct(page, F.col("props").alias("message")))).alias("errors"))
    s = M.trimmed(s, F.col("entity_id") % 5 + 1)
    different = F.array_distinct(F.transform("hashes", lambda x: x["hash"]))
    n = lambda c: F.size(c).cast("long")
    return s.select("load_id", "entity_id", "last_page", n("files").alias("files"), n(different).alias("hashes"), n("errors").alias("errors"), "completed")


@query("range_buffer", "select event_type, min(value) - (max(value) - min(value)) * 0.1 as low, max(value) + (max(value) - min(value)) * 0.1 as high, max(length(props)) + 5 as max_length from events group by 1")
def _(t):
    from lakeforge.operators.profile import range_buffer

    g = t.events.groupBy("event_type").agg(F.min("value").alias("a"), F.max("value").alias("b"), F.max(F.length("props")).alias("n"))
    low, high = range_buffer(F.col("a"), F.col("b"))
    return g.select("event_type", low.alias("low"), high.alias("high"), (F.col("n") + 5).cast("long").alias("max_length"))


@query("audit_enrich", f"select load_id, 'orders' as data_source, cast(strptime(load_id, '%Y%m%d') as timestamp) as ingest_timestamp, '{{\"n\":' || orders || '}}' as query_parameters, 1 as audit_schema_version, md5(load_id) as audit_schema_checksum, null::varchar as checksum_status, null::timestamp as checksum_timestamp, null::varchar as checksum_report, cast(orders as double) / 4 as ingestion_time, null::varchar as validation_status, null::varchar as validation_errors, null::varchar as validation_fails, null::varchar as validation_summary, null::varchar as dq_report, '[\"' || load_id || '.json\"]' as payload_files, null::varchar as payload_results, false as is_reprocessed, timestamp '2024-01-01' as original_processing_timestamp, null::varchar as reprocessing_reason from ({AUDIT})")
def _(t):
    return staging.enrich(staging.audit(manifests(t)), F.expr("timestamp_ntz '2024-01-01 00:00:00'"))


@query("entity_status", "select user_id, case when sum(case when event_type = 'error' then 1 else 0 end) > 0 then 'failed' else 'completed' end as status from events group by 1")
def _(t):
    from lakeforge.functions.predicates import error_is_critical

    critical = error_is_critical(F.when(F.col("event_type") == "error", F.lit("Rate limit hit")), F.lit(None).cast("string"))
    return t.events.groupBy("user_id").agg(F.when(F.bool_or(critical), "failed").otherwise("completed").alias("status"))
