"""Payloads, states, logs and audits as derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.plans.registry import Tables


def entries(t: Tables) -> DataFrame:
    """One nested publication-like entry for each order that has lines."""
    affiliation = F.array(F.struct(F.col("l_partkey").cast("string").alias("$")))
    author = F.struct(F.col("l_linenumber").cast("string").alias("@seq"), F.col("l_suppkey").cast("string").alias("authid"), F.col("l_returnflag").alias("given-name"), F.col("l_linestatus").alias("surname"), affiliation.alias("afid"))
    authors = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(author)).alias("author"))
    words = F.when(F.col("o_orderkey") % 7 == 0, "undefined").when(F.col("o_orderkey") % 5 == 0, " ").otherwise(F.concat(F.col("o_orderstatus"), F.lit(" |  "), F.col("o_orderpriority"), F.lit("||")))
    count = F.struct(F.lit("100").alias("@limit"), F.size("author").cast("string").alias("@total"), F.size("author").cast("string").alias("$"))
    label = F.struct(F.array(F.struct(F.col("o_orderstatus").alias("$"))).alias("value"))
    return t.orders.join(authors, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.concat(F.lit("2-s2.0-"), F.col("o_orderkey").cast("string")).alias("eid"), F.col("o_orderkey"), (F.col("o_custkey") % 50).alias("grp"), F.col("o_orderpriority").alias("dc:title"),
        F.col("o_orderkey").cast("string").alias("citedby-count"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("prism:coverDate"), words.alias("authkeywords"), "author", count.alias("author-count"), label.alias("freetoreadLabel"))


def payload_files(t: Tables, path: str) -> None:
    """One JSON file for each customer group, with a malformed one, one without load id, and a manifest."""
    e = entries(t)
    meta = F.struct(F.concat(F.lit("scopus_"), F.lit("20240101000000")).alias("load_id"), F.lit("scopus_search_api").alias("data_source"))
    inner = F.struct(F.size("entry").cast("string").alias("opensearch:totalResults"), F.col("entry"))
    body = e.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "eid", "dc:title", "citedby-count", "authkeywords"))).alias("entry"))
    text = F.to_json(F.struct(F.when(F.col("grp") != 49, meta).alias("metadata"), F.struct(inner.alias("search-results")).alias("raw_response")))
    broken = F.when(F.col("grp") == 48, F.substr(text, F.lit(1), F.lit(20))).otherwise(text)
    body.select("grp", broken.alias("value")).repartition("grp").write.mode("overwrite").partitionBy("grp").text(path)


def states(t: Tables) -> DataFrame:
    """Progress of each user: pages, errors, completed."""
    n = t.events.groupBy("user_id").agg(F.count("*").alias("pages"), F.count_if(F.col("event_type") == "error").alias("errors"), F.min("ts").alias("start_time"), F.max("ts").alias("end_time"))
    return n.withColumn("completed", F.col("user_id") % 3 != 0)


def pages(t: Tables) -> DataFrame:
    """Events as pages of (day, user): load_id, entity_id, page_number, event_id, ts, event_type, value, props."""
    from pyspark.sql import Window

    day = F.date_format("ts", "yyyyMMdd")
    w = Window.partitionBy("load_id", "user_id").orderBy("ts", "event_id")
    return t.events.withColumn("load_id", day).withColumn("page_number", F.row_number().over(w)).withColumnRenamed("user_id", "entity_id")


PAGES_SQL = "select strftime(ts, '%Y%m%d') as load_id, user_id as entity_id, row_number() over (partition by strftime(ts, '%Y%m%d'), user_id order by ts, event_id) as page_number, event_id, ts, event_type, value, props from events"
