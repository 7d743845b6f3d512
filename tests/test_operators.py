"""Edge cases and properties on small rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeforge.functions import predicates as P
from lakeforge.functions import scalars as S
from lakeforge.operators import dq, profile, registry
from lakeforge.operators.relational import chunked, fresh_lookup
from lakeforge.sources.files import scan_payload, scan_quarantine
from lakeforge.sources.sinks import insert_missing, report_names, upsert

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def test_payload_files_are_told_apart(spark, tmp_path):
    for name, text in {"a.json": '{"metadata": {"load_id": "x"}}', "b.json": "{oops", "c.json": '{"metadata": {}}', "x_manifest_1.json": "{}"}.items():
        (tmp_path / name).write_text(text)
    assert [r.file for r in scan_payload(spark, str(tmp_path)).collect()] == ["a.json"]
    assert {r.file: r.reason for r in scan_quarantine(spark, str(tmp_path)).collect()} == {"b.json": "malformed", "c.json": "no load_id"}


def test_content_hash_ignores_key_order_but_not_list_order(spark):
    rows = spark.createDataFrame([('{"a":1,"b":2}', '{"b": 2, "a": 1}', "[1,2]", "[2,1]")], "a string, b string, c string, d string")
    r = rows.select(*(S.content_hash(F.col(c)).alias(c) for c in "abcd")).first()
    assert r.a == r.b and r.c != r.d


def test_keywords(spark):
    rows = spark.createDataFrame([("a | b||",), (" ",), ("undefined",), (None,), ("||",)], "k string")
    assert [r[0] for r in rows.select(S.split_keywords(F.col("k"))).collect()] == [["a", "b"], None, None, None, None]


def test_responses(spark):
    # as the rules have it: a list under "results" is no place for items
    rows = spark.createDataFrame([('{"total": 2, "data": [1, 2], "response": 1}',), ('{"total": 3, "results": [1]}',), ("{}",), ("x",), (None,)], "s string")
    got = rows.select(P.response_complete(F.col("s"), "$.total"), P.response_empty(F.col("s")), P.response_structure(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [(True, False, True), (False, False, True), (False, True, False), (False, True, False), (False, True, False)]


def test_upsert_is_idempotent_and_may_set_null(spark):
    old = spark.createDataFrame([(1, "a", "s"), (2, "b", "s")], "k int, v string, src string")
    new = spark.createDataFrame([(2, None, "t"), (3, "c", "t")], "k int, v string, src string")
    once = upsert(old, new, ["k"], keep=["src"])
    twice = upsert(once, new, ["k"], keep=["src"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str) == [(1, "a", "s"), (2, None, "s"), (3, "c", "t")]
    assert insert_missing(once, new, ["k"]).count() == 0


@SLOW
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), st.text(max_size=3))), min_size=1, max_size=8))
def test_checksum_has_no_order(spark, rows):
    a = spark.createDataFrame(rows, "x int, y string")
    b = spark.createDataFrame(rows[::-1], "x int, y string").repartition(3)
    assert profile.compare_checksums(profile.table_checksum(a), profile.table_checksum(b)).first().verdict == "PASSED"


def test_checksum_marks_nulls(spark):
    a = spark.createDataFrame([("a", None, "b")], "x string, y string, z string")
    b = spark.createDataFrame([("a", "b", None)], "x string, y string, z string")
    assert profile.compare_checksums(profile.table_checksum(a), profile.table_checksum(b)).first().verdict == "FAILED"


def test_absent_column_is_an_error_and_stops_later_tiers(spark):
    df = spark.createDataFrame([(1,)], "x int")
    r = dq.run_checks(df, [dq.Check("critical", "gone", "missing_count", "nope", fail_high=0), dq.Check("quality", "ok", "row_count", fail_low=1)])
    assert {x.tier: x.status for x in dq.decision(r).collect()} == {"critical": "FAIL", "quality": "NOT_RUN", "monitoring": "NOT_RUN", "overall": "CRITICAL_FAIL"}


def test_schema_compared_with_itself_has_no_changes(spark):
    c = registry.catalogue(spark, {"t": spark.createDataFrame([(1, "a")], "x int, y string")})
    assert registry.compare(c, c).count() == 0


def test_strict_reference_outcomes(spark):
    old = registry.catalogue(spark, {"t": spark.createDataFrame([(1,)], "x int")})
    new = registry.catalogue(spark, {"t": spark.createDataFrame([(1,)], "x bigint")})
    level = lambda strict: registry.evaluate(registry.compare(old, new), registry.rules(spark), strict).first().level
    assert (level(False), level(True)) == ("safe", "breaking")


def test_chunks_are_full_and_in_order(spark):
    c = chunked(spark.range(103), "id").groupBy("chunk").agg(F.count("*").alias("n"), F.min("id").alias("low")).orderBy("chunk").collect()
    assert [(r.chunk, r.n, r.low) for r in c] == [(1, 25, 0), (2, 25, 25), (3, 25, 50), (4, 25, 75), (5, 3, 100)]


def test_cache_hit_within_ttl_only(spark):
    rows = lambda x, c: spark.createDataFrame(x, f"k string, s string, {c} int").withColumn("ts", F.col("s").cast("timestamp")).drop("s")
    req = rows([("a", "2024-01-01 00:10:00", 1), ("a", "2024-01-01 02:00:00", 2), ("b", "2024-01-01 00:10:00", 3)], "r")
    hit = fresh_lookup(req, rows([("a", "2024-01-01 00:00:00", 9)], "v"), ["k"], "ts", 3600, "v")
    assert {x.r: x.hit for x in hit.collect()} == {1: 9, 2: None, 3: None}


def test_landing_survives_restart_replay_and_empty_starts(spark, tmp_path):
    from lakeforge.streaming import streams as X

    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    put = lambda rows: spark.createDataFrame(rows, "k int, v string, seq int").coalesce(1).write.mode("append").parquet(source)
    start = lambda checkpoint=progress: {r.k: r.v for r in X.land(spark.readStream.schema("k int, v string, seq int").parquet(source), ["k"], out, checkpoint, order="seq").collect()}
    put([(1, "a", 1), (2, "b", 1), (2, "c", 2)])
    assert start() == {1: "a", 2: "c"}
    put([(2, "d", 3), (3, "e", 1)])
    assert start() == {1: "a", 2: "d", 3: "e"}  # a second start goes on from what is there
    assert start() == {1: "a", 2: "d", 3: "e"}  # a third one has nothing new
    assert start(str(tmp_path / "lost")) == {1: "a", 2: "d", 3: "e"}  # all read again


def test_bad_batches_are_set_aside(spark, tmp_path):
    from lakeforge.streaming import streams as X

    source, good, bad, progress = (str(tmp_path / n) for n in ("in", "good", "bad", "progress"))
    for rows in ([(1, "a"), (2, "b")], [(None, "c")]):
        spark.createDataFrame(rows, "k int, v string").coalesce(1).write.mode("append").parquet(source)
        X.gate(spark.readStream.schema("k int, v string").parquet(source), [dq.Check("critical", "keys", "missing_count", "k", fail_high=0)], good, bad, progress)
    assert spark.read.parquet(good).count() == 2 and [r.v for r in spark.read.parquet(bad).collect()] == ["c"]


def test_merges_take_one_update_for_each_key(spark):
    from lakeforge.sources import sinks

    target = spark.createDataFrame([(1, "old", 0), (2, "same", 0)], "k int, v string, seq int")
    new = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "z", 1), (None, "n", 1)], "k int, v string, seq int")
    assert sorted((r.k or 0, r.v) for r in sinks.upsert(target, new, ["k"], order="seq").collect()) == [(0, "n"), (1, "y"), (2, "same"), (3, "z")]
    assert sinks.insert_or_replace(target, new, ["k"]).where("k = 1").count() == 1
    once = sinks.insert_missing(target, new.where("k = 3 or k is null"), ["k"])
    assert [r.k for r in once.collect()] == [3]


def test_responses_as_the_rules_have_them(spark):
    from lakeforge.functions import predicates as P

    rows = [('{"search-results": {"opensearch:totalResults": "2", "entry": [1, 2]}}', True, False), ('{"search-results": {"opensearch:totalResults": "0", "entry": []}}', True, True), ('{"results": [1]}', False, False), ('{"results": {"count": 1, "items": [1]}}', False, False), ('{"results": {"totalCount": 0, "data": [1]}}', False, True), ('{"note": 1}', False, False), ("{}", False, True), ("[1]", False, True), ("oops", False, True), (None, False, True)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s string, complete boolean, empty boolean")
    for r in df.select("*", P.response_complete(F.col("s")).alias("c"), P.response_empty(F.col("s")).alias("e")).collect():
        assert (r.c, r.e) == (r.complete, r.empty), r.s


def test_checksum_tells_columns_apart(spark):
    sums = [profile.table_checksum(spark.createDataFrame([r], "x string, y string")).first() for r in (("a|b", "c"), ("a", "b|c"))]
    assert sums[0].hash_sum != sums[1].hash_sum


def test_usage_across_stretches_and_null_groups(spark):
    from lakeforge.operators.relational import usage

    at = [0, 5, 9, 10, 11, 19, 20, 30, 30, 41]
    rows = [(g, x) for g in ("a", None) for x in at]
    df = spark.createDataFrame(rows, "g string, t long").withColumn("ts", F.timestamp_seconds("t"))
    got = sorted((r.g or "", r.t, r.used, r.within) for r in usage(df, "g", "ts", 10, 3).collect())
    assert got == sorted((g or "", x, n := sum(x - 10 <= y <= x for y in at), n < 3) for g, x in rows)


def test_staging_tolerates_numbers_but_not_json(spark):
    from lakeforge.operators import staging

    e = spark.createDataFrame([("x", "12", "{\"b\":1,\"a\":2}"), ("y", "twelve", None)], "eid string, `citedby-count` string, author string")
    rows = {r["eid"]: r for r in staging.stage(e).collect()}
    assert len(rows["x"]) == 28 and rows["x"]["citations"] == 12 and rows["x"]["authors"] == '{"a":2,"b":1}'
    assert rows["y"]["citations"] is None and rows["y"]["authors"] is None and rows["y"]["title"] is None
    broken = spark.createDataFrame([("x", "{")], "eid string, author string")
    with pytest.raises(Exception, match="MALFORMED"):
        staging.stage(broken).collect()
    assert len(staging.audit(e).columns) == 9


def test_report_names_count_up_when_taken(spark):
    df = spark.sql("select * from values ('t', 'l', timestamp '2024-01-01 00:00:00', 1), ('t', 'l', timestamp '2024-01-01 00:00:00', 2), ('u', 'l', timestamp '2024-01-01 00:00:00', 3) as v(tab, load, at, i)")
    names = sorted(r["report"] for r in report_names(df, "tab", "load", "at").collect())
    assert names == ["t_l_20240101_000000", "t_l_20240101_000000_1", "u_l_20240101_000000"]


def test_unwrap_leaves_other_items(spark):
    df = spark.sql("""select parse_json('{"value":[{"$":1},"x",{"y":2}]}') as a, parse_json('{"other":1}') as b""")
    r = df.select(S.unwrap_value(F.col("a")).alias("a"), S.unwrap_value(F.col("b")).alias("b")).first()
    assert r["a"] == '[1,"x",{"y":2}]' and r["b"] == '{"other":1}'


def test_missing_rule_types_and_active_order(spark):
    t = spark.sql("select * from values ('add_column', true, 2), ('add_column', true, 1), ('remove_column', false, 3) as v(rule_type, is_active, created_at)")
    assert sorted(r["missing"] for r in registry.missing_types(t).collect()) == ["change_datatype", "change_nullable"]
    assert [r["created_at"] for r in registry.active_rules(t).collect()] == [1, 2]
    assert registry.active_rules(t, "remove_column").count() == 0


def test_checks_from_rows(spark):
    spec = spark.createDataFrame([("critical", "some", "row_count", None, None, 1.0, None, None, None)], dq.SPEC)
    assert dq.compiled(spec) == [dq.Check("critical", "some", "row_count", fail_low=1.0)]


def stamped(path, n):
    """Files of a folder get times in the order in which they were written."""
    import os

    files = sorted((f for f in os.scandir(path) if f.name.endswith(".parquet")), key=lambda f: f.stat().st_mtime_ns)
    os.utime(files[-1].path, (n, n))


def event_files(spark, path, batches):
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, "k string, s string").select("k", F.col("s").cast("timestamp_ntz").alias("ts")).coalesce(1).write.mode("append").parquet(path)
        stamped(path, 1_700_000_000 + n)
    return lambda X: X.events_stream(spark, path, spark.read.parquet(path).schema, files=1)


def test_windows_close_and_late_rows_are_dropped(spark, tmp_path):
    from lakeforge.streaming import streams as X

    days = [[("a", f"2024-01-{d:02d} 12:00:00"), ("b", f"2024-01-{d:02d} 13:00:00")] for d in range(1, 9)]
    days[4].append(("a", "2024-01-04 23:00:00"))  # a day late: its window is open
    days[6].append(("a", "2024-01-02 09:00:00"))  # its window was closed when the fourth of January came
    make = event_files(spark, str(tmp_path / "in"), days)
    s = X.tumbling(make(X), "k", "ts")
    query = X.finished(s.writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")))
    got = {(r.k, r.start.day): r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(k, d): 2 if (k, d) == ("a", 4) else 1 for k in "ab" for d in range(1, 7)}  # up to a day before the eighth
    progress = [p for p in query.recentProgress if p.numInputRows]
    assert len(progress) == 8 and sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress) == 1
    kept = [p.stateOperators[0].numRowsTotal for p in progress]
    assert max(kept) <= 8 and kept[-1] < 16  # windows that are closed leave the state
    out = X.run_to_end(X.sessions(make(X), "k", "ts"), str(tmp_path / "out2"), str(tmp_path / "c2"))
    assert out.count() == 14  # those of days 1 to 6, the one of a on day 7 and the row that was a day late
    used = X.run_to_end(X.usage_window(make(X), "k", "ts", 2, "3 days", "1 day"), str(tmp_path / "out3"), str(tmp_path / "c3"))
    assert {(r.start.day, r.used, r.over_limit) for r in used.where("k = 'b' and start >= '2024-01-01'").collect()} == {(d, 3, True) for d in range(1, 5)}


def test_duplicates_and_state_across_batches(spark, tmp_path):
    from lakeforge.streaming import streams as X

    make = event_files(spark, str(tmp_path / "in"), [[("a", "2024-01-01 00:00:00")], [("a", "2024-01-01 01:00:00"), ("b", "2024-01-01 02:00:00")], [("b", "2024-01-02 00:00:00")]])
    assert sorted(r.k for r in X.run_to_end(X.dedup_hash(make(X), "ts", ["k"], "2 days").select("k"), str(tmp_path / "o"), str(tmp_path / "c")).collect()) == ["a", "b"]
    seen = []
    states = X.entity_state(make(X), "k", F.lit(2), F.hour("ts") == 1, F.dayofmonth("ts") == 2)
    X.for_each_batch(states, lambda b, n: seen.extend((n, *r) for r in b.collect()), str(tmp_path / "c4"), "update")
    assert seen[0] == (0, "a", 1, 2, 0, False) and (1, "a", 2, 4, 1, False) in seen and seen[-1] == (2, "b", 2, 4, 0, True)


def test_landing_writes_touched_buckets_alone(spark, tmp_path):
    import os

    from lakeforge.streaming import streams as X

    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    start = lambda: X.land(spark.readStream.schema("k long, v string").parquet(source), ["k"], out, progress, buckets=16)
    spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v")).write.parquet(source)
    assert start().count() == 1000
    for n in range(1, 5):
        spark.createDataFrame([(7, f"v{n}"), (1000, "new")], "k long, v string").coalesce(1).write.mode("append").parquet(source)
        assert start().where("k = 7").first().v == f"v{n}" and start().count() == 1001
        assert len([x for x in os.listdir(f"{out}/data/{n}") if x.startswith("__bucket")]) <= 2
    assert X.versions(spark, out) == [3, 4] and not [x for x in os.listdir(f"{out}/data/1") if x.startswith("__bucket")]


def test_gate_takes_its_checks_from_the_write(spark, tmp_path):
    from lakeforge.streaming import streams as X

    source, good, bad, progress = (str(tmp_path / n) for n in ("in", "good", "bad", "progress"))
    spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, v string").coalesce(1).write.parquet(source)
    checks = [dq.Check("quality", "rows", "row_count", fail_low=1), dq.Check("quality", "keys", "missing_count", "k", warn_high=0), dq.Check("quality", "same", "duplicate_count", "k", fail_high=1)]
    said = X.gate(spark.readStream.schema("k int, v string").parquet(source), checks, good, bad, progress)
    again = {r.check_name: (r.value, r.outcome) for r in dq.run_checks(spark.read.parquet(source), checks).collect()}
    assert {f["check_name"]: (f["value"], f["outcome"]) for f in said} == again == {"rows": (4, "pass"), "keys": (1, "warn"), "same": (1, "pass")}
    assert spark.read.parquet(good).count() == 4


def test_appends_count_what_they_write(spark, tmp_path):
    from lakeforge.sources import sinks

    path = str(tmp_path / "t")
    target = sinks.reload(spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"), F.lit(None).cast("string").alias("w")), path)
    source = spark.range(50, 150).select(F.when(F.col("id") < 149, F.col("id")).alias("k"), F.lit("y").alias("v"))
    for want in ({"total": 100, "inserted": 49, "skipped": 50, "invalid": 1}, {"total": 100, "inserted": 0, "skipped": 99, "invalid": 1}):
        before = spark.read.parquet(path).count()
        assert sinks.append_missing(spark.read.parquet(path), source, ["k"], path) == want
        assert spark.read.parquet(path).count() - before == want["inserted"]
    assert target.count() == 100


def test_constrained_tables_stop_the_write(spark, tmp_path):
    import pytest
    from pyspark.errors import PySparkException

    from lakeforge.operators import staging

    rows = lambda *x: spark.createDataFrame([(i, 7) for i in x], "load_id string, audit_schema_version int")
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    good = staging.enrich(rows("a", "b").withColumn("audit_schema_hash_value", F.lit("h")), at)
    assert good.columns == [c for c, _ in staging.AUDIT_TABLE] and len(good.columns) == 20
    good.write.parquet(str(tmp_path / "ok"))
    one = spark.read.parquet(str(tmp_path / "ok")).where("load_id = 'a'").first()
    assert one.is_reprocessed is False and one.audit_schema_checksum == "h" and one.dq_report is None
    for bad, said in ((rows("a", None), "null in load_id"), (rows("a", "a"), "repeated key load_id")):
        with pytest.raises(PySparkException, match=said):
            staging.enrich(bad, at).write.parquet(str(tmp_path / said.replace(" ", "_")))
    assert len(staging.staged_table(spark.createDataFrame([("e",)], "eid string")).columns) == 35


def test_sources_that_fail_leave_the_others(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from lakeforge.operators import relational

    schema = StructType([StructField("id", LongType()), StructField("v", StringType())])
    sources = {"good": lambda: spark.createDataFrame([("1", "a"), ("2", None)], "id string, v string"), "text": lambda: spark.createDataFrame([("x",)], "id string"), "gone": lambda: spark.read.parquet(str(tmp_path / "no")), "more": lambda: spark.createDataFrame([(3,)], "id int")}
    rows, status = relational.union_isolated(sources, schema, str(tmp_path / "s"))
    assert sorted(map(tuple, rows.collect())) == [(1, "a", "good"), (2, None, "good"), (3, None, "more")]
    said = {r.source: (r.status, r.rows, r.error) for r in status.collect()}
    assert said["good"] == ("loaded", 2, None) and said["more"][:2] == ("loaded", 1) and said["gone"][0] == "failed" and "CAST_INVALID_INPUT" in said["text"][2]
    none, status = relational.union_isolated({"gone": sources["gone"]}, schema, str(tmp_path / "s2"))
    assert none.count() == 0 and none.columns == ["id", "v", "source"] and status.count() == 1


def test_dated_reads_prune_folders(spark, tmp_path):
    from lakeforge.sources import sinks

    path = str(tmp_path / "d")
    rows = spark.range(40).select("id", F.expr("timestamp_ntz '2024-01-01 06:00:00' + make_dt_interval(cast(id as int))").alias("ts"))
    sinks.write_dated(rows, "ts", path)
    some = sinks.read_range(spark, path, "ts", "2024-01-30", "2024-02-02 06:00:00")
    assert sorted(r.id for r in some.collect()) == [29, 30, 31]
    leaf = lambda df, name: int(df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().get(name).get().value())
    plan = some._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [" in plan.toString() and "yyyymm" in plan.toString().split("PartitionFilters")[1][:200]
    assert leaf(some.drop("none"), "numFiles") <= 4 if plan.getClass().getSimpleName() != "AdaptiveSparkPlanExec" else True
    days = spark.createDataFrame([(202401, 31), (202402, 1)], "yyyymm int, dd int")
    found = sinks.read_days(spark, path, days.where("dd > 0"))
    assert sorted(r.id for r in found.collect()) == [30, 31]


def test_usage_is_a_sweep(spark):
    import random

    from lakeforge.operators.relational import usage

    rng = random.Random(5)
    rows = [("hot", rng.randrange(900_000)) for _ in range(3000)] + [("cold", 5), ("cold", 605), ("cold", 606), (None, 5), (None, 6)] + [("hot", 17)] * 500
    log = spark.createDataFrame([(i, k, s) for i, (k, s) in enumerate(rows)], "i int, k string, s long").withColumn("ts", F.timestamp_seconds("s")).unionByName(spark.createDataFrame([(-1, "hot", None)], "i int, k string, s long").withColumn("ts", F.timestamp_seconds("s")))
    for stretch in (100, 86_400, 10**7):
        got = {r.i: r.used for r in usage(log, "k", "ts", 600, 3, stretch).collect()}
        assert got.pop(-1) == 1 and len(got) == len(rows)
        assert all(got[i] == sum(1 for g, u in rows if g == k and s - 600 <= u <= s) for i, (k, s) in list(enumerate(rows))[::37] + list(enumerate(rows))[3000:3006])


def test_fresh_lookup_splits_hot_keys(spark):
    import random

    rng = random.Random(6)
    cached = [("hot", rng.randrange(100_000), v) for v in range(400)] + [(None, 5, -1)]
    asked = [("hot", rng.randrange(101_000)) for _ in range(600)] + [(None, 6), ("cold", 7)]
    a = spark.createDataFrame([(i, *r) for i, r in enumerate(asked)], "i int, k string, s long").select("i", "k", F.timestamp_seconds("s").alias("ts"))
    b = spark.createDataFrame(cached, "k string, s long, v int").select("k", F.timestamp_seconds("s").alias("ts"), "v")
    hit = fresh_lookup(a, b, ["k"], "ts", 90, "v")
    for r in hit.select("i", "hit").collect():
        k, s = asked[r.i]
        fits = [(t, v) for g, t, v in cached if k is not None and g == k and s - 90 <= t < s]
        assert r.hit is None if not fits else r.hit in {v for t, v in fits if t == max(fits)[0]}
    assert "__stretch" in hit._jdf.queryExecution().optimizedPlan().toString()


def test_checksum_tree_reads_few_rows_again(spark, tmp_path):
    from lakeforge.operators import profile

    base = spark.range(20_000).select("id", F.concat(F.lit("v"), "id").alias("v"))
    changed = base.where("id not in (40, 12345)").withColumn("v", F.when(F.col("id").isin(*range(7000, 7006)), "x").otherwise(F.col("v"))).unionAll(spark.createDataFrame([(20_000, "n"), (None, "null")], "id long, v string"))
    for name, df in (("a", base), ("b", changed)):
        df.repartitionByRange(64, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    got = {(r.id, r.side) for r in profile.diff_by_range(a, b, "id").collect()}
    assert got == {(40, "source"), (12345, "source"), (20_000, "target"), (None, "target")} | {(i, "both") for i in range(7000, 7006)}
    near = a.where(profile.differing(a, b, "id")).select("id", "v")
    near.write.format("noop").mode("overwrite").save()
    inside = near.select(F.input_file_name().alias("f")).distinct().count()
    assert near.count() < 0.05 * 20_000 and inside <= 5
    assert profile.diff_by_range(a, a, "id").count() == 0 and profile.differing(a.limit(0), a.limit(0), "id") is None


def test_checks_may_warn_on_high_values(spark):
    spec = spark.createDataFrame([("monitoring", "high", "max", "id", None, None, None, None, 5.0)], dq.SPEC)
    assert dq.run_checks(spark.range(10), dq.compiled(spec)).first().outcome == "warn"


def test_older_rules_win_ties(spark):
    from lakeforge.operators import registry

    m = spark.createDataFrame([("t", "c", "add_column", "R2", "add_column", "any", "any", "any", 1), ("t", "c", "add_column", "R1", "add_column", "any", "any", "any", 2)], "table_name string, name string, change_type string, rule_id string, rule_type string, from_constraint string, to_constraint string, category string, created_at int")
    assert registry.best_rule(m).first().rule_id == "R2" and registry.best_rule(m.drop("created_at")).first().rule_id == "R1"


def test_manifest_operators_take_any_columns(spark):
    from lakeforge.operators import manifests as M

    e = spark.createDataFrame([("l1", "a", "completed", 3), ("l1", "b", "failed", 1), ("l2", "c", "partial", 2), (None, "d", None, None)], "load string, who string, state string, n int")
    got = {r.load: r for r in M.summary(e, ["load"], "state", "n").collect()}
    assert (got["l1"].entities, got["l1"].completed, got["l1"].failed, got["l1"].success_percent, got["l1"].pages_per_entity) == (2, 1, 1, 50.0, 2.0) and got[None].pages is None
    errors = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "x"), ("b", None)], "who string, why string")
    assert {r.who: r.error_list for r in M.with_error_list(e, errors, ["who"], "why").collect()} == {"a": ["x", "y"], "b": [], "c": [], "d": []}
    assert {r.error_type: (r.errors, r.entities) for r in M.error_types(errors, [], F.col("why"), "who").collect()} == {"x": (2, 1), "y": (1, 1), None: (1, 1)}
    plan = spark.createDataFrame([("a", 51), ("b", 0), ("c", None), ("d", 25)], "k string, found int")
    assert sorted(tuple(r) for r in M.page_plan(plan, ["k"], "found").collect()) == [("a", 1, 0), ("a", 2, 25), ("a", 3, 50), ("d", 1, 0)]
    files = spark.createDataFrame([("l", "b.json", 2048), ("l", "a.json", 100)], "l string, f string, b int")
    assert M.payload_files(files, ["l"], "f", "b").first().payload_files == '[{"file":"a.json","size_kb":0.1},{"file":"b.json","size_kb":2.0}]'
    pages = spark.createDataFrame([("a", 1, True), ("a", 3, False), ("a", 2, False)], "k string, p int, ok boolean")
    assert tuple(M.resume_points(pages, ["k"], "p", ~F.col("ok")).first()) == ("a", 4, 2)
    state = spark.createDataFrame([("a", [(1, "f1"), (2, "f2"), (3, "f3")], [(1, "h")], [(3, "bad")], 3, True), ("b", None, [], [], 0, False)], "k string, files array<struct<page:int,f:string>>, hashes array<struct<page:int,h:string>>, errors array<struct<page:int,m:string>>, last_page int, completed boolean")
    r = {x.k: x for x in M.trimmed(state, F.lit(3)).collect()}
    assert [f.f for f in r["a"].files] == ["f1", "f2"] and r["a"].errors == [] and r["a"].last_page == 2 and r["a"].completed is False and r["b"].files is None
    m = M.with_defaults(spark.createDataFrame([(1, None, None), (2, 3.0, None)], "k int, score double, cites double"), {"score": 0.0, "cites": 0.0})
    assert {x.k: (x.score, x.cites, x.has_metrics) for x in m.collect()} == {1: (0.0, 0.0, False), 2: (3.0, 0.0, True)}
    there = M.rows_exist(errors.select("who").distinct(), e, ["who"])
    assert {x.who: x.there for x in there.collect()} == {"a": True, "b": True}
    assert {x.k: x.ok for x in M.rows_intact(pages, ["k"], F.when(F.col("p") < 3, F.col("p"))).collect()} == {"a": False}
    run = M.run_statistics(spark.createDataFrame([("completed", 5, "2024-01-01 00:00:00", "2024-01-01 00:00:10"), ("failed", 0, "2024-01-01 00:00:00", None)], "status string, pages int, a string, b string").select("status", "pages", F.col("a").cast("timestamp").alias("start_time"), F.col("b").cast("timestamp").alias("end_time"))).first()
    assert tuple(run) == (2, 1, 1, 5, 10.0)


def test_profiles_from_sketches_of_loads(spark, tmp_path):
    from lakeforge.operators import profile

    rows = spark.range(50_000).select("id", (F.col("id") % 10).alias("load"), (F.col("id") % 7000).alias("n"), F.when(F.col("id") % 9 > 0, F.concat(F.lit("k"), F.col("id") % 4)).alias("kind"), F.lit(None).cast("string").alias("none"))
    path = str(tmp_path / "sketches")
    for half in (0, 1):  # stored load by load
        profile.sketches(rows.where(F.col("load") % 2 == half), by=["load"]).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 40
    got = {r.column_name: r for r in profile.from_sketches(profile.united(stored)).collect()}
    exact = {r.column_name: r for r in profile.basic(rows.drop("load")).collect()}
    for c, r in got.items():
        assert (r.total, r.null_count) == (exact[c].total, exact[c].null_count)
        assert abs(r.distinct_count - exact[c].distinct_count) <= 0.03 * exact[c].distinct_count
    assert got["kind"]["values"] == ["k0", "k1", "k2", "k3"] and got["id"]["values"] is None and got["none"]["values"] is None
    assert (got["n"].min_value, got["n"].max_value) == (0, 6999) and abs(got["n"].median - 3500) < 150 and abs(got["id"].median - 25_000) < 750 and got["kind"].median is None
    assert profile.from_sketches(profile.united(profile.sketches(rows.limit(0).drop("load")))).count() == 0


def test_suggested_sets_list_their_values(spark):
    from lakeforge.operators import profile

    found = profile.suggest_all(spark.createDataFrame([("b",), ("a",), (None,)], "c string")).where("expectation = 'in_set'").first()
    assert found.detail == '["a","b"]'


def test_arrow_table_function_equals_compare(spark):
    from lakeforge.operators import registry

    old = [("t", "a", "INTEGER", True, None, 1, "integer", None), ("t", "b", "VARCHAR(5)", False, "x", 2, "string", 5), ("t", "gone", "INTEGER", True, None, 3, "integer", None)]
    new = [("t", "b", "VARCHAR(9)", True, None, 1, "string", 9), ("t", "a", "INTEGER", True, None, 2, "integer", None), ("t", "more", "BOOL", True, None, 3, "boolean", None)]
    a, b = (spark.createDataFrame(x, registry.CATALOGUE) for x in (old, new))
    spark.udtf.register("expand_changes", registry.ExpandChanges)
    registry.paired(a, b).createOrReplaceTempView("pairs_tested")
    got = sorted(tuple(r) for r in spark.sql("select * from expand_changes(table(pairs_tested))").collect())
    assert got == sorted(tuple(r) for r in registry.compare(a, b).select("table_name", "name", "change_type").collect())
    assert {r[2] for r in got} == set(registry.KINDS)


def test_json_of_one_shape_is_cleaned_natively(spark):
    import json

    from lakeforge.functions import scalars as S

    texts = ['{"dc:title": "a", "x.y": 1, "afid": [{"$": "7", "@_fa": true}, {"$": "8", "@_fa": false}], "in": {"@_fa": 1, "authid": "é"}}', '{"afid": [], "in": {"authid": "2"}, "@_fa": "z"}', "no json", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, j string")
    native = df.select("i", S.clean_json_column(df, "j", ["@_fa"], S.RENAMES).alias("j"))
    assert "Python" not in native._jdf.queryExecution().executedPlan().toString()
    plain = lambda rows: {r.i: json.loads(r.j) if r.j and r.j[0] == "{" else r.j for r in rows}
    assert plain(native.collect()) == plain(df.select("i", S.clean_json(["@_fa"], S.RENAMES)("j").alias("j")).collect())
    mixed = spark.createDataFrame([(0, '{"a": 1, "b": 2}'), (1, '{"a": {"b": 1}}')], "i int, j string")
    both = mixed.select("i", S.clean_json_column(mixed, "j", ["b"]).alias("j"))
    assert "Python" in both._jdf.queryExecution().executedPlan().toString() and plain(both.collect()) == {0: {"a": 1}, 1: {"a": {}}}
    clash = spark.createDataFrame([(0, '{"a": 1, "b": 2}')], "i int, j string")
    assert plain(clash.select("i", S.clean_json_column(clash, "j", rename={"a": "b"}).alias("j")).collect()) == {0: {"b": 2}}


def test_native_json_equals_the_function_on_entries(spark):
    import json

    from conftest import SF

    from lakeforge.functions import scalars as S
    from lakeforge.plans.fixtures import entries
    from lakeforge.plans.registry import Tables

    e = entries(Tables(spark, SF)).select("eid", F.to_json(F.struct("eid", "`dc:title`", "authkeywords", "author", "author-count", "freetoreadLabel")).alias("j"))
    native = e.select("eid", S.clean_json_column(e, "j", ["@seq", "@limit"], {k: v for k, v in S.RENAMES.items() if k != "@seq"}).alias("j"))
    assert "Python" not in native._jdf.queryExecution().executedPlan().toString()
    udf = e.select("eid", S.clean_json(["@seq", "@limit"], {k: v for k, v in S.RENAMES.items() if k != "@seq"})("j").alias("j"))
    read = lambda df: {r.eid: json.loads(r.j) for r in df.collect()}
    got = read(native)
    assert len(got) > 100 and got == read(udf)


def test_versions_of_any_history(spark):
    from lakeforge.operators import versions as V

    rows = [("a", 1, "x", None), ("a", 5, "x", "p"), ("a", 12, None, "p"), ("a", 31, None, "q"), ("a", None, "z", "r"), (None, 3, "u", "s"), (None, 40, "w", "s"), ("b", None, "k", "t"), ("b", None, "k", "t")]
    h = spark.createDataFrame(rows, "tab string, nr int, hash string, note string")
    got = {(r.tab, r.nr): (r.previous, r.changed) for r in V.deltas(h, ["tab"], "nr", "hash", 10).collect()}
    assert got == {("a", 1): (None, True), ("a", 5): ("x", False), ("a", 12): ("x", True), ("a", 31): (None, False), ("a", None): (None, True), (None, 3): (None, True), (None, 40): ("u", True), ("b", None): (None, True)}
    assert V.deltas(h, ["tab"], "nr", "hash", 10).count() == len(rows) and V.deltas(h.where("nr < 0"), ["tab"], "nr", "hash").count() == 0
    assert {tuple(r) for r in V.current(h, ["tab"], ["nr"]).collect()} == {("a", 31, None, "q"), (None, 40, "w", "s"), ("b", None, "k", "t")}
    assert [r.nr for r in V.newest(h, ["nr"], 2, h.tab == "a").collect()] == [31, 12]
    assert {r.note for r in V.logged(h, spark.createDataFrame([("a", 7)], "tab string, version int"), "tab", ["version"]).collect()} == {None, "p", "q", "r"}


def test_deltas_split_hot_groups(spark):
    """All rows in one group, cut into stretches, get what one plain window gives."""
    from pyspark.sql import Window

    from lakeforge.operators import versions as V

    h = spark.range(20_000).select(F.lit("hot").alias("tab"), (F.col("id") * 7 % 20_011).alias("nr"), F.when(F.col("id") % 5 != 0, (F.col("id") % 3).cast("string")).alias("hash"))
    want = h.select("nr", F.lag("hash").over(Window.orderBy("nr")).alias("previous"))
    got = V.deltas(h, ["tab"], "nr", "hash", 1_000).select("nr", "previous")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_names_identifiers_citations_and_blanks(spark):
    from lakeforge.operators import dq
    from lakeforge.operators import versions as V

    col = lambda *v: spark.createDataFrame([(x,) for x in v], "c string")
    assert {tuple(r) for r in V.compared(col("a", "b", "b", None), col("b", "c"), "c").collect()} == {("a", "removed"), ("b", "common"), ("c", "added"), (None, "removed")}
    refs = spark.createDataFrame([(1, 10, 7), (2, 20, None), (3, 10, 8)], "src int, dst int, other int")
    assert {tuple(r) for r in V.identifiers(refs, {"d": "dst", "o": "other"}).collect()} == {("d", 10), ("d", 20), ("o", 7), ("o", 8)}
    items, kept = spark.createDataFrame([(10,), (20,), (30,)], "item int"), spark.createDataFrame([(1,), (3,)], "src int")
    assert [r.item for r in V.cited(items, "item", refs, "dst", kept, "src").collect()] == [10]
    b = spark.createDataFrame([(1, " x ", "y"), (2, None, " "), (3, "ok", None)], "k int, v string, w string")
    assert {tuple(r) for r in dq.whitespace_rows(b, ["k"], ["v", "w"]).collect()} == {(1, "v", 3, 1), (2, "w", 1, 0)}


def test_small_builders_on_nulls_and_odd_values(spark):
    from lakeforge.operators.relational import absent

    df = spark.createDataFrame([(1, ["a"], "b", '[1, 2]', "x/y z"), (2, None, "b", "{}", None), (3, ["b", "a"], "b", "oops", "/"), (4, ["a"], None, None, "p.q")], "k int, a array<string>, v string, j string, n string")
    got = df.select("k", S.append_distinct(F.col("a"), F.col("v")).alias("a"), S.json_items(F.col("j")).alias("j"), S.safe_name(F.col("n"), "/ .").alias("n")).orderBy("k").collect()
    assert [r.a for r in got] == [["a", "b"], ["b"], ["b", "a"], ["a"]] and [r.j for r in got] == [2, None, None, None] and [r.n for r in got] == ["x_y_z", None, "_", "p_q"]
    assert [r.a for r in S.nested_as_json(df, ["a"]).orderBy("k").collect()] == ['["a"]', None, '["b","a"]', '["a"]']
    m = spark.createDataFrame([('{"all_query_parameters": [1, "x"], "query_parameters": 2}',), ('{"query_parameters": {"q": 2}}',), ("{}",), ("oops",), (None,)], "m string")
    assert [r[0] for r in m.select(S.query_parameters(F.col("m"))).collect()] == ['[1,"x"]', '[{"q":2}]', "[]", "[]", "[]"]
    p = df.select(P.valid_regex(F.col("n"), "x|x/y z|/"), P.valid_values(F.col("v"), ["b"])).collect()
    assert [tuple(r) for r in p] == [(True, True), (None, True), (True, True), (False, None)]
    assert sorted(r.k for r in absent(df, df.where("k = 1"), ["v"]).collect()) == [4] and absent(df, df.limit(0), ["k"]).count() == 4


def test_stage_takes_nested_json(spark):
    """Nested parts give the text that their JSON gives when it is parsed; types whose numbers or keys parsing changes are parsed."""
    from lakeforge.operators import staging

    inner = "struct<b:string,`a$`:array<struct<z:int,`@y`:string>>,`Ü`:boolean,c:array<string>,d:bigint>"
    item = ('q"\\\n\x01é😀/', [(1, None), None, (None, "x")], True, ["v", None], 1 << 60)
    rows = [(item, [item, None], {"k": "v", "a": None}, [1.0, 2.5], '{"b":1,"a":[ ]}'), ((None,) * 5, [], {}, None, "null"), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, f"`author-count` {inner}, author array<{inner}>, affiliation map<string,string>, publication_keywords array<double>, open_access_status string")
    text = df.select(*(F.to_json(F.col(f"`{c}`")).alias(c) if c != "open_access_status" else F.col(c) for c in df.columns))
    assert staging.stage(df).collect() == staging.stage(text).collect()
    assert [staging.plain(f.dataType) for f in df.schema] == [True, True, False, False, True]
