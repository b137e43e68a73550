"""Versions by folder, rejects, drift, streaming upserts, incremental roll-ups,
bucketed joins, hot keys, profiles, restart and retention."""
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.operators import Enrichment, Lookup, enrich, lookup_keys, rollup_children
from starloom.operators.hot_keys import hot_keys, key_sketch, lookup_hot, merge_sketches
from starloom.operators.profile import merge_profiles, profiled_write
from starloom.operators.rollup_state import apply_delta, finish_rollup, merge_states, read_rollup, rollup_state
from starloom.plans import loads, racing
from starloom.sinks import versions
from starloom.sinks.buckets import bucket_count, write_bucketed
from starloom.sinks.drift import SchemaDrift, compare_schemas, fits, reconcile, widened_schema
from starloom.sinks.run_ledger import RunLedger
from starloom.sinks.versions import (
    append_version,
    current_version,
    read_current,
    read_version,
    reading,
    remove_superseded,
    replace_partitions,
    write_version,
)
from starloom.sources.landing import CONTROL_SCHEMA, Rejects, ingest, read_bronze, read_rejects
from starloom.streaming import newest_per_key, upsert_batch
from test_racing import TS, bronze, by  # noqa: F401 -- the racing fixture


def files_by(spark, base, by_col):
    out = {}
    for r in read_current(spark, base).select(by_col, F.col("_metadata.file_path").alias("f")).distinct().collect():
        out.setdefault(r[0], set()).add(r[1])
    return out


# -- versions


def test_only_the_named_partitions_change(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    write_version(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "n")], "p int, v string"),
                  base, partition_by="p")
    before = files_by(spark, base, "p")
    new = spark.createDataFrame([("B", 2)], "v string, p int")
    replace_partitions(new, base, "p", spark.createDataFrame([(2,), (3,), (9,)], "p int"))
    after = files_by(spark, base, "p")
    assert set(after) == {1, 2, None} and after[1] == before[1] and after[None] == before[None]
    assert not after[2] & before[2]
    assert sorted(read_current(spark, base).collect(), key=str) == sorted(
        spark.createDataFrame([(1, "a"), (1, "b"), (2, "B"), (None, "n")], "p int, v string").collect(), key=str)
    # the version before is as it was
    assert read_version(spark, base, 1).count() == 5
    # a row outside the named partitions raises, and nothing changes
    with pytest.raises(Exception, match="not replaced: p=7"):
        replace_partitions(spark.createDataFrame([(7, "x")], "p int, v string"), base, "p",
                           spark.createDataFrame([(2,)], "p int"))
    assert current_version(spark, base) == 2
    # the NULL partition can be named too, and a table may lose all rows
    replace_partitions(new.limit(0), base, "p", spark.createDataFrame([(1,), (2,), (None,)], "p int"))
    assert read_current(spark, base).columns == ["p", "v"] and read_current(spark, base).count() == 0


def test_partitioning_is_checked(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "p int, v string")
    with pytest.raises(ValueError, match="cannot replace"):
        write_version(df, f"{tmp_dir}/t", partition_by="v")
    write_version(df, f"{tmp_dir}/t")
    with pytest.raises(ValueError, match="not partitioned"):
        replace_partitions(df, f"{tmp_dir}/t", "p")
    write_version(df, f"{tmp_dir}/u", partition_by="p")
    with pytest.raises(ValueError, match="partitioned"):
        append_version(df, f"{tmp_dir}/u")


def test_an_append_writes_new_rows_only(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    append_version(spark.createDataFrame([(1, "a")], "k int, v string"), base)
    before = {r.file for r in versions.current_files(spark, base).collect()}
    append_version(spark.createDataFrame([("b", 2)], "v string, k int"), base)
    after = {r.file for r in versions.current_files(spark, base).collect()}
    assert before < after and len(after) == len(before) + 1
    assert sorted(tuple(r) for r in read_current(spark, base).collect()) == [(1, "a"), (2, "b")]
    assert read_version(spark, base, 1).count() == 1


def test_versions_do_not_follow_the_clock(spark, tmp_dir, monkeypatch):
    df = spark.createDataFrame([(1,)], "k int")
    write_version(df, f"{tmp_dir}/t")
    monkeypatch.setattr(versions.time, "time_ns", lambda: 5)  # a clock long past
    write_version(df.union(df), f"{tmp_dir}/t")
    assert read_current(spark, f"{tmp_dir}/t").count() == 2


def test_retention_spares_readers_and_shared_folders(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    one = spark.createDataFrame([(1,)], "k int")
    write_version(one, base)
    append_version(one, base)           # version 2 shares version 1's folder
    with reading(spark, base) as held:
        for _ in range(3):
            write_version(one, base)    # 3 to 5
        gone = remove_superseded(spark, base, keep=1)
        assert len(gone) == 2 and held.count() == 2
    assert remove_superseded(spark, base, keep=1, older_than_seconds=3600) == []
    assert len(remove_superseded(spark, base, keep=1)) == 2
    assert read_current(spark, base).count() == 1
    with pytest.raises(Exception):
        read_version(spark, base, 2).count()
    with pytest.raises(ValueError):
        remove_superseded(spark, base, keep=0)


def test_folders_of_failed_writes_go(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    write_version(spark.createDataFrame([(1, "a")], "p int, v string"), base, partition_by="p")
    bad = spark.createDataFrame([(9, "x")], "p int, v string")
    with pytest.raises(Exception, match="not replaced"):
        replace_partitions(bad, base, "p", spark.createDataFrame([(1,)], "p int"))
    write_version(bad, f"{base}/data/_version=99-lost")  # what a writer that died leaves
    assert remove_superseded(spark, base, keep=1, unlogged_after_seconds=3600) == []
    gone = remove_superseded(spark, base, keep=1, unlogged_after_seconds=0)
    assert any("99-lost" in g for g in gone) and read_current(spark, base).count() == 1


# -- the racing job


def test_reload_writes_only_its_races(spark, bronze, tmp_dir):  # noqa: F811
    store = f"{tmp_dir}/silver"
    first = racing.run_all(bronze, load_ts=TS, store=store)
    base = f"{store}/fact_race_result"
    before, dates = files_by(spark, base, "src_race_id"), versions.current_files(spark, f"{store}/dim_date").collect()
    keys = {r["src_result_id"]: r["result_key"] for r in first["fact_race_result"].collect()}
    # result 1 moves from race 18 to race 19; 2 stays in 18
    moved = dict(bronze)
    moved["results"] = bronze["results"].withColumn(
        "raceId", F.when(F.col("resultId") == 1, 19).otherwise(F.col("raceId")))
    moved["results"] = moved["results"].where("resultId <> 3")
    fact = racing.run_all(moved, load_ts=TS, store=store, race_ids=[19])["fact_race_result"]
    rows = fact.collect()
    assert sorted((r["src_result_id"], r["src_race_id"], r["result_key"]) for r in rows) == [
        (1, 19, keys[1]), (2, 18, keys[2])]
    # the calendar got no new folder with rows, and a reload of race 18 leaves race 19's files
    assert set(versions.current_files(spark, f"{store}/dim_date").collect()) == set(dates)
    before = files_by(spark, base, "src_race_id")
    racing.run_all(moved, load_ts=TS, store=store, race_ids=[18])
    after = files_by(spark, base, "src_race_id")
    assert after[19] == before[19] and not after[18] & before[18]


def test_a_failed_job_runs_only_what_is_missing(spark, bronze, tmp_dir):  # noqa: F811
    store, told = f"{tmp_dir}/silver", {t: 1 for t in bronze}
    broken = dict(bronze, status=bronze["status"].union(bronze["status"]))
    ledger = RunLedger(spark, f"{store}/_runs", store)
    with pytest.raises(Exception, match="duplicate key"):
        racing.run_all(broken, load_ts=TS, store=store, input_versions=told, ledger=ledger)
    assert sorted(ledger.ran) == ["dim_circuit", "dim_constructor", "dim_date", "dim_driver", "dim_race"]
    dims = {d: current_version(spark, f"{store}/{d}") for d in ledger.ran}
    again = RunLedger(spark, f"{store}/_runs", store)
    out = racing.run_all(bronze, load_ts=TS, store=store, input_versions={**told, "status": 2}, ledger=again)
    assert sorted(again.skipped) == sorted(dims) and again.ran == ["fact_race_result", "race_date_quarantine"]
    assert {d: current_version(spark, f"{store}/{d}") for d in dims} == dims
    assert set(by(out["fact_race_result"], "src_result_id")) == {1, 2, 3}
    # a new circuits delivery: what reads it runs, directly or through the race
    third = RunLedger(spark, f"{store}/_runs", store)
    racing.run_all(bronze, load_ts=TS, store=store, input_versions={**told, "status": 2, "circuits": 2}, ledger=third)
    assert third.ran == ["dim_circuit", "dim_race", "fact_race_result"]


def test_created_tables_are_the_ones_that_are_loaded(spark, bronze, tmp_dir):  # noqa: F811
    store = f"{tmp_dir}/silver"
    racing.create_silver_tables(spark, store)
    out = racing.run_all(bronze, load_ts=TS, store=store)
    assert out["dim_driver"].count() == 3 and current_version(spark, f"{store}/dim_driver") == 2
    assert set(by(out["fact_race_result"], "src_result_id")) == {1, 2, 3}


# -- rejects


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.mark.parametrize("bronze_kind", ["path", "catalog"])
def test_bad_lines_go_to_the_reject_table(spark, tmp_dir, bronze_kind):
    target = f"{tmp_dir}/bronze" if bronze_kind == "path" else "bronze_rejects_test"
    control = spark.createDataFrame([("t", "csv", "t", ","), ("u", "csv", "u", ",")], CONTROL_SCHEMA)
    schemas = {"t": StructType.fromDDL("a int, b string"), "u": StructType.fromDDL("a int")}
    # the column c is not read, yet a line without it is a bad one
    _write(f"{tmp_dir}/landing/t.csv", "b,c,a\nx,1,1\ny,1,two\nz\nw,1,4,9\nv,,5\n")
    _write(f"{tmp_dir}/landing/u.csv", "a\n1\nx\ny\n")
    rejects = Rejects(f"{tmp_dir}/rejects", max_rows=3, max_share=0.6)
    res = ingest(spark, control, f"{tmp_dir}/landing", target, schemas=schemas, rejects=rejects)
    assert res.loaded == ["t.csv"] and res.failed == ["u.csv"]
    t = read_bronze(spark, target, "t")
    assert t.columns == ["a", "b"] and sorted(map(tuple, t.collect())) == [(1, "x"), (5, "v")]
    bad = read_rejects(spark, rejects).collect()
    assert sorted((r.target_table, r.line) for r in bad) == [
        ("t", "w,1,4,9"), ("t", "y,1,two"), ("t", "z"), ("u", "x"), ("u", "y")]
    assert all(r.file_path.endswith(f"{r.target_table}.csv") for r in bad)
    audit = by(res.audit, "file_name")
    assert (audit["t.csv"]["rows_loaded"], audit["t.csv"]["detail"]) == (2, "3 lines rejected")
    assert "2 of 3 lines rejected" in audit["u.csv"]["detail"] and read_bronze(spark, target, "u") is None
    # a delivery with too many bad lines leaves the table as it was; one without good lines empties it
    _write(f"{tmp_dir}/landing/t.csv", "b,c,a\n" + "z\n" * 4)
    assert ingest(spark, control, f"{tmp_dir}/landing", target, schemas=schemas, rejects=rejects).loaded == []
    assert read_bronze(spark, target, "t").count() == 2
    lax = Rejects(f"{tmp_dir}/rejects")
    assert "t.csv" in ingest(spark, control, f"{tmp_dir}/landing", target, schemas=schemas, rejects=lax).loaded
    assert read_bronze(spark, target, "t").count() == 0


def test_a_catalog_table_is_replaced_whole_or_not_at_all(spark):
    from starloom.sinks.storage import ensure_database, replace_table
    ensure_database(spark, "replace_test")
    replace_table(spark.createDataFrame([(1,)], "a int"), "replace_test.t")
    replace_table(spark.table("replace_test.t").selectExpr("a + 1 AS a", "'x' AS b"), "replace_test.t")  # reads itself
    assert [tuple(r) for r in spark.table("replace_test.t").collect()] == [(2, "x")]
    with pytest.raises(Exception):
        replace_table(spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("a")), "replace_test.t")
    assert spark.table("replace_test.t").count() == 1 and not spark.catalog.tableExists("replace_test.t__next")


def test_the_job_with_rejects_and_retention(spark, bronze, tmp_dir):  # noqa: F811
    from starloom.sinks.storage import export
    for name, df in bronze.items():
        export(df, f"{tmp_dir}/landing/{name}.csv")
    _write(f"{tmp_dir}/landing/status.csv/part-extra.csv", "statusId,status\nx,Broken\n")
    control = spark.createDataFrame([(n, "csv", n, ",") for n in bronze], CONTROL_SCHEMA)
    rejects = Rejects(f"{tmp_dir}/rejects", max_rows=1)
    args = (control, f"{tmp_dir}/landing", f"{tmp_dir}/bronze", f"{tmp_dir}/silver")
    res, out = racing.run_from_landing(spark, *args, load_ts=TS, rejects=rejects, allow_drift=("added",), keep_versions=1)
    assert not res.failed and [r.line for r in read_rejects(spark, rejects).collect()] == ["x,Broken"]
    assert set(by(out["fact_race_result"], "src_result_id")) == {1, 2, 3}
    # without a reject table that line stops the job before silver
    before = current_version(spark, f"{tmp_dir}/silver/dim_driver")
    _write(f"{tmp_dir}/landing/status.csv/part-extra.csv", "statusId,status\ny,Broken\n")
    with pytest.raises(racing.SourcesFailed):
        racing.run_from_landing(spark, *args, load_ts=TS)
    assert current_version(spark, f"{tmp_dir}/silver/dim_driver") == before


# -- drift


def test_what_fits():
    def t(ddl):
        return StructType.fromDDL(f"c {ddl}").fields[0].dataType

    for narrow, wide in [("tinyint", "int"), ("int", "bigint"), ("int", "decimal(10,0)"), ("decimal(9,2)", "decimal(12,4)"),
                         ("int", "double"), ("float", "double"), ("date", "timestamp"), ("string", "string")]:
        assert fits(t(narrow), t(wide)) and (narrow == wide or not fits(t(wide), t(narrow)))
    for a, b in [("bigint", "double"), ("int", "decimal(9,0)"), ("decimal(9,2)", "decimal(10,4)"), ("int", "string")]:
        assert not fits(t(a), t(b))


def test_reconcile_shapes_or_refuses(spark):
    stored = StructType.fromDDL("Id int, amount decimal(9,2), gone string, day date")
    landed = spark.createDataFrame([(5, 7, 1, "n")], "id bigint, day int, amount int, fresh string").withColumn(
        "day", F.lit("2020-01-02").cast("date"))
    kinds = {c.column: c.kind for c in compare_schemas(stored, landed.schema)}
    assert kinds == {"Id": "widened", "amount": "incompatible", "fresh": "added", "gone": "missing"}
    ok = landed.withColumn("amount", F.lit(1).cast("smallint"))
    with pytest.raises(SchemaDrift, match="gone missing"):
        reconcile(ok, stored)
    out, changes = reconcile(ok, stored, ("added", "widened", "narrower", "missing"))
    assert out.dtypes == [("Id", "bigint"), ("amount", "decimal(9,2)"), ("gone", "string"), ("day", "date"),
                          ("fresh", "string")]
    assert len(changes) == 4 and out.first()["gone"] is None
    with pytest.raises(SchemaDrift, match=r"amount incompatible \(decimal\(9,2\) to int\)"):
        reconcile(landed, stored, ("added", "widened", "narrower", "missing"))
    assert widened_schema(stored, ok.schema).simpleString() == (
        "struct<Id:bigint,amount:decimal(9,2),gone:string,day:date,fresh:string>")


# -- streaming upsert


def test_a_replayed_batch_changes_nothing(spark, tmp_dir):
    base, target = f"{tmp_dir}/d", StructType.fromDDL("key bigint, k int, v string, dw_updated_at timestamp_ntz")
    args = dict(surrogate_key="key", insert_stamp_col=None, load_ts=TS)

    def batch(*rows):
        return spark.createDataFrame(rows, "k int, v string, at int")

    assert upsert_batch(batch((1, "a", 1), (1, "b", 2), (None, "x", 1), (2, None, 1)), 0, base, ["k"], target,
                        order_by=["at"], **args)
    assert upsert_batch(batch((1, "c", 3), (3, "d", 3)), 1, base, ["k"], target, order_by=["at"], **args)
    one = sorted(map(tuple, read_current(spark, base).select("key", "k", "v").collect()))
    assert one == [(1, 1, "c"), (2, 2, None), (3, 3, "d")]
    for i in (0, 1):
        assert not upsert_batch(batch((1, "z", 9), (9, "z", 9)), i, base, ["k"], target, order_by=["at"], **args)
    assert sorted(map(tuple, read_current(spark, base).select("key", "k", "v").collect())) == one
    assert current_version(spark, base) == 2
    # another stream counts its own batches; an empty batch makes no version
    assert upsert_batch(batch((4, "e", 1)), 0, base, ["k"], target, stream="other", order_by=["at"], **args)
    assert not upsert_batch(batch((4, "e", 1)).limit(0), 7, base, ["k"], target, **args)
    assert current_version(spark, base) == 3


def test_newest_row_of_a_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (1, "z", 0), (2, None, None)], "k int, v string, at int")
    got = newest_per_key(df, ["k"], ["at"])
    assert got.columns == df.columns and sorted(map(tuple, got.collect()), key=str) == [(1, "b", 1), (2, None, None)]


# -- incremental roll-up


def test_random_deltas_equal_the_full_rollup(spark, tmp_dir):
    rnd = random.Random(8)
    keys, layout = ["a", "b"], "a int, b int, v int, gone boolean"
    live, names = [], dict(count_name="n", sum_name="s", avg_name="m")
    for step in range(4):
        new = [(rnd.randint(0, 9), rnd.randint(0, 2), rnd.choice([None, rnd.randint(-50, 50)])) for _ in range(40)]
        gone = rnd.sample(live, len(live) // 3)
        delta = spark.createDataFrame([(*r, False) for r in new] + [(*r, True) for r in gone], layout)
        for r in gone:
            live.remove(r)
        live += new
        state = rollup_state(delta, keys, "v", bucket=F.col("a"), withdrawn=F.col("gone"))
        assert apply_delta(spark, f"{tmp_dir}/state", state, keys, f"step {step}")
        assert not apply_delta(spark, f"{tmp_dir}/state", state, keys, f"step {step}")
        full = rollup_children(spark.createDataFrame(live, "a int, b int, v int"), keys, "v", count_name="n",
                               sum_name="s", sum_type="bigint", avg_name="m")
        got = read_rollup(spark, f"{tmp_dir}/state", keys, **names)
        assert sorted(map(str, got.collect())) == sorted(map(str, full.collect()))


def test_a_delta_rewrites_its_buckets_only(spark, tmp_dir):
    base, keys = f"{tmp_dir}/state", ["a"]

    def state(*rows):
        return rollup_state(spark.createDataFrame(rows, "a int, v int"), keys, "v", bucket=F.col("a"))

    apply_delta(spark, base, state((1, 1), (2, 2), (3, 3)), keys)
    before = files_by(spark, base, "_bucket")
    apply_delta(spark, base, state((2, 5)), keys)
    after = files_by(spark, base, "_bucket")
    assert after[1] == before[1] and after[3] == before[3] and not after[2] & before[2]
    both = merge_states(state((7, 1)), state((7, None)), keys)
    assert finish_rollup(both, keys).first()[1:3] == (2, 1)


# -- bucketed joins


def test_bucketed_joins_need_no_exchange(spark, distributed_paths, capsys):
    loads.bucketed_enrichment(spark, "/root/testdata/sf0.001").explain("formatted")
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_bucketed_tables_have_a_file_per_bucket(spark, tmp_dir):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    t = write_bucketed(df, "bucket_test", ["k"], 4, f"{tmp_dir}/b")
    assert t.count() == 1000 and len([f for f in os.listdir(f"{tmp_dir}/b") if f.endswith(".parquet")]) == 4
    out = enrich(t, [Enrichment(t.select("k", F.col("v").alias("w")), {"k": "k"}, {"w": "w"})])
    assert out.where("w = v").count() == 1000
    assert bucket_count(spark, 0) == 8 and bucket_count(spark, 100 << 30) == 512


def test_buckets_follow_the_number_of_lines(spark, tmp_dir, distributed_paths, monkeypatch):
    monkeypatch.setattr(loads, "BUCKET_BYTES", 100 * 64, raising=False)  # a hundred lines
    for n in (1000, 10000):
        (spark.range(n).selectExpr("id div 4 AS l_orderkey", "id % 3 AS l_suppkey", "int(id % 4) AS l_linenumber",
                                   "if(id % 5 = 0, 'R', 'N') AS l_returnflag", "double(id % 50) AS l_quantity",
                                   "id % 10 / 100 AS l_discount").write.parquet(f"{tmp_dir}/{n}/lineitem.parquet"))
        got = loads.bucketed_enrichment(spark, f"{tmp_dir}/{n}")
        # each join, sort and roll-up of a task holds one bucket
        tasks = got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum("kept_lines").alias("kept"),
                                                        F.sum("cut_lines").alias("cut"))
        most, *sums = tasks.agg(F.max("n"), F.sum("n"), F.sum("kept"), F.sum("cut")).first()
        supplier = [(i // 4, i % 3) for i in range(n)]
        kept = Counter(k for i, k in enumerate(supplier) if i % 5)
        cut = Counter(k for i, k in enumerate(supplier) if i % 10 >= 5)
        assert most < 200 and sums == [n, sum(kept[k] for k in supplier), sum(cut[k] for k in supplier)]


def test_a_table_has_no_more_buckets_than_the_session_allows(spark):
    assert bucket_count(spark, 100 << 40) == 65536
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "100")
    try:
        assert bucket_count(spark, 100 << 30) == 64
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")


# -- hot keys


def test_hot_keys_meet_by_broadcast_and_rows_stay_whole(spark, distributed_paths, capsys):
    fact = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, None)
                                    .otherwise(F.col("id") % 900).cast("int").alias("k"))
    dim = spark.range(800).select(F.col("id").cast("int").alias("dk"), F.concat(F.lit("n"), "id").alias("name"))
    lookup = Lookup(dim, {"k": "dk"}, {"name": "name"})
    assert hot_keys(key_sketch(fact, "k"), share=0.2) == [7]
    got = lookup_hot(fact, lookup, [7])
    want = lookup_keys(fact, [lookup])
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    got.explain("formatted")
    assert "BroadcastHashJoin" in capsys.readouterr().out
    assert sorted(map(str, lookup_hot(fact, lookup).collect())) == sorted(map(str, want.collect()))
    with pytest.raises(Exception, match="duplicate key"):
        lookup_hot(fact, Lookup(dim.union(dim), {"k": "dk"}, {"name": "name"}), [7]).collect()


def test_sketches_of_loads_merge(spark):
    one, two, none = (key_sketch(spark.range(n).select((F.col("id") % m).alias("k")), "k")
                      for n, m in ((1000, 1), (3000, 1500), (0, 1)))
    both = merge_sketches(one.unionByName(two).unionByName(none))
    assert both.first()["n"] == 4000 and hot_keys(both, share=0.2) == [0]
    assert hot_keys(none) == []
    assert lookup_hot(spark.createDataFrame([], "k long"),
                      Lookup(spark.range(3), {"k": "id"}, {})).collect() == []


# -- profiles


def test_profiles_are_measured_by_the_write(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", [1]), (2, None, [1]), (2, "b", None)], "k int, `odd name` string, l array<int>")
    other = spark.createDataFrame([(3, "c", [2])], df.schema)
    parts = [profiled_write(d, n, lambda x, n=n: x.write.parquet(f"{tmp_dir}/{n}")) for n, d in (("x", df), ("y", other))]
    got = by(merge_profiles(parts[0].unionByName(parts[1])), "column")
    assert {c: (r.loads, r.rows, r.nulls, r.distinct_estimate) for c, r in got.items()} == {
        "k": (2, 4, 0, 3), "odd name": (2, 4, 1, 3), "l": (2, 4, 1, 2)}
    assert spark.read.parquet(f"{tmp_dir}/x").count() == 3
    empty = profiled_write(df.limit(0), "e", lambda x: x.write.parquet(f"{tmp_dir}/e"))
    assert {r.rows for r in empty.collect()} == {0}
