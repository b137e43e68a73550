"""Config-driven ingestion, ledger, versioned tables, truncate, export."""
import os

import pytest

from pyspark.sql import functions as F

from starloom.sinks.storage import (
    export,
    project_to_schema,
    truncate,
)
from starloom.sinks.versions import read_current, write_version
from starloom.sources.landing import CONTROL_SCHEMA, ingest, list_landing


def _land(spark, landing):
    os.makedirs(landing, exist_ok=True)
    with open(f"{landing}/Circuits.CSV", "w") as f:
        f.write("circuitId|name\n1|Albert Park\n2|Sepang\n")
    with open(f"{landing}/status.csv", "w") as f:
        f.write("statusId,status\n1,Finished\n11,+1 Lap\n")
    with open(f"{landing}/broken.csv", "w") as f:
        f.write("a,b\n1,2,3,4\n\"unterminated\n")
    spark.range(3).withColumnRenamed("id", "k").coalesce(1).write.option("header", "true") \
        .csv(f"{landing}/parts.csv")


CONTROL = [
    ("circuits", "csv", "circuits", "|"),
    ("STATUS", "csv", "status", ","),
    ("seasons", "csv", "seasons", ","),
    ("broken", "csv", "broken", ","),
    ("parts", "csv", "parts", ","),
]


def test_listing_names_entries(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    _land(spark, landing)
    names = {r["expected"]: r["entry"] for r in list_landing(spark, landing).collect()}
    assert names["circuits.csv"] == "Circuits.CSV" and "parts.csv" in names
    assert list_landing(spark, f"{tmp_dir}/missing").count() == 0


def test_ingest_run_skip_and_redelivery(spark, tmp_dir):
    landing, bronze, ledger = f"{tmp_dir}/landing", f"{tmp_dir}/bronze", f"{tmp_dir}/ledger"
    _land(spark, landing)
    control = spark.createDataFrame(CONTROL, CONTROL_SCHEMA)
    from pyspark.sql.types import StructType
    schemas = {"broken": StructType.fromDDL("a int, b int")}
    r1 = ingest(spark, control, landing, bronze, ledger=ledger, schemas=schemas)
    audit = {r["file_name"]: r for r in r1.audit.collect()}
    assert audit["circuits.csv"]["status"] == "loaded" and audit["circuits.csv"]["rows_loaded"] == 2
    assert audit["status.csv"]["columns"] == 2
    assert audit["seasons.csv"]["status"] == "skipped" and audit["seasons.csv"]["detail"] == "no file"
    assert audit["broken.csv"]["status"] == "failed"          # isolated, others still loaded
    assert audit["parts.csv"]["rows_loaded"] == 3
    c = read_current(spark, f"{bronze}/circuits")
    assert c.columns == ["circuitId", "name"] and dict(c.dtypes)["circuitId"] == "int"

    r2 = ingest(spark, control, landing, bronze, ledger=ledger, schemas=schemas)
    audit2 = {r["file_name"]: (r["status"], r["detail"]) for r in r2.audit.collect()}
    assert audit2["circuits.csv"] == ("skipped", "already loaded")
    assert audit2["broken.csv"][0] == "failed"               # failures are retried

    with open(f"{landing}/status.csv", "a") as f:               # re-delivered file
        f.write("12,+2 Laps\n")
    r3 = ingest(spark, control, landing, bronze, ledger=ledger, schemas=schemas)
    audit3 = {r["file_name"]: r for r in r3.audit.collect()}
    assert audit3["status.csv"]["status"] == "loaded" and audit3["status.csv"]["rows_loaded"] == 3
    assert audit3["circuits.csv"]["status"] == "skipped"


def test_versions_truncate_and_projection(spark, tmp_dir):
    base = f"{tmp_dir}/tbl"
    v1 = spark.createDataFrame([(1, "a")], "k int, v string")
    write_version(v1, base)
    cur = read_current(spark, base)
    # a new version computed from the current one: never overwrites what it reads
    write_version(cur.union(spark.createDataFrame([(2, "b")], cur.schema)), base)
    assert sorted(r["k"] for r in read_current(spark, base).collect()) == [1, 2]

    path = f"{tmp_dir}/plain"
    v1.write.parquet(path)
    truncate(spark, path)
    t = spark.read.parquet(path)
    assert t.count() == 0 and t.columns == ["k", "v"]

    from pyspark.sql.types import StructType
    full = StructType.fromDDL("id bigint, k int, v string, extra date")
    p = project_to_schema(v1, full)
    assert p.columns == ["id", "k", "v", "extra"] and p.first()["id"] is None


def test_export_writes_a_file_per_task(spark, tmp_dir):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).repartition(4)
    export(df, f"{tmp_dir}/out")
    assert len([f for f in os.listdir(f"{tmp_dir}/out") if f.endswith(".csv")]) == 4
    assert spark.read.option("header", "true").schema("k long, v long").csv(f"{tmp_dir}/out").count() == 100


def test_stream_landing_processes_each_file_once(spark, tmp_dir):
    from starloom.streaming import stream_landing
    df = spark.range(10).selectExpr("id AS k", "id * 3 AS v")
    glob, sink, ckpt = f"{tmp_dir}/landing/*/*.csv", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    export(df.where("k < 4"), f"{tmp_dir}/landing/a")
    assert stream_landing(spark, glob, df.schema, sink, ckpt) == 4
    export(df.where("k >= 4"), f"{tmp_dir}/landing/b")
    assert stream_landing(spark, glob, df.schema, sink, ckpt) == 6
    assert stream_landing(spark, glob, df.schema, sink, ckpt) == 0
    assert sorted(r["k"] for r in spark.read.parquet(sink).collect()) == list(range(10))
    # a malformed row fails the run, as in the batch load
    with open(f"{tmp_dir}/landing/b/bad.csv", "w") as f:
        f.write("k,v\nxx,1\n")
    with pytest.raises(Exception):
        stream_landing(spark, glob, df.schema, sink, ckpt)
    assert spark.read.parquet(sink).count() == 10


def test_create_tables_and_clean_bronze(spark, tmp_dir):
    from starloom.plans import racing
    racing.create_silver_tables(spark, f"{tmp_dir}/silver")
    fact = read_current(spark, f"{tmp_dir}/silver/fact_race_result")
    assert fact.count() == 0 and len(fact.columns) == 36
    with pytest.raises(Exception):
        racing.create_silver_tables(spark, f"{tmp_dir}/silver")
    racing.create_silver_tables(spark, f"{tmp_dir}/silver", replace=True)
    write_version(spark.createDataFrame([(1, "x")], "statusId int, status string"), f"{tmp_dir}/bronze/status")
    assert racing.clean_bronze(spark, f"{tmp_dir}/bronze") == ["status"]
    st = read_current(spark, f"{tmp_dir}/bronze/status")
    assert st.count() == 0 and st.columns == ["statusId", "status"]


def test_ingest_into_catalog_database(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    _land(spark, landing)
    control = spark.createDataFrame([("status", "csv", "status", ",")], CONTROL_SCHEMA)
    res = ingest(spark, control, landing, "bronze_catalog_test")
    assert res.loaded == ["status.csv"]
    assert spark.table("bronze_catalog_test.status").count() == 2
    # overwrite replaces the table on the next load
    res2 = ingest(spark, control, landing, "bronze_catalog_test")
    assert spark.table("bronze_catalog_test.status").count() == 2 and res2.loaded == ["status.csv"]


def test_listing_relative_landing_folder(spark, tmp_dir, monkeypatch):
    _land(spark, f"{tmp_dir}/landing")
    monkeypatch.chdir(tmp_dir)
    names = {r["expected"] for r in list_landing(spark, "landing").collect()}
    assert {"circuits.csv", "status.csv", "parts.csv"} <= names


def test_two_sources_for_one_target_load_in_turn(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    _land(spark, landing)
    with open(f"{landing}/status2.csv", "w") as f:
        f.write("statusId,status\n1,Finished\n2,Disqualified\n3,Accident\n")
    control = spark.createDataFrame([("status2", "csv", "status", ","), ("status", "csv", "status", ",")],
                                    CONTROL_SCHEMA)
    res = ingest(spark, control, landing, f"{tmp_dir}/bronze")
    assert sorted(res.loaded) == ["status.csv", "status2.csv"]
    # file-name order: status.csv first, then status2.csv overwrites it
    assert read_current(spark, f"{tmp_dir}/bronze/status").count() == 3


def _control(spark, *rows):
    return spark.createDataFrame([(n, "csv", t, ",") for n, t in rows], CONTROL_SCHEMA)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.mark.parametrize("bronze", ["path", "catalog"])
def test_corrupt_redelivery_keeps_the_old_table(spark, tmp_dir, bronze):
    from pyspark.sql.types import StructType
    from starloom.sources.landing import read_bronze
    target = f"{tmp_dir}/bronze" if bronze == "path" else "bronze_redelivery_test"
    schemas = {"status": StructType.fromDDL("statusId int, status string")}
    control = _control(spark, ("status", "status"))
    _write(f"{tmp_dir}/landing/status.csv", "statusId,status\n1,a\n2,b\n")
    assert ingest(spark, control, f"{tmp_dir}/landing", target, schemas=schemas).loaded == ["status.csv"]
    _write(f"{tmp_dir}/landing/status.csv", "statusId,status\n1,a\nx,b\n")
    bad = ingest(spark, control, f"{tmp_dir}/landing", target, schemas=schemas)
    assert bad.failed == ["status.csv"] and len(bad.audit.first()["detail"]) > 20
    assert read_bronze(spark, target, "status").count() == 2
    assert read_bronze(spark, target, "never_landed") is None


def test_columns_are_found_by_header_name(spark, tmp_dir):
    from pyspark.sql.types import StructType
    _write(f"{tmp_dir}/landing/t.csv", "B,extra,a\n2,x,1\n4,,3\n")
    _write(f"{tmp_dir}/landing/u.csv", "a\n1\n")
    schemas = {n: StructType.fromDDL("a int, b int") for n in ("t", "u")}
    res = ingest(spark, _control(spark, ("t", "t"), ("u", "u")), f"{tmp_dir}/landing", f"{tmp_dir}/bronze",
                 schemas=schemas)
    assert res.loaded == ["t.csv"] and res.failed == ["u.csv"]
    t = read_current(spark, f"{tmp_dir}/bronze/t")
    assert t.columns == ["a", "b"] and sorted(map(tuple, t.collect())) == [(1, 2), (3, 4)]


def test_ledger_knows_the_target_table(spark, tmp_dir):
    _write(f"{tmp_dir}/landing/t.csv", "a\n1\n")
    args = (f"{tmp_dir}/landing", f"{tmp_dir}/bronze")
    first = ingest(spark, _control(spark, ("t", "one")), *args, ledger=f"{tmp_dir}/ledger")
    both = ingest(spark, _control(spark, ("t", "one"), ("t", "two")), *args, ledger=f"{tmp_dir}/ledger")
    assert first.loaded == ["t.csv"] and both.loaded == ["t.csv"] and both.skipped == ["t.csv"]
    assert read_current(spark, f"{tmp_dir}/bronze/two").count() == 1


def test_names_that_differ_only_in_case_are_reported(spark, tmp_dir):
    _write(f"{tmp_dir}/landing/t.csv", "a\n1\n")
    _write(f"{tmp_dir}/landing/T.csv", "a\n2\n")
    res = ingest(spark, _control(spark, ("t", "t")), f"{tmp_dir}/landing", f"{tmp_dir}/bronze")
    assert res.failed == ["t.csv"] and "case" in res.audit.first()["detail"]


def test_unreadable_version_log_raises(spark, tmp_dir):
    from starloom.sinks.versions import read_current_or_none
    assert read_current_or_none(spark, f"{tmp_dir}/none") is None
    _write(f"{tmp_dir}/tbl/versions/part-0.parquet", "not parquet")
    with pytest.raises(Exception):
        read_current_or_none(spark, f"{tmp_dir}/tbl")


def test_not_null_columns_are_checked_on_write(spark, tmp_dir):
    from starloom.sinks.storage import require_not_null
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    with pytest.raises(Exception, match="NOT NULL"):
        write_version(require_not_null(df, ["k"], "t"), f"{tmp_dir}/t")
    assert require_not_null(df, ["v"], "t").count() == 2


def test_checkpoint_folder_must_be_set_on_a_cluster(spark, monkeypatch):
    from starloom import session
    monkeypatch.setattr(session, "_is_local", lambda s: False)
    monkeypatch.setattr(session, "_context", lambda s: None)
    old = spark.conf.get("spark.checkpoint.dir", None)
    if old is None:
        with pytest.raises(RuntimeError):
            session.checkpoint_dir(spark)
    else:
        assert session.checkpoint_dir(spark) == old
