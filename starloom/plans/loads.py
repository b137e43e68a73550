"""Load operators bound to the warehouse tables: reloads by partition, reject
tables, streaming upserts, incremental roll-ups, bucketed joins, hot-key
lookups, load profiles, schema drift, restart and retention.

As in ``retail``, each function takes ``(spark, base_dir)``, reads whole tables
and derives the fixtures that an operator needs from attributes of the rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.operators import Enrichment, Lookup, enrich, lookup_keys, rollup_children
from starloom.operators.hot_keys import lookup_hot
from starloom.operators.profile import merge_profiles, profiled_write, read_profiles, store_profile
from starloom.operators.rollup_state import apply_delta, read_rollup, rollup_state
from starloom.plans import retail
from starloom.session import scratch_dir
from starloom.sinks.buckets import bucket_count, write_bucketed
from starloom.sinks.run_ledger import RunLedger
from starloom.sinks.storage import append_rows, create_table, ensure_database, export, truncate, write_table
from starloom.sinks.versions import (
    append_version,
    read_current,
    read_version,
    reading,
    remove_superseded,
    replace_partitions,
    write_version,
)
from starloom.sources.landing import CONTROL_SCHEMA, Rejects, ingest, read_rejects
from starloom.sources.tables import read_table
from starloom.streaming import stream_upsert as stream_upsert_files
from starloom.streaming import upsert_batch

# --------------------------------------------------------------------------
# reload by partition
# --------------------------------------------------------------------------

# The region whose nations are reloaded, and the one of them that
# has no orders any more.
RELOAD_REGION, CLOSED_NATION = "ASIA", "CHINA"


def fact_reload_by_partition(spark: SparkSession, d: str) -> DataFrame:
    """The order fact stored by nation, before its lines arrived; the nations
    of a region are then reloaded with them, without withdrawn orders, and one
    of the nations has no rows left.  ``rewritten`` tells the rows whose file
    is a new one: those of the reloaded partitions and no others."""
    base = scratch_dir(spark, "fact-by-nation")
    dims = retail.retail_dims(spark, d)
    write_version(retail._build_fact(spark, d, dims, with_lines=False), base, partition_by="nation_key")
    before = read_current(spark, base).select(F.col("_metadata.file_path").alias("_old_file")).distinct()
    names = read_table(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    regions = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    chosen = (dims["nation"].select("n_nationkey", "nation_key").join(names, "n_nationkey")
              .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
              .where(F.col("r_name") == RELOAD_REGION).select("nation_key", "n_name"))
    new = (retail._build_fact(spark, d, dims).where(F.col("o_orderstatus") != retail.WITHDRAWN_STATUS)
           .join(chosen.where(F.col("n_name") != CLOSED_NATION).select("nation_key"), "nation_key", "left_semi"))
    replace_partitions(new, base, "nation_key", chosen)
    after = read_current(spark, base).withColumn("_file", F.col("_metadata.file_path"))
    return (after.join(before, F.col("_file") == F.col("_old_file"), "left")
            .select(*retail.FACT_COLUMNS, F.col("_old_file").isNull().alias("rewritten")))


def calendar_append_job(spark: SparkSession, d: str) -> DataFrame:
    """The ship-date calendar stored as a version, the order dates not yet in
    it appended: the new version has the old one's files and one more folder."""
    base = scratch_dir(spark, "calendar-versions")
    write_version(retail.calendar_dimension(
        read_table(spark, d, "lineitem", ["l_shipdate"])
        .select(F.col("l_shipdate").cast("date").alias("full_date"))), base)
    stored = read_current(spark, base)
    append_version(retail.insert_if_absent(retail.calendar(spark, d), stored, ["date_key"]), base)
    return read_current(spark, base)


# --------------------------------------------------------------------------
# rejects and drift
# --------------------------------------------------------------------------

REJECT_COLUMNS = "c_custkey BIGINT, c_nationkey INT, c_acctbal DECIMAL(12,2), c_mktsegment STRING"


def _ingest_rejects(spark: SparkSession, d: str):
    """customer landed as text: customers in debt have no number as balance,
    those of one segment a column too many; supplier has nothing but bad lines,
    more than allowed."""
    root = scratch_dir(spark, "rejects")
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    bal = F.when(F.col("c_acctbal") < 0, F.lit("overdrawn")).otherwise(
        F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    extra = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("|x")).otherwise(F.lit(""))
    line = F.concat(F.concat_ws("|", F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"), bal,
                                "c_mktsegment"), extra)
    # lines as another system writes them, without a header
    c.select(line.alias("value")).write.text(f"{root}/landing/customer.csv")
    s = read_table(spark, d, "supplier", ["s_suppkey"])
    s.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("value")).write.text(
        f"{root}/landing/supplier.csv")
    control = spark.createDataFrame([("customer", "csv", "bronze_customer", "|"),
                                     ("supplier", "csv", "bronze_supplier", "|")], CONTROL_SCHEMA)
    rejects = Rejects(f"{root}/rejects", max_share=0.5)
    res = ingest(spark, control, f"{root}/landing", f"{root}/bronze", header=False, rejects=rejects, schemas={
        "bronze_customer": StructType.fromDDL(REJECT_COLUMNS),
        "bronze_supplier": StructType.fromDDL("s_suppkey INT")})
    return root, rejects, res


def ingest_accepted(spark: SparkSession, d: str) -> DataFrame:
    """The good lines in bronze."""
    root, _, _ = _ingest_rejects(spark, d)
    return read_current(spark, f"{root}/bronze/bronze_customer")


def ingest_rejected(spark: SparkSession, d: str) -> DataFrame:
    """The bad lines of both sources, with the name of the landed entry."""
    _, rejects, _ = _ingest_rejects(spark, d)
    return read_rejects(spark, rejects).select(
        "target_table", F.regexp_extract("file_path", r"/landing/([^/]+)/", 1).alias("entry"), "line")


def ingest_reject_audit(spark: SparkSession, d: str) -> DataFrame:
    """One source loads without its bad lines, the other fails for too many."""
    return _ingest_rejects(spark, d)[2].audit


# Three layouts in which supplier is delivered, one after the other.
DRIFT = ("s_suppkey INT, s_name STRING, s_acctbal DECIMAL(9,2)",
         "s_suppkey BIGINT, s_name STRING, s_acctbal DECIMAL(12,2), s_nationkey INT",
         "s_suppkey STRING, s_name STRING, s_acctbal DECIMAL(12,2), s_nationkey INT")


def _ingest_drift(spark: SparkSession, d: str):
    """supplier delivered in three layouts: the second widens two columns and
    adds one, the third makes the key text, which is refused."""
    root = scratch_dir(spark, "drift")
    control = spark.createDataFrame([("supplier", "csv", "bronze_supplier", ",")], CONTROL_SCHEMA)
    audits = []
    for i, ddl in enumerate(DRIFT, start=1):
        layout = StructType.fromDDL(ddl)
        s = read_table(spark, d, "supplier", layout.names)
        export(s.select(*[F.col(f.name).cast(f.dataType) for f in layout.fields]), f"{root}/landing{i}/supplier.csv")
        res = ingest(spark, control, f"{root}/landing{i}", f"{root}/bronze", schemas={"bronze_supplier": layout},
                     allow_drift=("added", "widened"))
        audits.append(res.audit.select(F.lit(i).alias("delivery"), "*"))
    return root, audits[0].unionByName(audits[1]).unionByName(audits[2])


def ingest_drift(spark: SparkSession, d: str) -> DataFrame:
    """The audit of the three deliveries; the changes are named."""
    return _ingest_drift(spark, d)[1]


def ingest_drift_table(spark: SparkSession, d: str) -> DataFrame:
    """Bronze after them: the second delivery, in the widened layout."""
    root, _ = _ingest_drift(spark, d)
    return read_current(spark, f"{root}/bronze/bronze_supplier")


# --------------------------------------------------------------------------
# streaming upsert, incremental roll-up
# --------------------------------------------------------------------------

UPSERT_SOURCE = "c_custkey BIGINT, c_name STRING, c_acctbal DECIMAL(12,2), c_mktsegment STRING, delivered INT"
UPSERT_TARGET = ("cust_key BIGINT, c_custkey BIGINT, c_name STRING, c_acctbal DECIMAL(12,2), c_mktsegment STRING, "
                 "dw_inserted_at TIMESTAMP_NTZ, dw_updated_at TIMESTAMP_NTZ")


def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """customer delivered in two drops and merged by the stream.  The first has
    no customers of the new segment; the second has those, and every customer
    in debt twice, the later one with a balance of 0.  Then the first batch is
    handed out again, with other balances: nothing changes."""
    root = scratch_dir(spark, "upsert")
    base = f"{root}/dim_customer"
    source, target = StructType.fromDDL(UPSERT_SOURCE), StructType.fromDDL(UPSERT_TARGET)
    c = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    rows = c.select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"), "c_mktsegment",
                    F.lit(1).alias("delivered"))
    new = F.col("c_mktsegment") == retail.NEW_SEGMENT
    first = rows.where(~new | new.isNull())
    debt = rows.where(F.col("c_acctbal") < 0)
    zero = debt.withColumns({"c_acctbal": F.lit(0).cast("decimal(12,2)"), "delivered": F.lit(2)})
    args = dict(surrogate_key="cust_key", order_by=["delivered"], load_ts=retail._ts(retail.LOAD_TS))
    for i, drop in enumerate((first, rows.where(new).unionByName(debt).unionByName(zero)), start=1):
        export(drop, f"{root}/landing/drop{i}")
        stream_upsert_files(spark, f"{root}/landing/*/*.csv", source, base, ["c_custkey"], target,
                            f"{root}/checkpoint", **args)
    upsert_batch(rows.withColumn("c_acctbal", F.lit(-1).cast("decimal(12,2)")), 0, base, ["c_custkey"], target, **args)
    return read_current(spark, base)


# The day that parts the lines loaded first from those added later.
ROLLUP_SPLIT = "1996-01-01 00:00:00"


def rollup_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Lines per order from stored state: the lines shipped before a day are
    rolled up, the later ones added, returned ones withdrawn, and the second
    delivery handed out again, which changes nothing."""
    base = scratch_dir(spark, "rollup-state")
    keys = ["l_orderkey"]
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_quantity", "l_shipdate", "l_returnflag"])
    early = F.coalesce(F.col("l_shipdate") < F.lit(ROLLUP_SPLIT).cast("timestamp_ntz"), F.lit(False))
    # a quantity is missing where the line was accepted, so that counts of rows and of values differ
    qty = F.when(F.col("l_returnflag") != "A", F.floor("l_quantity").cast("int"))

    def state(rows: DataFrame, **kw) -> DataFrame:
        # orders are numbered in the order of their arrival: a delivery has few buckets
        return rollup_state(rows, keys, qty, bucket=F.floor(F.col("l_orderkey") / 4096), **kw)

    apply_delta(spark, base, state(li.where(early)), keys, "early")
    apply_delta(spark, base, state(li.where(~early)), keys, "late")
    apply_delta(spark, base, state(li.where(F.col("l_returnflag") == "R"), withdrawn=F.lit(True)), keys, "returned")
    apply_delta(spark, base, state(li.where(~early)), keys, "late")
    return read_rollup(spark, base, keys, count_name="line_count", sum_name="total_qty", avg_name="avg_qty")


# --------------------------------------------------------------------------
# bucketed joins, hot-key lookups
# --------------------------------------------------------------------------

# The least number of buckets; bytes of a line's six columns, and of a bucket's
# lines.  The sorts and roll-ups of a task hold one bucket.
BUCKETS, LINE_BYTES, BUCKET_BYTES = 16, 64, 64 << 20


def bucketed_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """Every line beside two roll-ups on (order, supplier): of the lines kept,
    and of the discounted ones.  Lines and roll-ups are bucketed by that key,
    so the joins, and the roll-ups of bucketed lines, need no exchange.  The
    number of buckets follows that of the lines, so that a task's stays."""
    tag = uuid.uuid4().hex[:8]
    keys = ["l_orderkey", "l_suppkey"]
    lines = read_table(spark, d, "lineitem", ["l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag",
                                              "l_quantity", "l_discount"])
    buckets = max(BUCKETS, bucket_count(spark, lines.count() * LINE_BYTES, BUCKET_BYTES))
    li = write_bucketed(lines, f"lines_{tag}", keys, buckets)
    qty = F.floor("l_quantity").cast("int")
    kept = rollup_children(li.where(F.col("l_returnflag") != "R"), keys, qty, count_name="kept_lines",
                           sum_name="kept_qty", sum_type="bigint", avg_name=None)
    cut = rollup_children(li.where(F.col("l_discount") >= 0.05), keys, qty, count_name="cut_lines",
                          sum_name="cut_qty", sum_type="bigint", avg_name=None)
    tables = [write_bucketed(t, f"{n}_{tag}", keys, buckets) for n, t in (("kept", kept), ("cut", cut))]
    on = {k: k for k in keys}
    out = enrich(li, [
        Enrichment(tables[0], on, {"kept_lines": "kept_lines", "kept_qty": "kept_qty"}, {"kept_lines": 0}),
        Enrichment(tables[1], on, {"cut_lines": "cut_lines", "cut_qty": "cut_qty"}, {"cut_lines": 0})])
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "kept_lines", "kept_qty", "cut_lines", "cut_qty")


def hot_key_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Every line with its supplier's name and nation: suppliers of one line in
    a hundred or more meet by broadcast, the others by the ordinary lookup."""
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"])
    s = read_table(spark, d, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    return lookup_hot(li, Lookup(s, {"l_suppkey": "s_suppkey"}, {"s_name": "s_name", "s_nationkey": "s_nationkey"}))


def status_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Orders with the text of their status, NULL for a status that the status
    table does not have (that of no line)."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_orderstatus"])
    codes = read_table(spark, d, "lineitem", ["l_linestatus"]).where(F.col("l_linestatus").isNotNull()).distinct()
    status = codes.select(F.col("l_linestatus").alias("status_id"),
                          F.concat(F.lit("Status "), F.col("l_linestatus")).alias("status"))
    return lookup_keys(o, [Lookup(status, {"o_orderstatus": "status_id"}, {"status": "finish_status"}, unique=True)])


# --------------------------------------------------------------------------
# profiles, tables, restart, retention
# --------------------------------------------------------------------------

def load_profile(spark: SparkSession, d: str) -> DataFrame:
    """customer written in two loads (by balance) and profiled while written;
    the profiles merged per column.  ``near_exact``: the distinct estimate of
    both loads together is within 6% of the exact number."""
    root = scratch_dir(spark, "profile")
    c = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    c = c.withColumn("c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))
    debt = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    for name, part in (("debt", debt), ("rest", ~debt)):
        profile = profiled_write(c.where(part), name, lambda df, n=name: write_table(df, f"{root}/{n}"))
        store_profile(profile, f"{root}/profiles")
    merged = merge_profiles(read_profiles(spark, f"{root}/profiles"))
    exact = c.agg(*[F.count_distinct(n).alias(n) for n in c.columns])
    exact = exact.unpivot([], c.columns, "column", "exact")
    near = F.abs(F.col("distinct_estimate") - F.col("exact")) <= 0.06 * F.col("exact")
    return merged.join(exact, "column").select("column", "loads", "rows", "nulls", near.alias("near_exact"))


def table_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    """A database and an empty table with declared columns; region is inserted
    with a column list, the table truncated, and nation inserted."""
    db = f"bronze_{uuid.uuid4().hex[:8]}"
    for _ in range(2):  # a second time changes nothing
        ensure_database(spark, db, scratch_dir(spark, db))
    layout = StructType.fromDDL("place_key BIGINT, place_name STRING, place_code SMALLINT, remark STRING")
    create_table(spark, f"{db}.place", layout)
    r = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    append_rows(r.select(F.col("r_regionkey").alias("place_key"), F.col("r_name").alias("place_name")),
                f"{db}.place", layout)
    truncate(spark, f"{db}.place")
    n = read_table(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    append_rows(n.select(F.col("n_name").alias("place_name"), F.col("n_nationkey").alias("place_key"),
                         F.col("n_regionkey").alias("place_code")), f"{db}.place", layout)
    return spark.table(f"{db}.place")


def run_restart(spark: SparkSession, d: str) -> DataFrame:
    """A job of three steps whose last one fails, started again (only that step
    runs), and started once more with a new version of one input (the steps
    that read it, directly or not, run)."""
    store = scratch_dir(spark, "restart")
    inputs = {"region": 1, "nation": 1}
    told = []

    def nations() -> DataFrame:
        n = read_table(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
        return n.where(F.col("n_regionkey").isNotNull()) if inputs["nation"] > 1 else n

    def run(number: int, broken: bool) -> None:
        ledger = RunLedger(spark, f"{store}/_runs", store)

        def join() -> None:
            if broken:
                raise RuntimeError("no space left")
            both = lookup_keys(ledger_tables["nations"], [Lookup(
                ledger_tables["regions"], {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"}, unique=True)])
            write_version(both, ledger.base("places"))

        ledger_tables = {}
        counts = {}
        try:
            ledger_tables["regions"] = ledger.step("regions", {"region": inputs["region"]}, lambda: write_version(
                read_table(spark, d, "region", ["r_regionkey", "r_name"]), ledger.base("regions")))
            ledger_tables["nations"] = ledger.step("nations", {"nation": inputs["nation"]}, lambda: write_version(
                nations(), ledger.base("nations")))
            ledger_tables["places"] = ledger.step(
                "places", {t: ledger.version(t) for t in ("regions", "nations")}, join)
        except RuntimeError:
            pass
        for name, table in ledger_tables.items():
            counts[name] = table.count()
        for name in ("regions", "nations", "places"):
            outcome = "ran" if name in ledger.ran else "skipped" if name in ledger.skipped else "failed"
            told.append((number, name, outcome, counts.get(name)))

    run(1, broken=True)
    run(2, broken=False)
    inputs["nation"] = 2
    run(3, broken=False)
    return spark.createDataFrame(told, "run int, step string, outcome string, rows long")


def version_retention(spark: SparkSession, d: str) -> DataFrame:
    """customer stored four times (by segment, then whole), superseded versions
    removed while the second is being read: it and the newest stay.  One row
    per version: whether it is there, and its rows."""
    base = scratch_dir(spark, "retention")
    c = read_table(spark, d, "customer", ["c_custkey", "c_mktsegment"])
    write_version(c.where(F.col("c_mktsegment") == "BUILDING"), base)
    write_version(c.where(F.col("c_mktsegment") == "MACHINERY"), base)
    with reading(spark, base) as second:
        write_version(c.where(F.col("c_mktsegment") == "AUTOMOBILE"), base)
        write_version(c, base)
        gone = remove_superseded(spark, base, keep=1)
        rows = {2: second.count(), 4: read_version(spark, base, 4).count()}
    kept = [(v, f"{v}" not in {p.rsplit("_version=", 1)[1].split("-")[0] for p in gone}) for v in range(1, 5)]
    return spark.createDataFrame([(v, there, rows.get(v)) for v, there in kept], "version int, stored boolean, rows long")


QUERIES = {
    "fact_reload_by_partition": fact_reload_by_partition,
    "calendar_append_job": calendar_append_job,
    "ingest_accepted": ingest_accepted,
    "ingest_rejected": ingest_rejected,
    "ingest_reject_audit": ingest_reject_audit,
    "ingest_drift": ingest_drift,
    "ingest_drift_table": ingest_drift_table,
    "stream_upsert": stream_upsert,
    "rollup_incremental": rollup_incremental,
    "bucketed_enrichment": bucketed_enrichment,
    "hot_key_lookup": hot_key_lookup,
    "status_lookup": status_lookup,
    "load_profile": load_profile,
    "table_lifecycle": table_lifecycle,
    "run_restart": run_restart,
    "version_retention": version_retention,
}
