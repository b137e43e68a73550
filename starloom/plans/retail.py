"""The star-schema operators bound to the warehouse tables (region, nation,
customer, supplier, part, orders, lineitem, events).

Each public function takes ``(spark, base_dir)`` and returns a DataFrame.
Every one reads whole tables; fixtures that an operator needs (a stale
target, a partial dimension, malformed text) are derived from attributes of
the rows themselves -- market segment, balance sign, return flag, line number
-- never from id subsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.functions import (
    blank_to_null,
    full_name,
    lap_time_ms,
    exact_sum,
    least_positive,
    money_units,
    parse_date_any,
    positions_gained as positions_gained_col,
    safe_cast,
    trimmed,
    units_sum,
)
from starloom.operators import (
    Enrichment,
    Lookup,
    assemble_fact,
    assign_surrogate_keys,
    calendar_dimension,
    compare_to_group_mean,
    count_by_bucket,
    entity_records as entity_records_op,
    insert_if_absent,
    lookup_keys,
    max_key,
    mean_by_bucket,
    one_row_per_key,
    period_leaders,
    quarantine,
    replace_keys,
    rollup_children,
    scd1_merge,
    share_of_group as share_of_group_op,
)
from starloom.session import scratch_dir
from starloom.sinks.storage import append_rows, export, write_table
from starloom.sinks.versions import read_current, write_version
from starloom.sources.landing import CONTROL_SCHEMA, ingest
from starloom.sources.tables import read_table
from starloom.streaming import stream_landing

# Load timestamps used by the dimension loads, so reruns are
# repeatable (the timestamp is an argument of the load, not the wall clock).
LOAD_TS = "2024-01-01 00:00:00"
PREVIOUS_LOAD_TS = "2023-01-01 00:00:00"


def _ts(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


# --------------------------------------------------------------------------
# dimensions
# --------------------------------------------------------------------------

def natural_key(df: DataFrame, keys: list[str], key_name: str) -> DataFrame:
    """In place of ``assign_surrogate_keys`` where only matters whether a key
    resolves: the natural key itself, which must be there once too."""
    return one_row_per_key(df, keys, "rows to be keyed").withColumn(key_name, F.col(keys[0]))


def dim_region(spark: SparkSession, d: str, keyed=assign_surrogate_keys) -> DataFrame:
    r = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    return keyed(r, ["r_regionkey"], "region_key")


def dim_nation(spark: SparkSession, d: str, regions: DataFrame, keyed=assign_surrogate_keys) -> DataFrame:
    """Nation dimension; its region key is looked up at load time (as a
    race row gets its circuit key)."""
    n = read_table(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    n = keyed(n, ["n_nationkey"], "nation_key")
    return lookup_keys(n, [Lookup(regions, {"n_regionkey": "r_regionkey"},
                                  {"region_key": "region_key"}, unique=True)])


def dim_customer(spark: SparkSession, d: str, nations: DataFrame,
                 customers: DataFrame | None = None, keyed=assign_surrogate_keys) -> DataFrame:
    c = customers if customers is not None else read_table(
        spark, d, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    c = keyed(c, ["c_custkey"], "cust_key")
    return lookup_keys(c, [Lookup(nations, {"c_nationkey": "n_nationkey"},
                                  {"nation_key": "nation_key"}, unique=True)])


def dim_order_date(orders: DataFrame) -> DataFrame:
    return calendar_dimension(orders.select(F.col("o_orderdate").cast("date").alias("full_date")))


def lineitem_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Child roll-up of lineitem per order: count, quantity total and
    decimal mean, price total."""
    return _lineitem_rollup_of(
        read_table(spark, d, "lineitem", ["l_orderkey", "l_quantity", "l_extendedprice"]))


def _lineitem_rollup_of(li: DataFrame) -> DataFrame:
    return rollup_children(
        li, ["l_orderkey"], F.floor("l_quantity").cast("int"),
        count_name="line_count", sum_name="total_qty", sum_type="bigint",
        avg_name=None,
        extra=[F.avg(F.col("l_quantity").cast("decimal(10,0)")).cast("decimal(8,1)").alias("avg_qty"),
               units_sum(money_units("l_extendedprice"), 2).alias("total_price")])


FACT_COLUMNS = ["o_orderkey", "cust_key", "nation_key", "region_key", "date_key",
                "o_orderstatus", "order_total", "line_count", "total_qty",
                "total_price", "avg_qty"]


def _orders_base(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    F.col("o_totalprice").cast("decimal(15,2)").alias("order_total"),
                    F.col("o_orderdate").cast("date").alias("order_date"))


def retail_dims(spark: SparkSession, d: str, customers: DataFrame | None = None,
                keyed=assign_surrogate_keys) -> dict:
    """Region, nation, customer and order-date dimensions."""
    regions = dim_region(spark, d, keyed)
    nations = dim_nation(spark, d, regions, keyed)
    return {
        "region": regions,
        "nation": nations,
        "customer": dim_customer(spark, d, nations, customers, keyed),
        "date": dim_order_date(read_table(spark, d, "orders", ["o_orderdate"])),
    }


def _build_fact(spark: SparkSession, d: str, dims: dict, *, with_lines: bool = True,
                require: list[str] | None = None, keep_natural: bool = False,
                only_customers: DataFrame | None = None) -> DataFrame:
    """Assemble the order fact.  ``only_customers`` (one column ``o_custkey``)
    restricts the build to those customers' orders *and* their lineitems
    before the roll-up, as a targeted reload should."""
    base = _orders_base(spark, d)
    rollup = lineitem_rollup(spark, d) if with_lines else None
    if only_customers is not None:
        chosen = only_customers.distinct()
        base = base.join(chosen, "o_custkey", "left_semi")
        if with_lines:
            orders_of = base.select(F.col("o_orderkey").alias("l_orderkey"))
            li = read_table(spark, d, "lineitem", ["l_orderkey", "l_quantity", "l_extendedprice"])
            rollup = _lineitem_rollup_of(li.join(orders_of, "l_orderkey", "left_semi"))
    enrichments = []
    if with_lines:
        enrichments.append(Enrichment(
            rollup, {"o_orderkey": "l_orderkey"},
            {"line_count": "line_count", "total_qty": "total_qty",
             "total_price": "total_price", "avg_qty": "avg_qty"},
            defaults={"line_count": 0}, unique=True))
    fact = assemble_fact(
        base,
        enrichments=enrichments,
        lookups=[
            Lookup(dims["customer"], {"o_custkey": "c_custkey"},
                   {"cust_key": "cust_key", "nation_key": "nation_key"}, unique=True),
            # transitive: nation and region keys reach the fact through the
            # customer dimension, and resolve only if those rows exist.
            Lookup(dims["nation"], {"nation_key": "nation_key"},
                   {"nation_key": "nation_key", "region_key": "region_key"}, unique=True),
            Lookup(dims["region"], {"region_key": "region_key"}, {"region_key": "region_key"}, unique=True),
            Lookup(dims["date"], {"order_date": "full_date"}, {"date_key": "date_key"}, unique=True),
        ],
        require=require)
    if not with_lines:
        fact = fact.select("*", F.lit(0).cast("bigint").alias("line_count"),
                           F.lit(None).cast("bigint").alias("total_qty"),
                           F.lit(None).cast("decimal(38,2)").alias("total_price"),
                           F.lit(None).cast("decimal(8,1)").alias("avg_qty"))
    cols = FACT_COLUMNS + (["o_custkey"] if keep_natural else [])
    return fact.select(*cols)


# --------------------------------------------------------------------------
# fact queries
# --------------------------------------------------------------------------

def star_fact(spark: SparkSession, d: str) -> DataFrame:
    """Every order with customer/nation/region/date keys and its lineitem
    roll-up (count 0 when it has no lines)."""
    return _build_fact(spark, d, retail_dims(spark, d))


def star_fact_required(spark: SparkSession, d: str) -> DataFrame:
    """Only orders that have a roll-up (the required-measure filter)."""
    return _build_fact(spark, d, retail_dims(spark, d), require=["total_qty"])


# The market segment whose customers a targeted reload replaces,
# and the status of orders that it no longer finds.
RELOAD_SEGMENT = "BUILDING"
WITHDRAWN_STATUS = "P"


def star_fact_reload(spark: SparkSession, d: str) -> DataFrame:
    """Targeted reload: an older fact built before lineitems arrived (no
    roll-up) gets the orders of the chosen customers replaced by freshly
    assembled rows; all other rows are kept as they were.  Orders of status
    P have been withdrawn meanwhile, so a chosen customer with no others has
    no rows left."""
    dims = retail_dims(spark, d)
    old = _build_fact(spark, d, dims, with_lines=False, keep_natural=True)
    chosen = (read_table(spark, d, "customer", ["c_custkey", "c_mktsegment"])
              .where(F.col("c_mktsegment") == RELOAD_SEGMENT)
              .select(F.col("c_custkey").alias("o_custkey")))
    new = _build_fact(spark, d, dims, keep_natural=True, only_customers=chosen)
    new = new.where(F.col("o_orderstatus") != WITHDRAWN_STATUS)
    return replace_keys(old, new, ["o_custkey"], chosen).select(*FACT_COLUMNS)


FACT_KEYS = ["cust_key", "nation_key", "region_key", "date_key"]


def fact_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Fact rows whose keys do not resolve, against a customer dimension that
    holds only customers with a non-negative balance; each row names the
    unresolved key columns."""
    partial = (read_table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey",
                                                 "c_mktsegment", "c_acctbal"])
               .where(F.col("c_acctbal") >= 0).drop("c_acctbal"))
    fact = _build_fact(spark, d, retail_dims(spark, d, partial, natural_key), with_lines=False, keep_natural=True)
    _, bad = quarantine(fact, FACT_KEYS)
    return bad.select("o_orderkey", "o_custkey", "unresolved")


def child_rollup(spark: SparkSession, d: str) -> DataFrame:
    """lineitem per (order, supplier): count, quantity sum, decimal mean
    stored as DECIMAL(8,1), price sum."""
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return rollup_children(
        li, ["l_orderkey", "l_suppkey"], F.floor("l_quantity").cast("int"),
        count_name="line_count", sum_name="total_qty", sum_type="bigint",
        avg_name="avg_qty", avg_input_type="decimal(10,0)", avg_type="decimal(8,1)",
        extra=[units_sum(money_units("l_extendedprice"), 2).alias("total_price")])


# --------------------------------------------------------------------------
# calendar
# --------------------------------------------------------------------------

def calendar(spark: SparkSession, d: str) -> DataFrame:
    """Calendar dimension of the distinct order dates."""
    return dim_order_date(read_table(spark, d, "orders", ["o_orderdate"]))


def calendar_new_only(spark: SparkSession, d: str) -> DataFrame:
    """Order-date calendar rows not yet in a calendar built from ship dates
    (insert-if-absent)."""
    existing = calendar_dimension(
        read_table(spark, d, "lineitem", ["l_shipdate"])
        .select(F.col("l_shipdate").cast("date").alias("full_date")))
    return insert_if_absent(calendar(spark, d), existing, ["date_key"])


# How an order date is rendered as text, by order priority.
# The last layout is not an accepted one, so it parses to NULL.
DATE_RENDERING = {
    "1-URGENT": "yyyy-MM-dd",
    "2-HIGH": "dd-MM-yyyy",
    "3-MEDIUM": "dd/MM/yyyy",
    "4-NOT SPECIFIED": "MM/dd/yyyy",
    "5-LOW": "yyyy.MM.dd",
}


def _rendered_dates(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"])
    dt = F.col("o_orderdate").cast("date")
    text = None
    for prio, fmt in DATE_RENDERING.items():
        branch = F.date_format(dt, fmt)
        text = (F.when(F.col("o_orderpriority") == prio, branch) if text is None
                else text.when(F.col("o_orderpriority") == prio, branch))
    return o.select("o_orderkey", "o_custkey", "o_orderpriority", text.alias("date_text"))


def date_normalise(spark: SparkSession, d: str) -> DataFrame:
    """Mixed-format date text back to DATE (first accepted layout wins)."""
    r = _rendered_dates(spark, d)
    return r.select("o_orderkey", "o_orderpriority", "date_text",
                    parse_date_any("date_text").alias("parsed_date"))


def race_style_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Rows keyed like a race load: customer key by natural key, date key by
    joining the calendar on the date parsed from text (parsed once, used as
    both the stored date and the join key)."""
    customers = assign_surrogate_keys(read_table(spark, d, "customer", ["c_custkey"]), ["c_custkey"], "cust_key")
    dates = dim_order_date(read_table(spark, d, "orders", ["o_orderdate"]))
    r = _rendered_dates(spark, d).withColumn("order_date", parse_date_any("date_text"))
    out = assemble_fact(r, lookups=[
        Lookup(customers, {"o_custkey": "c_custkey"}, {"cust_key": "cust_key"}, unique=True),
        Lookup(dates, {"order_date": "full_date"}, {"date_key": "date_key"}, unique=True),
    ])
    return out.select("o_orderkey", "cust_key", "order_date", "date_key")


# --------------------------------------------------------------------------
# SCD1 merge
# --------------------------------------------------------------------------

# Segments defining the merge fixture.  Customers of the first
# are new (absent from the existing dimension); customers of the second are no
# longer delivered (absent from the source); the third has a stale balance.
NEW_SEGMENT = "MACHINERY"
DROPPED_SEGMENT = "HOUSEHOLD"
STALE_SEGMENT = "AUTOMOBILE"
CUSTOMER_ATTRS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _merge_fixture(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = read_table(spark, d, "customer", ["c_custkey"] + CUSTOMER_ATTRS)
    bal = F.col("c_acctbal").cast("decimal(12,2)")
    target = c.where(F.col("c_mktsegment") != NEW_SEGMENT).select(
        (F.col("c_custkey") + 1).cast("bigint").alias("cust_key"),
        "c_custkey", "c_name", "c_nationkey",
        F.when(F.col("c_mktsegment") == STALE_SEGMENT, bal - 100).otherwise(bal)
        .cast("decimal(12,2)").alias("c_acctbal"),
        "c_mktsegment",
        _ts(PREVIOUS_LOAD_TS).alias("dw_inserted_at"),
        F.lit(None).cast("timestamp_ntz").alias("dw_updated_at"))
    source = c.where(F.col("c_mktsegment") != DROPPED_SEGMENT).select(
        "c_custkey", "c_name", "c_nationkey", bal.alias("c_acctbal"),
        # a source NULL must overwrite the target value
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    return target, source


def _merge(target: DataFrame, source: DataFrame, **kw) -> DataFrame:
    return scd1_merge(target, source, ["c_custkey"], surrogate_key="cust_key",
                      update_cols=CUSTOMER_ATTRS, load_ts=_ts(LOAD_TS), **kw)


def scd1_customer(spark: SparkSession, d: str) -> DataFrame:
    target, source = _merge_fixture(spark, d)
    return _merge(target, source)


def scd1_changed_only(spark: SparkSession, d: str) -> DataFrame:
    target, source = _merge_fixture(spark, d)
    return _merge(target, source, only_changed=True, action_col="merge_action")


def scd1_idempotent(spark: SparkSession, d: str) -> DataFrame:
    """The same source merged twice: no duplicate rows, no key changes;
    the second pass only touches the stamp of rows the first one inserted."""
    target, source = _merge_fixture(spark, d)
    return _merge(_merge(target, source), source)


def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    """Existing key map = parts shipped before 1998, keyed in part-key order;
    every other part gets max(existing) + its rank among the new parts."""
    shipped = (read_table(spark, d, "lineitem", ["l_partkey", "l_shipdate"])
               .where(F.col("l_shipdate") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
               .select(F.col("l_partkey").alias("p_partkey")).distinct())
    existing = assign_surrogate_keys(shipped, ["p_partkey"], "part_key")
    parts = read_table(spark, d, "part", ["p_partkey"])
    new = parts.join(existing.select("p_partkey"), "p_partkey", "left_anti")
    keyed = assign_surrogate_keys(new, ["p_partkey"], "part_key",
                                  start=max_key(existing, "part_key"))
    return existing.unionByName(keyed)


# --------------------------------------------------------------------------
# column functions over text derived from the tables
# --------------------------------------------------------------------------

def _lap_texts(spark: SparkSession, d: str) -> DataFrame:
    """Lap-time text rendered from l_extendedprice (as milliseconds), in a
    variant chosen by line number and return flag.  Fixed values: line numbers 1-7
    of lines not returned (flag other than R) give the canonical text, padded text, a one-digit
    fraction, no fraction, bare seconds, ``\\N`` and an empty string; line numbers
    1-7 of returned lines give NULL, no colon, a trailing colon, an hour
    prefix, a four-digit fraction, seconds over 59 and a leading tab."""
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"])
    ms = F.floor("l_extendedprice")
    m = F.floor(ms / 60000).cast("string")
    s_num = F.floor(ms / 1000) % 60
    ss = F.lpad(s_num.cast("string"), 2, "0")
    fff = F.lpad((ms % 1000).cast("string"), 3, "0")
    canonical = F.concat(m, F.lit(":"), ss, F.lit("."), fff)
    ln = F.col("l_linenumber")
    returned = F.col("l_returnflag") == "R"
    text = (
        F.when(~returned & (ln == 1), canonical)
        .when(~returned & (ln == 2), F.concat(F.lit("  "), canonical, F.lit(" ")))
        .when(~returned & (ln == 3), F.concat(m, F.lit(":"), ss, F.lit("."), F.substring(fff, 1, 1)))
        .when(~returned & (ln == 4), F.concat(m, F.lit(":"), ss))
        .when(~returned & (ln == 5), F.floor(ms / 1000).cast("string"))
        .when(~returned & (ln == 6), F.lit("\\N"))
        .when(~returned & (ln == 7), F.lit(""))
        .when(returned & (ln == 1), F.lit(None).cast("string"))
        .when(returned & (ln == 2), F.concat(ss, F.lit("."), fff))
        .when(returned & (ln == 3), F.concat(m, F.lit(":")))
        .when(returned & (ln == 4), F.concat(F.lit("1:"), F.lpad(m, 2, "0"), F.lit(":"), ss,
                                             F.lit("."), F.substring(fff, 1, 1)))
        .when(returned & (ln == 5), F.concat(canonical, F.lit("0")))
        .when(returned & (ln == 6), F.concat(m, F.lit(":"), (s_num + 60).cast("string"),
                                             F.lit("."), fff))
        .when(returned & (ln == 7), F.concat(F.lit("\t"), canonical))
        .otherwise(canonical))
    return li.select("l_orderkey", "l_linenumber", text.alias("lap_text"))


def lap_times(spark: SparkSession, d: str) -> DataFrame:
    t = _lap_texts(spark, d).withColumn("fastest_ms", lap_time_ms("lap_text", missing="null"))
    # the qualifying flavour differs only in mapping "missing" to 0
    return t.select("l_orderkey", "l_linenumber", "lap_text",
                    F.coalesce("fastest_ms", F.lit(0)).alias("qual_ms"), "fastest_ms")


def best_of_three(spark: SparkSession, d: str) -> DataFrame:
    """Three session times per order (lines 1-3, pivoted by a grouped
    conditional min) and the best strictly positive one."""
    t = _lap_texts(spark, d).withColumn("q", lap_time_ms("lap_text", missing="zero"))
    ln = F.col("l_linenumber")
    per = t.groupBy("l_orderkey").agg(*[
        F.min(F.when(ln == k, F.col("q"))).alias(f"q{k}_ms") for k in (1, 2, 3)])
    return per.withColumn("best_ms", least_positive("q1_ms", "q2_ms", "q3_ms"))


def positions_gained(spark: SparkSession, d: str) -> DataFrame:
    """grid = p_size (0 for open N-flag lines), finish = text of l_quantity
    with '0', '\\N', 'R' and out-of-range values injected by line number."""
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                           "l_returnflag", "l_linestatus"])
    p = read_table(spark, d, "part", ["p_partkey", "p_size"])
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "left")
    grid = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(0)) \
        .otherwise(F.col("p_size"))
    q = F.floor("l_quantity").cast("int")
    ln = F.col("l_linenumber")
    finish = (F.when(ln == 4, (q * 10).cast("string"))
              .when(ln == 5, F.lit("0"))
              .when(ln == 6, F.lit("\\N"))
              .when(ln == 7, F.lit("R"))
              .otherwise(q.cast("string")))
    out = j.select("l_orderkey", "l_linenumber", grid.alias("grid"), finish.alias("finish_text"))
    out = out.withColumn("finish_position", safe_cast("finish_text", "tinyint"))
    return out.withColumn("positions_gained", positions_gained_col("grid", "finish_position"))


def try_cast_suite(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    bal = F.col("c_acctbal").cast("decimal(12,2)")
    return c.select(
        "c_custkey",
        bal.cast("string").alias("acct_text"),
        safe_cast(bal.cast("string"), "decimal(7,3)").alias("bal_dec73"),
        safe_cast((bal * 10).cast("string"), "decimal(7,3)").alias("bal10_dec73"),
        safe_cast(F.col("c_custkey").cast("string"), "tinyint").alias("key_tiny"),
        F.col("c_nationkey").cast("tinyint").alias("nation_tiny"),
        safe_cast("c_mktsegment", "tinyint").alias("segment_tiny"))


def clean_names(spark: SparkSession, d: str) -> DataFrame:
    """Padded name parts trimmed, blank codes to NULL, full name NULL when a
    part is missing."""
    c = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    first = F.concat(F.lit("  "), F.split_part("c_name", F.lit("#"), F.lit(1)), F.lit(" "))
    last = F.when(F.col("c_nationkey") != 0,
                  F.concat(F.lit(" "), F.split_part("c_name", F.lit("#"), F.lit(2)), F.lit("  ")))
    code = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.substring("c_mktsegment", 1, 3))
    return c.select("c_custkey", trimmed(first).alias("forename"), trimmed(last).alias("surname"),
                    blank_to_null(code).alias("code"), full_name(first, last).alias("full_name"))


# --------------------------------------------------------------------------
# analyses
# --------------------------------------------------------------------------

def _customer_year_values(spark: SparkSession, d: str) -> DataFrame:
    """Order value per (customer, year), aggregated *before* the customer
    join: the join then moves one row per customer-year instead of one per
    order, and a customer holding a large share of all orders arrives as a
    handful of rows rather than a skewed partition.  Value without a known
    customer stays, under the NULL nation.  Stored once: its users read it
    more than once."""
    o = read_table(spark, d, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    per = (o.groupBy("o_custkey", F.year("o_orderdate").alias("year"))
           .agg(units_sum(money_units("o_totalprice"), 2).alias("cust_value")))
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    return _stored(per.join(c, per["o_custkey"] == c["c_custkey"], "left").drop("c_custkey"), "customer_years")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the session's shared scratch folder and read back."""
    path = scratch_dir(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def leader_by_decade(spark: SparkSession, d: str) -> DataFrame:
    """Yearly order value per nation; the year's leader(s) (rank 1, ties
    kept); years led per nation (NULL: customers of no known nation) and decade."""
    rev = (_customer_year_values(spark, d)
           .groupBy("c_nationkey", "year")
           .agg(exact_sum("cust_value", 2).alias("revenue")))
    leaders = period_leaders(rev, ["c_nationkey"], ["year"], "revenue")
    counts = count_by_bucket(leaders, ["c_nationkey"], (F.floor(F.col("year") / 10) * 10).cast("int"),
                             "decade", "years_led")
    n = read_table(spark, d, "nation", ["n_nationkey", "n_name"])
    return (counts.join(n, counts["c_nationkey"] == n["n_nationkey"], "left")
            .select("decade", "c_nationkey", "n_name", "years_led"))


# Event types counted per user, with their output names.
EVENT_COUNTS = {"purchase": "purchases", "click": "clicks", "view": "views",
                "error": "errors", "signup": "signups"}


def entity_records(spark: SparkSession, d: str) -> DataFrame:
    """Top 20 users by purchases (user id breaks ties) with their counts per
    event type and value total."""
    ev = read_table(spark, d, "events", ["user_id", "event_type", "value"])
    return entity_records_op(ev, "user_id", "event_type", EVENT_COUNTS,
                             value_col="value", value_name="total_value",
                             rank_by=["purchases"], top_k=20)


def _order_values(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_extendedprice", "l_discount"])
    # price x (1 - discount) in units of 10^-4: cents x (100 - discount in hundredths)
    value_units = money_units("l_extendedprice") * (F.lit(100) - money_units("l_discount"))
    per = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("line_count"),
                                       units_sum(value_units, 4).alias("order_value"))
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    # an order without lines has a count and a value of 0, not no row
    return o.join(per, per["l_orderkey"] == o["o_orderkey"], "left").select(
        "o_orderkey", "o_custkey", F.coalesce("line_count", F.lit(0).cast("bigint")).alias("line_count"),
        F.coalesce("order_value", F.lit(0).cast("decimal(38,4)")).alias("order_value"))


def deep_dive(spark: SparkSession, d: str) -> DataFrame:
    """Each order's value beside its customer's mean order value."""
    values = _stored(_order_values(spark, d), "order_values")  # read for the means and for the rows
    return compare_to_group_mean(values, ["o_custkey"], "order_value",
                                 mean_name="cust_mean_value", delta_name="vs_cust_mean") \
        .select("o_orderkey", "o_custkey", "line_count", "order_value", "cust_mean_value", "vs_cust_mean")


def deep_dive_by_lines(spark: SparkSession, d: str) -> DataFrame:
    """Mean order value by number of lines (the pit-stop-count view)."""
    return mean_by_bucket(_order_values(spark, d), "line_count", "order_value",
                          count_name="orders", mean_name="mean_order_value")


def share_of_group(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's share of its nation's yearly order value, beside the
    nation's rank that year."""
    vals = _customer_year_values(spark, d)
    out = share_of_group_op(vals, ["o_custkey"], ["c_nationkey"], ["year"], "cust_value",
                            group_total_name="nation_value", share_name="share", rank_name="nation_rank")
    return out.select("o_custkey", "c_nationkey", "year", "cust_value", "nation_value", "share", "nation_rank")


# --------------------------------------------------------------------------
# ingestion and export
# --------------------------------------------------------------------------

# The control table of the ingestion fixture.  The region file is
# landed under a mixed-case name and '|'-delimited; no supplier file is landed.
INGEST_CONTROL = [
    ("region", "CSV", "bronze_region", "|"),
    ("Nation", "csv", "bronze_nation", ","),
    ("supplier", "csv", "bronze_supplier", ","),
]


def _land_and_ingest(spark: SparkSession, d: str, runs: int = 1):
    root = scratch_dir(spark, "ingest")
    landing = f"{root}/landing"
    export(read_table(spark, d, "region"), f"{landing}/Region.csv", sep="|")
    export(read_table(spark, d, "nation"), f"{landing}/nation.csv", sep=",")
    control = spark.createDataFrame(INGEST_CONTROL, CONTROL_SCHEMA)
    results = [ingest(spark, control, landing, f"{root}/bronze", ledger=f"{root}/ledger")
               for _ in range(runs)]
    return root, results


def ingest_csv(spark: SparkSession, d: str) -> DataFrame:
    """region and nation landed as delimited files, ingested through the
    control table (schema inferred, as the bronze load does), and read back
    from bronze: nation with its region name."""
    root, _ = _land_and_ingest(spark, d)
    n = read_current(spark, f"{root}/bronze/bronze_nation")
    r = read_current(spark, f"{root}/bronze/bronze_region")
    return (n.join(r, n["n_regionkey"] == r["r_regionkey"], "left")
            .select("n_nationkey", "n_name", "n_regionkey", "r_name"))


def ingest_audit(spark: SparkSession, d: str) -> DataFrame:
    """Audit rows of two consecutive runs over the same landing folder: the
    second run finds everything already loaded."""
    _, results = _land_and_ingest(spark, d, runs=2)
    out = None
    for i, res in enumerate(results, start=1):
        a = res.audit.select(F.lit(i).alias("run"), "*")
        out = a if out is None else out.unionByName(a)
    return out


def export_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """supplier exported as CSV with a header, then read back with the
    table's declared schema."""
    s = read_table(spark, d, "supplier")
    path = f"{scratch_dir(spark, 'export')}/supplier"
    export(s, path, fmt="csv", header=True)
    return spark.read.schema(s.schema).option("header", "true").csv(path)


def ingest_stream(spark: SparkSession, d: str) -> DataFrame:
    """nation delivered to a landing folder in two drops (the nations of
    regions below 3, then the rest) and picked up by three incremental
    streaming runs; the third finds nothing new.  The bronze table ends up
    holding every nation exactly once."""
    root = scratch_dir(spark, "stream")
    nation = read_table(spark, d, "nation")
    first = F.col("n_regionkey") < 3
    sink, ckpt = f"{root}/bronze_nation", f"{root}/_checkpoint"
    glob = f"{root}/landing/*/*.csv"
    export(nation.where(first), f"{root}/landing/drop1")
    stream_landing(spark, glob, nation.schema, sink, ckpt)
    export(nation.where(~first | F.col("n_regionkey").isNull()), f"{root}/landing/drop2")
    stream_landing(spark, glob, nation.schema, sink, ckpt)
    stream_landing(spark, glob, nation.schema, sink, ckpt)
    return spark.read.parquet(sink)


# --------------------------------------------------------------------------
# composite keys, merge variants, sinks
# --------------------------------------------------------------------------

def composite_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """Every line beside the roll-up of its order's lines from the same
    supplier (a two-column key), 0 lines where there is no such roll-up."""
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_quantity"])
    per = rollup_children(li.where(F.col("l_returnflag") != "R"), ["l_orderkey", "l_suppkey"],
                          F.floor("l_quantity").cast("int"), count_name="kept_lines", sum_name="kept_qty",
                          sum_type="bigint", avg_name=None)
    out = assemble_fact(li, enrichments=[Enrichment(
        per, {"l_orderkey": "l_orderkey", "l_suppkey": "l_suppkey"},
        {"kept_lines": "kept_lines", "kept_qty": "kept_qty"}, defaults={"kept_lines": 0})])
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "kept_lines", "kept_qty")


def scd1_no_touch(spark: SparkSession, d: str) -> DataFrame:
    """The customer merge into a dimension without an update stamp; rows of
    customers in debt arrive without their natural key and are ignored."""
    target, source = _merge_fixture(spark, d)
    source = source.withColumn("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")))
    return _merge(target.drop("dw_updated_at"), source, touch_col=None)


def calendar_season(spark: SparkSession, d: str) -> DataFrame:
    """Calendar whose season comes from the source: the smallest year, less
    the number of the customer's region, of the orders on that date."""
    o = read_table(spark, d, "orders", ["o_custkey", "o_orderdate"])
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    rows = o.join(c, o["o_custkey"] == c["c_custkey"], "left").select(
        F.col("o_orderdate").cast("date").alias("full_date"),
        (F.year("o_orderdate") - F.coalesce("c_nationkey", F.lit(0)) % 5).alias("season_year"))
    return calendar_dimension(rows, season_col="season_year")


def calendar_append(spark: SparkSession, d: str) -> DataFrame:
    """The ship-date calendar stored, the order dates not yet in it appended
    (only the new rows are written), and the table read back."""
    path = scratch_dir(spark, "calendar")
    existing = calendar_dimension(
        read_table(spark, d, "lineitem", ["l_shipdate"])
        .select(F.col("l_shipdate").cast("date").alias("full_date")))
    write_table(existing, path)
    stored = spark.read.schema(existing.schema).parquet(path)
    append_rows(insert_if_absent(calendar(spark, d), stored, ["date_key"]), path, existing.schema)
    return spark.read.schema(existing.schema).parquet(path)


def full_refresh(spark: SparkSession, d: str) -> DataFrame:
    """supplier stored without balances, then refreshed whole as a new
    version; readers get the newest one."""
    base = scratch_dir(spark, "supplier")
    s = read_table(spark, d, "supplier")
    write_version(s.select("s_suppkey", "s_name"), base)
    write_version(s, base)
    return read_current(spark, base)


# A declared layout, and one whose column the landed file lacks.
DECLARED = {"bronze_customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DECIMAL(12,2)",
            "bronze_nation": "n_nationkey INT, n_anthem STRING"}


def _ingest_declared(spark: SparkSession, d: str):
    """customer landed with its columns in another order and more of them than
    declared; nation landed without a declared column."""
    root = scratch_dir(spark, "declared")
    landing = f"{root}/landing"
    c = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal"])
    export(c.select("c_name", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"), "c_custkey",
                    "c_nationkey"), f"{landing}/customer.csv")
    export(read_table(spark, d, "nation"), f"{landing}/nation.csv")
    control = spark.createDataFrame([("customer", "csv", "bronze_customer", ","),
                                     ("nation", "csv", "bronze_nation", ",")], CONTROL_SCHEMA)
    schemas = {name: StructType.fromDDL(ddl) for name, ddl in DECLARED.items()}
    return root, ingest(spark, control, landing, f"{root}/bronze", schemas=schemas)


def ingest_declared(spark: SparkSession, d: str) -> DataFrame:
    """The declared columns of the reordered, wider file, found by name."""
    root, _ = _ingest_declared(spark, d)
    return read_current(spark, f"{root}/bronze/bronze_customer")


def ingest_failing(spark: SparkSession, d: str) -> DataFrame:
    """The audit of that run: one source fails, the other loads."""
    return _ingest_declared(spark, d)[1].audit


QUERIES = {
    "star_fact": star_fact,
    "star_fact_required": star_fact_required,
    "star_fact_reload": star_fact_reload,
    "fact_quarantine": fact_quarantine,
    "child_rollup": child_rollup,
    "calendar": calendar,
    "calendar_new_only": calendar_new_only,
    "date_normalise": date_normalise,
    "race_style_lookup": race_style_lookup,
    "scd1_customer": scd1_customer,
    "scd1_changed_only": scd1_changed_only,
    "scd1_idempotent": scd1_idempotent,
    "surrogate_keys": surrogate_keys,
    "lap_time_ms": lap_times,
    "best_of_three": best_of_three,
    "positions_gained": positions_gained,
    "try_cast_suite": try_cast_suite,
    "clean_names": clean_names,
    "leader_by_decade": leader_by_decade,
    "entity_records": entity_records,
    "deep_dive": deep_dive,
    "deep_dive_by_lines": deep_dive_by_lines,
    "share_of_group": share_of_group,
    "ingest_csv": ingest_csv,
    "ingest_audit": ingest_audit,
    "export_roundtrip": export_roundtrip,
    "ingest_stream": ingest_stream,
    "composite_enrichment": composite_enrichment,
    "scd1_no_touch": scd1_no_touch,
    "calendar_season": calendar_season,
    "calendar_append": calendar_append,
    "full_refresh": full_refresh,
    "ingest_declared": ingest_declared,
    "ingest_failing": ingest_failing,
}
