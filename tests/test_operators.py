"""Operator invariants: surrogate keys, lookups, quarantine, SCD1 merge,
calendar, roll-ups, fact assembly, targeted reload, analyses."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import (
    Enrichment,
    Lookup,
    assemble_fact,
    assign_surrogate_keys,
    calendar_dimension,
    compare_to_group_mean,
    entity_records,
    insert_if_absent,
    period_leaders,
    quarantine,
    replace_keys,
    rollup_children,
    scd1_merge,
    share_of_group,
)

TS1 = "2024-01-01 00:00:00"
TS2 = "2024-02-01 00:00:00"


# ---------------------------------------------------------------- keys
def test_surrogate_keys_distributed_equals_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("k")).distinct()
    dist = assign_surrogate_keys(df, ["k"], "sk", start=100)
    ref = df.withColumn("sk", 100 + F.row_number().over(Window.orderBy("k")))
    assert sorted(map(tuple, dist.collect())) == sorted(map(tuple, ref.collect()))
    # stable on recomputation
    assert sorted(map(tuple, dist.collect())) == sorted(map(tuple, dist.collect()))


def test_surrogate_keys_string_and_composite_keys(spark):
    df = spark.createDataFrame([("b", 2), ("a", 9), ("b", 1), ("c", 0)], "s string, n int")
    small = assign_surrogate_keys(df, ["s", "n"], "sk")
    big = assign_surrogate_keys(df, ["s", "n"], "sk")
    expect = {("a", 9): 1, ("b", 1): 2, ("b", 2): 3, ("c", 0): 4}
    for out in (small, big):
        assert {(r["s"], r["n"]): r["sk"] for r in out.collect()} == expect


def test_lookup_and_quarantine(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, 99), (4, None)], "id int, nk int")
    dim = spark.createDataFrame([(10, 100, 7), (20, 200, 8)], "nk int, sk bigint, parent int")
    parent = spark.createDataFrame([(7, 70)], "parent int, parent_sk bigint")
    out = assemble_fact(fact, lookups=[
        Lookup(dim, {"nk": "nk"}, {"sk": "sk", "parent": "parent"}),
        Lookup(parent, {"parent": "parent"}, {"parent_sk": "parent_sk"}),
    ])
    assert out.count() == 4
    good, bad = quarantine(out, ["sk", "parent_sk"])
    assert sorted(r["id"] for r in good.collect()) == [1]
    reasons = {r["id"]: r["unresolved"] for r in bad.collect()}
    assert reasons == {2: "parent_sk", 3: "sk,parent_sk", 4: "sk,parent_sk"}


def test_lookup_and_enrichment_raise_on_repeated_keys(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20)], "id int, nk int")
    doubled = spark.createDataFrame([(10, 1), (10, 2), (None, 3), (None, 4)], "nk int, sk bigint")
    for out in (assemble_fact(fact, lookups=[Lookup(doubled, {"nk": "nk"}, {"sk": "sk"})]),
                assemble_fact(fact, enrichments=[Enrichment(doubled, {"nk": "nk"}, {"sk": "sk"})])):
        with pytest.raises(Exception, match="duplicate key"):
            out.collect()
    # NULL keys never match, so they may repeat
    nulls = spark.createDataFrame([(10, 1), (None, 3), (None, 4)], "nk int, sk bigint")
    out = assemble_fact(fact, lookups=[Lookup(nulls, {"nk": "nk"}, {"sk": "sk"})])
    assert sorted((r["id"], r["sk"]) for r in out.collect()) == [(1, 1), (2, None)]


def test_key_assignment_raises_on_repeated_keys(spark):
    with pytest.raises(Exception, match="duplicate key"):
        assign_surrogate_keys(spark.createDataFrame([("a",), ("b",), ("a",)], "k string"), ["k"], "sk").collect()


def test_building_a_plan_runs_nothing_but_the_checkpoint(spark):
    """Joins, merges and ranks decide nothing by counting rows beforehand."""
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    fact = spark.range(1000).select(F.col("id").cast("int").alias("id"), (F.col("id") % 7).cast("int").alias("nk"))
    dim = spark.range(7).select(F.col("id").cast("int").alias("nk"), (F.col("id") + 1).alias("sk"))

    def jobs_of(name, build):
        sc.setJobGroup(name, name)
        build()
        sc.setJobGroup("other", "other")
        return len(tracker.getJobIdsForGroup(name))

    assert jobs_of("lookups", lambda: assemble_fact(
        fact, lookups=[Lookup(dim, {"nk": "nk"}, {"sk": "sk"})],
        enrichments=[Enrichment(dim.withColumnRenamed("sk", "x"), {"nk": "nk"}, {"x": "x"})])) == 0
    assert jobs_of("means", lambda: compare_to_group_mean(fact, ["nk"], "id")) == 0
    assert jobs_of("replace", lambda: replace_keys(fact, fact, ["nk"])) == 0
    # the range bounds are sampled, the rows shuffled and stored: no more than that
    target = spark.createDataFrame([], "sk bigint, nk int, dw_inserted_at timestamp, dw_updated_at timestamp")
    assert 0 < jobs_of("merge", lambda: scd1_merge(target, dim.select("nk"), ["nk"], surrogate_key="sk")) <= 6


def test_group_sums_beyond_bigint(spark):
    from starloom.functions import units_sum
    from starloom.operators import mean_by_bucket
    big = spark.range(100).select(F.lit(1).alias("b"), F.lit("99999999999999.9999").cast("decimal(18,4)").alias("v"))
    assert mean_by_bucket(big, "b", "v").first()["mean_value"] == pytest.approx(1e14)
    units = spark.createDataFrame([(9 * 10 ** 18,), (9 * 10 ** 18,), (-5,), (None,)], "u bigint")
    assert units.agg(units_sum("u", 2).alias("s")).first()["s"] == Decimal("179999999999999999.95")
    assert spark.range(0).agg(units_sum("id", 2).alias("s")).first()["s"] is None



# ---------------------------------------------------------------- SCD1
def _target(spark):
    return spark.createDataFrame(
        [(1, 1, "a", "x", None, None), (2, 2, "b", "y", None, None), (3, 3, "c", "z", None, None)],
        "sk bigint, nk int, name string, tag string, dw_inserted_at timestamp_ntz, dw_updated_at timestamp_ntz")


def _source(spark):
    return spark.createDataFrame(
        [(2, "b", None), (3, "C", "z"), (5, "e", "w"), (4, "d", "v"), (None, "q", "q")],
        "nk int, name string, tag string")


def test_scd1_merge_semantics(spark):
    out = scd1_merge(_target(spark), _source(spark), ["nk"], surrogate_key="sk", load_ts=TS1,
                     action_col="act")
    rows = {r["nk"]: r for r in out.collect()}
    assert set(rows) == {1, 2, 3, 4, 5}                      # NULL key ignored
    assert rows[1]["act"] == "kept" and rows[1]["dw_updated_at"] is None
    assert rows[2]["tag"] is None                             # source NULL overwrites
    assert rows[2]["dw_updated_at"] == dt.datetime(2024, 1, 1)  # touched even if unchanged
    assert rows[3]["name"] == "C" and rows[3]["sk"] == 3        # key never changes
    assert (rows[4]["sk"], rows[5]["sk"]) == (4, 5)             # max + rank of natural key
    assert rows[4]["dw_inserted_at"] == dt.datetime(2024, 1, 1) and rows[4]["dw_updated_at"] is None
    assert out.columns == _target(spark).columns + ["act"]


def test_scd1_only_changed_and_idempotent(spark):
    t, s = _target(spark), _source(spark)
    once = scd1_merge(t, s, ["nk"], surrogate_key="sk", load_ts=TS1, only_changed=True)
    twice = scd1_merge(once, s, ["nk"], surrogate_key="sk", load_ts=TS2, only_changed=True,
                       action_col="act")
    acts = {r["nk"]: r["act"] for r in twice.collect()}
    assert acts == {1: "kept", 2: "unchanged", 3: "unchanged", 4: "unchanged", 5: "unchanged"}
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.drop("act").collect()))
    first = {r["nk"]: r for r in
             scd1_merge(t, s, ["nk"], surrogate_key="sk", load_ts=TS1, only_changed=True,
                        action_col="act").collect()}
    assert first[2]["act"] == "updated" and first[3]["act"] == "updated"


def test_scd1_duplicate_source_key_raises(spark):
    dup = spark.createDataFrame([(2, "b", "y"), (2, "bb", "y")], "nk int, name string, tag string")
    with pytest.raises(Exception, match="duplicate key"):
        scd1_merge(_target(spark), dup, ["nk"], surrogate_key="sk", load_ts=TS1).collect()


def test_scd1_into_empty_target(spark):
    empty = spark.createDataFrame([], _target(spark).schema)
    out = scd1_merge(empty, _source(spark), ["nk"], surrogate_key="sk", load_ts=TS1)
    assert sorted((r["nk"], r["sk"]) for r in out.collect()) == [(2, 1), (3, 2), (4, 3), (5, 4)]


# ---------------------------------------------------------------- calendar
def test_calendar_dimension_columns(spark):
    df = spark.createDataFrame([(dt.date(2021, 3, 28), 2021), (dt.date(2021, 3, 28), 2020),
                                (dt.date(2021, 3, 29), 2021), (None, 1999)], "d date, yr int")
    cal = calendar_dimension(df, "d", season_col="yr", season_name="season")
    rows = {r["date_key"]: r for r in cal.collect()}
    assert set(rows) == {20210328, 20210329}                  # one row per date, NULL left out
    sun = rows[20210328]
    assert (sun["month_name"], sun["day_of_week_name"], sun["day_of_week_num"]) == ("March", "Sunday", 1)
    assert sun["is_weekend"] is True and rows[20210329]["is_weekend"] is False
    assert sun["season"] == 2020 and sun["quarter"] == 1
    existing = cal.where(F.col("date_key") == 20210328)
    assert [r["date_key"] for r in insert_if_absent(cal, existing).collect()] == [20210329]


# ---------------------------------------------------------------- roll-ups / facts
def test_rollup_children_decimal_average(spark):
    pits = spark.createDataFrame([(1, 1, 22000), (1, 1, 23001), (1, 2, 25000), (2, 1, 1)],
                                 "race int, drv int, ms int")
    r = {(x["race"], x["drv"]): x for x in
         rollup_children(pits, ["race", "drv"], "ms", sum_type="bigint").collect()}
    assert r[(1, 1)]["child_count"] == 2 and r[(1, 1)]["child_total"] == 45001
    assert r[(1, 1)]["child_avg"] == Decimal("22500.5")


def test_enrichment_fan_out_is_refused(spark):
    base = spark.createDataFrame([(1, 1)], "race int, drv int")
    dup = spark.createDataFrame([(1, 1, 5), (1, 1, 6)], "race int, drv int, pts int")
    with pytest.raises(Exception, match="duplicate key"):
        assemble_fact(base, enrichments=[
            Enrichment(dup, {"race": "race", "drv": "drv"}, {"pts": "pts"})]).collect()


def test_assemble_keeps_every_base_row_and_required_filter(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    child = spark.createDataFrame([(1, 5), (1, 6), (3, 1)], "id int, v int")
    roll = rollup_children(child, ["id"], "v", count_name="n", sum_name="s", avg_name=None)
    en = [Enrichment(roll, {"id": "id"}, {"n": "n", "s": "s"}, defaults={"n": 0}, unique=True)]
    out = assemble_fact(base, enrichments=en)
    assert sorted((r["id"], r["n"], r["s"]) for r in out.collect()) == [(1, 2, 11), (2, 0, None), (3, 1, 1)]
    req = assemble_fact(base, enrichments=en, require=["s"])
    assert sorted(r["id"] for r in req.collect()) == [1, 3]


def test_replace_keys(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2)], "id int, v string, grp int")
    new = spark.createDataFrame([(2, "B", 1), (4, "D", 1), (9, "Z", 3)], "id int, v string, grp int")
    keys = spark.createDataFrame([(1,)], "grp int")
    out = replace_keys(old, new, ["grp"], keys)
    assert sorted(map(tuple, out.collect())) == [(2, "B", 1), (3, "c", 2), (4, "D", 1)]


# ---------------------------------------------------------------- analyses
def test_period_leaders_keeps_ties(spark):
    v = spark.createDataFrame([("a", 2000, 10), ("b", 2000, 10), ("c", 2000, 5), ("a", 2001, 1)],
                              "team string, yr int, pts int")
    out = sorted((r["team"], r["yr"]) for r in period_leaders(v, ["team"], ["yr"], "pts").collect())
    assert out == [("a", 2000), ("a", 2001), ("b", 2000)]


def test_share_and_group_mean_and_topk(spark):
    v = spark.createDataFrame([(1, "x", 2000, Decimal("30.00")), (2, "x", 2000, Decimal("10.00")),
                               (3, "y", 2000, Decimal("50.00"))], "m int, g string, yr int, val decimal(12,2)")
    s = {r["m"]: r for r in share_of_group(v, ["m"], ["g"], ["yr"], "val").collect()}
    assert s[1]["share"] == 0.75 and s[1]["group_rank"] == 2 and s[3]["group_rank"] == 1
    c = {r["m"]: r for r in compare_to_group_mean(v, ["g"], "val").collect()}
    assert c[1]["group_mean"] == 20.0 and c[2]["vs_group_mean"] == -10.0
    ev = spark.createDataFrame([(1, "buy"), (2, "buy"), (2, "buy"), (3, "view"), (1, "view")],
                               "u int, t string")
    top = entity_records(ev, "u", "t", {"buy": "buys", "view": "views"}, rank_by=["buys"], top_k=2)
    assert [(r["u"], r["buys"]) for r in top.collect()] == [(2, 2), (1, 1)]


def test_surrogate_keys_distributed_path_on_table_data(spark):
    from sf_dirs import SF_ORACLE
    c = spark.read.parquet(f"{SF_ORACLE}/customer.parquet").select("c_custkey", "c_mktsegment")
    dist = assign_surrogate_keys(c, ["c_mktsegment", "c_custkey"], "k", start=10)
    ref = c.withColumn("k", 10 + F.row_number().over(Window.orderBy("c_mktsegment", "c_custkey")))
    assert dist.count() == c.count()
    assert sorted(map(tuple, dist.collect())) == sorted(map(tuple, ref.collect()))


def test_join_back_of_a_hot_group_equals_plain_join(spark, distributed_paths):
    from starloom.operators import join_group_values
    # one hot group holding most rows, many cold ones
    units = spark.range(0, 3000).select(
        F.when(F.col("id") < 2000, F.lit(0)).otherwise(F.col("id") % 97).alias("g"),
        F.col("id").alias("u"), (F.col("id") % 13).cast("decimal(12,2)").alias("val"))
    means = units.groupBy("g").agg(F.avg("val").alias("m"))
    got = join_group_values(units, means, ["g"])
    plain = units.join(means, ["g"], "left")
    assert sorted(map(tuple, got.select("g", "u", "m").collect())) == \
        sorted(map(tuple, plain.select("g", "u", "m").collect()))
    assert compare_to_group_mean(units, ["g"], "val").count() == 3000


def test_rank_within_distributed_equals_window_rank(spark):
    from starloom.operators import rank_within
    df = spark.range(0, 4000).select(
        (F.col("id") % 3).alias("p"),
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise((F.col("id") * 7919) % 211).alias("v"),
        F.col("id").alias("row"))
    ref = df.withColumn("r", F.rank().over(Window.partitionBy("p").orderBy(F.col("v").desc())).cast("int"))
    dist = rank_within(df, ["p"], "v", "r")
    assert dist.count() == 4000

    def rows(d):
        return sorted(((r["row"], r["r"]) for r in d.collect()))
    assert rows(dist) == rows(ref)
    asc = rank_within(df, ["p"], "v", "r", descending=False)
    ref_asc = df.withColumn("r", F.rank().over(Window.partitionBy("p").orderBy(F.col("v").asc_nulls_last())).cast("int"))
    assert rows(asc) == rows(ref_asc)


def test_group_values_attach_to_null_group(spark):
    from starloom.operators import join_group_values
    units = spark.createDataFrame([(1, None, 2), (2, None, 4), (3, "x", 10)], "u int, g string, v int")
    means = units.groupBy("g").agg(F.avg("v").alias("m"))
    got = {r["u"]: r["m"] for r in join_group_values(units, means, ["g"]).collect()}
    assert got == {1: 3.0, 2: 3.0, 3: 10.0}
