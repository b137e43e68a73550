"""The racing star schema end to end on small hand-made fixtures."""
import datetime as dt
from decimal import Decimal

import pytest

from starloom.plans import racing
from starloom.plans.racing_schemas import source_schema

URL = "http://x"
TS = "2024-01-01 00:00:00"


@pytest.fixture()
def bronze(spark):
    def df(name, rows):
        return spark.createDataFrame(rows, source_schema(name))
    return {
        "circuits": df("circuits", [
            (1, "albert_park", "Albert Park", "Melbourne", "Australia", "-37.8497", "144.968", "10", URL),
            (2, "sepang", "Sepang", "Kuala Lumpur", "Malaysia", "2.76083", "101.738", "18.6", URL),
            (None, "ghost", "Ghost", "-", "-", "0", "0", "0", URL)]),
        "constructors": df("constructors", [
            (1, "mclaren", "McLaren", "British", URL), (2, "ferrari", "Ferrari", "Italian", URL)]),
        "drivers": df("drivers", [
            (1, " hamilton ", "44", "HAM", " Lewis ", "Hamilton ", "1985-01-07", "British", URL),
            (2, "alonso", "\\N", "", "Fernando", "Alonso", "29/07/1981", "Spanish", URL),
            (3, "kubica", "200", "KUB", "Robert", None, "07-12-1984", "Polish", URL)]),
        "races": df("races", [
            (18, 2008, 1, 1, "Australian GP", "2008-03-16", "04:30:00", URL),
            (19, 2008, 2, 2, "Malaysian GP", "23/03/2008", "\\N", URL),
            (20, 2008, 3, 9, "Bahrain GP", "04/06/2008", "11:30:00", URL),
            (21, 2008, 4, 1, "Junk GP", "someday", None, URL),
            (22, 2008, 5, 2, "Twin GP", "03/16/2008", None, URL)]),
        "results": df("results", [
            (1, 18, 1, 1, 1, 1, "1", "1", 1, "10", 58, "5690616", "39", "2", "1:27.452", "218.300"),
            (2, 18, 2, 2, 11, 5, "\\N", "R", 20, "0", 30, "\\N", "", "\\N", "", "\\N"),
            (3, 19, 1, 1, 1, 0, "3", "3", 3, "6", 56, "5700000", "50", "1", "\\N", "200.1"),
            (4, 19, 3, 2, 1, 4, "2", "2", 2, "8", 56, "5690000", "40", "3", "1:36.000", "199.0"),
            (5, 18, 99, 1, 1, 7, "5", "5", 5, "4", 58, "5800000", "30", "5", "1:28.000", "210.0")]),
        "qualifying": df("qualifying", [
            (18, 1, 1, 1, "1:26.572", "1:25.187", "1:26.714"),
            (18, 2, 2, 9, "1:27.000", "\\N", ""),
            (19, 1, 1, 3, "", "1:35.5", None),
            (18, 99, 1, 12, "1:30.000", None, None)]),
        "pit_stops": df("pit_stops", [(18, 1, 22000), (18, 1, 23001), (18, 2, 25000)]),
        "driver_standings": df("driver_standings", [
            (18, 1, Decimal("10"), 1, 1), (18, 2, Decimal("0"), 5, 0),
            (19, 1, Decimal("16"), 1, 1), (19, 3, Decimal("8"), 2, 0)]),
        "constructors_results": df("constructors_results", [
            (18, 1, Decimal("14")), (18, 2, Decimal("0")), (19, 1, Decimal("6")), (19, 2, Decimal("8"))]),
        "status": df("status", [(1, "Finished"), (11, "+1 Lap")]),
    }


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_racing_job(spark, bronze, tmp_dir):
    out = racing.run_all(bronze, load_ts=TS, store=f"{tmp_dir}/silver")
    circ = by(out["dim_circuit"], "circuit_id")
    assert set(circ) == {1, 2}
    assert circ[2]["altitude_m"] == 19 and circ[1]["latitude"] == Decimal("-37.849700")
    drv = by(out["dim_driver"], "driver_id")
    assert drv[1]["driver_ref"] == "hamilton" and drv[1]["full_name"] == "Lewis Hamilton"
    assert drv[1]["date_of_birth"] == dt.date(1985, 1, 7) and drv[1]["car_number"] == 44
    assert drv[2]["code"] is None and drv[2]["car_number"] is None
    assert drv[2]["date_of_birth"] == dt.date(1981, 7, 29)
    assert drv[3]["car_number"] is None and drv[3]["full_name"] is None
    assert [drv[i]["driver_key"] for i in (1, 2, 3)] == [1, 2, 3]

    dates = by(out["dim_date"], "date_key")
    assert set(dates) == {20080316, 20080323, 20080604}
    assert dates[20080316]["f1_season"] == 2008 and dates[20080316]["day_of_week_name"] == "Sunday"

    races = by(out["dim_race"], "race_id")
    assert races[19]["race_date"] == dt.date(2008, 3, 23) and races[19]["race_time"] is None
    assert races[20]["circuit_key"] is None and races[21]["date_key"] is None
    assert races[22]["date_key"] == 20080316
    assert [races[i]["race_key"] for i in (18, 19, 20, 21, 22)] == [1, 2, 3, 4, 5]

    fact = by(out["fact_race_result"], "src_result_id")
    assert set(fact) == {1, 2, 3}                        # 4: no qualifying time; 5: quarantined
    r1, r2, r3 = fact[1], fact[2], fact[3]
    assert (r1["q1_time_ms"], r1["q2_time_ms"], r1["q3_time_ms"]) == (86572, 85187, 86714)
    assert r1["best_qualifying_time_ms"] == 85187 and r1["fastest_lap_time_ms"] == 87452
    assert (r1["pit_stop_count"], r1["total_pit_time_ms"], r1["avg_pit_time_ms"]) == (2, 45001, Decimal("22500.5"))
    assert r1["positions_gained"] == 0 and r1["finish_status"] == "Finished"
    assert r1["driver_champ_points"] == Decimal("10.00") and r1["constructor_race_points"] == Decimal("14.00")
    assert r2["finish_position"] is None and r2["fastest_lap_time_ms"] is None
    assert (r2["q2_time_ms"], r2["q3_time_ms"], r2["best_qualifying_time_ms"]) == (0, 0, 87000)
    assert r2["race_time_ms"] is None and r2["positions_gained"] is None
    assert r3["pit_stop_count"] == 0 and r3["avg_pit_time_ms"] is None and r3["positions_gained"] is None
    assert r3["best_qualifying_time_ms"] == 95500 and r3["circuit_key"] == circ[2]["circuit_key"]
    assert sorted(r["result_key"] for r in fact.values()) == [1, 2, 3]
    bad = out["fact_quarantine"].collect()
    assert [(r["src_result_id"], r["unresolved"]) for r in bad] == [(5, "driver_key")]
    assert out["fact_race_result"].columns == [f.name for f in
                                               racing.target_schema("fact_race_result").fields]


def test_racing_keep_all_results(spark, bronze):
    out = racing.run_all(bronze, load_ts=TS, require_measure=None)
    fact = by(out["fact_race_result"], "src_result_id")
    assert set(fact) == {1, 2, 3, 4} and fact[4]["q1_time_ms"] is None


def test_racing_rerun_is_idempotent_and_reload_targets_races(spark, bronze, tmp_dir):
    store = f"{tmp_dir}/silver"
    first = racing.run_all(bronze, load_ts=TS, store=store)
    silver = {k: v for k, v in first.items() if k.startswith("dim_")}
    second = racing.run_all(bronze, silver=silver, load_ts="2024-02-01 00:00:00", store=store)
    # the first run's versions are still readable next to the second's
    assert first["dim_driver"].count() == second["dim_driver"].count() == 3
    # a result that arrives later with a lower id does not shift existing keys
    late = dict(bronze)
    late["results"] = bronze["results"].union(spark.createDataFrame(
        [(0, 18, 3, 2, 1, 9, "6", "6", 6, "1", 58, "5900000", "25", "7", "1:29.000", "205.0")],
        bronze["results"].schema))
    late["qualifying"] = bronze["qualifying"].union(spark.createDataFrame(
        [(18, 3, 2, 15, "1:31.000", None, None)], bronze["qualifying"].schema))
    third = racing.run_all(late, silver={k: v for k, v in second.items() if k.startswith("dim_")},
                           load_ts=TS, store=store)
    before = {r["src_result_id"]: r["result_key"] for r in first["fact_race_result"].collect()}
    after = {r["src_result_id"]: r["result_key"] for r in third["fact_race_result"].collect()}
    assert all(after[i] == k for i, k in before.items()) and after[0] == max(before.values()) + 1
    for name in ("dim_circuit", "dim_driver", "dim_constructor"):
        a = sorted(tuple(r) for r in first[name].drop("dw_updated_at").collect())
        b = sorted(tuple(r) for r in second[name].drop("dw_updated_at").collect())
        assert a == b, name
    assert first["dim_date"].count() == second["dim_date"].count() == 3
    assert sorted(r["race_key"] for r in second["dim_race"].collect()) == [1, 2, 3, 4, 5]

    old = first["fact_race_result"]
    changed = dict(bronze)
    changed["pit_stops"] = bronze["pit_stops"].union(
        bronze["pit_stops"].sparkSession.createDataFrame([(19, 1, 30000)], bronze["pit_stops"].schema))
    new, _ = racing.load_fact_race_result(
        changed["results"], changed["qualifying"], changed["pit_stops"], changed["driver_standings"],
        changed["constructors_results"], changed["status"], first["dim_race"], first["dim_driver"],
        first["dim_constructor"], first["dim_circuit"], first["dim_date"], load_ts=TS,
        race_ids=[19], existing=old)
    rows = by(new, "src_result_id")
    assert set(rows) == {1, 2, 3}
    assert rows[3]["pit_stop_count"] == 1 and rows[1]["pit_stop_count"] == 2
    olds = by(old, "src_result_id")
    assert all(rows[i]["result_key"] == olds[i]["result_key"] for i in (1, 2, 3))


def test_run_from_landing_end_to_end(spark, bronze, tmp_dir):
    import os
    from starloom.sinks.storage import export
    from starloom.sources.landing import CONTROL_SCHEMA
    landing = f"{tmp_dir}/landing"
    for name, df in bronze.items():
        export(df, f"{landing}/{name}.csv")
    control = spark.createDataFrame([(n, "csv", n, ",") for n in bronze] + [("seasons", "csv", "seasons", ",")],
                                    CONTROL_SCHEMA)
    res, out = racing.run_from_landing(spark, control, landing, f"{tmp_dir}/bronze", f"{tmp_dir}/silver",
                                       export_dir=f"{tmp_dir}/export", load_ts=TS)
    assert sorted(res.loaded) == sorted(f"{n}.csv" for n in bronze) and res.skipped == ["seasons.csv"]
    assert sorted(r["src_result_id"] for r in out["fact_race_result"].collect()) == [1, 2, 3]
    assert os.path.isdir(f"{tmp_dir}/export/fact_race_result")
    back = spark.read.option("header", "true").csv(f"{tmp_dir}/export/dim_driver")
    assert back.count() == 3
    # second run: nothing new landed, silver taken from the store, same fact
    res2, out2 = racing.run_from_landing(spark, control, landing, f"{tmp_dir}/bronze", f"{tmp_dir}/silver",
                                         load_ts=TS)
    assert res2.loaded == []
    assert sorted(r["result_key"] for r in out2["fact_race_result"].collect()) == [1, 2, 3]
    assert out2["dim_driver"].count() == 3


def test_racing_job_on_full_scale_paths(spark, bronze, tmp_dir, distributed_paths):
    """Same results when every join shuffles and keys come from the
    checkpointed range-partition path."""
    out = racing.run_all(bronze, load_ts=TS, store=f"{tmp_dir}/silver")
    fact = by(out["fact_race_result"], "src_result_id")
    assert set(fact) == {1, 2, 3}
    assert sorted(r["result_key"] for r in fact.values()) == [1, 2, 3]
    assert fact[1]["avg_pit_time_ms"] == Decimal("22500.5") and fact[3]["best_qualifying_time_ms"] == 95500
    races = by(out["dim_race"], "race_id")
    assert [races[i]["race_key"] for i in (18, 19, 20, 21, 22)] == [1, 2, 3, 4, 5]
    assert [(r["src_result_id"], r["unresolved"]) for r in out["fact_quarantine"].collect()] == [(5, "driver_key")]


def test_targeted_reload_of_the_stored_fact(spark, bronze, tmp_dir):
    store = f"{tmp_dir}/silver"
    first = racing.run_all(bronze, load_ts=TS, store=store)
    assert {r["src_race_id"] for r in first["fact_race_result"].collect()} == {18, 19}
    more = dict(bronze)
    # a result that was not there before: Alonso classified in race 19
    more["results"] = bronze["results"].where("raceId <> 18").union(spark.createDataFrame(
        [(6, 19, 2, 2, 1, 6, "4", "4", 4, "5", 56, "5800000", "20", "6", "1:37.000", "190.0")],
        bronze["results"].schema))
    more["qualifying"] = bronze["qualifying"].union(spark.createDataFrame(
        [(19, 2, 2, 6, "1:36.900", None, None)], bronze["qualifying"].schema))
    silver = {n: first[n] for n in first if n.startswith("dim_")}
    only_19 = racing.run_all(more, silver, load_ts=TS, store=store, race_ids=[19])["fact_race_result"]
    rows = by(only_19, "src_result_id")
    assert set(rows) == {1, 2, 3, 6}           # race 18 as it was, though withdrawn by now
    assert rows[3]["result_key"] == 3          # an existing result keeps its key
    assert rows[6]["result_key"] == 4          # a new one goes above the stored max
    # race 18 yields no row any more: its rows leave the fact
    both = racing.run_all(more, silver, load_ts=TS, store=store, race_ids=[18, 19])["fact_race_result"]
    assert {r["src_race_id"] for r in both.collect()} == {19}
    with pytest.raises(ValueError):
        racing.run_all(bronze, race_ids=[18])


def test_doubled_status_raises_instead_of_doubling_results(spark, bronze, tmp_dir):
    doubled = dict(bronze, status=bronze["status"].union(bronze["status"]))
    with pytest.raises(Exception, match="duplicate key"):
        racing.run_all(doubled, load_ts=TS, store=f"{tmp_dir}/silver")


def test_failed_source_stops_the_job_and_catalog_equals_path(spark, bronze, tmp_dir):
    from starloom.sinks.storage import export
    from starloom.sinks.versions import read_current_or_none
    from starloom.sources.landing import CONTROL_SCHEMA
    landing = f"{tmp_dir}/landing"
    for name, df in bronze.items():
        export(df.select(*reversed(df.columns)), f"{landing}/{name}.csv")
    control = spark.createDataFrame([(n, "csv", n, ",") for n in bronze], CONTROL_SCHEMA)
    runs = [racing.run_from_landing(spark, control, landing, target, f"{tmp_dir}/silver-{i}", load_ts=TS)[1]
            for i, target in enumerate((f"{tmp_dir}/bronze", "bronze_racing_test"))]
    for name in runs[0]:
        one, two = (sorted(map(str, out[name].collect())) for out in runs)
        assert one == two, name
    export(bronze["status"].withColumnRenamed("status", "state"), f"{landing}/status.csv")
    with pytest.raises(racing.SourcesFailed):
        racing.run_from_landing(spark, control, landing, f"{tmp_dir}/bronze2", f"{tmp_dir}/silver-9", load_ts=TS)
    assert read_current_or_none(spark, f"{tmp_dir}/silver-9/dim_date") is None


def test_command_line_job(spark, bronze, tmp_dir, capsys):
    from starloom.__main__ import main
    from starloom.sinks.storage import export
    landing = f"{tmp_dir}/landing"
    for name, df in bronze.items():
        export(df, f"{landing}/{name}.csv")
    with open(f"{tmp_dir}/control.csv", "w") as f:
        f.write("file_name,file_type,target_table,file_delimiter\n")
        for name in bronze:
            f.write(f"{name},csv,{name},\",\"\n")
    rc = main(["racing", "--control", f"{tmp_dir}/control.csv", "--landing", landing,
               "--bronze", f"{tmp_dir}/bronze", "--silver", f"{tmp_dir}/silver",
               "--export", f"{tmp_dir}/export", "--load-ts", TS])
    assert rc == 0
    assert "failed=[]" in capsys.readouterr().out
    assert spark.read.option("header", "true").csv(f"{tmp_dir}/export/fact_race_result").count() == 3


def test_racing_analyses(spark, bronze, tmp_dir):
    from starloom.plans import racing_analyses as ra
    out = racing.run_all(bronze, load_ts=TS, store=f"{tmp_dir}/silver", require_measure=None)
    fact, races = out["fact_race_result"], out["dim_race"]
    dom = ra.constructor_dominance(fact, races, out["dim_constructor"]).collect()
    # 2008: McLaren 10+6, Ferrari 0+8 -> McLaren leads the 2000s once
    assert [(r["decade"], r["constructor_name"], r["seasons_led"]) for r in dom] == [(2000, "McLaren", 1)]
    rec = {r["full_name"]: r for r in ra.driver_records(fact, out["dim_driver"]).collect()}
    assert rec["Lewis Hamilton"]["wins"] == 1 and rec["Lewis Hamilton"]["poles"] == 1
    assert rec["Lewis Hamilton"]["fastest_laps"] == 1
    assert len(rec) == fact.select("driver_key").distinct().count()  # drivers without any are listed too
    dive = {(r["race_key"], r["driver_key"]): r for r in ra.race_deep_dive(fact).collect()}
    assert len(dive) == 4
    ham18 = dive[(races.where("race_id = 18").first()["race_key"], 1)]
    assert ham18["positions_gained"] == 0 and ham18["pace_delta_ms"] == 87452 - 85187
    pits = {r["pit_stop_count"]: r for r in ra.gain_by_pit_stops(fact).collect()}
    assert pits[2]["results"] == 1
    share = {(r["driver_key"], r["season"]): r for r in ra.driver_or_car(fact, races).collect()}
    ham = share[(1, 2008)]
    assert ham["share_of_constructor"] == 1.0 and ham["constructor_rank"] == 1
