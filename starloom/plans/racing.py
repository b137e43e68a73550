"""The racing star schema: five dimension loads and the fact load, composed
from the generic operators, plus the run order.

Every load is a function from DataFrames to DataFrames; persisting the result
(a new table version, see ``starloom.sinks.versions.write_version``) is the
caller's step, so a load never overwrites the table it reads.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import (
    DEFAULT_DATE_FORMATS,
    blank_to_null,
    default_zero,
    full_name,
    lap_time_ms,
    least_positive,
    null_tokens_to_null,
    parse_date_any,
    positions_gained,
    safe_cast,
    trimmed,
)
from starloom.operators import (
    Enrichment,
    Lookup,
    assemble_fact,
    assign_surrogate_keys,
    calendar_dimension,
    insert_if_absent,
    max_key,
    quarantine,
    replace_keys,
    rollup_children,
    scd1_merge,
)
from starloom.plans.racing_schemas import (
    BRONZE_TABLES,
    SOURCES,
    TARGETS,
    not_null_columns,
    source_schema,
    target_schema,
)
from starloom.sinks.run_ledger import RunLedger
from starloom.sinks.storage import export, project_to_schema, require_not_null, truncate
from starloom.sinks.versions import (
    append_version,
    current_version,
    read_current,
    read_current_or_none,
    remove_superseded,
    replace_partitions,
    write_version,
)
from starloom.sources.landing import IngestResult, Rejects, ingest, read_bronze

# Date layouts accepted for a driver's date of birth (the race
# date accepts the four of DEFAULT_DATE_FORMATS).
DOB_FORMATS = ("yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy")

FACT_KEYS = ("race_key", "driver_key", "constructor_key", "circuit_key", "date_key")
#: Stored tables whose partitions are replaced one by one, and their columns.
PARTITIONED = {"fact_race_result": "src_race_id"}


def _stamp(load_ts) -> Column:
    if load_ts is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(load_ts, Column):
        return load_ts.cast("timestamp_ntz")
    return F.lit(str(load_ts)).cast("timestamp_ntz")


def empty_target(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], target_schema(name))


def create_silver_tables(spark: SparkSession, base: str, replace: bool = False) -> None:
    """Empty silver tables with their declared columns under ``base``, which
    the loads then read and write.  One that is there already raises unless
    ``replace`` is given, which empties it."""
    for name in TARGETS:
        path = f"{base.rstrip('/')}/{name}"
        if not replace and current_version(spark, path):
            raise FileExistsError(f"table exists: {path}")
        write_version(empty_target(spark, name), path, partition_by=PARTITIONED.get(name))


def clean_bronze(spark: SparkSession, bronze: str, tables: Sequence[str] = BRONZE_TABLES) -> list[str]:
    """Empty every landed bronze table that exists, keeping its schema.
    Returns the tables emptied."""
    done = []
    to_path = "/" in bronze or ":" in bronze
    for t in tables:
        table = read_bronze(spark, bronze, t)
        if table is None:  # never landed
            continue
        if to_path:
            write_version(spark.createDataFrame([], table.schema), f"{bronze.rstrip('/')}/{t}")
        else:
            truncate(spark, f"{bronze}.{t}")
        done.append(t)
    return done


# --------------------------------------------------------------------------
# dimension loads (SCD1)
# --------------------------------------------------------------------------

def load_dim_circuit(circuits: DataFrame, target: DataFrame, load_ts=None) -> DataFrame:
    """Latitude/longitude text straight to DECIMAL(9,6); altitude rounded
    half-up to SMALLINT; unparseable text becomes NULL."""
    src = circuits.select(
        F.col("circuitId").cast("int").alias("circuit_id"),
        F.col("circuitRef").alias("circuit_ref"),
        F.col("name").alias("circuit_name"),
        "location", "country",
        safe_cast(null_tokens_to_null(trimmed("lat")), "decimal(9,6)").alias("latitude"),
        safe_cast(null_tokens_to_null(trimmed("lng")), "decimal(9,6)").alias("longitude"),
        safe_cast(F.round(safe_cast(null_tokens_to_null(trimmed("alt")), "decimal(12,3)"), 0),
                  "smallint", text=False).alias("altitude_m"),
        F.col("url").alias("wikipedia_url"))
    return scd1_merge(target, src, ["circuit_id"], surrogate_key="circuit_key",
                      load_ts=_stamp(load_ts))


def load_dim_constructor(constructors: DataFrame, target: DataFrame, load_ts=None) -> DataFrame:
    src = constructors.select(
        F.col("constructorId").cast("int").alias("constructor_id"),
        F.col("constructorRef").alias("constructor_ref"),
        F.col("name").alias("constructor_name"),
        "nationality",
        F.col("url").alias("wikipedia_url"))
    return scd1_merge(target, src, ["constructor_id"], surrogate_key="constructor_key",
                      load_ts=_stamp(load_ts))


def load_dim_driver(drivers: DataFrame, target: DataFrame, load_ts=None,
                    dob_formats: Sequence[str] = DOB_FORMATS) -> DataFrame:
    """Trimmed names, blank/placeholder code to NULL, full name NULL when a
    part is missing, date of birth as DATE, car number NULL when not a
    TINYINT."""
    src = drivers.select(
        F.col("driverId").cast("int").alias("driver_id"),
        trimmed("driverRef").alias("driver_ref"),
        blank_to_null(null_tokens_to_null("code")).alias("code"),
        full_name("forename", "surname").alias("full_name"),
        trimmed("forename").alias("forename"),
        trimmed("surname").alias("surname"),
        parse_date_any("dob", dob_formats).alias("date_of_birth"),
        "nationality",
        safe_cast("number", "tinyint").alias("car_number"),
        F.col("url").alias("wikipedia_url"))
    return scd1_merge(target, src, ["driver_id"], surrogate_key="driver_key",
                      load_ts=_stamp(load_ts))


def _race_source(races: DataFrame) -> DataFrame:
    """Race rows with the date text parsed once (used for both the stored
    date and the calendar key)."""
    return races.where(F.col("raceId").isNotNull()).withColumn(
        "_race_date", parse_date_any("date", DEFAULT_DATE_FORMATS))


def new_dim_dates(races: DataFrame, target: DataFrame, load_ts=None) -> DataFrame:
    """A calendar row for every race date not yet in the dimension; one row
    per date, season = the smallest race year on that date.  Races whose date
    text does not parse get no row (see ``unparsed_race_dates``)."""
    new = calendar_dimension(_race_source(races).select(F.col("_race_date").alias("full_date"), "year"),
                             season_col="year", season_name="f1_season",
                             load_ts=_stamp(load_ts), stamp_col="dw_inserted_at")
    return project_to_schema(insert_if_absent(new, target, ["date_key"]), target.schema)


def load_dim_date(races: DataFrame, target: DataFrame, load_ts=None) -> DataFrame:
    """The calendar with ``new_dim_dates`` appended."""
    return target.unionByName(new_dim_dates(races, target, load_ts))


def unparsed_race_dates(races: DataFrame) -> DataFrame:
    return _race_source(races).where(F.col("_race_date").isNull()).drop("_race_date")


def load_dim_race(races: DataFrame, dim_circuit: DataFrame, dim_date: DataFrame,
                  target: DataFrame, load_ts=None) -> DataFrame:
    """Race rows with circuit and date keys looked up, merged on race_id (no
    update stamp on this dimension)."""
    src = _race_source(races)
    src = assemble_fact(src, lookups=[
        Lookup(dim_circuit, {"circuitId": "circuit_id"}, {"circuit_key": "circuit_key"}),
        Lookup(dim_date, {"_race_date": "full_date"}, {"date_key": "date_key"}),
    ]).select(
        F.col("raceId").cast("int").alias("race_id"),
        safe_cast("year", "smallint", text=False).alias("season_year"),
        safe_cast("round", "tinyint", text=False).alias("round_number"),
        F.col("name").alias("race_name"),
        F.col("_race_date").alias("race_date"),
        null_tokens_to_null("time").alias("race_time"),
        "circuit_key", "date_key",
        F.col("url").alias("wikipedia_url"))
    return scd1_merge(target, src, ["race_id"], surrogate_key="race_key", touch_col=None,
                      load_ts=_stamp(load_ts))


# --------------------------------------------------------------------------
# fact load
# --------------------------------------------------------------------------

def qualifying_ms(qualifying: DataFrame) -> DataFrame:
    """Session times in ms; a missing or malformed time is 0 when the
    qualifying row exists."""
    return qualifying.select(
        "raceId", "driverId",
        F.col("position").alias("qualifying_position"),
        lap_time_ms("q1", missing="zero").alias("q1_time_ms"),
        lap_time_ms("q2", missing="zero").alias("q2_time_ms"),
        lap_time_ms("q3", missing="zero").alias("q3_time_ms"))


def pit_rollup(pit_stops: DataFrame) -> DataFrame:
    return rollup_children(pit_stops, ["raceId", "driverId"], "milliseconds",
                           count_name="pit_stop_count", sum_name="total_pit_time_ms",
                           sum_type="bigint", avg_name="avg_pit_time_ms",
                           avg_input_type="decimal(10,0)", avg_type="decimal(8,1)")


def load_fact_race_result(results: DataFrame, qualifying: DataFrame, pit_stops: DataFrame,
                          driver_standings: DataFrame, constructors_results: DataFrame,
                          status: DataFrame, dim_race: DataFrame, dim_driver: DataFrame,
                          dim_constructor: DataFrame, dim_circuit: DataFrame,
                          dim_date: DataFrame, *, load_ts=None,
                          require_measure: str | None = "best_qualifying_time_ms",
                          race_ids: DataFrame | Sequence[int] | None = None,
                          existing: DataFrame | None = None,
                          previous: DataFrame | None = None,
                          only_touched: bool = False) -> tuple[DataFrame, ...]:
    """Assemble the race-result fact.

    Returns ``(fact, quarantined)``: rows whose five dimension keys all
    resolve, and rows with at least one unresolved key (never written with
    NULL keys).  ``require_measure`` keeps only rows with a best qualifying
    time (``None`` keeps every result row).  With ``race_ids`` and an
    ``existing`` fact, only those races are rebuilt and replace their old
    rows; all other races stay as they were, but for results that moved into
    the named ones; ``only_touched`` returns ``(rows, quarantined, races)`` of
    the races that change instead (see ``reload_races``).  ``previous`` (an earlier
    version of the fact) keeps result keys stable across full reloads:
    results already keyed keep their key, new ones are numbered above it.
    """
    spark = results.sparkSession
    ids_df = None
    if race_ids is not None:
        ids_df = (race_ids if isinstance(race_ids, DataFrame)
                  else spark.createDataFrame([(int(r),) for r in race_ids], "raceId int"))
        ids_df = ids_df.select(F.col(ids_df.columns[0]).cast("int").alias("raceId")).distinct()
        # every race-keyed input is cut to the chosen races before any
        # aggregate or join, so a reload of a few races reads only their rows
        results, qualifying, pit_stops, driver_standings, constructors_results = (
            t.join(ids_df, "raceId", "left_semi")
            for t in (results, qualifying, pit_stops, driver_standings, constructors_results))
    base = results

    rk = {"raceId": "raceId", "driverId": "driverId"}
    fact = assemble_fact(
        base,
        enrichments=[
            Enrichment(qualifying_ms(qualifying), rk,
                       {"qualifying_position": "qualifying_position", "q1_time_ms": "q1_time_ms",
                        "q2_time_ms": "q2_time_ms", "q3_time_ms": "q3_time_ms"}),
            Enrichment(pit_rollup(pit_stops), rk,
                       {"pit_stop_count": "pit_stop_count", "total_pit_time_ms": "total_pit_time_ms",
                        "avg_pit_time_ms": "avg_pit_time_ms"}, unique=True),
            Enrichment(driver_standings, rk,
                       {"points": "driver_champ_points", "position": "driver_champ_position",
                        "wins": "driver_champ_wins"}),
            Enrichment(constructors_results, {"raceId": "raceId", "constructorId": "constructorId"},
                       {"points": "constructor_race_points"}),
        ],
        lookups=[
            Lookup(dim_race, {"raceId": "race_id"},
                   {"race_key": "race_key", "circuit_key": "_race_circuit_key",
                    "date_key": "_race_date_key"}),
            Lookup(dim_driver, {"driverId": "driver_id"}, {"driver_key": "driver_key"}),
            Lookup(dim_constructor, {"constructorId": "constructor_id"},
                   {"constructor_key": "constructor_key"}),
            # transitive: circuit and date reach the fact through the race
            Lookup(dim_circuit, {"_race_circuit_key": "circuit_key"}, {"circuit_key": "circuit_key"}),
            Lookup(dim_date, {"_race_date_key": "date_key"}, {"date_key": "date_key"}),
            Lookup(status, {"statusId": "statusId"}, {"status": "finish_status"}),
        ])
    finish = safe_cast("position", "tinyint")
    fact = fact.select(
        "race_key", "driver_key", "constructor_key", "circuit_key", "date_key",
        F.col("resultId").cast("int").alias("src_result_id"),
        F.col("raceId").cast("int").alias("src_race_id"),
        F.col("driverId").cast("int").alias("src_driver_id"),
        F.col("constructorId").cast("int").alias("src_constructor_id"),
        F.col("qualifying_position").cast("tinyint").alias("qualifying_position"),
        "q1_time_ms", "q2_time_ms", "q3_time_ms",
        least_positive("q1_time_ms", "q2_time_ms", "q3_time_ms").alias("best_qualifying_time_ms"),
        F.col("grid").cast("tinyint").alias("grid_position"),
        finish.alias("finish_position"),
        F.col("positionOrder").cast("tinyint").alias("position_order"),
        F.col("positionText").alias("position_text"),
        safe_cast(null_tokens_to_null("points"), "decimal(5,2)").alias("points_scored"),
        F.col("laps").cast("smallint").alias("laps_completed"),
        safe_cast("milliseconds", "bigint").alias("race_time_ms"),
        "finish_status",
        safe_cast("fastestLap", "smallint").alias("fastest_lap_number"),
        safe_cast("rank", "tinyint").alias("fastest_lap_rank"),
        lap_time_ms("fastestLapTime", missing="null").alias("fastest_lap_time_ms"),
        safe_cast("fastestLapSpeed", "decimal(7,3)").alias("fastest_lap_speed_kph"),
        default_zero("pit_stop_count").cast("tinyint").alias("pit_stop_count"),
        safe_cast("total_pit_time_ms", "int", text=False).alias("total_pit_time_ms"),
        "avg_pit_time_ms",
        F.col("driver_champ_points").cast("decimal(6,2)").alias("driver_champ_points"),
        F.col("driver_champ_position").cast("tinyint").alias("driver_champ_position"),
        F.col("driver_champ_wins").cast("tinyint").alias("driver_champ_wins"),
        F.col("constructor_race_points").cast("decimal(5,2)").alias("constructor_race_points"),
        positions_gained("grid", finish).alias("positions_gained"),
        _stamp(load_ts).alias("dw_inserted_at"))
    if require_measure:
        fact = fact.where(F.col(require_measure).isNotNull())

    good, bad = quarantine(fact, FACT_KEYS)
    if existing is not None and ids_df is not None:
        fresh, touched = reload_races(existing, good, ids_df.withColumnRenamed("raceId", "src_race_id"))
        if only_touched:
            return fresh, bad, touched
        return replace_keys(existing, fresh, ["src_race_id"], touched), bad
    if previous is not None:
        keyed = _result_keys(good, previous)
    else:
        keyed = assign_surrogate_keys(good, ["src_result_id"], "result_key")
    return project_to_schema(keyed, target_schema("fact_race_result")), bad


def reload_races(existing: DataFrame, good: DataFrame,
                 race_keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, races)`` of a targeted reload: the races whose rows change, and
    all their new rows.  Besides the named races those are the ones that a
    result was moved from (results keep their key wherever they move): their
    other rows stay, the moved result leaves."""
    result = good.select("src_result_id").distinct()
    known = existing.join(result, "src_result_id", "left_semi").select("src_race_id")
    touched = race_keys.select("src_race_id").unionByName(known).distinct()
    losing = touched.join(race_keys, "src_race_id", "left_anti")
    staying = (existing.join(losing, "src_race_id", "left_semi")
               .join(result, "src_result_id", "left_anti").select(*existing.columns))
    keyed = project_to_schema(_result_keys(good, existing), target_schema("fact_race_result"))
    return keyed.unionByName(staying), touched


def _result_keys(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Surrogate keys for rebuilt results: a result already in the fact, in
    whichever race, keeps its key (looked up by ``src_result_id``); a new
    result gets one above the fact's largest key."""
    previous = existing.select("src_result_id", "result_key")
    rows = rows.drop("result_key") if "result_key" in rows.columns else rows
    known = rows.join(previous, "src_result_id", "inner")
    fresh = rows.join(previous.select("src_result_id"), "src_result_id", "left_anti")
    fresh = assign_surrogate_keys(fresh, ["src_result_id"], "result_key",
                                  start=max_key(existing, "result_key"))
    return known.unionByName(fresh)


# --------------------------------------------------------------------------
# run order
# --------------------------------------------------------------------------

class SourcesFailed(RuntimeError):
    """A source failed to load, so the silver loads did not start."""

    def __init__(self, result: IngestResult):
        super().__init__(f"sources failed: {', '.join(result.failed)}")
        self.result = result


def run_all(bronze: dict[str, DataFrame], silver: dict[str, DataFrame] | None = None,
            load_ts=None, require_measure: str | None = "best_qualifying_time_ms",
            store: str | None = None, race_ids: Sequence[int] | None = None,
            input_versions: dict[str, int] | None = None,
            ledger: RunLedger | None = None) -> dict[str, DataFrame]:
    """Dependency order: {date, circuit, driver, constructor} -> race -> fact.

    ``silver`` holds the current dimension tables (those in ``store``, or empty
    ones, when absent).  With ``store`` (a folder on shared storage), every load
    is written as a new version of its table under ``store/<name>`` and read
    back before the next load uses it: downstream loads then start from stored
    tables rather than re-running the upstream merges, and a failed load leaves
    the previous version current.  The calendar only gets its new rows, and the
    fact is partitioned by race.

    ``race_ids`` (with ``store``) is a targeted reload: only the partitions of
    those races (and of races that lose a result to them) are written; one that
    yields no row any more leaves the fact.

    ``input_versions`` gives the versions of the bronze tables.  With it and a
    ``ledger``, a step that finished for the same inputs is not run again.
    """
    if race_ids is not None and store is None:
        raise ValueError("a targeted reload needs the stored fact")
    spark = next(iter(bronze.values())).sparkSession
    dims = ("dim_date", "dim_circuit", "dim_driver", "dim_constructor", "dim_race")
    cur = dict(silver or {})
    for name in dims:
        if cur.get(name) is None and store is not None:
            cur[name] = read_current_or_none(spark, f"{store.rstrip('/')}/{name}")
        if cur.get(name) is None:
            cur[name] = empty_target(spark, name)
    if ledger is None and store is not None:
        ledger = RunLedger(spark, f"{store.rstrip('/')}/_runs", store)

    def inputs(tables: Sequence[str], upstream: Sequence[str] = (), **params) -> dict | None:
        if input_versions is None or any(t not in input_versions for t in tables):
            return None
        return {**{t: input_versions[t] for t in tables}, **{u: ledger.version(u) for u in upstream}, **params}

    def whole(name: str, df: DataFrame) -> None:
        if name in TARGETS:
            df = require_not_null(df, not_null_columns(name), name)
        write_version(df, f"{store.rstrip('/')}/{name}", partition_by=PARTITIONED.get(name))

    def keep(name: str, build: Callable[[], DataFrame], told: Callable[[], dict | None]) -> DataFrame:
        if store is None:
            return build()
        return ledger.step(name, told(), lambda: whole(name, build()))

    def store_dates() -> None:
        base = f"{store.rstrip('/')}/dim_date"
        stored = read_current_or_none(spark, base)
        if stored is None:
            return whole("dim_date", load_dim_date(bronze["races"], cur["dim_date"], load_ts))
        fresh = new_dim_dates(bronze["races"], stored, load_ts)
        append_version(require_not_null(fresh, not_null_columns("dim_date"), "dim_date"), base)

    def dates() -> DataFrame:
        if store is None:
            return load_dim_date(bronze["races"], cur["dim_date"], load_ts)
        return ledger.step("dim_date", inputs(["races"]), store_dates)

    # date, circuit, driver and constructor do not depend on each other: with
    # a store they are loaded concurrently (one Spark job stream per thread)
    independent = {
        "dim_date": dates,
        "dim_circuit": lambda: keep("dim_circuit", lambda: load_dim_circuit(
            bronze["circuits"], cur["dim_circuit"], load_ts), lambda: inputs(["circuits"])),
        "dim_driver": lambda: keep("dim_driver", lambda: load_dim_driver(
            bronze["drivers"], cur["dim_driver"], load_ts), lambda: inputs(["drivers"])),
        "dim_constructor": lambda: keep("dim_constructor", lambda: load_dim_constructor(
            bronze["constructors"], cur["dim_constructor"], load_ts), lambda: inputs(["constructors"])),
    }
    out: dict[str, DataFrame] = {}
    with ThreadPoolExecutor(max_workers=len(independent) if store is not None else 1) as pool:
        done = {name: pool.submit(fn) for name, fn in independent.items()}
        for name, fut in done.items():
            out[name] = fut.result()
    # race needs circuit and date; the fact needs all five
    out["dim_race"] = keep("dim_race", lambda: load_dim_race(
        bronze["races"], out["dim_circuit"], out["dim_date"], cur["dim_race"], load_ts),
        lambda: inputs(["races"], ["dim_circuit", "dim_date"]))

    def fact(**kw) -> tuple[DataFrame, ...]:
        return load_fact_race_result(
            bronze["results"], bronze["qualifying"], bronze["pit_stops"], bronze["driver_standings"],
            bronze["constructors_results"], bronze["status"], out["dim_race"], out["dim_driver"],
            out["dim_constructor"], out["dim_circuit"], out["dim_date"], load_ts=load_ts,
            require_measure=require_measure, **kw)

    if store is None:
        out["fact_race_result"], out["fact_quarantine"] = fact()
        out["race_date_quarantine"] = unparsed_race_dates(bronze["races"])
        return out

    def store_fact() -> None:
        base = f"{store.rstrip('/')}/fact_race_result"
        stored = read_current_or_none(spark, base)
        if race_ids is None:
            rows, bad = fact(previous=stored)
            # the rejected rows go first: once the fact is current, the step is as good as done
            whole("fact_quarantine", bad)
            return whole("fact_race_result", rows)
        existing = stored if stored is not None else empty_target(spark, "fact_race_result")
        rows, bad, touched = fact(existing=existing, race_ids=race_ids, only_touched=True)
        whole("fact_quarantine", bad)
        rows = require_not_null(rows, not_null_columns("fact_race_result"), "fact_race_result")
        replace_partitions(rows, base, PARTITIONED["fact_race_result"], touched)

    told = inputs(["results", "qualifying", "pit_stops", "driver_standings", "constructors_results", "status"],
                  dims, require_measure=require_measure, race_ids=sorted(race_ids) if race_ids is not None else None)
    out["fact_race_result"] = ledger.step("fact_race_result", told, store_fact)
    out["fact_quarantine"] = read_current(spark, f"{store.rstrip('/')}/fact_quarantine")
    out["race_date_quarantine"] = keep("race_date_quarantine", lambda: unparsed_race_dates(bronze["races"]),
                                       lambda: inputs(["races"]))
    return out


def run_from_landing(spark: SparkSession, control: DataFrame, landing: str, bronze: str,
                     silver_store: str, *, export_dir: str | None = None, load_ts=None,
                     require_measure: str | None = "best_qualifying_time_ms",
                     race_ids: Sequence[int] | None = None, rejects: Rejects | None = None,
                     allow_drift: Sequence[str] | None = None,
                     keep_versions: int | None = None) -> tuple[IngestResult, dict[str, DataFrame]]:
    """The whole job: ingest landed files into bronze (a folder or a catalog
    database; declared schemas, ledger), load the silver star schema as new
    table versions, and export every silver table as CSV.  Returns the ingest
    audit and the silver tables as loaded.  If a source fails, ``SourcesFailed``
    is raised before any silver table is touched.  ``race_ids`` limits the
    fact load to those races.  With bronze in a folder, a job started again
    after a failure runs only the steps that have not finished for the bronze
    versions at hand.  ``rejects`` and ``allow_drift`` are those of ``ingest``;
    ``keep_versions`` removes older versions of every table once the job is
    done, but for those that a registered reader uses."""
    to_path = "/" in bronze or ":" in bronze
    ledger = f"{(bronze if to_path else silver_store).rstrip('/')}/_ledger"
    res = ingest(spark, control, landing, bronze, ledger=ledger, rejects=rejects, allow_drift=allow_drift,
                 schemas={name: source_schema(name) for name in SOURCES})
    if res.failed:
        raise SourcesFailed(res)
    sources = {}
    for name in SOURCES:
        df = read_bronze(spark, bronze, name)
        sources[name] = df if df is not None else spark.createDataFrame([], source_schema(name))
    versions = {n: current_version(spark, f"{bronze.rstrip('/')}/{n}") for n in SOURCES} if to_path else None
    out = run_all(sources, load_ts=load_ts, require_measure=require_measure, store=silver_store,
                  race_ids=race_ids, input_versions=versions)
    if export_dir:
        for name, df in out.items():
            export(df, f"{export_dir.rstrip('/')}/{name}")
    if keep_versions is not None:
        for name in out:
            remove_superseded(spark, f"{silver_store.rstrip('/')}/{name}", keep_versions)
        for name in SOURCES if to_path else ():
            remove_superseded(spark, f"{bronze.rstrip('/')}/{name}", keep_versions)
    return res, out
