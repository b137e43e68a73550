"""Declared schemas of the racing sources (bronze) and silver targets.

Source columns (the ones the loads read, in file order) are text wherever the
loads cast, try-cast or parse them; the targets follow the silver DDL.
Declaring them avoids schema inference (an extra pass over each file, and
wrong guesses such as a time of day read as a timestamp).  Kept as DDL text;
``source_schema`` / ``target_schema`` parse them (a session must exist).
"""

from pyspark.sql.types import StructType


# Source column names (as the landed files name them) and the
# silver table layouts (column names and types), which downstream readers
# depend on.
SOURCES: dict[str, str] = {
    "circuits": ("circuitId INT, circuitRef STRING, name STRING, location STRING, country STRING, "
        "lat STRING, lng STRING, alt STRING, url STRING"),
    "constructors": ("constructorId INT, constructorRef STRING, name STRING, nationality STRING, url STRING"),
    "drivers": ("driverId INT, driverRef STRING, number STRING, code STRING, forename STRING, "
        "surname STRING, dob STRING, nationality STRING, url STRING"),
    "races": ("raceId INT, year INT, round INT, circuitId INT, name STRING, date STRING, "
        "time STRING, url STRING"),
    "results": ("resultId INT, raceId INT, driverId INT, constructorId INT, statusId INT, grid INT, "
        "position STRING, positionText STRING, positionOrder INT, points STRING, laps INT, "
        "milliseconds STRING, fastestLap STRING, rank STRING, fastestLapTime STRING, "
        "fastestLapSpeed STRING"),
    "qualifying": ("raceId INT, driverId INT, constructorId INT, position INT, q1 STRING, q2 STRING, "
        "q3 STRING"),
    "pit_stops": ("raceId INT, driverId INT, milliseconds INT"),
    "driver_standings": ("raceId INT, driverId INT, points DECIMAL(6,2), position INT, wins INT"),
    "constructors_results": ("raceId INT, constructorId INT, points DECIMAL(5,2)"),
    "status": ("statusId INT, status STRING"),
}

DIM_DRIVER = ("driver_key BIGINT, driver_id INT NOT NULL, driver_ref STRING, code STRING, full_name STRING, "
    "forename STRING, surname STRING, date_of_birth DATE, nationality STRING, "
    "car_number TINYINT, wikipedia_url STRING, dw_inserted_at TIMESTAMP_NTZ, "
    "dw_updated_at TIMESTAMP_NTZ")

DIM_CONSTRUCTOR = ("constructor_key BIGINT, constructor_id INT NOT NULL, constructor_ref STRING, "
    "constructor_name STRING, nationality STRING, wikipedia_url STRING, "
    "dw_inserted_at TIMESTAMP_NTZ, dw_updated_at TIMESTAMP_NTZ")

DIM_CIRCUIT = ("circuit_key BIGINT, circuit_id INT NOT NULL, circuit_ref STRING, circuit_name STRING, "
    "location STRING, country STRING, latitude DECIMAL(9,6), longitude DECIMAL(9,6), "
    "altitude_m SMALLINT, wikipedia_url STRING, dw_inserted_at TIMESTAMP_NTZ, "
    "dw_updated_at TIMESTAMP_NTZ")

DIM_DATE = ("date_key INT NOT NULL, full_date DATE NOT NULL, year SMALLINT, quarter TINYINT, month_num TINYINT, "
    "month_name STRING, day_of_month TINYINT, day_of_week_num TINYINT, "
    "day_of_week_name STRING, is_weekend BOOLEAN, f1_season SMALLINT, "
    "dw_inserted_at TIMESTAMP_NTZ")

DIM_RACE = ("race_key BIGINT, race_id INT NOT NULL, season_year SMALLINT, round_number TINYINT, "
    "race_name STRING, race_date DATE, race_time STRING, circuit_key BIGINT, date_key INT, "
    "wikipedia_url STRING, dw_inserted_at TIMESTAMP_NTZ")

FACT_RACE_RESULT = ("result_key BIGINT, race_key BIGINT NOT NULL, driver_key BIGINT NOT NULL, "
    "constructor_key BIGINT NOT NULL, circuit_key BIGINT NOT NULL, date_key INT NOT NULL, src_result_id INT, src_race_id INT, "
    "src_driver_id INT, src_constructor_id INT, qualifying_position TINYINT, "
    "q1_time_ms INT, q2_time_ms INT, q3_time_ms INT, best_qualifying_time_ms INT, "
    "grid_position TINYINT, finish_position TINYINT, position_order TINYINT, "
    "position_text STRING, points_scored DECIMAL(5,2), laps_completed SMALLINT, "
    "race_time_ms BIGINT, finish_status STRING, fastest_lap_number SMALLINT, "
    "fastest_lap_rank TINYINT, fastest_lap_time_ms INT, fastest_lap_speed_kph DECIMAL(7,3), "
    "pit_stop_count TINYINT, total_pit_time_ms INT, avg_pit_time_ms DECIMAL(8,1), "
    "driver_champ_points DECIMAL(6,2), driver_champ_position TINYINT, "
    "driver_champ_wins TINYINT, constructor_race_points DECIMAL(5,2), "
    "positions_gained SMALLINT, dw_inserted_at TIMESTAMP_NTZ")

TARGETS: dict[str, str] = {
    "dim_driver": DIM_DRIVER,
    "dim_constructor": DIM_CONSTRUCTOR,
    "dim_circuit": DIM_CIRCUIT,
    "dim_date": DIM_DATE,
    "dim_race": DIM_RACE,
    "fact_race_result": FACT_RACE_RESULT,
}

# The bronze tables a clean-up empties (landed sources,
# including three that no load reads).
BRONZE_TABLES = (
    "circuits", "constructors", "constructors_results", "constructors_standings",
    "drivers", "driver_standings", "lap_times", "pit_stops", "qualifying", "races",
    "results", "seasons", "status",
)


def source_schema(name: str) -> StructType:
    return StructType.fromDDL(SOURCES[name])


def target_schema(name: str) -> StructType:
    return StructType.fromDDL(TARGETS[name])


def not_null_columns(name: str) -> list[str]:
    return [f.name for f in target_schema(name).fields if not f.nullable]
