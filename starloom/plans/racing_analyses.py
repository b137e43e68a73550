"""The dashboard analyses over the racing star schema, composed from the
generic analysis operators.  Each takes the silver tables and returns a
DataFrame; none puts a whole group into one task (see
``starloom.operators.analyses``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators import (
    compare_to_group_mean,
    count_by_bucket,
    mean_by_bucket,
    period_leaders,
    share_of_group,
)


def _with_season(fact: DataFrame, dim_race: DataFrame) -> DataFrame:
    races = dim_race.select("race_key", F.col("season_year").alias("season"))
    return fact.join(races, "race_key", "left")


def constructor_dominance(fact: DataFrame, dim_race: DataFrame, dim_constructor: DataFrame) -> DataFrame:
    """Seasons each constructor finished on top of the points table, per
    decade (season leader = most race points that season, ties included)."""
    pts = (_with_season(fact, dim_race)
           .groupBy("constructor_key", "season")
           .agg(F.sum("points_scored").cast("decimal(12,2)").alias("season_points")))
    leaders = period_leaders(pts, ["constructor_key"], ["season"], "season_points")
    per_decade = count_by_bucket(leaders, ["constructor_key"],
                                 (F.floor(F.col("season") / 10) * 10).cast("int"), "decade", "seasons_led")
    names = dim_constructor.select("constructor_key", "constructor_name")
    return per_decade.join(names, "constructor_key", "left")


def driver_records(fact: DataFrame, dim_driver: DataFrame, top_k: int | None = None) -> DataFrame:
    """Wins, pole positions and fastest laps of every driver in the fact, one
    pass of conditional counts; with ``top_k`` only the first so many by wins
    (then poles, then driver key)."""
    per = fact.groupBy("driver_key").agg(
        F.count(F.when(F.col("finish_position") == 1, 1)).alias("wins"),
        F.count(F.when(F.col("grid_position") == 1, 1)).alias("poles"),
        F.count(F.when(F.col("fastest_lap_rank") == 1, 1)).alias("fastest_laps"))
    if top_k is not None:
        per = per.orderBy(F.desc("wins"), F.desc("poles"), "driver_key").limit(top_k)
    return per.join(dim_driver.select("driver_key", "full_name"), "driver_key", "left")


def race_deep_dive(fact: DataFrame) -> DataFrame:
    """Per result: positions gained, the race's mean gain and the distance
    from it, and race pace against qualifying pace (fastest race lap minus
    best qualifying time, in ms)."""
    rows = fact.select("race_key", "driver_key", "positions_gained", "pit_stop_count",
                       (F.col("fastest_lap_time_ms") - F.col("best_qualifying_time_ms")).alias("pace_delta_ms"))
    return compare_to_group_mean(rows.withColumn("gain", F.col("positions_gained").cast("decimal(10,0)")),
                                 ["race_key"], "gain", mean_name="race_mean_gain",
                                 delta_name="gain_vs_race").drop("gain")


def gain_by_pit_stops(fact: DataFrame) -> DataFrame:
    """Mean positions gained by number of pit stops (pit-strategy view)."""
    rows = fact.where(F.col("positions_gained").isNotNull()) \
        .select("pit_stop_count", F.col("positions_gained").cast("decimal(10,0)").alias("gain"))
    return mean_by_bucket(rows, "pit_stop_count", "gain", count_name="results", mean_name="mean_gain")


def driver_or_car(fact: DataFrame, dim_race: DataFrame) -> DataFrame:
    """Each driver's share of their constructor's points per season, beside
    the constructor's rank that season -- the headline question."""
    pts = (_with_season(fact, dim_race)
           .groupBy("driver_key", "constructor_key", "season")
           .agg(F.sum("points_scored").cast("decimal(12,2)").alias("driver_points")))
    return share_of_group(pts, ["driver_key"], ["constructor_key"], ["season"], "driver_points",
                          group_total_name="constructor_points", share_name="share_of_constructor",
                          rank_name="constructor_rank")
