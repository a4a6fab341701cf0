"""Taxi-trip profile, cleaning, features and analyses.

Each analysis is one scan and one aggregation to few groups, so a heavy hour,
zone or payment type is reduced inside the tasks that read it. Windows run over
results that hold one row per hour, weekday or month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.scalar import banded, mean, money_mean, money_total, number
from tallyhouse.operators.ranking import (
    top_k,
    top_per_group,
    with_growth,
    with_running_totals,
)

# Upper bounds of the distance bands, in miles.
DISTANCE_BANDS = [(1, "< 1 mile"), (3, "1-3 miles"), (5, "3-5 miles"), (10, "5-10 miles")]
DISTANCE_TOP = "10+ miles"


def valid_trip() -> Column:
    """Plausible fare, distance, passengers and total, and both times known."""
    return (
        F.col("fare_amount").between(0, 500)
        & F.col("trip_distance").between(0, 100)
        & F.col("passenger_count").between(0, 7)
        & (F.col("total_amount") > 0)
        & F.col("dropoff_datetime").isNotNull()
        & F.col("pickup_datetime").isNotNull()
    )


def trip_cleaning(trips: DataFrame) -> DataFrame:
    return trips.filter(valid_trip())


def trip_cleaning_stats(trips: DataFrame) -> DataFrame:
    """Rows before and after cleaning, counted in one pass."""
    counts = trips.agg(F.count("*").alias("original_count"), F.count_if(valid_trip()).alias("clean_count"))
    removed = F.col("original_count") - F.col("clean_count")
    return counts.withColumns(
        {"removed": removed, "removed_pct": F.try_divide(number(removed), number("original_count")) * 100}
    )


def pickup_calendar(trips: DataFrame) -> DataFrame:
    """Date parts of the pickup time; weekdays count from Sunday = 1."""
    at = F.col("pickup_datetime")
    return trips.withColumns(
        {
            "pickup_date": F.to_date(at),
            "pickup_hour": F.hour(at),
            "pickup_day_of_week": F.dayofweek(at),
            "pickup_month": F.month(at),
            "pickup_year": F.year(at),
            "day_name": F.date_format(at, "EEEE"),
            "is_weekend": F.dayofweek(at).isin(1, 7),
        }
    )


def trip_features(trips: DataFrame) -> DataFrame:
    """Clean trips with calendar, duration, speed, tip share and revenue per mile.

    A zero fare, distance or duration gives NULL, not an error.
    """
    seconds = F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")
    with_duration = pickup_calendar(trip_cleaning(trips)).withColumn("trip_duration_minutes", seconds / F.lit(60.0))
    return with_duration.withColumns(
        {
            "speed_mph": F.try_divide(F.col("trip_distance"), F.col("trip_duration_minutes") / 60),
            "tip_percentage": F.try_divide(number("tip_amount"), number("fare_amount")) * 100,
            "revenue_per_mile": F.try_divide(number("total_amount"), F.col("trip_distance")),
        }
    )


def date_range_profile(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.min("pickup_datetime").alias("earliest_trip"), F.max("pickup_datetime").alias("latest_trip")
    )


# Hours and weekdays


def trip_hourly(features: DataFrame) -> DataFrame:
    return features.groupBy("pickup_hour").agg(*_volume())


def peak_hour(features: DataFrame) -> DataFrame:
    """The hour with most trips; the earlier one on a tie."""
    return top_k(trip_hourly(features), "numtrips", 1, "pickup_hour").select("pickup_hour", "numtrips")


def weekend_hourly(features: DataFrame) -> DataFrame:
    return features.groupBy("is_weekend", "pickup_hour").agg(*_volume())


def weekend_pivot(features: DataFrame) -> DataFrame:
    """Trips per hour, weekdays beside weekends; NULL where there is none."""
    return (
        features.groupBy("pickup_hour", "is_weekend")
        .agg(F.count("*").alias("numtrips"))
        .groupBy("pickup_hour")
        .pivot("is_weekend", [False, True])
        .agg(F.first("numtrips"))
        .withColumnsRenamed({"false": "weekday_trips", "true": "weekend_trips"})
    )


def weekend_summary(features: DataFrame) -> DataFrame:
    return features.groupBy("is_weekend").agg(
        F.count("*").alias("total_trips"),
        money_total("total_amount").alias("total_revenue"),
        money_mean("total_amount").alias("avg_fare"),
        mean("trip_distance").alias("avg_distance"),
        mean("trip_duration_minutes").alias("avg_duration"),
        mean("tip_percentage").alias("avg_tip_pct"),
    )


def hour_rank(features: DataFrame) -> DataFrame:
    """Hours ranked by revenue, with their percent rank: 24 rows enter the window."""
    order = Window.orderBy(F.desc("total_revenue"), "pickup_hour")
    return trip_hourly(features).withColumns(
        {"revenue_rank": F.row_number().over(order), "revenue_percentile": F.percent_rank().over(order)}
    )


def top_hours_per_day(features: DataFrame, k: int = 3) -> DataFrame:
    hours = features.groupBy("day_name", "pickup_day_of_week", "pickup_hour").agg(
        F.count("*").alias("numtrips"), money_total("total_amount").alias("total_revenue")
    )
    return top_per_group(hours, "day_name", "total_revenue", k, "rank_within_day", "pickup_hour")


# Months


def trip_monthly(trips: DataFrame) -> DataFrame:
    """``trips`` needs pickup_year, pickup_month and total_amount."""
    return trips.groupBy("pickup_year", "pickup_month").agg(
        F.count("*").alias("trips"),
        money_total("total_amount").alias("revenue"),
        money_mean("total_amount").alias("avg_fare"),
    )


def trip_mom_growth(trips: DataFrame) -> DataFrame:
    return with_growth(
        trip_monthly(trips),
        ["pickup_year", "pickup_month"],
        {
            "revenue": ("prev_month_revenue", "revenue_growth", "revenue_growth_pct"),
            "trips": ("prev_month_trips", None, "trip_growth_pct"),
        },
    )


def cumulative_monthly(trips: DataFrame) -> DataFrame:
    return with_running_totals(
        trip_monthly(trips),
        ["pickup_year", "pickup_month"],
        {"revenue": "cumulative_revenue", "trips": "cumulative_trips"},
        ties_share=False,
    )


# Payment, passengers, distance


def tips_by_payment(features: DataFrame) -> DataFrame:
    return features.groupBy("payment_type").agg(
        F.count("*").alias("numtrips"),
        money_total("tip_amount").alias("total_tips"),
        money_mean("tip_amount").alias("avg_tip"),
        mean("tip_percentage").alias("avg_tip_pct"),
    )


def tips_pivot(features: DataFrame, payment_types: list[str] | None = None) -> DataFrame:
    """Average tip share per hour, one column per payment type.

    Give the types when they are known; otherwise Spark finds them with one more job over
    ``features`` (and refuses more than ``spark.sql.pivotMaxValues`` of them). Means are taken
    per hour and type first, so the pivot meets one row per cell.
    """
    cells = features.groupBy("pickup_hour", "payment_type").agg(mean("tip_percentage").alias("avg_tip_pct"))
    return cells.groupBy("pickup_hour").pivot("payment_type", payment_types).agg(F.first("avg_tip_pct"))


def by_passenger_count(features: DataFrame) -> DataFrame:
    return features.groupBy("passenger_count").agg(
        F.count("*").alias("num_trips"),
        money_total("total_amount").alias("revenue"),
        money_mean("total_amount").alias("avg_fare"),
        mean("trip_distance").alias("avg_distance"),
        mean("tip_percentage").alias("avg_tip_pct"),
    )


def distance_buckets(features: DataFrame) -> DataFrame:
    """Distance bands, shortest first."""
    band = banded("trip_distance", DISTANCE_BANDS, DISTANCE_TOP)
    return (
        features.groupBy(band.alias("distance_bucket"))
        .agg(
            F.count("*").alias("trips"),
            money_mean("total_amount").alias("avg_fare"),
            mean("trip_duration_minutes").alias("avg_duration"),
            mean("speed_mph").alias("avg_speed"),
            F.min("trip_distance").alias("sort_order"),
        )
        .orderBy("sort_order")
        .drop("sort_order")
    )


# Places


def zone(latitude: str, longitude: str) -> Column:
    """Grid cell of a position, two decimals; NULL when either part is unknown."""
    return F.concat(
        F.round(latitude, 2).cast("string"), F.lit(","), F.round(longitude, 2).cast("string")
    )


def pickup_zones(features: DataFrame, k: int = 10) -> DataFrame:
    cells = features.groupBy(zone("pickup_latitude", "pickup_longitude").alias("pickup_zone")).agg(
        F.count("*").alias("pickups"),
        money_mean("total_amount").alias("avg_fare"),
        money_total("total_amount").alias("total_fare"),
    )
    return top_k(cells, "pickups", k, "pickup_zone")


def dropoff_zones(features: DataFrame, k: int = 10) -> DataFrame:
    cells = features.groupBy(zone("dropoff_latitude", "dropoff_longitude").alias("dropoff_zone")).agg(
        F.count("*").alias("dropoffs"),
        money_total("total_amount").alias("revenue"),
        money_mean("total_amount").alias("avg_fare"),
    )
    return top_k(cells, "dropoffs", k, "dropoff_zone")


def popular_routes(features: DataFrame, min_trips: int = 100, k: int = 20) -> DataFrame:
    """Pickup and drop-off cells with more than ``min_trips`` trips between them."""
    routes = features.groupBy(
        zone("pickup_latitude", "pickup_longitude").alias("pickup_zone"),
        zone("dropoff_latitude", "dropoff_longitude").alias("dropoff_zone"),
    ).agg(
        F.count("*").alias("trips"),
        money_total("total_amount").alias("total_revenue"),
        money_mean("total_amount").alias("avg_fare"),
        mean("trip_distance").alias("avg_distance"),
    )
    return top_k(routes.filter(F.col("trips") > min_trips), "trips", k, "pickup_zone", "dropoff_zone")


def _volume() -> list[Column]:
    return [
        F.count("*").alias("numtrips"),
        money_total("total_amount").alias("total_revenue"),
        money_mean("total_amount").alias("avg_fare"),
        mean("trip_distance").alias("avg_distance"),
    ]
