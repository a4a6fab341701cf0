"""Trip cleaning, features and groups on hand-made rows."""

import datetime as dt

import pytest

from tallyhouse.plans import trips

SCHEMA = (
    "trip int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, passenger_count bigint, trip_distance double, "
    "fare_amount double, tip_amount double, total_amount double, payment_type string, pickup_latitude double, "
    "pickup_longitude double, dropoff_latitude double, dropoff_longitude double"
)
START = dt.datetime(2024, 1, 6, 19, 0)  # a Saturday


def trip(number, **changed):
    row = {
        "trip": number, "pickup_datetime": START, "dropoff_datetime": START + dt.timedelta(minutes=30),
        "passenger_count": 1, "trip_distance": 10.0, "fare_amount": 20.0, "tip_amount": 5.0, "total_amount": 25.0,
        "payment_type": "card", "pickup_latitude": 40.751, "pickup_longitude": -73.984,
        "dropoff_latitude": 40.7, "dropoff_longitude": -74.0,
    }
    return tuple((row | changed).values())


@pytest.fixture
def frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


BROKEN = [
    {"fare_amount": -0.01}, {"fare_amount": 500.01}, {"trip_distance": -1.0}, {"trip_distance": 100.5},
    {"passenger_count": -1}, {"passenger_count": 8}, {"total_amount": 0.0}, {"dropoff_datetime": None},
    {"pickup_datetime": None}, {"fare_amount": None},
]
EDGES = [{"fare_amount": 0.0}, {"fare_amount": 500.0}, {"trip_distance": 100.0}, {"passenger_count": 0}, {"passenger_count": 7}]


def test_each_bound_removes_its_row(frame):
    rows = [trip(i, **c) for i, c in enumerate(BROKEN)] + [trip(100 + i, **c) for i, c in enumerate(EDGES)]
    assert {r.trip for r in trips.trip_cleaning(frame(*rows)).collect()} == {100, 101, 102, 103, 104}
    stats = trips.trip_cleaning_stats(frame(*rows)).first()
    assert (stats.original_count, stats.clean_count, stats.removed) == (15, 5, 10)
    assert stats.removed_pct == pytest.approx(200 / 3)


def test_features_and_their_zero_guards(frame):
    rows = trips.trip_features(
        frame(
            trip(1),
            trip(2, fare_amount=0.0),
            trip(3, trip_distance=0.0),
            trip(4, dropoff_datetime=START),
        )
    ).collect()
    plain, free, still, instant = sorted(rows, key=lambda r: r.trip)
    assert (plain.pickup_hour, plain.pickup_day_of_week, plain.day_name, plain.is_weekend) == (19, 7, "Saturday", True)
    assert (plain.trip_duration_minutes, plain.speed_mph, plain.tip_percentage, plain.revenue_per_mile) == (30, 20, 25, 2.5)
    assert free.tip_percentage is None and still.revenue_per_mile is None and instant.speed_mph is None


def test_distance_bands_start_at_their_lower_bound(frame):
    miles = [0.5, 1.0, 3.0, 5.0, 10.0, 0.0]
    features = trips.trip_features(frame(*[trip(i, trip_distance=m) for i, m in enumerate(miles)]))
    assert [(r.distance_bucket, r.trips) for r in trips.distance_buckets(features).collect()] == [
        ("< 1 mile", 2), ("1-3 miles", 1), ("3-5 miles", 1), ("5-10 miles", 1), ("10+ miles", 1),
    ]


def test_zones_and_unknown_places(frame):
    features = trips.trip_features(frame(trip(1), trip(2), trip(3, pickup_latitude=None)))
    assert [(r.pickup_zone, r.pickups) for r in trips.pickup_zones(features).collect()] == [("40.75,-73.98", 2), (None, 1)]
    routes = trips.popular_routes(features, min_trips=1).collect()
    assert [(r.pickup_zone, r.dropoff_zone, r.trips) for r in routes] == [("40.75,-73.98", "40.7,-74.0", 2)]


def test_pivots(frame):
    monday = dt.datetime(2024, 1, 8, 19, 0)
    features = trips.trip_features(
        frame(
            trip(1),
            trip(2, pickup_datetime=monday, dropoff_datetime=monday + dt.timedelta(hours=1), payment_type="cash"),
            trip(3, tip_amount=1.0),
        )
    )
    assert [tuple(r) for r in trips.weekend_pivot(features).collect()] == [(19, 1, 2)]
    assert trips.tips_pivot(features).first().asDict() == {"pickup_hour": 19, "card": 15.0, "cash": 25.0}
    assert trips.tips_pivot(features, ["cash"]).first().asDict() == {"pickup_hour": 19, "cash": 25.0}


def test_growth_is_null_at_first_and_after_zero(spark):
    months = spark.createDataFrame([(2024, 1, 0.0), (2024, 2, 50.0), (2024, 3, 75.0)], "pickup_year int, pickup_month int, total_amount double")
    rows = trips.trip_mom_growth(months).orderBy("pickup_month").collect()
    assert [r.revenue_growth_pct for r in rows] == [None, None, 50.0]
    assert [r.trip_growth_pct for r in rows] == [None, 0.0, 0.0]
    totals = trips.cumulative_monthly(months).orderBy("pickup_month").collect()
    assert [float(r.cumulative_revenue) for r in totals] == [0, 50, 125]
