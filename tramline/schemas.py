"""One declared schema per layer, so no job depends on per-file inference."""

from __future__ import annotations

from pyspark.sql import types as T

_EVENT = T.StructType([T.StructField("delay", T.IntegerType())])

ENTITY = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField(
            "vehicle",
            T.StructType(
                [
                    T.StructField(
                        "trip",
                        T.StructType(
                            [
                                T.StructField("trip_id", T.StringType()),
                                T.StructField("route_id", T.StringType()),
                            ]
                        ),
                    ),
                    T.StructField("vehicle", T.StructType([T.StructField("id", T.StringType())])),
                    T.StructField(
                        "position",
                        T.StructType(
                            [
                                T.StructField("latitude", T.FloatType()),
                                T.StructField("longitude", T.FloatType()),
                                T.StructField("bearing", T.FloatType()),
                            ]
                        ),
                    ),
                    T.StructField("timestamp", T.LongType()),
                ]
            ),
        ),
        T.StructField(
            "trip_update",
            T.StructType(
                [
                    T.StructField("trip", T.StructType([T.StructField("trip_id", T.StringType())])),
                    T.StructField(
                        "stop_time_update",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("arrival", _EVENT),
                                    T.StructField("departure", _EVENT),
                                ]
                            )
                        ),
                    ),
                ]
            ),
        ),
    ]
)

# `arrival_seq` is the position of a message in arrival order. The payloads carry no such
# field, and without it neither the delay join nor the bunching flag can be replayed.
ARRIVAL = T.StructField("arrival_seq", T.LongType())

POSITION = T.StructType(
    [
        ARRIVAL,
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("agency_id", T.StringType()),
        T.StructField("route_short_name", T.StringType()),
        T.StructField("trip_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("bearing", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

TRIP_UPDATE = T.StructType(
    [
        ARRIVAL,
        T.StructField("trip_id", T.StringType()),
        T.StructField("delay_seconds", T.LongType()),
    ]
)

SILVER = T.StructType(
    POSITION.fields
    + [
        T.StructField("delay_seconds", T.LongType()),
        T.StructField("is_bunching", T.BooleanType()),
    ]
)

LIVE_COLUMNS = [
    "vehicle_id",
    "route_id",
    "agency_id",
    "route_short_name",
    "trip_id",
    "latitude",
    "longitude",
    "timestamp",
    "delay_seconds",
    "is_bunching",
]

HISTORY_COLUMNS = ["timestamp", "route_id", "agency_id", "delay_seconds", "is_bunching"]

AGENCY = T.StructType(
    [T.StructField("agency_id", T.StringType()), T.StructField("agency_name", T.StringType())]
)

LIVE = T.StructType([SILVER[name] for name in LIVE_COLUMNS])


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
