"""Feed snapshots and decoded entities to bronze rows.

Entities are nested structs (`schemas.ENTITY`). On the wire they are protobuf messages in
base64 text; `entity_of` reads those where Spark's protobuf package is installed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions import labels


def fan_out(snapshots: DataFrame, topic: str) -> DataFrame:
    """One base64 text message per entity of every snapshot.

    `snapshots` has `entities ARRAY<STRUCT<id STRING, payload BINARY>>`; the other columns are
    kept. Publishing is `publish` in `sources.topics`.
    """
    kept = [name for name in snapshots.columns if name != "entities"]
    return snapshots.select(*kept, F.explode("entities").alias("entity")).select(
        *kept,
        F.lit(topic).alias("topic"),
        F.col("entity.id").alias("entity_id"),
        # Spark may break base64 text into lines; a message is one line.
        F.translate(F.base64("entity.payload"), "\r\n", "").alias("value"),
    )


def message_bytes(value: Column) -> Column:
    """Entity bytes of a topic message, the reverse of `fan_out`."""
    return F.unbase64(value)


def entity_of(value: Column, descriptor: str, message: str = "transit_realtime.FeedEntity") -> Column:
    """The entity in a topic message; `descriptor` is the compiled protobuf description file."""
    from pyspark.sql.protobuf.functions import from_protobuf

    wire = from_protobuf(message_bytes(value), message, descriptor)
    vehicle, update = wire["vehicle"], wire["trip_update"]
    position = F.struct(*[vehicle["position"][n] for n in ("latitude", "longitude", "bearing")])
    stops = F.transform(
        update["stop_time_update"],
        lambda stop: F.struct(
            *[F.struct(stop[n]["delay"].alias("delay")).alias(n) for n in ("arrival", "departure")]
        ),
    )
    return F.struct(
        wire["id"],
        F.when(
            vehicle.isNotNull(),
            F.struct(
                F.struct(vehicle["trip"]["trip_id"], vehicle["trip"]["route_id"]),
                F.struct(vehicle["vehicle"]["id"]),
                position,
                vehicle["timestamp"],
            ),
        ),
        F.when(update.isNotNull(), F.struct(F.struct(update["trip"]["trip_id"]), stops)),
    ).cast(schemas.ENTITY)


def _text(path: str) -> Column:
    return F.coalesce(F.col(path), F.lit(""))


def _number(path: str) -> Column:
    return F.coalesce(F.col(path).cast("double"), F.lit(0.0))


def _stamps(messages: DataFrame) -> list[str]:
    """When a message was taken in, where the source says so."""
    return [name for name in messages.columns if name == "ingest_time"]


def decode_positions(messages: DataFrame) -> DataFrame:
    """Bronze positions from the `entity` column: vehicle entities that are on a trip.

    Unset fields read as the empty text or zero, as the wire format defines them.
    """
    route = _text("entity.vehicle.trip.route_id")
    return messages.filter(
        F.col("entity.vehicle").isNotNull() & (_text("entity.vehicle.trip.trip_id") != "")
    ).select(
        "arrival_seq",
        _text("entity.vehicle.vehicle.id").alias("vehicle_id"),
        route.alias("route_id"),
        labels.route_agency(route).alias("agency_id"),
        labels.route_short_name(route).alias("route_short_name"),
        _text("entity.vehicle.trip.trip_id").alias("trip_id"),
        _number("entity.vehicle.position.latitude").alias("latitude"),
        _number("entity.vehicle.position.longitude").alias("longitude"),
        _number("entity.vehicle.position.bearing").alias("bearing"),
        F.coalesce("entity.vehicle.timestamp", F.lit(0).cast("long")).alias("timestamp"),
        *_stamps(messages),
    )


def decode_trip_updates(messages: DataFrame) -> DataFrame:
    """Bronze updates: the delay at the next stop, its arrival before its departure.

    Only the first stop is looked at. Updates without a delay there, or without a trip, go.
    """
    next_stop = F.get("entity.trip_update.stop_time_update", F.lit(0))
    delay = F.coalesce(next_stop["arrival"]["delay"], next_stop["departure"]["delay"])
    return (
        messages.select(
            "arrival_seq",
            _text("entity.trip_update.trip.trip_id").alias("trip_id"),
            delay.cast("long").alias("delay_seconds"),
            *_stamps(messages),
        )
        .filter((F.col("trip_id") != "") & F.col("delay_seconds").isNotNull())
        .select(*schemas.TRIP_UPDATE.names, *_stamps(messages))
    )
