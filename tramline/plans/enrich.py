"""Bronze to silver in one batch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline import schemas
from tramline.operators.last_known import attach_delay
from tramline.operators.proximity import bunching_arrivals
from tramline.settings import DEFAULTS, Settings


def enrich(positions: DataFrame, updates: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Every position with its last known delay and its bunching flag.

    The flag does not depend on the delay, so it is worked out on the bare positions, where
    only seven narrow columns are shuffled, and joined to the delays by arrival number.
    """
    return with_flags(
        attach_delay(positions, updates, settings), bunching_arrivals(positions, settings)
    )


def with_flags(delayed: DataFrame, bunching: DataFrame) -> DataFrame:
    """Silver rows from delayed positions and the arrival numbers of the bunching ones."""
    flagged = bunching.withColumn("flag", F.lit(True))
    return (
        delayed.join(flagged, "arrival_seq", "left")
        .withColumn("is_bunching", F.coalesce("flag", F.lit(False)))
        .select(schemas.SILVER.names)
    )
