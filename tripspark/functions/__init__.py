"""Column expressions (built-in Spark functions only, so they stay in codegen)."""

from tripspark.functions.geo import (
    central_angle,
    half_chord,
    haversine_a,
    ieee_divide,
    speed,
)
from tripspark.functions.time import (
    duration_millis,
    duration_seconds,
    epoch_micros,
    epoch_millis,
    epoch_seconds,
    hour_label,
    hour_of_day,
    is_ntz,
)

__all__ = [
    "central_angle",
    "duration_millis",
    "duration_seconds",
    "epoch_micros",
    "epoch_millis",
    "epoch_seconds",
    "half_chord",
    "haversine_a",
    "hour_label",
    "hour_of_day",
    "ieee_divide",
    "is_ntz",
    "speed",
]
