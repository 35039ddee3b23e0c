"""Feature matrix and labels for the hazard models, flight features for the delay model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrahaz.functions import classify as C

# Feature names and the constants of the scaling and label rules.
HAZARD_FEATURES = [
    "lat_normalized", "lon_normalized",
    "earthquake_magnitude", "temperature_normalized",
    "humidity_normalized", "wind_normalized",
    "flight_velocity",
    "is_311", "is_hospital", "is_earthquake", "is_flight", "is_weather",
    "complaint_severity", "borough_encoded",
    "spatial_density", "event_frequency",
]
DELAY_FEATURES = [
    "temperature_f", "humidity_pct", "wind_speed_mph", "wind_direction_deg",
    "visibility_miles", "ceiling_ft", "precipitation_in",
    "is_night", "is_weekend", "airline_code", "route_distance_nm",
]
# column -> (offset, scale, fill for null, feature when the column is absent)
SCALES = {
    "latitude": ("lat_normalized", 40.5, 0.5, None),
    "longitude": ("lon_normalized", -74.3, 0.6, None),
    "temperature_f": ("temperature_normalized", 50.0, 30.0, None),
    "humidity_pct": ("humidity_normalized", 0.0, 100.0, 50.0),
    "wind_speed_mph": ("wind_normalized", 0.0, 20.0, 5.0),
    "velocity_mps": ("flight_velocity", 0.0, 500.0, 200.0),
}
SOURCE_FLAGS = {
    "is_311": "311_requests",
    "is_earthquake": "usgs_earthquakes",
    "is_flight": "nyc_flights",
    "is_weather": "nyc_weather",
}


def _have(df: DataFrame, name: str, kind: str = "double") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def normalize_features(df: DataFrame) -> DataFrame:
    """Scaled copies of the coordinates and the weather and flight readings."""
    out = {}
    for column, (feature, offset, scale, fill) in SCALES.items():
        value = _have(df, column)
        value = value if fill is None else F.coalesce(value, F.lit(fill))
        shifted = value if offset == 0.0 else value - F.lit(offset)
        out[feature] = shifted / F.lit(scale)
    return df.withColumns(out)


def hazard_features(df: DataFrame) -> DataFrame:
    """The 16 model features of a stacked table; nulls become 0.

    ``spatial_density`` and ``event_frequency`` are used if the table has them.
    """
    columns = {
        "earthquake_magnitude": F.coalesce(_have(df, "magnitude"), F.lit(0.0)),
        "is_hospital": C.contains_ci(_have(df, "facility_type", "string"), "hospital").cast("int"),
        "complaint_severity": C.complaint_severity(_have(df, "complaint_type", "string")),
        "borough_encoded": C.lookup(F.upper(_have(df, "borough", "string")), C.BOROUGH_CODES, 0),
        "spatial_density": F.coalesce(_have(df, "spatial_density").cast("double"), F.lit(1.0)),
        "event_frequency": F.coalesce(_have(df, "event_frequency").cast("double"), F.lit(1.0)),
    }
    for flag, source in SOURCE_FLAGS.items():
        columns[flag] = (F.col("data_source") == source).cast("int")
    return normalize_features(df).withColumns(columns).fillna(0, subset=HAZARD_FEATURES)


def noise(key: Column, seed: int, scale: float) -> Column:
    """Roughly normal, fully repeatable noise: a sum of twelve hashed uniforms."""
    draws = [(F.pmod(F.xxhash64(key, F.lit(seed * 100 + i)), F.lit(1 << 20)) / F.lit(float(1 << 20))) for i in range(12)]
    total = draws[0]
    for d in draws[1:]:
        total = total + d
    return (total - F.lit(6.0)) * F.lit(scale)


def hazard_labels(df: DataFrame, noise_key: str | None = None, seed: int = 42) -> DataFrame:
    """fire_risk, hospital_overpop and response_time; noise only if a key is named."""
    temperature = F.coalesce(_have(df, "temperature_f"), F.lit(60.0))
    humidity = F.coalesce(_have(df, "humidity_pct"), F.lit(50.0))
    wind = F.coalesce(_have(df, "wind_speed_mph"), F.lit(5.0))

    def one(condition: Column) -> Column:
        return condition.cast("double")

    fire = (
        one(temperature > 80)
        + one((temperature > 75) & (humidity < 40))
        + one(wind > 15)
        + F.col("is_hospital") * F.lit(0.5)
    )
    crowd = (
        F.col("is_311") * F.lit(1.0)
        + F.col("borough_encoded") / F.lit(4.0)
        + F.col("complaint_severity") / F.lit(4.0)
    )
    response = F.lit(5.0) + F.abs(F.col("latitude") - F.lit(40.75)) * F.lit(30.0)
    if noise_key is not None:
        response = response + noise(F.col(noise_key), seed, 2.0)
    return df.withColumns(
        {
            "fire_risk": (fire >= 2).cast("int"),
            "hospital_overpop": (crowd >= 1).cast("int"),
            "response_time": C.clip(response, 3.0, 25.0),
        }
    )


def delay_features(df: DataFrame) -> DataFrame:
    """Flights joined to weather, with the model's columns, score and label."""
    with_flight = df.withColumns(
        {
            "is_night": C.is_night("ts"),
            "is_weekend": C.is_weekend("ts"),
            "airline_code": C.carrier_code("callsign"),
            "route_distance_nm": F.col("distance_nm"),
            "delay_score": C.delay_score("wind_speed_mph", "visibility_miles", "precipitation_in", "temperature_f"),
        }
    )
    return with_flight.withColumn("delay", C.is_delay("delay_score"))
