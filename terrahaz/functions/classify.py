"""Scalar rules: hazard types, categories, severities, units, text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, word lists and limits that results must agree on.
COMPLAINT_HAZARDS = {"Noise": "medical", "Parking": "rescue", "Condition": "hazmat"}
COMPLAINT_DEFAULT = "rescue"
FACILITY_HAZARDS = {"fire_station": "fire", "hospital": "medical", "clinic": "hazmat"}
FACILITY_DEFAULT = "medical"
QUAKE_HAZARD = "fire"
FEED_SEVERITY = {"usgs_earthquakes": 5, "nyc_311": 5, "osm_infrastructure": 7}
HAZMAT_WORDS = ["hazmat", "chemical", "spill", "asbestos"]
FIRE_CATEGORIES = ["fire", "fire_station"]
MEDICAL_CATEGORIES = ["medical", "hospital", "clinic"]
RESCUE_CATEGORIES = ["rescue", "safety", "emergency"]
URGENT_COMPLAINT_WORDS = ["fire", "safety", "emergency"]
NUISANCE_COMPLAINT_WORDS = ["noise", "construction"]
BOROUGH_CODES = {"MANHATTAN": 0, "BROOKLYN": 1, "QUEENS": 2, "BRONX": 3, "STATEN ISLAND": 4}
CARRIER_CODES = {
    "AAL": 1, "UAL": 2, "DAL": 3, "JBU": 4, "SWA": 5,
    "ASA": 6, "FFT": 7, "RPA": 8, "JB": 9, "NKS": 10,
}
CATEGORY_COLORS = {"fire": "#ff0040", "medical": "#0080ff", "hazmat": "#ff8800", "rescue": "#00ff80"}
CATEGORY_LABELS = {"fire": "Fire", "medical": "Medical", "hazmat": "Hazmat", "rescue": "Rescue"}
DELAY_LEVELS = [(0.15, "none"), (0.30, "low"), (0.50, "medium"), (0.70, "high")]
DELAY_TOP = "severe"
MARKER_CLASSES = [
    ("FIRE", ["building", "fire", "fire_station"], 12.0),
    ("HOSPITAL", ["hospital", "clinic", "medical"], 10.0),
    ("AMBULANCE", ["road", "ambulance", "traffic"], 6.0),
    ("RESCUE", ["rescue", "police", "emergency", "safety"], 10.0),
]
MARKER_OTHER = ("OTHER", 4.0)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(c, table: dict, default=None) -> Column:
    """Constant dictionary lookup with a default for unknown and null keys."""
    pairs = [F.lit(v) for item in table.items() for v in item]
    found = F.try_element_at(F.create_map(*pairs), F.coalesce(_col(c), F.lit("")))
    return found if default is None else F.coalesce(found, F.lit(default))


def _first_match(c: Column, table: dict, default: str) -> Column:
    chain = reduce(
        lambda out, item: out.when(c.contains(item[0]), item[1]), table.items(), F
    )
    return chain.otherwise(default)


def hazard_from_complaint(complaint) -> Column:
    """Case-sensitive, first match wins; unknown and null fall to the default."""
    return _first_match(_col(complaint), COMPLAINT_HAZARDS, COMPLAINT_DEFAULT)


def hazard_from_facility(facility) -> Column:
    return lookup(facility, FACILITY_HAZARDS, FACILITY_DEFAULT)


def feed_severity(source: str) -> Column:
    return F.lit(FEED_SEVERITY[source])


def any_word(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def map_category(hazard, severity) -> Column:
    """Map layer of an event; unknown types follow severity, null severity is medical."""
    kind = F.lower(_col(hazard))
    by_severity = F.when(_col(severity) > 7, "rescue").otherwise("medical")
    return (
        F.when(any_word(kind, HAZMAT_WORDS), "hazmat")
        .when(kind.isin(FIRE_CATEGORIES), "fire")
        .when(kind.isin(MEDICAL_CATEGORIES), "medical")
        .when(kind.isin(RESCUE_CATEGORIES), "rescue")
        .otherwise(by_severity)
    )


def category_label(category) -> Column:
    return F.initcap(_col(category))


def category_color(category) -> Column:
    return lookup(category, CATEGORY_COLORS, "#808080")


def priority_bucket(weight) -> Column:
    w = _col(weight)
    return F.when(w > 0.7, "HIGH").when(w > 0.4, "MEDIUM").otherwise("LOW")


def score_percent(weight) -> Column:
    return F.round(_col(weight) * 100, 0)


def marker_radius(weight) -> Column:
    return F.greatest(_col(weight) * 4, F.lit(6.0))


def marker_class(facility, risk, bed_demand=None) -> Column:
    """``struct<class, radius, shown>``; fire is shown above 0.5 (0..1) or 5 (1..10)."""
    kind = F.lower(_col(facility))
    risk = _col(risk)
    name, radius = F.lit(MARKER_OTHER[0]), F.lit(MARKER_OTHER[1])
    for label, kinds, size in reversed(MARKER_CLASSES):
        hit = kind.isin(kinds)
        own = F.lit(size)
        if label == "HOSPITAL" and bed_demand is not None:
            own = F.coalesce(_col(bed_demand).cast("double"), own)
        name = F.when(hit, label).otherwise(name)
        radius = F.when(hit, own).otherwise(radius)
    hot = F.when(risk <= 1, risk > 0.5).otherwise(risk > 5)
    shown = F.when(name == "FIRE", F.coalesce(hot, F.lit(False))).otherwise(F.lit(True))
    return F.struct(name.alias("class"), radius.alias("radius"), shown.alias("shown"))


def severity_ramp(severity) -> Column:
    """Severity 1..10 as yellow to red: factor, red, green, blue, strength."""
    s = _col(severity).cast("double")
    factor = (s - 1.0) / 9.0
    return F.struct(
        factor.alias("factor"),
        F.lit(1.0).alias("red"),
        (F.lit(1.0) - factor).alias("green"),
        F.lit(0.0).alias("blue"),
        (s * 15.0).alias("strength"),
    )


def complaint_severity(complaint) -> Column:
    text = F.coalesce(F.lower(_col(complaint)), F.lit(""))
    return (
        F.when(any_word(text, URGENT_COMPLAINT_WORDS), 4)
        .when(any_word(text, NUISANCE_COMPLAINT_WORDS), 3)
        .otherwise(2)
    )


def delay_severity(probability) -> Column:
    p = _col(probability)
    out = F.when(p.isNull(), F.lit(None).cast("string"))
    for limit, name in DELAY_LEVELS:
        out = out.when(p < limit, name)
    return out.otherwise(DELAY_TOP)


def flight_risk(probability) -> Column:
    """Delay severity folded to three levels."""
    level = delay_severity(probability)
    return (
        F.when(level.isin("high", "severe"), "high").when(level == "medium", "medium").when(
            level.isNotNull(), "low"
        )
    )


def delay_score(wind_mph, visibility_miles, precipitation_in, temperature_f) -> Column:
    """Weighted bad-weather score; an unknown reading adds nothing."""

    def term(condition: Column, weight: float) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("int") * F.lit(weight)

    return (
        term(_col(wind_mph) > 20, 0.3)
        + term(_col(visibility_miles) < 3, 0.3)
        + term(_col(precipitation_in) > 0.1, 0.25)
        + term(_col(temperature_f) < 32, 0.15)
    )


def is_delay(score) -> Column:
    return (_col(score) > 0.3).cast("int")


def delay_minutes(score) -> Column:
    return (_col(score) * 120).cast("int")


def carrier_code(callsign) -> Column:
    return lookup(F.substring(_col(callsign), 1, 3), CARRIER_CODES, 0)


def is_night(ts) -> Column:
    h = F.hour(_col(ts))
    return ((h >= 20) | (h < 6)).cast("int")


def is_weekend(ts) -> Column:
    return (F.weekday(_col(ts)) >= 5).cast("int")


def celsius_to_fahrenheit(c) -> Column:
    return _col(c) * 9 / 5 + 32


def mps_to_mph(c) -> Column:
    return _col(c) * F.lit(2.237)


def epoch_ms_to_ts(c) -> Column:
    return F.timestamp_millis(_col(c).cast("bigint"))


def epoch_s_to_ts(c) -> Column:
    return F.timestamp_seconds(_col(c))


def clip(c, low: float, high: float) -> Column:
    """Bound to [low, high]; null stays null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def token_count(text) -> Column:
    """Whitespace-separated tokens; empty and null text have none."""
    trimmed = F.trim(F.regexp_replace(_col(text), r"\s+", " "))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", 0).otherwise(F.size(F.split(trimmed, " ")))


def contains_ci(c, word: str) -> Column:
    return F.coalesce(F.lower(_col(c)).contains(word.lower()), F.lit(False))


def first_of(*columns) -> Column:
    """First field that is neither null nor empty."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in columns])
