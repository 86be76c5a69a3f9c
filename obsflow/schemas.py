"""Explicit schemas and keys: nothing is inferred, nothing goes by position."""

from __future__ import annotations

from pyspark.sql import types as T

COORDINATE = T.DecimalType(9, 6)
MEASURE = T.DecimalType(18, 6)

CURRENT_MEASURES = [
    "temp", "feels_like", "pressure", "humidity", "dew_point", "uvi",
    "clouds", "visibility", "wind_speed", "wind_deg",
]
HOURLY_MEASURES = [*CURRENT_MEASURES, "wind_gust"]
CONDITION_FIELDS = ["id", "main", "description", "icon"]

CORRUPT_COLUMN = "_corrupt_record"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


CONDITION = _struct(
    ("id", T.LongType()),
    ("main", T.StringType()),
    ("description", T.StringType()),
    ("icon", T.StringType()),
)
CURRENT_ENTRY = _struct(
    ("dt", T.LongType()),
    ("sunrise", T.LongType()),
    ("sunset", T.LongType()),
    *[(name, T.DoubleType()) for name in CURRENT_MEASURES],
    ("weather", T.ArrayType(CONDITION)),
)
HOURLY_ENTRY = _struct(
    ("dt", T.LongType()),
    *[(name, T.DoubleType()) for name in HOURLY_MEASURES],
    ("weather", T.ArrayType(CONDITION)),
)
WEATHER_DOCUMENT = _struct(
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("timezone", T.StringType()),
    ("timezone_offset", T.LongType()),
    ("current", CURRENT_ENTRY),
    ("hourly", T.ArrayType(HOURLY_ENTRY)),
    (CORRUPT_COLUMN, T.StringType()),
)

_STORED_CONDITION = [
    ("weather_id", T.LongType()),
    ("weather_main", T.StringType()),
    ("weather_description", T.StringType()),
    ("weather_icon", T.StringType()),
]
_STORED_PLACE = [
    ("latitude", COORDINATE),
    ("longitude", COORDINATE),
    ("timezone", T.StringType()),
]
LOCATION = _struct(
    ("latitude", COORDINATE),
    ("longitude", COORDINATE),
    ("city", T.StringType()),
    ("state", T.StringType()),
    ("postcode", T.StringType()),
    ("country", T.StringType()),
)
REQUEST = _struct(("latitude", T.StringType()), ("longitude", T.StringType()))
HOURLY_WEATHER = _struct(
    *_STORED_PLACE,
    ("datetime", T.TimestampType()),
    *[(name, MEASURE) for name in HOURLY_MEASURES],
    *_STORED_CONDITION,
)
CURRENT_WEATHER = _struct(
    *_STORED_PLACE,
    ("requested_datetime", T.TimestampType()),
    ("sunrise", T.TimestampType()),
    ("sunset", T.TimestampType()),
    *[(name, MEASURE) for name in CURRENT_MEASURES],
    *_STORED_CONDITION,
)

LOCATION_KEY = ["latitude", "longitude"]
HOURLY_KEY = ["latitude", "longitude", "datetime"]
CURRENT_KEY = ["latitude", "longitude", "requested_datetime"]

# --- bundles -----------------------------------------------------------------

_CODING = _struct(
    ("system", T.StringType()), ("code", T.StringType()), ("display", T.StringType())
)
_CONCEPT = _struct(("coding", T.ArrayType(_CODING)), ("text", T.StringType()))
_REFERENCE = _struct(("reference", T.StringType()), ("display", T.StringType()))
_IDENTIFIER = _struct(
    ("use", T.StringType()),
    ("type", _CONCEPT),
    ("system", T.StringType()),
    ("value", T.StringType()),
)
_NAME = _struct(
    ("use", T.StringType()),
    ("text", T.StringType()),
    ("family", T.StringType()),
    ("given", T.ArrayType(T.StringType())),
)
_ADDRESS = _struct(
    ("use", T.StringType()),
    ("line", T.ArrayType(T.StringType())),
    ("city", T.StringType()),
    ("state", T.StringType()),
    ("postalCode", T.StringType()),
    ("country", T.StringType()),
)
_CONTACT = _struct(
    ("system", T.StringType()), ("value", T.StringType()), ("use", T.StringType())
)
_META = _struct(("versionId", T.StringType()), ("lastUpdated", T.StringType()))

PATIENT = _struct(
    ("id", T.StringType()),
    ("active", T.BooleanType()),
    ("name", T.ArrayType(_NAME)),
    ("resourceType", T.StringType()),
    ("address", T.ArrayType(_ADDRESS)),
    ("birthDate", T.StringType()),
    ("careProvider", T.ArrayType(_REFERENCE)),
    ("gender", T.StringType()),
    ("identifier", T.ArrayType(_IDENTIFIER)),
    ("managingOrganization", _REFERENCE),
    ("maritalStatus", _CONCEPT),
    ("meta", _META),
    ("telecom", T.ArrayType(_CONTACT)),
)
SEARCH = _struct(("mode", T.StringType()))
PATIENT_ENTRY = _struct(("resource", PATIENT), ("search", SEARCH))
