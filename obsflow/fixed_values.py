"""Fixed values.

These must stay as they are for the results to come out as expected; nothing
else in the package hard-codes them.
"""

# Locations that are asked for when no override is given (latitude, longitude).
DEFAULT_LOCATIONS = [
    ("30.318878", "-81.690173"),
    ("28.538336", "-81.379234"),
    ("27.950575", "-82.457176"),
    ("25.761681", "-80.191788"),
    ("34.052235", "-118.243683"),
    ("40.712776", "-74.005974"),
    ("41.878113", "-87.629799"),
    ("32.776665", "-96.796989"),
    ("47.950356", "-124.385490"),
    ("36.169941", "-115.139832"),
]

# How many days before the anchor a run asks for, and the unit system it asks in.
TRAILING_DAYS = 5
DEFAULT_UNITS = "metric"

# Response codes that count as a good answer.
ACCEPTED_STATUS = (200, 204)

# Coordinates are compared after rounding to this many places; averages to this many.
COORDINATE_SCALE = 4
AVERAGE_SCALE = 2

# Longest text a stored column may hold, and the rows shown by a preview.
MAX_TEXT_LENGTH = 255
PREVIEW_ROWS = 15

# Formats.
STAMP_SECONDS = "yyyyMMddHHmmss"
STAMP_MICROS = "yyyyMMddHHmmssSSSSSS"
TOTAL_MESSAGE = "Total order value is: %.2f"

# Bundle resources, each landed in a folder of its own.
BUNDLE_RESOURCES = (
    "organization",
    "location",
    "patient",
    "procedure",
    "practitioner",
    "ServiceRequest",
)

# Names under which the two marts are published.
DAILY_MAX_VIEW = "VW_DATASET_1"
DAILY_STATS_VIEW = "VW_DATASET_2"
