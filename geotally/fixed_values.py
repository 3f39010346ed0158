"""Values that results must contain exactly as written."""

# Hour ranges of the day phases (both ends included), their labels and
# the name of the wide mean column of each.
DAY_PHASES = (
    (0, 5, "DAWN_0_TO_5", "dawn_avg"),
    (6, 11, "MORNING_6_TO_11", "morning_avg"),
    (12, 17, "NOON_12_TO_17", "noon_avg"),
    (18, 23, "EVENING_18_TO_23", "evening_avg"),
)
UNKNOWN_PHASE = "Unknown"

# Weekday names, Monday first (ISO day numbers 1 to 7).
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Stations kept in the projected air table unless the caller names others.
PROJECTED_STATIONS = ("FCKTB", "FCWYG", "FDQBU", "FDQBX", "FEUZB")

# Marker classes above, below and at the mean.
ABOVE_MEAN, BELOW_MEAN, AT_MEAN = "red", "green", "black"

# Width of blank-padded month and weekday names.
PADDED_NAME_WIDTH = 9

# Spatial reference ids. Coordinates are degrees (4326); tables that must
# look like the published ones carry the label 26917.
SRID_DEGREES, SRID_UTM17 = 4326, 26917

# Hours between UTC and the insertion stamp's zone (no daylight saving).
EST_OFFSET_HOURS = 5

# Years between the newest observation and the first forecast date.
FORECAST_GAP_YEARS = 9

# Words accepted as forecast frequency, the period code and its label.
FREQUENCY_WORDS = (
    ("HOUR", "h", "Hourly"),
    ("DAY", "D", "Daily"),
    ("DAILY", "D", "Daily"),
    ("MONTH", "MS", "Monthly"),
    ("YEAR", "YS", "Yearly"),
    ("ANNUAL", "YS", "Yearly"),
    ("QUARTER", "QS", "Quarterly"),
)

# Run-log rows, with their end times, that exist before their steps have run.
PLACEHOLDER_PHASE = "WebMaps"
PLACEHOLDER_STEPS = (
    ("folium", "2002-03-15 13:59:12.498894"),
    ("mapbox", "2002-03-15 13:59:12.498894"),
    ("turf", "2002-03-15 13:59:12.498894"),
    ("auto_ml", "2002-03-15 13:59:12.498894"),
    ("create_dataframes", "2024-03-15 13:59:12.498894"),
    ("test_maps", "2024-03-15 13:59:12.498894"),
)
PLACEHOLDER_NUMBER = -1.0
PLACEHOLDER_START = "2002-05-01 00:00:00"

# Name of the summary row that the combined run log leaves out.
TOTAL_STEP = "create_production_tables"

# Map kinds recognised in a file name.
MAP_KINDS = (("FOLIUM", "folium"), ("TURF", "turf"), ("MAPBOX", "mapbox"))
UNKNOWN_MAP_KIND = "unknown"

# Catalogue names never exported.
EXPORT_SKIPS = ("spatial_ref_sys", "geography_columns", "geometry_columns")
