"""Values other systems depend on: measurement names, thresholds, durations, colours.

Fixed values. They are part of the contract with dashboards and stored points, so
they are listed here as they are; everything else takes them as default arguments.
"""

# Sources a reading can come from.
SOURCE_IN = "IN"
SOURCE_OUT = "OUT"

# Measurement names of stored points.
ROOMS_AVG = "rooms_avg"
ROOMS_TEMPERATURES = "rooms_temperatures"
NEW_ROOMS = "newrooms"

# Windows, gaps and thresholds of the main job.
AVERAGE_WINDOW = "5 seconds"
JOIN_WINDOW = "1 second"
OUT_OF_ORDERNESS = "3 seconds"
WATERMARK_INTERVAL = "1 second"
WARNING_THRESHOLD = 30
WARNING_GAP = "5 seconds"
ALERT_GAP = "10 seconds"

# Other defaults: reading filter, late-window grace, meter window, histogram size.
FILTER_THRESHOLD = 25
ALLOWED_LATENESS = "500 milliseconds"
METER_WINDOW = "5 seconds"
HISTOGRAM_SIZE = 10_000

# Sink batching of a time-series store, for sinks that write to one.
POINTS_PER_FILE = 1000
FLUSH_INTERVAL = "100 milliseconds"
POINTS_COMPRESSION = "gzip"

# Dashboard: time range, "latest" horizon, gauge range, grid range, bands
# (colour, lower bound).
DASHBOARD_RANGE = "30 minutes"
LATEST_RANGE = "15 seconds"
GAUGE_MIN, GAUGE_MAX = 0.0, 40.0
GRID_MIN, GRID_MAX = 0.0, 2.0
BANDS = (("green", None), ("#EAB839", 20), ("red", 30))
