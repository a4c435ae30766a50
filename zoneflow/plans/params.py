"""Fixed parameters of the registered queries (shared by the Spark plans and their SQL twins)."""

import datetime as dt

# Dashboard "now" for the history fixture: the end of the last hourly tick of the test data.
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
# History ticks: one trigger per hour of message time.
TICK = "1 hour"
TICK_SECONDS = 3600
# The two dashboard ranges checked: the default and the maximum.
RANGE_SHORT = 60
RANGE_LONG = 1440
# A range whose start lies inside an hour: rollups need finer buckets and single documents at its ends.
RANGE_RAGGED = 1003
