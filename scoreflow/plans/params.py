"""Fixed parameters of the registered queries."""

import datetime as dt

from scoreflow.functions.dates import LOCAL_ZONE

AS_OF = dt.date(2001, 8, 1)  # order dates end here; today would keep nothing
WINDOW_MONTHS = 6
SAMPLING_RATIO = 1.5
SEED = 42
SPLIT_WEIGHTS = (0.7, 0.3)
ACTIVITY_DAY = dt.date(2024, 1, 15)
EXPORT_TRIGGER = "2024-01-05T20:00:00"
EXPORT_ZONE = LOCAL_ZONE
