"""Parameters of the registered queries (fixed so Spark and the oracle agree).

The sales facts are loaded whole; range operators are exercised with a narrower window whose bounds fall
mid-data, which is the operator's purpose, not a row cap.
"""

# None: no bound, whatever dates the data hold.
FULL_START = None
FULL_END = None
# A window given to load_window; loads and calendars follow the data.
GIVEN_START = "1995-01-01"
GIVEN_END = "2001-12-31"
RANGE_START = "1996-03-01"
RANGE_END = "1998-02-28"
AS_OF = "2001-08-01"
NOW = "2026-01-01 00:00:00"
LATER = "2026-02-01 00:00:00"

# Upsert scenario: the target holds an earlier load, the batch an overlapping later one.
OLD_END = "1999-12-31"
NEW_START = "1999-01-01"
RELOAD_START = "1999-01-15"

# Restricted valid sets that make the membership tests bite on the driver data.
ACTIVE_ONLY = "active = 'Y'"
MAX_VALID_GROUP = 40

SMA_N = 3
WAG_N = 3
YOY_YEARS = 5
SAFETY_FACTOR_PCT = 10.0
TOP_K = 5
