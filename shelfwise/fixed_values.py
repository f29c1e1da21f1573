"""Fixed values that must equal the upstream system's for identical results.

They are stated once here, in plain text, and imported everywhere else.
"""

# Column defaults of the operational store.
STATUS_ACTIVE = "ACTIVE"
UNSPECIFIED_PRODUCT = "Unspecified Product"
PO_STATUS_DEFAULT = "รอตัดสินใจ"  # "awaiting decision"

# Source codes.
ACTIVE_FLAG = "Y"
SUPPLIER_TYPE = "S"
CUSTOMER_TYPE = "C"

# Batch window rules.
MAX_PROBE_DAYS = 7
DEFAULT_LOOKBACK_DAYS = 7
REPAIR_DEFAULT_DAYS = 7
FULL_MODE_DEFAULT_START = "2026-01-01"
END_OF_DAY = "23:59:59"

# Monthly partition suffix, e.g. y2026m08 (Spark datetime pattern).
PARTITION_SUFFIX_PATTERN = "'y'yyyy'm'MM"
