from txloom.functions.columns import (
    BUCKETS,
    ZERO_ADDRESS,
    day_of,
    day_slice,
    flow_partition,
    hex_bucket,
    logistic,
    md5_bucket,
    safe_numeric,
)
from txloom.functions.relations import (
    accumulate,
    new_only,
    tag_rows,
    union_distinct,
)
from txloom.functions.rolling import previous_row_means

__all__ = [
    "BUCKETS",
    "ZERO_ADDRESS",
    "accumulate",
    "day_of",
    "day_slice",
    "flow_partition",
    "hex_bucket",
    "logistic",
    "md5_bucket",
    "new_only",
    "previous_row_means",
    "safe_numeric",
    "tag_rows",
    "union_distinct",
]
