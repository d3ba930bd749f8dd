"""Feature expressions: functions from Column to Column that stay inside generated JVM code."""

from featloom.functions.flags import band, missing_flag, present_flag
from featloom.functions.numeric import nan_to_null, ratio, round0
from featloom.functions.text import (
    alpha_code,
    empty_to_null,
    first_char,
    optional_capture,
    title_prefix,
    token_count,
)

__all__ = [
    "alpha_code",
    "band",
    "empty_to_null",
    "first_char",
    "missing_flag",
    "nan_to_null",
    "optional_capture",
    "present_flag",
    "ratio",
    "round0",
    "title_prefix",
    "token_count",
]
