"""Column-in, column-out building blocks. All stay on the JVM and never raise on bad data."""

from arealis.functions.casts import (
    census_bigint,
    census_double,
    census_text,
    clock_hour,
    parse_clock,
    parse_coordinate,
    parse_date,
    parse_flag,
    parse_integer,
    parse_number,
    parse_timestamp,
)
from arealis.functions.ratios import (
    complement,
    composite_mean,
    log1p_or_null,
    rate_per,
    safe_ratio,
    weighted_share,
    yes_share,
)
from arealis.functions.rules import Rule, categorize, indicator
from arealis.functions.text import column, normalize_name, null_tokens_to_null, tidy

__all__ = [
    "Rule",
    "categorize",
    "census_bigint",
    "census_double",
    "census_text",
    "clock_hour",
    "column",
    "complement",
    "composite_mean",
    "indicator",
    "log1p_or_null",
    "normalize_name",
    "null_tokens_to_null",
    "parse_clock",
    "parse_coordinate",
    "parse_date",
    "parse_flag",
    "parse_integer",
    "parse_number",
    "parse_timestamp",
    "rate_per",
    "safe_ratio",
    "tidy",
    "weighted_share",
    "yes_share",
]
