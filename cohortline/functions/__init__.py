"""Column-level helpers built from Spark's own expressions (no Python UDFs)."""

from cohortline.functions.columns import (
    METRICS,
    crossed,
    email_domain,
    exact,
    metric_columns,
    reached,
    round_half_up_div,
    rounded_share,
    safe_percentage,
    whole_percent,
)

__all__ = [
    "METRICS",
    "crossed",
    "email_domain",
    "exact",
    "metric_columns",
    "reached",
    "round_half_up_div",
    "rounded_share",
    "safe_percentage",
    "whole_percent",
]
