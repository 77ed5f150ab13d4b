from plantmetrics.functions.numeric import (
    any_true,
    clamp,
    hours_between,
    minutes_between,
    percent,
    ratio,
    stable_avg,
    stable_sum,
    to_number,
)
from plantmetrics.functions.timestamps import date_label, label_date, parse_timestamp

__all__ = [
    "any_true",
    "clamp",
    "date_label",
    "hours_between",
    "label_date",
    "minutes_between",
    "parse_timestamp",
    "percent",
    "ratio",
    "stable_avg",
    "stable_sum",
    "to_number",
]
