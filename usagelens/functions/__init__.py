from usagelens.functions.aggregates import first_filled, most_frequent
from usagelens.functions.calendar import calendar_columns, minutes_between, seconds_between
from usagelens.functions.clean import (
    clean_bool, clean_number, clean_text, clean_timestamp, clean_wire_text, or_unknown,
)
from usagelens.functions.measures import (
    kind_flags, per_thousand, ratio_or, request_ratios, round_to, token_measures,
)

__all__ = [
    "calendar_columns", "clean_bool", "clean_number", "clean_text", "clean_timestamp",
    "clean_wire_text", "first_filled", "kind_flags", "minutes_between", "most_frequent", "or_unknown",
    "per_thousand", "ratio_or", "request_ratios", "round_to", "seconds_between",
    "token_measures",
]
