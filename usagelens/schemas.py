"""Column lists and schemas shared by every layer.

The names below are fixed values: they are the wire format and the table
contract, so they have to be spelled exactly like this.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: event kinds ------------------------------------------------
API_REQUEST = "api_request"
TOOL_DECISION = "tool_decision"
TOOL_RESULT = "tool_result"
USER_PROMPT = "user_prompt"
API_ERROR = "api_error"
EVENT_NAMES = [API_REQUEST, TOOL_DECISION, TOOL_RESULT, USER_PROMPT, API_ERROR]

# --- fixed values: flat event columns ------------------------------------------
REQUIRED_COLUMNS = ["event_type", "event_name", "timestamp", "session_id", "user_id", "email"]
TEXT_COLUMNS = [
    "event_type", "event_name", "session_id", "user_id", "email",
    "model", "tool_name", "terminal_type", "organization_id", "practice",
]
NUMERIC_COLUMNS = [
    "input_tokens", "output_tokens", "cache_read_tokens", "cache_creation_tokens",
    "cost_usd", "duration_ms", "prompt_length",
]
# The columns whose nulls, negative values and Unknowns the quality report counts.
NULL_CHECKED = ["timestamp", "session_id", "user_id", "email", "practice", "model", "tool_name"]
NEGATIVE_CHECKED = ["input_tokens", "output_tokens", "cache_read_tokens",
                    "cache_creation_tokens", "cost_usd", "duration_ms"]
MISSING_CHECKED = ["practice", "level", "location"]
EMPLOYEE_COLUMNS = ["email", "full_name", "practice", "level", "location"]
UNKNOWN = "Unknown"

# --- fixed values: where each flat column sits in a decoded log message ---------
BODY_COLUMN = "event_type"
ATTRIBUTE_KEYS = {
    "event_name": "event.name",
    "timestamp": "event.timestamp",
    "session_id": "session.id",
    "user_id": "user.id",
    "email": "user.email",
    "model": "model",
    "input_tokens": "input_tokens",
    "output_tokens": "output_tokens",
    "cache_read_tokens": "cache_read_tokens",
    "cache_creation_tokens": "cache_creation_tokens",
    "cost_usd": "cost_usd",
    "duration_ms": "duration_ms",
    "prompt_length": "prompt_length",
    "tool_name": "tool_name",
    "success": "success",
    "terminal_type": "terminal.type",
    "organization_id": "organization.id",
}
RESOURCE_KEYS = {"practice": "user.practice"}

RAW_COLUMNS = [BODY_COLUMN, *ATTRIBUTE_KEYS, *RESOURCE_KEYS]

# Events are numbered in this order; nulls last. The first three columns are the
# ordering proper, the rest settles ties so that the numbering is a function of
# the data alone. Identity columns come first among the tie-breakers: the session
# and user tables rely on that to find "the first event" from grouped rows.
EVENT_ORDER = [
    "timestamp", "session_id", "event_name",
    "user_id", "email", "organization_id", "practice",
    "model", "tool_name", "terminal_type", "event_type",
    *NUMERIC_COLUMNS, "success",
]


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Wire values are strings; a JSON number or boolean read as a string keeps its text.
MESSAGE = T.StructType([
    T.StructField("body", T.StringType()),
    T.StructField("attributes", _strings(ATTRIBUTE_KEYS.values())),
    T.StructField("resource", _strings(RESOURCE_KEYS.values())),
])

ENVELOPE = T.StructType([
    T.StructField("messageType", T.StringType()),
    T.StructField("owner", T.StringType()),
    T.StructField("logGroup", T.StringType()),
    T.StructField("logStream", T.StringType()),
    T.StructField("subscriptionFilters", T.ArrayType(T.StringType())),
    T.StructField("logEvents", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("message", T.StringType()),
    ]))),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
])

RAW_EVENTS = _strings(RAW_COLUMNS)
