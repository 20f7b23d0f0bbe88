"""Derived measures. Division by zero never raises; it takes the stated default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from usagelens.schemas import API_ERROR, API_REQUEST, TOOL_RESULT


def token_measures() -> dict[str, Column]:
    total = F.col("input_tokens") + F.col("output_tokens")
    cached = F.col("cache_read_tokens") + F.col("cache_creation_tokens")
    return {
        "total_tokens": total,
        "cached_tokens": cached,
        "total_token_footprint": total + cached,
        "duration_seconds": F.col("duration_ms") / 1000.0,
    }


def kind_flags() -> dict[str, Column]:
    name = F.col("event_name")
    return {
        "has_model": F.col("model") != "",
        "has_tool": F.col("tool_name") != "",
        "is_api_request": name == API_REQUEST,
        "is_tool_result": name == TOOL_RESULT,
        "is_error": name == API_ERROR,
    }


def ratio_or(top: Column, bottom: Column, default) -> Column:
    default = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")),
                      default.cast("double"))


def per_thousand(amount: Column, count: Column) -> Column:
    return ratio_or(amount, count / 1000.0, 0.0)


def request_ratios() -> dict[str, Column]:
    return {
        "cost_per_1k_tokens": per_thousand(F.col("cost_usd"), F.col("total_tokens")),
        "cache_ratio": ratio_or(F.col("cached_tokens"), F.col("total_token_footprint"), 0.0),
    }


def round_to(c: Column, digits: int) -> Column:
    """Round half away from zero on the binary value, the way SQL engines do.

    ``F.round(1.005, 2)`` works on the decimal text and gives 1.01; scaling first
    gives 1.0.
    """
    scale = float(10 ** digits)
    return F.round(c.cast("double") * scale, 0) / scale


def round_even(c: Column, digits: int) -> Column:
    """Round half to even, as in data-frame tables."""
    scale = float(10 ** digits)
    return F.rint(c.cast("double") * scale) / scale
