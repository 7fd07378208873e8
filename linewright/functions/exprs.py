"""Column expressions shared by the operators. All of them stay inside generated code."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds_of(duration: str) -> int:
    """Seconds in a duration such as ``"24 hours"`` (fixed-length units only)."""
    found = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", duration.lower())
    if not found or found.group(2) not in _UNITS:
        raise ValueError(f"not a fixed-length duration: {duration!r}")
    return int(found.group(1)) * _UNITS[found.group(2)]


def parse_timestamp(column: Column | str, fmt: str | None = None) -> Column:
    """String to timestamp; text that is no timestamp becomes NULL instead of failing the job."""
    text = F.col(column) if isinstance(column, str) else column
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def epoch_us(column: Column | str) -> Column:
    """Microseconds since 1970 (sessions run in UTC)."""
    value = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(value.cast("timestamp"))


def slice_start(column: Column | str, seconds: int) -> Column:
    """Start, in microseconds since 1970, of the time slice that holds a moment. Whole-number
    arithmetic, also right before 1970."""
    at = epoch_us(column)
    return at - F.pmod(at, F.lit(seconds * 1_000_000).cast("long"))


def from_epoch_us(micros: Column, like: T.DataType) -> Column:
    """The inverse of :func:`epoch_us`, in the timestamp type of another column."""
    return F.timestamp_micros(micros).cast(like)


def as_flag(column: Column | str) -> Column:
    """A 0/1 flag as double, absent meaning 0."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(value.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, NULL for an empty whole."""
    return F.try_divide(part, whole) * 100


def as_fixed(column: Column | str, digits: int) -> Column:
    """A decimal reading as a whole number of ``10^-digits`` steps."""
    value = F.col(column) if isinstance(column, str) else column
    return F.rint(value * float(10**digits)).cast("long")


def fixed_mean(total: Column, count: Column, digits: int) -> Column:
    """Mean from a fixed-point total."""
    return F.try_divide(total.cast("double") / float(10**digits), count)


def defect_rate_labelled(label: str) -> Column:
    """Percent defective among labelled rows; NULL when no row has a label."""
    return percent(F.sum(F.col(label).cast("long")), F.count(label))


def defect_rate_all(label: str) -> Column:
    """Percent defective among all rows; unlabelled rows count as good."""
    return percent(F.count_if(F.col(label) == 1), F.count(F.lit(1)))


# Names and conditions of the risk features of one card transaction.
CARD_FEATURES = {
    "is_high_risk_method": "cast(is_tor_or_vpn = 1 OR three_ds_result = 'FAILED' AS int)",
    "is_foreign_ip": "cast(ip_country_match = 0 AS int)",
    "is_unrecognized_device": "cast(device_fingerprint_known = 0 AS int)",
    "amount_log": "log1p(amount)",
    "is_cross_border_online": "cast(cross_border = 1 AND payment_method = 'online' AS int)",
}


def derived_card_features() -> dict[str, Column]:
    return {name: F.expr(sql) for name, sql in CARD_FEATURES.items()}
