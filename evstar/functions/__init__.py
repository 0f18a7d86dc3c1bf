"""Column-level helpers: every function takes and returns ``Column``s."""

from .calendar import calendar_columns, date_key, date_spine, date_spine_covering, is_weekend, iso_day_of_week
from .envelope import (
    ENVELOPE_FIELDS,
    envelope_columns,
    envelope_json,
    message_error,
    message_keys,
    message_text,
    missing_fields,
    parse_envelope,
    quarantine_value,
)
from .keys import message_key, stable_uuid, surrogate_key

__all__ = [
    "ENVELOPE_FIELDS",
    "calendar_columns",
    "date_key",
    "date_spine",
    "date_spine_covering",
    "envelope_columns",
    "envelope_json",
    "is_weekend",
    "iso_day_of_week",
    "message_error",
    "message_key",
    "message_keys",
    "message_text",
    "missing_fields",
    "parse_envelope",
    "quarantine_value",
    "stable_uuid",
    "surrogate_key",
]
