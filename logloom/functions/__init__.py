"""Column functions: every rule is a built-in expression, none is a Python UDF."""

from logloom.functions.labels import error_marker, event_label, event_prefix, resolve_signature
from logloom.functions.once import once
from logloom.functions.predicates import (
    contains_text,
    is_api_error,
    is_api_warning,
    is_posting_failure,
    is_span_error,
    is_unreviewed,
    within,
)
from logloom.functions.text import first_line, is_signal, message_pattern, normalize_message
from logloom.functions.times import parse_api_time, parse_cobrand_time
from logloom.functions.variants import first_member, record, subtree, whole_number

__all__ = [
    "contains_text",
    "error_marker",
    "event_label",
    "event_prefix",
    "first_line",
    "first_member",
    "is_api_error",
    "is_api_warning",
    "is_posting_failure",
    "is_signal",
    "is_span_error",
    "is_unreviewed",
    "message_pattern",
    "normalize_message",
    "once",
    "parse_api_time",
    "parse_cobrand_time",
    "record",
    "resolve_signature",
    "subtree",
    "whole_number",
    "within",
]
