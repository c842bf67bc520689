"""Labels derived from other columns."""

from pyspark.sql import Column, functions as F

from logloom.constants import (
    ERROR_MARK,
    NESTED_PREFIX,
    NO_ERROR_MARK,
    SIGNATURES,
    UNINSTRUMENTED,
    UNKNOWN_EVENT,
)


def event_prefix(event_action: Column) -> Column:
    """Family of an event: the part before the first dot, but two parts below the nested prefix."""
    return F.when(event_action.startswith(NESTED_PREFIX + "."), F.lit(NESTED_PREFIX)).otherwise(
        F.substring_index(event_action, ".", 1)
    )


def resolve_signature(raw_pattern: Column) -> Column:
    """Short label of a known failure pattern; the pattern itself when no rule knows it."""
    label = F
    for pattern, signature in SIGNATURES:
        label = label.when(raw_pattern.rlike(f"(?i){pattern}"), F.lit(signature))
    return label.otherwise(raw_pattern)


def event_label(
    event_action: Column,
    signature: Column,
    probable_component: Column,
    raw_pattern: Column,
    message: Column,
    error_message: Column,
) -> Column:
    """What to call a row: its action, else its known failure, else an honest placeholder.

    A signature equal to its own pattern is the "no rule" fallback, not a name.
    """
    named = signature.isNotNull() & (raw_pattern.isNull() | (signature != raw_pattern))
    return (
        F.when(event_action.isNotNull(), event_action)
        .when(named & probable_component.isNotNull(), F.concat(signature, F.lit(" ("), probable_component, F.lit(")")))
        .when(named, signature)
        .when(message.isNotNull() | error_message.isNotNull(), F.lit(UNINSTRUMENTED))
        .otherwise(F.lit(UNKNOWN_EVENT))
    )


def error_marker(error_message: Column) -> Column:
    return F.when(error_message.isNotNull(), F.lit(ERROR_MARK)).otherwise(F.lit(NO_ERROR_MARK))
