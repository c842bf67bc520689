"""Message text: first line, normalization, noise."""

from pyspark.sql import Column, functions as F

from logloom.constants import NOISE_MESSAGES, NORMALIZATION


def first_line(text: Column) -> Column:
    """Text before the first line feed, without surrounding blanks, tabs and CRs."""
    return F.btrim(F.substring_index(text, "\n", 1), F.lit(" \r\n\t"))


def normalize_message(text: Column) -> Column:
    """Replace what varies between occurrences (times, ids, addresses, numbers) by a token."""
    for pattern, token in NORMALIZATION:
        text = F.regexp_replace(text, pattern, token)
    return text


def message_pattern(text: Column) -> Column:
    """The grouping key of a message: its normalized first line."""
    return normalize_message(first_line(text))


def is_signal(message: Column) -> Column:
    """True for messages worth grouping; NULL (so filtered out) for a NULL message."""
    return ~message.isin(*NOISE_MESSAGES)
