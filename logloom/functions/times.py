"""Event-time texts.

Two spellings exist: ``Sun, 12 Jul 2026 00:00:04 AM`` and, with a comma before
the clock, ``Tue, 21 Jul 2026, 00:00:47 pm``. An hour up to 12 obeys the
AM/PM mark; an hour beyond 12 can only be a 24-hour clock, so the mark is
ignored. A mark glued to the seconds is ignored as well.
"""

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, functions as F

from logloom.constants import MONTHS, WEEKDAYS


def _parse(text: str, comma: str) -> Column:
    shape = (
        rf"(?i)^\s*(?:{'|'.join(WEEKDAYS)}),\s+\d{{1,2}}\s+(?:{'|'.join(MONTHS)})\s+\d{{1,4}}{comma}"
        r"\s+\d{1,2}:[0-5]?\d:[0-5]?\d(?:\s*[ap]m)?\s*$"
    )
    # p is [weekday, day, month, year, hour, minute, second, AM/PM], split once and read by a lambda.
    number = "try_cast(get(p, {}) as int)".format
    hour, mark = number(4), "upper(get(p, 7))"
    clock = f"case when {hour} > 12 then {hour} when {mark} = 'PM' then {hour} % 12 + 12 when {mark} = 'AM' then {hour} % 12 else {hour} end"
    # The shape admits ASCII letters only; lower() would map them by the rules of Unicode, which takes many times as long.
    low = f"translate(get(p, 2), '{ascii_uppercase}', '{ascii_lowercase}')"
    month = f"cast((instr('{''.join(MONTHS).lower()}', {low}) + 2) / 3 as int)"
    second = "try_cast(translate(get(p, 6), 'APMapm', '') as int)"
    stamp = f"try_make_timestamp_ntz({number(3)}, {month}, {number(1)}, {clock}, {number(5)}, {second})"
    parts = rf"array(split(btrim({text}), r'[\s,:]+'))"
    return F.expr(f"case when {text} rlike r'{shape}' then get(transform({parts}, p -> {stamp}), 0) end")


def parse_api_time(text: str) -> Column:
    """Time text of an API line (a column's name) -> TIMESTAMP_NTZ; NULL when it is not one."""
    return _parse(text, "")


def parse_cobrand_time(text: str) -> Column:
    """Time text of a Cobrand line (comma before the clock) -> TIMESTAMP_NTZ."""
    return _parse(text, ",")
