"""SQL expressions that turn attribute text into typed columns.

Each function takes a column name and returns SQL text for `selectExpr`. An
attribute can be absent (null), empty or filled; the three are kept apart:

| text              | `int_or_zero` | `int_or_null` |
| ----------------- | ------------- | ------------- |
| absent            | 0             | null          |
| empty             | null          | null          |
| not an integer    | null          | null          |

Integers are 64-bit. Integer text beyond that is no null: `beyond_bigint` tells it, and
the line becomes a reject.
"""

from __future__ import annotations

# Text forms of integers and of timestamps. `\z`, because `$`
# would accept a final newline.
INT_TEXT = r"\A[+-]?[0-9]+\z"
TIMESTAMP_TEXT = (
    r"\A(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\.[0-9]{1,6}\z"
)


def matches(text: str, pattern: str) -> str:
    return f"{text} rlike r'{pattern}'"


def int_or_null(text: str) -> str:
    # try_cast alone would trim blanks and read " 5 " as 5
    return f"try_cast(if({matches(text, INT_TEXT)}, {text}, null) as bigint)"


def int_or_zero(text: str) -> str:
    return f"if({text} is null, 0, {int_or_null(text)})"


def beyond_bigint(text: str) -> str:
    """Holds for integer text that no 64-bit integer can take."""
    return f"(length({text}) > 18 and {matches(text, INT_TEXT)} and {int_or_null(text)} is null)"


def length_or_zero(text: str) -> str:
    """Characters of the decoded text, markup included."""
    return f"coalesce(cast(length({text}) as bigint), 0)"


def presence_flag(text: str) -> str:
    return f"cast(coalesce(length({text}) > 0, false) as int)"


def instant(text: str) -> str:
    """UTC timestamp of ISO text; null if absent or invalid. Independent of the session zone.

    Leap seconds, 60 and 61, are taken as 59; `epoch_or_zero` counts them.
    """
    valid = f"if({matches(text, TIMESTAMP_TEXT)}, {text}, null)"
    return f"try_to_timestamp(concat(replace(replace({valid}, ':60.', ':59.'), ':61.', ':59.'), 'Z'))"


def epoch_or_zero(text: str) -> str:
    """Whole seconds since 1970, rounded down; 0 if absent, null if invalid."""
    leap = f"case when contains({text}, ':60.') then 1 when contains({text}, ':61.') then 2 else 0 end"
    return f"if({text} is null, 0, unix_seconds({instant(text)}) + {leap})"


def truth_flag(number: str) -> str:
    """1 if not zero, 0 if zero, null if null."""
    return f"cast(cast({number} as boolean) as int)"


def ratio(total: str, count: str) -> str:
    """Exact long totals divided as doubles; null if the count is 0."""
    return f"try_divide({total}, {count})"
