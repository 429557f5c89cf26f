"""Safe casts and text predicates: failures become null, never errors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline import constants as K

DAY_FIRST = r"^\s*(\d{1,2})[./-](\d{1,2})[./-](\d{4})([ T].*)?$"
COMPACT = r"^\s*(\d{4})(\d{2})(\d{2})\s*$"
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
SPELLED = (
    r"(?i)^\s*(\d{1,2})[ -](jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    r"sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)[ -](\d{4})([ T].*)?$"
)
SHORT_YEAR = r"^\s*(\d{1,2})[./-](\d{1,2})[./-](\d{2})\s*$"
FIRST_TWO = r"^\s*(\d{1,2})[./-](\d{1,2})[./-](?:\d{4}|\d{2})(?:[ T].*)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d{1,18}\s*$"
STARTS_WITH_DIGIT = r"^\s*\d"
YEAR_FIRST = r"^\s*(\d{4})[./-](\d{1,2})[./-](\d{1,2})([ T].*)?$"


def anywhere_stripped(patterns: tuple[str, ...]) -> str:
    """One anchored pattern for several, blind to white space around the text. A text that
    does not start like a match is rejected at its first character."""
    bodies = [p.removeprefix("^").replace("$", r"\s*$") for p in patterns]
    return r"^\s*(?:" + "|".join(bodies) + ")"


def to_number(column: Column) -> Column:
    """Text to double. The pattern guard rejects forms only the JVM takes, such as '1d'."""
    return F.when(
        column.rlike(anywhere_stripped((K.NUMBER_PATTERN, K.INFINITY_PATTERN))),
        column.try_cast("double"),
    )


def to_timestamp(column: Column, month_first: bool = False) -> Column:
    """Text to timestamp: ISO first, then day-first forms (month-first ones if the column holds
    them), `20240105`, `05-Jan-2024` or `5 January 2024`, and years of two digits (69 to 99 are
    of the last century). Independent of the session zone."""
    short = F.regexp_replace(column, SHORT_YEAR, "$3")
    century = F.when(short.try_cast("int") >= 69, "19").otherwise("20")
    day, month = ("2", "1") if month_first else ("1", "2")
    spelled = F.substring(F.lower(F.regexp_extract(column, SPELLED, 2)), 1, 3)
    number = ((F.instr(F.lit(MONTHS), spelled) + 2) / 3).cast("int").cast("string")
    branches = (
        (DAY_FIRST, F.regexp_replace(column, DAY_FIRST, f"$3-${month}-${day}$4")),
        (YEAR_FIRST, F.regexp_replace(column, YEAR_FIRST, "$1-$2-$3$4")),
        (COMPACT, F.regexp_replace(column, COMPACT, "$1-$2-$3")),
        (SPELLED, F.concat(F.regexp_extract(column, SPELLED, 3), F.lit("-"), number, F.lit("-"),
                           F.regexp_extract(column, SPELLED, 1), F.regexp_extract(column, SPELLED, 4))),
        (SHORT_YEAR, F.concat(century, F.regexp_replace(column, SHORT_YEAR, f"$3-${month}-${day}"))),
    )
    iso = F.lit(None).cast("string")
    for pattern, parts in reversed(branches):
        iso = F.when(column.rlike(pattern), parts).otherwise(iso)
    # every form starts so; other text is told by one test instead of five
    return F.when(column.rlike(STARTS_WITH_DIGIT), F.trim(iso).try_cast("timestamp_ntz"))


def proves_month_first(column: Column) -> Column:
    """The second of three numbers is no month, the first may be one."""
    first, second = (F.regexp_extract(column, FIRST_TWO, k).try_cast("int") for k in (1, 2))
    return (second > 12) & (first <= 12)


def proves_day_first(column: Column) -> Column:
    first = F.regexp_extract(column, FIRST_TWO, 1).try_cast("int")
    return first > 12


def looks_like_date(column: Column) -> Column:
    return column.rlike(anywhere_stripped(K.DATE_PATTERNS))


def looks_like_id(column: Column) -> Column:
    return column.rlike(anywhere_stripped(K.ID_PATTERNS))


def has_control_characters(column: Column) -> Column:
    return column.rlike(K.CONTROL_CHARACTERS)


def name_has(column: Column, words: tuple[str, ...]) -> Column:
    """True where a column name contains one of the hint words."""
    lowered = F.lower(column)
    return reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])


def name_words(name: Column) -> Column:
    return F.array_distinct(F.split(F.lower(name), K.NAME_SPLIT_PATTERN))


def name_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of the tokens of two names."""
    left, right = name_words(a), name_words(b)
    return F.size(F.array_intersect(left, right)) / F.size(F.array_union(left, right))


def percent(part: Column, total: Column) -> Column:
    """Share in percent at two decimals, half to even; 0 for an empty table."""
    share = F.bround(part.cast("double") / total.cast("double") * 100, 2)
    return F.when(total == 0, F.lit(0.0)).otherwise(share)


def thousands(value: Column, decimals: int = 4) -> Column:
    return F.format_number(value, decimals)


def business_days(start: Column, end: Column) -> Column:
    """Weekdays in [start, end), by closed form from a Monday."""

    def weekdays_since_monday(day: Column) -> Column:
        offset = F.datediff(day, F.lit("1970-01-05").cast("date"))
        return F.floor(offset / 7) * 5 + F.least(F.pmod(offset, F.lit(7)), F.lit(5))

    return weekdays_since_monday(end) - weekdays_since_monday(start)
