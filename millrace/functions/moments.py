"""Date and time expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A month counts 30 days and a year 365 in differences and ages.
SECONDS = {
    "years": 31536000, "months": 2592000, "weeks": 604800, "days": 86400,
    "hours": 3600, "minutes": 60, "seconds": 1,
}
# Pattern letters and what Spark calls them.
PATTERNS = {
    "YYYY": "yyyy", "MMM": "MMM", "MM": "MM", "DD": "dd", "HH": "HH", "mm": "mm", "ss": "ss", "ddd": "EEE",
}


def add_time(moment: Column, amount: int, unit: str) -> Column:
    """Shift a timestamp; months and years stop at the end of a shorter month."""
    return F.timestamp_add(unit.rstrip("s").upper(), F.lit(amount), moment)


def micros(moment: Column) -> Column:
    """Microseconds of the wall-clock time since 1970; no session zone is involved."""
    wall = moment.cast("timestamp_ntz")
    days = F.datediff(wall.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = days * 1440 + F.hour(wall) * 60 + F.minute(wall)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), wall) * 1_000_000).cast("bigint")


def floor_div(value: Column, size: int) -> Column:
    """Whole division rounded towards minus infinity, in integers."""
    return F.call_function("div", value - F.pmod(value, F.lit(size)), F.lit(size))


def date_diff(first: Column, second: Column, unit: str = "days") -> Column:
    """Whole units from ``first`` to ``second``, rounded towards minus infinity."""
    return floor_div(micros(second) - micros(first), SECONDS[unit] * 1_000_000)


def format_date(moment: Column, pattern: str = "YYYY-MM-DD") -> Column:
    """Format with YYYY MM DD HH mm ss ddd MMM; anything else is literal."""
    out = []
    for piece in re.split("(YYYY|MMM|MM|DD|HH|mm|ss|ddd)", pattern):
        if piece in PATTERNS:
            out.append(PATTERNS[piece])
        elif piece:
            out.append("'" + piece.replace("'", "''") + "'")
    return F.date_format(moment, "".join(out))


def is_valid_date(text: Column) -> Column:
    return text.try_cast("timestamp").isNotNull()


def time_ago(moment: Column, now: Column) -> Column:
    """Age in the largest unit that fits, ``just now`` below a minute."""
    seconds = floor_div(micros(now) - micros(moment), 1_000_000)
    out = F.lit("just now")
    for unit in ("minutes", "hours", "days", "weeks", "months", "years"):
        size = SECONDS[unit]
        n = floor_div(seconds, size)
        label = F.concat(n, F.lit(f" {unit[:-1]}"), F.when(n > 1, "s").otherwise(""), F.lit(" ago"))
        out = F.when(seconds >= size, label).otherwise(out)
    return out


def expand_dates(column: str) -> dict[str, Column]:
    """Year, month, day, weekday (Monday 0) and weekend flag of a timestamp column."""
    c = F.col(column)
    return {
        f"{column}_year": F.year(c),
        f"{column}_month": F.month(c),
        f"{column}_day": F.day(c),
        f"{column}_dayofweek": F.weekday(c),
        f"{column}_is_weekend": (F.weekday(c) >= 5).cast("int"),
    }
