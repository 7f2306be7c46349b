"""Text forms of timestamps, windows and numbers, and checked parsing of the same.

All functions are built-in expressions. They expect ``spark.sql.session.timeZone = UTC``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted spellings of a timestamp, a whole number and a special double.
TIMESTAMP_PATTERN = r"^\s*\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,9})?\s*$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
SPECIAL_DOUBLE_PATTERN = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$"
EXACT_SPECIAL_DOUBLE_PATTERN = r"^\s*[+-]?Infinity\s*$"


def timestamp_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.f``: at least one fraction digit, further trailing zeros cut."""
    cut = F.rtrim(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("0"))
    return F.concat(cut, F.when(F.endswith(cut, F.lit(".")), "0").otherwise(""))


def iso_instant(ts: Column) -> Column:
    """ISO instant with no fraction, milliseconds or microseconds, whichever is the shortest."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return (
        F.when(micros == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(micros % 1000 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )


def windowed_key(key: Column, window: Column) -> Column:
    """``[key@startMillis/endMillis]``."""
    start = F.unix_millis(window["start"]).cast("string")
    end = F.unix_millis(window["end"]).cast("string")
    return F.concat(F.lit("["), key, F.lit("@"), start, F.lit("/"), end, F.lit("]"))


def epoch_seconds(ts: Column) -> Column:
    return F.floor(F.unix_millis(ts) / 1000)


def quoted(value: Column) -> Column:
    """Double-quoted text; a missing value is written as ``null``."""
    return F.concat(F.lit('"'), F.coalesce(value, F.lit("null")), F.lit('"'))


def parse_timestamp(text: Column) -> Column:
    """NULL unless ``text`` is ``yyyy-[m]m-[d]d hh:mm:ss[.f...]``; ISO ``T`` forms are refused."""
    return F.when(text.rlike(TIMESTAMP_PATTERN), F.trim(text).try_cast("timestamp"))


def parse_int(text: Column) -> Column:
    """NULL unless ``text`` is a sign and digits within 32 bits; blanks are refused."""
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("int"))


def parse_score(text: Column) -> Column:
    """NULL unless ``text`` is a number that can be added to a score: NaN is refused."""
    usable = ~text.rlike(SPECIAL_DOUBLE_PATTERN) | text.rlike(EXACT_SPECIAL_DOUBLE_PATTERN)
    return F.when(usable, text.try_cast("double"))
