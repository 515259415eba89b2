"""String standardising, file-key parsing, character repair."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date layouts in a file key, in order of precedence. The hive layout is taken as one piece and
# rewritten, so that one extraction does for three parts.
HIVE_DATE = r"year=(\d{4}/month=\d{2}/day=\d{2})"
DT_DATE = r"dt=(\d{4}-\d{2}-\d{2})"
PLAIN_DATE = r"(\d{4}/\d{2}/\d{2})"


def upper_trim(c: Column) -> Column:
    return F.trim(F.upper(c))


def lower_trim(c: Column) -> Column:
    return F.trim(F.lower(c))


def _found(key: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(key, pattern, 1), F.lit(""))


def _dashed(text: Column, *separators: str) -> Column:
    for separator in separators:
        text = F.replace(text, F.lit(separator), F.lit("-"))
    return text


def partition_date(key: Column, run_date: Column) -> Column:
    """Date text of the first layout found anywhere in the key, else the run date.

    The text is not checked against the calendar; pass it through ``to_date`` for that.
    """
    return F.coalesce(
        _dashed(_found(key, HIVE_DATE), "/month=", "/day="),
        _found(key, DT_DATE),
        _dashed(_found(key, PLAIN_DATE), "/"),
        run_date,
    )


def event_key_decode(key: Column) -> Column:
    """URL-decoded key, '+' meaning a blank; a '%' that starts no escape stays as it is."""
    return F.coalesce(
        F.try_url_decode(F.regexp_replace(key, "%(?![0-9A-Fa-f]{2})", "%25")), F.replace(key, F.lit("+"), F.lit(" ")))


def starts_with_any(c: Column, prefixes: Iterable[str]) -> Column:
    return reduce(or_, [c.startswith(p.strip()) for p in prefixes], F.lit(False))


def ends_with_any(c: Column, suffixes: Iterable[str]) -> Column:
    return reduce(or_, [c.endswith(s) for s in suffixes], F.lit(False))


def replace_invalid_chars(c: Column) -> Column:
    """Bytes that are not UTF-8 become blanks; valid text, U+FFFD included, stays as it is."""
    return F.when(F.is_valid_utf8(c), c).otherwise(F.replace(F.make_valid_utf8(c), F.lit("\uFFFD"), F.lit(" ")))
