"""Text to typed value, NULL on failure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow.schemas import PRICE, RATE

DATE_PATTERN = "yyyy-MM-dd"
def _int_text(digits: int) -> str:
    """A whole number between what Spark trims (blanks and control characters), or one with a decimal tail between blanks.

    The group has sign and digits, leading zeros not counted in ``digits``; nothing longer matches.
    """
    return (r"^(?=[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*\z|\s*[+-]?[0-9]+(?:[.][0-9]*)?\s*$)"
            rf"[\x00-\x20\x7F]*([+-]?0*[0-9]{{1,{digits}}})(?![0-9])")


# Any nine digits are an INT, and any ten a BIGINT.
_PLAIN_INT = r"^[\x00-\x20\x7F]*[+-]?0*[0-9]{1,9}[\x00-\x20\x7F]*\z"
_INT, _LONG = _int_text(9), _int_text(10)
_PLAIN_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def to_int(c: Column) -> Column:
    """INT with a decimal tail cut off: ' 3 ' is 3, '2.5' is 2, '1e3' and overflow are NULL.

    The text is looked at before it is cast, since a cast that fails raises and catches an error for the row, which
    costs more than all the rest. Plain integers take the first branch.
    """
    whole = F.regexp_extract(c, _LONG, 1).try_cast("bigint")
    return F.coalesce(
        F.when(c.rlike(_PLAIN_INT), c.try_cast("int")),
        F.when(c.rlike(_INT), F.regexp_extract(c, _INT, 1).try_cast("int")),
        F.when(c.rlike(_LONG), F.when(whole.between(-2**31, 2**31 - 1), whole.cast("int"))))


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_price(c: Column) -> Column:
    """Money parsed exactly; wide enough that nothing is rounded before the arithmetic."""
    return c.try_cast(PRICE)


def to_rate(c: Column) -> Column:
    return c.try_cast(RATE)


def to_date(c: Column) -> Column:
    """DATE by the strict pattern: '2024-1-5' and '2024-02-30' are NULL.

    Ten characters of the pattern's shape need no formatter; it judges whatever else there is.
    """
    return F.when(c.rlike(_PLAIN_DATE), c.try_cast("date")).otherwise(F.try_to_date(c, DATE_PATTERN))
