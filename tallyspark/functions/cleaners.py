"""Text-to-type cleaners for the raw transaction columns.

Every cleaner is a pair: a lenient one that turns unusable text into NULL, and
a strict one that stops the query when text that claims a format cannot be
converted. Both agree on all input the strict one accepts. Conversions use
``try_cast`` so that the outcome does not depend on the session's ANSI flag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.schemas import AMOUNT, AMOUNT_INTEGER_DIGITS, AMOUNT_SCALE

LENIENT = "lenient"
STRICT = "strict"

# Fixed patterns. ``\z`` and not ``$``: the latter also accepts a final newline.
UNSIGNED_NUMBER = r"^\d+(\.\d+)?\z"
EITHER_DATE = r"^(\d{2}-\d{2}-\d{4}|\d{4}-\d{2}-\d{2})\z"
# A number that AMOUNT holds exactly; zeros before and behind do not count.
FITTING_NUMBER = rf"^0*\d{{1,{AMOUNT_INTEGER_DIGITS}}}(\.\d{{1,{AMOUNT_SCALE}}}0*)?\z"


def _converted(value: Column, must_convert: Column, text: Column, what: str, mode: str) -> Column:
    if mode == LENIENT:
        return value
    if mode != STRICT:
        raise ValueError(f"unknown mode {mode!r}")
    complaint = F.concat(F.lit(f"{what}: cannot convert '"), text, F.lit("'"))
    return F.when(must_convert & value.isNull(), F.raise_error(complaint)).otherwise(value)


def strip_prefix(text: Column, prefix: str) -> Column:
    """Drop one leading upper-case ``prefix``."""
    return F.substr(text, has_prefix(text, prefix).cast("int") * len(prefix) + 1)


def has_prefix(text: Column, prefix: str) -> Column:
    """Whether text starts with ``prefix``, which is upper case."""
    return text.startswith(prefix)


def before_dot(text: Column) -> Column:
    return F.substring_index(text, ".", 1)


def id_digits(text: Column, prefix: str) -> Column:
    """What is left of an id without its prefix; NULL if nothing is."""
    return F.nullif(strip_prefix(text, prefix), F.lit(""))


def clean_prefixed_id(text: Column, prefix: str, what: str, mode: str = LENIENT) -> Column:
    """An id that may carry a prefix letter; NULL if nothing is left of it."""
    digits = id_digits(text, prefix)
    return _converted(digits.try_cast("int"), digits.isNotNull(), text, what, mode)


def clean_customer_id(text: Column, mode: str = LENIENT) -> Column:
    """Ids stored as decimals: the part before the first dot, never rounded."""
    whole = before_dot(text).try_cast("int")
    return _converted(whole, text.isNotNull(), text, "customer_id", mode)


def is_day_first(text: Column) -> Column:
    """Tells the two date shapes apart; for text of one of them."""
    return F.substring(text, 3, 1) == "-"


def iso_date_text(text: Column) -> Column:
    """Day-first or ISO date as ISO text; NULL for any other shape."""
    reordered = F.concat_ws(
        "-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2)
    )
    # One pattern match; the third character then tells the two shapes apart.
    return F.when(text.rlike(EITHER_DATE), F.when(is_day_first(text), reordered).otherwise(text))


def clean_date(text: Column, mode: str = LENIENT) -> Column:
    """Day-first or ISO date; any other shape is NULL in both modes."""
    iso_text = iso_date_text(text)
    return _converted(
        iso_text.try_cast("date"), iso_text.isNotNull(), text, "transaction_date", mode
    )


def clean_quantity(text: Column, mode: str = LENIENT) -> Column:
    """Unsigned number rounded half up to an int.

    Works on the digits themselves, so text with any number of decimals is
    rounded once and exactly.
    """
    is_number = text.rlike(UNSIGNED_NUMBER)
    whole = before_dot(text).try_cast("bigint")
    dot = F.instr(text, ".")
    rounds_up = (dot > 0) & (F.substring(text, dot + 1, F.lit(1)) >= "5")
    carry = F.when(rounds_up, 1).otherwise(0)
    rounded = F.when(whole < 2**31, whole + carry).try_cast("int")
    return _converted(F.when(is_number, rounded), is_number, text, "quantity", mode)


def clean_amount(text: Column, what: str, mode: str = LENIENT) -> Column:
    """An amount with all its digits; NULL for text that is no number.

    A number that the type cannot hold stops the query in both modes: as NULL it would
    vanish from the fact, and rounded it would be another number.
    """
    if mode not in (LENIENT, STRICT):
        raise ValueError(f"unknown mode {mode!r}")
    complaint = F.concat(F.lit(f"{what}: too many digits in '"), text, F.lit("'"))
    return F.when(text.rlike(FITTING_NUMBER), text.try_cast(AMOUNT)).when(
        text.rlike(UNSIGNED_NUMBER), F.raise_error(complaint)
    )


def loses_digits(text: Column) -> Column:
    """True where a number has more digits than ``AMOUNT`` can hold."""
    return F.coalesce(text.rlike(UNSIGNED_NUMBER) & ~text.rlike(FITTING_NUMBER), F.lit(False))
