"""Cleaning of text cells, as Column expressions that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space.
WHITE = (
    " \t\n\r\v\f\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Patterns of accepted numbers and dates.
NUMBER = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"
ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
ISO_BASIC_DAY = r"^\d{8}$"
ISO_BASIC_TIME = r"^\d{8}.\d{2}(\d{2}(\d{2})?)?$"
ISO_TIME = (
    r"^\d{4}-\d{2}-\d{2}.\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?"
    r"(Z|[+-]\d{2}(:?\d{2}(:?\d{2}(\.\d+)?)?)?)?$"
)
# Fixed value: the usual layout, in full; tried before the others.
PLAIN_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
# Accepted date layouts besides ISO, with the pattern that guards each.
DATE_LAYOUTS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}$", "y-M-d H:m:s[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]"),
    (r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$", "y-M-d H:m:s"),
    (r"(?i)^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}\s*[ap]m$", "y-M-d h:m a"),
    (r"^\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{1,2}:\d{1,2}$", "M/d/y H:m:s"),
    (r"(?i)^\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{1,2}\s*[ap]m$", "M/d/y h:m a"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "y-M-d"),
)
# Status words of the order-level export.
STATUS_WORDS = {"COMPLETED": "Perfect", "INCOMPLETE": "Short"}


def _no_time() -> Column:
    return F.lit(None).cast("timestamp")


def strip(c: Column) -> Column:
    """Text without leading and trailing white space, tabs and newlines included."""
    return F.btrim(c, F.lit(WHITE))


def clean_text(c: Column) -> Column:
    """Stripped text, or NULL when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def normalize_header(c: Column) -> Column:
    """Header text for comparison: stripped, lower case, blanks and slashes as underscores."""
    return F.coalesce(F.translate(F.lower(strip(c)), " /", "__"), F.lit(""))


def iso_timestamp(c: Column) -> Column:
    """Timestamp of an ISO-8601 text, else NULL.

    The patterns keep out what Spark's lenient cast would accept, such as a bare
    year or a bare time of day.
    """
    # Any single character may stand between day and time; Spark wants a blank.
    spaced = F.regexp_replace(c, r"^(\d{4}-\d{2}-\d{2}).", "$1 ")
    hour_only = F.regexp_replace(spaced, r"^(\S+ \d{2})($|Z|[+-])", "$1:00$2")
    plain = F.regexp_replace(hour_only, r",(\d)", ".$1")
    basic = F.rpad(F.concat(F.left(c, F.lit(8)), F.substr(c, F.lit(10))), 14, "0")
    return (
        F.when(c.rlike(ISO_DAY), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))
        .when(c.rlike(ISO_BASIC_DAY), F.try_to_timestamp(c, F.lit("yyyyMMdd")))
        .when(c.rlike(ISO_TIME), F.try_to_timestamp(plain))
        .when(c.rlike(ISO_BASIC_TIME), F.try_to_timestamp(basic, F.lit("yyyyMMddHHmmss")))
        .otherwise(_no_time())
    )


def parse_datetime(c: Column) -> Column:
    """Timestamp of a text in ISO or one of six other layouts, else NULL."""
    # A plain time reads as ISO does it; it needs no stripping and none of the other patterns.
    plain = F.when(c.rlike(PLAIN_TIME), F.try_to_timestamp(c))
    text = strip(c)
    one_blank = F.upper(F.regexp_replace(text, r"\s+", " "))
    spaced = F.regexp_replace(one_blank, r"(\d)([AP]M)$", "$1 $2")
    # The guards shut each other out, so no text is tried by two layouts.
    other = _no_time()
    for guard, layout in reversed(DATE_LAYOUTS):
        other = F.when(text.rlike(guard), F.try_to_timestamp(spaced, F.lit(layout))).otherwise(other)
    return F.coalesce(plain, iso_timestamp(text), other)


def _number(c: Column) -> Column:
    """Double of a plain number text, else NULL; type suffixes as in ``12D`` are no numbers."""
    text = strip(c)
    return F.when(
        text.rlike(NUMBER), F.regexp_replace(text, "_", "").try_cast("double")
    )


def int_text(c: Column, exact: bool = False) -> Column:
    """Whole part of a number text, as text; other text unchanged; blank as NULL.

    A number passes through a double, so leading zeros go and digits beyond 2^53
    change. ``exact=True`` keeps all digits of identifiers that are digits only and
    so lets long package codes match. Values beyond 2^63 keep their text.
    """
    text = clean_text(c)
    whole = _number(text).try_cast("bigint").cast("string")
    if exact:
        whole = F.when(text.rlike(r"^\d+$"), text).otherwise(whole)
    return F.coalesce(whole, text)


def whole_number(c: Column) -> Column:
    """Integer part of a number text, else NULL."""
    return _number(c).try_cast("int")


def amount(c: Column) -> Column:
    """Number text as double, NULL when it is no number."""
    return _number(c)


def claim_type(c: Column) -> Column:
    """Reason text folded to SHORTAGE or DAMAGE where it names one; missing means SHORTAGE."""
    upper = F.upper(c)
    return (
        F.when(c.isNull() | (c == ""), F.lit("SHORTAGE"))
        .when(upper.contains("SHORT"), F.lit("SHORTAGE"))
        .when(upper.contains("DAMAGE"), F.lit("DAMAGE"))
        .otherwise(c)
    )


def order_status(c: Column) -> Column:
    """Upper-cased status with the known words translated."""
    upper = F.upper(c)
    mapped = upper
    for word, status in STATUS_WORDS.items():
        mapped = F.when(upper == word, F.lit(status)).otherwise(mapped)
    return mapped


def digits(c: Column) -> Column:
    """The decimal digits of a text."""
    return F.regexp_replace(c, "[^0-9]", "")


def content_hash(c: Column) -> Column:
    """SHA-256 of file content, as hexadecimal text."""
    return F.sha2(c, 256)
