"""How a profile is shown: status severity, channel labels, money, numbers and dates."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schemas import CHANNELS

NOTHING = "—"

# The words that decide a status's severity, worst first.
BAD_PARTS = ("late", "declined", "failed")
BAD_WORDS = ("behind", "frozen", "closed")
WARN_PARTS = ("review",)
WARN_WORDS = ("pays_minimum", "revolves")


def _col(column) -> Column:
    return column if isinstance(column, Column) else F.col(column)


def _mentions(text: Column, parts, words) -> Column:
    found = text.isin(*words)
    for part in parts:
        found = found | text.contains(part)
    return found


def severity(status) -> Column:
    """bad, warn or ok; null for a null status."""
    text = F.lower(_col(status))
    return (
        F.when(text.isNull(), None)
        .when(_mentions(text, BAD_PARTS, BAD_WORDS), "bad")
        .when(_mentions(text, WARN_PARTS, WARN_WORDS), "warn")
        .otherwise("ok")
    )


def channel_label(key) -> Column:
    """Readable channel name; an unknown key stays as it is."""
    pairs = chain.from_iterable((c.key, c.label) for c in CHANNELS)
    labels = F.create_map(*(F.lit(x) for x in pairs))
    return F.coalesce(F.try_element_at(labels, _col(key)), _col(key))


def channel_labels(keys) -> Column:
    return F.transform(_col(keys), channel_label)


def grouped_int(number) -> Column:
    """1234567 -> 1,234,567."""
    return F.coalesce(F.format_number(_col(number), 0), F.lit(NOTHING))


def whole_dollars(amount) -> Column:
    """1234.5 -> $1,235, halves away from zero, sign before the dollar."""
    amount = _col(amount)
    # format_number would round half to even, so the rounding comes first.
    digits = F.format_number(F.round(F.abs(amount), 0), 0)
    sign = F.when(amount < 0, "-").otherwise("")
    return F.coalesce(F.concat(sign, F.lit("$"), digits), F.lit(NOTHING))


def day_text(when) -> Column:
    """The first ten characters of an ISO date or time text."""
    text = _col(when).cast("string")
    return F.when(F.length(text) > 0, F.substring(text, 1, 10)).otherwise(NOTHING)


def plain_number(number) -> Column:
    """A decimal as a float prints: 12.50 -> 12.5 and 5.00 -> 5."""
    return F.regexp_replace(_col(number).cast("string"), r"(\.\d*[1-9])0+$|\.0+$", "$1")


def percent_text(number) -> Column:
    return F.concat(plain_number(number), F.lit("%"))


def months_text(months) -> Column:
    return F.concat(_col(months).cast("string"), F.lit("mo"))


def events_text(count) -> Column:
    return F.concat(_col(count).cast("string"), F.lit(" events"))


def full_name(first="first_name", last="last_name") -> Column:
    """Null when either part is null."""
    return F.concat(_col(first), F.lit(" "), _col(last))
