"""Masks for personal data, as column expressions. NULL stays NULL except for fixed texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts a masked cell shows.
HIDDEN = "***"
HIDDEN_DOMAIN = "@***.***"
REDACTED = "*** REDACTED ***"
UNKNOWN_PHONE = "UNKNOWN"
PHONE_DIGITS_SHOWN = 4


def mask_name(c: Column) -> Column:
    return F.concat(F.left(c, F.lit(1)), F.lit(HIDDEN))


def mask_full_name(c: Column) -> Column:
    return F.concat(F.substring_index(c, " ", 1), F.lit(" " + HIDDEN))


def mask_email(c: Column) -> Column:
    return F.concat(F.substring_index(c, "@", 1), F.lit(HIDDEN_DOMAIN))


def mask_phone(c: Column) -> Column:
    digits = F.regexp_replace(c, "[^0-9]", "")
    stars = F.repeat(F.lit("*"), F.greatest(F.length(digits) - PHONE_DIGITS_SHOWN, F.lit(0)))
    return F.when(c == UNKNOWN_PHONE, c).otherwise(F.concat(stars, F.right(digits, F.lit(PHONE_DIGITS_SHOWN))))


def mask_address(c: Column) -> Column:
    return F.lit(REDACTED)


MASKS: dict[str, Callable[[Column], Column]] = {
    "name": mask_name,
    "full_name": mask_full_name,
    "email": mask_email,
    "phone": mask_phone,
    "address": mask_address,
}
