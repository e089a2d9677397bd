"""Text helpers: word split, word-order reversal, contact-field rules.

Patterns use explicit ASCII classes (not ``\\w`` / ``\\b``), whose meaning is
the same in every regex engine the results are checked against.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the contact rules.
WHITESPACE = r"[ \t\n\r]+"
MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"
PHONE = r"[+]?[0-9][0-9 ()-]{8,}[0-9]"
MAIL_DOMAIN_RULE = r"@[A-Za-z0-9.-]*mail[A-Za-z0-9.-]*[.]com$"
MIN_NAME_LENGTH = 5
PHONE_DIGITS = 10
PHONE_PREFIX = "9"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text) -> Column:
    """Whitespace-separated tokens, empty tokens removed."""
    return F.filter(F.split(_col(text), WHITESPACE), lambda w: w != "")


def reverse_words(text) -> Column:
    """Tokens in reverse order joined by one space (runs of spaces collapse)."""
    return F.array_join(F.reverse(words(text)), " ")


def digits_only(c) -> Column:
    return F.regexp_replace(_col(c), "[^0-9]", "")


def name_ok(name) -> Column:
    return F.length(_col(name)) > MIN_NAME_LENGTH


def phone_ok(phone) -> Column:
    d = digits_only(phone)
    return (F.length(d) == PHONE_DIGITS) & d.startswith(PHONE_PREFIX)


def mail_ok(mail) -> Column:
    return _col(mail).rlike(MAIL_DOMAIN_RULE)
