"""Guarded text -> value parsing with JDK-parser acceptance rules, as column expressions.

Spark casts are looser than the JDK parsers the original lines were written for (Spark accepts a
date without time as an instant, trims around integers, reads ``inf``), so every cast is guarded
by a pattern first and then done with ``try_cast`` (ANSI mode never raises on bad input).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: the accepted shapes of the JDK parsers used by the original code.
# Instant.parse: ISO date, 'T', HH:mm:ss, optional 1-9 digit fraction, 'Z' or a +hh:mm[:ss] offset;
# letters are case-insensitive.
INSTANT_RE = r"(?i)^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?(Z|[+-][0-9]{2}:[0-9]{2}(:[0-9]{2})?)$"
# Integer.parseInt: optional sign, decimal digits.
INT_RE = r"^[+-]?[0-9]+$"
# Double.parseDouble (token already free of blanks): NaN, Infinity, decimal with optional exponent,
# hexadecimal with binary exponent; optional f/F/d/D suffix.
DOUBLE_RE = (r"^[+-]?(NaN|Infinity|(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)"
             r"|(0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[fFdD]?))$")
# String.isBlank: empty or only whitespace code points (ASCII blanks, separators 0x1C-0x1F,
# Unicode spaces except the no-break ones).
BLANK_RE = r"^[\s\x1C-\x1F[\p{Z}&&[^\u00A0\u2007\u202F]]]*$"
# String.trim removes every char <= U+0020 at both ends.
TRIM_RE = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_instant(text) -> Column:
    """ISO-8601 instant -> TIMESTAMP truncated to milliseconds, NULL when not accepted."""
    t = _c(text)
    ts = F.try_to_timestamp(F.upper(t))
    ms = F.unix_millis(ts)
    return F.when(t.rlike(INSTANT_RE), F.timestamp_millis(ms))


def parse_int(text) -> Column:
    t = _c(text)
    return F.when(t.rlike(INT_RE), t.try_cast("int"))


def parse_double(text) -> Column:
    t = _c(text)
    # Spark does not read the f/F/d/D suffix or hex floats in every form; strip the suffix,
    # and leave hex to try_cast (NULL when unsupported, counted as a parse failure).
    body = F.regexp_replace(t, r"(?<=[0-9.])[fFdD]$", "")
    return F.when(t.rlike(DOUBLE_RE), body.try_cast("double"))


def java_trim(text) -> Column:
    return F.regexp_replace(_c(text), TRIM_RE, "")


def is_blank(text) -> Column:
    t = _c(text)
    return t.isNull() | t.rlike(BLANK_RE)
