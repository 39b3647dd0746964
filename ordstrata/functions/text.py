"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The characters other than whitespace after which a new word starts.
WORD_BREAKS = '[](){}/|\\<>!?@"^#$&~_,.:;*%+-'

# U+FFFF is no character, so text cannot hold it.
_MARK = "\uffff "

# Text without word breaks other than the space, as most names are.
_PLAIN_WORDS = r"^[A-Za-z0-9 '\u00c0-\u00ff]*+$"


def trim_ws(text: Column) -> Column:
    """Strip every kind of Unicode whitespace, where plain ``trim`` strips the space alone.

    The general strip costs several times the plain one, so it is left to texts that still end in
    whitespace after it.
    """
    plain = F.trim(text)
    spaces = F.lit(WHITESPACE)
    first, last = F.substring(plain, 1, 1), F.substring(plain, -1, 1)
    unstripped = F.contains(spaces, first) | F.contains(spaces, last)
    return F.when(unstripped, F.btrim(text, spaces)).otherwise(plain)


def clean_upper(text: Column) -> Column:
    return F.upper(trim_ws(text))


def clean_lower(text: Column) -> Column:
    return F.lower(trim_ws(text))


def is_blank(text: Column) -> Column:
    """True for empty or whitespace text, NULL for NULL."""
    return trim_ws(text) == ""


def initcap_words(text: Column) -> Column:
    """Upper-case the first letter of each word and lower-case the rest.

    ``initcap`` alone starts words at spaces only. A marked space is put behind every other word
    break for it and taken out again afterwards, where the text holds any.
    """
    breaks = "".join(f"\\u{ord(c):04x}" for c in WORD_BREAKS + WHITESPACE if c != " ")
    spaced = F.regexp_replace(text, f"([{breaks}])", f"$1{_MARK}")
    broken = F.replace(F.initcap(spaced), F.lit(_MARK), F.lit(""))
    return F.when(text.rlike(_PLAIN_WORDS), F.initcap(text)).otherwise(broken)


def all_digits(text: Column) -> Column:
    return text.rlike(r"^\d+$")


def padded(number: Column, width: int) -> Column:
    """Whole number with leading zeros; longer numbers keep all their digits."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))


def year_month(year: Column, month: Column) -> Column:
    """``2020-03``"""
    return F.concat(padded(year, 4), F.lit("-"), padded(month, 2))


def year_half(year: Column, half: Column) -> Column:
    """``2020 - S1``"""
    return F.concat(year.cast("string"), F.lit(" - S"), half.cast("string"))
