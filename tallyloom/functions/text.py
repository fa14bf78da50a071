"""Text normalisation as one native expression.

The classes below are spelled out instead of using ``\\w``, ``\\s`` and ``\\b``: Java
reads those as ASCII, and its Unicode mode counts combining marks as letters but not
numerals such as U+00B2. A word character is a letter, a number or ``_``; whitespace
includes the four ASCII separators U+001C to U+001F.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = (
    r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)

# What is removed or spelled out, in this order. Patterns begin with the
# single characters a match can start with, so that the scan skips quickly over the rest
# (an address starts with "http" or "www"). No pattern scans a
# stretch of text more than twice: an unclosed tag is matched as a whole and put back
# (group 1), instead of being tried again from each "<" in it.
URL = rf"[hw](?:ttp(?<=http)|ww(?<=www))[^{SPACE}]+"
TAG = r"<[^>\n]*+>|(<[^>\n]*+)"
CURRENCIES = (("$", " dollar "), ("€", " euro "), ("£", " pound "))
PERCENT = rf"(?=\p{{Nd}})(?<![{WORD}])(\p{{Nd}}++)%"
AMOUNT = rf"(?=\p{{Nd}})(?<![{WORD}])(\p{{Nd}}++)([kmb])(?![{WORD}])"
UNITS = (("k", " thousand"), ("m", " million"), ("b", " billion"))
NOT_KEPT = rf"[^{WORD}.,!?$%\-]+"


def clean_text(text: Column) -> Column:
    """Lower-case, drop URLs and tags, spell out currencies and number suffixes, keep
    words and basic punctuation, collapse whitespace. NULL becomes the empty string."""
    out = F.lower(F.coalesce(text, F.lit("")))
    out = F.regexp_replace(out, URL, "")
    out = F.regexp_replace(out, TAG, "$1")
    for symbol, name in CURRENCIES:
        out = F.replace(out, F.lit(symbol), F.lit(name))
    out = F.regexp_replace(out, PERCENT, "$1 percent")
    # One pass finds the amounts and marks their unit with "$", which no text holds any
    # more at this point.
    out = F.regexp_replace(out, AMOUNT, r"$1\$$2")
    for letter, name in UNITS:
        out = F.replace(out, F.lit("$" + letter), F.lit(name))
    # Dropped characters turn into spaces and runs of spaces into one, so a run of
    # either kind is replaced in a single pass over the text.
    return F.trim(F.regexp_replace(out, NOT_KEPT, " "))


def strip_whitespace(text: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.regexp_replace(text, rf"^[{SPACE}]+|(?<![{SPACE}])[{SPACE}]+$", "")


def preview(text: Column, length: int = 50) -> Column:
    """The leading characters shown in a log line."""
    return F.substring(text, 1, length)
