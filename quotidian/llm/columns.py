"""Words of a text as column expressions, for plans without Python workers."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Of text whose A-Z are lower-case already: digits, letters, and whatever lies beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same signs by what they are; Java's patterns test this in half the time.
TERM_SIGNS = r"[0-9a-z\x80-\x{10FFFF}]+"


def ascii_lower(text: Column) -> Column:
    """Only A-Z lower-cased. Where no sign lies beyond ASCII that is lower()."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def terms(text: Column) -> Column:
    """All words in their order, repeats included; none of a null."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(TERM_SIGNS), F.lit(0)), F.array().cast("array<string>"))


#: The same in the other engine.
SQL_LOWER = f"translate(%s, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
SQL_TERMS = f"coalesce(regexp_extract_all({SQL_LOWER}, '{TERM}'), [])"
