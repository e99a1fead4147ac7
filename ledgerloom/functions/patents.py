"""Reading of patent numbers as people write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Country, series letters, zeros, digits, kind code, after blanks and signs are gone.
NUMBER = r"^(?:US)?([A-Z]*)0*([0-9]+)(?:[A-Z][0-9]?)?$"
SIGNS = r"[\p{P}\p{S}\p{Z}\p{C}\s]+"


def patent_key(c: Column) -> Column:
    """`series:digits` of a patent number, the same for all its spellings; null where it can't be read as a number.

    Letter case, blanks, punctuation, a leading US, zeros before the digits and a kind code at the end don't count.
    """
    key = F.regexp_replace(F.regexp_replace(F.upper(c), SIGNS, ""), NUMBER, "$1:$2")
    return F.when(key.contains(":"), key)


def key_code(key: Column) -> Column:
    """A dictionary code for the result of patent_key: series letters as a number of base 27, then twelve digits.

    One to one and in order, without a table to look up. Null for keys of more than four letters or twelve digits.
    """
    series, digits = F.substring_index(key, ":", 1), F.substring_index(key, ":", -1)
    number = F.lit(0).cast("long")
    for i in range(1, 5):
        letter = F.substring(series, i, 1)
        number = number * 27 + F.when(letter == "", 0).otherwise(F.ascii(letter) - 64).cast("long")
    fits = (F.length(series) <= 4) & (F.length(digits) <= 12)
    return F.when(fits, number * F.lit(10**12).cast("long") + digits.try_cast("long"))
