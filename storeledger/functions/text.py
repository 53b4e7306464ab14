"""Text expressions: header names, match keys, ids, addresses, street numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points counted as blank when an id or name is trimmed.
BLANKS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
         *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def strip(text: Column) -> Column:
    """Text without blanks at its ends.

    Spaces are cut first, which is quick. The search for all other blanks looks at every
    character of the text, so it is left out where both ends are plain: ASCII above the space.
    """
    spaced = F.trim(text.cast("string"))
    last = F.substring(spaced.cast("binary"), -1, 1)
    plain = (spaced >= "!") & (spaced < "\x80") & last.between(F.lit(b"!"), F.lit(b"\x7f"))
    return F.when(plain, spaced).otherwise(F.btrim(spaced, F.lit(BLANKS)))


def normalize_header(text: Column) -> Column:
    words = F.regexp_replace(text, "[^a-zA-Z0-9]+", "_")
    return F.lower(F.btrim(words, F.lit("_")))


def header_name(name: str) -> str:
    """``normalize_header`` for a column name known while planning."""
    return "_".join(re.findall("[a-zA-Z0-9]+", name)).lower()


def norm_key(text: Column) -> Column:
    """Upper-case words separated by single spaces; never null."""
    words = F.regexp_replace(F.upper(F.coalesce(text, F.lit(""))), "[^A-Z0-9]+", " ")
    return F.btrim(words)


def norm_key_text(text: str) -> str:
    """``norm_key`` for a text known while planning."""
    return " ".join(re.findall("[A-Z0-9]+", text.upper()))


def concat_address(line1: Column, line2: Column) -> Column:
    def filled(line: Column) -> Column:
        part = strip(line)
        # lower case is slow to find, so it is asked for texts of that length alone
        named = (F.length(part) != 3) | (F.lower(part) != "nan")
        return F.when((part != "") & named, part)

    return F.concat_ws(", ", filled(line1), filled(line2))


def numeric_id(text: Column) -> Column:
    """Plain digits of a numeric id (``0123.0`` -> ``123``); null if not numeric."""
    number = strip(text)
    plain = number.rlike(r"^[0-9]+(\.[0-9]*)?$")
    digits = F.regexp_replace(number, r"\.0*$", "")
    return F.when(plain, F.regexp_replace(digits, r"^0+(?=[0-9])", ""))


def clean_id(text: Column) -> Column:
    """``numeric_id`` where it applies, else the trimmed text; blank is null."""
    number = strip(text)
    usable = (number != "") & (F.lower(number) != "nan")
    return F.coalesce(numeric_id(text), F.when(usable, number))


def words(key: Column) -> Column:
    return F.split(key, " ")


def is_street_number(word: Column) -> Column:
    number = word.try_cast("int")
    return word.rlike("^[0-9]{3,5}$") & (number < 10000) & ~number.between(1900, 2030)


def street_numbers(key: Column) -> Column:
    """Street numbers of a match key in order of appearance."""
    return F.filter(words(key), is_street_number)
