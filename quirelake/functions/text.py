"""Text cleaning rules."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters stripped from both ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(code) for code in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Three-letter language codes with their two-letter form.
LANGUAGE_CODES = {
    "eng": "en", "fre": "fr", "spa": "es", "ger": "de",
    "ita": "it", "por": "pt", "ara": "ar", "jpn": "ja",
    "chi": "zh", "rus": "ru", "dut": "nl", "kor": "ko",
}

# Labels that mean "no category".
INVALID_CATEGORIES = ["Add a comment", "Add_a_comment", "default", "Default", ""]


def literal_map(entries: dict) -> Column:
    """A constant map. It is built from one literal: a column per entry takes the driver seconds for a large map."""
    kind = "int" if all(isinstance(v, int) for v in entries.values()) else "string"
    return F.from_json(F.lit(json.dumps(entries)), f"map<string,{kind}>")


def bind(c: Column, function: Callable[[Column], Column]) -> Column:
    """`function(c)` with `c` computed once, however often the function uses it.

    Spark repeats a costly expression in every branch of a conditional.
    """
    return F.get(F.transform(F.array(c), function), F.lit(0))


def trim_ws(c: Column) -> Column:
    """Strip all kinds of whitespace; `trim` alone would only strip spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trim_ws(c), F.lit(""))


def is_blank(c: Column) -> Column:
    """Null or whitespace only; never null itself, so it can split a table in two."""
    return F.coalesce(trim_ws(c) == "", F.lit(True))


def clean_author(c: Column) -> Column:
    name = trim_ws(c)
    return F.when(~F.lower(name).isin("unknown", ""), name)


def fill_language(c: Column, default: str = "en") -> Column:
    return F.coalesce(c, F.lit(default))


def drop_repeated_half(c: Column, min_half: int = 30, probe: int = 20) -> Column:
    """Keep the first half of a text that was pasted twice.

    The second half counts as a copy when its first `probe` characters equal
    the text's own. Empty text becomes null; whitespace-only text becomes ''.
    """

    def first_half(text: Column) -> Column:
        half = F.floor(F.length(text) / 2).cast("int")
        head = trim_ws(F.substr(text, F.lit(1), F.lit(probe)))
        tail = trim_ws(F.substr(text, half + 1, F.lit(probe)))
        repeated = (half > min_half) & (tail == head)
        return F.when(repeated, trim_ws(F.substr(text, F.lit(1), half))).otherwise(text)

    return bind(trim_ws(F.when(c != "", c)), first_half)


def has_repeated_half(c: Column, min_half: int = 30, probe: int = 20) -> Column:
    """Residue test after cleaning: compares the slices as they are, untrimmed."""
    half = F.floor(F.length(c) / 2).cast("int")
    same = F.substr(c, half + 1, F.lit(probe)) == F.substr(c, F.lit(1), F.lit(probe))
    return F.coalesce((half > min_half) & same, F.lit(False))


def join_lines(c: Column) -> Column:
    """Runs of line breaks become one space; '' becomes null."""
    return trim_ws(F.regexp_replace(F.when(c != "", c), "[\r\n]+", " "))


def normalize_language(c: Column) -> Column:
    code = F.lower(trim_ws(c))
    shortened = F.when(F.length(code) == 3, F.substring(code, 1, 2)).otherwise(code)
    return F.coalesce(F.try_element_at(literal_map(LANGUAGE_CODES), code), shortened)


def normalize_availability(c: Column) -> Column:
    """Free text to available / unavailable / unknown; 'in stock' is tested first."""
    text = F.lower(c)
    return (
        F.when(F.contains(text, F.lit("in stock")), "available")
        .when(F.contains(text, F.lit("out")), "unavailable")
        .otherwise("unknown")
    )


def fix_category(c: Column) -> Column:
    label = trim_ws(c)
    return F.when(label.isNull() | label.isin(INVALID_CATEGORIES), "Unknown").otherwise(label)


def path_key(c: Column, unsafe: str = " /") -> Column:
    """A folder-safe form of a label: every `unsafe` character becomes '_'."""
    return F.translate(c, unsafe, "_" * len(unsafe))


def capitalize(c: Column) -> Column:
    """First letter upper case, the rest lower case (not every word, as initcap does)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def safe_timestamp(c: Column) -> Column:
    """ISO text to timestamp; what cannot be parsed becomes null."""
    return F.try_to_timestamp(c)


def utc_wall_clock(c: Column) -> Column:
    """The UTC wall-clock time of a timestamp, whatever the session's time zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))
