"""Column expressions that clean raw report text (rows P1-P9, X1-X6, X15, X16)."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

FULL_WIDTH_SPACE = "　"
BYTE_ORDER_MARK = "﻿"

# fixed values: markers that mean "no value" in exchange reports
EMPTY_MARKERS = [
    "", "--", "---", "----", "nan", "NaN", "None", "N/A", "n/a", "null", "NULL",
    "X", "x", "除權", "除息", "除權息",
]

# fixed values: punctuation that table rendering leaves at the edges of account titles
EDGE_NOISE = "[\\s,.;:，。；：、·‧•]+"

# named character references, from the standard library's table; a no-break space reads as a blank
NAMED_REFERENCES = {name: " " if name == "nbsp" else chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
REFERENCE = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: Column | str) -> Column:
    """Trim blanks including the full-width space, drop a byte order mark."""
    no_mark = F.regexp_replace(col(c), BYTE_ORDER_MARK, "")
    return F.regexp_replace(no_mark, "^[\\s　]+|[\\s　]+$", "")


def empty_to_null(c: Column | str) -> Column:
    """NULL for the no-value markers and for runs of dashes, else the trimmed text."""
    text = strip_text(c)
    blank = text.isin(EMPTY_MARKERS) | text.rlike("^-+$")
    return F.when(~blank, text)


NUMBER = "^[-+]?[0-9]*[.]?[0-9]+[.]?(?:[eE][-+]?[0-9]+)?$"


def to_number(c: Column | str) -> Column:
    """Tolerant number: drops thousands separators, NULL when it is not a finite number.

    One chain of replacements, so that each is evaluated once per value.
    """
    text = F.regexp_replace(col(c), f"[,\\s　{BYTE_ORDER_MARK}]|--", "")
    return F.regexp_extract(text, NUMBER, 0).try_cast("double")


def to_signed_number(c: Column | str) -> Column:
    """As to_number, and `(1,234)` reads as -1234."""
    text = F.regexp_replace(col(c), f"[,\\s　{BYTE_ORDER_MARK}]|--", "")
    negated = F.regexp_replace(text, "^\\((.*)\\)$", "-$1")
    return F.regexp_extract(negated, NUMBER, 0).try_cast("double")


def finite(c: Column | str) -> Column:
    """NULL instead of NaN and the infinities; applied at every source."""
    value = col(c)
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def clean_symbol(c: Column | str, width: int | None = None) -> Column:
    """Strip a spreadsheet `="..."` wrapper and blanks; optionally zero-pad."""
    text = strip_text(F.regexp_replace(col(c), '^="|[="]', ""))
    return zero_pad(text, width) if width else text


def zero_pad(c: Column | str, width: int) -> Column:
    """Left-pad with zeros, never shortening (Spark's lpad would truncate)."""
    text = col(c)
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def signed_change(sign: Column | str, magnitude: Column | str) -> Column:
    """Magnitude carrying the sign of a separate +/- column; the sign column may hold markup."""
    mark = F.regexp_replace(F.coalesce(col(sign), F.lit("")), "<[^>]*>", "")
    value = to_number(magnitude)
    return F.when(mark.contains("-"), -value).otherwise(value)


def clean_account_name(c: Column | str) -> Column:
    """Account title without full-width blanks and punctuation at either edge."""
    text = F.regexp_replace(col(c), FULL_WIDTH_SPACE, " ")
    text = F.regexp_replace(text, "\\s+", " ")
    return F.regexp_replace(text, f"^{EDGE_NOISE}|{EDGE_NOISE}$", "")


def strip_tags(c: Column | str) -> Column:
    """Markup removed, entities resolved, blanks folded to one."""
    text = resolve_references(F.regexp_replace(col(c), "<[^>]+>", ""))
    return F.trim(F.regexp_replace(text, "[\\s　]+", " "))


def resolve_references(c: Column | str) -> Column:
    """Named and numeric character references resolved once each; unknown ones stay as they are."""
    text = col(c)
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)))

    def character(ref: Column) -> Column:
        digits = F.when(F.lower(F.substring(ref, 1, 2)) == "#x", F.substring(ref, 3, 8)).otherwise(
            F.when(ref.startswith("#"), F.conv(F.substring(ref, 2, 8), 10, 16))
        )
        scalar = F.conv(digits, 16, 10).cast("bigint")
        valid = scalar.between(1, 0x10FFFF) & ~scalar.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")).otherwise(map_literal(NAMED_REFERENCES, ref))

    # The ampersand's own references come last, so that what they make is not read again.
    makes_amp = lambda ref: ref.isin("amp", "#38", "#x26", "#X26")
    ordered = F.concat(F.filter(found, lambda r: ~makes_amp(r)), F.filter(found, makes_amp))
    step = lambda acc, ref: F.replace(acc, F.concat(F.lit("&"), ref, F.lit(";")), F.coalesce(character(ref), F.concat(F.lit("&"), ref, F.lit(";"))))
    return F.when(text.contains("&"), F.aggregate(ordered, text, step)).otherwise(text)


def map_literal(mapping: dict[str, str], key: Column | str) -> Column:
    """Lookup in a small constant map, NULL when the key is absent."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), col(key))


def same_value(stored: Column | str, raw: Column | str, tolerance: float = 1e-4) -> Column:
    """Type-aware equality of a stored value and the raw text it came from.

    Two no-value markers are equal. A whole raw number compares with the whole
    part of the stored one, other numbers within a tolerance, text when one
    holds the other (a raw `="0050"` matches 0050).
    """
    left, right = (F.replace(empty_to_null(c), F.lit(","), F.lit("")) for c in (stored, raw))
    num_l, num_r = to_number(left), to_number(right)
    both_numbers = num_l.isNotNull() & num_r.isNotNull()
    whole = right.rlike("^-?[0-9]+$")
    return (
        F.when(left.isNull() | right.isNull(), left.isNull() & right.isNull())
        .when(both_numbers & whole, num_l.cast("bigint") == num_r.cast("bigint"))
        .when(both_numbers, F.abs(num_l - num_r) < tolerance)
        .otherwise(left.contains(right) | right.contains(left))
    )
