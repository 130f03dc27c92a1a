"""Expressions over delimited lists kept in one string."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from filmdw.fixed_values import LIST_DELIMITER, MAJOR_STUDIOS, MEDIUM_NAME_LENGTH, UNKNOWN

# What counts as white space when a label is stripped for the regression.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


#: case and trailing blanks do not count, as in a database that compares text so
CASELESS = "UTF8_LCASE_RTRIM"


def collated(column: Column | str, collation: str | None) -> Column:
    """The text compared, grouped and joined under a collation; as it is without one."""
    column = F.col(column) if isinstance(column, str) else column
    return column if collation is None else F.collate(column, collation)


def tokens(value: Column, trim: bool = False) -> Column:
    """List elements of a delimited string; blank elements stay."""
    parts = F.split(value, LIST_DELIMITER)
    return F.transform(parts, lambda part: F.trim(part)) if trim else parts


def first_token(value: Column) -> Column:
    """Text before the first delimiter, untrimmed."""
    return F.substring_index(value, LIST_DELIMITER, 1)


def primary_token(value: Column) -> Column:
    """First element stripped; a missing or empty list gives ``Unknown``."""
    return F.when(F.coalesce(value, F.lit("")) == "", UNKNOWN).otherwise(
        F.btrim(first_token(value), F.lit(WHITE_SPACE))
    )


def is_known(name: Column) -> Column:
    return (name != "") & (name != UNKNOWN)


def known_head(value: Column) -> Column:
    """List of the first element that is neither blank nor ``Unknown``; empty without one."""
    return F.slice(F.filter(tokens(value, trim=True), is_known), 1, 1)


def first_known(value: Column) -> Column:
    """First element that is neither blank nor ``Unknown``, else NULL."""
    return F.try_element_at(known_head(value), F.lit(1))


def studio_size(name: Column) -> Column:
    """Large for a major studio, Medium for a long name, else Small."""
    major = F.lit(False)
    for part in MAJOR_STUDIOS:
        major = major | F.contains(name, F.lit(part))
    return (
        F.when(major, "Large")
        .when(F.length(name) > MEDIUM_NAME_LENGTH, "Medium")
        .otherwise("Small")
    )


def joined_names(items: Column, field: str, default: str) -> Column:
    """One delimited string from an array of structs, or ``default`` if empty."""
    text = F.array_join(F.transform(items, lambda item: item[field]), LIST_DELIMITER)
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def shown_title(title: Column, width: int = 40) -> Column:
    return F.coalesce(F.nullif(F.substring(title, 1, width), F.lit("")), F.lit(UNKNOWN))
