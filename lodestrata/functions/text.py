"""Text and key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_WIDTH = 7  # fixed value: digits of a municipality key


def normalise_code(code: Column) -> Column:
    return F.upper(F.trim(code))


def title_name(name: Column) -> Column:
    return F.initcap(F.trim(name))


def text_key(key: Column) -> Column:
    return F.trim(key.cast("string"))


def pad_key(key: Column, width: int = KEY_WIDTH) -> Column:
    """Zero-padded key. A key that is already longer is kept whole, so that a rule can reject it."""
    text = key.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def short_code(text: Column) -> Column:
    """The first two letters in upper case; null for an empty text."""
    return F.nullif(F.upper(F.substring(text, 1, 2)), F.lit(""))
