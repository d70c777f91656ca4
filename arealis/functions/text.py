"""Names and text values."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no value" in the raw sheets. Case matters: "none" is kept.
NULL_TOKENS = ("", "nan", "NaN", "NAN", "null", "NULL", "None")


def column(name: str) -> Column:
    """Reference a column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_name(name: str) -> str:
    """ASCII snake_case form of a header: runs of letters and digits joined by ``_``."""
    decomposed = unicodedata.normalize("NFKD", name.lower())
    plain = "".join(ch for ch in decomposed if not unicodedata.combining(ch))
    return "_".join(re.findall("[a-z0-9]+", plain))


def tidy(value: Column, whitespace: str = "spaces") -> Column:
    """Trim a text: spaces only, or every kind of white space with ``whitespace="all"``."""
    if whitespace == "spaces":
        return F.trim(value)
    if whitespace == "all":
        return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")
    raise ValueError(f"whitespace must be 'spaces' or 'all', not {whitespace!r}")


def null_tokens_to_null(value: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """NULL where the trimmed text is a null token; otherwise the value itself, type and all."""
    return F.when(~F.trim(value.cast("string")).isin(*tokens), value)
