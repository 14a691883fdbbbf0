"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def split_tokens(text: Column, separator: str) -> Column:
    """Split on a one-character separator, without empty tokens at the end.

    Empty tokens in front and between stay. Text of separators only gives no token;
    the empty text gives one empty token.
    """
    if len(separator) != 1:
        raise ValueError("the separator must be one character")
    kept = F.rtrim(text, F.lit(separator))
    pattern = separator if separator.isalnum() or separator in " _" else "\\" + separator
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(kept == "", F.array().cast("array<string>"))
        .otherwise(F.split(kept, pattern))
    )


def parts_of(compound_id: Column) -> tuple[Column, Column]:
    """``room_<n>_<source>`` as (``room_<n>``, ``<source>``)."""
    tokens = split_tokens(compound_id, "_")
    return F.concat_ws("_", F.get(tokens, F.lit(0)), F.get(tokens, F.lit(1))), F.get(tokens, F.lit(2))
