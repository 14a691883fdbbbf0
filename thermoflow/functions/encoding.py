"""Text form of points for time-series stores (line protocol)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from thermoflow.functions.time import as_micros


def _one_line(text: Column) -> Column:
    return F.translate(text, "\r\n", "  ")


def _escape(text: Column, special: str) -> Column:
    text = _one_line(text)
    for character in special:
        text = F.replace(text, F.lit(character), F.lit("\\" + character))
    return text


def line_protocol(
    measurement: Column,
    tags: Mapping[str, Column],
    fields: Mapping[str, tuple[Column, str]],
    time: Column,
) -> Column:
    """``measurement,tag=... field=... nanoseconds``.

    Tags and fields are written in name order; NULL tags are left out, as the format
    has no empty tag. A field comes with its kind: ``"double"``, ``"int"`` (written
    with the suffix ``i``) or ``"string"`` (quoted). NULL fields, and doubles that are not
    finite, are left out; rows without any field give NULL. So are empty tags. Line breaks,
    which would split a record, become blanks in names, tags and texts.
    """
    tag_texts = [
        F.when(value != "", F.concat(F.lit(f"{name}="), _escape(value, ",= ")))
        for name, value in sorted(tags.items())
    ]
    field_texts = [
        F.concat(F.lit(f"{name}="), _field(value, kind)) for name, (value, kind) in sorted(fields.items())
    ]
    head = F.concat_ws(",", _escape(measurement, ", "), *tag_texts)
    body = F.concat_ws(",", *field_texts)
    nanoseconds = (as_micros(time) * 1000).cast("string")
    return F.when(body != "", F.concat_ws(" ", head, body, nanoseconds))


def _field(value: Column, kind: str) -> Column:
    if kind == "double":
        number = value.cast("double")
        return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number.cast("string"))
    if kind == "int":
        return F.concat(value.cast("bigint").cast("string"), F.lit("i"))
    if kind == "string":
        quoted = F.replace(F.replace(_one_line(value), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        return F.concat(F.lit('"'), quoted, F.lit('"'))
    raise ValueError(f"unknown field kind {kind!r}")
