"""Loose JSON values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_value(text: Column) -> Column:
    """Variant of a text that is one whole JSON value, else null.

    `try_parse_json` stops after the first value and ignores what follows.
    Only a single value parses both as the sole content of an array and as
    the value of an object member, so both are asked.
    """
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(in_array.isNotNull(), F.try_variant_get(in_object, "$.v", "variant"))


def query_value(text: Column) -> Column:
    """JSON value of a text, or the text itself where it is not JSON."""
    return F.coalesce(json_value(text), text.cast("variant"))
