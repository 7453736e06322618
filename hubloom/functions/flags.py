"""Optional request flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The only spellings of a flag that are read as a boolean.
TRUE_TEXTS = ("1", "t", "T", "TRUE", "true", "True")
FALSE_TEXTS = ("0", "f", "F", "FALSE", "false", "False")


def strict_bool(text: Column) -> Column:
    """Boolean of a flag text; null when the flag is absent or unreadable.

    A cast would also take `yes`, `tRUE` and padded text, so it is not used.
    """
    return F.when(text.isin(*TRUE_TEXTS), F.lit(True)).when(
        text.isin(*FALSE_TEXTS), F.lit(False))


def flag_status(text: Column) -> Column:
    """200 for an absent or readable flag, 400 for any other text."""
    absent = F.coalesce(text, F.lit("")) == ""
    return F.when(absent | strict_bool(text).isNotNull(), F.lit(200)).otherwise(F.lit(400))
