"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The white space characters that are cut from both ends.
WHITE_SPACE = (
    "\t\n\v\f\r "
    "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trim_space(text: Column) -> Column:
    """Cut white space, Unicode spaces included, from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))
