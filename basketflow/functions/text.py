"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip takes for white space.
WHITE_SPACE = (
    "\t\n\v\f\r"
    "\u001c\u001d\u001e\u001f"
    "\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def begins_and_ends_visibly(text: Column) -> Column:
    """Are the first and the last character visible ASCII characters?"""
    last = F.right(text, F.lit(1))
    return (text >= "!") & (text < "\u007f") & (last >= "!") & (last < "\u007f")


def strip(column: Column) -> Column:
    """Remove white space of any kind from both ends.

    Nearly all values are left alone after a look at both ends; only the others
    are trimmed, which is dear with a set of characters.
    """
    text = column.cast("string")
    trimmed = F.trim(text, F.lit(WHITE_SPACE))
    return F.when(begins_and_ends_visibly(text), text).otherwise(trimmed)


def clean(column: Column) -> Column:
    """Strip white space; what is then empty is absent (NULL)."""
    return F.nullif(strip(column), F.lit(""))


def quoted(name: str) -> str:
    """A column's name as Spark's expressions take any name."""
    return f"`{name.replace('`', '``')}`"
