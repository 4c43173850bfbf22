"""Words and rows of documents as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Space and the five control characters that end a word.
BLANKS = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


def word_array(text: Column | str) -> Column:
    """The words of a text; a NULL text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(
        F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""
    )


def word_count(text: Column | str) -> Column:
    """How many words a text has; a NULL text has none."""
    return F.size(word_array(text)).cast("long")
