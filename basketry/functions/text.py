"""Tokenising text the way ``java.util.StringTokenizer`` does by default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default delimiter set of StringTokenizer
# (space, tab, newline, carriage return, form feed).
TOKEN_DELIMITERS = " \t\n\r\f"


def spaced(text: str | Column) -> Column:
    """Text with every delimiter turned into a space (``translate``: no regex)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.translate(col, TOKEN_DELIMITERS[1:], " " * (len(TOKEN_DELIMITERS) - 1))


def split_on_delimiters(text: str | Column) -> Column:
    """Pieces between delimiters, empty pieces included.

    Splitting on a single space takes Java's no-regex fast path, so no
    pattern is compiled per row (a regex ``split`` compiles one per call).
    """
    return F.split(spaced(text), " ")



# Fixed values of the pair file: characters that end a field or a line, and their escapes.
PAIR_ESCAPES = (("|", "\\p"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))
# An item without characters.
EMPTY_ITEM = "\\e"


def escaped_item(item: str | Column) -> Column:
    """An item as a field of the pair file: backslash, pipe, tab and line ends as
    two characters, any other name as it is."""
    out = F.replace(F.col(item) if isinstance(item, str) else item, F.lit("\\"), F.lit("\\\\"))
    for plain, escape in PAIR_ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(escape))
    return F.when(out == "", F.lit(EMPTY_ITEM)).otherwise(out)


def unescaped_item(field: Column) -> Column:
    """The item of a field. Escaped backslashes are cut out first, so that what follows
    one isn't taken for an escape; a backslash before any other character stays."""
    def plain(part: Column) -> Column:
        for char, escape in PAIR_ESCAPES:
            part = F.replace(part, F.lit(escape), F.lit(char))
        return part

    parts = F.array_join(F.transform(F.split(field, r"\\\\"), plain), "\\")
    return F.when(field == EMPTY_ITEM, F.lit("")).when(F.instr(field, "\\") > 0, parts).otherwise(field)
