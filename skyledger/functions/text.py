"""String rules shared by every field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters ECMAScript counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \u00a0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

#: The same set as a regular-expression class body.
WHITE_SPACE_CLASS = r"\t-\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


#: How the reason starts for a part of a record that is too long for one value; the first part stands for the record.
CONTINUED = "continued from an earlier part: "


def is_continued(parse_error: Column) -> Column:
    """Whether a row is a further part of a record; such rows keep text and are not counted."""
    return F.coalesce(parse_error.startswith(CONTINUED), F.lit(False))


def trimmed(text: Column) -> Column:
    """Strip white space as ECMAScript does; Spark's ``trim`` strips only U+0020."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    return trimmed(text) == ""


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units, the unit length limits are stated in."""
    return F.when(
        F.octet_length(text) == F.char_length(text), F.char_length(text)
    ).otherwise((F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int"))
