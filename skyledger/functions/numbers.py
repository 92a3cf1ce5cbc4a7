"""Numbers as text: reading and writing them the way ECMAScript does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL_TEXT = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"


def number_from_text(text: Column) -> Column:
    """DOUBLE for text that is a number, NULL for anything else.

    A bare cast would also take ``1d``, ``5f`` or ``NaN``, so the shape is
    checked first. The text must be trimmed; blank text is NULL here.
    """
    t = text
    prefix = F.lower(F.substring(t, 1, 2))
    body = F.substring(t, F.lit(3), F.length(t))

    def radix(mark: str, digits: str, base: int) -> tuple[Column, Column]:
        """Folded digit by digit, so that no length overflows; beyond a DOUBLE it is infinite."""
        places = F.transform(F.split(F.lower(body), ""), lambda c: F.instr(F.lit("0123456789abcdef"), c) - 1)
        value = F.aggregate(places, F.lit(0.0), lambda whole, digit: whole * base + digit)
        return (prefix == mark) & body.rlike(f"^{digits}+$"), value

    (is_hex, hex_value), (is_oct, oct_value), (is_bin, bin_value) = (
        radix("0x", "[0-9a-fA-F]", 16),
        radix("0o", "[0-7]", 8),
        radix("0b", "[01]", 2),
    )
    return (
        F.when(t.rlike(DECIMAL_TEXT), t.try_cast("double"))
        .when(is_hex, hex_value)
        .when(is_oct, oct_value)
        .when(is_bin, bin_value)
        .when(t.rlike(r"^\+?Infinity$"), F.lit(float("inf")))
        .when(t == "-Infinity", F.lit(float("-inf")))
    )


def number_to_text(value: Column) -> Column:
    """Shortest text that reads back as the same DOUBLE, in ECMAScript layout.

    Fixed layout: plain digits while the decimal point stays within 21 places
    on the left and 6 leading zeros on the right, exponent form beyond.
    """
    d = value.cast("double")
    # The shortest of 15, 16 or 17 digits that reads back unchanged.
    scientific = F.coalesce(
        *[
            F.when(F.format_string(f"%.{places}e", d).try_cast("double") == d, F.format_string(f"%.{places}e", d))
            for places in (14, 15)
        ],
        F.format_string("%.16e", d),
    )
    sign = F.when(d < 0, "-").otherwise("")
    digits = F.regexp_replace(
        F.concat(
            F.regexp_extract(scientific, r"^-?(\d)\.(\d+)e", 1),
            F.regexp_extract(scientific, r"^-?(\d)\.(\d+)e", 2),
        ),
        "0+$",
        "",
    )
    exponent = F.regexp_extract(scientific, r"e([+-]\d+)$", 1).try_cast("int")
    point = exponent + 1
    count = F.char_length(digits)
    plain = (
        F.when(
            (count <= point) & (point <= 21),
            F.concat(digits, F.repeat(F.lit("0"), point - count)),
        )
        .when(
            (point > 0) & (point <= 21),
            F.concat(F.left(digits, point), F.lit("."), F.substring(digits, point + 1, count)),
        )
        .when((point > -6) & (point <= 0), F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .otherwise(
            F.concat(
                F.left(digits, F.lit(1)),
                F.when(count > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), count))).otherwise(""),
                F.lit("e"),
                F.when(exponent < 0, "-").otherwise("+"),
                F.abs(exponent).cast("string"),
            )
        )
    )
    return (
        F.when(d == 0, "0")
        .when(F.abs(d) == float("inf"), "null")
        .otherwise(F.concat(sign, plain))
    )
