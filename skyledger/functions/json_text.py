"""JSON rules: what counts as one JSON value, and its canonical text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numbers import number_to_text
from skyledger.functions.text import WHITE_SPACE_CLASS

PARSER_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

_ESCAPED_SPACE = rf"(?:[{WHITE_SPACE_CLASS}]|\\[tnrf]|\\u000[bB])*+"
#: A quoted value (never a key) that holds exactly a boolean or a plain number. With more digits
#: before the point it is infinite as a DOUBLE, and stays text for the checks to see.
QUOTED_SCALAR = (
    r'(?<=[:\[,])"' + _ESCAPED_SPACE
    + r"(true|false|-?(?:0|[1-9]\d{0,308})(?:\.\d++)?)"
    + _ESCAPED_SPACE + r'"(?=[,\]}])'
)

#: Such a number; ECMAScript writes it as null.
_ENDLESS_SCALAR = (
    r'(?<=[:\[,])"' + _ESCAPED_SPACE + r"-?[1-9]\d{309,}+(?:\.\d++)?" + _ESCAPED_SPACE + r'"(?=[,\]}])'
)

#: Text in which a number or an escape may be laid out differently from ECMAScript.
_OTHER_LAYOUT = (
    r"[:\[,]-?(?:[0-9][0-9.]*E|[0-9.]{16,}|0\.000000|[0-9]+\.0[,\]}])|\\u00[01][0-9A-F]"
)
_TOKEN = r'"(?:[^"\\]++|\\.)*+"|-?[0-9][-+0-9.eE]*+|[^"0-9-]++'
# Control characters whose \u escape has a hexadecimal letter in it.
_LETTERED_ESCAPES = ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F")


#: What stands behind the text inside its brackets: a word that JSON spells in one way only.
_MARK = "true"


def wrapped(text: Column) -> Column:
    """The text parsed inside ``[...,true]``; see :func:`is_one_value`."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f",{_MARK}]")))


def is_one_value(text: Column, in_brackets: Column) -> Column:
    """Whether a text, given with its :func:`wrapped` form, is exactly one JSON value.

    The parser ignores whatever follows the value it read, so the text is parsed
    inside ``[...,true]``: with one value, the second item is that ``true`` and there is no
    third. A text that closes the bracket early hides it, unless it has a ``true`` before a ``]`` of
    its own; only then is it parsed a second time inside ``{...}``.
    """
    closed = ~text.rlike(rf"{_MARK}[ \t\r\n]*+\]") | F.try_parse_json(
        F.concat(F.lit('{"v":'), text, F.lit("}"))
    ).isNotNull()
    ok = (
        in_brackets.isNotNull()
        & (F.to_json(F.try_variant_get(in_brackets, "$[1]", "variant")) == _MARK)
        & F.try_variant_get(in_brackets, "$[2]", "variant").isNull()
        & closed
    )
    return F.coalesce(ok, F.lit(False))


def parsed(text: Column) -> Column:
    """VARIANT of a text that is exactly one JSON value, else NULL."""
    whole = wrapped(text)
    return F.when(is_one_value(text, whole), F.try_variant_get(whole, "$[0]", "variant"))


def array_items(df: DataFrame, text: str, into: str) -> DataFrame:
    """Add ``into``: array of (value VARIANT, text STRING) of a JSON array, else NULL.

    The items are read one by one, so the size of the whole array is not bound by
    the limit on a single VARIANT. ``text`` keeps the item's own key order; a
    string item appears without its quotes.
    """
    as_list = F.from_json(
        F.concat(F.lit("["), F.col(text), F.lit("]")), "array<array<variant>>", PARSER_OPTIONS
    )
    as_member = F.from_json(
        F.concat(F.lit('{"v":'), F.col(text), F.lit("}")), "struct<v array<string>>", PARSER_OPTIONS
    )
    looks_like_array = first_mark(F.col(text)) == "["
    return (
        df.withColumn("_list", F.when(looks_like_array, as_list))
        .withColumn("_texts", F.when(F.size("_list") == 1, as_member["v"]))
        .withColumn(
            into,
            F.when(
                F.col("_texts").isNotNull() & (F.size("_texts") == F.size(F.col("_list")[0])),
                F.arrays_zip(
                    F.col("_list")[0].alias("value"),
                    F.transform("_texts", lambda t: F.coalesce(t, F.lit("null"))).alias("text"),
                ),
            ),
        )
        .drop("_list", "_texts")
    )


def kind_of_schema(schema: Column) -> Column:
    """ECMAScript type name from a VARIANT's schema text; ``undefined`` for NULL.

    Give it a column computed once, not the expression: it is looked at repeatedly.
    """
    return (
        F.when(schema.isNull(), "undefined")
        .when(schema == "STRING", "string")
        .when(schema == "VOID", "null")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array")
        .otherwise("number")
    )


def kind(value: Column) -> Column:
    """ECMAScript type name of a VARIANT."""
    return kind_of_schema(F.schema_of_variant(value))


def first_mark(text: Column) -> Column:
    """First visible character of a JSON text."""
    # Trimmed by its set of blanks: the rest of a long text is not looked at.
    return F.left(F.ltrim(text, F.lit(" \t\r\n")), F.lit(1))


def kind_of_mark(mark: Column) -> Column:
    """Type name from the first character of a JSON text; cheap for large values."""
    return (
        F.when(mark.isNull(), "undefined")
        .when(mark == "{", "object")
        .when(mark == "[", "array")
        .when(mark == '"', "string")
        .when(mark == "n", "null")
        .when(mark.isin("t", "f"), "boolean")
        .otherwise("number")
    )


def has_quoted_scalar(text: Column) -> Column:
    return text.rlike(QUOTED_SCALAR)


def unquote_scalars(text: Column) -> Column:
    """Turn quoted booleans and plain numbers into booleans and numbers, at any depth."""
    return F.regexp_replace(text, QUOTED_SCALAR, "$1")


def field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def canonical(sorted_text: Column) -> Column:
    """Canonical text from a VARIANT's own text, whose keys are already sorted.

    Plain numbers are printed alike by both; the rare text holding an exponent,
    a very small or a very long number is rewritten token by token.
    """

    def relaid(token: Column) -> Column:
        lowered = token
        for code in _LETTERED_ESCAPES:
            lowered = F.regexp_replace(
                lowered, r"(?<!\\)((?:\\\\)*+)\\u00" + code, r"$1\\u00" + code.lower()
            )
        return (
            F.when(token.rlike("^-?[0-9]"), number_to_text(token.try_cast("double")))
            .when(token.startswith('"'), lowered)
            .otherwise(token)
        )

    sorted_text = F.regexp_replace(sorted_text, _ENDLESS_SCALAR, "null")
    tokens = F.regexp_extract_all(sorted_text, F.lit(_TOKEN), F.lit(0))
    return F.when(
        sorted_text.rlike(_OTHER_LAYOUT), F.array_join(F.transform(tokens, relaid), "")
    ).otherwise(sorted_text)
