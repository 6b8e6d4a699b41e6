"""Turn a JSON object of any values into MAP<STRING,STRING>."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from authlane.functions.plan import bound


# Sign, first digit, fraction and exponent of a double's text.
_EXPONENT = r"^(-?)(\d)\.(\d+)E(-?\d+)$"


def plain_number(text: Column) -> Column:
    """Spell a double's text without an exponent: ``1.0E21`` and ``1.5E-7`` in full,
    and without a trailing ``.0``."""
    return _by_exponent(text, _in_full)


def _by_exponent(text: Column, spelled: Callable[[Column, Column], Column]) -> Column:
    """``spelled`` of a double's text and its exponent; a text without one loses a trailing
    ``.0``. The exponent is read only where there is one, as a failed cast costs a Java exception."""

    def with_exponent(t: Column) -> Column:
        return bound(F.regexp_extract(t, r"E(-?\d+)$", 1).try_cast("int"), lambda e: spelled(t, e))

    return bound(
        text,
        lambda t: F.when(F.contains(t, F.lit("E")), with_exponent(t)).otherwise(F.regexp_replace(t, r"\.0$", "")),
    )


def _in_full(text: Column, exponent: Column) -> Column:
    sign = F.regexp_extract(text, _EXPONENT, 1)
    # "1.0E21" has the digits "1": a lone fraction zero carries no information.
    frac = F.regexp_replace(F.regexp_extract(text, _EXPONENT, 3), "0+$", "")
    digits = F.concat(F.regexp_extract(text, _EXPONENT, 2), frac)
    shift = exponent - F.length(frac)
    large = F.when(
        shift >= 0, F.concat(sign, digits, F.repeat(F.lit("0"), shift))
    ).otherwise(
        F.concat(
            sign,
            F.substring(digits, F.lit(1), exponent + F.lit(1)),
            F.lit("."),
            F.substring(digits, exponent + F.lit(2), F.length(digits)),
        )
    )
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - F.lit(1)), digits)
    return F.when(exponent < 0, small).otherwise(large)


# JSON text in pieces: strings, numbers, and what lies between.
_PIECES = r'("(?:[^"\\]++|\\.)*+"|-?[0-9][0-9.eE+-]*+|[^"0-9-]++)'

# A number, or text in a string that looks like one, that a double may spell otherwise: with
# a fraction or an exponent, or too long. JSON from a VARIANT has no blanks before numbers.
_INEXACT = r"(?:^|[\[,:])-?(?:[0-9]+[.eE]|[0-9]{16})"


def json_number(text: Column) -> Column:
    """Spell a double's text as a number inside JSON: an exponent from 1e21 on and below 1e-6."""

    def spelled(t: Column, exponent: Column) -> Column:
        mantissa = F.regexp_replace(F.substring_index(t, "E", 1), r"\.0$", "")
        sign = F.when(exponent > 0, "e+").otherwise("e")
        return F.when(
            (exponent >= 21) | (exponent < -6), F.concat(mantissa, sign, exponent.cast("string"))
        ).otherwise(_in_full(t, exponent))

    return _by_exponent(text, spelled)


def json_numbers(text: Column) -> Column:
    """JSON text with every number outside strings rounded to a double."""

    def rounded(t: Column) -> Column:
        spelled = F.transform(
            F.regexp_extract_all(t, F.lit(_PIECES), F.lit(1)),
            lambda p: F.when(
                F.rlike(p, F.lit("^-?[0-9]")), json_number(p.try_cast("double").cast("string"))
            ).otherwise(p),
        )
        return F.array_join(spelled, "")

    return bound(text, lambda t: F.when(F.rlike(t, F.lit(_INEXACT)), rounded(t)).otherwise(t))


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def stringify_value(v: Column) -> Column:
    """One VARIANT value as text: strings as they are, booleans as true/false,
    numbers in plain notation, arrays and objects as JSON with sorted keys."""
    nested = json_numbers(F.to_json(v))
    for char, escaped in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e")):
        nested = F.replace(nested, F.lit(char), F.lit(escaped))
    return bound(
        _kind(v),
        lambda kind: F.when(kind.isin("STRING", "BOOLEAN"), v.cast("string"))
        .when(F.startswith(kind, F.lit("ARRAY")) | F.startswith(kind, F.lit("OBJECT")), nested)
        .otherwise(plain_number(v.try_cast("double").cast("string"))),
    )


def is_object(v: Column) -> Column:
    return F.startswith(F.coalesce(_kind(v), F.lit("")), F.lit("OBJECT"))


def stringify_map(v: Column) -> Column:
    """A VARIANT object as MAP<STRING,STRING>, without empty keys and nulls.
    A missing or null object gives the empty map."""
    as_map = F.when(is_object(v), v.cast("map<string,variant>"))
    kept = F.map_filter(as_map, lambda k, x: (k != "") & ~F.is_variant_null(x))
    texts = F.transform_values(kept, lambda _, x: stringify_value(x))
    return F.coalesce(texts, F.create_map().cast("map<string,string>"))
