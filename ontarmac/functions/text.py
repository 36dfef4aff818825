"""Codes, messages and sentences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ontarmac import constants as K
from ontarmac.functions.casts import as_column

WHITESPACE = " \t\r\n\f\x0b"


def stripped(column: str | Column) -> Column:
    return F.btrim(as_column(column), F.lit(WHITESPACE))


def code(column: str | Column) -> Column:
    """A carrier or airport code without surrounding space, in capitals."""
    return F.upper(stripped(column))


def model_key(column: str | Column) -> Column:
    """A model id in lower case; blank counts as absent."""
    return F.nullif(F.lower(stripped(column)), F.lit(""))


def joined_code(*columns: str | Column) -> Column:
    return F.concat_ws("_", *[as_column(c) for c in columns])


def named_codes(message: str | Column) -> Column:
    """Every word of three letters from A to Z in a message, in capitals and in order."""
    return F.regexp_extract_all(F.upper(as_column(message)), F.lit(r"(?U)\b([A-Z]{3})\b"), F.lit(1))


def intent(message: str | Column) -> Column:
    """The tool a message asks for; words count wherever they stand, earlier tools win."""
    text = F.lower(stripped(message))
    result = F
    for tool, words in K.INTENT_WORDS:
        hit = reduce(lambda a, b: a | b, [text.contains(w) for w in words])
        result = result.when(hit, tool)
    return result.otherwise("help")


def percent(probability: str | Column) -> Column:
    """A share as a percentage with one digit, rounded from the exact binary value, ties to even.

    Ten times the percentage is the sum of eight and two times it, both exact; ``error`` is what that sum lost.
    """
    x = as_column(probability) * 100
    sum_ = x * 8 + x * 2
    error = x * 2 - (sum_ - x * 8)
    whole = F.floor(sum_)
    rest = sum_ - whole
    odd = whole % 2 == 1
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & odd)))
    tenths = whole + up.cast("int")
    shown = F.format_string("%d.%d%%", F.floor(tenths / 10), tenths % 10)
    return F.when(as_column(probability).isNotNull(), shown)


def risk_band(probability: str | Column) -> Column:
    p = as_column(probability)
    return F.when(p >= K.HIGH_RISK, "high").when(p >= K.MEDIUM_RISK, "medium").otherwise("low")


def explain_sentence(probability: str | Column, band: str | Column) -> Column:
    return F.format_string(K.TEXT_EXPLAIN, percent(probability), as_column(band))


def predict_sentence(probability: str | Column) -> Column:
    return F.format_string(K.TEXT_PREDICT, percent(probability), risk_band(probability))


def route_sentence(origin: Column, dest: Column, miles: Column, origin_wac: Column, dest_wac: Column) -> Column:
    return F.format_string(K.TEXT_ROUTE, origin, dest, miles, origin_wac, dest_wac)
