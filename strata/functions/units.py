"""Unit conversions: height and reach to whole centimetres, weight to kg.

Whole-centimetre results round half to even (``bround``), as Python's
``round`` does: 75 in * 2.54 = 190.5 -> 190. Factors are double literals;
a bare ``2.54`` in Spark SQL would be a DECIMAL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import text_value

# Conversion factors.
CM_PER_INCH = 2.54
KG_PER_POUND = 0.45359237

_NUM = "(\\d+(?:[.,]\\d+)?)"


def _number(txt: Column, pattern: str) -> Column:
    """First capture of ``pattern`` as a double (comma decimals allowed), else null."""
    raw = F.nullif(F.regexp_extract(txt, pattern, 1), F.lit(""))
    return F.regexp_replace(raw, ",", ".").try_cast("double")


def height_cm(x) -> Column:
    """``F' I`` -> (12F + I) * 2.54; else ``N cm``; else null. Whole cm."""
    txt = text_value(x)
    feet = F.nullif(F.regexp_extract(txt, "(\\d+)\\s*'\\s*(\\d+)", 1), F.lit(""))
    inches = F.nullif(F.regexp_extract(txt, "(\\d+)\\s*'\\s*(\\d+)", 2), F.lit(""))
    imperial = (feet.try_cast("double") * 12 + inches.try_cast("double")) * F.lit(CM_PER_INCH)
    metric = _number(F.lower(txt), _NUM + "\\s*cm")
    value = F.when(feet.isNotNull(), imperial).otherwise(metric)
    return F.bround(value, 0).cast("int")


def weight_kg(x) -> Column:
    """``N lb(s)`` -> N * 0.45359237; else ``N kg``; else null. One decimal."""
    low = F.lower(text_value(x))
    lbs = _number(low, _NUM + "\\s*lbs?")
    kg = _number(low, _NUM + "\\s*kg")
    return F.when(lbs.isNotNull(), F.round(lbs * F.lit(KG_PER_POUND), 1)).otherwise(F.round(kg, 1))


def reach_cm(x) -> Column:
    """``N"`` -> N * 2.54; else ``N cm``; else null. Whole cm."""
    txt = text_value(x)
    inches = _number(txt, _NUM + '\\s*"')
    metric = _number(F.lower(txt), _NUM + "\\s*cm")
    value = F.when(inches.isNotNull(), inches * F.lit(CM_PER_INCH)).otherwise(metric)
    return F.bround(value, 0).cast("int")
