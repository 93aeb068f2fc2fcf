"""Closed vocabularies, code labels, flags and image-marker classification."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import text_value

# Stance translation (input compared lower-case).
STANCE_LABELS = {
    "orthodox": "Destro",
    "southpaw": "Canhoto",
    "switch": "Ambidestro",
}

# Bonus code labels; other codes become "Bonus <n>".
BONUS_LABELS = {
    1: "Luta da Noite",
    2: "Performance da Noite",
    3: "Finalizacao da Noite",
    4: "Nocaute da Noite",
}
BONUS_SEED = [1, 2, 3, 4]

# Marker image names in priority order -> bonus code.
BONUS_MARKERS = [("fight.png", 1), ("perf.png", 2), ("sub.png", 3), ("ko.png", 4)]
TITLE_MARKER = "belt.png"
TITLE_TYPE = "title bout"
NORMAL_TYPE = "normal"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])


def translate_stance(x) -> Column:
    """Case-insensitive closed-vocabulary lookup; unknown -> null."""
    return F.try_element_at(_literal_map(STANCE_LABELS), F.lower(text_value(x)))


def bonus_label(code) -> Column:
    """Label of a bonus code, falling back to ``Bonus <n>``."""
    c = _c(code)
    return F.coalesce(F.try_element_at(_literal_map(BONUS_LABELS), c),
                      F.concat(F.lit("Bonus "), c.cast("string")))


def bonus_from_images(srcs) -> Column:
    """Highest-priority marker found in the lower-cased image names, else null."""
    arr = _c(srcs)
    out = None
    for marker, code in BONUS_MARKERS:
        hit = F.exists(arr, _mentions(marker))
        out = F.when(hit, F.lit(code)) if out is None else out.when(hit, F.lit(code))
    return out


def _mentions(marker: str):
    return lambda s: F.contains(F.lower(F.coalesce(s, F.lit(""))), F.lit(marker))


def bout_type_from_images(srcs) -> Column:
    hit = F.exists(_c(srcs), _mentions(TITLE_MARKER))
    return F.when(hit, F.lit(TITLE_TYPE)).otherwise(F.lit(NORMAL_TYPE))


def title_flag(x) -> Column:
    """1 when the bout type is ``title bout`` (any case), else 0."""
    return (F.lower(F.coalesce(_c(x), F.lit(""))) == TITLE_TYPE).cast("int")


def digits_to_int(x) -> Column:
    """Digits-only text -> int; anything else -> null."""
    c = _c(x)
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))
