"""Label/value pivot: ``"Label: value"`` items of one record -> columns.

All items of a record are in one array, so the pivot is pure array
expressions on the row (no shuffle, no grouping): parse each item, then for
every wanted label take the last matching item (last occurrence wins;
unknown labels are ignored; an absent label gives null).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import normalise_label, remove_label


def parse_items(items) -> Column:
    """array<string> -> array<struct<label, value>>; label = text up to the colon run."""
    arr = F.col(items) if isinstance(items, str) else items

    def one(item):
        raw = F.regexp_extract(item, "^([^:]*:+)", 1)
        return F.struct(normalise_label(raw).alias("label"), remove_label(item, raw).alias("value"))
    return F.transform(arr, one)


def _label_is(label: str):
    return lambda x: x["label"] == F.lit(label)


def pivot_label_items(df: DataFrame, items: str, targets: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    parsed = parse_items(items)
    cols = []
    for label, out in targets.items():
        hits = F.filter(parsed, _label_is(label))
        cols.append(F.try_element_at(hits, F.lit(-1))["value"].alias(out))
    return df.select(*keep, *cols)
