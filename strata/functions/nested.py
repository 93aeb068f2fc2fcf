"""JSON text and nested-collection helpers (arrays, maps, generators)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import ustrip


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_json_text(x) -> Column:
    """Nested value -> JSON text keeping null fields; null -> null."""
    return F.to_json(_c(x), {"ignoreNullFields": "false"})


def parse_object_array(text, element_type: str) -> Column:
    """JSON text -> array of objects.

    Blank, malformed (strict JSON: no single quotes, nothing after the value) or
    non-array text gives an empty array; array items that are not objects are
    dropped, strings that hold one included. The remaining items are converted
    one by one, so a field of another type is null and not the whole list.
    An object that repeats a key counts as malformed.
    """
    # the parser ignores what follows a value: inside an array that has to end with a known item, nothing can follow
    framed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), ustrip(_c(text)), F.lit(', "end"]'))), "$", "array<variant>")
    alone = (F.size(framed) == 2) & (F.try_variant_get(F.try_element_at(framed, F.lit(2)), "$", "string") == "end")
    items = F.when(alone, F.try_variant_get(F.try_element_at(framed, F.lit(1)), "$", "array<variant>"))
    objects = F.filter(items, lambda e: F.schema_of_variant(e).startswith("OBJECT"))
    parsed = F.transform(objects, lambda e: F.from_json(F.to_json(e), element_type))
    return F.coalesce(parsed, F.array().cast(f"array<{element_type}>"))


def natural_key_order(keys) -> Column:
    """Sort keys numeric-first by value, then text keys lexically.

    Each key gets its sort key once (``transform``: is-text flag, number, text)
    and the array is sorted by the default struct ordering; a comparator
    lambda would re-evaluate the digit test on every comparison.
    """
    def tag(k):
        num = F.when(k.rlike("^[0-9]+$"), k.try_cast("decimal(38,0)"))
        return F.struct(num.isNull().alias("is_text"), num.alias("num"), k.alias("key"))
    return F.transform(F.array_sort(F.transform(_c(keys), tag)), lambda x: x["key"])


def round_keys(rounds_map, total_rounds_text) -> Column:
    """Keys to expand for one member.

    Non-empty map -> its keys in natural order. Empty map -> ``1..n`` from the
    digits-only total (``sequence(1, 0)`` would be ``[1, 0]``, hence the n > 0
    guard). Neither -> a single null key, so the member still yields one row.
    """
    m = _c(rounds_map)
    total = F.trim(F.coalesce(_c(total_rounds_text).cast("string"), F.lit(""))).try_cast("int")
    fallback = F.when(total > 0, F.transform(F.sequence(F.lit(1), total), lambda i: i.cast("string")))
    return (F.when(F.coalesce(F.size(m), F.lit(0)) > 0, natural_key_order(F.map_keys(m)))
             .when(fallback.isNotNull(), fallback)
             .otherwise(F.array(F.lit(None).cast("string"))))
