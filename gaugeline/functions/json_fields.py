"""Fields of a JSON text column."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_field(doc: Column, name: str, default: str | None = None) -> Column:
    return F.coalesce(F.get_json_object(doc, f"$.{name}"), F.lit(default).cast("string"))


def int_field(doc: Column, name: str, default: int) -> Column:
    """Whole number of the field; fractions are cut, what is not a number gives the default."""
    number = F.get_json_object(doc, f"$.{name}").try_cast("double").try_cast("int")
    return F.coalesce(number, F.lit(default).cast("int"))


def bool_field(doc: Column, name: str, default: bool) -> Column:
    """``true``/``false``, or a number that is false only when zero."""
    text = F.get_json_object(doc, f"$.{name}")
    return (
        F.when(text == "true", True)
        .when(text == "false", False)
        .when(text.try_cast("double").isNotNull(), text.try_cast("double") != 0)
        .otherwise(F.lit(default))
    )


def date_field(doc: Column, name: str) -> Column:
    """Epoch milliseconds as TIMESTAMP; NULL when the field is missing or -1."""
    ms = F.get_json_object(doc, f"$.{name}").try_cast("bigint")
    return F.timestamp_millis(F.nullif(ms, F.lit(-1).cast("bigint")))


OBJECT = T.MapType(T.StringType(), T.VariantType())


def drop_fields(doc: Column, fields: Sequence[str]) -> Column:
    """The document without ``fields``; a dot reaches into a nested object.

    All other fields stay, known or not, nulls included; absent ones stay absent. NULL where the text is no object.
    """
    return F.to_json(_without(F.from_json(doc, OBJECT), fields))


def _without(entries: Column, fields: Sequence[str]) -> Column:
    nested: dict[str, list[str]] = defaultdict(list)
    for field in fields:
        head, dot, rest = field.partition(".")
        if dot:
            nested[head].append(rest)
    gone = [f for f in fields if "." not in f]
    kept = F.map_filter(entries, lambda k, _: ~k.isin(*gone)) if gone else entries

    def changed(k: Column, v: Column) -> Column:
        out = F.when(F.lit(False), v)
        for head, rest in nested.items():
            inner = F.try_variant_get(v, "$", "map<string,variant>")
            out = out.when((k == head) & inner.isNotNull(), F.to_variant_object(_without(inner, rest)))
        return out.otherwise(v)

    return F.transform_values(kept, changed) if nested else kept


def drop_top_fields(doc: Column, fields: Sequence[str]) -> Column:
    """The document without top-level ``fields``; needs no schema.

    Values are kept as raw JSON through VARIANT, so numbers, texts and nested objects survive.
    """
    entries = F.from_json(doc, OBJECT)
    return F.to_json(F.map_filter(entries, lambda k, _: ~k.isin(*fields)))
