"""Reading JSON documents whose repeated parts are an object, a text or a list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_KEY = "#text"


def node(document: Column, *keys: str, kind: str = "variant") -> Column:
    """Nested lookup; null where a step is absent or is not an object."""
    path = "$" + "".join(f'["{key}"]' for key in keys)
    return F.try_variant_get(document, path, kind)


def text_at(document: Column, *keys: str) -> Column:
    return node(document, *keys, kind="string")


def as_list(value: Column) -> Column:
    """The elements when the value is a list, else null."""
    return node(value, kind="array<variant>")


def is_object(value: Column) -> Column:
    return node(value, kind="map<string,variant>").isNotNull()


def body_text(value: Column) -> Column:
    """An object's text entry, or its JSON form when it has none; a plain value as text."""
    return F.coalesce(text_at(value, TEXT_KEY), text_at(value), F.lit(""))


def element_text(value: Column) -> Column:
    """An object's text entry, empty when it has none; a plain value as text."""
    return F.when(is_object(value), F.coalesce(text_at(value, TEXT_KEY), F.lit(""))).otherwise(
        text_at(value)
    )


def full_text(value: Column) -> Column:
    """Text of a plain value, an object or a list (joined by a blank)."""
    return F.coalesce(F.array_join(F.transform(as_list(value), body_text), " "), body_text(value))


def truthy(text: Column) -> Column:
    return F.coalesce(text != "", F.lit(False))
