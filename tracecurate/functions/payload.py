"""Expressions over nested payloads: requests, responses, metadata, completions.

A payload column may be a VARIANT (mixed kinds, as a trace store delivers them), plain
text, a map or a struct. ``as_payload`` brings all of them to VARIANT, where an object is
taken apart and a string is used as it is, never parsed as JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .literals import parse_literal
from .text import pystrip


def as_payload(col: Column, dtype: T.DataType, parse_json: bool = False) -> Column:
    """Any payload as VARIANT. With ``parse_json``, text that holds a JSON object becomes
    that object: for stores that keep every payload as text."""
    if isinstance(dtype, T.VariantType):
        return col
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_variant_object(col)
    text = col.cast("string")
    if parse_json:
        parsed = F.when(F.startswith(F.ltrim(text), F.lit("{")), F.try_parse_json(text))
        return F.coalesce(parsed, text.cast("variant"))
    return text.cast("variant")


def _scalar_text(payload: Column) -> Column:
    """Text of a payload that is not an object; empty for null and for false-like values."""
    text = F.try_variant_get(payload, "$", "string")
    false_like = text.isin("0", "0.0", "false", "[]") & (F.schema_of_variant(payload) != "STRING")
    return F.when(text.isNull() | false_like, "").otherwise(pystrip(text))


def _is_object(payload: Column, field: str) -> Column:
    # Reads one top-level field only; null for every kind but object.
    return F.try_variant_get(payload, "$", f"struct<{field}: variant>").isNotNull()


def request_text(payload: Column) -> Column:
    """User text: contents of all user messages joined by a blank, or the plain string.

    A message whose content is not text (a multi-part list, a number) is dropped.
    """
    messages = F.try_variant_get(
        payload, "$.messages", "array<struct<role: string, content: variant>>"
    )

    def is_user_text(m: Column) -> Column:
        kind = F.coalesce(F.schema_of_variant(m["content"]), F.lit("VOID"))
        return (m["role"] == "user") & kind.isin("STRING", "VOID")

    contents = F.transform(
        F.filter(messages, is_user_text),
        lambda m: F.coalesce(F.try_variant_get(m["content"], "$", "string"), F.lit("")),
    )
    return F.when(
        _is_object(payload, "messages"), F.coalesce(pystrip(F.array_join(contents, " ")), F.lit(""))
    ).otherwise(_scalar_text(payload))


def response_text(payload: Column) -> Column:
    """Assistant text: content of the first choice, or the plain string."""
    content = F.try_variant_get(payload, "$.choices[0].message.content", "string")
    return F.when(
        _is_object(payload, "choices"), F.coalesce(pystrip(content), F.lit(""))
    ).otherwise(_scalar_text(payload))


def completion_text(raw: Column, dtype: T.DataType) -> Column:
    """Text of a completion: the string, or the first non-empty content of a list of parts."""
    if isinstance(dtype, T.StringType):
        return raw
    payload = as_payload(raw, dtype)
    parts = F.try_variant_get(payload, "$", "array<variant>")
    contents = F.filter(
        F.transform(parts, lambda part: F.try_variant_get(part, "$.content", "string")),
        lambda text: text != "",
    )
    return F.when(
        parts.isNotNull(), F.coalesce(F.get(contents, F.lit(0)), F.to_json(payload))
    ).otherwise(F.try_variant_get(payload, "$", "string"))


def is_blank_metadata(meta: Column, dtype: T.DataType) -> Column:
    """True when a metadata cell holds nothing, so that its alternate column is asked."""
    if isinstance(dtype, T.StringType):
        return meta.isNull() | (meta == "")
    if isinstance(dtype, T.MapType):
        return meta.isNull() | (F.size(meta) == 0)
    if isinstance(dtype, T.VariantType):
        text = F.try_variant_get(meta, "$", "string")
        return text.isNull() | text.isin("", "{}", "[]")
    return meta.isNull()


def _key_in_text(meta: Column, key: str) -> Column:
    """Look a key up in JSON text or, when it is no JSON, in a Python dict literal."""
    in_literal = F.try_variant_get(parse_literal(meta), f"$['{key}']", "string")
    return F.coalesce(
        F.get_json_object(meta, f"$['{key}']"),
        F.when(F.try_parse_json(meta).isNull(), in_literal),
    )


def metadata_object(meta: Column, dtype: T.DataType) -> Column:
    """Whole metadata as VARIANT, whichever way it is encoded; null if it cannot be read."""
    if isinstance(dtype, T.VariantType):
        text = F.try_variant_get(meta, "$", "string")
        is_text = F.schema_of_variant(meta) == "STRING"
        return F.when(is_text, metadata_object(text, T.StringType())).otherwise(meta)
    if not isinstance(dtype, T.StringType):
        return F.to_variant_object(meta)
    parsed = F.try_parse_json(meta)
    found = F.when(parsed.isNotNull(), parsed).otherwise(parse_literal(meta))
    return F.when(F.startswith(F.ltrim(meta), F.lit("{")), found)


def metadata_value(meta: Column, dtype: T.DataType, key: str) -> Column:
    """Value of one metadata key, whichever way the metadata is encoded."""
    if isinstance(dtype, T.MapType):
        return F.try_element_at(meta, F.lit(key))
    if isinstance(dtype, T.StructType):
        return meta[key] if key in dtype.names else F.lit(None).cast("string")
    if isinstance(dtype, T.VariantType):
        inside = F.try_variant_get(meta, f"$['{key}']", "string")
        return F.coalesce(inside, _key_in_text(F.try_variant_get(meta, "$", "string"), key))
    return _key_in_text(meta, key)


def is_unreadable_metadata(meta: Column, dtype: T.DataType) -> Column:
    """True for metadata text that is neither a JSON object nor a dict literal."""
    if isinstance(dtype, T.VariantType):
        text = F.try_variant_get(meta, "$", "string")
        is_text = F.coalesce(F.schema_of_variant(meta) == "STRING", F.lit(False))
        return is_text & is_unreadable_metadata(text, T.StringType())
    if not isinstance(dtype, T.StringType):
        return F.lit(False)
    return F.coalesce((meta != "") & metadata_object(meta, dtype).isNull(), F.lit(False))


def unquoted(value: Column) -> Column:
    """Strip double quotes from both ends, then single quotes."""
    return F.btrim(F.btrim(value, F.lit('"')), F.lit("'"))
