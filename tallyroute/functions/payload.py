"""Tolerant readers for JSON and XML payloads: malformed input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def field(value: str | Column, path: str) -> Column:
    return F.get_json_object(_col(value), path)


def fields(value: str | Column, names: list[str], root: str = "$") -> Column:
    """Several text members of one object, parsed once into a struct."""
    schema = ", ".join(f"`{name}` STRING" for name in names)
    body = _col(value) if root == "$" else F.get_json_object(_col(value), root)
    return F.from_json(body, schema)


def xml_tag(value: str | Column, tag: str) -> Column:
    """Text of the first ``<tag>``; NULL if there is none."""
    return F.nullif(F.regexp_extract(_col(value), f"<{tag}>(.*?)</{tag}>", 1), F.lit(""))


def unquoted(value: str | Column) -> Column:
    """Undo one level of quoting of a JSON document stored as a JSON string."""
    return F.replace(F.btrim(_col(value), F.lit('"')), F.lit('\\"'), F.lit('"'))


def any_item(value: str | Column, path: str, member: str, wanted: str) -> Column:
    """True if the array at ``path`` has an object whose ``member`` equals ``wanted``."""
    items = F.from_json(
        F.get_json_object(_col(value), path), f"ARRAY<STRUCT<`{member}`: STRING>>"
    )
    return F.exists(items, lambda item: item[member] == wanted)


def items(value: str | Column, path: str, schema: str) -> Column:
    return F.from_json(F.get_json_object(_col(value), path), f"ARRAY<STRUCT<{schema}>>")


def occupation(value: str | Column) -> Column:
    """First answer among the five shapes identity providers send.

    The first character decides which parser may try: a JSON parser that fails throws per row.
    """
    text = _col(value)
    first = F.substring(F.ltrim(text), 1, 1)
    body = F.when(first == "{", text)
    details = field(field(field(body, "$.actions"), "$[1].details"), "$.pan")
    return F.coalesce(
        field(body, "$.occupation"),
        field(body, "$.signing_parties[0].pki_signature_details.occupation"),
        field(details, "$.occupation"),
        xml_tag(text, "occupation"),
        field(unquoted(F.when(first == '"', text)), "$.pan_details.occupation"),
    )


def object_of(**members: Column) -> Column:
    return F.to_json(F.struct(*[column.alias(name) for name, column in members.items()]))
