"""JSON access on VARIANT values.

Payloads are parsed once into VARIANT (binary, schema-on-read). Member access then never
re-parses text, numbers keep their full precision, and JSON null / missing both read as NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, VariantType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_json_lenient(c) -> Column:
    """Text -> VARIANT; malformed text -> NULL."""
    return F.try_parse_json(_col(c))


def json_parse_error(text, parsed) -> Column:
    """'JSON parse error' when a non-empty body did not parse, else NULL."""
    text, parsed = _col(text), _col(parsed)
    return F.when((F.length(text) > 0) & parsed.isNull(), F.lit("JSON parse error"))


def _path(path: str) -> str:
    if path.startswith("$"):
        return path
    return "$" + "".join(f"['{p}']" for p in path.split("."))


def json_member(v, path: str) -> Column:
    """Member as VARIANT (like ``->``)."""
    return F.try_variant_get(_col(v), _path(path), "variant")


def json_text(v, path: str) -> Column:
    """Member as text (like ``->>``): strings unquoted, objects/arrays as JSON text, null -> NULL."""
    return F.try_variant_get(_col(v), _path(path), "string")


def json_array(v, path: str = "$") -> Column:
    """Member as array<variant>; NULL when missing, JSON null or not an array."""
    return F.try_variant_get(_col(v), _path(path), "array<variant>")


def struct_type(members) -> str:
    """DDL of a struct with these members: names are texts (read as by ``json_text``), pairs (name, type) the rest."""
    return "struct<" + ",".join(f"`{m}`:string" if isinstance(m, str) else f"`{m[0]}`:{m[1]}" for m in members) + ">"


def json_typed(v, path: str, ddl: str) -> Column:
    """Member as a value of a nested type, in one pass over it. What doesn't fit is NULL where it stands, nothing around it: an
    array that is none, an element that is no object."""
    return F.try_variant_get(_col(v), _path(path), ddl)


def as_variant(df, name: str) -> Column:
    """Column ``name`` of ``df`` as VARIANT whether it is stored as JSON text or VARIANT."""
    dt = df.schema[name].dataType
    if isinstance(dt, VariantType):
        return F.col(name)
    if isinstance(dt, StringType):
        return F.try_parse_json(F.col(name))
    raise TypeError(f"column {name} must be string or variant, got {dt}")
