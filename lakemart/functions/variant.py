"""VARIANT parsing and typed field access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote_name(name: str) -> Column:
    """Column reference for any source name (spaces, parentheses, dots, backticks)."""
    return F.col("`" + name.replace("`", "``") + "`")


def parse_json(text: Column | str, strict: bool = True) -> Column:
    """JSON text to VARIANT. Malformed text fails the job, or gives NULL with
    ``strict=False``."""
    return F.parse_json(_col(text)) if strict else F.try_parse_json(_col(text))


def variant_path(field: str) -> str:
    """``$.name`` for plain names, ``$["Name (x)"]`` for anything else."""
    if field.replace("_", "").isalnum() and field.isascii() and not field[0].isdigit():
        return f"$.{field}"
    return '$["' + field.replace("\\", "\\\\").replace('"', '\\"') + '"]'


def variant_field(payload: Column | str, field: str, type_: str = "string") -> Column:
    """Typed field of a VARIANT object; NULL when missing or not castable."""
    path = field if field.startswith("$") else variant_path(field)
    return F.try_variant_get(_col(payload), path, type_)


def hash_key(*cols: Column | str) -> Column:
    """64-bit surrogate key (xxHash64, seed 42 as in Spark)."""
    return F.xxhash64(*[_col(c) for c in cols])
