"""Code standardisation: padding, ids, bins, composite keys, one-hot columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed values (must equal the reference's): species codes, names and ids, and
# main areas with name, latitude and longitude of their representative point.
SPECIES_NAMES = {"COD": "Torsk", "HAD": "Hyse", "POK": "Sei"}
SPECIES_IDS = {"COD": 1, "HAD": 2, "POK": 3}
OTHER_SPECIES_ID = 99
AREA_NAMES = {
    "03": ("Øst-Finnmark", 71.0, 30.0),
    "04": ("Vest-Finnmark", 71.0, 24.5),
    "05": ("Røstbanken til Malangsgrunnen", 68.5, 13.0),
    "06": ("Helgelandsbanken", 66.5, 11.0),
    "07": ("Storegga-Frøyabanken", 63.5, 5.5),
    "08": ("Eigersundbanken", 58.5, 4.5),
}
# Vessel group by length in metres, right-closed: (-inf, 20], (20, 30], (30, inf).
VESSEL_GROUPS = (("Kyst", 20.0), ("Kyst større", 30.0), ("Hav", None))


def lpad_code(c: Column | str, width: int = 2) -> Column:
    """Left-pad with zeros to ``width``; longer codes are cut (Spark/SQL lpad)."""
    return F.lpad(_col(c), width, "0")


def zfill_code(c: Column | str, width: int = 2) -> Column:
    """Left-pad with zeros but never cut (Python ``str.zfill`` for codes)."""
    s = _col(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def strip_dot0(c: Column | str) -> Column:
    """Drop a trailing ``.0`` only (``1.05`` stays ``1.05``)."""
    return F.regexp_replace(_col(c).cast("string"), r"\.0$", "")


def species_id(code: Column | str, ids: Mapping[str, int] | None = None,
               other: int = OTHER_SPECIES_ID) -> Column:
    ids = SPECIES_IDS if ids is None else ids
    c = _col(code)
    expr = None
    for key, value in ids.items():
        expr = (F.when(c == key, F.lit(value)) if expr is None
                else expr.when(c == key, F.lit(value)))
    return F.lit(other) if expr is None else expr.otherwise(F.lit(other))


def area_id(code: Column | str) -> Column:
    """Area code as int; NULL when not an integer text."""
    return _col(code).try_cast("int")


def vessel_group(length: Column | str, groups=VESSEL_GROUPS) -> Column:
    """Length bins, right-closed; NULL for unknown length."""
    x = _col(length)
    expr = None
    for label, upper in groups:
        cond = x.isNotNull() if upper is None else x <= F.lit(upper)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def concat_key(*cols: Column | str, sep: str = "-", fill: str = "X") -> Column:
    """``a-b-c`` with ``fill`` in place of a missing part."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit(fill)) for c in cols])


def one_hot(c: Column | str, values: Iterable, prefix: str) -> list[Column]:
    """0/1 int column per value, named ``{prefix}_{value}``."""
    x = _col(c)
    return [F.coalesce((x == F.lit(v)).cast("int"), F.lit(0)).alias(f"{prefix}_{v}") for v in values]
